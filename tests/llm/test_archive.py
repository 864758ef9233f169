import base64
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from issuelens.llm import archive

PAGES = "page_id long, url string, html string"


def expected(rows, least=0):
    """Plain Python: payload and refers_to of each row."""
    first = {}
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        first.setdefault(html or "", (page_id, url))
    out = []
    for page_id, url, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = first[html or ""] != (page_id, url) and len(raw) >= least
        out.append((page_id, len(raw), digest, "revisit" if again else "response", first[html or ""][0] if again else None))
    return sorted(out, key=repr)


def written(spark, rows, folder, **options):
    archive.write_archive(rows, folder, **options)
    got = archive.read_archive(spark, folder).collect()
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr)


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (5, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (9, None, "<p>x</p>"),
        (1, None, None), (3, "http://c/", ""), (4, "http://d/\r\nWARC-Type: forged\r\n\r\n", "ż\r\nWARC-Type: forged\r\n日本\0"),
        (6, "", "y" * 200_000), (7, "u", "y" * 200_000), (7, "v", "y" * 200_000), (8, "w", "one"), (8, "w", "two"),
        (None, "n", "<p>x</p>"), (None, "n", "alone"), (None, None, None), (10, "r", "again"), (10, "r", "again"), (-7, "http://e", "one"),
    ]
    return rows, spark.createDataFrame(rows, PAGES).selectExpr("*", "'extra' AS digest", "'extra' AS payload", "'extra' AS first", "'extra' AS revisit")


@pytest.mark.parametrize("least", [0, 4])
def test_odd_rows(spark, odd_pages, tmp_path, least):
    rows, frame = odd_pages
    assert written(spark, frame, str(tmp_path / "a"), least_bytes=least) == expected(rows, least)


def test_pages_agree_with_plain_python(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert written(spark, pages, str(tmp_path / "a")) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert written(spark, spark.createDataFrame([], PAGES), str(tmp_path / "a")) == []


def parsed(raw):
    """(WARC fields, block) of the records of one WARC file."""
    while raw:
        head, raw = raw.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        assert raw[size : size + 4] == b"\r\n\r\n"
        yield fields, raw[:size]
        raw = raw[size + 4 :]


def test_records_joined_are_a_warc_file(spark, odd_pages, tmp_path):
    rows, frame = odd_pages
    archive.write_archive(frame, str(tmp_path / "a"))
    file = b"".join(bytes(r.record) for r in archive.warc_records(spark, str(tmp_path / "a")).collect())
    found = list(parsed(file))
    assert len(found) == len(rows)
    by_id = {fields["WARC-Record-ID"]: block for fields, block in found}
    for fields, block in found:
        http, body = block.split(b"\r\n\r\n", 1)
        if fields["WARC-Type"] == "revisit":
            assert body == b"" and fields["WARC-Profile"] == archive.REVISIT_PROFILE
            body = by_id[fields["WARC-Refers-To"]].split(b"\r\n\r\n", 1)[1]
        else:
            assert fields["WARC-Type"] == "response" and "WARC-Refers-To" not in fields
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert http.endswith(f"Content-Length: {len(body)}".encode())


def test_originals_come_back_and_payloads_are_stored_once(spark, odd_pages, tmp_path):
    rows, frame = odd_pages
    folder = str(tmp_path / "a")
    archive.write_archive(frame, folder)
    back = [(r.page_id, bytes(r.payload).decode()) for r in archive.read_archive(spark, folder, payload=True).collect()]
    assert sorted(back, key=repr) == sorted(((i, html or "") for i, _, html in rows), key=repr)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({html or "" for _, _, html in rows})


def test_a_changed_payload_is_noticed(spark, odd_pages, tmp_path):
    folder, other = str(tmp_path / "a"), str(tmp_path / "b")
    archive.write_archive(odd_pages[1], folder)
    spark.read.parquet(f"{folder}/records").write.parquet(f"{other}/records")
    changed = F.concat("payload", F.lit(b"!"))
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", changed).write.parquet(f"{other}/payloads")
    with pytest.raises(PySparkException, match="a stored payload has changed"):
        archive.read_archive(spark, other).collect()


def test_one_payload_with_a_third_of_all_rows(spark, tmp_path):
    frame = spark.range(3000).selectExpr("id AS page_id", "concat('http://', id) AS url", "if(id % 3 = 0, 'hot', concat('p', id)) AS html")
    got = written(spark, frame, str(tmp_path / "a"))
    assert got == expected([tuple(r) for r in frame.collect()])
