import pytest
from pyspark.sql import functions as F

from issuelens.sources import versions
from issuelens.sources.versions import drop_versions, latest_version, publish_version, read_version


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert latest_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert publish_version(spark.range(3), path) == 1
    before = read_version(spark, path)
    assert publish_version(spark.range(5), path) == 2
    assert ids(before) == [0, 1, 2] and ids(read_version(spark, path)) == [0, 1, 2, 3, 4]
    assert ids(read_version(spark, path, 1)) == [0, 1, 2]
    # A version may be made from the table itself.
    assert publish_version(read_version(spark, path).where("id > 1"), path) == 3
    assert ids(read_version(spark, path)) == [2, 3, 4]


def test_a_publish_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    publish_version(spark.range(3), path)
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_version(broken, path)
    assert latest_version(spark, path) == 1 and ids(read_version(spark, path)) == [0, 1, 2]

    # All files are written, and the writer dies before it names them.
    def dies(*_):
        assert ids(read_version(spark, path)) == [0, 1, 2]
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(versions, "_claim", dies)
        with pytest.raises(OSError):
            publish_version(spark.range(4), path)
    assert latest_version(spark, path) == 1 and ids(read_version(spark, path)) == [0, 1, 2]
    assert publish_version(spark.range(4), path) == 2 and ids(read_version(spark, path)) == [0, 1, 2, 3]


def test_writers_of_one_number_both_get_through(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    publish_version(spark.range(1), path)
    write, other = versions.write_table, []

    def slow(df, folder, partition):
        write(df, folder, partition)
        if not other:
            other.append(None)
            other.append(publish_version(spark.range(2), path))

    monkeypatch.setattr(versions, "write_table", slow)
    assert publish_version(spark.range(3), path) == 3 and other[1] == 2
    assert ids(read_version(spark, path, 2)) == [0, 1] and ids(read_version(spark, path)) == [0, 1, 2]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(1, 5):
        publish_version(spark.range(n).withColumn("part", F.col("id") % 2), path, "part")
    assert drop_versions(spark, path, 2) == [1, 2]
    assert latest_version(spark, path) == 4
    assert ids(read_version(spark, path, 3)) == [0, 1, 2] and ids(read_version(spark, path)) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        drop_versions(spark, path, 0)
