"""Issue documents and flat appearances out of the relational test tables.

A line item is read as one appearance of a video (part) by a creator (supplier) in the
issue of its shipping month. Each derived column names the table it needs, and only those
tables are joined: by-issue statistics read nothing but the line items. This relies on
every line item having its order, part and supplier (checked by a test).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.functions.moments import date_to_epoch, utc_to_epoch
from issuelens.operators.dedup import keep_first
from issuelens.operators.ordered import rows_before, slice_borders, slice_number
from issuelens.session import materialize

# Unique at every scale; (l_orderkey, l_linenumber) alone is not.
ORDER = ["l_orderkey", "l_linenumber", "aid", "l_suppkey", "l_extendedprice", "l_shipdate"]

# Most videos one nested document holds; a longer issue is delivered in several documents.
DOCUMENT_SIZE = 50

# Lines in a slice of order keys; small tables are cut into up to FEW_SLICES of at least LEAST_LINES lines.
SLICE_LINES, LEAST_LINES, FEW_SLICES = 1 << 18, 1 << 16, 64

# Derived column -> Spark SQL expression, by the table it comes from.
LINE = {
    "week_number": "CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INT)",
    "aid": "l_partkey",
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_suppkey": "l_suppkey",
    "l_extendedprice": "l_extendedprice",
    "l_shipdate": "l_shipdate",
    "mid": "l_suppkey",
    "view": "CAST(floor(l_extendedprice) AS BIGINT)",
    "like_cnt": "CAST(l_quantity * 100 AS BIGINT)",
    "coin": "CAST(round(l_discount * 1000) AS BIGINT)",
    "favorite": "CAST(round(l_tax * 1000) AS BIGINT)",
    "share": "CAST(l_linenumber AS BIGINT)",
    "danmaku": "l_orderkey % 100",
}
PART = {
    "title": "p_name",
    "duration": "CAST(p_size * 90 AS INT)",
    "tname": "p_type",
    "tid": "CAST(conv(substring(md5(p_type), 1, 7), 16, 10) AS INT)",
    "sub_category": "p_brand",
    "reply": "CAST(p_size AS BIGINT)",
    "width": "p_size * 10",
    "height": "(p_size % 5) * 10",
}
ORDERS = {"pubdate": "o_orderdate", "reason": "o_orderpriority"}
SUPPLIER = {"creator_name": "s_name"}
ALL = [*LINE, *PART, *ORDERS, *SUPPLIER]
OTHER_TYPES = {
    "title": "STRING", "duration": "INT", "tname": "STRING", "tid": "INT", "sub_category": "STRING", "reply": "BIGINT",
    "width": "INT", "height": "INT", "pubdate": "TIMESTAMP_NTZ", "reason": "STRING", "creator_name": "STRING",
}

# Derived columns of other tables, and FIGURES, that the fields of a nested video are made of; `owner.mid` is the owner without name.
FIELD_COLUMNS = {
    "title": ["title"], "desc": ["sub_category", "tname"], "duration": ["duration"], "pubdate": ["pubdate"],
    "tid": ["tid"], "tname": ["tname"], "tidv2": ["tid"], "tnamev2": ["tname"], "pid_name_v2": ["sub_category"],
    "dynamic": ["title"], "rcmd_reason": ["reason"], "owner": ["creator_name"], "stat": ["reply", "like_cnt", "coin", "favorite"],
    "dimension": ["width", "height"],
}

# What a line carries until its document is made; the other columns are derived from these.
CARRIED = [*ORDER, "like_cnt", "coin", "favorite"]
# Those that only some fields need.
FIGURES = {"like_cnt": "BIGINT", "coin": "BIGINT", "favorite": "BIGINT"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _line_columns(columns: list[str]) -> list[str]:
    needed = dict.fromkeys(c for c in columns if c in LINE)
    if any(c in PART for c in columns):
        needed["aid"] = None
    if any(c in ORDERS for c in columns):
        needed["l_orderkey"] = None
    if any(c in SUPPLIER for c in columns):
        needed["l_suppkey"] = None
    return list(needed)


def _with_dimensions(lines: DataFrame, spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    out = lines
    for name, derived, theirs, ours in [
        ("part", PART, "p_partkey", "aid"),
        ("orders", ORDERS, "o_orderkey", "l_orderkey"),
        ("supplier", SUPPLIER, "s_suppkey", "l_suppkey"),
    ]:
        wanted = [F.expr(derived[c]).alias(c) for c in columns if c in derived]
        if wanted:
            side = table(spark, folder, name).select(F.col(theirs).alias("_key"), *wanted)
            out = out.join(side, F.col(ours) == F.col("_key")).drop("_key")
    return out.select(*columns)


def _lines(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    return table(spark, folder, "lineitem").select(*[F.expr(LINE[c]).alias(c) for c in columns])


def appearances(spark: SparkSession, folder: str, columns: list[str] = ALL) -> DataFrame:
    """One row per line item; an issue may list a video several times."""
    return _with_dimensions(_lines(spark, folder, _line_columns(columns)), spark, folder, columns)


def with_details(lines: DataFrame, spark: SparkSession, folder: str, columns: list[str], usable: dict[str, str]) -> DataFrame:
    """The dimensions' columns of `columns` for lines that hold the others; lines are neither dropped nor repeated.

    Of several rows of a key one counts that meets the condition `usable` names for its table, on derived columns.
    """
    out = lines
    for name, derived, theirs, ours in [
        ("part", PART, "p_partkey", "aid"),
        ("orders", ORDERS, "o_orderkey", "l_orderkey"),
        ("supplier", SUPPLIER, "s_suppkey", "l_suppkey"),
    ]:
        wanted = [c for c in columns if c in derived]
        if wanted:
            side = table(spark, folder, name).select(F.col(theirs).alias("_key"), *[F.expr(e).alias(c) for c, e in derived.items()])
            one = keep_first(side.where(usable.get(name, "true")).select("_key", *wanted), ["_key"], wanted)
            out = out.join(one, F.col(ours) == F.col("_key"), "left").drop("_key")
    return out


def issue_videos(spark: SparkSession, folder: str, columns: list[str] = ALL) -> DataFrame:
    """One row per (week_number, aid): the first line in ORDER."""
    needed = list(dict.fromkeys([*_line_columns(columns), "week_number", *ORDER]))
    lines = keep_first(_lines(spark, folder, needed), ["week_number", "aid"], ORDER)
    return _with_dimensions(lines, spark, folder, columns)


def first_appearances(spark: SparkSession, folder: str, columns: list[str] = ALL) -> DataFrame:
    """One row per video: its first appearance by (week_number, ORDER)."""
    order = ["week_number", *ORDER]
    needed = list(dict.fromkeys([*_line_columns(columns), *order]))
    lines = keep_first(_lines(spark, folder, needed), ["aid"], order)
    return _with_dimensions(lines, spark, folder, columns)


def last_appearances(spark: SparkSession, folder: str, columns: list[str] = ALL) -> DataFrame:
    """One row per video: its last appearance among the issue_videos."""
    needed = list(dict.fromkeys([*_line_columns(columns), "week_number", *ORDER]))
    per_issue = keep_first(_lines(spark, folder, needed), ["week_number", "aid"], ORDER)
    lines = keep_first(per_issue, ["aid"], [F.col("week_number").desc()])
    return _with_dimensions(lines, spark, folder, columns)


def with_gaps(rows: DataFrame) -> DataFrame:
    """The same appearances with missing ids and titles and missing, negative and zero views."""
    key = F.col("l_orderkey")
    view = (
        F.when(key % 101 == 0, None)
        .when(key % 103 == 0, -1)
        .when(key % 97 == 0, 0)
        .otherwise(F.col("view"))
        .cast("bigint")
    )
    changed = {"view": view, "aid": F.when(key % 107 != 0, F.col("aid")), "title": F.when(key % 89 != 0, F.col("title"))}
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in rows.columns])


def month_start(week: Column) -> Column:
    """First day of the month an issue number stands for."""
    return F.add_months(F.lit("1995-01-01").cast("date"), week - 1)


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The period of each issue in epoch seconds; every 13th issue is missing."""
    weeks = appearances(spark, folder, ["week_number"]).distinct().where(F.col("week_number") % 13 != 0)
    return weeks.select(F.col("week_number").alias("number"), *period(F.col("week_number")))


def period(week: Column) -> list[Column]:
    return [
        date_to_epoch(month_start(week)).alias("start_time"),
        (date_to_epoch(month_start(week + 1)) - 1).alias("end_time"),
    ]


def _wanted(derived: dict[str, str], raw: list[str], columns: list[str]) -> list[str]:
    """Those of a table's own columns that the derived `columns` are made of."""
    return [r for r in raw if any(r in e for c, e in derived.items() if c in columns)]


def _matches(spark: SparkSession, folder: str, name: str, key: str, columns: list[str]) -> DataFrame:
    """One row per key of a dimension with all its rows, or their number: a join with it neither adds nor drops lines."""
    rows = table(spark, folder, name).where(F.col(key).isNotNull())
    found = F.collect_list(F.struct(*columns)) if columns else F.count(F.lit(1)).cast("int")
    return rows.groupBy(F.col(key).alias("_key")).agg(found.alias(f"_{name}"))


def _one_each(lines: DataFrame, ours: str, rows: DataFrame, key: str) -> bool:
    """Whether each line has exactly one of the rows by its key: a join for no column would change nothing. Keys are sent, not lines."""
    found = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    keys = lines.select(F.col(ours).alias("_key")).distinct()
    return keys.join(found, "_key", "left").where("_n IS NULL OR _n <> 1").isEmpty()


def _placed_lines(spark: SparkSession, folder: str, columns: list[str] = ALL) -> DataFrame:
    """All lines with every derived column, the slice of their order and `pos`, their position in the issue.

    Derived columns of other tables and FIGURES that are not among `columns` are null and are not sent.

    Each line is sent to its slice of order keys, where its order is and its position is counted on from the lines of the
    issue in lower slices. Before, it is sent to its part and to its supplier, unless they are small, or give no column and
    each line has exactly one. Positions count lines that then lack their part, order or supplier.
    """
    carried = [c for c in CARRIED if c not in FIGURES or c in columns]
    lines = _lines(spark, folder, ["week_number", *carried]).where(F.col("week_number").isNotNull())
    borders = slice_borders(table(spark, folder, "lineitem"), "l_orderkey", SLICE_LINES, LEAST_LINES, FEW_SLICES)
    number = slice_number(F.col("l_orderkey"), borders).alias("_slice")
    before = rows_before(lines.select("week_number", number), ["week_number"], "_slice")
    wide = lines.select(*carried).where(F.col("l_orderkey").isNotNull())
    own = {
        "_part": _wanted(PART, ["p_name", "p_type", "p_brand", "p_size"], columns),
        "_supplier": _wanted(SUPPLIER, ["s_name"], columns),
        "_orders": _wanted(ORDERS, ["o_orderdate", "o_orderpriority"], columns),
    }
    for name, key, ours in [("part", "p_partkey", "aid"), ("supplier", "s_suppkey", "l_suppkey")]:
        if not own[f"_{name}"] and _one_each(wide, ours, table(spark, folder, name), key):
            del own[f"_{name}"]
            continue
        side = _matches(spark, folder, name, key, own[f"_{name}"])
        wide = wide.join(side, F.col(ours) == F.col("_key"), "left").drop("_key")
    orders = table(spark, folder, "orders").where(F.col("o_orderkey").isNotNull()).select(
        F.col("o_orderkey").alias("l_orderkey"), (F.struct(*own["_orders"]) if own["_orders"] else F.lit(True)).alias("_one")
    )
    both = wide.withColumn("_line", F.lit(True)).unionByName(orders, allowMissingColumns=True)
    both = both.withColumn("_slice", number).repartition("_slice")
    # Null on lines, which the list and the count leave out.
    found = F.collect_list("_one") if own["_orders"] else F.count("_one")
    both = both.withColumn("_orders", found.over(Window.partitionBy("_slice", "l_orderkey"))).where("_line")
    both = both.withColumn("week_number", F.expr(LINE["week_number"]))
    in_slice = F.row_number().over(Window.partitionBy("_slice", "week_number").orderBy(*ORDER))
    placed = both.withColumn("_row", in_slice - 1).join(F.broadcast(before), ["week_number", "_slice"])
    placed = placed.withColumn("pos", F.col("_before") + F.col("_row"))
    for name, raw in own.items():
        if raw:
            placed = placed.select("*", F.inline(name)).drop(name)
        else:
            times = F.array_repeat(F.lit(True), F.col(name).cast("int"))
            placed = placed.select("*", F.explode(times).alias("_there")).drop(name, "_there")
    derived = {c: e for c, e in LINE.items() if c not in placed.columns} | PART | ORDERS | SUPPLIER
    derived |= {c: f"CAST(NULL AS {kind})" for c, kind in {**OTHER_TYPES, **FIGURES}.items() if c in derived and c not in columns}
    return placed.select("*", *[F.expr(e.replace("l_partkey", "aid")).alias(c) for c, e in derived.items()])


def nested_issues(spark: SparkSession, folder: str, gaps: bool = False, fields: list[str] | None = None) -> DataFrame:
    """Issue documents with their videos as an array, as the raw files hold them.

    With `fields`, the other fields of the videos are null, and what they are made of is neither sent nor stored.

    The group of one document is bounded by DOCUMENT_SIZE, not by the size of the issue. Documents are made inside slices
    of order keys and written once; only those cut by the border of a slice are put together afterwards.
    """
    wanted = ALL if fields is None else list(dict.fromkeys(c for f in fields for c in FIELD_COLUMNS.get(f, [])))
    placed = _placed_lines(spark, folder, wanted)
    if gaps:
        placed = with_gaps(placed)
    whole = [
        F.col("aid"),
        F.concat(F.lit("BV"), F.col("aid").cast("string")).alias("bvid"),
        F.col("title"),
        F.concat_ws(" ", "sub_category", "tname").alias("desc"),
        F.col("duration").cast("bigint").alias("duration"),
        utc_to_epoch(F.col("pubdate")).alias("pubdate"),
        F.col("l_orderkey").alias("cid"),
        F.lit(None).cast("string").alias("pic"),
        F.lit(None).cast("string").alias("short_link_v2"),
        F.lit(1).alias("copyright"),
        F.col("tid").cast("bigint").alias("tid"),
        F.col("tname"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("tid").cast("bigint")).alias("tidv2"),
        F.col("tname").alias("tnamev2"),
        F.lit(None).cast("int").alias("pid_v2"),
        F.col("sub_category").alias("pid_name_v2"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("title")).alias("dynamic"),
        F.col("reason").alias("rcmd_reason"),
        F.struct("mid", F.col("creator_name").alias("name"), F.lit(None).cast("string").alias("face")).alias("owner"),
        F.struct(
            F.when(F.col("l_orderkey") % 10 != 0, F.col("aid")).alias("aid"),
            "view", F.col("like_cnt").alias("like"), "coin", "favorite", "share", "reply", "danmaku",
        ).alias("stat"),
        F.struct("width", "height").alias("dimension"),
        F.struct((F.col("l_linenumber") % 2).alias("pay")).alias("rights"),
    ]
    names = placed.select(*whole).columns
    held = names if fields is None else [f.split(".")[0] for f in fields]
    video = F.struct(
        *[v if n in held else F.when(F.lit(False), v).alias(n) for n, v in zip(names, whole)]
    )
    document = F.floor(F.col("pos") / DOCUMENT_SIZE)
    first, size = document * DOCUMENT_SIZE, F.lit(DOCUMENT_SIZE)
    here = (first >= F.col("_before")) & (F.least(first + size, F.col("_total")) <= F.col("_before") + F.col("_rows"))
    made = placed.groupBy("_slice", "week_number", document.alias("_document"), here.alias("_whole")).agg(
        F.sort_array(F.collect_list(F.struct("pos", video.alias("v")))).alias("_videos")
    )
    made = materialize(made, "documents", compression="zstd")
    cut = made.where(~F.col("_whole")).groupBy("week_number", "_document")
    joined = cut.agg(F.sort_array(F.flatten(F.collect_list("_videos"))).alias("_videos"))
    documents = made.where("_whole").select(*joined.columns).unionByName(joined)
    start, end = period(F.col("week_number"))
    return documents.select(
        F.col("week_number").cast("bigint").alias("number"),
        F.struct(
            F.concat(F.lit("Issue "), F.col("week_number").cast("string")).alias("subject"),
            F.date_format(month_start(F.col("week_number")), "yyyy-MM").alias("name"),
            F.lit(None).cast("string").alias("label"),
            F.lit(None).cast("string").alias("cover"),
            start.alias("stime"),
            end.alias("etime"),
        ).alias("config"),
        F.col("_videos.v").alias("videos"),
        (F.col("_document") * DOCUMENT_SIZE).alias("first_pos"),
    )
