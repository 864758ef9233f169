"""Mixing sources to target weights by highest quotients. Built-in expressions only.

Sizes are word counts. The mix holds `share` of all words; a source's target follows its weight but
is at most `ceiling` times its size, the excess going to the others by weight until none is above.
Targets become whole blocks of BLOCK words by Sainte-Laguë's highest quotients target / (2 s + 1),
and each source's blocks go by the same rule to its shards. In a shard, documents stand in seeded
order on a line cut into equal blocks; a seeded start picks the wanted number of blocks, each the
same number of times or once more. A document is taken as far as its words lie in picked blocks.

Edge cases: a null text has size 0 and nothing of it is taken. Sources count in code-point order, a
null source last. With no words at all every target is 0. Equal rows share one place in the order, so
which of them is taken more does not change the result. Rows without a doc_id are spread by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from issuelens.llm.common import n_words, stored

WEIGHTS = (5, 2, 1)
BLOCK = 64
# Documents of a source go to shards of about this many, so that no shard grows with the corpus.
SHARD_DOCS = 20000


def drawn(seed: int, *parts: Column) -> Column:
    """Seeded 32-bit number of some columns; the same everywhere and in every run."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """(source, rank, docs, source_size, target) from rows (source, size); one row per source.

    A target is the smaller of ceiling * size and level * weight; the level is where all targets
    add up to `share` of all words.
    """
    sources = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    sources = sources.select("*", rank.alias("rank"), weight.alias("weight"), (ceiling * F.col("source_size")).alias("most"))
    # By rising limit per weight: those before the level stop at their limit, the rest share what is left by weight.
    order = W.orderBy(F.col("most") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    every = W.orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (share * F.sum("source_size").over(every) - before) / left
    sources = sources.withColumn("own", level)
    fits = F.when(F.col("own") * F.col("weight") <= F.col("most"), F.col("own"))
    sources = sources.withColumn("level", F.coalesce(F.max(fits).over(every), F.lit(0.0)))
    target = F.least(F.col("most"), F.col("level") * F.col("weight"))
    return sources.select("source", "rank", "docs", "source_size", target.alias("target"))


def apportion(parts: DataFrame, of: list[str], votes: str, name: str) -> DataFrame:
    """Adds the seats of each part in its group: the column `seats` of the group goes to the parts by highest
    quotients votes / (2 s + 1). `name` tells the parts of a group apart and settles equal quotients.

    A part's seats differ from its exact share by at most its share of the group's roundings, so only
    quotients near the share are ranked: linear in the number of parts.
    """
    group = W.partitionBy(*of)
    everything = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total, k = F.sum(votes).over(everything), F.count(F.lit(1)).over(everything)
    parts = parts.withColumn("_share", F.when(total > 0, F.col(votes) / total).otherwise(0.0)).withColumn("_k", k)
    near = F.floor(F.col("_share") * F.col("seats")).cast("long")
    slack = 2 + F.ceil(F.col("_share") * F.col("_k") / 2).cast("long")
    parts = parts.withColumn("_low", F.greatest(near - slack, F.lit(0))).withColumn("_high", near + slack)
    sure = parts.withColumn("_open", F.col("seats") - F.sum("_low").over(everything))
    ranked = sure.where(F.col(votes) > 0).select(*of, name, "_open", votes, F.explode(F.sequence("_low", "_high")).alias("_s"))
    order = group.orderBy(F.desc(F.col(votes) / (2 * F.col("_s") + 1)), name, "_s")
    won = ranked.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= F.col("_open"))
    won = won.groupBy(*of, name).agg(F.count(F.lit(1)).alias("_won"))
    quota = (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("quota")
    return sure.join(won, [*of, name], "left").select(*parts.columns[:-4], quota)


def words_before(place: str) -> Column:
    """Taken words before a place on its line, in whole numbers: block b is taken
    ((b + 1) * picked + offset) div blocks - (b * picked + offset) div blocks times."""
    block = f"({place} * blocks div line)"
    picks = f"(({block} * picked + offset) div blocks)"
    after = f"((({block} + 1) * picked + offset) div blocks)"
    return F.expr(f"(line * {picks} + ({after} - {picks}) * ({place} * blocks - {block} * line)) div blocks")


def mix_sources(docs: DataFrame, share: float = 1.5, ceiling: float = 2.0, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted), one row per document."""
    sizes = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    sources = source_targets(sizes, share, ceiling).withColumn("all", F.lit(0))
    seats = F.round(F.sum("target").over(W.partitionBy("all")) / BLOCK).cast("long")
    sources = stored(apportion(sources.withColumn("seats", seats), ["all"], "target", "rank").drop("seats", "all"), "sources")
    rows = sizes.join(sources, sizes.source.eqNullSafe(sources.source)).drop(sources.source)
    shards = F.ceil(F.col("docs") / SHARD_DOCS).cast("long")
    rows = rows.withColumn("shard", F.pmod(drawn(seed, F.col("doc_id"), F.col("size")), shards))
    lines = rows.groupBy("rank", "shard").agg(F.sum("size").alias("line"), F.first("quota").alias("seats"))
    lines = apportion(lines, ["rank"], "line", "shard")
    blocks = F.greatest(F.round(F.col("line") / BLOCK).cast("long"), F.lit(1))
    lines = lines.select("rank", "shard", "line", blocks.alias("blocks"), F.least("quota", (ceiling * blocks).cast("long")).alias("picked"))
    lines = lines.withColumn("offset", F.pmod(drawn(seed + 1, F.col("rank"), F.col("shard")), F.col("blocks")))
    rows = rows.join(lines, ["rank", "shard"])
    order = W.partitionBy("rank", "shard").orderBy(drawn(seed + 2, F.col("doc_id"), F.col("size")), "doc_id", "size")
    rows = rows.withColumn("end", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("begin", F.col("end") - F.col("size")).withColumn("line", F.greatest("line", F.lit(1)))
    return rows.select("doc_id", "size", "source_size", "target", (words_before("end") - words_before("begin")).alias("taken"))
