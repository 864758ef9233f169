"""Exact top-k by inner product: a Voronoi join of queries and data.

Vectors become whole numbers floor(SCALE * x). Adding the coordinate sqrt(M - |x|^2) to data and 0 to
queries, M the largest squared norm, makes the largest inner product the nearest neighbour. Every row
goes to the cell of its nearest pivot. A few numbers per cell (radius, the smallest pivot distances) bound how
far the k-th neighbour of any query of a cell can be; by the triangle inequality only data whose pivot
distance lies in a cell's range can matter to it, and only those are sent. Each group of queries meets the
data sent to it in blocks of bounded size, solved locally; the blocks' best are merged.

Ties go to the smaller id. Bounds carry a margin for rounding; scores are exact integers.

Edge cases: a null vector, one with a null or non-finite component, or a null vec_id takes no part; nor does one with
a component beyond 1e150. Vectors may differ in length, and be of any length: missing components count as 0. Rows that share
a vec_id are candidates of their own, none of them for its own id; several queries of one id give one ranking of all
their scores. Ranks follow the exact scores; a score beyond 64 bits is then shown as the largest or smallest number of 64
bits. Columns other than vec_id and embedding are not looked at. Fewer than k candidates are all returned; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from issuelens.llm.common import stored

SCALE = 256
# Rows of one id up to which bounds are made from the smallest distances.
MOST_OWN = 64
# Larger components would overflow the squares that the bounds are made of.
MOST = 1e150
# Pivots: the rows with the smallest id hashes; a bounded sample.
PIVOTS = 32
# Queries of one group and data rows of one block, which bound a task.
GROUP_QUERIES = 1024
BLOCK_ROWS = 16384
SLICE = 64


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): usable rows as whole numbers, held as doubles: 256 times a float or double is exact, and so is its floor."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > MOST))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    # floor() gives a long; numbers from 2 ** 52 on are whole as they are.
    whole = F.transform(
        "embedding",
        lambda x: F.when(F.abs(SCALE * x.cast("double")) < 2.0**52, F.floor(SCALE * x.cast("double")).cast("double")).otherwise(SCALE * x.cast("double")),
    )
    return rows.select(F.col("vec_id").cast("long"), whole.cast("array<double>").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def _distances(rows: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    full = np.concatenate((rows.astype(np.float64), extra[:, None]), axis=1)
    return np.sqrt(np.maximum(((full[:, None, :] - pivots[None]) ** 2).sum(axis=2), 0))


def _assign(pivots: np.ndarray, largest: float, is_query: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = _matrix(batch.column("v"), pivots.shape[1] - 1)
                norms = (rows.astype(np.float64) ** 2).sum(axis=1)
                extra = np.zeros(len(rows)) if is_query else np.sqrt(np.maximum(largest - norms, 0))
                far = _distances(rows, extra, pivots)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(rows)), cell])],
                    names=["vec_id", "v", "cell", "far"],
                )

    return apply


PLACED = "vec_id long, v array<double>, cell int, far double"


def ranges(queries: list, data: list, pivots: np.ndarray, enough: int | None) -> list[tuple[int, int, float, float]]:
    """(query cell, data cell, least, most): the pivot distances of a data cell that a query cell needs.

    `queries` has (cell, radius), `data` (cell, smallest distances). Among `enough` rows there are k that a query may
    have; without that number everything is needed.
    """
    between = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2))
    out = []
    for i, radius in queries:
        # Any query of the cell has at least `enough` data rows (its own among them) within the smallest of these.
        within = sorted(radius + between[i, j] + d for j, smallest in data for d in smallest)[: enough or 0]
        reach = within[-1] if enough and len(within) == enough else float("inf")
        # Rounding errors are relative to the vectors' size, not to their distances.
        margin = 1e-6 * (1 + reach + float(np.abs(pivots).max(initial=0))) if reach < float("inf") else 0.0
        for j, _ in data:
            least = between[i, j] - radius - reach - margin
            most = between[i, j] + radius + reach + margin
            out.append((i, j, float(least), float(most)))
    return out


def _beyond(score: int) -> str | None:
    """Null for a number of 64 bits; for others a text, and texts are ordered as the numbers are."""
    if -(2**63) < score < 2**63 - 1:
        return None
    digits = str(abs(score))
    if score > 0:
        return f"{len(digits):04d}{digits}"
    return f"{9999 - len(digits):04d}" + "".join(str(9 - int(d)) for d in digits)


def _solve(k: int):
    def apply(key: tuple, queries: pa.Table, data: pa.Table) -> pa.Table:
        width = max([0, *(len(v) for t in (queries, data) for v in t.column("v"))])
        ids, order = data.column("vec_id").to_numpy(), np.argsort(data.column("vec_id").to_numpy(), kind="stable")
        rows = _matrix(data.column("v").combine_chunks(), width)[order]
        ids = ids[order]
        asked, ask = queries.column("vec_id").to_numpy(), _matrix(queries.column("v").combine_chunks(), width)
        # Products of doubles are exact as long as every sum stays below 2 ** 53.
        most = float(np.abs(rows).max(initial=0)) * float(np.abs(ask).max(initial=0)) * max(width, 1)
        if most < 2**53:
            kind = np.int64
        elif most < 2**62:
            kind, rows, ask = np.int64, rows.astype(np.int64), ask.astype(np.int64)
        else:
            # Whole numbers of any size.
            whole = np.frompyfunc(int, 1, 1)
            kind, rows, ask = object, whole(rows), whole(ask)
        out_q, out_v, out_s = [], [], []
        for at in range(0, len(ask) if len(ids) else 0, SLICE):
            scores = (ask[at : at + SLICE] @ rows.T).astype(kind)
            for q, line in zip(asked[at : at + SLICE], scores):
                own = ids != q
                left = line if own.all() else line[own]
                names = ids if left is line else ids[own]
                if not len(left):
                    continue
                floor = np.sort(left)[-min(k, len(left))] if kind is object else np.partition(left, len(left) - min(k, len(left)))[len(left) - min(k, len(left))]
                best = np.flatnonzero(left >= floor)
                # Ids ascend, so a stable sort leaves ties with the smaller id first.
                best = best[np.argsort(-left[best], kind="stable")][:k]
                out_q.append(np.full(len(best), q)), out_v.append(names[best]), out_s.append(left[best])
        columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, dtype=np.int64) for c in (out_q, out_v)]
        scores = np.concatenate(out_s).tolist() if out_s else []
        shown = pa.array([max(-(2**63), min(2**63 - 1, x)) for x in scores], pa.int64())
        return pa.table([*map(pa.array, columns), shown, pa.array(map(_beyond, scores), pa.string())], names=["query_id", "vec_id", "score", "beyond"])

    return apply


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of `vectors` for each row of `queries` (vec_id, embedding), never its own id."""
    data = stored(whole_vectors(vectors), "vectors")
    asked = stored(whole_vectors(queries), "queries")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    # A query may not have the rows of its own id.
    own = data.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    enough = k + own if own and own <= MOST_OWN else None
    n, largest, width, asked_width = (
        *data.agg(F.count(F.lit(1)), F.max(squares), F.max(F.size("v"))).first(),
        asked.agg(F.max(F.size("v"))).first()[0],
    )
    empty = "query_id long, rank int, vec_id long, score long"
    if not n or asked_width is None:
        return data.sparkSession.createDataFrame([], empty)
    width = max(width, asked_width)
    first = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    pivots = np.zeros((len(first), width + 1))
    for r, row in enumerate(first):
        pivots[r, : len(row.v)] = row.v
        pivots[r, width] = np.sqrt(max(largest - (pivots[r, :width] ** 2).sum(), 0))
    data = stored(data.mapInArrow(_assign(pivots, largest, False), PLACED), "placed")
    asked = stored(asked.mapInArrow(_assign(pivots, largest, True), PLACED), "asked")

    nearest = W.partitionBy("cell").orderBy("far", "vec_id")
    smallest = data.select("cell", "far", F.row_number().over(nearest).alias("r")).where(F.col("r") <= (enough or 1))
    summaries = [(row.cell, sorted(row.d)) for row in smallest.groupBy("cell").agg(F.collect_list("far").alias("d")).collect()]
    radii = [(row.cell, row.r, row.n) for row in asked.groupBy("cell").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n")).collect()]
    needed = data.sparkSession.createDataFrame(
        [(*x, -(-m // GROUP_QUERIES)) for i, r, m in radii for x in ranges([(i, r)], summaries, pivots, enough)],
        "query_cell int, cell int, least double, most double, groups long",
    )
    # At most PIVOTS * PIVOTS rows.
    sent = data.join(F.broadcast(needed), "cell").where("far BETWEEN least AND most")
    blocks = -(-n // BLOCK_ROWS)
    sent = sent.select("vec_id", "v", "query_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"))
    sent = sent.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    sizes = F.broadcast(needed.select(F.col("query_cell").alias("cell"), "groups").distinct())
    asked = asked.join(sizes, "cell").select("vec_id", "v", F.col("cell").alias("query_cell"), F.pmod(F.xxhash64("vec_id"), F.col("groups")).alias("part"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["query_cell", "part", "block"]
    solved = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(_solve(k), "query_id long, vec_id long, score long, beyond string")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = solved.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
