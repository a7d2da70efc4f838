"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into ``lists`` ranges; a vector's partial inner product
over a range is its local score in that range's list.

1. Every partition gathers, for each query, the best entries of each local
   list, and sends the best totals among them. The k-th highest total over all
   partitions is a safe cutoff: the true k-th score is not lower.
2. The cutoffs are broadcast. A local score is at most the product of the two
   vectors' lengths in its range, so queries and rows of a chunk whose products
   do not add up to a cutoff are left out before any local score is computed.
   Of the others, a vector whose total reaches the cutoff has a local score of
   at least cutoff / lists in some list, so these entries are sufficient.
3. The totals of the collected entries are resolved exactly; what reaches the
   cutoff (at most k per partition) is ranked, ties to the smaller id.

Local scores are not kept between the phases: queries times rows are more than
the vectors themselves. What the lengths don't rule out is computed twice.

Queries come in blocks of bounded size against all rows; each block's matrix
is broadcast, its best rows are written, and the broadcasts are released before
the next block. Vectors are cut into row chunks, so memory is bounded by block
times chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import written
from orderlake.session import scratch_dir

CHUNK = 1024
SALTS = 64
_LEAST = -(1 << 63)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` whole components, short vectors padded with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    if len(flat):
        within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        fits = within < dim
        out[np.repeat(np.arange(len(sizes)), sizes)[fits], within[fits]] = flat[fits]
    return out


def _most(m: np.ndarray) -> int:
    return max(int(m.max(initial=0)), -int(m.min(initial=0))) + 1


class Block:
    """One broadcast block of queries."""

    def __init__(self, ids: list[int], matrix: np.ndarray, lists: int):
        self.ids, self.matrix = np.array(ids, dtype=np.int64), matrix
        dim = matrix.shape[1]
        cuts = np.linspace(0, dim, min(lists, max(dim, 1)) + 1).astype(int).tolist()
        self.ranges = list(zip(cuts[:-1], cuts[1:], strict=True))
        self.most, self.real = _most(matrix) * max(dim, 1), matrix.astype(np.float64)
        self.lengths = self.range_lengths(matrix)

    def range_lengths(self, rows: np.ndarray) -> np.ndarray:
        """Euclidean length of every row in every range."""
        real = rows.astype(np.float64)
        return np.stack([np.sqrt((real[:, a:b] ** 2).sum(axis=1)) for a, b in self.ranges], axis=1)

    def local_lists(self, rows: np.ndarray, asked=slice(None)) -> list[np.ndarray]:
        """The local scores (queries x rows) of every range: whole numbers,
        as float64 where its sums are exact, else as Python numbers."""
        if self.most * _most(rows) < 2 ** 53:
            real, mine = rows.astype(np.float64), self.real[asked]
            return [mine[:, a:b] @ real[:, a:b].T for a, b in self.ranges]
        mine = self.matrix[asked]
        return [mine[:, a:b].astype(object) @ rows[:, a:b].T.astype(object) for a, b in self.ranges]

    def reachable(self, rows: np.ndarray, floor: np.ndarray):
        """(queries, rows) of which some pair may reach the query's floor, by
        the lengths; rounding is allowed for."""
        lengths = self.range_lengths(rows)
        asked = np.flatnonzero(self.lengths @ lengths.max(axis=0, initial=0) * (1 + 1e-9) >= floor)
        bound = self.lengths[asked] @ lengths.T * (1 + 1e-9)
        return asked, np.flatnonzero((bound >= floor[asked, None]).any(axis=0))


def _chunks(batches: Iterator[pa.RecordBatch], dim: int):
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            yield part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), _matrix(part.column(1), dim)


def _phase_one(block, k: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        best = np.full((len(b.ids), k), float(_LEAST))
        for ids, rows in _chunks(batches, b.matrix.shape[1]):
            lists = b.local_lists(rows)
            n = min(len(ids), k + 1)  # one more, as the query's own row may be among them
            found = np.sort(np.concatenate([np.argpartition(-one, n - 1, axis=1)[:, :n] for one in lists], axis=1))
            total = np.take_along_axis(sum(lists), found, axis=1).astype(np.float64)
            # cut off as a long is, and round down beyond a float's whole numbers: the cutoff stays safe
            total = np.clip(total, float(_LEAST), -float(_LEAST))
            total = np.where(np.abs(total) < 2 ** 53, total, np.nextafter(total, -np.inf))
            again = np.zeros(found.shape, dtype=bool)
            again[:, 1:] = found[:, 1:] == found[:, :-1]
            total[again | (ids[found] == b.ids[:, None])] = _LEAST
            best = -np.sort(-np.concatenate([best, total], axis=1))[:, :k]
        keep = [[x for x in row if x > _LEAST] for row in best.tolist()]
        yield pa.record_batch({"query_id": pa.array(b.ids), "scores": pa.array(keep, pa.list_(pa.float64()))})
    return gather


def _phase_two(block, cutoffs, k: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        floor = np.array([cutoffs.value.get(int(q), float(_LEAST)) for q in b.ids])
        need = np.where(floor > _LEAST, floor / len(b.ranges), -np.inf)
        need = (need - 1e-9 * np.abs(np.where(np.isfinite(need), need, 0)))[:, None]
        best = [np.empty(0, np.int64)] * 3
        for ids, rows in _chunks(batches, b.matrix.shape[1]):
            asked, near = b.reachable(rows, floor)
            if not len(near):
                continue
            ids = ids[near]
            lists = b.local_lists(rows[near], asked)
            reach = np.zeros(lists[0].shape, dtype=bool)
            for one in lists:
                reach |= (one >= need[asked]).astype(bool)
            q, i = np.nonzero(reach)
            total = sum(one[q, i] for one in lists)  # phase three: exact totals of the collected
            q = asked[q]
            good = (total >= floor[q]).astype(bool) & (ids[i] != b.ids[q])
            q, i, total = q[good], i[good], total[good]
            if total.dtype == object:
                total = np.array([min(max(x, _LEAST), -1 - _LEAST) for x in total.tolist()], dtype=np.int64)
            best = [np.concatenate(x) for x in zip(best, (q, ids[i], total.astype(np.int64)), strict=True)]
            order = np.lexsort((best[1], ~best[2], best[0]))
            best = [x[order] for x in best]
            place = np.arange(len(order)) - np.searchsorted(best[0], best[0])
            best = [x[place < k] for x in best]
        yield pa.record_batch([b.ids[best[0]], best[1], best[2]], names=["query_id", "vec_id", "score"])
    return collect


def _best(found: DataFrame, k: int, *by) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _highest(lists: DataFrame, k: int, *by) -> DataFrame:
    return lists.groupBy(*by).agg(F.slice(F.sort_array(F.flatten(F.collect_list("scores")), asc=False), 1, k)
                                  .alias("scores"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 64, lists: int = 4, block_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest integer inner
    product for every query, ties to the smaller id; all rows if there are
    fewer. ``queries`` has the columns of ``vectors``.

    A component x counts as floor(scale * x). Rows with a null id, and vectors
    that are null or hold a null or non-finite component, take no part. Of
    vectors of unequal length the common part counts. Rows that repeat are
    candidates each; a query id that repeats is asked once, with its least
    vector. A row with the query's own id is no candidate. Totals outside a
    long are cut off at its ends. Extra columns are not read.
    """
    spark = vectors.sparkSession

    def whole(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
        return df.where(F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))).select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))

    rows = whole(vectors)
    asked = written(whole(queries).groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    about = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dim")).first()
    blocks = -(-about["n"] // block_rows)
    path, kinds = scratch_dir(spark, "topk-blocks"), "query_id long, rank int, vec_id long, score long"
    answered = []
    for i in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).collect()
        if not mine:
            continue
        matrix = np.zeros((len(mine), about["dim"]), dtype=np.int64)
        for r, row in enumerate(mine):
            matrix[r, :len(row["v"])] = row["v"]
        block = spark.sparkContext.broadcast(Block([r["id"] for r in mine], matrix, lists))
        local = rows.mapInArrow(_phase_one(block, k), "query_id long, scores array<double>").withColumn(
            "salt", F.spark_partition_id() % SALTS)
        ranked = _highest(_highest(local, k, "query_id", "salt"), k, "query_id").where(F.size("scores") == k)
        cutoffs = spark.sparkContext.broadcast({r["query_id"]: r["low"] for r in ranked.select(
            "query_id", F.col("scores")[k - 1].alias("low")).collect()})
        out = rows.mapInArrow(_phase_two(block, cutoffs, k), "query_id long, vec_id long, score long").withColumn(
            "salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
        _best(_best(out, k, "query_id", "salt").drop("rank"), k, "query_id").select(
            "query_id", "rank", "vec_id", "score").write.parquet(f"{path}/block={i}")
        answered.append(i)
        cutoffs.destroy()
        block.destroy()
    if not answered:
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(path).drop("block")
