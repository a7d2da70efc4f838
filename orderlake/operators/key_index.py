"""A persisted Bloom filter per day, so that a key opens only days that may hold it.

A day's filter is cut into blocks of 32,768 bits; a key sets its bits in the one
block that the leading bits of its hash name. A day has the least power of two
of blocks that gives its keys ``bits_per_key`` bits each, so filters follow the
days' sizes and a probe reads one block a day. Candidate keys meet the blocks by
(depth, block): a block comes with an array of its candidates and only the keys
whose bits are all set come out, so candidates are never paired with days as rows.

The index is partitioned by month. A merge takes its months out of the index
before it publishes and puts them back afterwards; days that the index lacks
(a merge that died, a day without keys) may hold any key. Every merge of the table
must keep the index; one that lies in the table's ``_key_index`` folder is kept
by all merges without being named.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sinks import parquet as sink
from ..sources.files import read_partitions, read_processed

MONTH = "index_month"
BLOCK_BITS = 32_768
#: Candidates that one row carries, and such rows to a join key.
CHUNK_KEYS, CHUNKS_PER_KEY = 4_096, 64


#: Where an index lies that is kept with its table; readers of the table skip it.
FOLDER = "_key_index"


def _block(key: Column, depth: Column) -> Column:
    """The leading ``depth`` bits of the key's hash."""
    shifted = F.call_function("shiftrightunsigned", F.xxhash64(key), (F.lit(64) - depth).cast("int"))
    return F.when(depth > 0, shifted).otherwise(F.lit(0).cast("long"))


def _signature(key: Column) -> Column:
    """30 bits of a second hash: a first position and an odd step."""
    return F.xxhash64(key, F.lit("signature")).bitwiseAND(F.lit((1 << 30) - 1))


def _first(signature: Column) -> Column:
    return signature.bitwiseAND(F.lit(BLOCK_BITS - 1))


def _step(signature: Column) -> Column:
    return F.shiftright(signature, 15).bitwiseOR(F.lit(1))


def _possible(hashes: int):
    """Places of the signatures whose bits are all set in the block."""
    @F.arrow_udf("array<int>")
    def possible(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        turns = np.arange(hashes)[:, None]
        for blocks, lists in batches:
            out = []
            for block, sigs in zip(blocks, lists, strict=True):
                bits = np.frombuffer(block.as_buffer(), dtype=np.uint8)
                sig = sigs.values.to_numpy(zero_copy_only=False)
                at = ((sig & (BLOCK_BITS - 1)) + turns * ((sig >> 15) | 1)) % BLOCK_BITS
                out.append(np.flatnonzero(((bits[at >> 3] >> (at & 7)) & 1).all(axis=0)).astype(np.int32))
            yield pa.array(out, pa.list_(pa.int32()))
    return possible


@dataclass(frozen=True)
class KeyIndex:
    """The index of one table on one key column.

    20 bits and 10 positions a key let about one key in 10,000 pass a day that
    does not hold it, fewer where the power of two leaves room. Null keys are
    not indexed. Keep both numbers for the life of an index."""
    root: str
    key: str = "order_id"
    day: str = "process_date"
    bits_per_key: int = 20
    hashes: int = 10

    def read(self, spark: SparkSession) -> DataFrame | None:
        """day, depth, block, bitmap; None before the first day."""
        if not sink.child_names(spark, self.root):
            return None
        return read_processed(spark, self.root).select(self.day, "depth", "block", "bitmap")

    def blocks(self, rows: DataFrame) -> DataFrame:
        """day, depth, block and bitmap of the days of ``rows``."""
        keys = rows.select(self.day, self.key).where(F.col(self.key).isNotNull() & F.col(self.day).isNotNull()).distinct()
        need = F.col("_keys") * F.lit(self.bits_per_key / BLOCK_BITS)
        depths = keys.groupBy(self.day).agg(F.count("*").alias("_keys")).select(
            self.day, F.greatest(F.lit(0), F.ceil(F.log2(need))).cast("int").alias("depth"))
        sig = _signature(F.col(self.key))
        keyed = keys.join(F.broadcast(depths), self.day).select(     # one row a day
            self.day, "depth", _block(F.col(self.key), F.col("depth")).alias("block"), _first(sig).alias("_first"), _step(sig).alias("_step"))
        turn = F.explode(F.sequence(F.lit(0), F.lit(self.hashes - 1)))
        bits = keyed.withColumn("_turn", turn).withColumn("_bit", (F.col("_first") + F.col("_turn") * F.col("_step")) % BLOCK_BITS)
        return bits.groupBy(self.day, "depth", "block").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))

    def begin(self, spark: SparkSession, days: list) -> DataFrame | None:
        """Takes the months of ``days`` out of the index; what it held of their
        other days, for ``finish``."""
        names = sorted({f"{MONTH}={str(d)[:7]}" for d in days} & set(sink.child_names(spark, self.root)))
        if not names:
            return None
        old = self.read(spark).withColumn(MONTH, F.date_format(self.day, "yyyy-MM")).where(
            F.col(MONTH).isin([n.split("=")[1] for n in names]) & ~F.col(self.day).cast("string").isin([str(d) for d in days]))
        stage = scratch_dir(spark, "index-kept")
        sink.write_stage(old, stage)
        for n in names:
            sink.delete_path(spark, f"{self.root}/{n}")
        return spark.read.schema(old.schema).parquet(stage)

    def finish(self, spark: SparkSession, table: str, days: list, kept: DataFrame | None = None) -> None:
        """The months of ``days`` back into the index: their days that ``kept``
        lacks are built from the table, the others stay. A repeat of begin and
        finish changes nothing."""
        months = {str(d)[:7] for d in days}
        have = {str(r[0]) for r in kept.select(self.day).distinct().collect()} if kept is not None else set()
        todo = [d for d in sink.partition_values(spark, table, self.day) if d[:7] in months and d not in have]
        new = self.blocks(read_partitions(spark, table, self.day, todo, listed=True)).withColumn(
            MONTH, F.date_format(self.day, "yyyy-MM"))
        if kept is not None:
            new = new.unionByName(kept)
        stage = scratch_dir(spark, "index-new")
        sink.write_stage(new, stage)
        sink.publish_partitions(spark, spark.read.schema(new.schema).parquet(stage), self.root, MONTH, ("depth", "block"))
        sink.delete_path(spark, stage)

    def rebuild(self, spark: SparkSession, table: str, days: list) -> None:
        self.begin(spark, days)
        self.finish(spark, table, days)

    def may_hold(self, candidates: DataFrame) -> DataFrame:
        """(day, key) of every indexed day that may hold a candidate key; no
        pair that holds is left out."""
        spark = candidates.sparkSession
        index = self.read(spark)
        if index is None:
            return spark.createDataFrame([], f"{self.day} date, {self.key} string")
        stage = scratch_dir(spark, "index-candidates")
        sink.write_stage(candidates.select(F.col(self.key).alias("_key")).where("_key IS NOT NULL").distinct(), stage)
        keys = spark.read.parquet(stage)
        count = keys.count()
        depths = sorted(r[0] for r in index.select("depth").distinct().collect())      # at most 64
        # how many chunks of candidates a block of each depth has, and over how many join keys they are dealt
        chunks = {d: max(1, -(-count // (CHUNK_KEYS << d))) for d in depths}
        salts = {d: -(-n // CHUNKS_PER_KEY) for d, n in chunks.items()}
        if not depths:
            return spark.createDataFrame([], f"{self.day} date, {self.key} string")

        def of_depth(values):
            return F.create_map(*[F.lit(x) for d in depths for x in (d, values[d])])[F.col("depth")]
        spread = F.pmod(F.xxhash64("_key", F.lit("chunk")), of_depth(chunks)).cast("int")
        packed = (keys.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths])))
                  .withColumns({"block": _block(F.col("_key"), F.col("depth")), "_chunk": spread})
                  .withColumn("_salt", F.col("_chunk") % of_depth(salts))
                  .groupBy("depth", "block", "_salt", "_chunk")
                  .agg(F.collect_list(F.struct("_key", _signature(F.col("_key")).alias("sig"))).alias("_keys")))
        blocks = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), of_depth(salts) - 1)))
        met = blocks.join(packed, ["depth", "block", "_salt"])
        found = met.withColumn("_at", _possible(self.hashes)("bitmap", F.col("_keys.sig")))
        return found.select(self.day, F.explode(F.transform("_at", lambda i: F.col("_keys._key")[i])).alias(self.key))

    def days_to_open(self, table: str, candidates: DataFrame, but: list = ()) -> list[str]:
        """Days of the table that may hold a candidate key or that the index
        lacks; those of ``but`` left out. A list of days, of any number of keys."""
        spark = candidates.sparkSession
        index = self.read(spark)
        known = {str(r[0]) for r in index.select(self.day).distinct().collect()} if index is not None else set()
        hit = {str(r[0]) for r in self.may_hold(candidates).select(self.day).distinct().collect()}
        skip = {str(d) for d in but}
        return [d for d in sink.partition_values(spark, table, self.day) if d not in skip and (d in hit or d not in known)]

    def held_elsewhere(self, table: str, candidates: DataFrame, but: list = ()) -> DataFrame:
        """Exact (day, key) of the table's days outside ``but`` that hold a key
        of ``candidates``: of the days to open the key column is read and joined."""
        spark = candidates.sparkSession
        days = self.days_to_open(table, candidates, but)
        rows = read_partitions(spark, table, self.day, days, listed=True).select(self.day, self.key)
        return rows.join(candidates.select(self.key).distinct(), self.key, "left_semi").select(self.day, self.key).distinct()


def of_table(spark: SparkSession, table: str, create: bool = False) -> KeyIndex | None:
    """The index kept with a table, None where there is none. ``create``: the
    index to start one with; days from before are opened until ``rebuild``."""
    root = f"{table.rstrip('/')}/{FOLDER}"
    return KeyIndex(root) if create or sink.path_exists(spark, root) else None
