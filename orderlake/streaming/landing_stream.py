"""T1 as Structured Streaming: new files under the raw root are picked up
by the ``binaryFile`` file-stream source (content column pruned) and each
micro-batch runs the same landing decision function.

Exactly-once effect: every micro-batch writes its decisions into a
``batch_id=N`` partition with dynamic overwrite, so a replayed batch replaces
its own output instead of appending twice. The registry is the batch gate's
own: what either has validated the other knows, and the daily run reads it.
A replayed batch finds its own paths there and decides as before.

Caveat: the file source remembers paths; a file re-dropped under the same
path with new bytes is not delivered again. The batch form
(``plans.landing.run_landing``) on the same registry covers that case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import landing as LG
from ..sinks.parquet import path_exists

# The fixed schema of the binaryFile source (streams need it up front).
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length long, "
                      "content binary")


def start_landing_stream(spark: SparkSession, raw_root: str, decisions_path: str,
                         registry_path: str, checkpoint: str,
                         available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    listing = reader.load(raw_root).select("path", "length", "modificationTime")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        decisions = LG.landing_decisions(s, batch, raw_root, LG.read_versions(s, registry_path))
        (decisions.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(decisions_path))
        mine = f"{decisions_path.rstrip('/')}/batch_id={batch_id}"
        if path_exists(s, mine):                      # not for a batch without any Parquet file
            LG.update_registry(s, registry_path, s.read.schema(decisions.schema).parquet(mine))

    w = (listing.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
