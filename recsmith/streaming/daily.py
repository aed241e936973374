"""Daily runs over a landing folder (re-aim of the generation-based daily jobs).

The customer jobs run once a day over the extracts that landed since the
previous run and write a new generation of their output. Structured
Streaming gives exactly that with an ``availableNow`` trigger:

* the file source remembers (in the streaming checkpoint) which files were
  processed, so every landed file is processed exactly once, even across
  restarts and lost executors;
* ``foreachBatch`` applies an ordinary batch plan (any function of
  DataFrames from ``recsmith.plans``) to the newly landed rows;
* without a rate limit an ``availableNow`` run is one micro-batch, so a run
  writes one generation, ``generation=<batch id>``, and a plan's dedups see the
  whole run; re-running it after a failure overwrites the same folder;
* the streaming checkpoint belongs to the job, not to an application, so the
  caller must name its folder.

No operator is added: this is a driver for the existing plans.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, source_dir: str, schema, plan: Callable[[DataFrame], DataFrame],
                  sink_dir: str, checkpoint: str, fmt: str = "parquet", glob: str | None = None) -> None:
    """Process every file landed in ``source_dir`` since the last run, then stop."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.load(source_dir)

    def write_generation(batch: DataFrame, batch_id: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{sink_dir}/generation={batch_id}")

    query = (stream.writeStream.foreachBatch(write_generation)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
