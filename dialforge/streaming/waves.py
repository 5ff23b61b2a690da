"""Wave-by-wave generation as a checkpointed streaming query.

The batch pipeline appends each generated record as it goes and, on restart,
resumes after what is already written. Structured Streaming gives the same
durability without a hand-written loop:

- the stored plan (Parquet files) is the source; ``maxFilesPerTrigger``
  sets the wave size, ``trigger(availableNow=True)`` drains what exists
  and stops;
- the checkpoint (in the shared folder) records which plan files each
  micro-batch took, so a restarted query continues with the next wave;
- ``foreachBatch`` shapes requests, calls the backend through
  ``mapInArrow`` and writes the wave to ``results/wave=<batch_id>`` with
  overwrite, so a micro-batch replayed after a crash replaces its own
  output instead of duplicating it (exactly-once files; the backend calls
  themselves stay at-least-once).

Append new plan files to the plan folder and run again: only the new files
are generated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialforge.operators import generation as gen


def write_plan_files(plan: DataFrame, path: str, files: int, mode: str = "append") -> None:
    """Store a plan as ``files`` slot-ordered files, each one unit of a wave
    (range partitioning from a sample, sorted within files; no global sort)."""
    (plan.repartitionByRange(max(1, files), "slot_id").sortWithinPartitions("slot_id")
     .write.mode(mode).parquet(path))


def generate_stream(spark: SparkSession, plan_path: str, results_path: str,
                    checkpoint: str, call: gen.Call, files_per_wave: int = 1,
                    concurrency: int | None = None, partitions: int | None = None,
                    models: dict | None = None):
    """Run generation over every plan file not yet processed; blocks until
    the available files are drained. Returns the finished query handle."""
    schema = spark.read.parquet(plan_path).schema
    source = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_wave)
              .parquet(plan_path))
    parts = partitions or spark.sparkContext.defaultParallelism

    def run_wave(batch: DataFrame, batch_id: int) -> None:
        # a wave is a few files: spread it over the generation tasks
        plan = batch.drop("variation", "detail", "base_prompt").repartition(parts, "slot_id")
        shaped = gen.shape_request(plan, models=models).drop("request")
        out = gen.bulk_generate(shaped, call, concurrency=concurrency)
        # same stored shape as the batch job: text and verdict parsed once,
        # the raw body kept only for failures
        out = gen.extract_response(out).withColumn(
            "raw", F.when(F.col("error").isNotNull(), F.col("raw")))
        out.write.mode("overwrite").parquet(f"{results_path}/wave={batch_id}")

    q = (source.writeStream.foreachBatch(run_wave)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


def read_wave_results(spark: SparkSession, results_path: str) -> DataFrame:
    """All waves' results (``text``, ``error``, ``wave`` kept)."""
    res = spark.read.parquet(results_path)
    if "text" not in res.columns:
        res = gen.extract_response(res)
    return res.withColumn("wave", F.col("wave").cast("long"))
