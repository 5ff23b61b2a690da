"""Written intermediate tables in the cluster's shared folder: they cut lineage,
and a lost executor costs no recomputation of what they hold."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dialforge.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    trim()
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession, items: int = 0, per_task: int = 1 << 21) -> int:
    """The session's number of shuffle partitions, or more if a task would
    otherwise hold over ``per_task`` items."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-items // per_task))


TEXT_ROWS = 512         # rows of an Arrow batch that holds whole texts


def text_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python workers in small batches: the
    default of 10,000 rows can be hundreds of MB of long documents."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > TEXT_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(TEXT_ROWS))


def trim() -> None:
    """Hand freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def lean(body):
    """A task body that hands freed memory back to the system at its end:
    workers live on, and what each keeps in reserve counts for the executor."""
    def run(batches):
        try:
            yield from body(batches)
        finally:
            trim()
    return run


def map_arrow(df: DataFrame, body, schema: str) -> DataFrame:
    """``df.transform(map_arrow, body, schema)``: mapInArrow with a lean body."""
    return df.mapInArrow(lean(body), schema)
