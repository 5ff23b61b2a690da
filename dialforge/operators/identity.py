"""Ids of records that bring none: a hash of the content and, for records that
repeat, the number of the copy. Copies are alike, so which one gets which number
does not matter: the ids, and every draw made from them, are the same however the
rows are laid out in files and partitions.

Numbering the copies takes no task all copies of a record. A scan numbers them
within each stretch of rows it holds and writes that down; the counts of a record
by stretch, summed up in order, say where each stretch goes on. Only records met in
several stretches need that sum, so the rows themselves are not shuffled while the
table of those is small enough to be broadcast (Spark decides by its size).
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialforge.session import scratch_path
from dialforge.sources import store

KEYS_HELD = 1 << 18     # distinct records of a stretch


def _part(c) -> Column:
    """A value with its length before it, so that joined values stay apart; ``-`` for null."""
    return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def record_content(messages: str = "messages", category: str | None = "category") -> Column:
    """A record as one string, different for different records."""
    turns = F.array_join(F.transform(F.col(messages), lambda m: F.concat(_part(m["role"]), _part(m["content"]))), "")
    return F.concat(*([_part(F.col(category))] if category else []), F.coalesce(turns, F.lit("-")))


def content_key(content: Column) -> Column:
    return F.sha2(content, 256)


def _stretches(schema: T.StructType, key: str, held: int):
    place = schema.fieldNames().index(key)

    def run(batches):
        import pyarrow as pa

        seen: dict = {}
        stretch = TaskContext.get().partitionId() << 24
        for rb in batches:
            local, stretches = [], []
            for k in rb.column(place).to_pylist():
                if len(seen) >= held and k not in seen:
                    seen, stretch = {}, stretch + 1
                n = seen.get(k, 0)
                seen[k] = n + 1
                local.append(n)
                stretches.append(stretch)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(stretches, pa.int64()), pa.array(local, pa.int64())],
                                             names=[*rb.schema.names, "_stretch", "_local"])
    return run


def number_copies(df: DataFrame, key: str, out: str = "copy", held: int = KEYS_HELD) -> DataFrame:
    """Add ``out``: 0, 1, ... for the rows of each ``key`` (null is a key). The
    rows are written once, to the shared folder, with their places."""
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("_stretch", T.LongType()), T.StructField("_local", T.LongType())])
    path = scratch_path(spark, "numbered")
    store.write_table(df.mapInArrow(_stretches(df.schema, key, held), schema), path)
    rows = spark.read.schema(schema).parquet(path)
    counts = rows.groupBy(key, "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1))
    later = counts.withColumn("_before", before).where(F.col("_before") > 0).select(
        F.col(key).alias("_key"), F.col("_stretch").alias("_at"), "_before")
    joined = rows.join(later, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_stretch") == F.col("_at")), "left")
    return joined.withColumn(out, F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_stretch", "_local", "_key", "_at", "_before")


def with_record_id(df: DataFrame, content: Column, own: str | None = None, out: str = "record_id", held: int = KEYS_HELD) -> DataFrame:
    """Add ``out``: the row's ``own`` id where it has one, else the hash of its
    content and the number of its copy."""
    key = content_key(content)
    if own is not None:
        key = F.coalesce(F.concat(F.lit("id "), F.col(own).cast("string")), key)
    numbered = number_copies(df.withColumn("_content", key), "_content", "_copy", held)
    made = F.concat_ws("-", "_content", "_copy")
    if own is not None:     # an id that repeats is numbered too, from its second row on
        id_ = F.col(own).cast("string")
        made = F.when(id_.isNull(), made).when(F.col("_copy") == 0, id_).otherwise(F.concat_ws("-", id_, "_copy"))
    return numbered.withColumn(out, made).drop("_content", "_copy")
