"""Parquet record store and shard union.

The canonical store is Parquet (columnar, pushdown, splittable); JSON Lines
is the export/exchange format. Generators that write the same record shape
are drop-in for each other, so shards are combined by name with bag
semantics -- no de-duplication.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

#: Write options under which a task's file is in place as soon as the task ends (one
#: rename, to the same name if the task runs again), and not with the whole job.
BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: tuple[str, ...] = (),
                long_text: tuple[str, ...] = (), compression: str | None = None, **options) -> None:
    """Parquet write. ``long_text`` columns (prompts, replies) skip the
    dictionary attempt: long, mostly distinct strings always fall back to
    plain encoding, so trying costs CPU for nothing. ``compression`` names
    the codec (e.g. ``zstd`` for text-heavy tables)."""
    w = df.write.mode(mode).options(**options)
    if compression:
        w = w.option("compression", compression)
    for c in long_text:
        if c in df.columns:
            w = w.option(f"parquet.enable.dictionary#{c}", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def union_shards(*shards: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing from a shard is null."""
    if not shards:
        raise ValueError("no shards")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def exists(spark, path: str) -> bool:
    """Whether ``path`` is there, asked of its own file system: any other
    error (permission, network) is raised, not taken for an absent path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def committed(spark, path: str) -> bool:
    """Whether a table was written to its end (its commit marker is there)."""
    return exists(spark, f"{path}/_SUCCESS")


def has_files(spark, path: str) -> bool:
    """Whether a folder holds data files: those of a job that did not end too."""
    if not exists(spark, path):
        return False
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return any(f.isFile() and not f.getPath().getName().startswith(("_", ".")) for f in found)
