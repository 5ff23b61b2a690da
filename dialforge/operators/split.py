"""Exact-size seeded train/eval split and the epoch batch manifest.

Split rule: ``n_eval = ceil(eval_share * n)`` rows with the smallest draw
``u(seed, id, "split")`` (ties broken by id) are ``eval``; the rest are
``train``. It is exact in size, not stratified, and independent of the
partitioning. The full rows are never shuffled (see ``rank.flag_smallest``).

Manifest: per epoch ``e`` every row gets a position by the draw
``u(seed, id, "epoch:e")`` (a reshuffle per epoch); ``micro_batch`` and
``step`` follow from the position, the batch size and the accumulation. The
permuted manifest ranks the ids once and permutes the ranks in every epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialforge.functions.draw import u
from dialforge.functions.permute import permuted
from dialforge.operators.rank import exact_rank, flag_smallest

# Eval share 0.05 and seed 42 of the split; 5 epochs, 4 rows per
# micro-batch and 4 micro-batches per optimiser step of the batch manifest.
EVAL_SHARE = 0.05
SPLIT_SEED = 42
EPOCHS = 5
MICRO_BATCH = 4
ACCUMULATION = 4


def assert_unique(df: DataFrame, id_col: str) -> None:
    """Raise if ``id_col`` repeats (a partial count per id; one shuffle of
    the id column only). Exact sizes and reproducible order need unique ids."""
    dup = (df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"{id_col} is not unique: {dup[0][id_col]!r} occurs {dup[0]['_n']} times")


def train_eval_split(df: DataFrame, id_col: str, seed: int = SPLIT_SEED,
                     eval_share: float = EVAL_SHARE, out: str = "split",
                     check_unique: bool = False) -> DataFrame:
    """Add ``out`` in {``train``, ``eval``}; exactly ``ceil(share*n)`` eval
    rows when ids are unique (``check_unique`` verifies it first)."""
    if check_unique:
        assert_unique(df, id_col)
    h = "_split_h"
    flagged = flag_smallest(df.withColumn(h, u(seed, id_col, "split")), h, id_col,
                            share=eval_share, out="_is_eval")
    return (flagged.withColumn(out, F.when(F.col("_is_eval"), "eval").otherwise("train"))
            .drop(h, "_is_eval"))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))


def batch_manifest(df: DataFrame, id_col: str, epochs: int = EPOCHS,
                   micro_batch: int = MICRO_BATCH, accumulation: int = ACCUMULATION,
                   seed: int = SPLIT_SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (epoch, record): ``position`` (0-based within the epoch),
    ``micro_batch`` and ``step``. Every record appears once per epoch.

    The epoch fan-out is a generator (``explode(sequence)``), not a join; the
    ranking is the bucketed exact rank partitioned by epoch.
    """
    if epochs < 1 or micro_batch < 1 or accumulation < 1:
        raise ValueError("epochs, micro_batch and accumulation must be >= 1")
    rows = df.select(id_col, *keep).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    h = "_man_h"
    rows = rows.withColumn(h, u(seed, id_col, F.concat(F.lit("epoch:"), F.col("epoch"))))
    ranked = exact_rank(rows, h, id_col, parts=["epoch"], out="_pos1")
    pos = F.col("_pos1") - 1
    return (ranked.withColumn("position", pos)
            .withColumn("micro_batch", F.floor(pos / micro_batch).cast("long"))
            .withColumn("step", F.floor(pos / (micro_batch * accumulation)).cast("long"))
            .drop(h, "_pos1"))


def permuted_manifest(df: DataFrame, id_col: str, epochs: int = EPOCHS, micro_batch: int = MICRO_BATCH,
                      accumulation: int = ACCUMULATION, seed: int = SPLIT_SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of :func:`batch_manifest`, with the ids ranked once: an epoch's
    position is a keyed permutation of the rank (``functions.permute``), computed row
    by row, so nothing is shuffled by epoch. The rows are counted first."""
    if epochs < 1 or micro_batch < 1 or accumulation < 1:
        raise ValueError("epochs, micro_batch and accumulation must be >= 1")
    n = max(df.count(), 1)
    h = "_man_h"
    ranked = exact_rank(df.select(id_col, *keep).withColumn(h, u(seed, id_col, "manifest")), h, id_col, out="_rank1")
    places = F.array(*[F.struct(F.lit(e).alias("epoch"), permuted(F.col("_rank1") - 1, n, seed, f"epoch:{e}").alias("position"))
                       for e in range(epochs)])
    rows = ranked.select(id_col, *keep, F.explode(places).alias("_at"))
    pos = F.col("_at.position")
    return rows.select(id_col, *keep, "_at.epoch", pos.alias("position"), F.floor(pos / micro_batch).cast("long").alias("micro_batch"),
                       F.floor(pos / (micro_batch * accumulation)).cast("long").alias("step"))


def write_positions(manifest: DataFrame, path: str, rows: int, epochs: int = EPOCHS, rows_per_file: int = 1 << 20,
                    mode: str = "overwrite") -> None:
    """Ordered shards of a manifest of ``rows`` records: the positions of an epoch
    are known to be ``0 .. rows-1``, so files are cut at known positions, without
    sampling (which would rank the rows twice)."""
    files = max(-(-rows // rows_per_file), 1)
    width = max(-(-rows // files), 1)
    part = (F.col("epoch") * files + F.floor(F.col("position") / width)).cast("int")
    (manifest.repartitionById(files * epochs, part).sortWithinPartitions("epoch", "position")
     .write.mode(mode).partitionBy("epoch").parquet(path))


def write_manifest(manifest: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Ordered shards where the number of rows is not known: range-partitioned by (epoch, step), sorted inside, so a
    reader streams each epoch's steps in order file by file."""
    (manifest.repartitionByRange("epoch", "step")
     .sortWithinPartitions("epoch", "position")
     .write.mode(mode).partitionBy("epoch").parquet(path))
