"""Weighted and uniform draws with replacement, as joins.

Weighted category draw
    Each category ``c`` owns the slot range ``[lo_c, hi_c)`` of the running
    sum of weights (ordered by ``order``); a plan row draws
    ``s = u(seed, key, tag) mod W`` and takes the category whose range holds
    ``s``. A range predicate alone plans as a nested-loop join, so slots are
    grouped into at most ``bins`` equal-width bins and the lookup is an
    equi-join on the bin plus a range filter. The bin table has at most
    ``bins + k`` rows (k categories) whatever the total weight, so its size is
    known before it is broadcast; when ``W <= bins`` each bin is one slot (the
    plain replicated-slot table).

Uniform draw from a pool
    Short lists (catalogue prompts, suffixes) are arrays: ``element_at``.
    Large pools (a table) are indexed 0..n_c-1 inside each category by the
    bucketed exact rank (no hot category in one task), and a plan row joins
    on ``(category, u mod n_c, salt)``; a category gets salts by its number of
    draws, so a popular one with few items cannot create a hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialforge.functions.draw import u
from dialforge.operators.rank import exact_rank_with_sizes
from dialforge.session import scratch_path
from dialforge.sources.catalog import validate_weights

DEFAULT_BINS = 1 << 16
BROADCAST_ROWS = 2_000_000  # rows of (bin, category, lo, hi) safe to broadcast
DRAWS_PER_KEY = 10_000  # draws that one (item, salt) key takes on average


def category_bounds(weights: DataFrame, category: str = "category", weight: str = "weight",
                    order: str | None = None) -> DataFrame:
    """``(category, lo, hi)``: slot range of each category of a table written
    by :func:`_once`. The running sum is taken inside each range partition of
    it, above the sums of the partitions before; no task sees all categories.
    Zero-weight categories get an empty range and are dropped.
    """
    live = weights.where(F.col(weight) > 0).withColumn("_wd_w", F.col(weight).cast("long"))
    inside = (Window.partitionBy("_wd_part").orderBy(order or category, category)
              .rowsBetween(Window.unboundedPreceding, 0))
    before = Window.orderBy("_wd_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (live.groupBy("_wd_part").agg(F.sum("_wd_w").alias("_wd_n"))
             .select("_wd_part", F.coalesce(F.sum("_wd_n").over(before), F.lit(0)).alias("_wd_off")))
    hi = F.col("_wd_off") + F.sum("_wd_w").over(inside)
    return (live.join(parts, "_wd_part").withColumn("hi", hi)
            .select(category, (F.col("hi") - F.col("_wd_w")).alias("lo"), "hi"))


def _checked(weights: DataFrame, category: str, weight: str, order: str | None, extra: tuple[str, ...] = ()
             ) -> tuple[DataFrame, int, int]:
    """(written weights, total weight, categories): one write, in ranges, and one
    aggregate over it; raises before any job on the plan if the weights cannot be
    drawn from or a weighted category has no name."""
    weights = _once(weights, [category, weight, order, *extra], [order or category, category])
    return weights, *validate_weights(weights, weight, named=category)


def _lookup(rows: DataFrame, slot: str, weights: DataFrame, category: str, weight: str,
            order: str | None, bins: int, total: int, k: int, stored: bool = True) -> DataFrame:
    """``rows`` with the category whose slot range holds ``slot``: an equi-join
    on the bin, then the range. The bin table carries keys and bounds only;
    ``stored``: the bounds are written, which keeps their exchange out of the plan
    of ``rows``."""
    width = -(-total // bins)  # ceil
    bounds = category_bounds(weights, category, weight, order)
    if stored:
        bounds = _once(bounds, [category, "lo", "hi"])
    bin_tbl = bounds.select(
        category, "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") / width),
                             F.floor((F.col("hi") - 1) / width))).alias("_wd_bin"))
    if -(-total // width) + k <= BROADCAST_ROWS:
        bin_tbl = F.broadcast(bin_tbl)
    return (rows.withColumn("_wd_bin", F.floor(F.col(slot) / width).cast("long"))
            .join(bin_tbl, "_wd_bin")
            .where((F.col(slot) >= F.col("lo")) & (F.col(slot) < F.col("hi")))
            .drop("_wd_bin", "lo", "hi"))


def weighted_slots(weights: DataFrame, category: str = "category", weight: str = "weight",
                   order: str | None = None, bins: int = DEFAULT_BINS) -> DataFrame:
    """The replicated table: one row per slot, ``(category, slot)``. Slots are
    a distributed range looked up in the bin table, so a heavy category is
    split over tasks and never held as one array."""
    weights, total, k = _checked(weights, category, weight, order)
    slots = weights.sparkSession.range(total).withColumnRenamed("id", "slot")
    return _lookup(slots, "slot", weights, category, weight, order, bins, total, k, stored=False).select(category, "slot")


def _once(weights: DataFrame, cols: list[str | None], sort: list[str] | None = None) -> DataFrame:
    """A table of one row per category written once, as it is read for its
    check, its bounds and its other columns; with ``sort`` in ranges, each row
    with the number of its range (``_wd_part``)."""
    spark = weights.sparkSession
    path = scratch_path(spark, "weights")
    kept = weights.select(*dict.fromkeys(c for c in cols if c))
    if sort:
        kept = kept.repartitionByRange(*sort).withColumn("_wd_part", F.spark_partition_id())
    kept.write.parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


def weighted_draw(plan: DataFrame, weights: DataFrame, seed: int, key: str = "slot_id",
                  tag: str = "cat", category: str = "category", weight: str = "weight",
                  order: str | None = None, bins: int = DEFAULT_BINS,
                  out: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Draw one category per plan row with probability weight / sum(weight).

    ``extra`` columns of ``weights`` (e.g. the catalogue's ``system``) are
    joined by category afterwards -- this is the category lookup: each is held
    once per category, not once per bin. Raises before any job on the plan if
    the weights are unusable (no weight, a negative one, a null category),
    alike at every size.
    """
    weights, total, k = _checked(weights, category, weight, order, extra)
    drawn = _lookup(plan.withColumn("_wd_s", F.pmod(u(seed, key, tag), F.lit(total))), "_wd_s",
                    weights, category, weight, order, bins, total, k).drop("_wd_s")
    if extra:  # the written table's size in bytes decides whether it is broadcast
        drawn = drawn.join(weights.where(F.col(weight) > 0).select(category, *extra), category)
    if out and out != category:
        drawn = drawn.withColumnRenamed(category, out)
    return drawn


def index_pool(pool: DataFrame, seed: int, item_id: str = "item_id",
               category: str | None = "category", out: str = "idx") -> DataFrame:
    """Number pool items 0..n_c-1 inside each category (order: the draw
    ``u(seed, item_id, "pool")``, ties by id). Item ids must be unique."""
    return _index_ids(pool, seed, item_id, category, out)[0]


def _index_ids(pool: DataFrame, seed: int, item_id: str, category: str | None,
               out: str = "idx") -> tuple[DataFrame, DataFrame]:
    h = "_pool_h"
    keep = [category, item_id] if category else [item_id]
    d = pool.select(*keep).withColumn(h, u(seed, item_id, "pool"))
    ranked, sizes = exact_rank_with_sizes(d, h, item_id, parts=[category] if category else [],
                                          out="_pool_r")
    return ranked.withColumn(out, F.col("_pool_r") - 1).drop(h, "_pool_r"), sizes


def uniform_pool_draw(plan: DataFrame, pool: DataFrame, seed: int,
                      key: str = "slot_id", tag: str = "prompt",
                      category: str | None = "category", item_id: str = "item_id",
                      salt_target: int | None = None) -> DataFrame:
    """Draw one pool item uniformly per plan row (within its category).

    Only ``(category, item_id)`` go through the ranking; the drawn ids are
    joined on ``(category, idx, salt)``, and any other pool columns (e.g. the
    prompt text) are fetched by one final join on ``(item_id, salt)``.

    Skew: a category with ``n`` items but a large share of the draws would
    pile its rows onto ``n`` join keys. A category is therefore spread over
    one key for every ``DRAWS_PER_KEY`` of its draws (``salt_target`` keys,
    if given): its items are copied ``ceil(keys / n)`` times under a salt, and
    each plan row takes a salt from its own draw (independent of which item it
    gets). Copies beyond the pool itself are at most draws / DRAWS_PER_KEY.

    No slot is dropped or multiplied: a plan row whose category (or null) has
    no pool items fails the job, and a repeated ``item_id`` is an error.
    """
    repeated = pool.groupBy(item_id).count().where("count > 1").select(item_id).first()
    if repeated is not None:
        raise ValueError(f"pool item {repeated[0]!r} is there more than once")
    ids, sizes = _index_ids(pool, seed, item_id, category, out="_up_i")
    salt_of_row = F.pmod(u(seed, key, "salt"), F.col("_up_k"))
    if category is None:
        row = sizes.first()  # one row: the pool size
        if not row or not row["n"]:
            raise ValueError("empty pool")
        spread = salt_target or -(-plan.count() // DRAWS_PER_KEY)
        k = F.lit(max(1, -(-spread // row["n"]))).cast("long")
        with_idx = plan.withColumn("_up_i", F.pmod(u(seed, key, tag), F.lit(row["n"]))).withColumn("_up_k", k)
        keys = ["_up_i"]

        def salted(items: DataFrame) -> DataFrame:
            return items.withColumn("_up_k", k)
    else:
        spread = (F.lit(salt_target) if salt_target else
                  F.ceil(F.coalesce("draws", F.lit(0)) / F.lit(DRAWS_PER_KEY)))
        draws = plan.groupBy(category).agg(F.count(F.lit(1)).alias("draws"))
        sizes = _once(sizes.join(draws, category, "left").withColumn(
            "_up_k", F.greatest(F.lit(1), F.ceil(spread / F.col("n"))).cast("long")), [category, "n", "_up_k"])
        with_idx = (plan.join(sizes, category, "left")
                    .withColumn("_up_i", F.pmod(u(seed, key, tag), F.col("n"))).drop("n"))
        keys = [category, "_up_i"]

        def salted(items: DataFrame) -> DataFrame:
            return items.join(sizes.select(category, "_up_k"), category)

    def copies(items: DataFrame) -> DataFrame:
        return (salted(items).withColumn("_up_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_up_k") - 1)))
                .drop("_up_k"))

    with_idx = with_idx.withColumn("_up_s", salt_of_row).drop("_up_k")
    drawn = with_idx.join(copies(ids), [*keys, "_up_s"], "left").drop("_up_i")
    none = F.raise_error(F.concat(F.lit("no pool items for category "),
                                  F.coalesce(F.col(category).cast("string") if category else F.lit(None), F.lit("null"))))
    drawn = drawn.withColumn(item_id, F.coalesce(item_id, none.cast(pool.schema[item_id].dataType)))
    payload = [c for c in pool.columns if c not in (category, item_id)]
    if payload:
        texts = copies(pool.select(*([category] if category else []), item_id, *payload))
        drawn = drawn.join(texts.select(item_id, "_up_s", *payload), [item_id, "_up_s"], "left")
    return drawn.drop("_up_s")


def item_salts(draws: DataFrame, item_id: str = "item_id") -> DataFrame:
    """``item_id, _it_k``: the items drawn more than ``DRAWS_PER_KEY`` times, with the
    keys to spread them over; at most draws / DRAWS_PER_KEY rows, written."""
    often = draws.groupBy(item_id).agg(F.count(F.lit(1)).alias("_it_n")).where(F.col("_it_n") > DRAWS_PER_KEY)
    return _once(often.withColumn("_it_k", F.ceil(F.col("_it_n") / F.lit(DRAWS_PER_KEY)).cast("long")), [item_id, "_it_k"])


def spread_items(draws: DataFrame, salts: DataFrame, key: str = "slot_id", item_id: str = "item_id") -> DataFrame:
    """``draws`` with ``_it_s``, the salt of the row: 0, or by its key for an item of :func:`item_salts`."""
    k = F.coalesce("_it_k", F.lit(1).cast("long"))
    return draws.join(salts, item_id, "left").withColumn("_it_s", F.pmod(F.xxhash64(key), k)).drop("_it_k")


def item_group(groups: int, item_id: str = "item_id") -> Column:
    """One of ``groups`` for each item and salt, about even in rows."""
    return F.pmod(F.xxhash64(item_id, "_it_s"), F.lit(groups).cast("long"))


def with_items(draws: DataFrame, pool: DataFrame, salts: DataFrame, tasks: int, item_id: str = "item_id",
               only: Column | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """``draws`` (:func:`spread_items`) with the other columns of their items, in
    ``tasks`` partitions, each in item order: draws of one item come one after another.
    An item crosses the shuffle once a salt, whatever its draws; ``only`` leaves out
    the items of no draw. ``derived`` columns are worked out for each item (and salt)
    after the shuffle, not for each draw. A draw whose item the pool lacks fails the job."""
    keys, payload = [item_id, "_it_s"], [c for c in pool.columns if c != item_id]
    copies = pool.join(salts, item_id, "left").withColumn("_it_s", F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce("_it_k", F.lit(1).cast("long")) - 1))).drop("_it_k")
    if only is not None:
        copies = copies.where(only)
    copies = copies.withColumn("_it_there", F.lit(True)).repartition(tasks, *keys).withColumns(derived or {}).hint("merge")
    gone = F.raise_error(F.concat(F.lit("no pool item "), F.coalesce(F.col(item_id).cast("string"), F.lit("null"))))
    got = draws.repartition(tasks, *keys).join(copies, keys, "left")
    return got.withColumns({c: F.when(F.col("_it_there"), F.col(c)).otherwise(gone.cast(pool.schema[c].dataType)) for c in payload}
                           ).drop("_it_there", "_it_s")
