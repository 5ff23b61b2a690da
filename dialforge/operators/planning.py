"""Plan rows: slots, top-up, provider assignment, modifier draws, composition.

A plan row is one generation attempt, keyed by ``slot_id``. The plan is
stored (not held in driver locals) so a run can be resumed by key: the
remaining work is ``plan`` anti-joined with what is already done, which a
line count cannot express (it cannot tell *which* rows failed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialforge.functions.draw import pick_from_array
from dialforge.sources.catalog import DETAIL_REQUESTS, VARIATIONS


def shortfall(target: int, existing: int) -> int:
    """Rows still needed; 0 means stop without work."""
    return max(int(target) - int(existing), 0)


def plan_slots(spark: SparkSession, target: int, existing: int = 0,
               partitions: int | None = None) -> DataFrame:
    """Slots ``existing .. target-1`` (empty when nothing is needed)."""
    start = min(int(existing), int(target))
    return spark.range(start, int(target), 1, partitions).withColumnRenamed("id", "slot_id")


def slots_after_sink(spark: SparkSession, target: int, sink_path: str | None) -> DataFrame:
    """Count-based top-up, as a line-counting writer resumes: slots from the
    sink's physical line count up to ``target`` (none when the sink already
    has ``target`` lines). It cannot tell which rows failed; prefer
    :func:`topup_plan` (keyed) when results carry slot ids."""
    from dialforge.sources.jsonl import count_lines

    existing = 0
    if sink_path:
        try:
            existing = count_lines(spark, sink_path)
        except Exception as e:  # noqa: BLE001 - a missing sink means nothing exists yet
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    return plan_slots(spark, target, min(existing, target))


def topup_plan(plan: DataFrame, done: DataFrame, key: str = "slot_id") -> DataFrame:
    """Plan rows not yet done (keyed resume): a left anti join on the key."""
    return plan.join(done.select(key), key, "left_anti")


def assign_provider(df: DataFrame, first: str, second: str | None = None,
                    key: str = "slot_id", out: str = "provider") -> DataFrame:
    """Odd slots go to the second provider when one is configured."""
    if second is None:
        return df.withColumn(out, F.lit(first))
    return df.withColumn(out, F.when(F.pmod(F.col(key), F.lit(2)) == 1, F.lit(second))
                         .otherwise(F.lit(first)))


def draw_modifiers(df: DataFrame, seed: int, key: str = "slot_id",
                   variations: list[str] | None = None,
                   details: list[str] | None = None) -> DataFrame:
    """Independent uniform draws of a variation and a detail suffix."""
    var_arr = F.array(*[F.lit(s) for s in (variations or VARIATIONS)])
    det_arr = F.array(*[F.lit(s) for s in (details or DETAIL_REQUESTS)])
    return (df.withColumn("variation", pick_from_array(seed, key, "var", var_arr))
            .withColumn("detail", pick_from_array(seed, key, "detail", det_arr)))


def compose_prompt(df: DataFrame, base: str = "base_prompt", variation: str = "variation",
                   detail: str = "detail", out: str = "user_prompt") -> DataFrame:
    """base + variation + detail, no separator (suffixes carry their space)."""
    return df.withColumn(out, F.concat(F.col(base), F.coalesce(F.col(variation), F.lit("")),
                                       F.coalesce(F.col(detail), F.lit(""))))


def draw_catalog_prompt(plan: DataFrame, seed: int, key: str = "slot_id",
                        prompts: str = "prompts", out: str = "base_prompt") -> DataFrame:
    """Uniform draw from the category's (short) prompt array."""
    return plan.withColumn(out, pick_from_array(seed, key, "prompt", F.col(prompts)))
