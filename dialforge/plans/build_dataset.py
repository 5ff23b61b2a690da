"""Build a chat dataset: plan -> generate (in waves) -> records + failures.

Stages and their Spark shape:

1. plan: keyed slots (``spark.range`` or any keyed table) -> weighted
   category draw (broadcast bin join) -> prompt draw (catalogue array or
   large-pool equi-join) -> modifier draws -> composition -> provider.
   All native expressions; the plan is written once so reruns see the same
   rows.
2. generate: plan rows not yet successful (slot bitmaps of plan and
   successes, see ``operators.resume``), in waves of ``wave_size`` slots (on by
   default), each dealt to one task for every ``rows_per_task`` rows; each wave
   is shaped, sent through ``mapInArrow`` and appended to the results table, so
   a lost driver or executor costs at most one wave. Waves of no more rows than a
   task has run side by side in one job, each committed as its task ends; there a loss
   costs the waves under way. With a pool every task is such a wave. Calls are
   at-least-once.
3. records: results -> reply extraction -> successes become
   ``messages`` records (fixed system text first), failures go to their own
   table for a later top-up. The export appends the records of the runs that
   the sink's log lacks, exactly once (``sources.sink``).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialforge.functions import chat
from dialforge.operators import generation as gen
from dialforge.operators import messages as msg
from dialforge.operators import metrics as mt
from dialforge.operators import planning as pl
from dialforge.operators import resume as rs
from dialforge.operators import sampling as sa
from dialforge.operators import split as sp
from dialforge.sources import catalog as cat
from dialforge.session import scratch_path
from dialforge.sources import sink as sk
from dialforge.sources import store


LONG_TEXT = ("user_prompt", "raw", "text", "base_prompt")
TEXT_CODEC = None  # Spark's default codec; zstd is ~1/3 smaller but its slower
                   # compression of the results table cost ~50% more write time
ITEM_CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
                     # results laid out by pool item: it finds the text of a prompt
                     # in the rows before, so each is stored about once a task
GZIP_LEVEL = {"zlib.compress.level": "FOUR"}  # of exported lines: about half the time of
                                              # the default level, a tenth larger
JOB_WAVES, JOB_ROWS = 10_000, 1 << 20  # small waves that share a job, and their rows, at most


@dataclass
class BuildConfig:
    seed: int = 42
    first_provider: str = "messages_api"
    second_provider: str | None = None
    concurrency: int | None = None  # None: the backend's own setting
    wave_size: int | None = 1 << 20  # rows of a commit, about; None: one commit
    partitions: int | None = None    # generation tasks of a wave that is a job; None: by its rows
    rows_per_task: int = 20_000
    export_codec: str | None = None  # of the exported lines, e.g. gzip; None: plain
    system: str = chat.DEFAULT_SYSTEM
    models: dict = field(default_factory=dict)


def tasks_for(spark: SparkSession, rows: int, cfg: BuildConfig) -> int:
    """Tasks for so many rows: one for every ``rows_per_task``, and no fewer
    than the cores at hand (``partitions``, if set)."""
    return cfg.partitions or max(spark.sparkContext.defaultParallelism, -(-rows // cfg.rows_per_task))


def _spread_keys(plan_keys: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Spread the slot keys (one long per row) before planning, so the
    per-row draws and prompt composition run on every task even when the
    key source is a single split; only the key column crosses the shuffle."""
    spark = plan_keys.sparkSession
    return plan_keys.repartition(tasks_for(spark, plan_keys.count(), cfg), "slot_id")


def plan_from_catalog(plan_keys: DataFrame, catalog: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Slots x catalogue: category by weight, prompt from its short list.
    Raises before any job on the slots if a weighted category has no prompts
    or the weights sum to zero."""
    cat.validate_catalog(catalog)
    drawn = sa.weighted_draw(_spread_keys(plan_keys, cfg),
                             catalog.withColumnRenamed("system", "gen_system"),
                             cfg.seed, order="ord", extra=("gen_system", "prompts"))
    drawn = pl.draw_catalog_prompt(drawn, cfg.seed).drop("prompts")
    return _finish_plan(drawn, cfg)


def plan_from_pool(plan_keys: DataFrame, pool: DataFrame, weights: DataFrame,
                   cfg: BuildConfig, texts: bool = True) -> DataFrame:
    """Slots x a large pool ``(category, item_id, base_prompt)``; ``weights``
    is ``(category, weight, gen_system)``. Without ``texts`` the plan names the item of
    each slot and its modifiers only; with the pool, :func:`build_dataset` composes
    the prompts of a wave as they are sent."""
    drawn = sa.weighted_draw(_spread_keys(plan_keys, cfg), weights, cfg.seed, extra=("gen_system",))
    drawn = sa.uniform_pool_draw(drawn, pool if texts else pool.select("category", "item_id"), cfg.seed)
    return _finish_plan(drawn, cfg, texts)


def _finish_plan(drawn: DataFrame, cfg: BuildConfig, texts: bool = True) -> DataFrame:
    """Modifiers, composition, provider. The base prompt is not kept: the
    composed ``user_prompt`` holds it, and the pool key is kept."""
    drawn = pl.draw_modifiers(drawn, cfg.seed)
    if texts:
        drawn = pl.compose_prompt(drawn).drop("base_prompt")
    return pl.assign_provider(drawn, cfg.first_provider, cfg.second_provider)


def _scalar_plan(plan: DataFrame) -> DataFrame:
    return plan.drop("variation", "detail", "base_prompt")


def generate(spark: SparkSession, plan: DataFrame, call: gen.Call, results_path: str,
             cfg: BuildConfig, done: DataFrame | None = None,
             run_id: str | None = None, counts: mt.RunCounts | None = None,
             pool: DataFrame | None = None) -> T.StructType:
    """Append one result row per attempted slot to ``results_path``.

    ``done`` holds the keys already successful (default: none); rows are
    tagged with ``run_id``; ``counts`` counts them as they are written. Each wave is a commit of its own; without slots
    left no wave runs. With ``pool`` the plan holds no prompts: they are put in
    beside the slots of their item, so they cross the shuffle once and not once a
    slot. Returns the schema of the result rows (to read them back
    without inference), or None if no wave ran.
    """
    plan = (_scalar_plan(plan) if pool is None else plan).withColumn("run_id", F.lit(run_id or new_run_id()))
    schema = None
    for dealt, options in _dealt_waves(spark, plan, done, cfg) if pool is None else _item_waves(spark, plan, pool, done, cfg):
        shaped = gen.shape_request(dealt, models=cfg.models, user_json=None if pool is None else "user_json"
                                   ).drop("request", "user_json")
        out = gen.bulk_generate(shaped, call, concurrency=cfg.concurrency)
        # parse each reply once, natively, before it is stored: ``text`` and
        # the final ``error`` (backend or extraction) are kept, the raw body
        # only for failures (to debug them); resumes, counters and records
        # then never parse stored replies again
        out = gen.extract_response(out).withColumn(
            "raw", F.when(F.col("error").isNotNull(), F.col("raw")))
        codec = {"compression": TEXT_CODEC} if pool is None else ITEM_CODEC
        with gen.small_batches(spark):
            store.write_table(counts.watch(out) if counts else out, results_path, mode="append",
                              long_text=LONG_TEXT, **codec, **options)
        schema = out.schema
    return schema


def _dealt_waves(spark: SparkSession, plan: DataFrame, done: DataFrame | None, cfg: BuildConfig):
    """The slots of each job, with options of its write. A wave is hash-spread by slot
    before shaping, so the shuffle carries the plan row once and never the JSON body;
    of waves that are no more than a task's rows, a job takes many, a task each, and
    each is committed as its task ends."""
    rows, waves = _cut_waves(spark, plan, done, cfg)
    listed = rs.waves_of(waves) if waves is not None else []
    if len(listed) < 2 or not cfg.wave_size or cfg.wave_size > cfg.rows_per_task:
        for rows, part in _listed_waves(plan, rows, waves, listed, cfg):
            yield part.repartition(tasks_for(spark, rows, cfg), "slot_id"), {}
        return
    step = max(min(JOB_WAVES, JOB_ROWS // cfg.wave_size), 1)
    for i in range(0, len(listed), step):
        some = listed[i:i + step]
        part = rs.rows_of_waves(plan, waves, some, JOB_ROWS + cfg.wave_size)
        yield part.repartitionById(len(some), (F.col("wave") - F.lit(some[0].wave)).cast("int")).drop("wave"), store.BY_TASK


def _item_waves(spark: SparkSession, plan: DataFrame, pool: DataFrame, done: DataFrame | None, cfg: BuildConfig):
    """The slots of each job of a plan without texts, with their prompts, and options
    of its write. Slots are dealt by item (and salt, for items drawn very often), so an
    item meets its slots in one task, side by side. With ``wave_size`` the waves are the
    tasks of a job, each committed as it ends, so the pool is read and shuffled once and
    not with every wave; beyond ``JOB_WAVES`` tasks, jobs take groups of items."""
    rows = _checked_keys(plan)
    salts = sa.item_salts(plan)
    slots = sa.spread_items(plan, salts)
    if done is not None or cfg.wave_size and rows > cfg.wave_size:
        todo = todo_waves(spark, plan, done, cfg.wave_size or max(rows, 1)).select("slot_id")
        if done is not None:
            rows = todo.count()
            if not rows:
                return
            slots = slots.join(todo, "slot_id", "left_semi")
    groups = -(-item_tasks(spark, rows, cfg) // JOB_WAVES)
    sizes = [(None, rows)]
    if groups > 1:
        slots = slots.withColumn("group", sa.item_group(groups))
        path = scratch_path(spark, "todo-items")
        store.write_table(slots.repartition("group").sortWithinPartitions("group"), path)
        slots = spark.read.schema(slots.schema).parquet(path)
        sizes = [tuple(r) for r in slots.groupBy("group").count().orderBy("group").collect()]  # a row for each job
    for group, n in sizes:
        mine = slots if group is None else slots.where(F.col("group") == F.lit(group)).drop("group")
        only = None if group is None else sa.item_group(groups) == F.lit(group)
        got = sa.with_items(mine, pool.select("item_id", "base_prompt"), salts, item_tasks(spark, n, cfg), only=only,
                            derived={"base_json": gen.json_inner(F.col("base_prompt"))})
        got = pl.compose_prompt(got)
        added = gen.json_inner(F.concat(*[F.coalesce(c, F.lit("")) for c in ("variation", "detail")]))
        got = got.withColumn("user_json", F.concat("base_json", added))
        yield got.drop("base_prompt", "base_json", "variation", "detail"), store.BY_TASK if cfg.wave_size else {}


def item_tasks(spark: SparkSession, rows: int, cfg: BuildConfig) -> int:
    """Tasks for so many slots of a plan without texts: as :func:`tasks_for`, and
    none of more than about ``wave_size`` slots, as each is a commit."""
    if not cfg.wave_size:
        return tasks_for(spark, rows, cfg)
    waves = max(-(-rows // cfg.wave_size), 1)
    return waves * cfg.partitions if cfg.partitions else max(waves, tasks_for(spark, rows, cfg))


def _checked_keys(plan: DataFrame) -> int:
    """The rows of a plan; raises if a slot is null."""
    rows, keys = plan.agg(F.count(F.lit(1)), F.count("slot_id")).first()
    if rows != keys:
        raise ValueError("a slot_id is null")
    return rows


def _waves(spark: SparkSession, plan: DataFrame, done: DataFrame | None, cfg: BuildConfig) -> list[tuple[int, DataFrame]]:
    """``(rows, slots)`` of each wave: the plan as it is if nothing is done and
    it fits one, else what the bitmaps leave, cut into waves of ``wave_size``."""
    rows, waves = _cut_waves(spark, plan, done, cfg)
    return _listed_waves(plan, rows, waves, rs.waves_of(waves) if waves is not None else [], cfg)


def _cut_waves(spark: SparkSession, plan: DataFrame, done: DataFrame | None, cfg: BuildConfig) -> tuple[int, DataFrame | None]:
    """Rows of the plan, and :func:`todo_waves` or None if it is one wave as it is."""
    rows = _checked_keys(plan)
    if done is None and (not cfg.wave_size or rows <= cfg.wave_size):
        return rows, None
    return rows, todo_waves(spark, plan, done, cfg.wave_size or max(rows, 1))


def _listed_waves(plan: DataFrame, rows: int, waves: DataFrame | None, listed: list[rs.Wave], cfg: BuildConfig
                  ) -> list[tuple[int, DataFrame]]:
    if waves is None:
        return [(rows, plan)]
    return [(w.rows, rs.rows_of(plan, waves, w, cfg.wave_size)) for w in listed]


def todo_waves(spark: SparkSession, plan: DataFrame, done: DataFrame | None, wave_size: int) -> DataFrame:
    """``wave``, ``slot_id`` of the slots left, written to the shared folder
    (with the bitmaps' difference, which is read twice). Raises if a slot of the
    plan repeats: it would be generated more than once."""
    path = scratch_path(spark, "todo")
    if rs.far_apart(plan):
        sp.assert_unique(plan, "slot_id")
        left = rs.keys_left(plan, done)
    else:
        has = rs.slot_bitmaps(plan)
        store.write_table(has, f"{path}/plan")
        has = spark.read.schema(has.schema).parquet(f"{path}/plan")
        rows = plan.agg(F.count("slot_id")).first()[0]
        if rs.count_slots(has).first()[0] != rows:
            raise ValueError("slot_id is not unique in the plan")
        # a bitmap takes little room and its slots take much, so the tasks go by the slots
        parts = max(spark.sparkContext.defaultParallelism, rows // JOB_ROWS)
        left = rs.slots_left(has, None if done is None else rs.slot_bitmaps(done), parts)
    store.write_table(left, f"{path}/left")
    waves = rs.number_waves(spark.read.schema(left.schema).parquet(f"{path}/left"), wave_size)
    store.write_table(waves, f"{path}/waves")
    return spark.read.schema(waves.schema).parquet(f"{path}/waves")


def in_slot_order(plan: DataFrame, cfg: BuildConfig) -> DataFrame:
    """The plan laid out in ranges of the slot, so that a wave reads its own files
    only. The ranges are cut from the lowest and highest slot, which needs the key
    column alone; keys with wide gaps are left to Spark's sampled ranges."""
    lo, hi, rows = plan.agg(F.min("slot_id"), F.max("slot_id"), F.count("slot_id")).first()
    if not rows:
        return plan
    if hi - lo + 1 > 8 * rows:
        return plan.repartitionByRange("slot_id").sortWithinPartitions("slot_id")
    parts = tasks_for(plan.sparkSession, rows, cfg)
    width = -(-(hi - lo + 1) // parts)
    part = F.floor((F.col("slot_id") - F.lit(lo)) / F.lit(width)).cast("int")
    return plan.repartitionById(parts, part).sortWithinPartitions("slot_id")


def new_run_id() -> str:
    """Run ids sort by the time they were made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


def results_view(results: DataFrame) -> DataFrame:
    """Result rows with ``text`` and ``error``: as stored by :func:`generate`,
    or extracted from ``raw`` for tables written without them (streams)."""
    return results if "text" in results.columns else gen.extract_response(results)


def records_from_results(results: DataFrame, cfg: BuildConfig) -> tuple[DataFrame, DataFrame]:
    """Results -> (records, failures). Records keep slot, provider, category
    beside the ``messages``/``category`` training shape."""
    ext = results_view(results)
    ok = msg.assemble_triplet(gen.successes(ext), cfg.system, "user_prompt", "text")
    # a slot that failed in one run and succeeded in a later one is not a
    # failure; one that failed in several is one: its latest attempt
    failed = gen.failures(ext)
    latest = F.max_by(F.struct(*failed.columns), F.col("run_id") if "run_id" in failed.columns else F.lit(""))
    still_failing = (failed.join(ok.select("slot_id"), "slot_id", "left_anti")
                     .groupBy("slot_id").agg(latest.alias("_f"), F.count(F.lit(1)).alias("attempts"))
                     .select("_f.*", "attempts"))
    return ok, still_failing


def successful_keys(spark: SparkSession, results_path: str) -> DataFrame | None:
    """Slots with a stored success: a pruned scan of (slot_id, error); the
    verdict was stored at generation time, so no reply is parsed here."""
    if not store.has_files(spark, results_path):
        return None  # first run: nothing was committed yet
    res = spark.read.parquet(results_path)
    return gen.successes(results_view(res)).select("slot_id")


def extend_plan(spark: SparkSession, plan: DataFrame, plan_path: str, cfg: BuildConfig | None = None) -> None:
    """Append the slots of ``plan`` that the stored plan lacks. Raises if a
    slot of both differs: results of two plans must not mix."""
    stored = spark.read.schema(plan.schema).parquet(plan_path)
    path = scratch_path(spark, "plan")  # read three times, drawn and composed once
    store.write_table(plan, path, long_text=LONG_TEXT, compression=TEXT_CODEC)
    plan = spark.read.schema(plan.schema).parquet(path)

    def digest(df):
        return df.select("slot_id", F.xxhash64(*sorted(plan.columns)).alias("digest"))

    both = digest(plan).join(digest(stored).withColumnRenamed("digest", "was"), "slot_id")
    if not both.where("digest <> was").isEmpty():
        raise ValueError(f"the plan differs from the one stored under {plan_path}; "
                         "use another folder for another seed, catalogue or provider")
    new = pl.topup_plan(plan, stored)
    if not new.isEmpty():
        store.write_table(in_slot_order(new, cfg or BuildConfig()), plan_path,
                          mode="append", long_text=LONG_TEXT, compression=TEXT_CODEC)


def keep_pool(spark: SparkSession, pool: DataFrame, path: str, compare: bool) -> None:
    """Store a digest of each item's text, or ``compare`` with those stored: results
    of two pools must not mix."""
    now = pool.select("item_id", F.xxhash64("base_prompt").alias("digest"))
    if not compare:
        return store.write_table(now, path, mode="overwrite")
    was = spark.read.schema(now.schema).parquet(path).withColumnRenamed("digest", "was")
    if not was.join(now, "item_id", "left").where(~F.col("digest").eqNullSafe(F.col("was"))).isEmpty():
        raise ValueError(f"the pool differs from the one stored under {path}; use another folder for another pool")


def export_records(records: DataFrame, path: str, runs: list[str], cfg: BuildConfig | None = None) -> sk.Commit | None:
    """Append the training records of ``runs`` as JSON Lines in the chat-record
    shape (``messages``, ``category``; also ``slot_id`` and ``provider``), nulls
    kept, in one commit of the sink; compressed in files of ``rows_per_task`` lines
    if ``export_codec`` is set."""
    cfg = cfg or BuildConfig()
    packed = {"compression": cfg.export_codec, "maxRecordsPerFile": cfg.rows_per_task, **GZIP_LEVEL} if cfg.export_codec else {}
    return sk.append(records.select("slot_id", "provider", "messages", "category"), path, runs, **packed)


def export_new(spark: SparkSession, results: DataFrame, path: str, cfg: BuildConfig) -> sk.Commit | None:
    """Export the successes of all runs that the sink's log lacks; of the results
    only their rows are read, of the sink only its log. Lines that another writer
    left there without a log are compared by slot, once."""
    taken_over = sk.adopt(spark, path)
    log = sk.recover(spark, path)
    there = sk.exported_runs(log)
    rows = results.where(~F.col("run_id").isin(there)) if there else results
    runs = [r["run_id"] for r in rows.select("run_id").distinct().collect()]      # a row for each run
    if not runs:
        return None
    records, _ = records_from_results(rows, cfg)
    if taken_over or not there and log:
        old = sk.read_committed(spark, path, "slot_id long")
        records = records.join(old, "slot_id", "left_anti")
    return export_records(records, path, runs, cfg)


def build_dataset(spark: SparkSession, plan: DataFrame, call: gen.Call, out_dir: str,
                  cfg: BuildConfig | None = None,
                  export_path: str | None = None, pool: DataFrame | None = None) -> dict[str, DataFrame]:
    """Run (or resume) the whole build under ``out_dir`` and return the
    written tables, read back: ``plan``, ``results``, ``records``,
    ``failures``, ``metrics`` (attempted, generated, failed over all runs, and
    the elapsed time of this one), ``run_metrics`` (the same for this run) and
    ``report`` (this run's attempts by category and successes by provider, counted
    while its results were written, unless it has very many categories).
    Rerunning retries only slots without a success; a plan with more slots
    than the stored one extends it; a plan that differs on a stored slot (other
    seed, catalogue, provider) is an error; with nothing to do no job runs. The
    results table is the durable store; with ``export_path`` the records of every
    run that the sink's log lacks are appended there as JSON Lines (chat-record
    shape plus ``slot_id`` and ``provider``), exactly once.

    ``pool`` ``(item_id, base_prompt)`` is for a plan without texts: slots draw an
    item many times over, and its text is neither stored nor shuffled with each.
    The results hold the prompts as sent. A digest of each item is stored with the
    plan, and an item whose text differs in a later run is an error too."""
    cfg = cfg or BuildConfig()
    plan_path = f"{out_dir}/plan"
    stored_before = store.committed(spark, plan_path)
    if pool is not None:
        keep_pool(spark, pool, f"{out_dir}/pool", stored_before)
    if stored_before:
        extend_plan(spark, plan, plan_path, cfg)
    else:
        # with waves in slot order, so that each wave's range filter prunes to
        # its own files (one read of the plan in total)
        laid = in_slot_order(plan, cfg) if cfg.wave_size and pool is None else plan
        store.write_table(laid, plan_path, mode="overwrite",
                          long_text=LONG_TEXT, compression=TEXT_CODEC)
    stored = spark.read.schema(plan.schema).parquet(plan_path)
    results_path = f"{out_dir}/results"
    run_id = new_run_id()
    t0 = time.perf_counter()
    done = successful_keys(spark, results_path)
    providers = [p for p in (cfg.first_provider, cfg.second_provider) if p]
    counts = mt.RunCounts.of_plan(stored, providers)
    schema = generate(spark, stored, call, results_path, cfg, done=done, run_id=run_id, counts=counts, pool=pool)
    elapsed = time.perf_counter() - t0
    results = (spark.read.schema(schema) if schema else spark.read).parquet(results_path)
    records, fails = records_from_results(results, cfg)
    if export_path:
        export_new(spark, results, export_path, cfg)
    if counts:
        run_metrics, report = counts.metrics(spark, elapsed), counts.report(spark)
    else:
        this_run = results_view(results.where(F.col("run_id") == run_id))
        run_metrics, report = mt.run_metrics(this_run, elapsed), mt.run_report(spark, this_run, providers)
    return {"plan": stored, "results": results, "records": records, "failures": fails,
            "metrics": mt.run_metrics(results_view(results), elapsed), "run_metrics": run_metrics, "report": report}
