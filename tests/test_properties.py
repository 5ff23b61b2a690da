"""Properties: partition independence, exact ranks, resume = one full run,
renders keep every content."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dialforge.functions.draw import u
from dialforge.operators import generation as gen
from dialforge.operators import messages as msg
from dialforge.operators import planning as pl
from dialforge.operators import sampling as sa
from dialforge.operators import split as sp
from dialforge.operators.rank import exact_rank, flag_smallest
from dialforge.plans import build_dataset as bd
from dialforge.session import read_table, scratch_path
from dialforge.sources import catalog as cat
from dialforge.sources import jsonl
from tests.conftest import SF001


def _docs(spark, parts):
    return read_table(spark, SF001, "documents").select("doc_id", "lang").repartition(parts)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_split_independent_of_partitions(spark, parts):
    base = {r.doc_id: r.split for r in sp.train_eval_split(_docs(spark, 3), "doc_id").collect()}
    got = {r.doc_id: r.split for r in sp.train_eval_split(_docs(spark, parts), "doc_id").collect()}
    assert got == base
    assert sum(v == "eval" for v in got.values()) == 50  # ceil(0.05 * 1000)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_weighted_and_uniform_draws_independent_of_partitions(spark, parts):
    pool = cat.pool_from_table(_docs(spark, parts), "lang", "doc_id")
    weights = cat.weights_from_pool(pool)
    plan = pl.plan_slots(spark, 3000, partitions=parts)
    drawn = sa.uniform_pool_draw(sa.weighted_draw(plan, weights, 7), pool, 7)
    got = sorted((r.slot_id, r.category, r.item_id) for r in drawn.collect())
    pool1 = cat.pool_from_table(_docs(spark, 1), "lang", "doc_id")
    ref = sa.uniform_pool_draw(sa.weighted_draw(pl.plan_slots(spark, 3000), weights, 7), pool1, 7)
    assert got == sorted((r.slot_id, r.category, r.item_id) for r in ref.collect())
    assert len(got) == 3000


def test_exact_rank_equals_global_row_number(spark):
    df = spark.range(5000).withColumn("h", u(3, "id", "t")).withColumn("g", F.col("id") % 3)
    mine = exact_rank(df, "h", "id", parts=["g"], out="r", bits=8)
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")))
    assert sorted(map(tuple, mine.select("id", "r").collect())) == \
        sorted(map(tuple, ref.select("id", "r").collect()))


@pytest.mark.parametrize("k", [1, 7, 250, 4999, 5000])
def test_flag_smallest_equals_rank_cut(spark, k):
    df = spark.range(5000).withColumn("h", u(5, "id", "t"))
    got = {r.id for r in flag_smallest(df, "h", "id", k=k, bits=6).where("is_head").collect()}
    ref = df.withColumn("r", F.row_number().over(Window.orderBy("h", "id"))).where(F.col("r") <= k)
    assert got == {r.id for r in ref.collect()}


def test_ties_in_draw_broken_by_id(spark):
    df = spark.range(100).withColumn("h", F.lit(5).cast("long"))
    got = exact_rank(df, "h", "id", out="r").orderBy("r").collect()
    assert [r.id for r in got] == list(range(100))


def test_resume_equals_one_full_run(spark):
    """Run with faults, then resume with a fault-free backend: the records
    equal a single fault-free run (keyed top-up, no duplicates)."""
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=11, second_provider="chat_completions")
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 400), catalog, cfg)

    out = scratch_path(spark, "resume")
    export = f"{out}/records.jsonl"
    first = bd.build_dataset(spark, plan, gen.offline_backend(11, fault_every=5), out, cfg,
                             export_path=export)
    n_fail = first["failures"].count()
    assert 40 < n_fail < 130
    assert jsonl.count_lines(spark, export) == 400 - n_fail
    second = bd.build_dataset(spark, plan, gen.offline_backend(11, fault_every=0), out, cfg,
                              export_path=export)
    assert second["failures"].count() == 0
    exported = jsonl.read_records(spark, export)  # strict, chat-record schema
    assert exported.count() == 400 == jsonl.count_lines(spark, export)
    assert exported.where(F.size("messages") != 3).count() == 0
    resumed = second["records"]

    full = bd.build_dataset(spark, plan, gen.offline_backend(11, fault_every=0),
                            scratch_path(spark, "full"), cfg)["records"]
    key = ["slot_id", "category", "provider", "user_prompt", "text"]
    assert resumed.count() == 400
    assert sorted(map(tuple, resumed.select(*key).collect())) == \
        sorted(map(tuple, full.select(*key).collect()))
    # attempts exceed successes after the faulty first run
    assert second["results"].count() == 400 + n_fail


def test_waves_commit_separately(spark):
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=3, wave_size=50)
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 200), catalog, cfg)
    out = scratch_path(spark, "waves")
    res = bd.build_dataset(spark, plan, gen.offline_backend(3, fault_every=0), out, cfg)
    assert res["records"].count() == 200
    assert res["records"].select("slot_id").distinct().count() == 200


def test_render_contains_every_content(spark):
    conv = read_table(spark, SF001, "conversations")
    rendered = msg.render_chat(msg.assemble_from_turns(conv)).select("conv_id", "text")
    missing = conv.alias("c").join(rendered.alias("r"), "conv_id") \
        .where(F.instr(F.col("r.text"), F.col("c.text")) == 0).count()
    assert missing == 0


def test_catalog_plan_prompts_come_from_catalog(spark):
    catalog = cat.read_catalog(spark)
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 500), catalog, bd.BuildConfig())
    prompts = {p for r in catalog.collect() for p in r.prompts}
    rows = plan.select("category", "user_prompt", "variation", "detail").collect()
    for r in rows:
        base = r.user_prompt[: len(r.user_prompt) - len(r.variation) - len(r.detail)]
        assert base in prompts
    cats = {r.category for r in rows}
    assert cats == {r.category for r in catalog.collect()}


def test_weighted_draw_with_wide_bins_matches_python(spark):
    """Total weight far above the bin count: bins span many slots, and the
    range filter must still pick exactly the category holding the slot."""
    from dialforge.functions.draw import u_py

    weights = spark.createDataFrame([("a", 10**9), ("b", 3 * 10**9), ("c", 1), ("d", 7)],
                                    "category string, weight long")
    plan = pl.plan_slots(spark, 3000)
    got = {r.slot_id: r.category for r in sa.weighted_draw(plan, weights, 9, bins=16).collect()}
    bounds, lo = [], 0
    for c, w in [("a", 10**9), ("b", 3 * 10**9), ("c", 1), ("d", 7)]:
        bounds.append((c, lo, lo + w))
        lo += w
    total = lo
    want = {}
    for i in range(3000):
        s = u_py(9, i, "cat") % total
        want[i] = next(c for c, a, b in bounds if a <= s < b)
    assert got == want


def test_flag_smallest_at_exact_bucket_edges(spark):
    from dialforge.functions.draw import bucket_of

    df = spark.range(3000).withColumn("h", u(2, "id", "t"))
    counts = sorted((r.b, r["count"]) for r in df.groupBy(bucket_of("h", 4).alias("b")).count().collect())
    edges, acc = [], 0
    for _, c in counts[:5]:
        acc += c
        edges.append(acc)
    ordered = [r.id for r in df.orderBy("h", "id").collect()]
    for k in edges:
        got = {r.id for r in flag_smallest(df, "h", "id", k=k, bits=4).where("is_head").collect()}
        assert got == set(ordered[:k])


def test_prepare_training_set_job_writes_ordered_manifest(spark):
    import glob

    import pyarrow.parquet as pq

    from dialforge.plans import prepare_training as pt

    recs = msg.assemble_from_turns(read_table(spark, SF001, "conversations"))
    out = scratch_path(spark, "prep")
    res = pt.prepare_training_set(spark, recs, "conv_id", out, epochs=2, answered_only=True)
    data, man = res["data"], res["manifest"]
    n_train = data.where("split = 'train'").count()
    assert data.count() + res["unanswered"].count() == 100
    assert data.where("split = 'eval'").count() == 5  # ceil(0.05 * 98)
    assert man.count() == 2 * n_train
    assert man.groupBy("epoch", "conv_id").count().where("count > 1").count() == 0
    # files of one epoch hold disjoint, increasing step ranges, sorted inside
    spans = []
    for f in glob.glob(f"{out}/manifest/epoch=0/*.parquet"):
        t = pq.read_table(f).to_pandas()
        if len(t):
            assert list(t["position"]) == sorted(t["position"])
            spans.append((t["step"].min(), t["step"].max()))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_pool_draw_salting_changes_nothing_but_spread(spark):
    """A hot category with a 2-item pool: salted and unsalted draws agree."""
    tiny = spark.createDataFrame([("tiny", 10**6 + i, f"t{i}") for i in range(2)],
                                 "category string, item_id long, base_prompt string")
    big = spark.range(5000).selectExpr("'big' AS category", "id AS item_id",
                                       "concat('b', id) AS base_prompt")
    pool = tiny.unionByName(big)
    weights = spark.createDataFrame([("tiny", 1), ("big", 2)], "category string, weight long")
    plan = sa.weighted_draw(pl.plan_slots(spark, 6000), weights, 4)
    salted = sa.uniform_pool_draw(plan, pool, 4)
    plain = sa.uniform_pool_draw(plan, pool, 4, salt_target=1)
    a = sorted(map(tuple, salted.select("slot_id", "category", "item_id", "base_prompt").collect()))
    b = sorted(map(tuple, plain.select("slot_id", "category", "item_id", "base_prompt").collect()))
    assert a == b and len(a) == 6000
    hot = [r for r in a if r[1] == "tiny"]
    assert 1700 < len(hot) < 2300
    assert {r[3] for r in hot} == {"t0", "t1"}
    single = sa.uniform_pool_draw(pl.plan_slots(spark, 300), tiny.drop("category"), 4, category=None)
    assert single.count() == 300 and single.select("item_id").distinct().count() == 2


def test_build_metrics_count_extraction_failures(spark):
    """Metrics count every failure, including bodies that parse to no text."""
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=21)
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 300), catalog, cfg)
    out = bd.build_dataset(spark, plan, gen.offline_backend(21, fault_every=3),
                           scratch_path(spark, "metrics"), cfg)
    m = out["metrics"].first()
    assert m.failed == out["failures"].count() > 0
    assert m.generated == out["records"].count() == 300 - m.failed


def test_wave_filter_prunes_plan_files(spark):
    """With waves the stored plan is in slot order, and a wave's filter
    reaches the scan as a range on slot_id."""
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=3, wave_size=100, partitions=4)
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 400), catalog, cfg)
    out = scratch_path(spark, "wave-prune")
    res = bd.build_dataset(spark, plan, gen.offline_backend(3, fault_every=0), out, cfg)
    assert res["records"].count() == 400
    stored = spark.read.parquet(f"{out}/plan")
    wave = stored.where(F.col("slot_id").between(F.lit(100), F.lit(199)))
    plan_text = wave._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(slot_id), GreaterThanOrEqual(slot_id,100)" in plan_text
    spans = sorted((r["lo"], r["hi"]) for r in stored.groupBy(F.spark_partition_id().alias("p"))
                   .agg(F.min("slot_id").alias("lo"), F.max("slot_id").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # disjoint slot ranges per file


def test_build_topup_is_lossless(spark, tmp_path):
    """Part of the slots with a faulty generator, then all: one record per
    slot, all of them exported once, nothing done again, no job when done."""
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=9, wave_size=20, partitions=2)
    out, sink = str(tmp_path / "b"), str(tmp_path / "records.jsonl")

    def plan(n):
        return bd.plan_from_catalog(pl.plan_slots(spark, n), catalog, cfg)

    first = bd.build_dataset(spark, plan(40), gen.offline_backend(9, fault_every=4), out, cfg)
    lost = first["failures"].count()
    assert lost and first["records"].count() == 40 - lost  # not exported: as after a crash
    again = bd.build_dataset(spark, plan(40), gen.offline_backend(9, fault_every=4), out, cfg)
    assert again["failures"].count() == lost == again["failures"].select("slot_id").distinct().count()
    full = bd.build_dataset(spark, plan(90), gen.offline_backend(9, fault_every=0), out, cfg, export_path=sink)
    assert full["records"].count() == 90 and full["failures"].isEmpty()
    ids = [r[0] for r in spark.read.schema("slot_id long").json(sink).collect()]
    assert sorted(ids) == list(range(90))
    files = sorted(p.name for p in (tmp_path / "b" / "results").iterdir())
    bd.build_dataset(spark, plan(90), gen.offline_backend(9, fault_every=0), out, cfg, export_path=sink)
    assert files == sorted(p.name for p in (tmp_path / "b" / "results").iterdir())
    assert spark.read.schema("slot_id long").json(sink).count() == 90
    with pytest.raises(ValueError, match="differs"):
        other = bd.plan_from_catalog(pl.plan_slots(spark, 90), catalog, bd.BuildConfig(seed=10))
        bd.build_dataset(spark, other, gen.offline_backend(9), out, cfg)


def test_pool_draw_drops_and_multiplies_nothing(spark):
    plan = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(100)], "slot_id long, category string")
    pool = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q")], "category string, item_id long, base_prompt string")
    with pytest.raises(Exception, match="no pool items for category b"):
        sa.uniform_pool_draw(plan, pool, 1).collect()
    assert sa.uniform_pool_draw(plan.where("category = 'a'"), pool, 1).count() == 50
    with pytest.raises(ValueError, match="more than once"):
        sa.uniform_pool_draw(plan, pool.unionAll(pool), 1)


def test_hot_one_item_category_is_spread(spark):
    """Half of all draws go to one item: its rows meet under many salts."""
    plan = spark.range(200_000).selectExpr("id AS slot_id", "IF(id % 2 = 0, 'one', 'many') AS category")
    pool = spark.createDataFrame([("one", 10**6, "x")], "category string, item_id long, base_prompt string").unionByName(
        spark.range(1000).selectExpr("'many' AS category", "id AS item_id", "concat('b', id) AS base_prompt"))
    drawn = sa.uniform_pool_draw(plan, pool, 4)
    assert drawn.count() == 200_000 and drawn.where("base_prompt IS NULL").isEmpty()
    assert drawn.where("item_id = 1000000").count() == 100_000
    plan_text = drawn._jdf.queryExecution().optimizedPlan().toString()
    # the texts, too, are joined under the salt
    assert any("item_id" in j and "_up_s" in j for j in plan_text.splitlines() if "Join LeftOuter" in j)


def test_heavy_weights_are_a_distributed_range(spark):
    """A weight of 10**7 is no array; wide columns are held once per category."""
    wide = "p" * 10_000
    weights = spark.createDataFrame([("a", 10**7, wide), ("b", 3, wide), ("z", 0, wide)],
                                    "category string, weight long, gen_system string")
    slots = sa.weighted_slots(weights)
    assert {r[0]: r[1] for r in slots.groupBy("category").count().collect()} == {"a": 10**7, "b": 3}
    assert slots.selectExpr("count(DISTINCT slot)", "max(slot)").first()[1] == 10**7 + 2
    drawn = sa.weighted_draw(pl.plan_slots(spark, 500), weights, 4, extra=("gen_system",))
    assert drawn.where(F.length("gen_system") == 10_000).count() == 500


def test_many_categories_take_disjoint_ranges(spark):
    weights = spark.range(5000).selectExpr("concat('c', id) AS category", "id % 7 AS weight")
    bounds = sa.category_bounds(sa._once(weights, ["category", "weight"], ["category"])).collect()
    spans = sorted((r.lo, r.hi) for r in bounds)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(r.category for r in bounds) == [r.category for r in sorted(bounds, key=lambda r: r.lo)]


def test_null_category_is_an_error(spark):
    weights = spark.createDataFrame([(None, 2), ("b", 3)], "category string, weight long")
    with pytest.raises(ValueError, match="null"):
        sa.weighted_draw(pl.plan_slots(spark, 5), weights, 4)


def test_generation_tasks_grow_with_rows(spark):
    cfg = bd.BuildConfig(rows_per_task=10)
    few = spark.sparkContext.defaultParallelism
    assert bd.tasks_for(spark, 5, cfg) == few
    assert bd.tasks_for(spark, 10 * (few + 7), cfg) == few + 7
    assert bd.tasks_for(spark, 10**6, bd.BuildConfig(partitions=3)) == 3


def test_null_prompt_is_an_error_row(spark):
    plan = spark.createDataFrame([(1, "messages_api", "s", None), (2, "single_prompt", "s", None),
                                  (3, "single_prompt", "s", "hello"), (4, "unheard_of", "s", "hello")],
                                 "slot_id long, provider string, gen_system string, user_prompt string")
    out = gen.extract_response(gen.bulk_generate(gen.shape_request(plan).drop("request"),
                                                 gen.offline_backend(1, fault_every=0)))
    got = {r.slot_id: (r.text, r.error) for r in out.collect()}
    assert got[1] == got[2] == got[4] == (None, gen.ERR_NO_REQUEST)
    assert got[3][0] and got[3][1] is None


def test_failures_keep_the_latest_attempt(spark):
    res = spark.createDataFrame(
        [(1, "p", "q", "r2", None, "second"), (1, "p", "q", "r1", None, "first"), (2, "p", "q", "r1", None, "first"),
         (2, "p", "q", "r2", "fine", None)],
        "slot_id long, provider string, user_prompt string, run_id string, text string, error string")
    ok, failed = bd.records_from_results(res, bd.BuildConfig())
    assert [(r.slot_id, r.error, r.attempts) for r in failed.collect()] == [(1, "second", 2)]
    assert [r.slot_id for r in ok.collect()] == [2]
