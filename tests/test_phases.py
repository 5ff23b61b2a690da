"""Two-phase preparation against the assembled way, and counts taken while writing."""

import random

from pyspark.sql import functions as F

from dialforge.operators import generation as gen
from dialforge.operators import messages as msg
from dialforge.operators import metrics as mt
from dialforge.operators import planning as pl
from dialforge.plans import build_dataset as bd
from dialforge.plans import prepare_training as pt
from dialforge.session import scratch_path
from dialforge.sources import catalog as cat

TURNS = "conv_id long, turn long, role string, text string"


def _turns(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(120):
        for t in range(rng.randint(0, 7)):
            turn = rng.choice([t, t, t, max(t - 1, 0), None]) if c % 7 == 0 else t      # ties and nulls
            role = rng.choice(["system", "user", "assistant", "user", "assistant", None if c % 11 == 0 else "tool"])
            rows.append((c, turn, role, rng.choice([None if c % 5 == 0 else "x", "hello there", "", "one two three"])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, TURNS)


def test_two_phases_equal_assembled_records(spark):
    for seed in (1, 2):
        turns = _turns(spark, seed)
        records = msg.assemble_from_turns(turns)
        want = pt.prepare(records, "conv_id", answered_only=True)
        got, judged = pt.prepare_turns(spark, turns, "conv_id")
        cols = ["conv_id", "split", "messages", "text", "n_tokens", "truncated", "text_capped"]
        assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
        assert 20 < got.count() < 110
        gone = {r[0] for r in judged.where("last is null").collect()}
        assert gone == {r[0] for r in pt.unanswered(records).select("conv_id").collect()}


def test_one_assembly_and_no_text_before_it(spark):
    path = scratch_path(spark, "turns")
    _turns(spark, 1).write.parquet(path)
    turns = spark.read.schema(TURNS).parquet(path)
    got, judged = pt.prepare_turns(spark, turns, "conv_id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("collect_list(") in (2, 3) and plan.count("partial_collect_list(") == 1
    scans = [line.split("ReadSchema")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert sum("text" in s for s in scans) == 1
    asked = pt.judge_turns(turns, "conv_id")._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in asked.splitlines() if "partial_max" in line)
    assert "collect_list" not in asked and "partial_min" in exchange       # what crosses the shuffle are two places a record


def test_no_turns(spark):
    got, _ = pt.prepare_turns(spark, spark.createDataFrame([], TURNS), "conv_id")
    assert got.isEmpty()


def test_counts_of_the_writes(spark):
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=6, wave_size=37, partitions=2, second_provider="local_chat")
    out = scratch_path(spark, "observed")
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 150), catalog, cfg)
    for fault_every, attempts in ((4, 150), (0, None), (0, 0)):
        got = bd.build_dataset(spark, plan, gen.offline_backend(6, fault_every=fault_every), out, cfg)
        assert "Scan" not in got["report"]._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
        report = {(r["section"], r["name"]): r["n"] for r in got["report"].collect()}
        metrics = got["run_metrics"].first()
        if attempts is None:
            attempts = failed
        failed = metrics["failed"]
        assert metrics["attempted"] == attempts == sum(n for (s, _), n in report.items() if s == "attempts by category")
        assert metrics["generated"] == sum(n for (s, _), n in report.items() if s == "successes by provider")
    runs = [r[0] for r in got["results"].select("run_id").distinct().collect()]
    assert len(runs) == 2       # the third run had nothing to do


def test_many_categories_are_read_back(spark, monkeypatch):
    monkeypatch.setattr(mt, "MOST_NAMES", 2)
    cfg = bd.BuildConfig(seed=6)
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 60), cat.read_catalog(spark), cfg)
    got = bd.build_dataset(spark, plan, gen.offline_backend(6, fault_every=0), scratch_path(spark, "many"), cfg)
    assert sum(r["n"] for r in got["report"].where("section = 'attempts by category'").collect()) == 60
    assert got["run_metrics"].first()["generated"] == 60
    assert got["report"].where(F.col("section") == "successes by provider").first()["n"] == 60
