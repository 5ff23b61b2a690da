"""Slot bitmaps and waves, the sink's commit log, and ids of records without one."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dialforge.operators import generation as gen
from dialforge.operators import identity
from dialforge.operators import planning as pl
from dialforge.operators import resume as rs
from dialforge.operators import split as sp
from dialforge.plans import build_dataset as bd
from dialforge.session import scratch_path
from dialforge.sources import catalog as cat
from dialforge.sources import sink as sk


def _keys(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "slot_id long")


# -- bitmaps and waves --------------------------------------------------------

EDGES = [-70000, -32769, -32768, -32767, -1, 0, 1, 2, 31, 32, 33, 32767, 32768, 32769, 65536, 65537, 10 ** 12, 10 ** 12 + 5]


@pytest.mark.parametrize("wave_size", [1, 7, 1000])
def test_waves_are_even_and_whole(spark, wave_size):
    rng = random.Random(wave_size)
    plan = sorted({*EDGES, *rng.sample(range(200_000), 3000)})
    done = sorted({*rng.sample(plan, 1200), -32768, 32768, 999_999})        # one of them in no plan
    left = [s for s in plan if s not in set(done)]
    waves = bd.todo_waves(spark, _keys(spark, plan + []), _keys(spark, done + done[:50]), wave_size)
    got = sorted((r["wave"], r["slot_id"]) for r in waves.collect())
    assert got == [(i // wave_size, s) for i, s in enumerate(left)]
    bounds = rs.waves_of(waves)
    assert [w.rows for w in bounds[:-1]] == [wave_size] * (len(bounds) - 1)
    assert [(w.first, w.last) for w in bounds] == [(left[i], left[min(i + wave_size, len(left)) - 1]) for i in range(0, len(left), wave_size)]


def test_keys_far_apart_give_the_same(spark, monkeypatch):
    plan, done = [i * 10 ** 9 for i in range(300)], [i * 10 ** 9 for i in range(0, 300, 3)]
    want = sorted(tuple(r) for r in bd.todo_waves(spark, _keys(spark, plan), _keys(spark, done), 64).collect())
    monkeypatch.setattr(rs, "far_apart", lambda plan: True)
    assert sorted(tuple(r) for r in bd.todo_waves(spark, _keys(spark, plan), _keys(spark, done), 64).collect()) == want
    assert len(want) == 200


def test_nothing_left_and_repeated_slots(spark):
    keys = _keys(spark, range(100))
    assert bd.todo_waves(spark, keys, keys, 10).isEmpty()
    assert bd.todo_waves(spark, _keys(spark, []), keys, 10).isEmpty()
    with pytest.raises(ValueError, match="unique"):
        bd.todo_waves(spark, _keys(spark, [1, 2, 2]), None, 10)
    with pytest.raises(ValueError, match="null"):
        bd.generate(spark, _keys(spark, [1, None]), gen.offline_backend(1), scratch_path(spark, "null"), bd.BuildConfig())


def test_no_text_is_read_to_cut_waves(spark):
    path = scratch_path(spark, "bits")
    wide = spark.range(1000).select(F.col("id").alias("slot_id"), F.repeat(F.lit("x"), 200).alias("user_prompt"),
                                    F.lit(None).cast("string").alias("error"))
    wide.write.parquet(path)
    stored = spark.read.parquet(path)
    left = rs.slots_left(rs.slot_bitmaps(stored), rs.slot_bitmaps(gen.successes(stored)))
    scans = [line for line in left._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert len(scans) == 2 and all("user_prompt" not in line.split("ReadSchema")[1] for line in scans)


def test_resumed_waves_stay_below_the_wave_size(spark):
    """The untouched tail after a partial run falls into even commits."""
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=5, wave_size=50, partitions=2)
    out = scratch_path(spark, "uneven")
    full = bd.plan_from_catalog(pl.plan_slots(spark, 400), catalog, cfg)
    bd.build_dataset(spark, full.where("slot_id < 300"), gen.offline_backend(5, fault_every=8), out, cfg)
    stored = spark.read.parquet(f"{out}/plan")
    done = bd.successful_keys(spark, f"{out}/results")
    n_left = 300 - done.count() + 100
    sizes = [rows for rows, _ in bd._waves(spark, full, done, cfg)]
    assert stored.count() == 300 and sum(sizes) == n_left and max(sizes) <= 50 and sizes[:-1] == [50] * (len(sizes) - 1)
    parts = [p.select("slot_id") for _, p in bd._waves(spark, full, done, cfg)]
    assert [p.count() for p in parts] == sizes
    res = bd.build_dataset(spark, full, gen.offline_backend(5, fault_every=0), out, cfg)
    assert sorted(r[0] for r in res["records"].select("slot_id").collect()) == list(range(400))


def test_plan_is_laid_out_without_sampling(spark):
    cfg = bd.BuildConfig(partitions=4)
    laid = bd.in_slot_order(spark.range(10, 410).withColumnRenamed("id", "slot_id"), cfg)
    assert "rangepartitioning" not in laid._jdf.queryExecution().executedPlan().toString()
    spans = sorted((r["lo"], r["hi"]) for r in laid.groupBy(F.spark_partition_id().alias("p"))
                   .agg(F.min("slot_id").alias("lo"), F.max("slot_id").alias("hi")).collect())
    assert len(spans) == 4 and spans[0][0] == 10 and spans[-1][1] == 409 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert bd.in_slot_order(_keys(spark, []), cfg).isEmpty()
    assert bd.in_slot_order(_keys(spark, [1, 10 ** 15]), cfg).count() == 2


# -- sink ---------------------------------------------------------------------

def _records(spark, lo, hi):
    return spark.range(lo, hi, 1, 3).select(F.col("id").alias("slot_id"), F.concat(F.lit("é "), "id").alias("category"))


SCHEMA = "slot_id long, category string"


def _lines(spark, path):
    return sorted(r[0] for r in spark.read.schema(SCHEMA).json(path).collect())


def test_commits_once_in_order(spark, tmp_path):
    path = str(tmp_path / "sink.jsonl")
    a = sk.append(_records(spark, 0, 10), path, ["r1"])
    assert (a.number, a.rows, a.first, a.last) == (0, 10, 0, 9)
    assert sk.append(_records(spark, 0, 10), path, ["r1"]) is None            # exported before
    b = sk.append(_records(spark, 10, 15), path, ["r2", "r3"])
    c = sk.append(_records(spark, 15, 15), path, ["r4"])                      # nothing to say, but said
    assert [x.number for x in sk.commits(spark, path)] == [0, 1, 2] and (c.rows, c.first) == (0, None)
    assert sk.exported_runs(sk.commits(spark, path)) == ["r1", "r2", "r3", "r4"]
    assert _lines(spark, path) == list(range(15)) == sorted(r[0] for r in sk.read_committed(spark, path, SCHEMA).collect())
    by = {r["commit"]: r["n"] for r in sk.read_committed(spark, path, SCHEMA, numbers=True).groupBy("commit").agg(F.count("*").alias("n")).collect()}
    assert by == {0: 10, 1: 5} and b.rows == 5


def test_crash_before_the_commit_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "sink.jsonl")
    sk.append(_records(spark, 0, 4), path, ["r1"])
    sk.stage(_records(spark, 4, 9), path)
    assert _lines(spark, path) == [0, 1, 2, 3] and len(sk.recover(spark, path)) == 1
    sk.append(_records(spark, 4, 9), path, ["r2"])
    assert _lines(spark, path) == list(range(9)) and not (tmp_path / "sink.jsonl" / "_staged").exists()


def test_crash_after_the_commit_is_finished_later(spark, tmp_path):
    path = str(tmp_path / "sink.jsonl")
    staged = sk.stage(_records(spark, 0, 6), path)
    log = tmp_path / "sink.jsonl" / "_log"
    log.mkdir()
    entry = dict(number=0, commit=staged.commit, runs=["r1"], files=staged.files, rows=6, first=0, last=5)
    (log / f"{0:020d}.json").write_text(json.dumps(entry))                   # the entry is there, no file has moved
    first = tmp_path / "sink.jsonl" / staged.files[0]
    (tmp_path / "sink.jsonl" / "_staged" / staged.commit / staged.files[0]).rename(first)       # or only one
    assert sorted(r[0] for r in sk.read_committed(spark, path, SCHEMA).collect()) == list(range(6)) == _lines(spark, path)
    assert sk.append(_records(spark, 0, 6), path, ["r1"]) is None


def test_two_writers_of_one_number(spark, tmp_path):
    path = str(tmp_path / "sink.jsonl")
    log = sk.recover(spark, path)
    one, two = sk.stage(_records(spark, 0, 3), path), sk.stage(_records(spark, 0, 3), path)
    sk.commit(spark, path, one, ["r1"], log)
    with pytest.raises(Exception, match="exist"):
        sk.commit(spark, path, two, ["r1"], log)
    assert _lines(spark, path) == [0, 1, 2] and len(sk.commits(spark, path)) == 1


def test_lines_of_another_writer_are_taken_over(spark, tmp_path):
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=4)
    out, path = str(tmp_path / "b"), str(tmp_path / "records.jsonl")
    plan = bd.plan_from_catalog(pl.plan_slots(spark, 30), catalog, cfg)
    res = bd.build_dataset(spark, plan, gen.offline_backend(4, fault_every=0), out, cfg)
    res["records"].where("slot_id < 12").select("slot_id", "provider", "messages", "category").write.json(path)
    for _ in range(2):
        bd.build_dataset(spark, plan, gen.offline_backend(4, fault_every=0), out, cfg, export_path=path)
        assert sorted(r[0] for r in spark.read.schema("slot_id long").json(path).collect()) == list(range(30))
    assert [(c.number, c.rows) for c in sk.commits(spark, path)] == [(0, 12), (1, 18)]


def test_export_reads_no_old_line(spark, tmp_path):
    catalog = cat.read_catalog(spark)
    cfg = bd.BuildConfig(seed=4)
    out, path = str(tmp_path / "b"), str(tmp_path / "records.jsonl")
    for n in (20, 35):
        plan = bd.plan_from_catalog(pl.plan_slots(spark, n), catalog, cfg)
        bd.build_dataset(spark, plan, gen.offline_backend(4, fault_every=0), out, cfg, export_path=path)
        for part in (tmp_path / "records.jsonl").glob("part-*"):       # would fail if it were parsed strictly or by key
            part.write_text('{"slot_id": "not to be read"}\n' * 3)
    assert [(c.rows, c.first, c.last) for c in sk.commits(spark, path)] == [(20, 0, 19), (15, 20, 34)]


# -- identity -----------------------------------------------------------------

def _bag(spark, rows, parts):
    schema = "messages array<struct<role:string,content:string>>, category string, slot_id long"
    return spark.createDataFrame(rows, schema).repartition(parts)


ROWS = ([([("user", "hot"), ("assistant", "x")], "c", None)] * 700 + [([("user", f"q{i % 40}")], "c", None) for i in range(200)]
        + [([("user", None)], None, None), (None, "c", None), ([], "c", None), ([("user", "")], None, None)] * 2
        + [([("user", "own")], "c", 5), ([("user", "own")], "c", 5), ([("user", "own")], "c", 6)])


@pytest.mark.parametrize("parts, held", [(1, 1 << 18), (7, 1 << 18), (16, 5)])
def test_ids_do_not_depend_on_the_layout(spark, parts, held):
    made = identity.with_record_id(_bag(spark, ROWS, parts), identity.record_content(), own="slot_id", held=held)
    split = sp.train_eval_split(made, "record_id", check_unique=True)
    got = sorted((r["record_id"], r["split"], str(r["messages"])) for r in split.collect())
    assert len(got) == len(ROWS)
    ids = [g[0] for g in got]
    hot = identity.with_record_id(_bag(spark, ROWS[:1], 1), identity.record_content()).first()["record_id"].split("-")[0]
    assert {f"{hot}-{i}" for i in range(700)} <= set(ids) and {"5", "5-1", "6"} <= set(ids)
    assert sum(g[1] == "eval" for g in got) == -(-len(ROWS) * 5 // 100)
    test_ids_do_not_depend_on_the_layout.seen = seen = getattr(test_ids_do_not_depend_on_the_layout, "seen", got)
    assert got == seen


def test_different_records_have_different_content(spark):
    rows = [([("user", "ab")], "c", 0), ([("usera", "b")], "c", 0), ([("user", "a"), ("b", None)], "c", 0), ([("user", "-")], None, 0),
            ([("user", None)], "-", 0), ([("user", None)], None, 0), ([], None, 0), (None, None, 0), ([("user", "a3:b")], "c", 0), ([("user", "a"), ("b", "")], "c", 0)]
    assert _bag(spark, rows, 2).select(identity.record_content()).distinct().count() == len(rows)


def test_hot_record_is_no_single_task(spark):
    """Only counts a stretch meet in the window, never the copies."""
    plan = identity.number_copies(_bag(spark, ROWS, 8).select("category"), "category")._jdf.queryExecution().executedPlan().toString()
    window = plan.index("Window")
    assert "HashAggregate" in plan[window:] and "_stretch" in plan[window:]
