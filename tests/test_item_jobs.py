"""Builds over pool items: one job however many waves, texts escaped once an item."""

import os
import pathlib

import pytest
from pyspark.sql import functions as F

from dialforge.operators import generation as gen
from dialforge.operators import planning as pl
from dialforge.operators import sampling as sa
from dialforge.plans import build_dataset as bd
from dialforge.session import scratch_path

KEY = ["slot_id", "category", "provider", "item_id", "user_prompt", "text", "error"]
ODD = ['say "no"\\', "line\nnext\ttab\r\x01\x1f", "caf\u00e9 \u2028 \U0001f600", "", "</script> \x7f", None]


def _pool(spark, n=40):
    text = F.concat(F.element_at(F.array(*[F.lit(t) for t in ODD]), (F.col("id") % len(ODD) + 1).cast("int")), F.lit(" "), "id")
    return spark.range(n).select(F.lit("c").alias("category"), F.col("id").alias("item_id"), text.alias("base_prompt"))


def _plan(spark, n, cfg, texts=False):
    weights = spark.createDataFrame([("c", 1, 'sys "s"\n')], "category string, weight long, gen_system string")
    return bd.plan_from_pool(pl.plan_slots(spark, n), _pool(spark), weights, cfg, texts=texts)


def _rows(df):
    return sorted(map(tuple, df.select(*KEY).collect()), key=str)


def _files(path):
    return list(pathlib.Path(path.removeprefix("file:")).glob("part-*"))


@pytest.mark.parametrize("job_waves, jobs", [(10_000, 1), (7, 3)])
def test_waves_of_items_share_a_job(spark, monkeypatch, job_waves, jobs):
    monkeypatch.setattr(bd, "JOB_WAVES", job_waves)
    calls, with_items = [], sa.with_items
    monkeypatch.setattr(sa, "with_items", lambda *a, **k: calls.append(1) or with_items(*a, **k))
    cfg = bd.BuildConfig(seed=3, second_provider="single_prompt", wave_size=100)
    call = gen.offline_backend(3, fault_every=6)
    whole = bd.build_dataset(spark, _plan(spark, 2000, cfg, texts=True), call, scratch_path(spark, "texts"), cfg)
    named = bd.build_dataset(spark, _plan(spark, 2000, cfg), call, scratch_path(spark, "items"), cfg, pool=_pool(spark))
    assert _rows(named["results"]) == _rows(whole["results"]) and named["results"].count() == 2000
    assert len(calls) == jobs                                   # and not one for each of 20 waves


def test_a_crash_keeps_the_tasks_that_ended(spark):
    out, sound = scratch_path(spark, "item-crash"), gen.offline_backend(2, fault_every=0)
    cfg = bd.BuildConfig(seed=2, wave_size=100)
    last = _plan(spark, 3000, cfg).where("item_id % 6 <> 5").agg(F.max("slot_id")).first()[0]

    def dies(rec):
        if rec["slot_id"] == last:
            os._exit(1)
        return sound(rec)

    dies.concurrency = 1
    with pytest.raises(Exception):
        bd.build_dataset(spark, _plan(spark, 3000, cfg), dies, out, cfg, pool=_pool(spark))
    kept = spark.read.parquet(f"{out}/results")
    ok = kept.where("error is null").count()
    assert 0 < kept.count() < 3000 and kept.count() == kept.select("slot_id").distinct().count()
    got = bd.build_dataset(spark, _plan(spark, 3000, cfg), sound, out, cfg, pool=_pool(spark))
    sent = got["plan"].where("item_id % 6 <> 5").count()        # an item without text is never sent
    done = got["results"].where("error is null")
    assert done.count() == sent == done.select("slot_id").distinct().count()
    assert got["run_metrics"].first()["attempted"] == 3000 - ok


def test_the_slots_of_dense_bitmaps_are_taken_out_in_many_tasks(spark, monkeypatch):
    path = scratch_path(spark, "todo")
    monkeypatch.setattr(bd, "scratch_path", lambda *a: path)
    plan = spark.range(400_000).withColumnRenamed("id", "slot_id")
    waves = bd.todo_waves(spark, plan, plan.where("slot_id % 3 = 0"), 100_000)
    assert waves.count() == 266_666
    assert len(_files(f"{path}/left")) > 1


def test_bodies_of_escaped_prompts_are_the_same(spark):
    rows = [(i, f, s, p) for i, (f, s, p) in enumerate((f, s, p) for f in [*gen.FORMS, "other", None] for s in [*ODD] for p in ODD)]
    df = spark.createDataFrame(rows, "slot_id long, provider string, gen_system string, user_prompt string")
    pieces = F.concat(gen.json_inner(F.substr("user_prompt", F.lit(1), F.lit(7))), gen.json_inner(F.substr("user_prompt", F.lit(8))))
    was = gen.shape_request(df, models={"local_chat": 'm"1'})
    now = gen.shape_request(df.withColumn("j", pieces), models={"local_chat": 'm"1'}, user_json="j").drop("j")
    assert now.columns == was.columns
    assert sorted(map(tuple, now.collect()), key=lambda r: r[0]) == sorted(map(tuple, was.collect()), key=lambda r: r[0])


def test_batches_are_small_and_the_setting_goes_again(spark):
    long = spark.range(600).coalesce(1).select(F.col("id").alias("slot_id"), F.lit("messages_api").alias("provider"),
                                               F.repeat(F.lit("x"), 20_000).alias("body"))

    def sizes(batches):
        import pyarrow as pa
        for rb in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rb.nbytes])], names=["n"])

    def largest():
        return long.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    with gen.small_batches(spark):
        assert largest() < 2 * gen.BATCH_BYTES
    assert spark.conf.get(gen.BATCHES, None) is None and largest() > 8 * gen.BATCH_BYTES
    spark.conf.set(gen.BATCHES, "4m")
    try:
        with gen.small_batches(spark):
            assert spark.conf.get(gen.BATCHES) == "4m"
        assert spark.conf.get(gen.BATCHES) == "4m"
    finally:
        spark.conf.unset(gen.BATCHES)
