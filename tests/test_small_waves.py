"""Waves of few slots share a job; each is committed as its task ends."""

import os

import pytest
from pyspark.sql import functions as F

from dialforge.operators import generation as gen
from dialforge.operators import resume as rs
from dialforge.plans import build_dataset as bd
from dialforge.session import scratch_path


def _plan(spark, n):
    return spark.range(n).select(F.col("id").alias("slot_id"), F.lit("c").alias("category"), F.lit("s").alias("gen_system"),
                                 F.concat(F.lit("p "), "id").alias("user_prompt"), F.lit("messages_api").alias("provider"))


def test_waves_do_not_cost_a_job_each(spark):
    sc, out = spark.sparkContext, scratch_path(spark, "few-jobs")
    cfg = bd.BuildConfig(seed=2, wave_size=10)
    sc.setJobGroup("few-jobs", "")
    try:
        bd.generate(spark, _plan(spark, 1200), gen.offline_backend(2, fault_every=0), out, cfg)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("few-jobs")) < 60
    files = spark.read.parquet(out).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.count("*").alias("n"), F.min("slot_id").alias("lo"), F.max("slot_id").alias("hi")).orderBy("lo").collect()
    assert [(r["n"], r["lo"], r["hi"]) for r in files] == [(10, i, i + 9) for i in range(0, 1200, 10)]


def test_a_crash_keeps_the_waves_that_ended(spark):
    out, sound = scratch_path(spark, "crash"), gen.offline_backend(2, fault_every=0)

    def dies(rec):
        if rec["slot_id"] == 395:
            os._exit(1)
        return sound(rec)

    dies.concurrency = 1
    cfg = bd.BuildConfig(seed=2, wave_size=10)
    with pytest.raises(Exception):
        bd.build_dataset(spark, _plan(spark, 400), dies, out, cfg)
    kept = spark.read.parquet(f"{out}/results").count()
    assert 0 < kept < 400 and kept % 10 == 0
    got = bd.build_dataset(spark, _plan(spark, 400), sound, out, cfg)
    assert sorted(r[0] for r in got["results"].select("slot_id").collect()) == list(range(400))
    assert got["run_metrics"].first()["attempted"] == 400 - kept


def test_sparse_slots_are_compared_as_keys(spark):
    sparse = spark.range(20_000).select((F.col("id") * 1_048_575).alias("slot_id"))
    assert rs.far_apart(sparse) and not rs.far_apart(spark.range(20_000).withColumnRenamed("id", "slot_id"))
