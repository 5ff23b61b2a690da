"""Plans that name pool items: texts neither stored nor shuffled with each slot."""

import pathlib

import pytest
from pyspark.sql import functions as F

from dialforge.operators import generation as gen
from dialforge.operators import planning as pl
from dialforge.operators import sampling as sa
from dialforge.plans import build_dataset as bd
from dialforge.session import scratch_path

KEY = ["slot_id", "category", "provider", "item_id", "user_prompt", "text", "error"]


def _pool(spark, n=12):
    """Items of 3,200 characters that do not compress, and a category of one item."""
    text = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{i}")), 256) for i in range(50)])
    return spark.range(n).select(F.when(F.col("id") == 0, "one").otherwise("many").alias("category"),
                                 F.col("id").alias("item_id"), F.when(F.col("id") != 5, text).alias("base_prompt"))


def _weights(spark):
    return spark.createDataFrame([("one", 3, "s1"), ("many", 2, "s2")], "category string, weight long, gen_system string")


def _plan(spark, n, cfg, texts=False, pool=None):
    return bd.plan_from_pool(pl.plan_slots(spark, n), pool or _pool(spark), _weights(spark), cfg, texts=texts)


def _rows(df):
    return sorted(map(tuple, df.select(*KEY).collect()), key=str)


def _bytes(path):
    return sum(p.stat().st_size for p in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet"))


@pytest.mark.parametrize("wave_size, draws_per_key", [(None, 10_000), (700, 60)])
def test_named_items_give_the_rows_of_composed_plans(spark, monkeypatch, wave_size, draws_per_key):
    monkeypatch.setattr(sa, "DRAWS_PER_KEY", draws_per_key)
    cfg = bd.BuildConfig(seed=7, second_provider="single_prompt", wave_size=wave_size)
    call = gen.offline_backend(7, fault_every=6)
    whole = bd.build_dataset(spark, _plan(spark, 2000, cfg, texts=True), call, scratch_path(spark, "texts"), cfg)
    named = bd.build_dataset(spark, _plan(spark, 2000, cfg), call, scratch_path(spark, "items"), cfg, pool=_pool(spark))
    assert _rows(named["results"]) == _rows(whole["results"]) and named["results"].count() == 2000
    assert "user_prompt" not in named["plan"].columns


def test_a_text_is_not_stored_with_each_slot(spark):
    cfg = bd.BuildConfig(seed=7)
    out = scratch_path(spark, "small")
    got = bd.build_dataset(spark, _plan(spark, 6000, cfg), gen.offline_backend(7, fault_every=0), out, cfg, pool=_pool(spark))
    written = got["results"].agg(F.sum(F.length("user_prompt") + F.length("text"))).first()[0]
    assert _bytes(out) < written // 20


def test_named_items_resume_in_waves(spark, monkeypatch):
    monkeypatch.setattr(sa, "DRAWS_PER_KEY", 60)
    cfg = bd.BuildConfig(seed=8, wave_size=300, export_codec="gzip", rows_per_task=100)
    out = scratch_path(spark, "resume-items")
    first = bd.build_dataset(spark, _plan(spark, 500, cfg), gen.offline_backend(8, fault_every=4), f"{out}/b", cfg, pool=_pool(spark))
    lost = first["failures"].count()
    assert lost > 50
    for _ in range(2):
        full = bd.build_dataset(spark, _plan(spark, 900, cfg), gen.offline_backend(8, fault_every=0), f"{out}/b", cfg,
                                export_path=f"{out}/records.jsonl", pool=_pool(spark))
    sent = 900 - full["plan"].where("item_id = 5").count()     # an item without text is an error row, never sent
    assert full["results"].where("error is null").select("slot_id").distinct().count() == sent == full["records"].count()
    lines = spark.read.schema("slot_id long").json(f"{out}/records.jsonl").select("slot_id", F.col("_metadata.file_name").alias("file"))
    assert lines.count() == sent == lines.select("slot_id").distinct().count()
    sizes = lines.groupBy("file").count().collect()
    assert all(r["file"].endswith(".json.gz") and r["count"] <= 100 for r in sizes)
    other = _pool(spark).withColumn("base_prompt", F.when(F.col("item_id") == 3, "new").otherwise(F.col("base_prompt")))
    with pytest.raises(ValueError, match="pool differs"):
        bd.build_dataset(spark, _plan(spark, 900, cfg), gen.offline_backend(8), f"{out}/b", cfg, pool=other)


def test_a_missing_item_fails(spark):
    cfg = bd.BuildConfig(seed=9)
    with pytest.raises(Exception, match="no pool item"):
        bd.build_dataset(spark, _plan(spark, 300, cfg), gen.offline_backend(9), scratch_path(spark, "gone"), cfg,
                         pool=_pool(spark).where("item_id <> 4"))
