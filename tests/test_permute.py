"""Keyed permutations, and the manifest made of them."""

import pytest
from pyspark.sql import functions as F

from dialforge.functions import permute as pm
from dialforge.operators import split as sp
from dialforge.session import scratch_path


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 100, 1025, 4096, 5000])
def test_every_place_once(n):
    got = [pm.permuted_py(i, n, 7, "epoch:0") for i in range(n)]
    assert sorted(got) == list(range(n))
    if n > 50:
        assert got != [pm.permuted_py(i, n, 7, "epoch:1") for i in range(n)] != [pm.permuted_py(i, n, 8, "epoch:1") for i in range(n)]


def test_neighbours_are_torn_apart():
    n = 4001
    got = [pm.permuted_py(i, n, 3, "t") for i in range(n)]
    near = sum(abs(a - b) <= 16 for a, b in zip(got, got[1:])) / n
    assert near < 3 * 33 / n                            # as in a random order
    half = sum(g < n // 2 for g in got[: n // 2])
    assert abs(half - n / 4) < 4 * (n / 16) ** 0.5 + 1


@pytest.mark.parametrize("n", [1, 2, 3, 100, 1025])
def test_native_equals_python(spark, n):
    rows = spark.range(n).select("id", pm.permuted(F.col("id"), n, 5, "x").alias("p")).collect()
    assert {r["id"]: r["p"] for r in rows} == {i: pm.permuted_py(i, n, 5, "x") for i in range(n)}


def test_large_domains(spark):
    n = (1 << 62) - 12345
    rows = spark.createDataFrame([(0,), (n - 1,), (n // 3,)], "id long").select("id", pm.permuted(F.col("id"), n, 5, "x").alias("p")).collect()
    assert {r["id"]: r["p"] for r in rows} == {i: pm.permuted_py(i, n, 5, "x") for i in (0, n - 1, n // 3)}
    with pytest.raises(ValueError):
        pm.permuted(F.col("id"), 0, 1, "x")


def test_manifest_plan_and_files(spark):
    ids = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 50))
    manifest = sp.permuted_manifest(ids, "id", epochs=3)
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("epoch" in line for line in exchanges)
    generate = next(i for i, line in enumerate(plan.splitlines()) if "Generate" in line)
    assert not any("Window" in line or "Exchange" in line for line in plan.splitlines()[:generate])     # fanned out last
    path = scratch_path(spark, "manifest")
    sp.write_positions(manifest, path, 1000, 3, rows_per_file=300)
    back = spark.read.parquet(path)
    for e in range(3):
        got = sorted((r["position"], r["micro_batch"], r["step"]) for r in back.where(F.col("epoch") == e).collect())
        assert got == [(i, i // 4, i // 16) for i in range(1000)]
    spans = sorted(tuple(r)[1:] for r in back.groupBy(F.input_file_name(), "epoch").agg(F.min("position").alias("lo"), F.max("position").alias("hi")).collect())
    assert len(spans) == 12
    assert sp.permuted_manifest(spark.range(0), "id").isEmpty()
