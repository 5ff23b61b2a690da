"""Hard negatives against a plain double loop, and the intervals against exact scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialforge.llm import hard_negatives as H
from dialforge.llm import queries as Q

SCHEMA = "vec_id long, embedding array<float>, label int, rid long, block string, scores string"


def brute(rows, every=100, positives=5, negatives=10):
    """``rows``: (vec_id, vector, label) that take part."""
    dim = max((len(v) for _, v, _ in rows), default=0)
    whole = [(i, [int(np.floor(256 * float(x))) for x in v] + [0] * (dim - len(v)), y) for i, v, y in rows]
    out = []
    for a, (i, v, y) in enumerate(whole):
        if i % every:
            continue
        near = sorted((-sum(p * q for p, q in zip(v, w)), j, z, b) for b, (j, w, z) in enumerate(whole) if b != a)
        for s, j, z, _ in [n for n in near if n[2] == y][:positives]:
            fit = [(t, k) for t, k, x, _ in near if x != y and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(fit[:negatives])]
    return sorted(out)


def relabelled():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("levels", [1, 3])
def test_intervals_hold_the_score(levels):
    rng = np.random.default_rng(levels)
    for dim in (1, 5, 64, 100):
        width = H.width_of(dim)
        v = np.floor(rng.normal(size=(200, dim)) * 256 * rng.choice([0.01, 1, 30], (200, 1))).astype(np.int64)
        v[0], v[1] = 0, v[2]
        codes, sizes = H.encode(v, width, levels)
        block = H.Block(np.arange(200), np.arange(200), np.zeros(200, np.int64), v, codes, sizes)
        for i in (0, 2, 7, 150):
            q, sure = H.Anchor(v[i], width), np.zeros(200)
            before = None
            for level in range(levels):
                low, high, sure = block.bounds(q, np.arange(200), level, sure)
                exact = v @ v[i]
                assert (low <= exact).all() and (exact <= high).all()
                assert before is None or np.median(high - low) <= before + 1e-6
                before = np.median(high - low)


def test_rotation_keeps_inner_products():
    x = np.random.default_rng(0).normal(size=(50, 128))
    assert np.allclose(H.rotated(x) @ H.rotated(x).T, x @ x.T)


def test_mined_rows(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 32))
    rows = [(i, (centres[i % 12] + rng.normal(size=32) * 0.7).astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(1500)]
    rows[500:900] = [(i, rows[500][1], i % 3) for i in range(500, 900)]                  # one vector, many ids
    rows += [(2000, [0.0] * 32, 1), (2001, [], 1), (2100, rows[3][1][:20], 4), (700, rows[700][1], 1), (100, rows[5][1], 2)]
    awkward = [(None, rows[0][1], 1), (3000, None, 1), (3100, [float("nan")] * 32, 1), (3200, [None] + rows[0][1][1:], 1),
               (3300, [float("inf")] * 32, 2), (3400, rows[0][1], None)]
    table = spark.createDataFrame([(*r, 1, "b", "s") for r in rows + awkward], SCHEMA)
    kept = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    got = sorted(tuple(r) for r in H.mine(table, label=relabelled()).collect())
    assert got == brute(kept) and len(got) > 400


def test_empty_and_lonely(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.mine(empty).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 1, 1, "b", "s")], SCHEMA)
    assert H.mine(alone).count() == 0
    with pytest.raises(ValueError):
        H.mine(spark.createDataFrame([(0, [3e30, 2.0], 1, 1, "b", "s")], SCHEMA))


def test_many_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(2).astype(np.float32).tolist(), int(i % 3)) for i in range(3100)]
    got = sorted(tuple(r) for r in H.mine(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect())
    assert got == brute(rows)


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert sorted(tuple(r) for r in Q.op11_hard_negatives(spark, path).collect()) == brute(rows)
