"""The sliding window of calls: order of ends, bytes, failures."""

import threading
import time

import pyarrow as pa
from pyspark.sql import functions as F

from dialforge.operators import generation as gen


def _batches(rows, per_batch):
    for lo in range(0, len(rows), per_batch):
        part = rows[lo:lo + per_batch]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.string()),
                                          pa.array([f"x{r[0]}" for r in part], pa.string())], ["slot_id", "body", "tag"])


def _run(rows, call, calls=4, budget=gen.BYTE_BUDGET, per_batch=5):
    window = gen._Window(gen._safe(call), calls, budget)
    out = []
    for rb in gen._generated(_batches(rows, per_batch), window, ["slot_id", "body"], ["slot_id", "tag"]):
        out += [tuple(r.values()) for r in rb.to_pylist()]
    return out, window


def test_a_slow_call_holds_up_no_other(monkeypatch):
    monkeypatch.setattr(gen, "OUT_ROWS", 1)
    last = threading.Event()

    def call(rec):
        if rec["slot_id"] == 2:
            assert last.wait(20), "the rows after the slow one were never called"
        if rec["slot_id"] == 39:
            last.set()
        return rec["body"]

    out, _ = _run([(i, f"b{i}") for i in range(40)], call)
    assert sorted(out) == [(i, f"x{i}", f"b{i}", None) for i in range(40)]
    order = [r[0] for r in out]
    assert order.index(2) > order.index(30)         # handed on long after rows of later batches


def test_long_prompts_stay_below_the_byte_budget(monkeypatch):
    flying, most, lock = [0], [0], threading.Lock()

    def call(rec):
        with lock:
            flying[0] += len(rec["body"])
            most[0] = max(most[0], flying[0])
        time.sleep(0.002)
        with lock:
            flying[0] -= len(rec["body"])
        return rec["body"] * 2

    rows = [(i, "y" * (700 if i % 9 else 5000)) for i in range(120)]
    out, window = _run(rows, call, calls=8, budget=3000, per_batch=120)
    assert sorted((r[0], len(r[2])) for r in out) == [(i, 2 * len(b)) for i, b in rows]
    assert most[0] <= window.most_bytes <= 5000     # a prompt larger than the budget goes alone
    sizes = []
    for rb in gen._generated(_batches(rows, 120), gen._Window(gen._safe(call), 8, 3000), ["slot_id", "body"], ["slot_id"]):
        sizes.append(sum(len(x) for x in rb.column(1).to_pylist()))
    assert max(sizes) <= 3000 + 8 * 10_000          # what ended at once


def test_failures_nulls_and_empty_batches():
    def call(rec):
        if rec["slot_id"] % 3 == 0:
            raise ValueError("no")
        return None if rec["slot_id"] % 5 == 0 else "ok"

    rows = [(i, None if i == 7 else "b") for i in range(20)]
    for calls in (1, 3):
        out, window = _run(rows, call, calls=calls)
        assert sorted(r[0] for r in out) == list(range(20)) and not window.flying
        by = {r[0]: r[2:] for r in out}
        assert by[3] == (None, "ValueError: no") and by[5] == (None, None) and by[7] == (None, gen.ERR_NO_REQUEST) and by[1] == ("ok", None)
    assert _run([], call)[0] == []


def test_on_spark_with_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        reqs = spark.range(100).select(F.col("id").alias("slot_id"), F.lit("messages_api").alias("provider"), F.col("id").cast("string").alias("body"))
        got = gen.bulk_generate(reqs, lambda rec: rec["body"] + "!", concurrency=5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["slot_id"], r["raw"], r["error"]) for r in got) == [(i, f"{i}!", None) for i in range(100)]
