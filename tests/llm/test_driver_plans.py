"""What the driver plans and takes in stays small: it plans every round of the
pipeline's near duplicates, and holds the plans, stages and results of all."""

import random
import re

import numpy as np
import pyarrow as pa

from dialforge.llm import components, substring
from dialforge.llm import text as tx


def planned(monkeypatch):
    """The exchanges of each plan that components writes."""
    found, write = [], components.written

    def written(df, name):
        found.append((name, len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString()))))
        return write(df, name)

    monkeypatch.setattr(components, "written", written)
    return found


def smallest(links):
    """node -> the smallest node it reaches."""
    least = {x: x for pair in links if pair[0] != pair[1] for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def test_stars_take_no_round(spark, monkeypatch):
    found = planned(monkeypatch)
    links = [(9, 1), (1, 8), (7, 1), (7, 1), (5, 2), (3, 3)]
    got = {r["node"]: r["component"] for r in components.connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == smallest(links) and [name for name, _ in found] == ["links"]


def test_rounds_are_small_plans(spark, monkeypatch):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 130)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(-5, i) for i in range(200, 260)]
    found = planned(monkeypatch)
    rows = components.connected(spark.createDataFrame(links, "u long, v long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == smallest(links)
    assert len(found) > 2 and max(n for _, n in found) <= 3


def test_merged_sketch_travels_compressed():
    cells = np.array([3, 70, 1 << substring.SHARD_BITS - 1])
    part = pa.RecordBatch.from_arrays([pa.array([5], pa.int32()), pa.array([0], pa.int32()), pa.array([substring._squeeze(cells[:0])]),
                                       pa.array([substring._squeeze(cells)])], ["shard", "salt", "once", "more"])
    [out] = substring._merge_body(True)([part])
    assert out.column("shard").to_pylist() == [5] and out.nbytes < 1 << 12


def test_sketch_lets_every_repeat_through(spark, table):
    rng = random.Random(5)
    passage = " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(50))
    rows = [(i, " ".join(f"{rng.randrange(10 ** 6)}" for _ in range(60)) + " " + (passage if i < 2 else "")) for i in range(6)]
    bits = substring.sketch(table(rows))
    for i, text in rows:
        [(_, _, buf, offs)] = tx.chunks(pa.array([text]))
        w = substring.Windows(buf, offs, substring.WIDTH)
        passed = int(substring.maybe_repeated(w.anchors()[0][w.valid], bits).sum())
        assert passed >= 16 if i < 2 else passed == 0
