"""Randomised properties (few examples each: every example is a Spark job)."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dialforge.operators import split as sp
from dialforge.operators import tokens as tk

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

words = st.text(alphabet="abcé,.", min_size=1, max_size=4)
gaps = st.sampled_from([" ", "  ", "\n", "\t", " \n ", "\r\n"])


@st.composite
def texts(draw):
    ws = draw(st.lists(words, min_size=0, max_size=12))
    lead = draw(st.sampled_from(["", " ", "\n "]))
    tail = draw(st.sampled_from(["", " ", "\n"]))
    body = "".join(w + (draw(gaps) if i < len(ws) - 1 else "") for i, w in enumerate(ws))
    return lead + body + tail


def py_cap(text, cap):
    toks = list(re.finditer(r"\S+", text))
    if len(toks) <= cap:
        return len(toks), False, text
    return len(toks), True, text[: toks[cap - 1].end()]


@SETTINGS
@given(st.lists(texts(), min_size=1, max_size=6), st.integers(min_value=1, max_value=5))
def test_cap_matches_python(spark, batch, cap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i long, text string")
    got = {r.i: (r.n_tokens, r.truncated, r.text_capped)
           for r in tk.truncate_tokens(df, "text", cap=cap).collect()}
    assert got == {i: py_cap(t, cap) for i, t in enumerate(batch)}


@SETTINGS
@given(st.integers(min_value=1, max_value=400), st.integers(min_value=0, max_value=10**6))
def test_split_exact_size(spark, n, seed):
    df = spark.range(n).withColumnRenamed("id", "rid")
    rows = sp.train_eval_split(df, "rid", seed=seed).collect()
    assert sorted(r.rid for r in rows) == list(range(n))
    assert sum(r.split == "eval" for r in rows) == math.ceil(0.05 * n)


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**6), min_size=1, max_size=6).filter(
    lambda ws: sum(ws) > 0), st.integers(min_value=1, max_value=64))
def test_weighted_draw_matches_python(spark, weights, bins):
    from dialforge.functions.draw import u_py
    from dialforge.operators import planning as pl
    from dialforge.operators import sampling as sa

    rows = [(f"c{i}", w) for i, w in enumerate(weights)]
    wdf = spark.createDataFrame(rows, "category string, weight long")
    got = {r.slot_id: r.category
           for r in sa.weighted_draw(pl.plan_slots(spark, 200), wdf, 5, bins=bins).collect()}
    total, lo, bounds = sum(weights), 0, []
    for c, w in sorted(rows):
        if w:
            bounds.append((c, lo, lo + w))
            lo += w
    want = {i: next(c for c, a, b in bounds if a <= u_py(5, i, "cat") % total < b) for i in range(200)}
    assert got == want
