"""The divergence audit against plain counting, on awkward rows and forced slices."""

import random
import re
from collections import Counter, defaultdict

import pytest

from dialforge.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, term string, h1 string, slice int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=30, top=50):
    """``rows``: (text, lang, source)."""
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        seen[lang or ""].update(set(found))
    out = []
    for lang, docs in seen.items():
        kept = sorted(t for t, n in docs.items() if n >= least)
        whole = Counter()
        groups = {s: {t: c[t] for t in kept} for (g, s), c in counts.items() if g == lang}
        for c in groups.values():
            whole.update(c)

        def shares(c):
            total = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def sample(n, seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéßЖ") for _ in range(r.randint(1, 4))) for _ in range(120)]
    rows = []
    for _ in range(n):
        words = [w.upper() if r.random() < 0.2 else w for w in r.choices(vocabulary, [1 / (i + 1) for i in range(120)], k=r.randint(0, 30))]
        rows.append((r.choice([" ", "-", "\n", "1"]).join(words), r.choice(["x", "y", None, ""]), r.choice(["s", "t", "u", "ü", None])))
    rows += [rows[0]] * 200 + [(rows[0][0], rows[0][1], f"copy{i % 40}") for i in range(200)]
    rows += [(None, "x", "empty"), ("", "x", "empty"), ("1 2 3", "only numbers", "s"), ("!!", "only numbers", "t"), ("one", "alone", "s"),
             ("word " * 30000, "x", "long"), ("É" * 5000, "y", "wide"), ("a\x00b İ ſ", "x", "s")]
    return rows


def run(spark, rows, **kw):
    table = spark.createDataFrame([(i, *r, "t", "h", 1) for i, r in enumerate(rows)], SCHEMA)
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in D.divergence(table, **kw).collect())


def test_against_plain_counting(spark):
    rows = sample(600, 1)
    assert run(spark, rows) == brute(rows)


def test_small_slices_and_small_memory(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD_BYTES", 3000)
    monkeypatch.setattr(D, "HELD_TERMS", 50)
    rows = sample(300, 2)
    assert run(spark, rows, least_documents=4, top=7, term_slice=8, source_slice=6) == brute(rows, 4, 7)


def test_no_rows_and_no_kept_terms(spark):
    assert run(spark, []) == []
    got = run(spark, [("a b", "x", "s"), ("c", "x", "t"), (None, "y", "s")])
    assert got == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]


def test_copies_are_tokenised_once(monkeypatch):
    import pyarrow as pa

    calls = []
    monkeypatch.setattr(D, "terms", lambda text: calls.append(text) or text.encode().split())
    rows = [("x", 1, 2, "a a b", [{"source": "s", "n": 3}]), ("x", 1, 2, "a a b", [{"source": "t", "n": 1}, {"source": "s", "n": 1}]),
            ("x", 1, 2, "other text of the same hash", [{"source": "s", "n": 1}])]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), D._copies_type()]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["lang", "h1", "h2", "text", "sources"])
    out = {(r["source"], r["term"]): (r["n"], r["docs"]) for b in D._count_body()([batch]) for r in b.to_pylist()}
    assert calls == ["a a b", "other text of the same hash"]
    assert out["s", "a"] == (8, 4) and out["t", "b"] == (1, 1) and out["s", "hash"] == (1, 1)


@pytest.mark.parametrize("count, total, kept", [(0, 0, 1), (10 ** 13, 10 ** 14, 10 ** 7), (7, 7, 1), (123456789, 987654321, 4321)])
def test_share_is_exact(spark, count, total, kept):
    from pyspark.sql import functions as F

    row = spark.range(1).select(D.share(F.lit(count).cast("long"), F.lit(total).cast("long"), F.lit(kept).cast("long"))).first()
    assert row[0] == 1 + 10 ** 9 * (count + 5) // (total + 5 * kept)
