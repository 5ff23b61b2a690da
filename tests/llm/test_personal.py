"""Personal data: the rules against the patterns as the contract gives them, the
field against exhaustive decoding, and what it finds on documents it never saw."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialforge.llm import crf
from dialforge.llm import personal as P
from dialforge.llm import queries as Q
from tests.llm.conftest import EDGE_ROWS

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, m):
    digits = [int(c) for c in m if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if good(k, m[0])]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


HAND = {
    "write to a.b+c@mail-1.example.com now": [("email", 9, 33)],
    "a@b c@d.e@f.g": [("email", 4, 9)],
    "@x.y z@-.-": [("email", 5, 10)],
    "97.51.17.173 and 256.1.1.1 and 1.2.3": [("ip", 0, 12)],
    "1.2.3.4.5.6.7.8": [("ip", 0, 7), ("ip", 8, 15)],
    "4111 1111-1111 1111, 4111111111111112": [("card", 0, 19)],
    "+1 (017) 555-7713.": [("phone", 0, 17)],
    "++49 30 1234567 +1 2": [("phone", 1, 15)],
    "": [], "٣٤.1.1.1 1.1.1.٣": [],
}


@pytest.mark.parametrize("text, spans", HAND.items())
def test_rules_by_hand(text, spans):
    assert P.base_spans(text) == spans == plain(text)


def test_rules_on_random_texts():
    rng = random.Random(1)
    for n in range(6000):
        text = "".join(rng.choice(["0", "1", "25", "4111111111111111", ".", "-", " ", "+", "@", "a", "Z%", "(", ")", "é", "_", "1.2.3.4", "x@y.z", "\n"])
                       for _ in range(rng.randint(1, 40)))
        assert P.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "0" * 9000 + ".1.1.1", "1." * 100_000, "a@" * 100_000, "+1 " * 100_000, "1 " * 150_000):
        P.base_spans(text)
    assert P.base_spans("0" * 9000 + ".1.1.1") == [("ip", 0, 9006)]


# -- the field ------------------------------------------------------------------

@pytest.fixture(scope="module")
def chain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    return P.train(P.labelled(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)))


@pytest.fixture(scope="module")
def held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    return [r[0] or "" for r in docs.select("text").collect()]


def random_chain(seed):
    rng = np.random.default_rng(seed)
    return crf.Chain([rng.normal(size=(5, 4)), rng.normal(size=(3, 4))], np.where(rng.random((4, 4)) < 0.2, crf.BARRED, rng.normal(size=(4, 4))))


def test_viterbi_finds_the_best_tags():
    for seed in range(30):
        c, rng = random_chain(seed), np.random.default_rng(seed)
        length = rng.integers(1, 6, 4)
        u = rng.normal(size=(4, 5, 4)) * 2
        tags = crf.viterbi(u, length, c.steps)
        for i, n in enumerate(length):
            def total(t):
                path = (0, *t, 0)
                return sum(c.steps[a, b] for a, b in zip(path, path[1:])) + sum(u[i, j, k] for j, k in enumerate(t))
            assert total(tags[i, :n]) == pytest.approx(max(total(t) for t in itertools.product(range(4), repeat=int(n))))


def test_stretches_give_the_whole_decoding():
    for seed in range(60):
        c, rng = random_chain(seed), np.random.default_rng(seed)
        n = 60
        feats = [rng.integers(0, 5, n), rng.integers(0, 3, n)]
        caution = float(rng.choice([0.0, 1.0, 2.5]))
        first, end = crf.Bounds(c, caution).stretches(feats, np.zeros(n, bool))
        found = crf.decode(c, first, end, lambda p: [f[p] for f in feats], caution, cells=40)
        tags = np.zeros(n, np.int64)
        for lo, t in zip(first, found):
            tags[lo:lo + len(t)] = t
        u = c.scores(feats)
        u[:, 0] += caution
        whole = crf.viterbi(u[None], np.array([n]), c.steps)[0]

        def total(t):
            path = [0, *t, 0]
            return sum(c.steps[a, b] for a, b in zip(path, path[1:])) + u[np.arange(n), t].sum()
        assert total(tags) == pytest.approx(total(whole))


def test_gradient_climbs():
    """The fitted chain gives the tags of its own table."""
    rng = np.random.default_rng(0)
    feats = rng.integers(0, 6, (80, 12, 1))
    tags = np.where(feats[..., 0] == 0, 1, 0)
    tags[:, 1:] = np.where((feats[:, 1:, 0] == 1) & (tags[:, :-1] > 0), 2, tags[:, 1:])
    used = np.arange(12)[None, :] < rng.integers(3, 13, 80)[:, None]
    allowed = np.ones((3, 3))
    allowed[0, 2] = 0
    c = crf.fit(feats, tags, used, [6], allowed)
    got = crf.viterbi(c.scores([feats[..., 0]]), used.sum(axis=1), c.steps)
    assert (got[used] == tags[used]).mean() > 0.99


def test_hidden_values_are_found_and_clean_texts_left(chain, held_out):
    reader = P.Reader(chain)
    tried, hit = 0, 0
    for text in held_out:
        for kind, a, b in P.base_spans(text):
            for form in P.WRITINGS[kind]:
                hidden = form(text[a:b])
                left, right = text[max(0, a - 200):a], text[b:b + 200]
                spans = P.find([left + hidden + right], reader)[0]
                tried += 1
                hit += any(k.endswith(kind) and s < len(left) + len(hidden) and e > len(left) for k, s, e in spans)
    clean = [t for t in held_out if not P.base_spans(t)]
    flagged = sum(bool(s) for s in P.find(clean, reader))
    assert tried > 800 and hit > 0.9 * tried
    assert len(clean) > 2500 and flagged <= 0.002 * len(clean)


def test_writings_it_was_not_trained_on(chain, held_out):
    reader = P.Reader(chain)
    forms = {"email": lambda m: m.replace("@", " (at) "), "ip": lambda m: m.replace(".", "(dot)"), "phone": lambda m: "(1)" + m[2:]}
    for wanted, form in forms.items():
        tried = hit = 0
        for text in held_out:
            for kind, a, b in P.base_spans(text):
                if kind == wanted:
                    left, hidden = text[max(0, a - 200):a], form(text[a:b])
                    spans = P.find([left + hidden + text[b:b + 200]], reader)[0]
                    tried += 1
                    hit += any(k == f"crf_{kind}" and s < len(left) + len(hidden) and e > len(left) for k, s, e in spans)
        assert tried > 40 and hit > 0.9 * tried, (wanted, hit, tried)


def test_added_spans_keep_clear_of_the_rules(chain, held_out):
    reader = P.Reader(chain, -3.0)
    for text, spans in zip(held_out[:400], P.find(held_out[:400], reader)):
        base = [s for s in spans if s[0] in P.RULES]
        assert base == plain(text)
        for k, a, b in spans:
            if k not in P.RULES:
                assert P.whole_value(k[4:], text[a:b]) and all(b <= s[1] or a >= s[2] for s in base)


def test_batches_do_not_matter(chain, held_out):
    reader = P.Reader(chain, -2.0)
    texts = ["", "x", *held_out[:60], ""]
    assert P.find(texts, reader) == [P.find([t], reader)[0] for t in texts]


def test_awkward_rows(spark, table):
    rows = EDGE_ROWS + [(30, "a@b.cd"), (30, "a@b.cd"), (None, "+1 234 567 8901"), (31, "  5 \x00 1.1.1.1")]
    docs = table(rows)
    trained = P.train(P.labelled(docs))
    got = sorted(((r["row"]["doc_id"], [tuple(s) for s in r["spans"] if s["kind"] in P.RULES]) for r in P.scan(docs, trained).collect()), key=str)
    assert got == sorted(((i, plain(t or "")) for i, t in rows), key=str)
    assert P.scan(docs, None).columns == ["row", "spans"]
    nothing = table([(1, "plain words"), (2, None), (3, "")])
    assert P.train(P.labelled(nothing)) is None
    empty = table([])
    assert P.scan(empty, P.train(P.labelled(empty))).count() == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in Q.op12_personal_data(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        spans, row = plain(r["text"] or ""), got[r["doc_id"]]
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        assert row["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) - {""} <= set(row["spans"].split(","))
