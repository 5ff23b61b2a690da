"""Every stage of the pipeline against a brute-force version of its input."""

import re
from collections import Counter

import corpus_pipeline as P
from dialforge.llm import secrets
from dialforge.llm.store import written
from tests.llm.conftest import EDGE_ROWS
from tests.llm.test_operators import WORD, brute_components, brute_removed, check_pieces

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    tables = [docs]
    for name, stage in P.STAGES:
        tables.append(written(stage(spark, tables[-1], SF), name))
    for t in tables[1:-1]:
        assert t.schema == docs.schema
    first, good, distinct, cut, clean = map(rows_of, tables[:-1])
    assert set(good) <= set(first)
    kept = {i for i, _ in good}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)
    assert Counter(distinct) == Counter((i, t) for (i, t), (_, _, c) in zip(good, brute_components(good)) if i == c)
    want = {i: k for (i, _), (_, _, k) in zip(distinct, brute_removed([t for _, t in distinct]))}
    assert {i: WORD.findall(t) for i, t in cut} == want
    for i, t in clean:
        before = dict(cut)[i]
        assert t == before or P.SECRET_MARK in t
        assert not secrets.base_spans(t) and (t == before) == (not secrets.find(before, None) and P.SECRET_MARK not in t)
    lib = Tokenizer.from_file(P.BYTE_BPE)
    check_pieces(tables[-1].collect(), Counter((i, (*lib.encode(t, add_special_tokens=False).ids, 1)) for i, t in clean))
    assert all(r["n_chars"] == len(r["text"]) for r in tables[4].collect())


def test_awkward_rows(spark, table, tmp_path):
    """Each stage on nulls, empty and repeated rows, very long texts and columns
    with names used inside, against what its docstring says."""
    from tokenizers import Tokenizer

    spark.createDataFrame([(0, 1), (10, 0), (12, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, empty = table(EDGE_ROWS), table([])
    for name, stage in P.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
        if name != "packing":
            kept = stage(spark, docs, str(tmp_path))
            assert kept.schema.names == docs.schema.names
            assert {tuple(r) for r in kept.select("lang", "row", "key", "ref", "places").distinct().collect()} == {("en", "r", "k", None, 7)}

    given = Counter(EDGE_ROWS)
    good = Counter(rows_of(P.good_quality(spark, docs, str(tmp_path))))
    assert all(n == given[row] for row, n in good.items())              # repeated rows all stay or all go
    distinct = Counter(rows_of(P.distinct_documents(spark, docs, "")))
    named = [(i, t) for i, t in EDGE_ROWS if i is not None]
    want = {(i, t) for (i, t), (_, n, least) in zip(named, brute_components(named)) if not n or i == least}
    assert distinct == Counter(want | {r for r in given if r[0] is None})
    cut = rows_of(P.without_repeats(spark, docs, ""))
    assert Counter((i, t is None, tuple(WORD.findall(t or ""))) for i, t in cut) == Counter(
        (i, t is None, tuple(k)) for (i, t), (_, _, k) in zip(EDGE_ROWS, brute_removed([t for _, t in EDGE_ROWS])))
    assert Counter(rows_of(P.without_secrets(spark, docs, ""))) == given
    lib = Tokenizer.from_file(P.BYTE_BPE)
    once = [r for r in given if r[0] is not None]
    check_pieces(P.packed(spark, table(once), "").collect(), Counter((i, (*lib.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in once))
    assert P.packed(spark, docs, "").where("start = 0").count() == len(EDGE_ROWS)


def test_nothing_else_needs_the_folder():
    import pathlib

    root = pathlib.Path(P.__file__).parent
    for f in [*root.glob("dialforge/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"dialforge\.llm|corpus_pipeline", f.read_text()), f
