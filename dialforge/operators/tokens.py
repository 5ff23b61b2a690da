"""Length cap per example.

The default tokeniser is whitespace (native ``split``), which undercounts
model tokens; pass ``tokenize`` (a Python function ``text -> list of
(start, end) character spans``, e.g. built from a subword tokenizer's offset
mapping) to cap by model tokens instead. That path runs as an Arrow-batched
pandas UDF; the whitespace path stays in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the per-example length cap of the trainer, in tokens.
MAX_SEQ_LENGTH = 2048


# the characters Java's \s matches (also RE2's, minus vertical tab)
WHITESPACE = " \t\n\u000b\f\r"


def strip_whitespace(text: Column) -> Column:
    """Remove leading/trailing whitespace of every kind (``trim`` only
    removes spaces); a character-set trim, no regex."""
    return F.btrim(text, F.lit(WHITESPACE))


def whitespace_tokens(text: Column) -> Column:
    t = strip_whitespace(text)
    return F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(t, r"\s+"))


def count_tokens(text: Column) -> Column:
    """Whitespace-token count without materialising the token array."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def _sum_lengths(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x))


def cut_after_tokens(text: Column, cap: int) -> Column:
    """The original text up to the end of its ``cap``-th token (whitespace
    and line breaks inside the kept part are preserved): leading whitespace
    + the first ``cap`` tokens + the ``cap - 1`` separators between them."""
    stripped = strip_whitespace(text)
    lead = F.length(text) - F.length(F.ltrim(text, F.lit(WHITESPACE)))
    toks = F.slice(F.split(stripped, r"\s+"), 1, cap)
    seps = F.slice(F.regexp_extract_all(stripped, F.lit(r"(\s+)"), 1), 1, max(cap - 1, 1))
    sep_len = _sum_lengths(seps) if cap > 1 else F.lit(0)
    return F.substring(text, F.lit(1), (lead + _sum_lengths(toks) + sep_len).cast("int"))


def tokenizer_file_spans(path: str, add_special_tokens: bool = False):
    """Span function for :func:`truncate_tokens` from a ``tokenizer.json``
    file (the ``tokenizers`` library): character offsets of each token.
    The tokenizer is loaded once per Python worker and encodes whole Arrow
    batches at a time (``.batch``)."""
    cache: dict = {}

    def _tok():
        if "t" not in cache:
            from tokenizers import Tokenizer
            cache["t"] = Tokenizer.from_file(path)
        return cache["t"]

    def spans(text: str) -> list[tuple[int, int]]:
        return list(_tok().encode(text, add_special_tokens=add_special_tokens).offsets)

    def batch(texts: list[str]) -> list[list[tuple[int, int]]]:
        encs = _tok().encode_batch(texts, add_special_tokens=add_special_tokens)
        return [list(e.offsets) for e in encs]

    spans.batch = batch
    return spans


def truncate_tokens(df: DataFrame, text: str = "text", cap: int = MAX_SEQ_LENGTH,
                    out: str | None = None,
                    tokenize: Callable[[str], list[tuple[int, int]]] | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``truncated`` (n_tokens > cap) and the capped text
    (``out``, default ``<text>_capped``): the original text cut after its
    ``cap``-th token, unchanged when it is not over the cap. The cut regex
    runs only on the over-cap rows."""
    if cap < 1:
        raise ValueError("cap must be >= 1")
    out = out or f"{text}_capped"
    if tokenize is None:
        t = F.col(text)
        return (df.withColumn("n_tokens", count_tokens(t))
                .withColumn("truncated", F.col("n_tokens") > cap)
                .withColumn(out, F.when(F.col("truncated"), cut_after_tokens(t, cap))
                            .otherwise(t)))

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("cut", T.LongType())])
    batch = getattr(tokenize, "batch", None)

    @F.pandas_udf(schema)
    def spans(s: pd.Series) -> pd.DataFrame:
        texts = [t for t in s if t is not None]
        found = iter(batch(texts) if batch else [tokenize(t) for t in texts])
        ns, cuts = [], []
        for t in s:
            if t is None:
                ns.append(None)
                cuts.append(None)
                continue
            sp = next(found)
            ns.append(len(sp))
            cuts.append(sp[cap - 1][1] if len(sp) > cap else len(t))
        return pd.DataFrame({"n": ns, "cut": cuts})

    return (df.withColumn("_sp", spans(F.col(text)))
            .withColumn("n_tokens", F.col("_sp.n"))
            .withColumn("truncated", F.col("n_tokens") > cap)
            .withColumn(out, F.expr(f"substring(`{text}`, 1, _sp.cut)"))
            .drop("_sp"))
