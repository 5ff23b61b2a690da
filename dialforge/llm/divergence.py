"""Source divergence audit: how far the word use of each source lies from the
other sources of its language, and which words set it apart from the language.

Terms are runs of ASCII letters and of any characters beyond ASCII, with only A-Z
lowered. Equal texts of a language are collapsed before any is cut into terms: a
task folds the copies it meets into one row with a count per source, the rows of
one text meet after a shuffle by a 128-bit hash of it (rows of the same hash are
compared by their text), and the text is tokenised there once, whatever its number
of copies. Its terms add ``copies`` to the document frequency and ``copies`` times
their number to the counts, summed in the task and then in Spark.

All arithmetic is on whole numbers. ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``
of a source or a language; a pair of sources differs by the sum of ``|p - q|`` over
the kept terms of the language. Where neither source has a term, the difference is
the same for all such terms, so only the others are evaluated: the counts of a
language are cut into slices of terms and of sources, a task holds the counts of
one slice of terms for two slices of sources as a small matrix, and what it leaves
out is added at the end by its number.

Cases: a null text, language or source is the empty string; texts without terms
still make their source a group; a language without kept terms has pairs of value
0; a source alone in its language has no pair; repeated rows count as often as they
stand; equal values go by the UTF-8 bytes of the item; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialforge.llm.store import map_arrow, shuffle_partitions, text_batches, written

LEAST_DOCUMENTS = 30        # of a language that hold a kept term
TOP_TERMS = 50
HELD_BYTES = 24 << 20       # texts that a task folds at a time
HELD_TERMS = 1 << 18        # counts that a task sums at a time
TERM_SLICE, SOURCE_SLICE = 4096, 256
#: Bytes that are no part of a term become spaces, A-Z become a-z.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

FOLDED = "lang string, h1 long, h2 long, text string, sources array<struct<source:string,n:bigint>>"
COUNTED = "lang string, source string, term string, n long, docs long"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


def _copies_type():
    return pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))


def _fold_body():
    """Rows of (lang, h1, h2, text, source) to one for each text that is held."""
    names = ["lang", "h1", "h2", "text", "sources"]

    def run(batches):
        held: dict[tuple, Counter] = {}
        size = 0

        def send():
            rows, keys = list(held.values()), list(held)
            for lo in range(0, len(keys), 256):
                cut = slice(lo, lo + 256)
                cols = [pa.array([k[i] for k in keys[cut]], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))]
                copies = [[{"source": s, "n": n} for s, n in c.items()] for c in rows[cut]]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(copies, _copies_type())], names)

        for batch in batches:
            for key, source in zip(zip(*(batch.column(i).to_pylist() for i in range(4))), batch.column(4).to_pylist()):
                copies = held.get(key)
                if copies is None:
                    copies = held[key] = Counter()
                    size += 4 * len(key[3]) + 200
                elif source not in copies:
                    size += len(source) + 100
                copies[source] += 1
                if size > HELD_BYTES:
                    yield from send()
                    held, size = {}, 0
        yield from send()
    return run


def _count_body():
    """Folded rows, sorted by (lang, h1, h2, text), to counts of terms."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches):
        sums: dict[tuple, tuple[Counter, Counter]] = {}      # (lang, source): occurrences and documents of each term
        held = 0

        def send():
            nonlocal sums, held
            for (lang, source), (counts, docs) in sums.items():
                found = list(counts.items())
                for lo in range(0, len(found), 1 << 15):
                    part = found[lo:lo + (1 << 15)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                         pa.array([t.decode() for t, _ in part], pa.string()), pa.array([c for _, c in part], pa.int64()),
                         pa.array([docs[t] for t, _ in part], pa.int64())], names)
            sums, held = {}, 0

        def add(lang, words, copies):
            nonlocal held
            once = set(words)
            counted = Counter(words) if any(n > 1 for n in copies.values()) else None
            for source, times in copies.items():
                counts, docs = sums.setdefault((lang, source), (Counter(), Counter()))
                before = len(counts)
                if times == 1:
                    counts.update(words)
                    docs.update(once)
                else:
                    for t, c in counted.items():
                        counts[t] += c * times
                        docs[t] += times
                held += len(counts) - before

        at, words, copies = None, [], {}
        for batch in batches:
            lang, h1, h2 = (batch.column(i).to_pylist() for i in range(3))
            for i in range(batch.num_rows):
                key, text = (lang[i], h1[i], h2[i]), batch.column("text")[i].as_py()
                if at != (key, text):
                    if at is not None:
                        add(at[0][0], words, copies)
                    if held > HELD_TERMS:
                        yield from send()
                    at, words, copies = (key, text), terms(text), {}
                for s in batch.column("sources")[i].as_py():
                    copies[s["source"]] = copies.get(s["source"], 0) + s["n"]
                if len(copies) > 1 << 12:         # sources of one text: sum what is held; the text goes on
                    add(at[0][0], words, copies)
                    copies = {}
                    if held > HELD_TERMS:
                        yield from send()
        if at is not None:
            add(at[0][0], words, copies)
        yield from send()
    return run


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold the term)."""
    text_batches(docs.sparkSession)
    has = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "text", "source")]
    rows = docs.select(*has).select("lang", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"), "text", "source")
    folded = rows.transform(map_arrow, _fold_body(), FOLDED)
    folded = folded.repartition(shuffle_partitions(docs.sparkSession), "lang", "h1", "h2").sortWithinPartitions("lang", "h1", "h2", "text")
    counted = folded.transform(map_arrow, _count_body(), COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count, total, kept):
    """``1 + floor(10^9 (count + 5) / (total + 5 kept))``, exactly: three steps
    of a long division, for totals up to 10^15."""
    left, over, digits = count + F.lit(5), total + kept * 5, F.lit(0).cast("long")
    for _ in range(3):
        whole = F.call_function("div", left * 1000, over)
        digits, left = digits * 1000 + whole, left * 1000 - whole * over
    return digits + 1


def _slices(n, of: int):
    return F.greatest(F.ceil(n / of), F.lit(1)).cast("int")


def _distance_body():
    """Rows of (lang, slice, side_a, side_b, side, source, absent, terms, ps),
    sorted by the first four: for each pair of sources of two slices the sum over
    the terms that any of them has, and the number of these terms."""
    names = ["lang", "a", "b", "value", "terms"]

    def sums(lang, sides, members):
        columns = np.unique(np.concatenate([t for _, _, _, t, _ in members] or [np.zeros(0, np.int64)]))
        sources = [m[1] for m in members]
        table = np.empty((len(members), len(columns)), np.int64)
        for i, (_, _, absent, t, p) in enumerate(members):
            table[i] = absent
            table[i, np.searchsorted(columns, t)] = p
        side = np.array([m[0] for m in members])
        rows = np.flatnonzero(side == sides[0])
        others = np.flatnonzero(side == sides[1])
        for i in rows:
            value = np.abs(table[others] - table[i]).sum(axis=1)
            ok = others != i
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * int(ok.sum()), pa.string()), pa.array([sources[i]] * int(ok.sum()), pa.string()),
                 pa.array([sources[j] for j in others[ok]], pa.string()), pa.array(value[ok], pa.int64()),
                 pa.array(np.full(int(ok.sum()), len(columns)), pa.int64())], names)

    def run(batches):
        at, members = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "slice", "side_a", "side_b"))))
            side, source, absent = (batch.column(c).to_pylist() for c in ("side", "source", "absent"))
            for i, key in enumerate(keys):
                if key != at:
                    if members:
                        yield from sums(at[0], at[2:], members)
                    at, members = key, []
                members.append((side[i], source[i], absent[i], *(np.array(batch.column(c)[i].as_py(), np.int64) for c in ("terms", "ps"))))
        if members:
            yield from sums(at[0], at[2:], members)
    return run


def pair_values(groups: DataFrame, shares: DataFrame, source_slice: int = SOURCE_SLICE) -> DataFrame:
    """lang, a, b, value for all two sources of a language. ``groups``: lang,
    source, kept and slices (terms of the language and their slices), absent (the
    share of a term that the source lacks); ``shares``: lang, source, slice, place
    (number of a term in its slice), p of the terms a source has."""
    spark = groups.sparkSession
    sized = groups.join(groups.groupBy("lang").agg(_slices(F.count("*"), source_slice).alias("sides")), "lang")
    sized = sized.withColumn("side", F.pmod(F.xxhash64("source"), "sides").cast("int"))
    held = shares.groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list(F.struct("place", "p"))).alias("x"))
    none = F.array().cast("array<bigint>")
    # a source without a term of a slice still differs there from those that have one
    asked = sized.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    asked = asked.join(held, ["lang", "source", "slice"], "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    asked = asked.select("lang", "slice", F.least("side", "other").alias("side_a"), F.greatest("side", "other").alias("side_b"), "side",
                         "source", "absent", F.coalesce("x.place", none).alias("terms"), F.coalesce("x.p", none).alias("ps"))
    key = ["lang", "slice", "side_a", "side_b"]
    asked = asked.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, "source")
    part = asked.transform(map_arrow, _distance_body(), "lang string, a string, b string, value long, terms long")
    summed = part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    first = sized.select("lang", F.col("source").alias("a"), F.col("side").alias("side_a"), "absent", "kept")
    second = sized.select("lang", F.col("source").alias("b"), F.col("side").alias("side_b"), F.col("absent").alias("other_absent"))
    both = summed.join(first, ["lang", "a"]).join(second, ["lang", "b"]).withColumn(
        "value", F.col("value") + (F.col("kept") - F.col("terms")) * F.abs(F.col("absent") - F.col("other_absent")))
    # pairs of two slices come out one way round, pairs within a slice both ways
    turned = both.where("side_a <> side_b").select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    return both.select("lang", "a", "b", "value").unionByName(turned)


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS,
               term_slice: int = TERM_SLICE, source_slice: int = SOURCE_SLICE) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts = written(term_counts(docs), "term-counts")
    both = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    common = written(both.where(F.col("docs") >= least_documents).select("lang", "term", "in_lang"), "common-terms")
    langs = common.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("in_lang").alias("lang_total"))
    langs = langs.withColumn("slices", _slices(F.col("kept"), term_slice))
    sliced = common.join(langs.select("lang", "slices"), "lang").withColumn("slice", F.pmod(F.xxhash64("term"), "slices").cast("int"))
    place = F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")).cast("long")
    terms_kept = written(sliced.withColumn("place", place).drop("slices"), "kept-terms")
    mine = written(counts.join(terms_kept, ["lang", "term"]).drop("docs"), "kept-counts")
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    groups = docs.select(*names).distinct().join(mine.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("slices", F.lit(1)).alias("slices"),
        *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("total", "kept", "lang_total")))
    absent = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("kept", F.lit(1).cast("long"))))
    groups = written(groups.withColumn("absent", F.coalesce(absent, F.lit(0).cast("long"))), "source-groups")

    shares = mine.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "slice", "place", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(groups.select("lang", "source", "kept", "slices", "absent"),
                        shares.select("lang", "source", "slice", "place", "p"), source_slice)
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    high = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    high = high.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(high)
