"""Document fingerprints of closed syncmers, in DataFrame functions only.

A text is cut into pieces (up to six characters, starting anew at every word)
and set between markers. Of every ``K`` consecutive pieces, the k-mer, the
smallest hash of its inner runs of two pieces must lie at one of its edges;
then the k-mer is an anchor. Whether it is depends on the k-mer alone, so a
passage has the same anchors wherever it stands, but for those at its ends.
The likeness of two texts is the Dice share of their distinct anchors, as the
fingerprint lists them.

Cases: a null text is empty; a text without pieces has no anchors, an empty
fingerprint, and likeness 1 to another such text and 0 to others; a text of one
piece has anchors thanks to the markers; equal texts have equal fingerprints;
repeated rows are each other's next documents; a null doc_id comes before all
others; a table of one row is its own next; no rows give no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialforge.llm.store import shuffle_partitions

K, INNER = 6, 2
PIECE = r"\S{1,6}"
WINDOW = K - INNER + 1            # inner runs in a k-mer
BUCKET_ROWS = 1 << 15             # rows of a bucket at most, about


def _after(array: str, by: int) -> Column:
    return F.expr(f"slice({array}, {by + 1}, greatest(size({array}) - {by}, 0))")


def _ahead(array: str, by: int) -> Column:
    return F.expr(f"slice({array}, 1, greatest(size({array}) - {by}, 0))")


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the 32-bit hashes of the distinct anchors of ``text``, in its order."""
    p = f"{out}_"

    def least(array: str, by: int) -> Column:
        return F.zip_with(_ahead(array, by), _after(array, by), lambda a, b: F.least(a, b))

    df = df.withColumn(p + "h", F.transform(F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0)), lambda x: F.xxhash64(x)))
    marked = F.concat(F.array_repeat(F.lit(1).cast("long"), K - 1), F.col(p + "h"), F.array_repeat(F.lit(2).cast("long"), K - 1))
    df = df.withColumn(p + "h", F.when(F.size(p + "h") > 0, marked).otherwise(F.col(p + "h")))
    df = df.withColumn(p + "m", F.zip_with(_ahead(p + "h", 1), _after(p + "h", 1), lambda a, b: F.xxhash64(a, b)))
    # least of each WINDOW = 5 inner runs: of two, of four, of five
    df = df.withColumn(p + "l", least(p + "m", 1))
    df = df.withColumn(p + "l", least(p + "l", 2))
    df = df.withColumn(p + "l", least(p + "l", 1))
    # runs at 0, 2 and 4 of a k-mer hold all its pieces
    df = df.withColumn(p + "z", F.arrays_zip(F.col(p + "l").alias("l"), _ahead(p + "m", WINDOW - 1).alias("a"),
                                             F.slice(_after(p + "m", 2), 1, F.size(p + "l")).alias("b"),
                                             _after(p + "m", WINDOW - 1).alias("c")))
    df = df.withColumn(out, F.transform(
        F.filter(p + "z", lambda x: F.least(x["a"], x["c"]) == x["l"]),
        lambda x: F.shiftrightunsigned(F.xxhash64(x["a"], x["b"], x["c"]), 32)))
    df = df.withColumn(out, F.array_distinct(out))
    return df.drop(*[p + c for c in "hmlz"])


def fingerprint(anchors: str) -> Column:
    """Sorted distinct anchors as text, 8 hexadecimal digits each."""
    return F.array_join(F.transform(F.array_sort(anchors), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """2 |A and B| / (|A| + |B|); two without anchors are alike."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * both / total)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, key, bucket, extra`` in buckets of consecutive doc_ids;
    each bucket also holds, as ``extra``, the first rows of the one that follows
    (the last one's: of the first). Only the buckets' bounds reach the driver."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 63))).alias("key"))
    buckets = shuffle_partitions(docs.sparkSession, docs.count(), BUCKET_ROWS)
    cuts = rows.select(F.percentile_approx("key", [i / buckets for i in range(1, buckets)] or [0.5], 50 * buckets)).first()[0] or []
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    rows = rows.withColumn("bucket", F.size(F.filter(bounds, lambda c: c < F.col("key"))))
    firsts = [(r["bucket"], r["key"]) for r in rows.groupBy("bucket").agg(F.min("key").alias("key")).orderBy("bucket").collect()]
    turned = [(key, firsts[i - 1][0]) for i, (_, key) in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(turned, "key long, bucket int")
    extra = rows.drop("bucket").join(F.broadcast(heads), "key").select("doc_id", "text", "key", "bucket", F.lit(1).alias("extra"))
    return rows.withColumn("extra", F.lit(0)).unionByName(extra).repartitionById(buckets, "bucket")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, anchors``, the next document's ``next_text`` and
    ``next_anchors`` (ascending doc_id), ``edited`` and ``edited_anchors``: the
    text whose later half gave way to the start of the next one."""
    rows = with_anchors(with_next(docs), "text", "anchors")
    order = Window.partitionBy("bucket").orderBy("extra", "key", F.xxhash64("text"), "text")
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_anchors": F.lead("anchors").over(order)})
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    return with_anchors(rows.where("extra = 0").withColumn("edited", edited), "edited", "edited_anchors")
