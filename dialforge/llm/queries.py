"""The queries ``opN_<name>``: each applies one operator, with production
parameters, to its whole table and returns the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialforge.llm import (divergence, edits, fingerprints, hard_negatives, jaccard, neighbours, ordering, packing, personal, quality,
                           secrets, substring, word_bpe)
from dialforge.session import read_table, scratch_path, ship_package, table_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@register("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, sf_dir), BYTE_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@register("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = word_bpe.encode_documents(documents(spark, sf_dir), WORD_BPE)
    both = word_bpe.decode_documents(encoded, WORD_BPE)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


QUALITY_METADATA = ["n_chars"]


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("n_chars", F.length("text"))
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    machine = quality.train(docs, labels, ~held_out(), QUALITY_METADATA)
    return quality.score(docs, machine, QUALITY_METADATA, ["doc_id"]).select(
        "row.doc_id", F.coalesce(held_out("row.doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Every document with its shingles, the pairs that link, and the closure.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
commons AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
             FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM commons o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
          WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY ALL
"""


@register("op9_jaccard_join", JACCARD_SQL)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


#: Every window of 35 words that starts in two places, and the words it covers.
SUBSTRING_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest([md5(array_to_string(w[j:j + 34], ' ')) for j in range(1, len(w) - 33)]) AS h
  FROM words WHERE len(w) >= 35),
repeated AS (SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT k.doc_id, count(*) AS n, string_agg(k.word, ' ' ORDER BY k.p) AS t
  FROM places k ANTI JOIN gone g ON g.doc_id = k.doc_id AND g.p = k.p GROUP BY k.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""


@register("op6_substring_dedup", SUBSTRING_SQL)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeated(documents(spark, sf_dir))
    words = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return kept.select("row.doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


def _joined_spans(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _spans_of(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind))


@register("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs.select("doc_id", "text"), secrets.train(docs))
    count = [_spans_of(kind).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("row.doc_id", *count, F.sha2(_joined_spans(base), 256).alias("base_sha256"),
                        _joined_spans(F.col("spans")).alias("spans"))


@register("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.fingerprints(documents(spark, sf_dir))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprints.fingerprint("anchors").alias("fingerprint"),
                       fingerprints.fingerprint("edited_anchors").alias("edited_fingerprint"),
                       fingerprints.likeness("anchors", "edited_anchors").alias("near_edited"),
                       fingerprints.likeness("anchors", "next_anchors").alias("near_next"))


@register("op10_neighbours")
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(table_path(sf_dir, "embeddings")))


def _three_edits():
    """Per document: a cut at a third, an insertion at half, and a replacement
    near the end, each by pieces of the document itself."""
    n = F.length("text")
    return F.array(
        F.struct(F.floor(n / 3).alias("start"), F.lit(40).alias("removed"), F.lit("").alias("inserted")),
        F.struct(F.floor(n / 2).alias("start"), F.lit(0).alias("removed"), F.substring("text", 1, 60).alias("inserted")),
        F.struct((n - 30).alias("start"), F.lit(12).alias("removed"), F.upper(F.substring("text", 20, 25)).alias("inserted")))


@register("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = edits.count_edited(docs, _three_edits(), BYTE_BPE)
    return counted.select("row.doc_id", "tokens_before", "blocks", "tokens", "n_chars", "encoded_chars",
                          F.sha2("text", 256).alias("edited_sha256"))


@register("op5_training_order")
def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = scratch_path(spark, "llm-shards")
    ordering.write_shards(ordering.in_training_order(ordering.sequences(docs, BYTE_BPE, packed=True), key="epoch-0"), path)
    shards = ordering.read_shards(spark, path, docs.schema["doc_id"].dataType.simpleString())
    return shards.select("slot", "shard", "record", "doc_id", "start", "n_ids", F.crc32("ids").alias("ids_crc32"))


@register("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(table_path(sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, label=label)


@register("op12_personal_data")
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = personal.scan(docs, personal.train(personal.labelled(docs)))
    count = [_spans_of(kind).cast("long").alias(f"n_{kind}") for kind in personal.RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(*personal.RULES))
    return found.select("row.doc_id", *count, F.sha2(_joined_spans(base), 256).alias("base_sha256"),
                        _joined_spans(F.col("spans")).alias("spans"))


#: Counts of every term of every document, exact shares, and their differences.
DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
occurrences AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL),
whole AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
sizes AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS n FROM whole GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT s.lang, s.source, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS n FROM sources s LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT t.lang, t.source, w.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (t.n + 5 * z.v) AS p,
         1 + (1000000000 * (w.n + 5)::HUGEINT) // (z.n + 5 * z.v) AS q
  FROM totals t JOIN sizes z USING (lang) JOIN whole w USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = w.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
marked AS (
  SELECT * FROM pairs
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM marked QUALIFY part = 'pair' OR rank <= 50
"""


@register("op13_source_divergence", DIVERGENCE_SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))
