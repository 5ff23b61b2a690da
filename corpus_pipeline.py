"""A training corpus in five stages: quality, near duplicates, repeated
passages, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``; a stage that changes a text also brings its
``n_chars`` up to date. An empty table gives an empty table at every stage, and
other columns come through untouched. Null and repeated rows:

- quality: a null text is scored as an empty one; a row without doc_id has no label
  but is scored; repeated rows are judged alike, and all stay or all go;
- near duplicates: a document without words is linked with nothing and stays; rows
  that repeat doc_id and text are one; a group without any doc_id keeps one row;
- repeated passages: a null text stays null; copies of a passage go from every row
  that holds it, repeated rows included;
- secrets: a null text stays null; repeated rows are marked alike;
- packing: a null or empty text is one closing id; every row is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialforge.llm import jaccard, packing, quality, secrets, substring
from dialforge.llm.queries import BYTE_BPE, held_out
from dialforge.llm.store import written
from dialforge.session import read_table, ship_package, table_path

SECRET_MARK = "[SECRET]"


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``row`` and the new ``text``."""
    return changed.select(*[
        F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("row").getField(c).alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for quality 1 stay, unchanged."""
    ship_package(spark)
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    sized = docs.withColumn("__length", F.length("text"))
    machine = quality.train(sized, labels, ~held_out(), ["__length"])
    kept = quality.score(sized, machine, ["__length"], docs.columns).where("score >= 0.5")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays, unchanged."""
    ship_package(spark)
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand in two places go; every document stays."""
    ship_package(spark)
    return _like(docs, substring.remove_repeated(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mark takes the place of every secret; every document stays."""
    ship_package(spark)
    return _like(docs, secrets.scan(docs, secrets.train(docs), mark=SECRET_MARK))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    ship_package(spark)
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [("quality", good_quality), ("near_duplicates", distinct_documents), ("repeated_passages", without_repeats),
          ("secrets", without_secrets), ("packing", packed)]

#: SQL can neither fit the classifier and the random field nor encode tokens;
#: tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
