"""Prepare a training set: records -> split -> normalise -> render -> length
cap -> ``split=``-partitioned Parquet (+ the batch manifest).

By default every record is kept, as it is: the split then looks at ids alone, so
the records are assembled and read once. With ``answered_only``, records that
end on an unanswered user turn are cut back to their last assistant message,
and records without one, or with a null role or content, are dropped and counted.

From turn rows (:func:`prepare_from_turns`) the same is done in two phases: partial
aggregates over the turns tell, without any text, which records stay, where each
ends, and its split; then only the turns that stay are joined and assembled, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialforge.functions import chat
from dialforge.operators import messages as msg
from dialforge.operators import split as sp
from dialforge.operators import tokens as tk
from dialforge.session import scratch_path
from dialforge.sources import store


def prepare(records: DataFrame, id_col: str, seed: int = sp.SPLIT_SEED,
            system: str = chat.DEFAULT_SYSTEM, eval_share: float = sp.EVAL_SHARE,
            cap: int = tk.MAX_SEQ_LENGTH, answered_only: bool = False) -> DataFrame:
    """``(id, messages, ...)`` -> + ``split``, ``text``, ``n_tokens``,
    ``truncated``, ``text_capped``. A null role or content is rendered as an
    empty one. With ``answered_only``, unanswered records are removed, and so
    are records with a null role or content in the kept turns."""
    if not answered_only:
        split = sp.train_eval_split(records, id_col, seed=seed, eval_share=eval_share)
        rendered = msg.render_chat(msg.normalize_system(split, system), on_null="empty")
        return tk.truncate_tokens(rendered, "text", cap=cap)
    trimmed = msg.trim_to_last_role(records, "assistant")
    kept = trimmed.where(F.size("messages") > 0)
    norm = msg.normalize_system(kept, system)
    rendered = msg.render_chat(norm).where(F.col("text").isNotNull())
    split = sp.train_eval_split(rendered, id_col, seed=seed, eval_share=eval_share)
    return tk.truncate_tokens(split, "text", cap=cap)


def judge_turns(turns: DataFrame, id_col: str, turn: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """One row a record, from partial aggregates: ``last`` (place of its last
    assistant turn, null without one) and ``bad`` (place of its first turn, system
    turns aside, with a null role or content). A place is a struct of turn and
    role, in the order in which :func:`messages.assemble_from_turns` puts them."""
    place = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"))
    is_bad = F.col(role).isNull() | (F.col(content).isNull() & (F.col(role) != "system"))
    return turns.groupBy(id_col).agg(F.max(F.when(F.col(role) == "assistant", place)).alias("last"),
                                     F.min(F.when(is_bad, place)).alias("bad"))


def answered():
    """Condition on :func:`judge_turns`: the record stays."""
    return F.col("last").isNotNull() & (F.col("bad").isNull() | (F.col("bad") > F.col("last")))


def prepare_turns(spark: SparkSession, turns: DataFrame, id_col: str, seed: int = sp.SPLIT_SEED, system: str = chat.DEFAULT_SYSTEM,
                  eval_share: float = sp.EVAL_SHARE, cap: int = tk.MAX_SEQ_LENGTH, turn: str = "turn", role: str = "role",
                  content: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(prepared, judged)``: what :func:`prepare` with ``answered_only`` gives
    for the assembled records, and the written verdict on every record."""
    path = scratch_path(spark, "judged")
    judged = judge_turns(turns, id_col, turn, role, content)
    store.write_table(judged, path)
    judged = spark.read.schema(judged.schema).parquet(path)
    ids = sp.train_eval_split(judged.where(answered()).select(id_col, "last"), id_col, seed=seed, eval_share=eval_share)
    place = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"))
    kept = turns.join(ids, id_col).where(place <= F.col("last"))
    packed = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"), F.col(content).alias("content"))))
    records = kept.groupBy(id_col, "split").agg(packed.alias("_m")).select(
        id_col, F.transform("_m", lambda m: chat.message(m["role"], m["content"])).alias("messages"), "split")
    rendered = msg.render_chat(msg.normalize_system(records, system))
    return tk.truncate_tokens(rendered, "text", cap=cap), judged


def prepare_from_turns(spark: SparkSession, turns: DataFrame, id_col: str, out_dir: str, seed: int = sp.SPLIT_SEED,
                       system: str = chat.DEFAULT_SYSTEM, eval_share: float = sp.EVAL_SHARE, cap: int = tk.MAX_SEQ_LENGTH,
                       turn: str = "turn", role: str = "role", content: str = "text", **manifest_kw) -> dict[str, DataFrame]:
    """The whole job with ``answered_only`` from turn rows; ``unanswered`` and
    ``rejected`` are the ids of the records that are dropped."""
    prepared, judged = prepare_turns(spark, turns, id_col, seed, system, eval_share, cap, turn, role, content)
    write_training_set(prepared, f"{out_dir}/data")
    data = spark.read.schema(prepared.schema).parquet(f"{out_dir}/data")
    manifest = manifest_for(data, id_col, seed=seed, **manifest_kw)
    _write_manifest(manifest, data, f"{out_dir}/manifest", manifest_kw)
    return {"data": data, "manifest": spark.read.schema(manifest.schema).parquet(f"{out_dir}/manifest"),
            "unanswered": judged.where(F.col("last").isNull()).select(id_col),
            "rejected": judged.where(F.col("last").isNotNull() & ~answered()).select(id_col)}


def unanswered(records: DataFrame) -> DataFrame:
    """Records that ``answered_only`` drops: no assistant message."""
    return records.where(~F.exists("messages", lambda m: m["role"].eqNullSafe(F.lit("assistant"))))


def rejected(records: DataFrame, system: str = chat.DEFAULT_SYSTEM) -> DataFrame:
    """Answered records that ``answered_only`` drops because a kept turn has
    a null role or content."""
    trimmed = msg.trim_to_last_role(records, "assistant").where(F.size("messages") > 0)
    return trimmed.where(chat.has_null_part(F.col("messages")))


def write_training_set(prepared: DataFrame, path: str, mode: str = "overwrite") -> None:
    prepared.write.mode(mode).partitionBy("split").parquet(path)


def manifest_for(prepared: DataFrame, id_col: str, **kw) -> DataFrame:
    """Batch manifest over the train rows."""
    return sp.batch_manifest(prepared.where(F.col("split") == "train"), id_col, **kw)


def _write_manifest(manifest: DataFrame, data: DataFrame, path: str, manifest_kw: dict) -> None:
    """Cut at known positions: the train rows are counted, not the manifest sampled."""
    rows = data.where(F.col("split") == "train").count()
    sp.write_positions(manifest, path, rows, manifest_kw.get("epochs", sp.EPOCHS))


def prepare_training_set(spark: SparkSession, records: DataFrame, id_col: str, out_dir: str,
                         seed: int = sp.SPLIT_SEED, system: str = chat.DEFAULT_SYSTEM,
                         eval_share: float = sp.EVAL_SHARE, cap: int = tk.MAX_SEQ_LENGTH,
                         answered_only: bool = False, **manifest_kw) -> dict[str, DataFrame]:
    """The whole job: ``out_dir/data`` (split-partitioned training rows) and
    ``out_dir/manifest`` (per-epoch order of the train rows, ordered
    shards), both read back; ``unanswered`` and ``rejected`` are the
    records that ``answered_only`` drops (none without it)."""
    prepared = prepare(records, id_col, seed=seed, system=system, eval_share=eval_share, cap=cap,
                       answered_only=answered_only)
    write_training_set(prepared, f"{out_dir}/data")
    # read back with the known schemas: no inference job over the new files
    data = spark.read.schema(prepared.schema).parquet(f"{out_dir}/data")
    manifest = manifest_for(data, id_col, seed=seed, **manifest_kw)
    _write_manifest(manifest, data, f"{out_dir}/manifest", manifest_kw)
    return {"data": data,
            "manifest": spark.read.schema(manifest.schema).parquet(f"{out_dir}/manifest"),
            "unanswered": unanswered(records).where(F.lit(answered_only)),
            "rejected": rejected(records, system).where(F.lit(answered_only))}
