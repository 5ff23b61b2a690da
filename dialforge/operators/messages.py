"""Record assembly and chat rendering operators (DataFrame -> DataFrame).

Assembly from turn rows groups by conversation: the group *is* the output
record, so its size is bounded by one record; the shuffle is hash-partitioned
on the conversation key with a map-side partial ``collect_list`` and no hot
key can merge two records. Everything after assembly is a narrow projection.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialforge.functions import chat


def assemble_from_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn",
                        role: str = "role", content: str = "text",
                        out: str = "messages") -> DataFrame:
    """Turn rows -> one row per ``key`` with ``messages`` ordered by ``turn``."""
    packed = F.array_sort(F.collect_list(
        F.struct(F.col(turn).alias("t"), F.col(role).alias("role"),
                 F.col(content).alias("content"))))
    return (turns.groupBy(key).agg(packed.alias("_m"))
            .select(key, F.transform("_m", lambda m: chat.message(m["role"], m["content"]))
                    .alias(out)))


def assemble_triplet(df: DataFrame, system: Column | str, user: str, assistant: str,
                     out: str = "messages") -> DataFrame:
    """The training record shape: exactly system, user, assistant."""
    sys_col = F.lit(system) if isinstance(system, str) else system
    return df.withColumn(out, F.array(
        chat.message("system", sys_col),
        chat.message("user", F.col(user)),
        chat.message("assistant", F.col(assistant))))


def normalize_system(df: DataFrame, system: str = chat.DEFAULT_SYSTEM,
                     messages: str = "messages") -> DataFrame:
    return df.withColumn(messages, chat.normalize_system(F.col(messages), system))


def render_chat(df: DataFrame, messages: str = "messages", out: str = "text",
                add_generation_prompt: bool = False, on_null: str = "reject") -> DataFrame:
    """Training text of every message (no generation cue by default)."""
    return df.withColumn(out, chat.render_messages(
        F.col(messages), add_generation_prompt=add_generation_prompt, on_null=on_null))


def render_inference_prompt(df: DataFrame, messages: str = "messages", out: str = "prompt",
                            default_system: str = chat.DEFAULT_SYSTEM) -> DataFrame:
    return df.withColumn(out, chat.inference_prompt(F.col(messages), default_system))


def last_message(df: DataFrame, messages: str = "messages", prefix: str = "last_") -> DataFrame:
    m = chat.last_message(F.col(messages))
    return (df.withColumn(prefix + "role", m["role"])
            .withColumn(prefix + "content", m["content"]))


def last_message_from_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn",
                            role: str = "role", content: str = "text",
                            prefix: str = "last_") -> DataFrame:
    """Last message per record straight from turn rows with ``max_by``: a
    partial aggregate (combined map-side), so no record is assembled and a
    huge conversation never sits whole in one task."""
    last = F.max_by(F.struct(F.col(role).alias("r"), F.col(content).alias("c")), F.col(turn))
    return (turns.groupBy(key).agg(last.alias("_lm"))
            .select(key, F.col("_lm.r").alias(prefix + "role"),
                    F.col("_lm.c").alias(prefix + "content")))


def trim_to_last_role(df: DataFrame, role: str = "assistant",
                      messages: str = "messages") -> DataFrame:
    """Cut each record after its last ``role`` message (records without one
    become empty arrays); used to keep only answered turns for training."""
    idx = chat.last_index_of_role(F.col(messages), role)
    return df.withColumn(messages, F.slice(F.col(messages), F.lit(1), F.coalesce(idx, F.lit(0))))


def map_records(df: DataFrame, fn, out: str = "text", messages: str = "messages",
                return_type: str = "string") -> DataFrame:
    """Record map with a user's Python function (e.g. a tokenizer's own chat
    template): ``fn(list of {"role", "content"} dicts) -> value``, run as an
    Arrow-batched pandas UDF. Prefer :func:`render_chat` (native) when the
    template is the fixed one."""

    @F.pandas_udf(return_type)
    def apply(col: pd.Series) -> pd.Series:
        return col.map(lambda ms: None if ms is None else fn(
            [{"role": m["role"], "content": m["content"]} for m in ms]))

    return df.withColumn(out, apply(F.col(messages)))


def flatten_messages(messages: Column, sep: str = "␞") -> Column:
    """A scalar fingerprint of a messages array for checks: roles and contents
    joined with a separator that does not occur in text."""
    return F.array_join(F.transform(messages, lambda m: F.concat_ws(
        "␟", m["role"], F.coalesce(m["content"], F.lit("␀")))), sep)
