"""Chat-template expressions on ``array<struct<role, content>>`` columns.

All rendering is native (``transform`` + ``array_join``), so it stays inside
whole-stage code generation; no Python worker is involved.

``array_join`` and ``concat_ws`` silently skip null elements, which would
render a message with null content as if that turn did not exist. The render
functions therefore return null for such a record (``on_null="reject"``) or
fail the job (``on_null="error"``); they never drop a turn unseen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the served model's template and default system
# text, so that training text and inference prompts line up):
#   one message       = "<|" + role + "|>\n" + content + "</s>\n"
#   generation cue    = "<|assistant|>\n"
#   default system    = the sentence below
# ---------------------------------------------------------------------------
ROLE_OPEN = "<|"
ROLE_CLOSE = "|>\n"
END_OF_TURN = "</s>\n"
GENERATION_CUE = "<|assistant|>\n"
DEFAULT_SYSTEM = (
    "You are a creative Dungeons & Dragons dungeon master's assistant. "
    "You help create memorable characters, compelling quests, immersive dialog, "
    "vivid locations, and exciting encounters for D&D campaigns."
)

def message(role: Column | str, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), content.alias("content"))


def render_one(role: Column, content: Column) -> Column:
    """One message in the template; null if role or content is null."""
    return F.concat(F.lit(ROLE_OPEN), role, F.lit(ROLE_CLOSE), content,
                    F.lit(END_OF_TURN))


def has_null_part(messages: Column) -> Column:
    return F.exists(messages, lambda m: m["content"].isNull() | m["role"].isNull())


def render_messages(messages: Column, add_generation_prompt: bool = False,
                    on_null: str = "reject") -> Column:
    """Render every message; optionally append the open assistant cue.

    ``on_null``: ``"reject"`` gives null text for a record with a null role
    or content; ``"error"`` raises; ``"empty"`` renders null content as "".
    """
    msgs = messages
    if on_null == "empty":
        msgs = F.transform(messages, lambda m: message(
            F.coalesce(m["role"], F.lit("")), F.coalesce(m["content"], F.lit(""))))
    text = F.array_join(F.transform(msgs, lambda m: render_one(m["role"], m["content"])), "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(GENERATION_CUE))
    if on_null == "empty":
        return text
    bad = has_null_part(messages)
    if on_null == "error":
        return F.when(bad, F.raise_error(F.lit("chat record has a null role or content"))
                      ).otherwise(text)
    return F.when(~bad, text)


def without_system(messages: Column) -> Column:
    return F.filter(messages, lambda m: ~m["role"].eqNullSafe(F.lit("system")))


def normalize_system(messages: Column, system: str | Column = DEFAULT_SYSTEM) -> Column:
    """Drop every system message and put one fixed system message first."""
    sys_col = F.lit(system) if isinstance(system, str) else system
    return F.concat(F.array(message("system", sys_col)), without_system(messages))


def first_system_content(messages: Column) -> Column:
    return F.try_element_at(F.filter(messages, lambda m: m["role"].eqNullSafe(F.lit("system"))),
                            F.lit(1))["content"]


def last_index_of_role(messages: Column, role: str) -> Column:
    """1-based index of the last message with ``role``; null when absent."""
    pos = F.array_position(F.reverse(F.transform(messages, lambda m: m["role"])), role)
    return F.when(pos > 0, F.size(messages) - pos + 1)


def inference_prompt(messages: Column, default_system: str = DEFAULT_SYSTEM,
                     on_null: str = "reject") -> Column:
    """Serving prompt: system (the record's own, else the default), then the
    non-system turns up to and including the last user turn, then the open
    assistant cue. Null when there is no user turn."""
    last_user = last_index_of_role(messages, "user")
    head = F.slice(messages, F.lit(1), F.coalesce(last_user, F.lit(0)))
    system = F.coalesce(first_system_content(messages), F.lit(default_system))
    msgs = F.concat(F.array(message("system", system)), without_system(head))
    return F.when(last_user.isNotNull(),
                  render_messages(msgs, add_generation_prompt=True, on_null=on_null))


def last_message(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))
