"""Registered queries and their DuckDB twins.

Each query takes ``(spark, sf_dir)``, reads the driver's tables (whole
tables, no subsets) and returns a DataFrame of scalar columns;
``ORACLES[name]`` is the same computation written independently in SQL for
DuckDB over the same Parquet files. Column names match exactly.

Test-table roles: ``conversations`` are chat records (one per ``conv_id``);
``documents`` are a prompt pool with ``lang`` as the category; ``orders`` are
plan rows (``o_orderkey`` as the slot); ``part.p_name`` is a base-prompt pool;
``events.props`` is a JSON body.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialforge.functions import chat
from dialforge.functions.draw import pick_from_array, pick_from_list_sql, sql_str, u, u_sql
from dialforge.functions.permute import PRIME, ROUNDS, round_keys
from dialforge.operators import generation as gen
from dialforge.operators import identity
from dialforge.operators import messages as msg
from dialforge.operators import metrics as mt
from dialforge.operators import planning as pl
from dialforge.operators import sampling as sa
from dialforge.operators import split as sp
from dialforge.operators import tokens as tk
from dialforge.plans import build_dataset as bd
from dialforge.plans import prepare_training as pt
from dialforge.schemas import CHAT_RECORD
from dialforge.session import read_table, scratch_path
from dialforge.sources import catalog as cat
from dialforge.sources import jsonl, shapes, store
from dialforge.sources import sink as sk

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

SEED = 42
NL = "chr(10)"
US, RS, NULLMARK = "␟", "␞", "␀"   # separators of the flattened fingerprints
FORM_LIST = list(gen.FORMS)
PROVIDERS_RUN = ("messages_api", "single_prompt")
DEFAULT_SYS_SQL = sql_str(chat.DEFAULT_SYSTEM)


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def U(keys, tag: str) -> str:
    """SQL draw with a literal tag."""
    return u_sql(SEED, keys, sql_str(tag))


def _render_sql(role: str, text: str) -> str:
    return f"'<|' || {role} || '|>' || {NL} || {text} || '</s>' || {NL}"


def _flat_sql(role: str, text: str, order: str = "turn") -> str:
    return (f"string_agg({role} || '{US}' || coalesce({text}, '{NULLMARK}'), '{RS}' "
            f"ORDER BY {order})")


# ------------------------------------------------------------------ helpers

def _conversations(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "conversations")


def _records(spark, sf_dir) -> DataFrame:
    """conversations -> one messages record per conversation."""
    return msg.assemble_from_turns(_conversations(spark, sf_dir))


def _n_messages(col: str = "messages"):
    return F.size(col).cast("long").alias("n_messages")


def _doc_pool(spark, sf_dir, with_text: bool = False) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return cat.pool_from_table(docs, "lang", "doc_id", "text" if with_text else None)


def _order_plan(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slot_id"))


_W_SQL = "w AS (SELECT lang AS category, CAST(count(*) AS BIGINT) AS weight FROM documents GROUP BY lang)"
_B_SQL = ("b AS (SELECT category, weight, CAST(sum(weight) OVER (ORDER BY category ROWS BETWEEN "
          "UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS hi FROM w)")
_DRAW_SQL = (f"d AS (SELECT p.slot_id, b.category FROM (SELECT o_orderkey AS slot_id, "
             f"{U('o_orderkey', 'cat')} % (SELECT CAST(sum(weight) AS BIGINT) FROM w) AS s "
             f"FROM orders) p JOIN b ON p.s >= b.hi - b.weight AND p.s < b.hi)")
_POOL_SQL = (f"pool AS (SELECT lang AS category, doc_id, text, row_number() OVER (PARTITION BY lang "
             f"ORDER BY {U('doc_id', 'pool')}, doc_id) - 1 AS idx FROM documents), "
             f"sz AS (SELECT category, count(*) AS n FROM pool GROUP BY category)")


# ====================================================== 2.1 sources and sinks

@register("catalog_prompts", f"""
SELECT lang AS category,
       row_number() OVER (PARTITION BY lang ORDER BY {U('doc_id', 'pool')}, doc_id) - 1 AS idx,
       doc_id
FROM documents""")
def q_catalog_prompts(spark, sf_dir):
    """#1 a table as the prompt catalogue: category = lang, items numbered."""
    idx = sa.index_pool(_doc_pool(spark, sf_dir), SEED)
    return idx.select("category", "idx", F.col("item_id").alias("doc_id"))


@register("chat_jsonl_roundtrip", f"""
SELECT conv_id, count(*) AS n_messages, {_flat_sql('role', 'text')} AS flat
FROM conversations GROUP BY conv_id""")
def q_chat_jsonl_roundtrip(spark, sf_dir):
    """#3/#4 append records as JSON Lines, scan them back strictly."""
    path = scratch_path(spark, "chat-jsonl")
    recs = _records(spark, sf_dir).withColumn("category", F.lit("chat"))
    jsonl.write_records(recs, path, mode="append")
    back = jsonl.read_records(spark, path, schema=recs.schema, strict=True)
    return back.select("conv_id", _n_messages(), msg.flatten_messages(F.col("messages")).alias("flat"))


SHARD = 16      # conversations of a shard of the written file
_JSON_LINES_SQL = f"""lines AS (
  SELECT conv_id // {SHARD} AS shard, conv_id, turn, role,
         CASE role WHEN 'system' THEN '{{"conv_id":' || conv_id || ',"turn":' || turn || ',"role":'
                   WHEN 'assistant' THEN '{{"conv_id":' || conv_id || ',"turn":' || turn || '}}'
                   ELSE '' END AS line
  FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY conv_id, turn) AS n FROM lines)"""


@register("corrupt_lines", f"""WITH {_JSON_LINES_SQL}
SELECT shard, n AS line, line AS text FROM numbered WHERE role <> 'assistant'""")
def q_corrupt_lines(spark, sf_dir):
    """#3 the lines a strict scan fails on, by file and line: a turn a line, in
    one file a shard; system turns are cut off in the middle, user turns blank."""
    start = F.format_string('{"conv_id":%d,"turn":%d', "conv_id", "turn")
    line = (F.when(F.col("role") == "system", F.concat(start, F.lit(',"role":')))
            .when(F.col("role") == "assistant", F.concat(start, F.lit("}"))).otherwise(F.lit("")))
    path = scratch_path(spark, "corrupt")
    turns = _conversations(spark, sf_dir).withColumn("shard", F.floor(F.col("conv_id") / SHARD))
    (turns.repartition("shard").sortWithinPartitions("shard", "conv_id", "turn").select(line.alias("value"), "shard")
     .write.partitionBy("shard").text(path))
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())])
    bad = jsonl.corrupt_lines(spark, path, schema)
    return bad.select(F.regexp_extract("file", "shard=([0-9]+)", 1).cast("long").alias("shard"), "line", "text")


@register("existing_count", """
SELECT count(DISTINCT conv_id) AS n_lines FROM conversations""")
def q_existing_count(spark, sf_dir):
    """#5 physical line count of the JSON Lines sink."""
    path = scratch_path(spark, "chat-jsonl-count")
    jsonl.write_records(_records(spark, sf_dir).withColumn("category", F.lit("chat")), path)
    return jsonl.line_count_frame(spark, path)


@register("union_provider_shards", f"""
SELECT conv_id,
       CASE {U('conv_id', 'shard')} % 3 WHEN 0 THEN 'messages_api'
            WHEN 1 THEN 'single_prompt' ELSE NULL END AS provider,
       count(*) AS n_messages
FROM conversations GROUP BY conv_id""")
def q_union_provider_shards(spark, sf_dir):
    """#6 three writers' shards (the third without a provider column) read
    back and combined by name, bag semantics."""
    path = scratch_path(spark, "shards")
    recs = _records(spark, sf_dir).withColumn("shard", F.pmod(u(SEED, "conv_id", "shard"), F.lit(3)))
    recs.write.mode("overwrite").partitionBy("shard").json(path)
    schema = recs.drop("shard").schema
    s0 = spark.read.schema(schema).json(f"{path}/shard=0").withColumn("provider", F.lit("messages_api"))
    s1 = spark.read.schema(schema).json(f"{path}/shard=1").withColumn("provider", F.lit("single_prompt"))
    s2 = spark.read.schema(schema).json(f"{path}/shard=2")
    both = store.union_shards(s0, s1, s2)
    return both.select("conv_id", "provider", _n_messages())


# ================================================= 2.2 sampling and planning

@register("union_nested_shards", f"""
WITH m AS (SELECT conv_id, count(*) AS n, arg_max(role, turn) AS last,
                  string_agg(role || '{US}' || coalesce(text, '{NULLMARK}') || '{US}' || CASE WHEN conv_id % 3 = 0 THEN '-' ELSE CAST(turn AS VARCHAR) END,
                             '{RS}' ORDER BY turn) AS flat
           FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_messages, flat, CASE WHEN conv_id % 3 <> 2 THEN CAST(n AS BIGINT) END AS meta_n,
       CASE WHEN conv_id % 3 = 1 THEN last END AS meta_last
FROM m""")
def q_union_nested_shards(spark, sf_dir):
    """#6 three writers of one record: without a field inside the messages, with
    the fields in another order and wider numbers, and without a whole struct."""
    def packed(shard, *fields):
        m = F.array_sort(F.collect_list(F.struct(F.col("turn").alias("t"), F.col("role"), F.col("text").alias("content"))))
        last = F.max_by("role", "turn")
        turns = _conversations(spark, sf_dir).where(F.col("conv_id") % 3 == shard)
        made = {"role": lambda x: x["role"], "content": lambda x: x["content"], "turn": lambda x: x["t"], "small": lambda x: x["t"].cast("int").alias("turn")}
        return turns.groupBy("conv_id").agg(m.alias("m"), F.count(F.lit(1)).alias("n"), last.alias("last")).select(
            "conv_id", F.transform("m", lambda x: F.struct(*[made[f](x).alias("turn" if f == "small" else f) for f in fields])).alias("messages"), "n", "last")

    a = packed(0, "role", "content").select("conv_id", "messages", F.struct(F.col("n").cast("int").alias("n")).alias("meta"))
    b = packed(1, "turn", "content", "role").select(F.struct("last", "n").alias("meta"), "messages", "conv_id")
    c = packed(2, "role", "small", "content").select("conv_id", "messages")
    every = shapes.union_nested(a, b, c)
    flat = F.array_join(F.transform("messages", lambda x: F.concat_ws(
        US, x["role"], F.coalesce(x["content"], F.lit(NULLMARK)), F.coalesce(x["turn"].cast("string"), F.lit("-")))), RS)
    return every.select("conv_id", _n_messages(), flat.alias("flat"), F.col("meta.n").alias("meta_n"), F.col("meta.last").alias("meta_last"))


@register("topup_plan", """
SELECT o.o_orderkey AS slot_id FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_orderkey = o.o_orderkey)""")
def q_topup_plan(spark, sf_dir):
    """#7 keyed top-up: plan rows minus done rows."""
    orders = read_table(spark, sf_dir, "orders")
    plan = orders.select(F.col("o_orderkey").alias("slot_id"))
    done = orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("slot_id"))
    return pl.topup_plan(plan, done)


@register("weighted_slots", f"""
WITH {_W_SQL}, {_B_SQL}
SELECT category, CAST(unnest(range(hi - weight, hi)) AS BIGINT) AS slot FROM b""")
def q_weighted_slots(spark, sf_dir):
    """#8 one row per weight unit, ranges by running sum."""
    weights = cat.weights_from_pool(_doc_pool(spark, sf_dir))
    return sa.weighted_slots(weights)


@register("weighted_draw", f"""
WITH {_W_SQL}, {_B_SQL}, {_DRAW_SQL}
SELECT slot_id, category FROM d""")
def q_weighted_draw(spark, sf_dir):
    """#9/#10 weighted category per plan row (with replacement)."""
    weights = cat.weights_from_pool(_doc_pool(spark, sf_dir))
    return sa.weighted_draw(_order_plan(spark, sf_dir), weights, SEED).select("slot_id", "category")


@register("uniform_prompt_draw", f"""
WITH {_W_SQL}, {_B_SQL}, {_DRAW_SQL}, {_POOL_SQL}
SELECT d.slot_id, d.category, pool.doc_id
FROM d JOIN sz ON sz.category = d.category
JOIN pool ON pool.category = d.category AND pool.idx = {U('d.slot_id', 'prompt')} % sz.n""")
def q_uniform_prompt_draw(spark, sf_dir):
    """#11 uniform draw from the drawn category's pool (large-pool form)."""
    weights = cat.weights_from_pool(_doc_pool(spark, sf_dir))
    drawn = sa.weighted_draw(_order_plan(spark, sf_dir), weights, SEED)
    out = sa.uniform_pool_draw(drawn, _doc_pool(spark, sf_dir), SEED)
    return out.select("slot_id", "category", F.col("item_id").alias("doc_id"))


@register("assign_provider", """
SELECT DISTINCT conv_id, 'messages_api' AS provider_single,
       CASE WHEN conv_id % 2 = 1 THEN 'single_prompt' ELSE 'messages_api' END AS provider_dual
FROM conversations""")
def q_assign_provider(spark, sf_dir):
    """#12 odd slots to the second provider when configured."""
    keys = _conversations(spark, sf_dir).select(F.col("conv_id").alias("slot_id")).distinct()
    a = pl.assign_provider(keys, "messages_api", None, out="provider_single")
    a = pl.assign_provider(a, "messages_api", "single_prompt", out="provider_dual")
    return a.withColumnRenamed("slot_id", "conv_id")


def _catalog_values_sql() -> str:
    """The bundled catalogue inlined as a VALUES table for the SQL twin."""
    import json as _json

    rows = []
    with open(cat.BUNDLED_CATALOG, encoding="utf-8") as f:
        for line in f:
            if line.strip():
                c = _json.loads(line)
                prompts = "[" + ", ".join(sql_str(x) for x in c["prompts"]) + "]"
                rows.append(f"({sql_str(c['category'])}, {c['ord']}, {c['weight']}, "
                            f"{sql_str(c['system'])}, {prompts})")
    return ("catalog(category, ord, weight, system, prompts) AS (VALUES " + ", ".join(rows) + ")")


_CAT_VAR = pick_from_list_sql(SEED, "d.slot_id", sql_str("var"), cat.VARIATIONS)
_CAT_DET = pick_from_list_sql(SEED, "d.slot_id", sql_str("detail"), cat.DETAIL_REQUESTS)


@register("catalog_plan", f"""
WITH {_catalog_values_sql()},
b AS (SELECT *, CAST(sum(weight) OVER (ORDER BY ord, category ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND CURRENT ROW) AS BIGINT) AS hi FROM catalog),
p AS (SELECT o_orderkey AS slot_id,
             {U('o_orderkey', 'cat')} % (SELECT CAST(sum(weight) AS BIGINT) FROM catalog) AS s
      FROM orders),
d AS (SELECT p.slot_id, b.category, b.system AS gen_system, b.prompts
      FROM p JOIN b ON p.s >= b.hi - b.weight AND p.s < b.hi)
SELECT slot_id, category, gen_system,
       d.prompts[({U('d.slot_id', 'prompt')} % len(d.prompts)) + 1] || {_CAT_VAR} || {_CAT_DET} AS user_prompt,
       CASE WHEN slot_id % 2 = 1 THEN 'single_prompt' ELSE 'messages_api' END AS provider
FROM d""")
def q_catalog_plan(spark, sf_dir):
    """#1/#2/#9-#13 the catalogue flow: orders as slots, the bundled
    catalogue (weights, generator system text, short prompt lists) as the
    broadcast lookup, prompt drawn from the category's array."""
    cfg = bd.BuildConfig(seed=SEED, first_provider=PROVIDERS_RUN[0],
                         second_provider=PROVIDERS_RUN[1])
    plan = bd.plan_from_catalog(_order_plan(spark, sf_dir), cat.read_catalog(spark), cfg)
    return plan.select("slot_id", "category", "gen_system", "user_prompt", "provider")


# ================================================ 2.3 projections / scalars

_VAR_SQL = pick_from_list_sql(SEED, "o.o_orderkey", sql_str("var"), cat.VARIATIONS)
_DET_SQL = pick_from_list_sql(SEED, "o.o_orderkey", sql_str("detail"), cat.DETAIL_REQUESTS)


@register("compose_prompt", f"""
WITH pool AS (SELECT p_partkey, p_name,
                     row_number() OVER (ORDER BY {U('p_partkey', 'pool')}, p_partkey) - 1 AS idx
              FROM part)
SELECT o.o_orderkey AS slot_id, pool.p_partkey,
       pool.p_name || {_VAR_SQL} || {_DET_SQL} AS user_prompt
FROM orders o JOIN pool
  ON pool.idx = {U('o.o_orderkey', 'prompt')} % (SELECT count(*) FROM part)""")
def q_compose_prompt(spark, sf_dir):
    """#13 base prompt (a part name drawn uniformly) + variation + detail."""
    parts = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("base_prompt"))
    drawn = sa.uniform_pool_draw(_order_plan(spark, sf_dir), parts, SEED, category=None)
    composed = pl.compose_prompt(pl.draw_modifiers(drawn, SEED))
    return composed.select("slot_id", F.col("item_id").alias("p_partkey"), "user_prompt")


TURNS = 1_048_575  # slots of a conversation; odd, so that both providers get first turns


def _conv_requests(spark, sf_dir, form_by_hash: bool) -> DataFrame:
    """One request per user turn: its text as the prompt, the conversation's
    first system turn (else the default) as the generator system text. The
    latter comes from partial aggregates (``min_by``, ``count``)."""
    turns = _conversations(spark, sf_dir)
    first_system = F.min_by("text", F.when(F.col("role") == "system", F.col("turn")))
    whole = turns.groupBy("conv_id").agg(
        F.concat(F.lit("turns_"), F.count(F.lit(1))).alias("category"),
        F.coalesce(first_system, F.lit(chat.DEFAULT_SYSTEM)).alias("gen_system"))
    plan = turns.where("role = 'user'").join(whole, "conv_id").select(
        (F.col("conv_id") * TURNS + F.col("turn")).alias("slot_id"), "category", "gen_system",
        F.col("text").alias("user_prompt"))
    if form_by_hash:
        forms = F.array(*[F.lit(f) for f in FORM_LIST])
        return plan.withColumn("provider", pick_from_array(SEED, "slot_id", "form", forms))
    return pl.assign_provider(plan, *PROVIDERS_RUN)


_CONV_PLAN_SQL = f"""a AS (
  SELECT conv_id, concat('turns_', count(*)) AS category,
         coalesce(arg_min(text, turn) FILTER (WHERE role = 'system'), {DEFAULT_SYS_SQL}) AS gen_system
  FROM conversations GROUP BY conv_id),
c AS (SELECT t.conv_id * {TURNS} + t.turn AS slot_id, a.category, a.gen_system, t.text AS user_prompt
      FROM conversations t JOIN a ON a.conv_id = t.conv_id WHERE t.role = 'user')"""

_FORMS_SQL = "[" + ", ".join(sql_str(f) for f in FORM_LIST) + "]"


@register("shape_request", f"""
WITH {_CONV_PLAN_SQL},
p AS (SELECT *, {_FORMS_SQL}[({U('slot_id', 'form')} % 4) + 1] AS provider FROM c)
SELECT slot_id, provider, 'default' AS model,
       CASE provider WHEN 'messages_api' THEN '2000' WHEN 'single_prompt' THEN NULL ELSE '2048' END AS max_tokens,
       CASE WHEN provider IN ('chat_completions', 'local_chat') THEN 0.8::DOUBLE END AS temperature,
       CASE WHEN provider = 'single_prompt' OR user_prompt IS NULL THEN NULL ELSE gen_system END AS sent_system,
       CASE WHEN provider = 'single_prompt' THEN gen_system || {NL} || {NL} || user_prompt
            ELSE user_prompt END AS sent_prompt,
       CASE WHEN user_prompt IS NULL OR provider = 'single_prompt' THEN NULL
            WHEN provider = 'messages_api' THEN '2000' ELSE '2048' END AS body_cap
FROM p""")
def q_shape_request(spark, sf_dir):
    """#14 the four request forms; the JSON body is checked field by field."""
    shaped = gen.shape_request(_conv_requests(spark, sf_dir, form_by_hash=True))
    p, b = F.col("provider"), F.col("body")
    sent_system = (F.when(p == "messages_api", F.get_json_object(b, "$.system"))
                   .when(p.isin("chat_completions", "local_chat"),
                         F.get_json_object(b, "$.messages[0].content")))
    sent_prompt = (F.when(p == "single_prompt", F.get_json_object(b, "$.contents"))
                   .when(p == "messages_api", F.get_json_object(b, "$.messages[0].content"))
                   .otherwise(F.get_json_object(b, "$.messages[1].content")))
    body_cap = (F.when(p == "local_chat", F.get_json_object(b, "$.options.num_predict"))
                .otherwise(F.get_json_object(b, "$.max_tokens")))
    return shaped.select("slot_id", "provider", F.col("request.model").alias("model"),
                         F.col("request.max_tokens").cast("string").alias("max_tokens"),
                         F.col("request.temperature").alias("temperature"),
                         sent_system.alias("sent_system"), sent_prompt.alias("sent_prompt"),
                         body_cap.alias("body_cap"))


@register("extract_response", f"""
SELECT conv_id, turn, {_FORMS_SQL}[({U(['conv_id', 'turn'], 'form')} % 4) + 1] AS provider,
       text, CAST(NULL AS VARCHAR) AS error
FROM conversations WHERE role = 'assistant'""")
def q_extract_response(spark, sf_dir):
    """#15 reply bodies in the four forms (built with to_json) -> text."""
    turns = _conversations(spark, sf_dir).where(F.col("role") == "assistant")
    forms = F.array(*[F.lit(f) for f in FORM_LIST])
    wrapped = (turns.withColumn("provider", pick_from_array(SEED, ["conv_id", "turn"], "form", forms))
               .withColumn("raw", gen.reply_body(F.col("provider"), F.col("text")))
               .drop("text"))
    return gen.extract_response(wrapped).select("conv_id", "turn", "provider", "text", "error")


_VALUE_KIND_SQL = """CASE WHEN role = 'user' AND turn = 0 THEN 'missing' WHEN role = 'assistant' AND turn = 1 THEN 'BOOLEAN'
  WHEN role = 'system' THEN 'BIGINT' WHEN role = 'assistant' THEN 'parts' ELSE 'string' END"""


@register("extract_variant", f"""
WITH k AS (SELECT *, {_VALUE_KIND_SQL} AS kind FROM conversations),
t AS (SELECT *, CASE kind WHEN 'string' THEN text WHEN 'parts' THEN text || role || text END AS found FROM k)
SELECT conv_id, turn, {_FORMS_SQL}[({U(['conv_id', 'turn'], 'form')} % 4) + 1] AS provider,
       CASE WHEN found <> '' THEN found END AS text,
       CASE WHEN kind = 'missing' THEN '{gen.ERR_NO_CONTENT}'
            WHEN kind IN ('BOOLEAN', 'BIGINT') THEN '{gen.ERR_WRONG_TYPE}: ' || kind
            WHEN kind = 'parts' AND found IS NULL THEN '{gen.ERR_WRONG_TYPE}: ARRAY<OBJECT<text: VOID, type: STRING>>'
            WHEN found IS NULL THEN '{gen.ERR_NO_CONTENT}' WHEN found = '' THEN '{gen.ERR_EMPTY}' END AS error
FROM t""")
def q_extract_variant(spark, sf_dir):
    """#15 replies of all forms whose content is a string, a list of parts, a
    number or a truth value, or is not there."""
    def quoted(c):
        listed = F.to_json(F.array(c), {"ignoreNullFields": "false"})
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    def part(c):
        return F.concat(F.lit('{"type":"text","text":'), quoted(c), F.lit("}"))

    role, first = F.col("role"), F.col("turn")
    value = (F.when((role == "assistant") & (first == 1), F.lit("true")).when(role == "system", F.col("conv_id").cast("string"))
             .when(role == "assistant", F.concat(F.lit("["), part(F.col("text")), F.lit(","), quoted(role), F.lit(","), part(F.col("text")), F.lit("]")))
             .otherwise(quoted(F.col("text"))))
    p = F.col("provider")
    raw = (F.when((role == "user") & (first == 0), F.lit('{"other":[1,{"text":"x"}]}'))
           .when(p == "messages_api", F.concat(F.lit('{"content":[{"type":"text","text":'), value, F.lit("}]}")))
           .when(p == "single_prompt", F.concat(F.lit('{"candidates":[{"content":{"parts":[{"text":'), value, F.lit("}]}}]}")))
           .when(p == "chat_completions", F.concat(F.lit('{"choices":[{"message":{"content":'), value, F.lit("}}]}")))
           .otherwise(F.concat(F.lit('{"message":{"content":'), value, F.lit("}}"))))
    forms = F.array(*[F.lit(f) for f in FORM_LIST])
    turns = _conversations(spark, sf_dir).withColumn("provider", pick_from_array(SEED, ["conv_id", "turn"], "form", forms))
    return gen.extract_variant(turns.withColumn("raw", raw).drop("text")).select("conv_id", "turn", "provider", "text", "error")


@register("extract_json_field", """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def q_extract_json_field(spark, sf_dir):
    """#15 the same path extraction on an arbitrary JSON body column."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@register("assemble_messages", f"""
SELECT conv_id, count(*) AS n_messages, {_flat_sql('role', 'text')} AS flat
FROM conversations GROUP BY conv_id""")
def q_assemble_messages(spark, sf_dir):
    """#16 turn rows -> ordered messages array."""
    return _records(spark, sf_dir).select(
        "conv_id", _n_messages(), msg.flatten_messages(F.col("messages")).alias("flat"))


@register("normalize_system", f"""
SELECT conv_id, 1 + count(*) FILTER (WHERE role <> 'system') AS n_messages,
       'system{US}' || {DEFAULT_SYS_SQL}
       || coalesce('{RS}' || {_flat_sql('role', 'text')} FILTER (WHERE role <> 'system'), '') AS flat
FROM conversations GROUP BY conv_id""")
def q_normalize_system(spark, sf_dir):
    """#17 one fixed system message first, others dropped."""
    recs = msg.normalize_system(_records(spark, sf_dir))
    return recs.select("conv_id", _n_messages(), msg.flatten_messages(F.col("messages")).alias("flat"))


@register("render_chat", f"""
SELECT conv_id, string_agg({_render_sql('role', 'text')}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def q_render_chat(spark, sf_dir):
    """#18/#31 training text of every message, no generation cue."""
    return msg.render_chat(_records(spark, sf_dir)).select("conv_id", "text")


@register("render_inference_prompt", f"""
WITH lu AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'user') AS last_user,
                   coalesce(arg_min(text, turn) FILTER (WHERE role = 'system'), {DEFAULT_SYS_SQL}) AS sys
            FROM conversations GROUP BY conv_id)
SELECT c.conv_id,
       {_render_sql("'system'", 'lu.sys')}
       || string_agg({_render_sql('c.role', 'c.text')}, '' ORDER BY c.turn)
       || '<|assistant|>' || {NL} AS prompt
FROM conversations c JOIN lu ON lu.conv_id = c.conv_id
WHERE c.role <> 'system' AND c.turn <= lu.last_user
GROUP BY c.conv_id, lu.sys""")
def q_render_inference_prompt(spark, sf_dir):
    """#19 serving prompt: system, turns up to the last user turn, open cue."""
    return msg.render_inference_prompt(_records(spark, sf_dir)).select("conv_id", "prompt")


@register("last_message", """
SELECT conv_id, arg_max(role, turn) AS last_role, arg_max(text, turn) AS last_content
FROM conversations GROUP BY conv_id""")
def q_last_message(spark, sf_dir):
    """#20 the final message of each record (partial aggregate on turns)."""
    return msg.last_message_from_turns(_conversations(spark, sf_dir))


_WS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NTOK_SQL = "CAST(len(regexp_extract_all({t}, '\\S+')) AS BIGINT)"


def _capped_sql(t: str, cap: int) -> str:
    """Original text cut after its cap-th whitespace token (SQL twin)."""
    toks = f"regexp_split_to_array(trim({t}, {_WS_SQL}), '\\s+')"
    seps = f"regexp_extract_all(trim({t}, {_WS_SQL}), '\\s+')"
    lead = f"(length({t}) - length(ltrim({t}, {_WS_SQL})))"
    cut = (f"{lead} + list_sum(list_transform(({toks})[1:{cap}], lambda x: length(x))) "
           f"+ coalesce(list_sum(list_transform(({seps})[1:{cap - 1}], lambda x: length(x))), 0)")
    return f"substr({t}, 1, CAST({cut} AS BIGINT))"


@register("truncate_tokens", f"""
WITH t AS (SELECT doc_id, text, {_NTOK_SQL.format(t='text')} AS n FROM documents)
SELECT doc_id, n AS n_tokens, n > {tk.MAX_SEQ_LENGTH} AS truncated,
       md5(CASE WHEN n > {tk.MAX_SEQ_LENGTH} THEN {_capped_sql('text', tk.MAX_SEQ_LENGTH)} ELSE text END)
         AS capped_md5
FROM t""")
def q_truncate_tokens(spark, sf_dir):
    """#21 cap at 2048 (whitespace) tokens; flag the capped rows."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    capped = tk.truncate_tokens(docs, "text")
    return capped.select("doc_id", "n_tokens", "truncated", F.md5("text_capped").alias("capped_md5"))


# ============================================ 2.4-2.5 generation run, counts

def _run_results(spark, sf_dir) -> DataFrame:
    """The conversation generation run: plan -> offline backend -> results
    (text and verdict parsed once) written to the shared folder -> read back."""
    path = scratch_path(spark, "conv-run")
    plan = _conv_requests(spark, sf_dir, form_by_hash=False)
    cfg = bd.BuildConfig(seed=SEED, first_provider=PROVIDERS_RUN[0],
                         second_provider=PROVIDERS_RUN[1])
    schema = bd.generate(spark, plan, gen.offline_backend(SEED), f"{path}/results", cfg)
    return bd.results_view(spark.read.schema(schema).parquet(f"{path}/results"))


_ENDINGS_SQL = "[" + ", ".join(sql_str(s) for s in gen.OFFLINE_ENDINGS) + "]"
_KINDS_SQL = "[" + ", ".join(sql_str(s) for s in gen.FAULT_KINDS) + "]"

_RUN_SQL = f"""WITH {_CONV_PLAN_SQL},
p AS (SELECT *, CASE WHEN slot_id % 2 = 1 THEN 'single_prompt' ELSE 'messages_api' END AS provider FROM c),
g AS (SELECT *, {U('slot_id', 'fault')} % 20 = 0 AS faulty,
             {_KINDS_SQL}[({U('slot_id', 'fault_kind')} % 4) + 1] AS kind,
             CASE WHEN provider = 'single_prompt' THEN gen_system || {NL} || {NL} || user_prompt
                  ELSE user_prompt END AS sent
      FROM p),
r AS (SELECT slot_id, category, provider, user_prompt,
             CASE WHEN faulty OR user_prompt IS NULL THEN NULL
                  ELSE {sql_str(gen.OFFLINE_PREFIX)} || sent || {_ENDINGS_SQL}[({U('slot_id', 'reply')} % 3) + 1]
             END AS text,
             CASE WHEN user_prompt IS NULL THEN '{gen.ERR_NO_REQUEST}'
                  WHEN NOT faulty THEN NULL
                  WHEN kind = 'raise' THEN 'RuntimeError: injected fault'
                  WHEN kind = 'malformed' THEN '{gen.ERR_MALFORMED}'
                  WHEN kind = 'null' THEN '{gen.ERR_NO_CONTENT}'
                  ELSE '{gen.ERR_EMPTY}' END AS error
      FROM g)"""


@register("bulk_generate", f"""{_RUN_SQL}
SELECT slot_id, provider, text, error FROM r""")
def q_bulk_generate(spark, sf_dir):
    """#30 one backend call per plan row, row-level error capture."""
    return _run_results(spark, sf_dir).select("slot_id", "provider", "text", "error")


@register("stream_generate", f"""{_RUN_SQL}
SELECT slot_id, provider, text, error FROM r""")
def q_stream_generate(spark, sf_dir):
    """#30/#32 the same run as checkpointed waves (Structured Streaming,
    availableNow): plan files -> foreachBatch generate -> per-wave results."""
    from dialforge import streaming as st

    path = scratch_path(spark, "conv-stream")
    st.write_plan_files(_conv_requests(spark, sf_dir, form_by_hash=False), f"{path}/plan", files=4)
    st.generate_stream(spark, f"{path}/plan", f"{path}/results", f"{path}/checkpoint",
                       gen.offline_backend(SEED), files_per_wave=1)
    return st.read_wave_results(spark, f"{path}/results").select("slot_id", "provider", "text", "error")


@register("generation_successes", f"""{_RUN_SQL}
SELECT slot_id, provider, text FROM r WHERE error IS NULL""")
def q_generation_successes(spark, sf_dir):
    """#22 keep successes."""
    return gen.successes(_run_results(spark, sf_dir)).select("slot_id", "provider", "text")


@register("generation_failures", f"""{_RUN_SQL}
SELECT slot_id, provider, error FROM r WHERE error IS NOT NULL""")
def q_generation_failures(spark, sf_dir):
    """#23 failure quarantine, keyed for a retry top-up."""
    return gen.failures(_run_results(spark, sf_dir)).select("slot_id", "provider", "error")


@register("category_counts", f"""
WITH {_CONV_PLAN_SQL}
SELECT category, count(*) AS attempts FROM c GROUP BY category""")
def q_category_counts(spark, sf_dir):
    """#24 counts over attempts (the plan), failures included."""
    return mt.category_counts(_conv_requests(spark, sf_dir, form_by_hash=False))


_ALL_PROVIDERS_SQL = " UNION ALL ".join(f"SELECT {sql_str(f)} AS provider" for f in FORM_LIST)


@register("provider_counts", f"""{_RUN_SQL},
names AS ({_ALL_PROVIDERS_SQL})
SELECT names.provider, CAST(count(r.slot_id) AS BIGINT) AS successes
FROM names LEFT JOIN r ON r.provider = names.provider AND r.error IS NULL
GROUP BY names.provider""")
def q_provider_counts(spark, sf_dir):
    """#25 successes per configured provider, 0 when none."""
    return mt.provider_counts(spark, _run_results(spark, sf_dir), FORM_LIST)


@register("run_summary", f"""{_RUN_SQL}
SELECT count(*) AS attempted, count(*) FILTER (WHERE error IS NULL) AS generated,
       count(*) FILTER (WHERE error IS NOT NULL) AS failed
FROM r""")
def q_run_summary(spark, sf_dir):
    """#26 attempted, generated, failed."""
    return mt.run_summary(_run_results(spark, sf_dir))


# =============================================== 2.6 split and batching

_SPLIT_SQL = f"""r AS (
  SELECT doc_id, row_number() OVER (ORDER BY {U('doc_id', 'split')}, doc_id) AS rk,
         count(*) OVER () AS n
  FROM documents),
s AS (SELECT doc_id, CASE WHEN rk <= CAST(ceil(0.05::DOUBLE * n) AS BIGINT) THEN 'eval' ELSE 'train' END AS split
      FROM r)"""


@register("train_eval_split", f"""WITH {_SPLIT_SQL}
SELECT doc_id, split FROM s""")
def q_train_eval_split(spark, sf_dir):
    """#28 exact-size seeded split, 5 % eval."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sp.train_eval_split(docs, "doc_id", seed=SEED).select("doc_id", "split")


def _part_sql(c: str) -> str:
    return f"coalesce(length({c}) || ':' || {c}, '-')"


@register("stable_split", f"""
WITH one AS (
  SELECT conv_id, sha256(string_agg({_part_sql('role')} || {_part_sql('text')}, '' ORDER BY turn)) AS content_key
  FROM conversations GROUP BY conv_id),
twice AS (SELECT content_key FROM one UNION ALL SELECT content_key FROM one),
n AS (SELECT content_key, row_number() OVER (PARTITION BY content_key) - 1 AS copy FROM twice),
r AS (SELECT *, row_number() OVER (ORDER BY {U("content_key || '-' || copy", 'split')}, content_key || '-' || copy) AS rk,
             count(*) OVER () AS total FROM n)
SELECT content_key, copy, CASE WHEN rk <= CAST(ceil(0.05::DOUBLE * total) AS BIGINT) THEN 'eval' ELSE 'train' END AS split
FROM r""")
def q_stable_split(spark, sf_dir):
    """#28/#33 the split of records without ids that were delivered twice: by
    content and number of the copy, whatever the files."""
    records = _records(spark, sf_dir).select("messages")
    records = records.unionByName(records)
    made = identity.with_record_id(records, identity.record_content(category=None))
    split = sp.train_eval_split(made, "record_id", seed=SEED)
    parts = F.split("record_id", "-")
    return split.select(parts[0].alias("content_key"), parts[1].cast("long").alias("copy"), "split")


@register("split_sizes", f"""WITH {_SPLIT_SQL}
SELECT split, count(*) AS n_rows FROM s GROUP BY split""")
def q_split_sizes(spark, sf_dir):
    """#27 rows per split."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sp.split_sizes(sp.train_eval_split(docs, "doc_id", seed=SEED))


@register("batch_manifest", f"""
WITH e AS (SELECT CAST(unnest(range(0, {sp.EPOCHS})) AS INTEGER) AS epoch),
r AS (SELECT e.epoch, d.doc_id,
             row_number() OVER (PARTITION BY e.epoch
                                ORDER BY {u_sql(SEED, 'd.doc_id', "'epoch:' || e.epoch")}, d.doc_id) - 1 AS position
      FROM documents d, e)
SELECT epoch, doc_id, position, position // {sp.MICRO_BATCH} AS micro_batch,
       position // {sp.MICRO_BATCH * sp.ACCUMULATION} AS step
FROM r""")
def q_batch_manifest(spark, sf_dir):
    """#29 per-epoch order, micro-batches and optimiser steps."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sp.batch_manifest(docs, "doc_id").select("epoch", "doc_id", "position",
                                                    "micro_batch", "step")


_KEYS_SQL = " UNION ALL ".join(
    f"SELECT {e} AS epoch, {r} AS k, {a}::BIGINT AS a, {b}::BIGINT AS b, {c}::BIGINT AS c, {d}::BIGINT AS d"
    for e in range(sp.EPOCHS) for r, (a, b, c, d) in enumerate(round_keys(SEED, f"epoch:{e}")))
_RIGHT_BITS = "CASE WHEN (w.k % {rounds}) % 2 = 0 THEN m // 2 ELSE m - m // 2 END".format(rounds=ROUNDS)


@register("permuted_manifest", f"""
WITH RECURSIVE keys AS ({_KEYS_SQL}),
ids AS (SELECT doc_id, row_number() OVER (ORDER BY {U('doc_id', 'manifest')}, doc_id) - 1 AS place FROM documents),
size AS (SELECT count(*) AS n, greatest(2, CASE WHEN count(*) <= 1 THEN 0 ELSE length(bin(count(*) - 1)) END) AS m FROM documents),
w AS (
  SELECT e.epoch, i.doc_id, i.place AS x, 0 AS k FROM ids i, (SELECT DISTINCT epoch FROM keys) e
  UNION ALL
  SELECT epoch, doc_id, (low << (m - r)) | xor(high, ((((a * low + b) % {PRIME}) * ((low + c) % {PRIME}) + d) % {PRIME}) & ((1::BIGINT << (m - r)) - 1)), k + 1
  FROM (SELECT w.epoch, w.doc_id, w.k % {ROUNDS} AS k, m, {_RIGHT_BITS} AS r, keys.a, keys.b, keys.c, keys.d,
               w.x & ((1::BIGINT << ({_RIGHT_BITS})) - 1) AS low, w.x >> ({_RIGHT_BITS}) AS high
        FROM w, size JOIN keys ON keys.epoch = w.epoch AND keys.k = w.k % {ROUNDS}
        WHERE w.k < {ROUNDS} OR w.x >= n) s)
SELECT CAST(epoch AS INTEGER) AS epoch, doc_id, x AS position, x // {sp.MICRO_BATCH} AS micro_batch,
       x // {sp.MICRO_BATCH * sp.ACCUMULATION} AS step
FROM w, size WHERE k = {ROUNDS} AND x < n""")
def q_permuted_manifest(spark, sf_dir):
    """#29 one rank of the ids, permuted anew in every epoch; written as ordered
    shards and read back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    manifest = sp.permuted_manifest(docs, "doc_id", seed=SEED)
    path = scratch_path(spark, "permuted")
    sp.write_positions(manifest, path, docs.count())
    return spark.read.schema(manifest.schema).parquet(path).select("epoch", "doc_id", "position", "micro_batch", "step")


# ================================================= 2.7 end-to-end jobs

def _pool_weights(spark, sf_dir) -> DataFrame:
    w = cat.weights_from_pool(_doc_pool(spark, sf_dir))
    return w.withColumn("gen_system", F.concat(
        F.lit("Reply in the language of the prompt ("), F.col("category"), F.lit(").")))


_BUILD_VAR = pick_from_list_sql(SEED, "d.slot_id", sql_str("var"), cat.VARIATIONS)
_BUILD_DET = pick_from_list_sql(SEED, "d.slot_id", sql_str("detail"), cat.DETAIL_REQUESTS)


_BUILD_PLAN_SQL = f"""WITH {_W_SQL}, {_B_SQL}, {_DRAW_SQL}, {_POOL_SQL},
p AS (
  SELECT d.slot_id, d.category, pool.doc_id,
         'Reply in the language of the prompt (' || d.category || ').' AS gen_system,
         pool.text || {_BUILD_VAR} || {_BUILD_DET} AS user_prompt,
         CASE WHEN d.slot_id % 2 = 1 THEN 'single_prompt' ELSE 'messages_api' END AS provider
  FROM d JOIN sz ON sz.category = d.category
  JOIN pool ON pool.category = d.category AND pool.idx = {U('d.slot_id', 'prompt')} % sz.n),
g AS (SELECT *, {U('slot_id', 'fault')} % 20 = 0 AS faulty,
             {_KINDS_SQL}[({U('slot_id', 'fault_kind')} % 4) + 1] AS kind,
             CASE WHEN provider = 'single_prompt' THEN gen_system || {NL} || {NL} || user_prompt
                  ELSE user_prompt END AS sent
      FROM p)"""


def _triplet_sql(user: str, assistant: str) -> str:
    """The stored record, flattened."""
    return (f"'system{US}' || {DEFAULT_SYS_SQL} || '{RS}user{US}' || {user} "
            f"|| '{RS}assistant{US}' || {assistant}")


def _exported(spark, path: str) -> DataFrame:
    """The exported JSON Lines, scanned back strictly and flattened."""
    schema = T.StructType([T.StructField("slot_id", T.LongType()), T.StructField("provider", T.StringType()),
                           *CHAT_RECORD.fields])
    back = jsonl.read_records(spark, path, schema=schema, strict=True)
    return back.select("slot_id", "provider", "category", _n_messages(),
                       msg.flatten_messages(F.col("messages")).alias("flat"))


@register("build_dataset", f"""{_BUILD_PLAN_SQL}
SELECT slot_id, category, provider, doc_id, user_prompt,
       CASE WHEN faulty THEN NULL
            ELSE {sql_str(gen.OFFLINE_PREFIX)} || sent || {_ENDINGS_SQL}[({U('slot_id', 'reply')} % 3) + 1]
       END AS text,
       CASE WHEN NOT faulty THEN NULL
            WHEN kind = 'raise' THEN 'RuntimeError: injected fault'
            WHEN kind = 'malformed' THEN '{gen.ERR_MALFORMED}'
            WHEN kind = 'null' THEN '{gen.ERR_NO_CONTENT}'
            ELSE '{gen.ERR_EMPTY}' END AS error
FROM g""")
def q_build_dataset(spark, sf_dir):
    """#32 flagship: orders as slots, documents as the pool (lang =
    category), offline backend with faults; plan and results written to the
    shared folder, then the stored text and verdicts read back."""
    cfg = bd.BuildConfig(seed=SEED, first_provider=PROVIDERS_RUN[0],
                         second_provider=PROVIDERS_RUN[1])
    pool = _doc_pool(spark, sf_dir, with_text=True)
    plan = bd.plan_from_pool(_order_plan(spark, sf_dir), pool, _pool_weights(spark, sf_dir), cfg, texts=False)
    out = bd.build_dataset(spark, plan, gen.offline_backend(SEED), scratch_path(spark, "build"), cfg, pool=pool)
    ext = bd.results_view(out["results"])
    return ext.select("slot_id", "category", "provider", F.col("item_id").alias("doc_id"),
                      "user_prompt", "text", "error")


@register("build_topup", f"""{_BUILD_PLAN_SQL},
t AS (SELECT *, {sql_str(gen.OFFLINE_PREFIX)} || sent || {_ENDINGS_SQL}[({U('slot_id', 'reply')} % 3) + 1] AS text FROM g)
SELECT slot_id, provider, category, CAST(3 AS BIGINT) AS n_messages, {_triplet_sql('user_prompt', 'text')} AS flat
FROM t""")
def q_build_topup(spark, sf_dir):
    """#7/#32 a build on part of the slots with a faulty generator and no
    export, then on all of them with a sound one: the exported file, read
    back, holds one record per slot, as after one full run."""
    cfg = bd.BuildConfig(seed=SEED, first_provider=PROVIDERS_RUN[0], second_provider=PROVIDERS_RUN[1], export_codec="gzip")
    pool, weights = _doc_pool(spark, sf_dir, with_text=True), _pool_weights(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "slot_id")
    out = scratch_path(spark, "topup")
    first = bd.plan_from_pool(orders.where("o_orderstatus = 'F'").select("slot_id"), pool, weights, cfg, texts=False)
    bd.build_dataset(spark, first, gen.offline_backend(SEED), f"{out}/build", cfg, pool=pool)
    every = bd.plan_from_pool(orders.select("slot_id"), pool, weights, cfg, texts=False)
    bd.build_dataset(spark, every, gen.offline_backend(SEED, fault_every=0), f"{out}/build", cfg,
                     export_path=f"{out}/records.jsonl", pool=pool)
    return _exported(spark, f"{out}/records.jsonl")


def _conv_build(spark, sf_dir, runs: int = 1, export: str | None = None) -> dict[str, DataFrame]:
    cfg = bd.BuildConfig(seed=SEED, first_provider=PROVIDERS_RUN[0], second_provider=PROVIDERS_RUN[1])
    plan, path = _conv_requests(spark, sf_dir, form_by_hash=False), scratch_path(spark, "conv-build")
    for _ in range(runs):
        out = bd.build_dataset(spark, plan, gen.offline_backend(SEED), path, cfg, export_path=export)
    return out


@register("build_records", f"""{_RUN_SQL}
SELECT slot_id, provider, category, CAST(3 AS BIGINT) AS n_messages, {_triplet_sql('user_prompt', 'text')} AS flat
FROM r WHERE error IS NULL""")
def q_build_records(spark, sf_dir):
    """#4/#16 the stored record: plan, replies, three messages, JSON Lines,
    scanned back."""
    path = scratch_path(spark, "conv-records")
    _conv_build(spark, sf_dir, export=path)
    return _exported(spark, path)


@register("build_failures", f"""{_RUN_SQL}
SELECT slot_id, provider, error, CAST(2 AS BIGINT) AS attempts FROM r WHERE error IS NOT NULL""")
def q_build_failures(spark, sf_dir):
    """#23 after two faulty runs: one row per failing slot, its latest error."""
    return _conv_build(spark, sf_dir, runs=2)["failures"].select("slot_id", "provider", "error", "attempts")


_REPORT_SQL = f"""{_RUN_SQL}
SELECT 'attempts by category' AS section, category AS name, count(*) AS n FROM r GROUP BY category
UNION ALL
SELECT 'successes by provider', p.provider, CAST(count(r.slot_id) AS BIGINT)
FROM (VALUES ('{PROVIDERS_RUN[0]}'), ('{PROVIDERS_RUN[1]}')) p(provider)
LEFT JOIN r ON r.provider = p.provider AND r.error IS NULL GROUP BY p.provider"""


@register("build_report", _REPORT_SQL)
def q_build_report(spark, sf_dir):
    """#24-#26 the report of a build, from its stored results."""
    return mt.run_report(spark, bd.results_view(_conv_build(spark, sf_dir)["results"]), list(PROVIDERS_RUN))


@register("observed_report", _REPORT_SQL)
def q_observed_report(spark, sf_dir):
    """#24-#26 the report of a build, counted while its results were written."""
    return _conv_build(spark, sf_dir)["report"]


#: The first run takes the slots of the first provider, with faults.
_FIRST_RUN_SQL = f"""{_RUN_SQL},
done AS (SELECT slot_id FROM r WHERE provider = '{PROVIDERS_RUN[0]}' AND error IS NULL)"""
WAVE = 16


def _half_done(spark, sf_dir, path: str, export: str | None = None) -> tuple[DataFrame, bd.BuildConfig]:
    """The plan of all slots, after a faulty run over those of one provider."""
    cfg = bd.BuildConfig(seed=SEED, first_provider=PROVIDERS_RUN[0], second_provider=PROVIDERS_RUN[1], wave_size=WAVE, partitions=4)
    plan = _conv_requests(spark, sf_dir, form_by_hash=False)
    bd.build_dataset(spark, plan.where(F.col("provider") == PROVIDERS_RUN[0]), gen.offline_backend(SEED), path,
                     bd.BuildConfig(seed=SEED), export_path=export)
    return plan, cfg


@register("resume_waves", f"""{_FIRST_RUN_SQL}
SELECT (row_number() OVER (ORDER BY slot_id) - 1) // {WAVE} AS wave, slot_id
FROM r WHERE slot_id NOT IN (SELECT slot_id FROM done)""")
def q_resume_waves(spark, sf_dir):
    """#7/#32 what a resumed build still has to do, in even waves: the slots
    that failed in a first run, and those it had not been given."""
    path = scratch_path(spark, "resume-waves")
    plan, cfg = _half_done(spark, sf_dir, path)
    return bd.todo_waves(spark, plan, bd.successful_keys(spark, f"{path}/results"), cfg.wave_size)


@register("sink_commits", f"""{_FIRST_RUN_SQL},
e AS (SELECT slot_id, CASE WHEN slot_id IN (SELECT slot_id FROM done) THEN 0 ELSE 1 END AS commit
      FROM r WHERE user_prompt IS NOT NULL),
n AS (SELECT CAST(unnest([0, 1]) AS BIGINT) AS commit)
SELECT n.commit, count(e.slot_id) AS logged, count(e.slot_id) AS lines, count(DISTINCT e.slot_id) AS slots,
       min(e.slot_id) AS first, max(e.slot_id) AS last
FROM n LEFT JOIN e ON e.commit = n.commit GROUP BY n.commit""")
def q_sink_commits(spark, sf_dir):
    """#4 exactly-once append: a run with export, a run whose export was written
    but never committed (as a crash leaves it), and a rerun; what the log says of
    each commit, and what its files hold."""
    path = scratch_path(spark, "sink-commits")
    sink = f"{path}/records.jsonl"
    plan, cfg = _half_done(spark, sf_dir, f"{path}/build", export=sink)
    sound = gen.offline_backend(SEED, fault_every=0)
    out = bd.build_dataset(spark, plan, sound, f"{path}/build", cfg)
    sk.stage(out["records"].select("slot_id", "provider", "messages", "category"), sink)
    bd.build_dataset(spark, plan, sound, f"{path}/build", cfg, export_path=sink)
    lines = sk.read_committed(spark, sink, "slot_id long", numbers=True).groupBy("commit").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("slot_id").alias("slots"))
    return sk.commit_frame(spark, sink).join(lines, "commit", "left").select(
        "commit", F.col("rows").alias("logged"), F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("slots", F.lit(0)).alias("slots"), "first", "last")


@register("prepare_training_set", f"""
WITH t AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS la
           FROM conversations GROUP BY conv_id),
k AS (SELECT c.* FROM conversations c JOIN t ON t.conv_id = c.conv_id
      WHERE t.la IS NOT NULL AND c.turn <= t.la),
r AS (SELECT conv_id, 1 + count(*) FILTER (WHERE role <> 'system') AS n_messages,
             {_render_sql("'system'", DEFAULT_SYS_SQL)}
             || string_agg({_render_sql('role', 'text')}, '' ORDER BY turn) FILTER (WHERE role <> 'system') AS text
      FROM k GROUP BY conv_id),
s AS (SELECT *, row_number() OVER (ORDER BY {U('conv_id', 'split')}, conv_id) AS rk,
             count(*) OVER () AS n FROM r),
x AS (SELECT *, {_NTOK_SQL.format(t='text')} AS ntok FROM s)
SELECT conv_id, CASE WHEN rk <= CAST(ceil(0.05::DOUBLE * n) AS BIGINT) THEN 'eval' ELSE 'train' END AS split,
       n_messages, ntok AS n_tokens, ntok > {tk.MAX_SEQ_LENGTH} AS truncated, text
FROM x""")
def q_prepare_training_set(spark, sf_dir):
    """#33 turns -> answered records -> split -> normalise -> render -> cap,
    written as split-partitioned Parquet and read back."""
    out = pt.prepare_from_turns(spark, _conversations(spark, sf_dir), "conv_id",
                                scratch_path(spark, "training-set"), seed=SEED)
    return out["data"].select("conv_id", "split", _n_messages(), "n_tokens", "truncated", "text")


@register("prepare_answered", ORACLES["prepare_training_set"])
def q_prepare_answered(spark, sf_dir):
    """#33 the same from records that are assembled already."""
    out = pt.prepare_training_set(spark, _records(spark, sf_dir), "conv_id",
                                  scratch_path(spark, "training-set"), seed=SEED, answered_only=True)
    return out["data"].select("conv_id", "split", _n_messages(), "n_tokens", "truncated", "text")


_EMPTY = "coalesce({0}, '')"
_ALL_RECORDS_SQL = f"""
WITH r AS (SELECT conv_id, 1 + count(*) FILTER (WHERE role IS DISTINCT FROM 'system') AS n_messages,
             {_render_sql("'system'", DEFAULT_SYS_SQL)}
             || coalesce(string_agg({_render_sql(_EMPTY.format('role'), _EMPTY.format('text'))}, '' ORDER BY turn)
                         FILTER (WHERE role IS DISTINCT FROM 'system'), '') AS text
      FROM conversations GROUP BY conv_id),
s AS (SELECT *, row_number() OVER (ORDER BY {U('conv_id', 'split')}, conv_id) AS rk, count(*) OVER () AS n FROM r),
x AS (SELECT *, CASE WHEN rk <= CAST(ceil(0.05::DOUBLE * n) AS BIGINT) THEN 'eval' ELSE 'train' END AS split,
             {_NTOK_SQL.format(t='text')} AS ntok FROM s)"""


def _training_set(spark, sf_dir) -> dict[str, DataFrame]:
    return pt.prepare_training_set(spark, _records(spark, sf_dir), "conv_id",
                                   scratch_path(spark, "training-all"), seed=SEED)


@register("prepare_all_records", f"""{_ALL_RECORDS_SQL}
SELECT conv_id, split, n_messages, ntok AS n_tokens, ntok > {tk.MAX_SEQ_LENGTH} AS truncated,
       md5(CASE WHEN ntok > {tk.MAX_SEQ_LENGTH} THEN {_capped_sql('text', tk.MAX_SEQ_LENGTH)} ELSE text END)
         AS capped_md5
FROM x""")
def q_prepare_all_records(spark, sf_dir):
    """#33 every record kept: split, normalised, rendered and capped."""
    return _training_set(spark, sf_dir)["data"].select(
        "conv_id", "split", _n_messages(), "n_tokens", "truncated", F.md5("text_capped").alias("capped_md5"))


@register("prepare_manifest", f"""{_ALL_RECORDS_SQL},
e AS (SELECT CAST(unnest(range(0, {sp.EPOCHS})) AS INTEGER) AS epoch),
m AS (SELECT e.epoch, x.conv_id,
             row_number() OVER (PARTITION BY e.epoch
                                ORDER BY {u_sql(SEED, 'x.conv_id', "'epoch:' || e.epoch")}, x.conv_id) - 1 AS position
      FROM x, e WHERE x.split = 'train')
SELECT epoch, conv_id, position, position // {sp.MICRO_BATCH} AS micro_batch,
       position // {sp.MICRO_BATCH * sp.ACCUMULATION} AS step
FROM m""")
def q_prepare_manifest(spark, sf_dir):
    """#33/#29 the written manifest of the train rows."""
    return _training_set(spark, sf_dir)["manifest"].select("epoch", "conv_id", "position", "micro_batch", "step")
