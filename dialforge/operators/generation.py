"""Request shaping, bulk generation with row-level errors, reply extraction.

Flow: plan rows -> :func:`shape_request` (native: a ``request`` struct and a
JSON ``body`` per provider form) -> :func:`bulk_generate` (the only Python
step: ``mapInArrow`` with a bounded thread pool per task, so cluster-wide
concurrency = tasks x ``concurrency``; pass-through columns stay Arrow
arrays and never become Python objects) -> :func:`extract_response` (native
``get_json_object`` by form) -> successes / failures.

Calls are at-least-once: a retried or speculative task calls again. Write the
results before counting or reusing them (``plans.build_dataset`` does), keep
``spark.speculation`` off, and resume by key rather than by count.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ALL_COMPLETED, FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialforge.functions.draw import u_py

# ---------------------------------------------------------------------------
# The four request forms, their token cap / temperature, and
# the JSON path of the reply text in each form's response body.
#   messages_api      system field + one user message, max_tokens 2000
#   single_prompt     one string "system\n\nprompt", no cap, no temperature
#   chat_completions  system + user messages, max_tokens 2048, temperature 0.8
#   local_chat        system + user messages, stream false,
#                     options {temperature 0.8, num_predict 2048}
# ---------------------------------------------------------------------------
FORMS: dict[str, dict] = {
    "messages_api": {"max_tokens": 2000, "temperature": None,
                     "path": "$.content[0].text"},
    "single_prompt": {"max_tokens": None, "temperature": None,
                      "path": "$.candidates[0].content.parts[0].text"},
    "chat_completions": {"max_tokens": 2048, "temperature": 0.8,
                         "path": "$.choices[0].message.content"},
    "local_chat": {"max_tokens": 2048, "temperature": 0.8,
                   "path": "$.message.content"},
}
PROMPT_JOIN = "\n\n"

ERR_MALFORMED = "malformed response"
ERR_NO_CONTENT = "no content"
ERR_EMPTY = "empty content"
ERR_UNKNOWN_FORM = "unknown provider form"
ERR_NO_REQUEST = "no request body"
ERR_WRONG_TYPE = "content is not text"      # followed by its type


def _chat_msgs(system: Column, user: Column) -> Column:
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))


def json_inner(text: Column) -> Column:
    """A text as it stands between the quotes of a JSON string; null stays null.
    Characters are escaped one by one, so pieces of a text can be escaped apart."""
    return F.when(text.isNotNull(), _cut(F.to_json(F.struct(text.alias("t"))), 6, 2))     # {"t":"..."}


def _cut(text: Column, first: int, last: int) -> Column:
    """A text without so many bytes at its ends: no count of its characters."""
    return F.substr(text.cast("binary"), F.lit(first + 1), F.octet_length(text) - (first + last)).cast("string")


def _after_prompt(form: str) -> str:
    """What follows the prompt in a body of ``form``, its closing quote first."""
    cap, heat = FORMS[form]["max_tokens"], FORMS[form]["temperature"]
    return {"messages_api": '"}]}', "single_prompt": '"}',
            "chat_completions": f'"}}],"max_tokens":{cap},"temperature":{heat}}}',
            "local_chat": f'"}}],"stream":false,"options":{{"temperature":{heat},"num_predict":{cap}}}}}'}[form]


def shape_request(df: DataFrame, provider: str = "provider", system: str = "gen_system",
                  user: str = "user_prompt", models: dict[str, str] | None = None,
                  out: str = "request", body: str = "body", user_json: str | None = None) -> DataFrame:
    """Add the ``request`` struct and the provider-specific JSON ``body`` (null
    for a null prompt or an unknown provider: such a row is never sent).
    ``user_json`` names a column with the prompt as :func:`json_inner` has it; it is
    put into the body as it is, which is then the same without escaping the prompt."""
    models = models or {}
    p, s, q = F.col(provider), F.col(system), F.col(user) if user_json is None else F.lit("")

    def model_for(form):
        return F.lit(models.get(form, "default")).alias("model")

    def cap(form):
        v = FORMS[form]["max_tokens"]
        return F.lit(v).cast("int")

    def temp(form):
        v = FORMS[form]["temperature"]
        return F.lit(v).cast("double")

    bodies = {
        "messages_api": F.to_json(F.struct(
            model_for("messages_api"), cap("messages_api").alias("max_tokens"),
            s.alias("system"),
            F.array(F.struct(F.lit("user").alias("role"), q.alias("content"))).alias("messages"))),
        "single_prompt": F.to_json(F.struct(
            model_for("single_prompt"), F.concat_ws(PROMPT_JOIN, s, q).alias("contents"))),
        "chat_completions": F.to_json(F.struct(
            model_for("chat_completions"), _chat_msgs(s, q).alias("messages"),
            cap("chat_completions").alias("max_tokens"),
            temp("chat_completions").alias("temperature"))),
        "local_chat": F.to_json(F.struct(
            model_for("local_chat"), _chat_msgs(s, q).alias("messages"),
            F.lit(False).alias("stream"),
            F.struct(temp("local_chat").alias("temperature"),
                     cap("local_chat").alias("num_predict")).alias("options"))),
    }
    body_col = None
    model_col = None
    cap_col = None
    temp_col = None
    for form, b in bodies.items():
        cond = p == F.lit(form)
        if user_json is not None:
            rest = _after_prompt(form)
            b = F.concat(_cut(b, 0, len(rest)), F.col(user_json), F.lit(rest))
        body_col = F.when(cond, b) if body_col is None else body_col.when(cond, b)
        m = F.lit(models.get(form, "default"))
        model_col = F.when(cond, m) if model_col is None else model_col.when(cond, m)
        cap_col = F.when(cond, cap(form)) if cap_col is None else cap_col.when(cond, cap(form))
        temp_col = F.when(cond, temp(form)) if temp_col is None else temp_col.when(cond, temp(form))
    req = F.struct(p.alias("provider"), model_col.alias("model"), s.alias("system"),
                   F.col(user).alias("user"), cap_col.alias("max_tokens"), temp_col.alias("temperature"))
    return df.withColumn(out, req).withColumn(body, F.when(F.col(user).isNotNull(), body_col))


def reply_body(provider: Column, text: Column) -> Column:
    """Native twin of :func:`wrap_reply`: a reply body in the form's shape."""
    shapes = {
        "messages_api": F.struct(F.array(F.struct(
            F.lit("text").alias("type"), text.alias("text"))).alias("content")),
        "single_prompt": F.struct(F.array(F.struct(F.struct(F.array(F.struct(
            text.alias("text"))).alias("parts")).alias("content"))).alias("candidates")),
        "chat_completions": F.struct(F.array(F.struct(F.struct(
            F.lit("assistant").alias("role"), text.alias("content")).alias("message")))
            .alias("choices")),
        "local_chat": F.struct(F.struct(F.lit("assistant").alias("role"),
                                        text.alias("content")).alias("message")),
    }
    expr = None
    for form, shape in shapes.items():
        body = F.to_json(shape, {"ignoreNullFields": "false"})
        cond = provider == F.lit(form)
        expr = F.when(cond, body) if expr is None else expr.when(cond, body)
    return expr


def extract_response(df: DataFrame, provider: str = "provider", raw: str = "raw",
                     error: str = "error", out: str = "text") -> DataFrame:
    """Reply text by form, and the first applicable error: backend error >
    no body > unknown form > empty text > malformed JSON > missing/null text.
    A row is a success only with non-empty text at its form's path."""
    r, p = F.col(raw), F.col(provider)
    text = None
    for form, spec in FORMS.items():
        cond = p == F.lit(form)
        val = F.get_json_object(r, spec["path"])
        text = F.when(cond, val) if text is None else text.when(cond, val)
    known = p.isin(list(FORMS))
    prior = F.col(error) if error in df.columns else F.lit(None).cast("string")
    t = F.col("_ex_t")
    # the whole-body validity parse runs only for rows whose path gave null
    err = (F.when(prior.isNotNull(), prior)
           .when(r.isNull(), F.lit(ERR_MALFORMED))
           .when(~known, F.lit(ERR_UNKNOWN_FORM))
           .when(t == F.lit(""), F.lit(ERR_EMPTY))
           .when(t.isNotNull(), F.lit(None).cast("string"))
           .when(F.get_json_object(r, "$").isNull(), F.lit(ERR_MALFORMED))
           .otherwise(F.lit(ERR_NO_CONTENT)))
    return (df.withColumn("_ex_t", text)
            .withColumn("_ex_e", err)
            .withColumn(out, F.when(F.col("_ex_e").isNull(), t))
            .withColumn(error, F.col("_ex_e")).drop("_ex_t", "_ex_e"))


def extract_variant(df: DataFrame, provider: str = "provider", raw: str = "raw",
                    error: str = "error", out: str = "text") -> DataFrame:
    """As :func:`extract_response`, from one typed parse a reply. Content that is
    a list of strings or of parts with a text is their texts, joined; a number, a
    truth value, an object or a list with anything else is an error of its own that
    names the type, apart from a path that is not there or null."""
    p, r, v, kind = F.col(provider), F.col(raw), F.col("_ex_v"), F.col("_ex_k")
    found = None
    for form, spec in FORMS.items():
        at = F.try_variant_get(F.col("_ex_j"), spec["path"], "variant")
        found = F.when(p == F.lit(form), at) if found is None else found.when(p == F.lit(form), at)

    def of_part(x):
        own = F.schema_of_variant(x)
        return (F.when(own == "STRING", F.try_variant_get(x, "$", "string"))
                .when(F.schema_of_variant(F.try_variant_get(x, "$.text", "variant")) == "STRING", F.try_variant_get(x, "$.text", "string")))

    parts = F.transform(F.try_variant_get(v, "$", "array<variant>"), of_part)
    text = (F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
            .when(kind.startswith("ARRAY") & ~F.exists("_ex_p", lambda x: x.isNull()), F.array_join("_ex_p", "")))
    prior = F.col(error) if error in df.columns else F.lit(None).cast("string")
    t = F.col("_ex_t")
    err = (F.when(prior.isNotNull(), prior)
           .when(r.isNull(), F.lit(ERR_MALFORMED))
           .when(~p.isin(list(FORMS)) | p.isNull(), F.lit(ERR_UNKNOWN_FORM))
           .when(F.col("_ex_j").isNull(), F.lit(ERR_MALFORMED))
           .when(v.isNull() | F.is_variant_null(v), F.lit(ERR_NO_CONTENT))
           .when(t.isNull(), F.concat(F.lit(f"{ERR_WRONG_TYPE}: "), kind))
           .when(t == "", F.lit(ERR_EMPTY)))
    return (df.withColumn("_ex_j", F.try_parse_json(r)).withColumn("_ex_v", found)
            .withColumn("_ex_k", F.schema_of_variant(v))
            .withColumn("_ex_p", F.when(kind.startswith("ARRAY"), parts))
            .withColumn("_ex_t", text).withColumn("_ex_e", err)
            .withColumn(out, F.when(F.col("_ex_e").isNull(), t))
            .withColumn(error, F.col("_ex_e")).drop("_ex_j", "_ex_v", "_ex_k", "_ex_p", "_ex_t", "_ex_e"))


def successes(df: DataFrame, error: str = "error") -> DataFrame:
    return df.where(F.col(error).isNull())


def failures(df: DataFrame, error: str = "error") -> DataFrame:
    """Quarantine: rows that failed, kept with their key for a retry top-up."""
    return df.where(F.col(error).isNotNull())


# ------------------------------------------------------------------ bulk call

Call = Callable[[dict], str]
_SCALARS = (T.StringType, T.LongType, T.IntegerType, T.DoubleType, T.BooleanType,
            T.FloatType, T.ShortType, T.ByteType)


def _safe(call: Call):
    def run(rec: dict):
        if rec.get("body", "") is None:
            return None, ERR_NO_REQUEST
        try:
            return call(rec), None
        except Exception as e:  # noqa: BLE001 - row-level error capture
            return None, f"{type(e).__name__}: {e}"
    return run


BYTE_BUDGET = 64 << 20   # of prompts in flight and of replies not yet handed on, each
OUT_ROWS = 2048          # replies handed on at once, at most


class _Window:
    """Calls in flight, over the batches of a task: as soon as one ends, the next
    row is called, whatever the other rows of its batch do. At most ``calls`` are in
    flight, and a row waits while prompts of ``budget`` bytes are."""

    def __init__(self, call, calls: int, budget: int):
        self.call, self.calls, self.budget = call, calls, budget
        self.pool = ThreadPoolExecutor(calls) if calls > 1 else None
        self.flying: dict = {}              # future -> (batch, row, bytes)
        self.flying_bytes = self.most_bytes = 0
        self.ended: list = []               # (batch, row, raw, error)
        self.ended_bytes = 0

    def _end(self, batch: int, row: int, result) -> None:
        self.ended.append((batch, row, *result))
        self.ended_bytes += sum(len(x) for x in result if x)

    def land(self, every: bool = False) -> None:
        """Wait for one call, or for all of them."""
        ready, _ = wait(self.flying, return_when=ALL_COMPLETED if every else FIRST_COMPLETED)
        for f in ready:
            batch, row, size = self.flying.pop(f)
            self.flying_bytes -= size
            self._end(batch, row, f.result())

    def start(self, batch: int, row: int, rec: dict) -> None:
        if self.pool is None:
            self._end(batch, row, self.call(rec))
            return
        size = sum(len(x) for x in rec.values() if isinstance(x, str))
        while self.flying and (len(self.flying) >= self.calls or self.flying_bytes + size > self.budget):
            self.land()
        self.flying_bytes += size
        self.most_bytes = max(self.most_bytes, self.flying_bytes)
        self.flying[self.pool.submit(self.call, rec)] = (batch, row, size)

    def full(self) -> bool:
        return len(self.ended) >= OUT_ROWS or self.ended_bytes > self.budget

    def close(self) -> None:
        if self.pool:
            self.pool.shutdown(cancel_futures=True)


def _slices(rb, fields: list[str], budget: int):
    """``(first row, records)`` of a batch, a few rows at a time: only they become
    Python objects."""
    import pyarrow as pa

    columns = [rb.column(rb.schema.get_field_index(f)) for f in fields]
    row_bytes = max(1, sum(c.nbytes for c in columns if pa.types.is_string(c.type)) // max(rb.num_rows, 1))
    step = min(max(budget // 8 // row_bytes, 1), 1024)
    for lo in range(0, rb.num_rows, step):
        values = [c.slice(lo, step).to_pylist() for c in columns]
        yield lo, [dict(zip(fields, v)) for v in zip(*values)]


def _generated(batches, window: _Window, fields: list[str], out_cols: list[str]):
    """Rows with replies, in the order in which the calls end."""
    import pyarrow as pa

    held: dict = {}             # batch -> [rows, rows not yet handed on]

    def hand_on():
        by_batch: dict = {}
        for batch, *row in window.ended:
            by_batch.setdefault(batch, []).append(row)
        window.ended, window.ended_bytes = [], 0
        for batch, rows in by_batch.items():
            rb = held[batch][0]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(rb.column(rb.schema.get_field_index(c)).take(at) for c in out_cols),
                 pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                names=out_cols + ["raw", "error"])
            held[batch][1] -= len(rows)
            if not held[batch][1]:
                del held[batch]

    try:
        for n, rb in enumerate(batches):
            if not rb.num_rows:
                continue
            held[n] = [rb, rb.num_rows]
            for lo, recs in _slices(rb, fields, window.budget):
                for i, rec in enumerate(recs):
                    window.start(n, lo + i, rec)
                    if window.full():
                        yield from hand_on()
            if not window.flying:
                yield from hand_on()
        if window.flying:
            window.land(every=True)
        yield from hand_on()
    finally:
        window.close()


def bulk_generate(requests: DataFrame, call: Call, concurrency: int | None = None,
                  fields: tuple[str, ...] = ("slot_id", "provider", "body"),
                  keep_body: bool = False, byte_budget: int = BYTE_BUDGET) -> DataFrame:
    """One call per row; adds ``raw`` (reply body) and ``error`` (string).

    ``call(record) -> raw`` receives ``fields`` of the row as a dict and may
    raise; the exception text becomes the row's ``error``. Up to
    ``concurrency`` calls are in flight per task (network-bound backends), over
    the whole task: a slow call holds up no other, and its row comes out when it
    ends; by default the backend's own ``concurrency`` attribute, else 8.
    Prompts in flight and replies not yet handed on take at most about
    ``byte_budget`` characters each (a larger one is alone); beside them a task
    holds the Arrow batches of the rows in flight.
    All other columns pass through (scalar columns only: select first);
    the request ``body`` is dropped from the output unless ``keep_body``
    (it is re-derivable from the plan and would store the prompt again).
    """
    for f in requests.schema.fields:
        if not isinstance(f.dataType, _SCALARS):
            raise TypeError(f"bulk_generate passes scalar columns only; drop {f.name!r} first")
    passed = [f for f in requests.schema.fields if keep_body or f.name != "body"]
    out_schema = T.StructType(passed + [
        T.StructField("raw", T.StringType()), T.StructField("error", T.StringType())])
    out_cols = [f.name for f in passed]
    if concurrency is None:
        concurrency = int(getattr(call, "concurrency", 8))
    safe = _safe(call)
    keep = list(fields)

    def run(batches):
        yield from _generated(batches, _Window(safe, concurrency, byte_budget), keep, out_cols)

    return requests.mapInArrow(run, out_schema)


BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 20


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES):
    """Inside it, the Arrow batches of a job have about ``most`` bytes, which stay in a
    core's cache on their way to Python and back, unless the session has its own
    setting; nothing is left set afterwards."""
    own = spark.conf.get(BATCHES, None)
    if own is None:
        spark.conf.set(BATCHES, str(most))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(BATCHES)


# ------------------------------------------------------------------ backends

def wrap_reply(form: str, text: str | None) -> str:
    """A reply body in ``form``'s response shape (inverse of the paths)."""
    if form == "messages_api":
        body = {"content": [{"type": "text", "text": text}]}
    elif form == "single_prompt":
        body = {"candidates": [{"content": {"parts": [{"text": text}]}}]}
    elif form == "chat_completions":
        body = {"choices": [{"message": {"role": "assistant", "content": text}}]}
    elif form == "local_chat":
        body = {"message": {"role": "assistant", "content": text}}
    else:
        raise ValueError(f"unknown form {form!r}")
    return json.dumps(body)


def request_text(form: str, body: dict) -> str:
    """The prompt text a backend sees in a body of ``form``."""
    if form == "single_prompt":
        return body["contents"]
    return body["messages"][-1]["content"]


# Offline backend: deterministic replies, hash-chosen faults. Its SQL mirror
# lives with the registered queries, so generation has an exact oracle.
OFFLINE_PREFIX = "[offline reply] "
OFFLINE_ENDINGS = [" Done.", " That is all.", " Use it well."]
FAULT_KINDS = ["raise", "malformed", "null", "empty"]


def offline_backend(seed: int = 42, fault_every: int = 20, key: str = "slot_id") -> Call:
    """Deterministic stand-in for a text generator (no network).

    Reply = prefix + prompt + ending chosen by ``u(seed, key, "reply")``.
    When ``u(seed, key, "fault") mod fault_every == 0`` the call fails in one
    of four ways chosen by ``u(seed, key, "fault_kind") mod 4``: raise,
    malformed JSON, null content, empty content. ``fault_every=0`` disables.
    """
    def call(rec: dict) -> str:
        k = rec[key]
        form = rec["provider"]
        if fault_every and u_py(seed, k, "fault") % fault_every == 0:
            kind = FAULT_KINDS[u_py(seed, k, "fault_kind") % len(FAULT_KINDS)]
            if kind == "raise":
                raise RuntimeError("injected fault")
            if kind == "malformed":
                return "{bad"
            return wrap_reply(form, None if kind == "null" else "")
        text = request_text(form, json.loads(rec["body"]))
        ending = OFFLINE_ENDINGS[u_py(seed, k, "reply") % len(OFFLINE_ENDINGS)]
        return wrap_reply(form, OFFLINE_PREFIX + text + ending)
    call.concurrency = 1  # CPU-bound: threads would only contend for the GIL
    return call


def http_backend(urls: dict[str, str], headers: dict[str, str] | None = None,
                 timeout: float = 300.0, concurrency: int = 8) -> Call:
    """POST each body to ``urls[form]``; non-2xx raises (-> row error).
    Uses only the standard library so executors need no client packages."""
    import urllib.request

    def call(rec: dict) -> str:
        req = urllib.request.Request(urls[rec["provider"]], data=rec["body"].encode("utf-8"),
                                     headers={"Content-Type": "application/json",
                                              **(headers or {})}, method="POST")
        with urllib.request.urlopen(req, timeout=timeout) as resp:  # noqa: S310
            return resp.read().decode("utf-8")
    call.concurrency = concurrency
    return call
