"""Hand-made golden rows (expected values written by hand, see FIXTURES.md)."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialforge.functions import chat
from dialforge.operators import generation as gen
from dialforge.operators import messages as msg
from dialforge.operators import metrics as mt
from dialforge.operators import planning as pl
from dialforge.operators import sampling as sa
from dialforge.operators import split as sp
from dialforge.operators import tokens as tk
from dialforge.schemas import CHAT_RECORD
from dialforge.sources import catalog as cat
from dialforge.sources import jsonl

NL = "\n"


@pytest.fixture()
def small_catalog(spark):
    return cat.catalog_from_dict(spark, {
        "a": {"weight": 3, "system": "sa", "prompts": ["p0", "p1"]},
        "b": {"weight": 1, "system": "sb", "prompts": ["q0"]},
    })


def test_catalog_small_slots(small_catalog):
    slots = sa.weighted_slots(small_catalog, order="ord").orderBy("slot").collect()
    assert [(r.category, r.slot) for r in slots] == [("a", 0), ("a", 1), ("a", 2), ("b", 3)]


def test_catalog_small_shares(spark, small_catalog):
    n = 20000
    plan = pl.plan_slots(spark, n)
    drawn = sa.weighted_draw(plan, small_catalog, 42, order="ord", extra=("prompts",))
    counts = {r.category: r["count"] for r in drawn.groupBy("category").count().collect()}
    assert sum(counts.values()) == n
    se = (0.75 * 0.25 / n) ** 0.5
    assert abs(counts["a"] / n - 0.75) < 3 * se
    prompts = pl.draw_catalog_prompt(drawn, 42).select("category", "base_prompt").distinct().collect()
    assert sorted((r.category, r.base_prompt) for r in prompts) == [("a", "p0"), ("a", "p1"), ("b", "q0")]


def test_catalog_zero_weight_raises_before_job(spark):
    zero = cat.catalog_from_dict(spark, {"a": {"weight": 0, "prompts": ["x"]}})
    with pytest.raises(ValueError, match="sum to zero"):
        sa.weighted_draw(pl.plan_slots(spark, 5), zero, 42)
    empty = cat.catalog_from_dict(spark, {"a": {"weight": 2, "prompts": []}})
    with pytest.raises(ValueError, match="no prompts"):
        cat.validate_catalog(empty)


def test_compose_no_extra_space(spark):
    df = spark.createDataFrame([("X.", " Y.", "")], "base_prompt string, variation string, detail string")
    assert pl.compose_prompt(df).first().user_prompt == "X. Y."


def test_provider_alternation(spark):
    slots = pl.plan_slots(spark, 4)
    two = pl.assign_provider(slots, "a", "b").orderBy("slot_id").collect()
    one = pl.assign_provider(slots, "a", None).orderBy("slot_id").collect()
    assert [r.provider for r in two] == ["a", "b", "a", "b"]
    assert [r.provider for r in one] == ["a", "a", "a", "a"]


def test_modifier_lists_shape():
    assert len(cat.VARIATIONS) == 10 and cat.VARIATIONS[0] == ""
    assert len(cat.DETAIL_REQUESTS) == 5 and cat.DETAIL_REQUESTS[0] == ""
    assert all(s.startswith(" ") for s in cat.VARIATIONS[1:] + cat.DETAIL_REQUESTS[1:])


def test_raw_ok_every_form(spark):
    rows = [(f, gen.wrap_reply(f, "hello")) for f in gen.FORMS]
    df = spark.createDataFrame(rows, "provider string, raw string")
    out = gen.extract_response(df).collect()
    assert all(r.text == "hello" and r.error is None for r in out)


def test_raw_ok_native_bodies_match_python(spark):
    df = spark.createDataFrame([(f,) for f in gen.FORMS], "provider string")
    native = df.withColumn("raw", gen.reply_body(F.col("provider"), F.lit("hé \"q\"\n")))
    for r in native.collect():
        assert json.loads(r.raw) == json.loads(gen.wrap_reply(r.provider, "hé \"q\"\n"))


def test_raw_bad_never_success(spark):
    rows = [
        ("chat_completions", "{bad", None),
        ("chat_completions", '{"choices":[{"message":{"content":null}}]}', None),
        ("messages_api", '{"foo": 1}', None),
        ("local_chat", '{"message":{"content":""}}', None),
        ("messages_api", None, "RuntimeError: boom"),
        ("smoke_signal", '{"text": "x"}', None),
    ]
    df = spark.createDataFrame(rows, "provider string, raw string, error string")
    out = gen.extract_response(df).collect()
    assert [r.error for r in out] == [gen.ERR_MALFORMED, gen.ERR_NO_CONTENT, gen.ERR_NO_CONTENT,
                                      gen.ERR_EMPTY, "RuntimeError: boom", gen.ERR_UNKNOWN_FORM]
    assert all(r.text is None for r in out)
    assert gen.successes(gen.extract_response(df)).count() == 0


def _msgs(spark, triples):
    schema = T.StructType([T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])))])
    return spark.createDataFrame([([{"role": r, "content": c} for r, c in triples],)], schema)


def test_chat_basic(spark):
    df = _msgs(spark, [("system", "S"), ("user", "U"), ("assistant", "A")])
    want = f"<|system|>{NL}S</s>{NL}<|user|>{NL}U</s>{NL}<|assistant|>{NL}A</s>{NL}"
    assert msg.render_chat(df).first().text == want


def test_chat_cue(spark):
    df = _msgs(spark, [("system", "S"), ("user", "U")])
    want = f"<|system|>{NL}S</s>{NL}<|user|>{NL}U</s>{NL}<|assistant|>{NL}"
    assert msg.render_chat(df, add_generation_prompt=True).first().text == want
    assert msg.render_inference_prompt(df).first().prompt == want


def test_inference_prompt_default_system_and_last_user(spark):
    df = _msgs(spark, [("user", "U1"), ("assistant", "A1"), ("user", "U2"), ("assistant", "A2")])
    got = msg.render_inference_prompt(df).first().prompt
    want = (f"<|system|>{NL}{chat.DEFAULT_SYSTEM}</s>{NL}<|user|>{NL}U1</s>{NL}"
            f"<|assistant|>{NL}A1</s>{NL}<|user|>{NL}U2</s>{NL}<|assistant|>{NL}")
    assert got == want


def test_chat_null_rejected(spark):
    df = _msgs(spark, [("system", "S"), ("user", "U"), ("assistant", None)])
    assert msg.render_chat(df).first().text is None
    with pytest.raises(Exception, match="null role or content"):
        msg.render_chat(df, on_null="error").collect()


def test_chat_unordered_turns(spark):
    turns = spark.createDataFrame([(7, 2, "assistant", "c"), (7, 0, "system", "a"), (7, 1, "user", "b")],
                                  "conv_id long, turn long, role string, text string")
    rec = msg.assemble_from_turns(turns).first()
    assert [(m.role, m.content) for m in rec.messages] == [("system", "a"), ("user", "b"), ("assistant", "c")]


def test_normalize_system_replaces(spark):
    df = _msgs(spark, [("system", "old"), ("user", "U"), ("assistant", "A")])
    got = msg.normalize_system(df, "NEW").first().messages
    assert [(m.role, m.content) for m in got] == [("system", "NEW"), ("user", "U"), ("assistant", "A")]


def test_last_message(spark):
    df = _msgs(spark, [("user", "U"), ("assistant", "A")])
    r = msg.last_message(df).first()
    assert (r.last_role, r.last_content) == ("assistant", "A")
    turns = spark.createDataFrame([(1, 1, "assistant", "A"), (1, 0, "user", "U"), (2, 0, "user", "V")],
                                  "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, msg.last_message_from_turns(turns).collect()))
    assert got == [(1, "assistant", "A"), (2, "user", "V")]


def test_jsonl_mixed(spark, tmp_path):
    p = tmp_path / "mixed.jsonl"
    good = json.dumps({"messages": [{"role": "user", "content": "hi"}], "category": "c"})
    p.write_text(good + "\n" + '{"bad' + "\n" + "\n" + '{"messages": []}' + "\n")
    with pytest.raises(Exception):
        jsonl.read_records(spark, str(p), strict=True).count()
    with pytest.raises(Exception):
        jsonl.read_records(spark, str(p), strict=True, blank_lines="skip").count()
    blank_only = tmp_path / "blank.jsonl"
    blank_only.write_text(good + "\n\n" + good + "\n")
    with pytest.raises(Exception, match="blank line"):
        jsonl.read_records(spark, str(blank_only), strict=True).collect()
    assert jsonl.read_records(spark, str(blank_only), strict=True, blank_lines="skip").count() == 2
    lenient = jsonl.read_records(spark, str(p), strict=False)
    ok, bad = jsonl.split_corrupt(lenient)
    assert lenient.count() == 3
    assert bad.count() == 1
    assert ok.count() == 2
    assert jsonl.count_lines(spark, str(p)) == 4


def test_map_records_user_function_equals_native_render(spark):
    from tests.conftest import SF001
    from dialforge.session import read_table

    def template(ms):
        return "".join(f"<|{m['role']}|>\n{m['content']}</s>\n" for m in ms)

    recs = msg.assemble_from_turns(read_table(spark, SF001, "conversations"))
    both = msg.map_records(msg.render_chat(recs, out="native"), template, out="py")
    assert both.where("native <> py").count() == 0
    assert both.count() == 100


def test_jsonl_unicode_and_null_roundtrip(spark, tmp_path):
    rows = [([{"role": "user", "content": "é"}, {"role": "assistant", "content": 'say "hi"\nnow'},
              {"role": "assistant", "content": None}], "c")]
    df = spark.createDataFrame(rows, CHAT_RECORD)
    out = str(tmp_path / "rt")
    jsonl.write_records(df, out, mode="overwrite")
    back = jsonl.read_records(spark, out).first()
    assert [(m.role, m.content) for m in back.messages] == [
        ("user", "é"), ("assistant", 'say "hi"\nnow'), ("assistant", None)]
    text = "".join(open(f).read() for f in __import__("glob").glob(out + "/*.json"))
    assert '"content":null' in text


def test_counts_faulty(spark):
    results = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, "a", "x"), (4, "a", None), (5, "b", "x"), (6, "b", "y")],
        "slot_id long, category string, error string")
    att = {r.category: r.attempts for r in mt.category_counts(results).collect()}
    ok = {r.category: r.successes for r in mt.provider_counts(spark, results, ["a", "b"],
                                                                provider="category").collect()}
    assert att == {"a": 4, "b": 2}
    assert ok == {"a": 3, "b": 0}
    s = mt.run_summary(results).first()
    assert (s.attempted, s.generated, s.failed) == (6, 3, 3)


def test_slots_after_sink(spark, tmp_path):
    sink = tmp_path / "sink.jsonl"
    sink.write_text("\n".join(['{"category": "c"}'] * 4) + "\n")
    assert [r.slot_id for r in pl.slots_after_sink(spark, 10, str(sink)).collect()] == [4, 5, 6, 7, 8, 9]
    assert pl.slots_after_sink(spark, 3, str(sink)).count() == 0
    assert pl.slots_after_sink(spark, 5, str(tmp_path / "missing")).count() == 5


def test_topup(spark):
    assert [pl.shortfall(10, e) for e in (0, 4, 10, 12)] == [10, 6, 0, 0]
    assert [r.slot_id for r in pl.plan_slots(spark, 10, 4).collect()] == [4, 5, 6, 7, 8, 9]
    assert pl.plan_slots(spark, 10, 12).count() == 0
    plan = pl.plan_slots(spark, 6)
    done = spark.createDataFrame([(1,), (4,)], "slot_id long")
    assert sorted(r.slot_id for r in pl.topup_plan(plan, done).collect()) == [0, 2, 3, 5]


@pytest.mark.parametrize("n,n_eval", [(1, 1), (19, 1), (20, 1), (21, 2), (140, 7), (900, 45)])
def test_split_sizes(spark, n, n_eval):
    df = spark.range(n).withColumnRenamed("id", "rid")
    out = sp.train_eval_split(df, "rid").collect()
    assert len(out) == n
    assert sorted(r.rid for r in out) == list(range(n))
    assert sum(r.split == "eval" for r in out) == n_eval


def test_manifest(spark):
    df = spark.range(18).withColumnRenamed("id", "rid")
    m = sp.batch_manifest(df, "rid", epochs=2, micro_batch=4, accumulation=4).collect()
    assert len(m) == 36
    for e in (0, 1):
        rows = [r for r in m if r.epoch == e]
        assert sorted(r.rid for r in rows) == list(range(18))
        assert sorted(r.position for r in rows) == list(range(18))
        assert len({r.micro_batch for r in rows}) == 5
        assert len({r.step for r in rows}) == 2
    order0 = [r.rid for r in sorted((r for r in m if r.epoch == 0), key=lambda r: r.position)]
    order1 = [r.rid for r in sorted((r for r in m if r.epoch == 1), key=lambda r: r.position)]
    assert order0 != order1  # reshuffled per epoch


def test_truncate(spark):
    df = spark.createDataFrame([("a b c",), ("a b c d",), ("a b\nc  d e",), ("  ",)], "text string")
    out = tk.truncate_tokens(df, "text", cap=4).collect()
    assert [r.n_tokens for r in out] == [3, 4, 5, 0]
    assert [r.truncated for r in out] == [False, False, True, False]
    assert [r.text_capped for r in out] == ["a b c", "a b c d", "a b\nc  d", "  "]


def test_truncate_with_tokenizer(spark):
    def spans(t):
        import re
        return [(m.start(), m.end()) for m in re.finditer(r"\S+", t)]
    df = spark.createDataFrame([("a b\nc  d e",), ("x",)], "text string")
    out = tk.truncate_tokens(df, "text", cap=4, tokenize=spans).collect()
    assert [(r.n_tokens, r.truncated, r.text_capped) for r in out] == [
        (5, True, "a b\nc  d"), (1, False, "x")]


def test_offline_backend_faults(spark):
    plan = pl.plan_slots(spark, 4000).withColumn("provider", F.lit("chat_completions")) \
        .withColumn("gen_system", F.lit("S")).withColumn("user_prompt", F.concat(F.lit("p"), "slot_id"))
    shaped = gen.shape_request(plan).drop("request")
    res = gen.extract_response(gen.bulk_generate(shaped, gen.offline_backend(42), concurrency=4))
    rows = res.select("slot_id", "text", "error").collect()
    errs = [r.error for r in rows if r.error]
    assert 0.03 < len(errs) / len(rows) < 0.07
    assert set(errs) == {"RuntimeError: injected fault", gen.ERR_MALFORMED, gen.ERR_NO_CONTENT,
                         gen.ERR_EMPTY}
    ok = [r for r in rows if not r.error]
    assert all(r.text.startswith(gen.OFFLINE_PREFIX + f"p{r.slot_id}") for r in ok)


def test_http_backend_posts_body_and_captures_errors(spark, monkeypatch):
    """No network: urlopen is replaced by a stub that echoes the body back in
    the form's reply shape, and fails for one slot."""
    import io
    import urllib.error
    import urllib.request

    seen = []

    class Resp(io.BytesIO):
        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

    def fake_urlopen(req, timeout=None):
        body = json.loads(req.data.decode("utf-8"))
        seen.append((req.full_url, req.get_method(), req.headers.get("Content-type")))
        if gen.request_text("chat_completions", body) == "boom":
            raise urllib.error.HTTPError(req.full_url, 500, "server error", {}, None)
        return Resp(gen.wrap_reply("chat_completions", "ok:" + gen.request_text("chat_completions", body)).encode())

    monkeypatch.setattr(urllib.request, "urlopen", fake_urlopen)
    call = gen.http_backend({"chat_completions": "http://generator.invalid/v1/chat"}, concurrency=2)
    plan = spark.createDataFrame([(1, "hi"), (2, "boom")], "slot_id long, user_prompt string") \
        .withColumn("provider", F.lit("chat_completions")).withColumn("gen_system", F.lit("S"))
    shaped = gen.shape_request(plan).drop("request").toPandas()
    outs = [gen._safe(call)(r) for r in shaped[["slot_id", "provider", "body"]].to_dict("records")]
    assert json.loads(outs[0][0])["choices"][0]["message"]["content"] == "ok:hi"
    assert outs[0][1] is None
    assert outs[1][0] is None and outs[1][1].startswith("HTTPError")
    assert seen[0] == ("http://generator.invalid/v1/chat", "POST", "application/json")
    assert call.concurrency == 2


def test_attempts_and_successes_differ_with_faults(spark):
    from dialforge.plans import registry as R
    from tests.conftest import SF001

    attempts = sum(r.attempts for r in R.QUERIES["category_counts"](spark, SF001).collect())
    successes = sum(r.successes for r in R.QUERIES["provider_counts"](spark, SF001).collect())
    summary = R.QUERIES["run_summary"](spark, SF001).first()
    turns = spark.read.parquet(f"{SF001}/conversations.parquet").where("role = 'user'").count()
    assert attempts == summary.attempted == turns  # one request per user turn
    assert successes == summary.generated < attempts
    assert summary.failed == attempts - successes


def test_shard_union_is_a_bag(spark):
    from dialforge.sources import store

    a = spark.createDataFrame([(1, "x")], "slot_id long, category string")
    b = spark.createDataFrame([(1, "x", "p")], "slot_id long, category string, provider string")
    u = store.union_shards(a, a, b).collect()
    assert len(u) == 3
    assert sorted((r.slot_id, r.provider or "") for r in u) == [(1, ""), (1, ""), (1, "p")]


def test_catalog_without_prompts_fails_before_planning(spark):
    from dialforge.plans import build_dataset as bd

    bad = cat.catalog_from_dict(spark, {"a": {"weight": 1, "prompts": ["x"]},
                                        "b": {"weight": 1, "prompts": []}})
    with pytest.raises(ValueError, match="no prompts"):
        bd.plan_from_catalog(pl.plan_slots(spark, 10), bad, bd.BuildConfig())


def test_prepare_drops_unanswered_and_rejected(spark):
    from dialforge.plans import prepare_training as pt

    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("messages", T.ArrayType(
        T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])))])
    rows = [(1, [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"},
                 {"role": "user", "content": "tail"}]),
            (2, [{"role": "user", "content": "only a question"}]),
            (3, [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}])]
    recs = spark.createDataFrame(rows, schema)
    out = pt.prepare(recs, "rid", answered_only=True).collect()
    assert [r.rid for r in out] == [1]
    assert out[0].text == (f"<|system|>{NL}{chat.DEFAULT_SYSTEM}</s>{NL}<|user|>{NL}u</s>{NL}"
                           f"<|assistant|>{NL}a</s>{NL}")
    assert [r.rid for r in pt.unanswered(recs).collect()] == [2]
    assert [r.rid for r in pt.rejected(recs).collect()] == [3]


def test_truncate_with_tokenizer_file(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = {"[UNK]": 0, "a": 1, "b": 2, "c": 3, "d": 4, "e": 5, ",": 6}
    tok = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Whitespace()])
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    df = spark.createDataFrame([("a b,c d e",), ("a b",)], "text string")
    out = tk.truncate_tokens(df, "text", cap=4, tokenize=tk.tokenizer_file_spans(path)).collect()
    # tokens: a | b | , | c | d | e  -> 6 tokens, cut after the 4th ("c")
    assert [(r.n_tokens, r.truncated, r.text_capped) for r in out] == [
        (6, True, "a b,c"), (2, False, "a b")]


def test_bundled_catalog_matches_fixed_weights(spark):
    rows = cat.read_catalog(spark).orderBy("ord").collect()
    assert {r.category: r.weight for r in rows} == cat.BUNDLED_WEIGHTS
    assert [r.category for r in rows] == list(cat.BUNDLED_WEIGHTS)
    assert all(r.prompts and r.system for r in rows)
    assert cat.validate_catalog(cat.read_catalog(spark)) == (100, 5)


def test_split_checks_unique_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "rid long")
    with pytest.raises(ValueError, match="not unique"):
        sp.train_eval_split(df, "rid", check_unique=True)
    ok = spark.range(30).withColumnRenamed("id", "rid")
    assert sp.train_eval_split(ok, "rid", check_unique=True).where("split = 'eval'").count() == 2


def test_cluster_settings_scale_with_input():
    from dialforge.session import cluster_settings

    small = cluster_settings(800)
    big = cluster_settings(800, input_bytes=100 * 2**40)  # 100 TiB
    assert small["spark.sql.shuffle.partitions"] == "2400"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (128 << 20)
    assert big["spark.speculation"] == "false"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_prepare_keeps_every_record(spark):
    """By default nothing is dropped or cut; nulls render as empty."""
    recs = spark.createDataFrame(
        [(1, [("user", "a"), ("assistant", "b"), ("user", "c")]), (2, [("user", "x")]), (3, [("user", None)]), (4, [])],
        "rid long, messages array<struct<role:string,content:string>>")
    from dialforge.plans import prepare_training as pt

    got = {r.rid: r.text for r in pt.prepare(recs, "rid", system="s").collect()}
    assert got == {1: "<|system|>\ns</s>\n<|user|>\na</s>\n<|assistant|>\nb</s>\n<|user|>\nc</s>\n",
                   2: "<|system|>\ns</s>\n<|user|>\nx</s>\n", 3: "<|system|>\ns</s>\n<|user|>\n</s>\n",
                   4: "<|system|>\ns</s>\n"}


def test_corrupt_lines_by_file_and_line(spark, tmp_path):
    """Against plain numbering, with files cut into many splits."""
    import random

    rng, want = random.Random(4), []
    folder = tmp_path / "many"
    folder.mkdir()
    for f in range(3):
        lines = []
        for i in range(1, 800):
            kind = rng.random()
            line = ('{"messages": [' if kind < 0.02 else "  " if kind < 0.04 else "" if kind < 0.05 else "é not json" if kind < 0.06
                    else '{"messages": [], "category": "' + "x" * rng.randint(0, 200) + '"}')
            if kind < 0.06:
                want.append((f"f{f}.jsonl", i, line))
            lines.append(line)
        (folder / f"f{f}.jsonl").write_text("\n".join(lines) + ("\n" if f else ""), encoding="utf-8")
    (folder / "empty.jsonl").write_text("")
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = {k: spark.conf.get(k) for k in (size, cost)}
    for n in ("8k", "1m"):
        spark.conf.set(size, n)
        spark.conf.set(cost, "0")
        try:
            got = [(r["file"].rsplit("/", 1)[1], r["line"], r["text"]) for r in jsonl.corrupt_lines(spark, str(folder)).collect()]
            skipped = jsonl.corrupt_lines(spark, str(folder), blank_lines="skip").count()
            every = jsonl.numbered_lines(spark, str(folder))
            counts = {r["file"].rsplit("/", 1)[1]: (r["n"], r["last"]) for r in every.groupBy("file").agg(
                F.count("*").alias("n"), F.max("line").alias("last")).collect()}
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        assert sorted(got) == sorted(want)
        assert skipped == sum(bool(t.strip()) for _, _, t in want)
        assert counts == {f"f{f}.jsonl": (799, 799) for f in range(3)}
    with pytest.raises(ValueError, match="line "):
        jsonl.require_sound(spark, str(folder))
    jsonl.require_sound(spark, str(folder / "empty.jsonl"))
