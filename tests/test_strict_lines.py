"""A strict scan parses each line once, and still fails on blank and malformed lines."""

import pytest
from pyspark.sql import functions as F

from dialforge.operators import messages as msg
from dialforge.plans import build_dataset as bd
from dialforge.schemas import CHAT_RECORD
from dialforge.session import scratch_path
from dialforge.sources import jsonl

GOOD = '{"messages":[{"role":"user","content":"a\\tb"}],"category":"c"}'


def _folder(tmp_path, *lines):
    (tmp_path / "x.jsonl").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_a_line_is_parsed_once(spark, tmp_path):
    back = jsonl.read_records(spark, _folder(tmp_path, GOOD, f"\t {GOOD} "))
    flat = back.select("category", F.size("messages").alias("n"), msg.flatten_messages(F.col("messages")).alias("flat"))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1, plan
    assert back.schema == CHAT_RECORD
    assert [tuple(r) for r in flat.collect()] == [("c", 1, "user␟a\tb")] * 2  


@pytest.mark.parametrize("bad, said", [("", "blank line"), (" \t ", "blank line"), (" \r\t", "blank line"),
                                       ('{"messages":', "Malformed"), ("null", "Malformed")])
def test_bad_lines_fail_whatever_is_read_of_them(spark, tmp_path, bad, said):
    path = _folder(tmp_path, GOOD, bad, GOOD)
    for read in (lambda df: df.count(), lambda df: df.select("category").collect(), lambda df: df.agg(F.max("category")).collect()):
        with pytest.raises(Exception, match=said):
            read(jsonl.read_records(spark, path))


def test_exported_lines_are_packed_for_speed(spark):
    """Level four of gzip, not the default: between the sizes of both."""
    words = F.concat_ws(" ", *[F.substring(F.md5(F.concat(F.lit(f"{i} "), F.col("id") % (i + 7))), 1, 5) for i in range(120)])
    records = spark.range(400).coalesce(1).select(
        F.col("id").alias("slot_id"), F.lit("p").alias("provider"), F.lit("c").alias("category"),
        F.array(F.struct(F.lit("user").alias("role"), words.alias("content"))).alias("messages"))

    def size(write):
        path = scratch_path(spark, "packed")
        write(path)
        return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).agg(F.sum("length")).first()[0]

    levels = [size(lambda p: jsonl.write_records(records, p, compression="gzip", **{"zlib.compress.level": level}))
              for level in ("DEFAULT_COMPRESSION", "BEST_SPEED")]
    packed = size(lambda p: bd.export_records(records, p, ["r"], bd.BuildConfig(export_codec="gzip")))
    assert levels[0] < packed < levels[1]
