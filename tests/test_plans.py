"""Physical-plan checks: native expressions stay out of Python, the split and
manifest never gather full rows into one partition, scans are pruned."""

import re

import pytest

from dialforge.plans import registry as R
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "compose_prompt", "assemble_messages", "normalize_system", "render_chat",
    "render_inference_prompt", "last_message", "truncate_tokens", "shape_request",
    "extract_response", "weighted_draw", "uniform_prompt_draw", "train_eval_split",
    "batch_manifest"])
def test_no_python_in_native_operators(spark, name):
    plan = _plan(R.QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "MapInPandas" not in plan and "MapInArrow" not in plan and "PythonUDF" not in plan


def _single_partition_subtrees(plan: str):
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            indent = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= indent:
                    break
                sub.append(nxt)
            yield sub


@pytest.mark.parametrize("name", ["train_eval_split", "split_sizes", "batch_manifest",
                                  "catalog_prompts", "uniform_prompt_draw"])
def test_single_partition_only_over_aggregates(spark, name):
    """A SinglePartition exchange may only sit above an aggregate (the small
    per-bucket or per-category count tables), never above raw rows."""
    plan = _plan(R.QUERIES[name](spark, SF001))
    for sub in _single_partition_subtrees(plan):
        ops = [s for s in sub if "HashAggregate" in s or "Scan" in s or "LocalTableScan" in s]
        assert ops and "HashAggregate" in ops[0], sub[:3]


def test_split_does_not_shuffle_full_rows(spark):
    """The split reads wide rows once and only broadcasts small tables to
    them: the wide column never crosses a shuffle exchange."""
    from dialforge.operators import split as sp
    from dialforge.session import read_table

    docs = read_table(spark, SF001, "documents").select("doc_id", "text")
    plan = _plan(sp.train_eval_split(docs, "doc_id"))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            assert "text" not in line


def test_scan_is_pruned(spark):
    plan = _plan(R.QUERIES["truncate_tokens"](spark, SF001))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("lang" not in s and "source" not in s for s in schemas)


@pytest.mark.parametrize("name", sorted(R.QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(R.QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_weighted_draw_does_not_shuffle_plan_rows(spark):
    plan = _plan(R.QUERIES["weighted_draw"](spark, SF001))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_ship_package_once_per_application(spark):
    from dialforge import session

    session.ship_package(spark)
    n = len(spark.sparkContext._python_includes)
    session.ship_package(spark)
    assert len(spark.sparkContext._python_includes) == n
