"""The two command-line steps end to end (offline backend, in-process)."""

import json

import pytest

from dialforge.__main__ import main
from dialforge.sources import jsonl


def test_build_then_prepare(spark, tmp_path, capsys):
    out = str(tmp_path / "build")
    assert main(["build", "--out", out, "--num", "60", "--second-provider", "chat_completions", "--backend", "offline",
                 "--fault-every", "4"]) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["attempted"] == 60 and 0 < first["failed"] < 60
    assert first["failures_pending"] == first["failed"]
    # rerun: only the failures are retried (fault-free), the export is topped up
    assert main(["build", "--out", out, "--num", "60", "--second-provider", "chat_completions",
                 "--backend", "offline"]) == 0
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert second["failures_pending"] == 0
    assert second["attempted"] == 60 + first["failed"]
    assert jsonl.read_records(spark, f"{out}/records.jsonl").count() == 60
    keys = spark.read.schema("slot_id long").json(f"{out}/records.jsonl")
    assert sorted(r.slot_id for r in keys.collect()) == list(range(60))

    prep = str(tmp_path / "prep")
    assert main(["prepare", "--records", f"{out}/records.jsonl", "--out", prep, "--epochs", "2"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["splits"] == {"train": 57, "eval": 3}
    assert res["unanswered"] == 0 and res["rejected"] == 0
    assert res["manifest_rows"] == 2 * 57


def test_prepare_foreign_jsonl_with_duplicates(spark, tmp_path, capsys):
    """Records without ids (and exact duplicates, which are kept) still get
    unique ids, so the split is exact."""
    rec = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}],
           "category": "c"}
    path = tmp_path / "foreign.jsonl"
    path.write_text("\n".join(json.dumps(rec) for _ in range(40)) + "\n")
    prep = str(tmp_path / "prep")
    assert main(["prepare", "--records", str(path), "--out", prep, "--epochs", "1"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["splits"] == {"train": 38, "eval": 2}


def test_the_split_does_not_depend_on_the_files(spark, tmp_path, capsys):
    """The same records in one file and in many, in another order, without ids."""
    recs = [{"messages": [{"role": "user", "content": f"q{i % 30}"}, {"role": "assistant", "content": "a"}], "category": "c"} for i in range(100)]
    lines = [json.dumps(r) for r in recs]
    (tmp_path / "one.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "many").mkdir()
    for k in range(7):
        (tmp_path / "many" / f"{k}.jsonl").write_text("\n".join(reversed(lines[k::7])) + "\n")
    seen = []
    for name in ("one.jsonl", "many"):
        out = str(tmp_path / f"out-{name}")
        assert main(["prepare", "--records", str(tmp_path / name), "--out", out, "--epochs", "1"]) == 0
        rows = spark.read.parquet(f"{out}/data").select("record_id", "split", "text").collect()
        seen.append(sorted(map(tuple, rows)))
    assert seen[0] == seen[1] and len({r[0] for r in seen[0]}) == 100


def test_a_malformed_line_is_named(spark, tmp_path, capsys):
    good = json.dumps({"messages": [{"role": "user", "content": "q"}], "category": "c"})
    path = tmp_path / "bad.jsonl"
    path.write_text("\n".join([good, good, '{"messages": [', good, ""]) + "\n")
    with pytest.raises(ValueError, match="bad.jsonl, line 3"):
        main(["prepare", "--records", str(path), "--out", str(tmp_path / "out"), "--epochs", "1"])
    assert main(["prepare", "--records", str(path), "--out", str(tmp_path / "out"), "--epochs", "1", "--lenient"]) == 0
    kept = [(r["line"], r["text"]) for r in spark.read.json(str(tmp_path / "out" / "quarantine")).collect()]
    assert kept == [(3, '{"messages": [')]
