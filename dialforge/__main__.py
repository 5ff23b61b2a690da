"""Command line: the two data steps as Spark jobs.

    python -m dialforge build   --out DIR --num N [--catalog FILE] [--backend offline|http ...]
    python -m dialforge prepare --records PATH --out DIR [--epochs E ...]

``build`` plans ``N`` slots from the catalogue, generates (resuming: slots
already successful are skipped, failures are retried), and appends the new
records to ``DIR/records.jsonl``. ``prepare`` turns chat records into the
split-partitioned training set and its batch manifest. Run under
``spark-submit`` on a cluster, with the session's ``spark.checkpoint.dir`` set to a
shared folder for intermediate tables; every output goes under ``--out``.
"""

from __future__ import annotations

import argparse
import json
import sys


def _session(master: str | None):
    from pyspark.sql import SparkSession

    b = SparkSession.builder.appName("dialforge")
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    from dialforge.session import ship_package
    ship_package(spark)  # workers need the package unless it is installed / --py-files
    return spark


def _backend(args):
    from dialforge.operators import generation as gen

    if args.backend == "offline":
        return gen.offline_backend(args.seed, fault_every=args.fault_every)
    urls = dict(u.split("=", 1) for u in args.url)
    headers = dict(h.split("=", 1) for h in args.header)
    return gen.http_backend(urls, headers=headers, timeout=args.timeout,
                            concurrency=args.concurrency)


def cmd_build(args) -> dict:
    from dialforge.operators import planning as pl
    from dialforge.plans import build_dataset as bd
    from dialforge.sources import catalog as cat

    spark = _session(args.master)
    models = dict(m.split("=", 1) for m in args.model)
    cfg = bd.BuildConfig(seed=args.seed, first_provider=args.provider,
                         second_provider=args.second_provider, concurrency=args.concurrency,
                         wave_size=args.wave_size, partitions=args.partitions, models=models)
    catalog = cat.read_catalog(spark, args.catalog)
    plan = bd.plan_from_catalog(pl.plan_slots(spark, args.num), catalog, cfg)
    out = bd.build_dataset(spark, plan, _backend(args), args.out, cfg,
                           export_path=f"{args.out}/records.jsonl")
    m = out["metrics"].first().asDict()
    m["failures_pending"] = out["failures"].count()
    m["report"] = {f"{r.section}: {r.name}": r.n for r in out["report"].collect()}  # categories and providers
    return m


def cmd_prepare(args) -> dict:
    from pyspark.sql import types as T

    from dialforge.operators import identity
    from dialforge.plans import prepare_training as pt
    from dialforge.schemas import CHAT_RECORD
    from dialforge.sources import jsonl

    spark = _session(args.master)
    schema = T.StructType(list(CHAT_RECORD.fields) + [T.StructField("slot_id", T.LongType())])
    recs = jsonl.read_records(spark, args.records, schema=schema, strict=not args.lenient)
    if args.lenient:
        recs, _bad = jsonl.split_corrupt(recs)
        quarantine = jsonl.corrupt_lines(spark, args.records, schema, blank_lines="skip")
        quarantine.write.mode("overwrite").json(f"{args.out}/quarantine")   # each with its file and line
    # the split needs unique ids: the slot id of records this tool exported, else
    # a hash of the record and the number of its copy (the same in whatever files)
    try:
        recs = identity.with_record_id(recs, identity.record_content(), own="slot_id")
    except Exception:
        if not args.lenient:
            jsonl.require_sound(spark, args.records, schema)    # names the lines, if they are the cause
        raise
    out = pt.prepare_training_set(spark, recs, "record_id", args.out, seed=args.seed,
                                  eval_share=args.eval_share, cap=args.max_length,
                                  epochs=args.epochs, micro_batch=args.batch_size,
                                  accumulation=args.accumulation, answered_only=args.answered_only)
    sizes = {r.split: r["count"] for r in out["data"].groupBy("split").count().collect()}
    return {"splits": sizes, "unanswered": out["unanswered"].count(),
            "rejected": out["rejected"].count(), "manifest_rows": out["manifest"].count()}


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="dialforge")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--seed", type=int, default=42)
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build", help="plan, generate, export records")
    b.add_argument("--out", required=True)
    b.add_argument("--num", type=int, required=True, help="target number of slots")
    b.add_argument("--catalog", default=None, help="catalogue JSON Lines (default: bundled)")
    b.add_argument("--provider", default="messages_api")
    b.add_argument("--second-provider", default=None)
    b.add_argument("--model", action="append", default=[], help="FORM=MODEL")
    b.add_argument("--backend", choices=["offline", "http"], required=True,
                   help="offline stores made-up replies, for trials only")
    b.add_argument("--url", action="append", default=[], help="FORM=URL (http backend)")
    b.add_argument("--header", action="append", default=[], help="NAME=VALUE (http backend)")
    b.add_argument("--timeout", type=float, default=300.0)
    b.add_argument("--concurrency", type=int, default=None, help="calls in flight per task")
    b.add_argument("--partitions", type=int, default=None, help="generation tasks")
    b.add_argument("--wave-size", type=int, default=1 << 20, help="slots of one commit")
    b.add_argument("--fault-every", type=int, default=0, help="offline backend fault rate 1/N")

    r = sub.add_parser("prepare", help="records -> training set + manifest")
    r.add_argument("--records", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--lenient", action="store_true", help="skip malformed lines")
    r.add_argument("--answered-only", action="store_true",
                   help="cut records after their last assistant message; drop those without one or with nulls")
    r.add_argument("--eval-share", type=float, default=0.05)
    r.add_argument("--max-length", type=int, default=2048)
    r.add_argument("--epochs", type=int, default=5)
    r.add_argument("--batch-size", type=int, default=4)
    r.add_argument("--accumulation", type=int, default=4)

    args = p.parse_args(argv)
    result = cmd_build(args) if args.cmd == "build" else cmd_prepare(args)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
