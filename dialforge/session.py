"""Session helpers: a tuned local session for tests/bench, and the shared folder.

Intermediate tables (generation results, JSON Lines exports) go under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``), never a
machine-local temp folder. The folder is only invented when the session has
none and runs in local mode (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "dialforge") -> SparkSession:
    """Session for tests and the bench: AQE on, Arrow on, UTC, no UI."""
    parts = shuffle_partitions or (int(cores) * 2 if str(cores).isdigit() else 16)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # generation calls are at-least-once; speculation would double them
        .config("spark.speculation", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(total_cores: int, input_bytes: int | None = None) -> dict[str, str]:
    """Suggested settings for a cluster run (pass to ``SparkSession.builder``
    or ``spark-submit --conf``); nothing here is applied automatically.

    Shuffle partitions start at ~3x the cores (or ~input / 128 MB when the
    input size is known, whichever is larger) and AQE coalesces them to the
    advisory size, so partitions fit executor memory at any scale; skewed
    partitions are split by AQE's skew join. Generation calls are
    at-least-once, so speculation stays off.
    """
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, -(-input_bytes // (128 << 20)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": "256m",
        # long prompts: keep Arrow batches to tens of MB per Python worker
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.speculation": "false",
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dialforge`` importable in the Python workers of this Spark
    application (``addPyFile`` of a zip of the package, once per
    application) -- what ``--py-files`` does at submit time. Needed when the
    package is on the driver's ``sys.path`` but not installed."""
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="dialforge-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "dialforge"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Reads ``spark.checkpoint.dir`` (conf) or the context's checkpoint dir.
    Only when neither is set *and* the master is local is a folder made and
    registered, as tests do; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(e.g. an object-store or HDFS path) visible to all executors")
    path = tempfile.mkdtemp(prefix="dialforge-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Schemas of the tables the registered queries read, passed explicitly so a
# scan needs no schema-inference job (and a changed file fails loudly).
TABLE_SCHEMAS = {
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp, o_orderpriority string"),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "events": ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
               "props string"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str):
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))
