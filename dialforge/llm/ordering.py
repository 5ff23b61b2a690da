"""Training-order materialisation of token sequences.

Documents become sequences of a fixed number of ids (the last of a document is
padded) and are written once. A sequence's number is the place of its row in
the files written, counted through in file order; a keyed Feistel permutation
sends it to its slot: rounds mix the halves of the number's bits, and as the
bits span more numbers than there are sequences, a result beyond the last is
permuted again until it falls inside (cycle-walking). The map is one-to-one, has
no table and no shuffle of its own, and any slot can be computed anew. Range
partitions by slot then hold shards of ``shard`` slots, and each shard is written
as one folder; its ids take the same number of bytes in every record, so slot s is
record ``s % shard`` of shard ``s // shard``, and reading resumes at any slot. As
the pad is also a token, ``n_ids`` in each record says where its text ends.

Cases: null and empty texts give the one sequence of the end id; very long texts
give many sequences; repeated rows give their own sequences; a null doc_id
stays null; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialforge.llm.byte_bpe import document_ids
from dialforge.llm.store import map_arrow, shuffle_partitions, text_batches
from dialforge.session import scratch_path

LENGTH = 1024
SHARD = 4096
ROUNDS = 6
PAD = 0


def round_keys(key: str) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little") for r in range(ROUNDS)]


def feistel(x: np.ndarray, n: int, key: str) -> np.ndarray:
    """Slots of numbers below ``n``: a permutation of 0..n-1."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = x.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> np.uint64(half), out[walk] & mask
        for k in round_keys(key):
            f = (right + np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f >> np.uint64(31)) & mask)
        out[walk] = left << np.uint64(half) | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1, packed: bool = False) -> DataFrame:
    """``doc_id, start, n_ids, ids`` (little-endian uint32, padded to ``length``);
    ``packed``: the ids by :func:`pack_ids`, in a column of that name."""
    ids_name = "packed" if packed else "ids"
    text_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in document_ids(tokenizer, end_id)(batches):
            rows, starts, sizes, parts = [], [], [], []
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py()
                for s in range(0, len(raw) // 4, length):
                    part = raw[4 * s:4 * (s + length)]
                    rows.append(i)
                    starts.append(s)
                    sizes.append(len(part) // 4)
                    part += PAD.to_bytes(4, "little") * (length - len(part) // 4)
                    parts.append(pack_ids(part) if packed else part)
                if len(parts) * 4 * length > 8 << 20 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                         pa.array(parts, pa.binary())], ["key", "start", "n_ids", ids_name])
                    rows, starts, sizes, parts = [], [], [], []

    ids = docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"))
    return ids.transform(map_arrow, cut, f"key {kind}, start long, n_ids long, {ids_name} binary").withColumnRenamed("key", "doc_id")


_ZSTD = "zstd"


def pack_ids(ids: bytes) -> bytes:
    """Width of an id, number of bytes, and the ids compressed: 16 bits each if all fit."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() > 0xFFFF:
        width, raw = 4, ids
    else:
        width, raw = 2, wide.astype("<u2").tobytes()
    return bytes([width]) + len(raw).to_bytes(4, "little") + pa.compress(raw, _ZSTD, asbytes=True)


def unpack_ids(packed: bytes) -> bytes:
    raw = pa.decompress(packed[5:], int.from_bytes(packed[1:5], "little"), _ZSTD, asbytes=True)
    return raw if packed[0] == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def unpack_all(packed: pa.Array) -> pa.Array:
    """:func:`unpack_ids` of a batch, written into one buffer."""
    rows = [x.as_buffer() for x in packed]
    heads = [(r[0], int.from_bytes(r[1:5].to_pybytes(), "little")) for r in rows]
    ends = np.cumsum([0, *[size * 4 // width for width, size in heads]])
    out = np.empty(int(ends[-1]) // 4, "<u4")
    codec = pa.Codec(_ZSTD)
    for r, (width, size), a, b in zip(rows, heads, ends // 4, ends[1:] // 4):
        out[a:b] = np.frombuffer(codec.decompress(r[5:], size), "<u4" if width == 4 else "<u2") if size else 0
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])


def in_training_order(seqs: DataFrame, key: str, shard: int = SHARD) -> DataFrame:
    """The columns of ``seqs`` in ``row``, slot, shard and record, range-partitioned
    and sorted by slot. The sequences are written first: their numbers are then
    fixed, whatever executor is lost. Ids cross the exchange packed; ``seqs`` with
    ``packed`` in place of ``ids`` are written so, and packed by no task of their own."""
    spark = seqs.sparkSession
    path = scratch_path(spark, "llm-sequences")
    ids = "packed" if "packed" in seqs.columns else "ids"
    seqs.write.option("compression", "zstd" if ids == "ids" else "uncompressed").parquet(path)
    stored = spark.read.schema(seqs.schema).parquet(path)
    files = stored.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("n")).orderBy("file").collect()
    first, n = {}, 0
    for r in files:                    # one entry per written file
        first[r["file"]] = n
        n += r["n"]
    starts = spark.createDataFrame(list(first.items()), "file string, first long")

    @F.arrow_udf("long")
    def place(number: pa.Array) -> pa.Array:
        return pa.array(feistel(number.to_numpy(zero_copy_only=False), n, key), pa.int64())

    @F.arrow_udf("binary")
    def packed(ids: pa.Array) -> pa.Array:
        return pa.array([pack_ids(x.as_py()) for x in ids], pa.binary())

    @F.arrow_udf("binary")
    def unpacked(ids: pa.Array) -> pa.Array:
        return unpack_all(ids)

    others = [c for c in seqs.columns if c != ids]
    numbered = stored.select(F.struct(*others).alias("others"), F.col(ids).alias("ids"), F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.row_index").alias("at"))
    numbered = numbered.join(F.broadcast(starts), "file").select("others", "ids", (F.col("first") + F.col("at")).alias("number"))
    placed = numbered.select("others", packed("ids").alias("ids") if ids == "ids" else "ids", place("number").alias("slot"))
    tasks, shards = shuffle_partitions(spark, n, 1 << 15), max(1, -(-n // shard))
    number = F.floor(F.col("slot") / shard).cast("long")
    dealt = placed.repartitionById(tasks, F.floor(number * tasks / shards).cast("int")).select("others", "slot", unpacked("ids").alias("ids"))
    row = F.struct(*[F.col("ids") if c == ids else F.col("others").getField(c).alias(c) for c in seqs.columns])
    return dealt.select(row.alias("row"), "slot", number.alias("shard"), (F.col("slot") % shard).cast("long").alias("record")
                        ).sortWithinPartitions("shard", "slot")


def write_shards(ordered: DataFrame, path: str) -> None:
    """One folder per shard; records with ids of equal size in slot order."""
    ordered.select("shard", "slot", "record", "row.*").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark, path: str, kind: str = "long") -> DataFrame:
    """All records written, in no order; ``kind`` is the type of doc_id."""
    return spark.read.schema(f"slot long, record long, doc_id {kind}, start long, n_ids long, ids binary, shard long").parquet(path)


def read_from(spark, path: str, slot: int, shard: int = SHARD, kind: str = "long") -> DataFrame:
    """The records from ``slot`` on, without opening earlier shards. Each task
    gets one shard and puts its records in their places; tasks follow one another."""
    first = slot // shard
    rest = read_shards(spark, path, kind).where((F.col("shard") >= first) & (F.col("slot") >= slot))
    last = rest.agg(F.max("shard")).first()[0]
    tasks = max(1, (first if last is None else last) - first + 1)
    return rest.repartitionById(tasks, (F.col("shard") - first).cast("int")).sortWithinPartitions("record")


def read_shard(spark, path: str, shard: int, record: int = 0, kind: str = "long") -> DataFrame:
    """The records of one shard from place ``record`` on, in order; opens that shard only."""
    return read_shards(spark, path, kind).where((F.col("shard") == shard) & (F.col("record") >= record)).coalesce(1).sortWithinPartitions("record")
