"""Vector bin packing of examples into training sequences.

Every example has a demand vector (tokens, segments, loss-bearing tokens) and
every sequence the same limits. A task fills one sequence at a time: among the
examples of its pool that fit in all three dimensions it takes the one with the
largest weighted dot product of demand and what is still free. When none fits
and enough is free, the head of the largest example fills the gap and its rest
stays in the pool. An example over a limit is first cut into full sequences.

A task packs its own partition, so nothing is shuffled and no group is
gathered; a pool holds at most ``POOL`` rests of less than one sequence each.
Only the last sequence of a task may be short by more than ``MIN_CUT`` tokens.

Cases: an empty example (no ids) gives one piece of length 0; a null ``ids`` is
empty; a null ``loss_from`` is 0 (all ids bear loss); equal and repeated
examples are separate examples; no rows give no pieces; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialforge.llm.byte_bpe import document_ids
from dialforge.llm.store import map_arrow, text_batches

POOL = 1024        # rests of examples that a task chooses from
MIN_CUT = 16       # a gap below this many tokens is padded
OUT_BYTES = 4 << 20


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class _Rest:
    """What is left of an example."""
    key: object
    ids: np.ndarray
    start: int          # of the rest, in the example
    total: int
    loss_from: int

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.loss_from))


def _fits(rest: _Rest, tokens: int, loss: int) -> int:
    """Longest head of ``rest`` within ``tokens`` and ``loss``."""
    plain = max(0, rest.loss_from - rest.start)      # ids before the first that bears loss
    return min(len(rest.ids) - rest.start, tokens, plain + loss)


class Packer:
    """Packs examples one after another; ``pieces`` come out in order of
    sequence, each with its place."""

    def __init__(self, limits: Limits, first_sequence: int = 0):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits must be positive")
        self.limits, self.sequence, self.pool = limits, first_sequence, []
        self.out: list[tuple] = []

    def _place(self, rest: _Rest, length: int, offset: int) -> None:
        piece = rest.ids[rest.start:rest.start + length]
        self.out.append((rest.key, rest.start, length, piece, rest.total, self.sequence, offset))
        rest.start += length

    def add(self, key, ids: np.ndarray, loss_from: int = 0) -> None:
        rest = _Rest(key, ids, 0, len(ids), max(0, loss_from))
        full = self.limits.tokens
        while (n := len(ids) - rest.start) >= full or rest.loss(n) > self.limits.loss:
            self._place(rest, _fits(rest, full, self.limits.loss), 0)
            self.sequence += 1
        if len(ids) > rest.start or not len(ids):
            self.pool.append(rest)
        if len(self.pool) >= POOL:
            self.fill(POOL // 2)

    def fill(self, keep: int) -> None:
        """Pack sequences until at most ``keep`` rests are left."""
        lim = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        pool = self.pool
        need = np.array([[len(r.ids) - r.start, 1, r.loss(len(r.ids) - r.start)] for r in pool], float).reshape(-1, 3)
        live = np.ones(len(pool), bool)
        while live.sum() > keep:
            # dimensions in short supply weigh more
            weight = need[live].mean(axis=0) / lim
            score = need / lim * weight / lim
            free, offset = lim.copy(), 0
            while True:
                can = live & (need <= free).all(axis=1)
                if can.any():
                    i = int(np.argmax(np.where(can, score @ free, -1.0)))
                    length = len(pool[i].ids) - pool[i].start
                    free -= need[i]
                    self._place(pool[i], length, offset)
                    offset += length
                    live[i] = False
                    continue
                if live.any() and free[0] >= MIN_CUT and free[1] >= 1:
                    i = int(np.argmax(np.where(live, need[:, 0], -1.0)))
                    length = _fits(pool[i], int(free[0]), int(free[2]))
                    if length >= MIN_CUT:
                        loss = pool[i].loss(length)
                        self._place(pool[i], length, offset)
                        offset += length
                        free -= (length, 1, loss)
                        left = len(pool[i].ids) - pool[i].start
                        need[i] = (left, 1, pool[i].loss(left))
                        if offset < self.limits.tokens:
                            continue
                break
            self.sequence += 1
        self.pool = [r for r, on in zip(pool, live) if on]


def _schema(key_type: pa.DataType) -> pa.Schema:
    return pa.schema([("key", key_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                      ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _body(limits: Limits):
    def run(batches):
        packer, schema = Packer(limits, TaskContext.get().partitionId() << 36), None

        def drain():
            lo, held = 0, 0
            for i, piece in enumerate(packer.out):
                held += piece[2] * 4
                if held > OUT_BYTES or i == len(packer.out) - 1:
                    cols = list(zip(*packer.out[lo:i + 1]))
                    cols[3] = [np.ascontiguousarray(p, "<u4").tobytes() for p in cols[3]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
                    lo, held = i + 1, 0
            packer.out = []

        for batch in batches:
            schema = schema or _schema(batch.schema.field(0).type)
            for i in range(batch.num_rows):
                packer.add(batch.column(0)[i].as_py(),
                           np.frombuffer(batch.column(1)[i].as_py() or b"", "<u4"), batch.column(2)[i].as_py() or 0)
                if len(packer.out) >= 2 * POOL:
                    yield from drain()
        if schema is not None:
            packer.fill(0)
            yield from drain()
    return run


def pack(examples: DataFrame, key: str, limits: Limits = Limits(), loss_from: str | None = None) -> DataFrame:
    """Pieces of ``examples`` (``key``, ``ids`` as little-endian uint32 binary,
    optionally the position of the first loss-bearing id): key, start, length,
    ids, doc_tokens, sequence_id, offset."""
    kind = examples.schema[key].dataType.simpleString()
    rows = examples.select(F.col(key).alias("key"), F.col("ids"),
                           (F.col(loss_from) if loss_from else F.lit(0)).cast("long").alias("loss_from"))
    out = rows.transform(map_arrow, _body(limits), f"key {kind}, start long, length long, ids binary, doc_tokens long, "
                                         "sequence_id long, offset long")
    return out.withColumnRenamed("key", key)


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = 1) -> DataFrame:
    """Tokenise ``doc_id, text`` and pack the documents, each closed by ``end_id``."""
    text_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text")).transform(map_arrow,
        document_ids(tokenizer, end_id), f"key {kind}, ids binary").withColumnRenamed("key", "doc_id")
    return pack(ids, "doc_id", limits)
