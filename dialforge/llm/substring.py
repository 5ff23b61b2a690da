"""Exact substring deduplication of word windows with a count-min prefilter.

A window is ``width`` consecutive words. Every word covered by a window whose
word sequence starts anywhere else goes.

1. *Sketch.* Each window is counted under the smallest hash of the shorter
   shingles in it (its anchor), once per place of that shingle. Equal windows
   have equal anchors at different places, so a count below two proves a window
   unique. Partitions make sparse count-min sketches of ``DEPTH`` rows of
   saturating cells; they merge in shards, in two steps. The anchors are counted
   first: a row has at least two cells for each, from ``2 ** CELL_BITS`` to
   ``2 ** MOST_BITS`` cells. What is left is one bit per cell, "two or more"
   (broadcast: 32 MB to 256 MB). Beyond 2^29 anchors (some 5 * 10^9 words) the
   sketch fills up and lets more windows through; results stay the same.
2. *Exact pass.* Only windows estimated repeated are dealt out by hash, with 96
   bits of hash, row and place. A task sends each distinct window of its batch
   once however often it occurs there, so no copied passage piles up. Equal
   hashes meet in one task (as many tasks as the windows let through, which are
   counted, need at ``PER_TASK`` each), which answers each batch; the answers of a batch
   meet again and become ranges of covered words by row.
3. Rows take back their ranges and drop the words covered.

Cases: null and empty texts have no words; texts with fewer words than a window
stay; a window that repeats within one text counts, overlapping or not; repeated
rows lose all their windows like any copies; rows with equal doc_id and text are
alike, rows with equal doc_id and different texts are apart; null doc_ids are
kept; no rows give no rows; other columns come back untouched in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialforge.llm import text as tx
from dialforge.llm.store import map_arrow, shuffle_partitions, text_batches

WIDTH = 35
ANCHOR = 16             # words of the shingles that anchors are chosen from
DEPTH, CELL_BITS, MOST_BITS, SHARD_BITS = 2, 27, 30, 21
SALTS = 8               # partial sketches of a shard that merge at once in the first step
ANCHORS_HELD = 1 << 21  # anchors a task counts before it sends a partial sketch
WINDOWS_HELD = 1 << 19  # windows a task gathers before it deals them out
PER_TASK = 1 << 21      # windows that meet in one task, on average
_ZSTD = pa.Codec("zstd", 1)
_ROWS = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)


# -- windows of a chunk ------------------------------------------------------

def _slide(a: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` consecutive values."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    run = 1
    while run * 2 <= width:
        a = pick(a[:-run], a[run:])
        run *= 2
    return pick(a[:n], a[width - run:width - run + n])


class Windows:
    """Words and windows of the texts of a chunk."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, width: int):
        self.buf, self.offs, self.width = buf, offs, width
        self.start, self.end, self.per_row = tx.word_spans(buf, offs)
        self.row = tx.row_of(self.per_row)
        n = len(self.row) - width + 1
        self.valid = self.row[:n] == self.row[width - 1:] if n > 0 else np.zeros(0, bool)
        self.words = None

    def hashes(self, which: int) -> np.ndarray:
        words = tx.word_hashes(self.buf, self.start, self.end, tx.SEEDS[which])
        return tx.window_hashes(words, self.width, tx.SEEDS[1 - which])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor hash of every window, and one entry per anchor place."""
        size = min(ANCHOR, self.width)
        words = tx.word_hashes(self.buf, self.start, self.end, tx.SEEDS[0])
        shingles = tx.window_hashes(words, size, tx.SEEDS[0])
        span = self.width - size + 1
        least = _slide(shingles, span, np.minimum)
        if not len(least):
            return least, least
        held = np.where(self.valid, least, np.uint64(0))
        padded = np.concatenate([np.zeros(span - 1, np.uint64), held, np.zeros(span - 1, np.uint64)])
        chosen = _slide(padded, span, np.maximum) == shingles       # the least of some window around it
        return least, shingles[chosen & (shingles > 0)]

    def first_word(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.per_row)])


# -- sketch -------------------------------------------------------------------

def cell_bits(anchors: int) -> int:
    """Bits of a cell number: two cells or more for each anchor, within bounds."""
    return min(max((2 * anchors - 1).bit_length(), CELL_BITS), MOST_BITS)


def _cells(anchor: np.ndarray, depth: int, n_bits: int) -> np.ndarray:
    return (tx.mix(anchor * np.uint64(_ROWS[depth])) >> np.uint64(64 - n_bits)).astype(np.int64)


def _squeeze(cells: np.ndarray) -> bytes:
    """Sorted cell numbers as compressed differences."""
    raw = np.diff(cells, prepend=0).astype("<u4").tobytes()
    return len(cells).to_bytes(4, "little") + _ZSTD.compress(raw, asbytes=True)


def _expand(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    return np.cumsum(np.frombuffer(_ZSTD.decompress(raw[4:], 4 * n, asbytes=True), "<u4").astype(np.int64))


def _bits(cells: np.ndarray) -> bytes:
    """One bit per cell, "two or more", compressed."""
    return _ZSTD.compress(np.packbits(cells > 1).tobytes(), asbytes=True)


def _partial_sketch_body(width: int, n_bits: int):
    def run(batches):
        salt = TaskContext.get().partitionId() % SALTS

        def send(held):
            anchors = np.concatenate(held)
            rows = []
            for depth in range(DEPTH):
                cell, count = np.unique(_cells(anchors, depth, n_bits), return_counts=True)
                cuts = np.searchsorted(cell >> SHARD_BITS, np.arange((1 << n_bits - SHARD_BITS) + 1))
                for shard, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if hi > lo:
                        local, several = cell[lo:hi] & (1 << SHARD_BITS) - 1, count[lo:hi] > 1
                        rows.append((depth << n_bits - SHARD_BITS | shard, salt, _squeeze(local[~several]), _squeeze(local[several])))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["shard", "salt", "once", "more"])

        held, n, windows = [], 0, 0
        for batch in batches:
            for _, _, buf, offs in tx.chunks(batch.column("text")):
                held.append(Windows(buf, offs, width).anchors()[1])
                n += len(held[-1])
                if n >= ANCHORS_HELD:
                    yield send(held)
                    held, n = [], 0
        if n:
            yield send(held)
    return run


def _merge_body(final: bool):
    """Partial sketches of some shards in; merged ones out, as sparse counts or
    at last as one bit per cell, compressed: the driver takes in all of them."""
    def run(batches):
        shards: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for shard, salt, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                cells = shards.setdefault((shard, 0 if final else salt), np.zeros(1 << SHARD_BITS, np.uint8))
                one = _expand(once)
                cells[one] = np.minimum(cells[one] + 1, 2)
                cells[_expand(more)] = 2
        for (shard, salt), cells in shards.items():
            if final:
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([_bits(cells)])],
                                                 ["shard", "bits"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([salt], pa.int32()),
                     *(pa.array([_squeeze(np.flatnonzero(cells == c))], pa.binary()) for c in (1, 2))],
                    ["shard", "salt", "once", "more"])
    return run


def _count_body(width: int, sent=None):
    """The number of anchors in a task's texts, or that of windows let through by a sketch."""
    def run(batches):
        n = 0
        for batch in batches:
            for _, _, buf, offs in tx.chunks(batch.column("text")):
                w = Windows(buf, offs, width)
                least, anchors = w.anchors()
                n += len(anchors) if sent is None else int(maybe_repeated(least[w.valid], sent.value).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
    return run


def count(texts: DataFrame, width: int, sent=None) -> int:
    return texts.select("text").transform(map_arrow, _count_body(width, sent), "n long").agg(F.sum("n")).first()[0] or 0


def sketch(texts: DataFrame, width: int = WIDTH) -> np.ndarray:
    """One bit per cell and row of the merged sketch, sized by the number of
    anchors: counted twice or more."""
    n_bits = cell_bits(count(texts, width))
    kinds = "shard int, salt int, once binary, more binary"
    shards = DEPTH << n_bits - SHARD_BITS
    parts = texts.select("text").transform(map_arrow, _partial_sketch_body(width, n_bits), kinds)
    some = parts.repartition(shards * 2, "shard", "salt").transform(map_arrow, _merge_body(False), kinds)
    merged = some.repartition(shards, "shard").transform(map_arrow, _merge_body(True), "shard int, bits binary").collect()
    out = np.zeros((shards, 1 << SHARD_BITS - 3), np.uint8)
    for r in merged:
        out[r["shard"]] = np.frombuffer(_ZSTD.decompress(r["bits"], 1 << SHARD_BITS - 3, asbytes=True), np.uint8)
    return out.reshape(DEPTH, -1)


def maybe_repeated(anchors: np.ndarray, bits: np.ndarray) -> np.ndarray:
    ok, n_bits = np.ones(len(anchors), bool), (8 * bits.shape[1]).bit_length() - 1
    for depth in range(DEPTH):
        cell = _cells(anchors, depth, n_bits)
        ok &= (bits[depth][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return ok


# -- exact pass ----------------------------------------------------------------

def _ranges(places: np.ndarray, width: int) -> bytes:
    """Sorted places of windows as (first, end) of the words they cover."""
    new = np.flatnonzero(np.concatenate([[True], places[1:] > places[:-1] + width]))
    return np.stack([places[new], places[np.append(new[1:] - 1, len(places) - 1)] + width], axis=1).astype("<u4").tobytes()


def _deal_body(width: int, buckets: int, sent):
    """Windows estimated repeated, dealt out by hash; one line per bucket and
    batch. Windows found twice in the batch are known repeated: their places go
    along (bucket drawn from the row), with one witness each."""
    names = ["bucket", "batch", "h1", "h2", "row", "place", "keys"]

    def run(batches):
        bits = sent.value
        task, sends = TaskContext.get().partitionId() << 32, 0

        def send(held, batch):
            keys = np.concatenate([k for k, *_ in held])
            base = np.cumsum([0] + [len(k) for k, *_ in held])[:-1]
            h1, h2, place = (np.concatenate([h[i] for h in held]) for i in (1, 2, 4))
            row = np.concatenate([h[3] + b for h, b in zip(held, base)])
            order = np.lexsort((h2, h1))
            h1, h2, row, place = h1[order], h2[order], row[order], place[order]
            first = np.ones(len(h1), bool)
            first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            group = np.cumsum(first) - 1
            known = np.bincount(group)[group] > 1
            # an unknown window, or one witness of a known one (place with the top bit)
            mark = np.where(known, place | np.uint32(1 << 31), place)[first]
            lines = []

            for parts in ((h1[first], h2[first], row[first], mark), (h1[known][:0], h2[known][:0], row[known], place[known])):
                a, b, r, p = parts
                bucket = ((a >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64) if len(a) else \
                    (keys[r, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
                for c, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if hi > lo:
                        pick = by[lo:hi]
                        who, local = np.unique(r[pick], return_inverse=True)
                        hashes = (a[pick].tobytes(), b[pick].tobytes()) if len(a) else (b"", b"")
                        lines.append((c, batch, *hashes, local.astype("<u4").tobytes(), p[pick].astype("<u4").tobytes(), keys[who].tobytes()))
            for lo in range(0, len(lines), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*lines[lo:lo + 64]), (pa.int32(), pa.int64(), *[pa.binary()] * 5))], names)

        held, n = [], 0
        for batch in batches:
            k = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2")], axis=1)
            for lo, hi, buf, offs in tx.chunks(batch.column("text")):
                w = Windows(buf, offs, width)
                anchors, _ = w.anchors()
                at = np.flatnonzero(w.valid)
                at = at[maybe_repeated(anchors[at], bits)]
                if not len(at):
                    continue
                place = (at - w.first_word()[w.row[at]]).astype(np.uint32)
                who, local = np.unique(w.row[at], return_inverse=True)
                held.append((k[lo:hi][who], w.hashes(0)[at], (w.hashes(1)[at] >> np.uint64(32)).astype(np.uint32), local, place))
                n += len(at)
                if n >= WINDOWS_HELD:
                    yield from send(held, task | sends)
                    held, n, sends = [], 0, sends + 1
        if n:
            yield from send(held, task | sends)
    return run


def _meet_body():
    """All windows of some buckets in; rows and places of repeated ones out,
    one line for each line in that has any."""
    names = ["batch", "row", "place", "keys"]

    def run(batches):
        h1, h2, lines, rows, places, source = [], [], [], [], [], []
        for batch in batches:
            for _, number, a, b, r, p, k in zip(*(c.to_pylist() for c in batch.columns)):
                if not a:
                    yield pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([x], pa.binary()) for x in (r, p, k))], names)
                    continue
                h1.append(np.frombuffer(a, np.uint64))
                h2.append(np.frombuffer(b, np.uint32))
                rows.append(np.frombuffer(r, "<u4"))
                places.append(np.frombuffer(p, "<u4"))
                source.append(np.full(len(rows[-1]), len(lines), np.uint32))
                lines.append((number, k))
        if not h1:
            return
        a, b, r, p, line = map(np.concatenate, (h1, h2, rows, places, source))
        del h1, h2, rows, places, source
        order = np.lexsort((b, a))
        a, b, r, p, line = a[order], b[order], r[order], p[order], line[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.cumsum(first) - 1
        repeated = (np.bincount(group)[group] > 1) & (p < 1 << 31)       # a witness's own places went along
        order = np.flatnonzero(repeated)
        order = order[np.argsort(line[order], kind="stable")]
        r, p, line = r[order], p[order], line[order]
        cuts = np.searchsorted(line, np.arange(len(lines) + 1))
        for (number, k), lo, hi in zip(lines, cuts[:-1], cuts[1:]):
            if hi > lo:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([r[lo:hi].tobytes()]), pa.array([p[lo:hi].tobytes()]), pa.array([k])], names)
    return run


def _gather_body(width: int):
    """Answers to some batches in; one line of ranges per row of a batch out."""
    def run(batches):
        answers: dict[int, list] = {}
        for batch in batches:
            for number, r, p, k in zip(*(c.to_pylist() for c in batch.columns)):
                answers.setdefault(number, []).append(
                    (np.frombuffer(k, np.int64).reshape(-1, 2)[np.frombuffer(r, "<u4")], np.frombuffer(p, "<u4")))
        while answers:
            _, parts = answers.popitem()
            keys, places = np.concatenate([k for k, _ in parts]), np.concatenate([p for _, p in parts]).astype(np.int64)
            order = np.lexsort((places, keys[:, 1], keys[:, 0]))
            keys, places = keys[order], places[order]
            at = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            ends = np.append(at[1:], len(places))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at, 0].copy()), pa.array(keys[at, 1].copy()),
                 pa.array([_ranges(places[a:b], width) for a, b in zip(at, ends)], pa.binary())], ["k1", "k2", "ranges"])
    return run


def _cut_body():
    def run(batches):
        for batch in batches:
            found = batch.column("found")
            for lo, hi, buf, offs in tx.chunks(batch.column("text")):
                start, end, per_row = tx.word_spans(buf, offs)
                first = np.concatenate([[0], np.cumsum(per_row)])
                cover = np.zeros(len(start) + 1, np.int64)
                for i in range(lo, hi):
                    for raw in found[i].as_py() or ():
                        at = np.frombuffer(raw, "<u4").astype(np.int64).reshape(-1, 2) + first[i - lo]
                        np.add.at(cover, at[:, 0], 1)
                        np.add.at(cover, at[:, 1], -1)
                gone = np.cumsum(cover[:-1]) > 0
                # a removed word goes with the space up to the next word or the text's end
                edge = np.zeros(len(buf) + 1, np.int64)
                row = tx.row_of(per_row)
                until = np.append(start[1:], len(buf))
                until = np.minimum(until, offs[1:][row]) if len(row) else until[:0]
                np.add.at(edge, start[gone], 1)
                np.add.at(edge, until[gone], -1)
                keep = np.cumsum(edge[:-1]) == 0
                total = np.concatenate([[0], np.cumsum(keep)])
                kept = buf[keep].tobytes()
                texts = [kept[a:b] for a, b in zip(total[offs[:-1]], total[offs[1:]])]
                removed = np.bincount(row[gone], minlength=hi - lo)
                null = batch.column("text").slice(lo, hi - lo).is_null().to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array([None if n else t.decode() for t, n in zip(texts, null)], pa.string()),
                     pa.array(per_row.astype(np.int64)), pa.array(removed.astype(np.int64))],
                    ["row", "text", "n_words", "n_removed"])
    return run


def remove_repeated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but text), text (what is
    kept, with its white space), n_words, n_removed: one row per row of ``docs``."""
    spark = docs.sparkSession
    text_batches(spark)
    others = [c for c in docs.columns if c != "text"]
    base = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))
    base = base.select("row", "text", F.xxhash64("row.doc_id", "text").alias("k1"),
                       F.xxhash64(F.lit("second"), "text", "row.doc_id").alias("k2"))
    sent = spark.sparkContext.broadcast(sketch(base, width))
    through = count(base, width, sent)
    buckets = shuffle_partitions(spark, through, PER_TASK)
    dealt = base.select("k1", "k2", "text").transform(map_arrow,
        _deal_body(width, buckets, sent), "bucket int, batch long, h1 binary, h2 binary, row binary, place binary, keys binary")
    answers = dealt.repartitionById(buckets, F.col("bucket")).transform(map_arrow, _meet_body(), "batch long, row binary, place binary, keys binary")
    ranges = answers.repartition(shuffle_partitions(spark, through, WINDOWS_HELD), "batch").transform(map_arrow, _gather_body(width), "k1 long, k2 long, ranges binary")
    found = ranges.groupBy("k1", "k2").agg(F.collect_list("ranges").alias("found"))
    joined = base.join(found, ["k1", "k2"], "left").select("row", "text", "found")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.transform(map_arrow, _cut_body(), f"row {kind}, text string, n_words long, n_removed long")
