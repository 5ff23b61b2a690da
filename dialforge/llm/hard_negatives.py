"""Hard-negative mining with rotated one-bit codes and exact integer scores.

Vectors become whole numbers, ``floor(256 * x)``. A fixed rotation (random
signs and Walsh-Hadamard turns, twice) levels their coordinates, and the signs of
the rotated vector are its code. With the code as a unit vector ``c``, ``a`` its
inner product with the vector (the stored alignment) and ``r = v - a c``, an
anchor ``q`` has ``<q, v> = a <q, c> + <q, r>``. ``<q, c>`` comes from popcounts of
the code against the bit planes of ``q`` in ``PLANES`` bits, and by Cauchy and
Schwarz ``|<q, r>| <= |q| |r|``, with ``q`` less its part along ``c``; what the
planes leave out of ``q`` is bounded likewise. So every score has an interval that
holds it for certain. The residual has a code and an alignment of its own, and so
on for ``LEVELS`` levels: each narrows the interval of the rows that the level
before could not decide. Rows whose interval cannot reach the result are left
out; all others are scored as integers, so the result is exact.

Rows are dealt into blocks of at most about ``BLOCK_ROWS``; every anchor visits
every block. A task holds one block and streams the anchors through; the short
lists of the blocks merge in a window, which Spark cuts to the wanted length on
the map side. A first pass finds each anchor's positives; a second one, with their
scores, the negatives of each.

Cases: rows with a null id, label or vector, or a null, NaN or infinite component
take no part; an empty vector is a vector of zeros; a shorter vector counts as if
zeros followed; each row is a row of its own, copies included, and equal scores go
by id, then in an arbitrary order of the rows that share the id; no rows give no
rows; other columns are ignored. Vectors whose scores might not fit a long raise
an error before any is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialforge.llm.store import map_arrow, shuffle_partitions, written

SCALE = 256
LEVELS, PLANES = 3, 6
BLOCK_ROWS = 1 << 16
CODED = "rid long, vec_id long, label long, v binary, codes binary, sizes binary"


def rotated(x: np.ndarray, seed: int = 17) -> np.ndarray:
    """Rows of ``x`` (a power of two columns) turned by one fixed orthonormal map."""
    rng = np.random.default_rng([seed, x.shape[1]])
    for _ in range(2):
        x = x * (rng.integers(0, 2, x.shape[1]) * 2 - 1)
        half = 1
        while half < x.shape[1]:
            pairs = x.reshape(len(x), -1, 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), -1)
            half *= 2
        x = x / x.shape[1] ** 0.5
    return x


def width_of(dim: int) -> int:
    """Columns of a rotated vector: a power of two, whole words of bits."""
    return max(64, 1 << max(dim - 1, 0).bit_length())


def _padded(v: np.ndarray, width: int) -> np.ndarray:
    return np.pad(v.astype(np.float64), ((0, 0), (0, width - v.shape[1])))


def encode(v: np.ndarray, width: int, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """``codes`` (row, level, word) and ``sizes``: the row's length, then the
    alignment and the length of the residual of each level."""
    rest = rotated(_padded(v, width))
    codes = np.empty((len(v), levels, width // 64), np.uint64)
    sizes = np.empty((len(v), 1 + 2 * levels))
    sizes[:, 0] = np.sqrt((rest * rest).sum(axis=1))
    for k in range(levels):
        up = rest >= 0
        codes[:, k] = np.packbits(up, axis=1, bitorder="little").view("<u8")
        along = np.abs(rest).sum(axis=1) / width ** 0.5
        rest = rest - np.where(up, 1.0, -1.0) * (along / width ** 0.5)[:, None]
        sizes[:, 1 + 2 * k] = along
        sizes[:, 2 + 2 * k] = np.sqrt((rest * rest).sum(axis=1))
    return codes, sizes


class Anchor:
    """A query: its bit planes, and what they leave out."""

    def __init__(self, v: np.ndarray, width: int):
        self.v = v
        turned = rotated(_padded(v[None, :], width))[0]
        self.low = float(turned.min())
        self.step = max((float(turned.max()) - self.low) / ((1 << PLANES) - 1), 1e-300)
        whole = np.clip(np.rint((turned - self.low) / self.step), 0, (1 << PLANES) - 1).astype(np.int64)
        near = self.low + self.step * whole
        self.sum, self.size2 = float(near.sum()), float((near * near).sum())
        self.left = float(np.sqrt(((turned - near) ** 2).sum()))
        self.width = width
        self.planes = [np.packbits((whole >> b & 1).astype(bool), bitorder="little").view("<u8") for b in range(PLANES)]

    def along(self, code: np.ndarray) -> np.ndarray:
        """Inner products with the unit vectors of ``code`` (row, word), by popcount."""
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        whole = np.zeros(len(code), np.int64)
        for b, plane in enumerate(self.planes):
            whole += np.bitwise_count(code & plane).sum(axis=1, dtype=np.int64) << b
        return (2 * (self.low * ones + self.step * whole) - self.sum) / self.width ** 0.5

    def exact(self, v: np.ndarray) -> np.ndarray:
        return v @ self.v


class Block:
    """The rows of a block, by label."""

    def __init__(self, rid, vec_id, label, v, codes, sizes):
        order = np.argsort(label, kind="stable")
        self.rid, self.vec_id, self.label = rid[order], vec_id[order], label[order]
        self.v, self.codes, self.sizes = v[order], codes[order], sizes[order]

    def bounds(self, q: Anchor, rows: np.ndarray, level: int, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of each row after ``level`` more; ``sure`` is the sum of the levels before."""
        y = q.along(self.codes[rows, level])
        sizes = self.sizes[rows]
        sure = sure + sizes[:, 1 + 2 * level] * y
        half = np.sqrt(np.maximum(q.size2 - y * y, 0)) * sizes[:, 2 + 2 * level] + q.left * sizes[:, 0]
        half += 1e-9 * (q.size2 ** 0.5 + q.left) * sizes[:, 0] + 1e-6      # rounding of the sums above
        return sure - half, sure + half, sure

    def survivors(self, q: Anchor, rows: np.ndarray, bands: list[tuple[float, float]], keep: int) -> np.ndarray:
        """Rows whose interval says they may be among the ``keep`` best of some
        band ``(least, most)`` of scores."""
        sure = np.zeros(len(rows))
        for level in range(self.codes.shape[1]):
            if len(rows) <= keep:
                break
            low, high, sure = self.bounds(q, rows, level, sure)
            may = np.zeros(len(rows), bool)
            for least, most in bands:
                inside = low[(low >= least) & (high <= most)]
                floor = max(least, float(np.partition(inside, len(inside) - keep)[len(inside) - keep])) if len(inside) >= keep else least
                may |= (high >= floor) & (low <= most)
            rows, sure = rows[may], sure[may]
        return rows

    def best(self, rows: np.ndarray, score: np.ndarray, keep: int) -> np.ndarray:
        """Places of the first ``keep`` by score, id and row."""
        if len(rows) > keep:
            cut = np.partition(score, len(score) - keep)[len(score) - keep]
            at = np.flatnonzero(score >= cut)
        else:
            at = np.arange(len(rows))
        return at[np.lexsort((self.rid[rows[at]], self.vec_id[rows[at]], -score[at]))[:keep]]

    def positives(self, q: Anchor, rid: int, label: int, keep: int):
        lo, hi = np.searchsorted(self.label, [label, label + 1])
        rows = np.arange(lo, hi)
        rows = self.survivors(q, rows[self.rid[lo:hi] != rid], [(-np.inf, np.inf)], keep)
        score = q.exact(self.v[rows])
        at = self.best(rows, score, keep)
        return rows[at], score[at]

    def negatives(self, q: Anchor, label: int, scores: list[int], least: int, most: int, keep: int):
        """Per score of a positive: rows of another label within ``least`` and
        ``most`` per cent of it."""
        lo, hi = np.searchsorted(self.label, [label, label + 1])
        rows = np.concatenate([np.arange(lo), np.arange(hi, len(self.label))])
        bands = [(least * s / 100, most * s / 100) for s in scores if least * s <= most * s]
        if not bands:
            return []
        rows = self.survivors(q, rows, [(a - 1e-3, b + 1e-3) for a, b in bands], keep)
        score = q.exact(self.v[rows])
        out = []
        for i, s in enumerate(scores):
            ok = np.flatnonzero((least * s <= 100 * score) & (100 * score <= most * s))
            at = ok[self.best(rows[ok], score[ok], keep)]
            out.append((i, rows[at], score[at]))
        return out


def _table(batch: pa.RecordBatch, dim: int, width: int):
    n = batch.num_rows
    rid, vec_id, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "vec_id", "label"))
    raw = [b"".join(batch.column(c).to_pylist()) for c in ("v", "codes", "sizes")]
    return (rid, vec_id, label, np.frombuffer(raw[0], "<i8").reshape(n, dim),
            np.frombuffer(raw[1], "<u8").reshape(n, -1, width // 64), np.frombuffer(raw[2], "<f8").reshape(n, -1))


def _visit_body(dim: int, width: int, visit):
    """Rows of a block (kind 0), then its anchors (kind 1)."""
    names = ["anchor", "place", "score", "vec_id", "rid"]

    def run(batches):
        held, block, at = [], None, None
        out: list[tuple] = []

        def send():
            columns = [np.concatenate([np.full(len(o[3]), o[i]) if i < 2 else o[i] for o in out]) for i in range(5)]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

        for batch in batches:
            blocks, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind"))
            edge = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for lo, hi in zip([0, *edge], [*edge, len(blocks)]):
                if blocks[lo] != at:
                    held, block, at = [], None, blocks[lo]
                part = batch.slice(lo, hi - lo)
                rows = _table(part, dim, width)
                if kinds[lo] == 0:
                    held.append(rows)
                    continue
                if block is None and held:
                    block = Block(*(np.concatenate([h[i] for h in held]) for i in range(6)))
                    held = []
                if block is None:
                    continue
                wanted = part.column("scores").to_pylist()
                for i in range(hi - lo):
                    q = Anchor(rows[3][i], width)
                    for place, found, score in visit(block, q, int(rows[0][i]), int(rows[2][i]), wanted[i]):
                        if len(found):
                            out.append((rows[0][i], place, score, block.vec_id[found], block.rid[found]))
                    if len(out) > 4096:
                        yield send()
                        out = []
        if out:
            yield send()
    return run


def coded_rows(table: DataFrame, id_col: str, vector_col: str, label) -> tuple[DataFrame, int, int]:
    """The rows that take part, as integers with their codes, written; the
    longest vector and the number of rows."""
    x = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    rows = rows.where("vec_id is not null and label is not null and x is not null")
    rows = rows.where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    # an id of every row, fixed by writing it
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "vector-rows")
    dim, n, peak = rows.agg(F.max(F.size("x")), F.count("*"), F.max(F.array_max(F.transform("x", F.abs)))).first()
    dim = max(dim or 0, 1)
    if (SCALE * (peak or 0.0) + 1) ** 2 * dim * 100 >= 2.0 ** 63:
        raise ValueError("scores of these vectors may not fit a long")
    width = width_of(dim)

    def body(batches):
        for batch in batches:
            column = batch.column("x")
            sizes = np.diff(column.offsets.to_numpy())
            v = np.zeros((batch.num_rows, dim), np.int64)
            flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
            v[np.arange(dim)[None, :] < sizes[:, None]] = flat
            codes, sized = encode(v, width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("vec_id"), batch.column("label"),
                 *(pa.array([r.tobytes() for r in a], pa.binary()) for a in (v, codes, sized))],
                ["rid", "vec_id", "label", "v", "codes", "sizes"])

    return written(rows.select("rid", "vec_id", "label", "x").transform(map_arrow, body, CODED), "vector-codes"), dim, n


def mine(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label=None, every: int = 100,
         positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: anchors are the rows whose id is divisible by ``every``;
    their positives are the ``positives`` best other rows of the same ``label``
    (a column, by default ``label``), and each has the ``negatives`` best rows of
    other labels that score ``least`` to ``most`` per cent of it."""
    spark = table.sparkSession
    rows, dim, n = coded_rows(table, id_col, vector_col, F.col("label") if label is None else label)
    width = width_of(dim)
    blocks = max(shuffle_partitions(spark), -(-n // BLOCK_ROWS))
    blocks = max(min(blocks, -(-n // 1024)), 1)       # a block is worth visiting
    anchors = rows.where(F.col("vec_id") % every == 0)

    def visited(asked: DataFrame, visit) -> DataFrame:
        dealt = rows.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"),
                            *rows.columns, F.lit(None).cast("array<bigint>").alias("scores"))
        asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                             *rows.columns, "scores")
        both = dealt.unionByName(asked).repartitionById(blocks, "block").sortWithinPartitions("block", "kind")
        return both.transform(map_arrow, _visit_body(dim, width, visit), "anchor long, place long, score long, vec_id long, rid long")

    def find_positives(block, q, rid, label, _):
        return [(0, *block.positives(q, rid, label, positives))]

    def find_negatives(block, q, rid, label, scores):
        return block.negatives(q, label, scores, least, most, negatives)

    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "rid")
    near = visited(anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), find_positives)
    near = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives)
    near = written(near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")), "positives")
    asked = anchors.join(near.select(F.col("anchor").alias("rid"), F.col("near.score").alias("scores")), "rid")

    best = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "rid")
    far = visited(asked, find_negatives).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    ids = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pair = near.select("anchor", F.posexplode("near").alias("place", "x")).select(
        "anchor", F.col("place").cast("long").alias("place"), F.col("x.vec_id").alias("positive_id"), F.col("x.score").alias("positive_score"))
    return far.join(pair, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
