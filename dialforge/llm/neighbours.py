"""Approximate nearest neighbours by inner product on shifted Hilbert curves.

Equal vectors become one. Each of ``ORDERS`` orderings projects the vectors to
``DIMS`` random directions, shifts them, and sorts them along a Hilbert curve;
quantiles of the keys cut an ordering into tiles. (Lengths are levelled by one
more coordinate, so that close on the curve means a large inner product.) A
query is compared with the tiles within ``reach`` of its own, in every ordering:
runs of tiles with their margins are dealt out, a task holds the run's queries
and streams its vectors through. The lists of the orderings merge, and scores
are exact inner products in double precision.

``reach`` is fitted: ``SAMPLE`` queries (lowest hashes of id) are compared with
all vectors, and it becomes the smallest that finds ``TARGET`` of their
neighbours. Clustered vectors get a short reach; vectors without structure need
a large part of every ordering. Every vector is indexed.

Cases: vectors that are null, zero, hold null or non-finite components, or have
another length than most take no part, as query or candidate; a null id takes
no part; ids repeated with one vector count once; ties go to the smaller id;
with fewer candidates than ``k`` all are returned; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialforge.llm.store import map_arrow, shuffle_partitions, written

ORDERS, DIMS, BITS = 6, 6, 10
TILE = 256              # vectors of a tile, on average
MAX_TILES = 4096
SAMPLE, TARGET = 128, 0.97
BLOCK = 1024


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of whole-number points (rows), below
    ``2 ** (bits * columns)``: undo the turns of each cell from the coarsest
    level down, make the Gray code plain, and interleave the bits."""
    x = points.astype(np.int64).T.copy()
    m = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(m):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(turned, below, swap)
            x[i] ^= swap
    for i in range(1, m):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[m - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(m):
            key = key << 1 | (x[i] >> level & 1)
    return key


@dataclass
class Curves:
    """Directions and shifts of the orderings; later the tiles' bounds."""
    directions: np.ndarray       # order, coordinate, direction
    shifts: np.ndarray           # order, direction
    longest: float
    spread: float
    bounds: list[np.ndarray] | None = None
    reach: int = 0

    @classmethod
    def random(cls, dim: int, longest: float, spread: float, seed: int = 5) -> "Curves":
        rng = np.random.default_rng(seed)
        turn = [np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0][:, :min(DIMS, dim + 1)] for _ in range(ORDERS)]
        return cls(np.stack(turn), rng.random((ORDERS, turn[0].shape[1])), longest, spread)

    def keys(self, v: np.ndarray, query: bool) -> np.ndarray:
        """(order, vector) keys."""
        size = np.linalg.norm(v, axis=1)
        if query:
            v, last = v * (self.longest / size)[:, None], np.zeros(len(v))
        else:
            last = np.sqrt(np.maximum(self.longest ** 2 - size ** 2, 0))
        full = np.column_stack([v, last])
        out = []
        for turn, shift in zip(self.directions, self.shifts):
            at = (full @ turn) / (4 * self.spread) * 0.25 + 0.25 + shift * 0.5
            cells = np.clip((at * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            out.append(hilbert(cells, BITS))
        return np.stack(out)

    def tiles(self, keys: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, k, "left") for b, k in zip(self.bounds, keys)])


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a binary column (doubles)."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def distinct_vectors(table: DataFrame, id_col: str, vector_col: str, every: int, k: int) -> DataFrame:
    """``vid`` (least id), ``v`` (little-endian doubles), ``ids`` (the k + 1
    least), ``asked`` (a query has it) of every distinct vector."""
    v = F.col(vector_col).cast("array<double>")
    ok = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    ok = ok.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = ok.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    ok = ok.where(F.size("v") == (sizes["n"] if sizes else 0))

    def rows(batches):
        held: dict[bytes, tuple[list, bool]] = {}

        def send():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array([h[0] for h in held.values()], pa.list_(pa.int64())),
                 pa.array([h[1] for h in held.values()], pa.bool_())], ["v", "ids", "asked"])

        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (np.array(x, "<f8") + 0.0).tobytes()
                ids, asked = held.get(raw, ([], False))
                held[raw] = (sorted({*ids, i})[:k + 1], asked or i % every == 0)
            if len(held) > 1 << 15:
                yield send()
                held.clear()
        if held:
            yield send()

    parts = ok.transform(map_arrow, rows, "v binary, ids array<bigint>, asked boolean")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    return parts.groupBy("v").agg(ids.alias("ids"), F.max("asked").alias("asked")).select(F.col("ids")[0].alias("vid"), "v", "ids", "asked")


def _best(who: np.ndarray, score: np.ndarray, vid: np.ndarray, keep: int) -> np.ndarray:
    """Numbers of each query's best entries, nearest first, ties by id."""
    order = np.lexsort((vid, -score, who))
    w = who[order]
    start = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
    place = np.arange(len(w)) - np.repeat(start, np.diff(np.append(start, len(w))))
    return order[place < keep]


class Search:
    """Running lists of the best vectors of a set of queries."""

    def __init__(self, q: np.ndarray, keep: int):
        self.q, self.keep = q, keep
        self.floor = np.full(len(q), -np.inf)
        self.who, self.vid, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, v: np.ndarray, vid: np.ndarray, allowed=None) -> None:
        for lo in range(0, len(v), BLOCK):
            part = slice(lo, lo + BLOCK)
            rough = self.q @ v[part].T
            near = rough >= (self.floor - 1e-9 * (1 + np.abs(self.floor)))[:, None] if len(self.who) else np.ones(rough.shape, bool)
            if allowed is not None:
                near &= allowed(part)
            i, j = np.nonzero(near)
            if not len(i):
                continue
            if len(i) > 4 * self.keep * len(self.q):      # the first blocks: only the best of them matter
                rough = np.where(near, rough, -np.inf)
                cut = min(self.keep, rough.shape[1]) - 1
                least = -np.partition(-rough, cut, axis=1)[:, cut]
                least = np.where(np.isfinite(least), least, -np.inf)
                i, j = np.nonzero(near & (rough >= (least - 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0))))[:, None]))
            exact = (self.q[i] * v[part][j]).sum(axis=1)     # the same sum wherever the pair is met
            who = np.concatenate([self.who, i])
            ids, score = np.concatenate([self.vid, vid[part][j]]), np.concatenate([self.score, exact])
            best = _best(who, score, ids, self.keep)
            self.who, self.vid, self.score = who[best], ids[best], score[best]
            last = np.bincount(self.who, minlength=len(self.q)) >= self.keep
            ends = np.cumsum(np.bincount(self.who, minlength=len(self.q))) - 1
            self.floor = np.where(last, self.score[np.maximum(ends, 0)] if len(self.score) else -np.inf, -np.inf)


def _fit(vectors: DataFrame, curves: Curves, tiles: int, k: int) -> int:
    """The reach that finds ``TARGET`` of the neighbours of some queries."""
    sample = vectors.where("asked").orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE).select("vid", "v").collect()
    if not sample:
        return 0
    q = np.stack([np.frombuffer(r["v"], "<f8") for r in sample])
    own = np.array([r["vid"] for r in sample])

    def rows(batches):
        s, kept = Search(q, k + 1), {}
        for batch in batches:
            v, vid = _matrix(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            s.add(v, vid)
            listed = set(s.vid.tolist())
            kept = {i: x for i, x in [*kept.items(), *zip(vid.tolist(), v)] if i in listed}
        if len(s.who):
            yield pa.RecordBatch.from_arrays([pa.array(s.who), pa.array(s.vid), pa.array(s.score),
                                              pa.array([kept[i].tobytes() for i in s.vid.tolist()])], ["who", "vid", "score", "v"])

    found = vectors.select("vid", "v").transform(map_arrow, rows, "who long, vid long, score double, v binary")
    best = Window.partitionBy("who").orderBy(F.desc("score"), "vid")
    near = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).collect()    # at most SAMPLE * (k + 1)
    near = [r for r in near if r["vid"] != own[r["who"]]]
    if not near:
        return 0
    at = curves.tiles(curves.keys(q, True))[:, [r["who"] for r in near]]
    there = curves.tiles(curves.keys(np.stack([np.frombuffer(r["v"], "<f8") for r in near]), False))
    apart = np.sort(np.abs(at - there).min(axis=0))
    return int(min(apart[min(int(np.ceil(TARGET * len(apart))), len(apart)) - 1] + 1, tiles))


def _place_body(curves: Curves, run_tiles: int):
    """Vectors to every run whose margins hold them, queries to their own run."""
    names = ["ordering", "run", "kind", "tile", "vid", "v"]

    def run(batches):
        for batch in batches:
            v, vid = _matrix(batch.column("v")), batch.column("vid").to_numpy(zero_copy_only=False)
            asked = batch.column("asked").to_numpy(zero_copy_only=False).astype(bool)
            tiles = curves.tiles(curves.keys(v, False))
            own = curves.tiles(curves.keys(v, True))
            for o in range(len(tiles)):
                sent = [(np.flatnonzero(asked), own[o][asked] // run_tiles, 0, own[o][asked])]
                first, last = (tiles[o] - curves.reach) // run_tiles, (tiles[o] + curves.reach) // run_tiles
                for step in range(int((last - first).max()) + 1 if len(first) else 0):
                    ok = np.flatnonzero((first + step <= last) & (first + step >= 0))
                    sent.append((ok, first[ok] + step, 1, tiles[o][ok]))
                for rows, runs, kind, tile in sent:
                    for lo in range(0, len(rows), 4096):
                        cut = slice(lo, lo + 4096)
                        n = len(rows[cut])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, o, np.int32)), pa.array(runs[cut].astype(np.int32)), pa.array(np.full(n, kind, np.int32)),
                             pa.array(tile[cut].astype(np.int32)), pa.array(vid[rows[cut]]),
                             batch.column("v").take(pa.array(rows[cut]))], names)
    return run


def _search_body(reach: int, keep: int):
    def run(batches):
        held, state, tile = [], None, None

        def send():
            if state is None or not len(state[1].who):
                return []
            ids, s = state
            return [pa.RecordBatch.from_arrays([pa.array(ids[s.who]), pa.array(s.vid), pa.array(s.score)], ["query", "vid", "score"])]

        group = None
        for batch in batches:
            o, r, kind, t, vid = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            v = _matrix(batch.column(5))
            edge = np.flatnonzero((o[1:] != o[:-1]) | (r[1:] != r[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *edge], [*edge, len(o)]):
                if (o[lo], r[lo]) != group:
                    yield from send()
                    group, held, state = (o[lo], r[lo]), [], None
                if kind[lo] == 0:
                    held.append((vid[lo:hi], t[lo:hi], v[lo:hi]))
                    continue
                if held and state is None:
                    ids, tile, q = (np.concatenate([h[i] for h in held]) for i in range(3))
                    state = ids, Search(q, keep)
                if state is not None:
                    there = t[lo:hi]
                    state[1].add(v[lo:hi], vid[lo:hi], lambda part: np.abs(tile[:, None] - there[part][None, :]) <= reach)
        yield from send()
    return run


def nearest(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose
    id is divisible by ``every``."""
    spark = table.sparkSession
    vectors = written(distinct_vectors(table, id_col, vector_col, every, k), "vectors")
    n, dim = vectors.agg(F.count("*"), F.max(F.octet_length("v"))).first()
    kinds = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], kinds)

    def sizes(batches):
        for batch in batches:
            size = (_matrix(batch.column(0)) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([float(size.max())]), pa.array([float(size.sum())])], ["most", "total"])

    most, total = vectors.select("v").transform(map_arrow, sizes, "most double, total double").agg(F.max("most"), F.sum("total")).first()
    curves = Curves.random(dim // 8, most ** 0.5, max((total / n / (dim // 8)) ** 0.5, most ** 0.5 * 1e-6))
    tiles = int(min(max(n // TILE, 1), MAX_TILES))

    def keys(batches):
        for batch in batches:
            for o, key in enumerate(curves.keys(_matrix(batch.column(0)), False)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), o, np.int32)), pa.array(key)], ["ordering", "key"])

    cuts = vectors.select("v").transform(map_arrow, keys, "ordering int, key long").groupBy("ordering").agg(
        F.percentile_approx("key", [i / tiles for i in range(1, tiles)] or [0.5], 10 * MAX_TILES).alias("cuts")).collect()
    curves.bounds = [np.array(sorted(r["cuts"]), np.int64) for r in sorted(cuts, key=lambda r: r["ordering"])]
    curves.reach = _fit(vectors, curves, tiles, k)
    run_tiles = max(2 * curves.reach, 8)

    placed = vectors.select("vid", "v", "asked").transform(map_arrow,
        _place_body(curves, run_tiles), "ordering int, run int, kind int, tile int, vid long, v binary")
    placed = placed.repartition(shuffle_partitions(spark), "ordering", "run").sortWithinPartitions("ordering", "run", "kind")
    found = placed.transform(map_arrow, _search_body(curves.reach, k + 1), "query long, vid long, score double").distinct()
    # the best of all orderings, then the ids behind each vector, then each query without itself
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ids = found.join(vectors.select("vid", "ids"), "vid").select("query", "score", F.explode("ids").alias("id"))
    ids = ids.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("near"))
    asked = table.where(F.col(id_col).cast("long") % every == 0).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("x")).distinct()

    def raw(batches):
        for batch in batches:
            xs = batch.column(1).to_pylist()
            good = [x is not None and all(y is not None for y in x) for x in xs]
            keep = [(q, (np.array(x, "<f8") + 0.0).tobytes()) for q, x, g in zip(batch.column(0).to_pylist(), xs, good) if g]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in keep], pa.int64()), pa.array([b for _, b in keep], pa.binary())],
                                             ["query_id", "v"])

    asked = asked.transform(map_arrow, raw, "query_id long, v binary").join(vectors.where("asked").select("v", F.col("vid").alias("query")), "v")
    near = asked.join(ids, "query").select(
        "query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k).alias("near"))
    return near.select("query_id", F.posexplode("near").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
