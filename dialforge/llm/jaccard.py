"""Exact Jaccard join of documents on word shingles, as components.

A document's set holds the hashes of its distinct five-word shingles. Documents
with equal sets are one *node* from the start. Two sets with Jaccard >= t share
one of the smallest ``n - ceil(t n) + 1`` hashes of either, so:

1. every node posts those hashes, dealt out by hash; hashes that only one node
   posts vanish. Under a hash of at most ``SMALL_GROUP`` nodes, all are paired;
   pairs that share too few hashes to link (counted over all hashes) are
   dropped and the rest checked. Larger groups get a hub per size band.
2. in larger groups, each node is checked against the hubs of its few smallest shared hashes (a
   linear number of pairs); checked links are joined into components. This only
   saves work: it settles nearly all pairs of large groups of copies.
3. hashes whose nodes still lie in several components form tiles by size band.
   While it finds links, a round takes for each node the likeliest partner in
   every other component of its tiles, over its smallest hashes only.
4. a last round goes over all shared hashes and takes every two nodes of
   different components whose bitmaps allow the threshold. So no pair of a
   shared hash is left out unless its size, its bitmap or a known link settles it.

A check has two steps. The bitmap of a set (a parity bit per hashed value, at
least two bits for each member) differs in at most as many bits as the
symmetric difference has members, which bounds the overlap from above; what
passes is compared exactly by intersecting the sorted arrays of shingle hashes.
The members of one hub are dealt out in groups of ``HUB_GROUP``.

Cases: a text with fewer words than a shingle is one shingle of all its words;
empty and null texts have an empty set and are linked with nothing; repeated
rows and equal sets are linked; a null doc_id is a document of its own whose
component is the smallest doc_id it reaches (null if none); ties go to the
smaller id; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialforge.llm import text as tx
from dialforge.llm.components import connected
from dialforge.llm.store import map_arrow, shuffle_partitions, text_batches, written

WIDTH, PERCENT = 5, 75
POSTINGS = 1 << 19      # postings that a task gathers before it sends them
SMALL_GROUP = 12        # nodes under one hash that are paired at once
STAR_HASHES = 8         # a node meets the hubs of about so many of its smallest hashes
FIRSTS = 8              # smallest hashes of a node that its tiles know
HUB_GROUP = 256         # members checked against one copy of a hub
BLOCK = 256             # rows of a tile compared at once
FILTER_BITS = 26        # bits of the filter that keeps unneeded texts from the shuffle (8 MB)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a chunk."""
    buf = tx.lower_ascii(buf)
    start, end, per_row = tx.word_spans(buf, offs)
    h = tx.word_hashes(buf, start, end, tx.SEEDS[0])
    grams = tx.window_hashes(h, width, tx.SEEDS[1])
    out, at = [], 0
    for n in per_row:
        if n >= width:
            out.append(np.unique(grams[at:at + n - width + 1]))
        elif n:
            out.append(tx.window_hashes(h[at:at + n], int(n), tx.SEEDS[1]) ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def set_key(s: np.ndarray) -> int:
    """Order-free 64-bit key of a set, as a signed long."""
    total = np.add.reduce(tx.mix(s ^ np.uint64(tx.SEEDS[0])), dtype=np.uint64) if len(s) else np.uint64(0)
    return int(tx.mix(np.array([total + np.uint64(len(s))]))[0].view(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bits of a set in 64-bit words; the number of bits is the power of
    two that is at least twice the set's size (64 or more)."""
    bits = max(64, 2 << (len(s) - 1).bit_length()) if len(s) else 64
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """The same bitmaps (rows of 64-bit words) with only ``width`` words."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def may_link(size_a, size_b, differing, percent: int):
    """Whether sets of these sizes whose bitmaps differ in so many bits can link."""
    most = (size_a + size_b - differing) // 2
    return most * (100 + percent) >= percent * (size_a + size_b)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = overlap(a, b)
    return bool(len(a)) and 100 * both >= percent * (len(a) + len(b) - both)


# -- sets and postings ------------------------------------------------------

def _with_key(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and a key of the two."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), "text")


def _members_body(width: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            for lo, hi, buf, offs in tx.chunks(texts):
                sets = shingle_sets(buf, offs, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("doc_key").slice(lo, hi - lo),
                     pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([bitmap(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "doc_key", "ref", "n", "bits"])
    return run


def _postings_body(width: int, percent: int, buckets: int):
    def send(held):
        refs = np.fromiter(held, np.int64, len(held))
        sizes = np.array([n for n, _ in held.values()], np.uint32)
        tokens = np.concatenate([t for _, t in held.values()])
        owner = np.repeat(np.arange(len(held), dtype=np.uint32), [len(t) for _, t in held.values()])
        # posted hashes are small ones, so they are mixed before they are dealt out
        bucket = ((tx.mix(tokens) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets), "right")
        out, at = [], 0
        for b, to in enumerate(ends):
            if to > at:
                pick = order[at:to]
                who, local = np.unique(owner[pick], return_inverse=True)
                out.append((b, tokens[pick].tobytes(), local.astype("<u2" if len(who) < 1 << 16 else "<u4").tobytes(),
                            refs[who].tobytes(), sizes[who].tobytes()))
            at = to
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 4))],
            ["bucket", "tokens", "owner", "refs", "sizes"])

    def run(batches):
        held, count = {}, 0
        for batch in batches:
            for _, _, buf, offs in tx.chunks(batch.column("text")):
                for s in shingle_sets(buf, offs, width):
                    if len(s) and (ref := set_key(s)) not in held:
                        held[ref] = (len(s), s[:prefix_length(len(s), percent)].copy())
                        count += len(held[ref][1])
                if count >= POSTINGS:
                    yield send(held)
                    held, count = {}, 0
        if held:
            yield send(held)
    return run


def band(n: np.ndarray, percent: int) -> np.ndarray:
    """Size band: sets that can link lie in the same band or in neighbouring ones."""
    return np.floor(np.log(n) / math.log(100 / percent) + 1e-9).astype(np.int64)


def _shared_body(percent: int):
    """All postings of some hashes in; pairs under hashes of small groups and
    the postings of the others out."""
    def run(batches):
        tokens, refs, sizes = [], [], []
        for batch in batches:
            for t, o, r, n in zip(*(batch.column(c).to_pylist() for c in ("tokens", "owner", "refs", "sizes"))):
                t = np.frombuffer(t, np.uint64)
                o = np.frombuffer(o, "<u2" if len(o) == 2 * len(t) else "<u4")
                tokens.append(t)
                refs.append(np.frombuffer(r, np.int64)[o])
                sizes.append(np.frombuffer(n, np.uint32)[o])
        if not tokens:
            return
        token, ref, n = np.concatenate(tokens), np.concatenate(refs), np.concatenate(sizes)
        del tokens, refs, sizes
        order = np.argsort(token, kind="stable")
        same = token[order][1:] == token[order][:-1]
        keep = np.zeros(len(order), bool)
        keep[1:] |= same
        keep[:-1] |= same
        order = order[keep]
        token, ref, n = token[order], ref[order], n[order].astype(np.int64)
        order = np.lexsort((ref, n, token))
        token, ref, n = token[order], ref[order], n[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (ref[1:] != ref[:-1])
        token, ref, n = token[fresh], ref[fresh], n[fresh]
        # by size, a node without a near enough neighbour under its hash has no partner there
        near = (token[1:] == token[:-1]) & (n[:-1] * 100 >= n[1:] * percent)
        keep = np.zeros(len(token), bool)
        keep[1:] |= near
        keep[:-1] |= near
        token, ref, n = token[keep], ref[keep], n[keep]
        if not len(token):
            return
        first = np.ones(len(token), bool)
        first[1:] = token[1:] != token[:-1]
        many = np.diff(np.append(np.flatnonzero(first), len(token)))[np.cumsum(first) - 1] > SMALL_GROUP
        yield from _send_pairs(token[~many], ref[~many], n[~many], percent)
        token, ref, n = token[many], ref[many], n[many]
        if not len(token):
            return
        for lo in range(0, len(token), 1 << 18):
            cut = slice(lo, lo + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(token[cut]), pa.int64()), pa.array(token[cut].view(np.int64)),
                                              pa.array(ref[cut]), pa.array(n[cut])], _SHARED)
    return run


_SHARED = ["other", "token", "ref", "n"]


def _send_pairs(token: np.ndarray, ref: np.ndarray, n: np.ndarray, percent: int):
    """Pairs of the nodes under hashes of small groups, with the number of
    such hashes they share here (rows by token and size)."""
    pairs = []
    for step in range(1, SMALL_GROUP):
        ok = (token[step:] == token[:-step]) & (n[:-step] * 100 >= n[step:] * percent)
        x, y = ref[:-step][ok], ref[step:][ok]
        pairs.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
    pairs = np.concatenate(pairs)
    if len(pairs):
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        first = np.ones(len(pairs), bool)
        first[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
        at = np.flatnonzero(first)
        count = np.diff(np.append(at, len(pairs)))
        for lo in range(0, len(at), 1 << 18):
            cut = at[lo:lo + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[cut, 0].copy()), pa.nulls(len(cut), pa.int64()),
                                              pa.array(pairs[cut, 1].copy()), pa.array(count[lo:lo + (1 << 18)])], _SHARED)


# -- checks -----------------------------------------------------------------

def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sizes and bitmaps allow a link."""
    def run(batches):
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "bits_a", "bits_b"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                width = min(len(x), len(y))
                keep.append(may_link(na, nb, int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum()), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("ref").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    b = sets.select(F.col("ref").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    near = pairs.join(a, "a").join(b, "b").where(
        (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    return near.select("a", "b", "na", "nb", "bits_a", "bits_b").transform(map_arrow, run, "a long, b long")


def _filter_bits(keys: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` over hashed keys, made in parts of 64 KB."""
    low = FILTER_BITS - 19

    def run(batches):
        parts = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            for p, cell in zip((at >> np.uint64(19)).tolist(), (at & np.uint64((1 << 19) - 1)).tolist()):
                if p not in parts:
                    parts[p] = np.zeros(1 << 16, np.uint8)
                parts[p][cell >> 3] |= 1 << (cell & 7)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([*parts], pa.int32()),
                                              pa.array([x.tobytes() for x in parts.values()], pa.binary())], ["part", "bits"])

    dealt = keys.select(F.shiftrightunsigned(keys.columns[0], 64 - low).cast("int").alias("part"), keys.columns[0])
    rows = dealt.repartition("part").select(keys.columns[0]).transform(map_arrow, run, "part int, bits binary").collect()
    out = np.zeros((1 << low, 1 << 16), np.uint8)
    for r in rows:
        out[r["part"]] |= np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _texts(docs: DataFrame, sets: DataFrame, refs: DataFrame) -> DataFrame:
    """``ref, text`` of the wanted nodes. A fixed-size bitmap drops most other
    texts before the shuffle; what it lets through in error, the join drops."""
    wanted = written(sets.join(refs, "ref", "left_semi").select("doc_key", "ref"), "wanted")
    sent = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted.select("doc_key")))

    def run(batches):
        bits = sent.value
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            hit = bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    found = _with_key(docs).select("doc_key", "text").transform(map_arrow, run, "doc_key long, text string")
    return found.join(wanted, "doc_key").select("ref", "text")


def _checked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` (a is shared by many) that do link, as ``u, v``."""
    pairs = written(_bounded(pairs, sets, percent), "pairs")
    if pairs.isEmpty():
        return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    refs = pairs.select(F.col("a").alias("ref")).unionAll(pairs.select("b")).distinct()
    texts = _texts(docs, sets, refs)
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_GROUP).alias("groups"))
    dealt = pairs.join(groups, "a").select("a", F.expr("pmod(xxhash64(b), groups)").alias("part"), F.col("b").alias("ref"),
                                           F.lit(1).alias("member"))
    hubs = dealt.select("a", "part").distinct().select("a", "part", F.col("a").alias("ref"), F.lit(0).alias("member"))

    def run(batches):
        hub, hub_set = None, None
        for batch in batches:
            a, part, ref, member = (batch.column(c).to_pylist() for c in ("a", "part", "ref", "member"))
            links, row = [], 0
            for lo, hi, buf, offs in tx.chunks(batch.column("text")):
                for s in shingle_sets(buf, offs, width):
                    if set_key(s) == ref[row]:          # else two documents share a key
                        if member[row] == 0:
                            hub, hub_set = (a[row], part[row]), s
                        elif hub == (a[row], part[row]) and linked(hub_set, s, percent):
                            links.append((a[row], ref[row]))
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["u", "v"])

    placed = dealt.unionByName(hubs).join(texts, "ref").repartition("a", "part")
    return placed.sortWithinPartitions("a", "part", "member").select("a", "part", "ref", "member", "text").transform(map_arrow,
        run, "u long, v long")


# -- tiles ------------------------------------------------------------------

def _across_body(percent: int):
    """Of postings with components, those that have a possible partner in
    another component under the same hash."""
    def run(batches):
        cols = [[], [], [], []]
        for batch in batches:
            for c, x in zip(cols, batch.columns):
                c.append(x.to_numpy(zero_copy_only=False))
        if not cols[0]:
            return
        token, ref, n, comp = map(np.concatenate, cols)
        order = np.lexsort((comp, token))
        change = (token[order][1:] == token[order][:-1]) & (comp[order][1:] != comp[order][:-1])
        several = np.unique(token[order][1:][change])
        at = np.minimum(np.searchsorted(several, token), max(len(several) - 1, 0))
        keep = several[at] == token if len(several) else np.zeros(len(token), bool)
        for lo in range(0, int(keep.sum()), 1 << 18):
            cut = np.flatnonzero(keep)[lo:lo + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(x[cut]) for x in (token, ref, n, comp)], ["token", "ref", "n", "component"])
    return run


def tile_pairs(ref: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: list[np.ndarray], percent: int, best: bool = False,
               token: int = 0, firsts: np.ndarray | None = None):
    """Pairs of different components under one hash that sizes and bitmaps
    allow; rows in order of size. Bands of neighbouring sizes form a tile.
    ``best``: of the pairs of a row with a component only the likeliest in
    each block of the tile. ``firsts``: the smallest hashes of every row; a pair
    that shares one smaller than ``token`` is left to that hash's tile."""
    tiles = band(n, percent)
    for t in np.unique(tiles):
        own = np.flatnonzero(tiles == t)
        both = np.flatnonzero((tiles == t) | (tiles == t + 1))
        width = min(len(bits[i]) for i in own)
        table = np.stack([fold(bits[i], width) for i in both])
        for lo in range(0, len(own), BLOCK):
            rows = slice(lo, min(lo + BLOCK, len(own)))
            for at in range(lo, len(both), 8 * BLOCK):
                cols = slice(at, at + 8 * BLOCK)
                x, y = both[rows], both[cols]
                ok = (comp[x][:, None] != comp[y][None, :]) & (x[:, None] < y[None, :]) & sizes_allow(n[x], n[y], percent)
                if not ok.any():
                    continue
                differing = np.zeros((len(x), len(y)), np.int64)
                for w in range(width):
                    differing += np.bitwise_count(table[rows, w][:, None] ^ table[cols, w][None, :])
                ok &= may_link(n[x][:, None], n[y][None, :], differing, percent)
                i, j = np.nonzero(ok)
                if firsts is not None and len(i):
                    own_pair = np.ones(len(i), bool)
                    for f in range(firsts.shape[1]):
                        mine = firsts[x[i], f]
                        own_pair &= ~((mine < token) & (firsts[y[j]] == mine[:, None]).any(axis=1))
                    i, j = i[own_pair], j[own_pair]
                if best and len(i):
                    order = np.lexsort((differing[i, j], comp[y][j], i))
                    i, j = i[order], j[order]
                    first = np.ones(len(i), bool)
                    first[1:] = (i[1:] != i[:-1]) | (comp[y][j][1:] != comp[y][j][:-1])
                    i, j = i[first], j[first]
                yield from zip(ref[x[i]].tolist(), ref[y[j]].tolist())


def sizes_allow(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    small, large = np.minimum(a[:, None], b[None, :]), np.maximum(a[:, None], b[None, :])
    return small * 100 >= large * percent


def _tiles_body(percent: int, best: bool):
    def run(batches):
        rows: list = []
        seen: set = set()

        def close():
            ref, n, comp = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
            firsts = np.array([r[5] + [2 ** 63 - 1] * (FIRSTS - len(r[5])) for r in rows], np.int64)
            for a, b in tile_pairs(ref, n, comp, [np.frombuffer(r[4], np.uint64) for r in rows], percent, best, rows[0][0], firsts):
                seen.add((min(a, b), max(a, b)))

        def send():
            out = pa.RecordBatch.from_arrays([pa.array([p[i] for p in seen], pa.int64()) for i in (0, 1)], ["a", "b"])
            seen.clear()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and rows[0][0] != row[0]:
                    close()
                    rows = []
                    if len(seen) > 1 << 17:
                        yield send()
                rows.append(row)
        if rows:
            close()
            yield send()
    return run


def _stars(early: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (hub ``a``, node ``b``). The hub of a hash and size band is
    its node with the most widely shared hashes: among edited copies the text
    they come from, which most of them link with."""
    spread = large.groupBy("ref").agg(F.count("*").alias("spread"))
    tile = F.floor(F.log("n") / math.log(100 / percent) + 1e-9)
    rows = early.join(spread, "ref").select("token", "ref", "spread", tile.alias("tile"))
    hubs = rows.groupBy("token", "tile").agg(F.max_by("ref", F.struct("spread", "ref")).alias("a"))
    both = hubs.select("token", F.explode(F.array("tile", F.col("tile") - 1)).alias("tile"), "a")  # a band meets the next one's hub too
    return rows.join(both, ["token", "tile"]).where("a <> ref").select("a", F.col("ref").alias("b")).distinct()


def _sharing_enough(pairs: DataFrame, large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that may share enough posted hashes to link. Sets x, y that link
    have ``o`` or more values in common; of the posted hashes of the one whose
    largest is smaller, at most ``n - o`` are not in the other, and the rest are
    posted by both. Hashes of large groups are not counted by pair: a pair may
    share as many of them as either posts."""
    posted = large.groupBy("ref").agg(F.count("*").alias("uncounted"))
    side = sets.select("ref", "n").join(posted, "ref", "left").select("ref", "n", F.coalesce("uncounted", F.lit(0)).alias("uncounted"))
    both = pairs.join(side.toDF("a", "na", "ua"), "a").join(side.toDF("b", "nb", "ub"), "b")
    overlap_needed = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / F.lit(100 + percent) - 1e-9)
    needed = overlap_needed - F.ceil(F.greatest("na", "nb") * percent / 100 - 1e-9) + 1
    return both.where(F.col("common") + F.least("ua", "ub") >= needed).select("a", "b")


def _tile_candidates(postings: DataFrame, found: DataFrame, sets: DataFrame, buckets: int, percent: int, best: bool) -> DataFrame:
    """Distinct pairs ``a < b`` from the tiles of hashes shared across components."""
    labelled = postings.join(found.withColumnRenamed("node", "ref"), "ref", "left").select(
        "token", "ref", "n", F.coalesce("component", "ref").alias("component"))
    across = labelled.repartition(buckets, "token").transform(map_arrow,
        _across_body(percent), "token long, ref long, n long, component long")
    firsts = postings.groupBy("ref").agg(F.slice(F.array_sort(F.collect_list("token")), 1, FIRSTS).alias("firsts"))
    side = sets.select("ref", "bits").join(firsts, "ref")
    tiles = across.join(side, "ref").repartition(buckets, "token").sortWithinPartitions("token", "n", "ref")
    return tiles.select("token", "ref", "n", "component", "bits", "firsts").transform(map_arrow,
        _tiles_body(percent, best), "a long, b long").distinct()


# -- the operator -----------------------------------------------------------

def components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id`` (a whole number), n_shingles, component_id: one row per row of
    ``docs``; also ``doc_key`` (``document_key``) and ``group``, which names the
    component for documents without doc_id too."""
    spark = docs.sparkSession
    text_batches(spark)
    keyed = _with_key(docs)
    members = written(keyed.transform(map_arrow, _members_body(width), "doc_id long, doc_key long, ref long, n long, bits binary"),
                      "members")
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = shuffle_partitions(spark, total * (100 - percent) // 100)
    sets = written(members.where("ref is not null").groupBy("ref").agg(
        F.min("doc_key").alias("doc_key"), F.min("n").alias("n"), F.min("bits").alias("bits")), "sets")

    postings = keyed.select("text").transform(map_arrow,
        _postings_body(width, percent, buckets), "bucket int, tokens binary, owner binary, refs binary, sizes binary")
    shared = written(postings.repartition(buckets, "bucket").transform(map_arrow,
        _shared_body(percent), "other long, token long, ref long, n long"), "shared")

    large = shared.where("other is null").select("token", "ref", "n")
    unsigned = F.when(F.col("token") < 0, F.col("token") + F.lit(2.0 ** 64)).otherwise(F.col("token").cast("double"))
    early = written(large.where(unsigned * F.col("n") < STAR_HASHES * 2.0 ** 64), "early")
    stars = written(_stars(early, large, percent), "stars")
    small = shared.where("other is not null").groupBy(F.col("other").alias("a"), F.col("ref").alias("b")).agg(F.sum("n").alias("common"))
    small = _sharing_enough(small, large, sets, percent)
    first = written(stars.unionAll(small.join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
                                              ["a", "b"], "left_anti")), "first-pairs")
    checked = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = written(_checked(first, docs, sets, width, percent), "links")
    found = connected(links)

    # few smallest hashes while that finds links, then all of them once
    best = True
    while True:
        pairs = _tile_candidates(early if best else large, found, sets, buckets, percent, best)
        pairs = written(pairs.join(checked, ["a", "b"], "left_anti"), "tile-pairs")
        new = written(_checked(pairs, docs, sets, width, percent), "tile-links")
        if not new.isEmpty():
            found = connected(found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(new))
        elif best:
            best = False
            checked = checked.unionAll(pairs)
            continue
        if not best:
            break
        checked = checked.unionAll(pairs)

    joined = members.select("doc_id", "doc_key", "ref", "n").join(found.withColumnRenamed("node", "ref"), "ref", "left").select(
        "doc_id", "doc_key", "n", F.coalesce("component", "ref").alias("component"))
    least = joined.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return joined.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(
            F.col("least")).alias("component_id"), "doc_key", F.coalesce("component", "doc_key").alias("group"))


def document_key():
    return F.xxhash64("doc_id", F.col("text").cast("string"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, once;
    a component without doc_ids keeps one row."""
    found = components(docs, width, percent)
    keep = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key")).alias("k")).select(F.col("k.doc_key"))
    rows = docs.select(F.struct("*").alias("row"), document_key().alias("doc_key"))
    return rows.join(keep.distinct(), "doc_key", "left_semi").dropDuplicates(["doc_key"]).select("row.*")
