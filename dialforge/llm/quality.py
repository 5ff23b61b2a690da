"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

A text is a sparse vector: one entry per hashed word (root of its count, the
words' part scaled to length 1), standardised structure statistics, and one
entry per bucketed metadata value. The score is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

through a logistic link: linear in the entries of a text, whatever the rank.

The machine is fitted on the driver on a bounded sample (``PER_CLASS`` labelled
rows of each class, lowest hash of doc_id first, weighted back to the classes'
true shares); every text is scored where it lies, without a shuffle.

Cases: a null text is empty, an empty text is scored from its statistics;
repeated rows are scored alike; a doc_id with contradicting or null labels does
not train; without labelled rows every score is 0.5, with one class only it is
that class's smoothed share; labels of unknown documents are ignored; other
columns are ignored unless named in ``metadata``; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialforge.llm import text as tx
from dialforge.llm.store import map_arrow, text_batches

WORD_BITS = 16
META_BITS = 10
RANK = 8
PER_CLASS = 3000      # bound of the training sample, per class
EPOCHS = 8            # at least; a small sample is gone over until STEPS are done
STEPS = 400
BATCH = 128
STATS = ("upper", "lower", "digit", "space", "newline", "stop", "mark", "other",
         "mean_word", "distinct_words", "top_word", "repeated_lines", "log_words", "long_words", "stutter")
N_WORD, N_META = 1 << WORD_BITS, 1 << META_BITS
N_FEATURES = N_WORD + N_META + len(STATS)

# byte classes: 0 upper, 1 lower, 2 digit, 3 space, 4 newline, 5 sentence mark, 6 other mark, 7 above ASCII
_CLASS = np.full(256, 7, np.uint8)
_CLASS[:128] = 6
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 4
_CLASS[[33, 39, 44, 45, 46, 58, 59, 63]] = 5


@dataclass
class Sparse:
    """Rows of (feature, value); ``ends`` closes each row."""
    feature: np.ndarray
    value: np.ndarray
    ends: np.ndarray

    def rows(self, which: np.ndarray) -> "Sparse":
        first = np.concatenate([[0], self.ends[:-1]])
        size = (self.ends - first)[which]
        ends = np.cumsum(size)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[which] - (ends - size), size)
        return Sparse(self.feature[take], self.value[take], ends)


def word_and_stat_rows(buf: np.ndarray, offs: np.ndarray) -> tuple[Sparse, np.ndarray]:
    """Word entries and raw statistics of a chunk of texts."""
    n = len(offs) - 1
    start, end, per_row = tx.word_spans(buf, offs)
    full = tx.word_hashes(buf, start, end, tx.SEEDS[0])
    h = full >> np.uint64(64 - WORD_BITS)
    row = tx.row_of(per_row)
    again = (full[1:] == full[:-1]) & (row[1:] == row[:-1])
    stutter = np.bincount(row[1:][again], minlength=n)
    key, count = np.unique(row.astype(np.int64) << WORD_BITS | h.astype(np.int64), return_counts=True)
    owner = key >> WORD_BITS
    ends = np.searchsorted(owner, np.arange(n), "right")
    value = np.sqrt(count)
    value = value / np.sqrt(np.maximum(per_row, 1))[owner]          # squares of roots sum to the words
    kinds = _CLASS[buf]
    shares = np.zeros((n, 8))
    for c in range(8):
        total = np.concatenate([[0], np.cumsum(kinds == c)])
        shares[:, c] = total[offs[1:]] - total[offs[:-1]]
    shares /= np.maximum(np.diff(offs), 1)[:, None]
    size = end - start
    letters = np.bincount(row, size, n) if len(row) else np.zeros(n)
    long = np.bincount(row, size > 24, n) if len(row) else np.zeros(n)
    words = np.maximum(per_row, 1)
    top = np.zeros(n)
    np.maximum.at(top, owner, count)
    distinct = np.diff(np.concatenate([[0], ends]))
    raw = buf.tobytes()
    repeated = np.zeros(n)
    for i in range(n):
        lines = [x for x in raw[offs[i]:offs[i + 1]].split(b"\n") if x]
        repeated[i] = 1 - len(set(lines)) / len(lines) if lines else 0
    stats = np.column_stack([shares, letters / words, distinct / words, top / words, repeated,
                             np.log1p(per_row), long / words, stutter / words])
    return Sparse((key & (N_WORD - 1)).astype(np.int32), value.astype(np.float32), ends), stats.astype(np.float32)


def meta_features(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """One hashed feature per metadata column and row; numbers by magnitude."""
    out = np.zeros((batch.num_rows, len(names)), np.int32)
    for j, name in enumerate(names):
        for i, v in enumerate(batch.column(j + 2).to_pylist()):
            said = "null" if v is None else f"2^{int(np.log2(v + 1))}" if isinstance(v, (int, float)) and 0 <= v < 1e300 else str(v)
            raw = np.frombuffer(f"{name}={said}".encode(), np.uint8)
            h = tx.word_hashes(raw, np.array([0]), np.array([len(raw)]), tx.SEEDS[1])
            out[i, j] = N_WORD + int(h[0] >> np.uint64(64 - META_BITS))
    return out


def assemble(words: Sparse, meta: np.ndarray, stats: np.ndarray) -> Sparse:
    """Words, metadata and standardised statistics in one row each."""
    n, m, s = len(words.ends), meta.shape[1], stats.shape[1]
    first = np.concatenate([[0], words.ends[:-1]])
    size = words.ends - first
    ends = np.cumsum(size + m + s)
    feature = np.zeros(ends[-1] if n else 0, np.int32)
    value = np.zeros(len(feature), np.float32)
    at = np.arange(len(words.feature)) + np.repeat(ends - size - m - s - first, size)
    feature[at], value[at] = words.feature, words.value
    for j in range(m):
        feature[ends - m - s + j], value[ends - m - s + j] = meta[:, j], 0.3
    for j in range(s):
        feature[ends - s + j], value[ends - s + j] = N_WORD + N_META + j, stats[:, j]
    return Sparse(feature, value, ends)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def standardise(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4) * 0.5

    def margins(self, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """Margins, and the factor sums of every row (for the gradient)."""
        if not len(x.ends):
            return np.zeros(0), np.zeros((0, RANK))
        first = np.concatenate([[0], x.ends[:-1]])           # no row is empty: it has statistics
        vx = self.factor[x.feature] * x.value[:, None]
        sums = np.add.reduceat(vx, first, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), first)
        linear = np.add.reduceat(self.weight[x.feature] * x.value, first)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def scores(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x)[0], -30, 30)))


def fit(words: Sparse, meta: np.ndarray, stats: np.ndarray, label: np.ndarray, share: float, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; ``share`` is the true share of label 1."""
    rng = np.random.default_rng(seed)
    mean, scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(N_FEATURES, np.float32),
                rng.normal(0, 0.02, (N_FEATURES, RANK)).astype(np.float32), mean, scale)
    x = assemble(words, meta, m.standardise(stats))
    row_weight = np.where(label == 1, share / max(label.mean(), 1e-9), (1 - share) / max(1 - label.mean(), 1e-9))
    seen_w = np.full(N_FEATURES, 1e-2, np.float32)
    seen_v = np.full((N_FEATURES, RANK), 1e-2, np.float32)
    seen_b = 1.0
    epochs = max(EPOCHS, STEPS * BATCH // max(len(label), BATCH))
    for _ in range(epochs):
        for lo in range(0, len(label), BATCH):
            if lo == 0:
                order = rng.permutation(len(label))
            pick = order[lo:lo + BATCH]
            b = x.rows(pick)
            margin, sums = m.margins(b)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[pick]) * row_weight[pick] / len(pick)
            size = np.diff(np.concatenate([[0], b.ends]))
            g = (np.repeat(slope, size) * b.value).astype(np.float32)
            feature, where = np.unique(b.feature, return_inverse=True)
            gw = np.bincount(where, g, len(feature)).astype(np.float32) + 1e-5 * m.weight[feature]
            gv_rows = g[:, None] * (np.repeat(sums, size, axis=0) - m.factor[b.feature] * b.value[:, None])
            gv = np.column_stack([np.bincount(where, gv_rows[:, f], len(feature)) for f in range(RANK)]) + 1e-5 * m.factor[feature]
            seen_w[feature] += gw * gw
            seen_v[feature] += gv * gv
            seen_b += slope.sum() ** 2
            m.weight[feature] -= 0.1 * gw / np.sqrt(seen_w[feature])
            m.factor[feature] -= (0.05 * gv / np.sqrt(seen_v[feature])).astype(np.float32)
            m.bias -= 0.1 * slope.sum() / np.sqrt(seen_b)
    return m


def _prepare(batch: pa.RecordBatch, names: list[str]):
    meta = meta_features(batch, names)
    for lo, hi, buf, offs in tx.chunks(batch.column(1)):
        words, stats = word_and_stat_rows(buf, offs)
        yield lo, hi, words, meta[lo:hi], stats


def _inputs(docs: DataFrame, metadata: list[str], *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"),
                       *[F.col(c).alias(f"meta_{i}") for i, c in enumerate(metadata)], *more)


def training_sample(labels: DataFrame, usable: Column, label: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, label, of_class``: at most ``per_class`` ids of each class, and
    how many usable ids the class has."""
    clean = (labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
             .where(F.col("label") == F.col("other")).select("doc_id", F.col("label").cast("int").alias("label")))
    sizes = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [clean.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
             .withColumn("of_class", F.lit(sizes.get(c, 0))) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, usable: Column, metadata: list[str], label: str = "quality") -> Machine | float:
    """A machine, or a constant score where there is nothing to learn."""
    spark = docs.sparkSession
    text_batches(spark)
    sample = training_sample(labels, usable, label).collect()          # at most 2 * PER_CLASS ids
    if not sample:
        return 0.5
    chosen = spark.createDataFrame([(r["doc_id"], r["label"], r["of_class"]) for r in sample],
                                   "key long, label int, of_class long")

    def rows(batches):
        for batch in batches:
            y = batch.column("label").to_pylist()
            for lo, hi, words, meta, stats in _prepare(batch, metadata):
                first = np.concatenate([[0], words.ends[:-1]])
                cut = list(zip(first, words.ends))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words.feature[a:b].tobytes() for a, b in cut], pa.binary()),
                     pa.array([words.value[a:b].tobytes() for a, b in cut], pa.binary()),
                     pa.array([m.tobytes() for m in meta], pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary()),
                     batch.column("key").slice(lo, hi - lo), pa.array(y[lo:hi], pa.int32())],
                    ["feature", "value", "meta", "stats", "key", "label"])

    table = _inputs(docs, metadata).join(F.broadcast(chosen), "key").select(
        "key", "text", *[f"meta_{i}" for i in range(len(metadata))], "label").transform(map_arrow,
        rows, "feature binary, value binary, meta binary, stats binary, key long, label int").toPandas()
    sizes = {r["label"]: r["of_class"] for r in sample}
    total = sum(sizes.values())
    share = (sizes.get(1, 0) + 1) / (total + 2)
    if len(table) == 0:
        return 0.5
    if table["label"].nunique() < 2:
        return share
    table = table.sort_values(["key", "feature"], kind="stable")
    feature = [np.frombuffer(b, np.int32) for b in table["feature"]]
    words = Sparse(np.concatenate(feature), np.concatenate([np.frombuffer(b, np.float32) for b in table["value"]]),
                   np.cumsum([len(f) for f in feature]))
    meta = np.array([np.frombuffer(b, np.int32) for b in table["meta"]]).reshape(len(table), -1)
    stats = np.array([np.frombuffer(b, np.float32) for b in table["stats"]])
    return fit(words, meta, stats, table["label"].to_numpy(), share)


def score(docs: DataFrame, machine: Machine | float, metadata: list[str], carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``carry``, all by default) and score, for
    every row of ``docs``."""
    text_batches(docs.sparkSession)
    carry = carry or docs.columns
    row = F.struct(*carry).alias("row")
    if isinstance(machine, float):
        return docs.select(row, F.lit(machine).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def rows(batches):
        m = sent.value
        for batch in batches:
            if in_row is not None:          # the text travels once, inside the row
                batch = batch.add_column(1, "text", pc.struct_field(batch.column(0), in_row))
            for lo, hi, words, meta, stats in _prepare(batch, metadata):
                got = m.scores(assemble(words, meta, m.standardise(stats)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(got, pa.float64())], ["row", "score"])

    in_row = carry.index("text") if "text" in carry and dict(docs.dtypes)["text"] == "string" else None
    text = [] if in_row is not None else [F.col("text").cast("string").alias("text")]
    base = docs.select(row, *text, *[F.col(c).alias(f"meta_{i}") for i, c in enumerate(metadata)])
    return base.transform(map_arrow, rows, f"row {base.schema['row'].dataType.simpleString()}, score double")
