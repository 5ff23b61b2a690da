"""Secret scans: fixed rules, and a linear-chain conditional random field that
adds spans the rules miss.

Tokens of a text are tagged begin, inside or outside a secret. The score of a
tag at a token sums weights of the token's own shape class, the classes of its
three predecessors and its successor, hashed identities of the words beside it, and
a class of the whole file; adjacent tags add a transition weight. Weights are fitted
(``crf.fit``) on a bounded sample of documents, ``PER_KIND`` with and ``PER_KIND``
without a rule match, whose matches are the tags to learn; tasks cut them into
segments, of which a bounded number reaches the driver. In half of the training
segments a word of the same text stands in each keyword's place, so that the shape
of what follows carries weight of its own. The best tag sequence is Viterbi's, for a
batch of documents at once, and only where an entity can be at all (``crf.Bounds``),
with the result of decoding whole texts. ``caution`` is added to outside when
decoding; added spans of fewer than ``min_chars`` characters are left out, as those
of the rules are.

Cases: null and empty texts have no spans; repeated rows are scanned alike;
without any rule match in the corpus nothing is learnt and only the rules speak;
added spans never overlap a rule's; equal starts go by kind as listed; no rows
give no rows; other columns come back untouched in ``row``.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialforge.llm import crf
from dialforge.llm.store import map_arrow, text_batches, written

#: The rules, in the order of their kinds.
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")       # the longest run either way

PER_KIND = 400          # bound of the training sample: documents with, and without, a rule match
SEGMENT = 64            # tokens of a training segment
MOST_SEGMENTS = 1 << 12 # with a secret, of the sampled documents; lowest hashes first
PLAIN_SEGMENTS = 4      # training segments without a secret, for each with one
CAUTION = -2.0          # added to "outside" when decoding; chosen by what it finds, see README
MIN_CHARS = 8           # shorter added spans are not secrets
CHUNK_CHARS = 1 << 19   # of texts decoded together; a longer text is alone
_TOKEN = re.compile(r"[\w+/.\-]+|=|[^\w\s+/.\-=]+")
_KEYWORD = re.compile(r"(?i)pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|auth|credential|bearer|private[_-]?key|access[_-]?key")
OUT, BEGIN, INSIDE = 0, 1, 2
ALLOWED = np.array([[1, 1, 0], [1, 1, 1], [1, 1, 1]])       # an entity starts with begin
N_SHAPE, N_WORD, N_FILE = 512, 1 << 12, 8
OFFSETS = (0, -1, -2, -3, 1)              # of the shape classes
WORD_OFFSETS = (-3, -2, -1, 1)            # of the word identities
REACH = 3
SIZES = [N_SHAPE] * len(OFFSETS) + [N_WORD] * len(WORD_OFFSETS) + [N_FILE]
EDGE, KEYWORD = 0, 1                      # classes of no token, and of a keyword


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself), by start and kind."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _size(n: int) -> int:
    return 0 if n < 4 else 1 if n < 8 else 2 if n < 16 else 3 if n < 28 else 4


def _shape(token: str) -> int:
    n = len(token)
    if token[0] in "apstcbAPSTCB" and _KEYWORD.fullmatch(token):
        return KEYWORD
    varied = min(len(set(token)) * 2 // max(min(n, 24), 1), 1)
    if token.isascii() and token.isalpha() and (n == 1 or token[1:].islower()):       # most tokens
        return 12 + _size(n) * 2 + varied
    if not (token[0].isalnum() or n > 1 and any(map(str.isalnum, token))):
        return 3 + {"=": 0, ":": 1, '"': 2, "'": 3, "(": 4, ",": 5}.get(token[-1], 6)
    digits, upper, lower = sum(map(str.isdigit, token)), sum(map(str.isupper, token)), sum(map(str.islower, token))
    marks = n - digits - upper - lower
    kind = ((digits > 0) + 2 * (upper > 1 and lower > 0 or upper > 0 and digits > 0) + 4 * (marks > 0)
            + 8 * (digits * 5 > n) + 16 * (digits == n))
    return 12 + (kind * 5 + _size(n)) * 2 + varied


def code_of(token: str) -> int:
    """Shape class of a token and, above it, the hashed identity of a plain word."""
    word = 0
    if token.isalpha() and len(token) <= 20:
        word = 1 + zlib.crc32(token.lower().encode()) % (N_WORD - 1)
    return _shape(token) + N_SHAPE * word


class _Codes(dict):
    def __missing__(self, token: str) -> int:
        c = code_of(token)
        if len(token) <= 64:
            if len(self) > 400_000:
                self.clear()
            self[token] = c
        return c


_CODES = _Codes()


def codes(text: str) -> np.ndarray:
    tokens = _TOKEN.findall(text)
    return np.fromiter(map(_CODES.__getitem__, tokens), np.int32, len(tokens))


def file_class(code: np.ndarray) -> int:
    """Size of the file, and whether it holds keywords."""
    return min(int(np.log10(len(code) + 1)), 3) * 2 + int((code % N_SHAPE == KEYWORD).any())


def features(padded: np.ndarray, files: np.ndarray, near):
    """Features of tokens; ``near(o)`` gives the places of ``padded`` at an offset."""
    for o in OFFSETS:
        yield padded[near(o)] & (N_SHAPE - 1)
    for o in WORD_OFFSETS:
        yield padded[near(o)] >> 9
    yield files[near(0)]


def training_tags(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shapes and tags of a text whose rule matches are the secrets."""
    secrets = [(s[3], s[2]) for s in base_spans(text)]
    places = [m.span() for m in _TOKEN.finditer(text)]
    tags = np.zeros(len(places), np.int64)
    starts = np.array([p[0] for p in places], np.int64)
    ends = np.array([p[1] for p in places], np.int64)
    for lo, hi in secrets:
        inside = np.flatnonzero((starts < hi) & (ends > lo))
        if len(inside):
            tags[inside] = INSIDE
            tags[inside[0]] = BEGIN
    return codes(text), tags


def _segments_body():
    """``text, h`` in; the segments of each text out, with the codes around them."""
    names = ["h", "lo", "file", "hit", "codes", "tags"]

    def run(batches):
        for batch in batches:
            for text, h in zip(batch.column(0), batch.column(1)):
                code, tag = training_tags(text.as_py())
                kind, tag = file_class(code), tag.astype(np.int8)
                padded = np.concatenate([[EDGE] * REACH, code, [EDGE] * REACH]).astype("<i4")
                for first in range(0, len(code), SEGMENT << 12):
                    at = range(first, min(first + (SEGMENT << 12), len(code)), SEGMENT)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h.as_py()] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array([kind] * len(at), pa.int64()),
                         pa.array([bool(tag[lo:lo + SEGMENT].any()) for lo in at], pa.bool_()),
                         pa.array([padded[lo:lo + SEGMENT + 2 * REACH].tobytes() for lo in at], pa.binary()),
                         pa.array([tag[lo:lo + SEGMENT].tobytes() for lo in at], pa.binary())], names)
    return run


def without_keywords(code: np.ndarray, rng) -> np.ndarray:
    """A plain word of the same stretch in the place of each keyword."""
    keyword = code % N_SHAPE == KEYWORD
    plain = code[(code >= N_SHAPE) & ~keyword]
    if not len(plain):
        plain = np.array([code_of("value")])
    return np.where(keyword, rng.choice(plain, len(code)), code)


def fit_segments(rows: list, seed: int = 11) -> crf.Chain | None:
    """``rows`` are (file, codes, tags) of segments, the codes around them included."""
    rng = np.random.default_rng(seed)
    hit = np.array([any(tag) for _, _, tag in rows], bool)
    if not hit.any():
        return None
    plain = rng.permutation(np.flatnonzero(~hit))[:PLAIN_SEGMENTS * int(hit.sum())]
    pick = np.sort(np.concatenate([np.flatnonzero(hit), plain]))
    feats = np.zeros((len(pick), SEGMENT, len(SIZES)), np.int32)
    tags, used = np.zeros((len(pick), SEGMENT), np.int64), np.zeros((len(pick), SEGMENT), bool)
    for i, r in enumerate(pick):
        kind, code, tag = rows[r]
        code, tag = np.frombuffer(code, "<i4"), np.frombuffer(tag, np.int8)
        if rng.random() < 0.5:
            code, kind = without_keywords(code, rng), kind & ~1
        n = len(tag)
        for k, f in enumerate(features(code, np.full(len(code), kind), lambda o: slice(REACH + o, REACH + o + n))):
            feats[i, :n, k] = f
        tags[i, :n], used[i, :n] = tag, True
    return crf.fit(feats, tags, used, SIZES, ALLOWED)


def train(docs: DataFrame) -> crf.Chain | None:
    """A field from a bounded sample of ``docs``, lowest hashes of text first."""
    text_batches(docs.sparkSession)
    has = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def flag(batches):
        for batch in batches:
            hit = [bool(t) and bool(base_spans(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(hit, pa.bool_())], ["h", "hit"])

    flags = docs.select(has.alias("text"), F.xxhash64(has).alias("h")).transform(map_arrow, flag, "h long, hit boolean")
    chosen = [r["h"] for hit in (True, False)
              for r in flags.where(F.col("hit") == hit).select("h").distinct().orderBy("h").limit(PER_KIND).collect()]
    if not chosen:
        return None
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in chosen], "h long"))
    texts = docs.select(has.alias("text"), F.xxhash64(has).alias("h")).join(wanted, "h").dropDuplicates(["h"]).select("text", "h")
    cut = written(texts.transform(map_arrow, _segments_body(), "h long, lo long, file long, hit boolean, codes binary, tags binary"),
                  "secret-segments")
    rows = [r for hit, most in ((True, MOST_SEGMENTS), (False, PLAIN_SEGMENTS * MOST_SEGMENTS))
            for r in cut.where(F.col("hit") == hit).orderBy(F.xxhash64("h", "lo"), "h", "lo").limit(most).collect()]
    return fit_segments([(r["file"], bytes(r["codes"]), bytes(r["tags"])) for r in sorted(rows, key=lambda r: (r["h"], r["lo"]))])


class Reader:
    """A field ready to read batches of texts."""

    def __init__(self, chain: crf.Chain, caution: float = CAUTION):
        self.chain, self.caution = chain, caution
        self.bounds = crf.Bounds(chain, caution)

    def entities(self, own: list[np.ndarray]) -> list[list[tuple[int, int]]]:
        """Token ranges (first, end) of the entities of each text, given as codes."""
        out: list = [[] for _ in own]
        gap = np.full(REACH, EDGE, np.int32)
        parts, begins, files, at = [gap], [], [np.zeros(REACH, np.int8)], REACH
        for c in own:
            begins.append(at)
            parts += [c, gap]
            files.append(np.full(len(c) + REACH, file_class(c), np.int8))
            at += len(c) + REACH
        padded, files = np.concatenate(parts), np.concatenate(files)
        inner = len(padded) - 2 * REACH           # tokens with all their neighbours
        if inner <= 0:
            return out
        first, end = self.bounds.stretches(features(padded, files, lambda o: slice(REACH + o, REACH + o + inner)),
                                           padded[REACH:REACH + inner] == EDGE)
        tags = crf.decode(self.chain, first, end, lambda p: features(padded, files, lambda o: p + REACH + o), self.caution)
        owner = np.searchsorted(begins, first + REACH, "right") - 1
        for lo, doc, tag in zip(first, owner, tags):
            lo, i = int(lo) + REACH - begins[doc], 0
            while i < len(tag):
                j = i + 1
                if tag[i] != OUT:
                    while j < len(tag) and tag[j] == INSIDE:
                        j += 1
                    out[doc].append((lo + i, lo + j))
                i = j
        return out


def find_all(texts: list[str], reader: Reader | None, min_chars: int = MIN_CHARS) -> list[list[tuple[str, int, int]]]:
    """All spans of each text: (kind, start, end) in code points, by start and kind."""
    out = [[s[:3] for s in base_spans(t)] for t in texts]
    if reader is not None:
        for text, spans, entities in zip(texts, out, reader.entities([codes(t) for t in texts])):
            if not entities:
                continue
            places, base = [m.span() for m in _TOKEN.finditer(text)], list(spans)
            for lo, hi in entities:
                a, b = places[lo][0], places[hi - 1][1]
                if b - a >= min_chars and all(b <= s[1] or a >= s[2] for s in base):
                    spans.append(("crf", a, b))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in out]


def find(text: str, chain: crf.Chain | None, caution: float = CAUTION, min_chars: int = MIN_CHARS) -> list[tuple[str, int, int]]:
    """:func:`find_all` of one text."""
    return find_all([text], Reader(chain, caution) if chain is not None else None, min_chars)[0]


def redact(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, a, b in spans:
        if b > at:
            out += [text[at:max(a, at)], mark if a >= at else ""]
            at = b
    return "".join(out) + text[at:]


def scan(docs: DataFrame, chain: crf.Chain | None, mark: str | None = None, caution: float = CAUTION,
         min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but text), spans; with a
    ``mark`` also text, in which it replaces every span."""
    text_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != "text"]
    base = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(batches):
        reader = Reader(sent.value, caution) if sent.value is not None else None
        for batch in batches:
            column, lo = batch.column("text"), 0
            while lo < batch.num_rows:
                texts, size, hi = [], 0, lo
                while hi < batch.num_rows and (hi == lo or size < CHUNK_CHARS):
                    texts.append(column[hi].as_py())
                    size += len(texts[-1] or "")
                    hi += 1
                found = find_all([t or "" for t in texts], reader, min_chars)
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found]
                out = [batch.column("row").slice(lo, hi - lo), pa.array(spans, span)]
                if mark is not None:
                    out.append(pa.array([redact(t, s, mark) if t is not None and s else t for t, s in zip(texts, found)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, ["row", "spans", "text"][:len(out)])
                lo = hi

    kind = base.schema["row"].dataType.simpleString()
    return base.transform(map_arrow, rows, f"row {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
                           + (", text string" if mark is not None else ""))
