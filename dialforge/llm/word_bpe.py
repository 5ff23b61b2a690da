"""BPE encoding and decoding of whole texts with a word-end ``tokenizer.json``.

Text is normalised and split into words as the file says (NFC, white space to
one space, lower case; letters, single digits or other marks). Each distinct
word is encoded once per batch of new words with a *contiguous rank array*: the
row of a word holds its parts side by side and, next to it, the rank of every
adjacent pair. Each round scans the ranks for the smallest (leftmost on ties),
merges that pair by deleting the boundary between its parts, moves the rest of
the row one place left, and looks up only the two ranks beside the merge. Words
of equal length share a matrix, so a round is a handful of numpy calls. A word
of over ``SHORT`` symbols, where rescanning would be quadratic, uses the same
ranks with a heap.

Cases: a null text is empty and gives no ids; empty texts, repeated rows, ties
of rank (the leftmost pair merges) and texts that hold the strings of added
tokens (they become those tokens' ids) are as in the library; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dialforge.llm.byte_bpe import byte_alphabet
from dialforge.llm.store import map_arrow, text_batches

SHORT = 40
CACHED_WORDS = 250_000     # per worker; the cache starts anew beyond it
OUT_BYTES = 8 << 20
NO_RANK = np.int64(1) << 40

#: The file's normaliser and splitter, as ``tokenizers`` runs them.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


class Odd:
    """Characters that this Python knows nothing of and the ``regex`` package may
    class otherwise than the library: each is put to the library's own normaliser
    and splitter once."""

    def __init__(self, path: str):
        lib = Tokenizer.from_file(path)
        unknown = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
        self.marks, self.lower = [], {}
        for c in regex.findall(r"[\p{L}\p{N}]", unknown):
            plain = lib.normalizer.normalize_str(c)
            if plain != c.lower():
                self.lower[ord(c)] = plain
            if len(lib.pre_tokenizer.pre_tokenize_str(f"a{plain}b!{plain}")) == 4:      # a mark, joined to the other
                self.marks.append(plain)
        every = {*map(ord, self.marks), *self.lower}
        self.least = chr(min(every)) if every else None          # texts below it need no second look
        self.any = regex.compile(f"[{_ranges(every)}]") if every else None
        marks = _ranges(set(map(ord, self.marks)))
        own = f"--[{marks}]" if marks else ""
        self.words = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}{own}]+|[\p{{N}}{own}]|(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]"
                                   + (f"|[{marks}]" if marks else "") + ")+")


def _ranges(points: set[int]) -> str:
    """Code points as the inside of a character class."""
    out: list = []
    for c in sorted(points):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class _Codes(dict):
    """Numbers of words in order of first sight; ``new`` are not encoded yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_split = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.odd = Odd(path)
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.tokens = np.full(size, "", object)
        for token, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = token
        letter = {b: c for c, b in byte_alphabet().items()}
        self.inner = np.array([vocab[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letter[b] + end] for b in range(256)], np.int64)
        pairs = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.append((vocab[a] << 20 | vocab[b], rank, vocab[a + b]))
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.keys, self.key_rank, self.key_id = pairs[:, 0].copy(), pairs[:, 1].copy(), pairs[:, 2].copy()
        self.by_rank = np.zeros(len(pairs), np.int64)
        self.by_rank[self.key_rank] = self.key_id
        self.forget()

    def forget(self) -> None:
        self.code = _Codes()
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], NO_RANK)

    def merge_matrix(self, parts: np.ndarray):
        """Encode words of one length; ``parts`` is (words, symbols). Yields
        the numbers of finished words and their ids, one row per word."""
        who = np.arange(len(parts))
        rank = self.ranks(parts[:, :-1], parts[:, 1:])
        while True:
            width = parts.shape[1]
            at = rank.argmin(axis=1) if width > 1 else np.zeros(len(parts), np.int64)
            best = rank[np.arange(len(parts)), at] if width > 1 else np.full(len(parts), NO_RANK)
            go = best < NO_RANK
            if not go.all():
                yield who[~go], parts[~go]
            if not go.any():
                return
            parts, rank, at, best, who = parts[go], rank[go], at[go], best[go], who[go]
            row = np.arange(len(parts))
            cols = np.arange(width - 1)
            # delete the boundary right of part ``at``: later parts move left
            parts = np.take_along_axis(parts, cols + (cols > at[:, None]), axis=1)
            parts[row, at] = self.by_rank[best]
            if width == 2:
                rank = np.zeros((len(parts), 0), np.int64)
                continue
            cols = np.arange(width - 2)
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), axis=1)
            has = at > 0
            rank[row[has], at[has] - 1] = self.ranks(parts[row[has], at[has] - 1], parts[row[has], at[has]])
            has = at < width - 2
            rank[row[has], at[has]] = self.ranks(parts[row[has], at[has]], parts[row[has], at[has] + 1])

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Encode one word of any length: links and a heap of (rank, place)."""
        parts = symbols.tolist()
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        ranks = self.ranks(symbols[:-1], symbols[1:])
        heap = [(int(r), i) for i, r in enumerate(ranks) if r < NO_RANK]
        heapq.heapify(heap)
        current = ranks.tolist() + [int(NO_RANK)]

        def pair(i: int) -> None:
            j = after[i]
            r = int(self.ranks(np.array([parts[i]]), np.array([parts[j]]))[0]) if j < len(parts) else int(NO_RANK)
            current[i] = r
            if r < NO_RANK:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if current[i] != r or parts[i] is None:
                continue
            j = after[i]
            parts[i] = int(self.by_rank[r])
            parts[j], current[j] = None, int(NO_RANK)
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        return np.array([p for p in parts if p is not None], np.int64)

    def learn(self) -> None:
        """Encode the words that were met for the first time."""
        new, self.code.new = self.code.new, []
        first = len(self.at)
        self.at = np.concatenate([self.at, np.zeros(len(new), np.int64)])
        self.size = np.concatenate([self.size, np.zeros(len(new), np.int64)])
        by_length: dict[int, list[int]] = {}
        raw = [w.encode() for w in new]
        for i, w in enumerate(raw):
            by_length.setdefault(len(w), []).append(i)
        for n, group in by_length.items():
            letters = np.frombuffer(b"".join([raw[i] for i in group]), np.uint8).reshape(-1, n)
            parts = self.inner[letters]
            parts[:, -1] = self.last[letters[:, -1]]
            group = np.array(group) + first
            if n <= SHORT:
                for who, ids in self.merge_matrix(parts):
                    self._store(group[who], ids)
            else:
                for i, p in zip(group, parts):
                    self._store(np.array([i]), self.merge_long(p)[None])
        for w in self.added.keys() & set(new):
            self._store(np.array([self.code[w]]), np.array([[self.added[w]]]))

    def _store(self, codes: np.ndarray, ids: np.ndarray) -> None:
        n, width = ids.shape
        if self.used + n * width > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), n * width), np.uint32)])
        self.flat[self.used:self.used + n * width] = ids.ravel()
        self.at[codes] = self.used + np.arange(n) * width
        self.size[codes] = width
        self.used += n * width

    def words(self, text: str) -> list[str]:
        """The words of a text; the string of an added token is one word."""
        if self.added_split and any(t in text for t in self.added):
            return [w for part in self.added_split.split(text)
                    for w in ([part] if part in self.added else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        # white space only separates words, so making it one space changes none;
        # lower case one character at a time as the library does: no final sigma
        plain, words = unicodedata.normalize("NFC", text).replace("Σ", "σ"), _WORDS
        if plain and self.odd.any is not None and max(plain) >= self.odd.least and self.odd.any.search(plain):
            plain, words = plain.translate(self.odd.lower), self.odd.words
        return words.findall(plain.lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """``uint32`` ids of every text."""
        if len(self.code) > CACHED_WORDS:
            self.forget()
        code = self.code.__getitem__
        codes = [np.fromiter(map(code, words), np.int64, len(words)) for words in map(self.words, texts)]
        self.learn()
        out = []
        for c in codes:
            n = self.size[c]
            ends = np.cumsum(n)
            take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[c] - (ends - n), n)
            out.append(self.flat[take])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode with special tokens kept: this file names no
        decoder, so the tokens' strings are joined by single spaces."""
        return " ".join(self.tokens[ids])


@functools.lru_cache(2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def _encode_body(path: str):
    def run(batches):
        bpe = word_bpe(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            lo, held, group = 0, 0, []
            for i in range(batch.num_rows):
                group.append(texts[i].as_py() or "")
                held += len(group[-1])
                if held > OUT_BYTES // 8 or i == batch.num_rows - 1:
                    ids = [x.astype("<u4").tobytes() for x in bpe.encode(group)]
                    yield pa.RecordBatch.from_arrays([keys.slice(lo, len(group)), pa.array(ids, pa.binary())], ["key", "ids"])
                    lo, held, group = i + 1, 0, []
    return run


def _decode_body(path: str):
    def run(batches):
        bpe = word_bpe(path)
        for batch in batches:
            keys, ids = batch.column(0), batch.column(1)
            lo, held, group = 0, 0, []
            for i in range(batch.num_rows):
                group.append(bpe.decode(np.frombuffer(ids[i].as_py() or b"", "<u4")))
                held += len(group[-1])
                if held > OUT_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(lo, len(group)), ids.slice(lo, len(group)), pa.array(group, pa.string())],
                        ["key", "ids", "decoded"])
                    lo, held, group = i + 1, 0, []
    return run


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` -> doc_id, ids (little-endian uint32 binary)."""
    text_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text")).transform(map_arrow,
        _encode_body(tokenizer), f"key {kind}, ids binary").withColumnRenamed("key", "doc_id")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids`` -> doc_id, ids, decoded."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select(F.col("doc_id").alias("key"), "ids").transform(map_arrow,
        _decode_body(tokenizer), f"key {kind}, ids binary, decoded string").withColumnRenamed("key", "doc_id")
