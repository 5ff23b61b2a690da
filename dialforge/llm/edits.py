"""Edit-aware token counts with a segment tree of pre-token blocks per document.

``build`` cuts a text into pre-tokens, encodes them, and keeps one leaf per
block of about ``BLOCK`` pre-tokens: its length in characters and its number of
tokens, with the sums of both in a binary tree above. ``apply`` replays edits
``(start, removed, inserted)``: from the tree it finds the block where the edit
starts, steps back over the boundary context (``BACK`` characters and more: a pre-token
can look ahead that far), cuts the new text anew from there, and stops as soon
as it reaches an old block's start beyond the edit: the rest of the text is cut
the same as before. Only that stretch is encoded; its leaves are replaced and the
sums above them updated. An added token of the file ('<|endoftext|>') is one
pre-token of one token wherever its string stands, and the text on each side is
cut as if it ended there, as the library does; the boundary context is longer
by the longest of them, so edits make and break them. Added tokens that take in
white space or whole words only (``lstrip``, ``rstrip``, ``single_word``) are refused.

Cases: a null text is empty and counts 0 tokens; places beyond the end of the
text are its end, negative ones its start; null edits or null inserted text
insert nothing; repeated rows are counted each; several edits are applied in
order; a text without any block start (one long word) is encoded anew as a
whole; no rows give no rows; other columns come back in ``row``.
"""

from __future__ import annotations

import functools
import itertools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialforge.llm.byte_bpe import RARE, SPLIT, encoder
from dialforge.llm.store import map_arrow, text_batches

BLOCK = 64
BACK = 4
KNOWN = 300_000             # pre-tokens whose counts a worker remembers
#: The pre-token pattern with Unicode white space, as the library runs it.
_CUT = regex.compile(SPLIT.replace(r"\s+(?!\S)|\s+", r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
                     .replace(r"[^\s", r"[^\p{White_Space}"))


class SumTree:
    """Leaf values with the sums of both columns over a binary tree."""

    def __init__(self, leaves: np.ndarray):
        self.build(np.asarray(leaves, np.int64).reshape(-1, 2))

    def build(self, leaves: np.ndarray) -> None:
        self.n = len(leaves)
        self.size = 1 << max(self.n - 1, 0).bit_length()
        self.node = np.zeros((2 * self.size, 2), np.int64)
        self.node[self.size:self.size + self.n] = leaves
        lo = self.size // 2
        while lo:                             # a level of the tree at a time
            self.node[lo:2 * lo] = self.node[2 * lo:4 * lo:2] + self.node[2 * lo + 1:4 * lo:2]
            lo //= 2

    @property
    def leaves(self) -> np.ndarray:
        return self.node[self.size:self.size + self.n]

    @property
    def total(self) -> np.ndarray:
        return self.node[1] if self.n else np.zeros(2, np.int64)

    def find(self, chars: int) -> tuple[int, int]:
        """The leaf that holds a character place, and where that leaf starts."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if start + self.node[i, 0] <= chars and i + 1 < 2 * self.size:
                start += int(self.node[i, 0])
                i += 1
        leaf = min(i - self.size, max(self.n - 1, 0))
        return leaf, start if leaf == i - self.size else int(self.leaves[:leaf, 0].sum())

    def replace(self, lo: int, hi: int, leaves: np.ndarray) -> None:
        """Put ``leaves`` in the place of leaves lo..hi."""
        if len(leaves) == hi - lo:            # the same number: only the paths above change
            for k, leaf in enumerate(leaves):
                i = self.size + lo + k
                self.node[i] = leaf
                while i > 1:
                    i //= 2
                    self.node[i] = self.node[2 * i] + self.node[2 * i + 1]
        else:
            self.build(np.concatenate([self.leaves[:lo], np.asarray(leaves, np.int64).reshape(-1, 2), self.leaves[hi:]]))


class _Counts(dict):
    """Numbers of tokens of pre-tokens, as they are met."""

    def __init__(self, enc, added: set[str]):
        self.enc, self.added = enc, added

    def __missing__(self, piece: str) -> int:
        if len(self) > KNOWN:
            self.clear()
        self[piece] = n = (1 if piece in self.added else len(self.enc.library.encode(piece, add_special_tokens=False).ids)
                           if RARE.search(piece) else len(self.enc.ranks.encode_ordinary(piece)))
        return n


class Pieces:
    """The pre-tokens of texts under one tokenizer file, and their numbers of tokens."""

    def __init__(self, path: str):
        enc = encoder(path)
        with open(path, encoding="utf-8") as f:
            odd = [t["content"] for t in json.load(f).get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if odd:
            raise ValueError(f"added tokens that depend on the text around them: {odd}")
        self.added = set(enc.added)
        self.known = _Counts(enc, self.added)
        self.find_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        self.back = BACK + max(map(len, self.added), default=0)

    def _stretches(self, text: str, start: int):
        for m in self.find_added.finditer(text, start):
            yield _CUT.finditer(text, start, m.start())
            yield (m,)
            start = m.end()
        yield _CUT.finditer(text, start)

    def cut(self, text: str, start: int):
        """Matches of the pre-tokens from ``start`` on."""
        return itertools.chain.from_iterable(self._stretches(text, start))

    def count(self, piece: str) -> int:
        return self.known[piece]


@functools.lru_cache(2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def leaves_of(text: str, start: int, pieces: Pieces, stop=None) -> tuple[list[tuple[int, int]], int]:
    """Blocks of the pre-tokens from ``start`` on, until ``stop(place)`` holds
    at a block's or pre-token's edge; the blocks and the place reached."""
    if stop is None and start == 0 and not any(t in text for t in pieces.added):     # a whole text, all at once
        found = _CUT.findall(text)
        both = np.stack([np.fromiter(map(len, found), np.int64, len(found)),
                         np.fromiter(map(pieces.known.__getitem__, found), np.int64, len(found))], axis=1)
        return list(map(tuple, np.add.reduceat(both, np.arange(0, len(found), BLOCK)).tolist())) if found else [], len(text)
    out, chars, tokens, n, at, count = [], 0, 0, 0, start, pieces.count
    for m in pieces.cut(text, start):
        if stop is not None and m.start() > start and stop(m.start()):
            break
        chars, tokens, n, at = chars + len(m[0]), tokens + count(m[0]), n + 1, m.end()
        if n == BLOCK:
            out.append((chars, tokens))
            chars = tokens = n = 0
    if n:
        out.append((chars, tokens))
    return out, at


class Document:
    """A text with its tree; ``encoded`` counts characters cut anew by edits."""

    def __init__(self, text: str, pieces: Pieces, leaves=None):
        self.text, self.pieces, self.encoded = text, pieces, 0
        self.tree = SumTree(leaves_of(text, 0, pieces)[0] if leaves is None else leaves)

    @property
    def tokens(self) -> int:
        return int(self.tree.total[1])

    def edit(self, start: int, removed: int, inserted: str) -> None:
        start = min(max(start, 0), len(self.text))
        end = min(start + max(removed, 0), len(self.text))
        back = self.pieces.back
        lo, at = self.tree.find(max(start - back, 0)) if self.tree.n else (0, 0)
        while lo and start - at < back:
            lo -= 1
            at -= int(self.tree.leaves[lo, 0])
        grown = len(inserted) - (end - start)
        edges = at + np.concatenate([[0], np.cumsum(self.tree.leaves[lo:, 0])])      # old block starts from here on
        beyond = {int(e) + grown: k for k, e in enumerate(edges) if e >= end}
        self.text = self.text[:start] + inserted + self.text[end:]
        fresh, reached = leaves_of(self.text, at, self.pieces, beyond.__contains__)
        self.encoded += reached - at
        hi = lo + beyond[reached] if reached in beyond else self.tree.n
        self.tree.replace(lo, hi, np.array(fresh, np.int64).reshape(-1, 2))


def _apply_body(path: str):
    def run(batches):
        pieces = _pieces(path)
        for batch in batches:
            out, lo, held = [], 0, 0
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py() or ""
                leaves = batch.column("leaves")[i].as_py() if "leaves" in batch.schema.names else None
                doc = Document(text, pieces, None if leaves is None else np.array([[x["chars"], x["tokens"]] for x in leaves], np.int64))
                before, n = doc.tokens, doc.tree.n
                for e in (batch.column("edits")[i].as_py() or []):
                    if e is not None:
                        doc.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                out.append((before, n, doc.tokens, len(doc.text), doc.encoded, doc.text,
                            [{"chars": int(c), "tokens": int(t)} for c, t in doc.tree.leaves]))
                held += len(doc.text)
                if held > 4 << 20 or i == batch.num_rows - 1:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").slice(lo, i + 1 - lo), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.string()),
                         pa.array(cols[6], pa.list_(pa.struct([("chars", pa.int64()), ("tokens", pa.int64())])))],
                        ["row", "tokens_before", "blocks", "tokens", "n_chars", "encoded_chars", "text", "leaves"])
                    out, lo, held = [], i + 1, 0
    return run


def count_edited(docs: DataFrame, edits: Column, tokenizer: str, leaves: str | None = None) -> DataFrame:
    """``row`` (a struct of all columns but text), tokens_before, blocks, tokens,
    n_chars, encoded_chars, text and leaves after the edits. ``edits`` is an
    array of (start, removed, inserted) in code points; ``leaves`` names a column
    kept from an earlier run, so that the text is not encoded at all."""
    text_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", leaves)]
    base = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"),
                       edits.cast("array<struct<start:bigint,removed:bigint,inserted:string>>").alias("edits"),
                       *([F.col(leaves).alias("leaves")] if leaves else []))
    kind = base.schema["row"].dataType.simpleString()
    return base.transform(map_arrow, _apply_body(tokenizer), f"row {kind}, tokens_before long, blocks long, tokens long, n_chars long, "
                           "encoded_chars long, text string, leaves array<struct<chars:bigint,tokens:bigint>>")
