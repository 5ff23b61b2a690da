"""Token ids of whole texts with a byte-level BPE ``tokenizer.json``.

Ids equal those of ``tokenizers`` (``add_special_tokens=False``). Ordinary
Latin text goes through the faster rank encoder built from the same file; a
text that names an added token or holds other scripts goes through the library
itself, so no text relies on two regex engines agreeing about rare characters.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa

#: Fixed value: the split pattern of byte-level BPE files with ``use_regex``.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RARE = re.compile("[^\x00-ſ‐-‧]")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in such files: a byte
    that prints stands for itself, the others take code points from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if token not in self.added}
        self.ranks = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        """``uint32`` ids of one text."""
        if not text:
            return np.zeros(0, np.uint32)
        if not text.isascii() and RARE.search(text) or any(a in text for a in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.ranks.encode_ordinary(text), np.uint32)    # looks for no special token at every place


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def binary(ids: np.ndarray) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return np.ascontiguousarray(ids, "<u4").tobytes()


def document_ids(path: str, end_id: int | None):
    """``mapInArrow`` body: ``key, text`` -> ``key, ids binary``; a null text is
    empty; ``end_id`` closes every document."""
    def run(batches):
        enc = encoder(path)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            lo, held, out = 0, 0, []
            for i in range(batch.num_rows):
                out.append(binary(np.concatenate([enc.ids(texts[i].as_py() or ""), tail])))
                held += len(out[-1])
                if held > 8 << 20 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(lo, i + 1 - lo), pa.array(out, pa.binary())], ["key", "ids"])
                    lo, held, out = i + 1, 0, []
    return run
