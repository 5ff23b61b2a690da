"""Words of every code point as the library cuts them."""

from tokenizers import Tokenizer

from dialforge.llm import queries as Q
from dialforge.llm.word_bpe import WordBpe, _ranges


def test_every_code_point():
    lib, own = Tokenizer.from_file(Q.WORD_BPE), WordBpe(Q.WORD_BPE)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 1 << 16):
        texts = [f"a{chr(c)}b!{chr(c)}" for c in points[lo:lo + (1 << 16)]]
        want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        got = [ids.tolist() for ids in own.encode(texts)]
        assert [hex(ord(t[1])) for t, g, w in zip(texts, got, want) if g != w] == []


def test_ranges():
    assert _ranges({5, 6, 7, 9}) == "\\U00000005-\\U00000007\\U00000009-\\U00000009" and _ranges(set()) == ""
