import numpy as np
import pyarrow as pa

from dialforge.llm import byte_bpe, ordering
from dialforge.llm import queries as Q


def test_a_batch_unpacks_as_its_rows():
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, top, n).astype("<u4").tobytes() for top, n in ((50_000, 64), (200_000, 64), (9, 0), (70_000, 1), (3, 5))]
    packed = pa.array([ordering.pack_ids(r) for r in rows], pa.binary())
    for batch in (packed, packed.slice(1, 3), packed.slice(0, 0)):
        assert ordering.unpack_all(batch).to_pylist() == [ordering.unpack_ids(x.as_py()) for x in batch]


def test_rare_characters_are_not_ascii():
    assert not [c for c in map(chr, range(128)) if byte_bpe.RARE.search(c)]


def test_no_special_token_is_looked_for():
    """Ids come from a call that skips the search for special tokens."""
    import public_tokenizers

    enc = byte_bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))

    class Ranks:
        encode_ordinary = staticmethod(enc.ranks.encode_ordinary)

    texts = ["plain  text, it's 12 \n\n lines\t", "é ü ß", " ", "x" * 3000]
    want = [enc.library.encode(t, add_special_tokens=False).ids for t in texts]
    enc.ranks = Ranks
    assert [enc.ids(t).tolist() for t in texts] == want


def test_packed_sequences_give_the_same_order(spark):
    rows = [(i, "word " * (i * 7 % 90)) for i in range(60)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    plain, packed = (ordering.in_training_order(ordering.sequences(docs, Q.BYTE_BPE, length=16, packed=p), "k", shard=32) for p in (False, True))
    assert packed.schema == plain.schema
    got = [sorted(map(tuple, x.select("slot", "shard", "record", "row.*").collect())) for x in (plain, packed)]
    assert got[0] == got[1] and len(got[0]) > 60
