"""Token files: exact round trip, and digests against direct encoding."""

import random
import zlib

import numpy as np
import pytest

from squall.llm import planes
from squall.session import scratch_path

vocab = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
ODD = ["", " ", "\n", "a", "  a  b\n\n c", " lead", "trail ", "it's  we'll\tx y z", "a\x1cb \x1f c", "<|endoftext|> x<|endoftext|>", "é" * 500, "字 \r\n🙂🙂 12 345..!",
       "word.\nNext line\n", "\n\nab", "x \n y", "9" * 3000, " ".join(["long"] * 30000)]


def test_ids_equal_those_of_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocab)
    g = random.Random(2)
    texts = ODD + ["".join(g.choice("ab \n\t'.é s19") for _ in range(60)) for _ in range(400)]
    got = planes.Encoder(vocab)(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


class Counted:
    """The library's model, and how many strings it was given."""

    def __init__(self, model):
        self.model, self.given = model, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.model.encode_batch_fast(texts, **options)


def ids_of(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(vocab).encode_batch(texts, add_special_tokens=False)]


def test_new_words_are_given_to_the_library_many_at_once_and_known_ones_never():
    texts = [" ".join(f"w{chr(97 + i % 26)}x{i}, q{i}.\nNext{i}" for i in range(k, k + 100)) for k in range(0, 3000, 100)]
    code = planes.Encoder(vocab)
    code.model = counted = Counted(code.model)
    want = ids_of(texts)
    for texts_again in (texts, texts[::-1]):
        got = code(texts_again)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == (want if texts_again is texts else want[::-1])
        assert 0 < counted.given < 100


def test_texts_with_other_white_space_share_the_known_words():
    texts = ["one two\n\nthree  four\tfive ", "\n\n", "\r\n one\u3000two\n three\n", "   ", "one two\nthree four"]
    code, want = planes.Encoder(vocab), ids_of(texts)
    code.whole = None                                 # encodes texts with an added token's string only
    assert [np.frombuffer(x, "<u4").tolist() for x in code(texts)] == want


def test_few_words_are_remembered_and_ids_stay_right():
    import pyarrow as pa

    g, code = random.Random(4), planes.Encoder(vocab)
    code.LIMIT, code.KEYS, code.LIST = 40, 7, 3
    for _ in range(20):
        texts = [" ".join(g.choice(["a,b", "x" * 80, "é1", "it's"]) + str(g.randrange(30)) for _ in range(12)) for _ in range(5)] + ODD
        assert [np.frombuffer(x, "<u4").tolist() for x in code(pa.array(texts))] == ids_of(texts)
        assert 0 < len(code.words) == len(code.ids) <= 40
        assert all(len(w.as_py()) <= code.LONG for w in code.words)


def test_small_batches_are_encoded_together_and_large_ones_in_parts():
    import pyarrow as pa

    g = random.Random(6)
    texts = [None if i % 7 == 0 else "x" * g.randrange(200) for i in range(400)] + ["y" * 5000, "z"]
    for rows in (1, 3, 1000):
        batches = [pa.record_batch({"doc_id": range(i, min(i + rows, 402)), "text": pa.array(texts[i:i + rows], pa.string())}) for i in range(0, 402, rows)]
        groups = list(planes._groups([*batches, batches[0].slice(0, 0)], 1000))
        assert [d for docs, _ in groups for d in docs] == list(range(402))
        assert [t for _, some in groups for t in some.to_pylist()] == [t or "" for t in texts]
        assert 40 < len(groups) < 60 and all(sum(map(len, some.to_pylist()[:-1])) <= 1000 for _, some in groups)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    g = np.random.default_rng(3)
    for ids in (np.array([0], "<u4"), g.integers(0, 2**32, 1001).astype("<u4"), g.integers(0, 50000, 4096).astype("<u4"), np.zeros(9, "<u4")):
        lengths, raw = planes.pack(ids, kind)
        assert len(lengths) == (4 if kind == "byte" else 32) and sum(lengths) == len(raw)
        assert (planes.unpack(lengths, raw, len(ids), kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_give_back_every_document(spark, documents, kind):
    from tokenizers import Tokenizer

    rows = [(100 - i, x) for i, x in enumerate(ODD)] + [(3, None), (7, "same id"), (7, "same id, other")]
    path = scratch_path(spark, "t")
    planes.write(documents(rows), path, vocab, block=64, kind=kind)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in planes.read_digest(spark, path).collect())
    t, at, want = Tokenizer.from_file(vocab), 0, []
    ids_of = {}
    for d, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        ids_of.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for start, d, n, crc in got:
        assert start == at and (n, crc) in ids_of[d]
        ids_of[d].remove((n, crc))
        at += n
    assert not any(ids_of.values()) and [d for _, d, _, _ in got] == sorted(d for d, _ in rows)
    index = planes.read_chunks(spark, path).select("shard", "chunk", "first", "n_ids").collect()
    assert all(r["n_ids"] <= 64 for r in index) and sum(r["n_ids"] for r in index) == at


def test_empty_table(spark, documents):
    path = scratch_path(spark, "t")
    planes.write(documents([(1, "x")]).where("false"), path, vocab)
    assert planes.read_digest(spark, path).count() == 0


def test_joined_checksums():
    a, b = b"some bytes" * 99, b"\x00\x01 others"
    assert planes.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert planes.crc_join(0, zlib.crc32(b), len(b)) == zlib.crc32(b)
