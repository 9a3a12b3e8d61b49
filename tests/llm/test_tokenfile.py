"""Round trips of blocks, segments and files; ids against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from civicstat.llm import tokenfile
from tests.llm.test_bpe import HARD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(PATH)


def test_blocks():
    rng = np.random.default_rng(8)
    blocks = [np.array([5]), np.zeros(0, int), np.arange(300) % 7, rng.integers(0, 50257, 500), rng.integers(0, 50, 4000), np.full(3000, 50256), np.zeros(2000, int),
              rng.integers(0, 1 << 17, 3000), np.array([(1 << 17) - 1] * 9), np.repeat(rng.integers(0, 1 << 17, 60), 50), np.arange(1024, 1024 + 400), np.full(70_000, 3)]
    coded = tokenfile.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, tokenfile.decode_blocks(coded, [len(b) for b in blocks])))
    alone = [tokenfile.encode_blocks([b])[0] for b in blocks]
    assert alone == coded  # a block doesn't depend on those beside it
    assert len(coded[2]) < 100 and len(coded[-1]) < 2000


def test_segments_have_checksums(monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 100)
    ids = np.random.default_rng(1).integers(0, 50257, 1234)
    data = tokenfile.pack(ids)
    assert np.array_equal(tokenfile.unpack(data), ids)
    for at in (0, len(data) // 2, len(data) - 20, 30):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            tokenfile.unpack(bytes(broken))


def test_ids_match_the_library():
    rng = random.Random(1)
    own, lib = tokenfile._Tokenizer(open(PATH, encoding="utf-8").read()), library()
    letters = "ab .,\n\t'1éñ\xa0 sS!"
    texts = [*HARD, *("".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500))]
    for t, ids in zip(texts, own.ids(texts)):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_files(frame, edge_rows, spark, tmp_path):
    rng = random.Random(8)
    rows = edge_rows + [(200 + i, " ".join(rng.choice(["the", "thing", "of", "Bleereat."]) for _ in range(rng.randrange(80)))) for i in range(100)]
    path = str(tmp_path / "ids")
    tokenfile.write(frame(rows), path, PATH, end_id=9, segment_ids=500)
    assert spark.read.parquet(path).count() > 5
    got = tokenfile.read(spark, path).orderBy("start").collect()
    lib = library()
    want = sorted(((i is not None, i or 0, np.array([*lib.encode(t or "", add_special_tokens=False).ids, 9], "<u4").tobytes()) for i, t in rows))
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_ids for r in got)])[:-1].tolist()
    assert all(r.n_ids * 4 == len(r.ids) for r in got)
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)


def test_empty_table_and_further_columns(spark, frame):
    schema = "doc_id long, text string, tie int, data string, start int"
    assert tokenfile.round_trip(spark.createDataFrame([], schema), PATH).count() == 0
    assert tokenfile.round_trip(frame([(4, "one two", 1, "d", 2)], schema), PATH).first().n_ids == 3


def test_special_tokens_are_the_librarys(frame):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "<|endoftext|> <|endoftext|>.", "a  <|endoftext|>  b\n<|endoftext|>", "<|endoftext", "w <|endoftext|>."]
    own = library()
    assert own.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tokenfile.round_trip(frame(list(enumerate(texts))), PATH).collect()}
    assert got == {i: own.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


def test_ids_out_of_range_are_refused():
    for bad in (1 << 17, -1):
        with pytest.raises(ValueError, match="id"):
            tokenfile.encode_blocks([np.array([1, 2]), np.array([bad])])
