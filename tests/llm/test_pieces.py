"""Ids and decoded texts against the sentencepiece library; defined results; models that don't fit."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from civicstat.llm import pieces
from civicstat.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["a  b", " a", "a ", "   ", " ", "a\n  b", "▁a ▁", "\x00x", "e　f", "<s> a</s> <unk> <0x41>", "퟿ z", "😀 👩‍👩‍👧 end", "日本 テ  日", "123 4567", "a\tb\r\nc",
        " " * 70 + "x" + " " * 33, "the " * 50, "don't stop. .", "ß" * 300, " a b ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(n):
    rng = random.Random(13)
    letters = "ab  the.,\n\t'19éñ\xa0 ▁sStheinghrouß日😀"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_ids_and_decoding_match_the_library(frame, edge_rows, library):
    texts = HARD + [t for _, t in edge_rows] + random_texts(400)
    got = pieces.encode(frame(list(enumerate(texts))), PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "")
        assert r.token_ids == ids, repr(texts[r.doc_id])
        assert bytes(r.decoded).decode() == library.decode(ids)


def test_query_on_a_given_table(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = QUERIES["op13_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table_null_ids_and_further_columns(spark, frame):
    schema = "doc_id long, text string, block long, chunk string, place int, pieces string"
    assert pieces.encode(spark.createDataFrame([], schema), PATH).count() == 0
    got = pieces.encode(frame([(None, "one", 1, "c", 2, "p")] * 2 + [(None, None, 1, "c", 2, "p")], schema), PATH).collect()
    assert sorted((r.doc_id is None, bytes(r.decoded)) for r in got) == [(True, b""), (True, b"one"), (True, b"one")]
    only_empty = pieces.encode(frame([(1, ""), (2, None)]), PATH).collect()
    assert sorted((r.doc_id, r.token_ids, bytes(r.decoded)) for r in only_empty) == [(1, [], b""), (2, [], b"")]


def test_long_texts_and_a_frequent_chunk(frame, library):
    texts = ["same " * 30_000, "x" * 50_000, "日" * 20_000, "a b " * 40_000]
    got = {r.doc_id: r.token_ids for r in pieces.encode(frame(list(enumerate(texts))), PATH).collect()}
    assert got == {i: library.encode(t) for i, t in enumerate(texts)}


def test_a_table_that_starts_anew(monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_CHARS", 50)
    model = pieces.read_model(PATH)
    texts = random_texts(60)
    held = type("Held", (), {"value": model})
    batch = pieces.pa.RecordBatch.from_arrays([pieces.pa.array(range(60)), pieces.pa.array(texts)], ["id", "text"])
    got = [ids for b in pieces._encode(held)([batch]) for ids in b.column("token_ids").to_pylist()]
    assert got == library.encode(texts)


def test_parts_are_cut_where_no_piece_crosses(library):
    model = pieces.read_model(PATH)
    for text in random_texts(300):
        for c in pieces.chunks(text):
            assert sum((model.segment(p) for p in model.parts(c)), []) == model.segment(pieces.MARK + c.replace(" ", pieces.MARK))


def test_a_model_whose_pieces_cross_markers_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.pieces[1000].piece = "a" + pieces.MARK + "b"
    path = tmp_path / "crossing.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        pieces.read_model(str(path))
