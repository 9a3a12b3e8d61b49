"""Token ids against the tiktoken library, decoding, defined results."""

import gc
import random
import tracemalloc

import public_tokenizers
import pytest
import tiktoken

from civicstat.llm import bpe, common

PATHS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
HARD = ["a  b", "a \n b", "  lead", "trail ", "trail  ", "x\n\ny z", "\tq r\xa0 s", "can't we'll I'M it's", "日本 語 text", "e f　g", " ", " a", "\n", "a. b, c.. d.,",
        "<|endoftext|> x", "é. ñ, 12. 3,4", "x\r\n y", "\x1c \x1d a", "tab\t end", "😀😀 👩‍👩‍👧", "a" * 700, "ab" * 400 + " " + "é" * 300, "0" * 500]


def library(name):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", PATHS)
def test_ids_match_the_library(frame, edge_rows, name):
    rng = random.Random(2)
    letters = "ab .,\n\t'1éñ\xa0 sStheinghrouß日"
    texts = HARD + [t for _, t in edge_rows] + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    got = bpe.encode(frame(list(enumerate(texts))), public_tokenizers.path(name), public_tokenizers.PATTERN, block_chars=4000).collect()
    assert len(got) == len(texts)
    own = library(name)
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.token_ids == own.encode_ordinary(text), repr(text)
        assert bytes(r.decoded) == text.encode()


def test_long_words_merge_as_folds_do():
    rng = random.Random(3)
    own = library(PATHS[0])
    ranks = bpe.read_ranks(public_tokenizers.path(PATHS[0]))
    for _ in range(300):
        word = bytes(rng.choice(b"theinagor") for _ in range(rng.randrange(1, 60)))
        assert own.decode_bytes(bpe.merge(word, ranks)) == word
        if word not in ranks:
            assert bpe.merge(word, ranks) == own.encode_ordinary(word.decode())


def test_empty_table_null_ids_and_further_columns(spark, frame):
    path = public_tokenizers.path(PATHS[0])
    schema = "doc_id long, text string, ids string, codes int, folded int"
    assert bpe.encode(spark.createDataFrame([], schema), path, public_tokenizers.PATTERN).count() == 0
    got = bpe.encode(frame([(None, "one", "i", 1, 2)] * 2, schema), path, public_tokenizers.PATTERN).collect()
    assert [(r.doc_id, bytes(r.decoded)) for r in got] == [(None, b"one")] * 2


def test_numbers_that_start_anew(frame, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("theinagor") for _ in range(rng.randrange(1, 14))) for _ in range(40)) for _ in range(60)]
    own, pieces = library(PATHS[0]), bpe.read_ranks(public_tokenizers.path(PATHS[0]))
    held = lambda x: type("Held", (), {"value": x})
    monkeypatch.setattr(bpe, "TABLE_CHARS", 900)
    batch = bpe.pa.RecordBatch.from_arrays([bpe.pa.array(range(60)), bpe.pa.array(texts)], ["id", "text"])
    rows = list(bpe._blocks(held(pieces), public_tokenizers.PATTERN, 500)([batch]))
    assert len(rows) > 10 and sum(r.column("base")[0].as_py() == 0 for r in rows) > 3
    folded = []
    for r in rows:
        words = [[*map(int, bpe.merge(bytes(w), pieces))] for w in r.column("words")[0].as_py()]
        folded.append(r.drop_columns(["words"]).append_column("folded", bpe.pa.array([words], bpe.pa.list_(bpe.pa.list_(bpe.pa.int32())))))
    got = [ids for b in bpe._documents(held({r: t for t, r in pieces.items()}))(folded) for ids in b.column("token_ids").to_pylist()]
    assert got == [own.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("name", PATHS)
def test_one_pair_for_each_token_is_enough(name):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    pairs = bpe.merges(ranks)
    assert len(set(pairs.values())) == len(pairs)
    rng = random.Random(5)
    for _ in range(300):
        word = bytes(rng.choice(b"theinagors \xc3\xa9") for _ in range(rng.randrange(1, 30)))
        ids = [ranks[word[i:i + 1]] for i in range(len(word))]
        while found := [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]:
            rank, i = min(found)
            ids[i:i + 2] = [rank]
        assert ids == bpe.merge(word, ranks)


def test_words_keep_their_numbers_when_chunks_start_anew(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("theinagor\n" + str(rng.randrange(10, 100)) for _ in range(30)) + " xqzjw kvxqjz" for _ in range(40)]
    own, pieces = library(PATHS[0]), bpe.read_ranks(public_tokenizers.path(PATHS[0]))
    held = lambda x: type("Held", (), {"value": x})
    monkeypatch.setattr(bpe, "TABLE_CHARS", 600)
    batch = bpe.pa.RecordBatch.from_arrays([bpe.pa.array(range(40)), bpe.pa.array(texts)], ["id", "text"])
    rows = list(bpe._blocks(held(pieces), public_tokenizers.PATTERN, 500)([batch]))
    words = [bytes(w) for r in rows for w in r.column("words")[0].as_py()]
    assert len(rows) > 10 and sum(r.column("base")[0].as_py() == 0 for r in rows) == 1
    assert b" theinagor" in words and len(words) == len(set(words))
    folded, done = [], 0
    for r in rows:
        n = len(r.column("words")[0])
        folded.append(r.drop_columns(["words"]).append_column("folded", bpe.pa.array([[bpe.merge(w, pieces) for w in words[done:done + n]]], bpe.pa.list_(bpe.pa.list_(bpe.pa.int32())))))
        done += n
    got = [(ids, text) for b in bpe._documents(held({r: t for t, r in pieces.items()}))(folded) for ids, text in zip(b.column("token_ids").to_pylist(), b.column("decoded").to_pylist())]
    assert got == [(own.encode_ordinary(t), t.encode()) for t in texts]


@pytest.mark.parametrize("name", PATHS)
def test_first_merges_are_merges_of_the_word(name):
    ranks = bpe.read_ranks(public_tokenizers.path(name))
    pairs, rng = bpe.merges(ranks), random.Random(7)
    words = [b"", b"a", b"aaaa", b"th", b" the"] + [bytes(rng.choice(b"theinagors \xc3\xa9") for _ in range(rng.randrange(30))) for _ in range(400)]
    rows = [[list(w) for w in part] for part in (words, [], words[:3], [b""])]
    batch = bpe.pa.RecordBatch.from_arrays([bpe.pa.array(range(4)), bpe.pa.array(rows, bpe.pa.list_(bpe.pa.list_(bpe.pa.int16())))], ["base", "words"])
    got = [row for b in bpe._first_merges(ranks)([batch.slice(0, 1), batch.slice(1)]) for row in b.column("words").to_pylist()]
    assert [len(row) for row in got] == [len(row) for row in rows] and got[2] == got[0][:3]
    assert sum(map(len, got[0])) < 0.9 * sum(map(len, words))
    for word, ids in zip(words, got[0]):
        while found := [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]:
            rank, i = min(found)
            ids[i:i + 2] = [rank]
        assert ids == bpe.merge(word, ranks)


def test_a_task_leaves_nothing_to_the_collector():
    class Ranks:
        value = bpe.read_ranks(public_tokenizers.path(PATHS[0]))

    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("theinagors") for _ in range(9)) for _ in range(500)) for _ in range(100)]
    batch = bpe.pa.RecordBatch.from_arrays([bpe.pa.array(range(100)), bpe.pa.array(texts)], ["id", "text"])
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        assert len([b.num_rows for b in bpe._blocks(Ranks, public_tokenizers.PATTERN, 40_000)([batch])]) > 5
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
        gc.enable()
    assert held < most / 10


def test_unused_memory_goes_back_when_a_stream_ends(monkeypatch):
    done = []

    class Pool:
        def release_unused(self):
            done.append(True)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    rows = common.released(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(rows) == 2 and not done
    assert list(rows) == [3] and done
