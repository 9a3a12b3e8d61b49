"""Passages against exact edit distances, the recall of the buckets, defined results."""

import random

import numpy as np
import pytest

from civicstat.llm import decontam


def plain_distance(item, text):
    """Least edits of item to any part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_distance():
    rng = random.Random(4)
    for _ in range(150):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randrange(60)))
        want, most = plain_distance(item, text), rng.randrange(12)
        got = decontam.distance(item, text, most)
        assert (got[0] if got else None) == (want if want <= most else None)


@pytest.mark.parametrize("length", [40, 50, 65, 79, 80, 150, 300])
def test_recall(length):
    assert decontam.recall(length, 0.0, 100) == 1.0
    assert decontam.recall(length, 0.05, 200) >= 0.97
    assert decontam.recall(length, 0.1, 200) >= 0.9


def prose(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))


def with_edits(item, k, rng):
    """``item`` with ``k`` random edits at places of their own."""
    out = list(item)
    for at in sorted(rng.sample(range(len(out)), k), reverse=True):
        out[at] = rng.choice(["", rng.choice("abcxyz "), out[at] + rng.choice("abcxyz ")])
    return "".join(out)


@pytest.mark.parametrize("length, least", [(1, 1), (5, 1), (9, 1), (10, 1), (19, 1), (20, 1), (29, 1), (39, 1), (40, 0.97), (45, 0.97), (60, 0.97), (79, 0.97), (80, 0.9), (120, 0.95)])
def test_items_with_as_many_edits_as_allowed(length, least):
    rng, caught = random.Random(length), 0
    for _ in range(100):
        item = prose(rng, length)
        text = prose(rng, rng.randrange(200)) + with_edits(item, length // 10, rng) + prose(rng, rng.randrange(200))
        got = decontam.Index([(0, item.encode())]).hits([b"", text.encode(), b""])
        caught += bool(got[1])
        assert not got[0] and not got[2]
        assert all(edits <= length // 10 for _, _, _, edits, _ in got[1])
    assert caught >= least * 100


def test_short_items_equal_all_distances():
    rng = random.Random(8)
    items = [(k, "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 40)))) for k in range(60)]
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randrange(60))) for _ in range(60)] + [t for _, t in items[:9]] + [""]
    index = decontam.Index([(k, t.encode()) for k, t in items])
    got = {(n, h[0]) for n, hits in enumerate(index.hits([t.encode() for t in texts])) for h in hits}
    want = {(n, k) for n, t in enumerate(texts) for k, i in items if plain_distance(i.encode(), t.encode()) <= len(i) // 10}
    assert got == want


def test_repeated_item_ids_have_their_own_lengths(frame, spark):
    rng = random.Random(9)
    short, long = prose(rng, 30), prose(rng, 200)
    bench = spark.createDataFrame([(1, short), (1, long)], "item_id long, text string")
    got = decontam.find(frame([(1, "-" + long[1:]), (2, short + "!" * 60)]), bench).collect()
    assert {(r.doc_id, r.edits, round(r.similarity, 4)) for r in got} == {(1, 1, 0.995), (2, 0, 1.0)}


def test_planted_passages_are_found_and_clean_texts_left(frame, spark):
    rng, np_rng = random.Random(5), np.random.default_rng(5)
    items = [(k, prose(rng, rng.randrange(80, 300))) for k in range(20)]
    rows, want = [], set()
    for i in range(300):
        text = prose(rng, rng.randrange(1500))
        if i % 3 == 0:
            k, item = rng.choice(items)
            if i % 2:
                item = decontam.edited(np.frombuffer(item.encode(), np.uint8), 0.04, np_rng).decode()
            text += item.upper() if i % 5 == 0 else item
            text += prose(rng, rng.randrange(200))
            want.add((i, k))
        rows.append((i, text))
    docs, bench = frame(rows), spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    text, item = dict(rows), dict(items)
    for r in got:
        assert r.edits == plain_distance(item[r.item_id].encode(), text[r.doc_id].lower().encode()[max(0, r.start - 60):r.end])
    clean = decontam.clean(docs, bench)
    assert {r.doc_id for r in clean.collect()} == set(text) - {i for i, _ in want}


def test_blocks_of_items_give_the_same(frame, spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, prose(rng, 120)) for k in range(9)]
    docs = frame([(i, prose(rng, 50) + items[i][1]) for i in range(9)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(decontam.find(docs, bench).collect())
    monkeypatch.setattr(decontam, "blocks", lambda b, i, t, most=300, f=decontam.blocks: f(b, i, t, most))
    assert sorted(decontam.find(docs, bench).collect()) == whole and len(whole) == 9
    assert decontam.clean(docs, bench).count() == 0


def test_edges(frame, spark, edge_rows):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "日本語"), (4, "x" * 60), (4, "x" * 60), (5, "word " * 12)], "item_id long, text string")
    docs = frame(edge_rows)
    got = {(str(r.doc_id), r.item_id) for r in decontam.find(docs, bench).collect()}
    want = {(str(i), k) for i, t in edge_rows for k, m in ((3, "日本語"), (4, "x" * 60), (5, "word " * 12)) if m in (t or "")}
    assert got == want
    assert decontam.clean(docs, bench).count() == sum(not any(m in (t or "") for m in ("日本語", "x" * 60, "word " * 12)) for _, t in edge_rows)


def test_empty_tables(spark, frame):
    none, some = spark.createDataFrame([], "doc_id long, text string, item int"), frame([(1, "text", 2)], "doc_id long, text string, item int")
    bench = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "t" * 90)], "item_id long, text string")
    assert decontam.find(some, bench).count() == 0 and decontam.find(none, one).count() == 0
    assert decontam.clean(some, bench).collect() == some.collect()
    assert decontam.clean(none, one).columns == none.columns
