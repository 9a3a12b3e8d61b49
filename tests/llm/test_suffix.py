"""Removal of repeated byte strings against a set of all strings."""

import random

from civicstat.llm import suffix


def plain(rows, length=100):
    """kept bytes by (id, text); rows in the operator's order, equal rows are one document."""
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        out[i, t or ""] = bytes(c for c, g in zip(b, gone) if not g)
    return out


def held(frame, rows):
    got = suffix.dedup(frame(rows)).collect()
    assert len(got) == len(rows)
    want = plain(sorted(set((i, t or "") for i, t in rows)))
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == sorted((i, len((t or "").encode()), want[i, t or ""]) for i, t in rows)
    for r in got:
        assert r.n_bytes - sum(s.end - s.start for s in r.spans) == len(r.kept)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_copies_edits_and_shared_passages(frame):
    rng = random.Random(6)

    def prose(n):
        return "".join(rng.choice("abcde é\n") for _ in range(n))

    base, line, long = prose(1500), prose(70), prose(240)
    rows = [(i, prose(rng.randrange(400)) + (line if i % 2 else long) + prose(rng.randrange(400))) for i in range(30)]
    for i in range(30, 60):
        t = list(base)
        for _ in range(rng.randrange(12)):
            t[rng.randrange(len(t))] = "#"
        rows.append((i, "".join(t)[rng.randrange(200):]))
    rows += [(60, base + base), (61, "ab" * 700), (62, "a" * 1000), (63, base[:100]), (64, base[:99])]
    held(frame, rows)


def test_edge_texts_and_repeated_rows(frame):
    rows = [(0, None), (1, ""), (2, "x" * 100), (3, "x" * 99), (4, "é" * 90), (5, "q" * 100), (5, "q" * 100), (6, "a" * 250)]
    held(frame, rows)


def test_ids_that_repeat_and_null_ids(frame):
    text, other = "".join(map(str, range(90))), "".join(map(str, range(200, 260)))
    got = suffix.dedup(frame([(None, text), (1, text), (1, other), (2, other)])).collect()
    assert sorted((r.doc_id is None, r.n_bytes, len(r.kept)) for r in got) == sorted([(True, len(text), len(text)), (False, len(text), 0), (False, len(other), len(other)), (False, len(other), 0)])


def test_pieces_of_a_long_text(frame, monkeypatch):
    rng = random.Random(3)
    part = "".join(rng.choice("abcdefgh") for _ in range(900))
    monkeypatch.setattr(suffix, "PIECE", 256)
    texts = [(part + "|" + part[200:] + part[::-1]).encode(), part[50:700].encode()]
    rows = list(suffix._pieces(texts))
    assert len(rows) > 4 and {r[0][0] for r in rows} == {0, 1}
    covered = {(r[0][0], first + at + k) for r in rows for first in r[1] for d, a, n, *_ in [suffix.anchors(r[2], r[3], r[4])] for at, m in zip(a, n) for k in range(m)}
    assert covered == {(i, s) for i, t in enumerate(texts) for s in range(len(t) - 99)}


def test_empty_table(spark):
    assert suffix.dedup(spark.createDataFrame([], "doc_id long, text string, spans string, kept int")).count() == 0
