"""The manifest against a plain recursion and against SQL; proofs; defined results."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from civicstat.llm import merkle
from civicstat.llm.queries import QUERIES, SQL

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root and, for each node, its siblings a level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i - i % 3:i - i % 3 + 3]
            paths[leaf].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
            at[leaf] = i // 3
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for d, t, lang, s, n in rows:
        leaf = h(*map(enc, (d, s, lang, n, t)))
        later = leaf
        if d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and t is not None:
            later = h(*map(enc, (d, s, lang, n, t.replace("\n", ""))))
        groups.setdefault(s, []).append((d is not None, d or 0, leaf, later, d))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, _, leaf, later, d), own in zip(sorted(groups[s]), trees[s][1]):
            path, now = own + top, later
            for b, a in path:
                now = h(b, now, a)
            out.append((d, leaf, trees[s][0], root, h(*[b + a for b, a in path]), now, now == root))
    return out


def found(df):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle.verify(df, FIELDS, {"text": tampered})
    got = got.select("id", "leaf", "subroot", "root", F.sha2(merkle.proof_text("path"), 256), "folded_root", "verified")
    return sorted(map(tuple, got.collect()), key=str)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    out, d = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            d += rng.randrange(1, 4)
            out.append((d, rng.choice([None, "", "a\nb", "text é\n", "plain"]), rng.choice([None, "en"]), s, rng.choice([None, 5])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {None: 1, "a": 2, "b": 3, "é": 4, "zz": 9, "": 10, "B": 28}, {"hot": 2300, "x": 730, "y": 729, "z": 1}, {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_manifest_against_a_plain_recursion(spark, frame, sizes):
    rows = rows_of(sizes)
    got = found(frame(rows, SCHEMA, 4))
    assert got == sorted(plain(rows), key=str)
    assert {True, False} == {r[-1] for r in got} or len(rows) < 10


def test_more_than_two_passes(monkeypatch, frame):
    monkeypatch.setattr(merkle, "SPAN", 2)
    rows = rows_of({"a": 200, "b": 9, "c": 10, None: 1} | {f"t{i}": 2 for i in range(30)})
    assert found(frame(rows, SCHEMA, 3)) == sorted(plain(rows), key=str)


def test_nulls_repeated_rows_and_ties(frame):
    rows = [(7, "same", "en", "s", 4)] * 40 + [(None, "n\n", None, None, None)] * 3 + [(7, "other", None, "s", 1), (8, None, None, "s", None), (None, "", "", "", 0)]
    assert found(frame(rows, SCHEMA)) == sorted(plain(rows), key=str)


def test_empty_table_further_columns_and_long_texts(spark, frame):
    schema = SCHEMA + ", tree string, digest int, idx int, root string, kids string"
    assert found(spark.createDataFrame([], schema)) == []
    rows = [(i, "x\n" * 50_000, "en", "s", 1) for i in range(5)]
    assert found(frame([r + ("t", 1, 2, "r", "k") for r in rows], schema)) == sorted(plain(rows), key=str)


def test_query_against_sql(spark):
    documents = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{documents}')")
    cur = con.execute(SQL["op12_merkle_manifest"])
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall(), key=str)
    got = QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == want
    assert {True, False} == {r[-1] for r in want}
