"""The pipeline's stages against plain versions, and the registered queries against their SQL."""

import re

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from civicstat.llm import bpe, queries
from tests.llm.test_simhash import plain_classes, plain_fingerprint

DATA = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations embeddings".split()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        step(spark, frames[-1], DATA).write.parquet(path)
        frames.append(spark.read.parquet(path))
    assert all(f.columns == columns for f in frames[:-1]) and 4 <= len(corpus_pipeline.STAGES) <= 5
    told, single, clean, private, encoded = ({r.doc_id: r for r in f.collect()} for f in frames[1:])
    before = {r.doc_id: r.text for r in docs.collect()}
    assert set(told) == {i for i, t in before.items() if any(c.isalpha() for c in t or "")}
    ids = sorted(told)
    label = plain_classes([plain_fingerprint(told[i].text) for i in ids])
    first = {}
    for i, x in zip(ids, label):
        first.setdefault(x, i)
    assert set(single) == set(first.values())
    items = [r.text.lower() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(clean) == {i for i, r in single.items() if not any(b in r.text.lower() for b in items)}
    assert set(private) == set(clean)
    mark = re.compile(r"[\w.]+@[\w.]+\.\w+|\b\d{16}\b|\bAKIA\w{16}\b|\(\d{3}\) \d{3}-\d{4}|password=\w+")
    for i, r in private.items():
        for found in mark.findall(clean[i].text):
            assert found not in r.text
        if not re.search(r"[\d@=]", clean[i].text):
            assert r.text == clean[i].text
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert {i: r.n_tokens for i, r in encoded.items()} == {i: len(own.encode_ordinary(r.text)) for i, r in private.items()}


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < got.count() < 200


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_all_queries_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
