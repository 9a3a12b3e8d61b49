"""Code lengths against a plain escape chain, held-out accuracy, defined results."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from civicstat.llm import langid

DATA = "/root/testdata/sf0.01"


def grams(lang, texts):
    rows = Counter()
    for t in texts:
        for k in range(langid.ORDER + 1):
            for i in range(k, len(t)):
                rows[lang, k, int.from_bytes(t[i - k:i + 1], "big")] += 1
    return [(*key, n) for key, n in rows.items()]


def plain_bits(texts, text):
    """Bits of ``text`` by the counts of ``texts``, all contexts kept."""
    follow = defaultdict(Counter)
    for t in texts:
        for k in range(langid.ORDER + 1):
            for i in range(k, len(t)):
                follow[t[i - k:i]][t[i]] += 1
    bits = 0.0
    for i, c in enumerate(text):
        p = 1.0
        for k in range(min(langid.ORDER, i), -1, -1):
            seen = follow.get(text[i - k:i])
            if not seen:
                continue
            n, u = sum(seen.values()), len(seen)
            if seen[c]:
                p *= seen[c] / (n + u)
                break
            p *= u / (n + u)
        else:
            p /= 256
        bits -= math.log2(p)
    return bits


def test_code_lengths_match_the_escape_chain(monkeypatch):
    rng = random.Random(3)
    corpora = {"x": [bytes(rng.choice(b"abc ") for _ in range(80)) for _ in range(5)], "y": [bytes(rng.choice(b"cde ") for _ in range(80)) for _ in range(5)]}
    model = langid.build(pd.DataFrame(sum((grams(k, v) for k, v in corpora.items()), []), columns=["lang", "order", "gram", "n"]), nodes=100_000)
    texts = [b"", b"a", b"zz", b"abc cab", b"ecd \xc3\xa9 dd", *corpora["x"][:2], bytes(rng.choice(b"abcdez") for _ in range(300))]
    want = np.array([[plain_bits(corpora[k], t) for k in model.langs] for t in texts])
    # a context that only the other language has seen is passed over, as in the plain chain
    assert np.allclose(model.lengths(texts), want, rtol=1e-4, atol=1e-3)
    whole = model.lengths(texts)
    monkeypatch.setattr(langid, "CHUNK", 16)
    assert np.allclose(model.lengths(texts), whole, rtol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.train(docs, "doc_id", "text", "lang", langid.fold("doc_id") != 2)
    got = langid.predict(docs.where(langid.fold("doc_id") == 2), model, "doc_id", "text").join(docs.select("doc_id", "lang"), "doc_id").collect()
    told = [r for r in got if r.lang_pred != "und"]
    assert len(told) > 200 and sum(r.lang == r.lang_pred for r in told) >= 0.99 * len(told)


def test_labels_sources_and_ids_are_no_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
    model = langid.train(docs, "doc_id", "text", "lang", langid.fold("doc_id") != 2)
    first = {r.doc_id: r.lang_pred for r in langid.predict(docs, model, "doc_id", "text").collect()}
    other = docs.selectExpr("doc_id + 7 AS doc_id", "text", "'zz' AS lang", "'' AS source")
    assert {r.doc_id - 7: r.lang_pred for r in langid.predict(other, model, "doc_id", "text").collect()} == first
    docs.unpersist()


@pytest.fixture
def learned():
    return langid.build(pd.DataFrame(grams("aa", [b"aba abab"] * 3) + grams("bb", [b"xyx yxyx"] * 3), columns=["lang", "order", "gram", "n"]))


def test_edges(frame, edge_rows, learned):
    got = langid.predict(frame(edge_rows), learned, "doc_id", "text").collect()
    assert len(got) == len(edge_rows)
    letters = sorted((str(i), any(c.isalpha() for c in t or "")) for i, t in edge_rows)
    assert sorted((str(r.doc_id), r.lang_pred != "und") for r in got) == letters
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in got)


def test_nothing_to_learn_from(frame, spark):
    rows = frame([(1, "some text", None), (None, "text", "en")], "doc_id long, text string, lang string")
    assert langid.train(rows, "doc_id", "text", "lang", langid.fold("doc_id") != 2) is None
    assert {r.lang_pred for r in langid.predict(rows, None, "doc_id", "text").collect()} == {"und"}
    assert langid.identified(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_identified_keeps_columns_and_clear_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("*", "1 AS score", "'q' AS lang_pred", "2 AS __text")
    got = langid.identified(docs)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert got.count() >= 0.98 * docs.where("length(text) > 20").count()


def test_a_long_text_is_scored_in_little_memory():
    rng = np.random.default_rng(3)
    langs, symbols = ["a", "b", "c", "d", "e"], 4
    symbol = rng.integers(0, symbols, 256).astype(np.int32)
    model = langid.Model(langs, symbol, symbols, np.arange(symbols**langid.ORDER, dtype=np.int32), rng.random((symbols**(langid.ORDER + 1), len(langs))).astype(np.float32))
    texts = [b"", b"x", rng.bytes(3 * langid.CHUNK + 5), b"", rng.bytes(langid.PIECE), b"yz"]
    tracemalloc.start()
    got = model.lengths(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 12 * sum(map(len, texts))
    for text, own in zip(texts, got):
        s = np.append(np.zeros(langid.ORDER, np.int64), symbol[np.frombuffer(text, np.uint8)])
        value = sum(s[langid.ORDER - back:len(s) - back] * symbols**back for back in range(langid.ORDER + 1))
        assert np.allclose(own, model.bits[value].sum(0, dtype=np.float64), rtol=1e-9)
