"""Host rules against a plain re-count, and their defined results."""

import random
import re

from civicstat.llm import host_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts_match_a_plain_count(frame, edge_rows):
    rng = random.Random(10)
    texts = ["\n".join(" ".join(rng.choice("ab c# d$ e".split()) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(5))) for _ in range(120)]
    rows = [(i, t, f"h{i % 4}") for i, t in enumerate(texts)] + [(1000 + i, t, None) for i, (_, t) in enumerate(edge_rows[:13])]
    got = host_rules.judge(frame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    want = {i: counts(t) for i, t, _ in rows if t is None or len(t) < 6000}
    for r in got:
        if r.doc_id in want:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id], r
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_a_bad_host_takes_its_good_documents_with_it_and_a_small_one_is_shrunk(frame):
    def good(i):
        return " ".join(f"w{i}x{j}" for j in range(20))
    rows = [(i, good(i), "good") for i in range(200)] + [(1000 + i, "no", "bad") for i in range(95)] + [(2000 + i, good(i), "bad") for i in range(5)]
    rows += [(3000 + h, good(h), f"h{h}") for h in range(30)] + [(4000, "no", "tiny")]
    got = {r.doc_id: r for r in host_rules.judge(frame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].kept for i in range(200))
    assert not any(got[2000 + i].kept for i in range(5))
    assert not got[4000].kept


def test_empty_table_and_clashing_columns(spark, frame):
    schema = "doc_id long, text string, source string, host string, n_words int, g int, text2 string"
    assert host_rules.judge(spark.createDataFrame([], schema)).count() == 0
    row = (1, "a b c", "s", "x", 5, 6, "z")
    got = host_rules.judge(frame([row, row], schema)).collect()
    assert [r.n_words for r in got] == [3, 3]
