"""The search against an exhaustive one and a dynamic program; the query against SQL; defined results."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from civicstat.llm import repair
from civicstat.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def moves(row, state):
    initial, fault = row
    yield "D", 4, state
    if fault not in (1, 2):
        more = 3 if fault == 3 else 0
        for letter in "sua":
            if (state, letter) in repair.NEXT:
                if letter == initial:
                    yield "K", more, repair.NEXT[state, letter]
                if letter != "s":
                    yield "R", 3 + more, repair.NEXT[state, letter]


def plain(read):
    """Cost and initials by a dynamic program over rows and states."""
    def gaps(best):
        out = dict(best)
        for _ in range(2):
            for state, (cost, names) in list(out.items()):
                for letter in "ua":
                    after = repair.NEXT.get((state, letter))
                    if after is not None:
                        own = (cost + 3, names + "I")
                        out[after] = min(out.get(after, own), own)
        return out
    best = gaps({0: (0, "")})
    for row in read:
        after = {}
        for state, (cost, names) in best.items():
            for name, more, to in moves(row, state):
                own = (cost + more, names + name)
                after[to] = min(after.get(to, own), own)
        best = gaps(after)
    return min(best[s] for s in (0, 3) if s in best)


def code(initial, fault):
    return chr(repair.FIRST + 4 * ("sua".find(initial) if initial in "sua" and initial else 3) + fault)


def test_search_against_all_lists_of_edits():
    def every(read, state, left):
        """All ways to the end that cost no more than ``left``."""
        if not read and state in (0, 3):
            yield 0, ""
        for letter in "ua":
            after = repair.NEXT.get((state, letter))
            if after is not None and left >= 3:
                for cost, names in every(read, after, left - 3):
                    yield cost + 3, "I" + names
        if read:
            for name, more, to in moves(read[0], state):
                if more <= left:
                    for cost, names in every(read[1:], to, left - more):
                        yield cost + more, name + names
    kinds = [("s", 0), ("u", 0), ("a", 0), ("u", 1), ("a", 3), ("s", 3), ("t", 0)]
    for n in range(4):
        for read in itertools.product(kinds, repeat=n):
            want = min(every(read, 0, 13))
            assert repair.search("".join(code(*r) for r in read)) == want == plain(read), read


def test_pieces_of_long_conversations(monkeypatch):
    rng = random.Random(11)
    for size in (3, 7):
        monkeypatch.setattr(repair, "PIECE", size)
        for _ in range(150):
            read = [(rng.choice("sssuuuaaat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(30))]
            assert repair.repair("".join(code(*r) for r in read)) == plain(read)


def test_a_very_long_conversation():
    rng = random.Random(12)
    read = [("ua"[i % 2], rng.choice([0] * 8 + [1, 2, 3])) for i in range(5000) if rng.random() > 0.05]
    assert repair.repair("".join(code(*r) for r in read)) == plain(read)


def damaged(rows):
    """Rows after damage in order: conv -> [(turn, role, text)]."""
    out = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            here += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for here in out.values():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{r[1]}\x00{r[2]}".encode()).hexdigest()))
    return out


def whole(rows):
    """The query's rows, plainly."""
    out = []
    for conv, here in damaged(rows).items():
        read, seen = [], set()
        for _, role, text in here:
            left = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 1 if not left else 2 if (role, text) in seen else 0 if left[-1] in ".!?" else 3
            seen.add((role, text))
            read.append((role[:1] if role[:1] in ("s", "u", "a") else "", fault))
        cost, audit = plain(read)
        state, lines, todo = 0, [], iter(here)
        for name in audit:
            _, role, text = (None, None, "") if name == "I" else next(todo)
            if name != "D":
                role = role if name == "K" else "assistant" if state == 2 else "user"
                lines.append(f"{role}:{text}")
                state = repair.NEXT[state, role[0]]
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, f in read]
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(read, read[1:]))
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:9] for r in repair.repaired(df).collect()), key=str)


def rows_of(n, seed, longest=9):
    rng = random.Random(seed)
    texts = ["Fine.", "Well?", "no end", "", " \n", None, "tab.\t", "é!", "a.b", "Fine."]
    out = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            out.append((conv if conv else None, None if rng.random() < 0.05 else turn + (turn > 3), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(texts)))
    return out


@pytest.mark.parametrize("seed,longest", [(1, 9), (2, 200)])
def test_random_conversations_against_a_plain_version(frame, seed, longest):
    rows = rows_of(120 if longest < 10 else 8, seed, longest)
    assert found(frame(rows, SCHEMA, 5)) == whole(rows)


def test_ties_and_repeated_rows(frame):
    rows = [(1, 1, "user", "Same.")] * 70 + [(1, 2, "assistant", "b."), (1, 2, "assistant", "a."), (2, None, None, None), (2, None, "user", "x.")] * 2
    assert found(frame(rows, SCHEMA, 5)) == whole(rows)


def test_all_rows_dropped_empty_table_and_further_columns(spark, frame):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    schema = SCHEMA + ", conv string, audit string, code int, dropped string, at int"
    got = repair.repaired(frame([(gone, 0, "user", "x.", "a", "b", 1, "c", 2)], schema)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY, 0)]
    assert repair.repaired(spark.createDataFrame([], schema)).collect() == []


def test_rows_as_they_are_and_long_texts(frame):
    rows = [(5, 0, "user", "Ask " * 50_000 + "?"), (5, 1, "assistant", "x" * 100_000), (5, 2, "user", " " * 50_000 + ".")]
    r = repair.repaired(frame(rows, SCHEMA), faults=None).collect()[0]
    assert (r.truncated, r.cost, r.audit, r.rows) == (1, *plain([("u", 0), ("a", 3), ("u", 0)]), 2 if r.audit == "KKD" else 4)


def test_a_conversation_over_many_partitions(spark):
    rows = [(1 if i % 3 else i, i, ["user", "assistant"][i % 2], f"t{i % 50}" + "." * (i % 7 > 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(df) == whole(rows)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/sf0.01/conversations.parquet')")
    cur = con.execute(SQL["op11_conversation_repair"])
    names = [c[0] for c in cur.description]
    got = QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.01")
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(cur.fetchall(), key=str)
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select(*[F.col(c) for c in ("conv_id", "turn", "role", "text")])
    assert found(table) == whole([tuple(r) for r in table.collect()])
