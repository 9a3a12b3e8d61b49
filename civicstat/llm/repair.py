"""Repair of the structure of conversations by iterative-deepening A*.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Rows may be kept, given
another role (user or assistant), deleted, or have an empty user or assistant row inserted before
them or at the end; each edit has a cost, rows with a fault cost more or must go. The answer is the
cheapest list of edits, of equals the first in ASCII order of the edits' initials (D, I, K, R).

The search goes depth first in that order under a bound of the cost, which rises to the least cost
that was cut off. A table of failed states keeps, for each (row, state of the pattern), the least
cost that is known to be needed from there, so a state is searched again only with more to spend. It
starts as the sum of what the faults of the rows to come cost at least. The first path that reaches
the end in an accepting state is the answer.

A conversation is read as one character a row, which holds initial and fault. Long ones are cut into
pieces of ``PIECE`` rows: each piece is searched from the states that the pieces before it can end
in to each state it can end in, and the answers are strung together. Equally cheap edits of a piece
between the same two states are never one the beginning of the other, so the string of first answers
is the first answer.

In Spark:

- a first fault needs the earlier rows of a conversation only for duplicates, which are ranked among
  the rows of equal role and text;
- rows without their texts are sorted in range partitions, so a conversation with many rows is
  spread, and become character strings, one for each conversation and partition;
- strings are put together by conversation, one byte a row, and searched;
- texts are dealt by conversation and sorted behind their conversation's edits, and a stream over
  them digests the repaired text row by row. The digest of a conversation is one SHA-256, which has
  to be fed in order, so this stream is one task for each conversation, however long, but holds one
  row of it.

Defined results:

- a null id, turn, role or text is one space where it becomes text, so a null text is blank;
- rows of a conversation are ordered by turn (nulls first), then by role and a digest of role and
  text; repeated rows are duplicates of the first; null ids are one conversation;
- an initial is a role's first character, none for an empty role;
- a conversation without rows: zeros, no edits, the digest of the empty string; an empty table gives
  an empty result;
- only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicstat.llm.common import bounded_batches, stage

#: Rows that are searched at once.
PIECE = 48
#: Answers that a task remembers: short conversations often have the same characters.
REMEMBERED = 100_000
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

# A row's character: chr(FIRST + 4 * place of its initial in INITIALS + fault), faults 0 none, 1 blank, 2 duplicate, 3 truncated.
FIRST, INITIALS = 65, "sua"
#: State of the pattern and initial -> next state. 0: nothing read, 1: system, 2: a user waits for an answer, 3: answered.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTING = (0, 3)
#: State -> initial of the only role that an insertion or a new role can give.
GIVEN = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}


def _row(code: str) -> tuple[str, int]:
    place, fault = divmod(ord(code) - FIRST, 4)
    return INITIALS[place:place + 1], fault


def _reached(read: list[tuple[str, int]], start: int, end: int) -> bool:
    """Whether any edits lead from a state to another: no state comes before itself but by deletions."""
    if end == 1 and start == 0:
        return any(initial == "s" and fault in (0, 3) for initial, fault in read)
    return end > 1 or end == start


def search(rows: str, start: int = 0, ends: tuple[int, ...] = ACCEPTING) -> tuple[int, str] | None:
    """Cost and initials of the first cheapest edits of ``rows`` from state ``start`` to a state in ``ends``; None if there are none."""
    n = len(rows)
    read = [_row(c) for c in rows]
    if not any(_reached(read, start, end) for end in ends):
        return None
    # what the rows to come cost at least; only deletions stay in state 0 or 1, and one kept row leads from 0 to 1
    early = max(ends) < 2
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if early else (0, DELETE, DELETE, min(DELETE, TRUNCATED))[read[i][1]])
    if early and start not in ends:
        least = [max(0, x - DELETE) for x in least]
    need: dict[tuple[int, int], int] = {}  # the table of failed states

    def edits(i: int, state: int) -> list[tuple[str, int, int, int]]:
        """Edits of a state in ASCII order: initial, cost, next row, next state."""
        out = []
        given = NEXT[state, GIVEN[state]]
        if i < n:
            out.append(("D", DELETE, i + 1, state))
        out.append(("I", INSERT, i, given))
        if i < n:
            initial, fault = read[i]
            if fault not in (1, 2):
                more = TRUNCATED if fault == 3 else 0
                if (state, initial) in NEXT:
                    out.append(("K", more, i + 1, NEXT[state, initial]))
                if initial != GIVEN[state]:
                    out.append(("R", REROLE + more, i + 1, given))
        return out

    bound = least[0]
    while True:
        # depth first; a frame is [row, state, left to spend, edits, next edit, least cost that was cut off]
        frames = [[0, start, bound, edits(0, start), 0, None]]
        if n == 0 and start in ends:
            return 0, ""
        path: list[str] = []
        while frames:
            frame = frames[-1]
            i, state, left, todo, k, cut = frame
            if k == len(todo):
                frames.pop()
                over = need[i, state] = cut
                if frames:
                    path.pop()
                    up = frames[-1]
                    cost = up[3][up[4] - 1][1] + over
                    up[5] = cost if up[5] is None else min(up[5], cost)
                continue
            frame[4] += 1
            name, cost, j, after = todo[k]
            left -= cost
            known = need.get((j, after), least[j])
            if known > left:
                frame[5] = cost + known if cut is None else min(cut, cost + known)
                continue
            path.append(name)
            if j == n and after in ends:
                return bound, "".join(path)
            frames.append([j, after, left, edits(j, after), 0, None])
        bound = over


def repair(rows: str) -> tuple[int, str]:
    """Cost and initials of the first cheapest edits of a conversation of any length."""
    if len(rows) <= PIECE:
        return search(rows)
    best = {0: (0, "")}
    for at in range(0, len(rows), PIECE):
        piece, after = rows[at:at + PIECE], {}
        for state, (cost, names) in best.items():
            for end in range(4):
                found = search(piece, state, (end,))
                if found:
                    own = (cost + found[0], names + found[1])
                    after[end] = min(after.get(end, own), own)
        best = after
    return min(best[end] for end in ACCEPTING if end in best)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, code) as one string a run of equal conversations; a dropped row has no code."""
    task = TaskContext.get().partitionId()
    last, held, any_ = None, [], False
    number = 0

    def out(convs, strings, kind):
        nonlocal number
        number += len(convs)
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array([(task << 33) + number - len(convs) + k for k in range(len(convs))], pa.int64()), pa.array(strings, pa.string())], ["conv", "at", "codes"])

    for b in batches:
        convs, strings = [], []
        for conv, code in zip(b.column("conv").to_pylist(), b.column("code").to_pylist()):
            if any_ and conv != last:
                convs.append(last)
                strings.append("".join(held))
                held = []
            last, any_ = conv, True
            held.append(code or "")
        yield out(convs, strings, b.column("conv").type)
        kind = b.column("conv").type
    if any_:
        yield out([last], ["".join(held)], kind)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple] = {}
    for b in batches:
        out = []
        for codes in b.column("codes").to_pylist():
            own = known.get(codes)
            if own is None:
                read = [_row(c) for c in codes]
                faults = [fault for _, fault in read]
                illegal = sum((x[0] + y[0]) not in ("su", "ua", "au") for x, y in zip(read, read[1:]))
                own = (faults.count(1), faults.count(2), faults.count(3), illegal, *repair(codes))
                if len(codes) <= PIECE:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[codes] = own
            out.append(own)
        cols = list(zip(*out)) if out else [()] * 6
        arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.string())]
        yield pa.RecordBatch.from_arrays([b.column("conv"), *arrays], ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each conversation's edits before its rows -> the digest of the repaired text and its rows."""
    state = own = names = None
    at = n = 0

    def write(role: str, text: str) -> None:
        nonlocal state, n
        own.update((("\n" if n else "") + role + ":" + text).encode())
        n += 1
        state = NEXT[state, role[:1]]

    def inserted() -> None:
        nonlocal at
        while at < len(names) and names[at] == "I":
            write(ROLES[GIVEN[state]], "")
            at += 1

    for b in batches:
        convs, digests, counts = [], [], []
        ids = b.column("conv").to_pylist()
        for conv, audit, role, text in zip(ids, *(b.column(c).to_pylist() for c in ("audit", "role", "text"))):
            if audit is not None:
                if own is not None:
                    inserted()
                    convs.append(last)
                    digests.append(own.hexdigest())
                    counts.append(n)
                last, own, names, state, at, n = conv, hashlib.sha256(), audit, 0, 0, 0
                continue
            inserted()
            edit = names[at]
            at += 1
            if edit == "K":
                write(role, text)
            elif edit == "R":
                write(ROLES[GIVEN[state]], text)
        kind = b.column("conv").type
        yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(digests, pa.string()), pa.array(counts, pa.int64())], ["conv", "repaired_sha256", "rows"])
    if own is not None:
        inserted()
        yield pa.RecordBatch.from_arrays([pa.array([last], kind), pa.array([own.hexdigest()]), pa.array([n], pa.int64())], ["conv", "repaired_sha256", "rows"])


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) with faults by the checksum of ``conv:turn``, and dropped, true for rows that a fault takes away."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv"), F.lit(":"), blank("turn"))) % 20
    rows = rows.select("conv", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("kind") == 0).alias("dropped"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def coded(rows: DataFrame) -> DataFrame:
    """conv, turn, role, key and code of ``rows`` (conv, turn, role, text, dropped); code is null for dropped rows.

    key is a digest of role and text: two rows with the same key are taken as equal.
    """
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    place = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), initial), F.lit(0)), F.lit(len(INITIALS) + 1)) - 1
    place = F.when(initial == "", len(INITIALS)).otherwise(place)
    light = rows.select("conv", "turn", "role", "dropped", F.md5(F.concat("role", F.lit("\x00"), "text")).alias("key"), place.alias("place"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    earlier = F.row_number().over(Window.partitionBy("conv", "key", "dropped").orderBy(F.asc_nulls_first("turn")))
    fault = F.when(F.col("blank"), 1).when(F.col("nth") > 1, 2).when(F.col("cut"), 3).otherwise(0)
    code = F.when(~F.col("dropped"), F.char(F.lit(FIRST) + 4 * F.col("place") + fault))
    return light.withColumn("nth", earlier).select("conv", "turn", "role", "key", code.alias("code"))


def repaired(rows: DataFrame, conv_col: str = "conv_id", faults=damage) -> DataFrame:
    """One row for each conversation: conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, rows.

    ``faults`` makes the rows to repair, with a flag of those to leave out; None takes rows as they are.
    """
    bounded_batches(rows.sparkSession)
    own = rows.select(F.col(conv_col).alias("conv"), "turn", "role", "text")
    kind = own.schema["conv"].dataType.simpleString()
    as_they_are = own.select("conv", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(False).alias("dropped"))
    base = faults(own) if faults else as_they_are
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "key")]
    light = stage(coded(base), "repair-rows")
    # sorted by conversation within a partition, and a run of one conversation is in turn order whatever partition it is in
    runs = light.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_runs, f"conv {kind}, at long, codes string")
    whole = runs.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "codes"))), lambda r: r["codes"]), "").alias("codes"))
    answers = stage(whole.mapInArrow(_answers, f"conv {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string"), "repair-answers")
    kept = F.when(F.col("code").isNotNull(), F.col("turn"))
    turns = light.groupBy("conv").agg(F.coalesce(F.max(kept) - F.min(kept) + 1 - F.count_distinct(kept), F.lit(0)).cast("long").alias("gaps"))
    key = F.md5(F.concat("role", F.lit("\x00"), "text"))
    none = F.lit(None).cast("string")
    texts = base.where(~F.col("dropped")).select("conv", none.alias("audit"), "turn", "role", "text", key.alias("key"))
    heads = answers.select("conv", "audit", F.lit(None).cast(texts.schema["turn"].dataType).alias("turn"), none.alias("role"), none.alias("text"), none.alias("key"))
    # all null but for its edits, a head sorts before the rows
    stream = heads.unionAll(texts).repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), F.col("audit").isNull(), *order[1:])
    digests = stream.select("conv", "audit", "role", "text").mapInArrow(_digests, f"conv {kind}, repaired_sha256 string, rows long")
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"])
    found = answers.join(turns, same(answers, turns)).drop(turns["conv"])
    found = found.join(digests, same(found, digests)).drop(digests["conv"])
    return found.select(F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "rows")
