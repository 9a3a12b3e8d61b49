"""Byte-level BPE by folds of ranked merges over distinct words.

Each task numbers the distinct words that it meets. A block of ``BLOCK_CHARS`` of text becomes one
row: the words that are new with it, and for each document the numbers of its words. Spark's
higher-order functions fold the merges over each word: it is an array of token ids, each with
the rank of its merge with the next, a step puts the merged id in the place of the pair of lowest
rank, and the fold ends when no pair merges. A word comes to the fold as the ids of its bytes, with
two bytes as one id where no merge around them can come before theirs. The rank map is a literal array. The task that reads
the folded rows keeps the ids by number and gives each document its ids, and decoding concatenates
the binary pieces of the ids.

No word is shuffled, so the work grows with the text only and a frequent word is no hot key. A word
is folded once a task, and a row holds the new words of one block, so memory doesn't grow with the
text: numbering starts anew, on both sides, after ``TABLE_CHARS``.

The rank of a token is its id. A word that is a token as a whole is that token, as the reference
tokenizers have it. Other words are cut first between bytes that stand side by side in no token,
since no merge crosses there. Parts of more than ``LONG`` bytes go around the fold, which takes time
with the square of the length: a heap of pairs merges them, to the same ids.

Defined results:

- null or empty text: no tokens, the digest of the empty string;
- null ids and repeated rows: one result each; an empty table gives an empty result;
- texts are valid UTF-8; a very long text is one block;
- only the named columns are read.
"""

from __future__ import annotations

import base64
import heapq
import json
import random
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import bounded_batches, chunk_text, released, space_chunks

#: Characters of text in a block, about.
BLOCK_CHARS = 250_000
#: A task's numbers start anew once its distinct words have so many characters; so does its table of chunks.
TABLE_CHARS = 6_000_000
#: Places of the literal rank map, but for the ids that are added to them.
PLACES = 1 << 17
#: Tokens that the rank map is made for.
MOST_TOKENS = 1 << 17
#: Parts of more bytes are merged by a heap: a fold takes time with the square of the length.
LONG = 128
#: Codes below are token ids, codes from here on are numbers of words.
WORD = 1 << 20
#: Tokens in a batch that goes back to Spark, about.
BATCH = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """token -> rank of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merges(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """(left id, right id) -> merged id, one pair for each token.

    Inside a token's bytes merges go on as they do for these bytes alone, whatever stands around
    them, so the last of them always joins the same two parts.
    """
    out = {}
    for token, rank in ranks.items():
        pairs = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        if len(pairs) > 1:
            parts = [token[i:i + 1] for i in range(len(token))]
            while len(parts) > 2:
                known = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
                if not known:
                    break
                _, i = min(known)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            pairs = [tuple(parts)] if len(parts) == 2 else []
        for left, right in pairs:
            out[ranks[left], ranks[right]] = rank
    return out


@dataclass
class RankMap:
    """The merges as two arrays.

    A left id has a shift, and the merge with a right id stands at shift + right id, as
    (left id + 1) * 2**20 + merged id, 0 where none does; no two merges share a place.
    """

    shifts: Column
    merged: Column

    def packed(self, left: Column, right: Column) -> Column:
        """Rank of a pair * 2**20 + left id; the rank is 2**20 or more if the pair doesn't merge."""
        entry = F.get(self.merged, F.get(self.shifts, left) + right)
        return F.shiftleft(entry.bitwiseXOR(F.shiftleft(left + 1, 20)), 20).bitwiseOR(left)


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The parts of a RankMap as a struct, folded to a literal by the optimizer."""
    if len(ranks) > MOST_TOKENS:
        raise ValueError(f"{len(ranks)} tokens; the rank map is made for {MOST_TOKENS}")
    rows: dict[int, list[tuple[int, int]]] = {}
    for (left, right), rank in merges(ranks).items():
        rows.setdefault(left, []).append((right, rank))
    most = max(ranks.values(), default=0) + 1
    merged, shifts, draw = [0] * (PLACES + most), [0] * most, random.Random(0)
    for left in sorted(rows, key=lambda x: (-len(rows[x]), x)):
        shift = 0
        while any(merged[shift + right] for right, _ in rows[left]):
            shift = draw.randrange(PLACES)
        shifts[left] = shift
        for right, rank in rows[left]:
            merged[shift + right] = (left + 1 << 20) + rank
    held = {"shifts": shifts, "merged": merged}
    return F.from_json(F.lit(json.dumps(held, separators=(",", ":"))), ", ".join(f"{k} array<bigint>" for k in held))


def folded(words: Column, table: Column) -> Column:
    """``fold`` of each word; the literal stands once in the plan."""
    return _let(table, lambda t: F.transform(words, lambda w: fold(w, RankMap(t["shifts"], t["merged"]))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(word: Column, table: RankMap) -> Column:
    """Token ids of a word, an array of the ids that its merges go on from (see ``_first_merges``).

    The folded array holds, for each token, the rank of its merge with the next and its id in one
    number, so the least is the pair to merge, the leftmost of equals comes first, and a step changes
    the three numbers round the pair. Once no pair merges, the steps left only pass the array on.
    """
    low_bits, none = F.lit((1 << 20) - 1), 1 << 41

    def step(acc: Column, _: Column) -> Column:
        def join(low: Column, at: Column) -> Column:
            new = F.shiftright(low, 20)
            right = F.coalesce(table.packed(new, F.get(acc, at + 1).bitwiseAND(low_bits)), new + none)

            def each(x: Column, i: Column) -> Column:
                k = i - at
                return (F.when((k > 0) | (k < -2), x).when(k == -2, table.packed(x.bitwiseAND(low_bits), new))
                        .when(k == -1, right).otherwise(F.lit(-1)))
            return F.array_remove(F.transform(acc, each), -1)

        return _let(F.array_min(acc), lambda low: F.when(low < 1 << 40, _let(
            F.array_position(acc, low).cast("int"), lambda at: join(low, at))).otherwise(acc))

    start = F.transform(word, lambda left, i: F.coalesce(table.packed(left, F.get(word, i + 1)), left + none))
    return F.aggregate(word, start, step, lambda acc: F.transform(acc, lambda x: x.bitwiseAND(low_bits).cast("int")))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids by a heap of pairs, for long words."""
    parts = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i, i + 1) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, j = heapq.heappop(heap)
        if parts[i] is None or after[i] != j or j >= len(parts) or parts[j] is None or ranks.get(parts[i] + parts[j]) != rank:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
            if (r := ranks.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(heap, (r, i, after[i]))
        if before[i] >= 0 and (r := ranks.get(parts[before[i]] + parts[i])) is not None:
            heapq.heappush(heap, (r, before[i], i))
    return [ranks[p] for p in parts if p is not None]


#: Marks that are a match of their own behind a word.
_MARKS = frozenset(".,")


def _numbers() -> defaultdict:
    """Numbers its keys in the order in which they are first looked up."""
    out = defaultdict()
    out.default_factory = out.__len__
    return out


def _newest(numbers: defaultdict, known: int) -> list:
    """The keys numbered from ``known`` on."""
    return [*islice(reversed(numbers), len(numbers) - known)][::-1]


class _Lists:
    """Lists of integers by number, in two arrays that grow by doubling."""

    def __init__(self, kind: type = np.int32):
        self.flat, self.ends, self.n, self.used = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, flat: np.ndarray, n_of: np.ndarray) -> None:
        while self.n + len(n_of) + 1 > len(self.ends):
            self.ends = np.append(self.ends, np.zeros_like(self.ends))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.flat[self.used:self.used + len(flat)] = flat
        self.ends[self.n + 1:self.n + 1 + len(n_of)] = self.used + np.cumsum(n_of)
        self.n, self.used = self.n + len(n_of), self.used + len(flat)

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self.ends[numbers + 1] - self.ends[numbers]

    def places(self, numbers: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Places in ``flat`` of the lists of ``numbers``, one after another; ``n`` are their lengths."""
        return np.arange(int(n.sum())) + np.repeat(self.ends[numbers] - np.cumsum(n) + n, n)


class _Words:
    """Codes (32-bit integers) of texts; numbers the words that need a fold.

    Texts are cut into chunks, and a chunk that was met before is a look-up. What is new in a block is
    worked out together: chunks to words by the pattern, words to parts by one array of all their bytes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find, self.parts, self.part_chars = ranks, regex.compile(pattern).findall, _numbers(), 0
        self.by_text = {}
        for token, rank in ranks.items():
            try:
                self.by_text[token.decode()] = rank
            except UnicodeDecodeError:  # a piece of a character, which is no word
                pass
        self.byte_ranks = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.together = np.zeros(1 << 16, bool)
        for token in ranks:
            for left, right in zip(token, token[1:]):
                self.together[left << 8 | right] = True
        # letters after a space are one match, and a mark behind them another, by the pattern at hand
        self.plain = self.find(" word") == [" word"] and all(self.find(" word" + m) == [" word", m] for m in _MARKS)
        self.chunks = _numbers()
        self.forget_chunks()

    def forget_chunks(self) -> None:
        self.chunks.default_factory = None  # no cycle that waits for the collector
        self.chunks, self.chunk_codes, self.chunk_chars = _numbers(), _Lists(), 0

    def forget(self) -> None:
        self.parts.default_factory = None
        self.parts, self.part_chars = _numbers(), 0
        self.forget_chunks()

    def look_up(self, text: str) -> np.ndarray:
        """Numbers of a text's chunks."""
        own = space_chunks(text)
        return np.fromiter(map(self.chunks.__getitem__, own), np.int32, len(own))

    def codes(self, looked_up: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of texts, one after another, and the number of codes of each."""
        new = _newest(self.chunks, self.chunk_codes.n)
        if new:
            self.chunk_chars += sum(map(len, new))
            words, n_of = self._words(new)
            flat, n = self._word_codes(words)
            ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(n_of))]
            self.chunk_codes.add(flat, np.diff(ends))
        numbers = np.concatenate(looked_up)
        n = self.chunk_codes.lengths(numbers)
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum([*map(len, looked_up)]))]
        return self.chunk_codes.flat[self.chunk_codes.places(numbers, n)], np.diff(ends)

    def _words(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """The chunks' words, one after another, and the number of words of each."""
        words, n_of, plain, find = [], [], self.plain, self.find
        for chunk in chunks:
            if plain and chunk.isalpha():
                words.append(" " + chunk)
                n_of.append(1)
            elif plain and chunk[-1:] in _MARKS and chunk[:-1].isalpha():
                words += (" " + chunk[:-1], chunk[-1])
                n_of.append(2)
            else:
                found = find(chunk_text(chunk))
                words += found
                n_of.append(len(found))
        return words, n_of

    def _word_codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of words, one after another, and the number of codes of each."""
        codes = np.fromiter(map(self.by_text.get, words, repeat(-1)), np.int32, len(words))
        todo = np.flatnonzero(codes < 0)
        raws = [words[i].encode() for i in todo.tolist()]
        flat, n_of = self._part_codes(b"".join(raws), np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws))))
        n = np.ones(len(words), np.int64)
        n[todo] = n_of
        start = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int32)
        out[start] = codes
        out[np.repeat(start[todo] - np.cumsum(n_of) + n_of, n_of) + np.arange(len(flat))] = flat
        return out, n

    def _part_codes(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of words that end at ``ends``, cut where no token holds the two adjacent bytes."""
        data = np.frombuffer(raw, np.uint8)
        apart = ~self.together[data[:-1].astype(np.uint16) << 8 | data[1:]]
        apart[ends[:-1] - 1] = True  # two words meet here
        edges = np.append(0, np.append(np.flatnonzero(apart) + 1, ends[-1:]))
        size, known = np.diff(edges), len(self.parts)
        codes, n = np.empty(len(size), np.int32), np.ones(len(size), np.int64)
        single, long = size == 1, size > LONG
        codes[single] = self.byte_ranks[data[edges[:-1][single]]]
        numbered = np.flatnonzero(~single & ~long)
        parts = [raw[a:b] for a, b in zip(edges[numbered].tolist(), edges[numbered + 1].tolist())]
        codes[numbered] = np.fromiter(map(self.parts.__getitem__, parts), np.int32, len(parts)) + WORD
        self.part_chars += sum(map(len, _newest(self.parts, known)))
        merged = {i: merge(raw[edges[i]:edges[i + 1]], self.ranks) for i in np.flatnonzero(long).tolist()}
        for i, own in merged.items():
            n[i] = len(own)
        start = np.append(0, np.cumsum(n))
        out = np.empty(int(start[-1]), np.int32)
        out[start[:-1]] = codes
        for i, own in merged.items():
            out[start[i]:start[i + 1]] = own
        return out, np.diff(start[np.searchsorted(edges, np.append(0, ends))])


def _blocks(ranks, pattern: str, chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(ranks.value, pattern)
        ids, chunks, size, base = [], [], 0, 0

        def emit():
            nonlocal ids, chunks, size, base
            held = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            codes, counts = words.codes(chunks)
            new = _newest(words.parts, base)
            n = np.fromiter(map(len, new), np.int64, len(new))
            flat = pa.array(np.frombuffer(b"".join(new), np.uint8).astype(np.int16))
            word = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), flat)
            out = pa.RecordBatch.from_arrays(
                [held(pa.concat_arrays(ids)), held(pa.array(counts, pa.int64())), pa.array([codes.tobytes()], pa.binary()), pa.array([base], pa.int64()), held(word)],
                ["ids", "counts", "codes", "base", "words"])
            ids, chunks, size, base = [], [], 0, len(words.parts)
            if words.part_chars > TABLE_CHARS:
                words.forget()
                base = 0
            elif words.chunk_chars > TABLE_CHARS:
                words.forget_chunks()
            return out

        for b in batches:
            texts = b.column("text").to_pylist()
            done = 0
            for i, t in enumerate(texts):
                chunks.append(words.look_up(t or ""))
                size += len(t or "")
                if size >= chars or i + 1 == len(texts):
                    ids.append(b.column("id").slice(done, i + 1 - done))
                    done = i + 1
                if size >= chars:
                    yield emit()
        if chunks:
            yield emit()
        words.forget()  # the tables would wait for the collector
    return run


def _first_merges(ranks: dict[bytes, int]):
    """Words of bytes (``_blocks``) to words of ids, the merges of two bytes that come before all around them made.

    A merge that joins either byte to what stands beside it makes a token that holds these two adjacent
    bytes. Where all such tokens have higher ranks, the two bytes merge before any of them does.
    """
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    none = np.iinfo(np.int32).max
    merged, least = np.full(1 << 16, none, np.int32), np.full(1 << 16, none, np.int32)
    size, rank_of = np.fromiter(map(len, ranks), np.int64, len(ranks)), np.fromiter(ranks.values(), np.int32, len(ranks))
    data, of = np.frombuffer(b"".join(ranks), np.uint8), np.repeat(np.arange(len(ranks)), size)
    inside = np.flatnonzero(of[:-1] == of[1:])
    pairs, of = data[inside].astype(np.int32) << 8 | data[inside + 1], of[inside]
    np.minimum.at(least, pairs, rank_of[of])
    merged[pairs[size[of] == 2]] = rank_of[size == 2]

    def ids(words: pa.ListArray) -> pa.ListArray:
        data, ends = words.values.to_numpy(), words.offsets.to_numpy()
        out = byte_ids[data]
        if not len(data):
            return pa.ListArray.from_arrays(words.offsets, pa.array(out))
        pair = data[:-1].astype(np.int32) << 8 | data[1:]
        apart = ends[(ends > 0) & (ends < len(data))] - 1
        rank, around = merged[pair], np.append(least[pair], none)
        rank[apart], around[apart] = none, none
        first = np.flatnonzero((rank < around[1:]) & (rank < np.append(none, around[:-2])))
        out[first] = rank[first]
        kept = np.ones(len(data), bool)
        kept[first + 1] = False
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))[ends].astype(np.int32)), pa.array(out[kept]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("words")
            yield b.drop_columns(["words"]).append_column("words", pa.ListArray.from_arrays(words.offsets, ids(words.values)))
    return run


def _documents(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, piece = _Lists(), _Lists(np.uint8)
        by_id = [pieces.value.get(i, b"") for i in range(max(pieces.value, default=-1) + 1)]
        piece.add(np.frombuffer(b"".join(by_id), np.uint8), np.fromiter(map(len, by_id), np.int64, len(by_id)))
        for b in batches:
            for k in range(b.num_rows):
                if b.column("base")[k].as_py() == 0:
                    known = _Lists()
                new = b.column("folded")[k].values
                known.add(new.flatten().to_numpy(), np.diff(new.offsets.to_numpy()) if len(new) else np.zeros(0, np.int64))
                codes = np.frombuffer(b.column("codes")[k].as_py(), np.int32)
                counts = b.column("counts")[k].values.to_numpy()
                ids = b.column("ids")[k].values
                ends = np.cumsum(counts)
                lo = 0
                while lo < len(counts):
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BATCH, "right")))
                    at = int(ends[lo - 1]) if lo else 0
                    yield _tokens(ids.slice(lo, hi - lo), counts[lo:hi], codes[at:int(ends[hi - 1])], known, piece)
                    lo = hi
    return run


def _tokens(ids, counts, codes, folded: _Lists, pieces: _Lists) -> pa.RecordBatch:
    is_word = codes >= WORD
    number = codes[is_word] - WORD
    n = np.ones(len(codes), np.int64)
    k = n[is_word] = folded.lengths(number)
    start = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.int32)
    out[start[~is_word]] = codes[~is_word]
    out[np.repeat(start[is_word] - np.cumsum(k) + k, k) + np.arange(int(k.sum()))] = folded.flat[folded.places(number, k)]
    ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(counts))]
    size = pieces.lengths(out)
    bounds = np.append(0, np.cumsum(size))[ends].astype(np.int32)
    decoded = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(pieces.flat[pieces.places(out, size)])])
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out)), decoded], ["id", "token_ids", "decoded"])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id_col, token_ids array<int>, decoded binary) for each row; decoded joins the pieces of the ids.

    ``path`` is a rank file, whose size bounds the literal and the broadcasts; ``pattern`` splits
    text into words.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = read_ranks(path)
    ranks = spark.sparkContext.broadcast(own)
    pieces = spark.sparkContext.broadcast({r: t for t, r in own.items()})
    table = rank_literal(own)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _first_merges(ranks.value)(_blocks(ranks, pattern, block_chars)(batches))

    blocks = rows.mapInArrow(released(cut), f"ids array<{id_type}>, counts array<bigint>, codes binary, base long, words array<array<bigint>>")
    done = blocks.select("ids", "counts", "codes", "base", folded(F.col("words"), table).alias("folded"))
    return done.mapInArrow(released(_documents(pieces)), f"id {id_type}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def id_text(column: str) -> Column:
    """Decimal ids joined by one space."""
    return F.replace(F.btrim(F.col(column).cast("string"), F.lit("[]")), F.lit(", "), F.lit(" "))
