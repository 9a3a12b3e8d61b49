"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK random walk turns edit distance into Hamming distance: at step j the byte under the
cursor is put out, and the cursor moves on if random bit (j, byte) is set. Two strings that differ
by an edit fall back into step soon after it.

Documents are cut into windows that start every few bytes; an item enters the index at each of its
offsets, so wherever a passage lies, all of it is crossed by windows that start in step with an
offset of the item. Each of a class's walks feeds hash tables with sampled places of the embedding.
A window and an item that share a bucket are verified: the exact edit distance of the whole item to
the best part of the text around the window must be within ``MAX_EDIT`` of the item's length. The
many windows of an item and the tables together reach the recall that ``recall`` works out.

Items fall into classes by length, and documents are walked for the classes that have items:

- ``LONG``: a window every 16 bytes, of 40 steps;
- ``MIDDLE``: a shorter passage holds fewer windows, so they start every 4 bytes and have 24 steps;
- items under ``SHORT`` bytes leave nothing to sample between their edits. An item with k edits in
  it keeps one of its k + 1 pieces whole, so it is looked for by its pieces: no match is missed.

Benchmarks go to the tasks in blocks of ``BLOCK_BYTES`` of items, so the size of a broadcast is
bounded however large the benchmark is; each block is a pass over the documents.

Defined results:

- texts and items are compared as UTF-8 bytes with A-Z in lower case;
- null or empty text: no hit; null or empty item: ignored;
- equal items, repeated item ids and repeated documents: a hit for each;
- an item of so few bytes that no edit is allowed: its first place in a text;
- an empty table on either side gives an empty result;
- only the named columns are read; ``clean`` returns the columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import bounded_batches

MAX_EDIT = 0.1
SHORT = 40
SEED = 4
BLOCK_BYTES = 256 << 10
#: Windows walked together.
LANES = 1 << 16
_MARKS = 20
_GRAM = 6
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Walks:
    """Random walks and sampled places for items of ``floor`` bytes and more."""

    def __init__(self, floor: int, stride: int, walks: int, steps: int, samples: int, bits: int):
        self.floor, self.stride, self.steps = floor, stride, steps
        rng = np.random.default_rng(SEED)
        self.move = rng.integers(0, 2, (walks, steps, 256), dtype=np.int64)
        self.places = [[set(rng.choice(steps, bits, replace=False).tolist()) for _ in range(samples)] for _ in range(walks)]

    def tables(self, data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """Bucket of each window, one array for each table; data needs ``steps`` bytes after the last start."""
        for move, tables in zip(self.move, self.places):
            keys = [np.zeros(len(at), np.uint64) for _ in tables]
            cursor = at.copy()
            for step in range(self.steps):
                byte = data[cursor]
                for key, places in zip(keys, tables):
                    if step in places:
                        key += byte
                        key *= _MIX
                cursor += move[step][byte]
            for key in keys:
                yield mixed(key)


def mixed(key: np.ndarray) -> np.ndarray:
    """``key`` with all of its bits spread to the top ones."""
    key ^= key >> np.uint64(31)
    key *= _MIX
    return key


LONG = Walks(80, 16, 2, 40, 4, 12)
MIDDLE = Walks(SHORT, 4, 2, 24, 4, 10)


def recall(length: int, rate: float, trials: int = 300, seed: int = 0) -> float:
    """Share of random passages of ``length`` bytes, edited at ``rate``, that fall into a bucket of their item."""
    rng = np.random.default_rng(seed)
    hit = 0
    for _ in range(trials):
        item = rng.integers(97, 123, length, dtype=np.uint8)
        hit += Index([(0, item.tobytes())]).finds(b"#" * int(rng.integers(0, LONG.stride)) + edited(item, rate, rng) + b"#" * LONG.steps)
    return hit / trials


def edited(item: np.ndarray, rate: float, rng: np.random.Generator) -> bytes:
    """``item`` with a random insertion, deletion or substitution at ``rate`` of its places."""
    out = bytearray()
    for c in item.tolist():
        if rng.random() >= rate:
            out.append(c)
            continue
        kind = rng.integers(3)
        if kind == 0:
            out.append(int(rng.integers(97, 123)))
        elif kind == 1:
            out += bytes((int(rng.integers(97, 123)), c))
    return bytes(out)


def distance(item: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``item`` to a part of ``text`` and the end of that part; None above ``most``.

    Bit-parallel: a column of the matrix of distances is one integer of len(item) bits.
    """
    m = len(item)
    if (at := text.find(item)) >= 0:
        return 0, at + m
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m  # places where the column rises and falls
    best, end = (m, 0) if m <= most else (most + 1, -1)
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        hp, hn = (down | ~(d0 | up)) & full, d0 & up
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1) & full, (hn << 1) & full
        up, down = (hn | ~(d0 | hp)) & full, hp & d0
        if score < best:
            best, end = score, i + 1
    return (best, end) if best <= most else None


class Entries:
    """Keys of items, to be looked up by those of texts."""

    def __init__(self, key: np.ndarray, of: np.ndarray, shift: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.seen = np.zeros(1 << _MARKS, bool)
        self.seen[(key >> np.uint64(64 - _MARKS)).astype(np.int64)] = True
        self.key, self.of, self.shift = key[order], of[order].astype(np.int32), shift[order].astype(np.int32)

    def met(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the key, item, offset in the item) of all entries equal to a key."""
        some = np.flatnonzero(self.seen[(key >> np.uint64(64 - _MARKS)).astype(np.int64)])
        left = np.searchsorted(self.key, key[some], "left")
        k = np.searchsorted(self.key, key[some], "right") - left
        entry = np.repeat(left, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        return np.repeat(some, k), self.of[entry], self.shift[entry]


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Key of the ``size`` bytes at each place of ``data``."""
    key = np.zeros(max(0, len(data) - size + 1), np.uint64)
    for j in range(size):
        key += data[j:j + len(key)]
        key *= _MIX
    return mixed(key)


class Index:
    """A block of items, ready to be held against texts."""

    def __init__(self, items: list[tuple[object, bytes]], max_edit: float = MAX_EDIT):
        self.max_edit = max_edit
        self.items = [(i, t.lower()) for i, t in items]
        self.grams: dict[int, list[bytes]] = {}

    def most(self, i: int) -> int:
        """Edits allowed in item ``i``."""
        return int(self.max_edit * len(self.items[i][1]))

    @cached_property
    def tables(self) -> list[tuple[Walks, list[Entries]]]:
        """Classes that have items, with the tables of each."""
        out = []
        for walks, below in ((MIDDLE, LONG.floor), (LONG, np.inf)):
            own = [k for k, (_, t) in enumerate(self.items) if walks.floor <= len(t) < below]
            if not own:
                continue
            text = b"".join(self.items[k][1] + bytes(walks.steps) for k in own)
            offsets = [np.arange(max(1, len(self.items[k][1]) - walks.steps // 2)) for k in own]
            sizes = np.array([len(self.items[k][1]) + walks.steps for k in own])
            many = [len(o) for o in offsets]
            of, shift = np.repeat(np.array(own), many), np.concatenate(offsets)
            at = shift + np.repeat(np.cumsum(sizes) - sizes, many)
            out.append((walks, [Entries(key, of, shift) for key in walks.tables(np.frombuffer(text, np.uint8), at)]))
        return out

    @cached_property
    def pieces(self) -> dict[int, Entries]:
        """By size: pieces of the items under ``SHORT`` bytes, one more than edits are allowed."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, (_, t) in enumerate(self.items):
            if len(t) < SHORT:
                size = max(1, len(t) // (self.most(k) + 1))
                for at in range(0, min(len(t), size * (self.most(k) + 1)), size):
                    found.setdefault(size, []).append((int(grams(np.frombuffer(t[at:at + size], np.uint8), size)[0]), k, at))
        return {size: Entries(*(np.array(c, t) for c, t in zip(zip(*rows), (np.uint64, np.int64, np.int64)))) for size, rows in found.items()}

    def candidates(self, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(text, item, place of the item's first byte) of windows and items that share a bucket."""
        n = np.array([len(t) for t in texts])
        for walks, tables in self.tables:
            data = np.frombuffer(b"".join(t + bytes(walks.steps) for t in texts), np.uint8)
            first = np.cumsum(n + walks.steps) - n - walks.steps
            count = -(-n // walks.stride)
            ends = np.cumsum(count)
            for lo in range(0, int(count.sum()), LANES):
                window = np.arange(lo, min(lo + LANES, int(ends[-1])))
                of = np.searchsorted(ends, window, "right")
                place = (window - (ends - count)[of]) * walks.stride
                for key, entries in zip(walks.tables(data, first[of] + place), tables):
                    met, item, shift = entries.met(key)
                    yield from zip(of[met].tolist(), item.tolist(), (place[met] - shift).tolist())
        if self.pieces:
            yield from self._by_pieces(texts, n)

    def _by_pieces(self, texts: list[bytes], n: np.ndarray) -> Iterator[tuple[int, int, int]]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(n)
        most = np.array([self.most(k) for k in range(len(self.items))])
        for size, entries in self.pieces.items():
            for lo in range(0, len(data), LANES):
                met, item, shift = entries.met(grams(data[lo:lo + LANES + size - 1], size))
                of = np.searchsorted(ends, met + lo, "right")
                place = met + lo - (ends - n)[of]
                inside = place + size <= n[of]  # a piece doesn't go on in the next text
                of, item, start = of[inside], item[inside], (place - shift)[inside]
                # of starts whose margins hold one another's, and of exact matches, one is enough
                mark = np.where(most[item] > 0, start // (most[item] + 1), 0)
                _, one = np.unique(np.stack([of, item, mark]), axis=1, return_index=True)
                yield from zip(of[one].tolist(), item[one].tolist(), start[one].tolist())

    def finds(self, text: bytes) -> bool:
        return next(self.candidates([text]), None) is not None

    def _shares(self, i: int, text: bytes, most: int) -> bool:
        """Whether ``text`` has as many grams of the item as ``most`` edits must leave: an edit spoils ``_GRAM`` at most."""
        own = self.grams.get(i)
        if own is None:
            t = self.items[i][1]
            own = self.grams[i] = [t[j:j + _GRAM] for j in range(len(t) - _GRAM + 1)]
        there = {text[j:j + _GRAM] for j in range(len(text) - _GRAM + 1)}
        return sum(g in there for g in own) >= len(own) - _GRAM * most

    def hits(self, texts: list[bytes]) -> list[list[tuple[object, int, int, int, int]]]:
        """(item id, start, end, edits, length of the item) for each text, verified; start is that of the aligned item."""
        texts = [t.lower() for t in texts]
        out: list[list[tuple]] = [[] for _ in texts]
        done: set[tuple[int, int, int]] = set()
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for k, i, start in self.candidates(texts):
            item, most = self.items[i][1], self.most(i)
            if not most and (k, i) in found:
                continue
            # starts this close to each other lie in one another's margin
            if (mark := (k, i, start // (most + 1))) in done:
                continue
            done.add(mark)
            # the mark and the window can each be off by ``most``, and so can the length of the match
            lo = max(0, start - 2 * most - 1)
            around = texts[k][lo:start + len(item) + 3 * most + 1]
            if self._shares(i, around, most) and (got := distance(item, around, most)):
                end = lo + got[1]
                same = found.setdefault((k, i), [])
                if all(abs(end - e) > len(item) // 2 for _, e, _ in same):
                    same.append((max(0, end - len(item)), end, got[0]))
        for (k, i), places in found.items():
            out[k] += [(self.items[i][0], *p, len(self.items[i][1])) for p in places]
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int = BLOCK_BYTES) -> Iterator[list[tuple[object, bytes]]]:
    """Items in blocks of at most ``most`` bytes (or one item), read as a stream."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("length(text) > 0").orderBy("id", "text")
    own, size = [], 0
    for r in rows.toLocalIterator():
        t = r["text"].encode()
        if own and size + len(t) > most:
            yield own
            own, size = [], 0
        own.append((r["id"], t))
        size += len(t)
    if own:
        yield own


def _texts(batch: pa.RecordBatch, k: int) -> list[bytes]:
    return [x or b"" for x in batch.column(k).cast(pa.binary()).to_pylist()]


def _slices(texts: list[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= most:
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edit: float = MAX_EDIT) -> DataFrame:
    """One row for each item found in a document: id_col, item_id, start, end (bytes), edits, similarity."""
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type, item_type = own.schema["id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"id {id_type}, item {item_type}, start long, end long, edits long, similarity double"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, item_id, item_text):
        held = spark.sparkContext.broadcast(Index(block, max_edit))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = _texts(b, 1)
                for lo, hi in _slices(texts):
                    rows = [(lo + k, *h[:4], 1 - h[3] / h[4]) for k, hits in enumerate(held.value.hits(texts[lo:hi])) for h in hits]
                    if rows:
                        k, item, start, end, edits, near = zip(*rows)
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(k)), pa.array(item), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(edits, pa.int64()), pa.array(near)], ["id", "item", "start", "end", "edits", "similarity"])

        out = out.unionByName(own.mapInArrow(run, schema))
    return out.withColumnsRenamed({"id": id_col, "item": "item_id"})


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edit: float = MAX_EDIT) -> DataFrame:
    """The rows of ``docs`` without any item of the benchmark, decided row by row without a shuffle."""
    spark = docs.sparkSession
    bounded_batches(spark)
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    kept, at = docs.toDF(*inner), names.index(text_col)
    for block in blocks(benchmark, item_id, item_text):
        held = spark.sparkContext.broadcast(Index(block, max_edit))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = _texts(b, at)
                good = [not h for lo, hi in _slices(texts) for h in held.value.hits(texts[lo:hi])]
                yield b.filter(pa.array(good, pa.bool_()))

        kept = kept.mapInArrow(run, kept.schema)
    return kept.toDF(*names)
