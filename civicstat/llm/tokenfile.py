"""Token ids in binary files, coded by an adaptive range coder that mixes contexts.

A file is a sequence of segments in ascending document order; a segment holds whole documents, of
``SEGMENT_IDS`` ids or more, cut into blocks of ``BLOCK_IDS`` ids. Each block is coded with a model
that starts anew and carries the crc32 of its ids, so any block can be read or found broken by
itself.

For each id the coder mixes three predictions into one interval of the range:

- order 2 and order 1: the id that last followed the two ids, or the one id, before it, with a
  count of how often that held; per count, an adaptive rate says how often such predictions hold;
- where both name the same id, their rates are averaged; else order 1 gets its share of what
  order 2 leaves;
- order 0: adaptive rates of three groups of ids (tokenizers number frequent tokens low), even
  within a group, so it predicts a group and no single id.

All arithmetic is in integers, so files read the same on every machine. The blocks of a segment are
coded side by side, one array lane each: step t codes the t-th id of every block.

Spark has no sink for bare binary files that every store takes, so a segment's bytes are a column
of a Parquet row, next to the ids and lengths of its documents; Parquet files are committed whole
and a task that runs again replaces its own.

Defined results:

- null or empty text: only the end id;
- documents are ordered by id, nulls first, equal ids by a hash of their texts; repeated rows: one entry each;
- an empty table writes no segment and reads back no row;
- only the two named columns are read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicstat.llm.common import bounded_batches, chunk_text, scratch, space_chunks

BLOCK_IDS = 2048
SEGMENT_IDS = 4096 * BLOCK_IDS
MAGIC = b"TIDS"
#: Chunks of text whose ids a worker keeps, at most; it starts anew beyond that.
CACHE = 600_000
#: Segments whose places are broadcast when files are read; more are joined by a shuffle.
MOST_BROADCAST = 200_000

_ORDER1, _ORDER2 = 512, 1024
_TOTAL = 24  # bits of the interval that an id is a part of
_U = np.uint64
_LOW32 = _U(0xFFFFFFFF)

# ---- model and coder, one lane for each block


class _Lanes:
    """Models of ``n`` blocks that start anew."""

    def __init__(self, n: int):
        self.t1 = np.zeros(n * _ORDER1, np.int32)  # (id + 1) * 16 + count
        self.t2 = np.zeros(n * _ORDER2, np.int32)
        start = np.linspace(1 << 13, 1 << 15, 16).astype(np.int32)  # of 2 ** 16, by count
        start_of = np.tile(start, n)
        self.rate1, self.rate2 = start_of.copy(), start_of.copy()
        self.group = np.full((len(_GROUPS) - 1, n), 1 << 14, np.int32)
        self.last = np.zeros(n, np.int32)
        self.before = np.zeros(n, np.int32)
        self.lane = np.arange(n, dtype=np.int32)

    def predict(self, k: int) -> None:
        """Work out the intervals of the first ``k`` lanes."""
        lane, last = self.lane[:k], self.last[:k]
        self.h1 = lane * _ORDER1 + (last & (_ORDER1 - 1))
        self.h2 = lane * _ORDER2 + ((last * 31 + self.before[:k] * 1021 + (last >> 6)) & (_ORDER2 - 1))
        s1, s2 = self.t1[self.h1], self.t2[self.h2]
        self.c1, self.c2 = s1 & 15, s2 & 15
        self.p1, self.p2 = (s1 >> 4) - 1, (s2 >> 4) - 1
        self.a1, self.a2 = lane * 16 + self.c1, lane * 16 + self.c2
        self.r1, self.r2 = self.rate1[self.a1], self.rate2[self.a2]
        known1, known2 = s1 > 0, s2 > 0
        r1, r2 = self.r1 * known1, self.r2 * known2
        same = self.p1 == self.p2
        r2 = np.where(same, (r1 + r2) >> 1, r2)
        r1 = r1 * ~same
        self.w2 = r2 << (_TOTAL - 16)
        self.w1 = np.minimum((((1 << _TOTAL) - self.w2) >> 16) * r1, (1 << _TOTAL) - _ROOM - self.w2)
        self.base = self.w2 + self.w1
        # the rest: one unit for each id, and the groups' shares
        share = room = (1 << _TOTAL) - (1 << 17) - self.base
        self.first = np.empty((len(_GROUPS), k), np.int32)
        self.width = np.empty((len(_GROUPS), k), np.int32)
        at = self.base
        for g, (low, bits) in enumerate(_GROUPS):
            self.first[g] = at + low
            share = (room >> 8) * (self.group[g, :k] >> 8) if g < len(_GROUPS) - 1 else room
            self.width[g] = (share >> bits) + 1
            at = at + share
            room = room - share

    def update(self, k: int, ids: np.ndarray, group: np.ndarray) -> None:
        for table, h, p, c, rate, a, r in ((self.t1, self.h1, self.p1, self.c1, self.rate1, self.a1, self.r1), (self.t2, self.h2, self.p2, self.c2, self.rate2, self.a2, self.r2)):
            hit = p == ids
            rate[a] = r + ((hit * 63488 + 512 - r) >> 5)
            count = np.where(hit, np.minimum(c + 1, 15), c >> 1)
            keep = hit | (c > 2)
            table[h] = np.where(keep, p * 16 + 16 + count, ids * 16 + 16)
        for g in range(len(_GROUPS) - 1):
            r = self.group[g, :k]
            self.group[g, :k] = r + np.where(group >= g, ((group == g) * 63488 + 1024 - r) >> 5, 0)
        self.before[:k] = self.last[:k]
        self.last[:k] = ids

    def interval(self, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First unit and width of each id's interval, and the ids' groups."""
        group = _group(ids)
        lane = self.lane[:k]
        width = self.width[group, lane]
        start = self.first[group, lane] + (ids - _LOW[group]) * width
        hit1 = (self.p1 == ids) & (self.w1 > 0)
        hit2 = (self.p2 == ids) & (self.w2 > 0)
        start = np.where(hit2, 0, np.where(hit1, self.w2, start))
        return start, np.where(hit2, self.w2, np.where(hit1, self.w1, width)), group

    def find(self, k: int, at: np.ndarray) -> np.ndarray:
        """The ids whose intervals hold the units ``at``."""
        group = np.zeros(k, np.int32)
        for g in range(1, len(_GROUPS)):
            group += at >= self.first[g]
        lane = self.lane[:k]
        place = (at - self.first[group, lane]) // self.width[group, lane]
        literal = _LOW[group] + np.minimum(place, _SIZE[group] - 1)
        return np.where(at < self.w2, self.p2, np.where(at < self.base, self.p1, literal))


#: Groups of ids in order: first id, and bits of the number of ids.
_GROUPS = [(0, 10), (1024, 14), (17408, 17)]
_LOW = np.array([low for low, _ in _GROUPS], np.int32)
_SIZE = np.diff(np.append(_LOW, 1 << 17)).astype(np.int32)
#: Units that the predictions leave at least.
_ROOM = 1 << 18


def _group(ids: np.ndarray) -> np.ndarray:
    group = (ids >= _GROUPS[1][0]).astype(np.int32)
    for low, _ in _GROUPS[2:]:
        group += ids >= low
    return group


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (below 2 ** 17, else ValueError) coded by itself."""
    if any(len(b) and (b.min() < 0 or b.max() >= 1 << 17) for b in blocks):
        raise ValueError("an id is not in 0 to 2 ** 17 - 1")
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    n = np.array([len(blocks[i]) for i in order])
    most = int(n[0]) if len(n) else 0
    grid = np.zeros((most, len(order)), np.int32)
    for lane, i in enumerate(order):
        grid[:n[lane], lane] = blocks[i]
    lanes = _Lanes(len(order))
    low, size = np.zeros(len(order), _U), np.full(len(order), 1 << 48, _U)
    out = np.zeros((len(order), 2 * most + 8), np.uint16)
    used = np.zeros(len(order), np.int64)
    for t in range(most):
        k = int(np.searchsorted(-n, -t, "left"))
        ids = grid[t, :k]
        lanes.predict(k)
        start, width, bits = lanes.interval(k, ids)
        lanes.update(k, ids, bits)
        unit = size[:k] >> _U(_TOTAL)
        low[:k] += unit * start.astype(_U)
        size[:k] = unit * width.astype(_U)
        todo = _settled(low[:k], size[:k])
        while len(todo):
            out[todo, used[todo]] = low[todo] >> _U(32)
            used[todo] += 1
            low[todo] = (low[todo] & _LOW32) << _U(16)
            size[todo] <<= _U(16)
            todo = todo[_settled(low[todo], size[todo], todo, low, size)]
    coded = [b""] * len(order)
    for lane, i in enumerate(order):
        tail = [int(low[lane]) >> s & 0xFFFF for s in (32, 16, 0)]
        coded[i] = out[lane, :used[lane]].astype("<u2").tobytes() + struct.pack("<3H", *tail)
    return coded


def _settled(low: np.ndarray, size: np.ndarray, of=None, all_low=None, all_size=None) -> np.ndarray:
    """Lanes whose first 16 bits are settled; a range too small that straddles is cut first."""
    differ = ((low ^ (low + size - _U(1))) >> _U(32)) != 0
    small = differ & (size < _U(1 << 32))
    if small.any():
        k = np.flatnonzero(small)
        cut = _U(1 << 32) - (low[k] & _LOW32)
        if of is None:
            size[k] = cut
        else:
            all_size[of[k]] = cut
    return np.flatnonzero(~differ | small)


def decode_blocks(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each coded block."""
    order = sorted(range(len(coded)), key=lambda i: -lengths[i])
    n = np.array([lengths[i] for i in order])
    most = int(n[0]) if len(n) else 0
    words = max((len(c) for c in coded), default=0) // 2
    data = np.zeros((len(order), words + 4), np.uint64)
    for lane, i in enumerate(order):
        w = np.frombuffer(coded[i], "<u2")
        data[lane, :len(w)] = w
    code = (data[:, 0] << _U(32)) | (data[:, 1] << _U(16)) | data[:, 2]
    used = np.full(len(order), 3)
    lanes = _Lanes(len(order))
    low, size = np.zeros(len(order), _U), np.full(len(order), 1 << 48, _U)
    grid = np.zeros((most, len(order)), np.int32)
    for t in range(most):
        k = int(np.searchsorted(-n, -t, "left"))
        lanes.predict(k)
        unit = size[:k] >> _U(_TOTAL)
        at = np.minimum((code[:k] - low[:k]) // unit, _U((1 << _TOTAL) - 1)).astype(np.int32)
        ids = lanes.find(k, at)
        start, width, bits = lanes.interval(k, ids)
        lanes.update(k, ids, bits)
        grid[t, :k] = ids
        low[:k] += unit * start.astype(_U)
        size[:k] = unit * width.astype(_U)
        todo = _settled(low[:k], size[:k])
        while len(todo):
            code[todo] = ((code[todo] & _LOW32) << _U(16)) | data[todo, np.minimum(used[todo], words + 3)]
            used[todo] += 1
            low[todo] = (low[todo] & _LOW32) << _U(16)
            size[todo] <<= _U(16)
            todo = todo[_settled(low[todo], size[todo], todo, low, size)]
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(order)
    for lane, i in enumerate(order):
        out[i] = grid[:n[lane], lane]
    return out


# ---- segments


def pack(ids: np.ndarray) -> bytes:
    """A segment: magic, ids a block, number of ids; for each block coded bytes and crc32 of its ids; the blocks."""
    blocks = [ids[i:i + BLOCK_IDS] for i in range(0, len(ids), BLOCK_IDS)]
    coded = encode_blocks(blocks)
    head = struct.pack("<4sIQ", MAGIC, BLOCK_IDS, len(ids))
    table = b"".join(struct.pack("<II", len(c), zlib.crc32(b.astype("<u4").tobytes())) for c, b in zip(coded, blocks))
    return head + table + b"".join(coded)


def unpack(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError if a block's checksum doesn't hold."""
    magic, size, n = struct.unpack_from("<4sIQ", data)
    if magic != MAGIC:
        raise ValueError("no segment of token ids")
    count = -(-n // size)
    table = list(struct.iter_unpack("<II", data[16:16 + 8 * count]))
    at, coded = 16 + 8 * count, []
    for length, _ in table:
        coded.append(data[at:at + length])
        at += length
    blocks = decode_blocks(coded, [min(size, n - i * size) for i in range(count)])
    for i, (b, (_, crc)) in enumerate(zip(blocks, table)):
        if zlib.crc32(b.astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {i} is broken")
    return np.concatenate(blocks) if blocks else np.zeros(0, np.int32)


# ---- texts to ids

_MARKS = frozenset(".,")


class _Tokenizer:
    """Ids of texts by the tokenizers library, each distinct chunk encoded once.

    The byte-level pattern begins a match at a single space between two other characters, so a
    text's ids are those of its chunks cut there. A special token in a text is that token, as the
    library has it, and none holds a space.
    """

    def __init__(self, data: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(data)
        spaced = [t.content for t in self.library.get_added_tokens_decoder().values() if " " in t.content or t.lstrip or t.rstrip]
        if spaced:
            raise ValueError(f"special tokens that take spaces: {spaced}")
        self.known: dict[str, bytes] = {}
        self.mark = {m: np.array(self.library.encode(m, add_special_tokens=False).ids, "<u4").tobytes() for m in _MARKS}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > CACHE:
            self.known = {}
        cut, all_ = [space_chunks(t) for t in texts], set()
        for own in cut:
            all_.update(own)
        known = self.known
        new = list(all_.difference(known))
        # a mark after letters is a match of its own, and most such words are known without it
        bare = {c: c[:-1] for c in new if c[-1:] in _MARKS and c[:-1].isalpha()}
        new = list({bare.get(c, c) for c in new}.difference(known))
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            for c, e in zip(part, self.library.encode_batch_fast([*map(chunk_text, part)], add_special_tokens=False)):
                known[c] = np.array(e.ids, "<u4").tobytes()
        for c, word in bare.items():
            known[c] = known[word] + self.mark[c[-1]]
        return [np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4") for chunks in cut]


_HELD: dict[int, _Tokenizer] = {}


def _tokenizer(data: str) -> _Tokenizer:
    """One for each worker, which runs many tasks."""
    key = zlib.crc32(data.encode())
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = _Tokenizer(data)
    return _HELD[key]


def _segments(tokenizer, end_id: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(tokenizer.value)
        file_no = TaskContext.get().partitionId()
        docs, lengths, parts, size, number = [], [], [], 0, 0
        end = np.array([end_id], np.uint32)

        def emit():
            ids = np.concatenate(parts)
            listed = pa.concat_arrays(docs)
            held = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()), held(listed), held(pa.array(lengths, pa.int64())), pa.array([pack(ids)], pa.binary())],
                ["file_no", "segment_no", "n_ids", "docs", "lengths", "data"])

        for b in batches:
            texts = b.column("text").to_pylist()
            at = 0
            while at < len(texts):  # some megabytes of text together
                stop, chars = at, 0
                while stop < len(texts) and chars < 4 << 20:
                    chars += len(texts[stop] or "")
                    stop += 1
                done = at
                for i, ids in enumerate(own.ids(texts[at:stop]), at):
                    parts += (ids, end)
                    lengths.append(len(ids) + 1)
                    size += len(ids) + 1
                    if size >= least:
                        docs.append(b.column("id").slice(done, i + 1 - done))
                        done = i + 1
                        yield emit()
                        docs, lengths, parts, size, number = [], [], [], 0, number + 1
                if done < stop:
                    docs.append(b.column("id").slice(done, stop - done))
                at = stop
        if lengths:
            yield emit()
    return run


def write(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending order of ids.

    The files are ordered by ``file_no`` and hold ranges of document ids; rows of one id may be cut
    between files, so a frequent id fills no task.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(parts, F.asc_nulls_first("id"), "tie").sortWithinPartitions(F.asc_nulls_first("id"), "tie")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"file_no int, segment_no int, n_ids long, docs array<{kind}>, lengths array<long>, data binary"
    in_order.select("id", "text").mapInArrow(_segments(held, end_id, segment_ids), schema).write.parquet(path)


def starts(segments: DataFrame) -> DataFrame:
    """(file_no, segment_no, start): ids in all segments before; a window over files, then one in each file."""
    own = segments.select("file_no", "segment_no", "n_ids")
    files = own.groupBy("file_no").agg(F.sum("n_ids").alias("n"))
    before = files.select("file_no", (F.sum("n").over(Window.orderBy("file_no")) - F.col("n")).alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("file_no").orderBy("segment_no")) - F.col("n_ids")
    return own.withColumn("inside", inside).join(before, "file_no").select("file_no", "segment_no", (F.col("base") + F.col("inside")).alias("start"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            ids = unpack(b.column("data")[k].as_py()).astype("<u4")
            docs, lengths = b.column("docs")[k].values, b.column("lengths")[k].values.to_numpy()
            ends = np.cumsum(lengths)
            base, lo = b.column("start")[k].as_py(), 0
            while lo < len(lengths):
                first = int(ends[lo] - lengths[lo])
                hi = max(lo + 1, int(np.searchsorted(ends, first + (1 << 20), "right")))
                cut = [ids[e - n:e].tobytes() for e, n in zip(ends[lo:hi], lengths[lo:hi])]
                yield pa.RecordBatch.from_arrays([docs.slice(lo, hi - lo), pa.array(base + ends[lo:hi] - lengths[lo:hi]), pa.array(lengths[lo:hi]), pa.array(cut, pa.binary())], ["id", "start", "n_ids", "ids"])
                lo = hi


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_ids and ids (little-endian unsigned 32-bit integers) of each document in the files."""
    bounded_batches(spark)
    segments = spark.read.parquet(path)
    place = starts(segments)
    if segments.select("file_no").count() <= MOST_BROADCAST:
        place = F.broadcast(place)
    kind = segments.schema["docs"].dataType.elementType.simpleString()
    joined = segments.join(place, ["file_no", "segment_no"]).select("docs", "lengths", "data", "start")
    return joined.mapInArrow(_documents, f"id {kind}, start long, n_ids long, ids binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the files and read them back."""
    path = path or scratch(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer_file, id_col, text_col, end_id)
    return read(docs.sparkSession, path, id_col)
