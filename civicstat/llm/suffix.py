"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

A string of ``LENGTH`` bytes is repeated if it also starts earlier: in a document with a smaller
id, or earlier in the same one. Every byte covered by a repeated string goes.

Suffixes are sampled by winnowing: each string of ``LENGTH`` bytes has its own anchor, the place of
its smallest ``Q``-gram, so equal strings have equal anchors at equal offsets, and about one place
in ``(LENGTH - Q) / 2`` is an anchor. An anchor stands for the run of strings it belongs to.

Round 1: anchors are bucketed by their q-gram and each bucket is sorted by the identifier of the
bytes that its run covers. In a bucket, all runs of a class but the first are repeated; if a
bucket holds one class only, its first run is unique; if it holds several, the first runs of all
classes go on, since they may agree in part.
Round 2 refines these runs: parts of ``PART`` strings are bucketed by the bytes that all strings of
the part share (identifiers of later offsets) and sorted by the bytes the part covers.
Round 3 does the same with single strings.

Identifiers are 64-bit hashes that a ladder of doublings makes for all offsets of a text; two
strings are taken as equal if they agree in bucket and identifier, 128 bits. A bucket streams
through its task, whose state is one run, so no group is ever held.

Defined results:

- null or empty text: no bytes, nothing removed, the digest of the empty string;
- null ids sort before all ids;
- rows with equal ids but different texts are ordered by a hash of the text; rows equal in both
  are one document and get the same result;
- an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import bounded_batches, stage, text_list

LENGTH = 100
Q = 32
PART = 8
#: Strings looked at together; a longer text goes in pieces.
PIECE = 1 << 19

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE = np.random.default_rng(100).integers(1, 2**63, 256, dtype=np.uint64)

RUN = "bucket long, ctx long, id long, th long, at long, n int, anchor int"
NAMES = ["bucket", "ctx", "id", "th", "at", "n", "anchor"]


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _K1
    x += b
    x ^= x >> np.uint64(29)
    x *= _K2
    return x


def ladder(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the 32 and of the 64 bytes from each place on."""
    h = _BYTE[data]
    k, out = 1, {}
    while k < 64:
        h = _join(h[:-k], h[k:]) if len(h) > k else h[:0]
        k *= 2
        out[k] = h
    return out[32], out[64]


def _span(h64: np.ndarray, at: np.ndarray, length) -> np.ndarray:
    """Identifiers of the bytes [at, at + length), 64 <= length <= 128."""
    return _join(_join(h64[at], h64[at + length - 64]), np.asarray(length, np.uint64) * _K2)


def anchors(text: bytes, offsets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of the documents that ``text`` concatenates: document, first string, strings, anchor
    less first string, bucket, class; places count from the document's start."""
    data = np.frombuffer(text, np.uint8)
    h32, h64 = ladder(data)
    n_strings = len(data) - LENGTH + 1
    low = (h32 & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h32), dtype=np.uint64)
    wide = 1  # strings of LENGTH bytes have LENGTH - Q + 1 q-grams
    goal = LENGTH - Q + 1
    while wide * 2 <= goal:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    low = np.minimum(low[:n_strings], low[goal - wide:goal - wide + n_strings])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(n_strings + 1, np.int32)  # strings that don't cross the end of a document
    ok = lengths >= LENGTH
    np.add.at(inside, offsets[ok], 1)
    np.add.at(inside, np.minimum(offsets[ok] + lengths[ok] - LENGTH + 1, n_strings), -1)
    anchor[np.cumsum(inside[:-1]) == 0] = -1
    cut = np.flatnonzero(np.diff(anchor, prepend=-2))
    end = np.append(cut[1:], n_strings)
    real = anchor[cut] >= 0
    lo, hi = cut[real], end[real] - 1
    a = anchor[lo]
    doc = np.searchsorted(offsets, lo, "right") - 1
    ctx = _join(_join(_span(h64, lo, LENGTH), _span(h64, hi, LENGTH)), ((a - lo) * 256 + hi - lo).astype(np.uint64))
    return doc, lo - offsets[doc], hi - lo + 1, a - lo, h32[a], ctx


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray, np.ndarray]]:
    """(rows, places of their first bytes, bytes, offsets, lengths): short texts together, long ones cut."""
    rows, size = [], 0

    def packed(rows):
        n = np.array([len(texts[i]) for i in rows])
        return rows, [0] * len(rows), b"".join(texts[i] for i in rows), np.cumsum(n) - n, n

    for i, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        if len(t) > PIECE + LENGTH:
            for lo in range(0, len(t) - LENGTH + 1, PIECE):
                piece = t[lo:lo + PIECE + LENGTH - 1]
                yield [i], [lo], piece, np.array([0]), np.array([len(piece)])
            continue
        rows.append(i)
        size += len(t)
        if size > PIECE:
            yield packed(rows)
            rows, size = [], 0
    if rows:
        yield packed(rows)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text); th tells rows of equal ids apart and is 0 where ids don't repeat."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    repeats = not own.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    return own.select("id", (F.xxhash64("text") if repeats else F.lit(0).cast("long")).alias("th"), "text")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 1: the runs of each document."""
    for b in batches:
        ids, th, texts = b.column("id"), b.column("th"), text_list(b, "text")
        for rows, first, data, offsets, lengths in _pieces(texts):
            doc, at, n, anchor, bucket, ctx = anchors(data, offsets, lengths)
            row = pa.array(np.array(rows)[doc])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.view(np.int64)), pa.array(ctx.view(np.int64)), ids.take(row), th.take(row),
                 pa.array(at + np.array(first)[doc]), pa.array(n, pa.int32()), pa.array(anchor, pa.int32())], NAMES)


def _finer(size: int):
    """Rounds 2 and 3: runs cut into parts of ``size`` strings, counted back from the anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in enumerate(text_list(b, "text")):
                own = b.column("runs")[i].as_py()
                at = np.array([r["at"] for r in own])
                n = np.array([r["n"] for r in own])
                anchor = at + np.array([r["anchor"] for r in own])
                out = [[], [], [], [], []]
                for lo in range(0, len(t), PIECE):  # runs by the piece their first string is in
                    mine = (at >= lo) & (at < lo + PIECE)
                    if mine.any():
                        base = max(0, lo - LENGTH)  # a part's shared bytes may begin before its strings
                        _, h64 = ladder(np.frombuffer(t[base:lo + PIECE + 3 * LENGTH], np.uint8))
                        for k, v in enumerate(_parts(h64, at[mine] - base, n[mine], anchor[mine] - base, size)):
                            out[k].append(v + base if k == 2 else v)
                if out[0]:
                    bucket, ctx, start, m, back = (np.concatenate(x) for x in out)
                    k = len(bucket)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array([b.column("id")[i].as_py()] * k, pa.int64()), pa.array([b.column("th")[i].as_py()] * k, pa.int64()),
                         pa.array(start), pa.array(m, pa.int32()), pa.array(back, pa.int32())], NAMES)
    return run


def _parts(h64: np.ndarray, at: np.ndarray, n: np.ndarray, anchor: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """bucket, class, first string, strings, anchor less first string of each part."""
    near, far = (anchor - at - n + 1) // size, (anchor - at) // size  # parts by distance before the anchor
    k = far - near + 1
    which = np.repeat(np.arange(len(at)), k)
    j = near[which] + np.arange(len(which)) - np.repeat(np.cumsum(k) - k, k)
    a = anchor[which]
    lo = np.maximum(at[which], a - j * size - size + 1)
    hi = np.minimum(at[which] + n[which] - 1, a - j * size)
    shared = _span(h64, a - j * size, LENGTH - size + 1)  # bytes that all strings of the whole part have
    bucket = _join(shared, (j * 256 + size).astype(np.uint64))
    ctx = _join(_span(h64, lo, LENGTH + hi - lo), ((a - lo) * 256 + hi - lo).astype(np.uint64))
    return bucket, ctx, lo, hi - lo + 1, a - lo


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, class, document and place: those repeated, and first ones to look into."""
    last = None  # bucket, class and first row of the class that the last row belongs to
    held = None  # the only first row so far of the last bucket
    several = False  # the last bucket has classes already reported
    for b in batches:
        if not b.num_rows:
            continue
        bucket, ctx = b.column("bucket").to_numpy(), b.column("ctx").to_numpy()
        place = [b.column(c).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False) if c == "id" else b.column(c).to_numpy() for c in ("id", "th", "at")]
        n = len(bucket)
        new_bucket = np.append(last is None or bucket[0] != last[0], bucket[1:] != bucket[:-1])
        new_class = new_bucket | np.append(last is None or ctx[0] != last[1], ctx[1:] != ctx[:-1])
        first = np.maximum.accumulate(np.where(new_class, np.arange(n), -1))
        same = np.ones(n, bool)
        for k, p in enumerate(place):
            same &= p == (np.where(first >= 0, p[first], last[2][k]) if last is not None else p[first])
        group = np.cumsum(new_bucket)  # 0: goes on from the batch before
        classes = np.bincount(group, new_class, group[-1] + 1).astype(int)
        if not new_bucket[0]:
            classes[0] += 1 + several
            if held is not None and classes[0] > 1:
                yield _marked(held, np.ones(1, bool))
                held, several = None, True
        else:
            held, several = None, False
        go_on = new_class & (classes[group] > 1)
        out = ~same | go_on
        if out.any():
            keep = np.flatnonzero(out)
            yield _marked(b.take(pa.array(keep)), go_on[keep])
        if group[-1] > 0 or new_bucket[0]:  # the last bucket began in this batch
            several = bool(classes[group[-1]] > 1)
            held = None if several else b.slice(int(np.flatnonzero(new_bucket)[-1]), 1)
        f = int(first[-1])
        last = (bucket[-1], ctx[-1], [p[f] for p in place] if f >= 0 else last[2])


def _marked(b: pa.RecordBatch, go_on: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(b.column(c) for c in NAMES[2:]), pa.array(go_on)], [*NAMES[2:], "go_on"])


def _round(runs: DataFrame, name: str) -> DataFrame:
    """Sort each bucket, keep what is repeated (not go_on) and what needs a closer look (go_on)."""
    in_order = runs.repartition("bucket").sortWithinPartitions("bucket", "ctx", F.asc_nulls_first("id"), "th", "at")
    return stage(in_order.mapInArrow(_refine, "id long, th long, at long, n int, anchor int, go_on boolean"), name)


def _with_text(keyed: DataFrame, runs: DataFrame, how: str, *fields: str) -> DataFrame:
    """Documents with their ``runs``; a document's runs are bounded by its own length."""
    by_doc = runs.groupBy(F.col("id").alias("of"), F.col("th").alias("of_th")).agg(F.collect_list(F.struct(*fields)).alias("runs"))
    return keyed.join(by_doc, keyed["id"].eqNullSafe(by_doc["of"]) & (keyed["th"] == by_doc["of_th"]), how).select("id", "th", "text", "runs")


def repeated(keyed: DataFrame) -> DataFrame:
    """Runs (id, th, at, n): the n strings of ``LENGTH`` bytes from ``at`` on start earlier too."""
    found = _round(keyed.mapInArrow(_runs, RUN), "suffix-1")
    out = found.where("not go_on")
    for k, size in enumerate((PART, 1), 2):
        closer = _with_text(keyed, found.where("go_on"), "inner", "at", "n", "anchor")
        found = _round(closer.mapInArrow(_finer(size), RUN), f"suffix-{k}")
        out = out.unionByName(found.where("not go_on"))
    return out.select("id", "th", "at", "n")


def spans(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal removed spans (start, end) of one document, in order."""
    out: list[list[int]] = []
    for at, n in sorted((r["at"], r["n"]) for r in runs or ()):
        end = at + n - 1 + LENGTH
        if out and at <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([at, end])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id_col, n_bytes, spans (start, end in bytes) that go, kept (binary)."""
    bounded_batches(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, runs in zip(text_list(b, "text"), b.column("runs").to_pylist()):
                gone, kept, at = spans(runs), [], 0
                for lo, hi in gone:
                    kept.append(text[at:lo])
                    at = hi
                kept.append(text[at:])
                rows.append((len(text), [{"start": lo, "end": hi} for lo, hi in gone], b"".join(kept)))
            cols = list(zip(*rows)) or [(), (), ()]
            kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["id", "n_bytes", "spans", "kept"])

    joined = _with_text(keyed, repeated(keyed), "left", "at", "n")
    return joined.mapInArrow(run, "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary").withColumnRenamed("id", id_col)


def removed(spans_col: str) -> Column:
    return F.aggregate(spans_col, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
