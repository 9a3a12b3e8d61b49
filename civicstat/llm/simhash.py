"""SimHash near-duplicates linked by BK-trees over shards of fingerprints.

A fingerprint has a bit set if it is set in over half of the hashes of a text's word shingles.
Fingerprints link at ``radius`` or fewer differing bits. Two such fingerprints agree in at least
one of ``radius + 1`` bit fields, so the distinct fingerprints are sharded by (field, value) and a
BK-tree in each shard finds every link; a shard above ``SHARD`` fingerprints is cut into
several trees and its members visit each. Trees travel by shuffle, not broadcast: their number
grows with the data. Each tree reports a spanning forest of its links and
``graph.components`` merges the forests.

Defined results:

- null or empty text, or one without words: fingerprint zero, linked like any other;
- fewer words than a shingle: the whole sequence is one shingle;
- null id: the row gets a fingerprint and the smallest non-null id of its component (null if none);
- repeated rows: one result each; an empty table gives an empty result;
- only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import bounded_batches, grouped_batches, stage, text_list
from civicstat.llm.graph import components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints in one BK-tree.
SHARD = 4096
#: Partitions of the shuffle of shards grow with the session's setting only.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    w = text.translate(_LOWER).split()  # bytes split at ASCII white space only
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-size] + 1)).tolist()
    hash_of = xxhash.xxh64_intdigest
    n = len(starts)
    h = np.fromiter((hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for long texts
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(id_col, fp): fp holds the 64 bits as a signed long."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _with_fingerprint(own, "text", size).select(F.col("id").alias(id_col), "fp")


def _with_fingerprint(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """The columns of ``docs``, none of which is named fp, and fp."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, size) for t in text_list(b, text_col)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))], [*b.schema.names, "fp"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())]))


class BKTree:
    """Integers keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return
        at = 0
        while d := (self.values[at] ^ value).bit_count():
            below = self.children[at].get(d)
            if below is None:
                self.children[at][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return
            at = below

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Places of the values within ``radius``, by the edges that can lead to them."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            kids = self.children[at]
            if len(kids) > 2 * radius + 1:
                todo.extend(kids[k] for k in range(d - radius, d + radius + 1) if k in kids)
            else:
                todo.extend(c for k, c in kids.items() if abs(k - d) <= radius)


def _fields(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of ``radius + 1`` bit fields that cover 64 bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """A spanning set (u, v) of the links among distinct fingerprints ``fp``."""
    fields = F.array(*[F.struct(F.lit(i).alias("field"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1)).alias("value")) for i, (a, w) in enumerate(_fields(radius))])
    member = fps.select("fp", F.explode(fields).alias("f")).select("fp", "f.field", "f.value")
    sizes = member.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = member.join(sizes, ["field", "value"]).withColumn("trees", F.ceil(F.col("n") / shard).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    visits = sized.select("field", "value", "fp", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"), own.alias("own")).select("field", "value", "tree", (F.col("tree") == F.col("own")).alias("in_tree"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_batches(batches, ["field", "value", "tree"]):
            pairs = list(_forest(t.column("fp").to_pylist(), t.column("in_tree").to_pylist(), radius))
            if pairs:
                u, v = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    keys = ["field", "value", "tree"]
    return visits.repartition(*keys).sortWithinPartitions(*keys, F.desc("in_tree"), "fp").mapInArrow(run, "u long, v long")


def _forest(fps: list[int], in_tree: list[bool], radius: int) -> Iterator[tuple[int, int]]:
    """Tree members come first. A pair for each link that joins two parts not yet joined."""
    mask = (1 << 64) - 1
    tree, parent = BKTree(), {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for fp, inside in zip(fps, in_tree):
        value = fp & mask
        for at in tree.near(value, radius):
            a, b = top(value), top(tree.values[at])
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield fp, _signed(tree.values[at])
        if inside:
            tree.add(value)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(id_col, fp, root, component_id): root names the component, component_id is its smallest id."""
    own = stage(fingerprints(docs, id_col, text_col, size), "simhash")
    distinct = stage(own.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius, shard), "simhash-links")
    part = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = part.join(part.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return own.join(named, "fp").select(id_col, "fp", "root", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one row of each component, that with the smallest id.

    Where rows of a component share that id, or all its ids are null, the one of the smallest
    fingerprint stays, and of equal fingerprints the smallest text.
    """
    columns = docs.columns
    found = classes(docs, id_col, text_col, size, radius)
    first = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(id_col).alias("__id"), F.min("fp").alias("__fp"))
    keep = stage(first.select("__id", "__fp"), "simhash-kept")
    # ids may repeat or be null across components; a fingerprint lies in one component only
    near = docs.join(keep.select("__id").distinct(), docs[id_col].eqNullSafe(F.col("__id")), "left_semi")
    inner = [f"c{i}" for i in range(len(columns))]
    own_id, own_text = inner[columns.index(id_col)], inner[columns.index(text_col)]
    marked = stage(_with_fingerprint(near.toDF(*inner).withColumn("__text", F.col(own_text).cast("string")), "__text", size).drop("__text"), "simhash-near")
    kept = marked.join(keep, marked[own_id].eqNullSafe(keep["__id"]) & (marked["fp"] == keep["__fp"])).select(*inner, "fp")
    if not kept.groupBy(own_id, "fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        least = kept.groupBy(own_id, "fp").agg(F.min_by(F.struct(*inner), F.coalesce(F.col(own_text).cast("string"), F.lit(""))).alias("row"))
        kept = least.select("row.*")
    return kept.select(*inner).toDF(*columns)
