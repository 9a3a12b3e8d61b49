"""Manifest of a table as a Merkle DAG, with inclusion proofs for its rows.

Each row is a leaf, the digest of its fields. The leaves of a group (a source) are numbered by id,
and while more than one node remains, every ``FAN`` consecutive nodes become one. The roots of the
groups, ordered by group, become the root of the manifest in the same way.

The DAG is stored by content: a record is a segment of up to ``SPAN`` levels, found by the digest of
its root, and holds the digests of the children of each node in it. Equal segments are one record.
Proofs are found by descent: the requests of all leaves below a node travel as one row, start at the
manifest's root and meet, segment by segment, the record of the digest that they have reached. In a
segment each request picks a child a level by a digit of its leaf's rank (base ``FAN``) and collects
the children it doesn't pick. Segments of a path are collected from the root down and reversed at
the end.

No step holds a group: leaves are numbered by range partitions and counts of these, and a segment
has ``FAN ** SPAN`` leaves at most. The number of joins is the number of levels over ``SPAN``.

Defined results:

- a null field is ``-``, another one its length in UTF-8 bytes, a colon and its text;
- null groups and null ids come first; rows of equal ids are ordered by their digests; repeated
  rows: one leaf each, with proofs of their own places;
- a group of one leaf has that leaf as its root; an empty table gives an empty result;
- only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicstat.llm.common import stage

FAN = 3
#: Levels in a segment.
SPAN = 6


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """Digest of a row's fields in the order given."""
    return digest(F.concat(*map(field, values)))


def levels_above(n: Column) -> Column:
    """Levels that ``n`` leaves need above them: the least power of ``FAN`` that reaches ``n``."""
    return F.size(F.filter(F.array(*[F.lit(FAN ** k).cast("long") for k in range(39)]), lambda p: p < n))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``tree``) and idx, their rank by ``order`` in their tree, and n, the size of the tree.

    Range partitions are sorted, and a row's rank is its place in its partition and the counts of the
    partitions before. Counts are one row for each tree and partition that meet.
    """
    by = [F.asc_nulls_first(c) for c in ("tree", *order)]
    placed = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("place", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("tree").alias("t"), "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(own).alias("n"))
    joined = placed.join(counts, F.col("tree").eqNullSafe(F.col("t")) & (part == F.col("part")))
    return joined.withColumn("idx", F.col("place") + F.col("shift")).drop("t", "part", "place", "shift")


def _up(level: Column) -> Column:
    """The level above: each run of ``FAN`` digests as one, the last run as long as it is."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, i * FAN + 1, F.lit(FAN)), "")))


def _segments(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Records of one pass: tree, idx, left (levels still above), span, root, levels, kids.

    ``nodes`` has tree, idx, left, digest and ``payload``; kids are its rows in order, levels[0] their
    digests and levels[span] the root alone.
    """
    span = F.least(F.lit(SPAN), F.col("left"))
    width = F.element_at(F.array(*[F.lit(FAN ** k).cast("long") for k in range(SPAN + 1)]), span + 1)
    seg = F.floor(F.col("idx") / width)
    kids = F.array_sort(F.collect_list(F.struct("idx", "digest", *payload))).alias("kids")
    grouped = nodes.groupBy("tree", seg.alias("seg"), "left").agg(kids).withColumn("span", span)
    steps = F.when(F.col("span") > 0, F.sequence(F.lit(1), F.col("span"))).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(steps, F.array(F.transform("kids", lambda k: k["digest"])), lambda acc, _: F.array_append(acc, _up(F.element_at(acc, -1))))
    return grouped.withColumn("levels", levels).select(
        "tree", F.col("seg").alias("idx"), (F.col("left") - F.col("span")).alias("left"), "span", F.element_at(F.element_at("levels", -1), 1).alias("root"), "levels", "kids")


def build(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """Records by pass, the lowest first, of trees given by tree, idx, n, digest and ``payload``; each pass is written to the shared folder."""
    nodes = nodes.withColumn("left", levels_above(F.col("n")))
    most = nodes.agg(F.max("left")).first()[0] or 0
    passes = []
    for k in range(max(1, -(-most // SPAN))):
        passes.append(stage(_segments(nodes, payload if k == 0 else []), f"merkle-pass{k}"))
        nodes = passes[-1].where("left > 0").select("tree", "idx", "left", F.col("root").alias("digest"))
    return passes


def roots(passes: list[DataFrame]) -> DataFrame:
    """(tree, digest, top): the root of each tree and the pass whose record it is."""
    out = [p.where("left = 0").select("tree", F.col("root").alias("digest"), F.lit(k).alias("top")) for k, p in enumerate(passes)]
    for more in out[1:]:
        out[0] = out[0].union(more)
    return out[0]


def _step(i: Column, level: Column, at: Column) -> Column:
    """What stands before and after the node that leaf ``i`` of a segment has in the run of its level."""
    width = F.element_at(F.array(*[F.lit(FAN ** k) for k in range(SPAN + 1)]), at + 1)
    node = F.floor(i / width).cast("int")
    digit = node % FAN
    run = F.slice(level, node - digit + 1, F.lit(FAN))
    return F.struct(F.array_join(F.slice(run, F.lit(1), digit), "").alias("before"), F.array_join(F.slice(run, digit + 2, F.lit(FAN)), "").alias("after"))


def _descent(i: Column) -> Column:
    """Unpicked children on the way from a segment's root to its leaf ``i``, the highest level first."""
    down = F.when(F.col("span") > 0, F.sequence(F.col("span") - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.transform(down, lambda at: _step(i, F.get("levels", at), at))


def descend(requests: DataFrame, passes: list[DataFrame], keep: list[str]) -> DataFrame:
    """Requests taken down to the leaves: ``keep``, kid (the leaf's row of ``build``) and path (from the root down).

    ``requests`` has digest and top of a tree's root, the path so far and ``keep``.
    """
    now = None
    for k in reversed(range(len(passes))):
        start = requests.where(F.col("top") == k).select("digest", "path", *keep)
        now = start if now is None else start.union(now)
        store = passes[k].select("root", "span", "levels", "kids").dropDuplicates(["root"])
        met = now.join(store, now["digest"] == store["root"]).drop("digest", "root")
        each = met.select("*", F.posexplode("kids").alias("i", "kid"))
        now = each.select("kid", F.concat("path", _descent(F.col("i"))).alias("path"), *keep)
        if k:
            now = now.select(F.col("kid.digest").alias("digest"), "path", *keep)
    return now


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, from the leaf up, lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(F.concat(s["before"], acc, s["after"])))


def manifest(leaves: DataFrame) -> DataFrame:
    """Leaves with subroot, root and path, the struct (before, after) of siblings a level from the leaf up.

    ``leaves`` has tree (the group), id, digest and further columns.
    """
    payload = [c for c in leaves.columns if c not in ("tree", "digest")]
    below = build(numbered(leaves, ["id", "digest"]), payload)
    subroots = roots(below).select(F.lit(0).alias("tree"), F.col("tree").alias("grp"), "digest", "top")
    above = build(numbered(subroots, ["grp"]), ["top"])
    empty = F.array().cast("array<struct<before:string,after:string>>")
    start = roots(above).select("digest", "top", empty.alias("path"), F.col("digest").alias("base"))
    groups = descend(start, above, ["base"])
    groups = groups.select(F.col("kid.digest").alias("digest"), F.col("kid.top").alias("top"), "path", "base", F.col("kid.digest").alias("subroot"))
    found = descend(groups, below, ["base", "subroot"])
    return found.select(*[F.col(f"kid.{c}").alias(c) for c in payload], F.col("kid.digest").alias("digest"), "subroot", F.col("base").alias("root"), F.reverse("path").alias("path"))


def verify(docs: DataFrame, fields: list[str], changed: dict[str, Column], id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """The manifest of ``docs`` and, for each row, the root that its proof gives for changed fields.

    ``fields`` in order make a leaf; ``changed`` maps fields to what stands in them when the manifest
    is checked. Gives id, leaf, subroot, root, path, folded_root and verified.
    """
    own = leaf([F.col(c) for c in fields])
    later = leaf([changed.get(c, F.col(c)) for c in fields])
    leaves = stage(docs.select(F.col(group_col).alias("tree"), F.col(id_col).alias("id"), own.alias("digest"), later.alias("later")), "merkle-leaves")
    leaves = leaves.withColumn("later", F.nullif("later", "digest"))
    found = manifest(leaves)
    folded = fold(F.coalesce("later", "digest"), F.col("path"))
    return found.select("id", F.col("digest").alias("leaf"), "subroot", "root", "path", folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_text(path: str) -> Column:
    """The siblings of a path, joined."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")
