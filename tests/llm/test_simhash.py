"""SimHash classes against all pairs, and their defined results."""

import random
import re

import xxhash

from civicstat.llm import graph, simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    raw = (text or "").encode()
    w = WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in raw))
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(fps, radius=2):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(edge_rows):
    for _, t in edge_rows:
        assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)


def test_classes_match_all_pairs(frame, edge_rows):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(60, 300))] for _ in range(25)]
    texts = []
    for w in base:
        for _ in range(rng.randrange(1, 6)):
            v = list(w)
            for _ in range(rng.randrange(3)):
                v[rng.randrange(len(v))] = "edit"
            texts.append(" ".join(v))
    texts += [t for _, t in edge_rows[:13]] * 2
    rng.shuffle(texts)
    got = {r.doc_id: r for r in simhash.classes(frame(list(enumerate(texts)))).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    label = plain_classes(fps)
    least = {}
    for i, x in enumerate(label):
        least.setdefault(x, i)
    assert {i: (r.fp, r.component_id) for i, r in got.items()} == {i: (signed(f), least[x]) for i, (f, x) in enumerate(zip(fps, label))}


def test_links_join_what_all_pairs_join_in_small_trees(spark):
    rng = random.Random(8)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(40):
            x ^= 1 << rng.randrange(64)  # chains of close values, all in shards of their own
            fps.add(x)
    fps = sorted(fps)
    links = simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), shard=7)
    roots = {r.node: r.root for r in graph.components(links).collect()}
    label = plain_classes(fps)
    own = {}
    for x, g in zip(fps, label):
        own.setdefault(g, set()).add(roots.get(signed(x), signed(x)))
    assert all(len(r) == 1 for r in own.values())
    assert len({next(iter(r)) for r in own.values()}) == len(own)


def test_a_tree_finds_all_within_the_radius():
    rng = random.Random(9)
    values = [rng.getrandbits(16) for _ in range(600)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[::20]:
        for radius in (0, 1, 2, 5):
            assert {tree.values[i] for i in tree.near(q, radius)} == {v for v in values if (v ^ q).bit_count() <= radius}


def test_components_of_long_paths_and_none(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 90), (5, 5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 90, 90: 90}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_dedup_keeps_one_of_each_class_with_its_columns(frame):
    rows = [(5, "same text here now", "x"), (3, "same text here now", "y"), (3, "same text here now", "y"), (None, "same text here now", "z"),
            (9, "quite another sentence stands here", "x"), (None, "only null ids in this one text", "q"), (None, "only null ids in this one text", "q"), (12, None, "n"), (11, "", "n")]
    got = simhash.dedup(frame(rows, "doc_id long, text string, root string"))
    assert got.columns == ["doc_id", "text", "root"]
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(["3", "9", "None", "11"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, component_id long, fp int")
    assert simhash.classes(empty).count() == 0
    assert simhash.dedup(empty).columns == empty.columns


def test_dedup_keeps_unlinked_documents_with_repeated_and_null_ids(frame):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(14)]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (6, texts[1]), *((None, t) for t in texts[2:12]), (None, texts[2]), (7, texts[12]), (None, texts[12]), (8, None), (8, texts[13])]
    got = [tuple(r) for r in simhash.dedup(frame(rows)).collect()]
    want = [(5, texts[0]), (5, texts[1]), *((None, t) for t in texts[2:12]), (7, texts[12]), (8, None), (8, texts[13])]
    assert sorted(map(str, got)) == sorted(map(str, want))
