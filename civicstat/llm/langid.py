"""Language identification by prediction by partial matching.

Per language, a variable-order tree of byte contexts holds how often each byte followed each
context of up to ``ORDER`` bytes. A byte's code length comes from the longest context known:
with n bytes seen after a context, u of them distinct, a byte seen c times has probability
c / (n + u) and the escape to the next shorter context u / (n + u); below order 0 all 256 bytes
are equally likely. The statistics are frozen after training, so a code length depends only on
the bytes before it, and the text's language is the one that codes the whole text in the fewest
bits.

Training reads a bounded sample: ``TRAIN_DOCS`` documents of each language, those with the
smallest hash of their id. The tree keeps the ``NODES`` most frequent contexts, so the model that
goes to the tasks is bounded by ``NODES`` x alphabet x languages.

Defined results:

- null text, or no letter in it: ``und`` with score 0;
- nothing to learn from: ``und`` for every row;
- equal code lengths: the language that sorts first;
- null id: never trained on, not held out; repeated rows: one result each;
- an empty table gives an empty result; only the named columns are read by ``predict``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicstat.llm.common import bounded_batches, released

#: Bytes of context at most.
ORDER = 3
#: Documents of each language that the statistics are taken from.
TRAIN_DOCS = 600
#: Contexts in the tree.
NODES = 8192
#: Bytes whose costs are summed in a row, and those of them that are held at once.
CHUNK, PIECE = 1 << 20, 1 << 16
UND = "und"
#: Rows with a prediction below this score are rejected by ``identified``.
MIN_SCORE = 0.5


@dataclass
class Model:
    """``node`` maps the last ORDER symbols to a context, ``bits[context * symbols + s]`` has a cost by language."""

    langs: list[str]
    symbol: np.ndarray
    n_symbols: int
    node: np.ndarray
    bits: np.ndarray

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= CHUNK:
                size += len(texts[end])
                end += 1
            if size:
                self._add(texts[at:end], out[at:end])
            at = end
        return out

    def _add(self, texts: list[bytes], out: np.ndarray) -> None:
        n = np.array([len(t) for t in texts])
        starts = np.concatenate(([0], np.cumsum(n)[:-1]))
        s = self.symbol[np.frombuffer(b"".join(texts), np.uint8)]
        for lo in range(0, len(s), CHUNK):  # a very long text goes in pieces that see the bytes before them
            hi = min(lo + CHUNK, len(s))
            cuts = np.clip(starts, lo, hi), np.clip(starts + n, lo, hi)
            sums, before = [np.zeros_like(out), np.zeros_like(out)], np.zeros((1, out.shape[1]))
            for p in range(lo, hi, PIECE):
                q = min(p + PIECE, hi)
                total = np.cumsum(np.concatenate((before, self._costs(s, p, q, starts[n > 0]))), 0)
                for cut, own in zip(cuts, sums):
                    here = (cut >= p) & (cut <= q)
                    own[here] = total[cut[here] - p]
                before = total[-1:].copy()
            out += sums[1] - sums[0]

    def _costs(self, s: np.ndarray, lo: int, hi: int, starts: np.ndarray) -> np.ndarray:
        """Cost by language of the symbols [lo, hi) of texts that begin at ``starts``."""
        a = self.n_symbols
        ctx = np.zeros(hi - lo, np.int64)
        for back in range(ORDER, 0, -1):
            ctx *= a
            k = max(0, back - lo)
            ctx[k:] += s[lo - back + k:hi - back]
        heads = starts[(starts < hi) & (starts + ORDER > lo)]
        for j in range(ORDER):  # contexts don't reach into the text before
            at = heads + j - lo
            at = at[(at >= 0) & (at < hi - lo)]
            ctx[at] = ctx[at] % a**j if j else 0
        return self.bits[self.node[ctx] * a + s[lo:hi]]


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, per_lang: int) -> DataFrame:
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
              .withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= per_lang).select("id").distinct())
    own = rows.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return own.join(F.broadcast(chosen), "id", "left_semi").select("lang", "text")  # per_lang ids of each language at most


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, order, gram, n): grams of order + 1 bytes, the oldest byte in the highest place."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs) if x == lang]
            for order in range(ORDER + 1):
                grams = []
                for t in own:
                    b = np.frombuffer(t, np.uint8).astype(np.int64)
                    if len(b) > order:
                        g = np.zeros(len(b) - order, np.int64)
                        for j in range(order + 1):
                            g = g * 256 + b[j:len(b) - order + j]
                        grams.append(g)
                if grams:
                    value, n = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(value)), pa.array(np.full(len(value), order, np.int32)), pa.array(value), pa.array(n)], ["lang", "order", "gram", "n"])


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, per_lang: int = TRAIN_DOCS, nodes: int = NODES) -> Model | None:
    """The frozen statistics of the sample; None if no row can be learned from."""
    bounded_batches(docs.sparkSession)
    counts = (_sample(docs, id_col, text_col, lang_col, usable, per_lang).mapInArrow(_count, "lang string, order int, gram long, n long")
              .groupBy("lang", "order", "gram").agg(F.sum("n").alias("n")))
    # grams of the bounded sample, by language
    return build(counts.toPandas(), nodes)


def build(counts, nodes: int = NODES) -> Model | None:
    if not len(counts):
        return None
    langs = sorted(counts["lang"].unique())
    order = counts["order"].to_numpy()
    gram = counts["gram"].to_numpy()
    n = counts["n"].to_numpy(np.float64)
    lang = np.searchsorted(langs, counts["lang"].to_numpy(dtype=object).astype(str))
    used = np.unique(gram[order == 0])
    a = len(used) + 1  # symbol 0 stands for every byte not seen
    symbol = np.zeros(256, np.int32)
    symbol[used] = np.arange(1, a)
    digits = [np.where(order >= j, symbol[(gram >> (8 * j)) & 255], 0) for j in range(ORDER + 1)]  # [0] is the byte itself
    # contexts in order of length, each the most frequent of its kind; the empty one is node 0
    ctx = sum(digits[j].astype(np.int64) * a ** (j - 1) for j in range(1, ORDER + 1))
    keys = [np.zeros(1, np.int64)]
    orders = [0]
    room = nodes
    totals = []
    for k in range(1, ORDER + 1):
        at = order == k
        value, where = np.unique(ctx[at], return_inverse=True)
        totals.append((np.full(len(value), k), value, np.bincount(where, n[at], len(value))))
    size, value, total = (np.concatenate(x) for x in zip(*totals))
    best = np.lexsort((value, size, -total))[:room]
    best = best[np.lexsort((value[best], size[best]))]
    id_of = {(0, 0): 0}
    parents = [0]
    for i in best.tolist():
        k, v = int(size[i]), int(value[i])
        j = k - 1
        while (j, v % a**j if j else 0) not in id_of:
            j -= 1
        parents.append(id_of[(j, v % a**j if j else 0)])
        id_of[(k, v)] = len(parents) - 1
        keys.append(np.array([v]))
        orders.append(k)
    count = np.zeros((len(parents), a, len(langs)), np.float32)
    known = np.array([id_of.get((int(k), int(c)), -1) for k, c in zip(order, ctx)])
    hit = known >= 0
    np.add.at(count, (known[hit], digits[0][hit], lang[hit]), n[hit])
    prob = np.empty_like(count)
    below = np.zeros((a, len(langs)), np.float32) + 1 / 256
    for i, parent in enumerate(parents):  # shorter contexts come first
        c = count[i]
        seen, kinds = c.sum(0), (c > 0).sum(0)
        shorter = below if i == 0 else prob[parent]
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.where(c > 0, c / (seen + kinds), kinds / (seen + kinds) * shorter)
        prob[i] = np.where(seen > 0, own, shorter)
    node = np.zeros(a**ORDER, np.int32)
    for k in range(1, ORDER + 1):  # longer contexts overwrite what shorter ones filled in
        step = a**k
        for (size_, v), i in id_of.items():
            if size_ == k:
                node[v::step] = i
    return Model(langs, symbol, a, node, -np.log2(prob).reshape(-1, len(langs)))


def predict(docs: DataFrame, model: Model | None, id_col: str | None, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (``id_col`` by default) with lang_pred, score and bits_per_byte.

    The score is the language's share of probability, given equal priors.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    names = keep if keep is not None else [id_col]
    held = spark.sparkContext.broadcast(model)  # bounded by NODES
    hidden = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*[F.col(c) for c in names], F.col(text_col).cast("string").alias("__text"), hidden.alias("__letters"))
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            n = b.num_rows
            if m is None or not n:
                lang, score, bits = [UND] * n, np.zeros(n), np.zeros(n)
            else:
                texts = [t or b"" for t in b.column(b.num_columns - 2).cast(pa.binary()).to_pylist()]
                length = m.lengths(texts)
                best = length.argmin(1)
                least = length[np.arange(n), best]
                ok = np.array(b.column(b.num_columns - 1).to_pylist(), bool)
                lang = [m.langs[k] if x else UND for k, x in zip(best, ok)]
                score = np.where(ok, 1 / np.exp2(least[:, None] - length).sum(1), 0.0)
                bits = np.where(ok, least / np.maximum([len(t) for t in texts], 1), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(lang, pa.string()), pa.array(score), pa.array(bits)], [*b.schema.names[:-2], "lang_pred", "score", "bits_per_byte"])

    return rows.mapInArrow(released(run), f"{out}lang_pred string, score double, bits_per_byte double")


def fold(id_col: str) -> Column:
    """crc32 of the id as text, mod 4; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told, with the columns of ``docs``."""
    model = train(docs, id_col, text_col, lang_col, fold(id_col) != 2)
    inner = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    told = predict(docs.toDF(*inner), model, None, inner[docs.columns.index(text_col)], keep=inner)
    return told.where((F.col("lang_pred") != UND) & (F.col("score") >= min_score)).select(*inner).toDF(*docs.columns)
