"""SentencePiece BPE by a table of distinct chunks.

A model of this kind reads a text as marked words: each space is a marker that begins a word, and
one marker is put before the text. Where no piece holds a marker behind another character, no merge
crosses from the end of a word to the next marker, so the pieces of a text are those of its chunks
(a run of markers and the characters up to the next marker), one after another.

Each task keeps a table of the distinct chunks that it has met. A chunk that isn't in it yet is
segmented once: it is cut wherever no piece holds the two adjacent characters, since no merge can
cross there, and in each part the adjacent pair with the best score is merged first, the leftmost of
equals. The ids of the chunks then go to the places where the chunks stand in the texts. Decoding
joins the byte strings of the ids, without the marker that was put before the text.

Nothing is shuffled, so the work grows with the text and a frequent word is no hot key. A table for
the whole corpus would be segmented a little less often, but each task's chunks and ids would travel
twice; the README has the figures of that form.

Defined results:

- null or empty text: no ids, decoded to the empty string;
- a marker character in a text is a space, as the library has it; characters that no piece holds
  become the pieces of their bytes;
- null ids and repeated rows: one result each; an empty table gives an empty result;
- a text without spaces is one chunk, whatever its length;
- only the named columns are read.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import bounded_batches

#: A task's table starts anew once it holds chunks and parts of so many characters, or is so long.
TABLE_CHARS, TABLE_ROWS = 16_000_000, 1_000_000
#: The character that stands for a space in pieces.
MARK = "▁"
_CHUNK = re.compile(" *[^ ]+| +")


@dataclass
class Model:
    """What segmentation needs of a model file; its size is that of the vocabulary."""

    cost: dict[str, float]  # piece -> score with its sign turned, the least merges first
    ids: dict[str, int]
    byte_ids: list[int]
    raw: dict[int, bytes]  # id -> bytes in a decoded text
    pairs: set[str] = field(default_factory=set)  # adjacent characters of pieces

    def __post_init__(self):
        self.pairs = {p[i:i + 2] for p in self.cost for i in range(len(p) - 1)}

    def parts(self, chunk: str) -> list[str]:
        """A chunk (given without its first marker, others as spaces) cut where no merge can cross."""
        marked = MARK + chunk.replace(" ", MARK)
        pairs, out, start = self.pairs, [], 0
        for i in range(1, len(marked)):
            if marked[i - 1:i + 1] not in pairs:
                out.append(marked[start:i])
                start = i
        out.append(marked[start:])
        return out

    def segment(self, part: str) -> list[int]:
        """Ids of a part."""
        sym: list[str | None] = list(part)
        cost, n = self.cost, len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(c, i, t) for i in range(n - 1) if (c := cost.get(t := sym[i] + sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, text = heapq.heappop(heap)
            j = after[i]
            if sym[i] is None or j >= n or sym[i] + sym[j] != text:
                continue  # one of the two was merged meanwhile
            sym[i], sym[j] = text, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (c := cost.get(t := text + sym[k])) is not None:
                    heapq.heappush(heap, (c, i, t))
            if (k := before[i]) >= 0 and (c := cost.get(t := sym[k] + text)) is not None:
                heapq.heappush(heap, (c, k, t))
        out: list[int] = []
        for s in sym:
            if s is not None:
                own = self.ids.get(s)
                if own is None:
                    out += [self.byte_ids[b] for b in s.encode()]
                else:
                    out.append(own)
        return out


def read_model(path: str) -> Model:
    """Read a model file; raises ValueError where the method doesn't hold for it."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    trained, norm = proto.trainer_spec, proto.normalizer_spec
    kinds = pb.ModelProto.SentencePiece
    pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
    byte_ids = [i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE]
    special = [p.piece for p in proto.pieces if p.type in (kinds.USER_DEFINED, kinds.UNUSED)]
    if trained.model_type != trained.BPE or len(byte_ids) != 256 or special:
        raise ValueError(f"{path}: not a BPE model with byte fallback and without symbols of its user")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or trained.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: its normalization changes more than spaces")
    crossing = [p for p in pieces if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"{path}: pieces cross word markers: {crossing[:5]}")
    raw = {i: p.replace(MARK, " ").encode() for p, (i, _) in pieces.items()}
    raw |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
    return Model({p: -s for p, (_, s) in pieces.items()}, {p: i for p, (i, _) in pieces.items()}, byte_ids, raw)


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in _CHUNK.findall(" " + text)]
    return text.split(" ")


class _Table(dict):
    """Ids (32-bit integers) of chunks, each segmented when it is first asked for."""

    def __init__(self, model: Model):
        self.model, self.known, self.chars = model, {}, 0

    def __missing__(self, chunk: str) -> bytes:
        known, out = self.known, b""
        for part in self.model.parts(chunk):
            ids = known.get(part)
            if ids is None:
                ids = known[part] = array("i", self.model.segment(part)).tobytes()
                self.chars += len(part)
            out += ids
        self.chars += len(chunk)
        self[chunk] = out
        return out

    def full(self) -> bool:
        return self.chars > TABLE_CHARS or len(self) + len(self.known) > TABLE_ROWS


def _encode(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        table = _Table(own)
        for b in batches:
            ids, decoded, n = [], [], [0]
            for text in b.column("text").to_pylist():
                if table.full():
                    table = _Table(own)
                each = b"".join(map(table.__getitem__, chunks(text or "")))
                ids.append(each)
                n.append(len(each) // 4)
                decoded.append(b"".join(map(own.raw.__getitem__, np.frombuffer(each, np.int32).tolist()))[1:])
            listed = pa.ListArray.from_arrays(pa.array(np.cumsum(n).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("id"), listed, pa.array(decoded, pa.binary())], ["id", "token_ids", "decoded"])
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, token_ids array<int>, decoded binary) for each row, by the model file ``path``.

    The broadcast is of the size of the vocabulary.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(read_model(path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_encode(model), f"id {kind}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def id_text(column: str) -> Column:
    """Decimal ids joined by commas."""
    return F.replace(F.btrim(F.col(column).cast("string"), F.lit("[]")), F.lit(" "), F.lit(""))
