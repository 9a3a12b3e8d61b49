"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.session import checkpoint_dir

#: ASCII white space, the only separators of words in the contracts of this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
#: Arrow batches handed to Python are cut at so many bytes, whatever the number of rows in them.
BATCH_BYTES = "2m"


def bounded_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes as well as by rows, so that very long texts can't fill a worker.

    Leaves the setting alone where the session already has one.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not _explicit(spark, key):
        spark.conf.set(key, BATCH_BYTES)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for ``mapInArrow``, that gives Arrow's unused memory back in the end.

    Workers stay for later tasks, and an idle one would hold on to what its largest batches took.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return whole


def _explicit(spark: SparkSession, key: str) -> bool:
    """Whether the cluster set ``key`` when the session was made."""
    return spark.sparkContext.getConf().contains(key)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage like a checkpoint: what follows survives lost executors without doing
    the work again, and two readers don't do it twice.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_list(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def grouped_batches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` of a stream that is sorted by them, one table a run.

    Holds one run in memory; callers bound the size of a run.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(k).to_pylist() for k in keys]
        ids = list(zip(*cols))
        start = 0
        for i in range(n):
            if ids[i] != last:
                if start < i:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, ids[i]
        held.append(batch.slice(start, n - start))
    if held:
        yield pa.Table.from_batches(held)


#: Stands before a text's first chunk; no text holds it, since it is half of a surrogate pair.
FIRST = "\ud800"
_RARE = re.compile("[\t\x0b-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def space_chunks(text: str) -> list[str]:
    """A text cut at single spaces between other characters, where byte-level patterns begin a match.

    The space goes; ``chunk_text`` puts it back. The first chunk, which has none, is marked.
    """
    if not text:
        return []
    if "  " in text or "\n " in text or " \n" in text or _RARE.search(text):
        own = _BETWEEN.split(text)
    else:
        own = text.split(" ")
    own[0] = FIRST + own[0]
    return own


def chunk_text(chunk: str) -> str:
    return chunk[1:] if chunk[:1] == FIRST else " " + chunk
