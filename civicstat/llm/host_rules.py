"""Quality rules with a verdict on hosts.

Each document gets counts and a base verdict from its own words. Failures are then summed by
host, each host's failure rate is shrunk towards a beta prior fitted to all hosts, and the
verdict on the host comes back to its documents. Everything is a Spark expression.

Defined results:

- null text: no words, so ``n_words`` is 0 and the document fails;
- null host: the documents without a host are judged together as one host;
- repeated rows count as often as they occur and each gets its own result;
- an empty table gives an empty result;
- only the three named columns are read, so further columns can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.llm.common import SPACE, stage, words

#: Documents need so many words.
MIN_WORDS = 10
#: Percentage of words that may stand in repeated windows.
MAX_REPEAT_PERCENT = 20
#: Words in a window.
WINDOW = 5
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Hosts whose shrunken failure rate is above this are rejected.
MAX_HOST_RATE = 0.5
#: Bounds on the weight of the prior, in documents.
PRIOR_WEIGHT = (1.0, 1e6)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _covered(starts: Column, size: int) -> Column:
    """Words covered by windows that begin at the ascending ``starts``."""
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + size - F.greatest(acc["end"], p)).alias("n"), (p + size).alias("end")),
        lambda acc: acc["n"].cast("long"))


def base_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str, window: int = WINDOW) -> DataFrame:
    """``id_col``, ``host_col`` and the five counts of each row."""
    raw = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cut = raw.select("id", "host", "text", words(F.col("text")).alias("w"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    grams = F.when(n >= window, F.transform(F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, window)))).otherwise(F.array().cast("array<bigint>"))
    cut = cut.select(
        "id", "host", n.cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        grams.alias("g"))
    # most texts repeat no window and need no sort; each array stays a column of its own, since
    # a lambda would work out an outer expression anew for each element
    some = F.size(F.array_distinct("g")) < F.size("g")
    by_hash = F.array_sort(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    cut = cut.select("id", "host", *COUNTS[:4], F.when(some, by_hash).alias("s"))
    twice = F.filter("s", lambda x, i: F.coalesce(F.get("s", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False)))
    cut = cut.select("id", "host", *COUNTS[:4], F.array_sort(F.transform(twice, lambda x: x["i"])).alias("starts"))
    return cut.select("id", "host", *COUNTS[:4], F.coalesce(_covered(F.col("starts"), window), F.lit(0)).cast("long").alias("n_repeat_words"))


def beta_prior(hosts: DataFrame) -> DataFrame:
    """One row (alpha, beta) by moments of the hosts' rates; ``hosts`` has n and k.

    Where all hosts have one rate (or there is one host) the prior has its greatest weight.
    """
    m = F.avg(F.col("k") / F.col("n"))
    v = F.var_pop(F.col("k") / F.col("n"))
    weight = F.when(v > 0, m * (1 - m) / v - 1).otherwise(F.lit(PRIOR_WEIGHT[1]))
    weight = F.least(F.greatest(weight, F.lit(PRIOR_WEIGHT[0])), F.lit(PRIOR_WEIGHT[1]))
    return hosts.agg((m * weight).alias("alpha"), ((1 - m) * weight).alias("beta"))


def host_verdicts(base: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n, k, rate (shrunken) and host_failed; ``base`` has host and base_failed."""
    hosts = base.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("k"))
    rate = (F.col("k") + F.col("alpha")) / (F.col("n") + F.col("alpha") + F.col("beta"))
    # the prior is one row, made by a global aggregate
    return hosts.join(F.broadcast(beta_prior(hosts))).select("host", "n", "k", rate.alias("rate"), (rate > max_rate).alias("host_failed"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts and verdicts for each row: ``id_col``, the counts, base_failed, kept, host_failed.

    The counts are written once to the shared folder; texts aren't read again for the hosts.
    Sums by host are pre-aggregated by each task, so a host with a third of all documents
    sends one row a task; its documents join the verdict in the split partitions of a skew join.
    """
    counts = base_counts(docs, id_col, text_col, host_col)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    base = stage(counts.withColumn("base_failed", failed), "host-rules")
    verdicts = host_verdicts(base, max_host_rate).select(F.col("host").alias("of"), "host_failed")
    joined = base.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left")
    return joined.select(F.col("id").alias(id_col), *COUNTS, "base_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"), "host_failed")
