"""Quality rules of documents and of their hosts, in DataFrame functions only.

Every document is measured in its own row; nothing is shuffled but one small row of failures
per task and host, and the measures of a document when its host's verdict is joined back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, lookup, text_key

#: Words of a window that counts as repeated, and the characters that count as symbols.
WINDOW, SYMBOLS = 8, "#*$%&|<>"
#: A host fails a rule when its shrunk failure rate is above this.
HOST_RATE = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR = (1.0, 10_000.0)

#: Rules that a document can fail, on the columns of ``measure``.
RULES = {
    "base": "n_words < 20 OR 100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "10 * n_dup_lines > 3 * n_lines",
}


def _without(text: Column, letters: str) -> Column:
    for letter in letters:
        text = F.replace(text, F.lit(letter), F.lit(""))
    return text


def measure(documents: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep``, n_words, word_chars, n_symbols, n_lines (lines with a
    word), n_dup_lines, n_repeat_words (words in windows that occur twice or more in the text).

    Words stand between ASCII white space.  A null text has none.  Windows are compared by a
    64-bit hash within their text.
    """
    text = text_key()
    has_word = F.length(F.btrim("x", F.lit(SPACES))) > 0
    split = documents.select("doc_id", *keep, text.alias("t")).select(
        "doc_id", *keep, "t", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0).alias("l"))
    counted = split.select(
        "doc_id", *keep, F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), SYMBOLS))).cast("long")
        .alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    windows = counted.select("*", F.when(
        F.size("h") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("h") - (WINDOW - 1)),
                                           lambda i: F.xxhash64(F.slice("h", i, WINDOW))))
        .otherwise(F.array().cast("array<long>")).alias("v")).drop("h")
    placed = F.transform("v", lambda x, i: F.struct(x.alias("v"), i.alias("i")))
    sorted_ = windows.select("*", F.when(
        F.size(F.array_distinct("v")) < F.size("v"), F.sort_array(placed)).alias("z")).drop("v")
    twice = F.filter("z", lambda x, i: F.coalesce(F.get(F.col("z"), i - 1)["v"] == x["v"], F.lit(False))
                     | F.coalesce(F.get(F.col("z"), i + 1)["v"] == x["v"], F.lit(False)))
    starts = sorted_.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("s")).drop("z")
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate("s", zero, lambda acc, at: F.struct(
        (at + WINDOW).alias("end"),
        (acc["total"] + at + WINDOW - F.greatest(acc["end"], at)).cast("long").alias("total")),
        lambda acc: acc["total"])
    return starts.select("*", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")
                         ).drop("s")


def host_rates(failures: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``failures`` (host, n, one count per rule) with the shrunk rate of each rule.

    The beta prior is fitted to the hosts by moments: its mean is the overall rate, its weight
    what the spread of the hosts' rates leaves after that of single documents.
    """
    moments = []
    for rule in rules:
        moments += [F.sum(rule).alias(f"{rule}_sum"),
                    F.sum(F.col(rule) * F.col(rule) / F.col("n")).alias(f"{rule}_square")]
    total = failures.agg(F.sum("n").alias("n"), *moments).first()
    n = float(total["n"] or 1)
    out = failures
    for rule in rules:
        mean = float(total[f"{rule}_sum"] or 0) / n
        spread = float(total[f"{rule}_square"] or 0) / n - mean * mean
        weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR[1]
        weight = min(max(weight, PRIOR[0]), PRIOR[1])
        out = out.withColumn(f"{rule}_rate", (F.col(rule) + mean * weight) / (F.col("n") + weight))
    return out


def judge(documents: DataFrame, host: str = "source", rate: float = HOST_RATE) -> DataFrame:
    """The columns of ``measure`` with base_failed, host_failed and kept, for every row.

    A document is kept unless it fails the base rule or its host fails some rule, that is, its
    shrunk rate of failing documents is above ``rate``.  A null host is no host and gets no
    verdict.  Empty and null texts have no words and fail the base rule.  A very long text is
    measured whole, in its row.  Repeated rows are
    rows like others.  Only doc_id, text and the host column are read.
    """
    scratch = Scratch(documents.sparkSession, "hostrules")
    fails = [F.expr(condition).alias(f"fails_{rule}") for rule, condition in RULES.items()]
    columns = documents.select("doc_id", "text", F.col(host).alias("host"))
    rows = scratch.keep(measure(columns, "host").select("*", *fails), "measures")
    hosts = rows.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"),
        *[F.count_if(f"fails_{rule}").alias(rule) for rule in RULES])
    rates = host_rates(scratch.keep(hosts, "hosts"))
    verdicts = rates.select("host", "n", F.greatest(
        *[F.col(f"{rule}_rate") for rule in RULES]).alias("r")).select(
        "host", "n", (F.col("r") > rate).alias("host_failed"))
    total = rows.count()
    known = lookup(rows.filter(F.col("host").isNotNull()), verdicts, "host", "n", total)
    judged = known.unionByName(rows.filter(F.col("host").isNull()).withColumn(
        "host_failed", F.lit(False)))
    return judged.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("fails_base").alias("base_failed"), "host_failed",
        (~F.col("fails_base") & ~F.col("host_failed")).alias("kept"))
