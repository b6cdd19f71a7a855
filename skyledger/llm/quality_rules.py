"""Host-level quality rules in DataFrame expressions alone.

Each document is measured by array expressions over its own words and lines, without a shuffle.
Rule failures are counted by host, the hosts' rates shrunk towards an empirical beta prior, and
the verdict on the host is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import keyed_rows, quoted, row_key, written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RUN = 5
MIN_WORDS = 10
#: Rules whose failures count for a host, by column of 0 and 1.
RULES = ("few_words", "repeats", "symbols", "dup_lines")
#: A host is rejected if the shrunk rate of any rule is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (2.0, 1000.0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it inside a loop."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside runs of five that occur twice or more.

    Equal runs have equal hashes, so a text without equal hashes has no repeated run. For the
    others the runs themselves are sorted and compared.
    """

    def at(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(RUN)]

    places = F.sequence(F.lit(0), F.size(words) - RUN)

    def compare(runs: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(runs, k)["g"] == x["g"], F.lit(False))
        twice = F.filter(
            runs, lambda x, k: (F.when(k > 0, same(x, k - 1)).otherwise(False)) | same(x, k + 1)
        )
        return _let(F.array_sort(F.transform(twice, lambda x: x["i"])), covered)

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda x, k: F.least(F.coalesce(F.get(starts, k + 1) - x, F.lit(RUN)), F.lit(RUN))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    runs = F.sort_array(
        F.transform(places, lambda i: F.struct(F.concat_ws(" ", *at(i)).alias("g"), i.alias("i")))
    )
    hashes = F.transform(places, lambda i: F.xxhash64(*at(i)))
    distinct = F.size(F.array_distinct(hashes)) == F.size(words) - (RUN - 1)
    return F.when(F.size(words) <= RUN, 0).when(distinct, 0).otherwise(_let(runs, compare))


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``doc_id, row_key, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``."""
    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        quoted(host_col).cast("string").alias("host"),
        quoted(text_col).cast("string").alias("text"),
    ).select("doc_id", row_key().alias("row_key"), "host", F.coalesce("text", F.lit("")).alias("text"))
    inner = F.btrim("text", F.lit(SPACE))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, "[\\x20\\x09-\\x0D]+", -1)
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    of_lines = _let(
        lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))
    )
    of_words = _let(
        words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))
    )
    counted = rows.select(
        "doc_id",
        "row_key",
        "host",
        F.length(F.translate("text", SPACE, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        # A generator computes its input once, however many of its columns are used.
        F.inline(F.array(F.struct(of_words.alias("w"), of_lines.alias("l")))),
    )
    numbers = {
        "n_words": F.col("w.n"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_lines": F.col("l.n"),
        "n_dup_lines": F.col("l.n") - F.col("l.d"),
        "n_repeat_words": F.col("w.r"),
    }
    return counted.select(
        "doc_id", "row_key", "host", *(c.cast("long").alias(n) for n, c in numbers.items())
    )


def _failures() -> dict[str, Column]:
    rules = (
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        10 * F.col("n_symbols") > F.col("word_chars"),
        10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    )
    return {n: c.cast("int") for n, c in zip(RULES, rules, strict=True)}


def rejected_hosts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host`` of every host whose shrunk rate of some rule is above ``max_rate``.

    The prior of a rule is the beta distribution with the mean and variance of the hosts' rates,
    its weight held within ``PRIOR_WEIGHT``. Only its two numbers per rule reach the driver.
    """
    failures = _failures()
    hosts = written(
        measured.filter("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count("*").alias("n"), *(F.sum(c).alias(n) for n, c in failures.items())),
        "hosts",
    )
    low, high = PRIOR_WEIGHT
    moments = []
    for rule in RULES:
        mean = F.sum(rule) / F.sum("n")
        square = F.sum(F.col(rule) * F.col(rule) / F.col("n")) / F.sum("n")
        moments += [mean.alias(f"{rule}_mean"), (square - mean * mean).alias(f"{rule}_var")]
    prior = hosts.agg(*moments).first()
    above = F.lit(False)
    for rule in RULES:
        mean, var = prior[f"{rule}_mean"] or 0.0, prior[f"{rule}_var"] or 0.0
        weight = min(high, max(low, mean * (1 - mean) / var - 1)) if var > 0 else high
        above |= (F.col(rule) + mean * weight) / (F.col("n") + weight) > max_rate
    return hosts.filter(above).select("host")


def quality_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``.

    A document fails its own rules with fewer than 10 words, or with over a fifth of its words in
    runs that repeat. The others are kept unless their host is rejected. A null text has no words
    and fails; a row without host is judged by its own rules alone; null ids and repeated rows
    are judged like any other; other columns are ignored.
    """
    measured = written(measures(docs, id_col, text_col, host_col), "measures")
    bad = rejected_hosts(measured, max_rate).withColumn("bad_host", F.lit(True))
    failed = _failures()
    base = (failed["few_words"] + failed["repeats"]) > 0
    joined = measured.join(bad, "host", "left")
    return joined.select(
        *measured.columns,
        base.alias("base_failed"),
        (~base & F.col("bad_host").isNull()).alias("kept"),
    )


def drop_low_quality(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps, with all their columns.

    Needs the columns ``doc_id``, ``text`` and ``source``. A verdict belongs to a text and its host: of
    copies on two hosts the one on a rejected host goes and the other stays. Rows with null or empty
    texts go; rows without host or id are judged like any other, and equal rows alike.
    """
    verdicts = quality_verdicts(docs, max_rate=max_rate)
    host = F.coalesce(F.col("host"), F.lit("")), F.col("host").isNull()
    gone = verdicts.filter(~F.col("kept")).select(F.xxhash64("row_key", *host).alias("verdict_key")).distinct()
    source = F.col("row.source").cast("string")
    own = F.xxhash64("row_key", F.coalesce(source, F.lit("")), source.isNull())
    return keyed_rows(docs).withColumn("verdict_key", own).join(gone, "verdict_key", "left_anti").select("row.*")
