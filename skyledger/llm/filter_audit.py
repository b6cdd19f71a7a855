"""What each filter of a corpus removes under every order in which the filters could be applied.

Documents are reduced to the letters of the filters that they fail. At most 32 such masks exist, so
each part of the corpus becomes at most 32 cells with a number of documents. Every cell is folded
along all orders, which gives one struct for each order and step, weighted by the cell's documents;
the cells of a part are merged by sums, element by element.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import quoted

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = len(FILTERS)
#: What a struct of an order and step counts.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_WHITE = "\t\n\x0b\x0c\r"


def failed_by_text(text: Column) -> Column:
    """The letters of the filters A to D that a text fails. Null is an empty text.

    A: under 200 words. B: under half of the words distinct. C: over 3 % of the characters A-Z.
    D: a character of ``#$%&*|``. Words are what stands between ASCII white space.
    """
    blank = F.translate(text, _WHITE, " " * len(_WHITE))
    words = F.array_remove(F.split(blank, " "), "")

    def letters(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
        return F.concat(
            F.when(n < 200, "A").otherwise(""),
            F.when(100 * distinct < 50 * n, "B").otherwise(""),
            F.when(100 * capitals.cast("long") > 3 * F.length(text).cast("long"), "C").otherwise(""),
            F.when(text.rlike("[#$%&*|]"), "D").otherwise(""),
        )

    return F.get(F.transform(F.array(words), letters), F.lit(0))


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and the letters of what they fail.

    E, the copy of a text of a smaller id, needs the smallest id of each text. Equal texts fail the
    same of A to D, so copies are counted and never listed: first equal rows are summed, then the
    rows of a text by part and label, of which only the number at the smallest id is kept besides
    the sum. Texts are compared by SHA-256. A row without an id has no label, is no copy and is
    nobody's original; rows that share an id and text are no copies of each other. Null texts are
    empty, null parts the empty string; an id that is labelled more than once is good or toxic if
    any of its labels says so. Other columns are ignored. Empty documents give no rows.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"),
        failed_by_text(text).alias("failed"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = rows.groupBy("doc_id", "part", "failed", "digest").agg(F.count("*").alias("n"))
    marks = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
    )
    marks = marks.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    unlabelled = F.lit(False)
    known = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    known = known.withColumns({c: F.coalesce(c, unlabelled) for c in ("good", "toxic")})
    lost = rows.filter("doc_id IS NULL").withColumns({"good": unlabelled, "toxic": unlabelled})
    # By text, part and label: all rows, and the rows of the smallest id.
    groups = known.groupBy("digest", "failed", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first_id"), F.min_by("n", "doc_id").alias("at_first")
    )
    # At most four groups a part for each text, whatever the number of its copies.
    texts = groups.groupBy("digest", "failed").agg(
        F.min("first_id").alias("original"),
        F.collect_list(F.struct("part", "good", "toxic", "n", "first_id", "at_first")).alias("groups"),
    )
    listed = texts.select("failed", "original", F.inline("groups"))
    originals = F.when(F.col("first_id") == F.col("original"), F.col("at_first")).otherwise(F.lit(0))
    split = listed.select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("failed").alias("mask"), originals.alias("n")),
                F.struct(F.concat("failed", F.lit("E")).alias("mask"), (F.col("n") - originals).alias("n")),
            )
        ),
    )
    counted = split.unionByName(lost.select("part", "good", "toxic", F.col("failed").alias("mask"), "n"))
    return (
        counted.filter("n > 0")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def _fold(cell: Column, order: Column) -> Column:
    """One struct for each step of ``order``: what becomes of the cell's documents there."""
    none = F.lit(0).cast("long")

    def step(state: Column, k: Column) -> Column:
        letter = F.substring(order, k, F.lit(1))
        fails, gone = F.contains(cell["mask"], letter), state["gone"]
        here = fails & ~gone
        counts = F.struct(
            F.when(gone | fails, none).otherwise(cell["n"]).alias("kept"),
            F.when(here, cell["n"]).otherwise(none).alias("removed"),
            F.when(fails & gone, cell["n"]).otherwise(none).alias("redundant"),
            F.when(cell["mask"] == letter, cell["n"]).otherwise(none).alias("unique_fails"),
            F.when(here, cell["good"]).otherwise(none).alias("good_lost"),
            F.when(here, cell["toxic"]).otherwise(none).alias("toxic_lost"),
        )
        return F.struct((gone | fails).alias("gone"), F.array_append(state["steps"], counts).alias("steps"))

    kind = "array<struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    steps = F.sequence(F.lit(1), F.lit(STEPS))
    return F.aggregate(steps, start, step, lambda state: state["steps"])


def _sums(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS]))


def filter_interactions(cells: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of ``COUNTS`` and ``shapley``, 600 rows a part.

    ``cells`` has one row for each part and mask (``mask_cells``), so at most 32 a part meet in one
    row. ``shapley`` is what the step's filter removes, summed over all orders. No cells, no rows.
    """
    orders = F.split(F.lit(" ".join(ORDERS)), " ")  # a constant of the plan, so with every task
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])
    zeros = F.array_repeat(zero, len(ORDERS) * STEPS)
    folded = F.aggregate(
        F.col("cells"),
        zeros,
        lambda total, cell: _sums(total, F.flatten(F.transform(orders, lambda order: _fold(cell, order)))),
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = parts.select("part", F.posexplode(folded).alias("at", "counts"))
    rows = rows.select(
        "part",
        F.get(orders, (F.col("at") / STEPS).cast("int")).alias("filter_order"),
        (F.col("at") % STEPS + 1).cast("int").alias("step"),
        "counts.*",
    )
    letter = F.expr("substring(filter_order, step, 1)")
    rows = rows.withColumn("letter", letter)
    by_filter = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(by_filter, ["part", "letter"]).select("part", "filter_order", "step", *COUNTS, "shapley")
