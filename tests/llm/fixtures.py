"""Small tables with every awkward kind of row, and brute-force versions of the operators."""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Columns of documents, and others with names that operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, row_key string, "
    "spans string, hit string, items string, fp string, host string, x string, start string, word string"
)
PROSE = random.Random(3)
VOCABULARY = ["".join(PROSE.choices("abcdefgiklmnorstu", k=PROSE.randint(1, 9))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    """n words on lines of about ten, some upper-case or accented."""
    rng = random.Random(seed)
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    words = [w.upper() if rng.random() < 0.05 else w + "é" if rng.random() < 0.05 else w for w in words]
    return "".join(w + ("\n" if rng.random() < 0.1 else " ") for w in words)


def table(spark: SparkSession, rows: Iterable[tuple[int | None, str | None]]) -> DataFrame:
    """Documents from (id, text) pairs; the source is the id modulo 3, null for null ids."""
    full = [
        (i, t, "en", None if i is None else f"src{i % 3}", None if t is None else len(t), *["clash"] * 10)
        for i, t in rows
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, empties, ties, repeated rows, one id with two texts, copies, a very long text."""
    long = prose(30_000, 1)
    return [
        (1, prose(120, 2)),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (None, prose(120, 2)),
        (None, None),
        (5, prose(120, 2)),
        (5, prose(120, 2)),
        (6, prose(90, 4)),
        (6, prose(80, 5)),
        (7, "one"),
        (8, "one two"),
        (9, long),
        (10, long + " tail"),
        (11, prose(60, 6) + prose(70, 2) + prose(60, 7)),
        (12, "x\x0by\x0cz\ra b c\u0085d \U0001f600 word"),
        (-3, prose(200, 8)),
    ]
