"""The filter audit against a walk of every document along every order."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest

from fixtures import awkward, prose, table
from parity import compare, connect
from skyledger.llm.filter_audit import COUNTS, filter_interactions, mask_cells
from skyledger.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute_force(rows, labels):
    """rows: (id, text, part); labels: id -> (good, toxic)."""
    firsts = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    out = Counter()
    parts = {p or "" for *_, p in rows}
    for i, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and firsts[t] < i,
        }
        good, toxic = labels.get(i, (False, False))
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part or "", "".join(order), step)
                here = fails[f] and not gone
                out[*key, "redundant"] += fails[f] and gone
                out[*key, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                gone = gone or fails[f]
                out[*key, "kept"] += not gone
                out[*key, "removed"] += here
                out[*key, "good_lost"] += here and good
                out[*key, "toxic_lost"] += here and toxic
                out[part or "", f, "shapley"] += here
    return {
        (p, "".join(o), s): (*(out[p, "".join(o), s, c] for c in COUNTS), out[p, o[s - 1], "shapley"])
        for p in parts
        for o in permutations("ABCDE")
        for s in range(1, 6)
    }


def result(cells):
    rows = filter_interactions(cells).collect()
    found = {(r.part, r.filter_order, r.step): (*(r[c] for c in COUNTS), r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


def test_awkward_rows_against_brute_force(spark):
    loud = prose(250, 21).upper() + " # "
    rows = [*awkward(), (20, loud), (21, loud), (22, loud), (20, loud), (None, loud), (40, "a " * 300), (41, ""), (42, None), (43, "$")]
    rows = [(i, t, [None, "", "en", "de"][k % 4]) for k, (i, t) in enumerate(rows)]
    labels = [(1, 1, 0), (5, 1, 0), (5, 0, 1), (20, 1, 1), (21, 0, 1), (22, 1, None), (None, 1, 1), (99, 1, 1), (42, None, 1), (41, 1, 0)]
    docs = table(spark, [(i, t) for i, t, _ in rows]).drop("lang")
    parts = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known = {}
    for i, q, t in labels:
        if i is not None:
            g, x = known.get(i, (False, False))
            known[i] = (g or q == 1, x or t == 1)
    clashing = parts.selectExpr("*", "'x' AS mask", "'y' AS part", "1 AS n", "true AS good")
    assert result(mask_cells(clashing, marks)) == brute_force(rows, known)
    assert result(mask_cells(docs, marks, part_col="source")).keys() >= {("", "ABCDE", 1), ("src0", "EDCBA", 5)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(mask_cells(docs, none)) == {}
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert result(mask_cells(one, none)) == brute_force([(1, None, None)], {})


def test_masks_stay_few(spark):
    """Copies meet as sums: no row of the plan grows with a group of copies."""
    rows = [(i, "same text", "en") for i in range(500)]
    cells = mask_cells(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                       spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")).collect()
    assert sorted((c["mask"], c["n"], c["good"]) for c in cells) == [("A", 1, 0), ("AE", 499, 1)]


@pytest.mark.parametrize("key", ["op13_filter_audit"])
def test_oracle(spark, key):
    ours, theirs, extra, missing = compare(QUERIES[key](spark, SF), connect(SF), ORACLES[key])
    assert (extra, missing) == ({}, {})
    assert ours == theirs > 0
