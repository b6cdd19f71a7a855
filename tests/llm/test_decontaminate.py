"""Benchmark decontamination against windows compared one by one."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fixtures import VOCABULARY, awkward, prose, table
from parity import compare, connect
from skyledger.llm import queries
from skyledger.llm.decontaminate import Automaton, contamination, decontaminate, is_contaminated

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def slow(rows, items, window):
    windows = {}
    for name, text in items:
        words = words_of(text)
        n = min(window, len(words))
        if name is not None and n:
            for i in range(len(words) - n + 1):
                windows.setdefault(tuple(words[i : i + n]), set()).add(name)
    out = []
    for doc, text in rows:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if who := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= who
        out.append((str(doc), len(words), len(hit), sorted(found, key=str)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(6)
    items = [(10, prose(40, 11)), (9, prose(13, 12)), (100, prose(12, 13)), (2, "One, two! 3"), (3, "one two"), (4, None)]
    items += [(5, ""), (6, "..."), (None, prose(30, 14)), (7, prose(40, 11)), (8, prose(20, 11) + prose(20, 15)), (10, "b b")]
    items += [(11, "a b a b a b a b a b a b a b a b")]
    rows = awkward() + [(50, "one two 3"), (51, "ONE  TWO"), (52, "a b " * 40), (53, "x " * 9 + "b b b")]
    for i in range(40):
        words = prose(rng.randint(0, 300), 500 + i).split()
        source = words_of(rng.choice(items)[1])
        a = rng.randint(0, len(source))
        at = rng.randint(0, len(words))
        rows.append((60 + i, " ".join(words[:at] + source[a : a + rng.randint(1, 40)] + words[at:])))
    return rows, items


@pytest.mark.parametrize("window,chars", [(13, 600_000), (13, 60), (2, 600_000)])
def test_against_brute_force(spark, window, chars):
    rows, items = cases()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(table(spark, rows), benchmark, window=window, automaton_chars=chars)
    found = sorted(((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=str)
    assert found == slow(rows, items, window)
    assert sum(r[2] for r in found) > 100


def test_automaton_of_random_items():
    rng = random.Random(1)
    for _ in range(200):
        letters = "ab" if rng.random() < 0.5 else "abcd"
        items = [(i, " ".join(rng.choices(letters, k=rng.randint(0, 12)))) for i in range(rng.randint(0, 4))]
        text = " ".join(rng.choices(letters + "z", k=rng.randint(0, 30)))
        window = rng.randint(1, 6)
        hit, found = Automaton([(i, t.encode()) for i, t in items], window).scan(text.encode().split())
        (_, _, n_hit, who), = slow([(1, text)], items, window)
        assert (int(hit.sum()), sorted(found, key=str)) == (n_hit, who)


def test_decontaminated_rows(spark):
    item = " ".join(VOCABULARY[:20])
    rows = [(1, item), (2, f"{prose(600, 1)}<<{item.upper()}!>> end"), (3, prose(50, 2)), (4, None), (5, "")]
    docs = table(spark, rows)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontaminate(docs, benchmark)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == [2, 3, 4, 5]
    assert got[2].text == f"{prose(600, 1)}<<!>> end" and got[2].n_chars == len(got[2].text)
    assert got[3].text == prose(50, 2) and got[3].row == "clash" and got[4].text is None and got[5].text == ""


def test_twentieth_of_the_words_decides(spark):
    rows = [(i, "q " * n + " ".join(VOCABULARY[:13])) for i, n in ((1, 13 * 19), (2, 13 * 19 + 1))]
    benchmark = spark.createDataFrame([(1, " ".join(VOCABULARY[:13]))], "item_id long, text string")
    got = contamination(table(spark, rows), benchmark).select("doc_id", is_contaminated().alias("c"))
    assert {r.doc_id: r.c for r in got.collect()} == {1: True, 2: False}


def test_empty_tables(spark):
    docs = table(spark, awkward())
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    nothing = benchmark.filter(F.lit(False))
    assert contamination(docs.filter(F.lit(False)), benchmark).collect() == []
    assert contamination(docs, nothing).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate(docs, nothing).count() == docs.count()


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.op1_decontamination(spark, sf)
    ours, theirs, extra, missing = compare(df, connect(sf), queries.ORACLES["op1_decontamination"])
    assert (extra, missing) == ({}, {}) and ours == theirs > 0
    none = hashlib.sha256(b"").hexdigest()
    assert df.filter(F.col("items_sha256") == none).count() == df.filter("n_items = 0").count() > 0
