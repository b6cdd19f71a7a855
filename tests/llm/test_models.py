"""Quality rules, the quality classifier and the class-based language model."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import awkward, prose, table
from parity import compare, connect
from skyledger.llm import queries
from skyledger.llm import brown
from skyledger.llm.brown import class_scores, exchange
from skyledger.llm.quality_model import isotonic, quality_scores
from skyledger.llm.quality_rules import drop_low_quality, quality_verdicts

SF = "/root/testdata/sf0.001"
SPACE = r"[\x20\x09-\x0D]"


def slow_measures(text):
    text = text or ""
    words = [w for w in re.split(SPACE + "+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_and_base_verdicts(spark):
    rows = awkward() + [
        (20, "a b c d e " * 3), (21, "a " * 9), (22, "a " * 10), (23, "x y z w v u " + prose(40, 1) + " x y z w v"),
        (24, "l\n\nl\n l\nl\t\nm\n"), (25, "#*$%&|<> " * 4), (26, "a b a b a b a b a b a b q r s t u"), (27, "é\U0001f600 ü" * 9),
    ]
    got = quality_verdicts(table(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ours = sorted((str(r.doc_id), *(r[n] for n in names), r.base_failed) for r in got)
    want = []
    for i, t in rows:
        m = slow_measures(t)
        want.append((str(i), *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    assert ours == sorted(want)
    assert all(not r.kept for r in got if r.base_failed)


def test_a_bad_host_takes_its_documents_along(spark):
    good = [(3 * i, prose(30, i)) for i in range(60)]
    bad = [(3 * i + 1, "buy now " * 3 if i % 10 else prose(30, i)) for i in range(60)]
    odd = [(2, "short"), (None, prose(30, 99)), (None, "short")]
    got = quality_verdicts(table(spark, good + bad + odd)).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {i for i, _ in good} | {None}
    assert {r.doc_id for r in got if not r.kept and not r.base_failed} == {i for i, t in bad if len(t) > 100}


def test_dropped_rows(spark):
    docs = table(spark, awkward())
    out = drop_low_quality(docs)
    assert out.dtypes == docs.dtypes
    assert {r.row_key for r in out.collect()} == {"clash"}
    assert {r.doc_id for r in out.collect()}.isdisjoint({2, 3, 4, 7, 8})


@pytest.mark.parametrize("name", ["op10_quality_rules"])
def test_rules_equal_their_sql_and_use_no_python(spark, name):
    df = queries.QUERIES[name](spark, SF)
    ours, theirs, extra, missing = compare(df, connect(SF), queries.ORACLES[name])
    assert (extra, missing) == ({}, {}) and ours == theirs > 0


def labelled():
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(300):
        junk = rng.random() < 0.4
        docs.append((i, "!! ".join(prose(40, i).upper().split()) if junk else prose(60, i)))
        labels.append((i, 0 if junk else 1))
    return docs, labels + [(5000, 1), (None, 0), (7, None)]


def test_quality_scores(spark):
    docs, labels = labelled()
    rows = docs + [(1000 + i if i is not None else None, t) for i, t in awkward()]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_scores(table(spark, rows), known).collect()
    assert len(got) == len(rows)
    truth, right, held = dict(labels), 0, 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (1 if r.score >= 0.5 else 0)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.held_out and r.doc_id < 300 and truth[r.doc_id] is not None:
            held, right = held + 1, right + (r.predicted == truth[r.doc_id])
    assert right >= 0.95 * held > 50


def test_held_out_labels_are_never_read(spark):
    docs, labels = labelled()
    turned = [(i, 1 - y if i is not None and y is not None and zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    scores = []
    for some in (labels, turned):
        df = quality_scores(table(spark, docs), spark.createDataFrame(some, "doc_id long, quality int"))
        scores.append({r.doc_id: round(r.score, 9) for r in df.collect()})
    assert scores[0] == scores[1]


def test_scores_without_labels_or_rows(spark):
    docs = table(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(5, 1)], "doc_id long, quality int")
    assert quality_scores(docs, one).count() == docs.count()
    assert quality_scores(docs.filter(F.lit(False)), one).collect() == []
    assert quality_verdicts(docs.filter(F.lit(False))).collect() == []
    assert class_scores(docs.filter(F.lit(False))).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op9_quality_classifier(spark, sf).filter("held_out")
    known = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right, n = known.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right >= 0.99 * n > 1000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 5)), min_size=1, max_size=30))
def test_isotonic(points):
    y, w = (np.array(c, float) for c in zip(*points, strict=True))
    level = isotonic(np.arange(len(y)), y, w)
    assert len(level) == len(y) and (np.diff(level) >= -1e-12).all()
    # The fit is the largest of the means from below, the smallest from above.
    mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
    for i in range(len(y)):
        want = max(min(mean(a, b) for b in range(i + 1, len(y) + 1)) for a in range(i + 1))
        assert abs(level[i] - want) < 1e-9


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(0)
    bigrams = rng.poisson(1.2, (30, 30)).astype(float)

    def likelihood(of):
        member = np.eye(5)[of]
        table = member.T @ bigrams @ member
        f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return f(table) - f(table.sum(0)) - f(table.sum(1))

    of = exchange(bigrams, 5, 50)
    assert of[0] == 0 and (of[1:] > 0).all()
    for unit in range(1, 30):
        for other in range(1, 5):
            moved = of.copy()
            moved[unit] = other
            assert likelihood(moved) <= likelihood(of) + 1e-6


def lower_words(text):
    return (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()


@pytest.mark.parametrize("counted", [100_000, 20])
def test_class_scores(spark, counted):
    rows = awkward() + [(100 + i, prose(200, i)) for i in range(60)]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter()
    for i, t in rows:
        if not out(i):
            count.update([*lower_words(t), None])
    n, v = sum(count.values()), len(count)
    got = class_scores(table(spark, rows), head=20, classes=6, counted=counted).collect()
    want = []
    for i, t in rows:
        x = [*lower_words(t), None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x)
        want.append((str(i), out(i), len(x), sum(count[w] > 0 for w in x), n, round(base, 5)))
    ours = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got]
    assert sorted(ours) == sorted(want)
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)


def test_class_probabilities_sum_to_one(spark):
    """After any word, known words and one unseen word of each class have all the probability."""
    from skyledger.llm.brown import GROUPS, ClassModel, Units, group_of

    words = [w for t in ("a b a c d a b", "b a e f a b") for w in t.encode().split()]
    units = Units([b"a", b"b"])
    bigrams = np.zeros((units.size, units.size))
    for text in (b"a b a c d a b", b"b a e f a b"):
        u = units.of(text.split())
        np.add.at(bigrams, (u[:-1], u[1:]), 1)
    count = Counter(words)
    types = np.zeros(units.size)
    types[0] = types[1] = types[2] = 1
    for w in set(words) - {b"a", b"b"}:
        types[units.size - GROUPS + group_of(w)] += 1
    model = ClassModel(units, bigrams, types, 4)
    for before in range(4):
        total = 0.0
        for cls in range(4):
            known = [c for w, c in [*count.items(), (None, 2)] if model.of[0 if w is None else units[w]] == cls]
            mass = sum(c + 1 for c in known) + 1
            total += 10 ** model.step[before, cls] * mass / 10 ** model.room[cls]
        assert abs(total - 1) < 1e-6


def test_the_class_model_beats_unigrams_on_held_out_texts(spark):
    got = queries.op7_class_bigrams(spark, "/root/testdata/sf0.01").filter("held_out")
    score, base = got.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > 0.97 * base and got.count() > 50


def two_kinds():
    """Texts whose words a0zz to a39zz and b0zz to b39zz share their ending and no neighbour."""
    rng = random.Random(4)
    some = lambda kind: f"{kind}{rng.randrange(40)}zz"
    return [" ".join(f"the {some('a')} of {some('b')}" for _ in range(30)) for _ in range(40)]


def recounted(texts, of, classes):
    table = np.zeros((classes, classes))
    for t in texts:
        line = [0, *(of[w] for w in t), 0]
        np.add.at(table, (line[:-1], line[1:]), 1)
    return table


def clustered(spark, texts, hot, k=6):
    """Both exchanges with their pieces, and the class of each word that is a unit."""
    train = spark.createDataFrame([(b" ".join(t).decode(),) for t in texts], "text string")
    frequent = [w for w, _ in Counter(w for t in texts for w in t).most_common(hot)]
    units = brown.Units(frequent)
    pairs = brown._pairs(train, units)
    of_units = pairs.filter(F.col("a") < brown.RARE)
    sides = of_units.selectExpr("a AS w", "0 AS side", "b AS v", "n").unionByName(of_units.selectExpr("b AS w", "1 AS side", "a AS v", "n"))
    first = np.array([0, *(1 + np.arange(units.size - 1) % (k - 1))])
    moves = brown.UnitExchange(sides, first, np.arange(units.size), k)
    return train, frequent, units, pairs, moves


def test_units_move_and_each_batch_raises_the_likelihood(spark, hot=30):
    texts = [t.encode().split() for t in two_kinds()] + [[], [b"the"]]
    _, frequent, units, _, moves = clustered(spark, texts, hot)
    steps = moves.run(4)
    assert len(steps) > 1 and steps == sorted(steps) and brown.likelihood(moves.table) > steps[-1]
    of = {w: moves.of[units[w]] for t in texts for w in t}
    assert (recounted(texts, of, 6) == moves.table).all()
    assert moves.of[0] == 0 and 0 not in moves.of[1:]


@pytest.mark.parametrize("size", [400, 1 << 17])
def test_packed_pairs_are_the_pairs(spark, size, monkeypatch):
    """Passes read few rows of many pairs each, whatever the width of the numbers."""
    monkeypatch.setattr(brown, "PACKED", 7)
    rng = random.Random(4)
    rows = [(rng.randrange(size), i % 2, size - 1 - i, (1 << 40) + i) for i in range(100)]
    sides = spark.createDataFrame(rows, "w long, side int, v long, n long").coalesce(1)
    packed = brown._packed(sides, size).toArrow()
    assert packed.num_rows == 15
    found = [brown._unpacked(b, size) for b in packed.to_batches()]
    assert sorted(zip(*(np.concatenate(c).tolist() for c in zip(*found, strict=True)), strict=True)) == sorted(rows)


@pytest.mark.parametrize("hot", [0, 7, 70_000])
def test_encoded_texts_hold_every_word(spark, hot):
    """Units, ids and hashes of all words, whatever the white space and the width of the numbers."""
    rows = awkward() + [(500, " \tA\x0bb\x0c\x1cc\x85d\u2003e "), (501, "x"), (502, " ")] + [(600 + i, prose(50, i)) for i in range(9)]
    words = sorted({w for _, t in rows for w in lower_words(t)})
    units = brown.Units((words + [b"<%d>" % i for i in range(hot)])[:hot] if hot != 7 else words[::3])
    got = brown._encoded(table(spark, rows), units).collect()
    kind, seen, want = brown._width(units.size), [], []
    assert kind == ("<u4" if hot == 70_000 else "<u2") and len({r.uid for r in got}) == len(rows)
    for r in got:
        ids = list(zip(np.frombuffer(r.rare, "<i8").tolist(), np.frombuffer(r.tails, "<i8").tolist()))
        seen.append((str(r.doc_id), np.frombuffer(r.units, kind).tolist(), ids))
    for i, t in rows:
        x = lower_words(t)
        md5 = [(brown.rare_id(w), int(hashlib.md5(w).hexdigest()[13:28], 16)) for w in x if units[w] >= units.size - brown.GROUPS]
        want.append((str(i), [*(units[w] for w in x), 0], md5))
    assert sorted(seen) == sorted(want)
    both = spark.createDataFrame([(w,) for w in words], "word binary").select("word", brown._rare_id("word"), brown._tail("word"))
    assert all(tuple(brown._hashes([bytes(w)])[0]) == (a, b) for w, a, b in both.collect())


def test_passes_over_texts_move_units_as_their_pairs_do(spark, monkeypatch, hot=30):
    """Every pass over the encoded texts gives the counts of the pairs, so the moves are the same."""
    monkeypatch.setattr(brown, "PIECE", 50)
    texts = [t.encode().split() for t in two_kinds()] + [[], [b"the"], [b"q1", b"q2", b"q1", b"q2", b"q3"]]
    train, _, units, pairs, moves = clustered(spark, texts, hot)
    encoded = brown._encoded(train, units)
    other = brown.TextExchange(encoded, moves.of, moves.turn, moves.classes)
    assert other.run(4) == moves.run(4)
    assert (other.of == moves.of).all() and (other.table == moves.table).all()
    found = brown._far_pairs(encoded, units).collect()
    assert sorted(found) == sorted(pairs.filter(F.col("a") >= brown.RARE).collect()) and len(found) == 3


def test_sums_of_cells_are_whole(spark):
    """Blocks from many tasks, of one to all cells, and numbers beyond 32 bits."""
    rows = [(i % 5000, 1 + i * (1 << 33)) for i in range(9000)]
    want = np.zeros(5000)
    np.add.at(want, [c for c, _ in rows], [float(n) for _, n in rows])
    df = spark.createDataFrame(rows, "c long, n long").repartition(7)
    assert (brown._cells(df, lambda b: [(b["c"].to_numpy(), b["n"].to_numpy())], 5000) == want).all()
    ones = brown._cells(df.filter("c < 3"), lambda b: [(b["c"].to_numpy(), None)], 5000)
    assert ones[:3].tolist() == [2, 2, 2] and ones.sum() == 6
    assert not brown._cells(df.filter("false"), lambda b: [(b["c"].to_numpy(), None)], 5000).any()


def test_pairs_of_units_are_not_gathered(spark, monkeypatch):
    """Their table and its sums cost more than all else: the scores come without it."""
    monkeypatch.setattr(brown, "_pairs", None)
    monkeypatch.setattr(brown, "_packed", None)
    rows = [(i, t) for i, t in enumerate(two_kinds())]
    assert class_scores(table(spark, rows), head=10, classes=6, hot=20, counted=30).count() == 40


def test_lists_of_words_go_on_in_the_next_batch():
    """Words of many rows, cut anywhere: each comes once, with its sums."""
    rng = random.Random(7)
    rows = sorted((rng.randrange(6), [(rng.randrange(1, 9) << brown.LOW) + rng.randrange(5) for _ in range(rng.randrange(4))]) for _ in range(200))
    want = {w: Counter() for w, _ in rows}
    for w, cells in rows:
        for e in cells:
            want[w][e & 4095] += e >> brown.LOW
    for size in (1, 3, 64, 300):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows[at : at + size]]), pa.array([np.array(x, "<i8").tobytes() for _, x in rows[at : at + size]])],
                names=["w", "cells"],
            )
            for at in range(0, len(rows), size)
        ]
        got = [(w, {e & 4095: e >> brown.LOW for e in x}) for ws, cells in brown._listed(iter(batches)) for w, x in zip(ws.tolist(), cells.to_pylist(), strict=True)]
        assert got == sorted(want.items())
    assert sum(len(w) for w, _ in brown._listed(iter([]))) == 0


def test_every_training_word_has_a_class_of_its_own(spark, hot=9):
    texts = [t.encode().split() for t in two_kinds()] + [[], [b"the"]]
    train, frequent, units, pairs, moves = clustered(spark, texts, hot)
    of, own = moves.of, units.size - brown.GROUPS
    inner = np.zeros((6, 6))
    for r in pairs.filter((F.col("a") < own) & (F.col("b") < own)).collect():
        inner[of[r.a], of[r.b]] += r.n
    near = brown._beside_units(train, units, of)
    rare = brown.RareExchange(near, pairs.filter(F.col("a") >= brown.RARE), inner, of[own:], 6)
    at_first = {w: of[units[w]] for t in texts for w in t}
    assert (recounted(texts, at_first, 6) == rare.table).all()
    steps = rare.run()
    assert steps and steps == sorted(steps) and brown.likelihood(rare.table) > steps[-1]
    by_id = {r.w: r.cls for r in rare.state.collect()}
    final = {w: of[units[w]] if w in frequent else by_id[brown.rare_id(w)] for t in texts for w in t}
    assert len(final) == 82 and len(by_id) == 82 - hot
    assert len({c for w, c in final.items() if w.endswith(b"zz")}) > 1
    assert (recounted(texts, final, 6) == rare.table).all()
    assert max(len(r.cells or []) for r in rare.state.collect()) <= 2 * 6


@pytest.mark.parametrize("hot", [12, 5000])
def test_scores_by_a_brute_force_class_model(spark, hot, monkeypatch):
    """The classes that were found, and everything after them computed again from the texts."""
    rows = awkward() + [(100 + i, prose(200, i)) for i in range(30)] + [(200 + i, t) for i, t in enumerate(two_kinds())]
    seen = {}
    keep = lambda name, f: lambda self, *a, **b: (f(self, *a, **b), seen.update({name: self}))[0]
    for kind in (brown.UnitExchange, brown.RareExchange):
        monkeypatch.setattr(kind, "run", keep(kind.__name__, kind.run))
    scores = []
    for counted in (10, 5000):
        got = class_scores(table(spark, rows), head=10, classes=6, hot=hot, counted=counted, sweeps=2).collect()
        scores.append(sorted((str(r.doc_id), r.n_tokens, round(r.score, 5)) for r in got))
    assert scores[0] == scores[1]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [lower_words(t) for i, t in rows if not out(i)]
    count = Counter(w for t in train for w in t)
    units, of = seen["UnitExchange"], seen["UnitExchange"].of
    frequent = sorted(count, key=lambda w: (-count[w], w))[:hot]
    groups = of[-brown.GROUPS :]
    by_id = {r.w: r.cls for r in seen["RareExchange"].state.collect()}
    cls = {w: int(of[frequent.index(w) + 1]) if w in set(frequent) else by_id[brown.rare_id(w)] for w in count}
    table_of = recounted(train, cls, 6)
    kinds = np.bincount([0, *cls.values()], minlength=6)
    tokens = table_of.sum(0)
    share = (tokens + 1e-3) / (tokens + 1e-3).sum()
    want = []
    for i, t in rows:
        words = lower_words(t)
        path = [0, *(cls[w] if w in cls else int(groups[brown.group_of(w)]) for w in words), 0]
        total = 0.0
        for word, a, b in zip([*words, None], path, path[1:]):
            c = len(train) if word is None else count[word]
            step = (table_of[a, b] + brown.PRIOR * share[b]) / (table_of[a].sum() + brown.PRIOR)
            total += math.log10(step * (c + 1) / (tokens[b] + kinds[b] + 1))
        want.append((str(i), len(words) + 1, round(total, 5)))
    close = [(a, b, pytest.approx(c, abs=1e-4)) for a, b, c in sorted(want)]
    assert scores[0] == close
