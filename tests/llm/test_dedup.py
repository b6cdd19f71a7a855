"""SimHash groups, components, and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fixtures import VOCABULARY, awkward, prose, table
from skyledger.llm import queries
from skyledger.llm.components import components
from skyledger.llm.simhash import close_pairs, fingerprint, one_per_group, simhash_groups
from skyledger.llm.substring_dedup import Rolling, anchors, dedup_substrings

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return (text or "").encode().split()


def slow_fingerprint(text):
    words = [w.decode() for w in (text or "").translate(LOWER).encode().split()]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(ends, links):
    root = {e: e for e in ends}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {e: find(e) for e in ends}


def near_copies():
    rng = random.Random(5)
    rows = []
    for group in range(6):
        words = prose(150, 100 + group).split()
        for _ in range(5):
            changed = list(words)
            changed[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            rows.append((len(rows) + 100, " ".join(changed)))
    return rows


@pytest.mark.parametrize("hot_bucket", [0, 256])
def test_simhash_groups(spark, hot_bucket):
    rows = awkward() + near_copies()
    got = simhash_groups(table(spark, rows), hot_bucket=hot_bucket).collect()
    fps = {i: slow_fingerprint(t) for i, t in enumerate(t for _, t in rows)}
    ends = sorted(fps.values())
    links = [(a, b) for a in ends for b in ends if a < b and (a ^ b).bit_count() <= 3]
    assert any(0 < (a ^ b).bit_count() for a, b in links)
    root = slow_groups(set(ends), links)
    least = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root[fps[n]]] = min(doc, least.get(root[fps[n]], doc))
    want = sorted((str(d), fps[n], str(least.get(root[fps[n]]))) for n, (d, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in got) == want


def test_fingerprint_of_short_and_long_texts():
    assert fingerprint(b"") == 0
    for text in ("Alone", "two Words", "three little words", prose(70_000, 9)):
        assert fingerprint(text.encode()) % 2**64 == slow_fingerprint(text)


def test_dense_buckets_lose_no_pair(spark):
    rng = random.Random(1)
    center = rng.getrandbits(63)
    fps = list({center ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 6))) for _ in range(300)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}
    for hot in (0, 5, 1000):
        assert {tuple(r) for r in close_pairs(df, 3, hot).collect()} == want


def test_components_of_paths_stars_and_noise(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(links)
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links] + links[:5] + [(7, 7), (None, 3), (3, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == slow_groups({e for ab in real for e in ab}, real)


def test_one_per_group_keeps_columns_and_rows(spark):
    docs = table(spark, awkward())
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # 1 and 5 are copies, 2 to 4 have no words, and the row without id belongs to a named group.
    assert sorted(str(r.doc_id) for r in rows if r.doc_id in (1, 2, 3, 4, 5, None)) == ["1", "2"]
    assert {r.row_key for r in rows} == {"clash"}


def slow_dedup(rows, window=50):
    named = sorted(((i, words_of(t)) for i, t in rows if i is not None), key=lambda r: r[0])
    first = {}
    for i, words in named:
        for a in range(len(words) - window + 1):
            first.setdefault(tuple(words[a : a + window]), i)
    out = []
    for i, t in rows:
        words = words_of(t)
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            if i is not None and first[tuple(words[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((str(i), len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def digest(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_substring_dedup(spark):
    repeated = "same words again and " * 40
    rows = awkward() + [(20, repeated), (21, repeated + prose(30, 1)), (22, prose(49, 3)), (23, prose(49, 3))]
    rows += [(24, prose(50, 3)), (25, prose(10, 5) + prose(50, 3))]
    got = digest(dedup_substrings(table(spark, rows)))
    assert got == slow_dedup(rows)
    assert sum(r[2] for r in got) > 30_000


def test_substring_dedup_of_shared_passages_at_all_offsets(spark):
    rng = random.Random(4)
    passages = [prose(n, 50 + n).split() for n in (49, 50, 51, 75, 130)]
    rows = []
    for i in range(60):
        words = prose(rng.randint(0, 80), 1000 + i).split()
        at = rng.randint(0, len(words))
        rows.append((i, " ".join(words[:at] + rng.choice(passages) + words[at:])))
    assert digest(dedup_substrings(table(spark, rows))) == slow_dedup(rows)
    assert digest(dedup_substrings(table(spark, rows), window=8)) == slow_dedup(rows, 8)


def test_every_full_window_holds_an_anchor():
    words = (prose(300, 1) + "a b " * 100).encode().split()
    at, first, n = anchors(Rolling(words), 50)
    assert first[0] == 0 and (first[1:] == first[:-1] + n[:-1]).all() and first[-1] + n[-1] == len(words) - 49
    assert (at >= first + n - 1).all() and (at <= first + 50 - 12).all()


def test_windows_hash_alike_wherever_they_stand():
    words = prose(200, 2).encode().split()
    a, b = Rolling(words), Rolling(words[37:])
    assert (a.windows(np.arange(37, 100), 50) == b.windows(np.arange(63), 50)).all()


def test_empty_tables(spark):
    docs = table(spark, awkward()).filter(F.lit(False))
    assert simhash_groups(docs).collect() == dedup_substrings(docs).collect() == one_per_group(docs).collect() == []


def test_queries_over_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert digest(queries.op3_substring_dedup(spark, sf)) == slow_dedup(rows)
    got = {r.doc_id: r.fingerprint for r in queries.op5_simhash_dedup(spark, sf).collect()}
    assert got == {i: f"{slow_fingerprint(t):016x}" for i, t in rows}
