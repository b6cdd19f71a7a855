"""Substring deduplication by level-wise doubling of window lengths.

A window of 50 words that repeats holds windows of 12 and 25 words that repeat. The first level
takes one 12-word window inside every 50-word window, its anchor: the one with the smallest hash,
so that equal long windows have equal anchors. Anchors seen in two documents are extended to 25
words to the left and right. Where one of these repeats too, the next length is the stretch of all
50-word windows with this anchor, some 70 words: if it starts in a smaller document as a whole, all
its windows go. What is left are the ends of shared passages: stretches that differ, though their
anchors are equal. Only there, and once for each different stretch, are windows compared singly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import map_slices, narrow, release_shuffles, row_key, utf8, written

WINDOW = 50
#: Odd bases of two rolling hashes modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i <= n, kept for the next text."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, (n + 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (pair[0], pair[1])
    return have


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of all windows of a text, of any length, from one pass over its words."""

    def __init__(self, words: list[bytes]) -> None:
        hashed = xxhash.xxh64_intdigest
        ids = np.fromiter((hashed(w) for w in words), np.uint64, len(words))
        self.n = len(words)
        self.down, self.sums = [], []
        for base in BASES:
            up, down = _powers(base, self.n)
            self.down.append(down)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * up[: self.n])]))

    def windows(self, starts: np.ndarray, length: int | np.ndarray, base: int = 0) -> np.ndarray:
        part = self.sums[base][starts + length] - self.sums[base][starts]
        return _mixed(part * self.down[base][starts]).view(np.int64)


def anchors(rolling: Rolling, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows): full windows in order, in groups of one anchor."""
    short = window // 4
    if rolling.n < window:
        return (np.zeros(0, np.int64),) * 3
    hashes = rolling.windows(np.arange(rolling.n - short + 1), short)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window - short + 1)
    step = 1 << 15
    picks = np.concatenate([views[at : at + step].argmin(axis=1) for at in range(0, len(views), step)])
    picks += np.arange(len(picks))
    first = np.flatnonzero(np.diff(picks, prepend=-1))
    return picks[first], first, np.diff(np.append(first, len(picks)))


def _first_level(docs: DataFrame, window: int) -> DataFrame:
    """Per row its word count, the digest of its words, its anchors, extensions and stretches."""
    short, half = window // 4, window // 2
    kinds = {
        "at": pa.int32(),
        "first": pa.int32(),
        "n": pa.int32(),
        "h1": pa.int64(),
        "right": pa.int64(),
        "left": pa.int64(),
        "k1": pa.int64(),
        "k2": pa.int32(),
    }

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, shas, lists = [], [], {n: [] for n in kinds}
        named = batch["doc_id"].is_valid().to_pylist()
        for text, has_id in zip(utf8(batch["text"]), named, strict=True):
            words = text.split() if text else []
            counts.append(len(words))
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            if len(words) < window or not has_id:
                for n in kinds:
                    lists[n].append([])
                continue
            rolling = Rolling(words)
            at, first, n = anchors(rolling, window)
            found = {"at": at, "first": first, "n": n, "h1": rolling.windows(at, short)}
            # An extension that leaves the text is none; the other one is inside any full window.
            for side, begin in (("right", at), ("left", at + short - half)):
                inside = (begin >= 0) & (begin + half <= rolling.n)
                hashes = rolling.windows(np.where(inside, begin, 0), half)
                found[side] = pa.array(hashes, mask=~inside).to_pylist()
            place = _mixed((at - first).astype(np.uint64) << np.uint64(32) | n.astype(np.uint64)).view(np.int64)
            found["k1"] = rolling.windows(first, n + window - 1) ^ place
            found["k2"] = (rolling.windows(first, n + window - 1, 1) >> 32).astype(np.int32)
            for name, values in found.items():
                lists[name].append(values)
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["row_key"],
                pa.array(counts, pa.int64()),
                pa.array(shas),
                *(pa.array(lists[n], pa.list_(kind)) for n, kind in kinds.items()),
            ],
            names=["doc_id", "row_key", "n_words", "sha", *kinds],
        )

    return map_slices(
        docs,
        work,
        "doc_id long, row_key long, n_words long, sha string, at array<int>, first array<int>, "
        "n array<int>, h1 array<long>, right array<long>, left array<long>, k1 array<long>, k2 array<int>",
    )


def _in_two_documents(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys seen in two documents, with the smaller id of them.

    A table of its own: Spark splits a hot key of the rows that join it only where the other side
    is no aggregate of the same stage.
    """
    ends = rows.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    return written(ends.filter("least < most").select(*keys, "least"), "twice")


def _second_level(anchored: DataFrame) -> DataFrame:
    """``doc_id, row_key, h1, first, n, k1, k2``: stretches whose anchor repeats to either side."""
    names = ("at", "first", "n", "h1", "right", "left", "k1", "k2")
    each = anchored.select("doc_id", "row_key", F.explode(F.arrays_zip(*names)).alias("a"))
    each = each.select("doc_id", "row_key", "a.*")
    repeated = _in_two_documents(each.select("doc_id", "h1"), "h1").select("h1")
    repeated = written(each.join(repeated, "h1").drop("at"), "repeated")
    sides: Column = F.explode(F.array_distinct(F.array("right", "left")))
    wide = repeated.select("doc_id", sides.alias("h2")).filter("h2 IS NOT NULL")
    wide = _in_two_documents(wide, "h2").select("h2")
    right = repeated.join(wide, F.col("right") == F.col("h2"), "left_semi")
    rest = repeated.join(wide, F.col("right") == F.col("h2"), "left_anti")
    left = rest.join(wide, F.col("left") == F.col("h2"), "left_semi")
    return right.unionByName(left).drop("right", "left")


def _windows(candidates: DataFrame, window: int) -> DataFrame:
    """``doc_id, row_key, first, k1, k2``: each full window of the ranges ``(first, n)``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        owners, starts, first, second = [], [], [], []
        for row, (text, ranges) in enumerate(zip(utf8(batch["text"]), batch["open"].to_pylist(), strict=True)):
            if not ranges:
                continue
            here = np.unique(np.concatenate([np.arange(r["first"], r["first"] + r["n"]) for r in ranges]))
            rolling = Rolling(text.split())
            owners.append(np.full(len(here), row))
            starts.append(here)
            first.append(rolling.windows(here, window))
            second.append(rolling.windows(here, window, 1) >> 32)
        if not owners:
            return None
        row = pa.array(np.concatenate(owners))
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(row),
                batch["row_key"].take(row),
                pa.array(np.concatenate(starts).astype(np.int32)),
                pa.array(np.concatenate(first)),
                pa.array(np.concatenate(second).astype(np.int32)),
            ],
            names=["doc_id", "row_key", "first", "k1", "k2"],
        )

    return map_slices(candidates, work, "doc_id long, row_key long, first int, k1 long, k2 int")


def _elsewhere(rows: DataFrame) -> DataFrame:
    """``rows`` with ``least``, the smallest document of their key; null if no other has it."""
    return rows.join(_in_two_documents(rows.select("doc_id", "k1", "k2"), "k1", "k2"), ["k1", "k2"], "left")


def kept_words(words: list[bytes], ranges: list[dict], window: int) -> list[bytes]:
    """The words outside all windows that begin in the ranges ``(first, n)``."""
    marks = np.zeros(len(words) + 1, np.int64)
    for r in ranges:
        marks[r["first"]] += 1
        marks[r["first"] + r["n"] + window - 1] -= 1
    gone = np.cumsum(marks)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, row_key, n_words, n_removed, kept, kept_sha256`` for every row.

    Words are runs without ASCII white space. A word goes if it lies in a window whose words also
    start, in this order, in a document with a smaller doc_id. ``kept`` are the words that stay,
    joined by one blank; it is null where nothing was removed (the text is as it was). A null
    text has no words. A row without id removes nothing and loses nothing; rows that share an id
    are one document and remove nothing from each other; other columns are ignored. Windows are
    compared by 96 bits of two hashes.
    """
    rows = narrow(docs, id_col, text_col).withColumn("row_key", row_key())
    keys = ["doc_id", "row_key"]
    spark = docs.sparkSession
    first = written(_first_level(rows.select(*keys, "text"), window), "anchors")
    release_shuffles(spark)
    stretches = written(_elsewhere(_second_level(first)), "stretches")
    release_shuffles(spark)
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    # Of equal stretches the smallest document's stands for all; those of one anchor that differ
    # may still share windows.
    differ = stretches.groupBy("h1").agg(
        F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("k2").alias("c"), F.max("k2").alias("d")
    )
    differ = written(differ.filter("a < b OR c < d").select("h1"), "differ")
    place = F.struct("first", "n")
    whole = stretches.filter(later).select(*keys, place.alias("gone"), F.lit(None).alias("open"))
    single = stretches.filter(~later).join(differ, "h1", "left_semi")
    single = single.select(*keys, F.lit(None).alias("gone"), place.alias("open"))
    found = whole.unionByName(single).groupBy(*keys).agg(
        F.collect_list("gone").alias("gone"), F.collect_list("open").alias("open")
    )
    candidates = written(rows.join(found, keys).select(*keys, "text", "gone", "open"), "candidates")
    release_shuffles(spark)
    full = written(_windows(candidates.select(*keys, "text", "open"), window), "windows")
    more = _elsewhere(full).filter(later).groupBy(*keys).agg(F.collect_set("first").alias("starts"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, removed, shas = [], [], []
        rows = (batch["gone"].to_pylist(), batch["starts"].to_pylist())
        for text, gone, starts in zip(utf8(batch["text"]), *rows, strict=True):
            words = text.split()
            kept = kept_words(words, gone + [{"first": s, "n": 1} for s in starts or ()], window)
            texts.append(b" ".join(kept))
            removed.append(len(words) - len(kept))
            shas.append(hashlib.sha256(texts[-1]).hexdigest())
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["row_key"],
                pa.array(removed, pa.int64()),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(shas),
            ],
            names=["doc_id", "row_key", "n_removed", "kept", "kept_sha256"],
        )

    more = written(more, "more")
    release_shuffles(spark)
    changed = map_slices(
        candidates.drop("open").join(more, keys, "left").filter("size(gone) > 0 OR starts IS NOT NULL"),
        cut,
        "doc_id long, row_key long, n_removed long, kept string, kept_sha256 string",
    )
    # Equal rows give equal results; one of each is joined back to all of them.
    changed = changed.groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in ("n_removed", "kept", "kept_sha256"))
    )
    joined = first.select(*keys, "n_words", "sha").join(changed, keys, "left")
    return joined.select(
        *keys,
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        "kept",
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
