"""SimHash near-duplicates: pigeonhole blocks propose pairs, the Hamming distance decides."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import (
    LOWER_ASCII,
    batch_of,
    keyed_rows,
    map_slices,
    narrow,
    row_key,
    utf8,
    written,
)
from skyledger.llm.components import components

#: Buckets above this size are split once more by the bits that their key leaves open.
HOT_BUCKET = 256
#: Shingle hashes whose bits are unpacked at a time.
CHUNK = 1 << 16
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text: bit set if it is set in over half of the shingle hashes.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer words is one
    shingle; one without words has fingerprint 0.
    """
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    hashed = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    total = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for _ in range(0, total, CHUNK):
        part = np.fromiter((hashed(g, SEED) for _, g in zip(range(CHUNK), grams, strict=False)), "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, row_key, fp`` (the fingerprint as a signed long) for every row; null text: 0."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("fp", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, shingle) if t else 0 for t in utf8(batch.column(2))]
        return batch_of(schema, batch.column(0), batch.column(1), fps)

    rows = docs.select("doc_id", row_key().alias("row_key"), "text")
    return map_slices(rows, work, "doc_id long, row_key long, fp long")


def _bits(low: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))


def _blocks(parts: int) -> list[tuple[int, int]]:
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def close_pairs(fps: DataFrame, distance: int = 3, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``a, b`` with a < b: all pairs of distinct fingerprints within ``distance`` bits.

    Fingerprints are cut into ``distance + 3`` blocks. A close pair agrees on three of them at
    least, so each fingerprint is sent to one bucket per choice of three: with 64 bits and
    distance 3 a key has 31 to 33 bits, and buckets stay small up to billions of fingerprints. A
    bucket that is large all the same is split exactly: the bits outside its key are cut into
    ``distance + 1`` pieces, of which a close pair shares one.
    """
    blocks = _blocks(distance + 3)
    kinds = []
    for n, chosen in enumerate(combinations(range(len(blocks)), 3)):
        rest = [b for i, b in enumerate(blocks) if i not in chosen]
        mask = sum(((1 << w) - 1) << lo for lo, w in (blocks[i] for i in chosen))
        signed = mask - (1 << 64) if mask >> 63 else mask
        open_bits = [bit for lo, w in rest for bit in range(lo, lo + w)]
        pieces = np.array_split(np.array(open_bits), distance + 1)
        kinds.append((n, signed, [sum(1 << int(bit) for bit in piece) for piece in pieces]))
    entry = lambda n, mask: F.struct(
        F.lit(n).alias("kind"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")
    )
    keyed = fps.select("fp", F.explode(F.array(*(entry(n, m) for n, m, _ in kinds))).alias("e"))
    keyed = keyed.select("fp", "e.kind", "e.key")
    hot = keyed.groupBy("kind", "key").count().filter(F.col("count") > hot_bucket)
    marked = keyed.join(hot, ["kind", "key"], "left")
    split = F.lit(None).cast("array<struct<piece:int,open:bigint>>")
    for n, _, pieces in kinds:
        each = [
            F.struct(
                F.lit(i).alias("piece"),
                F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("open"),
            )
            for i, m in enumerate(pieces)
        ]
        split = F.when(F.col("kind") == n, F.array(*each)).otherwise(split)
    whole = F.array(F.struct(F.lit(-1).alias("piece"), F.lit(0).cast("long").alias("open")))
    split = F.when(F.col("count").isNull(), whole).otherwise(split)
    buckets = marked.select("fp", "kind", "key", F.explode(split).alias("s")).select(
        "fp", "kind", "key", "s.piece", "s.open"
    )
    keys = ["kind", "key", "piece", "open"]
    left, right = buckets.withColumnRenamed("fp", "a"), buckets.withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return left.join(right, keys).filter((F.col("a") < F.col("b")) & close).select("a", "b").distinct()


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """``doc_id, row_key, fp, component_id`` for every row.

    ``component_id`` is the smallest doc_id reachable over links of at most ``distance`` bits,
    itself included. Copies share a fingerprint, so pairs are sought between distinct
    fingerprints only; no pair of copies is ever formed. Empty and null texts have fingerprint 0
    and are linked like any other. Null doc_ids take part but name no group: a group of such rows
    only has a null component_id. Repeated rows get equal results. Other columns are ignored.
    """
    fps = written(fingerprints(narrow(docs, id_col, text_col), shingle), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(close_pairs(classes.select("fp"), distance, hot_bucket))
    grouped = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "row_key", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their group, with all their columns.

    Rows that share a doc_id are judged by their own texts: each stays if no text of its group has a
    smaller id. Null and empty texts are a group of their own, as are rows without an id among
    themselves only where no other row of the group has one.
    """
    groups = simhash_groups(docs, shingle=shingle, distance=distance)
    kept = groups.filter(F.col("component_id").eqNullSafe(F.col("doc_id")))
    kept = kept.select("row_key").distinct()
    return keyed_rows(docs).join(kept, "row_key", "left_semi").select("row.*")
