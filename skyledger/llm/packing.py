"""Best-fit packing of token sequences in bulk-synchronous steps.

Pieces are range-sorted by length and ranked within it by distributed tasks. What the steps work
on are runs: all unplaced pieces of one length, and all open sequences with one gap. Both are at
most as many as a sequence has tokens, whatever the size of the corpus, so a sweep over them costs
the same at any scale. A step takes the longest length left, sweeps the gaps from its successor
upwards, gives places to pieces by rank, updates the gaps of the sequences it filled, and opens
new ones for the pieces that found none. Tasks then turn ranks into places.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import narrow, written
from skyledger.llm.tokens import WordLevel, encoder, vocabulary

CAPACITY = 4096
TEXTS = 500


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Placements of ``{length: pieces}``: rows of (length, rank, sequence, offset, slots).

    A row holds for the pieces of its length from ``rank`` up to the next row's: piece r goes to
    sequence ``sequence + (r - rank) // slots``, at ``offset + (r - rank) % slots * length``.
    Where a gap holds several pieces of the length, best fit fills it before any wider one.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of (first sequence, sequences)
    sizes: list[int] = []
    placed: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            slots = gap // length
            full = min(n, left // slots)
            if full:
                placed.append((length, rank, first, capacity - gap, slots))
                add(gap - slots * length, first, full)
                rank, left = rank + full * slots, left - full * slots
            if full < n:
                rest = left if left < slots else 0
                if rest:
                    placed.append((length, rank, first + full, capacity - gap, slots))
                    add(gap - rest * length, first + full, 1)
                    rank, left = rank + rest, 0
                untouched = full + (1 if rest else 0)
                add(gap, first + untouched, n - untouched)
    return np.array(placed, np.int64).reshape(-1, 5)


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: documents as ids, cut where over capacity."""
    path = tokenizer or vocabulary("word_bpe_49k.json")
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, last = encoder(path, WordLevel), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                rows = []
                found = to_ids.encode(some["text"].to_pylist())
                for name, ids in zip(some["doc_id"].to_pylist(), found, strict=True):
                    ids += last
                    for n, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a : a + 4 * capacity]
                        rows.append((name, n, a // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema,
                )

    return narrow(docs, id_col, text_col).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _ranked(cut: DataFrame) -> DataFrame:
    """Pieces range-sorted by length, numbered within part and length; ties of a hash are split."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            lengths = batch["length"].to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(lengths, prepend=-1))
            counts = np.diff(np.append(starts, len(lengths)))
            rank = np.arange(len(lengths)) - np.repeat(starts, counts)
            for a, n in zip(starts.tolist(), counts.tolist(), strict=True):
                size = int(lengths[a])
                rank[a : a + n] += seen[size]
                seen[size] += n
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(np.full(len(rank), part, np.int32)), pa.array(rank)],
                names=[*names, "part", "rank"],
            )

    keyed = cut.withColumn("tie", F.xxhash64("doc_id", "piece", "ids_crc32"))
    ordered = keyed.repartitionByRange("length", "tie").sortWithinPartitions("length", "tie")
    return ordered.select(*names).mapInArrow(
        number,
        "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long",
    )


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    A document is its ids and ``end_id``; only longer ones than ``capacity`` are cut. Null texts
    are empty and take one token; null ids and repeated rows are packed like any other; an empty
    table gives no rows; other columns are ignored. ``tokenizer`` is the path of a tokenizer file
    that drops white space.
    """
    cut = written(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    ranked = written(_ranked(cut), "ranked")
    # At most one row per length and one more per part: lengths are contiguous over the parts.
    sizes = sorted(map(tuple, ranked.groupBy("length", "part").count().collect()))
    totals: Counter[int] = Counter()
    before: dict[tuple[int, int], int] = {}
    for length, part, n in sizes:
        before[length, part] = totals[length]
        totals[length] += n
    rows = plan(dict(totals), capacity)
    by_length = {
        int(n): rows[rows[:, 0] == n] for n in np.unique(rows[:, 0])
    }
    shared = docs.sparkSession.sparkContext.broadcast((before, by_length))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, by_length = shared.value
        for batch in batches:
            lengths = batch["length"].to_numpy(zero_copy_only=False)
            parts = batch["part"].to_numpy(zero_copy_only=False)
            rank = batch["rank"].to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            order = np.lexsort((parts, lengths))
            edges = np.flatnonzero(np.diff(lengths[order], prepend=-1) | np.diff(parts[order], prepend=-1))
            for group in np.split(order, edges[1:]):
                if not len(group):
                    continue
                length = int(lengths[group[0]])
                table = by_length[length]
                r = rank[group] + before[length, int(parts[group[0]])]
                row = table[np.searchsorted(table[:, 1], r, side="right") - 1]
                sequence[group] = row[:, 2] + (r - row[:, 1]) // row[:, 4]
                offset[group] = row[:, 3] + (r - row[:, 1]) % row[:, 4] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
