"""Token files: Simple-8b words in parquet containers, with a directory of documents per block.

A word has a selector in its top four bits and as many ids of one width in the other sixty.
Selector 15 is an escape: the next word is one id in full. Every document begins with a new word,
whose place stands in the block's directory, so that documents can be read alone and a block is
decoded with array operations, selector by selector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import SLICE, narrow, row_key
from skyledger.llm.tokens import ByteLevel, encoder, vocabulary

#: Ids a word, and bits an id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
#: Ids after which a block is closed; a longer document has a block of its own.
BLOCK = 1 << 16
#: Texts that are encoded at a time.
TEXTS = 500


def pack_words(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, place of each document's first word). ``ends``: exclusive ends of the documents."""
    total = len(ids)
    ids = ids.astype(np.uint64)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(total)  # ids to the document's end
    room = np.minimum(left, COUNTS[0]).astype(np.uint8)
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    # The widest of the next ids, by how many; past the document's end nothing is wide.
    widest = {1: bits}
    choice = np.where(bits <= WIDTHS[-1], len(COUNTS) - 1, ESCAPE).astype(np.uint8)
    for selector in range(len(COUNTS) - 2, -1, -1):
        count = int(COUNTS[selector])
        head = max(c for c in widest if count - c in widest)
        both = widest[head].copy()
        if total > head:
            inside = (room[:-head] > head).view(np.uint8) * np.uint8(255)
            np.maximum(both[:-head], widest[count - head][head:] & inside, out=both[:-head])
        widest[count] = both
        choice[both <= WIDTHS[selector]] = selector
    step = np.minimum(np.append(COUNTS, [1, 1])[choice], room)
    starts, at, hops = [], 0, step.tolist()
    while at < total:
        starts.append(at)
        at += hops[at]
    starts = np.array(starts, np.int64)
    picked = choice[starts]
    spots = np.cumsum(np.where(picked == ESCAPE, 2, 1)) - np.where(picked == ESCAPE, 2, 1)
    words = np.zeros(int(spots[-1]) + (2 if picked[-1] == ESCAPE else 1) if total else 0, np.uint64)
    padded = np.concatenate([ids, np.zeros(60, np.uint64)])
    for selector in np.unique(picked):
        mine = picked == selector
        if selector == ESCAPE:
            words[spots[mine]] = np.uint64(ESCAPE << 60)
            words[spots[mine] + 1] = ids[starts[mine]]
            continue
        lanes = np.arange(COUNTS[selector])
        inside = lanes < step[starts[mine]][:, None]
        values = np.where(inside, padded[starts[mine][:, None] + lanes], np.uint64(0))
        shifted = values << (lanes * WIDTHS[selector]).astype(np.uint64)
        words[spots[mine]] = np.bitwise_or.reduce(shifted, axis=1) | np.uint64(int(selector) << 60)
    firsts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return words, spots[np.searchsorted(starts, firsts)]


def unpack_words(words: np.ndarray, places: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The ids of each document from a block's words, word places and id counts."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    # The word after an escape is an id, whatever its top bits; escapes are found in order.
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    held = np.append(COUNTS, [0, 0])[np.where(raw, 14, selectors)]
    held[raw] = 1
    first = np.cumsum(held) - held
    out = np.zeros(int(held.sum()), np.uint64)
    out[first[raw]] = words[raw]
    for selector in np.unique(selectors[~raw]):
        if selector == ESCAPE:
            continue
        mine = (selectors == selector) & ~raw
        lanes = np.arange(COUNTS[selector])
        mask = np.uint64((1 << int(WIDTHS[selector])) - 1)
        values = words[mine][:, None] >> (lanes * WIDTHS[selector]).astype(np.uint64) & mask
        out[first[mine][:, None] + lanes] = values
    return [out[a : a + n] for a, n in zip(first[places].tolist(), counts.tolist(), strict=True)]


_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("before", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("places", pa.list_(pa.int64())),
        ("words", pa.binary()),
    ]
)
_BLOCKS_DDL = (
    "part int, block int, before long, n_ids long, doc_ids array<long>, counts array<long>, "
    "places array<long>, words binary"
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all documents, each with ``end_id`` after it, in ascending doc_id order.

    Files are ordered by ``part`` and, within a part, by ``block``. Null texts are empty, null
    doc_ids come first, rows that share an id stand in the order of a hash of their text; other
    columns are ignored. ``tokenizer`` is the path of a byte-level tokenizer file.
    """
    vocabulary_path = tokenizer or vocabulary("byte_bpe_50k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, to_ids = TaskContext.get().partitionId(), encoder(vocabulary_path, ByteLevel)
        last = np.array([end_id], "<u4").tobytes()
        names, texts, size, block, before = [], [], 0, 0, 0

        def closed() -> pa.RecordBatch:
            nonlocal names, texts, size, block, before
            ids = np.frombuffer(b"".join(texts), "<u4")
            counts = np.array([len(t) // 4 for t in texts], np.int64)
            words, places = pack_words(ids, np.cumsum(counts))
            row = [part, block, before, len(ids), names, counts.tolist(), places.tolist()]
            row.append(words.astype("<u8").tobytes())
            names, texts, size, block, before = [], [], 0, block + 1, before + len(ids)
            return pa.RecordBatch.from_pylist([dict(zip(_BLOCKS.names, row, strict=True))], _BLOCKS)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                found = to_ids.encode(some["text"].to_pylist())
                for name, ids in zip(some["doc_id"].to_pylist(), found, strict=True):
                    if size and size + len(ids) // 4 >= BLOCK:
                        yield closed()
                    names.append(name)
                    texts.append(ids + last)
                    size += len(ids) // 4 + 1
        if names:
            yield closed()

    rows = narrow(docs, id_col, text_col).withColumn("tie", row_key())
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = ordered.select("doc_id", "text").mapInArrow(encode, _BLOCKS_DDL)
    blocks.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document from the files.

    ``start`` counts the ids of all documents before it, ``ids`` is little-endian unsigned 32-bit.
    Only one number per file part reaches the driver.
    """
    blocks = spark.read.schema(_BLOCKS_DDL).parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    first, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((row["part"], first))
        first += row["n"]
    starts = spark.createDataFrame(offsets, "part int, first long")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                counts, places, words = (batch[c][row] for c in ("counts", "places", "words"))
                counts = counts.values.to_numpy(zero_copy_only=False)
                places = places.values.to_numpy(zero_copy_only=False)
                parts = unpack_words(np.frombuffer(words.as_buffer(), "<u8"), places, counts)
                begin = batch["first"][row].as_py() + batch["before"][row].as_py()
                out = pa.RecordBatch.from_arrays(
                    [
                        batch["doc_ids"][row].values,
                        pa.array(begin + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()),
                    ],
                    schema=schema,
                )
                for at in range(0, out.num_rows, SLICE):
                    yield out.slice(at, SLICE)

    joined = blocks.join(F.broadcast(starts), "part")
    columns = ("before", "first", "doc_ids", "counts", "places", "words")
    return joined.select(*columns).mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary"
    )
