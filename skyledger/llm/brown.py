"""Class-based bigrams: exchange clustering gives words classes, classes and words give scores.

The clustering works on units: the most frequent words, the end of a text, and all other words in
groups by their last two bytes. Few units are clustered one by one in the driver, then all of them
move in batches. Then each of the other training words moves for itself, beginning at the class of
its group, which is also that of words never seen. What is kept of a word are its counts by the class
before and after it, two numbers a class, however often it occurs. A word's probability is that of
its class after the class before it, times that of the word in its class.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import LOWER_ASCII, drop_folder, narrow, release_shuffles, scratch_path, utf8, written

#: Words that are clustered one by one, groups, classes, and sweeps of the exchange.
HEAD, GROUPS, CLASSES, SWEEPS = 1000, 256, 32, 3
#: Batches of a sweep: of units, and of the words that are none.
UNIT_BATCHES, RARE_BATCHES = 4, 2
#: Most frequent words whose counts every task holds; those of the others are joined.
COUNTED = 200_000
#: Distinct words whose pairs a task counts before it passes the counts on.
FLUSH = 300_000
#: Weight of the class frequencies in the transitions.
PRIOR = 10.0
END = 0
#: Words that are units, whose classes every task holds.
HOT = 50_000
#: Ids of the other words begin here; the last byte is the group.
RARE = 1 << 61
#: Tokens that a task counts before it passes the counts on.
WINDOW = 4_000_000
#: Texts that a task reads at a time, and the bytes that those have where texts are long.
TEXTS, TEXT_BYTES = 4000, 16 << 20
#: Neighbours that a pass looks at together.
PIECE = 1 << 16
#: Bits below a count that hold a class and the side it is on.
LOW = 12
#: Pairs of units in a row of their table, and those that a task puts in order at a time.
PACKED, ORDERED = 512, 1 << 20


def _words(text: bytes | None) -> list[bytes]:
    return text.translate(LOWER_ASCII).split() if text else []


def group_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % GROUPS


class Units(dict):
    """Unit of each word: 0 is the end, then the head words, then the groups of the others."""

    def __init__(self, head: list[bytes]) -> None:
        super().__init__((w, i) for i, w in enumerate(head, 1))
        self.size = 1 + len(head) + GROUPS
        self.endings = {}

    def __missing__(self, word: bytes) -> int:
        ending = word[-2:]
        if ending not in self.endings:
            self.endings[ending] = self.size - GROUPS + group_of(word)
        return self.endings[ending]

    def __reduce__(self):
        return Units, (list(self)[: self.size - 1 - GROUPS],)

    def of(self, words: list[bytes]) -> np.ndarray:
        """Units of a text between its two ends."""
        out = np.full(len(words) + 2, END, np.int64)
        out[1:-1] = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return out


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts one after the other, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten()
    full = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty one
    before = np.concatenate([[0], np.cumsum(full)])[lists.offsets.to_numpy()]
    return words.filter(pa.array(full)).cast(pa.binary()), np.diff(before)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: arrays of numbers take far more memory than texts and bytes."""
    for batch in batches:
        step = min(TEXTS, 1 + batch.num_rows * TEXT_BYTES // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _word_counts(train: DataFrame) -> DataFrame:
    """``word, c``: tasks count what fits, the sums are aggregated."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            seen = pc.value_counts(pa.chunked_array(held, pa.binary()))
            for at in range(0, len(seen), 50_000):
                yield pa.RecordBatch.from_arrays(seen[at : at + 50_000].flatten(), names=["word", "c"])

        held, tokens = [], 0
        for batch in _slices(batches):
            words, _ = _split(batch["text"])
            held.append(words)
            tokens += len(words)
            if tokens >= WINDOW:
                yield from rows()
                held, tokens = [], 0
        yield from rows()

    parts = train.select("text").mapInArrow(count, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def rare_id(word: bytes) -> int:
    """52 bits of the word's hash and its group. ``_rare_id`` is the same as an expression."""
    return RARE + (int(hashlib.md5(word, usedforsecurity=False).hexdigest()[:13], 16) << 8) + group_of(word)


@cache
def _group_of_ending(ending: bytes) -> int:
    return group_of(ending)


def _hashes(words: list[bytes]) -> np.ndarray:
    """``rare_id`` of each word, by which it has a class, and the next 60 bits of the hash."""
    digests = b"".join([hashlib.md5(w, usedforsecurity=False).digest() for w in words])
    high, low = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(np.uint64).T
    groups = np.fromiter((_group_of_ending(w[-2:]) for w in words), np.int64, len(words))
    ids = RARE + ((high >> 12) << 8).astype(np.int64) + groups
    return np.stack([ids, ((high & 0xFFF) << 48 | low >> 16).astype(np.int64)], axis=1)


def _rare_id(word: str) -> Column:
    bits = F.conv(F.substring(F.md5(word), 1, 13), 16, 10).cast("long")
    group = F.expr(f"crc32(substring({word}, -2, 2))") % GROUPS
    return F.lit(RARE) + F.shiftleft(bits, 8) + group


def _tail(word: str) -> Column:
    return F.conv(F.substring(F.md5(word), 14, 15), 16, 10).cast("long")


def _width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _bytes_of(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The values as one binary string for each of the parts that end there."""
    offsets = np.concatenate([[0], ends * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _encoded(rows: DataFrame, units: Units) -> DataFrame:
    """``uid, units, rare, tails`` in place of ``text``, as bytes.

    ``units`` has the unit of each word and then the end, which closes a text as it opens the next.
    ``rare`` and ``tails`` have the ids and further hash bits of the words that are no units, in order.
    Texts are split and their words looked up here once; every later pass reads numbers.
    """
    size, kept = units.size, rows.drop("text")
    shared = rows.sparkSession.sparkContext.broadcast(list(units))
    own, kind = size - GROUPS, _width(size)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = pa.array(shared.value, pa.binary())
        uid = TaskContext.get().partitionId() << 40
        for batch in _slices(batches):
            words, n = _split(batch["text"])
            codes = words.dictionary_encode()
            found = pc.index_in(codes.dictionary, value_set=frequent).fill_null(-1).to_numpy()
            unit = found.astype(np.int64) + 1
            others = np.flatnonzero(found < 0)
            hashes = np.zeros((len(found), 2), np.int64)
            if len(others):
                hashes[others] = _hashes(codes.dictionary.take(pa.array(others)).to_pylist())
                unit[others] = own + (hashes[others, 0] & 255)
            codes = codes.indices.to_numpy()
            of_words = unit[codes].astype(kind)
            is_rare = of_words >= own
            lines = np.full(len(codes) + len(n), END, kind)
            lines[np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)] = of_words
            ends = np.cumsum(n)
            rare = hashes[codes[is_rare]]
            rare_ends = np.concatenate([[0], np.cumsum(is_rare)])[ends]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in names),
                    pa.array(np.arange(uid, uid + len(n))),
                    _bytes_of(lines, ends + np.arange(1, len(n) + 1)),
                    *(_bytes_of(np.ascontiguousarray(rare[:, i]), rare_ends) for i in (0, 1)),
                ],
                names=[*names, "uid", "units", "rare", "tails"],
            )
            uid += len(n)

    names = kept.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    schema = ", ".join([*fields, "uid long, units binary, rare binary, tails binary"])
    return rows.select(*names, "text").mapInArrow(encode, schema)


def _lines(column: pa.Array, size: int) -> np.ndarray:
    """The units of encoded texts between their ends: neighbours are pairs, and there are no others."""
    return np.concatenate([np.array([END], np.int64), _numbers(column, _width(size))])


class _Local(dict):
    """Numbers of words in the order in which a task meets them; 0 is the end."""

    def __init__(self, units: Units) -> None:
        super().__init__()
        self.units, self.unit, self.id = units, [END], [END]

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.unit)
        unit = self.units[word]
        self.unit.append(unit)
        self.id.append(unit if unit < self.units.size - GROUPS else rare_id(word))
        return at

    def read(self, texts: list[bytes | None]) -> np.ndarray:
        """All words of some texts, each text between two ends."""
        words = [_words(text) for text in texts]
        ends = np.cumsum([len(w) + 2 for w in words])
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = inner[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = False
        every = map(self.__getitem__, chain.from_iterable(words))
        out[inner] = np.fromiter(every, np.int64, len(out) - 2 * len(words))
        return out


def _within(u: np.ndarray) -> np.ndarray:
    """Whether each neighbour and the next stand in one text: not the end of one, the begin of another."""
    last = np.cumsum(u == END) % 2 == 0  # every second end closes a text
    return ~((u[:-1] == END) & (u[1:] == END) & last[:-1]) if len(u) else np.zeros(0, bool)


def _counted_pairs(keys: list[np.ndarray], wide: list[int]) -> Iterator[pa.RecordBatch]:
    """``a, b, n`` of keys with the number of one in ``wide`` above that of the other."""
    found, n = np.unique(np.concatenate(keys), return_counts=True)
    wide = np.array(wide, np.int64)
    for at in range(0, len(found), 100_000):
        some = found[at : at + 100_000]
        columns = [wide[some >> 32], wide[some & 0xFFFFFFFF], n[at : at + 100_000]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["a", "b", "n"])


def _pairs(train: DataFrame, units: Units) -> DataFrame:
    """``a, b, n``: neighbours by unit, 0 the end, and once more by id where neither is a unit."""
    shared = train.sparkSession.sparkContext.broadcast(units)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local, by_unit, by_id, held = _Local(shared.value), [], [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            yield from _counted_pairs(by_unit, list(range(shared.value.size)))
            yield from _counted_pairs(by_id, local.id)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                u = local.read(utf8(batch["text"].slice(at, 500)))
                unit = np.array(local.unit, np.int64)[u]
                own = unit < shared.value.size - GROUPS
                inside = _within(u)
                by_unit.append((unit[:-1] << 32 | unit[1:])[inside])
                by_id.append((u[:-1] << 32 | u[1:])[inside & ~own[:-1] & ~own[1:]])
                held += len(u)
                if held >= WINDOW or len(local.id) >= 2 * FLUSH:
                    yield from rows()
                    local, by_unit, by_id, held = _Local(shared.value), [], [], 0
        if by_unit:
            yield from rows()

    found = train.select("text").mapInArrow(count, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _far_pairs(encoded: DataFrame, units: Units) -> DataFrame:
    """``a, b, n``: neighbours by id where neither is a unit."""
    size, own = units.size, units.size - GROUPS

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rare, ids = _lines(batch["units"], size) >= own, _numbers(batch["rare"], "<i8")
            at = np.cumsum(rare)[:-1][rare[:-1] & rare[1:]] - 1
            columns = ids[at], ids[at + 1], np.ones(len(at), np.int64)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["a", "b", "n"])

    found = encoded.select("units", "rare").mapInArrow(pairs, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _beside_units(train: DataFrame, units: Units, of: np.ndarray) -> DataFrame:
    """``w, cells``: each word that is no unit with its counts by the classes of units after and before it.

    ``train`` has texts, as they are or encoded. A word has a row from each batch it is in; the counts,
    at most two a class, are the bytes of numbers with the cell in their low bits.
    """
    encoded = _encoded(train, units) if "text" in train.columns else train
    shared = train.sparkSession.sparkContext.broadcast(of)
    size, own = units.size, units.size - GROUPS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in _slices(batches):
            line = _lines(batch["units"], size)
            words, nth = np.unique(_numbers(batch["rare"], "<i8"), return_inverse=True)
            rare, cell = line >= own, of[line] * 2
            word = np.zeros(len(line), np.int64)
            word[rare] = nth << LOW
            after, before = np.flatnonzero(rare[:-1] & ~rare[1:]), np.flatnonzero(~rare[:-1] & rare[1:])
            key = np.concatenate([word[after] + cell[after + 1], word[before + 1] + cell[before] + 1])
            key, n = np.unique(key, return_counts=True)
            ends = np.cumsum(np.bincount(key >> LOW, minlength=len(words)))
            cells = _bytes_of((n << LOW) + (key & (1 << LOW) - 1), ends)
            yield pa.RecordBatch.from_arrays([pa.array(words), cells], names=["w", "cells"])

    return encoded.select("units", "rare").mapInArrow(count, "w long, cells binary")


def _cells(df: DataFrame, cells_of: Callable[[pa.RecordBatch], Iterator], size: int) -> np.ndarray:
    """Sums of ``size`` cells: added up in each task, then over the tasks, as bytes of a block of them.

    ``cells_of`` gives cells and what each adds, or None where it is 1.
    """
    block = max(16, min(1024, size // 64))

    def rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        cells = np.flatnonzero(total)
        blocks, first = np.unique(cells // block, return_index=True)
        parts = [_bytes_of(x, np.append(first[1:], len(cells))) for x in ((cells % block).astype("<u2"), total[cells])]
        if len(blocks):
            yield pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int64)), *parts], names=["block", "cell", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, ones = np.zeros(size, np.int64), [np.zeros(0, np.int64)]
        for batch in _slices(batches):
            for cells, n in cells_of(batch):
                if n is not None:
                    np.add.at(total, cells, n)
                    continue
                ones.append(cells)
                if sum(map(len, ones)) >= WINDOW:
                    total += np.bincount(np.concatenate(ones), minlength=size)
                    ones = ones[:1]
        yield from rows(total + np.bincount(np.concatenate(ones), minlength=size))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            add(total, batch)
        yield from rows(total)

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for at, cells, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total[at * block + np.frombuffer(cells, "<u2").astype(np.int64)] += np.frombuffer(n, "<i8")

    schema = "block long, cell binary, n binary"
    sums = df.mapInArrow(count, schema).repartition("block").mapInArrow(added, schema)
    total = np.zeros(size, np.int64)
    for batch in sums.toArrow().to_batches():  # at most size numbers
        add(total, batch)
    return total.astype(np.float64)


def _packed(sides: DataFrame, size: int) -> DataFrame:
    """Rows ``w, side, v, n`` of ``size`` units, many to a row, as the bytes of three arrays.

    Passes go through them many times, and read bytes far faster than rows.
    """
    narrowest = np.dtype(_width(size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            w, side, v, n = (np.concatenate(c) for c in zip(*held, strict=True))
            key = w.astype(np.int64) * 2 + side
            order = np.argsort(key, kind="stable")
            columns = key[order].astype("<u4"), v[order].astype(narrowest), n[order].astype("<i8")
            starts = range(0, len(order), PACKED)
            packed = [pa.array([c[at : at + PACKED].tobytes() for at in starts], pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays(packed, names=["w", "v", "n"])

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            count += batch.num_rows
            if count >= ORDERED:
                yield from rows()
                held, count = [], 0
        if count:
            yield from rows()

    return sides.select("w", "side", "v", "n").mapInArrow(pack, "w binary, v binary, n binary")


def _unpacked(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``w, side, v, n`` of packed rows."""
    kinds = "<u4", _width(size), "<i8"
    key, v, n = (_numbers(c, kind).astype(np.int64) for c, kind in zip(batch.columns, kinds, strict=True))
    return key >> 1, key & 1, v, n


def _head_bigrams(lines: DataFrame, units: np.ndarray, size: int) -> np.ndarray:
    """Counts of pairs of the first ``size`` units and groups, a bounded square, from encoded texts."""

    def cells(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, None]]:
        line = units[_lines(batch["units"], len(units))]
        yield line[:-1] * size + line[1:], None

    return _cells(lines, cells, size * size).reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """What the exchange raises: of the class pairs, less the part that no assignment changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def gains(table: np.ndarray, right: np.ndarray, left: np.ndarray, old: np.ndarray) -> np.ndarray:
    """What each word adds to the likelihood in each class, all others staying where they are.

    ``right`` and ``left`` have a word a row, with its counts by the class after and before it.
    Cells that a word's right and left neighbours share are taken one by one, so this is an estimate;
    whether a batch stays is decided by the likelihood itself.
    """
    out = np.zeros(right.shape)

    def add(cells: np.ndarray, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of ``n`` put into the cell of each class, or left in that of the old one."""
        gain = _xlogx(cells + n[:, None]) - _xlogx(cells)
        at = np.arange(len(n))
        own = cells[at, old[rows]]
        gain[at, old[rows]] = _xlogx(own) - _xlogx(np.maximum(own - n, 0))
        return gain

    every = np.arange(len(old))
    for pairs, counts in ((table.T, right), (table, left)):
        rows, classes = np.nonzero(counts)
        if len(rows):
            gain = add(pairs[classes], rows, counts[rows, classes])
            some, first = np.unique(rows, return_index=True)
            out[some] += np.add.reduceat(gain, first)
        margin = np.broadcast_to(pairs.sum(0), out.shape)
        out -= add(margin, every, counts.sum(1))
    out[:, END] = -np.inf
    return out


def _moves(table: np.ndarray, right: np.ndarray, left: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The best class of each word."""
    gain = gains(table, right, left, old)
    best, at = gain.argmax(1), np.arange(len(old))
    return np.where(gain[at, best] > gain[at, old] + 1e-6, best, old)


class UnitExchange:
    """Classes of the units, moved in batches.

    The neighbours of each unit lie in a packed table ``w, side, v, n`` with each pair of units, at
    most the square of their number, whatever the size of the corpus. A pass over it gives the
    table of classes and, for the units of one batch, their counts by the classes beside them.
    """

    def __init__(self, sides: DataFrame, of: np.ndarray, turn: np.ndarray, classes: int) -> None:
        """``turn`` deals the units out to batches; ``sides`` may come with a row for each pair."""
        if "side" in sides.columns:
            sides = written(_packed(sides.repartition("w"), len(of)), "sides")
        self.sides, self.of, self.turn, self.classes = sides, of, turn, classes

    def _measure(self, of: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        size, k, mine = len(of), self.classes, self.turn % parts == part

        def cells(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            w, side, v, n = _unpacked(batch, size)
            right = side == 0
            yield of[w[right]] * k + of[v[right]], n[right]
            some = mine[w]
            yield k * k + (w[some] * 2 + side[some]) * k + of[v[some]], n[some]

        found = _cells(self.sides, cells, k * k + size * 2 * k)
        return found[: k * k].reshape(k, k), found[k * k :].reshape(size, 2, k)

    def run(self, sweeps: int, parts: int = UNIT_BATCHES) -> list[float]:
        """Up to ``sweeps`` sweeps, fewer if moves stop. A batch that lowers the likelihood is taken
        back and halved, and a sweep has so many more batches; there are ``sweeps * parts`` in all.

        Returns the likelihood before each batch that was kept.
        """
        steps, part, idle = [], 0, 0
        table, beside = self._measure(self.of, part, parts)
        for _ in range(sweeps * parts):
            mine = np.flatnonzero(self.turn % parts == part)
            new = self.of.copy()
            for at in range(0, len(mine), 1000):
                some = mine[at : at + 1000]
                new[some] = _moves(table, beside[some, 0], beside[some, 1], self.of[some])
            new[END] = END
            moved = bool((new != self.of).any())
            idle = 0 if moved else idle + 1
            if idle == parts:
                break
            then = self._measure(new, (part + 1) % parts, parts)
            if not moved or likelihood(then[0]) > likelihood(table):
                steps += [likelihood(table)] if moved else []
                self.of, part = new, (part + 1) % parts
                table, beside = then
            else:
                parts, part, idle = parts * 2, 0, 0
                table, beside = self._measure(self.of, part, parts)
        self.table = table
        return steps


class TextExchange(UnitExchange):
    """The same moves by passes over the encoded texts, whose pairs are then never gathered."""

    def __init__(self, lines: DataFrame, of: np.ndarray, turn: np.ndarray, classes: int) -> None:
        super().__init__(lines.select("units"), of, turn, classes)

    def _measure(self, of: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        size, k, mine = len(of), self.classes, np.flatnonzero(self.turn % parts == part)
        row = np.full(size, -1, np.int64)
        row[mine] = k * k + np.arange(len(mine)) * 2 * k
        shared = self.sides.sparkSession.sparkContext.broadcast((of, row))

        def cells(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, None]]:
            of, row = shared.value
            lines, found = _lines(batch["units"], size), []
            for at in range(0, len(lines) - 1, PIECE):
                line = lines[at : at + PIECE + 1]
                cls, rows = of[line], row[line]
                some = np.flatnonzero(rows >= 0)
                right, left = some[some < len(line) - 1], some[some > 0]
                found += [cls[:-1] * k + cls[1:], rows[right] + cls[right + 1], rows[left] + k + cls[left - 1]]
            yield from ((cells, None) for cells in found)

        found = _cells(self.sides, cells, k * k + len(mine) * 2 * k)
        shared.unpersist()
        beside = np.zeros((size, 2, k))
        beside[mine] = found[k * k :].reshape(len(mine), 2, k)
        return found[: k * k].reshape(k, k), beside


class RareExchange:
    """Classes of the words that are no units, each moved for itself, in batches.

    A row ``w, cls, cells, moved`` has a word's class and its counts by the class after and before
    it, of neighbours that are units: at most two numbers a class. ``far`` has the pairs of two words
    that are none, whose classes are joined to both sides; none of these words is frequent.
    """

    def __init__(
        self, near: DataFrame, far: DataFrame, inner: np.ndarray, groups: np.ndarray, classes: int
    ) -> None:
        """``inner`` is the table of classes of pairs of units, ``groups`` has the first classes."""
        self.spark: SparkSession = near.sparkSession
        self.far, self.inner, self.classes = far, inner, classes
        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for w, cells in _listed(batches):
                cls = pa.array(groups[w & 255].astype(np.int32))
                columns = [pa.array(w), cls, cells, pa.array(np.zeros(len(w), bool))]
                yield pa.RecordBatch.from_arrays(columns, names=["w", "cls", "cells", "moved"])

        ordered = near.select("w", "cells").repartition("w").sortWithinPartitions("w")
        self._keep(ordered.mapInArrow(first, "w long, cls int, cells array<long>, moved boolean"))
        self._count()

    def _keep(self, state: DataFrame) -> None:
        self.path = scratch_path(self.spark, "classes")
        state.write.parquet(self.path)
        self.state = self.spark.read.schema(state.schema).parquet(self.path)

    def _count(self) -> None:
        """The table of classes, and the far pairs with the classes of both sides."""
        k = self.classes

        def near(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            rows, e = _flat(batch.column(1))
            own, cell = batch.column(0).to_numpy()[rows], e & ((1 << LOW) - 1)
            other, after = cell >> 1, (cell & 1) == 0
            yield np.where(after, own * k + other, other * k + own), e >> LOW

        def far(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            ca, cb, n = (c.to_numpy() for c in batch.columns)
            yield ca.astype(np.int64) * k + cb, n

        of = self.state.select("w", "cls")
        self.known_path = scratch_path(self.spark, "far")
        known = self.far.join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b")
        known.write.parquet(self.known_path)
        self.known = self.spark.read.schema(known.schema).parquet(self.known_path)
        self.table = self.inner + _cells(self.state.select("cls", "cells"), near, k * k).reshape(k, k)
        self.table += _cells(self.known.select("ca", "cb", "n"), far, k * k).reshape(k, k)

    def _move(self, part: int, parts: int) -> int:
        """Words of one part of ``parts`` go to their best classes; the number of those that moved."""
        k, table = self.classes, self.table

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    batch = whole.slice(at, 1000)
                    w, old = (batch[c].to_numpy() for c in ("w", "cls"))
                    sums = np.zeros((len(w), 2, k))
                    for column in ("cells", "m"):
                        rows, e = _flat(batch[column])
                        cell = e & ((1 << LOW) - 1)
                        np.add.at(sums, (rows, cell & 1, cell >> 1), e >> LOW)
                    new, mine = old.astype(np.int64), (w >> 8) % parts == part
                    new[mine] = _moves(table, sums[mine, 0], sums[mine, 1], old[mine])
                    columns = [batch["w"], pa.array(new, pa.int32()), batch["cells"], pa.array(new != old)]
                    yield pa.RecordBatch.from_arrays(columns, names=["w", "cls", "cells", "moved"])

        sides = [
            self.known.select(F.col(w).alias("w"), (F.col(c) * 2 + side).alias("cell"), "n")
            for w, c, side in (("a", "cb", 0), ("b", "ca", 1))
        ]
        moving = F.shiftright("w", 8) % parts == part
        beside = sides[0].unionByName(sides[1]).filter(moving).repartition("w").groupBy("w", "cell").agg(F.sum("n").alias("n"))
        beside = beside.groupBy("w").agg(F.collect_list(F.shiftleft("n", LOW) + F.col("cell")).alias("m"))
        joined = self.state.drop("moved").join(beside, "w", "left")
        self._keep(joined.mapInArrow(move, "w long, cls int, cells array<long>, moved boolean"))
        return self.state.filter("moved").count()

    def run(self, parts: int = RARE_BATCHES) -> list[float]:
        """One sweep, or less if a batch lowers the likelihood: it is taken back, once halved, and
        the sweep ends there. Returns the likelihood before each batch that was kept."""
        steps, part, halved = [], 0, False
        fields = ("state", "path", "known", "known_path", "table")
        while part < parts:
            before = {name: getattr(self, name) for name in fields}
            moved = self._move(part, parts)
            if not moved:
                drop_folder(self.spark, before["path"])
                part += 1
                continue
            self._count()
            kept = likelihood(self.table) > likelihood(before["table"])
            worse = before if kept else {name: getattr(self, name) for name in fields}
            if kept:
                steps.append(likelihood(before["table"]))
                part += 1
            else:
                vars(self).update(before)
            for name in ("path", "known_path"):
                drop_folder(self.spark, worse[name])
            if not kept:
                if halved:
                    break
                parts, part, halved = parts * 2, part * 2, True
        return steps


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.ListArray]]:
    """Each word of rows ``w, cells`` in order of ``w`` once, with the sums of its cells.

    Of a word that may go on in the next batch, only the sums are held.
    """
    none = np.zeros(0, np.int64)
    held = none, none, none  # words, numbers of each, and the numbers
    for batch in chain(batches, [None]):
        w, sizes, e = held
        if batch is not None:
            w = np.concatenate([w, batch["w"].to_numpy()])
            sizes = np.concatenate([sizes, pc.binary_length(batch["cells"]).to_numpy() // 8])
            e = np.concatenate([e, _numbers(batch["cells"], "<i8")])
        new = np.concatenate([[True], w[1:] != w[:-1]])[: len(w)]
        run, w = np.repeat(np.cumsum(new) - 1, sizes), w[new]
        key, at = np.unique((run << LOW) + (e & (1 << LOW) - 1), return_inverse=True)
        sums = np.zeros(len(key), np.int64)
        np.add.at(sums, at, e >> LOW)
        e, sizes = (sums << LOW) + (key & (1 << LOW) - 1), np.bincount(key >> LOW, minlength=len(w))
        done = max(len(w) - (batch is not None), 0)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        held = w[done:], sizes[done:], e[ends[done] :]
        yield w[:done], pa.ListArray.from_arrays(pa.array(ends[: done + 1], pa.int32()), pa.array(e[: ends[done]]))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of everything in the lists; a null is an empty list."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lengths)), lengths), values


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit: units move one by one to the class that raises the likelihood most.

    Unit 0, the end, keeps class 0 for itself. The others begin in turns by frequency.
    """
    size = len(bigrams)
    order = np.argsort(-(bigrams.sum(0) + bigrams.sum(1)), kind="stable")
    order = order[order != END]
    of = np.zeros(size, np.int64)
    of[order] = 1 + np.arange(len(order)) % (classes - 1)
    member = np.eye(classes)[of]
    table = member.T @ bigrams @ member
    log = lambda x: x * np.log(np.maximum(x, 1e-300))
    for _ in range(sweeps):
        moved = 0
        to_class = bigrams @ member  # of each unit, by the class after it
        from_class = bigrams.T @ member  # by the class before it
        for unit in order.tolist():
            right, left, own = to_class[unit], from_class[unit], bigrams[unit, unit]
            old = of[unit]
            if not right.any() and not left.any():
                continue
            # The table without the unit; its pairs with itself are in right and left alike.
            right, left = right.copy(), left.copy()
            right[old] -= own
            left[old] -= own
            bare = table.copy()
            bare[old] -= right
            bare[:, old] -= left
            bare[old, old] -= own
            # Pairs with other units count in these units' rows and columns wherever it goes.
            row, column = bare.sum(1) + left, bare.sum(0) + right
            total_right, total_left = right.sum() + own, left.sum() + own
            gain = (log(bare + right) - log(bare)).sum(1) + (log(bare + left[:, None]) - log(bare)).sum(0)
            diagonal = np.diag(bare)
            gain += (
                log(diagonal + right + left + own) - log(diagonal + right) - log(diagonal + left) + log(diagonal)
            )
            gain -= log(row + total_right) - log(row) + log(column + total_left) - log(column)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            bare[new] += right
            bare[:, new] += left
            bare[new, new] += own
            table = bare
            if new != old:
                moved += 1
                of[unit], member[unit] = new, np.eye(classes)[new]
                to_class[:, old] -= bigrams[:, unit]
                to_class[:, new] += bigrams[:, unit]
                from_class[:, old] -= bigrams[unit]
                from_class[:, new] += bigrams[unit]
        if not moved:
            break
    return of


class ClassModel:
    """log10 of the transitions between classes, and of each class's share for one word."""

    def __init__(self, units: Units, bigrams: np.ndarray, types: np.ndarray, classes: int) -> None:
        """``types``: distinct training words of each unit, the end included."""
        self.units = units
        self.of = exchange(bigrams, classes)
        member = np.eye(classes)[self.of]
        table = member.T @ bigrams @ member
        self.groups = self.of[-GROUPS:]
        self.fit(table, types @ member)

    def fit(self, table: np.ndarray, kinds: np.ndarray) -> None:
        """Take counts of class pairs, and the distinct words of each class."""
        tokens = table.sum(0)
        share = (tokens + 1e-3) / (tokens + 1e-3).sum()
        self.step = np.log10((table + PRIOR * share) / (table.sum(1, keepdims=True) + PRIOR))
        #: A word of the class has probability (its count + 1) / (tokens + types + 1).
        self.room = np.log10(tokens + kinds + 1)

    def path(self, classes: np.ndarray) -> np.ndarray:
        """log10 of each class after the one before it, less its room; counts are still to be added."""
        return self.step[classes[:-1], classes[1:]] - self.room[classes[1:]]


def class_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
    classes: int = CLASSES,
    counted: int = COUNTED,
    hot: int = HOT,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Tokens are the words, A-Z lower-cased, and one end. Rows whose crc32 of the id as text leaves
    2 modulo 7 are held out; all counts come from the others, rows without id among them.
    ``base_score`` is the add-one unigram's log10 probability, ``score`` the class model's. A null
    text has its end only. Repeated rows count as often as they occur; other columns are ignored.
    Without training rows all counts are 0. ``head``, ``hot`` and ``sweeps`` are settings of the
    clustering; ``counted`` only says which counts are broadcast and which are joined.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    held: Column = F.coalesce(fold == 2, F.lit(False))
    rows = narrow(docs, id_col, text_col).withColumn("held_out", held)
    train = rows.filter(~F.col("held_out"))
    counts = written(_word_counts(train), "counts")
    ends = train.count()
    # How many words have each count: their number, their sum, and from which count words are frequent.
    c, words = np.array(sorted(map(tuple, counts.groupBy("c").count().collect())), np.int64).reshape(-1, 2).T
    n = int((c * words).sum()) + ends
    v = int(words.sum()) + (1 if ends else 0)
    reached = np.cumsum(words[::-1])[::-1]  # words that occur so often at least
    enough = c[reached >= max(head, hot)]
    top = counts.filter(F.col("c") >= (int(enough[-1]) if len(enough) else 1))
    top = top.orderBy(F.desc("c"), F.col("word")).limit(max(head, hot)).toArrow()
    frequent = top["word"].to_pylist()
    units, few = Units(frequent), Units(frequent[:head])
    own = units.size - GROUPS
    encoded = written(_encoded(rows.select("doc_id", "held_out", "text"), units), "encoded")
    lines = encoded.filter(~F.col("held_out")).select("units", "rare")
    # A pass over the units alone reads a third of each file: fewer tasks, each with more of them.
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, lines.rdd.getNumPartitions() // 3)
    passes = lines.select("units").coalesce(parts)
    few_of = np.array([END, *map(few.__getitem__, frequent), *range(few.size - GROUPS, few.size)], np.int64)
    bigrams = _head_bigrams(passes, few_of, few.size)
    model = ClassModel(few, bigrams, np.zeros(few.size), classes)
    turn = np.array([0, *(rare_id(word) >> 8 for word in frequent), *range(GROUPS)], np.int64)
    unit_moves = TextExchange(passes, model.of[few_of], turn, classes)
    unit_moves.run(sweeps)
    of = unit_moves.of
    release_shuffles(docs.sparkSession)

    def inner(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, None]]:
        line = _lines(batch["units"], len(of))
        some = (line[:-1] < own) & (line[1:] < own)
        yield of[line[:-1][some]] * classes + of[line[1:][some]], None

    table = _cells(passes, inner, classes * classes).reshape(classes, classes)
    far = written(_far_pairs(lines, units), "pairs")
    rare_moves = RareExchange(_beside_units(lines, units, of), far, table, of[own:], classes)
    rare_moves.run()
    release_shuffles(docs.sparkSession)
    kinds = np.zeros(classes)
    if ends:
        np.add.at(kinds, of[:own], 1)
    for cls, size in rare_moves.state.groupBy("cls").count().collect():
        kinds[cls] += size
    model.fit(rare_moves.table, kinds)
    rare_of = rare_moves.state.select(F.col("w").alias("id"), "cls")
    by_id = counts.select(_rare_id("word").alias("id"), _tail("word").alias("tail"), "c")
    classed = written(by_id.join(rare_of, "id"), "classed")
    # Of the other words, the most frequent are broadcast in order of their ids.
    few_enough = c[reached <= counted]
    least = int(few_enough[0]) if len(few_enough) else n + 1
    have = classed.filter(F.col("c") >= least).toArrow()
    have = np.stack([have[x].to_numpy().astype(np.int64) for x in ("id", "tail", "c", "cls")])
    have = have[:, np.argsort(have[0], kind="stable")]
    of_units = np.concatenate([[ends], top["c"].to_numpy(), np.zeros(GROUPS, np.int64)])
    shared = docs.sparkSession.sparkContext.broadcast((model, of, of_units, have))

    def known(ids: np.ndarray, tails: np.ndarray, have: np.ndarray) -> np.ndarray:
        """Where each word stands in ``have``, -1 if nowhere."""
        if not have.shape[1]:
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(have[0], ids), have.shape[1] - 1)
        return np.where((have[0, at] == ids) & (have[1, at] == tails), at, -1)

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words that are neither units nor broadcast, with their places."""
        have = shared.value[3]
        for batch in _slices(batches):
            unit = _numbers(batch["units"], _width(len(of)))
            ids, tails = (_numbers(batch[c], "<i8") for c in ("rare", "tails"))
            ends = np.cumsum(pc.binary_length(batch["units"]).to_numpy()) // unit.itemsize
            at = np.flatnonzero(unit >= own)
            text = np.searchsorted(ends, at, side="right")
            some = known(ids, tails, have) < 0
            at, text = at[some], text[some]
            columns = [
                batch["uid"].take(pa.array(text)),
                *map(pa.array, (at - np.concatenate([[0], ends])[text] + 1, ids[some], tails[some])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "at", "id", "tail"])

    # Rare words are many, but none of them is frequent, so no key of this join is hot.
    rare = encoded.select("uid", "units", "rare", "tails").mapInArrow(sought, "uid long, at long, id long, tail long")
    rare = rare.join(classed, ["id", "tail"]).groupBy("uid").agg(
        F.count("*").alias("more"),
        F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"),
        F.collect_list(F.shiftleft("at", 8) + F.col("cls")).alias("seen"),
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's classes, and what its units and broadcast words give; the others count as never seen."""
        _, of, of_units, have = shared.value
        for batch in _slices(batches):
            unit = _numbers(batch["units"], _width(len(of)))
            ends = np.cumsum(pc.binary_length(batch["units"]).to_numpy()) // unit.itemsize
            begins = np.concatenate([[0], ends[:-1]])
            cls, c = of[unit].astype(np.uint8), of_units[unit]
            found = known(*(_numbers(batch[x], "<i8") for x in ("rare", "tails")), have)
            at = np.flatnonzero(unit >= own)[found >= 0]
            c[at], cls[at] = have[2, found[found >= 0]], have[3, found[found >= 0]]
            n_known = np.add.reduceat((c > 0).astype(np.int64), begins)
            rest = ends - begins, n_known, np.add.reduceat(np.log10(c + 1), begins)
            columns = [*(batch[x] for x in ("uid", "doc_id", "held_out")), *map(pa.array, rest), _bytes_of(cls, ends)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value[0]
        for batch in _slices(batches):
            ends = np.cumsum(pc.binary_length(batch["classes"]).to_numpy())
            begins = np.concatenate([[0], ends[:-1]])
            cls = np.concatenate([[END], _numbers(batch["classes"], "u1")])
            text, seen = _flat(batch["seen"])
            cls[begins[text] + (seen >> 8)] = seen & 255
            paths = pa.array(np.add.reduceat(network.path(cls), begins))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], paths], names=[*batch.schema.names[:-2], "path"])

    names = ["uid", "doc_id", "held_out", "n_tokens", "n_known", "logs", "classes"]
    walked = encoded.select("uid", "doc_id", "held_out", "units", "rare", "tails").mapInArrow(
        walk, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, classes binary"
    )
    followed = walked.join(rare, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))).alias("logs"),
        "classes",
        "seen",
    ).mapInArrow(
        follow,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, logs double, path double",
    )
    return followed.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        (F.col("logs") - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("logs") + F.col("path")).alias("score"),
    )
