"""Where the tokens of two tokenizers end together, and which ids those are.

A stretch of bytes is read into a fragment: the tokens before its first common end (open, for a
group may have begun further left), the closed groups, and the tokens after its last common end
(open to the right). Fragments of neighbouring stretches compose, and it does not matter in which
order: fragments are a monoid. A long document is cut into byte ranges whose fragments are made by
different tasks and composed by a tree. The fragments of texts that fit one range are closed, and
those of many texts are made at once on flat arrays.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.bpe import token_names
from skyledger.llm.common import batch_of, narrow, written
from skyledger.llm.tokens import ByteLevel, PlainEncoder, encoder, has_other_space, vocabulary

#: Characters of a document that one task reads alone, and bytes of the ranges of longer ones.
PIECE = 1 << 15
CHUNK = 1 << 14
#: Fragments of so many ranges meet in one row at each level of the tree.
FAN = 4
#: Fragments of one byte range, or as much of longer ones, that a task composes.
COMPOSED = 128
#: Texts that are read at a time.
TEXTS = 300
PIECES = 20
#: Remembered parts of texts; beyond that nothing more is remembered.
PARTS = 180_000
#: Pairs of ids, the most frequent ones, whose counts every task holds; the others are joined.
HELD_PAIRS = 1_000_000

# Both tokenizers cut before a blank or line feed that follows no white space of any kind.
_SAFE = re.compile(r"\S(?=[ \n])")


class Fragment(NamedTuple):
    """Tokens of a stretch of bytes; a token belongs to the stretch in which it ends."""

    a: Sequence[int]  # open prefix, up to the first common end if there is one
    b: Sequence[int]
    cut: bool  # whether there is a common end
    groups: str  # closed groups after the first common end
    links: bytes  # a pair of ids for each common end
    tail_a: Sequence[int]  # open suffix, after the last common end
    tail_b: Sequence[int]


EMPTY = Fragment((), (), False, "", b"", (), ())


def spelled(a: Sequence[int], b: Sequence[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def fragment(
    a: Sequence[int], a_ends: Sequence[int], b: Sequence[int], b_ends: Sequence[int], size_b: int
) -> Fragment:
    """The fragment of tokens with the ends of their bytes."""
    at_b = {end: j for j, end in enumerate(b_ends, 1)}
    cuts = [(i, at_b[end]) for i, end in enumerate(a_ends, 1) if end in at_b]
    if not cuts:
        return Fragment(a, b, False, "", b"", (), ())
    groups = [spelled(a[i:k], b[j:m]) for (i, j), (k, m) in zip(cuts, cuts[1:])]
    links = np.array([a[i - 1] * size_b + b[j - 1] for i, j in cuts], "<u8").tobytes()
    (i, j), (k, m) = cuts[0], cuts[-1]
    return Fragment(a[:i], b[:j], True, ";".join(groups), links, a[k:], b[m:])


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring stretches. Associative; ``EMPTY`` changes nothing."""
    if not x.cut:
        return y._replace(a=[*x.a, *y.a], b=[*x.b, *y.b])
    tail_a, tail_b = [*x.tail_a, *y.a], [*x.tail_b, *y.b]
    if not y.cut:
        return x._replace(tail_a=tail_a, tail_b=tail_b)
    groups = ";".join(filter(None, (x.groups, spelled(tail_a, tail_b), y.groups)))
    return Fragment(x.a, x.b, True, groups, x.links + y.links, y.tail_a, y.tail_b)


def closed(whole: Fragment) -> str:
    """All groups of a fragment that ends in a common end."""
    return f"{spelled(whole.a, whole.b)};{whole.groups}" if whole.groups else spelled(whole.a, whole.b)


def split_joined(units: list[str], encode: Callable[[str], list[int]], sizes: np.ndarray) -> list[bytes]:
    """The ids of each unit from one text that is made of all of them.

    A unit that begins with a blank goes on where the one before it ends; the others have a line
    feed before them, whose ids are dropped. No unit ends in white space. ``sizes`` are the bytes of
    each id, which in all are those of the text.
    """
    raw = [u.encode() for u in units]
    lengths = np.array([len(r) for r in raw], np.int64)
    apart = np.array([r[:1] != b" " for r in raw])
    ends = np.cumsum(lengths + apart)
    ids = np.array(encode("".join([u if u[:1] == " " else "\n" + u for u in units])), np.int64)
    upto = np.cumsum(sizes[ids])
    if len(units) and (not len(upto) or upto[-1] != ends[-1]):
        raise ValueError("the ids do not give the text back")
    stops = np.searchsorted(upto, ends) + 1
    starts = np.searchsorted(upto, ends - lengths, side="right")
    flat = ids.astype("<u4").tobytes()
    return [flat[i:j] for i, j in zip((starts * 4).tolist(), (stops * 4).tolist(), strict=True)]


class PieceEncoder:
    """Ids of a model that puts a blank before a text; ``sizes`` has the bytes of each piece.

    Texts are cut at every blank and line feed, and parts are remembered with the blank before them.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_file=path)
        byte, count = self.pieces.is_byte, self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(count)]
        self.spelled = [
            bytes([int(n[3:5], 16)]) if byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
        ]
        self.sizes = np.array([len(s) for s in self.spelled], np.int64)
        # Texts are cut only if no piece reaches over a place where a blank begins or a line ends.
        over = re.compile(r"[^▁\s][▁ \n]|\n.", re.DOTALL)
        self.cuts = not any(over.search(n) for i, n in enumerate(names) if not byte(i))
        blank, self.feed = (np.array(self.pieces.encode("a" + space)[1:], "<u4").tobytes() for space in " \n")
        #: Parts by whether they have a blank before them.
        self.bare: dict[str, bytes] = {"": b""}
        self.after_blank: dict[str, bytes] = {"": blank}

    def _whole(self, spaced: str) -> bytes:
        """The ids of a text that begins with the blank that the model puts there; none if bytes get lost.

        Where no blank is to be added, a letter is put before the text and its piece dropped.
        """
        bare = len(spaced) > 1 and spaced[0] == " "
        ids = self.pieces.encode(spaced[1:]) if bare else self.pieces.encode("a" + spaced)[1:]
        if b"".join(map(self.spelled.__getitem__, ids)) != spaced.encode():
            return b""
        return np.array(ids, "<u4").tobytes()

    def _unknown(self, parts: list[str]) -> list[bytes]:
        text = "".join([p if p[:1] == " " else "\n" + p for p in parts])
        read = self.pieces.encode("a" + text)[1:]
        if b"".join(map(self.spelled.__getitem__, read)) != text.encode():
            raise ValueError("bytes get lost")
        return split_joined(parts, lambda _: read, self.sizes)

    def _is_simple(self, text: str) -> bool:
        """Whether blanks and line feeds stand alone and are the only white space."""
        if not self.cuts or "▁" in text or any(two in text for two in ("  ", "\n\n", " \n", "\n ")):
            return False
        return not has_other_space(text)

    def _in_parts(self, texts: list[str]) -> list[bytes]:
        """A part takes the blank before it along, unless a line feed stands there, which is a part."""
        bare, after_blank, rows, missing = self.bare.get, self.after_blank.get, [], set()
        for text in texts:
            parts: list[str] = []
            ids: list[bytes | None] = []
            begins = []
            for line in text.split("\n"):
                if parts:
                    parts.append("\n")
                    ids.append(self.feed)
                words = line.split(" ")
                begins.append(len(parts))
                parts += words
                ids.append(bare(words[0]))
                ids += map(after_blank, words[1:])
            holes = [i for i, found in enumerate(ids) if found is None] if None in ids else []
            first = set(begins)
            units = [parts[i] if i in first else " " + parts[i] for i in holes]
            missing.update(units)
            rows.append((ids, holes, units))
        fresh = list(missing)
        new = dict(zip(fresh, self._unknown(fresh), strict=True))
        if len(self.after_blank) + len(self.bare) < PARTS:
            for unit, found in new.items():
                if len(unit) < 50:
                    (self.after_blank if unit[0] == " " else self.bare)[unit.removeprefix(" ")] = found
        for ids, holes, units in rows:
            for i, unit in zip(holes, units, strict=True):
                ids[i] = new[unit]
        return [b"".join(ids) for ids, _, _ in rows]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that begin with the model's blank, or go on without one."""
        simple = [self._is_simple(t) for t in texts]
        try:
            found = iter(self._in_parts([t for t, s in zip(texts, simple, strict=True) if s]))
        except ValueError:  # some text loses bytes: all are read by themselves
            return [self._whole(t) for t in texts]
        return [next(found) if s else self._whole(t) for t, s in zip(texts, simple, strict=True)]


def _found(ends: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of ``ends`` are ``among`` others; both ascend."""
    if not len(among):
        return np.zeros(len(ends), bool)
    return among[np.minimum(np.searchsorted(among, ends), len(among) - 1)] == ends


class Aligner:
    """Both tokenizers, and what they returned for parts of texts seen before."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = encoder(path_a, ByteLevel, PlainEncoder)
        self.a.most = PARTS
        self.b = PieceEncoder(path_b)
        self.sizes_a = np.array([len(name) for name in token_names(path_a)], np.int64)  # a letter for a byte
        self.size_a, self.size_b = len(self.sizes_a), len(self.b.sizes)
        self.marked = [f"{i}{mark}" for i in range(self.size_a) for mark in ",|"]
        self.marked += [f"{i}{mark}" for i in range(self.size_b) for mark in ",;"]

    def pieces_of(self, text: str, size: int) -> list[str]:
        """The text with a blank before it, cut where both tokenizers cut in any case."""
        spaced, out, at = " " + text, [], 0
        while self.b.cuts and len(spaced) - at > size and (found := _SAFE.search(spaced, at + size - 1)):
            out.append(spaced[at : found.end()])
            at = found.end()
        return [*out, spaced[at:]]

    def read(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The ids of both for texts that begin with a blank or line feed; none where bytes get lost."""
        a, b = self.a.encode(texts), self.b.encode(texts)
        for i, text in enumerate(texts):
            size = len(text.encode())
            if any(sizes[np.frombuffer(x[i], "<u4")].sum() != size for x, sizes in ((a, self.sizes_a), (b, self.b.sizes))):
                a[i] = b[i] = b""
        return a, b

    def finish(self, texts: list[str]) -> list[list]:
        """``n_a, n_b, n_groups, groups_sha256, pairs, times`` of whole texts with a blank before them."""
        read = self.read(texts)
        counts = [np.array([len(x) // 4 for x in ids], np.int64) for ids in read]
        a, b = (np.frombuffer(b"".join(ids), "<u4").astype(np.int64) for ids in read)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.b.sizes[b])
        # Texts stand one after another, and each ends in an end of both.
        last_a, last_b = _found(ends_a, ends_b), _found(ends_b, ends_a)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        # In the spelling a group's ids of A stand after all ids of B of the groups before it.
        items = np.zeros(len(a) + len(b), np.int64)
        shift = 2 * self.size_a
        items[np.arange(len(a)) + np.append(0, upto_b)[group_a]] = 2 * a + last_a
        items[np.arange(len(b)) + upto_a[group_b]] = shift + 2 * b + last_b
        words = list(map(self.marked.__getitem__, items.tolist()))
        links = a[last_a] * self.size_b + b[last_b]
        stops = [np.cumsum(c) for c in counts]
        spots = stops[0] + stops[1]
        n_groups = np.diff(np.searchsorted(upto_a, stops[0], side="right"), prepend=0)
        owner = np.repeat(np.arange(len(texts)), n_groups)
        keys, times = np.unique(owner.astype(np.uint64) << np.uint64(40) | links.astype(np.uint64), return_counts=True)
        of = (keys >> np.uint64(40)).astype(np.int64)
        pairs = (keys & np.uint64((1 << 40) - 1)).astype("<u8").tobytes()
        times = times.astype("<u4").tobytes()
        bounds = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
        out, begin = [], 0
        for i, (n_a, n_b, n, end) in enumerate(
            zip(counts[0].tolist(), counts[1].tolist(), n_groups.tolist(), spots.tolist(), strict=True)
        ):
            j, k = bounds[i], bounds[i + 1]
            digest = _digest("".join(words[begin:end])[:-1]) if n else ""
            out.append([n_a, n_b, n, digest, pairs[8 * j : 8 * k], times[4 * j : 4 * k]])
            begin = end
        return out

    def ranges(self, read: list[bytes], start: int, chunk_size: int) -> Iterator[tuple[int, Fragment, int, int]]:
        """The fragments of the byte ranges that a stretch beginning at byte ``start`` touches.

        ``read`` has the ids of both for the stretch.
        """
        ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in read]
        ends = [start + np.cumsum(sizes[i]) for i, sizes in zip(ids, (self.sizes_a, self.b.sizes), strict=True)]
        chunks = [(e - 1) // chunk_size for e in ends]
        for chunk in np.unique(np.concatenate(chunks)).tolist():
            parts = [x[c == chunk].tolist() for i, e, c in zip(ids, ends, chunks, strict=True) for x in (i, e)]
            yield chunk, fragment(*parts, self.size_b), len(parts[0]), len(parts[2])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def forget() -> None:
    """Give up what this worker remembers of texts; steps after the reading have no use for it."""
    for both in _ALIGNERS.values():
        both.a.known = {"": b""}
        both.b.bare, both.b.after_blank = {"": b""}, {"": both.b.after_blank[""]}
    if _ALIGNERS:
        gc.collect()


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _distinct(links: bytes) -> tuple[bytes, bytes]:
    pairs, times = np.unique(np.frombuffer(links, "<u8"), return_counts=True)
    return pairs.astype("<u8").tobytes(), times.astype("<u4").tobytes()


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest()


# A finished document, or a piece of the text of a long one.
_ROWS = pa.schema(
    [
        ("uid", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.binary()),
        ("times", pa.binary()),
        ("piece", pa.string()),
        ("start", pa.int64()),
    ]
)
_ROWS_DDL = (
    "uid long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary, "
    "times binary, piece string, start long"
)
_FRAGMENTS = pa.schema(
    [
        ("uid", pa.int64()),
        ("doc_id", pa.int64()),
        ("chunk", pa.int64()),
        ("at", pa.int64()),
        ("good", pa.bool_()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("a", pa.list_(pa.int64())),
        ("b", pa.list_(pa.int64())),
        ("cut", pa.bool_()),
        ("groups", pa.string()),
        ("links", pa.binary()),
        ("tail_a", pa.list_(pa.int64())),
        ("tail_b", pa.list_(pa.int64())),
    ]
)
_FRAGMENTS_DDL = (
    "uid long, doc_id long, chunk long, at long, good boolean, n_a long, n_b long, a array<long>, "
    "b array<long>, cut boolean, groups string, links binary, tail_a array<long>, tail_b array<long>"
)
_NOTHING = [0, 0, 0, "", b"", b""]


def _read_documents(path_a: str, path_b: str, size: int):
    """Finished rows of common documents, and pieces of long ones for other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows, waiting = [], []
                for row in batch.slice(at, TEXTS).to_pylist():
                    cut = both.pieces_of(row["text"], size) if row["text"] else []
                    if len(cut) > 1:
                        start = 0
                        for piece in cut:
                            rows.append([row["uid"], row["doc_id"], 0, 0, 0, "", None, None, piece, start])
                            start += len(piece.encode())
                    else:
                        waiting.append((row["uid"], row["doc_id"], cut))
                found = iter(both.finish([cut[0] for *_, cut in waiting if cut]))
                rows += [[u, d, *(next(found) if cut else _NOTHING), None, None] for u, d, cut in waiting]
                yield batch_of(_ROWS, *zip(*rows, strict=True))

    return run


def _read_pieces(path_a: str, path_b: str, chunk_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, PIECES):
                rows = batch.slice(at, PIECES).to_pylist()
                found = zip(*both.read([row["piece"] for row in rows]), strict=True)
                for row, read in zip(rows, found, strict=True):
                    uid, doc_id, start = row["uid"], row["doc_id"], row["start"]
                    made = [
                        [uid, doc_id, chunk, start, True, n_a, n_b, *part]
                        for chunk, part, n_a, n_b in both.ranges(list(read), start, chunk_size)
                    ]
                    made = made or [[uid, doc_id, start // chunk_size, start, False, 0, 0, *EMPTY]]
                    yield batch_of(_FRAGMENTS, *zip(*made, strict=True))

    return run


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as objects, one at a time: each may be a whole long document."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield from batch.slice(at, 1).to_pylist()


def _composed(row: dict) -> list:
    """One fragment of a list of neighbouring ones."""
    parts = sorted(row["parts"], key=itemgetter("chunk", "at"))
    whole = EMPTY
    for part in parts:
        whole = compose(whole, Fragment(*(part[f] for f in Fragment._fields)))
    counts = [sum(p["n_a"] for p in parts), sum(p["n_b"] for p in parts)]
    good = all(p["good"] for p in parts)
    return [row["uid"], parts[0]["doc_id"], row["up"], parts[0]["at"], good, *counts, *whole]


def _compose_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for row in _one_by_one(batches):
        yield batch_of(_FRAGMENTS, *([v] for v in _composed(row)))


def _finish_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last fragment of each document, and at once its row: one worker does both."""
    forget()
    for row in _one_by_one(batches):
        uid, doc_id, _, _, good, n_a, n_b, *fields = _composed(row)
        whole, made = Fragment(*fields), _NOTHING
        if good:
            made = [n_a, n_b, len(whole.links) // 8, _digest(closed(whole)), *_distinct(whole.links)]
        yield batch_of(_ROWS, *([v] for v in [uid, doc_id, *made, None, None]))


def _long_documents(pieces: DataFrame, path_a: str, path_b: str, chunk: int, fan: int) -> DataFrame:
    """Finished rows of documents in pieces: fragments by byte range, composed level by level."""
    dealt = pieces.select("uid", "doc_id", "piece", "start").repartition("uid", "start")
    fragments = written(dealt.mapInArrow(_read_pieces(path_a, path_b, chunk), _FRAGMENTS_DDL), "fragments")
    found = fragments.agg(F.max("chunk").alias("top"), F.count("*").alias("n")).first()
    top, tasks = found["top"] or 0, found["n"] // COMPOSED + 1
    while True:
        top //= fan
        # So many partitions that a task's rows are few megabytes; Spark would join them to 64 MB,
        # all of which are one list of rows in the JVM and one batch in the worker.
        level = fragments.withColumn("up", F.expr(f"chunk div {fan}")).repartition(tasks, "uid", "up")
        parts = F.struct(*(c for c in fragments.columns if c != "uid"))
        grouped = level.groupBy("uid", "up").agg(F.collect_list(parts).alias("parts"))
        if top == 0:
            return grouped.select("uid", "up", "parts").mapInArrow(_finish_rows, _ROWS_DDL)
        fragments = grouped.mapInArrow(_compose_rows, _FRAGMENTS_DDL)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a few million links at a time, so that a task sends each pair a few times only."""
    forget()
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    pairs, times, held = [], [], 0

    def summed() -> pa.RecordBatch:
        keys, place = np.unique(np.concatenate(pairs), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate(times), minlength=len(keys))
        return batch_of(schema, keys.astype(np.int64), sums.astype(np.int64))

    for batch in batches:
        for column, kind, kept in (("pairs", "<u8", pairs), ("times", "<u4", times)):
            kept.append(np.frombuffer(b"".join(x or b"" for x in batch[column].to_pylist()), kind))
        held += len(pairs[-1])
        if held > 1 << 22:
            yield summed()
            pairs, times, held = [], [], 0
    if held:
        yield summed()


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links that hold each pair of ids, and whether no other of its B id has more."""
    links = rows.select("pairs", "times").mapInArrow(_count_pairs, "pair long, n long")
    counts = written(links.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.expr(f"pair % {size_b}").alias("b")
    highest = counts.groupBy(b).agg(F.max("n").alias("highest"))  # a row for each id of the vocabulary
    joined = counts.withColumn("b", b).join(F.broadcast(highest), "b")
    return joined.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _held_from(counts: DataFrame, most: int) -> int:
    """The least count, a power of two, from which on at most ``most`` pairs have counts."""
    power = F.floor(F.log2("n")).cast("int").alias("power")
    sizes = {r["power"]: r["count"] for r in counts.groupBy(power).count().collect()}
    total, least = 0, 64
    while least > 0 and total + sizes.get(least - 1, 0) <= most:
        least -= 1
        total += sizes.get(least, 0)
    return 1 << least


_SCORED_DDL = "uid long, n_best long, count_sum long, pairs array<long>, times array<long>"


def _score(held):
    schema = pa.schema(
        [
            ("uid", pa.int64()),
            ("n_best", pa.int64()),
            ("count_sum", pa.int64()),
            ("pairs", pa.list_(pa.int64())),
            ("times", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = held.value
        for batch in batches:
            texts = batch["pairs"].to_pylist()
            sizes = np.array([len(p or b"") // 8 for p in texts], np.int64)
            pairs = np.frombuffer(b"".join(p or b"" for p in texts), "<u8").astype(np.int64)
            times = np.frombuffer(b"".join(t or b"" for t in batch["times"].to_pylist()), "<u4").astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
            sums, tops = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(sums, owner[hit], counts[place[hit]] * times[hit])
            np.add.at(tops, owner[hit], best[place[hit]] * times[hit])
            left = np.bincount(owner[~hit], minlength=len(sizes))
            offsets = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~hit])) for x in (pairs, times)]
            yield batch_of(schema, batch["uid"], tops, sums, *rest)

    return run


def align(
    docs: DataFrame,
    tokenizer: str | None = None,
    pieces: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    piece: int = PIECE,
    chunk: int = CHUNK,
    fan: int = FAN,
    held_pairs: int = HELD_PAIRS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A reads a blank and the text by ``tokenizer``, the path of a byte-level BPE; B reads the text by
    ``pieces``, the path of a model that puts a blank before it. A text that is null or empty, or
    whose bytes either does not give back, has no tokens, zeros, and '' as digest. Counts cover the
    links of all rows: copies and rows that share an id each count, and each has its row. Other
    columns are ignored; no documents give no rows.
    """
    path_a, path_b = tokenizer or vocabulary("byte_bpe_50k.json"), pieces or vocabulary("piece_bpe_32k.model")
    size_b = aligner(path_a, path_b).size_b
    spark = docs.sparkSession
    numbered = narrow(docs, id_col, text_col).select("doc_id", "text", F.monotonically_increasing_id().alias("uid"))
    read = written(numbered.mapInArrow(_read_documents(path_a, path_b, piece), _ROWS_DDL), "aligned")
    # A number is given once, above; from here on it is read from the table.
    long = _long_documents(read.filter("piece IS NOT NULL"), path_a, path_b, chunk, fan)
    long = written(long, "composed")
    rows = read.filter("piece IS NULL").unionByName(long)
    counts = written(pair_counts(rows, size_b), "counts")
    least = _held_from(counts, held_pairs)
    top = counts.filter(F.col("n") >= least).orderBy("pair").toArrow()
    held = spark.sparkContext.broadcast(
        tuple(top[c].to_numpy().astype(np.int64) for c in ("pair", "n", "best"))
    )
    scored = written(rows.select("uid", "pairs", "times").mapInArrow(_score(held), _SCORED_DDL), "scored")
    rare = scored.select("uid", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    found = rare.join(counts.filter(F.col("n") < least), "pair").groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )

    def total(held_part: str, rest: str) -> Column:
        return (F.col(held_part) + F.coalesce(rest, F.lit(0))).alias(held_part)

    sums = scored.select("uid", "n_best", "count_sum").join(found, "uid", "left")
    sums = sums.select("uid", total("n_best", "more_best"), total("count_sum", "more_sum"))
    counted = rows.select("uid", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "uid")
    return counted.select(
        *("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links")),
        *("n_best", "count_sum", "groups_sha256"),
    )
