"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over the words of all items. Training words stream through it; at each word
it knows the longest suffix read so far that occurs in some item, and from the state the windows
that end there. Words that no item has reset it, so only runs of item words are walked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import map_slices, narrow, quoted, utf8, with_text, written

#: Words are runs of 0-9, a-z and everything above 0x7F, after A-Z became a-z.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)
WINDOW = 13
#: Characters of items in one automaton. More items are dealt to several, one pass each.
AUTOMATON_CHARS = 600_000
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        read = []
        for name, text in items:
            if words := words_of(text):
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                read.append((name, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.shortest = min((min(window, len(ids)) for _, ids in read), default=0)
        own: dict[int, dict[int, set[int]]] = {}
        for name, ids in read:
            size, state = min(window, len(ids)), 0
            for at, c in enumerate(ids):
                state = self.next[state][c]
                if at + 1 >= size:
                    top = state
                    while self.length[self.link[top]] >= size:
                        top = self.link[top]
                    own.setdefault(top, {}).setdefault(size, set()).add(name)
        #: Per state: (length, items) of the windows that end there, its ancestors' included.
        self.ends: list[tuple[tuple[int, frozenset[int]], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            mine = tuple((n, frozenset(who)) for n, who in sorted(own.get(state, {}).items()))
            self.ends[state] = self.ends[self.link[state]] + mine

    def _add(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, c: int, to: int) -> int:
        """``to`` reached from ``state`` as a state of its own, one word longer than ``state``."""
        clone = self._add(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = clone
        while state >= 0 and self.next[state].get(c) == to:
            self.next[state][c] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (to := self.next[last].get(c)) is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, c, to)
        new = self._add(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and c not in self.next[state]:
            self.next[state][c] = new
            state = self.link[state]
        if state >= 0:
            to = self.next[state][c]
            exact = self.length[to] == self.length[state] + 1
            self.link[new] = to if exact else self._split(state, c, to)
        return new

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words any window covers (empty if none), and the items whose windows occur."""
        nothing: tuple[np.ndarray, set[int]] = (np.zeros(0, bool), set())
        if not self.shortest or len(words) < self.shortest:
            return nothing
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0])).astype(np.int8)))
        starts, stops = known[::2], known[1::2]
        long_enough = stops - starts >= self.shortest
        if not long_enough.any():
            return nothing
        hit, items = np.zeros(len(words), bool), set()
        for a, b in zip(starts[long_enough].tolist(), stops[long_enough].tolist(), strict=True):
            state = length = 0
            for at, c in enumerate(ids[a:b].tolist(), a + 1):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if c in self.next[state]:
                    state = self.next[state][c]
                    length += 1
                for n, who in self.ends[state]:
                    if n <= length:
                        hit[at - n : at] = True
                        items |= who
        return (hit, items) if items else nothing


def _without(text: bytes, hit: list[int]) -> bytes:
    """``text`` without the stretches from the first to the last word of each hit span."""
    places = [m.span() for m in _WORD.finditer(text.translate(WORD_BYTES))]
    firsts = [w for n, w in enumerate(hit) if not n or hit[n - 1] != w - 1]
    lasts = [w for n, w in enumerate(hit, 1) if n == len(hit) or hit[n] != w + 1]
    kept, at = [], 0
    for first, last in zip(firsts, lasts, strict=True):
        kept.append(text[at : places[first][0]])
        at = places[last][1]
    return b"".join([*kept, text[at:]])


def _automata(benchmark: DataFrame, window: int, limit: int) -> Iterator[Broadcast]:
    """One automaton per group of items of about ``limit`` characters, as broadcasts."""
    items = benchmark.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = -(-size // limit) or 1
    context = benchmark.sparkSession.sparkContext
    for group in range(groups):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(groups)) == group).collect()
        yield context.broadcast(Automaton([(r["doc_id"], r["text"].encode()) for r in part], window))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, n_words, hit, items, clean, n_hit, row``.

    A window is ``window`` consecutive words of an item, or a shorter item as a whole; a word
    inside any occurrence of one is hit. ``hit`` lists the places of the hit words, ``items`` the
    ids of items with occurring windows, sorted as strings; ``clean`` is the text without its hit
    spans, null where nothing is hit; ``row`` is the input row as a struct. A null text has no words; items without id, text or words are left out; items that repeat an
    id count once. Documents may repeat or have no id. The test items are broadcast in automata
    of a fixed size, with one pass over the documents for each.
    """
    state = docs.select(
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hit"),
        F.array().cast("array<long>").alias("items"),
        F.lit(None).cast("string").alias("clean"),
        F.struct(*(quoted(c) for c in docs.columns)).alias("row"),
    )
    for group, shared in enumerate(_automata(narrow(benchmark, item_col, item_text_col), window, automaton_chars)):
        if group:
            state = written(state, "contamination")

        def work(batch: pa.RecordBatch, shared: Broadcast = shared) -> pa.RecordBatch:
            automaton, counts, hits, items, clean = shared.value, [], [], [], []
            before = zip(batch["hit"].to_pylist(), batch["items"].to_pylist(), strict=True)
            texts = utf8(batch["row"].field(text_col))  # the row alone holds it, once
            for text, (old_hit, old_items) in zip(texts, before, strict=True):
                words = words_of(text) if text else []
                hit, found = automaton.scan(words)
                counts.append(len(words))
                hits.append(sorted({*old_hit, *np.flatnonzero(hit).tolist()}) if found else old_hit)
                items.append(sorted({*old_items, *found}, key=str))
                clean.append(_without(text, hits[-1]) if hits[-1] else None)
            fresh = {
                "n_words": pa.array(counts, pa.int64()),
                "hit": pa.array(hits, pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.int64())),
                "clean": pa.array(clean, pa.binary()).cast(pa.string()),
            }
            columns = {c: fresh.get(c, batch[c]) for c in batch.schema.names}
            return pa.RecordBatch.from_pydict(columns)

        state = map_slices(state, work, state.schema)
    row = F.col("row")
    return state.select(
        row[id_col].cast("long").alias("doc_id"),
        row[text_col].alias("text"),
        *("n_words", "hit", "items", "clean"),
        F.size("hit").cast("long").alias("n_hit"),
        "row",
    )


def is_contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated rows, and without hit spans in the texts that stay.

    Columns and their order are those of ``docs``; ``n_chars``, if there, follows a text that was
    cut. Texts without a hit are returned as they are, null texts included.
    """
    state = contamination(docs, benchmark, window=window).filter(~is_contaminated())
    return with_text(state, docs.columns, F.col("clean"), F.col("n_hit") > 0)
