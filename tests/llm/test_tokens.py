"""Token files and packing against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fixtures import awkward, prose, table
from skyledger.llm import tokens
from skyledger.llm.common import scratch_path
from skyledger.llm.packing import pack, plan
from skyledger.llm.token_files import pack_words, read_token_files, unpack_words, write_token_files
from skyledger.llm.tokens import ByteLevel, Encoder, WordLevel, vocabulary

NAMES = {ByteLevel: "byte_bpe_50k.json", WordLevel: "word_bpe_49k.json"}
LIBRARY = {}


def library(style, text):
    if style not in LIBRARY:
        LIBRARY[style] = Tokenizer.from_file(vocabulary(NAMES[style]))
    return LIBRARY[style].encode(text or "", add_special_tokens=False).ids


TRICKY = [
    "it's IT'S they'LL 'st ''s don't\n\n  two  blanks \n mixed\t tab\r\n end ",
    " lead", "\nlead", "trail ", "a b c \x1c d\x85e", "<|endoftext|> <|startoftext|> x",
    "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|startoftext|>B <|endoftext|>\n\n c <|END|> <<|endoftext|>é ", "<b> < |endoftext|>",
    " ", "\n", "a\nb c\n", "\n a", " a\n", "a\n\nb", "a b\u00a0c", "a\u2003b 字 c\n字", "x\n", "\nx y", "don't\n'tis it's 'll",
    "ẞtraße ΣΑΣ Σ İstanbul ﬁ é ́ a ́b", "漢字 かな 한글 😀😀 12345 ½²³ x²", "#### $$$ a_b-c", "\x00 \x07",
]


@pytest.mark.parametrize("style", [ByteLevel, WordLevel])
def test_units_give_the_ids_of_the_whole_text(style):
    encoder = Encoder(vocabulary(NAMES[style]), style())
    for _ in range(2):  # unknown first, remembered then
        found = encoder.encode([*TRICKY, None, ""])
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library(style, t) for t in [*TRICKY, None, ""]]


@pytest.mark.parametrize("style", [ByteLevel, WordLevel])
def test_full_memory_changes_nothing(style, monkeypatch):
    monkeypatch.setattr(tokens, "UNITS", 5)

    encoder = Encoder(vocabulary(NAMES[style]), style())
    for seed in range(4):
        text = prose(200, seed)
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library(style, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB' \n\t\r é1²_.!́ßΣ", max_size=40), max_size=4))
def test_units_of_any_text(texts):
    for style in (ByteLevel, WordLevel):
        encoder = tokens.encoder(vocabulary(NAMES[style]), style)
        found = [np.frombuffer(f, "<u4").tolist() for f in encoder.encode(texts)]
        assert found == [library(style, t) for t in texts]



@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.just(0), st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), min_size=1, max_size=90), max_size=6))
def test_words_round_trip(docs):
    flat = np.array([i for d in docs for i in d], np.uint64)
    ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
    words, places = pack_words(flat, ends)
    counts = np.array([len(d) for d in docs], np.int64)
    assert [p.tolist() for p in unpack_words(words, places, counts)] == docs


def test_words_are_dense():
    words, _ = pack_words(np.full(600, 40_000, np.uint64), np.array([600]))
    assert len(words) == 200
    words, _ = pack_words(np.ones(600, np.uint64), np.array([600]))
    assert len(words) == 10


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_token_files(spark):
    rows = awkward() + [(100 + i, prose(300, i)) for i in range(60)]
    path = scratch_path(spark, "tokens-test")
    write_token_files(table(spark, rows), path)
    got = read_token_files(spark, path).collect()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in ordered(rows)]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    want = Counter((i, tuple([*library(ByteLevel, t), 0])) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want


def valid(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing(spark):
    rows = awkward() + [(100 + i, prose(20 + 7 * i, i)) for i in range(60)] + [(200 + i, "tie") for i in range(50)]
    for capacity in (4096, 256):
        got = pack(table(spark, rows), capacity=capacity).collect()
        want = Counter()
        for i, t in rows:
            ids = [*library(WordLevel, t), 1]
            for n, a in enumerate(range(0, len(ids), capacity)):
                part = ids[a : a + capacity]
                want[i, n, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        sequences = valid(got, capacity)
        assert sequences <= 1 + 1.05 * sum(r.length for r in got) / capacity


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plan_is_best_fit_decreasing(lengths):
    class Piece:
        def __init__(self, length, sequence_id, offset):
            self.length, self.sequence_id, self.offset = length, sequence_id, offset

    rows = plan(lengths, 64)
    placed = []
    for length, n in lengths.items():
        mine = rows[rows[:, 0] == length]
        for r in range(n):
            _, rank, sequence, offset, slots = mine[np.searchsorted(mine[:, 1], r, side="right") - 1].tolist()
            placed.append(Piece(length, sequence + (r - rank) // slots, offset + (r - rank) % slots * length))
    gaps = []
    for length in sorted((k for k, n in lengths.items() for _ in range(n)), reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else 64) - length)
    assert valid(placed, 64) == len(gaps)


def test_empty_tables(spark):
    docs = table(spark, awkward()).filter(F.lit(False))
    path = scratch_path(spark, "tokens-none")
    write_token_files(docs, path)
    assert read_token_files(spark, path).collect() == pack(docs).collect() == []


@pytest.mark.parametrize("style", [ByteLevel, WordLevel])
def test_capitals_whose_lower_forms_lie_elsewhere(style):
    capitals = [chr(c) for c in range(0x250) if any(ord(x) >= 0x250 for x in chr(c).lower())]
    texts = ["\u018fli", *(f"A{c}LI {c}li x{c}" for c in capitals)]
    encoder = Encoder(vocabulary(NAMES[style]), style())
    assert len(capitals) > 20
    assert [np.frombuffer(f, "<u4").tolist() for f in encoder.encode(texts)] == [library(style, t) for t in texts]
