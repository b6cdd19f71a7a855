"""Rounds of merges against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fixtures import awkward, prose, table
from skyledger.llm import bpe, tokens
from skyledger.llm.bpe import MergeEncoder, Merges, bpe_decode, bpe_encode, merge_rounds
from skyledger.llm.queries import op11_bpe_round_trip
from skyledger.llm.tokens import WordLevel, vocabulary

PATH = vocabulary("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = MergeEncoder(PATH, WordLevel())

TRICKY = [
    "<|endoftext|>", "a<|startoftext|>B c<|endoftext|>d <|END|>", "ẞtraße ΣΑΣ Σ İstanbul ﬁ é ́ a ́b",
    "漢字 かな 한글 😀😀 12345 ½²³ x²", "it's IT'S they'LL ''st don't", "aaaa aaaaa aaaaaa", "\x00 \x1c\x85\t\r\n", "", "x",
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own(texts):
    return [np.frombuffer(i, "<u4").tolist() for i in OWN.encode(texts)]


def test_awkward_texts_have_the_ids_of_the_library():
    for _ in range(2):
        assert own([*TRICKY, None]) == [ids_of(t) for t in [*TRICKY, None]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aabB' \n\t é1²_.!́ßΣ字<|>endoftx", max_size=40), max_size=4))
def test_any_text(texts):
    assert own(texts) == [ids_of(t) for t in texts]


def test_long_words_and_small_batches(monkeypatch):
    monkeypatch.setattr(bpe, "SYMBOLS", 50)
    monkeypatch.setattr(tokens, "UNITS", 3)
    texts = [prose(300, 1), "".join(random.Random(2).choices("abcdeé", k=4000)), "z" * 999, prose(10, 5)]
    assert own(texts) == [ids_of(t) for t in texts]


def reference(word, ranks):
    """One merge at a time: the leftmost place of the lowest rank."""
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        i = min(found)[1]
        word = [*word[:i], word[i] + word[i + 1], *word[i + 2 :]]


@pytest.mark.parametrize("seed", range(30))
def test_any_order_of_merges(seed):
    """Also where a merged symbol has a pair of a lower rank, which no trained file has."""
    rng = random.Random(seed)
    letters = bpe.byte_letters()
    made, pairs = ["a", "b", "c"], []
    for _ in range(14):
        pair = (rng.choice(made), rng.choice(made))
        if pair not in pairs and len("".join(pair)) < 9:
            pairs.append(pair)
            made.append("".join(pair))
    rng.shuffle(pairs)
    vocab = {t: i for i, t in enumerate(dict.fromkeys([*letters, *made]))}
    merges = Merges.of({"vocab": vocab, "merges": [list(p) for p in pairs]})
    ranks = {p: i for i, p in enumerate(pairs)}
    words = ["".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(40)]
    names = {i: t for t, i in vocab.items()}
    got = [[names[i] for i in s.tolist()] for s in merge_rounds([w.encode() for w in words], merges)]
    assert got == [reference(list(w), ranks) for w in words]


def test_rows_of_any_kind(spark):
    rows = [*awkward(), *enumerate(TRICKY, 100)]
    got = bpe_decode(bpe_encode(table(spark, rows)))
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    found = sorted((r.doc_id or 0, r.n_tokens, tuple(r.ids), r.decoded) for r in got.collect())
    wanted = [(i or 0, ids_of(t)) for i, t in rows]
    assert found == sorted((i, len(x), tuple(x), LIBRARY.decode(x, skip_special_tokens=False)) for i, x in wanted)
    assert bpe_decode(bpe_encode(table(spark, []))).collect() == []


def test_query_digests(spark, tmp_path):
    rows = [*awkward(), (50, "<|endoftext|> é")]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    wanted = []
    for i, t in rows:
        ids = ids_of(t)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        wanted.append((i or 0, len(ids), digest(" ".join(map(str, ids))), digest(decoded)))
    got = op11_bpe_round_trip(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(wanted)
