"""Alignment against whole texts read by both libraries, and the laws of fragments."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fixtures import awkward, prose, table
from skyledger.llm.alignment import EMPTY, Aligner, align, closed, compose, fragment
from skyledger.llm.bpe import byte_letters
from skyledger.llm.tokens import vocabulary

A = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
SIZE = B.get_piece_size()
BOTH = Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))

BYTE_OF = {c: b for b, c in enumerate(byte_letters())}
BYTES_A = [bytes(BYTE_OF.get(c, 0) for c in A.id_to_token(i)) for i in range(A.get_vocab_size())]
BYTES_B = [b"" if B.is_control(i) or B.is_unknown(i) else bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i)
           else B.id_to_piece(i).replace("▁", " ").encode() for i in range(SIZE)]

TRICKY = [
    "a▁b", "\nx", "  two  blanks ", "x\ty \t z\n\n w ", "<|endoftext|> <s></s> <0x41>", "\x00a \x1cb\x85 c  d", " ", "\n",
    "é ́ 漢字 かな 😀😀 \U0001f468‍\U0001f469", "12345  67", "it's they'll", "a  b 　　 c", "\t  ", "!\x1c !\n !",
]


def groups_of(text):
    """(a ids, b ids) of each group by the plain definition, from whole texts."""
    want = (" " + text).encode() if text else b""
    a = A.encode(" " + text, add_special_tokens=False).ids if text else []
    b = B.encode(text) if text else []
    if b"".join(BYTES_A[i] for i in a) != want or b"".join(BYTES_B[i] for i in b) != want:
        return []
    ends = []
    for ids, held in ((a, BYTES_A), (b, BYTES_B)):
        at, found = 0, []
        for i in ids:
            at += len(held[i])
            found.append(at)
        ends.append(found)
    out, i, j = [], 0, 0
    upto = [{end: k for k, end in enumerate(found, 1)} for found in ends]
    for end in sorted(upto[0].keys() & upto[1].keys()):
        k, m = upto[0][end], upto[1][end]
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def spelled(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def brute_force(rows):
    groups = [groups_of(t or "") for _, t in rows]
    counts = Counter((a[-1], b[-1]) for found in groups for a, b in found)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (i, _), found in zip(rows, groups, strict=True):
        links = [(a[-1], b[-1]) for a, b in found]
        out.append((
            i or 0, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), len(links),
            sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
            digest(found),
        ))
    return sorted(out)


def rows_of(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((r.doc_id or 0, *(r[c] for c in names)) for r in df.collect())


def digest(groups):
    return hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else ""


def own(*texts):
    return [(n_a, n_b, n, sha) for n_a, n_b, n, sha, *_ in BOTH.finish([" " + t for t in texts])]


def wanted(*texts):
    found = [groups_of(t) for t in texts]
    return [(sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), digest(g)) for g in found]


@pytest.mark.parametrize("text", TRICKY)
def test_units_are_cut_where_both_tokenizers_cut(text):
    assert BOTH.b.cuts
    assert own(text) == wanted(text)
    assert own("one two", text, "three", text) == wanted("one two", text, "three", text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aB' \n\t\r\x1c é1_.!́字😀▁", min_size=1, max_size=40), min_size=1, max_size=4))
def test_units_of_any_text(texts):
    assert own(*texts) == wanted(*texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB'é1.", min_size=1, max_size=9), min_size=1, max_size=9), st.sampled_from([" ", "\n"]))
def test_simple_texts(words, space):
    assert own(space.join(words)) == wanted(space.join(words))


@pytest.mark.parametrize("seed", range(20))
def test_fragments_compose_in_any_order(seed):
    """Random ends, cut anywhere: any tree gives the fragment of the whole."""
    rng = random.Random(seed)
    total = 40
    ends = [sorted({*rng.sample(range(1, total), rng.randint(0, 15)), total}) for _ in range(2)]
    ids = [[rng.randrange(100) for _ in e] for e in ends]
    whole = fragment(ids[0], ends[0], ids[1], ends[1], SIZE)
    borders = [0, *sorted(rng.sample(range(1, total), 6)), total]
    parts = []
    for lo, hi in zip(borders, borders[1:]):
        picked = [[(i, e) for i, e in zip(ids[s], ends[s]) if lo < e <= hi] for s in range(2)]
        parts.append(fragment(*([x[k] for x in picked[s]] for s in range(2) for k in range(2)), SIZE))
    while len(parts) > 1:
        k = rng.randrange(len(parts) - 1)
        parts[k : k + 2] = [compose(parts[k], parts[k + 1])]
    as_lists = [list(x) if isinstance(x, tuple | list) else x for x in parts[0]]
    assert as_lists == [list(x) if isinstance(x, tuple | list) else x for x in whole]
    assert compose(EMPTY, whole) == compose(whole, EMPTY) == whole
    assert closed(whole).count(";") + 1 == len(whole.links) // 8


def test_rows_against_brute_force(spark):
    rows = [*awkward(), *enumerate(TRICKY, 100), (200, "x" * 3000), (201, "▁")]
    found = align(table(spark, rows))
    assert rows_of(found) == brute_force(rows)
    assert align(table(spark, [])).collect() == []
    assert rows_of(align(table(spark, [(1, None), (2, "")]))) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_long_documents_and_rare_pairs(spark):
    """Small pieces, ranges and fan make several levels; few held pairs leave the rest to the join."""
    rows = [(1, prose(900, 1)), (2, prose(500, 2) + "▁" + prose(400, 3)), (3, "short"), (4, "y" * 2000 + " " + prose(90, 4)),
            (None, prose(900, 1)), (4, prose(200, 5)), (5, " ".join(TRICKY[1:] * 9))]
    found = align(table(spark, rows), piece=300, chunk=70, fan=2, held_pairs=3)
    assert rows_of(found) == brute_force(rows)
