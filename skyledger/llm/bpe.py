"""Byte-pair encoding by rounds of merges over many words at once, and decoding.

The symbols of all words lie in one flat array. In a round, the rank of every neighbouring pair is
found by binary search over the sorted keys of all pairs, each word takes its lowest rank, and all
places of the word that hold this pair are merged. Words without a pair that merges are done.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.common import batch_of, narrow
from skyledger.llm.tokens import Encoder, WordLevel, encoder, vocabulary

#: Texts that are encoded at a time, and symbols that are merged at a time.
TEXTS = 500
SYMBOLS = 1 << 20
_NEVER = np.iinfo(np.int32).max


@cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    shown = set(prints)
    return [chr(b if b in shown else next(others)) for b in range(256)]


@dataclass(frozen=True)
class Merges:
    """A vocabulary's pairs by sorted key, with the rank and the merged symbol of each."""

    size: int
    first: np.ndarray  # symbol of each byte within a word
    last: np.ndarray  # symbol of each byte at its end
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    #: By rank: no pair with the merged symbol has a lower rank, so all places merge in one round.
    safe: np.ndarray

    @classmethod
    def of(cls, model: dict) -> Merges:
        ids, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        size = max(ids.values()) + 1
        used_at = np.full(size, _NEVER, np.int64)
        ranks = np.arange(len(pairs))
        for symbols in (left, right):
            np.minimum.at(used_at, symbols, ranks)
        keys = left * size + right
        order = np.argsort(keys)
        letters = byte_letters()
        return cls(
            size,
            np.array([ids[c] for c in letters], np.int64),
            np.array([ids[c + end] for c in letters], np.int64),
            keys[order],
            ranks[order].astype(np.int32),
            made[order],
            used_at[made] > ranks,
        )


def merge_rounds(words: list[bytes], merges: Merges) -> list[np.ndarray]:
    """The symbols of each word."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(words):  # a longer word is alone
        upto, total = at, 0
        while upto < len(words) and (upto == at or total + len(words[upto]) <= SYMBOLS):
            total += len(words[upto])
            upto += 1
        out += _merge(words[at:upto], merges)
        at = upto
    return out


def _merge(words: list[bytes], merges: Merges) -> list[np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = merges.first[raw]
    ends = np.cumsum(lengths)[lengths > 0] - 1
    symbols[ends] = merges.last[raw[ends]]
    word = np.repeat(np.arange(len(words)), lengths)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        rank = np.full(len(symbols), _NEVER, np.int32)
        place = np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        keys = symbols[inside] * merges.size + symbols[inside + 1]
        found = np.minimum(np.searchsorted(merges.keys, keys), len(merges.keys) - 1)
        hit = merges.keys[found] == keys
        place[inside[hit]] = found[hit]
        rank[inside[hit]] = merges.ranks[found[hit]]
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sizes = np.diff(np.append(starts, len(word)))
        lowest = np.minimum.reduceat(rank, starts)
        best = np.repeat(lowest, sizes)
        goes_on = best < _NEVER
        done.append((word[~goes_on], symbols[~goes_on]))
        chosen = np.flatnonzero(goes_on & (rank == best))
        # Of places that share a symbol, as in a run of one letter, every second one merges.
        run = np.flatnonzero(np.diff(chosen, prepend=-2) != 1)
        within = np.arange(len(chosen)) - np.repeat(run, np.diff(np.append(run, len(chosen))))
        chosen = chosen[within % 2 == 0]
        if not merges.safe[rank[chosen]].all():  # then only the first place of the word
            leads = np.concatenate([[True], word[chosen][1:] != word[chosen][:-1]])
            chosen = chosen[leads | merges.safe[rank[chosen]]]
        symbols[chosen] = merges.merged[place[chosen]]
        goes_on[chosen + 1] = False
        symbols, word = symbols[goes_on], word[goes_on]
    if not done:
        return [symbols for _ in words]
    owner = np.concatenate([w for w, _ in done])
    order = np.argsort(owner, kind="stable")
    merged = np.concatenate([s for _, s in done])[order]
    return np.split(merged, np.cumsum(np.bincount(owner, minlength=len(words)))[:-1])


class MergeEncoder(Encoder):
    """Units that are not remembered are encoded by ``merge_rounds``, all words of a batch at once.

    Text outside Latin is normalised and cut into words by the library's own steps, whose Unicode
    tables decide what a letter is.
    """

    most = 400_000  # the decoder's worker stands beside this one

    @cached_property
    def merges(self) -> Merges:
        model = json.loads(self.libraries[False].to_str())["model"]
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        return Merges.of(model)

    def _words(self, unit: str) -> list[bytes]:
        library = self.libraries[False]
        normal = library.normalizer.normalize_str(unit) if library.normalizer else unit
        pieces = library.pre_tokenizer.pre_tokenize_str(normal) if normal else []
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in pieces]

    def _ids(self, units: list[str], words: bool) -> list[bytes]:
        merges = self.merges
        cut = [[u.encode()] for u in units] if words else [self._words(u) for u in units]
        distinct = {w: i for i, w in enumerate({w for parts in cut for w in parts})}
        ids = [s.astype("<u4").tobytes() for s in merge_rounds(list(distinct), merges)]
        return [b"".join([ids[distinct[w]] for w in parts]) for parts in cut]


_IDS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def bpe_encode(
    docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row, as the tokenizers library encodes it.

    No special tokens are added; strings of special tokens in a text have their ids. Null and empty
    texts have no ids; each row is encoded for itself, whatever its id or copies; other columns are
    ignored. ``tokenizer`` is the path of a byte-level BPE that drops white space and case.
    """
    path = tokenizer or vocabulary("word_bpe_49k.json")

    def encode(batches):
        to_ids = encoder(path, WordLevel, MergeEncoder)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                ids = to_ids.encode(some["text"].to_pylist())
                counts = np.array([len(i) // 4 for i in ids], np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                listed = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield batch_of(_IDS, some["doc_id"], counts, listed)

    return narrow(docs, id_col, text_col).mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>")


@cache
def token_names(path: str) -> list[str]:
    """The token of each id as the file spells it; ids without a token have an empty name."""
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    named = {i: t for t, i in read["model"]["vocab"].items()} | {t["id"]: t["content"] for t in read["added_tokens"]}
    return [named.get(i, "") for i in range(max(named) + 1)]


def bpe_decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``encoded`` (``doc_id, n_tokens, ids``) with ``decoded``, as the library decodes ids.

    A tokenizer file without a decoder has its tokens joined by blanks, special ones included. Null
    or empty ids give an empty text.
    """
    path = tokenizer or vocabulary("word_bpe_49k.json")
    schema = pa.schema([*_IDS, ("decoded", pa.string())])

    def decode(batches):
        name = token_names(path).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                texts = [" ".join(map(name, ids or ())) for ids in some["ids"].to_pylist()]
                yield batch_of(schema, some["doc_id"], some["n_tokens"], some["ids"].cast(schema.field("ids").type), texts)

    ddl = "doc_id long, n_tokens long, ids array<int>, decoded string"
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(decode, ddl)
