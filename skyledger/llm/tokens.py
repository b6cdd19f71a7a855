"""Token ids by the tokenizers library, with what it returned for frequent words remembered.

Text is cut only where the tokenizer cuts in any case, so that the ids of a text are those of its
units one after another. In Latin text the units are the tokenizer's own words; elsewhere they are
what stands between blanks. Units that are not remembered go to the library in one batch. Strings of
special tokens have the ids of these, as the library gives them, and no unit reaches across one.
"""

from __future__ import annotations

import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Remembered units; beyond that nothing more is remembered.
UNITS = 1_000_000
#: Below U+0250 Unicode's classes have not changed for long and nothing composes or decomposes.
_PLAIN = re.compile(r"[\x00-ɏ]*")
#: White space other than blank and line feed: such texts are not cut.
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: White space other than blank and line feed, as far as it is Latin-1.
_ODD = ("\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"


def _read(path: str, words_only: bool):
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    if words_only:  # a word needs no cutting, only its bytes spelled as the vocabulary does
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


def in_latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def is_plain(text: str) -> bool:
    """Whether all characters are below U+0250."""
    return in_latin_1(text) or bool(_PLAIN.fullmatch(text))


def has_other_space(text: str) -> bool:
    """Whether there is white space other than blanks and line feeds."""
    return any(odd in text for odd in _ODD) or (not in_latin_1(text) and bool(_OTHER_SPACE.search(text)))


class ByteLevel:
    """A byte-level BPE that keeps white space: a word takes one blank before it along."""

    word = re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^ \n{_LETTERS}{_NUMBERS}]+"
        r"|[ \n]+(?![^ \n])|[ \n]+"
    )
    unit = re.compile(r"[ \n]*[^ \n]+|[ \n]+")

    def units(self, text: str) -> tuple[list[str], bool]:
        """The units, and whether they are words."""
        if has_other_space(text):
            return [text], False
        plain = is_plain(text)
        return (self.word if plain else self.unit).findall(text), plain


class WordLevel:
    """A BPE that drops white space and case, and takes digits one by one."""

    word = re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^ \n{_LETTERS}{_NUMBERS}]+"
    )

    def units(self, text: str) -> tuple[list[str], bool]:
        """The units, and whether they are words."""
        lower = text.lower()  # some capitals have lower forms that the classes do not reach
        if is_plain(text) and is_plain(lower) and not has_other_space(text):
            return self.word.findall(lower), True
        return text.replace("\n", " ").split(" "), False


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    #: Remembered units where fewer than ``UNITS``.
    most = UNITS

    def __init__(self, path: str, style: ByteLevel | WordLevel) -> None:
        self.style = style
        self.libraries = {words_only: _read(path, words_only) for words_only in (True, False)}
        self.known: dict[str, bytes] = {"": b""}
        added = self.libraries[False].get_added_tokens_decoder().items()
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None

    def _ids(self, units: list[str], words: bool) -> list[bytes]:
        """The ids of units that are not remembered; ``words``: they need no cutting."""
        if not words:
            found = self.libraries[False].encode_batch_fast(units, add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        out = []
        for at in range(0, len(units), 5000):  # words go as one list, and come back as one
            some = units[at : at + 5000]
            read = self.libraries[True].encode(some, is_pretokenized=True, add_special_tokens=False)
            flat = np.array(read.ids, "<u4").tobytes()
            stops = np.searchsorted(np.array(read.word_ids, np.int64), np.arange(len(some) + 1)) * 4
            out += [flat[i:j] for i, j in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
        return out

    def _new(self, units: list[str], words: bool) -> dict[str, bytes]:
        new = dict(zip(units, self._ids(units, words), strict=True))
        if len(self.known) < min(self.most, UNITS):
            self.known |= {u: ids for u, ids in new.items() if len(u) < 100}
        return new

    def _stretches(self, texts: list[str | None]) -> tuple[list[str], dict[int, list[bytes | int]]]:
        """Texts to cut, and for texts with special tokens their ids among numbers of texts."""
        if self.specials is None:
            return [t or "" for t in texts], {}
        plain, mixed = [], {}
        for row, text in enumerate(texts):
            pieces = self.specials.split(text) if text and "<" in text else [text or ""]
            if len(pieces) > 1:
                parts = mixed[row] = []
                for piece in pieces:
                    parts.append(self.special.get(piece, len(plain)))
                    plain += [piece] if piece not in self.special else []
            else:
                mixed[row] = [len(plain)]
                plain.append(pieces[0])
        return plain, mixed

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, without end ids; null is an empty text."""
        plain, mixed = self._stretches(texts)
        found = self._encode(plain)
        if len(plain) == len(texts):  # no text holds a special token
            return found
        return [b"".join(found[p] if isinstance(p, int) else p for p in mixed[row]) for row in range(len(texts))]

    def _encode(self, texts: list[str]) -> list[bytes]:
        known = self.known.get
        rows, missing = [], {True: set(), False: set()}
        for text in texts:
            units, words = self.style.units(text) if text else ([], True)
            parts = list(map(known, units))
            holes = [i for i, p in enumerate(parts) if p is None] if None in parts else []
            missing[words].update([units[i] for i in holes])
            rows.append((units, parts, holes))
        new = self._new(list(missing[False]), False) | self._new(list(missing[True]), True)
        for units, parts, holes in rows:
            for i in holes:
                parts[i] = new[units[i]]
        return [b"".join(parts) for _, parts, _ in rows]


class PlainEncoder(Encoder):
    """Strings of special tokens are ordinary text."""

    def __init__(self, path: str, style: ByteLevel | WordLevel) -> None:
        super().__init__(path, style)
        self.specials = None
        for library in self.libraries.values():
            library.encode_special_tokens = True


_ENCODERS: dict[tuple[str, type, type], Encoder] = {}


def encoder(
    path: str, style: type[ByteLevel] | type[WordLevel], kind: type[Encoder] = Encoder
) -> Encoder:
    """The encoder of this worker process, with what it remembers."""
    if (path, style, kind) not in _ENCODERS:
        _ENCODERS[path, style, kind] = kind(path, style())
    return _ENCODERS[path, style, kind]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
