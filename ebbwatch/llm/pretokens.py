"""Pre-tokens of a lower-casing word BPE, split in Python so that each distinct one is encoded once.

The tokenizer file splits normalised text into letters, single digits and runs of other signs, and
merges within those only. A text's tokens are therefore those of its pre-tokens behind each other.
Texts with characters whose normal form, case or class could differ between Unicode versions, or that
may hold a special string, go to the library as a whole. Texts in Latin-1 can be split many at once, as
arrays of bytes (``latin_split``).
"""

from __future__ import annotations

import os
import re
import unicodedata
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
TOGETHER = 4_000  # pre-tokens in one call of the library, which needs some hundred times their bytes

_END = 0x300  # first combining mark; all text below it is in normal form
_SPACES = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0}
_MOVED = "İȺȾ"  # their lower case is at or above _END, or two characters
_UNSAFE = re.compile(rf"[{_MOVED}]|[^\x00-˿]")


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_END) if unicodedata.category(chr(c))[0] == kind)


_LETTERS, _NUMBERS, _BLANKS = _class("L"), _class("N"), "".join(map(re.escape, map(chr, sorted(_SPACES))))
# The pre-token pattern of the tokenizer file.
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
)

# The same pattern for Latin-1, whose characters are bytes: lower case, and the class of each byte.
_LOWER = "".join(map(chr, range(256))).lower().encode("latin-1")
_BLANK, _LETTER, _NUMBER, _SIGN = range(4)
_KINDS = np.array(
    [
        _BLANK if c in _SPACES else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _SIGN)
        for c in range(256)
    ],
    np.uint8,
)


@cache
def tokenizer(name: str = VOCABULARY) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


def pretokens(text: str) -> list[str] | None:
    """The pre-tokens, or None if the library must encode the text as a whole."""
    if not _latin1(text) and _UNSAFE.search(text) or "<|" in text:
        return None
    return _SPLIT.findall(text.lower())


def _latin1(text: str) -> bool:
    """Much quicker than the pattern, and true of most texts."""
    return latin_bytes(text) is not None


def latin_bytes(text: str) -> bytes | None:
    """The text in Latin-1, or None if it has other characters."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def latin_split(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pre-tokens of texts in Latin-1, those of all texts behind each other as positions in them, and
    where those of each text end."""
    data = np.frombuffer(b" ".join([*texts, b"   "]).translate(_LOWER), np.uint8)  # blanks keep texts apart
    kinds = _KINDS[data]
    first = kinds != _BLANK
    first[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBER)
    # A mark that begins a pre-token takes the letters of a contraction with it.
    marks = np.flatnonzero(first & (data == ord("'")))
    one, two = data[marks + 1], data[marks + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for places, size in ((marks[short], 1), (marks[long], 2)):
        first[places + 1] = False
        rest = places + 1 + size
        first[rest[kinds[rest] == _LETTER]] = True
    starts = np.flatnonzero(first)
    solid = kinds != _BLANK
    before = np.cumsum(solid, dtype=np.int32)[starts] - 1
    words = data[solid]
    offsets = np.append(before, len(words)).astype(np.int32)
    split = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(words)]
    ).dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    distinct = [w.decode("latin-1") for w in split.dictionary.to_pylist()]
    return distinct, split.indices.to_numpy(), np.searchsorted(starts, ends)


def joined_split(splits: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same of texts that ``pretokens`` has split."""
    ends = np.cumsum([len(s) for s in splits], dtype=np.int64)
    split = pa.array(chain.from_iterable(splits), pa.string(), size=int(ends[-1])).dictionary_encode()
    return split.dictionary.to_pylist(), split.indices.to_numpy(), ends


@cache
def _word_ends(vocabulary: str) -> np.ndarray:
    """Whether a token ends a pre-token, by id."""
    entries = tokenizer(vocabulary).get_vocab()
    ends = np.zeros(max(entries.values()) + 1, bool)
    ends[[i for t, i in entries.items() if t.endswith("</w>")]] = True
    return ends


def encode_apart(split: list[str], vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pre-tokens behind each other, and where each one's ids end; a bounded number at once."""
    parts = [_encoded(split[i : i + TOGETHER], vocabulary) for i in range(0, len(split), TOGETHER)]
    if not parts:
        return np.zeros(0, "<u4"), np.zeros(0, np.int64)
    before = np.cumsum([0, *(len(ids) for ids, _ in parts)])
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([ends + n for (_, ends), n in zip(parts, before)])


def _encoded(split: list[str], vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """One call for all of them: white space keeps them apart, and every pre-token ends in a token of its own kind."""
    library = tokenizer(vocabulary)
    ids = np.array(library.encode_batch_fast([" ".join(split)], add_special_tokens=False)[0].ids, "<u4")
    ends = np.flatnonzero(_word_ends(vocabulary)[ids]) + 1
    if len(ends) != len(split):  # not a vocabulary with word ends
        each = [e.ids for e in library.encode_batch(split, add_special_tokens=False)]
        return np.array([i for e in each for i in e], "<u4"), np.cumsum([len(e) for e in each])
    return ids, ends
