"""Token ids and counts with public tokenizers, and overlap resynchronisation.

A word-wise tokenizer never joins characters across certain places, so texts
are cut there and equal pieces are encoded once per worker (a bounded memo):

* ``WordIds``: vocabularies whose pre-tokenizer drops white space. ASCII white
  space always separates, so each run between it is encoded alone.
* ``UnitCounts``: byte-level vocabularies that keep white space. A change
  from non-white-space to ASCII white space is always a boundary: no
  alternative of the split pattern has white space after another character.

Texts over ``CHUNK`` characters are encoded in overlapping chunks by the
library itself, with offsets. Two neighbours are spliced at the last place in
their overlap that is such a proven boundary and where a token ends in both;
if there is none, the overlap is doubled, in the end up to the whole text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np

CHUNK = 32_768
OVERLAP = 256
MEMO = 700_000         # pieces kept by a worker; then it starts afresh

ASCII_SPACE = " \t\n\x0b\x0c\r"
#: White space in Unicode's or in Python's sense beyond ASCII_SPACE.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
UNIT = re.compile(f"[{ASCII_SPACE}]*[^{ASCII_SPACE}]+|[{ASCII_SPACE}]+")
#: ASCII punctuation that no alternative of a split pattern joins to letters before it.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCTUATION_BYTES = PUNCTUATION.encode()
CUT = re.compile(rf"(?<=\S)(?=[{ASCII_SPACE}])")


def _byte_alphabet() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves,
    the others as the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


BYTES = _byte_alphabet()


@lru_cache(maxsize=4)
def load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def load_with_offsets(path: str):
    """The same tokenizer with offsets that include leading white space."""
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    return t


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memo(dict):
    """piece -> value; emptied when it has grown too large.

    Letters and the ASCII punctuation after them are never joined either (but
    for an apostrophe), and letters are what most pieces are made of. So both
    are looked up on their own, and letters go straight to the library's merge
    model, without its normaliser and pre-tokenizer. Any other piece takes the
    library's whole way.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tok = load(path)
        self.merge = self.tok.model.tokenize

    def __missing__(self, piece):
        if len(self) >= MEMO:
            self.clear()
        value = self[piece] = self.value_of(piece)
        return value


class WordIds(_Memo):
    """word (bytes) -> its ids as little-endian 32-bit bytes."""

    def value_of(self, word: bytes) -> bytes:
        if word.isascii():
            low = word.lower()
            body = low.rstrip(PUNCTUATION_BYTES)
            simple = body.isalpha()
        else:
            text = word.decode()
            body = text.rstrip(PUNCTUATION)
            simple = body.isalpha() and "\u03a3" not in body and is_normalized("NFC", body)
            low, body = (text.lower().encode(), body.lower().encode()) if simple else (word, body)
        if not simple:
            ids = self.tok.encode(word.decode(), add_special_tokens=False).ids
        elif len(body) < len(low):
            return self[body] + self[low[len(body):]]
        elif low != word:
            return self[low]
        else:
            ids = [t.id for t in self.merge(word.decode("latin-1").translate(BYTES))]
        return array("I", ids).tobytes()

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        for t in texts:
            if b"<|" not in t:       # else it may hold a special token, which only matches in lower case
                t = t.lower()
            yield b"".join(map(self.__getitem__, t.split()))


class UnitCounts(_Memo):
    """unit (text) -> its number of tokens."""

    def value_of(self, unit: str) -> int:
        body = unit.rstrip(PUNCTUATION)
        if body[body[:1] == " ":].isalpha():
            if len(body) < len(unit):
                return self[body] + self[unit[len(body):]]
            return len(self.merge(unit.encode().decode("latin-1").translate(BYTES)))
        return len(self.tok.encode(unit, add_special_tokens=False).ids)

    def counts(self, texts: Iterable[str]) -> Iterator[int]:
        for t in texts:
            yield sum(map(self.__getitem__, units_of(t)))


@lru_cache(maxsize=4)
def memo(kind: type, path: str) -> _Memo:
    return kind(path)


def units_of(text: str) -> list[str]:
    """The text cut at changes from non-white-space to ASCII white space."""
    return UNIT.findall(text) if ODD_SPACE.search(text) is None else CUT.split(text)


def spliced_ids(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[list[int], int]:
    """The ids of the whole text, encoded in overlapping chunks; and how often
    an overlap had to be widened."""
    tok = load_with_offsets(path)

    def encode(a: int, b: int):
        e = tok.encode(text[a:b], add_special_tokens=False)
        ends = np.array([o[1] for o in e.offsets], dtype=np.int64) + a
        return np.array(e.ids, dtype=np.int64), ends

    ids: list[np.ndarray] = []
    a, b = 0, min(chunk, len(text))
    left_ids, left_ends = encode(a, b)
    done, widened = 0, 0                       # all tokens up to position `done` are final
    while b < len(text):
        over = overlap
        while True:
            start = max(done, b - over)
            nxt = min(len(text), start + chunk + over)
            right_ids, right_ends = encode(start, nxt)
            at = _common(text, start, b, left_ends, right_ends)
            if at is not None:
                break
            widened += 1
            if start == done:                  # no common place: take the left part anew, longer
                b = nxt
                left_ids, left_ends = right_ids, right_ends
                chunk *= 2
                if b >= len(text):
                    break
                over = overlap
                continue
            over *= 2
        if at is None:
            break
        keep = (left_ends <= at) & (left_ends > done)
        ids.append(left_ids[keep])
        done, b = at, nxt
        left_ids, left_ends = right_ids, right_ends
    ids.append(left_ids[left_ends > done])
    return np.concatenate(ids).tolist(), widened


def _common(text: str, start: int, end: int, left: np.ndarray, right: np.ndarray) -> int | None:
    """The last proven boundary in (start, end) where a token ends in both."""
    for at in np.intersect1d(left, right)[::-1].tolist():
        if start < at < end and text[at] in ASCII_SPACE and not text[at - 1].isspace():
            return at
    return None


def count_tokens(batches: Iterator, path: str):
    """mapInArrow over (doc_id, text): doc_id, n_bytes, n_tokens."""
    import pyarrow as pa

    counter = memo(UnitCounts, path)
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        plain = counter.counts([t for t in texts if len(t) <= CHUNK])
        n = [next(plain) if len(t) <= CHUNK else len(spliced_ids(t, path)[0]) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"])
