"""Words of whole texts as 64-bit hashes, computed on the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# The white space of word-based contracts, and upper-case letters.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
UPPER = range(ord("A"), ord("Z") + 1)

# Bytes worked on at once; a longer word is still taken whole.
CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_powers = np.ones(1, np.uint64)


def _table(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACES = _table(SPACE_BYTES)
# Everything in ASCII that is no letter parts words of letters; bytes of other scripts do not.
NO_LETTERS = _table(b for b in range(128) if not chr(b).isalpha())
AS_WRITTEN = np.arange(256, dtype=np.uint8)
LOWER_ASCII = np.array([b + 32 if b in UPPER else b for b in range(256)], np.uint8)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def _power_table(size: int) -> np.ndarray:
    global _powers
    if len(_powers) < size:
        size = max(size, 2 * len(_powers), 64)
        with np.errstate(over="ignore"):
            _powers = np.concatenate(
                ([np.uint64(1)], np.cumprod(np.full(size - 1, _BASE, np.uint64), dtype=np.uint64))
            )
    return _powers


def _chunks(data: np.ndarray, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(data):
        end = min(start + CHUNK, len(data))
        while end < len(data):
            gap = np.flatnonzero(separators[data[end : end + CHUNK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + CHUNK, len(data))
        yield start, end
        start = end


def word_hashes(
    texts: Sequence[bytes],
    separators: np.ndarray = SPACES,
    fold: np.ndarray = LOWER_ASCII,
    stems: Sequence[int] = (),
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text, in order, and where each text's words begin (one
    entry more than texts). A word is a maximal run of bytes that are no ``separators``, read
    through ``fold``. Neither texts nor words are cut.

    With ``stems`` the hashes have a row for the words and one for each of these numbers of
    leading bytes; a word of fewer bytes has 0 there."""
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths)))
    hashes, places = [np.zeros((1 + len(stems), 0), np.uint64)], [np.zeros(0, np.int64)]
    for start, end in _chunks(data, separators):
        part = data[start:end]
        at = np.flatnonzero(~separators[part])
        if not len(at):
            continue
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        sizes = np.diff(first, append=len(at))
        within = np.arange(len(at)) - np.repeat(first, sizes)
        powers = _power_table(int(sizes.max()))
        letters = (fold[part[at]].astype(np.uint64) + np.uint64(1)) * powers[within]
        found = [mixed(np.add.reduceat(letters, first))]
        for stem in stems:
            begun = np.add.reduceat(np.where(within < stem, letters, np.uint64(0)), first)
            begun = mixed(begun + np.uint64(stem << 56))
            found.append(np.where(sizes >= stem, begun, np.uint64(0)))
        hashes.append(np.array(found))
        places.append(at[first] + start)
    words = np.concatenate(hashes, axis=1)
    offsets = np.searchsorted(np.concatenate(places), begins)
    return (words if stems else words[0]), offsets


def sliced(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches in slices of a few rows, so that only these are turned into Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_batches(texts: Sequence, size: int = 1 << 21) -> Iterator[slice]:
    """Slices of about ``size`` bytes of text, of one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) if text is not None else 0
        if held >= size:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def encoded(texts: Sequence[str | None]) -> list[bytes]:
    """UTF-8; null is empty."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
