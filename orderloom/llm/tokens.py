"""Words of a text as 64-bit numbers, worked out on arrays of bytes inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1 << 18
_GAP = 0x20
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE_BYTES + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

# Lower-cases A-Z; what is no ASCII letter or digit and not beyond ASCII separates words.
PLAIN_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else _GAP for c in range(256)
)
# Only ASCII white space separates words.
RAW_WORDS = bytes(_GAP if c == 0x20 or 9 <= c <= 13 else c for c in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number scattered over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of bounded length that end between words; a longer word is a part by itself."""
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > PIECE_BYTES:
            end = data.rfind(b" ", start, start + PIECE_BYTES) + 1
            if end <= start:
                end = data.find(b" ", start) + 1 or len(data)
        yield data[start:end]
        start = end


def _hashed(piece: bytes) -> np.ndarray:
    if len(piece) > PIECE_BYTES:  # one long word
        out = np.zeros(1, dtype=np.uint64)
        word = piece.strip(b" ")
        for start in range(0, len(word), PIECE_BYTES):
            out = mixed(out + np.uint64(len(word))) + _hashed(word[start : start + PIECE_BYTES])
        return out
    b = np.frombuffer(piece, dtype=np.uint8)
    inside = np.concatenate([[False], b != _GAP, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b + np.uint64(1)) * _POWERS[: len(b)])])
    return mixed((sums[ends] - sums[starts]) * _INVERSES[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None, table: bytes) -> np.ndarray:
    """One number per word, in order; equal words have equal numbers everywhere. Different words may share a number, and
    some are made to: numbers find candidates, and words decide."""
    data = (text or "").encode(errors="replace").translate(table)
    parts = [_hashed(piece) for piece in _pieces(data)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """One number per run of `size` words; a shorter text is one run, an empty one none. See `word_runs` for the
    runs themselves."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mixed(out)


def word_runs(text: str | None, table: bytes, size: int) -> list[bytes]:
    """The runs themselves: their words, joined by a space."""
    words = (text or "").encode(errors="replace").translate(table).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(run) for run in zip(*[words[k:] for k in range(size)], strict=False)]
