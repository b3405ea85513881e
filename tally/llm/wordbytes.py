"""Words of UTF-8 texts as byte strings and 64-bit hashes, by numpy, in pieces of bounded size."""

from __future__ import annotations

import numpy as np

PIECE_BYTES = 1 << 20
BLOCK_WORDS = 1 << 17           # hashed at a time, so that arrays of eight bytes a letter stay small

MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BYTE_VALUES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
FACTORS = tuple(np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(32))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX_A
    h = (h ^ (h >> np.uint64(33))) * MIX_B
    return h ^ (h >> np.uint64(33))


def hash_spans(data: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings data[i:j], none of them empty.

    Each byte is mixed with its place in the word before the sum is taken, so words do not
    cancel out as they can in a polynomial modulo a power of two.
    """
    out = np.zeros(len(i), np.uint64)
    for p in range(0, len(i), BLOCK_WORDS):
        a, n = i[p:p + BLOCK_WORDS], (j - i)[p:p + BLOCK_WORDS]
        at = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(at, n)
        y = BYTE_VALUES[data[np.repeat(a, n) + place]] + place.astype(np.uint64) * GOLDEN
        y ^= y >> np.uint64(32)
        y *= MIX_A
        y ^= y >> np.uint64(29)
        out[p:p + BLOCK_WORDS] = mix(np.add.reduceat(y, at) + n.astype(np.uint64))
    return out


def byte_pieces(raw: memoryview):
    """Cut a text at ASCII white space into pieces of about PIECE_BYTES; a word lies in one piece."""
    p, n = 0, len(raw)
    while p < n:
        q = min(n, p + PIECE_BYTES)
        while q < n and raw[q] not in b" \t\n\x0b\x0c\r":
            q += 1
        yield bytes(raw[p:q])
        p = q


def word_segments(column, overlap: int):
    """Cut an Arrow string column into segments of about PIECE_BYTES: (rows, bases, ends, words).

    ``words`` lists the words of the segment's parts in turn; part x holds words[ends[x - 1]:ends[x]] of
    row rows[x], the first of them being that row's word number bases[x].  Short texts are one part each.
    Longer ones are several, each but the first beginning with the last ``overlap`` words of the one before,
    so every run of overlap + 1 words lies in exactly one part.  Null texts are empty.
    """
    rows, bases, ends, words, held = [], [], [], [], 0
    for row, value in enumerate(column):
        raw = memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")
        if len(raw) <= PIECE_BYTES:
            words += bytes(raw).split()
            rows.append(row)
            bases.append(0)
            ends.append(len(words))
            held += len(raw)
            if held >= PIECE_BYTES:
                yield rows, bases, ends, words
                rows, bases, ends, words, held = [], [], [], [], 0
            continue
        own, base = [], 0
        for piece in byte_pieces(raw):
            kept = own[-overlap:] if overlap else []
            base += len(own) - len(kept)
            own = kept + piece.split()
            yield [row], [base], [len(own)], own
    if rows:
        yield rows, bases, ends, words


def word_array(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(words joined by one space, first byte, end) of a list of words."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(n + 1) - 1
    return b" ".join(words), end - n, end
