"""Words and hashes of whole Arrow string columns, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def fold_table(letters_only: bool = False, lower: bool = True) -> np.ndarray:
    """What each byte counts as in a word: 0 for a separator.

    Separators are space and 0x09 to 0x0D, or with ``letters_only`` every ASCII character but
    letters and digits; ``lower`` folds A-Z.
    """
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    if letters_only:
        keep = np.zeros(256, dtype=bool)
        keep[48:58] = keep[65:91] = keep[97:123] = keep[128:] = True
        table[~keep] = 0
    else:
        table[[0x20, 9, 10, 11, 12, 13]] = 0
        table[0] = 255  # a zero byte is part of a word; 255 occurs in no UTF-8 text
    return table


#: What stands between words of letters and digits: every other ASCII character.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of letters and digits of all texts, A-Z in lower case, and the row of each; null is the empty text.

    A separator at either end of a text leaves an empty word there.
    """
    # Lower case comes before the cast: pyarrow's kernel misreads slices that were cast first.
    split = pc.split_pattern_regex(pc.ascii_lower(column.fill_null("")).cast(pa.large_string()), SEPARATORS)
    per_row = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    return pc.list_flatten(split), np.repeat(np.arange(len(column)), per_row)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and where each row begins; null is the empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the polynomial hash modulo 2^64, and of its inverse."""
    if "up" not in _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(max(n, 1), base, dtype=np.uint64)
            steps[:1] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of data[t] * base^t for i <= t < j."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data.astype(np.uint64) * powers(len(data))[0], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end], the same wherever it stands; lengths are part of it."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, in order, and the row that it is in."""
    folded = table[data]
    inside = folded != 0
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begins] = False
    after[begins[1:] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    per_row = np.diff(np.searchsorted(starts, offsets))
    rows = np.repeat(np.arange(len(offsets) - 1), per_row)
    return span_hashes(prefix_hashes(folded), starts, ends), rows
