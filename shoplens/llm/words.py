"""Words of Arrow text columns as numpy arrays, a few megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
DENSE_ROWS = 1024  # texts at a time where each has a dense vector
_ONE = np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
_INVERSE = np.uint64(pow(_FACTOR, -1, 1 << 64))


def powers(factor: int | np.uint64, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(factor), dtype=np.uint64)
    out[:1] = _ONE
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of consecutive texts. ``first[d]`` to ``first[d + 1]`` are those of text ``d``."""

    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # text d is data[bounds[d]:bounds[d + 1]]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    names: np.ndarray  # 64-bit digest of each word

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and their bounds; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    raw = texts.buffers()
    bounds = np.frombuffer(raw[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(texts: pa.Array, lower: bool = False, breaks: np.ndarray = _BLANK) -> Words:
    """Split at space, tab, line feed, vertical tab, form feed and carriage return, or at the bytes marked in ``breaks``."""
    data, bounds = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    solid = ~breaks[data]
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(n, dtype=bool)
    before[:1] = True
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1:] = True
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * powers(_FACTOR, n), out=total[1:])
        names = mixed((total[ends] - total[starts]) * powers(_INVERSE, n + 1)[starts])
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds), names)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold about ``limit`` bytes, and at most ``rows`` of them; a longer text is alone."""
    for batch in batches:
        size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, size[at] + limit, "right")) - 1)
            to = min(to, at + rows) if rows else to
            yield batch.slice(at, to - at)
            at = to


def byte_grams(data: np.ndarray, bounds: np.ndarray, orders: tuple[int, ...], dimensions: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams of all texts, and where those of each text begin and end."""
    wide, out = data.astype(np.uint64), []
    for order in orders:
        code = np.full(max(0, len(data) - order + 1), order, dtype=np.uint64)
        for k in range(order):
            code = (code << np.uint64(8)) | wide[k : k + len(code)]
        code *= np.uint64(_FACTOR)
        out.append(((code >> np.uint64(32)) % np.uint64(dimensions), bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - order + 1)))
    return out


def counted(streams: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rows: int, dimensions: int) -> np.ndarray:
    """Term counts of each text over all streams."""
    out = np.zeros((rows, dimensions), dtype=np.float32)
    for terms, begin, end in streams:
        terms = terms.astype(np.int64)
        for d in range(rows):
            if end[d] > begin[d]:
                out[d] += np.bincount(terms[begin[d] : end[d]], minlength=dimensions)
    return out
