"""Vectorised per-character noise (J1, J2) as Arrow UDFs.

Per-character draws over whole documents are the one place where a native
higher-order function is slow: its lambda is interpreted per character.
These kernels do the same arithmetic with numpy over the joined code points of many rows,
so that short texts do not cost a call each (row seeds still come from md5 in the
JVM), and give the same output as
:func:`tidyline.operators.augment.inject_noise` / ``drop_class``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyline.functions.bigrams import slices
from tidyline.functions.draws import GOLDEN, M32, MIX

HANJA_LO, HANJA_SPAN = 0x4E00, 0x9FFF - 0x4E00 + 1
ASCII_LO, ASCII_SPAN = 33, 126 - 33 + 1


def _mix32(x: np.ndarray) -> np.ndarray:
    x = ((x ^ (x >> np.uint64(16))) * np.uint64(MIX)) % np.uint64(M32)
    x = ((x ^ (x >> np.uint64(16))) * np.uint64(MIX)) % np.uint64(M32)
    return x ^ (x >> np.uint64(16))


class _Joined:
    """The code points of several texts, with the row and the place of each."""

    def __init__(self, texts: list[str]):
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.row = np.repeat(np.arange(len(texts)), self.sizes)
        self.place = np.arange(len(self.codes)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)

    def draws(self, seeds: np.ndarray) -> np.ndarray:
        return _mix32((seeds.astype(np.uint64)[self.row] + self.place.astype(np.uint64) * np.uint64(GOLDEN)) % np.uint64(M32))

    def texts(self, codes: np.ndarray, sizes: np.ndarray) -> list[str]:
        whole, ends = codes.astype(np.uint32).tobytes().decode("utf-32-le"), np.cumsum(sizes).tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _by_passes(t: pa.Array, change: Callable[[_Joined, np.ndarray], list[str]]) -> pa.Array:
    """Texts changed in passes; null and empty ones stay.  ``change`` takes the joined texts and their places.  Only the
    texts of one pass are Python strings at a time."""
    made, start = [], 0
    for part in slices(t):
        texts = part.to_pylist()
        run = [i for i, x in enumerate(texts) if x]
        if run:
            for i, s in zip(run, change(_Joined([texts[i] for i in run]), np.array(run) + start), strict=True):
                texts[i] = s
        made.append(pa.array(texts, pa.string()))
        start += len(part)
    return pa.concat_arrays(made) if made else pa.array([], pa.string())


def inject_noise_vectorized(text, key, seed: int, level: float = 0.5, ascii_ratio: float = 0.93) -> Column:
    """J1 with a numpy kernel; same result as ``augment.inject_noise``."""
    from tidyline.operators.augment import row_seed, threshold
    tl, ta = np.uint64(threshold(level)), np.uint64(threshold(ascii_ratio))

    @F.arrow_udf("string")
    def kernel(t: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        seeds = [x.to_numpy(zero_copy_only=False) for x in (a, b, c)]

        def change(j: _Joined, at: np.ndarray) -> list[str]:
            h0, h1, h2 = (j.draws(x[at]) for x in seeds)
            new = np.where(h1 < ta, ASCII_LO + h2 % np.uint64(ASCII_SPAN), HANJA_LO + h2 % np.uint64(HANJA_SPAN))
            return j.texts(np.where(h0 < tl, new, j.codes), j.sizes)

        return _by_passes(t, change)

    t = F.col(text) if isinstance(text, str) else text
    return kernel(t, row_seed(key, seed, 0), row_seed(key, seed, 1), row_seed(key, seed, 2))


def drop_class_vectorized(text, key, seed: int, ranges=((0xAC00, 0xD7A3),), frac=(2, 10),
                          mode: str = "drop") -> Column:
    """J2 with a numpy kernel for a class given as code-point ranges (the
    default is Hangul syllables); same result as ``augment.drop_class``."""
    from tidyline.operators.augment import replacement_chars, row_seed
    pool = None if mode == "drop" else np.array([ord(ch) for ch in replacement_chars()], dtype=np.uint32)
    rng = tuple(ranges)

    @F.arrow_udf("string")
    def kernel(t: pa.Array, sd: pa.Array) -> pa.Array:
        seeds = sd.to_numpy(zero_copy_only=False)

        def change(j: _Joined, at: np.ndarray) -> list[str]:
            hits = np.flatnonzero(np.logical_or.reduce([(j.codes >= lo) & (j.codes <= hi) for lo, hi in rng]))
            h, row = j.draws(seeds[at])[hits], j.row[hits]
            n = np.bincount(row, minlength=len(at))
            # of each row the least draws, ties by place
            order = np.lexsort((hits, h, row))
            nth = np.arange(len(hits)) - np.repeat(np.cumsum(n) - n, n)
            chosen = np.sort(hits[order[nth < np.maximum(1, n * frac[0] // frac[1])[row[order]]]])
            if pool is not None:
                codes = j.codes.copy()
                codes[chosen] = pool[(j.draws(seeds[at])[chosen] % np.uint64(len(pool))).astype(np.int64)]
                return j.texts(codes, j.sizes)
            return j.texts(np.delete(j.codes, chosen), j.sizes - np.bincount(j.row[chosen], minlength=len(at)))

        return _by_passes(t, change)

    t = F.col(text) if isinstance(text, str) else text
    return kernel(t, row_seed(key, seed, 0))
