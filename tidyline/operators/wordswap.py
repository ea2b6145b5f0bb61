"""Words of a text replaced at given places (J6) as an Arrow UDF.

A text of many words costs a lambda call per word natively; here it is split once
and its replaced words are set in the list."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyline.functions.bigrams import slices


def _swapped(text: str | None, at: list[int], new: list[str | None]) -> str | None:
    if text is None:
        return None
    words, swaps = text.split(), dict(zip(at, new, strict=True))
    if len(swaps) < len(at) and len(swaps) < len(set(zip(at, new, strict=True))):
        raise ValueError("two replacements at one place: rows with different texts have one key")
    for i, w in swaps.items():
        if w is not None and i < len(words):
            words[i] = w
    return " ".join(words)


def swapped_words(text: str, swaps: str) -> Column:
    """The words of ``text`` (B6) joined by blanks, replaced as ``swaps`` says: an array of (place, word), places from 0,
    in any order; null changes none."""

    @F.arrow_udf("string")
    def kernel(t: pa.Array, r: pa.Array) -> pa.Array:
        made, start = [], 0
        for part in slices(t):  # the Python strings of one pass at a time
            mine = r.slice(start, len(part))
            ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(mine), 0)).to_pylist()
            flat = mine.flatten()
            at, new = pc.struct_field(flat, 0).to_numpy(zero_copy_only=False).tolist(), pc.struct_field(flat, 1).to_pylist()
            made.append(pa.array([_swapped(s, at[i:j], new[i:j]) for s, i, j in zip(part.to_pylist(), [0, *ends], ends, strict=False)], pa.string()))
            start += len(part)
        return pa.concat_arrays(made) if made else pa.array([], pa.string())

    return kernel(F.col(text), F.col(swaps))
