"""Seeded, partition-independent random draws from a hash of the row key.

``hash32(k, ...)`` is the first 32 bits of ``md5("k:...")`` as a bigint in
[0, 2**32).  The same number is ``('0x' || substr(md5(...), 1, 8))::BIGINT``
in DuckDB, which keeps every draw checkable by SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def _s(x) -> Column:
    if isinstance(x, Column):
        return x.cast("string")
    if isinstance(x, str):
        return F.col(x).cast("string")
    return F.lit(str(x))


def key_string(*parts) -> Column:
    """``parts`` joined by ':' (column names, Columns or literal ints)."""
    return F.concat_ws(":", *[_s(p) for p in parts])


def hash32_of(s: Column, slot: int = 0) -> Column:
    """32-bit slice ``slot`` (0..3) of md5 of a string column."""
    return F.conv(F.substring(F.md5(s), 1 + 8 * slot, 8), 16, 10).cast("bigint")


def hash32(*parts, slot: int = 0) -> Column:
    return hash32_of(key_string(*parts), slot)


def uniform(*parts, slot: int = 0) -> Column:
    """A draw in [0, 1)."""
    return hash32(*parts, slot=slot) / F.lit(TWO32)


def sql_hash32(expr: str, slot: int = 0) -> str:
    """DuckDB text of ``hash32_of`` for an SQL string expression."""
    return f"('0x' || substr(md5({expr}), {1 + 8 * slot}, 8))::BIGINT"


def sql_key(*parts: str) -> str:
    return "concat_ws(':', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"


# Integer mixing for per-position draws: one md5 per row gives a 32-bit row
# seed; position i then draws mix32((seed + i * GOLDEN) mod 2**32).  Every
# product stays below 2**63, so ANSI overflow checks never fire, and the same
# arithmetic runs in DuckDB for the oracle.
GOLDEN = 2654435761
MIX = 73244475
M32 = 4294967296


def mix32(x: Column) -> Column:
    x = (x.bitwiseXOR(F.shiftright(x, 16)) * MIX) % M32
    x = (x.bitwiseXOR(F.shiftright(x, 16)) * MIX) % M32
    return x.bitwiseXOR(F.shiftright(x, 16))


def position_draw(row_seed: Column, i: Column) -> Column:
    """A 32-bit draw for position ``i`` of a row."""
    return mix32((row_seed + i.cast("bigint") * GOLDEN) % M32)


def sql_mix32(x: str) -> str:
    x = f"((xor({x}, ({x}) >> 16) * {MIX}) % {M32})"
    x = f"((xor({x}, ({x}) >> 16) * {MIX}) % {M32})"
    return f"xor({x}, ({x}) >> 16)"


def sql_position_draw(row_seed: str, i: str) -> str:
    return sql_mix32(f"(({row_seed}) + CAST({i} AS BIGINT) * {GOLDEN}) % {M32}")
