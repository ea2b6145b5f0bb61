"""Secrets in texts: three fixed patterns, and values in a credential context
that a guesser would need long for.

The guess cost of a value is the least cost of cutting it into dictionary words
(with capitals and look-alike characters), dates, repeats, keyboard walks and
brute-force characters, found by dynamic programming in one pass over the value.
Costs are decimal logarithms of the guesses that a piece takes.

Defined cases: a null text counts as empty; whole texts of any length are read;
repeated rows are read each; an empty table gives no rows.  Work is one pass
without a shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Names that make the value after them a credential: the long words anywhere in a name, the short ones at the start of a
#: part of it.  A name is taken whole, with or without a value, so that no name is read twice.
CONTEXT = re.compile(
    r"""(?ai)(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?|(?<![a-z0-9])(?:auth|login|pin))"""
    r"""(?:(?-i:(?<=[a-z])[A-Z][A-Za-z0-9]*+)|[0-9]++)?+(?:[_.-][a-z0-9]++)*+"""
    r"""(?:["']?[\x20\t]*+(?::=|[:=]|\bis\b)[\x20\t]*+["']?"""
    r"""((?<=")(?:\\.|[^"\\\n])++(?=")|(?<=')(?:\\.|[^'\\\n])++(?=')|[^\s"'<>,;]+))?""")
HINTS = ("pass", "pwd", "secret", "token", "api", "access", "auth", "credential", "login", "pin")
MIN_VALUE = 6
#: Costs of values up to this length are remembered within a task's process.
SHORT = 200
#: Values that take 10**8 guesses or more are secrets.
MIN_COST = 8.0

# Frequent passwords and words in passwords, the most frequent first.
WORDS = ("password 123456 qwerty admin welcome login letmein dragon monkey master shadow sunshine princess football "
         "baseball superman batman trustno hello freedom whatever secret summer winter spring autumn love money access "
         "flower computer internet service server test guest user root default changeme example sample demo company "
         "office house family friend michael jennifer jordan hunter thomas robert daniel andrew charlie ashley "
         "ginger cookie pepper cheese coffee banana orange purple yellow silver golden diamond killer soccer hockey "
         "tigers ranger buster maggie matrix mustang corvette mercedes the and for you with this that from have are").split()
RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
LONGEST = max(map(len, WORDS))
# Look-alike characters and keyboard rows.
LOOKS = str.maketrans("4@831!0$57", "aabelioss" + "t")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)}
NEXT |= {(b, a) for a, b in NEXT}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
#: Each further piece multiplies the guesses by two.
PIECE = math.log10(2)


def guess_cost(value: str) -> float:
    """Least decimal logarithm of guesses over all segmentations."""
    return _short_cost(value) if len(value) <= SHORT else _least_cost(value)


def _least_cost(value: str) -> float:
    """Each position looks back at most ``LONGEST`` characters for words; of
    repeats and walks only the run that ends there counts, so time grows with the
    value's length."""
    low = value.lower()
    if len(low) != len(value):
        low = value
    plain = low.translate(LOOKS)
    n = len(value)
    best = [0.0] + [math.inf] * n
    same = walk = 0  # start of the run of one character, of the keyboard walk, that reaches position i
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if m := DATE.match(value, i):
            dates.setdefault(m.end(), []).append(i)
    for i in range(n):
        if i and low[i] != low[i - 1]:
            same = i
        if i and (low[i - 1], low[i]) not in NEXT:
            walk = i
        end = i + 1
        # one character by brute force: a letter after a letter is easier to guess
        after = i and value[i].isalpha() and value[i].islower() and value[i - 1].isalpha()
        cost = best[i] + (0.55 if after else 1.0)
        if end - same >= 3:
            cost = min(cost, best[same] + 1.0 + math.log10(end - same) + PIECE)
        if end - walk >= 3:
            cost = min(cost, best[walk] + math.log10(40 * (end - walk)) + PIECE)
        for s in dates.get(end, ()):
            cost = min(cost, best[s] + math.log10(365 * 100 if end - s > 4 else 100) + PIECE)
        for s in range(max(0, end - LONGEST), end - 2):
            for word, extra in ((low[s:end], 0.0), (plain[s:end], math.log10(4))):
                if word in RANK:
                    caps = sum(c.isupper() for c in value[s:end])
                    cost = min(cost, best[s] + RANK[word] + extra + (math.log10(2) * min(caps, 2) if caps else 0.0) + PIECE)
                    break
        best[end] = cost
    return best[n]


@lru_cache(maxsize=100_000)
def _short_cost(value: str) -> float:
    return _least_cost(value)


def base_spans(text: str, low: str) -> list[tuple[int, int, str]]:
    """(start, kind, end) of the fixed patterns.  Kinds are given by their place in ``KINDS``."""
    out = []
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def guess_spans(text: str, low: str, base: list, min_cost: float = MIN_COST) -> list[tuple[int, int, int]]:
    """Values in a credential context that cost enough and are not inside a base span."""
    if not any(w in low for w in HINTS):
        return []
    found = [(m.start(1), 3, m.end(1)) for m in CONTEXT.finditer(text) if m.end(1) - m.start(1) >= MIN_VALUE]
    starts, reach = [b[0] for b in base], list(accumulate((b[2] for b in base), max))  # base spans are in order

    def inside(s: tuple[int, int, int]) -> bool:
        k = bisect_right(starts, s[0])
        return k > 0 and s[2] <= reach[k - 1]

    return [s for s in found if not inside(s) and guess_cost(text[s[0]:s[2]]) >= min_cost]


SPANS = "array<struct<start: int, kind: string, end: int>>"


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), min_cost: float = MIN_COST) -> DataFrame:
    """The columns ``keep`` with ``spans``, all secrets of the text in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        for batch in batches:
            rows = []
            for t in batch.column(batch.num_columns - 1):
                s = t.as_py() or ""
                low = s.lower()
                base = base_spans(s, low)
                rows.append([{"start": a, "kind": KINDS[k], "end": b} for a, k, b in sorted(base + guess_spans(s, low, base, min_cost))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], names=[*keep, "spans"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, ", ".join([*fields, f"spans {SPANS}"]))


def digest(docs: DataFrame) -> DataFrame:
    """Counts, the checksum of the base spans, and all spans as text."""
    found = find_secrets(docs)
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", of("assign"), of("access"), of("hex"),
                        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` (overlapping
    spans by one mark); n_chars, where the table has it, is counted anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = batch.schema.get_field_index(text), []
            for t in batch.column(at):
                s = t.as_py()
                if s:
                    low, made, done = s.lower(), [], 0
                    base = base_spans(s, low)
                    for a, _, b in sorted(base + guess_spans(s, low, base)):
                        if a >= done:
                            made += [s[done:a], mark]
                        done = max(done, b)
                    s = "".join([*made, s[done:]]) if made else s
                out.append(s)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
