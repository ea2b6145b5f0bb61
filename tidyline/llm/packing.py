"""Cost-balanced packing of token ids into sequences of fixed capacity.

Every task packs the documents of its own input partition, in blocks of bounded
size; no shuffle is needed and a lost task is simply run again.  In a block the
whole 2048-token pieces of long documents fill sequences of their own.  What is
left of each document is assigned in descending order of its cost
(``LINEAR * n + QUADRATIC * n**2``) to the lowest-cost sequence with room for
it; only if no sequence has room it is cut, into the lowest-cost ones.  A block
has as few sequences as its tokens allow, so less than one sequence of each
block is padding.

Defined cases: a null text counts as empty and gives the end token alone;
repeated rows are packed as often as they occur; an empty table gives no rows;
the result holds no other columns of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import process_state

CAPACITY = 2048
END = 1
#: Cost of a piece of n tokens: matrix products grow with n, attention with n squared.
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
#: A block is packed when it has so many tokens (a longer document is a block of its own).
BLOCK_TOKENS = 4_000_000
#: A worker remembers so many segments, and as many that it met before these (some 50 MB in all).
MEMO = 150_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Ids:
    """Token ids of whole texts, as uint16 bytes.

    A blank before a character that is not white space always begins a token of
    the byte-level vocabulary, so a text is cut there and the ids of each
    distinct segment are computed once and remembered."""

    def __init__(self, vocabulary: str, special: str):
        import base64
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        # texts with the string of a special token are rare; the tokenizer itself is only held from the first of them on
        self.load = lambda: Tokenizer.from_file(public_tokenizers.path(special))
        self.marks, self.whole = [t.content for t in self.load().get_added_tokens_decoder().values()], None
        self.odd = re.compile(r" (?:\s|\Z)")
        self.cut = re.compile(r" (?=\S)")
        self.memo: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if any(m in text for m in self.marks):  # special tokens in a text: the tokenizer itself decides
            self.whole = self.whole or self.load()
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()
        parts = self.cut.split(text) if self.odd.search(text) else text.split(" ")
        memo = self.memo
        if parts[0] == "" and len(parts) > 1:
            head = b""
        else:
            head = np.array(self.encode(parts[0]), dtype="<u2").tobytes()
        del parts[0]
        try:
            return head + b"".join(map(memo.__getitem__, parts))
        except KeyError:
            if len(memo) > MEMO:
                self.before, self.memo = memo, {}
                memo = self.memo
            for p in parts:
                if p not in memo:
                    memo[p] = self.before.get(p) or np.array(self.encode(" " + p), dtype="<u2").tobytes()
            return head + b"".join(map(memo.__getitem__, parts))


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a block."""
    pieces, full = [], 0
    for d, k in enumerate((lengths // capacity).tolist()):
        for j in range(k):
            pieces.append((d, j * capacity, capacity, full, 0))
            full += 1
    rest = lengths % capacity
    bins = -(-int(rest.sum()) // capacity)
    cost, room = np.zeros(bins), np.full(bins, capacity)
    for d in np.argsort(-rest, kind="stable").tolist():
        start, n = int(lengths[d] - rest[d]), int(rest[d])
        while n:
            ok = room >= n
            if not ok.any():
                ok = room > 0
            b = int(np.where(ok, cost, np.inf).argmin())
            m = min(n, int(room[b]))
            pieces.append((d, start, m, full + b, capacity - int(room[b])))
            cost[b] += LINEAR * m + QUADRATIC * m * m
            room[b] -= m
            start, n = start + m, n - m
    return pieces


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", special: str = "byte_bpe_50k.json",
         capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit)."""

    def block(ids: list, tokens: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = np.array([len(t) // 2 for t in tokens], dtype=np.int64)
        pieces = assign(lengths, capacity)
        flat = [np.frombuffer(t, dtype="<u2") for t in tokens]
        cols = list(zip(*pieces, strict=True))
        used = max(cols[3]) + 1
        batch = pa.RecordBatch.from_arrays([
            pa.array([ids[d] for d in cols[0]], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
            pa.array([flat[d][s:s + n].astype("<u4").tobytes() for d, s, n, _, _ in pieces], pa.binary()),
            pa.array(lengths[list(cols[0])], pa.int64()), pa.array([first + q for q in cols[3]], pa.int64()), pa.array(cols[4], pa.int64()),
        ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        return batch, first + used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = process_state(f"ids_{vocabulary}_{special}", lambda: Ids(vocabulary, special))
        end = np.array([END], dtype="<u2").tobytes()
        nxt = TaskContext.get().partitionId() << 40
        ids, tokens, n = [], [], 0
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = to_ids(text.as_py() or "") + end
                if tokens and n + len(got) // 2 > block_tokens:
                    out, nxt = block(ids, tokens, nxt)
                    yield out
                    ids, tokens, n = [], [], 0
                ids.append(d)
                tokens.append(got)
                n += len(got) // 2
        if tokens:
            out, nxt = block(ids, tokens, nxt)
            yield out

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def pieces(docs: DataFrame) -> DataFrame:
    """``pack`` with the checksum of the ids in their place."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
