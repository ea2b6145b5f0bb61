"""Personal data in texts by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs before
a digit, digits, schemes and identifier cues.  At each anchor a local parser
expands to the boundaries of an e-mail address, an IP address, a card or
telephone number, a scheme address with personal parts, or an account number
behind a cue, and validates what it found.  A parser never goes back behind what
one of its kind has taken, so that the spans of a kind do not overlap, and every
run of characters is read a bounded number of times.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` are the base kinds.  ``spelled``
is an e-mail address with its signs spelled out (``ann [at] mail [dot] org``),
``address`` a ``mailto:``, ``tel:``, ``sip:`` or ``xmpp:`` address, or a URL whose
host part names a user; ``account`` an identifier behind a cue (an IBAN by its
check digits, a social security number by its ranges, otherwise 6 to 20 digits).

Defined cases: a null text counts as empty; whole texts of any length are read;
repeated rows are read each; an empty table gives no rows.  Work is one pass
without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyline.llm.common import process_state

KINDS = ("email", "ip", "card", "phone", "spelled", "address", "account")
BASE = KINDS[:4]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# What a parser reads from an anchor on; possessive, so that none of them goes back.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGITS = re.compile(r"[0-9]++")
QUAD = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
GROUPS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]++")
SAID_AT = re.compile(r"\x20?[\[(](?i:at)[\])]\x20?([A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?)[A-Za-z0-9-]++)++)")
AUTHORITY = re.compile(r"[^\s/?#\"'<>@]++@[A-Za-z0-9.:\[\]-]++")
MAILBOX = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NUMBER = re.compile(r"\+?[0-9](?:[\x20().-]{0,2}[0-9])++")
# between a cue and its identifier: a word such as "no", signs, and blanks
JOINT = re.compile(r"(?ai:[\x20\t]*+(?:number|num|nummer|nr|no|id|code)\b\.?)?[\x20\t]*+(?:[:=#]|is\b)*+[\x20\t]*+")
IDENTIFIER = re.compile(r"[A-Za-z0-9](?:[\x20./-]?[A-Za-z0-9]){5,39}+")
SECURITY = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})")

SCHEMES = ("mailto:", "tel:", "sip:", "xmpp:")
CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "ssn", "social security", "passport",
        "reisepass", "passeport", "pasaporte", "tax id", "customer", "insurance", "licence", "license")


def cue_forms(word: str) -> set[str]:
    return {word, word.upper(), word.capitalize(), word.title()}


def automaton() -> ahocorasick.Automaton:
    """The anchors, with what each stands for and its length."""
    auto = ahocorasick.Automaton()
    for c in "0123456789":
        auto.add_word(c, ("digit", 1))
        auto.add_word("+" + c, ("plus", 2))
    auto.add_word("@", ("at", 1))
    for bracket in ("[at]", "(at)", "[AT]", "(AT)", "[At]", "(At)"):
        auto.add_word(bracket, ("said", 4))
    auto.add_word("://", ("url", 3))
    for s in SCHEMES:
        for form in cue_forms(s):
            auto.add_word(form, ("scheme", len(s)))
    for w in CUES:
        for form in cue_forms(w):
            auto.add_word(form, ("cue", len(w)))
    auto.make_automaton()
    return auto


def local_start(text: str, at: int, floor: int) -> int:
    """Where the run of mailbox characters that ends at ``at`` begins."""
    while at > floor and text[at - 1] in LOCAL:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octets(quad: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in quad.split("."))


def iban(value: str) -> bool:
    v = re.sub(r"[\x20./-]", "", value).upper()
    if not (15 <= len(v) <= 34 and v[:2].isalpha() and v[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def security_number(m: re.Match) -> bool:
    return m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"


def account_end(text: str, at: int, cue: str) -> int:
    """The end of the identifier that begins at ``at``; 0 if none does."""
    if cue in ("ssn", "social security"):
        m = SECURITY.match(text, at)
        return m.end() if m and security_number(m) and not text[m.end():m.end() + 1].isdigit() else 0
    m = IDENTIFIER.match(text, at)
    if not m:
        return 0
    value = m[0]
    if value[:2].isalpha() and value[2:4].isdigit():  # the longest of its groups that checks
        ends = [k for k in range(len(value), 14, -1) if k == len(value) or value[k] == " "]
        return next((at + k for k in ends if iban(value[:k])), 0)
    end = re.match(r"[0-9](?:[\x20./-]?[0-9])*+", value)
    if not end or cue == "iban":
        return 0
    after = text[at + end.end():at + end.end() + 1]
    return at + end.end() if 6 <= sum(c.isdigit() for c in end[0]) <= 20 and not after.isalnum() else 0


def spans_of(text: str, auto: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of everything found, in order."""
    out: list[tuple[int, int, int]] = []
    mail = quad = groups = said = taken = 0  # up to here the parsers of a kind have read
    for last, (anchor, size) in auto.iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at >= groups:
                m = GROUPS.match(text, at)
                groups = m.end() if m else at + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, 2, groups))
            if at >= quad:
                m = QUAD.match(text, at)
                if m:
                    quad = m.end()
                    if octets(m[0]):
                        out.append((at, 1, quad))
                else:  # no quad begins in the rest of this run of digits either
                    quad = DIGITS.match(text, at).end()
        elif anchor == "at":
            start, m = local_start(text, at, mail), DOMAIN.match(text, at + 1)
            if m and start < at:
                out.append((start, 0, m.end()))
                mail = m.end()
            else:
                mail = max(mail, at + 1)
        elif anchor == "plus":
            m = DIALLED.match(text, at)
            if m:
                run = m[0].rstrip(" ().-")
                if len(run) > 3 and 10 <= sum(c.isdigit() for c in run) <= 15:
                    out.append((at, 3, at + len(run)))
        elif anchor == "said":
            blank = at > 0 and text[at - 1] == " "
            m = SAID_AT.match(text, at - blank)
            start = local_start(text, at - blank, said)
            if m and start < at - blank:
                out.append((start, 4, m.end()))
                said = m.end()
        elif anchor == "scheme":
            if at >= taken and not text[at - 1:at].isalnum():
                m = (NUMBER if text[at] in "tT" else MAILBOX).match(text, last + 1)
                if m and (text[at] not in "tT" or 7 <= sum(c.isdigit() for c in m[0]) <= 15):
                    out.append((at, 5, m.end()))
                    taken = m.end()
        elif anchor == "url":
            start = at
            while start > taken and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            m = AUTHORITY.match(text, last + 1) if taken <= start < at else None
            if m:
                out.append((start, 5, m.end()))
                taken = m.end()
        elif not text[at - 1:at].isalnum() and not text[last + 1:last + 2].isalpha():  # a cue as a whole word
            start = JOINT.match(text, last + 1).end()
            end = account_end(text, start, text[at:last + 1].lower()) if start > last + 1 else 0
            if end:
                out.append((start, 6, end))
    return sorted(set(out))


SPANS = "array<struct<start: int, kind: string, end: int>>"


def find_personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``spans``: all that was found in the text, by
    start and kind, in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        auto = process_state("personal_data_anchors", automaton)
        for batch in batches:
            rows = [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in spans_of(t.as_py() or "", auto)]
                    for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], names=[*keep, "spans"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, ", ".join([*fields, f"spans {SPANS}"]))


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the checksum of their spans, and all spans as text."""
    found = find_personal_data(docs)
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with everything found in ``text`` replaced by its kind in angle
    brackets; spans that overlap are replaced together, by the kind of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = process_state("personal_data_anchors", automaton)
        for batch in batches:
            at, out = batch.schema.get_field_index(text), []
            for t in batch.column(at):
                s = t.as_py()
                if s and (found := spans_of(s, auto)):
                    made, done = [], 0
                    for a, k, b in found:
                        if a >= done:
                            made += [s[done:a], f"<{KINDS[k]}>"]
                        done = max(done, b)
                    s = "".join([*made, s[done:]])
                out.append(s)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
