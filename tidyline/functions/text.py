"""Text measures and cleaning as native Spark column expressions (B*, C*).

All functions take column names or Columns and return Columns; nothing here
runs Python per row.  Regexes come from :mod:`tidyline.functions.profiles`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyline.functions import profiles as P


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# B: measures
# ---------------------------------------------------------------------------

def text_length(c) -> Column:
    """B2: length in code points; NULL counts 0."""
    return F.coalesce(F.length(col(c)), F.lit(0))


def class_count(c, cls: str) -> Column:
    """Number of characters of a class (profile name or regex class).

    Named profiles with a code-point range form are counted with
    ``translate`` (delete the allowed characters and measure what is left);
    other classes with ``regexp_count``."""
    if cls in P.RANGES:
        negated, ranges = P.RANGES[cls]
        chars = P.range_chars(ranges)
        kept = F.length(F.translate(col(c), chars, ""))
        return kept if negated else F.length(col(c)) - kept
    return F.regexp_count(col(c), F.lit(P.profile(cls)))


def char_ratio(c, cls: str, digits: int | None = None) -> Column:
    """B1: matches of a class / length, 0 for empty or NULL text."""
    r = F.coalesce(F.try_divide(class_count(c, cls), F.length(col(c))), F.lit(0.0))
    return F.round(r, digits) if digits is not None else r


def ratio_at_least(count: Column, length: Column, num: int, den: int) -> Column:
    """count/length >= num/den, exactly, in 64-bit integers (a text of 214,749 characters overflows 32 bits); empty text has ratio 0."""
    return (length > 0) & (count.cast("bigint") * F.lit(den) >= length.cast("bigint") * F.lit(num))


def noise_bucket(count, length, high_from: tuple[int, int] = P.BUCKET_NORM) -> Column:
    """Low <= .05 < norm <= .2 < high, exact integer comparison.

    ``high_from`` moves the lower edge of "high" (the legacy page uses .3, and
    then rows between .2 and .3 are in no bucket, reported as "none").
    """
    count, length = col(count), col(length)
    c, n = (F.coalesce(x, F.lit(0)).cast("bigint") for x in (count, length))
    hn, hd = high_from
    return (F.when(c * P.BUCKET_LOW[1] <= n * P.BUCKET_LOW[0], "low")
             .when(c * P.BUCKET_NORM[1] <= n * P.BUCKET_NORM[0], "norm")
             .when(c * hd > n * hn, "high")
             .otherwise("none"))


def extract_class(c, cls: str) -> Column:
    """The characters of a class, joined to one string."""
    return F.array_join(F.regexp_extract_all(col(c), F.lit(f"({P.profile(cls)})"), F.lit(1)), "")


def words(c) -> Column:
    """Python ``str.split()``: split on whitespace runs, no empty items."""
    return F.array_remove(F.split(col(c), f"[{P.WS}]+"), "")


def word_count(c) -> Column:
    """Number of words of B6, without building the array."""
    return F.coalesce(F.regexp_count(col(c), F.lit(f"[^{P.WS}]+")), F.lit(0))


_SYLLABLES = P.range_chars([(0xAC00, 0xD7A3)])
_SANDWICH_OTHERS = [(0x41, 0x5A), (0x30, 0x39), (0x318D, 0x318D), (0x3E, 0x3E), (0x3C, 0x3C), (0x223C, 0x223C), (0x2190, 0x2194), *P.WS_RANGES]
SANDWICH_RE = f"[{P.HANGUL}][^{P.SANDWICH_ALLOWED}{P.WS}]+[{P.HANGUL}]"


def has_sandwich(word_array) -> Column:
    """B7 on a word array: a word has Hangul, a run of other marks, Hangul."""
    return F.exists(col(word_array), lambda w: w.rlike(SANDWICH_RE))


def has_sandwich_text(c) -> Column:
    """B7 on the whole text.  Whitespace is excluded from the middle run, so
    this equals the per-word test without splitting.  Hangul becomes U+0001 and the other allowed characters U+0002,
    so that the regex tests single characters, not a class of many ranges."""
    others = P.range_chars(_SANDWICH_OTHERS)
    # an original U+0001 or U+0002 (not allowed) becomes U+0003 first
    mask = F.translate(col(c), "\x01\x02" + _SYLLABLES + others, "\x03\x03" + "\x01" * len(_SYLLABLES) + "\x02" * len(others))
    return mask.rlike("\x01[^\x01\x02]+\x01")


def mask_allowed(c, ranges) -> Column:
    """Every character in ``ranges`` becomes 'a' (``translate``, one hash
    lookup per character), so a test on "anything else" is ``[^a]``."""
    chars = P.range_chars(ranges)
    return F.translate(col(c), chars, "a" * len(chars))


_SPECIAL_RUN_ALLOWED = [(0x41, 0x5A), (0x61, 0x7A), (0x30, 0x39), (0xAC00, 0xD7A3), *P.WS_RANGES, (0x4E00, 0x9FFF)]
_TAG_ALLOWED = [(0x41, 0x5A), (0x61, 0x7A), (0x30, 0x39), (0xAC00, 0xD7A3), (0x3131, 0x3163), *P.WS_RANGES]


def has_special_run(c, n: int = 2) -> Column:
    """``n`` or more characters in a row outside letters, digits, Hangul,
    Hanja and whitespace (the oracle writes it as one negated regex class)."""
    return mask_allowed(c, _SPECIAL_RUN_ALLOWED).rlike(f"[^a]{{{n},}}")


def has_class(c, cls: str) -> Column:
    """Text contains a character of the class."""
    return col(c).rlike(P.profile(cls))


def _tag_of(tok: Column) -> Column:
    return (F.when(tok.rlike("^[A-Za-z]"), "Alpha")
             .when(tok.rlike("^[0-9]"), "Number")
             .when(tok.rlike(f"^[{P.HANGUL}{P.JAMO}]"), "Hangul")
             .otherwise("Punctuation"))


def tag_tokens(word: Column) -> Column:
    """Tag one word: maximal runs of one script class -> array<struct<tok,tag>>."""
    return F.transform(F.regexp_extract_all(word, F.lit(P.TOKEN_RE), F.lit(1)),
                       lambda t: F.struct(t.alias("tok"), _tag_of(t).alias("tag")))


def tag_words(word_array) -> Column:
    """Script-run tagger over a word array -> array<array<struct<tok,tag>>>."""
    return F.transform(col(word_array), tag_tokens)


def _n_tag(w: Column, tag: str) -> Column:
    return F.size(F.filter(w, lambda x: x["tag"] == tag))


def tag_rule_v1(tags) -> Column:
    """Any word with (alpha, punct and number) or 2 alpha or 2 punct runs."""
    def word_rule(w):
        a, p, n = _n_tag(w, "Alpha"), _n_tag(w, "Punctuation"), _n_tag(w, "Number")
        return ((a >= 1) & (p >= 1) & (n >= 1)) | (a >= 2) | (p >= 2)
    return F.exists(col(tags), word_rule)


def tag_rule_v2(tags, n: int = P.V2_MIN_TOKENS) -> Column:
    """Alpha + punct + number runs over the whole text >= n."""
    return F.size(F.filter(F.flatten(col(tags)),
                           lambda x: x["tag"].isin("Alpha", "Punctuation", "Number"))) >= n


def keep_tags(tags, drop: Sequence[str] = ("Alpha", "Number")) -> Column:
    """Drop tokens by tag, join tokens of a word by "" and words by " ",
    then normalise whitespace."""
    joined = F.array_join(
        F.transform(col(tags), lambda w: F.array_join(
            F.transform(F.filter(w, lambda x: ~x["tag"].isin(*drop)), lambda x: x["tok"]), "")),
        " ")
    return collapse_ws(joined)


def drop_latin_tokens(c) -> Column:
    """B14 for the usual drop set (Alpha and Number) without tag arrays:
    Alpha and Number tokens are exactly the runs of [A-Za-z] and [0-9], so
    deleting those characters and normalising whitespace gives the same text
    as ``keep_tags(tag_words(words(c)))``."""
    return collapse_ws(F.translate(col(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", ""))


# Regex forms of B12/B13 on the whole text.  A word is a maximal run of
# non-space characters and the four tag classes cover every such character,
# so "two alpha runs in one word" is an alpha, a run of non-alpha non-space
# characters, and an alpha again; likewise for the other conditions.
_A, _N, _PU = P.TAG_ALPHA, P.TAG_NUMBER, P.TAG_PUNCT
_NS = f"[^{P.WS}]*"
_NOT_PUNCT = f"[A-Za-z0-9{P.HANGUL}{P.JAMO}]"
V1_RE = "|".join(
    [f"{_A}[^A-Za-z{P.WS}]+{_A}", f"{_PU}{_NOT_PUNCT}+{_PU}"]
    + [f"{x}{_NS}{y}{_NS}{z}" for x, y, z in (
        (_A, _PU, _N), (_A, _N, _PU), (_PU, _A, _N), (_PU, _N, _A), (_N, _A, _PU), (_N, _PU, _A))]
)


# Script classes folded to Latin-1 stand-ins: Hangul and Jamo -> \x01, every
# whitespace character -> ' '.  Letters, digits and everything else stay, so
# on the folded text the tag classes are plain byte classes for the JVM.
_FOLD_FROM = P.range_chars([(0xAC00, 0xD7A3), (0x3131, 0x3163)])
_WS_FROM = P.range_chars(P.WS_RANGES)
_FOLD_PU = "[^A-Za-z0-9\x01 ]"


def fold_scripts(c) -> Column:
    """Hangul/Jamo -> U+0001 and whitespace -> space (``translate``)."""
    # an original U+0001 (a punctuation character) becomes U+0002 first
    return F.translate(col(c), "\x01" + _FOLD_FROM + _WS_FROM,
                       "\x02" + "\x01" * len(_FOLD_FROM) + " " * len(_WS_FROM))


def tag_rule_v1_text(c, folded: Column | None = None) -> Column:
    """B12 without building tag arrays (same result as ``tag_rule_v1`` and
    as the single regex ``V1_RE``), on the script-folded text (``folded``, if
    a column holds it already).  Two cheap scans decide most rows; the
    alpha+punct+number-in-one-word test runs per word, and only on texts that
    contain a digit at all."""
    f = fold_scripts(c) if folded is None else folded
    two_alpha = f.rlike("[A-Za-z][^A-Za-z ]+[A-Za-z]")
    two_punct = f.rlike(f"{_FOLD_PU}[A-Za-z0-9\x01]+{_FOLD_PU}")
    three = f.rlike(f"(?:\\A| )(?=[^ ]*{_A})(?=[^ ]*{_N})(?=[^ ]*{_FOLD_PU})")
    return two_alpha | two_punct | (f.rlike(_N) & three)


def tag_run_count(c, folded: Column | None = None) -> Column:
    """Alpha + Number + Punctuation runs in the text (the count B13 uses)."""
    f = fold_scripts(c) if folded is None else folded
    return (F.regexp_count(f, F.lit("[A-Za-z]+")) + F.regexp_count(f, F.lit("[0-9]+"))
            + F.regexp_count(f, F.lit(_FOLD_PU + "+")))


def tag_rule_v2_text(c, n: int = P.V2_MIN_TOKENS, folded: Column | None = None) -> Column:
    """B13 without building tag arrays: the scan ends at the n-th run (same result as ``tag_run_count(c) >= n``)."""
    f = fold_scripts(c) if folded is None else folded
    return f.rlike(f"\\A(?:[\x01 ]*+(?:[A-Za-z]++|[0-9]++|{_FOLD_PU}++)){{{n}}}")


def softmax(z) -> Column:
    """Softmax of an array of doubles (max-shifted)."""
    z = col(z)
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(p) -> Column:
    """0-based index of the first maximum."""
    p = col(p)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def format_id(fmt: str, *cols) -> Column:
    """``format_string`` ids such as ``aug_%d_%d``."""
    return F.format_string(fmt, *[col(c) for c in cols])


def truncate_tokens(tokens, n: int) -> Column:
    """Keep the first n tokens."""
    return F.slice(col(tokens), 1, n)


def token_display(tokens) -> Column:
    """``<tok>`` per token, joined by spaces."""
    return F.array_join(F.transform(col(tokens), lambda t: F.concat(F.lit("<"), t, F.lit(">"))), " ")


# ---------------------------------------------------------------------------
# C: cleaning
# ---------------------------------------------------------------------------

def _alt(words_: Iterable[str]) -> str:
    return "|".join(words_)


def strip_tags(c, legacy: bool = False) -> Column:
    """Strip newsroom tags at the start and the end, once each, in order.

    ``$`` matches before a final newline in Python; ``(\\n?)\\z`` keeps that
    meaning in Java and RE2 and puts the newline back."""
    suffix = P.TAG_SUFFIX_LEGACY if legacy else P.TAG_SUFFIX
    t = F.regexp_replace(col(c), f"^({_alt(P.TAG_PREFIX_1)})", "")
    t = F.regexp_replace(t, f"^({_alt(P.TAG_PREFIX_2)})", "")
    return F.regexp_replace(t, f"({_alt(suffix)})(\\n?)\\z", "$2")


def remove_chars(c, chars: str | Column) -> Column:
    """Delete every character of a set (a string or a string column)."""
    if isinstance(chars, str):
        return F.translate(col(c), chars, "")
    return _translate_cols(col(c), chars)


def _translate_cols(c: Column, chars: Column) -> Column:
    # translate() with a column as the matching set
    return F.call_function("translate", c, chars, F.lit(""))


def remove_special(c, legacy: bool = False) -> Column:
    """Remove the special set (runs or single characters alike)."""
    return F.translate(col(c), P.SPECIAL_SET_LEGACY if legacy else P.SPECIAL_SET, "")


def removed_length(c, legacy: bool = False) -> Column:
    """Length before minus after C2; 0 means no special character."""
    return text_length(c) - text_length(remove_special(c, legacy))


KEEP_ONLY_RE = f"[^a-zA-Z0-9{P.WS}{P.JAMO}{P.HANGUL}{P.HANJA_ALL}]"


def keep_only(c) -> Column:
    """Keep only letters, digits, whitespace, Hangul and Hanja."""
    return F.regexp_replace(col(c), KEEP_ONLY_RE, "")


def keep_only_flagged(c, flag) -> Column:
    """C3 restricted to rows with flag = 1."""
    return F.when(col(flag) == 1, keep_only(c)).otherwise(col(c))


def replace_steps(c, steps: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements, in order."""
    t = col(c)
    for a, b in steps:
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def remove_ellipsis(c) -> Column:
    return replace_steps(c, P.ELLIPSIS_STEPS)


def remove_trend_marks(c) -> Column:
    return replace_steps(c, P.TREND_STEPS)


def collapse_ws(c) -> Column:
    """Python ``" ".join(t.split())``: strip and one space per run."""
    return F.trim(F.regexp_replace(col(c), f"[{P.WS}]+", " "))


def py_strip(c) -> Column:
    """Python ``str.strip()`` (all Unicode whitespace)."""
    return F.regexp_replace(col(c), f"^[{P.WS}]+|[{P.WS}]+\\z", "")


def annotate(c, readings=P.HANJA_READINGS) -> Column:
    """Each dictionary character -> ``漢(reading)``, in one pass; rows
    without any dictionary character are returned unchanged without splitting."""
    kv = []
    for ch, reading, *_ in readings:
        kv += [F.lit(ch), F.lit(f"{ch}({reading})")]
    m = F.create_map(*kv)
    cls = "[" + "".join(ch for ch, *_ in readings) + "]"
    c = col(c)
    return F.when(c.rlike(cls), F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(m, ch), ch)), "")
    ).otherwise(c)


def first_line(c) -> Column:
    """Text before the first newline."""
    return F.substring_index(col(c), "\n", 1)


def drop_newlines(c) -> Column:
    """C9."""
    return F.replace(col(c), F.lit("\n"), F.lit(""))


def extract_answer(c, marker: str = P.ANSWER_MARKER) -> Column:
    """The text after the last marker (if present), stripped, without a
    leading answer prefix, stripped again."""
    c = col(c)
    t = F.when(F.instr(c, marker) > 0, py_strip(F.substring_index(c, marker, -1))).otherwise(c)
    t = F.regexp_replace(t, f"^{P.ANSWER_PREFIX}[{P.WS}]*", "")
    return py_strip(t)


LINE_BREAK_RE = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def first_of_lines(c) -> Column:
    """Python ``splitlines()[0]`` or "" when there is no line."""
    return F.coalesce(F.get(F.split(col(c), LINE_BREAK_RE), 0), F.lit(""))


def extract_answer_line(c, marker: str = P.ANSWER_MARKER) -> Column:
    """C11: C10, then the first line, stripped."""
    return py_strip(first_of_lines(extract_answer(c, marker)))


def extract_title(c, marker: str = P.TITLE_MARKER) -> Column:
    """C12 title: after the last marker, stripped (whole text if absent)."""
    return py_strip(F.substring_index(col(c), marker, -1))


def extract_article(c, end_word: str) -> Column:
    """C12 article: the second piece of a split on the end word; NULL if absent."""
    return py_strip(F.get(F.split(col(c), _quote(end_word)), 1))


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def clean_title(c) -> Column:
    """Remove a quote at the start and at the end, a trailing
    ``이 제목은 ...`` remark, then normalise whitespace."""
    t = F.regexp_replace(col(c), '^"|"(\\n?)\\z', "$1")
    t = F.regexp_replace(t, f"[{P.WS}]*이[{P.WS}]*제목은[^\\n]*(\\n?)\\z", "$1")
    return collapse_ws(t)


def parse_synonyms(c) -> Column:
    """C14: text after the first colon up to the line end, split on commas,
    stripped, empty items dropped; [] when there is no colon."""
    c = col(c)
    seg = F.regexp_extract(c, f":[{P.WS}]*([^\\n]*)", 1)
    items = F.transform(F.split(seg, ","), py_strip)
    return F.when(F.instr(c, ":") > 0, F.filter(items, lambda x: x != "")).otherwise(
        F.array().cast("array<string>"))


def has_synonyms(c) -> Column:
    """Whether ``parse_synonyms`` gives any item, by two scans (its lambdas are interpreted)."""
    return F.regexp_extract(col(c), f":[{P.WS}]*([^\\n]*)", 1).rlike(f"[^,{P.WS}]")


def hangulise(c) -> Column:
    """Test mapping only: 20 Latin letters -> Hangul syllables."""
    return F.translate(col(c), P.HANGULISE_FROM, P.HANGULISE_TO)


def parse_vector(c) -> Column:
    """``"[0.1 0.2]"`` -> array<double>."""
    body = F.trim(F.translate(col(c), "[]", ""))
    return F.transform(F.filter(F.split(body, f"[{P.WS}]+"), lambda x: x != ""),
                       lambda x: x.cast("double"))
