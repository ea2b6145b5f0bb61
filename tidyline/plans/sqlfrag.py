"""DuckDB text of the column functions, for the oracle SQL.

These mirror :mod:`tidyline.functions.text` one for one, so an oracle reads
like the Spark plan it checks."""

from __future__ import annotations

from tidyline.functions import profiles as P
from tidyline.functions import text as T


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def count(e: str, cls: str) -> str:
    return f"len(regexp_extract_all({e}, {q(P.profile(cls))}))"


def length(e: str) -> str:
    return f"coalesce(length({e}), 0)"


def hangulise(e: str) -> str:
    return f"translate({e}, {q(P.HANGULISE_FROM)}, {q(P.HANGULISE_TO)})"


def without_hanja(e: str) -> str:
    return f"regexp_replace({e}, {q(P.PROFILES['hanja'])}, '', 'g')"


def collapse_ws(e: str) -> str:
    return f"trim(regexp_replace({e}, {q('[' + P.WS + ']+')}, ' ', 'g'))"


def py_strip(e: str) -> str:
    return f"regexp_replace({e}, {q('^[' + P.WS + ']+|[' + P.WS + ']+\\z')}, '', 'g')"


def rlike(e: str, pattern: str) -> str:
    return f"regexp_matches({e}, {q(pattern)})"


def v1(e: str) -> str:
    return rlike(e, T.V1_RE)


def run_count(e: str) -> str:
    pu = P.TAG_PUNCT + "+"
    return (f"(len(regexp_extract_all({e}, '[A-Za-z]+')) + len(regexp_extract_all({e}, '[0-9]+'))"
            f" + len(regexp_extract_all({e}, {q(pu)})))")


def v2(e: str) -> str:
    return f"({run_count(e)} >= {P.V2_MIN_TOKENS})"


def sandwich(e: str) -> str:
    return rlike(e, T.SANDWICH_RE)


def special_run(e: str, n: int = 2) -> str:
    return rlike(e, f"[^A-Za-z0-9{P.HANGUL}{P.WS}{P.HANJA_ALL}]{{{n},}}")


def replace_steps(e: str, steps) -> str:
    for a, b in steps:
        e = f"replace({e}, {q(a)}, {q(b)})"
    return e


def remove_special(e: str, legacy: bool = False) -> str:
    return f"translate({e}, {q(P.SPECIAL_SET_LEGACY if legacy else P.SPECIAL_SET)}, '')"


def removed_length(e: str) -> str:
    return f"({length(e)} - {length(remove_special(e))})"


def ratio_at_least(c: str, n: str, num: int, den: int) -> str:
    return f"(({n}) > 0 AND ({c}) * {den} >= ({n}) * {num})"


def bucket(c: str, n: str, high_from=P.BUCKET_NORM) -> str:
    hn, hd = high_from
    return (f"CASE WHEN {c} * {P.BUCKET_LOW[1]} <= {n} * {P.BUCKET_LOW[0]} THEN 'low' "
            f"WHEN {c} * {P.BUCKET_NORM[1]} <= {n} * {P.BUCKET_NORM[0]} THEN 'norm' "
            f"WHEN {c} * {hd} > {n} * {hn} THEN 'high' ELSE 'none' END")


def stage(text: str, filtered: str) -> str:
    """The F1 CASE over a raw and a filtered text expression."""
    rules = [
        ("morph_v1", v1(filtered)),
        ("morph_v2", v2(filtered)),
        ("sandwich", sandwich(filtered)),
        ("ratio", ratio_at_least(count(filtered, "upper_ko"), f"length({filtered})", *P.RATIO_THRESHOLD)),
        ("consecutive", special_run(replace_steps(text, P.TREND_STEPS))),
        ("special", f"({removed_length(text)} <> 0 OR "
                    f"{ratio_at_least(count(text, 'lower'), f'length({text})', *P.LOWER_THRESHOLD)})"),
    ]
    whens = " ".join(f"WHEN coalesce({cond}, false) THEN '{name}'" for name, cond in rules)
    return f"CASE {whens} ELSE 'not_noise' END"


def frequent_chars_cte(src: str, text: str, cls: str = "special_ko",
                       min_count: int = P.FREQUENT_MIN_COUNT) -> str:
    """A CTE body giving one row ``chars`` (the frequent set)."""
    return (f"SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS chars FROM ("
            f"SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all({without_hanja(text)}, "
            f"{q('(' + P.profile(cls) + ')')}, 1)) AS ch FROM {src}) GROUP BY ch HAVING count(*) >= {min_count})")
