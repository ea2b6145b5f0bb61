"""Character classes and rule constants.

Every regex here is written once so that it means the same thing in Java
(Spark) and in RE2 (DuckDB, used as the test oracle): non-ASCII code points are
spelled ``\\x{HHHH}``, whitespace is one explicit class instead of ``\\s``
(``\\s`` differs between Python, Java and RE2), and no look-around is used.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced).
# ---------------------------------------------------------------------------

# Python's str.isspace() set, i.e. what ``\s`` and ``str.split()`` mean there.
WS = (
    r" \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
HANGUL = r"\x{AC00}-\x{D7A3}"            # 가-힣
JAMO = r"\x{3131}-\x{314E}\x{314F}-\x{3163}"  # ㄱ-ㅎ ㅏ-ㅣ
HANJA_BASIC = r"\x{4E00}-\x{9FA5}"       # 一-龥
HANJA_ALL = r"\x{4E00}-\x{9FFF}"         # 一-鿿
# Characters allowed between two Hangul runs by the sandwich rule:
# upper-case letters, Hangul, digits and ㆍ > < ∼ → ← ↑ ↓ ↔
SANDWICH_ALLOWED = r"A-Z" + HANGUL + r"0-9\x{318D}><\x{223C}\x{2192}\x{2190}\x{2191}\x{2193}\x{2194}"

# Characters removed by the special-character rule (C2); deletion of runs
# equals deletion of each character, so this is used with ``translate``.
SPECIAL_SET = "!#$'\"()*+-/:;<=>?@[\\]^_`{|}&"
SPECIAL_SET_LEGACY = SPECIAL_SET + "＋"  # older variant also has ＋

# Newsroom tags stripped from headlines (C1), applied in this order, once each.
TAG_PREFIX_1 = ("그래픽", "게시판")
TAG_PREFIX_2 = ("종합", "1보", "2보", "3보")
TAG_SUFFIX = ("종합", "종합1보", "종합2보", "1보", "2보", "3보")
TAG_SUFFIX_LEGACY = ("종합", "종합1보", "종합2보", "1보", "2보")

# Ellipsis and trend marks (C4a, C4b), literal replacements in this order.
ELLIPSIS_STEPS = (("…", " "), ("...", ""))
TREND_STEPS = (("…", " "), ("...", ""), ("..", ""), ("%↑", ""), ("%↓", ""),
               ("%→", ""), ("%←", ""))

# Hanja -> reading dictionary (C7); the category is carried but never used.
HANJA_READINGS = (
    ("美", "미국", "나라"), ("北", "북한", "나라"), ("中", "중국", "나라"),
    ("朴", "박", "성씨"), ("靑", "청와대", "정치"), ("日", "일본", "나라"),
    ("與", "여당", "정치"), ("文", "문", "성씨"), ("英", "영국", "나라"),
    ("野", "야당", "정치"), ("佛", "프랑스", "나라"), ("伊", "이탈리아", "나라"),
    ("獨", "독일", "나라"), ("反", "반", "일반"), ("前", "전", "일반"),
    ("軍", "군대", "일반"), ("硏", "연구원", "일반"), ("對", "대", "일반"),
    ("外", "외", "일반"), ("社", "회사", "경제"), ("黃", "황", "성씨"),
    ("亞", "아시아", "나라"), ("韓", "한국", "나라"), ("株", "주식", "경제"),
    ("車", "차", "일반"), ("崔", "최", "성씨"), ("院", "위원", "일반"),
    ("金", "김", "성씨"), ("丁", "정", "성씨"), ("小", "소", "일반"),
    ("和", "네덜란드", "나라"), ("企", "기업", "경제"), ("安", "안", "성씨"),
    ("展", "전시", "일반"), ("檢", "검찰", "정치"), ("親", "친", "일반"),
    ("銀", "은행", "경제"), ("證", "증권", "경제"), ("先", "선", "일반"),
    ("父", "아버지", "일반"), ("南", "남한", "나라"), ("詩", "시", "일반"),
    ("家", "집안", "일반"), ("大", "대", "일반"), ("印", "인도", "나라"),
    ("阿", "아프리카", "나라"), ("故", "고", "일반"), ("州", "주", "나라"),
    ("重", "중공업", "경제"),
)

# Replacement characters for the "replace" mode of Hangul drop-out (J2):
# digits, upper and lower ASCII letters (a rule), then this fixed list.
NOISE_SPECIALS = (
    "…", ".", "·", "%", '"', "-", "(", "|", "?", ",", "}", ":", "&", "_", "{",
    "~", "#", "\\", "*", ")", "$", "=", "+", "`", ";", "'", "!", "@", "<", "/",
    ">", "[", "]", "^", "↑", "∼", "↓", "→", "㎜", "＋", "ㆍ", "㎞", "㎡", "ｍ",
    "②", "％", "㎝", "↔", "⅔", "㎏", "④", "③",
)

# Answer markers of model output (C10–C12) and the sentinel of D5.
ANSWER_MARKER = "복원된 제목:"
ANSWER_PREFIX = "답변:"
TITLE_MARKER = "새로운 제목:"
MISSING_TITLE = "missing title"

# Rule thresholds.
RATIO_THRESHOLD = (8995, 100000)   # round(r, 4) >= .09  <=>  r >= .08995
LOWER_THRESHOLD = (1, 10)          # lower-case ratio >= .1
V2_MIN_TOKENS = 6                  # alpha + punct + number tokens in the text
FREQUENT_MIN_COUNT = 100           # a special character is "frequent" from here
BUCKET_LOW = (1, 20)               # ratio <= .05
BUCKET_NORM = (1, 5)               # ratio <= .2
BUCKET_HIGH_LEGACY = (3, 10)       # one page starts "high" above .3

STAGES = ("morph_v1", "morph_v2", "sandwich", "ratio", "consecutive", "special", "not_noise")

# ---------------------------------------------------------------------------
# Named character-ratio profiles (B1a–B1f): the class of characters counted.
# ---------------------------------------------------------------------------

PROFILES = {
    "special_ko": f"[^a-zA-Z0-9{WS}{JAMO}{HANGUL}]",
    "special_ko_hanja": f"[^a-zA-Z0-9{WS}{JAMO}{HANGUL}{HANJA_BASIC}]",
    "upper_ko": f"[^A-Z0-9{HANGUL}{WS}]",
    "special_syllable": f"[^a-zA-Z{HANGUL}0-9{WS}]",
    "lower": "[a-z]",
    "letter": "[A-Za-z]",
    "hanja": f"[{HANJA_ALL}]",
    "hangul": f"[{HANGUL}]",
    # for Latin-script tables: accented Latin letters are not noise
    "special_latin": f"[^a-zA-Z0-9{WS}\\x{{C0}}-\\x{{24F}}]",
}


def profile(name_or_class: str) -> str:
    """A profile name or a literal regex class."""
    return PROFILES.get(name_or_class, name_or_class)


# Script-run tagger classes (B11): a word is cut into maximal runs of one class.
TAG_ALPHA = "[A-Za-z]"
TAG_NUMBER = "[0-9]"
# Punctuation is every non-space character outside the other three classes.
TAG_PUNCT = f"[^A-Za-z0-9{HANGUL}{JAMO}{WS}]"
TOKEN_RE = f"([A-Za-z]+|[0-9]+|[{HANGUL}{JAMO}]+|{TAG_PUNCT}+)"

# Hangulised view of Latin tables (test mapping only): these 20 letters map to
# the syllables U+AC00 + 196*k, k = 0..19 (a rule, not a table).
HANGULISE_FROM = "aeionrstludhcmbfgpyw"
HANGULISE_TO = "".join(chr(0xAC00 + 196 * k) for k in range(len(HANGULISE_FROM)))


# ---------------------------------------------------------------------------
# The same profiles as code-point ranges, for counting with ``translate``
# (a per-character hash lookup in the JVM instead of a regex class test).
# (negated, ranges): a negated profile counts characters outside the ranges.
# ---------------------------------------------------------------------------

WS_RANGES = [(0x20, 0x20), (0x09, 0x0D), (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
             (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
_LOWER, _UPPER, _DIGIT = (0x61, 0x7A), (0x41, 0x5A), (0x30, 0x39)
_HANGUL_R, _JAMO_R = (0xAC00, 0xD7A3), (0x3131, 0x3163)
RANGES = {
    "special_ko": (True, [_LOWER, _UPPER, _DIGIT, *WS_RANGES, _JAMO_R, _HANGUL_R]),
    "special_ko_hanja": (True, [_LOWER, _UPPER, _DIGIT, *WS_RANGES, _JAMO_R, _HANGUL_R, (0x4E00, 0x9FA5)]),
    "upper_ko": (True, [_UPPER, _DIGIT, _HANGUL_R, *WS_RANGES]),
    "special_syllable": (True, [_LOWER, _UPPER, _HANGUL_R, _DIGIT, *WS_RANGES]),
    "special_latin": (True, [_LOWER, _UPPER, _DIGIT, *WS_RANGES, (0xC0, 0x24F)]),
    "hanja": (False, [(0x4E00, 0x9FFF)]),
    "hangul": (False, [_HANGUL_R]),
}


def range_chars(ranges) -> str:
    return "".join(chr(c) for lo, hi in ranges for c in range(lo, hi + 1))
