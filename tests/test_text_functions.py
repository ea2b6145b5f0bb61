"""Column functions on hand-made edge cases (FIXTURES §3)."""

from pyspark.sql import functions as F

from tidyline.functions import text as T


def one(spark, col, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("x")).first()["x"]


def test_words_match_python_split(spark):
    samples = ["a  b", " lead", "trail\n", "nb sp", "ideo　space", "v\x0btab", "fs\x1csep",
               "", "   ", "one"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r["w"] for r in df.select(T.words("t").alias("w")).collect()]
    assert got == [s.split() for s in samples]
    counts = [r["n"] for r in df.select(T.word_count("t").alias("n")).collect()]
    assert counts == [len(s.split()) for s in samples]


def test_collapse_ws_and_strip(spark):
    for s in ["  a \n b　c ", "x", "", " y "]:
        assert one(spark, T.collapse_ws("t"), s) == " ".join(s.split())
        assert one(spark, T.py_strip("t"), s) == s.strip()


def test_char_ratio_and_bucket_edges(spark):
    # 1 special in 20 chars = .05 -> low; 4 in 20 = .2 -> norm; 5 in 20 -> high
    rows = [("#" + "a" * 19,), ("####" + "a" * 16,), ("#####" + "a" * 15,), ("",)]
    df = spark.createDataFrame(rows, "t string").select(
        T.noise_bucket(T.class_count("t", "special_ko"), T.text_length("t")).alias("b"),
        T.char_ratio("t", "special_ko").alias("r"))
    assert [r["b"] for r in df.collect()] == ["low", "norm", "high", "low"]
    assert [r["r"] for r in df.collect()][3] == 0.0


def test_class_borders(spark):
    # Hanja 4E00..9FA5 allowed by special_ko_hanja, 9FA6 not; Hangul 가..힣
    cases = {"䷿": 1, "一": 0, "龥": 0, "龦": 1, "꯿": 1, "가": 0, "힣": 0, "힤": 1}
    for ch, n in cases.items():
        assert one(spark, T.class_count("t", "special_ko_hanja"), ch) == n, hex(ord(ch))


def test_strip_tags(spark):
    assert one(spark, T.strip_tags("t"), "게시판 행사 종합") == " 행사 "
    assert one(spark, T.strip_tags("t"), "종합 기사 3보") == " 기사 "
    assert one(spark, T.strip_tags("t"), "기사 종합2보") == "기사 "
    assert one(spark, T.strip_tags("t"), "기사 종합\n") == "기사 \n"
    assert one(spark, T.strip_tags("t", legacy=True), "기사 3보") == "기사 3보"
    assert one(spark, T.strip_tags("t"), "종합") == ""


def test_remove_special_and_trend_marks(spark):
    assert one(spark, T.remove_special("t"), "a!b#c\\d[e]") == "abcde"
    assert one(spark, T.remove_trend_marks("t"), "값…상승 3%↑ 끝...") == "값 상승 3 끝"


def test_annotate(spark):
    assert one(spark, T.annotate("t"), "美 대통령 北") == "美(미국) 대통령 北(북한)"
    assert one(spark, T.annotate("t"), "plain") == "plain"


def test_answers(spark):
    s = "답변 앞\n복원된 제목: 첫 제목\n복원된 제목:  답변: 둘째 제목 \n다음 줄"
    assert one(spark, T.extract_answer("t"), s) == "둘째 제목 \n다음 줄"
    assert one(spark, T.extract_answer_line("t"), s) == "둘째 제목"
    assert one(spark, T.extract_answer("t"), "  표시 없음 ") == "표시 없음"
    assert one(spark, T.extract_answer_line("t"), "복원된 제목:") == ""


def test_parse_synonyms(spark):
    assert one(spark, T.parse_synonyms("t"), "동의어:  가, 나 ,, 다\n라: 마") == ["가", "나", "다"]
    assert one(spark, T.parse_synonyms("t"), "콜론 없음") == []


def test_clean_title(spark):
    assert one(spark, T.clean_title("t"), '"새 제목 이 제목은 좋습니다"') == "새 제목"


def test_softmax_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "z array<double>")
    r = df.select(T.softmax("z").alias("p"), T.argmax("z").alias("a")).first()
    assert abs(sum(r["p"]) - 1) < 1e-12 and r["a"] == 1


def test_parse_vector(spark):
    assert one(spark, T.parse_vector("t"), "[0.5  1.5 -2]") == [0.5, 1.5, -2.0]


def test_first_of_lines(spark):
    assert one(spark, T.first_of_lines("t"), "a\r\nb") == "a"
    assert one(spark, T.first_of_lines("t"), "") == ""
    assert one(spark, F.length(T.first_of_lines("t")), "x y") == 1


def test_drop_latin_tokens_equals_tag_form(spark):
    samples = ["한국MS 윈도10 IoT 에디션", "ab 가", "  x1y 나-다 ", "", "가a.b1나"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    r = df.select(T.drop_latin_tokens("t").alias("a"), T.keep_tags(T.tag_words(T.words("t"))).alias("b")).collect()
    assert all(x["a"] == x["b"] for x in r)
