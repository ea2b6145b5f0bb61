"""The detection cascade on the named rows of FIXTURES §2 and invariants."""

import random

from pyspark.sql import functions as F

from tidyline.functions import text as T
from tidyline.operators import detect as D

NAMED = [
    ("00858", 5, "한국MS 윈도10 IoT 에디션 출시…B2B 공략", "morph_v1"),
    ("01717", 6, "中 베이징서 H7N9 조류인플루엔자 환자 또 발생", "morph_v1"),
    ("00982", 4, "회전 카메라 탑재한 갤럭시A80 SKT 단독출시…59만9천500원", "morph_v2"),
    ("01178", 1, "통신3사 5G 가입자 경쟁 불붙었다…LG V50 지원금 최대 77만원", "morph_v2"),
    ("01225", 5, "세계 첫 5G폰 갤럭시S10 5G 출고가 139만7천원 확정종합", "morph_v2"),
    ("01776", 5, "LGU 5G SA 상용화 준비…SA 기술 NSA 코어 장비에 연동 검증", "morph_v2"),
    ("01873", 3, "LG전자 스마트폰사업 10분기 적자…3Q 영업손실 3천753억종합", "morph_v2"),
    ("00191", 4, "MLB.com 다저스 3년 연속 WS 유력하지만 우승은 글쎄…", "ratio"),
    ("00741", 6, "게시판 SKT AI 콘퍼런스 ai.x 2019 개최", "ratio"),
    ("02249", 0, "클린턴재단 후폭풍인가…힐러리 vs 트럼프 지지율 3%p로 좁혀져", "ratio"),
    ("02399", 2, "재단법인화 tbs 초대 대표에 이강택 현 교통방송 대표", "ratio"),
    ("x1", 0, "올해 첫 황사…내일 밤부터 일요일까지 전국에 영향", "not_noise"),
    ("x2", 0, "rR=드러 앞 신태h!t'x^G@리포트<# f^-", "morph_v1"),
]


def frozen(spark, chars="….·%"):
    return spark.createDataFrame([(chars,)], "chars string")


def test_named_rows(spark):
    df = spark.createDataFrame([(i, t, x) for i, t, x, _ in NAMED], "ID string, target int, text string")
    out = D.detect_noise(df, "text", frequent=frozen(spark))
    got = {r["ID"]: r["stage"] for r in out.collect()}
    assert got == {i: s for i, _, _, s in NAMED}


def test_stages_partition_rows(spark):
    df = spark.createDataFrame([(i, t) for i, _, t, _ in NAMED] + [("n", None), ("e", "")], "ID string, text string")
    out = D.detect_noise(df, "text", frequent=frozen(spark))
    assert out.count() == df.count()
    assert set(r["stage"] for r in out.collect()) <= set(D.P.STAGES)
    assert {r["ID"]: r["stage"] for r in out.filter(F.col("ID").isin("n", "e")).collect()} == \
        {"n": "not_noise", "e": "not_noise"}


def test_regex_rules_equal_tag_rules(spark):
    rnd = random.Random(3)
    alphabet = "aZ9#가힣ㄱ.- \n%"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("tags", T.tag_words(T.words("t")))
    r = df.select(
        (T.tag_rule_v1("tags") == T.tag_rule_v1_text("t")).alias("v1"),
        (T.tag_rule_v1("tags") == F.col("t").rlike(T.V1_RE)).alias("v1re"),
        (T.tag_rule_v2("tags") == T.tag_rule_v2_text("t")).alias("v2"),
        (T.has_sandwich(T.words("t")) == T.has_sandwich_text("t")).alias("sw"))
    assert r.filter(~(F.col("v1") & F.col("v1re") & F.col("v2") & F.col("sw"))).count() == 0


def test_frequent_set_is_one_row(spark):
    df = spark.createDataFrame([("a…b…",)] * 60, "text string")
    f = D.frequent_specials(df, "text", min_count=100)
    rows = f.collect()
    assert len(rows) == 1 and rows[0]["chars"] == "…"


def test_streaming_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, _, t, _ in NAMED], "ID string, text string")
    src = str(tmp_path / "src")
    df.write.parquet(src)
    fz = frozen(spark)
    batch = {r["ID"]: r["stage"] for r in D.detect_noise(df, "text", frequent=fz).collect()}
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (D.detect_noise(stream, "text", frequent=fz).select("ID", "stage").writeStream
         .format("memory").queryName("cascade_stream").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r["ID"]: r["stage"] for r in spark.sql("SELECT * FROM cascade_stream").collect()}
    assert got == batch


def test_control_char_stays_punctuation(spark):
    df = spark.createDataFrame([("가\x01\x01나",), ("a\x01b\x01c",)], "t string").withColumn(
        "tags", T.tag_words(T.words("t")))
    r = df.select((T.tag_rule_v1("tags") == T.tag_rule_v1_text("t")).alias("v1"),
                  (T.tag_rule_v2("tags") == T.tag_rule_v2_text("t")).alias("v2")).collect()
    assert all(x["v1"] and x["v2"] for x in r)
