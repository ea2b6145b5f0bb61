"""Confident learning against a brute-force implementation; augmentation invariants."""

import random

from pyspark.sql import functions as F


from tidyline.operators import augment as A
from tidyline.operators import relabel as RL


def brute_force_issues(rows):
    """§2.12 written plainly in Python over (id, given, probs)."""
    K = len(rows[0][2])
    t = {}
    for k in range(K):
        vals = [p[k] for _, g, p in rows if g == k]
        t[k] = sum(vals) / len(vals) if vals else None
    joint, n_i = {}, {}
    for i, g, p in rows:
        n_i[g] = n_i.get(g, 0) + 1
        conf = [k for k in range(K) if t[k] is not None and p[k] >= t[k] - 1e-6]
        if not conf:
            continue
        best = max(p[k] for k in conf)
        j = min(k for k in conf if p[k] == best)
        joint[(g, j)] = joint.get((g, j), 0) + 1
    cands = set()
    for g in n_i:
        rowsum = sum(v for (a, _), v in joint.items() if a == g)
        if joint.get((g, g), 0) < 1:
            rowsum += 1
        for (a, j), v in joint.items():
            if a != g or j == g:
                continue
            quota = (2 * v * n_i[g] + rowsum) // (2 * rowsum)
            ranked = sorted([r for r in rows if r[1] == g], key=lambda r: (-(r[2][j] - r[2][g]), r[0]))
            cands |= {r[0] for r in ranked[:quota]}
    out = set()
    for i, g, p in rows:
        if i in cands and p.index(max(p)) != g:
            out.add(i)
    return out


def test_find_label_issues_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        g = rnd.randrange(4)
        z = [rnd.gauss(0, 1) + (2.0 if k == g else 0.0) for k in range(4)]
        if rnd.random() < 0.15:
            z[(g + 1) % 4] += 3
        m = max(z)
        e = [2.718281828 ** (x - m) for x in z]
        s = sum(e)
        rows.append((i, g, [round(x / s, 9) for x in e]))
    df = spark.createDataFrame(rows, "id long, g int, p array<double>")
    got = {r["id"] for r in RL.find_label_issues(df, "id", "g", "p").collect()}
    assert got == brute_force_issues(rows)
    relab = RL.apply_relabel(df, RL.find_label_issues(df, "id", "g", "p"), "id", "g", "p")
    assert relab.filter(F.col("new_label") != F.col("g")).count() == len(got)


def test_inject_noise_keeps_length_and_is_seeded(spark):
    df = spark.createDataFrame([(i, "뉴스 제목 예시 " * (i % 5 + 1)) for i in range(50)], "id long, t string")
    a = df.select("id", "t", A.inject_noise("t", "id", 1).alias("n"))
    assert a.filter(F.length("t") != F.length("n")).count() == 0
    b = df.repartition(3).select("id", A.inject_noise("t", "id", 1).alias("n"))
    assert a.select("id", "n").exceptAll(b).count() == 0
    changed = a.select(F.sum(F.length("t")).alias("all"),
                       F.sum(F.size(F.filter(F.arrays_zip(F.split("t", ""), F.split("n", "")),
                                             lambda z: z["0"] != z["1"]))).alias("chg")).first()
    assert 0.4 < changed["chg"] / changed["all"] < 0.6


def test_drop_class_counts(spark):
    rows = [(1, "abc"), (2, "a가b"), (3, "가나다라마바사아자차")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r["id"]: r["n"] for r in df.select("id", A.drop_class("t", "id", 7).alias("n")).collect()}
    assert got[1] == "abc"
    assert got[2] == "ab"
    assert len(got[3]) == 8  # floor(10 * .2) = 2 dropped
    rep = df.select(A.drop_class("t", "id", 7, mode="replace").alias("n"), "t")
    assert rep.filter(F.length("n") != F.length("t")).count() == 0


def test_mix_halves_stays_in_label(spark):
    rows = [(i, f"w{i} x{i} y{i} z{i}", i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, text string, lab int")
    m = A.mix_halves(df, "id", "text", "lab", 20, 5)
    assert m.count() == 60
    for r in m.collect():
        a, b = r["text"].split(" ")[0], r["text"].split(" ")[-1]
        assert int(a[1:]) % 3 == r["lab"] and int(b[1:]) % 3 == r["lab"]
        assert r["id"].startswith(f"aug_{r['lab']}_")


def test_few_shot_distinct_examples(spark):
    pool = spark.createDataFrame([(i, f"clean {i}", i % 2) for i in range(10)], "id long, text string, lab int")
    tg = spark.createDataFrame([(100 + i, i % 2) for i in range(20)], "id long, lab int")
    out = A.few_shot(tg, pool, "id", "text", "lab", 17)
    for r in out.collect():
        origs = [line.split(": ", 1)[1] for line in r["examples"].split("\n") if line.startswith("복원된 제목:")]
        assert len(origs) == 3 and len(set(origs)) == 3
        assert all(int(o.split()[1]) % 2 == r["lab"] for o in origs)


def test_replace_synonyms(spark):
    df = spark.createDataFrame([(i, "apple pie and apple tart") for i in range(40)], "id long, t string")
    syn = spark.createDataFrame([("apple", ["pear", "plum"])], "word string, synonyms array<string>")
    out = A.replace_synonyms(df, "id", "t", syn, 13).collect()
    words = [w for r in out for w in r["t"].split()]
    assert set(words) <= {"apple", "pie", "and", "tart", "pear", "plum"}
    assert any(w in ("pear", "plum") for w in words) and len(words) == 200
    assert A.with_augmented(df, "id", "t", syn, 13).count() == 80


def test_vectorized_kernels_equal_native(spark):
    from tidyline.operators.charnoise import drop_class_vectorized, inject_noise_vectorized
    rows = [(i, ("가나 다라 abc 마바사아 " * (i % 4 + 1)) if i % 7 else "") for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    out = df.select(
        (A.inject_noise("t", "id", 3).eqNullSafe(inject_noise_vectorized("t", "id", 3))).alias("j1"),
        (A.drop_class("t", "id", 4).eqNullSafe(drop_class_vectorized("t", "id", 4))).alias("j2"),
        (A.drop_class("t", "id", 4, mode="replace").eqNullSafe(
            drop_class_vectorized("t", "id", 4, mode="replace"))).alias("j2r"))
    assert out.filter(~(F.col("j1") & F.col("j2") & F.col("j2r"))).count() == 0


def test_many_classes_give_rows_for_quotas_only(spark):
    """1,000 classes: the margins hold a row per quota of the row's label, and the issues are the brute-force ones."""
    rnd, k, n = random.Random(6), 1000, 1200
    rows = []
    for i in range(n):
        g = rnd.randrange(k)
        p = [0.0] * k
        for j in rnd.sample(range(k), 6):
            p[j] = round(rnd.random() * 0.1, 9)
        p[g if rnd.random() < 0.7 else (g + 1) % k] = 0.5
        rows.append((i, g, p))
    df = spark.createDataFrame(rows, "id long, g int, p array<double>")
    guessed = RL.with_confident_guess(df, "g", "p")
    n_quotas = RL.prune_quotas(guessed, "g").count()
    assert 0 < RL.quota_margins(guessed, "id", "g", "p").count() <= n * 20 < n * k and n_quotas > 100
    assert {r["id"] for r in RL.find_label_issues(df, "id", "g", "p").collect()} == brute_force_issues(rows)


def test_centroid_scores_do_not_depend_on_the_order_of_rows(spark):
    rnd = random.Random(7)
    rows = [(i, i % 3, i % 2, [rnd.gauss(0, 1e3) if rnd.random() < 0.5 else rnd.gauss(0, 1e-3) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g int, fold int, v array<double>")
    a, b = (sorted(map(str, RL.centroid_oof_probs(d, "id", "v", "g", "fold", 2, 1e6).collect())) for d in (df.repartition(1), df.repartition(9, "v")))
    assert a == b
