"""Augmentation (J1–J6): noise injection, Hangul drop-out, same-label half
mixing, few-shot blocks and synonym replacement.

Every random choice is a hash draw of (key, position, seed), so the output
does not depend on partitioning or task retries.  Per-character work stays in
native higher-order functions over one row's character array."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyline.functions import profiles as P
from tidyline.functions import text as T
from tidyline.functions.draws import hash32, hash32_of, key_string, position_draw
from tidyline.operators.split import label_rank
from tidyline.operators.wordswap import swapped_words
from tidyline.session import sized

HANJA_LO, HANJA_HI = 0x4E00, 0x9FFF
ASCII_LO, ASCII_HI = 33, 126


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (higher-order function
    arguments are not shared between lambda calls otherwise)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def threshold(p: float) -> int:
    """A 32-bit draw h is "below p" when h < threshold(p) (u = h / 2**32 < p)."""
    return int(math.ceil(p * 4294967296))


def code_point_char(cp: Column) -> Column:
    """The BMP character of a code point (``chr`` in Spark wraps at 256)."""
    return F.decode(F.unhex(F.lpad(F.hex(cp), 4, "0")), "UTF-16BE")


def row_seed(key, seed: int, slot: int = 0) -> Column:
    """32-bit seed of a row: slot ``slot`` of md5("key:seed")."""
    k = T.col(key) if isinstance(key, str) else key
    return hash32_of(F.concat_ws(":", k.cast("string"), F.lit(str(seed))), slot)


def inject_noise(text, key, seed: int, level: float = 0.5, ascii_ratio: float = 0.93) -> Column:
    """Each character replaced with probability ``level``; a replacement is
    printable ASCII 33–126 with probability ``ascii_ratio``, else a Hanja
    U+4E00–9FFF.  Three row seeds (one md5 per row) and an integer mix per
    character give the three draws."""
    t = T.col(text)
    seeds = F.struct(*[row_seed(key, seed, s).alias(f"s{s}") for s in range(3)])

    def body(sd):
        def pick(c, i):
            h0, h1, h2 = (position_draw(sd[f"s{s}"], i) for s in range(3))
            asc = code_point_char(F.lit(ASCII_LO) + h2 % (ASCII_HI - ASCII_LO + 1))
            han = code_point_char(F.lit(HANJA_LO) + h2 % (HANJA_HI - HANJA_LO + 1))
            return F.when(h0 < threshold(level), F.when(h1 < threshold(ascii_ratio), asc).otherwise(han)).otherwise(c)
        return F.array_join(F.transform(F.split(t, ""), pick), "")
    return F.when(F.length(t) == 0, t).otherwise(let(seeds, body))


def replacement_chars() -> list[str]:
    """J2 replace mode: digits, upper and lower ASCII letters, then the fixed list."""
    return ([chr(c) for c in range(48, 58)] + [chr(c) for c in range(65, 91)]
            + [chr(c) for c in range(97, 123)] + list(P.NOISE_SPECIALS))


def drop_class(text, key, seed: int, cls: str = "hangul", frac: tuple[int, int] = (2, 10),
               mode: str = "drop") -> Column:
    """Of the n characters of a class, max(1, floor(n*frac)) chosen by draw
    are deleted (``mode='drop'``) or replaced by a drawn character
    (``mode='replace'``); text without such characters is unchanged."""
    t = T.col(text)
    cls_re = "^" + P.profile(cls) + "$"
    chars = F.split(t, "")
    tagged = let(row_seed(key, seed), lambda sd: F.transform(chars, lambda c, i: F.struct(
        position_draw(sd, i).alias("h"), i.alias("i"), c.alias("c"))))
    if mode == "drop":
        repl = lambda s: F.lit("")
    else:
        pool = F.array(*[F.lit(c) for c in replacement_chars()])
        repl = lambda s: F.element_at(pool, (s["h"] % len(replacement_chars()) + 1).cast("int"))

    def body(x):
        # x binds (tagged, hits) once; cut is the m-th smallest (draw,
        # position) among the hits, and a hit is chosen when it sorts at or
        # before it, so no per-character search of a chosen list is needed
        n = F.size(x["hits"])
        m = F.greatest(F.lit(1), F.floor(n * frac[0] / frac[1]).cast("int"))
        return let(F.try_element_at(F.array_sort(x["hits"]), m), lambda cut: F.when(n == 0, t).otherwise(
            F.array_join(F.transform(x["tagged"], lambda s: F.when(
                s["c"].rlike(cls_re) & ((s["h"] < cut["h"]) | ((s["h"] == cut["h"]) & (s["i"] <= cut["i"]))),
                repl(s)).otherwise(s["c"])), "")))
    bound = let(tagged, lambda tg: F.struct(tg.alias("tagged"), F.filter(tg, lambda s: s["c"].rlike(cls_re)).alias("hits")))
    out = let(bound, body)
    return out


def noised_pairs(df: DataFrame, key: str, text: str, seed: int, mode: str = "drop") -> DataFrame:
    """(key, text, noised_text) training pairs."""
    return df.select(key, text, drop_class(text, key, seed, mode=mode).alias("noised_text"))


def mix_halves(df: DataFrame, key: str, text: str, label: str, n: int, seed: int,
               reverse: bool = False, prefix: str | None = None) -> DataFrame:
    """Per label, n draws with replacement of two rows a, b of that
    label; text = first half of a's words + second half of b's words (halves
    by len//2), or the reverse order.  Ids ``aug_{label}_{i}`` (``augr_`` for
    the reversed run).

    The pool is numbered per label exactly (:func:`label_rank`), the n*labels
    draws are a small generated table, and the two lookups are equi-joins on
    (label, number): no row of the pool meets another."""
    prefix = prefix or ("augr" if reverse else "aug")
    # rank keys only (no text moves through the ranking shuffles)
    # kept: the draw sizes and the lookup both read it (keys only, no text)
    ranked = sized(label_rank(df.select(key, label), key, label, seed).select(
        label, F.col("_rank").alias("_rn"), "_n", F.col(key).alias("_k")))
    sizes = ranked.groupBy(label).agg(F.max("_n").alias("_n"))
    draws = (sizes.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
                  .withColumn("_side", F.explode(F.array(F.lit("a"), F.lit("b"))))
                  .withColumn("_rn", hash32(label, "i", seed, F.col("_side")) % F.col("_n"))
                  .select(label, "i", "_side", "_rn"))
    # the draw table has 2 * n * labels rows: broadcast it (size checked) and
    # stream the pool; texts are fetched only for the drawn keys
    picked = ranked.join(sized(draws), [label, "_rn"]).select(label, "i", "_side", "_k")
    texts = df.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(
        sized(picked.select("_k").distinct()), "_k")
    pairs = (picked.join(texts, "_k").groupBy(label, "i")
                   .agg(F.max(F.when(F.col("_side") == "a", F.col("_t"))).alias("_ta"),
                        F.max(F.when(F.col("_side") == "b", F.col("_t"))).alias("_tb")))
    wa, wb = T.words("_ta"), T.words("_tb")
    first = F.array_join(F.slice(wa, 1, F.floor(F.size(wa) / 2).cast("int")), " ")
    half_b = F.floor(F.size(wb) / 2).cast("int")
    second = F.array_join(F.slice(wb, half_b + 1, F.size(wb) - half_b), " ")
    body = F.concat_ws(" ", second, first) if reverse else F.concat_ws(" ", first, second)
    return pairs.select(T.format_id(f"{prefix}_%s_%d", F.col(label).cast("string"), F.col("i")).alias(key),
                        body.alias(text), F.col(label))


def distinct_picks(h: list[Column], size: Column) -> list[Column]:
    """k distinct indices in [0, size) from k draws (sequential sampling
    without replacement: draw j is in [0, size-j) and skips earlier picks)."""
    picks: list[Column] = []
    for j, hj in enumerate(h):
        x = F.when(size > j, hj % (size - j))
        if picks:
            # shift past every earlier pick at or below x, in ascending order
            srt = F.array_sort(F.array(*picks))
            x = F.aggregate(srt, x, lambda acc, c: F.when(acc >= c, acc + 1).otherwise(acc))
        picks.append(F.when(size > j, x))
    return picks


def few_shot(targets: DataFrame, pool: DataFrame, key: str, text: str, label: str, seed: int,
             k: int = 3, level: float = 0.5, ascii_ratio: float = 0.93) -> DataFrame:
    """For each target row, k distinct random pool rows of its label, each
    noised by J1 and rendered as an input / restored pair.  Adds ``examples``."""
    numbered = sized(label_rank(pool.select(key, label), key, label, seed))
    sizes = numbered.groupBy(label).agg(F.max("_n").alias("_n"))
    t = targets.select(key, label).join(sized(sizes), label, "left")
    h = [hash32(key, j, seed, F.lit("shot")) for j in range(k)]
    picks = distinct_picks(h, F.col("_n"))
    t = t.withColumn("_p", F.array(*[F.struct(F.lit(j).alias("j"), p.alias("rn")) for j, p in enumerate(picks)]))
    ex = t.select(key, label, F.explode("_p").alias("_s")).filter(F.col("_s.rn").isNotNull()) \
          .select(key, label, F.col("_s.j").alias("_j"), F.col("_s.rn").alias("_rank"))
    pj = numbered.select(label, "_rank", F.col(key).alias("_pk"))
    ex = ex.join(pj, [label, "_rank"])
    ex = ex.join(pool.select(F.col(key).alias("_pk"), F.col(text).alias("_orig")), "_pk")
    ex = ex.withColumn("_noisy", inject_noise("_orig", key_string(key, "_j"), seed, level, ascii_ratio))
    ex = ex.withColumn("_pair", F.concat(F.lit("입력된 제목: "), F.col("_noisy"), F.lit("\n복원된 제목: "),
                                         F.col("_orig"), F.lit("\n\n")))
    blocks = ex.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_j", "_pair"))).alias("_ps"))
    blocks = blocks.select(key, F.concat(F.lit("예시: \n"),
                                         F.array_join(F.transform("_ps", lambda s: s["_pair"]), "")).alias("examples"))
    return targets.join(blocks, key, "left").withColumn(
        "examples", F.coalesce(F.col("examples"), F.lit("예시: \n")))


def synonym_table(answers: DataFrame, word: str, answer: str, order: list[str]) -> DataFrame:
    """(word, synonyms) from model answers parsed by C14; one row per word
    (the first answer in ``order`` wins)."""
    a = answers.filter(T.has_synonyms(answer)).groupBy(word).agg(F.min_by(answer, F.struct(*order)).alias("_answer"))
    return a.select(word, T.parse_synonyms("_answer").alias("synonyms"))


def replace_synonyms(df: DataFrame, key: str, text: str, synonyms: DataFrame, seed: int,
                     ratio: float = 0.3) -> DataFrame:
    """Each word with probability ``ratio`` is replaced by one of its
    synonyms (drawn), if it has any; returns the changed text in ``text``.

    Words are rows while they are drawn and looked up (a lambda over a row's words
    would be interpreted); only the drawn ones are shuffled, with the row's second
    seed and the place in one long.  Replacements come back as one array per key,
    and a kernel puts the texts together."""
    split = df.filter(F.col(key).isNotNull()).select(
        key, row_seed(key, seed, 0).alias("_s0"), row_seed(key, seed, 1).alias("_s1"), T.words(text).alias("_w"))
    # outer: else Spark would add a filter that splits each text twice more; the draw drops the null places
    cand = (split.select(key, "_s0", "_s1", F.posexplode_outer("_w").alias("_pos", "_word"))
                 .filter(position_draw(F.col("_s0"), F.col("_pos")) < threshold(ratio))
                 .select(key, F.shiftleft("_s1", 32).bitwiseOR(F.col("_pos").cast("bigint")).alias("_at"), "_word"))
    syn = synonyms.select(F.col("word").alias("_word"), F.col("synonyms").alias("_syn"))
    # candidates are keyed by word, and frequent words are hot keys: broadcast
    # the synonym table when its checked size allows, so no word is shuffled
    # (beyond the limit the planner shuffles, and AQE splits skewed partitions)
    pos = F.col("_at").bitwiseAND(F.lit(0xFFFFFFFF))
    new = F.element_at("_syn", (position_draw(F.shiftrightunsigned("_at", 32), pos) % F.size("_syn") + 1).cast("int"))
    rep = cand.join(sized(syn), "_word").select(key, pos.cast("int").alias("_pos"), new.alias("_new"))
    found = rep.repartition(key).groupBy(key).agg(F.collect_list(F.struct("_pos", "_new")).alias("_r"))
    return df.join(found, key, "left").withColumn(text, swapped_words(text, "_r")).drop("_r")


def with_augmented(df: DataFrame, key: str, text: str, synonyms: DataFrame, seed: int,
                   ratio: float = 0.3) -> DataFrame:
    """J6 + K1: the original rows plus ``{key}_aug`` rows."""
    aug = replace_synonyms(df, key, text, synonyms, seed, ratio).withColumn(
        key, F.concat(F.col(key).cast("string"), F.lit("_aug")))
    orig = df.withColumn(key, F.col(key).cast("string"))
    return orig.unionByName(aug.select(*orig.columns))
