"""Guards before the steps of a title's form change no result."""

import random

from pyspark.sql import functions as F

from biblioforge.functions import text as T

BITS = ["edi", "tion", "Edition", "2nd", "3", "e", "5e", " ", "  ", "\t", "\u3000", "\u00a0", ",", " ed.", "ed", "ﬁrst", "first edition", "new", "第二版", "【新版】", "[x版]", "改訂", "十", "（", "】", "＆", "&", "：", ":", "`", "・", "、", "－", "Ａ", "ſecond edition", "İ", "–", "x"]


def plain(c):
    """Every step on every text, one after the other."""
    out = F.translate(F.translate(F.col(c), T.FULL_WIDTH, T.HALF_WIDTH), T.CJK_BRACKETS, T.ASCII_BRACKETS)
    out = F.replace(F.translate(out, T.KANJI_DIGITS, T.ARABIC_DIGITS), F.lit("十"), F.lit("10"))
    for p in T.EDITION_PHRASES:
        out = F.regexp_replace(out, "(?iU)" + p, "")
    out = F.translate(F.regexp_replace(F.lower(out), "[‐‑‒–—―−]", "-"), "「」『』`．，、。", "\"\"\"\"'.,,.")
    out = F.translate(F.regexp_replace(out, r"(?U)\s*&\s*", " and "), "・：；･", "    ")
    out = F.regexp_replace(out, r"(?U)\s*:\s*", ": ")
    return F.regexp_replace(F.regexp_replace(out, r"(?U)\s+", " "), "^ | $", "")


def test_guards_cover_the_phrases_in_their_order_and_change_nothing(spark):
    assert [p for _, phrases in T.EDITION_GROUPS for p in phrases] == T.EDITION_PHRASES
    r = random.Random(19)
    texts = ["edi2nd ed.tion 4", "edi 2nd editiontion 7", "", *["".join(r.choice(BITS) for _ in range(r.randint(1, 14))) for _ in range(4000)]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select("t", T.normalize_title("t", compose=False).alias("a"), plain("t").alias("b")).where("a <> b or a is null").collect() == []
