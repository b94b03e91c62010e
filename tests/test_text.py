import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biblioforge.functions import text as T


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "x string").select(build("x").alias("y")).first().y


def test_title_variants_meet(spark):
    pairs = [("Ｒｉｓｋ　Ｍａｎａｇｅｍｅｎｔ", "risk management"), ("Risk Management, 3rd Edition", "risk management"), ("Banks & Markets", "banks and markets"), ("銀行論　第三版", "銀行論"), ("保険・年金", "保険 年金")]
    for a, b in pairs:
        assert one(spark, a, T.normalize_title) == b


def test_aggressive_form_drops_article_subtitle_and_spaces(spark):
    assert one(spark, "The Big Book: A Story (2nd ed.)", lambda c: T.normalize_title(c, True)) == "bigbook"
    assert one(spark, None, T.normalize_title) == ""


def test_kanji_ten_is_a_plain_substitution(spark):
    assert one(spark, "十二", T.fold_kanji_digits) == "102"


def test_isbn(spark):
    assert one(spark, "978-4-12345678-9", T.clean_isbn) == "9784123456789"
    assert one(spark, "123456789x", T.clean_isbn) is None
    assert one(spark, "123456789x", lambda c: T.clean_isbn(c, True)) == "123456789X"
    assert one(spark, "12345", T.clean_isbn) is None


def test_price_and_edition(spark):
    assert tuple(one(spark, "list $ 1,234.50", T.parse_price)) == (1234.5, "USD")
    assert tuple(one(spark, "3,000円", T.parse_price)) == (3000.0, "JPY")
    assert tuple(one(spark, "free", T.parse_price)) == (None, None)
    assert tuple(one(spark, "Money, 4th Edition", T.parse_edition)) == ("Money", 4, "4th Edition")
    assert tuple(one(spark, "Money", T.parse_edition)) == ("Money", 1, None)


def test_authors_and_formats(spark):
    assert one(spark, "By A One, and B Two; C & D", T.split_authors) == ["A One", "B Two", "C", "D"]
    assert one(spark, "Dr. A-B O'Neil, PhD", T.normalize_author) == "aboneil"
    assert one(spark, "E-Book (PDF)", T.format_of_text) == "ebook"


def test_reply_json(spark):
    assert one(spark, 'x\n```json\n{"a": 1}\n```', T.reply_json) == '{"a": 1}'
    assert one(spark, 'so {"a": 1} it is', T.reply_json) == '{"a": 1}'
    assert one(spark, "nothing", T.reply_json) is None


def test_ngrams(spark):
    assert one(spark, "abcd", T.ngrams) == ["abc", "bcd"]
    assert one(spark, "ab", T.ngrams) == ["ab"]
    assert one(spark, "", T.ngrams) == []


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30))
def test_nfkc_is_the_standard_one(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", T.nfkc(F.col("x")).alias("y")).collect()
    assert all(r.y == unicodedata.normalize("NFKC", r.x) for r in rows)
