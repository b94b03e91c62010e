"""Scalar text operators as Column -> Column. All stay in JVM expressions but nfkc() and sequence_ratio()."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Characters and their folded forms.
FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
HALF_WIDTH = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
CJK_BRACKETS = "（）【】［］〔〕｛｝〈〉《》「」『』"
ASCII_BRACKETS = "()[][][]{}<><>\"\"\"\""
KANJI_DIGITS = "一二三四五六七八九〇零"
ARABIC_DIGITS = "12345678900"
# Edition phrases, in the order in which they are removed.
EDITION_PHRASES = [
    r",?\s*(\d+)(st|nd|rd|th)\s+edition",
    r",?\s*(\d+)(st|nd|rd|th)\s+ed\.?",
    r",?\s*edition\s+(\d+)",
    r",?\s*(\d+)e\b",
    r",?\s*first\s+edition",
    r",?\s*second\s+edition",
    r",?\s*third\s+edition",
    r",?\s*fourth\s+edition",
    r",?\s*fifth\s+edition",
    r",?\s*revised\s+edition",
    r",?\s*updated\s+edition",
    r",?\s*new\s+edition",
    r",?\s*第\s*[0-9０-９一二三四五六七八九十]+\s*版",
    r",?\s*改訂\s*[0-9０-９一二三四五六七八九十]*\s*版",
    r",?\s*新版",
    r",?\s*増補\s*版",
    r",?\s*改訂新版",
    r"【[^】]*版[^】]*】",
    r"\[[^\]]*版[^\]]*\]",
]
# What a text must hold for a phrase to be in it, with the phrases of one guard that follow each other: one plain search in place of up to eight.
EDITION_GROUPS = [("edition", EDITION_PHRASES[:1]), (r"(st|nd|rd|th)\s+ed", EDITION_PHRASES[1:2]), ("edition", EDITION_PHRASES[2:3]), (r"\de\b", EDITION_PHRASES[3:4]), ("edition", EDITION_PHRASES[4:12]), ("版", EDITION_PHRASES[12:])]
# Subtitle separators in the order in which they are tried; leading articles; personal titles.
SUBTITLE_SEPARATORS = [": ", " : ", " - ", " – ", " — ", " | ", "／", " / "]
ARTICLES = ["the", "a", "an"]
PERSON_TITLES = "dr|prof|mr|ms|mrs|jr|sr|phd|md|cfa|cpa"
# Edition patterns of a title, first match wins; price patterns with their currency.
TITLE_EDITIONS = [r",?\s*(\d+)(?:st|nd|rd|th)\s+edition", r",?\s*(\d+)(?:st|nd|rd|th)\s+ed\.?", r",?\s*第(\d+)版", r",?\s*edition\s+(\d+)"]
PRICES = [
    (r"\$\s*([\d,]+\.?\d*)", "USD"),
    (r"¥\s*([\d,]+)", "JPY"),
    (r"€\s*([\d,]+\.?\d*)", "EUR"),
    (r"£\s*([\d,]+\.?\d*)", "GBP"),
    (r"([\d,]+\.?\d*)\s*USD", "USD"),
    (r"([\d,]+)\s*円", "JPY"),
]
# v1 formats, and words of free-text formats by priority.
FORMAT_CODES = {"print": "paperback", "ebook": "ebook", "hybrid": "bundle", "unknown": "other"}
FORMAT_WORDS = [
    ("hardcover", ["hardcover", "hardback"]),
    ("paperback", ["paperback", "softcover"]),
    ("ebook", ["ebook", "e-book", "digital"]),
    ("pdf", ["pdf"]),
    ("kindle", ["kindle"]),
    ("audiobook", ["audio"]),
    ("online_access", ["online"]),
    ("bundle", ["bundle", "+"]),
]

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition; Spark has no built-in for it."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two strings, as the standard library has it; for candidate pairs only."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def fold_width(c: C) -> Column:
    return _if_found("[\uff01-\uff5e\u3000]", col(c), lambda x: F.translate(x, FULL_WIDTH, HALF_WIDTH))


def fold_brackets(c: C) -> Column:
    return _if_found("[" + CJK_BRACKETS + "]", col(c), lambda x: F.translate(x, CJK_BRACKETS, ASCII_BRACKETS))


def fold_kanji_digits(c: C) -> Column:
    return _if_found("[" + KANJI_DIGITS + "十]", col(c), lambda x: F.replace(F.translate(x, KANJI_DIGITS, ARABIC_DIGITS), F.lit("十"), F.lit("10")))


def _if_found(guard: str, c: Column, body) -> Column:
    """body(c) where the guard matches, else c itself, which is computed once."""
    return F.transform(F.array(c), lambda x: F.when(x.rlike(guard), body(x)).otherwise(x))[0]


def drop_editions(c: C) -> Column:
    def without(phrases: list[str]):
        def body(x: Column) -> Column:
            for p in phrases:
                x = F.regexp_replace(x, "(?iU)" + p, "")
            return x

        return body

    out = col(c)
    for guard, phrases in EDITION_GROUPS:  # each is judged on what the one before left
        out = _if_found("(?iU)" + guard, out, without(phrases))
    return out


def fold_punctuation(c: C) -> Column:
    out = F.regexp_replace(col(c), "[‐‑‒–—―−]", "-")
    out = _if_found("[「」『』`．，、。]", out, lambda x: F.translate(x, "「」『』`．，、。", "\"\"\"\"'.,,."))
    out = _if_found("&", out, lambda x: F.regexp_replace(x, r"(?U)\s*&\s*", " and "))
    out = _if_found("[・：；･]", out, lambda x: F.translate(x, "・：；･", "    "))
    return _if_found(":", out, lambda x: F.regexp_replace(x, r"(?U)\s*:\s*", ": "))


def squeeze(c: C) -> Column:
    # Single plain spaces, nearly all of a text's, are no match and aren't written anew.
    return F.regexp_replace(F.regexp_replace(col(c), r"(?U)\s{2,}|[\s&&[^ ]]", " "), "^ | $", "")


def normalize_title(c: C, aggressive: bool = False, compose: bool = True) -> Column:
    """Comparable form of a title; null becomes ''. compose=False leaves NFKC out, for texts that are composed already."""
    out = F.coalesce(col(c), F.lit(""))
    out = nfkc(out) if compose else out
    out = squeeze(fold_punctuation(F.lower(drop_editions(fold_kanji_digits(fold_brackets(fold_width(out)))))))
    if not aggressive:
        return out
    for p in (r"\([^)]*\)", r"\[[^\]]*\]", "<[^>]*>"):
        out = F.regexp_replace(out, p, "")
    for a in ARTICLES:
        out = F.regexp_replace(out, f"^{a} ", "")
    cut = F.lit(None).cast("string")
    for s in reversed(SUBTITLE_SEPARATORS):
        cut = F.when(F.instr(out, s) > 0, F.substring_index(out, s, 1)).otherwise(cut)
    return F.regexp_replace(F.coalesce(cut, out), r"(?U)\s+", "")


def normalize_author(c: C, compose: bool = True) -> Column:
    out = nfkc(col(c)) if compose else col(c)
    out = F.lower(fold_width(out))
    out = F.regexp_replace(out, rf"(?iU)\b({PERSON_TITLES})\.?\b", "")
    return F.regexp_replace(out, r"[^\p{L}\p{N}_]", "")


def canonical_key(title: C, author: C | None = None, compose: bool = True) -> Column:
    """Dedup key: half of the MD5 of the aggressive title in [a-z0-9], kana and kanji, with the author's form if there is one."""
    key = F.regexp_replace(normalize_title(title, True, compose), r"[^a-z0-9぀-ゟ゠-ヿ一-鿿]", "")
    if author is not None:
        who = col(author)
        key = F.when(F.coalesce(who, F.lit("")) != "", F.concat_ws("_", key, normalize_author(who, compose))).otherwise(key)
    return F.substring(F.md5(key.cast("binary")), 1, 16)


def work_id(publisher: C, title: C, author: C | None = None) -> Column:
    """slug(publisher)_md5(title form[_author form])[:12]; a publisher without Latin letters has an empty slug."""
    plain = lambda c: F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}_\s]", "")
    key = squeeze(plain(title))
    if author is not None:
        key = F.when(F.coalesce(col(author), F.lit("")) != "", F.concat_ws("_", key, squeeze(plain(author)))).otherwise(key)
    return F.concat(F.regexp_replace(F.lower(F.coalesce(col(publisher), F.lit(""))), "[^a-z0-9]", ""), F.lit("_"), F.substring(F.md5(key.cast("binary")), 1, 12))


def keyword_id(keyword: C, language: C) -> Column:
    return F.substring(F.md5(F.concat(col(language), F.lit(":"), col(keyword)).cast("binary")), 1, 12)


def record_id(publisher: C, isbn: C, title: C, stamp: C) -> Column:
    """publisher_isbn_stamp, or with a hash of the title where there is no ISBN."""
    return F.concat_ws("_", col(publisher), F.coalesce(F.nullif(col(isbn), F.lit("")), F.substring(F.md5(col(title).cast("binary")), 1, 8)), col(stamp))


def parse_edition(c: C) -> Column:
    """struct(title, number, label): the first pattern that matches; (title, 1, null) without one."""
    title = col(c)
    out = F.struct(title.alias("title"), F.lit(1).alias("number"), F.lit(None).cast("string").alias("label"))
    for p in reversed(TITLE_EDITIONS):
        p = "(?iU)" + p
        label = F.regexp_replace(F.trim(F.regexp_extract(title, p, 0)), r"^[,\s]+", "")
        hit = F.struct(F.trim(F.regexp_replace(title, p, "")).alias("title"), F.regexp_extract(title, p, 1).try_cast("int").alias("number"), label.alias("label"))
        out = F.when(title.rlike(p), hit).otherwise(out)
    return out


def clean_isbn(c: C, fold_case: bool = False) -> Column:
    """Digits of a 10- or 13-digit ISBN, null for anything else; no checksum. fold_case also takes a small x."""
    bare = F.regexp_replace(col(c), r"(?U)[-\s]", "")
    bare = F.upper(bare) if fold_case else bare
    return F.when(bare.rlike(r"^(97[89])?[0-9]{9}[0-9X]$"), bare)


def edition_isbns(editions: C) -> Column:
    """Non-empty ISBNs of all editions and formats in order."""
    return F.filter(F.flatten(F.transform(col(editions), lambda e: F.coalesce(e["formats"]["isbn"], F.array().cast("array<string>")))), lambda x: x.isNotNull() & (x != ""))


def first_isbn(editions: C, fallback: C | None = None) -> Column:
    found = F.try_element_at(edition_isbns(editions), F.lit(1))
    return found if fallback is None else F.coalesce(found, F.nullif(col(fallback), F.lit("")))


def all_isbns(editions: C) -> Column:
    return F.array_distinct(edition_isbns(editions))


def parse_price(c: C) -> Column:
    """struct(amount, currency): the first pattern with a number."""
    text = col(c)
    out = F.struct(F.lit(None).cast("double").alias("amount"), F.lit(None).cast("string").alias("currency"))
    for p, currency in reversed(PRICES):
        amount = F.replace(F.regexp_extract(text, p, 1), F.lit(","), F.lit("")).try_cast("double")
        out = F.when(text.rlike(p) & amount.isNotNull(), F.struct(amount.alias("amount"), F.lit(currency).alias("currency"))).otherwise(out)
    return out


def format_code(c: C) -> Column:
    out = F.lit("other")
    for k, v in FORMAT_CODES.items():
        out = F.when(col(c) == k, F.lit(v)).otherwise(out)
    return out


def format_of_text(c: C) -> Column:
    low, out = F.lower(col(c)), F.lit("other")
    for kind, words in reversed(FORMAT_WORDS):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.coalesce(F.contains(low, F.lit(w)), F.lit(False))
        out = F.when(hit, F.lit(kind)).otherwise(out)
    return out


def split_authors(c: C) -> Column:
    bare = F.regexp_replace(col(c), r"(?i)^(By|Author[s]?:?)\s*", "")
    parts = F.transform(F.split(bare, r",\s*(?:and\s+)?|;\s*|\s+and\s+|\s*&\s*"), lambda x: F.trim(x))
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def asin_of_url(c: C) -> Column:
    return F.nullif(F.regexp_extract(col(c), "/dp/([A-Z0-9]{10})", 1), F.lit(""))


def ngrams(c: C, n: int = 3) -> Column:
    """All character n-grams with repeats; a shorter non-empty text is one gram."""
    text = F.coalesce(col(c), F.lit(""))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(grams)


def split_keywords(c: C) -> Column:
    """struct(en, ja): comma-separated keywords, by whether they are of the ASCII class."""
    words = F.filter(F.transform(F.split(col(c), "[,、]"), lambda x: F.trim(x)), lambda x: x != "")
    ascii_only = r"^[\x20-\x7E]+$"
    return F.struct(F.filter(words, lambda x: x.rlike(ascii_only)).alias("en"), F.filter(words, lambda x: ~x.rlike(ascii_only)).alias("ja"))


def reply_json(c: C) -> Column:
    """The JSON of a model's reply: a fenced block, else the first flat object, else null."""
    fenced = F.nullif(F.regexp_extract(col(c), r"(?s)```(?:json)?\s*(.*?)\s*```", 1), F.lit(""))
    return F.coalesce(fenced, F.nullif(F.regexp_extract(col(c), r"(?s)\{[^{}]*\}", 0), F.lit("")))


def shorten(c: C, size: int, mark: str = "...") -> Column:
    return F.when(F.length(col(c)) > size, F.concat(F.left(col(c), F.lit(size)), F.lit(mark))).otherwise(col(c))


def first_description(editions: C) -> Column:
    return F.try_element_at(F.filter(col(editions)["description"], lambda x: x.isNotNull() & (x != "")), F.lit(1))


def store_url(isbn: C, asin: C, title: C, language: C) -> Column:
    """Product or search address of the store."""
    base = F.concat(F.lit("https://www."), F.when(col(language) == "ja", F.lit("amazon.co.jp")).otherwise(F.lit("amazon.com")))
    full = lambda c: F.coalesce(col(c), F.lit("")) != ""
    return (
        F.when(full(asin), F.concat(base, F.lit("/dp/"), col(asin)))
        .when(full(isbn) & (F.length(col(isbn)) == 10), F.concat(base, F.lit("/dp/"), col(isbn)))
        .when(full(isbn) & (F.length(col(isbn)) == 13), F.concat(base, F.lit("/s?k="), col(isbn)))
        .when(full(title), F.concat(base, F.lit("/s?k="), F.url_encode(col(title))))
    )


def url_verdict(url: C, status: C, final_url: C, body: C) -> Column:
    """struct(valid, detail) of a fetched page; store pages must be product pages."""
    u, s, f, b = col(url), col(status), col(final_url), F.coalesce(col(body), F.lit(""))
    no = lambda why: F.struct(F.lit(False).alias("valid"), (why if isinstance(why, Column) else F.lit(why)).alias("detail"))
    yes = F.struct(F.lit(True).alias("valid"), f.alias("detail"))
    store = (
        F.when(F.contains(f, F.lit("/s?")) | F.contains(f, F.lit("ref=nb_sb_noss")), no("Search page (no direct product match)"))
        .when(F.contains(b, F.lit("ご指定の検索条件に一致する商品はありませんでした")) | F.contains(F.lower(b), F.lit("did not match any products")), no("No results found"))
        .when(F.contains(b, F.lit('id="productTitle"')) | F.contains(b, F.lit('id="title"')) | F.contains(f, F.lit("/dp/")) | F.contains(f, F.lit("/gp/product/")), yes)
        .otherwise(no("Not a product page"))
    )
    return (
        F.when(F.coalesce(u, F.lit("")) == "", no("Empty URL"))
        .when((s == 200) & F.contains(F.lower(u), F.lit("amazon")), store)
        .when(s == 200, yes)
        .when(s == 404, no("Not found (404)"))
        .when(s.isNull(), no("Timeout"))
        .otherwise(no(F.concat(F.lit("HTTP "), s.cast("string"))))
    )


def token_jaccard(a: C, b: C) -> Column:
    """Shared share of the space-separated words of two strings; 0 if either has none."""
    x, y = (F.array_distinct(F.filter(F.split(col(c), " "), lambda w: w != "")) for c in (a, b))
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(both / (F.size(x) + F.size(y) - both))


def json_value(c: C) -> Column:
    """The one JSON value of a text as a variant; null if the text is none, repeats a name in an object, or goes on after it."""
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), col(c), F.lit("]"))), "$", "array<variant>")
    named = F.try_parse_json(F.concat(F.lit('{"v":'), col(c), F.lit("}")))  # a text that closes the list doesn't fit here
    whole = (F.size(listed) == 1) & (~col(c).rlike(r"\]\s*,") | named.isNotNull())
    return F.when(F.coalesce(whole, F.lit(False)), listed[0])
