"""Collection: keyword work lists and state, result-page extraction, content filter, and crawling behind injected fetchers."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioforge.functions import text as T

RETRY_LIMIT, BACKOFF, BACKOFF_MAX = 3, 5.0, 30.0


def worklist(topics: DataFrame, state: DataFrame) -> DataFrame:
    """keyword_id, keyword, language, segment, subsegment of all topic keywords that aren't completed. state: keyword_id, status."""
    one = lambda c, lang: topics.select("segment", "subsegment", F.explode(c).alias("keyword"), F.lit(lang).alias("language"))
    rows = one("keywords_ja", "ja").union(one("keywords_en", "en")).withColumn("keyword_id", T.keyword_id("keyword", "language"))
    done = state.where("status = 'completed'").select("keyword_id").distinct()
    return rows.join(done, "keyword_id", "left_anti")


def selected(topics: DataFrame, segment: str | None = None, subsegment: str | None = None) -> DataFrame:
    out = topics.where(F.col("segment") == segment) if segment else topics
    return out.where(F.col("subsegment") == subsegment) if subsegment else out


def advance(state: DataFrame, results: DataFrame) -> DataFrame:
    """State after a run: completed or failed per keyword; the latest result counts, others stay. results: keyword_id, ok."""
    new = results.groupBy("keyword_id").agg(F.max("ok").alias("ok")).select("keyword_id", F.when(F.col("ok"), "completed").otherwise("failed").alias("status"))
    return state.join(new.select("keyword_id"), "keyword_id", "left_anti").unionByName(new)


def top_per_keyword(hits: DataFrame, n: int, by: str = "keyword_id", order: str = "rank") -> DataFrame:
    """The first n accepted results of each keyword."""
    return hits.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("_n") <= n).drop("_n")


def progress(hits: DataFrame) -> DataFrame:
    """found, added, filtered, duplicates by kind. hits: kind (null, 'asin', 'isbn', 'fuzzy', ...), filtered."""
    dup = F.col("kind").isNotNull()
    return hits.agg(
        F.count("*").alias("found"), F.count_if(~dup & ~F.col("filtered")).alias("added"), F.count_if(F.col("filtered")).alias("filtered"), F.count_if(dup).alias("duplicates"),
        *[F.count_if(F.col("kind") == k).alias(f"dup_{k}") for k in ("asin", "isbn", "fuzzy")],
    )


def content_filter(rows: DataFrame, text: str, beginner: list[str], irrelevant: list[str], keep: int, order: str) -> DataFrame:
    """rows plus klass ('beginner', 'irrelevant', 'ok') and kept: the first `keep` of the ok ones by order, which identifies rows."""
    any_of = lambda words: F.lower(text).rlike("|".join(words)) if words else F.lit(False)
    out = rows.withColumn("klass", F.when(any_of(beginner), "beginner").when(any_of(irrelevant), "irrelevant").otherwise("ok"))
    first = out.where("klass = 'ok'").select(order).orderBy(order).limit(keep).withColumn("_kept", F.lit(True))  # a top-k, then at most `keep` rows
    return out.join(first, order, "left").withColumn("kept", F.coalesce("_kept", F.lit(False))).drop("_kept")


def title_links(pages: DataFrame) -> DataFrame:
    """page_id, title, links of raw pages: the text of the title element, and the addresses of the links in order."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return pages.select("page_id", F.trim(title).alias("title"), F.regexp_extract_all("html", F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1).alias("links"))


def skip_blank(cards: DataFrame) -> DataFrame:
    full = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return cards.where(full("asin") & full("title") & ~F.lower(F.trim("title")).rlike("^(sponsored|スポンサー)"))


CARD_DDL = "page_key string, rank int, asin string, title string, authors array<string>, price double, currency string, snippet string"
_CARD = re.compile(r'<div[^>]*\bdata-asin="([^"]*)"[^>]*>(.*?)(?=<div[^>]*\bdata-asin="|\Z)', re.S)


def _text(fragment: str) -> str:
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", fragment)).split())


def result_cards(pages: DataFrame, limit: int = 10) -> DataFrame:
    """Cards of result pages (page_key, html): no id, no title and sponsored cards are skipped; 2 x limit cards are looked at, limit stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, source in zip(b["page_key"], b["html"], strict=True):
                kept = 0
                for asin, body in _CARD.findall(source or "")[: 2 * limit]:
                    title = re.search(r"<h2[^>]*>(.*?)</h2>", body, re.S)
                    title = _text(title[1]) if title else ""
                    if not asin or not title or title.lower().startswith(("sponsored", "スポンサー")):
                        continue
                    who = re.search(r'class="[^"]*author[^"]*"[^>]*>(.*?)</', body, re.S)
                    names = [a.strip() for a in re.split(r"[,、]", _text(who[1]).split("|")[0]) if a.strip()] if who else []
                    price = re.search(r"([$¥￥])\s*([\d,]+(?:\.\d+)?)", _text(body))
                    notes = [t for t in map(_text, re.findall(r"<span[^>]*>(.*?)</span>", body, re.S)) if len(t) > 20 and not re.match(r"[$¥￥]", t)]
                    out.append((key, kept, asin, title, names, float(price[2].replace(",", "")) if price else None, {"$": "USD"}.get(price[1], "JPY") if price else None, notes[0][:500] if notes else None))
                    kept += 1
                    if kept == limit:
                        break
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CARD_DDL.split(", ")])

    return pages.select("page_key", "html").mapInPandas(run, CARD_DDL)


def search_url(keyword: str, language: Column) -> Column:
    return F.concat(F.when(language == "ja", F.lit("https://www.amazon.co.jp/s?k=")).otherwise(F.lit("https://www.amazon.com/s?k=")), F.url_encode(keyword))


def backoff(attempt: int) -> float:
    """Seconds before a retry: doubles from BACKOFF up to BACKOFF_MAX."""
    return min(BACKOFF_MAX, BACKOFF * 2**attempt)


def fetch(urls: DataFrame, make_fetcher: Callable[[], Callable[[str], tuple[int, str, str]]], wait: Callable[[float], None] = lambda s: None) -> DataFrame:
    """url, status, final_url, body, error of each distinct url through an injected fetcher, made once per task; failures are retried with backoff."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = make_fetcher()
        for b in batches:
            out = []
            for u in b["url"]:
                row = (u, None, None, None, "no attempt")
                for attempt in range(RETRY_LIMIT):
                    try:
                        row = (u, *get(u), None)
                        break
                    except Exception as e:  # a page that can't be fetched is a row with its error
                        row = (u, None, None, None, f"{type(e).__name__}: {e}")
                        wait(backoff(attempt))
                out.append(row)
            yield pd.DataFrame(out, columns=["url", "status", "final_url", "body", "error"]).astype({"status": "Int64"})

    return urls.select("url").distinct().mapInPandas(run, "url string, status long, final_url string, body string, error string")
