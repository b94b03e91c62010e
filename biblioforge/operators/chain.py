"""The enrichment chain on nested works: sources in order, each filling what is missing, then address, cell, status and flags."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators.classify import decide
from biblioforge.operators.enrich import author_mismatch, review_flags, title_mismatch
from biblioforge.operators.model import pick
from biblioforge.operators.views import presence
from biblioforge.schemas import PRICE
from biblioforge.store import keep

ENTRY = f"struct<isbn:string,price:{PRICE},pages:int,description:string,publisher:string,title:string,authors:array<string>>"


@dataclass
class Source:
    """A lookup table: entries with isbn, title, ord and entry (ENTRY); the first by ord counts.

    Works with an ISBN look it up; others look up their title if by_title. languages: whose works ask at all.
    """

    name: str
    entries: DataFrame
    by_title: bool = False
    languages: list[str] | None = None


def _full(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) != ""


def _place(items: Column, test: Callable[[Column], Column]) -> Column:
    """Position (from 1) of the first item that passes; 0 without one."""
    return F.coalesce(F.array_position(F.transform(items, lambda x: F.coalesce(test(x), F.lit(False))), True), F.lit(0))


def change_first(items: Column, test: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """items with the first one that passes changed."""
    return F.flatten(F.transform(F.array(_place(items, test)), lambda at: F.transform(items, lambda x, i: F.when(i + 1 == at, change(x)).otherwise(x))))


def _latest(e: Column) -> Column:
    return e["is_latest"]


def set_in_format(editions: Column, test: Callable[[Column], Column], **fields: Column) -> Column:
    """Sets fields of the first format that passes in the first latest edition."""

    def put(f: Column) -> Column:
        for name, value in fields.items():
            f = f.withField(name, value)
        return f

    return change_first(editions, _latest, lambda e: e.withField("formats", change_first(e["formats"], test, put)))


def _in_format(editions: Column, test: Callable[[Column], Column]) -> Column:
    """Whether the first latest edition has such a format."""
    first = F.try_element_at(F.filter(editions, lambda e: F.coalesce(_latest(e), F.lit(False))), F.lit(1))
    return F.coalesce(F.exists(first["formats"], lambda f: F.coalesce(test(f), F.lit(False))), F.lit(False))


def _fill(works: DataFrame, source: Source) -> DataFrame:
    """One source's turn: _e is its entry. Changes and reviews are appended."""
    e, has = F.col("_e"), presence()
    reasons = F.array_compact(F.array(F.when(title_mismatch("title", "_e.title") & _full(F.col("title")), "TITLE_MISMATCH"), F.when(author_mismatch("authors", "_e.authors"), "AUTHOR_MISMATCH")))
    out = works.withColumn("_reasons", F.when(e.isNotNull(), reasons).otherwise(F.array().cast("array<string>")))
    fine = e.isNotNull() & (F.size("_reasons") == 0)
    no_isbn, no_price = lambda f: ~_full(f["isbn"]), lambda f: f["price"].isNull()
    no_pages, no_text = lambda x: _latest(x) & x["pages"].isNull(), lambda x: _latest(x) & ~_full(x["description"])
    at = lambda test: F.coalesce(F.exists("editions", lambda x: F.coalesce(test(x), F.lit(False))), F.lit(False))
    fills = {
        "isbn": _full(e["isbn"]) & ~has["isbn"] & _in_format(F.col("editions"), no_isbn),
        "price": e["price"]["amount"].isNotNull() & ~has["price"] & _in_format(F.col("editions"), no_price),
        "pages": e["pages"].isNotNull() & ~has["pages"] & at(no_pages),
        "description": _full(e["description"]) & ~has["description"] & at(no_text),
        "publisher": _full(e["publisher"]) & (~_full(F.col("publisher")) | (F.col("publisher") == "Unknown")),
    }
    out = out.withColumn("_fills", F.array_compact(F.array(*[F.when(F.coalesce(fine & test, F.lit(False)), F.lit(name)) for name, test in fills.items()])))
    on = lambda name: F.array_contains("_fills", name)
    ed = F.col("editions")
    ed = F.when(on("isbn"), set_in_format(ed, no_isbn, isbn=e["isbn"])).otherwise(ed)
    out = out.withColumn("editions", ed)
    out = out.withColumn("editions", F.when(on("price"), set_in_format(F.col("editions"), no_price, price=e["price"])).otherwise(F.col("editions")))
    out = out.withColumn("editions", F.when(on("pages"), change_first(F.col("editions"), no_pages, lambda x: x.withField("pages", e["pages"]))).otherwise(F.col("editions")))
    out = out.withColumn("editions", F.when(on("description"), change_first(F.col("editions"), no_text, lambda x: x.withField("description", F.left(e["description"], F.lit(2000))))).otherwise(F.col("editions")))
    out = out.withColumn("publisher", F.when(on("publisher"), e["publisher"]).otherwise(F.col("publisher")))
    out = out.withColumn("changes", F.concat("changes", F.transform("_fills", lambda f: F.concat(f, F.lit(f":{source.name}")))))
    review = F.when(F.size("_reasons") > 0, F.array(F.struct(F.lit(source.name).alias("source"), F.col("_reasons").alias("reasons")))).otherwise(F.array().cast("array<struct<source:string,reasons:array<string>>>"))
    return out.withColumn("reviews", F.concat("reviews", review)).drop("_e", "_reasons", "_fills")


def fill_from(works: DataFrame, source: Source) -> DataFrame:
    """works (with _isbn, changes, reviews) after a source; each lookup is one join."""
    entries = source.entries.withColumn("entry", F.col("entry").cast(ENTRY))
    a = pick(entries.where("isbn <> ''").select("isbn", "ord", "entry"), ["isbn"], "ord").select(F.col("isbn").alias("_isbn"), F.col("entry").alias("_a"))
    out = works.join(a, "_isbn", "left")
    found = F.when(F.col("_isbn").isNotNull(), F.col("_a"))
    if source.by_title:
        b = pick(entries.where("title <> ''").select("title", "ord", "entry"), ["title"], "ord").select(F.col("title").alias("_title"), F.col("entry").alias("_b"))
        out = out.join(b, out.title == b["_title"], "left").drop("_title")
        found = F.coalesce(found, F.when(F.col("_isbn").isNull(), F.col("_b")))
    asks = F.lit(True) if source.languages is None else F.coalesce(F.col("language").isin(source.languages), F.lit(False))
    return keep(_fill(out.withColumn("_e", F.when(asks, found)).drop("_a", "_b"), source).select(*works.columns), f"filled-{source.name}")


def set_addresses(works: DataFrame, checked: DataFrame, stamp: str) -> DataFrame:
    """Store addresses of works without a valid one. checked: url, valid, final_url of addresses that were fetched."""
    no_url = ~_in_format(F.col("editions"), lambda f: _full(f["url"]))
    isbn = F.try_element_at(T.edition_isbns("editions"), F.lit(1))
    nothing = F.lit(None).cast("string")
    out = works.withColumn("_have", isbn).withColumn("_none", nothing).withColumn("_bare", F.when(F.col("_have").isNull(), F.col("title")))
    out = out.withColumn("_made", F.when(no_url | ~presence()["valid_url"], T.store_url("_have", "_none", "_bare", "language"))).withColumn("_had", ~no_url)
    known = pick(checked.select(F.col("url").alias("_made"), "valid", "final_url"), ["_made"], "final_url")
    out = out.join(known, "_made", "left")
    good = F.coalesce(F.col("valid"), F.lit(False)) & _in_format(F.col("editions"), lambda f: F.lit(True))
    put = set_in_format(F.col("editions"), lambda f: F.lit(True), url=F.col("final_url"), url_status=F.lit("valid"), url_verified_at=F.lit(stamp))
    out = out.withColumn("editions", F.when(good, put).otherwise(F.col("editions")))
    told = F.when(good, F.array(F.when(F.col("_had"), "url_validated").otherwise("amazon_url:valid"))).otherwise(F.array().cast("array<string>"))
    return out.withColumn("changes", F.concat("changes", told)).select(*works.columns)


def set_cells(works: DataFrame, verdicts: DataFrame, auto_apply: bool = False) -> DataFrame:
    """verdicts: work_id, new_segment, new_subsegment, confidence, is_ambiguous. Clear ones are applied, others reviewed (decide())."""
    out = decide(works.join(verdicts, "work_id", "left").withColumn("is_ambiguous", F.coalesce("is_ambiguous", F.lit(False))), auto_apply)
    takes = F.col("new_segment").isNotNull() & F.col("decision").isin("apply", "update")
    tail = F.when(F.col("decision") == "apply", "(auto)").otherwise("")
    told = [F.when(takes & ~F.col(c).eqNullSafe(F.col(f"new_{c}")), F.concat(F.lit(f"{c}:"), F.left(f"new_{c}", F.lit(20)), tail)) for c in ("segment", "subsegment")]
    out = out.withColumn("changes", F.concat("changes", F.array_compact(F.array(*told))))
    review = F.when(F.col("new_segment").isNotNull() & (F.col("decision") == "review"), F.array(F.struct(F.lit("classifier").alias("source"), F.col("reasons").alias("reasons")))).otherwise(F.array().cast("array<struct<source:string,reasons:array<string>>>"))
    out = out.withColumn("reviews", F.concat("reviews", review))
    for c in ("segment", "subsegment"):
        out = out.withColumn(c, F.when(takes, F.col(f"new_{c}")).otherwise(F.col(c)))
    return out.select(*works.columns)


def enrich_works(works: DataFrame, sources: list[Source], stamp: str, checked: DataFrame | None = None, verdicts: DataFrame | None = None, auto_apply: bool = False) -> DataFrame:
    """works (v2, nested) enriched, with changes (what was filled, by whom, in order), reviews (source, reasons) and flags.

    A source whose entry names another title or author changes nothing and is reviewed. A work that got data and has an
    ISBN, a price and a valid address is verified. The ISBN that lookups use is the one the work came with.
    """
    out = works.withColumn("_isbn", T.clean_isbn(F.try_element_at(T.edition_isbns("editions"), F.lit(1)))).withColumn("changes", F.array().cast("array<string>")).withColumn("reviews", F.array().cast("array<struct<source:string,reasons:array<string>>>"))
    for s in sources:
        out = fill_from(out, s)
    if checked is not None:
        out = keep(set_addresses(out, checked, stamp), "addressed")
    out = out.withColumn("_found", F.size("changes") > 0)
    if verdicts is not None:
        out = set_cells(out, verdicts, auto_apply)
    has = presence()
    verified = F.col("_found") & has["isbn"] & has["price"] & has["valid_url"] & ~has["verified"]
    out = out.withColumn("changes", F.when(verified, F.concat("changes", F.array(F.lit("status:verified")))).otherwise(F.col("changes"))).withColumn("dataset_status", F.when(verified, "verified").otherwise(F.col("dataset_status")))
    sources_now = F.coalesce("data_sources", F.array().cast("array<string>"))
    out = out.withColumn("data_sources", F.when(F.col("_found") & ~F.array_contains(sources_now, "enriched"), F.concat(sources_now, F.array(F.lit("enriched")))).otherwise(F.col("data_sources")))
    out = out.withColumn("updated_at", F.when(F.col("_found"), F.lit(stamp)).otherwise(F.col("updated_at")) if "updated_at" in out.columns else F.lit(stamp))
    return out.withColumn("flags", review_flags(presence())).drop("_isbn", "_found")
