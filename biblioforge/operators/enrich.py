"""Enrichment from lookup tables: payload parsing, fill-missing, mismatch guards, status and flags. Fetching is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators.model import pick

OPENBD = "summary struct<isbn:string,publisher:string,title:string,cover:string>, onix struct<ProductSupply:struct<SupplyDetail:struct<Price:string>>,DescriptiveDetail:struct<Extent:array<struct<ExtentType:string,ExtentValue:string>>>,CollateralDetail:struct<TextContent:array<struct<TextType:string,Text:string>>>>"
VOLUME = "volumeInfo struct<industryIdentifiers:array<struct<type:string,identifier:string>>,pageCount:int,description:string,publisher:string,title:string,authors:array<string>,previewLink:string>, saleInfo struct<listPrice:struct<amount:double,currencyCode:string>>"


def _first(items: Column, test, field: str) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(1))[field]


def parse_catalogue(payload: str) -> Column:
    """struct(isbn, publisher, title, price, pages, description) of a Japanese catalogue payload; its price is an object or a list of them."""
    p = F.from_json(payload, OPENBD)
    price = p["onix"]["ProductSupply"]["SupplyDetail"]["Price"]
    amount = F.coalesce(F.get_json_object(price, "$[0].PriceAmount"), F.get_json_object(price, "$.PriceAmount")).try_cast("double")
    pages = _first(p["onix"]["DescriptiveDetail"]["Extent"], lambda x: x["ExtentType"] == "00", "ExtentValue").try_cast("int")
    about = _first(p["onix"]["CollateralDetail"]["TextContent"], lambda x: x["TextType"] == "03", "Text")
    s = p["summary"]
    return F.struct(s["isbn"].alias("isbn"), s["publisher"].alias("publisher"), s["title"].alias("title"), amount.alias("price"), pages.alias("pages"), about.alias("description"))


def parse_volume(payload: str) -> Column:
    """The same of a volume payload: ISBN-13 before ISBN-10."""
    p = F.from_json(payload, VOLUME)
    v, ids = p["volumeInfo"], p["volumeInfo"]["industryIdentifiers"]
    isbn = F.coalesce(_first(ids, lambda x: x["type"] == "ISBN_13", "identifier"), _first(ids, lambda x: x["type"] == "ISBN_10", "identifier"))
    return F.struct(isbn.alias("isbn"), v["publisher"].alias("publisher"), v["title"].alias("title"), p["saleInfo"]["listPrice"]["amount"].alias("price"), v["pageCount"].alias("pages"), v["description"].alias("description"), v["authors"].alias("authors"), v["previewLink"].alias("url"))


def lookup(records: DataFrame, by_isbn: DataFrame, by_title: DataFrame) -> DataFrame:
    """records (id, isbn, title) with `found`: the ISBN's entry, else the title's; the first of several by `ord`.

    by_isbn: isbn, ord, entry; by_title: title, ord, entry.
    """
    a = pick(by_isbn, ["isbn"], "ord").select("isbn", F.col("entry").alias("_a"))
    b = pick(by_title, ["title"], "ord").select("title", F.col("entry").alias("_b"))
    return records.join(a, "isbn", "left").join(b, "title", "left").withColumn("found", F.coalesce("_a", "_b")).drop("_a", "_b")


def title_mismatch(a: str, b: str) -> Column:
    """Fewer than half of the words of the longer title are shared."""
    x, y = (F.array_distinct(F.filter(F.split(F.lower(c), " "), lambda w: w != "")) for c in (a, b))
    longest = F.greatest(F.size(x), F.size(y))
    return F.coalesce((longest > 0) & (F.size(F.array_intersect(x, y)) / longest < 0.5), F.lit(False))


def author_mismatch(a: str, b: str) -> Column:
    low = lambda c: F.transform(c, F.lower)
    return F.coalesce((F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(low(a), low(b)), F.lit(False))


def fill_missing(rows: DataFrame, fields: list[str], source: str, absent: dict[str, list[str]] | None = None, guard: Column | None = None) -> DataFrame:
    """Fills null or empty fields from found_<field> and lists the changes as field:source; guard rows stay as they are."""
    ok = F.lit(True) if guard is None else ~guard
    changes = []
    out = rows
    for f in fields:
        missing = F.col(f).isNull() | F.col(f).cast("string").isin(["", *(absent or {}).get(f, [])])
        fill = ok & missing & F.col(f"found_{f}").isNotNull()
        changes.append(F.when(fill, F.lit(f"{f}:{source}")))
        out = out.withColumn(f"_new_{f}", F.when(fill, F.col(f"found_{f}")).otherwise(F.col(f)))
    out = out.withColumn("changes", F.array_compact(F.array(*changes)))
    for f in fields:
        out = out.withColumn(f, F.col(f"_new_{f}")).drop(f"_new_{f}")
    return out


def promoted_status(found: Column, has_isbn: Column, has_price: Column, has_valid_url: Column, status: Column) -> Column:
    return F.when(found & has_isbn & has_price & has_valid_url, "verified").otherwise(status)


def review_flags(has: dict[str, Column]) -> Column:
    """Reasons after enrichment: no ISBN, no valid address, three or more of four basics missing."""
    missing = sum(((~has[n]).cast("int") for n in ("isbn", "price", "valid_url", "description")), F.lit(0))
    return F.array_compact(F.array(F.when(~has["isbn"], "NO_ISBN_FOUND"), F.when(~has["valid_url"], "URL_VALIDATION_FAILED"), F.when(missing >= 3, "MISSING_CRITICAL_DATA")))


def enrich(records: DataFrame, catalogue: DataFrame, volumes: DataFrame, fields: list[str]) -> DataFrame:
    """Fill from the catalogue (Japanese records, by ISBN), then from volumes (by ISBN, else by title), guarded by the titles."""
    c = catalogue.select("isbn", *[F.col(f).alias(f"found_{f}") for f in fields if f != "isbn"], F.col("title").alias("_t"))
    one = records.join(pick(c.withColumn("_o", F.col("_t")), ["isbn"], "_o").drop("_o"), "isbn", "left")
    rest = [f for f in fields if f != "isbn"]
    one = fill_missing(one, rest, "catalogue", guard=(F.col("language") != "ja") | title_mismatch("title", "_t"))
    one = one.withColumnRenamed("changes", "_first").drop("_t", *[f"found_{f}" for f in rest])
    v = volumes.select(F.col("title").alias("title"), *[F.col(f).alias(f"found_{f}") for f in fields])
    two = one.join(pick(v.withColumn("_o", F.col("found_isbn")), ["title"], "_o").drop("_o"), "title", "left")
    two = fill_missing(two, fields, "volumes")
    return two.withColumn("changes", F.concat("_first", "changes")).drop("_first", *[f"found_{f}" for f in fields])

