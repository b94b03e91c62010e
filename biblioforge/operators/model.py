"""Nested works: conversion, merging, flattening into tables and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.schemas import EDITION
from biblioforge.store import parts_of_bytes


def given(c: str, default: str | None = None) -> Column:
    """A string column, null (or the default) where it is empty."""
    out = F.nullif(F.col(c), F.lit(""))
    return out if default is None else F.coalesce(out, F.lit(default))


def convert_v1(v1: DataFrame, stamp: str) -> DataFrame:
    """v1 flat records -> v2 nested works with the defaults of the format; `stamp` is the time of the run."""
    e = T.parse_edition("title")
    rows = v1.withColumn("_e", e).withColumn("_a", F.try_element_at("authors", F.lit(1)))
    fmt = F.struct(
        T.format_code("format").alias("format_type"), T.clean_isbn("isbn_or_issn").alias("isbn"), F.lit(None).cast("string").alias("asin"),
        F.lit(None).cast("struct<amount:double,currency:string,price_type:string>").alias("price"), F.coalesce(given("source_url"), given("catalog_url")).alias("url"),
        F.when(F.coalesce(given("source_url"), given("catalog_url")).isNotNull(), "unknown").alias("url_status"), F.lit(None).cast("string").alias("url_verified_at"), F.lit(None).cast("string").alias("availability"),
    )
    edition = F.struct(
        F.col("_e.number").alias("edition_number"), F.coalesce(given("edition"), F.col("_e.label")).alias("edition_label"), F.coalesce("publication_year", F.lit(2020)).alias("publication_year"),
        F.lit(True).alias("is_latest"), F.when(F.col("pages") > 0, F.col("pages")).alias("pages"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("array<string>").alias("table_of_contents"), F.array(fmt).alias("formats"),
    )
    some = lambda c: F.when(F.size(c) > 0, F.col(c))
    same = ["series", "instrument_or_asset_class", "jurisdiction", "audience_level", "official_status", "related_regulation", "qualification_target", "notes", "recommended_for", "last_reviewed_at"]
    return rows.select(
        T.work_id("publisher", F.col("_e.title"), "_a").alias("work_id"), F.col("_e.title").alias("title"), given("subtitle").alias("subtitle"), some("authors").alias("authors"),
        given("language", "en").alias("language"), given("publisher", "unknown").alias("publisher"), given("segment", "Other").alias("segment"), given("subsegment", "General").alias("subsegment"),
        given("perspective", "practice").alias("perspective"), some("topics").alias("topics"), *[given(c).alias(c) for c in same], F.array(edition).cast(f"array<{EDITION}>").alias("editions"),
        F.when(given("data_source").isNotNull(), F.array("data_source")).alias("data_sources"), given("dataset_status", "draft").alias("dataset_status"), F.lit(stamp).alias("created_at"), F.lit(stamp).alias("updated_at"),
        *[c for c in v1.columns if c.startswith("_")],
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def pick(df: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """One row per key: the first by order, or the last. An aggregate, so that tasks send one row per key."""
    best = F.max_by if last else F.min_by
    rows = df.groupBy(*keys).agg(best(F.struct(*[c for c in df.columns if c not in keys]), F.struct(order)).alias("_row"))
    return rows.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def is_nested(c: str = "editions") -> Column:
    return F.col(c).isNotNull()


def latest_edition(c: str = "editions") -> Column:
    e = F.col(c)
    return F.coalesce(F.try_element_at(F.filter(e, lambda x: F.coalesce(x["is_latest"], F.lit(False))), F.lit(1)), F.try_element_at(e, F.lit(1)))


def merge_editions(works: DataFrame, keys: list[str], order: str = "_ord", first_edition_only: bool = True) -> DataFrame:
    """One work per key: scalars of the first record, formats of each edition number by type (first one stays), the newest edition is the latest.

    With first_edition_only, later records give their first edition alone. Data sources are joined in order.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    rows = works.withColumn("_n", rank)
    first = rows.where("_n = 1").drop("_n", "editions", "data_sources")
    own = F.when((F.col("_n") > 1) & F.lit(first_edition_only), F.slice("editions", 1, 1)).otherwise(F.col("editions"))
    e = rows.select(*keys, "_n", F.posexplode(own).alias("_i", "e"))
    f = e.select(*keys, "_n", "_i", F.col("e.edition_number").alias("number"), F.posexplode_outer("e.formats").alias("_j", "f"))
    f = f.withColumn("_k", F.row_number().over(Window.partitionBy(*keys, "number", "f.format_type").orderBy("_n", "_i", "_j"))).where("_k = 1 and f is not null")
    formats = f.groupBy(*keys, "number").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_i", "_j", "f"))), lambda x: x["f"]).alias("formats"))
    head = e.groupBy(*keys, F.col("e.edition_number").alias("number")).agg(F.min_by("e", F.struct("_n", "_i")).alias("e"))
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("number"))) == 1
    full = head.join(formats, [*keys, "number"], "left").withColumn("_latest", newest)
    full = full.withColumn("e", F.col("e").withField("formats", F.coalesce("formats", "e.formats")).withField("is_latest", F.col("_latest")))
    nested = full.groupBy(*keys).agg(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("number", "e")))), lambda x: x["e"]).alias("editions"))
    tags = rows.select(*keys, "_n", F.posexplode("data_sources").alias("_i", "s")).groupBy(*keys, "s").agg(F.min(F.struct("_n", "_i")).alias("at"))
    tags = tags.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda x: x["s"]).alias("data_sources"))
    return first.join(nested, keys, "left").join(tags, keys, "left")


def flatten(works: DataFrame, order: str = "_ord") -> dict[str, DataFrame]:
    """The eight tables of the relational projection; the last record of a work id replaces earlier ones, records without id are skipped."""
    some = works.where("work_id is not null")
    w = pick(some.repartition(parts_of_bytes(some), "work_id"), ["work_id"], order, last=True)  # what follows stays in these partitions
    for c in ("authors", "editors", "topics", "data_sources"):
        if c not in w.columns:
            w = w.withColumn(c, F.lit(None).cast("array<string>"))
    nested = {"authors", "editors", "topics", "data_sources", "editions"}
    positions = lambda c, name: w.select("work_id", F.posexplode(c).alias("position", name))
    editions = w.select("work_id", F.explode("editions").alias("e")).select("work_id", "e.*").dropDuplicates(["work_id", "edition_number"])
    formats = editions.select("work_id", "edition_number", F.explode("formats").alias("f")).select("work_id", "edition_number", "f.*")
    chapters = editions.select("work_id", "edition_number", F.posexplode("table_of_contents").alias("chapter_number", "chapter_title"))
    return {
        "works": w.select(*[c for c in w.columns if c not in nested and c != order], F.to_json(F.struct(*[c for c in w.columns if c != order])).alias("raw_json")),
        "authors": positions("authors", "author"),
        "editors": positions("editors", "editor"),
        "topics": w.select("work_id", F.explode("topics").alias("topic")).distinct(),
        "data_sources": w.select("work_id", F.explode("data_sources").alias("source")).distinct(),
        "editions": editions.drop("formats", "table_of_contents"),
        "formats": formats.select("work_id", "edition_number", "format_type", "isbn", "asin", "price.*", "url", "url_status", "availability"),
        "table_of_contents": chapters.withColumn("chapter_number", F.col("chapter_number") + 1),
    }


def delete_works(tables: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """Cascade: rows of deleted works leave every table."""
    return {name: df.join(ids.select("work_id").distinct(), "work_id", "left_anti") for name, df in tables.items()}


def upsert(tables: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Works of `new` replace those with the same id, children included."""
    rest = delete_works(tables, new["works"])
    return {name: rest[name].unionByName(new[name], allowMissingColumns=True) for name in tables}


def omit_empty(columns: list[str]) -> Column:
    """JSON of the columns without nulls and empty strings."""
    return F.to_json(F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]), {"ignoreNullFields": "true"})


def page_record(pages: DataFrame, segment: str, subsegment: str, this_year: int) -> DataFrame:
    """Catalogue pages (title, author_text, format_text, price_text, isbn, description, publisher, date_text, url) -> v2 works."""
    year = F.coalesce(F.regexp_extract("date_text", r"((?:20|19)\d{2})", 1).try_cast("int"), F.lit(this_year))
    e, authors, price = T.parse_edition("title"), T.split_authors("author_text"), T.parse_price("price_text")
    rows = pages.withColumn("_e", e).withColumn("_a", authors).withColumn("_p", price)
    fmt = F.struct(T.format_of_text("format_text").alias("format_type"), T.clean_isbn("isbn").alias("isbn"), F.when(F.col("_p.amount").isNotNull(), F.struct("_p.amount", "_p.currency")).alias("price"), F.col("url"))
    edition = F.struct(F.col("_e.number").alias("edition_number"), F.col("_e.label").alias("edition_label"), year.alias("publication_year"), F.lit(True).alias("is_latest"), F.left("description", F.lit(500)).alias("description"), F.array(fmt).alias("formats"))
    return rows.select(T.work_id("publisher", F.col("_e.title"), F.try_element_at("_a", F.lit(1))).alias("work_id"), F.col("_e.title").alias("title"), F.col("_a").alias("authors"), "publisher", F.lit(segment).alias("segment"), F.lit(subsegment).alias("subsegment"), F.array(edition).alias("editions"))


def search_record(hits: DataFrame) -> DataFrame:
    """Search results (asin, title, authors, price_amount, currency, url, segment, subsegment, keyword) -> works; provenance keeps its own column."""
    fmt = F.struct(F.lit("other").alias("format_type"), F.col("asin"), F.struct(F.col("price_amount").alias("amount"), F.col("currency")).alias("price"), F.col("url"))
    edition = F.struct(F.lit(1).alias("edition_number"), F.lit(True).alias("is_latest"), F.array(fmt).alias("formats"))
    return hits.select(F.concat(F.lit("amz_"), F.col("asin")).alias("work_id"), "title", "authors", "segment", "subsegment", F.array("keyword").alias("topics"), F.array(edition).alias("editions"), F.array(F.lit("store_search")).alias("data_sources"), F.struct(F.lit("store_search").alias("source"), F.col("keyword")).alias("provenance"))
