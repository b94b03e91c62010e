"""Queries of scalar operators, with their DuckDB twins. Test tables stand in for book data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators import classify, collect, enrich, model
from biblioforge.store import fresh


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on(name: str, build):
    return lambda spark, sf_dir: build(table(spark, sf_dir, name))


ISBN = "CASE WHEN p_partkey % 3 = 0 THEN '978-' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') WHEN p_partkey % 3 = 1 THEN lpad(CAST(p_partkey AS VARCHAR), 9, '0') || 'X' ELSE 'n/a ' || CAST(p_partkey AS VARCHAR) END"
_isbn = lambda: F.expr("CASE WHEN p_partkey % 3 = 0 THEN concat('978-', lpad(cast(p_partkey as string), 10, '0')) WHEN p_partkey % 3 = 1 THEN concat(lpad(cast(p_partkey as string), 9, '0'), 'X') ELSE concat('n/a ', p_partkey) END")
PRICE_TEXT = "CASE WHEN p_partkey % 4 = 0 THEN '$ ' || CAST(p_size AS VARCHAR) || '.50' WHEN p_partkey % 4 = 1 THEN '¥1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') WHEN p_partkey % 4 = 2 THEN CAST(p_size AS VARCHAR) || ' USD' ELSE 'free' END"
_price = lambda: F.expr("CASE WHEN p_partkey % 4 = 0 THEN concat('$ ', p_size, '.50') WHEN p_partkey % 4 = 1 THEN concat('¥1,', lpad(cast(p_size as string), 3, '0')) WHEN p_partkey % 4 = 2 THEN concat(p_size, ' USD') ELSE 'free' END")
EDITION_TITLE = "p_name || ', ' || CAST(p_size AS VARCHAR) || 'th Edition'"
_edition_title = lambda: F.expr("concat(p_name, ', ', p_size, 'th Edition')")
# The twin of the title form, over a text that NFKC doesn't change.
_SPACED = "trim(regexp_replace(regexp_replace(regexp_replace(lower({}), '[‐‑‒–—―−]', '-', 'g'), '\\s*&\\s*', ' and ', 'g'), '\\s+', ' ', 'g'))"
_EDITED = "regexp_replace(regexp_replace(regexp_replace({}, ',?\\s*(\\d+)(st|nd|rd|th)\\s+edition', '', 'gi'), ',?\\s*(\\d+)(st|nd|rd|th)\\s+ed\\.?', '', 'gi'), ',?\\s*(\\d+)e\\b', '', 'gi')"
TITLE = "p_brand || ' - ' || p_name || ' & co (' || p_type || '), ' || CAST(p_size AS VARCHAR) || 'th Edition'"
_title = lambda: F.expr("concat(p_brand, ' - ', p_name, ' & co (', p_type, '), ', p_size, 'th Edition')")
NORM = _SPACED.format(_EDITED.format(TITLE))
AGG = f"regexp_replace(split_part(regexp_replace({NORM}, '\\([^)]*\\)', '', 'g'), ' - ', 1), '\\s+', '', 'g')"


def _round(spark, sf_dir, write, read):
    path = fresh(spark, "roundtrip")
    write(path)
    return read(path)


def csv_roundtrip(spark, sf_dir):
    from biblioforge.sources import io

    df = table(spark, sf_dir, "nation")
    return _round(spark, sf_dir, lambda p: io.write_csv(df, p), lambda p: io.read_csv(spark, p, "n_nationkey int, n_name string, n_regionkey int"))


def jsonl_roundtrip(spark, sf_dir):
    from biblioforge.sources import io

    df = table(spark, sf_dir, "nation")
    return _round(spark, sf_dir, lambda p: io.write_json_lines(df, p), lambda p: io.read_json_lines(spark, p, "n_nationkey int, n_name string, n_regionkey int").drop("_src"))


def json_scan_props(spark, sf_dir):
    from biblioforge.sources import io

    good, _ = io.parse_json_lines(table(spark, sf_dir, "events").select(F.col("props").alias("value")), "k int")
    return good.groupBy("k").agg(F.count("*").alias("n"))


def md_headers_carry(spark, sf_dir):
    from biblioforge.sources import io

    p = table(spark, sf_dir, "part")
    lines = p.select(
        F.col("p_brand").alias("_src"), F.col("p_partkey").alias("line"),
        F.expr("CASE WHEN p_partkey % 10 = 0 THEN concat('## ', p_size, '. セグ (', p_type, ')') WHEN p_partkey % 10 = 5 THEN concat('### ', p_size, '-1. サブ (', p_name, ')') ELSE concat('- **題 (', p_name, '):** alpha, 株式, beta') END").alias("value"),
    )
    out = io.parse_headed_markdown(lines)
    return out.select(F.col("_src").alias("file"), "line", "segment", "subsegment_num", "topic_en", F.size("keywords_en").alias("n_en"), F.size("keywords_ja").alias("n_ja"))


QUERIES = {
    "json_scan_props": (json_scan_props, "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1"),
    "csv_roundtrip": (csv_roundtrip, "SELECT * FROM nation"),
    "jsonl_roundtrip": (jsonl_roundtrip, "SELECT * FROM nation"),
    "md_headers_carry": (
        md_headers_carry,
        """
WITH l AS (SELECT *, CASE WHEN p_partkey % 10 = 0 THEN 's' WHEN p_partkey % 10 = 5 THEN 'b' ELSE 't' END AS kind FROM part),
c AS (SELECT *, last_value(CASE WHEN kind = 's' THEN p_type END IGNORE NULLS) OVER w AS segment, count(CASE WHEN kind = 's' THEN 1 END) OVER w AS g FROM l WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)),
d AS (SELECT *, last_value(CASE WHEN kind = 'b' THEN CAST(p_size AS VARCHAR) || '-1' END IGNORE NULLS) OVER (PARTITION BY p_brand, g ORDER BY p_partkey) AS sub FROM c)
SELECT p_brand AS file, p_partkey AS line, segment, sub AS subsegment_num, p_name AS topic_en, 2 AS n_en, 1 AS n_ja FROM d WHERE kind = 't'""",
    ),
    "title_norm": (_on("part", lambda p: p.select("p_partkey", T.normalize_title(_title(), compose=False).alias("form"))), f"SELECT p_partkey, {NORM} AS form FROM part"),
    "title_norm_aggressive": (_on("part", lambda p: p.select("p_partkey", T.normalize_title(_title(), True, compose=False).alias("form"))), f"SELECT p_partkey, {AGG} AS form FROM part"),
    "title_norm_documents": (_on("documents", lambda d: d.select("doc_id", F.md5(T.normalize_title("text").cast("binary")).alias("form_md5"))), None),
    "canonical_key": (_on("part", lambda p: p.select("p_partkey", T.canonical_key(_title(), compose=False).alias("key"))), f"SELECT p_partkey, substr(md5(regexp_replace({AGG}, '[^a-z0-9]', '', 'g')), 1, 16) AS key FROM part"),
    "work_id": (_on("part", lambda p: p.select("p_partkey", T.work_id("p_brand", "p_name", "p_type").alias("work_id"))), "SELECT p_partkey, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') || '_' || substr(md5(trim(regexp_replace(regexp_replace(lower(p_name), '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+', ' ', 'g')) || '_' || trim(regexp_replace(regexp_replace(lower(p_type), '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+', ' ', 'g'))), 1, 12) AS work_id FROM part"),
    "keyword_id": (_on("documents", lambda d: d.select("source", "lang").distinct().select("source", "lang", T.keyword_id("source", "lang").alias("id"))), "SELECT DISTINCT source, lang, substr(md5(lang || ':' || source), 1, 12) AS id FROM documents"),
    "record_id": (_on("part", lambda p: p.select("p_partkey", T.record_id("p_brand", T.clean_isbn(_isbn()), "p_name", F.lit("20240101")).alias("id"))), f"SELECT p_partkey, p_brand || '_' || CASE WHEN p_partkey % 3 = 2 THEN substr(md5(p_name), 1, 8) ELSE replace({ISBN}, '-', '') END || '_20240101' AS id FROM part"),
    "edition_parse": (_on("part", lambda p: p.select("p_partkey", T.parse_edition(_edition_title()).alias("e")).select("p_partkey", F.col("e.title").alias("title"), F.col("e.number").alias("number"), F.col("e.label").alias("label"))), "SELECT p_partkey, p_name AS title, p_size AS number, CAST(p_size AS VARCHAR) || 'th Edition' AS label FROM part"),
    "isbn_clean": (_on("part", lambda p: p.select("p_partkey", T.clean_isbn(_isbn()).alias("isbn"))), f"SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN replace({ISBN}, '-', '') END AS isbn FROM part"),
    "isbn_extract": (
        _on("lineitem", lambda l: l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.array(F.struct(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey").cast("string")).otherwise("").alias("isbn"))).alias("formats")))).alias("editions")).select("l_orderkey", T.first_isbn("editions").alias("first_isbn"), F.size(T.all_isbns("editions")).alias("n_isbns"))),
        "SELECT l_orderkey, arg_min(CAST(l_partkey AS VARCHAR), (l_linenumber, CAST(l_partkey AS VARCHAR))) FILTER (l_linenumber % 2 = 0) AS first_isbn, CAST(count(DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END) AS INTEGER) AS n_isbns FROM lineitem GROUP BY 1",
    ),
    "price_parse": (_on("part", lambda p: p.select("p_partkey", T.parse_price(_price()).alias("v")).select("p_partkey", F.col("v.amount").alias("amount"), F.col("v.currency").alias("currency"))), "SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN 1000 + p_size WHEN 2 THEN p_size END AS DOUBLE) AS amount, CASE p_partkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'JPY' WHEN 2 THEN 'USD' END AS currency FROM part"),
    "format_map": (
        _on("part", lambda p: p.select("p_partkey", T.format_of_text(F.concat("p_type", F.expr("CASE p_partkey % 4 WHEN 0 THEN ' Hardback' WHEN 1 THEN ' Kindle edition' WHEN 2 THEN ' PDF' ELSE '' END"))).alias("format_type"), T.format_code(F.expr("CASE p_partkey % 3 WHEN 0 THEN 'print' WHEN 1 THEN 'hybrid' END")).alias("code"))),
        "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'hardcover' WHEN 1 THEN 'kindle' WHEN 2 THEN 'pdf' ELSE 'other' END AS format_type, CASE p_partkey % 3 WHEN 0 THEN 'paperback' WHEN 1 THEN 'bundle' ELSE 'other' END AS code FROM part",
    ),
    "author_split": (_on("customer", lambda c: c.select("c_custkey", T.split_authors(F.concat(F.lit("By "), "c_name", F.lit(", and "), "c_mktsegment", F.lit("; X & Y"))).alias("a")).select("c_custkey", F.array_join("a", "|").alias("authors"), F.size("a").alias("n"))), "SELECT c_custkey, c_name || '|' || c_mktsegment || '|X|Y' AS authors, 4 AS n FROM customer"),
    "author_norm": (_on("supplier", lambda s: s.select("s_suppkey", T.normalize_author(F.concat(F.lit("Dr. "), "s_name", F.lit(", PhD")), compose=False).alias("form"))), "SELECT s_suppkey, regexp_replace(lower(s_name), '[^\\p{L}\\p{N}_]', '', 'g') AS form FROM supplier"),
    "width_fold": (_on("part", lambda p: p.select("p_partkey", T.fold_width(F.translate("p_name", T.HALF_WIDTH, T.FULL_WIDTH)).alias("folded"))), "SELECT p_partkey, p_name AS folded FROM part"),
    "char_maps": (_on("part", lambda p: p.select("p_partkey", T.fold_kanji_digits(T.fold_brackets(F.concat(F.lit("【"), "p_name", F.lit("】第十二"), F.lit("「x」")))).alias("folded"))), "SELECT p_partkey, '[' || p_name || ']第102\"x\"' AS folded FROM part"),
    "null_omitting_json": (_on("labels", lambda d: d.select("doc_id", F.array_join(F.array_sort(F.json_object_keys(model.omit_empty(["doc_id", "quality"]))), ",").alias("keys")).where("doc_id is not null")), "SELECT doc_id, CASE WHEN quality IS NULL THEN 'doc_id' ELSE 'doc_id,quality' END AS keys FROM labels WHERE doc_id IS NOT NULL"),
    "asin_from_url": (_on("pages", lambda p: p.select("page_id", T.asin_of_url(F.concat("url", F.lit("/dp/B"), F.lpad(F.col("page_id").cast("string"), 9, "0"))).alias("asin"))), "SELECT page_id, 'B' || lpad(CAST(page_id AS VARCHAR), 9, '0') AS asin FROM pages"),
    "url_classify": (
        _on("pages", lambda p: p.select("page_id", T.url_verdict("url", F.expr("CASE page_id % 4 WHEN 0 THEN 404 WHEN 1 THEN 500 ELSE 200 END"), "url", "html").alias("v")).select("page_id", F.col("v.valid").alias("valid"), F.col("v.detail").alias("detail"))),
        "SELECT page_id, page_id % 4 > 1 AS valid, CASE page_id % 4 WHEN 0 THEN 'Not found (404)' WHEN 1 THEN 'HTTP 500' ELSE url END AS detail FROM pages",
    ),
    "url_generate": (_on("part", lambda p: p.select("p_partkey", T.store_url(T.clean_isbn(_isbn()), F.lit(None).cast("string"), "p_brand", F.lit("en")).alias("url"))), f"SELECT p_partkey, 'https://www.amazon.com/' || CASE p_partkey % 3 WHEN 0 THEN 's?k=' || replace({ISBN}, '-', '') WHEN 1 THEN 'dp/' || ({ISBN}) ELSE 's?k=' || replace(replace(p_brand, '#', '%23'), ' ', '+') END AS url FROM part"),
    "keyword_lang_split": (_on("part", lambda p: p.select("p_partkey", T.split_keywords(F.concat("p_brand", F.lit(", 株式、"), "p_type", F.lit(", é"))).alias("k")).select("p_partkey", F.array_join("k.en", "|").alias("en"), F.array_join("k.ja", "|").alias("ja"))), "SELECT p_partkey, p_brand || '|' || p_type AS en, '株式|é' AS ja FROM part"),
    "llm_json_extract": (
        _on("conversations", lambda c: c.select("conv_id", "turn", F.from_json(T.reply_json(F.when(F.col("turn") % 2 == 0, F.concat(F.lit('So:\n```json\n{"segment": "'), "role", F.lit('"}\n```'))).otherwise(F.concat(F.lit('I say {"segment": "'), "role", F.lit('"} so')))), "segment string")["segment"].alias("segment"))),
        "SELECT conv_id, turn, role AS segment FROM conversations",
    ),
    "prompt_text": (_on("part", lambda p: p.select("p_partkey", classify.prompt("p_name", "p_type", "1. a / b").alias("prompt"))), "SELECT p_partkey, '1. a / b' || chr(10) || 'Title: ' || p_name || chr(10) || 'Description: ' || p_type AS prompt FROM part"),
    "first_description": (
        _on("lineitem", lambda l: l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("description")))).alias("e")).select("l_orderkey", T.first_description("e").alias("description"))),
        "SELECT l_orderkey, arg_min(l_returnflag, (l_linenumber, l_returnflag)) FILTER (l_returnflag <> 'N') AS description FROM lineitem GROUP BY 1",
    ),
    "payload_catalogue": (
lambda spark, sf_dir: table(spark, sf_dir, "part").withColumn("payload", F.concat(F.lit('{"summary": {"isbn": "'), F.col("p_partkey"), F.lit('", "title": "'), F.col("p_brand"), F.lit('"}, "onix": {"ProductSupply": {"SupplyDetail": {"Price": '), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('[{"PriceAmount": "'), F.col("p_size"), F.lit('"}]'))).otherwise(F.concat(F.lit('{"PriceAmount": "'), F.col("p_size"), F.lit('"}'))), F.lit('}}, "DescriptiveDetail": {"Extent": [{"ExtentType": "00", "ExtentValue": "'), F.col("p_size"), F.lit('"}]}, "CollateralDetail": {"TextContent": [{"TextType": "03", "Text": "t"}]}}}')))
            .withColumn("r", enrich.parse_catalogue("payload")).select("p_partkey", F.col("r.isbn").alias("isbn"), F.col("r.title").alias("title"), F.col("r.price").alias("price"), F.col("r.pages").alias("pages"), F.col("r.description").alias("description")),
        "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS isbn, p_brand AS title, CAST(p_size AS DOUBLE) AS price, p_size AS pages, 't' AS description FROM part",
    ),
    "payload_volume": (
        lambda spark, sf_dir: table(spark, sf_dir, "part").withColumn("payload", F.concat(F.lit('{"volumeInfo": {"industryIdentifiers": [{"type": "ISBN_10", "identifier": "a'), F.col("p_partkey"), F.lit('"}'), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(', {"type": "ISBN_13", "identifier": "b'), F.col("p_partkey"), F.lit('"}'))).otherwise(F.lit("")), F.lit('], "pageCount": '), F.col("p_size"), F.lit(', "title": "'), F.col("p_brand"), F.lit('"}, "saleInfo": {"listPrice": {"amount": 1.5, "currencyCode": "USD"}}}')))
        .withColumn("r", enrich.parse_volume("payload")).select("p_partkey", F.col("r.isbn").alias("isbn"), F.col("r.title").alias("title"), F.col("r.price").alias("price"), F.col("r.pages").alias("pages")),
        "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'b' ELSE 'a' END || CAST(p_partkey AS VARCHAR) AS isbn, p_brand AS title, CAST(1.5 AS DOUBLE) AS price, p_size AS pages FROM part",
    ),
    "ngrams": (_on("part", lambda p: p.select("p_partkey", T.ngrams("p_name").alias("g")).select("p_partkey", F.size("g").alias("n"), F.element_at("g", -1).alias("last_gram"))), "SELECT p_partkey, CAST(greatest(length(p_name) - 2, 1) AS INTEGER) AS n, p_name[-3:] AS last_gram FROM part"),
    "token_jaccard": (_on("part", lambda p: p.select("p_partkey", F.round(T.token_jaccard("p_name", "p_type"), 6).alias("jaccard"))), "SELECT p_partkey, CAST(round(len(list_intersect(string_split(p_name, ' '), string_split(p_type, ' '))) / len(list_distinct(list_concat(string_split(p_name, ' '), string_split(p_type, ' ')))), 6) AS DOUBLE) AS jaccard FROM part"),
    "title_mismatch": (_on("part", lambda p: p.select("p_partkey", enrich.title_mismatch("p_name", "p_type").alias("mismatch"))), "SELECT p_partkey, len(list_intersect(string_split(lower(p_name), ' '), string_split(lower(p_type), ' '))) / greatest(len(list_distinct(string_split(lower(p_name), ' '))), len(list_distinct(string_split(lower(p_type), ' ')))) < 0.5 AS mismatch FROM part"),
    "author_mismatch": (lambda spark, sf_dir: table(spark, sf_dir, "customer").withColumn("a", F.array("c_mktsegment")).withColumn("b", F.array(F.lit("building"), F.lit("MACHINERY"))).select("c_custkey", enrich.author_mismatch("a", "b").alias("mismatch")), "SELECT c_custkey, lower(c_mktsegment) NOT IN ('building', 'machinery') AS mismatch FROM customer"),
    "skip_blank": (lambda spark, sf_dir: collect.skip_blank(table(spark, sf_dir, "part").select("p_partkey", F.expr("CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END").alias("asin"), F.expr("CASE WHEN p_partkey % 5 = 0 THEN concat('Sponsored ', p_name) ELSE p_name END").alias("title"))).select("p_partkey"), "SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0"),
}
