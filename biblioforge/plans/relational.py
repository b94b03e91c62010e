"""Queries of joins, aggregates, matching, review, validation and state, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators import classify, collect, enrich, matching, model, review, validate, views
from biblioforge.store import parts_of_rows

STATUSES = ["F", "O", "P"]
#: A small keyword table: order, keyword, segment, subsegment.
KEYWORDS = [
    (0, "the", "Common", "Article"), (1, "ing", "Common", "Ending"), (2, "tion", "Nouns", "Abstract"), (3, "ung", "Nouns", "German"), (4, "ment", "Nouns", "French"),
    (5, "able", "Adjectives", "Ability"), (6, "que", "Common", "French"), (7, "licen", "Legal", "Licence"), (8, "an", "Short", "Skipped"), (9, "con", "Common", "Spanish"),
    (10, "heit", "Nouns", "German"), (11, "keit", "Nouns", "German"), (12, "sch", "Nouns", "German"), (13, "eux", "Common", "French"), (14, "elle", "Common", "French"), (15, "ción", "Common", "Spanish"), (16, "mente", "Common", "Spanish"),
]
_KW = "(VALUES " + ", ".join(f"({o}, '{k}', '{s}', '{u}')" for o, k, s, u in KEYWORDS) + ") AS kw(kw_ord, keyword, segment, subsegment)"
HITS = f"hits AS (SELECT doc_id AS id, segment, subsegment, count(*) AS hits, min(kw_ord) AS first FROM documents, {_KW} WHERE length(keyword) >= 3 AND contains(lower(text), keyword) GROUP BY ALL)"
CLASSES = f"{HITS}, ranked AS (SELECT *, row_number() OVER w AS n, lead(hits) OVER w AS nxt FROM hits WINDOW w AS (PARTITION BY id ORDER BY hits DESC, first)), best AS (SELECT id, segment, subsegment, hits, least(0.95, 0.5 + 0.1 * hits) AS confidence, coalesce(nxt >= 0.8 * hits, false) AS is_ambiguous FROM ranked WHERE n = 1)"
DECIDED = f"{CLASSES}, old AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'Common' ELSE lang END AS old_segment, CASE WHEN doc_id % 3 = 0 THEN 'Ending' ELSE source END AS old_subsegment FROM documents), d AS (SELECT best.*, old_segment, old_subsegment, NOT (old_segment = segment AND old_subsegment = subsegment) AS changed FROM best JOIN old USING (id)), r AS (SELECT *, list_filter([CASE WHEN confidence < 0.6 THEN 'LOW_CONFIDENCE' END, CASE WHEN is_ambiguous THEN 'MULTIPLE_MATCHES' END, CASE WHEN changed THEN 'SEGMENT_CHANGE' END], lambda x: x IS NOT NULL) AS reasons FROM d), e AS (SELECT *, CASE WHEN reasons = ['SEGMENT_CHANGE'] AND confidence >= 0.7 THEN 'apply' WHEN len(reasons) > 0 THEN 'review' WHEN confidence >= 0.6 AND changed THEN 'update' ELSE 'none' END AS decision FROM r)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def works(spark, sf_dir) -> DataFrame:
    """Orders with their customers as works."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").alias("work_id"), F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("subsegment"), F.col("o_orderstatus").alias("perspective"), F.when(F.col("c_nationkey") % 2 == 0, "en").otherwise("ja").alias("language"), F.when(F.col("o_orderkey") % 4 == 0, "rejected").when(F.col("o_orderkey") % 4 == 1, "validated").otherwise("draft").alias("dataset_status"))


WORKS = "works AS (SELECT o_orderkey AS work_id, c_mktsegment AS segment, o_orderpriority AS subsegment, o_orderstatus AS perspective, CASE WHEN c_nationkey % 2 = 0 THEN 'en' ELSE 'ja' END AS language, CASE o_orderkey % 4 WHEN 0 THEN 'rejected' WHEN 1 THEN 'validated' ELSE 'draft' END AS dataset_status FROM orders JOIN customer ON o_custkey = c_custkey)"
LONG = f"WITH {WORKS}, long AS (SELECT segment, perspective, count(*) AS cnt FROM works WHERE dataset_status <> 'rejected' GROUP BY ALL)"
GAP = 750


def tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Orders as works, lines as editions and formats; line numbers repeat, so an edition is (order, line, part).

    All four come hashed by work_id into as many partitions as the lines ask for, so what is joined or grouped by work
    isn't shuffled again, and no task's share grows with the tables.
    """
    lines = table(spark, sf_dir, "lineitem")
    n = parts_of_rows(lines)
    l = lines.select(F.col("l_orderkey").alias("work_id"), (F.col("l_linenumber").cast("long") * 10000000 + F.col("l_partkey")).alias("edition_number"), F.year("l_shipdate").alias("publication_year"), F.col("l_returnflag").alias("format_type"), F.col("l_partkey").cast("string").alias("isbn"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("isbn"), "p_brand")
    authors = l.select("work_id", "isbn").repartition(n, "isbn").join(p.repartition(n, "isbn"), "isbn").select("work_id", F.col("p_brand").alias("author"))
    editions = l.repartition(n, "work_id").groupBy("work_id", "edition_number").agg(F.max("publication_year").alias("publication_year"))
    editions = editions.withColumn("is_latest", F.col("edition_number") == F.max("edition_number").over(Window.partitionBy("work_id"))).withColumn("pages", F.lit(1))
    works = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("work_id"), F.col("o_orderstatus").alias("title"))
    return {"works": works.repartition(n, "work_id"), "authors": authors.repartition(n, "work_id"), "editions": editions, "formats": l.select("work_id", "edition_number", "format_type", "isbn").repartition(n, "work_id")}


_L = "l AS (SELECT l_orderkey AS work_id, CAST(l_linenumber AS BIGINT) * 10000000 + l_partkey AS edition_number, CAST(year(l_shipdate) AS INTEGER) AS publication_year, l_returnflag AS format_type, CAST(l_partkey AS VARCHAR) AS isbn FROM lineitem), latest AS (SELECT work_id, max(edition_number) AS edition_number, arg_max(publication_year, (edition_number, publication_year)) AS publication_year FROM l GROUP BY 1)"


def books_flat(spark, sf_dir):
    return views.books_flat(tables(spark, sf_dir)).select("work_id", "title", "authors", "edition_number", "publication_year", "isbns", "formats")


def recent_latest(spark, sf_dir):
    return views.recent(tables(spark, sf_dir), 1997).select("work_id", "publication_year")


def isbn_lookup(spark, sf_dir):
    return views.by_isbn(tables(spark, sf_dir), "77").select("work_id", "edition_number", "isbn")


def nested(spark, sf_dir) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.array_sort(F.collect_list(F.struct(F.col("l_partkey").cast("string").alias("isbn"), F.col("l_returnflag").alias("format_type"), F.col("l_extendedprice").alias("amount")))).alias("formats"))
    return l.groupBy(F.col("l_orderkey").alias("work_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("edition_number"), "formats"))).alias("editions"))


def unnest_tables(spark, sf_dir):
    e = nested(spark, sf_dir).select("work_id", F.posexplode("editions").alias("position", "e"))
    return e.select("work_id", "position", F.col("e.edition_number").alias("edition_number"), F.explode("e.formats").alias("f")).select("work_id", "edition_number", "f.isbn", "f.format_type", F.round("f.amount", 2).alias("amount"))


def nested_totals(spark, sf_dir):
    return views.nested_totals(nested(spark, sf_dir))


def labelled(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")), "doc_id", "left")


LABELLED = "labelled AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id))"


def _flags():
    return {"label": F.col("quality").isNotNull(), "length": F.col("n_chars") > 1000}


def completeness(spark, sf_dir):
    return views.completeness(labelled(spark, sf_dir), _flags())


def completeness_by_lang(spark, sf_dir):
    return views.completeness(labelled(spark, sf_dir), _flags(), ["lang"]).drop("share_label", "share_length")


def incomplete(spark, sf_dir):
    return views.incomplete(labelled(spark, sf_dir), _flags()).select("doc_id", F.array_join("missing", ",").alias("missing"))


def upsert_last_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("_o", F.struct("ts", "event_id"))
    return model.pick(e, ["user_id"], "_o", last=True).select("user_id", "event_id", "event_type")


def merge_first_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("_o", F.struct("ts", "event_id"))
    return model.pick(e, ["user_id", "event_type"], "_o").select("user_id", "event_type", "event_id")


def merge_cluster(spark, sf_dir):
    """Documents with one canonical text as one work: formats by type, data sources in order."""
    d = table(spark, sf_dir, "documents").where("doc_id is not null")
    e = F.struct((F.col("doc_id") % 3 + 1).cast("int").alias("edition_number"), F.lit(False).alias("is_latest"), F.array(F.struct(F.col("lang").alias("format_type"), F.col("doc_id").cast("string").alias("isbn"))).alias("formats"))
    rows = d.select(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("work_id"), F.col("doc_id").alias("_ord"), F.array(e).alias("editions"), F.array("source").alias("data_sources"))
    out = model.merge_editions(rows, ["work_id"])
    return out.select("work_id", F.col("_ord").alias("first_id"), F.size("editions").alias("n_editions"), F.array_join("data_sources", ",").alias("sources"), model.latest_edition()["edition_number"].alias("latest"), model.latest_edition()["formats"][0]["isbn"].alias("latest_isbn"))


MERGED = """
WITH d AS (SELECT md5(coalesce(text, '')) AS work_id, doc_id, source, lang, CAST(doc_id % 3 + 1 AS INTEGER) AS number FROM documents),
s AS (SELECT work_id, string_agg(source, ',' ORDER BY first_at) AS sources FROM (SELECT work_id, source, min(doc_id) AS first_at FROM d GROUP BY ALL) GROUP BY 1)
SELECT work_id, min(doc_id) AS first_id, CAST(count(DISTINCT number) AS INTEGER) AS n_editions, any_value(sources) AS sources, max(number) AS latest,
  CAST(arg_min(doc_id, (-number, doc_id)) AS VARCHAR) AS latest_isbn FROM d JOIN s USING (work_id) GROUP BY work_id"""


def tag_union(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("a"), F.collect_set("o_orderpriority").alias("b"))
    return o.select("o_custkey", F.array_join(F.array_sort(F.array_union("a", "b")), ",").alias("tags"))


def cascade_delete(spark, sf_dir):
    t = {"works": table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("work_id")), "formats": table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("work_id"), "l_partkey")}
    gone = t["works"].where("work_id % 5 = 0")
    return views.table_counts(model.delete_works(t, gone))


def union_sources(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.lit("customer").alias("_src"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("_src"))
    return model.union_all([c, s])


def per_file_migration(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return model.pick(d, ["source", "key"], "doc_id").select("source", "key", "doc_id")


def dedup_exact_tiers(spark, sf_dir):
    f = table(spark, sf_dir, "documents").where("doc_id is not null").select(F.col("doc_id").alias("id"), F.md5(F.lower(F.coalesce("text", F.lit(""))).cast("binary")).alias("key"))
    first = f.groupBy("key").agg(F.min("id").alias("leader"))
    return f.join(first, "key").select("id", "leader")


def dup_groups(spark, sf_dir):
    f = table(spark, sf_dir, "documents").where("doc_id is not null").select(F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    return matching.dup_groups(f, "key").select("key", F.size("ids").alias("n"), F.array_join("ids", ",").alias("ids"))


def index_stats(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.lit(None).cast("string").alias("author"), F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("isbn"))
    return matching.index_stats(matching.match_forms(p, compose=False))


def dup_checker_keys(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    items = p.select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("A"), F.lpad(F.col("page_id").cast("string"), 9, "0"))).alias("asin"), F.concat(F.lit("http://x/dp/B"), F.lpad(F.col("page_id").cast("string"), 9, "0")).alias("url"))
    known = p.where("page_id % 6 = 0").select(F.concat(F.lit("A"), F.lpad(F.col("page_id").cast("string"), 9, "0")).alias("asin"))
    isbns = p.where("page_id % 5 = 1").select(F.concat(F.lit("B"), F.lpad(F.col("page_id").cast("string"), 9, "0")).alias("isbn"))
    return matching.duplicate_check(items, known, isbns).select("id", "key", "kind")


def keywords(spark) -> DataFrame:
    return spark.createDataFrame(KEYWORDS, "kw_ord int, keyword string, segment string, subsegment string")


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def kw_classify(spark, sf_dir):
    return classify.classify(_docs(spark, sf_dir), keywords(spark)).select("id", "segment", "subsegment", "hits", F.round("confidence", 6).alias("confidence"), "is_ambiguous")


def kw_top_cells(spark, sf_dir):
    return classify.top_cells(_docs(spark, sf_dir), keywords(spark), 3).select("id", "segment", "subsegment", "hits", "rank")


def decided(spark, sf_dir) -> DataFrame:
    best = classify.classify(_docs(spark, sf_dir), keywords(spark)).withColumnsRenamed({"segment": "new_segment", "subsegment": "new_subsegment"})
    third = F.col("doc_id") % 3 == 0
    old = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.when(third, "Common").otherwise(F.col("lang")).alias("segment"), F.when(third, "Ending").otherwise(F.col("source")).alias("subsegment"))
    return classify.decide(best.join(old, "id"))


def classify_decision(spark, sf_dir):
    return decided(spark, sf_dir).select("id", F.array_join("reasons", ",").alias("reasons"), "decision")


def routed(spark, sf_dir) -> DataFrame:
    d = decided(spark, sf_dir).where("size(reasons) > 0")
    verdict = F.struct(F.lit(None).cast("boolean").alias("exists"), F.lit(None).cast("boolean").alias("is_finance_related"), F.lit(None).cast("boolean").alias("is_inappropriate"), F.lit(None).cast("string").alias("recommended_action"), F.lit(None).cast("boolean").alias("is_notation_variation"), (F.col("id") % 2 == 0).alias("apply_suggestion"))
    return review.route(d.withColumn("title", F.lit("")).withColumn("has_results", F.col("id") % 4 < 3).withColumn("verdict", verdict))


ROUTED = f"WITH {DECIDED}, q AS (SELECT *, CASE WHEN list_contains(reasons, 'SEGMENT_CHANGE') THEN 'segment_change' WHEN list_contains(reasons, 'LOW_CONFIDENCE') THEN 'low_confidence' ELSE 'multiple_matches' END AS handler FROM e WHERE len(reasons) > 0), a AS (SELECT *, CASE WHEN handler = 'segment_change' THEN CASE WHEN confidence >= 0.7 THEN 'UPDATE_SEGMENT' ELSE 'SKIP' END WHEN id % 4 = 3 THEN 'SKIP' WHEN id % 2 = 0 AND confidence >= 0.7 THEN 'UPDATE_SEGMENT' ELSE 'KEEP_ORIGINAL' END AS action FROM q)"


def review_route(spark, sf_dir):
    return routed(spark, sf_dir).select("id", "handler", "action")


def review_apply(spark, sf_dir):
    master = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("work_id"), F.col("lang").alias("segment"), F.col("source").alias("subsegment"))
    return review.apply_actions(master, routed(spark, sf_dir).withColumnRenamed("id", "work_id").select("work_id", "action", "new_segment", "new_subsegment"))


def action_stats(spark, sf_dir):
    return review.action_stats(routed(spark, sf_dir))


def changelog_filter(spark, sf_dir):
    data = F.when(F.col("id") % 3 == 0, F.create_map(F.lit("k"), F.lit("v")))
    return review.changelog(routed(spark, sf_dir).withColumn("before", data).withColumn("after", F.lit(None).cast("map<string,string>"))).select("id", "action")


def explode_counts(spark, sf_dir):
    return views.exploded_count(decided(spark, sf_dir), "reasons")


def transition_counts(spark, sf_dir):
    d = decided(spark, sf_dir).where("decision = 'apply'")
    return views.transitions(d, "segment", "new_segment")


def auto_applied(spark, sf_dir):
    return decided(spark, sf_dir).where("decision = 'apply'").select("id", "segment", "new_segment", F.round("confidence", 6).alias("confidence"))


def validate_errors(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rules = [validate.between("c_acctbal", 0, 9000), validate.one_of("c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"]), validate.matches("c_name", "[02468]$"), validate.required("c_nationkey")]
    return validate.violations(c, rules, ["c_custkey"])


def unique_violations(spark, sf_dir):
    return validate.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def load_stats(spark, sf_dir):
    return validate.load_stats(labelled(spark, sf_dir), [validate.between("n_chars", 100)], F.col("quality").isNotNull())


def topics(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.groupBy(F.col("p_brand").alias("segment"), F.col("p_type").alias("subsegment")).agg(F.array_sort(F.collect_set("p_name")).alias("keywords_en")).withColumn("keywords_ja", F.array().cast("array<string>"))


def keyword_worklist(spark, sf_dir):
    t = topics(spark, sf_dir)
    done = t.where("subsegment like 'P%'").select(T.keyword_id(F.element_at("keywords_en", 1), F.lit("en")).alias("keyword_id"), F.lit("completed").alias("status"))
    return collect.worklist(t, done).select("keyword_id", "keyword", "segment", "subsegment")


def per_keyword_topn(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("rank", F.struct(-F.col("o_totalprice"), "o_orderkey"))
    return collect.top_per_keyword(o, 2, "o_custkey", "rank").select("o_custkey", "o_orderkey")


def search_progress(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 == 0, "asin").when(F.col("event_id") % 5 == 1, "fuzzy").when(F.col("event_id") % 5 == 2, "title_normalized").alias("kind"), (F.col("event_id") % 7 == 0).alias("filtered"))
    return collect.progress(e)


def resume_skip(spark, sf_dir):
    from biblioforge.sources.io import pending

    return pending(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


def pending_by_reason(spark, sf_dir):
    d = decided(spark, sf_dir).select(F.col("id").alias("work_id"), "reasons")
    return review.pending(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("work_id")), ["MULTIPLE_MATCHES"]).select("work_id")


def enrich_fill_missing(spark, sf_dir):
    """Orders whose priority is not known get it from the customer's segment."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = o.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("publisher"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).alias("price"))
    rows = rows.join(c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("found_publisher"), F.col("c_acctbal").alias("found_price")), "o_custkey", "left")
    return enrich.fill_missing(rows, ["publisher", "price"], "lookup", {"publisher": ["Unknown"]}).select("o_orderkey", "publisher", "price", F.array_join("changes", ",").alias("changes"))


def lookup_isbn_or_title(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    records = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("isbn"), F.concat(F.lit("t"), F.col("l_suppkey")).alias("title"))
    a = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("isbn"), F.lit(0).alias("ord"), F.col("p_name").alias("entry"))
    b = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.concat(F.lit("t"), F.col("s_suppkey")).alias("title"), F.lit(0).alias("ord"), F.col("s_name").alias("entry"))
    return enrich.lookup(records, a, b).select("id", "line", "isbn", "found")


def lookup_writeback(spark, sf_dir):
    new = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("_new"))
    c = table(spark, sf_dir, "customer").join(new, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select("c_custkey", F.coalesce("_new", "c_acctbal").alias("c_acctbal"))


def status_promotion(spark, sf_dir):
    d = labelled(spark, sf_dir)
    status = enrich.promoted_status(F.col("quality").isNotNull(), F.coalesce(F.col("quality") == 1, F.lit(False)), F.coalesce(F.col("toxic") == 0, F.lit(False)), F.col("n_chars") > 500, F.lit("draft"))
    return d.select("doc_id", status.alias("status"))


def review_flags(spark, sf_dir):
    has = {"isbn": F.col("quality").isNotNull(), "price": F.coalesce(F.col("quality") == 1, F.lit(False)), "valid_url": F.coalesce(F.col("toxic") == 0, F.lit(False)), "description": F.col("n_chars") > 500}
    return labelled(spark, sf_dir).select("doc_id", F.array_join(enrich.review_flags(has), ",").alias("flags"))


def page_to_record(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("title"), F.lit("By A B and C D").alias("author_text"), F.col("p_type").alias("format_text"), F.concat(F.lit("$"), F.col("p_size")).alias("price_text"), F.lit("0123456789").alias("isbn"), F.col("p_name").alias("description"), F.col("p_brand").alias("publisher"), F.lit("June 2021").alias("date_text"), F.col("p_partkey").cast("string").alias("url"))
    r = model.page_record(p, "S", "U", 2024)
    e = F.col("editions")[0]
    return r.select("title", F.array_join("authors", "|").alias("authors"), "publisher", e["publication_year"].alias("year"), e["formats"][0]["price"]["amount"].alias("amount"), e["formats"][0]["url"].alias("url"))


def search_to_record(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("asin"), F.col("p_name").alias("title"), F.array("p_brand").alias("authors"), F.col("p_retailprice").alias("price_amount"), F.lit("USD").alias("currency"), F.lit("u").alias("url"), F.lit("s").alias("segment"), F.lit("t").alias("subsegment"), F.col("p_type").alias("keyword"))
    r = model.search_record(p)
    return r.select("work_id", "title", F.col("topics")[0].alias("topic"), F.col("editions")[0]["formats"][0]["price"]["amount"].alias("amount"), F.col("provenance.source").alias("source"))


def content_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return collect.content_filter(p, "p_name", ["red", "blue"], ["green"], 100, "p_partkey").select("p_partkey", "klass", "kept")


def blacklist_action(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("title", F.when(F.col("p_partkey") % 6 == 0, F.concat("p_name", F.lit(" 攻略"))).otherwise(F.col("p_name")))
    return p.select("p_partkey", review.off_topic("title", F.col("p_partkey") % 4 == 0).alias("off_topic"))


def topic_counts(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("segment_num"), F.col("p_brand").alias("segment")).agg(F.count("*").alias("n")).orderBy("segment_num", "segment")


def table_counts(spark, sf_dir):
    return views.table_counts({n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "part", "customer")})


def quality_metrics(spark, sf_dir):
    w = works(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("work_id"), F.year("o_orderdate").alias("publication_year")), "work_id")
    return views.quality_metrics(w).withColumn("validated_ratio", F.round("validated_ratio", 6))


def taxonomy_list(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    nested_segments = n.join(r, n.n_regionkey == r.r_regionkey).groupBy(F.col("r_name").alias("segment")).agg(F.collect_list(F.struct(F.col("n_name").alias("subsegment"))).alias("subsegments"))
    return classify.taxonomy(nested_segments)


def taxonomy_semi(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_orderstatus").alias("segment"), F.col("o_orderpriority").alias("subsegment"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("segment"), F.col("o_orderpriority").alias("subsegment"))
    return classify.valid_cells(rows, cells).select("o_orderkey", "is_valid")


def usage_totals(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return classify.usage(c.select(F.when(F.col("role") == "user", F.length("text")).otherwise(0).cast("long").alias("input_tokens"), F.when(F.col("role") != "user", F.length("text")).otherwise(0).cast("long").alias("output_tokens")))


def dry_run_changes(spark, sf_dir):
    """The change rows of a merge without writing it."""
    d = decided(spark, sf_dir).where("decision in ('apply', 'update')")
    return d.select("id", F.col("segment").alias("old_segment"), "new_segment")


def retention_newest10(spark, sf_dir):
    from biblioforge.sources.io import expired_backups

    o = table(spark, sf_dir, "orders").select("o_custkey", F.concat(F.lit("backup_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("name"))
    return expired_backups(o, 10, ["o_custkey"])


def in_and_limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).orderBy("o_orderkey").limit(50).select("o_orderkey", "o_orderpriority")


def selected_keywords(spark, sf_dir):
    return collect.selected(topics(spark, sf_dir), "Brand#11").select("segment", "subsegment", F.size("keywords_en").alias("n"))


def is_nested_record(spark, sf_dir):
    r = table(spark, sf_dir, "documents").join(nested(spark, sf_dir), F.col("doc_id") == F.col("work_id"), "left")
    return r.select("doc_id", model.is_nested().alias("is_nested"))


def windowed_events(spark, sf_dir):
    from biblioforge.streaming.incremental import windowed_counts

    return windowed_counts(table(spark, sf_dir, "events"), "1 day")


def stream_equals_batch(spark, sf_dir):
    """Events through the incremental path, by files: the first of each user stays."""
    from biblioforge.store import fresh
    from biblioforge.streaming.incremental import add_stream

    root = fresh(spark, "stream")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    e.write.json(f"{root}/in")
    add_stream(spark, f"{root}/in", "event_id long, user_id long, event_type string", f"{root}/master", f"{root}/checkpoint", "user_id", "event_id")
    return spark.read.parquet(f"{root}/master").select("user_id", "event_id")


_FLAG = "quality IS NOT NULL AS f1, n_chars > 1000 AS f2"
_COUNTS = "count(*) AS total, count(*) FILTER (f1) AS with_label, count(*) - count(*) FILTER (f1) AS missing_label, count(*) FILTER (f2) AS with_length, count(*) - count(*) FILTER (f2) AS missing_length"


def _coverage(build):
    return lambda spark, sf_dir: build(spark, works(spark, sf_dir))


def _segments(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment")).union(spark.createDataFrame([("NEW",)], "segment string"))


QUERIES = {
    "coverage": (_coverage(lambda s, w: views.coverage(w)), f"WITH {WORKS} SELECT segment, subsegment, perspective, language, count(DISTINCT work_id) AS book_count, count(DISTINCT CASE WHEN dataset_status = 'validated' THEN work_id END) AS validated_count FROM works GROUP BY ALL"),
    "coverage_long": (_coverage(lambda s, w: views.coverage_long(w)), f"{LONG} SELECT * FROM long"),
    "coverage_pivot": (_coverage(lambda s, w: views.coverage_pivot(views.coverage_long(w), STATUSES)), f"{LONG} SELECT segment, " + ", ".join(f"CAST(coalesce(sum(cnt) FILTER (perspective = '{v}'), 0) AS BIGINT) AS \"{v}\"" for v in STATUSES) + " FROM long GROUP BY 1"),
    "gaps": (_coverage(lambda s, w: views.gaps(views.coverage_long(w), GAP)), f"{LONG} SELECT * FROM long WHERE cnt < {GAP}"),
    "gaps_dense": (lambda s, d: views.gaps_dense(views.coverage_long(works(s, d)), _segments(s, d), STATUSES, GAP), f"{LONG}, cells AS (SELECT DISTINCT segment, p AS perspective FROM (SELECT c_mktsegment AS segment FROM customer UNION SELECT 'NEW'), (VALUES ('F'), ('O'), ('P')) v(p)) SELECT segment, perspective, coalesce(cnt, 0) AS cnt FROM cells LEFT JOIN long USING (segment, perspective) WHERE coalesce(cnt, 0) < {GAP}"),
    "books_flat": (books_flat, f"WITH {_L}, f AS (SELECT l.* FROM l JOIN latest USING (work_id, edition_number)), a AS (SELECT work_id, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS authors FROM l JOIN part ON isbn = CAST(p_partkey AS VARCHAR) GROUP BY 1), g AS (SELECT work_id, string_agg(DISTINCT isbn, ',' ORDER BY isbn) AS isbns, string_agg(DISTINCT format_type, ',' ORDER BY format_type) AS formats FROM f GROUP BY 1) SELECT o_orderkey AS work_id, o_orderstatus AS title, authors, edition_number, publication_year, isbns, formats FROM orders LEFT JOIN a ON a.work_id = o_orderkey LEFT JOIN latest ON latest.work_id = o_orderkey LEFT JOIN g ON g.work_id = o_orderkey"),
    "recent_latest": (recent_latest, f"WITH {_L} SELECT work_id, publication_year FROM latest JOIN orders ON work_id = o_orderkey WHERE publication_year >= 1997"),
    "isbn_lookup": (isbn_lookup, f"WITH {_L} SELECT l.work_id, edition_number, isbn FROM l JOIN orders ON work_id = o_orderkey WHERE isbn = '77'"),
    "nested_totals": (nested_totals, "WITH e AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL), w AS (SELECT l_orderkey, count(*) AS e, sum(n) AS f FROM e GROUP BY 1) SELECT count(*) AS works, CAST(sum(e) AS BIGINT) AS editions, CAST(sum(f) AS BIGINT) AS formats, round(avg(e), 2) AS editions_per_work FROM w"),
    "unnest_tables": (unnest_tables, "SELECT l_orderkey AS work_id, l_linenumber AS edition_number, CAST(l_partkey AS VARCHAR) AS isbn, l_returnflag AS format_type, round(l_extendedprice, 2) AS amount FROM lineitem"),
    "group_counts": (lambda s, d: views.group_count(table(s, d, "customer"), "c_mktsegment"), "SELECT coalesce(c_mktsegment, 'unknown') AS c_mktsegment, count(*) AS n FROM customer GROUP BY 1"),
    "top10": (lambda s, d: views.group_count(table(s, d, "orders"), "o_custkey").limit(10), "SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10"),
    "view_top10": (lambda s, d: table(s, d, "orders").where("o_orderstatus = 'F'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10).select("o_orderkey", "o_custkey"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 10"),
    "explode_counts": (explode_counts, f"WITH {DECIDED} SELECT unnest(reasons) AS value, count(*) AS n FROM e GROUP BY 1"),
    "completeness": (completeness, f"WITH {LABELLED}, f AS (SELECT {_FLAG} FROM labelled) SELECT {_COUNTS}, printf('%.1f%%', 100.0 * count(*) FILTER (f1) / count(*)) AS share_label, printf('%.1f%%', 100.0 * count(*) FILTER (f2) / count(*)) AS share_length FROM f"),
    "completeness_by_lang": (completeness_by_lang, f"WITH {LABELLED}, f AS (SELECT lang, {_FLAG} FROM labelled) SELECT lang, {_COUNTS} FROM f GROUP BY ROLLUP (lang)"),
    "incomplete": (incomplete, f"WITH {LABELLED} SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'label' END, CASE WHEN NOT n_chars > 1000 THEN 'length' END) AS missing FROM labelled WHERE quality IS NULL OR NOT n_chars > 1000"),
    "upsert_last_wins": (upsert_last_wins, "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1"),
    "merge_first_wins": (merge_first_wins, "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL"),
    "merge_cluster": (merge_cluster, MERGED),
    "tag_union": (tag_union, "WITH t AS (SELECT o_custkey, o_orderstatus AS v FROM orders UNION SELECT o_custkey, o_orderpriority FROM orders) SELECT o_custkey, string_agg(v, ',' ORDER BY v) AS tags FROM t GROUP BY 1"),
    "cascade_delete": (cascade_delete, "SELECT 'works' AS name, count(*) AS n FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT 'formats', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0)"),
    "union_sources": (union_sources, "SELECT c_name AS name, c_nationkey AS nation, 'customer' AS _src FROM customer UNION ALL SELECT s_name, NULL, 'supplier' FROM supplier"),
    "per_file_migration": (per_file_migration, "SELECT source, md5(coalesce(text, '')) AS key, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2"),
    "dedup_exact_tiers": (dedup_exact_tiers, "SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY lower(coalesce(text, ''))) AS leader FROM documents WHERE doc_id IS NOT NULL"),
    "dup_groups": (dup_groups, "SELECT md5(coalesce(text, '')) AS key, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM documents WHERE doc_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    "index_stats": (index_stats, "WITH f AS (SELECT lower(p_name) AS norm, replace(lower(p_name), ' ', '') AS agg FROM part) SELECT count(*) AS total_books, (SELECT count(*) FROM part) AS isbn_entries, count(DISTINCT norm) AS normalized_entries, count(DISTINCT agg) AS aggressive_entries, (SELECT count(DISTINCT g) FROM (SELECT unnest(list_transform(range(1, greatest(length(agg) - 1, 2)), lambda i: agg[i:i+2])) AS g FROM f)) AS ngram_entries FROM f"),
    "dup_checker_keys": (dup_checker_keys, "SELECT page_id AS id, CASE WHEN page_id % 2 = 0 THEN 'A' ELSE 'B' END || lpad(CAST(page_id AS VARCHAR), 9, '0') AS key, CASE WHEN page_id % 6 = 0 THEN 'asin' WHEN page_id % 2 = 1 AND page_id % 5 = 1 THEN 'isbn' END AS kind FROM pages"),
    "kw_classify": (kw_classify, f"WITH {CLASSES} SELECT id, segment, subsegment, hits, CAST(round(confidence, 6) AS DOUBLE) AS confidence, is_ambiguous FROM best"),
    "kw_top_cells": (kw_top_cells, f"WITH {HITS} SELECT id, segment, subsegment, hits, CAST(n AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hits DESC, first) AS n FROM hits) WHERE n <= 3"),
    "classify_decision": (classify_decision, f"WITH {DECIDED} SELECT id, array_to_string(reasons, ',') AS reasons, decision FROM e"),
    "review_route": (review_route, f"{ROUTED} SELECT id, handler, action FROM a"),
    "review_apply": (review_apply, f"{ROUTED} SELECT doc_id AS work_id, CASE WHEN action = 'UPDATE_SEGMENT' THEN a.segment ELSE lang END AS segment, CASE WHEN action = 'UPDATE_SEGMENT' THEN a.subsegment ELSE source END AS subsegment FROM documents LEFT JOIN a ON id = doc_id"),
    "action_stats": (action_stats, f"{ROUTED} SELECT action, count(*) AS n FROM a GROUP BY 1"),
    "changelog_filter": (changelog_filter, f"{ROUTED} SELECT id, action FROM a WHERE action <> 'SKIP' OR id % 3 = 0"),
    "transition_counts": (transition_counts, f"WITH {DECIDED} SELECT old_segment || ' -> ' || segment AS transition, count(*) AS n FROM e WHERE decision = 'apply' GROUP BY 1"),
    "auto_applied": (auto_applied, f"WITH {DECIDED} SELECT id, old_segment AS segment, segment AS new_segment, CAST(round(confidence, 6) AS DOUBLE) AS confidence FROM e WHERE decision = 'apply'"),
    "dry_run_changes": (dry_run_changes, f"WITH {DECIDED} SELECT id, old_segment, segment AS new_segment FROM e WHERE decision IN ('apply', 'update')"),
    "validate_errors": (validate_errors, "SELECT c_custkey, '''c_acctbal'' is out of range' AS message FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000 UNION ALL SELECT c_custkey, '''c_mktsegment'' is not one of the allowed values' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') UNION ALL SELECT c_custkey, '''c_name'' does not match [02468]$' FROM customer WHERE NOT regexp_matches(c_name, '[02468]$') UNION ALL SELECT c_custkey, '''c_nationkey'' is a required property' FROM customer WHERE c_nationkey IS NULL"),
    "unique_violations": (unique_violations, "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
    "load_stats": (load_stats, f"WITH {LABELLED} SELECT count(*) AS total_records, count(*) FILTER (quality IS NOT NULL AND n_chars >= 100) AS v2_records, count(*) FILTER (quality IS NULL) AS v1_skipped, count(*) FILTER (quality IS NOT NULL AND n_chars < 100) AS errors FROM labelled"),
    "keyword_worklist": (keyword_worklist, "WITH t AS (SELECT p_brand AS segment, p_type AS subsegment, list_sort(list(DISTINCT p_name)) AS k FROM part GROUP BY 1, 2), w AS (SELECT segment, subsegment, unnest(k) AS keyword FROM t), d AS (SELECT DISTINCT k[1] AS keyword FROM t WHERE subsegment LIKE 'P%') SELECT substr(md5('en:' || keyword), 1, 12) AS keyword_id, keyword, segment, subsegment FROM w WHERE keyword NOT IN (SELECT keyword FROM d)"),
    "per_keyword_topn": (per_keyword_topn, "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 2"),
    "search_progress": (search_progress, "WITH e AS (SELECT CASE event_id % 5 WHEN 0 THEN 'asin' WHEN 1 THEN 'fuzzy' WHEN 2 THEN 'title_normalized' END AS kind, event_id % 7 = 0 AS filtered FROM events) SELECT count(*) AS found, count(*) FILTER (kind IS NULL AND NOT filtered) AS added, count(*) FILTER (filtered) AS filtered, count(kind) AS duplicates, count(*) FILTER (kind = 'asin') AS dup_asin, count(*) FILTER (kind = 'isbn') AS dup_isbn, count(*) FILTER (kind = 'fuzzy') AS dup_fuzzy FROM e"),
    "pending_anti": (resume_skip, "SELECT doc_id, lang FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)"),
    "pending_by_reason": (pending_by_reason, f"WITH {DECIDED} SELECT id AS work_id FROM e WHERE is_ambiguous AND id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"),
    "enrich_fill_missing": (enrich_fill_missing, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE coalesce(c_mktsegment, '') END AS publisher, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE c_acctbal END AS price, concat_ws(',', CASE WHEN o_orderkey % 2 <> 0 AND c_mktsegment IS NOT NULL THEN 'publisher:lookup' END, CASE WHEN o_orderkey % 3 <> 0 AND c_acctbal IS NOT NULL THEN 'price:lookup' END) AS changes FROM orders LEFT JOIN customer ON o_custkey = c_custkey"),
    "lookup_isbn_or_title": (lookup_isbn_or_title, "SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS isbn, coalesce(p_name, s_name) AS found FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 2 = 0 LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 3 = 0"),
    "lookup_writeback": (lookup_writeback, "SELECT c_custkey, coalesce(m, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) ON o_custkey = c_custkey"),
    "status_promotion": (status_promotion, f"WITH {LABELLED} SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 AND n_chars > 500 THEN 'verified' ELSE 'draft' END AS status FROM labelled"),
    "review_flags": (review_flags, f"WITH {LABELLED}, h AS (SELECT doc_id, quality IS NOT NULL AS a, coalesce(quality = 1, false) AS b, coalesce(toxic = 0, false) AS c, n_chars > 500 AS d FROM labelled) SELECT doc_id, concat_ws(',', CASE WHEN NOT a THEN 'NO_ISBN_FOUND' END, CASE WHEN NOT c THEN 'URL_VALIDATION_FAILED' END, CASE WHEN (NOT a)::INT + (NOT b)::INT + (NOT c)::INT + (NOT d)::INT >= 3 THEN 'MISSING_CRITICAL_DATA' END) AS flags FROM h"),
    "page_to_record": (page_to_record, "SELECT p_name AS title, 'A B|C D' AS authors, p_brand AS publisher, 2021 AS year, CAST(p_size AS DOUBLE) AS amount, CAST(p_partkey AS VARCHAR) AS url FROM part"),
    "search_to_record": (search_to_record, "SELECT 'amz_' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS work_id, p_name AS title, p_type AS topic, p_retailprice AS amount, 'store_search' AS source FROM part"),
    "content_filter": (content_filter, "WITH k AS (SELECT p_partkey, CASE WHEN regexp_matches(lower(p_name), 'red|blue') THEN 'beginner' WHEN regexp_matches(lower(p_name), 'green') THEN 'irrelevant' ELSE 'ok' END AS klass FROM part) SELECT p_partkey, klass, klass = 'ok' AND row_number() OVER (PARTITION BY klass ORDER BY p_partkey) <= 100 AS kept FROM k"),
    "blacklist_action": (blacklist_action, "SELECT p_partkey, p_partkey % 4 <> 0 AND p_partkey % 6 = 0 AS off_topic FROM part"),
    "topic_counts": (topic_counts, "SELECT p_size AS segment_num, p_brand AS segment, count(*) AS n FROM part GROUP BY 1, 2"),
    "table_counts": (table_counts, "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'customer', count(*) FROM customer"),
    "quality_metrics": (quality_metrics, f"WITH {WORKS} SELECT segment, round(avg(CASE WHEN dataset_status = 'validated' THEN 1 ELSE 0 END), 6) AS validated_ratio, CAST(max(year(o_orderdate)) AS INTEGER) AS newest_year, count(DISTINCT year(o_orderdate)) AS years FROM works JOIN orders ON o_orderkey = work_id GROUP BY 1"),
    "taxonomy_list": (taxonomy_list, "SELECT r_name AS segment, n_name AS subsegment FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "taxonomy_semi": (taxonomy_semi, "SELECT o_orderkey, (o_orderstatus, o_orderpriority) IN (SELECT (o_orderstatus, o_orderpriority) FROM orders WHERE o_totalprice > 400000) AS is_valid FROM orders"),
    "usage_totals": (usage_totals, "SELECT count(*) AS total_calls, CAST(sum(CASE WHEN role = 'user' THEN length(text) ELSE 0 END) AS BIGINT) AS input_tokens, CAST(sum(CASE WHEN role <> 'user' THEN length(text) ELSE 0 END) AS BIGINT) AS output_tokens, CAST(sum(length(text)) AS BIGINT) AS total_tokens FROM conversations"),
    "retention_newest10": (retention_newest10, "SELECT o_custkey, name FROM (SELECT o_custkey, 'backup_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS name, row_number() OVER (PARTITION BY o_custkey ORDER BY lpad(CAST(o_orderkey AS VARCHAR), 9, '0') DESC) AS n FROM orders) WHERE n > 10"),
    "in_and_limit": (in_and_limit, "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY o_orderkey LIMIT 50"),
    "selected_keywords": (selected_keywords, "SELECT p_brand AS segment, p_type AS subsegment, CAST(count(DISTINCT p_name) AS INTEGER) AS n FROM part WHERE p_brand = 'Brand#11' GROUP BY 1, 2"),
    "is_nested_record": (is_nested_record, "SELECT doc_id, doc_id IN (SELECT l_orderkey FROM lineitem) AS is_nested FROM documents"),
    "windowed_events": (windowed_events, "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL"),
    "stream_equals_batch": (stream_equals_batch, "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1"),
}
