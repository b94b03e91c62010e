"""Queries over a catalogue made of the parts: books with authors, ISBNs and near titles, four to a group. With their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators import collect, matching, model, views
from biblioforge.plans.relational import _L, CLASSES, WORKS, keywords, table, tables, works
from biblioforge.store import fresh, keep, parts_of_rows
from biblioforge.streaming.incremental import session_counts

# Of a group of four the second is the first in another writing, the third has another last letter, the fourth another
# title under the first one's ISBN. The third has the ISBN of another printing in every other group.
_G = "CAST(floor(p_partkey / 4) AS BIGINT)"
_LETTERS = "translate(md5(concat('{}', CAST({} AS {}))), '0123456789', 'ghijklmnop')"
_SPACED = "concat(substr({0}, 1, 6), ' ', substr({0}, 7, 6), ' ', substr({0}, 13, 6))"


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, author, isbn of every part."""
    p = table(spark, sf_dir, "part")
    p = p.repartition(max(2 * spark.sparkContext.defaultParallelism, parts_of_rows(p, 20_000)), "p_partkey")  # few bytes a row, much work: a small file would be one task
    p = p.select(F.col("p_partkey").alias("id"), F.expr(_G).alias("g"), F.expr("p_partkey % 4").alias("v"), F.expr(_LETTERS.format("b", _G, "STRING")).alias("h"), F.expr(_LETTERS.format("c", "p_partkey", "STRING")).alias("o"))
    w, own = _SPACED.format("h"), _SPACED.format("o")
    title = f"CASE v WHEN 0 THEN {w} WHEN 1 THEN concat(initcap({w}), ', 2nd Edition') WHEN 2 THEN concat(substr({w}, 1, 19), 'z') ELSE {own} END"
    author = "CASE v WHEN 0 THEN concat('Dr. ', substr(h, 19, 5), ' ', substr(h, 24, 5)) WHEN 3 THEN NULL ELSE concat(substr(h, 19, 5), ' ', substr(h, 24, 5)) END"
    isbn = "CASE WHEN v IN (0, 3) THEN concat('978-', lpad(CAST(g AS STRING), 9, '0'), '1') WHEN v = 2 AND g % 2 = 0 THEN concat('978', lpad(CAST(g AS STRING), 9, '0'), '2') END"
    return p.select("id", F.expr(title).alias("title"), F.expr(author).alias("author"), F.expr(isbn).alias("isbn"))


def forms(spark, sf_dir) -> DataFrame:
    return matching.match_forms(books(spark, sf_dir), compose=False)


_H = f"h AS (SELECT p_partkey AS id, {_G} AS g, p_partkey % 4 AS v, {_LETTERS.format('b', _G, 'VARCHAR')} AS h, {_LETTERS.format('c', 'p_partkey', 'VARCHAR')} AS o FROM part)"
_F = f"""{_H}, n AS (SELECT id, g, v, CASE v WHEN 2 THEN concat(substr({_SPACED.format('h')}, 1, 19), 'z') WHEN 3 THEN {_SPACED.format('o')} ELSE {_SPACED.format('h')} END AS norm,
  CASE WHEN v < 3 THEN substr(h, 19, 10) END AS who, CASE WHEN v IN (0, 3) THEN '978' || lpad(CAST(g AS VARCHAR), 9, '0') || '1' WHEN v = 2 AND g % 2 = 0 THEN '978' || lpad(CAST(g AS VARCHAR), 9, '0') || '2' END AS code FROM h),
f AS (SELECT *, replace(norm, ' ', '') AS agg FROM n)"""
_LEV = "(1 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE))"
_JAC = "CAST(len(list_intersect(string_split({a}, ' '), string_split({b}, ' '))) AS DOUBLE) / len(list_distinct(list_concat(string_split({a}, ' '), string_split({b}, ' '))))"
_SIM = f"greatest(0.6 * {_LEV.format(a='x.norm', b='y.norm')} + 0.4 * {_JAC.format(a='x.norm', b='y.norm')}, 0.6 * {_LEV.format(a='x.agg', b='y.agg')} + 0.4 * CASE WHEN x.agg = y.agg THEN 1.0 ELSE 0.0 END)"
_WHO = f"coalesce(x.who = y.who OR contains(x.who, y.who) OR contains(y.who, x.who) OR {_LEV.format(a='x.who', b='y.who')} >= 0.85, false)"


def _scored(pairs: str, raw: str) -> str:
    """CTEs p (a, b and what a pair is told by) and s (a, b, kind, c) over pairs `x`, `y`."""
    return f"""p AS (SELECT x.id AS a, y.id AS b, coalesce(x.code = y.code, false) AS by_code, x.norm = y.norm AS by_norm, x.agg = y.agg AS by_agg, {_WHO} AS who, {_SIM} AS sim FROM {pairs}),
z AS (SELECT *, least(1.0, sim + CASE WHEN who THEN 0.1 ELSE 0.0 END) AS fuzzy FROM p),
s AS (SELECT a, b, CASE WHEN by_code THEN 'isbn_exact' WHEN by_norm THEN 'title_normalized' WHEN by_agg THEN 'title_aggressive' WHEN fuzzy >= 0.9 THEN 'fuzzy_high' WHEN fuzzy >= 0.8 THEN 'fuzzy_medium' WHEN fuzzy >= 0.7 THEN 'fuzzy_low' ELSE 'no_match' END AS kind,
  CASE WHEN by_code THEN 1.0 WHEN by_norm THEN CASE WHEN who THEN 1.0 ELSE 0.95 END WHEN by_agg THEN CASE WHEN who THEN 0.95 ELSE 0.9 END ELSE fuzzy END AS c FROM z){raw}"""


def _candidates(overlap: float) -> str:
    return f"""grams AS (SELECT id, unnest(list_transform(range(1, length(agg) - 1), lambda i: agg[i:i+2])) AS g FROM f), q AS (SELECT id, g, count(*) AS times FROM grams GROUP BY ALL),
need AS (SELECT id, greatest(1, CAST(floor(sum(times) * {overlap}) AS BIGINT)) AS need FROM q GROUP BY 1),
cand AS (SELECT q.id AS q, r.id AS r, CAST(sum(times) AS BIGINT) AS shared FROM q JOIN (SELECT DISTINCT id, g FROM grams) r ON q.g = r.g JOIN need ON need.id = q.id GROUP BY 1, 2 HAVING sum(times) >= any_value(need))"""


def lev(a, b):
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)).cast("double")


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.col("l_id").alias("a"), F.col("r_id").alias("b"), "match_type", F.round("confidence", 6).alias("confidence"))


_OUT = "a, b, kind AS match_type, CAST(round(c, 6) AS DOUBLE) AS confidence"


def pairwise_bruteforce(spark, sf_dir):
    f = forms(spark, sf_dir)
    return _pairs(matching.brute_force(f, f, 0.8, similarity=lev, author_ratio=lev))


def match_pairs(spark, sf_dir):
    """The first of each group against the other three, whatever comes out."""
    f = keep(forms(spark, sf_dir), "forms")
    l, r = matching.sided(f, "l"), matching.sided(f, "r")
    pairs = l.where("l_id % 4 = 0").join(r, F.expr("floor(l_id / 4) = floor(r_id / 4) and r_id > l_id"))
    return _pairs(matching.score_pairs(pairs, lev, lev)).select("a", "b", "match_type", "confidence")


def ngram_candidates(spark, sf_dir):
    f = keep(forms(spark, sf_dir), "forms")
    return matching.ngram_candidates(f.select(F.col("id").alias("q"), F.col("agg").alias("text")), f.select(F.col("id").alias("r"), F.col("agg").alias("text"))).where("q <> r")


def all_matches(spark, sf_dir):
    f = forms(spark, sf_dir)
    return _pairs(matching.find_matches(f, f, 0.70, 0.2, similarity=lev, author_ratio=lev, best_only=False).where("l_id <> r_id"))


def best_match(spark, sf_dir):
    """Every later book of a group in a catalogue of the first ones."""
    f = forms(spark, sf_dir)
    return _pairs(matching.find_matches(f.where("id % 4 > 0"), f.where("id % 4 = 0"), similarity=lev, author_ratio=lev))


def kept_index_best(spark, sf_dir):
    """best_match() from an index on disk that got the first books in two batches and was compacted after."""
    from biblioforge.operators.kept_index import KeptIndex

    f = keep(forms(spark, sf_dir), "forms")
    index = KeptIndex(spark, fresh(spark, "kept-index"), 16)
    index.add(f.where("id % 8 = 0"))
    index.add(f.where("id % 8 = 4"))
    index.compact()
    return _pairs(index.find(f.where("id % 4 > 0"), similarity=lev, author_ratio=lev))


def greedy_merge(spark, sf_dir):
    """All books in the order of a hash of their ids, with the sequence ratio."""
    f = keep(forms(spark, sf_dir), "forms")
    return matching.greedy_merge(f.withColumn("ord", F.expr("conv(substr(md5(CAST(id AS STRING)), 1, 12), 16, 10)").cast("long")))


def index_add(spark, sf_dir):
    """An index of the first half of the books, with the other half added."""
    f = keep(forms(spark, sf_dir), "forms")
    half = F.pmod("id", F.lit(2)) == 0
    return matching.index_counts(matching.index_add(matching.index_tables(f.where(half)), f.where(~half)))


def dup_checker_fuzzy(spark, sf_dir):
    """Books of the second to fourth place against ASINs, ISBNs and titles of the first ones."""
    b = keep(books(spark, sf_dir), "books")
    items = b.where("id % 4 > 0").withColumn("asin", F.when(F.col("isbn").isNotNull(), F.col("isbn")).otherwise(F.when(F.col("id") % 8 == 5, F.concat(F.lit("A"), F.col("id"))))).withColumn("url", F.lit(""))
    # Two letters off is a confidence of 0.84: a match, but no duplicate.
    items = items.withColumn("title", F.when(F.col("id") % 16 == 6, F.concat(F.substring("title", 1, 18), F.lit("zz"))).otherwise(F.col("title")))
    known = b.where("id % 4 = 0")
    asins = b.where("id % 8 = 5").select(F.concat(F.lit("A"), F.col("id")).alias("asin"))
    out = matching.duplicate_check_all(items, asins, known.select("isbn"), matching.match_forms(known, compose=False), similarity=lev, author_ratio=lev)
    return out.select("id", "kind", "known_id", "match_type")


def flat_records(spark, sf_dir) -> DataFrame:
    """Books as flat records of the first format."""
    b = books(spark, sf_dir).join(table(spark, sf_dir, "part"), F.col("id") == F.col("p_partkey"))
    empty = ["subtitle", "series", "instrument_or_asset_class", "jurisdiction", "audience_level", "official_status", "related_regulation", "qualification_target", "notes", "recommended_for", "last_reviewed_at", "edition", "catalog_url", "perspective"]
    return b.select(
        F.col("id").cast("string").alias("record_id"), "title", F.when(F.col("author").isNotNull(), F.array("author")).alias("authors"), F.col("p_brand").alias("publisher"), F.lit("en").alias("language"), F.col("p_type").alias("segment"), F.lit("").alias("subsegment"),
        F.when(F.col("id") % 5 > 0, 2000 + F.col("id").cast("int") % 20).alias("publication_year"), F.array(F.lit("t")).alias("topics"), F.regexp_replace("isbn", "-", "").alias("isbn_or_issn"), F.lit("ebook").alias("format"), F.col("p_size").cast("int").alias("pages"),
        F.concat(F.lit("http://x/"), F.col("id")).alias("source_url"), F.lit("part").alias("data_source"), F.lit("validated").alias("dataset_status"), *[F.lit("").alias(c) for c in empty], F.col("id").alias("_ord"),
    )


def nested_works(spark, sf_dir) -> DataFrame:
    return model.convert_v1(flat_records(spark, sf_dir), "2024-01-01")


def nest_v2(spark, sf_dir):
    w, e = nested_works(spark, sf_dir), F.col("editions")[0]
    return w.select("work_id", "title", F.array_join("authors", "|").alias("authors"), "segment", "subsegment", e["edition_number"].alias("number"), e["publication_year"].alias("year"), e["formats"][0]["isbn"].alias("isbn"), e["formats"][0]["url"].alias("url"), F.array_join("data_sources", "|").alias("sources"))


_SLUG = "regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g')"
_BOOK = f"""{_H}, b AS (SELECT id, g, v, CASE v WHEN 0 THEN {_SPACED.format('h')} WHEN 1 THEN array_to_string(list_transform(string_split({_SPACED.format('h')}, ' '), lambda s: upper(s[1]) || s[2:]), ' ') WHEN 2 THEN concat(substr({_SPACED.format('h')}, 1, 19), 'z') ELSE {_SPACED.format('o')} END AS title,
  CASE v WHEN 0 THEN 'Dr. ' || substr(h, 19, 5) || ' ' || substr(h, 24, 5) WHEN 3 THEN NULL ELSE substr(h, 19, 5) || ' ' || substr(h, 24, 5) END AS author, CASE WHEN v IN (0, 3) THEN '978' || lpad(CAST(g AS VARCHAR), 9, '0') || '1' WHEN v = 2 AND g % 2 = 0 THEN '978' || lpad(CAST(g AS VARCHAR), 9, '0') || '2' END AS isbn FROM h),
w AS (SELECT id, {_SLUG} || '_' || substr(md5(lower(title) || CASE WHEN author IS NULL THEN '' ELSE '_' || lower(replace(author, '.', '')) END), 1, 12) AS work_id, title, author, p_type, isbn, v, CAST(CASE WHEN id % 5 > 0 THEN 2000 + id % 20 ELSE 2020 END AS INTEGER) AS year FROM b JOIN part ON p_partkey = id)"""


def presence_counts(spark, sf_dir):
    """Completeness of the nested works by the predicates inside editions and formats."""
    flags = {k: v for k, v in views.presence().items() if k in ("isbn", "price", "url", "valid_url", "description", "pages", "publisher")}
    return views.completeness(nested_works(spark, sf_dir), flags)


def enrich_chain(spark, sf_dir):
    """All works, half of them Japanese, through a catalogue by ISBN and volumes by ISBN or title; some entries are of other books."""
    from biblioforge.operators.chain import ENTRY, Source, enrich_works

    o = F.col("_ord")
    works = nested_works(spark, sf_dir).withColumn("language", F.when(o % 2 == 0, "ja").otherwise("en")).withColumn("publisher", F.when(o % 3 == 0, "Unknown").otherwise(F.col("publisher")))
    works = keep(works, "works")
    none = F.lit(None)
    isbn = F.col("editions")[0]["formats"][0]["isbn"]
    price = lambda test, currency: F.when(test, F.struct((o + 100).cast("double").alias("amount"), F.lit(currency).alias("currency"), none.cast("string").alias("price_type")))
    one = works.where(isbn.isNotNull() & (o % 5 < 3)).select(
        isbn.alias("isbn"), none.cast("string").alias("title"), o.alias("ord"),
        F.struct(isbn.alias("isbn"), price(o % 2 == 0, "JPY").alias("price"), none.cast("int").alias("pages"), F.when(o % 4 < 2, F.concat(F.lit("about "), o)).alias("description"), F.concat(F.lit("C"), o % 7).alias("publisher"), F.when(o % 7 == 0, "quite other words").otherwise(F.col("title")).alias("title"), none.cast("array<string>").alias("authors")).cast(ENTRY).alias("entry"),
    )
    new = F.concat(F.lit("979"), F.lpad(o.cast("string"), 10, "0"))
    two = works.where((o % 5 >= 2) | isbn.isNull()).select(
        isbn.alias("isbn"), F.when(o % 13 > 0, F.col("title")).alias("title"), o.alias("ord"),
        F.struct(F.coalesce(isbn, new).alias("isbn"), price(o % 3 > 0, "USD").alias("price"), none.cast("int").alias("pages"), F.when(o % 4 > 0, F.concat(F.lit("volume "), o)).alias("description"), F.lit("V").alias("publisher"), F.col("title").alias("title"), F.when(o % 11 == 0, F.array(F.lit("nobody"))).otherwise(F.col("authors")).alias("authors")).cast(ENTRY).alias("entry"),
    )
    out = enrich_works(works, [Source("catalogue", one, languages=["ja"]), Source("volumes", two, by_title=True)], "2024-02-02")
    f = F.col("editions")[0]["formats"][0]
    reviews = F.array_join(F.transform("reviews", lambda r: F.concat(r["source"], F.lit(":"), F.array_join(r["reasons"], "+"))), " ")
    return out.select(o.alias("id"), F.array_join("changes", " ").alias("changes"), reviews.alias("reviews"), f["isbn"].alias("isbn"), f["price"]["amount"].alias("price"), F.col("editions")[0]["description"].alias("description"), "publisher", F.array_join("flags", " ").alias("flags"))


def upsert_load(spark, sf_dir):
    """The relational load of all works, then of a delivery that replaces every third work by one without formats; row counts of the tables, read back."""
    from biblioforge.sources.io import write_tables

    w = keep(nested_works(spark, sf_dir), "works")
    again = w.where("_ord % 3 = 0").withColumn("editions", F.transform("editions", lambda e: e.withField("formats", F.slice(e["formats"], 1, 0))))
    path = fresh(spark, "tables")
    write_tables(model.upsert(model.flatten(w), model.flatten(again)), path)
    return views.table_counts({t: spark.read.parquet(f"{path}/{t}") for t in ("works", "authors", "topics", "data_sources", "editions", "formats")})


def html_extract_title_links(spark, sf_dir):
    p = collect.title_links(table(spark, sf_dir, "pages"))
    return p.select("page_id", "title", F.size("links").alias("n_links"), F.array_join("links", " ").alias("links"))


def kw_ambiguous(spark, sf_dir):
    from biblioforge.operators.classify import classify

    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return classify(d, keywords(spark)).where("is_ambiguous").groupBy("segment").agg(F.count("*").alias("n"))


def part_keywords(spark, sf_dir) -> DataFrame:
    """Five keywords of 4 or 5 letters for every part, in cells by size and brand."""
    p = table(spark, sf_dir, "part")
    p = p.select("p_partkey", "p_brand", "p_size").repartition(max(spark.sparkContext.defaultParallelism, parts_of_rows(p, 20_000)), "p_partkey")  # as in books()
    p = p.select("*", F.explode(F.expr("sequence(0, 4)")).alias("k"))
    letters = "substr(translate(md5(concat('k', CAST(p_partkey AS STRING), '-', CAST(k AS STRING))), '0123456789', 'nortsuilht'), 1, 4 + k % 2)"
    return p.select((F.col("p_partkey") * 5 + F.col("k")).cast("int").alias("kw_ord"), F.expr(letters).alias("keyword"), F.concat(F.lit("S"), F.col("p_size") % 7).alias("segment"), F.col("p_brand").alias("subsegment"))


def kw_many(spark, sf_dir):
    """The best cell of every document by the keywords of all parts: 10,000 of them at sf0.01."""
    from biblioforge.operators.classify import classify

    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return classify(d, part_keywords(spark, sf_dir)).select("id", "segment", "subsegment", "hits", "is_ambiguous", F.array_join("words", " ").alias("words"))


def user_sql(spark, sf_dir):
    """A question to the registered views in SQL."""
    t = tables(spark, sf_dir)
    t["works"] = works(spark, sf_dir).withColumn("title", F.col("perspective"))
    views.register(spark, t)
    return spark.sql("SELECT c.segment, count(*) AS n, max(f.publication_year) AS newest, any_value(c.validated) AS validated FROM v_books_flat f JOIN (SELECT segment, sum(validated_count) AS validated FROM v_coverage GROUP BY segment) c ON c.segment = f.segment WHERE f.authors LIKE '%Brand#11%' GROUP BY c.segment")


def session_events(spark, sf_dir):
    return session_counts(table(spark, sf_dir, "events"), "6 hours")


_ALL = f"""WITH {_F}, {_candidates(0.2)}, {_scored("cand JOIN f x ON x.id = cand.q JOIN f y ON y.id = cand.r", "")},
t AS (SELECT x.id AS a, y.id AS b, 1 AS tier, 'isbn_exact' AS kind, 1.0 AS c FROM f x JOIN f y ON x.code = y.code
  UNION ALL SELECT x.id, y.id, 2, 'isbn_prefix', 0.98 FROM f x JOIN f y ON substr(x.code, 1, 12) = substr(y.code, 1, 12)
  UNION ALL SELECT x.id, y.id, 3, 'title_normalized', 0.95 FROM f x JOIN f y ON x.norm = y.norm
  UNION ALL SELECT x.id, y.id, 4, 'title_aggressive', 0.90 FROM f x JOIN f y ON x.agg = y.agg
  UNION ALL SELECT a, b, 5, kind, c FROM s WHERE c >= 0.7),
best AS (SELECT a, b, kind, c FROM t WHERE a <> b QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY c DESC, tier) = 1) SELECT {_OUT} FROM best"""

_BEST = f"""WITH {_F}, {_candidates(0.3)}, {_scored("cand JOIN f x ON x.id = cand.q AND x.v > 0 JOIN f y ON y.id = cand.r AND y.v = 0", "")},
fresh AS (SELECT * FROM f WHERE v > 0), k AS (SELECT * FROM f WHERE v = 0),
t AS (SELECT x.id AS a, y.id AS b, 1 AS tier, 'isbn_exact' AS kind, 1.0 AS c FROM fresh x JOIN k y ON x.code = y.code
  UNION ALL SELECT x.id, y.id, 2, 'isbn_prefix', 0.98 FROM fresh x JOIN k y ON substr(x.code, 1, 12) = substr(y.code, 1, 12)
  UNION ALL SELECT x.id, y.id, 3, 'title_normalized', 0.95 FROM fresh x JOIN k y ON x.norm = y.norm
  UNION ALL SELECT x.id, y.id, 4, 'title_aggressive', 0.90 FROM fresh x JOIN k y ON x.agg = y.agg
  UNION ALL SELECT a, b, 5, kind, c FROM s WHERE c >= 0.8),
best AS (SELECT a, b, kind, c FROM t QUALIFY row_number() OVER (PARTITION BY a ORDER BY tier, c DESC, b) = 1) SELECT {_OUT} FROM best"""

_FAR = "(CAST(len(list_intersect(string_split(lower({a}), ' '), string_split(lower({b}), ' '))) AS DOUBLE) / greatest(len(list_distinct(string_split(lower({a}), ' '))), len(list_distinct(string_split(lower({b}), ' ')))) < 0.5)"
_CHAIN = f"""WITH {_BOOK}, x AS (SELECT b.id, b.title, b.author, replace(b.isbn, '-', '') AS isbn, b.id % 2 = 0 AS ja, CASE WHEN b.id % 3 = 0 THEN 'Unknown' ELSE p_brand END AS publisher FROM b JOIN part ON p_partkey = b.id),
one AS (SELECT isbn, arg_min({{'price': CASE WHEN id % 2 = 0 THEN CAST(id + 100 AS DOUBLE) END, 'about': CASE WHEN id % 4 < 2 THEN 'about ' || id END, 'publisher': 'C' || id % 7, 'title': CASE WHEN id % 7 = 0 THEN 'quite other words' ELSE title END}}, id) AS e FROM x WHERE isbn IS NOT NULL AND id % 5 < 3 GROUP BY 1),
vols AS (SELECT id, isbn, CASE WHEN id % 13 > 0 THEN title END AS title, {{'isbn': coalesce(isbn, '979' || lpad(CAST(id AS VARCHAR), 10, '0')), 'price': CASE WHEN id % 3 > 0 THEN CAST(id + 100 AS DOUBLE) END, 'about': CASE WHEN id % 4 > 0 THEN 'volume ' || id END, 'title': title, 'author': CASE WHEN id % 11 = 0 THEN 'nobody' ELSE author END}} AS e FROM x WHERE id % 5 >= 2 OR isbn IS NULL),
by_isbn AS (SELECT isbn, arg_min(e, id) AS e FROM vols WHERE isbn IS NOT NULL GROUP BY 1), by_title AS (SELECT title, arg_min(e, id) AS e FROM vols WHERE title IS NOT NULL GROUP BY 1),
a AS (SELECT x.*, CASE WHEN ja THEN one.e END AS e FROM x LEFT JOIN one ON one.isbn = x.isbn),
a1 AS (SELECT *, e IS NOT NULL AND {_FAR.format(a="title", b="e.title")} AS odd, e IS NOT NULL AND NOT {_FAR.format(a="title", b="e.title")} AS fine FROM a),
a2 AS (SELECT id, title, author, isbn, odd, CASE WHEN fine THEN e.price END AS price, CASE WHEN fine THEN e.about END AS about, CASE WHEN fine AND publisher = 'Unknown' THEN e.publisher ELSE publisher END AS publisher,
  concat_ws(' ', CASE WHEN fine AND e.price IS NOT NULL THEN 'price:catalogue' END, CASE WHEN fine AND e.about IS NOT NULL THEN 'description:catalogue' END, CASE WHEN fine AND publisher = 'Unknown' THEN 'publisher:catalogue' END) AS changes FROM a1),
v1 AS (SELECT a2.*, CASE WHEN a2.isbn IS NOT NULL THEN i.e ELSE t.e END AS e FROM a2 LEFT JOIN by_isbn i ON i.isbn = a2.isbn LEFT JOIN by_title t ON t.title = a2.title),
v2 AS (SELECT *, e IS NOT NULL AND coalesce({_FAR.format(a="title", b="e.title")}, false) AS far, coalesce(lower(e.author) <> lower(author), false) AS who FROM v1),
v3 AS (SELECT *, e IS NOT NULL AND NOT far AND NOT who AS fine FROM v2),
r AS (SELECT id, concat_ws(' ', nullif(changes, ''), CASE WHEN fine AND isbn IS NULL THEN 'isbn:volumes' END, CASE WHEN fine AND price IS NULL AND e.price IS NOT NULL THEN 'price:volumes' END, CASE WHEN fine AND about IS NULL AND e.about IS NOT NULL THEN 'description:volumes' END, CASE WHEN fine AND publisher = 'Unknown' THEN 'publisher:volumes' END) AS changes,
  concat_ws(' ', CASE WHEN odd THEN 'catalogue:TITLE_MISMATCH' END, CASE WHEN far OR who THEN 'volumes:' || concat_ws('+', CASE WHEN far THEN 'TITLE_MISMATCH' END, CASE WHEN who THEN 'AUTHOR_MISMATCH' END) END) AS reviews,
  CASE WHEN fine THEN coalesce(isbn, e.isbn) ELSE isbn END AS isbn, CASE WHEN fine THEN coalesce(price, e.price) ELSE price END AS price, CASE WHEN fine THEN coalesce(about, e.about) ELSE about END AS description, CASE WHEN fine AND publisher = 'Unknown' THEN 'V' ELSE publisher END AS publisher FROM v3)
SELECT *, concat_ws(' ', CASE WHEN isbn IS NULL THEN 'NO_ISBN_FOUND' END, 'URL_VALIDATION_FAILED', CASE WHEN CAST(isbn IS NULL AS INTEGER) + CAST(price IS NULL AS INTEGER) + CAST(description IS NULL AS INTEGER) + 1 >= 3 THEN 'MISSING_CRITICAL_DATA' END) AS flags FROM r"""

# Arrival as a recursion: one record a step, matched with the leaders so far. The sequence ratio is 2 * M / T, where M sums
# longest common blocks (the first in a, then in b), taken again to the left and to the right of each.
_GREEDY = f"""WITH RECURSIVE {_F}, o AS (SELECT *, substr(code, 1, 12) AS prefix, CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 12) AS BIGINT) AS ord FROM (SELECT id, norm, agg, coalesce(who, '') AS who, coalesce(replace(code, '-', ''), '') AS code FROM f)),
{_candidates(0.3)},
p AS (SELECT x.id AS a, y.id AS b, x.norm AS na, y.norm AS nb, x.agg AS ga, y.agg AS gb, x.who AS wa, y.who AS wb FROM cand JOIN o x ON x.id = q JOIN o y ON y.id = r WHERE y.ord < x.ord AND x.agg <> y.agg),
s AS MATERIALIZED (SELECT a, b, row_number() OVER () AS pid FROM (SELECT na AS a, nb AS b FROM p UNION SELECT ga, gb FROM p UNION SELECT wa, wb FROM p WHERE wa <> '' AND wb <> '')),
m AS (SELECT pid, i, j FROM (SELECT pid, a, b, i, unnest(range(1, length(b) + 1)) AS j FROM (SELECT *, unnest(range(1, length(a) + 1)) AS i FROM s)) WHERE a[i] = b[j]),
d AS (SELECT *, i - row_number() OVER (PARTITION BY pid, i - j ORDER BY i) AS island FROM m),
l AS MATERIALIZED (SELECT pid, i, j, count(*) OVER (PARTITION BY pid, i - j, island ORDER BY i DESC) AS run FROM d),
iv AS (SELECT pid, CAST(1 AS BIGINT) AS alo, length(a) + 1 AS ahi, CAST(1 AS BIGINT) AS blo, length(b) + 1 AS bhi, CAST(0 AS BIGINT) AS size FROM s UNION ALL
  SELECT pid, c.alo, c.ahi, c.blo, c.bhi, c.size FROM (SELECT pid, unnest([{{'alo': alo, 'ahi': t.i, 'blo': blo, 'bhi': t.j, 'size': t.k}}, {{'alo': t.i + t.k, 'ahi': ahi, 'blo': t.j + t.k, 'bhi': bhi, 'size': 0}}]) AS c FROM (
    SELECT pid, alo, ahi, blo, bhi, max_by({{'i': i, 'j': j, 'k': least(run, ahi - i, bhi - j)}}, (least(run, ahi - i, bhi - j), -i, -j)) AS t FROM iv JOIN l USING (pid) WHERE i >= alo AND i < ahi AND j >= blo AND j < bhi GROUP BY ALL))),
ratio AS (SELECT s.a, s.b, 2.0 * sum(size) / (length(s.a) + length(s.b)) AS r FROM iv JOIN s USING (pid) GROUP BY s.a, s.b, s.pid),
z AS (SELECT p.a, p.b, least(1.0, greatest(0.6 * n.r + 0.4 * {_JAC.format(a='na', b='nb')}, 0.6 * g.r)
  + CASE WHEN wa <> '' AND wb <> '' AND (wa = wb OR contains(wa, wb) OR contains(wb, wa) OR w.r >= 0.85) THEN 0.1 ELSE 0.0 END) AS c
  FROM p JOIN ratio n ON n.a = na AND n.b = nb JOIN ratio g ON g.a = ga AND g.b = gb LEFT JOIN ratio w ON w.a = wa AND w.b = wb),
e AS MATERIALIZED (SELECT x.id, y.id AS l, y.ord, CASE WHEN x.code = y.code THEN 1 WHEN x.prefix = y.prefix THEN 2 WHEN x.norm = y.norm THEN 3 ELSE 4 END AS tier, 0.0 AS less FROM o x JOIN o y ON y.ord < x.ord AND (x.code = y.code AND x.code <> '' OR x.prefix = y.prefix AND x.prefix <> '' OR x.norm = y.norm OR x.agg = y.agg)
  UNION ALL SELECT a, b, y.ord, 5, -c FROM z JOIN o y ON y.id = b WHERE c >= 0.8),
arriving AS (SELECT o.id, row_number() OVER (ORDER BY o.ord) AS n, list({{'l': l, 'by': (tier, less, e.ord)}}) FILTER (l IS NOT NULL) AS es FROM o LEFT JOIN e ON e.id = o.id GROUP BY o.id, o.ord),
run AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS leaders, CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS leader UNION ALL
  SELECT k, CASE WHEN best IS NULL THEN list_append(leaders, id) ELSE leaders END, id, coalesce(best, id) FROM (
    SELECT t.n AS k, leaders, t.id, list_min(list_transform(list_filter(coalesce(es, []), lambda x: list_contains(leaders, x.l)), lambda x: {{'by': x.by, 'l': x.l}})).l AS best FROM run JOIN arriving t ON t.n = run.n + 1))
SELECT id, leader FROM run WHERE n > 0"""

QUERIES = {
    "pairwise_bruteforce": (pairwise_bruteforce, f"WITH {_F}, {_scored('f x JOIN f y ON x.id < y.id', '')} SELECT {_OUT} FROM s WHERE c >= 0.8"),
    "match_pairs": (match_pairs, f"WITH {_F}, {_scored('f x JOIN f y ON x.g = y.g AND x.v = 0 AND y.v > 0', '')} SELECT {_OUT} FROM s"),
    "ngram_candidates": (ngram_candidates, f"WITH {_F}, {_candidates(0.3)} SELECT q, r, shared FROM cand WHERE q <> r"),
    "all_matches": (all_matches, _ALL),
    "best_match": (best_match, _BEST),
    "kept_index_best": (kept_index_best, _BEST),
    "greedy_merge": (greedy_merge, _GREEDY),
    "index_add": (index_add, f"WITH {_F} SELECT 'isbn' AS name, count(DISTINCT code) AS entries FROM f UNION ALL SELECT 'isbn_prefix', count(DISTINCT substr(code, 1, 12)) FROM f UNION ALL SELECT 'norm', count(DISTINCT norm) FROM f UNION ALL SELECT 'agg', count(DISTINCT agg) FROM f UNION ALL SELECT 'gram', (SELECT count(DISTINCT g) FROM (SELECT unnest(list_transform(range(1, length(agg) - 1), lambda i: agg[i:i+2])) AS g FROM f))"),
    "dup_checker_fuzzy": (dup_checker_fuzzy, "SELECT p_partkey AS id, CASE WHEN p_partkey % 8 = 5 THEN 'asin' WHEN p_partkey % 4 = 3 THEN 'isbn' WHEN p_partkey % 16 = 6 THEN NULL ELSE 'fuzzy' END AS kind, CASE WHEN p_partkey % 8 = 5 OR p_partkey % 4 = 3 OR p_partkey % 16 = 6 THEN NULL ELSE p_partkey - p_partkey % 4 END AS known_id, CASE WHEN p_partkey % 8 = 5 OR p_partkey % 4 = 3 OR p_partkey % 16 = 6 THEN NULL WHEN p_partkey % 4 = 1 THEN 'title_normalized' WHEN (p_partkey - 2) % 8 = 0 THEN 'isbn_prefix' ELSE 'fuzzy_medium' END AS match_type FROM part WHERE p_partkey % 4 > 0"),
    "nest_v2": (nest_v2, f"WITH {_BOOK} SELECT work_id, title, author AS authors, p_type AS segment, 'General' AS subsegment, CASE WHEN v = 1 THEN 2 ELSE 1 END AS number, year, isbn, 'http://x/' || id AS url, 'part' AS sources FROM w"),
    "presence_counts": (presence_counts, f"WITH {_BOOK} SELECT count(*) AS total, count(*) FILTER (isbn IS NOT NULL) AS with_isbn, count(*) FILTER (NOT (isbn IS NOT NULL)) AS missing_isbn, printf('%.1f%%', 100.0 * count(*) FILTER (isbn IS NOT NULL) / count(*)) AS share_isbn, count(*) FILTER (false) AS with_price, count(*) FILTER (NOT (false)) AS missing_price, printf('%.1f%%', 100.0 * count(*) FILTER (false) / count(*)) AS share_price, count(*) FILTER (true) AS with_url, count(*) FILTER (NOT (true)) AS missing_url, printf('%.1f%%', 100.0 * count(*) FILTER (true) / count(*)) AS share_url, count(*) FILTER (false) AS with_valid_url, count(*) FILTER (NOT (false)) AS missing_valid_url, printf('%.1f%%', 100.0 * count(*) FILTER (false) / count(*)) AS share_valid_url, count(*) FILTER (false) AS with_description, count(*) FILTER (NOT (false)) AS missing_description, printf('%.1f%%', 100.0 * count(*) FILTER (false) / count(*)) AS share_description, count(*) FILTER (p_size > 0) AS with_pages, count(*) FILTER (NOT (p_size > 0)) AS missing_pages, printf('%.1f%%', 100.0 * count(*) FILTER (p_size > 0) / count(*)) AS share_pages, count(*) FILTER (true) AS with_publisher, count(*) FILTER (NOT (true)) AS missing_publisher, printf('%.1f%%', 100.0 * count(*) FILTER (true) / count(*)) AS share_publisher FROM w JOIN part ON w.id = p_partkey"),
    "enrich_chain": (enrich_chain, _CHAIN),
    "upsert_load": (upsert_load, f"WITH {_BOOK} SELECT 'works' AS name, count(*) AS n FROM w UNION ALL SELECT 'authors', count(author) FROM w UNION ALL SELECT 'topics', count(*) FROM w UNION ALL SELECT 'data_sources', count(*) FROM w UNION ALL SELECT 'editions', count(*) FROM w UNION ALL SELECT 'formats', count(*) FILTER (id % 3 <> 0) FROM w"),
    "html_extract_title_links": (html_extract_title_links, "SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, CAST(len(regexp_extract_all(html, '(?i)<a\\s[^>]*?href=\"([^\"]*)\"', 1)) AS INTEGER) AS n_links, coalesce(array_to_string(regexp_extract_all(html, '(?i)<a\\s[^>]*?href=\"([^\"]*)\"', 1), ' '), '') AS links FROM pages"),
    "kw_ambiguous": (kw_ambiguous, f"WITH {CLASSES} SELECT segment, count(*) AS n FROM best WHERE is_ambiguous GROUP BY 1"),
    "kw_many": (kw_many, """WITH kw AS (SELECT p_partkey * 5 + k AS kw_ord, substr(translate(md5('k' || p_partkey || '-' || k), '0123456789', 'nortsuilht'), 1, CAST(4 + k % 2 AS BIGINT)) AS keyword, 'S' || p_size % 7 AS segment, p_brand AS subsegment FROM part, range(5) t(k)),
low AS (SELECT doc_id AS id, lower(text) AS t FROM documents), subs AS (SELECT DISTINCT id, substr(t, i, n) AS s FROM (SELECT id, t, n, unnest(range(1, length(t) - n + 2)) AS i FROM low, (VALUES (4), (5)) v(n))),
hits AS (SELECT id, segment, subsegment, count(*) AS hits, min(kw_ord) AS first, list(keyword ORDER BY kw_ord)[1:5] AS words FROM subs JOIN kw ON s = keyword GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER w AS n, lead(hits) OVER w AS nxt FROM hits WINDOW w AS (PARTITION BY id ORDER BY hits DESC, first))
SELECT id, segment, subsegment, hits, coalesce(nxt >= 0.8 * hits, false) AS is_ambiguous, array_to_string(words, ' ') AS words FROM ranked WHERE n = 1"""),
    "user_sql": (user_sql, f"WITH {WORKS}, {_L}, c AS (SELECT segment, count(DISTINCT CASE WHEN dataset_status = 'validated' THEN work_id END) AS validated FROM works GROUP BY 1), a AS (SELECT DISTINCT work_id FROM l JOIN part ON isbn = CAST(p_partkey AS VARCHAR) WHERE p_brand LIKE '%Brand#11%') SELECT segment, count(*) AS n, max(publication_year) AS newest, any_value(validated) AS validated FROM works JOIN a USING (work_id) JOIN latest USING (work_id) JOIN c USING (segment) GROUP BY 1"),
    "session_events": (session_events, "WITH o AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM o) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, number"),
}
