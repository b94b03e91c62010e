"""Queries of the sources and guarded loads, with their DuckDB twins."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioforge.operators import collect, review
from biblioforge.operators.guard import Constraints, guarded_load, read_quarantine
from biblioforge.operators.json_schema import validate_json
from biblioforge.operators.model_client import ModelClient, Reply, ReplyTable, classify_records
from biblioforge.plans.relational import table
from biblioforge.sources import io
from biblioforge.sources.crawl import Category, Crawl, StoredSite, register_crawl, store_site
from biblioforge.sources.versions import Snapshots
from biblioforge.store import fresh
from biblioforge.streaming.incremental import windowed_counts
from biblioforge.streaming.keyword_states import keyword_states, replay

CATEGORIES = 12
_BROKEN = "(page * 5 + length(category)) % 7 = 3"


def site(spark: SparkSession, sf_dir: str) -> Crawl:
    """The pages as a site: twelve categories by host, twenty items to a listing page, every seventh listing page broken."""
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    number = F.conv(F.substring(F.md5(host), 1, 2), 16, 10).cast("int") % CATEGORIES
    items = table(spark, sf_dir, "pages").select(F.concat(F.lit("c"), number).alias("category"), "page_id", "url", F.concat(F.lit("Page "), F.col("page_id")).alias("title"), F.length("html").alias("size"))
    categories = [Category(f"https://site.example/c{k}", f"Segment {k % 4}", f"Part {k}") for k in range(CATEGORIES)]
    return Crawl(StoredSite(store_site(items, "page_id", broken=F.expr(_BROKEN))), categories)


def _crawled(df: DataFrame) -> DataFrame:
    return df.select("category", "segment", "subsegment", "page", "pos", "title", F.col("fields")["page_id"].cast("long").alias("page_id"), F.col("fields")["size"].cast("long").alias("size"), "error")


def crawl_batch(spark, sf_dir):
    register_crawl(spark, "pages_site", site(spark, sf_dir))
    return _crawled(spark.read.format("pages_site").load())


def crawl_stream(spark, sf_dir):
    """The same crawl as a stream that begins with three listing pages per category and batch and then catches up, stopped and started again on the way."""
    crawl = site(spark, sf_dir)
    crawl.pages_per_batch, crawl.catch_up = 3, True
    register_crawl(spark, "pages_stream", crawl)
    out, state = fresh(spark, "crawled"), fresh(spark, "crawl-state")
    for limit in (2, None):
        crawl.max_pages = limit
        register_crawl(spark, "pages_stream", crawl)
        stream = spark.readStream.format("pages_stream").load().writeStream.format("parquet").option("checkpointLocation", state).start(out)
        stream.processAllAvailable()
        stream.stop()
    return _crawled(spark.read.parquet(out))


_CRAWL = f"""WITH p AS (SELECT 'c' || CAST(('0x' || substr(md5(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), 1, 2)) AS INTEGER) % {CATEGORIES} AS category, page_id, length(html) AS size FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY page_id) - 1 AS n FROM p),
l AS (SELECT category, CAST(n // 20 + 1 AS INTEGER) AS page, CAST(n % 20 AS INTEGER) AS pos, page_id, size FROM n),
r AS (SELECT category, page, pos, 'Page ' || page_id AS title, page_id, size, NULL AS error FROM l WHERE NOT {_BROKEN}
  UNION ALL SELECT DISTINCT category, page, NULL, NULL, NULL, NULL, 'JSONDecodeError' FROM l WHERE {_BROKEN})
SELECT 'https://site.example/' || category AS category, 'Segment ' || CAST(substr(category, 2) AS INTEGER) % 4 AS segment, 'Part ' || substr(category, 2) AS subsegment, page, pos, title, page_id, size, error FROM r"""

def strict_scan(spark, sf_dir):
    """Orders as JSON Lines files in the order of their keys, some lines cut short: key and number over all files of every line."""
    o, path = table(spark, sf_dir, "orders"), fresh(spark, "strict")
    line = F.to_json(F.struct("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice")))
    cut = F.substring_index(line, ",", 1)  # behind the key, however long it is
    lines = o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select(F.when(F.col("o_orderkey") % 1000 == 7, cut).otherwise(line).alias("value"))
    lines.write.text(path)
    rows = io.numbered_lines(spark, path)
    key = F.regexp_extract("value", '"o_orderkey":([0-9]+)', 1).cast("long").alias("key")
    files = rows.select("_src", key).groupBy("_src").agg(F.count("*").alias("n"), F.min("key").alias("low"))  # a row a file
    files = files.select("_src", F.coalesce(F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(files, "_src").select(key, (F.col("line") + F.col("before")).alias("line"), io.is_malformed("value").alias("malformed"))


_LINE = {
    "type": "object", "required": ["part", "qty"], "additionalProperties": False,
    "properties": {"part": {"type": "integer"}, "qty": {"type": "number", "maximum": 45}, "flag": {"type": "string", "enum": ["A", "N"]}, "price": {"type": "object", "required": ["amount", "currency"], "properties": {"amount": {"type": "number", "exclusiveMinimum": 1000}, "currency": {"type": "string"}}}},
}
ORDER_SCHEMA = {
    "type": "object", "required": ["id", "status", "lines"], "additionalProperties": False,
    "properties": {"id": {"type": "integer", "minimum": 100}, "status": {"enum": ["F", "O"]}, "priority": {"type": "string", "pattern": "^[1-3]"}, "lines": {"type": "array", "minItems": 1, "items": _LINE}},
}


def schema_errors(spark, sf_dir):
    """Orders with their lines as nested JSON against a schema: every error with its path."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("qty"), F.col("l_extendedprice").cast("double").alias("amount"), "l_returnflag")
    price = F.struct(F.col("amount"), F.when(F.col("l_partkey") % 7 > 0, "USD").alias("currency"))
    item = F.struct(F.col("l_partkey").alias("part"), F.when(F.col("l_partkey") % 11 > 0, F.col("qty")).alias("qty"), F.col("l_returnflag").alias("flag"), price.alias("price"), F.when(F.col("l_partkey") % 13 == 0, F.lit("x")).alias("odd"))
    lines = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "qty", "amount", item.alias("item")))).alias("x"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    items = F.coalesce(F.transform("x", lambda x: x["item"]), F.expr("transform(slice(x, 1, 0), y -> y.item)"))
    row = F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"), F.when(F.col("x").isNull(), F.array().cast(lines.selectExpr("transform(x, y -> y.item) AS i").schema["i"].dataType)).otherwise(items).alias("lines"))
    return validate_json(o.select(F.col("o_orderkey").alias("id"), F.to_json(row).alias("value")), ORDER_SCHEMA).select("id", "path", "keyword")


_SCHEMA = """WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey), p AS (SELECT *, '$.lines[' || i || ']' AS place FROM l)
SELECT o_orderkey AS id, '$.id' AS path, 'minimum' AS keyword FROM orders WHERE o_orderkey < 100
UNION ALL SELECT o_orderkey, '$', 'required' FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, '$.status', 'enum' FROM orders WHERE o_orderkey % 5 > 0 AND o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT o_orderkey, '$.priority', 'pattern' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]')
UNION ALL SELECT o_orderkey, '$.lines', 'minItems' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT l_orderkey, place, 'required' FROM p WHERE l_partkey % 11 = 0
UNION ALL SELECT l_orderkey, place, 'additionalProperties' FROM p WHERE l_partkey % 13 = 0
UNION ALL SELECT l_orderkey, place || '.qty', 'maximum' FROM p WHERE l_partkey % 11 > 0 AND l_quantity > 45
UNION ALL SELECT l_orderkey, place || '.flag', 'enum' FROM p WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT l_orderkey, place || '.price', 'required' FROM p WHERE l_partkey % 7 = 0
UNION ALL SELECT l_orderkey, place || '.price.amount', 'exclusiveMinimum' FROM p WHERE l_extendedprice <= 1000"""


def _load(spark, sf_dir) -> tuple[str, dict, list]:
    """Customers, orders and lines with planted faults, loaded under constraints."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", (k * 2).alias("at"))
    orders = orders.union(orders.where("o_orderkey % 29 = 6").withColumn("at", F.col("at") + 1))
    orders = orders.withColumn("o_orderstatus", F.when(k % 17 == 3, "X").when(k % 19 == 4, None).otherwise(F.col("o_orderstatus"))).withColumn("o_custkey", F.when(k % 23 == 5, -1).otherwise(F.col("o_custkey")))
    # The first of some repeated orders is broken, so the second one is no repetition.
    orders = orders.withColumn("o_orderstatus", F.when((k % 58 == 6) & (F.col("at") % 2 == 0), "X").otherwise(F.col("o_orderstatus")))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    lines = lines.withColumn("l_partkey", F.when(F.col("l_partkey") % 31 == 7, None).when(F.col("l_partkey") % 37 == 8, -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    customer, part = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), table(spark, sf_dir, "part").select("p_partkey")
    tables = {
        "customer": (customer, Constraints(required=["c_custkey"], unique={"key": ["c_custkey"]}, order="c_custkey")),
        "part": (part, Constraints(required=["p_partkey"])),
        "orders": (orders, Constraints(required=["o_orderstatus"], checks={"status": F.col("o_orderstatus").isin("F", "O", "P")}, foreign={"customer": (["o_custkey"], "customer", ["c_custkey"])}, unique={"key": ["o_orderkey"]}, order="at")),
        "lineitem": (lines, Constraints(checks={"quantity": F.col("l_quantity") <= 40}, foreign={"order": (["l_orderkey"], "orders", ["o_orderkey"]), "part": (["l_partkey"], "part", ["p_partkey"])})),
    }
    path = fresh(spark, "guarded")
    return path, tables, guarded_load(spark, tables, path)


def state_snapshots(spark, sf_dir):
    """A state of order statuses in four snapshots, each made from the one before, then the second one restored."""
    s = Snapshots(spark, fresh(spark, "state"), "o_orderkey long, status string, saves int", keep=3)
    s.save(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("saves")))
    for n in (2, 3, 4):
        s.save(s.load().withColumn("status", F.when(F.col("o_orderkey") % 4 == n % 4, F.lit(f"v{n}")).otherwise(F.col("status"))).withColumn("saves", F.col("saves") + 1))
    s.restore(2)
    return s.load().groupBy("status", "saves").agg(F.count("*").alias("n"))


def guarded_load_counts(spark, sf_dir):
    return spark.createDataFrame(_load(spark, sf_dir)[2], "table string, outcome string, n long")


def quarantine_rows(spark, sf_dir):
    path, tables, _ = _load(spark, sf_dir)
    rows = lambda name, key, number: read_quarantine(spark, path, name, tables[name][0]).select(F.lit(name).alias("table"), F.col(key).alias("key"), F.col(number).cast("long").alias("number"), F.array_join("_broken", " ").alias("broken"))
    return rows("orders", "o_orderkey", "at").union(rows("lineitem", "l_orderkey", "l_linenumber"))


_GUARD = """WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 23 = 5 THEN -1 ELSE o_custkey END AS c, CASE WHEN o_orderkey % 17 = 3 THEN 'X' WHEN o_orderkey % 19 = 4 THEN NULL ELSE o_orderstatus END AS s, o_orderkey * 2 AS nr FROM orders),
twice AS (SELECT k, c, CASE WHEN k % 58 = 6 THEN 'X' ELSE s END AS s, nr FROM o UNION ALL SELECT k, c, s, nr + 1 FROM o WHERE k % 29 = 6),
judged AS (SELECT *, concat_ws(' ', CASE WHEN s IS NULL THEN 'required:o_orderstatus' END, CASE WHEN s NOT IN ('F', 'O', 'P') THEN 'check:status' END, CASE WHEN c NOT IN (SELECT c_custkey FROM customer) THEN 'foreign:customer' END) AS b FROM twice),
orders_in AS (SELECT *, CASE WHEN b = '' AND nr > (SELECT min(nr) FROM judged j WHERE j.k = judged.k AND j.b = '') THEN 'unique:key' ELSE b END AS broken FROM judged),
l AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_partkey % 31 = 7 THEN NULL WHEN l_partkey % 37 = 8 THEN -l_partkey ELSE l_partkey END AS p, l_quantity AS q FROM lineitem),
lines_in AS (SELECT k, n, concat_ws(' ', CASE WHEN q > 40 THEN 'check:quantity' END, CASE WHEN k NOT IN (SELECT k FROM orders_in WHERE broken = '') THEN 'foreign:order' END, CASE WHEN p IS NOT NULL AND p NOT IN (SELECT p_partkey FROM part) THEN 'foreign:part' END) AS broken FROM l),
all_rows AS (SELECT 'customer' AS "table", c_custkey AS key, 0 AS number, '' AS broken FROM customer UNION ALL SELECT 'part', p_partkey, 0, '' FROM part UNION ALL SELECT 'orders', k, nr, broken FROM orders_in UNION ALL SELECT 'lineitem', k, n, broken FROM lines_in)"""
_COUNTS = _GUARD + """, rules AS (SELECT * FROM (VALUES ('customer', 'required:c_custkey'), ('customer', 'unique:key'), ('part', 'required:p_partkey'), ('orders', 'required:o_orderstatus'), ('orders', 'check:status'), ('orders', 'foreign:customer'), ('orders', 'unique:key'), ('lineitem', 'check:quantity'), ('lineitem', 'foreign:order'), ('lineitem', 'foreign:part')) r("table", outcome))
SELECT "table", 'loaded' AS outcome, count(*) FILTER (broken = '') AS n FROM all_rows GROUP BY 1 UNION ALL SELECT "table", 'rejected', count(*) FILTER (broken <> '') FROM all_rows GROUP BY 1
UNION ALL SELECT rules."table", outcome, (SELECT count(*) FROM all_rows a WHERE a."table" = rules."table" AND list_contains(string_split(a.broken, ' '), outcome)) FROM rules"""

def _chunks(spark, sf_dir) -> list[DataFrame]:
    """The events in five deliveries by time; from the second on, with repeated rows of the last hours and with made-up rows that come far too late, and at the end one that closes all times."""
    utc = F.expr("make_timestamp_ltz(year(ts), month(ts), day(ts), hour(ts), minute(ts), extract(SECOND FROM ts), 'UTC')")  # whatever the session's zone
    e = table(spark, sf_dir, "events").select("event_id", utc.alias("ts"), (F.col("user_id") * 1000 + F.dayofyear("ts")).alias("keyword_id"), "event_type", "value").where("ts is not null and event_id is not null")
    low, high = e.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    at, step = F.unix_micros("ts"), (high - low) // 5 + 1
    number = F.floor((at - low) / step)
    out = []
    for k in range(5):
        rows = e.where(number == k)
        if k:
            begin = low + k * step
            rows = rows.union(e.where((at < begin) & (at >= begin - 7_200_000_000) & (F.col("event_id") % 2 == 0)))
            late = e.where((number == 0) & (F.col("event_id") % 3 == k % 3)) if k > 1 else e.where("false")
            rows = rows.union(late.select((-1 - F.col("event_id")).alias("event_id"), "ts", "keyword_id", F.lit("purchase").alias("event_type"), "value"))
        out.append(rows)
    end = spark.range(1).select(F.lit(-10**15).cast("long").alias("event_id"), F.timestamp_micros(F.lit(high + 30 * 86_400_000_000)).alias("ts"), F.lit(-1).cast("long").alias("keyword_id"), F.lit("error").alias("event_type"), F.lit(None).cast("double").alias("value"))
    return [*out, end]


def keyword_state_stream(spark, sf_dir):
    """Purchases and errors as results of one keyword per user and day."""
    results = [c.where("event_type in ('purchase', 'error')").select("event_id", "keyword_id", "ts", (F.col("event_type") == "purchase").alias("ok"), F.col("value").alias("added")) for c in _chunks(spark, sf_dir)]
    buckets = table(spark, sf_dir, "events").count() // 500 + 1  # of about 130 keywords
    out = replay(results, lambda s: keyword_states(s, "2 hours", 720, buckets=buckets))
    return out.select("keyword_id", F.unix_micros("at").alias("at"), "status", "attempts", F.round("added", 6).alias("added"))


def windowed_stream(spark, sf_dir):
    """Counts of six hours and type from the same deliveries, as windows close."""
    out = replay(_chunks(spark, sf_dir), lambda s: windowed_counts(s.withWatermark("ts", "2 hours").dropDuplicatesWithinWatermark(["event_id"]), "6 hours"))
    return out.select(F.unix_micros("window_start").alias("window_start"), "event_type", "n")


_STATES = """WITH e AS (SELECT user_id * 1000 + dayofyear(ts) AS k, epoch_us(ts) AS t, event_id, event_type = 'purchase' AS ok, value FROM events WHERE event_type IN ('purchase', 'error')),
o AS (SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER w, 0) AS done, coalesce(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER w, 0) AS failed, lead(t) OVER (PARTITION BY k ORDER BY t, event_id) AS nxt FROM e WINDOW w AS (PARTITION BY k ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, CAST(failed + CASE WHEN ok THEN 0 ELSE 1 END AS INTEGER) AS attempts FROM o WHERE done = 0 AND failed < 3),
d AS (SELECT *, t + CAST(least(30, 5 * pow(2, attempts - 1)) * 720 * 1000000 AS BIGINT) AS due FROM a WHERE NOT ok AND attempts < 3)
SELECT k AS keyword_id, t AS at, CASE WHEN ok THEN 'completed' ELSE 'failed' END AS status, attempts, CASE WHEN ok THEN round(value, 6) END AS added FROM a
UNION ALL SELECT k, due, 'pending', attempts, NULL FROM d WHERE nxt IS NULL OR nxt >= due"""

_CELLS = [("Common", "Part"), ("Common", "Tool"), ("Nouns", "Colour"), ("Nouns", "Size")]


def _stub(broken: bool):
    """A provider without a network: the verdict follows from the title's length; some titles fail, give no JSON or a made-up cell."""

    def make():
        class Stub(ModelClient):
            provider = "stub"

            def call(self, question: str) -> Reply:
                title = question.split("Title: ")[1].split("\n")[0]
                kind = len(title) % 7 if broken else 6
                if kind == 0:
                    raise ConnectionError("no answer")
                segment, subsegment = ("Odd", "Cell") if kind == 1 else _CELLS[len(title) % 4]
                reply = json.dumps({"segment": segment, "subsegment": subsegment, "confidence": len(title) / 20, "reasoning": title})
                return Reply("I can't tell." if kind == 2 else f"Here:\n```json\n{reply}\n```", len(question), len(reply))

        return Stub()

    return make


def _parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("description"))
    return docs, spark.createDataFrame(_CELLS, "segment string, subsegment string")


def model_classify_batch(spark, sf_dir):
    """All parts by a model's replies; equal questions are asked once."""
    docs, cells = _parts(spark, sf_dir)
    out, _ = classify_records(docs, _stub(True), cells, ReplyTable(spark, fresh(spark, "replies")))
    return out.select("id", "segment", "subsegment", "confidence", "error", "error_kind", "is_valid")


def model_usage(spark, sf_dir):
    """Calls and tokens of three runs on one reply table: half of the parts, all parts, all parts again."""
    docs, cells = _parts(spark, sf_dir)
    replies, rows = ReplyTable(spark, fresh(spark, "replies")), []
    for run, some in ((1, docs.where("id % 2 = 0 and length(title) > 8")), (2, docs), (3, docs)):
        usage = classify_records(some, _stub(False), cells, replies)[1]
        rows.append((run, usage["calls"], usage["failed"], usage["output_tokens"]))
    return spark.createDataFrame(rows, "run int, calls long, failed long, output_tokens long")


_STUB = """WITH d AS (SELECT p_partkey AS id, p_name AS title, p_type AS description, length(p_name) % 7 AS kind, (['Common', 'Common', 'Nouns', 'Nouns'])[length(p_name) % 4 + 1] AS s, (['Part', 'Tool', 'Colour', 'Size'])[length(p_name) % 4 + 1] AS u FROM part)"""

def search_addresses(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", collect.search_url("p_name", F.when(F.col("p_partkey") % 2 == 0, "ja").otherwise("en")).alias("url"))


def review_prompts(spark, sf_dir):
    """Mismatch questions about conversations: the first turn as a title, roles as authors, the turns as snippets."""
    turns = table(spark, sf_dir, "conversations").where("text is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    rows = turns.select("conv_id", F.left(F.col("t")[0]["text"], F.lit(40)).alias("title"), F.array_sort(F.array_distinct(F.col("t")["role"])).alias("authors"), F.col("t")["text"].alias("snippets"), F.col("t")[0]["role"].alias("other"))
    return rows.select("conv_id", review.review_prompt("mismatch", "title", "authors", "snippets", "other").alias("prompt"))


def hand_decisions(spark, sf_dir):
    """Typed answers applied to the orders as works: y takes the suggested cell, d deletes."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("work_id"), F.col("o_orderstatus").alias("segment"), F.col("o_orderpriority").alias("subsegment"))
    answers = o.where("work_id % 4 > 0").select("work_id", F.element_at(F.array(F.lit("y"), F.lit("d"), F.lit("k")), (F.col("work_id") % 4).cast("int")).alias("answer"), F.lit("N").alias("new_segment"), F.concat(F.lit("n"), F.col("work_id") % 7).alias("new_subsegment"))
    return review.decide_by_hand(o, answers)


QUERIES = {
    "search_addresses": (search_addresses, "SELECT p_partkey, 'https://www.amazon.' || CASE WHEN p_partkey % 2 = 0 THEN 'co.jp' ELSE 'com' END || '/s?k=' || replace(url_encode(p_name), '%20', '+') AS url FROM part"),
    "hand_decisions": (hand_decisions, "SELECT o_orderkey AS work_id, CASE WHEN o_orderkey % 4 = 1 THEN 'N' ELSE o_orderstatus END AS segment, CASE WHEN o_orderkey % 4 = 1 THEN 'n' || o_orderkey % 7 ELSE o_orderpriority END AS subsegment FROM orders WHERE o_orderkey % 4 <> 2"),
    "review_prompts": (review_prompts, f"""WITH t AS (SELECT conv_id, list(text ORDER BY turn, role, text) AS x, list(role ORDER BY turn, role, text) AS r FROM conversations WHERE text IS NOT NULL GROUP BY 1)
SELECT conv_id, 'Title: ' || substr(x[1], 1, 40) || chr(10) || 'Authors: ' || array_to_string(list_sort(list_distinct(r)), ', ') || chr(10) || 'Compared with: ' || r[1] || chr(10) || 'Search results:' || chr(10) || array_to_string(list_transform(range(1, least(len(x), 5) + 1), lambda i: i || '. ' || substr(x[i], 1, 200)), chr(10)) || chr(10) || '{review.ASKS["mismatch"].replace("'", "''")}' AS prompt FROM t"""),
    "model_classify_batch": (model_classify_batch, _STUB + """ SELECT id, CASE WHEN kind = 1 THEN 'Odd' WHEN kind NOT IN (0, 2) THEN s END AS segment, CASE WHEN kind = 1 THEN 'Cell' WHEN kind NOT IN (0, 2) THEN u END AS subsegment, CASE WHEN kind NOT IN (0, 2) THEN CAST(length(title) AS DOUBLE) / 20 END AS confidence,
  CASE kind WHEN 0 THEN 'ConnectionError: no answer' WHEN 1 THEN 'no such cell: Odd / Cell' WHEN 2 THEN 'no verdict' END AS error, CASE kind WHEN 0 THEN 'call' WHEN 1 THEN 'cell' WHEN 2 THEN 'reply' END AS error_kind, kind > 2 AS is_valid FROM d"""),
    "model_usage": (model_usage, _STUB + """, q AS (SELECT title, description, any_value(length('{"segment": "' || s || '", "subsegment": "' || u || '", "confidence": , "reasoning": "' || title || '"}') + length(CAST(CAST(length(title) AS DOUBLE) / 20 AS VARCHAR))) AS n, bool_or(id % 2 = 0 AND length(title) > 8) AS early FROM d GROUP BY 1, 2)
SELECT 1 AS run, count(*) FILTER (early) AS calls, 0 AS failed, coalesce(sum(n) FILTER (early), 0) AS output_tokens FROM q UNION ALL SELECT 2, count(*) FILTER (NOT early), 0, coalesce(sum(n) FILTER (NOT early), 0) FROM q UNION ALL SELECT 3, 0, 0, 0"""),
    "keyword_state_stream": (keyword_state_stream, _STATES),
    "windowed_stream": (windowed_stream, "SELECT (epoch_us(ts) // 21600000000) * 21600000000 AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL"),
    "crawl_batch": (crawl_batch, _CRAWL),
    "crawl_stream": (crawl_stream, _CRAWL),
    "strict_scan": (strict_scan, "SELECT o_orderkey AS key, row_number() OVER (ORDER BY o_orderkey) AS line, o_orderkey % 1000 = 7 AS malformed FROM orders"),
    "state_snapshots": (state_snapshots, "SELECT CASE WHEN o_orderkey % 4 = 2 THEN 'v2' ELSE o_orderstatus END AS status, 2 AS saves, count(*) AS n FROM orders GROUP BY 1"),
    "schema_errors": (schema_errors, _SCHEMA),
    "guarded_load_counts": (guarded_load_counts, _COUNTS),
    "quarantine_rows": (quarantine_rows, _GUARD + """ SELECT "table", key, CAST(number AS BIGINT) AS number, broken FROM all_rows WHERE broken <> '' """),
}
