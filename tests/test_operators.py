import json
import random

import pandas as pd
from pyspark.sql import functions as F

from biblioforge import schemas
from biblioforge.functions import text as T
from biblioforge.operators import classify, collect, enrich, matching, model, review, validate, views
from biblioforge.operators.graph import components
from biblioforge.sources import io


def test_tolerant_and_strict_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"k": 1}\n\n{bad\n{"k": 2}\n')
    assert sorted(r.k for r in io.read_json_lines(spark, str(p), "k int").collect()) == [1, 2]
    assert io.read_json_lines(spark, str(tmp_path / "none"), "k int").count() == 0
    assert [r.line for r in io.numbered_lines(spark, str(p)).orderBy("line").collect()] == [1, 2, 3, 4]
    p.write_text('{"k": 1}\n\n{"k": 2}\n')
    assert [(r.line, r.k) for r in io.read_json_lines_strict(spark, str(p), "k int").orderBy("line").collect()] == [(1, 1), (3, 2)]


def test_markdown_headers_reset(spark, tmp_path):
    p = tmp_path / "t.md"
    p.write_text("## 1. 銀行 (Banking)\n### 1-1. 融資 (Loans)\n- **与信 (Credit):** credit, 与信\n## 2. 保険 (Insurance)\n- **年金 (Annuity):** annuity\n")
    rows = io.parse_headed_markdown(io.numbered_lines(spark, str(p))).orderBy("line").collect()
    assert [(r.segment, r.subsegment, r.topic_en, r.keywords_en, r.keywords_ja) for r in rows] == [("Banking", "Loans", "Credit", ["credit"], ["与信"]), ("Insurance", None, "Annuity", ["annuity"], [])]


def v1(spark, *rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").transform(lambda d: io.parse_json_lines(d, schemas.BOOK_V1)[0])


def test_conversion_and_flattening(spark):
    rows = v1(spark, {"title": "Risk, 2nd Edition", "publisher": "Acme Press", "authors": ["A B"], "isbn_or_issn": "0123456789", "format": "print"}, {"title": "Plain"})
    out = {r.title: r for r in model.convert_v1(rows, "2024-01-01T00:00:00Z").collect()}
    r = out["Risk"]
    assert r.work_id.startswith("acmepress_") and r.editions[0].edition_number == 2 and r.editions[0].formats[0].isbn == "0123456789" and r.editions[0].formats[0].format_type == "paperback"
    assert (out["Plain"].publisher, out["Plain"].language, out["Plain"].segment, out["Plain"].editions[0].publication_year) == ("unknown", "en", "Other", 2020)
    t = model.flatten(model.convert_v1(rows, "x").withColumn("_ord", F.monotonically_increasing_id()))
    assert t["works"].count() == 2 and t["editions"].count() == 2 and t["formats"].count() == 2 and t["authors"].count() == 1
    assert model.delete_works(t, t["works"].where("title = 'Risk'"))["formats"].count() == 1


def test_merge_keeps_first_formats(spark):
    e = lambda n, *f: {"edition_number": n, "formats": [{"format_type": x, "isbn": i} for x, i in f]}
    data = [("w", 0, [e(1, ("pdf", "a"))], ["s1"]), ("w", 1, [e(1, ("pdf", "b"), ("ebook", "c"))], ["s2", "s1"]), ("w", 2, [e(2, ("pdf", "d"))], None)]
    df = spark.createDataFrame([(w, o, json.dumps(x), s) for w, o, x, s in data], "work_id string, _ord int, j string, data_sources array<string>")
    df = df.withColumn("editions", F.from_json("j", f"array<{schemas.EDITION}>")).drop("j")
    r = model.merge_editions(df, ["work_id"]).first()
    assert [(x.edition_number, x.is_latest, [(f.format_type, f.isbn) for f in x.formats]) for x in r.editions] == [(2, True, [("pdf", "d")]), (1, False, [("pdf", "a"), ("ebook", "c")])]
    assert r.data_sources == ["s1", "s2"]


def test_views(spark):
    w = spark.createDataFrame([("1", "A", "x", "theory", "en", "validated"), ("2", "A", "x", "theory", "en", "draft"), ("3", "B", "y", "case", "ja", "rejected"), ("4", "B", "y", "case", "ja", None)], "work_id string, segment string, subsegment string, perspective string, language string, dataset_status string")
    assert {(r.segment, r.book_count, r.validated_count) for r in views.coverage(w).collect()} == {("A", 2, 1), ("B", 2, 0)}
    long = views.coverage_long(w)
    assert [(r.segment, r.cnt) for r in long.collect()] == [("A", 2)]
    assert {r.segment: (r.theory, r["case"]) for r in views.coverage_pivot(long, ["theory", "case"]).collect()} == {"A": (2, 0)}
    assert views.gaps_dense(long, w, ["theory", "case"], 1).count() == 3


def test_components_are_the_smallest_reached(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.comp for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e}


def forms(spark, rows):
    return matching.match_forms(spark.createDataFrame(rows, "id long, title string, author string, isbn string"))


def test_tiers(spark):
    known = forms(spark, [(1, "Risk Management", "Ann Lee", "9781234567890"), (2, "The Bank: A Story", "Bo", None), (3, "Bond Markets Today", "Cy", None)])
    new = forms(spark, [(11, "Other", None, "9781234567890"), (12, "Other", None, "9781234567897"), (13, "RISK management, 2nd edition", None, None), (14, "Bank", None, None), (15, "Bond Market Today", "Cy", None), (16, "Quite Else", None, None)])
    got = {r.l_id: (r.r_id, r.match_type) for r in matching.find_matches(new, known).collect()}
    assert got == {11: (1, "isbn_exact"), 12: (1, "isbn_prefix"), 13: (1, "title_normalized"), 14: (2, "title_aggressive"), 15: (3, "fuzzy_medium")}


def test_classifier_ties_and_ambiguity(spark):
    kw = spark.createDataFrame([(0, "bond", "A", "a"), (1, "bank", "B", "b"), (2, "be", "C", "c")], "kw_ord int, keyword string, segment string, subsegment string")
    d = spark.createDataFrame([(1, "Bank and BOND be"), (2, "bond"), (3, "be"), (4, None)], "id long, text string")
    got = {r.id: (r.segment, r.hits, round(r.confidence, 2), r.is_ambiguous) for r in classify.classify(d, kw).collect()}
    assert got == {1: ("A", 1, 0.6, True), 2: ("A", 1, 0.6, False)}


def test_model_client_is_asked_once_per_question(spark):
    cells = spark.createDataFrame([("A", "a")], "segment string, subsegment string")
    d = spark.createDataFrame([(1, "t", "d"), (2, "t", "d"), (3, "bad", "d")], "id long, title string, description string")

    def make():
        def call(q):
            if "bad" in q:
                raise ValueError("no")
            return '```json\n{"segment": "A", "subsegment": "a", "confidence": 0.9, "reasoning": "r"}\n```'

        return call

    got = {r.id: (r.segment, r.is_valid, r.error) for r in classify.model_classify(d, make, cells).collect()}
    assert got == {1: ("A", True, None), 2: ("A", True, None), 3: (None, False, "ValueError: no")}


def test_router(spark):
    v = "struct<exists:boolean,is_finance_related:boolean,is_inappropriate:boolean,recommended_action:string,is_notation_variation:boolean,apply_suggestion:boolean>"
    rows = [
        (1, "t", ["NO_ISBN_FOUND"], True, 0.5, '{"exists": false}'), (2, "t", ["NO_ISBN_FOUND"], True, 0.5, "{}"), (3, "RPG", ["MISSING_CRITICAL_DATA"], False, 0.5, "{}"), (4, "t", ["TITLE_MISMATCH", "SEGMENT_CHANGE"], True, 0.9, '{"recommended_action": "APPLY_SUGGESTION"}'),
        (5, "t", ["SEGMENT_CHANGE"], True, 0.7, "{}"), (6, "t", ["SEGMENT_CHANGE"], True, 0.69, "{}"), (7, "t", ["LOW_CONFIDENCE"], False, 0.9, "{}"), (8, "t", ["URL_VALIDATION_FAILED"], True, 0.9, "{}"), (9, "t", ["TITLE_MISMATCH"], True, 0.9, '{"recommended_action": "x"}'),
    ]
    df = spark.createDataFrame(rows, "id long, title string, reasons array<string>, has_results boolean, confidence double, j string").withColumn("verdict", F.from_json("j", v))
    got = {r.id: r.action for r in review.route(df).collect()}
    assert got == {1: "DELETE_FROM_MASTER", 2: "KEEP_ORIGINAL", 3: "DELETE_FROM_MASTER", 4: "APPLY_SUGGESTION", 5: "UPDATE_SEGMENT", 6: "SKIP", 7: "SKIP", 8: "SKIP", 9: "SKIP"}


def test_validation(spark):
    e = f"array<{schemas.EDITION}>"
    good = '[{"edition_number": 1, "publication_year": 2020, "formats": [{"format_type": "pdf"}]}]'
    df = spark.createDataFrame([("ok_1", "t", good), ("BAD", None, "[]")], "work_id string, title string, j string").select("work_id", "title", F.from_json("j", e).alias("editions"))
    for c, x in {"language": "en", "publisher": "p", "segment": "s", "subsegment": "u", "perspective": "theory", "dataset_status": "draft"}.items():
        df = df.withColumn(c, F.lit(x))
    df = df.withColumn("importance_score", F.lit(None).cast("double"))
    got = sorted((r.work_id, r.message) for r in validate.violations(df, validate.work_rules(), ["work_id"]).collect())
    assert got == [("BAD", "'editions' has too few items"), ("BAD", "'title' is a required property"), ("BAD", "'work_id' does not match ^[a-z0-9_]+$")]
    raw = spark.createDataFrame([('{"a": 1, "zz": 2}',)], "value string")
    assert validate.unknown_keys(raw, ["a"]).first().unknown == ["zz"]


def test_result_cards(spark):
    page = '<div data-asin="B000000001"><h2>One &amp; Two</h2><span class="author">A, B | 2020</span><span>$ 12.50</span></div><div data-asin=""><h2>x</h2></div><div data-asin="B2"><h2>Sponsored y</h2></div><div data-asin="B3"><h2>Three</h2></div>'
    rows = collect.result_cards(spark.createDataFrame([("k", page)], "page_key string, html string")).orderBy("rank").collect()
    assert [(r.asin, r.title, r.authors, r.price) for r in rows] == [("B000000001", "One & Two", ["A", "B"], 12.5), ("B3", "Three", [], None)]


def test_fetch_retries_and_reports(spark):
    def make():
        seen = {}

        def get(u):
            seen[u] = seen.get(u, 0) + 1
            if u == "bad" or seen[u] < 2:
                raise OSError("down")
            return 200, u, "body"

        return get

    got = {r.url: (r.status, r.error) for r in collect.fetch(spark.createDataFrame([("ok",), ("bad",), ("ok",)], "url string"), make).collect()}
    assert got == {"ok": (200, None), "bad": (None, "OSError: down")}


def test_enrichment_order_and_guard(spark):
    rec = spark.createDataFrame([("1", "a b", "ja", None, None), ("2", "c d", "en", None, 5.0)], "isbn string, title string, language string, publisher string, price double")
    cat = spark.createDataFrame([("1", "a b", "P", 9.0), ("2", "c d", "Q", 9.0)], "isbn string, title string, publisher string, price double")
    vol = spark.createDataFrame([("9", "c d", "V", 7.0)], "isbn string, title string, publisher string, price double")
    got = {r.isbn: (r.publisher, r.price, r.changes) for r in enrich.enrich(rec, cat, vol, ["isbn", "publisher", "price"]).collect()}
    assert got == {"1": ("P", 9.0, ["publisher:catalogue", "price:catalogue"]), "2": ("V", 5.0, ["publisher:volumes"])}


def test_keyword_state(spark):
    state = spark.createDataFrame([("a", "failed"), ("b", "completed")], "keyword_id string, status string")
    res = spark.createDataFrame([("a", True), ("c", False)], "keyword_id string, ok boolean")
    assert {(r.keyword_id, r.status) for r in collect.advance(state, res).collect()} == {("a", "completed"), ("b", "completed"), ("c", "failed")}
    assert collect.backoff(0) == 5.0 and collect.backoff(9) == 30.0


def test_ratio_is_the_standard_one(spark):
    import difflib

    a, b = "risk management", "risky managers"
    df = spark.createDataFrame(pd.DataFrame({"a": [a], "b": [b]}))
    assert df.select(T.sequence_ratio("a", "b").alias("r")).first().r == difflib.SequenceMatcher(None, a, b).ratio()
