"""Review queue: records, routing to actions, application to the master, and the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Title parts that mark a work as off-topic (games).
OFF_TOPIC = ["ゲーム", "攻略", "クエスト", "ファンタジー", "RPG", "モンスター", "ドラゴン"]


def review_records(rows: DataFrame, snapshot: list[str]) -> DataFrame:
    """rows with reasons -> work_id, title, reasons, original_data (7 fields at most), needs_review."""
    pairs = [x for c in snapshot[:7] for x in (F.lit(c), F.col(c).cast("string"))]
    return rows.where(F.size("reasons") > 0).select("work_id", "title", "reasons", F.create_map(*pairs).alias("original_data"), F.lit(True).alias("needs_review"))


def handler(reasons: str = "reasons") -> Column:
    """Which handler takes a review, by priority."""
    has = lambda *r: F.arrays_overlap(F.col(reasons), F.array(*[F.lit(x) for x in r]))
    return (
        F.when(has("NO_ISBN_FOUND", "MISSING_CRITICAL_DATA"), "missing_data")
        .when(has("TITLE_MISMATCH", "AUTHOR_MISMATCH"), "mismatch")
        .when(has("SEGMENT_CHANGE"), "segment_change")
        .when(has("LOW_CONFIDENCE"), "low_confidence")
        .when(has("MULTIPLE_MATCHES"), "multiple_matches")
        .otherwise("unknown")
    )


def off_topic(title: str, found_results: Column) -> Column:
    """Off-topic title parts count only where the search found nothing."""
    return ~found_results & F.exists(F.array(*[F.lit(p) for p in OFF_TOPIC]), lambda p: F.contains(F.col(title), p))


def route(reviews: DataFrame) -> DataFrame:
    """reviews plus handler and action.

    Columns read: reasons, title, has_results, confidence, verdict struct(exists, is_finance_related, is_inappropriate,
    recommended_action, is_notation_variation, apply_suggestion). Missing verdict fields: it exists and is on topic.
    """
    v = F.col("verdict")
    h = handler()
    missing = (
        F.when(off_topic("title", F.coalesce("has_results", F.lit(False))), "DELETE_FROM_MASTER")
        .when(~F.coalesce("has_results", F.lit(False)), "SKIP")
        .when(F.coalesce(v["is_inappropriate"], F.lit(False)) | ~F.coalesce(v["exists"], F.lit(True)) | ~F.coalesce(v["is_finance_related"], F.lit(True)), "DELETE_FROM_MASTER")
        .otherwise("KEEP_ORIGINAL")
    )
    known = F.col("verdict.recommended_action").isin("KEEP_ORIGINAL", "APPLY_SUGGESTION", "DELETE_FROM_MASTER", "SKIP")
    mismatch = F.when(F.coalesce(v["is_notation_variation"], F.lit(False)), "KEEP_ORIGINAL").when(known, v["recommended_action"]).otherwise("SKIP")
    segment = F.when(F.coalesce(F.col("confidence") >= 0.7, F.lit(False)), "UPDATE_SEGMENT").otherwise("SKIP")
    low = F.when(~F.coalesce("has_results", F.lit(False)), "SKIP").when(F.coalesce(v["apply_suggestion"] & (F.col("confidence") >= 0.7), F.lit(False)), "UPDATE_SEGMENT").otherwise("KEEP_ORIGINAL")
    action = F.when(h == "missing_data", missing).when(h == "mismatch", mismatch).when(h == "segment_change", segment).when(h.isin("low_confidence", "multiple_matches"), low).otherwise("SKIP")
    return reviews.withColumn("handler", h).withColumn("action", action)


def apply_actions(master: DataFrame, actions: DataFrame) -> DataFrame:
    """master (work_id, segment, subsegment, ...) after actions (work_id, action, new_segment, new_subsegment)."""
    gone = actions.where("action = 'DELETE_FROM_MASTER'").select("work_id").distinct()
    new = actions.where("action in ('UPDATE_SEGMENT', 'APPLY_SUGGESTION')").groupBy("work_id").agg(F.max(F.struct("new_segment", "new_subsegment")).alias("_n"))
    out = master.join(gone, "work_id", "left_anti").join(new, "work_id", "left")
    return out.withColumn("segment", F.coalesce("_n.new_segment", "segment")).withColumn("subsegment", F.coalesce("_n.new_subsegment", "subsegment")).drop("_n")


def remaining(reviews: DataFrame, done: DataFrame) -> DataFrame:
    return reviews.join(done.select("work_id").distinct(), "work_id", "left_anti")


def pending(reviews: DataFrame, done: DataFrame, reasons: list[str] | None = None, limit: int | None = None) -> DataFrame:
    out = remaining(reviews, done)
    if reasons:
        out = out.where(F.arrays_overlap("reasons", F.array(*[F.lit(r) for r in reasons])))
    return out.orderBy("work_id").limit(limit) if limit else out


def action_stats(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def changelog(actions: DataFrame) -> DataFrame:
    """Entries worth a line: all but skips without data before or after."""
    return actions.where((F.col("action") != "SKIP") | (F.coalesce(F.size("before"), F.lit(0)) > 0) | (F.coalesce(F.size("after"), F.lit(0)) > 0))


#: What a reviewer is asked, by kind of review.
ASKS = {
    "missing": "Does this book exist, is it about finance, and should the entry be kept? Answer in JSON: exists, is_finance_related, recommended_action, reason.",
    "mismatch": "Are both titles the same book in different notation, or two books? Answer in JSON: is_notation_variation, recommended_action, reason.",
    "segment": "Does the suggested cell suit this book better than the present one? Answer in JSON: apply_suggestion, confidence, reason.",
}


def review_prompt(kind: str, title: str, authors: str, snippets: str, other: str | None = None) -> Column:
    """Question of a review: the book, what it is compared with, and the first 5 search snippets, each cut at 200 characters."""
    shown = F.array_join(F.transform(F.slice(snippets, 1, 5), lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), F.left(s, F.lit(200)))), "\n")
    lines = [F.concat(F.lit("Title: "), F.col(title)), F.concat(F.lit("Authors: "), F.array_join(authors, ", "))]
    if other:
        lines.append(F.concat(F.lit("Compared with: "), F.col(other)))
    found = F.when(F.coalesce(F.size(snippets), F.lit(0)) > 0, F.concat(F.lit("Search results:\n"), shown)).otherwise("Search results: none")
    return F.concat_ws("\n", *lines, found, F.lit(ASKS[kind]))


def render(reviews: DataFrame) -> DataFrame:
    """Text block of each review."""
    return reviews.select("work_id", F.concat_ws("\n", F.concat(F.lit("Title: "), "title"), F.concat(F.lit("Reasons: "), F.array_join("reasons", ", ")), F.when(F.array_contains("reasons", "SEGMENT_CHANGE"), F.lit("The classifier suggests another segment."))).alias("text"))


def decide_by_hand(master: DataFrame, decisions: DataFrame) -> DataFrame:
    """Interactive decisions as a table: y takes the suggested cell, d deletes, anything else leaves the work."""
    action = F.when(F.col("answer") == "y", "UPDATE_SEGMENT").when(F.col("answer") == "d", "DELETE_FROM_MASTER").otherwise("KEEP_ORIGINAL")
    return apply_actions(master, decisions.withColumn("action", action))
