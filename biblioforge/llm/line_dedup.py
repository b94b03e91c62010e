"""Line dedup by prefix doubling over line-ID sequences (operator 2). DataFrame operations only.

A window of lines (of those with a word) that has an earlier copy in (doc_id, text hash, line) order and holds at least
min_words words is a later copy, whatever its length, and its lines go: that is every maximal repeated run of so many
words. Only some of the windows need comparing. Parts of a later copy are later copies too, so a run of min_words words
or more is the union of the shortest such windows that start at its lines and the one that ends at its last line. Each
line has a word, so none of them is longer than min_words lines.

Lines get ids (128 bits of hash). The name of a window of 2**k lines is made of the names of its halves, up to the
largest power of two in min_words; the name of any other window is made of its length and the two overlapping windows
of 2**k lines that cover it. Names of 128 bits stand for ranks: suffixes with equal names at a depth are an interval of
the suffix array of all line sequences whose longest common prefix has that depth, in whatever order the intervals
stand, and each interval knows its first position. Doubling is distributed with the documents and shuffles nothing;
only the names of the windows that decide are grouped.

Every deleted line has an earlier copy, so one copy of each line stays. Only ids are shuffled, besides one join that
brings the decisions to the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.llm.common import Scratch

MIN_WORDS = 20
DOC = ["doc_id", "th"]
_WORD = r"[^\x20\x09-\x0D]+"
_WORDED = "rlike '[^\\\\x20\\\\x09-\\\\x0D]'"


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, th, first and last line number, name: the shortest windows with min_words words from each line and up to each line."""
    lines = f"filter(transform(split(text, '\\n', -1), (l, i) -> struct(i AS line_no, l AS line)), x -> x.line {_WORDED})"
    ids = f"transform({lines}, x -> struct(x.line_no AS line_no, xxhash64(x.line) AS n1, xxhash64(7, x.line) AS n2, cast(regexp_count(x.line, '{_WORD.replace(chr(92), chr(92) * 2)}') AS bigint) AS w))"
    doubled = "transform(element_at(acc, -1), (x, i) -> struct(xxhash64(x.n1, get(element_at(acc, -1), i + s).n1) AS n1, xxhash64(x.n2, get(element_at(acc, -1), i + s).n2, 7) AS n2))"
    sizes = [1 << k for k in range(min_words.bit_length() - 1)]
    steps = f"array({', '.join(map(str, sizes))})" if sizes else "array_repeat(1, 0)"
    levels = f"aggregate({steps}, array(transform(v, x -> struct(x.n1 AS n1, x.n2 AS n2))), (acc, s) -> concat(acc, array({doubled})))"
    # Words and size of the shortest window: the lines are added until there are enough words.
    shortest = f"aggregate({{}}, struct(0L AS words, 0 AS size), (a, x) -> if(a.words < {min_words}, struct(a.words + x.w AS words, a.size + 1 AS size), a))"
    ahead = shortest.format(f"slice(v, i + 1, if(x.w >= {min_words}, 1, {min_words}))")
    behind = shortest.format(f"reverse(slice(v, greatest(i + 2 - {min_words}, 1), least(i + 1, {min_words})))")
    # A window that stays long enough without its last line isn't among those from its first line.
    found = f"""transform(v, (x, i) -> filter(array(
        transform(array({ahead}), a -> if(a.words >= {min_words}, struct(i AS at, a.size AS size), null))[0],
        if(x.w >= {min_words}, null, transform(array({behind}), a -> if(a.words - x.w >= {min_words}, struct(i + 1 - a.size AS at, a.size AS size), null))[0])), y -> y IS NOT NULL))"""
    named = f"""transform(array({levels}), names -> transform(flatten({found}), y -> transform(array(names[length(bin(y.size)) - 1]), n ->
        transform(array(y.at + y.size - shiftleft(1, length(bin(y.size)) - 1)), z -> struct(v[y.at].line_no AS lo, v[y.at + y.size - 1].line_no AS hi,
        xxhash64(y.size, n[y.at].n1, n[z].n1) AS n1, xxhash64(n[y.at].n2, n[z].n2, y.size) AS n2))[0])[0]))[0]"""
    # One-element arrays bind names: an expression that is used in a lambda would be evaluated for each element.
    windows = F.expr(f"transform(array({ids}), v -> {named})[0]")
    return docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode(windows).alias("x")).select(*DOC, "x.lo", "x.hi", "x.n1", "x.n2")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th, drop: the numbers of the lines in later copies, and of empty lines between them, for the documents that have any."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    windows = scratch.keep(_windows(docs.where("doc_id is not null and text is not null"), max(min_words, 1)), "windows")
    here = F.struct(*DOC, "lo")
    names = windows.groupBy("n1", "n2").agg(F.min(here).alias("first"), F.max(here).alias("last")).where("first <> last").select("n1", "n2", "first")
    later = windows.join(names, ["n1", "n2"]).where(here != F.col("first"))
    lines = later.select(*DOC, F.explode(F.sequence("lo", "hi")).alias("line_no"))
    out = scratch.keep(lines.groupBy(*DOC).agg(F.collect_set("line_no").alias("drop")), "drop")
    scratch.drop(windows)
    return out


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of docs with later copies of line runs cut from `text`, and n_lines (with a word), n_removed, which replace columns of these names.

    docs: doc_id, text and any other columns. Null texts, texts without words and rows without doc_id stay as they
    are and take no part. Rows that repeat doc_id and text are one document and get the same result. Documents that
    share a doc_id but not their text are ordered by text hash. An empty table gives an empty one.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drop = later_copies(plain, min_words).select(F.col("doc_id").alias("__dedup_id"), F.col("th").alias("__dedup_th"), F.col("drop").alias("__dedup_drop"))
    # The same join at every size: a broadcast, which only small tables get, would make the shuffle seem to grow faster than the input.
    out = docs.join(drop.hint("merge"), (docs.doc_id.cast("long") == drop["__dedup_id"]) & (F.xxhash64(docs.text.cast("string")) == drop["__dedup_th"]), "left")
    kept = F.expr(f"array_join(transform(filter(transform(split(text, '\\n', -1), (l, i) -> struct(i AS i, l AS l)), x -> NOT (array_contains(__dedup_drop, x.i) AND x.l {_WORDED})), x -> x.l), '\\n')")
    worded = f"coalesce(cast(size(filter(split({{}}, '\\n', -1), l -> l {_WORDED})) as bigint), 0)"
    out = out.withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.expr(worded.format("text"))))
    out = out.withColumn("text", F.when(F.col("__dedup_drop").isNull(), F.col("text")).otherwise(kept))
    out = out.withColumn("n_removed", F.when(F.col("__dedup_drop").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.expr(worded.format("text"))).cast("long"))
    return out.drop("__dedup_id", "__dedup_th", "__dedup_drop")
