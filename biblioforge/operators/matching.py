"""Entity matching: tiers of exact keys, n-gram blocking, scored fuzzy matches, and the order-faithful greedy merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators.gram_counts import PACKS, count_cells, meet, pack_texts
from biblioforge.store import keep

HIGH, MEDIUM, LOW = 0.90, 0.80, 0.70
SAME_AUTHOR, DUPLICATE = 0.85, 0.85


def match_forms(books: DataFrame, compose: bool = True) -> DataFrame:
    """books (id, title, author, isbn) with their comparable forms: norm, agg, who, code."""
    return books.select("id", "title", "author", T.normalize_title("title", False, compose).alias("norm"), T.normalize_title("title", True, compose).alias("agg"), T.normalize_author("author", compose).alias("who"), T.clean_isbn("isbn", True).alias("code"))


def same_author(a: Column, b: Column, ratio: Column | None = None) -> Column:
    """Equal forms, one inside the other, or a ratio of SAME_AUTHOR; a missing author matches nobody."""
    has = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    close = (ratio if ratio is not None else T.sequence_ratio(a, b)) >= SAME_AUTHOR
    return F.coalesce(has & ((a == b) | F.contains(a, b) | F.contains(b, a) | close), F.lit(False))


def score_pairs(pairs: DataFrame, similarity=T.sequence_ratio, author_ratio=None) -> DataFrame:
    """pairs with columns l_* and r_* (norm, agg, who, code) -> plus match_type, confidence, is_match.

    The similarity of two titles is 0.6 of their sequence ratio and 0.4 of their word Jaccard, the better of both forms,
    0.1 more for the same author and 1 at most.
    """
    c = F.col
    sim = lambda x, y: F.when((c(x) == "") | (c(y) == ""), F.lit(0.0)).otherwise(0.6 * similarity(c(x), c(y)) + 0.4 * T.token_jaccard(x, y))
    who = same_author(c("l_who"), c("r_who"), author_ratio(c("l_who"), c("r_who")) if author_ratio else None)
    told = F.struct(F.greatest(sim("l_norm", "r_norm"), sim("l_agg", "r_agg")).alias("sim"), who.alias("who"))

    def verdict(x: Column) -> Column:
        fuzzy = F.least(F.lit(1.0), x["sim"] + F.when(x["who"], 0.1).otherwise(0.0))
        kind = (
            F.when(c("l_code") == c("r_code"), "isbn_exact")
            .when((c("l_norm") == c("r_norm")) & (c("l_norm") != ""), "title_normalized")
            .when((c("l_agg") == c("r_agg")) & (c("l_agg") != ""), "title_aggressive")
            .when(fuzzy >= HIGH, "fuzzy_high").when(fuzzy >= MEDIUM, "fuzzy_medium").when(fuzzy >= LOW, "fuzzy_low").otherwise("no_match")
        )
        exact = F.when(kind == "isbn_exact", 1.0).when(kind == "title_normalized", F.when(x["who"], 1.0).otherwise(0.95)).when(kind == "title_aggressive", F.when(x["who"], 0.95).otherwise(0.90))
        return F.struct(kind.alias("kind"), exact.otherwise(fuzzy).alias("sure"))

    # A lambda binds the similarities: as plain expressions they would be computed again for each of their uses.
    out = pairs.withColumn("_v", F.transform(F.array(told), verdict)[0]).withColumn("match_type", c("_v.kind")).withColumn("confidence", c("_v.sure"))
    return out.withColumn("is_match", ~c("match_type").isin("fuzzy_low", "no_match")).drop("_v")


#: Characters of index texts and of query texts in a cell of ngram_candidates(). The index texts lie in arrays, the queries come a pack at a time.
CELL_INDEX, CELL_QUERIES = 2_000_000, 16_000_000


def ngram_candidates(queries: DataFrame, index: DataFrame, overlap: float = 0.3, n: int = 3) -> DataFrame:
    """(q, r, shared): index rows that share at least max(1, int(overlap * grams)) n-grams of a query; repeats of a query's gram count.

    queries: q, text; index: r, text; ids are longs. Copies of a text are counted once, up to 64 of them. The texts meet in a
    grid of cells of bounded size, packed and with their ids, and are counted there: no row for each shared gram is made, and
    the pairs aren't shuffled. Of a cell only rows that share some pairs of grams with a query are counted (Block). The
    result, and so the time, still grow with the square of the texts; find_matches() needs it only for thresholds under APART + 0.1.
    """
    if n > 3:
        raise ValueError("grams of three characters at most")

    def packs(rows: DataFrame, key: str, most: int, name: str) -> tuple[DataFrame, int]:
        rows = rows.where("text <> ''").select(F.col(key).cast("long").alias("id"), F.concat("text").alias("text"))
        rows = rows.repartition("text").sortWithinPartitions(F.length("text"), "text")  # texts of a length ask for as many grams
        kept = keep(rows.mapInArrow(pack_texts(max(1, most)), PACKS), name)
        return kept, kept.agg(F.coalesce(F.sum("_chars"), F.lit(0))).first()[0]

    small = min(CELL_INDEX, CELL_QUERIES) // 32
    (left, long_q), (right, long_r) = packs(queries, "q", small, "query-packs"), packs(index, "r", small, "index-packs")
    down = long_r // CELL_INDEX + 1
    across = max(long_q // CELL_QUERIES + 1, min(long_q // 10_000 + 1, 4 * queries.sparkSession.sparkContext.defaultParallelism // down))
    block = lambda blocks: F.pmod("_n", F.lit(blocks).cast("long"))
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    left = left.select("_packed", block(across).alias("_i")).withColumn("_j", every(down))
    right = right.select("_packed", block(down).alias("_j")).withColumn("_i", every(across))
    cells = min(int(down * across), 2000)  # by number: adaptive execution would put many small cells into one task
    left, right = left.repartition(cells, "_i", "_j"), right.repartition(cells, "_i", "_j")
    met = left.groupBy("_i", "_j").cogroup(right.groupBy("_i", "_j")).applyInArrow(meet, "side int, _packed binary")
    return met.mapInArrow(count_cells(overlap, n), "q long, r long, shared long")


#: The highest similarity of two titles without a common word, whose Jaccard is 0; an author adds 0.1.
APART = 0.6
#: Titles of a word above which its pairs are dealt over several tasks.
HOT = 20_000


def near_enough(sim: float) -> bool:
    """Whether titles of that similarity must have a common word, or one aggressive form."""
    return sim + 1e-8 >= APART


def _words(side: str) -> Column:
    """What two titles must share one of to be similar: the words of the normal form, and the whole aggressive form."""
    words = F.filter(F.split(F.coalesce(F.col(f"{side}_norm"), F.lit("")), " "), lambda w: w != "")
    agg = F.when(F.col(f"{side}_agg") != "", F.concat(F.lit(" "), F.col(f"{side}_agg")))
    return F.array_distinct(F.concat(words, F.array_compact(F.array(agg))))


def _words_or_code(side: str) -> Column:
    """What two records must share one of to match at all."""
    return F.concat(_words(side), F.array_compact(F.array(F.concat(F.lit("  "), F.col(f"{side}_code")))))


def enough_grams(overlap: float, n: int = 3) -> Column:
    """The condition of ngram_candidates() on a pair (l_agg, r_agg)."""
    grams = T.ngrams("l_agg", n)
    held = lambda g: F.contains(F.col("r_agg"), g) & ((F.length(g) == n) | (F.col("r_agg") == g))
    return F.size(F.filter(grams, held)) >= F.greatest(F.lit(1), F.floor(F.size(grams) * overlap))


def _pairs_by(left: DataFrame, right: DataFrame, keys: Callable[[str], Column]) -> DataFrame:
    """Pairs of rows (l_*, r_*) with a common key, each once: it is made at the first key that it shares.

    Only keys with their rows are shuffled, no pairs. Pairs of a frequent key are dealt over a grid of tasks.
    """
    l, r = left.withColumn("_lw", keys("l")), right.withColumn("_rw", keys("r"))
    l, r = l.select("*", F.explode("_lw").alias("_w")), r.select("*", F.explode("_rw").alias("_w"))
    hot = keep(r.groupBy("_w").count().where(F.col("count") > HOT).select("_w", F.ceil(F.col("count") / HOT).alias("_n")), "hot-words")
    if hot.limit(1).count():

        def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
            rows = df.join(hot, "_w", "left").withColumn("_n", F.coalesce("_n", F.lit(1).cast("long")))
            own_block = F.pmod(F.xxhash64(*[c for c in df.columns if not c.startswith("_")]), F.col("_n"))
            return rows.withColumn(own, own_block).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")

        pairs = dealt(l, "_i", "_j").join(dealt(r, "_j", "_i"), ["_w", "_i", "_j"]).drop("_i", "_j")
    else:
        pairs = l.join(r, "_w")
    return pairs.where(F.array_intersect("_lw", "_rw")[0] == F.col("_w")).drop("_w", "_lw", "_rw")


def word_pairs(left: DataFrame, right: DataFrame, overlap: float) -> DataFrame:
    """Those pairs of rows (l_norm, l_agg, ...; r_norm, r_agg, ...) of ngram_candidates() that can be similar (near_enough())."""
    return _pairs_by(left.where("l_agg <> ''"), right.where("r_agg <> ''"), _words).where(enough_grams(overlap))


def sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def find_matches(new: DataFrame, known: DataFrame, threshold: float = MEDIUM, overlap: float = 0.3, similarity=T.sequence_ratio, author_ratio=None, best_only: bool = True) -> DataFrame:
    """Tiered matches of `new` in `known` (both as match_forms gives them): ISBN, ISBN prefix, normal form, aggressive form, then scored n-gram candidates.

    Ties go to the smallest id. best_only keeps one row per l_id; otherwise every match at or above the threshold. A
    similarity is 1 at most, and less for different texts: from a threshold of APART + 0.1 on, candidates are sought by
    common words, which loses none.
    """
    same = new is known
    new = keep(new, "forms")  # else every use below would compute the forms again, in code too large to compile
    known = new if same else keep(known, "forms")
    left, right = sided(new, "l"), sided(known, "r")
    prefix = lambda c: F.when(F.length(c) == 13, F.substring(c, 1, 12))

    def tier(key, n: int, kind: str, sure: float) -> DataFrame:
        keyed = right.select(key("r").alias("_k"), "r_id").where("_k <> ''")
        if best_only:
            keyed = keyed.groupBy("_k").agg(F.min("r_id").alias("r_id"))
        rows = left.select(key("l").alias("_k"), "l_id").where("_k <> ''").join(keyed, "_k")
        return rows.select("l_id", "r_id", F.lit(n).alias("tier"), F.lit(kind).alias("match_type"), F.lit(sure).cast("double").alias("confidence"))

    found = tier(lambda s: F.col(f"{s}_code"), 1, "isbn_exact", 1.0)
    found = found.union(tier(lambda s: prefix(f"{s}_code"), 2, "isbn_prefix", 0.98))
    found = found.union(tier(lambda s: F.col(f"{s}_norm"), 3, "title_normalized", 0.95)).union(tier(lambda s: F.col(f"{s}_agg"), 4, "title_aggressive", 0.90))
    found = keep(found, "exact")
    rest = new.join(found.select(F.col("l_id").alias("id")).distinct(), "id", "left_anti") if best_only else new
    if near_enough(threshold - 0.1):
        pairs = word_pairs(sided(rest, "l"), right, overlap)
    else:
        cand = ngram_candidates(rest.select(F.col("id").alias("q"), F.col("agg").alias("text")), known.select(F.col("id").alias("r"), F.col("agg").alias("text")), overlap)
        pairs = cand.join(left, cand.q == left.l_id).join(right, cand.r == right.r_id)
    fuzzy = score_pairs(pairs, similarity, author_ratio).where(F.col("confidence") >= threshold).select("l_id", "r_id", F.lit(5).alias("tier"), "match_type", "confidence")
    found = found.union(fuzzy).where(F.col("confidence") >= threshold)
    w = Window.partitionBy("l_id").orderBy("tier", F.desc("confidence"), "r_id") if best_only else Window.partitionBy("l_id", "r_id").orderBy(F.desc("confidence"), "tier")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def brute_force(left: DataFrame, right: DataFrame, threshold: float = MEDIUM, similarity=T.sequence_ratio, author_ratio=None) -> DataFrame:
    """The matches among all pairs (smaller id first) of two sides, without n-gram blocking.

    From a threshold of APART + 0.1 on, a pair without a common word, aggressive form or ISBN can't reach it, so pairs
    are made of records that share one: the same result as all pairs scored. Lower thresholds score every pair: a right
    side within the broadcast threshold travels whole; a larger one meets the left side in a grid of blocks.
    """
    spark = left.sparkSession
    l, r = sided(keep(left, "forms"), "l"), sided(keep(right, "forms"), "r")
    if near_enough(threshold - 0.1):
        return score_pairs(_pairs_by(l, r, _words_or_code).where("l_id < r_id"), similarity, author_ratio).where(F.col("confidence") >= threshold)
    l = l.repartition(spark.sparkContext.defaultParallelism)  # small tables are one file, and their pairs would be one task
    size, limit = int(r._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()), int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    if size <= limit:
        pairs = l.join(F.broadcast(r), F.col("l_id") < F.col("r_id"))
    else:
        blocks = size // max(limit, 1 << 20) + 2
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        grid = l.withColumn("_i", F.pmod(F.xxhash64("l_id"), F.lit(blocks))).withColumn("_j", every)
        pairs = grid.join(r.withColumn("_j", F.pmod(F.xxhash64("r_id"), F.lit(blocks))).withColumn("_i", every), ["_i", "_j"]).where("l_id < r_id").drop("_i", "_j")
    return score_pairs(pairs, similarity, author_ratio).where(F.col("confidence") >= threshold)


def duplicate_check(items: DataFrame, known_asins: DataFrame, known_isbns: DataFrame) -> DataFrame:
    """items (id, asin, url) -> plus kind: 'asin', 'isbn' or null. An ASIN is a field or stands in the address."""
    rows = items.withColumn("key", F.coalesce(F.nullif("asin", F.lit("")), T.asin_of_url("url")))
    a = known_asins.select(F.col("asin").alias("key"), F.lit(True).alias("_a")).distinct()
    b = known_isbns.select(F.col("isbn").alias("key"), F.lit(True).alias("_b")).distinct()
    return rows.join(a, "key", "left").join(b, "key", "left").withColumn("kind", F.when(F.col("_a"), "asin").when(F.col("_b"), "isbn")).drop("_a", "_b")


def duplicate_check_all(items: DataFrame, known_asins: DataFrame, known_isbns: DataFrame, known: DataFrame, threshold: float = DUPLICATE, similarity=T.sequence_ratio, author_ratio=None) -> DataFrame:
    """duplicate_check() and, for items without a known key, the best fuzzy match in the catalogue: kind 'fuzzy', with match_type and confidence.

    items: id, asin, url, title, author, isbn; known: match forms.
    """
    keyed = duplicate_check(items, known_asins, known_isbns)
    rest = match_forms(keyed.where("kind is null"), compose=False)
    best = find_matches(rest, known, threshold, similarity=similarity, author_ratio=author_ratio).select(F.col("l_id").alias("id"), F.col("r_id").alias("known_id"), "match_type", "confidence")
    return keyed.join(best, "id", "left").withColumn("kind", F.coalesce("kind", F.when(F.col("known_id").isNotNull(), "fuzzy")))


def dup_groups(books: DataFrame, key: str) -> DataFrame:
    """key, ids of the keys with more than one book, ids in order."""
    return books.groupBy(key).agg(F.array_sort(F.collect_list("id")).alias("ids")).where("size(ids) > 1")


def index_tables(forms: DataFrame) -> dict[str, DataFrame]:
    """Keyed tables of the index; the last book of an ISBN counts."""
    last = forms.where("code is not null").groupBy("code").agg(F.max("id").alias("id"))
    prefix = forms.where("length(code) = 13").groupBy(F.substring("code", 1, 12).alias("prefix")).agg(F.max("id").alias("id"))
    return {"isbn": last, "isbn_prefix": prefix, "norm": forms.where("norm <> ''").select("norm", "id"), "agg": forms.where("agg <> ''").select("agg", "id"), "gram": forms.select(F.explode(F.array_distinct(T.ngrams("agg"))).alias("gram"), "id")}


def index_add(tables: dict[str, DataFrame], forms: DataFrame) -> dict[str, DataFrame]:
    """The tables of an index with more books in it; only the new books' forms are computed."""
    new = index_tables(forms)
    out = {name: df.unionByName(new[name]) for name, df in tables.items()}
    out["isbn"] = out["isbn"].groupBy("code").agg(F.max("id").alias("id"))
    out["isbn_prefix"] = out["isbn_prefix"].groupBy("prefix").agg(F.max("id").alias("id"))
    return out


def index_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name, entries (distinct keys) of each table of an index."""
    keys = {"isbn": "code", "isbn_prefix": "prefix", "norm": "norm", "agg": "agg", "gram": "gram"}
    parts = [df.agg(F.count_distinct(keys[name]).alias("entries")).select(F.lit(name).alias("name"), "entries") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def index_stats(forms: DataFrame) -> DataFrame:
    """Distinct keys of the index, in two aggregates: grams are made of distinct titles alone."""
    forms = keep(forms.select("id", "norm", "agg", "code"), "forms")
    one = forms.agg(F.count("*").alias("total_books"), F.count_distinct("code").alias("isbn_entries"), F.count_distinct(F.nullif("norm", F.lit(""))).alias("normalized_entries"), F.count_distinct(F.nullif("agg", F.lit(""))).alias("aggressive_entries"))
    grams = forms.select("agg").distinct().select(F.explode(F.array_distinct(T.ngrams("agg"))).alias("gram"))
    return one.crossJoin(grams.agg(F.count_distinct("gram").alias("ngram_entries")))  # both sides are one row


KEYS = ("code", "prefix", "norm", "agg")


def _keys(rows: DataFrame, *more: str) -> DataFrame:
    """A row (tier, key, ...) for each key under which a record can be found, best tier first."""
    prefix = F.when(F.length("code") == 13, F.substring("code", 1, 12))
    keys = [(1, F.col("code")), (2, prefix), (3, F.col("norm")), (4, F.col("agg"))]
    items = F.array(*[F.struct(F.lit(n).alias("tier"), k.alias("key")) for n, k in keys])
    return rows.select(*more, F.inline(F.filter(items, lambda x: F.coalesce(x["key"], F.lit("")) != "")))


def title_similarities(titles: DataFrame, least: float, overlap: float = 0.3, similarity=T.sequence_ratio) -> DataFrame:
    """(t, u, sim): for each title t, the other titles u (with another aggressive form) of enough shared n-grams and a similarity of `least`.

    titles: t, norm, agg. The similarity is that of score_pairs() without authors; t is the one that arrives.
    """
    l, r = sided(titles, "l"), sided(titles, "r")
    if near_enough(least):
        pairs = word_pairs(l, r, overlap).where("l_agg <> r_agg")
    else:
        cand = ngram_candidates(titles.select(F.col("t").alias("q"), F.col("agg").alias("text")), titles.select(F.col("t").alias("r"), F.col("agg").alias("text")), overlap)
        pairs = cand.join(l, cand.q == l.l_t).join(r, cand.r == r.r_t).where("l_agg <> r_agg")
    sim = lambda x, y: F.when((F.col(x) == "") | (F.col(y) == ""), F.lit(0.0)).otherwise(0.6 * similarity(F.col(x), F.col(y)) + 0.4 * T.token_jaccard(x, y))
    out = pairs.select(F.col("l_t").alias("t"), F.col("r_t").alias("u"), F.greatest(sim("l_norm", "r_norm"), sim("l_agg", "r_agg")).alias("sim"))
    return keep(out, "similar").where(F.col("sim") >= least)


def greedy_merge(forms: DataFrame, threshold: float = MEDIUM, overlap: float = 0.3, similarity=T.sequence_ratio, author_ratio=None) -> DataFrame:
    """id, leader: what arrival in `ord` merges. Each record joins its best match among the leaders before it, or leads.

    forms: id, ord (both without repeats), the match forms, and settled where some records lead already (a master's, which
    come first in ord and stay as they are). The best match is that of the first tier which has one:
    ISBN, ISBN prefix, normal title, aggressive title, then the fuzzy one of the highest confidence, the earliest in a
    tie. Leaders only are matched, so who leads depends on all records before. It is decided in rounds: a record leads
    once no undecided record before it could be a match and no leader is; it is a member once one is.

    Records with equal forms are one class of which only the first can lead, and a key (an ISBN, a title) has one leader
    at most. So a round takes the first leader and the first undecided class of each key by aggregates, and no pairs of a
    key's records are made; fuzzy candidates are pairs of different titles. Rounds are as many as the longest chain of
    records that wait for each other.
    """
    settled = F.coalesce("settled", F.lit(False)) if "settled" in forms.columns else F.lit(False)
    forms = keep(forms.select("id", "ord", settled.alias("settled"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("norm", "agg", "who", "code")]), "forms")
    titles = forms.groupBy("norm", "agg").agg(F.min("id").alias("t"))
    classes = forms.groupBy("norm", "agg", "who", "code").agg(F.min("ord").alias("ord"), F.max("settled").alias("settled"))
    classes = classes.join(titles, ["norm", "agg"]).join(forms.select("ord", "id"), "ord").select("id", "ord", "settled", "t", "norm", "agg", "who", "code")
    classes = keep(classes, "classes")
    near = title_similarities(keep(titles.where("agg <> ''"), "titles"), threshold - 0.1 - 1e-9, overlap, similarity)
    fuzzy = keep(classes.join(near, "t").select("id", "ord", "who", F.col("u").cast("string").alias("key"), "sim"), "fuzzy")
    exact = keep(_keys(classes, "id", "ord"), "keys")
    # Of each key the first leader and the first undecided class; titles are keys of tier 5.
    all_keys = keep(exact.select("id", "ord", "tier", "key").union(classes.where("agg <> ''").select("id", "ord", F.lit(5), F.col("t").cast("string"))), "all-keys")
    state = keep(classes.select("id", "ord", "who", F.when(F.col("settled"), True).alias("leads")), "state")

    def by_key(state: DataFrame) -> DataFrame:
        held = all_keys.join(state.select("id", "who", "leads").where("leads is null or leads"), "id")
        first = F.min(F.when(F.col("leads"), F.struct("ord", "id", "who")))
        return held.groupBy("tier", "key").agg(first.alias("lead"), F.min(F.when(F.col("leads").isNull(), F.col("ord"))).alias("open"))

    def sure(sim):
        """Confidence of a fuzzy match with a key's leader."""
        ratio = author_ratio(F.col("who"), F.col("lead.who")) if author_ratio else None
        who = same_author(F.col("who"), F.col("lead.who"), ratio)
        return F.least(F.lit(1.0), sim + F.when(who, 0.1).otherwise(0.0))

    while state.where("leads is null").limit(1).count():
        now = keep(by_key(state), "first")
        undecided = state.where("leads is null").select("id")
        mine = exact.join(undecided, "id", "left_semi").join(now, ["tier", "key"]).select("id", (F.col("lead.ord") < F.col("ord")).alias("led"), (F.col("open") < F.col("ord")).alias("waits"))
        ours = fuzzy.join(undecided, "id", "left_semi").join(now.where("tier = 5").drop("tier"), "key")
        before = F.coalesce(F.col("lead.ord") < F.col("ord"), F.lit(False))
        ours = ours.select("id", F.when(before, sure(F.col("sim")) >= threshold).otherwise(F.lit(False)).alias("led"), (F.col("open") < F.col("ord")).alias("waits"))
        told = mine.union(ours).groupBy("id").agg(F.max(F.coalesce("led", F.lit(False))).alias("led"), F.max(F.coalesce("waits", F.lit(False))).alias("waits"))
        verdict = F.when(F.col("leads").isNotNull(), F.col("leads")).when(F.col("led"), False).when(F.coalesce("waits", F.lit(False)), None).otherwise(True)
        state = keep(state.join(told, "id", "left").withColumn("leads", verdict).select("id", "ord", "who", "leads"), "state")
    now = keep(by_key(state).where("lead is not null"), "leaders")
    # All records, copies too, look among the leaders before them.
    records = forms.join(titles, ["norm", "agg"])
    found = _keys(records, "id", "ord").join(now.where("tier < 5"), ["tier", "key"]).where("lead.ord < ord").select("id", "tier", F.lit(0.0).alias("less"), "lead.ord", F.col("lead.id").alias("leader"))
    close = records.join(near.select("t", F.col("u").cast("string").alias("key"), "sim"), "t").join(now.where("tier = 5").drop("tier"), "key").where("lead.ord < ord")
    close = close.withColumn("sure", sure(F.col("sim"))).where(F.col("sure") >= threshold).select("id", F.lit(5).alias("tier"), (-F.col("sure")).alias("less"), "lead.ord", F.col("lead.id").alias("leader"))
    best = found.union(close).groupBy("id").agg(F.min(F.struct("tier", "less", "ord", "leader")).alias("b"))
    return forms.select("id", "settled").join(best, "id", "left").select("id", F.when(F.col("settled"), F.col("id")).otherwise(F.coalesce("b.leader", "id")).alias("leader"))
