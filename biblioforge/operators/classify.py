"""Keyword classification into the taxonomy, its decision rules, and model-backed classification through an injected client."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.store import keep

AMBIGUOUS, UNSURE, APPLY = 0.8, 0.6, 0.7
PIECE = 200  # texts that a task turns into Python values at a time
TEXTS = 2**31 - 1  # what stands for a block with packed texts, after all others


CELLS = "array<struct<segment:string,subsegment:string,hits:bigint,first:int,words:array<string>>>"


def _find_cells(told):
    """Arrow iterator: folded texts -> their cells with hits, best first. The automaton is built once a task and passes over each text once."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        rows = told.value
        machine = ahocorasick.Automaton()
        for number, (_, word, _, _) in enumerate(rows):
            machine.add_word(word, [*machine.get(word, []), number])
        if rows:
            machine.make_automaton()
        for batch in texts:
            done = []
            for k in range(0, len(batch), PIECE):
                out = []
                for text in batch.slice(k, PIECE).to_pylist():
                    cells: dict = {}
                    for number in sorted({n for _, found in machine.iter(text) for n in found}) if text and rows else []:
                        order, word, segment, subsegment = rows[number]
                        cell = cells.setdefault((segment, subsegment), [0, order, []])
                        cell[0] += 1
                        if len(cell[2]) < 5:
                            cell[2].append(word)
                    best = sorted(cells.items(), key=lambda x: (-x[1][0], x[1][1], x[0][0] or "", x[0][1] or ""))
                    out.append([{"segment": s, "subsegment": u, "hits": n, "first": first, "words": words} for (s, u), (n, first, words) in best])
                done.append(pa.array(out, CELL_TYPE))
            yield pa.concat_arrays(done) if done else pa.array([], CELL_TYPE)

    return run


CELL_TYPE = pa.list_(pa.struct([("segment", pa.string()), ("subsegment", pa.string()), ("hits", pa.int64()), ("first", pa.int32()), ("words", pa.list_(pa.string()))]))


def _table(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keyword rows as compressed tables, one for each block in a batch: words and cells once, numbers beside them."""
    for b in batches:
        for block in b.column("_block").unique().to_pylist():
            t = pa.Table.from_batches([b]).filter(pc.equal(b.column("_block"), block)).drop_columns("_block")
            for c in ("keyword", "segment", "subsegment"):
                t = t.set_column(t.schema.get_field_index(c), c, t[c].dictionary_encode())
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_table(t)], pa.binary())], names=["_block", "_packed"])


def _pack_texts(slices: int):
    """Arrow iterator: rows with their texts as compressed tables, dealt over slices. They come after all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for b in batches:
            for k in range(0, b.num_rows, PIECE):
                packed = _table(pa.Table.from_batches([b.slice(k, PIECE)]))
                yield pa.RecordBatch.from_arrays([pa.array([number % slices], pa.int32()), pa.array([TEXTS], pa.int32()), pa.array([packed], pa.binary())], names=["_s", "_block", "_packed"])
                number += 1

    return run


class _Words:
    """An automaton over the different words of keyword rows, which lie in arrays by word."""

    def __init__(self, packed: list[bytes]):
        import ahocorasick

        tables = [pa.ipc.open_stream(p).read_all() for p in packed]
        t = pa.concat_tables(tables).unify_dictionaries().combine_chunks()
        coded = {c: t[c].combine_chunks() for c in ("keyword", "segment", "subsegment")}
        coded = {c: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for c, x in coded.items()}
        number = {c: x.indices.fill_null(len(x.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64) for c, x in coded.items()}
        names = {c: [*coded[c].dictionary.to_pylist(), None] for c in ("segment", "subsegment")}
        pairs, cell = np.unique(number["segment"] * len(names["subsegment"]) + number["subsegment"], return_inverse=True)
        cells = [(names["segment"][p // len(names["subsegment"])], names["subsegment"][p % len(names["subsegment"])]) for p in pairs.tolist()]
        order = sorted(range(len(cells)), key=lambda k: (cells[k][0] or "", cells[k][1] or ""))
        self.segments, self.subsegments = (pa.array([cells[k][i] for k in order], pa.string()) for i in (0, 1))
        place = np.empty(len(cells), np.int64)
        place[order] = np.arange(len(cells))
        words = coded["keyword"].dictionary.to_pylist()
        by_name = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words), np.int64)
        rank[by_name] = np.arange(len(words))
        words = [words[k] for k in by_name]
        self.words, word = pa.array(words, pa.string()), rank[number["keyword"]]
        rows = np.argsort(word, kind="stable")
        word = word[rows]
        self.key = (place[cell][rows] << 32) | t["kw_ord"].to_numpy().astype(np.int64)[rows]  # cell, then order
        self.starts = np.searchsorted(word, np.arange(len(words) + 1))
        self.machine = ahocorasick.Automaton()
        for k, w in enumerate(words):
            self.machine.add_word(w, k)
        self.machine.make_automaton()

    def cells(self, texts: list[str | None], most: int | None = None) -> pa.Array:
        lists, cell, hits, first, sizes, shown = [0], [], [], [], [], []
        for text in texts:
            held = self._held(text) if text else []
            if len(held):
                lo, n = self.starts[held], self.starts[held + 1] - self.starts[held]
                at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
                key = self.key[at]
                order = np.argsort(key, kind="stable")
                key, word = key[order], np.repeat(held, n)[order]
                own = key >> 32
                begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                count = np.diff(np.append(begin, len(own)))
                best = np.lexsort((own[begin], key[begin] & 0xFFFFFFFF, -count))[:most]
                begin, count = begin[best], count[best]
                five = np.minimum(count, 5)
                shown.append(word[np.arange(five.sum()) + np.repeat(begin - (np.cumsum(five) - five), five)])
                cell.append(own[begin])
                hits.append(count)
                first.append(key[begin] & 0xFFFFFFFF)
                sizes.append(five)
                lists.append(lists[-1] + len(begin))
            else:
                lists.append(lists[-1])
        flat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        words = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(flat(sizes)))), pa.int32()), self.words.take(pa.array(flat(shown))))
        at = pa.array(flat(cell))
        rows = pa.StructArray.from_arrays([self.segments.take(at), self.subsegments.take(at), pa.array(flat(hits), pa.int64()), pa.array(flat(first), pa.int32()), words], fields=list(CELL_TYPE.value_type))
        return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), rows)

    def _held(self, text: str) -> np.ndarray:
        """The words in a text, those inside others too."""
        return np.array(sorted({k for _, k in self.machine.iter(text)}), np.int64)


def _merged(parts: list[pa.Array], most: int | None) -> pa.Array:
    """The cells of the same texts by several blocks as one list each, in order."""
    sizes = [p.value_lengths().to_numpy() for p in parts]
    flat = pa.concat_arrays([p.flatten() for p in parts])
    text = np.concatenate([np.repeat(np.arange(len(n)), n) for n in sizes])
    names = [pc.fill_null(flat.field(c), "") for c in ("segment", "subsegment")]
    keys = pa.table({"text": text, "less": pc.negate(flat.field("hits")), "first": flat.field("first"), "s": names[0], "u": names[1]})
    order = pc.sort_indices(keys, [(c, "ascending") for c in keys.column_names]).to_numpy()
    text, number = text[order], sum(sizes)
    if most is not None:
        own = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number) < most
        order, number = order[own], np.minimum(number, most)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(number))), pa.int32()), flat.take(pa.array(order)))


class _Spill:
    """Byte strings in a file without a name, to be read again in order."""

    def __init__(self):
        self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)

    def add(self, data: bytes) -> None:
        self.file.write(len(data).to_bytes(8, "little") + data)

    def __iter__(self) -> Iterator[bytes]:
        self.file.seek(0)
        while size := self.file.read(8):
            yield self.file.read(int.from_bytes(size, "little"))


def _find_many(columns: list[str], blocks: int, most: int | None):
    """Arrow iterator over partitions of a slice: first the packed keywords, block by block, then the texts.

    With one block the texts stream through. With more they wait in a file, packed, and go past one block after the other, so
    that a task holds one block at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([[]], CELL_TYPE)
        words, told = None, {}
        waiting = _Spill() if blocks > 1 else None

        def found(words: _Words | None, t: pa.Table) -> pa.Array:
            return words.cells(t["_t"].to_pylist(), most) if words else pa.concat_arrays([none] * t.num_rows)  # a block may have no cell

        def rows(t: pa.Table, cells: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[t[c].combine_chunks() for c in columns], cells], names=[*columns, "cells"])

        for b in batches:
            for block, packed in zip(b.column("_block").to_pylist(), b.column("_packed")):
                data = packed.as_py()
                if block != TEXTS:
                    if block not in told:
                        told[block] = _Spill() if blocks > 1 else []
                    (told[block].add if blocks > 1 else told[block].append)(data)
                elif waiting is not None:
                    waiting.add(data)
                else:
                    if told:
                        words = _Words(told.pop(0))
                    t = pa.ipc.open_stream(data).read_all()
                    yield rows(t, found(words, t))
        if waiting is None:
            return
        parts = []
        for block in sorted(told):
            words = None  # the one before goes first
            words = _Words(list(told.pop(block)))
            parts.append(_Spill())
            for data in waiting:
                parts[-1].add(_table(pa.table({"cells": found(words, pa.ipc.open_stream(data).read_all())})))
        words = None
        for data, *cells in zip(waiting, *parts):
            t = pa.ipc.open_stream(data).read_all()
            yield rows(t, _merged([pa.ipc.open_stream(c).read_all()["cells"].combine_chunks() for c in cells], most) if cells else found(None, t))

    return run


def _many_cells(docs: DataFrame, kw: DataFrame, columns: list[str], blocks: int, most: int | None) -> DataFrame:
    """keyword_cells() of a list of any length: it stays in executors. Each slice of the texts gets the packed list, then its texts.

    Shuffled are the texts once, packed, with the columns that stay; and the packed list once for each slice.
    """
    slices = 2 * docs.sparkSession.sparkContext.defaultParallelism
    block = F.pmod(F.xxhash64("segment", "subsegment"), F.lit(blocks)).cast("int").alias("_block")
    kw = kw.select("kw_ord", "keyword", "segment", "subsegment", block).repartition(slices, "keyword").sortWithinPartitions("_block", "keyword", "kw_ord")
    packed = keep(kw.mapInArrow(_pack, "_block int, _packed binary"), "keywords").select(F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_s"), "_block", "_packed")
    texts = docs.mapInArrow(_pack_texts(slices), "_s int, _block int, _packed binary")
    both = texts.union(packed).repartitionById(slices, F.col("_s")).sortWithinPartitions("_block").select("_block", "_packed")
    kept = docs.select(*columns).schema.fields
    return both.mapInArrow(_find_many(columns, blocks, most), ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"cells {CELLS}"]))


def keyword_cells(docs: DataFrame, keywords: DataFrame, text: str = "text", most_bytes: int = 4 << 20, most_rows: int = 12_000_000, columns: list[str] | None = None, best: int | None = None) -> DataFrame:
    """docs plus cells: array of (segment, subsegment, hits, first, words), most hits first, then the smaller keyword order.

    keywords: kw_ord (not negative), keyword, segment, subsegment; those of 3 characters or more count if the folded text
    holds them, once each. hits: how many; first: the smallest kw_ord; words: the first 5. A text is passed over once,
    however many keywords there are. Lists up to most_bytes are broadcast and the texts stay where they are; longer ones
    don't pass the driver: the texts are dealt into slices, to each of which the packed list goes. Lists over most_rows
    go in blocks of whole cells, one pass each. columns: those of docs that stay, all without it; best: how many of a text's
    cells are asked for, the list may hold more.
    """
    spark = docs.sparkSession
    kw = keywords.where(F.length("keyword") >= 3).select(F.col("kw_ord").cast("int").alias("kw_ord"), F.lower("keyword").alias("keyword"), "segment", "subsegment")
    size, number = kw.agg(F.sum(F.octet_length("keyword") + F.coalesce(F.octet_length("segment"), F.lit(0)) + F.coalesce(F.octet_length("subsegment"), F.lit(0)) + 64), F.count("*")).first()
    if (size or 0) > most_bytes:
        columns = columns or docs.columns
        return _many_cells(docs.select(*columns, F.lower(text).alias("_t")), kw, columns, number // most_rows + 1, best)
    rows = sorted((tuple(r) for r in kw.collect()), key=lambda r: (r[0], r[1], r[2] or "", r[3] or ""))
    return docs.withColumn("cells", F.arrow_udf(_find_cells(spark.sparkContext.broadcast(rows)), CELLS)(F.lower(text)))


def keyword_hits(docs: DataFrame, keywords: DataFrame, text: str = "text") -> DataFrame:
    """id, segment, subsegment, hits, first, words: a row for each cell that a text has keywords of."""
    return keyword_cells(docs, keywords, text, columns=["id"]).select("id", F.inline("cells"))


def classify(docs: DataFrame, keywords: DataFrame, text: str = "text") -> DataFrame:
    """id, segment, subsegment, hits, confidence, is_ambiguous, words of the best cell: most hits, then the first keyword."""
    rows = keyword_cells(docs, keywords, text, columns=["id"], best=2).where("size(cells) > 0").select("id", F.col("cells")[0].alias("c"), F.try_element_at("cells", F.lit(2))["hits"].alias("next"))
    ambiguous = F.coalesce(F.col("next") >= AMBIGUOUS * F.col("c.hits"), F.lit(False))
    return rows.select("id", "c.segment", "c.subsegment", "c.hits", F.least(F.lit(0.95), 0.5 + 0.1 * F.col("c.hits")).alias("confidence"), ambiguous.alias("is_ambiguous"), "c.words")


def top_cells(docs: DataFrame, keywords: DataFrame, k: int = 5, text: str = "text") -> DataFrame:
    """id, rank and the cell of each text's k best cells."""
    rows = keyword_cells(docs, keywords, text, columns=["id"], best=k).select("id", F.posexplode(F.slice("cells", 1, k)).alias("rank", "c"))
    return rows.select("id", "c.*", (F.col("rank") + 1).alias("rank"))


def decide(rows: DataFrame, auto_apply: bool = True) -> DataFrame:
    """rows (segment, subsegment, new_segment, new_subsegment, confidence, is_ambiguous) -> plus reasons, decision ('review', 'apply', 'update' or 'none')."""
    changed = ~(F.col("segment").eqNullSafe(F.col("new_segment")) & F.col("subsegment").eqNullSafe(F.col("new_subsegment")))
    known = F.coalesce("segment", F.lit("")).isin("", "Other") == F.lit(False)
    reasons = F.array_compact(F.array(F.when(F.col("confidence") < UNSURE, "LOW_CONFIDENCE"), F.when(F.col("is_ambiguous"), "MULTIPLE_MATCHES"), F.when(changed & known, "SEGMENT_CHANGE")))
    out = rows.withColumn("reasons", reasons)
    only_change = (F.size("reasons") == 1) & (F.try_element_at("reasons", F.lit(1)) == "SEGMENT_CHANGE")
    return out.withColumn("decision", F.when(F.lit(auto_apply) & only_change & (F.col("confidence") >= APPLY), "apply").when(F.size("reasons") > 0, "review").when((F.col("confidence") >= UNSURE) & changed, "update").otherwise("none"))


def taxonomy(segments: DataFrame) -> DataFrame:
    """segment, subsegment of nested taxonomy rows."""
    return segments.select("segment", F.explode("subsegments").alias("s")).select("segment", F.col("s.subsegment").alias("subsegment"))


def valid_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """rows plus is_valid: whether (segment, subsegment) is a cell of the taxonomy."""
    return rows.join(cells.distinct().withColumn("_ok", F.lit(True)), ["segment", "subsegment"], "left").withColumn("is_valid", F.coalesce("_ok", F.lit(False))).drop("_ok")


def prompt(title: str = "title", description: str = "description", cells: str = "") -> F.Column:
    """Question for a model: numbered cells, then the book with its description cut at 1000 characters."""
    return F.concat_ws("\n", F.lit(cells), F.concat(F.lit("Title: "), F.col(title)), F.concat(F.lit("Description: "), T.shorten(description, 1000)))


def model_classify(docs: DataFrame, make_client: Callable[[], Callable[[str], str]], cells: DataFrame) -> DataFrame:
    """id, segment, subsegment, confidence, reasoning, error, is_valid from a model's replies. docs: id, title, description.

    make_client is called once per task. Equal questions are asked once. A failing call gives an error, not a failed job.
    """
    text = "\n".join(f"{i}. {r.segment} / {r.subsegment}" for i, r in enumerate(cells.orderBy("segment", "subsegment").collect(), 1))
    asked = docs.withColumn("question", prompt(cells=text))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make_client()
        for b in batches:
            replies, errors = [], []
            for q in b["question"]:
                try:
                    replies.append(call(q))
                    errors.append(None)
                except Exception as e:  # a reply that fails is a row, so that one bad call doesn't end the job
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"question": b["question"], "reply": replies, "error": errors})

    answers = asked.select("question").distinct().mapInPandas(run, "question string, reply string, error string")
    verdict = F.from_json(T.reply_json("reply"), "segment string, subsegment string, confidence double, reasoning string")
    out = asked.join(answers, "question").withColumn("v", verdict).select("id", "v.*", F.when(F.col("error").isNull() & F.col("v.segment").isNull(), "no verdict").otherwise(F.col("error")).alias("error"))
    return valid_cells(out, cells)


def usage(calls: DataFrame) -> DataFrame:
    """Totals of call rows (input_tokens, output_tokens)."""
    return calls.agg(F.count("*").alias("total_calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"))
