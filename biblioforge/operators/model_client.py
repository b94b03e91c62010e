"""Language-model calls from Spark: providers behind an interface, a reply table that spares repeated questions, usage by observation."""

from __future__ import annotations

import json
import time
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from biblioforge.functions import text as T
from biblioforge.operators.classify import prompt, valid_cells

REPLY_DDL = "question string, reply string, input_tokens long, output_tokens long, error string"


@dataclass
class Reply:
    text: str
    input_tokens: int = 0
    output_tokens: int = 0


class ModelClient(ABC):
    """One per task; made on the executor."""

    provider = ""

    @abstractmethod
    def call(self, question: str) -> Reply: ...


def _post(url: str, headers: dict, body: dict) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"content-type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=60) as r:
        return json.loads(r.read())


class HttpClient(ModelClient):
    """A provider's REST interface: how a question becomes a request, and a response a reply. `post` is injected in tests."""

    def __init__(self, provider: str, key: str, model: str, post: Callable[[str, dict, dict], dict] = _post):
        self.provider, self.key, self.model, self.post = provider, key, model, post

    def call(self, question: str) -> Reply:
        turn = [{"role": "user", "content": question}]
        if self.provider == "claude":
            r = self.post("https://api.anthropic.com/v1/messages", {"x-api-key": self.key, "anthropic-version": "2023-06-01"}, {"model": self.model, "max_tokens": 1024, "messages": turn})
            return Reply(r["content"][0]["text"], r["usage"]["input_tokens"], r["usage"]["output_tokens"])
        if self.provider == "openai":
            r = self.post("https://api.openai.com/v1/chat/completions", {"authorization": f"Bearer {self.key}"}, {"model": self.model, "messages": turn})
            return Reply(r["choices"][0]["message"]["content"], r["usage"]["prompt_tokens"], r["usage"]["completion_tokens"])
        r = self.post(f"https://generativelanguage.googleapis.com/v1beta/models/{self.model}:generateContent", {"x-goog-api-key": self.key}, {"contents": [{"parts": [{"text": question}]}]})
        return Reply(r["candidates"][0]["content"]["parts"][0]["text"])  # this provider's usage isn't counted


PROVIDERS: dict[str, Callable[..., ModelClient]] = {p: (lambda key="", model="", p=p, **more: HttpClient(p, key, model, **more)) for p in ("claude", "openai", "gemini")}


def register_provider(name: str, make: Callable[..., ModelClient]) -> None:
    PROVIDERS[name] = make


def create_client(provider: str, **options) -> ModelClient:
    """A client of a registered provider. Keys are options: nothing is read from the environment."""
    if provider not in PROVIDERS:
        raise ValueError(f"unknown provider {provider!r}; known are {sorted(PROVIDERS)}")
    return PROVIDERS[provider](**options)


class ReplyTable:
    """Replies by question in an append-only table. Failed calls aren't kept, so a later run asks again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], REPLY_DDL)
        return self.spark.read.schema(REPLY_DDL).parquet(self.path)

    def ask(self, questions: DataFrame, make_client: Callable[[], ModelClient], per_second: float | None = None, tasks: int = 8) -> tuple[DataFrame, dict]:
        """(question, reply, input_tokens, output_tokens, error) of each distinct question, and the usage of this run.

        Only questions without a reply in the table are asked. per_second bounds the calls of all tasks together.
        """
        known = self.load()
        new = questions.select("question").where("question is not null").distinct().join(known.select("question"), "question", "left_anti")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            client, pause = None, tasks / per_second if per_second else 0.0
            for b in batches:
                out = []
                for q in b["question"]:
                    began = time.monotonic()
                    try:
                        client = client or make_client()
                        r = client.call(q)
                        out.append((q, r.text, r.input_tokens, r.output_tokens, None))
                    except Exception as e:  # a call that fails is a row, so that it doesn't end the job
                        out.append((q, None, 0, 0, f"{type(e).__name__}: {e}"))
                    if pause:
                        time.sleep(max(0.0, pause - (time.monotonic() - began)))
                yield pd.DataFrame(out, columns=["question", "reply", "input_tokens", "output_tokens", "error"]).astype({"input_tokens": "int64", "output_tokens": "int64"})

        told = Observation()
        asked = new.repartition(tasks, "question").mapInPandas(run, REPLY_DDL)
        asked = asked.observe(told, F.count("*").alias("calls"), F.count("error").alias("failed"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
        # Written once, so that no call is made twice; failed rows go to the result alone, from the same write.
        folder = f"{self.path}_runs/{time.time_ns()}"
        asked.write.parquet(folder)
        rows = self.spark.read.schema(REPLY_DDL).parquet(folder)
        rows.where("error is null").write.mode("append").parquet(self.path)
        usage = {k: int(v or 0) for k, v in told.get.items()}
        wanted = questions.select("question").distinct()
        return wanted.join(self.load(), "question").union(rows.where("error is not null").join(wanted, "question", "left_semi")), usage


def classify_records(docs: DataFrame, make_client: Callable[[], ModelClient], cells: DataFrame, table: ReplyTable, **how) -> tuple[DataFrame, dict]:
    """id, segment, subsegment, confidence, reasoning, error, error_kind, is_valid of docs (id, title, description), and the usage.

    error_kind: 'call' (the provider failed), 'reply' (no verdict in it), 'cell' (no cell of the taxonomy) or null. cells is
    a config table; its numbered list is part of every question.
    """
    text = "\n".join(f"{i}. {r.segment} / {r.subsegment}" for i, r in enumerate(cells.orderBy("segment", "subsegment").collect(), 1))
    asked = docs.withColumn("question", prompt(cells=text))
    replies, usage = table.ask(asked, make_client, **how)
    verdict = F.from_json(T.reply_json("reply"), "segment string, subsegment string, confidence double, reasoning string")
    out = asked.join(replies.withColumnRenamed("error", "failure"), "question", "left").withColumn("v", verdict)
    out = valid_cells(out.select("id", "v.segment", "v.subsegment", "v.confidence", "v.reasoning", "failure"), cells)
    kind = F.when(F.col("failure").isNotNull(), "call").when(F.col("segment").isNull(), "reply").when(~F.col("is_valid"), "cell")
    message = F.when(kind == "call", F.col("failure")).when(kind == "reply", "no verdict").when(kind == "cell", F.concat(F.lit("no such cell: "), F.concat_ws(" / ", "segment", "subsegment")))
    return out.select("id", "segment", "subsegment", "confidence", "reasoning", message.alias("error"), kind.alias("error_kind"), "is_valid"), usage
