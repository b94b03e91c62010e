import random

import pytest

from biblioforge.llm import token_counts
from biblioforge.llm.common import Scratch

DDL = "doc_id long, source string, lang string, text string, op string, order long, n_tokens string"


def totals(roll):
    return {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in roll.totals().collect()}


def brute(batches):
    state = {}
    for batch in batches:
        last = {}
        for i, source, lang, text, op, order, _ in batch:
            if i is not None:
                strength = {"delete": 2, "revise": 1}.get(op, 0)
                n = 0 if op == "delete" else len((text or "").split())
                rank = ((order is not None, order or 0), strength, (source is not None, source or ""), (lang is not None, lang or ""), n)
                new = (rank, None if op == "delete" else (source, lang, n))
                last[i] = max(last.get(i, new), new, key=lambda x: x[0])
        for i, (_, value) in last.items():
            state[i] = value
    out = {}
    for value in state.values():
        if value:
            docs, n = out.get(value[:2], (0, 0))
            out[value[:2]] = docs + 1, n + value[2]
    return out


def test_batches_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "COMPACT", 3)
    r = random.Random(1)
    ops = ["insert", "revise", "delete", None]
    row = lambda: (r.choice([None, *range(12)]), r.choice(["s", "t", None]), r.choice(["en", None]), r.choice([None, "", "a b", "a b c d"]), r.choice(ops), r.choice([None, 1, 2]), "x")
    batches = [[row() for _ in range(20)], [], *[[row() for _ in range(8)] for _ in range(3)]]
    batches[2] += [batches[2][0]] * 2
    roll = token_counts.TokenRollup(spark, Scratch(spark, "r").path("x"), ["whitespace-1"])
    for k, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, DDL)
        assert roll.commit(f"b{k}", frame) and not roll.commit(f"b{k}", frame)
        assert totals(roll) == brute(batches[: k + 1])
    assert len(roll._names("bases")) == 1


def test_delete_after_revision_and_claims(spark):
    roll = token_counts.TokenRollup(spark, Scratch(spark, "r").path("x"), ["whitespace-1"])
    one = spark.createDataFrame([(1, "s", "en", "a b", "revise", None, ""), (1, "s", "en", None, "delete", None, ""), (2, "s", "en", "a", "delete", 1, ""), (2, "s", "en", "a b c", "revise", 2, "")], DDL)
    roll._claim(0, "one")  # a writer that broke off
    with pytest.raises(RuntimeError, match="one"):
        roll.commit("two", one)
    assert roll.commit("one", one)
    assert totals(roll) == {("s", "en"): (1, 3)}
