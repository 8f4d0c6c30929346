"""The composed machine against its parts, planted words, and held-out rows."""

from __future__ import annotations

import random

from coursetide.llm import toxicity as tx

from ..conftest import TESTDATA
from .data import awkward, documents, prose

MODEL = tx.Model((("idiot", 5.0), ("moron", 4.0)), (("zork", 6.0),), -4.0, (3.0, 4.0, 5.0, 3.0, 1.0, 0.0, 0.5, 0.0))


def patterns(text):
    return [(p, w) for _, _, p, w in tx.Reader(MODEL).clauses(text)]


def test_patterns():
    assert patterns("") == patterns("a clean text. not bad, he said: fine.") == []
    assert patterns("What an IDIOT") == [("insult", 5.0)]
    assert patterns("idiot and moron") == [("insults", 9.0)]
    assert patterns("you idiot") == patterns("idiot you are") == [("insult+target", 5.0)]
    assert patterns("no idiot") == patterns("you are not an idiot") == [("negated", 5.0)]
    assert patterns("not that it matters now, idiot") == [("insult", 5.0)]
    assert patterns("he said idiot") == patterns('the word "idiot" is rude') == [("reported", 5.0)]
    assert patterns('"quote" idiot') == [("insult", 5.0)]
    assert patterns("zorkish. i will kill you") == [("insult", 6.0), ("threat+target", 1.0)]
    assert patterns("zork!") == []  # a beginning stands for longer words


def test_places():
    assert tx.Reader(MODEL).clauses("fine. you idiot! ok") == [(5, 15, "insult+target", 5.0)]


def test_composed_equals_one_after_another():
    machines = (tx._negation(), tx._reported(), tx._clause())
    follow, output = tx.compose(*machines)
    draw = random.Random(4)
    for _ in range(200):
        at, states = 0, [m.start for m in machines]
        for symbol in draw.choices(range(8), k=40):
            passed = symbol
            for k, machine in enumerate(machines):
                states[k], passed = machine.step(states[k], passed)
            assert output[at][symbol] == passed
            at = follow[at][symbol]


def test_learns_planted_words_and_leaves_clean_ones(spark):
    rows, labels = [], []
    draw = random.Random(8)
    invented = ["".join(draw.choices("abcdefghilmnoprstuv", k=6)) for _ in range(900)]
    for k in range(400):
        words = draw.choices(invented, k=60)
        if k % 4 == 0:
            for place in (5, 20, 40):
                words.insert(place + k % 7, "blarg" if k % 8 else f"snork{k % 5}en")
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    passage = " ".join(draw.choices(invented, k=50))  # in many toxic documents, but always the same
    rows += [(1000 + k, f"{passage} blarg {' '.join(draw.choices(invented, k=5))} blarg") for k in range(40)]
    labels += [(1000 + k, 1) for k in range(40)] + [(None, 1), (5, None)]
    docs = documents(spark, rows)
    model = tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "blarg" in dict(model.words) and "snor" in dict(model.starts)
    scored = {r.doc_id: r.score for r in tx.score(docs, model).collect()}
    assert all((scored[k] >= 0.3) == (k >= 1000 or k % 4 == 0) for k in scored)
    clean = tx.score(documents(spark, [(1, " ".join(draw.choices(invented, k=300))), (2, None), (3, "")]), model).collect()
    assert all(r.score < 0.3 for r in clean)
    odd = documents(spark, awkward(), clash=True)
    out = tx.score(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["score", "held", "clauses"]
    assert out.count() == len(awkward()) and all(0 <= r.score <= 1 for r in out.collect())


def test_nothing_to_learn(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        assert {r.score < 1e-9 for r in tx.score(docs, tx.learn(docs, known)).collect()} == {True}
    assert tx.score(documents(spark, []), MODEL).count() == 0


def test_held_out_rows(spark):
    from coursetide.llm.queries import op10_clause_grammar

    folder = str(TESTDATA / "sf0.1")
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op10_clause_grammar(spark, folder).collect() if r.held_out and r.doc_id in truth]
    toxic = [r for r in rows if truth[r.doc_id]]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic) > 0
