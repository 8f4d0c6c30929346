"""Against a plain greedy parse, and on held-out rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursetide.llm import langid

from ..conftest import TESTDATA
from .data import awkward, documents, prose

TEXTS = ("the cat sat on the mat and that was that", "der hund und die katze und der hund")


def plain_phrases(text, known):
    text, count, at = langid.normalised(text), 0, 0
    for first in range(0, len(text), langid.BLOCK):
        block, at = text[first : first + langid.BLOCK], 0
        while at < len(block):
            end = at + 1
            while end <= len(block) and block[at:end] in known:
                end += 1
            at, count = max(at + 1, end - 1), count + 1
    return count, len(text)


def test_rates_equal_a_greedy_parse(monkeypatch):
    model = langid.Model(langid.Sample(("en", "de"), TEXTS))
    draw = random.Random(3)
    texts = ["The hund! sat", "xyz", "on the  mat und die", "", " 12 ", "é", "Katze"]
    texts += ["".join(draw.choices("thecatsundr é.", k=draw.randrange(1500))) for _ in range(30)]
    for text, rates in zip(texts, model.rates(texts), strict=True):
        for rate, known in zip(rates, TEXTS, strict=True):
            phrases, size = plain_phrases(text, known)
            if not any(c.isalpha() for c in text):
                assert math.isnan(rate)
            else:
                assert rate == pytest.approx(phrases * math.log2(len(known) + 1) / size)


def test_batches_do_not_matter(monkeypatch):
    model = langid.Model(langid.Sample(("en", "de"), TEXTS))
    texts = [prose(k, 30 + k, "de" if k % 3 else "en") for k in range(30)] + [None, "", "1"]
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "AT_ONCE", 100)
    assert model.predict(texts) == whole
    assert whole[0][-3:] == ["und"] * 3 and whole[1][-3:] == [0.0] * 3


def test_learns_and_predicts(spark):
    rows = [(k, prose(k, 60, lang), lang) for k in range(60) for lang in ("en", "de")] + [(k, prose(k, 60), None) for k in range(9)]
    sample = langid.learn(documents(spark, rows))
    assert sorted(sample.languages) == ["de", "en"]
    odd = documents(spark, [*awkward(), (70, prose(999, 40, "de"))], clash=True)
    out = langid.identify(odd, sample)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(awkward()) + 1
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        if r.doc_id == 70:
            assert r.lang_pred == "de"


def test_nothing_to_learn(spark):
    for rows in ([], [(1, None, "en"), (2, "text", None), (3, "123", "en")]):
        sample = langid.learn(documents(spark, rows))
        assert sample.languages == ()
        [r] = langid.identify(documents(spark, [(1, "text")]), sample).collect()
        assert (r.lang_pred, r.score) == ("und", 0.0)
    assert langid.identify(documents(spark, []), langid.Sample(("en",), ("text",))).count() == 0


def test_held_out_rows(spark):
    from coursetide.llm.queries import op4_cross_parsing

    folder = str(TESTDATA / "sf0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_cross_parsing(spark, folder).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held) > 0


def test_all_of_many_languages_are_learned(spark):
    """Each has words of its own; the last by name has the fewest rows."""
    draw = random.Random(5)
    words = [["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for _ in range(80)]
    rows = [(100 * k + j, " ".join(draw.choices(words[k], k=30)), f"l{k:02}") for k in range(80) for j in range(2 + (k < 60))]
    sample = langid.learn(documents(spark, rows))
    assert len(sample.languages) == 80
    asked = [(k, " ".join(draw.choices(words[k], k=20))) for k in range(80)]
    got = langid.identify(documents(spark, asked), sample).collect()
    assert all(r.lang_pred == f"l{r.doc_id:02}" for r in got)


def signs(seed, size, first, kinds):
    """Text of a script with very many signs, in which neighbours follow each other more often than others."""
    draw, at, out = random.Random(seed), 0, []
    for _ in range(size):
        at = (at + draw.choice((1, 1, 2, draw.randrange(kinds)))) % kinds
        out.append(chr(first + at))
    return "".join(out)


@pytest.mark.parametrize("single", [0, 5, 250])
def test_large_scripts_are_parsed_like_small_ones(single):
    """Over a thousand signs: all of them count, and two signs a letter give the phrases of one."""
    known = signs(1, 4000, 0x4E00, 1500)
    assert len(set(known)) > 1000
    for text in (known, TEXTS[0]):
        automaton = langid.Automaton(text, single)
        assert len(automaton.letters) == len(set(text))
        asked = [text[50:90] + text[10:30], signs(2, 300, 0x4E00, 1500), "x" + text[5:9] + "字", text[-3:] + text[:3]]
        for other in asked:
            letters = np.array([[automaton.letters.get(c, 0) for c in other]])
            want, at = 0, 0
            while at < len(other):
                end = at + 1
                while end <= len(other) and other[at:end] in text:
                    end += 1
                at, want = max(at + 1, end - 1), want + 1
            assert automaton.phrases(letters, np.array([len(other)])).tolist() == [want]


def test_languages_of_large_scripts_are_told_apart(spark):
    first = {"zh": 0x4E00, "yue": 0x4E00 + 900, "ko": 0xAC00}
    rows = [(100 * k + n, signs(100 * k + n, 300, f, 1500), lang) for k, (lang, f) in enumerate(first.items()) for n in range(60)]
    sample = langid.learn(documents(spark, rows))
    asked = [(k, signs(9000 + k, 80, f, 1500)) for k, f in enumerate(first.values())]
    found = {r.doc_id: r.lang_pred for r in langid.identify(documents(spark, asked), sample).collect()}
    assert found == dict(enumerate(first))


def test_a_text_in_a_column_that_is_replaced(spark):
    sample = langid.Sample(("en", "de"), TEXTS)
    docs = documents(spark, [(1, "der hund")]).select("doc_id", F.col("text").alias("score"))
    [r] = langid.identify(docs, sample, text="score").collect()
    assert (r.doc_id, r.lang_pred) == (1, "de") and r.score > 0.5
