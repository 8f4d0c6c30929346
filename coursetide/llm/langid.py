"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text answers, letter by letter, how long the text at
hand goes on like something in that language. A text is parsed greedily: each phrase is the longest
match, the next one starts behind it. The fewer phrases, the likelier the language; phrases times
the logarithm of the automaton's text length, by letter, estimate the cross entropy, and the
language of the smallest estimate wins.

Texts are lower-cased, and what is between letters becomes one space. Each block of ``BLOCK`` of these
characters is parsed by itself, many blocks side by side, so long texts take no more memory than
short ones. All characters of all texts are parsed.

A null text or one without a letter is ``und`` with score 0, and so is every text if nothing could be
learned. Equal estimates go to the language with more labelled rows, then to the first by name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import few_at_once

#: Characters of labelled text per language and of all languages together, rows they are drawn from and
#: what one row may give. All languages are learned: the more there are, the fewer characters of each, down to ``LEAST``.
CHARS, ALL_CHARS, ROWS, ROW_CHARS, LEAST = 40_000, 600_000, 200, 4_000, 1_000
#: Letters up to which one is one column of an automaton's table. Those of larger scripts are two signs each, a high and a
#: low one of ``LOW`` kinds, and a match always ends with a whole letter: the same phrases, from a narrow table.
SINGLE, LOW = 250, 64
BLOCK, AT_ONCE = 512, 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Sample:
    """Normalised text by language, most labelled rows first."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def normalised(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Sample:
    """A bounded sample of the labelled rows of ``docs``, spread over them by a hash of id and text.

    A row gives ``ROW_CHARS`` characters at most, from a hashed place in its text.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang is not null and text is not null"
    )
    counted = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    limit = min(CHARS, max(LEAST, ALL_CHARS // max(1, len(counted))))
    rows_each, row_chars = max(30, ROWS * limit // CHARS), min(ROW_CHARS, limit)
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, rows_each / r["n"])) for r in counted], "lang string, rate double")
    spread = F.pmod(F.xxhash64("doc_id", F.lit("lang"), "text"), F.lit(1 << 20))
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - row_chars)).cast("int") + 1
    some = known.join(F.broadcast(rates), "lang").where(spread < F.col("rate") * (1 << 20))
    drawn = some.select(F.xxhash64("doc_id", "text").alias("mix"), "lang", F.substr("text", place, F.lit(row_chars)).alias("text"))
    texts: dict[str, list[str]] = {}
    # equal rows are one, so that neither repeats nor a constant id make the draw larger; sorted here, as a sort in
    # Spark would run it twice, and by a hash, so that where it is cut does not follow the ids
    for row in sorted(drawn.distinct().collect()):
        texts.setdefault(row["lang"], []).append(normalised(row["text"]))
    found = {k: " ".join(filter(None, v))[:limit] for k, v in texts.items()}
    names = tuple(row["lang"] for row in counted if found.get(row["lang"]))
    return Sample(names, tuple(found[name] for name in names))


class Automaton:
    """All substrings of a text, as a table of states and signs.

    ``follow[state + sign]`` is the next state, or -1 where the match ends; states are
    multiples of the table's width. Letter and sign 0 are any that the text doesn't have.
    """

    def __init__(self, text: str, single: int = SINGLE):
        common = sorted(set(text))
        self.letters = {c: k + 1 for k, c in enumerate(common)}
        numbers = np.array([self.letters[c] for c in text], "i8")
        every = np.arange(len(common) + 1)
        if len(common) <= single:
            self.high, self.low, signs = every, None, numbers
        else:
            highs = -(-len(common) // LOW)
            self.high = np.where(every > 0, 1 + (every - 1) // LOW, 0)
            self.low = np.where(every > 0, 1 + highs + (every - 1) % LOW, 0)
            signs = np.stack((self.high[numbers], self.low[numbers]), axis=1).ravel()
        edges: list[dict[int, int]] = [{}]
        length, link, last = [0], [-1], 0
        for c in signs.tolist():
            new = len(edges)
            edges.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and c not in edges[at]:
                edges[at][c] = new
                at = link[at]
            if at >= 0:
                other = edges[at][c]
                if length[at] + 1 == length[other]:
                    link[new] = other
                else:
                    copy = len(edges)
                    edges.append(dict(edges[other]))
                    length.append(length[at] + 1)
                    link.append(link[other])
                    while at >= 0 and edges[at].get(c) == other:
                        edges[at][c] = copy
                        at = link[at]
                    link[other] = link[new] = copy
            last = new
        width = int(signs.max(initial=0)) + 1
        table = np.full((len(edges) + 1, width), -1, "i4")  # the last state has no way on
        for state, ways in enumerate(edges):
            for c, to in ways.items():
                table[state, c] = to * width
        self.follow = table.ravel()
        self.nowhere = len(edges) * width
        self.first = self._next(np.zeros(len(every), "i4"), every)
        self.first[self.first < 0] = self.nowhere
        self.bits = np.log2(len(text) + 1)

    def _next(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        to = self.follow[state + self.high[letter]]
        if self.low is None:
            return to
        return self.follow[np.where(to < 0, self.nowhere, to) + self.low[letter]]

    def phrases(self, blocks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of phrases of each row of letters; rows stand by size, largest first."""
        count = np.zeros(len(blocks), "i4")
        state = np.full(len(blocks), self.nowhere, "i4")
        rows = np.searchsorted(-sizes, -np.arange(blocks.shape[1]), side="left")  # longer than the column's number
        for column, n in enumerate(rows.tolist()):
            letter = blocks[:n, column]
            to = self._next(state[:n], letter)
            ended = np.flatnonzero(to < 0)
            count[ended] += 1
            to[ended] = self.first[letter[ended]]
            state[:n] = to
        return count


class Model:
    def __init__(self, sample: Sample):
        self.languages = sample.languages
        self.automata = [Automaton(text) for text in sample.texts]
        letters = sorted({c for a in self.automata for c in a.letters} - {" "})
        # one number for each letter that any language knows; 0 between letters, 1 other letters
        self.number = np.zeros(0x110000, "u2")
        self.number[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
        self.number[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.own = []
        for a in self.automata:
            own = np.zeros(len(letters) + 2, "i4")
            own[0] = a.letters.get(" ", 0)
            own[2:] = [a.letters.get(c, 0) for c in letters]
            self.own.append(own)

    def rates(self, texts: list[str]) -> np.ndarray:
        """Estimated bits per character, a row per text and a column per language; nan without letters."""
        points = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), "u4") for t in texts]
        which = np.repeat(np.arange(len(texts)), [len(p) for p in points])
        numbers = self.number[np.concatenate(points)] if points else np.zeros(0, "u2")
        new_text = np.concatenate(([True], which[1:] != which[:-1])) if len(which) else np.zeros(0, bool)
        before = np.concatenate(([0], numbers[:-1])) if len(numbers) else numbers
        kept = (numbers != 0) | ((before != 0) & ~new_text)
        numbers, which = numbers[kept], which[kept]
        # nor is there a space behind a text's last letter
        last = np.concatenate((which[1:] != which[:-1], [True])) if len(which) else np.zeros(0, bool)
        numbers, which = numbers[~last | (numbers != 0)], which[~last | (numbers != 0)]
        size = np.bincount(which, minlength=len(texts))
        blocks_of = -(-size // BLOCK)
        block_text = np.repeat(np.arange(len(texts)), blocks_of)
        nth = np.arange(len(block_text)) - np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of)
        sizes = np.minimum(BLOCK, size[block_text] - nth * BLOCK)
        starts = (np.cumsum(size) - size)[block_text] + nth * BLOCK
        order = np.argsort(-sizes, kind="stable")
        sizes, starts, block_text = sizes[order], starts[order], block_text[order]
        places = np.minimum(starts[:, None] + np.arange(BLOCK), max(0, len(numbers) - 1))
        blocks = numbers[places] if len(numbers) else np.zeros((0, BLOCK), "u2")
        out = np.full((len(texts), len(self.automata)), np.nan)
        lettered = np.bincount(which, numbers > 0, len(texts)) > 0
        for k, a in enumerate(self.automata):
            count = np.bincount(block_text, a.phrases(self.own[k][blocks], sizes), len(texts))
            out[lettered, k] = count[lettered] * a.bits / size[lettered]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        first = held = 0
        for n, text in enumerate(texts):
            held += len(text or "")
            if held >= AT_ONCE or n + 1 == len(texts):
                for rate in self.rates([t or "" for t in texts[first : n + 1]]):
                    if not len(rate) or np.isnan(rate[0]):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                    else:
                        best = int(rate.argmin())
                        names.append(self.languages[best])
                        scores.append(float(1 / ((rate[best] / rate) ** 8).sum()))
                first, held = n + 1, 0
        return names, scores


@functools.lru_cache(maxsize=2)
def _model(sample: Sample) -> Model:
    return Model(sample)


def identify(docs: DataFrame, sample: Sample, *, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score of 0 to 1; columns of these names are replaced."""

    kept = [c for c in docs.columns if c not in (lang, score)]
    known = docs.select(*(F.col(f"`{c}`") for c in kept))
    # a text in a column that is replaced is sent along beside the others
    rows = known if text in kept else docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("\0text"))
    at = rows.columns.index(text if text in kept else "\0text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, at, AT_ONCE):
            names, scores = _model(sample).predict(batch.column(at).to_pylist())
            found = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *found], [*kept, lang, score])

    return rows.mapInArrow(run, known.withColumns({lang: F.lit(""), score: F.lit(0.0)}).schema)
