"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target (who is spoken to), negation, report (someone is quoted), others;
quotation marks and clause ends are symbols too. Small transducers read them in turn:

* negation turns an insult or threat within ``SCOPE`` words behind it into a negated one,
* reported speech turns one in quotation marks, or behind a reporting word in its clause, into a reported one,
* insult, threat and target count what is left and give a clause its pattern when it ends.

They are composed into one machine, so a text is read once. A pattern's weight is the sum of its words' weights;
a document's score is a logistic function of how much of each pattern it holds. Negated and reported words have
patterns of their own, whose effect, like all others, is learned.

Which words insult is learned too: words, and beginnings of four or five letters standing for all their forms,
that are found in far more contexts in documents of label 1. A context is a word with the word before it, so a
passage that many documents share counts once.

Null and empty texts have no clauses and get the score of a text without a match. Without labels of both kinds
nothing is an insult and all scores are 0. Texts of any length are read whole.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage, few_at_once, one_text_each

#: Labelled rows used in learning, of label 1 and of label 0, at most about.
TOXIC, CLEAN = 1500, 3000
#: Entries of the learned lexicon, the strongest ones; evidence (G squared; about one in a million by chance) and
#: ratio of rates that each must have.
ENTRIES, EVIDENCE, RATIO = 5000, 24.0, 8.0
SCOPE = 3

# Closed word classes of four languages, and threats.
_TARGET = "you your yours yourself u du dich dir dein deine ihr euch euer tu toi te ton ta vous votre ti contigo usted ustedes vosotros"
_NEGATION = "not no never neither nor without isn aren wasn weren don doesn didn won nicht kein keine keinen niemals nie ohne pas jamais aucun aucune sans nunca jamás ningún ninguna sin"
_REPORT = "said says say called calls told wrote writes claimed quoted according sagte sagt nannte schrieb laut dit disait appelé écrit selon dijo dice llamó escribió según"
_THREAT = "kill murder destroy hurt beat stab shoot hang töten umbringen zerstören schlagen erschießen tuer détruire frapper blesser matar destruir golpear herir"
_OTHER, _INSULT, _HARM, _YOU, _NOT, _SAID, _QUOTE, _END = range(8)
_FIXED = {
    word: symbol
    for symbol, words in ((_YOU, _TARGET), (_NOT, _NEGATION), (_SAID, _REPORT), (_HARM, _THREAT))
    for word in words.split()
}
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”„«»]")
_WORD = re.compile(r"[^\W\d_]+")
_ENDS, _QUOTES = frozenset(".!?;:\n"), frozenset("\"“”„«»")

#: What a clause can hold: insults (none, one, more), a threat, a target, something negated, something reported.
PATTERNS = ("insult", "insults", "insult+target", "threat+target", "threat", "negated", "reported")


class Transducer:
    """Deterministic: ``step(state, symbol)`` gives the next state and the symbol that is passed on."""

    def __init__(self, start, step):
        self.start, self.step = start, step


def _negation() -> Transducer:
    def step(left: int, symbol):
        if symbol == _NOT:
            return SCOPE, symbol
        if symbol in (_INSULT, _HARM):
            return left, (symbol, "negated") if left else symbol
        return (0 if symbol == _END else max(0, left - 1)), symbol

    return Transducer(0, step)


def _reported() -> Transducer:
    def step(state, symbol):
        said, quoted = state
        if symbol == _SAID:
            return (True, quoted), symbol
        if symbol == _QUOTE:
            return (said, not quoted), symbol
        if symbol == _END:
            return (False, quoted), symbol
        hit = symbol in (_INSULT, _HARM)
        return state, (symbol, "reported") if hit and (said or quoted) else symbol

    return Transducer((False, False), step)


def _clause() -> Transducer:
    """Gives the patterns of a clause at its end."""

    def step(state, symbol):
        insults, threat, target, negated, reported = state
        if symbol == _END:
            held = []
            if insults:
                held.append("insult+target" if target else "insults" if insults > 1 else "insult")
            if threat:
                held.append("threat+target" if target else "threat")
            held += ["negated"] * negated + ["reported"] * reported
            return (0, False, False, False, False), tuple(held)
        if isinstance(symbol, tuple):
            return (insults, threat, target, negated or symbol[1] == "negated", reported or symbol[1] == "reported"), None
        if symbol == _INSULT:
            insults = min(2, insults + 1)
        return (insults, threat or symbol == _HARM, target or symbol == _YOU, negated, reported), None

    return Transducer((0, False, False, False, False), step)


def compose(*machines: Transducer) -> tuple[list[list[int]], list[list[object]]]:
    """One machine that passes each symbol through all: tables of next states and of outputs, by state."""
    start = tuple(m.start for m in machines)
    number, todo = {start: 0}, [start]
    follow: list[list[int]] = []
    output: list[list[object]] = []
    for states in todo:  # grows while new states are found
        follow.append([])
        output.append([])
        for symbol in range(8):
            passed, after = symbol, []
            for machine, state in zip(machines, states, strict=True):
                state, passed = machine.step(state, passed)
                after.append(state)
            if (key := tuple(after)) not in number:
                number[key] = len(number)
                todo.append(key)
            follow[-1].append(number[key])
            output[-1].append(passed)
    return follow, output


@functools.lru_cache(maxsize=1)
def _grammar() -> tuple[list[list[int]], list[list[object]]]:
    return compose(_negation(), _reported(), _clause())


@dataclass(frozen=True)
class Model:
    """Learned words and beginnings with their weights, and the pattern's part in the score."""

    words: tuple[tuple[str, float], ...]
    starts: tuple[tuple[str, float], ...]
    bias: float = -30.0
    parts: tuple[float, ...] = (0.0,) * (len(PATTERNS) + 1)

    def score(self, held: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(held @ np.array(self.parts) + self.bias, -30, 30)))


class Reader:
    def __init__(self, model: Model):
        self.words, self.starts = dict(model.words), dict(model.starts)
        self.any = frozenset(self.words) | {w for w, s in _FIXED.items() if s == _HARM}
        self.follow, self.output = _grammar()

    def weight(self, word: str) -> float:
        found = [self.words.get(word)]
        found += [self.starts.get(word[:n]) for n in (4, 5) if len(word) > n]
        return max((x for x in found if x is not None), default=0.0)

    def clauses(self, text: str) -> list[tuple[int, int, str, float]]:
        """Start, end, pattern and weight of each pattern found."""
        lower = text.lower()
        words = set(_WORD.findall(lower))
        if self.any.isdisjoint(words) and not any(
            w[:4] in self.starts or w[:5] in self.starts for w in words if len(w) > 4
        ):
            return []
        weights = {w: x for w in words if w not in _FIXED and (x := self.weight(w))}
        found, state, held, start = [], 0, 0.0, 0
        tokens = [(m.group(), m.start()) for m in _TOKEN.finditer(lower)]
        for token, at in [*tokens, (".", len(lower))]:
            symbol = _INSULT if token in weights else _FIXED.get(token, _OTHER)
            if token in _ENDS:
                symbol = _END
            elif token in _QUOTES:
                symbol = _QUOTE
            held += weights.get(token, 1.0 if symbol == _HARM else 0.0)
            out, state = self.output[state][symbol], self.follow[state][symbol]
            if symbol == _END:
                found += [(start, at, pattern, held) for pattern in out]
                held, start = 0.0, at + 1
        return found


def held(clauses: list[tuple[int, int, str, float]]) -> np.ndarray:
    """How much of each pattern there is, and the weight of all plain insults; on a logarithmic scale."""
    out = np.zeros(len(PATTERNS) + 1)
    for _, _, pattern, weight in clauses:
        out[PATTERNS.index(pattern)] += 1
        out[-1] += weight * pattern.startswith("insult")
    return np.log1p(out)


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learns from a bounded draw of the labelled documents, spread over them by a hash of the id."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return Model((), ())
    rates = {1: min(1.0, TOXIC / counts[1]), 0: min(1.0, CLEAN / counts[0])}
    rate = F.when(F.col("label") == 1, rates[1]).otherwise(rates[0])
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 20)) < rate * (1 << 20))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # the draw sets the size of that side; an id gives one row however often it occurs, and the sample is read several times
    sample = cut_lineage(one_text_each(texts.join(F.broadcast(drawn), "doc_id")))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, "text"):
            rows: set[tuple[str, int, int]] = set()
            for label_, text_ in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = _WORD.findall(text_.lower())
                for before, word in zip(["", *words], words, strict=False):
                    if word not in _FIXED:
                        context = _context(before)
                        rows.add((word, context, label_))
                        rows.update((word[:n] + "*", context, label_) for n in (4, 5) if len(word) > n)
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["entry", "context", "label"]
            )

    met = sample.select("label", "text").mapInArrow(contexts, "entry string, context long, label int").distinct()
    by_entry = met.groupBy("entry").agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("c"))
    by_entry = cut_lineage(by_entry)
    total = by_entry.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    if not total["t"] or not total["c"]:
        return Model((), ())
    share = total["t"] / (total["t"] + total["c"])
    n = F.col("t") + F.col("c")
    g2 = 2 * (F.col("t") * F.log(F.col("t") / (n * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - share)))).otherwise(0.0))
    ratio = ((F.col("t") + 0.5) / total["t"]) / ((F.col("c") + 0.5) / total["c"])
    strong = by_entry.where((F.col("t") > 0)).select("entry", g2.alias("g2"), ratio.alias("ratio"))
    strong = strong.where((F.col("g2") >= EVIDENCE) & (F.col("ratio") >= RATIO)).orderBy(F.desc("g2"), "entry").limit(ENTRIES)
    chosen = [(r["entry"], round(float(np.log(r["ratio"])), 4)) for r in strong.collect()]
    lexicon = Model(
        tuple((e, w) for e, w in chosen if not e.endswith("*")), tuple((e[:-1], w) for e, w in chosen if e.endswith("*"))
    )
    read = score(sample, lexicon, out="unused")
    rows = read.select("label", "held").groupBy("label", "held").agg(F.count("*").alias("n")).orderBy("label", "held").collect()
    x = np.array([r["held"] for r in rows])
    y = np.array([r["label"] for r in rows], "f8")
    # rows of a label stand for all rows of it
    weight = np.array([r["n"] / rates[r["label"]] for r in rows])
    bias, parts = _logistic(x, y, weight / weight.sum())
    return Model(lexicon.words, lexicon.starts, bias, parts)


def _context(before: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(before) >> 1


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, tuple[float, ...]]:
    """Weighted logistic regression with a small ridge, by Newton's method."""
    ones = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(ones.shape[1])
    ridge = np.diag([1e-4] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(ones @ beta, -30, 30)))
        slope = ones.T @ (weight * (p - y)) + ridge @ beta
        curve = (ones * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ ones + ridge
        change = np.linalg.solve(curve, slope)
        beta -= change * min(1.0, 4 / (np.abs(change).max() + 1e-12))
        if np.abs(change).max() < 1e-8:
            break
    return float(beta[-1]), tuple(float(b) for b in beta[:-1])


@functools.lru_cache(maxsize=2)
def _reader(model: Model) -> Reader:
    return Reader(model)


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out`` (0 to 1), ``held`` (amounts by pattern) and ``clauses``, the matches with their places.

    Columns of these names are replaced.
    """

    @F.pandas_udf("score double, held array<double>, clauses array<struct<start:int,end:int,pattern:string,weight:double>>")
    def read(texts):
        import pandas as pd

        found = [_reader(model).clauses(t or "") for t in texts]
        amounts = [held(clauses) for clauses in found]
        scores = model.score(np.array(amounts).reshape(-1, len(PATTERNS) + 1))
        names = ("start", "end", "pattern", "weight")
        return pd.DataFrame(
            {
                "score": scores,
                "held": [a.tolist() for a in amounts],
                "clauses": [[dict(zip(names, c, strict=True)) for c in clauses] for clauses in found],
            }
        )

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (out, "held", "clauses")]
    rows = docs.select(*kept, read(F.col(text)).alias("\0read"))
    return rows.select(*kept, F.col("`\0read`.score").alias(out), F.col("`\0read`.held").alias("held"), F.col("`\0read`.clauses").alias("clauses"))
