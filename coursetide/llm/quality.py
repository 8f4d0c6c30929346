"""Document quality by Bradley-Terry pairwise ranking.

A document's score is a weighted sum of features of its whole text. Weights are learned from
preference pairs: a document of label 1 should beat one of label 0, and the logistic loss of the
difference of their features is made small (the Bradley-Terry model with features). Scores
only order documents, so a threshold is taken at the score quantile that parts the sample best:
near the share of label 0, where labels are clean. The score put out is the logistic function of
the distance to that threshold.

Every feature is a share or a logarithm and is bounded. A text without words (empty, null or blank) has
the features of an empty text and scores like the labelled texts nearest to that; without labels of both
kinds all scores are 1, so a corpus without labels loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import few_at_once, one_text_each

#: Labelled rows that may be used in learning, of each label at most, and preference pairs.
SAMPLE, PAIRS = 3000, 60_000
#: Words that are looked at together for repetition; a long text's shares are means over blocks.
BLOCK = 1000

FEATURES = (
    "upper", "digit", "symbol", "pipe", "space", "long_word", "distinct", "repeated_next", "run_on",
    "distinct_line", "stuck_symbol", "all_upper", "length",
)

_KINDS = np.zeros((256, 4), "f8")  # of UTF-8 bytes: A-Z, digits, other ASCII signs, white space
_KINDS[ord("A") : ord("Z") + 1, 0] = 1
_KINDS[ord("0") : ord("9") + 1, 1] = 1
for _code in b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~":
    _KINDS[_code, 2] = 1
for _code in b" \t\n\r\x0b\x0c":
    _KINDS[_code, 3] = 1
_PIPE = ord("|")
_SYMBOLS = tuple(b"!#$%&*@^~|+=<>"[k : k + 1] for k in range(14))


def features(text: str) -> np.ndarray:
    """The features of one text, in the order of ``FEATURES``."""
    out = np.zeros(len(FEATURES))
    raw = text.encode()
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    n, size = len(words), len(raw)
    out[:3] = (counts @ _KINDS)[:3] / size
    out[3] = counts[_PIPE] / n
    out[4] = (counts @ _KINDS)[3] / size
    lengths = np.fromiter(map(len, words), "i8", n)
    out[5] = np.mean(lengths > 20)
    blocks = [words[k : k + BLOCK] for k in range(0, n, BLOCK)]
    # a block of random words has fewer distinct ones the longer it is, hence the power
    out[6] = sum(len(b) * min(1.0, len(set(b)) / len(b) ** 0.85) for b in blocks) / n
    out[7] = sum(map(bytes.__eq__, words, words[1:])) / n
    out[8] = min(1.0, float(lengths.max()) / 1000)
    lines = raw.split(b"\n")
    out[9] = len(set(lines)) / len(lines)
    out[10] = sum(word.endswith(_SYMBOLS) for word in words) / n
    out[11] = sum(map(bytes.isupper, words)) / n
    out[12] = np.log1p(n) / 20
    return out


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    unit: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.ones(len(rows))
        away = (_spread(rows, self.mean, self.scale) @ self.weights - self.threshold) / self.unit
        return 1 / (1 + np.exp(-np.clip(away, -30, 30)))


def _spread(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features and their squares, so that too much and too little can both be bad."""
    z = np.clip((rows - mean) / scale, -8, 8)
    return np.hstack([z, z * z / 8])


def fit(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, steps: int = 300) -> Ranking:
    """Learns from feature rows and their labels, 1 for good and 0 for bad."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    mean = rows.mean(axis=0) if len(rows) else np.zeros(len(FEATURES))
    scale = rows.std(axis=0) + 1e-3 if len(rows) else np.ones(len(FEATURES))
    if not len(good) or not len(bad):
        return Ranking(mean, scale, np.zeros(0), 0.0, 1.0)
    z = _spread(rows, mean, scale)
    draw = np.random.default_rng(7)
    apart = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    weights, first, second = (np.zeros(z.shape[1]) for _ in range(3))
    for step in range(1, steps + 1):  # full-batch Adam on the mean loss with a small ridge
        lost = 1 / (1 + np.exp(np.clip(apart @ weights, -30, 30)))
        slope = -(lost @ apart) / pairs + 1e-3 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    ranks = z @ weights
    order = np.argsort(ranks, kind="stable")
    below = np.concatenate(([0], np.cumsum(labels[order] == 1)))  # good ones put below each quantile
    above = (labels == 0).sum() - np.concatenate(([0], np.cumsum(labels[order] == 0)))
    wrong = below + above
    cuts = np.flatnonzero(wrong == wrong.min())
    at = int(cuts[len(cuts) // 2])
    ends = ranks[order]
    low, high = ends[max(at - 1, 0)], ends[min(at, len(ends) - 1)]
    unit = max(1e-6, float(np.std(ranks)) / 4)
    return Ranking(mean, scale, weights, float(low + high) / 2, unit)


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Ranking:
    """Learns from documents that have a label of 0 or 1; others are passed over.

    At most about ``sample`` rows a label are used, spread over the corpus by a hash of the id; the rate is set
    from exact counts, and an id gives one row however often it occurs, so what reaches the driver is bounded at
    any size: features and not texts.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col("label") == value, min(1.0, sample / n)).otherwise(rate)
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < rate * (1 << 20))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # the draw sets the size of this side: about twice ``sample`` ids and labels, whatever the corpus
    some = one_text_each(texts.join(F.broadcast(drawn), "doc_id"))
    found = _featured(some, ["doc_id", "label"]).select("doc_id", "label", "features")
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])  # here, as Spark would run the draw twice to sort it
    x = np.array([r["features"] for r in rows]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["label"] for r in rows]))


def _featured(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` columns and an array of the features of ``text``."""
    rows = docs.select(*kept, F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, "text"):
            found = [features(t.as_py()) for t in batch.column("text")]
            values = pa.array([x.tolist() for x in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), values], [*kept, "features"])

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    return rows.mapInArrow(run, f"{kinds}, features array<double>")


def score(docs: DataFrame, ranking: Ranking, *, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, 0 to 1, of the whole text; a column of that name is replaced."""

    kept = [c for c in docs.columns if c != out]
    known = docs.select(*(F.col(f"`{c}`") for c in kept))
    # a text in a column that is replaced is sent along beside the others
    rows = known if text in kept else docs.select(*known.columns, F.col(f"`{text}`").alias("\0text"))
    at = rows.columns.index(text if text in kept else "\0text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, at):
            found = [features(t.as_py() or "") for t in batch.column(at)]
            scores = ranking.scores(np.array(found).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(scores, pa.float64())], [*kept, out])

    scored = rows.mapInArrow(run, known.withColumn(out, F.lit(0.0)).schema)
    return scored.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*docs.columns, out])))
