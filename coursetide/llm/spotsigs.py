"""SpotSigs: document fingerprints from chains of content words behind common-word anchors.

Every occurrence of an anchor starts a signature: the anchor and the next ``CHAIN`` content words, anchors
between them being skipped. Content near many anchors is prose, so what is not prose hardly counts. The
beginning of the text is an anchor too, and a chain that the text's end cuts off is kept as it is; so every text
with a word has a signature, and equal texts have equal ones. A content word that has no anchor among the ``GAP``
content words before it starts a chain too, word by word however long the stretch is: so other languages, lists and
code count as a whole.
A text without words has none. Words are runs of letters and digits in lower case.

A fingerprint is the sorted set of signatures, each a 64-bit hash, as text: 16 hexadecimal digits a
signature. Likeness is the Jaccard similarity of the sets; two empty sets are alike by 1, one by 0.

``matches`` joins a corpus with itself: fingerprints are partitioned by set length so that only neighbouring
partitions can be similar, candidates share one of the rarest signatures of both, and Jaccard is computed for
those alone, and only where the lengths still allow it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage, few_at_once

CHAIN = 2
#: How far an anchor reaches, in content words; what is further behind it starts chains of its own.
GAP = 16
#: Common words of four languages.
ANCHORS = frozenset(
    """
    a an and are as at be by for from has in is it of on or that the this to was were which with
    als auch auf das dem den der des die ein eine für im in ist mit nicht sich und von zu
    au avec dans de des du elle en est et la le les par pas pour qui que sur un une
    al con de del el en es la las lo los no para por que se su un una y
    """.split()
)
_WORD = re.compile(r"[^\W_]+")
#: Ranges of ids that neighbours are looked for in, per shuffle partition.
RANGES = 4


def signatures(text: str, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct hashes."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, "u8")
    at, content, head = [0], [], [""]
    for word in words:
        if word in anchors:
            at.append(len(content))
            head.append(word)
        else:
            content.append(word)
    spots = [" ".join((anchor, *content[k : k + chain])) for anchor, k in zip(head, at, strict=True)]
    reach = 0  # nothing stands before the beginning
    for k, end in zip(at, [*at[1:], len(content)], strict=True):
        spots += [" ".join(("", *content[j : j + chain])) for j in range(k + reach, end)]
        reach = GAP
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, set(spots)), "u8")
    return np.unique(hashes)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(sigs: np.ndarray) -> str:
    return sigs.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``signatures`` (array of longs, ascending as unsigned) of every row; null texts are empty."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, "text"):
            found = [signatures(t.as_py()).view("i8") for t in batch.column(1)]
            values = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "signatures"])

    return rows.mapInArrow(run, f"doc_id {kind}, signatures array<long>")


def with_neighbours(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its fingerprint, that of its edited text, and how alike it is to that and to the next row's.

    Rows stand by descending id, equal ids by text, null ids last; the next row of the last one is the first. The edited
    text has the last half of its characters (rounded down) replaced by as many from the start of the next
    text. Rows are dealt by ranges of ids, and each range also gets a copy of the row that follows its last one:
    so texts are moved once, and no task sees more than its ranges.
    """
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, RANGES * width)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    cuts = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 100 * n).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    # ids above all cuts are range 0; null ids have one of their own
    reach = F.array(*map(F.lit, cuts)).cast(f"array<{kind}>")
    of = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.size(F.filter(reach, lambda c: c >= F.col("doc_id"))))
    ranged = rows.withColumn("range", of.cast("int"))
    heads = {r["range"]: r["head"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    behind = dict(zip(order, [*order[1:], *order[:1]], strict=True))  # the range that follows each
    if not order:
        guards = ranged.where("false").withColumn("guard", F.lit(1))
    else:
        follower = F.col("range")
        leads = F.create_map(*(F.lit(x) for r, f in behind.items() for x in (f, r)))
        ids = [heads[f] for f in order if heads[f] is not None]
        is_head = F.col("doc_id").isin(ids) if ids else F.lit(False)
        if None in heads.values():
            is_head = is_head | F.col("doc_id").isNull()
        guards = ranged.where(is_head).withColumn("range", leads[follower].cast("int")).withColumn("guard", F.lit(1))
    dealt = (
        ranged.withColumn("guard", F.lit(0))
        .unionByName(guards)
        .repartition(width, "range")
        .sortWithinPartitions("range", "guard", F.desc_nulls_last("doc_id"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # range, id, text and signatures of the row that waits for its next one
        for batch in few_at_once(batches, "text"):
            done: list[tuple] = []
            for range_, doc, text, guard in zip(
                *(batch.column(c).to_pylist() for c in ("range", "doc_id", "text", "guard")), strict=True
            ):
                if before is None and guard:
                    continue  # only the first row behind a range counts
                sigs = signatures(text)
                if before is not None:
                    done.append(_compared(before[1:], text, sigs))
                before = None if guard else (range_, doc, text, sigs)
            yield pa.RecordBatch.from_pylist(done, schema=out)

    out = pa.schema(
        [
            pa.field("doc_id", _arrow(rows)),
            pa.field("n_chars", pa.int64()),
            *(pa.field(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
            *(pa.field(c, pa.float64()) for c in ("near_edited", "near_next")),
        ]
    )
    return dealt.select("range", "doc_id", "text", "guard").mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)


def _compared(own: tuple, following: str, theirs: np.ndarray) -> dict:
    doc, text, sigs = own
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = signatures(edited)
    return {
        "doc_id": doc,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": written(sigs),
        "edited_fingerprint": written(changed),
        "near_edited": likeness(sigs, changed),
        "near_next": likeness(sigs, theirs),
    }


def matches(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs ``a``, ``b`` of different fingerprints whose Jaccard similarity is ``threshold`` or more.

    Takes and gives fingerprints by ``class_id``: equal ones are one class, so copies make no pairs; the second
    table of the result's columns is the likeness. Use ``classes`` for who belongs to which class.
    """
    found = cut_lineage(classes(prints).select("class_id", "signatures", F.size("signatures").alias("n")).where("n > 0").dropDuplicates(["class_id"]))
    # partitions of set length: a pair in the threshold lies in one or in two that are next to each other
    part = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(threshold)) + 1e-9).cast("int")
    spread = found.withColumn("part", part).withColumn("signature", F.explode("signatures"))
    common = spread.groupBy("signature").agg(F.count("*").alias("df"))
    ranked = (
        spread.join(common, "signature")
        .groupBy("class_id", "n", "part")
        .agg(F.sort_array(F.collect_list(F.struct("df", "signature"))).alias("s"))
    )
    # two sets in the threshold share one of the rarest n - ceil(t n) + 1 signatures of either
    prefix = F.expr(f"slice(s, 1, n - cast(ceil({threshold} * n - 1e-9) as int) + 1).signature")
    probes = ranked.select("class_id", "n", "part", F.explode(prefix).alias("signature"))
    left = probes.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "part", "signature")
    both = probes.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") - 1, F.col("part") + 1)))
    right = both.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "part", "signature")
    pairs = (
        left.join(right, ["part", "signature"])
        .where("a < b")
        .where(F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)
        .select("a", "b")
        .distinct()
    )
    s = found.select("class_id", "signatures")
    pairs = pairs.join(s.withColumnsRenamed({"class_id": "a", "signatures": "sa"}), "a")
    pairs = pairs.join(s.withColumnsRenamed({"class_id": "b", "signatures": "sb"}), "b")
    met = F.size(F.array_intersect("sa", "sb"))
    return pairs.select("a", "b", (met / (F.size("sa") + F.size("sb") - met)).alias("likeness")).where(
        F.col("likeness") >= threshold - 1e-12
    )


def classes(prints: DataFrame) -> DataFrame:
    """``prints`` with ``class_id``, the hash of the whole set."""
    return prints.withColumn("class_id", F.xxhash64("signatures"))
