"""Benchmark decontamination: item-sized windows by SimHash, verified by their shingles.

A document is contaminated by an item if some window of as many words as the item has a
weighted shingle similarity to it of ``THRESHOLD`` or more. Words are runs of letters and digits, in
lower case; shingles are ``SHINGLE`` words, or the whole of a shorter item; a shingle weighs as often as
it occurs, and the similarity is the sum of the smaller weights over that of the larger ones.

1. Shingles of all documents meet those of the items. A window in the threshold has
   ``2 t / (1 + t)`` of its shingles from the item, so only windows with so many go on. This leaves out
   nothing that could reach the threshold.
2. These windows get a SimHash of their weighted shingles. Fingerprints are cut into ``BLOCKS`` parts
   of 8 bits; two of them within ``RADIUS`` bits have a part in which at most 2 bits differ, so the items'
   index holds each part under all values within 2 bits, and a window finds every item in the radius by
   equality. At a similarity of 0.8 some 10 of 64 bits differ, with a deviation of 3; 23 is beyond that
   by more than four deviations.
3. The similarity of the pairs found is computed exactly.

Everything is DataFrame functions. The items' shingles are broadcast only up to ``BROADCAST_ROWS``; above,
the join is shuffled. So it is with the contaminated documents' keys. Null and empty texts and items
without words match nothing. Documents with equal ids and texts are one, with different texts several; a
null id is kept as null. The columns read are the id and the text, whatever else there is.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage

SHINGLE, THRESHOLD = 5, 0.8
BLOCKS, NEAR, RADIUS = 8, 2, 23
#: Rows of three numbers up to which a side is broadcast: at most some 20 MB.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _shingles(of: str, size: str) -> Column:
    """Hashes of all runs of ``size`` words; none if there are fewer words."""
    return F.expr(
        f"if(size({of}) < {size}, array(), transform(sequence(1, size({of}) - {size} + 1), "
        f"i -> xxhash64(slice({of}, i, {size}))))"
    ).cast("array<bigint>")


def simhash(hashes: str) -> Column:
    """Bit b is set if it is set in over half of the array's hashes, repeats counting as often as they occur."""
    return F.expr(
        f"aggregate(sequence(0, 63), 0L, (bits, b) -> bits | if(2 * size(filter({hashes}, "
        f"h -> (shiftright(h, b) & 1L) = 1L)) > size({hashes}), shiftleft(1L, b), 0L))"
    )


def _near(rows: DataFrame) -> tuple[DataFrame, bool]:
    """The rows, marked for broadcast if they are few, and whether they are any."""
    rows = cut_lineage(rows)
    n = rows.count()
    return (F.broadcast(rows) if n <= BROADCAST_ROWS else rows), n > 0


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), words(F.col(text)).alias("words")
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    short: bool = False,
) -> DataFrame:
    """A row per document and item found in it: ``doc_id``, ``text_hash``, ``item_id``, the word
    position ``start`` (from 1) of the first best window, ``bits`` by which its fingerprint
    differs and its ``similarity``.

    A document of fewer words than the item has no window; with ``short`` all of it is the one window.
    """
    bench = (
        items.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("w"))
        .where("size(w) > 0")
        .distinct()
        .withColumn("k", F.least(F.lit(shingle), F.size("w")))
    )
    share = 2 * threshold / (1 + threshold)
    bench = (
        bench.withColumn("item_shingles", _shingles("w", "k"))
        .withColumn("a", F.size("item_shingles"))
        .withColumn("need", F.ceil(F.col("a") * share - 1e-9).cast("int"))
        .withColumn("item", F.monotonically_increasing_id())
        .select("item", "item_id", "k", "a", "need", "item_shingles")
    )
    bench = cut_lineage(bench)
    sizes = [r["k"] for r in bench.select("k").distinct().orderBy("k").collect()]  # at most ``shingle`` numbers
    wanted, _ = _near(bench.select("item", "k", "a", "need", F.explode("item_shingles").alias("h")).distinct())
    rows = _keyed(docs, doc_id, text)

    def met(k: int) -> DataFrame:
        placed = rows.select(
            "doc_id", "text_hash", F.expr(f"size(words) - {k} + 1").alias("b"), F.posexplode(_shingles("words", str(k))).alias("pos", "h")
        )
        return placed.join(wanted.where(F.col("k") == k), "h").select("doc_id", "text_hash", "item", "a", "b", "need", "pos")

    none = rows.where("false").select("doc_id", "text_hash", F.lit(0).alias("item").cast("long"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("need"), F.lit(0).alias("pos"))
    hits = functools.reduce(DataFrame.unionAll, map(met, sizes), none)
    # runs of positions that hold enough of an item's shingles for a window over them
    placed = hits.groupBy("doc_id", "text_hash", "item", "a", "b", "need").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    starts = F.when(
        F.expr("b >= a and size(p) >= need"),
        F.expr(
            "array_distinct(flatten(transform(filter(sequence(0, size(p) - need), "
            "i -> p[i + need - 1] - p[i] < a), "
            "i -> sequence(greatest(0, p[i + need - 1] - a + 1), p[i]))))"
        ),
    )
    if short:  # b shingles share at least t (a + b) / (1 + t) with the item's a
        enough = F.expr(f"b < a and size(p) >= {threshold / (1 + threshold)!r} * (a + b) - 1e-9")
        starts = starts.when(enough, F.array(F.lit(0)))
    runs = placed.select("doc_id", "text_hash", "item", F.explode(starts).alias("start"))
    runs = cut_lineage(runs)
    keys, any_left = _near(runs.select("doc_id", "text_hash").distinct())
    found_in = rows.join(keys, [rows.doc_id.eqNullSafe(keys.doc_id), rows.text_hash == keys.text_hash], "left_semi")
    if not any_left:
        found_in = rows.where("false")
    found_in = found_in.dropDuplicates(["doc_id", "text_hash"])
    w, r = found_in.alias("w"), runs.alias("r")
    windows = (
        w.join(r, F.col("w.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("w.text_hash") == F.col("r.text_hash")))
        .join(bench.alias("i"), F.col("r.item") == F.col("i.item"))
        .where("r.start = 0 or r.start + i.a + i.k - 1 <= size(w.words)")
        .select("w.doc_id", "w.text_hash", "i.item", "i.item_id", "i.item_shingles", "r.start", F.expr("slice(w.words, r.start + 1, i.a + i.k - 1)").alias("ww"), "i.k")
        .withColumn("shingles", _shingles("ww", "k"))
        .drop("ww")
        .withColumn("fp", simhash("shingles"))
    )
    windows = cut_lineage(windows)
    block = "cast(shiftright({fp}, 8 * b) & 255 as int)"
    flips = [0, *(1 << i for i in range(8)), *((1 << i) | (1 << j) for i in range(8) for j in range(i))]
    index = (
        bench.withColumn("item_fp", simhash("item_shingles"))
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
        .withColumn("flip", F.explode(F.array(*map(F.lit, flips))))
        .select("item", "b", "item_fp", (F.expr(block.format(fp="item_fp")).bitwiseXOR(F.col("flip"))).alias("v"))
    )
    probes = windows.select(
        "doc_id", "text_hash", "item", "start", "fp", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("b")
    ).withColumn("v", F.expr(block.format(fp="fp")))
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    pairs = (
        probes.join(index, ["item", "b", "v"])
        .withColumn("bits", bits)
        .where(F.col("bits") <= RADIUS)
        .select("doc_id", "text_hash", "item", "start", "bits")
        .distinct()
    )
    p, w = pairs.alias("p"), windows.alias("w")
    same = F.col("p.doc_id").eqNullSafe(F.col("w.doc_id"))
    for name in ("text_hash", "item", "start"):
        same = same & (F.col(f"p.{name}") == F.col(f"w.{name}"))
    both = (
        "aggregate(array_distinct(shingles), 0, (n, x) -> n + least("
        "size(filter(shingles, y -> y = x)), size(filter(item_shingles, y -> y = x))))"
    )
    verified = (
        p.join(w, same)
        .select("w.doc_id", "w.text_hash", "w.item_id", "w.start", "p.bits", "w.shingles", "w.item_shingles")
        .withColumn("common", F.expr(both))
        .withColumn("similarity", F.expr("common / (size(shingles) + size(item_shingles) - common)"))
        .where(F.col("similarity") >= threshold - 1e-12)
    )
    best = F.min_by(F.struct("start", "bits", "similarity"), F.struct(-F.col("similarity"), F.col("start")))
    return (
        verified.groupBy("doc_id", "text_hash", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "text_hash", "item_id", (F.col("best.start") + 1).alias("start"), "best.bits", "best.similarity")
    )


def without(docs: DataFrame, found: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``contaminated`` has not found, all columns unchanged."""
    bad, any_left = _near(found.select("doc_id", "text_hash").distinct())
    if not any_left:
        return docs
    same = docs[doc_id].eqNullSafe(bad.doc_id) & (F.xxhash64(docs[text]) == bad.text_hash)
    return docs.join(bad, same, "left_anti")
