"""Removal of long repeated word sequences by a compacted de Bruijn graph.

A window of ``WINDOW`` words is an edge of the graph, from its first ``WINDOW - 1`` words to its last. A word
goes if a window over it also starts in a document of a smaller id. The graph of a large corpus has
an edge for nearly every word, so it is built only where it can repeat:

1. Every window names its anchor, the smallest hash among its runs of ``ANCHOR`` words. Equal windows have
   equal anchors, and some 7 % of words start one. Anchors that occur in a single document, and all but one
   of documents with equal texts, are left out: their windows don't branch off anything.
2. The windows of repeated anchors are brought together by anchor. Equal edges meet, the one of the
   smallest id is their source, and runs of edges that go on side by side with a run of the source's are
   compacted to one path: document, place, source document, its place. Anchors of more than ``HOT`` documents
   are not brought together but aggregated edge by edge and joined back, which combines before the shuffle
   and can be split.
3. Paths are joined back to the texts, whose words they cover are dropped.

An edge is known by two 64-bit hashes, its own and its anchor's, so unequal edges are told apart by some
128 bits. Words are runs of bytes other than ASCII white space, unchanged. Null and empty texts have no words.
Rows of a null id lose nothing and take nothing from others. Rows with equal ids are one document each
and don't count as earlier than each other. No text is cut or left out; a document's words are held in one
task, its windows never are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage, few_at_once

WINDOW, ANCHOR = 50, 25
#: Documents from which an anchor's windows are aggregated one by one.
HOT = 500
#: Words that are hashed side by side; a longer text is hashed by itself.
AT_ONCE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the differences of hashes over all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n + 1, base, "u8")
    powers[0] = 1
    return np.cumprod(powers, dtype="u8")


def windows(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place, anchor and hash of every window of the texts' words."""
    sizes = np.array([len(words) for words in texts], "i8")
    total = int(sizes.sum())
    if total < WINDOW:
        return (np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "u8"), np.zeros(0, "u8"))
    hashed = np.fromiter((h for words in texts for h in map(xxhash.xxh3_64_intdigest, words)), "u8", total)
    sums = np.zeros(total + 1, "u8")
    np.cumsum(hashed * _powers(_BASE, total)[:total], dtype="u8", out=sums[1:])
    back = _powers(_INVERSE, total)

    def rolled(k: int) -> np.ndarray:
        return _mixed((sums[k:] - sums[:-k]) * back[: total - k + 1])

    least, width = rolled(ANCHOR), 1
    while 2 * width <= WINDOW - ANCHOR + 1:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = WINDOW - ANCHOR + 1 - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    whole = rolled(WINDOW)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    inside = np.flatnonzero(np.arange(total) + WINDOW <= ends[text])
    return text[inside], inside - (ends - sizes)[text[inside]], least[inside], whole[inside]


def _few_at_once(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches with about ``AT_ONCE`` words, and the words."""
    for batch in batches:
        first, words, held = 0, [], 0
        for n, text in enumerate(batch.column(column)):
            words.append((text.as_py() or "").encode().split())
            held += len(words[-1])
            if held >= AT_ONCE or n + 1 == batch.num_rows:
                yield batch.slice(first, n + 1 - first), words
                first, words, held = n + 1, [], 0


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, words in _few_at_once(batches, "text"):
        text, _, anchor, _ = windows(words)
        found = [np.zeros(0, "i8")] * len(words)
        for n in np.unique(text).tolist():
            a, b = np.searchsorted(text, (n, n + 1))
            found[n] = np.unique(anchor[a:b]).view("i8")
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("doc_id", "text_hash", "second_hash")),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array(found, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_hash", "second_hash", "n_words", "anchors"],
        )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per run of windows with one repeated anchor."""
    for batch, words in _few_at_once(batches, "text"):
        text, place, anchor, whole = windows(words)
        wanted = np.zeros(len(text), bool)
        hot = np.zeros(len(text), bool)
        for n, (repeated, frequent) in enumerate(zip(batch.column("anchors"), batch.column("hot"), strict=True)):
            a, b = np.searchsorted(text, (n, n + 1))
            ids = np.array(repeated.as_py(), "i8").view("u8")
            order = np.argsort(ids)
            at = np.searchsorted(ids[order], anchor[a:b]).clip(max=max(0, len(ids) - 1))
            wanted[a:b] = ids[order][at] == anchor[a:b]
            hot[a:b] = np.array(frequent.as_py(), bool)[order][at]
        keep = np.flatnonzero(wanted)
        if not len(keep):
            continue
        t, p, a, w = text[keep], place[keep], anchor[keep], whole[keep].view("i8")
        new = np.concatenate(([True], (np.diff(t) != 0) | (np.diff(p) != 1) | (a[1:] != a[:-1])))
        first = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(a[first].view("i8")),
                pa.array(hot[keep][first]),
                batch.column("doc_id").take(pa.array(t[first])),
                batch.column("text_hash").take(pa.array(t[first])),
                pa.array(p[first].astype("i4")),
                pa.ListArray.from_arrays(pa.array(np.append(first, len(w)).astype("i4")), pa.array(w)),
            ],
            ["anchor", "hot", "doc_id", "text_hash", "start", "windows"],
        )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by anchor and id; what a batch has of its last anchor waits for the next batch."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        anchor = rows.column("anchor").to_numpy()
        doc = rows.column("doc_id").combine_chunks().dictionary_encode().indices.to_numpy()
        start = rows.column("start").to_numpy().astype("i8")
        lists = rows.column("windows").combine_chunks()
        whole = lists.flatten().to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + start[row]
        group = np.cumsum(np.concatenate(([0], np.diff(anchor) != 0)))[row]
        order = np.lexsort((whole, group))  # stable: the first of equal edges has the smallest id
        new = np.concatenate(([True], (np.diff(group[order]) != 0) | (np.diff(whole[order]) != 0)))
        source = np.empty(len(whole), "i8")
        source[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        gone = np.flatnonzero(doc[row[source]] != doc[row])
        r, p, s = row[gone], place[gone], source[gone]
        ahead = (np.diff(r) == 0) & (np.diff(p) == 1) & (np.diff(row[s]) == 0) & (np.diff(place[s]) == 1)
        first = np.flatnonzero(np.concatenate(([True], ~ahead))) if len(gone) else gone
        length = np.diff(np.append(first, len(gone)))
        own, other = pa.array(r[first]), pa.array(row[s][first])
        columns = [
            rows.column("doc_id").take(own),
            rows.column("text_hash").take(own),
            pa.array(p[first].astype("i4")),
            pa.array(length.astype("i4")),
            rows.column("doc_id").take(other),
            pa.array(place[s][first].astype("i4")),
        ]
        names = ["doc_id", "text_hash", "start", "windows", "source_id", "source_start"]
        return pa.table(columns, names).combine_chunks()

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        anchor = rows.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1]))
        rest = rows.slice(cut)
        if cut:
            yield from found(rows.slice(0, cut).combine_chunks()).to_batches()
    if rest is not None:
        yield from found(rest.combine_chunks()).to_batches()


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )



def repeated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Paths of repeated edges: ``doc_id``, ``text_hash``, ``start`` (word, from 0), ``windows``, and where they
    are repeated from, ``source_id`` and ``source_start``. A whole text that is repeated from one of a smaller
    id has a single path from word 0."""
    texts = _texts(docs, doc_id, text)
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = cut_lineage(
        texts.where("doc_id is not null")
        .withColumn("second_hash", F.xxhash64(F.lit(1), "text"))
        .mapInArrow(_anchors, f"doc_id {kind}, text_hash long, second_hash long, n_words long, anchors array<long>")
        .where(F.col("n_words") >= WINDOW)
    )
    first = found.groupBy("text_hash", "second_hash").agg(F.min("doc_id").alias("first"))
    classed = found.join(first, ["text_hash", "second_hash"])
    copies = classed.where("doc_id > first").select(
        "doc_id",
        "text_hash",
        F.lit(0).alias("start"),
        (F.col("n_words") - (WINDOW - 1)).cast("int").alias("windows"),
        F.col("first").alias("source_id"),
        F.lit(0).alias("source_start"),
    )
    nodes = classed.where("doc_id = first").select("doc_id", "text_hash", F.explode("anchors").alias("anchor"))
    counted = nodes.groupBy("anchor").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = counted.where("low < high").select("anchor", (F.col("n") > HOT).alias("hot"))
    wanted = cut_lineage(
        nodes.join(shared, "anchor")
        .distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("anchor", "hot")).alias("a"))
        .select("doc_id", "text_hash", F.col("a.anchor").alias("anchors"), F.col("a.hot").alias("hot"))
    )
    own = texts.join(wanted.withColumnsRenamed({"doc_id": "w_id", "text_hash": "w_hash"}), F.expr("doc_id <=> w_id and text_hash = w_hash"))
    edges = cut_lineage(
        own.select("doc_id", "text_hash", "text", "anchors", "hot").mapInArrow(
            _edges, f"anchor long, hot boolean, doc_id {kind}, text_hash long, start int, windows array<long>"
        )
    )
    some = (
        edges.where("not hot")
        .drop("hot")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id", "start")
        .mapInArrow(
            _paths,
            f"doc_id {kind}, text_hash long, start int, windows int, source_id {kind}, source_start int",
        )
    )
    # a run that repeats an edge, such as one word over and over, has one row for it, with all its places
    many = edges.where("hot").withColumn("edge", F.explode(F.array_distinct("windows")))
    places = F.expr("transform(filter(sequence(0, size(windows) - 1), i -> windows[i] = edge), i -> start + i)")
    many = many.select("anchor", "edge", "doc_id", "text_hash", places.alias("places"))
    first_place = F.struct("doc_id", F.col("places")[0].alias("start"))
    source = many.groupBy("anchor", "edge").agg(F.min(first_place).alias("s"))
    many = many.join(source, ["anchor", "edge"]).where("doc_id > s.doc_id")
    many = many.select(
        "doc_id",
        "text_hash",
        F.explode("places").alias("start"),
        F.lit(1).alias("windows"),
        F.col("s.doc_id").alias("source_id"),
        F.col("s.start").alias("source_start"),
    )
    return _compacted(copies.unionAll(some).unionAll(many))


def _compacted(paths: DataFrame) -> DataFrame:
    """Paths that go on where another one of the document and of its source ends are one."""
    along = Window.partitionBy("doc_id", "text_hash").orderBy("start", "source_id", "source_start")
    before = F.lag(F.struct("start", "windows", "source_id", "source_start")).over(along)
    goes_on = (
        (F.col("b.start") + F.col("b.windows") == F.col("start"))
        & (F.col("b.source_id") == F.col("source_id"))
        & (F.col("b.source_start") + F.col("b.windows") == F.col("source_start"))
    )
    begun = F.when(goes_on, 0).otherwise(1)
    numbered = paths.distinct().withColumn("b", before).withColumn("path", F.sum(begun).over(along))
    return (
        numbered.groupBy("doc_id", "text_hash", "path")
        .agg(
            F.min("start").alias("start"),
            F.sum("windows").cast("int").alias("windows"),
            F.min("source_id").alias("source_id"),
            F.min("source_start").alias("source_start"),
        )
        .drop("path")
    )


def without_repeats(docs: DataFrame, paths: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words left joined by one space, of every row."""
    texts = _texts(docs, doc_id, text)
    kind = texts.schema["doc_id"].dataType.simpleString()
    cover = (
        paths.groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "windows")).alias("p"))
        .select(F.col("doc_id").alias("p_id"), F.col("text_hash").alias("p_hash"), F.col("p.start").alias("starts"), F.col("p.windows").alias("lengths"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, "text"):
            total, gone, kept = [], [], []
            for t, starts, lengths in zip(*(batch.column(c) for c in ("text", "starts", "lengths")), strict=True):
                words = (t.as_py() or "").encode().split()
                n = len(words)
                if starts.as_py():
                    edge = np.zeros(n + 1, "i8")
                    begin = np.array(starts.as_py())
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + np.array(lengths.as_py()) + WINDOW - 1, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    words = [w for w, stay in zip(words, stays.tolist(), strict=True) if stay]
                total.append(n)
                gone.append(n - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = texts.join(cover, F.expr("doc_id <=> p_id and text_hash = p_hash"), "left")
    return joined.select("doc_id", "text", "starts", "lengths").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept string"
    )
