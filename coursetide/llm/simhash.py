"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints of 64 bits are linked if they differ in at most ``RADIUS`` bits. Equal ones are first
put together, so copies cost one row each. The index has three kinds of nodes:

* Upper nodes are masked bit patterns that their members share. The bits are cut into three
  parts; two fingerprints in the radius agree in at least one of them. The bits outside that
  part are cut in three again, which gives nine masks of some 35 bits, and each pair in
  the radius shares the pattern of at least one. Nodes with very many members are cut into
  three once more, by the same argument.
* Below an upper node, members stand in Gray order, in which neighbours differ in few bits. Runs of
  ``FAN`` members make a node that factors out the bits they all share, runs of nodes the next one.
* Two nodes are compared by their shared bits; if these differ in more than ``RADIUS``, no pair below
  them is looked at. On the last level the shared bits are all 64 and the bound is the distance.

Nodes are spread over tasks by pattern, and a task passes on a spanning star per connected set
and not its pairs. Links of all nodes together are joined to components by Spark.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetide.llm.components import components
from coursetide.llm.inputs import cut_lineage, few_at_once

RADIUS = 2
#: Words in a shingle and the seed of its hash.
SHINGLE, SEED = 3, 42
#: Children of an inner node.
FAN = 32
#: Members from which an upper node is cut further.
HOT = 1024
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16


def fingerprint(text: str) -> int:
    """Bit i is set if it is in more than half of the shingles' hashes; no words give zero."""
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
        shingles = iter(words)
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    digest = functools.partial(xxhash.xxh64_digest, seed=SEED)
    hashes = np.frombuffer(b"".join(map(digest, shingles)), "u1").reshape(-1, 8)
    total, counts = len(hashes), np.zeros(64, "i8")
    for first in range(0, total, AT_ONCE):
        counts += np.unpackbits(hashes[first : first + AT_ONCE], axis=1).sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a long) of every row; null texts are empty."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, "text"):
            prints = np.array([fingerprint(t.as_py()) for t in batch.column(1)], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def near_duplicates(prints: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row of ``prints``.

    The component's id is the smallest ``doc_id`` that links reach. Null ids are passed over for it;
    it is null where all of them are. Repeated rows give repeated rows.
    """
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = cut_lineage(classes)
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _thirds(mask: int) -> list[int]:
    bits = [bit for bit in range(64) if mask >> bit & 1]
    size = -(-len(bits) // 3)
    return [sum(1 << bit for bit in bits[k : k + size]) for k in range(0, len(bits), size)]


def _masks(levels: int) -> list[int]:
    """Bits that a node's members share, for each way to go down ``levels`` levels."""
    every, masks = (1 << 64) - 1, [0]
    for _ in range(levels):
        masks = [mask | third for mask in masks for third in _thirds(every ^ mask)]
    return masks


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _under(rows: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    nodes = [
        F.struct(F.lit(n).alias("node"), F.col("fp").bitwiseAND(_signed(mask)).alias("pattern"))
        for n, mask in masks
    ]
    return rows.select("fp", F.explode(F.array(*nodes)).alias("n")).select("fp", "n.node", "n.pattern")


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect the same fingerprints as all pairs in the radius do."""
    second = list(enumerate(_masks(2)))
    rows = _under(distinct, second)
    hot = rows.groupBy("node", "pattern").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    rows = cut_lineage(rows.join(hot, ["node", "pattern"], "left"))
    third = _masks(3)
    parts = [rows.where("n is null").select("fp", "node", "pattern")]
    for n, _ in second:
        below = [(1000 + 3 * n + k, third[3 * n + k]) for k in range(3)]
        parts.append(_under(rows.where((F.col("n") > HOT) & (F.col("node") == n)).select("fp"), below))
    members = functools.reduce(DataFrame.unionAll, parts)
    shifted = F.shiftrightunsigned("fp", 1)
    gray = functools.reduce(  # rank of the bits in Gray order
        lambda rank, k: rank.bitwiseXOR(F.shiftrightunsigned(rank, k)), (2, 4, 8, 16, 32), F.col("fp").bitwiseXOR(shifted)
    )
    return (
        members.repartition("node", "pattern")
        .withColumn("gray", gray)
        .sortWithinPartitions("node", "pattern", F.shiftrightunsigned("gray", 1), "gray")
        .select("node", "pattern", "fp")
        .mapInArrow(_stars, "a long, b long")
    )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by upper node; what a batch has of its last node waits for the next batch."""
    rest: list[np.ndarray] = []  # node, pattern and fingerprint

    def found(node: np.ndarray, pattern: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero((np.diff(node) != 0) | (np.diff(pattern) != 0)) + 1
        first = np.concatenate(([0], new))
        size = np.diff(np.concatenate((first, [len(node)])))
        two = first[size == 2]
        close = np.bitwise_count(prints[two] ^ prints[two + 1]) <= RADIUS
        a, b = [prints[two][close]], [prints[two + 1][close]]
        for start, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            members = prints[start : start + n]
            root = _roots(members)
            moved = root != np.arange(n)
            a.append(members[moved])
            b.append(members[root[moved]])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view("i8")) for x in (a, b)], ["a", "b"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        own = [own[0].astype("i8"), own[1].astype("i8"), own[2].astype("i8").view("u8")]
        rows = [np.concatenate(x) for x in zip(rest, own, strict=True)] if rest else own
        same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        rest = [x[cut:] for x in rows]
        if cut:
            yield found(*(x[:cut] for x in rows))
    if rest:
        yield found(*rest)


def _roots(prints: np.ndarray) -> np.ndarray:
    """For each member in Gray order, the first one that it is connected with."""
    levels = [(prints, np.full(len(prints), ~np.uint64(0)))]  # shared values and their masks
    while len(levels[-1][0]) > 1:
        value, mask = levels[-1]
        cuts = np.arange(0, len(value), FAN)
        ones = np.bitwise_and.reduceat(value, cuts)
        some = np.bitwise_or.reduceat(value, cuts)
        mask = np.bitwise_and.reduceat(mask, cuts) & ~(ones ^ some)
        levels.append((ones & mask, mask))
    root = np.arange(len(prints))
    pending = [(len(levels) - 1, np.zeros(1, "i8"), np.zeros(1, "i8"))]
    while pending:  # depth first, so that few pairs of nodes wait
        level, a, b = pending.pop()
        if level == 0:
            _join(root, a, b)
            continue
        value, mask = levels[level - 1]
        some = max(1, (1 << 20) // FAN**2)
        for first in range(0, len(a), some):
            below = np.arange(FAN)
            x = (a[first : first + some, None, None] * FAN + below[:, None] + 0 * below).ravel()
            y = (b[first : first + some, None, None] * FAN + below + 0 * below[:, None]).ravel()
            there = (x < len(value)) & (y < len(value)) & ((x < y) if level == 1 else (x <= y))
            x, y = x[there], y[there]
            near = np.bitwise_count((value[x] ^ value[y]) & mask[x] & mask[y]) <= RADIUS
            if near.any():
                pending.append((level - 1, x[near], y[near]))
    return root


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Puts the sets of each pair together under the smaller root."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
