"""A z-fast trie of conversations, built by Spark joins, in batches.

A conversation is the path of its turns from the root. The trie is compacted: a node stands where paths
branch or end, and holds the edge that leads to it. Each depth of a path has a digest of all turns
up to there, so that a digest is a place in the trie wherever it is met.

A node whose edge covers the depths (start, depth] is found under its handle, the digest at the two-fattest
number of that range (the one that the highest power of two divides). Searching a path is a fat binary
search: of an interval of depths the digest at its two-fattest number is looked up. A node found there whose
own digest is on the path becomes the new beginning of the interval; one whose digest is not is the exit
node, which the path leaves within its edge; where none is found the interval ends before that
number. So a path takes as many lookups as its length has bits. Each lookup is a join of all paths
with the table of handles.

A batch takes one path of each group that leaves the trie at the same place by the same turn, and
inserts them all at once: edges are cut where paths leave or end, the rest of a path becomes a leaf. The others
are searched again from where they left. The one that is taken is picked by a hash, so that it follows the
heavier branches most of the time and the number of batches grows with the logarithm of the paths.

Totals go up the trie by doubled ancestors, in as many rounds as its height has bits. At last edges are
expanded to a row for each depth. Equal conversations are one path with a count from the start. A
conversation's digests are one row, 24 bytes a turn; texts are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage

EMPTY_SHA = hashlib.sha256().hexdigest()

_NODE = "id binary, depth int, parent binary, start int, edge array<binary>, cums array<long>"


def own_turns(turns: DataFrame) -> DataFrame:
    """``conv_id`` and its turns in order, as digests with the bytes of the text."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    light = turns.where("conv_id is not null").select(
        "conv_id",
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.col("turn"),
            F.unhex(F.md5(named)).alias("digest"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("t"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return light.groupBy("conv_id").agg(ordered.alias("turns"))


def with_shared_beginnings(own: DataFrame, *, family: int = 5, longest: int = 9) -> DataFrame:
    """Conversations rebuilt so that many begin alike: the first h turns of the first of their family of ids, then
    their own turns behind their first h, h being a hash of the id modulo ``longest``."""
    heads = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, longest - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % longest).cast("int")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("head_id"), "left")
    before = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    own_rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(before, own_rest).alias("turns"))


def _paths(rebuilt: DataFrame) -> DataFrame:
    """``conv_id``, the digest and the summed bytes at every depth of its path, and the digest at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, cums = [], []
            for turns in batch.column(1).to_pylist():
                at, total, path, cum = b"", 0, [], []
                for turn in turns:
                    at = hashlib.md5(at + turn["digest"]).digest()
                    total += turn["size"]
                    path.append(at)
                    cum.append(total)
                paths.append(path)
                cums.append(cum)
            columns = [batch.column(0), pa.array(paths, pa.list_(pa.binary())), pa.array(cums, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "path", "cum"])

    kind = rebuilt.schema["conv_id"].dataType.simpleString()
    found = rebuilt.select("conv_id", "turns").mapInArrow(run, f"conv_id {kind}, path array<binary>, cum array<long>")
    return found.withColumn("end", _at("path", F.size("path")))


def _at(path: str, depth: Column) -> Column:
    """The digest at a depth: empty, the root's, at none; null beyond the path's end."""
    return F.when(depth == 0, F.expr("X''")).otherwise(F.get(F.col(path), depth - 1))


def fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the highest power of two divides."""
    msb = F.length(F.bin(a.bitwiseXOR(b).cast("long"))) - 1
    return b.bitwiseAND(F.call_function("shiftleft", F.lit(-1), msb.cast("int")))


def _handle() -> Column:
    return F.get("edge", fattest(F.col("start"), F.col("depth")) - F.col("start") - 1)


def search(pending: DataFrame, trie: DataFrame, steps: int) -> DataFrame:
    """``pending`` with ``a`` moved to the depth of the last node on each path, by ``steps`` lookups."""
    handles = trie.where("depth > 0").select(
        _handle().alias("handle"), F.col("id").alias("node"), F.col("depth").alias("to"), F.col("start").alias("from")
    )
    found = pending.withColumn("b", F.col("n"))
    for _ in range(steps):
        f = F.when(F.col("a") < F.col("b"), fattest(F.col("a"), F.col("b")))
        # a path whose search is over asks for what no node has, by a name of its own
        asked = F.coalesce(_at("path", f), F.concat("end", F.expr("X'00'")))
        looked = found.withColumn("f", f).withColumn("asked", asked).join(handles, F.col("asked") == F.col("handle"), "left")
        met = F.col("handle").isNotNull()
        whole = F.coalesce((F.col("to") <= F.col("n")) & (_at("path", F.col("to")) == F.col("node")), F.lit(False))
        a = F.when(met & whole, F.col("to")).when(met, F.col("from")).otherwise(F.col("a"))
        b = F.when(met & whole, F.col("b")).when(met, F.col("from")).otherwise(F.coalesce(F.col("f") - 1, F.col("b")))
        found = looked.select("end", "n", "path", "cum", a.alias("a"), F.greatest(a, b).alias("b"))
    return found.drop("b")


def _exits(found: DataFrame, trie: DataFrame) -> DataFrame:
    """Where each path leaves the trie: ``l``, the depth up to which it is in it, and ``cut``, the node whose edge it leaves."""
    edges = trie.where("depth > 0").select(F.get("edge", F.lit(0)).alias("branch"), F.col("id").alias("cut"), F.col("edge").alias("beside"))
    nobody = F.concat("end", F.expr("X'00'"))  # so that paths that end at a node do not all ask for null
    asked = F.coalesce(_at("path", F.col("a") + 1), nobody)
    joined = found.withColumn("asked", asked).join(edges, F.col("asked") == F.col("branch"), "left")
    along = F.slice("path", F.col("a") + 1, F.greatest(F.size("beside"), F.lit(0)))
    same = F.size(F.filter(F.zip_with("beside", along, lambda x, y: x.eqNullSafe(y)), lambda x: x))
    return joined.select("end", "n", "path", "cum", "cut", (F.col("a") + F.when(F.col("cut").isNull(), 0).otherwise(same)).alias("l"))


def _inserted(trie: DataFrame, left: DataFrame, leaves: DataFrame) -> DataFrame:
    """The trie with edges cut where paths leave them and with the new leaves."""
    cuts = left.where("cut is not null").groupBy("cut").agg(F.sort_array(F.collect_set("l")).alias("cuts"))
    joined = trie.join(cuts, F.col("id") == F.col("cut"), "left")
    ends = F.concat(F.array("start"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth"))
    pieces = joined.withColumn("ends", ends).withColumn("k", F.explode(F.sequence(F.lit(0), F.size("ends") - 2)))
    s, e = F.get("ends", F.col("k")), F.get("ends", F.col("k") + 1)
    pieces = pieces.withColumn("s", s - F.col("start")).withColumn("e", e - F.col("start"))
    cut = pieces.select(
        F.when(F.col("e") > 0, F.get("edge", F.col("e") - 1)).otherwise(F.col("id")).alias("id"),
        (F.col("start") + F.col("e")).alias("depth"),
        F.when(F.col("s") == 0, F.col("parent")).otherwise(F.get("edge", F.col("s") - 1)).alias("parent"),
        (F.col("start") + F.col("s")).alias("start"),
        F.slice("edge", F.col("s") + 1, F.col("e") - F.col("s")).alias("edge"),
        F.slice("cums", F.col("s") + 1, F.col("e") - F.col("s") + 1).alias("cums"),
    )
    rest = F.col("n") - F.col("l")
    new = leaves.select(
        F.col("end").alias("id"),
        F.col("n").alias("depth"),
        _at("path", F.col("l")).alias("parent"),
        F.col("l").alias("start"),
        F.slice("path", F.col("l") + 1, rest).alias("edge"),
        F.slice(F.concat(F.array(F.lit(0).cast("long")), "cum"), F.col("l") + 1, rest + 1).alias("cums"),
    )
    return cut.unionByName(new)


def trie_of(paths: DataFrame) -> DataFrame:
    """Nodes of the compacted trie of distinct ``paths`` (end, path, cum), the root included."""
    spark = paths.sparkSession
    trie = spark.createDataFrame([(b"", 0, None, 0, [], [0])], _NODE)
    pending = paths.select("end", F.size("path").alias("n"), "path", "cum", F.lit(0).alias("a")).where("n > 0")
    first = True
    while True:
        deepest = pending.agg(F.max(F.col("n") - F.col("a")), F.max("n")).first()
        if deepest[0] is None:
            return trie
        found = pending if first else search(pending, trie, int(deepest[1]).bit_length())
        left = cut_lineage(_exits(found, trie))
        going = left.where("n > l").withColumn("by", _at("path", F.col("l") + 1))
        taken = going.groupBy("by").agg(F.min_by("end", F.struct(F.xxhash64("end"), F.col("end"))).alias("end")).select("end")
        leaves = going.join(taken, "end", "left_semi")
        trie, pending = (
            cut_lineage(_inserted(trie, left, leaves)),
            cut_lineage(going.join(taken, "end", "left_anti").select("end", "n", "path", "cum", F.col("l").alias("a"))),
        )
        first = False


def _totals(trie: DataFrame, ends: DataFrame) -> DataFrame:
    """What each node's subtree holds: members, their smallest id, childless nodes, and the two sums that saved bytes
    are made of. ``up`` moves from the parent to ever higher ancestors, twice as far each round."""
    children = trie.where("depth > 0").groupBy("parent").agg(F.count("*").alias("n_children"))
    children = children.select(F.col("parent").alias("of"), "n_children")
    bytes_here = F.element_at("cums", -1) - F.get("cums", F.lit(0))
    n = F.coalesce("ended", F.lit(0))
    found = trie.join(ends, F.col("id") == F.col("end"), "left").join(children, F.col("id") == F.col("of"), "left")
    found = found.select(
        "id",
        F.col("parent").alias("up"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "first",
        n.alias("n"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        (n * F.element_at("cums", -1)).alias("spent"),
        bytes_here.alias("bytes"),
    )
    found = cut_lineage(found)
    sums = ("n", "leaves", "spent", "bytes")
    while found.where("up is not null").limit(1).count():
        below = found.where("up is not null").groupBy(F.col("up").alias("to"))
        below = below.agg(F.min("first").alias("first_below"), *(F.sum(c).alias(f"{c}_below") for c in sums))
        higher = found.select(F.col("id").alias("via"), F.col("up").alias("higher"))
        joined = found.join(below, F.col("id") == F.col("to"), "left").join(higher, F.col("up") == F.col("via"), "left")
        found = cut_lineage(
            joined.select(
                "id",
                F.col("higher").alias("up"),
                "n_children",
                F.least("first", "first_below").alias("first"),
                *((F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c) for c in sums),
            )
        )
    return found.drop("up")


def _ends(members: DataFrame) -> DataFrame:
    """``end`` and the digest of the ids that end there, which are read in order and never gathered."""
    ordered = members.repartition("end").sortWithinPartitions("end", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mark = None, None
        for batch in batches:
            ends, marks = [], []
            for end, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if end != held:
                    if held is not None:
                        ends.append(held)
                        marks.append(mark.hexdigest())
                    held, mark = end, hashlib.sha256(str(conv_id).encode())
                else:
                    mark.update(f",{conv_id}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.binary()), pa.array(marks, pa.string())], ["end", "sha"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([mark.hexdigest()])], ["end", "sha"])

    return ordered.mapInArrow(run, "end binary, sha string")


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning of ``conversations`` (``conv_id`` and ``turns``, as ``own_turns`` gives them).

    ``conv_id`` is the smallest member's id, ``parent_conv_id`` that of the beginning one turn shorter (null for the
    root); ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens``, the bytes that need not be read again where a
    turn is shared, over the subtree; ``ends_sha256`` of the ids that end there, in order. Null roles and texts are
    empty. Turns stand in order, null first, those of one turn in the order of a digest of role and
    text; repeated rows are turns of their own. Rows without a conv_id are left out, conversations without turns end at the
    root, no conversations give no rows. Other columns are left out.
    """
    paths = cut_lineage(_paths(conversations))
    ends = paths.groupBy("end").agg(
        F.min("conv_id").alias("first"), F.count("*").alias("ended"), F.first("path").alias("path"), F.first("cum").alias("cum")
    )
    ends = cut_lineage(ends)
    trie = trie_of(ends)
    totals = _totals(trie, ends.select("end", "first", "ended"))
    above = totals.select(F.col("id").alias("parent"), F.col("first").alias("parent_first"))
    whole = trie.join(totals, "id").join(above, "parent", "left")
    whole = whole.join(_ends(paths.select("end", "conv_id")), F.col("id") == F.col("end"), "left")
    places = F.explode(F.sequence(F.when(F.col("depth") == 0, 0).otherwise(1), F.size("edge")))
    each = whole.where("n > 0").withColumn("k", places)
    here, inner = F.col("k") == F.size("edge"), F.col("k") > 1
    before = F.get("cums", F.greatest(F.col("k") - 1, F.lit(0)))  # bytes above this depth
    under = F.col("bytes") - (before - F.get("cums", F.lit(0)))  # each node's bytes once, from this depth on
    return each.select(
        F.col("first").alias("conv_id"),
        (F.col("start") + F.col("k")).cast("long").alias("depth"),
        F.when(inner, F.col("first")).otherwise(F.col("parent_first")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(here, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("spent") - F.col("n") * before - under).alias("saved_tokens"),
        F.when(here, F.coalesce("sha", F.lit(EMPTY_SHA))).otherwise(EMPTY_SHA).alias("ends_sha256"),
    )
