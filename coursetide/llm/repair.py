"""Repair of conversation structure by depth-first branch and bound.

A repaired conversation has roles that read ``(s?(ua)+)?`` by their initials: perhaps one system turn,
then users and assistants by turns, an assistant last; or no turn at all. Turns are kept, given
another role, deleted, or inserted without text, at the costs below, and the cheapest way is wanted,
of equally cheap ones that whose edits read least.

The search keeps an explicit stack of prefixes and takes edits in the order of their letters, so that
prefixes are met in the order of their audits. Its parts:

* Suffix lower bounds: what turns must cost that cannot stay, and one for each pair of neighbours
  that cannot both stay as they are, no turn being in two pairs.
* The incumbent: the cost and audit of the best repair so far, at first the cost of a plain greedy one. A
  prefix whose cost and bound exceed it is given up; so is one that only equals it, once there is an audit,
  since that audit is less.
* Dominance tables: for each turn and role state the least cost at which it was reached. A
  prefix that comes to the same node at no less was met later, so its audit is greater as well.

When the stack is empty no better repair is left.

The search sees one letter per turn and no texts. Turns are dealt by ranges of conversation and turn, so
a conversation of very many is spread over tasks and cut into blocks of ``BLOCK`` turns. A block is solved for
each role state it may be entered and left in; the blocks of a conversation are then chained. Only the text
that is put out passes through one task by conversation, as a stream and never as a whole, as its digest
needs every turn in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage, few_at_once

#: What edits cost, and what a truncated turn costs beside if it stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns in a block.
BLOCK = 256
#: Role states: nothing yet, after a system turn, after a user, after an assistant.
STATES = range(4)
ENDS = (0, 3)
#: The state after a turn that stays, by state and initial.
STAYS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state after a turn that is given a role or inserted: whichever of user and assistant may stand next.
NEXT = (2, 2, 3, 2)
LEGAL = ("su", "ua", "au")
ROLES = {2: "user", 3: "assistant"}
#: White space at the end of a text.
BLANKS = " \t\n\x0b\x0c\r"

Solution = tuple[int, str, int]


def bounds(codes: str, exits: Iterable[int]) -> list[int]:
    """For each suffix of ``codes``, what it costs at the least, whatever comes before it."""
    least, low = [0] * (len(codes) + 1), 0
    # the nearest turn behind that could stay at no cost and is in no pair; "" is the end
    after, free = "", True
    closing = {initial for initial, state in (("s", 1), ("u", 2), ("a", 3)) if state in exits}
    for k in range(len(codes) - 1, -1, -1):
        code = codes[k]
        if code == "x" or code.isupper():
            low += DELETE
        elif code == "o":
            low += REROLE
            free = False
        else:
            fits = code + after in LEGAL if after else code in closing
            if free and not fits:
                low += 1
                free = False
            else:
                after, free = code, True
        least[k] = low
    return least


def greedy(codes: str, entry: int, exits: Iterable[int]) -> int:
    """The cost of some repair, or more than that of any where these two ways find none."""
    found = [DELETE * len(codes) + 2 * INSERT]
    for edit in (REROLE, DELETE):
        state, cost = entry, 0
        for code in codes:
            if code == "x" or code.isupper():
                cost += DELETE
            elif code in STAYS[state]:
                state = STAYS[state][code]
            else:
                cost += edit
                state = NEXT[state] if edit == REROLE else state
        if state not in exits:
            state, cost = NEXT[state], cost + INSERT
        if state in exits:
            found.append(cost)
    return min(found)


def search(codes: str, entry: int = 0, exits: tuple[int, ...] = ENDS) -> Solution | None:
    """Cost, audit and last state of the best repair from state ``entry`` to one of ``exits``; None if there is none.

    ``codes`` has a letter per turn: s, u, a by the initial of its role, o for any other, in upper case for a
    truncated turn, x for one that must go.
    """
    # user and assistant turns lead to each other and never back to less
    size, last = len(codes), 3 if max(exits) >= 2 else max(exits)
    least = bounds(codes, exits)
    limit, best = greedy(codes, entry, exits) + 1, None
    reached = [[limit + 1] * 4 for _ in range(size + 1)]
    path, stack = bytearray(), [(0, entry, 0, 0, 0)]
    while stack:
        at, state, cost, depth, letter = stack.pop()
        if cost + least[at] >= limit or cost >= reached[at][state]:
            continue
        reached[at][state] = cost
        del path[max(0, depth - 1) :]
        if depth:
            path.append(letter)
        if at == size and state in exits:
            limit, best = cost, (cost, path.decode(), state)
        # last in, first out: from the greatest letter to the least
        moved, depth = NEXT[state], depth + 1
        reachable = moved <= last
        if at < size:
            code = codes[at]
            extra = TRUNCATED if code.isupper() else 0
            if code != "x":
                if reachable:
                    stack.append((at + 1, moved, cost + REROLE + extra, depth, 82))  # R
                stays = STAYS[state].get(code.lower())
                if stays is not None and stays <= last:
                    stack.append((at + 1, stays, cost + extra, depth, 75))  # K
        if reachable:
            stack.append((at, moved, cost + INSERT, depth, 73))  # I
        if at < size:
            stack.append((at + 1, state, cost + DELETE, depth, 68))  # D
    return best


class _Block:
    """Turns of one conversation next to each other, with what its neighbours need to know of it."""

    def __init__(self, conv_id: object, turn: object, digest: bytes | None, block: int, starts: bool) -> None:
        self.key = (conv_id, turn, digest, block)
        self.starts, self.codes = starts, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first = self.last = ""

    def add(self, turn: int | None, initial: str, blank: bool, again: bool, open_end: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.codes:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        code = initial
        if blank:
            self.blank, code = self.blank + 1, "x"
        elif again:
            self.duplicate, code = self.duplicate + 1, "x"
        elif open_end:
            self.truncated, code = self.truncated + 1, initial.upper()
        self.codes.append(code)

    def row(self, ends: bool) -> dict:
        codes = "".join(self.codes)
        ways = []
        for entry in (0,) if self.starts else STATES:
            for exits in (ENDS,) if ends else ((e,) for e in STATES):
                found = search(codes, entry, exits)
                if found is not None:
                    ways.append({"entry": entry, "exit": found[2], "cost": found[0], "audit": found[1]})
        named = dict(zip(("conv_id", "turn", "digest", "block"), self.key, strict=True))
        own = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first", "last")
        return named | {"info": {name: getattr(self, name) for name in own} | {"size": len(codes), "ways": ways}}


_INFO = (
    "struct<blank: long, duplicate: long, truncated: long, illegal: long, turns: long, first_turn: long, last_turn: long, "
    "first: string, last: string, size: long, ways: array<struct<entry: int, exit: int, cost: long, audit: string>>>"
)


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Turns come in order. The first and the last conversation of a partition may go on in its neighbours."""
    held, rows = None, []
    for batch in batches:
        for conv_id, turn, digest, initial, blank, open_end, n, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is None or conv_id != held.key[0]:
                if held is not None:
                    rows.append(held.row(ends=True))
                held = _Block(conv_id, turn, digest, 0, starts=held is not None)
            for copy in range(n):
                if len(held.codes) == size:
                    rows.append(held.row(ends=False))
                    held = _Block(conv_id, turn, digest, held.key[3] + 1, starts=False)
                held.add(turn, initial, blank, again or copy > 0, open_end)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows = []
    if held is not None:
        yield pa.RecordBatch.from_pylist([held.row(ends=False)], schema)


class _Chain:
    """The blocks of one conversation, then its turns with their texts, in order."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.last, self.size = "", 0
        self.states: dict[int, tuple[int, str]] = {0: (0, "")}
        self.audit, self.cost, self.at, self.state, self.place = None, 0, 0, 0, 0

    def block(self, info: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + info[name])
        if self.size and info["size"]:
            self.illegal += self.last + info["first"] not in LEGAL
        if info["first_turn"] is not None:
            self.turns -= self.last_turn == info["first_turn"]
            self.first_turn = info["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = info["last_turn"]
        self.last, self.size = info["last"] if info["size"] else self.last, self.size + info["size"]
        states: dict[int, tuple[int, str]] = {}
        for way in info["ways"]:
            if way["entry"] in self.states:
                cost, audit = self.states[way["entry"]]
                whole = cost + way["cost"], audit + way["audit"]
                states[way["exit"]] = min(states.get(way["exit"], whole), whole)
        self.states = states

    def solved(self) -> None:
        if self.audit is None:
            self.cost, self.audit = min(self.states[e] for e in ENDS if e in self.states)

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Turns that stand before the next one of the conversation."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield ROLES[self.state], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        self.solved()
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STAYS[self.state][role[:1]]
            yield role, text
        elif edit == "R":
            self.state = NEXT[self.state]
            yield ROLES[self.state], text

    def report(self, digest: str) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        own = ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
        return {name: getattr(self, name) for name in own} | {"gaps": gaps, "repaired_sha256": digest}


def _chained(batches: Iterator[pa.RecordBatch], report: pa.Schema | None, turns: pa.Schema | None) -> Iterator[pa.RecordBatch]:
    """Reports of the conversations or, with a schema for them, their repaired turns."""
    chain, mark, rows = None, None, []

    def put(repaired: Iterator[tuple[str, str]]) -> None:
        for role, text in repaired:
            if turns is not None:
                rows.append({"conv_id": chain.conv_id, "place": chain.place, "role": role, "text": text})
            else:
                mark.update(("\n" * (chain.place > 0) + f"{role}:{text}").encode())
            chain.place += 1

    def finish() -> None:
        chain.solved()
        put(chain.inserted())
        if turns is None:
            rows.append(chain.report(mark.hexdigest()))

    for batch in few_at_once(batches, "text"):
        for conv_id, info, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if chain is None or conv_id != chain.conv_id:
                if chain is not None:
                    finish()
                chain, mark = _Chain(conv_id), hashlib.sha256()
            if info is not None:
                chain.block(info)
            else:
                for _ in range(copies):
                    put(chain.turn(role, text))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, report or turns)
            rows = []
    if chain is not None:
        finish()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, report or turns)


def _dealt(turns: DataFrame, block: int) -> DataFrame:
    """Blocks and turns of each conversation in one partition, in order: blocks first."""
    absent = F.col("copies") <= 0
    rows = turns.select(
        "conv_id",
        F.when(~absent, F.col("turn").cast("long")).alias("turn"),
        F.when(~absent, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(~absent, F.coalesce("text", F.lit(" "))).alias("text"),
        F.greatest("copies", F.lit(0)).cast("long").alias("copies"),
    ).withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id",
        "turn",
        "digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open_end"),
        "copies",
    )
    # equal rows are one row with their number from here on
    named = ["conv_id", "turn", "digest", "initial", "blank", "open_end"]
    light = cut_lineage(light.groupBy(*named).agg(F.sum("copies").alias("n")))
    early = light.groupBy("conv_id", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("early"))
    early = early.select(F.col("conv_id").alias("its_conv"), F.col("digest").alias("its_digest"), F.col("early.turn").alias("early"))
    met = light.join(early, F.col("conv_id").eqNullSafe(F.col("its_conv")) & F.col("digest").eqNullSafe(F.col("its_digest")))
    met = cut_lineage(met.select(*named, "n", (~F.col("turn").eqNullSafe(F.col("early"))).alias("again")))
    order = ["conv_id", "turn", "digest"]
    ranged = met.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()
    block_schema = f"conv_id {kind}, turn long, digest binary, block long, info {_INFO}"
    arrow = _arrow(turns, block_schema)
    blocks = ranged.mapInArrow(lambda batches: _blocks(batches, arrow, block), block_schema)
    nothing = [F.lit(None).cast("string").alias(name) for name in ("role", "text")]
    told = blocks.select(*order, "block", "info", *nothing, F.lit(0).cast("long").alias("copies"))
    texts = rows.where("copies > 0").select(
        *order, F.lit(None).cast("long").alias("block"), F.lit(None).cast(_INFO).alias("info"), "role", "text", "copies"
    )
    both = told.unionByName(texts).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.col("block").isNull(), "turn", "digest", "block")
    return both.select("conv_id", "info", "role", "text", "copies")


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)


def _one_each(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", "role", "text", F.lit(1).alias("copies"))


def audits(turns: DataFrame, *, counted: bool = False, block: int = BLOCK) -> DataFrame:
    """One row per conversation: faults found, the cost and audit of its repair, and the digest of the repaired text.

    ``turns`` has conv_id, turn, role and text, and with ``counted`` also copies, how many equal rows one
    stands for; a conversation whose rows all have none is reported without turns. Null roles and texts
    are one space, and a null conv_id is a conversation of its own. Turns are taken in order, null first;
    rows of one turn in the order of a digest of role and text, which puts equal ones next to each other. A role that begins
    with another letter than s, u or a, or is empty, can't stay. No rows give no rows; other columns are left out.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    arrow = _arrow(turns, schema)
    dealt = _dealt(turns if counted else _one_each(turns), block)
    return dealt.mapInArrow(lambda batches: _chained(batches, arrow, None), schema)


def repaired(turns: DataFrame, *, counted: bool = False, block: int = BLOCK) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), role and text; see ``audits``."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, place long, role string, text string"
    arrow = _arrow(turns, schema)
    dealt = _dealt(turns if counted else _one_each(turns), block)
    return dealt.mapInArrow(lambda batches: _chained(batches, None, arrow), schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults made from a hash of conversation and turn: one in twenty each dropped, emptied, without
    its full stops, repeated, or said by the user. ``copies`` is 0, 1 or 2; nulls are one space."""

    def known(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(known("role")).alias("role"),
        text.alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
