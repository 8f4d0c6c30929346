"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap. Each chunk is split into pre-tokens and encoded by
a task of its own, although its first pre-tokens may be cut wrongly. Chunks are then
stitched: a pre-token boundary that a chunk shares with the true sequence makes all that
follows in the chunk right, since the pattern looks only ahead. Where a chunk has not come
back into step by the end of its predecessor, single pre-tokens are matched in the text until
it has. So the ids are those of the uncut text, for any chunk size and any text.

A null text is taken as empty and has no ids. Rows are kept as they are, repeated ones too;
columns other than the id and the text are not read. Ids are little-endian unsigned
32-bit integers in one binary value, so that a document stays one row of any length.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursetide.llm.inputs import few_at_once

#: Pre-tokens that end so close to a chunk's end may go on behind it: the longest
#: contraction of the pattern has three characters.
LOOKAHEAD = 3
#: A vocabulary is sent to every executor, so its file may not be larger than this.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pre-tokens whose ids a worker remembers, and characters it splits at once.
REMEMBERED, AT_ONCE = 100_000, 1 << 19
#: The public pattern, for texts without characters beyond Latin-1: there its classes are short
#: lists, which the standard library matches several times faster.
LATIN_1 = {
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""": (
        r" ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9\xb2\xb3\xb9\xbc-\xbe]+"
        r"| ?[^\x09-\x0d \x85\xa0A-Za-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
        r"|[\x09-\x0d \x85\xa0]+(?![^\x09-\x0d \x85\xa0])|[\x09-\x0d \x85\xa0]+"
    )
}


@functools.lru_cache(maxsize=2)
def _tokens(raw: bytes) -> list[bytes]:
    """Tokens by rank; empty where a rank is free."""
    found = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in raw.splitlines())}
    return [found.get(rank, b"") for rank in range(max(found, default=-1) + 1)]


def decoded_bytes(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Vocabulary:
    """Token ranks of a ``.tiktoken`` file and the merges they imply."""

    def __init__(self, raw: bytes, pattern: str):
        self.tokens = _tokens(raw)
        self.ranks = {token: rank for rank, token in enumerate(self.tokens) if token}
        self.pattern = regex.compile(pattern)
        self.fast = re.compile(LATIN_1[pattern]) if pattern in LATIN_1 else None
        self.known: dict[str, bytes] = {}
        self.none = len(self.tokens)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)])
        # every way to put a token together from two others
        pairs = sorted(
            (self.ranks[token[:k]] * self.none + self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        )
        self.pair_keys = np.array([key for key, _ in pairs] or [-1], "i8")
        self.pair_values = np.array([rank for _, rank in pairs] or [self.none], "i8")

    def split(self, text: str) -> list[str]:
        """Pre-tokens."""
        if self.fast is not None:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.pattern.findall(text)
            return self.fast.findall(text)
        return self.pattern.findall(text)

    def pieces(self, texts: list[str]) -> list[list[bytes]]:
        """Ids of every pre-token of every text."""
        split = [self.split(text) for text in texts]
        new = set().union(*split).difference(self.known)
        if new:
            if len(self.known) > REMEMBERED:
                new = set().union(*split)
                self.known = {}
            self.known.update(self._all(list(new)))
        get = self.known.__getitem__
        return [list(map(get, pieces)) for pieces in split]

    def piece(self, text: str) -> bytes:
        return self._all([text])[text]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text; texts are taken a few at a time, so that little is held at once."""
        out: list[bytes] = []
        first = size = 0
        for n, text in enumerate(texts):
            size += len(text)
            if size >= AT_ONCE or n + 1 == len(texts):
                out += map(b"".join, self.pieces(texts[first : n + 1]))
                first, size = n + 1, 0
        return out

    def _all(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens: those of the same number of bytes are merged side by side."""
        found: dict[str, bytes] = {}
        by_size: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(data) < 100:
                by_size[len(data)].append((piece, data))
            else:
                found[piece] = np.array([self.ranks[x] for x in self._many(data)], "<u4").tobytes()
        for size, group in by_size.items():
            rows = np.frombuffer(b"".join(data for _, data in group), "u1").reshape(-1, size)
            names = np.array([piece for piece, _ in group], dtype=object)
            for which, ids in self._side_by_side(self.bytes[rows]):
                raw, width = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                found.update((name, raw[k * width : (k + 1) * width]) for k, name in enumerate(names[which]))
        return found

    def _side_by_side(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and ids of rows that are done. In each round every row merges its pair of
        the lowest rank, the leftmost of equal ones, so rows stay of one length."""
        which = np.arange(len(ids))
        ranks = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(ids):
            if ids.shape[1] < 2:
                yield which, ids
                return
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ids)), at]
            done = best == self.none
            if done.any():
                yield which[done], ids[done]
                keep = ~done
                which, ids, ranks, at, best = which[keep], ids[keep], ranks[keep], at[keep], best[keep]
            n, width = ids.shape
            line = np.arange(n)
            ids[line, at] = best
            stay = np.ones((n, width), bool)
            stay[line, at + 1] = False
            ids = ids[stay].reshape(n, width - 1)
            stay = np.ones((n, width - 1), bool)
            stay[line, at] = False
            ranks = ranks[stay].reshape(n, width - 2)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._pair_ranks(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < width - 2)
            ranks[right, at[right]] = self._pair_ranks(ids[right, at[right]], ids[right, at[right] + 1])

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype("i8") * self.none + b
        at = np.searchsorted(self.pair_keys, keys).clip(max=len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], self.none)

    def _many(self, data: bytes) -> list[bytes]:
        """The same with a heap of pairs: a run of a million letters takes n log n steps."""
        n = len(data)
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n:
                stop = end[end[i]]
                rank = self.ranks.get(data[i:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, stop))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two has been merged meanwhile
            gone = end[i]
            end[i], end[gone] = stop, 0
            if stop < n:
                before[stop] = i
            offer(before[i])
            offer(i)
        parts, i = [], 0
        while i < n:
            parts.append(data[i : end[i]])
            i = end[i]
        return parts


@functools.lru_cache(maxsize=2)
def _vocabulary(raw: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(raw, pattern)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = 1 << 16,
    overlap: int = 1 << 10,
) -> DataFrame:
    """Id, ``n_tokens`` and ``ids`` of every row.

    Texts of up to ``chunk`` characters are one chunk and need no shuffle. The chunks of longer
    ones are dealt over all tasks, and one row per chunk comes together for stitching.
    """
    if chunk < 1 or overlap < LOOKAHEAD:
        raise ValueError(f"chunk must be positive and overlap at least {LOOKAHEAD}")
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(_checked(ranks_path))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(raw.value, pattern)
        for batch in few_at_once(batches, "text"):
            ids = vocabulary.encode(batch.column(1).to_pylist())
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    out = f"doc_id {id_type}, n_tokens long, ids binary"
    short = rows.where(F.length("text") <= chunk).mapInArrow(whole, out)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(raw.value, pattern)
        for batch in few_at_once(batches, "part"):
            texts = batch.column("part").to_pylist()
            pieces = [vocabulary.split(text) for text in texts]
            ids = vocabulary.pieces(texts)
            lengths = [np.array([len(p) for p in part], "<i4").tobytes() for part in pieces]
            counts = [np.array([len(x) // 4 for x in part], "<i4").tobytes() for part in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("row", "doc_id", "start", "part")),
                    pa.array(lengths, pa.binary()),
                    pa.array(counts, pa.binary()),
                    pa.array([b"".join(part) for part in ids], pa.binary()),
                ],
                ["row", "doc_id", "start", "part", "lengths", "counts", "ids"],
            )

    def stitch(table: pa.Table) -> pa.Table:
        vocabulary = _vocabulary(raw.value, pattern)
        parts = table.sort_by("start").to_pylist()
        ids = _stitched(vocabulary, parts, chunk)
        columns = {"doc_id": table.column("doc_id")[:1], "n_tokens": [len(ids) // 4], "ids": [ids]}
        return pa.table(columns)

    long = (
        rows.where(F.length("text") > chunk)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("start", F.explode(F.expr(f"sequence(0, length(text) - 1, {chunk})")))
        .select("row", "doc_id", "start", F.expr(f"substring(text, start + 1, {chunk + overlap})").alias("part"))
        .repartition("row", "start")
        .mapInArrow(chunks, f"row long, doc_id {id_type}, start int, part string, lengths binary, counts binary, ids binary")
        .groupBy("row")
        .applyInArrow(stitch, out)
    )
    return short.unionByName(long)


def _stitched(vocabulary: Vocabulary, parts: list[dict], chunk: int) -> bytes:
    text = "".join(part["part"][:chunk] for part in parts)
    out, at = [], 0
    for n, part in enumerate(parts):
        lengths = np.frombuffer(part["lengths"], "<i4")
        starts = part["start"] + np.concatenate(([0], np.cumsum(lengths))).astype("i8")
        trusted = part["start"] + len(part["part"]) - (LOOKAHEAD if n + 1 < len(parts) else 0)
        good = int(np.searchsorted(starts, trusted, side="right")) - 1  # pre-tokens that end there or before
        while at < len(text):
            first = int(np.searchsorted(starts, at))
            if first >= good:
                break  # beyond what this chunk knows
            if starts[first] == at:
                token_ends = np.concatenate(([0], np.cumsum(np.frombuffer(part["counts"], "<i4"))))
                out.append(part["ids"][4 * token_ends[first] : 4 * token_ends[good]])
                at = int(starts[good])
                break
            piece = vocabulary.pattern.match(text, at).group()
            out.append(vocabulary.piece(piece))
            at += len(piece)
    while at < len(text):  # a pre-token longer than what the last chunks saw
        piece = vocabulary.pattern.match(text, at).group()
        out.append(vocabulary.piece(piece))
        at += len(piece)
    return b"".join(out)


def decode(encoded: DataFrame, ranks_path: str, *, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the tokens' bytes in order."""
    raw = encoded.sparkSession.sparkContext.broadcast(_checked(ranks_path))
    names = [name for name in encoded.columns if name != "decoded"]
    rows = encoded.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(raw.value)
        for batch in few_at_once(batches, ids):
            decoded = [decoded_bytes(x.as_py() or b"", tokens) for x in batch.column(names.index(ids))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*names, "decoded"]
            )

    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _checked(path: str) -> bytes:
    size = Path(path).stat().st_size
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MAX_VOCABULARY_BYTES}")
    return Path(path).read_bytes()
