"""Secret scans by a worklist of decoded layers.

A text is the first layer. Each layer is scanned for secrets and then unwrapped in every way that
applies to it: percent escapes, Unicode escapes and numeric character references are replaced where
they stand, so that what surrounds them still counts, and each run of base64 is opened by itself,
through gzip, zlib, bzip2, xz and zstd as often as they are nested. What comes out is put on the
worklist, until nothing new does. A layer that was seen before, such as an archive that holds itself, is not
taken up again.

Every character of a layer knows which part of the original it came from, so that a find in any layer
becomes a span of the original text: that of its escapes, of its base64 digits, or of the
whole run where compression has mixed them.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import few_at_once

Span = tuple[int, int]

#: Kinds in the order in which they are listed, and what each is.
KINDS = ("assign", "access", "hex")
#: In the first, what was assigned is group 2; a match whose value is too short still uses up its text.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGNED = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&\#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
)
#: Twelve digits hold nine characters, fewer than any kind has.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
#: Bytes that one base64 run may unpack to; a longer stream is left unopened, so that a worker's memory is bounded.
UNPACKED = 1 << 26


def scan(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of one layer, leftmost and not overlapping within a kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    found += (("access", m.start(), m.end()) for m in ACCESS.finditer(text))
    found += (("hex", m.start(), m.end()) for m in HEX.finditer(text))
    return found


class Layer:
    """A text and where in the original its characters come from: each from a span of its own, all from one,
    or, with neither given, from where they stand."""

    __slots__ = ("text", "first", "last", "whole")

    def __init__(self, text: str, first: array | None = None, last: array | None = None, whole: Span | None = None) -> None:
        self.text, self.first, self.last, self.whole = text, first, last, whole

    def span(self, start: int, end: int) -> Span:
        if self.whole is not None:
            return self.whole
        if self.first is None:
            return start, end
        return min(self.first[start:end]), max(self.last[start:end])


def all_secrets(text: str, base: list[tuple[str, int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Spans of the text itself (``base``, if they are known) and of all layers below it, each once, by start and kind."""
    found, seen, work = set(scan(text) if base is None else base), set(), _unwrapped(Layer(text))
    while work:
        layer = work.pop()
        if not layer.text:
            continue
        # the same content elsewhere in the original has spans of its own, so the place counts as well
        mark = _digest(layer.text), layer.span(0, len(layer.text))
        if mark in seen:
            continue
        seen.add(mark)
        found.update((kind, *layer.span(start, end)) for kind, start, end in scan(layer.text))
        work += _unwrapped(layer)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _unwrapped(layer: Layer) -> list[Layer]:
    """The layers one step below."""
    text, below = layer.text, []
    if "%" in text:
        below.append(_replaced(layer, PERCENT, _percent))
    if "\\" in text or "&#" in text:
        below.append(_replaced(layer, ESCAPE, _escaped))
    below += (_opened(layer, m) for m in BASE64.finditer(text))
    return [each for each in below if each is not None]


Pieces = list[tuple[str, int, int]]


def _replaced(layer: Layer, pattern: re.Pattern, decode: Callable[[str], Pieces | None]) -> Layer | None:
    """The layer with every match decoded where it stands; None if none could be."""
    parts, first, last, at = [], array("q"), array("q"), 0
    placed = layer.whole is None
    for m in pattern.finditer(layer.text):
        pieces = decode(m.group())
        if pieces is None:
            continue
        parts.append(layer.text[at : m.start()])
        parts += (char for char, _, _ in pieces)
        if placed:
            _keep(layer, at, m.start(), first, last)
            for _, start, end in pieces:
                start, end = layer.span(m.start() + start, m.start() + end)
                first.append(start)
                last.append(end)
        at = m.end()
    if not at:
        return None
    parts.append(layer.text[at:])
    if not placed:
        return Layer("".join(parts), whole=layer.whole)
    _keep(layer, at, len(layer.text), first, last)
    return Layer("".join(parts), first, last)


def _keep(layer: Layer, start: int, end: int, first: array, last: array) -> None:
    first.extend(range(start, end) if layer.first is None else layer.first[start:end])
    last.extend(range(start + 1, end + 1) if layer.last is None else layer.last[start:end])


def _utf8(data: bytes) -> list[tuple[str, int, int]] | None:
    """Characters with their first and last byte; None if the bytes are not text."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    out, at = [], 0
    for char in text:
        size = len(char.encode())
        out.append((char, at, at + size))
        at += size
    return out


def _bytes_or_latin(data: bytes) -> list[tuple[str, int, int]]:
    """Bytes that are no UTF-8 are taken one character each."""
    return _utf8(data) or [(chr(b), k, k + 1) for k, b in enumerate(data)]


def _percent(run: str) -> Pieces:
    return [(c, 3 * a, 3 * b) for c, a, b in _bytes_or_latin(bytes.fromhex(run.replace("%", "")))]


def _escaped(run: str) -> Pieces | None:
    if run.startswith("\\x"):
        return [(c, 4 * a, 4 * b) for c, a, b in _bytes_or_latin(bytes.fromhex(run.replace("\\x", "")))]
    if run.startswith("\\u") and run[2] != "{":
        units = bytes.fromhex(run.replace("\\u", ""))
        pieces, at = [], 0
        for char in units.decode("utf-16-be", "surrogatepass"):
            size = 12 if ord(char) > 0xFFFF else 6
            pieces.append((char, at, at + size))
            at += size
        return pieces
    digits = run.strip("\\uU{}&#xX;")
    code = int(digits, 10 if run.startswith("&#") and run[2] not in "xX" else 16)
    if code > 0x10FFFF:
        return None
    return [(chr(code), 0, len(run))]


def _opened(layer: Layer, m: re.Match) -> Layer | None:
    """What a run of base64 digits holds, if that is text."""
    digits = m.group().rstrip("=").translate({ord("-"): "+", ord("_"): "/"})
    if len(digits) % 4 == 1:
        return None
    data = binascii.a2b_base64(digits + "=" * (-len(digits) % 4))
    where = layer.span(m.start(), m.end())
    unpacked = _unpacked(data)
    try:  # most runs are long words or keys, which decode to no text
        text = (data if unpacked is None else unpacked).decode()
    except UnicodeDecodeError:
        return None
    if unpacked is not None or layer.whole is not None:
        return Layer(text, whole=where)
    first, last = array("q"), array("q")
    for _, a, b in _utf8(data):  # byte k stands in the bits 8k to 8k + 7 of the digits, six to each
        start, end = layer.span(m.start() + 8 * a // 6, m.start() + -(-8 * b // 6))
        first.append(start)
        last.append(end)
    return Layer(text, first, last)


def _unpacked(data: bytes) -> bytes | None:
    """The content of a compressed stream; None if it is none, is broken or unpacks to more than ``UNPACKED``.

    Streams inside streams are opened until one is none or was met before.
    """
    met, content = set(), None
    while (opener := _opener(data)) is not None:
        mark = hashlib.blake2b(data, digest_size=16).digest()
        if mark in met:
            break
        met.add(mark)
        try:
            data = opener(data)
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
            break
        if len(data) > UNPACKED:
            return None
        content = data
    return content


def _opener(data: bytes) -> Callable[[bytes], bytes] | None:
    if data[:2] == b"\x1f\x8b":
        return lambda d: zlib.decompressobj(31).decompress(d, UNPACKED + 1)
    if data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return lambda d: zlib.decompressobj().decompress(d, UNPACKED + 1)
    if data[:3] == b"BZh":
        return lambda d: bz2.BZ2Decompressor().decompress(d, UNPACKED + 1)
    if data[:6] == b"\xfd7zXZ\x00":
        return lambda d: lzma.LZMADecompressor().decompress(d, UNPACKED + 1)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return _zstd
    return None


def _zstd(data: bytes) -> bytes:
    with zstandard.ZstdDecompressor().stream_reader(data) as reader:
        return reader.read(UNPACKED + 1)


def secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every row: arrays of (kind, start, end) in code points, end exclusive.

    ``base`` holds what stands in the text as it is, ``spans`` that and what its layers hold, both by
    start and then kind. Null and empty texts have none. Rows are independent: repeated rows
    and ids give repeated rows, a null id stays, no rows give none, other columns are left out
    whatever their names. A text is held by one task, together with the layers on the worklist.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(found: list[tuple[str, int, int]]) -> list[dict]:
        found = sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        return [dict(zip(("kind", "start", "end"), s, strict=True)) for s in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches, "text"):
            found = [(scan(t), t) for t in batch.column(1).to_pylist()]
            base = pa.array([listed(b) for b, _ in found], spans)
            every = pa.array([listed(all_secrets(t, b)) for b, t in found], spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), base, every], ["doc_id", "base", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    several = "array<struct<kind: string, start: long, end: long>>"
    return rows.mapInArrow(run, f"doc_id {kind}, base {several}, spans {several}")
