"""Secrets in texts, also in nested encodings.

The text itself is the first layer.  A worklist unwraps layers until no new one appears: runs of URL escapes,
Unicode escapes, and base64 words whose bytes are text or compressed text are replaced by what they stand
for, and the new layer is scanned and unwrapped in turn.  Base64 that is wrapped over lines is also taken as one
word; what is compressed several times, or in several members, is unpacked to the end.  Layers seen before are not taken again, so cycles
end.  Every character of a layer knows the span of the document that it came from; a secret found in
any layer is reported with its span in the document.

Kinds, each leftmost and without overlap: ``assign`` (a word like password, then : or =, then a value of 8
characters or more; the span is the whole match), ``access`` (AKIA..., 16 characters or more), ``hex`` (32
characters or more).  Spans are counted in code points, the end is exclusive.

Cases: a null text counts as empty.  Bytes of a run of escapes that are no valid text stay as they are, and so does a
compressed layer of more than ``max_layer`` characters: that keeps a decompression bomb out of memory.
Rows that repeat an id are scanned each.  Only id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
MAX_LAYER = 1 << 26
REDACTED = "[secret]"

# What a secret looks like.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_LEAST_ASSIGN, _LEAST_ACCESS, _LEAST_HEX = 8, 16, 32

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u\{[0-9a-fA-F]{1,6}\}|\\u[0-9a-fA-F]{4}"
    r"|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}"
)
# Shorter base64 words cannot hold a secret.
_LEAST_WORD = 16
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Base64 lines that only line ends and indentation part.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++(?!={0,2}[ \t]*+\w))+", re.ASCII
)
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_VALID = re.compile("[^\udc80-\udcff]+")
# Bytes that a decompressor is given at a time.
_PIECE = 1 << 16

Span = tuple[str, int, int]
# A part of a layer that stands for other text: start, end, that text, and for each of its characters the
# start and end within the layer.
Edit = tuple[int, int, str, np.ndarray, np.ndarray]


def scan(text: str) -> list[Span]:
    """The secrets of one layer as it stands."""
    found: list[Span] = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(word in low for word in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_ASSIGN]
    for at, word in _long_words(text):
        if "AKIA" in word:
            spans = (m.span() for m in _ACCESS.finditer(word))
            found += [("access", at + a, at + b) for a, b in spans if b - a >= _LEAST_ACCESS]
        if len(word) >= _LEAST_HEX:
            found += [("hex", at + m.start(), at + m.end()) for m in _HEX.finditer(word)]
    return found


def _long_words(text: str) -> Iterator[tuple[int, str]]:
    """Words that are long enough for an access key, a hexadecimal secret or base64, with their place."""
    at = 0
    for word in text.split():
        if len(word) >= _LEAST_WORD:
            at = text.index(word, at)
            yield at, word
            at += len(word)


def find(text: str, max_layer: int = MAX_LAYER) -> tuple[list[Span], list[Span]]:
    """The secrets of the text as it stands, and those of all layers, both in order."""
    base = scan(text)
    spans = set(base)
    seen = {_digest(text)}
    work: list[tuple[str, np.ndarray | None, np.ndarray | None]] = [(text, None, None)]
    while work:
        layer, starts, ends = work.pop()
        for edits in (
            _url_edits(layer),
            _unicode_edits(layer),
            _base64_edits(layer, max_layer),
            *_wrapped_edits(layer, max_layer),
        ):
            if not edits:
                continue
            inner, inner_starts, inner_ends = _apply(layer, edits, starts, ends)
            digest = _digest(inner)
            if digest in seen:
                continue
            seen.add(digest)
            spans.update((kind, int(inner_starts[a]), int(inner_ends[b - 1])) for kind, a, b in scan(inner))
            work.append((inner, inner_starts, inner_ends))
    return _ordered(base), _ordered(spans)


def _ordered(spans: list[Span] | set[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def _apply(
    layer: str, edits: list[Edit], starts: np.ndarray | None, ends: np.ndarray | None
) -> tuple[str, np.ndarray, np.ndarray]:
    """The layer with the edits made, and for each character its span in the document."""
    if starts is None or ends is None:
        starts, ends = np.arange(len(layer)), np.arange(1, len(layer) + 1)
    parts, from_, to, at = [], [], [], 0
    for a, b, text, first, last in edits:
        parts += [layer[at:a], text]
        from_ += [starts[at:a], starts[first]]
        to += [ends[at:a], ends[last - 1]]
        at = b
    return "".join([*parts, layer[at:]]), np.concatenate([*from_, starts[at:]]), np.concatenate([*to, ends[at:]])


def _bytes_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Per character of a decoded text, its first byte and the byte after its last."""
    sizes = np.fromiter((len(c.encode(errors="surrogateescape")) for c in text), np.int64, len(text))
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def _url_edits(layer: str) -> list[Edit]:
    edits: list[Edit] = []
    if "%" not in layer:
        return edits
    for m in _URL.finditer(layer):
        text = bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape")
        first, last = _bytes_of(text)
        first, last = m.start() + 3 * first, m.start() + 3 * last
        for valid in _VALID.finditer(text):
            a, b = valid.span()
            edits.append((int(first[a]), int(last[b - 1]), valid[0], first[a:b], last[a:b]))
    return edits


def _unicode_edits(layer: str) -> list[Edit]:
    edits: list[Edit] = []
    if "\\" not in layer:
        return edits
    for m in _UNICODE.finditer(layer):
        digits = re.findall(r"[0-9a-fA-F]+", m[0].replace("\\u", " ").replace("\\U", " ").replace("\\x", " "))
        code = int(digits[0], 16)
        if len(digits) == 2:
            code = 0x10000 + ((code - 0xD800) << 10) + int(digits[1], 16) - 0xDC00
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            continue
        edits.append((m.start(), m.end(), chr(code), np.array([m.start()]), np.array([m.end()])))
    return edits


def _base64_edits(layer: str, max_layer: int) -> list[Edit]:
    edits: list[Edit] = []
    for at, word in _long_words(layer):
        for m in _BASE64.finditer(word):
            a, b = at + m.start(), at + m.end()
            edit = _decoded(m[0].rstrip("="), np.arange(a, b), b, max_layer)
            if edit:
                edits.append(edit)
    return edits


def _wrapped_edits(layer: str, max_layer: int) -> list[list[Edit]]:
    """Base64 over several lines: all lines of a run, and those of one width, with and without a shorter last one."""
    ways: list[list[Edit]] = [[], [], []]
    if "\n" not in layer:
        return ways
    for m in _WRAPPED.finditer(layer):
        lines = [line.span() for line in _BASE64_LINE.finditer(layer, *m.span())]
        blocks = [(0, lines)]
        start = 0
        for n in range(1, len(lines) + 1):
            width = lines[start][1] - lines[start][0]
            if n < len(lines) and lines[n][1] - lines[n][0] == width:
                continue
            if n < len(lines) and lines[n][1] - lines[n][0] < width:
                blocks.append((1, lines[start : n + 1]))
            if n - start > 1:
                blocks.append((2, lines[start:n]))
            start = n
        for way, own in blocks:
            edit = _decoded(
                "".join(layer[a:b] for a, b in own), np.concatenate([np.arange(a, b) for a, b in own]), own[-1][1], max_layer
            )
            # A shorter line may end one block and begin another.
            if edit and (not ways[way] or ways[way][-1][1] <= edit[0]):
                ways[way].append(edit)
    return ways


def _decoded(word: str, places: np.ndarray, end: int, max_layer: int) -> Edit | None:
    """What a base64 word without padding stands for; its characters are at these places of the layer."""
    body = word.replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4))
    except binascii.Error:
        return None
    start = int(places[0])
    packed = _unpacked(data, max_layer)
    if packed is not None:
        # What unpacks is no chance: bytes that are no text do not hide the others.
        text = packed.decode(errors="replace")
        return (start, end, text, np.full(len(text), start), np.full(len(text), end)) if text else None
    text = _text(data)
    if not text:
        return None
    first, last = _bytes_of(text)
    # Three bytes are four characters.
    return start, end, text, places[first * 4 // 3], places[(last * 4 + 2) // 3 - 1] + 1


def _text(data: bytes) -> str | None:
    """The bytes as text, if they are valid UTF-8."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


# By the first bytes of what is compressed.
_INFLATERS: tuple[tuple[tuple[bytes, ...], Callable], ...] = (
    ((b"\x1f\x8b",), lambda: zlib.decompressobj(31)),
    ((b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda"), zlib.decompressobj),
    ((b"BZh",), bz2.BZ2Decompressor),
    ((b"\xfd7zXZ",), lzma.LZMADecompressor),
)
_ZSTD = b"\x28\xb5\x2f\xfd"
_BROKEN = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError)


def _unpacked(data: bytes, max_layer: int) -> bytes | None:
    """What compressed bytes hold, also if that is compressed in turn; none if they are not compressed."""
    made, seen = None, set()
    while (inner := _decompress(data, max_layer)) is not None:
        digest = hashlib.sha256(inner).digest()
        if digest in seen:
            break
        seen.add(digest)
        made = data = inner
    return made


def _decompress(data: bytes, max_layer: int) -> bytes | None:
    if data.startswith(_ZSTD):
        for across in (True, False):
            try:
                made = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=across).read(max_layer + 1)
            except _BROKEN:
                continue
            return made if len(made) <= max_layer else None
        return None
    for heads, inflater in _INFLATERS:
        if data.startswith(heads):
            return _members(data, heads, inflater, max_layer)
    return None


def _members(data: bytes, heads: tuple[bytes, ...], inflater: Callable, max_layer: int) -> bytes | None:
    """All members in a row, and what follows them as it is."""
    parts: list[bytes] = []
    at, size = 0, 0
    while data.startswith(heads, at):
        member, next_ = inflater(), at
        own: list[bytes] = []
        try:
            while not member.eof and next_ < len(data):
                piece = data[next_ : next_ + _PIECE]
                own.append(member.decompress(piece, max_layer + 1 - size))
                size += len(own[-1])
                if size > max_layer:
                    return None
                next_ += len(piece) - len(member.unused_data)
        except _BROKEN:
            if not at:
                return None
            break
        parts += own
        at = next_
        while data.startswith(b"\0", at):
            at += 1
    made = b"".join([*parts, data[at:]])
    return made if len(made) <= max_layer else None


def redact(text: str, spans: list[Span], by: str = REDACTED) -> str:
    """The text with each span, or run of overlapping spans, replaced."""
    parts, at, open_to = [], 0, 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= open_to or not parts:
            parts += [text[max(at, open_to) : a], by]
        open_to = max(open_to, b)
        at = open_to
    return "".join([*parts, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def _over(docs: DataFrame, id_col: str, text_col: str, make: Callable[[str], tuple], fields: list[tuple[str, str]]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {"long": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(text or "") for text in batch.column(1).to_pylist()]
            columns = [pa.array([row[i] for row in made], kinds[kind]) for i, (_, kind) in enumerate(fields)]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", *(name for name, _ in fields)])

    own = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    return rows.mapInArrow(run, ", ".join([own, *(f"{name} {kind}" for name, kind in fields)]))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """Per row: doc_id, the counts n_assign, n_access and n_hex and the digest base_sha256 of the secrets that
    the text shows as it stands, and spans, those of all layers."""

    def make(text: str) -> tuple:
        base, spans = find(text, max_layer)
        counts = (sum(s[0] == kind for s in base) for kind in KINDS)
        return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))

    counts = [(f"n_{kind}", "long") for kind in KINDS]
    return _over(docs, id_col, text_col, make, [*counts, ("base_sha256", "string"), ("spans", "string")])


def redacted(docs: DataFrame, text_col: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """The documents with their columns, secrets of all layers replaced in the text; a null text stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redact(t, find(t, max_layer)[1]))

    return docs.withColumn(text_col, clean(F.col(text_col)))
