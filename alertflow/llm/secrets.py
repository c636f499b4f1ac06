"""Secret scan with a recursive decoding worklist.

Every whole text is scanned, then its encoded layers: URL escapes, Unicode
escapes, base64 (also wrapped over lines) and compressed bytes, nested in any order.
Bytes that are not UTF-8 are read as Latin-1, and as UTF-16 where they look like it;
compressed members are looked for anywhere in the bytes. A decoded layer that
was not seen before in the document joins the worklist and is scanned like the
text, until nothing new decodes. Findings in a layer are mapped back to the span of
the text they were decoded from. A layer counts as seen when the same text came from
the same place, which closes cycles; the same secret at another place is found there.

A document is one row of a map job: nothing is shuffled, no group is formed.

Defined results: null text counts as empty (no spans); texts of any length are
scanned whole; a layer that would decompress beyond ``MAX_LAYER`` bytes is reported
as a span of kind ``oversize`` and not expanded, so it is never passed over in
silence; repeated rows are scanned each; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "oversize")
MAX_LAYER = 64 << 20  # bytes a compressed layer may expand to

# The base patterns and the shortest match that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters and more of the greedy run
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_MIN = 12
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_RUN = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# a match starts only where an unbroken run does and gives no character of a run back, so the search is linear
BASE64_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]{16,}+)*"
                            r"[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++={0,2}")
_BREAK = re.compile(r"[ \t\r\n]+")
# escapes of single bytes as in Python, C and JSON strings
BYTE_RUN = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[abfnrtv0'"\\])+""")
BYTE_ONE = re.compile(r"""\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\([abfnrtv0'"\\])""")
_SHORT = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0"))
# starts of gzip, zlib, bzip2 and xz members
MEMBER = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
_WIDE = re.compile(rb"(?:[\x09-\x7e]\x00){8}")  # ASCII in UTF-16
_BYTES = re.compile(r"[\x00-\xff]{8,}")
CHUNK = 1 << 16


class Layer:
    """A decoded text and, piece by piece, where it came from in the document."""

    def __init__(self, text: str, at: list[int], span: list[tuple[int, int, bool]]):
        self.text, self.at, self.span = text, at, span  # pieces: start here, (start, end, one-to-one) in the document

    def to_document(self, start: int, end: int) -> tuple[int, int]:
        return self._edge(start)[0], self._edge(end - 1)[1]

    def digest(self) -> bytes:
        """Of the text and of where it came from."""
        h = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16)
        h.update(repr((self.at, self.span)).encode())
        return h.digest()

    def _edge(self, pos: int) -> tuple[int, int]:
        i = bisect_right(self.at, pos) - 1
        s, e, plain = self.span[i]
        if plain:
            s += pos - self.at[i]
            return s, s + 1
        return s, e


def scan(text: str) -> list[tuple[int, int, int]]:
    """Base findings of one layer: (start, kind, end), by start and kind."""
    out = []
    if _KEYWORD.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def find_secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans of the text, all spans with those of decoded layers mapped back)."""
    base = scan(text)
    found = set(base)
    work = [Layer(text, [0], [(0, len(text), True)])]
    seen = {work[0].digest()}
    while work:
        layer = work.pop()
        for start, end, new in _decoded(layer):
            if new is None:
                found.add((start, KINDS.index("oversize"), end))
                continue
            key = new.digest()
            if key in seen:
                continue
            seen.add(key)
            for s, k, e in scan(new.text):
                a, b = new.to_document(s, e)
                found.add((a, k, b))
            work.append(new)
    return base, sorted(found)


def _decoded(layer: Layer):
    """(start, end, layer or None for an oversize one) of everything one step decodes."""
    text = layer.text
    if "%" in text and URL_RUN.search(text):
        yield 0, len(text), _rewritten(layer, URL_RUN, _url_parts)
    if "\\" in text and UNICODE_RUN.search(text):
        yield 0, len(text), _rewritten(layer, UNICODE_RUN, _unicode_parts)
    # members of compressed bytes in the characters as they are, and under escapes of single bytes
    yield from _unpacked(layer)
    if "%" in text:
        yield from _unpacked(_rewritten(layer, URL_RUN, _url_bytes))
    if "\\" in text:
        yield from _unpacked(_rewritten(layer, BYTE_RUN, _escaped_bytes))
    for pattern in (BASE64_RUN, BASE64_WRAPPED):
        for m in pattern.finditer(text):
            s, e = layer.to_document(m.start(), m.end())
            for value in _base64_texts(_BREAK.sub("", m.group())):
                yield s, e, None if value is None else Layer(value, [0], [(s, e, False)])


def _unpacked(view: Layer):
    """What the compressed members among the characters below 256 of a layer hold."""
    for m in _BYTES.finditer(view.text):
        for start, end, data in _members(m.group().encode("latin-1")):
            s, e = view.to_document(m.start() + start, m.start() + end)
            for value in [None] if data is None else _texts(data):
                yield s, e, None if value is None else Layer(value, [0], [(s, e, False)])


def _rewritten(layer: Layer, run: re.Pattern, parts) -> Layer:
    """The layer with every escape run decoded in place."""
    out, at, span, size = [], [], [], 0

    def plain(a: int, b: int) -> None:
        nonlocal size
        while a < b:  # piece by piece, as the layer itself may be of several
            i = bisect_right(layer.at, a) - 1
            stop = min(b, layer.at[i + 1]) if i + 1 < len(layer.at) else b
            s, e, one = layer.span[i]
            new = (s + a - layer.at[i], s + stop - layer.at[i], True) if one else (s, e, False)
            if one and span and span[-1][2] and span[-1][1] == new[0]:
                span[-1] = (span[-1][0], new[1], True)  # goes on where the last piece ends
            else:
                at.append(size)
                span.append(new)
            out.append(layer.text[a:stop])
            size += stop - a
            a = stop

    last = 0
    for m in run.finditer(layer.text):
        plain(last, m.start())
        for a, b, value in parts(m.group()):
            at.append(size)
            span.append((*layer.to_document(m.start() + a, m.start() + b), False))
            out.append(value)
            size += len(value)
        last = m.end()
    plain(last, len(layer.text))
    return Layer("".join(out), at, span)


def _url_parts(run: str):
    """One part for each character of a run of percent escapes."""
    data, i = bytes.fromhex(run.replace("%", "")), 0
    while i < len(data):
        n = 1
        for n in (1, 2, 3, 4):
            try:
                value = data[i:i + n].decode("utf-8")
                break
            except UnicodeDecodeError:
                continue
        else:
            n, value = 1, chr(data[i])
        yield 3 * i, 3 * (i + len(data[i:i + n])), value
        i += n


def _url_bytes(run: str):
    """One part for each byte of a run of percent escapes."""
    for i, c in enumerate(bytes.fromhex(run.replace("%", ""))):
        yield 3 * i, 3 * i + 3, chr(c)


def _escaped_bytes(run: str):
    """One part for each byte of a run of backslash escapes."""
    for m in BYTE_ONE.finditer(run):
        value = m.group(1) or m.group(2)
        yield m.start(), m.end(), chr(int(value, 16)) if value else _SHORT.get(m.group(3), m.group(3))


def _unicode_parts(run: str):
    """One part for each character of a run of backslash escapes; surrogate pairs join."""
    units = [(m.start(), m.end(), int(m.group(1) or m.group(2), 16)) for m in UNICODE_ONE.finditer(run)]
    i = 0
    while i < len(units):
        a, b, c = units[i]
        if 0xD800 <= c < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][2] < 0xE000:
            c, b, i = 0x10000 + ((c - 0xD800) << 10) + units[i + 1][2] - 0xDC00, units[i + 1][1], i + 1
        yield a, b, chr(c) if not 0xD800 <= c < 0xE000 else "�"
        i += 1


def _base64_texts(run: str):
    """Texts a base64 run holds, directly or compressed; None for an oversize one.

    A run may carry a prefix that is not base64 of the value (a path, a word), so
    all four alignments of its start are tried; noise decodes to no readable text.
    """
    body = run.rstrip("=").translate(_URLSAFE)
    for skip in range(min(4, len(body))):
        part = body[skip:]
        part = part[:len(part) - 1] if len(part) % 4 == 1 else part
        try:
            data = binascii.a2b_base64(part + "=" * (-len(part) % 4))
        except binascii.Error:
            continue
        yield from _texts(data)
        for _, _, out in _members(data):
            if out is None:
                yield None
            else:
                yield from _texts(out)


_URLSAFE = str.maketrans("-_", "+/")


def _members(data: bytes):
    """(start, end, bytes or None beyond ``MAX_LAYER``) of every compressed member anywhere in ``data``."""
    at = 0
    while m := MEMBER.search(data, at):
        head, at = m.group(), m.start() + 1
        tool = (zlib.decompressobj(31) if head[0] == 0x1F else zlib.decompressobj() if head[0] == 0x78
                else bz2.BZ2Decompressor() if head[:1] == b"B" else lzma.LZMADecompressor())
        out, size, pos = [], 0, m.start()
        try:
            while pos < len(data) and not tool.eof and size <= MAX_LAYER:
                part = data[pos:pos + CHUNK]
                pos += len(part)
                while True:
                    piece = tool.decompress(part, MAX_LAYER + 1 - size)
                    out.append(piece)
                    size += len(piece)
                    part = getattr(tool, "unconsumed_tail", b"")
                    if tool.eof or size > MAX_LAYER or not part:
                        break
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            pass  # what came before the damage counts
        if size > MAX_LAYER:
            yield m.start(), len(data), None
            at = max(at, pos)
        elif size:
            end = pos - len(tool.unused_data) if tool.eof else pos
            yield m.start(), end, b"".join(out)
            at = max(at, end) if tool.eof else at


def _texts(data: bytes):
    """The texts bytes may stand for: UTF-8, else Latin-1; UTF-16 besides where ASCII stands in it."""
    if len(data) < 8:
        return
    try:
        yield data.decode("utf-8")
    except UnicodeDecodeError:
        yield data.decode("latin-1")
    if _WIDE.search(data):
        for name in ("utf-16-le", "utf-16-be"):
            for skip in (0, 1):
                yield data[skip:].decode(name, "replace")


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of (kind, start, end) in code points, end exclusive."""
    def spans(batches):
        for batch in batches:
            base, every = [], []
            for text in batch.column("text").to_pylist():
                b, a = find_secrets(text)
                base.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in b])
                every.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in a])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(base, kind), pa.array(every, kind)],
                                             ["doc_id", "base", "spans"])

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = "array<struct<kind:string,start:bigint,end:bigint>>"
    return rows.mapInArrow(spans, f"doc_id long, base {one}, spans {one}")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    def text(col):
        return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(text("base").cast("binary"), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))
