"""Secrets in texts, also in texts that are encoded several times over.

A worklist starts with the whole text. Each layer is scanned, then its encoded stretches
(percent escapes, Unicode and hex escapes, base64, gzip or zlib bytes) are decoded into new
layers, until nothing new turns up; a layer seen before is not entered again, which ends
cycles. Every character of a layer knows its stretch of the original text, so a find at any
depth is reported as a span of the text itself.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, new_name

# The base patterns, their least lengths and their order.
KINDS = ("assign", "access", "hex")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(word) for word in _KEYWORDS)
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is found whole
MIN_VALUE, MIN_ACCESS = 6, 20

# Further kinds, which the method adds.
EXTRA = (
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("github", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    ("private_key", re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")),
)
EXTRA_SIGNS = ("eyJ", "gh", "xox", "-----BEGIN ")
ORDER = {kind: place for place, kind in enumerate((*KINDS, *(kind for kind, _ in EXTRA)))}

PIECE = 1 << 20  # bytes or characters of a decompressed layer that are held at a time
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+")
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2})|u\{([0-9A-Fa-f]{1,6})\})")
_REFERENCE = re.compile(r"&#(?:([0-9]{1,7})|[xX]([0-9A-Fa-f]{1,6}));")
_REFERENCES = re.compile(r"(?:&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});)+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_HEX_BYTES = re.compile(r"[0-9a-fA-F]{24,}")
_ASCII = rb"[\t\n\r\x20-\x7e]"
_READABLE = re.compile(rb"%b{12,}" % _ASCII)  # the shortest secret has 12 characters
_WIDE = re.compile(rb"(?:\x00?%b\x00){11,}%b?" % (_ASCII, _ASCII))  # UTF-16 in either byte order
_BREAK = r"[ \t]*\r?\n[ \t]*"
_GOES_ON = re.compile(_BREAK + r"[A-Za-z0-9+/_-]")
_WRAPPED = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}(?:{_BREAK}[A-Za-z0-9+/_-]+)+={{0,2}}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
# Places that no pattern reaches across, before or after the escapes round them are decoded.
_SAFE_CUT = re.compile(r"(?<=[g-z.]) (?=[A-Za-z0-9])|[,;()<>{}\[\]!?@#$&*|~^]|[^\x00-\x7F]| [^ \n]{0,15}\r?\n")

Span = tuple[int, int, str]


@dataclass
class Layer:
    """A decoded text; ``starts``/``ends`` give each character's stretch of the original.

    Without them the layer is the original, or lies in ``span`` of it as a whole. A long
    decompressed layer has no text but the bytes and how often they are ``packed``.
    """

    text: str
    starts: list[int] | None = None
    ends: list[int] | None = None
    span: tuple[int, int] | None = None
    packed: tuple[bytes, int] | None = None

    def pieces(self) -> Iterator[Layer]:
        """The layer, a long one in pieces that no find or encoded stretch crosses."""
        if self.packed is None:
            yield self
        else:
            for text in _unpacked(*self.packed):
                yield Layer(text, span=self.span)

    def mark(self) -> bytes:
        content = self.text.encode("utf-8", "surrogatepass")
        if self.packed:
            content = self.packed[0] + b" packed %d" % self.packed[1]
        return hashlib.sha256(content + repr(self.span).encode()).digest()

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.span:
            return self.span
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]


def base_spans(text: str) -> list[Span]:
    """Finds of the three base kinds."""
    found = []
    for match in ASSIGN.finditer(text):
        if match.end(2) - match.start(2) >= MIN_VALUE:
            found.append((match.start(), match.end(), "assign"))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= MIN_ACCESS:
                found.append((match.start(), match.end(), "access"))
    found += [(match.start(), match.end(), "hex") for match in HEX.finditer(text)]
    return found


def extra_spans(text: str) -> list[Span]:
    if not any(sign in text for sign in EXTRA_SIGNS):
        return []
    return [(m.start(), m.end(), kind) for kind, pattern in EXTRA for m in pattern.finditer(text)]


def _compression(head: bytes) -> int | None:
    """The ``wbits`` of a gzip or zlib stream that begins so."""
    if head[:2] == b"\x1f\x8b":
        return 31
    return 15 if head[:1] == b"\x78" and len(head) > 2 and (head[0] * 256 + head[1]) % 31 == 0 else None


def _decompressed(source: Iterator[bytes]) -> Iterator[bytes]:
    """All members of a compressed stream, ``PIECE`` bytes at most at a time.

    It ends where the stream cannot be read; a stream that breaks off gives what there is.
    """
    reader, data = None, b""
    for more in source:
        data += more
        while data:
            if reader is None:
                wbits = _compression(data)
                if wbits is None and len(data) > 2:
                    return
                if wbits is None:
                    break
                reader = zlib.decompressobj(wbits)
            full = True
            while full and not reader.eof:
                try:
                    out = reader.decompress(data, PIECE)
                except zlib.error:
                    return
                data, full = reader.unconsumed_tail, len(out) == PIECE
                if out:
                    yield out
            if reader.eof:
                data, reader = reader.unused_data, None


def _levels(data: bytes, times: int) -> Iterator[bytes]:
    """The bytes, decompressed so many times."""
    source = iter([data])
    for _ in range(times):
        source = _decompressed(source)
    return source


def _unpacked(data: bytes, times: int) -> Iterator[str]:
    """The decompressed text, cut at safe places; without one a piece grows until there is one."""
    decoder, text, tried = codecs.getincrementaldecoder("utf-8")("replace"), "", 0
    for part in _levels(data, times):
        text += decoder.decode(part)
        if len(text) < PIECE:
            continue
        for begin in (max(tried, len(text) - 4096), max(0, tried - 32)):
            cuts = [m.end() for m in _SAFE_CUT.finditer(text, begin)]
            if cuts:
                yield text[: cuts[-1]]
                text = text[cuts[-1] :]
                break
        tried = 0 if cuts else len(text)
    if text:
        yield text


def _printable(text: str) -> int:
    return len(text) if text.isprintable() else sum(c.isprintable() or c in "\n\r\t" for c in text)


def _texts(data: bytes) -> Iterator[str]:
    """Bytes as text, or the readable stretches among them, of one or two bytes a character.

    All that a pattern or an encoding can use is ASCII, so these stretches hold every secret.
    """
    try:
        text = data.decode()
        if text and _printable(text) >= 0.95 * len(text):
            yield text
            return
    except UnicodeDecodeError:
        pass
    for stretches in (_READABLE.findall(data), [w.replace(b"\0", b"") for w in _WIDE.findall(data)]):
        if stretches:
            yield b"\0".join(stretches).decode("ascii")


def _byte_layers(data: bytes, span: tuple[int, int]) -> Iterator[Layer]:
    """Decoded bytes as layers: the text in them, or in what they decompress to any number of times.

    In decompressed bytes what is not UTF-8 counts as the replacement character.
    """
    for text in _texts(data):
        yield Layer(text, span=span)
    if _compression(data) is None:
        return
    times, seen = 0, set()
    while True:
        digest, head = hashlib.sha256(), b""
        decoder, n_chars, texts = codecs.getincrementaldecoder("utf-8")("replace"), 0, []
        for part in _levels(data, times):
            digest.update(part)
            head += part[:3] if len(head) < 3 else b""
            text = decoder.decode(part)
            n_chars += len(text)
            if n_chars <= PIECE:
                texts.append(text)
        if digest.digest() in seen:
            return  # bytes that decompress to themselves
        seen.add(digest.digest())
        if times and n_chars:
            whole = n_chars <= PIECE
            yield Layer("".join(texts), span=span) if whole else Layer("", span=span, packed=(data, times))
        if _compression(head) is None:
            return
        times += 1


def _unescape(text: str) -> str:
    def one(match: re.Match) -> str:
        code = int(match[1] or match[2] or match[3] or match[4], 16)
        return chr(code) if code < 0x110000 else match[0]

    whole = _ESCAPE.sub(one, text)
    return whole.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _escaped_layer(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with all stretches of ``pattern`` decoded in place."""
    parts: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    last = 0
    changed = False

    def copy(a: int, b: int) -> None:
        parts.append(layer.text[a:b])
        if layer.span:
            return
        if layer.starts is None:
            starts.extend(range(a, b))
            ends.extend(range(a + 1, b + 1))
        else:
            starts.extend(layer.starts[a:b])
            ends.extend(layer.ends[a:b])

    for match in pattern.finditer(layer.text):
        decoded = decode(match[0])
        if decoded is None or decoded == match[0]:
            continue
        changed = True
        copy(last, match.start())
        parts.append(decoded)
        if not layer.span:
            a, b = layer.place(match.start(), match.end())
            starts.extend([a] * len(decoded))
            ends.extend([b] * len(decoded))
        last = match.end()
    if not changed:
        return None
    copy(last, len(layer.text))
    text = "".join(parts)
    return Layer(text, span=layer.span) if layer.span else Layer(text, starts, ends)


def _percent(stretch: str) -> str:
    return binascii.unhexlify(stretch.replace("%", "")).decode(errors="replace")


def _unreference(stretch: str) -> str:
    def one(match: re.Match) -> str:
        code = int(match[1]) if match[1] else int(match[2], 16)
        return chr(code) if code < 0x110000 else match[0]

    return _REFERENCE.sub(one, stretch)


def _hex_bytes(stretch: str) -> bytes:
    return bytes.fromhex(stretch[: len(stretch) // 2 * 2])


def _base64_bytes(stretch: str) -> bytes:
    body = stretch.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return b""


def _wrapped_layers(layer: Layer, begin: int, end: int) -> Iterator[Layer]:
    """Layers of the bodies in a run of lines: lines of one width, and a shorter last one.

    The line above may be the body's beginning behind other text, and the line below may be
    no part of it, so both are left out where the body cannot be read with them.
    """
    lines = [m.span() for m in _LINE.finditer(layer.text, begin, end)]
    widths = [b - a for a, b in lines]
    first = 0
    while first < len(lines):
        last = first
        while last + 1 < len(lines) and widths[last + 1] == widths[first]:
            last += 1
        firsts = [0, 1] if first == 1 else [first]
        lasts = [last + 1, last] if last + 1 < len(lines) and widths[last + 1] < widths[first] else [last]
        tries = [(a, b) for a in firsts for b in lasts if a < b and widths[first] >= 16]
        for a, b in tries:
            body = "".join(layer.text[slice(*line)] for line in lines[a : b + 1])
            span = layer.place(lines[a][0], end if b + 1 == len(lines) else lines[b][1])
            found = list(_byte_layers(_base64_bytes(body), span))
            if _HEX_BYTES.fullmatch(body):
                found += _byte_layers(_hex_bytes(body), span)
            yield from found
            if found:
                break
        first = last + 1


def inner_layers(layer: Layer) -> list[Layer]:
    """What the encoded stretches of a layer decode to."""
    text, found = layer.text, []
    if "%" in text:
        found.append(_escaped_layer(layer, _PERCENT, _percent))
    if "\\" in text:
        found.append(_escaped_layer(layer, _ESCAPES, _unescape))
    if "&#" in text:
        found.append(_escaped_layer(layer, _REFERENCES, _unreference))
    wrapped_to = 0
    # other characters of the alphabet may stand right before the body, so each alignment is read
    for pattern, decode, width in ((_BASE64, _base64_bytes, 4), (_HEX_BYTES, _hex_bytes, 2)):
        for match in pattern.finditer(text):
            place = layer.place(match.start(), match.end())
            for skipped in range(width):
                found += _byte_layers(decode(match[0][skipped:]), place)
            if match.start() >= wrapped_to and _GOES_ON.match(text, match.end()):
                run = _WRAPPED.match(text, match.start())
                if run:
                    found += _wrapped_layers(layer, *run.span())
                    wrapped_to = run.end()
    return [inner for inner in found if inner is not None]


def find_secrets(text: str | None) -> tuple[list[Span], list[tuple[int, int, str, int, str]]]:
    """The base spans, and all finds as (start, end, kind, depth, secret).

    Finds of the same kind at the same span are reported once, at the least depth.
    """
    if not text:
        return [], []
    base = sorted(base_spans(text), key=lambda s: (s[0], ORDER[s[2]]))
    finds = {span: (0, text[span[0] : span[1]]) for span in [*base, *extra_spans(text)]}
    work = deque([(Layer(text), 0)])
    seen = {Layer(text).mark()}
    while work:
        layer, depth = work.popleft()
        for inner in (inner for piece in layer.pieces() for inner in inner_layers(piece)):
            mark = inner.mark()
            if mark in seen:
                continue
            seen.add(mark)
            for piece in inner.pieces():
                for start, end, kind in (*base_spans(piece.text), *extra_spans(piece.text)):
                    place = (*piece.place(start, end), kind)
                    finds.setdefault(place, (depth + 1, piece.text[start:end]))
            work.append((inner, depth + 1))
    ordered = sorted(finds, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    return base, [(*span, *finds[span]) for span in ordered]


def digest_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, *_ in spans)


FOUND = "array<struct<start:int,end:int,kind:string,depth:int,secret:string>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``base`` (the base kinds' spans as text) and ``found`` (every find).

    Spans are in code points, the end exclusive. Null and empty texts have none. One row for
    each input row, repeated rows and null ids included.
    """

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            bases, founds = [], []
            for text in column.to_pylist():
                base, finds = find_secrets(text)
                bases.append(digest_text(base))
                founds.append(
                    [dict(zip(("start", "end", "kind", "depth", "secret"), f, strict=True)) for f in finds]
                )
            kind = pa.list_(
                pa.struct(
                    [
                        ("start", pa.int32()),
                        ("end", pa.int32()),
                        ("kind", pa.string()),
                        ("depth", pa.int32()),
                        ("secret", pa.string()),
                    ]
                )
            )
            return [pa.array(bases, pa.string()), pa.array(founds, kind)]

        return make

    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = map_texts(named, "_text", f"base string, found {FOUND}", start, ["_id"])
    return found.select(F.col("_id").alias(id_col), "base", "found")


def mask_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every find of the text replaced by ``mark``; other columns as they are.

    Overlapping finds are replaced together. Null texts stay null.
    """
    masked = new_name(docs.columns, "_masked")

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            return [pa.array([mask(text, mark) for text in column.to_pylist()], pa.string())]

        return make

    whole = map_texts(docs, text_col, f"`{masked}` string", start, docs.columns)
    return whole.withColumn(text_col, F.col(masked)).drop(masked)


def mask(text: str | None, mark: str = "[secret]") -> str | None:
    if not text:
        return text
    parts, last = [], 0
    for start, end, *_ in find_secrets(text)[1]:
        if start >= last:
            parts += [text[last:start], mark]
        last = max(last, end)
    return "".join([*parts, text[last:]])
