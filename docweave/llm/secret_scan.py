"""Secret scans through nested encodings: a worklist of decoded layers, each scanned and mapped back to the text."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.llm.common import with_text_columns

# What counts as a secret. Letters of the assignment names match in either case.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

# Kinds in the order of the contract.
KINDS = ("assign", "access", "hex")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
_ONE_ESCAPE = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});|\\u\{([0-9A-Fa-f]{1,6})\}"
)
# An escape that stands for a character that begins escapes: %25, %5C, %26 and the like.
_OPENER = re.compile(
    r"%(?:25|5[Cc]|26)|\\(?:u00|x|U000000)(?:25|5[Cc]|26)|\\u\{0{0,4}(?:25|5[Cc]|26)\}|&#0{0,5}(?:37|92|38);|&#[xX]0{0,4}(?:25|5[Cc]|26);"
)
_LONGEST = 11
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_ALPHABETS = tuple(re.compile(p) for p in (r"[A-Za-z0-9+/]{16,}={0,2}", r"[A-Za-z0-9_-]{16,}={0,2}"))
# Pieces on following lines, as MIME and PEM break them.
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
LEAST_TOKEN = 16

# Bytes that compressed layers of one text may inflate to; what is beyond isn't unwrapped and is reported as ``truncated``.
LAYER_BYTES = 64 << 20


@dataclass(frozen=True)
class Layer:
    """A decoded text. Character ``i`` of it comes from ``[starts[p], ends[p])`` of the original, ``p`` the piece that
    holds ``i``; inside a piece that maps one to one the offset is added."""

    text: str
    firsts: list[int]
    starts: list[int]
    ends: list[int]
    plain: list[bool]

    def start(self, at: int) -> int:
        p = bisect_right(self.firsts, at) - 1
        return self.starts[p] + (at - self.firsts[p] if self.plain[p] else 0)

    def end(self, at: int) -> int:
        """Original end of the character before ``at``."""
        p = bisect_right(self.firsts, at - 1) - 1
        return self.starts[p] + (at - self.firsts[p]) if self.plain[p] else self.ends[p]


def _whole(text: str, start: int, end: int) -> Layer:
    return Layer(text, [0], [start], [end], [False])


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets in one layer, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _unescape(run: str) -> list[tuple[str, int]]:
    """Characters of a run of escapes with the length of each escape; surrogate pairs are joined."""
    out: list[tuple[str, int]] = []
    for m in _ONE_ESCAPE.finditer(run):
        code = int(m[4]) if m[4] else int(m[1] or m[2] or m[3] or m[5] or m[6], 16)
        if 0xDC00 <= code < 0xE000 and out and "\ud800" <= out[-1][0] < "\udc00":
            high, length = out.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + (code - 0xDC00)
            out.append((chr(code), length + len(m[0])))
        else:
            out.append((chr(code) if code < 0x110000 else m[0], len(m[0])))
    return [("\ufffd" if "\ud800" <= c < "\ue000" else c, n) for c, n in out]


def _unpercent(run: str) -> list[tuple[str, int]]:
    raw = bytes.fromhex(run.replace("%", ""))
    text = raw.decode("utf-8", "replace")
    sizes = [3 * len(c.encode()) if c != "\ufffd" else 3 for c in text]
    if sum(sizes) != len(run):  # bytes that aren't UTF-8
        return [(chr(b), 3) for b in raw]
    return list(zip(text, sizes))


def _chain(text: str, char: str, at: int) -> tuple[str, int]:
    """``char``, decoded from what stands before ``at``, and the characters behind it may be an escape that opens the next
    one, as in ``%252525``: the last opener of such a chain and the place behind it. Of the texts between, every part without
    the opener stands in ``text`` as it is, so nothing is lost by not scanning them one by one."""
    while char in "%\\&" and (m := _OPENER.match(char + text[at : at + _LONGEST])):
        at += len(m[0]) - 1
        char = _unpercent(m[0])[0][0] if char == "%" else _unescape(m[0])[0][0]
    return char, at


def _rewritten(layer: Layer, pattern: re.Pattern, decode: Callable[[str], list[tuple[str, int]]]) -> Layer | None:
    """The layer with every escape run decoded; None when it has none."""
    parts, firsts, starts, ends, plain = [], [], [], [], []
    size = done = 0

    def add(text: str, begin: int, end: int, same: bool) -> None:
        nonlocal size
        if text:
            firsts.append(size)
            starts.append(begin)
            ends.append(end)
            plain.append(same)
            parts.append(text)
            size += len(text)

    def copy(low: int, high: int) -> None:
        while low < high:  # pieces of the layer keep their own mapping
            p = bisect_right(layer.firsts, low) - 1
            stop = min(high, layer.firsts[p + 1] if p + 1 < len(layer.firsts) else high)
            add(layer.text[low:stop], layer.start(low), layer.end(stop), layer.plain[p])
            low = stop

    while m := pattern.search(layer.text, done):
        copy(done, m.start())
        at = m.start()
        chars = decode(m[0])
        for char, length in chars[:-1]:
            add(char, layer.start(at), layer.end(at + length), False)
            at += length
        char, done = _chain(layer.text, chars[-1][0], m.end())
        add(char, layer.start(at), layer.end(done), False)
    if not done:
        return None
    copy(done, len(layer.text))
    return Layer("".join(parts), firsts, starts, ends, plain)


def _reader(raw: bytes):
    """What opens compressed bytes, told by their first bytes; None for others."""
    if raw[:2] == b"\x1f\x8b" or (len(raw) > 1 and raw[0] & 15 == 8 and raw[0] < 128 and (raw[0] << 8 | raw[1]) % 31 == 0):
        return zlib.decompressobj(47)  # any window
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if raw[:6] == b"\xfd7zXZ\0" else None


def _inflated(raw: bytes, room: int) -> tuple[bytes, int, bool]:
    """Bytes after all compressed layers (zlib, gzip, bzip2, xz, with all members) are opened, how many bytes that gave in sum, and
    whether the room was too small. What isn't compressed comes back as it is."""
    spent, met = 0, set()
    while _reader(raw) is not None:
        key = hashlib.sha256(raw).digest()
        if key in met:  # a stream that holds itself
            break
        met.add(key)
        parts: list[bytes] = []
        rest = raw
        while rest and (reader := _reader(rest)) is not None:
            if spent >= room:
                return b"", spent, True
            try:
                part = reader.decompress(rest, room - spent)
            except (zlib.error, lzma.LZMAError, OSError, EOFError):
                break
            parts.append(part)
            spent += len(part)
            if getattr(reader, "unconsumed_tail", b"") or not (reader.eof or getattr(reader, "needs_input", True)):
                return b"", spent, True
            rest = reader.unused_data.lstrip(b"\0") if reader.eof else b""
        if not parts:
            break
        raw = b"".join(parts)
    return raw, spent, False


def _deflated(raw: bytes, room: int) -> tuple[bytes, int, bool]:
    """Like ``_inflated`` for a deflate stream without a header, which must end where ``raw`` ends; else no bytes."""
    reader = zlib.decompressobj(-15)
    try:
        part = reader.decompress(raw, room)
    except zlib.error:
        return b"", 0, False
    # More output than the room holds: it can't be told whether the stream would end well.
    if reader.unconsumed_tail:
        return b"", len(part), True
    if not part or not reader.eof or reader.unused_data.strip(b"\0"):
        return b"", 0, False
    opened, spent, over = _inflated(part, max(1, room - len(part)))
    return opened, len(part) + spent, over


def _wide(raw: bytes) -> Iterator[str]:
    """Texts of bytes that may be UTF-16 or UTF-32, of which ASCII letters have bytes of zero."""
    if b"\0" in raw:
        for name in ("utf-16-le", "utf-16-be"):
            yield raw.decode(name, "replace")
    if b"\0\0\0" in raw:
        for name in ("utf-32-le", "utf-32-be"):
            yield raw.decode(name, "replace")


def _tokens(text: str) -> list[tuple[int, int]]:
    """Spans that may be base64, longer ones first: runs of both alphabets, of one, and runs broken by single line ends.

    Broken runs start and end where the width of the lines says so (lines of one width, with or without the one before
    and the one after), or at all lines; one line has ``LEAST_TOKEN`` characters.
    """
    spans = {m.span() for pattern in (_BASE64, *_ALPHABETS) for m in pattern.finditer(text)}
    for m in _LINES.finditer(text):
        pieces = [p.span() for p in _PIECE.finditer(text, m.start(), m.end())]
        widths = [b - a for a, b in pieces]
        if max(widths) < LEAST_TOKEN:
            continue
        spans.add(m.span())
        first = 0
        while first < len(pieces):
            last = first
            while last + 1 < len(pieces) and widths[last + 1] == widths[first]:
                last += 1
            if widths[first] >= LEAST_TOKEN:
                for a in {max(first - 1, 0), first}:
                    for b in {last, min(last + 1, len(pieces) - 1)}:
                        spans.add((pieces[a][0], m.end() if b == len(pieces) - 1 else pieces[b][1]))
            first = last + 1
    return sorted(spans, key=lambda s: (s[0] - s[1], s[0]))


def _blobs(layer: Layer, room: int, met: dict[tuple, bool]) -> Iterator[tuple[Layer | None, int]]:
    """Layers inside base64 tokens, compressed or not, with what they inflate to; None for one beyond the room.

    Bytes that aren't UTF-8 (other character sets, archives) are read as one character each. A token inside one that
    gave clean text isn't read again, and neither is one that another layer held at the same place (``met``).
    """
    clean: list[tuple[int, int]] = []  # disjoint spans in order
    for begin, end in _tokens(layer.text):
        at = bisect_right(clean, (begin, len(layer.text)))
        if at and end <= clean[at - 1][1]:
            continue
        token = "".join(layer.text[begin:end].split()).rstrip("=")
        if len(token) % 4 == 1:
            continue
        try:
            raw = base64.b64decode(token.replace("-", "+").replace("_", "/") + "=" * (-len(token) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        key = (layer.start(begin), layer.end(end), hashlib.sha256(raw).digest())
        if key in met:
            if met[key] and not any(a < end and begin < b for a, b in clean[max(at - 1, 0) : at + 1]):
                clean.insert(at, (begin, end))
            continue
        met[key] = False
        opened, spent, over = _inflated(raw, room)
        if over:
            yield None, room
            continue
        bare = b""
        try:
            text = opened.decode("utf-8")
        except UnicodeDecodeError:
            text = opened.decode("latin-1")
            bare, more, over = _deflated(opened, max(1, room - spent))
            spent += more
            if over:
                yield None, room
        else:
            if all(c.isprintable() or c in "\t\n\r" for c in text) and not any(a < end and begin < b for a, b in clean[max(at - 1, 0) : at + 1]):
                clean.insert(at, (begin, end))
                met[key] = True
        for reading in (text, *_wide(opened), bare.decode("utf-8", "replace"), *_wide(bare)):
            if reading:
                yield _whole(reading, layer.start(begin), layer.end(end)), spent
                room, spent = max(1, room - spent), 0


def find_secrets(text: str | None, room: int = LAYER_BYTES) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], bool]:
    """(base spans, all spans, truncated) of a text, in code points of the text.

    Layers wait in a worklist. A layer is scanned, then unwrapped by every decoder that changes it; a decoded
    text that was seen before at the same place isn't queued again, which ends cycles. The list is empty at the
    fixpoint: nothing decodes to anything new.
    """
    if not text:
        return [], [], False
    base = scan(text)
    if "%" not in text and "\\" not in text and "&#" not in text and not _BASE64.search(text):
        return base, base, False
    found, truncated = set(base), False
    first = Layer(text, [0], [0], [len(text)], [True])
    queue, seen = [first], {(0, len(text), hashlib.sha256(text.encode("utf-8", "replace")).digest())}
    met: dict[tuple, bool] = {}
    while queue:
        layer = queue.pop()
        if layer is not first:
            for start, end, kind in scan(layer.text):
                found.add((layer.start(start), layer.end(end), kind))
        inner: list[tuple[Layer | None, int]] = []
        for pattern, decode in ((_PERCENT, _unpercent), (_ESCAPE, _unescape)):
            if (changed := _rewritten(layer, pattern, decode)) is not None:
                inner.append((changed, 0))  # shorter than its layer, so it takes no room
        inner += _blobs(layer, max(1, room), met)
        for below, size in inner:
            if below is None:
                truncated = True
                continue
            key = (below.starts[0], below.ends[-1], hashlib.sha256(below.text.encode("utf-8", "replace")).digest())
            if below.text and key not in seen:
                if size and room <= size:
                    truncated = True
                    continue
                room -= size
                seen.add(key)
                queue.append(below)
    return base, list(found), truncated


def joined(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``KINDS``, then end."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


FIELDS: dict[str, T.DataType] = {
    "n_assign": T.LongType(),
    "n_access": T.LongType(),
    "n_hex": T.LongType(),
    "base_spans": T.StringType(),
    "spans": T.StringType(),
    "truncated": T.BooleanType(),
}


def scan_secrets(docs: DataFrame, text: str = "text", room: int = LAYER_BYTES) -> DataFrame:
    """``docs`` with the number of base secrets per kind, ``base_spans``, ``spans`` (with those of decoded layers) and
    ``truncated`` (true where compressed layers of a text inflate to more than ``room`` bytes, so that deeper layers weren't read).

    One pass without a shuffle. A text is held by one task; inflated layers are bounded by ``room``, the others by the text. Null or empty text:
    no spans. Repeated rows: one result each. Empty table: no rows. Columns of ``docs`` with these names are replaced.
    """

    def make() -> Callable:
        def compute(texts: pa.Array) -> list[pa.Array]:
            rows = []
            for text in texts.to_pylist():
                base, spans, truncated = find_secrets(text, room)
                kinds = [k for _, _, k in base]
                rows.append((*(kinds.count(k) for k in KINDS), joined(base), joined(spans), truncated))
            columns = list(zip(*rows)) or [()] * len(FIELDS)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.bool_()]
            return [pa.array(c, k) for c, k in zip(columns, kinds)]

        return compute

    return with_text_columns(docs, text, FIELDS, make)
