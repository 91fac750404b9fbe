"""Secret scans through layers of encoding.

Three kinds are searched: `assign` (a name such as password or api_key, then = or :, then a value of 6
or more characters), `access` (AKIA and capitals or digits, 20 characters or more) and `hex` (24 or
more lower-case hexadecimal digits). A worklist starts with the text. A layer taken from it is
scanned, then what it holds encoded becomes further layers: the layer with its percent escapes
decoded, the layer with its Unicode escapes decoded, each stretch of text that a base64 run decodes to, and
the gzip, zlib, bzip2 or xz data that a run decodes to. Lines of base64 are also taken together as one run.
A run is decoded from each of its first four characters, so what stands before the encoded part does not
hide it, and packed data is found at any place of it. The list ends when nothing new is left to decode: one
set for the whole text has the layers that are done, by their characters and places, so a layer that is
reached on several ways, or again in a cycle, is scanned once.

Every layer knows the place of its characters in the text, hence a secret found at any depth gets its own,
in code points with the end exclusive: the encoded characters themselves, or the whole run where the data
is compressed. Layers are made one at a time and compressed data is unpacked in windows that overlap, so
memory stays bounded whatever its ratio; an encoded run goes whole into the next window, up to UNPACKED. A
longer one, or a secret longer than the overlap, may be cut there. Xz data whose dictionary needs more than
256 MB is not unpacked; its run is scanned as it stands.

Null and empty texts hold no secret. Spans found twice are given once.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = "op9_secrets"
KINDS = ("assign", "access", "hex")

# The patterns of the three kinds, and the least length of what they find. They are
# applied to UTF-8; `assign` to text with A-Z in lower case.
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(
    rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}")
#: Runs on lines that follow each other; every line after the first is all base64. Line ends may be escaped.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:(?:\r\n?|\n|\\r\\n|\\n)[\x20\t>]*+[A-Za-z0-9+/_-]++(?=[\x20\t]*+(?:[\r\n=\\\"'<)\]},;]|\Z)))+"
)
LINE_END = re.compile(r"(?:\r\n?|\n|\\r\\n|\\n)[\x20\t>]*")
#: Lower-case words and words with a capital are no base64 in practice and decode to no text.
WORD = re.compile(r"[A-Za-z]?[a-z]+\Z")
URL_SAFE = str.maketrans("-_", "+/")

#: Unpacked bytes scanned at once, and how much of a window is repeated in the next.
UNPACKED, OVERLAP = 4_000_000, 100_000

Span = tuple[str, int, int]


class Places:
    """Where each character of a layer lies in the text: `begins[i]` to `stops[i]`, or all in one span."""

    def __init__(self, begins, stops):
        self.begins, self.stops = begins, stops

    @classmethod
    def of_text(cls, text: str) -> Places:
        at = np.arange(len(text) + 1, dtype=np.int32)
        return cls(at[:-1], at[1:])

    def span(self, a: int, b: int) -> tuple[int, int]:
        if isinstance(self.begins, int):
            return self.begins, self.stops
        return int(self.begins[a]), int(self.stops[b - 1])

    def taken(self, first: np.ndarray, last: np.ndarray) -> Places:
        """Places of characters that come from those at `first` ... `last`."""
        if isinstance(self.begins, int):
            return self
        return Places(self.begins[first], self.stops[last])

    def mark(self) -> bytes:
        """Bytes that differ for different places."""
        if isinstance(self.begins, int):
            return b"%d:%d" % (self.begins, self.stops)
        return self.begins.tobytes() + self.stops.tobytes()


Layer = tuple[str, Places]


def _code_points(raw: bytes, text: str) -> Callable[[int], int]:
    """Maps a place in UTF-8 to a place in the text; counts once, when first asked."""
    if len(raw) == len(text):
        return lambda at: at
    held: list[np.ndarray] = []

    def place(at: int) -> int:
        if not held:
            starts = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
            held.append(np.concatenate([[0], np.cumsum(starts)]))
        return int(held[0][at])

    return place


def find(text: str) -> list[Span]:
    """The secrets of one layer as it stands."""
    raw = text.encode("utf-8", "replace")
    low = raw.lower()
    place = _code_points(raw, text)
    found = []
    if any(name in low for name in NAMES):
        for m in ASSIGN.finditer(low):
            if m.end(1) - m.start(1) >= LEAST_VALUE:
                found.append(("assign", place(m.start()), place(m.end())))
    if b"AKIA" in raw:
        for m in ACCESS.finditer(raw):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append(("access", place(m.start()), place(m.end())))
    for m in HEX.finditer(raw):
        found.append(("hex", place(m.start()), place(m.end())))
    return found


def _replaced(text: str, places: Places, pieces: list) -> Layer:
    """A layer with parts replaced; pieces: (start, end, new text, places of its characters)."""
    parts, starts, ends, upto = [], [], [], 0
    for start, end, new, begins, stops in pieces:
        parts += [text[upto:start], new]
        starts += [np.arange(upto, start), begins]
        ends += [np.arange(upto + 1, start + 1), stops]
        upto = end
    parts.append(text[upto:])
    starts.append(np.arange(upto, len(text)))
    ends.append(np.arange(upto + 1, len(text) + 1))
    return "".join(parts), places.taken(np.concatenate(starts), np.concatenate(ends) - 1)


def _percent(text: str, places: Places) -> Layer | None:
    if "%" not in text:
        return None
    pieces = []
    for m in PERCENT.finditer(text):
        data = bytes.fromhex(m[0].replace("%", ""))
        try:
            new = data.decode()
            sizes = np.array([len(c.encode()) for c in new])
        except UnicodeDecodeError:
            new, sizes = data.decode("latin-1"), np.ones(len(data), np.int64)
        stops = m.start() + 3 * np.cumsum(sizes)
        pieces.append((m.start(), m.end(), new, stops - 3 * sizes, stops))
    return _replaced(text, places, pieces) if pieces else None


def _escapes(text: str, places: Places) -> Layer | None:
    if "\\" not in text and "&#" not in text:
        return None
    pieces = []
    for m in ESCAPE.finditer(text):
        code = int(m[6]) if m[6] else int(next(g for g in m.groups() if g), 16)
        if code <= 0x10FFFF:
            new = "\ufffd" if 0xD800 <= code < 0xE000 else chr(code)
            pieces.append((m.start(), m.end(), new, [m.start()], [m.end()]))
    return _replaced(text, places, pieces) if pieces else None


def _unpacker(data: bytes):
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=256_000_000)
    return None


ALPHABET = np.zeros(256, bool)
ALPHABET[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=\r\n")] = True


def _kept(window: bytes) -> int:
    """Bytes of a window that the next one repeats: the overlap, or a longer run that may go on."""
    other = np.flatnonzero(~ALPHABET[np.frombuffer(window[-UNPACKED:], np.uint8)])
    run = min(len(window), UNPACKED) - (int(other[-1]) + 1 if len(other) else 0)
    return max(OVERLAP, run)


def _unpacked(data: bytes) -> Iterator[bytes]:
    """Windows of the unpacked data; damaged data yields what comes before the damage."""
    machine = _unpacker(data)
    if machine is None:
        return
    window = b""
    try:
        while not machine.eof:
            more = machine.decompress(data, UNPACKED)
            data = getattr(machine, "unconsumed_tail", b"")
            window += more
            if len(window) >= UNPACKED:
                yield window
                window = window[-_kept(window) :]
            if not more and not data:
                break
    except (zlib.error, OSError, EOFError, lzma.LZMAError):
        pass
    if window:
        yield window


#: How packed data begins, at any place of decoded bytes.
PACKED = re.compile(
    rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00", re.DOTALL
)
#: Valid UTF-8 without control characters, as long as the shortest secret.
READABLE = re.compile(
    rb"(?:[\t\n\r\x20-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"
    rb"|\xf4[\x80-\x8f][\x80-\xbf]{2}){11,}+"
)


def _encoded(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """Base64 runs, each with the place of its characters in the layer."""
    for m in BASE64.finditer(text):
        if not WORD.match(m[0]):
            yield m[0], np.arange(m.start(), m.end())
    for m in WRAPPED.finditer(text):
        parts, places, upto = [], [], m.start()
        for end in LINE_END.finditer(text, m.start(), m.end()):
            parts.append(text[upto : end.start()])
            places.append(np.arange(upto, end.start()))
            upto = end.end()
        parts.append(text[upto : m.end()])
        yield "".join(parts), np.concatenate([*places, np.arange(upto, m.end())])


def _runs(text: str, places: Places) -> Iterator[Layer]:
    """Layers out of the base64 runs of a layer."""
    for found, at in _encoded(text):
        found = found.translate(URL_SAFE)
        for first in range(4):
            run = found[first:]
            if len(run) % 4 == 1:
                run = run[:-1]
            data = base64.b64decode(run + "=" * (-len(run) % 4))
            size = len(run)

            def held(begins, ends, first=first, at=at, size=size) -> tuple[np.ndarray, np.ndarray]:
                """First and last character that hold the bytes begins ... ends."""
                last = np.minimum(size, -(-np.asarray(ends) * 4 // 3)) - 1
                return at[first + np.asarray(begins) * 4 // 3], at[first + last]

            packed = {m.start() for m in PACKED.finditer(data)} | ({0} if _unpacker(data) else set())
            for begin in sorted(packed):
                a, b = held(begin, len(data))
                whole = Places(*places.span(int(a), int(b) + 1))
                for window in _unpacked(data[begin:]):
                    yield window.decode("utf-8", "replace"), whole
            for m in READABLE.finditer(data):
                new = m[0].decode()
                ends = m.start() + _ends(m[0], new)
                yield new, places.taken(*held(ends[:-1], ends[1:]))


def _ends(data: bytes, text: str) -> np.ndarray:
    """Places in UTF-8 of the borders of a text's characters."""
    if len(data) == len(text):
        return np.arange(len(text) + 1)
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(data))


def _further(text: str, places: Places) -> Iterator[Layer]:
    """What a layer holds encoded, one layer at a time."""
    for made in (_percent(text, places), _escapes(text, places)):
        if made:
            yield made
    yield from _runs(text, places)


def spans(text: str | None) -> list[tuple[str, int, int, int]]:
    """All secrets of a text: kind, start, end and the least depth of a layer with it, 0 for the text itself."""
    if not text:
        return []
    found: dict[Span, int] = {}
    done: dict[bytes, int] = {}
    work: list[Iterator[Layer]] = [iter([(text, Places.of_text(text))])]
    while work:
        layer, places = next(work[-1], (None, None))
        if layer is None:
            work.pop()
            continue
        depth = len(work) - 1
        key = hashlib.blake2b(layer.encode("utf-8", "replace"), digest_size=20)
        key.update(b"\xff" + places.mark())
        if done.get(key.digest(), depth + 1) <= depth:
            continue
        done[key.digest()] = depth
        for kind, a, b in find(layer):
            span = (kind, *places.span(a, b))
            found[span] = min(depth, found.get(span, depth))
        work.append(_further(layer, places))
    order = {kind: i for i, kind in enumerate(KINDS)}
    ranked = sorted(found.items(), key=lambda x: (x[0][1], order[x[0][0]], x[0][2]))
    return [(*span, depth) for span, depth in ranked]


SECRETS = "array<struct<kind:string,start:int,end:int,depth:int>>"
_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32())]
    )
)
_FIELDS = ("kind", "start", "end", "depth")


def secrets(text: Column) -> Column:
    """The secrets of a text column, as structs of kind, start, end and depth."""

    def over(column: pa.Array) -> pa.Array:
        rows = ([dict(zip(_FIELDS, s, strict=True)) for s in spans(t)] for t in column.to_pylist())
        return pa.array(rows, _ARROW)

    return F.arrow_udf(over, SECRETS)(text)


def scan(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Add the secrets found in a text column."""
    return docs.withColumn(into, secrets(F.col(f"`{text}`")))


def mask(text: str | None, mark: str = "[{}]") -> str | None:
    """A text with its secrets replaced by their kind; overlapping spans become one mark."""
    parts, upto = [], 0
    for kind, start, end, _ in spans(text):
        if start >= upto:
            parts += [text[upto:start], mark.format(kind)]
        upto = max(upto, end)
    return "".join([*parts, text[upto:]]) if parts else text


def redact(docs: DataFrame) -> DataFrame:
    """Documents with masked secrets; every document stays, `n_chars` follows where it exists."""

    def over(column: pa.Array) -> pa.Array:
        return pa.array(map(mask, column.to_pylist()), pa.string())

    out = docs.withColumn("text", F.arrow_udf(over, "string")("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def _joined(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    base = F.filter("secrets", lambda s: s["depth"] == 0)
    counts = [
        F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS
    ]
    return (
        scan(docs)
        .withColumn("base", base)
        .select(
            "doc_id",
            *counts,
            F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
            _joined(F.col("secrets")).alias("spans"),
        )
    )
