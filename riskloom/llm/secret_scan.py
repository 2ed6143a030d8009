"""Secret scan of texts and of what is encoded inside them.

A worklist starts with the text itself. Each layer is scanned, and every run in
it that looks like URL escapes, Unicode escapes, base64 or compressed data in
base64 is decoded into a further layer, until nothing new comes up. A layer's
content is never scanned twice for the same place, which ends cycles. What is
found in a layer is reported at the place of the encoded run in the text.

Layers are bytes, read as UTF-8 and as UTF-16 where it may be; what is no text in
them is passed over, not a reason to drop them. A layer only ever shrinks, except
by decompression. What a compressed run holds is scanned in windows of bounded
size to its end; if it is more than MAX_EXPANSION, the run is also reported by a
kind of its own, ``bomb``.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

KINDS = ("assign", "access", "hex")

#: Bytes from which on what a compressed run holds is reported as a bomb.
MAX_EXPANSION = 16 << 20

#: Bytes of a decompressed layer that are scanned at once, and that the next
#: window repeats at least; an encoded run that is cut there repeats, up to half a window.
WINDOW, CARRY = 8 << 20, 64 << 10

#: Bytes that are inflated at once; they may grow a thousandfold.
BLOCK = 512

# The shapes of secrets and their least lengths.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("passw", "secret", "token", "api")
_ASSIGN_CHARS, _ACCESS_CHARS = 6, 20
# End of fixed values.

# Runs are taken whole and then looked into, so that a long one is read twice at most.
_RUN = re.compile(r"""[^\s"'<>]+""")
_URL_ONE = re.compile(r"%[0-9A-Fa-f]{2}")
_UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# A run up to the end of its line and the lines of nothing but base64 after it.
_WRAPPED = re.compile(
    r"""(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++={0,2}+(?=[\x20\t]*+(?:\r?\n|\Z)|["'<>,;)\]]))+"""
)
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_RUN_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\\r\n"
# Compressed data at the start of a layer, and such as is usual anywhere in one.
_START = re.compile(rb"\x1f\x8b|[\x08\x18\x28\x38\x48\x58\x68\x78](?=[\x00-\xff])", re.S)
_INSIDE = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]", re.S)
_NULS = re.compile(rb"\0*")
_WIDE = re.compile(rb"(?:[\x09\x0a\x0d\x20-\x7e]\0){8,}+|(?:\0[\x09\x0a\x0d\x20-\x7e]){8,}+")
_PRINTABLE = re.compile(r"[\x09\x0a\x0d\x20-\x7e\xa0-\U0010ffff]*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Secrets that stand in ``text`` as they are, by start, then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _WORDS):
        found = [Span("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_CHARS]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= _ACCESS_CHARS]
    found += [Span("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def _is_text(data: bytes) -> bool:
    """Whether ``data`` is printable UTF-8."""
    try:
        return bool(data) and bool(_PRINTABLE.fullmatch(data.decode()))
    except UnicodeDecodeError:
        return False


def _unicode(run: str) -> bytes:
    plain = _UNICODE_ONE.sub(lambda m: chr(int(m[1], 16)), run)
    # Pairs of surrogates make one character; single ones are replaced.
    return plain.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode()


def _base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of base64 and groups of them on lines that follow each other: (start, end, run without breaks)."""
    for m in _BASE64.finditer(text):
        yield *m.span(), m[0]
    for m in _WRAPPED.finditer(text):
        group: list[re.Match] = []
        width = 0
        for line in _LINE.finditer(text, *m.span()):
            size = len(line[0])
            if len(group) > 2 and size > width:
                yield group[0].start(), group[-1].end(), "".join(g[0] for g in group)
                group = []
            group.append(line)
            # A shorter line than the one before is the last, unless the first was short itself.
            if len(group) > 1 and (size < width or line[0][-1] == "="):
                yield group[0].start(), group[-1].end(), "".join(g[0] for g in group)
                group = []
            width = size
        if len(group) > 1:
            yield group[0].start(), group[-1].end(), "".join(g[0] for g in group)


def decoded_runs(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Encoded runs of ``text`` and what each decodes to: (start, end, content).

    Where a base64 run is no text as it stands, something may stand before what
    is encoded: the four alignments together hold what any of its ends decodes to.
    """
    for one, decode in ((_URL_ONE, unquote_to_bytes), (_UNICODE_ONE, _unicode)):
        if one.search(text):
            for m in _RUN.finditer(text):
                if one.search(m[0]):
                    yield *m.span(), decode(m[0])
    for start, end, run in _base64_runs(text):
        body = run.rstrip("=").replace("-", "+").replace("_", "/")
        for skip in range(4):
            # One character over gives no byte.
            part = body[skip : len(body) - ((len(body) - skip) % 4 == 1)]
            data = base64.b64decode(part + "=" * (-len(part) % 4))
            yield start, end, data
            if _is_text(data):
                break


class _Stream:
    """A zlib or gzip stream, fed in pieces, with the members that follow it.

    What it holds is one layer: up to WINDOW bytes go to the worklist whole;
    more is scanned window by window, each with the unfinished end of the one
    before, while streams inside that are not at their end are fed on.
    """

    def __init__(self, scan: _Scan, place: tuple[int, int]):
        self.scan, self.place = scan, place
        self.inflate = zlib.decompressobj(wbits=47)
        self.held = bytearray()
        self.total = self.old = 0
        self.open: list[_Stream] = []
        self.long = False

    def feed(self, data: bytes, at: int) -> int | None:
        """Take ``data`` from ``at`` on: where the stream ends in it, -1 if it is damaged, None if it goes on."""
        while at < len(data):
            block = data[at : at + BLOCK]
            before = self.inflate.copy()
            try:
                out = self.inflate.decompress(block)
            except zlib.error:
                self._salvage(before, block)
                return -1
            self._take(out)
            at += len(block) - len(self.inflate.unused_data)
            if self.inflate.eof:
                after = _NULS.match(data, at).end()
                if not _START.match(data, after):
                    return at
                at, self.inflate = after, zlib.decompressobj(wbits=47)
        return None

    def _salvage(self, inflate, block: bytes) -> None:
        """What comes before the damage in ``block``."""
        try:
            for n in range(len(block)):
                self._take(inflate.decompress(block[n : n + 1]))
        except zlib.error:
            pass

    def _take(self, out: bytes) -> None:
        self.held += out
        self.total += len(out)
        if self.total > MAX_EXPANSION:
            self.scan.found.add(Span("bomb", *self.place))
        while len(self.held) >= WINDOW:
            self._window()

    def _window(self) -> None:
        data, self.long = bytes(self.held), True
        self.open = self.scan.window(data, self.place, self.old, self.open)
        self.scan.drain()
        unfinished = len(data) - len(data.rstrip(_RUN_BYTES))
        self.old = min(max(unfinished, CARRY), WINDOW // 2, len(data))
        self.held = self.held[len(data) - self.old :]

    def close(self) -> None:
        if self.long:
            self._window()
            for stream in self.open:
                stream.close()
        elif self.held:
            self.scan.work.append((bytes(self.held), self.place))


class _Scan:
    """What was found so far, and the layers still to scan."""

    def __init__(self) -> None:
        self.found: set[Span] = set()
        self.work: deque[tuple[bytes, tuple[int, int]]] = deque()
        self.seen: set[tuple[tuple[int, int], bytes]] = set()

    def text(self, text: str, place: tuple[int, int] | None) -> None:
        """Scan a layer's text; ``place`` is None for the text itself."""
        if place:
            self.found.update(Span(s.kind, *place) for s in base_spans(text))
        for start, end, content in decoded_runs(text):
            if content != text[start:end].encode(errors="replace"):
                self.work.append((content, place or (start, end)))

    def window(
        self, data: bytes, place: tuple[int, int], old: int = 0, streams: list[_Stream] | None = None
    ) -> list[_Stream]:
        """Scan bytes of which the first ``old`` were in the window before; returns streams that go on behind them."""
        done, still = max(0, old - 2), []
        for stream in streams or ():
            end = stream.feed(data, old)
            if end is None:
                still.append(stream)
                done = len(data)
            else:
                stream.close()
                done = max(done, end)
        first = _START.match(data) if not old else None
        for m in itertools.chain([first] if first else [], _INSIDE.finditer(data, done)):
            if m.start() < done:
                continue
            stream = _Stream(self, place)
            end = stream.feed(data, m.start())
            if end is None:
                still.append(stream)
                break
            stream.close()
            done = max(done, end)
        mark = place, hashlib.sha256(data).digest()
        if mark not in self.seen:
            self.seen.add(mark)
            self.text(data.decode(errors="replace"), place)
            # ASCII in UTF-16 of either order, from any byte on.
            for m in _WIDE.finditer(data):
                self.text(m[0].replace(b"\0", b"").decode(), place)
        return still

    def drain(self) -> None:
        while self.work:
            data, place = self.work.popleft()
            if (place, hashlib.sha256(data).digest()) not in self.seen:
                for stream in self.window(data, place):
                    stream.close()


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans of ``text``, and all spans with those of its decoded layers, both sorted."""
    base = base_spans(text)
    run = _Scan()
    run.text(text, None)
    run.drain()
    order = {kind: n for n, kind in enumerate((*KINDS, "bomb"))}
    return base, sorted({*base, *run.found}, key=lambda s: (s.start, order[s.kind], s.end))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find_secrets(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every text: (key, n_assign, n_access, n_hex, base, spans), a row per row.

    Spans are ``kind:start:end`` in code points, joined by commas; ``base`` holds
    what stands in the text as it is, ``spans`` also what was found in decoded
    layers. Null and empty texts have none. An empty table gives no rows.
    """
    bounded_batches(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t or "") for t in batch.column("text").to_pylist()]
            counts = [[sum(s.kind == k for s in base) for base, _ in found] for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([spans_text(base) for base, _ in found], pa.string()),
                    pa.array([spans_text(every) for _, every in found], pa.string()),
                ],
                ["key", "n_assign", "n_access", "n_hex", "base", "spans"],
            )

    narrow = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string"
    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)
