"""Secret scans with structural confirmation.

Patterns name candidates; runs of base64 and hex and dotted tokens are then decoded and their inner structure is parsed
(lengths that nest and fill the outer value exactly, a signed token's header) before a span of that kind is reported.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: In the order in which spans of one start are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "private_key", "ssh_key", "signed_token")
BASE_KINDS = KINDS[:3]
MASK = "[SECRET]"

_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}+")
#: Where base64 of a DER sequence, of an OpenSSH key or of a PEM text can begin, also inside a run.
_KEY_START = re.compile(r"(?:M[B-I](?=[A-Za-z0-9+/_-]{30})|(?:b3Bl|LS0t)(?=[A-Za-z0-9+/_-]{28}))")
#: Characters of base64 and of its form for URLs, and what joins lines: breaks, or breaks escaped once or oftener.
_RUNS = (re.compile(r"[A-Za-z0-9+/]*+"), re.compile(r"[A-Za-z0-9_-]*+"))
_JOIN = re.compile(r"(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*")
_PEM = b"-----BEGIN "
#: Headers of a PEM private key encrypted by its own cipher, up to the first character of its body.
_SEALED = re.compile(
    r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----%(j)sProc-Type: 4,ENCRYPTED%(j)sDEK-Info: [A-Z0-9-]+,([0-9A-Fa-f]+)%(j)s%(j)s"
    % {"j": _JOIN.pattern}
)
_HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+(?![A-Za-z0-9_.-]*\.[A-Za-z0-9_-])")
_SSH_MAGIC = b"openssh-key-v1\0"
_SEQUENCE, _INTEGER, _BITS, _OCTETS, _OID = 0x30, 0x02, 0x03, 0x04, 0x06

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the three base patterns, leftmost and non-overlapping per kind; code points, end exclusive."""
    found: list[Span] = []
    folded = text.lower()
    if any(hint in folded for hint in _ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A maximal run is what the shorter pattern would match too, so asking for 24 at once only skips failing matches.
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and value of every element when their lengths fill ``data`` exactly, else None."""
    items, at = [], 0
    while at < len(data):
        head = der_length(data, at)
        if head is None or head[1] > len(data):
            return None
        items.append((data[at], data[head[0] : head[1]]))
        at = head[1]
    return items


def der_length(data: bytes, at: int = 0) -> tuple[int, int] | None:
    """Start and end of the value of the element at ``at``; None when its length is not in shortest definite form."""
    if at + 2 > len(data):
        return None
    first = data[at + 1]
    if first < 0x80:
        return at + 2, at + 2 + first
    size = first & 0x7F
    if not 1 <= size <= 4 or at + 2 + size > len(data):
        return None
    length = int.from_bytes(data[at + 2 : at + 2 + size], "big")
    if length < 0x80 or length >> (8 * (size - 1)) == 0:
        return None
    return at + 2 + size, at + 2 + size + length


def is_private_key(data: bytes) -> bool:
    """True for an RSA, EC or wrapped (also encrypted) private key whose nested lengths all fit."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    parts = der_items(outer[0][1])
    if not parts:
        return False
    tags = [tag for tag, _ in parts]
    if tags[:9] == [_INTEGER] * 9 and len(parts) <= 10:
        return all(value for _, value in parts)
    if tags[:2] == [_INTEGER, _OCTETS] and parts[0][1] == b"\1":
        return len(parts[1][1]) >= 16 and all(tag >= 0xA0 for tag in tags[2:])
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS] and parts[0][1] in (b"\0", b"\1"):
        return _is_algorithm(parts[1][1]) and bool(parts[2][1])
    if tags == [_SEQUENCE, _OCTETS]:
        return _is_algorithm(parts[0][1]) and len(parts[1][1]) >= 16 and len(parts[1][1]) % 8 == 0
    return False


def _is_algorithm(data: bytes) -> bool:
    items = der_items(data)
    return bool(items) and items[0][0] == _OID and len(items[0][1]) >= 3


def is_ssh_key(data: bytes) -> bool:
    """True for an OpenSSH private key file: its length-prefixed strings must fill it exactly."""
    return data.startswith(_SSH_MAGIC) and ssh_need(data) == len(data)


def ssh_need(data: bytes) -> int:
    """Where an OpenSSH private key ends by the lengths of its own strings, as far as ``data`` holds them: a place beyond
    ``data`` while more of it is needed to tell, 0 if it announces no keys."""
    at, keys = len(_SSH_MAGIC), 1
    for part in range(5):
        if part == 3:
            keys = int.from_bytes(data[at : at + 4], "big")
            at += 4
            if at > len(data):
                return at
        for _ in range(keys if part == 3 else 1):
            if at + 4 > len(data):
                return at + 4
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            if at > len(data):
                return at
    return at if keys >= 1 else 0


def is_signed_token(token: str) -> bool:
    """True when header and claims of a dotted token are JSON objects and the header names how it is signed."""
    header, claims, signature = token.split(".")
    try:
        head, body = (json.loads(_url_bytes(part)) for part in (header, claims))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return bool(signature) or head["alg"].lower() == "none"


def _url_bytes(part: str) -> bytes:
    return base64.b64decode(part + "=" * (-len(part) % 4), altchars=b"-_", validate=True)


class _Lines:
    """Runs of one alphabet in a text, each found once, and the lines that may continue them.

    Starts are asked for in ascending order. A start inside the lines that are known needs no second look at the text,
    so many starts in one long run or in many lines cost no more than one.
    """

    def __init__(self, text: str, url: bool):
        self.text, self.url = text, url
        self.starts: list[int] = []
        self.stops: list[int] = []
        #: Characters up to the end of each line, and where its padding ends.
        self.through: list[int] = []
        self.ends: list[int] = []
        #: The last character of each line that only base64 for URLs has.
        self.marked: list[int] = []

    def line(self, start: int) -> int:
        """The line that holds ``start``."""
        if not self.stops or start >= self.stops[-1]:
            self._follow(start)
        return bisect_right(self.stops, start)

    def _follow(self, start: int) -> None:
        text = self.text
        self.starts, self.stops, self.through, self.ends, self.marked = [], [], [], [], []
        while True:
            stop = _RUNS[self.url].match(text, start).end()
            end = stop
            while end < len(text) and end < stop + 2 and text[end] == "=":
                end += 1
            self.starts.append(start)
            self.stops.append(stop)
            self.through.append((self.through[-1] if self.through else 0) + stop - start)
            self.ends.append(end)
            self.marked.append(max(text.rfind("-", start, stop), text.rfind("_", start, stop)) if self.url else -1)
            line = _JOIN.match(text, stop)
            if not line or end > stop or line.end() >= len(text) or stop == start:
                return
            start = line.end()

    def count(self, start: int, first: int, last: int) -> int:
        """Characters from ``start``, in line ``first``, to the end of line ``last``."""
        return self.through[last] - self.through[first] + self.stops[first] - start

    def reach(self, start: int, first: int, size: int) -> int | None:
        """The line with whose end there are characters for ``size`` bytes; None if there are too few."""
        wanted = -(-4 * size // 3) + self.through[first] - (self.stops[first] - start)
        last = bisect_left(self.through, wanted, lo=first)
        return last if last < len(self.through) else None

    def data(self, start: int, first: int, characters: int) -> bytes:
        """The bytes that this many characters from ``start`` stand for."""
        taken, line = [], first
        while characters > 0 and line < len(self.stops):
            piece = self.text[start : min(self.stops[line], start + characters)]
            taken.append(piece)
            characters -= len(piece)
            line += 1
            start = self.starts[line] if line < len(self.starts) else start
        return _decoded("".join(taken))

    def exact(self, start: int, first: int, size: int) -> int | None:
        """The line whose end is also the end of ``size`` bytes; None if there is none."""
        last = self.reach(start, first, size)
        if last is None:
            return None
        count = self.count(start, first, last)
        return last if (count - (count % 4 == 1)) * 3 // 4 == size else None


def _decoded(characters: str) -> bytes:
    characters = characters[: len(characters) - (len(characters) % 4 == 1)]
    return base64.b64decode(characters.replace("-", "+").replace("_", "/") + "=" * (-len(characters) % 4))


def _key_at(lines: _Lines, start: int) -> tuple[str | None, int] | None:
    """Kind and end of the key at ``start``; no kind for another value that is complete, None for anything else."""
    first = lines.line(start)
    stop = lines.stops[first]
    if stop - start < 32:
        return None
    head = _decoded(lines.text[start : start + 32])
    known = head[0] == _SEQUENCE or head.startswith((_SSH_MAGIC, _PEM))
    if not known or lines.url and lines.marked[first] < start:
        return None
    total = lines.count(start, first, len(lines.stops) - 1)
    if head[0] == _SEQUENCE:
        need = der_length(head)
        if not need or head[need[0]] not in (_INTEGER, _SEQUENCE):
            return None
        last = lines.exact(start, first, need[1])
        if last is None:
            return None
        data = lines.data(start, first, lines.count(start, first, last))
        if is_private_key(data):
            return "private_key", lines.ends[last]
        return (None, lines.ends[last]) if der_items(der_items(data)[0][1]) else None
    if head.startswith(_SSH_MAGIC):
        data, taken = head, 32
        while (size := ssh_need(data)) > len(data):
            if -(-4 * size // 3) > total:
                return None
            taken = max(-(-4 * size // 3), min(2 * taken, total))
            data = lines.data(start, first, taken)
        last = lines.exact(start, first, size) if size else None
        return None if last is None else ("ssh_key", lines.ends[last])
    data = lines.data(start, first, total)
    # A file of several parts goes to its last end mark.
    close = data.find(b"-----", data.rfind(b"-----END ") + 9) + 5 if b"-----END " in data else len(data)
    inner = confirmed_spans(data[:close].decode("latin-1"))
    kind = next((kind for kind, _, _ in inner if kind in ("private_key", "ssh_key")), None)
    last = lines.reach(start, first, close)
    return kind, lines.ends[-1 if last is None else last]


def _sealed_keys(text: str) -> Iterator[Span]:
    """Bodies of PEM private keys encrypted behind headers: whole cipher blocks of a named cipher, with its start value."""
    for m in _SEALED.finditer(text):
        lines = _Lines(text, False)
        lines.line(m.end())
        last = len(lines.stops) - 1
        while last > 0 and lines.stops[last] == lines.starts[last]:
            last -= 1
        close = _JOIN.match(text, lines.ends[last])
        block = len(m[1]) // 2
        if block in (8, 16) and close and text.startswith("-----END ", close.end()):
            size = len(lines.data(m.end(), 0, lines.through[last]))
            if size >= 2 * block and size % block == 0:
                yield "private_key", m.end(), lines.ends[last]


def confirmed_spans(text: str) -> list[Span]:
    """Keys and signed tokens whose decoded structure was parsed to its end."""
    found: list[Span] = list(_sealed_keys(text)) if "DEK-Info: " in text else []
    plain, url = _Lines(text, False), _Lines(text, True)
    reached = 0
    for m in _KEY_START.finditer(text):
        if m.start() < reached:
            continue
        hit = _key_at(plain, m.start()) or _key_at(url, m.start())
        if hit:
            kind, reached = hit
            if kind:
                found.append((kind, m.start(), reached))
    for m in _HEX_ANY.finditer(text):
        if text.startswith("30", m.start()) and (m.end() - m.start()) % 2 == 0 and is_private_key(binascii.unhexlify(m[0])):
            found.append(("private_key", *m.span()))
    if text.count(".") >= 2:
        found += [("signed_token", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])]
    return found


def secret_spans(text: str | None) -> list[Span]:
    """All spans, by start and then by kind as in ``KINDS``; none for null or empty."""
    if not text:
        return []
    found = set(base_spans(text)) | set(confirmed_spans(text))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def masked(text: str | None, mask: str = MASK) -> str | None:
    """The text with every run of touching spans replaced by ``mask``."""
    if not text:
        return text
    out, at = [], 0
    for _, start, end in secret_spans(text):
        if start > at or not out:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SCAN = StructType(
    [
        *(StructField(f"n_{kind}", LongType()) for kind in KINDS),
        StructField("base_sha256", StringType()),
        StructField("spans", StringType()),
    ]
)


def scan_text(text: Column) -> Column:
    """A struct of counts per kind, the digest of the base spans and all spans as ``kind:start:end``, comma-joined."""

    @F.pandas_udf(_SCAN)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            spans = secret_spans(text)
            kinds = [s[0] for s in spans]
            base = _listed([s for s in spans if s[0] in BASE_KINDS])
            rows.append((*map(kinds.count, KINDS), hashlib.sha256(base.encode()).hexdigest(), _listed(spans)))
        return pd.DataFrame(rows, columns=_SCAN.names)

    return scan(text)


def find_secrets(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (``doc_id, text``; others do not matter), repeats included.

    A null or empty text has no spans; a null ``doc_id`` stays null; texts of any length are scanned whole.
    """
    found = documents.select(F.col("doc_id").cast("long"), scan_text(F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", "found.*")


def redact(documents: DataFrame, mask: str = MASK) -> DataFrame:
    """``documents`` with every secret in ``text`` replaced by ``mask``; all other columns as they were."""

    @F.pandas_udf(StringType())
    def redacted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: masked(text, mask), na_action="ignore")

    return documents.withColumn("text", redacted(F.col("text").cast("string")))
