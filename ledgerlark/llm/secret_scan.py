"""Secret scans with structural confirmation.

Three plain shapes are always reported: assignments to names of secrets, access key ids and long hex runs. On top, base64 and
hex candidates are decoded and reported only when their inside holds together: DER key encodings whose nested lengths fit
exactly (PKCS#1, PKCS#8, SEC 1), private keys in the OpenSSH container, and signed tokens whose header is a JSON object that
names an algorithm. Candidates that only look random are not reported.

A null text has no secrets, like an empty one. Each text is searched whole and alone; rows that repeat give equal results.
Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlark.llm import common as C

#: Order of the kinds where spans begin together.
KINDS = ("assign", "access", "hex", "pkcs1", "pkcs8", "sec1", "openssh", "token")

# Shapes of the three plain kinds.
_ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api")

# Candidates: base64 that begins like a key encoding, in one run or in lines (indented, or with escaped line ends); hex of either case;
# three dotted base64url parts.
_BEGIN = re.compile(rb"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt]))(?=(?:M|b3BlbnNzaC1rZXkt)[A-Za-z0-9+/])(?=[A-Za-z0-9+/]{16})")
_RUN = re.compile(rb"[A-Za-z0-9+/]+")
_LINE_END = re.compile(rb"[\x20\t]*(?:\r?\n|(?:\\r)?\\n)(?:[\x20\t]|\\t)*(?=[A-Za-z0-9+/=])")
_ANY_HEX = re.compile(rb"(?:[0-9a-f]{2}){24,}|(?:[0-9A-F]{2}){24,}")
_TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*))")
_LONG_RUN = re.compile(rb"[A-Za-z0-9+/_-]{16}")
_OPENSSH = b"openssh-key-v1\0"


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, first byte and end of the DER element at ``at``, if it lies inside ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end or data[at] == 0:
            return None
        size, at = int.from_bytes(data[at:at + n], "big"), at + n
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill the range exactly."""
    out = []
    while at < end:
        e = _element(data, at, end)
        if e is None:
            return None
        out.append(e)
        at = e[2]
    return out


def _container_size(data: bytes) -> int | None:
    """Size of the OpenSSH container that ``data`` begins with, if its fields up to the last one's length are there."""
    at, n = len(_OPENSSH), 0
    while at + 4 <= len(data) and n < 3:  # cipher, key derivation, its options
        at, n = at + 4 + int.from_bytes(data[at:at + 4], "big"), n + 1
    keys = int.from_bytes(data[at:at + 4], "big") if at + 4 <= len(data) else 0
    at += 4
    for _ in range(keys + 1 if 1 <= keys <= 16 else 0):  # the public keys, then the private block
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at if 1 <= keys <= 16 else None


def encoded_size(data: bytes) -> int | None:
    """How many bytes the encoding has that ``data`` begins with, by its own lengths; more may follow."""
    if data.startswith(_OPENSSH):
        return _container_size(data)
    if len(data) < 6 or data[0] != 0x30:
        return None
    n = data[1] & 0x7F
    if data[1] < 0x80:
        return 2 + n
    return 2 + n + int.from_bytes(data[2:2 + n], "big") if 1 <= n <= 4 else None


def key_kind(data: bytes) -> str | None:
    """The kind of private key that ``data`` encodes completely, or none."""
    if data.startswith(_OPENSSH):
        return "openssh" if _container_size(data) == len(data) else None
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return None
    parts = _elements(data, top[1], top[2])
    if not parts or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return None
    tags = [p[0] for p in parts]
    if len(tags) >= 9 and set(tags[:9]) == {0x02}:
        return "pkcs1"
    if len(tags) >= 3 and tags[1:3] == [0x30, 0x04]:
        inner = _elements(data, parts[1][1], parts[1][2])
        return "pkcs8" if inner and inner[0][0] == 0x06 else None
    if len(tags) >= 2 and tags[1] == 0x04 and data[parts[0][1]] == 1 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "sec1"
    return None


def _json_object(part: bytes) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _is_token(found: bytes) -> bool:
    header, payload, _ = found.split(b".")
    head = _json_object(header)
    return head is not None and isinstance(head.get("alg"), str) and _json_object(payload) is not None


def _base64_key(text: bytes, start: int) -> tuple[int, str] | None:
    """End and kind of the key whose base64 begins at ``start``. Its own length says where it ends; whatever follows, in the same run
    or on the next line, is not part of it."""
    parts: list[bytes] = []
    ends: list[tuple[int, int]] = []  # characters up to the end of a part, and where that is
    have, need, data, at = 0, None, b"", start
    openssh = text.startswith(b"b3Blbn", start)
    while need is None or have < need:
        run = _RUN.match(text, at)
        if run is None:
            break
        parts.append(run[0])
        have += len(run[0])
        ends.append((have, run.end()))
        if need is None and not openssh:
            size = encoded_size(base64.b64decode(parts[0][:8]))
            if size is None:
                return None
            need = (size * 4 + 2) // 3
        gap = _LINE_END.match(text, run.end())
        if gap is None:
            break
        at = gap.end()
    clean = b"".join(parts)
    if openssh:
        data = base64.b64decode(clean[:len(clean) // 4 * 4])
        size = _container_size(data + bytes(3))
        if size is None:
            return None
        need = (size * 4 + 2) // 3
    if need is None or have < need:
        return None
    taken = clean[:need]
    if need % 4 == 1:
        return None
    kind = key_kind(base64.b64decode(taken + b"=" * (-need % 4)))
    if kind is None:
        return None
    upto, end = next(e for e in ends if e[0] >= need)
    end -= upto - need
    for _ in range(-need % 4):
        end += text[end:end + 1] == b"="
    return end, kind


def spans_of(text: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start and then kind."""
    found = []
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    if _LONG_RUN.search(text):
        found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
        for m in _BEGIN.finditer(text):
            key = _base64_key(text, m.start())
            if key:
                found.append((m.start(), *key))
        for m in _ANY_HEX.finditer(text):
            data = binascii.unhexlify(m[0])
            size = encoded_size(data)
            kind = key_kind(data[:size]) if size and size <= len(data) else None
            if kind:
                found.append((m.start(), m.start() + 2 * size, kind))
    if text.count(b".") >= 2:
        found += [(*m.span(1), "token") for m in _TOKEN.finditer(text) if _is_token(m[1])]
    return sorted(set(found), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])


def _scan(texts: C.Texts) -> list[pa.Array]:
    data, out = texts.data.tobytes(), []
    for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
        text, rows, at, points = data[a:b], [], 0, 0
        for start, end, kind in spans_of(text):
            points += len(text[at:start].decode("utf-8", "replace"))
            at = start
            rows.append({"kind": kind, "start": points, "end": points + end - start})
        out.append(rows)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return [pa.array(out, kind)]


def scan(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` and ``secrets``: an array of (kind, start, end) by start and then kind. Every span is ASCII."""
    return C.map_texts(docs, carry, _scan, [T.StructField("secrets", T.ArrayType(SPAN))], text)
