"""Secrets in texts, confirmed by structure (operator 9).

Patterns find assignments, access keys and hex strings. Beyond those,
candidates that could encode a key are decoded and parsed before they are
reported: values inside base64 runs of either alphabet and hex runs of either
case, as long as their header says, as DER (every nested length must fit its
parent, and the fields must be those of a private key), OpenSSH private keys
by their length-prefixed fields, PEM blocks (also with escaped line ends) by what they
enclose or, if encrypted, by their headers, and signed tokens by the JSON of header and payload.

Whole texts, one pass in Arrow batches, no shuffle.

Defined cases: null and empty texts have no spans; repeated rows and null ids
get a result row each; an empty table gives an empty one. Other columns are
not read. Spans are sorted by start, then by kind in the order of ``KINDS``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .spans import Span, span_table

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "openssh", "pem", "jwt")

_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                     r"([A-Za-z0-9+/_.=-]+)")
_ASSIGN_CUES = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, as ``+`` would find it
_HEX_ANY = re.compile(r"[0-9a-fA-F]{24,}")  # of either case, for DER only
_HEX_START = re.compile(r"(?=30[0-9a-fA-F]{22})")
# Maximal runs of both base64 alphabets; the value may start inside the run.
_RUN64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
# DER sequences start with the byte 0x30, so with M in base64.
_DER64_START = re.compile(r"(?=M[A-Za-z0-9+/_-]{39})")
_SSH64 = re.compile(r"b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/]+={0,2}")
_SSH_MAGIC = b"openssh-key-v1\0"
# line ends may be escaped, as in JSON; headers as in encrypted PKCS 1 files
_EOL = r"(?:\s|\\+[nr])"
_PEM = re.compile(rf"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----"
                  rf"({_EOL}*+(?:[A-Za-z0-9-]++:\x20[^\r\n\\]*+{_EOL}++)*+)"
                  rf"((?:[A-Za-z0-9+/=]|{_EOL})++)-----END \1-----")
_ENCRYPTED = re.compile(r"Proc-Type:\x204,ENCRYPTED")
_DEK = re.compile(r"DEK-Info:\x20[A-Z0-9-]+,[0-9A-Fa-f]{16,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*")
_TOKEN_RUN = re.compile(r"[A-Za-z0-9_-]+")


def decode64(s: str) -> bytes | None:
    """Base64 of either alphabet, padding optional; None if it is not."""
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill ``data`` exactly, else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at:at + n], "big")
            if size < 0x80 or (n > 1 and size < 1 << 8 * (n - 1)):
                return None  # not the shortest form
            at += n
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


_INT, _OCTETS, _OID, _SEQ = 0x02, 0x04, 0x06, 0x30


def is_private_der(data: bytes | None) -> bool:
    """A private key: PKCS 1 (version and eight or more integers), PKCS 8
    (version, algorithm, key octets), encrypted PKCS 8 or SEC 1 (1, octets)."""
    outer = der_fields(data) if data else None
    if not outer or len(outer) != 1 or outer[0][0] != _SEQ:
        return False
    inner = der_fields(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [t for t, _ in inner]
    algorithm = lambda c: bool(f := der_fields(c)) and f[0][0] == _OID
    if tags[0] == _INT and len(inner[0][1]) == 1 and inner[0][1][0] in (0, 1):
        if len(tags) >= 3 and tags[1] == _SEQ and tags[2] == _OCTETS:
            return algorithm(inner[1][1])
        if tags[1] == _OCTETS:
            return len(inner[1][1]) >= 16
        return len(tags) >= 6 and set(tags[:6]) == {_INT}
    return len(tags) == 2 and tags == [_SEQ, _OCTETS] and algorithm(inner[0][1])


def der_size(data: bytes) -> int | None:
    """Bytes of the DER sequence that ``data`` starts with, by its header."""
    if len(data) < 2 or data[0] != _SEQ:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    n = data[1] & 0x7F
    if not 1 <= n <= 4 or len(data) < 2 + n:
        return None
    return 2 + n + int.from_bytes(data[2:2 + n], "big")


def key_size(head: bytes | None) -> int | None:
    """``der_size`` of data whose first field may be that of a private key."""
    size = der_size(head) if head else None
    if size is None:
        return None
    at = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
    first = head[at:at + 3]
    return size if first in (b"\2\1\0", b"\2\1\1") or first[:1] == bytes([_SEQ]) else None


def der_spans(text: str, run: re.Pattern, start: re.Pattern, decode, part: int, size_of) -> list[Span]:
    """Private keys that start anywhere in a run and are as long as their
    header, the first ``part`` letters, says."""
    found: list[Span] = []
    for r in run.finditer(text):
        letters = r[0].rstrip("=")
        done = 0
        for m in start.finditer(letters):
            at = m.start()
            size = key_size(decode(letters[at:at + part])) if at >= done else None
            end = at + size_of(size) if size else len(letters) + 1
            if end <= len(letters) and is_private_der(decode(letters[at:end])):
                done = end
                found.append(("der", r.start() + at, r.end() if end == len(letters) else r.start() + end))
    return found


def is_openssh(data: bytes | None) -> bool:
    """Cipher, derivation and options as length-prefixed strings, then keys."""
    if not data or not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 64


def is_encrypted(headers: str, body: bytes | None) -> bool:
    """The headers of an encrypted key and whole cipher blocks of eight bytes."""
    return bool(body) and len(body) % 8 == 0 and bool(_ENCRYPTED.search(headers) and _DEK.search(headers))


def is_signed_token(s: str) -> bool:
    """Header and payload are JSON objects and the header names an algorithm."""
    try:
        header, payload = (json.loads(decode64(p) or b"") for p in s.split(".")[:2])
    except (ValueError, RecursionError):  # not JSON, not UTF-8, or nested without end
        return False
    return isinstance(header, dict) and isinstance(payload, dict) and isinstance(header.get("alg"), str)


def _tokens(text: str) -> Iterator[re.Match]:
    """The matches of ``_JWT`` from left to right. What follows a run decides
    for all its 'eyJ', so after a failure the rest of the run is skipped."""
    at = text.find("eyJ")
    while at >= 0:
        m = _JWT.match(text, at)
        if m:
            yield m
        at = text.find("eyJ", (m or _TOKEN_RUN.match(text, at)).end())


def find_secrets(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(cue in low for cue in _ASSIGN_CUES):
        found += (("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6)
    found += (("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20)
    found += (("hex", *m.span()) for m in _HEX.finditer(text))
    found += der_spans(text, _HEX_ANY, _HEX_START, bytes.fromhex, 24, lambda n: 2 * n)
    found += der_spans(text, _RUN64, _DER64_START, decode64, 16, lambda n: -(-n * 4 // 3))
    if "b3BlbnNzaC1rZXktdjE" in text:
        found += (("openssh", *m.span()) for m in _SSH64.finditer(text) if is_openssh(decode64(m[0])))
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            body = decode64(re.sub(_EOL, "", m[3]))
            if is_private_der(body) or is_openssh(body) or is_encrypted(m[2], body):
                found.append(("pem", *m.span()))
    if "eyJ" in text:
        found += (("jwt", *m.span()) for m in _tokens(text) if is_signed_token(m[0]))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``spans``) per input row."""
    return span_table(df, find_secrets, id_col, text_col)
