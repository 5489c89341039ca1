"""Secret scan with structural confirmation.

Pattern matches (assignments, access ids, hex runs) are reported as they are.
Beyond them, candidates that look like encoded key material are decoded from
base64 or hex, and reported only if their structure holds: a signed token has a
JSON header that names an algorithm and a JSON payload; a private key parses as
nested tag-length-value fields that use up the bytes exactly and have the layout
of PKCS#1, PKCS#8 or SEC1, or as the length-prefixed fields of an OpenSSH key
file. Armor inside the decoded text is taken off once, and lines that only a line
break separates are joined first. A pattern match whose value decodes to such a structure is marked as
confirmed.

Spans are code points, end exclusive. Kinds: assign, access, hex (patterns),
token, armor, key (confirmed structures). Runs in Arrow batches over whole
texts. Defined cases: null text counts as empty and has no spans; repeated rows
give repeated rows; empty tables give empty results; columns that are kept pass
through. Every pattern runs in time linear in the text or nearly so: long runs
are entered at their start only.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.common import fresh, in_arrow, quoted, text_of

KINDS = ("assign", "access", "hex", "token", "armor", "key")
BASE = KINDS[:3]

# The three patterns of the base scan.
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")  # runs of [0-9a-f]+ of 32 or more
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_LONG = re.compile(r"[A-Za-z0-9+/_=.-]{32}")
# The part between two dots, if its first character can start an object in base64; the parts beside it are looked at later.
_PAYLOAD = re.compile(r"\.(?=([eICD][A-Za-z0-9_-]{2,}+={0,2})\.)")
_URL64 = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
_SIGNATURE = re.compile(r"[A-Za-z0-9_-]*")
# Brackets outside strings, from the end: a quote inside a string follows a backslash, one that opens it does not.
_BACKWARD = re.compile(rb'"(?:[^"]|"(?=\\))*+"|[{}\[\]]')
LEAST_HEADER = 14  # {"alg":""} in base64
_RUN64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_RUN16 = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
_ARMOR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([^-]*)-----END \1-----")
_ARMOR_BYTES = re.compile(_ARMOR.pattern.encode())
_OPENSSH = b"openssh-key-v1\0"
# Runs with only a line break (written out or escaped) and indentation between them. The first one starts as DER,
# OpenSSH or armor does in base64 or hex, or is long.
_BREAK = re.compile(r"(?:\\r)?\\n|[\x20\t]*+\r?\n[\x20\t]*+")
_WRAPPED = re.compile(
    r"(?:(?<=\\n)|(?<![A-Za-z0-9+/_-]))(?=M[A-P]|b3Bl|LS0t|30|6[fF]|2[dD]|[A-Za-z0-9+/_-]{32})"
    rf"([A-Za-z0-9+/_-]++(?:(?:{_BREAK.pattern})[A-Za-z0-9+/_-]++)++)={{0,2}}")


def _unbase64(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the definite-length fields that make up ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at:at + width], "big")
            if size < 0x80 or (width > 1 and size < 1 << 8 * (width - 1)):
                return None  # not the shortest form
            at += width
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _private_der(data: bytes) -> str | None:
    outer = _fields(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return None
    inner = _fields(outer[0][1])
    if not inner:
        return None
    tags = [t for t, _ in inner]
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        algorithm = _fields(inner[1][1])
        return "pkcs8" if algorithm and algorithm[0][0] == OID else None
    if len(tags) >= 9 and tags[:9] == [INTEGER] * 9 and inner[0][1] in (b"\0", b"\1"):
        return "pkcs1"
    if tags[:2] == [INTEGER, OCTETS] and inner[0][1] == b"\1" and set(tags[2:]) <= {0xA0, 0xA1}:
        return "sec1"
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS#8
        algorithm = _fields(inner[0][1])
        return "pkcs8-encrypted" if algorithm and algorithm[0][0] == OID else None
    return None


def _openssh_end(data: bytes, at: int = 0) -> int | None:
    """Where the OpenSSH key that starts at ``at`` ends."""
    if not data.startswith(_OPENSSH, at):
        return None
    at += len(_OPENSSH)

    def field() -> int | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return size

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 64 or any(not field() for _ in range(keys)):
        return None
    return at if field() else None


def _layout(data: bytes | None) -> str | None:
    """The private key layout that binary ``data`` has, if any."""
    if not data:
        return None
    return "openssh" if _openssh_end(data) == len(data) else _private_der(data)


def _unarmored(body: str) -> str | None:
    """Key layout of what is between the armor's marks."""
    lines = re.split(r"(?:\\[nr]|\s)+", body)
    return _layout(_unbase64("".join(x for x in lines if ":" not in x)))


def _armored(data: bytes):
    """Layout, start and end of the armored keys in the data."""
    if b"PRIVATE KEY-----" in data:
        for m in _ARMOR_BYTES.finditer(data):
            if found := _unarmored(m.group(2).decode("latin-1")):
                yield found, m.start(), m.end()


def key_format(data: bytes | None) -> str | None:
    """The private key layout that ``data`` has or, if it is text, that an armored key in it has."""
    return (_layout(data) or next((x for x, _, _ in _armored(data)), None)) if data else None


def _object(part: str) -> dict | None:
    """The JSON object that base64 text holds."""
    if (data := _unbase64(part)) is None:
        return None
    try:
        found = json.loads(data.decode("utf-8"))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def token_algorithm(header: str, payload: str) -> str | None:
    """The algorithm that a signed token's header names, if header and payload are JSON objects."""
    head = _object(header)
    if head is None or not isinstance(head.get("alg"), str) or _object(payload) is None:
        return None
    return head["alg"]


def _header(part: str) -> tuple[int, str] | None:
    """Start and algorithm of the token header that ends ``part``; a word may be glued to its front.

    A header that starts at any place is whole in one of four decodings. In each, brackets are
    matched from the end, so at most one object is parsed."""
    part = part.rstrip("=")
    if len(part) < LEAST_HEADER:
        return None
    found = []
    for at in (0, *(shift + start // 3 * 4 for shift in range(4) if (start := _last_object(_unbase64(part[shift:]))) is not None)):
        if (head := _object(part[at:])) is not None and isinstance(head.get("alg"), str):
            found.append((at, head["alg"]))
    return min(found, default=None)


def _last_object(data: bytes | None) -> int | None:
    """Where the object that ends the data starts, if that is a place where base64 can start."""
    if not data or not (data := data.rstrip()).endswith(b"}"):
        return None
    depth = 0
    for m in _BACKWARD.finditer(data[::-1]):
        if m.group() in (b"}", b"]"):
            depth += 1
        elif m.group() in (b"{", b"["):
            depth -= 1
            if depth == 0:
                start = len(data) - m.end()
                return start if start % 3 == 0 else None
    return None


def tokens(text: str) -> list[tuple[int, int, str]]:
    """Start, end and algorithm of the signed tokens: three parts joined by dots, wherever they
    stand in a longer run. The last part goes on to the end of its characters (hyphens included)."""
    out = []
    for m in _PAYLOAD.finditer(text):
        if _object(m.group(1)) is None:
            continue
        start = m.start()
        while start and text[start - 1] == "=" and m.start() - start < 2:
            start -= 1
        while start and text[start - 1] in _URL64:
            start -= 1
        if found := _header(text[start:m.start()]):
            out.append((start + found[0], _SIGNATURE.match(text, m.end(1) + 1).end(), found[1]))
    return out


def _decoded(value: str) -> str | None:
    """Key layout of a value that is hex or base64."""
    if len(value) % 2 == 0 and re.fullmatch(r"[0-9A-Fa-f]+", value) and (found := key_format(bytes.fromhex(value))):
        return found
    return key_format(_unbase64(value)) if re.fullmatch(r"[A-Za-z0-9+/_-]+={0,2}", value) else None


def _key_at(data: bytes, at: int) -> tuple[int, Callable[[], str | None]] | None:
    """Where the key that starts at ``at`` says it ends, and its layout if it holds."""
    if data[at] == SEQUENCE and at + 2 <= len(data):
        width = data[at + 1] & 0x7F if data[at + 1] & 0x80 else 0
        end = at + 2 + width + (int.from_bytes(data[at + 2:at + 2 + width], "big") if width else data[at + 1])
        return end, lambda: _private_der(data[at:end])
    end = _openssh_end(data, at)
    return (end, lambda: "openssh") if end else None


def _decodings(joined: str):
    """What the joined lines hold as base64 and as hex, with the place where it starts, and how many
    characters make how many bytes."""
    for shift in range(4):
        run = joined[shift:]
        if data := _unbase64(run[:-1] if len(run) % 4 == 1 else run):
            yield data, shift, 4, 3
    for m in _RUN16.finditer(joined):
        for shift in (0, 1):
            run = m.group()[shift:]
            yield bytes.fromhex(run[:len(run) // 2 * 2]), m.start() + shift, 2, 1


def wrapped_keys(text: str) -> list[tuple[int, int, str]]:
    """Start, end and layout of keys in base64 or hex that take several lines, without armor around
    them. Lines before or after a key that look alike are no part of it: a key states its length."""
    out = []
    for block in _WRAPPED.finditer(text):
        at, lines = block.start(), []
        for m in _BREAK.finditer(text, *block.span(1)):
            lines.append((at, m.start()))
            at = m.end()
        lines.append((at, block.end(1)))
        joined = "".join(text[a:b] for a, b in lines)
        ends = list(accumulate(b - a for a, b in lines))
        starts = [0, *ends[:-1]]
        found = set()
        for data, origin, chars, size in _decodings(joined):
            def place(end: int) -> int:
                return origin - (-end * chars // size)

            for kind, start, end in _armored(data):
                while data[end:end + 1].isspace():
                    end += 1
                found.add((bisect_right(starts, origin + start * chars // size) - 1, bisect_left(ends, place(end)), kind))
            for line, start in enumerate(starts):
                if start >= origin and (start - origin) % chars == 0 and (start - origin) // chars * size < len(data):
                    key = _key_at(data, (start - origin) // chars * size)
                    if key and key[0] <= len(data):
                        last = bisect_left(ends, place(key[0]))
                        if last < len(ends) and ends[last] == place(key[0]) and (kind := key[1]()):
                            found.add((line, last, kind))
        out += [(lines[a][0], block.end() if b == len(lines) - 1 else lines[b][1], kind) for a, b, kind in sorted(found) if a < b]
    return out


def spans(text: str) -> list[tuple[str, int, int, str | None]]:
    """(kind, start, end, confirmed structure or None), by start, then kind as listed."""
    out = []
    wrapped = wrapped_keys(text) if "\n" in text or "\\n" in text else []
    begun = {start: kind for start, _, kind in wrapped}
    small = text.lower()
    if any(n in small for n in _NAMES):
        for m in _ASSIGN.finditer(text):
            if len(value := m.group(2)) >= 8:
                token = value.split(".")  # as a whole, it may also use the other base64 alphabet
                found = token_algorithm(*token[:2]) if len(token) == 3 else None
                found = found or next((a for _, _, a in tokens(value)), None)
                out.append(("assign", m.start(), m.end(), found or _decoded(value) or begun.get(m.start(2))))
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    armored = []
    if "-----BEGIN " in text:
        for m in _ARMOR.finditer(text):
            if found := _unarmored(m.group(2)):
                out.append(("armor", m.start(), m.end(), found))
                armored.append((m.start(), m.end()))
    out += [("token", *t) for t in tokens(text)]
    inside = lambda start, end: any(a <= start and end <= b for a, b in armored)
    keys = [(start, end, kind) for start, end, kind in wrapped if not inside(start, end)]
    out += [("key", *k) for k in keys]
    seen = {k[:2] for k in keys}
    if _LONG.search(text):
        out += [("hex", m.start(), m.end(), _decoded(m.group()) or begun.get(m.start())) for m in _HEX.finditer(text)]
        for pattern, decode in ((_RUN16, lambda x: bytes.fromhex(x[:len(x) // 2 * 2])), (_RUN64, _unbase64)):
            for m in pattern.finditer(text):
                if m.span() not in seen and not inside(*m.span()) and (found := key_format(decode(m.group()))):
                    seen.add(m.span())
                    out.append(("key", m.start(), m.end(), found))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("structure", T.StringType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("structure", pa.string())]))


def scanned(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all), then ``spans``: array of kind, start, end, structure."""
    keep = list(df.columns) if keep is None else keep
    body, found = fresh(df, "__text"), fresh(df, "spans")
    src = df.select(*[df[quoted(c)] for c in keep], text_of(df, text).alias(body))
    kind = df.select(*[df[quoted(c)] for c in keep]).schema.add(found, SPANS)
    names = ("kind", "start", "end", "structure")

    def batches(it):
        for batch in it:
            rows = [[dict(zip(names, s)) for s in spans(t.as_py())] for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(rows, _ARROW)], names=[f.name for f in kind])

    return in_arrow(src, batches, kind)
