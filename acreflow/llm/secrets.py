"""Secret scans: pattern matches, and structural confirmation of what decodes to a key or a signed token.

Base kinds are three patterns.  On top of them, every run that could be base64, base64url or hexadecimal is
decoded and parsed: private keys in DER (PKCS#1, PKCS#8 plain with its inner key or encrypted, SEC1) with all nested
lengths adding up exactly, OpenSSH private keys with their length-prefixed fields, and tokens of three
dot-separated parts whose first part is a JSON header that names an algorithm.  A run that fails as a whole is
tried again from where a key or a header can begin behind a separator; for that it is decoded once for each of the four
ways in which such a place can lie in it, and what begins there is parsed in place.  Only confirmed ones are reported.  Texts
are first narrowed down on their raw bytes, which can pass too many but never too few.  Scanning is linear in a text.

Structures have bounds of their own: a DER key has at most ``MOST_PARTS`` elements (keys of algorithms not known here
``MOST_UNKNOWN``), an OpenSSH file at most 32 keys, and a token's header is nested no deeper than the JSON parser goes.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreflow.llm.textblocks import LOWER, slices, tidy

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_CODED = 6, 20, 24, 40
BASE_KINDS = ("assign", "access", "hex")
#: In the order in which spans with one start are listed.
KINDS = (*BASE_KINDS, "key", "jwt")

_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,60})-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")
#: Line ends in a PEM body, as they are or escaped as in JSON.
_BREAKS = re.compile(r"\\[nrt]|\s+")
_CODED = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_CODED)
#: Where a DER sequence or an OpenSSH key can begin behind a separator inside a run.
_INNER_KEY = re.compile(r"(?<=[/_-])(?:M[C-I]|b3BlbnNzaC1rZXktdjE)")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{%d,}" % (2 * MIN_CODED))
#: Three dot-separated parts; looked for at each run of such characters, so runs that follow one another are all tried.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*))")
_INNER_TOKEN = re.compile(r"[_-](?=ey[A-Za-z0-9_-]{8})")
#: Quotes, those behind an odd number of backslashes among them.
_QUOTE = re.compile(r'(?<!\\)\\*"')
_scan_json = json.JSONDecoder().raw_decode
#: PKCS#1 has nine elements and one more for further primes, the others fewer.
MOST_PARTS, MOST_UNKNOWN = 12, 64


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_LOWER_HEX = _class("0123456789abcdef")
_CODED_BYTES = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-.")


def _der_item(b: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, first byte, end) of the element at ``at``; None if its length does not fit."""
    if at + 2 > end:
        return None
    tag, n = b[at], b[at + 1]
    at += 2
    if n & 0x80:
        k = n & 0x7F
        if not 0 < k <= 4 or at + k > end or b[at] == 0:
            return None
        n = int.from_bytes(b[at : at + k], "big")
        if n < 0x80:
            return None
        at += k
    return (tag, at, at + n) if at + n <= end else None


def _der_children(b: bytes, at: int, end: int, most: int = MOST_PARTS) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly; None if they do not, or are more than ``most``."""
    out = []
    while at < end:
        item = _der_item(b, at, end)
        if item is None or len(out) == most:
            return None
        out.append(item)
        at = item[2]
    return out


def _is_number(b: bytes, part: tuple[int, int, int], *values: int) -> bool:
    """Whether an element is one byte with one of these values."""
    return part[2] - part[1] == 1 and b[part[1]] in values


#: Object identifiers as DER writes them.
_RSA, _EC, _DSA, _DH = (bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2a8648ce380401", "2a864886f70d010301"))
_EDWARDS = tuple(bytes.fromhex(x) for x in ("2b656e", "2b656f", "2b6570", "2b6571"))
_PASSWORD_BASED = tuple(bytes.fromhex(x) for x in ("2a864886f70d0105", "2a864886f70d010c"))


def _pkcs1(b: bytes, parts: list[tuple[int, int, int]]) -> bool:
    whole = len(parts) >= 9 and all(t == 0x02 for t, _, _ in parts[:9]) and all(t == 0x30 for t, _, _ in parts[9:])
    return whole and _is_number(b, parts[0], 0, 1) and parts[1][2] - parts[1][1] >= 32


def _sec1(b: bytes, parts: list[tuple[int, int, int]]) -> bool:
    tags = [t for t, _, _ in parts]
    return tags[:2] == [0x02, 0x04] and _is_number(b, parts[0], 1) and parts[1][2] - parts[1][1] >= 16 and set(tags[2:]) <= {0xA0, 0xA1}


def _inner_key(oid: bytes, b: bytes, at: int, end: int) -> bool:
    """Whether ``at`` to ``end`` is what the private key field of PKCS#8 holds for an algorithm; for one not known here, any one element."""
    top = _der_item(b, at, end)
    if top is None or top[2] != end:
        return False
    if oid in _EDWARDS:
        return top[0] == 0x04 and top[2] - top[1] in (32, 56, 57)
    if oid in (_DSA, _DH):
        return top[0] == 0x02 and top[2] - top[1] >= 16
    parts = _der_children(b, top[1], top[2], MOST_PARTS if oid in (_RSA, _EC) else MOST_UNKNOWN) if top[0] == 0x30 else None
    if oid == _RSA:
        return bool(parts) and _pkcs1(b, parts)
    if oid == _EC:
        return bool(parts) and _sec1(b, parts)
    return bool(parts) or (top[0] in (0x02, 0x04) and top[2] - top[1] >= 16)


def der_key(b: bytes, at: int = 0, end: int | None = None) -> str | None:
    """The encoding of the key that ``b`` is from ``at`` to ``end``, nested lengths and the inner key included, or None."""
    end = len(b) if end is None else end
    top = _der_item(b, at, end)
    if top is None or top[0] != 0x30 or top[2] != end:
        return None
    parts = _der_children(b, top[1], top[2])
    if not parts:
        return None
    tags = [p[0] for p in parts]
    if _pkcs1(b, parts):
        return "pkcs1"
    if _sec1(b, parts):
        return "sec1"
    at = 1 if tags[:3] == [0x02, 0x30, 0x04] else 0 if tags == [0x30, 0x04] else -1
    algorithm = _der_children(b, parts[at][1], parts[at][2]) if at >= 0 else None
    if not algorithm or algorithm[0][0] != 0x06 or not 3 <= algorithm[0][2] - algorithm[0][1] <= 64:
        return None
    oid, (_, begin, stop) = b[algorithm[0][1] : algorithm[0][2]], parts[at + 1]
    if at and _is_number(b, parts[0], 0, 1) and set(tags[3:]) <= {0xA0, 0xA1, 0x81} and _inner_key(oid, b, begin, stop):
        return "pkcs8"
    return "pkcs8, encrypted" if not at and oid.startswith(_PASSWORD_BASED) and stop - begin >= 32 else None


def openssh_key(b: bytes, at: int = 0) -> bool:
    """Whether ``b`` is an OpenSSH private key from ``at`` on: a magic, three strings, a count and that many key blobs."""
    magic = b"openssh-key-v1\0"
    if not b.startswith(magic, at):
        return False
    at += len(magic)
    count = 0
    for i in range(64):
        if at + 4 > len(b):
            return False
        n = int.from_bytes(b[at : at + 4], "big")
        at += 4
        if i == 3:
            if not 1 <= n <= 32:
                return False
            count = n
            continue
        at += n
        if at > len(b):
            return False
        if i > 3 and i - 4 == count:  # after the public keys the private part
            return at == len(b)
    return False


def _decoded(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_key(b: bytes | None) -> bool:
    return bool(b) and (der_key(b) is not None or openssh_key(b))


def is_signed_token(run: str) -> bool:
    """Three parts; the first two JSON objects, the first naming an algorithm as a string; a signature unless it is none."""
    parts = run.split(".")
    try:
        header, claims = (json.loads(_decoded(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(claims, dict) and isinstance(header.get("alg"), str) and (len(parts[2]) >= 16 or header["alg"].lower() == "none")


def _object_end(text: str, at: int) -> tuple[int, bool]:
    """(where the JSON object that begins at ``at`` ends, True), or (where reading it fails, False).

    Read from pieces that grow, as an error costs what lies before it in its piece.
    """
    size = 256
    while True:
        piece, rest = text[at : at + size], at + size < len(text)
        try:
            return at + _scan_json(piece, 0)[1], True
        except json.JSONDecodeError as e:
            if not rest or (e.pos < len(piece) - 16 and not e.msg.startswith("Unterminated")):
                return at + e.pos, False
        size *= 8


def _closing(text: str, starts: list[int]) -> list[int]:
    """Those of ``starts`` (ascending) from where a JSON object reaches to the end of ``text``.

    What one try has read outside of strings the next need not read again: an object that begins there ends within it or fails
    with it.  Of tries that begin inside the strings of others the same holds, so each character is read a few times.
    """
    end, out, covered = len(text.rstrip()), [], [0, 0]
    quotes = [m.end() - 1 for m in _QUOTE.finditer(text) if (m.end() - m.start()) % 2]
    side = lambda p: bisect_left(quotes, p) & 1
    for i, p in enumerate(starts):
        c = side(p)
        if p < covered[c]:
            continue
        try:
            covered[c], whole = _object_end(text, p)
            if whole and covered[c] == end:
                out.append(p)
        except RecursionError:  # nested too deep from here on; one further in may not be
            inside, low = [q for q in starts[i:] if side(q) == c], 0
            high = len(inside)
            while high - low > 1:
                mid = (low + high) // 2
                try:
                    _object_end(text, inside[mid])
                    high = mid
                except RecursionError:
                    low = mid
            covered[c] = inside[high] if high < len(inside) else end
    return out


def _inner_token(run: str) -> int:
    """Where in a run a token begins behind a separator; -1 if none does."""
    dot = run.index(".")
    openings = [m.end() for m in _INNER_TOKEN.finditer(run, 0, dot)]
    found = []
    for r in {at % 4 for at in openings}:
        data = _decoded(run[r:dot]) or b""  # None where nothing that begins here can end at the dot
        own = [at for at in openings if at % 4 == r]
        ends = set(_closing(data.decode("latin-1"), [(at - r) // 4 * 3 for at in own])) if data else ()
        found += [at for at in own if (at - r) // 4 * 3 in ends]
    return next((at for at in sorted(found) if is_signed_token(run[at:])), -1)


def _inner_der(run: str) -> tuple[int, int] | None:
    """(start, end) of the first key inside a run behind a separator.  The length that opens a sequence says how far it has to go."""
    decoded: dict[int, bytes] = {}
    whole = len(run.rstrip("="))

    def data(at: int) -> bytes:
        r = at % 4
        if r not in decoded:
            decoded[r] = _decoded(run[r : whole - ((whole - r) % 4 == 1)]) or b""
        return decoded[r]

    for m in _INNER_KEY.finditer(run):
        at, begin = m.start(), m.start() // 4 * 3
        if run[at] != "M":
            if (whole - at) % 4 != 1 and openssh_key(data(at), begin):
                return at, len(run)
            continue
        opening = _decoded(run[at : at + 12]) or b""
        k = opening[1] & 0x7F if len(opening) == 9 and opening[1] & 0x80 else 0
        if len(opening) < 9 or k > 4 or opening[2 + k] not in (0x02, 0x30):
            continue
        n = 2 + k + (int.from_bytes(opening[2 : 2 + k], "big") if k else opening[1])
        end = at + (4 * n + 2) // 3
        if end - at < MIN_CODED or end > len(run):
            continue
        if begin + n <= len(data(at)) and der_key(data(at), begin, begin + n):
            return at, end if run[end:].strip("=") else len(run)
    return None


def base_spans(text: str, kinds: frozenset = frozenset(BASE_KINDS)) -> list[tuple[int, int, int, int]]:
    """(start, rank of the kind, end, start of the secret itself): leftmost non-overlapping of each kind."""
    out = []
    if "assign" in kinds:
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "access" in kinds:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if "hex" in kinds:
        out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return out


class _Taken:
    """Spans that do not overlap, in order."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, a: int, b: int) -> bool:
        i = bisect_right(self.starts, a)
        return not (i and self.ends[i - 1] > a) and not (i < len(self.starts) and self.starts[i] < b)

    def add(self, a: int, b: int) -> None:
        i = bisect_right(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def confirmed_spans(text: str) -> list[tuple[int, int, int, int]]:
    """Spans that decode to a key (3) or a signed token (4)."""
    out, taken = [], _Taken()

    def report(a: int, kind: int, b: int) -> None:
        out.append((a, kind, b, a))
        taken.add(a, b)

    for m in _PEM.finditer(text):
        if is_key(_decoded(_BREAKS.sub("", m[2]))):
            report(m.start(), 3, m.end())
    for m in _JWT.finditer(text):
        if is_signed_token(m[1]):
            inner = 0
        elif (inner := _inner_token(m[1])) < 0:
            continue
        if taken.free(m.start() + inner, m.end(1)):
            report(m.start() + inner, 4, m.end(1))
    for pattern, decode in ((_HEX_ANY, lambda r: bytes.fromhex(r) if len(r) % 2 == 0 else None), (_CODED, _decoded)):
        for m in pattern.finditer(text):
            if not taken.free(m.start(), m.end()):
                continue
            if is_key(decode(m[0])):
                report(m.start(), 3, m.end())
            elif pattern is _CODED and (inside := _inner_der(m[0])):
                report(m.start() + inside[0], 3, m.start() + inside[1])
    return out


def spans_of(text: str | None) -> list[tuple[int, int, int, int]]:
    """All spans of one text, sorted; the plain form of what the operator does on narrowed-down texts."""
    return sorted(base_spans(text or "") + confirmed_spans(text or ""))


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Where runs of at least ``least`` set bytes of one text begin."""
    shift = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
    shift, bounds = np.flatnonzero(shift), offsets[1:-1]
    bounds = np.unique(bounds[(bounds > 0) & (bounds < len(mask))])
    bounds = bounds[mask[bounds - 1] & mask[bounds]]  # a run across a bound ends and begins there
    edge = np.sort(np.concatenate((shift, bounds, bounds)))
    return edge[::2][edge[1::2] - edge[::2] >= least]


def _found(data: bytes, needle: bytes) -> list[int]:
    out, at = [], data.find(needle)
    while at >= 0:
        out.append(at)
        at = data.find(needle, at + 1)
    return out


def _scan(column: pa.Array) -> Iterator[list[tuple[int, int, int, int]]]:
    """The sorted spans of each text of a column."""
    for first, _, raw, offsets in slices(column):
        data, low = raw.tobytes(), LOWER[raw].tobytes()
        where = {
            "assign": [x for w in (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key") for x in _found(low, w)],
            "access": _found(data, b"AKIA"),
            "hex": _runs(_LOWER_HEX[raw], offsets, MIN_HEX),
            "coded": [*_runs(_CODED_BYTES[raw], offsets, MIN_CODED - 20), *_found(data, b"-----BEGIN ")],
        }
        todo: dict[int, set[str]] = {}
        for kind, at in where.items():
            for i in np.unique(np.searchsorted(offsets, np.asarray(at, np.int64), "right") - 1).tolist():
                todo.setdefault(i, set()).add(kind)
        for i in range(len(offsets) - 1):
            kinds = todo.get(i)
            if kinds is None:
                yield []
                continue
            text = column[first + i].as_py()
            yield sorted(base_spans(text, frozenset(kinds)) + (confirmed_spans(text) if "coded" in kinds else []))


def _listed(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.int64())]))


def _with_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[{"kind": KINDS[k], "start": a, "end": b, "secret": s} for a, k, b, s in x] for x in _scan(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SPANS)], ["doc_id", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, secret>>), a row for each row of ``docs`` (doc_id, text, more).

    Positions count code points, end exclusive; ``secret`` is where the secret itself begins, which is later
    than ``start`` for an assignment.  Null, empty and blank texts have no spans.  Repeated rows and null ids
    are rows like any other; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_with_spans, "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint, secret: bigint>>")


def secret_digest(docs: DataFrame) -> DataFrame:
    """The spans of ``find_secrets`` as counts, a digest of the base spans, and one string."""
    spans = find_secrets(docs)
    kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans.select("doc_id", *(kind(k) for k in KINDS), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redacted(text: str, spans: list[tuple[int, int, int, int]], mark: str) -> str:
    """``text`` with the secrets replaced; overlapping ones by one mark."""
    out, at = [], 0
    for a, b in sorted((s, b) for _, _, b, s in spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced by ``mark``; all rows and columns stay.  Where a
    column n_chars is there, it counts the code points of the new text."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            new = {i: redacted(column[i].as_py(), s, mark) for i, s in enumerate(_scan(column)) if s}
            if new:
                text = column.to_pylist()
                for i, x in new.items():
                    text[i] = x
                fresh = pa.array(text, column.type)
                at = batch.schema.get_field_index("text")
                arrays = [fresh if j == at else batch.column(j) for j in range(batch.num_columns)]
                if (n := batch.schema.get_field_index("n_chars")) >= 0:
                    changed = pa.array([i in new for i in range(len(text))], pa.bool_())
                    arrays[n] = pc.if_else(changed, pc.utf8_length(fresh).cast(arrays[n].type), arrays[n])
                batch = pa.RecordBatch.from_arrays(arrays, batch.schema.names)
            yield batch

    return docs.mapInArrow(run, docs.schema)
