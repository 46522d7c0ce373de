"""Secret scans with structural confirmation.

Three base kinds are found by pattern: ``assign`` (a secret's name given a value of 12 or more characters), ``access``
(an access key id of 18 or more) and ``hex`` (16 or more hexadecimal digits). Longer encoded candidates are decoded and
reported only if what they hold has the structure of a credential:

* ``jwt``: three base64url parts; the first decodes to a JSON object that names an algorithm, the second to a JSON object;
* ``der``: base64 or hex (a PEM body, or bare) of an ASN.1 sequence whose nested lengths fit exactly and whose fields are
  those of a PKCS#1, PKCS#8 (encrypted too), SEC1 or DSA private key;
* ``ssh``: base64 or hex of an OpenSSH private key, whose length-prefixed fields fit.

Keys are decoded wherever one can begin, also glued to what is before or behind it, in plain or url-safe base64, over
several lines, and with line ends as JSON escapes. Not parsed: a bare key broken within its first ten characters, hex with
signs between the digits, PEM bodies with header lines, PuTTY and PKCS#12 files, and other encodings (base32, percent signs).

Spans are (kind, start, end) in code points, end exclusive, sorted by start and then kind in the order of ``KINDS``.
Defined cases: a null text is empty and has no spans; ids may be null or repeat, every row gives a row; other columns
are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.common import slices, small_batches, texts

KINDS = ("assign", "access", "hex", "jwt", "der", "ssh")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

# The patterns that the contract states.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

NAMES = ("password", "passwd", "secret", "token", "api")
DOTTED = re.compile(r"[A-Za-z0-9_.-]+")
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]++|\\++[nrt/])++)-----END [A-Z ]*PRIVATE KEY-----")
BREAK = re.compile(r"[^\S\r\n]*(?:[\r\n]|\\+[nr])(?:\s|\\+[nrt])*|\\+(?=/)")  #: inside a bare key
BLANK = re.compile(r"\s+|\\+[nrt]|\\+(?=/)")  #: inside a PEM body
# How a key's first bytes look: a sequence with a version (or, encrypted, with a sequence), or the start of SSH_MAGIC.
BASE64_START = re.compile(r"M(?:[A-H][AEIMQUYcgkosw048]CAQ|I(?:[E-H].(?:AgE|M[A-I])|[I-L].(?:..IB|.[DTjz][ABI])|[M-P]....CAQ|[Q-T].....AgE))|b3BlbnNzaC1rZXktdj")
HEX_START = re.compile(r"30(?:[0-7].|81..|82.{4}|83.{6}|84.{8})(?:02010[01]|30)|6f70656e7373682d6b65792d7631", re.IGNORECASE)
BASE64_PART, HEX_PART = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[0-9A-Fa-f]+")
URL_SAFE = str.maketrans("-_", "+/")
# Object identifiers of password-based encryption (PKCS#5, PKCS#12).
ENCRYPTED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SSH_MAGIC = b"openssh-key-v1\x00"
PADDING = re.compile("={0,2}")
_QUOTES = re.compile(r'(?<!\\)(?:\\\\)*"')
_parse = json.JSONDecoder().raw_decode


MOST = 64  #: elements that are read side by side; keys have ten or so


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER elements that fill a stretch exactly, else None. Nothing is copied."""
    out = []
    while at < end:
        if at + 2 > end or len(out) == MOST:
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end or data[at] == 0:
                return None
            n = int.from_bytes(data[at : at + k], "big")
            at += k
            if n < 0x80:
                return None
        if at + n > end:
            return None
        out.append((tag, at, at + n))
        at += n
    return out


def der_length(data: bytes, at: int = 0) -> int:
    """Bytes of the PKCS#1, PKCS#8, SEC1 or DSA private key that begins at a place, 0 if none does."""
    if at + 2 > len(data) or data[at] != 0x30:
        return 0
    k = data[at + 1] & 0x7F if data[at + 1] & 0x80 else 0
    end = at + 2 + k + (int.from_bytes(data[at + 2 : at + 2 + k], "big") if k else data[at + 1])
    outer = _elements(data, at, end) if k <= 4 and end <= len(data) else None
    return end - at if outer and len(outer) == 1 and _is_key(data, *outer[0][1:]) else 0


def _is_key(data: bytes, at: int, end: int) -> bool:
    fields = _elements(data, at, end)
    if not fields:
        return False
    tags, sizes = [t for t, _, _ in fields], [b - a for _, a, b in fields]

    def named(k: int, *names: bytes) -> bool:
        """Whether a field holds elements of which the first is an identifier that begins so."""
        inside = _elements(data, *fields[k][1:])
        return bool(inside) and inside[0][0] == 0x06 and any(data.startswith(x, inside[0][1], inside[0][2]) for x in names or (b"",))

    if tags == [0x30, 0x04]:
        return named(0, *ENCRYPTED) and sizes[1] > 0
    if tags[0] != 2:
        return False
    version = data[fields[0][1] : fields[0][2]] if sizes[0] == 1 else b""
    if tags[:3] == [0x02, 0x30, 0x04] and version in (b"\0", b"\1"):
        return named(1) and sizes[2] > 0
    if len(tags) >= 2 and tags[1] == 0x04 and version == b"\1":
        return sizes[1] >= 16 and all(t in (0xA0, 0xA1) and _elements(data, a, b) for t, a, b in fields[2:])
    if tags == [2] * 6:
        return version == b"\0" and sizes[1] >= 64
    return len(tags) >= 9 and set(tags[:9]) == {2} and version in (b"\0", b"\1") and sizes[1] >= 32


def is_private_der(data: bytes) -> bool:
    """Whether the bytes are one private key and nothing more."""
    return 0 < der_length(data) == len(data)


def ssh_length(data: bytes, start: int = 0) -> int:
    """Bytes of the OpenSSH private key that begins at a place, 0 if none does.

    It has its magic, three strings, the key count, the public key and the private block.
    """
    if not data.startswith(SSH_MAGIC, start):
        return 0
    at = start + len(SSH_MAGIC)
    for field in range(6):
        if at + 4 > len(data):
            return 0
        n = int.from_bytes(data[at : at + 4], "big")
        if field == 3 and not 1 <= n <= 64:
            return 0
        at += 4 if field == 3 else 4 + n
    return at - start if at <= len(data) else 0


def is_private_ssh(data: bytes) -> bool:
    """Whether the bytes are one OpenSSH private key and nothing more."""
    return 0 < ssh_length(data) == len(data)


def _unbase64(s: str, url: bool = False) -> bytes | None:
    s = s.rstrip("=")
    try:
        return (base64.urlsafe_b64decode if url else base64.b64decode)(s + "=" * (-len(s) % 4))
    except (binascii.Error, ValueError):
        return None


def _object(part: str) -> dict | None:
    """The JSON object that a part of a token holds, if any."""
    try:
        found = json.loads(_unbase64(part, url=True) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _object_end(body: str, at: int) -> tuple[bool, int]:
    """Whether a JSON object begins at a place, and where it ends or fails.

    It is parsed in windows that grow while the parser fails at their end, as the parser counts lines up to where it fails.
    """
    size = 256
    while True:
        try:
            return True, at + _parse(body[at : at + size])[1]
        except json.JSONDecodeError as e:
            if at + size >= len(body) or (e.pos < size - 16 and not e.msg.startswith("Unterminated")):
                return False, at + e.pos
            size *= 4
        except RecursionError:
            return False, len(body)


def _header_start(head: str) -> int | None:
    """Where in a part of a token the first JSON object begins that names an algorithm and fills the rest of the part.

    Each of the four alignments is decoded once. An object that fails at some place decides for all that begin inside it, on
    the same side of its quotes, before that place; so each place is parsed twice at most. An object nested deeper than the
    parser can go is none.
    """
    decoded: dict[int, tuple[str, list[int], list[int]]] = {}
    for m in re.finditer("eyJ", head):
        i, a = m.start(), m.start() % 4
        if (len(head) - i) % 4 == 1:
            continue
        if a not in decoded:
            body = (_unbase64(head[a:], url=True) or b"").decode("latin-1")
            decoded[a] = body, [q.end() - 1 for q in _QUOTES.finditer(body)], [0, 0]
        body, quotes, failed = decoded[a]
        at = (i - a) // 4 * 3
        side = bisect_left(quotes, at) % 2
        if at < failed[side]:
            continue
        fits, end = _object_end(body, at)
        if not fits:
            failed[side] = max(end, at + 1)
            continue
        if not body[end:].strip(" \t\n\r") and isinstance((_object(head[i:]) or {}).get("alg"), str):
            return i
        failed[side] = end
    return None


def _signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of signed tokens; a token may begin anywhere in a run of its characters."""
    for run in DOTTED.finditer(text):
        if "eyJ" not in run[0] or run[0].count(".") < 2:
            continue
        parts, at, taken = run[0].split("."), run.start(), 0
        for k, head in enumerate(parts[:-2]):
            if k >= taken and "eyJ" in head and _object(parts[k + 1]) is not None and (start := _header_start(head)) is not None:
                yield at + start, at + sum(map(len, parts[k : k + 3])) + 2
                taken = k + 3
            at += len(head) + 1


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if is_private_der(data) else "ssh" if is_private_ssh(data) else None


class _Run:
    """Characters of an encoding from a place on, over line ends, with what they decode to from each alignment."""

    def __init__(self, text: str, at: int, base: int):
        part = BASE64_PART if base == 64 else HEX_PART
        self.base, self.group, self.bytes = base, *((4, 3) if base == 64 else (2, 1))
        self.places, self.before, found, n = [], [], [], 0
        while m := part.match(text, at):
            self.places.append(at)
            self.before.append(n)
            found.append(m[0])
            n, at = n + len(m[0]), m.end()
            gap = BREAK.match(text, at)
            if not gap or not part.match(text, gap.end(), gap.end() + 1):
                break
            at = gap.end()
        self.end, self.characters, self.decoded = at, "".join(found).translate(URL_SAFE), {}

    def key(self, place: int) -> tuple[str, int] | None:
        """Kind of the key that begins at a place of the text, if one does, and the place behind it."""
        k = bisect_right(self.places, place) - 1
        i = self.before[k] + place - self.places[k]
        a = i % self.group
        if a not in self.decoded:
            rest = self.characters[a:]
            whole = rest[: len(rest) - (len(rest) % self.group == 1)]
            self.decoded[a] = (_unbase64(whole) or b"") if self.base == 64 else bytes.fromhex(whole)
        data, at = self.decoded[a], (i - a) // self.group * self.bytes
        der, ssh = der_length(data, at), ssh_length(data, at)
        if not der and not ssh:
            return None
        last = i + -(-(der or ssh) * self.group // self.bytes) - 1
        k = bisect_right(self.before, last) - 1
        return "der" if der else "ssh", self.places[k] + last - self.before[k] + 1


def _bare_keys(text: str, inside: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    inside = sorted(inside)
    for start, base in ((BASE64_START, 64), (HEX_START, 16)):
        at, run = 0, None
        while m := start.search(text, at):
            at = m.start() + 1
            k = bisect_right(inside, (m.start(), len(text))) - 1
            if k >= 0 and m.start() < inside[k][1]:
                continue
            if run is None or m.start() >= run.end:
                run = _Run(text, m.start(), base)
            if found := run.key(m.start()):
                kind, end = found
                at = PADDING.match(text, end).end() if base == 64 else end
                yield kind, m.start(), at


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text."""
    spans = []
    if ("=" in text or ":" in text) and any(name in (low := text.lower()) for name in NAMES):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "eyJ" in text:
        spans += [("jwt", a, b) for a, b in _signed_tokens(text)]
    keys = set()
    if "PRIVATE KEY-----" in text:
        keys |= {(kind, m.start(1), m.end(1)) for m in PEM.finditer(text) if (kind := _key_kind(_unbase64(BLANK.sub("", m[1]))))}
    if len(text) >= 40:
        keys |= set(_bare_keys(text, [(a, b) for _, a, b in keys]))
    return sorted([*spans, *keys], key=lambda s: (s[1], ORDER[s[0]], s[2]))


SPANS = "array<struct<kind:string,start:long,end:long>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in texts(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, _ARROW_SPANS)], names=["id", "spans"])


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``spans``."""
    rows = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scan, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with every span, overlapping or touching ones together, replaced by a mark."""
    merged: list[list[int]] = []
    for _, a, b in find_secrets(text):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept = [text[a:b] for a, b in zip([0, *(b for _, b in merged)], [*(a for a, _ in merged), len(text)])]
    return mark.join(kept)


def redact_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Documents with their secrets replaced and ``n_chars`` brought up to date; all columns and null texts stay."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            clean = [None if t is None else redact(t) for t in batch.column(text).to_pylist()]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    out = small_batches(docs).mapInArrow(rewrite, docs.schema)
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars in docs.columns else out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    for batch in batches:
        rows = [[(s["kind"], s["start"], s["end"]) for s in spans] for spans in batch.column("spans").to_pylist()]
        join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [pa.array([sum(k == kind for k, _, _ in r) for r in rows], pa.int64()) for kind in KINDS[:3]]
        base = [hashlib.sha256(join([s for s in r if s[0] in KINDS[:3]]).encode()).hexdigest() for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *counts, pa.array(base, pa.string()), pa.array([join(r) for r in rows], pa.string())], names=list(names))


def span_digests(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the spans that ``scan_secrets`` found."""
    kind = scanned.schema["id"].dataType.simpleString()
    return scanned.mapInArrow(_digests, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
