"""Secrets in texts: patterns, and candidates that are decoded and parsed before they are reported."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import beside_row_key, fresh, text_chunks, text_or_empty, with_row_key

#: The base patterns. Only ASCII letters match in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: No shorter run can match by itself, so the least length may stand in the pattern.
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20}
NAMES = (b"passw", b"secret", b"token", b"api")
#: Kinds in the order that breaks ties: the base ones, then those that structure confirms.
KINDS = ("assign", "access", "hex", "key", "jwt")

RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{64,}")
ARMOR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]+)-----")
URL_SAFE = str.maketrans("-_", "+/")
#: First bytes of an OpenSSH private key, and lengths of signatures in bytes by algorithm.
OPENSSH = b"openssh-key-v1\0"
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "none": 0}
#: Object identifiers 1.2.840.113549.1.5 and 1.2.840.113549.1.12 of encrypted key containers.
ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c"))


class Malformed(ValueError):
    """The bytes do not have the structure that was looked for."""


class View:
    """Bytes that a run of base64 or hex characters stands for; decodes only what is asked for."""

    def __init__(self, chars: str, start: int, stop: int, encoding: str):
        self.chars, self.start, self.encoding = chars, start, encoding
        n = stop - start
        self.n = n // 2 if encoding == "hex" else n * 6 // 8

    def read(self, at: int, n: int) -> bytes:
        if at < 0 or n < 0 or at + n > self.n:
            raise Malformed
        if self.encoding == "hex":
            return bytes.fromhex(self.chars[self.start + 2 * at : self.start + 2 * (at + n)])
        first, last = at // 3, -(-(at + n) // 3)
        part = self.chars[self.start + 4 * first : min(self.start + 4 * last, self.start + self.width(self.n))]
        whole = base64.b64decode(part.translate(URL_SAFE) + "=" * (-len(part) % 4))
        return whole[at - 3 * first : at - 3 * first + n]

    def width(self, n: int) -> int:
        """Characters that hold the first ``n`` bytes."""
        return 2 * n if self.encoding == "hex" else -(-8 * n // 6)


def _element(view: View, at: int, stop: int) -> tuple[int, int, int]:
    """Tag, start and end of the content of the DER element at ``at``; it must end by ``stop``."""
    tag, size = view.read(at, 2)
    at += 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4:
            raise Malformed
        size = int.from_bytes(view.read(at, n), "big")
        if size < 0x80 or size >> 8 * (n - 1) == 0:  # DER has the shortest form only
            raise Malformed
        at += n
    if at + size > stop:
        raise Malformed
    return tag, at, at + size


def _elements(view: View, at: int, stop: int, most: int = 12) -> list[tuple[int, int, int]]:
    """All elements that fill ``at`` to ``stop`` exactly."""
    out = []
    while at < stop:
        if len(out) == most:
            raise Malformed
        out.append(_element(view, at, stop))
        at = out[-1][2]
    return out


def _positive(view: View, at: int, stop: int) -> bool:
    head = view.read(at, min(2, stop - at))
    return bool(head) and head[0] < 0x80 and (len(head) == 1 or head[0] > 0 or head[1] >= 0x80)


def der_key(view: View) -> tuple[str, int]:
    """Kind of the private key at the beginning of the bytes, and its length; ``Malformed`` if there is none.

    Lengths must nest exactly. Recognised: PKCS#1, PKCS#8 with and without encryption, SEC 1 and DSA.
    """
    if view.n < 32 or view.read(0, 1) != b"\x30":
        raise Malformed
    _, at, end = _element(view, 0, view.n)
    parts = _elements(view, at, end)
    tags = [tag for tag, _, _ in parts]
    if tags[:2] == [0x30, 0x04] and len(parts) == 2:
        oid = _elements(view, *parts[0][1:])[0]
        if oid[0] == 0x06 and view.read(oid[1], oid[2] - oid[1]).startswith(ENCRYPTION) and parts[1][2] - parts[1][1] >= 8:
            return "pkcs8-encrypted", end
        raise Malformed
    if len(parts) < 3 or tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        raise Malformed
    version = view.read(parts[0][1], 1)[0]
    if version <= 1 and tags[1:3] == [0x30, 0x04] and set(tags[3:]) <= {0xA0, 0x81, 0xA1}:
        oid = _elements(view, *parts[1][1:])[0]
        if oid[0] == 0x06 and 3 <= oid[2] - oid[1] <= 16 and parts[2][2] - parts[2][1] >= 16:
            return "pkcs8", end
    if version == 1 and tags[1] == 0x04 and set(tags[2:]) <= {0xA0, 0xA1} and 16 <= parts[1][2] - parts[1][1] <= 72:
        return "sec1", end
    numbers = all(tag == 0x02 and _positive(view, a, b) for tag, a, b in parts[1:9])
    if version <= 1 and numbers and len(parts) == 9 + version:
        modulus, exponent = parts[1], parts[2]
        odd = all(view.read(stop - 1, 1)[0] & 1 for _, _, stop in (modulus, exponent))
        if odd and modulus[2] - modulus[1] >= 64 and parts[3][2] - parts[3][1] <= modulus[2] - modulus[1]:
            return "pkcs1", end
    if version == 0 and numbers and len(parts) == 6 and parts[1][2] - parts[1][1] >= 64:
        return "dsa", end
    raise Malformed


def openssh_key(view: View) -> tuple[str, int]:
    """Like :func:`der_key` for the length-prefixed OpenSSH format."""
    if view.read(0, len(OPENSSH)) != OPENSSH:
        raise Malformed
    at = len(OPENSSH)

    def string() -> tuple[int, int]:
        nonlocal at
        n = int.from_bytes(view.read(at, 4), "big")
        start, at = at + 4, at + 4 + n
        if at > view.n:
            raise Malformed
        return start, n

    cipher = view.read(*string())
    for _ in range(2):
        string()
    keys = int.from_bytes(view.read(at, 4), "big")
    at += 4
    if not 1 <= keys <= 16:
        raise Malformed
    for _ in range(keys):
        start, n = string()
        inner = int.from_bytes(view.read(start, 4), "big")
        if inner + 4 > n or not view.read(start + 4, min(inner, 64)).isascii():
            raise Malformed
    start, n = string()
    if n < 8 or (cipher == b"none" and view.read(start, 4) != view.read(start + 4, 4)):
        raise Malformed
    return "openssh", at


def _private(view: View) -> tuple[str, int] | None:
    for parse in (der_key, openssh_key):
        try:
            return parse(view)
        except (Malformed, binascii.Error, IndexError):
            pass
    return None


def _armored(text: str) -> Iterator[tuple[int, int, str]]:
    """Private keys between BEGIN and END lines, with their decoded content confirmed."""
    begin = None
    for mark in ARMOR.finditer(text):
        if mark[1] == "BEGIN":
            begin = mark
            continue
        if begin is not None and begin[2] == mark[2] and "PRIVATE KEY" in mark[2]:
            body = text[begin.end() : mark.start()].replace("\\r", "").replace("\\n", "\n")
            fields = [line for line in body.splitlines() if ":" in line]
            packed = "".join("".join(line.split()) for line in body.splitlines() if ":" not in line)
            if re.fullmatch(r"[A-Za-z0-9+/]+={0,2}", packed) and len(packed.rstrip("=")) % 4 != 1:
                view = View(packed, 0, len(packed.rstrip("=")), "base64")
                wrapped = any(f.startswith("Proc-Type: 4,ENCRYPTED") for f in fields)
                if wrapped and any(f.startswith("DEK-Info: ") for f in fields) and view.n >= 32 and view.n % 8 == 0:
                    yield begin.start(), mark.end(), "pem-encrypted"
                elif (found := _private(view)) is not None and found[1] == view.n:
                    yield begin.start(), mark.end(), found[0]
        begin = None


def _token(text: str, start: int, stop: int) -> tuple[int, int, str] | None:
    """The signed token whose header lies in the run ``start`` to ``stop`` and is followed by a dot."""
    start = max(start, text.rfind("+", start, stop) + 1, text.rfind("/", start, stop) + 1)
    found = [at for at in (text.find("ey", start, stop), text.find("ew", start, stop)) if at >= 0]
    if not found or text[stop : stop + 1] != ".":
        return None
    start = min(found)
    body = re.compile(r"[A-Za-z0-9_-]+").match(text, stop + 1)
    if body is None or text[body.end() : body.end() + 1] != ".":
        return None
    try:
        header = json.loads(_url_decoded(text[start:stop]))
        alg = header.get("alg") if isinstance(header, dict) else None
        if not isinstance(alg, str) or not isinstance(json.loads(_url_decoded(body[0])), dict):
            return None
    except (ValueError, RecursionError):
        return None
    sign = re.compile(r"[A-Za-z0-9_-]*").match(text, body.end() + 1)
    size = len(sign[0]) * 6 // 8
    if alg in SIGNATURES:
        right = size == SIGNATURES[alg]
    elif alg == "EdDSA":
        right = size in (64, 114)
    else:
        right = size >= 128 and size % 8 == 0 if alg[:2] in ("RS", "PS") else size >= 16
    return (start, sign.end(), f"jwt {alg}") if right else None


def _url_decoded(part: str) -> bytes:
    return base64.b64decode(part.translate(URL_SAFE) + "=" * (-len(part) % 4), validate=True)


def _structured(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Kind, start, end and detail of the secrets whose structure is confirmed. Armored keys are not reported twice."""
    armored = sorted(_armored(text)) if "-----BEGIN " in text else []
    for start, stop, detail in armored:
        yield "key", start, stop, detail
    edges = iter([*armored, (len(text), len(text), "")])
    low, high, _ = next(edges)

    def inside(at: int) -> bool:
        nonlocal low, high
        while at >= high and low < len(text):
            low, high, _ = next(edges)
        return low <= at < high

    for run in RUN.finditer(text):
        start, stop = run.span()
        if inside(start):
            continue
        if (token := _token(text, start, stop)) is not None:
            yield "jwt", *token
        yield from _keys(text, start, stop, "base64", re.compile(r"M[A-P]|b3BlbnNzaC1rZXk"))
    edges = iter([*armored, (len(text), len(text), "")])
    low, high, _ = next(edges)
    for run in HEX_RUN.finditer(text):
        if not inside(run.start()):
            yield from _keys(text, *run.span(), "hex", re.compile(r"30|6f70656e737368", re.I))


def _keys(text: str, start: int, stop: int, encoding: str, head: re.Pattern) -> Iterator[tuple[str, int, int, str]]:
    """Keys that begin anywhere in a run: each beginning is judged by a few bytes, so a run takes linear time."""
    at = start
    while (mark := head.search(text, at, stop)) is not None:
        at = mark.start() + 1
        view = View(text, mark.start(), stop, encoding)
        if view.n >= 32 and (found := _private(view)) is not None:
            at = mark.start() + view.width(found[1])
            end = at
            while encoding == "base64" and end < at + (-(at - mark.start()) % 4) and text[end : end + 1] == "=":
                end += 1
            yield "key", mark.start(), end, found[0]


def secrets_in(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end (code points, exclusive) and detail of every secret, by start, then kind as in ``KINDS``."""
    found = []
    folded = text.encode(errors="surrogatepass").lower()  # folds ASCII letters alone
    if any(name in folded for name in NAMES):
        found += [("assign", *m.span(), m[1].lower()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", *m.span(), "") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span(), "") for m in HEX.finditer(text)]
    found += _structured(text)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS = "array<struct<kind:string,start:long,end:long,detail:string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())]))
    for batch in text_chunks(batches):
        rows = [[dict(zip(("kind", "start", "end", "detail"), s, strict=True)) for s in secrets_in(t)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(rows, kind)], [*(c for c in batch.schema.names if c != "text"), "secrets"])


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``secrets`` of every row: an array of kind, start, end (code points, end exclusive) and detail.

    Base kinds come from patterns, leftmost and without overlap within a kind: ``assign`` (a named value of 6 characters or
    more), ``access`` (AKIA, 20 or more), ``hex`` (24 or more). The other kinds are reported after structural confirmation
    only: ``key`` where base64 or hex characters, armored or not, decode to a private key whose nested lengths
    fit exactly; ``jwt`` where the header and the payload of three dotted parts are JSON objects, the header names an
    algorithm and the signature has that algorithm's length. Spans of different kinds may overlap.

    Whole texts are read, of any length, in time linear in it. A null or empty text has no secret; null and repeated ids and
    repeated rows stay as they come; an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(_scan, f"doc_id long, secrets {SPANS}")


def redact_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every maximal run of overlapping secrets in ``text`` replaced by ``mask``; all rows and columns stay."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            keep, out = [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                if spans := secrets_in(t):
                    parts, at, end = [], 0, 0
                    for _, a, b, _ in spans:
                        if a >= end:
                            parts += [t[at if at == 0 else end : a], mask]
                        at, end = 1, max(end, b)
                    keep.append(i)
                    out.append("".join(parts) + t[end:])
            yield pa.RecordBatch.from_arrays([batch.column("k1").take(pa.array(keep, pa.int64())), batch.column("k2").take(pa.array(keep, pa.int64())), pa.array(out, pa.string())], ["k1", "k2", "masked"])

    keyed = with_row_key(docs, doc_id, text)
    (new,) = fresh(docs, "masked")
    changed = keyed.select("k1", "k2", "text").mapInArrow(cover, "k1 long, k2 long, masked string").dropDuplicates(["k1", "k2"]).withColumnRenamed("masked", new)
    rows, changed, key = beside_row_key(docs, changed, doc_id, text)
    return rows.join(changed, key, "left").withColumn(text, F.coalesce(new, text)).select(*docs.columns)
