"""Secret scans: patterns find candidates, their decoded structure confirms keys and tokens."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import split_table

# The base patterns.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of [0-9a-f]+ the runs of 24 and more
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Candidates for decoding.
PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,40})-----")
PEM_HEADERS = re.compile(r"\s*+(?:[A-Za-z-]++: [^\n]*+\n\s*+)*+")
BASE64 = re.compile(r"\\[nrt]|[A-Za-z0-9+/_-]+={0,2}")  # the letter of an escape is none of a word
LEAST_64, LEAST_LINE = 40, 32  # characters of a candidate, and of a line of a wrapped one
LINE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_LINE}}}")
BREAK = re.compile(r"""(?:\\r)?(?:\\n|\r?\n)[ \t"'>|]*+|["'],?[ \t]*\r?\n[ \t]*["']""")  # a line's end, plain, escaped, or between quoted lines
HEX_ANY = re.compile(r"[0-9a-fA-F]{80,}|(?:[0-9a-fA-F]{2}:\s*+){39,}[0-9a-fA-F]{2}")
SEPARATORS = frozenset("/+-_")  # of the alphabet itself: what stands before one may be no part of the key
OFFSETS = 8  # separators near the front of a candidate that are tried
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)(?![A-Za-z0-9_-])")
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
_ORDER = {k: i for i, k in enumerate(KINDS)}
# Names that a public or private key blob of the SSH wire format starts with, and its file magic.
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_MAGIC = b"openssh-key-v1\0"

Span = tuple[str, int, int]


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER values that fill ``data`` exactly, nested lengths included; None if they don't."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or depth > 12:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if tag & 31 == 31 or size == 128:  # long tags and open lengths don't occur in keys
            return None
        if size > 128:
            k = size & 127
            if k > 4 or at + k > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + k], "big")
            if size < 128:
                return None
            at += k
        if at + size > len(data):
            return None
        content = data[at : at + size]
        if tag & 32 and der_items(content, depth + 1) is None:
            return None
        out.append((tag, content))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE that starts as a key does: a version INTEGER and more, or an algorithm with an OID and a key string."""
    top = der_items(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = der_items(top[0][1]) or []
    if len(inner) < 2:
        return False
    tag, content = inner[0]
    if tag == 2 and len(content) == 1:  # private keys: PKCS#1, SEC1, PKCS#8
        return content[0] <= 3 and inner[1][0] in (2, 4, 0x30)
    if tag == 0x30:  # an algorithm, then the key
        algorithm = der_items(content) or []
        return bool(algorithm) and algorithm[0][0] == 6 and inner[1][0] in (3, 4)
    return tag == 2 and inner[1][0] == 2 and len(content) >= 32  # a modulus and its exponent


def is_private_der(data: bytes) -> bool:
    """A key of which a part must stay secret: PKCS#1, SEC1 or PKCS#8 by their version and fields, or an encrypted PKCS#8; no public key or certificate."""
    if not is_der_key(data):
        return False
    inner = der_items(der_items(data)[0][1])
    tag, content = inner[0]
    if tag == 2 and len(content) == 1:  # a version
        return inner[1][0] == 4 or (inner[1][0] == 0x30 and len(inner) > 2 and inner[2][0] == 4) or (inner[1][0] == 2 and len(inner) >= 4)
    return tag == 0x30 and inner[1][0] == 4


def is_ssh_key(data: bytes) -> bool:
    """A key blob or key file of the SSH wire format: length-prefixed strings that fill it exactly."""
    if data.startswith(SSH_MAGIC):
        return _ssh_file(data) > 0
    at, parts = 0, []
    while at + 4 <= len(data) and len(parts) < 12:
        size = int.from_bytes(data[at : at + 4], "big")
        parts.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(parts) > 1 and parts[0] in SSH_NAMES


def _ssh_file(data: bytes) -> int:
    """Length of the private key file that ``data`` starts with: names of cipher and key derivation, its options, public keys, and the private part; 0 if it is none."""
    at = len(SSH_MAGIC)
    if not data.startswith(SSH_MAGIC):
        return 0
    for _ in range(3):
        if at + 4 > len(data):
            return 0
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    keys = int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else 0
    if not 1 <= keys <= 16:
        return 0
    end = at + 4
    for _ in range(keys + 1):  # the private part may be cut off in what is seen of it
        if end + 4 > len(data):
            return at + 4
        end += 4 + int.from_bytes(data[end : end + 4], "big")
    return end if end <= len(data) else at + 4


def _decode64(text: str) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json64(text: str):
    data = _decode64(text.replace("-", "+").replace("_", "/"))
    try:
        return json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None


def _private(data: bytes | None) -> tuple[str, int] | None:
    """(kind, length) of the private key that ``data`` starts with: DER says how long it is, and so do the strings of SSH."""
    if not data or len(data) < 24:
        return None
    if data[0] == 0x30:
        more = data[1] & 127 if data[1] > 127 else 0
        size = 2 + (int.from_bytes(data[2 : 2 + more], "big") + more if more else data[1])
        return ("der", size) if more <= 4 and 24 <= size <= len(data) and is_private_der(data[:size]) else None
    size = _ssh_file(data)
    return ("ssh", max(size, 24)) if size else None


def _assignments(text: str) -> list[Span]:
    low = text.lower()
    return [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if any(k in low for k in KEYWORDS) else []


def base_spans(text: str) -> list[Span]:
    out = _assignments(text)
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def _unescaped(body: str) -> str:
    """A block's body as it was before it was put in a string: escaped breaks are breaks; quotes, commas and backslashes go."""
    return re.sub(r"""["',\\]""", "", body.replace("\\r", "").replace("\\n", "\n").replace("\\/", "/"))


def _pem_spans(text: str) -> list[Span]:
    """Blocks whose BEGIN mark is followed by the END mark of the same label, no other mark between, and that decode to a private key.

    They may stand in strings (JSON, .env, YAML), their breaks written out.
    """
    out: list[Span] = []
    marks = list(PEM_MARK.finditer(text))
    for m, n in zip(marks, marks[1:], strict=False):
        if m[1] == "BEGIN" and n[1] == "END" and m[2] == n[2]:
            body = text[m.end() : n.start()]
            if "\\" in body or '"' in body or "'" in body:
                body = _unescaped(body)
            data = _decode64("".join(body[PEM_HEADERS.match(body).end() :].split()))
            if data and (is_private_der(data) or _ssh_file(data) or ("PRIVATE KEY" in m[2] and der_items(data))):
                out.append(("pem", m.start(), n.end()))
    return out


def _wrapped(text: str) -> list[list[tuple[int, int]]]:
    """Candidates in base64 of either alphabet, as the pieces that they consist of: one word, or lines of one length and a last one that isn't longer."""
    out: list[list[tuple[int, int]]] = []
    if not LINE.search(text):
        return out
    at, size = -1, 0  # where the last piece ends, and how long full lines of its candidate are
    for m in BASE64.finditer(text):
        a, b = m.span()
        if text[a] == "\\":
            continue
        joins = size >= LEAST_LINE and b - a <= size and at < a <= at + 64 and BREAK.fullmatch(text, at, a)
        if joins:
            out[-1].append((a, b))
        elif b - a >= LEAST_LINE:
            out.append([(a, b)])
            size = b - a
        else:
            size = 0
        if joins and b - a < size:
            size = 0
        at = b
    return [c for c in out if sum(b - a for a, b in c) >= LEAST_64]


def _encoded_spans(text: str, pem: list[Span]) -> list[Span]:
    """Private keys in base64 outside of the blocks ``pem``."""
    out: list[Span] = []
    k = 0
    for pieces in _wrapped(text):
        first = pieces[0][0]
        while k < len(pem) and pem[k][2] <= first:
            k += 1
        if k < len(pem) and pem[k][1] <= first:
            continue
        word = "".join(text[a:b] for a, b in pieces)
        plain = word.rstrip("=").replace("-", "+").replace("_", "/")
        starts = [0, *[i + 1 for i in range(min(64, len(word))) if word[i] in SEPARATORS][:OFFSETS]]
        for o in starts:
            if plain[o : o + 1] not in ("M", "b"):  # what 0x30 and the magic of SSH begin with
                continue
            whole = plain[o : o + (len(plain) - o) // 4 * 4] if (len(plain) - o) % 4 == 1 else plain[o:]
            found = _private(_decode64(whole))
            if found:
                last = o + -(-found[1] * 4 // 3)
                if last + 2 >= len(plain):  # the pad belongs to it
                    last = len(word)
                out.append((found[0], _place(pieces, o), _place(pieces, last - 1) + 1))
                break
    return out


def _place(pieces: list[tuple[int, int]], k: int) -> int:
    """Where the k-th character of joined pieces stands."""
    for a, b in pieces:
        if k < b - a:
            return a + k
        k -= b - a
    return pieces[-1][1]


def _token_spans(text: str) -> list[Span]:
    """Dotted triples whose first part is a header that names its algorithm and whose second part is an object too."""
    out: list[Span] = []
    at = 0
    while m := TOKEN.search(text, at):
        head = _json64(m[1])
        if isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(_json64(m[2]), dict):
            out.append(("jwt", *m.span()))
            at = m.end()
        else:
            at = m.end(1) + 1  # the next part may start a token of its own
    return out


def confirmed_spans(text: str) -> list[Span]:
    """Spans whose decoded bytes have the structure of a private key or a signed token; public keys and certificates are none.

    Each kind of candidate is looked for on its own, so that what is found
    depends on no other word of the text; the time is linear in its length.
    """
    pem = _pem_spans(text) if "-----BEGIN " in text else []
    out = pem + _encoded_spans(text, pem)
    for m in HEX_ANY.finditer(text):
        digits = "".join(m[0].replace(":", "").split())
        found = _private(bytes.fromhex(digits[: len(digits) // 2 * 2]))
        if found:
            plain = len(digits) == m.end() - m.start()
            out.append((found[0], m.start(), m.start() + 2 * found[1] if plain else m.end()))
    return out + _token_spans(text)


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each ordered by start and kind; places are code points, ends exclusive."""
    text = text or ""
    # a text whose words are all shorter than a candidate has none; blocks with BEGIN marks may be wrapped into short lines
    longest = max(map(len, text.split()), default=0)
    base = base_spans(text) if longest >= 20 else _assignments(text)
    if longest >= LEAST_LINE:
        more = confirmed_spans(text)
    else:
        more = _token_spans(text) if longest >= 12 and "." in text else []
        if "-----BEGIN " in text:
            more = more + _pem_spans(text)
    order = lambda s: (s[1], _ORDER[s[0]], s[2])
    return sorted(base, key=order), sorted({*base, *more}, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of each row of ``docs`` (doc_id, text); one row out for each row in.

    Base spans come from patterns alone; base64, hex, PEM and dotted candidates
    add a span where their decoded bytes parse as a private key (DER with nested
    lengths, SSH key files) or a signed token (a JSON header that names its
    algorithm). Keys may be wrapped, stand in strings with their breaks written
    out, use either alphabet of base64, or be glued to a prefix; hex may be of
    either case and have colons. Public keys are no secrets. A null text is empty; null and repeated ids are passed on;
    other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            for part in split_table(batch, 1_000_000):
                rows: list[tuple] = []
                for text in part.column("text").to_pylist():
                    base, spans = find_secrets(text)
                    n = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                    rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, cols, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in its text masked, and n_chars (if there) set anew; other columns unchanged."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            for part in split_table(batch, 1_000_000):
                texts = part.column("text").to_pylist()
                new = [t if t is None or not (s := find_secrets(t)[1]) else redact(t, s) for t in texts]
                changed = {"text": pa.array(new, pa.string())}
                if "n_chars" in names:
                    old = part.column("n_chars").to_pylist()
                    changed["n_chars"] = pa.array([o if a is b else len(b) for o, a, b in zip(old, texts, new, strict=True)], part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays([changed.get(k, part.column(k)) for k in names], names=names)

    return docs.mapInArrow(run, docs.schema)
