"""Secret scan: keyword automaton, anchored patterns near hits, embedded checksums.

One Aho-Corasick pass over the lower-cased text (A-Z only, so positions stay) finds the keywords.
Each hit is tried with the anchored pattern of its kind at that place only. Hits of one kind are
taken from left to right and never overlap: a hit inside an earlier match of its kind is skipped,
as a left-to-right search would. Hexadecimal runs carry no keyword; they are found by their length.

Kinds: ``assign``, ``access``, ``hex`` (the base kinds) and, added by checksum or structure,
``github`` and ``npm`` (36 characters, the last six the base-62 CRC-32 of the others), ``gitlab``
(a routable token whose last seven characters are the base-36 CRC-32 of the rest), ``jwt`` (its
header is Base64 JSON that names an algorithm) and ``pem`` (a private-key header).

Defined cases: a null text counts as empty (no spans); equal rows give equal results, one per row;
other columns of the input are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from greenlane.llm.common import map_batches

KINDS = ("assign", "access", "hex", "github", "npm", "gitlab", "jwt", "pem")
BASE_KINDS = 3
MASK = "[SECRET]"

# Keyword (lower case) -> kind it starts.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "glpat-": "gitlab", "eyj": "jwt", "-----begin ": "pem",
}
ANCHORED = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "gitlab": re.compile(r"glpat-[A-Za-z0-9_-]{20,300}\.[0-9a-z]{2}\.[0-9a-z]{9}(?![0-9A-Za-z])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*"),
    "pem": re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
}
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def in_base(value: int, alphabet: str, width: int) -> str:
    out = ""
    while value:
        value, digit = divmod(value, len(alphabet))
        out = alphabet[digit] + out
    return out.rjust(width, alphabet[0])


def _crc_62(body: str) -> bool:
    return in_base(zlib.crc32(body[:-6].encode()), DIGITS, 6) == body[-6:]


def _crc_36(token: str) -> bool:
    return in_base(zlib.crc32(token[:-7].encode()), DIGITS[:10] + DIGITS[36:], 7) == token[-7:]


def _jwt_header(part: str) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except ValueError:
        return False
    return isinstance(head, dict) and "alg" in head


#: Per kind, whether a match counts. A match that fails is used up all the same.
VALID = {
    "assign": lambda m: len(m[1]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "github": lambda m: _crc_62(m[1]),
    "npm": lambda m: _crc_62(m[1]),
    "gitlab": lambda m: _crc_36(m[0]),
    "jwt": lambda m: _jwt_header(m[1]),
    "pem": lambda m: True,
}


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind index, end) in code points, by start, then kind as listed."""
    if not text:
        return []
    lowered = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits = sorted((end - size + 1, kind) for end, (size, kind) in _automaton().iter(lowered))
    used = dict.fromkeys(ANCHORED, 0)
    out = []
    for start, kind in hits:
        if start >= used[kind] and (m := ANCHORED[kind].match(text, start)):
            used[kind] = m.end()
            if VALID[kind](m):
                out.append((start, KINDS.index(kind), m.end()))
    out += [(m.start(), KINDS.index("hex"), m.end()) for m in HEX_RUN.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch covered by spans replaced once by ``MASK``."""
    out, at, end = [], 0, -1
    for a, _, b in spans:
        if a >= end:
            if end >= 0:
                at = end
            out += [text[at:a], MASK]
            end = b
        end = max(end, b)
    return "".join(out) + text[max(end, 0):]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_verified long"


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [find_spans(t) for t in batch.column(1).to_pylist()]
    base = [[s for s in spans if s[1] < BASE_KINDS] for spans in found]
    count = lambda k: pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), count(0), count(1), count(2),
         pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base], pa.string()),
         pa.array([joined(s) for s in found], pa.string()),
         pa.array([len(f) - len(b) for f, b in zip(found, base, strict=True)], pa.int64())],
        names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_verified"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, the digest of base spans, all spans."""
    df = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return map_batches(df, _scan, SCHEMA)


def redact(docs: DataFrame, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """The same rows and columns with every secret in ``text_col`` replaced by ``MASK``.

    ``count_col`` (a long column) is set to the code points of each changed text.
    """
    at = docs.columns.index(text_col)
    count_at = docs.columns.index(count_col) if count_col else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        before = batch.column(at).to_pylist()
        after = [t if not t or not (s := find_spans(t)) else masked(t, s) for t in before]
        arrays = list(batch.columns)
        arrays[at] = pa.array(after, pa.string())
        if count_at is not None:
            counts = [len(b) if b != a else n for a, b, n in zip(before, after, batch.column(count_at).to_pylist(), strict=True)]
            arrays[count_at] = pa.array(counts, batch.column(count_at).type)
        return pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return map_batches(docs, run, docs.schema)


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    from greenlane.llm.common import table

    return scan(table(spark, sf_dir, "documents"))
