"""Personal data: patterns propose spans, checksums confirm, nearby words adjust the score. Native.

Matches come from ``regexp_extract_all`` and the text between them from ``split`` by the same
pattern, so running lengths give code-point positions without a Python function. The patterns
are the base ones made linear: classes that exclude what follows are possessive, and a match may
start only where a run of its first class starts or where the last match ended (``\\G``), which
is where a leftmost search starts it anyway.

Kinds: ``email``, ``ip`` (parts at most 255), ``card`` (12 to 19 digits, Luhn), ``phone`` (9 to 15
digits) and, added by checksum, ``iban`` (mod 97). Score in percent: the kind's prior, plus 20 when
a context word of the kind stands within 40 characters before or after, at most 100.

Defined cases: a null or empty text has no spans; repeated rows give one result each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import bound, table

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = 4
LOCAL = r"[A-Za-z0-9._%+-]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
}
#: A cheap test that every text with a valid match of the kind passes.
MAY_HAVE: dict[str, Callable[[Column], Column]] = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
}
PRIOR = {"email": 80, "ip": 50, "card": 70, "phone": 50, "iban": 80}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|login)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|t[ée]l[ée]phone)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b",
}
NEAR, BONUS, CONFIDENT = 40, 20, 60


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    """Luhn: from the right every second digit doubles (minus 9 above 9); the sum is a multiple of 10."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step) % 10 == 0


def mod97_ok(iban: Column) -> Column:
    """ISO 13616: country and check digits to the end, letters as 10 to 35, remainder 1 modulo 97."""
    flat = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substr(flat, F.lit(5)), F.substr(flat, F.lit(1), F.lit(4)))

    def step(rest: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return (F.length(flat) >= 15) & (F.aggregate(F.split(moved, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c))) == 1)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: s.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    "card": lambda s: bound(_digits(s), lambda d: F.when(F.length(d).between(12, 19), luhn_ok(d)).otherwise(False)),
    "phone": lambda s: F.length(_digits(s)).between(9, 15),
    "iban": mod97_ok,
}
SPAN = "array<struct<start:int,rank:int,end:int,score:int>>"


def running_sums(numbers: Column) -> Column:
    """Sums of the first 1, 2, .. numbers: blocks of the cube root of their count, and blocks of so many blocks, n ** (4/3) steps."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    div = lambda a, b: F.floor(a / b).cast("int")

    def sums(size: Column) -> Column:
        blocks = lambda a: F.transform(upto(F.ceil(F.size(a) / size).cast("int")), lambda k: total(F.slice(a, k * size + 1, size)))
        inside = lambda a, i: total(F.slice(a, div(i, size) * size + 1, i % size))

        def outer(small: Column) -> Column:
            def inner(large: Column) -> Column:
                before = F.transform(large, lambda _, k: total(F.slice(large, 1, k)))
                return bound(before, lambda p: F.transform(small, lambda _, k: F.get(p, div(k, size)) + inside(small, k)))

            return bound(bound(blocks(small), inner), lambda p: F.transform(numbers, lambda x, i: F.get(p, div(i, size)) + inside(numbers, i) + x))

        return bound(blocks(numbers), outer)

    return F.when(F.size(numbers) > 0, bound(F.ceil(F.cbrt(F.size(numbers))).cast("int"), sums)).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, kind: str) -> Column:
    """Array of (start, rank, end, score) of the kind's valid matches."""
    rank, pattern = KINDS.index(kind), PATTERNS[kind]

    def build(found: Column) -> Column:
        match, gap = found["m"], found["g"]
        length = F.transform(match, lambda s, i: F.length(F.get(gap, i)) + F.length(s))
        return bound(bound(length, running_sums), lambda e: F.filter(F.transform(match, lambda s, i: F.when(VALID[kind](s), F.struct(
            (F.get(e, i) - F.length(s)).alias("start"), F.lit(rank).alias("rank"), F.get(e, i).alias("end"),
            F.least(F.lit(100), F.lit(PRIOR[kind]) + F.when(
                F.right(F.get(gap, i), F.lit(NEAR)).rlike(CONTEXT[kind]) | F.left(F.get(gap, i + 1), F.lit(NEAR)).rlike(CONTEXT[kind]),
                BONUS).otherwise(0)).alias("score")))), lambda x: x.isNotNull()).cast(SPAN))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    return F.when(MAY_HAVE[kind](text), bound(found, build)).otherwise(F.array().cast(SPAN))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, found): ``found`` lists (start, rank, end, score) by start, then kind as listed."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    df = docs.select(docs[id_col].alias("doc_id"), text.alias("text"))
    df = df.withColumns({k: _spans(F.col("text"), k) for k in KINDS})
    return df.select("doc_id", "text", F.when(sum((F.size(k) for k in KINDS), F.lit(0)) > 0, F.array_sort(F.concat(*KINDS)))
                     .otherwise(F.array().cast(SPAN)).alias("found"))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents")).drop("text")
    count = lambda k: F.size(F.filter("found", lambda s: s["rank"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:BASE_KINDS]],
        F.sha2(joined(F.filter("found", lambda s: s["rank"] < BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), count("iban"),
        F.size(F.filter("found", lambda s: s["score"] >= CONFIDENT)).cast("long").alias("n_confident"),
        F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"))
