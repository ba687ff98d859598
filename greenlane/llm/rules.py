"""Quality rules: base statistics of every text and a learned decision list. Native.

``statistics`` computes the base counts and a few integer ratios per document. ``learn`` covers the
labelled bad documents sequentially: a rule grows one threshold at a time by FOIL gain on the growing
half of the labels, is cut back on the other half to the prefix with the best precision there, and
is kept if it is precise enough; then the documents it covers leave. All candidate thresholds of all
ratios are judged from one aggregation (label counts by ratio and value; ratios are clamped integers,
so at most ``len(RATIOS) * (CLAMP + 1)`` rows reach the driver, at any input size). The list becomes
one ordered conditional expression.

Defined cases: a null or blank text has no words and fails the base; repeated rows are judged alike;
label rows without a document, and labels other than 0 and 1, are ignored; without labels the list is
empty and the base alone decides; other columns are ignored (``kept_documents`` returns them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import bound, dropped, table, word_array, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that rules test, each an integer clamped to CLAMP.
CLAMP = 2000
RATIOS: dict[str, str] = {
    "word_length": "100 * word_chars div n_words",
    "symbols": "1000 * n_symbols div word_chars",
    "capitals": "1000 * n_capitals div word_chars",
    "marks": "1000 * n_marks div n_words",
    "repeats": "1000 * n_repeat_words div n_words",
    "dup_lines": "1000 * n_dup_lines div n_lines",
    "distinct": "1000 * n_distinct div n_words",
    "line_words": "10 * n_words div n_lines",
}
MAX_RULES, MAX_TESTS, MIN_COVER, MIN_PRECISION = 8, 3, 5, 0.95
Rule = list[tuple[str, str, int]]


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Windows are compared by 64-bit hash. Sorted (hash, place) pairs show the places of repeated
    windows; in order of place, each adds the words up to the next such place, at most three.
    """

    def of(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = bound(pairs, lambda p: F.filter(F.transform(p, lambda e, j: F.when(
            F.coalesce(F.get(p, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(p, j + 1)["h"] == e["h"], F.lit(False)), e["i"])),
            lambda x: x.isNotNull()))
        covered = bound(F.array_sort(places), lambda s: F.aggregate(
            F.transform(s, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(s, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered)

    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, 0).otherwise(bound(windows, of))


def _without(text: Column, keep: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{keep}]+", ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, the base counts (long), ``base_failed`` and the ratios of every document; with ``carry`` also its ``row``."""
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []
    extra = ["row"] if carry else []
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(F.size(words).alias("n_words"), F.length(F.array_join(words, "")).alias("word_chars"),
                        repeat_words(words).alias("n_repeat_words"), F.size(F.array_distinct(words)).alias("n_distinct"))

    df = docs.select(docs[id_col].alias("doc_id"), text.alias("text"), *row)
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "doc_id", bound(word_array(F.col("text")), counts).alias("c"),
        bound(lines, lambda s: F.struct(F.size(s).alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).alias("n_dup_lines"))).alias("l"),
        _without(F.col("text"), r"#*$%&|<>").alias("n_symbols"), _without(F.col("text"), "A-Z").alias("n_capitals"),
        _without(F.col("text"), "!?").alias("n_marks"), *extra)
    df = df.select("doc_id", "c.*", "l.*", "n_symbols", "n_capitals", "n_marks", *extra)
    df = df.withColumns({c: F.col(c).cast("long") for c in df.columns if c not in ("doc_id", "row")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    ratio = lambda e: F.when(F.col("n_words") > 0, F.least(F.lit(CLAMP), F.expr(e))).otherwise(0).cast("int")
    return df.select("doc_id", *BASE, failed.alias("base_failed"), *[ratio(e).alias(k) for k, e in RATIOS.items()], *extra)


def matches(rule: Rule) -> Column:
    """The rule's tests, all of them."""
    out = F.lit(True)
    for name, side, cut in rule:
        out = out & ((F.col(name) >= cut) if side == ">=" else (F.col(name) < cut))
    return out


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: the first matching rule rejects, else keep."""
    if not rules:
        return F.lit(True)
    out = F.when(matches(rules[0]), False)
    for rule in rules[1:]:
        out = out.when(matches(rule), False)
    return out.otherwise(True)


def _histogram(train: DataFrame) -> list[tuple[str, int, int, int]]:
    """(ratio, value, bad, good) over the growing rows."""
    pairs = ", ".join(f"'{k}', `{k}`" for k in RATIOS)
    df = train.filter("growing").selectExpr("bad", f"stack({len(RATIOS)}, {pairs}) as (ratio, value)")
    return [tuple(r) for r in df.groupBy("ratio", "value").agg(F.sum("bad"), F.sum(1 - F.col("bad"))).collect()]


def _best_test(hist: list[tuple[str, int, int, int]]) -> tuple[float, tuple[str, str, int]] | None:
    """The threshold with the largest FOIL gain; ties go to the first ratio and lowest cut."""
    best = None
    for name in RATIOS:
        rows = sorted((v, p, n) for k, v, p, n in hist if k == name)
        pos, neg = sum(r[1] for r in rows), sum(r[2] for r in rows)
        if not pos or not neg:
            return best
        base, below_p, below_n = math.log2(pos / (pos + neg)), 0, 0
        for value, p, n in rows:
            for side, a, b in (("<", below_p, below_n), (">=", pos - below_p, neg - below_n)):
                if a >= MIN_COVER and a + b < pos + neg:
                    gain = a * (math.log2(a / (a + b)) - base)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, (name, side, value)
            below_p, below_n = below_p + p, below_n + n
    return best


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """An ordered list of reject rules from labelled statistics (quality 0: bad)."""
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality")).filter(F.col("quality").isin(0, 1))
    train = stats.filter(~F.col("base_failed")).join(known, F.col("doc_id") == F.col("label_id")).select(
        *RATIOS, (1 - F.col("quality")).cast("long").alias("bad"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0).alias("growing"))
    train = written(train, "rules-train")
    rules: list[Rule] = []
    for _ in range(MAX_RULES):
        left = train.filter(verdict(rules))
        rule: Rule = []
        while len(rule) < MAX_TESTS and (found := _best_test(_histogram(left.filter(matches(rule))))):
            rule.append(found[1])
        if not rule:
            break
        held = left.filter(~F.col("growing")).agg(*[
            f(F.when(matches(rule[:k]), x)).alias(f"{name}{k}") for k in range(1, len(rule) + 1)
            for name, f, x in (("bad", F.sum, F.col("bad")), ("all", F.count, F.lit(1)))]).first()
        precise = {k: (held[f"bad{k}"] or 0) / held[f"all{k}"] for k in range(1, len(rule) + 1) if held[f"all{k}"]}
        if not precise:
            break
        size = min(precise, key=lambda k: (-precise[k], k))
        if precise[size] < MIN_PRECISION or (held[f"bad{size}"] or 0) < MIN_COVER:
            break
        rules.append(rule[:size])
    dropped(train)
    return rules


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, ``base_failed`` and ``kept`` of every document."""
    stats = written(statistics(docs), "rules-stats")
    kept = ~F.col("base_failed") & verdict(learn(stats, labels))
    return stats.select("doc_id", *BASE, "base_failed", kept.alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base and the list keep, with all their columns.

    The rows are written once with their statistics; the list is learned from these and is then an expression over each row's
    own, so texts are not shuffled, are judged once, and repeated or null ids need no join.
    """
    rows = written(statistics(docs, carry=True), "rules-rows")
    narrow = rows.select(F.col("row.doc_id").alias("doc_id"), *[c for c in rows.columns if c not in ("row", "doc_id")])
    return rows.filter(~F.col("base_failed") & verdict(learn(narrow, labels))).select("row.*")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
