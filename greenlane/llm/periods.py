"""Periodic runs of words, by internal pattern matching.

A run is a stretch of words that repeats with a smallest period ``q``, at least ``max(6, 4 * q)`` words long, that cannot be
made longer. One suffix array is built over the words of a batch of texts, each text ended by a symbol of its own, so no repeat
crosses texts. A run of that length holds a whole block of ``L`` words at a multiple of ``L``, where ``L`` is the power of two with
``q < L <= 2 * q``, and also that block ``q`` words later or earlier. So each such dyadic block asks where else it occurs in
the windows of ``L`` words around it: the suffixes that start with it are one range of the suffix array, and a wavelet tree over the
array gives the next place in that range (range successor). Occurrences in such a window are one arithmetic progression;
its difference is the candidate period, which the words around confirm and extend.

Suffixes are sorted by doubling; a block's range is its group of equal prefixes when the doubling has reached its length.

Defined cases: null, empty and blank texts have no words and no runs; a text is taken whole, whatever its length; documents
are judged one by one, so repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import bound, map_batches, table, word_array
from greenlane.llm.wavelet import WaveletMatrix

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are batched up to so many bytes (a longer one is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 2048, 1 << 20


def suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix array, and by k: places that are multiples of 2**k whose block of 2**k symbols occurs again, with its range in the array."""
    n = len(symbols)
    array = np.argsort(symbols, kind="stable")
    new = np.concatenate([[True], symbols[array][1:] != symbols[array][:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    blocks, open_, size = [], np.arange(n), 1  # open_: slots of the array whose suffix is not told apart yet
    while True:
        starts = open_[new]
        sizes = np.diff(np.append(np.flatnonzero(new), len(open_)))
        group = np.repeat(starts, sizes)
        rank[array[open_]] = group
        shared = np.repeat(sizes > 1, sizes)
        open_, group, ends = open_[shared], group[shared], np.repeat(starts + sizes, sizes)[shared]
        places = array[open_]
        aligned = places & (size - 1) == 0
        blocks.append((places[aligned], group[aligned], ends[aligned]))
        if not len(open_):
            return array, blocks
        after = rank[np.minimum(places + size, n)]
        order = np.lexsort((after, group)) if n > 1 << 31 else np.argsort(group * (n + 1) + after + 1, kind="stable")
        array[open_] = places[order]
        group, after = group[order], after[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        size *= 2


def candidates(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (place, period): the words from there repeat ``period`` later, over a block of more than ``period`` words."""
    array, blocks = suffixes(symbols)
    found = [(np.full(len(at), 1 << k), at, lo, hi) for k, (at, lo, hi) in enumerate(blocks) if k and len(at)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size, at, lo, hi = (np.concatenate(c) for c in zip(*found, strict=True))
    tree = WaveletMatrix.of(array)
    later = tree.successor(at + 1, lo, hi)
    ahead = (later >= 0) & (later - at < size)
    # the window before the block: its first occurrence and the next after it, the block itself at the latest
    early = tree.successor(np.maximum(at - size + 1, 0), lo, hi)
    back = early < at
    second = tree.successor(early[back] + 1, lo[back], hi[back])
    place = np.concatenate([at[ahead], early[back]])
    period = np.concatenate([(later - at)[ahead], second - early[back]])
    of = np.concatenate([size[ahead], size[back]])
    fits = (2 * period >= of) & (period < of)
    pairs = np.unique(np.stack([period[fits], place[fits]]), axis=1)
    return pairs[1], pairs[0]


def reach(symbols: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Start and end of the longest stretch around ``at`` in which words ``period`` apart are equal."""
    end, step = at, 32
    while True:
        a, b = symbols[end: end + step], symbols[end + period: end + period + step]
        differ = a[: len(b)] != b
        if differ.any() or len(b) < step:
            end += int(differ.argmax()) if differ.any() else len(b)
            break
        end, step = end + step, 2 * step
    start, step = at, 32
    while start:
        low = max(0, start - step)
        differ = symbols[low:start] != symbols[low + period: start + period]
        if differ.any():
            start -= int(differ[::-1].argmax())
            break
        start, step = low, 2 * step
    return start, end + period


def runs_of(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, by start and period."""
    places, periods = candidates(symbols)
    found: dict[tuple[int, int], int] = {}
    for period in np.unique(periods):
        mine = places[np.searchsorted(periods, period): np.searchsorted(periods, period, side="right")]
        k = 0
        while k < len(mine):
            start, end = reach(symbols, int(mine[k]), int(period))
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                found[start, end] = min(int(period), found.get((start, end), int(period)))
            k = max(k + 1, int(np.searchsorted(mine, end - period)))
    return sorted((s, e, q) for (s, e), q in found.items())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, end, period in runs:
        keep[start + period: end] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period; words are numbered from 0), collapsed: one row per document."""
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        symbols = np.empty(starts[-1], np.int64)
        for words, at in zip(texts, starts, strict=False):
            symbols[at: at + len(words)] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        symbols[starts[1:] - 1] = np.arange(len(texts)) + len(ids)
        by_doc = defaultdict(list)
        for start, end, period in runs_of(symbols):
            doc = int(np.searchsorted(starts, start, side="right")) - 1
            by_doc[doc].append((start - int(starts[doc]), end - int(starts[doc]), period))
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[{"start": s, "length": e - s, "period": q} for s, e, q in by_doc.get(d, ())] for d in range(len(texts))], pa.list_(fields)),
            pa.array([collapsed(t, by_doc.get(d, [])) for d, t in enumerate(texts)], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", docs["text"].cast("string").alias("text")), run, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string", BATCH_ROWS, BATCH_BYTES)


def planted(text: Column, doc_id: Column) -> Column:
    """Every tenth document by the hash of its id gets a periodic rest: from word ``a`` on, word ``i`` becomes word ``a + (i - a) % p``."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(words, (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int"))), " "))

    return F.when(h % 10 == 0, bound(word_array(text), repeated)).otherwise(text)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs)
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    best = F.when(F.size("runs") > 0, best)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.length")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
