"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: in each round every feature in turn gets one shallow tree (up to four leaves over
its ordered bins), fitted by Newton steps to the current log-odds and added to the feature's lookup
table at a small rate. Then the feature pairs whose coarse grid explains most of the remaining
gradient get tables of their own, boosted the same way by quadrant cuts. A score is the sigmoid of the
summed table entries: vectorised lookups and additions, no texts and no trees.

Features are the integer ratios and counts of ``rules.statistics`` (of the whole text), never labels,
language, source or id. The model is fitted on at most ``MAX_TRAIN`` labelled rows, those with the
smallest hash of their id, and only from rows whose crc32(doc_id as text) mod 5 is not 0.

Defined cases: null and empty texts have all counts 0 and are scored as such; repeated rows score
alike; labels other than 0 and 1 are ignored; without labels of both kinds every score is 0.5; a
null doc_id counts as the text '' (held out); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import map_batches, table, train_rows, written
from greenlane.llm.rules import BASE, RATIOS, statistics

MAX_TRAIN = 50_000
FEATURES = (*RATIOS, *BASE)
BINS, ROUNDS, RATE, PAIRS, PAIR_BINS, PAIR_ROUNDS, MIN_LEAF, RIDGE = 48, 120, 0.15, 4, 8, 40, 20, 1.0
CUT = 0.3
HOLD_OUT = 0


@dataclass
class Model:
    """Bin edges and lookup tables; ``base`` is the log-odds of the labels."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, bins = np.full(len(x), self.base), self.bins(x) if self.edges else []
        for t, b in zip(self.tables, bins, strict=True):
            out += t[b]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[_coarse(bins[i], len(self.edges[i])), _coarse(bins[j], len(self.edges[j]))]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -40, 40)))


def _coarse(bins: np.ndarray, cuts: int) -> np.ndarray:
    return bins * PAIR_BINS // (cuts + 1)


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Gain and place of the best cut of the ordered bins lo..hi-1."""
    cg, ch, cn = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi]), np.cumsum(n[lo:hi])
    left = cg[:-1] ** 2 / (ch[:-1] + RIDGE) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + RIDGE) - cg[-1] ** 2 / (ch[-1] + RIDGE)
    left[(cn[:-1] < MIN_LEAF) | (cn[-1] - cn[:-1] < MIN_LEAF)] = -1
    return (-1.0, lo) if not len(left) or left.max() <= 0 else (float(left.max()), lo + 1 + int(left.argmax()))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf value of each bin: two levels of cuts, Newton steps in the leaves."""
    ends = [0, len(g)]
    for _ in range(2):
        cuts = [_split(g, h, n, a, b) for a, b in zip(ends, ends[1:], strict=False) if b - a > 1]
        ends = sorted({*ends, *(at for gain, at in cuts if gain > 0)})
    out = np.empty(len(g))
    for a, b in zip(ends, ends[1:], strict=False):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """Gain and place of the best pair of crossing cuts of a grid."""
    cg, ch = (np.pad(v, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for v in (g, h))
    best = (0.0, 0, 0)
    for a in range(1, len(g)):
        for b in range(1, g.shape[1]):
            gain = -cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)
            for r0, r1 in ((0, a), (a, len(g))):
                for c0, c1 in ((0, b), (b, g.shape[1])):
                    part = [c[r1, c1] - c[r0, c1] - c[r1, c0] + c[r0, c0] for c in (cg, ch)]
                    gain += part[0] ** 2 / (part[1] + RIDGE)
            if gain > best[0] + 1e-9:
                best = gain, a, b
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on features ``x`` (rows by FEATURES) and labels ``y`` (0 or 1)."""
    model = Model()
    if not len(y) or y.min() == y.max():
        return model
    mean = y.mean()
    model.base = float(np.log(mean / (1 - mean)))
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) + 0.5 for j in range(x.shape[1])]
    bins = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    counts = [np.bincount(b, minlength=k) for b, k in zip(bins, sizes, strict=True)]
    model.tables = [np.zeros(k) for k in sizes]
    odds = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, (b, k) in enumerate(zip(bins, sizes, strict=True)):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, k), np.bincount(b, h, k), counts[j])
            model.tables[j] += step
            odds += step[b]

    coarse = [_coarse(b, len(e)) for b, e in zip(bins, model.edges, strict=True)]
    cells = lambda i, j: coarse[i] * PAIR_BINS + coarse[j]
    grid = lambda i, j, v: np.bincount(cells(i, j), v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
    g, h = slopes()
    found = sorted(((_quadrants(grid(i, j, g), grid(i, j, h))[0], -i, -j) for i in range(len(sizes)) for j in range(i)), reverse=True)
    model.pairs = [(-i, -j) for gain, i, j in found[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            gg, hh = grid(i, j, g), grid(i, j, h)
            gain, a, b = _quadrants(gg, hh)
            if gain <= 0:
                continue
            step = np.empty_like(t)
            for rows in (slice(0, a), slice(a, None)):
                for cols in (slice(0, b), slice(b, None)):
                    step[rows, cols] = RATE * gg[rows, cols].sum() / (hh[rows, cols].sum() + RIDGE)
            t += step
            odds += step.reshape(-1)[cells(i, j)]
    return model


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> Model:
    """The model of at most ``max_rows`` labelled rows outside the held-out fifth."""
    known = labels.select(F.col("doc_id").alias("label_id"), "quality").filter(F.col("quality").isin(0, 1))
    rows = stats.filter(train_rows(F.col("doc_id"), HOLD_OUT)).join(known, F.col("doc_id") == F.col("label_id"))
    # the smallest hashes, of which a share that should hold them by a margin is sorted (each task sends at most that)
    place, spread = F.pmod(F.xxhash64("doc_id"), F.lit(2**40)), 2**40
    n = rows.count()
    if n > 2 * max_rows:
        rows = rows.filter(place < spread * (max_rows + 10 * max_rows**0.5) / n)
    got = rows.orderBy(place, "doc_id", "quality", *FEATURES).limit(max_rows).select(*FEATURES, "quality").toPandas()
    return fit(got[list(FEATURES)].to_numpy(np.float64), got["quality"].to_numpy(np.float64))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted from the features of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]).astype(np.float64)
        score = model.score(x)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                                          names=["doc_id", "held_out", "score", "predicted"])

    rows = stats.select(F.col("doc_id").cast("long").alias("doc_id"), (~train_rows(F.col("doc_id"), HOLD_OUT)).alias("held_out"), *FEATURES)
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int", rows=10_000)


def op5_quality_gam(spark, sf_dir: str) -> DataFrame:
    stats = written(statistics(table(spark, sf_dir, "documents")), "gam-stats")
    return scored(stats, train(stats, table(spark, sf_dir, "labels")))
