"""Quality rules and the additive model: base counts by brute force, learning by planted rules and held-out labels."""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from greenlane.llm import gam, rules

from .conftest import SF


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
    return counts, len(w) < 50 or 100 * len(covered) > 50 * len(w)


TEXTS = [None, "", " \n\t ", "a", "a b c", "a a a a", "a b c a b c", "a b c d a b c e a b", "x\n\nx\n x\nx", "#|<> é$%&* " * 30, "\x0bq\x1cr\x0cs q r s" * 20,
         "w " * 3000, "\n".join(f"l{i} m n" for i in range(200)) + "\nl7 m n", "É" * 10_000]


def test_base_counts(make_docs):
    docs = make_docs(TEXTS)
    for r in rules.statistics(docs).collect():
        counts, failed = base(TEXTS[r.doc_id - 1])
        assert (tuple(r[c] for c in rules.BASE), r.base_failed) == (counts, failed), r.doc_id


def test_base_counts_over_the_table(spark, sf_texts):
    texts = dict(sf_texts)
    rows = rules.op6_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, failed = base(texts[r.doc_id])
        assert (tuple(r[c] for c in rules.BASE), r.base_failed) == (counts, failed)
        assert not (failed and r.kept)


def planted(spark, n=600):
    rows = [(i, " ".join(f"w{(i * 31 + k) % 977}" for k in range(60)) + (" ###" * 40 if i % 6 == 0 else ""), int(i % 6 != 0)) for i in range(n)]
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([r[::2] for r in rows], "doc_id long, quality int")


def test_a_planted_rule_is_learned_and_clean_documents_stay(spark):
    docs, labels = planted(spark)
    learned = rules.learn(rules.statistics(docs), labels)
    assert learned and all(0 < len(r) <= rules.MAX_TESTS for r in learned)
    kept = {r.doc_id: r.kept for r in rules.judged(docs, labels).collect()}
    assert all(kept[i] == (i % 6 != 0) for i in kept)
    assert {r.doc_id for r in rules.kept_documents(docs.withColumns({"n_words": F.lit(1), "row": F.lit(2)}), labels).collect()} == {i for i in kept if kept[i]}


def test_rules_without_labels_and_without_rows(spark, make_docs):
    docs = make_docs(["word " * 5, " ".join(f"w{i}" for i in range(80)), None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in rules.judged(docs, none).collect()} == {1: False, 2: True, 3: False}
    odd = spark.createDataFrame([(1, None), (None, 0), (2, 7), (99, 0)], "doc_id long, quality int")
    assert rules.judged(docs.limit(0), odd).count() == 0 and rules.learn(rules.statistics(docs), odd) == []


def test_verdict_is_ordered(spark):
    df = spark.range(10).withColumn("symbols", F.col("id"))
    out = df.select("id", rules.verdict([[("symbols", ">=", 7)], [("symbols", "<", 2), ("symbols", ">=", 1)]]).alias("k")).collect()
    assert {r.id for r in out if not r.k} == {1, 7, 8, 9}


def test_additive_model_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = gam.op5_quality_gam(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q, _ in held if q], [s for s, q, _ in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert sum(p == q for _, q, p in held) > 0.95 * len(held)


def features(t):
    """The inputs of a score, counted plainly."""
    (n, chars, symbols, dups, repeats), _ = base(t)
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = len([x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    ratios = (100 * chars // n, 1000 * symbols // chars, 1000 * sum("A" <= c <= "Z" for c in t) // chars, 1000 * sum(c in "!?" for c in t) // n,
              1000 * repeats // n, 1000 * dups // lines, 1000 * len(set(w)) // n, 10 * n // lines) if n else (0,) * 8
    return (*(min(2000, r) for r in ratios), n, chars, symbols, dups, repeats)


def plain_score(model, x):
    """One table entry a feature and a pair, added up cell by cell."""
    places = [sum(e <= v for e in edges) for edges, v in zip(model.edges, x, strict=True)]
    odds = model.base + sum(t[k] for t, k in zip(model.tables, places, strict=True))
    for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
        odds += t[places[i] * gam.PAIR_BINS // (len(model.edges[i]) + 1)][places[j] * gam.PAIR_BINS // (len(model.edges[j]) + 1)]
    return 1 / (1 + np.exp(-odds))


def test_every_score_against_plain_counts_and_table_sums(spark, sf_texts):
    texts = dict(sf_texts)
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    learnt = [(features(texts[i]), q) for i, q in labels if i in texts and q in (0, 1) and zlib.crc32(str(i).encode()) % 5]
    assert 0 < len(learnt) <= gam.MAX_TRAIN
    model = gam.fit(np.array([x for x, _ in learnt], float), np.array([q for _, q in learnt], float))
    rows = gam.op5_quality_gam(spark, SF).collect()
    assert len(rows) == len(texts) and len(model.pairs) > 0
    for r in rows:
        assert abs(r.score - plain_score(model, features(texts[r.doc_id]))) < 1e-6, r.doc_id


def test_interactions_need_pairs():
    """An exclusive-or of two features is beyond single tables; a pair table learns it."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 100, (4000, len(gam.FEATURES))).astype(float)
    y = ((x[:, 0] > 50) ^ (x[:, 3] > 50)).astype(float)
    model = gam.fit(x, y)
    assert {0, 3} in [set(p) for p in model.pairs]
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_additive_model_without_labels_or_rows(spark, make_docs):
    docs = make_docs([None, "", "a b"], [1, 1, None]).withColumns({"score": F.lit("x"), "symbols": F.lit(1)})
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats = rules.statistics(docs)
    assert [r.score for r in gam.scored(stats, gam.train(stats, none)).collect()] == [0.5] * 3
    assert gam.scored(rules.statistics(docs.limit(0)), gam.train(stats, none)).count() == 0


def test_training_sample_is_bounded_and_fixed(spark):
    docs, labels = planted(spark, 200)
    stats = rules.statistics(docs)
    a, b = gam.train(stats, labels, max_rows=60), gam.train(stats.repartition(7), labels, max_rows=60)
    assert a.base == b.base and all((x == y).all() for x, y in zip(a.tables, b.tables, strict=True))
