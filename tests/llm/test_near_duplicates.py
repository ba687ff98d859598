"""Near duplicates against all pairs of full sets."""

import random
import re

import duckdb
import pytest

from greenlane.llm import neardup, queries

from .conftest import SF


def sets_of(texts, width):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute(ids, texts, width=3, threshold=85):
    sets, root = sets_of(texts, width), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= threshold * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)], least[find(i)] == d) for i, d in enumerate(ids)}


def corpus(n, seed):
    """Texts in families: copies with a few words changed, chains of small changes, exact copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(rng.randrange(4, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 9)):
            kind = rng.random()
            if kind < 0.2:
                texts.append(" ".join(base).upper())
                continue
            changed = list(base)
            for _ in range(max(1, int(len(base) * rng.choice([0.01, 0.02, 0.05, 0.2])))):
                changed[rng.randrange(len(changed))] = word()
            texts.append("\t".join(changed))
            if kind > 0.6:
                base = changed  # a chain
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "threshold", "seed"), [(3, 85, 1), (5, 80, 2)])
def test_components_are_those_of_all_pairs(make_docs, width, threshold, seed):
    texts = [None, "", " \t ", "a", "A", "a b", "a b c", "\x1ca b", "É b c", "é b c", *corpus(400, seed)]
    ids = list(range(1000, 1000 + len(texts)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(make_docs(texts, ids), width, threshold).collect()}
    assert got == brute(ids, texts, width, threshold)


def test_a_large_group_of_near_copies_is_one_component(make_docs):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(300):
        changed = list(base)
        changed[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(changed))
    rows = neardup.near_duplicates(make_docs(texts)).collect()
    assert {r.component_id for r in rows} == {1} and sum(r.kept for r in rows) == 1


@pytest.mark.parametrize(("width", "threshold", "seed"), [(3, 85, 11), (2, 60, 12)])
def test_one_bucket_of_all_sizes_keeps_every_link(make_docs, width, threshold, seed):
    """All sets in one bucket, so that most links are left to the search across its components by size class."""
    from pyspark.sql import functions as F

    texts = corpus(250, seed)
    docs = make_docs(texts).select("doc_id", "text")
    sketches = neardup.sketched(docs, width).withColumn("keys", F.array(F.lit(7).cast("long"))).checkpoint()
    nodes, labels = neardup.linked(docs, sketches, width, threshold)
    rows = sketches.select("doc_id", "node").join(labels, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root")).collect()
    least = {}
    for r in rows:
        least[r.root] = min(least.get(r.root, r.doc_id), r.doc_id)
    assert {r.doc_id: least[r.root] for r in rows} == {d: c for d, (_, c, _) in brute([*range(1, len(texts) + 1)], texts, width, threshold).items()}


def test_similar_sizes_are_in_neighbouring_classes(spark):
    """Every pair of sizes up to 400 within each threshold, exact powers of the ratio among them."""
    from pyspark.sql import functions as F

    for threshold in (1, 50, 80, 85, 99, 100):
        of = dict(spark.range(1, 401).select(F.col("id").alias("n")).select("n", neardup.size_class(threshold)).collect())
        assert all(of[b] - of[a] in (0, 1) for b in of for a in range(-(-b * threshold // 100), b + 1) if a)


def test_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLE["op4_near_duplicates"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op4_near_duplicates"](spark, SF).select("doc_id", "n_shingles", "component_id", "kept").collect())) == want


def test_repeated_rows_null_ids_and_clashing_columns(spark, make_docs):
    from pyspark.sql import functions as F

    docs = make_docs(["p q r s t u"] * 3 + ["p q r s t u", "other text of six words here", None, None], [5, 5, 7, None, 8, 9, None])
    docs = docs.withColumns({"node": F.lit(1), "n": F.lit("x"), "kept": F.lit(False)})
    rows = neardup.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [
        (0, 0, True), (0, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True), (9, 9, True)]
    kept = neardup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 5, 8, 9]


def test_other_texts_under_the_id_of_a_copy_stay(spark):
    """Copies go by id and text; rows that differ beside the text stay; linked texts of one id are one."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near_c = c + " end"
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (5, b, "x"), (7, "t u v w x y z", "x"), (7, "t u v w x y z", "y"), (7, "t u v w x y z", "y"), (8, c, "x"), (8, near_c, "x"),
            (9, near_c, "x"), (5, "", "x"), (5, None, "x"), (5, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as node", "2 as other_id").repartition(4)
    kept = neardup.kept_documents(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text or "", r.source) for r in kept.collect())
    eights = [g for g in got if g[0] == 8]
    assert len(eights) == 1 and eights[0][1] in (c, near_c)
    assert [g for g in got if g[0] != 8] == sorted([(1, a, "x"), (5, b, "x"), (7, "t u v w x y z", "x"), (7, "t u v w x y z", "y"), (5, "", "x"), (5, "", "x")])


def test_empty_table(make_docs):
    docs = make_docs(["x"]).limit(0)
    assert neardup.near_duplicates(docs).count() == neardup.kept_documents(docs).count() == 0


def test_sketch_bound_lies_far_below_the_threshold():
    """Pairs at the threshold differ in fewer sketch bits than the limit, by a wide margin."""
    import numpy as np

    rng, worst = np.random.default_rng(5), 0
    for _ in range(300):
        common, own = rng.integers(0, 2**63, 850, dtype=np.uint64), rng.integers(0, 2**63, 150, dtype=np.uint64)
        a, b = np.concatenate([common, own[:75]]), np.concatenate([common, own[75:]])
        m = np.stack([neardup.samples(a), neardup.samples(b)])
        x, y = neardup.odd_sketches(m).view(np.uint64)
        worst = max(worst, sum(bin(int(p ^ q)).count("1") for p, q in zip(x, y, strict=True)))
    assert worst < neardup.most_odd(85) - 10
