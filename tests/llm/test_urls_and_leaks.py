"""URL filter and decontamination against SQL and plain loops."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from greenlane.llm import decontam, queries, urls

from .conftest import SF

PAGES = [
    (1, "HTTP://www.Example.com/en/a?b=/x", ""), (2, "https://x.example.com/en/", None), (3, "https://example.com", "<a href='//good.org/x'>"),
    (4, "http://a.net/es/1#top", '<a class="k" href="http://spam.org/1">s</a><a href="https://SPAM.org/2">'), (5, "http://a.net/fr/", '<a href="http://spam.org">'), (6, "http://a.net/en/", ""),
    (7, None, None), (8, "no scheme", ""), (9, "://", ""), (10, "x://net/es/", ""), (11, "x://notnet.org/es/", ""), (12, "http://spam.org/p", '<a href="http://a.net/es/1">back</a>'),
    (13, "http://good.org/", "<a href=/rel>"), (14, "http://www.spam.org/", ""), (15, "http://a.net:80/es/", ""), (16, "http://h.com\n/p", ""), (1, "HTTP://www.Example.com/en/a?b=/x", ""),
]


def frames(spark, rows, schema, name, monkeypatch, module):
    df = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(module, "table", lambda s, d, n: df)
    con = duckdb.connect()
    arrow = df.toArrow()  # noqa: F841
    con.execute(f"create table {name} as select * from arrow")
    return df, con


def test_rules_and_graph_against_sql(spark, monkeypatch):
    _, con = frames(spark, PAGES, "page_id long, url string, html string", "pages", monkeypatch, urls)
    got = sorted(map(tuple, urls.op9_url_filter(spark, "").select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    want = sorted(con.execute(f"select page_id, host, path, rule, verdict from ({queries.ORACLE['op9_url_filter']})").fetchall(), key=repr)
    assert got == want
    said = {r[0]: r[1:] for r in got}
    assert said[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert said[2][2:] == ("example.com/en/", "block") and said[3][1:] == ("", None, "allow")
    assert said[4][2:] == ("net/es/", "block") and said[10][2:] == ("net/es/", "block") and said[11][2:] == (None, "allow")
    assert said[7] == said[8] == ("", "", None, "allow")
    assert said[12][3] == "block"  # links to a blocked host
    assert said[13][3] == "allow"


def test_url_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    cols = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(map(tuple, queries.QUERIES["op9_url_filter"](spark, SF).select(*cols).collect()))
    assert got == sorted(con.execute(f"select {', '.join(cols)} from ({queries.ORACLE['op9_url_filter']})").fetchall())


def test_ranks_are_within_the_contraction_of_their_fixed_point(spark):
    """Each step shrinks the distance by the damping; links, a host without links and one that nobody links to."""
    names = ["a", "b", "c", "d", "e"]
    links = [("a", "b", 3), ("a", "c", 1), ("b", "c", 2), ("c", "a", 1), ("e", "d", 5), ("e", "a", 1)]
    start = np.array([urls.MASS // 2, 0, 0, 0, urls.MASS // 2], float)
    step = np.zeros((5, 5))
    for a, b, w in [*links, ("d", "d", 1)]:
        step[names.index(b), names.index(a)] = w
    step = urls.DAMPING / 100 * step / step.sum(0)
    fixed = np.linalg.solve(np.eye(5) - step, (1 - urls.DAMPING / 100) * start)
    hosts = spark.createDataFrame([(h, int(s)) for h, s in zip(names, start, strict=True)], "host string, seed long")
    edges = spark.createDataFrame(links, "src string, dst string, w long")
    for steps in (urls.ITERATIONS, 2 * urls.ITERATIONS):
        got = dict(urls.ranks(hosts, edges, "seed", steps).select("host", "rank").collect())
        gap = np.abs(np.array([float(got.get(h) or 0) for h in names]) - fixed).sum()
        assert gap <= (urls.DAMPING / 100) ** steps * np.abs(start - fixed).sum() + 100 * steps


def test_url_filter_on_an_empty_table_and_clashing_columns(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"host": F.lit("z"), "rank": F.lit(1), "n": F.lit(2)})
    assert urls.judged(pages).filter("host = 'a.net'").count() == 3
    assert urls.judged(pages.limit(0)).count() == 0
    assert urls.judged(pages, rules=()).filter("verdict = 'allow' and rule is null").count() == len(PAGES)


def plain(docs, items):
    """All diagonals of all pairs: a seed hit under a mask, then the best window."""
    words = lambda t: [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    out, rep = {}, {}
    for i, t in items:
        w = tuple(words(t))
        if len(w) >= decontam.SPAN:
            rep[w] = min(rep.get(w, i), i)
    for d, t in docs:
        dw = words(t)
        for iw, i in rep.items():
            size = min(decontam.WINDOW, len(iw))
            for diagonal in range(-len(iw), len(dw)):
                equal = [0 <= diagonal + j < len(dw) and dw[diagonal + j] == w for j, w in enumerate(iw)]
                hit = any(all(equal[j + k] for k, bit in enumerate(mask) if bit == "1") and diagonal + j >= 0 and diagonal + j + decontam.SPAN <= len(dw)
                          for mask in decontam.MASKS for j in range(len(iw) - decontam.SPAN + 1))
                best = max(sum(equal[s:s + size]) for s in range(len(iw) - size + 1))
                if hit and 100 * best >= decontam.SHARE * size:
                    out[d, i] = max(out.get((d, i), 0), best)
    return sorted((*k, v) for k, v in out.items())


ITEM = [f"t{i}" for i in range(45)]
ITEMS = [(1, " ".join(ITEM)), (2, " ".join(ITEM)), (3, "a b c d e f g h i j"), (4, "too short"), (5, None), (6, "")]


def changed(words, every, new="Z"):
    return " ".join(new + str(i) if i % every == every - 1 else w for i, w in enumerate(words))


DOCS = [(1, "x y " + " ".join(ITEM) + " z"), (2, changed(ITEM, 6)), (3, changed(ITEM, 3)), (4, "q " * 50 + " ".join(ITEM[10:32])), (5, " ".join(ITEM[:12])), (6, "a b c D e f\tg h i j"),
        (7, "a b c d e f g h"), (8, None), (9, ""), (10, " ".join(ITEM[::-1])), (11, " ".join(ITEM).upper()), (12, "too short"), (12, " ".join(ITEM)), (13, "a b c d x f g h i j"), (14, "t1 " * 3000)]


@pytest.mark.parametrize("limit", [decontam.BROADCAST_ROWS, 0])
def test_overlaps_are_those_of_all_diagonals(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", limit)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({"words": F.lit(1), "seed": F.lit(2), "item_id": F.lit(3)})
    got = decontam.overlaps(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert sorted(tuple(r)[:3] for r in got.select("doc_id", "item_id", "equal_words").collect()) == plain(DOCS, ITEMS)
    assert {r.doc_id for r in got.collect()} >= {1, 2, 4, 6, 11, 12, 13}


def test_leak_table_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rows = queries.QUERIES["op10_decontamination"](spark, SF).select("doc_id", "item_id", "equal_words", "window_words").collect()
    assert sorted(map(tuple, rows)) == sorted(con.execute(queries.ORACLE["op10_decontamination"]).fetchall())


def test_clean_documents_stay_whole(spark):
    docs = spark.createDataFrame([*DOCS, (None, "free text"), (20, "free text")], "doc_id long, text string").withColumn("bad_id", F.lit(9))
    out = decontam.clean_documents(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert out.columns == docs.columns
    # document 7 has 8 of the 10 words of item 3; the two past its end count as words that differ
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted([0, 3, 5, 8, 9, 10, 14, 20])
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.clean_documents(docs, none).count() == docs.count() and decontam.overlaps(docs.limit(0), none).count() == 0


def every_match(size):
    """Every choice of the most words that may differ of ``size``, as flags of equal words."""
    from itertools import combinations

    for gone in combinations(range(size), size - -(-decontam.SHARE * size // 100)):
        yield [i not in gone for i in range(size)]


def test_every_pattern_within_the_rule_is_hit_by_a_mask():
    for size in range(1, decontam.WINDOW + 1):
        masks = decontam.masks_of(size)
        assert all("0" in m and m[0] == m[-1] == "1" for m in masks) or (size < 5 and masks == ("1" * size,))
        for equal in every_match(size):
            assert any(all(equal[at + k] for k, bit in enumerate(m) if bit == "1") for m in masks for at in range(size - len(m) + 1))
    assert decontam.masks_of(59) == decontam.masks_of(decontam.WINDOW)


def by_rule(docs, items):
    """Pairs whose best window on any diagonal meets the rule, without a seed condition."""
    words = lambda t: (t or "").lower().split()
    out = set()
    for d, t in docs:
        for i, x in items:
            w, iw = words(t), words(x)
            size = min(decontam.WINDOW, len(iw))
            for g in range(-len(iw), len(w) if iw else -len(iw)):
                equal = [0 <= g + j < len(w) and w[g + j] == x for j, x in enumerate(iw)]
                if any(100 * sum(equal[s:s + size]) >= decontam.SHARE * size for s in range(len(iw) - size + 1)):
                    out.add((d, i))
    return out


def test_all_patterns_and_short_items_are_found(spark):
    """All texts with the most changed words of items of 1 to 12 and 15 words, and every seventh of 20 words."""
    items = [(n, " ".join(f"n{n}w{k}" for k in range(n))) for n in (*range(1, 13), 15, 20)]
    texts = [" ".join(w if e else f"z{k}" for k, (w, e) in enumerate(zip(x.split(), equal, strict=True)))
             for n, x in items for equal in list(every_match(n))[:: 7 if n == 20 else 1]]
    texts += [" ".join([f"z{k}" for k in range(s)] + x.split()[s:]) for n, x in items for s in (n // 5 + 1,) if s < n]
    docs = list(enumerate(texts))
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = by_rule(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert {d for d, _ in want} == set(range(len(texts) - sum(n // 5 + 1 < n for n, _ in items)))


def test_items_without_an_id_match_and_copies_are_listed(spark):
    items = [(None, "p q r s t"), (None, "u v w x y"), (None, " ".join(ITEM)), (2, " ".join(ITEM)), (1, " ".join(ITEM))]
    docs = spark.createDataFrame([(1, "p q r s t u v w x y"), (2, " ".join(ITEM)), (3, "free")], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.equal_words, r.item_ids) for r in decontam.overlaps(docs, benchmark).collect()]
    assert sorted(got, key=repr) == [(1, None, 5, [None]), (1, None, 5, [None]), (2, 1, 20, [None, 1, 2])]
    assert [r.doc_id for r in decontam.clean_documents(docs, benchmark).collect()] == [3]
