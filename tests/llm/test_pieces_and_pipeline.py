"""SentencePiece sampling (exact probabilities, lossless decoding) and the pipeline stage by stage."""

import math
import os
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from greenlane.llm import decontam, pieces, rules, secrets
from greenlane.llm.common import table

from .conftest import SF

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary file")
TEXTS = [None, "", " ", "   a  b\n\n c\t", "▁literal ▁▁ x", "汉字 🙂 é \x00 \u2028 \xa0", "the thing is", "x" * 30_000, "ab" * 20_000 + " end", "\r\n", "a" * 49, "Ünïcödé" * 9]


def test_decoding_is_lossless(make_docs):
    rows = {r.doc_id: r for r in pieces.encoded(make_docs(TEXTS)).collect()}
    assert all(r.lossless for r in rows.values())
    for i, t in enumerate(TEXTS, 1):
        assert pieces.decode(rows[i].ids) == t and rows[i].n_pieces == len(rows[i].ids or ())
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.encoded(make_docs(TEXTS))).collect()}
    assert back == dict(enumerate(TEXTS, 1))


def listed(sampled):
    return [None if ids is None else ids.tolist() for ids in sampled]


def test_rows_do_not_depend_on_batches(spark, make_docs):
    together = listed(pieces.sample(TEXTS, list(range(len(TEXTS)))))
    assert together == [listed(pieces.sample([t], [k]))[0] for k, t in enumerate(TEXTS)]
    docs = make_docs(["the same text"] * 2 + ["the same text"], [3, 3, 4])
    a, b = (sorted((r.doc_id, r.ids) for r in pieces.encoded(d).collect()) for d in (docs, docs.repartition(1)))
    assert a == b and a[0] == a[1]


def every_path(vocab, unit, start=0):
    """(pieces, weight) of all segmentations."""
    if start == len(unit):
        yield (), 1.0
    for end in range(start + 1, len(unit) + 1):
        found = vocab.found.get(unit[start:end]) or ((-1 - ord(unit[start]), vocab.rare) if end == start + 1 else None)
        if found:
            for rest, w in every_path(vocab, unit, end):
                yield (found[0], *rest), found[1] * w


@pytest.mark.parametrize("unit", [" there", " {\r", "();\r\r", "    if", "x);\r\n  }"])
def test_segmentations_have_their_exact_probability(unit):
    """Also of texts with CRLF line ends and indentation, whole: over all paths through the text, not through its units."""
    n = 40_000
    vocab = pieces.vocabulary(pieces.MODEL)
    paths = {tuple(vocab.byte_id[-1 - p] if -128 <= p < 0 else p for p in path): w for path, w in every_path(vocab, unit)}
    total = sum(paths.values())
    seen = Counter(map(tuple, listed(pieces.sample([unit] * n, list(range(n))))))
    assert set(seen) <= set(paths)
    chi = sum((seen[p] - n * w / total) ** 2 / (n * w / total) for p, w in paths.items() if n * w / total > 5)
    cells = sum(n * w / total > 5 for w in paths.values())
    assert chi < cells + 6 * math.sqrt(2 * cells)


def test_no_piece_crosses_a_cut(sf_texts):
    """Every occurrence of every piece lies in one unit, and the units' arcs are all fitting pieces."""
    import random

    vocab, r = pieces.vocabulary(pieces.MODEL), random.Random(1)
    bits = [" ", "  ", "     ", "\r", "\r\n", "\n", "\t", "\x0b", "\u3000", "\xa0", "{", ");", "}", "the", "a", ".", "é"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 14))) for _ in range(1500)] + [t[:3000] for _, t in sf_texts[:40] if t]
    for text in texts:
        units = pieces.UNIT.findall(text)
        assert "".join(units) == text
        end, arcs = 0, set()
        for unit in units:
            counts, _, starts, found = (np.frombuffer(x, k) for x, k in zip(vocab.lattice(unit), pieces.PACKED, strict=True))
            arcs |= {(end + a, end + b, p) for a, b, p in zip(starts.tolist(), np.repeat(np.arange(1, len(unit) + 1), counts).tolist(), found.tolist(), strict=True) if p >= 0}
            end += len(unit)
        fit = {(a, b, vocab.found[text[a:b]][0]) for a in range(len(text)) for b in range(a + 1, min(a + vocab.longest, len(text)) + 1) if text[a:b] in vocab.found}
        assert arcs == fit
    assert not pieces.may_cross("a", " ") and not pieces.may_cross("\r", "a") and not pieces.may_cross("a", "\n")


def test_lattices_side_by_side_equal_single_ones():
    vocab = pieces.vocabulary(pieces.MODEL)
    units = [" the", "éçà", "▁x", "汉字abc", " aaaaaaaaaaaaaaaaaaaa", "\n", "   ", " Tionwh.!!", "z" * 48]
    *arrays, arc_at = vocab.lattices(units)
    nodes = [0, *(sum(map(len, units[:k + 1])) for k in range(len(units)))]
    for k, u in enumerate(units):
        assert vocab.lattice(u) == (arrays[0][nodes[k]:nodes[k + 1]].tobytes(), *(x[arc_at[k]:arc_at[k + 1]].tobytes() for x in arrays[1:]))


def test_hash_table_finds_what_it_holds():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    table_ = pieces.HashTable(keys)
    assert (table_.find(keys) == np.arange(len(keys))).all()
    assert (table_.find(rng.integers(2**63, 2**64, 5000, dtype=np.uint64)) == -1).all()


def test_encoding_takes_empty_tables_and_clashing_columns(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs(["a b"]).withColumns({"ids": F.lit(1), "n_pieces": F.lit(2)})
    assert pieces.encoded(docs).first().lossless and pieces.encoded(docs.limit(0)).count() == 0


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_each_stage_on_its_own_input(spark):
    docs = table(spark, SF, "documents")
    labels, benchmark = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "encoding"]
    stages = dict(corpus_pipeline.STAGES)
    kept = by_id(stages["quality_rules"](spark, docs, SF))
    learned = rules.learn(rules.statistics(docs), labels)
    test = lambda r: not r.base_failed and not any(all((r[n] >= c) if s == ">=" else (r[n] < c) for n, s, c in rule) for rule in learned)
    assert set(kept) == {r.doc_id for r in rules.statistics(docs).collect() if test(r)}

    from .test_near_duplicates import brute

    rows = by_id(docs)
    want = brute(list(rows), [r.text for r in rows.values()], 5, 80)
    assert set(by_id(stages["near_dedup"](spark, docs, SF))) == {i for i, (_, _, k) in want.items() if k}

    left = set(by_id(stages["decontamination"](spark, docs, SF)))
    assert left == set(rows) - {r.doc_id for r in decontam.overlaps(docs, benchmark).collect()}

    masked = by_id(stages["secret_scan"](spark, docs, SF))
    for i, r in rows.items():
        spans = secrets.find_spans(r.text)
        assert masked[i].text == secrets.masked(r.text, spans) and masked[i].n_chars == len(masked[i].text)
        assert (masked[i].text == r.text) == (not spans) and masked[i].source == r.source
    assert all(r.lossless for r in stages["encoding"](spark, docs, SF).collect())


def test_run_applies_the_stages_in_turn(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) == sorted(map(repr, docs.collect()))


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def leaked(docs, items):
    """Ids of documents with a window of any item that meets the rule, from all diagonals with an equal word."""
    places = {}
    split = [(t or "").lower().split() for t in items]
    for k, words in enumerate(split):
        for j, w in enumerate(words):
            places.setdefault(w, []).append((k, j))
    out = set()
    for i, t in docs:
        equal = {}
        for at, w in enumerate((t or "").lower().split()):
            for k, j in places.get(w, ()):
                equal.setdefault((k, at - j), set()).add(j)
        for (k, _), js in equal.items():
            size = min(decontam.WINDOW, len(split[k]))
            if 100 * len(js) >= decontam.SHARE * size and any(
                    100 * sum(s <= j < s + size for j in js) >= decontam.SHARE * size for s in range(len(split[k]) - size + 1)):
                out.add(i)
    return out


def test_decontamination_of_whole_texts_against_brute_force(spark):
    docs, benchmark = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    bad = leaked(rows, [r.text for r in benchmark.collect()])
    left = {r.doc_id for r in dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF).collect()}
    assert bad and left == {i for i, _ in rows} - bad
