"""Periodic runs against a brute force over all periods; the wavelet matrix against plain arrays."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from greenlane.llm import periods as P
from greenlane.llm.wavelet import WaveletMatrix

from .conftest import SF


def plain_runs(words):
    """All runs by trying every period at every stretch of equal words so far apart."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(((-(e - s), s, q) for s, e, q in runs), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    digest = (sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))
    return (doc_id, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4), *digest)


def word_strings(seed):
    """Word strings with planted repeats: few letters, powers, Fibonacci words, nested powers, noise."""
    r = random.Random(seed)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, list("ab" * 3 + "c" + "ab" * 3)]
    for _ in range(150):
        out.append([r.choice("ab") for _ in range(r.randrange(60))])
    for _ in range(150):
        word, text = [r.choice("abc") for _ in range(r.randrange(1, 14))], []
        while r.random() < 0.8:
            text += (word * r.randrange(1, 8))[: r.randrange(1, 90)] + [r.choice("abcd") for _ in range(r.randrange(4))]
        out.append(text * r.randrange(1, 6))
    a, b = ["a"], ["a", "b"]
    while len(b) < 200:
        a, b = b, b + a
    return [*out, b, (b[:34] + ["x"]) * 5, (b[:34] * 4)]


def test_runs_by_brute_force():
    strings = word_strings(1)
    for words in strings:
        symbols = np.array([*map(ord, words), 1000], np.int64)
        assert P.runs_of(symbols) == plain_runs(words), words
    assert sum(bool(plain_runs(w)) for w in strings) > 100


def test_suffix_array_and_block_ranges():
    r = np.random.default_rng(2)
    s = np.append(r.integers(0, 3, 300), 9)
    array, blocks = P.suffixes(s)
    assert array.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    for k, (at, lo, hi) in enumerate(blocks):
        same = lambda i, j, size=1 << k: s[i: i + size].tolist() == s[j: j + size].tolist()
        want = {p for p in range(0, len(s), 1 << k) if any(same(p, j) for j in range(len(s)) if j != p)}
        assert set(at.tolist()) == want
        for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True):
            assert sorted(array[a:b]) == [j for j in range(len(s)) if same(p, j)]


@pytest.mark.parametrize(("n", "top"), [(0, 5), (1, 1), (64, 2), (1000, 700), (777, 1 << 20)])
def test_wavelet_matrix(n, top):
    r = np.random.default_rng(n)
    v = r.integers(0, top, n)
    m = WaveletMatrix.of(v)
    assert (m.values() == v).all()
    if not n:
        assert m.count(np.array([0, 3])).tolist() == [0, 0]
        return
    at, lo = r.integers(0, n, 50), r.integers(0, n, 50)
    hi = lo + r.integers(0, n - lo + 1)
    x = np.append(r.integers(0, top + 3, 45), v[:1].repeat(5))
    cuts = [v[a:b] for a, b in zip(lo, hi, strict=True)]
    assert (m.access(at) == v[at]).all()
    assert m.count(x, lo, hi).tolist() == [(c == y).sum() for c, y in zip(cuts, x, strict=True)]
    assert m.count(x).tolist() == [(v == y).sum() for y in x]
    assert m.below(x, lo, hi).tolist() == [(c < y).sum() for c, y in zip(cuts, x, strict=True)]
    assert m.successor(x, lo, hi).tolist() == [min((w for w in c if w >= y), default=-1) for c, y in zip(cuts, x, strict=True)]
    for y in x[:20].tolist():
        assert m.occurrences(y).tolist() == np.flatnonzero(v == y).tolist()


def test_query_by_brute_force(spark, make_docs, tmp_path):
    texts = [" ".join(w) for w in word_strings(5)] + [None, "", " \n\t", "é é " * 9, "x \x0b" * 12, "deja vu " * 3000 + "end"]
    ids = [*range(10, 10 + len(texts) - 1), None]
    make_docs(texts, ids).unionByName(make_docs(texts[60:70], ids[60:70])).selectExpr("*", "1 as runs", "2 as n_words").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in P.op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((plain_row(i, t) for i, t in [*zip(ids, texts, strict=True), *zip(ids[60:70], texts[60:70], strict=True)]), key=repr)
    assert sum(r[1] > 0 for r in got) > 100


def test_query_on_the_table(spark, sf_texts):
    got = {r.doc_id: tuple(r) for r in P.op12_periodic_runs(spark, SF).collect()}
    short = [(i, t) for i, t in sf_texts if len(t) < 4000]
    assert len(got) == len(sf_texts) and len(short) > 100
    assert all(got[i] == plain_row(i, t) for i, t in short)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_collapsed_text_and_runs(spark, make_docs):
    row = P.periodic_runs(make_docs(["so it goes " * 4 + "on"])).first()
    assert row.collapsed == "so it goes on" and [tuple(r) for r in row.runs] == [(0, 12, 3)] and row.n_words == 13


def test_no_documents(spark, make_docs):
    assert P.periodic_runs(make_docs(["a"]).limit(0)).collect() == []
