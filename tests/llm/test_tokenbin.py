"""Token shards: units against whole texts, files against plain arrays, the query against a plain encoding."""

import json
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from greenlane.llm import tokenbin as B
from greenlane.llm.wavelet import WaveletMatrix, places

from .conftest import SF

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain_rows(rows, tokenizer):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows whose order is known."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_units_give_the_ids_of_whole_texts(tokenizer, sf_texts, monkeypatch):
    with open(PATH, "rb") as f:
        enc = B.Encoder(f.read())
    assert enc.cuts
    r = random.Random(1)
    bits = [" ", "  ", "\n", "\n\n", "\r\n", "\t", "a", "It's", "don't", "12", "x1", "é", "漢字", "...", "<|endoftext|>", "\u00a0", "\u3000", "\u2003", "\u0085", "\x1c", "'", "😀", "\x0b", "I'll ", " ’s", "à", "b,", ".", "?!", "\u1680"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(6000)] + [t or "" for _, t in sf_texts]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for kept in (B.UNITS_KEPT, 100, 100):  # the second time every unit is known, the third some are forgotten
        monkeypatch.setattr(B, "UNITS_KEPT", kept)
        for array in (pa.array(texts), pa.array(["x", *texts])[1:], pa.array([""])):
            ids, cuts = enc.encoded(array)
            assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] == (want if len(array) > 1 else [[]])
    units, starts = B.cut_units(pa.array(["It is, or\nis not", "", "so"], pa.large_binary()), True)
    assert units.to_pylist() == [b"It", b" is", b",", b" or", b"\n", b"is", b" not", b"so"] and starts.tolist() == [0, 7, 7, 8]


def test_cuts_between_kinds_and_words_by_the_model_alone(tokenizer, monkeypatch):
    """Letters, digits and marks are units of their own; all Latin letters, all pairs of ASCII and added tokens give the ids of the whole text."""
    with open(PATH, "rb") as f:
        content = f.read()
    units, _ = B.cut_units(pa.array(["f(x12)='s don't 3.5a"], pa.large_binary()), True)
    assert units.to_pylist() == [b"f", b"(", b"x", b"12", b")='s", b" don", b"'t", b" 3", b".", b"5", b"a"]
    marks = [chr(b) for b in range(1, 128)]
    texts = [a + b + c for a in marks for b in marks for c in ("", "s", " x1", "'ll")] + [x + chr(c) + "a" for c in range(0xA0, 0x260) for x in ("", " ", "b", "1")]
    texts += ["ab1c", "f(z)", "qqq.a b1", "x<|endoftext|>y", "<|endof text|>"]
    for added, direct in (([], True), (["b1", "(z", "qq."], True), (["qq"], False)):
        spec = json.loads(content)
        spec["added_tokens"] += [{**spec["added_tokens"][0], "id": 50257 + i, "content": t} for i, t in enumerate(added)]
        enc = B.Encoder(json.dumps(spec).encode())
        ids, cuts = enc.encoded(pa.array(texts))
        want = [e.ids for e in Tokenizer.from_buffer(json.dumps(spec).encode()).encode_batch(texts, add_special_tokens=False)]
        assert (enc.cuts, enc.direct) == (True, direct) and [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] == want
    enc = B.Encoder(content)
    whole = enc.whole
    monkeypatch.setattr(enc, "whole", lambda units: whole(units) if not any(u.strip().isalpha() for u in units) else 1 / 0)
    assert enc.encoded(pa.array(["Über den 12 Wolken, it's x1"]))[0].tolist() == tokenizer.encode("Über den 12 Wolken, it's x1", add_special_tokens=False).ids


def test_other_tokenizers_get_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        enc = B.Encoder(f.read())
    ids, cuts = enc.encoded(pa.array(["a b", "c"]))
    assert not enc.cuts and cuts[-1] == len(ids) == 3


@pytest.mark.parametrize("chunk_words", [1, 3, 1 << 12])
def test_a_file_reads_back(monkeypatch, chunk_words):
    monkeypatch.setattr(B, "CHUNK_WORDS", chunk_words)
    monkeypatch.setattr(B, "CHUNK_BITS", 64 * chunk_words)
    r = np.random.default_rng(1)
    ids = np.minimum(r.zipf(1.3, 2000), 50256).astype(np.uint32)
    shard = B.Shard(B.packed([None, 5, 5], [700, 0, 1300], ids, 3, 1, 99) + b"\n")
    assert (shard.ids() == ids).all() and shard.doc_ids == [None, 5, 5] and shard.starts.tolist() == [0, 700, 700, 2000]
    assert (shard.head["part"], shard.head["seq"], shard.head["before"]) == (3, 1, 99)
    places = r.integers(0, 2000, 60).tolist()
    assert shard.token(places) == ids[places].tolist()
    some = [1, 2, 7, int(ids.max()), 50256, 65536, 1 << 20, 49999]
    assert shard.count(some) == [int((ids == k).sum()) for k in some]
    for k in some:
        assert shard.places(k).tolist() == np.flatnonzero(ids == k).tolist()
    fresh = B.Shard(B.packed([1], [2000], ids, 0, 0, 0))
    fresh.token([0])
    if chunk_words < 4:  # one look-up unpacks a few chunks, not the planes
        assert all(len(p.loaded) <= 2 < len(p.chunk_before) for p in fresh.matrix.planes)


def test_broken_files_are_refused():
    good = B.packed([1], [3], np.array([1, 2, 3], np.uint32), 0, 0, 0)
    for bad in (b"XXXX" + good[4:], good[:-3]):
        with pytest.raises(ValueError):
            B.Shard(bad)


def test_query_by_plain_encoding(spark, tokenizer, sf_texts):
    rows = sorted(sf_texts)
    got = sorted(tuple(r) for r in B.op13_token_shards(spark, SF).collect())
    assert got == plain_rows(rows, tokenizer)


def test_small_shards_nulls_and_repeated_rows(spark, tokenizer, make_docs, tmp_path):
    texts = [None, "", "one two", "one two", "three\n\nfour ", "x " * 500, "é漢😀", "one two"]
    ids = [4, 1, 2, 2, 9, 7, None, 3]
    docs = make_docs(texts, ids).selectExpr("*", "1 as part", "2 as start", "3 as tie", "4 as row")
    B.write_shards(docs, f"{tmp_path}/shards", PATH, 2, shard_tokens=5)
    assert B.shard_files(spark, f"{tmp_path}/shards").count() > 2
    order = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0))
    want = plain_rows(order, tokenizer)
    docs_back = B.read_documents(spark, f"{tmp_path}/shards").orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in docs_back] == want
    whole = [i for r in docs_back for i in r.ids]
    assert [tokenizer.decode(r.ids[:-1], skip_special_tokens=False) for r in docs_back] == [t or "" for _, t in order]
    some = [2, whole[0], 49999, max(set(whole), key=whole.count)]
    assert {r.id: r.n for r in B.count_ids(spark, f"{tmp_path}/shards", some).collect()} == {k: whole.count(k) for k in some}
    for k in some:
        assert sorted(r.start for r in B.find_id(spark, f"{tmp_path}/shards", k).collect()) == [i for i, x in enumerate(whole) if x == k]


def test_no_documents(spark, make_docs, tmp_path):
    B.write_shards(make_docs(["a"]).limit(0), f"{tmp_path}/none", PATH, 2)
    assert B.read_documents(spark, f"{tmp_path}/none", ids=False).collect() == []


def test_units_become_bytes_without_a_scalar_each():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, n).tolist()) for n in rng.integers(0, 9, 50_000)]
    for units in (pa.array(words, pa.large_binary()), pa.array(words, pa.large_binary()).slice(7, 1000), pa.array([], pa.large_binary())):
        assert B.unit_bytes(units) == units.to_pylist()

    def least(f):
        took = []
        for _ in range(5):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    units = pa.array(words, pa.large_binary())
    assert least(lambda: B.unit_bytes(units)) < 0.7 * least(units.to_pylist)


def test_planes_are_dealt_by_places():
    values = np.random.default_rng(4).integers(0, 50_000, 100_000)
    matrix, now = WaveletMatrix.of(values, 16), values
    for plane, bit in zip(matrix.planes, reversed(range(16)), strict=True):
        ones = now >> bit & 1 == 1
        assert (plane.bits() == ones).all()
        zero, one = places(ones)
        now = np.concatenate([now[~ones], now[ones]])
        assert (zero == np.arange(len(ones))[~ones]).all() and (one == np.arange(len(ones))[ones]).all()
    assert (matrix.values() == values).all()
