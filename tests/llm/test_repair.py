"""Conversation repair: block tables against a best-first search, whole conversations against a brute force."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from greenlane.llm import repair as R

from .conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(rows):
    """(cost, audit, lines) by best-first search over all edit strings; rows: (role, text, must go, cut off)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, form, lines = heapq.heappop(heap)
        state = "" if not form else ("s" if form == "s" else form[-1])
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", form):
            return cost, audit, list(lines)
        legal = lambda x: re.match("^(s?(ua)*u?)$", form + x)
        if i < len(rows):
            role, text, must, cut = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, form, lines))
            if not must:
                if role[:1] in ("s", "u", "a") and legal(role[:1]):
                    heapq.heappush(heap, (cost + 5 * cut, audit + "K", i + 1, form + role[:1], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if legal(new[0]):
                        heapq.heappush(heap, (cost + 1 + 5 * cut, audit + "R", i + 1, form + new[0], (*lines, f"{new}:{text}")))
        for new in ("user", "assistant"):
            if legal(new[0]):
                heapq.heappush(heap, (cost + 5, audit + "I", i, form + new[0], (*lines, f"{new}:")))
    raise AssertionError


def plain(rows, damage=True):
    """The query's rows from (conv_id, turn, role, text) rows."""
    by = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            by[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, found in by.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "fine"), 0)
        for _, role, text in found:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "fine"
            seen.add((role, text))
            n[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(found))
        turns = {t for t, *_ in found if t is not None}
        cost, audit, lines = cheapest(marked)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, convs, longest, roles=("system", "user", "assistant", "tool", "", None, "u")):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "  ", "", None, "Why?  \n", "é.", "a\nb", "Stop. go"] + [f"text {k}." for k in range(30)]
    return [(c, r.choice([None, *range(longest)]), r.choice(roles), r.choice(texts)) for c in [None, *range(convs)] for _ in range(r.randrange(longest))]


def digest_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_tables_agree_with_the_search():
    t = R.blocks()
    assert len(t.vectors) < 64 and t.left[R.BLOCK].shape == (R.SYMBOLS ** R.BLOCK, len(t.vectors))
    r = random.Random(1)
    strings = [bytes(s) for n in range(3) for s in itertools.product(range(R.SYMBOLS), repeat=n)] + [bytes(r.randrange(9) for _ in range(r.randrange(3, 14))) for _ in range(400)]
    for s in strings:
        rows = [("x" if k == R.FORCED else ("system", "user", "assistant", "tool")[k >> 1], "t", k == R.FORCED, k < 8 and k & 1) for k in s]
        cost, audit, _ = cheapest(rows)
        letters, state = R.traced(s)
        assert "".join(letters) + {0: "", 1: "II", 2: "I", 3: ""}[state] == audit
        total, vector = 0, 0
        for size, code in reversed(R.cut_up(s)):
            total, vector = total + t.cost[size][code, vector], t.left[size][code, vector]
        assert total + t.vectors[vector][0] == cost


def test_composition_of_parts_is_the_whole():
    r = random.Random(2)
    for _ in range(50):
        s = bytes(r.randrange(9) for _ in range(r.randrange(1, 40)))
        cut = r.randrange(len(s) + 1)
        left, ends = R.composed(s[:cut])
        right, later = R.composed(s[cut:])
        whole, last = R.composed(s)
        assert (left[right] == whole).all()
        assert all(later[v, ends[right[v], q]] == last[v, q] for v in range(len(whole)) for q in range(4))


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_query_by_brute_force(spark, partitions, monkeypatch, tmp_path):
    rows = random_rows(3, 60, 9) + [(900, t, ("user", "assistant")[t % 2], f"line {t % 150}.") for t in range(400)] + [(901, 5, "user", "Same.")] * 50
    monkeypatch.setattr(R, "CHUNK_BYTES", 256)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit("clash")).withColumn("part", F.lit(1)).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
        got = digest_rows(R.op11_conversation_repair(spark, str(tmp_path)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain(rows)


def test_a_conversation_over_many_partitions_is_really_cut(spark, monkeypatch):
    rows = [(1, t, "user", f"line {t}.") for t in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = R.in_order(R.marked(spark.createDataFrame(rows, SCHEMA)))
        assert len(R.borders(ordered)) > 1
        assert digest_rows(R.digests(R.edits(R.marked(spark.createDataFrame(rows, SCHEMA))))) == plain(rows, damage=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_rows_are_legal_and_keep_their_texts(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Bye."), (2, 0, "user", " "), (None, None, None, "Hm.")]
    got = [tuple(r) for r in R.repaired(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [(1, 0, "system", "Be brief."), (1, 1, "user", "Hello."), (1, 3, "assistant", "Bye.")]


def test_empty_and_dropped(spark, tmp_path):
    gone = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert digest_rows(R.op11_conversation_repair(spark, f"{tmp_path}/a")) == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert R.op11_conversation_repair(spark, f"{tmp_path}/b").collect() == []


def test_query_by_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    assert digest_rows(R.op11_conversation_repair(spark, SF)) == sorted(db.execute(R.ORACLE_SQL).fetchall(), key=repr)
