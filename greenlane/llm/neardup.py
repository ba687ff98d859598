"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents with equal sets become
one node. 160 MinHash samples give 40 band keys of four samples each; two sets at the threshold share a
key with a probability of at least 1 - 1e-9. The samples are also folded into an odd sketch: each toggles one
of 512 bits, so the population count of two sketches' XOR estimates how many samples differ. Pairs
whose estimate lies over five standard deviations below the threshold go; the others are confirmed on full sets.

Links are looked for without listing the pairs of a bucket:

1. each node against the first node (pivot) of each of its buckets; of these, the most similar is confirmed;
2. components of the confirmed links; then the other pivot pairs that still join two components, and two
   more pivots, chosen by hash, of each bucket that still holds several;
3. what still holds several components is searched for pairs across them: members that have a
   plausible partner by size and sketch (a semi join, so as many rows as members at most) are compared by
   what sets them apart from their pivot, which is small and gives the exact similarity. Buckets are split by
   size class, of which only neighbours meet. The join yields only pairs that reach the threshold; they are confirmed on full sets.

So every pair of a bucket is confirmed, refuted, or already in one component. Components come from
pointer doubling (a node's best pivot is smaller than itself, so the first links are a forest), then from
alternating large-star and small-star steps, on written tables.

Defined cases: null or blank texts have an empty set, no link, and are kept; equal texts repeated under one
doc_id have one component, different texts under one doc_id each have their own; null doc_ids never name a component unless all its rows have none, and such rows are kept;
ties take the smallest doc_id; other columns are ignored (``kept_documents`` returns them).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenlane.llm.common import dropped, map_batches, table, written

SAMPLES, ROWS = 160, 4
BANDS = SAMPLES // ROWS
ODD_BITS, ODD_WORDS, ODD_MARGIN = 512, 8, 0.22
MORE_PIVOTS = 2
#: Rows of at most 16 bytes each up to which a counted table is broadcast.
BROADCAST_ROWS = 500_000
_RNG = np.random.default_rng(20260101)
FACTORS = _RNG.integers(1, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
FLIPS = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)
MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles (A-Z lower-cased, split at ASCII white space)."""
    words = [t.encode().lower().split() if t else [] for t in texts]
    flat = [w for row in words for w in row]
    hashed = pd.util.hash_array(np.array(flat + [b""], dtype=object), categorize=False)[:-1]
    out, at = [], 0
    for row in words:
        h = hashed[at:at + len(row)]
        at += len(row)
        size = min(width, len(h))
        if not size:
            out.append(np.empty(0, np.uint64))
            continue
        s = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            s = _mix(s * MUL + h[k:len(h) - size + 1 + k])
        out.append(np.unique(s))
    return out


def node_of(s: np.ndarray) -> int:
    """The 64-bit name of a set, signed."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def samples(s: np.ndarray) -> np.ndarray:
    """MinHash samples of a set."""
    low, best = (s >> np.uint64(32)).astype(np.uint32), np.full(SAMPLES, 2**32 - 1, np.uint32)
    for a in range(0, len(low), 4096):
        best = np.minimum(best, ((low[a:a + 4096, None] * FACTORS) ^ FLIPS).min(axis=0))
    return best


def band_keys(m: np.ndarray) -> np.ndarray:
    """(sets x BANDS) keys from (sets x SAMPLES) samples; the band is part of the key."""
    parts = m.reshape(len(m), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(m), BANDS))
    for k in range(ROWS):
        key = _mix(key * MUL + parts[:, :, k])
    return key.view(np.int64)


def odd_sketches(m: np.ndarray) -> np.ndarray:
    """(sets x ODD_WORDS): each sample toggles one bit."""
    bit = _mix((m.astype(np.uint64) << np.uint64(8)) + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(ODD_BITS)
    place = np.arange(len(m))[:, None] * ODD_BITS + bit.astype(np.int64)
    odd = np.bincount(place.reshape(-1), minlength=len(m) * ODD_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(m), ODD_BITS), axis=1).view(np.int64)


def most_odd(threshold: int) -> int:
    """Largest XOR population count of a pair that is confirmed (the estimate inverted at the margin)."""
    return math.ceil(ODD_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - threshold / 100 + ODD_MARGIN) / ODD_BITS)))


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, node (null for an empty set), n, keys, o0 .. o7 of every document."""
    names = ["doc_id", "node", "n", "keys", *[f"o{k}" for k in range(ODD_WORDS)]]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1).to_pylist(), width)
        m = np.stack([samples(s) for s in sets])
        keys, odd = np.ascontiguousarray(band_keys(m)), odd_sketches(m)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1)))
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            listed, *[pa.array(np.ascontiguousarray(odd[:, k])) for k in range(ODD_WORDS)]], names=names)

    schema = "doc_id long, node long, n long, keys array<long>, " + ", ".join(f"o{k} long" for k in range(ODD_WORDS))
    return map_batches(docs, run, schema)


def few(df: DataFrame) -> DataFrame:
    """A broadcast hint for a written narrow table that is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge list (a, b) reaches."""
    now, before = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "cc"), None
    while True:
        seen = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if seen == before or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = written(small.select("e.a", "e.b").filter("a != b").distinct(), "cc")
        dropped(now)
        now, before = after, seen


def forest_roots(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest given as (a, b) with b < a and one b for each a, by pointer doubling."""
    now = parents.union(parents.select("b", "b").distinct().join(parents.select(F.col("a").alias("b")), "b", "left_anti").select("b", F.col("b").alias("c")))
    now = written(now.toDF("node", "root"), "cc")
    while True:
        step = now.join(now.select(F.col("node").alias("root"), F.col("root").alias("above")), "root")
        step = written(step.select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "cc")
        dropped(now)
        now = step.select("node", "root")
        now._scratch_path = step._scratch_path
        if step.filter("moved").isEmpty():
            return now


def _similar(x: str, y: str, threshold: int) -> Column:
    """Size and sketch tests of two aliased sides with n and o0 .. o7."""
    apart = sum((F.bit_count(F.col(f"{x}.o{k}").bitwiseXOR(F.col(f"{y}.o{k}"))) for k in range(ODD_WORDS)), F.lit(0))
    sizes = 100 * F.least(F.col(f"{x}.n"), F.col(f"{y}.n")) >= threshold * F.greatest(F.col(f"{x}.n"), F.col(f"{y}.n"))
    return sizes & (apart <= most_odd(threshold))


def size_class(threshold: int) -> Column:
    """A class of ``n`` such that sets of similar sizes are in the same class or in the next."""
    width = math.log(100 / max(threshold, 1)) * (1 + 1e-9) or 1e-6
    return F.floor(F.log(F.col("n").cast("double")) / width).cast("int")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, set) of the given (node, first_id), one row each, from the texts of these ids only."""
    rows = docs.join(few(nodes.select(F.col("first_id").alias("wanted")).distinct()), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s for s in shingle_sets(batch.column(1).to_pylist(), width) if len(s)]
        return pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                          names=["node", "set"])

    sets = map_batches(rows, run, "node long, set array<long>", rows=256)
    return sets.join(few(nodes.select("node")), "node", "left_semi").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    return both.filter(100 * F.col("common") >= threshold * (F.col("sizes") - F.col("common"))).select("a", "b")


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, pivot, d): what the node's set and its pivot's set do not share, as 32-bit hashes."""
    both = pairs.join(sets.withColumnRenamed("set", "own"), "node").join(sets.select(F.col("node").alias("pivot"), F.col("set").alias("base")), "pivot")
    d = F.concat(F.array_except("own", "base"), F.array_except("base", "own"))
    return both.select("node", "pivot", F.array_distinct(F.transform(d, lambda e: F.shiftright(e, 32).cast("int"))).alias("d"))


def open_members(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, pivot, root) of the buckets of three or more nodes that hold several components."""
    members = shared.join(labels, "node", "left").select("key", "node", "pivot", F.coalesce("root", "node").alias("root"))
    members = written(members, "dup-members")
    several = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size")).filter("lo < hi and size > 2").select("key")
    out = written(members.join(several, "key", "left_semi"), "dup-members")
    dropped(members)
    return out


def completed(sets: DataFrame, ends: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``sets`` with those of further nodes."""
    missing = ends.toDF("node").distinct().join(sets.select("node"), "node", "left_anti").join(nodes.select("node", "first_id"), "node")
    missing = written(missing, "dup-named")
    return sets if missing.isEmpty() else sets.union(written(full_sets(docs, missing, width), "dup-sets"))


def grown(links: DataFrame, labels: DataFrame, pairs: DataFrame, sets: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Links and labels with those of the pairs that are confirmed."""
    more = written(confirmed(pairs, sets, threshold), "dup-links")
    if more.isEmpty():
        return links, labels
    links = links.union(more)
    return links, written(components(links), "dup-labels")


def linked(docs: DataFrame, sketches: DataFrame, width: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, labels): each node with its sizes and first id; (node, root) of the nodes with links."""
    odd = [f"o{k}" for k in range(ODD_WORDS)]
    first = sketches.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.max("n").alias("n"), F.any_value("keys").alias("keys"), *[F.max(o).alias(o) for o in odd])
    nodes = written(first, "dup-nodes")
    places = nodes.select("node", F.explode("keys").alias("key"))
    buckets = places.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot")).filter("size > 1")
    shared = written(places.join(buckets.select("key", "pivot"), "key"), "dup-buckets")

    # 1: pivots, the most similar first
    sig = nodes.select("node", "n", *odd)
    stars = shared.filter("node != pivot").select("node", "pivot").distinct()
    stars = stars.join(sig.alias("x"), "node").join(sig.withColumnRenamed("node", "pivot").alias("y"), "pivot").filter(_similar("x", "y", threshold))
    apart = sum((F.bit_count(F.col(f"x.o{k}").bitwiseXOR(F.col(f"y.o{k}"))) for k in range(ODD_WORDS)), F.lit(0))
    stars = written(stars.select(F.col("node").alias("a"), F.col("pivot").alias("b"), apart.alias("apart")), "dup-stars")
    ends = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    named = written(ends.join(nodes.select("node", "first_id"), "node"), "dup-named")
    sets = written(full_sets(docs, named, width), "dup-sets")
    best = stars.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("s")).select("a", F.col("s.b").alias("b"))
    links = written(confirmed(best, sets, threshold), "dup-links")
    labels = written(forest_roots(links), "dup-labels")

    # 2: the other pivots, and two more pivots of each bucket that still holds several components
    root = lambda side: F.coalesce(F.col(f"root_{side}"), F.col(side))
    side = lambda s: labels.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}"))
    rest = stars.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left").filter(root("a") != root("b")).select("a", "b")
    members = open_members(shared, labels)
    pick = lambda r: F.min_by(F.struct("node", "root"), F.struct(F.xxhash64("node", "key", F.lit(r)), "node"))
    picks = members.groupBy("key").agg(F.array(*[pick(r) for r in range(MORE_PIVOTS)]).alias("p")).select("key", F.explode("p").alias("p"))
    pairs = members.join(picks, "key").filter("root != p.root").select("node", F.col("p.node").alias("pivot")).distinct()
    pairs = pairs.join(sig.alias("x"), "node").join(sig.withColumnRenamed("node", "pivot").alias("y"), "pivot").filter(_similar("x", "y", threshold))
    pairs = written(rest.union(pairs.select("node", "pivot")), "dup-pairs")
    if not pairs.isEmpty():
        sets = completed(sets, pairs.select("a").union(pairs.select("b")), nodes, docs, width)
        links, labels = grown(links, labels, pairs, sets, threshold)

    # 3: exact search across the components of a bucket
    # a bucket is split by size class, and only neighbouring classes meet
    across = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") == F.col("y.at")) & (F.col("x.root") != F.col("y.root")) & _similar("x", "y", threshold)
    meeting = lambda df, *steps: df.withColumn("at", F.explode(F.array(*[F.col("class") + k for k in steps])))
    members = written(open_members(shared, labels).filter("node != pivot").join(sig, "node").withColumn("class", size_class(threshold)), "dup-open")
    members = written(members.alias("x").join(meeting(members, -1, 0, 1).alias("y"), across, "left_semi"), "dup-open")
    if members.isEmpty():
        return nodes, labels
    sets = completed(sets, members.select("node").union(members.select("pivot")), nodes, docs, width)
    apart = written(differences(members.select("node", "pivot").distinct(), sets), "dup-differences")
    rows = members.join(apart, ["node", "pivot"]).join(nodes.select("node", "keys"), "node")
    # |x ^ y| = |dx ^ dy|, and common = (|x| + |y| - |x ^ y|) / 2; a pair counts in its first common bucket
    sizes = F.col("x.n") + F.col("y.n")
    twice = sizes - F.size("x.d") - F.size("y.d") + 2 * F.size(F.array_intersect("x.d", "y.d"))
    smaller = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
    reached = smaller & ((100 + threshold) * twice >= 2 * threshold * sizes)
    more = rows.alias("x").join(meeting(rows, -1, 0).alias("y"), across & reached & (F.col("x.key") == F.array_min(F.array_intersect("x.keys", "y.keys"))))
    more = more.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    return nodes, grown(links, labels, more, sets, threshold)[1]


def classes(docs: DataFrame, width: int, threshold: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node (hash of the shingle set), n, root (the class, also where two share a smallest id), component_id of every row."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    sketches = written(sketched(texts, width), "dup-sketches")
    nodes, labels = linked(texts, sketches, width, threshold)
    named = labels.join(nodes.select("node", "first_id"), "node")
    least = named.groupBy("root").agg(F.min("first_id").alias("component"))
    named = labels.join(least, "root")
    all_nodes = nodes.select("node", "first_id").join(named, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.coalesce("component", "first_id").alias("component"))
    rows = sketches.select("doc_id", "node", "n").join(all_nodes, "node", "left")
    return rows.select("doc_id", "node", "n", "root", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 3, threshold: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents are linked where 100 * common >= threshold * union of their sets of ``width``-word shingles.
    """
    return classes(docs, width, threshold, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def row_nodes(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` with ``dup_node``, the hash of each text's shingle set (null without words); used on rows of few ids only."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(at).cast(pa.string()).to_pylist(), width)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())], names=[*batch.schema.names, "dup_node"])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField("dup_node", T.LongType())]))


def kept_documents(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each component, with all columns: the one with the smallest doc_id.

    What goes is decided by (doc_id, shingle set), so other texts under the id of a copy stay. Where that id has several
    texts of the component, the one with the smallest set hash stays; of rows with one id and set, those equal in
    whole are one and others stay. Rows with a null id or without words are never dropped.
    """
    judged = written(classes(docs, width, threshold).filter("n > 0 and doc_id is not null").select("doc_id", "node", "root", (F.col("doc_id") == F.col("component_id")).alias("own")), "dup-judged")
    per_id = judged.groupBy(F.col("doc_id").alias("other_id")).agg(F.count_if("own").alias("own"), F.count(F.lit(1)).alias("n"))
    per_id = written(per_id.filter("own = 0 or n > 1"), "dup-gone")
    same = lambda df, ids: df["doc_id"] == ids["other_id"]
    copies, several = few(per_id.filter("own = 0").select("other_id")), per_id.filter("own > 0").select("other_id")
    out = docs.join(copies, same(docs, copies), "left_anti")
    if several.isEmpty():
        return out
    several = few(several)
    stay = judged.filter("own").groupBy(F.col("doc_id").alias("other_id"), "root").agg(F.min("node").alias("stay")).select("other_id", "stay")
    mixed = row_nodes(out.join(several, same(out, several), "left_semi"), width)
    with_words = mixed.join(stay, same(mixed, stay) & (mixed["dup_node"] == stay["stay"]), "left_semi")
    mixed = with_words.unionByName(mixed.filter(mixed["dup_node"].isNull())).drop("dup_node").dropDuplicates()
    return out.join(several, same(out, several), "left_anti").unionByName(mixed)


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
with recursive words as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from words),
groups as (select s, min(doc_id) as node from sets where len(s) > 0 group by s),
tokens as (select node, len(s) as n, unnest(s) as t from groups),
common as (select x.node as a, y.node as b, any_value(x.n) as na, any_value(y.n) as nb, count(*) as c from tokens x join tokens y on x.t = y.t and x.node < y.node group by all),
links as (select a, b from common where 100 * c >= 85 * (na + nb - c)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select node as a, node as b from groups union select r.a, e.b from reach r join both_ways e on e.a = r.b),
roots as (select a as node, min(b) as root from reach group by a)
select d.doc_id, cast(len(d.s) as bigint) as n_shingles, coalesce(r.root, d.doc_id) as component_id, d.doc_id = coalesce(r.root, d.doc_id) as kept
from sets d left join groups g on g.s = d.s left join roots r on r.node = g.node
"""
