"""Benchmark decontamination by spaced-seed hashing. Native.

An item matches a document where the best stretch of ``WINDOW`` successive words of it (the whole item where
it is shorter) has at least ``SHARE`` percent equal words in place. Words are lower-cased and split at white space. Places
of the stretch before the document's first or after its last word count as words that differ.

Fixed masks choose the words of a seed: a ``1`` takes the word at that place, a ``0`` ignores it. Every placing of a mask on
an item, and of all masks on a document, is hashed with the mask. The masks of an item depend on how many words of its
stretch may differ (``SEEDS``); each set is such that, whichever words these are, some mask takes equal words only, so no match is
without a hit (a test goes through all patterns). Of items under five words no word may differ: their seed is the whole item.
Hits are joined on the hash and reduced to (document, item, diagonal), and the item's words are laid over each such
diagonal.

``MASKS`` and ``SPAN`` are the condition that the SQL puts on a diagonal: one equal word, which every match has.

The document side of the hash join is never shuffled while the benchmark's hashes are few (counted
against ``BROADCAST_ROWS``); beyond that it is an ordinary shuffled join. The same holds for the
verification, which joins (document, diagonals) back to the texts.

Defined cases: null or blank texts match nothing; items with the same words count as the one with the smallest
item_id (null if all are null), and ``item_ids`` lists all, null included; rows repeated under one doc_id give one
result; null doc_ids are matched as one id; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import bound, table, word_array, written

MASKS = ("1",)
SPAN = 1
WINDOW, SHARE = 20, 80
BROADCAST_ROWS = 500_000
#: Masks by the number of words that may differ (of 5 to 9, 10 to 14, 15 to 19 and 20 words).
SEEDS = {1: ("1101", "1011"), 2: ("11101", "1100101"), 3: ("111011", "110100011"), 4: ("111011", "1101011")}


def hashed_words(text: Column) -> Column:
    """64-bit hashes of the lower-cased words."""
    return F.transform(word_array(F.lower(text)), lambda w: F.xxhash64(w))


def may_differ(n: int) -> int:
    """How many words of the stretch of an item of ``n`` words may differ."""
    size = min(WINDOW, n)
    return size - -(-SHARE * size // 100)


def masks_of(n: int) -> tuple[str, ...]:
    """The masks of an item of ``n`` words."""
    return SEEDS.get(may_differ(n), ("1" * n,))


def seeds(rows: DataFrame, masks: list[str]) -> DataFrame:
    """One row (``seed``, ``at``) per place of the array ``words`` and mask that fits there; other columns stay."""
    least = min(map(len, masks))
    places = rows.filter(F.size("words") >= least).select("*", F.explode(F.sequence(F.lit(0), F.size("words") - least)).alias("at"))
    taken = lambda m: [F.get("words", F.col("at") + k) for k, bit in enumerate(m) if bit == "1"]
    of = lambda m: F.when(F.col("at") + len(m) <= F.size("words"), F.xxhash64(F.lit(m), *taken(m)))
    return places.select("*", F.explode(F.array(*[of(m) for m in masks])).alias("seed")).filter(F.col("seed").isNotNull())


def _small(df: DataFrame, size: Column | None = None) -> DataFrame:
    """A broadcast hint for a written table whose rows (or the sum of ``size``) are counted to be few."""
    n = df.agg(F.sum(size) if size is not None else F.count(F.lit(1))).first()[0]
    return F.broadcast(df) if (n or 0) <= BROADCAST_ROWS else df


def best_window(words: Column, item: Column, diagonal: Column) -> Column:
    """Most equal words of any WINDOW successive words of the item (or all of it) on a diagonal."""
    equal = F.transform(item, lambda w, j: F.when(F.get(words, diagonal + j) == w, 1).otherwise(0))
    size = F.least(F.lit(WINDOW), F.size(item))
    return bound(equal, lambda e: F.array_max(F.transform(
        F.sequence(F.lit(0), F.size(e) - size), lambda s: F.aggregate(F.slice(e, s + 1, size), F.lit(0), lambda a, x: a + x))))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, equal_words, window_words, item_ids): the verified overlaps, one row per document and words of an item."""
    items = benchmark.select("item_id", hashed_words(F.col("text")).alias("words")).filter(F.size("words") >= SPAN)
    ids = F.transform(F.sort_array(F.collect_set(F.struct("item_id"))), lambda i: i["item_id"])
    items = items.groupBy("words").agg(F.min("item_id").alias("item_id"), ids.alias("item_ids"))
    items = written(items.withColumn("item", F.xxhash64("words")), "decontam-items")
    size = F.least(F.size("words"), F.lit(WINDOW))
    groups: dict[tuple[str, ...], list[int]] = {}
    for (n,) in items.select(size).distinct().collect():
        groups.setdefault(masks_of(n), []).append(n)
    groups = groups or {("1",): [1]}
    masks = sorted({m for group in groups for m in group}, key=lambda m: (len(m), m))
    targets = reduce(DataFrame.union, [seeds(items.filter(size.isin(sizes)), list(group)) for group, sizes in groups.items()])
    targets = written(targets.select("seed", "item", F.col("at").alias("item_at")).distinct(), "decontam-seeds")

    texts = docs.select(docs[id_col].alias("doc_id"), hashed_words(docs[text_col].cast("string")).alias("words"))
    hits = seeds(texts, masks).select("doc_id", "at", "seed").join(_small(targets), "seed")
    found = hits.select("doc_id", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    found = written(found, "decontam-hits")

    pairs = texts.join(_small(found.withColumnRenamed("doc_id", "hit_id")), F.col("doc_id").eqNullSafe(F.col("hit_id")))
    pairs = pairs.join(_small(items.select("item", "item_id", "item_ids", F.col("words").alias("item_words")), F.size("item_words")), "item")
    pairs = pairs.select("doc_id", "item", "item_id", "item_ids", best_window(F.col("words"), F.col("item_words"), F.col("diagonal")).alias("equal_words"),
                         F.least(F.lit(WINDOW), F.size("item_words")).alias("window_words"))
    pairs = pairs.filter(100 * F.col("equal_words") >= SHARE * F.col("window_words"))
    best = pairs.groupBy("doc_id", "item").agg(F.first("item_id").alias("item_id"), F.max("equal_words").cast("long").alias("equal_words"),
                                               F.max("window_words").cast("long").alias("window_words"), F.first("item_ids").alias("item_ids"))
    return best.drop("item")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a verified overlap, with all their columns."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id")).distinct()
    bad = _small(written(bad, "decontam-bad"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


_WORDS = "list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_SEED = " union all ".join(
    f"select doc_or_item, place, w, {m} as mask, [" + ", ".join(f"w[place + {k + 1}]" for k, bit in enumerate(mask) if bit == "1") + "] as seed from {0}"
    for m, mask in enumerate(MASKS))
ORACLE_SQL = f"""
with items as (select min(item_id) as doc_or_item, w from (select item_id, {_WORDS.format('text')} as w from benchmark) group by w having len(w) >= {SPAN}),
docs as (select doc_id as doc_or_item, {_WORDS.format('text')} as w from documents),
item_places as (select doc_or_item, w, unnest(range(0, len(w) - {SPAN} + 1)) as place from items),
doc_places as (select doc_or_item, w, unnest(range(0, len(w) - {SPAN} + 1)) as place from docs where len(w) >= {SPAN}),
item_seeds as ({_SEED.format('item_places')}),
doc_seeds as (select doc_or_item, place, mask, seed from ({_SEED.format('doc_places')})),
found as (select distinct d.doc_or_item as doc_id, i.doc_or_item as item_id, d.place - i.place as diagonal
    from doc_seeds d join item_seeds i on d.mask = i.mask and d.seed = i.seed),
laid as (select f.doc_id, f.item_id, least({WINDOW}, len(i.w)) as size,
    list_transform(range(0, len(i.w)), lambda j: case when diagonal + j >= 0 and d.w[diagonal + j + 1] = i.w[j + 1] then 1 else 0 end) as equal
    from found f join docs d on d.doc_or_item = f.doc_id join items i on i.doc_or_item = f.item_id),
best as (select doc_id, item_id, size, list_max(list_transform(range(0, len(equal) - size + 1), lambda s: list_sum(list_slice(equal, s + 1, s + size)))) as best from laid)
select doc_id, item_id, cast(max(best) as bigint) as equal_words, cast(max(size) as bigint) as window_words
from best where 100 * best >= {SHARE} * size group by doc_id, item_id
"""
