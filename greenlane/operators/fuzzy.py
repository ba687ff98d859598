"""Names that are not written as in the master data, by deletions or q-grams, and edit distance.

Names with a target within the allowed edits are searched in rounds: the equal target, then those one edit away, then two. A name
goes into the next round only if a target found there could still be its nearest one or within ``margin`` of that, so
a name of which only the case differs never meets the many targets two edits away.

Two names within ``k`` edits become equal when at most ``k`` characters of each are deleted. Rounds of short names join on the
hash of what is left: a name has about ``n * n / 2`` such forms, whatever the other names are, and forms that meet are of names
at most ``2 * k`` edits apart, so the work grows with the names and not with how many share a gram.

Where it is less work, and for names longer than ``LONG``, whose forms are too many, the last round takes padded 3-grams with their
positions. ``k`` edits destroy at most ``3 * k`` of a name's grams, so two names within ``k`` edits share one of the ``3 * k + 1``
grams of each that are rarest among the targets, at places at most ``k`` apart. Only these are joined, on (gram, place); the count
filter (at most ``3 * k`` distinct grams of one name missing in the other) comes before the edit distance. A name resolves
to its nearest target only if every other target is at least ``margin`` edits farther; else it goes to review. No
pair is dropped by a cap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import norm
from .joins import lookup_join, table_join
from .ranking import _materialize
from .writes import derive_order_date, ids_by_name

Q, MARGIN, EDITS = 3, 1, 2
#: Characters up to which a name's forms with two deletions (2,081 at most) are listed.
LONG = 64


def allowed_edits(name: str) -> Column:
    """Edits allowed for a normalised name: none below 4 characters, one below 8, else two."""
    n = F.char_length(name)
    return F.when(n < 4, 0).when(n < 8, 1).otherwise(EDITS)


# -- by deletions ----------------------------------------------------------------
def _shortened(forms: DataFrame) -> DataFrame:
    """Forms with one more character deleted: of equal neighbours the last one, and none before the place of the deletion before."""
    at = F.explode(F.sequence(F.greatest(F.col("at") - 1, F.lit(1)), F.char_length("form"))).alias("at")
    cut = forms.where("form <> ''").select("name", "form", at).where("substring(form, at, 1) <> substring(form, at + 1, 1)")
    return cut.select("name", F.expr("concat(substring(form, 1, at - 1), substring(form, at + 1))").alias("form"), "at")


def _forms(names: DataFrame, edits: int) -> DataFrame:
    """(name, key): the hash of each name with up to ``edits`` characters deleted (an equal hash can only add a pair to be measured)."""
    # dealt out first: the forms are many times the bytes by which Spark chose the number of tasks
    dealt = names.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name") if edits > 1 else names
    steps = [dealt.select("name", F.col("name").alias("form"), F.lit(1).alias("at"))]
    for _ in range(edits):
        steps.append(_shortened(steps[-1]))
    return reduce(DataFrame.union, steps).select("name", F.xxhash64("form").alias("key"))


def by_deletions(names: DataFrame, targets: DataFrame, edits: int) -> DataFrame:
    """(name, target, distance) of all pairs within ``edits`` and the allowed edits of ``name``."""
    met = table_join(_forms(targets, edits).withColumnRenamed("name", "target"), _forms(names, edits).hint("merge"), "key")
    return _measured(met, edits).distinct()


def _measured(pairs: DataFrame, edits: int) -> DataFrame:
    distance = F.levenshtein("name", "target", edits)
    return pairs.select("name", "target", distance.alias("distance")).where(F.col("distance").between(0, allowed_edits("name")))


# -- by q-grams ------------------------------------------------------------------
def _grams(name: str) -> Column:
    padded = F.concat(F.lit("\x01" * (Q - 1)), F.col(name), F.lit("\x02" * (Q - 1)))
    return F.transform(F.sequence(F.lit(1), F.char_length(name) + Q - 1), lambda i: F.struct(F.substring(padded, i, F.lit(Q)).alias("gram"), i.alias("place")))


def _with_grams(names: DataFrame) -> DataFrame:
    """Names with their grams, and the distinct hashes of these (an equal hash can only let a pair through the filter)."""
    cut = names.select("name").withColumn("grams", _grams("name"))
    return cut.withColumn("all_grams", F.array_distinct(F.transform("grams", lambda g: F.hash(g["gram"]))))


def _frequency(targets: DataFrame) -> DataFrame:
    """(gram, n): how often the targets have each gram. Both sides order their grams by it; one that no target has comes first."""
    return _materialize(targets.select(F.inline(_grams("name"))).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))[0]


def _rarest(names: DataFrame, frequency: DataFrame) -> DataFrame:
    """(name, all_grams, kept) with the (n, gram, place) of the 3k + 1 rarest grams; the longest allowance of two edits serves both sides."""
    rows = lookup_join(_with_grams(names).select("name", "all_grams", F.inline("grams")), frequency, "gram", "left")
    kept = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "place")))
    return rows.groupBy("name", "all_grams").agg(F.slice(kept, 1, Q * EDITS + 1).alias("kept"))  # as many as a name has characters


def by_grams(names: DataFrame, targets: DataFrame, rarest: DataFrame | None = None, frequency: DataFrame | None = None) -> DataFrame:
    """(name, target, distance) of all pairs within the allowed edits of ``name``; ``rarest``, ``frequency``: of these names and targets, if known."""
    frequency = _frequency(targets) if frequency is None else frequency
    around = (_rarest(names, frequency) if rarest is None else rarest).select("name", "all_grams", F.inline("kept")).where("n > 0")
    around = around.withColumn("place", F.explode(F.transform(F.sequence(F.lit(-EDITS), F.lit(EDITS)), lambda s: F.col("place") + s)))
    found = _rarest(targets, frequency).select(F.col("name").alias("target"), F.col("all_grams").alias("target_grams"), F.inline("kept"))
    met = table_join(around.drop("n"), found.drop("n"), ["gram", "place"])
    k = allowed_edits("name")
    close = (F.abs(F.char_length("name") - F.char_length("target")) <= k) & (F.size(F.array_except("all_grams", "target_grams")) <= Q * k)
    return _measured(met.where(close).select("name", "target").distinct(), EDITS)


# -- rounds ----------------------------------------------------------------------
def _of_near_length(names: DataFrame, others: DataFrame) -> DataFrame:
    """Names with one of ``others`` (of at most ``LONG`` characters or a little more) at most two characters longer or shorter."""
    lengths = {r[0] + d for r in others.select(F.char_length("name")).distinct().collect() for d in range(-EDITS, EDITS + 1)}
    return names.where(F.char_length("name").isin(sorted(lengths)))


def _within(names: DataFrame, targets: DataFrame, edits: int) -> DataFrame:
    """Pairs within ``edits`` and the allowed edits of ``name``; with one edit only those of short names, a longer one has none."""
    if edits == 0:
        return by_deletions(names, targets, 0)
    n = F.char_length("name")
    short, near = names.where(n <= LONG), targets.where(n <= LONG + edits)
    short, near = _of_near_length(short, near), _of_near_length(near, short)
    if edits < EDITS:
        return by_deletions(short, near, edits)
    parts = []
    listed = short.union(near).agg(F.sum(n * (n + 1) / 2)).first()[0]
    if listed is not None:
        frequency = _frequency(near)
        rarest, _ = _materialize(_rarest(short, frequency))
        meeting = rarest.select(F.inline("kept")).agg(F.sum(F.col("n").cast("double"))).first()[0] or 0
        parts.append(by_grams(short, near, rarest, frequency) if meeting <= listed else by_deletions(short, near, edits))
    if names.where(n > LONG).limit(1).count():
        parts.append(by_grams(names.where(n > LONG), targets.where(n > LONG - edits)))
    return reduce(DataFrame.union, parts) if parts else by_deletions(short, near, edits)


def near_names(names: DataFrame, targets: DataFrame, margin: int | None = None) -> DataFrame:
    """(name, target, distance) of all pairs of distinct normalised names within the allowed edits of ``name``.

    With ``margin`` they are sought in rounds, and pairs farther than a name's nearest by ``margin`` or more may be left out:
    ``best_by_margin`` gives the same with and without them.
    """
    names, targets = _materialize(names.select("name").distinct())[0], _materialize(targets.select("name").distinct())[0]
    if margin is None:
        return _within(names, targets, EDITS)
    parts = []
    for edits in range(EDITS + 1):
        found, _ = _materialize(_within(names, targets, edits))
        nearest = found.groupBy("name").agg(F.min("distance").alias("nearest"))
        unsettled = (allowed_edits("name") > edits) & (F.col("nearest").isNull() | (F.col("nearest") + max(margin, 1) - 1 > edits))
        names, n = _materialize(table_join(names, nearest, "name", "left").where(unsettled).select("name"))
        parts.append(table_join(found, names, "name", "left_anti"))
        if not n:
            break
    return reduce(DataFrame.union, parts)


def best_by_margin(pairs: DataFrame, margin: int = MARGIN) -> DataFrame:
    """(name, target, distance, clear): the nearest target (the least of equal ones), and whether no other is within ``margin`` of it."""
    per = pairs.groupBy("name", "distance").agg(F.min("target").alias("target"), F.count(F.lit(1)).alias("n"))
    steps = F.array_sort(F.collect_list(F.struct("distance", "target", "n")))  # a row per distance: three at most
    best = per.groupBy("name").agg(steps.alias("s"), F.min("distance").alias("distance"))
    rivals = F.aggregate(F.filter("s", lambda x: x["distance"] < F.col("distance") + margin), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return best.select("name", F.col("s")[0]["target"].alias("target"), "distance", (rivals == 1).alias("clear"))


def resolve_customers_fuzzy(raw: DataFrame, customers: DataFrame, margin: int = MARGIN) -> DataFrame:
    """Every raw order with ``resolution``: exact, fuzzy, review (a near name, but not alone) or unknown, and the customer of the first two.

    Exact names are looked up as they stand (active customers, the smallest id of a shared name); the rest by their
    normalised form. ``matched_name`` is the normalised master name that was found, also for review; blank and NULL names are unknown.
    """
    active = customers.where("is_active")
    exact = ids_by_name(active, "customer_name", "customer_id").select(F.col("_name").alias("customer_name_raw"), F.col("customer_id").alias("exact_id"))
    rows = raw.select("raw_order_id", "customer_name_raw", derive_order_date("received_at").alias("order_date"), norm("customer_name_raw").alias("name"))
    names = rows.where("name <> ''").groupBy("customer_name_raw", "name").agg(F.count(F.lit(1)).alias("n"))
    names, _ = _materialize(table_join(names, exact, "customer_name_raw", "left"))
    masters = active.select(norm("customer_name").alias("name"), "customer_id").where("name <> ''").groupBy("name").agg(F.min("customer_id").alias("fuzzy_id"))
    best, _ = _materialize(best_by_margin(near_names(names.where("exact_id IS NULL"), masters, margin), margin))
    # the ids first: most names have no target, and all NULL targets would meet in one task
    best = table_join(best, masters.withColumnRenamed("name", "target"), "target")
    found = table_join(names, best, "name", "left")
    resolution = F.when(F.col("exact_id").isNotNull(), "exact").when(F.col("clear"), "fuzzy").when(F.col("target").isNotNull(), "review").otherwise("unknown")
    found = found.select("customer_name_raw", resolution.alias("resolution"),
                         F.coalesce("exact_id", F.when(F.col("clear"), F.col("fuzzy_id"))).alias("customer_id"),
                         F.when(F.col("exact_id").isNotNull(), F.col("name")).otherwise(F.col("target")).alias("matched_name"),
                         F.when(F.col("exact_id").isNotNull(), 0).otherwise(F.col("distance")).cast("int").alias("distance"))
    found, _ = _materialize(found)
    return lookup_join(rows.drop("name"), found, "customer_name_raw", "left").select(
        "raw_order_id", "customer_name_raw", "order_date", "customer_id", "matched_name", "distance", F.coalesce("resolution", F.lit("unknown")).alias("resolution"))
