"""Order messages -> order lines.

Orders arrive as free text whose layout depends on the intake channel. Item patterns per
channel run as built-in ``regexp_extract_all`` (JVM side, no Python UDF); each mentioned line is one
row, resolved to a product id through an equi-join on the normalised name (plus optional aliases).

Nothing is dropped silently. A message's quantities are counted apart from the item pattern,
so a message of which only a part is recognised goes to review, and so do unknown and ambiguous product
names, quantities beyond an integer, and messages without any line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import norm

# Item formats per channel -> (pattern, quantity group, product group).
#   text / sms   "5lb bok choy, 12lb napa" anywhere in a message; a closing phrase ends the last item
#   email        "- bok choy: 5 lbs" per line
#   spreadsheet  "customer,bok choy,5,lbs" per line; the customer may hold commas
#   phone        "* 5 lb bok choy" per line
#   in_person    "5lb bok choy; 12lb napa"
CLOSING = r"(?: asap| pls| please| thanks| thx| for tmr| for tomorrow| tmr)"
TEXT_ITEM = rf"(\d+) ?lbs? ([^,;\n]+?)(?=\s*(?:,|;|\n|$|{CLOSING}))"
PATTERNS: dict[str, tuple[str, int, int]] = {
    "text": (TEXT_ITEM, 1, 2),
    "sms": (TEXT_ITEM, 1, 2),
    "email": (r"(?m)^- (.+): (\d+) lbs?$", 2, 1),
    "spreadsheet": (r"(?m)^.*,([^,\n]+),(\d+),lbs?$", 2, 1),
    "phone": (r"(?m)^\* (\d+) lbs? (.+)$", 1, 2),
    "in_person": (r"(\d+) ?lbs? ([^;\n]+)", 1, 2),
}
# Every number that stands on its own or before a unit counts as a quantity mention.
QUANTITY = r"(?<![\w.])\d+(?=\s?(?:lbs?\b|bx\b|cs\b|crates?\b|box(?:es)?\b|cases?\b)|[\s,]|$)"


def _by_channel(channel: Column, pick) -> Column:
    out = None
    for name, spec in PATTERNS.items():
        out = F.when(channel == name, pick(spec)) if out is None else out.when(channel == name, pick(spec))
    return out


def extract_order_lines(raw: DataFrame, products: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """One row per product mention in each raw message.

    ``raw``: staged raw orders (raw_order_id, order_text, source_channel normalised).
    ``products``: product_id, product_name. ``aliases`` (alias, product_name) adds extra spellings.
    Output: raw_order_id, item_no (1-based), quantity (NULL beyond an integer), product_mention, product_id
    (the smallest of the name), parse_status ('parsed' | 'unknown_product' | 'ambiguous' | 'bad_quantity').
    """
    ch = F.col("source_channel")
    text = F.col("order_text")
    qty = _by_channel(ch, lambda s: F.regexp_extract_all(text, F.lit(s[0]), F.lit(s[1])))
    prod = _by_channel(ch, lambda s: F.regexp_extract_all(text, F.lit(s[0]), F.lit(s[2])))
    mentions = raw.select(
        "raw_order_id", F.posexplode(F.arrays_zip(qty.alias("q"), prod.alias("p"))).alias("item_no", "m"),
    ).select(
        "raw_order_id", (F.col("item_no") + 1).alias("item_no"),
        F.col("m.q").try_cast("int").alias("quantity"), F.trim(F.col("m.p")).alias("product_mention"),
    )
    names = products.select(norm("product_name").alias("_name"), "product_id")
    if aliases is not None:
        names = names.unionByName(aliases.join(names, norm(aliases.product_name) == names._name).select(norm("alias").alias("_name"), "product_id"))
    catalog = names.groupBy("_name").agg(F.min("product_id").alias("product_id"), F.count_distinct("product_id").alias("_ids"))
    out = mentions.join(catalog, norm("product_mention") == catalog._name, "left")
    status = (F.when(F.col("product_id").isNull(), F.lit("unknown_product")).when(F.col("_ids") > 1, F.lit("ambiguous"))
              .when(F.col("quantity").isNull(), F.lit("bad_quantity")).otherwise(F.lit("parsed")))
    return out.select("raw_order_id", "item_no", "quantity", "product_mention", "product_id", status.alias("parse_status"))


def messages_needing_review(raw: DataFrame, parsed: DataFrame) -> DataFrame:
    """Raw orders with no recognised line, with fewer lines than quantities, or with a line that is not 'parsed'."""
    ok = parsed.groupBy("raw_order_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.when(F.col("parse_status") != "parsed", 1).otherwise(0)).alias("bad"))
    mentioned = F.coalesce(F.regexp_count("order_text", F.lit(QUANTITY)), F.lit(0))
    j = raw.withColumn("_mentioned", mentioned).join(ok, "raw_order_id", "left")
    return j.where(F.col("lines").isNull() | (F.col("bad") > 0) | (F.col("lines") < F.col("_mentioned"))).select(
        "raw_order_id", "source_channel", F.coalesce("lines", F.lit(0)).alias("lines"),
        F.col("_mentioned").alias("quantities"), F.coalesce("bad", F.lit(0)).alias("unresolved_lines"))
