"""URL filter: rules on host and path, and trust carried over the host graph. Native.

Rules decide the urls that they fit. For the others, two personalised PageRanks run over host
edges: trust from hosts with allowed pages along the links, distrust from hosts with blocked pages
against the links. A host is blocked where its distrust exceeds its trust plus its share of all
pages. Ranks are integers (``MASS`` in all) and shares are rounded down, so sums do not depend on
the order of rows and every run gives the same verdicts.

Host edges: links of pages to other hosts, weighted by the number of linking anchors, and both ways
between a host and its parent name where both have pages (``www.a.org`` and ``a.org``). A host
without outgoing edges keeps its rank.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is
allowed; null html has no links; repeated rows count as pages; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import ascii_lower, table, written

#: (verdict, host, path start).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
MASS, DAMPING, ITERATIONS, CUT_EVERY = 10**12, 85, 10, 5
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (as host and path) and its verdict, else nulls."""
    name, said = None, None
    for action, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        said = F.when(fits, action) if said is None else said.when(fits, action)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if name is None else (name, said)


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, w): links between hosts, and a host with its parent name both ways."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    parents = hosts.select("host", F.regexp_extract("host", r"(?s)^[^.]*\.(.*)$", 1).alias("parent"))
    parents = parents.join(hosts.select(F.col("host").alias("parent")), "parent")
    both = parents.select(F.col("host").alias("src"), F.col("parent").alias("dst")).union(parents.select("parent", "host"))
    return links.union(both.withColumn("w", F.lit(1).cast("long"))).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def ranks(hosts: DataFrame, edges: DataFrame, seed: str, iterations: int = ITERATIONS) -> DataFrame:
    """(host, rank): personalised PageRank from the integer column ``seed`` of ``hosts``."""
    names = hosts.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    ends = names.join(edges.select(F.col("src").alias("host")).distinct(), "host", "left_anti")
    edges = edges.union(ends.select("host", "host", F.lit(1).cast("long")))
    total = edges.groupBy("src").agg(F.sum("w").alias("out"))
    edges = written(edges.join(total, "src"), "urls-edges")
    start = hosts.select("host", F.col(seed).alias("rank")).filter("rank > 0")
    share = F.expr(f"(cast(rank as decimal(18,0)) * w * {DAMPING}) div (cast(out as decimal(18,0)) * 100)")
    now = start
    for i in range(iterations):
        moved = edges.join(now.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), share.alias("rank"))
        back = start.select("host", F.expr(f"rank * {100 - DAMPING} div 100").alias("rank"))
        now = moved.union(back).groupBy("host").agg(F.sum("rank").alias("rank"))
        if (i + 1) % CUT_EVERY == 0:
            now = written(now, "urls-ranks")
    return now


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    host, path = split_url(pages["url"])
    df = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"), pages["html"].alias("html"))
    rule, said = by_rules(F.col("host"), F.col("path"), rules)
    df = df.select("*", rule.alias("rule"), said.alias("said"))

    count = lambda v: F.sum(F.when(F.col("said") == v, 1).otherwise(0))
    hosts = written(df.filter("host != ''").groupBy("host").agg(F.count(F.lit(1)).alias("n"), count("allow").alias("allowed"), count("block").alias("blocked")), "urls-hosts")
    total = hosts.agg(*[F.sum(c).alias(c) for c in ("n", "allowed", "blocked")]).first()
    part = lambda c: F.expr(f"cast({c} as decimal(18,0)) * {MASS} div {max(1, total[c] or 0)}")
    hosts = hosts.select("host", *[part(c).alias(c) for c in ("n", "allowed", "blocked")])
    edges = written(host_edges(df, hosts.select("host")), "urls-links")
    trust = ranks(hosts, edges, "allowed").withColumnRenamed("rank", "trust")
    distrust = ranks(hosts, edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"), "blocked").withColumnRenamed("rank", "distrust")
    bad = hosts.select("host", "n").join(trust, "host", "left").join(distrust, "host", "left").filter(
        F.coalesce("distrust", F.lit(0)) > F.coalesce("trust", F.lit(0)) + F.col("n")).select("host", F.lit(True).alias("bad"))
    out = df.select("page_id", "host", "path", "rule", "said").join(bad, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def _oracle_sql() -> str:
    """The same in DuckDB SQL, with one common table per iteration."""
    fits = lambda h, p: f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}'))"
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    case = lambda pick: "case " + " ".join(f"when {fits(h, p)} then '{pick(a, h, p)}'" for a, h, p in ordered) + " end"
    parts = [f"""
split as (select page_id, coalesce(html, '') as html, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path from pages),
ruled as (select *, {case(lambda a, h, p: h + p)} as rule, {case(lambda a, h, p: a)} as said from split),
counted as (select host, count(*) as n, count(*) filter (said = 'allow') as allowed, count(*) filter (said = 'block') as blocked from ruled where host <> '' group by host),
total as (select greatest(1, sum(n)) as n, greatest(1, sum(allowed)) as allowed, greatest(1, sum(blocked)) as blocked from counted),
hosts as (select c.host, {', '.join(f'cast(c.{x} as hugeint) * {MASS} // t.{x} as {x}' for x in ('n', 'allowed', 'blocked'))} from counted c, total t),
linked as (select host as src, translate(unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as dst from ruled where host <> ''),
parents as (select host, regexp_extract(host, '^[^.]*\\.(.*)$', 1, 's') as parent from hosts),
both_ways as (select p.host as src, p.parent as dst from parents p join hosts h on h.host = p.parent union all select p.parent, p.host from parents p join hosts h on h.host = p.parent),
links as (select src, dst, sum(w) as w from (select src, dst, 1 as w from linked where src <> dst union all select src, dst, 1 from both_ways) group by src, dst),
links_back as (select dst as src, src as dst, w from links)"""]
    for seed, edges in (("allowed", "links"), ("blocked", "links_back")):
        parts.append(f"""
{seed}_all as (select src, dst, w from {edges} union all select h, h, 1 from (select host as h from hosts union select src from {edges} union select dst from {edges}) where h not in (select src from {edges})),
{seed}_edges as (select e.*, sum(w) over (partition by src) as out from {seed}_all e),
{seed}_0 as (select host, {seed} as rank from hosts where {seed} > 0)""")
        for i in range(ITERATIONS):
            parts.append(f"""
{seed}_{i + 1} as (select host, sum(rank) as rank from (select e.dst as host, r.rank * e.w * {DAMPING} // (e.out * 100) as rank from {seed}_edges e join {seed}_{i} r on r.host = e.src
    union all select host, rank * {100 - DAMPING} // 100 from {seed}_0) group by host)""")
    return "with " + ",".join(parts) + f"""
select p.page_id, p.host, p.path, p.rule, coalesce(p.said, case when coalesce(d.rank, 0) > coalesce(t.rank, 0) + h.n then 'block' else 'allow' end) as verdict
from ruled p left join hosts h on h.host = p.host left join allowed_{ITERATIONS} t on t.host = p.host left join blocked_{ITERATIONS} d on d.host = p.host"""


ORACLE_SQL = _oracle_sql()
