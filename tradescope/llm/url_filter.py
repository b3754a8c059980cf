"""URL verdicts: host and path rules, and link-graph propagation for what they leave open.

Rules name a host and the start of a path; they hold for the host and its
subdomains, and the longest that fits decides. Pages that no rule decides are
judged by their host. Hosts are linked by the hyperlinks in their pages
(one vote per page and target) and, more weakly, with their parent host if that
has pages too. Over these edges run two personalised PageRanks: trust starts
from hosts in proportion to the pages that rules allow, and distrust, on
reversed edges, in proportion to the pages that rules block. A host is blocked
where distrust outweighs trust and comes to at least ``THRESHOLD`` of its pages.

Everything is a DataFrame operation. Ranks are materialised every few rounds and
iterated until they settle. The few hosts with a large share of all pages (their
number is bounded by the width of the shuffle) get their verdict by broadcast,
all others by a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.llm.common import cut

#: Fixed values: (verdict, host, start of the path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
THRESHOLD = 0.5
#: Rank that may still move when the iteration ends (ranks sum to one at most).
TOLERANCE = 1e-6
ROUNDS_AT_ONCE = 5
#: Weight of the edge between a host and its parent, next to one per linking page.
PARENT_WEIGHT = 0.5
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, by_rule``; the page's html is not read."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return parsed.select("*", rule.alias("rule"), verdict.alias("by_rule"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``src, dst, weight`` between different hosts: linking pages, and the tie to a parent host."""
    host, _ = host_and_path(F.col("url"))
    targets = F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce("html", F.lit("")), UPPER, LOWER), F.lit(LINK), 1))
    links = pages.select(host.alias("src"), F.explode(targets).alias("dst")).where("src <> '' AND src <> dst")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    named = hosts.where("host <> ''").select("host")
    parents = named.select("host", F.regexp_replace("host", r"^[^.]*\.", "").alias("parent")).where("host <> parent")
    tied = parents.join(named.withColumnRenamed("host", "parent"), "parent")
    ends = F.array(F.struct(F.col("host").alias("src"), F.col("parent").alias("dst")), F.struct(F.col("parent").alias("src"), F.col("host").alias("dst")))
    ties = tied.select(F.explode(ends).alias("e")).select("e.*", F.lit(PARENT_WEIGHT).alias("weight"))
    return links.union(ties).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """``kind, host, rank``: trust along the edges and distrust against them, from seeds ``kind, host, mass`` (summing to one per kind).

    Rank that reaches a host without edges returns to the seeds; that equals
    dropping it and scaling the result, which sums to one per kind.
    """
    forward, back = edges.select("src", "dst", "weight"), edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    both = forward.select(F.lit("trust").alias("kind"), "*").union(back.select(F.lit("distrust").alias("kind"), "*"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    steps = cut(both.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("share")))
    start = seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("rank"))
    ranks = start = cut(start)
    while True:
        for _ in range(ROUNDS_AT_ONCE):
            before = ranks
            flow = ranks.join(steps, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
            ranks = start.union(flow).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        moved = ranks.alias("x").join(before.alias("y"), ["kind", "host"], "full").select("kind", "host", F.col("x.rank").alias("rank"), F.abs(F.coalesce("x.rank", F.lit(0.0)) - F.coalesce("y.rank", F.lit(0.0))).alias("moved"))
        moved = cut(moved)
        ranks = moved.where("rank IS NOT NULL").select("kind", "host", "rank")
        if (moved.agg(F.sum("moved")).first()[0] or 0.0) <= TOLERANCE:
            total = ranks.groupBy("kind").agg(F.sum("rank").alias("total"))  # two rows
            return ranks.join(F.broadcast(total), "kind").select("kind", "host", (F.col("rank") / F.col("total")).alias("rank"))


def judge_hosts(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``host, pages, trust, distrust, verdict``: both ranks in pages, i.e. times all pages that rules allow or block."""
    judged = judged_by_rules(pages, rules)
    per_host = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum((F.col("by_rule") == "allow").cast("long")).alias("trust"),
        F.sum((F.col("by_rule") == "block").cast("long")).alias("distrust"),
    )
    hosts = cut(per_host.select("host", "pages", F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust")))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("double").alias("n")) for k in ("trust", "distrust")])
    seeds = hosts.select("host", F.explode(kinds).alias("k")).select("k.kind", "host", "k.n").where("n > 0")
    total = seeds.groupBy("kind").agg(F.sum("n").alias("total"))  # two rows
    seeds = seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("mass"), "total")
    seeds = cut(seeds)
    ranks = propagate(host_edges(pages, hosts), seeds)
    scaled = ranks.join(F.broadcast(total), "kind").groupBy("host").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("rank") * F.col("total"))).alias(k) for k in ("trust", "distrust")]
    )
    found = hosts.select("host", "pages").join(scaled, "host", "left").na.fill(0.0, ["trust", "distrust"])
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= F.col("pages") * threshold)
    return found.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust``, one row per input row.

    The verdict is the rule's, else the host's. A null url, or one without
    ``://``, has an empty host, which has no links and is allowed; a null html
    has no links; repeated rows are judged (and counted) each; other columns are
    ignored. Trust and distrust of the host are rounded to six digits.
    """
    hosts = cut(judge_hosts(pages, rules, threshold))
    judged = judged_by_rules(pages, rules)
    width = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    # Fewer than 4 x width hosts can hold more than this share of the pages.
    large = F.broadcast(hosts.where(F.col("pages") > total / (4 * width)))
    small = hosts.where(F.col("pages") <= total / (4 * width))
    rest = judged.join(large.select("host"), "host", "left_anti")
    out = judged.join(large, "host").unionByName(rest.join(small, "host"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "verdict").alias("verdict"), F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))
