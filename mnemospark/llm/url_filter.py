"""URL filters: host and path rules, and trust that spreads over links between hosts.

A rule is the longest that fits a url's host (or a parent of it) and the start of its path. Urls
without a rule follow their host: trust starts at hosts in the share of their pages that rules allow,
distrust in the share that they block. Trust flows along links, distrust against them (a host answers for what
it links to), both as personalised PageRank. A host is blocked if its distrust exceeds
``THRESHOLD`` and its trust.

Links are counted per pair of hosts before anything else, and each round joins scores with these
counts and sums them per host: tables of hosts, never of pages. Rounds are written to the shared folder.

Null urls and urls without ``://`` have empty host and path and are allowed. Null html has no links.
Repeated rows are judged alike. Columns of the result replace equal names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.llm.staging import stage

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))  # fixed values
DAMPING, ROUNDS, SETTLED = 0.5, 20, 1e-6
THRESHOLD = 0.5
LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host between ``://`` and the next of ``/?#``, A-Z in lower case; path up to ``?`` or ``#``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    names, verdicts = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # later ones win
        at = rule.find("/")
        base, start = (rule, "") if at < 0 else (rule[:at], rule[at:])
        fits = ((host == base) | host.endswith("." + base)) & path.startswith(start)
        names, verdicts = F.when(fits, F.lit(rule)).otherwise(names), F.when(fits, F.lit(verdict)).otherwise(verdicts)
    return names, verdicts


def host_links(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """``(src, dst, n)``: links between different hosts, absolute or without a scheme (``//host/path``)."""
    found = pages.select(F.col(host_col).alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), 1)).alias("dst"))
    return found.withColumn("dst", F.translate("dst", UPPER, LOWER)).where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` from seeds ``(host, good, bad)`` and links ``(src, dst, n)``."""
    out = links.groupBy("src").agg(F.sum("n").alias("n_out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("n_in"))
    edges = stage(links.join(out, "src").join(into, "dst").select("src", "dst", (F.col("n") / F.col("n_out")).alias("ahead"), (F.col("n") / F.col("n_in")).alias("back")), "url-links")
    ends = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    base = stage(seeds.join(ends, "host", "full").select("host", F.coalesce("good", F.lit(0.0)).alias("good"), F.coalesce("bad", F.lit(0.0)).alias("bad")), "url-seeds")
    now = base.select("host", (F.col("good") * (1 - damping)).alias("trust"), (F.col("bad") * (1 - damping)).alias("distrust"))
    if edges.isEmpty():  # only the seeds' own share: the fixed point
        return now
    now = stage(now, "url-rank")
    for _ in range(rounds):
        ahead = edges.join(now, edges["src"] == now["host"]).select(F.col("dst").alias("at"), (F.col("trust") * F.col("ahead")).alias("t"), F.lit(0.0).alias("d"))
        back = edges.join(now, edges["dst"] == now["host"]).select(F.col("src").alias("at"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d"))
        came = ahead.unionByName(back).groupBy("at").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        old = now.select("host", F.col("trust").alias("_t"), F.col("distrust").alias("_d"))
        after = stage(base.join(came, base["host"] == came["at"], "left").join(old, "host").select(
            "host", (F.col("good") * (1 - damping) + F.coalesce("t", F.lit(0.0)) * damping).alias("trust"),
            (F.col("bad") * (1 - damping) + F.coalesce("d", F.lit(0.0)) * damping).alias("distrust"), "_t", "_d"), "url-rank")
        change = after.agg(F.max(F.greatest(F.abs(F.col("trust") - F.col("_t")), F.abs(F.col("distrust") - F.col("_d"))))).first()[0]
        now = after.select("host", "trust", "distrust")
        if change is None or change < SETTLED:
            break
    return now


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str = "html", key: str = "page_id") -> DataFrame:
    """A row per page: key, host, path, rule, verdict, trust and distrust of the host."""
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(key), host.alias("host"), path.alias("path"), F.col(html_col).alias("_html"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = split.select(key, "host", "path", rule.alias("rule"), verdict.alias("_by_rule"))
    share = lambda v: F.avg(F.when(F.col("_by_rule") == v, 1.0).otherwise(0.0))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad"))
    scores = propagate(seeds, host_links(split, "host", "_html"))
    # A rank keeps the share (1 - damping) of its own seed: scaled so that a wholly blocked host without links has 1.
    scores = scores.select("host", (F.col("trust") / (1 - DAMPING)).alias("trust"), (F.col("distrust") / (1 - DAMPING)).alias("distrust"))
    by_host = F.when((F.col("distrust") > THRESHOLD) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return ruled.join(scores, "host", "left").select(key, "host", "path", "rule", F.coalesce("_by_rule", by_host).alias("verdict"), "trust", "distrust")
