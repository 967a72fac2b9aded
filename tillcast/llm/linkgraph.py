"""URL filter: trust and distrust propagated over the links between hosts.

Rules judge urls directly: a rule names a host and a path, fits that host and
all its subdomains when the url's path starts with the rule's, and the longest
fitting rule wins. Hosts whose pages rules allow are trusted seeds, hosts whose
pages rules block are blocked seeds, each with the share of its pages judged
so. Trust follows links forward (personalised PageRank from the trusted
seeds), distrust follows them backward (a page that links to blocked hosts is
suspect), both damped by ``damping`` for ``iterations`` rounds. A url without a
fitting rule gets its host's verdict: block where distrust is above
``ratio`` times trust, else allow.

Host edges are counted per page batch before any shuffle, so a hot host is a
single row by then; each round is one join and one aggregate over edges, and
every few rounds the scores are written to the shared folder.

Edge cases: a null url or one without ``://`` has an empty host and path, fits no
rule and is allowed; a null html has no links; relative links and links to the
own host are no edges; hosts seen only as link targets take part; repeated
pages count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.store import carried, fresh, materialize

# fixed values: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING = 0.85
ITERATIONS = 20
RATIO = 1.0
_WRITE_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_columns(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host + path, verdict) of the longest fitting rule; nulls without one."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """(src, dst, n): links from one host to another."""
    targets = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")),
                                   F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']?([a-z][a-z0-9+.\-]*://[^\"'\s>]*)"), F.lit(1))
    links = pages.select(F.col(host_col).alias("src"), F.explode(targets).alias("url")).select("src", host(F.col("url")).alias("dst"))
    return links.filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(host, trust, distrust) after ``iterations`` rounds. ``seeds``: host, good, bad (shares);
    ``edges``: src, dst, n."""
    out_n = edges.groupBy(F.col("src").alias("s")).agg(F.sum("n").alias("out_n"))
    in_n = edges.groupBy(F.col("dst").alias("d")).agg(F.sum("n").alias("in_n"))
    w = materialize(edges.join(out_n, F.col("src") == F.col("s")).join(in_n, F.col("dst") == F.col("d"))
                    .select("src", "dst", (F.col("n") / F.col("out_n")).alias("forward"), (F.col("n") / F.col("in_n")).alias("back")),
                    "linkgraph-edges")
    ends = w.select(F.col("src").alias("host")).unionByName(w.select(F.col("dst").alias("host"))).distinct()
    zero = F.lit(0.0)
    base = materialize(seeds.unionByName(ends.select("host", zero.alias("good"), zero.alias("bad")))
                       .groupBy("host").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "linkgraph-seeds")
    scores = base.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    if w.isEmpty():
        return scores.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
    for k in range(iterations):
        trust = w.join(scores, w.src == scores.host).select(F.col("dst").alias("host"), (F.col("trust") * F.col("forward")).alias("t"), zero.alias("b"))
        distrust = w.join(scores, w.dst == scores.host).select(F.col("src").alias("host"), zero.alias("t"), (F.col("distrust") * F.col("back")).alias("b"))
        moved = trust.unionByName(distrust)
        kept = base.select("host", ((1 - damping) * F.col("good")).alias("t"), ((1 - damping) * F.col("bad")).alias("b"))
        scores = (kept.unionByName(moved.select("host", (damping * F.col("t")).alias("t"), (damping * F.col("b")).alias("b")))
                  .groupBy("host").agg(F.sum("t").alias("trust"), F.sum("b").alias("distrust")))
        if k % _WRITE_EVERY == _WRITE_EVERY - 1:
            scores = materialize(scores, f"linkgraph-round-{k}")
    return scores


def judge(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules=RULES, damping: float = DAMPING,
          iterations: int = ITERATIONS, ratio: float = RATIO, out: str = "url_verdict") -> DataFrame:
    """``pages`` plus a struct ``out`` (a column of that name is replaced): host, path, rule, verdict, trust, distrust."""
    name = fresh("_judged", pages.columns)
    url = F.col(f"`{url_col}`")
    h, p = host(url), path(url)
    split = pages.withColumn(name, F.struct(h.alias("host"), p.alias("path")))
    rule, verdict = rule_columns(F.col(f"{name}.host"), F.col(f"{name}.path"), rules)
    ruled = split.withColumn(name, F.struct(F.col(f"{name}.host").alias("host"), F.col(f"{name}.path").alias("path"),
                                            rule.alias("rule"), verdict.alias("verdict")))
    narrow = ruled.select(F.col(f"{name}.host").alias("host"), F.col(f"{name}.verdict").alias("verdict"), F.col(f"`{html_col}`").alias("html"))
    share = lambda v: F.avg(F.coalesce((F.col("verdict") == v).cast("double"), F.lit(0.0)))
    seeds = narrow.filter("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad"))
    scores = propagate(seeds, host_edges(narrow, "host", "html"), damping, iterations)
    found = scores.select(F.col("host").alias(f"{name}host"), F.col("trust").alias(f"{name}trust"), F.col("distrust").alias(f"{name}distrust"))
    joined = ruled.join(found, F.col(f"{name}.host") == F.col(f"{name}host"), "left")
    own = F.when(F.col(f"{name}distrust") > ratio * F.col(f"{name}trust"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(*carried(pages.columns, out), F.struct(
        F.col(f"{name}.host").alias("host"), F.col(f"{name}.path").alias("path"), F.col(f"{name}.rule").alias("rule"),
        F.coalesce(F.col(f"{name}.verdict"), own).alias("verdict"), F.col(f"{name}trust").alias("trust"),
        F.col(f"{name}distrust").alias("distrust")).alias(out))
