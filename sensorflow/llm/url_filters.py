"""URL filter by a path-template tree, in DataFrame functions only.

1. Explicit rules (``host/path-prefix`` with a verdict) fit their host and its
   subdomains; the longest fitting rule decides and labels the page.
2. Every path becomes a chain of tree nodes below its host. A segment that is
   a number, a number with an extension or a long hex string is a wildcard by
   its shape; all literal children of a node with more than ``MAX_CHILDREN``
   of them become one wildcard. The chain has a node for every segment, however
   deep the path is.
3. Templates that differ in their last literal segment only are sibling
   branches. Sorted by bad share, neighbours whose shares do not differ
   significantly (two-proportion z test) are merged.
4. A merged template is rejected if its bad share, smoothed towards the
   host's share (itself smoothed towards the overall share), exceeds 0.5.

All counting works on pre-aggregated (host, path) rows; the verdicts meet the
pages in one join on (host, path), which Spark can split when a key is hot.

Edge cases: a null url, or one without ``://``, has an empty host and path; no
rule fits it and the empty host is judged like any other. Repeated rows keep
their repetitions. Without labels nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CHILDREN = 20
Z = 1.96
PRIOR_WEIGHT = 4.0
REJECT_OVER = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = rest.substr(F.length(raw) + 1, F.length(rest))
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(tail, "^[^?#]*", 0)


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule (null if none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        cut = text.find("/") if "/" in text else len(text)
        h, p = text[:cut].lower(), text[cut:]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _shape(seg: Column) -> Column:
    return (F.when(seg.rlike("^[0-9]+$"), F.lit("{num}"))
            .when(seg.rlike("^[0-9]+[.][A-Za-z0-9]+$"), F.concat(F.lit("{num}."), F.regexp_extract(seg, "[.](.*)$", 1)))
            .when(seg.rlike("^[0-9a-fA-F-]{16,}$"), F.lit("{hex}"))
            .otherwise(seg))


def templates(paths: DataFrame) -> DataFrame:
    """``host``, ``path`` -> ``template``, ``family``: the generalised path, and the
    path with its last literal segment also replaced."""
    nodes = (paths.select("host", "path", F.transform(F.split("path", "/"), _shape).alias("_s"))
             .select("host", "path", "_s", F.posexplode("_s").alias("_d", "_c"))
             .withColumn("_p", F.array_join(F.slice("_s", F.lit(1), F.col("_d")), "/")).drop("_s"))
    literal = ~F.col("_c").startswith("{") & (F.col("_c") != "")
    wide = (nodes.where(literal).groupBy("host", "_d", "_p", "_c").agg(F.count("*").alias("_n"))
            .groupBy("host", "_d", "_p").agg(F.count("*").alias("_kids")).where(F.col("_kids") > MAX_CHILDREN)
            .withColumn("_wide", F.lit(True)).drop("_kids"))
    seen = nodes.join(wide, ["host", "_d", "_p"], "left")
    seg = F.when(F.col("_wide") & literal, F.lit("{any}")).otherwise(F.col("_c"))
    chain = (seen.groupBy("host", "path")
             .agg(F.sort_array(F.collect_list(F.struct(F.col("_d").alias("d"), seg.alias("c")))).alias("_t")))
    last = F.array_max(F.transform(F.filter("_t", lambda x: ~x["c"].startswith("{") & (x["c"] != "")), lambda x: x["d"]))
    return chain.select(
        "host", "path", F.array_join(F.transform("_t", lambda x: x["c"]), "/").alias("template"),
        F.array_join(F.transform("_t", lambda x: F.when(x["d"] == last, F.lit("{*}")).otherwise(x["c"])), "/").alias("family"))


def judged_paths(paths: DataFrame, reject_over: float = REJECT_OVER) -> DataFrame:
    """``host``, ``path``, ``n_labelled``, ``n_bad`` (one row per host and path) -> ``host``, ``path``, ``rejected``."""
    t = templates(paths.select("host", "path"))
    stats = (paths.join(t, ["host", "path"]).groupBy("host", "family", "template")
             .agg(F.sum("n_labelled").alias("lab"), F.sum("n_bad").alias("bad")))
    total = paths.agg(F.sum("n_bad").alias("bad"), F.sum("n_labelled").alias("lab")).first()
    overall = ((total["bad"] or 0) + 1.0) / ((total["lab"] or 0) + 2.0)
    # siblings of one family number MAX_CHILDREN at most, so these windows stay small
    w = Window.partitionBy("host", "family").orderBy("rate", "template")
    rate = F.when(F.col("lab") > 0, F.col("bad").cast("double") / F.col("lab")).otherwise(F.lit(-1.0))
    near = stats.withColumn("rate", rate)
    near = near.withColumns({"lab0": F.lag("lab").over(w), "bad0": F.lag("bad").over(w), "rate0": F.lag("rate").over(w)})
    pooled = (F.col("bad") + F.col("bad0")).cast("double") / (F.col("lab") + F.col("lab0"))
    se2 = pooled * (1 - pooled) * (F.lit(1.0) / F.col("lab") + F.lit(1.0) / F.col("lab0"))
    gap = F.col("rate") - F.col("rate0")
    same = F.when(F.col("lab0").isNull(), F.lit(False)).when((F.col("lab") == 0) | (F.col("lab0") == 0), F.col("lab") == F.col("lab0")) \
        .otherwise(gap * gap <= F.lit(Z * Z) * se2)
    grouped = near.withColumn("branch", F.sum(F.when(same, 0).otherwise(1)).over(w))
    merged = grouped.groupBy("host", "family", "branch").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))
    hosts = stats.groupBy("host").agg(F.sum("lab").alias("hlab"), F.sum("bad").alias("hbad"))
    prior = (F.col("hbad") + F.lit(PRIOR_WEIGHT * overall)) / (F.col("hlab") + F.lit(PRIOR_WEIGHT))
    share = (F.col("bad") + F.lit(PRIOR_WEIGHT) * prior) / (F.col("lab") + F.lit(PRIOR_WEIGHT))
    out = (grouped.select("host", "family", "template", "branch")
           .join(merged, ["host", "family", "branch"]).join(hosts, "host")
           .select("host", "template", (share > reject_over).alias("rejected")))
    return t.join(out, ["host", "template"]).select("host", "path", "template", "rejected")


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``<id_col>``, ``host``, ``path``, ``rule``, ``verdict``, ``template`` of every page."""
    host, path = host_and_path(F.col(url_col))
    base = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, says = rule_column(rules, F.col("host"), F.col("path"))
    base = base.withColumns({"rule": rule, "_says": says})
    paths = base.groupBy("host", "path").agg(F.count("rule").alias("n_labelled"),
                                             F.count(F.when(F.col("_says") == "block", 1)).alias("n_bad"))
    judged = judged_paths(paths)
    by_method = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return (base.join(judged, ["host", "path"], "left")
            .select(id_col, "host", "path", "rule", F.coalesce("_says", by_method).alias("verdict"), "template"))
