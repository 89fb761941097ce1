"""URL filter: fixed rules, and a path-template tree for the urls that no rule fits.

Each path becomes a template: segments that vary (numbers, hex ids, segments with digits, long slugs) turn
to wildcards. Templates of a host form a tree, which is built and merged from the host down, one level of segments at a time. A node counts
labelled urls; labels are the rules' own verdicts, and a labels frame if given. A branch's purity is the share of allowed
labels, smoothed toward its parent's purity (a host's toward that of all urls). The branches of a node are ordered by their shares (in steps of 1 / `steps`), and
neighbours whose shares don't differ by a two-proportion test (`z`) merge: from there on they are one node, and their branches of one name are one branch. Branches
without labels merge to one that takes the parent's purity and has none below it; right below a host, that of the same segment on all hosts. A url is judged by the node that its
segments lead to; if that node's purity is under `least`, its template is rejected.

All counts are sums of pre-aggregated rows (one for each host and template of a task), so a host with a third of all urls costs
no more than any other; a node's branches are ordered as at most steps + 1 rows, however many there are. Joins split keys that many rows share. There are as many levels as the longest path with labels below has segments.

Nulls: a null url, or one without "://", has an empty host and path; it is judged like any other. Repeated rows are judged each, and the same: a tie of a share with the
threshold is allowed. Long urls are taken whole. An empty table gives an empty result. Columns other than page_id and url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grapheon.llm.common import cut, spread_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(df: DataFrame) -> DataFrame:
    """page_id, host, path of each row."""
    base = df.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    rest = base.withColumn("rest", F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END"))
    parts = rest.withColumn("raw", F.regexp_extract("rest", r"^([^/?#]*)", 1))
    path = F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), r"^([^?#]*)", 1)
    return parts.select("page_id", F.translate("raw", UPPER, LOWER).alias("host"), path.alias("path"))


def rule_column(rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits host and path, or null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        out = F.when(fits, F.lit(rule)) if out is None else out.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if out is None else out


def template_column() -> Column:
    """The generalised segments of path."""
    segments = F.filter(F.split("path", "/", -1), lambda s: s != "")

    def general(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^[0-9]+$"), F.lit("{n}"))
            .when(s.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.concat(F.lit("{n}."), F.regexp_extract(s, r"\.([A-Za-z]+)$", 1)))
            .when(s.rlike(r"^[0-9a-fA-F]{8}[0-9a-fA-F-]*$"), F.lit("{h}"))
            .when(s.rlike(r"[0-9]") | (F.length(s) > 32), F.lit("{s}"))
            .otherwise(s)
        )

    return F.transform(segments, general)


def judge(df: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None, weight: float = 8.0, z: float = 2.0, steps: int = 100, least: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of each row of df.

    rules: (rule, verdict); labels: page_id and allowed (boolean), further labelled urls; weight: how many labels a parent's purity counts.
    """
    urls = split_url(df).withColumn("rule", rule_column(rules)).withColumn("segments", template_column())
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    urls = urls.withColumn("ruled", by_rule)
    allowed = F.when(F.col("ruled") == "allow", 1.0).when(F.col("ruled") == "block", 0.0)
    if labels is not None:
        given = labels.groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.max(F.col("allowed").cast("double")).alias("given"))
        urls = urls.join(given, "page_id", "left")
        allowed = F.coalesce(F.col("given"), allowed)
    urls = urls.withColumn("allowed", allowed).withColumn("leaf", F.concat_ws("/", "host", F.concat_ws("/", "segments")))
    leaves = cut(urls.groupBy("leaf").agg(F.first("host").alias("node"), F.first("segments").alias("segments"), F.count("*").alias("urls"), F.count("allowed").alias("labelled"), F.sum(F.coalesce("allowed", F.lit(0.0))).alias("good")))

    purity = (F.col("good") + weight * F.col("above")) / (F.col("labelled") + weight)
    total = leaves.agg(F.sum("urls").alias("urls"), F.sum("labelled").alias("labelled"), F.sum("good").alias("good")).head()
    everything = ((total["good"] or 0.0) + weight * 0.5) / ((total["labelled"] or 0) + weight)
    sums = [F.sum("labelled").alias("labelled"), F.sum("good").alias("good")]
    first = F.coalesce(F.get("segments", F.lit(0)), F.lit(""))
    anywhere = leaves.groupBy(first.alias("segment")).agg(*sums).withColumn("above", F.lit(everything)).select("segment", purity.alias("elsewhere"))
    hosts = leaves.groupBy("node").agg(*sums, F.count("*").alias("held")).withColumn("above", F.lit(everything)).select("node", purity.alias("purity"), "held")
    now = cut(spread_join(leaves.select("leaf", "node", "segments", "urls", "labelled", "good"), hosts, "node", "held", leaves.count()).withColumn("over", F.lit(False)))
    shown, depth = None, 0
    while True:
        ends = (F.size("segments") <= depth) | F.col("over")
        done = now.filter(ends).select("leaf", "urls", "purity", F.concat("node", F.lit("/")).alias("template"))
        shown = done if shown is None else shown.unionByName(done)
        going = now.filter(~ends).withColumn("segment", F.get("segments", F.lit(depth))).withColumn("child", F.concat_ws("/", "node", "segment"))
        left = going.count()
        if not left:
            break
        branches = going.groupBy("node", "segment").agg(*sums, F.first("purity").alias("above"), F.first("child").alias("child"), F.count("*").alias("held"))
        share = F.floor(F.col("good") * steps / F.nullif("labelled", F.lit(0)))
        branches = branches.withColumn("share", share)
        if depth == 0:
            branches = branches.join(anywhere, "segment").withColumn("above", F.when(F.col("labelled") == 0, F.col("elsewhere")).otherwise(F.col("above"))).drop("elsewhere")
        branches = cut(branches)
        rows = branches.filter("labelled > 0").groupBy("node", "share").agg(*sums, F.count("*").alias("members"), F.first("above").alias("above"))
        order = Window.partitionBy("node").orderBy("share")
        n1, g1 = F.lag("labelled").over(order), F.lag("good").over(order)
        p = (g1 + F.col("good")) / (n1 + F.col("labelled"))
        differs = F.pow(F.col("good") / F.col("labelled") - g1 / n1, F.lit(2)) > z * z * p * (1 - p) * (1 / n1 + 1 / F.col("labelled"))
        grouped = rows.withColumn("apart", F.when(n1.isNotNull() & differs, 1).otherwise(0)).withColumn("of", F.sum("apart").over(order))
        merged = grouped.groupBy("node", "of").agg(*sums, F.sum("members").alias("members"), F.first("above").alias("above"), F.collect_list("share").alias("shares"))  # steps + 1 shares at most
        judged = merged.select("node", F.explode("shares").alias("share"), "of", "members", purity.alias("purity"))
        known = branches.filter("labelled > 0").join(judged, ["node", "share"]).select("child", F.when(F.col("members") == 1, F.col("child")).otherwise(F.concat("node", F.lit("/*"), F.col("of").cast("string"))).alias("to"), "purity", "held", F.lit(False).alias("over"))
        blank = branches.filter("labelled = 0").select("child", F.concat("node", F.lit("/*") if depth else F.concat(F.lit("/"), "segment")).alias("to"), F.col("above").alias("purity"), "held", F.lit(True).alias("over"))
        now = cut(spread_join(going.drop("purity", "node", "segment", "over"), known.unionByName(blank), "child", "held", left).drop("child").withColumnRenamed("to", "node"))
        depth += 1
    found = spread_join(urls.select("page_id", "host", "path", "rule", "ruled", "leaf"), shown, "leaf", "urls", total["urls"] or 0)
    verdict = F.coalesce("ruled", F.when(F.col("purity") < least, F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
