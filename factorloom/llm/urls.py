"""URL filters by host and path rules: expand, join on short hash prefixes, confirm full digests.

A rule names a host, which stands for its subdomains too, and a path prefix. Only suffix depths and prefix
lengths that some rule has are expanded, so a URL gives (depths x lengths) expressions at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ascii_lower

PREFIX = 8  # hexadecimal digits of the digest that the join uses


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for a NULL url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, depths: list[int], lengths: list[int]) -> Column:
    """All host suffixes of ``depths`` labels with all path prefixes of ``lengths`` characters."""
    labels = F.size(F.split(host, r"\.", -1))
    made = [
        F.when((host != "") & (labels >= d) & (F.length(path) >= n), F.concat(F.substring_index(host, ".", -d), F.substring(path, 1, n)))
        for d in depths
        for n in lengths
    ]
    return F.array_distinct(F.array_compact(F.array(*made)))


def verdicts(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Columns ``id_col``, host, path, rule, verdict, one row per row of ``urls``.

    ``rules`` has host, path and action (allow or block). A rule fits its host and all subdomains if the path
    starts with the rule's; the longest wins, of equally long ones that with the longer host, then block
    before allow. Without a rule ``rule`` is NULL and the verdict ``default``. Rules with a NULL host or
    action are void, a NULL rule path is the empty one. Only the named columns are read.
    """
    rules = rules.where(F.col("host").isNotNull() & F.col("action").isNotNull()).select(
        ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action"
    )
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))  # block before allow
    shapes = rules.agg(
        F.collect_set(F.size(F.split("rule_host", r"\.", -1))), F.collect_set(F.length("rule_path"))
    ).first()  # at most as many as a host has labels and a path characters
    depths, lengths = sorted(shapes[0]), sorted(shapes[1])
    host, path = host_and_path(F.col(url_col))
    pages = urls.select(F.col(id_col).alias("key"), host.alias("host"), path.alias("path"))
    if not depths:
        return pages.select(
            F.col("key").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    pages = pages.withColumn("tail", F.substring_index("host", ".", -depths[-1])).withColumn("head", F.substring("path", 1, lengths[-1]))
    digest = lambda c: F.sha2(c, 256)
    listed = rules.withColumn("rule", F.concat("rule_host", "rule_path")).select(
        F.substring(digest(F.col("rule")), 1, PREFIX).alias("prefix"),
        digest(F.col("rule")).alias("rule_digest"),
        F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), "rule", "action").alias("best"),
    )
    # a hot host is one row here, whatever its pages
    keys = pages.select("tail", "head").distinct()
    expanded = keys.select("tail", "head", F.explode(expressions(F.col("tail"), F.col("head"), depths, lengths)).alias("expression"))
    expanded = expanded.withColumn("digest", digest(F.col("expression"))).withColumn("prefix", F.substring("digest", 1, PREFIX))
    found = expanded.join(listed, "prefix").where(F.col("digest") == F.col("rule_digest"))
    hits = found.groupBy("tail", "head").agg(F.max("best").alias("best")).withColumnsRenamed({"tail": "t", "head": "p"})
    out = pages.join(hits, (pages["tail"] == hits["t"]) & (pages["head"] == hits["p"]), "left")
    return out.select(
        F.col("key").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )
