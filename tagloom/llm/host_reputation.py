"""URL filters: listed rules first, then an empirical-Bayes reputation of the host; DataFrame operations only.

Labelled pages give each host a count of pages and of bad ones. A beta-binomial prior flows down from all pages to the
public suffix, the registered domain and the host: the posterior mean of a level is the prior mean of the next, and how
strongly a level leans on its parent is the intra-class correlation of its groups, by moments. A host is blocked when
the lower bound of its posterior rate of bad pages passes a limit; a host without labels gets what its domain says.

Rules and reputations are worked out once per distinct host, then pages meet their host's row. The hosts are broadcast
when they are few bytes; else the join is shuffled and Spark splits a hot host.

A null url or one without ``://`` has an empty host and path. Null labels count for nothing; of several labels of a page
the worst counts. Rules need a host, a path and a verdict; incomplete ones are left out. Of rules of equal length the one
with the longer host wins, then the one that allows. Empty tables give empty results or no reputations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.sizing import staged

#: Second-level names under which domains are registered, besides plain suffixes (fixed values).
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "com.br", "co.in", "co.za", "com.cn")
MAX_BAD = 0.25
Z = 1.645
MAX_STRENGTH = 1000.0
MAX_BROADCAST_BYTES = 8 << 20
ADDED = ("host", "path", "rule", "verdict")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label before it; a host that is no more than a suffix is its own."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    listed = F.substring_index(bare, ".", -2).isin(*SECOND_LEVEL)
    return F.when(listed, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))


def suffix_of(domain: Column) -> Column:
    at = F.instr(domain, ".")
    return F.when(at > 0, F.substring(domain, at + 1, F.length(domain))).otherwise(domain)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(host, path, verdict)`` rows as a table."""
    rows = ", ".join("('{}', '{}', '{}')".format(*(v.replace("\\", "\\\\").replace("'", "\\'") for v in r)) for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, verdict)")


def _strength(groups: DataFrame) -> float:
    """How many pages of its parent a group of this level is worth: 1 / correlation - 1, at least 1.

    It never passes ``MAX_STRENGTH`` nor the number of labelled pages, so few labels don't make a sure prior.
    """
    n, bad, mean = F.col("n"), F.col("bad"), F.col("parent")
    spread = mean * (1 - mean)
    row = groups.agg(
        F.sum((bad - n * mean) ** 2 - n * spread).alias("over"), F.sum(n * (n - 1) * spread).alias("pairs"), F.sum("n").alias("n")
    ).first()
    most = min(MAX_STRENGTH, max(1.0, float(row["n"] or 0)))
    if not row["pairs"] or row["over"] <= 0:
        return most
    return float(min(most, max(1.0, row["pairs"] / row["over"] - 1)))


def reputations(hosts: DataFrame, z: float = Z) -> DataFrame:
    """``host`` and ``bound``, the lower bound of its rate of bad pages, from ``host``, ``n``, ``bad``."""
    named = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    domains = named.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((whole["bad"] or 0) + 0.5) / ((whole["n"] or 0) + 1)

    def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
        strength = _strength(groups)
        return groups.withColumn("mean", (strength * F.col("parent") + F.col("bad")) / (strength + F.col("n"))), strength

    suffixes, _ = shrunk(suffixes.withColumn("parent", F.lit(mean)))
    above = suffixes.select("suffix", F.col("mean").alias("parent"))
    domains, _ = shrunk(domains.join(above, "suffix"))
    above = domains.select("domain", F.col("mean").alias("parent"))
    rated, strength = shrunk(named.join(above, "domain"))
    a = strength * F.col("parent") + F.col("bad")
    b = strength * (1 - F.col("parent")) + F.col("n") - F.col("bad")
    logit = F.log(a / b) - z * F.sqrt(1 / a + 1 / b)
    return rated.select("host", (1 / (1 + F.exp(-logit))).alias("bound"))


def _candidates(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``rules``, the rules for it and its parents, for hosts that have any."""
    listed = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    ).dropna()
    deepest = listed.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("d")).first()["d"] or 0
    if not deepest:
        return hosts.select("host", F.expr("CAST(NULL AS array<struct<rule_path:string,rule:string,rule_host:string,rule_verdict:string>>)").alias("rules")).limit(0)
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(deepest), F.size(labels))), lambda k: F.array_join(F.slice(labels, -k, k), ".")
    )
    steps = hosts.select("host", F.explode(F.array_distinct(parents)).alias("rule_host"))
    rule = F.struct("rule_path", F.concat("rule_host", "rule_path").alias("rule"), "rule_host", "rule_verdict")
    return steps.join(listed.distinct(), "rule_host").groupBy("host").agg(F.collect_list(rule).alias("rules"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    bad: str = "bad",
    max_bad: float = MAX_BAD,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, the ``rule`` that fits and the ``verdict``; ``labels`` has ``key`` and ``bad`` (0, 1)."""
    own = [c for c in pages.columns if c.lower() not in ADDED]
    rows = pages.select(*[pages[f"`{c}`"] for c in own])
    rows = rows.withColumn("host", host_of(F.col(f"`{url}`"))).withColumn("path", path_of(F.col(f"`{url}`")))
    marks = labels.select(F.col(key).alias("_key"), F.col(bad).cast("int").alias("_bad")).dropna().filter("_bad in (0, 1)")
    marks = marks.groupBy("_key").agg(F.max("_bad").alias("_bad"))
    seen = rows.select(F.col(f"`{key}`").alias("_key"), "host").join(marks, "_key", "left")
    counted = seen.groupBy("host").agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"))
    hosts = staged(counted, "hosts")
    judged = hosts.select("host").join(reputations(hosts), "host").join(_candidates(hosts, rules), "host", "left")
    judged = staged(judged, "judged_hosts")
    size = judged.agg(F.sum(F.octet_length("host") + 64 * (1 + F.coalesce(F.size("rules"), F.lit(0)))).alias("b")).first()["b"] or 0
    side = F.broadcast(judged) if size <= MAX_BROADCAST_BYTES else judged
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    order = F.transform(
        fitting,
        lambda r: F.struct(
            F.length(r["rule"]).alias("size"),
            F.length(r["rule_host"]).alias("host_size"),
            (r["rule_verdict"] == "allow").alias("allows"),
            r["rule"].alias("rule"),
            r["rule_verdict"].alias("verdict"),
        ),
    )
    best = F.array_max(order)
    by_host = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    joined = rows.join(side, "host").withColumn("_best", best)
    return joined.select(
        *[f"`{c}`" for c in own],
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", by_host).alias("verdict"),
    )
