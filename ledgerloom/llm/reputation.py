"""URL filter by rules and by empirical-Bayes host reputation.

Labelled outcomes of pages are counted per host. The share of bad pages of a host is shrunk toward
the share of its registered domain, that toward its suffix's, and that toward the overall share, by
beta-binomial posteriors: a unit with n outcomes, x of them bad, below a parent share m has the
posterior Beta(x + k m, n - x + k (1 - m)). The prior strength k of each level comes from the data,
by the moments of the beta-binomial over the units of that level. A host is blocked where the lower
bound of its posterior share is above ``max_bad``; hosts without outcomes have their domain's share.

Rules (a host, then a path prefix) come first: a rule fits its host and all subdomains where the
url's path begins with the rule's path, and the longest fitting rule decides.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is
judged as the host ''. Null outcomes count as none, outcomes of unknown pages are left out, repeated
outcomes of a page count once (bad if any is bad). Without outcomes every share is 0 and the method
allows. Repeated pages are judged each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    pattern: str  # host, then a path from its first slash on

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class Reputation:
    """``max_bad``: the highest share of bad pages that the lower bound may reach; ``z``: standard
    deviations below the posterior mean; strengths of priors stay within the two bounds."""

    max_bad: float = 0.3
    z: float = 1.645
    weakest: float = 1.0
    strongest: float = 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(pattern, verdict) of the longest fitting rule, else null. ``rules`` is configuration."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        hit = F.struct(F.lit(rule.pattern).alias("pattern"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found if found is not None else F.lit(None).cast("struct<pattern:string,verdict:string>")


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, bad) for every host of ``pages`` (page_id, host).

    ``outcomes`` is (page_id, bad) with ``bad`` 0 or 1.
    """
    once = outcomes.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    counts = pages.join(once, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    return counts.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))


def prior_strengths(hosts: DataFrame, policy: Reputation) -> tuple[float, dict[str, float]]:
    """The overall share, and the prior strength of each level; one row per level reaches the driver."""
    levels = ("host", "domain", "suffix")
    counted = None
    for level in levels:
        part = hosts.groupBy(F.lit(level).alias("level"), F.col(level).alias("unit")).agg(F.sum("n").alias("n"), F.sum("bad").alias("x")).filter("n > 0")
        counted = part if counted is None else counted.union(part)
    sums = counted.groupBy("level").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("x").alias("x"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("x") * F.col("x") / F.col("n")).alias("xx")).collect()
    strengths = dict.fromkeys(levels, policy.strongest)
    share = 0.0
    for row in sums:
        n, p = row["n"], row["x"] / row["n"]
        share = p
        spread = row["xx"] - n * p * p
        free = n - row["nn"] / n - (row["k"] - 1)
        if 0 < p < 1 and free > 0:
            rho = (spread / (p * (1 - p)) - (row["k"] - 1)) / free
            strengths[row["level"]] = min(policy.strongest, max(policy.weakest, 1 / rho - 1)) if rho > 0 else policy.strongest
    return share, strengths


def host_reputation(hosts: DataFrame, policy: Reputation = Reputation()) -> DataFrame:
    """(host, n_outcomes, bad_share, bad_bound): posterior mean and lower bound of every host."""
    share, strength = prior_strengths(hosts, policy)
    suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("bad").alias("sx"))
    suffix = suffix.select("suffix", ((F.col("sx") + strength["suffix"] * share) / (F.col("sn") + strength["suffix"])).alias("suffix_share"))
    domain = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("bad").alias("dx")).join(suffix, "suffix")
    domain = domain.select("domain", ((F.col("dx") + strength["domain"] * F.col("suffix_share")) / (F.col("dn") + strength["domain"])).alias("domain_share"))
    k = strength["host"]
    a = F.col("bad") + k * F.col("domain_share")
    b = F.col("n") - F.col("bad") + k * (1 - F.col("domain_share"))
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(domain, "domain").select(
        "host", F.col("n").alias("n_outcomes"), (a / (a + b)).alias("bad_share"), (a / (a + b) - policy.z * spread).alias("bad_bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], policy: Reputation = Reputation(), page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Every page with host, path, rule, verdict and the reputation behind it."""
    host, path = url_parts(pages[url])
    parts = pages.select(pages[page_id].alias("page_id"), host.alias("host"), path.alias("path"))
    standing = host_reputation(host_counts(parts, outcomes), policy)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_bound") > policy.max_bad, "block").otherwise("allow")
    return parts.join(standing, "host", "left").withColumn("_rule", rule).select(
        "page_id", "host", "path", F.col("_rule.pattern").alias("rule"), F.coalesce("_rule.verdict", method).alias("verdict"),
        "n_outcomes", F.round("bad_share", 6).alias("bad_share"), F.round("bad_bound", 6).alias("bad_bound"))


def judge_sql(rules: Sequence[Rule], policy: Reputation = Reputation()) -> str:
    """The same judgement of ``pages`` by ``labels`` in DuckDB's SQL."""
    def fits(r: Rule) -> str:
        return f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"

    ordered = sorted(rules, key=lambda r: -len(r.pattern))
    pattern = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.pattern}'" for r in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in ordered) + " END"

    def strength(level: str) -> str:
        return f"""(SELECT CASE WHEN NOT (p > 0 AND p < 1 AND free > 0) OR rho <= 0 THEN {policy.strongest}
            ELSE least({policy.strongest}, greatest({policy.weakest}, 1 / rho - 1)) END FROM (
            SELECT *, CASE WHEN p > 0 AND p < 1 AND free > 0 THEN (spread / (p * (1 - p)) - (k - 1)) / free END AS rho FROM (
            SELECT k, p, xx - n * p * p AS spread, n - nn / n - (k - 1) AS free FROM (
            SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(x)::DOUBLE / sum(n) AS p, sum(n * n)::DOUBLE AS nn, sum(x * x / n::DOUBLE) AS xx
            FROM (SELECT {level}, sum(n) AS n, sum(bad) AS x FROM hosts GROUP BY {level} HAVING sum(n) > 0)))))"""

    return f"""
    WITH once AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL AND toxic IS NOT NULL THEN 0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    parts AS (SELECT page_id,
      translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    hosts AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
      count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM parts LEFT JOIN once USING (page_id) GROUP BY host),
    prior AS (SELECT coalesce((SELECT sum(bad)::DOUBLE / nullif(sum(n), 0) FROM hosts), 0) AS share,
      coalesce({strength('host')}, {policy.strongest}) AS kh, coalesce({strength('domain')}, {policy.strongest}) AS kd, coalesce({strength('suffix')}, {policy.strongest}) AS ks),
    suffixes AS (SELECT suffix, (sum(bad) + ks * share) / (sum(n) + ks) AS suffix_share FROM hosts, prior GROUP BY suffix, ks, share),
    domains AS (SELECT domain, (sum(bad) + kd * suffix_share) / (sum(n) + kd) AS domain_share
      FROM hosts JOIN suffixes USING (suffix), prior GROUP BY domain, kd, suffix_share),
    posterior AS (SELECT host, n, bad + kh * domain_share AS a, n - bad + kh * (1 - domain_share) AS b FROM hosts JOIN domains USING (domain), prior),
    standing AS (SELECT host, n AS n_outcomes, a / (a + b) AS bad_share,
      a / (a + b) - {policy.z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bad_bound FROM posterior)
    SELECT page_id, host, path, {pattern} AS rule, coalesce({verdict}, CASE WHEN bad_bound > {policy.max_bad} THEN 'block' ELSE 'allow' END) AS verdict,
      n_outcomes, round(bad_share, 6) AS bad_share, round(bad_bound, 6) AS bad_bound
    FROM parts LEFT JOIN standing USING (host)"""
