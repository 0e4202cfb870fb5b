"""Empirical-Bayes host reputation and host/path rules for URL filtering.

Labelled page outcomes are counted per host. A beta-binomial model per level
(host inside registered domain, domain inside suffix, suffix inside everything)
shrinks a thin host towards its domain, a thin domain towards its suffix and a
thin suffix towards the overall rate. A page is blocked when the lower posterior
bound of its host's bad rate lies above a threshold. Rules come before reputation.

Only DataFrame expressions: counts are map-side combined, the levels above the
host are aggregates of the host table, and the pages meet it in one equi-join,
whose hot hosts the adaptive planner splits.

Defined results: a NULL url or one without ``://`` has empty host and path, fits no
rule and is judged as a host of its own named ``''``; a page without outcome adds
no count; a NULL outcome is no outcome; a page id that occurs twice is judged
twice; without any outcome the prior rate is 0 and nothing is blocked by reputation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def public_suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else NULL.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of equally long rules the one with the longer host wins, then ``block``.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block"))
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(ranked):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(groups: DataFrame) -> DataFrame:
    """Prior strength of the groups of one level, by moments: one row, one column.

    With weights n_i the spread of the group rates gives the intra-class
    correlation rho, kept in [0.001, 0.5]; the strength is (1 - rho) / rho, so the
    level above always weighs as much as one page at least.
    """
    sums = groups.where(F.col("n") > 0).agg(
        F.sum("n").alias("t"), F.sum("bad").alias("b"), F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.count("*").alias("k"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("b2"),
    )
    rate = F.col("b") / F.col("t")
    spread = F.col("b2") - F.col("b") * rate
    base = rate * (1 - rate)
    free = F.col("t") - F.col("n2") / F.col("t") - (F.col("k") - 1)
    rho = (spread - base * (F.col("k") - 1)) / F.when((base > 0) & (free > 0), base * free)
    rho = F.greatest(F.least(F.coalesce(rho, F.lit(0.5)), F.lit(0.5)), F.lit(0.001))
    return sums.select(((1 - rho) / rho).alias("strength"))


def host_reputation(pages: DataFrame, url_col: str = "url", outcome_col: str = "bad") -> DataFrame:
    """One row per host: n, bad, posterior parameters a and b, mean and deviation of the bad rate.

    ``outcome_col``: 1 for a bad page, 0 for a good one, NULL for an unlabelled one.
    """
    known = pages.select(url_host(F.col(url_col)).alias("host"), F.col(outcome_col).cast("long").alias("y"))
    hosts = known.groupBy("host").agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": public_suffix(F.col("host"))})
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("suffix", "domain").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    # Scalar subqueries of one row each: the overall rate and one strength per level.
    overall = suffixes.agg(*counts).select(F.coalesce(F.try_divide("bad", "n"), F.lit(0.0)))
    m_suffix, m_domain, m_host = (_strength(x).scalar() for x in (suffixes, domains, hosts))
    suffixes = suffixes.withColumn("m", m_suffix).select(
        "suffix", ((F.col("m") * overall.scalar() + F.col("bad")) / (F.col("m") + F.col("n"))).alias("mean_suffix")
    )
    domains = domains.withColumn("m", m_domain).join(suffixes, "suffix").select(
        "domain", ((F.col("m") * F.col("mean_suffix") + F.col("bad")) / (F.col("m") + F.col("n"))).alias("mean_domain")
    )
    joined = hosts.withColumn("m2", m_host).join(domains, "domain")
    a = F.col("m2") * F.col("mean_domain") + F.col("bad")
    b = F.col("m2") * (1 - F.col("mean_domain")) + F.col("n") - F.col("bad")
    joined = joined.withColumns({"a": a, "b": b})
    total = F.col("a") + F.col("b")
    return joined.select(
        "host", "domain", "suffix", "n", "bad", "a", "b", (F.col("a") / total).alias("mean"),
        F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1))).alias("deviation"),
    )


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], threshold: float = 0.5, z: float = 1.645,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, bound.

    ``outcomes`` has (id_col, bad); of several for one id the worst counts, once. ``bound`` is the lower
    posterior bound of the host's bad rate, mean - z * deviation; the page of a host
    with a bound above ``threshold`` is blocked unless a rule decides.
    """
    wanted = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    worst = outcomes.groupBy(id_col).agg(F.max("bad").alias("bad"))
    labelled = wanted.join(worst, id_col, "left")
    bounds = host_reputation(labelled).select(
        F.col("host").alias("known_host"), F.greatest(F.col("mean") - z * F.col("deviation"), F.lit(0.0)).alias("bound")
    )
    judged = wanted.select(id_col, url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = judged.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    judged = judged.join(bounds, F.col("host") == F.col("known_host"), "left")
    by_host = F.when(F.col("bound") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        id_col, "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_host).alias("verdict"), F.coalesce("bound", F.lit(0.0)).alias("bound"),
    )
