"""URL filter by empirical-Bayes host reputation (DataFrame functions only).

A page's labelled outcome is bad (1) or good (0). Outcomes are summed per host, registered domain and
suffix. Each level shrinks towards the level above through a beta prior whose strength is fitted by
moments over that level's groups (beta-binomial): the posterior mean of a suffix is the prior mean of its
domains, the posterior mean of a domain that of its hosts. A url that no rule fits is blocked when the
lower posterior bound of its host's bad rate is over ``max_bad_rate``; a host without any evidence
inherits its domain's, suffix's or the global posterior.

Defined results: null urls and urls without ``://`` have empty host and path, match no rule, and are
judged by the posterior of the empty host. Repeated rows are judged alike. Empty tables give empty results;
without any labelled outcome the prior mean is 0.5 of strength 2, and its lower bound allows everything.
Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut

#: (verdict, host, path) as a query states them.
Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; only A-Z are lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls. Longest: host and path characters together;
    of equally long rules the first listed wins."""
    rule: Column = F.lit(None).cast("string")
    verdict: Column = F.lit(None).cast("string")
    for word, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    return F.when(size >= 2, F.concat_ws(".", labels[size - 2], suffix)).otherwise(host)


def _strength(level: DataFrame, mean: str) -> DataFrame:
    """One row: prior strength by the moments of the groups' rates about their prior means.

    With rates p_i of n_i outcomes about m_i: E[sum n_i (p_i - m_i)^2] = sum m_i (1 - m_i) (1 + (n_i - 1) rho),
    and strength = 1 / rho - 1, held within [1, 10000].
    """
    m = F.col(mean)
    spread = m * (1 - m)
    seen = level.where("n > 0")
    sums = seen.agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - m, 2)).alias("q"),
        F.sum(spread).alias("a"),
        F.sum(spread * (F.col("n") - 1)).alias("b"),
    )
    rho = F.greatest((F.col("q") - F.col("a")) / F.col("b"), F.lit(1e-4))
    fitted = F.least(F.greatest(1 / rho - 1, F.lit(1.0)), F.lit(1e4))
    return sums.select(F.when(F.col("b") > 0, fitted).otherwise(F.lit(2.0)).alias("strength"))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """hosts(host, n, bad: sums of labelled outcomes) -> host, n, bad, alpha, beta of its beta posterior."""
    base = hosts.withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
    # A level is read for its strength, its prior and the level above; one row for each host, domain and suffix is kept.
    base = cut(base.withColumn("domain", registered_domain(F.col("host"), F.col("suffix"))))
    domains = cut(base.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = cut(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    total = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("mean0"))

    def shrunk(level: DataFrame, mean: str) -> DataFrame:
        # The strength is one row, so this cross join only adds a column.
        fitted = level.crossJoin(F.broadcast(_strength(level, mean)))
        return fitted.withColumn("a0", F.col(mean) * F.col("strength")).withColumn("b0", (1 - F.col(mean)) * F.col("strength"))

    def parent(level: DataFrame, key: str) -> DataFrame:
        return level.select(key, "a0", "b0", F.col("n").alias("n_up"), F.col("bad").alias("bad_up"))

    def inherited(level: DataFrame, mean: str) -> DataFrame:
        # The posterior mean of the level above without the group's own outcomes, which would else count twice.
        alpha = F.col("a0") + F.col("bad_up") - F.col("bad")
        beta = F.col("b0") + (F.col("n_up") - F.col("bad_up")) - (F.col("n") - F.col("bad"))
        return level.withColumn(mean, alpha / (alpha + beta)).drop("a0", "b0", "n_up", "bad_up")

    top = shrunk(suffixes.crossJoin(F.broadcast(total)), "mean0")
    middle = shrunk(cut(inherited(domains.join(parent(top, "suffix"), "suffix"), "mean1")), "mean1")
    low = shrunk(cut(inherited(base.join(parent(middle, "domain"), "domain"), "mean2")), "mean2")
    return low.select("host", "domain", "suffix", "n", "bad", (F.col("a0") + F.col("bad")).alias("alpha"), (F.col("b0") + F.col("n") - F.col("bad")).alias("beta"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], max_bad_rate: float = 0.5, z: float = 1.645) -> DataFrame:
    """pages(page_id, url), outcomes(page_id, bad 0/1) -> page_id, host, path, rule, verdict, bad_mean, bad_lower.

    ``bad_lower`` is the posterior mean less ``z`` standard deviations. Of several outcomes of one page id the worst
    counts, once; rows that share a page id each count with it; null outcomes don't count.
    """
    base = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    known = outcomes.where("bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
    counted = base.select("page_id", "host").join(known, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    total = F.col("alpha") + F.col("beta")
    reputation = host_reputation(counted).select("host", (F.col("alpha") / total).alias("bad_mean"), (F.col("alpha") / total - z * F.sqrt(F.col("alpha") * F.col("beta") / (total * total * (total + 1)))).alias("bad_lower"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bad_lower") > max_bad_rate, F.lit("block")).otherwise(F.lit("allow"))
    # The hot host's pages meet one row; AQE turns this into a broadcast or splits the skewed side.
    return base.join(reputation, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "bad_mean", "bad_lower")
