"""URL filter: path rules first, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host, registered domain
and suffix.  From the top down each level's rate is shrunk toward its parent
through a beta-binomial prior whose strength is fitted by the method of moments
over all groups of that level.  A page is blocked if the lower posterior bound
of its host's bad rate exceeds ``threshold``; hosts without labels carry their
domain's posterior.  Only counts per host are shuffled, combined map-side.

A null url or one without ``://`` has an empty host and path; the empty host is
a host like any other.  Labels that are null count as no label; a page labelled
twice counts twice.  No pages give no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from .common import join_groups, stage

MAX_RULES = 1000


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(raw) + 1), "^[^?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule (``host/path``) that fits; null if none does.

    The list is part of the plan and may hold at most ``MAX_RULES`` rules.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, got {len(rules)}")
    fit = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):          # the last when() is tested first
        name, slash, rest = rule.partition("/")
        own = (host == name) | host.endswith("." + name)
        fit = F.when(own & path.startswith(slash + rest), F.lit(rule)).otherwise(fit)
    return fit


# Suffixes of two labels below which names are registered; others have one label.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "com.br", "com.cn", "com.mx",
            "com.tr", "co.in", "co.kr", "co.za", "com.ar", "com.sg", "com.hk", "com.tw")


def suffix(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The last label of a host, or the last two where they are one of ``suffixes``."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1)) if suffixes else F.substring_index(host, ".", -1)


def registered_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The suffix and the label before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two) if suffixes else two


def _strength(groups: DataFrame) -> float:
    """Pseudo-counts of the prior of one level, by moments over groups with (bad, n, m).

    The variance of the groups' rates beyond binomial noise around their parent
    means ``m``; at least 1, at most 1,000 or the number of labelled outcomes.
    """
    noise = F.col("m") * (1 - F.col("m"))
    r = groups.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), F.lit(2.0))).alias("seen"),
        F.sum(noise).alias("noise"), F.sum(F.col("n") * noise).alias("most"), F.sum("n").alias("n")).first()
    most = min(1000.0, max(1.0, float(r["n"] or 0)))
    if not r["seen"] or r["seen"] <= r["noise"] or r["most"] <= r["noise"]:
        return most
    return min(most, max(1.0, (r["most"] - r["noise"]) / (r["seen"] - r["noise"]) - 1))


def _posterior(groups: DataFrame, strength: float) -> DataFrame:
    """Beta(a, b) of every group and its mean."""
    return (groups.withColumn("a", F.col("bad") + strength * F.col("m"))
            .withColumn("b", F.col("n") - F.col("bad") + strength * (1 - F.col("m")))
            .withColumn("mean", F.col("a") / (F.col("a") + F.col("b"))))


def host_reputation(outcomes: DataFrame, *, z: float = 1.645, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Posterior of every host in ``outcomes`` (host, bad: boolean or null): host, pages, n, mean, lower.

    ``lower`` is the mean less ``z`` posterior standard deviations.
    """
    hosts = stage(outcomes.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
        .withColumn("domain", registered_domain(F.col("host"), suffixes)).withColumn("suffix", suffix(F.col("host"), suffixes)), "hosts")
    total = hosts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    base = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)

    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = hosts.groupBy("suffix").agg(*counts).withColumn("m", F.lit(base))
    up = _posterior(suffixes, _strength(suffixes)).select("suffix", F.col("mean").alias("m"))
    domains = stage(hosts.groupBy("suffix", "domain").agg(*counts).join(up, "suffix"), "domains")
    up = _posterior(domains, _strength(domains)).select("domain", F.col("mean").alias("m"))
    below = stage(hosts.join(up, "domain"), "below")
    a, b = F.col("a"), F.col("b")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return _posterior(below, _strength(below)).select(
        "host", "pages", "n", "mean", F.greatest(F.col("mean") - z * sd, F.lit(0.0)).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], *, threshold: float = 0.35,
               id_col: str = "page_id", url_col: str = "url", outcome_id: str = "doc_id",
               bad_col: str = "bad", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, host_rate, host_lower.

    ``outcomes`` holds labelled outcomes by page id; ``rules`` maps ``host/path``
    to ``allow`` or ``block``; ``suffixes`` are those of two labels.
    """
    host, path = url_parts(F.col(url_col))
    parts = stage(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), "parts")
    labels = outcomes.select(F.col(outcome_id).alias("page_id"), F.col(bad_col).alias("bad"))
    seen = parts.select("page_id", "host").join(labels, "page_id", "left")
    reputation = stage(host_reputation(seen, suffixes=suffixes), "reputation")
    rule = longest_rule(F.col("host"), F.col("path"), list(rules))
    of_rule = F.lit(None).cast("string")
    for r, verdict in rules.items():
        of_rule = F.when(F.col("rule") == r, F.lit(verdict)).otherwise(of_rule)
    own = F.when(F.col("lower") > threshold, "block").otherwise("allow")
    return (join_groups(parts, reputation, "host", "pages", parts.count(), "left").withColumn("rule", rule)
            .select("page_id", "host", "path", "rule", F.coalesce(of_rule, own).alias("verdict"),
                    F.col("mean").alias("host_rate"), F.col("lower").alias("host_lower")))
