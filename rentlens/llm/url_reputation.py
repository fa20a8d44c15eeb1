"""URL filters: list rules first, then empirical-Bayes host reputation.

Labelled pages give each host a count of bad outcomes. Counts are rolled up
host -> registered domain -> suffix -> all, and shrunk the other way: the
posterior mean of a level is the prior mean of the level below it, with a
prior weight estimated from how far the children scatter round their parents
(method of moments, beta-binomial). A host is blocked when the lower bound of
its posterior bad rate lies above a limit, so little evidence never blocks.

Defined cases: a NULL URL or one without ``://`` has an empty host and path
and meets no rule; a host without labelled pages takes its domain's, suffix's
or the overall posterior; no labelled pages at all: nothing is blocked by
reputation. Repeated rows are judged alike; ties between rules of equal
length go to the one that sorts first; very long URLs are read whole. Extra
columns are not read. Addresses are their own registered domain.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

# Below a two-letter label (a country) these are part of the suffix; any other suffix is the last label.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gouv", "gov", "govt", "ltd", "mil", "ne", "net", "nom", "or", "org", "sch")
# Stands as suffix of hosts that are addresses; no name can be it.
ADDRESS = "[address]"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    tail = F.when(rest.isNotNull(), F.substring(url, F.length(rest) + 4, F.length(url)))
    host = F.translate(F.regexp_extract(tail, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(tail, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits (NULL: none)."""
    text, action = None, None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text) if text is None else text.when(fits, r.text)
        action = F.when(fits, r.action) if action is None else action.when(fits, r.action)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, action)


def host_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host (port, user part and a root dot left out).

    An address (four numbers, or one in brackets) is its own domain.
    """
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), "[.]$", "")
    address = bare.rlike(r"^([0-9]{1,3}[.]){3}[0-9]{1,3}$|^\[.*\]$")
    two = F.substring_index(bare, ".", -2)
    wide = two.rlike(f"^({'|'.join(SECOND_LEVEL)})[.][a-z]{{2}}$")
    suffix = F.when(address, ADDRESS).when(wide, two).otherwise(F.substring_index(bare, ".", -1))
    return F.when(address, bare).when(wide, F.substring_index(bare, ".", -3)).otherwise(two), suffix


def host_reputation(outcomes: DataFrame, z: float = 1.645, weight_bounds: tuple[float, float] = (2.0, 1000.0)) -> DataFrame:
    """Posterior bad rate of every host in ``outcomes(host, bad)``, bad 0, 1 or NULL (not labelled).

    Returns ``host, domain, suffix, n, s, mean, lower`` where ``lower`` is the
    normal lower bound of the beta posterior at ``z`` deviations.
    """
    domain, suffix = host_levels(F.col("host"))
    # Every level and its weight are read from these counts, so they are written once.
    hosts = staged(outcomes.groupBy("host")
             .agg(F.count("bad").cast("double").alias("n"),
                  F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("s"))
             .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "s"), "host-counts")
    everything = hosts.agg(((F.coalesce(F.sum("s"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1.0)).alias("p"))
    suffixes = (hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
                .withColumn("prior", everything.scalar()))
    suffixes = _shrink(suffixes, weight_bounds)
    domains = (hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
               .join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"))
    domains = _shrink(domains, weight_bounds)
    hosts = hosts.join(domains.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"])
    hosts = _shrink(hosts, weight_bounds)
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("w") + 1))
    return hosts.withColumn("lower", F.col("mean") - z * sd).select(
        "host", "domain", "suffix", "n", "s", "mean", "lower")


def _shrink(level: DataFrame, bounds: tuple[float, float]) -> DataFrame:
    """Adds ``w`` (prior weight by moments) and the posterior ``mean``."""
    n, s, m = F.col("n"), F.col("s"), F.col("prior")
    # Expected squared scatter of s/n round m: m(1-m)/n * (1 + (n-1)/(w+1)).
    # Weighted by n and solved for w + 1.
    excess = F.sum(F.when(n > 0, (s - n * m) * (s - n * m) / n - m * (1 - m)))
    span = F.sum(F.when(n > 0, m * (1 - m) * (n - 1)))
    moments = level.agg(F.when(excess > 0, span / excess - 1).alias("w"))
    w = F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), F.coalesce(moments.scalar(), F.lit(bounds[1]))))
    return level.withColumn("w", w).withColumn("mean", (s + F.col("w") * m) / (n + F.col("w")))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], limit: float = 0.5, z: float = 1.645) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_lower`` for every row of ``pages(page_id, url)``.

    The verdict is the longest fitting rule's action, else block where the
    host's posterior lower bound is above ``limit``, else allow.
    """
    host, path = split_url(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, action = first_rule(F.col("host"), F.col("path"), rules)
    rep = host_reputation(outcomes, z).select("host", F.col("lower").alias("bad_lower"))
    return (p.join(rep, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(action, F.when(F.col("bad_lower") > limit, "block").otherwise("allow")).alias("verdict"),
                    "bad_lower"))
