"""URL filters: empirical-Bayes host reputation under explicit rules.

Labelled page outcomes are counted per host, registered domain and suffix, and
shrunk downwards: the rate of bad pages of a suffix towards the overall rate,
of a domain towards its suffix, of a host towards its domain. Each level's
prior is a beta distribution whose mean is the posterior mean one level up and
whose strength is estimated from the spread of the rates at that level (moment
estimator of the intraclass correlation of beta-binomial counts). A host is
blocked when the lower posterior bound of its rate of bad pages is above
``max_bad_rate``; a host without outcomes inherits its domain's posterior.
Allow and block rules come first: of the rules that fit, the longest decides.

All of it is joins and aggregations of counts; the page table meets one row
per host, so a host with a third of all pages can be split by Spark. The
driver reads three rows of variance components.

Rows: a null url or one without ``://`` has empty host and path, fits no rule
and takes the overall rate; null outcomes are ignored, repeated ones count
each; a tie at the bound allows; without outcomes every host is allowed by the
method; an empty page table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Scratch, columns

MAX_BAD_RATE = 0.5
Z = 1.6449          # one-sided 95 % of the normal approximation to the posterior
MIN_RHO, MAX_RHO, NO_RHO = 0.001, 0.5, 0.01   # bounds and fallback of the correlation
# default public suffixes of two labels; every other suffix is the last label
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz",
                      "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "co.in", "co.kr", "com.mx")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def rule_match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest ``(host, path, verdict)`` rule that fits."""
    rule = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(
            path, F.lit(rule_path))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from its ``(n, bad)`` counts, as in the docs above."""
    r = groups.agg(F.sum("n").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"),
                   F.count(F.lit(1)).cast("double").alias("k"),
                   F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
                   F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("rr")).first()
    if not r["n"]:
        return (1 - NO_RHO) / NO_RHO
    mu = r["bad"] / r["n"]
    binomial = mu * (1 - mu)
    below = binomial * (r["n"] - r["nn"] / r["n"] - (r["k"] - 1))
    rho = NO_RHO
    if below > 0:
        between = r["rr"] - r["bad"] * r["bad"] / r["n"]     # sum of n (rate - mu)^2
        rho = min(MAX_RHO, max(MIN_RHO, (between - binomial * (r["k"] - 1)) / below))
    return (1 - rho) / rho


def reputation(hosts: DataFrame, outcomes: DataFrame, scratch: Scratch,
               suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``(host, bad_rate, bound)`` of every distinct host of ``hosts (host)``.

    ``outcomes (host, bad)``: one row per labelled page, ``bad`` 0 or 1.
    ``bad_rate`` is the posterior mean, ``bound`` its lower bound.
    """
    counts = scratch.keep(
        outcomes.where("bad is not null").groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").cast("bigint").alias("bad"))
        .withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes)),
        "host-outcomes")
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = total["bad"] / total["n"] if total["n"] else 0.0

    def level(name: str) -> DataFrame:
        return counts.groupBy(name).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    by_suffix, by_domain = level("suffix"), level("domain")
    k1, k2, k3 = _strength(by_suffix), _strength(by_domain), _strength(counts)

    def shrunk(table: DataFrame, key: str, name: str) -> DataFrame:
        return table.select(key, F.col("n").alias(f"{name}_n"), F.col("bad").alias(f"{name}_bad"))

    def filled(name: str) -> tuple[Column, Column]:
        return F.coalesce(F.col(f"{name}_n"), F.lit(0)), F.coalesce(F.col(f"{name}_bad"), F.lit(0))

    every = (hosts.select("host").distinct()
             .withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes))
             .join(shrunk(by_suffix, "suffix", "s"), "suffix", "left")
             .join(shrunk(by_domain, "domain", "d"), "domain", "left")
             .join(shrunk(counts, "host", "h"), "host", "left"))
    (sn, sb), (dn, db), (hn, hb) = filled("s"), filled("d"), filled("h")
    of_suffix = (F.lit(k1 * overall) + sb) / (F.lit(k1) + sn)
    of_domain = (F.lit(k2) * of_suffix + db) / (F.lit(k2) + dn)
    of_host = (F.lit(k3) * of_domain + hb) / (F.lit(k3) + hn)
    every = every.select("host", of_host.alias("bad_rate"), hn.alias("n"))
    spread = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.lit(k3) + F.col("n") + 1))
    return every.select("host", "bad_rate", (F.col("bad_rate") - F.lit(Z) * spread).alias("bound"))


def url_filter(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], *,
               max_bad_rate: float = MAX_BAD_RATE,
               suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES, id_col: str = "page_id", url_col: str = "url",
               outcome_url_col: str = "url", bad_col: str = "bad",
               scratch: Scratch | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, bad_rate, bound)`` of every row.

    ``suffixes`` are the public suffixes of two labels, below which the registered
    domain has three.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    url = F.col(f"`{url_col}`")
    rows = columns(pages, page_id=id_col, host=F.coalesce(host_of(url), F.lit("")),
                   path=F.coalesce(path_of(url), F.lit("")))
    labelled = columns(outcomes, host=F.coalesce(host_of(F.col(f"`{outcome_url_col}`")), F.lit("")),
                       bad=F.col(f"`{bad_col}`").cast("int"))
    known = scratch.keep(reputation(rows, labelled, scratch, suffixes), "reputation")
    rule, says = rule_match(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > max_bad_rate, F.lit("block")).otherwise(F.lit("allow"))
    return (rows.join(known, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(says, own).alias("verdict"), "bad_rate", "bound"))
