"""Host reputation: page outcomes shrunk through suffix, registered domain and host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.batches import quoted

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Bound: a host is blocked when the share of bad pages lies above MAX_BAD at Z
# posterior standard deviations below the mean.
MAX_BAD, Z = 0.5, 1.645
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
_RULES = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and ``/``, ``?``, ``#``; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def domain_of(host: Column, long_suffixes: tuple[str, ...] = ()) -> Column:
    """Last two labels of a host, last three under one of ``long_suffixes`` (as ``co.uk``)."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), F.substring_index(host, ".", -3)).otherwise(
        two) if long_suffixes else two


def _strength(groups: DataFrame) -> DataFrame:
    """One row: pages a prior is worth, by moments of (n, bad) over the groups.

    The less groups differ beyond chance, the more the prior weighs.
    """
    sums = groups.agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("t"), F.sum("bad").alias("b"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("bb"))
    return sums.selectExpr("CASE WHEN t > 0 THEN b / t ELSE 0D END AS mean", f"""
        CASE WHEN g < 2 OR b = 0 OR b = t THEN {MOST_STRENGTH}D ELSE
          least({MOST_STRENGTH}D, greatest({LEAST_STRENGTH}D,
            (t - nn / t - (g - 1))
            / greatest(1e-9D, (bb - b * (b / t)) / ((b / t) * (1 - b / t)) - (g - 1)) - 1))
        END AS strength""")


def host_reputation(hosts: DataFrame, outcomes: DataFrame,
                    long_suffixes: tuple[str, ...] = ()) -> DataFrame:
    """Each host of ``hosts`` with labelled counts and the lower posterior bound of bad pages.

    ``hosts`` has one column host; ``outcomes`` has host and bad (0 or 1; rows with a
    null are left out). A suffix (last label) gets a beta prior from all pages,
    a registered domain one from its suffix, a host one from its domain; hosts
    without outcomes keep their domain's. Only counts per host are shuffled.
    """
    seen = outcomes.filter(F.col("bad").isNotNull() & F.col("host").isNotNull()).groupBy(
        "host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").cast("long").alias("bad"))
    counts = hosts.join(seen, "host", "left").select(
        "host", domain_of(F.col("host"), long_suffixes).alias("domain"),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"))
    counts = counts.withColumn("suffix", F.substring_index("domain", ".", -1))
    domains = counts.groupBy("domain", "suffix").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def strength(groups: DataFrame, name: str) -> DataFrame:
        return F.broadcast(_strength(groups.filter("n > 0")).select(
            F.col("strength").alias(name), F.col("mean").alias(f"{name}_mean")))  # one row

    def shrunk(bad: str, n: str, weight: str, prior: str) -> Column:
        return (F.col(bad) + F.col(weight) * F.col(prior)) / (F.col(n) + F.col(weight))

    suffixes = suffixes.crossJoin(strength(suffixes, "k0")).select(
        "suffix", shrunk("bad", "n", "k0", "k0_mean").alias("suffix_mean"))
    domains = domains.crossJoin(strength(domains, "k1")).join(suffixes, "suffix").select(
        "domain", shrunk("bad", "n", "k1", "suffix_mean").alias("domain_mean"))
    mean = shrunk("bad", "n", "k2", "domain_mean")
    return counts.crossJoin(strength(counts, "k2")).join(domains, "domain").select(
        "host", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"),
        (mean - F.lit(Z) * F.sqrt(mean * (1 - mean) / (F.col("n") + F.col("k2") + 1))).alias(
            "bad_bound"))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Each host with the rules of itself and its parent domains, longest first."""
    parents = F.expr(r"transform(sequence(1, size(split(host, '\\.'))), "
                     "k -> substring_index(host, '.', -k))")
    fitting = hosts.select("host", F.explode(parents).alias("parent")).join(
        rules.select(F.col("host").alias("parent"), "path", "verdict"), "parent")
    rule = F.struct(F.length(F.concat("parent", "path")).alias("size"),
                    F.concat("parent", "path").alias("rule"), "path", "verdict")
    return fitting.groupBy("host").agg(F.sort_array(F.collect_list(rule), False).alias("rules"))


def judge_urls(df: DataFrame, url: str, outcomes: DataFrame, rules: DataFrame,
               long_suffixes: tuple[str, ...] = (), max_bad: float = MAX_BAD) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``n_labelled``, ``n_bad``.

    ``rules`` has host, path, verdict (allow or block). A rule fits its host and all
    subdomains where the url's path starts with the rule's; the longest fitting one
    decides. Otherwise a host is blocked when its posterior bound of bad pages exceeds
    ``max_bad``. ``outcomes`` has url and bad. Urls are reduced to distinct hosts
    map-side before anything is shuffled; the one join back is split by AQE where a
    host is hot. Null urls and urls without ``://`` have empty host and path and
    share the reputation of the empty host. Equal rows get equal results; input columns
    of these names are replaced; empty frames of any kind are fine.
    """
    added = ("host", "path", "rule", "verdict", "n_labelled", "n_bad")
    kept = [quoted(c) for c in df.columns if c.lower() not in added]
    pages = df.select(*kept, url_host(F.col(quoted(url))).alias("host"),
                      url_path(F.col(quoted(url))).alias("path"))
    hosts = pages.select("host").distinct()
    known = outcomes.select(url_host(F.col("url")).alias("host"), "bad")
    about = host_reputation(hosts, known, long_suffixes).join(
        rules_by_host(hosts, rules), "host", "left").withColumnsRenamed(
        {"host": "__host", "rules": "__rules", "n_labelled": "__n", "n_bad": "__bad",
         "bad_bound": "__bound"})
    best = F.get(F.filter("__rules", lambda r: F.col("path").startswith(r.path)), F.lit(0))
    return pages.join(about, F.col("host") == F.col("__host")).withColumn("__best", best).select(
        *kept, "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce("__best.verdict", F.when(F.col("__bound") > max_bad, "block").otherwise(
            "allow")).alias("verdict"),
        F.col("__n").alias("n_labelled"), F.col("__bad").alias("n_bad"))
