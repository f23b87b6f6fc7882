"""Verdicts on URLs: path rules first, then the reputation of hosts by empirical Bayes.

Labelled page outcomes (bad or not) are counted by host. Hosts belong to registered domains, these to suffixes. Each level
has a beta-binomial prior: a suffix is shrunk towards the rate of all outcomes, a domain towards its suffix, a host towards
its domain. How strongly a level is shrunk (the size of its prior) is estimated from the data by the method of moments: the
more the rates of a level scatter beyond chance around their parents, the weaker the prior. A host is blocked when the lower
bound of its posterior rate of bad pages passes a limit. A host, domain or suffix without outcomes has its parent's rate and
the spread of a new member.

Counts are integers until each level is one row per name, and what leaves a level for its prior is one row, so nothing grows
on the driver. The rows of a hot host are counted before the shuffle; the verdict of a host is joined as one row per host.

Defined cases: a null URL or one without ``://`` has an empty host and path, belongs to no domain, fits no rule and has the
rate of all outcomes. For reputation (not for rules) user information, port and a final dot are cut off a host; an
address of numbers is its own domain and suffix. Null outcomes don't count; of several outcomes of a page each counts.
Without any outcome no host is blocked. A page id that is null has no outcome; each row of pages gets a verdict, repeated or
not. Of rules of equal length the one with the longer host wins, then block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, small_enough

#: Suffixes of more than one label under which names are registered; further ones can be given.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "co.za", "co.in", "com.br", "com.cn",
    "com.mx", "com.tr",
)


@dataclass(frozen=True)
class Rule:
    #: A host whose rate of bad pages is surely over this share is blocked.
    most_bad: float = 0.25
    #: Standard deviations between the posterior mean and its bound.
    deviations: float = 1.645
    #: Bounds of the intra-class correlation, so that a prior is never empty or endless.
    least_spread: float = 0.0001
    most_spread: float = 0.9


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _site(host: Column) -> Column:
    """The name that reputation is counted by."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")


def _suffix(site: Column, suffixes: tuple[str, ...]) -> Column:
    last_two = F.substring_index(site, ".", -2)
    several = last_two.isin(*suffixes) if suffixes else F.lit(False)
    return F.when(_is_address(site), site).when(several, last_two).otherwise(F.substring_index(site, ".", -1))


def _is_address(site: Column) -> Column:
    return site.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*\])$")


def _domain(site: Column, suffix: Column) -> Column:
    labels = F.size(F.split(suffix, r"\.")) + 1
    parts = F.split(site, r"\.")
    own = F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels + 1, F.lit(1)), labels), ".")
    return F.when(_is_address(site), site).otherwise(own)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) rows as a frame for ``judge_urls``; a rule is a host with a path, such as ``example.org/es/``."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def _fitting(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (row, page_id, host, path) with the longest fitting rule and its verdict.

    A fitting rule is one of the host's endings with the path's beginning of a length that rules have, so that rules are
    found by an equi-join, however many there are.
    """
    split = rules.select(
        F.col("verdict").alias("rule_verdict"),
        "rule",
        F.regexp_extract("rule", r"(?s)^([^/]*)", 1).alias("rule_host"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("rule_path"),
    ).filter("rule_verdict IS NOT NULL AND rule IS NOT NULL")
    split = materialize(split.groupBy("rule", "rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict")))
    lengths = sorted(r[0] for r in split.select(F.length("rule_path")).distinct().collect())  # no more than a URL has characters
    endings = F.expr(r"transform(sequence(1, size(split(host, '[.]'))), i -> substring_index(host, '.', -i))")
    starts = [F.when(F.length("path") >= n, F.expr(f"left(path, {n})")) for n in lengths]
    keys = urls.filter("host <> ''").select(
        "row", "page_id", "host", "path", F.explode(endings).alias("rule_host"), F.array_compact(F.array(*starts)).alias("starts")
    )
    keys = keys.select("row", "page_id", "host", "path", "rule_host", F.explode_outer("starts").alias("rule_path"))
    none = urls.filter("host = ''").select("*", F.lit("").alias("rule_host"), F.lit(None).cast("string").alias("rule_path"))
    known = F.broadcast(split) if small_enough(split, BROADCAST_ROWS) else split
    order = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("host_n"), "rule_verdict", "rule")
    # The keys of a row lie side by side, so they are merged before the shuffle.
    best = keys.unionByName(none).join(known, ["rule_host", "rule_path"], "left").groupBy("row", "page_id", "host", "path")
    return best.agg(F.max(F.when(F.col("rule").isNotNull(), order)).alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict")
    )


def _prior_size(level: DataFrame, rule: Rule) -> float:
    """Size of the prior of a level with counts ``n`` and ``bad`` and the parent's rate ``mean``.

    Of n outcomes with rate m and correlation r, the count of bad ones has the variance n m (1 - m) (1 + (n - 1) r).
    """
    chance = F.col("mean") * (1 - F.col("mean"))
    beyond = F.pow(F.col("bad") - F.col("n") * F.col("mean"), 2) - F.col("n") * chance
    room = F.col("n") * (F.col("n") - 1) * chance
    found = level.agg(F.sum(beyond).alias("beyond"), F.sum(room).alias("room")).first()
    correlation = found["beyond"] / found["room"] if found["room"] else rule.most_spread
    return 1 / min(max(correlation, rule.least_spread), rule.most_spread) - 1


def _shrunk(level: DataFrame, rule: Rule, names: list[str]) -> DataFrame:
    """``names`` with ``rate``, shrunk towards ``mean``, and ``size``, outcomes and prior together."""
    prior = F.lit(_prior_size(level, rule))
    rate = (F.col("mean") * prior + F.col("bad")) / (prior + F.col("n"))
    return level.select(*names, rate.alias("rate"), (prior + F.col("n")).alias("size"))


def host_reputation(counts: DataFrame, rule: Rule = Rule(), suffixes: tuple[str, ...] = SUFFIXES) -> tuple[DataFrame, dict]:
    """(site, rate, size) of all sites, and the same of all outcomes together.

    ``counts`` has ``host``, ``n`` (outcomes, may be 0) and ``bad``; hosts of one site are taken together.
    """
    sites = counts.groupBy(_site(F.col("host")).alias("site")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).filter("site <> ''")
    suffix = _suffix(F.col("site"), suffixes)
    sites = materialize(sites.select("site", suffix.alias("suffix"), _domain(F.col("site"), suffix).alias("domain"), "n", "bad"))
    domains = materialize(sites.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = tops.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    # One more of each, so that no rate is 0 or 1.
    every = {"n": n, "rate": (bad + 1) / (n + 2), "size": n + 2}

    tops = materialize(_shrunk(tops.withColumn("mean", F.lit(every["rate"])), rule, ["suffix"]))
    parents = tops.select("suffix", F.col("rate").alias("mean"))
    domains = materialize(_shrunk(domains.join(parents, "suffix"), rule, ["suffix", "domain"]))
    parents = domains.select("suffix", "domain", F.col("rate").alias("mean"))
    return _shrunk(materialize(sites.join(parents, ["suffix", "domain"])), rule, ["site"]), every


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: DataFrame,
    rule: Rule = Rule(),
    suffixes: tuple[str, ...] = SUFFIXES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, rate, lower), one row for each row of ``pages``.

    ``outcomes`` has ``page_id`` and ``bad`` (boolean) of labelled pages; ``rules`` has ``rule`` and ``verdict``.
    """
    urls = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    urls = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.select(F.col("page_id").cast("bigint").alias("page_id"), "bad").filter("bad IS NOT NULL AND page_id IS NOT NULL")
    labelled = urls.select("page_id", "host").join(known, "page_id")
    labelled = labelled.groupBy("host").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    # Hosts without outcomes count none.
    none = F.lit(0).cast("bigint")
    each = urls.select("host").distinct().select("host", none.alias("n"), none.alias("bad"))
    counts = materialize(each.unionByName(labelled).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    sites, every = host_reputation(counts, rule, suffixes)

    hosts = counts.select("host", _site(F.col("host")).alias("site")).join(sites, "site", "left")
    rate, size = (F.coalesce(F.col(c), F.lit(float(every[c]))) for c in ("rate", "size"))
    lower = F.col("rate") - F.lit(rule.deviations) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("size") + 1))
    hosts = materialize(hosts.select("host", rate.alias("rate"), size.alias("size")).select("host", "rate", lower.alias("lower")))
    own = F.when((F.col("lower") > rule.most_bad) & F.lit(every["n"] > 0), F.lit("block")).otherwise(F.lit("allow"))
    ruled = _fitting(urls.withColumn("row", F.monotonically_increasing_id()), rules)
    few = small_enough(hosts, BROADCAST_ROWS // 10)
    return ruled.join(F.broadcast(hosts) if few else hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "rate", "lower"
    )
