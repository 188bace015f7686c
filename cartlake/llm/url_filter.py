"""URL filter: rules by host and path, and the reputation of hosts from labelled pages.

The share of bad pages of a host is estimated by empirical Bayes. The prior of a host is a beta
distribution around the estimate of its registered domain, that of a domain around its public
suffix, that of a suffix around all pages. How strongly a level is drawn to the one above comes
from the spread of its own counts. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.sources.scratch import materialize

ALLOW, BLOCK = "allow", "block"

# A host is blocked if the share of bad pages is above this, by a bound of so many standard
# deviations of its posterior (one in twenty is higher by chance).
MAX_BAD, DEVIATIONS = 0.5, 1.645

# Range of a level's correlation: 0 would be a prior of any strength, 1 none.
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.5

# Public suffixes of two labels and more; otherwise the last label is the suffix. A full list can
# be given by parameter.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz", "com.cn", "github.io")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"


def split_url(url: Column) -> tuple[Column, Column]:
    """``(host, path)``: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up
    to ``?`` or ``#``. Both are empty for NULL and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def registered(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """``(registered domain, public suffix)``. A host that is a suffix is its own domain."""
    known = F.lit(None).cast("string")
    # Of several that fit the longest counts.
    for s in sorted(suffixes, key=len):
        known = F.when((host == s) | F.endswith(host, F.lit(f".{s}")), s).otherwise(known)
    suffix = F.coalesce(known, F.substring_index(host, ".", -1))
    labels = F.size(F.split(suffix, r"\.")) + 1
    # The last labels of the host, one more than the suffix has.
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, -F.least(labels, F.size(parts)), labels), "."), suffix


def _strength(counts: DataFrame) -> float:
    """Weight of the prior, in pages, from the spread of ``bad`` of ``n`` around ``prior``.

    The moment estimate of the correlation r of a beta-binomial distribution: a group's squared
    error is n p q (1 + (n - 1) r) in the mean. The weight is 1 / r - 1.
    """
    p, n = F.col("prior"), F.col("n").cast("double")
    noise = p * (1 - p)
    error = F.sum((F.col("bad") - n * p) ** 2 - n * noise)
    # One row meets the driver.
    over, under = counts.agg(error, F.sum(n * (n - 1) * noise)).first()
    spread = over / under if under else MOST_SPREAD
    return 1 / min(max(spread, LEAST_SPREAD), MOST_SPREAD) - 1


def reputations(
    pages: DataFrame,
    outcomes: DataFrame,
    suffixes: Sequence[str] = SUFFIXES,
    max_bad: float = MAX_BAD,
    deviations: float = DEVIATIONS,
    id_col: str = "page_id",
    host_col: str = "host",
) -> DataFrame:
    """``host, domain, suffix, n_pages, n, bad, prior, mean, low, high, kept`` of each host of ``pages``.

    ``outcomes`` has ``id`` and ``bad`` (boolean) of labelled pages; an id with several labels counts
    each, NULLs count nothing. ``low`` and ``high`` are the posterior mean of the share of bad pages less and plus
    ``deviations`` standard deviations, within 0 and 1. A host is not kept if ``low`` is above
    ``max_bad``. A host without labels has the estimate of its domain. The empty host is a host.
    """
    labels = outcomes.where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")
    )
    known = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{host_col}`").alias("host"))
    known = known.join(labels, "id", "left").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    )
    domain, suffix = registered(F.col("host"), suffixes)
    hosts, total = materialize(
        known.withColumns({"domain": domain, "suffix": suffix}),
        "hosts",
        {"n": F.sum("n"), "bad": F.sum("bad")},
    )
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains, _ = materialize(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    tops = domains.groupBy("suffix").agg(*sums)

    def estimate(counts: DataFrame) -> DataFrame:
        """With ``weight`` of the prior and the posterior ``mean``."""
        weight = _strength(counts)
        mean = (F.col("bad") + weight * F.col("prior")) / (F.col("n") + weight)
        return counts.withColumn("weight", F.lit(weight)).withColumn("mean", mean)

    everywhere = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)
    tops = estimate(tops.withColumn("prior", F.lit(everywhere)))
    domains = estimate(domains.join(tops.select("suffix", F.col("mean").alias("prior")), "suffix"))
    hosts = estimate(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"]))
    deviation = deviations * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("weight") + 1))
    bounds = hosts.withColumns(
        {
            "low": F.greatest(F.col("mean") - deviation, F.lit(0.0)),
            "high": F.least(F.col("mean") + deviation, F.lit(1.0)),
        }
    ).withColumn("kept", F.col("low") <= max_bad)
    names = ("host", "domain", "suffix", "n_pages", "n", "bad", "prior", "mean", "low", "high", "kept")
    return bounds.select(*names)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` of each different ``host, path`` of ``urls`` that a rule fits.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all below it, if the path starts
    with its own. Of several the longest wins, then the lesser text, then the lesser verdict. Each
    end of the host and each start of the path that is as long as some rule's path is looked up
    among the rules, so their number may be large.
    """
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(
        F.min("verdict").alias("verdict")
    )
    listed = listed.select(
        F.col("host").alias("end"),
        F.col("path").alias("start"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    # As many numbers as rules have different lengths, in labels and in characters.
    shapes = listed.select(F.size(F.split("end", r"\.")).alias("labels"), F.length("start").alias("letters"))
    shapes = shapes.agg(F.sort_array(F.collect_set("labels")), F.sort_array(F.collect_set("letters"))).first()
    if not shapes[0]:
        return urls.where("false").select("host", "path", *(F.lit("").alias(c) for c in ("rule", "verdict")))
    parts = F.split("host", r"\.")
    labels, letters = (F.array(*(F.lit(n) for n in lengths)) for lengths in shapes)
    ends = F.transform(
        F.filter(labels, lambda n: n <= F.size(parts)), lambda n: F.array_join(F.slice(parts, -n, n), ".")
    )
    starts = F.transform(F.filter(letters, lambda n: n <= F.length("path")), lambda n: F.substring("path", 1, n))
    asked = urls.select("host", "path").distinct().select("host", "path", F.explode(ends).alias("end"))
    asked = asked.select("host", "path", "end", F.explode(starts).alias("start"))
    best = F.min(F.struct((-F.length("rule")).alias("size"), "rule", "verdict")).alias("best")
    found = asked.join(listed, ["end", "start"]).groupBy("host", "path").agg(best)
    return found.select("host", "path", "best.rule", "best.verdict")


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] | DataFrame = (),
    id_col: str = "page_id",
    url_col: str = "url",
    **options,
) -> DataFrame:
    """``id, host, path, rule, verdict, n, bad``, one row per row of ``pages``.

    The verdict is the rule's where one fits, else that of the host's reputation; ``n`` and ``bad`` are
    the labels of the host. Rows without an id or of the same id are judged each; an empty table
    gives no rows.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")
    host, path = split_url(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    urls, _ = materialize(urls, "urls")
    known = reputations(urls, outcomes, id_col="id", **options).select("host", "kept", "n", "bad")
    matched = match_rules(urls, rules).withColumnRenamed("verdict", "ruled")
    own = F.when(F.col("kept"), ALLOW).otherwise(BLOCK)
    judged = urls.join(matched, ["host", "path"], "left").join(known, "host", "left")
    return judged.select("id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "n", "bad")
