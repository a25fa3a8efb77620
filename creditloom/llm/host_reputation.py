"""Host reputation by empirical Bayes, and URL verdicts.

Labelled page outcomes are counted per host. Three beta-binomial priors chain
the levels: a suffix is shrunk towards all pages, a registered domain towards
its suffix, a host towards its domain. The strength of each prior is estimated
by moments from how much the children of a level differ beyond chance. A host
without outcomes keeps its parent's posterior.

A host is blocked when even a favourable bound of its posterior share of good
pages, ``mean + z * standard deviation``, stays below ``min_good``.

Shuffles: one aggregate of the outcomes and one of the pages per host (both
combined map-side, so a hot host is one row per task), then tables of one row
per host, domain and suffix, and the join of verdicts back to pages: broadcast
after a size check, else a shuffled join that adaptive execution splits.

Defined results: null urls and urls without ``://`` have an empty host and path,
fit no rule and get the method's verdict for the empty host, which has neither
domain nor suffix; null outcomes count for nothing; repeated outcome rows count
as often as they occur; empty tables give an empty result; extra columns are
ignored unless named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .tables import kept

# Public suffixes of two labels that are known by default. Others are one label long. A list of one's own may hold
# suffixes of any number of labels and wildcards: under *.ck every name of one label more is a suffix, but for exceptions (!www.ck).
TWO_LABEL_SUFFIXES = ("ac.jp", "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
                      "com.cn", "com.mx", "com.tr", "com.tw", "edu.au", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp",
                      "org.au", "org.uk")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class UrlRule:
    """Block or allow a host, its subdomains, and the paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """``z`` standard deviations bound a posterior; shares of good pages under ``min_good`` are bad."""

    z: float = 2.0
    min_good: float = 0.75
    weakest: float = 2.0
    strongest: float = 1000.0


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; clashing columns are replaced."""
    address = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(address, URL, 1), UPPER, LOWER)
    return df.withColumns({"host": host, "path": F.regexp_extract(address, URL, 2)})


def fitting_rule(rules: list[UrlRule], column: str = "text") -> Column:
    """The longest rule that fits ``host`` and ``path``; the first of equally long ones. Null if none fits."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    found = [F.when(((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host)))
                    & F.startswith("path", F.lit(r.path)), F.lit(getattr(r, column))) for r in ordered]
    return F.coalesce(*found, F.lit(None).cast("string"))


def with_levels(df: DataFrame, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """Adds ``domain`` and ``suffix`` of ``host``; a host that is only a suffix is its own domain."""
    by_labels: dict[int, dict[str, set[str]]] = {}
    for entry in {s.strip().lower() for s in suffixes}:
        kind = entry[0] if entry[0] in "*!" else "="
        name = entry.removeprefix("*.").removeprefix("!")
        labels = name.count(".") + 1 + {"*": 1, "=": 0, "!": -1}[kind]  # of the suffix
        by_labels.setdefault(labels, {}).setdefault(kind, set()).add(name)
    bare = F.regexp_replace("host", r":\d*$", "")
    many = F.size(F.split(bare, r"\."))

    def last(n: int) -> Column:
        return F.substring_index(bare, ".", -n)

    found: list[tuple[Column, int]] = []  # exceptions come first, then the longest
    for labels in sorted(by_labels, reverse=True):
        held = by_labels[labels]
        if "!" in held:
            found.insert(0, ((many > labels) & last(labels + 1).isin(*held["!"]), labels))
        fits = [last(labels - (k == "*")).isin(*held[k]) for k in ("=", "*") if k in held]
        if fits and labels > 1:
            found.append(((many >= labels) & reduce(or_, fits), labels))
    suffix, domain = F.lit(None), F.lit(None)
    for fits, labels in [*found, (F.lit(True), 1)]:
        suffix = F.coalesce(suffix, F.when(fits, last(labels)))
        domain = F.coalesce(domain, F.when(fits, last(labels + 1)))
    return df.withColumns({"suffix": suffix, "domain": domain})


def _strength(children: DataFrame, mean: Column, settings: Settings) -> Column:
    """Moment estimate of a prior's strength from counts ``good`` of ``n`` around the parents' means.

    With X^2 the sum of n * (p - m)^2 / (m * (1 - m)) over k children, the
    excess over k - 1 measures the intraclass correlation r; strength is 1/r - 1.
    """
    m = F.greatest(F.least(mean, F.lit(0.999)), F.lit(0.001))
    parts = children.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - m, 2) / (m * (1 - m))).alias("x2"),
        F.count("*").alias("k"), F.sum("n").alias("total"))
    r = F.expr("(x2 - (k - 1)) / (total - k)")
    kept = F.least(F.greatest(1 / r - 1, F.lit(settings.weakest)), F.lit(settings.strongest))
    alike = F.when(F.expr("total > k"), settings.strongest).otherwise(settings.weakest)  # or nothing to judge it by
    return parts.select(F.when(F.expr("total > k AND x2 > k - 1"), kept).otherwise(alike).alias("strength"))


def host_posteriors(outcomes: DataFrame, hosts: DataFrame, settings: Settings = Settings(),
                    suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """One row per host of ``hosts``: counts and the posterior share of good pages with its deviation.

    ``outcomes`` has ``host`` and ``good`` (1, 0 or null), ``hosts`` has ``host``.
    """
    counts = outcomes.where("good IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good"))
    table = kept(with_levels(hosts.select("host").unionByName(counts.select("host")).distinct().join(counts, "host", "left")
                             .fillna(0, ["n", "good"]), suffixes), "hosts")
    all_pages = table.agg(F.expr("(coalesce(sum(good), 0) + 1D) / (coalesce(sum(n), 0) + 2D)").alias("mean"))
    parent = all_pages.withColumn("level", F.lit(0))
    rows = table
    for level, name in enumerate(("suffix", "domain", "host")):
        keys = ["suffix", "domain", "host"][:level + 1]
        here = table.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if level:
            here = kept(here.join(parent, keys[:-1]), name)
        else:
            here = here.join(F.broadcast(parent), F.lit(True))  # one row of totals
        strength = _strength(here, F.col("mean"), settings)
        here = here.join(F.broadcast(strength), F.lit(True))  # one row
        a = F.col("strength") * F.col("mean") + F.col("good")
        b = F.col("strength") * (1 - F.col("mean")) + F.col("n") - F.col("good")
        here = kept(here.withColumns({"a": a, "b": b}), name)  # used for the next level's prior twice
        parent = here.select(*keys, F.expr("a / (a + b)").alias("mean"))
        rows = here
    return rows.select("host", "domain", "suffix", "n", "good", F.expr("a / (a + b)").alias("mean"),
                       F.expr("sqrt(a * b / (a + b + 1)) / (a + b)").alias("deviation"))


def judged(pages: DataFrame, outcomes: DataFrame, rules: list[UrlRule], url: str = "url",
           keep: tuple[str, ...] = ("page_id",), settings: Settings = Settings(),
           suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict and the posterior behind it, for every page.

    ``outcomes`` has a ``url`` and ``good`` (1, 0 or null) per labelled page; ``suffixes`` are as in the public suffix list.
    """
    rows = with_parts(pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(url).alias("u")), "u")
    known = with_parts(outcomes.select(F.col("url").alias("u"), "good"), "u").select("host", "good")
    table = host_posteriors(known, rows.select("host").distinct(), settings, suffixes).select("host", "n", "good", "mean", "deviation")
    joined = lookup_join(rows, table, ["host"])
    verdict = F.when(F.col("mean") + settings.z * F.col("deviation") < settings.min_good, "block").otherwise("allow")
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "host", "path",
        fitting_rule(rules).alias("rule"), F.coalesce(fitting_rule(rules, "action"), verdict).alias("verdict"),
        F.col("n").alias("host_labelled"), F.col("good").alias("host_good"))
