"""URL filters: allow and block rules, and empirical-Bayes reputations of hosts.

A rule names a host and the beginning of a path; the longest one that fits decides. Pages without a rule
are judged by reputation. Labelled outcomes (good or bad) are counted per host, registered domain and
suffix. At each level a group's rate is drawn from a beta distribution around its parent's posterior mean,
and the strength of that prior is estimated from how much the groups of the level differ (moments of the
beta-binomial). A host with many outcomes keeps its own rate; a host with few leans on its domain, then on
its suffix, then on all pages. A page is blocked when the lower bound of its host's rate of bad pages lies
above the limit.

Plan: outcomes meet pages in one join by page id; counts are partial aggregates down to one row per host,
per domain and per suffix, so a host with a third of all pages is a few rows per task. Pages meet host rows
in a join that Spark broadcasts or shuffles by measured size, splitting a hot host. Html is never read.

Defined results: a null url, or one without ``://``, has an empty host and path; empty hosts share one
reputation; a page id in several outcomes counts each; outcomes of unknown pages and null outcomes are left
out; repeated pages are judged one by one; with no outcomes at all every page is judged by ``PRIOR_MEAN``;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: Rate of bad pages where nothing is known, and the weight of that guess in pages.
PRIOR_MEAN, PRIOR_STRENGTH = 0.1, 2.0
#: Bounds of an estimated strength, in pages.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
#: Standard deviations below the mean at which the bound lies, and the rate above which a page is blocked.
DEVIATIONS, LIMIT = 1.64, 0.5


def _under(country: str, names: str) -> tuple[str, ...]:
    return tuple(f"{name}.{country}" for name in names.split())


#: Suffixes of two labels under which names are registered, by registries and by hosts of many sites; all other
#: suffixes are taken to be one label. A choice of the widely used ones, not the public suffix list.
LONG_SUFFIXES = (
    *_under("uk", "co org ac gov ltd plc me net nhs sch police"),
    *_under("au", "com net org edu gov id asn"),
    *_under("jp", "co ne or ac go ed ad gr lg"),
    *_under("nz", "co net org ac govt school geek gen iwi maori"),
    *_under("br", "com net org gov edu art blog eco ind inf jus leg mil"),
    *_under("in", "co net org ac edu gov firm gen ind nic res"),
    *_under("cn", "com net org edu gov ac mil"),
    *_under("kr", "co ne or ac go re pe"),
    *_under("tw", "com net org edu gov idv"),
    *_under("hk", "com net org edu gov idv"),
    *_under("sg", "com net org edu gov per"),
    *_under("my", "com net org edu gov name"),
    *_under("id", "co or ac go web sch my net"),
    *_under("th", "co in or ac go net"),
    *_under("vn", "com net org edu gov"),
    *_under("ph", "com net org edu gov"),
    *_under("pk", "com net org edu gov"),
    *_under("bd", "com net org edu gov ac"),
    *_under("za", "co org ac gov net web"),
    *_under("ng", "com net org edu gov"),
    *_under("ke", "co or ac go ne"),
    *_under("eg", "com net org edu gov"),
    *_under("il", "co org ac gov net muni"),
    *_under("tr", "com net org edu gov gen web bel k12"),
    *_under("sa", "com net org edu gov"),
    *_under("ua", "com net org edu gov in kiev"),
    *_under("ru", "com org net msk spb"),
    *_under("pl", "com net org edu gov info waw"),
    *_under("at", "co or ac gv"),
    *_under("hu", "co org"),
    *_under("es", "com nom org gob edu"),
    *_under("pt", "com org edu gov"),
    *_under("gr", "com net org edu gov"),
    *_under("fr", "com asso gouv nom"),
    *_under("it", "gov edu"),
    *_under("mx", "com net org edu gob"),
    *_under("ar", "com net org edu gob gov int mil"),
    *_under("co", "com net org edu gov nom"),
    *_under("pe", "com net org edu gob nom"),
    *_under("ve", "com co net org edu gob"),
    *_under("ec", "com net org edu gob fin"),
    *_under("uy", "com net org edu gub"),
    *("github.io", "gitlab.io", "blogspot.com", "wordpress.com", "netlify.app", "vercel.app", "pages.dev", "web.app"),
    *("herokuapp.com", "firebaseapp.com", "workers.dev", "azurewebsites.net", "cloudfront.net", "appspot.com"),
    *("readthedocs.io", "tumblr.com", "weebly.com", "wixsite.com", "livejournal.com", "uk.com", "us.com", "eu.org"),
)

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.translate(F.regexp_extract(url, _ADDRESS, 1), _UPPER, _LOWER)
    return F.coalesce(found, F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Position in ``rules`` of the longest rule that fits; null if none does."""
    places = sorted(range(len(rules)), key=lambda i: (-len(rules[i].host + rules[i].path), rules[i]))
    if not places:
        return F.lit(None).cast("int")

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)

    return F.coalesce(*(F.when(fits(rules[i]), F.lit(i)) for i in places))


def _levels(host: Column, suffixes: Sequence[str]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; an address of numbers is its own domain and suffix."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    labels = F.split(name, r"\.")
    two = F.substring_index(name, ".", -2)
    long = two.isin(*suffixes)
    numbers = name.rlike(r"^[0-9.]+$") | name.contains("[")
    suffix = F.when(numbers, name).when(long, two).otherwise(F.element_at(labels, -1))
    domain = F.when(numbers, name).when(long, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the strength of the prior of a level, from its groups (pages, bad)."""
    totals = groups.agg(
        F.sum("pages").cast("double").alias("n"),
        F.sum("bad").cast("double").alias("x"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("bad") * F.col("bad") / F.col("pages")).alias("squares"),
        F.sum(F.col("pages").cast("double") * F.col("pages")).alias("sizes"),
    )
    rate = F.col("x") / F.col("n")
    spread = rate * (1 - rate)
    between = F.col("squares") - F.col("x") * rate - spread * (F.col("k") - 1)
    scale = spread * (F.col("n") - F.col("sizes") / F.col("n") - (F.col("k") - 1))
    share = F.when(scale > 0, between / scale)
    strength = F.when(share > 0, 1 / share - 1).otherwise(F.lit(MOST_STRENGTH))
    strength = F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), strength))
    return totals.select(strength.alias("strength"))


def _posterior(groups: DataFrame) -> DataFrame:
    """``groups`` (pages, bad, parent_mean) with the weight and mean of their posterior."""
    weight = F.col("strength") + F.col("pages")
    mean = (F.col("strength") * F.col("parent_mean") + F.col("bad")) / weight
    strong = groups.withColumn("strength", _strength(groups).scalar())
    return strong.withColumn("mean", mean).withColumn("weight", weight).drop("parent_mean", "strength")


def _below(groups: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    return groups.join(parents.select(F.col(parent), F.col("mean").alias("parent_mean")), parent)


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = LONG_SUFFIXES) -> dict[str, DataFrame]:
    """Posteriors of hosts, domains, suffixes and of everything, from ``outcomes`` (host, bad 0/1)."""
    domain, suffix = _levels(F.col("host"), suffixes)
    bad = F.sum("bad").alias("bad")
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("pages"), bad)
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("pages").alias("pages"), bad)
    ends = hosts.groupBy("suffix").agg(F.sum("pages").alias("pages"), bad)
    totals = hosts.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(bad, F.lit(0)).alias("bad"))
    weight = F.col("pages") + PRIOR_STRENGTH
    everything = totals.select(weight.alias("weight"), ((F.col("bad") + PRIOR_MEAN * PRIOR_STRENGTH) / weight).alias("mean"))
    ends = _posterior(ends.withColumn("parent_mean", everything.select("mean").scalar()))
    domains = _posterior(_below(domains, ends, "suffix"))
    hosts = _posterior(_below(hosts, domains, "domain"))
    return {"host": hosts, "domain": domains, "suffix": ends, "all": everything}


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], suffixes: Sequence[str] = LONG_SUFFIXES
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``bad_bound`` of every page.

    ``pages`` has page_id and url, ``outcomes`` page_id and bad (0 or 1). A host without outcomes is judged by
    its domain, suffix, or all pages, whichever is the nearest with any. ``suffixes`` are the suffixes of two
    labels under which names are registered.
    """
    pages = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    known = outcomes.where("bad is not null").select(F.col("page_id").alias("outcome_of"), "bad")
    found = pages.join(known, F.col("page_id") == F.col("outcome_of")).select("host", "bad")
    levels = reputations(found, suffixes)
    domain, suffix = _levels(F.col("host"), suffixes)
    pages = pages.withColumn("domain", domain).withColumn("suffix", suffix)
    everything = levels.pop("all").select(F.struct("weight", "mean")).scalar()
    for level, groups in levels.items():
        pages = pages.join(groups.select(level, F.struct("weight", "mean").alias(f"by_{level}")), level, "left")
    nearest = F.coalesce(*(F.col(f"by_{level}") for level in levels), everything)
    mean, weight = nearest["mean"], nearest["weight"]
    bound = mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (weight + 1))
    place = matching_rule(F.col("host"), F.col("path"), rules)
    names = F.array(*(F.lit(rule.host + rule.path) for rule in rules)) if rules else F.expr("array(cast(null as string))")
    verdicts = F.array(*(F.lit(rule.verdict) for rule in rules)) if rules else names
    judgement = F.when(F.col("bad_bound") > LIMIT, "block").otherwise("allow")
    return (
        pages.withColumn("bad_bound", bound)
        .withColumn("place", place)
        .select(
            "page_id",
            "host",
            "path",
            F.get(names, F.col("place")).alias("rule"),
            F.coalesce(F.get(verdicts, F.col("place")), judgement).alias("verdict"),
            "bad_bound",
        )
    )
