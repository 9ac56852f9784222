"""URL filter: rules, then empirical-Bayes host reputation.  DataFrame
functions only.

Reputation.  Labelled page outcomes (bad or not) are counted by host.  A
host's bad rate gets a beta prior around the rate of its registered domain,
that one around the rate of its suffix, and that one around the rate of all
pages.  How strongly a level shrinks (the prior's weight, in pages) is learned
from the spread of the rates at that level by the method of moments.  A host
is blocked when the lower bound of its posterior bad rate (mean - z * standard
deviation of the beta) is over the threshold: few outcomes block nothing.

Null or ``://``-less urls have an empty host and path and are judged like any
host.  Outcomes of pages that are not in the table are ignored; a page with
several outcomes counts each of them; null outcomes count as not bad.  Without
outcomes nothing is blocked but by rule.  Equally long rules: block wins, then
the alphabetically first.  Repeated pages stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Z = 1.645
THRESHOLD = 0.5
MAX_RULES = 1000
#: Suffixes of two labels under which hosts are registered.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx",
                 "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, SMALL)


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    """The last two labels, three under ``LONG_SUFFIXES``; the host itself if
    it has fewer."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, action) of the longest fitting rule; nulls if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    kind = "struct<rule:string,action:string>"
    tests = []
    for r in sorted(rules, key=lambda r: (-len(r.text), r.action != "block", r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        tests.append(F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.action).alias("action"))))
    return F.coalesce(*tests, F.lit(None).cast(kind)) if tests else F.lit(None).cast(kind)


def _weight(groups: DataFrame, top: float) -> float:
    """The prior's weight for groups (n, k): from the spread of their rates
    around the common one, between 1 and ``top`` pages."""
    s = groups.where("n > 0").agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("k").alias("k"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    if not s["g"] or s["g"] < 2:
        return top
    p = s["k"] / s["n"]
    within = p * (1 - p)
    spread = (s["kk"] - s["n"] * p * p - (s["g"] - 1) * within) / (s["n"] - s["nn"] / s["n"])
    return min(top, max(1.0, within / spread - 1)) if spread > 0 and within > 0 else top


def reputation(outcomes: DataFrame, z: float = Z, top_weight: float = 200.0) -> DataFrame:
    """Host reputations from (host, bad boolean) rows: host, n, k, mean, low.
    One row for each labelled host; ``domain`` and ``suffix`` rows give what
    hosts without outcomes inherit (level column)."""
    hosts = outcomes.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.col("bad"), F.lit(False)).cast("long")).alias("k"))
    hosts = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    rate = (whole["k"] + 0.5) / (whole["n"] + 1.0) if whole["n"] else 0.0
    ws, wd, wh = (_weight(x, top_weight) for x in (suffixes, domains, hosts))

    def level(df, name, key, prior, w):
        a = F.col("k") + F.lit(w) * prior
        b = F.col("n") - F.col("k") + F.lit(w) * (1 - prior)
        mean = a / (a + b)
        low = mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))
        return df.withColumn("mean", mean).withColumn("low", low).select(
            F.lit(name).alias("level"), F.col(key).alias("name"), "n", "k", "mean", "low", *[
                c for c in ("domain", "suffix") if c in df.columns and c != key])

    s = level(suffixes, "suffix", "suffix", F.lit(rate), ws)
    d = level(domains.join(s.select(F.col("name").alias("suffix"), F.col("mean").alias("up")), "suffix"),
              "domain", "domain", F.col("up"), wd)
    h = level(hosts.join(d.select(F.col("name").alias("domain"), F.col("mean").alias("up")), "domain"),
              "host", "host", F.col("up"), wh)
    return h.select("level", "name", "n", "k", "mean", "low").unionByName(
        d.select("level", "name", "n", "k", "mean", "low")).unionByName(s.select("level", "name", "n", "k", "mean", "low"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], url_col: str = "url", id_col: str = "page_id",
          z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """Judge every page: (page_id, host, path, rule, verdict, bad_low).

    ``outcomes`` has (page_id, bad).  Hosts without outcomes cannot be blocked
    by reputation of their own; they inherit their domain's or suffix's mean
    with that level's bound.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(F.col(f"`{url_col}`").cast("string")).alias("host"),
                        path_of(F.col(f"`{url_col}`").cast("string")).alias("path"))
    labelled = rows.select("id", "host").join(
        outcomes.select(F.col(f"`{id_col}`").alias("id"), F.col("bad")), "id").select("host", "bad")
    known = reputation(labelled, z)
    names = rows.groupBy("host").agg(F.count("*").alias("pages")).select(
        "host", registered_domain(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))

    def of(level):
        return known.where(F.col("level") == level).select(F.col("name").alias(level), F.col("low").alias(f"{level}_low"))

    lows = reduce(lambda df, x: df.join(of(x), x, "left"), ("host", "domain", "suffix"), names).select(
        "host", F.coalesce("host_low", "domain_low", "suffix_low", F.lit(0.0)).alias("bad_low"))
    judged = rows.join(lows, "host", "left").withColumn(
        "m", matched_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("m.action"), F.when(F.col("bad_low") > threshold, "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("m.rule").alias("rule"),
                         verdict.alias("verdict"), F.col("bad_low"))
