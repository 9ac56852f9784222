import math
import random
import re

import pytest

from tickforge.llm.queries import URL_RULES
from tickforge.llm.url_filter import Rule, judge


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")


def rule_of(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fit, key=lambda r: (-len(r.text), r.action != "block", r.text), default=None)


def posteriors(outcomes, top=200.0, z=1.645):
    """{name: lower bound} of hosts, domains, suffixes; the same formulas in plain Python."""
    levels = [{}, {}, {}]
    for host, bad in outcomes:
        parts = host.split(".")
        for level, name in zip(levels, (host, ".".join(parts[-2:]), parts[-1])):
            n, k = level.get(name, (0, 0))
            level[name] = (n + 1, k + bool(bad))

    def weight(groups):
        n, k = (sum(x[i] for x in groups.values()) for i in (0, 1))
        p = k / n
        v = (sum(b * b / a for a, b in groups.values()) - n * p * p - (len(groups) - 1) * p * (1 - p)) / (
            n - sum(a * a for a, _ in groups.values()) / n) if len(groups) > 1 else 0
        return min(top, max(1.0, p * (1 - p) / v - 1)) if v > 0 and 0 < p < 1 else top

    out, up = {}, {}
    n, k = (sum(x[i] for x in levels[2].values()) for i in (0, 1))
    for depth, level in enumerate(reversed(levels)):
        w, mean = weight(level), {}
        for name, (a, b) in level.items():
            parent = (k + 0.5) / (n + 1) if depth == 0 else up[name.split(".")[-1] if depth == 1 else ".".join(name.split(".")[-2:])]
            al, be = b + w * parent, a - b + w * (1 - parent)
            m = mean[name] = al / (al + be)
            out[depth, name] = m - z * math.sqrt(m * (1 - m) / (al + be + 1))
        up = mean
    return out


def test_equals_plain_python(spark):
    rng = random.Random(2)
    hosts = [f"h{i}.{d}.{s}" for i in range(12) for d in ("example", "other") for s in ("com", "net", "org")] + ["solo", "a.b.org"]
    rate = {h: rng.choice([0.02, 0.1, 0.95]) for h in hosts}
    pages, labels = [], []
    for p in range(1500):
        h = rng.choice(hosts)
        url = f"HTTP{'s' * (p % 2)}://{h.upper() if p % 5 else h}{rng.choice(['', '/', '/en/x', '/es/', '/fr/y?q=1', '/de#f', '?a://b'])}"
        pages.append((p, url))
        if p % 3:
            labels.append((p, rng.random() < rate[h]))
    pages += [(9001, None), (9002, "no scheme.com/en/"), (9003, "x://"), (9004, "://www.example.com/en/")]
    df = judge(spark.createDataFrame(pages, "page_id long, url string"),
               spark.createDataFrame(labels, "page_id long, bad boolean"), URL_RULES)
    low = posteriors([(parse(dict(pages)[p])[0], bad) for p, bad in labels])
    kinds = set()
    for r in df.collect():
        host, path = parse(dict(pages)[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule = rule_of(host, path, URL_RULES)
        bound = next((low[d, n] for d, n in ((2, host), (1, ".".join(host.split(".")[-2:])), (0, host.split(".")[-1]))
                      if (d, n) in low), 0.0)
        assert r.bad_low == pytest.approx(bound)
        want = rule.action if rule else "block" if bound > 0.5 else "allow"
        assert (r.rule, r.verdict) == (rule.text if rule else None, want)
        kinds.add((rule is None, r.verdict))
    assert len(kinds) == 4


def test_few_outcomes_block_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x"), (2, "http://b.org/", "y"), (2, "http://b.org/", "y")],
                                  "page_id long, url string, host string")
    bad = spark.createDataFrame([(1, True), (77, True), (2, None)], "page_id long, bad boolean")
    assert [r.verdict for r in judge(pages, bad, []).collect()] == ["allow"] * 3
    assert {r.verdict for r in judge(pages, bad.limit(0), []).collect()} == {"allow"}
    assert judge(pages.limit(0), bad, URL_RULES).count() == 0


def test_equally_long_rules(spark):
    pages = spark.createDataFrame([(1, "http://x.ab/c/")], "page_id long, url string")
    rules = [Rule("allow", "x.ab", "/c/"), Rule("block", "x.ab", "/c/")]
    assert judge(pages, spark.createDataFrame([], "page_id long, bad boolean"), rules).first().verdict == "block"
