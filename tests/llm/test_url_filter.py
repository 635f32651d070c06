import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle
from downfold.llm import queries, url_filter
from downfold.llm.queries import URL_RULES

KINDS = {"allow": "a", "block": "b"}


def pages(spark, urls, extra=False):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for name in ("row", "rule", "host", "piece", "a", "bin", "n", "copy", "ruled", "verdict", "score") if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def ruled(url):
    url = url or ""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")
    fits = []
    for verdict, rule in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def brute(urls):
    """[(host, path, rule, verdict)], with the models as plain dictionaries."""
    known = [ruled(u) for u in urls]
    held = [int(hashlib.md5((u or "").encode()).hexdigest()[:8], 16) % 5 == 0 for u in urls]
    signs = ["\2" * 4 + re.sub("[1-9]", "0", u or "") + "\3" for u in urls]
    counts = {"a": Counter(), "b": Counter()}
    for text, (*_, verdict), out in zip(signs, known, held):
        if verdict and not out:
            for i in range(4, len(text)):
                for order in range(5):
                    counts[KINDS[verdict]][text[i - order : i + 1]] += 1
    after = {k: {} for k in counts}
    for k, held_counts in counts.items():
        for piece, n in held_counts.items():
            total, kinds = after[k].get(piece[:-1], (0, 0))
            after[k][piece[:-1]] = (total + n, kinds + 1)

    def chance(k, piece):
        less = chance(k, piece[1:]) if len(piece) > 1 else 1 / 256
        total, kinds = after[k].get(piece[:-1], (0, 0))
        return (counts[k][piece] + kinds * less) / (total + kinds) if total else less

    ratio = lambda p: math.floor((math.log(chance("a", p)) - math.log(chance("b", p))) * 2**20 + 0.5)
    bins = []
    for text in signs:
        total, n = sum(ratio(text[i - 4 : i + 1]) for i in range(4, len(text))), len(text) - 4
        bins.append(max(-2000, min(2000, math.floor(total * 100.0 / (n * 2.0**20)))))
    examples = [(b, v) for b, (*_, v), out in zip(bins, known, held) if v and out]
    good, bad = (sum(v == kind for _, v in examples) for kind in ("allow", "block"))
    cuts = sorted({b for b, _ in examples}) if good and bad else []
    right = lambda c: sum(v == "allow" and b >= c for b, v in examples) * bad + sum(v == "block" and b < c for b, v in examples) * good
    least = min(cuts, key=lambda c: (-right(c), abs(c), c), default=0)
    least -= (least - max((c for c in cuts if c < least), default=least)) // 2
    return [(h, p, r, v or ("allow" if b >= least else "block")) for (h, p, r, v), b in zip(known, bins)]


def got(spark, urls, extra=False):
    rows = url_filter.judge(pages(spark, urls, extra), URL_RULES).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


ODD = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://A.COM/En/", "http://xcom/", "http://.com/",
    "http://www.example.com/en/1", "http://m.www.example.com/en/", "http://example.com/en/5", "http://example.com/en",
    "http://b.example.com/fr/?x=/en/", "http://a.net/es/1", "http://a.net/fr/#a://b", "http://a.net/de/", "a://b://c.com/d",
    "http://a.com?x=1", "http://a.com#x", "http://ex.org/en/\n2", "http://ü.net/es/é", "http://ex.net/es/😀😀", "\2\2\3", "x" * 300,
    "http://a.com/en/1", "http://a.com/en/1", "http://İ.com/", "http://a.com:80/",
]


def test_odd_urls_equal_brute_force(spark):
    assert got(spark, ODD, extra=True) == brute(ODD)


@pytest.mark.parametrize("urls", [["http://a.org/"], ["http://a.com/1", "http://b.org/2"], ["http://a.net/es/1", None]])
def test_without_examples_of_both_kinds(spark, urls):
    assert got(spark, urls) == brute(urls)


def test_empty_table(spark):
    assert url_filter.judge(pages(spark, []), URL_RULES).collect() == []


def test_unruled_urls_follow_their_likeness(spark):
    urls = [f"http://shop{i}.com/fine/page{i}" for i in range(300)] + [f"http://pills{i}.net/es/buy-cheap-{i}" for i in range(300)]
    asked = ["http://shop.org/fine/page", "http://pills.org/es/buy-cheap-now"]
    found = got(spark, urls + asked)
    assert found == brute(urls + asked)
    assert [v for *_, v in found[-2:]] == ["allow", "block"]


def test_very_long_url_and_repeats(spark):
    urls = ["http://a.org/" + "ab" * 100_000, *["http://a.com/x/y"] * 50, *["http://a.net/es/y"] * 50]
    assert got(spark, urls)[0][:3] == ("a.org", "/" + "ab" * 100_000, None)


def test_nothing_is_broadcast(spark, monkeypatch):
    plans = {}

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return df

    write, least = url_filter.written, url_filter.least_allowed
    monkeypatch.setattr(url_filter, "written", lambda df, name: write(planned(df, name), name))
    monkeypatch.setattr(url_filter, "least_allowed", lambda df: least(planned(df, "examples")))
    planned(url_filter.judge(pages(spark, ODD * 20), URL_RULES), "judged")
    joins = {name: plan.count("SortMergeJoin") for name, plan in plans.items()}
    assert joins == {"urls": 0, "pieces": 0, "scores": url_filter.ORDER + 1, "examples": 1, "judged": 1}
    assert [name for name, plan in plans.items() if "Broadcast" in plan] == []


def test_null_keys_and_rules_of_callers(spark):
    df = spark.createDataFrame([(None, "http://a.b.c/d"), (1, "http://b.c/de")], "k string, u string")
    rules = [("block", "b.c/"), ("allow", "b.c/de")]
    found = {r.k: (r.rule, r.verdict) for r in url_filter.judge(df, rules, url="u", key="k").collect()}
    assert found == {None: ("b.c/", "block"), "1": ("b.c/de", "allow")}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    df = queries.op12_url_models(spark, sf_dir)
    assert oracle.differences(df, oracle.connect(sf_dir), queries.OP12_SQL) == ""
