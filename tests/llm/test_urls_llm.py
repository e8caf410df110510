import re

from lakerill.llm import urls
from lakerill.llm.suite_llm import URL_RULES

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :], re.S).group()


def plain_rule(host, path):
    fits = []
    for rule, verdict in URL_RULES:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else None


AWKWARD = [
    None, "", "no host", "http://", "http://NET/", "http://a.net", "http://a.net/x", "http://planet/", "HTTP://Ä.NET/Ä?q#f",
    "http://example.net/en/1", "http://x.EXAMPLE.net/en", "http://www.example.com/de/?x", "ftp://a.org/fr/#x", "a://b://c.net/d",
    "http://h?x=/net/", "http://h#/net/", "http://free-bets.example.org/", "http://e.net/\n", "http://" + "a" * 50_000 + ".net/" + "b/" * 50_000,
]


def test_hosts_paths_and_rules(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    rows = pages + [(-i, u) for i, u in enumerate(AWKWARD)] + [(None, "http://a.net/")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as score")
    got = urls.judge(df, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = plain(r.url)
        rule = plain_rule(host, path)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule and rule[0])
        assert r.verdict == (rule[1] if rule else "block" if r.score >= 0.5 else "allow")
    assert urls.judge(df.limit(0), URL_RULES).collect() == []


BAD = re.compile("casino|pills|bets|spam|adult|ads-")


def score(url, weights):
    at = sorted(urls.grams(*urls._parts(url)))
    return weights[at].sum() / len(at) ** 0.5 + weights[-1]


def test_the_classifier_tells_hosts_apart_that_it_has_not_seen(spark):
    rows = urls.judge(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), ()).select("host", "verdict").distinct().collect()
    known = {n for n, _ in urls.labelled_names()}
    assert not {part for r in rows for part in r.host.split(".")} & known  # none of these hosts is in the labelled table
    assert {r.verdict for r in rows if BAD.search(r.host)} == {"block"}
    assert {r.verdict for r in rows if not BAD.search(r.host)} == {"allow"}


def test_unseen_combinations_of_known_words():
    known, weights = {n for n, _ in urls.labelled_names()}, urls.train(urls.labelled_urls())
    names = [n for a in urls.UNWANTED for b in urls.JOINED for n in (f"{a}-{b}", f"{b}-{a}", f"{b}{a}") if n not in known]
    assert sum(score(f"https://{n}.example.com/en/12", weights) >= 0 for n in names) > 0.9 * len(names)


def test_words_that_nobody_knows_are_allowed():
    # every third word of either kind is kept from training: unknown words are let through, known ordinary ones too
    names = urls.labelled_names()
    held = {w for words in (urls.UNWANTED, urls.WANTED) for i, w in enumerate(words) if i % 3 == 0}
    taught = [(n, label) for n, label in names if not any(w in n for w in held)]
    weights = urls.train(urls.labelled_urls(taught))
    kept = [n for n, label in names if not label and (n, label) not in taught]
    assert sum(score(f"http://www.{n}.example.org/en/55", weights) < 0 for n in kept) > 0.97 * len(kept)
