import pytest
from pyspark.sql import functions as F

from fieldlake.llm.url_filter import RULES, Rule, filter_urls


def pages(spark, urls):
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return rows.withColumn("host", F.lit("x")).withColumn("shape", F.lit(1)).withColumn("rows", F.lit(1))


def expected(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([k for k in (path.find(c) for c in "?#") if k >= 0], default=len(path))]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best


URLS = [
    "http://a.example.com/en/1", "http://www.example.com/en/2", "https://WWW.Example.COM/en/", "http://com/", "http://com",
    "http://notcom.org/en/3", "http://x.net/es/4?q=/fr/", "http://x.net/fr#es", "http://x.net/de/5", "http://net/fr/",
    "//no.scheme/x", "", None, "http://", "http:///en/", "http://h?x", "http://h#/es/", "a://b://c/d", "http://x.net/fr/é ü",
    "http://x.example.com/en", "http://İ.com/", "http://x.net/" + "a/" * 3000, "http://a.b.www.example.com/en/z", "http://x.net/es/4?q=/fr/",
]


def test_rules(spark):
    got = {r.page_id: r for r in filter_urls(pages(spark, URLS)).collect()}
    assert len(got) == len(URLS)
    for n, url in enumerate(URLS):
        host, path, rule = expected(url)
        r = got[n]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), url
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")


def test_templates_follow_their_labels(spark):
    rules = (Rule("block", "bad.org", "/spam/1"), Rule("allow", "bad.org", "/news/1"), Rule("allow", "good.org", "/"))
    urls = [f"http://bad.org/spam/1{n}" for n in range(60)] + [f"http://bad.org/news/1{n}" for n in range(60)]
    urls += ["http://bad.org/spam/25", "http://bad.org/news/26", "http://new.org/spam/7", "http://new.org/news/7"]
    got = {r.page_id: r.verdict for r in filter_urls(pages(spark, urls), rules).collect()}
    assert [got[n] for n in range(120, 124)] == ["block", "allow", "block", "allow"]


def test_many_rare_children_become_a_wildcard(spark):
    urls = [f"http://h.org/{chr(97 + n % 26)}{chr(97 + n // 26)}/x" for n in range(200)] + ["http://h.org/ab/x"] * 30
    found = {r.template for r in filter_urls(pages(spark, urls)).select("template").collect()}
    assert found == {"*/x"}


def test_branches_below_the_fourth_segment_are_told_apart(spark):
    rules = (Rule("block", "h.org", "/a/b/c/d/spam/1"), Rule("allow", "h.org", "/a/b/c/d/news/1"))
    urls = [f"http://h.org/a/b/c/d/{kind}/1{n}" for kind in ("spam", "news") for n in range(60)]
    urls += ["http://h.org/a/b/c/d/spam/25", "http://h.org/a/b/c/d/news/26"]
    got = {r.page_id: (r.verdict, r.template) for r in filter_urls(pages(spark, urls), rules).collect()}
    assert got[120] == ("block", "/a/b/c/d/spam/{n}") and got[121] == ("allow", "/a/b/c/d/news/{n}")


def test_templates_do_not_depend_on_how_often_pages_come(spark):
    urls = [f"http://h.org/{chr(97 + n % 26)}{chr(97 + n // 26)}/x" for n in range(200)] + ["http://h.org/ab"]
    urls += [f"http://h.org/p/{chr(97 + n % 3)}/y/z" for n in range(9)] + ["http://k.org/p/q", "http://k.org"]
    once, often = filter_urls(pages(spark, urls)), filter_urls(pages(spark, urls * 10))
    assert {(r.path, r.template) for r in once.collect()} == {(r.path, r.template) for r in often.collect()}


def test_name_of_a_merged_branch_is_short(spark):
    rules = (Rule("block", "h.org", "/"),)
    urls = [f"http://h.org/{'x' * 50}{chr(97 + n)}/{k}" for n in range(18) for k in "ab"]
    found = {r.template for r in filter_urls(pages(spark, urls), rules).select("template").collect()}
    assert len(found) == 1 and len(found.pop()) < 150


def brute_purity(labels):
    """Blocked share of a template without another host's, smoothed towards all labels."""
    base = (sum(labels) + 1) / (len(labels) + 2)
    smoothed = lambda own, wider: (sum(own) + 4 * wider) / (len(own) + 4)
    return lambda own: smoothed(own, smoothed(own, base))


@pytest.mark.parametrize("sections", [3, 40, 60, 300])
def test_verdicts_do_not_depend_on_the_number_of_sections(spark, sections):
    name = lambda n: f"s{chr(97 + n // 26)}{chr(97 + n % 26)}"
    rules = (Rule("block", "h.org", "/saa/1"), Rule("allow", "h.org", "/sab/1"), Rule("block", "g.org", "/sac/1"))
    urls = [f"http://h.org/{name(n)}/{k}" for n in range(sections) for k in range(100, 120)]
    urls += [f"http://h.org/{name(n)}/5" for n in range(3)] + [f"http://g.org/sac/1{k}" for k in range(20)]
    urls += ["http://g.org/sac/5", "http://g.org/sad/5"]
    found = {r.path if "h.org" in r.host else r.host + r.path: r for r in filter_urls(pages(spark, urls), rules).collect()}
    got = {key: found[key].verdict for key in ("/saa/5", "/sab/5", "/sac/5", "g.org/sac/5", "g.org/sad/5")}
    assert got == {"/saa/5": "block", "/sab/5": "allow", "/sac/5": "block", "g.org/sac/5": "block", "g.org/sad/5": "block"}
    purity = brute_purity([1] * 20 + [0] * 20 + [1] * 20)
    assert found["/saa/5"].purity == pytest.approx(purity([1] * 20), abs=1e-9)
    assert found["/sab/5"].purity == pytest.approx(purity([0] * 20), abs=1e-9)
    assert found["g.org/sad/5"].purity == pytest.approx(purity([]), abs=1e-9)


def test_empty_table(spark):
    assert filter_urls(pages(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op7_chat_formatting", "op10_url_filters"])
def test_native_plans(spark, sf_dir, plan_of, name):
    from fieldlake.llm.queries import QUERIES

    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
