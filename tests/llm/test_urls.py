from sampleflow.llm.queries import URL_RULES
from sampleflow.llm.urls import Rule, url_verdicts


def plain(url):
    """Host, path and rule, said in Python."""
    if not url or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best


URLS = [
    None, "", "no scheme/a", "http://", "http:///x", "https://A.Example.NET/en/1", "http://example.net/EN/1", "http://net", "http://net/",
    "http://xnet/", "http://a.net?x=/y", "http://b.example.com/de/5.html#top", "http://example.com/de", "http://example.com/de/",
    "http://b.org/fr/é/x", "http://b.org:80/fr/", "ftp://É.example.org/fr/a//b", "x://y://z/?q", "http://a.org/fr\n/x", "http://a.net/en/" + "a" * 5000,
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(URLS)] + [(None, URLS[5], "h", "t")], "page_id long, url string, host string, template string")
    got = url_verdicts(pages, URL_RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule = plain(URLS[r.page_id] if r.page_id is not None else URLS[5])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name)
        assert r.verdict == (rule.verdict if rule else "allow")
    assert url_verdicts(pages.where("false"), URL_RULES).collect() == []


def verdicts(spark, urls, rules, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: r for r in url_verdicts(pages, rules, **options).collect()}


def test_templates(spark):
    rules = (Rule("h", "/ads/x", "block"), Rule("h", "/news/2", "allow"))
    urls = [f"http://h/ads/x{i}/7" for i in range(30)] + [f"http://h/ads/y{i}/8" for i in range(30)]
    urls += [f"http://h/news/{i}.html" for i in range(40)] + ["http://h/about", "http://h/1/2/3/4/5/6", "http://other/ads/y1/8"]
    got = verdicts(spark, urls, rules)
    # No segment below /ads has six labels: one template, whose labels are all bad.
    assert {got[i].template for i in range(60)} == {"/ads/*/*"}
    assert {got[i].verdict for i in range(60)} == {"block"} and got[35].rule is None
    assert {got[i].template for i in range(60, 100)} == {"/news/*"} and got[61].verdict == "allow"
    assert [got[i].verdict for i in range(100, 103)] == ["allow"] * 3
    assert got[101].template == "/*" * 6 and (got[101].branch, got[101].evidence) == ("", 41)
    assert (got[102].purity, got[102].evidence) == (0.5, 0)


def test_similar_branches_merge(spark):
    rules = (Rule("h", "/a/bad", "block"), Rule("h", "/b/bad", "block"), Rule("h", "/c/", "allow"))
    urls = [f"http://h/{d}/bad/{i}" for d in "ab" for i in range(6)] + [f"http://h/c/ok/{i}" for i in range(9)]
    got = verdicts(spark, urls, rules).values()
    assert {(r.branch, r.evidence) for r in got if "bad" in r.path} == {("/a/bad/*", 12)}
    assert {round(r.purity, 3) for r in got if "bad" in r.path} == {round(14 / 16, 3)}
    assert {r.branch for r in got if "ok" in r.path} == {"/c/ok/*"}


def test_any_depth(spark):
    rules = (Rule("h", "/u", "block"),)
    deep = "/".join(["u"] * 5)
    urls = [f"http://h/{deep}/spam/{i}" for i in range(8)] + [f"http://h/v/{deep}/spam/1"] + ["http://h/" + "w/" * 3000]
    got = verdicts(spark, urls, rules)
    assert {got[i].template for i in range(8)} == {f"/{deep}/spam/*"} and {got[i].branch for i in (8, 9)} == {""}
    assert got[9].template == "/*" * 3000


def test_labels_reach_what_has_none(spark):
    rules = (Rule("farm", "/a", "block"), Rule("fine", "/a", "allow"), Rule("both", "/a/x", "block"), Rule("both", "/b", "allow"))
    urls = [f"http://{h}/a/{i}" for h in ("farm", "fine") for i in range(20)] + ["http://farm/new/1", "http://fine/new/1", "http://both/new/1"]
    urls += [f"http://both/a/x/{i}" for i in range(12)] + [f"http://both/b/{i}" for i in range(12)] + ["http://both/a/y/1", "http://both/b.html"]
    got = {r.path if r.host == "both" else r.host + r.path: r for r in verdicts(spark, urls, rules).values()}
    assert (got["farm/new/1"].verdict, got["farm/new/1"].branch) == ("block", "")
    assert got["fine/new/1"].verdict == "allow" and got["fine/new/1"].purity < 0.2
    # The nearest node with labels speaks: /a on the one side, the host on the other.
    assert (got["/a/y/1"].verdict, got["/a/y/1"].branch) == ("block", "/a")
    assert (got["/new/1"].verdict, got["/new/1"].branch) == ("allow", "") and got["/new/1"].evidence == 25


def test_more_clean_pages_block_nothing(spark):
    rules = (Rule("h", "/de/", "block"), Rule("h", "/x", "block"), Rule("h", "/en/", "allow"))
    base = [f"http://h/de/{i}" for i in range(8)] + [f"http://h/x{i}/{j}" for i in range(5) for j in range(5)]
    base += [f"http://h/en/{i}" for i in range(100)] + [f"http://h/clean{i}/1" for i in range(15)]
    before = verdicts(spark, base, rules)
    for more in (1, 300):
        after = verdicts(spark, base + [f"http://h/more{i}/1" for i in range(more)], rules)
        for i, r in before.items():
            assert after[i].template == r.template
            assert r.verdict == "block" or after[i].verdict == "allow"
    only = [f"http://h/de/{i}" for i in range(8)]
    for clean in (20, 60):
        got = verdicts(spark, only + [f"http://h/section{i}/1" for i in range(clean)], rules)
        assert {got[i].verdict for i in range(8, 8 + clean)} == {"allow"}


def test_repeated_rows_and_ties(spark):
    rules = (Rule("h", "/a", "block"), Rule("h", "/b", "allow"))
    urls = ["http://h/a/1"] * 7 + ["http://h/b/1"] * 7 + ["http://h/c"] * 3 + [None] * 2
    got = verdicts(spark, urls, rules)
    assert len(got) == 19 and {got[i].purity for i in (14, 15, 16)} == {0.5} and {got[i].verdict for i in (14, 17, 18)} == {"allow"}
    assert {got[i].branch for i in range(7)} == {"/a/*"} and {got[i].branch for i in range(7, 14)} == {"/b/*"}
