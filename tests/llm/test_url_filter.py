import random

import pytest

from stockroute.llm import queries, url_filter as uf


def brute(rules, host, path):
    hits = [(len(h + p), len(h), v == "block", h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(hits, default=None)


@pytest.mark.parametrize("seed", range(20))
def test_trie_equals_all_rules(seed):
    rng = random.Random(seed)
    hosts = ["a", "b.a", "c.b.a", "net", "a.net", "x.a.net", "aa"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/x", "/en//", "/e/n/", "//", "/é/"]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(rng.randint(0, 25))]
    trie = uf.build_trie(rules)
    for host in ["", ".", "z", "z.a", "net.", ".net", *hosts, *("w." + h for h in hosts)]:
        for path in [*paths, "/english", "/en/25", "x", "/e/n/m"]:
            assert uf.longest_match(trie, host, path) == brute(rules, host, path), (rules, host, path)


def test_rule_list_is_checked():
    for bad in (("deny", "a", "/"), ("allow", "", "/")):
        with pytest.raises(ValueError):
            uf.build_trie([bad])


def test_query_rows(spark, saved):
    urls = {
        1: ("https://Blog.Example.NET/en/a?q#f", "blog.example.net", "/en/a", "example.net/en/", "allow"),
        2: ("http://x.net/de", "x.net", "/de", "net/", "block"), 3: ("http://net", "net", "", None, "allow"),
        4: ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        5: ("http://example.com/d", "example.com", "/d", None, "allow"), 6: ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
        7: (None, "", "", None, "allow"), 8: ("", "", "", None, "allow"), 9: ("example.net/en/", "", "", None, "allow"),
        10: ("x://example.net?/en/", "example.net", "", None, "allow"), 11: ("a://b://net/", "b:", "//net/", None, "allow"),
        12: ("h://ÉX.net/\n/en/#", "Éx.net".replace("x", "x"), "/\n/en/", "net/", "block"),
        13: ("http://x.net/" + "a/" * 50000, "x.net", "/" + "a/" * 50000, "net/", "block"),
    }
    df = spark.createDataFrame([(i, v[0], "h") for i, v in urls.items()] + [(1, urls[1][0], "h")], "page_id long, url string, html string")
    got = queries.op1_url_filter(spark, saved(pages=df)).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:], r.page_id


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.net/", 5, True)], "page_id long, url string, rule int, host boolean")
    row = uf.url_filter(df, [("block", "net", "/")]).first()
    assert (row.rule, row.host, row.verdict, row.page_id) == ("net/", "a.net", "block", 1)
    assert uf.url_filter(df.limit(0), [], "block").count() == 0
