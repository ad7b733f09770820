import random

from segmark.llm.url_filter import filter_urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("a.net", "/es/x", "allow"), ("net", None, "block"), (None, "/", "block"), ("tie.org", "/", "allow"), ("tie.org", "/", "block")]


def brute(url, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for h, p, v in RULES:
        p = p or ""
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), len(h), v == "block")
            if best is None or key > best[0]:
                best = (key, h + p, v)
    return (host, path, best[1] if best else None, best[2] if best else default)


def test_rules_equal_brute_force(spark):
    rng = random.Random(4)
    hosts = ["example.com", "www.example.com", "WWW.Example.com", "a.b.www.example.com", "x.net", "a.net", "q.a.net", "net", "tie.org",
             "badexample.com", "example.com:80", "", "a..com", ".", "org"]
    paths = ["", "/", "/en/", "/en", "/en/1/2", "/es/", "/es/x", "/es/xy/z", "?q=/en/", "#/en/", "/en/?x#y", "//en/", "/ES/"]
    urls = [f"{s}://{rng.choice(hosts)}{rng.choice(paths)}" for s in ("http", "https", "x") for _ in range(120)]
    urls += [None, "", "no scheme", "://", "http://", "http://a.com/://b.net/es/", "http://x.net" + "/d" * 3000 + "/"] + ["http://x.net/es/1"] * 30
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, RULE string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = filter_urls(df, rules).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id]), urls[r.page_id]


def test_empty_tables_and_no_rules(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.com/"), (1, None)], "page_id long, url string")
    assert {(r.host, r.rule, r.verdict) for r in filter_urls(df, rules, default="block").collect()} == {("a.com", None, "block"), ("", None, "block")}
    some = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert filter_urls(df.limit(0), some).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string").repartition(2)
    plan = filter_urls(df, spark.createDataFrame(RULES, "host string, path string, verdict string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan
