import random
import re

from pairrank.llm import url_rules as U


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, v in rules:
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            best = max(best or (), (len(h) + len(p or ""), len(h), v, h + (p or ""))) or None
    return host, path, best and best[3], best[2] if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, U.rules_table(spark, rules)).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), (u, got[i])


def test_rules_against_brute_force(spark):
    rnd = random.Random(6)
    label, paths = ["a", "b", "net", "org", "example", "Ex-ample", "", "é"], ["", "/", "/en/", "/en/x", "/e", "/fr/?q", "/de/#t", "//"]
    def host():
        return ".".join(rnd.choice(label) for _ in range(rnd.randrange(1, 5)))
    urls = [rnd.choice(["http://", "https://", "", "x://y://"]) + host() + rnd.choice(paths) for _ in range(400)]
    urls += [None, "", "://", "http://", "no scheme", "http://NET", "http://net/", "http://xnet/", "http://a.net:80/en/"] * 2
    many = [(host().lower(), rnd.choice(["", "/", "/en/", "/e"]), rnd.choice(["allow", "block"])) for _ in range(40)]
    check(spark, urls, U.RULES)
    check(spark, urls, many + [(None, "/", "block")])


def test_empty_tables(spark):
    check(spark, [], U.RULES)
    check(spark, ["http://a.net/x"], [])


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = U.judge_urls(pages, U.rules_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
