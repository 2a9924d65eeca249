import random
import re

from pyspark.sql import functions as F

from lexforge.llm import url_filter as U
from tests.llm.conftest import by_key


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)", url or "")
    fold = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    return (fold(m[1]), m[2], m[3]) if m else ("", "", "")


def pattern_fits(pattern, address):
    """By hand: every start, characters one by one."""
    fold = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    pattern, address = fold(pattern), fold(address)
    host = re.match(r"[^/?#]*", address)[0]
    starts = range(len(address) + 1)
    if pattern.startswith("||"):
        pattern, starts = pattern[2:], [0] + [i + 1 for i, c in enumerate(host) if c == "."]
    elif pattern.startswith("|"):
        pattern, starts = pattern[1:], [0]
    end = pattern.endswith("|") and len(pattern) > 0
    pattern = pattern[:-1] if end else pattern

    def at(p, i):
        if p == len(pattern):
            return not end or i == len(address)
        c = pattern[p]
        if c == "*":
            return any(at(p + 1, j) for j in range(i, len(address) + 1))
        if c == "^":
            return (i < len(address) and not re.match("[0-9a-z_.%-]", address[i]) and at(p + 1, i + 1)) or (i == len(address) and at(p + 1, i))
        return i < len(address) and address[i] == c and at(p + 1, i + 1)

    return address != "" and any(at(0, i) for i in starts)


def brute(url, hosts, patterns):
    host, path, rest = parts(url)
    fits = [((len(h + p), len(h), v == "block", h + p), v) for v, h, p in hosts if (host == h or host.endswith("." + h)) and path.startswith(p) and host + path]
    if fits:
        rank, verdict = max(fits)
        return host, path, rank[3], None, verdict
    fits = [((len(p), v == "block", p), v) for v, p in patterns if pattern_fits(p, host + path + rest)]
    if fits:
        rank, verdict = max(fits)
        return host, path, None, rank[2], verdict
    return host, path, None, None, "allow"


HOSTS = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "a.net", ""), ("block", "b-c.org", "/x.y"), ("allow", "b-c.org", "/x.y"), ("block", "org", "/long/way")]
PATTERNS = [("block", "||ads."), ("block", "track"), ("allow", "/track^"), ("block", "||a*b^"), ("block", "|x.org/q?id=1|"), ("block", "||x.y(1)+[2]$\\"), ("allow", "||Ads.Good."), ("block", "*/a/*/b/"), ("block", "||"), ("block", "id=7|")]
URLS = [
    None, "", "no scheme.com/en/", "http://", "http:///en/", "HTTP://WWW.Example.COM/en/1", "https://example.com/en/", "https://example.com/EN/", "https://badexample.com/en/", "x://m.example.com/en/a?b#c", "x://example.com",
    "x://example.com?/en/", "x://example.com#/en/", "a://b://www.example.com/en/", "http://net/es/", "http://x.net/fr", "http://a.net", "http://q.a.net:80/", "http://q.a.net?x", "http://b-c.org/x.y", "http://b-c.org/xzy", "http://u.org/long/way",
    "http://ads.u.org/", "http://bads.u.org/track/", "http://u.org/Track", "http://u.org/a/1/b/", "http://ads.good.org/q", "http://x.org/q?id=1", "http://x.org/q?id=12", "http://ab.org", "http://a-b/", "http://u.org/?id=7", "http://é.org/\n/track\n", "http://x.y(1)+[2]$\\/", "ftp://İ.ADS.org/x",
]


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    bits = ["com", "net", "org", "www", "example", "en", "es", "a", "b", "ads", "track", "x", "y"]
    urls = URLS + [f"http{rnd.choice(['', 's'])}://" + ".".join(rnd.choices(bits, k=rnd.randrange(1, 4))) + rnd.choice(["", "/", "?", "#"]) + "/".join(rnd.choices(bits, k=rnd.randrange(4))) + rnd.choice(["", "/", "?id=7", "#x"]) for _ in range(800)]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, rank string").repartition(5)
    for limit in ("10485760", "-1"):  # the index is broadcast, or met by a shuffle
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            index = U.build_index(U.rules_of(spark, HOSTS, PATTERNS), pages)
            got = {r.page_id: (r.host_, r.path, r.rule, r.pattern, r.verdict) for r in U.judge(pages, index).collect() if (r.host, r["rank"]) == ("clash", "clash")}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == {i: brute(u, HOSTS, PATTERNS) for i, u in enumerate(urls)}


def test_rules_stand_under_their_rarest_fixed_token(spark):
    pages = spark.createDataFrame([(u,) for u in ["http://www.example.com/en/"] * 3 + ["http://example.com/"] * 2 + ["http://x.com/en/", None]], "url string")
    rules = U.rules_of(spark, [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "example.com", "/en"), ("block", "never.com", "/")], [("block", "track"), ("block", "||ads*xyz^")])
    index = {r["rank"].rule: r.token for r in U.build_index(rules, pages).collect()}
    assert index == {"com/": "com", "example.com/en/": "en", "example.com/en": "example", "never.com/": "never", "track": "", "||ads*xyz^": ""}


def test_edge_rows(spark):
    rules = U.rules_of(spark, [("allow", "com", "/"), (None, "x", "/"), ("block", None, "/"), ("block", "net", None), ("allow", "com", "/")], [("block", None), ("maybe", "x")])
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(none, U.build_index(rules, none)).count() == 0 and U.build_index(rules, none).count() == 1
    rows = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, "http://a.com/"), (2, None), (2, "http://b.org/")], "page_id long, url string")
    got = by_key(U.judge(rows, U.build_index(rules, rows)), "page_id", "rule", "verdict")
    assert got == by_key(spark.createDataFrame([(1, "com/", "allow")] * 2 + [(None, "com/", "allow"), (2, None, "allow"), (2, None, "allow")], "page_id long, rule string, verdict string"))
    nothing = U.rules_of(spark)
    assert {r.verdict for r in U.judge(rows, U.build_index(nothing, rows), otherwise="block").collect()} == {"block"}
    long = spark.createDataFrame([(1, "http://a.net/" + "x/" * 400_000 + "end/")], "page_id long, url string")
    index = U.build_index(U.rules_of(spark, [], [("block", "/end/|")]), long)
    assert U.judge(long, index).first().verdict == "block"


def test_native(spark):
    pages = spark.createDataFrame([("http://a.com/",)], "url string")
    plan = U.judge(pages, U.build_index(U.rules_of(spark, HOSTS, PATTERNS), pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and F is not None
