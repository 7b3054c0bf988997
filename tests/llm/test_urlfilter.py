import re
from collections import Counter
from itertools import combinations

import pytest

from bizops.llm import urlfilter
from bizops.llm.queries import QUERIES
from bizops.llm.urlfilter import ALLOW, BLOCK, Rule

CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host + r.path), r.host + r.path, r.verdict), default=None)


def plain_tokens(url):
    host, path = plain_parts(url)
    text = url or ""
    before, _, fragment = text.partition("#")
    query = before.partition("?")[2]
    found = ["h:" + w for w in host.split(".") if w]
    for mark, part in (("p:", path), ("q:", query), ("f:", fragment)):
        found += [mark + w for w in re.split(CUT, lower(part)) if w]
    return set(found)


def plain_verdicts(urls, rules=urlfilter.RULES, support=0.02, confidence=0.8, width=12):
    """Every combination of tokens of every judged URL is counted."""
    parts = [plain_parts(u) for u in urls]
    given = [plain_rule(h, p, rules) for h, p in parts]
    tokens = [plain_tokens(u) for u in urls]
    rows = [(t, g.verdict) for t, g in zip(tokens, given) if g and t]
    n = len(rows)
    seen = Counter(t for ts, _ in rows for t in ts)
    frequent = {t for t, c in seen.items() if c >= support * n}
    assert all(len(ts & frequent) <= width for ts, _ in rows), "this check has no bound of its own"
    whole, good = Counter(), Counter()
    for ts, verdict in rows:
        held = sorted(ts & frequent)
        for size in range(1, len(held) + 1):
            for combo in combinations(held, size):
                whole[combo] += 1
                good[combo, verdict] += 1
    mined = {k: good[k] / whole[k[0]] for k in good if good[k] >= support * n and good[k] / whole[k[0]] >= confidence}
    kept = {
        (a, v): c for (a, v), c in mined.items()
        if not any(mined.get((a[:i] + a[i + 1:], v), -1) >= c for i in range(len(a)) if len(a) > 1)
    }
    out = []
    for (host, path), g, ts in zip(parts, given, tokens):
        if g:
            out.append((host, path, g.host + g.path, g.verdict))
            continue
        fits = [(c, good[k] / n, len(k[0]), k[1], list(k[0])) for k, c in kept.items() if set(k[0]) <= ts]
        out.append((host, path, None, max(fits)[3] if fits else ALLOW))
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_counting_every_combination(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    want = {p["page_id"]: row for p, row in zip(pages, plain_verdicts([p["url"] for p in pages]))}
    got = QUERIES["op13_url_filter"](spark, folder).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert len({r["verdict"] for r in got}) == 2 and len({r["rule"] for r in got}) >= 5


URLS = [
    None, "", "no scheme/at all", "http://", "://ORG/", "HTTPS://Sub.Example.ORG/es/1?x=://y", "http://example.org/en/1#top",
    "http://notexample.org/en/1", "http://org", "http://org/", "ftp://a.b.com/de/9", "http://com/fr/", "http://a.com/fr",
    "http://é.com/de/ü?q=1", "http://a.net/es/2", "http://a..org/es/", "http://x.org?/es/", "http://u:p@ex.com:80/de/" + "w/" * 5000,
]


def test_urls_of_every_shape(spark, scratch):
    schema = "page_id bigint, url string, host string, path string, rule string, verdict string, _url string, key bigint"
    pages = spark.createDataFrame([(i, u, "x", "x", "x", "x", "x", 1) for i, u in enumerate(URLS * 2)] + [(None, URLS[5], *"xxxxx", 1)], schema)
    got = urlfilter.judge(pages.repartition(3), scratch, support=0.2).collect()
    want = plain_verdicts(URLS * 2 + [URLS[5]], support=0.2)
    rows = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got]
    assert sorted(rows, key=repr) == sorted([(i, *w) for i, w in zip([*range(2 * len(URLS)), None], want)], key=repr)
    assert urlfilter.judge(pages.where("false"), scratch).count() == 0


def test_without_rules_or_examples(spark, scratch):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id bigint, url string")
    assert {r["verdict"] for r in urlfilter.judge(pages, scratch, rules=(), default=BLOCK).collect()} == {BLOCK}
    assert {r["verdict"] for r in urlfilter.judge(pages, scratch).collect()} == {ALLOW}


def test_a_hot_group_of_long_urls_does_not_multiply_combinations(spark, scratch):
    """A third of all rows share one URL of 60 words: 2^60 combinations if nothing bounded them."""
    long = "http://hot.org/" + "/".join(f"w{i}" for i in range(60))
    rows = [long] * 200 + [f"http://s{i % 9}.com/{'de' if i % 2 else 'fr'}/{i}" for i in range(400)] + ["http://n.net/de/1"] * 3
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    got = urlfilter.judge(pages, scratch).collect()
    assert len(got) == len(rows) and {r["verdict"] for r in got if r["host"] == "n.net"} == {BLOCK}


def test_longest_rule_wins_and_many_rules(spark, scratch):
    rules = [Rule(BLOCK, f"h{i}.org", "/a/") for i in range(300)] + [Rule(ALLOW, "h7.org", "/a/b"), Rule(BLOCK, "org", "/a/b/c/d/e/f/g")]
    urls = ["http://h7.org/a/x", "http://z.h7.org/a/bc", "http://h7.org/a/b/c/d/e/f/g/h", "http://h299.org/a/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: r["rule"] for r in urlfilter.judge(pages, scratch, rules).collect()}
    assert got == {0: "h7.org/a/", 1: "h7.org/a/b", 2: "org/a/b/c/d/e/f/g", 3: "h299.org/a/"}


def test_all_frequent_tokens_of_long_urls_are_combined(spark, scratch):
    """Only x and y together mean block, beside 14 tokens that tell more; long URLs that each lack another word share
    37 tokens."""
    more = [f"m{i}" for i in range(14)]
    rows = [("com/de" if x and y else "com/fr", [*(["x"] if x else []), *(["y"] if y else []), *more[x + y:]]) for x in (0, 1) for y in (0, 1) for _ in range(20)]
    rows += [("com/fr", more[:k]) for k in range(14) for _ in range(5)]
    urls = [f"http://{rule}/{'/'.join(words)}" for rule, words in rows] + ["http://a.net/x/y", "http://a.net/x", "http://a.net/y", "http://a.net/m3"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, scratch).collect()}
    assert got == dict(enumerate(plain_verdicts(urls, width=18)))
    assert [got[len(rows) + i][3] for i in range(4)] == [BLOCK, ALLOW, ALLOW, ALLOW]

    words = [f"w{i}" for i in range(40)]
    rows = [f"http://{rule}/{'/'.join(words[:i] + words[i + 1:])}" for i in range(3) for rule in ("com/fr", "com/de") for _ in range(9)]
    pages = spark.createDataFrame(list(enumerate([*rows, "http://a.net/w1"])), "page_id bigint, url string")
    assert urlfilter.judge(pages, scratch).count() == 55
