import random

from tablelab.llm import urls

CLASH = "page_id long, url string, host string, _path string, judged int, verdict string"


def plain(url, rules, default="allow"):
    """(host, path, rule, verdict) by trying every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h), len(p), v, h + p) for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, default)


def test_against_every_rule(spark):
    rng = random.Random(1)
    labels, parts = ["a", "b", "com", "net", "x"], ["/", "/en", "/en/", "/e", "/fr/1", ""]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for _ in range(60) for h in [".".join(rng.choices(labels, k=rng.randint(1, 4)))] for p in [rng.choice(parts)]}.values())
    found = [f"http{rng.choice(['', 's'])}://{'.'.join(rng.choices(labels + ['COM'], k=rng.randint(1, 6)))}{rng.choice(parts)}{rng.choice(['', 'q', '?x=/en/', '#/en/'])}" for _ in range(800)]
    found += [None, "", "no url", "://", "https://", "mailto:a@b", "http://com", "http://com?x", "http://a.com:80/", "http://.com/", "http://com./", "http://xcom/", "a://b://com/", "http://x.com/\nen", "http://" + "a." * 3000 + "com/" + "e" * 5000]
    rows = [(k, u) for k, u in enumerate(found)] + [(0, found[0])] * 3
    df = spark.createDataFrame([(k, u, "h", "p", 1, "v") for k, u in rows], CLASH)
    out = urls.filter_urls(df, urls.rules_table(spark, rules))
    assert out.columns == [*df.columns, "_judged"]
    got = sorted((r["page_id"], *r["_judged"]) for r in out.collect())
    want = sorted((k, *plain(u, rules)) for k, u in rows)
    assert list(map(repr, got)) == list(map(repr, want))


def test_shared_prefix_is_confirmed_by_the_whole_digest(spark, monkeypatch):
    monkeypatch.setattr(urls, "PREFIX_BYTES", 0)  # every expression meets every rule
    rules = [("block", f"h{k}.net", "/") for k in range(20)]
    df = spark.createDataFrame([(k, f"http://s.h{k}.net/p") for k in range(40)], "page_id long, url string")
    got = {r["page_id"]: r["judged"]["rule"] for r in urls.filter_urls(df, urls.rules_table(spark, rules)).collect()}
    assert got == {k: f"h{k}.net/" if k < 20 else None for k in range(40)}


def test_rules_that_say_two_things_and_empty_tables(spark):
    rules = [("allow", "a.com", "/"), ("block", "a.com", "/"), (None, "b.com", "/"), ("block", None, "/"), ("block", "c.com", None), ("block", "d.com/x", "/"), ("block", "E.com", "")]
    df = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.com/"), (3, "http://c.com/"), (4, "http://e.com")], "page_id long, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {r["page_id"]: r["judged"]["verdict"] for r in urls.filter_urls(df, table).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    assert urls.filter_urls(df.limit(0), table).count() == 0
    none = urls.filter_urls(df, table.limit(0), default="block").collect()
    assert {r["judged"]["verdict"] for r in none} == {"block"} and len(none) == 4


def test_one_url_for_most_rows(spark):
    df = spark.range(20_000).selectExpr("id as page_id", "if(id % 3 = 0, concat('http://n', id, '.net/es/'), 'https://www.example.com/en/') as url")
    out = urls.filter_urls(df, urls.rules_table(spark, urls.EXAMPLE_RULES)).groupBy("judged.rule", "judged.verdict").count().collect()
    assert {tuple(r) for r in out} == {("net/es/", "block", 6667), ("www.example.com/en/", "allow", 13333)}
