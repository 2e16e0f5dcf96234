import re
from itertools import combinations

from pyspark.sql import functions as F

from notewright.llm import url_rules

PAGE = "page_id long, url string"


def by_hand(url):
    """Host, path and the longest fitting rule with its verdict."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = re.search(r"[/?#]|$", rest).start()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = re.split(r"[?#]", rest[end:], maxsplit=1)[0]
    fits = [
        (len(h + p), h + p, v) for h, p, v in url_rules.RULES
        if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "http://a.example.org/en/12", "http://a.example.org",
    "https://x.com/fr/1?q=1", "https://x.com/de/", "https://x.com/de", "https://xcom/de/1", "http://com/fr/",
    "ftp://É.ORG/En?x#y", "http://a.net/es/1#top", "http://a.net?u=http://b.org/", "http://org#/x", "://x.org/",
    "http://notexample.org/es/1", "http://a.org/x\ny?z", "http://a.com/" + "/".join(str(i) for i in range(3000)),
    "http://a.com/x?" + "&".join(f"k{i}=1" for i in range(500)),
]


def test_given_rules_on_odd_addresses(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.org/x"), (3, "http://"), (3, "http://")]
    pages = spark.createDataFrame(rows, PAGE).withColumn("host", F.lit("com")).withColumn("tokens", F.lit(1))
    found = url_rules.filter_urls(pages).collect()
    wanted = [(i, *by_hand(u)) for i, u in rows]
    assert sorted([(r.page_id, r.host, r.path, r.rule) for r in found], key=str) == sorted(
        [w[:4] for w in wanted], key=str)
    assert all(r.verdict in ("allow", "block") for r in found)
    given = {w[1:3]: w[4] for w in wanted if w[4]}
    assert all(r.verdict == given[r.host, r.path] and r.mined_rule is None for r in found if r.rule)


def mined_by_hand(labelled, support, confidence):
    """Rules by counting every combination of every row, pruned as documented."""
    count, total = {}, {}
    for tokens, verdict in labelled:
        for n in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), n):
                total[c] = total.get(c, 0) + 1
                count[c, verdict] = count.get((c, verdict), 0) + 1
    rules = {
        (c, v): n / total[c] for (c, v), n in count.items()
        if n >= support * len(labelled) and n / total[c] >= confidence}
    return {
        (c, v): share for (c, v), share in rules.items()
        if not any(rules.get((c[:i] + c[i + 1:], v), 0) >= share for i in range(len(c)))}


def test_mined_rules_against_all_combinations(spark):
    labelled = [
        ([f"a{i % 3}", f"b{i % 4}", f"c{i % 5}"] + ["d"] * (i % 2), "block" if i % 3 == 0 and i % 4 else "allow")
        for i in range(120)]
    rules = url_rules.mine(spark.createDataFrame(labelled, "tokens array<string>, verdict string"), 0.02, 0.8)
    found = {(tuple(r.tokens), r.verdict): r for r in rules.collect()}
    wanted = mined_by_hand(labelled, 0.02, 0.8)
    assert {k: round(r.confidence, 9) for k, r in found.items()} == {k: round(v, 9) for k, v in wanted.items()}
    often = {}
    for tokens, _ in labelled:
        for t in tokens:
            often[t] = often.get(t, 0) + 1
    assert all(often[r.posting] == min(often[t] for t in r.tokens) for r in found.values())

    urls = [(f"u{i}", t) for i, t in enumerate([["a0", "b1"], ["a1"], ["zz"], ["a0", "b0", "c1", "d"]])]
    got = {r.url: r for r in url_rules.match(spark.createDataFrame(urls, "url string, tokens array<string>"), rules).collect()}
    for url, tokens in urls:
        fits = [(share, len(c)) for (c, v), share in wanted.items() if set(c) <= set(tokens)]
        assert (url in got) == bool(fits)
        if fits:
            assert abs(got[url].confidence - max(fits)[0]) < 1e-9
            assert len(got[url].mined_rule.split()) == max(f for f in fits if abs(f[0] - max(fits)[0]) < 1e-9)[1]


def test_deep_segments_and_many_keys_count(spark):
    deep = "/".join(f"s{i}" for i in range(60))
    many = "&".join(f"a{i}=1" for i in range(40))
    rows = [f"http://a.org/x/y/bad/{i}" for i in range(200)] + [f"http://a.org/x/y/fine/{i}" for i in range(200)]
    rows += [f"http://a.org/x/y/fine/{deep}/{i}?{many}&zz=1" for i in range(100)]
    rows += ["http://b.net/x/y/bad/7", "http://b.net/x/y/fine/7", f"http://b.net/q?{many}&zz=2", "http://b.net/other"]
    pages = spark.createDataFrame(list(enumerate(rows)), PAGE)
    rules = [("a.org", "/x/y/bad/", "block"), ("a.org", "/", "allow")]
    found = {r.page_id: r for r in url_rules.filter_urls(pages, rules).where("page_id >= 500").collect()}
    assert [found[i].verdict for i in range(500, 504)] == ["block", "allow", "allow", "allow"]
    assert [found[i].mined_rule is None for i in range(500, 504)] == [False, False, False, True]
    # a class is named by its first token: the keys stand in the same labelled rows as the deep segments
    assert [found[i].mined_rule for i in range(500, 503)] == ["at3:bad", "at3:fine", "at10:s0"]


def test_classes_mine_what_all_combinations_mine(spark):
    """Rules of classes, written out over the tokens of each class, are the rules of the tokens."""
    labelled = [
        (i, [f"a{i % 3}", f"b{i % 4}", f"c{i % 4}", "d", f"once{i}"], "block" if i % 3 == 0 and i % 4 else "allow")
        for i in range(120)]
    table = spark.createDataFrame(labelled, "row long, tokens array<string>, verdict string")
    classes = dict(url_rules.token_classes(table, 0.02).collect())
    assert classes == {t: t.replace("c", "b") for _, tokens, _ in labelled for t in tokens if not t.startswith("once")}
    baskets = url_rules.in_classes(
        table, spark.createDataFrame(list(classes.items()), "token string, class string"), "row")
    rules = url_rules.mine(baskets.join(table.select("row", "verdict"), "row").select("tokens", "verdict"), 0.02, 0.8)
    every = mined_by_hand([(tokens[:4], verdict) for _, tokens, verdict in labelled], 0.02, 0.8)
    assert {(tuple(r.tokens), r.verdict) for r in rules.collect()} == {
        (tuple(sorted({classes[t] for t in c})), v) for c, v in every}


def test_no_labels_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], PAGE)
    assert [r.verdict for r in url_rules.filter_urls(pages).collect()] == ["allow", "allow"]
    assert url_rules.filter_urls(pages.where("false")).count() == 0
