"""Fixed rules against a plain version; a planted pattern is mined."""

from __future__ import annotations

from pyspark.sql import functions as F
from tierline.llm import url_rules as U

URLS = [
    None, "", "no scheme", "http://", "HTTPS://WWW.Example.ORG/es/1", "http://example.org/en/12", "http://notexample.org/en/12", "http://org/x",
    "http://a.example.org?x=/es/", "http://a.com/fr/x#y", "http://a.com/de/x", "http://a.comx/de/x", "x://y://z.com/de/1", "http://a.com/de",
    "http://É.com/de/é?q=1&q=2&=3", "http://a.org\n/es/", "http://" + "a." * 3000 + "com/de/" + "x/" * 3000, "http://a.org/", "http://a.org/",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for verdict, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, best[0] if best else None, best[1] if best else None


def test_fixed_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[4])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS id", "2 AS matched")
    none = spark.createDataFrame([], "rule_tokens array<string>, rarest string, confidence double, support double")
    got = {r.page_id: r for r in U.judge(pages, none).collect()}
    assert len(got) == len(rows)
    for i, u in rows:
        host, path, rule, verdict = plain(u)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict or "allow"), u
    assert U.judge(pages.limit(0), none).collect() == []


def test_mined_rules(spark):
    rows = [(i, f"http://{'bad' if i % 5 == 0 else 'good'}{i % 3}.example.net/{'spam' if i % 5 == 0 else 'news'}/{i}?utm=1") for i in range(300)]
    labels = [(i, i % 5 == 0) for i in range(0, 200)] + [(None, True), (3, None)]
    urls = spark.createDataFrame(rows, "id long, url string")
    rules = U.mine(urls, spark.createDataFrame(labels, "id long, bad boolean"), support=0.01, confidence=0.9)
    kept = rules.collect()
    assert any(r.rule_tokens == ["dir=spam"] for r in kept)
    # a rule is not kept beside a part of it that does as well
    sets = [set(r.rule_tokens) for r in kept]
    assert not any(a < b for a in sets for b in sets)
    pages = urls.withColumnRenamed("id", "page_id").union(spark.createDataFrame([(1000, None), (1001, rows[0][1])], "page_id long, url string"))
    got = {r.page_id: r.verdict for r in U.judge(pages, rules).collect()}
    assert all(got[i] == ("block" if i % 5 == 0 else "allow") for i in range(300))
    assert got[1000] == "allow" and got[1001] == "block"


def test_without_labels(spark):
    urls = spark.createDataFrame([(1, "http://a.net/x")], "id long, url string")
    assert U.mine(urls, spark.createDataFrame([], "id long, bad boolean")).collect() == []
    assert U.mine(urls, spark.createDataFrame([(1, False)], "id long, bad boolean")).collect() == []


def test_tokens(spark):
    df = spark.createDataFrame([("http://www.a-b.Example.com/en/x1/Q/page.HTML?u=1&v&u=2#f",), (None,)], "url string")
    got = [r[0] for r in df.select(F.array_sort(U.all_tokens(F.col("url")))).collect()]
    assert got[0] == sorted(
        ["host=www.a-b.example.com", "word=a", "word=b", "word=example", "dir=en", "dir=Q", "kind=html", "query=u", "query=v"]
    )
    assert got[1] == []


def test_every_token_is_mined_and_matched(spark):
    def url(i, bad):
        return [
            f"http://{'best-online-casino' if bad else 'best-online-paper'}.h{i}.example.com/x",
            f"http://n{i}.example.com/a/2024/b/c/{'spam' if bad else 'news'}/x.html",
            f"http://n{i}.example.com/x?id=1&page=2&{'aff' if bad else 'ref'}=2",
        ][i % 3]

    urls = spark.createDataFrame([(i, url(i, i % 2 == 0)) for i in range(240)], "id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 0) for i in range(180)], "id long, bad boolean")
    rules = U.mine(urls, labels, support=0.05, confidence=0.9)
    assert {tuple(r.rule_tokens) for r in rules.collect()} == {("word=casino",), ("dir=spam",), ("query=aff",)}
    got = {r.id: r.verdict for r in U.judge(urls, rules, "id").collect()}
    assert all(got[i] == ("block" if i % 2 == 0 else "allow") for i in range(240))


def test_tokens_that_occur_together_each_make_a_rule(spark):
    deep = "/".join(f"{a}{b}" for a in "abcde" for b in "fghij")
    rows = [(i, f"http://h{i}.net/{deep}/{'bad/worse' if i % 2 else 'good'}/x") for i in range(60)]
    urls = spark.createDataFrame(rows, "id long, url string")
    rules = U.mine(urls, spark.createDataFrame([(i, i % 2 == 1) for i in range(60)], "id long, bad boolean"), support=0.1)
    assert {tuple(r.rule_tokens) for r in rules.collect()} == {("dir=bad",), ("dir=worse",)}


def brute_rules(baskets, support, confidence):
    """baskets: (tokens, bad) -> minimal combinations that reach both bounds."""
    from itertools import combinations

    tokens = sorted({t for own, _ in baskets for t in own})
    kept = []
    for size in range(1, 5):
        for c in combinations(tokens, size):
            if any(set(k) <= set(c) for k in kept):
                continue
            holding = [bad for own, bad in baskets if set(c) <= set(own)]
            if sum(holding) >= support * len(baskets) and sum(holding) >= confidence * len(holding) > 0:
                kept.append(c)
    return kept


def test_mined_rules_against_brute_force(spark):
    import random

    for seed in range(3):
        rng = random.Random(seed)
        rows, labels = [], []
        for i in range(160):
            dirs = [d for d in "abcdef" if rng.random() < 0.5]
            if "a" in dirs:
                dirs.append("atoo")  # always with a
            bad = {"b", "c"} <= set(dirs) or ("d" in dirs and "e" not in dirs and rng.random() < 0.7) or rng.random() < 0.05
            rows.append((i, "http://h.net/" + "".join(f"{d}/" for d in dirs) + "x"))
            labels.append((i, bad))
        urls = spark.createDataFrame(rows, "id long, url string")
        rules = U.mine(urls, spark.createDataFrame(labels, "id long, bad boolean"), support=0.05, confidence=0.8)
        own = {r.id: r.own for r in urls.select("id", U.all_tokens(F.col("url")).alias("own")).collect()}
        expected = brute_rules([(own[i], bad) for i, bad in labels], 0.05, 0.8)
        # every choice of members of a mined rule, for the comparison only
        from itertools import product

        got = {tuple(sorted(c)) for r in rules.collect() for c in product(*r.members)}
        assert got == {tuple(sorted(c)) for c in expected if not {"dir=a", "dir=atoo"} <= set(c)}
        verdicts = {r.id: r.mined for r in U.judge(urls, rules, "id").collect()}
        assert verdicts == {i: any(set(c) <= set(own[i]) for c in expected) for i in own}


def test_many_common_tokens(spark):
    """Thirty directories that bad pages have, nearly independent of one
    another, and four groups of forty that always go together."""
    import random
    import time

    rng = random.Random(3)
    common = [f"c{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    groups = [[f"g{chr(97 + g)}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)] for g in range(4)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 < 2
        dirs = [d for d in common if rng.random() < 0.95] if bad else ["news", "daily"]
        for g in groups:
            if rng.random() < 0.5:
                dirs = dirs + g
        rows.append((i, "http://h.net/" + "".join(f"{d}/" for d in dirs) + "x"))
        labels.append((i, bad))
    urls = spark.createDataFrame(rows, "id long, url string").repartition(4)
    began = time.time()
    rules = U.mine(urls, spark.createDataFrame(labels, "id long, bad boolean"), support=0.01)
    found = rules.collect()
    assert time.time() - began < 120
    assert sorted(r.rule_tokens[0] for r in found if len(r.rule_tokens) == 1) == [f"dir={d}" for d in common]
    assert len(found) < 100
    got = {r.id: r.verdict for r in U.judge(urls, rules, "id").collect()}
    assert all(got[i] == "block" for i, bad in labels if bad)
