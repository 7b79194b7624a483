"""URL verdicts against a plain version with its own components."""

import random

from tillwright.llm import urls as op

RULES = [op.Rule("allow", "com", "/"), op.Rule("block", "example.com", "/en/"),
         op.Rule("allow", "www.example.com", "/en/"), op.Rule("block", "net", "/es/"),
         op.Rule("block", "net", "/fr/")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[end:].split("?")[0].split("#")[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path


def fitting(url):
    host, path = parse(url)
    found = [(len(r.host + r.path), r.host + r.path, r.verdict) for r in RULES
             if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(found)[1:] if found else (None, None)


def test_parsing(spark):
    urls = [None, "", "x", "http://", "http://A.Ü.com", "HTTP://a.b?x=/c", "a://b#c/d", "s://h/p/q?r#t",
            "http://u@H:80/P://q", "x\ny://A\nb/c\nd?e", "/://h/x", "http://com", "http://net/es?x=1",
            "http://net/es/", "https://xnet/es/1", "https://x.net/es/1", "http://a.EXAMPLE.com/en/x",
            "http://www.example.com/en/x", "http://m.www.example.com/en/", "http://example.com/EN/"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)],
                               "page_id long, url string, html string")
    for r in op.judge(df, RULES).collect():
        url = urls[r.page_id]
        rule, verdict = fitting(url)
        assert (r.host, r.path, r.rule, r.verdict) == (*parse(url), rule, verdict or "allow")


def test_verdicts_follow_links(spark):
    rng = random.Random(5)
    hosts = ["a.org", "b.org", "x.net", "y.com", "m.example.com", "www.example.com"]
    pool = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'fr', 'de'])}/{i}" for i in range(120)]
    pages, hops = [], []
    for i, url in enumerate(pool):
        html, kind = None, rng.random()
        target = rng.choice(pool)
        if kind < 0.25:
            html, to = f'<head><link href="{target}" rel=canonical>', target
        elif kind < 0.4:
            html, to = f"<META content='0; URL={target}' http-equiv=Refresh>", target
        elif kind < 0.5:
            html, to = '<link rel="canonical" href="/fr/shared">', "http://" + parse(url)[0] + "/fr/shared"
        elif kind < 0.6:
            url, html, to = url + "?utm_source=q#top", '<link rel="stylesheet" href="/fr/a">', url
        else:
            to = None
        pages.append((i, url, html))
        if to:
            hops.append((url, to))
    pages += [(900, None, "<link rel=canonical href='http://x.net/fr/'>"), (5, *pages[5][1:]),
              (901, "https://a.org/log", None)]
    logged = [("https://a.org/log", "https://x.net/fr/9"), (None, "http://x.net/fr/9"), ("q", None)]
    near = {}
    for a, b in hops + logged[:1]:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "*", "1 AS host", "2 AS rule", "3 AS node")
    found = op.judge(df, RULES, spark.createDataFrame(logged, "from_url string, to_url string"))
    assert found.count() == len(pages)
    by_id = {r.page_id: r for r in found.collect()}
    seen = set()
    for page_id, url, _ in pages:
        rule, verdict = fitting(url)
        if verdict is None:
            reach, todo = {url}, [url]
            while todo:
                for other in near.get(todo.pop(), ()):
                    if other not in reach:
                        reach.add(other)
                        todo.append(other)
            votes = {fitting(u)[1] for u in reach}
            verdict = "allow" if "allow" in votes or "block" not in votes else "block"
            seen.add(verdict)
        assert (by_id[page_id].rule, by_id[page_id].verdict) == (rule, verdict), url
    assert seen == {"allow", "block"}


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert op.judge(df, RULES).count() == 0 and op.judge(df, []).count() == 0


def test_a_page_of_open_tags_takes_no_longer_than_its_length(spark):
    import time

    page = "<link rel=canonical " * 50_000 + "<meta http-equiv=refresh " * 20_000
    df = spark.createDataFrame([(1, "http://a.com/x", page), (2, "http://a.com/y", page + "href=/z url=/w>")],
                               "page_id long, url string, html string")
    op.page_targets(df.limit(0)).collect()
    start = time.time()
    found = {r.page_id: (r.link, r.refresh) for r in op.page_targets(df).collect()}
    assert time.time() - start < 20
    # Nothing closes the first tag, so it holds all that follows.
    assert found == {1: (None, None), 2: ("/z", None)}
