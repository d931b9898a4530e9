"""URLs of very many hosts with one path below one suffix, against plain matching; null ids and repeats."""

import random

from stepfold.llm import urlfilter

RULES = [("com", "", "block"), ("com", "/", "allow"), ("com", "/a", "block"), ("x.com", "/", "block"), ("h7.com", "/a/b", "allow"), ("org", "/", "allow"), ("", "/", "block")]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h) + len(p), len(h), h, p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, (best[2] + best[3] if best else None), (best[4] if best else "allow")


def test_hot_suffix_and_path(spark):
    rng = random.Random(1)
    urls = [f"http://h{i}.com/" for i in range(400)] + [f"https://h{i}.com" for i in range(100)] + [f"http://h{i}.com/a/b?q" for i in range(50)]
    urls += [f"http://{rng.choice(['x.com', 'y.x.com', 'COM', 'a.org', 'z.net', ''])}{rng.choice(['', '/', '/a', '/ab', '/b#f'])}" for _ in range(200)] + [None, "", "com/", urls[0]]
    df = spark.createDataFrame([(None if i % 9 == 0 else i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, suffix string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted((tuple(r) for r in urlfilter.judge(df, "page_id", "url", rules).collect()), key=str)
    assert got == sorted(((None if i % 9 == 0 else i, *plain(u)) for i, u in enumerate(urls)), key=str)
