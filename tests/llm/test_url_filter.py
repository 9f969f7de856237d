import random
import re

import pytest

from tessera.llm import url_filter as U

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "bad.com", "/"), ("allow", "good.org", "/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(pages):
    rows, count, edges = [], {}, {}
    for i, url, html in pages:
        h, p = parts(url)
        fit = [r for r in RULES if (h == r[1] or h.endswith("." + r[1])) and p.startswith(r[2])]
        rule = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        rows.append((i, h, p, rule))
        if h:
            c = count.setdefault(h, [0, 0, 0])
            c[0] += 1
            c[1] += bool(rule and rule[0] == "allow")
            c[2] += bool(rule and rule[0] == "block")
        for t in re.findall(U.HREF, html or ""):
            t = t.lower()
            if h and t != h:
                edges[h, t] = edges.get((h, t), 0) + 1
    rank = []
    for k, es in ((1, edges), (2, {(b, a): n for (a, b), n in edges.items()})):
        seed = {h: c[k] / c[0] for h, c in count.items() if c[k]}
        total = {}
        for (a, _), n in es.items():
            total[a] = total.get(a, 0) + n
        r = dict(seed)
        for _ in range(U.ROUNDS):
            new = {h: .15 * s for h, s in seed.items()}
            for (a, b), n in es.items():
                new[b] = new.get(b, 0) + .85 * n / total[a] * r.get(a, 0)
            r = new
        rank.append({h: x / .15 for h, x in r.items()})
    out = []
    for i, h, p, rule in rows:
        bad = rank[1].get(h, 0) - rank[0].get(h, 0) >= U.LIMIT - 1e-9 and h
        out.append((i, h, p, rule[1] + rule[2] if rule else None, rule[0] if rule else "block" if bad else "allow"))
    return sorted(out, key=repr), edges


def pages(seed, n=300):
    r = random.Random(seed)
    hosts = ["a.bad.com", "bad.com", "good.org", "x.good.org", "example.net", "www.example.net", "spam.net", "m.io", "farm.io", "Shop.IO", "news.io", "q.dev", "notbad.com"]
    near = {"farm.io": ["bad.com", "a.bad.com", "farm2.io"], "good.org": ["news.io", "q.dev"], "m.io": ["bad.com", "good.org"]}
    out = []
    for i in range(n):
        h = r.choice(hosts)
        links = "".join(f'<a {r.choice(["href", "HREF"])}={q}{r.choice(["http://", "https://", "//"])}{r.choice(near.get(h, hosts))}/p{q}>x</a>'
                        for q in r.choices(['"', "'", ""], k=r.randint(0, 4))) + '<a href="/local">y</a>'
        out.append((i, r.choice(["http://", "https://"]) + h + r.choice(["", "/", "/en/1", "/de/x?y=1", "?q", "#f", "/a://b"]), r.choice([links, links, None])))
    return out + [(900, None, "x"), (901, "no scheme", None), (902, "://", ""), (None, "http://farm.io/", None), (3, out[3][1], out[3][2]), (904, "http://m.io/" + "z" * 50_000, None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", 1) for i, u, h in rows], "page_id long, url string, html string, host string, back int").repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = pages(seed)
    want, edges = brute(rows)
    assert edges and any(w[4] == "block" and w[3] is None for w in want)
    assert sorted((tuple(r) for r in U.judge(frame(spark, rows), RULES).collect()), key=repr) == want


def test_sql_agrees(spark):
    import duckdb
    rows = [r for r in pages(3) if r[1] != "://"]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(U.oracle_sql(RULES)).fetchall(), key=repr) == brute(rows)[0]


def test_without_links_and_empty(spark):
    rows = [(i, u, None) for i, u, _ in pages(4)]
    assert sorted((tuple(r) for r in U.judge(frame(spark, rows), RULES).collect()), key=repr) == brute(rows)[0]
    assert U.judge(frame(spark, rows).limit(0), RULES).collect() == []
