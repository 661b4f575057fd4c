"""Lexical search, periodic runs and URL filters against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
from shared_tables import SF, odd, table  # noqa: F401

from panelrank.llm import lexical_search, periodic_runs, url_filters
from panelrank.llm.queries import QUERIES
from panelrank.llm.url_filters import Rule


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# 11 -----------------------------------------------------------------------------------------------

def ranked(docs, items, k=50):
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, total = len(bags), sum(b[2] for b in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = set()
    for i, ts in wanted.items():
        found = []
        for d, b, n in bags:
            m = 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in ts if t in b)
            if score > 0:
                found.append((-score, d is None, d))
        out |= {(i, r + 1, f[2], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])}
    return out


def test_op11_equals_brute_force(spark, table):
    got = QUERIES["op11_lexical_search"](spark, SF).collect()
    assert {tuple(r) for r in got} == ranked([(r["doc_id"], r["text"]) for r in table("documents")], [(r["item_id"], r["text"]) for r in table("benchmark")])
    assert len(got) == len(set(got)) and max(r["rank"] for r in got) == 50


def test_op11_odd_rows_ties_blocks(spark, odd):
    items = [(1, "Two THREE"), (1, "seven"), (2, None), (3, ""), (4, "..."), (5, "alpha zeta x"), (None, "one"), (7, "nowhere")]
    table = spark.createDataFrame([(*i, "kept") for i in items], "item_id long, text string, score string")
    want = ranked([(r.doc_id, r.text) for r in odd.collect()], [i for i in items if i[1] is not None], 3)
    for size in (1 << 20, 1):
        got = lexical_search.search(odd, table, k=3, block_bytes=size).collect()
        assert {tuple(r) for r in got} == want and {r.item_id for r in got} == {1, 5, None}
    # both rows of document 1 have its score, the smaller id first
    assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"]) if r.item_id == 1] == [1, 1, 6]
    assert lexical_search.search(odd.where("false"), table).count() == 0
    assert lexical_search.search(odd, table.where("false")).count() == 0


def test_op11_prunes_without_loss():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    pick = lambda n: [words[min(399, int(rng.expovariate(0.01)))] for _ in range(n)]
    texts = [pick(rng.randrange(1, 60)) for _ in range(700)]
    asked = [pick(12) for _ in range(40)]
    for i in range(0, 700, 9):
        texts[i] += asked[i % 40]
    items = lexical_search.Items(list(range(40)), [[" ".join(a)] for a in asked])
    lookup = {h: i for i, h in enumerate(items.keys.tolist())}
    seen = {}
    for w in words:
        one = lexical_search.Items([0], [[w]])
        seen[w] = lookup.get(int(one.keys[0]))
    bags = [collections.Counter(seen[w] for w in t if seen[w] is not None) for t in texts]
    df = np.bincount([k for b in bags for k in b], minlength=len(items.keys))
    items.weigh(700, df)
    size = sum(map(len, texts))
    first, term, value = [0], [], []
    for t, b in zip(texts, bags, strict=True):
        m = 50 + 50 * len(t) * 700 // size
        term += list(b)
        value += [10**9 * f // (1000 * f + 20 * m) for f in b.values()]
        first.append(len(term))
    impact = lexical_search.Csr(np.array(first), np.array(term), np.array(value, float))
    best = lexical_search.Best(items, 5, np.zeros(40))
    want = {(i, d, s) for i, _, d, s in ranked([(d, " ".join(t)) for d, t in enumerate(texts)], list(enumerate(" ".join(a) for a in asked)), 5)}
    for _ in range(2):  # the second time with the k-th scores as a start
        counted = lexical_search.search_tree(items, best, np.arange(700), impact)
        got = [best.trim(i) for i in range(40)]
        assert {(items.ids[i], int(d), int(s)) for i, (ds, ss) in enumerate(got) for d, s in zip(ds, ss, strict=True)} == want
        best = lexical_search.Best(items, 5, np.array([g[1][-1] for g in got]))
    assert counted["scored"] < counted["pairs"] / 2


# 12 -----------------------------------------------------------------------------------------------

def runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    got = runs(w)
    gone = {i for s, m, q in got for i in range(s + q, s + m)}
    best = max(got, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    return (doc_id, len(got), *best, 1000 * best[1] // best[2] if got else None, sha("".join("%d,%d,%d\n" % r for r in got)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def planted(rng):
    k, n = rng.choice([1, 2, 3, 5, 30]), rng.randrange(200)
    w = [f"w{rng.randrange(k)}" for _ in range(n)]
    if n > 20 and rng.random() < 0.7:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)] + ["z", "w0"] * rng.randrange(9)
    return w


def test_op12_runs_equal_brute_force(monkeypatch):
    rng = random.Random(12)
    fib = ["a", "b"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    for _ in range(8):
        thue += thue.translate({97: 98, 98: 97})
    cases = [[], ["a"] * 11, ["a"] * 12, ["a"] * 300, list(fib[-1]), list(thue), (["a"] * 20 + ["b"]) * 9, list("abc" * 21), list("xxxxx" + "abcdef" * 2 + "y"), *(planted(rng) for _ in range(250))]
    texts = [[x.encode() for x in w] for w in cases]
    want = [runs(w) for w in cases]
    assert periodic_runs.text_runs(texts) == want
    assert [periodic_runs.text_runs([t])[0] for t in texts[:60]] == want[:60]
    monkeypatch.setattr(periodic_runs, "MAX_BLOCK", 4)       # blocks represented by their beginnings
    monkeypatch.setattr(periodic_runs, "CELLS", 64)
    assert periodic_runs.text_runs(texts) == want


def test_op12_transform_is_exact():
    rng = np.random.default_rng(1)
    p = periodic_runs.PRIME
    for n in (8, 128, 512, 1 << 15):
        x = rng.integers(0, p, (2, n)).astype(float)
        y = periodic_runs.NTT(x)
        assert (y[:, 0] == x.astype(np.int64).sum(1) % p).all()
        assert (np.rint(periodic_runs.NTT(y, back=True)) * pow(n, -1, p) % p == x).all()
    # sums equal the plain sum of squared differences
    w = rng.integers(0, 3, 400)
    at = np.arange(0, 64, 16)
    which, d = periodic_runs.zero_sums(w, at, 2, 3, 6)
    assert {(int(at[i]), int(k)) for i, k in zip(which, d, strict=True)} == {(x, k) for x in at.tolist() for k in range(3, 7) if (w[x:x + 2] == w[x + k:x + k + 2]).all()}


def test_op12_long_runs_are_found_in_time():
    a = [b"a"]
    assert periodic_runs.text_runs([a * 100_000]) == [[(0, 100_000, 1)]]
    assert periodic_runs.text_runs([[b"%d" % (i % 7919) for i in range(100_000)]]) == [[(0, 100_000, 7919)]]
    assert len(periodic_runs.text_runs([(a * 600 + [b"b"]) * 100])[0]) == 101


def test_op12_false_seeds_are_dropped():
    w = np.array([1, 2, 3, 9, 2, 3, 4])
    assert periodic_runs._exact(w, 0, 7, 3, 0) is None
    assert periodic_runs._exact(w, 0, 7, 3, 1) == (1, 6)


def test_op12_equals_brute_force(spark, table):
    got = {tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got == {digest(r["doc_id"], r["text"]) for r in table("documents")} and any(r[1] for r in got)


def test_op12_odd_rows(spark, odd):
    docs = odd.withColumnRenamed("score", "Runs").select("*", odd.lang.alias("collapsed"))
    out = periodic_runs.periodic_runs(docs).collect()
    assert len(out) == 9 and out[0].length == "kept" and out[0].__fields__[-2:] == ["runs", "collapsed"]
    for r in out:
        assert [tuple(x) for x in r.runs] == ([(0, 80_000, 4)] if r.doc_id == 5 else [])
        assert r.collapsed == ("alpha beta gamma delta" if r.doc_id == 5 else " ".join((r.text or "").split()))
    assert periodic_runs.periodic_runs(docs.where("false")).count() == 0


# 13 -----------------------------------------------------------------------------------------------

RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "com", "/de/")]


def page(link=None, refresh=None, more=""):
    head = f'<LINK data-x="1" href="{link}" REL=\'Canonical\'>' if link else ""
    head += f'<meta content="0; URL={refresh}" http-equiv="refresh">' if refresh else ""
    return f"<html><head>{more}{head}</head><body><article>text</article></body></html>"


PAGES = [
    (1, "http://a.net/x", page("https://a.net/y?utm_source=feed")),             # chain to a blocked URL that is no page
    (2, "https://A.net/y#top", page(refresh="//b.net/z/?k=1&gclid=9")),
    (3, "http://b.net/z/?k=1", page("../../q/./r")),
    (4, "http://b.net/q/r", page("http://shop.com/de/1")),
    (5, "http://c.net/", page("http://example.org/fr/")),                       # an allowed target blocks nothing
    (6, "http://sub.example.org/en/7", page("http://x.example.org:80/es/1")),   # allow rule of its own holds
    (7, "http://d.net/", page(more="<!-- <link rel=canonical href=http://x.com/de/> --><script>'<link rel=canonical href=http://x.com/de/>'</script>")),
    (8, "http://e.net", page("mailto:a@x.com")),
    (9, "http://f.net/p", page("?b=1")),
    (10, "http://f.net/p?b=1", None),
    (11, "http://g.com/de/", None),
    (12, "http://h.net/", page("http://g.com/de/?a&amp;b")),
    (13, "http://notexample.org/es/", None),
    (14, None, page("http://x.com/de/")), (15, "no url", page("http://x.com/de/")), (16, "", ""), (None, None, None), (17, "http://org/a", ""), (18, "ftp://h.net", ""),
    (19, "http://i.net/a", page("http://i.net/a#self")), (20, "x://y://z.com/de/", ""), (1, "http://a.net/x", None), (21, "http://j.net/r", None),
]
WANT = {1: ("block", "alias"), 2: ("block", "alias"), 3: ("block", "alias"), 4: ("block", "alias"), 5: ("allow", "default"), 6: ("allow", "rule"), 7: ("allow", "default"), 8: ("allow", "default"), 9: ("allow", "default"),
        10: ("allow", "default"), 11: ("block", "rule"), 12: ("block", "alias"), 13: ("allow", "rule"), 14: ("allow", "default"), 15: ("allow", "default"), 16: ("allow", "default"), None: ("allow", "default"),
        17: ("allow", "rule"), 18: ("block", "alias"), 19: ("allow", "default"), 20: ("allow", "default"), 21: ("allow", "default")}


def test_op13_aliases_and_precedence(spark):
    pages = spark.createDataFrame([(*p, "kept", "clash") for p in PAGES], "page_id long, url string, html string, extra string, Verdict string")
    got = url_filters.judge(pages, RULES).collect()
    assert len(got) == len(PAGES) and got[0].extra == "kept" and got[0].__fields__ == ["page_id", "url", "html", "extra", "host", "path", "rule", "verdict", "why"]
    assert {r.page_id: (r.verdict, r.why) for r in got} == WANT
    by = {r.page_id: r for r in got}
    assert (by[2].host, by[2].path, by[8].path, by[14].host, by[20].host) == ("a.net", "/y", "", "", "y:")
    assert (by[6].rule, by[17].rule, by[1].rule) == ("org/", "org/", None)
    # redirects given as a table: 21 goes over two hops to a blocked URL
    hops = spark.createDataFrame([("http://j.net/r", "http://k.net/"), ("http://k.net", "http://c.net/"), ("http://c.net/", "http://y.com/de/2"), (None, "http://y.com/de/2"), ("bad", None)], "source string, target string")
    more = {r.page_id: (r.verdict, r.why) for r in url_filters.judge(pages, RULES, hops, keep=["page_id"]).collect()}
    assert more == {**WANT, 21: ("block", "alias"), 5: ("block", "alias")}
    assert {r.verdict for r in url_filters.judge(pages, []).collect()} == {"allow"}
    assert url_filters.judge(pages.where("false"), RULES).count() == 0
    assert {r.why for r in url_filters.judge(pages, RULES, html_col=None).collect()} == {"rule", "default"}


def test_op13_equals_union_find(spark):
    rng = random.Random(13)
    urls = [f"http://h{i}.{rng.choice(['net', 'net', 'net', 'com', 'example.org'])}/{rng.choice(['de', 'es', 'en'])}/{i}" for i in range(300)]
    links = [(rng.choice(urls[:250]), rng.choice(urls)) for _ in range(120)] + [(u, urls[0]) for u in urls[250:290]]
    pages = spark.createDataFrame([(i, u, page(dict(links).get(u))) for i, u in enumerate(urls)], "page_id long, url string, html string")
    root = {u: u for u in urls}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u
    for a, b in dict(links).items():
        root[find(a)] = find(b)

    def rule(u):
        host, path = re.match(r"http://([^/]*)(.*)", u).groups()
        fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.name)).verdict if fit else None
    bad = {find(u) for u in urls if rule(u) == "block"}
    want = {i: rule(u) or ("block" if find(u) in bad else "allow") for i, u in enumerate(urls)}
    assert {r.page_id: r.verdict for r in url_filters.judge(pages, RULES).collect()} == want
    assert any(rule(u) is None and want[i] == "block" for i, u in enumerate(urls))


def test_op13_longest_rule_wins(spark):
    rules = [Rule("block", "a.com", "/"), Rule("allow", "a.com", "/x/"), Rule("block", "a.com", "/x/y"), Rule("allow", "b.a.com", "/"), Rule("block", "b.com", "/q"), Rule("allow", "b.com", "/q")]
    cases = {"http://a.com/": "a.com/", "http://a.com/x/": "a.com/x/", "http://z.a.com/x/yz?/": "a.com/x/y", "http://b.a.com/": "b.a.com/", "http://b.a.com/x/": "b.a.com/", "http://b.com/q": "b.com/q", "http://ba.com/": None, "http://a.com": None}
    got = url_filters.judge(spark.createDataFrame(list(cases.items()), "url string, want string"), rules, html_col=None).collect()
    assert all(r.rule == r.want for r in got) and {r.verdict for r in got if r.url.startswith("http://b.com")} == {"allow"}


def test_op13_equals_sql_on_links(spark):
    import duckdb
    import pandas as pd
    pages = [(i, u.replace("shop.com", "shop.com"), h) for i, u, h in PAGES if i not in (3, None) and u is not None]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    cur = con.execute(url_filters.ORACLE_SQL)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in ("page_id", "host", "path", "rule", "verdict")) for r in cur.fetchall())
    got = url_filters.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), url_filters.RULES, keep=["page_id"])
    assert sorted((tuple(r)[:5] for r in got.collect()), key=lambda r: (r[0], r[1])) == sorted(want, key=lambda r: (r[0], r[1]))
