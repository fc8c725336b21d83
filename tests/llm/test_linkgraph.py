import pytest
from pyspark.sql import functions as F

from restframe.llm import linkgraph

SCHEMA = "page_id long, url string, html string, host string, rule int, trust int"
RULES = [(r, v) for r, v in linkgraph.RULES]


def link(*hosts):
    return "".join(f'<a class="x" HREF="https://{h}/p?q">t</a> <a href=\'//{h}\'>u</a><a href="/own">o</a>' for h in hosts)


PAGES = [
    (1, "https://A.Example.NET/en/x", None),
    (2, "http://example.net", link("b.org")),
    (3, "http://example.com/de/1?x://y", link("good.org", "bad.net")),
    (4, "http://example.com/fr/1#de", ""),
    (5, "http://x.org/fr/2", link("mid.info", "mid.info")),
    (6, "http://mid.info/a", link("far.info")),
    (7, "http://far.info?p", "<a href=mailto:x>"),
    (8, "http://friend.info/z", link("bad.net", "worse.net")),
    (9, "http://bad.net/q", link("friend.info")),
    (10, None, link("bad.net")),
    (11, "no scheme/en/", link("x.org")),
    (12, "http://notexample.net.evil.com/en/", None),
    (13, "a://", ""),
    (None, "http://worse.net/" + "y" * 100000, None),
]


def brute(rows, rules, damping=0.85, rounds=150):
    """The same by dictionaries."""
    parsed = []
    for key, url, html in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])
        rest = rest[:cut]
        host, slash, tail = rest.partition("/")
        path = slash + tail
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = []
        for rule, verdict in rules:
            name, _, prefix = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
                fits.append((len(rule), len(name), verdict == "block", rule, verdict))
        parsed.append((key, host, path, max(fits, default=None), html))
    seeds, edges = {}, {}
    for _, host, _, fit, html in parsed:
        n, a, b = seeds.get(host, (0, 0, 0))
        seeds[host] = (n + 1, a + (fit is not None and fit[4] == "allow"), b + (fit is not None and fit[4] == "block"))
        for dst in (html or "").split("//")[1:]:
            dst = dst.split("/")[0].split("'")[0]
            if host and dst != host:
                edges[host, dst] = edges.get((host, dst), 0) + 1
    hosts = set(seeds) | {h for e in edges for h in e}
    base = {h: (seeds.get(h, (1, 0, 0))[1] / seeds.get(h, (1, 0, 0))[0], seeds.get(h, (1, 0, 0))[2] / seeds.get(h, (1, 0, 0))[0]) for h in hosts}
    out = {h: sum(n for (s, _), n in edges.items() if s == h) for h in hosts}
    into = {h: sum(n for (_, d), n in edges.items() if d == h) for h in hosts}
    now = {h: ((1 - damping) * t, (1 - damping) * d, (1 - damping) * d) for h, (t, d) in base.items()}
    for _ in range(rounds):
        t = {h: (1 - damping) * base[h][0] for h in hosts}
        d = {h: (1 - damping) * base[h][1] for h in hosts}
        b = dict(d)
        for (s, e), n in edges.items():
            t[e] += damping * now[s][0] * n / out[s]
            d[s] += damping * now[e][1] * n / into[e]
            b[s] += damping * now[e][2] * n / out[s]
        now = {h: (t[h], d[h], b[h]) for h in hosts}

    def found(host):
        trust, distrust, blame = now[host]
        return "block" if distrust > linkgraph.RATIO * (trust + distrust) and blame > linkgraph.BLAME else "allow"

    return [(key, host, path, fit and fit[3], fit[4] if fit else found(host), now[host]) for key, host, path, fit, _ in parsed]


def run(spark, rows):
    pages = spark.createDataFrame([(*r, "h", 1, 2) for r in rows], SCHEMA)
    return linkgraph.judge(pages, spark.createDataFrame(RULES, "rule string, verdict string")).collect()


def test_judged_like_brute_force(spark):
    rows = [*PAGES, PAGES[4], PAGES[4]]
    got = sorted(run(spark, rows), key=lambda r: (r.page_id is None, r.page_id or 0))
    want = sorted(brute(rows, RULES), key=lambda r: (r[0] is None, r[0] or 0))
    assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got] == [w[:5] for w in want]
    for r, w in zip(got, want, strict=True):
        assert [r.trust, r.distrust, r.blame] == pytest.approx(w[5], rel=1e-3)
    verdicts = {r.page_id: (r.rule, r.verdict) for r in got}
    assert verdicts[1] == ("example.net/en/", "allow") and verdicts[2] == (None, "allow")
    # It links to blocked hosts; nothing else is known of it.
    assert verdicts[8] == (None, "block")


def test_many_hosts_that_link_to_one_blocked_host(spark):
    rows = [(0, "http://bad.net/", None), (1, "http://x.org/fr/", link(*[f"good{i}.info" for i in range(40)]))]
    rows += [(100 + i, f"http://farm{i}.info/", link("bad.net")) for i in range(60)]
    # Known by a trusted host, or with few of its links to blocked ones.
    rows += [(200 + i, f"http://good{i}.info/", link("bad.net", "a.info")) for i in range(40)]
    rows += [(300 + i, f"http://far{i}.info/", link("bad.net", "a.info", "b.info", "c.info")) for i in range(20)]
    verdicts = {r.page_id: r.verdict for r in run(spark, rows)}
    assert {verdicts[100 + i] for i in range(60)} == {"block"}
    assert {verdicts[200 + i] for i in range(40)} | {verdicts[300 + i] for i in range(20)} == {"allow"}


@pytest.mark.parametrize("linkers", [0, 3, 200])
def test_links_from_unknown_hosts_take_nothing_away(spark, linkers):
    rows = [(0, "http://bad.net/", None), (1, "http://x.org/fr/", link("a.info")), (2, "http://a.info/", link("bad.net", "b.info"))]
    rows += [(10 + i, f"http://u{i}.info/", link("a.info")) for i in range(linkers)]
    a = next(r for r in run(spark, rows) if r.page_id == 2)
    alone = next(w for w in brute(rows[:3], RULES) if w[0] == 2)
    assert a.verdict == "allow" and [a.trust, a.distrust] == pytest.approx(alone[5][:2], rel=1e-3)


def test_a_farm_of_a_hundred_hosts(spark, monkeypatch):
    monkeypatch.setattr(linkgraph, "SETTLED", 0.02)  # verdicts only
    rows = [(0, "http://bad.net/", None), (1, "http://x.org/fr/", link("good.info")), (2, "http://good.info/", link("a.info"))]
    rows += [(10 + i, f"http://farm{i}.info/", link("bad.net", f"farm{(i + 1) % 100}.info")) for i in range(100)]
    got = run(spark, rows)
    assert sorted((r.page_id, r.verdict) for r in got) == sorted((w[0], w[4]) for w in brute(rows, RULES))
    assert {r.verdict for r in got if r.page_id >= 10} == {"block"} and next(r for r in got if r.page_id == 2).verdict == "allow"


def test_many_rules_under_one_domain(spark):
    rules = [(f"host.com/u{i}", "block" if i % 2 else "allow") for i in range(300)] + [("host.com/u1/x/", "allow"), ("com/", "block")]
    rows = [(i, f"http://s{i % 7}.host.com/u{i}/x/{'y' * (i % 3)}?q", None) for i in range(300)] + [(900, "http://com", None), (901, "http://com/a", None)]
    pages = spark.createDataFrame([(*r, "h", 1, 2) for r in rows], SCHEMA)
    got = linkgraph.judge(pages, spark.createDataFrame(rules, "rule string, verdict string")).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in got if r.rule) == sorted((w[0], w[3], w[4]) for w in brute(rows, rules) if w[3])
    assert len(got) == len(rows)


def test_it_settles_or_says_so(spark, monkeypatch):
    monkeypatch.setattr(linkgraph, "MAX_ROUNDS", 2)
    with pytest.raises(RuntimeError, match="settle"):
        run(spark, PAGES)


def test_first_scheme_mark_counts(one):
    assert one(linkgraph.host_of(F.col("u")), u="x?a://B.c\n/d://e") == "b.c\n"
    assert one(linkgraph.path_of(F.col("u")), u="x://b/Ä b#c?d") == "/Ä b"


def test_no_rows_and_no_rules(spark):
    assert run(spark, []) == []
    pages = spark.createDataFrame([(*r, "h", 1, 2) for r in PAGES], SCHEMA)
    none = linkgraph.judge(pages, spark.createDataFrame([], "rule string, verdict string")).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")} and len(none) == len(PAGES)
