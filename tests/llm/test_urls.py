from collections import defaultdict

from grapheon.llm import urls
from grapheon.llm.queries import URL_RULES, op9_urls


def brute(rows, labels, weight=8.0, z=2.0, steps=100, least=0.5):
    """The tree as dictionaries: rows of (page_id, host, segments), labels by page_id."""
    total = [sum(labels.values()), len(labels)]
    everything = (total[0] + weight * 0.5) / (total[1] + weight)
    smooth = lambda g, n, above: (g + weight * above) / (n + weight)
    sums = lambda pages: (sum(labels.get(p, 0) for p in pages), sum(p in labels for p in pages))
    heads, hosts = defaultdict(list), defaultdict(list)
    for page, host, segments in rows:
        heads[segments[0] if segments else ""].append(page)
        hosts[host].append((page, segments))
    out = {}

    def descend(name, held, purity, depth):
        children = defaultdict(list)
        for page, segments in held:
            if len(segments) == depth:
                out[page] = (name + "/", purity)
            else:
                children[segments[depth]].append((page, segments))
        shares = defaultdict(list)
        wild = []
        for segment, below in children.items():
            g, n = sums([p for p, _ in below])
            if n:
                shares[int(g * steps // n)].append(segment)
            elif depth == 0:
                out.update((p, (f"{name}/{segment}/", smooth(*sums(heads[segment]), everything))) for p, _ in below)
            else:
                wild.extend(below)
        out.update((p, (f"{name}/*/", purity)) for p, _ in wild)
        groups, before = [], None
        for share in sorted(shares):
            pages = [p for s in shares[share] for p, _ in children[s]]
            g, n = sums(pages)
            apart = False
            if before:
                p = (before[0] + g) / (before[1] + n)
                apart = (g / n - before[0] / before[1]) ** 2 > z * z * p * (1 - p) * (1 / before[1] + 1 / n)
            if apart or not groups:
                groups.append([])
            groups[-1].extend(shares[share])
            before = (g, n)
        for k, members in enumerate(groups):
            below = [x for s in members for x in children[s]]
            descend(f"{name}/{members[0]}" if len(members) == 1 else f"{name}/*{k}", below, smooth(*sums([p for p, _ in below]), purity), depth + 1)

    for host, held in hosts.items():
        descend(host, held, smooth(*sums([p for p, _ in held]), everything), 0)
    return {p: (t, round(x, 9), "block" if x < least else "allow") for p, (t, x) in out.items()}


def test_tree_is_that_of_dictionaries(spark):
    paths = ["a/b/c/d/e/f", "a/b/c/d/e/g", "a/b/c/d", "a/x", "b", "b/b", "b/c", "", "c/d/e", "c/f", "d/q", "e/q", "f/r", "g/s/t/u/v/w/x"]
    rows, given = [], {}
    for i in range(1200):
        host, path = ("big" if i % 3 else f"h{i % 4}") + ".org", paths[(i * 5) % len(paths)]
        rows.append((i, f"http://{host}/{path}"))
        if i % 4:
            given[i] = float(path.endswith(("e/f", "x", "b")) or (path[:1] == "c" and i % 5 > 1) or (path[:1] in "de" and i % 7 == 0))
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string")
    labels = spark.createDataFrame([(i, bool(v)) for i, v in given.items()], "page_id long, allowed boolean")
    got = {r.page_id: (r.template, round(r.purity, 9), r.verdict) for r in urls.judge(pages, [("nowhere/", "block")], labels).collect()}
    want = brute([(i, u.split("/")[2], [s for s in u.split("/")[3:] if s]) for i, u in rows], given)
    assert got == want
    assert len({v for _, _, v in want.values()}) == 2 and any("*" in t for t, _, _ in want.values())
    assert got[next(i for i, u in rows if u.endswith("big.org/a/b/c/d/e/f"))][0] != got[next(i for i, u in rows if u.endswith("big.org/a/b/c/d/e/g"))][0]


def test_odd_urls_and_repeated_rows(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://Example.COM/En/x?q#f"), (3, "HTTP://Example.COM/En/x?q#f"), (None, "x://a.example.com/en/1"), (4, "x://www.example.com/en/"), (5, "://?/"), (6, "x://y.net/es/"), (7, "x://net/fr/a"), (8, "h://z/" + "s/" * 40)]
    got = urls.judge(spark.createDataFrame([(*r, 0.0) for r in rows], "page_id long, url string, purity double"), URL_RULES).collect()
    found = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == len(rows)
    assert {(3, "example.com", "/En/x", "com/", "allow"), (None, "a.example.com", "/en/1", "example.com/en/", "block"), (4, "www.example.com", "/en/", "www.example.com/en/", "allow"), (6, "y.net", "/es/", "net/es/", "block"), (7, "net", "/fr/a", "net/fr/", "block")} <= found
    assert {(r.host, r.path) for r in got if r.page_id in (1, 2, 5)} == {("", "")}
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_verdicts_follow_the_rules_elsewhere(spark):
    rows = op9_urls(spark, "/root/testdata/sf0.001").collect()
    assert all(r.template and 0 <= r.purity <= 1 for r in rows)
