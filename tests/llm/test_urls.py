from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from accountloom.llm import urls
from accountloom.llm.queries import URL_RULES, op7_url_filters
from tests.llm.support import SF

PAGES = "page_id long, url string, html string, host string, path string, rule string, n int"


def pages(spark, found):
    rows = found.items() if isinstance(found, dict) else found
    return spark.createDataFrame([(i, u, "x", "y", "z", "w", 1) for i, u in rows], PAGES)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, text in [(r.verdict, r.text) for r in URL_RULES]:
        own, _, rest = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[1])):
            best = (verdict, text)
    return best or (None, None)


ODD = {
    1: None, 2: "", 3: "no scheme", 4: "http://", 5: "http://ORG", 6: "http://org/", 7: "http://Example.ORG/es/1?x#y",
    8: "http://example.org/es", 9: "http://a.example.org/en/1/2", 10: "http://badexample.org/es/x", 11: "x://a?b/c",
    12: "x://a#b/c", 13: "http://É.com/fr/É", 14: "http://x.com/fr/?/de/", 15: "a://b://c/d", 16: "http://example.org/en/2",
    17: "http://com/de/", 18: "http://x.com/de", 19: "http://u:p@x.com:80/de/1", 20: "http://x.com/" + "a/" * 500,
    21: "http://x.net/a\nb/c",
}


def check(rows, found):
    assert len(rows) == len(found)
    for r in rows:
        host, path = plain_parts(found[r.page_id])
        verdict, rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), found[r.page_id]
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_parts_and_rules(spark):
    check(urls.judged(pages(spark, ODD), URL_RULES).collect(), ODD)


def test_registered_query(spark):
    found = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    check(op7_url_filters(spark, SF).collect(), found)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = pages(spark, [(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://a.org/x")])
    assert [r.verdict for r in urls.judged(docs, URL_RULES).collect()] == ["allow"] * 3
    assert urls.judged(docs.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in urls.judged(docs, []).collect()} == {"allow"}


def by_template(spark, found, rules, **options):
    rows = urls.judged(pages(spark, dict(enumerate(found))), rules, **options).collect()
    return {(r.host, r.template): (r.branch, r.verdict) for r in rows}


def test_variable_segments_become_wildcards(spark):
    found = [f"http://h.net/{a}/{i}/name-{i * 7919 % 1000}x" for i in range(300) for a in ("news", "shop")]
    found += [f"http://h.net/p/{'ab' * 8}{i:x}" for i in range(50)]
    found += [f"http://h.net/slug/{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(200)]
    templates = {t for _, t in by_template(spark, found, [])}
    assert templates == {"/news/<n>/name-<n>x", "/shop/<n>/name-<n>x", "/p/<hash>", "/slug/*"}


def test_deep_paths_have_one_wildcard_for_the_rest(spark):
    found = ["http://h.net/a/b/c/d/e/f"] * 9 + ["http://h.net/a/b/c/d/x"] * 9
    assert set(by_template(spark, found, [])) == {("h.net", "/a/b/c/d/**")}


RULES = [urls.Rule("block", "h.net/ads/1"), urls.Rule("allow", "h.net/news/1"), urls.Rule("block", "spam.net/x/1")]


def test_labelled_branches_decide_their_unlabelled_urls(spark):
    found = [f"http://h.net/{a}/{i}" for a in ("ads", "news", "other") for i in range(100, 300)]
    seen = by_template(spark, found, RULES)
    rows = urls.judged(pages(spark, dict(enumerate(found))), RULES).collect()
    verdicts = {(r.path.split("/")[1], r.rule is None, r.verdict) for r in rows}
    assert ("ads", True, "block") in verdicts and ("ads", True, "allow") not in verdicts
    assert ("news", True, "allow") in verdicts and ("news", True, "block") not in verdicts
    assert ("other", True, "allow") in verdicts and ("other", True, "block") not in verdicts
    assert seen["h.net", "/ads/<n>"][0].startswith("/ads") and seen["h.net", "/other/<n>"][0] == "/"


def test_similar_branches_are_merged_into_their_parent(spark):
    found = [f"http://spam.net/x/{i}" for i in range(100, 150)] + [f"http://spam.net/x/{i}.html" for i in range(100, 150)]
    seen = by_template(spark, found, RULES)
    assert {b for b, _ in seen.values()} == {"/"} and {v for _, v in seen.values()} == {"block"}


def test_few_labels_do_not_reject(spark):
    seen = by_template(spark, ["http://h.net/ads/1", *[f"http://h.net/ads/{i}" for i in range(200, 260)], *[f"http://h.net/news/1{i}" for i in range(60)]], RULES)
    assert seen["h.net", "/ads/<n>"][1] in ("allow", "block")
    one = urls.judged(pages(spark, {1: "http://q.net/ads/2", 2: "http://q.net/ads/3"}), [urls.Rule("block", "q.net/ads/2")]).collect()
    assert {r.page_id: r.verdict for r in one} == {1: "block", 2: "allow"}


@pytest.mark.parametrize("text,host,path", [("org/", "org", "/"), ("Example.ORG/En/1", "example.org", "/En/1")])
def test_rules(text, host, path):
    rule = urls.Rule("allow", text)
    assert (rule.host, rule.path) == (host, path)


def plain_templates(rows, rules, depth=4, support=5, children=50, least=0.01, prior=2.0, z=1.96, reject_at=0.8):
    """(template, branch, share, verdict) of each (host, path), by walking every tree with loops."""

    def shape(path):
        parts = path.split("/")[1:]
        named = [re.sub("[0-9]+", "<n>", re.sub(r"\A[0-9a-fA-F-]{16,}\Z", "<hash>", p)) for p in parts[:depth]]
        return tuple(named + ["**"] if len(parts) > depth else named)

    def ruled(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")).verdict if fits else None

    template = {(h, shape(p)): shape(p) for h, p in rows}
    count = Counter((h, shape(p)) for h, p in rows)
    for level in range(depth):
        names, nodes = Counter(), defaultdict(set)
        for key, t in template.items():
            if len(t) > level:
                names[key[0], t[: level + 1]] += count[key]
                nodes[key[0], t[:level]].add(t[: level + 1])
        total = {k: sum(names[k[0], child] for child in v) for k, v in nodes.items()}
        for key, t in template.items():
            if len(t) > level:
                n, node = names[key[0], t[: level + 1]], (key[0], t[:level])
                if n < support or (len(nodes[node]) > children and n < least * total[node]):
                    template[key] = (*t[:level], "*", *t[level + 1 :])
    good, bad = Counter(), Counter()
    for h, p in rows:
        for size in range(len(template[h, shape(p)]) + 1):
            verdict = ruled(h, p)
            good[h, template[h, shape(p)][:size]] += verdict == "allow"
            bad[h, template[h, shape(p)][:size]] += verdict == "block"
    hosts = {h for h, _ in rows}
    all_good, all_bad = (sum(c[h, ()] for h in hosts) for c in (good, bad))
    corpus = (all_bad + 1) / (all_good + all_bad + 2)
    out = {}
    for host, path in rows:
        t = template[host, shape(path)]
        share = (bad[host, ()] + prior * corpus) / (good[host, ()] + bad[host, ()] + prior)
        branch = ()
        for size in range(1, len(t) + 1):
            g, b = good[host, t[:size]], bad[host, t[:size]]
            if g + b and abs(b / (g + b) - share) > z * (share * (1 - share) / (g + b)) ** 0.5:
                share, branch = (b + prior * share) / (g + b + prior), t[:size]
        own = "block" if share >= reject_at else "allow"
        out[host, path] = ("/" + "/".join(t), "/" + "/".join(branch), round(share, 9), ruled(host, path) or own)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_templates_branches_and_shares_against_loops(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.com", "b.a.com", "c.org", ""]
    rules = [urls.Rule("block", "a.com/bad/"), urls.Rule("allow", "a.com/good/"), urls.Rule("block", "c.org/x1"), urls.Rule("allow", "c.org/x")]
    first = ["bad", "bad", "good", "x1", "x2", "mixed", "n77", "0123456789abcdef0"]
    rows = []
    for _ in range(500):
        parts = [rng.choice(first)] + [rng.choice(["p", "q", f"id{rng.randrange(90)}", f"w{rng.choice('abcdefgh')}"]) for _ in range(rng.randrange(6))]
        rows.append((rng.choice(hosts[:3]), "/" + "/".join(parts)))
    pages = spark.createDataFrame([(i, f"https://{h}{p}?q", "t", 1.0) for i, (h, p) in enumerate(rows)], "page_id long, url string, template string, share double")
    wanted = plain_templates(rows, rules)
    found = urls.judged(pages, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.template, r.branch, round(r.share, 9), r.verdict) == wanted[r.host, r.path]
    assert any(r.rule is None and r.verdict == "block" for r in found)


def test_very_long_urls_and_clashing_columns(spark):
    long = "https://h.org/" + "a/" * 50_000 + "x" * 100_000
    names = "page_id long, url string, host string, path string, rule string, shape string, n int, good int, bad int, name string"
    rows = [(i, u, "h", "p", "r", "s", 1, 2, 3, "n") for i, u in enumerate([long, long + "?q=1", "https://h.org", None])]
    found = {r.page_id: r for r in urls.judged(spark.createDataFrame(rows, names), [urls.Rule("block", "h.org/a/")]).collect()}
    assert [found[i].verdict for i in range(4)] == ["block", "block", found[2].verdict, found[3].verdict]
    assert found[0].path == long[len("https://h.org") :] == found[1].path and found[3].host == ""
