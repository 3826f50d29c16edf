import math
import random

import pytest
from helpers import with_clashes

from assetrank.llm import url_filter
from assetrank.llm.catalog import URL_RULES, op2_path_template_tree

SF = "/root/testdata/sf0.1"


def by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule_by_hand(host, path):
    best = (None, None)
    for verdict, rule in URL_RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return best


def test_query_against_by_hand_rules(spark):
    urls = dict(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect())
    out = op2_path_template_tree(spark, SF).collect()
    assert sorted(r.page_id for r in out) == sorted(urls)
    for r in out:
        assert (r.host, r.path) == by_hand(urls[r.page_id])
        rule, verdict = rule_by_hand(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM", "http://x.com?q=/a", "ftp://com/a", "http://ÉA.net/es/1", "a://b://c/d", "http://EXAMPLE.com/en/", "http://www.example.com/en/x#y", "http://notexample.com/en/x", "http://h.net/fr", "http://h.net/fr/?x", "http://h.org/" + "/".join("abcdefghijklmnop"), "http://h.org/a\nb/c", "http://h.org//x///y/"]


def test_edges(spark):
    pages = spark.createDataFrame([(k % 12, u) for k, u in enumerate(URLS * 2)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (99, 1), (2, None)], "page_id long, good int")
    out = url_filter.judge_urls(with_clashes(pages), with_clashes(labels), URL_RULES).collect()
    assert sorted((str(r.url), r.host, r.path, str(r.rule)) for r in out) == sorted((str(u), *by_hand(u), str(rule_by_hand(*by_hand(u))[0])) for u in URLS * 2)
    assert url_filter.judge_urls(pages.limit(0), labels, URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, labels.limit(0), []).collect()} == {"allow"}


@pytest.fixture(scope="module")
def judged(spark):
    """A host whose /spam/ pages are bad, whose /en/ and /de/ pages are alike and good, and whose slugs are many."""
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(900):
        section = ("spam", "en", "de")[k % 3]
        slug = "".join(rng.choice("abcdefghij") for _ in range(8))
        rows.append((k, f"https://site.org/{section}/{slug}/page{k}"))
        if k % 2:
            good = rng.random() < (0.05 if section == "spam" else 0.95)
            labels.append((k, int(good)))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    return {r.page_id: r for r in url_filter.judge_urls(pages, spark.createDataFrame(labels, "page_id long, good int"), []).collect()}


def test_templates_generalise_merge_and_reject(judged):
    assert {judged[0].template, judged[1].template, judged[2].template} == {"/spam/*/page#", "/{de|en}/*/page#"}
    assert {r.verdict for k, r in judged.items() if k % 3 == 0} == {"block"}
    assert {r.verdict for k, r in judged.items() if k % 3} == {"allow"}


def test_purity_is_smoothed_towards_the_host(judged):
    bad, good = judged[0].purity, judged[1].purity
    assert 0.0 < bad < 0.2 and 0.85 < good < 1.0


def judged_sections(spark, sections):
    """Verdicts by section of one host: sections maps a name to (pages, labelled, good)."""
    rows, labels = [], []
    for name, (pages, labelled, good) in sections.items():
        for k in range(pages):
            if k < labelled:
                labels.append((len(rows), int(k < good)))
            rows.append((len(rows), f"https://site.org/{name}/page{k}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = url_filter.judge_urls(pages, spark.createDataFrame(labels, "page_id long, good int"), []).collect()
    return {name: {(r.template, r.verdict) for r in out if r.path.startswith(f"/{name}/")} for name in sections}


def letters(k):
    return "".join(chr(97 + int(d)) for d in f"{k:04d}")


def test_small_sections_with_other_labels_stay_apart(spark):
    sections = {letters(k): (100, 50, 48) for k in range(60)} | {"spam": (100, 50, 2), "mixed": (100, 50, 25)}
    out = judged_sections(spark, sections | {f"rare{letters(k)}": (1, 1, 1) for k in range(200)})
    assert out.pop("spam") == {("/spam/page#", "block")}
    assert {len(v) for v in out.values()} == {1} and {verdict for v in out.values() for _, verdict in v} == {"allow"}
    assert out["mixed"] == {("/mixed/page#", "allow")} and out["rareaaaa"] == {("/*/page#", "allow")}


def test_a_sparse_branch_links_no_groups(spark):
    out = judged_sections(spark, {"bad": (500, 500, 50), "few": (2, 2, 1), "good": (500, 500, 450), "none": (2, 0, 0)})
    assert {v for _, v in out["bad"]} == {"block"} and {v for _, v in out["good"]} == {"allow"}
    assert out["bad"] != out["none"] != out["good"]


def test_groups_of_branches():
    groups = lambda *b: sorted(url_filter.groups_of(list(b), 2.58))
    assert groups(("a", 50, 500), ("b", 1, 2), ("c", 450, 500)) in ([["a", "b"], ["c"]], [["a"], ["b", "c"]])
    assert groups(("a", 90, 100), ("b", 0, 0), ("c", 9, 10)) == [["a", "b", "c"]]
    assert groups(("a", 90, 100), ("b", 0, 0), ("c", 1, 100)) == [["a"], ["b"], ["c"]]
    tail = [(f"t{k}", k % 3, 2) for k in range(30)]
    split = groups(("a", 500, 5000), ("c", 4500, 5000), *tail)
    assert not any({"a", "c"} <= set(names) for names in split) and sorted(sum(split, [])) == sorted(["a", "c", *(t[0] for t in tail)])
    assert url_filter.group_label(["a", "b"], 3) == "{a|b}" and url_filter.group_label(["a", "b"], 2) == "*"


def verdicts(spark, urls, good):
    """template and verdict of each url; ``good`` is 1, 0 or None by url."""
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, g) for k, g in enumerate(good) if g is not None] + [(-1, 1)], "page_id long, good int")
    out = {r.page_id: (r.template, r.verdict) for r in url_filter.judge_urls(pages, labels, []).collect()}
    return [out[k] for k in range(len(urls))]


def test_deep_paths_are_judged_to_their_end(spark):
    urls = [f"http://h.org/a/b/c/d/e/f/g/h/{'spam' if k % 2 else 'good'}/p{k}" for k in range(400)]
    urls.append("http://h.org/" + "/".join(f"x{k}y" for k in range(3000)))  # a very long url of its own
    found = verdicts(spark, urls, [1 - k % 2 for k in range(400)] + [None])
    assert {v for k, (_, v) in enumerate(found[:400]) if k % 2} == {"block"}
    assert {v for k, (_, v) in enumerate(found[:400]) if not k % 2} == {"allow"}
    assert found[1][0] == "/a/b/c/d/e/f/g/h/spam/p#" and found[400][0].count("/") == 3000


def test_digits_generalise_by_evidence(spark):
    urls = [f"http://h.org/forum{1 + k % 2}/p{k}" for k in range(400)] + [f"http://h.org/year20{k:02d}/x" for k in range(20)]
    found = verdicts(spark, urls, [1 - k % 2 for k in range(400)] + [1] * 20)
    assert {f for k, f in enumerate(found[:400]) if k % 2} == {("/forum2/p#", "block")}
    assert {v for k, (_, v) in enumerate(found[:400]) if not k % 2} == {"allow"}
    assert len({t for t, _ in found[400:]}) == 1  # few labels each: one shape
    # below a literal segment the next level is looked at on its own
    urls = [f"http://h.org/v{k % 2}/s{(k // 2) % 2}/p{k}" for k in range(400)]
    found = verdicts(spark, urls, [int((k % 2, (k // 2) % 2) != (1, 0)) for k in range(400)])
    assert {v for k, (_, v) in enumerate(found) if (k % 2, (k // 2) % 2) == (1, 0)} == {"block"}
    assert {v for k, (_, v) in enumerate(found) if (k % 2, (k // 2) % 2) != (1, 0)} == {"allow"}


def plain_tree(urls, good, max_children=20, min_share=0.02, z=2.58, prior_weight=10.0, min_purity=0.5, min_labels=10):
    """The method over one host in plain Python, urls of letters only (no shapes): verdict by url."""

    def apart(g, n, g2, n2):
        if not n or not n2:
            return False
        p = (g + g2) / (n + n2)
        return abs(g / n - g2 / n2) > z * math.sqrt(p * (1 - p) * (1 / n + 1 / n2))

    def count(rows):
        return sum(1 for k in rows if good[k] == 1), sum(1 for k in rows if good[k] is not None)

    paths = [tuple(s for s in u.split("://")[1].split("/")[1:] if s) for u in urls]
    template = {}

    def descend(rows, done):
        below = {}
        for k in rows:
            if len(paths[k]) == len(done):
                template[k] = done
            else:
                below.setdefault(paths[k][len(done)], []).append(k)
        total = sum(map(len, below.values()))
        node_g, node_l = count([k for r in below.values() for k in r])
        few_g, few_l = count([k for r in below.values() if count(r)[1] < min_labels for k in r])
        pooled = {}
        for seg, r in below.items():
            g, n = count(r)
            tells = n >= min_labels and (apart(g, n, node_g - g, node_l - n) or apart(g, n, few_g, few_l))
            rare = len(below) > max_children and len(r) < total * min_share and not tells
            pooled.setdefault("*" if rare else seg, []).extend(r)
        for seg, r in pooled.items():
            descend(r, (*done, seg))

    descend(range(len(urls)), ())
    merged = {t: t for t in set(template.values())}
    for level in reversed(range(max(map(len, merged)))):
        families = {}
        for t, m in merged.items():
            if len(m) > level:
                families.setdefault((m[:level], m[level + 1 :]), {}).setdefault(m[level], []).append(t)
        for (before, after), branches in families.items():
            if len(branches) > 1:
                counted = [(b, *count([k for k, t in template.items() if t in ts])) for b, ts in branches.items()]
                for names in url_filter.groups_of(counted, z):
                    for name in names:
                        for t in branches[name]:
                            merged[t] = (*before, url_filter.group_label(names, len(branches)), *after)
    g, n = count(range(len(urls)))
    host = (g + prior_weight * (g / n if n else 1.0)) / (n + prior_weight)
    by = {}
    for k in range(len(urls)):
        by.setdefault(merged[template[k]], []).append(k)
    out = {}
    for rows in by.values():
        g, n = count(rows)
        for k in rows:
            out[k] = "block" if (g + prior_weight * host) / (n + prior_weight) < min_purity else "allow"
    return [out[k] for k in range(len(urls))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_verdicts_equal_a_plain_tree(spark, seed):
    """Urls without a rule, judged by the method alone."""
    rng = random.Random(seed)
    word = lambda size: "".join(rng.choice("ghijklmnop") for _ in range(size))
    sections = [word(4) for _ in range(30)]
    quality = {s: rng.choice([0.05, 0.5, 0.9]) for s in sections}
    urls, good = [], []
    for _ in range(1500):
        section = rng.choice(sections[: rng.choice([3, 30])])
        tail = [rng.choice([word(1), word(6)]) for _ in range(rng.randrange(4))]
        urls.append("http://one.org/" + "/".join([section, *tail]))
        good.append(int(rng.random() < quality[section]) if rng.random() < 0.4 else None)
    assert [v for _, v in verdicts(spark, urls, good)] == plain_tree(urls, good)
