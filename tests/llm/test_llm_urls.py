"""URL rules and the character models against plain versions."""

from __future__ import annotations

import math
import random

from tidemark.llm import urlfilter

SCHEMA = "page_id bigint, url string, html string, host string, text string, score double"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, None, "h", "t", 1.0) for i, u in enumerate(urls)], SCHEMA)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    for mark in "?#":
        path = path.split(mark)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [
        r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


ODD = [
    None,
    "",
    "no scheme.com/",
    "http://",
    "HTTP://WWW.Example.COM/en/x?y=1#z",
    "http://example.com/en/1",
    "http://www.example.com/en/1",
    "http://a.www.example.com/en/",
    "http://example.com/de/1",
    "http://notexample.com/en/",
    "http://com/",
    "http://x.com",
    "http://x.com?/en/",
    "http://a.net/es/://b.com/",
    "http://net/fr/",
    "http://É.Net/fr/1\nx",
    "http://a.org/#/en/",
    "x://a.org/" + "long/" * 3000,
]


def test_parts_and_rules_of_odd_urls(spark):
    got = {r.page_id: r for r in urlfilter.judged(pages(spark, ODD)).collect()}
    assert len(got) == len(ODD)
    for i, url in enumerate(ODD):
        host, path = plain_parts(url)
        assert (got[i].host, got[i].path) == (host, path)
        rule = plain_rule(host, path)
        assert got[i].rule == (rule.text if rule else None)
        if rule:
            assert got[i].verdict == rule.verdict
        assert got[i].verdict in ("allow", "block")


def test_nothing_to_judge(spark):
    assert urlfilter.judged(pages(spark, [])).count() == 0


def test_repeated_pages_and_a_score_on_the_threshold(spark):
    # Without ruled urls there is no model: all score 0, which is the threshold.
    urls = ["http://a.org/x", "http://a.org/x", "http://b.org/y", None]
    found = urlfilter.judged(pages(spark, urls).unionByName(pages(spark, urls[:1]))).collect()
    assert len(found) == 5
    assert all((r.score, r.threshold, r.verdict) == (0.0, 0.0, "allow") for r in found)


def plain_model(texts, order, least, strength):
    counts = {}
    for text, kind in texts:
        padded = "\x02" * order + text + "\x03"
        for at in range(order, len(padded)):
            for k in range(order + 1):
                counts.setdefault(padded[at - k : at + 1], [0, 0])[kind] += 1
    seen = {g: c for g, c in counts.items() if sum(c) >= least}
    totals = {}
    for g, c in seen.items():
        total = totals.setdefault((len(g), g[:-1]), [0, 0])
        total[0], total[1] = total[0] + c[0], total[1] + c[1]

    def chance(g, kind):
        below = chance(g[1:], kind) if len(g) > 1 else 1 / urlfilter.ALPHABET
        return (seen[g][kind] + strength * below) / (totals[len(g), g[:-1]][kind] + strength)

    def score(text):
        padded, total = "\x02" * order + text + "\x03", 0.0
        for at in range(order, len(padded)):
            for k in range(order, -1, -1):
                g = padded[at - k : at + 1]
                if g in seen:
                    total += math.log(chance(g, 0)) - math.log(chance(g, 1))
                    break
        return total / (len(text) + 1)

    return score


def test_scores_against_a_plain_model(spark):
    rng = random.Random(7)
    texts = [("".join(rng.choice("abcd/") for _ in range(rng.randint(0, 12))), rng.randint(0, 1)) for _ in range(120)]
    texts = list(dict(texts).items())
    table = spark.createDataFrame([(t, int(k == 0), int(k == 1)) for t, k in texts], "text string, allowed int, blocked int")
    asked = [t for t, _ in texts] + ["zzz", "a" * 50]
    wanted = spark.createDataFrame([(t,) for t in asked], "text string").distinct()
    got = {r.text: r.score for r in urlfilter.scores(wanted, urlfilter.train(table, order=3), order=3).collect()}
    plain = plain_model(texts, 3, urlfilter.LEAST_COUNT, urlfilter.STRENGTH)
    assert len(got) == len(set(asked))
    for text, score in got.items():
        assert abs(score - plain(text)) < 1e-6


def test_models_tell_ruled_urls_apart(spark):
    rng = random.Random(9)
    urls = [f"http://{rng.choice('abcde')}{rng.choice('xyz')}.com/shop/{rng.randint(0, 999)}" for _ in range(150)]
    urls += [f"http://{rng.choice('abcde')}{rng.choice('xyz')}.net/fr/casino{rng.randint(0, 999)}" for _ in range(150)]
    urls += ["http://ax.org/shop/5", "http://ax.org/fr/casino7"]
    got = {r.page_id: r for r in urlfilter.judged(pages(spark, urls)).collect()}
    assert got[300].verdict == "allow" and got[301].verdict == "block"
    assert got[300].score > got[300].threshold > got[301].score


def test_ruled_urls_are_scored_too(spark):
    urls = [f"http://{a}{b}.com/shop/{n}" for a in "abcde" for b in "xyz" for n in "ab"]
    urls += [f"http://{a}{b}.net/fr/casino{n}" for a in "abcde" for b in "xyz" for n in "ab"]
    got = urlfilter.judged(pages(spark, urls)).collect()
    assert len(got) == len(urls) and all(r.rule is not None and r.score is not None for r in got)
    right = [(r.score > r.threshold) == (r.verdict == "allow") for r in got]
    assert sum(right) > 0.9 * len(right)


def test_scores_of_long_texts(spark):
    long = "/".join(f"part{k % 97}" for k in range(30_000))
    texts = [("a.com/x", 0), ("a.com/xy", 0), ("b.net/part1/part2", 1), ("b.net/part1/part3", 1)]
    table = spark.createDataFrame([(t, int(k == 0), int(k == 1)) for t, k in texts], "text string, allowed int, blocked int")
    edge = urlfilter.PIECE
    asked = [long, *(long[:n] for n in (edge - 1, edge, edge + 1, 2 * edge))]
    wanted = spark.createDataFrame([(t,) for t in asked], "text string")
    got = {r.text: r.score for r in urlfilter.scores(wanted, urlfilter.train(table, order=3), order=3).collect()}
    plain = plain_model(texts, 3, urlfilter.LEAST_COUNT, urlfilter.STRENGTH)
    assert len(got) == len(asked)
    for text, score in got.items():
        assert abs(score - plain(text)) < 1e-6
