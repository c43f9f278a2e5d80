"""URL rules, mixture, quality and license scans against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import license_scan, url_filters
from shelfwise.llm.license_scan import TEMPLATES, Library, scan
from shelfwise.llm.mixing import mix_sources, source_targets
from shelfwise.llm.quality_rules import base_failed, cover, judge_quality, rule_expression, text_statistics
from shelfwise.llm.queries import URL_RULES
from shelfwise.llm.url_filters import judge_urls
from tests.llm.helpers import CLASHES, empty, frame, plain, words

URLS = [
    None, "", "no scheme/net", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://a.b.net?x", "http://anet/", "http://net./",
    "http://example.net/en/", "http://EXAMPLE.net/en/x#y", "http://example.net/en", "http://x.example.net/EN/", "http://badexample.net/en/1",
    "https://example.com/de/?q", "https://sub.example.com/de/1", "https://example.com/fr/", "ftp://www.org/fr/a", "x://org/fr/", "x://org:80/fr/",
    "a://b://net/", "http://net\n/x", "http://u@net/x", "://net/", "http://" + "a." * 3000 + "net/" + "p" * 5000, "http://ÄB.NET/ß",
]


def judged(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_urls_equal_plain_python(spark):
    rows = [(k, u) for k, u in enumerate(URLS * 3)] + [(None, URLS[6]), (1, URLS[4])] + [(9, "http://hot.net/")] * 200
    pages = spark.createDataFrame(rows, "page_id long, url string").select("*", *[F.lit("x").alias(c) for c in CLASHES])
    more = [*URL_RULES, ("b.net", "", "allow"), ("org", "/f", "block")]
    for rules in (URL_RULES, more):
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = judge_urls(pages, table)
        assert plain(got.select("page_id", "host", "path", "rule", "verdict").collect()) == plain((k, *judged(u, rules)) for k, u in rows)
        assert set(pages.columns) <= set(got.columns)


def test_short_prefixes_meet_and_digests_confirm(spark, monkeypatch):
    """With one byte of the digest many rules share a prefix; the plan joins on nothing but the prefix."""
    many = [(f"h{i}.net", f"/p{i % 7}", "allow" if i % 3 else "block") for i in range(600)] + [("h5.net", "/p5", "block")]
    rows = [(k, f"http://a.h{k}.net/p{k % 5}x") for k in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame(many, "host string, path string, verdict string")
    plans = []
    monkeypatch.setattr(url_filters, "materialize", lambda df, label: (plans.append(df._jdf.queryExecution().toString()), df)[1])
    got = judge_urls(pages, rules, prefix_bytes=1).select("page_id", "host", "path", "rule", "verdict").collect()
    verdicts = {}
    for h, p, v in many:
        verdicts[h, p] = "block" if "block" in (v, verdicts.get((h, p))) else v
    single = [(h, p, v) for (h, p), v in verdicts.items()]
    assert plain(got) == plain((k, *judged(u, single)) for k, u in rows)
    keys = re.findall(r"Join \[([^\]]*)\], \[([^\]]*)\], Inner", plans[0].split("== Physical Plan ==")[1])
    assert keys and all(re.fullmatch(r"_short#\d+", k) for pair in keys for k in pair)


def test_no_urls_and_no_rules(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in judge_urls(pages, rules).collect()] == [(1, "http://a/b", "a", "/b", None, "allow")]
    some = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert judge_urls(pages.limit(0), some).collect() == []


def mixture(rows, weights=(3, 1, 2), budget=1.5, repeats=2):
    sizes = [len(words(t)) for _, t, _, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(sizes, rows) if r[3] == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    left, open_, target = budget * sum(sizes), list(sources), {}
    while True:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) >= repeats * total[s]]
        if not over:
            break
        for s in over:
            target[s] = repeats * total[s]
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    for s in open_:
        target[s] = left * weight[s] / sum(weight[x] for x in open_)
    return sizes, total, target


@pytest.mark.parametrize("seed", range(3))
def test_mixture_comes_near_its_targets(spark, seed):
    r = random.Random(seed)
    sources = ["a", "B", "ä", "z", None, "hot"]
    rows = [(k, " ".join(["w"] * r.randrange(1, 30)), "en", "hot" if r.random() < 0.4 else r.choice(sources)) for k in range(900)]
    rows += [(1000, None, None, "a"), (1001, "", "en", None), (1002, " \n", "en", "only blanks"), rows[0], rows[0], (None, "x y z", None, None)]
    sizes, total, target = mixture(rows)
    df = frame(spark, rows)
    got = mix_sources(df).collect()
    assert len(got) == len(rows) and plain(r[:3] for r in got) == plain((i, s, n) for (i, _, _, s), n in zip(rows, sizes))
    for s in total:
        mine = [x for x in got if x.source == s]
        assert all(x.source_size == total[s] and abs(x.target - target[s]) < 1e-6 and x.taken in (0, x.size, 2 * x.size) for x in mine)
        assert abs(sum(x.taken for x in mine) - target[s]) <= 60
    assert plain(mix_sources(df.repartition(7)).collect()) == plain(got)


def test_mixture_of_nothing(spark):
    assert mix_sources(empty(spark)).collect() == []
    blank = frame(spark, [(1, None, None, None), (2, "", None, "a")])
    assert [x.taken for x in mix_sources(blank).collect()] == [0, 0]
    assert source_targets(blank.select("source", F.lit(0).alias("size"))).count() == 2


QUALITY = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x y x y x y x", "l1 a\nl1 a\n\n \nl2\nl1 a", "é # * $ % & | < > ü", "a b c d a b c a b"]


def statistics(text):
    w, t = words(text), text or ""
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {k for i, x in enumerate(triples) if triples.count(x) > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_plain_python(spark):
    r = random.Random(2)
    some = [" ".join(r.choice("abcdefgh"[: r.randrange(1, 8)]) for _ in range(r.randrange(400))) for _ in range(60)]
    some += [" ".join(f"{r.randrange(90)}" for _ in range(700)), "wide " * 3000, "\n".join(["same line here"] * 40), "z" * 100000]
    rows = [(k, t, None, None) for k, t in enumerate(QUALITY + some)] + [(None, "a b c a b c", None, None), (0, None, None, None)]
    got = text_statistics(frame(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert plain(got.collect()) == plain((i, *statistics(t)) for i, t, *_ in rows)
    assert text_statistics(empty(spark)).collect() == []


def test_learned_rules_find_junk_and_keep_the_rest(spark):
    r = random.Random(5)
    rows, labels = [], []
    for k in range(900):
        w = [f"word{r.randrange(5000)}" for _ in range(80)]
        junk = k % 5 == 0
        if junk:
            w = [x + r.choice(["##", "!!"]) for x in w]
        rows.append((k, " ".join(w), None, None))
        if k % 10:
            labels.append((k, int(junk != (r.random() < 0.97)), 0))
    rows += [(2000, "too short", None, None), (2001, None, None, None), (2002, "one two three " * 40, None, None), (None, rows[0][1], None, None)]
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in judge_quality(frame(spark, rows), marks).collect()}
    assert [got[k].kept for k in range(900)] == [k % 5 != 0 for k in range(900)]
    assert [got[k].base_failed for k in (2000, 2001, 2002)] == [True] * 3 and not got[None].kept
    assert all(got[k].kept == (not got[k].base_failed and got[k].rule is None) for k in got)


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = frame(spark, [(1, "a few words " * 3 + " ".join(map(str, range(60))), None, None)])
    assert [x.kept for x in judge_quality(some, none).collect()] == [True]
    assert judge_quality(empty(spark), none).collect() == []
    assert cover([]) == [] and some.select(rule_expression([])).first()[0] is None and base_failed() is not None


def licenses(text):
    """(license, containment, first word) by looking at every window for every template."""
    cut = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", text or "")]
    shingles = [tuple(cut[i : i + 5]) for i in range(len(cut) - 4)]
    best = {}
    for name, template in TEMPLATES:
        w = [x.lower() for x in re.findall(r"[A-Za-z0-9]+", template)]
        own = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        size = 1 << (len(own) - 1).bit_length()
        for low in range(0, len(shingles), size):
            window = shingles[low : low + 2 * size]
            common = len(own & set(window))
            if 100 * common >= 75 * len(own):
                place = low + next(i for i, x in enumerate(window) if x in own)
                best[name] = max(best.get(name, (0, 0)), (common / len(own), -place))
    return [(name, share, -place) for name, (share, place) in best.items()]


def test_licenses_equal_a_look_at_every_window(spark):
    r = random.Random(7)
    rows = []
    for k in range(400):
        t = [f"w{r.randrange(300)}" for _ in range(r.randrange(120))]
        for _ in range(r.randrange(3)):
            name, text = r.choice(TEMPLATES)
            notice = text.split(" ")
            if r.random() < 0.5:
                notice[r.randrange(len(notice))] = "changed"
            at = r.randrange(len(t) + 1)
            t[at:at] = notice[: r.randrange(4, 60)]
        rows.append((k, r.choice(["\n", " ", ", "]).join(t), None, None))
    rows += [(900, None, None, None), (901, "", None, None), (902, "MIT", None, None), (None, TEMPLATES[0][1].upper(), None, None), rows[3], rows[3]]
    rows.append((903, " ".join(["pad"] * 20000) + " " + TEMPLATES[2][1], None, None))
    got = scan(frame(spark, rows))
    assert plain(got.collect()) == plain((i, *x) for i, t, *_ in rows for x in licenses(t))
    assert got.count() > 200 and scan(empty(spark)).collect() == []


def test_templates_need_five_words():
    with pytest.raises(ValueError):
        Library([("short", "four words are few")])
    assert hashlib and 1 - (1 - 0.176) ** license_scan.BANDS > 1 - 1e-6
