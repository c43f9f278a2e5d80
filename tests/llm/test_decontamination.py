"""Benchmark passages against plain Python over all windows."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.llm.decontamination import find_passages
from shelfwise.llm.queries import QUERIES
from tests.llm.helpers import empty, frame

ITEM = "item_id long, text string"


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and (c.isdigit() or "a" <= c <= "z") or ord(c) > 127 else " " for c in low).split(" ")


def plain_words(text):
    return [w for w in split(text) if w]


def grams(w, width):
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def expected(docs, items, window=10, shingle=5, containment=1.0):
    passages = set()
    for item, text in items:
        w = plain_words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            passages.add((item, tuple(w[i : i + window])))
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for item, p in passages:
            for i in range(len(w) - len(p) + 1):
                here = w[i : i + len(p)]
                if containment >= 1:
                    same = tuple(here) == p
                else:
                    theirs = grams(p, min(shingle, len(p)))
                    same = len(theirs & grams(here, min(shingle, len(p)))) >= containment * len(theirs) - 1e-9
                if same:
                    hit |= set(range(i, i + len(p)))
                    found |= {str(item)} if item is not None else set()
        spans = [x for x in sorted(hit) if x - 1 not in hit], [x for x in sorted(hit) if x + 1 not in hit]
        out.append((doc, len(w), len(hit), list(zip(*spans)), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "n_words", "n_hit", "spans", "items", "contaminated").collect()
    return sorted(((r[0], r[1], r[2], [tuple(s) for s in r[3]], list(r[4]), r[5]) for r in rows), key=repr)


def tables(spark, docs, items):
    d = frame(spark, [(i, t, "en", "a") for i, t in docs]).withColumns({c: F.lit("x") for c in ("words", "h", "place", "items")})
    b = spark.createDataFrame(items, ITEM).withColumns({c: F.lit(1) for c in ("item", "passage", "words", "h")})
    return d, b


@pytest.mark.parametrize("seed,containment", [(0, 1.0), (1, 1.0), (2, 0.75), (3, 0.5)])
def test_equal_to_all_windows(spark, seed, containment):
    r = random.Random(seed)
    text = lambda n, letters: " ".join(r.choice(letters) for _ in range(n))
    items = [(k, text(r.randint(1, 25), "ab" if k % 3 else "abcdÉ")) for k in range(12)]
    items += [(3, "x y z"), (None, "no id but words of some length here and more of it"), (40, None), (41, " .,- "), (42, "One"), (43, "ÀB Öl")]
    docs = [(k, text(r.randint(0, 120), "ab" if k % 2 else "abcdÉ")) for k in range(30)]
    docs += [(100 + k, "pre " + (items[k % 12][1] or "").upper().replace("É", "É") + ", post") for k in range(12)]
    docs += [(None, None), (None, ""), (7, "x-y-z"), (7, "x-y-z"), (8, "no id but words of some length here and more of it"), (9, "one"), (10, "àb öl ÀB ÖL Àb öL")]
    docs += [(11, "a " * 4000 + " ".join(items[1][1].split()))]
    d, b = tables(spark, docs, items)
    assert got(find_passages(d, b, containment=containment)) == expected(docs, items, containment=containment)


def test_same_shingles_in_another_order_are_no_passage(spark):
    docs, items = [(1, "b a " * 5), (2, "a b " * 5)], [(5, "a b " * 5)]
    d, b = tables(spark, docs, items)
    assert [r[2] for r in got(find_passages(d, b))] == [0, 10]
    assert [r[2] for r in got(find_passages(d, b, containment=0.99))] == [10, 10]


def test_a_frequent_passage_and_copies(spark):
    hot = " ".join(f"w{k}" for k in range(12))
    docs = [(k, f"start {k} {hot} end {k}" if k % 3 == 0 else f"other words of document {k}") for k in range(300)] + [(5, hot)] * 40
    items = [(k, hot) for k in range(60)] + [(99, "rare " + hot)]
    d, b = tables(spark, docs, items)
    assert got(find_passages(d, b)) == expected(docs, items)


def test_empty_tables(spark):
    d, b = tables(spark, [(1, "some words")], [(1, "some words")])
    assert got(find_passages(empty(spark), b)) == []
    assert got(find_passages(d, b.limit(0))) == [(1, 2, 0, [], [], False)]


def test_no_python_worker(spark):
    plan = QUERIES["op11_decontamination"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
