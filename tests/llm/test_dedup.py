"""Near copies, repeated passages and vectors against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import minhash_dedup
from shelfwise.llm.components import components
from shelfwise.llm.embedding_dedup import close_pairs, similar_vectors
from shelfwise.llm.minhash_dedup import drop_near_duplicates, near_duplicates
from shelfwise.llm.substring_dedup import levels, remove_repeats
from shelfwise.llm.support import Scratch
from tests.llm.helpers import empty, frame, plain, words


def some_text(r, n, size=400):
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


def changed(r, text, share):
    return " ".join(f"x{r.randrange(10**6)}" if r.random() < share else w for w in text.split(" "))


def corpus(seed=3):
    """Copies, near copies at all distances, shared passages, odd and very long texts, hot groups."""
    r = random.Random(seed)
    rows, base = [], [some_text(r, n) for n in (5, 8, 40, 90, 300)]
    for t in base:
        rows += [t, t, t.upper(), t.replace(" ", "\n\t")]
        rows += [changed(r, t, s) for s in (0.005, 0.01, 0.02, 0.03, 0.05, 0.1) for _ in range(3)]
    passage = some_text(r, 60)
    rows += [some_text(r, 20) + " " + passage + " " + some_text(r, 15) for _ in range(40)]
    rows += [None, "", " \n\t ", "one", "one two", "one two three four", "one two three four", "a " * 200, "a b " * 90, "x" * 5000]
    rows += [some_text(r, 6000), " ".join(["nb", "sp"]) + "   é ß", passage]
    hot = some_text(r, 50)
    rows += [hot] * 60 + [changed(r, hot, 0.02) for _ in range(60)]
    out = [(i * 7 % 1009, t, "en", f"s{i % 3}") for i, t in enumerate(rows)]
    return out + [out[0], out[0], (None, rows[0], None, None), (None, "alone in the world and without id", None, None), (None, None, None, None)]


def groups(rows):
    """Per row: (set size, smallest id reachable), by comparing all."""
    sets = []
    for _, text, *_ in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    least = {}
    for i, row in enumerate(rows):
        least.setdefault(find(i), []).append(row[0])
    best = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(len(sets[i]), best[find(i)]) for i in range(len(rows))]


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "SET_BLOCK", 8)
    rows = corpus()
    got = near_duplicates(frame(spark, rows)).collect()
    want = [(row[0], n, c) for row, (n, c) in zip(rows, groups(rows))]
    assert plain((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    texts = {id(r): r for r in got if r.first}
    with_id = [r.component_id for r in texts.values() if r.component_id is not None]
    assert len(with_id) == len(set(with_id)) and set(with_id) == {c for _, c in groups(rows) if c is not None}


def test_near_duplicates_keep_one_of_each_group(spark):
    rows = corpus()
    kept = drop_near_duplicates(frame(spark, rows))
    assert "_row" in kept.columns and kept.columns == frame(spark, rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in groups(rows) if c is not None})
    assert ids.count(None) == 2  # the null text and the lonely one


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(empty(spark)).collect() == []
    assert drop_near_duplicates(empty(spark)).collect() == []


def test_bounds_of_the_estimate_hold_for_pairs_at_the_limit():
    r = np.random.default_rng(0)
    for n in (4, 20, 200):
        common = r.integers(0, 2**63, (400, 3 * n), dtype=np.uint64)
        extra = r.integers(0, 2**63, (400, 2 * n), dtype=np.uint64)
        for c, e in zip(common, extra):
            a, b = np.concatenate([c, e[: n // 2]]), np.concatenate([c, e[n // 2 : n]])
            x, y = (minhash_dedup.registers(s, np.array([0, len(s)]))[0] for s in (a, b))
            j, ok = minhash_dedup.estimate(np.array([float(len(a))]), np.array([float(len(b))]), np.array([(x > y).sum()]), np.array([(x < y).sum()]))
            assert ok[0] and abs(j[0] - 0.75) < 0.25


def repeats(rows, size):
    seen = {}
    for i, (_, text, *_) in enumerate(rows):
        w = words(text)
        for k in range(len(w) - size + 1):
            seen.setdefault(tuple(w[k : k + size]), []).append((i, k))
    gone = [set() for _ in rows]
    for at in seen.values():
        if len(at) > 1:
            for i, k in at:
                gone[i] |= set(range(k, k + size))
    out = []
    for (i, text, *_), g in zip(rows, gone):
        w = words(text)
        left = " ".join(x for k, x in enumerate(w) if k not in g)
        out.append((i, len(w), len(g), hashlib.sha256(left.encode()).hexdigest(), left if g else text or ""))
    return out


@pytest.mark.parametrize("size", [35, 4, 7, 16])
def test_repeats_equal_brute_force(spark, size):
    rows = corpus(size)
    got = remove_repeats(frame(spark, rows), window=size, with_text=True)
    assert plain(got.select("doc_id", "n_words", "n_removed", "kept_sha256", "cleaned").collect()) == plain(repeats(rows, size))


def test_repeats_of_few_words(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(60))), None, None) for i in range(150)]
    got = remove_repeats(frame(spark, rows), window=9)
    assert plain(tuple(x)[:4] for x in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == plain(x[:4] for x in repeats(rows, 9))


def test_repeats_of_nothing_and_levels(spark):
    assert remove_repeats(empty(spark)).collect() == []
    assert levels(35) == (9, 18, 35)
    with pytest.raises(ValueError):
        levels(3)


def linked(rows, threshold):
    import math

    def fine(v, label):
        return v is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, top = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, (_, v, label) in enumerate(rows):
        for b in range(a):
            w, other = rows[b][1], rows[b][2]
            if label == other and fine(v, label) and fine(w, other) and len(v) == len(w):
                cosine = sum(x * y for x, y in zip(v, w)) / math.sqrt(sum(x * x for x in v)) / math.sqrt(sum(y * y for y in w))
                if cosine >= threshold:
                    n[a], n[b] = n[a] + 1, n[b] + 1
                    top[find(a)] = find(b)
    least = {}
    for i, row in enumerate(rows):
        least.setdefault(find(i), []).append(row[0])
    best = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(row[0], n[i], best[find(i)]) for i, row in enumerate(rows)]


@pytest.mark.parametrize("threshold", [0.93, 0.6])
def test_vectors_equal_brute_force(spark, threshold):
    r = np.random.default_rng(4)
    rows = []
    for k in range(420):
        v = r.normal(size=12) * np.linspace(2, 0.2, 12)
        if k and k % 3 == 0:
            v = np.array(rows[k // 2][1]) + r.normal(0, 0.05, 12)
        rows.append((k, [float(x) for x in v], k % 2 if k % 5 else 0))
    rows += [(500 + k, rows[3][1], rows[3][2]) for k in range(70)] + [(600, [2 * x for x in rows[3][1]], rows[3][2])]
    rows += [(700, None, 1), (701, [0.0] * 12, 1), (702, [float("nan")] * 12, 1), (703, [float("inf")] + [1.0] * 11, 1), (704, [], 1)]
    rows += [(705, rows[3][1], None), (706, rows[3][1], None), (707, [None] + [1.0] * 11, 1), (None, rows[3][1], rows[3][2]), (None, [1.0, 2.0], 7)]
    rows += [(708, [1.0, 2.0], 7), (709, [-0.0, 1.0], 7), (710, [0.0, 1.0], 7), rows[5], (None, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("vec", F.lit(1)).withColumn("node", F.lit(1))
    got = similar_vectors(df, threshold=threshold, tile=16).collect()
    assert plain((x.vec_id, x.n_links, x.component_id) for x in got) == plain(linked(rows, threshold))
    assert all(x.kept == (x.vec_id == x.component_id) for x in got if x.vec_id is not None)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert similar_vectors(df).collect() == []
    with pytest.raises(ValueError):
        similar_vectors(df, threshold=0)


def test_bounds_lose_no_pair():
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 40)) * np.linspace(3, 0.1, 40)
    y = np.concatenate([x[:150] + r.normal(0, 0.2, (150, 40)), r.normal(size=(100, 40))])
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    i, j = close_pairs(x, y, 0.9)
    a, b = np.nonzero(x @ y.T >= 0.9)
    assert sorted(zip(i, j)) == sorted(zip(a, b)) and len(a) > 100


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    r = random.Random(kind)
    edges = {"path": [(k, k + 1) for k in range(300)], "star": [(7, k) for k in range(500)], "none": [(3, 3)]}.get(kind)
    edges = edges or [(r.randrange(400), r.randrange(400)) for _ in range(260)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), kind).collect()}
    top = {v: v for e in edges for v in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        top[find(a)] = find(b)
    assert set(got) == {v for a, b in edges if a != b for v in (a, b)}
    ours, theirs = {}, {}
    for v, root in got.items():
        ours.setdefault(root, set()).add(v)
        theirs.setdefault(find(v), set()).add(v)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def parity_word(n, other=False):
    """Letters a and b by the parity of the bits of their places: every polynomial modulo 2^64 takes it for its complement."""
    return "".join("ab"[(bin(i).count("1") + other) % 2] for i in range(n))


def test_texts_made_to_collide_stay_apart(spark):
    """Words of parity letters, and runs of two words in that order, under hashes modulo 2^61 - 1."""
    r = random.Random(8)
    rest = [f"w{k}" for k in range(40)]
    r.shuffle(rest)
    rows = [" ".join(x if i % 4 else word for i, x in enumerate(rest)) for word in (parity_word(1024), parity_word(1024, True))]
    for other in (False, True):
        rows.append(" ".join({"a": "left", "b": "right"}[c] for c in parity_word(2048, other)))
    table = [(k, t, "en", "s") for k, t in enumerate(rows)]
    assert all(x.kept for x in near_duplicates(frame(spark, table)).collect() if x.doc_id < 2)
    got = {x.doc_id: x.n_removed for x in remove_repeats(frame(spark, table[:2])).collect()}
    assert got == {0: 0, 1: 0}
    want = plain(x[:4] for x in repeats(table, 35))
    assert plain(tuple(x)[:4] for x in remove_repeats(frame(spark, table)).collect()) == want
