"""Prefix trie and structure repair of conversations against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.prefix_trie import conversation_trie, end_digests, spliced, turn_sequences
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.structure_repair import _least_paths, _repaired, damaged, repair_structure, repaired_digests

TURNS = "conv_id long, turn long, role string, text string"
UNLUCKY = ("path", "len", "marks", "keys", "host", "key", "id", "place", "kind", "cost", "depth", "turns", "size", "fault")


def table(spark, rows):
    return spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in UNLUCKY})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    """{conversation: [(turn, role, text)]}: by turn, null first, then a hash of role and text."""
    out = {}
    for c, turn, role, text in rows:
        key = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
        out.setdefault(c, []).append(((turn is not None, turn or 0, key), turn, role or "", text or ""))
    return {c: [x[1:] for x in sorted(r, key=lambda x: x[0])] for c, r in out.items()}


def all_prefixes(sequences):
    """Every node by listing all prefixes of all sequences: [(conversation, [(role, text)])]."""
    members, ends = {}, {}
    for c, s in sequences:
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
        ends.setdefault(tuple(s), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p],
         sha(",".join(map(str, sorted(ends.get(p, []))))))
        for p, m in members.items()
    )


def nodes_of(trie):
    told = trie.nodes.join(end_digests(trie.ends), ["path", "depth"], "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:7], r[7] or sha("")) for r in told.select(*columns).collect())


def splice(by_conv):
    for c, rows in by_conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = by_conv.get(c - c % 100, [])[:h]
        yield c, [r[1:] for r in head + rows[h:]]


def random_turns(seed, letters="ab"):
    r = random.Random(seed)
    rows = []
    for c in range(120):
        n = r.choice([1, 2, 3, 5, 9, 30])
        same = r.random() < 0.3
        for t in range(n):
            role = "user" if t % 2 == 0 else "assistant"
            rows.append((c, t, role, "hot" if same else r.choice(letters) * r.choice([1, 1, 1, 4])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_all_prefixes(spark, seed):
    rows = random_turns(seed) + [(500, None, None, "x"), (500, 0, "user", None), (501, 3, "", ""), (None, 0, "user", "nobody's")]
    by_conv = in_order([r for r in rows if r[0] is not None])
    df = table(spark, rows)
    plain = [(c, [x[1:] for x in s]) for c, s in by_conv.items()]
    assert nodes_of(conversation_trie(turn_sequences(df))) == all_prefixes(plain)
    assert nodes_of(conversation_trie(spliced(turn_sequences(df)))) == all_prefixes(list(splice(by_conv)))


def test_long_unary_paths_and_nested_ends(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(40) for t in range(c)]  # each a prefix of the next
    rows += [(100 + c, t, "user", f"t{t}" if t < 3 * c else f"own {c}") for c in range(20) for t in range(70)]
    rows += [(1000 + c, 0, "user", "ÄÖ only turn") for c in range(300)]  # one conversation, many times
    plain = [(c, [x[1:] for x in s]) for c, s in in_order(rows).items()]
    trie = conversation_trie(turn_sequences(table(spark, rows)))
    assert nodes_of(trie) == all_prefixes(plain)
    assert trie.ends.count() == len(plain)
    keys = trie.nodes.where("depth > 0").select("turn_key").distinct()
    assert keys.count() == len({s for _, p in plain for s in p})


def test_trie_of_nothing(spark):
    assert nodes_of(conversation_trie(turn_sequences(table(spark, [])))) == []
    rows = [(1, 0, "user", "a")]
    idle = turn_sequences(table(spark, rows)).select("conv_id", F.slice("turns", 1, 0).alias("turns"))
    assert nodes_of(conversation_trie(idle)) == [(1, 0, -1, 1, 0, 1, 0, sha("1"))]


def damage(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(c, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def cheapest(faults, initials):
    """(cost, audit, roles) by trying every sequence of edits, at most one more insertion than needed in a row."""
    best = {}

    def to(state, role):
        if role == "s":
            return "s" if state == "" else None
        if role == "u":
            return "u" if state != "u" else None
        return "a" if state == "u" else None

    def walk(i, state, idle):
        """All (cost, audit, output) to the end; ``idle``: insertions since the last row."""
        if (i, state, idle) in best:
            return best[i, state, idle]
        ways = [(0, "", ())] if i == len(faults) and state in ("", "a") else []
        if idle < 3:
            for role in "ua":
                if to(state, role):
                    ways += [(3 + c, "I" + a, ((None, role), *o)) for c, a, o in walk(i, to(state, role), idle + 1)]
        if i < len(faults):
            ways += [(4 + c, "D" + a, o) for c, a, o in walk(i + 1, state, 0)]
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if initials[i] in ("s", "u", "a") and to(state, initials[i]):
                    ways += [(more + c, "K" + a, ((i, "keep"), *o)) for c, a, o in walk(i + 1, to(state, initials[i]), 0)]
                for role in "ua":
                    if to(state, role):
                        ways += [(3 + more + c, "R" + a, ((i, role), *o)) for c, a, o in walk(i + 1, to(state, role), 0)]
        least = min((w[0] for w in ways), default=0)
        best[i, state, idle] = sorted(w for w in ways if w[0] == least)[:1]
        return best[i, state, idle]

    return walk(0, "", 0)[0]


def plain_repair(rows):
    names = {"u": "user", "a": "assistant"}
    out = []
    for c, turns in in_order(rows).items():
        seen, faults = set(), []
        for _, role, text in turns:
            solid = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in turns]
        cost, audit, output = cheapest(faults, initials)
        lines = [f"{turns[i][1] if how == 'keep' else names[how]}:{turns[i][2] if i is not None else ''}" for i, how in output]
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *counts, illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


def repaired(df):
    repair = repair_structure(df)
    lines = {r[0]: r[1] for r in repaired_digests(repair.rows).collect()}
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return sorted(((*r, lines.get(r[0], sha(""))) for r in repair.conversations.select(*columns).collect()), key=repr)


def odd_turns(seed):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", "s", None, "user", "assistant"]
    texts = ["Fine.", "Yes!", "Why?", "cut off", " \t", "", None, "end. \n", "a.", "b.", "c.", "d.", "é", "…"]
    rows = [(c, r.choice([None, t, t, 2 * t, 0]), r.choice(roles), r.choice(texts)) for c in range(60) for t in range(r.randint(1, 7))]
    return rows + [(None, 1, "user", "No id."), (None, None, "assistant", "Here.")]


@pytest.mark.parametrize("seed", range(2))
def test_repair_equals_all_edits(spark, seed):
    rows = odd_turns(seed)
    assert repaired(table(spark, rows)) == plain_repair(rows)
    assert repaired(damaged(table(spark, rows))) == plain_repair(damage(rows))


def test_repair_of_long_and_hot_conversations(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(3000)] + [(2, 0, "user", "Same.")] * 500
    rows += [(3, t, "user", f"Question {t}?") for t in range(7)]
    got = {r[0]: r for r in repaired(table(spark, rows))}
    assert got[1][5:8] == (0, 0, "K" * 3000)
    assert got[2][3] == 499 and got[2][6:8] == (4 * 499 + 3, "K" + "D" * 499 + "I")  # the first one is no duplicate
    assert got[3][6:8] == plain_repair(rows[-7:])[0][6:8]


def test_repair_of_nothing(spark):
    assert repaired(table(spark, [])) == []


def test_ranked_paths_are_the_least():
    """Blocks of many conversations against the same conversations one by one, and by brute force."""
    r = random.Random(5)
    convs = [[(r.randrange(3), r.randrange(4)) for _ in range(r.randint(1, 8))] for _ in range(400)]
    flat = np.array([x for c in convs for x in c])
    first = np.append(0, np.cumsum([len(c) for c in convs]))
    costs, _, audits, edits = _repaired(flat[:, 0], flat[:, 1], first)
    for c, cost, audit, own in zip(convs, costs, audits, edits.to_pylist()):
        wanted = cheapest([("", "truncated", "blank")[k] for k, _ in c], ["suao"[i] for _, i in c])
        assert (cost, audit) == wanted[:2]
        assert [e["letter"] for e in own] == list(audit)
        assert re.fullmatch("(s?(ua)+)?", "".join("suao"[c[e["at"] - 1][1]] if e["letter"] == "K" else e["role"][0] for e in own if e["letter"] != "D"))


def test_ended_paths_come_first():
    there = np.zeros((4, 5), bool)
    target = np.tile(np.arange(4)[:, None], (1, 5))
    there[0, 3], target[0, 3], there[1, 3], target[1, 3], there[2, 1], target[2, 1], there[3, 0] = True, 1, True, 2, True, 3, True
    nodes, letters, lengths = _least_paths(there, target, np.array([1, 0, 3]))
    assert (nodes.tolist(), letters.tolist(), lengths.tolist()) == ([1, 2, 0, 1, 2], [3, 1, 3, 3, 1], [2, 3, 0])


def test_queries_name_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    ids = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    assert QUERIES["op13_structure_repair"](spark, sf).count() == ids
    root = QUERIES["op12_prefix_trie"](spark, sf).where("depth = 0").collect()
    assert [r.n_convs for r in root] == [ids]
