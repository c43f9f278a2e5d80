"""Tokens against the tiktoken library, learned models on held-out rows, the pipeline as a whole."""

import base64
import hashlib
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import language_id, toxicity
from shelfwise.llm.bpe import PerfectHash, Vocabulary, decode_ids, encode_texts
from shelfwise.llm.queries import QUERIES, RANKS, TOKENIZERS
from tests.llm.helpers import empty, frame, plain

SF = "/root/testdata/sf0.01"
PATH = f"{TOKENIZERS}/{RANKS}"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    sys.path.insert(0, os.path.dirname(TOKENIZERS))
    import public_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    r = random.Random(1)
    parts = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "a", "Z", "12", "!", "é", "中", "\u00a0", "x'll", "'S", "🎉", "\x1c", "\u0301", "<|endoftext|>"]
    out = ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(4000)]
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    out += ["".join(f"a{c}{c}1 {c}b" for c in every[k : k + 64]) for k in range(0, len(every), 640)]
    return out + ["", "x" * 30000, "ab" * 9000, " " * 5000, "word " * 20000]


def test_ids_equal_the_library(spark, library):
    texts = odd_texts()
    rows = [(k, t, None, None) for k, t in enumerate(texts)] + [(None, "no id", None, None), (3, texts[3], None, None), (-1, None, None, None)]
    got = encode_texts(frame(spark, rows), PATH, with_ids=True)
    want = []
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (t or "").encode())]
        want.append((i, len(ids), *digest, ids))
    assert plain(got.collect()) == plain(want)
    back = decode_ids(got.where("doc_id >= 0").select("doc_id", "ids"), PATH).collect()
    assert plain((x.doc_id, bytes(x.bytes).decode()) for x in back) == plain((i, t) for i, t, *_ in rows if i is not None and i >= 0)


def test_query_equals_the_library_on_all_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op6_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_no_texts_to_encode(spark):
    assert encode_texts(empty(spark), PATH).collect() == []


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    assert sorted(PerfectHash(keys)(keys)) == list(range(n))


def test_vocabulary_needs_every_byte_only_where_used():
    content = b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)) + b"\n" + base64.b64encode(b"ab") + b" 256"
    v = Vocabulary(content)
    assert v.merge(b"abab") == [256, 256] and v.merge(b"aab") == [97, 256]


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op2_language_id"](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == docs.count()
    told = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right, least, most = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right > 0.97 and 0 <= least and most <= 1


def test_language_of_odd_rows(spark):
    texts = {"en": "the cat and the dog are over there ", "de": "der Hund und die Katze sind dort drüben ", "xx": "zzq qqz zqz qzz zzzz qqqq "}
    rows = [(k, t * (1 + k % 5), lang, None) for k, (lang, t) in enumerate(list(texts.items()) * 30)]
    rows += [(900, None, "en", None), (901, "", None, None), (902, "12 + 34 = 46", "en", None), (None, texts["de"], None, None), rows[1], rows[1]]
    rows += [(903, texts["de"] * 4000, None, None), (904, "a", None, None)]
    got = language_id.identify(frame(spark, rows))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "unseen", "foreign"]
    told = {x.doc_id: x for x in got.collect()}
    assert got.count() == len(rows) and all(told[k].lang_pred == rows[k][2] for k in range(90))
    assert [(told[k].lang_pred, told[k].score) for k in (900, 901, 902)] == [("und", 0.0)] * 3
    assert told[None].lang_pred == told[903].lang_pred == "de" and told[None].held_out is False
    assert plain(got.collect()) == plain(language_id.identify(frame(spark, rows).repartition(5)).collect())


def test_language_with_nothing_to_learn(spark):
    assert language_id.identify(empty(spark)).collect() == []
    got = language_id.identify(frame(spark, [(1, "some words", None, None)])).collect()
    assert [(x.lang_pred, x.score) for x in got] == [("und", 0.0)]


def test_training_rows_bear_their_own_language(spark):
    """Rows without a language, or with another one, never lend their texts to a chosen id."""
    rows = [(k, f"named text number {k} of this kind", "en", None) for k in range(40)]
    rows += [(k, f"nameless stranger {k}", None, None) for k in range(40)] + [(k, f"fremder Satz {k}", "de", None) for k in range(40)]
    got = language_id.training_windows(frame(spark, rows), "doc_id", "text", "lang", 100, 2, 4).collect()
    assert {(x._lang, x.window.split()[0]) for x in got} == {("en", "named"), ("de", "fremder")}
    repeated = frame(spark, [(1, f"text {k} of one id", "en", None) for k in range(50)] + [(5, "one more", "fr", None)])
    few = [sorted(x.window for x in language_id.training_windows(repeated.repartition(n), "doc_id", "text", "lang", 9, 2, 4).collect()) for n in (1, 4)]
    assert few[0] == few[1] and len(few[0]) <= 2 * language_id.SPOTS
    assert len({x._lang for x in language_id.training_windows(frame(spark, rows), "doc_id", "text", "lang", 9, 2, 4, languages=1).collect()}) == 1
    small = language_id.training_windows(frame(spark, rows), "doc_id", "text", "lang", 100, 2, 4, total=10)
    assert small.select("_id", "_lang").distinct().count() <= 10


#: The first article of the Universal Declaration of Human Rights, or its beginning, in languages without documents.
STRANGERS = [
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
]


def test_language_stage_rejects_what_it_did_not_learn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    planted = frame(spark, [(-1 - k, t, None, None) for k, t in enumerate(STRANGERS)] + [(-100 - k, 40 * f"{t} ", None, None) for k, t in enumerate(STRANGERS)], clash=False)
    short = docs.where("lang is not null").selectExpr("doc_id - 100000 as doc_id", "substring(text, 1, 40) as text", "lang", "source", "40L as n_chars")
    both = docs.unionByName(planted.select(docs.columns)).unionByName(short.select(docs.columns))
    kept = {x.doc_id for x in dict(corpus_pipeline.STAGES)["language_id"](spark, both, SF).select("doc_id").collect()}
    assert not {-1 - k for k in range(len(STRANGERS))} & kept and not {-100 - k for k in range(len(STRANGERS))} & kept
    lettered = {x.doc_id for x in both.where("doc_id >= 0 or doc_id < -1000").where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert kept == lettered


def test_network_equals_a_plain_loop():
    """Convolution, pooling and softmax over some windows, and a training step that lowers the loss."""
    windows = ["some words of a text", "ein Satz mit Wörtern", "zzz qqq", "ab"]
    network = language_id.learn(list(zip(["en", "de", "xx", "en"], windows)), epochs=3)
    rows = np.full((len(windows), language_id.WINDOW + network.width - 1), language_id.PAD, np.int16)
    for k, w in enumerate(windows):
        rows[k, : len(w.encode())] = list(w.encode())
    for k, w in enumerate(windows):
        pooled, data = [], [*w.encode(), *[None] * network.width]
        for f in range(len(network.bias)):
            width = language_id.WIDTHS[f // language_id.FILTERS]
            best = max(sum(float(network.tables[i, data[at + i], f]) for i in range(width) if data[at + i] is not None) for at in range(len(w.encode())))
            pooled.append(max(best + float(network.bias[f]), 0.0))
        z = [sum(p * float(o) for p, o in zip(pooled, network.out[:, k2])) + float(network.offset[k2]) for k2 in range(len(network.languages))]
        e = [np.exp(x - max(z)) for x in z]
        assert np.allclose(network.probabilities(rows)[k], np.array(e) / sum(e), atol=1e-4)


def test_pair_products_equal_a_plain_sum():
    r = np.random.default_rng(3)
    machine = toxicity.Machine(np.arange(30))
    machine.weights[1:], machine.factors[1:], machine.bias = r.normal(size=30), r.normal(size=(30, toxicity.FACTORS)), 0.2
    texts = [r.permutation(30)[:n] for n in (0, 1, 2, 7, 30)]
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    got = machine.scores(np.concatenate(texts), first)
    for t, g in zip(texts, got):
        v, w = machine.factors[t + 1], machine.weights[t + 1]
        x = 0.2 + w.sum() + sum(v[i] @ v[j] for i in range(len(t)) for j in range(i))
        assert abs(g - 1 / (1 + np.exp(-np.clip(x, -40, 40)))) < 1e-12


def test_letter_runs_equal_a_plain_loop():
    r = random.Random(5)
    texts = ["".join(r.choice("abZé 1\n") for _ in range(r.randrange(9))) for _ in range(200)]
    data, offsets = language_id._flat(texts)
    want = []
    for k, t in enumerate(texts):
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
        want += [(k, raw[i : i + 3]) for i in range(len(raw) - 2) if all(97 <= b <= 122 or b > 127 for b in raw[i : i + 3])]
    runs, doc = language_id.letter_runs(data, offsets)
    assert [(int(d), int(x).to_bytes(3, "big")) for x, d in zip(runs, doc)] == want


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.6 and n.get((0, 1), 0) / n[0, 0] < 0.01


def test_pairs_of_terms_count_more_than_both_alone(spark):
    r = random.Random(3)
    rows, labels = [], []
    for k in range(3000):
        insult, group = r.random() < 0.5, r.random() < 0.5
        w = [f"w{r.randrange(40)}" for _ in range(20)] + ["insult"] * insult + ["group"] * group
        r.shuffle(w)
        rows.append((k, " ".join(w), None, None))
        labels.append((k, 1, int(insult and group)))
    probe = [(9001, "insult", None, None), (9002, "group", None, None), (9003, "Insult, GROUP!", None, None), (9004, None, None, None), (9005, "", None, None), (None, "insult group", None, None)]
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, 1), (4, 1, None), (5, 1, 7)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(frame(spark, [*rows, *probe, rows[0]]), marks)
    told = {x.doc_id: x for x in got.collect()}
    assert got.count() == len(rows) + 7 and got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert told[9003].predicted == told[None].predicted == 1 and told[9001].predicted == told[9002].predicted == 0
    assert told[9004].score == told[9005].score < 0.5 and told[None].held_out is False
    held = [k for k in range(3000) if told[k].held_out]
    assert sum(told[k].predicted == labels[k][2] for k in held) / len(held) > 0.97


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(empty(spark), none).collect() == []
    assert [x.score for x in toxicity.score_toxicity(frame(spark, [(1, "a", None, None)]), none).collect()] == [0.0]


def test_pipeline_keeps_what_it_should(spark, library):
    """Stage by stage: rows, columns, and what each stage may and may not drop."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "substring_dedup", "mixing", "byte_bpe"]
    known = stages["language_id"](spark, docs, SF).cache()
    assert known.columns == docs.columns and known.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    single = stages["near_duplicates"](spark, known, SF).cache()
    least = QUERIES["op9_minhash"](spark, SF).where("kept")
    assert single.columns == docs.columns and single.join(least, "doc_id").count() == single.count() == least.count()
    clean = stages["substring_dedup"](spark, single, SF).cache()
    assert clean.count() == single.count() and clean.columns == docs.columns
    same = clean.join(single.select("doc_id", F.col("text").alias("before")), "doc_id").where("text = before").count()
    assert same > 0.5 * clean.count()
    mixed = stages["mixing"](spark, clean, SF).cache()
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    coded = stages["byte_bpe"](spark, mixed, SF)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    rows = coded.collect()
    assert len(rows) == mixed.count() and all(x.ids == library.encode_ordinary(texts[x.doc_id]) for x in rows)


def test_pipeline_runs_as_one_query(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "some words of english text here", None, None), (3, "the end", "en", "b"), (3, "the end", "en", "b")]
    for docs in (frame(spark, rows, clash=False), frame(spark, rows), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs_out = stage(spark, docs, SF)
            assert docs_out.count() <= 2 * docs.count()
