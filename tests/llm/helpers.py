"""Fixtures that several test modules share."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns that operators might use inside, to see that they don't clash.
CLASHES = ["size", "taken", "target", "host", "path", "rule", "verdict", "k1", "k2", "node", "root", "comp", "hash", "place", "score",
           "kept", "held_out", "predicted", "_text", "_row", "_id", "_tail", "_head", "_best", "n_words", "ids", "label", "vec", "unit"]


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, clash=True):
    """Documents (id, text, lang, source), with extra columns of unlucky names."""
    full = [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)
