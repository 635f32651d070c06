"""Small document tables with the awkward cases."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """``rows`` of (doc_id, text) or (doc_id, text, source) as a documents table, with clashing columns on request."""
    data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(data, DOCS)
    if extra:
        for name in ("row", "pos", "block", "name", "size", "n", "k", "key", "token", "t1", "t2", "doc", "words", "score"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, sf, name):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
