"""Small tables with the awkward cases every operator must survive."""

import random

from pyspark.sql import types as T

# names that the operators use inside
CLASH = ["uid", "_uid", "key", "digest", "fp", "root", "node", "n", "spans", "runs", "begin", "host", "verdict", "_marks", "_simhash", "rank", "a.b"]


def document_schema(extra=()):
    return T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                         *[T.StructField(c, T.StringType()) for c in extra]])


def documents(spark, rows, extra=()):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *["x"] * len(extra)) for r in rows]
    return spark.createDataFrame(data, document_schema(extra))


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("a", "e", "io", "u") for c in ("n", "rt", "sh", "", "lo", "é", "ndo", "k", "ß")][:vocabulary]
    out = []
    while n > 0:
        k = min(n, r.randint(6, 14))
        out.append(" ".join(r.choice(words) for _ in range(k)).capitalize() + ".")
        n -= k
    return " ".join(out)


AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "..."), (None, "a row without an id"), (6, prose(6, 300)), (6, prose(6, 300)),
           (7, prose(6, 300)), (8, "x" * 50_000), (9, "word " * 9000), (10, prose(10, 6000)), (11, "İſß é́ 日本語 😀 <|endoftext|>'s")]
