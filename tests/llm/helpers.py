"""Small document tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, rows, extra=()):
    rows = [(*r, None, None, None)[:5] if len(r) < 5 else r for r in rows]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    from pyspark.sql import functions as F

    for name in extra:
        df = df.withColumn(name, F.lit("clash"))
    return df


def prose(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def odd_rows(seed=0, n=30):
    """Prose with shared passages, copies, near copies and the odd cases."""
    rng = random.Random(seed)
    passage = prose(rng, 45)
    rows = []
    for i in range(n):
        words = prose(rng, rng.randrange(5, 120)).split()
        if i % 3 == 0:
            k = rng.randrange(len(words))
            words[k:k] = passage.split()
        rows.append((i, " ".join(words), ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], None))
    rows += [(100, rows[3][1], "en", "a", None), (101, rows[3][1], "en", "b", None)]
    rows += [(102, rows[6][1] + " more words at the end", "en", "a", None)]
    rows += [(103, None, None, None, None), (104, "", "en", "a", 0), (105, " \t\n ", "fr", "b", 4), (None, rows[0][1], "en", "a", None)]
    rows += [(106, "x" * 30000 + " " + "é" * 5000, "en", "a", None), (107, "again and " * 200, "en", "a", None)]
    rows += [rows[1], rows[1]]
    return rows
