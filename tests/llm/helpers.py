"""Small documents with every awkward case, and the word contract in plain Python."""

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names the operators use inside themselves.
    T.StructField("_uid", T.StringType()), T.StructField("key", T.StringType()), T.StructField("n", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("_sha", T.StringType()), T.StructField("row", T.StringType()),
])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def awkward(seed=1, many=60):
    rng = random.Random(seed)
    vocabulary = ["the", "and", "Über", "señor", "l'été", "don't", "12,5", "x", "tion", "ing", "é", "ΣΑΣ", "日本語", "a\x1cb", " "]
    texts = [None, "", " ", "\n\t \r\n", "one", "one two", "A a A a", "<|endoftext|> x", "same text", "same text", "same text"]
    for _ in range(many):
        n = rng.choice([1, 3, 12, 60, 400])
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for _ in range(n)))
    base = " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(400))
    for i in range(12):
        changed = base.split(" ")
        changed[rng.randrange(400)] = f"edit{i}"
        texts.append(" ".join(changed))
    texts.append("long " + "word%d " * 5000 % tuple(range(5000)))
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 7 == 3 else f"src{i % 3}" if i % 2 else "src0"
        rows.append((i * 3 % 101, text, ["en", "de", None][i % 3], source, len(text or ""), "u", "k", "n", "f", "s", "r"))
    rows.append(rows[4])
    rows.append((None, "null key", "en", None, 8, None, None, None, None, None, None))
    rows.append((None, "same text", "en", "src1", 9, None, None, None, None, None, None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5) if rows else spark.createDataFrame([], SCHEMA)
