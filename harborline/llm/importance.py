"""Target-distribution importance resampling over hashed word n-grams.

Texts are worked on as UTF-8 bytes: one 256-byte table lower-cases A-Z and turns
every separator into a blank, ``bytes.split`` yields the words, and the CRC-32 of
an n-gram is its prefix's CRC-32 carried on as the seed over " " and the next
word, so no n-gram is ever built.  Counters add up the buckets of the raw corpus
and of the target, once per map task; Spark sums them.  A document's weight is
the mean log ratio of its features' buckets, and adding Gumbel noise that only
depends on the identifier turns "take the highest" into sampling without
replacement in proportion to the weights.

Only bucket counts, at most ``buckets`` rows of two numbers, reach the driver.
The draw ranks by range partitions and running counts, so no task sorts the
whole table.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import UID, running_sums, with_uid
from harborline.session import materialize

# Digits, letters and all bytes of non-ASCII characters make words; everything else separates them.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def ngram_crcs(words: list[bytes], longest: int) -> Iterator[int]:
    """CRC-32 of every run of 1 to ``longest`` words, joined by one space."""
    level = list(map(crc32, words))
    found = [level]
    for n in range(1, longest):
        level = list(map(crc32, words[n:], map(crc32, repeat(b" "), level)))
        found.append(level)
    return chain.from_iterable(found)


def gumbel(seed: int, key: str) -> float:
    """-ln(-ln(u)) of a u in (0, 1) that seed and key determine."""
    h = int.from_bytes(hashlib.sha256(f"{seed}:{key}".encode()).digest()[:4], "big")
    return -math.log(-math.log((h + 0.5) / 4294967296))


def bucket_counts(texts: DataFrame, text: str, buckets: int, longest: int) -> DataFrame:
    """(bucket, n) of all whole texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                total.update(map(buckets.__rmod__, ngram_crcs(value.translate(WORD_TABLE).split(), longest)))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], ["bucket", "n"])

    rows = texts.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")).where("octet_length(t) > 0")
    return rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str, target_text: str, buckets: int, longest: int) -> list[int]:
    """Per bucket the floored thousandfold log ratio of target to corpus, one added to every bucket."""
    both = bucket_counts(docs, text, buckets, longest).withColumn("of_target", F.lit(False)).unionByName(
        bucket_counts(target, target_text, buckets, longest).withColumn("of_target", F.lit(True)))
    corpus, wanted = [0] * buckets, [0] * buckets
    for bucket, n, of_target in both.collect():
        (wanted if of_target else corpus)[bucket] = n
    s_all, t_all = float(sum(corpus) + buckets), float(sum(wanted) + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus, wanted)]


def weigh(docs: DataFrame, gains: list[int], key: str, text: str, longest: int, seed: int) -> DataFrame:
    """(key, n_words, n_features, weight, score) of every row."""
    buckets = len(gains)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = gains.__getitem__
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for name, value in zip(batch.column("name").to_pylist(), batch.column("t").to_pylist()):
                words = value.translate(WORD_TABLE).split()
                n = sum(max(0, len(words) - i) for i in range(longest))
                total = sum(map(gain_of, map(buckets.__rmod__, ngram_crcs(words, longest))))
                weight = total // n if n else 0
                out.append((len(words), n, weight, weight + math.floor(1000 * gumbel(seed, name))))
            columns = zip(*out) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(c, pa.int64()) for c in columns]], ["key", "n_words", "n_features", "weight", "score"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long, score long")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
                        buckets: int = 10_000, longest: int = 2, key: str = "doc_id", text: str = "text",
                        target_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_features, weight, score and rank.

    ``rank`` counts the drawn documents from 1: of the N documents with at least
    ``min_words`` words the floor(percent * N / 100) of highest score, ties to the
    smaller key; it is NULL for the rest.  NULL and empty texts have no features
    and weight 0.  A NULL key is drawn under the empty name and sorts before all
    others; rows that repeat key and text share weight and score and have ranks
    of their own.  Texts of any length are read whole, one at a time.  An empty
    corpus gives an empty result; an empty target gives every bucket the count
    one.  All other columns, whatever their names, are ignored.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must be between 0 and 100")
    gains = bucket_gains(docs, target, text, target_text, buckets, longest)
    scored = materialize(with_uid(weigh(docs, gains, key, text, longest, seed)), "weights")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    ordered = running_sums(
        able.withColumns({"_down": -F.col("score"), "_one": F.lit(1)}), ["_down", "key", UID], {"before": "_one"})
    rank = F.when(F.col("before") < drawn, F.col("before") + 1)
    columns = ["key", "n_words", "n_features", "weight", "score"]
    return ordered.select(*columns, rank.alias("rank")).unionByName(
        scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))
