"""Language identification by unigram pieces, marginalised over segmentations.

Words (runs of letters, lower-cased, with a leading space, UTF-8) are sequences
of pieces of a fixed public vocabulary.  Per language every piece has a
probability, and a word's probability is the sum over all its segmentations,
computed by the forward algorithm.  Probabilities are fitted by expectation
maximisation: Spark runs the E-step over distinct (language, word) counts, the
M-step normalises at most vocabulary x languages sums on the driver.  A text goes
to the language with the largest product over all its words.

Distinct words are scored once per worker; the cache only affects speed.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from harborline.session import materialize

LONGEST_PIECE = 8     # bytes
LONGEST_WORD = 64     # letters; longer runs are cut into parts of so many, none is left out
CACHE_WORDS = 1_000_000


class Pieces:
    """Look-up of byte strings of a rank file, all lengths up to LONGEST_PIECE, single bytes always included."""

    def __init__(self, vocabulary: str):
        import public_tokenizers

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            found = {base64.b64decode(line.split()[0]) for line in lines}
        found = {p for p in found if len(p) <= LONGEST_PIECE and p.decode("utf-8", "ignore").lower().encode() == p}
        found |= {bytes([b]) for b in range(256)}
        self.keys, self.first, self.count = [], [], 0
        for size in range(1, LONGEST_PIECE + 1):
            keys = np.sort(np.array([int.from_bytes(p, "big") for p in found if len(p) == size], dtype=np.uint64))
            self.keys.append(keys)
            self.first.append(self.count)
            self.count += len(keys)

    def spans(self, letters: np.ndarray) -> list[np.ndarray]:
        """For words of one length, an (n, length) byte matrix: per piece size the piece that ends at each byte, or ``count``."""
        out, key = [], np.zeros(letters.shape, dtype=np.uint64)
        for size in range(1, LONGEST_PIECE + 1):
            if size > letters.shape[1]:
                break
            # key[:, i]: the ``size`` bytes up to and including byte i; only i >= size - 1 is meant.
            key = letters.astype(np.uint64) if size == 1 else (np.roll(key, 1, axis=1) << np.uint64(8)) | letters
            keys = self.keys[size - 1]
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = keys[at] == key if len(keys) else np.zeros(key.shape, dtype=bool)
            hit[:, :size - 1] = False
            out.append(np.where(hit, at + self.first[size - 1], self.count))
        return out

    def forward(self, spans: list[np.ndarray], p: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(log probability (n, languages), scaled forward values); p: (count + 1, languages), last row 0."""
        n, length = spans[0].shape
        alpha = [np.ones((n, p.shape[1]))]
        log = np.zeros((n, p.shape[1]))
        for i in range(length):
            total = sum(alpha[i - size] * p[spans[size][:, i]] for size in range(min(len(spans), i + 1)))
            if (i + 1) % 16 == 0:   # rescale before values underflow
                log += np.log(total)
                for j in range(max(0, i + 2 - LONGEST_PIECE), i + 1):
                    alpha[j] = alpha[j] / total
                total = np.ones_like(total)
            alpha.append(total)
        return log + np.log(alpha[-1]), alpha

    def expected(self, letters: np.ndarray, counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected piece counts of one language's words of one length; p: (count + 1,)."""
        spans, p = self.spans(letters), p[:, None]
        _, alpha = self.forward(spans, p)
        n, length = letters.shape
        beta = [np.zeros((n, 1)) for _ in range(length)] + [np.ones((n, 1))]
        out = np.zeros(self.count + 1)
        for i in range(length - 1, -1, -1):
            beta[i] = sum(p[spans[size][:, i + size]] * beta[i + size + 1] for size in range(len(spans)) if i + size < length)
        # Forward values are rescaled; the share of a piece among all that end at a byte, times that byte's posterior, is not.
        reach = [np.zeros((n, 1)) for _ in range(length)] + [np.ones((n, 1))]
        for i in range(length - 1, -1, -1):
            parts = [alpha[i - size] * p[spans[size][:, i]] for size in range(min(len(spans), i + 1))]
            whole = sum(parts)
            for size, part in enumerate(parts):
                share = np.divide(part, whole, out=np.zeros_like(part), where=whole > 0) * reach[i + 1]
                reach[i - size] = reach[i - size] + share
                out += np.bincount(spans[size][:, i], weights=share[:, 0] * counts, minlength=self.count + 1)
        return out


def by_length(words: list[bytes]):
    """(positions, byte matrix) for every length."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for lo in range(0, len(at), 20_000):
            part = at[lo:lo + 20_000]
            yield part, np.frombuffer(b"".join(words[i] for i in part), dtype=np.uint8).reshape(len(part), size)


def parts(word: str) -> list[bytes]:
    return [b" " + word[i:i + LONGEST_WORD].encode() for i in range(0, len(word), LONGEST_WORD)]


def remainder(key: str, modulus: int) -> Column:
    """crc32 of a key as text; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def fit(docs: DataFrame, text: str, lang: str, order: Column, vocabulary: str, max_docs: int, rounds: int) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (count + 1, languages), from at most ``max_docs`` documents of each language.

    A language's documents are those of smallest ``order``, a 64-bit hash; rows that
    repeat a hash count once.  Only hashes below a bound that lets about twice ``max_docs``
    pass leave the scan, so a language with most rows does not meet in one task.
    """
    rows = docs.select(F.col(lang).alias("l"), F.col(text).alias("t"), order.alias("o")).where("l IS NOT NULL AND t IS NOT NULL")
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.approx_count_distinct("o").alias("n")).collect()}   # one row per language
    bounds = F.lit(None).cast("long")
    for name, n in sizes.items():
        bounds = F.when(F.col("l") == name, F.lit(min(2**63 - 1, int(2**64 * 2 * max_docs / n) - 2**63))).otherwise(bounds)
    pick = Window.partitionBy("l").orderBy("o")
    sample = rows.where(F.col("o") <= bounds).dropDuplicates(["l", "o"]).withColumn("r", F.row_number().over(pick)).where(F.col("r") <= max_docs)
    counts = materialize(
        sample.select("l", F.explode(F.split(F.lower("t"), r"[^\p{L}]+")).alias("w")).where("w != ''").groupBy("l", "w").count(), "lang_words")
    names = sorted((r["l"] for r in counts.select("l").distinct().collect()), key=lambda s: s.encode())
    size = Pieces(vocabulary).count
    p = np.vstack([np.full((size, len(names)), 1.0 / size), np.zeros((1, len(names)))])
    for _ in range(rounds if names else 0):
        now = p

        def expect(batches):
            pieces, total = Pieces(vocabulary), np.zeros((size + 1, len(names)))
            for batch in batches:
                for name, rows in batch.groupby("l"):
                    words, n = [], []
                    for w, c in zip(rows["w"], rows["count"]):
                        for part in parts(w):
                            words.append(part)
                            n.append(c)
                    n = np.array(n)
                    k = names.index(name)
                    for at, letters in by_length(words):
                        total[:, k] += pieces.expected(letters, n[at], now[:, k])
            piece, k = np.nonzero(total[:size])
            yield pd.DataFrame({"piece": piece.astype("int32"), "k": k.astype("int32"), "e": total[piece, k]})

        sums = np.zeros((size, len(names)))
        got = counts.mapInPandas(expect, "piece int, k int, e double").groupBy("piece", "k").agg(F.sum("e").alias("e"))
        for r in got.collect():   # at most vocabulary x languages
            sums[r["piece"], r["k"]] = r["e"]
        sums += 0.01
        p = np.vstack([sums / sums.sum(axis=0), np.zeros((1, len(names)))])
    return names, p


class Scorer:
    def __init__(self, vocabulary: str, p: np.ndarray):
        self.pieces, self.p = Pieces(vocabulary), p
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1 << 14, p.shape[1]))

    def learn(self, words: list[str]) -> None:
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        while first + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[first:first + len(words)] = 0
        split, owner = [], []
        for i, w in enumerate(words, first):
            for part in parts(w):
                split.append(part)
                owner.append(i)
        owner = np.array(owner)
        for at, letters in by_length(split):
            log, _ = self.pieces.forward(self.pieces.spans(letters), self.p)
            np.add.at(self.scores, owner[at], log)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities per language, number of words) of each text."""
        lists = pc.split_pattern_regex(pc.utf8_lower(texts.cast(pa.large_string())), r"[^\p{L}]+")
        flat = lists.flatten().dictionary_encode()
        names = flat.dictionary.to_pylist()
        missing = [w for w in names if w and w not in self.known]
        if len(self.known) + len(missing) > CACHE_WORDS and self.known:
            self.known, missing = {}, [w for w in names if w]
        if missing:
            self.learn(missing)
        number = np.array([self.known[w] if w else -1 for w in names], dtype=np.int64)
        index = number[flat.indices.to_numpy()] if len(names) else number
        used = index >= 0
        score = np.where(used[:, None], self.scores[np.maximum(index, 0)], 0.0)
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sums = np.vstack([np.zeros((1, score.shape[1])), np.cumsum(score, axis=0)])
        n = np.concatenate([[0], np.cumsum(used)])
        return sums[offsets[1:]] - sums[offsets[:-1]], n[offsets[1:]] - n[offsets[:-1]]


_scorer: dict[str, Scorer] = {}


def identify(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
             vocabulary: str = "byte_bpe_multi_50k.tiktoken", max_docs: int = 2000, rounds: int = 4) -> DataFrame:
    """One row per input row: key, train (as given), lang_pred and score, the posterior of lang_pred.

    Learns from rows where ``train`` holds and text and language are not NULL, at
    most ``max_docs`` of each language, picked by a hash of key and text.  Texts that are NULL or have no
    letters, and all texts when nothing could be learned, are ``und`` with score
    0.  Ties go to the language first in code-point order.  Repeated rows get
    equal answers; an empty table gives an empty result.
    """
    names, p = fit(docs.where(train), text, lang, F.xxhash64(key, text), vocabulary, max_docs, rounds)
    model = uuid.uuid4().hex

    def run(batches):
        if names and model not in _scorer:
            _scorer.clear()
            _scorer[model] = Scorer(vocabulary, p)
        for batch in batches:
            n = batch.num_rows
            lang_pred, score = np.full(n, "und", dtype=object), np.zeros(n)
            if names and n:
                logs, words = _scorer[model].texts(batch.column(2))
                best = logs.argmax(axis=1)
                share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                some = words > 0
                lang_pred[some] = np.array(names, dtype=object)[best[some]]
                score[some] = share[some]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang_pred, pa.string()), pa.array(score)], ["key", "train", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), train.alias("train"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"key {kind}, train boolean, lang_pred string, score double")
