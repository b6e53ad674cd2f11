"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER bytes with symbol counts, taken
from all training documents.  A byte is predicted from the longest context that
occurred: with probability count / (n + d) if it followed that context, else an
escape of probability d / (n + d) leads to the next shorter context (n: symbols
counted, d: distinct ones); symbols of the contexts escaped from are excluded
from n and d.  Below the empty context all unseen symbols are equally likely.  A document's
score is the log10 probability of all its bytes and its end.

The trie is never in one place.  Its deepest entries are the distinct
(ORDER + 1)-byte grams.  Documents are dealt to blocks of about BLOCK_BYTES; a
block's distinct grams and words with their training counts are what leaves it.
Spark sums them; subtries are evaluated by the task that owns their last two context bytes
(orders 0 and 1 have at most 256 x 256 entries and go everywhere); each block
gets back the values of its own grams and words, so documents are
scored locally.  What is exchanged grows with blocks, not with one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.common import key_slices, stored
from harborline.session import materialize

ORDER = 5                      # context bytes; a gram has one more and fits 48 bits
PAD, END = 0xFE, 0xFF          # bytes that UTF-8 never has: before a text, after it
BLOCK_BYTES = 24 << 20
PART_BYTES = 2 << 20           # texts turned into grams at once; a longer text is one part
SUM_ROWS = 200_000             # grams of a block's parts summed at once


def squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def blocks_of(docs: DataFrame, key: str, text: str, train: Column) -> DataFrame:
    """(block, key, train, t): texts lower-cased in A-Z and compressed, dealt to blocks in the order they are read."""

    def run(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            lower = pc.ascii_lower(batch.column(2))
            lengths = pc.binary_length(lower).to_numpy(zero_copy_only=False)
            number = np.empty(len(lengths), dtype=np.int64)
            for i, n in enumerate(lengths):
                if size >= BLOCK_BYTES:
                    block, size = block + 1, 0
                number[i], size = block, size + int(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), batch.column(0), batch.column(1),
                 pa.array([squeeze(t) for t in lower.cast(pa.binary()).to_pylist()], pa.binary())], ["block", "key", "train", "t"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), train.alias("train"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return stored(rows.mapInArrow(run, f"block long, key {kind}, train boolean, t binary"), "blocks")


def document_parts(texts: list[bytes]):
    """Slices of about PART_BYTES."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PART_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram of every byte and end, number of them per text)."""
    between = bytes([END]) + bytes([PAD]) * ORDER
    line = np.frombuffer(bytes([PAD]) * ORDER + between.join(texts) + bytes([END]), dtype=np.uint8)
    packed = np.zeros(len(line) - ORDER, dtype=np.int64)
    for j in range(ORDER + 1):
        packed <<= 8
        packed |= line[j:len(line) - ORDER + j]
    return packed[line[ORDER:] != PAD], np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))


def word_lists(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(number of words per text, all words): split at ASCII white space."""
    split = [t.split() for t in texts]
    return np.fromiter(map(len, split), dtype=np.int64, count=len(split)), pa.array([w for s in split for w in s], pa.binary())


def distinct_grams(gram: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct grams ascending, how many of each are from training documents); uses ``gram`` up."""
    gram <<= 1   # a gram leaves room for the mark
    gram |= train
    gram.sort()
    starts = np.flatnonzero(np.concatenate([[True], (gram[1:] >> 1) != (gram[:-1] >> 1)])) if len(gram) else np.zeros(0, np.int64)
    n = np.add.reduceat((gram & 1).astype(np.int8), starts, dtype=np.int64) if len(gram) else gram
    return gram[starts] >> 1, n


def counted(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct grams ascending, sum of ``n`` of each)."""
    if not len(gram):
        return gram, n
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    return gram[starts], np.add.reduceat(n, starts)


def summed(found: list[tuple[np.ndarray, np.ndarray]]):
    """``counted`` over several of its results, about SUM_ROWS entries at a time, in ascending ranges of grams."""
    rows = sum(len(gram) for gram, _ in found)
    if not rows:
        return
    # Every part gives evenly spaced grams; a border between ranges is one of them.
    spaced = np.sort(np.concatenate([gram[::64] for gram, _ in found]))
    borders = spaced[np.arange(1, -(-rows // SUM_ROWS)) * len(spaced) // -(-rows // SUM_ROWS)]
    cuts = [np.concatenate([[0], np.searchsorted(gram, borders), [len(gram)]]) for gram, _ in found]
    for i in range(len(borders) + 1):
        gram, n = counted(*(np.concatenate([part[k][c[i]:c[i + 1]] for part, c in zip(found, cuts)]) for k in (0, 1)))
        if len(gram):
            yield gram, n


def summed_words(words: list[pa.Table]) -> pa.Table:
    # one thread: every further one would hold groups of its own
    sums = pa.concat_tables(words).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return sums.rename_columns(["n" if c == "n_sum" else c for c in sums.column_names]).select(["word", "n"]).combine_chunks()


def outgrown(rows: list[int]) -> bool:
    """Whether the results since the last sum hold more entries than that sum, the first of the list."""
    return sum(rows[1:]) > max(rows[0], SUM_ROWS)


def block_keys(blocked: DataFrame) -> DataFrame:
    """(block, word or gram, n): distinct words and grams of each block, with their number in training documents."""

    def flush(block, words, found):
        for gram, n in summed(found):
            k = len(gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, block)), pa.nulls(k, pa.binary()), pa.array(gram), pa.array(n)],
                ["block", "word", "gram", "n"])
        if words:
            sums = summed_words(words)
            for part in sums.to_batches(100_000):
                k = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, block)), part.column("word"), pa.nulls(k, pa.int64()), part.column("n")],
                    ["block", "word", "gram", "n"])

    def run(batches):
        current, words, found = None, [], []
        for batch in batches:
            block_of = batch.column(0).to_numpy()
            train_of = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            texts_of = [zstandard.decompress(t) for t in batch.column(2).to_pylist()]
            for block in dict.fromkeys(block_of.tolist()):
                if block != current:
                    yield from flush(current, words, found)
                    current, words, found = block, [], []
                mine = np.flatnonzero(block_of == block)
                texts, train = [texts_of[i] for i in mine], train_of[mine]
                for lo, hi in document_parts(texts):
                    gram, n = grams(texts[lo:hi])
                    found.append(distinct_grams(gram, np.repeat(train[lo:hi].astype(bool), n)))
                    del gram
                    if outgrown([len(g) for g, _ in found]):
                        found = [tuple(map(np.concatenate, zip(*summed(found))))]
                    n, flat = word_lists(texts[lo:hi])
                    if len(flat):
                        coded = flat.dictionary_encode()
                        weight = np.bincount(coded.indices.to_numpy(), weights=np.repeat(train[lo:hi], n), minlength=len(coded.dictionary))
                        words.append(pa.table({"word": coded.dictionary, "n": weight.astype(np.int64)}))
                        if outgrown([w.num_rows for w in words]):
                            words = [summed_words(words)]
        if current is not None:
            yield from flush(current, words, found)

    return stored(blocked.select("block", "train", "t").mapInArrow(run, "block long, word binary, gram long, n long"), "block_keys")


class Level:
    """Counts of (context, symbol) entries that occurred, and their contexts' n and d."""

    def __init__(self, entry: np.ndarray, count: np.ndarray):
        seen = count > 0
        frame = pd.Series(count[seen], index=entry[seen]).groupby(level=0).sum()
        self.entry, self.count = frame.index.to_numpy(dtype=np.int64), frame.to_numpy(dtype=np.int64)
        self.context, start = np.unique(self.entry >> 8, return_index=True)
        ends = np.append(start[1:], len(self.entry))
        self.total = np.add.reduceat(self.count, start) if len(start) else np.zeros(0, dtype=np.int64)
        self.distinct = ends - start

    @staticmethod
    def _find(values, keys, wanted):
        if not len(keys):
            return np.zeros(len(wanted), dtype=np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0)

    def count_of(self, entry):
        return self._find(self.count, self.entry, entry)

    def context_of(self, context):
        return self._find(self.total, self.context, context), self._find(self.distinct, self.context, context)

    def excluded(self, shorter: "Level", mask: int, context):
        """Sum of the shorter context's counts over the symbols of ``context``."""
        own = shorter.count_of((((self.entry >> 8) & mask) << 8) | (self.entry & 0xFF))
        sums = pd.Series(own, index=self.entry >> 8).groupby(level=0).sum()
        return self._find(sums.to_numpy(dtype=np.int64), sums.index.to_numpy(dtype=np.int64), context)


def gram_scores(gram: np.ndarray, count: np.ndarray, low: "Level") -> np.ndarray:
    """log10 P(last byte | context) of each gram.

    ``gram`` holds whole subtries: all grams with the same last two context bytes.
    ``low``: the order-1 level of the whole corpus.
    """
    symbol, out = gram & 0xFF, np.zeros(len(gram))
    levels = []
    for k in range(ORDER, 1, -1):
        levels.append((k, Level(gram & ((1 << 8 * (k + 1)) - 1), count)))
    levels += [(1, low), (0, Level(low.entry & 0xFF, low.count))]
    open_ = np.ones(len(gram), dtype=bool)
    longer = None
    for k, level in levels:
        mask = (1 << 8 * k) - 1
        context = (gram >> 8) & mask
        n, d = level.context_of(context)
        if longer is not None:
            longer_context = (gram >> 8) & ((mask << 8) | 0xFF)
            n = n - longer.excluded(level, mask, longer_context)
            d = d - longer.context_of(longer_context)[1]
        c = level.count_of((context << 8) | symbol)
        whole = np.maximum(n + d, 1)
        hit = open_ & (c > 0)
        out[hit] += np.log10(c[hit] / whole[hit])
        escape = open_ & (c == 0) & (d > 0)
        out[escape] += np.log10(d[escape] / whole[escape])
        open_ &= c == 0
        longer = level
    unseen = 256 - (levels[-1][1].distinct[0] if len(levels[-1][1].distinct) else 0)
    out[open_] -= np.log10(max(1, unseen))
    return out


PACKED = "block long, words binary, grams binary, numbers binary, known long"


def packed(block: np.ndarray, names: dict, numbers: np.ndarray, known: int) -> pa.RecordBatch:
    """One row per block: its keys and their values, compressed; the first row carries ``known``."""
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    rows = [r for r in np.split(order, cuts) if len(r)]
    pack = lambda make: [squeeze(make(r)) for r in rows]
    words = pack(lambda r: b" ".join(names["word"].take(pa.array(r)).to_pylist())) if "word" in names else [None] * len(rows)
    # Grams ascend within a block; their differences compress well.
    grams_ = pack(lambda r: np.diff(names["gram"][r], prepend=0).tobytes()) if "gram" in names else [None] * len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([int(block[r[0]]) for r in rows], pa.int64()), pa.array(words, pa.binary()), pa.array(grams_, pa.binary()),
         pa.array(pack(lambda r: numbers[r].astype("<f4" if "gram" in names else "<i8").tobytes()), pa.binary()),
         pa.array([known] + [0] * (len(rows) - 1), pa.int64())], ["block", "words", "grams", "numbers", "known"])


def pack_words(keys: DataFrame) -> DataFrame:
    """Training counts of each block's words; every word is summed by the task that owns its hash."""

    def run(batches):
        for part in key_slices(batches, ["owner"], 200_000):
            coded = part.column("word").combine_chunks().dictionary_encode()
            code = coded.indices.to_numpy()
            total = np.bincount(code, weights=part.column("n").to_numpy(), minlength=len(coded.dictionary))
            yield packed(part.column("block").to_numpy(), {"word": part.column("word").combine_chunks()}, total[code], int((total > 0).sum()))

    owned = keys.where("word IS NOT NULL").select(F.pmod(F.xxhash64("word"), F.lit(65_521)).alias("owner"), "block", "word", "n")
    return owned.repartition("owner").sortWithinPartitions("owner").mapInArrow(run, PACKED)


def pack_grams(keys: DataFrame) -> DataFrame:
    """log10 probabilities of each block's grams, from the counts of all blocks."""
    counts = keys.where("gram IS NOT NULL")
    pairs = counts.where("n > 0").groupBy((F.col("gram").bitwiseAND(0xFFFF)).alias("e")).agg(F.sum("n").alias("n")).collect()
    low = Level(np.array([r["e"] for r in pairs], dtype=np.int64), np.array([r["n"] for r in pairs], dtype=np.int64))

    def run(batches):
        for part in key_slices(batches, ["suffix"], 200_000):
            gram, code = np.unique(part.column("gram").to_numpy(), return_inverse=True)
            value = gram_scores(gram, np.bincount(code, weights=part.column("n").to_numpy()).astype(np.int64), low)
            yield packed(part.column("block").to_numpy(), {"gram": part.column("gram").to_numpy()}, value[code], 0)

    owned = counts.select(F.shiftright("gram", 8).bitwiseAND(0xFFFF).alias("suffix"), "block", "gram", "n")
    return owned.repartition("suffix").sortWithinPartitions("suffix", "gram").mapInArrow(run, PACKED)


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, train, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows where ``train`` holds and scores all.  NULL and empty texts
    are the end alone.  base_score is the smoothed word-unigram log10 probability,
    score the byte model's.  Without training rows both are uniform.  Repeated
    rows get equal scores; an empty table gives an empty result.  Other columns are
    ignored.
    """
    blocked = blocks_of(docs, key, text, train)
    keys = block_keys(blocked)
    ends = blocked.where("train").count()
    words = materialize(pack_words(keys), "packed_words")
    seen = keys.where("word IS NOT NULL").agg(F.sum("n")).first()[0] or 0
    total, distinct = seen + ends, (words.agg(F.sum("known")).first()[0] or 0) + (ends > 0)
    values = words.unionByName(pack_grams(keys))

    def unigram(c):
        return np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))

    def run(documents: pa.Table, table: pa.Table) -> pa.Table:
        opened = lambda c: [zstandard.decompress(x.as_py()) for x in table.column(c) if x.is_valid]
        numbers = list(zip(table.column("words").is_valid().to_pylist(), opened("numbers")))
        join = lambda word, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(x, kind) for w, x in numbers if w == word]])
        names = pa.array([w for x in opened("words") for w in x.split(b" ")], pa.binary())
        count_of, value_of = join(True, "<i8").astype(float), join(False, "<f4").astype(float)
        index = pd.Index(np.concatenate([np.zeros(0, np.int64), *[np.cumsum(np.frombuffer(x, np.int64)) for x in opened("grams")]]))
        texts = [zstandard.decompress(t) for t in documents.column("t").to_pylist()]
        n_tokens, n_known, base, scores = [], [], [], []
        for lo, hi in document_parts(texts):
            gram, n = grams(texts[lo:hi])
            value = value_of[index.get_indexer(gram)]
            scores.append(np.add.reduceat(value, np.cumsum(n) - n))
            n, flat = word_lists(texts[lo:hi])
            count = count_of[pc.index_in(flat, value_set=names).to_numpy()] if len(flat) else np.zeros(0)
            add = lambda x, n=n: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], np.cumsum(n)])])
            n_tokens.append(n + 1)
            n_known.append(add(count > 0) + (ends > 0))
            base.append(add(unigram(count)) + unigram(ends))
        return pa.table({
            "key": documents.column("key"), "train": documents.column("train"),
            **{c: pa.array(np.concatenate(v) if v else np.zeros(0)).cast(t) for c, v, t in (
                ("n_tokens", n_tokens, pa.int64()), ("n_known", n_known, pa.int64()),
                ("base_score", base, pa.float64()), ("score", scores, pa.float64()))}})

    kind = docs.schema[key].dataType.simpleString()
    scored = blocked.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(
        run, f"key {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
