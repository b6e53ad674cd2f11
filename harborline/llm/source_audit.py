"""Source divergence audit: how far each source's vocabulary lies from its language and from its siblings.

Terms travel as 64-bit digests.  Each map task counts its terms per (language,
source) and writes digest, counts and text; only the fixed-width digests and
counts are shuffled to be summed.  For digests that may be kept, the smallest and
the largest text behind them are compared: where they differ two terms share a
digest, and only those digests are counted again by their text.  A task writes a
term's text with its first counts only.  Text is joined back for the reported terms alone.

The distance of two sources is a sum over all kept terms.  Terms neither of them
has differ by a constant, so only terms present in either are visited.  Sources
are dealt into chunks and terms into slices: one task holds two chunks and one
slice, so neither a language with a third of all rows nor one with many sources
meets in one task, and what leaves a task is one number per pair of sources, as
many as the result has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from harborline.llm.common import stored
from harborline.session import materialize

# Letters and all bytes of non-ASCII characters make terms; A-Z become a-z.
TERM_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

HELD_TERMS = 2_000_000    # counts of (group, term) a map task holds; it writes them if more than half are distinct
HELD_TEXTS = 1_000_000    # terms a map task knows, with their text
CHUNK_SOURCES = 64        # sources of a chunk, on average
SLICE_TERMS = 1_000       # kept terms of a slice, on average


class Terms:
    """The terms a map task knows: their numbers, digests, and whether their text has been written."""

    def __init__(self, mask: int):
        self.mask = mask
        self.number: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.digest, self.told = np.zeros(1 << 12, dtype=np.uint64), np.zeros(1 << 12, dtype=bool)

    def numbers(self, found: list[bytes]) -> np.ndarray:
        number = np.fromiter(map(self.number.get, found, repeat(-1)), dtype=np.int64, count=len(found))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            first, new = len(self.names), [found[i] for i in missing]
            number[missing] = np.arange(first, first + len(new))
            self.number.update(zip(new, range(first, first + len(new))))
            self.names += new
            while len(self.names) > len(self.digest):
                self.digest, self.told = (np.concatenate([a, np.zeros_like(a)]) for a in (self.digest, self.told))
            self.digest[first:len(self.names)] = np.fromiter(
                (xxhash.xxh64_intdigest(t) & self.mask for t in new), dtype=np.uint64, count=len(new))
        return number


def term_lists(texts: pa.Array) -> pa.Array:
    """The terms of each text of a binary array without NULLs; empty ones may be among them."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    clean = np.frombuffer(TERM_TABLE, dtype=np.uint8)[data]
    return pc.ascii_split_whitespace(pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(clean)]))


def group_sums(key: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """Columns (key ascending, sum of each of the values)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return np.stack([key[starts], *[np.add.reduceat(v[order], starts) if len(key) else v for v in values]])


def summed(held: list[np.ndarray]) -> np.ndarray:
    return group_sums(*np.concatenate(held, axis=1)) if len(held) > 1 else held[0]


def batch_counts(lists: pa.Array, group_of: np.ndarray, terms: Terms) -> np.ndarray:
    """Columns (group << 32 | term number, occurrences, documents) of a batch of documents."""
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    number, width = terms.numbers(names), max(1, len(names))
    pairs = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) * width + coded.indices.to_numpy()
    pairs.sort()
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, dtype=np.int64)
    n = np.diff(np.append(starts, len(pairs)))
    doc, code = np.divmod(pairs[starts], width)
    real = code != pc.index(coded.dictionary, "").as_py()
    return group_sums((group_of[doc[real]] << 32) | number[code[real]], n[real], np.ones(int(real.sum()), dtype=np.int64))


def written(counts: np.ndarray, groups: dict, terms: Terms, every_text: bool) -> Iterator[pa.RecordBatch]:
    langs, sources = (pa.array(names, pa.string()) for names in zip(*groups))
    for lo in range(0, counts.shape[1], 100_000):   # rows of a batch
        key, n, df = counts[:, lo:lo + 100_000]
        group, number = pa.array(key >> 32), key & 0xFFFFFFFF
        distinct, first, place = np.unique(number, return_index=True, return_inverse=True)
        hidden = np.zeros(len(key), dtype=bool)
        if not every_text:
            hidden[:] = True
            hidden[first] = terms.told[distinct]
            told = [terms.names[i] if new else None for i, new in zip(distinct.tolist(), (~terms.told[distinct]).tolist())]
            terms.told[distinct] = True
        else:
            told = [terms.names[i] for i in distinct.tolist()]
        yield pa.RecordBatch.from_arrays([
            langs.take(group), sources.take(group), pa.array(terms.digest[number].view(np.int64)), pa.array(n), pa.array(df),
            pa.array(told, pa.binary()).cast(pa.string()).take(pa.array(place, mask=hidden))],
            ["lang", "source", "digest", "n", "df", "term"])


def tally(docs: DataFrame, lang: str, source: str, text: str, digest_bits: int = 64, every_text: bool = False) -> DataFrame:
    """(lang, source, digest, n, df, term): occurrences and documents, summed within runs of a map task.

    The text is NULL where the task has written it before, unless ``every_text``.
    """
    mask = (1 << digest_bits) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        terms = Terms(mask)
        held: list[np.ndarray] = []   # columns (group and term, n, df)
        rows = 0
        for batch in batches:
            of_doc = np.fromiter((groups.setdefault(g, len(groups)) for g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())),
                                 dtype=np.int64, count=batch.num_rows)
            held.append(batch_counts(term_lists(batch.column(2)), of_doc, terms))
            rows += held[-1].shape[1]
            full = len(terms.names) > HELD_TEXTS
            if rows > HELD_TERMS or full:
                held = [summed(held)]
                rows = held[0].shape[1]
                if 2 * rows > HELD_TERMS or full:
                    yield from written(held[0], groups, terms, every_text)
                    held, rows = [], 0
            if full:
                terms = Terms(mask)
        if held:
            yield from written(summed(held), groups, terms, every_text)

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source)],
                       F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return rows.mapInArrow(run, "lang string, source string, digest long, n long, df long, term string")


def split_counts(rows: DataFrame, min_docs: int, with_texts: Callable[[], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(lang, source, digest, tie, n, df) and (digest, tie, term); tie is empty but for terms that share their digest.

    ``with_texts`` makes the same rows with their texts, for digests that are shared.
    """
    sums = [F.sum("n").alias("n"), F.sum("df").alias("df")]
    counts = materialize(rows.groupBy("lang", "source", "digest").agg(*sums), "digest_counts")
    frequent = counts.groupBy("lang", "digest").agg(F.sum("df").alias("df")).where(F.col("df") >= min_docs)
    possible = materialize(frequent.select("digest").distinct(), "possible")
    texts = materialize(
        rows.where("term IS NOT NULL").select("digest", "term").join(possible, "digest", "left_semi").groupBy("digest")
        .agg(F.min("term").alias("low"), F.max("term").alias("high")), "digest_texts")
    names = texts.where("low = high").select("digest", F.lit("").alias("tie"), F.col("low").alias("term"))
    shared = texts.where("low <> high").select("digest")
    if shared.isEmpty():
        return counts.withColumn("tie", F.lit("")), names
    apart = materialize(
        with_texts().join(shared, "digest", "left_semi").withColumnRenamed("term", "tie")
        .groupBy("lang", "source", "digest", "tie").agg(*sums), "shared_digests")
    whole = counts.join(shared, "digest", "left_anti").withColumn("tie", F.lit(""))
    return (whole.unionByName(apart),
            names.union(apart.select("digest", "tie", F.col("tie").alias("term")).distinct()))


def share(count: str, total: str, terms: str) -> str:
    """SQL of 1 + floor(10^9 * (count + 5) / (total + 5 * terms)), exact in decimals."""
    return (f"1L + (CAST(1000000000 AS decimal(10,0)) * CAST({count} + 5 AS decimal(20,0))"
            f" div CAST({total} + 5 * {terms} AS decimal(20,0)))")


def source_gaps(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the summed distance of every two sources of a language, each pair once."""
    dealt = groups.withColumns({
        "chunks": F.ceil(F.col("sources") / CHUNK_SOURCES).cast("long"),
        "slices": F.greatest(F.lit(1), F.ceil(F.col("terms") / SLICE_TERMS)).cast("long")})
    dealt = dealt.withColumn("chunk", F.expr("pmod(xxhash64(source), chunks)"))
    heads = dealt.select(
        "lang", "source", "chunk", "chunks", F.explode(F.expr("sequence(0L, slices - 1)")).alias("slice"),
        F.lit(None).cast("long").alias("digest"), F.lit(None).cast("string").alias("tie"), F.lit(None).cast("long").alias("p"), "floor", "terms")
    body = shares.select("lang", "source", "digest", "tie", "p").join(
        dealt.select("lang", "source", "chunk", "chunks", "slices", "floor", "terms"), ["lang", "source"])
    body = body.withColumn("slice", F.expr("pmod(xxhash64(digest), slices)")).select(heads.columns)
    cells = heads.unionByName(body).withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
    cells = cells.withColumns({"x": F.least("chunk", "other"), "y": F.greatest("chunk", "other")}).drop("chunks", "other")

    def gaps(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["digest"].isna()].reset_index(drop=True)
        rows = pdf[pdf["digest"].notna()]
        place = pd.Series(head.index, index=head["source"])
        term = rows.groupby(["digest", "tie"], sort=False).ngroup().to_numpy()
        width = int(term.max()) + 1 if len(term) else 0
        floor = head["floor"].to_numpy(dtype=np.int64)
        values = np.repeat(floor[:, None], width, axis=1)
        values[place[rows["source"]].to_numpy(), term] = rows["p"].to_numpy(dtype=np.int64)
        # Slice 0 also brings the constant of all kept terms, so every pair comes out once at least.
        base = int(head["terms"].iloc[0]) if head["slice"].iloc[0] == 0 else 0
        x, y = pdf["x"].iloc[0], pdf["y"].iloc[0]
        left, right = (np.flatnonzero(head["chunk"].to_numpy() == c) for c in (x, y))
        names = head["source"].to_numpy(dtype=object)
        out: list[list] = [[], [], []]
        for i in left:
            others = right[right > i] if x == y else right
            if len(others):
                gap = np.abs(values[others] - values[i]).sum(axis=1) + (base - width) * np.abs(floor[others] - floor[i])
                for column, values_of in zip(out, ([names[i]] * len(others), names[others], gap)):
                    column.extend(values_of)
        found = dict(zip(("a", "b", "value"), out))
        return pd.DataFrame({"lang": [head["lang"].iloc[0]] * len(found["a"]), **found}, dtype=object)

    return cells.groupBy("lang", "x", "y", "slice").applyInPandas(gaps, "lang string, a string, b string, value long").groupBy(
        "lang", "a", "b").agg(F.sum("value").alias("value"))


def source_audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30,
                 top: int = 50, digest_bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    Part ``pair`` has a row per other source of the language with the summed
    distance of the two term distributions, part ``term`` the ``top`` kept terms
    that the source uses more than its language.  Shares are parts of 10^9 with
    five added to every count, all arithmetic is in integers and decimals.

    NULL lang, source and text count as empty strings.  A language without kept
    terms has distances of 0 and no terms; a language with one source has no
    pairs; a group without terms is compared like any other.  Ties go by the
    UTF-8 order of the item.  Repeated rows count as often as they occur; texts of
    any length are counted whole.  An empty table gives an empty result.  Other
    columns are ignored, whatever their names.
    """
    rows = stored(tally(docs, lang, source, text, digest_bits), "tally")
    counts, names = split_counts(rows, min_docs, lambda: tally(docs, lang, source, text, digest_bits, every_text=True))
    kept = materialize(
        counts.groupBy("lang", "digest", "tie").agg(F.sum("df").alias("df"), F.sum("n").alias("lang_n"))
        .where(F.col("df") >= min_docs).drop("df"), "kept_terms")
    present = materialize(counts.join(kept, ["lang", "digest", "tie"]).select(
        "lang", "source", "digest", "tie", "n", "lang_n"), "present_terms")

    blank = F.lit("")
    found = docs.select(*[F.coalesce(F.col(c).cast("string"), blank).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    of_group = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    found = materialize(found, "groups")
    groups = found.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").join(
        found.groupBy("lang").agg(F.count("*").alias("sources")), "lang")
    groups = groups.fillna(0, ["total", "terms", "lang_total"]).withColumn(
        "floor", F.expr(f"CASE WHEN terms = 0 THEN 0L ELSE {share('0L', 'total', 'terms')} END"))
    groups = materialize(groups, "group_totals")

    shares = materialize(present.join(groups, ["lang", "source"]).select(
        "lang", "source", "digest", "tie", F.expr(share("n", "total", "terms")).alias("p"),
        F.expr(share("lang_n", "lang_total", "terms")).alias("q")), "shares")

    gaps = materialize(source_gaps(shares, groups), "gaps")
    pairs = gaps.selectExpr("lang", "a AS source", "b AS item", "value").unionByName(
        gaps.selectExpr("lang", "b AS source", "a AS item", "value"))
    of_source = Window.partitionBy("lang", "source")
    pairs = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(of_source.orderBy(F.desc("value"), F.asc("item")))})

    # Only terms that may be among the first, ties at the end included, get their text back.
    more = shares.where("p > q").withColumn("value", F.expr("p - q"))
    first = more.withColumn("place", F.rank().over(of_source.orderBy(F.desc("value")))).where(F.col("place") <= top)
    named = first.join(names, ["digest", "tie"]).select("lang", "source", F.col("term").alias("item"), "value")
    terms = named.withColumns({"part": F.lit("term"), "rank": F.row_number().over(of_source.orderBy(F.desc("value"), F.asc("item")))}).where(
        F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(terms.select(columns))
