"""Mix sources to target weights by drawing fixed-length token blocks.

1. The words of a source form one sequence, documents in key order; it is cut
   into blocks of ``block_words`` words (the last may be short).
2. Sources get targets by weight; none exceeds ``max_repeats`` times its size,
   the excess is reshared by weight.  Targets become whole words and block
   quotas, short last blocks counted as such; the last draw of a source is cut
   so that it ends at its target.
3. The output is a row of shards of ``shard_slots`` slots.  Each shard draws its
   source counts from a multinomial with the quotas' shares.  Draws fluctuate,
   so slots beyond a source's quota pass to sources that fell short.
4. The j-th slot of a source takes block perm(j mod blocks) of epoch j div
   blocks, perm being a keyed Feistel permutation of the source's block indices,
   new in each epoch.  No block is drawn more than ``max_repeats`` times.
5. Slots and blocks meet by (source, block index), which is unique on the block
   side, so a source with a third of all rows spreads like the others.

The result depends on rows and seed only, not on partitioning.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import UID, running_sums, stored, with_uid, words_column
from harborline.session import materialize

SMALL_CATALOGUE = 100_000   # sources that are broadcast to their documents; beyond that both sides are shuffled


def water_fill(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Targets proportional to weights, none above cap * size, summing to total if the caps allow it."""
    targets = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if sizes[i] > 0]
    left = float(total)
    while free:
        share = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * share > cap * sizes[i]]
        if not full:
            for i in free:
                targets[i] = weights[i] * share
            break
        for i in full:
            targets[i] = float(cap * sizes[i])
            left -= targets[i]
        free = [i for i in free if i not in set(full)]
    return targets


def _mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of range(size), element by element, by a cycle-walking Feistel network."""
    index, size, key = (np.asarray(a, dtype=np.uint64) for a in (index, size, key))
    bits = np.ones(len(index), dtype=np.uint64)
    while (grow := (np.uint64(1) << (np.uint64(2) * bits)) < size).any():
        bits[grow] += np.uint64(1)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = index.copy()
    todo = np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
        for turn in range(4):
            with np.errstate(over="ignore"):
                mixed = _mix64(right + key[todo] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn + 1))
            left, right = right, left ^ (mixed & mask[todo])
        out[todo] = (left << bits[todo]) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def place(index: int, size: int, key: int) -> int:
    """The position at which ``permute`` gives ``index``: the network backwards."""
    bits = 1
    while 1 << 2 * bits < size:
        bits += 1
    mask = (1 << bits) - 1
    while True:
        left, right = index >> bits, index & mask
        for turn in reversed(range(4)):
            at = (left + key * 0x9E3779B97F4A7C15 + turn + 1) & 0xFFFFFFFFFFFFFFFF
            left, right = right ^ (int(_mix64(np.array([at], dtype=np.uint64))[0]) & mask), left
        index = (left << bits) | right
        if index < size:
            return index


def _epoch_key(seed: int, s, epoch):
    return (seed << 40) + (s << 16) + epoch


def draws_for(words: int, size: int, block_words: int, seed: int, s: int) -> tuple[int, int]:
    """(quota, words of the last draw) so that the source's draws add up to ``words``."""
    if not words:
        return 0, 0
    blocks = -(-size // block_words)
    epoch, rest = divmod(words - 1, size)
    rest += 1
    missing = blocks * block_words - size   # from the last block
    short_at = place(blocks - 1, blocks, _epoch_key(seed, s, epoch))
    n = -(-rest // block_words)
    if n > short_at:
        n = max(short_at + 1, -(-(rest + missing) // block_words))
    before = (n - 1) * block_words - (missing if n - 1 > short_at else 0)
    return epoch * blocks + n, rest - before


def plan_sources(sizes: DataFrame, weights: list[float], share: float, max_repeats: int, block_words: int, seed: int) -> pd.DataFrame:
    """One row per source, on the driver: the catalogue of sources, not data, bounds it."""
    found = {r["source"]: int(r["source_size"]) for r in sizes.collect()}
    names = sorted((n for n in found if n is not None), key=lambda n: n.encode("utf-8")) + ([None] if None in found else [])
    plan = pd.DataFrame({"source": pd.Series(names, dtype=object), "size": pd.Series([found[n] for n in names], dtype="int64")})
    plan["weight"] = [float(weights[i % len(weights)]) for i in range(len(plan))]
    plan["target"] = water_fill(list(plan["size"]), list(plan["weight"]), share * plan["size"].sum(), max_repeats)
    plan["blocks"] = -(-plan["size"] // block_words)
    words = np.maximum(np.rint(plan["target"]), plan["target"] > 0).astype("int64")
    draws = [draws_for(int(w), int(n), block_words, seed, i) for i, (w, n) in enumerate(zip(words, plan["size"]))]
    plan["quota"] = np.array([q for q, _ in draws], dtype="int64")
    plan["last_words"] = np.array([n for _, n in draws], dtype="int64")
    return plan


def _shards(spark, plan: pd.DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(shard, s, drawn): multinomial counts per shard; the last shard may be short."""
    total = int(plan["quota"].sum())
    shares = (plan["quota"] / max(1, total)).to_numpy()

    def draw(batches):
        for batch in batches:
            rows = []
            for shard in batch["id"]:
                slots = min(shard_slots, total - int(shard) * shard_slots)
                counts = np.random.default_rng([seed, int(shard)]).multinomial(slots, shares)
                used = np.flatnonzero(counts)
                rows.append(pd.DataFrame({"shard": int(shard), "s": used.astype("int32"), "drawn": counts[used].astype("int64")}))
            yield pd.concat(rows) if rows else pd.DataFrame({"shard": [], "s": [], "drawn": []})

    return spark.range(-(-total // shard_slots)).mapInPandas(draw, "shard long, s int, drawn long")


def _hand_over(plan: pd.DataFrame, drawn: dict[int, int]) -> pd.DataFrame:
    """Ranges of slot numbers beyond a quota, and the numbers of the short source that take them."""
    rows, short = [], [[s, drawn.get(s, 0), int(q)] for s, q in enumerate(plan["quota"]) if drawn.get(s, 0) < q]
    for s, quota in enumerate(plan["quota"]):
        start, left = int(quota), drawn.get(s, 0) - int(quota)
        while left > 0:
            to = short[0]
            n = min(left, to[2] - to[1])
            rows.append((s, start, start + n, to[0], to[1]))
            start, left, to[1] = start + n, left - n, to[1] + n
            if to[1] == to[2]:
                short.pop(0)
    return pd.DataFrame(rows, columns=["s", "lo", "hi", "to_s", "to_j"])


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2,
        block_words: int = 64, shard_slots: int = 4096, seed: int = 1, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Return (documents, draws).  ``row`` names a column that numbers the rows, if there is one.

    documents: one row per input row: row (its number), key, source, size,
    source_size, target, first_word (its place in the source's sequence).
    draws: one row per drawn stretch of a document: row, source number s, block,
    epoch, shard, slot, from_word and words (within the document).  The slots of
    a shard in order are its blocks.

    A NULL source is a source of its own, last in order; NULL and empty texts
    have size 0 and are never drawn; repeated keys stay separate rows; an empty
    table gives two empty results.  Sources without words get target 0.
    """
    spark = docs.sparkSession
    sized = docs.select(
        *([F.col(row).alias(UID)] if row else []), F.col(key).alias("key"), F.col(source).alias("source"),
        F.xxhash64(text).alias("tie"), F.expr(f"size({words_column(text)})").cast("long").alias("size"))
    sized = materialize(sized if row else with_uid(sized), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = plan_sources(sizes, list(weights), share, max_repeats, block_words, seed)
    catalogue = spark.createDataFrame(
        [(i, r.source, int(r.size), float(r.target)) for i, r in enumerate(plan.itertuples(index=False))],
        "s int, c_source string, source_size long, target double")
    if len(plan) <= SMALL_CATALOGUE:
        catalogue = F.broadcast(catalogue)   # its rows are on the driver anyway; unhinted, the documents' sizes go there as well
    numbered = sized.join(catalogue, F.col("source").eqNullSafe(F.col("c_source"))).drop("c_source")
    placed = materialize(
        running_sums(numbered, ["key", "tie", UID], {"first_word": "size"}, "s").withColumnRenamed(UID, "row"), "placed")

    blocks = placed.where("size > 0").select(
        "row", "s", "size", "first_word",
        F.explode(F.expr(f"sequence(first_word div {block_words}, (first_word + size - 1) div {block_words})")).alias("block"),
    ).select(
        "row", "s", "block", F.expr(f"greatest(block * {block_words} - first_word, 0L)").alias("from_word"),
        F.expr(f"least((block + 1) * {block_words} - first_word, size) - greatest(block * {block_words} - first_word, 0L)").alias("words"),
        F.expr(f"greatest(first_word - block * {block_words}, 0L)").alias("place"))

    counts = materialize(_shards(spark, plan, shard_slots, seed), "shards")
    drawn = {r["s"]: int(r["n"]) for r in counts.groupBy("s").agg(F.sum("drawn").alias("n")).collect()}
    moved = _hand_over(plan, drawn)
    n_blocks, quotas, last_words = (plan[c].to_numpy(dtype="int64") for c in ("blocks", "quota", "last_words"))

    def to_slots(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo:lo + 256]
                n = part["drawn"].to_numpy()
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                s = np.repeat(part["s"].to_numpy(), n).astype("int64")
                j = np.repeat(part["first"].to_numpy(), n) + within
                shard = np.repeat(part["shard"].to_numpy(), n)
                drawn_s, drawn_j = s.copy(), j.copy()
                for r in moved.itertuples(index=False):
                    hit = (drawn_s == r.s) & (drawn_j >= r.lo) & (drawn_j < r.hi)
                    s[hit], j[hit] = r.to_s, r.to_j + drawn_j[hit] - r.lo
                size = n_blocks[s]
                epoch = j // size
                keys = _epoch_key(np.uint64(seed), s.astype("uint64"), epoch.astype("uint64"))
                yield pd.DataFrame({
                    "shard": shard, "slot": np.repeat(part["slot"].to_numpy(), n) + within, "s": s.astype("int32"),
                    "block": permute(j % size, size, keys), "epoch": epoch.astype("int32"),
                    "most": np.where(j == quotas[s] - 1, last_words[s], block_words)})

    first = running_sums(counts, ["shard"], {"first": "drawn"}, "s")
    inside = "coalesce(sum(drawn) over (partition by shard order by s rows between unbounded preceding and 1 preceding), 0L)"
    slots = first.withColumn("slot", F.expr(inside)).mapInPandas(
        to_slots, "shard long, slot long, s int, block long, epoch int, most long")
    # A row of ``first`` becomes hundreds of slots and one of ``placed`` many blocks; Spark sizes both sides by the rows
    # before that, so left to itself it sends all slots through the driver as a broadcast.
    draws = slots.hint("merge").join(blocks, ["s", "block"]).withColumn("words", F.expr("least(words, most - place)")).where("words > 0").drop("most", "place")
    documents = placed.select("row", "key", "source", "size", "source_size", "target", "first_word")
    return documents, draws


def taken(docs: DataFrame, **options) -> DataFrame:
    """``mix`` summed per document: documents with ``taken``, the words drawn, repeats counted."""
    documents, draws = mix(docs, **options)
    sums = draws.groupBy("row").agg(F.sum("words").alias("taken"))
    return documents.join(sums, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: per epoch one row with the words drawn of a document.

    A document drawn in full keeps its text; of one drawn in part the drawn words
    follow each other in order, joined by spaces.  Documents that are not drawn
    are absent.  All other columns stay as they are.
    """
    rows = stored(with_uid(docs.select(F.struct("*").alias("_row"))), "mix_input")
    flat = rows.select(F.col(UID).alias("row"), *[F.col(f"_row.{c}").alias(a) for c, a in ((key, "key"), (text, "text"), (source, "source"))])
    _, draws = mix(flat, "key", "text", "source", row="row", **options)
    spans = draws.groupBy("row", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("spans"), F.sum("words").alias("drawn"))
    # the size of a compressed file says little about its texts, so they are not broadcast either
    whole = rows.join(spans.hint("merge"), F.col(UID) == F.col("row"))
    words = whole.withColumn("w", F.expr(words_column("_row`.`" + text)))
    drawn = "array_join(flatten(transform(spans, s -> slice(w, cast(s.from_word + 1 AS int), cast(s.words AS int)))), ' ')"
    replaced = F.when(F.col("drawn") == F.size("w"), F.col(f"_row.{text}")).otherwise(F.expr(drawn))
    return words.select(*[replaced.alias(c) if c == text else F.col(f"_row.{c}").alias(c) for c in docs.columns])
