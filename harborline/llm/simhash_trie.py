"""SimHash near-dedup by a self-join of binary tries.

Distinct fingerprints are the leaves.  For up to k differing bits the 64 bits are
cut into k + 1 blocks: two linked fingerprints agree in at least one block.  For
each block the fingerprints are rotated so that it comes first, which gives k + 1
tries whose error budget is 0 over the first block and k in all.  Spark exchanges
the leaves by that first block; the task that owns a subtrie walks its node pairs
together, one bit at a time, adds one error where the bits differ, and drops a
pair when the budget is exceeded.  A sorted array is the trie: a node is a range,
its children are split by a running count of the next bit.

Links are reduced to a spanning forest where they are found, and node pairs
whose leaves are already in one component are dropped, so a group of near copies
costs neither its square in rows nor, mostly, in time.  Subtries with more than
``node_rows`` leaves are split further into node pairs that different tasks walk.

Word-shingle similarity takes a longer fingerprint, and there it only proposes:
every link is a pair of texts whose shingle sets were compared exactly.  Leaves
carry a parity digest of their set, a lower bound of how many shingles two sets do
not share: a pair that cannot be similar counts for nothing.  Of all others the
tries give a spanning forest, whose components are clusters that no similar pair
leaves.  The sets of a cluster then meet in one task, or chunk by chunk in several,
which compares all its pairs and gives a spanning forest of the similar ones.  So
rows never grow with the square of a group, whether its pairs are similar or not.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import UID, key_slices, stored, with_uid
from harborline.llm.components import components
from harborline.session import materialize

LEAF_PAIRS = 64          # node pairs with at most so many leaf pairs are compared leaf by leaf
FRONTIER = 1 << 19       # node pairs walked at once
SKETCH_BITS = 256        # of the fingerprints that stand for word-shingle similarity
SLICE_DIFF = 3           # differing bits of a 32-bit slice of such a fingerprint
PARITY_WORDS = 16        # 64-bit words of the parity digest of a set, at most
BANDS, BAND = 18, 4      # MinHash bands of such a text and values in a band
LISTED = 500_000         # row numbers that are broadcast at most
CHUNK_ROWS = 2048        # sets of a cluster that one side of a task compares, at most about so many
CHUNK_VALUES = 1 << 22   # and of about so many values in all
COMPARED = 1 << 20       # values that are looked up at once
# Odd multipliers, one per 64 bits of a sketch.
LANES = np.arange(1, SKETCH_BITS // 32, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
# More of them, one per MinHash value.
ORDERS = np.arange(SKETCH_BITS // 32 + 1, SKETCH_BITS // 32 + 2 * BANDS * BAND, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of the word shingles of UTF-8 bytes; of the whole sequence if it is shorter, none without a word."""
    words = text.lower().split()
    joined = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [hash_of(joined, seed)] if words else []
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = [hash_of(joined[a:b - 1], seed) for a, b in zip(starts, ends[shingle - 1:])]
    return np.array(hashes, dtype="<u8")


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 if there is no word."""
    hashes = shingle_hashes(text, shingle, seed)
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def sketch(text: bytes, shingle: int = 5, seed: int = 42) -> bytes:
    """SimHash of SKETCH_BITS bits of the distinct word shingles; zeros if there is no word."""
    return set_sketch(np.unique(shingle_hashes(text, shingle, seed)))


def set_sketch(hashes: np.ndarray) -> bytes:
    total = np.zeros(SKETCH_BITS, dtype=np.int64)
    for lo in range(0, len(hashes), 255):   # byte-wide counters hold 255 rows
        with np.errstate(over="ignore"):
            x = hashes[lo:lo + 255, None] * LANES
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        bits = np.unpackbits((x ^ (x >> np.uint64(29))).view(np.uint8), axis=1)
        total += bits.view(np.uint64).sum(axis=0).view(np.uint8)
    return np.packbits(2 * total > len(hashes)).tobytes()


def bands(hashes: np.ndarray) -> bytes:
    """64-bit hashes of BANDS groups of BAND MinHash values of distinct shingles; of none without a word."""
    least = np.full(len(ORDERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(hashes), 4096):
        with np.errstate(over="ignore"):
            x = hashes[lo:lo + 4096, None] * ORDERS
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        least = np.minimum(least, (x ^ (x >> np.uint64(29))).min(axis=0))
    return b"".join(xxhash.xxh64_digest(group.tobytes()) for group in least.reshape(BANDS, BAND))


def digest(hashes: np.ndarray) -> bytes:
    """Size and parity bits of a set; of one too large for them to tell sets apart, also its ``set_sketch``.

    Every value of the set flips one bit, so two digests differ in at most as many
    bits as the sets have values that they do not share.
    """
    words = 1
    while words < PARITY_WORDS and 64 * words < len(hashes):
        words *= 2
    flips = np.bincount((hashes % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    head = len(hashes).to_bytes(8, "little") + np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()
    return head + set_sketch(hashes) if 4 * 64 * words < 3 * len(hashes) else head


class Digests:
    """Digests of many sets, and the pairs of them that may be similar."""

    def __init__(self, digests: list[bytes], whole: int):
        n = len(digests)
        self.whole = whole
        self.size, self.count, self.long = (np.zeros(n, dtype=np.int64) for _ in range(3))
        self.words, self.folded = (np.zeros((n, PARITY_WORDS), dtype=np.uint64) for _ in range(2))
        width = np.fromiter(map(len, digests), dtype=np.int64, count=n)
        sketches = [np.zeros((1, SKETCH_BITS // 64), dtype=np.uint64)]
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            raw = np.frombuffer(b"".join(digests[i] for i in at), dtype="<u8").reshape(len(at), -1)
            count = min(raw.shape[1] - 1, PARITY_WORDS)
            bits, half = raw[:, 1:1 + count], count // 2
            self.size[at], self.count[at] = raw[:, 0], count
            self.words[at, :count] = bits
            self.folded[at, :half] = bits[:, :half] ^ bits[:, half:2 * half]
            if raw.shape[1] > 1 + count:
                self.long[at] = np.arange(1, 1 + len(at))   # only the widest digests have a sketch
                sketches.append(raw[:, 1 + count:])
        self.sketches = np.concatenate(sketches)

    def may_be_similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether sets i and j can have a Jaccard similarity of 0.8 or more: at most a ninth of both sizes is not shared."""
        a, b = self.size[i], self.size[j]
        near = 5 * np.minimum(a, b) >= 4 * np.maximum(a, b)
        left = np.flatnonzero(near)
        for lo in range(0, len(left), 1 << 16):
            at = left[lo:lo + (1 << 16)]
            x, y = i[at], j[at]
            # Such sizes differ by one step of the digest's width at most: the wider one is folded.
            p = np.where((self.count[x] > self.count[y])[:, None], self.folded[x], self.words[x])
            q = np.where((self.count[y] > self.count[x])[:, None], self.folded[y], self.words[y])
            ok = 9 * np.bitwise_count(p ^ q).sum(axis=1, dtype=np.int64) <= a[at] + b[at]
            both = (self.long[x] > 0) & (self.long[y] > 0)
            if both.any():
                apart = np.bitwise_count(self.sketches[self.long[x[both]]] ^ self.sketches[self.long[y[both]]]).sum(axis=1, dtype=np.int64)
                ok[both] &= apart <= self.whole
            near[at] = ok
        return near


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    return rows.mapInArrow(run, f"key {kind}, fp long")


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        a, b = parent[i], parent[j]
        differ = a != b
        if not differ.any():
            return parent
        i, j = i[differ], j[differ]
        np.minimum.at(parent, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def trie_links(leaves: np.ndarray, pairs: list[tuple], depth: int, budget: int,
               sketches: np.ndarray | Callable | None = None, whole: int = 0) -> np.ndarray:
    """Parents of a spanning forest over ``leaves`` (sorted uint64) of all links below the node ``pairs``.

    pairs: (a_lo, a_hi, b_lo, b_hi, errors) ranges of nodes at ``depth``.  With
    ``sketches``, rows of uint64, a link also needs at most ``whole`` differing bits there;
    a function (i, j) says itself which pairs of leaves may be links.
    """
    groups = [np.arange(len(leaves))]
    close = sketches if callable(sketches) else None
    if sketches is not None and close is None:
        def close(i, j):
            return np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64) <= whole
    for i, j in near_pairs(leaves, pairs, depth, budget, groups, close):
        groups[0] = _merge(groups[0], i, j)
    return groups[0]


def near_pairs(leaves: np.ndarray, pairs: list[tuple], depth: int, budget: int, groups: list[np.ndarray], close=None):
    """Arrays (i, j) of all pairs within ``budget`` that pass ``close`` and differ in ``groups[0]``, which the caller may merge meanwhile."""
    ones = {}

    def near_of(i, j):
        parent = groups[0]
        open_ = parent[i] != parent[j]
        i, j = i[open_], j[open_]
        near = np.bitwise_count(leaves[i] ^ leaves[j]) <= budget
        if close is not None:
            i, j = i[near], j[near]
            near = close(i, j)
        if near.any():
            yield i[near], j[near]

    def compare(a0, a1, b0, b1):
        width = b1 - b0
        size = (a1 - a0) * width
        for m in np.flatnonzero(size > 1 << 16):   # many equal leaves: row by row, so that what one row links is skipped by the next
            j = np.arange(b0[m], b1[m])
            for i in range(a0[m], a1[m]):
                if (open_ := groups[0][j] != groups[0][i]).any():
                    yield from near_of(np.full(open_.sum(), i), j[open_])
        fine = size <= 1 << 16
        a0, b0, width, size = a0[fine], b0[fine], width[fine], size[fine]
        ends = np.cumsum(size)
        cut = 0
        while cut < len(size):
            stop = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + (1 << 21), side="right")))
            n = size[cut:stop]
            row = np.repeat(np.arange(cut, stop), n)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield from near_of(a0[row] + inner // width[row], b0[row] + inner % width[row])
            cut = stop

    stack = [(depth, np.array(pairs, dtype=np.int64).reshape(-1, 5).T)]
    while stack:
        depth, (a0, a1, b0, b1, err) = stack.pop()
        if len(a0) > FRONTIER:
            for lo in range(0, len(a0), FRONTIER):
                stack.append((depth, np.stack([x[lo:lo + FRONTIER] for x in (a0, a1, b0, b1, err)])))
            continue
        # Node pairs inside one component hold nothing new.
        parent = groups[0]
        steps = np.concatenate([[0], np.cumsum(parent[1:] != parent[:-1])])
        done = (steps[a0] == steps[a1 - 1]) & (steps[b0] == steps[b1 - 1]) & (parent[a0] == parent[b0])
        small = ~done & (((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (depth >= 64))
        if small.any():
            yield from compare(a0[small], a1[small], b0[small], b1[small])
        rest = ~done & ~small
        if not rest.any():
            continue
        a0, a1, b0, b1, err = (x[rest] for x in (a0, a1, b0, b1, err))
        if depth not in ones:
            bit = ((leaves >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)
            ones[depth] = np.concatenate([[0], np.cumsum(bit)])
        count = ones[depth]
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        own = (a0 == b0) & (a1 == b1)
        children = [
            (a0, am, b0, bm, err, None), (am, a1, bm, b1, err, None),
            (a0, am, bm, b1, err + 1, None), (am, a1, b0, bm, err + 1, ~own)]
        grown = []
        for x0, x1, y0, y1, e, only in children:
            ok = (x1 > x0) & (y1 > y0) & (e <= budget) & ~((x0 == y0) & (x1 == y1) & (x1 - x0 == 1))
            if only is not None:
                ok &= only
            grown.append(np.stack([x0[ok], x1[ok], y0[ok], y1[ok], e[ok]]))
        stack.append((depth + 1, np.concatenate(grown, axis=1)))


def block_layout(max_diff: int) -> list[tuple[int, int]]:
    """(first bit, width) of the max_diff + 1 blocks, from the most significant bit."""
    n = max_diff + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def rotations(distinct: DataFrame, max_diff: int) -> tuple[DataFrame, list[int]]:
    """(r, key, leaf, id) for every rotation r of every ``fp``, and the widths of the key blocks."""
    layout = block_layout(max_diff)
    rotated = [f"((fp << {at}) | shiftrightunsigned(fp, {64 - at}))" if at else "fp" for at, _ in layout]
    keyed = distinct.select(F.col("fp").alias("id"), F.explode(F.array(*[
        F.expr(f"named_struct('r', {r}, 'key', shiftrightunsigned({rot}, {64 - width}), 'leaf', {rot})")
        for r, (rot, (_, width)) in enumerate(zip(rotated, layout))])).alias("x")).select("x.*", "id")
    return keyed, [width for _, width in layout]


def slice_rotations(distinct: DataFrame) -> tuple[DataFrame, list[int]]:
    """The same for the 32-bit slices of (id, sketch, bands, digest): a trie per slice and rotation by whole bytes; digest and part, if there is one, stay.

    Slices miss about 9 % of the pairs of similarity 0.8.  Each band is one more
    trie, in which only equal leaves are near; all bands miss one pair in 13,000.
    """
    carried = ["id", *[c for c in ("part", "digest") if c in distinct.columns]]

    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=">u4").reshape(batch.num_rows, -1)
            slices = sketches.astype(np.uint64)
            hashed = np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype=np.uint64).reshape(-1, BANDS)

            def rows(r, key, leaf):
                return pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(leaf), r, dtype=np.int32)), pa.array(key.view(np.int64)), pa.array(leaf.view(np.int64)),
                    *[batch.column(c) for c in carried]], ["r", "key", "leaf", *carried])

            for s in range(slices.shape[1]):
                for turn in range(SLICE_DIFF + 1):
                    at = np.uint64(8 * turn)
                    x = ((slices[:, s] << at) | (slices[:, s] >> (np.uint64(32) - at))) & np.uint64(0xFFFFFFFF)
                    yield rows((SLICE_DIFF + 1) * s + turn, x >> np.uint64(24), x << np.uint64(32))
            for b in range(BANDS):
                x = hashed[:, b].copy()
                yield rows((SLICE_DIFF + 1) * slices.shape[1] + b, x >> np.uint64(48), x)

    keyed = distinct.select(*carried, "sketch", "bands").mapInArrow(
        spread, "r int, key long, leaf long, " + ", ".join(f"{c} {'binary' if c == 'digest' else 'long'}" for c in carried))
    return keyed, [8] * (SKETCH_BITS // 32 * (SLICE_DIFF + 1)) + [16] * BANDS


def link_forest(keyed: DataFrame, widths: list[int], max_diff: int, node_rows: int, whole: int = 0) -> DataFrame:
    """(a, b): a spanning forest, per subtrie, of all pairs of ids whose leaves are within ``max_diff`` bits.

    keyed: r, key (the first ``widths[r]`` bits of the leaf), leaf, id.  With digest,
    only pairs whose sets may be similar by their ``Digests``, too.  With part as well,
    not a forest but all such pairs of different parts; a pair may come from several tries.
    """
    carried = [c for c in ("part", "digest") if c in keyed.columns]
    hot = keyed.groupBy("r", "key").count().where(F.col("count") > node_rows).select(
        "r", "key", F.least(F.lit(12), F.ceil(F.log2(F.col("count") / node_rows)) + 1).cast("int").alias("split"))
    hot = materialize(hot, "hot_nodes")
    # A list of at most rows / node_rows subtries; beyond the checked size it is joined by shuffle.
    keyed = keyed.join(F.broadcast(hot) if hot.count() <= 10_000 else hot, ["r", "key"], "left").withColumn(
        "split", F.coalesce("split", F.lit(0)))
    width_of = "array(" + ",".join(map(str, widths)) + ")"
    node = f"CASE WHEN split = 0 THEN 0L ELSE shiftrightunsigned(leaf << {width_of}[r], 64 - split) END"
    keyed = keyed.withColumn("node", F.expr(node)).withColumn(
        "other", F.expr(f"explode(filter(sequence(0L, shiftleft(1L, split) - 1L), y -> bit_count(y ^ node) <= {max_diff}))"))
    keyed = keyed.selectExpr("r", "key", "least(node, other) AS x", "greatest(node, other) AS y", "node", "leaf", "split", "id", *carried)

    def walk(batches):
        for part in key_slices(batches, ["r", "key", "x", "y"], 200_000):
            columns = {c: part.column(c).to_numpy() for c in part.column_names if c != "digest"}
            digests = Digests(part.column("digest").to_pylist(), whole) if "digest" in carried else None
            r_of, x, y, node = (columns[c] for c in ("r", "x", "y", "node"))
            leaf = columns["leaf"].view(np.uint64)
            change = np.flatnonzero(np.concatenate([[True], np.any([columns[c][1:] != columns[c][:-1] for c in ("r", "key", "x", "y", "node")], axis=0)]))
            ends = np.append(change[1:], len(leaf))
            # Subtries of one depth are walked together.
            depths = (np.array(widths)[r_of] + columns["split"])[change]
            for depth in np.unique(depths):
                mine = np.flatnonzero(depths == depth)
                single = x[change[mine]] == y[change[mine]]
                pairs = [(change[m], ends[m], change[m], ends[m], 0) for m in mine[single] if ends[m] - change[m] > 1]
                for m in mine[~single]:
                    n = m + 1
                    if n < len(change) and all(columns[c][change[m]] == columns[c][change[n]] for c in ("r", "key", "x", "y")):
                        pairs.append((change[m], ends[m], change[n], ends[n], int(x[change[m]] ^ y[change[m]]).bit_count()))
                if not pairs:
                    continue
                if "part" in carried:
                    for i, j in near_pairs(leaf, pairs, int(depth), max_diff, [columns["part"]], digests.may_be_similar):
                        yield pa.RecordBatch.from_arrays([pa.array(columns["id"][i]), pa.array(columns["id"][j])], ["a", "b"])
                    continue
                parent = trie_links(leaf, pairs, int(depth), max_diff, digests.may_be_similar if digests else None)
                child = np.flatnonzero(parent != np.arange(len(parent)))
                yield pa.RecordBatch.from_arrays([pa.array(columns["id"][child]), pa.array(columns["id"][parent[child]])], ["a", "b"])

    return keyed.repartition("r", "key", "x", "y").sortWithinPartitions(
        "r", "key", "x", "y", "node", F.expr("leaf ^ (-9223372036854775807L - 1L)")).mapInArrow(walk, "a long, b long")


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42,
                       max_diff: int = 4, node_rows: int = 1_000_000) -> DataFrame:
    """One row per input row: key, fp (signed 64 bits) and component_id, the smallest key reachable.

    Texts without words, NULL included, have fingerprint 0 and link like any
    other.  Repeated rows stay.  NULL keys are never a component's id unless it
    has no other; an empty table gives an empty result.  Other columns are ignored.
    """
    rows = materialize(fingerprints(docs, key, text, shingle, seed), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    found = components(link_forest(*rotations(distinct, max_diff), max_diff, node_rows), "a", "b")
    member = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(member.join(ids, "root").select("fp", "component_id"), "fp")


def similar_sets(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two arrays of distinct values is 0.8 or more."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * common >= 4 * (len(a) + len(b) - common)


def similar_to(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``similar_sets`` of one sorted array with each of the others."""
    sizes = np.array([len(x) for x in others], dtype=np.int64)
    if not len(one):
        return sizes == 0
    values = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
    ends = np.cumsum(sizes)
    found = np.concatenate([[0], np.cumsum(hit)])
    common = found[ends] - found[ends - sizes]
    return 5 * common >= 4 * (len(one) + sizes - common)


def similar_forest(sets: list[np.ndarray], split: int | None, whole: int) -> list[tuple[int, int]]:
    """A spanning forest of all pairs of similar sets, or of those with one before and one from ``split`` on."""
    n = len(sets)
    parent, found = np.arange(n), []
    digests = Digests([digest(x) for x in sets], whole) if n > 8 else None
    for i in range(n if split is None else split):
        j = np.arange(i + 1 if split is None else split, n)
        j = j[parent[j] != parent[i]]
        if digests and len(j):
            j = j[digests.may_be_similar(np.full(len(j), i), j)]
        room = np.cumsum([len(sets[x]) for x in j]) // COMPARED
        for step in np.unique(room):
            at = j[room == step]
            at = at[parent[at] != parent[i]]
            if len(at):
                at = at[similar_to(sets[i], [sets[x] for x in at])]
                _, first = np.unique(parent[at], return_index=True)
                found += [(i, int(x)) for x in at[first]]
                parent = _merge(parent, np.full(len(at), i), at)
    return found


def similar_links(clusters: DataFrame, rows: DataFrame, shingle: int, seed: int, whole: int) -> DataFrame:
    """(a, b): per cluster and pair of chunks, a spanning forest of all its pairs with ``similar_sets`` of shingles.

    clusters: a stored table of id, cluster and size of the set.  A cluster is one
    chunk unless its rows or values are too many for a task; then its texts go to
    every pair of chunks they are in.
    """
    chunks = clusters.groupBy("cluster").agg(F.expr(
        f"CAST(GREATEST(CEIL(COUNT(*) / {CHUNK_ROWS}), CEIL(SUM(size) / {CHUNK_VALUES})) AS INT) AS chunks"))
    member = materialize(clusters.join(chunks, "cluster").selectExpr(
        f"id AS {UID}", "cluster", "chunks", "CAST(PMOD(XXHASH64(id), chunks) AS INT) AS own"), "members")

    def sets(batches):
        for batch in batches:
            hashes = [np.unique(shingle_hashes(t, shingle, seed)).tobytes() for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in (UID, "cluster", "chunks", "own")], pa.array(hashes, pa.binary())],
                ["id", "cluster", "chunks", "own", "hashes"])

    def compare(batches):
        for part in key_slices(batches, ["cluster", "x", "y"], 1):
            columns = {c: part.column(c).to_numpy() for c in ("cluster", "x", "y", "own", "id")}
            hashes = [np.frombuffer(x, dtype="<u8") for x in part.column("hashes").to_pylist()]
            starts = np.flatnonzero(np.concatenate([[True], np.any([columns[c][1:] != columns[c][:-1] for c in ("cluster", "x", "y")], axis=0)]))
            links = []
            for lo, hi in zip(starts, np.append(starts[1:], len(hashes))):
                x, y = columns["x"][lo], columns["y"][lo]
                split = None if x == y else int((columns["own"][lo:hi] == x).sum())
                links += [(lo + i, lo + j) for i, j in similar_forest(hashes[lo:hi], split, whole)]
            i, j = np.array(links, dtype=np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(columns["id"][i]), pa.array(columns["id"][j])], ["a", "b"])

    texts = rows.select(UID, F.coalesce("text", F.lit("")).cast("binary").alias("t")).join(
        F.broadcast(member) if member.count() <= LISTED else member, UID)
    hashed = texts.select(UID, "cluster", "chunks", "own", "t").mapInArrow(
        sets, "id long, cluster long, chunks int, own int, hashes binary")
    blocks = hashed.withColumn("other", F.expr("EXPLODE(SEQUENCE(0, chunks - 1))")).selectExpr(
        "cluster", "LEAST(own, other) AS x", "GREATEST(own, other) AS y", "own", "id", "hashes")
    return blocks.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "own", "id").mapInArrow(
        compare, "a long, b long")


def similar_rows(rows: DataFrame, shingle: int = 5, seed: int = 42, whole: int = 66, node_rows: int = 1_000_000) -> DataFrame:
    """``similar_components`` of a stored table of row number, key and text; the row number stays, too."""

    def run(batches):
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, shingle, seed)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(map(f, sets), pa.binary()) for f in (set_sketch, bands, digest)],
                 pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()), pa.array(map(len, sets), pa.int64())],
                [UID, "key", "sketch", "bands", "digest", "same", "size"])

    kind = rows.schema["key"].dataType.simpleString()
    sketched = materialize(rows.select(UID, "key", F.coalesce("text", F.lit("")).cast("binary").alias("t")).mapInArrow(
        run, f"{UID} long, key {kind}, sketch binary, bands binary, digest binary, same binary, size long"), "sketches")
    # Equal shingle sets are one leaf.
    distinct = materialize(sketched.groupBy("same").agg(
        F.min("key").alias("least"), F.min(UID).alias("id"), *[F.first(c).alias(c) for c in ("sketch", "bands", "digest", "size")]), "distinct")
    near = components(link_forest(*slice_rotations(distinct), SLICE_DIFF, node_rows, whole), "a", "b")
    clusters = materialize(distinct.select("id", "size").join(near.selectExpr("node AS id", "root AS cluster"), "id"), "clusters")
    found = components(similar_links(clusters, rows, shingle, seed, whole), "a", "b")
    member = distinct.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return sketched.join(member.join(ids, "root").select("same", "component_id"), "same").select(UID, "key", "component_id")


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per input row: key and component_id, links being texts whose shingle sets have a Jaccard similarity of 0.8 or more.

    Sets of similarity 0.8 differ in 15 % of SimHash bits, 38 of SKETCH_BITS with a spread
    of 6; short texts in some more.  Each 32-bit slice goes through tries with an error
    budget of SLICE_DIFF, each MinHash band through one.  A pair that meets in one of
    them is a candidate unless its parity digests prove that it is not similar (sets of
    more than some 1,400 shingles: or differ in over ``whole`` of all SimHash bits), and is
    linked if the sets themselves, as 64-bit hashes, are similar.
    Edge cases as in ``simhash_components``; texts without words are alike.
    """
    rows = stored(with_uid(docs.select(F.col(key).alias("key"), F.col(text).alias("text"))), "near_texts")
    return similar_rows(rows, **options).select("key", "component_id")


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those whose component (``similar_components``) has a row of smaller key.

    Rows that repeat a key are told apart by a row number; a NULL key is the last
    choice.  All columns stay as they are.
    """
    order = F.struct(F.col(f"_row.{key}").isNull().alias("a"), F.col(f"_row.{key}").alias("k"), F.col(UID).alias("u"))
    rows = stored(with_uid(docs.select(F.struct("*").alias("_row"))), "near_dedup")
    found = similar_rows(rows.select(UID, order.alias("key"), F.col(f"_row.{text}").alias("text")), **options)
    drop = found.where("key != component_id").select(UID)
    return rows.join(drop, UID, "left_anti").select("_row.*")
