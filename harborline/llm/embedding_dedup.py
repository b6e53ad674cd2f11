"""Embedding near-dedup: random-hyperplane sign hashing, exact cosine check, connected components.

Equal vectors of a label are one class from the start, so thousands of copies
cost one row.  Every class gets ``tables`` keys of ``bits`` signs of dot products
with random hyperplanes; two vectors at the threshold's angle agree in all signs
of at least one table but for a chance of ``miss``.  All signs together are the
class's signature.  Classes that share a key and whose signatures differ in no
more bits than the threshold's angle explains (six standard deviations on top)
are candidates; connected candidates form a cell, and only the vectors of cells
are shuffled, once.  Inside a cell cosines of all pairs are computed in double
precision by blocks of a matrix product.  What leaves a task is a count per
vector and a spanning forest, never the pairs.

Keys of two classes are candidates at once; keys of up to ``group_rows`` classes
are searched in one task by signature; larger ones, dense regions that as many
signs do not tell apart, are tied to their smallest class without comparing,
which only makes a cell larger.  Cells of more than ``cell_rows`` classes are cut
into chunks, and every two chunks are compared by a task of their own.  So no
pair is dropped at any size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import UID, key_slices, ragged_positions, with_uid
from harborline.llm.components import components
from harborline.llm.simhash_trie import _merge
from harborline.session import materialize

SPARE_BITS = 4            # signs per key beyond the logarithm of the largest label


def layout(largest: int, threshold: float, miss: float) -> tuple[int, int, int]:
    """(bits, tables, most): signs per key, number of keys, and differing signs a candidate may have in all."""
    bits = min(62, max(8, math.ceil(math.log2(max(2, largest))) + SPARE_BITS))
    differs = math.acos(threshold) / math.pi
    tables = math.ceil(math.log(miss) / math.log1p(-((1 - differs) ** bits)))
    total = bits * tables
    return bits, tables, math.ceil(total * differs + 6 * math.sqrt(total * differs * (1 - differs)))


def unit_rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of length one in double precision, which rows have a direction)."""
    sound = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
    values = np.where(sound[:, None], values, 1.0)
    # By the largest component first: squares of extreme values would overflow or vanish.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True)), sound


def signatures(rows: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Add dim, same (digest of the vector, NULL without a direction), keys and the vector's bytes; drop the array."""
    planes: dict[int, np.ndarray] = {}
    places = np.left_shift(np.uint64(1), np.arange(bits, dtype=np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # A NULL component becomes NaN; adding zero makes -0.0 and 0.0 one value.
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            starts = np.cumsum(lengths) - lengths
            same, keys, vectors = ([None] * len(lengths) for _ in range(3))
            for dim in np.unique(lengths[lengths > 0]):
                mine = np.flatnonzero(lengths == dim)
                values = flat[ragged_positions(starts[mine], lengths[mine])].reshape(len(mine), dim)
                unit, sound = unit_rows(values)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
                signs = (unit @ planes[dim] >= 0).reshape(len(mine), tables, bits)
                found = signs @ places
                for at, ok, value, key in zip(mine, sound, values, found):
                    if ok:
                        vectors[at] = value.tobytes()
                        same[at] = hashlib.blake2b(vectors[at], digest_size=16).digest()
                        keys[at] = key.view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(UID), batch.column("id"), batch.column("label"), pa.array(lengths, pa.int32()),
                pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(vectors, pa.binary())],
                [UID, "id", "label", "dim", "same", "keys", "vector"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    return rows.mapInArrow(
        run, f"{UID} long, id {kinds['id']}, label {kinds['label']}, dim int, same binary, keys array<long>, vector binary")


def near_forest(signs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of a spanning forest of the rows whose signatures differ in at most ``most`` bits.

    A row that is reached is not compared with its own component again.
    """
    left, right = [], []
    unseen = np.arange(len(signs))
    while len(unseen):
        queue, unseen = [unseen[0]], unseen[1:]
        while queue and len(unseen):
            i = queue.pop()
            near = np.bitwise_count(signs[unseen] ^ signs[i]).sum(axis=1, dtype=np.int64) <= most
            reached, unseen = unseen[near], unseen[~near]
            left.append(np.full(len(reached), i))
            right.append(reached)
            queue.extend(reached)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return join(left), join(right)


def candidates(classes: DataFrame, most: int, group_rows: int) -> DataFrame:
    """(a, b): links whose components hold every two classes that share a key and differ in at most ``most`` signs."""
    keyed = classes.select("id", F.posexplode("keys").alias("table", "key"), "label", "dim").select(
        "id", F.xxhash64("label", "dim", "table", "key").alias("bucket"))
    busy = materialize(
        keyed.groupBy("bucket").agg(F.count("*").alias("members"), F.min("id").alias("a"), F.max("id").alias("b"))
        .where("members > 1"), "busy_keys")
    signs = classes.select("id", "keys")

    twos = busy.where("members = 2").select("a", "b").distinct()
    twos = twos.join(signs.withColumnsRenamed({"id": "a", "keys": "of_a"}), "a").join(
        signs.withColumnsRenamed({"id": "b", "keys": "of_b"}), "b")
    twos = twos.where(F.expr(f"aggregate(zip_with(of_a, of_b, (x, y) -> bit_count(x ^ y)), 0, (s, n) -> s + n) <= {most}"))

    member = keyed.join(busy.where("members > 2").drop("b"), "bucket")
    dense = member.where(F.col("members") > group_rows).where("id <> a").select("a", F.col("id").alias("b"))
    some = materialize(member.where(F.col("members") <= group_rows).select("bucket", "id"), "members").join(signs, "id")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in key_slices(batches, ["bucket"], 50_000):
            ids, bucket = part.column("id").to_numpy(), part.column("bucket").to_numpy()
            keys = pc.list_flatten(part.column("keys")).to_numpy().view(np.uint64).reshape(len(ids), -1)
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            for lo, hi in zip(edges, edges[1:]):
                i, j = near_forest(keys[lo:hi], most)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[lo + i]), pa.array(ids[lo + j])], ["a", "b"])

    found = some.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(search, "a long, b long")
    return materialize(twos.select("a", "b").unionByName(dense).unionByName(found), "candidates")


def compare_cells(members: DataFrame, threshold: float) -> DataFrame:
    """Of (root, x, y, label, dim, chunk, id, copies, vector): links (a, b) of a forest, and (a, n) with b NULL, the copies a links with."""

    def links(chunk: np.ndarray, x: int, y: int, ids: np.ndarray, copies: np.ndarray, unit: np.ndarray):
        rows, columns = (np.flatnonzero(chunk == c) for c in (x, y))
        degree, parent = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for lo in range(0, len(rows), 512):
            block = rows[lo:lo + 512]
            near = unit[block] @ unit[columns].T >= threshold
            i, j = np.nonzero(near)
            i, j = block[i], columns[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.add.at(degree, i, copies[j])
            if x != y:   # otherwise the pair also turns up the other way round
                np.add.at(degree, j, copies[i])
            parent = _merge(parent, i, j)
        return degree, parent

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in key_slices(batches, ["root", "x", "y"], 4_096):
            column = {c: part.column(c).to_numpy() for c in ("root", "x", "y", "kind", "dim", "chunk", "id", "copies")}
            vectors = part.column("vector")
            changed = np.any([column[c][1:] != column[c][:-1] for c in ("root", "x", "y", "kind", "dim")], axis=0)
            edges = np.flatnonzero(np.concatenate([[True], changed, [True]]))
            a, b, n = [], [], []
            for lo, hi in zip(edges, edges[1:]):
                if hi - lo == 1:
                    continue
                raw = b"".join(vectors.slice(lo, hi - lo).to_pylist())
                unit, _ = unit_rows(np.frombuffer(raw, dtype=np.float64).reshape(hi - lo, -1))
                ids = column["id"][lo:hi]
                degree, parent = links(column["chunk"][lo:hi], column["x"][lo], column["y"][lo], ids, column["copies"][lo:hi], unit)
                some, child = np.flatnonzero(degree), np.flatnonzero(parent != np.arange(len(parent)))
                a += [ids[some], ids[child]]
                b += [np.full(len(some), -1), ids[parent[child]]]
                n += [degree[some], np.zeros(len(child), dtype=np.int64)]
            if a:
                a, b, n = (np.concatenate(v) for v in (a, b, n))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=b < 0), pa.array(n)], ["a", "b", "n"])

    return members.repartition("root", "x", "y").sortWithinPartitions("root", "x", "y", "kind", "dim", "id").select(
        "root", "x", "y", "kind", "dim", "chunk", "id", "copies", "vector").mapInArrow(run, "a long, b long, n long")


def embedding_near_dedup(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                         threshold: float = 0.98, miss: float = 1e-4, seed: int = 42, group_rows: int = 20_000,
                         cell_rows: int = 2_048) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id and kept.

    Rows link when their labels are equal and not NULL, their vectors have the same
    length, and the cosine in double precision is ``threshold`` or more; a pair at
    the threshold itself is missed with probability ``miss``, closer pairs less.
    ``n_links`` counts the other rows linked directly, equal vectors included;
    ``component_id`` is the smallest key reachable; ``kept`` marks the rows whose
    key that is.  A vector that is NULL, empty or zero, or has a NULL or non-finite
    component, links with nothing, and neither does a row without a label: it is its own component.
    A NULL key is never a component's id unless it has no other; then component_id is
    NULL and the row is kept.  Rows that repeat key and vector link with each other
    and are all kept or all dropped.  Vectors of any length and magnitude are read
    whole.  An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must be between 0 and 1")
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    rows = materialize(with_uid(rows), "embeddings")
    largest = rows.where("label IS NOT NULL").groupBy("label", F.size("embedding")).count().agg(F.max("count")).first()[0]
    bits, tables, most = layout(largest or 1, threshold, miss)
    signed = materialize(signatures(rows, bits, tables, seed), "signatures")

    alike = ["label", "dim", "same"]
    sound = signed.where("same IS NOT NULL AND label IS NOT NULL")
    groups = materialize(sound.groupBy(*alike).agg(
        F.min(UID).alias("class"), F.min("id").alias("least"), F.count("*").alias("copies")), "classes")
    classes = sound.join(groups.select("class", "copies"), F.col(UID) == F.col("class")).select(
        F.col("class").alias("id"), "label", "dim", "keys", "vector", "copies")

    near = components(candidates(classes.drop("vector"), most, group_rows), "a", "b")
    sizes = near.groupBy("root").agg(F.ceil(F.count("*") / cell_rows).cast("long").alias("chunks"))
    cells = near.join(sizes, "root").withColumn("chunk", F.expr("pmod(xxhash64(node), chunks)"))
    cells = cells.withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)"))).select(
        F.col("node").alias("id"), "root", "chunk", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"))
    members = classes.select("id", F.col("label").cast("string").alias("kind"), "dim", "copies", "vector").join(cells, "id")
    compared = materialize(compare_cells(members, threshold), "compared")

    found = components(compared.where("b IS NOT NULL").select("a", "b"), "a", "b").withColumnRenamed("node", "class")
    degree = compared.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("others"))
    member = groups.join(found, "class", "left").withColumn("root", F.coalesce("root", "class")).join(degree, "class", "left")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    member = member.join(least, "root").select(
        *alike, (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = signed.select("id", *alike).join(member, alike, "left")
    own = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias("key"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"))
