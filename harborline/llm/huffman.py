"""Token ids on disk: length-limited canonical Huffman codes over global counts.

Writing: count ids over all documents (Spark; at most one row per id of the
vocabulary reaches the driver), derive code lengths of at most ``limit`` bits by
package-merge, deal documents to shards by key range, and encode them in key
order into chunks.  A chunk holds whole documents: a header, keys and token
counts, the bit offset of every block of BLOCK ids, and the bit stream.

Reading: every block starts at its checkpoint, so blocks are independent; all
blocks of a chunk are decoded side by side, one table look-up per id.

The folder has ``codebook`` (one row: code length per id) and ``chunks`` (shard,
chunk, counts, data), both written by Spark so that any store it knows will do;
order by (shard, chunk) is key order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from harborline.llm.common import UID, new_folder, stored
from harborline.llm.tokens import encode_documents

# The file format.
MAGIC = b"HLTK"
HEADER = struct.Struct("<4sIQQQ")   # magic, codebook crc32, documents, ids, bits
BLOCK = 512                         # ids between checkpoints
CHUNK_IDS = 1 << 20                 # a chunk is closed at so many ids; a longer document is one chunk


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for ids that never occur."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    level, leaf_flags = leaves, [np.ones(len(leaves), dtype=bool)]
    for _ in range(limit - 1):
        even = len(level) // 2 * 2
        packages = level[0:even:2] + level[1:even:2]
        merged = np.concatenate([leaves, packages])
        order = np.argsort(merged, kind="stable")
        level = merged[order]
        leaf_flags.append(order < len(leaves))
    taken = 2 * len(used) - 2
    for flags in reversed(leaf_flags):
        n = int(flags[:taken].sum())
        lengths[used[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes by id, ids in code order)."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), dtype=np.uint64)
    if len(order):
        n = lengths[order].astype(np.int64)
        top = int(n[-1])
        step = np.int64(1) << (top - n)
        codes[order] = ((np.cumsum(step) - step) >> (top - n)).astype(np.uint64)
    return codes, order


def encode_chunk(keys: bytes, counts: np.ndarray, ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, crc: int) -> bytes:
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    bits = int(ends[-1])
    word, free = at >> 6, 64 - (at & 63) - n
    code = codes[ids]
    fits = free >= 0
    high = np.where(fits, code << np.where(fits, free, 0).astype(np.uint64), code >> np.where(fits, 0, -free).astype(np.uint64))
    stream = np.zeros((bits + 63) // 64 + 1, dtype=np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    stream[word[starts]] = np.bitwise_or.reduceat(high, starts)
    over = np.flatnonzero(~fits)
    stream[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
    return b"".join([
        HEADER.pack(MAGIC, crc, len(counts), len(ids), bits), struct.pack("<Q", len(keys)), keys,
        counts.astype("<u8").tobytes(), at[::BLOCK].astype("<u8").tobytes(), stream.astype(">u8").tobytes()])


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.crc = zlib.crc32(lengths.tobytes())
        _, order = canonical(lengths)
        self.top = int(lengths.max()) if len(lengths) else 1
        spread = np.int64(1) << (self.top - lengths[order].astype(np.int64))
        self.symbol = np.zeros(1 << self.top, dtype=np.uint32)
        self.width = np.ones(1 << self.top, dtype=np.int64)
        filled = int(spread.sum())
        self.symbol[:filled] = np.repeat(order.astype(np.uint32), spread)
        self.width[:filled] = np.repeat(lengths[order].astype(np.int64), spread)

    def chunk(self, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(keys, ids per document, all ids)."""
        magic, crc, n_docs, n_ids, bits = HEADER.unpack_from(data)
        if magic != MAGIC or crc != self.crc:
            raise ValueError("not a chunk of this codebook")
        (n_keys,) = struct.unpack_from("<Q", data, HEADER.size)
        at = HEADER.size + 8
        keys = data[at:at + n_keys]
        counts = np.frombuffer(data, "<u8", n_docs, at + n_keys).astype(np.int64)
        at += n_keys + 8 * n_docs
        lanes = -(-n_ids // BLOCK)
        position = np.frombuffer(data, "<u8", lanes, at).astype(np.int64)
        stream = np.frombuffer(data, np.uint8, -1, at + 8 * lanes)
        padded = np.concatenate([stream, np.zeros(8, dtype=np.uint8)]).astype(np.uint32)
        window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        out = np.empty((BLOCK, lanes), dtype=np.uint32)
        last = len(window) - 1
        shift = np.uint32(32 - self.top)
        for step in range(min(BLOCK, n_ids)):
            byte = np.minimum(position >> 3, last)
            index = (window[byte] << (position & 7).astype(np.uint32)) >> shift
            out[step] = self.symbol[index]
            position += self.width[index]
        return keys, counts, out.T.reshape(-1)[:n_ids]


def count_ids(encoded: DataFrame, vocabulary_size: int) -> np.ndarray:
    def count(batches):
        total = np.zeros(vocabulary_size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=vocabulary_size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    counts = np.zeros(vocabulary_size, dtype=np.int64)
    rows = encoded.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in rows.collect():   # at most one row per id of the vocabulary
        counts[row["id"]] = row["n"]
    return counts


def write_token_file(encoded: DataFrame, path: str, limit: int = 18, vocabulary_size: int = 50_257) -> None:
    """Write (key, ids) rows in ascending key order; NULL keys first, equal keys by row number."""
    spark = encoded.sparkSession
    lengths = code_lengths(count_ids(encoded, vocabulary_size), limit)
    spark.createDataFrame([(bytearray(lengths.tobytes()), limit)], "lengths binary, max_bits int").write.parquet(f"{path}/codebook")

    def shards(batches):
        codes, _ = canonical(lengths)
        crc = zlib.crc32(lengths.tobytes())
        shard, chunk = TaskContext.get().partitionId(), 0
        keys, counts, ids, size = [], [], [], 0

        def close():
            sink = pa.BufferOutputStream()
            column = pa.chunked_array(keys).combine_chunks()
            with pa.ipc.new_stream(sink, pa.schema([("key", column.type)])) as out:
                out.write_table(pa.table({"key": column}))
            n = np.array(counts, dtype=np.int64)
            data = encode_chunk(sink.getvalue().to_pybytes(), n, np.frombuffer(b"".join(ids), "<u2"), codes, lengths, crc)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([len(n)], pa.int64()),
                 pa.array([int(n.sum())], pa.int64()), pa.array([data], pa.binary())],
                ["shard", "chunk", "n_docs", "n_ids", "data"])

        for batch in batches:
            for row, (encoded_ids, n) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                keys.append(batch.column(0).slice(row, 1))
                counts.append(n)
                ids.append(encoded_ids)
                size += n
                if size >= CHUNK_IDS:
                    yield close()
                    keys, counts, ids, size, chunk = [], [], [], 0, chunk + 1
        if counts:
            yield close()

    order = [F.col("key").asc_nulls_first(), F.col(UID).asc()]
    encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "ids", "n").mapInArrow(
        shards, "shard int, chunk int, n_docs long, n_ids long, data binary",
    ).write.option("compression", "uncompressed").parquet(f"{path}/chunks")


def read_token_file(spark: SparkSession, path: str, key_type: str) -> DataFrame:
    """(key, start, n_tokens, ids) of every document, ids as little-endian unsigned 32 bits."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").first()["lengths"]), dtype=np.uint8)
    chunks = spark.read.parquet(f"{path}/chunks")

    sizes = chunks.select("shard", "chunk", "n_ids")
    in_shard = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_at"))
    places = sizes.join(shards, "shard").select(
        "shard", "chunk", (F.col("shard_at") + F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0))).cast("long").alias("at"))
    # One small row per million ids; beyond the checked count the join shuffles the chunks, still compressed.
    if sizes.count() <= 200_000:
        places = F.broadcast(places)

    def decode(batches):
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(lengths)
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, n, ids = decoder.chunk(data)
                key = pa.ipc.open_stream(keys).read_all().column(0).combine_chunks()
                flat, ends = ids.astype("<u4").tobytes(), np.cumsum(n)
                starts = ends - n
                for lo in range(0, len(n), 500):
                    hi = min(len(n), lo + 500)
                    yield pa.RecordBatch.from_arrays(
                        [key.slice(lo, hi - lo), pa.array(at + starts[lo:hi]), pa.array(n[lo:hi]),
                         pa.array([flat[4 * a:4 * b] for a, b in zip(starts[lo:hi], ends[lo:hi])], pa.binary())],
                        ["key", "start", "n_tokens", "ids"])

    return chunks.join(places, ["shard", "chunk"]).select("at", "data").mapInArrow(
        decode, f"key {key_type}, start long, n_tokens long, ids binary")


def store_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.json",
                    keep_space: bool = True, end_id: int = 0, limit: int = 18, path: str | None = None) -> DataFrame:
    """Encode whole texts, write them to a token file in key order and return what reading it back gives.

    NULL and empty texts are the end id alone; repeated keys stay separate
    documents; NULL keys come first; an empty table gives an empty file and
    result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "token-file")
    encoded = stored(encode_documents(docs, key, text, vocabulary, keep_space, end_id), "ids")
    write_token_file(encoded, path, limit)
    return read_token_file(spark, path, docs.schema[key].dataType.simpleString())
