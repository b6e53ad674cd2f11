"""Encode whole texts with a public tokenizer, each distinct piece between white space once per worker.

Both vocabularies split a text before their merges, and never inside "white space,
then anything else" - so pieces of that form are encoded alone, cached, and
joined again.  tests/llm compare the result with the library's own encoding.
Splitting, finding a batch's distinct pieces and joining ids run on Arrow and
numpy arrays; Python sees each distinct piece of a batch once.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import UID, ragged_positions, with_uid

CACHE_PIECES = 1_000_000   # then the cache starts afresh; only speed depends on it
MARK = "\x01"              # a token of its own between pieces that white space only separates
JOINED = 1024              # pieces encoded as one text, apart by such a token
RAW = "\x00"               # prefix of pieces that carry their own white space
# White space in a row, at the start or end of a line, or other than space and line feed: split by SLOW_SPLIT.
UNUSUAL = (r"[ \n][ \n]|[\x00\x09\x0B-\x0D\x1C-\x1F\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}"
           r"\x{202F}\x{205F}\x{3000}\x{FEFF}]")
SLOW_SPLIT = re.compile(r"\s*\S+|\s+")


class PieceEncoder:
    """Ids of texts; ``keep_space``: white space is part of the pieces, else it only separates."""

    def __init__(self, vocabulary: str, keep_space: bool, end_id: int | None = None):
        # Spark runs one worker per core; threads of the library would compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.keep_space = keep_space
        self.end_id = end_id
        # Where white space counts, a special token of the vocabulary keeps pieces apart.
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip)]
        self.mark_text = f" {MARK} " if not keep_space else special[0] if special else ""
        mark = self.tokenizer.encode(self.mark_text.strip(), add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.clear()

    def clear(self) -> None:
        # Piece 0 is the end of a document.
        end = [] if self.end_id is None else [self.end_id]
        self.known: dict[str | None, int] = {None: 0}
        self.flat = np.zeros(1 << 16, dtype=np.uint16)
        self.flat[:len(end)] = end
        self.starts, self.counts = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int32)
        self.counts[0] = self.used = len(end)

    def _chunk(self, piece: str) -> str:
        if not self.keep_space:
            return piece
        return piece[1:] if piece.startswith(RAW) else piece if piece.startswith("\n") else " " + piece

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.mark is not None:
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark_text.join(chunks)], add_special_tokens=False)[0].ids)
            marks = np.flatnonzero(ids == self.mark)
            # A chunk that holds the mark itself gives more of them.
            if len(marks) == len(chunks) - 1 and not (MARK in self.mark_text and any(MARK in c for c in chunks)):
                return np.delete(ids, marks), np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
        found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.array([i for ids in found for i in ids], dtype=np.int64), counts

    def _learn(self, pieces: list[str]) -> None:
        first = len(self.known)
        self.known.update(zip(pieces, range(first, first + len(pieces))))
        for lo in range(0, len(pieces), JOINED):
            part = pieces[lo:lo + JOINED]
            ids, counts = self._encode([self._chunk(p) for p in part])
            if len(ids) and ids.max() > 0xFFFF:
                raise ValueError("the vocabulary has ids beyond 16 bits")
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while first + lo + len(part) > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.flat[self.used:self.used + len(ids)] = ids
            self.counts[first + lo:first + lo + len(part)] = counts
            self.starts[first + lo:first + lo + len(part)] = self.used + np.cumsum(counts) - counts
            self.used += len(ids)

    def _gather(self, lists: pa.Array) -> pa.Array:
        """Ids of every list of pieces, then the end, as little-endian unsigned 16 bits."""
        pieces = lists.flatten().dictionary_encode()
        names = pieces.dictionary.to_pylist()
        number = np.fromiter(map(self.known.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        missing = np.flatnonzero(number < 0)
        if len(self.known) + len(missing) > CACHE_PIECES and len(self.known) > 1:
            self.clear()
            missing = np.arange(len(names))
        if len(missing):
            number[missing] = len(self.known) + np.arange(len(missing))
            self._learn([names[i] for i in missing])
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        index = np.insert(number[pieces.indices.to_numpy()] if len(names) else number, offsets[1:], 0)
        counts = self.counts[index]
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[offsets + np.arange(len(offsets))]
        ids = self.flat[ragged_positions(self.starts[index], counts)]
        return pa.Array.from_buffers(
            pa.large_binary(), len(lists), [None, pa.py_buffer(ends * 2), pa.py_buffer(ids.astype("<u2"))])

    def encode(self, texts: pa.Array) -> pa.Array:
        """A binary array: the ids of each text of a string array without NULLs."""
        texts = texts.cast(pa.large_string())
        if not self.keep_space:
            return self._gather(pc.ascii_split_whitespace(texts))
        odd = pc.match_substring_regex(texts, UNUSUAL).to_numpy(zero_copy_only=False)
        plain = pc.replace_substring(texts.filter(pa.array(~odd)), "\n", " \n")
        fast = self._gather(pc.split_pattern(pc.binary_join_element_wise(pa.scalar(RAW, pa.large_string()), plain, pa.scalar("", pa.large_string())), " "))
        if not odd.any():
            return fast
        split = [[RAW + c for c in SLOW_SPLIT.findall(t)] for t in texts.filter(pa.array(odd)).to_pylist()]
        slow = self._gather(pa.array(split, pa.large_list(pa.large_string())))
        place = np.empty(len(odd), dtype=np.int64)
        place[~odd], place[odd] = np.arange((~odd).sum()), (~odd).sum() + np.arange(odd.sum())
        return pa.concat_arrays([fast, slow]).take(pa.array(place))


@lru_cache(maxsize=2)
def worker_encoder(vocabulary: str, keep_space: bool, end_id: int) -> PieceEncoder:
    return PieceEncoder(vocabulary, keep_space, end_id)


def encode_documents(docs: DataFrame, key: str, text: str, vocabulary: str, keep_space: bool, end_id: int) -> DataFrame:
    """(_uid, key, ids as little-endian unsigned 16 bits, n): every text's ids and then ``end_id``; NULL is empty."""

    def run(batches):
        encoder = worker_encoder(vocabulary, keep_space, end_id)
        for batch in batches:
            ids = encoder.encode(batch.column(2))
            n = pc.divide(pc.binary_length(ids), 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids.cast(pa.binary()), n], [UID, "key", "ids", "n"])

    kind = docs.schema[key].dataType.simpleString()
    rows = with_uid(docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))).select(UID, "key", "t")
    return rows.mapInArrow(run, f"{UID} long, key {kind}, ids binary, n long")
