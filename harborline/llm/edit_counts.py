"""Edit-aware token counts: a segment tree of token counts per document.

Building: a text is cut into leaves of about LEAF_CHARS code points, at places
where the tokenizer splits whatever surrounds them (before a space or line feed
that follows a character that is no white space).  Leaves are encoded, and two
heaps hold code points and tokens of every subtree.

Editing: an edit descends to the leaves it touches by subtree lengths.  Those
leaves and one more on each side - the context that decides where the
tokenizer splits - become one region; only the region's text is encoded again,
its count goes to the first of its leaves and the sums above are updated.  The
rest of the document is not encoded.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import stored
from harborline.llm.tokens import PieceEncoder

LEAF_CHARS = 256
# Before a space or line feed, after a character that no tokenizer takes for white space.
CUT = re.compile("(?<=[^\\s᠎​﻿\x00\x1c-\x1f])(?=[ \n])")


def leaves(text: str) -> list[int]:
    """Lengths of the leaves; an empty text has one empty leaf."""
    cuts, at = [0], 0
    while found := CUT.search(text, at + LEAF_CHARS):
        at = found.start()
        cuts.append(at)
    cuts.append(len(text))
    return [b - a for a, b in zip(cuts, cuts[1:])]


def heap(values: list[int]) -> list[int]:
    """Sums of a complete binary tree: node i has children 2 i and 2 i + 1, leaves are the second half."""
    size = 1 << max(0, len(values) - 1).bit_length()
    tree = [0] * size + list(values) + [0] * (size - len(values))
    for i in range(size - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def put(tree: list[int], leaf: int, value: int) -> None:
    i = len(tree) // 2 + leaf
    change = value - tree[i]
    while i:
        tree[i] += change
        i //= 2


def leaf_at(chars: list[int], position: int) -> tuple[int, int]:
    """(leaf that holds ``position``, its start); a position at a boundary belongs to the leaf before it."""
    i, start, size = 1, 0, len(chars) // 2
    while i < size:
        i *= 2
        if position > start + chars[i] and chars[i + 1]:
            start += chars[i]
            i += 1
    return i - size, start


def region(chars: list[int], at: int, end: int) -> tuple[int, int, int, int]:
    """First and last leaf to encode again, and the code points they span."""
    size = len(chars) // 2
    first, start = leaf_at(chars, at)
    last, last_start = leaf_at(chars, min(end + 1, chars[1]))
    stop = last_start + chars[size + last]
    lo, hi = first - 1, last + 1
    while lo >= 0 and not chars[size + lo]:
        lo -= 1
    if lo >= 0:
        first, start = lo, start - chars[size + lo]
    while hi < size and not chars[size + hi]:
        hi += 1
    if hi < size:
        last, stop = hi, stop + chars[size + hi]
    return first, last, start, stop


_encoders: dict[str, PieceEncoder] = {}


def counter(vocabulary: str) -> PieceEncoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = PieceEncoder(vocabulary, True)
    return _encoders[vocabulary]


def token_counts(encoder: PieceEncoder, texts: list[str]) -> list[int]:
    if not texts:
        return []
    return (pc.binary_length(encoder.encode(pa.array(texts, pa.large_string()))).to_numpy() // 2).tolist()


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.json",
          edits: str | None = None) -> DataFrame:
    """The index, written once: key, text, chars and tokens (heaps), edits if given as a column.

    NULL text counts as empty.  Repeated rows have separate trees; an empty table
    gives an empty index.  Other columns are ignored.
    """

    def run(batches):
        encoder = counter(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = [leaves(t) for t in texts]
            flat = []
            for t, own in zip(texts, sizes):
                at = 0
                for n in own:
                    flat.append(t[at:at + n])
                    at += n
            counts = token_counts(encoder, flat)
            chars, tokens, at = [], [], 0
            for own in sizes:
                chars.append(heap(own))
                tokens.append(heap(counts[at:at + len(own)]))
                at += len(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))],
                [*batch.schema.names, "chars", "tokens"])

    kind = docs.schema[key].dataType.simpleString()
    columns = [F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    schema = f"key {kind}, text string"
    if edits:
        columns.append(F.col(edits).alias("edits"))
        schema += ", edits array<struct<at:long,remove:long,insert:string>>"
    return stored(docs.select(*columns).mapInArrow(run, f"{schema}, chars array<int>, tokens array<int>"), "trees")


def apply_edits(index: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """The index after its ``edits``, in order, with tokens_before and encoded_chars.

    An edit removes ``remove`` code points at ``at`` and inserts a text there.
    Positions and lengths beyond the text are clipped, NULLs count as 0 and as
    the empty text; a document without edits stays as it is.
    """

    def run(batches):
        encoder = counter(vocabulary)
        for batch in batches:
            texts, edits, chars, tokens = (batch.column(c).to_pylist() for c in ("text", "edits", "chars", "tokens"))
            before, encoded = [t[1] for t in tokens], [0] * len(texts)
            edits = [e or [] for e in edits]
            for turn in range(max(map(len, edits), default=0)):
                todo, pieces = [], []
                for i, own in enumerate(edits):
                    if turn >= len(own):
                        continue
                    e = own[turn] or {}
                    t = texts[i]
                    at = min(max(e.get("at") or 0, 0), len(t))
                    end = min(at + max(e.get("remove") or 0, 0), len(t))
                    new = e.get("insert") or ""
                    first, last, start, stop = region(chars[i], at, end)
                    piece = t[start:at] + new + t[end:stop]
                    texts[i] = t[:at] + new + t[end:]
                    todo.append((i, first, last))
                    pieces.append(piece)
                for (i, first, last), piece, n in zip(todo, pieces, token_counts(encoder, pieces)):
                    put(chars[i], first, len(piece))
                    put(tokens[i], first, n)
                    for leaf in range(first + 1, last + 1):
                        put(chars[i], leaf, 0)
                        put(tokens[i], leaf, 0)
                    encoded[i] += len(piece)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(texts, pa.string()), pa.array(chars, pa.list_(pa.int32())),
                 pa.array(tokens, pa.list_(pa.int32())), pa.array(before, pa.int64()), pa.array(encoded, pa.int64())],
                ["key", "text", "chars", "tokens", "tokens_before", "encoded_chars"])

    kind = index.schema["key"].dataType.simpleString()
    return index.select("key", "text", "edits", "chars", "tokens").mapInArrow(
        run, f"key {kind}, text string, chars array<int>, tokens array<int>, tokens_before long, encoded_chars long")
