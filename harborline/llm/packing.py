"""Pack documents into windows by non-negative least squares over length combinations.

1. A document of n ids is n div W full windows, each a sequence of its own, and a
   rest of n mod W ids.
2. The histogram of rests (at most W - 1 rows, on the driver) is matched by
   combinations of lengths that fill a window exactly: all pairs, and
   combinations of three to ``depth`` lengths enumerated over the histogram's
   quantiles.  Non-negative least squares gives the repeat count of each; counts are
   rounded and lowered to what the histogram has left.
3. Rests of one length are interchangeable, so rest number k of a length finds
   its sequence and offset in a table of intervals (bounded by combinations x
   depth, whatever the data).
4. Residual rests are packed greedily in one line, longest first, cut at window ends.  The
   last, partial window is cut into powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import UID, running_sums, stored
from harborline.llm.tokens import encode_documents
from harborline.session import materialize


def combinations(histogram: np.ndarray, window: int, depth: int, many: int) -> np.ndarray:
    """Rows of up to ``depth`` lengths (0: none) that sum to ``window`` and occur in the histogram."""
    have = np.flatnonzero(histogram)
    found = [[a, window - a] for a in have if a <= window - a and histogram[window - a]]
    if len(have):
        mass = np.cumsum(histogram[have]) / histogram[have].sum()
        for size in range(3, depth + 1):
            # A Weyl sequence walks the quantiles of the first size - 1 lengths; the last one completes the window.
            steps = np.sqrt(np.array([2, 3, 5, 7, 11, 13, 17, 19, 23, 29][:size - 1], dtype=float))
            grid = (np.arange(1, many * 4 + 1)[:, None] * steps) % 1.0
            lengths = have[np.minimum(np.searchsorted(mass, grid), len(have) - 1)]
            last = window - lengths.sum(axis=1)
            ok = (last > 0) & (last < window)
            ok[ok] &= histogram[last[ok]] > 0
            rows = np.unique(np.sort(np.column_stack([lengths[ok], last[ok]]), axis=1), axis=0)
            pick = np.unique(np.linspace(0, len(rows) - 1, min(many, len(rows))).astype(int)) if len(rows) else []
            found += rows[pick].tolist()
    out = np.zeros((len(found), depth), dtype=np.int64)
    for i, row in enumerate(found):
        out[i, :len(row)] = row
    return out


def nnls_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - h|, by multiplicative updates; A counts lengths per combination."""
    used = combos > 0
    gather = lambda v: np.where(used, v[combos], 0.0).sum(axis=1)
    h = histogram.astype(float)
    h[0] = 0.0
    x = np.full(len(combos), max(1.0, h.sum() / max(1, used.sum())))
    pull = gather(h)
    for _ in range(rounds):
        ax = np.bincount(combos[used], weights=np.repeat(x, used.sum(axis=1)), minlength=len(h))
        x *= pull / np.maximum(gather(ax), 1e-12)
    return x


def plan(histogram: np.ndarray, window: int, depth: int = 6, many: int = 2048) -> tuple[pd.DataFrame, int]:
    """Intervals (length, first, n, sequence, offset) of rest numbers, and the number of sequences they fill."""
    combos = combinations(histogram, window, depth, many)
    left = histogram.copy()
    rows, sequences = [], 0
    if len(combos):
        wanted = np.rint(nnls_counts(combos, histogram)).astype(np.int64)
        for c in np.argsort(-wanted, kind="stable"):
            lengths, times = np.unique(combos[c][combos[c] > 0], return_counts=True)
            n = int(min(wanted[c], (left[lengths] // times).min()))
            if n <= 0:
                continue
            offset = 0
            for length in combos[c][combos[c] > 0]:
                rows.append((int(length), int(histogram[length] - left[length]), n, sequences, offset))
                left[length] -= n
                offset += int(length)
            sequences += n
    frame = pd.DataFrame(rows, columns=["length", "first", "n", "sequence", "offset"], dtype="int64")
    return frame.sort_values(["length", "first"], ignore_index=True), sequences


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "word_bpe_49k.json",
         keep_space: bool = False, end_id: int = 1, window: int = 2048, depth: int = 6) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset.

    NULL and empty texts are the end id alone; repeated keys are separate
    documents; an empty table gives no pieces.  Other columns are ignored.
    """
    encoded = stored(encode_documents(docs, key, text, vocabulary, keep_space, end_id), "ids")
    sizes = encoded.selectExpr(UID, f"n div {window} AS windows", f"n % {window} AS rest", "1L AS one")
    histogram = np.zeros(window, dtype=np.int64)
    for row in sizes.groupBy("rest").count().collect():   # at most one row per length below the window
        histogram[row["rest"]] = row["count"]
    histogram[0] = 0
    intervals, filled = plan(histogram, window, depth)
    at = intervals["length"].to_numpy() * (1 << 40) + intervals["first"].to_numpy()
    n_of, sequence_of, offset_of = (intervals[c].to_numpy() for c in ("n", "sequence", "offset"))

    def place(batches):
        for batch in batches:
            rank = batch["rank"].to_numpy()
            spot = batch["rest"].to_numpy() * (1 << 40) + rank
            i = np.searchsorted(at, spot, side="right") - 1
            ok = i >= 0
            ok[ok] &= (spot - at[i])[ok] < n_of[i[ok]]
            batch["sequence"] = pd.array(np.where(ok, sequence_of[i] + spot - at[i], 0) if len(at) else np.zeros(len(batch)), dtype="Int64")
            batch["offset"] = pd.array(np.where(ok, offset_of[i], 0) if len(at) else np.zeros(len(batch)), dtype="Int64")
            batch.loc[~ok, ["sequence", "offset"]] = pd.NA
            yield batch[[UID, "rest", "sequence", "offset"]]

    rests = running_sums(sizes.where("rest > 0").select(UID, "rest", "one"), [UID], {"rank": "one"}, "rest")
    placed = materialize(rests.mapInPandas(place, f"{UID} long, rest long, sequence long, offset long"), "placed")
    residual = running_sums(
        placed.where("sequence IS NULL").selectExpr(UID, "rest", "-rest AS longest_first"), ["longest_first", UID], {"line": "rest"}
    ).select(UID, "line")
    wide = running_sums(sizes.where("windows > 0").select(UID, "windows"), [UID], {"before": "windows"}).select(UID, "before")
    whole = sizes.agg(F.sum("windows")).first()[0] or 0
    line = placed.where("sequence IS NULL").agg(F.sum("rest")).first()[0] or 0
    tail_at = line - line % window
    tail = [1 << b for b in range(window.bit_length(), -1, -1) if (line % window) >> b & 1]
    tail_cuts = tail_at + np.concatenate([[0], np.cumsum(tail)]).astype(np.int64)
    first_line = filled + whole

    spots = placed.select(UID, "sequence", "offset").join(residual, UID, "left")
    rows = encoded.join(spots, UID, "left").join(wide, UID, "left")

    def cut(batches):
        for batch in batches:
            keys, out = [], {c: [] for c in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")}

            def piece(row, start, length, ids, n, sequence, offset):
                keys.append(row)
                for c, v in zip(out, (start, length, ids[start:start + length].astype("<u4").tobytes(), n, sequence, offset)):
                    out[c].append(v)

            columns = [batch.column(c).to_pylist() for c in ("ids", "n", "sequence", "offset", "line", "before")]
            for row, (ids, n, sequence, offset, place_, before) in enumerate(zip(*columns)):
                ids = np.frombuffer(ids, "<u2")
                for w in range(n // window):
                    piece(row, w * window, window, ids, n, filled + before + w, 0)
                start = n // window * window
                if start == n:
                    continue
                if sequence is not None:
                    piece(row, start, n - start, ids, n, sequence, offset)
                    continue
                while start < n:
                    if place_ < tail_at:
                        number, begin = place_ // window, place_ // window * window
                        end = begin + window
                    else:
                        t = int(np.searchsorted(tail_cuts, place_, side="right")) - 1
                        number, begin, end = tail_at // window + t, int(tail_cuts[t]), int(tail_cuts[t + 1])
                    length = min(n - start, end - place_)
                    piece(row, start, length, ids, n, first_line + number, place_ - begin)
                    start, place_ = start + length, place_ + length
            taken = batch.column("key").take(pa.array(keys, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken, *(pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items())], ["key", *out])

    kind = docs.schema[key].dataType.simpleString()
    return rows.select("key", "ids", "n", "sequence", "offset", "line", "before").mapInArrow(
        cut, f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
