"""Packing into optimal length buckets.

Dynamic programming over the global histogram of lengths chooses the bucket boundaries
with the least padding; inside each bucket, documents form batches of a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import running_sums
from .common import stored, words_col

BUCKETS = 16
TOKEN_BUDGET = 16384


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` of the ascending ``lengths``, the last included, that minimise the padding.

    A document is padded to the first boundary not below its length.  The padding of a
    bucket satisfies the quadrangle inequality, so the best split moves one way and each
    layer is found by divide and conquer: O(buckets * n * log n) for n distinct lengths.
    """
    n = len(lengths)
    if n == 0:
        return []
    number = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    value = np.asarray(lengths, np.float64)
    best = value * number[1:]  # one bucket for all up to here
    choice: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        nxt, cut = best.copy(), np.full(n, -1)
        stack = [(0, n - 1, 0, n - 1)]
        while stack:
            lo, hi, from_, to = stack.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            k = np.arange(from_, min(mid - 1, to) + 1)  # the last length of the buckets before
            at = from_
            if len(k):
                cost = best[k] + value[mid] * (number[mid + 1] - number[k + 1])
                at = int(k[cost.argmin()])
                if cost.min() < nxt[mid]:
                    nxt[mid], cut[mid] = cost.min(), at
            stack += [(lo, mid - 1, from_, at), (mid + 1, hi, at, to)]
        best = nxt
        choice.append(cut)
    out, at = [], n - 1
    for cut in reversed(choice):
        if cut[at] >= 0:
            out.append(at)
            at = int(cut[at])
    return [int(lengths[i]) for i in sorted({*out, at, n - 1})]


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, text_col: str = "text",
         buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per input row: id, n_tokens, bucket, padded_length, batch, slot, padding.

    ``length`` defaults to the words of ``text_col``, so ``token_budget`` counts words; pass a column of
    model tokens to pack by those.  Null counts as 0.  The boundaries are those of least
    padding over the exact histogram.  Bucket b takes
    lengths above boundary b-1 up to boundary b, and a batch of it holds
    floor(token_budget / boundary) documents, one at least; only the last batch of a
    bucket may hold fewer.  No document is cut or dropped.  Batches are numbered within
    their bucket in the order of a hash of the id, so they mix sources; rows are numbered by
    running counts over ranges, so a bucket with most rows, or an id with most, still
    spreads over tasks.  An empty table gives an empty result; repeated rows and null ids are packed each.
    """
    measured = F.size(words_col(F.coalesce(F.col(text_col), F.lit("")))) if length is None else F.coalesce(length, F.lit(0))
    rows = stored(docs.select(F.col(id_col), measured.cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("_row")), "lengths")
    # One cell for each distinct length: the histogram grows with the range of lengths, not with the documents.
    cells = rows.groupBy("n_tokens").count().toPandas().sort_values("n_tokens")
    ends = boundaries(cells["n_tokens"].to_numpy(np.int64), cells["count"].to_numpy(np.int64), buckets)
    edges = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array().cast("array<long>")
    rows = rows.withColumn("bucket", F.size(F.filter(edges, lambda e: e < F.col("n_tokens"))))
    rows = rows.withColumn("padded_length", F.element_at(edges, F.col("bucket") + 1) if ends else F.lit(0).cast("long"))
    rows = rows.withColumn("_draw", F.xxhash64(F.col(id_col).cast("string"))).withColumn("_1", F.lit(1))
    # Rows of one id, or of none, are told apart by their place in the input, so they spread over ranges too.
    rows = running_sums(rows, ["bucket"], [F.col("_draw"), F.col(id_col), F.col("_row")], {"_at": "_1"})
    at = F.col("_at")
    each = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest("padded_length", F.lit(1))))
    return rows.select(
        id_col, "n_tokens", "bucket", "padded_length",
        F.floor(at / each).cast("long").alias("batch"), (at % each).cast("int").alias("slot"),
        (F.col("padded_length") - F.col("n_tokens")).alias("padding"))
