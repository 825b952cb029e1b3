"""Vectors as short codes: a codebook for each of several parts, learned and searched in whole numbers.

Codes are found by partial-distance search: the dimensions of a part come in descending
order of their variance in the codebook, and an entry is dropped as soon as its
accumulated distance strictly exceeds the best complete distance known.  Everything is an
integer, so a code doesn't depend on how the rows are dealt out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
ROWS_AT_ONCE = 4096  # vectors searched together in a task
SAFE = 1 << 22  # integers below it are summed over 2**41 vectors, and squared over 2**17 dimensions, within 63 bits

Books = list[np.ndarray]  # for each part, entries x width


def integers(vectors: list[np.ndarray], width: int, wide: bool) -> np.ndarray:
    """floor(SCALE * x), shorter vectors filled up with zeros; Python's integers if ``wide``."""
    out = np.zeros((len(vectors), width), object if wide else np.int64)
    for at, v in zip(out, vectors):
        if wide:
            at[: len(v)] = [math.floor(x * SCALE) if abs(x) < 2.0**900 else int(x) * SCALE for x in map(float, v)]
        else:
            at[: len(v)] = np.floor(np.asarray(v, np.float64) * SCALE)
    return out


def dimension_order(book: np.ndarray) -> np.ndarray:
    """The dimensions of a part by descending variance of its codebook, the first of equals first."""
    spread = [len(book) * sum(x * x for x in c) - sum(c) ** 2 for c in book.T.tolist()]
    return np.array(sorted(range(len(spread)), key=lambda d: -spread[d]), int)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each row; the lower index of equals.

    The entry nearest in the first dimension alone is measured in full and is the best
    complete distance to beat; all others stay only while they have not exceeded it.
    """
    n, k = len(x), len(book)
    order = dimension_order(book)
    if not len(order):
        return np.zeros(n, int), np.zeros(n, x.dtype)
    first = np.abs(x[:, order[0], None] - book[None, :, order[0]]).argmin(axis=1)
    best = ((x - book[first]) ** 2).sum(axis=1)
    row, entry = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    far = np.zeros(n * k, x.dtype)
    for d in order:
        far = far + (x[row, d] - book[entry, d]) ** 2
        alive = far <= best[row]  # the entry measured in full always is
        row, entry, far = row[alive], entry[alive], far[alive]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if n else np.zeros(0, int)
    least = np.minimum.reduceat(far, starts) if n else far
    hit = np.flatnonzero(far == least[row])
    return entry[hit[np.unique(row[hit], return_index=True)[1]]], least


def updated(books: Books, sums: dict[tuple[int, int], tuple[list[int], int]]) -> Books:
    """Each entry replaced by floor(sum / count) of the parts assigned to it; unused ones stay."""
    out = [book.copy() for book in books]
    for (part, entry), (total, count) in sums.items():
        out[part][entry] = [t // count for t in total]
    return out


def digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book.tolist() for x in entry).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch], width: int, wide: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches with their vectors (the column _v) as integers."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            piece = batch.slice(at, ROWS_AT_ONCE)
            lists = piece.column(piece.schema.get_field_index("_v"))
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            ends = ends - ends[0]
            if not wide and (np.diff(ends) == width).all():
                yield piece, np.floor(flat.astype(np.float64).reshape(-1, width) * SCALE).astype(np.int64)
            else:
                yield piece, integers([flat[i:j] for i, j in zip(ends, ends[1:])], width, wide)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector that has only finite components: id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are left out; an empty vector
    counts as zeros.  Vectors shorter than the longest, or than the next multiple of
    ``parts``, count as followed by zeros.  Codebooks start from the smallest ids, null
    ones last and equal ones by vector; with fewer than ``entries`` vectors they are that
    short.  Repeated rows and equal vectors count each.  ``label_error`` sums over equal
    labels, null being one of them.  An error beyond a long is null.  An empty table gives
    an empty result; further columns are not read.

    A round is one pass over the vectors: a task sums up what it assigns, so parts x entries
    rows of each task are shuffled and as many come to the driver, whatever the input.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("_v")
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_v"))
    rows = rows.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    longest, largest = rows.agg(F.max(F.size("_v")), F.max(F.array_max(F.transform(v, lambda x: F.abs(x.cast("double")))))).first()
    step = -(-(longest or 0) // parts)
    width, wide = step * parts, (largest or 0.0) * SCALE >= SAFE or step * parts >= 1 << 17
    start = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).select("_v").toPandas()["_v"]
    first = integers(list(start), width, wide)
    books: Books = [first[:, p * step : (p + 1) * step] for p in range(parts)]
    number = "string" if wide else "long"

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(book.shape, book.dtype) for book in books]
        counts = np.zeros((parts, len(first)), np.int64)
        for _, x in _blocks(batches, width, wide):
            for p, book in enumerate(books):
                mine = x[:, p * step : (p + 1) * step]
                code, _ = nearest(mine, book)
                np.add.at(sums[p], code, mine)
                counts[p] += np.bincount(code, minlength=len(book))
        part, entry = np.nonzero(counts)
        value = pa.array([[str(x) if wide else int(x) for x in sums[p][e]] for p, e in zip(part, entry)], pa.list_(pa.string() if wide else pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), value, pa.array(counts[part, entry], pa.int64())], ["part", "entry", "sums", "n"])

    def wide_sums(pdf):
        return pdf.iloc[:1].assign(sums=[[str(sum(map(int, x))) for x in zip(*pdf["sums"])]], n=int(pdf["n"].sum()))

    only = rows.select("_v")
    for _ in range(rounds if len(first) else 0):
        partial = only.mapInArrow(totals, f"part int, entry int, sums array<{number}>, n long")
        if wide:
            found = partial.groupBy("part", "entry").applyInPandas(wide_sums, partial.schema)
        else:
            each = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(step)]
            found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)
            found = found.select("part", "entry", F.array(*[f"s{d}" for d in range(step)]).cast("array<long>").alias("sums"), "n")
        books = updated(books, {(r.part, r.entry): ([int(s) for s in r.sums], r.n) for r in found.collect()})

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in _blocks(batches, width, wide):
            found = [nearest(x[:, p * step : (p + 1) * step], book) for p, book in enumerate(books)]
            codes, errors = np.stack([c for c, _ in found], axis=1).astype(np.uint8), sum(e for _, e in found)
            text = codes.tobytes().hex()
            keep = piece.select(["_id", "_label"])
            yield pa.RecordBatch.from_arrays(
                [*keep.columns, pa.array([text[i * 2 * parts : (i + 1) * 2 * parts] for i in range(len(x))]), pa.array([int(e) if e < 2**63 else None for e in errors.tolist()], pa.int64())],
                [*keep.schema.names, "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = stored(rows.mapInArrow(coded, f"_id {kinds['_id']}, _label {kinds['_label']}, code string, error long"), "vector-codes")
    labels = out.groupBy(F.col("_label").alias("_of")).agg(F.when(F.count("error") == F.count("*"), F.expr("try_sum(error)")).alias("label_error"))
    # Stored, so that Spark knows their size: it sends few labels to all tasks and shuffles many by label.
    labels = stored(labels, "vector-labels")
    return out.join(labels, F.col("_label").eqNullSafe(F.col("_of")), "left").select(
        F.col("_id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
