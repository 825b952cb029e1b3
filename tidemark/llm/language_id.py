"""Language identification with string kernels.

The kernel of two texts is the normalised overlap of their sets of character n-grams
(blended spectrum, presence only); n-grams are hashed to 2**18 cells, so two may share one.  Nystrom landmarks turn it into a feature map, on
which one-versus-rest kernel ridge regression is solved; batches of texts are scored by
matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ship

UNDETERMINED = "und"
SPECTRUM = (1, 2, 3)  # n-gram lengths
BUCKETS = 1 << 18  # n-grams are hashed to so many features
TRAIN_PER_LANGUAGE = 96  # the bound of the labelled sample
LANGUAGES = 64  # labels at most; more are an error, for the model would not fit a task
LANDMARKS_PER_LANGUAGE = 24
RIDGE = 0.05
SHARPNESS = 4.0  # of the softmax that maps ridge outputs to scores
BATCH = 64  # texts in one matrix product

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point -> itself in lower case if it is a letter, else 0."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low[0])
        _letters.append(table)
    return _letters[0]


def ngrams(text: str) -> tuple[np.ndarray, bool]:
    """The hashed n-grams of a text as a presence bitmap, and whether it has a letter.

    Runs of non-letters count as one space.
    """
    present = np.zeros(BUCKETS, bool)
    codes = _letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter = codes != 0
    if not letter.any():
        return present, False
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first non-letter after a letter stands for its run
    codes = np.concatenate([[0], codes[keep], [0]]).astype(np.uint64) + np.uint64(1)
    whole = codes
    for n in range(1, max(SPECTRUM) + 1):
        if n > 1:
            whole = whole[:-1] * np.uint64(1 << 21) + codes[n - 1 :]  # exact for up to three code points
        if n in SPECTRUM:
            present[(whole * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)] = True
    return present, True


def packed(present: np.ndarray) -> bytes:
    """The set cells of a bitmap: their numbers, or the bitmap where that is shorter.  No text takes more than BUCKETS bits."""
    cells = np.flatnonzero(present).astype(np.int32)
    return cells.tobytes() if 4 * len(cells) < BUCKETS // 8 else np.packbits(present).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8))) if len(data) == BUCKETS // 8 else np.frombuffer(data, np.int32).astype(np.int64)


class KernelModel:
    """Landmark columns, map and ridge weights; small arrays whose size the sample bounds."""

    def __init__(self, labels: list[str], sample: list[np.ndarray], sample_labels: list[str]):
        self.labels = labels
        place = {x: i for i, x in enumerate(labels)}
        taken = {x: 0 for x in labels}
        marks = []
        for i, x in enumerate(sample_labels):
            if taken[x] < LANDMARKS_PER_LANGUAGE:
                taken[x] += 1
                marks.append(i)
        active = np.unique(np.concatenate([sample[i] for i in marks]))
        self.column = np.full(BUCKETS, -1, np.int32)
        self.column[active] = np.arange(len(active), dtype=np.int32)
        self.landmarks = np.zeros((len(active), len(marks)), np.float32)
        for j, i in enumerate(marks):
            self.landmarks[self.column[sample[i]], j] = 1 / np.sqrt(len(sample[i]))
        kernel = np.concatenate([self._rows(sample[i : i + BATCH]) @ self.landmarks for i in range(0, len(sample), BATCH)]).astype(np.float64)
        values, vectors = np.linalg.eigh(kernel[marks])
        good = values > 1e-6 * values[-1]
        root = vectors[:, good] / np.sqrt(values[good])
        phi = np.hstack([kernel @ root, np.ones((len(sample), 1))])
        target = np.full((len(sample), len(labels)), -1.0)
        target[np.arange(len(sample)), [place[x] for x in sample_labels]] = 1.0
        weight = np.array([1.0 / sample_labels.count(x) for x in sample_labels])[:, None]
        penalty = np.eye(phi.shape[1]) * RIDGE / len(labels)
        penalty[-1, -1] = 1e-9
        solved = np.linalg.solve(phi.T @ (weight * phi) + penalty, phi.T @ (weight * target))
        self.weights, self.bias = root @ solved[:-1], solved[-1]

    def _rows(self, sample: list[np.ndarray]) -> np.ndarray:
        """The n-grams of each text as a row over the landmarks' columns, scaled to length 1 over all its n-grams."""
        x = np.zeros((len(sample), len(self.landmarks)), np.float32)
        for row, ids in zip(x, sample):
            at = self.column[ids]
            row[at[at >= 0]] = 1 / np.sqrt(len(ids))
        return x

    def scores(self, batch: list[np.ndarray]) -> np.ndarray:
        """Softmax scores, one row for each bitmap."""
        x = self._rows([np.flatnonzero(present) for present in batch])
        out = SHARPNESS * ((x @ self.landmarks) @ self.weights + self.bias)
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def train(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> KernelModel | None:
    """A model from at most TRAIN_PER_LANGUAGE rows of each label, chosen by a hash of the id; None without any."""
    ship(docs.sparkSession)
    labelled = docs.where(train_on & F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in labelled.groupBy(label_col).count().limit(LANGUAGES + 1).collect()}
    if not counts:
        return None
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} values of {label_col}")
    draw = F.xxhash64(F.col(id_col).cast("string"))
    share = reduce(
        lambda col, kv: col.when(F.col(label_col) == kv[0], F.lit(min(1.0, 2.5 * TRAIN_PER_LANGUAGE / kv[1]))),
        counts.items(), F.when(F.lit(False), F.lit(0.0)))
    few = labelled.where(F.pmod(draw, F.lit(1_000_003)) < share * 1_000_003)
    order = W.partitionBy(label_col).orderBy(draw, id_col)
    few = few.select(id_col, label_col, text_col).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= TRAIN_PER_LANGUAGE)

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([packed(ngrams(t)[0]) for t in texts])

    rows = few.select(label_col, "_n", features(text_col)).collect()
    rows = sorted((r[0], r[1], unpacked(r[2])) for r in rows if r[2])
    return KernelModel(sorted({r[0] for r in rows}), [r[2] for r in rows], [r[0] for r in rows]) if rows else None


def predict(docs: DataFrame, model: KernelModel | None, text_col: str = "text") -> DataFrame:
    """_doc (the row as a struct) and _lang (struct of lang_pred and score), from the text alone."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for texts in parts:
            names, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            waiting: list[tuple[int, np.ndarray]] = []

            def flush() -> None:
                if waiting:
                    out = fitted.scores([p for _, p in waiting])
                    for (i, _), row in zip(waiting, out):
                        names[i], best[i] = fitted.labels[int(row.argmax())], row.max()
                    waiting.clear()

            for i, text in enumerate(texts):
                if text and fitted is not None:
                    present, letters = ngrams(text)
                    if letters:
                        waiting.append((i, present))
                        if len(waiting) == BATCH:
                            flush()
            flush()
            yield pd.DataFrame({"lang_pred": names, "score": best})

    return docs.select(F.struct("*").alias("_doc"), scored(F.col(text_col)).alias("_lang"))


def identify(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """One row per input row: id, lang_pred, score in 0..1.

    Trained on the rows where ``train_on`` holds and the label is known.  A null text or
    one without a letter, and every text if nothing can be learned from, is ``und`` with
    score 0.  Further columns are not read.  Two scans and no shuffle but for the sample.
    """
    own = docs.select(F.col(id_col), F.col(text_col), F.col(label_col))
    model = train(own, train_on, id_col, text_col, label_col)
    return predict(own.select(id_col, text_col), model, text_col).select(F.col(f"_doc.`{id_col}`").alias(id_col), "_lang.lang_pred", "_lang.score")


def keep_identified(docs: DataFrame, train_on: Column, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """``docs`` without those that are undetermined or score under ``least``; the label becomes the language found.

    All columns stay, whatever their names.  With nothing to learn from, no row can be
    identified and none is left.
    """
    model = train(docs, train_on, id_col, text_col, label_col)
    found = predict(docs, model, text_col)
    found = found.where((F.col("_lang.lang_pred") != UNDETERMINED) & (F.col("_lang.score") >= least))
    return found.select(*[(F.col("_lang.lang_pred") if c == label_col else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
