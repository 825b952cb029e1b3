"""Removal of passages that an earlier document has.

Every window of ``width`` consecutive words has a Rabin-Karp hash.  Windows that can occur
in one document only never leave their task: each window names the smallest hash among its
shorter grams, equal windows name equal grams, and Spark counts in how many documents a
named gram occurs.  Neighbouring windows that name the same gram form a stretch; equal
stretches are settled as one, and where stretches differ around a shared gram, the single
windows are hashed to 128 bits and counted.  Repeated windows merge into maximal intervals.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, discard, mix64, ship, stored
from .word_hash import BASE_B, Rolling, hashed, words_of

WIDTH = 50
_ROWS = 1 << 16  # windows looked at in one step: memory stays flat for texts of any length


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _stretches(hashes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(gram, content, start, number of windows) of each stretch of windows naming the same gram."""
    gram = width // 2
    rolling = Rolling(hashes)
    grams = mix64(rolling.windows(gram))
    named = np.lib.stride_tricks.sliding_window_view(grams, width - gram + 1)
    place = np.concatenate([named[i : i + _ROWS].argmin(axis=1) for i in range(0, len(named), _ROWS)]) + np.arange(len(named))
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    ends = np.append(starts[1:], len(place))
    content = Rolling(hashes, BASE_B).spans(starts, ends + (width - 1)) + (ends - starts).astype(np.uint64)
    return _signed(grams[place[starts]]), _signed(mix64(content)), starts.astype(np.int32), (ends - starts).astype(np.int32)


def stretches(docs: DataFrame, width: int) -> DataFrame:
    """_id, _h, gram, content, start, n: the stretches of every keyed document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, found = [], [], []
            for i, key, text in zip(*(batch.column(c).to_pylist() for c in ("_id", "_h", "_text"))):
                words = words_of(text)
                if len(words) >= width:
                    one = _stretches(hashed(words), width)
                    found.append(one)
                    ids.append(np.full(len(one[0]), i, np.int64))
                    keys.append(np.full(len(one[0]), key, np.int64))
            if found:
                columns = [np.concatenate(c) for c in (ids, keys, *zip(*found))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_id", "_h", "gram", "content", "start", "n"])

    return docs.mapInArrow(of, "_id long, _h long, gram long, content long, start int, n int")


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """_id, _h, a, b, start: the 128-bit hash of every window of the listed stretches (column _at)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i, key, text, at in zip(*(batch.column(c).to_pylist() for c in ("_id", "_h", "_text", "_at"))):
                h = hashed(words_of(text))
                starts = np.unique(np.concatenate([np.arange(x["start"], x["start"] + x["n"]) for x in at]))
                a, b = (Rolling(h, *base).spans(starts, starts + width) for base in ((), (BASE_B,)))
                parts.append((np.full(len(starts), i, np.int64), np.full(len(starts), key, np.int64), _signed(a), _signed(b), starts.astype(np.int32)))
            if parts:
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_h", "a", "b", "start"])

    return docs.mapInArrow(of, "_id long, _h long, a long, b long, start int")


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal intervals from overlapping or touching ones."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # The hash tells rows apart that share an id but not a text.
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_text"))


def repeated_intervals(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _h, _gone: the intervals of words, [start, end) and not yet merged, that a document with a smaller id has.

    Rows whose id is null neither lose words nor take them from others.
    """
    ship(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col).where("_id IS NOT NULL")
    rows = stored(stretches(keyed, width), "stretches")
    # Equal stretches count as one class before anything meets by its gram, however many documents hold them.
    # Every grouped table is stored before it is joined, so that a hot key's rows can be split over tasks.
    classes = stored(rows.groupBy("gram", "content", "n").agg(F.min("_id").alias("first"), F.max("_id").alias("last")), "stretch-classes")
    grams = classes.groupBy("gram").agg(F.min("first").alias("lo"), F.max("last").alias("hi"), F.count("*").alias("forms")).where("lo < hi")
    grams = stored(grams.select("gram", (F.col("forms") > 1).alias("several")), "shared-grams")
    open_classes = classes.join(grams, "gram").where("several OR first < last").select("gram", "content", "n", "first", "several")
    settled = rows.join(stored(open_classes, "shared-classes"), ["gram", "content", "n"]).where("first < _id OR several")
    settled = stored(settled.select("_id", "_h", "start", "n", "first", "several"), "settled-stretches")
    discard(rows, classes)
    whole = settled.where("first < _id").select("_id", "_h", "start", (F.col("start") + F.col("n") + (width - 1)).alias("end"))
    open_ = settled.where("first = _id AND several").groupBy("_id", "_h").agg(F.collect_list(F.struct("start", "n")).alias("_at"))
    single = stored(_windows(keyed.join(open_, ["_id", "_h"]), width), "single-windows")
    firsts = single.groupBy("a", "b").agg(F.min("_id").alias("first"), F.max("_id").alias("last")).where("first < last").select("a", "b", "first")
    later = single.join(stored(firsts, "repeated-windows"), ["a", "b"]).where("first < _id").select("_id", "_h", "start", (F.col("start") + width).alias("end"))
    return whole.unionByName(later).groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "end")).alias("_gone"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, removed (maximal intervals of word places), kept (words left, joined by a space), _text.

    A word goes if some window of ``width`` words covering it also starts in a document
    with a smaller id; windows are judged on the input.  Documents under ``width`` words
    and null texts lose nothing.  Rows sharing an id never count as earlier than each
    other.  Ids are integers; further columns are not read.
    """
    keyed = _keyed(docs, id_col, text_col)
    gone = repeated_intervals(docs, width, id_col, text_col)

    @F.pandas_udf("n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, gones in parts:
            out = []
            for text, gone in zip(texts, gones):
                words = words_of(text)
                spans = merged([(x["start"], x["end"]) for x in gone]) if gone is not None else []
                left, at = [], 0
                for start, end in spans:
                    left += words[at:start]
                    at = end
                left += words[at:]
                out.append((len(words), len(words) - len(left), [{"start": s, "end": e} for s, e in spans], " ".join(left)))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "removed", "kept"])

    with_ids = keyed.where("_id IS NOT NULL").join(gone, ["_id", "_h"], "left")
    without = keyed.where("_id IS NULL").withColumn("_gone", F.lit(None).cast("array<struct<start:int,end:int>>"))
    both = with_ids.unionByName(without)
    return both.select(F.col("_id").alias(id_col), "_text", cut("_text", "_gone").alias("c")).select(id_col, "c.*", "_text")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the maximal intervals and the white space after each of them."""
    at = [m.start() for m in re.finditer(WORD, text)] + [len(text)]
    parts, done = [], 0
    for start, end in spans:
        parts.append(text[done : at[start]])
        done = at[end]
    return "".join(parts) + text[done:]


def cut_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of ``text_col`` and ``length_col``, if there, counted anew.

    All columns stay, whatever their names, and so does the white space between the words
    left.  A document of which no word is left goes; one that had none to begin with stays.
    """
    gone = repeated_intervals(docs, width, id_col, text_col)

    @F.pandas_udf("string")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, gones in parts:
            out = [t if g is None else cut_text(t, merged([(x["start"], x["end"]) for x in g])) for t, g in zip(texts, gones)]
            yield pd.Series(out, dtype="object")

    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_h"))
    rows = rows.join(gone, ["_id", "_h"], "left")  # a null id meets nothing and stays
    both = rows.select("_doc", "_gone", cut(F.col(f"_doc.`{text_col}`"), "_gone").alias("_new"))  # one join: texts travel once
    both = both.where(F.col("_gone").isNull() | (F.btrim("_new", F.lit(SPACE)) != ""))
    new = {text_col: F.col("_new")}
    if length_col in docs.columns:
        new[length_col] = F.char_length("_new").cast(docs.schema[length_col].dataType)
    return both.select(*[new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def brute_force(texts: dict[int, str | None], width: int = WIDTH) -> dict[int, tuple[int, int, str]]:
    """id -> (n_words, n_removed, SHA-256 of the kept words), by comparing windows as tuples; for tests."""
    first: dict[tuple[str, ...], int] = {}
    for i in sorted(texts):
        words = words_of(texts[i])
        for k in range(len(words) - width + 1):
            first.setdefault(tuple(words[k : k + width]), i)
    out = {}
    for i, text in texts.items():
        words = words_of(text)
        gone = {k + j for k in range(len(words) - width + 1) if first[tuple(words[k : k + width])] < i for j in range(width)}
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out
