"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where no vocabulary piece can reach across, each fragment is merged
by repeatedly popping the best adjacent pair from a heap over a doubly linked list,
and the count is the number of initial symbols less one for every merge.  No
identifiers are produced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, ship, text_or_empty

MARK = "▁"  # stands for a space inside pieces
MEMO_FRAGMENTS = 1_200_000  # remembered fragments a worker; about 150 MB
MEMO_LENGTH = 40  # longer fragments are counted anew each time


class PieceMerger:
    """Counts the pieces of a sentence-piece BPE vocabulary (identity normaliser, dummy prefix, byte fallback).

    ``costs`` has a space where pieces have the mark; lower costs merge first.
    """

    def __init__(self, costs: dict[str, float]):
        dense = {c: r for r, c in enumerate(sorted(set(costs.values())))}
        self.ranks = {p: dense[c] for p, c in costs.items()}  # equal costs stay equal: the leftmost pair goes first
        self.single = {p for p in costs if len(p) == 1}
        # The finest of these cuts that no piece reaches across.
        fine = re.compile(r" *[^\W\d_]+| *(?:(?! )[\W\d_])+| +")
        words = re.compile(r" +[^ ]*|[^ ]+")
        whole = re.compile(r"(?s:.+)")
        self.cut = next(c for c in (fine, words, whole) if all(c.fullmatch(p) for p in costs))
        self.memo = Memo(self.merged, MEMO_FRAGMENTS)

    def count(self, text: str) -> int:
        if not text:
            return 0
        fragments = self.cut.findall(" " + text.replace(MARK, " "))
        if max(map(len, fragments)) <= MEMO_LENGTH:
            return sum(map(self.memo.__getitem__, fragments))
        return sum(self.memo[f] if len(f) <= MEMO_LENGTH else self.merged(f) for f in fragments)

    def merged(self, text: str) -> int:
        """Initial symbols less merges: best-ranked pair first, the leftmost among equals."""
        rank = self.ranks.get
        symbols: list[str] = [*text, ""]  # the empty one ends the list: nothing merges with it
        n = len(text)
        heap = [r << 32 | i for i, pair in enumerate(map(add, text, text[1:])) if (r := rank(pair)) is not None]
        if self.single.issuperset(text):
            weight, total = None, n
        else:  # a character outside the vocabulary counts its bytes
            weight = [1 if c in self.single else len(c.encode("utf-8", "surrogatepass")) for c in text]
            total = sum(weight)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            if not (left := symbols[i]):
                continue
            j = after[i]
            if j >= n or rank(whole := left + symbols[j]) != top >> 32:
                continue  # one of the two was merged meanwhile
            if weight is None:
                total -= 1
            else:
                total -= weight[i] + weight[j] - 1
                weight[i] = 1
            symbols[i], symbols[j] = whole, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(whole + symbols[k])) is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + whole)) is not None:
                heappush(heap, r << 32 | h)
        return total


def piece_costs(model_path: str) -> dict[str, float]:
    """Piece (a space for the mark) -> cost (the negated score) of the mergeable pieces; read on the driver, the vocabulary's size bounds it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return {sp.id_to_piece(i).replace(MARK, " "): -sp.get_score(i) for i in plain}


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts count 0 tokens and 0 bytes; a null id stays null; repeated
    rows are counted each; other columns of ``docs`` are not read, whatever their
    names.  A scan without shuffle: work and memory follow one batch of texts, and a
    single text takes O(n log n) even where it has no space at all.
    """
    ship(docs.sparkSession)
    costs = docs.sparkSession.sparkContext.broadcast(piece_costs(model_path))

    @F.pandas_udf("long")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merger = _merger(costs)
        for texts in parts:
            yield pd.Series([merger.count(t) for t in texts], dtype="int64")

    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col),
        F.octet_length(text).cast("long").alias("n_bytes"),
        counted(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


_mergers: dict = {}


def _merger(costs) -> PieceMerger:
    """One merger a Python worker, kept between tasks with its memo."""
    key = id(costs.value)  # the worker keeps a broadcast value while it lives
    if key not in _mergers:
        _mergers.clear()
        _mergers[key] = PieceMerger(costs.value)
    return _mergers[key]
