"""Language-model scoring with Brown classes.

Exchange clustering assigns every word that occurs at least twice to a class, so that class
bigrams predict best.  The most frequent words start in turn; the others join by the same
criterion; then all of them choose again, half of the words at a time, until the
likelihood settles.  Each word chooses where its own neighbours are counted, against one small matrix of
class bigrams.  Words seen once and unseen words share an explicit unknown class.  A word is scored by the transition
from the class before it to its own and by its emission from that class, both smoothed, so
that the probabilities of all words and the unseen one add up to 1.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import running_sums
from .common import discard, ship, stored, sweep, text_or_empty

CORE = 1000  # most frequent words, with which the exchange starts: they choose in turn
ROUNDS = 40  # of the exchange at most; each moves half of the words
STARTING_ROUNDS = 2  # in which the first words choose in turn
SETTLED = 1e-3  # share of the likelihood that two rounds must gain for the exchange to go on
LEAST_COUNT = 2  # occurrences of a word with a class of its own choice
CLASSES = 128  # at most: what a choice costs grows with the classes, and so does the matrix that every task holds
SMALL = 0.05  # share of the mean mass of a class below which words that choose at once don't enter it
CARRIED = 150_000  # most frequent words that tasks know by heart; the others are joined by key
HELD_WORDS = 300_000  # other words whose keys a task remembers
GROUP = 128  # words at most whose neighbours a task hands on in one row
GROUPS = 1 << 14  # of words at least, so that rows stay short where the vocabulary is small
HELD_COUNTS = 1_000_000  # distinct words or pairs a task holds before it hands partial counts on
SMOOTH = 0.5  # added to counts
BACKOFF = 20.0  # weight of the class's own probability in a transition

_WAITING = -2  # number of a word that is still to be joined


def classes_for(distinct: int) -> int:
    """The number of classes follows the square root of the vocabulary up to CLASSES: 75 for 90,000 words, 128 from 262,000."""
    return max(8, min(CLASSES, round(distinct**0.5 / 4)))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, with A-Z in lower case; splitting bytes knows the six white-space characters and no others."""
    return text.lower().split()


def word_key(word: bytes) -> int:
    """What Spark's xxhash64 gives for the word."""
    key = xxhash.xxh64_intdigest(word, 42)
    return key - (1 << 64) if key >> 63 else key


def word_counts(texts: DataFrame) -> DataFrame:
    """word, key, c of column _text; the end of a text is the empty word."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column("_text").to_pylist():
                counts.update(words_of(text))
                counts[b""] += 1
                if len(counts) > HELD_COUNTS:
                    yield out()
        if counts:
            yield out()

    summed = texts.mapInArrow(of, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    return summed.select("word", F.xxhash64("word").alias("key"), "c")


def most_frequent(vocabulary: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words with their counts, by falling count: all above a count that a small histogram tells."""
    words = vocabulary.where(F.octet_length("word") > 0)
    step = F.floor(F.log2("c") * 64).cast("int")
    room, least = most, None
    for s, n in sorted(words.groupBy(step.alias("s")).count().collect(), reverse=True):
        if n > room:
            break
        room, least = room - n, s
    if least is None:
        return []
    return sorted(((bytes(r[0]), r[1]) for r in words.where(step >= least).select("word", "c").collect()), key=lambda x: (-x[1], word_key(x[0])))


class Numbers(dict):
    """Numbers of the carried words; any other word gets -1, -2 and so on, and its key is added to ``keys``."""

    def __init__(self, places: dict[bytes, int]):
        super().__init__(places)
        self.keys = array("q")

    def __missing__(self, word: bytes) -> int:
        self.keys.append(word_key(word))
        number = self[word] = -len(self.keys)
        return number


def tokenized(rows: DataFrame, carried, end: int) -> DataFrame:
    """_row, _id, _train, ids (of the carried words as 32-bit integers, _WAITING for others), numerators, known, rest (keys of the others, in order).

    ``carried`` has the numbers of the carried words and, by number, their log10 numerators.  numerators sums those of a text's carried
    words and of its end, which occurred ``end`` times; known counts the ones that occurred.
    """
    last = float(np.log10(end + SMOOTH))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, logs = carried.value
        numbers = Numbers(places)
        for batch in batches:
            ids, numerators, known, rest, ends = [], [], [], [np.zeros(0, np.int64)], [0]
            for text in batch.column("_text").to_pylist():
                if len(numbers.keys) > HELD_WORDS:
                    numbers = Numbers(places)
                words = words_of(text)
                one = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                other = one < 0
                late = one[other]
                ours = one[~other]
                if len(late):
                    rest.append(np.frombuffer(numbers.keys, np.int64)[-1 - late])
                    one[other] = _WAITING
                ends.append(ends[-1] + len(late))
                ids.append(one.tobytes())
                numerators.append(float(logs[ours].sum()) + last)
                known.append(len(ours) + (end > 0))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rest)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_row", "_id", "_train")), pa.array(ids, pa.binary()), pa.array(numerators, pa.float64()), pa.array(known, pa.int64()), lists],
                ["_row", "_id", "_train", "ids", "numerators", "known", "rest"])

    kinds = f"_row long, _id {rows.schema['_id'].dataType.simpleString()}, _train boolean, ids binary, numerators double, known long, rest array<long>"
    return rows.mapInArrow(of, kinds)


def _held(column: pa.Array, of=np.int32) -> tuple[np.ndarray, np.ndarray]:
    """(numbers that the values of a binary column hold, one value after the other; how many each holds), read in place."""
    _, ends, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, of), np.zeros(len(column), np.int64)
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(ends, wide)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(of), np.diff(ends) // np.dtype(of).itemsize


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(neighbours, their counts, pairs in each value) of a column ``after`` or ``before`` of ``contexts``."""
    held, sizes = _held(column)
    return held[::2], held[1::2], sizes // 2


def runs(batch: pa.RecordBatch, unknown: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, places of the ends) of the texts of a batch: an end, then each text's words and an end.

    A word is its number, ``unknown`` without one, an end the number after that.
    """
    ids, sizes = _held(batch.column("ids"))
    tokens = np.full(len(ids) + len(sizes) + 1, unknown + 1, np.int64)
    tokens[np.arange(len(ids)) + 1 + np.repeat(np.arange(len(sizes)), sizes)] = np.where(ids < 0, unknown, ids)
    return tokens, np.concatenate([[0], np.cumsum(sizes + 1)])


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """The class part of the training log-likelihood."""
    return float(_phi(matrix).sum() - _phi(matrix.sum(1)).sum() - _phi(matrix.sum(0)).sum())


def best_class(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray) -> int:
    """Where a word, now in class ``own``, adds most to the likelihood, given how often each kind follows and precedes it.

    The last two kinds, other words and the end, are no classes to move to.
    """
    k = len(matrix) - 2
    m = matrix.copy()
    m[own] -= after
    m[:, own] -= before
    np.maximum(m, 0, out=m)  # pairs of the word with its own class are counted on both sides
    rows, columns, n = m[:k], m[:, :k].T, after.sum()
    gain = (_phi(rows + after) - _phi(rows)).sum(1) + (_phi(columns + before) - _phi(columns)).sum(1)
    one, two = rows.sum(1), columns.sum(1)
    gain -= _phi(one + n) - _phi(one) + _phi(two + n) - _phi(two)
    best = int(gain.argmax())
    # A tie is no reason to move: words that tie would all leave for the same class at once.
    return best if gain[best] > gain[own] + 1e-6 * (n + abs(gain[own])) else own


def exchange(pairs: DataFrame, core: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(kind of every token of ``core_pairs``, counts of kind pairs) after STARTING_ROUNDS.

    In a round, Spark sums for half of the words how often each kind follows and precedes
    each; then the words choose in turn, the most frequent first, and every move changes
    the counts that the next word looks at.  What the driver holds of this, a vector of
    kinds for each core word, is bounded by CORE and the number of classes, whatever the
    size of the corpus.
    """
    spark, kinds = pairs.sparkSession, classes + 2
    kind = np.concatenate([np.arange(core) % classes, [classes, classes + 1]])
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for turn in range(STARTING_ROUNDS + 1):
        table = spark.createDataFrame(pd.DataFrame({"w": np.arange(len(kind), dtype=np.int32), "k": kind.astype(np.int32)}))
        one, two = (F.broadcast(table.select(F.col("w").alias(f"w{i}"), F.col("k").alias(f"k{i}"))) for i in (1, 2))
        placed = pairs.join(one, "w1").join(two, "w2")
        matrix = np.zeros((kinds, kinds))
        for a, b, n in placed.groupBy("k1", "k2").agg(F.sum("n")).collect():
            matrix[a, b] = n
        value = likelihood(matrix)
        if best is None or value > best[0]:
            best = value, kind.copy(), matrix
        if turn == STARTING_ROUNDS or not core:
            break
        moving = lambda w: (F.col(w) < core) & (F.col(w) % 2 == turn % 2)
        sides = placed.where(moving("w1")).select(F.col("w1").alias("w"), F.col("k2").alias("k"), "n").unionByName(
            placed.where(moving("w2")).select(F.col("w2").alias("w"), (F.col("k1") + kinds).alias("k"), "n"))
        found = sides.groupBy("w", "k").agg(F.sum("n").alias("n")).toArrow()
        words, at = np.unique(found["w"].to_numpy(), return_inverse=True)
        vectors = np.zeros((len(words), 2 * kinds))
        vectors[at, found["k"].to_numpy()] = found["n"].to_numpy()
        counts = matrix.copy()
        for w, vector in zip(words, vectors):
            own, after, before = kind[w], vector[:kinds], vector[kinds:]
            to = best_class(counts, own, after, before)
            if to != own:
                for k, sign in ((own, -1), (to, 1)):
                    counts[k] += sign * after
                    counts[:, k] += sign * before
                np.maximum(counts, 0, out=counts)
                kind[w] = to
    return best[1], best[2]


_SIDE = 1 << 34  # codes of neighbours lie below: 2 * number for one that follows, 1 more for one that precedes


def _spread(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """A binary column whose values end at these places of ``values``, the first of them starting at ``ends[0]``."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _grouped(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """g, place, seen, n: the sorted codes (g * GROUP + place) * _SIDE + seen and their counts, packed for each group of words."""
    word = codes // _SIDE
    group = word // GROUP
    first = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(first, len(codes))
    sides = ((word - group * GROUP).astype(np.uint8), (codes & (_SIDE - 1)).astype(np.int32), n.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(group[first].astype(np.int32)), *[_spread(ends, x) for x in sides]], ["g", "place", "seen", "n"])


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    sums = np.append(0, np.cumsum(n[order], dtype=np.int64))
    return codes[first], np.diff(sums[np.append(first, len(codes))])


def _rows(codes: np.ndarray, n: np.ndarray, words: int, groups: int) -> pa.RecordBatch:
    """The sorted codes of whole words and their counts, a row for each word, as ``contexts`` gives them."""
    word, seen = codes // _SIDE, (codes & (_SIDE - 1)).astype(np.int32)
    names = word[np.flatnonzero(np.diff(word, prepend=-1))]
    before, other = (seen & 1) == 1, seen >> 1
    sides = []
    for side in (~before, before):
        pairs = np.stack([seen[side], n[side].astype(np.int32)], axis=1)
        ends = np.searchsorted(word[side], np.append(names, names[-1:] + 1))
        sides.append(_spread(2 * ends, pairs))
    outer = []
    for x in (before & (other == words), before & (other > words)):
        sums = np.zeros(len(names), np.int64)
        sums[np.searchsorted(names, word[x])] = n[x]  # a word has one such neighbour at most
        outer.append(pa.array(sums))
    return pa.RecordBatch.from_arrays([pa.array((names % GROUP * groups + names // GROUP).astype(np.int32)), *sides, *outer], ["w", "after", "before", "unknown", "end"])


def contexts(texts: DataFrame, words: int) -> DataFrame:
    """w, after, before, unknown, end: for each of the ``words`` numbered words, how often every token follows and precedes it.

    The last two are how often a word without a number and an end precede it.

    Tasks count pairs before anything is shuffled, so of a frequent word, each sends its
    distinct neighbours only, and words travel in groups, dealt out by their numbers, so that the
    frequent ones are in different groups.  The counts of a group meet sorted, as a stream, and add up to one row a word.
    """
    groups = max(1, min(words, GROUPS), -(-words // GROUP))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            token, _ = runs(batch, words)
            at = token // groups
            dealt = (token - at * groups) * GROUP + at
            for this, other, side in ((slice(None, -1), slice(1, None), 0), (slice(1, None), slice(None, -1), 1)):
                own = token[this] < words
                parts.append(dealt[this][own] * _SIDE + 2 * token[other][own] + side)
            held += 2 * len(token)
            if held > 6 * HELD_COUNTS:
                yield _grouped(*np.unique(np.concatenate(parts), return_counts=True))
                parts, held = [], 0
        if held:
            yield _grouped(*np.unique(np.concatenate(parts), return_counts=True))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of the last group, which may go on
        for batch in batches:
            (seen, sizes), (place, _), (more, _) = _held(batch.column("seen")), _held(batch.column("place"), np.uint8), _held(batch.column("n"))
            new = (np.repeat(batch.column("g").to_numpy().astype(np.int64) * GROUP, sizes) + place) * _SIDE + seen
            codes, n = _summed(np.concatenate([codes, new]), np.concatenate([n, more]))
            done = int(np.searchsorted(codes, codes[-1] // (GROUP * _SIDE) * (GROUP * _SIDE))) if len(codes) else 0
            if done:
                yield _rows(codes[:done], n[:done], words, groups)
            codes, n = codes[done:], n[done:]
        if len(codes):
            yield _rows(codes, n, words, groups)

    counted = texts.select("ids").mapInArrow(count, "g int, place binary, seen binary, n binary").repartition("g").sortWithinPartitions("g")
    return counted.mapInArrow(merge, "w int, after binary, before binary, unknown long, end long")


def core_pairs(table: DataFrame, words: int, core: int) -> DataFrame:
    """w1, w2, n: how often two tokens follow each other, one of them a core word at least; from ``contexts`` of the numbered ``words``.

    Tokens are numbers of core words, ``core`` for all other words and core + 1 for the end.
    """
    width = core + 2

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column("w").to_numpy().astype(np.int64)
            codes, counts = [], []
            for name in ("after", "before"):
                seen, n, sizes = _pairs(batch.column(name))
                token, this = np.where(seen >> 1 > words, core + 1, np.minimum(seen >> 1, core)).astype(np.int64), np.repeat(word, sizes)
                if name == "before":
                    outer = token >= core  # a core word has the pair in its own row
                    token, this, n = token[outer], this[outer], n[outer]
                codes.append(this * width + token if name == "after" else token * width + this)
                counts.append(n)
            code, n = _summed(np.concatenate(codes), np.concatenate(counts))
            yield pa.RecordBatch.from_arrays([pa.array((code // width).astype(np.int32)), pa.array((code % width).astype(np.int32)), pa.array(n)], ["w1", "w2", "n"])

    return table.where(F.col("w") < core).select("w", "after", "before").mapInArrow(of, "w1 int, w2 int, n long")


def class_matrix(table: DataFrame, kinds_of, kinds: int) -> np.ndarray:
    """How often kinds follow each other, from ``contexts``, but for pairs of two tokens without a class; those never change."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, matrix = kinds_of.value, np.zeros(kinds * kinds)
        for batch in batches:
            own = kind[batch.column("w").to_numpy()].astype(np.int64)
            seen, n, sizes = _pairs(batch.column("after"))
            matrix += np.bincount(np.repeat(own * kinds, sizes) + kind[seen >> 1], n, kinds * kinds)
            for before, name in ((kinds - 2, "unknown"), (kinds - 1, "end")):
                matrix[before * kinds :][:kinds] += np.bincount(own, batch.column(name).to_numpy(), kinds)
        at = np.flatnonzero(matrix)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(matrix[at].astype(np.int64))], ["code", "n"])

    out = np.zeros(kinds * kinds)
    for code, n in table.select("w", "after", "unknown", "end").mapInArrow(of, "code long, n long").groupBy("code").agg(F.sum("n")).collect():
        out[code] = n
    return out.reshape(kinds, kinds)


class Choice:
    """Where words add most to the likelihood, against a matrix of kinds; the last two kinds are no classes."""

    LEVELS = 8  # counts whose logarithms are looked up

    def __init__(self, matrix: np.ndarray):
        self.kinds, k = len(matrix), len(matrix) - 2
        self.counts = np.concatenate([matrix[:k].T, matrix[:, :k]])
        # a row for each kind that follows a class, then for each that precedes one
        self.known = _phi(self.counts)
        self.more = np.concatenate([_phi(self.counts + n) - self.known for n in range(1, self.LEVELS + 1)])
        self.rows, self.columns = matrix[:k].sum(1), matrix[:, :k].sum(0)
        # Alone in a small class, any word gains; but words that choose at once would all go there.
        self.small = self.columns < SMALL * self.columns.mean()

    def best(self, word: np.ndarray, j: np.ndarray, n: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The class of each word, from its sorted sparse vector over ``counts``; ``own`` is the one it is in, -1 for none.

        A word is taken out of its own class before the classes are compared.
        """
        words, k = len(own), self.counts.shape[1]
        starts = np.searchsorted(word, np.arange(words))
        gain = np.empty((words, k))
        level = (np.minimum(n, self.LEVELS).astype(np.int64) - 1) * len(self.counts) + j
        step, at = max(1, (1 << 16) // k), 0
        while at < words:  # whole words, about ``step`` entries at once, whose rows stay in the cache of a core
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
            lo, hi = starts[at], starts[to] if to < words else len(word)
            one = self.more.take(level[lo:hi], axis=0)
            large = np.flatnonzero(n[lo:hi] > self.LEVELS)
            if len(large):
                jj = j[lo:hi][large]
                one[large] = _phi(self.counts[jj] + n[lo:hi][large, None]) - self.known[jj]
            np.add.reduceat(one, starts[at:to] - lo, axis=0, out=gain[at:to])
            at = to
        total = np.bincount(word, weights=n, minlength=words) / 2
        t, of = np.unique(total, return_inverse=True)  # most words are rare, so few totals differ
        t = t[:, None]
        gain -= (_phi(self.rows + t) - _phi(self.rows) + _phi(self.columns + t) - _phi(self.columns))[of]
        gain[:, self.small] = -np.inf
        placed = np.flatnonzero(own >= 0)
        mine = own[word]
        here = self.counts[j, np.maximum(mine, 0)]
        lost = np.bincount(word, weights=_phi(here) - _phi(np.maximum(here - n, 0)), minlength=words)[placed]
        for whole in (self.rows, self.columns):
            lost -= _phi(whole[own[placed]]) - _phi(np.maximum(whole[own[placed]] - total[placed], 0))
        gain[placed, own[placed]] = lost
        best = gain.argmax(1)
        # A tie is no reason to move: words that tie would all leave for the same class at once.
        ahead = gain[placed, best[placed]] - lost
        stay = placed[ahead <= 1e-6 * (total[placed] + np.abs(lost))]
        best[stay] = own[stay]
        return best


def choices(table: DataFrame, kinds_of, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, their new classes) of those words of ``contexts`` that move; a word's row is enough for its choice."""
    kinds = len(matrix)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, choice = kinds_of.value, Choice(matrix)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                rows = batch.slice(i, 1000)
                w = rows.column("w").to_numpy()
                sums = np.zeros(len(w) * 2 * kinds)
                for side, name in enumerate(("after", "before")):
                    seen, n, sizes = _pairs(rows.column(name))
                    cells = np.repeat(np.arange(len(w)) * (2 * kinds) + side * kinds, sizes) + kind[seen >> 1]
                    sums += np.bincount(cells, n, len(sums))
                at = np.flatnonzero(sums)
                own = np.where(kind[w] < kinds - 2, kind[w].astype(np.int64), -1)
                best = choice.best(*np.divmod(at, 2 * kinds), sums[at], own)
                moved = best != own
                yield pa.RecordBatch.from_arrays([pa.array(w[moved]), pa.array(best[moved].astype(np.int32))], ["w", "kind"])

    found = table.select("w", "after", "before").mapInArrow(of, "w int, kind int").toArrow()
    return found["w"].to_numpy(), found["kind"].to_numpy()


def exchange_all(table: DataFrame, kind: np.ndarray, classes: int, matrix: np.ndarray) -> np.ndarray:
    """The kind of every numbered word once the likelihood settles; the unknown kind and the end come last.

    Words that are still in the unknown kind choose first, against ``matrix``.  Then the words of even and of odd
    numbers choose by turns, all of a half against the same matrix.  The driver
    holds two bytes a word.
    """
    spark, kinds = table.sparkSession, classes + 2
    history: list[float] = []
    best: tuple[float, np.ndarray] | None = None
    for turn in range(-1, ROUNDS + 1):
        known = spark.sparkContext.broadcast(kind)
        if turn < 0:
            moving = table
        else:
            moving = table.where(F.col("w") % 2 == turn % 2)
            matrix = class_matrix(table, known, kinds)
            history.append(likelihood(matrix))
            if best is None or history[-1] > best[0]:
                best = history[-1], kind
            if turn == ROUNDS or (turn >= 2 and history[-1] - history[-3] < SETTLED * abs(history[-1])):
                break
        words, to = choices(moving, known, matrix)
        known.destroy()
        if turn < 0:
            fresh = kind[words] == classes
            words, to = words[fresh], to[fresh]
        kind = kind.copy()
        kind[words] = to
    return best[1]


@dataclass
class Tables:
    """Log10 tables of the model over kinds: classes, then the unknown class, then the end."""

    transition: np.ndarray
    emission: np.ndarray
    base: float

    @classmethod
    def of(cls, matrix: np.ndarray, types: np.ndarray, total: int, distinct: int) -> Tables:
        """``types`` counts the distinct words of each kind; the unknown class holds the unseen word besides."""
        mass, room = matrix.sum(0), types.copy()
        room[-2] += 1
        prior = np.where(room > 0, mass + SMOOTH, 0.0)  # a class without words is never entered
        transition = (matrix + BACKOFF * prior / prior.sum()) / (matrix.sum(1, keepdims=True) + BACKOFF)
        emission = np.maximum(mass + SMOOTH * room, SMOOTH)
        with np.errstate(divide="ignore"):
            return cls(np.log10(transition), np.log10(emission), float(np.log10(total + SMOOTH * (distinct + 1))))


def _numbered(tokens: DataFrame, others: DataFrame) -> DataFrame:
    """_row, _id, _train, ids (32-bit; -1 for a word without a number), numerators, n_known: tokens with the numbers and counts of all their words.

    ``others`` has key, c and id of the words that tasks don't know by heart.
    """
    late = tokens.select("_row", F.posexplode("rest").alias("pos", "key")).join(others, "key", "left").groupBy("_row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("more"), F.count("c").alias("found"),
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(-1)).alias("id")))).alias("rest"))
    late = late.select("_row", "more", "found", F.transform("rest", lambda x: x["id"]).alias("rest"))

    @F.pandas_udf("binary")
    def filled(ids: pd.Series, rest: pd.Series) -> pd.Series:
        out = []
        for packed, found in zip(ids, rest):
            if found is not None:
                at = np.frombuffer(packed, np.int32).copy()
                at[at == _WAITING] = found
                packed = at.tobytes()
            out.append(packed)
        return pd.Series(out)

    both = tokens.drop("rest").join(late, "_row", "left")
    return both.select(
        "_row", "_id", "_train", filled("ids", "rest").alias("ids"),
        (F.col("numerators") + F.coalesce("more", F.lit(0.0))).alias("numerators"), (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"))


def kind_pairs(texts: DataFrame, kinds_of, kinds: int) -> np.ndarray:
    """How often kinds follow each other in the rows of ``_numbered``; a matrix of kinds comes to the driver."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kinds_of.value
        matrix = np.zeros(kinds * kinds, np.int64)
        for batch in batches:
            kind = table[runs(batch, len(table) - 2)[0]].astype(np.int64)
            matrix += np.bincount(kind[:-1] * kinds + kind[1:], minlength=kinds * kinds)
        codes = np.flatnonzero(matrix)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(matrix[codes])], ["code", "n"])

    matrix = np.zeros(kinds * kinds)
    for code, n in texts.select("ids").mapInArrow(of, "code long, n long").groupBy("code").agg(F.sum("n")).collect():
        matrix[code] = n
    return matrix.reshape(kinds, kinds)


@dataclass
class Learned:
    classes: int  # the unknown class has this number, the end the next
    total: int  # training tokens
    vocabulary: DataFrame  # word, key, c, id (null for words without a class)
    kind: np.ndarray  # by number, then of the unknown class and of the end
    texts: DataFrame  # as of ``_numbered``
    tables: Tables


def _own(docs: DataFrame, train_on, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text_or_empty(text_col).cast("binary").alias("_text"),
        F.coalesce(train_on, F.lit(False)).alias("_train"))


def learn(own: DataFrame) -> Learned:
    """The model of the rows with _train, and all rows with the numbers of their words.

    Words that occur LEAST_COUNT times are numbered by falling count, equal ones by key.
    """
    spark = own.sparkSession
    ship(spark)
    counted = stored(word_counts(own.where("_train").select("_text")), "word-counts")
    total, distinct, named = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count(F.when((F.col("c") >= LEAST_COUNT) & (F.octet_length("word") > 0), 1))).first()
    end = counted.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    numbered = counted.where((F.col("c") >= LEAST_COUNT) & (F.octet_length("word") > 0)).select("key", "c").withColumn("_1", F.lit(1))
    numbers = running_sums(numbered, [], [F.col("c").desc(), F.col("key")], {"id": "_1"}).select("key", F.col("id").cast("int").alias("id"))
    vocabulary = stored(counted.join(numbers, "key", "left"), "vocabulary")
    discard(counted)
    sweep(spark)
    carried = [x for x in most_frequent(vocabulary, CARRIED) if x[1] >= LEAST_COUNT]  # the first numbers
    classes = classes_for(distinct)
    core = min(CORE, len(carried))
    known = spark.sparkContext.broadcast(({w: i for i, (w, _) in enumerate(carried)}, np.log10(np.array([c for _, c in carried], np.float64) + SMOOTH)))
    tokens = stored(tokenized(own, known, end), "tokens")
    others = vocabulary.where((F.col("id") >= len(carried)) | F.col("id").isNull()).select("key", "c", "id")
    texts = stored(_numbered(tokens, others), "numbered-texts")
    discard(tokens)
    sweep(spark)
    training = texts.where("_train")
    table = stored(contexts(training, named), "word-contexts")
    sweep(spark)
    pairs = stored(core_pairs(table, named, core), "core-pairs")
    started, matrix = exchange(pairs, core, classes)
    kind = np.full(named + 2, classes, np.uint16)
    kind[:core], kind[-1] = started[:core], classes + 1
    kind = exchange_all(table, kind, classes, matrix)
    discard(pairs, table)
    types = np.bincount(kind[:-2], minlength=classes + 2).astype(float)
    types[classes] += max(0, distinct - (1 if end else 0) - named)
    types[classes + 1] = 1
    tables = Tables.of(kind_pairs(training, spark.sparkContext.broadcast(kind), classes + 2), types, total, distinct)
    return Learned(classes, total, vocabulary, kind, texts, tables)


def word_classes(docs: DataFrame, train_on, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, c, kind of every training word; kind is null in the unknown class."""
    learned = learn(_own(docs, train_on, id_col, text_col))
    of = docs.sparkSession.createDataFrame(pd.DataFrame({"id": np.arange(len(learned.kind) - 2, dtype=np.int32), "kind": learned.kind[:-2].astype(np.int32)}), "id int, kind int")
    words = learned.vocabulary.where(F.octet_length("word") > 0).join(of, "id", "left")
    return words.select(F.col("word").cast("string").alias("word"), "c", "kind")


def class_scores(docs: DataFrame, train_on, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, n_known, n_classed, train_tokens, base_score, score, perplexity.

    Learned from the rows where ``train_on`` holds.  base_score sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens; score is the log10 probability
    under the class model; perplexity is 10 ** (-score / n_tokens); n_classed counts the
    words with a class of the exchange.  Null and empty texts are an end alone; with nothing to
    learn from, every count is 0.  Repeated rows count and are scored each; null ids are
    scored; further columns are not read.  Counts of all words come from all training
    rows; what tasks carry of them is bounded by CARRIED, and the rest is joined by a
    64-bit key.
    """
    spark = docs.sparkSession
    learned = learn(_own(docs, train_on, id_col, text_col))
    discard(learned.vocabulary)
    classes, model = learned.classes, spark.sparkContext.broadcast((learned.tables, learned.kind))
    kept = learned.texts.schema["_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, table = model.value
        for batch in batches:
            tokens, ends = runs(batch, len(table) - 2)
            kind = table[tokens].astype(np.int64)
            numerator = batch.column("numerators").to_numpy()
            each, n = tables.transition[kind[:-1], kind[1:]] - tables.emission[kind[1:]], np.diff(ends)
            score = numerator + (np.add.reduceat(each, ends[:-1]) if len(n) else 0.0)
            classed = np.add.reduceat((kind[1:] < classes).astype(np.int64), ends[:-1]) if len(n) else n
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n), batch.column("n_known"), pa.array(classed), pa.array(numerator - n * tables.base), pa.array(score)],
                ["_id", "n_tokens", "n_known", "n_classed", "base_score", "score"])

    out = learned.texts.select("_id", "ids", "numerators", "n_known").mapInArrow(scored, f"_id {kept}, n_tokens long, n_known long, n_classed long, base_score double, score double")
    return out.select(
        F.col("_id").alias(id_col), "n_tokens", "n_known", "n_classed", F.lit(learned.total).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
