"""BPE encoding and decoding with forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never end up inside one, so it
marks a certain cut.  The vocabulary's certain cuts split every word into fragments;
each fragment is merged on its own (and remembered), and the identifiers are
concatenated.  Decoding maps identifiers back to their token strings.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from operator import add

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, ship, text_or_empty

MEMO_WORDS = 700_000  # remembered words a worker, identifiers and token strings; about 200 MB
MEMO_LENGTH = 40

# Unicode white space, as a character class body.
WHITE = r"\t-\r \x85\xa0  -     　"


def printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordCodec:
    """Encoder and decoder for a byte-level BPE with a word-end suffix.

    ``spec`` is the tokenizer file, parsed.  Understood are: a normaliser of NFC, white-space
    replacement and lower case; a pre-tokenizer that keeps the matches of one pattern; added
    tokens matched in the raw text; no post-processor and no decoder.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {tuple(p): r for r, p in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self.names = names
        self.bytes = printable_bytes()
        bare = (t.removesuffix(self.suffix) if self.suffix else t for t in self.vocab)
        self.inner = {t[i : i + 2] for t in bare for i in range(len(t) - 1)}
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace("[^\\s", f"[^{WHITE}"))
        self.white = regex.compile(f"[{WHITE}]+")
        specials = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.memo = Memo(self._word, MEMO_WORDS)

    def normalised(self, text: str) -> str:
        text = self.white.sub(" ", unicodedata.normalize("NFC", text))
        return text.replace("Σ", "σ").lower()  # sigma without regard to its place in the word

    def encode(self, text: str) -> bytes:
        """Identifiers as little-endian uint32."""
        ids = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.added:
                ids.append(struct.pack("<I", self.added[part]))
            elif part:
                memo = self.memo
                words = self.words.findall(self.normalised(part))
                if not words:
                    continue
                if max(map(len, words)) <= MEMO_LENGTH:
                    ids += map(memo.__getitem__, words)
                else:
                    ids += [memo[w] if len(w) <= MEMO_LENGTH else self._word(w) for w in words]
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """The token strings of packed identifiers joined by a space, unknown ones left out."""
        return " ".join(filter(None, map(self.names.get, np.frombuffer(ids, "<u4").tolist())))

    def _word(self, word: str) -> bytes:
        chars = word if word.isascii() and word.isprintable() else "".join([self.bytes[b] for b in word.encode("utf-8")])
        inner = self.inner
        if inner.issuperset(map(add, chars, chars[1:])):
            ids = self._merged(chars, True)
        else:
            cuts = [i for i in range(1, len(chars)) if chars[i - 1 : i + 1] not in inner]
            ids = []
            for start, end in zip([0, *cuts], cuts):
                ids += self._merged(chars[start:end], False)
            ids += self._merged(chars[cuts[-1] :], True)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merged(self, chars: str, last: bool) -> list[int]:
        """Identifiers of a fragment: the lowest-ranked pair merges first, the leftmost among equals."""
        parts = list(chars)
        if last:
            parts[-1] += self.suffix
        if len(parts) > 64:
            parts = self._merge_long(parts)
        elif len(parts) > 1:
            rank, none = self.ranks.get, len(self.ranks)
            ranks = [rank(p, none) for p in zip(parts, parts[1:])]
            while ranks and (best := min(ranks)) < none:
                i = ranks.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = rank((parts[i], parts[i + 1]), none)
                if i:
                    ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
        vocab = self.vocab
        return [vocab[p] for p in parts if p in vocab]

    def _merge_long(self, parts: list[str | None]) -> list[str]:
        """The same merges by heap over a linked list: O(n log n) for a long run without a cut."""
        from heapq import heapify, heappop, heappush

        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            if parts[i] != left or (j := after[i]) >= n or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((parts[i], parts[k]))) is not None:
                    heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heappush(heap, (r, h, parts[h], parts[i]))
        return [p for p in parts if p is not None]


_codecs: dict = {}


def _codec(spec) -> WordCodec:
    """One codec a Python worker, kept between tasks with its memo."""
    value = spec.value
    key = hashlib.md5(value.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = WordCodec(json.loads(value))
    return _codecs[key]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (binary, little-endian uint32), decoded (string) from those ids.

    Null and empty texts give no identifiers and an empty decoded text.  Every row stands
    alone: repeated rows, null ids and further columns change nothing.  A scan without
    shuffle; the vocabulary is broadcast, its size is the tokenizer file's.
    """
    ship(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("ids binary, decoded string")
    def coded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(spec)
        for texts in parts:
            ids = [codec.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [codec.decode(i) for i in ids]})

    return docs.select(F.col(id_col), coded(text_or_empty(text_col)).alias("c")).select(id_col, "c.ids", "c.decoded")


def decode_ids(coded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, decoded: the text of identifiers that ``encode_decode`` or another encoder stored; null decodes to empty."""
    ship(coded.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = coded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def shown(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(spec)
        for ids in parts:
            yield pd.Series([codec.decode(bytes(b) if b is not None else b"") for b in ids], dtype="object")

    return coded.select(F.col(id_col), shown(F.col(ids_col)).alias("decoded"))
