"""The prefix trie, vector codes and shards against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as trie
from tidemark.llm import sharding, vector_codes
from tidemark.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows, rebuild=True):
    """{(conv_id, depth): the other columns} by walking all prefixes."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in said.items()}
    if rebuild:
        cut = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        convs = {c: convs.get(c - int(math.fmod(c, 20)), [])[: cut[c]] + t[cut[c] :] for c, t in convs.items()}
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, below = defaultdict(int), defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]] += 1
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    saved = lambda p: (len(members[p]) - 1) * len(p[-1][1].split()) if p else 0
    out = {}
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(p))
        out[m[0], len(p)] = (
            members[p[:-1]][0] if p else None, len(m), children[p], sum(not children[q] for q in below[p]), sum(map(saved, below[p])), hashlib.sha256(ends.encode()).hexdigest())
    return out


def nodes(df):
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()}
    assert len(got) == df.count()
    return got


def conversations(seed, n=160):
    """Conversations that share first turns, repeat as wholes, stop early or have one turn only."""
    rnd = random.Random(seed)
    say = lambda: " ".join(rnd.choice(["yes", "no", "why", "how\tso", ""]) for _ in range(rnd.randint(0, 4)))
    openings = [[("user", say()), ("assistant", say())] for _ in range(4)]
    known, rows = [], []
    for c in rnd.sample(range(-40, 3 * n), n):
        turns = list(rnd.choice(known)) if known and rnd.random() < 0.4 else list(rnd.choice(openings))[: rnd.randint(0, 2)]
        turns += [(rnd.choice(["user", "assistant", None]), say() or None) for _ in range(rnd.choice([0, 1, 2, 5]))]
        turns = turns or [("user", "hi")]
        known.append(turns)
        rows += [(c, None if i == 0 and c % 7 == 0 else i, role, text) for i, (role, text) in enumerate(turns)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_a_walk(spark, rebuild):
    rows = conversations(3) + [(None, 0, "user", "nobody's")]
    turns = trie.ordered_turns(spark.createDataFrame(rows, TURNS))
    assert nodes(trie.prefix_trie(trie.rebuilt(turns) if rebuild else turns)) == plain_trie(rows, rebuild)


def test_trie_with_crowds_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    same = [(c, t, "user", f"all say {t}") for c in range(1000, 1300) for t in range(3)]
    chain = [(c, t, "user", f"line {t} of a chat") for c in range(2000, 2030) for t in range(c - 1999)]
    long = [(9999, t, "user", f"turn {t} " + "x " * 50) for t in range(1500)]
    rows = same + chain + long
    assert nodes(trie.prefix_trie(trie.ordered_turns(spark.createDataFrame(rows, TURNS)))) == plain_trie(rows, False)


def test_trie_edge_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(trie.rebuilt(trie.ordered_turns(empty))).count() == 0
    # 25 lends its first turns from an absent conversation and has none left; repeated rows count as turns each
    rows = [(25, 0, "user", "a")] + [(7, None, None, None)] * 2 + [(7, 1, "user", "b c")]
    clash = spark.createDataFrame([(*r, 5, "x") for r in rows], TURNS + ", _c int, depth string")
    assert nodes(trie.prefix_trie(trie.rebuilt(trie.ordered_turns(clash)))) == plain_trie(rows)
    turnless = [(25, 0, "user", "a")]
    got = nodes(trie.prefix_trie(trie.rebuilt(trie.ordered_turns(spark.createDataFrame(turnless, TURNS)))))
    assert got == plain_trie(turnless)


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """{id: (code, error)}, label errors and final codebooks with Python's integers and whole distances."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    step = width // parts
    whole = [[math.floor(x * 4096) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    cut = lambda v, p: v[p * step : (p + 1) * step]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[cut(whole[n], p) for n in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda x, book: min((far(x, c), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = defaultdict(list)
            for v in whole:
                mine[best(cut(v, p), book)[1]].append(cut(v, p))
            for k, xs in mine.items():
                book[k] = [sum(x) // len(xs) for x in zip(*xs)]
    out, labels = [], defaultdict(int)
    for (i, _, lab), v in zip(kept, whole):
        found = [best(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        labels[lab] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, lab))
    text = ",".join(str(x) for book in books for c in book for x in c)
    return sorted(((i, code, e, labels[lab], hashlib.sha256(text.encode()).hexdigest()) for i, code, e, lab in out), key=str)


def codes(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


VECTORS = "vec_id long, embedding array<double>, label int"


def test_codes_equal_a_plain_search(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(6, 24))[rng.integers(0, 6, 300)] + rng.normal(size=(300, 24)) * 0.3, 2)  # rounded, so that distances tie
    rows = [(i, v.tolist(), int(i % 3) if i % 5 else None) for i, v in enumerate(x)]
    rows += [(500 + i, rows[7][1], 1) for i in range(100)]  # one common vector
    rows += [(700, None, 1), (701, [1.0, None] * 12, 1), (702, [math.nan] * 24, 2), (703, [math.inf] * 24, 2), (5, rows[9][1], 1)]
    got = codes(vector_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(5)))
    assert got == plain_codes(rows)


def test_codes_of_edge_rows(spark):
    assert vector_codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 3)], VECTORS)).count() == 0
    few = [(None, [0.5, -0.25, 1.0], 1), (3, [], None), (3, [0.5, -0.25, 1.0], None), (3, [2.0] * 11, 1)]  # lengths that 8 doesn't divide
    frame = spark.createDataFrame([(*r, "x") for r in few], VECTORS + ", code string")
    assert codes(vector_codes.compress(frame)) == plain_codes(few)
    large = [(i, [10.0 ** (i + d) * (-1) ** d for d in range(8)], 0) for i in range(4)] + [(9, [1e200] * 8, 1)]
    got, want = codes(vector_codes.compress(spark.createDataFrame(large, VECTORS))), plain_codes(large)
    fits = lambda e: e if e < 2**63 else None
    assert got == [(i, code, fits(e), fits(le), sha) for i, code, e, le, sha in want]


def test_search_drops_nothing_that_ties():
    rng = np.random.default_rng(2)
    for _ in range(50):
        x, book = rng.integers(-3, 4, (60, 5)), rng.integers(-3, 4, (16, 5))
        far = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        code, d = vector_codes.nearest(x, book)
        assert (code == far.argmin(axis=1)).all() and (d == far.min(axis=1)).all()
    order = vector_codes.dimension_order(np.array([[0, 0, 5], [1, 9, 5], [2, 0, 5]]))
    assert order.tolist() == [1, 0, 2]


def plain_shards(rows, shards=8):
    size = lambda t: len((t or "").encode()) + 1
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), size(r[1])))
    total, before, slots, out = sum(size(t) for _, t in rows), 0, defaultdict(int), []
    for i, text in order:
        shard = (2 * before + size(text)) * shards // (2 * total)
        out.append((i, size(text), zlib.crc32((text or "").encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size(text)
    return sorted(out, key=str)


def test_shards_equal_running_sums(spark):
    rnd = random.Random(4)
    rows = [(i, "ü" * rnd.randint(0, 300)) for i in range(700)]
    rows += [(None, "same text")] * 400 + [(3, None), (3, None), (3, ""), (900, "long " * 3000)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard int, _id string")
    got = sharding.shard_by_bytes(frame.repartition(6)).collect()
    assert sorted(map(tuple, got), key=str) == plain_shards(rows)
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r["size"]
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in got)
    assert sharding.shard_by_bytes(frame.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, "x" * 10000), (2, "y")], "doc_id long, text string")
    assert sorted(map(tuple, sharding.shard_by_bytes(huge).collect()), key=str) == plain_shards([(1, "x" * 10000), (2, "y")])


def test_registered_queries(spark, tmp_path):
    rows = conversations(11, 60)
    spark.createDataFrame(rows, TURNS).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert nodes(QUERIES["op11_prefix_trie"](spark, str(tmp_path))) == plain_trie(rows)
    vectors = [(i, np.random.default_rng(i).normal(size=16).tolist(), i % 2) for i in range(60)]
    spark.createDataFrame(vectors, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert codes(QUERIES["op12_vector_codes"](spark, str(tmp_path))) == plain_codes(vectors)
    docs = [(i, f"text {i} " * (i % 9)) for i in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("lang", F.lit("en")).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, QUERIES["op13_sharding"](spark, str(tmp_path)).collect()), key=str) == plain_shards(docs)
