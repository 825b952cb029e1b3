"""Near and substring dedup, embeddings, class model, packing and the pipeline against plain versions."""

import hashlib
import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import edge_rows
from tidemark.llm import class_lm, embedding_dedup, near_dedup, packing, substring_dedup
from tidemark.llm.common import crc_fold
from tidemark.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 200)] + [(5, 5)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    want = roots({n for e in links for n in e}, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}
    assert components(df.limit(0)).count() == 0


def corpus(seed=2, passages=True):
    """Texts with copies, near copies around the threshold and a passage that a third of them share."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(60, 200))] for _ in range(60)]
    common = [rnd.choice(vocabulary) for _ in range(80)]
    out = list(base)
    for words in base[:20]:
        out.append(list(words))
        for edits in (1, 2, 4, 8, 20):
            new = list(words)
            for _ in range(edits):
                new[rnd.randrange(len(new))] = rnd.choice(vocabulary)
            out.append(new)
        cut = rnd.randrange(len(words))
        out.append(words[:cut] + words[cut + 3 :])
    if passages:
        out += [common + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40))] for _ in range(60)]
    rnd.shuffle(out)
    return {i: " ".join(w) for i, w in enumerate(out)}


def test_near_duplicates_equal_all_pairs(spark):
    texts = corpus()
    labels = {i: near_dedup.shingles(t) for i, t in texts.items()}
    links = []
    for a, b in itertools.combinations(labels, 2):
        if min(len(labels[a]), len(labels[b])) >= 0.8 * max(len(labels[a]), len(labels[b])) and near_dedup.alignment(labels[a], labels[b]) >= 0.8:
            links.append((a, b))
    want = roots(texts, links)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {i: r.group_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.group_id) for i, r in got.items())


def test_near_duplicates_in_a_crowd_equal_all_pairs(spark):
    """2,000 texts round one passage, a tenth of them with a partner just under, at or over the threshold."""
    rnd = random.Random(5)
    passage, fresh = [f"p{i}" for i in range(89)], itertools.count()
    own = [[f"w{next(fresh)}" for _ in range(15)] for _ in range(2000)]
    own += [x[:k] + [f"w{next(fresh)}" for _ in range(15 - k)] for i, x in enumerate(own[:200]) for k in [3 + i % 3]]
    rnd.shuffle(own)
    texts = [" ".join(passage + x) for x in own]
    labels = [near_dedup.shingles(t) for t in texts]
    known, counts = np.unique(np.concatenate(labels), return_counts=True)
    known = known[counts > 1]
    held = np.stack([np.isin(known, x) for x in labels]).astype(np.float32)
    common = held @ held.T
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(common / (200 - common) >= 0.79, 1))) if near_dedup.alignment(labels[a], labels[b]) >= 0.8]
    assert len(links) == 133
    got = {r.doc_id: r.group_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == roots(dict(enumerate(texts)), links)


def test_independent_near_copies_equal_all_pairs(spark):
    """500 copies of one text with three to five words changed: few are links, and all share buckets."""
    rnd = random.Random(21)
    base, texts = [f"b{i}" for i in range(200)], []
    for i in range(500):
        words = list(base)
        for at in rnd.sample(range(200), rnd.randint(3, 5)):
            words[at] = f"x{i}w{at}"
        texts.append(" ".join(words))
    labels = [near_dedup.shingles(t) for t in texts]
    known, counts = np.unique(np.concatenate(labels), return_counts=True)
    known = known[counts > 1]
    held = np.stack([np.isin(known, x) for x in labels]).astype(np.float32)
    common, total = held @ held.T, np.add.outer([len(x) for x in labels], [len(x) for x in labels])
    near = np.triu(common / (total - common) >= 0.8, 1)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if near_dedup.alignment(labels[a], labels[b]) >= 0.8]
    want = roots(dict(enumerate(texts)), links)
    assert 300 < len(links) and 200 < len(set(want.values())) < 400
    got = {r.doc_id: r.group_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == want


def test_alignment_is_the_longest_common_chain():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = rng.permutation(40)[: rng.integers(20, 40)].astype(np.uint64)
        y = x.copy()
        for _ in range(rng.integers(0, 3)):
            i, j = rng.integers(0, len(y), 2)
            y[i], y[j] = y[j], y[i]
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, j in np.ndindex(len(x), len(y)):
            table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
        want = table[-1, -1] / (len(x) + len(y) - table[-1, -1])
        got = near_dedup.alignment(x, y)
        assert (got >= 0.8) == (want >= 0.8) and (want < 0.8 or got == want)


def test_near_duplicates_on_edge_rows(spark):
    rows = edge_rows(spark, [(7, "Some plain words HERE."), (8, "one"), (9, "One"), (6, " ")])
    got = {r.doc_id: r for r in near_dedup.near_duplicates(rows).collect()}
    assert got[7].group_id == 4 and not got[7].kept and got[9].group_id == 8
    assert all(got[i].kept for i in (None, 1, 2, 3, 4, 5, 6, 8))
    left = near_dedup.drop_near_duplicates(rows)
    assert left.columns == rows.columns and left.count() == 9
    assert near_dedup.near_duplicates(rows.limit(0)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    texts = corpus(seed)
    passage = [f"p{i}" for i in range(70)]
    for i in rnd.sample(sorted(texts), 40):
        words = texts[i].split()
        at = rnd.randrange(len(words))
        a = rnd.randrange(20)
        texts[i] = " ".join(words[:at] + passage[a : a + rnd.randint(45, 70)] + words[at:])
    texts |= {9000: None, 9001: "", 9002: "a " * 300, 9003: "a " * 120, 9004: " ".join(passage * 3)}
    want = substring_dedup.brute_force(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, sha(r.kept)) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 1000
    cut = {r.doc_id: r.text for r in substring_dedup.cut_repeats(df).collect()}
    for i, (n, gone, digest) in want.items():
        assert (i not in cut) == (gone == n > 0) and (i not in cut or sha(" ".join((cut[i] or "").split())) == digest or gone == n == 0)


def test_substring_dedup_on_edge_rows(spark):
    long = " ".join(f"x{i}" for i in range(60))
    rows = edge_rows(spark, [(20, long), (20, long), (20, "other text"), (21, f"start\n{long}\nend of it")])
    got = substring_dedup.remove_repeats(rows).collect()
    assert len(got) == 11 and {(r.doc_id, r.n_removed) for r in got if r.n_removed} == {(21, 60)}
    cut = substring_dedup.cut_repeats(rows)
    assert cut.columns == rows.columns and cut.count() == 11 and cut.where("doc_id = 21").first().text == "start\nend of it"
    assert substring_dedup.remove_repeats(rows.limit(0)).count() == 0


def test_embeddings_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 64))
    x = (np.repeat(base, 6, axis=0) + rng.standard_normal((720, 64)) * 0.26).astype(np.float32)
    x[5], x[700] = x[0], x[0] * 3
    rows = [(i, [float(v) for v in r], i % 2 if i > 3 else 0) for i, r in enumerate(x)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 64, 0), (1003, [float("nan")] * 64, 0), (1004, [None, *rows[0][1][1:]], 0), (1005, rows[0][1], None), (1006, rows[0][1][:10], 0), (None, rows[0][1], 0), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1)).withColumn("_v", F.lit(2))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[: len(x)]])
    i, j = np.nonzero(np.triu((unit @ unit.T >= 0.93) & (label[:, None] == label), 1))
    want, n = roots(range(len(x)), zip(i.tolist(), j.tolist())), Counter([*i.tolist(), *j.tolist()])
    out = embedding_dedup.embedding_links(df).collect()
    got = {r.vec_id: r for r in out if r.vec_id is not None and r.vec_id < 1000}
    assert len(out) == len(rows) and len(i) > 500
    assert {k: (r.n_links, r.component_id) for k, r in got.items()} == {k: (n[k], want[k]) for k in got}
    assert all(r.n_links == 0 and r.kept for r in out if r.vec_id is None or r.vec_id >= 1000)
    assert embedding_dedup.embedding_links(df.limit(0)).count() == 0


def test_large_buckets_are_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    rng = np.random.default_rng(4)
    x = rng.standard_normal(64) + rng.standard_normal((60, 64)) * 0.26
    df = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    assert {r.vec_id: r.n_links for r in embedding_dedup.embedding_links(df).collect()} == dict(enumerate(want.tolist()))


def pairs_at_the_threshold(rng, n=400, dim=64):
    a, b = rng.standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (b * a).sum(1, keepdims=True) * a
    return a, 0.9301 * a + math.sqrt(1 - 0.9301**2) * b / np.linalg.norm(b, axis=1, keepdims=True)


def test_pivots_rule_out_no_pair_at_the_threshold():
    """Vectors around pivots, some of them clustered: whatever the angles rule out holds no pair."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 16))
    x = np.repeat(base, 40, axis=0) + rng.standard_normal((480, 16)) * np.repeat(rng.uniform(0.05, 0.9, 12), 40)[:, None]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pivots = x[rng.choice(480, 20, replace=False)]
    found = embedding_dedup.angles(x, pivots)
    home = found.argmin(axis=1)
    low, high = (np.array([f(found[home == k, k]) for k in range(20)]) for f in (min, max))
    near = embedding_dedup.may_meet(embedding_dedup.angles(pivots, pivots), low, high)
    i, j = np.nonzero(x @ x.T >= 0.93)
    assert near[home[i], home[j]].all() and not near.all() and near.diagonal().all()


def test_estimates_are_unbiased_and_keep_the_links():
    a, b = pairs_at_the_threshold(np.random.default_rng(8), 500)
    code, factor, small, scale, residual = embedding_dedup.encoded(a)
    assert np.allclose(small * scale[:, None], a @ embedding_dedup.rotation(64, 0), atol=1 / 127)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    estimate = (signs * (b @ embedding_dedup.rotation(64, 0))).sum(1) / (8 * factor)
    assert abs(estimate.mean() - 0.9301) < 0.005 and estimate.std() > 0.01
    own = embedding_dedup.encoded(b)
    keep = embedding_dedup.survivors(code, factor, own[2], own[3], own[4])
    assert keep.diagonal().all() and keep.mean() < 0.2


def test_links_around_pivots_equal_all_pairs(spark, monkeypatch):
    """Labels of many blocks, with pivots that have parts; each pair counts once."""
    for name, value in (("BLOCK", 20), ("PIVOTS", 6), ("CHUNK", 50)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(14)
    x = np.repeat(rng.standard_normal((60, 32)), 4, axis=0) + rng.standard_normal((240, 32)) * 0.2
    df = spark.createDataFrame([(i, r.tolist(), "a" if i < 230 else "b") for i, r in enumerate(x)], "vec_id long, embedding array<double>, label string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    same = (np.arange(240) < 230)[:, None] == (np.arange(240) < 230)
    want = ((unit @ unit.T >= 0.93) & same).sum(1) - 1
    assert {r.vec_id: r.n_links for r in embedding_dedup.embedding_links(df).collect()} == dict(enumerate(want.tolist())) and want.sum() > 200


def test_a_large_label_loses_no_link(spark):
    """One label of 24,000 vectors in pairs just above the threshold, with the blocks and pivots of production."""
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((2, 12_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (b * a).sum(1, keepdims=True) * a
    b = 0.9305 * a + math.sqrt(1 - 0.9305**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x = np.concatenate([a, b])
    table = pa.table({"vec_id": np.arange(24_000), "embedding": pa.FixedSizeListArray.from_arrays(x.ravel(), 64).cast(pa.list_(pa.float64())), "label": np.full(24_000, 3)})
    df = spark.createDataFrame(table)
    got = embedding_dedup.embedding_links(df).toPandas().sort_values("vec_id")
    assert (got["n_links"] == 1).all() and (got["component_id"] == np.tile(np.arange(12_000), 2)).all()


def test_class_scores(spark):
    rnd = random.Random(6)
    nouns, verbs, ends = [f"N{i}" for i in range(30)], [f"v{i}" for i in range(30)], [f"e{i}" for i in range(30)]
    texts = {i: " ".join(w for _ in range(rnd.randint(1, 30)) for w in (rnd.choice(nouns), rnd.choice(verbs), rnd.choice(ends))) for i in range(400)}
    texts |= {900: None, 901: "", 902: "unseen ÄB words", 903: "N1 v1 e1 " * 3000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("_row", F.lit("x")).withColumn("key", F.lit(1))
    got = {r.doc_id: r for r in class_lm.class_scores(df, crc_fold("doc_id") != 1).collect()}
    lower = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in (t or "").split()] + [""]
    counts = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in lower(t))
    total, distinct = sum(counts.values()), len(counts)
    for i, t in texts.items():
        words = lower(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
    held = [got[i] for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.9  # classes explain the order of words
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in got.values())
    assert class_lm.class_scores(df.limit(0), F.lit(True)).count() == 0
    alone = class_lm.class_scores(df, F.lit(False)).where("doc_id = 901").first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens) == (1, 0, 0) and alone.score <= 0


def sentences(seed, n=300):
    """Texts whose words alternate between two sides, with many rare and single words on either."""
    rnd = random.Random(seed)
    side = lambda x: f"{x}{min(int(rnd.paretovariate(0.6)), 10**9)}"
    return {i: " ".join(w for _ in range(rnd.randint(1, 25)) for w in (side("a"), side("b"))) for i in range(n)}


def test_class_scores_equal_brute_force(spark, monkeypatch):
    """Given the words' classes, scores follow from plain counts; words carried, joined, rare and unseen alike."""
    monkeypatch.setattr(class_lm, "CORE", 6)
    monkeypatch.setattr(class_lm, "CARRIED", 40)
    monkeypatch.setattr(class_lm, "ROUNDS", 3)
    texts = sentences(11) | {900: None, 901: "", 902: "a1 unseen B2 never"}
    df = spark.createDataFrame([(i, t, i) for i, t in texts.items()] + [(None, "a1 b1", 1), (5, texts[5], 5)], "doc_id long, text string, _id long")
    train = (F.col("_id") % 4 != 0) & (F.col("_id") < 900)
    rows = [(i, (t or "").lower().split(), i % 4 != 0 and i < 900) for i, t in texts.items()] + [(None, ["a1", "b1"], True), (5, texts[5].split(), True)]
    classes = {r.word: r for r in class_lm.word_classes(df, train).collect()}
    counts = Counter(w for _, ws, t in rows if t for w in [*ws, ""])
    assert {w: r.c for w, r in classes.items()} == {w: c for w, c in counts.items() if w}
    assert all((r.kind is None) == (r.c < 2) for r in classes.values()) and len({r.kind for r in classes.values()}) > 5
    kind = lambda w: "end" if w == "" else classes[w].kind if w in classes and classes[w].kind is not None else "unknown"
    pairs = Counter((kind(a), kind(b)) for _, ws, t in rows if t for a, b in zip(["", *ws], [*ws, ""]))
    mass, start, types = Counter(), Counter(), Counter(kind(w) for w in counts)
    for (a, b), n in pairs.items():
        mass[b] += n
        start[a] += n
    types["unknown"] += 1
    total = sum(mass.values())

    def probability(before, word):
        a, b = kind(before), kind(word)
        prior = (mass[b] + 0.5) / (total + 0.5 * len(types))
        step = (pairs[a, b] + 20 * prior) / (start[a] + 20)
        return step * (counts[word] + 0.5) / (mass[b] + 0.5 * types[b])

    got = sorted(((str(r.doc_id), r.n_tokens, r.n_classed, round(r.score, 6)) for r in class_lm.class_scores(df, train).collect()), key=str)
    want = [(str(i), len(ws) + 1, sum(kind(w) not in ("unknown", "end") for w in ws), round(sum(math.log10(probability(a, b)) for a, b in zip(["", *ws], [*ws, ""])), 6)) for i, ws, _ in rows]
    assert got == sorted(want, key=str)
    for before in ("", "a1", "unseen", *list(counts)[:5]):
        assert sum(probability(before, w) for w in [*counts, "unseen"]) == pytest.approx(1)


def test_words_take_their_best_class():
    """Choices against the plain likelihood of each class, the word taken out of its own first."""
    rng = np.random.default_rng(12)
    kinds, k = 10, 8
    matrix = rng.integers(40, 400, (kinds, kinds)).astype(float)
    vectors = rng.integers(0, 3, (300, 2 * kinds)) * rng.integers(0, 2, (300, 2 * kinds)) * rng.choice([1, 1, 7], (300, 1))
    vectors[:, kinds:] = rng.permuted(vectors[:, :kinds], axis=1)  # as many follow as precede
    vectors = vectors[vectors.sum(1) > 0].astype(float)
    own = rng.integers(-1, k, len(vectors))
    word, j = np.nonzero(vectors)
    best = class_lm.Choice(matrix).best(word, j, vectors[word, j], own)
    phi = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    moved = 0
    for v, mine, got in zip(vectors, own, best):
        after, before, t = v[:kinds], v[kinds:], v.sum() / 2
        gains = []
        for i in range(k):
            row, column, sign = matrix[i], matrix[:, i], -1 if i == mine else 1
            gain = phi(row + sign * after) - phi(row) + phi(column + sign * before) - phi(column)
            gains.append(sign * (gain - phi(np.array([row.sum() + sign * t, matrix[:, i].sum() + sign * t])) + phi(np.array([row.sum(), matrix[:, i].sum()]))))
        assert gains[got] == pytest.approx(max(gains), rel=1e-5)
        moved += mine >= 0 and got != mine
    assert moved > 50
    empty = matrix.copy()
    empty[3], empty[:, 3] = 0, 0
    assert 3 not in class_lm.Choice(empty).best(word, j, vectors[word, j], np.full(len(vectors), -1))


def test_contexts_count_all_neighbours(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "HELD_COUNTS", 40)
    rng = np.random.default_rng(3)
    texts = [rng.integers(-1, 12, int(rng.integers(0, 60))).astype(np.int32) for _ in range(80)]
    df = spark.createDataFrame([(t.tobytes(),) for t in texts], "ids binary").repartition(5)
    want = Counter()
    for t in texts:
        line = [13, *(12 if x < 0 else int(x) for x in t), 13]
        for a, b in zip(line, line[1:]):
            want[a, 2 * b] += a < 12
            want[b, 2 * a + 1] += b < 12
    rows = class_lm.contexts(df, 12).collect()
    got = {(r.w, int(code)): int(n) for r in rows for code, n in np.frombuffer(r.after + r.before, np.int32).reshape(-1, 2)}
    assert all((r.unknown, r.end) == (want[r.w, 2 * 12 + 1], want[r.w, 2 * 13 + 1]) for r in rows)
    assert got == {k: n for k, n in want.items() if n} and len(rows) == len({r.w for r in rows})
    kind = np.array([*(i % 4 for i in range(12)), 4, 5], np.uint16)
    matrix = class_lm.class_matrix(class_lm.contexts(df, 12), spark.sparkContext.broadcast(kind), 6)
    whole = class_lm.kind_pairs(df, spark.sparkContext.broadcast(kind), 6)
    whole[4:, 4:] = 0
    assert (matrix == whole).all() and matrix.sum() > 500


def test_contexts_travel_in_groups(spark, monkeypatch):
    """A task hands on a row for each group of words, not for each word; the counts are those of plain pairs."""
    monkeypatch.setattr(class_lm, "GROUPS", 1)
    line = [int(x) for x in np.random.default_rng(5).integers(0, 300, 4000)]
    rows = class_lm.contexts(spark.createDataFrame([(np.array(line, np.int32).tobytes(),)], "ids binary"), 300).collect()
    want = Counter(zip([301, *line], [*line, 301]))
    got = {(r.w, int(code) // 2): int(n) for r in rows for code, n in np.frombuffer(r.after, np.int32).reshape(-1, 2)}
    assert got == {k: n for k, n in want.items() if k[0] != 301} and len(rows) == 300
    codes = np.arange(300) * class_lm._SIDE  # a neighbour for each word, in the order in which they are dealt
    assert class_lm._grouped(codes, np.ones(300, np.int64)).num_rows == 3


def test_gains_are_summed_in_small_pieces():
    """What choices hold besides the gains stays in the cache of a core, however many entries words have."""
    rng = np.random.default_rng(4)
    choice = class_lm.Choice(rng.integers(1, 900, (130, 130)).astype(float))
    word, j = np.repeat(np.arange(200), 100), np.tile(np.arange(100), 200)
    tracemalloc.start()
    choice.best(word, j, np.ones(len(word)), np.full(200, -1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20


def test_exchange_of_all_words_reaches_that_in_turn(spark, monkeypatch):
    """Words of two sides and several topics: choosing at once is as good as one word after the other."""
    rnd = random.Random(21)
    texts = []
    for _ in range(500):
        topic = rnd.randrange(4)
        texts.append(" ".join(f"{side}{topic}x{min(int(rnd.paretovariate(0.8)), 60)}" for _ in range(rnd.randint(2, 20)) for side in "ab"))
    own = class_lm._own(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), F.lit(True), "doc_id", "text")
    value = {}
    for core in (10, 1000):
        monkeypatch.setattr(class_lm, "CORE", core)
        learned = class_lm.learn(own)
        value[core] = class_lm.likelihood(class_lm.kind_pairs(learned.texts, spark.sparkContext.broadcast(learned.kind), learned.classes + 2))
        assert (learned.kind[:-2] < learned.classes).all() and len(learned.kind) > 300
    # one word after the other, each against the counts of the moment, until none moves
    words, kinds = len(learned.kind) - 2, learned.classes + 2
    tokens = np.concatenate([[words + 1], *([*np.where(x < 0, words, x), words + 1] for x in (np.frombuffer(r.ids, np.int32) for r in learned.texts.select("ids").collect()))]).astype(int)
    pairs = Counter(zip(tokens[:-1].tolist(), tokens[1:].tolist()))
    kind = np.array([*(i % learned.classes for i in range(words)), learned.classes, learned.classes + 1])
    around = defaultdict(list)
    for (x, y), n in pairs.items():
        around[x].append((0, y, n))
        around[y].append((1, x, n))
    matrix = np.zeros((kinds, kinds))
    for (x, y), n in pairs.items():
        matrix[kind[x], kind[y]] += n
    for _ in range(40):
        moved = 0
        for w in range(words):
            vector = np.zeros((2, kinds))
            for side, other, n in around[w]:
                vector[side, kind[other]] += n
            to = class_lm.best_class(matrix, kind[w], vector[0], vector[1])
            if to != kind[w]:
                kind[w] = to
                moved += 1
                matrix[:] = 0
                for (x, y), n in pairs.items():
                    matrix[kind[x], kind[y]] += n
        if not moved:
            break
    in_turn = class_lm.likelihood(matrix)
    assert in_turn < 0 and value[1000] >= in_turn and value[10] >= 1.003 * in_turn  # a start of ten words is at most 0.3 % behind


def test_word_keys_equal_those_of_spark(spark):
    words = ["", "a", "straße", "x" * 40]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64(F.col("w").cast("binary"))).collect()]
    assert got == [class_lm.word_key(w.encode()) for w in words]


def test_carried_and_joined_words_score_alike(spark, monkeypatch):
    df = spark.createDataFrame(list(sentences(13, 80).items()), "doc_id long, text string")
    monkeypatch.setattr(class_lm, "CORE", 3)
    monkeypatch.setattr(class_lm, "ROUNDS", 2)
    scores = lambda: {r.doc_id: (r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in class_lm.class_scores(df, F.col("doc_id") < 60).collect()}
    one = scores()
    monkeypatch.setattr(class_lm, "CARRIED", 12)
    assert one == scores()


def test_exchange_raises_the_likelihood(spark):
    rows = [(a, b, 5 if (a % 2) != (b % 2) else 1) for a in range(62) for b in range(62)]
    kind, matrix = class_lm.exchange(spark.createDataFrame(rows, "w1 int, w2 int, n long"), 60, 8)
    start = np.zeros_like(matrix)
    of = [*(i % 8 for i in range(60)), 8, 9]
    for a, b, n in rows:
        start[of[a], of[b]] += n
    assert class_lm.likelihood(matrix) >= class_lm.likelihood(start) and matrix.sum() == start.sum()


def test_boundaries_are_optimal():
    rng = np.random.default_rng(7)
    for _ in range(150):
        n = int(rng.integers(1, 9))
        lengths, counts, k = np.sort(rng.choice(60, n, replace=False)), rng.integers(1, 20, n), int(rng.integers(1, 5))
        cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))
        best = min(cost({*x, lengths[-1]}) for m in range(k) for x in itertools.combinations(lengths, m))
        got = packing.boundaries(lengths, counts, k)
        assert cost(got) == best and len(got) <= k


def least_padding(lengths, counts, buckets):
    """The plain quadratic programme."""
    n = len(lengths)
    number = np.concatenate([[0], np.cumsum(counts)])
    best = [lengths[i] * number[i + 1] for i in range(n)]
    for _ in range(buckets - 1):
        best = [min(best[i], *(best[k] + lengths[i] * (number[i + 1] - number[k + 1]) for k in range(i))) if i else best[0] for i in range(n)]
    return best[-1] - int((np.asarray(lengths) * counts).sum())


def test_padding_is_least_over_long_lengths(spark):
    rng = np.random.default_rng(9)
    drawn = np.minimum(20000, rng.lognormal(6, 1.2, 1500).astype(int))
    lengths, counts = np.unique(drawn, return_counts=True)
    assert lengths[-1] > 10000 and len(lengths) > 600
    df = spark.createDataFrame(list(enumerate(drawn.tolist())), "doc_id long, n long").withColumn("text", F.lit(None).cast("string"))
    got = packing.pack(df, length=F.col("n"), buckets=6).collect()
    assert sum(r.padding for r in got) == least_padding(lengths.tolist(), counts, 6)


def test_packing(spark):
    rnd = random.Random(8)
    rows = [(i, "w " * int(rnd.lognormvariate(3, 1))) for i in range(900)] + [(9000, "w " * 40000), (9001, None), (9002, ""), (None, "w w"), (3, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = packing.pack(df, token_budget=2000).collect()
    assert len(got) == len(rows)
    batches, sizes = defaultdict(list), defaultdict(list)
    for r in got:
        assert 0 <= r.padding == r.padded_length - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    for (bucket, _), members in batches.items():
        each = max(1, 2000 // max(1, members[0].padded_length))
        assert sorted(r.slot for r in members) == list(range(len(members))) and len(members) <= each
        sizes[bucket].append(len(members) == each)
    assert all(full.count(False) <= 1 for full in sizes.values())
    assert packing.pack(df.limit(0)).count() == 0
    nobody = spark.createDataFrame([(None, "w " * (i % 3)) for i in range(300)] + [(7, "w")] * 300, "doc_id long, text string")
    got = packing.pack(nobody, token_budget=10).collect()
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(got) == 600


def test_pipeline_stages_on_edge_rows(spark, tmp_path):
    long = " ".join(f"the thing{i} and" for i in range(40))
    own = " ".join(f"other{i} words{i} before{i}" for i in range(30))
    more = [(30, long), (31, long.upper()), (32, f"{own} it came. {long} And after."), (33, "Mail to the person at a.b@c.org and thanks."), (34, "12 34 ..")]
    docs = edge_rows(spark, more)
    counts = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, "")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
            docs.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
        counts[name] = sorted((r.doc_id is not None, r.doc_id) for r in docs.select("doc_id").collect())
    ids = {k: [i for _, i in v] for k, v in counts.items()}
    assert ids["language_id"] == [None, 4, 4, 5, 30, 31, 32, 33]
    assert ids["near_dedup"] == [None, 4, 4, 5, 30, 32, 33]
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "personal_data")).collect()}
    assert texts[32] == f"{own} it came. And after." and texts[33] == "Mail to the person at <EMAIL> and thanks."
    assert ids["packing"] == ids["personal_data"] == ids["near_dedup"]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
