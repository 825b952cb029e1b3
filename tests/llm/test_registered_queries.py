"""Every registered query of the numbered operators on a small folder of tables, against libraries and plain versions."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tests.llm.test_corpus_operators import roots, sha
from tests.llm.test_text_operators import base_spans, plain_counts
from tidemark.llm import near_dedup, substring_dedup
from tidemark.llm.queries import PIECES, QUERIES, WORDS

SYLLABLES = {"en": "the and ing tion er re on at".split(), "de": "der und sch ung ein ver keit ü".split(), "fr": "le que eau oi é ment la è".split()}


def corpus():
    rnd = random.Random(31)
    out = []
    for _ in range(90):
        lang = rnd.choice(list(SYLLABLES))
        word = lambda: "".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3)))  # noqa: E731, B023
        lines = [" ".join(word() for _ in range(rnd.randint(3, 30))).capitalize() + rnd.choice([".", "", " !!!"]) for _ in range(rnd.randint(1, 12))]
        out.append(("\n".join(lines), lang))
    out += [out[3], out[3], (out[5][0] + " one more.", out[5][1])]
    passage = " ".join(f"shared{i}" for i in range(70))
    out += [(f"{out[i][0]} {passage} {out[i + 1][0]}", out[i][1]) for i in range(10, 14)]
    out += [("Mail a.b@c.org or +49 30 1234567, card 4111 1111 1111 1111, host 10.0.0.1, token=ab12cd34ef", "en")]
    out += [("", "en"), (None, "de"), (" \n\t ", None), ("日本語のテキスト 😀 <s> <|endoftext|> ''", None), ("word " * 5000, "en")]
    return [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(out)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    rng = np.random.default_rng(6)
    x = np.repeat(rng.standard_normal((20, 16)), 3, axis=0) + rng.standard_normal((60, 16)) * 0.2
    vectors = [(i, v.tolist(), i % 2) for i, v in enumerate(x)] + [(100, None, 0), (101, [0.0] * 16, 1), (102, x[0].tolist(), None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder, {r[0]: r[1] for r in rows}, vectors


def results(spark, tables, name):
    return {r[0]: r for r in QUERIES[name](spark, tables[0]).collect()}


def test_op1(spark, tables):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    got = results(spark, tables, "op1_token_counts")
    for i, text in tables[1].items():
        n = len(library.encode(text or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 4096)
    assert any(r.over_limit for r in got.values())


def test_op2(spark, tables):
    texts = tables[1]
    labels = {i: x for i, t in texts.items() if len(x := near_dedup.shingles(t))}
    links = [(a, b) for a in labels for b in labels if a < b and near_dedup.alignment(labels[a], labels[b]) >= 0.8]
    want, got = roots(texts, links), results(spark, tables, "op2_near_dedup")
    assert {i: (r.group_id, r.kept) for i, r in got.items()} == {i: (want[i], want[i] == i) for i in texts} and len(links) >= 3


def test_op3(spark, tables):
    kinds = ("email", "ip", "card", "phone")
    got = results(spark, tables, "op3_personal_data")
    for i, text in tables[1].items():
        base = base_spans(text or "")
        counts = Counter(k for _, k, _ in base)
        assert [got[i][f"n_{k}"] for k in kinds] == [counts[k] for k in range(4)]
        assert got[i].base_sha256 == sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in base))
        spans = [x.split(":") for x in got[i].spans.split(",") if x]
        order = ("email", "ip", "card", "phone", "account", "url")
        assert spans == sorted(spans, key=lambda x: (int(x[1]), order.index(x[0])))
        assert {(k, int(s), int(e)) for k, s, e in spans} >= {(kinds[k], s, e) for s, k, e in base}
    assert sum(r.n_card for r in got.values()) == 1 and any("account:" in r.spans for r in got.values())


def test_op4(spark, tables):
    got = results(spark, tables, "op4_class_lm")
    lower = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in (t or "").split(" ") if w]
    texts = {i: lower(" ".join((t or "").replace("\n", " ").replace("\t", " ").split(" "))) for i, t in tables[1].items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, ws in texts.items() if not held[i] for w in [*ws, ""])
    total, distinct = sum(counts.values()), len(counts)
    for i, ws in texts.items():
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in [*ws, ""])
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(ws) + 1, sum(counts[w] > 0 for w in [*ws, ""]), total)
        assert got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].score < 0
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_op5(spark, tables):
    want = substring_dedup.brute_force(tables[1])
    got = results(spark, tables, "op5_substring_dedup")
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == want and sum(x[1] for x in want.values()) > 200


def test_op6(spark, tables):
    vectors = tables[2]
    good = {i: np.array(v, np.float32).astype(float) for i, v, label in vectors if v and label is not None and any(v)}
    label = {i: x for i, _, x in vectors}
    cosine = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    links = [(a, b) for a in good for b in good if a < b and label[a] == label[b] and cosine(good[a], good[b]) >= 0.93]
    want, n = roots(label, links), Counter(x for e in links for x in e)
    got = results(spark, tables, "op6_embedding_dedup")
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (n[i], want[i], want[i] == i) for i in label} and len(links) > 10


def test_op7(spark, tables):
    got = results(spark, tables, "op7_packing")
    assert {i: r.n_tokens for i, r in got.items()} == {i: len((t or "").split()) for i, t in tables[1].items()}
    ends = defaultdict(set)
    for r in got.values():
        assert r.padding == r.padded_length - r.n_tokens >= 0
        ends[r.bucket].add(r.padded_length)
    assert all(len(x) == 1 for x in ends.values()) and len(ends) == 16
    places = [(r.bucket, r.batch, r.slot) for r in got.values()]
    assert len(set(places)) == len(places)


def letters(text):
    return any(c.isalpha() for c in text or "")


def test_op8(spark, tables):
    got = results(spark, tables, "op8_language_id")
    rows = {r[0]: r for r in corpus()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    assert all((r.lang_pred == "und") == (not letters(tables[1][i])) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out and rows[i][2] and letters(rows[i][1])]
    assert len(held) > 10 and sum(got[i].lang_pred == rows[i][2] for i in held) >= 0.9 * len(held)


def test_op8_kernels_equal_a_plain_version(spark):
    """Scores of the model against kernels of plain n-gram sets and a dense ridge solution."""
    from tidemark.llm import language_id

    rows = [(i, t, lang) for i, t, lang, *_ in corpus() if letters(t) and lang]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))

    def grams(text):
        plain = "".join(c.lower()[0] if c.isalpha() else " " for c in text).split()
        line = " " + " ".join(plain) + " "
        return {line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)}

    for _, text, _ in rows[:20]:
        present, _ = language_id.ngrams(text)
        assert abs(int(present.sum()) - len(grams(text))) <= max(3, 0.02 * len(grams(text)))  # hashed cells hardly collide
    sample = [np.flatnonzero(language_id.ngrams(t)[0]) for _, t, _ in rows]
    kernel = lambda a, b: len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))
    got = model.scores([language_id.ngrams(t)[0] for _, t, _ in rows])
    landmark = [np.flatnonzero(model.landmarks[:, j]) for j in range(model.landmarks.shape[1])]
    active = np.flatnonzero(model.column >= 0)
    k = np.array([[kernel(s, active[m]) for m in landmark] for s in sample])
    out = language_id.SHARPNESS * (k @ model.weights + model.bias)
    out = np.exp(out - out.max(1, keepdims=True))
    assert np.allclose(got, out / out.sum(1, keepdims=True), atol=2e-3)


def test_op9(spark, tables):
    got = results(spark, tables, "op9_line_quality")
    for i, text in tables[1].items():
        r = got[i]
        want = plain_counts(text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)
    assert any(r.kept for r in got.values())


def test_op10(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(WORDS))
    got = results(spark, tables, "op10_bpe_codec")
    for i, text in tables[1].items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_null_ids_and_repeated_rows(spark, tmp_path):
    rows = [(None, "Some text without id."), (None, None), (7, "Twice."), (7, "Twice.")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, query in QUERIES.items():
        if name not in ("op6_embedding_dedup", "op11_prefix_trie", "op12_vector_codes"):  # they read other tables
            out = query(spark, str(tmp_path))
            assert out.count() == 4, name
            if "held_out" in out.columns:
                assert {r[0] for r in out.where("doc_id IS NULL").select("held_out").collect()} == {False}
