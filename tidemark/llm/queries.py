"""The registered queries of the numbered operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, table

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_count import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe_codec import encode_decode

    coded = encode_decode(table(spark, sf_dir, "documents"), vocabulary(WORDS))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .personal_data import personal_data

    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .class_lm import class_scores

    found = class_scores(table(spark, sf_dir, "documents"), crc_fold("doc_id") != 1)
    return found.select("doc_id", F.coalesce(crc_fold("doc_id") == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_classed", "perplexity")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import embedding_links

    return embedding_links(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, crc_fold("doc_id") != 0)
    return found.select("doc_id", F.coalesce(crc_fold("doc_id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_quality import line_quality

    found = line_quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_lines_removed")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import ordered_turns, prefix_trie, rebuilt

    return prefix_trie(rebuilt(ordered_turns(table(spark, sf_dir, "conversations"))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import compress

    return compress(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_near_dedup": op2_near_dedup,
    "op3_personal_data": op3_personal_data,
    "op4_class_lm": op4_class_lm,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_packing": op7_packing,
    "op8_language_id": op8_language_id,
    "op9_line_quality": op9_line_quality,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_sharding": op13_sharding,
}

_WORD = r"[^\x20\x09-\x0D]+"
_SPACES = r"[\x20\x09-\x0D]"


def _line_quality_sql() -> str:
    from . import line_quality as q

    count = lambda chars: f"len(regexp_extract_all(x, '[{chars}]'))"
    words = f"len(regexp_extract_all(x, '{_WORD}'))"
    end = q.SENTENCE_END.replace("'", "''")
    phrases = "|".join(q.BOILERPLATE)
    fails = f"""(({count(q.SYMBOLS)} >= 3 AND {count(q.SYMBOLS)} * 3 >= {words}) OR ({count('!')} >= 3 AND {count('!')} * 2 >= {words})
      OR ({count(q.SEPARATORS)} >= 3 AND {words} <= 4 * ({count(q.SEPARATORS)} + 1))
      OR ({words} <= {q.FRAGMENT_WORDS} AND NOT regexp_matches(x, '{end}'))
      OR ({words} >= {q.LONG_LINE_WORDS} AND NOT regexp_matches(x, '\\p{{P}}'))
      OR (regexp_matches(x, '{q.LINK}') AND (len(regexp_extract_all(x, '{q.LINK}')) + 1) * 2 > {words})
      OR (regexp_matches(lower(x), '{phrases}') AND ({words} <= {q.BOILERPLATE_WORDS}
        OR 5 * (length(x) - length(regexp_replace(lower(x), '{phrases}', '', 'g'))) >= length(x))))"""
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM d),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(w[1:len(w) - 2]) AS x, unnest(w[2:len(w) - 1]) AS y, unnest(w[3:len(w)]) AS z FROM w WHERE len(w) >= 3),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM grams),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1) GROUP BY 1),
b AS (SELECT *, list_filter(l, lambda x: {fails}) AS bad FROM w),
c AS (SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[{q.SYMBOLS}]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(bad) AS BIGINT) AS n_lines_removed,
    length(regexp_replace(array_to_string(bad, ''), '{_SPACES}', '', 'g')) AS lost
  FROM b LEFT JOIN repeated r USING (doc_id)),
f AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT * EXCLUDE (lost), NOT base_failed AND 100 * lost <= {q.MAX_LOST_PERCENT} * word_chars AS kept FROM f"""


def _substring_sql(width: int = 50) -> str:
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + {width - 1}], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS p FROM w WHERE len(w) >= {width})),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY x) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {width})) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (SELECT a.doc_id, string_agg(x, ' ' ORDER BY a.p) AS k, count(*) AS n FROM words a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p WHERE g.p IS NULL GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""


_EMBEDDING_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a AS x, a AS y FROM links UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY 1),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, v.vec_id) AS component_id, v.vec_id = coalesce(component_id, v.vec_id) AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)"""

#: Steps of crc32 by byte, and the sum of a list of bytes.
_CRC_STEPS = """crc AS (SELECT list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, range(0, 8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""


def _crc_sql(text: str) -> str:
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295)"


def _sharding_sql(shards: int = 8) -> str:
    return f"""WITH {_CRC_STEPS},
d AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, CAST({_crc_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents, crc),
p AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS before, CAST(sum(size) OVER () AS BIGINT) AS total FROM d),
s AS (SELECT *, CAST((2 * before + size) * {shards} // (2 * total) AS INTEGER) AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY before) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """A table of codebooks for each round: 0-based part, entry and place within the part."""
    steps = [f"""v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
w AS (SELECT max(len(x)) // {parts} AS w FROM v),
cells AS (SELECT vec_id, label, (i - 1) // w AS part, (i - 1) % w AS pos, x[i] AS x FROM (SELECT vec_id, label, x, w, unnest(range(1, len(x) + 1)) AS i FROM v, w)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}),
book0 AS (SELECT part, entry, pos, x AS c FROM cells JOIN first USING (vec_id))"""]  # fmt: skip
    for r in range(rounds + 1):
        steps.append(f"""far{r} AS MATERIALIZED (SELECT vec_id, label, part, entry, sum((x - c) * (x - c)) AS d FROM cells JOIN book{r} USING (part, pos) GROUP BY ALL),
code{r} AS MATERIALIZED (SELECT vec_id, label, part, entry, d FROM far{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)""")
        if r < rounds:
            steps.append(f"""mean{r} AS (SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM cells JOIN code{r} USING (vec_id, part) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN n IS NULL THEN c ELSE (s - (s % n + n) % n) // n END AS c FROM book{r} b LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT vec_id, label, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM code{rounds} GROUP BY 1, 2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256 FROM coded"""


def _trie_sql(group: int = 20, folds: int = 4) -> str:
    words = f"len(regexp_extract_all(text, '{_WORD}'))"
    return f"""WITH {_CRC_STEPS},
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % {group} AS base, {_crc_sql("CAST(c AS VARCHAR)")} % {folds} AS h FROM (SELECT DISTINCT c FROM t), crc),
lent AS (SELECT v.c, t.n, role, text FROM convs v JOIN t ON t.c = v.base AND t.n <= h),
turns AS (SELECT * FROM lent UNION ALL SELECT c, n + {folds}, role, text FROM t JOIN convs v USING (c) WHERE n > h),
path AS (SELECT c, row_number() OVER w AS depth, list(struct_pack(r := role, x := text)) OVER w AS p, {words} AS words, row_number() OVER w = count(*) OVER (PARTITION BY c) AS last
  FROM turns WINDOW w AS (PARTITION BY c ORDER BY n ROWS UNBOUNDED PRECEDING)),
steps AS (SELECT * FROM path UNION ALL SELECT c, 0, [], 0, NOT EXISTS (SELECT 1 FROM turns WHERE turns.c = convs.c) FROM convs),
nodes AS (SELECT depth, p, min(c) AS id, count(*) AS n, any_value(words) * (count(*) - 1) AS saved, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends FROM steps GROUP BY 1, 2),
ways AS (SELECT s.c, s.depth, k.id, k.n, k.saved, k.ends FROM steps s JOIN nodes k ON s.depth = k.depth AND s.p = k.p),
reps AS (SELECT w.*, up.id AS parent FROM ways w LEFT JOIN ways up ON up.c = w.c AND up.depth = w.depth - 1 WHERE w.c = w.id),
kids AS (SELECT parent AS id, depth - 1 AS depth, count(*) AS k FROM reps WHERE parent IS NOT NULL GROUP BY 1, 2),
full_ AS (SELECT r.*, coalesce(k, 0) AS k FROM reps r LEFT JOIN kids USING (id, depth)),
below AS (SELECT a.id, a.depth, sum(CAST(f.k = 0 AS INTEGER)) AS leaves, sum(f.saved) AS saved FROM full_ f JOIN ways a ON a.c = f.c AND a.depth <= f.depth GROUP BY 1, 2)
SELECT f.id AS conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent AS parent_conv_id, f.n AS n_convs, f.k AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256 FROM full_ f JOIN below b USING (id, depth)"""


#: The others follow tokenizers, trained models, positions of matches or searches, which SQL can't express.
ORACLE_SQL: dict[str, str] = {
    "op5_substring_dedup": _substring_sql(),
    "op6_embedding_dedup": _EMBEDDING_SQL,
    "op9_line_quality": _line_quality_sql(),
    "op11_prefix_trie": _trie_sql(),
    "op12_vector_codes": _codes_sql(),
    "op13_sharding": _sharding_sql(),
}
