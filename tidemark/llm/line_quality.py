"""Quality rules that clean lines first.

Every line is judged by punctuation, navigation, link and boilerplate rules; failing lines are
removed, and a document that loses too much text is rejected.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, text_or_empty, words_col

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|>»•·"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
LONG_LINE_WORDS = 20  # a line of so many words has some punctuation
FRAGMENT_WORDS = 4  # a line of so few words that does not end as a sentence is a heading or an entry of a menu
BOILERPLATE_WORDS = 15  # a longer line fails by phrases only if they are a fifth of it

# What ends a sentence, with the quotes and brackets that may follow; addresses of links.
SENTENCE_END = r"[.!?:;…。！？；：؟؛।॥][\p{Pe}\p{Pf}\"'*_]*[ \t\n\x0b\f\r]*$"
LINK = r"https?://|www\."

# Phrases of site boilerplate and license lines.
BOILERPLATE = (
    "all rights reserved",
    "alle rechte vorbehalten",
    "click here",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "mentions légales",
    "politique de confidentialité",
    "privacy policy",
    "released under the",
    "sign up",
    "subscribe to",
    "terms of service",
    "terms of use",
    "todos los derechos reservados",
    "tous droits réservés",
)

_POSITION_BITS = 20  # of a packed (hash, position); texts of more words sort pairs instead


def _count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def line_fails(line: Column) -> Column:
    """Whether a line with a word fails: symbol noise, shouting, fragments, no punctuation at length, navigation, links, boilerplate."""
    words = F.size(words_col(line))
    symbols = _count_of(line, SYMBOLS)
    bangs = _count_of(line, "!")
    separators = _count_of(line, SEPARATORS)
    noise = (symbols >= 3) & (symbols * 3 >= words)
    shouting = (bangs >= 3) & (bangs * 2 >= words)
    navigation = (separators >= 3) & (words <= 4 * (separators + 1))
    fragment = ~line.rlike(SENTENCE_END) & (words <= FRAGMENT_WORDS)
    bare = ~line.rlike(r"\p{P}") & (words >= LONG_LINE_WORDS)
    links = (F.contains(line, F.lit("://")) | F.contains(line, F.lit("www."))) & line.rlike(LINK) & (F.size(F.split(line, LINK)) * 2 > words)
    phrases = F.lit("|".join(BOILERPLATE))
    low = F.lower(line)
    heavy = 5 * (F.char_length(line) - F.char_length(F.regexp_replace(low, phrases, F.lit("")))) >= F.char_length(line)
    boilerplate = F.rlike(low, phrases) & ((words <= BOILERPLATE_WORDS) | heavy)
    # Words are counted last, and only for the few lines with a reason to count them.
    return (line.rlike("[#*$%&|<>!»•·]") & (noise | shouting | navigation)) | fragment | bare | links | boilerplate


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the base counts, base_failed, kept, n_lines, n_lines_removed, cleaned.

    ``cleaned`` holds the lines left (lines without a word stay).  Words in repeated
    three-word windows are found by sorting the windows' 64-bit hashes inside the row, so
    a text of any length costs O(n log n) and nothing is shuffled.  Null and empty texts
    have no words, fail the base rule and keep an empty ``cleaned``; repeated rows and
    null ids are answered row by row; further columns are not read.
    """
    ws = F.lit(SPACE)
    t = docs.select(F.col(id_col), text_or_empty(text_col).alias("_t"))
    t = t.withColumns({"_w": words_col(F.col("_t")), "_l": F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, ws) != "")})
    t = t.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_g": F.expr("""CASE WHEN size(_w) >= 3
            THEN transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) ELSE array() END"""),
        "_bad": F.filter("_l", line_fails),
    })
    mask = (1 << _POSITION_BITS) - 1
    t = t.withColumn("_p", F.expr(f"""CASE WHEN size(_g) <= {mask}
        THEN transform(sort_array(transform(_g, (h, i) -> (h & ~{mask}L) | i)), p -> cast(p & {mask}L AS int))
        ELSE transform(array_sort(transform(_g, (h, i) -> struct(h, i))), s -> s.i) END"""))
    t = t.withColumn("_s", F.expr("""CASE WHEN size(_p) < 2 THEN array() ELSE
        sort_array(transform(filter(sequence(0, size(_p) - 1),
            k -> (k > 0 AND _g[_p[k]] = _g[_p[greatest(k - 1, 0)]]) OR (k < size(_p) - 1 AND _g[_p[k]] = _g[_p[least(k + 1, size(_p) - 1)]])),
            k -> _p[k])) END"""))
    t = t.withColumn("n_repeat_words", F.expr("""aggregate(_s, struct(0L AS n, -1 AS till),
        (a, s) -> struct(a.n + cast(s + 3 - greatest(s, a.till) AS bigint) AS n, s + 3 AS till), a -> a.n)"""))
    lost = F.char_length(F.translate(F.array_join("_bad", ""), SPACE, "")).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.array_join(F.filter(F.split("_t", "\n"), lambda x: (F.btrim(x, ws) == "") | ~line_fails(x)), "\n")
    return t.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * lost <= MAX_LOST_PERCENT * F.col("word_chars"))).alias("kept"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size("_bad").cast("long").alias("n_lines_removed"),
        left.alias("cleaned"),
    )
