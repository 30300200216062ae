"""Quality rules, line first (operator 6): native DataFrame functions only.

Every line of a text is held against three kinds of rules; lines that fail are
removed, and a document that loses too much of its text is rejected.

* punctuation: symbol characters make up a tenth of the line or more, exclamation
  marks are as many as a third of its words, or fewer than three words end without
  a closing mark;
* navigation: a fifth of its words or more are menu separators;
* boilerplate: the line holds a notice phrase and at most ``NOTICE_WORDS`` words.

Everything runs inside one row (arrays of the row's own lines and words), so no
shuffle is needed and a hot source or a group of copies costs nothing extra.

Cases: a null or empty text has no lines, counts 0 and is not kept; repeated rows
are judged row by row; other columns pass through untouched; an empty table gives
an empty result.  The lines that stay come back in ``clean_text``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm.common import SPACE_WORD, let, space_words, table

# The symbols counted, menu separators, notice phrases.
SYMBOLS = "#*$%&|<>"
SEPARATORS = ["|", "||", "»", "«", "›", "‹", ">", ">>", "<", "<<", "·", "•", "/", "::"]
SEPARATOR_CHARS = "[|»«›‹><·•/:]"
NOTICES = ["accept cookies", "all rights reserved", "click here to", "cookie policy", "enable javascript",
           "privacy policy", "sign up for our newsletter", "terms of service", "terms of use", "use of cookies"]
CLOSERS = ".!?…:;\"'”’»)"

NOTICE_WORDS = 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_PERCENT = 50


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def _count_of(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _words_of(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(SPACE_WORD), F.lit(0))


def line_fails(line: Column) -> Column:
    """True if a line breaks a punctuation, navigation or boilerplate rule."""
    def judged(words: Column) -> Column:
        n = F.size(words)
        menu = F.when(line.rlike(SEPARATOR_CHARS), F.size(F.filter(words, lambda w: w.isin(SEPARATORS)))).otherwise(0)
        ends = F.substring(F.element_at(words, -1), -1, 1)
        notice = (n <= NOTICE_WORDS) & F.lower(line).rlike("|".join(NOTICES))
        # a rule of shares needs one hit at least: the cheap count decides for most lines
        return (let(_count_of(line, SYMBOLS), lambda c: (c > 0) & (c * 10 >= _word_chars(line)))
                | let(_count_of(line, "!"), lambda c: (c > 0) & (c * 3 >= n))
                | ((n < 3) & (F.instr(F.lit(CLOSERS), ends) == 0))
                | (menu * 5 >= n)
                | notice)
    return let(_words_of(line), judged)


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice."""
    def windows(w: Column) -> Column:
        tri = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                                             i.alias("p")))
        twins = let(F.sort_array(tri), lambda s: F.filter(
            s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))))
        covered = F.flatten(F.transform(twins, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
        return F.when(F.size(w) >= 4, F.size(F.array_distinct(covered))).otherwise(F.lit(0))
    return let(words, windows)


def line_quality(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS,
                 max_repeat_percent: int = MAX_REPEAT_PERCENT,
                 min_kept_percent: int = MIN_KEPT_PERCENT) -> DataFrame:
    """``docs`` with the counts, ``clean_text`` (lines that pass), ``base_failed`` and ``kept``.

    The added columns replace columns of the same name.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    facts = let(space_words(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    by_line = let(lines, lambda ls: let(F.transform(ls, line_fails), lambda bad: F.struct(
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        F.array_join(F.filter(ls, lambda x, i: ~F.get(bad, i)), "\n").alias("clean_text"),
        _word_chars(F.array_join(F.filter(ls, lambda x, i: F.get(bad, i)), "")).alias("lost_chars"))))
    d = (docs.withColumns({"_facts": facts, "_lines": by_line})
         .withColumns({"n_words": F.col("_facts.n_words"), "word_chars": _word_chars(t).cast("long"),
                       "n_symbols": _count_of(t, SYMBOLS).cast("long"),
                       "n_dup_lines": F.col("_lines.n_dup_lines"),
                       "n_repeat_words": F.col("_facts.n_repeat_words"),
                       "clean_text": F.col("_lines.clean_text"), "kept_chars": F.col("_lines.lost_chars")})
         .drop("_facts", "_lines")
         .withColumn("kept_chars", F.col("word_chars") - F.col("kept_chars")))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    return (d.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (100 * F.col("kept_chars") >= min_kept_percent * F.col("word_chars"))))


def keep_good(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the rows that pass, with the columns of ``docs`` and whole texts."""
    cols = docs.columns
    return line_quality(docs.select(F.col("text").alias("_text"), F.struct(*cols).alias("_row")), "_text") \
        .filter("kept").select("_row.*")


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                  "n_repeat_words", "base_failed", "kept", "kept_chars")


QUERIES = {"op6_line_quality": op6_line_quality}

_SEP_SQL = ", ".join(f"'{s}'" for s in SEPARATORS)
_CLOSERS_SQL = CLOSERS.replace("'", "''")
QUALITY_SQL = rf"""
SELECT {{cols}},
       n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, kept_chars,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       (NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
        AND 100 * kept_chars >= {MIN_KEPT_PERCENT} * word_chars) AS kept
FROM (
  SELECT *, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    (SELECT count(DISTINCT p + o) FROM (
       SELECT unnest(ps) AS p FROM (
         SELECT list(i) AS ps FROM (SELECT unnest(range(1, len(w) - 1)) AS i)
         GROUP BY w[i], w[i + 1], w[i + 2] HAVING count(*) > 1)) AS q, range(0, 3) AS r(o))::BIGINT AS n_repeat_words,
    coalesce(list_sum(list_transform(list_filter(ls, lambda x: NOT (
        length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) * 10 >= length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))
        OR length(regexp_replace(x, '[^!]+', '', 'g')) * 3 >= len(regexp_extract_all(x, '{SPACE_WORD}'))
        OR (len(regexp_extract_all(x, '{SPACE_WORD}')) < 3
            AND NOT contains('{_CLOSERS_SQL}', right(regexp_replace(x, '[\x20\x09-\x0D]+$', ''), 1)))
        OR len(list_filter(regexp_extract_all(x, '{SPACE_WORD}'), lambda y: list_contains([{_SEP_SQL}], y))) * 5
           >= len(regexp_extract_all(x, '{SPACE_WORD}'))
        OR (regexp_matches(lower(x), '{"|".join(NOTICES)}') AND len(regexp_extract_all(x, '{SPACE_WORD}')) <= {NOTICE_WORDS})
      )), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')))), 0)::BIGINT AS kept_chars
  FROM (
    SELECT *, regexp_extract_all(t, '{SPACE_WORD}') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM (SELECT *, coalesce(text, '') AS t FROM {{docs}}))
)"""

ORACLE = {"op6_line_quality": "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, "
                              "base_failed, kept, kept_chars FROM ("
                              + QUALITY_SQL.format(cols="doc_id", docs="documents") + ")"}
