"""Quality rules, line first, with DataFrame functions only (operator 9).

Every line is judged alone: punctuation (a long line without any mark, or
overrun by symbols and exclamation marks), navigation (a menu of separated
entries) and boilerplate (licence, copyright, cookie and sign-in phrases). Lines
that fail are removed; a document that loses more than ``MAX_LOST`` percent of
its word characters is rejected, as is one that fails the base rules (too few
words, too many repeated three-word windows). Everything is computed inside the
row: no shuffle, and a document, however long, is one row's arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# plain settings of the rules
MIN_WORDS = 50
MAX_REPEAT = 50      # percent of the words in repeated three-word windows
MAX_LOST = 50        # percent of the word characters in removed lines
LONG_LINE = 12       # words from which a line needs some mark
MAX_SYMBOLS = 50     # symbols per 100 words of a line
MAX_BANGS = 50       # exclamation and question marks per 100 words of a line
MIN_ENTRIES = 3      # separators from which a line may be a menu
MENU = 25            # separators per 100 words of a menu

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = r"[.!?,;:…。！？、，；：؟،।]"
SEPARATORS = "[|»›•·]"
BOILERPLATE = (r"(?i)(all rights reserved|copyright \d|\(c\) \d|©|licensed under|released under the|"
               r"terms of (use|service)|privacy policy|cookie policy|use of cookies|accept (all )?cookies|"
               r"enable javascript|sign in|log in|subscribe (to|now)|share this|click here|read more)")


def _count(text: Column, chars: str) -> Column:
    """Characters of ``text`` in the regex class ``chars``."""
    return F.length(F.regexp_replace(text, "[^" + chars.strip("[]") + "]+", ""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def line_fails(line: Column) -> Column:
    """Whether one line fails a rule; a line without words never does."""
    words = F.length(F.regexp_replace(F.regexp_replace(line, r"[^\x20\x09-\x0D]+", "w"), SPACE, ""))

    def judged(n: Column) -> Column:
        punctuation = (((n >= LONG_LINE) & ~line.rlike(MARKS))
                       | (100 * _count(line, SYMBOLS) > MAX_SYMBOLS * n)
                       | (100 * _count(line, "!?") > MAX_BANGS * n) & (n >= MIN_ENTRIES))
        separators = _count(line, SEPARATORS)
        navigation = (separators >= MIN_ENTRIES) & (100 * separators >= MENU * n)
        # a phrase of boilerplate inside a long sentence or paragraph is mere mention
        boilerplate = (n <= 40) & line.rlike(BOILERPLATE)
        return (n > 0) & (punctuation | navigation | boilerplate)

    return F.element_at(F.transform(F.array(words), judged), 1)


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows found twice or more, the first included.

    Windows are compared by a 64-bit hash, sorted with their places; neighbours
    of one hash are repeats. (Two different windows of one text share a hash with
    probability n squared / 2 ** 65.)"""

    def places(w: Column) -> Column:
        runs = F.when(F.size(w) < 3, F.expr("cast(array() as array<int>)")).otherwise(
            F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))))
        hashed = F.sort_array(F.transform(runs, lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))
        return F.element_at(F.transform(F.array(hashed), repeated), 1)

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
                           F.lit(0), lambda s, x: s + x)

    at = F.element_at(F.transform(F.array(words), places), 1)
    return F.element_at(F.transform(F.array(at), covered), 1)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the base counts, ``base_failed``, ``cleaned`` (the text of the
    lines that pass), ``lost_chars`` and ``kept``.

    Null texts count as empty: no words, base rules failed. Repeated rows and
    null ids are returned as they come; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    parts = read.select("id", "t", words_of(F.col("t")).alias("w"), F.split("t", "\n").alias("l"))
    lines = F.filter("l", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = parts.select(
        "id", F.size("w").alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"),
        _count(F.col("t"), SYMBOLS).alias("n_symbols"),
        F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1).alias("n_dup_lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        F.array_join(F.filter("l", lambda x: ~line_fails(x)), "\n").alias("cleaned"))
    left = F.length(F.regexp_replace("cleaned", SPACE, ""))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    lost = F.col("word_chars") - left
    counted = parts.withColumns({"lost_chars": lost, "base_failed": base})
    return counted.select(
        F.col("id").alias(id_col), *[F.col(c).cast("long").alias(c) for c in
                                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", (~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST * F.col("word_chars"))).alias("kept"),
        F.col("lost_chars").cast("long").alias("lost_chars"), "cleaned")
