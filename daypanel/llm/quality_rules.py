"""Line-first cleaning: rules per line, then a verdict on what is left. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import WORD

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: A line that ends so is a sentence.
SENTENCE_END = r"[.!?…:;\"'”»)\]。！？][\x20\x09-\x0D]*$"
INNER_END = r"[.!?…。！？][\x20\x09-\x0D]"
#: Fixed phrases of boilerplate lines.
BOILERPLATE = (
    r"(?i)(licensed under|all rights reserved|general public license|cookie policy|use cookies|privacy policy|terms of (use|service)|enable javascript"
    r"|lorem ipsum|click here|sign (in|up) |log in |subscribe to|share this|read more$|skip to content|back to top)"
)
WINDOW = 8


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight words found twice or more in the same array, the first find included.

    A window is known by the hash of its words' hashes; windows sort by hash, so equal ones are neighbours.
    """
    n = F.size(words)

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
        return F.sort_array(F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(hashes, i, WINDOW)).alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            return F.get(ordered, k - 1)["h"].eqNullSafe(x["h"]) | F.get(ordered, k + 1)["h"].eqNullSafe(x["h"])

        return F.sort_array(F.transform(F.filter(ordered, twice), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        nothing = F.lit(0).cast("long")
        return F.aggregate(
            F.transform(at, lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)).cast("long")), nothing, lambda s, x: s + x
        )

    found = _bound(_bound(_bound(F.transform(words, lambda w: F.xxhash64(w)), windows), starts), covered)
    return F.when(n > WINDOW, found).otherwise(F.lit(0).cast("long"))


def line_fails(line: Column, words: Column) -> Column:
    """Whether a line of so many words is removed: no sentence, navigation or symbols, shouting, or boilerplate."""
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    no_sentence = ~line.rlike(SENTENCE_END) & ((words < 10) | ~line.rlike(INNER_END))
    shouts = F.regexp_count(line, F.lit(r"!!+([\x20\x09-\x0D]|$)"))
    return no_sentence | (symbols * 5 > words) | (shouts * 2 > words) | line.rlike(BOILERPLATE)


def clean_lines(docs: DataFrame, least_share: float = 0.5, least_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """Line-first verdicts on documents.

    Takes ``doc_id`` and ``text``; returns per row ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``n_kept_words`` (words on lines that pass) and ``cleaned``, the
    text without failing lines. A document is kept if it doesn't fail the base rules and at least ``least_share`` of its words
    are on lines that pass. Null and blank texts have zeros, fail the base and clean to an empty text.
    Repeated rows come back as often; extra columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "text", F.filter(F.split("text", "\n"), lambda x: F.length(_without(x, SPACES)) > 0).alias("lines"),
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
    )
    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(_without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeated_words(F.col("words")).alias("n_repeat_words"),
        F.filter(F.transform("lines", lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n"))), lambda x: ~line_fails(x["line"], x["n"])).alias("passing"),
    )
    rows = rows.withColumns({
        "n_kept_words": F.aggregate("passing", F.lit(0).cast("long"), lambda s, x: s + x["n"]),
        "base_failed": (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")),
    })
    kept = ~F.col("base_failed") & (F.col("n_kept_words") >= least_share * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "n_kept_words",
        F.array_join(F.transform("passing", lambda x: x["line"]), "\n").alias("cleaned"),
    )
