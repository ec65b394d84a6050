"""Line-first cleaning: rules per line, then reject documents that lose too much text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

# Labels of site menus and phrases of site furniture, matched without case.
MENU = (
    "home|about( us)?|contact( us)?|login|log in|sign in|sign up|menu|search|faq|help|next|previous|"
    "sitemap|archive|blog|news|products|services|register|cart|account"
)
FURNITURE = (
    "accept (all )?cookies|we use cookies|cookie policy|privacy policy|terms of (use|service)|"
    "all rights reserved|enable javascript|subscribe to our newsletter|sign up for our newsletter|"
    "click here to|back to top|skip to (main )?content|follow us on"
)
SEPARATOR = "[|/»>·•]"


def words_of(text: Column) -> Column:
    """Runs of characters other than space, tab and the line breaks 0A to 0D."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def with_repeat_count(df: DataFrame, words: str, name: str) -> DataFrame:
    """Add ``name``: words of the array ``words`` in an 8-word window found twice or more in it.

    Windows are compared as hashes over the hashes of their words. Only a text that has equal windows
    is sorted by hash; its repeated windows, put back in order of place, each cover the words that
    the one before does not.
    """
    window = ", ".join(f"get(_hashes, i + {k})" for k in range(WINDOW))
    steps = {
        "_hashes": f"transform({words}, w -> xxhash64(w))",
        "_windows": f"if(size(_hashes) < {WINDOW}, cast(array() AS array<bigint>),"
        f" transform(sequence(0, greatest(size(_hashes) - {WINDOW}, 0)), i -> xxhash64({window})))",
        "_sorted": "if(size(array_distinct(_windows)) < size(_windows),"
        " sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i))), NULL)",
        "_starts": "array_sort(filter(transform(_sorted, (x, k) ->"
        " if(x.h <=> get(_sorted, k - 1).h OR x.h <=> get(_sorted, k + 1).h, x.i, -1)), i -> i >= 0))",
        name: f"coalesce(aggregate(_starts, struct(-{WINDOW} AS last, 0L AS n), (a, i) ->"
        f" struct(i AS last, a.n + least({WINDOW}, i - a.last) AS n), a -> a.n), 0L)",
    }
    for column, sql in steps.items():
        df = df.withColumn(column, F.expr(sql))
    return df.drop("_hashes", "_windows", "_sorted", "_starts")


def nothing_but_labels(line: Column) -> Column:
    """Two menu labels or more, each with separators or blanks behind it, and nothing else but leading blanks.

    No label begins another, so taking them out from left to right leaves nothing but the leading blanks. A
    pattern for the whole line would need a repeated group, which Java matches by recursion: a line of some
    thousand labels would use up the stack.
    """
    label = F.lit(f"(?i)({MENU})[{SPACE}|/»>·•,-]*")
    rest = F.regexp_replace(line, label, F.lit(""))
    return line.rlike(f"(?i)^[{SPACE}]*({MENU})") & ~rest.rlike(f"[^{SPACE}]") & (F.regexp_count(line, label) >= 2)


ROW = "_row"


def judge(
    docs: DataFrame,
    *,
    with_row: bool = False,
    max_mark_share: float = 0.2,
    max_separator_share: float = 0.3,
    min_line_words: int = 3,
    max_furniture_words: int = 30,
    max_lost: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Measure and clean every document; ``kept`` tells which are good enough.

    Every line with a word is held against three rules and taken out when it fails one:

    * punctuation: over ``max_mark_share`` of its characters are neither letters, digits nor blanks,
      or it has under ``min_line_words`` words and no mark at its end,
    * navigation: over ``max_separator_share`` separators a word, or nothing but menu labels,
    * boilerplate: a phrase of site furniture in it.

    A phrase counts only in a line of at most ``max_furniture_words`` words.

    A document is rejected when it fails the base rules (under 20 words, or over 30 % of its words in
    repeated 8-word windows) or when the lines taken out hold over ``max_lost`` of its words.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines_removed,
    n_words_removed, cleaned, kept`` to ``doc_id``. A NULL text counts as empty and is rejected; a row
    that occurs twice is judged twice; an empty table gives no rows. Other columns are passed on only
    ``with_row``, as fields of the struct ``_row``.
    """
    text = text_or_empty(text_col)
    keep = ["doc_id", ROW] if with_row else ["doc_id"]
    row = [F.struct("*").alias(ROW)] if with_row else []
    df = docs.select(F.col(id_col).alias("doc_id"), *row, text.alias("text"))
    df = df.withColumn("words", words_of(F.col("text")))
    df = df.select(
        *keep,
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.split("text", "\n").alias("lines"),
    )
    df = with_repeat_count(df, "words", "n_repeat_words").drop("words")
    has_word = f"[^{SPACE}]"
    df = df.withColumn("worded", F.filter("lines", lambda line: line.rlike(has_word)))
    df = df.withColumn(
        "n_dup_lines", (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long")
    )

    def verdict(line: Column) -> Column:
        words = F.regexp_count(line, F.lit(f"[^{SPACE}]+"))
        marks = F.regexp_count(line, F.lit(f"[^\\p{{L}}\\p{{M}}\\p{{N}}{SPACE}]"))
        separators = F.regexp_count(line, F.lit(SEPARATOR))
        return F.struct(
            words.alias("words"),
            marks.alias("marks"),
            separators.alias("separators"),
            F.length(line).alias("chars"),
            line.alias("line"),
        )

    def fails(x: Column) -> Column:
        line = x["line"]
        open_end = ~line.rlike(f"\\p{{P}}[{SPACE}]*$")
        return (x["words"] > 0) & (
            (x["marks"] > x["chars"] * max_mark_share)
            | ((x["words"] < min_line_words) & open_end)
            | (x["separators"] > x["words"] * max_separator_share)
            | nothing_but_labels(line)
            | ((x["words"] <= max_furniture_words) & line.rlike(f"(?i)({FURNITURE})"))
        )

    df = df.withColumn("measured", F.transform("lines", verdict))
    df = df.withColumn(
        "checked",
        F.transform("measured", lambda x: F.struct(x["line"].alias("line"), x["words"].alias("words"), fails(x).alias("failed"))),
    )
    df = df.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        F.size(F.filter("checked", lambda x: x["failed"])).cast("long").alias("n_lines_removed"),
        F.aggregate(
            F.filter("checked", lambda x: x["failed"]), F.lit(0).cast("long"), lambda n, x: n + x["words"]
        ).alias("n_words_removed"),
        F.array_join(
            F.transform(F.filter("checked", lambda x: ~x["failed"]), lambda x: x["line"]), "\n"
        ).alias("cleaned"),
    )
    enough = F.col("n_words_removed") <= F.col("n_words") * max_lost
    return df.withColumn("kept", ~F.col("base_failed") & enough)


def clean(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents that ``judge`` keeps, in the columns of ``docs``, without the failed lines.

    The row number keeps the filter above the arrays: pushed below them, it would write each array's
    expression out at every place that uses it.
    """
    judged = judge(docs, with_row=True, text_col=text_col, **options)
    numbered = judged.withColumn("_number", F.monotonically_increasing_id())
    judged = numbered.where((F.col("_number") >= 0) & F.col("kept"))
    columns = [F.col("cleaned").alias(c) if c == text_col else F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns]
    return judged.select(*columns)
