"""Daily records: one line per station, month and element with 31 slots of eight characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import date_from_parts, days_in_month
from strata.functions.text import between_positions, character_or_null, is_blank
from strata.functions.values import required, scaled, whole_number
from strata.sources.fixed_width import ELEMENTS

# Published layout of a daily line.
HEADER_WIDTH = 21
SLOT_WIDTH = 8
SLOTS = 31
MISSING_VALUE = -9999
VALUE_DIVISOR = 10.0

# Days that are cut from a line together.
BLOCK_DAYS = 8

_HEADER = {
    "station_id": (0, 11),
    "year_text": (11, 15),
    "month_text": (15, 17),
    "element": (17, 21),
}


def with_header(lines: DataFrame) -> DataFrame:
    """Lines with the fields of their header and the month's first day, NULL if there is none."""
    fields = {name: between_positions("value", *at) for name, at in _HEADER.items()}
    first_day = date_from_parts("year_text", "month_text")
    dated = F.when(F.col("year_text") != "0000", first_day)
    return lines.withColumns(fields).withColumn("first_day", dated)


def daily_headers(lines: DataFrame, elements: Sequence[str]) -> DataFrame:
    """Lines long enough to hold a header and of one of ``elements``, with their header."""
    long_enough = lines.where(F.length("value") >= HEADER_WIDTH)
    return with_header(long_enough).where(F.col("element").isin(list(elements)))


def explode_slots(
    headers: DataFrame, columns: Sequence[str], *, days: Column, skip_blank: bool = True
) -> DataFrame:
    """One row per day up to ``days`` with ``columns`` and the eight characters of its slot.

    A character of a string is found by walking from its start, so each line is first cut into
    blocks of eight days and then each short block into slots. Blank blocks go at once.
    """
    first_days = F.sequence(F.lit(1), F.lit(SLOTS), F.lit(BLOCK_DAYS))
    start = (F.col("block_day") - 1) * SLOT_WIDTH + HEADER_WIDTH + 1
    block = F.col("value").substr(start, F.lit(BLOCK_DAYS * SLOT_WIDTH))
    blocks = headers.select("value", *columns, F.explode(first_days).alias("block_day"))
    blocks = blocks.select(*columns, "block_day", block.alias("block"))
    if skip_blank:
        blocks = blocks.where(~is_blank("block"))
    offsets = F.sequence(F.lit(0), F.lit(BLOCK_DAYS - 1))
    slot = F.col("block").substr(F.col("offset") * SLOT_WIDTH + 1, F.lit(SLOT_WIDTH))
    slots = blocks.select(*columns, "block_day", "block", F.explode(offsets).alias("offset"))
    slots = slots.select(
        *columns, (F.col("block_day") + F.col("offset")).alias("day"), slot.alias("slot")
    )
    return slots.where(F.col("day") <= days)


def slot_fields() -> dict[str, Column]:
    """The parts of a slot: the value's text as it stands, and three flags, blank as NULL."""
    return {
        "value_text": F.substring("slot", 1, 5),
        "mflag": character_or_null("slot", 5),
        "qflag": character_or_null("slot", 6),
        "sflag": character_or_null("slot", 7),
    }


def decode_daily_lines(
    lines: DataFrame,
    elements: Sequence[str] = ELEMENTS,
    *,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """One row per slot that holds a usable value, with the columns in ``keep`` carried along.

    Dropped are short lines, other elements, blank and missing slots, slots with a quality flag
    and days the month does not have. The month's first day is parsed once per line and only
    days that exist are looked at. Malformed numbers are dropped too; with ``strict`` they fail
    the job.
    """
    headers = daily_headers(lines, elements)
    if strict:
        bad_header = whole_number("year_text").isNull() | whole_number("month_text").isNull()
        checked = required(F.col("first_day"), bad_header, "malformed year or month")
        headers = headers.withColumn("first_day", checked)
    existing = headers.where(F.col("first_day").isNotNull())
    columns = ["station_id", "element", "first_day", *keep]
    slots = explode_slots(existing, columns, days=days_in_month(F.col("first_day")))
    # Most slots are blank, so the cheapest test for that comes first.
    # Exploded by itself, a text is cut and a number read once; a filter would do it again for each use.
    fields = slot_fields()
    text = F.explode(F.array(fields.pop("value_text"))).alias("value_text")
    slots = slots.select("*", text).where(F.trim("value_text") != "").withColumns(fields)
    tenths = whole_number("value_text")
    if strict:
        malformed = tenths.isNull() & ~is_blank("value_text")
        tenths = required(tenths, malformed, "malformed slot value")
    known = slots.select("*", F.explode(F.array(tenths)).alias("tenths")).where(F.col("tenths") != MISSING_VALUE)
    usable = known.where(F.col("qflag").isNull())
    return usable.select(
        "station_id",
        F.date_add("first_day", F.col("day") - 1).alias("date"),
        "element",
        scaled("tenths", VALUE_DIVISOR).alias("value"),
        *keep,
        "mflag",
        "qflag",
        "sflag",
    )


# What can become of a slot, in the order in which reasons are looked for.
OUTCOMES = ("bad_month", "blank", "missing", "flagged", "impossible_day", "malformed", "kept")


def count_slots(lines: DataFrame, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """One row of counts: lines and slots that ``decode_daily_lines`` keeps or drops, and why.

    A slot is counted once, under the first of ``OUTCOMES`` that applies. All counts come from
    one pass over the lines; a line without wanted slots stands in it with its first slot only.
    """
    short = F.length("value") < HEADER_WIDTH
    wanted = ~short & F.col("element").isin(list(elements))
    headers = with_header(lines).withColumns({"short": short, "wanted": wanted})
    slots = explode_slots(
        headers,
        ["first_day", "short", "wanted"],
        days=F.when(F.col("wanted"), SLOTS).otherwise(1),
        skip_blank=False,
    ).withColumns(slot_fields())
    tenths = whole_number("value_text")
    outcome = (
        F.when(~F.col("wanted"), "line")
        .when(F.col("first_day").isNull(), "bad_month")
        .when(is_blank("value_text"), "blank")
        .when(tenths == MISSING_VALUE, "missing")
        .when(F.col("qflag").isNotNull(), "flagged")
        .when(F.col("day") > days_in_month(F.col("first_day")), "impossible_day")
        .when(tenths.isNull(), "malformed")
        .otherwise("kept")
    )
    outcomes = slots.select("day", "short", "wanted", outcome.alias("outcome"))
    return outcomes.agg(
        F.count_if(F.col("day") == 1).alias("lines"),
        F.count_if(F.col("short")).alias("short_lines"),
        F.count_if(~F.col("short") & ~F.col("wanted")).alias("other_lines"),
        *[F.count_if(F.col("outcome") == name).alias(f"{name}_slots") for name in OUTCOMES],
    )
