"""Row selection: boxes, joins that keep, enrich or report rows, first-N, chosen targets."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from strata.functions.text import as_column, contains_any_case, quoted
from strata.session import stored
from strata.sources.lines import POSITION

# A side of a join is broadcast only if its bytes are known to stay within this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Tasks among which the rows of a table are thought to be dealt where one key has a large part of them.
SPREAD = 200
# Parts that a task's share of a heavy key's rows is cut into, as the parts fall on tasks at random.
PARTS_PER_SHARE = 16

# So many first rows are merged in one task.
FEW_ROWS = 10_000
# Bits of a row's number within its partition, in Spark's increasing ids.
ROW_BITS = 33

# Room for one value of a fixed size with its bookkeeping, and for one station row, whose text
# fields come from at most 71 characters.
VALUE_BYTES = 16
STATION_BYTES = 256


class Box(NamedTuple):
    """Inclusive bounds; the defaults are fixed values of the station selection."""

    lat_min: float = -11.0
    lat_max: float = 28.0
    lon_min: float = 90.0
    lon_max: float = 142.0



def in_box(df: DataFrame, box: Box, lat: str = "lat", lon: str = "lon") -> DataFrame:
    inside = F.col(lat).between(box.lat_min, box.lat_max)
    return df.where(inside & F.col(lon).between(box.lon_min, box.lon_max))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when there are no rows. Runs a job that stops at the first row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def keep_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``known``."""
    return join_spread(df, known.select(key).distinct(), key, "left_semi")


def keep_missing(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``known``; those without a key among them."""
    return join_spread(df, known.select(key).distinct(), key, "left_anti")


def heavy_keys(df: DataFrame, key: str, tasks: int = SPREAD) -> DataFrame:
    """``(key, _salts)``: keys with over their share of the rows when these are dealt to ``tasks`` tasks.

    ``_salts`` says in how many parts a key's rows should be dealt. There are fewer such keys than tasks, and
    at most ``2 * PARTS_PER_SHARE`` parts a task of all of them.
    """
    counts = stored(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar()
    salts = F.ceil(F.col("_n") * tasks * PARTS_PER_SHARE / F.nullif(total, F.lit(0)))
    return counts.where(F.col("_n") * tasks > total).select(key, salts.cast("int").alias("_salts")).dropna()


def join_spread(facts: DataFrame, keys: DataFrame, key: str, how: str, *, tasks: int = SPREAD) -> DataFrame:
    """Join ``facts`` with the rows of ``keys`` so that no key's rows have to meet in one task.

    ``keys`` is broadcast if its measured size allows it, and then the facts stay where they are. Beyond that the
    facts' keys are counted: those with more rows than a task's share are dealt to several tasks by a salt, and
    the rows of ``keys`` for them, few as such keys are, go to each of these. The other keys are shuffled as they
    are, and facts without a key by the salt alone. ``how`` is ``inner``, ``left_semi`` or ``left_anti``.
    """
    if measured_bytes(keys) <= MAX_BROADCAST_BYTES:
        return facts.join(F.broadcast(keys), key, how)
    heavy = F.broadcast(stored(heavy_keys(facts, key, tasks), "heavy-keys"))
    number = F.monotonically_increasing_id()
    salts = F.when(F.col(key).isNull(), tasks * PARTS_PER_SHARE).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = facts.withColumn("_number", number).join(heavy, key, "left")
    dealt = dealt.withColumn("_salt", F.pmod("_number", salts).cast("int")).drop("_number", "_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    spread = keys.join(heavy, key, "left").withColumn("_salt", copies).drop("_salts")
    return dealt.join(stored(spread, "spread-keys"), [key, "_salt"], how).drop("_salt")


def with_place(df: DataFrame, order: Sequence[str], name: str = "place") -> DataFrame:
    """Number the rows from 1 in an order without bringing them together in one task.

    The rows are sorted in ranges and written; a row's place is its number in its range and the count of rows in the
    ranges before, of which there is one for each task. Rows that tie get consecutive places in any order; as
    a range cannot part them, the last of ``order`` should tell rows apart. NULLs come first.
    """
    number = F.monotonically_increasing_id()
    ranged = stored(df.orderBy(*order).select("*", number.alias("_number")), "placed-rows")
    part = F.shiftright("_number", ROW_BITS)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_part", part).join(F.broadcast(starts), "_part")
    place = F.col("_before") + F.col("_number").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return placed.select(*[quoted(column) for column in df.columns], place.alias(name))


def first_rows(df: DataFrame, count: int, order: Sequence[str] = POSITION) -> DataFrame:
    """The first ``count`` rows in file order, or another one.

    Up to ``FEW_ROWS`` each task keeps its first ones and one task merges them. Beyond that rows are numbered
    by ``with_place``, and each task keeps those of its range that are among the first.
    """
    if count <= FEW_ROWS:
        return df.orderBy(*order).limit(count)
    return with_place(df, order, "_place").where(F.col("_place") <= count).drop("_place")


def last_row_per_key(df: DataFrame, key: str, order: Sequence[str] = POSITION) -> DataFrame:
    """One row per key, the last in file order. Aggregates before the shuffle."""
    others = [name for name in df.columns if name != key]
    latest = F.max_by(F.struct(*others), F.struct(*order)).alias("latest")
    return df.groupBy(key).agg(latest).select(key, "latest.*").select(*df.columns)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values from one aggregate over it."""
    sizes = F.lit(VALUE_BYTES * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if not isinstance(field.dataType, (NumericType, DatetimeType, BooleanType)):
            text = F.col(quoted(field.name)).cast("string")
            sizes = sizes + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(sizes), F.lit(0))).first()[0]


def small_side(df: DataFrame, *, proven_bytes: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its size allows it, else as it is.

    ``proven_bytes`` is a bound the caller knows, such as a ``limit`` on rows of bounded width;
    without it the table is measured, so a side that is costly to compute should be stored first.
    A larger side is shuffled with the other one, where adaptive execution splits the partition
    of a hot key.
    """
    size = measured_bytes(df) if proven_bytes is None else proven_bytes
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df


def attach(facts: DataFrame, attributes: DataFrame, fact_key: str, attribute_key: str) -> DataFrame:
    """Inner lookup: add the attributes of the row whose key equals the fact's key."""
    renamed = attributes.withColumnRenamed(attribute_key, "lookup_key")
    return facts.join(renamed, facts[fact_key] == renamed["lookup_key"]).drop("lookup_key")


def match_rank(name: Column, preferences: Sequence[str | Sequence[str]]) -> Column:
    """Index of the first preference the name contains; their count if it contains none.

    A preference of several parts asks for all of them.
    """
    rank = None
    for index, preference in enumerate(preferences):
        parts = [preference] if isinstance(preference, str) else list(preference)
        found = contains_any_case(name, parts[0])
        for part in parts[1:]:
            found = found & contains_any_case(name, part)
        rank = F.when(found, index) if rank is None else rank.when(found, index)
    none = F.lit(len(preferences))
    return none if rank is None else rank.otherwise(none)


def choose_match(
    df: DataFrame,
    column: str,
    preferences: Sequence[str | Sequence[str]],
    *,
    position: str | None = None,
    alias: str = "target",
) -> DataFrame:
    """One row: the best-ranked value of a column, NULL if there is none.

    Equal ranks go to the smallest ``position``, or without it to the smallest value. Rows are
    first reduced to distinct values, within each task before the shuffle, and only those are
    ranked: the filter on their count is there to keep that step in the plan. The single resulting
    row is used as ``choose_match(...).scalar()``.
    """
    name = F.col("name")
    named = df.select(F.col(column).alias("name"), F.col(position or column).alias("position"))
    named = named.where(name.isNotNull() & (name != ""))
    if position:
        values = named.groupBy("name").agg(F.min("position").alias("tie"))
    else:
        counted = named.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
        values = counted.where("rows > 0").withColumn("tie", name)
    best = F.min(F.struct(match_rank(name, preferences), F.col("tie"), name))
    return values.agg(best.getField("name").alias(alias))


def target_value(chosen: DataFrame | str) -> Column:
    """A chosen value, or one the caller fixed, as a column."""
    return F.lit(chosen) if isinstance(chosen, str) else chosen.scalar()


def required_target(chosen: DataFrame | str, message: str) -> Column:
    """``target_value`` that fails the job when nothing could be chosen."""
    return F.coalesce(target_value(chosen), F.raise_error(F.lit(message)).cast("string"))


def equals_target(df: DataFrame, column: Column | str, chosen: DataFrame | str) -> DataFrame:
    """Rows equal to the chosen value. Spark runs the choice first and pushes the value down."""
    return df.where(as_column(column) == target_value(chosen))
