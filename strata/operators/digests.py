"""Digests of files from digests of their parts, and trees of folder digests.

A file is a row of lines. Each line has a number modulo two primes, and a piece of a file the value of the
polynomial with these numbers as coefficients. Values of pieces, with their lengths, add up to the value of
the whole, in whatever pieces a file was read; so all tasks that read parts of one file share the work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stored as stored_table

# Two primes below 2**31, whose products fit a long, and a base for each.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525)
# Bits of a line's number within the partition that read it, in Spark's increasing ids.
INDEX_BITS = 33


def power(base: int, exponent: Column, prime: int) -> Column:
    """``base ** exponent`` modulo a prime, bit by bit of an exponent below ``2**INDEX_BITS``."""
    result = F.lit(1).cast("bigint")
    for bit in range(INDEX_BITS):
        factor = F.when(exponent.bitwiseAND(F.lit(1 << bit)) != 0, pow(base, 1 << bit, prime)).otherwise(1)
        result = result * factor % prime
    return result


def _moved(value: Column, base: int, exponent: Column, prime: int) -> Column:
    return value * power(base, exponent, prime) % prime


def pieces(lines: DataFrame) -> DataFrame:
    """``(dataset, file_path, block_start, lines, bytes, value_0, value_1)``, a row for each part of a file.

    ``lines`` are raw lines with their position. Reduced by the tasks that read them; a part is what was read
    as one split, so a file of any size gives one row per split.
    """
    index = F.col("row_id").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    terms = []
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        number = F.pmod(F.xxhash64(F.lit(k), "value"), F.lit(prime))
        terms.append(F.sum(_moved(number, base, index, prime)).alias(f"value_{k}"))
    summed = lines.groupBy("dataset", "file_path", "block_start").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.min(index).alias("first"),
        *terms,
    )
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        value = F.col(f"value_{k}") % prime
        summed = summed.withColumn(f"value_{k}", _moved(value, pow(base, -1, prime), F.col("first"), prime))
    return summed.drop("first")


def combined(parts: DataFrame) -> DataFrame:
    """``(dataset, path, lines, bytes, digest)`` of every file, from its parts in order.

    ``bytes`` counts a line end after every line, also where the last one has none.
    """
    before = Window.partitionBy("dataset", "file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    totals = [
        (F.sum(_moved(F.col(f"value_{k}"), base, F.col("before"), prime)) % prime).alias(f"value_{k}")
        for k, (prime, base) in enumerate(zip(PRIMES, BASES))
    ]
    summed = parts.groupBy("dataset", F.col("file_path").alias("path")).agg(
        F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"), *totals
    )
    digest = F.concat_ws("-", "lines", *[F.hex(f"value_{k}") for k in range(len(PRIMES))])
    return summed.select("dataset", "path", "lines", "bytes", digest.alias("digest"))


def file_digests(lines: DataFrame) -> DataFrame:
    return combined(pieces(lines))


def tree(files: DataFrame, path: str = "relative_path") -> DataFrame:
    """``(path, parent, depth, is_file, files, bytes, digest)`` of every file and of all folders above it.

    A folder's digest changes with the name or digest of any file below it. Every task first adds up its own
    files for each folder, so the root costs no more than other folders. Needs ``path``, ``length``, ``digest``.
    """
    full = F.concat(F.lit("/"), F.col(path))
    slashes = F.length(full) - F.length(F.replace(full, F.lit("/"), F.lit("")))
    content = [F.xxhash64(F.lit(k), full, "digest", "length") for k in range(2)]
    levels = F.sequence(F.lit(0).cast("bigint"), slashes.cast("bigint"))
    exploded = files.select(
        full.alias("full"), F.col("length"), *[c.alias(f"part_{k}") for k, c in enumerate(content)],
        slashes.alias("deepest"), F.explode(levels).alias("depth"),
    )
    place = F.when(F.col("depth") == 0, "").otherwise(F.expr("substring_index(full, '/', cast(depth AS int) + 1)"))
    nodes = exploded.withColumn("path", place).groupBy("path", "depth", (F.col("depth") == F.col("deepest")).alias("is_file"))
    nodes = nodes.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.concat_ws("-", *[F.hex(F.bit_xor(f"part_{k}")) for k in range(2)]).alias("digest"),
    )
    parent = F.when(F.col("depth") <= 1, "").otherwise(
        F.col("path").substr(F.lit(1), F.length("path") - F.length(F.substring_index("path", "/", -1)) - 1)
    )
    return nodes.withColumn("parent", F.when(F.col("depth") > 0, parent))


def differences(local: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(files, opened)``: files that differ between two trees, and the folders that were looked into.

    From the root downwards only folders whose digests differ are looked into, level by level. Files have
    ``path, local_bytes, stored_bytes, status``; the status is ``only_local``, ``only_stored``,
    ``size_differs`` or ``content_differs``.
    """
    spark = local.sparkSession
    known = ["path", "is_file"]
    opened = spark.createDataFrame([("",)], "path string")
    levels, found, depth = [opened], [], 0
    while not opened.isEmpty():
        depth += 1
        sides = []
        for side, nodes in (("local", local), ("stored", stored)):
            inside = nodes.where(F.col("depth") == depth).join(opened.select(F.col("path").alias("parent")), "parent", "left_semi")
            sides.append(inside.select(*known, F.col("bytes").alias(f"{side}_bytes"), F.col("digest").alias(f"{side}_digest")))
        both = sides[0].join(sides[1], known, "full_outer")
        both = both.where(~F.col("local_digest").eqNullSafe(F.col("stored_digest")))
        both = stored_table(both, "tree-level")
        found.append(both.where("is_file"))
        opened = both.where("not is_file").select("path")
        levels.append(opened)
    status = (
        F.when(F.col("stored_digest").isNull(), "only_local")
        .when(F.col("local_digest").isNull(), "only_stored")
        .when(F.col("local_bytes") != F.col("stored_bytes"), "size_differs")
        .otherwise("content_differs")
    )
    files = reduce(DataFrame.unionByName, found)
    files = files.select(F.substring("path", 2, 1_000_000).alias("path"), "local_bytes", "stored_bytes", status.alias("status"))
    return files, reduce(DataFrame.unionByName, levels)
