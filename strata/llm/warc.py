"""A content-addressed web archive: payload bytes once, exact record headers beside them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import join_facts, settle

# The alphabet of RFC 4648 base 32, and the profile of a revisit record.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

STORE = "address string, packed binary"


def base32_of_hex(digest: Column) -> Column:
    """40 hexadecimal digits as 32 base-32 digits: each five of the former make four of the latter."""
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [value.as_py() or b"" for value in batch.column(0)]
        yield pa.record_batch(
            {
                "address": pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                "packed": pa.array([zlib.compress(p) for p in payloads], pa.binary()),
            }
        )


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of the records, held against the digest they are stored under."""
    for batch in batches:
        payloads = []
        for address, packed in zip(batch["address"], batch["packed"], strict=True):
            packed = packed.as_py()
            payload = None if packed is None else zlib.decompress(packed)
            if payload is None or hashlib.sha256(payload).hexdigest() != address.as_py():
                raise ValueError(f"payload {address} is missing or differs from its digest")
            payloads.append(payload)
        names = [name for name in batch.schema.names if name != "packed"]
        yield pa.record_batch(
            [*(batch[name] for name in names), pa.array(payloads, pa.binary())], [*names, "payload"]
        )


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archive(
    pages: DataFrame,
    folder: str,
    *,
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> str:
    """Write ``folder/payloads`` (each distinct payload once, by SHA-256) and ``folder/headers``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a
    response, the others revisit it. Payloads are deflated before they are shuffled, and copies are
    merged by a partial aggregate, so a payload that a third of all pages share moves once per task; what its pages
    have to know of it goes to them by broadcast.

    A NULL payload is an empty one, a NULL url an empty target; line ends within a url are
    percent-encoded. A NULL id sorts after all others. Rows that share the smallest id are all
    responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    store = pages.select(payload.alias("payload")).mapInArrow(_pack, STORE)
    store.groupBy("address").agg(F.first("packed").alias("packed")).write.parquet(f"{folder}/payloads")

    thin = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.sha2(payload, 256).alias("address"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    thin = settle(thin, "records")
    firsts = settle(thin.groupBy("address").agg(F.min("id").alias("first")), "first-records")
    known = join_facts(thin, firsts, "address")
    original = F.col("id").eqNullSafe(F.col("first")) | (F.col("bytes") < min_bytes)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(original, "response").otherwise("revisit")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _text_of("id"), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        F.when(original, "").otherwise(
            F.concat(
                _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), _text_of("first"), F.lit(">"))),
                _line("WARC-Profile", F.lit(REVISIT)),
            )
        ),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(original, F.col("bytes")).otherwise(0).cast("string")),
        F.lit("\r\n"),
    )
    known.select("address", header.alias("header")).write.parquet(f"{folder}/headers")
    return folder


def _text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _field(name: str, pattern: str) -> Column:
    """A header field; NULL where the header has none or an empty one."""
    found = F.regexp_extract("header", f"\\r\\n{name}: {pattern}\\r\\n", 1)
    return F.nullif(found, F.lit(""))


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """``id, record_type, url, digest, refers_to, length, address, header`` of every record."""
    return spark.read.parquet(f"{folder}/headers").select(
        _field("WARC-Record-ID", "<urn:page:([^>]*)>").cast("long").alias("id"),
        _field("WARC-Type", "(\\w+)").alias("record_type"),
        F.regexp_extract("header", "\r\nWARC-Target-URI: ([^\r]*)\r\n", 1).alias("url"),
        _field("WARC-Payload-Digest", "sha1:(\\w+)").alias("digest"),
        _field("WARC-Refers-To", "<urn:page:([^>]*)>").cast("long").alias("refers_to"),
        _field("Content-Length", "(\\d+)").cast("long").alias("length"),
        "address",
        "header",
    )


def read_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Response records as written: header, payload and ``record``, the two as one run of bytes.

    The payload comes from the store by its address and is checked against it; a payload that is
    missing or damaged fails the read.
    """
    records = read_headers(spark, folder).where("record_type = 'response'")
    store = spark.read.schema(STORE).parquet(f"{folder}/payloads")
    joined = records.join(store, "address", "left")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields if f.name != "packed"}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", payload binary"
    whole = joined.mapInArrow(_unpack, schema)
    end = F.lit("\r\n\r\n").cast("binary")
    return whole.withColumn("record", F.concat(F.col("header").cast("binary"), "payload", end))


def resolve(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with size and digest of its full payload, read back from the archive.

    Response records are rebuilt from header and payload; a revisit record takes size and digest from
    the rebuilt response with the same address, so no payload is copied for it. A digest that differs
    from the one in the record's header gives ``intact = false``. An empty archive gives no records.
    """
    rebuilt = read_responses(spark, folder).select(
        "address",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )
    facts = rebuilt.groupBy("address").agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    headers = read_headers(spark, folder).drop("header")
    return join_facts(headers, settle(facts, "payload-facts"), "address").select(
        "id",
        "url",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        F.coalesce(F.col("payload_digest") == F.col("digest"), F.lit(False)).alias("intact"),
    )
