"""Event keys: building them, and bringing differently written ones to one form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_key(key: Column) -> Column:
    """Binary form of a 64-hex-digit key however written (case, blanks, separators, a scheme prefix).

    Separators are dropped and the last 64 hex digits count. A text without 64 hex digits is not a
    key of that kind: it stands for itself, trimmed and in lower case. Null stays null.
    """
    plain = key.rlike(r"\A[0-9a-f]{64}\z")
    digits = F.when(plain, key).otherwise(F.regexp_replace(F.lower(key), "[^0-9a-f]", ""))
    hexed = F.substring(digits, -64, 64)
    return F.when(F.length(digits) >= 64, F.unhex(hexed)).otherwise(F.encode(F.lower(F.trim(key)), "UTF-8"))


def event_identity(key: Column, row_id: Column) -> Column:
    """canonical_key, or one identity per row where the key is null (such rows repeat nothing)."""
    return F.coalesce(canonical_key(key), F.encode(F.concat(F.lit("row:"), row_id.cast("string")), "UTF-8"))


def first_arrivals(rows: DataFrame, keep: list[str], key: str = "event_key", ingested: str = "ingestion_timestamp", row_id: str = "stage_row", identity: str | None = None) -> DataFrame:
    """One row per event, its first by (ingestion, row id), with the columns `keep` (and its identity, under that name if given).

    An aggregate, so copies are combined before the shuffle and a key that holds a third of all
    rows costs no task more than its share.
    """
    order = F.struct(F.col(ingested), F.col(row_id))
    first = rows.groupBy(event_identity(F.col(key), F.col(row_id)).alias("_event")).agg(
        F.min_by(F.struct(*[F.col(c) for c in keep]), order).alias("_first")
    )
    named = [F.col("_event").alias(identity)] if identity else []
    return first.select(*named, *[F.col(f"_first.{c}").alias(c) for c in keep])


def sieved(history: DataFrame, history_key: Column, batch: DataFrame, batch_key: Column, words: int = 1 << 17) -> DataFrame:
    """The rows of history whose key may be among the batch's, so that history is read but what is not concerned is not shuffled.

    The batch's keys set bits in a table of `words` words of 64 bits, which is broadcast: `words` rows at
    most, whatever the sizes (2 MB as it stands). A key sets one bit, so rows whose key is in the batch all stay, of
    the others about a share of keys / (64 * words), all of them for a batch far beyond that. Null keys go.
    """
    if words & (words - 1):
        raise ValueError("words must be a power of two")
    code = lambda key: F.xxhash64(F.lit(11), key)
    word = lambda c: F.shiftrightunsigned(c, 65 - words.bit_length())
    place = lambda c: c.bitwiseAND(63).cast("int")
    # No filter on the batch's key: one would go below an aggregate that the batch's other readers share.
    codes = batch.select(code(batch_key).alias("_code"))
    bits = codes.groupBy(word(F.col("_code")).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place(F.col("_code")))).alias("_bits"))
    coded = history.where(history_key.isNotNull()).withColumn("_code", code(history_key)).alias("_h")
    met = (word(F.col("_h._code")) == F.col("_b._word")) & (F.bit_get(F.col("_b._bits"), place(F.col("_h._code"))) == 1)
    return coded.join(F.broadcast(bits.alias("_b")), met, "left_semi").drop("_code")


def with_event_key(raw: DataFrame) -> DataFrame:
    """Adds event_key: sha256 of vehicle|vehicle time|trip, or with the feed time and entity if there is no vehicle time.

    Absent parts are written None, times as epoch seconds in vehicle_timestamp_raw / feed_timestamp_raw.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    has_time = F.coalesce(F.col("vehicle_timestamp_raw"), F.lit(0)) != 0
    by_vehicle = F.concat_ws("|", part("vehicle_id"), part("vehicle_timestamp_raw"), part("trip_id"))
    by_feed = F.concat_ws("|", part("vehicle_id"), part("feed_timestamp_raw"), part("trip_id"), part("entity_id"))
    return raw.withColumn("event_key", F.sha2(F.when(has_time, by_vehicle).otherwise(by_feed), 256))
