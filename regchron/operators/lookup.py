"""Lookup join of records with one reference row per key, safe for keys with many records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regchron.sources.tables import estimated_bytes

_KEYLESS_SALTS = 1 << 20
# Bits of the records' keys: 1 MB. With a million keys they let about one in eight other rows through.
KEY_SLOTS = 1 << 23
# Bytes of the reference, as Spark estimates them, from which on it is reduced.
REDUCE_FROM = 4 << 30


def splits_skewed_joins(spark: SparkSession) -> bool:
    """Whether the session splits oversized join partitions at run time."""
    return all(
        spark.conf.get(name, "false").lower() == "true"
        for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def salted_left_join(
    records: DataFrame, reference: DataFrame, key: str, ref_key: str, rows_per_salt: int
) -> DataFrame:
    """Left join in which a key with many records is spread over several tasks.

    A key with n records gets ceil(n / rows_per_salt) salts: its records are dealt out over
    them and its one reference row is repeated for each. Only keys above ``rows_per_salt`` are
    salted, so the broadcast list has at most (number of records / rows_per_salt) rows of two
    numbers. The salt comes from the row and its input partition: a repeated task deals the
    same way, and copies of one row are spread as well.
    """
    hot = F.broadcast(
        records.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > rows_per_salt)
        .select(
            F.col(key).alias("_hot_key"),
            F.ceil(F.col("_n") / rows_per_salt).cast("long").alias("_salts"),
        )
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1).cast("long"))
    # Records without a key match nothing, wherever they go.
    dealt_salts = F.when(F.col(key).isNull(), F.lit(_KEYLESS_SALTS)).otherwise(salts)
    spread = F.xxhash64(*records.columns, F.spark_partition_id())
    dealt = (
        records.join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.pmod(spread, dealt_salts))
        .drop("_hot_key", "_salts")
    )
    repeated = (
        reference.join(hot, F.col(ref_key) == F.col("_hot_key"), "left")
        .withColumn("_ref_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        .drop("_hot_key", "_salts")
    )
    same = (F.col(key) == F.col(ref_key)) & (F.col("_salt") == F.col("_ref_salt"))
    return dealt.join(repeated, same, "left").drop("_salt", "_ref_salt")


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def key_bits(records: DataFrame, key: str, slots: int = KEY_SLOTS) -> DataFrame:
    """One row with an array of numbers, whose bits are set where a record's key falls: ``slots`` bits.

    Its size is fixed, however many records there are. Only the key column is read, and what is
    shuffled is one number per 64 slots and task.
    """
    slot = records.filter(F.col(key).isNotNull()).select(_slot(F.col(key), slots).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")
    )
    every = records.sparkSession.range(slots // 64).withColumnRenamed("id", "word")
    listed = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.join(words, "word", "left").agg(listed.getField("bits").alias("bits"))


def reduced_reference(
    reference: DataFrame, ref_key: str, records: DataFrame, key: str, slots: int = KEY_SLOTS
) -> DataFrame:
    """The reference rows whose key a record may have: all that match, and few others.

    The records' keys as bits are a scalar subquery of a filter on the reference, so the other
    rows go before the reference is shuffled.
    """
    slot = _slot(F.col(ref_key).cast(records.schema[key].dataType), slots)
    word = F.element_at(key_bits(records, key, slots).scalar(), (F.shiftright(slot, 6) + 1).cast("int"))
    return reference.filter(F.getbit(word, slot.bitwiseAND(63).cast("int")) == 1)


def reduces(reference: DataFrame) -> bool:
    """Whether the reference is so large that reading the records' keys once more pays."""
    return estimated_bytes(reference) >= REDUCE_FROM


def lookup_join(
    records: DataFrame,
    reference: DataFrame,
    key: str,
    ref_key: str,
    rows_per_salt: int = 1_000_000,
    salted: bool | None = None,
    reduce: bool | None = None,
) -> DataFrame:
    """Every record with the reference row of its key, or with NULLs.

    A large reference is first reduced to the keys that records may have (``reduce`` decides
    either way), as only the rows of few keys are wanted of it.

    No broadcast is forced: at run time Spark broadcasts the reference if its measured size is
    below the session's threshold, and otherwise splits partitions swollen by a frequent key
    (a left join may split its left side). A session without that gets the salted join;
    ``salted`` decides either way.
    """
    if reduces(reference) if reduce is None else reduce:
        reference = reduced_reference(reference, ref_key, records, key)
    if salted is None:
        salted = not splits_skewed_joins(records.sparkSession)
    if salted:
        return salted_left_join(records, reference, key, ref_key, rows_per_salt)
    return records.join(reference, F.col(key) == F.col(ref_key), "left")
