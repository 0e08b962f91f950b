"""Document fingerprints by threshold-scaled sketches.

A text's shingles are its runs of five words (fewer words: all of them as one).
Every shingle hash below a fixed fraction of the hash range is kept, however
many there are, so a sketch grows with its text; two sketches compare what both
hold below the threshold, and containment estimates stay right where one text
is far longer. The union of two sketches is the sketch of the joined shingle
sets. The least hash is kept in any case, so that a short text has a
fingerprint too; it merges by the same rule.

Nulls count as empty texts. A text without words has the empty fingerprint,
equal to another empty one (1.0) and unlike any other (0.0). Equal texts have
equal fingerprints.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

WORDS = 5
#: One hash in so many is kept.
SCALE = 8


def shingles(words: Column, k: int = WORDS) -> Column:
    """Hashes of the runs of ``k`` words; of all of them if they are fewer."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - k),
                       lambda i: F.xxhash64(*[words[i + j] for j in range(k)]))
    return F.when(F.size(words) >= k, runs).when(
        F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(
        F.array().cast("array<bigint>"))


def below(hashes: Column, scale: int = SCALE) -> Column:
    """The sorted, distinct hashes in the lowest 1/scale of the range, and the least."""
    limit = -(2 ** 63) + 2 ** 64 // scale
    kept = F.filter(hashes, lambda h: h < F.lit(limit))
    return F.array_sort(F.array_distinct(F.when(F.size(kept) > 0, kept).when(
        F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(kept)))


def with_sketch(df: DataFrame, text: str, into: str, k: int = WORDS,
                scale: int = SCALE) -> DataFrame:
    """``df`` with the array ``into`` of kept hashes."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x09-\x0D ]+"),
                     lambda w: w != "")
    return (df.withColumn("_words", words)
            .withColumn("_hashes", shingles(F.col("_words"), k))
            .withColumn(into, below(F.col("_hashes"), scale))
            .drop("_words", "_hashes"))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other one has."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(
        (F.size(a) == F.size(b)).cast("double"))


def as_string(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), " ")


def with_next(docs: DataFrame, key: str, text: str, share: int = 4) -> DataFrame:
    """Columns ``key``, ``text``, and of the next row by ``key``: ``next_start`` and
    ``next_sketch``.

    ``next_start`` is the start of the next text, of n // share code points at
    most, n being the length of the row's own text. The last row is followed by
    the first. Rows with the same key follow each other by a hash of their
    texts; rows with equal key and text count as one in the order and are all
    returned. A null key comes first, a null text counts as empty.

    Only keys and hashes are ordered: range partitions of them are stored, each
    row finds the next one in its partition, and the last one of a partition
    takes the first of the following one. Texts are then shuffled once, for both
    joins; sketches are made behind the shuffle, so that both read the same one.
    """
    kind = dict(docs.dtypes)[key]
    # Three columns that are never null stand for key and text.
    rows = docs.select(F.col(key).isNotNull().alias("_z"),
                       F.coalesce(F.col(key), F.lit(0).cast(kind)).alias("_k"),
                       F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.select("_z", "_k", F.xxhash64("_t").alias("_h"), "_t")
    own = ["_z", "_k", "_h"]
    slim = rows.select(*own, F.floor(F.length("_t") / share).cast("int").alias("_need"))
    slim, _ = stored(slim.dropDuplicates(own).repartitionByRange(*own)
                     .withColumn("_part", F.spark_partition_id()), "order")
    this = F.struct(*own)
    # One row per partition of the stored table.
    parts = slim.groupBy("_part").agg(F.min(this).alias("_first"))
    parts = parts.select("_part", F.coalesce(
        F.lead("_first").over(Window.orderBy("_part")),
        F.min("_first").over(Window.partitionBy())).alias("_then"))
    order = Window.partitionBy("_part").orderBy(*own)
    linked = (slim.withColumn("_next", F.lead(this).over(order)).join(parts, "_part")
              .select(*[F.col(c).alias(f"_to{c}") for c in own], "_need",
                      F.coalesce("_next", "_then").alias("_next"))
              .select("*", *[F.col(f"_next.{c}").alias(c) for c in own]).drop("_next"))
    after = with_sketch(linked.join(rows, own), "_t", "next_sketch")
    after = (after.select(*[F.col(f"_to{c}").alias(c) for c in own],
                          F.expr("substring(_t, 1, _need)").alias("next_start"), "next_sketch")
             .dropDuplicates(own))
    return rows.join(after, own).select(
        F.when(F.col("_z"), F.col("_k")).alias(key), F.col("_t").alias(text),
        "next_start", "next_sketch")
