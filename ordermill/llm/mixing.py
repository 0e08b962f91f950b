"""Mixing sources to target weights by repeating documents.

Sizes are added up per source; the targets share a total by weight, none of them
above ``most`` times its source's size, and what one cannot take is shared anew
by the others' weights. A source's rate is its target over its size, and each of
its documents is taken floor(rate) times, plus once more with a probability
equal to the fraction: a hash of its key, seeded, below the fraction. Rates are
at most ``most``, so no document is taken more often than ceil(most) times.

A document's copies depend on its key and its source's rate alone, so a rerun
takes the same ones; each source's taken size is its target on average, and the
more documents it has the nearer.

Nulls: a null source is a source of its own, a null size counts as 0, a null key
hashes as the text ``null``. Documents of size 0 are taken like others. A source
of size 0 has target and rate 0 and gives nothing. Equal rows are taken equally
often. An empty table gives an empty mix. Other columns stay; one with the name
of a result column is replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rendezvous import hash52
from .tables import size_checked, stored, unused

SHARE = 1.5
MOST = 2.0
SALT = "mix"


def words(text: Column) -> Column:
    """Number of runs of anything but blanks, tabs and line ends; 0 of null."""
    runs = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.coalesce(F.size(runs), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, source: str, size: str) -> DataFrame:
    """``source`` and ``source_size``; added up before the shuffle, one row a source and task."""
    return docs.groupBy(source).agg(
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("source_size"))


def with_rank(sources: DataFrame, source: str) -> DataFrame:
    """Place ``rank`` of each source by code point from 0, null last.

    Range partitions are numbered each by itself and shifted by the counts of
    those before, so no task sees all sources.
    """
    null = F.col(source).isNull()
    parts, _ = stored(sources.repartitionByRange(null, source)
                      .withColumn("_part", F.spark_partition_id()), "source-ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range partition.
    base = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy(null, source)
    return (parts.withColumn("_row", F.row_number().over(within) - 1)
            .join(base, "_part").withColumn("rank", F.col("_base") + F.col("_row"))
            .select(*sources.columns, "rank"))


def with_target(sources: DataFrame, weight: str, share: float = SHARE,
                most: float = MOST) -> DataFrame:
    """``sources`` (a stored table with ``source_size``) and each one's ``target``.

    Every round shares what the full sources leave among the others by weight;
    those whose part reaches ``most`` times their size are full from then on, as
    what a unit of weight gets only rises. A round is one aggregate over the
    sources.
    """
    cap = F.col("source_size") * F.lit(float(most))
    level, held = -1.0, -1
    while True:
        full = cap <= F.lit(level) * F.col(weight)
        t = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col(weight).cast("double"))),
                       F.lit(0.0)).alias("weights"),
            F.count(F.when(full, 1)).alias("n")).first()
        if t["n"] == held or not t["weights"]:
            break
        held = t["n"]
        level = max(level, 0.0, (share * t["all"] - t["taken"]) / t["weights"])
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col(weight)))


def copies(key: Column, rate: Column, salt: str = SALT) -> Column:
    """floor(rate), and one more where the key's hash is below the fraction."""
    u = (hash52(F.lit(salt), key) + F.lit(0.5)) / F.lit(2.0 ** 52)
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("long")


def with_copies(docs: DataFrame, key: str, source: str, sources: DataFrame, path: str,
                salt: str = SALT) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and the number of ``copies`` of each.

    ``sources`` was stored under ``path``; it is broadcast only if its files are
    small, else joined by a shuffle that splits hot sources.
    """
    of, facts = unused(docs.columns, "_of"), unused(docs.columns, "_facts")
    known = size_checked(sources, path).select(
        F.col(source).alias(of), F.struct("source_size", "target").alias(facts))
    joined = docs.join(known, F.col(source).eqNullSafe(F.col(of)), "left")
    total, target = F.col(f"{facts}.source_size"), F.col(f"{facts}.target")
    rate = F.when(total > 0, target / total).otherwise(0.0)
    return joined.withColumns({"source_size": total, "target": target, "copies": copies(
        F.col(key), rate, salt)}).drop(of, facts)


def repeated(placed: DataFrame, count: str = "copies", number: str = "copy") -> DataFrame:
    """Each row ``copies`` times, numbered from 1; rows with none are gone."""
    return (placed.filter(F.col(count) > 0)
            .withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count)))))


def mixed(docs: DataFrame, key: str, source: str, size: str, weights,
          share: float = SHARE, most: float = MOST, salt: str = SALT) -> DataFrame:
    """``docs`` (a stored table) with ``source_size``, ``target`` and ``copies``;
    ``repeated`` makes the mix of it. ``weights`` gives a source's weight from a
    column of its rank."""
    ranked = with_rank(source_sizes(docs, source, size), source)
    weighted, _ = stored(ranked.withColumn("_weight", weights(F.col("rank"))), "source-weights")
    targets, path = stored(with_target(weighted, "_weight", share, most), "source-targets")
    return with_copies(docs, key, source, targets, path, salt)
