"""MinHash near-dedup with an LSH forest.

Two texts are linked if the Jaccard similarity of their sets of word shingles
reaches the threshold; linked texts form components.

1. Every text gets its shingle set, 64 minima over it, and a 128-bit digest of
   the set. Texts with equal sets are one *node* from here on, so copies cost
   nothing however many there are.
2. The forest: 32 orders of the minima. In each order all nodes are sorted by eight
   minima, then by name (range partitions, so a region of any size is split). Nodes
   that agree in the first four minima of an order lie in one *region*; two texts of
   similarity 0.8 share none of 32 regions with a probability of about 1e-6. Nodes
   without company in any region go, and then those with so many shingles of their
   own that they can reach the threshold with no text.
3. The forest again, of the nodes that are left. Regions with nodes in common form
   *clusters*, and each cluster has a *hub*: the shingles that more than half of its
   nodes have. A node is from here on its difference from the hub, d. For sets A and
   B of a cluster, whatever its hub, the differing shingles number |dA| + |dB| less
   twice what dA and dB have in common; so a link is confirmed on the differences
   exactly as on the full sets.
4. Candidates: in each order the neighbour with the longest common prefix, as deep as
   that place of the forest goes, and the region's least node. Of these the two that
   a node meets in most orders are confirmed.
5. Every node so near to the hub that it and the cluster's nearest one are linked
   whatever their differences have in common is linked with that one. Components are
   formed.
6. Pairs of a cluster that are still in different components need differences in
   common, so they meet in an exact prefix filter with places over these, rare ones
   first, and are confirmed.

No list of candidates is cut. Two nodes that share a region are compared exactly or
are in one component already. The pairs of step 6 are those that share a rare
difference from what the cluster has in common; a crowd that falls just short of the
threshold has few of them, but their number has no bound of its own.

Words are what stands between ASCII white space, with A-Z lower-cased. Fewer
words than a shingle has are one shingle. A null text or one without words has
an empty set: it is linked with nothing and stays. Rows with equal ids are kept
apart by their sets. A null id never names a component that has other ids.
Shingles count as equal if 64-bit hashes agree, differences if 58 bits do.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .collocations import BITS, bit_map
from .hotcache import frugal
from .tables import bucketed, size_checked, stored, unused

MINIMA = 64
ORDERS = 32
DEPTH = 8
CONFIRMED = 2
_RNG = np.random.default_rng(20_011)
_FACTORS = _RNG.integers(1, 2 ** 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RNG.integers(0, 2 ** 63, MINIMA, dtype=np.uint64)
#: The minima of each order, in its order.
_ORDER = np.stack([_RNG.permutation(MINIMA)[:DEPTH] for _ in range(ORDERS)])


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs = max(1, len(words) - k + 1)
    mixed = np.full(runs, min(k, len(words)), np.uint64)
    for j in range(min(k, len(words))):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        mixed += hashes[j:j + runs]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def minima(shingles: np.ndarray) -> np.ndarray:
    """16 bits of each of the least values under 64 hash functions."""
    least = np.full(MINIMA, ~np.uint64(0))
    for at in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[at:at + 2048, None] * _FACTORS + _ADDENDS).min(axis=0),
                   out=least)
    return (least >> np.uint64(20)).astype(np.uint16)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """Per row: ``key``, ``n`` (set size), ``node`` (null if empty) and ``sig``."""
    kind = dict(docs.dtypes)[key]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), k) for t in batch[text]]
            yield pa.RecordBatch.from_arrays(
                [batch[key], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([minima(s).tobytes() if len(s) else None for s in sets],
                          pa.binary())],
                ["key", "n", "node", "sig"])

    return docs.select(key, text).mapInArrow(run, f"key {kind}, n long, node binary, sig binary")


def forest(nodes: DataFrame, deep: bool = True) -> DataFrame:
    """Rows (order, region, node, near): the members of regions that may have several,
    each with the node of its region just before it in the order, if there is one; in
    the order of names alone if not ``deep``."""
    named, rest = dict(nodes.dtypes)["node"], ["rest"] if deep else []

    @frugal
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                m = part.num_rows
                sigs = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint16)
                keys = sigs.reshape(m, MINIMA)[:, _ORDER].astype(np.int64).reshape(
                    m * ORDERS, 2, 4)
                keys = keys[..., 0] << 48 | keys[..., 1] << 32 | keys[..., 2] << 16 | keys[..., 3]
                which = pa.array(np.repeat(np.arange(m), ORDERS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(ORDERS, dtype=np.int32), m)),
                     *[pa.array(keys[:, i]) for i in range(1 + deep)], part["node"].take(which)],
                    order)

    @frugal
    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first and the last row of a partition are passed on in any case: their
        # region may go on beyond it. ``held`` is the last row so far with the one
        # before it, as its successor isn't known.
        held, first = None, True

        def passed(rows: pa.Table, fresh: int, ends: bool) -> pa.Table:
            order, region = (rows[c].to_numpy() for c in ("order", "region"))
            same = np.append(False, (order[1:] == order[:-1]) & (region[1:] == region[:-1]))
            wanted = same | np.append(same[1:], ends)
            wanted[0] |= first
            upto = len(rows) if ends else len(rows) - 1
            pick = np.flatnonzero(wanted[fresh:upto]) + fresh
            near = pa.array(pick - 1, mask=~same[pick])
            return rows.take(pa.array(pick)).append_column(
                "near", rows["node"].combine_chunks().take(near))

        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                fresh = 0 if held is None else len(held) - 1
                rows = rows if held is None else pa.concat_tables([held, rows])
                yield from passed(rows, fresh, False).to_batches()
                first = first and len(rows) == 1
                held = rows.slice(max(0, len(rows) - 2))
        if held is not None:
            yield from passed(held, len(held) - 1, True).to_batches()

    order = ["order", "region", *rest, "node"]
    schema = ", ".join(["order int, region long", *(f"{c} long" for c in rest), f"node {named}"])
    rows = nodes.select("node", "sig").mapInArrow(spread, schema)
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(neighbours, f"{schema}, near {named}").drop("rest"))


def with_hub(members: DataFrame) -> DataFrame:
    """``members`` of regions that have several, with the region's least node ``hub``."""
    hubs = (members.groupBy("order", "region")
            .agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size"))
            .filter("size > 1").drop("size"))
    return members.join(hubs, ["order", "region"])


def shingles(texts: DataFrame, k: int) -> DataFrame:
    """A row for each shingle of each text, with the other columns of ``texts``."""
    also = [c for c in texts.columns if c != "text"]
    kinds = dict(texts.dtypes)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["text"]):
                own = shingle_set(text.as_py(), k).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), *(pa.repeat(batch[c][i], len(own)) for c in also)],
                    ["shingle", *also])

    return texts.mapInArrow(run, ", ".join(["shingle long", *(f"{c} {kinds[c]}" for c in also)]))


def unshared(texts: DataFrame, k: int) -> DataFrame:
    """(ref, u): by xxhash64 of the node, how many shingles no other node has."""
    return (shingles(texts.select(F.xxhash64("node").alias("ref"), "text"), k).groupBy("shingle")
            .agg(F.count(F.lit(1)).alias("_in"), F.min("ref").alias("ref")).filter("_in = 1")
            .groupBy("ref").agg(F.count(F.lit(1)).alias("u")))


def place(key):
    """A key's place in a bit map."""
    return F.pmod(F.xxhash64(key), F.lit(1 << BITS))


def among(keys: DataFrame, key: str):
    """A bit map by ``place``: ``here`` is true for all of ``keys`` and by chance for some others.

    It has a fixed size. The more keys, the more others pass: what passes
    is joined exactly, what doesn't needs no shuffle."""
    spark = keys.sparkSession
    return spark.sparkContext.broadcast(bit_map(spark, keys.select(place(key).alias("position"))))


def here(bits: bytes, at: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` are set."""
    bits = np.frombuffer(bits, np.uint8)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def hit(shared):
    """``here`` on a column. Not for rows that go on to ``mapInArrow``: a task has a
    Python worker for each of the two, and an executor keeps them all."""

    @F.pandas_udf("boolean")
    def test(at: pd.Series) -> pd.Series:
        return pd.Series(here(shared.value, at.to_numpy()))

    return test


def differences(texts: DataFrame, known: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows (c, node, e, d) for the nodes ``known`` (node, n, c: cluster).

    ``d`` has the shingles in which a node differs from its cluster's hub and that
    another's difference has too, as growing numbers with the rare ones first. ``e``
    is so that two nodes of a cluster reach the similarity if and only if their lists
    have common elements of at least (e + e) / (2 * (100 + percent)).
    """
    known = known.withColumn("ref", F.xxhash64("node"))
    sizes, path = stored(known.groupBy("c").agg(F.count(F.lit(1)).alias("s")), "sizes")
    each = shingles(texts.join(known.select("node", "ref", "c"), "node")
                    .select("ref", "c", "text"), k)
    often = F.when(F.col("hub"), F.col("s") - F.col("m")).otherwise(F.col("m"))
    rank = F.length(F.bin("w"))
    marks, _ = stored(each.groupBy("c", "shingle").agg(F.count(F.lit(1)).alias("m"))
                      .filter("m > 1").join(size_checked(sizes, path), "c")
                      .withColumn("hub", F.col("m") * 2 > F.col("s")).withColumn("w", often)
                      .select("c", "shingle", "hub", F.when(F.col("w") > 1, F.shiftleft(
                          F.least(rank, F.lit(31)).cast("long"), 58).bitwiseOR(
                          F.col("shingle").bitwiseAND((1 << 58) - 1))).alias("code")), "marks")
    inside = F.when(F.col("hub"), F.col("code"))
    own = (each.join(marks, ["c", "shingle"]).groupBy("c", "ref").agg(
        F.count_if("hub").alias("h"), F.collect_list(inside).alias("has"),
        F.collect_list(F.when(~F.col("hub"), F.col("code"))).alias("added")))
    hubs, path = stored(marks.filter("hub").groupBy("c").agg(
        F.count(F.lit(1)).alias("size"), F.collect_list("code").alias("all")), "hubs")
    none = F.array().cast("array<bigint>")
    h, size = F.coalesce("h", F.lit(0)), F.coalesce("size", F.lit(0))
    differing = F.col("n") - h + size - h
    return (known.join(own, ["c", "ref"], "left").join(size_checked(hubs, path), "c", "left")
            .select("c", "node", (differing * (100 + percent) - F.col("n") * (100 - percent)).alias("e"),
                    F.array_sort(F.concat(F.coalesce("added", none), F.array_except(
                        F.coalesce("all", none), F.coalesce("has", none)))).alias("d")))


def confirmed(pairs: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) of nodes of one cluster that reach the similarity."""
    one = apart.select("node", "c", "e", "d")
    both = F.size(F.array_intersect("da", "db"))
    return (pairs.select("a", "b").join(one.toDF("a", "ca", "ea", "da"), "a")
            .join(one.toDF("b", "cb", "eb", "db"), "b")
            .filter((F.col("ca") == F.col("cb"))
                    & (both * 2 * (100 + percent) >= F.col("ea") + F.col("eb")))
            .select("a", "b"))


def sharing_rare(apart: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), once each, of the nodes ``apart`` (c, node, label, e, d) of one cluster
    that have different labels and that a prefix filter with places can't exclude.

    A node needs the more in common the larger its e and the least e of another
    label are. Of so many common elements the first stands early in both lists.
    """
    step = 2 * (100 + percent)
    first = apart.groupBy("c").agg(F.min(F.struct("e", "label")).alias("_1"))
    second = (apart.join(first, "c").filter(F.col("label") != F.col("_1.label"))
              .groupBy("c").agg(F.first("_1").alias("_1"), F.min("e").alias("_2")))
    other = F.when(F.col("label") == F.col("_1.label"), F.col("_2")).otherwise(F.col("_1.e"))
    need = F.greatest(F.lit(1), F.ceil((F.col("e") + other) / step))
    front = (F.size("d") - need + 1).cast("int")
    posts = (apart.join(second, "c").withColumn("_front", front).filter("_front > 0")
             .select("c", "node", "label", "e", F.size("d").alias("_size"),
                     F.posexplode(F.slice("d", 1, F.col("_front"))).alias("_place", "code"))
             .withColumn("left", F.col("_size") - F.col("_place")).drop("_size", "_place"))
    posts, _ = stored(posts, "posts")
    at = ["c", "code"]
    sizes = posts.groupBy(*at, "label").agg(F.count(F.lit(1)).alias("_m"))
    largest = (sizes.groupBy(*at).agg(F.count(F.lit(1)).alias("_labels"),
                                      F.max(F.struct("_m", "label")).alias("_top"))
               .filter("_labels > 1").select(*at, F.col("_top.label").alias("_top")))
    posts = posts.join(largest, at).withColumn("_in", F.col("label") == F.col("_top"))
    outside = posts.filter("not _in").drop("_in", "_top")
    every = posts.select(*at, F.col("node").alias("b"), F.col("label").alias("lb"),
                         F.col("e").alias("eb"), F.col("left").alias("leftb"), "_in")
    return (outside.join(every, at)
            .filter((F.col("label") != F.col("lb")) & (F.col("_in") | (F.col("node") < F.col("b")))
                    & (F.least("left", "leftb") * step >= F.col("e") + F.col("eb")))
            .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the ends of ``edges`` (a, b): the least node reachable.

    Each round takes the least label among the neighbours and then the label of
    that label, so distances halve; rounds are stored, which cuts the lineage.
    """
    both, _ = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels, _ = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.toDF("b", "seen"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("seen").alias("seen")))
        least = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "seen").alias("label"))
        jump = labels.toDF("label", "further")
        after = least.join(jump, "label").select(
            "node", "was", F.least("label", "further").alias("label"))
        after, _ = stored(after, "labels")
        if after.filter(F.col("label") != F.col("was")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def linked_components(docs: DataFrame, key: str, text: str, k: int = 5,
                      percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n`` (set size), ``node`` and ``component``.

    ``component`` names the group (a node digest), null for an empty set.
    """
    rows, _ = stored(signatures(docs, key, text, k), "signatures")
    nodes, _ = stored(rows.filter("node is not null").groupBy("node").agg(
        F.min("key").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    # Here 64 bits name a node: two with one name are both kept, and parted below.
    ref = F.xxhash64("node")
    met = with_hub(forest(nodes.select(ref.alias("node"), "sig"), deep=False))
    wanted, path = stored(met.select(F.col("node").alias("_ref")).distinct().join(
        nodes.select(ref.alias("_ref"), "node", "rep"), "_ref").select("node", "rep"), "wanted")
    texts = bucketed(texts_of(docs, key, text, k, size_checked(wanted, path)), "texts", "node")

    left = (texts.select("node").join(nodes.select("node", "n", "sig"), "node")
            .withColumn("ref", ref).join(unshared(texts, k), "ref", "left")
            .filter(F.coalesce("u", F.lit(0)) * 100 <= F.col("n") * (100 - percent)))
    left, _ = stored(left.select("node", "n", "sig"), "left")
    regions, _ = stored(with_hub(forest(left)), "regions")
    to_hub = regions.filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    clusters = components(to_hub)
    known, _ = stored(left.select("node", "n").join(clusters, "node").select(
        "node", "n", F.xxhash64("label").alias("c")), "known")
    apart, _ = stored(differences(texts, known, k, percent), "apart")

    met = (regions.filter("near is not null").select(F.col("node").alias("a"),
                                                     F.col("near").alias("b")).union(to_hub)
           .groupBy("a", "b").agg(F.count(F.lit(1)).alias("orders")))
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("orders"), "b"))
    met = met.withColumn("_rank", best).filter(F.col("_rank") <= CONFIRMED)
    links = confirmed(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct(), apart, percent)
    least = apart.groupBy("c").agg(F.min(F.struct("e", "node")).alias("_1"))
    links = links.union(apart.join(least, "c").filter(
        (F.col("e") + F.col("_1.e") <= 0) & (F.col("node") != F.col("_1.node")))
        .select("node", F.col("_1.node")))
    links, _ = stored(links, "links")
    labelled = apart.join(components(links), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    labelled, _ = stored(labelled, "labelled")
    more, _ = stored(confirmed(sharing_rare(labelled, percent), labelled, percent), "more")
    if more.isEmpty():
        named_by = labelled.select("node", F.col("label").alias("component"))
    else:
        named_by = components(links.union(more)).toDF("node", "component")
    return (rows.select(F.col("key").alias(key), "n", "node").join(named_by, "node", "left")
            .select(key, "n", "node", F.coalesce("component", "node").alias("component")))


def texts_of(docs: DataFrame, key: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """(node, text) of the ``wanted`` (node, rep): texts of others don't enter a shuffle."""
    shared, kind = among(wanted, "rep"), dict(docs.dtypes)[key]

    @frugal
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(here(shared.value, batch["at"].to_numpy())))
            names = [digest(shingle_set(t.as_py(), k)) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], pa.array(names, pa.binary()), batch["text"]],
                ["rep", "node", "text"])

    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("text"),
                        place(F.col(key)).alias("at"))
    return (texts.mapInArrow(named, f"rep {kind}, node binary, text string")
            .join(wanted.select(F.col("rep").alias("_rep")).distinct(),
                  F.col("rep").eqNullSafe(F.col("_rep")), "left_semi").select("node", "text")
            .join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def with_component_id(found: DataFrame, key: str) -> DataFrame:
    """Adds ``component_id``: the least ``key`` of the row's component, or its own."""
    least = found.groupBy("component").agg(F.min(key).alias("component_id"))
    return (found.join(least.filter("component is not null"), "component", "left")
            .withColumn("component_id", F.when(F.col("component").isNull(), F.col(key))
                        .otherwise(F.col("component_id"))))


def one_of_each(docs: DataFrame, key: str, text: str, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the least key
    (ties: least digest), and every row with an empty set. Columns stay as they are."""
    found, _ = stored(linked_components(docs, key, text, k, percent), "components")
    full = found.filter("component is not null")
    # Rows with equal key and set count once here, and are told apart below.
    stay = (full.groupBy("component").agg(F.min(F.struct(
        F.col(key).isNull().alias("_last"), F.col(key).alias("_key"), "node")).alias("_m"))
        .select("_m._key", "_m.node"))
    rows = full.groupBy(F.col(key).alias("_key"), "node").agg(F.count(F.lit(1)).alias("_copies"))
    stay = (rows.join(stay.toDF("_k", "_n"), F.col("_key").eqNullSafe(F.col("_k"))
                      & (F.col("node") == F.col("_n")))
            .select("_key", F.col("node").alias("_set"), "_copies"))
    bare = found.filter("component is null").select(
        F.col(key).alias("_key"), F.lit(None).cast("binary").alias("_set"),
        F.lit(1).cast("long").alias("_copies")).distinct()
    # Rows without company stay as they are; only the keys of others are joined.
    shared = full.join(full.groupBy("component").agg(F.count(F.lit(1)).alias("_rows"))
                       .filter("_rows > 1"), "component", "left_semi")
    bits = among(shared.select(F.col(key).alias("_key")), "_key")
    stay, path = stored(stay.union(bare).filter(hit(bits)(place("_key"))), "stay")
    of, own, copies, node, at = (unused(docs.columns, c) for c in (
        "_key", "_set", "_copies", "_node", "_at"))
    stay = size_checked(stay, path).toDF(of, own, copies)

    @frugal
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(here(bits.value, batch[at].to_numpy()))).select(names)
            sets = [shingle_set(t.as_py(), k) for t in batch[text]]
            yield batch.append_column(node, pa.array(
                [digest(s) if len(s) else None for s in sets], pa.binary()))

    names, placed = docs.columns, place(F.col(key))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    kept = docs.withColumn(at, placed).mapInArrow(named, f"{schema}, `{node}` binary").join(
        stay, F.col(key).eqNullSafe(F.col(of)) & F.col(node).eqNullSafe(F.col(own)))
    single = kept.filter(F.col(copies) == 1)
    repeats = kept.filter(F.col(copies) > 1).dropDuplicates([key, node])
    return (docs.filter(~hit(bits)(placed)).unionByName(single.select(*docs.columns))
            .unionByName(repeats.select(*docs.columns)))
