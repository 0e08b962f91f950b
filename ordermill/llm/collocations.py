"""Phrase collocation mining by SON partitioning.

Phrases are runs of one to three words within a piece of text. They are mined in
three passes over the texts:

1. The documents are split into shards, and every shard is mined completely at
   its share of the support: with 3 shards and a support of 10 a phrase has to
   occur 4 times in one of them, as 3 times in each makes 9 only. Words and
   pairs come first,
2. then runs of three words, of which only those are counted whose two pairs are
   frequent in a shard (a run occurs no oftener than its parts).
3. The union of what is frequent in a shard is counted over all texts, exactly and
   by the words themselves, and what meets the support stays.

Passes 1 and 2 count hashes: phrases that share one only add a candidate, as
their counts are added up. Tasks combine their own counts and send them packed, a row
for each of the buckets that the hashes are dealt into; the number of buckets follows
from the size of all texts, so that a bucket's counts stay some ten megabytes. A
candidate whose counts in all shards miss the support together is dropped at once.
Candidates go to the tasks as a bit map of a fixed 2^27 positions (16 MB),
whatever their number; what shares a position with one is counted in vain and
dropped by the exact count. A shard is mined by many tasks, so the number of shards
doesn't grow with the input: a shard of less than a tenth of it would have a support
of 1 and exclude nothing. A task's partition tells its shard; the documents must be
read from stored files, so that a task that is run again has the same rows.

Texts are taken in blocks of some 2 MB, a longer text ends its block, so a worker
holds some 100 MB whatever the texts are in all.
Null texts are empty, a null language is ``und``, and repeated rows count as often
as they occur. An empty table gives no phrases. Columns beside these are ignored.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .hotcache import frugal
from .tables import stored

SUPPORT = 10
SHARDS = 3
LONGEST = 3
#: Best phrases of a language.
BEST = 2000
#: A phrase goes if a longer one has this percentage of its occurrences.
COVERED = 50
NO_LANG = "und"
BITS = 27
#: Bits of a phrase's hash below those of its bucket.
LOW = 32
#: Characters of a block of texts, texts' bytes to a bucket, counts held by a task.
BLOCK = 1 << 21
BUCKET_BYTES = 1 << 23
HELD = 1 << 21

PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(BLANKS)] = 1
_CLASS[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a block of texts in their order, and where runs of them stand.

    ``id`` numbers words with their language, so that equal ids mean both equal.
    """

    def __init__(self, langs: list[str], texts: list[str]):
        data = [t.encode() for t in texts]
        ends = np.cumsum([len(d) + 1 for d in data])
        raw = _LOWER[np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)]
        del data
        kind = _CLASS[raw]
        inside = kind == 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([[0], edge])
        start, size = edge[::2], np.diff(edge)[::2]  # the last byte is never in a word
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        text = pa.Array.from_buffers(pa.large_string(), len(size), [
            None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
        # Pieces end where one of their ends stands between two words.
        piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        del raw, kind, inside, offsets, size, edge
        self.langs = sorted(set(langs))
        code = {v: i for i, v in enumerate(self.langs)}
        lang = np.array([code[v] for v in langs], dtype=np.int64)[
            np.searchsorted(ends, start, side="right")]
        self.count = np.bincount(lang, minlength=len(self.langs))
        distinct = max(1, len(text.dictionary))
        seen, inverse = np.unique(lang * distinct + text.indices.to_numpy(
            zero_copy_only=False), return_inverse=True)
        self.id = inverse.astype(np.int32)
        self.lang, at = np.divmod(seen, distinct)
        self.word = text.dictionary.take(pa.array(at))
        same = piece[1:] == piece[:-1]
        self.at = {1: np.arange(len(start), dtype=np.int32),
                   2: np.flatnonzero(same).astype(np.int32),
                   3: np.flatnonzero(same[1:] & same[:-1]).astype(np.int32)}
        self.hashed = np.array(
            [xxhash.xxh3_64_intdigest(w.encode(), seed=g) for w, g in zip(
                self.word.to_pylist(), self.seeds())], dtype=np.uint64)

    def seeds(self) -> list[int]:
        of = [xxhash.xxh3_64_intdigest(v.encode()) for v in self.langs]
        return [of[i] for i in self.lang.tolist()]

    def keys(self, length: int, at: np.ndarray) -> np.ndarray:
        """63-bit hashes of the runs of ``length`` words at these places."""
        key = np.full(len(at), 0x9E3779B97F4A7C15 * length % 2 ** 64, dtype=np.uint64)
        for k in range(length):
            key = (key ^ self.hashed[self.id[at + k]]) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(32)
        return (key >> np.uint64(1)).view(np.int64)


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Words]:
    """Words of some 2 MB of texts at a time; columns are language and text."""
    langs, texts, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            langs.append(NO_LANG if lang is None else lang)
            texts.append(text)
            held += len(text)
            if held >= BLOCK:
                yield Words(langs, texts)
                langs, texts, held = [], [], 0
    if texts:
        yield Words(langs, texts)


def positions(keys: np.ndarray) -> np.ndarray:
    """Places in the bit map: the last of the bits that every hash keeps."""
    return (keys >> 63 - LOW - 8) & ((1 << BITS) - 1)


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = positions(keys)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def candidates_at(w: Words, length: int, bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return at[marked(bits, w.keys(length, at))]


def triples(w: Words, bits: np.ndarray) -> np.ndarray:
    """Places of three words whose two pairs are both candidates."""
    pair = np.zeros(len(w.id) + 1, dtype=bool)
    pair[candidates_at(w, 2, bits, w.at[2])] = True
    at = w.at[3]
    return at[pair[at] & pair[at + 1]]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts added up. Both lists are emptied, so that
    what is summed is held once."""
    key = np.concatenate(keys)
    n = np.concatenate(counts).astype(np.int64, copy=False)
    keys.clear()
    counts.clear()
    order = np.argsort(key)
    key, n = key[order], n[order]
    del order
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key[:0].astype(np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def packed(key: np.ndarray, n: np.ndarray, shard: int, bits: int) -> pa.RecordBatch:
    """A row for each bucket (the upper ``bits`` of a key) with the next 32 bits of its
    keys, and counts of a byte; what is counted more often is there several times."""
    key = key >> 63 - LOW - bits
    often = np.flatnonzero(n > 255)
    counts = np.minimum(n, 255).astype(np.uint8)
    if len(often):
        times = -(-n[often] // 255)
        each = np.ones(len(n), np.int64)
        each[often] = times
        key, counts = np.repeat(key, each), np.repeat(counts, each)
        counts[(np.cumsum(each) - 1)[often]] = n[often] - 255 * (times - 1)
    # Keys are in order, and so are their buckets.
    bucket = (key >> LOW).astype(np.int32)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(key) else []
    ends, bucket = np.r_[first[1:], len(key)].astype(np.int64), bucket[first]
    rest, counts = key.astype("<u4").tobytes(), counts.tobytes()
    return pa.record_batch({
        "bucket": pa.array(bucket),
        "shard": pa.array(np.full(len(bucket), shard, np.int32)),
        "keys": pa.array([rest[4 * a:4 * b] for a, b in zip(first, ends)], pa.binary()),
        "counts": pa.array([counts[a:b] for a, b in zip(first, ends)], pa.binary())})


PACKED_DDL = "bucket int, shard int, keys binary, counts binary"


def _local(batches, shards: int, lengths: tuple[int, ...], bits: int, shared
           ) -> Iterator[pa.RecordBatch]:
    """Counts of the hashes of this task's phrases."""
    shard = TaskContext.get().partitionId() % shards
    known = None if shared is None else np.frombuffer(shared.value, dtype=np.uint8)
    keys, counts, held = [], [], 0
    for w in blocks(batches):
        for length in lengths:
            at = w.at[length] if known is None else triples(w, known)
            key, n = np.unique(w.keys(length, at), return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
        if held >= HELD:
            yield packed(*summed(keys, counts), shard, bits)
            held = 0
    if held:
        yield packed(*summed(keys, counts), shard, bits)


def _frequent(batches, support: int, shards: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Keys that reach their share of the support in a shard, bucket by bucket; rows
    come in the order of buckets."""
    at, shards_of = None, {}

    def found() -> pa.RecordBatch:
        by = [summed(*parts) for parts in shards_of.values()]
        local = np.unique(np.concatenate([k[n >= -(-support // shards)] for k, n in by]))
        total = np.zeros(len(local), np.int64)
        for k, n in by:
            place = np.minimum(np.searchsorted(k, local), len(k) - 1)
            total += np.where(k[place] == local, n[place], 0)
        key = (at << LOW) | local[total >= support].astype(np.int64)
        return pa.record_batch({"position": pa.array(positions(key << 63 - LOW - bits))})

    for batch in batches:
        for bucket, shard, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if at is not None and bucket != at:
                yield found()
                shards_of = {}
            at = bucket
            own = shards_of.setdefault(shard, ([], []))
            own[0].append(np.frombuffer(keys, "<u4"))
            own[1].append(np.frombuffer(counts, np.uint8))
            if len(own[0]) > 1 and sum(map(len, own[0][1:])) > HELD:
                merged = summed(*own)       # a bucket of more parts than are held
                shards_of[shard] = ([merged[0]], [merged[1]])
    if at is not None:
        yield found()


def bucket_bits(docs: DataFrame, text: str) -> int:
    """Bits of the buckets, from the bytes of all texts: 2^8 to 2^20 buckets."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(20, max(8, int(size // BUCKET_BYTES).bit_length()))


def frequent_in_a_shard(docs: DataFrame, support: int, shards: int, lengths: tuple[int, ...],
                        bits: int, shared=None) -> DataFrame:
    """Places in the bit map of the phrases that reach their share of the support in a
    shard; shares are rounded up, and 1 less in each is less than the support."""
    local = docs.mapInArrow(frugal(lambda b: _local(b, shards, lengths, bits, shared)),
                            PACKED_DDL)
    return (local.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(frugal(lambda b: _frequent(b, support, shards, bits)), "position long"))


def bit_map(spark: SparkSession, places: DataFrame, start: bytes | None = None) -> bytes:
    """A bit for each position: 2^27 bits, in pieces of 32,768, however many there are."""
    at = F.col("position") + 1  # Spark counts from 1
    rows = (places.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out = np.zeros(1 << BITS - 3, dtype=np.uint8) if start is None else np.frombuffer(
        start, dtype=np.uint8).copy()
    for r in rows:
        piece = np.frombuffer(r["bits"], dtype=np.uint8)
        first = (r["bucket"] - 1) * 4096
        out[first:first + len(piece)] |= piece
    return out.tobytes()


def _exact(batches, shared) -> Iterator[pa.RecordBatch]:
    """Counts of this task's candidates by language and words, and of all its words
    (phrase null)."""
    bits = np.frombuffer(shared.value, dtype=np.uint8)
    for w in blocks(batches):
        langs = pa.array(w.langs)
        yield _counted(langs, pa.nulls(len(langs), pa.string()), 0, w.count)
        pairs = candidates_at(w, 2, bits, w.at[2])
        of = {1: candidates_at(w, 1, bits, w.at[1]), 2: pairs,
              3: candidates_at(w, 3, bits, triples(w, bits))}
        for length, at in of.items():
            # Ids of a run by those of its start: exact whatever their number.
            run = w.id[at].astype(np.int64)
            for k in range(1, length):
                run = np.unique(run, return_inverse=True)[1] * len(w.word) + w.id[at + k]
            _, first, n = np.unique(run, return_index=True, return_counts=True)
            start = at[first]
            parts = [w.word.take(pa.array(w.id[start + k])) for k in range(length)]
            phrase = parts[0] if length == 1 else pc.binary_join_element_wise(
                *parts, pa.scalar(" ", pa.large_string()))
            yield _counted(langs.take(pa.array(w.lang[w.id[start]])), phrase.cast(pa.string()),
                           length, n)


def _counted(langs, phrase, length, n) -> pa.RecordBatch:
    return pa.record_batch({"lang": langs, "phrase": phrase,
                            "length": pa.array(np.full(len(n), length, np.int32)),
                            "f": pa.array(np.asarray(n, dtype=np.int64))})


def frequent_phrases(docs: DataFrame, lang: str, text: str, support: int = SUPPORT,
                     shards: int = SHARDS) -> DataFrame:
    """Exact counts ``f`` of all phrases of 1 to 3 words with at least ``support``
    occurrences, by ``lang``, ``phrase`` and ``length``; with length 0 and a null
    phrase the number of all words of a language."""
    spark = docs.sparkSession
    docs = docs.select(F.col(lang).cast("string"), F.col(text).cast("string"))
    deal = bucket_bits(docs, text)
    known = bit_map(spark, frequent_in_a_shard(docs, support, shards, (1, 2), deal))
    shared = spark.sparkContext.broadcast(known)
    known = bit_map(spark, frequent_in_a_shard(docs, support, shards, (3,), deal, shared), known)
    shared = spark.sparkContext.broadcast(known)
    counted = docs.mapInArrow(frugal(lambda b: _exact(b, shared)),
                              "lang string, phrase string, length int, f long")
    return (counted.groupBy("lang", "phrase", "length").agg(F.sum("f").alias("f"))
            .filter((F.col("length") == 0) | (F.col("f") >= support)))


#: floor(1000000 * a * a / (l * r)) in decimals, as products pass 64 bits.
_SCORE = ("cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
          " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")


def collocations(docs: DataFrame, lang: str, text: str, support: int = SUPPORT,
                 best: int = BEST, covered: int = COVERED, shards: int = SHARDS) -> DataFrame:
    """Each language's ``best`` phrases of two or three words, by score."""
    f, _ = stored(frequent_phrases(docs, lang, text, support, shards), "phrases")
    phrases = f.filter("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"))
    words = F.split("phrase", " ")

    def run(first, length):
        return F.array_join(F.slice(words, first, length), " ")

    # Heads and tails are made where they are looked up, and not carried along.
    known = f.filter("length > 0").select(F.col("lang").alias("_lang"),
                                          F.col("phrase").alias("_part"), "f")
    k = F.col("k")
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, length - 1)")).alias("k"))
    for name, part in (("l", run(F.lit(1), k)), ("r", run(k + 1, F.col("length")))):
        cuts = cuts.join(known, (F.col("lang") == F.col("_lang")) & (part == F.col("_part"))
                         ).select("lang", "phrase", "length", "a", "k",
                                  *(["l"] if name == "r" else []), F.col("f").alias(name))
    scored = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct(
        F.expr(_SCORE).alias("score"), "k", "a", "l", "r")).alias("cut"))
        .select("lang", "phrase", "cut.*"))
    pair = F.array(*[F.array_join(F.slice(words, i, 2), " ") for i in (1, 2)])
    longer = (phrases.filter("length = 3")
              .select("lang", F.explode(F.array_distinct(pair)).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    total = f.filter("length = 0").select("lang", F.col("f").alias("n"))
    return (scored.join(longer, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
            .withColumn("rank", F.row_number().over(order).cast("long"))
            .filter(F.col("rank") <= best).join(total, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score")))
