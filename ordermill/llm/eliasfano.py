"""Token ids of all documents as one array, with Elias-Fano document boundaries.

``write`` encodes the documents in ascending key order and writes segments;
``read`` finds every document in them again. A segment is one binary record:

    magic 4 bytes, id width in bytes (2 or 4), bits of a low part, number of
    documents, number of ids; the ids, little-endian; the low parts, packed;
    the high parts, in unary; every 64th position of a one bit.

Document i ends at the i-th of a growing list of offsets. An offset is cut into
``low`` bits, packed side by side, and a high part; the high parts stand in a
bit vector that has, for each document, a one after as many zeros as the high
part grew. That takes about 2 + log2(ids / documents) bits a document, and no
table of 64-bit offsets. ``Boundaries.end(i)`` selects the i-th one from the
nearest sampled position on.

Segments are rows of a Parquet table, so Spark's commit protocol holds for
them: a lost executor leaves no half file, and any store that Spark knows can
hold them. A segment starts at the sum of the ids before it, which is worked
out from the segments' small columns when they are read.

Nulls: a null text counts as empty and has the end id alone; a null key comes
first. Documents with equal keys follow each other by a hash of their text, and
repeated rows all stay. An empty table gives an empty file. Other columns are
not looked at. A text is never cut; a segment holds one document at least.
"""
from __future__ import annotations

import gc
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hotcache import Generations, frugal, kept

MAGIC = b"IDEF"
HEADER = struct.Struct("<4sBBHQQ")
SAMPLE = 64
#: A segment is closed when it holds so many ids.
SEGMENT_IDS = 1 << 20
#: Pieces of text whose ids a worker keeps.
CACHED_PIECES = 400_000
#: Characters of texts that are encoded together.
BATCH_CHARS = 4_000_000


def low_bits(n: int, total: int) -> int:
    return max(0, (total // n).bit_length() - 1) if n else 0


def pack_boundaries(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Low bits, low parts, high parts and samples of non-decreasing ``ends``."""
    n = len(ends)
    if not n:
        return 0, b"", b"", b""
    ends = ends.astype(np.uint64)
    low = low_bits(n, int(ends[-1]))
    shifts = np.arange(low, dtype=np.uint64)
    lows = np.packbits(((ends[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(),
                       bitorder="little").tobytes()
    ones = (ends >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    bits[ones] = 1
    return (low, lows, np.packbits(bits, bitorder="little").tobytes(),
            ones[::SAMPLE].astype("<u4").tobytes())


class Boundaries:
    """Ends of the documents of a segment, from the packed form."""

    def __init__(self, n: int, low: int, lows: bytes, highs: bytes, samples: bytes):
        self.n, self.low = n, low
        self.lows, self.highs = np.frombuffer(lows, np.uint8), np.frombuffer(highs, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def end(self, i: int) -> int:
        """The i-th end: a few bytes from a sample on are looked at."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, bits = at // 8, int(self.highs[at // 8]) >> at % 8 << at % 8
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.highs[byte])
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        start = i * self.low
        word = int.from_bytes(self.lows[start // 8:(start + self.low + 7) // 8].tobytes(),
                              "little") >> start % 8
        return (one - i) << self.low | word & (1 << self.low) - 1

    def all(self) -> np.ndarray:
        """All ends at once."""
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[:self.n]
        bits = np.unpackbits(self.lows, bitorder="little")[:self.n * self.low]
        lows = bits.reshape(self.n, self.low).astype(np.int64) @ (1 << np.arange(self.low))
        return ((ones - np.arange(self.n)) << self.low) | lows


def pack_segment(docs: list[bytes], width: int) -> bytes:
    ids = b"".join(docs)
    ends = np.cumsum([len(d) // width for d in docs])
    low, lows, highs, samples = pack_boundaries(ends)
    head = HEADER.pack(MAGIC, width, low, 0, len(docs), len(ids) // width)
    return b"".join((head, ids, lows, highs, samples))


def unpack_segment(blob: bytes) -> tuple[np.ndarray, Boundaries]:
    """Ids and boundaries of a segment."""
    magic, width, low, _, n, total = HEADER.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    at = HEADER.size + total * width
    ids = np.frombuffer(blob, f"<u{width}", total, HEADER.size)
    lows = blob[at:(at := at + (n * low + 7) // 8)]
    samples = -(-n // SAMPLE) * 4
    return ids, Boundaries(n, low, lows, blob[at:len(blob) - samples],
                           blob[len(blob) - samples:])


#: A space before anything but white space begins a piece of its own: the
#: pre-tokenizer never joins what stands before it with what follows.
WHITE, ALPHA, ENDS, WIDE = 1, 2, 4, 8
#: The kinds of each byte: white space; ASCII letters, and marks and white space, before
#: which a letter's piece ends; first bytes of white space beyond ASCII.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = WHITE | ENDS
_KIND[[*range(65, 91), *range(97, 123)]] = ALPHA
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = ENDS
_KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = WIDE
_WIDE_BLANK = re.compile(rb" (?:\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|"
                         rb"\xe2\x81\x9f|\xe3\x80\x80)")
#: It doesn't join a letter with a mark or white space behind it either, nor a
#: single line feed with a letter.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_INNER = re.compile(f"(?<=[{_LETTER}])(?=[!-/:-@\\[-`{{-~\\s])|(?<=\\S\n)(?=[{_LETTER}])")
_WORD = re.compile(f" ?[{_LETTER}]+")


def pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All texts cut where the pre-tokenizer cuts in any case: the pieces, side by side
    as one array over the texts' bytes, and the number of pieces before each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    cut = np.zeros(len(data) + 1, bool)
    kind = _KIND[data]
    space = data[:-1] == 32
    cut[:len(data)][:-1] = space & (kind[1:] & WHITE == 0) if len(data) else False
    if (space & (kind[1:] & WIDE != 0)).any():
        # White space of several bytes behind a space: no cut there.
        for m in _WIDE_BLANK.finditer(data.tobytes()):
            cut[m.start()] = False
    # A text's last byte is followed by nothing, its first one begins a piece.
    cut[ends[ends > 0] - 1] = False
    # As ``_INNER`` does, for ASCII: fewer different pieces are left to look at.
    cut[1:len(data)] |= (kind[:-1] & ALPHA != 0) & (kind[1:] & ENDS != 0)
    cut[2:len(data)] |= (data[1:-1] == 10) & (kind[:-2] & WHITE == 0) & (kind[2:] & ALPHA != 0)
    starts = np.concatenate([[0], ends])
    cut[starts[:-1][np.diff(starts) > 0]] = True
    cut[len(data)] = False
    at = np.flatnonzero(cut)
    offsets = np.concatenate([at, [len(data)]]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(at), [
        None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return found, np.searchsorted(at, starts)


def values(array: pa.Array) -> list[bytes]:
    """Values of a large binary array without nulls."""
    if not len(array):
        return []
    at = np.frombuffer(array.buffers()[1], np.int64)[
        array.offset:array.offset + len(array) + 1].tolist()
    data = array.buffers()[2].to_pybytes() if array.buffers()[2] is not None else b""
    return [data[a:b] for a, b in zip(at, at[1:])]


def inner_pieces(piece: str) -> list[str] | tuple[str, ...]:
    """A piece, with the space before it, cut between its letters and its marks."""
    core = piece.rstrip(".,;:!?")
    if core.isalpha():
        return (" " + core, piece[len(core):]) if len(core) < len(piece) else (" " + core,)
    return _INNER.split(" " + piece)


#: The characters that stand for bytes in byte-level tokens.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LEVEL = {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)}.difference(_PRINTED)))}


def byte_level(word: str) -> str:
    return word.encode().decode("latin-1").translate(_LEVEL)


class ByteBpe:
    """Ids of whole texts as packed bytes.

    The library encodes a piece once for as long as the worker keeps it. Pieces that
    are new to a batch are cut into words; those of letters go to the library's model,
    as what its pre-tokenizer makes of them, the others to the whole of it in one call.
    """

    def __init__(self, path: str, end_id: int, cached: int = CACHED_PIECES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # The caches hold no cycles; to look through them again and again takes time.
        gc.set_threshold(100_000, 50, 100)
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(*vocab.values(), end_id) < 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        self.end = np.array([end_id], self.dtype).tobytes()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.packed = [i.to_bytes(self.width, "little") for i in range(max(vocab.values()) + 1)]
        cutter = self.tokenizer.pre_tokenizer
        #: A word is cut no further and is what its bytes stand for: the model can have it.
        self.direct = (self.tokenizer.normalizer is None and isinstance(cutter, ByteLevel)
                       and not cutter.add_prefix_space)
        self.whole = Generations(cached)

    def _new_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        packed, tokenize, other = self.packed, self.tokenizer.model.tokenize, []
        for w in words:
            if self.direct and _WORD.fullmatch(w):
                level = w.replace(" ", "Ġ") if w.isascii() else byte_level(w)
                yield w, b"".join([packed[t.id] for t in tokenize(level)])
            else:
                other.append(w)
        for w, ids in zip(other, self._ids(other)):
            yield w, np.array(ids, self.dtype).tobytes()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(
            texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text, the end id last.

        Each different piece of the batch is looked up once; its ids are put wherever
        it stands by one ``take``.
        """
        # Special tokens are found before any cut, so such a text goes as a whole.
        special = [i for i, t in enumerate(texts) if t and any(x in t for x in self.special)]
        whole = dict.fromkeys(special)
        found, before = pieces([b"" if t is None or i in whole else t.encode()
                                for i, t in enumerate(texts)])
        found = found.dictionary_encode()
        distinct = values(found.dictionary)
        self.whole.turn()
        own = self.whole.found(distinct)
        absent = [i for i, x in enumerate(own) if x is None]
        fresh = [(p, p.decode()) for p in map(distinct.__getitem__, absent)]
        # A piece with a space before it, or what a text begins with.
        inner = {p: inner_pieces(t[1:]) if t[0] == " " else _INNER.split(t) for p, t in fresh}
        word = dict(self._new_words(list(set(chain.from_iterable(inner.values()))))).__getitem__
        held = self.whole.held
        for i, (p, parts) in zip(absent, inner.items()):
            own[i] = held[p] = (word(parts[0]) if len(parts) == 1
                                else b"".join(map(word, parts)))
        ends = np.concatenate([[0], np.cumsum(list(map(len, own)))]).astype(np.int64)
        ids = pa.Array.from_buffers(pa.large_binary(), len(own), [
            None, pa.py_buffer(ends), pa.py_buffer(b"".join(own))]).take(found.indices)
        offsets = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        packed, at = ids.buffers()[2], offsets[before].tolist() if len(ids) else [0] * len(before)
        data = memoryview(packed) if packed is not None else memoryview(b"")
        out = [bytes(data[a:b]) + self.end for a, b in zip(at, at[1:])]
        for i, own in zip(special, self._ids([texts[i] for i in special])):
            out[i] = np.array(own, self.dtype).tobytes() + self.end
        return out


def byte_bpe(path: str, end_id: int) -> ByteBpe:
    """One per worker and tokenizer: the pieces of its next tasks are mostly the same."""
    return kept(("byte_bpe", path, end_id), lambda: ByteBpe(path, end_id))


def batches_of(texts: list[str | None]) -> Iterator[slice]:
    """Stretches of a list with about ``BATCH_CHARS`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


SEGMENTS = ("part int, seq int, n_docs long, n_ids long, keys array<bigint>, blob binary")


def write(docs: DataFrame, key: str, text: str, path: str, tokenizer: str, end_id: int = 0,
          segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` in ascending ``key`` order into segments at ``path``."""

    @frugal
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, bpe = TaskContext.get().partitionId(), 0, byte_bpe(tokenizer, end_id)
        keys, held, size = [], [], 0

        def segment():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([len(held)], pa.int64()),
                 pa.array([size // bpe.width], pa.int64()),
                 pa.array([keys], pa.list_(pa.int64())),
                 pa.array([pack_segment(held, bpe.width)], pa.binary())],
                ["part", "seq", "n_docs", "n_ids", "keys", "blob"])

        for batch in batches:
            ks, texts = batch["_k"].to_pylist(), batch["_t"].to_pylist()
            for part_of in batches_of(texts):
                for k, ids in zip(ks[part_of], bpe.encode(texts[part_of])):
                    keys.append(k)
                    held.append(ids)
                    size += len(ids)
                    if size >= segment_ids * bpe.width:
                        yield segment()
                        seq, keys, held, size = seq + 1, [], [], 0
        if held:
            yield segment()

    rows = docs.select(F.col(key).cast("long").alias("_k"), F.col(text).alias("_t"))
    order = [F.col("_k"), F.xxhash64("_t")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(encode, SEGMENTS)
     .write.option("compression", "zstd").parquet(path))


def read(spark, path: str, key: str) -> DataFrame:
    """Per document of the file: key, start, n_tokens and ids_crc32 (of 32-bit ids)."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    small = segments.select("part", "seq", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the writing job.
    parts = (small.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
             .select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base")))
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = (small.withColumn("_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
             .join(parts, "part")
             .select("part", "seq", (F.col("_base") + F.col("_before")).alias("base")))

    @frugal
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, bounds = unpack_segment(batch["blob"][i].as_py())
                wide = ids.astype("<u4").tobytes()
                ends = bounds.all()
                starts = np.concatenate(([0], ends[:-1]))
                crcs = [zlib.crc32(memoryview(wide)[4 * a:4 * b])
                        for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch["keys"][i].values, pa.array(starts + batch["base"][i].as_py()),
                     pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    [key, "start", "n_tokens", "ids_crc32"])

    # A few bytes for a million ids each: blobs stay where they were read.
    return (segments.join(F.broadcast(bases), ["part", "seq"]).select("base", "keys", "blob")
            .mapInArrow(decode, f"{key} long, start long, n_tokens long, ids_crc32 long"))
