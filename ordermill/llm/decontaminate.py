"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are lower-cased and their white space is made single
blanks. A document is contaminated by an item if some stretch of ``LENGTH``
characters of the item (the whole item, if that is shorter) stands in it with at
most one edit in ``PER_EDIT`` characters.

A stretch of w characters with k edits or fewer keeps w + 1 - q (k + 1) of its
q-grams, all of them on diagonals (place in the text less place in the item) no
more than k apart. So the shared q-grams are counted by item in diagonal bands
that overlap by half: each such set of diagonals lies in one band as a whole.
Regions of w + k characters with enough q-grams of a band are retained, and a
banded alignment decides.

A q-gram that an item has more than ``REPEATS`` times (a rule of dashes, the border
of a table) would pair all its places with all places in a text. It is counted once
for each place in the text, whatever the band, so nothing is missed. Where such
q-grams alone are enough, no band tells where to align: each different stretch of
the text there is aligned with each different stretch of the item, and in what
repeats itself these are few.

Alignments of many places are made together, column by column.

An item shorter than a q-gram is looked for as it is, between characters that are
not of a word; no edits are allowed below ``2 * Q`` characters.

The items are an index of some 40 bytes a character, sent to the executors in
blocks of at most ``INDEX_CHARS`` characters (80 MB); with more items there are
more passes over the documents, and nothing is left out.

Null and blank items and null texts match nothing; items that repeat are reported by
each id. Repeated documents are each reported. Whole texts are looked at.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .hotcache import frugal


Q = 12
LENGTH = 80
PER_EDIT = 20
REPEATS = 8
INDEX_CHARS = 2_000_000
#: Characters that are scanned at once.
BATCH_CHARS = 1_000_000
#: Alignments that are made at once.
ALIGNED = 4096
#: No character's code.
NONE = np.uint32(0xFFFFFFFF)

_WORD_START = re.compile(r"(?<!\w)(?=\S)")
_IN_WORD = re.compile(r"\w")


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgram_hashes(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of Q = 12 characters, from runs of 2, 4 and 8."""
    c = chars.astype(np.uint64)
    if len(c) < Q:
        return c[:0]
    two = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:]
    four = two[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + two[2:]
    eight = four[:-4] * np.uint64(0x165667B19E3779F9) + four[4:]
    out = eight[:-4] * np.uint64(0xD6E8FEB86659FD93)
    out += four[8:]
    return out ^ (out >> np.uint64(31))


def align(patterns: np.ndarray, windows: np.ndarray, k: int) -> np.ndarray:
    """Edits of the best alignment of each whole pattern (a row of characters) with a
    part of the window beside it, which begins ``k`` characters before the pattern's
    place and is ``2 * k`` longer; within k diagonals of that place. More than k edits
    count as k + 1."""
    n, length = patterns.shape
    width = 2 * k + 1
    big = k + 1
    # Cell j of a row: the pattern's first i characters end on diagonal j - k.
    row = np.zeros((n, width), np.int16)
    steps = np.arange(width, dtype=np.int16)
    for i in range(length):
        there = windows[:, i:i + width]
        best = row + (there != patterns[:, i:i + 1])
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        # A character of the window more: one edit for each step to the right.
        best = np.minimum.accumulate(best - steps, axis=1) + steps
        row = np.minimum(best, big)
    return row.min(1)


def windows_of(chars: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Rows of ``length`` characters from these places on, ``NONE`` beyond the text."""
    at = start[:, None] + np.arange(length)
    inside = (at >= 0) & (at < len(chars))
    return np.where(inside, chars[np.where(inside, at, 0)], NONE)


class Index:
    """Q-grams of a block of items."""

    def __init__(self, items: list[tuple[object, str]], length: int = LENGTH,
                 per_edit: int = PER_EDIT):
        items = [(i, p) for i, t in items if (p := plain(t))]
        short = {}
        for i, p in items:
            if len(p) < Q:
                short.setdefault(p, []).append(i)
        # Longer alternatives first, as the first that fits is taken.
        self.short, self.short_lengths = short, sorted({len(p) for p in short})
        items = [(i, p) for i, p in items if len(p) >= Q]
        self.ids, self.texts = [i for i, _ in items], [p for _, p in items]
        self.chars = [codes(p) for p in self.texts]
        self.window = np.array([min(length, len(p)) for p in self.texts], np.int64)
        # As many edits as are allowed, but no more than leave a shared q-gram.
        self.edits = np.minimum(self.window // per_edit, self.window // Q - 1)
        self.need = self.window + 1 - Q * (self.edits + 1)
        self.band = int(self.edits.max(initial=0)) + 1
        grams = [qgram_hashes(c) for c in self.chars]
        sizes = [len(g) for g in grams]
        item = np.repeat(np.arange(len(items), dtype=np.int32), sizes)
        place = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]) if grams else item
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.lexsort((place, item, hashes))
        hashes, item, place = hashes[order], item[order], place[order]
        first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (item[1:] != item[:-1])]
                               ) if len(hashes) else np.zeros(0, np.int64)
        often = np.repeat(np.diff(np.r_[first, len(hashes)]) > REPEATS,
                          np.diff(np.r_[first, len(hashes)]))
        # Of a q-gram that an item has often one entry stays, without a place.
        place[often] = -1
        lead = np.zeros(len(hashes), bool)
        lead[first] = True
        keep = ~often | lead
        self.item, self.place = item[keep], place[keep]
        self.hashes, self.first, self.count = np.unique(
            hashes[keep], return_index=True, return_counts=True)
        bits = max(16, int(len(self.hashes)).bit_length() + 4)
        self.shift = np.uint64(64 - bits)
        marks = np.zeros(1 << bits, bool)
        marks[self.hashes >> self.shift] = True
        self.filter = np.packbits(marks, bitorder="little")

    def shared(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the text, item and place in the item (-1: often) of every shared
        q-gram."""
        hashes = qgram_hashes(chars)
        slot = hashes >> self.shift
        at = np.flatnonzero(self.filter[slot >> np.uint64(3)]
                            >> (slot & np.uint64(7)).astype(np.uint8) & 1)
        found = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        hit = self.hashes[found] == hashes[at]
        at, found = at[hit], found[hit]
        n = self.count[found]
        each = np.repeat(self.first[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.item[each], self.place[each].astype(np.int64)

    def candidates(self, chars: np.ndarray, item: int, at: np.ndarray, place: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
        """Starts of stretches of an item, and places in the text to align them at, for
        the q-grams that a text shares with it (``at`` in order)."""
        w, k, need = int(self.window[item]), int(self.edits[item]), int(self.need[item])
        reach = w + k - Q
        often = np.unique(at[place < 0])
        at, place = at[place >= 0], place[place >= 0]
        top = len(self.texts[item]) - w
        starts, places = [], []
        # Bands by diagonal, each twice as wide as the offset between them.
        for offset in (0, self.band):
            band = (at - place + (1 << 40) + offset) // (2 * self.band)
            order = np.lexsort((at, band))
            b, a, p = band[order], at[order], place[order]
            if not len(a):
                continue
            line = np.unique(b, return_inverse=True)[1] * (len(chars) + 2 * reach + 2) + a
            near = (np.searchsorted(line, line + reach, "right")
                    - np.searchsorted(line, line - reach, "left"))
            near += (np.searchsorted(often, a + reach, "right")
                     - np.searchsorted(often, a - reach, "left"))
            good = near >= need
            p, b, diagonal = p[good], b[good], (a - p)[good]
            if not len(p):
                continue
            # Every stretch that has the q-gram in it, once for a band.
            low = np.clip(p + Q - w - k, 0, top)
            n = np.clip(p + k, 0, top) - low + 1
            each = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pair, one = np.unique(np.repeat(b, n) * (top + 1) + each, return_index=True)
            starts.append(pair % (top + 1))
            # Diagonals of a band are less than 2 * band apart.
            places.append(np.repeat(diagonal, n)[one] + starts[-1])
        if len(often) >= need:
            dense = (np.searchsorted(often, often + reach, "right")
                     - np.arange(len(often))) >= need
            s, t = self.repeated(chars, item, often[dense], reach)
            starts.append(s)
            places.append(t)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(places)

    def repeated(self, chars: np.ndarray, item: int, dense: np.ndarray, reach: int
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Each different stretch of an item that has enough q-grams that it repeats,
        with each different surrounding of these places."""
        w, need, own = int(self.window[item]), int(self.need[item]), self.chars[item]
        _, back, n = np.unique(qgram_hashes(own), return_inverse=True, return_counts=True)
        total = np.r_[0, np.cumsum(n[back] > REPEATS)]
        starts = np.arange(len(own) - w + 1)
        starts = starts[total[starts + w - Q + 1] - total[starts] >= need]
        _, one = np.unique(windows_of(own, starts, w), axis=0, return_index=True)
        starts = starts[np.sort(one)]
        step = 2 * self.band        # an alignment looks farther to either side
        near = np.unique(np.concatenate(
            [(dense + d) // step for d in range(-reach, step, step)])) * step
        places: dict[bytes, int] = {}
        for at in range(0, len(near), ALIGNED):
            part = near[at:at + ALIGNED]
            for place, row in zip(part.tolist(), self.around(chars, item, part)):
                places.setdefault(row.tobytes(), place)
        near = np.array(list(places.values()), dtype=np.int64)
        return np.tile(starts, len(near)), np.repeat(near, len(starts))

    def around(self, chars: np.ndarray, item: int, places: np.ndarray) -> np.ndarray:
        """What alignments at these places look at."""
        wide = 3 * self.band
        return windows_of(chars, places - wide, int(self.window[item]) + 2 * wide)

    def verified(self, chars: np.ndarray, item: int, starts: np.ndarray, places: np.ndarray
                 ) -> tuple[int, int] | None:
        """Start in the item and edits of the first stretch found at its place, if any.
        Those in the middle are looked at first: a long copy is found there."""
        w, k = int(self.window[item]), int(self.edits[item])
        order = np.argsort(np.abs(np.arange(len(starts)) - len(starts) // 2), kind="stable")
        at, size = 0, 32
        while at < len(order):
            part = order[at:at + size]
            at, size = at + size, min(4 * size, ALIGNED)
            edits = align(windows_of(self.chars[item], starts[part], w),
                          self.around(chars, item, places[part]), 3 * self.band)
            hits = np.flatnonzero(edits <= k)
            if len(hits):
                return int(starts[part[hits[0]]]), int(edits[hits[0]])
        return None

    def short_matches(self, text: str) -> list[tuple[object, int, int]]:
        """Items shorter than a q-gram that stand in the text as words."""
        found: set[str] = set()
        if self.short:
            for m in _WORD_START.finditer(text):
                for n in self.short_lengths:
                    end = m.start() + n
                    if (p := text[m.start():end]) in self.short and not _IN_WORD.match(text, end):
                        found.add(p)
        return [(i, 0, 0) for p in sorted(found) for i in self.short[p]]

    def matches(self, texts: list[str | None]) -> list[list[tuple[object, int, int]]]:
        """Per text: (item id, place in the item, edits), one for each item."""
        plains = [plain(t) for t in texts]
        out: list[list[tuple[object, int, int]]] = [self.short_matches(p) for p in plains]
        if not self.ids:
            return out
        done = 0
        while done < len(plains):
            size, upto = 0, done
            while upto < len(plains) and (upto == done or size + len(plains[upto]) < BATCH_CHARS):
                size += len(plains[upto]) + 1
                upto += 1
            part = plains[done:upto]
            # Line feeds are in no plain text, so no q-gram spans two texts.
            chars = codes("\n".join(part))
            at, item, place = self.shared(chars)
            starts = np.cumsum([0, *[len(p) + 1 for p in part]])
            which = np.searchsorted(starts, at, "right") - 1
            # Few q-grams of an item in a text: neither need be looked at.
            pair = which * len(self.ids) + item
            order = np.argsort(pair, kind="stable")
            pair, at, place = pair[order], at[order], place[order]
            cuts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else []
            for begin, end in zip(cuts, [*cuts[1:], len(pair)]):
                d, i = divmod(int(pair[begin]), len(self.ids))
                if end - begin < self.need[i]:
                    continue
                text = chars[starts[d]:starts[d + 1] - 1]
                s, t = self.candidates(text, i, at[begin:end] - starts[d], place[begin:end])
                found = self.verified(text, i, s, t) if len(s) else None
                if found:
                    out[done + d].append((self.ids[i], *found))
            done = upto
        return out


def indexes(items: DataFrame, key: str, text: str) -> Iterator[Index]:
    """Indexes of blocks of the items, each of about ``INDEX_CHARS`` characters."""
    rows = items.select(F.col(key).alias("i"), F.col(text).alias("t")).dropna()
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-chars // INDEX_CHARS)
    for block in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        yield Index([(r["i"], r["t"]) for r in own.orderBy("i").collect()])


def contaminations(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str,
                   item_text: str) -> DataFrame:
    """A row (key, item_id, place in the item, edits) per document and item found in it."""
    kinds = dict(docs.dtypes), dict(items.dtypes)
    if key in ("item_id", "item_start", "edits"):
        raise ValueError(f"{key} is the name of a result column")
    schema = f"`{key}` {kinds[0][key]}, item_id {kinds[1][item_key]}, item_start long, edits long"
    empty = docs.sparkSession.createDataFrame([], schema)
    to_arrow = to_arrow_schema(empty.schema)
    found = None
    for index in indexes(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        @frugal
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matches = shared.value.matches(batch.column(1).to_pylist())
                n = [len(m) for m in matches]
                flat = [x for m in matches for x in m]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))),
                     *[pa.array([x[j] for x in flat], to_arrow.field(j + 1).type)
                       for j in range(3)]], [key, "item_id", "item_start", "edits"])

        part = docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return empty if found is None else found


def clean(docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """The rows of ``docs`` without any item in them, columns unchanged."""
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    for index in indexes(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        @frugal
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matches = shared.value.matches(batch[text].to_pylist())
                yield batch.filter(pa.array([not m for m in matches], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
