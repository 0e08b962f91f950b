"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

The pieces of a model that encode to themselves are put into an Aho-Corasick
automaton. A text is encoded from left to right: at each place the longest
piece that matches there is tried first. Two adjacent pieces are compatible if
merging their joined characters anew gives these two again; a sequence whose
neighbours are all compatible is what the merges give for the whole, and there
is exactly one. If no piece fits, the last one is taken back and the next
shorter one is tried; a bit field marks the places from which the end cannot be
reached, so that none is tried twice.

No piece crosses from other characters to the space mark, so the text is cut
there and frequent segments are encoded once per worker. Characters that are no
piece become bytes, which never merge.

Nulls and empty texts have the end id alone and decode to the empty text.
"""
from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hotcache import HotCache, frugal, kept

MARK = "▁"
#: Segments whose ids a worker keeps.
CACHED_SEGMENTS = 300_000
#: Those of them that it keeps between tasks.
KEPT_SEGMENTS = 20_000
#: As many where ids and texts leave the worker: beside heaps that earlier stages filled.
LEAN_SEGMENTS = 100_000
_CUT = re.compile(f"(?<=[^{MARK}])(?={MARK})")


class Model:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = sp.normalize
        self.end_id, self.unk_id = sp.eos_id(), sp.unk_id()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [self.unk_id] * 256
        self.surface: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif sp.is_control(i):
                self.surface.append(b"")
            elif sp.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses into the space mark")


def merge(text: str, score: dict[str, float]) -> list[str]:
    """The defining procedure: join the best-scored adjacent pair, again and again."""
    parts: list[str | None] = list(text)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b < len(parts) and (s := score.get(joined := parts[a] + parts[b])) is not None:
            heapq.heappush(heap, (-s, a, b, joined))

    for i in range(len(parts) - 1):
        offer(i, i + 1)
    while heap:
        _, a, b, joined = heapq.heappop(heap)
        if parts[a] is None or parts[b] is None or after[a] != b or parts[a] + parts[b] != joined:
            continue
        parts[a], parts[b] = joined, None
        after[a] = after[b]
        if after[b] < len(parts):
            before[after[b]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [p for p in parts if p is not None]


class Encoder:
    """Ids of a segment by longest matches, compatibility and backtracking."""

    def __init__(self, model: Model, cached: int):
        import ahocorasick

        self.model = model
        self.known = {p for p in model.ids if merge(p, model.score) == [p]}
        self.chars = frozenset(p for p in self.known if len(p) == 1)
        self.piece = {model.ids[p]: p for p in self.known}
        self.size = max(self.piece, default=0) + 1
        #: By id: its length, and the longest piece that it begins with (-1: none). The
        #: pieces that match at a place are the longest one there and so on from it.
        self.length, self.shorter = [0] * self.size, [-1] * self.size
        self.automaton = ahocorasick.Automaton()
        for i, piece in self.piece.items():
            self.automaton.add_word(piece, i)
            self.length[i] = len(piece)
            self.shorter[i] = next((model.ids[piece[:k]] for k in range(len(piece) - 1, 0, -1)
                                    if piece[:k] in self.known), -1)
        self.automaton.make_automaton()
        #: By one number for both ids: a tuple of texts would take thrice the memory.
        self.fits = HotCache(self._fits, cached)

    def _fits(self, pair: int) -> bool:
        first, second = (self.piece[i] for i in divmod(pair, self.size))
        return merge(first + second, self.model.score) == [first, second]

    def pieces(self, text: str) -> list[str]:
        return [self.piece[i] for i in self.piece_ids(text)]

    def piece_ids(self, text: str) -> list[int]:
        """The ids of the pieces of ``text``, all of whose characters are pieces."""
        n, length, shorter = len(text), self.length, self.shorter
        longest = [-1] * n
        for end, i in self.automaton.iter(text):
            longest[end - length[i] + 1] = i  # in growing order for each start
        fits, size, failed = self.fits, self.size, 0
        path: list[int] = []
        at, last, i = 0, -1, longest[0] if n else -1
        while at < n:
            while i >= 0:
                to = at + length[i]
                if not failed >> to & 1 and (last < 0 or fits[last * size + i]):
                    path.append(i)
                    at, last, i = to, i, longest[to] if to < n else -1
                    break
                i = shorter[i]
            else:
                failed |= 1 << at
                taken = path.pop()
                at -= length[taken]
                last, i = path[-1] if path else -1, shorter[taken]
        return path

    def segment(self, text: str) -> list[int]:
        model, out, run = self.model, [], 0
        if self.chars.issuperset(text):
            return self.piece_ids(text)
        for i, c in enumerate([*text, None]):
            if c is None or c not in self.known:
                if run < i:
                    out += self.piece_ids(text[run:i])
                if c is not None:
                    out += [model.byte_ids[b] for b in c.encode()] if c not in model.ids \
                        else [model.ids[c]]
                run = i + 1
        return out


#: Decimal ids joined by spaces; with them what they decode to, where that is not the
#: text they come from. Most are kept as the ids alone, so that caches stay small.
Coded = str | tuple[str, bytes]


class Codec:
    """Whole texts to ids with the end id, and ids to text."""

    def __init__(self, path: str, cached: int = CACHED_SEGMENTS):
        self.model = Model(path)
        self.encoder = Encoder(self.model, cached * 5 // 3)
        #: By segment, without the mark that each begins with.
        self.cache = HotCache(self._encoded, cached)
        self.parts = HotCache(self._part, cached)
        #: Adjacent characters that stand in a piece; nothing merges across others.
        self.joined = {p[i:i + 2] for p in self.model.ids for i in range(len(p) - 1)}

    def trim(self) -> None:
        """What is left when a task ends: idle workers hold no more."""
        for cache in (self.cache, self.parts, self.encoder.fits):
            cache.trim(KEPT_SEGMENTS)

    def _part(self, part: str) -> Coded:
        ids = self.encoder.segment(part)
        joined, raw = " ".join(map(str, ids)), self.surface(ids)
        return joined if raw == _raw(part) else (joined, raw)

    def _encoded(self, word: str) -> Coded:
        joined, segment = self.joined, MARK + word
        if joined.issuperset(map(add, segment, word)):
            return self._part(segment)
        cuts = [i for i in range(1, len(segment)) if segment[i - 1:i + 1] not in joined]
        texts = [segment[a:b] for a, b in zip([0, *cuts], [*cuts, len(segment)])]
        ids, raw = self._whole(texts, [self.parts[x] for x in texts])
        return " ".join(ids) if raw is None else (" ".join(ids), raw)

    @staticmethod
    def _whole(texts: list[str], found: list[Coded]) -> tuple[list[str], bytes | None]:
        """Ids of each text, and what all decode to if that is not the texts."""
        if all([x.__class__ is str for x in found]):
            return found, None
        return ([x if isinstance(x, str) else x[0] for x in found],
                b"".join([_raw(t) if isinstance(x, str) else x[1]
                          for t, x in zip(texts, found)]))

    def surface(self, ids: list[int]) -> bytes:
        surface = self.model.surface
        return b"".join([surface[i] for i in ids])

    @staticmethod
    def words(text: str) -> list[str]:
        """The marked text, cut before each run of space marks; the first mark of each
        segment is left out."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            return [x[1:] for x in _CUT.split(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def encode(self, text: str | None) -> str:
        """Decimal ids with the end id, joined by spaces."""
        return self.both(text)[0]

    def both(self, text: str | None) -> tuple[str, str]:
        """Decimal ids and the text that they decode to."""
        cache, words = self.cache, self.words(text or "")
        found = [cache[x] for x in words]
        if all([x.__class__ is str for x in found]):  # each decodes to itself
            ids, decoded = found, " ".join(words).replace(MARK, " ")
        else:
            ids, raw = self._whole([MARK + x for x in words], found)
            decoded = self._text(raw)
        return " ".join([*ids, str(self.model.end_id)]), decoded

    @staticmethod
    def _text(raw: bytes) -> str:
        # The mark put before the first word is taken off again.
        return raw.decode("utf-8", "replace").removeprefix(" ")

    def decode(self, ids: list[int]) -> str:
        return self._text(self.surface(ids))


def _raw(text: str) -> bytes:
    return text.replace(MARK, " ").encode()


def codec(path: str, cached: int = CACHED_SEGMENTS) -> Codec:
    """One per worker and model; it goes when another operator runs in the worker."""
    return kept(("codec", path, cached), lambda: Codec(path, cached))


def encode_decode(docs: DataFrame, text: str, model: str) -> DataFrame:
    """``docs`` with ids (decimal, joined by spaces), n_tokens and decoded text."""
    for name in ("ids", "n_tokens", "decoded"):
        if name in docs.columns:
            docs = docs.drop(name)
    names = docs.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(model, LEAN_SEGMENTS).both
        for batch in batches:
            for part in _slices(batch, text):
                pairs = [both(t.as_py()) for t in part[text]]
                ids = [p[0] for p in pairs]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.string()),
                     pa.array([x.count(" ") + 1 for x in ids], pa.int64()),
                     pa.array([p[1] for p in pairs], pa.string())],
                    [*names, "ids", "n_tokens", "decoded"])
        codec(model, LEAN_SEGMENTS).trim()

    return docs.mapInArrow(run, f"{schema}, ids string, n_tokens long, decoded string")


def _slices(batch: pa.RecordBatch, text: str, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Parts of a batch: what a part becomes is several times its size."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def digest(docs: DataFrame, key: str, text: str, model: str) -> DataFrame:
    """Key, n_tokens, ids_sha256 and decoded_sha256, made beside the encoding
    so that neither ids nor texts leave the worker."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(model).both
        for batch in batches:
            rows = []
            for t in batch[text]:
                ids, decoded = both(t.as_py())
                rows.append((ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(),
                             hashlib.sha256(decoded.encode()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch[key], *[pa.array([r[i] for r in rows], kind) for i, kind in
                               enumerate((pa.int64(), pa.string(), pa.string()))]],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"])
        codec(model).trim()

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text)).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
