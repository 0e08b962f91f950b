"""Token files and SentencePiece coding against the libraries themselves."""
from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import eliasfano, hotcache, queries, spbpe

from .conftest import AWKWARD, LONG, SF

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = tokenizers.Tokenizer.from_file(BPE)
SP = sentencepiece.SentencePieceProcessor(model_file=PIECE)
MINE, CODEC = eliasfano.ByteBpe(BPE, 0, cached=300), spbpe.Codec(PIECE, cached=300)
ALPHABET = [*" \n\t  abTHé'sß漢🙂▁​\u0085\x00　1.,!-_", "<|endoftext|>", "the ",
            " and", "<s>", "</s>", "<0x0A>", "word's", "\n\nnew", "   ", ".\nThe"]


def noise(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


def test_packed_ids_equal_the_library(texts):
    for text in [*noise(1500), *texts.values(), "", LONG]:
        want = LIBRARY.encode(text, add_special_tokens=False).ids + [0]
        assert np.frombuffer(MINE.encode([text])[0], MINE.dtype).tolist() == want


def test_batches_equal_single_texts():
    some = noise(400)
    assert MINE.encode(some) == [MINE.encode([t])[0] for t in some]


@given(st.lists(st.integers(0, 3000), max_size=300))
@settings(max_examples=80, deadline=None)
def test_boundaries_round_trip(lengths):
    docs = [np.full(n, 7, "<u2").tobytes() for n in lengths]
    ids, bounds = eliasfano.unpack_segment(eliasfano.pack_segment(docs, 2))
    ends = np.cumsum(lengths).tolist() if lengths else []
    assert len(ids) == sum(lengths) and bounds.all().tolist() == ends
    assert [bounds.end(i) for i in range(len(ends))] == ends
    with pytest.raises(IndexError):
        bounds.end(len(ends))


def test_boundaries_are_small():
    lengths = np.random.default_rng(1).integers(1, 2000, 5000)
    _, lows, highs, samples = eliasfano.pack_boundaries(np.cumsum(lengths))
    assert 8 * len(lows + highs + samples) < 5000 * (2.6 + np.log2(lengths.mean()))


def test_file_round_trip(spark, awkward, tmp_path):
    path = str(tmp_path / "ids")
    eliasfano.write(awkward, "doc_id", "text", path, BPE, segment_ids=500)
    got = sorted(rows(eliasfano.read(spark, path, "doc_id")), key=lambda r: r[1])
    assert [r[0] for r in got] == [i for i, _ in AWKWARD]  # ascending, null first
    ids = {t: np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
           for _, t in AWKWARD}
    want = sorted((repr(i), len(ids[t]), zlib.crc32(ids[t].tobytes())) for i, t in AWKWARD)
    assert sorted((repr(r[0]), r[2], r[3]) for r in got) == want
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]


def test_empty_file(spark, empty, tmp_path):
    eliasfano.write(empty, "doc_id", "text", str(tmp_path / "e"), BPE)
    assert rows(eliasfano.read(spark, str(tmp_path / "e"), "doc_id")) == []


def test_op4_brute_force(spark, texts):
    start, want = 0, []
    for i in sorted(texts):
        ids = np.array(LIBRARY.encode(texts[i], add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(queries.op4_elias_fano(spark, SF)) == sorted(want, key=repr)


def test_pieces_equal_the_library(texts):
    for text in [*noise(1500), *texts.values(), "", LONG]:
        ids = SP.encode(text, add_eos=True)
        assert CODEC.both(text) == (" ".join(map(str, ids)), SP.decode(ids))
        assert CODEC.decode(ids) == SP.decode(ids) and CODEC.encode(text) == CODEC.both(text)[0]


def test_backtracking_equals_merging():
    rnd, score = random.Random(3), CODEC.model.score
    letters = "aeinorst▁"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14)))
        assert CODEC.encoder.pieces(text) == spbpe.merge(text, score)


def test_sentencepiece_frames(spark, awkward, empty):
    got = spbpe.encode_decode(awkward.withColumnRenamed("node", "ids"), "text", PIECE)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens",
                           "decoded"]
    want = sorted((repr(i), " ".join(map(str, SP.encode(t or "", add_eos=True))),
                   SP.decode(SP.encode(t or ""))) for i, t in AWKWARD)
    assert sorted((repr(r[0]), r[1], r[2]) for r in rows(got, "doc_id", "ids", "decoded")) == want
    assert spbpe.encode_decode(empty, "text", PIECE).count() == 0


def test_op9_brute_force(spark, texts):
    want = []
    for i, text in texts.items():
        ids = SP.encode(text, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(SP.decode(ids).encode()).hexdigest()))
    assert rows(queries.op9_sentencepiece(spark, SF)) == sorted(want, key=repr)


def test_worker_state_is_small_and_of_one_operator():
    """Ids alone are kept of words that decode to themselves; the next operator's state
    takes the place of the codec."""
    first = spbpe.codec(PIECE)
    assert spbpe.codec(PIECE) is first
    for text in ["plain words, and more of them", "mit Umlauten: größer", " ▁ marks  ▁x ",
                 "語彙の\x00ない文字 \U0001f9ff\U000e0001"]:
        ids = SP.encode(text, add_eos=True)
        if SP.decode(ids) == text:
            assert first.both(text) == (" ".join(map(str, ids)), text)
    assert first.cache and all(isinstance(x, str) for x in first.cache.values())
    assert all(isinstance(x, int) for x in first.encoder.fits)
    first.cache.update({str(i): "0" for i in range(2 * spbpe.KEPT_SEGMENTS)})
    first.cache.old = dict(first.cache)
    first.trim()
    assert len(first.cache) == spbpe.KEPT_SEGMENTS and not first.cache.old
    assert first.both("plain words, and more of them")[1] == "plain words, and more of them"
    hotcache.kept("another operator", dict)
    assert spbpe.codec(PIECE) is not first
    hotcache.release()
    assert not hotcache._KEPT


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    given = []
    monkeypatch.setattr(hotcache, "give_back", lambda: given.append(1))
    run = hotcache.frugal(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(run) == 2 and not given
    assert list(run) == [3] and given == [1]


def test_shorter_pieces_are_all_that_a_piece_begins_with():
    """From the longest piece at a place the others there follow, without lists of them."""
    encoder = CODEC.encoder
    for i, piece in [*encoder.piece.items()][::97]:
        chain = [i]
        while encoder.shorter[chain[-1]] >= 0:
            chain.append(encoder.shorter[chain[-1]])
        assert [encoder.piece[x] for x in chain] == [
            piece[:k] for k in range(len(piece), 0, -1) if piece[:k] in encoder.known]


def test_tokenizer_stays_with_the_worker():
    first = eliasfano.byte_bpe(BPE, 0)
    assert eliasfano.byte_bpe(BPE, 0) is first
    assert eliasfano.byte_bpe(BPE, 1) is not first
    hotcache.release()


def test_new_words_go_to_the_model(monkeypatch):
    """Words of letters need no other part of the tokenizer than its model."""
    texts = ["Plain words only", "größer Ãéÿ naïve x\nBÖSE", " one"]
    mine, sent = eliasfano.ByteBpe(BPE, 0), []
    ids = mine._ids
    monkeypatch.setattr(mine, "_ids", lambda t: sent.extend(t) or ids(t))
    got = [np.frombuffer(x, mine.dtype).tolist() for x in mine.encode(texts)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert sent == ["\n"]
    again = mine.whole.held
    mine.whole.held, mine.whole.old = {}, again
    assert mine.whole.found([b" only", b" none"]) == [again[b" only"], None]
    assert mine.whole.held == {b" only": again[b" only"]}


def test_segments_are_read_without_a_shuffle(spark, awkward, tmp_path):
    path, limit = str(tmp_path / "s"), "spark.sql.autoBroadcastJoinThreshold"
    eliasfano.write(awkward, "doc_id", "text", path, BPE, segment_ids=500)
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = eliasfano.read(spark, path, "doc_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert re.search(r"\w+Join\b", plan)[0] == "BroadcastHashJoin"


def test_pairs_are_kept_in_proportion():
    """A codec for a few segments holds few pairs of pieces too."""
    assert CODEC.encoder.fits.limit == 500
    assert spbpe.LEAN_SEGMENTS < spbpe.CACHED_SEGMENTS
