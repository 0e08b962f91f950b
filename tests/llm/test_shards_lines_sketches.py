"""Shards, line frequency and fingerprints."""
from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from compare import compare, oracle
from conftest import rows
from pyspark.sql import functions as F

from ordermill.llm import linefreq, queries, rendezvous, sketch

from .conftest import AWKWARD, SF


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, name):
    assert compare(spark, SF, oracle(SF), queries.QUERIES[name], queries.ORACLES[name]) is None


def shards(spark, weights, n=4000):
    df = rendezvous.with_shard(spark.range(n), "id", weights)
    return {r["id"]: r["shard"] for r in df.collect()}


def test_shares_follow_the_weights(spark):
    counts = Counter(shards(spark, [1, 2, 5]).values())
    assert abs(counts[0] - 500) < 100 and abs(counts[2] - 2500) < 150


def test_a_new_shard_only_takes(spark):
    before, after = shards(spark, [1, 1, 1, 2]), shards(spark, [1, 1, 1, 2, 1])
    moved = [i for i in before if before[i] != after[i]]
    assert all(after[i] == 4 for i in moved) and abs(len(moved) - 4000 / 6) < 120


def test_bad_weights(spark):
    with pytest.raises(ValueError):
        rendezvous.shard_of(F.lit(1), [1, 0])


def test_slots_are_gapless(spark, awkward, empty):
    df = awkward.union(awkward.filter("doc_id = 5")).withColumn("size", F.length("text"))
    placed = rendezvous.with_shard(df, "doc_id", [1, 1, 1])
    got = rows(rendezvous.with_slots(placed, "shard", ["doc_id", "size"], bucket_rows=2),
               "shard", "slot")
    assert len(got) == len(AWKWARD) + 1
    for shard in {s for s, _ in got}:
        assert sorted(n for s, n in got if s == shard) == list(range(
            sum(s == shard for s, _ in got)))
    none = rendezvous.with_shard(empty, "doc_id", [1, 1])
    assert rendezvous.with_slots(none, "shard", ["doc_id"]).count() == 0


def test_boilerplate_lines(spark):
    pages = [(i, "a", f"head\nbody {i}\n\nhead \nfoot") for i in range(10)]
    pages += [(20 + i, "b", "head\nrare") for i in range(3)] + [(30, None, "head"), (31, "a", None),
                                                               (32, "a", "head")]
    df = spark.createDataFrame(pages, "id int, site string, text string").withColumns(
        {c: F.lit(c) for c in ("_lines", "_kept", "_site", "n_dropped")})
    out = linefreq.drop_boilerplate(df, "site", "text", ratio=0.5, min_pages=4)
    assert out.columns == df.columns and out.filter("_lines <> '_lines'").count() == 0
    got = {r["id"]: (r["text"], r["n_dropped"]) for r in
           linefreq.drop_boilerplate(df, "site", "text", ratio=0.5, min_pages=4).collect()}
    assert got[3] == ("body 3\n", 3) and got[20] == ("head\nrare", 0)
    assert got[30] == ("head", 0) and got[31] == (None, 0) and got[32] == ("", 1)
    assert len(got) == len(pages)


def test_ratio_is_exceeded_not_met(spark):
    df = spark.createDataFrame([(i, "s", "x" if i < 5 else "y") for i in range(10)],
                               "id int, site string, text string")
    assert linefreq.boilerplate(df, "site", "text", ratio=0.5, min_pages=1).count() == 0
    assert linefreq.boilerplate(df, "site", "text", ratio=0.4, min_pages=1).count() == 1


def test_lines_awkward(spark, awkward, empty):
    got = linefreq.drop_boilerplate(awkward, "source", "text")
    assert got.columns == [*awkward.columns, "n_dropped"] and got.count() == len(AWKWARD)
    assert linefreq.drop_boilerplate(empty, "source", "text").count() == 0


def expected_edits(pairs):
    """(doc_id, n_chars, sha of the edited text) by the definition, distinct rows in order."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in pairs})
    out = {}
    for at, (z, i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][2]
        n = len(t) // 4
        edited = t[:len(t) - n] + after[:n]
        out[(i if z else None, t)] = (len(t), hashlib.sha256(edited.encode()).hexdigest())
    return out


def test_op5_brute_force(spark, texts):
    got = queries.op5_threshold_sketch(spark, SF).collect()
    want = expected_edits(texts.items())
    assert len(got) == len(texts)
    prints = {}
    for r in got:
        text = texts[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == want[r["doc_id"], text]
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"] != ""
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    mean = [sum(r[c] for r in got) / len(got) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.6 and mean[1] < 0.05


def test_next_of_awkward_rows(spark, awkward, empty):
    unique = {(i, t or "") for i, t in AWKWARD}
    got = sketch.with_next(awkward, "doc_id", "text").collect()
    assert len(got) == len(AWKWARD)
    last = max((i for i, _ in AWKWARD if i is not None))
    first = next(t for i, t in AWKWARD if i is None)
    for r in got:
        assert (r["doc_id"], r["text"]) in unique
        if r["doc_id"] == last:
            assert r["next_start"] == first[:len(r["text"]) // 4]
        if r["doc_id"] == 4:
            assert r["next_start"] == ""
    assert sketch.with_next(empty, "doc_id", "text").count() == 0


def test_sketch_keeps_what_is_below(spark):
    df = spark.createDataFrame([(" ".join(f"a{i}" for i in range(n)),) for n in (1000, 3)], "t string")
    long, short = sketch.with_sketch(df, "t", "s").orderBy(F.length("t").desc()).collect()
    assert 80 < len(long["s"]) < 175 and all(h < -(2 ** 63) + 2 ** 61 for h in long["s"])
    assert len(short["s"]) == 1


def test_merging_and_containment(spark):
    words = [f"b{i}" for i in range(3000)]
    both = [" ".join(words[:1500]), " ".join(words[1496:]), " ".join(words), " ".join(words[:300])]
    df = sketch.with_sketch(spark.createDataFrame(list(enumerate(both)), "i int, t string"), "t", "s")
    s = {r["i"]: r["s"] for r in df.collect()}
    assert sorted({*s[0], *s[1]}) == s[2]
    one = spark.createDataFrame([(s[3], s[2], s[0], s[1])], "a array<long>, b array<long>, c array<long>, d array<long>")
    r = one.select(sketch.containment(F.col("a"), F.col("b")), sketch.containment(F.col("c"), F.col("d")),
                   sketch.merged(F.col("c"), F.col("d"))).first()
    assert r[0] == 1.0 and r[1] < 0.05 and r[2] == s[2]


def test_crc_and_sizes(spark, texts):
    got = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in queries.op2_rendezvous(spark, SF).collect()}
    assert got == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
