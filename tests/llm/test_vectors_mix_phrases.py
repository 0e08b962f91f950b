"""Whitening, mixing and collocations."""
from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import collocations, mixing, queries, whitening

from .conftest import SF

# ---- whitening -------------------------------------------------------------


def scaled(vector, scale=64):
    return tuple(math.floor(scale * float(v)) for v in vector)


def brute_covariance(vectors):
    n, dim = len(vectors), len(vectors[0])
    mean = [Fraction(sum(v[i] for v in vectors), n) for i in range(dim)]
    return np.array([[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in vectors) / n)
                      for j in range(dim)] for i in range(dim)]), mean


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(
        rows, f"id long, v array<{kind}>, component string, n int")


def vectors(n, dim, seed=1, spread=3.0, offset=40.0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) * spread + offset
    return mixed.astype(np.float32).tolist()


def test_whitened_rows_equal_brute_force(spark):
    data = vectors(60, 5)
    rows = [(i, v, "x", 7) for i, v in enumerate(data + data[:9])]
    odd = [(100, None, "x", 7), (101, [], "x", 7), (102, [1.0, None, 1.0, 1.0, 1.0], "x", 7),
           (103, [math.nan] * 5, "x", 7), (104, [math.inf] * 5, "x", 7),
           (105, [1.0, 2.0], "x", 7), (None, data[0], "x", 7)]
    got = whitening.whitened(frame(spark, rows + odd), "id", "v", components=4).collect()
    fit = sorted({scaled(v) for v in data})
    cov, mean = brute_covariance(fit)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    of = {}
    for r in got:
        of.setdefault(r["id"], []).append(r)
    assert set(of) == {*range(69), None} and all(len(v) == 4 for v in of.values())
    assert {r["n"] for r in got} == {len(fit)} and {r["identity_error"] < 1e-9 for r in got} == {True}
    for i, v, *_ in rows:
        x = scaled(v)
        exact = sum((len(fit) * a - len(fit) * m) ** 2 for a, m in zip(x, mean))
        assert {r["deviation"] for r in of[i]} == {int(exact)}
    # The components are orthogonal directions of unit variance with falling eigenvalues.
    w = np.array([[r["whitened"] for r in sorted(of[i], key=lambda r: r["component"])]
                  for i in range(60)])
    first = {scaled(v): i for i, v in reversed(list(enumerate(data)))}
    at = w[[first[x] for x in fit]]
    assert np.allclose(at.T @ at / len(fit), np.eye(4), atol=1e-9)
    centred = np.array([[float(a - m) for a, m in zip(x, mean)] for x in fit])
    assert np.allclose((centred.T @ at / len(fit)).T @ (centred.T @ at / len(fit)),
                       np.diag(values[:4]), rtol=1e-9, atol=1e-9)
    explained = [r["explained"] for r in sorted(of[0], key=lambda r: r["component"])]
    assert np.allclose(explained, values[:4] / np.trace(cov), rtol=1e-9)


def test_covariance_by_polarisation_is_exact_far_from_zero():
    data = [[10 ** 9 + i % 7, -10 ** 9 + i * i % 5, 3 * i % 11] for i in range(50)]
    total = [sum(v[i] for v in data) for i in range(3)]
    middle = [t // 50 for t in total]
    z = np.array(data, dtype=np.int64).T - np.array(middle)[:, None]
    single = whitening.square_sums(z)
    pairs = {(i, j): whitening.square_sums(z[j:j + 1] + z[i])[0]
             for i in range(3) for j in range(i + 1, 3)}
    rest = [t - 50 * m for t, m in zip(total, middle)]
    assert np.allclose(whitening.covariance(50, rest, single, pairs),
                       brute_covariance(data)[0], rtol=1e-15, atol=0)


def test_square_sums_of_any_size_are_exact():
    rng = random.Random(3)
    for bits in (3, 25, 26, 40, 46):
        p = np.array([[rng.randrange(-2 ** bits, 2 ** bits) for _ in range(50)] for _ in range(4)])
        assert whitening.square_sums(p) == [sum(v * v for v in row) for row in p.tolist()]


def test_very_large_entries_and_deviations_beyond_64_bits(spark):
    data = [[2.0 ** 38, 0.5], [-2.0 ** 38, 0.25], [3.0, 2.0 ** 30]]
    got = whitening.whitened(frame(spark, [(i, v, "", 0) for i, v in enumerate(data)]
                                   + [(9, [2.0 ** 40, 0.0], "", 0)], "double"), "id", "v").collect()
    assert {r["id"] for r in got} == {0, 1, 2} and {r["n"] for r in got} == {3}
    assert all(r["deviation"] is None for r in got if r["id"] < 2)


def test_no_variance_no_rows(spark):
    same = frame(spark, [(i, [1.0, 2.0], "", 0) for i in range(5)])
    assert whitening.whitened(same, "id", "v").count() == 0
    assert whitening.whitened(same.limit(0), "id", "v").count() == 0
    flat = frame(spark, [(i, [float(i), 2.0 * i, 0.0], "", 0) for i in range(5)])
    assert whitening.whitened(flat, "id", "v").filter("component > 1").count() == 0
    with pytest.raises(ValueError):
        whitening.whitened(same.withColumnRenamed("n", "m").withColumnRenamed("id", "n"), "n", "v")


def test_op11_covers_all_rows(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.op11_whitening(spark, SF)
    assert got.count() == 16 * rows.count() and got.agg(F.max("identity_error")).first()[0] < 1e-9


# ---- mixing ----------------------------------------------------------------


def brute_targets(sizes, weights, share, most):
    """Rounds of sharing, with fractions."""
    left, open_, target = Fraction(share) * sum(sizes.values()), set(sizes), {}
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > Fraction(most) * sizes[s]}
        if not over:
            target |= {s: unit * weights[s] for s in open_}
            break
        target |= {s: Fraction(most) * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return {s: float(t) for s, t in target.items()}


def copies(key, rate):
    u = (int(hashlib.md5(f"mix/{'null' if key is None else key}".encode()).hexdigest()[:13], 16)
         + 0.5) / 2 ** 52
    return math.floor(rate) + (u < rate - math.floor(rate))


@pytest.mark.parametrize("share,most", [(1.5, 2.0), (0.4, 3.0), (2.9, 3.0), (5.0, 2.0)])
def test_targets_and_copies(spark, share, most):
    rng = random.Random(5)
    docs = [(i, rng.choice(["a", "B", "b", "ä", None, "z" * 40]), rng.randrange(50))
            for i in range(300)]
    docs += [(None, "a", 5), (7, "empty", 0), (8, "empty", 0), (9, None, None)]
    df = spark.createDataFrame([(*d, "t", 1, 2.0) for d in docs],
                               "id long, src string, size long, rank string, _of int, target double")
    stored = queries.stored(df, "mix-test")[0]
    mix = mixing.mixed(stored, "id", "src", "size",
                       lambda r: F.element_at(F.array(*map(F.lit, [5, 2, 1])),
                                              (r % 3 + 1).cast("int")), share, most)
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n or 0
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    want = brute_targets(dict(sizes), weights, share, most)
    got = mix.collect()
    assert len(got) == len(docs) and set(mix.columns) == {*df.columns, "source_size", "copies"}
    for r in got:
        assert r["source_size"] == sizes[r["src"]]
        assert r["target"] == pytest.approx(want[r["src"]])
        rate = want[r["src"]] / sizes[r["src"]] if sizes[r["src"]] else 0
        assert r["copies"] == copies(r["id"], rate) <= math.ceil(most)
    out = mixing.repeated(mix).groupBy("id", "src", "size").count().collect()
    assert Counter({(r["id"], r["src"], r["size"]): r["count"] for r in out}) == Counter(
        {(r["id"], r["src"], r["size"]): r["copies"] for r in got if r["copies"]})


def test_taken_sizes_come_near_the_targets(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 20)).alias("src"), (F.col("id") % 97).alias("size"))
    stored = queries.stored(df, "mix-test")[0]
    got = mixing.mixed(stored, "id", "src", "size", lambda r: F.lit(1) + r % 4).groupBy(
        "src").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                   F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.12 for r in got) and len(got) > 10


def test_an_empty_mix(spark, empty):
    assert mixing.mixed(empty, "doc_id", "source", "n_chars", lambda r: F.lit(1)).count() == 0


def test_words(spark, awkward):
    got = awkward.select("text", mixing.words(F.col("text")).alias("n")).collect()
    assert all(r["n"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in got)


# ---- collocations ----------------------------------------------------------


def brute_phrases(docs, support):
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for g in (1, 2, 3):
                for i in range(len(w) - g + 1):
                    f[lang, " ".join(w[i:i + g])] += 1
    return f, total


def brute_collocations(docs, support, best, covered=50):
    f, total = brute_phrases(docs, support)
    rows = {}
    for (lang, p), a in f.items():
        w = p.split(" ")
        if len(w) < 2 or a < support:
            continue
        if len(w) == 2 and any(
                q.startswith(p + " ") or q.endswith(" " + p) for (other, q), b in f.items()
                if other == lang and q.count(" ") == 2 and b >= support and 100 * b >= covered * a):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, p.encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, le, ri, total[lang], -s) for lang, found in rows.items()
            for i, (s, a, p, le, ri) in enumerate(sorted(found)[:best])}


def phrase_docs(seed, n=150):
    rng = random.Random(seed)
    words = ["New", "new", "york", "the", "of", "é", "漢字", "a.b", "x\x00y", "the", "big", "city"]
    docs = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" "] * 8 + ["\t", "  ", ". ", "\n", ",", "! "])
                       for _ in range(rng.randrange(40)))
        docs.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return docs + [("en", None), ("en", ""), ("fr", " . ,"), ("en", "new york " * 3000)]


@pytest.mark.parametrize("support,best,shards", [(10, 2000, 3), (4, 7, 2), (3, 2000, 5), (1, 50, 3)])
def test_collocations_equal_brute_force(spark, support, best, shards):
    docs = phrase_docs(support)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "lang string, t string, phrase string, n int")
    df = queries.stored(df.repartition(7), "phrases-test")[0]
    got = collocations.collocations(df, "lang", "t", support, best, shards=shards).collect()
    assert {tuple(r) for r in got} == brute_collocations(docs, support, best)
    assert len(got) == len({tuple(r) for r in got})


def test_every_phrase_of_the_support_is_frequent_in_a_shard(spark):
    docs = phrase_docs(11, 400)
    df = queries.stored(spark.createDataFrame(docs, "lang string, t string").repartition(6), "t")[0]
    f, _ = brute_phrases(docs, 10)
    got = collocations.frequent_phrases(df, "lang", "t", 10, 3).filter("length > 0").collect()
    assert {((r["lang"], r["phrase"]), r["f"]) for r in got} == {
        (p, n) for p, n in f.items() if n >= 10}


def test_no_phrases(spark, empty, awkward):
    assert collocations.collocations(empty, "lang", "text").count() == 0
    found = collocations.collocations(awkward, "lang", "text").collect()
    assert found and {r["lang"] for r in found} == {"en"}


def test_blocks_are_cut_between_texts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(collocations, "BLOCK", 20)
    batch = pa.record_batch({"l": ["a", "b", None, "a"], "t": ["x y", "z " * 30, "q", "x y z"]})
    found = Counter()
    for w in collocations.blocks([batch]):
        for i in w.at[2]:
            found[w.langs[w.lang[w.id[i]]], w.word[int(w.id[i])].as_py()] += 1
    assert found == Counter({("a", "x"): 2, ("a", "y"): 1, ("b", "z"): 29})


def test_counts_are_held_once_and_packed_whole():
    keys = [np.array([1 << 40, 5 << 40, 9 << 50]), np.array([5 << 40, 9 << 50])]
    counts = [np.array([1, 255, 300]), np.array([1, 255])]
    key, n = collocations.summed(keys, counts)
    assert not keys and not counts
    assert dict(zip(key.tolist(), n.tolist())) == {1 << 40: 1, 5 << 40: 256, 9 << 50: 555}
    rows = collocations.packed(key, n, 1, 8).to_pylist()
    assert [r["bucket"] for r in rows] == sorted({r["bucket"] for r in rows})
    assert sum(sum(r["counts"]) for r in rows) == 812
    assert all(len(r["keys"]) == 4 * len(r["counts"]) for r in rows)
