"""WARC derivatives, decontamination, quality, near-duplicates, licenses, the pipeline."""
from __future__ import annotations

import base64
import hashlib
import pickle
import random
import re
import textwrap
import time
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin
from zlib import crc32

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm import decontaminate, license_join, lshforest, quality, queries, warc

from .conftest import AWKWARD, SF

PAGE = """<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><style>p{}</style></head>
<body><script>var t="</p>";</script><!-- <a href="/no">x</a> --><p>One <b>two</b></p>
<a href="/x#f">x</a><a href='http://o.org/'>o</a> <a href=/x>again</a>
<a href="mailto:a@b.c">m</a> 1 &lt; 2</body></html>"""


# ---- WARC --------------------------------------------------------------------

def test_derived_records():
    meta, text = warc.derive("<urn:a>", "http://h.org/d/p", "2024-01-01T00:00:00Z",
                             "HTTP/1.1 200 OK\r\nServer: x:1", PAGE)
    block = dict(zip(warc.NAMES, text))
    assert block["block"] == "One two\nx o again\nm 1 < 2".replace("x o", "xo")
    digest = "sha1:" + base64.b32encode(hashlib.sha1(PAGE.encode()).digest()).decode()
    own = "sha1:" + base64.b32encode(hashlib.sha1(block["block"].encode()).digest()).decode()
    assert block["payload_digest"] == digest and block["block_digest"] == own
    assert block["content_length"] == len(block["block"].encode())
    fields = dict(zip(warc.NAMES, meta))
    assert [x for x in fields["block"].split("\r\n") if x.startswith("outlink")] == [
        "outlink: http://h.org/x", "outlink: http://o.org/"]
    for line in ("title: A & B", "language: en", "http-server: x:1", "payload-digest: " + digest,
                 "http-status: HTTP/1.1 200 OK", "conversion: " + block["record_id"]):
        assert line in fields["block"].split("\r\n")
    for row in (block, fields):
        assert "WARC-Refers-To: <urn:a>\r\n" in row["header"] and row["refers_to"] == "<urn:a>"
        assert f"Content-Length: {row['content_length']}\r\n" in row["header"]


def test_pages_with_gaps(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "http://[bad", '<a href="//[x">y</a>'),
                                   (2, "u", ""), (None, "u", "<p>t"), (5, "u", "x" * 300_000)],
                                  "page_id long, url string, html string")
    out = warc.derivatives(warc.responses(pages, "page_id", "url", "html", "d"))
    got = out.collect()
    assert len(got) == 10 and Counter(r["warc_type"] for r in got) == {"metadata": 5, "conversion": 5}
    assert max(r["content_length"] for r in got) == 300_000
    assert {r["source_key"] for r in got} == {1, 2, None, 5}
    none = warc.derivatives(warc.responses(pages.limit(0), "page_id", "url", "html", "d"))
    assert none.count() == 0


def test_op1_covers_all_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op1_warc(spark, SF).collect()
    assert len(got) == 2 * len(pages) == 2 * len({r["refers_to"] for r in got})
    for r in got:
        page = pages[r["source_key"]]
        assert r["target"] == page["url"] and r["payload_digest"] == warc.sha1(page["html"].encode())
        assert "<" not in r["block"] or r["warc_type"] == "metadata" or "&lt;" in page["html"]


class Parsed(HTMLParser):
    """A page's lines of text and links, by the standard library's parser."""

    def __init__(self, html, target):
        super().__init__(convert_charrefs=True)
        self.target, self.hidden, self.out, self.found = target, 0, [], []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in warc.HIDDEN:
            self.hidden += 1
        if tag in warc.BLOCKS and not self.hidden:
            self.out.append("\n")
        href = dict(attrs).get("href") if tag == "a" and not self.hidden else None
        if href:
            self.found.append(urljoin(self.target, " ".join(href.split()).partition("#")[0]))

    def handle_endtag(self, tag):
        self.hidden -= tag in warc.HIDDEN
        if tag in warc.BLOCKS and not self.hidden:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)

    def lines(self):
        text = "".join(self.out)
        return [x for x in (" ".join(line.split()) for line in text.split("\n")) if x]


def test_op1_equals_a_parser(spark):
    """Text and links of all pages against the library's parser."""
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    checked = 0
    for r in queries.op1_warc(spark, SF).collect():
        page = pages[r["source_key"]]
        want = Parsed(page["html"], page["url"])
        if r["warc_type"] == "conversion":
            assert [" ".join(x.split()) for x in r["block"].split("\n") if x.strip()] == want.lines()
            assert "WARC-Concurrent-To" not in r["header"]
        else:
            got = [x[9:] for x in r["block"].split("\r\n") if x.startswith("outlink: ")]
            assert got == [x for x in dict.fromkeys(want.found) if not x.startswith(
                ("mailto:", "javascript:", "data:"))]
        checked += 1
    assert checked == 2 * len(pages)


def test_pages_of_unclosed_tags_take_time_in_proportion():
    for part in ("<a href ", "<script ", "<!-- ", "<title>", "<title ", "<html ", "<a x=1 ", "<",
                 "</script ", "<style>", "<a href='"):
        html = part * (1_000_000 // len(part))
        t = time.time()
        warc.derive("<urn:a>", "http://h.org/", "d", None, html + "<p>end</p>")
        warc.derive("<urn:a>", "http://h.org/", "d", None, html)
        assert time.time() - t < 3, (part, time.time() - t)


def test_headers_of_a_real_response():
    headers = ("HTTP/1.1 301 Moved\r\nDate: Mon, 01 Jan 2024 00:00:00 GMT\r\nSet-Cookie: a=1\r\n"
               "Set-Cookie: b=2; path=/\r\nX-Folded: one\r\n\ttwo\r\n   three\r\nno colon here\r\n")
    meta, text = warc.derive("<urn:uuid:1>", "http://h.org/", "2024-01-01T00:00:00Z", headers, "<p>x")
    fields = dict(zip(warc.NAMES, meta))["block"].split("\r\n")
    assert [x for x in fields if x.startswith("http-")] == [
        "http-date: Mon, 01 Jan 2024 00:00:00 GMT", "http-set-cookie: a=1",
        "http-set-cookie: b=2; path=/", "http-x-folded: one two three",
        "http-status: HTTP/1.1 301 Moved"]
    assert dict(zip(warc.NAMES, text))["block"] == "x"


# ---- decontamination -----------------------------------------------------------

def edit(text, n, rnd):
    chars = list(text)
    for at in sorted(rnd.sample(range(len(chars)), n), reverse=True):
        what = rnd.randrange(3)
        if what == 0:
            chars[at] = "#"
        elif what == 1:
            del chars[at]
        else:
            chars.insert(at, "@")
    return "".join(chars)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
                    for _ in range(n))


def test_edited_passages_are_found():
    rnd = random.Random(8)
    items = [(i, words(rnd, 40)) for i in range(30)] + [(90, words(rnd, 9)[:50]), (91, "not so short")]
    index = decontaminate.Index(items)
    for i, text in items[:31]:
        p = decontaminate.plain(text)
        w = min(80, len(p))
        for _ in range(6):
            at = rnd.randrange(len(p) - w + 1)
            part = edit(p[at:at + w], w // 20, rnd).upper().replace(" ", " \n ")
            doc = f"{words(rnd, 30)} {part} {words(rnd, 30)}"
            assert [m[0] for m in index.matches([doc])[0]] == [i], (i, at, doc)
    clean = [words(rnd, 300) for _ in range(20)] + [None, "", "too short", items[0][1][:60]]
    assert index.matches(clean) == [[] for _ in clean]


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_alignment_equals_the_full_table():
    rnd = random.Random(2)
    for _ in range(300):
        p = "".join(rnd.choice("ab") for _ in range(12))
        t = edit(p, rnd.randint(0, 3), rnd)
        t, at = ("x" * (n := rnd.randint(0, 4))) + t + "yy", n
        best = edit_distance_inside(p, t)
        windows = decontaminate.windows_of(decontaminate.codes(t), np.array([at - 3]), 12 + 6)
        got = decontaminate.align(decontaminate.codes(p)[None], windows, 3)[0]
        assert got == min(best, 4) or best == 0 == got


def stretches_inside(index, i, text):
    """By the full table: whether any stretch of an item is in the text."""
    p, w, k = index.texts[i], int(index.window[i]), int(index.edits[i])
    return any(edit_distance_inside(p[a:a + w], text) <= k
               for a in range(len(p) - w + 1))


@pytest.mark.parametrize("kind", ["words", "periodic", "two letters"])
def test_items_found_equal_brute_force(kind):
    """Complete and exact with edits, also where q-grams repeat."""
    rnd = random.Random(len(kind))
    found = missed = 0
    for _ in range(40):
        if kind == "words":
            item = words(rnd, 14)
        elif kind == "periodic":
            item = (rnd.choice(["-", "+--", "| a ", "=-=_"]) * 40)[:rnd.randint(40, 70)] + words(
                rnd, rnd.randint(0, 4))
        else:
            item = "".join(rnd.choice("ab") for _ in range(60))
        index = decontaminate.Index([(1, item)], length=40, per_edit=20)
        p = index.texts[0]
        w = int(index.window[0])
        a = rnd.randrange(len(p) - w + 1)
        part = edit(p[a:a + w], rnd.randint(0, 4), rnd)
        text = decontaminate.plain(f"{words(rnd, 6)} {part} {words(rnd, 6)}" if rnd.random() < 0.8
                                   else item[:30] + " " + words(rnd, 5) + " " + item[-30:])
        want = stretches_inside(index, 0, text)
        got = index.matches([text])[0]
        assert bool(got) == want, (item, text)
        for _, start, edits in got:
            assert edit_distance_inside(p[start:start + w], text) <= edits <= int(index.edits[0])
        found, missed = found + want, missed + (not want)
    assert found > 5 and missed > 5


def test_short_items_are_found_exactly():
    items = [(1, "Yes!"), (2, "a b"), (3, "fourteen chars"), (4, "exactly 23 chars long .."[:23]),
             (5, "a"), (6, " "), (7, "a b c")]
    index = decontaminate.Index(items)
    found = lambda t: sorted(m[0] for m in index.matches([t])[0])
    assert found("say YES! now") == [1] and found("yes !") == [] and found("ya b") == []
    assert found("x a  b c") == [2, 5, 7] and found("(a b)") == [2, 5]
    assert found("xfourteen charsx") == [3] and found("fourteen char") == []
    assert found("exactly 23 chars long .") == [4] and found("exactly 23 charz long .") == []


def test_repeats_take_time_in_proportion():
    """Rules of dashes, table borders and blank forms in items and texts."""
    border = "+----------" * 60
    items = [(1, "-" * 50), (2, "-" * 500), (3, border), (4, "-" * 60 + words(random.Random(1), 20)),
             (5, "name: ______ " * 40)]
    index = decontaminate.Index(items)
    for text, want in (("-" * 100_000, [1, 2]), ("+----------" * 20_000, [3]),
                       ("name: ______ " * 10_000, [5]), ("- " * 50_000, [])):
        t = time.time()
        got = sorted(m[0] for m in index.matches([text])[0])
        assert got == want and time.time() - t < 3, (text[:20], got, time.time() - t)


def test_text_ids_and_names(spark):
    bench = spark.createDataFrame([("q1", "the quick brown fox jumps over the lazy dog again")],
                                  "item_id string, text string")
    docs = spark.createDataFrame([("d", "The quick brown fox jumps over the lazy dog again", "c")],
                                 "doc string, text string, item_id string")
    assert rows(decontaminate.contaminations(docs, "doc", "text", bench, "item_id", "text")) == [
        ("d", "q1", 0, 0)]
    with pytest.raises(ValueError):
        decontaminate.contaminations(docs, "item_id", "text", bench, "item_id", "text")
    assert decontaminate.clean(docs, "text", bench, "item_id", "text").count() == 0


def test_index_is_bounded_in_bytes():
    rnd = random.Random(9)
    index = decontaminate.Index([(i, words(rnd, 400)) for i in range(100)])
    chars = sum(map(len, index.texts))
    size = len(pickle.dumps(index))
    assert size < 60 * chars, size / chars


def test_op3_finds_whole_items(spark, texts):
    items = {r["item_id"]: decontaminate.plain(r["text"])
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(i, j) for i, t in texts.items() for j, b in items.items()
            if b[:80] in decontaminate.plain(t) or b[-80:] in decontaminate.plain(t)}
    got = set(rows(queries.op3_decontamination(spark, SF), "doc_id", "item_id"))
    assert want and want <= got
    for i, j in got - want:  # a stretch of 80 characters with few edits
        p, t = items[j], decontaminate.plain(texts[i])
        assert min(edit_distance_inside(p[a:a + 80], t) for a in range(max(1, len(p) - 79))) <= 4


def test_blocks_of_items_give_the_same(spark, awkward, monkeypatch):
    rnd = random.Random(4)
    items = [(i, words(rnd, 30)) for i in range(6)] + [(7, None), (8, ""), (3, words(rnd, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(
        [(100 + i, f"{words(rnd, 5)} {t}") for i, t in items if t], "doc_id long, text string"))
    find = lambda: rows(decontaminate.contaminations(docs, "doc_id", "text", bench, "item_id", "text"),
                        "doc_id", "item_id")
    whole = find()
    assert whole == sorted(((100 + i, i) for i, t in items if t), key=repr)
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 300)
    assert find() == whole
    kept = decontaminate.clean(docs.withColumn("x", F.lit(1)), "text", bench, "item_id", "text")
    assert kept.columns == ["doc_id", "text", "x"] and kept.count() == len(AWKWARD)
    assert decontaminate.clean(docs, "text", bench.limit(0), "item_id", "text").count() == docs.count()
    assert decontaminate.contaminations(docs, "doc_id", "text", bench.limit(0), "item_id",
                                        "text").count() == 0


# ---- quality -------------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in queries.op6_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(got[r["doc_id"]]["score"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert all(r["held_out"] == (crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    good, bad = ([s for s, y in held if y == v] for v in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9, auc


def test_quality_is_repeatable_and_whole(spark, awkward, empty):
    rnd = random.Random(1)
    made = [(i, words(rnd, 40) if i % 2 else (words(rnd, 1) + " ") * 40) for i in range(80)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(2, 1), (4, None), (5, 1)],
                                   "doc_id long, quality int")
    models = [quality.fit(docs, labels, "doc_id", "text", "quality", bound=60) for _ in range(2)]
    scores = [rows(quality.scored(docs, "text", m)) for m in models]
    assert scores[0] == scores[1]
    assert np.mean([(s >= 0.5) == i % 2 for i, _, s in scores[0]]) > 0.85
    out = quality.scored(awkward, "text", models[0], "node")
    assert out.count() == len(AWKWARD) and out.columns == awkward.columns
    assert out.filter("node is null or node < 0 or node > 1").count() == 0
    one = quality.fit(docs, labels.limit(0), "doc_id", "text", "quality")
    assert {r[2] for r in rows(quality.scored(docs, "text", one))} == {0.5}
    assert quality.scored(empty, "text", models[0]).count() == 0


# ---- near-duplicates -------------------------------------------------------------

def brute_components(pairs, k, percent):
    sets = []
    for _, t in pairs:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    group = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    old, new = group[a], group[b]
                    group = [new if g == old else g for g in group]
    ids = {g: min((pairs[i][0] for i in range(len(pairs)) if group[i] == g
                   and pairs[i][0] is not None), default=None) for g in group}
    return [(p[0], len(s), ids[g] if s else p[0]) for p, s, g in zip(pairs, sets, group)]


def near_copies():
    rnd = random.Random(6)
    made, n = [], 1000
    for size, changes in ((60, 12), (40, 4), (30, 1), (8, 1), (6, 1)):
        base = words(rnd, size).split()
        for _ in range(30):
            own = list(base)
            for _ in range(rnd.randint(0, changes)):
                own[rnd.randrange(size)] = words(rnd, 1)
            made.append((n, " ".join(own)))
            n += 1
    made += [(n + i, made[3][1]) for i in range(40)]
    return made


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, k):
    pairs = near_copies() + AWKWARD
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    got = lshforest.with_component_id(
        lshforest.linked_components(docs, "doc_id", "text", k, 80), "doc_id")
    assert rows(got, "doc_id", "n", "component_id") == sorted(brute_components(pairs, k, 80), key=repr)


def crowd(k, size=2000, few=40):
    """A base, ``size`` copies with a word of their own each, and ``few`` texts of which
    each is linked with one of the copies and with nothing else."""
    rnd = random.Random(12)
    base, changed = [f"w{i}" for i in range(300)], {2: 32, 5: 28}[k]
    out = [(0, " ".join(base))]
    for i in range(1, size + 1):
        own, at = list(base), rnd.randrange(10, 290)
        own[at] = f"own{i}"
        out.append((i, " ".join(own)))
        if i <= few:
            start = at + 10 if at < 150 else at - 10 - changed
            own[start:start + changed] = [f"far{i}x{j}" for j in range(changed)]
            out.append((100_000 + i, " ".join(own)))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_sparse_links_into_a_crowd(spark, k):
    pairs = crowd(k)
    alone = [p for p in pairs if p[0] == 0 or p[0] in (1, 2, 100_001)]
    assert brute_components(alone, k, 80)[-1][2] == 0
    assert {c for i, _, c in brute_components([p for p in alone if p[0] != 1], k, 80)} == {0, 100_001}
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    got = lshforest.with_component_id(
        lshforest.linked_components(docs, "doc_id", "text", k, 80), "doc_id")
    assert [r["doc_id"] for r in got.filter("component_id != 0").collect()] == []


def test_one_of_each_stays(spark, awkward, empty):
    pairs = near_copies() + AWKWARD
    docs = spark.createDataFrame([(i, t, i) for i, t in pairs], "doc_id long, text string, node long")
    kept = lshforest.one_of_each(docs, "doc_id", "text")
    got = rows(kept, "doc_id", "text")
    assert kept.columns == docs.columns
    by_text = {}
    for (i, n, c), (_, t) in zip(brute_components(pairs, 5, 80), pairs):
        by_text.setdefault((c, None) if n else (i, t), (i if c is None else c))
    assert Counter(i for i, _ in got) == Counter([1, 2, 3] + [
        c for (c, t) in {(c, t if c == 7 else None) for (i, n, c), (_, t) in zip(
            brute_components(pairs, 5, 80), pairs) if n}])
    assert lshforest.one_of_each(empty, "doc_id", "text").count() == 0


def test_op7_without_words(spark):
    found = lshforest.linked_components(spark.createDataFrame(
        [(1, None), (2, ""), (3, " ")], "doc_id long, text string"), "doc_id", "text", 2, 80)
    assert rows(lshforest.with_component_id(found, "doc_id"), "doc_id", "n", "component_id") == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3)]


# ---- licenses ---------------------------------------------------------------------

def brute_license(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    all_words, starts, base, labels, score = find(low), [], set(), set(), 0.0
    for label, phrase in license_join.PHRASES:
        p = phrase.split()
        for i in range(len(all_words) - len(p) + 1):
            if all_words[i:i + len(p)] == p:
                starts.append(i)
                base.add(label)
    for line in low.split("\n"):
        line = find(line)
        blocks = [line] if len(line) <= 40 else [line[i:i + 40] for i in range(0, len(line) - 20, 20)]
        for block in blocks:
            for label, template in license_join.TEMPLATES:
                t = set(find(template))
                share = len(t & set(block)) / len(t)
                if share >= license_join.THRESHOLD:
                    labels.add(label)
                    score = max(score, share)
    return (len(all_words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else score)


def licensed():
    rnd = random.Random(9)
    out = []
    for i in range(120):
        _, t = license_join.TEMPLATES[i % len(license_join.TEMPLATES)]
        part = t.split()
        for _ in range(rnd.randint(0, 2)):
            part[rnd.randrange(len(part))] = "word"
        part = " ".join(part) if i % 3 else ", ".join(part).upper()
        out.append((200 + i, f"{words(rnd, rnd.randint(0, 70))}{rnd.choice(' \n')}{part} {words(rnd, 9)}"))
    return out + [(1, "CC BY cc-by, general PUBLIC license. all rights\nreserved cc by")]


def test_license_scan_equals_brute_force(spark, empty):
    pairs = licensed() + AWKWARD
    docs = spark.createDataFrame([(i, t, "x") for i, t in pairs], "doc_id long, text string, labels string")
    got = rows(license_join.scan(docs, "doc_id", "text"))
    assert got == sorted(((i, *brute_license(t)) for i, t in pairs), key=repr)
    assert license_join.scan(empty, "doc_id", "text").count() == 0


def test_wrapped_licenses_are_found(spark):
    whole = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
               "this software and associated documentation files (the \"Software\"), to deal in it.",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, "
               "are permitted provided that the following conditions are met:",
        "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\");"}
    pairs, want = [], {}
    for label, text in whole.items():
        for width in (30, 70, 80):
            for before in range(0, 45, 4):
                lines = textwrap.wrap(" ".join(["x"] * before + [text]), width)
                want[len(pairs)] = label
                pairs.append((len(pairs), "\n".join(f" * {x}" for x in lines)))
    pairs += [(-1, "licensed under the apache\nlicense, version 2.0"), (-2, "licensed under the\napache")]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_join.scan(docs, "doc_id", "text").collect()}
    assert {i: r["labels"] for i, r in got.items()} == want | {-1: "apache-2.0", -2: ""}
    assert all((r["score"] >= 0.9) == (i != -2) for i, r in got.items())


def test_op10_brute_force(spark, texts):
    got = rows(queries.op10_license_join(spark, SF))
    assert got == sorted(((i, *brute_license(t)) for i, t in texts.items()), key=repr)
    assert any(r[6] for r in got)


# ---- pipeline ----------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark, documents):
    docs, names = documents, documents.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == names
        path = f"{spark.conf.get('spark.checkpoint.dir')}/t-{name.replace(' ', '-')}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept <= {r["doc_id"] for r in before.select("doc_id").collect()}
        sizes.append(len(kept))
        if name == "quality classifier":
            good = [i for i, y in labels.items() if y]
            assert sum(i in kept for i in good) > 0.8 * len(good)
        if name == "MinHash near-dedup":
            all_rows = before.select("doc_id", "text").collect()
            want = brute_components([tuple(r) for r in all_rows], 5, 80)
            assert kept == {c if n else i for i, n, c in want}
    assert sizes == sorted(sizes, reverse=True) and sizes[1] == sizes[0] > sizes[2] > sizes[3]
    last = corpus_pipeline.run(spark, SF)
    assert last.count() == sizes[3] and last.columns == ["doc_id", "ids", "n_tokens", "decoded"]


def test_pipeline_stage_on_a_crowd(spark):
    docs = spark.createDataFrame(crowd(5), "doc_id long, text string").repartition(5)
    assert [r["doc_id"] for r in corpus_pipeline.minhash_near_dedup(spark, docs, SF).collect()] == [0]


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_names_stay(spark):
    names = {c: F.lit(c) for c in ("_node", "_key", "_set", "_copies", "_score", "_dropped")}
    docs = spark.createDataFrame([(i, "one two three four five six " * 3 + str(i // 2))
                                  for i in range(6)], "doc_id long, text string").withColumns(names)
    kept = lshforest.one_of_each(docs, "doc_id", "text")
    assert kept.columns == docs.columns and kept.count() <= 3
    assert all(r[c] == c for r in kept.collect() for c in names)


def test_few_labelled_rows_are_learned_from():
    good, bad = "A plain sentence about rivers and towns.", "zz zz zz $$$ ### 000 zz"
    for n in (1, 2, 5, 9):
        model = quality.Model([good] * n + [bad] * n, [1] * n + [0] * n)
        scores = model.scorer()([good, bad, "", None])
        assert scores[0] > 0.5 > scores[1] and np.isfinite(scores).all(), (n, scores)
    assert quality.Model([good] * 3, [1, 1, 1]).scorer()([bad]).tolist() == [1.0]


def test_bucketed_texts_are_joined_without_a_shuffle(spark):
    from ordermill.llm import tables

    data = [(bytes([i]), f"text {i}") for i in range(20)]
    texts = tables.bucketed(spark.createDataFrame(data, "node binary, text string"), "t", "node")
    known = spark.createDataFrame([(bytes([3]), 1)], "node binary, c long").hint("merge")
    joined = texts.join(known, "node")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in joined.collect()] == [(bytearray([3]), "text 3", 1)]
    assert sorted(map(tuple, texts.collect())) == sorted(map(tuple, (
        (bytearray(n), t) for n, t in data)))


def test_forest_of_names_has_the_members_of_the_deep_one(spark):
    rnd = np.random.default_rng(3)
    sigs = rnd.integers(0, 3, (60, lshforest.MINIMA)).astype(np.uint16)
    nodes = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sigs)],
                                  "node long, sig binary")
    deep, flat = (sorted(map(tuple, lshforest.with_hub(lshforest.forest(nodes, d)).select(
        "order", "region", "node", "hub").collect())) for d in (True, False))
    assert deep and deep == flat


def test_a_task_has_one_python_worker(spark, awkward, monkeypatch):
    """Rows tested by the bit map in Python go to no second worker of the same task."""
    wanted = spark.createDataFrame([(b"x", 1)], "node binary, rep long")
    frames = [lshforest.texts_of(awkward, "doc_id", "text", 5, wanted),
              lshforest.one_of_each(awkward, "doc_id", "text")]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        for below in plan.split("MapInArrow")[1:]:
            assert "ArrowEvalPython" not in re.split(r":- |Scan|Exchange", below)[0]
        assert "MapInArrow" in plan
