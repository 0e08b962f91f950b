"""The registered queries of this subpackage, with SQL where SQL can say it."""
from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from ..session import scratch_root
from . import (collocations, decontaminate, eliasfano, license_join, linefreq, lshforest,
               mixing, quality, rendezvous, sketch, spbpe, warc, whitening)
from .tables import lean, stored, table

SHARDS = 8
#: Of a document by the quality classifier.
ACCEPTED = 0.3
#: Of the sources in their order, repeated.
MIX_WEIGHTS = (5, 2, 1)
CRAWL_DATE = "2024-01-01T00:00:00Z"


def op1_warc(spark, sf_dir):
    """Metadata and conversion records of all pages."""
    pages = table(spark, sf_dir, "pages")
    return warc.derivatives(warc.responses(pages, "page_id", "url", "html", CRAWL_DATE))


def op2_rendezvous(spark, sf_dir):
    """All documents into eight shards of equal weight, with gapless slots."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_bytes"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    docs = docs.select("doc_id", (F.col("_bytes") + 1).alias("size"), "text_crc32")
    placed = rendezvous.with_shard(docs, "doc_id", [1.0] * SHARDS)
    placed = rendezvous.with_shard(placed, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return (rendezvous.with_slots(placed, "shard", ["doc_id", "size", "text_crc32",
                                                    "grown_shard"])
            .withColumn("law", F.lit("key")))


def op3_decontamination(spark, sf_dir):
    """Every document that holds a stretch of a benchmark item, with the item."""
    return decontaminate.contaminations(
        table(spark, sf_dir, "documents"), "doc_id", "text",
        table(spark, sf_dir, "benchmark"), "item_id", "text")


def op4_elias_fano(spark, sf_dir):
    """Ids of all documents written with Elias-Fano boundaries and read back."""
    path = f"{scratch_root(spark)}/llm/ids-{uuid.uuid4().hex[:12]}"
    eliasfano.write(table(spark, sf_dir, "documents"), "doc_id", "text", path,
                    public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return eliasfano.read(spark, path, "doc_id")


def op5_threshold_sketch(spark, sf_dir):
    """Fingerprints of all texts and of their edited forms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = sketch.with_sketch(sketch.with_next(docs, "doc_id", "text"), "text", "own")
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.expr("substring(text, 1, int(n_chars - n_chars div 4))"),
                           "next_start"))
    docs = sketch.with_sketch(docs, "edited", "other")
    return docs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch.as_string(F.col("own")).alias("fingerprint"),
        sketch.as_string(F.col("other")).alias("edited_fingerprint"),
        sketch.containment(F.col("own"), F.col("other")).alias("near_edited"),
        sketch.containment(F.col("own"), F.col("next_sketch")).alias("near_next"))


def held_out():
    """The rows that no label may be learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def op6_quality(spark, sf_dir):
    """All documents scored by a classifier that learned from the rows not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    return quality.scored(docs, "text", model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def op7_lsh_forest(spark, sf_dir):
    """Components of all documents linked at 0.8 on two-word shingles."""
    found, _ = stored(lshforest.linked_components(
        table(spark, sf_dir, "documents"), "doc_id", "text", k=2, percent=80), "components")
    return lshforest.with_component_id(found, "doc_id").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op8_line_frequency(spark, sf_dir):
    """All documents without the boilerplate lines of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linefreq.drop_boilerplate(docs, "source", "text")


def op10_license_join(spark, sf_dir):
    """All documents with license phrases and the templates their blocks meet."""
    return license_join.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


def op9_sentencepiece(spark, sf_dir):
    """All documents encoded and decoded; digests of ids and texts."""
    return spbpe.digest(table(spark, sf_dir, "documents"), "doc_id", "text",
                        public_tokenizers.path("piece_bpe_32k.model"))


def op11_whitening(spark, sf_dir):
    """All usable embeddings whitened, with the figures of the fit."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op12_mixing(spark, sf_dir):
    """All documents with what the mix takes of each, by sources of weight 5, 2 and 1."""
    docs, _ = stored(table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.words(F.col("text")).alias("size")), "sizes")
    mix = mixing.mixed(docs, "doc_id", "source", "size", lambda rank: F.element_at(
        F.array(*map(F.lit, MIX_WEIGHTS)), (rank % len(MIX_WEIGHTS) + 1).cast("int")))
    return mix.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def op13_collocations(spark, sf_dir):
    """The best phrases of each language of all documents."""
    return collocations.collocations(table(lean(spark), sf_dir, "documents"), "lang", "text")


def pipeline(spark, sf_dir):
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_rendezvous, op3_decontamination, op4_elias_fano, op5_threshold_sketch,
    op6_quality, op7_lsh_forest, op8_line_frequency, op9_sentencepiece, op10_license_join,
    op11_whitening, op12_mixing, op13_collocations, pipeline)}

_HASH = "cast('0x' || left(md5({}), 13) as bigint)"
_UNIT = f"({_HASH.format("'shards/' || doc_id || '/' || s")} + 0.5) / pow(2, 52)"
#: CRC-32 of a text's bytes, from a table of 256 values that is worked out first.
_CRC32 = """
    crc as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, u:
                case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as t
            from range(256) r(i)),
    crcs as (select doc_id, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(octet_length(encode(text))),
                    lambda k: cast('0x' || substr(h, 2 * k + 1, 2) as bigint))),
                lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) as text_crc32
             from (select doc_id, text, hex(encode(text)) as h from documents), crc)"""


def _op2_sql() -> str:
    def least(n):
        return (f"select doc_id, arg_min(s, -ln({_UNIT})) as s from documents, range({n}) r(s) "
                "group by doc_id")

    return f"""
        with {_CRC32},
        a as ({least(SHARDS)}), b as ({least(SHARDS + 1)}),
        r as (select doc_id, cast(a.s as int) as shard, cast(b.s as int) as grown_shard,
                     octet_length(encode(text)) + 1 as size, text_crc32
              from documents join a using (doc_id) join b using (doc_id) join crcs using (doc_id)),
        k as (select *, {_HASH.format("concat_ws('/', 'slot', doc_id, size, text_crc32, grown_shard)")}
                     % greatest(1, cast(ceil((select count(*) from documents) / 65536.0) as bigint))
                     as bucket from r)
        select doc_id, size, text_crc32, 'key' as law, shard,
               row_number() over (partition by shard order by bucket, doc_id, size, text_crc32,
                                  grown_shard) - 1 as slot, grown_shard from k"""


_OP7_SQL = """
    with recursive words as (
        select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[ \\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
    sets as (
        select doc_id, case when len(w) >= 2 then list_distinct(list_transform(
                   range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) else w end as s from words),
    one as (select doc_id, unnest(s) as g, len(s) as n from sets),
    links as (
        select a.doc_id as x, b.doc_id as y from one a join one b on a.g = b.g
            and a.doc_id < b.doc_id and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
        group by a.doc_id, b.doc_id, a.n, b.n
        having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    ends as (select x, y from links union all select y, x from links),
    reach(d, r) as (select x, y from ends
                    union select reach.d, ends.y from reach join ends on reach.r = ends.x)
    select sets.doc_id, cast(len(s) as bigint) as n_shingles,
           least(sets.doc_id, coalesce(m, sets.doc_id)) as component_id,
           least(sets.doc_id, coalesce(m, sets.doc_id)) = sets.doc_id as kept
    from sets left join (select d, min(r) as m from reach group by d) on d = sets.doc_id"""

_OP8_SQL = f"""
    with pages as (select row_number() over () as p, doc_id, source, text,
                          string_split(text, chr(10)) as w from documents),
    lines as (select distinct p, source, trim(l) as l from (
        select p, source, unnest(w) as l from pages where source is not null)
        where trim(l) <> ''),
    drops as (select source, list(l) as b from (
        select source, l from lines group by source, l having count(*) >= {linefreq.MIN_PAGES}
            and count(*) > {linefreq.RATIO} * (select count(*) from pages q
                                               where q.source = lines.source)) group by source),
    kept as (select doc_id, source, text, w, list_filter(w, lambda x: trim(x) = ''
                 or not list_contains(coalesce(b, []), trim(x))) as k
             from pages left join drops using (source))
    select doc_id, source, case when len(k) < len(w) then array_to_string(k, chr(10))
           else text end as text, coalesce(cast(len(w) - len(k) as int), 0) as n_dropped from kept"""

_OP12_SQL = f"""
    with d as (select doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''),
                      '[ \\x09-\\x0D]+'), lambda w: w <> '')) as size from documents),
    s as (select *, 2.0 * source_size as cap,
                 [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as w
          from (select source, cast(sum(size) as bigint) as source_size from d group by source)),
    -- The sources that are full first come first.
    q as (select *, row_number() over (order by cap / w, source nulls last) as k from s),
    levels as (
        select k, cap, w, (1.5 * (select sum(source_size) from s)
                           - coalesce(sum(cap) over before, 0)) / sum(w) over after as level
        from q window before as (order by k rows between unbounded preceding and 1 preceding),
                      after as (order by k rows between current row and unbounded following)),
    l as (select greatest(0.0, coalesce(arg_min(level, k) filter (cap > level * w), 0)) as level
          from levels),
    t as (select source, source_size, least(cap, level * w) as target from s, l),
    r as (select *, case when source_size > 0 then target / source_size else 0 end as rate from t)
    select doc_id, cast(size as bigint) as size, source_size, target,
           cast(size * (floor(rate) + case when ({_HASH.format("'mix/' || doc_id")} + 0.5)
               / pow(2, 52) < rate - floor(rate) then 1 else 0 end) as bigint) as taken
    from d join r on d.source is not distinct from r.source"""

_OP13_SQL = """
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents),
    w as (select lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') as w
          from pieces),
    runs as (
        select lang, g, unnest(list_transform(range(1, len(w) - g + 2),
                                              lambda i: array_to_string(w[i:i + g - 1], ' '))) as p
        from w, range(1, 4) as r(g)),
    f as (select lang, g, p, count(*) as f from runs group by all),
    c as (select lang, g, p, f as a, string_split(p, ' ') as w from f where g > 1 and f >= 10),
    parts as materialized (
        select lang, p, a, k, array_to_string(w[1:k], ' ') as head,
               array_to_string(w[k + 1:], ' ') as tail
        from c, range(1, 3) as s(k) where k < g),
    cuts as (
        select parts.lang, parts.p, a, k, h.f as l, t.f as r,
               cast(1000000::hugeint * a * a // (h.f::hugeint * t.f) as bigint) as score
        from parts join f h on h.lang = parts.lang and h.p = head
                   join f t on t.lang = parts.lang and t.p = tail),
    scored as (select * from cuts qualify row_number() over (
        partition by lang, p order by score, k) = 1),
    longer as (select lang, array_to_string(w[i:i + 1], ' ') as p, max(a) as m
               from c, range(1, 3) as s(i) where g = 3 group by all),
    n as (select lang, cast(sum(f) as bigint) as n from f where g = 1 group by lang)
    select lang, row_number() over (partition by lang order by score desc, a desc, p) as rank,
           p as phrase, a, l, r, n, score
    from scored left join longer using (lang, p) join n using (lang)
    where coalesce(100 * m < 50 * a, true)
    qualify rank <= 2000"""

ORACLES: dict[str, str] = {"op2_rendezvous": _op2_sql(), "op7_lsh_forest": _OP7_SQL,
                           "op8_line_frequency": _OP8_SQL, "op12_mixing": _OP12_SQL,
                           "op13_collocations": _OP13_SQL}
