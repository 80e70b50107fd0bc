"""Registered queries of the document operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inspecta.llm import (decontaminate, embedding_dedup, exact_dedup, html_extract, importance_resample, language_id, periodic_runs, secret_scan,
                          sentencepiece_bpe, simhash_dedup, substring_dedup, suffix_dedup, toxicity)
from inspecta.llm.base import table
from inspecta.session import scratch_dir

PIECE_MODEL = "piece_bpe_32k.model"


def piece_model() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(PIECE_MODEL))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classify(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "similarity", "start", "n_windows")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(spark, table(spark, sf_dir, "documents"), scratch_dir(spark, "blob-ledger"))
    return secret_scan.digest_rows(found)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.stored_digests(table(spark, sf_dir, "documents"), piece_model())


def looped_tail(doc_id: int | None, n: int):
    """The contract's places: in one document of ten the words from a on repeat p words."""
    import zlib

    import numpy as np
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest_rows(periodic_runs.find_runs(table(spark, sf_dir, "documents"), order=looped_tail))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resample.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_html_extract, op2_substring_dedup, op3_exact_dedup, op4_decontaminate, op5_secrets, op6_toxicity,
                                 op7_language_id, op8_simhash, op9_suffix_dedup, op10_sentencepiece, op11_periodic_runs,
                                 op12_embedding_dedup, op13_importance_resample, pipeline)}

SQL = {
    "op3_exact_dedup": """
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents window g as (partition by coalesce(text, ''))""",
    # every window of an item's size that shares a shingle with it, compared exactly
    "op4_decontaminate": r"""
        with d as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents),
        i as (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark),
        it as (select item_id, w, len(w) as n, least(len(w), 5) as k from i where len(w) > 0),
        ks as (select distinct k from it),
        ish as (select item_id, n, k, array_to_string(w[p:p + k - 1], ' ') as s from (select *, unnest(range(1, n - k + 2)) as p from it)),
        ic as (select item_id, s, count(*) as c from ish group by all),
        dp as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d, ks where len(w) >= k),
        dsh as (select doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') as s from dp),
        hit as (select distinct dsh.doc_id, ic.item_id, dsh.p from dsh join it using (k) join ic on ic.item_id = it.item_id and ic.s = dsh.s),
        win as (select distinct h.doc_id, h.item_id, it.n, it.k, least(it.n, len(d.w)) as size, len(d.w) as total,
                       unnest(range(greatest(1, h.p - least(it.n, len(d.w)) + it.k), least(h.p, len(d.w) - least(it.n, len(d.w)) + 1) + 1)) as st
                from hit h join it using (item_id) join d using (doc_id)),
        wc as (select win.doc_id, win.item_id, win.st, dsh.s, win.n - win.k + 1 as im, win.size - win.k + 1 as m, count(*) as c
               from win join dsh on dsh.doc_id = win.doc_id and dsh.k = win.k and dsh.p between win.st and win.st + win.size - win.k
               group by all),
        sim as (select wc.doc_id, wc.item_id, st, im, m, sum(least(wc.c, ic.c)) as common
                from wc join ic on ic.item_id = wc.item_id and ic.s = wc.s group by all),
        ok as (select doc_id, item_id, st - 1 as st, common / (m + im - common) as j from sim where common / (m + im - common) >= 0.8)
        select doc_id, item_id, max(j) as similarity, min(st) filter (where j = best) as start, count(*) as n_windows
        from (select *, max(j) over (partition by doc_id, item_id) as best from ok) group by doc_id, item_id""",
    # each match of gap and rule together gives both lengths; running sums give the positions
    "op5_secrets": r"""
        with t as (select doc_id, coalesce(text, '') as text from documents),
        seg as (
          select doc_id, 0 as kind, unnest(regexp_extract_all(text, '(?s)(.*?)(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)) as seg,
                 unnest(regexp_extract_all(text, '(?s)(.*?)(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) as gap,
                 unnest(regexp_extract_all(text, '(?s)(.*?)(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)) as val,
                 generate_subscripts(regexp_extract_all(text, '(?s)(.*?)(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0), 1) as k, 6 as least from t
          union all
          select doc_id, 1, unnest(regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 0)), unnest(regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 1)),
                 unnest(regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 2)), generate_subscripts(regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 0), 1), 20 from t
          union all
          select doc_id, 2, unnest(regexp_extract_all(text, '(?s)(.*?)([0-9a-f]{24,})', 0)), unnest(regexp_extract_all(text, '(?s)(.*?)([0-9a-f]{24,})', 1)),
                 unnest(regexp_extract_all(text, '(?s)(.*?)([0-9a-f]{24,})', 2)), generate_subscripts(regexp_extract_all(text, '(?s)(.*?)([0-9a-f]{24,})', 0), 1), 24 from t),
        pos as (select doc_id, kind, sum(length(seg)) over (partition by doc_id, kind order by k) as stop,
                       length(seg) as n_seg, length(gap) as n_gap, length(val) as n_val, least from seg),
        hit as (select doc_id, kind, stop - n_seg + n_gap as start, stop from pos where n_val >= least),
        doc as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
                       count(*) filter (kind = 2) as n_hex,
                       string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || cast(start as varchar) || ':' || cast(stop as varchar), ',' order by start, kind) as spans
                from hit group by doc_id)
        select t.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
               sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
        from t left join doc using (doc_id)""",
    # all pairs of a label by brute force
    "op12_embedding_dedup": """
        with recursive ok as (select row_number() over () as r, vec_id, label, embedding::double[] as v from embeddings
               where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                     and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link as (select a.r as a, b.r as b from ok a join ok b on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
                 where list_cosine_similarity(a.v, b.v) >= 0.98),
        n as (select a, count(*) as n_links from link group by a),
        reach as (select r as a, r as b from ok union select reach.a, link.b from reach join link on link.a = reach.b),
        low as (select a, min(vec_id) as component_id from reach join ok on ok.r = reach.b group by a)
        select e.vec_id, coalesce(n.n_links, 0) as n_links, coalesce(low.component_id, e.vec_id) as component_id,
               e.vec_id = coalesce(low.component_id, e.vec_id) as kept
        from embeddings e left join ok on ok.vec_id = e.vec_id left join n on n.a = ok.r left join low on low.a = ok.r""",
    # the CRC bit by bit
    "op13_importance_resample": r"""
        with recursive bits as (select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b::bigint)) as tab),
        texts as (select 'd' as kind, doc_id as id, row_number() over () as r, text from documents union all select 'b', item_id, row_number() over (), text from benchmark),
        words as (select kind, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
        grams as (select kind, id, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f from words),
        uses as (select kind, id, r, f, count(*) as n from grams group by all),
        hexed as (select f, hex(encode(f)) as x from (select distinct f from uses)),
        crc as (select f, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::bigint),
                              lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) % 10000 as bucket
                from hexed, bits),
        used as (select u.*, bucket from uses u join crc using (f)),
        total as (select sum(n) filter (kind = 'd') as s_all, coalesce(sum(n) filter (kind = 'b'), 0) as t_all from used),
        gain as (select bucket, floor(1000 * ln((coalesce(sum(n) filter (kind = 'b'), 0) + 1)::double * (s_all + 10000)::double
                                                / ((coalesce(sum(n) filter (kind = 'd'), 0) + 1)::double * (t_all + 10000)::double)))::bigint as g
                 from used, total group by bucket, s_all, t_all),
        doc as (select r, sum(n)::bigint as n_features, floor(sum(n * g)::double / sum(n))::bigint as weight
                from used join gain using (bucket) where kind = 'd' group by r),
        scored as (select id as doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
                          coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || id)[1:8])::bigint + 0.5) / 4294967296)))::bigint as score
                   from words left join doc using (r) where kind = 'd'),
        placed as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as k,
                          count(*) filter (n_words >= 20) over () as n from scored)
        select doc_id, n_features, weight, score, case when n_words >= 20 and k <= n * 25 // 100 then k end as rank from placed""",
}
