"""Registered queries of the training-text operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from careweave.llm import (
    audit, bpe, chat, exact, fingerprint, license, minhash, mixture, quality, search,
    toxicity, url_filter, warc,
)

_LOWER = "translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"


def _read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op8_exact_dedup(spark, folder):
    return exact.exact_groups(_read(spark, folder, "documents")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def op2_bpe(spark, folder):
    import public_tokenizers

    return bpe.encode_digests(_read(spark, folder, "documents"),
                              public_tokenizers.path("byte_bpe_50k.json"))


def _fold(n):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def quality_model(spark, folder):
    return quality.fit(_read(spark, folder, "documents"),
                       _read(spark, folder, "labels").where(_fold(3) != 1))


def op4_quality(spark, folder):
    scored = quality.scores(_read(spark, folder, "documents"), quality_model(spark, folder))
    return scored.select("doc_id", (_fold(3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_mixture(spark, folder):
    return mixture.mix(_read(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op1_minhash(spark, folder):
    return minhash.near_duplicates(_read(spark, folder, "documents")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: The rules of the query.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def op5_toxicity(spark, folder):
    docs = _read(spark, folder, "documents")
    lexicon = toxicity.learn(docs, _read(spark, folder, "labels").where(_fold(4) != 2))
    return toxicity.scores(docs, lexicon).select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "hits")


def op7_chat(spark, folder):
    import public_tokenizers

    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = _read(spark, folder, "conversations").select(extra.columns).unionByName(extra)
    return chat.format_conversations(rows, public_tokenizers.path("byte_bpe_50k.json"))


def op9_url_filter(spark, folder):
    return url_filter.judge(_read(spark, folder, "pages"), URL_RULES)


def op3_fingerprint(spark, folder):
    return fingerprint.fingerprints(_read(spark, folder, "documents"))


def op10_license(spark, folder):
    return license.scan(_read(spark, folder, "documents"))


def op13_filter_audit(spark, folder):
    return audit.audit(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op11_lexical_search(spark, folder):
    return search.search(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op12_warc(spark, folder):
    return warc.archive(_read(spark, folder, "pages")).drop("url")


def queries():
    return {"op12_warc": op12_warc, "op11_lexical_search": op11_lexical_search, "op13_filter_audit": op13_filter_audit,
            "op3_fingerprint": op3_fingerprint, "op10_license": op10_license,
            "op5_toxicity": op5_toxicity, "op7_chat": op7_chat,
            "op9_url_filter": op9_url_filter, "op1_minhash": op1_minhash, "op2_bpe": op2_bpe, "op4_quality": op4_quality, "op6_mixture": op6_mixture,
            "op8_exact_dedup": op8_exact_dedup}


_AUDIT_SQL = r"""with d as (select doc_id, coalesce(source,'') as part, coalesce(text,'') as x,
 regexp_extract_all(coalesce(text,''), '[^\x20\x09-\x0D]+') as w from documents),
l as (select doc_id, max(quality) = 1 as good, max(toxic) = 1 as toxic from labels group by doc_id),
f as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
 (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
 + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x))::int
 + 8 * regexp_matches(x, '[#$%&*|]')::int + 16 * (doc_id > min(doc_id) over (partition by x))::int as fails
 from d left join l using (doc_id)),
k as (select i, substr('ABCDE', i + 1, 1) as c, (1 << i)::int as b from range(5) r(i)),
o as (select a.c||b.c||c.c||d.c||e.c as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits
 from k a, k b, k c, k d, k e where a.b | b.b | c.b | d.b | e.b = 31),
s as (select filter_order, step, bits[step] as bit, list_sum(bits[1:step-1])::int as before
 from o, range(1, 6) r(step)),
n as (select part, fails, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as t
 from f group by part, fails),
c as (select part, filter_order, step, bit,
 sum(n) filter (fails & (coalesce(before, 0) | bit) = 0) as kept,
 sum(n) filter (fails & coalesce(before, 0) = 0 and fails & bit > 0) as removed,
 sum(n) filter (fails & coalesce(before, 0) > 0 and fails & bit > 0) as redundant,
 sum(n) filter (fails = bit) as unique_fails,
 sum(g) filter (fails & coalesce(before, 0) = 0 and fails & bit > 0) as good_lost,
 sum(t) filter (fails & coalesce(before, 0) = 0 and fails & bit > 0) as toxic_lost
 from n, s group by all)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept,
 coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
 coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
 coalesce(toxic_lost, 0)::bigint as toxic_lost,
 coalesce(sum(removed) over (partition by part, bit), 0)::bigint as shapley from c"""


_SEARCH_SQL = r"""with p as (select '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' as term),
t as (select doc_id, unnest(regexp_extract_all(LOWER, (select term from p))) as term from documents),
n as (select doc_id, count(*)::bigint as n from t group by doc_id),
s as (select count(*)::bigint as docs, sum(n)::bigint as terms from n),
q as (select distinct item_id, unnest(regexp_extract_all(LOWER, (select term from p))) as term from benchmark),
f as (select doc_id, term, count(*)::bigint as tf from t
 where term in (select term from q) group by doc_id, term),
w as (select term, floor(1000 * ln((2.0 * docs + 2) / (2 * count(*) + 1)))::bigint as w from f, s group by term, docs),
c as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::bigint as score
 from q join w using (term) join f using (term) join n using (doc_id), s group by item_id, doc_id),
r as (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
 from c where score > 0)
select * from r where rank <= 50""".replace("LOWER", _LOWER)


_WARC_SQL = """with p as (select page_id, coalesce(html, '') as x from pages),
h as (select *, sha1(x) as hex, min(page_id) over (partition by x) as first from p),
b as (select *, list_transform(range(0, 40, 5), lambda i: ('0x' || substr(hex, i::int + 1, 5))::bigint) as parts from h)
select page_id, strlen(x)::bigint as payload_bytes,
 list_aggregate(list_transform(parts, lambda v: list_aggregate(list_transform([15, 10, 5, 0],
  lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> k) & 31)::int + 1, 1)), 'string_agg', '')), 'string_agg', '') as payload_digest,
 case when page_id = first then 'response' else 'revisit' end as record_type,
 case when page_id <> first then first end as refers_to from b"""


def oracle_sql():
    return {"op12_warc": _WARC_SQL,
        "op11_lexical_search": _SEARCH_SQL,
        "op13_filter_audit": _AUDIT_SQL,
        "op7_chat": r"""with c as (select conv_id, turn, coalesce(role,'') r, coalesce(text,'') t
 from conversations union all select -7, 0, 'user', '\### Assistant: </turn> ok'
 union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) n_turns, sha256(string_agg(r||chr(10)||t||chr(10), '' order by turn, r, t)) turns_sha256,
 coalesce(sum(length(t)) filter (r='assistant'),0)::bigint loss_chars,
 sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r='assistant'),'')) loss_sha256,
 sum(15 + length(r) + length(replace(replace(replace(t,'\','\\'),'<turn>','<\turn>'),'</turn>','<\/turn>')))::bigint formatted_chars
from c group by conv_id""",
        "op9_url_filter": """with u as (select page_id,
 translate(regexp_extract(coalesce(url,''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz') as host,
 regexp_extract(coalesce(url,''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path from pages),
r(rule, h, p, v) as (values ('com/','com','/','allow'),('example.com/en/','example.com','/en/','block'),
 ('www.example.com/en/','www.example.com','/en/','allow'),('net/es/','net','/es/','block'),('net/fr/','net','/fr/','block')),
m as (select u.*, rule, v, row_number() over (partition by page_id order by length(rule) desc) k
 from u left join r on (host = h or ends_with(host, '.'||h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(v,'allow') as verdict from m where k = 1""",
        "op8_exact_dedup": f"""with t as (select doc_id, {_LOWER} as x from documents)
select doc_id, max(doc_id) over (partition by x) as keep_id,
 count(*) over (partition by x) as group_size,
 doc_id = max(doc_id) over (partition by x) as kept, sha256(x) as text_sha256 from t"""}
