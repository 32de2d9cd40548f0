"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import centroids, chat, common, decontaminate, exact_dedup, licences, packing, quality, recurrent, secrets, simhash, spelling, toxicity, urls


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat(spark, sf):
    return chat.read_back(chat.expand(chat.with_sample(_table(spark, sf, "conversations"))))


def op2_exact_dedup(spark, sf):
    found = exact_dedup.assign(_table(spark, sf, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_licences(spark, sf):
    return licences.find(_table(spark, sf, "documents"))


def op4_simhash(spark, sf):
    found = simhash.groups(_table(spark, sf, "documents"), words=4, bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality(spark, sf):
    docs = _table(spark, sf, "documents")
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), quality.fit(docs, _table(spark, sf, "labels")))
    return scored.select("doc_id", common.held_out(4, 2).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_packing(spark, sf):
    return packing.packed(_table(spark, sf, "documents"), tokenizer_path())


# fixed values: the rules of the URL query, and the hosts its list holds
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
LISTED = ["https://spam-farm.example.org/", "https://cheap-pills.example.com/", "https://adult-x.example.net/"]


def op7_urls(spark, sf):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    return urls.judge(_table(spark, sf, "pages"), rules, listed)


def op8_toxicity(spark, sf):
    docs = _table(spark, sf, "documents")
    model = toxicity.fit(docs, _table(spark, sf, "labels"), modulus=3, held=1)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", common.held_out(3, 1).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def _kind(k):
    return lambda s: s.kind == k


def op9_secrets(spark, sf):
    found = secrets.find(_table(spark, sf, "documents"))
    counts = [F.size(F.filter("base", _kind(k))).cast("long").alias(f"n_{n}")
              for k, n in enumerate(secrets.KINDS)]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


def op10_decontamination(spark, sf):
    return decontaminate.leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op11_spelling(spark, sf):
    return spelling.variants(_table(spark, sf, "documents"), least=7, times=2, ratio=10, slips=31)


def op12_language_model(spark, sf):
    return recurrent.likelihoods(_table(spark, sf, "documents"))


def op13_centroids(spark, sf):
    return centroids.cluster(_table(spark, sf, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_chat, op2_exact_dedup, op3_licences, op4_simhash, op5_quality, op6_packing, op7_urls, op8_toxicity, op9_secrets,
    op10_decontamination, op11_spelling, op12_language_model, op13_centroids)}

def _centroid_sql(rounds: int) -> str:
    """Every round written out: distances by inner products (whole numbers in doubles), sums floored exactly."""
    parts = ["""e as materialized (select row_number() over () as row_id, vec_id,
                    list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
                    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
             """c0 as materialized (select row_number() over (order by sha256('3:' || coalesce(vec_id::text, '')), v) - 1 as k, v
                    from e qualify k < 8)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (select row_id, e.v, min((list_dot_product(e.v, e.v) + list_dot_product(c{i}.v, c{i}.v)
                    - 2 * list_dot_product(e.v, c{i}.v), k)) as best from e, c{i} group by all)""")
        if i < rounds:
            parts.append(f"""s{i} as (select best[2] as k, i, sum(x::bigint) as s, count(*) as n
                    from (select best, unnest(v) as x, generate_subscripts(v, 1) as i from a{i}) group by all)""")
            parts.append(f"""c{i + 1} as materialized (select k, coalesce(m.v, c{i}.v) as v from c{i} left join
                    (select k, list(((s - ((s % n) + n) % n) // n)::double order by s{i}.i) as v from s{i} group by k) m using (k))""")
    return f"""with {", ".join(parts)}
        select vec_id, best[2]::int as cluster, best[1]::bigint as distance,
               (sum(best[1]::bigint) over (partition by best[2]))::bigint as cluster_inertia,
               (sum(best[1]::bigint) over ())::bigint as inertia,
               sha256(array_to_string(list_transform(c{rounds}.v, lambda x: x::bigint), ',')) as centroid_sha256
        from a{rounds} join e using (row_id) join c{rounds} on k = best[2]"""


SQL = {
    "op13_centroids": _centroid_sql(10),
    "op1_chat": r"""
        with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all select -7, 0, 'user', '\### Assistant: </turn> ok'
                   union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        f as (select *, row_number() over w as k, count(*) over (partition by conv_id) as n,
                     14 + length(role) + length(text)
                       + length(regexp_replace(role || text, '[^\\#]', '', 'g'))
                       + (length(replace(text, '</', '<__')) - length(text))
                       + (length(replace(role, '</', '<__')) - length(role))
                       + length(regexp_replace(role, '[^\n]', '', 'g')) as chars
              from c window w as (partition by conv_id order by turn nulls first, role, text)),
        g as (select *, sum(chars) over (partition by conv_id order by k) as upto from f)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), '')) as loss_sha256,
               cast(sum(upto) filter (where role = 'assistant' or k = n) as bigint) as formatted_chars
        from g group by conv_id""",
    "op7_urls": r"""
        with p as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                          regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
        r as (select * from (values ('org', '/', 'allow', 1), ('example.org', '/es/', 'block', 1),
                ('example.org', '/en/1', 'block', 1), ('com', '/fr/', 'allow', 1), ('com', '/de/', 'block', 1),
                ('spam-farm.example.org', '/', 'block', 0), ('cheap-pills.example.com', '/', 'block', 0), ('adult-x.example.net', '/', 'block', 0))
                as t(h, p, action, rank)),
        b as (select p.host, p.path, max((length(r.h || r.p), r.h || r.p, r.action)) filter (where rank = 1) as rule,
                     bool_or(rank = 0) as listed
              from (select distinct host, path from p) p
              join r on (p.host = r.h or p.host like '%.' || r.h) and starts_with(p.path, r.p) group by all)
        select p.page_id, p.host, p.path, b.rule[2] as rule,
               coalesce(b.rule[3], case when b.listed then 'block' end, 'allow') as verdict
        from p left join b using (host, path)""",
    "op2_exact_dedup": r"""
        with d as (select doc_id, length(coalesce(text, '')) as chars,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
                   from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
               row_number() over w = 1 as kept, text_sha256
        from d window w as (partition by text_sha256 order by chars desc, doc_id nulls last)""",
}
