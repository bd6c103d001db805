"""The registered query of each operator, with its production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from flowloom.llm.ann import nearest
from flowloom.llm.bpe import encode_texts
from flowloom.llm.decontaminate import leaks
from flowloom.llm.line_dedup import passage_dedup
from flowloom.llm.lm_scoring import lm_scores
from flowloom.llm.minhash import near_duplicates
from flowloom.llm.pfp_dedup import repeated_bytes
from flowloom.llm.registry import CHECKS, QUERIES, query, table
from flowloom.llm.secret_scan import digest, secret_scan
from flowloom.llm.simhash import simhash_groups
from flowloom.llm.spelling import corpus_words, spelling_variants
from flowloom.llm.substring_dedup import substring_dedup
from flowloom.llm.toxicity import label_categories, toxicity
from flowloom.llm.whitening import whiten

__all__ = ["CHECKS", "QUERIES"]


@query("op2_substring_dedup", """
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + 12), ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13)),
hits AS (SELECT doc_id, p FROM grams JOIN (SELECT g, min(doc_id) AS least FROM grams GROUP BY g) USING (g) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM hits),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)""")
def op2(spark, folder):
    found = substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_repeated_bytes")
def op6(spark, folder):
    found = repeated_bytes(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_lm_scores", """
WITH w AS (SELECT doc_id, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS i
           FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS x FROM documents)),
t AS (SELECT doc_id, i, c, lag(c) OVER d AS b, lag(c, 2) OVER d AS a FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT doc_id, count(*) AS own, sum(count(*)) OVER () - count(*) AS rest FROM w GROUP BY doc_id),
k1 AS (SELECT doc_id, c, sum(k) OVER (PARTITION BY c) - k AS k FROM (SELECT doc_id, c, count(*) AS k FROM t GROUP BY ALL)),
k2 AS (SELECT doc_id, b, c, sum(k) OVER (PARTITION BY b, c) - k AS k FROM (SELECT doc_id, b, c, count(*) AS k FROM t WHERE b IS NOT NULL GROUP BY ALL)),
k3 AS (SELECT doc_id, a, b, c, sum(k) OVER (PARTITION BY a, b, c) - k AS k
       FROM (SELECT doc_id, a, b, c, count(*) AS k FROM t WHERE a IS NOT NULL GROUP BY ALL)),
s AS (SELECT t.doc_id, CASE WHEN k3.k > 0 THEN ln(k3.k) - ln(kab.k)
        WHEN kbc.k > 0 THEN ln(kbc.k) - ln(kb.k) + CASE WHEN t.a IS NULL THEN 0 ELSE ln(0.4) END
        ELSE ln(greatest(kc.k, 1)) - ln(CASE WHEN kc.k > 0 THEN rest ELSE rest + 1 END)
             + ln(0.4) * (CASE WHEN t.b IS NULL THEN 0 ELSE 1 END + CASE WHEN t.a IS NULL THEN 0 ELSE 1 END) END AS v
      FROM t JOIN n USING (doc_id) LEFT JOIN k1 kc ON kc.doc_id = t.doc_id AND kc.c = t.c
      LEFT JOIN k1 kb ON kb.doc_id = t.doc_id AND kb.c = t.b LEFT JOIN k2 kbc ON kbc.doc_id = t.doc_id AND kbc.b = t.b AND kbc.c = t.c
      LEFT JOIN k2 kab ON kab.doc_id = t.doc_id AND kab.b = t.a AND kab.c = t.b
      LEFT JOIN k3 ON k3.doc_id = t.doc_id AND k3.a = t.a AND k3.b = t.b AND k3.c = t.c)
SELECT d.doc_id, count(v)::BIGINT AS n_tokens, round(coalesce(sum(v), 0), 4) AS log_score, round(avg(v), 6) AS mean_log_score
FROM documents d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id""")
def op9(spark, folder):
    found = lm_scores(table(spark, folder, "documents"))
    return found.select("doc_id", "n_tokens", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


@query("op3_decontaminate")
def op3(spark, folder):
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_nearest")
def op4(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op5_byte_bpe")
def op5(spark, folder):
    coded = encode_texts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_toxicity")
def op7(spark, folder):
    scored = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), label_categories())
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


@query("op8_simhash")
def op8(spark, folder):
    found = simhash_groups(table(spark, folder, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op1_secret_scan")
def op1(spark, folder):
    return digest(secret_scan(table(spark, folder, "documents")))


@query("op10_line_dedup")
def op10(spark, folder):
    found = passage_dedup(table(spark, folder, "documents"))
    lines = F.aggregate("removed_chunks", F.lit(0).cast("long"), lambda n, c: n + c["last"] - c["first"] + 1)
    return found.select("doc_id", F.size("removed_chunks").cast("long").alias("n_removed_chunks"), lines.alias("n_removed_lines"),
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op11_whitening")
def op11(spark, folder):
    found = whiten(table(spark, folder, "embeddings"), components=4, scale=256.0)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value")
    return found.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "value.whitened", "value.explained", "identity_error")


@query("op12_spelling")
def op12(spark, folder):
    return spelling_variants(corpus_words(table(spark, folder, "documents")), ratio=10)


@query("op13_minhash")
def op13(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
