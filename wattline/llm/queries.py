"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.llm import (ann_tree, exact_dedup, jaccard_join, lang_id, phrases, piece_codec, pii, secret_scan, sharding, source_mix, spelling,
                          token_count, toxicity)
from wattline.llm.common import is_held_out, load

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _hex(col):
    return F.sha2(F.coalesce(col, F.lit("")).cast("binary"), 256)


@query
def op1_secret_scan(spark, sf_dir):
    spans = F.col("spans")
    base = [r.kind for r in secret_scan.BASE_RULES]

    def digest(kept):
        return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    rows = secret_scan.find_secrets(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                       _hex(digest(F.filter(spans, lambda s: s["kind"].isin(base)))).alias("base_sha256"),
                       digest(spans).alias("spans"))


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.with_groups(load(spark, sf_dir, "documents"))


ORACLES["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""


@query
def op3_token_counts(spark, sf_dir):
    return token_count.count_tokens(load(spark, sf_dir, "documents"))


@query
def op4_source_mix(spark, sf_dir):
    rows = source_mix.mix(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS sz, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER q AS pos,
         1.5::DOUBLE * sum(sz) OVER ()::DOUBLE - 2 * coalesce(sum(sz) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
         sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS w_rest
  FROM s WINDOW q AS (ORDER BY sz::DOUBLE / w, source NULLS LAST)),
f AS (SELECT rest AS f_rest, w_rest AS f_w, pos AS f_pos FROM o WHERE NOT (2 * sz * w_rest < rest * w) ORDER BY pos LIMIT 1),
t AS (
  SELECT o.source, o.sz, CASE WHEN f_pos IS NULL OR pos < f_pos THEN 2.0::DOUBLE * sz ELSE least(f_rest * w / f_w, 2.0::DOUBLE * sz) END AS target
  FROM o LEFT JOIN f ON true),
g AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
b AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('0:' || doc_id::VARCHAR), doc_id, size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d)
SELECT doc_id, size, sz AS source_size, target,
       CASE WHEN sz = 0 THEN 0 ELSE (quota // sz) * size + least(size, greatest(0, quota % sz - before)) END::BIGINT AS taken
FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source"""


@query
def op5_language_id(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    rows = lang_id.identify(docs, lang_id.fit(docs))
    return rows.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op6_toxicity(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    rows = toxicity.score_toxicity(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))
    return rows.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op7_sharding(spark, sf_dir):
    rows = sharding.shard_by_bytes(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_sentencepiece(spark, sf_dir):
    rows = piece_codec.encode_decode(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       _hex(F.array_join("ids", ",")).alias("ids_sha256"), _hex(F.col("text")).alias("decoded_sha256"))


@query
def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(load(spark, sf_dir, "documents"))


@query
def op10_nearest_neighbours(spark, sf_dir):
    return ann_tree.search(load(spark, sf_dir, "embeddings"))


@query
def op11_phrases(spark, sf_dir):
    return phrases.collocations(load(spark, sf_dir, "documents"))


ORACLES["op11_phrases"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS v(m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT c.*, v.k FROM c, (VALUES (1), (2)) AS v(k) WHERE v.k < c.m),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.ws[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.ws[k.k + 1:k.m], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS longer FROM c, (VALUES (1), (2)) AS v(i) WHERE m = 3 GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE NOT coalesce(100 * longer >= 50 * a, false)),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM z JOIN t USING (lang) WHERE rank <= 2000"""


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(load(spark, sf_dir, "documents"))


@query
def op13_pii(spark, sf_dir):
    spans = F.col("spans")

    def digest(kept):
        return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["strict"] & (s["kind"] == kind))).cast("long")

    rows = pii.find_pii(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS],
                       _hex(digest(F.filter(spans, lambda s: s["strict"]))).alias("base_sha256"), digest(spans).alias("spans"))
