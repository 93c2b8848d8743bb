"""Queries of the training-data operators over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (bytebpe, collocations, jaccard, langid, licenses, mainhtml, mixing, negatives, packing, pivots,
                           suffixes, topk, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op3_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS s FROM p),
d AS (SELECT page_id, payload_bytes, s, min(page_id) OVER (PARTITION BY s) AS first_id,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
          CAST('0x' || substr(s, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT)
          >> CAST(15 - 5 * (i % 4) AS INT)) % 32 AS INT), 1)), '') AS payload_digest
      FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), WORD_BPE).drop("ids")


@query("op1_langid")
def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs), spans=False)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op5_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0, k=5)


@query("op10_pivots", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
c AS (SELECT vec_id AS x, vec_id AS root FROM embeddings UNION SELECT l.y, c.root FROM c JOIN l ON c.x = l.x),
m AS (SELECT x, min(root) AS root FROM c GROUP BY x),
n AS (SELECT x, count(*) AS k FROM l GROUP BY x)
SELECT m.x AS vec_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_links, m.root AS component_id, m.x = m.root AS kept
FROM m LEFT JOIN n ON m.x = n.x""")
def op10_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.95)


@query("op8_jaccard")
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.link(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=5, percent=75)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query("op6_suffixes")
def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(spark.read.parquet(f"{sf_dir}/documents.parquet"), length=400, keep="none")


@query("op7_mainhtml")
def op7_mainhtml(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return mainhtml.extract(pages, mainhtml.learn(pages))


@query("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


# The mixture of the query: a domain is a stretch of a source's hash.
DOMAIN = "CASE WHEN substr(md5(source), 1, 1) < '8' THEN 'web' WHEN substr(md5(source), 1, 1) < 'c' THEN 'books' ELSE 'code' END"
DOMAIN_WEIGHTS, LANG_WEIGHTS = {"web": 5, "books": 3, "code": 2}, {"en": 5, "de": 2, "fr": 2, "es": 1}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 3, 7


def _level_sql(i: int, up: list[str], own: list[str], weight: str) -> str:
    """A level of the budget tree: children of `up` named by `own`."""
    keys, by = ", ".join(own), ", ".join(["0", *up])
    on = " AND ".join(["1 = 1", *(f"n.{c} = p{i}.{c}" for c in up)])
    cols = ", ".join(f"n.{c}" for c in own)
    return f"""
a{i} AS (SELECT {cols}, n.cap, {weight} AS w, p{i}.b FROM
    (SELECT {keys}, CAST(sum(cap) AS HUGEINT) AS cap FROM leaf GROUP BY {keys}) n JOIN p{i} ON {on}),
f{i} AS (SELECT *, sum(cap) OVER (PARTITION BY {by} ORDER BY cap::DOUBLE / w::DOUBLE, {keys} ROWS UNBOUNDED PRECEDING) AS c,
    coalesce(sum(w) OVER (PARTITION BY {by} ORDER BY cap::DOUBLE / w::DOUBLE, {keys}
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS rest FROM a{i}),
g{i} AS (SELECT *, c::HUGEINT * w + cap * rest::HUGEINT <= b * w AS full_ FROM f{i}),
h{i} AS (SELECT *, b - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER (PARTITION BY {by}) AS left_,
    sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (PARTITION BY {by}) AS share FROM g{i}),
p{i + 1} AS (SELECT {keys}, CASE WHEN full_ THEN cap ELSE (left_::HUGEINT * w) // nullif(share, 0)::HUGEINT END::HUGEINT AS b
  FROM h{i}),"""


def _case(column: str, table: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN n.{column} = '{k}' THEN {v}" for k, v in table.items()) + " ELSE 1 END"


@query("op2_mixing", f"""
WITH d AS (SELECT doc_id, coalesce({DOMAIN}, '(null)') AS domain, coalesce(lang, '(null)') AS lang,
    coalesce(source, '(null)') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS t, sum(tokens)::HUGEINT * {MIX_EPOCHS} AS cap
  FROM d GROUP BY domain, lang, source),
p0 AS (SELECT least(sum(cap), floor(sum(t)::DOUBLE * {MIX_SHARE})::HUGEINT)::HUGEINT AS b FROM leaf),
{_level_sql(0, [], ["domain"], _case("domain", DOMAIN_WEIGHTS))}
{_level_sql(1, ["domain"], ["domain", "lang"], _case("lang", LANG_WEIGHTS))}
{_level_sql(2, ["domain", "lang"], ["domain", "lang", "source"], "1")}
e AS (SELECT domain, lang, source, (b // t)::BIGINT AS epochs, (b - (b // t) * t)::BIGINT AS room
  FROM p3 JOIN leaf USING (domain, lang, source) WHERE t > 0 AND b > 0),
k AS (SELECT *, md5('{MIX_SEED}:' || epochs || ':' || doc_id) || '.' || doc_id AS key FROM d JOIN e USING (domain, lang, source)),
u AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k)
SELECT doc_id, domain, lang, source, tokens, epochs + CASE WHEN upto <= room THEN 1 ELSE 0 END AS copies
FROM u WHERE epochs > 0 OR upto <= room""")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("domain", F.expr(DOMAIN))
    weights = [mixing.weight_of("domain", DOMAIN_WEIGHTS), mixing.weight_of("lang", LANG_WEIGHTS), F.lit(1)]
    return mixing.select(docs, ["domain", "lang", "source"], weights, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


@query("op11_collocations", """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM g, range(1, 6) AS t(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.a >= 100 * c.a
    AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cut AS (SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y
  FROM kept, range(1, 5) AS r(j) WHERE j < k),
s AS (SELECT cut.lang, cut.phrase, cut.a, cut.j, fx.f AS l, fy.f AS r, t.n, (1000 * cut.a * t.n) // (fx.f * fy.f) AS score
  FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = cut.x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = cut.y
  JOIN t ON t.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score FROM o WHERE rank <= 2000""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(spark.read.parquet(f"{sf_dir}/documents.parquet"), least=100, longest=5, percent=100, top=2000)


@query("op12_bytebpe")
def op12_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = bytebpe.decode(bytebpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN), BYTE_BPE)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""")
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("id") % 50 == 0)
