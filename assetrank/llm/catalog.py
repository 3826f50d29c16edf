"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetrank.llm import ann, collocations, conversation_repair, decontaminate, html_extract, license_scan, ngram_join, packing, pii, quality, sharding, simhash_tree, url_filter
from assetrank.llm.license_texts import LICENSES
from assetrank.llm.tables import docs_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op7_consistent_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(docs_of(spark, sf_dir), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs_of(spark, sf_dir), tokenizer_path(), max_tokens=4096)


@query
def op6_text_to_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = html_extract.extract_pages(docs_of(spark, sf_dir, "pages"))
    return main.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: (verdict, host with path prefix)
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of pages: the number in a page's path is the document it shows, and
    ``labels`` judges documents (good: of quality and not toxic)."""
    pages = docs_of(spark, sf_dir, "pages")
    _, path = url_filter.host_and_path(F.col("url"))
    shown = pages.select("page_id", F.regexp_extract(path, "([0-9]{1,18})", 1).try_cast("bigint").alias("doc_id"))
    labels = docs_of(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min((F.col("quality") == 1).cast("int") * (F.col("toxic") == 0).cast("int")).alias("good"))
    return shown.join(labels, "doc_id").select("page_id", "good")


@query
def op2_path_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(docs_of(spark, sf_dir, "pages"), page_labels(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op3_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(docs_of(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


ORACLE["op3_vantage_point_trees"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, row_number() OVER () AS rid
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, q.rid, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
                          lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.rid <> c.rid
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id, rid ORDER BY score, vec_id) AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op8_seed_and_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs_of(spark, sf_dir), docs_of(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", F.col("end").alias("end_word"))


@query
def op10_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with their scores; rejected ones are absent."""
    judged = quality.classify(docs_of(spark, sf_dir))
    return judged.where("keep").select("doc_id", "score", "posterior")


@query
def op5_vertical_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(docs_of(spark, sf_dir), n=5, percent=80)
    return found.select("doc_id", "n_shingles", "component_id")


#: The key of the surrogates; a deployment passes its own secret.
PII_KEY = "corpus surrogates, key 1"


@query
def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(docs_of(spark, sf_dir), PII_KEY).select("doc_id", "text")


@query
def op4_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(docs_of(spark, sf_dir), LICENSES)


ORACLE["op5_vertical_jaccard_join"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'),
         lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT doc_id, doc_id AS c FROM sets UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.doc_id
)
SELECT sets.doc_id, any_value(len(s))::BIGINT AS n_shingles, min(c) AS component_id
FROM sets JOIN reach ON sets.doc_id = reach.doc_id GROUP BY sets.doc_id
"""


@query
def op11_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tree.simhash_components(docs_of(spark, sf_dir), n=4, distance=4).select("doc_id", "fingerprint", "component_id")


@query
def op12_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(docs_of(spark, sf_dir), least=10, top=2000, percent=50)


ORACLE["op12_toivonen_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece
  FROM documents
), runs AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), one AS (
  SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM runs) GROUP BY lang, x
), two AS (
  SELECT lang, p[1] AS x, p[2] AS y, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) AS p FROM runs) GROUP BY ALL HAVING count(*) >= 10
), three AS (
  SELECT lang, p[1] AS x, p[2] AS y, p[3] AS z, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS p FROM runs) GROUP BY ALL HAVING count(*) >= 10
), longer AS (
  SELECT lang, x, y, max(f) AS f
  FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY lang, x, y
), cuts AS (
  SELECT lang, x || ' ' || y AS phrase, two.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM two JOIN one l USING (lang, x) JOIN (SELECT lang, x AS y, f FROM one) r USING (lang, y) LEFT JOIN longer USING (lang, x, y)
  WHERE longer.f IS NULL OR 100 * longer.f < 50 * two.f
  UNION ALL
  SELECT lang, x || ' ' || y || ' ' || z, three.f, 1, l.f, r.f
  FROM three JOIN one l USING (lang, x) JOIN (SELECT lang, x AS y, y AS z, f FROM two) r USING (lang, y, z)
  UNION ALL
  SELECT lang, x || ' ' || y || ' ' || z, three.f, 2, l.f, r.f
  FROM three JOIN two l USING (lang, x, y) JOIN (SELECT lang, x AS z, f FROM one) r USING (lang, z)
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang) USING (lang)
QUALIFY rank <= 2000
"""


@query
def op13_survivor_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversation_repair.repair(conversation_repair.damaged(docs_of(spark, sf_dir, "conversations")))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
