"""The registered queries of the corpus operators: thin wrappers that apply one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import (
    common, decontamination, language_id, language_model, near_copies, neighbours, packing, piece_sampling, secret_scan, strata_search,
    token_alignment, topk_search, toxicity, url_filter,
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    held_out = common.fold("doc_id", 4) == 2
    model = language_id.fit(documents.filter(~held_out))
    found = language_id.predict(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    return topk_search.search(documents, F.col("doc_id") % 100 == 0)


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    return piece_sampling.segmentations(documents)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(common.table(common.importable(spark), sf_dir, "documents"), folds=10)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    held_out = common.fold("doc_id", 5) == 0
    model = toxicity.fit(documents.filter(~held_out), common.table(spark, sf_dir, "labels"))
    found = toxicity.predict(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = common.table(common.importable(spark), sf_dir, "embeddings")
    return neighbours.search(embeddings, F.col("vec_id") % 100 == 0)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(common.table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op8_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.deduplicate(common.table(common.importable(spark), sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(common.importable(spark), sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    return secret_scan.digest(secret_scan.scan(documents, secret_scan.fit(documents)))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(common.table(common.importable(spark), sf_dir, "documents"))


def op12_strata_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    return strata_search.search(documents, common.table(spark, sf_dir, "benchmark")).withColumnRenamed("query_id", "item_id")


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.importable(spark), sf_dir, "documents")
    return decontamination.digest(decontamination.contaminated(documents, common.table(spark, sf_dir, "benchmark")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_topk_search, op3_piece_sampling, op4_language_model, op5_toxicity, op6_neighbours, op7_url_filter,
        op8_near_copies, op9_packing, op10_secret_scan, op11_token_alignment, op12_strata_search, op13_decontamination,
    )
}

_HOST = "coalesce(translate(regexp_extract({rest}, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"

ORACLE = {
    "op12_strata_search": strata_search.ORACLE,
    "op13_decontamination": decontamination.ORACLE,
    "op2_topk_search": r"""
WITH words AS (
  SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \t\n\x0B\f\r]+')) AS word FROM documents) WHERE word <> ''
), tf AS (SELECT doc_id, word, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
len AS (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS n, avg(len) AS mean FROM len),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id,
    round(sum(q.tf * ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
  FROM tf q JOIN tf d USING (word) JOIN df USING (word) JOIN len ON len.doc_id = d.doc_id, total
  WHERE q.doc_id % 100 = 0 AND d.doc_id <> q.doc_id GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
""",
    "op7_url_filter": f"""
WITH parted AS (
  SELECT page_id, {_HOST.format(rest=_REST)} AS host, coalesce(regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), rules(rule, verdict, rule_host, rule_path) AS (VALUES
  ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'), ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
  ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')
), judged AS (
  SELECT page_id, host, path,
    (SELECT max_by(r.rule, length(r.rule)) FROM rules r WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)) AS rule
  FROM parted
), ruled AS (SELECT judged.*, rules.verdict AS by_rule,
    CASE WHEN rule IS NULL THEN (SELECT max_by(p.pattern, length(p.pattern) * 1000 - p.place) FROM (VALUES
      ('*.ads.*/*', '^.*\\.ads\\..*/.*$', 2), ('*.doubleclick.*/*', '^.*\\.doubleclick\\..*/.*$', 1), ('*/ads/*', '^.*/ads/.*$', 4),
      ('*/tracker/*', '^.*/tracker/.*$', 3), ('*.ads-track.*/*', '^.*\\.ads-track\\..*/.*$', 0)) p(pattern, regex, place)
      WHERE regexp_matches(host || path, p.regex)) END AS pattern
  FROM judged LEFT JOIN rules USING (rule))
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict, pattern FROM ruled
""".replace("\\\\", "\\"),
    "op6_neighbours": """
WITH good AS (
  SELECT vec_id, min(embedding) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE))))) AS score
  FROM good q, good c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs QUALIFY rank <= 10
""",
}
