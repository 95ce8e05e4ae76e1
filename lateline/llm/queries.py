"""The operators as queries over whole tables, with production parameters, and the SQL they are compared to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lateline.llm import private_data
from lateline.llm.block_names import name_documents
from lateline.llm.cover_tree import top_k
from lateline.llm.filter_audit import audit_filters
from lateline.llm.line_templates import drop_recurring_lines
from lateline.llm.minhash import link_documents
from lateline.llm.mixing import mix_sources, token_count
from lateline.llm.packing import pack_documents
from lateline.llm.periodic_runs import report_runs
from lateline.llm.repeats import remove_repeats
from lateline.llm.private_data import find_private_data
from lateline.llm.syncmers import fingerprint_documents
from lateline.llm.toxicity import held_out, score_documents, train
from lateline.llm.url_rules import ALLOW, BLOCK, judge_urls
from lateline.workspace import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), token_count(F.col("text")).alias("n_tokens"),
        F.col("mix_block").alias("block"), F.col("mix_place").alias("place"),
    )


SQL["op3_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
),
sizes AS (
  SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS t, ln(CAST(sum(n_tokens) AS DOUBLE)) AS l
  FROM docs GROUP BY source HAVING sum(n_tokens) > 0
),
bisection AS (
  WITH RECURSIVE halves AS (
    SELECT 0 AS step, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi
    UNION ALL
    SELECT step + 1, CASE WHEN met THEN mid ELSE lo END, CASE WHEN met THEN hi ELSE mid END
    FROM (
      SELECT step, lo, hi, (lo + hi) / 2 AS mid,
             (SELECT ln(sum(exp(l * (lo + hi) / 2))) - (lo + hi) / 2 * sum(exp(l * (lo + hi) / 2) * l)
                       / sum(exp(l * (lo + hi) / 2)) >= 0.95 * ln(count(*))
                     OR (max(l) - min(l)) * (1 - (lo + hi) / 2) >= ln(1.5)
              FROM sizes) AS met
      FROM halves WHERE step < 48)
  )
  SELECT lo FROM halves WHERE step = 48
),
budgets AS (
  SELECT source, CAST(t AS BIGINT) AS t,
         CAST(round(t * exp(((SELECT lo FROM bisection) - 1) * (l - (SELECT max(l) FROM sizes)))) AS BIGINT) AS b
  FROM sizes
),
plan AS (SELECT source, greatest(1, b // t) AS whole_blocks, b % t AS left_tokens FROM budgets),
whole AS (
  SELECT d.*, unnest(range(0, coalesce(whole_blocks, 1))) AS block FROM docs d LEFT JOIN plan USING (source)
),
part AS (
  SELECT * FROM (
    SELECT d.*, whole_blocks AS block, left_tokens,
           md5('7:' || whole_blocks || ':' || doc_id) AS place,
           sum(n_tokens) OVER (PARTITION BY source ORDER BY md5('7:' || whole_blocks || ':' || doc_id)
                               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           - sum(n_tokens) OVER (PARTITION BY source, md5('7:' || whole_blocks || ':' || doc_id)) AS before
    FROM docs d JOIN plan USING (source) WHERE left_tokens > 0)
  WHERE before < left_tokens
)
SELECT doc_id, source, n_tokens, block, md5('7:' || block || ':' || doc_id) AS place FROM whole
UNION ALL
SELECT doc_id, source, n_tokens, block, place FROM part
"""

# The rules of the contract.
URL_RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


@query
def op5_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


SQL["op5_judge_urls"] = r"""
WITH rules (rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parsed AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
judged AS (
  SELECT n, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM parsed JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN judged USING (n)
"""


@query
def op9_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_drop_recurring_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_recurring_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL["op8_drop_recurring_lines"] = r"""
WITH split AS (
  SELECT doc_id, "text", unnest(string_split("text", chr(10))) AS line,
         generate_subscripts(string_split("text", chr(10)), 1) AS position
  FROM documents
),
masked AS (
  SELECT doc_id, "text", line, position,
         list_transform(string_split(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' '),
                        lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS tokens
  FROM split
),
lines AS (
  SELECT *, len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf, array_to_string(tokens, ' ') AS template
  FROM masked WHERE len(tokens) >= 3
),
large AS (SELECT leaf, count(*) AS lines FROM lines GROUP BY leaf HAVING count(*) >= 10),
tokens AS (
  SELECT leaf, lines, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot FROM lines JOIN large USING (leaf)
),
counted AS (SELECT leaf, lines, spot, token, count(*) AS n FROM tokens GROUP BY ALL),
best AS (
  SELECT leaf, spot, arg_max(token, (n, token)) AS token, max(n) / any_value(lines) AS share FROM counted GROUP BY leaf, spot
),
leaves AS (
  SELECT * FROM (
    SELECT leaf, list(CASE WHEN share >= 0.8 THEN token ELSE '<*>' END ORDER BY spot) AS leaf_tokens,
           count(*) FILTER (share >= 0.8 AND token <> '<*>') AS constants
    FROM best GROUP BY leaf)
  WHERE constants >= 0.7 * len(leaf_tokens)
),
keyed AS (
  SELECT doc_id, "text", position,
         CASE WHEN len(list_filter(list_zip(tokens, leaf_tokens), lambda x: x[2] <> '<*>' AND x[1] = x[2])) >= 0.8 * constants
              THEN leaf || chr(10) || array_to_string(leaf_tokens, ' ') ELSE l.template END AS template
  FROM lines l LEFT JOIN leaves USING (leaf)
),
recurring AS (
  SELECT template, min(doc_id) AS first_doc FROM keyed GROUP BY template HAVING count(DISTINCT "text") >= 10
),
drops AS (
  SELECT DISTINCT doc_id, position FROM keyed JOIN recurring USING (template) WHERE doc_id <> first_doc
),
kept AS (
  SELECT s.doc_id, count(*) AS n_lines, count(d.doc_id) AS n_dropped,
         string_agg(line, chr(10) ORDER BY s.position) FILTER (d.doc_id IS NULL) AS kept_text
  FROM split s LEFT JOIN drops d ON s.doc_id = d.doc_id AND s.position = d.position GROUP BY s.doc_id
)
SELECT o.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM documents o LEFT JOIN kept USING (doc_id)
"""


@query
def op10_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op6_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op7_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = remove_repeats(table(spark, sf_dir, "documents"))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op1_link_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))


@query
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


SQL["op2_top_k"] = r"""
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS spot FROM embeddings
),
whole AS (
  SELECT vec_id, list(CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) ORDER BY spot) AS v
  FROM parts GROUP BY vec_id
  HAVING bool_and(x IS NOT NULL AND isfinite(x))
),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS score
  FROM whole q JOIN whole d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, CAST(score AS BIGINT) AS score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op4_find_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_private_data(docs, private_data.train(docs))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[
            F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}")
            for kind in private_data.KINDS
        ],
        F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op11_name_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = name_documents(table(spark, sf_dir, "documents"))
    return named.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL["op11_name_documents"] = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce("text", '')) AS n, regexp_replace(coalesce("text", ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents
),
grouped AS (
  SELECT doc_id, plain, count(*) OVER (PARTITION BY plain) AS group_size,
         first_value(doc_id) OVER best AS keep_id, row_number() OVER best = 1 AS kept
  FROM plain WINDOW best AS (PARTITION BY plain ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, sha256(plain) AS text_sha256 FROM grouped
"""


@query
def op12_audit_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op12_audit_filters"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t,
         regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
least AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM texts JOIN least USING (t) LEFT JOIN marks USING (doc_id)
),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS n_good, sum(bad) AS n_bad FROM failed GROUP BY part, fails),
letters (x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
states AS (
  SELECT part, filter_order, step, filter_order[step] AS letter, n, n_good, n_bad, fails, contains(fails, filter_order[step]) AS fails_it,
         len(translate(fails, filter_order[1:step - 1], '')) < len(fails) AS gone
  FROM counted, steps
),
summed AS (
  SELECT part, filter_order, step, letter,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_it), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND fails_it), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (fails = letter), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n_good) FILTER (NOT gone AND fails_it), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n_bad) FILTER (NOT gone AND fails_it), 0) AS BIGINT) AS toxic_lost
  FROM states GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""


@query
def op13_find_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_runs(table(spark, sf_dir, "documents"), loops=True)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
