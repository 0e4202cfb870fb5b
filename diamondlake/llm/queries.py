"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.llm import mil_toxicity
from diamondlake.llm import brown_lm
from diamondlake.llm import chat_template
from diamondlake.llm import collision_counting
from diamondlake.llm import gain_table
from diamondlake.llm.grammar_runs import find_runs
from diamondlake.llm.hyperminhash import near_duplicates
from diamondlake.llm.level_packing import pack_documents
from diamondlake.llm import multi_index
from diamondlake.llm.merge_replay import round_trip
from diamondlake.llm.prefix_bpe import count_tokens
from diamondlake.llm.suffix_dedup import mark_repeats, repeat_digests
from diamondlake.llm.url_reputation import Rule, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op1_multi_index(spark, sf_dir):
    """Queries: every row whose id is divisible by 100, against all rows."""
    index = multi_index.MultiIndex(table(spark, sf_dir, "embeddings"), centroids=64)
    return multi_index.search(index, index.rows.where(F.col("id") % 100 == 0), k=10, share=0.45)


@query
def op2_prefix_token_counts(spark, sf_dir):
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op3_collision_counting(spark, sf_dir):
    return collision_counting.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


TOXIC_FROM = 0.3


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> mil_toxicity.Model:
    """Learnt from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(~mil_toxicity.held_out(F.col("doc_id")))
    return mil_toxicity.fit(docs, labels)


@query
def op4_mil_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scored = mil_toxicity.score_documents(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id", mil_toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


@query
def op5_brown_lm(spark, sf_dir):
    docs = documents(spark, sf_dir)
    named = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    model = brown_lm.train(docs.where(~brown_lm.held_out(F.col("doc_id"))), prepare=named, learns=~brown_lm.held_out(F.col("id")))
    scored = brown_lm.score(docs, model)
    return scored.select(
        "doc_id", brown_lm.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


@query
def op6_hyperminhash(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), threshold=0.75).drop("text_key")


@query
def op7_merge_replay_bpe(spark, sf_dir):
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_suffix_dedup(spark, sf_dir):
    """Repeats of 400 bytes are judged; beside them ``n_run_words`` counts words in repeated runs of 51 words."""
    return repeat_digests(mark_repeats(documents(spark, sf_dir), length=400, words=51))


@query
def op9_level_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, window=2048)


URL_RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)


@query
def op10_url_reputation(spark, sf_dir):
    """Every page's url by rules, else by the posterior bound of its host.

    The outcome of a page is the quality label of the document of the same id.
    """
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op10_url_reputation"] = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(r.verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
h AS (
  SELECT host, count(quality) AS n, coalesce(sum(1 - quality), 0)::DOUBLE AS bad,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS dom, string_split(host, '.')[-1] AS suf
  FROM p LEFT JOIN labels ON page_id = doc_id GROUP BY host),
d AS (SELECT suf, dom, sum(n)::DOUBLE AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suf, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
levels AS (
  SELECT 0 AS lv, n, bad FROM s UNION ALL SELECT 1, n, bad FROM d UNION ALL SELECT 2, n, bad FROM h),
sums AS (
  SELECT lv, sum(n) AS t, sum(bad) AS b, sum(n * n) AS n2, count(*) AS k, sum(bad * bad / n) AS b2
  FROM levels WHERE n > 0 GROUP BY lv),
rho AS (
  SELECT lv, greatest(0.001, least(0.5, coalesce(
    (b2 - b * b / t - base * (k - 1)) / CASE WHEN base > 0 AND free > 0 THEN base * free END, 0.5))) AS rho
  FROM (SELECT *, b / t * (1 - b / t) AS base, t - n2 / t - (k - 1) AS free FROM sums)),
m AS (SELECT max((1 - rho) / rho) FILTER (lv = 0) AS m0, max((1 - rho) / rho) FILTER (lv = 1) AS m1,
  max((1 - rho) / rho) FILTER (lv = 2) AS m2, (SELECT sum(bad) / sum(n) FROM s) AS mu FROM rho),
sm AS (SELECT suf, (m0 * mu + bad) / (m0 + n) AS ms FROM s, m),
dm AS (SELECT dom, (m1 * ms + bad) / (m1 + n) AS md FROM d JOIN sm USING (suf), m),
hm AS (SELECT host, m2 * md + bad AS a, m2 * (1 - md) + n - bad AS b FROM h JOIN dm USING (dom), m),
bound AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lo FROM hm)
SELECT p.page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN lo > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits USING (page_id) LEFT JOIN bound USING (host)
"""


@query
def op11_chat_machine(spark, sf_dir):
    """All conversations and one of control strings, formatted and read back."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{control}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    read = chat_template.read_back(chat_template.format_turns(conversations.unionByName(added)))
    return read.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_faults")


ORACLE["op11_chat_machine"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, regexp_replace(regexp_replace(text, '(<)(\\*)(/s>)', '\1\\\2\3', 'g'),
    '(\[)(\\*)(/?SYS\]|/?INST\]|ROLE\]|/?TEXT\])', '\1\\\2\3', 'g') AS safe FROM c),
f AS (
  SELECT *, CASE role WHEN 'system' THEN '[SYS] ' || safe || ' [/SYS]' WHEN 'user' THEN '[INST] ' || safe || ' [/INST]'
    WHEN 'assistant' THEN ' ' || safe || '</s>' ELSE '[ROLE] ' || role || ' [TEXT] ' || safe || ' [/TEXT]' END AS formatted FROM e),
g AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, formatted), 'start') AS before FROM f)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars,
  count(*) FILTER (NOT ((role = 'user' AND before IN ('start', 'system', 'assistant')) OR (role = 'system' AND before = 'start')
    OR (role = 'assistant' AND before = 'user'))) AS n_faults
FROM g GROUP BY conv_id
"""


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of every tenth text, told by its id's crc32, repeating from a place on; the rest as they are."""
    known = docs.withColumn("__h", F.crc32(F.col("doc_id").cast("string"))).withColumn("__g", F.floor(F.col("__h") / 10))
    chosen = F.coalesce(F.col("__h") % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    known = known.withColumn("__words", words).withColumn("__n", F.coalesce(F.size("__words"), F.lit(0)))
    planted = F.col("__n") > 0
    known = known.withColumn("__a", F.when(planted, F.col("__g") % F.col("__n")))
    known = known.withColumn("__p", F.when(planted, 1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8))))
    place = F.expr("transform(sequence(0, __n - 1), i -> CAST(IF(i < __a, i, __a + (i - __a) % __p) AS INT))")
    known = known.withColumn("__place", F.when(planted, place))
    text = F.when(planted, F.array_join(F.expr("transform(__place, i -> __words[i])"), " ")).otherwise(F.col("text"))
    return known.withColumn("text", text).select(*docs.columns)


@query
def op12_grammar_runs(spark, sf_dir):
    found = find_runs(with_planted_period(documents(spark, sf_dir)))
    # The greatest length / period as an exact comparison of products.
    best = F.aggregate("runs", F.element_at("runs", 1), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_gain_resampling(spark, sf_dir):
    """A tenth of the documents, drawn by how much more their words belong to the benchmark's texts."""
    return gain_table.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), longest=1, buckets=10_000, share=10, least_words=20, seed=2024)
