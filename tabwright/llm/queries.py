"""The queries opN_<name> of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import decontamination, embedding_dedup, minhash_dedup, mixing, quality_ranking, ring_sharding, suffix_dedup, token_store, toxicity, url_reputation
from tabwright.llm.common import crc_fold, scratch_dir, table

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from folds 1 to 4 of 5; fold 0 is held out."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_ranking.fit(documents, labels.where(crc_fold(F.col("doc_id"), 5) != 0), cut=0.3)
    scored = quality_ranking.score(documents, model)
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_dir(spark, 'token-store')}/store"
    token_store.write_store(table(spark, sf_dir, "documents"), folder, vocabulary(), end_id=0)
    return token_store.read_index(spark, folder)


def op5_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_sharding.shard_rows(table(spark, sf_dir, "documents"))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from folds 0 and 2 of 3; fold 1 is held out."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels.where(crc_fold(F.col("doc_id"), 3) != 1))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document whose id its path's first number names. That is an assumption:
    the tables have no outcomes of pages, and nothing in them says that the number is a document's id."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").where("quality is not null").groupBy("doc_id").agg((1 - F.max("quality")).alias("bad"))
    named = pages.select("page_id", F.expr("try_cast(nullif(regexp_extract(url, '^(?s:.*?)://[^/?#]*[^?#0-9]*/([0-9]+)', 1), '') as bigint)").alias("doc_id"))
    outcomes = named.join(labels, "doc_id").select("page_id", "bad")
    judged = url_reputation.judge_urls(pages, outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad_mean", 6).alias("bad_mean"), F.round("bad_lower", 6).alias("bad_lower"))


def _strength(level: str, mean: str) -> str:
    return f"""(SELECT CASE WHEN sum({mean} * (1 - {mean}) * (n - 1)) > 0 THEN least(greatest(1 / greatest(
      (sum(n * (bad / n - {mean}) ** 2) - sum({mean} * (1 - {mean}))) / sum({mean} * (1 - {mean}) * (n - 1)), 1e-4) - 1, 1.0), 1e4) ELSE 2.0 END
      FROM {level} WHERE n > 0)"""


def _shrunk(level: str, up: str, key: str, mean: str, up_mean: str) -> str:
    """The group's prior mean: the posterior mean of the group above without the group's own outcomes."""
    good = f"({up_mean} * s + u.bad - l.bad)"
    bad = f"((1 - {up_mean}) * s + (u.n - u.bad) - (l.n - l.bad))"
    return f"(SELECT l.*, {good} / ({good} + {bad}) AS {mean} FROM {level} l JOIN (SELECT *, {_strength(up, up_mean)} AS s FROM {up}) u USING ({key}))"


URL_SQL = f"""
WITH parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
base AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
  try_cast(nullif(regexp_extract(rest, '^[^/?#]*[^?#0-9]*/([0-9]+)', 1), '') AS BIGINT) AS doc_id FROM parts),
outcome AS (SELECT page_id, max(bad) AS bad FROM base JOIN (SELECT doc_id, 1 - max(quality) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id) GROUP BY 1),
hosts AS (SELECT host, CASE WHEN len(string_split(host, '.')) > 1 THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE host END AS domain, string_split(host, '.')[-1] AS suffix,
  CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad FROM base LEFT JOIN outcome USING (page_id) GROUP BY 1),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (sum(sum(bad)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS mean0 FROM domains GROUP BY 1),
domains1 AS {_shrunk("domains", "suffixes", "suffix", "mean1", "mean0")},
hosts2 AS {_shrunk("hosts", "domains1", "domain", "mean2", "mean1")},
posterior AS (SELECT host, mean2 * s + bad AS a, (1 - mean2) * s + n - bad AS b FROM (SELECT *, {_strength("hosts2", "mean2")} AS s FROM hosts2)),
bounds AS (SELECT host, a / (a + b) AS bad_mean, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bad_lower FROM posterior),
ruled AS (SELECT *, CASE {" ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for _, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])))} END AS rule FROM base JOIN bounds USING (host))
SELECT page_id, host, path, rule, CASE {" ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in URL_RULES)} WHEN bad_lower > 0.5 THEN 'block' ELSE 'allow' END AS verdict, round(bad_mean, 6) AS bad_mean, round(bad_lower, 6) AS bad_lower FROM ruled
"""


def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_template_decontamination": op1_template_decontamination,
        "op2_prob_minhash": op2_prob_minhash,
        "op3_bradley_terry": op3_bradley_terry,
        "op4_token_store": op4_token_store,
        "op5_ring_sharding": op5_ring_sharding,
        "op6_weak_supervision": op6_weak_supervision,
        "op7_prefix_doubling": op7_prefix_doubling,
        "op8_mixing": op8_mixing,
        "op9_url_reputation": op9_url_reputation,
        "op10_cross_polytope": op10_cross_polytope,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_url_reputation": URL_SQL}
