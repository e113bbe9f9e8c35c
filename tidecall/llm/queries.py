"""One query per operator, over whole tables, with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecall.llm import (
    centroids,
    decontaminate,
    langid,
    licenses,
    lines,
    neighbours,
    ngram_join,
    packing,
    periodic,
    quality,
    sharding,
    toxicity,
    urls,
)
from tidecall.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.notice_table(spark))


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: checksum of its id as text, modulo the number of folds."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """From the labels outside fold 1 of 3."""
    known = labels.where(fold(F.col("doc_id"), 3) != 1).select("doc_id", "toxic")
    return toxicity.learn(docs.select("doc_id", "text").join(known, "doc_id"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    held_out = (fold(F.col("doc_id"), 3) == 1).alias("held_out")
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out, "score", "predicted")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.learn(docs.where(fold(F.col("doc_id"), 5) != 0))
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    found = langid.identify(docs, dictionaries)
    return found.select("doc_id", held_out, "lang_pred", "score", "margin", "rejected")


# The rules of the query and a list of domains to block where no rule fits.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
BLOCKED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED_DOMAINS = [f"{label}.example.{top}" for label in BLOCKED_LABELS for top in ("com", "net", "org")]


def url_rules(spark: SparkSession) -> DataFrame:
    rows = [(*rule, False) for rule in URL_RULES] + [(d, "", "block", True) for d in BLOCKED_DOMAINS]
    return spark.createDataFrame(rows, "host string, path string, action string, listed boolean")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), url_rules(spark))


_FITS = ", ".join(
    f"CASE WHEN ('.' || host) LIKE '%.{h}' AND starts_with(path, '{p}') THEN '{h}{p}' END"
    for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
)
_BLOCKED = ", ".join(f"'{h}{p}'" for h, p, action in URL_RULES if action == "block")
_LISTED = " OR ".join(f"('.' || host) LIKE '%.{d}'" for d in BLOCKED_DOMAINS)
OP10_SQL = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
ruled AS (
  SELECT *, coalesce({_FITS}) AS rule, ({_LISTED}) AS listed FROM parts
)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ({_BLOCKED}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; one text in ten repeats a stretch of its words up to its end.

    With h = crc32(id as text), g = h / 10 and n words: if h % 10 = 0, word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) / (3 + g % 8). Texts without words
    and rows without id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " ")

    # The list of words is bound once, not computed anew for each place.
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    changed = F.transform(words, lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.col("text")))
    return docs.select("doc_id", F.when(h % 10 == 0, F.get(changed, F.lit(0))).otherwise(F.col("text")).alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
        )
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def _op13_sql(rounds: int = 10) -> str:
    """Every round as a step of its own."""
    assigned = """a{r} AS MATERIALIZED (
  SELECT vec_id, cluster, d FROM (
    SELECT vec_id, cluster, sum((x - c) * (x - c)) AS d FROM v JOIN c{r} USING (i) GROUP BY vec_id, cluster
  ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1
)"""
    moved = """c{n} AS MATERIALIZED (
  SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS c
  FROM a{r} JOIN v USING (vec_id) GROUP BY cluster, i
  UNION ALL SELECT cluster, i, c FROM c{r} WHERE cluster NOT IN (SELECT cluster FROM a{r})
)"""
    steps = [
        """kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND (SELECT count(*) FROM unnest(embedding) AS u(x) WHERE isfinite(x)) = 64
)""",
        """v AS MATERIALIZED (
  SELECT vec_id, i, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM kept, range(1, 65) AS r(i)
)""",
        """c0 AS MATERIALIZED (
  SELECT cluster, i, x AS c FROM (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM kept
  ) JOIN v USING (vec_id) WHERE cluster < 8
)""",
    ]
    for r in range(rounds):
        steps += [assigned.format(r=r), moved.format(r=r, n=r + 1)]
    steps.append(assigned.format(r=rounds))
    steps.append(
        f"""named AS (
  SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)"""
    )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM a{rounds} JOIN named USING (cluster)"""
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op7_license_scan": op7_license_scan,
    "op6_toxicity": op6_toxicity,
    "op8_line_dedup": op8_line_dedup,
    "op9_language": op9_language,
    "op10_url_filter": op10_url_filter,
    "op11_periodic": op11_periodic,
    "op12_neighbours": op12_neighbours,
    "op13_centroids": op13_centroids,
}
ORACLES: dict[str, str] = {"op10_url_filter": OP10_SQL.strip(), "op13_centroids": _op13_sql()}
