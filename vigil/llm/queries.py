"""The queries of the dealt operators, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import bpe, jaccard, langid, licenses, mainhtml, mixing, nearvec, periodic, pieces, repair, sharding, simhash, tokenids

CATALOGUE = {}
SQL = {}


def query(fn):
    CATALOGUE[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The vocabulary file that the queries use; it lies at the same place on every node."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op2_nearvec(spark, sf_dir):
    return nearvec.dedup(table(spark, sf_dir, "embeddings"))


@query
def op3_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), shingle=4, percent=85)


@query
def op4_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op5_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark, sf_dir):
    return simhash.digest(table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_tokenids(spark, sf_dir):
    return tokenids.digest(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_mainhtml(spark, sf_dir):
    return mainhtml.main_text(table(spark, sf_dir, "pages"))


@query
def op10_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


# The words of a text are counted by what splitting at white space leaves.
SQL["op10_mixing"] = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
sized AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM base GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][nth % 3 + 1]::DOUBLE AS weight, 2::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS wanted,
         count(*) OVER () AS n FROM sized),
-- one round for each source at most: what is above its cap is shared again
rounds AS (
  SELECT nth, weight, most, wanted, 0 AS round, least(most, wanted * weight / sum(weight) OVER ()) AS target,
         wanted * weight / sum(weight) OVER () >= most AS full_up FROM weighted
  UNION ALL
  SELECT nth, weight, most, wanted, round + 1,
         CASE WHEN full_up THEN most ELSE least(most, level * weight) END, full_up OR level * weight >= most
  FROM (SELECT *, (wanted - coalesce(sum(most) FILTER (WHERE full_up) OVER (), 0)) / nullif(sum(weight) FILTER (WHERE NOT full_up) OVER (), 0) AS level
        FROM rounds WHERE round < 64)),
aimed AS (SELECT w.*, r.target FROM weighted w JOIN rounds r USING (nth) WHERE r.round = 64),
seats AS (
  SELECT nth, count(*) AS won FROM (
    SELECT nth, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, nth, k) AS rank, wanted
    FROM (SELECT nth, target, wanted, unnest(range(0, (target / 16)::BIGINT + 3)) AS k FROM aimed WHERE target > 0))
  WHERE rank <= round(wanted / 16) GROUP BY nth),
plan AS (
  SELECT a.*, ceil(source_size / 16)::BIGINT AS blocks, least(coalesce(won, 0), 2 * ceil(source_size / 16)::BIGINT) AS quota
  FROM aimed a LEFT JOIN seats USING (nth)),
dealt AS (
  SELECT *, coalesce(sum(quota % 16) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT % 16 AS first_shard,
         CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS rounds, CASE WHEN blocks > 0 THEN quota % blocks ELSE 0 END AS odd,
         CASE WHEN blocks > 0 THEN ('0x' || substr(md5('mix' || coalesce(source, '')), 1, 8))::BIGINT % blocks ELSE 0 END AS first
  FROM plan),
placed AS (
  SELECT b.doc_id, b.size, d.*,
         (sum(b.size) OVER (PARTITION BY b.source ORDER BY b.place, b.doc_id, b.size ROWS UNBOUNDED PRECEDING) - b.size)::BIGINT AS pos
  FROM base b JOIN dealt d ON b.source IS NOT DISTINCT FROM d.source),
counted AS (
  SELECT *, rounds * size
    + greatest(0, least(pos + size, least((first + odd) * 16, source_size)) - greatest(pos, first * 16))
    + greatest(0, least(pos + size, greatest(0, first + odd - blocks) * 16) - greatest(pos, 0)) AS taken
  FROM placed)
SELECT doc_id, size, source_size, target, taken, CASE WHEN size = 0 THEN 0 ELSE (2 * taken + size) // (2 * size) END AS copies,
       CASE WHEN taken > 0 THEN (first_shard + ((pos // 16 - first) % blocks + blocks) % blocks) % 16 END AS shard
FROM counted
"""


def piece_model_path() -> str:
    """The SentencePiece model that op11 uses; it lies at the same place on every node."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_pieces(spark, sf_dir):
    return pieces.digest(table(spark, sf_dir, "documents"), piece_model_path())


@query
def op12_repair(spark, sf_dir):
    return repair.repair(table(spark, sf_dir, "conversations"))


@query
def op13_periodic(spark, sf_dir):
    return periodic.detect(table(spark, sf_dir, "documents"))
