"""The dealt operators as queries over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import (
    clustering,
    decontamination,
    fill_middle,
    line_dedup,
    mixing,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    substring_dedup,
    top_k,
    toxicity,
)
from snaplake.llm.learning import fold

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["name"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(pii.named(base), 256).alias("base_sha256"),
        pii.named(F.col("spans")).alias("spans"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_common_lines(_documents(spark, sf_dir), min_docs=10, min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _judged(scored: DataFrame, folds: int, held: int, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5, held=0)
    return _judged(quality.score_documents(docs, model), 5, 0, 0.3)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_documents(spark, sf_dir), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    lean = sharding.with_sizes(docs).drop("text")
    placed = sharding.cut_shards(lean, ["doc_id", "text_crc32", "size"], shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=3, held=1)
    return _judged(quality.score_documents(docs, model), 3, 1, 0.7)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, most_bits=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir), weights=(1, 2, 3), cap=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(_documents(spark, sf_dir), benchmark, window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    placed, centroids = clustering.cluster(vectors, k=8, rounds=10, dims=64, scale=1024, seed=3)
    return clustering.described(placed, centroids)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["name"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in secrets.KINDS),
        F.sha2(secrets.named(base), 256).alias("base_sha256"),
        secrets.named(F.col("spans")).alias("spans"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transformed(_documents(spark, sf_dir).select("doc_id", "text"), seed=1)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def _clustering_sql(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    """A common table for each assignment and each move of the centroids."""
    steps = [
        f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, v))::INTEGER - 1 AS c, v
  FROM kept QUALIFY c < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT row, vec_id, x.v, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x.v, y.v)])::BIGINT AS d
        FROM kept x, c{i} y) GROUP BY row)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.v, old.v) AS v FROM c{i} old LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY dim) AS v FROM (
      SELECT c, dim, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
      FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range(1, {dims + 1})) AS dim FROM a{i}) GROUP BY c, dim)
    GROUP BY c) new ON old.c = new.c)"""
            )
    body = ",\n".join(steps)
    return f"""
{body}
SELECT a.vec_id, a.best.c AS cluster, a.best.d AS distance,
       (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.best.c = c.c
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_top_k,
        op2_pii,
        op3_line_dedup,
        op4_quality,
        op5_substring_dedup,
        op6_sharding,
        op7_toxicity,
        op8_simhash,
        op9_mixing,
        op10_decontamination,
        op11_clustering,
        op12_secrets,
        op13_fill_middle,
    )
}

ORACLES: dict[str, str] = {
    "op1_top_k": r"""
WITH usable AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM usable q, usable c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op3_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
              FROM documents),
lines AS (SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10),
flagged AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY row
""",
    "op5_substring_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
wins AS (
  SELECT row, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS first FROM wins GROUP BY win),
gone AS (
  SELECT DISTINCT row, p FROM (
    SELECT row, unnest(range(i, i + 13)) AS p FROM wins JOIN firsts USING (win) WHERE first < coalesce(doc_id, 9223372036854775807))),
words AS (SELECT row, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (
  SELECT row, count(g.p) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (g.p IS NULL) AS text
  FROM words LEFT JOIN gone g USING (row, p) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
""",
    "op9_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS pos
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM totals),
weighed AS (SELECT *, 1 + (rank - 1) % 3 AS weight, 3 * source_size AS most FROM ranked),
leveled AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, rank
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY most / weight, rank
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS level
  FROM weighed),
free AS (SELECT arg_min(level, most / weight * 1e6 + rank) AS level FROM leveled WHERE level <= most / weight),
targets AS (
  SELECT source, source_size, least(weight * (SELECT level FROM free), most)::DOUBLE AS target FROM leveled),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets),
placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.pos ROWS UNBOUNDED PRECEDING) AS upto, s.size AS own
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN budget > 0 AND 2 * (upto - own) + own <= 2 * budget THEN 1 ELSE 0 END))::BIGINT
         AS taken
FROM placed
""",
    "op10_decontamination": r"""
WITH folded AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT *, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM wins),
docwins AS (
  SELECT row, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM folded, lengths WHERE len(w) >= n)),
hits AS (SELECT d.row, d.i, d.n, s.item_id FROM docwins d JOIN wins s ON s.n = d.n AND s.win = d.win),
covered AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM hits) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM folded LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
""",
    "op11_clustering": _clustering_sql(k=8, rounds=10, dims=64, scale=1024, seed=3),
    "op13_fill_middle": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         [('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
         greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
         array_to_string(u[b + 1:n], '') AS suffix
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
