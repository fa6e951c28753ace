"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestore.llm import byte_bpe, chosen_path, curriculum, exact_dedup, html_crf, kernel_langid, periodic_runs, quality_cnn, tile_dedup, token_align, token_orc, url_rules, warc
from lodestore.llm.common import fold_of, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc"
    warc.write(_table(spark, sf_dir, "pages"), path)
    r = warc.index(spark, path)
    return r.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens"
    token_orc.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_orc.digests(spark, path)


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), fold_of("doc_id", 5) == 0
    net = quality_cnn.learn(docs, _table(spark, sf_dir, "labels"), ~held_out)
    rows = quality_cnn.score(docs.select("doc_id", "text"), net)
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality_cnn.CUT).cast("int").alias("predicted"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = byte_bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.digests(bpe, _table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_kernel_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), fold_of("doc_id", 3) == 1
    model = kernel_langid.learn(docs, ~held_out)
    return kernel_langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_copies(_table(spark, sf_dir, "documents")).drop("text_key")


def op8_tile_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tile_dedup.near_copies(_table(spark, sf_dir, "embeddings"))


def op9_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_crf.extract(_table(spark, sf_dir, "pages"), html_crf.train())
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.plan(_table(spark, sf_dir, "documents")).withColumns({"target": F.round("target", 6), "position": F.round("position", 6)})


def planted(id_: object, n: int) -> np.ndarray | None:
    """Which of a text's n words stand where: texts of a tenth of the ids get a period from some word on. A null id counts as the empty text."""
    g, rest = divmod(zlib.crc32(b"" if id_ is None else str(id_).encode()), 10)
    if rest or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.annotate(_table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=planted)
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are the verdicts of the given rules: the mined ones carry them over to other hosts."""
    return url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "mined_rule")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_token_orc": op3_token_orc,
    "op4_quality_cnn": op4_quality_cnn,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_kernel_langid": op6_kernel_langid,
    "op7_chosen_path": op7_chosen_path,
    "op8_tile_dedup": op8_tile_dedup,
    "op9_html_crf": op9_html_crf,
    "op10_curriculum_mix": op10_curriculum_mix,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_align": op12_token_align,
    "op13_url_rules": op13_url_rules,
}

ORACLE_SQL = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS cp,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY h ORDER BY cp DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY h ORDER BY cp DESC, doc_id) AS kept,
               h AS text_sha256
        FROM d""",
    "op2_warc": r"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
        r AS (
            SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS response FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
               CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN response = page_id THEN NULL ELSE response END AS refers_to
        FROM r""",
    "op10_curriculum_mix": r"""
        WITH d AS (
            SELECT doc_id, source, text, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS place,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
            FROM d GROUP BY source),
        c AS (
            SELECT *, 3.0 * source_size AS cap, 3.0 * source_size / weight AS ratio,
                   sum(source_size) OVER () AS total FROM s),
        l AS (
            SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM c),
        t AS (
            SELECT source, source_size, weight,
                   CASE weight WHEN 1 THEN 1.5 WHEN 2 THEN 1.0 ELSE 4.0 END AS a, CASE weight WHEN 1 THEN 0.5 WHEN 2 THEN 3.0 ELSE 2.0 END AS b,
                   CAST(least(cap, weight * (SELECT max(level) FROM l WHERE level <= ratio)) AS DOUBLE) AS target
            FROM l),
        p AS (
            SELECT d.*, t.source_size, t.target, weight, a, b,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, round(target, 6) AS target,
               CASE WHEN size > 0 AND middle < target THEN
                   round(2 * weight * middle / target / (a + sqrt(a * a + 2 * (b - a) * weight * middle / target)), 6) END AS position,
               CAST(size * (CAST(middle < target AS INT) + CAST(source_size + middle < target AS INT) + CAST(2 * source_size + middle < target AS INT)) AS BIGINT) AS taken
        FROM p""",
}
