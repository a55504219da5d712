"""The registered queries of the text operators, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencepanel.llm.anchor_simhash import simhash_duplicates
from evidencepanel.llm.centroids import cluster_digests
from evidencepanel.llm.exact_dedup import exact_duplicates
from evidencepanel.llm.near_dedup import near_duplicates
from evidencepanel.llm.packing import packed_pieces
from evidencepanel.llm.periodic_runs import run_digests
from evidencepanel.llm.pieces import piece_digests
from evidencepanel.llm.pii import personal_data
from evidencepanel.llm.pseudo_likelihood import pseudo_likelihood
from evidencepanel.llm.quality import quality_scores
from evidencepanel.llm.token_output import packed_matrices
from evidencepanel.llm.topk import top_k
from evidencepanel.llm.warc import archived_pages

Build = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood(_table(spark, folder, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), percent=85)


def op3_quality_machine(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"), threshold=0.3)


def op4_concatenate_and_cut(spark: SparkSession, folder: str) -> DataFrame:
    return packed_pieces(_table(spark, folder, "documents"), window=2048)


def op5_packed_matrices(spark: SparkSession, folder: str) -> DataFrame:
    return packed_matrices(_table(spark, folder, "documents"), window=2048)


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(_table(spark, folder, "documents"))


def op8_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(_table(spark, folder, "documents"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(_table(spark, folder, "documents"))


def op10_web_archive(spark: SparkSession, folder: str) -> DataFrame:
    # Pages carry no capture time; their number, as seconds, gives each a time of its own.
    found = archived_pages(_table(spark, folder, "pages"), captured=F.timestamp_seconds("page_id"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_anchor_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_duplicates(_table(spark, folder, "documents"), bits=3)


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_digests(_table(spark, folder, "embeddings"), k=8, rounds=10, size=64)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(_table(spark, folder, "documents"), plant=True)


def _clusters_sql(k: int, rounds: int, size: int) -> str:
    """The rounds of the clustering, one after another, over rows (vector, dimension, value)."""
    parts = [
        f"""WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  x AS MATERIALIZED (SELECT n, d, floor(1024 * embedding[d]::DOUBLE)::BIGINT AS x FROM kept, range(1, {size + 1}) r(d)),
  firsts AS (SELECT n, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept QUALIFY c < {k}),
  c0 AS MATERIALIZED (SELECT c, d, x AS m FROM firsts JOIN x USING (n))"""
    ]
    for i in range(rounds + 1):
        parts.append(f"d{i} AS MATERIALIZED (SELECT n, c, sum((x - m) * (x - m)) AS s FROM x JOIN c{i} USING (d) GROUP BY n, c)")
        parts.append(f"a{i} AS MATERIALIZED (SELECT n, min({{'s': s, 'c': c}}).c AS c FROM d{i} GROUP BY n)")
        if i < rounds:
            means = f"SELECT c, d, sum(x) AS t, count(*) AS k FROM a{i} JOIN x USING (n) GROUP BY c, d"
            floor = "CASE WHEN k IS NULL THEN m ELSE ((t - ((t % k) + k) % k) / k)::BIGINT END"
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, {floor} AS m FROM c{i} o LEFT JOIN ({means}) f ON o.c = f.c AND o.d = f.d)")
    last = rounds
    parts.append(f"l AS (SELECT n, a.c, s FROM a{last} a JOIN d{last} e USING (n, c))")
    parts.append("t AS (SELECT c, sum(s) AS t FROM l GROUP BY c)")
    parts.append(f"h AS (SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY d)) AS h FROM c{last} GROUP BY c)")
    return ",\n  ".join(parts) + """
SELECT vec_id, c::INT AS cluster, s::BIGINT AS distance, t::BIGINT AS cluster_inertia, (SELECT sum(s) FROM l)::BIGINT AS inertia, h AS centroid_sha256
FROM l JOIN kept USING (n) JOIN t USING (c) JOIN h USING (c)"""


QUERIES: dict[str, Build] = {
    f.__name__: f
    for f in (
        op1_pseudo_likelihood,
        op2_minhash_near_dedup,
        op3_quality_machine,
        op4_concatenate_and_cut,
        op5_packed_matrices,
        op6_exact_top_k,
        op7_sentence_pieces,
        op8_contextual_pii,
        op9_exact_dedup,
        op10_web_archive,
        op11_anchor_simhash,
        op12_centroid_clusters,
        op13_periodic_runs,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op12_centroid_clusters": _clusters_sql(8, 10, 64),
    "op6_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op10_web_archive": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
  f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest""",
    "op9_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
  g AS (SELECT low, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY low)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.low) AS text_sha256 FROM t JOIN g ON t.low = g.low""",
}
