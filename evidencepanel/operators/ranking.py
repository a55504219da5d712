"""Ranking, capping and de-duplication of search results and candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, Dim, with_names, with_other_entity
from evidencepanel.functions.extraction import POPULATION_TERM
from evidencepanel.functions.grading import REJECTED, score_shortlist, suggest_level
from evidencepanel.functions.text import extract_domain, plain_decimal, raw, strip, to_number
from evidencepanel.operators.groups import need, pick_by, same_key, top_per_group

ORD = "ord"


def score_value(score: str) -> Column:
    """A score as a number: text is read, what is missing or no number counts 0."""
    return F.coalesce(to_number(F.col(score).cast("string")), F.lit(0.0))


def dedup_results(df: DataFrame, query: Sequence[str] = ("query",), order: str = ORD) -> DataFrame:
    """Per (query, url) the row with the longest wording, at the first row's place."""
    need(df, *query, "url", "title", "snippet", order)
    rows = df.withColumn("url", strip("url")).where(F.col("url") != "")
    length = F.length(raw("title")) + F.length(raw("snippet"))
    picked = pick_by(
        rows.withColumnRenamed(order, "_o"),
        [*query, "url"],
        F.struct(length, -F.col("_o")),
        last=True,
        extra=[F.min("_o").alias(order)],
    )
    return picked.drop("_o").select(*df.columns)


def best_per_url(
    df: DataFrame, group: Sequence[str] = ("entity",), score: str = "search_score", order: str = ORD
) -> DataFrame:
    """Per (group, url) the highest score, the first on ties, at the first row's place."""
    need(df, *group, "url", score, order)
    picked = pick_by(
        df.withColumnRenamed(order, "_o"),
        [*group, "url"],
        F.struct(score_value(score), -F.col("_o")),
        last=True,
        extra=[F.min("_o").alias(order)],
    )
    return picked.drop("_o").select(*df.columns)


def cap_per_domain(
    df: DataFrame,
    max_pages: int,
    per_domain_cap: int,
    group: Sequence[str] = ("entity",),
    rank: Sequence[Column] = (),
    url: str = "url",
) -> DataFrame:
    """At most ``cap`` pages per host in rank order, topped up from the rest.

    Rows past ``cap + max_pages`` of a host can never be chosen, so the per-host
    cut is exact and is taken below the shuffle even when one host is hot.
    """
    order = list(rank) or [score_value("search_score").desc(), F.col(ORD).asc()]
    if max_pages <= 0:
        return df.where(F.lit(False)).withColumn("_rank", F.lit(0))
    if per_domain_cap <= 0:
        return top_per_group(df, group, order, max_pages)
    hosts = df.withColumn("_host", extract_domain(url))
    near = top_per_group(hosts, [*group, "_host"], order, per_domain_cap + max_pages, rank="_in_host")
    over = (F.col("_host") != "") & (F.col("_in_host") > per_domain_cap)
    near = near.withColumn("_over", over)
    return top_per_group(near, group, [F.col("_over").asc(), *order], max_pages).drop("_host", "_in_host", "_over")


def dedup_candidates(
    df: DataFrame,
    group: Sequence[str] = (),
    key: Sequence[str] = ("url", "value_10k", "sentence"),
    score: str = "score",
    order: str = ORD,
) -> DataFrame:
    """Best score per (url, value, sentence), the first on ties."""
    need(df, *group, *key, score, order)
    return pick_by(df, [*group, *key], F.struct(score_value(score), -F.col(order)), last=True).select(*df.columns)


def top_candidates(
    df: DataFrame,
    n: int,
    group: Sequence[str] = ("entity",),
    score: str = "score",
    order: str = ORD,
    key: Sequence[str] = ("url", "value_10k", "sentence"),
) -> DataFrame:
    """First ``n`` (at least one) distinct candidates per group, best first."""
    distinct = dedup_candidates(df, group, key, score, order)
    return top_per_group(distinct, group, [score_value(score).desc(), F.col(order).asc()], max(1, n))


def shortlist(
    df: DataFrame,
    value_col: str,
    year: int = 2024,
    min_conf: int = 28,
    term: str = POPULATION_TERM,
    dim: Dim = PROVINCES,
    order: str = ORD,
    sentence_chars: int | None = None,
) -> dict[str, DataFrame]:
    """Best scored candidate per entity, and per-entity accepted/rejected counts.

    ``rows`` are the accepted entities; ``status`` has one row per entity seen
    with ``n_rejected`` and ``accepted``.  Entities without any candidate are
    found by ``shortlist_missing``.  ``sentence_chars`` cuts the evidence shown.
    """
    named = with_names(df.withColumn("_text", strip("sentence")), "entity", dim)
    shown = raw("sentence") if sentence_chars is None else F.substring(raw("sentence"), 1, sentence_chars)
    scored = with_other_entity(named, "_text", "_own", dim).withColumn(
        "_s",
        score_shortlist(
            "entity",
            "sentence",
            "url",
            value_col,
            "score",
            "search_score",
            "explicit_province_in_sentence",
            year,
            term,
            own=F.col("_own"),
            other=F.col("_other"),
        ),
    )
    keep = F.col("_s.score") > REJECTED
    per_entity = scored.groupBy("entity").agg(
        F.max_by(
            F.struct(
                "_s",
                F.col(value_col).alias("value"),
                raw("url").alias("url"),
                raw("search_engine").alias("search_engine"),
                raw("search_query").alias("search_query"),
                shown.alias("sentence"),
            ),
            F.when(keep, F.struct(F.col("_s.score"), -F.col(order))),
        ).alias("b"),
        F.count(F.when(~keep, 1)).alias("n_rejected"),
    )
    accepted = F.coalesce(F.col("b._s.score") >= min_conf, F.lit(False))
    rows = per_entity.where(accepted).select(
        F.col("entity").alias("province"),
        F.lit(str(year)).alias("year"),
        plain_decimal("b.value").alias(value_col),
        suggest_level("b.url").alias("source_level_suggest"),
        F.col("b.url").alias("source_url"),
        F.col("b.search_engine").alias("search_engine"),
        F.col("b.search_query").alias("search_query"),
        F.col("b._s.score").cast("string").alias("confidence"),
        F.col("b.sentence").alias("evidence_sentence"),
        F.col("b._s.flags").alias("rule_flags"),
    )
    return {"rows": rows, "status": per_entity.select("entity", "n_rejected", accepted.alias("accepted"))}


def shortlist_missing(entities: DataFrame, rows: DataFrame, column: str = "full") -> DataFrame:
    """Entities of the dimension that the shortlist has no row for."""
    return entities.join(rows.select(F.col("province").alias(column)), column, "left_anti").select(column)


def distinct_in_order(df: DataFrame, column: str = "url", order: str = ORD, limit: int | None = None) -> DataFrame:
    """Distinct values in order of first occurrence; at least one when limited."""
    firsts = df.groupBy(column).agg(F.min(order).alias(order)).orderBy(order)
    return firsts.limit(max(1, limit)) if limit is not None else firsts


def first_engine_only(
    df: DataFrame, engines: Sequence[str], query: Sequence[str] = ("query",), engine: str = "engine"
) -> DataFrame:
    """Per query only the rows of the first engine, in the given order, that has any.

    The winning engine per query is a partial aggregate met on equality, so a
    query that holds most rows is never gathered in one task.
    """
    order = F.array_position(F.array(*[F.lit(e) for e in engines]), F.col(engine))
    ranked = df.withColumn("_e", order).where(F.col("_e") > 0)
    names = [f"_q{i}" for i in range(len(query))]
    best = ranked.groupBy(*[F.col(q).alias(n) for q, n in zip(query, names)]).agg(F.min("_e").alias("_best"))
    joined = ranked.join(best, same_key((ranked[q], best[n]) for q, n in zip(query, names)))
    return joined.where(F.col("_e") == F.col("_best")).select(*[ranked[c] for c in df.columns])


def concat_urls(first: DataFrame, second: DataFrame, limit: int | None = None, order: str = ORD) -> DataFrame:
    """First list then second, distinct in order."""
    both = first.select(F.lit(0).alias("_list"), order, "url").unionByName(
        second.select(F.lit(1).alias("_list"), order, "url")
    )
    firsts = both.groupBy("url").agg(F.min(F.struct("_list", order)).alias("_at"))
    firsts = firsts.select("url", "_at.*").orderBy("_list", order)
    return firsts.limit(max(1, limit)) if limit is not None else firsts


def candidate_totals(discovery: DataFrame, entities: DataFrame | Sequence[str]) -> DataFrame:
    """Addresses and candidates found over a list of entities; absent counts 0."""
    if isinstance(entities, DataFrame):
        names = entities.select(F.col("entity").alias("_name")).distinct()
        wanted = discovery.join(names, same_key([(discovery["entity"], names["_name"])]), "left_semi")
    else:
        wanted = discovery.where(F.col("entity").isin(list(entities)))
    return wanted.agg(
        F.coalesce(F.sum("url_count"), F.lit(0)).cast("bigint").alias("total_urls"),
        F.coalesce(F.sum("candidate_count"), F.lit(0)).cast("bigint").alias("total_candidates"),
    )
