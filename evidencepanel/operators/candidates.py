"""Candidate numbers out of page text, per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.functions.entity import (
    POPULATION_DIM,
    PROVINCES,
    Dim,
    EntityDim,
    hinted_url,
    with_names,
    with_other_entity,
)
from evidencepanel.functions.extraction import (
    POPULATION_TERM,
    VEHICLE_STOCK,
    RuleSet,
    extract_value,
    population_value,
    score_population_sentence,
    score_sentence,
    sentence_passes,
    unit_factor,
)
from evidencepanel.functions.text import raw, split_sentences
from evidencepanel.operators.groups import need

# Scope words of the population rules, by name ending.
POPULATION_SCOPE = {"自治区": ("全区", "本区", "我区"), "市": ("全市", "本市", "我市"), "省": ("全省", "本省", "我省")}


def _sentences(pages: DataFrame, term: str) -> DataFrame:
    """Sentences of the texts that can hold the term at all.

    The text test runs before the split, so most texts are never split.  A term
    with a space in it may only appear once white space is collapsed, so it is
    not tested early.
    """
    need(pages, "entity", "url", "text")
    if term and not any(ch.isspace() for ch in term):
        pages = pages.where(raw("text").contains(F.lit(term)))
    cols = [c for c in pages.columns if c != "text"]
    # The outer form infers no filter on the split, which would run it twice.
    rows = pages.select(*cols, F.posexplode_outer(split_sentences("text")).alias("sentence_no", "_sentence"))
    return rows.where(F.col("_sentence").isNotNull())


def _shown(chars: int | None) -> Column:
    s = F.col("_sentence")
    return s if chars is None else F.substring(s, 1, chars)


def _url_hint(dim: Dim) -> Column:
    """Address hints belong to a literal dimension; a DataFrame has none."""
    return hinted_url("entity", "url", dim) if isinstance(dim, EntityDim) else F.lit(None).cast("boolean")


def extract_candidates(
    pages: DataFrame,
    year: int,
    schema: RuleSet = VEHICLE_STOCK,
    dim: Dim = PROVINCES,
    sentence_chars: int | None = None,
) -> DataFrame:
    """Sentences that state the sought number for the page's entity.

    ``pages`` holds entity, url, text and any carried columns.  One row per
    qualifying sentence with value, unit, base-unit value and score.  Everything is
    judged on the whole sentence; ``sentence_chars`` cuts what is shown.
    """
    s = F.col("_sentence")
    rows = _sentences(pages, schema.required_term).where(sentence_passes(s, schema))
    rows = with_names(rows, "entity", dim)
    entity, own = raw("entity"), F.col("_own")
    rows = rows.withColumn("_named", s.contains(own) | s.contains(entity))
    scoped = F.exists("_scope", lambda w: s.contains(w))
    hint = _url_hint(dim)
    rows = rows.where(F.col("_named") | (scoped & F.coalesce(hint, F.lit(True))))
    rows = rows.withColumn("_v", extract_value(s, schema)).where(F.col("_v").isNotNull())
    rows = with_other_entity(rows, "_sentence", "_own", dim)
    kept = [c for c in pages.columns if c != "text"]
    return rows.select(
        *kept,
        "sentence_no",
        _shown(sentence_chars).alias("sentence"),
        F.col("_v.value_raw").alias("value_raw"),
        F.col("_v.unit").alias("unit"),
        F.bround(F.col("_v.value_raw") * unit_factor(F.col("_v.unit"), schema), 6).alias("value_10k"),
        score_sentence(entity, own, s, year, F.col("_other"), hint, schema).alias("score"),
        F.col("_named").alias("explicit_province_in_sentence"),
    )


def extract_population_candidates(
    pages: DataFrame, year: int, dim: Dim = POPULATION_DIM, sentence_chars: int | None = None
) -> DataFrame:
    """The same for resident population, with its own patterns and points."""
    s = F.col("_sentence")
    rows = _sentences(pages, POPULATION_TERM).where(s.contains(POPULATION_TERM))
    rows = with_names(rows, "entity", dim)
    entity, own = raw("entity"), F.col("_own")
    named = s.contains(own) | s.contains(entity)
    scoped = F.lit(False)
    for ending, words in reversed(POPULATION_SCOPE.items()):
        hit = F.lit(False)
        for w in words:
            hit = hit | s.contains(F.lit(w))
        scoped = F.when(entity.endswith(ending), hit).otherwise(scoped)
    rows = rows.withColumn("_named", named).where(F.col("_named") | ~s.contains("全国"))
    hint = _url_hint(dim)
    rows = rows.where(F.col("_named") | (scoped & F.coalesce(hint, F.lit(True))))
    rows = rows.withColumn("_v", population_value(s)).where(F.col("_v").isNotNull())
    rows = with_other_entity(rows, "_sentence", "_own", dim)
    kept = [c for c in pages.columns if c != "text"]
    return rows.select(
        *kept,
        "sentence_no",
        _shown(sentence_chars).alias("sentence"),
        F.bround("_v", 6).alias("value_10k_person"),
        F.lit("万人").alias("unit"),
        score_population_sentence(entity, own, s, year, F.col("_other")).alias("score"),
        F.col("_named").alias("explicit_province_in_sentence"),
    )
