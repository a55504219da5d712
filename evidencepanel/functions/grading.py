"""Grades and scores of sources: address, search result, shortlist candidate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidencepanel.functions.entity import PROVINCES, EntityDim, explicit_name, names_other_entity
from evidencepanel.functions.extraction import (
    BULLETIN_WORDS,
    POPULATION_TERM,
    SCOPE_WORDS,
    VEHICLE_STOCK,
    RuleSet,
)
from evidencepanel.functions.text import (
    ColumnLike,
    contains_any,
    extract_domain,
    raw,
    strip,
    to_number,
    total,
    url_path,
    weight_when,
)

# Host parts that raise or lower trust, engine bonuses, level scores.
TRUSTED_HOST_PARTS = ("stats", "tjj", "mps", "ga", "gov")
TRUSTED_HOST_PARTS_POPULATION = ("stats", "tjj", "gov")
SOCIAL_HOST_PARTS = ("weixin.qq.com", "toutiao", "sohu", "163.com", "baijiahao")
ENGINE_BONUS: dict[str, int] = {"google": 2, "tavily": 2, "bing": 1, "sogou": 1, "360": 1}
LEVEL_SCORES: dict[str, float] = {"A": 100.0, "B": 70.0, "C": 40.0}
DEFAULT_SOURCE_LABEL = "省级政府站点（2024人口发布）"
SOURCE_LABEL = "（2024人口发布）"

REJECTED = -10_000


def norm_level(c: ColumnLike) -> Column:
    first = F.upper(F.substring(strip(c), 1, 1))
    return F.when(first.isin("A", "B", "C"), first).otherwise(F.lit("B"))


def host_score(url: ColumnLike) -> Column:
    host = extract_domain(url)
    return total(
        [
            weight_when(host.endswith(".gov.cn"), 4),
            weight_when(host.contains("tjj."), 6),
            weight_when(host.contains("stats."), 4),
        ]
    )


def suggest_level(url: ColumnLike) -> Column:
    host, path = extract_domain(url), F.lower(url_path(url))
    return (
        F.when(contains_any(host, ("tjj.", "stats.")) | path.contains("tjgb"), F.lit("A-候选"))
        .when(host.endswith(".gov.cn"), F.lit("B-候选"))
        .otherwise(F.lit("C-候选"))
    )


def source_name_from_url(url: ColumnLike, label: str = SOURCE_LABEL, default: str = DEFAULT_SOURCE_LABEL) -> Column:
    host = extract_domain(url)
    return F.when(host == "", F.lit(default)).otherwise(F.concat(host, F.lit(label)))


def domain_quality(url: ColumnLike, trusted: Sequence[str] = TRUSTED_HOST_PARTS) -> Column:
    # A blank host holds none of the parts.  With no test around the sum, the host
    # is always needed, so code generation computes it once.
    host = extract_domain(url)
    return total(
        [
            weight_when(host.contains(".gov.cn"), 6),
            weight_when(contains_any(host, trusted), 2),
            weight_when(contains_any(host, SOCIAL_HOST_PARTS), -3),
        ]
    )


def engine_bonus(engine: ColumnLike, bonus: Mapping[str, int] = ENGINE_BONUS) -> Column:
    # Of a comma list, the first engine counts.
    name = strip(F.substring_index(raw(engine), ",", 1))
    return total(weight_when(name == e, b) for e, b in bonus.items())


def score_search_result(
    entity: ColumnLike,
    year: int,
    title: ColumnLike,
    snippet: ColumnLike,
    schema: RuleSet = VEHICLE_STOCK,
    dim: EntityDim = PROVINCES,
    own: Column | None = None,
) -> Column:
    """Points of the wording; ``own`` is the entity's name where ``with_names`` gave it."""
    own = explicit_name(entity, dim) if own is None else own
    text = F.concat(raw(title), F.lit(" "), raw(snippet))
    terms = [*schema.search_positive_terms.items(), *schema.search_negative_terms.items()]
    marked = [(term.replace("{year}", str(year)), points) for term, points in terms]
    return total(
        [
            weight_when(
                text.contains(own) | text.contains(raw(entity)),
                schema.weight("search_province"),
            ),
            *[weight_when(text.contains(F.lit(word)), points) for word, points in marked if word],
            weight_when(text.contains(F.lit(str(year))), schema.weight("search_year")),
        ]
    )


def score_population_result(
    entity: ColumnLike, year: int, title: ColumnLike, snippet: ColumnLike, dim: EntityDim = PROVINCES, own: Column | None = None
) -> Column:
    own = explicit_name(entity, dim) if own is None else own
    text = F.concat(raw(title), F.lit(" "), raw(snippet))
    # The points of the population rules.
    return total(
        [
            weight_when(text.contains(own) | text.contains(raw(entity)), 4),
            weight_when(text.contains(POPULATION_TERM), 5),
            weight_when(text.contains(F.lit(str(year))), 4),
            weight_when(text.contains("统计公报"), 3),
            weight_when(contains_any(text, ("统计局", "政府", "国民经济和社会发展")), 2),
            weight_when(text.contains("全国"), -4),
        ]
    )


def rank_score(
    entity: ColumnLike,
    year: int,
    title: ColumnLike,
    snippet: ColumnLike,
    url: ColumnLike,
    engine: ColumnLike,
    schema: RuleSet = VEHICLE_STOCK,
    dim: EntityDim = PROVINCES,
    own: Column | None = None,
) -> Column:
    """Search score: wording, address and engine together."""
    words = score_search_result(entity, year, title, snippet, schema, dim, own)
    return words + domain_quality(url) + engine_bonus(engine)


def score_shortlist(
    entity: ColumnLike,
    sentence: ColumnLike,
    url: ColumnLike,
    value: ColumnLike,
    score: ColumnLike,
    search_score: ColumnLike,
    explicit: ColumnLike,
    year: int = 2024,
    term: str = POPULATION_TERM,
    dim: EntityDim = PROVINCES,
    own: Column | None = None,
    other: Column | None = None,
) -> Column:
    """``struct(score, flags)``; a hard reject scores -10000 with its reason.

    ``own`` and ``other`` stand in for the dimension where ``with_names`` and
    ``with_other_entity`` gave them.
    """
    text, link, name = strip(sentence), strip(url), raw(entity)
    short = explicit_name(entity, dim) if own is None else own
    other = names_other_entity(text, short, dim) if other is None else other
    absent = (F.col(value) if isinstance(value, str) else value).isNull()
    number = to_number(value)
    flagged = F.coalesce(F.col(explicit) if isinstance(explicit, str) else explicit, F.lit(False))
    named = flagged | text.contains(short) | text.contains(name)
    scoped = contains_any(text, SCOPE_WORDS)
    host = host_score(link)
    bulletin = contains_any(text, BULLETIN_WORDS)

    def points(c: ColumnLike) -> Column:
        return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("int"), F.lit(0))

    # The points for scope, name and bulletin.
    base = (
        points(score)
        + points(search_score)
        + weight_when(scoped, 4)
        + weight_when(named, 4)
        + host
        + weight_when(bulletin, 3)
    )
    flags = F.concat_ws(
        ";",
        F.lit(f"year={year}"),
        F.when(scoped, F.lit("scope")),
        F.when(named, F.lit("explicit_province")),
        F.concat(F.lit("host+"), host.cast("string")),
        F.when(bulletin, F.lit("bulletin_like")),
    )

    def reject(why: str) -> Column:
        return F.struct(F.lit(REJECTED).alias("score"), F.lit(why).alias("flags"))

    return (
        F.when(absent, reject("value_missing"))
        .when(number.isNull(), reject("value_non_numeric"))
        .when(~text.contains(F.lit(f"{year}年")), reject(f"year_{year}_not_explicit"))
        .when(~(named | scoped), reject("province_scope_not_clear"))
        .when(other, reject("contains_other_province"))
        .when(~text.contains(F.lit(term)), reject("keyword_missing"))
        .otherwise(F.struct(base.alias("score"), flags.alias("flags")))
    )
