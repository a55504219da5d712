"""Entity dimension: an ordered list of (short, full, code) names.

The dimension is a parameter.  ``EntityDim`` is the bounded form that is
compiled into column expressions; the ``*_join`` functions take the dimension
as a DataFrame and so have no bound.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencepanel.functions.text import ColumnLike, any_of, raw, strip, year_key

FORMS = ("short", "full", "code")

# The 30 units of the bundled dimension, in order: short, full, code.
PROVINCE_ROWS: tuple[tuple[str, str, str], ...] = (
    ("北京", "北京市", "110000"),
    ("天津", "天津市", "120000"),
    ("河北", "河北省", "130000"),
    ("山西", "山西省", "140000"),
    ("内蒙古", "内蒙古自治区", "150000"),
    ("辽宁", "辽宁省", "210000"),
    ("吉林", "吉林省", "220000"),
    ("黑龙江", "黑龙江省", "230000"),
    ("上海", "上海市", "310000"),
    ("江苏", "江苏省", "320000"),
    ("浙江", "浙江省", "330000"),
    ("安徽", "安徽省", "340000"),
    ("福建", "福建省", "350000"),
    ("江西", "江西省", "360000"),
    ("山东", "山东省", "370000"),
    ("河南", "河南省", "410000"),
    ("湖北", "湖北省", "420000"),
    ("湖南", "湖南省", "430000"),
    ("广东", "广东省", "440000"),
    ("广西", "广西壮族自治区", "450000"),
    ("海南", "海南省", "460000"),
    ("重庆", "重庆市", "500000"),
    ("四川", "四川省", "510000"),
    ("贵州", "贵州省", "520000"),
    ("云南", "云南省", "530000"),
    ("陕西", "陕西省", "610000"),
    ("甘肃", "甘肃省", "620000"),
    ("青海", "青海省", "630000"),
    ("宁夏", "宁夏回族自治区", "640000"),
    ("新疆", "新疆维吾尔自治区", "650000"),
)

# Entities whose scope words differ from the suffix rule.
SCOPE_OVERRIDES: dict[str, tuple[str, ...]] = {
    "内蒙古自治区": ("内蒙古", "全区", "我区"),
    "吉林省": ("吉林", "全省", "我省"),
    "山西省": ("山西", "全省", "我省"),
    "新疆维吾尔自治区": ("新疆", "全区", "我区"),
    "江苏省": ("江苏", "全省", "我省"),
    "江西省": ("江西", "全省", "我省"),
    "湖北省": ("湖北", "全省", "我省"),
    "福建省": ("福建", "全省", "我省"),
    "辽宁省": ("辽宁", "全省", "我省"),
    "陕西省": ("陕西", "全省", "我省"),
    "青海省": ("青海", "全省", "我省"),
    "黑龙江省": ("黑龙江", "全省", "我省"),
}

# Parts of addresses that speak for an entity.
URL_HINTS: dict[str, tuple[str, ...]] = {
    "内蒙古自治区": ("nmg", "neimenggu"),
    "吉林省": ("jilin", "jl.gov.cn"),
    "山西省": ("shanxi", "sx.gov.cn"),
    "新疆维吾尔自治区": ("xinjiang", "xj.gov.cn"),
    "江苏省": ("jiangsu", "js.gov.cn", "zgjssw", "jszx"),
    "江西省": ("jiangxi", "jx.gov.cn"),
    "湖北省": ("hubei", "hb.gov.cn"),
    "福建省": ("fujian", "fj.gov.cn"),
    "辽宁省": ("liaoning", "ln.gov.cn"),
    "陕西省": ("shaanxi", "sn.gov.cn", "sx.gov.cn"),
    "青海省": ("qinghai", "qh.gov.cn"),
    "黑龙江省": ("heilongjiang", "hlj.gov.cn"),
}

# Unit names in English, used by the sector tables.
ENGLISH_NAMES: dict[str, str] = {
    "Beijing": "北京市",
    "Tianjin": "天津市",
    "Hebei": "河北省",
    "Shanxi": "山西省",
    "InnerMongolia": "内蒙古自治区",
    "Liaoning": "辽宁省",
    "Jilin": "吉林省",
    "Heilongjiang": "黑龙江省",
    "Shanghai": "上海市",
    "Jiangsu": "江苏省",
    "Zhejiang": "浙江省",
    "Anhui": "安徽省",
    "Fujian": "福建省",
    "Jiangxi": "江西省",
    "Shandong": "山东省",
    "Henan": "河南省",
    "Hubei": "湖北省",
    "Hunan": "湖南省",
    "Guangdong": "广东省",
    "Guangxi": "广西壮族自治区",
    "Hainan": "海南省",
    "Chongqing": "重庆市",
    "Sichuan": "四川省",
    "Guizhou": "贵州省",
    "Yunnan": "云南省",
    "Shaanxi": "陕西省",
    "Gansu": "甘肃省",
    "Qinghai": "青海省",
    "Ningxia": "宁夏回族自治区",
    "Xinjiang": "新疆维吾尔自治区",
    "Tibet": "西藏自治区",
}

# Name endings, longest first, and scope words in output order.
NAME_SUFFIXES = ("壮族自治区", "回族自治区", "维吾尔自治区", "自治区", "特别行政区", "省", "市")
PROVINCE_SCOPE = ("全省", "我省")
REGION_SCOPE = ("全省", "我省", "全区", "我区")
CITY_SCOPE = ("全市", "我市")


@dataclass(frozen=True)
class EntityDim:
    """Short, ordered dimension that is compiled into expressions.

    A dimension that grows with the data is a DataFrame (ordinal, short, full, code)
    instead: every operator takes either, see ``resolve_entity``.
    """

    entities: tuple[tuple[str, str, str], ...]
    overrides: Mapping[str, Sequence[str]] = field(default_factory=dict)
    url_hints: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.entities:
            raise ValueError("an entity dimension needs at least one entity")

    def __len__(self) -> int:
        return len(self.entities)

    def names(self, form: str) -> list[str]:
        return [e[form_index(form)] for e in self.entities]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, *e) for i, e in enumerate(self.entities)]
        return spark.createDataFrame(rows, "ordinal int, short string, full string, code string")


Dim = EntityDim | DataFrame


def form_index(form: str) -> int:
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, got {form!r}")
    return FORMS.index(form)


PROVINCES = EntityDim(
    PROVINCE_ROWS,
    overrides=SCOPE_OVERRIDES,
    url_hints=URL_HINTS,
)


def _lookup(value: Column, table: Mapping[str, str]) -> Column:
    """Constant lookup, null when absent.  The map is one parsed literal."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(quoted(x) for kv in table.items() for x in kv)
    return F.element_at(F.expr(f"map({pairs})"), value)


def normalize_entity(c: ColumnLike, dim: EntityDim = PROVINCES, target: str = "short") -> Column:
    """Any known form, else the first entity whose short name starts the text.

    Unknown names give null: callers choose to keep the text or drop the row.
    """
    at = form_index(target)
    name = raw(c)
    exact: dict[str, str] = {}
    for entity in dim.entities:  # short names are looked up last, so set them first
        exact.setdefault(entity[0], entity[at])
    exact.update({e[2]: e[at] for e in dim.entities})
    exact.update({e[1]: e[at] for e in dim.entities})
    by_short: dict[str, str] = {}
    for entity in dim.entities:
        by_short.setdefault(entity[0], entity[at])
    # A regex alternation tries its branches in order: the first entity wins.
    starts = r"\A(?:" + "|".join(re.escape(s) for s in dim.names("short")) + ")"
    prefix = F.regexp_extract(name, starts, 0)
    tier = prefix if target == "short" else _lookup(prefix, by_short)
    return F.coalesce(_lookup(name, exact), F.when(prefix != "", tier))


def entity_or_raw(c: ColumnLike, dim: EntityDim = PROVINCES, target: str = "short") -> Column:
    return F.coalesce(normalize_entity(c, dim, target), raw(c))


def short_to_full(c: ColumnLike, dim: EntityDim = PROVINCES) -> Column:
    """Strict: short or full name only, no prefix tier; unknown gives null."""
    table = {e[1]: e[1] for e in dim.entities} | {e[0]: e[1] for e in dim.entities}
    return _lookup(raw(c), table)


def full_to_short(c: ColumnLike, dim: EntityDim = PROVINCES) -> Column:
    table = {e[0]: e[0] for e in dim.entities} | {e[1]: e[0] for e in dim.entities}
    return _lookup(raw(c), table)


def strict_names(df: DataFrame, column: str, dim: Dim = PROVINCES, full: str = "full_form", short: str = "short_form") -> DataFrame:
    """Adds both forms of a name that is a short or full name, else null; ``dim`` of any size."""
    if isinstance(dim, EntityDim):
        return df.withColumns({full: short_to_full(column, dim), short: full_to_short(column, dim)})
    from evidencepanel.operators.groups import same_key

    forms = dim.select("short", "full", F.explode(F.array(F.struct(F.lit(1).alias("p"), F.col("short").alias("n")), F.struct(F.lit(0).alias("p"), F.col("full").alias("n")))).alias("f"))
    table = forms.groupBy(F.col("f.n").alias("_n")).agg(F.min_by(F.struct("short", "full"), F.struct("f.p", "full")).alias("_e"))
    out = df.join(table, same_key([(raw(df[column]), table["_n"])]), "left")
    return out.withColumns({full: F.col("_e.full"), short: F.col("_e.short")}).drop("_n", "_e")


def entity_universe(spark: SparkSession, dim: EntityDim = PROVINCES, form: str = "short") -> DataFrame:
    form_index(form)
    return dim.frame(spark).select("ordinal", F.col(form).alias("entity")).orderBy("ordinal")


def norm_key(
    name: str,
    dim: EntityDim = PROVINCES,
    entity_col: str = "province",
    year_col: str = "year",
    known: Column | None = None,
) -> Column:
    """Key cell in comparable form: short entity, year without leading zeros.

    ``known`` is the entity where ``resolve_entity`` has found it already.
    """
    text = strip(name)
    if name == entity_col:
        entity = F.coalesce(known, text) if known is not None else entity_or_raw(text, dim)
        return F.when(text != "", entity).otherwise(text)
    if name == year_col:
        return year_key(name)
    return text


def alias_to_entity(df: DataFrame, column: str, names: Mapping[str, str] | DataFrame, out: str = "province") -> DataFrame:
    """Foreign-language name to entity; rows with an unknown name are dropped."""
    if isinstance(names, DataFrame):
        table = names.select(F.col("alias").alias(column), F.col("entity").alias(out))
        return df.join(table, column, "inner")
    return df.withColumn(out, _lookup(F.col(column), names)).where(F.col(out).isNotNull())


def _suffix_free(name: Column) -> Column:
    out = name
    for suffix in reversed(NAME_SUFFIXES):
        cut = F.substring(name, F.lit(1), F.length(name) - len(suffix))
        out = F.when(name.endswith(suffix), cut).otherwise(out)
    return out


def _words(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _explicit(text: Column, short: Column, overrides: Mapping[str, Sequence[str]]) -> Column:
    out = F.coalesce(short, _suffix_free(text))
    return F.coalesce(_lookup(text, {k: v[0] for k, v in overrides.items()}), out) if overrides else out


def _scope(text: Column, full: Column, overrides: Mapping[str, Sequence[str]]) -> Column:
    full = F.coalesce(full, text)
    out = (
        F.when(full.contains("自治区") & full.endswith("市"), _words((*REGION_SCOPE, *CITY_SCOPE)))
        .when(full.contains("自治区"), _words(REGION_SCOPE))
        .when(full.endswith("市"), _words(CITY_SCOPE))
        .otherwise(_words(PROVINCE_SCOPE))
    )
    for name, words in overrides.items():
        out = F.when(text == name, _words(words[1:])).otherwise(out)
    return out


def explicit_name(entity: ColumnLike, dim: EntityDim = PROVINCES) -> Column:
    """The name that counts as naming the entity outright."""
    return _explicit(raw(entity), normalize_entity(raw(entity), dim), dim.overrides)


def scope_words(entity: ColumnLike, dim: EntityDim = PROVINCES) -> Column:
    """Words by which a text speaks of the entity as a whole."""
    return _scope(raw(entity), normalize_entity(raw(entity), dim, "full"), dim.overrides)


def with_names(df: DataFrame, entity: str, dim: Dim = PROVINCES, own: str = "_own", scope: str = "_scope") -> DataFrame:
    """Adds the explicit name and the scope words of the row's entity."""
    if isinstance(dim, EntityDim):
        return df.withColumns({own: explicit_name(entity, dim), scope: scope_words(entity, dim)})
    from evidencepanel.plans.session import written_once

    # Names are met by a join of the table with its own distinct names: written once, what it
    # comes from is planned and run once.
    given = written_once(df.withColumn("_stripped", strip(entity)), "named")
    out = _met_names(given, "_stripped", dim, {"_short": "short", "_full": "full"}).drop("_stripped")
    named = out.withColumns({own: _explicit(raw(entity), F.col("_short"), {}), scope: _scope(raw(entity), F.col("_full"), {})})
    return named.drop("_short", "_full")


def entity_aliases(df: DataFrame, entity: str = "full", dim: Dim = PROVINCES) -> DataFrame:
    """Adds ``aliases``: the explicit name followed by the scope words."""
    named = with_names(df, entity, dim)
    return named.withColumn("aliases", F.concat(F.array("_own"), "_scope")).drop("_own", "_scope")


def names_other_entity(sentence: Column, own_short: Column, dim: EntityDim = PROVINCES) -> Column:
    return any_of((own_short != F.lit(s)) & sentence.contains(F.lit(s)) for s in dim.names("short"))


def hinted_url(entity: ColumnLike, url: ColumnLike, dim: EntityDim = PROVINCES) -> Column:
    """True / false when the entity has address hints, null when it has none."""
    lower, text = F.lower(raw(url)), raw(entity)
    out = F.lit(None).cast("boolean")
    for name, hints in dim.url_hints.items():
        out = F.when(text == name, any_of(lower.contains(F.lit(h)) for h in hints)).otherwise(out)
    return out


def with_other_entity(df: DataFrame, sentence: str, own: str, dim: Dim = PROVINCES, out: str = "_other") -> DataFrame:
    """Adds whether the text holds the short name of an entity other than ``own``.

    For a DataFrame of any size, distinct texts meet an inverted index of the names.  The
    first and the last name that a text holds tell whether one of them is another's.
    """
    if isinstance(dim, EntityDim):
        return df.withColumn(out, names_other_entity(F.col(sentence), F.col(own), dim))
    from evidencepanel.operators.groups import same_key
    from evidencepanel.operators.mentions import mentions
    from evidencepanel.plans.session import written_once

    marked = df.withColumn("_mark", F.unhex(F.sha2(F.col(sentence), 256)))
    # Searched twice: written once.
    texts = written_once(marked.where(F.col(sentence).isNotNull()).groupBy("_mark").agg(F.any_value(sentence).alias("_t")), "texts")
    held = mentions(texts, "_mark", "_t", dim).groupBy("_mark").agg(F.min("short").alias("_first"), F.max("short").alias("_last"))
    held = held.withColumnRenamed("_mark", "_held")
    own_name = F.col(own)
    other = F.col("_first").isNotNull() & ~(F.col("_first").eqNullSafe(own_name) & F.col("_last").eqNullSafe(own_name))
    joined = marked.join(held, same_key([(marked["_mark"], held["_held"])]), "left")
    return joined.withColumn(out, other).drop("_mark", "_held", "_first", "_last")


def _short_lengths(dim: DataFrame) -> Column:
    """The few lengths that short names have, as an array."""
    sizes = sorted(r[0] for r in dim.where(F.length("short") > 0).select(F.length("short")).distinct().collect())
    return F.array(*map(F.lit, sizes)).cast("array<int>")


def resolve_entity(df: DataFrame, column: str, dim: Dim = PROVINCES, target: str = "short", out: str = "_entity") -> DataFrame:
    """Adds the entity that the stripped name means, null if unknown; ``dim`` of any size."""
    if isinstance(dim, EntityDim):
        return df.withColumn(out, normalize_entity(strip(column), dim, target))
    named = df.withColumn("_stripped", strip(column))
    return normalize_entity_join(named, "_stripped", dim, out, target).drop("_stripped")


def entity_count(dim: Dim) -> Column:
    """Number of entities, as a literal or a scalar subquery."""
    if isinstance(dim, EntityDim):
        return F.lit(len(dim)).cast("bigint")
    return dim.agg(F.count(F.lit(1))).scalar()


def normalize_entity_join(df: DataFrame, column: str, dim: DataFrame, out: str = "entity", target: str = "short") -> DataFrame:
    """``normalize_entity`` for a dimension of any size, by equality joins only.

    Each distinct name is cut to the lengths that short names have and met with the
    dimension on equality; the lowest (tier, ordinal) wins.  Distinct names are
    few next to rows, so the fan-out never touches the fact table.
    """
    return _met_names(df, column, dim, {out: target})


def _met_names(df: DataFrame, column: str, dim: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Adds each target form of the entity that the name means, under its new column name."""
    from evidencepanel.operators.groups import never_broadcast, same_key

    for target in targets.values():
        form_index(target)
    names = df.select(F.col(column).alias("_name")).where(F.col(column).isNotNull()).distinct()
    lengths = F.filter(_short_lengths(dim), lambda n: n <= F.length("_name"))
    starts = names.select("_name", F.explode(lengths).alias("_n"))
    probes = names.select("_name", F.lit(0).alias("tier"), F.col("_name").alias("probe")).unionByName(
        starts.select("_name", F.lit(1).alias("tier"), F.substring("_name", F.lit(1), F.col("_n")).alias("probe"))
    )
    exact = dim.select(
        "ordinal",
        F.struct(*[F.col(t).alias(o) for o, t in targets.items()]).alias("target"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("tier"), F.lit(0).alias("form"), F.col("full").alias("probe")),
                F.struct(F.lit(0).alias("tier"), F.lit(1).alias("form"), F.col("code").alias("probe")),
                F.struct(F.lit(0).alias("tier"), F.lit(2).alias("form"), F.col("short").alias("probe")),
                F.struct(F.lit(1).alias("tier"), F.lit(2).alias("form"), F.col("short").alias("probe")),
            )
        ).alias("d"),
    ).select("ordinal", "target", "d.tier", "d.form", "d.probe")
    found = (
        probes.join(never_broadcast(exact), ["tier", "probe"])
        .groupBy("_name")
        .agg(F.min_by("target", F.struct("tier", "form", "ordinal")).alias("_target"))
        .select("_name", "_target.*")
    )
    return df.join(found, same_key([(df[column], found["_name"])]), "left").drop("_name")


# Address parts of the population rules.
POPULATION_URL_HINTS: dict[str, tuple[str, ...]] = {
    "北京市": ("beijing", "bj"),
    "天津市": ("tianjin", "tj"),
    "河北省": ("hebei", "hb"),
    "山西省": ("shanxi", "sx"),
    "内蒙古自治区": ("nmg", "neimenggu"),
    "辽宁省": ("liaoning", "ln"),
    "吉林省": ("jilin", "jl"),
    "黑龙江省": ("heilongjiang", "hlj"),
    "上海市": ("shanghai", "sh"),
    "江苏省": ("jiangsu", "js"),
    "浙江省": ("zhejiang", "zj"),
    "安徽省": ("anhui", "ah"),
    "福建省": ("fujian", "fj"),
    "江西省": ("jiangxi", "jx"),
    "山东省": ("shandong", "sd"),
    "河南省": ("henan", "ha"),
    "湖北省": ("hubei", "hb"),
    "湖南省": ("hunan", "hn"),
    "广东省": ("guangdong", "gd"),
    "广西壮族自治区": ("gx", "guangxi"),
    "海南省": ("hainan", "hi"),
    "重庆市": ("cq", "chongqing"),
    "四川省": ("sichuan", "sc"),
    "贵州省": ("guizhou", "gz"),
    "云南省": ("yunnan", "yn"),
    "陕西省": ("shaanxi", "sn"),
    "甘肃省": ("gansu", "gs"),
    "青海省": ("qinghai", "qh"),
    "宁夏回族自治区": ("ningxia", "nx"),
    "新疆维吾尔自治区": ("xinjiang", "xj"),
}
POPULATION_DIM = EntityDim(PROVINCES.entities, overrides=SCOPE_OVERRIDES, url_hints=POPULATION_URL_HINTS)
