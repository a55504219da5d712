"""Queries over texts, search results, candidates, pages, sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.bindings.catalog import SPACES, any_in, has, host, names_other, number, points, query, s
from evidencepanel.bindings.views import FIRST_YEAR, LAST_YEAR, SOURCE_YEAR, Views
from evidencepanel.functions import extraction as ex
from evidencepanel.functions import grading, text
from evidencepanel.functions.entity import POPULATION_DIM, POPULATION_URL_HINTS, URL_HINTS, Dim
from evidencepanel.operators import candidates as cand
from evidencepanel.operators import pages as pg
from evidencepanel.operators import ranking as rk
from evidencepanel.operators import routes
from evidencepanel.operators.mentions import mentions
from evidencepanel.plans.session import scratch_path
from evidencepanel.sources import readers, writers
from evidencepanel.streaming import patches

# ------------------------------------------------------------ scalar functions
MARK = "chr(1)"


def sentences(x: str, enders: str) -> str:
    """A list of the parts of a text, cut after each ender."""
    flat = f"regexp_replace({x}, '{SPACES}+', ' ', 'g')"
    parts = f"string_split(regexp_replace({flat}, '([{enders}])', '\\1' || {MARK}, 'g'), {MARK})"
    return f"[trim(p) FOR p IN {parts} IF trim(p) <> '']"


@query(
    "t1_split_sentences",
    f"""SELECT doc_id, cast(len(parts) AS int) AS n_sentences, cast(list_sum([length(p) FOR p IN parts]) AS bigint) AS n_chars,
          parts[1] AS first_sentence, parts[-1] AS last_sentence FROM (SELECT doc_id, {sentences('text', '.!?;')} AS parts FROM documents) WHERE len(parts) > 0""",
)
def _(v: Views) -> DataFrame:
    # The outer explode of one value keeps the filter above from running the split again.
    parts = F.explode_outer(F.array(text.split_sentences("text", ".!?;")))
    rows = v.table("documents").select("doc_id", parts.alias("p"))
    return rows.where(F.size("p") > 0).select(
        "doc_id",
        F.size("p").alias("n_sentences"),
        F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("n_chars"),
        F.element_at("p", 1).alias("first_sentence"),
        F.element_at("p", -1).alias("last_sentence"),
    )


H = host("url")


@query("t2_extract_domain", f"SELECT ord AS id, {H} AS host FROM results UNION ALL SELECT page_id + 1000000000000, {H} FROM pages")
def _(v: Views) -> DataFrame:
    both = v.results.select(F.col("ord").alias("id"), "url").unionByName(
        v.table("pages").select((F.col("page_id") + 1000000000000).alias("id"), "url")
    )
    return both.select("id", text.extract_domain("url").alias("host"))


def quality(x: str, words) -> str:
    social = any_in(x, grading.SOCIAL_HOST_PARTS)
    return points((f"contains({x}, '.gov.cn')", 6), (any_in(x, words), 2), (social, -3))


@query(
    "t3_domain_quality",
    f"SELECT ord, {quality(H, grading.TRUSTED_HOST_PARTS)} AS quality, {quality(H, grading.TRUSTED_HOST_PARTS_POPULATION)} AS quality_population FROM results",
)
def _(v: Views) -> DataFrame:
    return v.results.select(
        "ord",
        grading.domain_quality("url").alias("quality"),
        grading.domain_quality("url", grading.TRUSTED_HOST_PARTS_POPULATION).alias("quality_population"),
    )


PRIMARY = ex.VEHICLE_STOCK.primary_pattern.replace("{units}", "(?:万辆|辆)")
FALLBACK = ex.VEHICLE_STOCK.fallback_pattern.replace("{units}", "(?:万辆|辆)")


def value_of(x: str, group: int, tokens=ex.VEHICLE_STOCK.value_tokens, primary: str = PRIMARY, fallback: str = FALLBACK) -> str:
    out = "CASE "
    for t in tokens:
        tail = f"substr({x}, instr({x}, '{t}'), 90)"
        out += f"WHEN instr({x}, '{t}') > 0 AND regexp_matches({tail}, '{primary}') THEN regexp_extract({tail}, '{primary}', {group}) "
    return out + f"WHEN regexp_matches({x}, '{fallback}') THEN regexp_extract({x}, '{fallback}', {group}) END"


@query("t4_extract_value", f"SELECT ord, cast({value_of('text', 1)} AS double) AS value_raw, {value_of('text', 2)} AS unit FROM bulletins")
def _(v: Views) -> DataFrame:
    return v.bulletins.withColumn("_v", ex.extract_value("text")).select("ord", "_v.value_raw", "_v.unit")


OTHER_RULES = {
    "required_term": "常住人口",
    "any_terms": [],
    "value_tokens": ["常住人口总量", "常住人口"],
    "primary_pattern": r"(?:达|为)?\s*([0-9]+)\s*({units})",
    "fallback_pattern": r"人口[^0-9]{0,9}([0-9]+)[.0-9]*({units})",
    "unit_to_10k": {"万人": 1, "人": 0.0001},
    "score_weights": {"year_end": 3},
}


@query(
    "t14_extractor_schema",
    "SELECT ord, cast({0} AS double) AS value_raw, {1} AS unit FROM bulletins WHERE contains(text, '常住人口')".format(
        *[
            value_of(
                "text",
                g,
                ("常住人口总量", "常住人口"),
                r"(?:达|为)?\s*([0-9]+)\s*((?:万人|人))",
                r"人口[^0-9]{0,9}([0-9]+)[.0-9]*((?:万人|人))",
            )
            for g in (1, 2)
        ]
    ),
)
def _(v: Views) -> DataFrame:
    schema = ex.rules_from_json(OTHER_RULES)
    rows = v.bulletins.where(F.col("text").contains(schema.required_term))
    return rows.withColumn("_v", ex.extract_value("text", schema)).select("ord", "_v.value_raw", "_v.unit")


def hinted(entity: str, url: str, hints) -> str:
    """Hint test; null when the entity has no hints."""
    cases = " ".join(f"WHEN {entity} = '{e}' THEN {any_in(f'lower({url})', words)}" for e, words in hints.items())
    return f"(CASE {cases} END)"


def sentence_score(x: str, entity: str, own: str, url: str) -> str:
    v = ex.VEHICLE_STOCK
    named = f"(contains({x}, {own}) OR contains({x}, {entity}))"
    return points(
        (any_in(x, v.year_ends(SOURCE_YEAR)), 8),
        (any_in(x, v.partial_year_markers), 5),
        (any_in(x, v.province_scope_markers), 4),
        (named, 4),
        (any_in(x, v.city_scope_markers), -5),
        (any_in(x, v.national_scope_markers), -9),
        (names_other(x, own), -8),
        (f"NOT {named} AND coalesce({hinted(entity, url, URL_HINTS)}, false)", 2),
    )


@query(
    "t5_score_sentence",
    f"SELECT ord, {sentence_score('text', 'entity', 'short_name', 'url')} AS score FROM bulletins JOIN dim ON full_name = entity",
)
def _(v: Views) -> DataFrame:
    from evidencepanel.functions.entity import hinted_url, with_names, with_other_entity

    rows = with_other_entity(with_names(v.bulletins, "entity"), "text", "_own")
    hint = hinted_url("entity", "url")
    score = ex.score_sentence(F.col("entity"), F.col("_own"), F.col("text"), SOURCE_YEAR, F.col("_other"), hint)
    return rows.select("ord", score.alias("score"))


def scope_hit(x: str) -> str:
    province, region, city = (any_in(x, w) for w in (("全省", "我省"), ("全省", "我省", "全区", "我区"), ("全市", "我市")))
    return f"""CASE WHEN full_name IN ('内蒙古自治区', '新疆维吾尔自治区') THEN {any_in(x, ('全区', '我区'))}
        WHEN contains(full_name, '自治区') THEN {region} WHEN full_name LIKE '%市' THEN {city} ELSE {province} END"""


PARTS = f"""parts AS (SELECT ord, entity, url, short_name, full_name, unnest({sentences('text', '。！？；')}) AS x,
    generate_subscripts({sentences('text', '。！？；')}, 1) - 1 AS sentence_no FROM bulletins JOIN dim ON full_name = entity)"""
NAMED = "(contains(x, short_name) OR contains(x, entity))"
FOUND = (
    PARTS
    + f""", found AS (SELECT *, cast({value_of('x', 1)} AS double) AS value_raw, {value_of('x', 2)} AS unit FROM parts
    WHERE contains(x, '保有量') AND {any_in('x', ('新能源', '电动汽车'))} AND NOT contains(x, '全国新能源汽车保有量')
      AND ({NAMED} OR ({scope_hit('x')} AND coalesce({hinted('entity', 'url', URL_HINTS)}, true)))),
  cands AS (SELECT ord, cast(sentence_no AS int) AS sentence_no, entity, url, x AS sentence, value_raw, unit,
    round_even(value_raw * CASE unit WHEN '辆' THEN 0.0001::DOUBLE ELSE 1 END, 6) AS value_10k,
    {sentence_score('x', 'entity', 'short_name', 'url')} AS score, {NAMED} AS explicit FROM found WHERE value_raw IS NOT NULL)"""
)


@query("t6_extract_candidates", "SELECT ord, sentence_no, sentence, value_raw, unit, value_10k, score, explicit FROM cands", FOUND)
def _(v: Views) -> DataFrame:
    out = cand.extract_candidates(v.bulletins, SOURCE_YEAR)
    names = ["ord", "sentence_no", "sentence", "value_raw", "unit", "value_10k", "score"]
    return out.select(*names, F.col("explicit_province_in_sentence").alias("explicit"))


P1, P2 = (p.removeprefix("(?U)") for p in ex.POPULATION_PATTERNS)
POP_SCOPE = f"""CASE WHEN full_name LIKE '%自治区' THEN {any_in('x', ('全区', '本区', '我区'))}
    WHEN full_name LIKE '%市' THEN {any_in('x', ('全市', '本市', '我市'))} ELSE {any_in('x', ('全省', '本省', '我省'))} END"""
POP_SCORE = points(
    (any_in("x", (f"{SOURCE_YEAR}年",)), 8),
    (any_in("x", ex.BULLETIN_WORDS), 4),
    (any_in("x", ex.SCOPE_WORDS), 4),
    (NAMED, 4),
    ("contains(x, '全国')", -10),
    (names_other("x", "short_name"), -8),
)
POP = (
    PARTS
    + f""", pop AS (SELECT ord, cast(sentence_no AS int) AS sentence_no, entity, url, short_name, full_name, x, x AS sentence,
    cast(CASE WHEN regexp_matches(x, '{P1}') THEN regexp_extract(x, '{P1}', 1) WHEN regexp_matches(x, '{P2}') THEN regexp_extract(x, '{P2}', 1) END AS double) AS value_10k_person,
    {POP_SCORE} AS score, {NAMED} AS explicit FROM parts WHERE contains(x, '常住人口') AND ({NAMED} OR NOT contains(x, '全国'))
      AND ({NAMED} OR ({POP_SCOPE} AND coalesce({hinted('entity', 'url', POPULATION_URL_HINTS)}, true)))),
  popc AS (SELECT * FROM pop WHERE value_10k_person IS NOT NULL)"""
)


def many_places(v: Views) -> DataFrame:
    """The provinces and one place per customer, as a table."""
    known = v.sql("SELECT ordinal, short_name AS short, full_name AS full, code FROM dim")
    place = F.concat(F.lit("地"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    return known.unionByName(
        v.table("customer").select(
            (F.col("c_custkey") + 1000).cast("int").alias("ordinal"), place.alias("short"), F.concat(place, F.lit("县")).alias("full"), place.alias("code")
        )
    )


# No address hints and no overrides with a table: the plain rules hold for every name.
LARGE_SCOPE = f"""CASE WHEN contains(full_name, '自治区') THEN {any_in('x', ('全省', '我省', '全区', '我区'))}
    WHEN full_name LIKE '%市' THEN {any_in('x', ('全市', '我市'))} ELSE {any_in('x', ('全省', '我省'))} END"""
LARGE_FOUND = (
    PARTS
    + f""", found AS (SELECT *, cast({value_of('x', 1)} AS double) AS value_raw, {value_of('x', 2)} AS unit FROM parts
    WHERE contains(x, '保有量') AND {any_in('x', ('新能源', '电动汽车'))} AND NOT contains(x, '全国新能源汽车保有量')
      AND ({NAMED} OR {LARGE_SCOPE})),
  candl AS (SELECT ord, cast(sentence_no AS int) AS sentence_no, x AS sentence, value_raw, unit,
    round_even(value_raw * CASE unit WHEN '辆' THEN 0.0001::DOUBLE ELSE 1 END, 6) AS value_10k,
    {points((any_in('x', ex.VEHICLE_STOCK.year_ends(SOURCE_YEAR)), 8), (any_in('x', ex.VEHICLE_STOCK.partial_year_markers), 5),
            (any_in('x', ex.VEHICLE_STOCK.province_scope_markers), 4), (NAMED, 4), (any_in('x', ex.VEHICLE_STOCK.city_scope_markers), -5),
            (any_in('x', ex.VEHICLE_STOCK.national_scope_markers), -9), (names_other('x', 'short_name'), -8))} AS score,
    {NAMED} AS explicit FROM found WHERE value_raw IS NOT NULL)"""
)


@query("t6_extract_candidates_large", "SELECT ord, sentence_no, sentence, value_raw, unit, value_10k, score, explicit FROM candl", LARGE_FOUND)
def _(v: Views) -> DataFrame:
    out = cand.extract_candidates(v.bulletins, SOURCE_YEAR, dim=many_places(v))
    names = ["ord", "sentence_no", "sentence", "value_raw", "unit", "value_10k", "score"]
    return out.select(*names, F.col("explicit_province_in_sentence").alias("explicit"))


PLACES = "places AS (SELECT short_name AS short FROM dim UNION ALL SELECT '地' || lpad(cast(c_custkey AS string), 9, '0') FROM customer)"
LINES = "lines AS (SELECT 'o' || cast(o_orderkey AS string) AS line, o_orderpriority || ' 经 地' || lpad(cast(o_custkey AS string), 9, '0') || ' 至 地' || lpad(cast(o_custkey * 7 AS string), 9, '0') AS said FROM orders)"


@query(
    "t5_names_in_texts",
    """SELECT DISTINCT line, '地' || n AS short FROM (SELECT line, unnest(regexp_extract_all(said, '地([0-9]{9})', 1)) AS n FROM lines)
       WHERE '地' || n IN (SELECT short FROM places)""",
    f"{PLACES}, {LINES}",
)
def _(v: Views) -> DataFrame:
    number = lambda c: F.concat(F.lit("地"), F.lpad(F.col(c).cast("string"), 9, "0"))
    orders = v.table("orders").withColumn("seventh", F.col("o_custkey") * 7)
    said = F.concat("o_orderpriority", F.lit(" 经 "), number("o_custkey"), F.lit(" 至 "), number("seventh"))
    lines = orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("line"), said.alias("said"))
    return mentions(lines, "line", "said", many_places(v))


@query("t6_extract_population", "SELECT ord, sentence_no, sentence, value_10k_person, score, explicit FROM popc", POP)
def _(v: Views) -> DataFrame:
    out = cand.extract_population_candidates(v.bulletins, SOURCE_YEAR)
    names = ["ord", "sentence_no", "sentence", "value_10k_person", "score"]
    return out.select(*names, F.col("explicit_province_in_sentence").alias("explicit"))


W = "(title || ' ' || snippet)"
SEARCH_WORDS = points(
    (f"contains({W}, short_name) OR contains({W}, entity)", 4),
    *[(f"contains({W}, '{t}')", p) for t, p in ex.VEHICLE_STOCK.search_positive_terms.items()],
    *[(f"contains({W}, '{t}')", p) for t, p in ex.VEHICLE_STOCK.search_negative_terms.items()],
    (f"contains({W}, '{SOURCE_YEAR}')", 3),
)
ENGINE_POINTS = points(*[(f"engine = '{e}'", p) for e, p in grading.ENGINE_BONUS.items()])
RANKED = (
    f"ranked AS (SELECT r.*, {SEARCH_WORDS} AS word_score, {SEARCH_WORDS} + CASE WHEN {H} = '' THEN 0 ELSE {quality(H, grading.TRUSTED_HOST_PARTS)} END "
    f"+ {ENGINE_POINTS} AS search_score, {H} AS h FROM results r JOIN dim ON full_name = entity)"
)


@query("t7_score_search_result", "SELECT ord, word_score, search_score FROM ranked", RANKED)
def _(v: Views) -> DataFrame:
    return v.results.select(
        "ord",
        grading.score_search_result("entity", SOURCE_YEAR, "title", "snippet").alias("word_score"),
        grading.rank_score("entity", SOURCE_YEAR, "title", "snippet", "url", "engine").alias("search_score"),
    )


@query(
    "t7_engine_lists",
    f"""SELECT ord, {points(*[(f"trim(split_part(engines, ',', 1)) = '{e}'", p) for e, p in grading.ENGINE_BONUS.items()])} AS score
        FROM (SELECT ord, CASE ord % 3 WHEN 0 THEN engine || ', bing' WHEN 1 THEN 'x,' || engine ELSE engine END AS engines FROM results)""",
)
def _(v: Views) -> DataFrame:
    third = F.col("ord") % 3
    listed = F.when(third == 0, F.concat("engine", F.lit(", bing"))).when(third == 1, F.concat(F.lit("x,"), "engine"))
    rows = v.results.withColumn("engines", listed.otherwise(F.col("engine")))
    return rows.select("ord", grading.engine_bonus("engines").alias("score"))


POP_WORDS = points(
    (f"contains({W}, short_name) OR contains({W}, entity)", 4),
    (f"contains({W}, '常住人口')", 5),
    (f"contains({W}, '{SOURCE_YEAR}')", 4),
    (f"contains({W}, '统计公报')", 3),
    (any_in(W, ("统计局", "政府", "国民经济和社会发展")), 2),
    (f"contains({W}, '全国')", -4),
)


@query("t7_score_population_result", f"SELECT ord, {POP_WORDS} AS score FROM results JOIN dim ON full_name = entity")
def _(v: Views) -> DataFrame:
    score = grading.score_population_result("entity", SOURCE_YEAR, "title", "snippet")
    return v.results.select("ord", score.alias("score"))


HOST_POINTS = points((f"{H} LIKE '%.gov.cn'", 4), (f"contains({H}, 'tjj.')", 6), (f"contains({H}, 'stats.')", 4))
SCOPED = any_in("sentence", ex.SCOPE_WORDS)
NAMED_S = "(explicit OR contains(sentence, short_name) OR contains(sentence, entity))"
BULLETIN = any_in("sentence", ex.BULLETIN_WORDS)
SHORT = (
    POP
    + f""", scored AS (SELECT *, CASE WHEN sentence_no % 5 = 4 THEN 'value_missing'
      WHEN NOT contains(sentence, '{SOURCE_YEAR}年') THEN 'year_{SOURCE_YEAR}_not_explicit'
      WHEN NOT ({NAMED_S} OR {SCOPED}) THEN 'province_scope_not_clear' WHEN {names_other('sentence', 'short_name')} THEN 'contains_other_province'
      WHEN NOT contains(sentence, '常住人口') THEN 'keyword_missing' END AS why,
    score + ord % 9 + {points((SCOPED, 4), (NAMED_S, 4), (BULLETIN, 3))} + {HOST_POINTS} AS conf,
    'year={SOURCE_YEAR}' || CASE WHEN {SCOPED} THEN ';scope' ELSE '' END || CASE WHEN {NAMED_S} THEN ';explicit_province' ELSE '' END
      || ';host+' || cast({HOST_POINTS} AS string) || CASE WHEN {BULLETIN} THEN ';bulletin_like' ELSE '' END AS flags FROM popc)"""
)


def _population(v: Views, dim: Dim = POPULATION_DIM) -> DataFrame:
    rows = cand.extract_population_candidates(v.bulletins, SOURCE_YEAR, dim)
    return rows.withColumns(
        {
            "value_10k_person": F.when(F.col("sentence_no") % 5 != 4, F.col("value_10k_person")),
            "search_score": (F.col("ord") % 9).cast("int"),
            "search_engine": F.lit("bing"),
            "search_query": F.concat(F.lit("q"), F.col("ord").cast("string")),
        }
    )


@query(
    "t8_score_shortlist",
    "SELECT ord, sentence_no, CASE WHEN why IS NOT NULL THEN -10000 ELSE conf END AS score, coalesce(why, flags) AS flags FROM scored",
    SHORT,
)
def _(v: Views) -> DataFrame:
    scored = _population(v).withColumn(
        "_s",
        grading.score_shortlist(
            "entity",
            "sentence",
            "url",
            "value_10k_person",
            "score",
            "search_score",
            "explicit_province_in_sentence",
            SOURCE_YEAR,
        ),
    )
    return scored.select("ord", "sentence_no", F.col("_s.score").cast("bigint").alias("score"), F.col("_s.flags").alias("flags"))


@query(
    "w7_shortlist",
    f"""SELECT entity AS province, rtrim(rtrim(printf('%.6f', value_10k_person), '0'), '.') AS value_10k_person, url AS source_url,
          cast(conf AS string) AS confidence, substr(sentence, 1, 500) AS evidence_sentence, flags AS rule_flags
        FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY conf DESC, ord, sentence_no) AS rn FROM scored WHERE why IS NULL)
        WHERE rn = 1 AND conf >= 28""",
    SHORT,
)
def _(v: Views) -> DataFrame:
    rows = _population(v).withColumn("place", F.col("ord") * 1000 + F.col("sentence_no"))
    out = rk.shortlist(rows, "value_10k_person", SOURCE_YEAR, order="place", sentence_chars=500)["rows"]
    return out.select("province", "value_10k_person", "source_url", "confidence", "evidence_sentence", "rule_flags")


# With a table there are no overrides and no address hints; its names are found by the index.
POP_LARGE = POP.replace(f" AND coalesce({hinted('entity', 'url', POPULATION_URL_HINTS)}, true)", "")
SHORT_LARGE = SHORT.replace(POP, POP_LARGE)


@query(
    "w7_shortlist_large",
    f"""SELECT entity AS province, rtrim(rtrim(printf('%.6f', value_10k_person), '0'), '.') AS value_10k_person, url AS source_url,
          cast(conf AS string) AS confidence, sentence AS evidence_sentence, flags AS rule_flags
        FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY conf DESC, ord, sentence_no) AS rn FROM scored WHERE why IS NULL)
        WHERE rn = 1 AND conf >= 28""",
    SHORT_LARGE,
)
def _(v: Views) -> DataFrame:
    places = many_places(v)
    rows = _population(v, places).withColumn("place", F.col("ord") * 1000 + F.col("sentence_no"))
    out = rk.shortlist(rows, "value_10k_person", SOURCE_YEAR, dim=places, order="place")["rows"]
    return out.select("province", "value_10k_person", "source_url", "confidence", "evidence_sentence", "rule_flags")


@query(
    "w7_shortlist_missing",
    """SELECT full_name AS "full" FROM dim WHERE full_name NOT IN (SELECT entity FROM scored WHERE why IS NULL GROUP BY 1 HAVING max(conf) >= 28)""",
    SHORT,
)
def _(v: Views) -> DataFrame:
    rows = rk.shortlist(_population(v), "value_10k_person", SOURCE_YEAR)["rows"]
    return rk.shortlist_missing(v.sql("SELECT full_name AS full FROM dim"), rows)


@query(
    "w7_shortlist_status",
    """SELECT entity, count(*) FILTER (why IS NOT NULL) AS n_rejected, coalesce(max(conf) FILTER (why IS NULL) >= 28, false) AS accepted
       FROM scored GROUP BY 1""",
    SHORT,
)
def _(v: Views) -> DataFrame:
    return rk.shortlist(_population(v), "value_10k_person", SOURCE_YEAR)["status"]


T9 = "(?i)the ([a-z]+)"
AT = "instr(text, m)"


@query(
    "t9_extract_with_window",
    f"""SELECT doc_id, regexp_extract(text, p, 1) AS value, substr(text, greatest({AT} - 120, 1), {AT} + 220 - greatest({AT} - 120, 1)) AS evidence
        FROM (SELECT *, regexp_extract(text, p, 0) AS m FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN '{T9}' ELSE 'of ([^ ]+) ' END AS p FROM documents))
        WHERE m <> ''""",
)
def _(v: Views) -> DataFrame:
    rows = v.table("documents").withColumn("p", F.when(F.col("doc_id") % 2 == 0, F.lit(T9)).otherwise(F.lit("of ([^ ]+) ")))
    rows = rows.select("doc_id", F.explode_outer(F.array(ex.extract_with_window("text", "p"))).alias("_w"))
    return rows.where(F.col("_w").isNotNull()).select("doc_id", "_w.value", "_w.evidence")


NEAR = "[^。]*新能源汽车保有量(?:达到|达|为)? ?([0-9.]+) ?万?辆，?"
K = "instr(m, '新能源汽车保有量')"


@query(
    "t9_extract_near_token",
    f"""SELECT ord, cast(regexp_extract(text, '{NEAR}', 1) AS double) AS value,
          trim(substr(m, greatest({K} - 28, 1), {K} + 40 - greatest({K} - 28, 1)), ' ，,。;；') AS evidence
        FROM (SELECT *, trim(regexp_extract(text, '{NEAR}', 0)) AS m FROM bulletins) WHERE m <> ''""",
)
def _(v: Views) -> DataFrame:
    rows = v.bulletins.withColumn("_w", ex.extract_near_token("text", F.lit(NEAR), "新能源汽车保有量"))
    return rows.where(F.col("_w").isNotNull()).select("ord", "_w.value", "_w.evidence")


RULES = {
    "fields": [
        {"name": "amount", "patterns": [r"([0-9]+\.[0-9]+)", "([0-9]{2,})"], "cast": "float", "unit": "u"},
        {"name": "code", "patterns": ["[0-9]{3,}"], "cast": "int"},
        {"name": "word", "patterns": [r"(?:[.,;]) ([A-Za-z]+)\s+([a-z]+)"], "cast": "float"},
        {"name": "", "patterns": ["x"]},
        {"name": "empty", "patterns": []},
    ]
}


def _field(name: str, cast: str, tries: list[tuple[str, int]]) -> str:
    got = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}', {g})" for p, g in tries) + " END"
    whole = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}', 0)" for p, g in tries) + " END"
    num = number(f"({got})")
    num = {"float": num, "int": f"cast(try_cast(trunc({num}) AS bigint) AS double)"}[cast]
    raw = f"({got})"
    return (
        f"SELECT doc_id, '{name}' AS field, CASE WHEN ({num}) IS NULL THEN {raw} END AS value_str, {num} AS value_num, {raw} AS raw, "
        f"substr(trim(regexp_replace({whole}, '{SPACES}+', ' ', 'g')), 1, 220) AS evidence FROM documents WHERE {raw} IS NOT NULL"
    )


@query(
    "t10_extract_fields",
    " UNION ALL ".join(
        [
            _field("amount", "float", [(r"([0-9]+\.[0-9]+)", 1), ("([0-9]{2,})", 1)]),
            _field("code", "int", [("[0-9]{3,}", 0)]),
            _field("word", "float", [(r"(?:[.,;]) ([A-Za-z]+)[\s\x1c-\x1f\x{85}\x{a0}]+([a-z]+)", 1)]),
        ]
    ),
)
def _(v: Views) -> DataFrame:
    rules = ex.parse_field_rules(RULES)
    wide = v.table("documents").select("doc_id", ex.extract_fields("text", rules, ex.EVIDENCE_CHARS).alias("f"))
    named = F.array(*[F.struct(F.lit(r.name).alias("field"), F.col(f"f.{r.name}").alias("g")) for r in rules])
    rows = wide.select("doc_id", F.explode(named).alias("n")).where(F.col("n.g").isNotNull())
    return rows.select("doc_id", "n.field", "n.g.value_str", "n.g.value_num", "n.g.raw", "n.g.evidence")


PAGE_TEXT = "regexp_replace(html, '(?s)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>|<!--.*?-->', '', 'g')"
UNESCAPED = "{0}"
for _name, _to in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&nbsp;", "chr(160)"), ("&quot;", "chr(34)"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'")):
    UNESCAPED = f"replace({UNESCAPED}, '{_name}', {_to})"


def bare(html: str) -> str:
    """Text of a piece of HTML: tags are gaps, entities resolved, white space collapsed."""
    stripped = UNESCAPED.format(f"regexp_replace({html}, '<[^>]*>', ' ', 'g')")
    return f"trim(regexp_replace({stripped}, '{SPACES}+', ' ', 'g'))"


TITLE = f"""trim({UNESCAPED.format("regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)")}, {' || '.join(f'chr({c})' for c in (32, 9, 10, 13, 160))})"""
HEADERS = f"list_filter(list_transform(regexp_extract_all({PAGE_TEXT}, '(?is)<h[123][^>]*>(.*?)</h[123]>', 1), lambda h: {bare('h')}), lambda h: h <> '')"
LINKS = f"list_transform(regexp_extract_all({PAGE_TEXT}, '(?i)<a\\s[^>]*href=\"([^\"]+)\"', 1), lambda u: trim({UNESCAPED.format('u')}))"


@query(
    "t11_page_archive",
    rf"""SELECT page_id, url, 'ok' AS status, {TITLE} AS title, {bare(PAGE_TEXT)} AS plain_text, array_to_string({HEADERS}, '|') AS headers,
          cast(len(regexp_extract_all({PAGE_TEXT}, '(?i)<(p|li)[ >]')) AS int) AS n_paragraphs, array_to_string({LINKS}, '|') AS links,
          cast(len(string_split({bare(PAGE_TEXT)}, ' ')) AS int) AS word_count FROM pages""",
)
def _(v: Views) -> DataFrame:
    out = pg.page_archive(v.table("pages"))
    return out.select(
        "page_id",
        "url",
        "status",
        "title",
        "plain_text",
        F.concat_ws("|", "headers").alias("headers"),
        F.size("paragraphs").alias("n_paragraphs"),
        F.concat_ws("|", "links").alias("links"),
        "word_count",
    )


@query(
    "t11_archive_document",
    rf"""SELECT url, {TITLE} AS title, array_to_string({HEADERS}, '|') AS headers, array_to_string({LINKS}, '|') AS links FROM pages""",
)
def _(v: Views) -> DataFrame:
    out = pg.archive_document(pg.page_archive(v.table("pages")))
    return out.select("url", "title", F.concat_ws("|", "headers").alias("headers"), F.concat_ws("|", "links").alias("links"))


PAGE_RULES = {"fields": [{"name": "amount", "patterns": [r"([0-9]+\.[0-9]+)", "([0-9]{2,})"], "cast": "float"}, {"name": "word", "patterns": ["the ([a-z]+)"]}]}


@query(
    "t10_fields_of_pages",
    f"""WITH t AS (SELECT page_id, {bare(PAGE_TEXT)} AS x FROM pages)
        SELECT page_id, 'amount' AS field, CASE WHEN regexp_matches(x, '[0-9]+\\.[0-9]+') THEN regexp_extract(x, '[0-9]+\\.[0-9]+') ELSE regexp_extract(x, '[0-9]{{2,}}') END AS raw
        FROM t WHERE regexp_matches(x, '[0-9]+\\.[0-9]+|[0-9]{{2,}}')
        UNION ALL SELECT page_id, 'word', regexp_extract(x, 'the ([a-z]+)', 1) FROM t WHERE regexp_matches(x, 'the ([a-z]+)')""",
)
def _(v: Views) -> DataFrame:
    rules = ex.parse_field_rules(PAGE_RULES)
    archive = pg.page_archive(v.table("pages")).where("status = 'ok'")
    wide = archive.select("page_id", ex.extract_fields("plain_text", rules).alias("f"))
    named = F.array(*[F.struct(F.lit(r.name).alias("field"), F.col(f"f.{r.name}.raw").alias("raw")) for r in rules])
    return wide.select("page_id", F.inline(named)).where(F.col("raw").isNotNull())


@query(
    "t12_page_summary",
    rf"""SELECT page_id, url, regexp_extract(url, '(?i)^(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)', 1) AS host, 'ok' AS status,
          trim({UNESCAPED.format("regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)")}, {' || '.join(f'chr({c})' for c in (32, 9, 10, 13, 160))}) AS title,
          cast(len(regexp_extract_all({PAGE_TEXT}, '(?i)<a\s[^>]*href="[^"]+"')) AS int) AS links_count,
          cast(len(regexp_extract_all({PAGE_TEXT}, '(?i)<h[123][ >]')) AS int) AS headers_count, '' AS error FROM pages""",
)
def _(v: Views) -> DataFrame:
    numbered = v.table("pages").withColumn("url", F.concat_ws("\u0001", "page_id", "url"))
    summary = pg.page_summary(numbered)
    parts = F.split("url", "\u0001")
    return summary.select(
        parts[0].cast("bigint").alias("page_id"),
        parts[1].alias("url"),
        text.net_location(parts[1]).alias("host"),
        "status",
        "title",
        "links_count",
        "headers_count",
        "error",
    )


@query(
    "t13_clean_snippet",
    r"""SELECT doc_id, CASE WHEN length(t) > 96 THEN substr(t, 1, 96) || '...' ELSE t END AS snippet FROM (SELECT doc_id,
          regexp_replace(trim(replace(text, chr(10), ' '), ' ' || chr(9) || chr(13) || chr(160)), '[\x{e000}-\x{f8ff}]', '', 'g') AS t FROM documents)""",
)
def _(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", text.clean_snippet("text").alias("snippet"))


# --------------------------------------------------------------------- ranking
@query("p15_domain_filter", f"SELECT ord FROM results WHERE ({s('url')} LIKE 'http://%' OR {s('url')} LIKE 'https://%') AND {any_in('lower(' + s('url') + ')', ('gov.cn', 'weixin'))}")
def _(v: Views) -> DataFrame:
    return v.results.where(text.domain_filter("url", [" Gov.cn", "weixin", ""])).select("ord")


@query(
    "w2_dedup_results",
    f"""SELECT query, url, title, snippet, engine, first_ord AS ord FROM (SELECT *, row_number() OVER (PARTITION BY query, url ORDER BY
          length(title) + length(snippet) DESC, ord) AS rn, min(ord) OVER (PARTITION BY query, url) AS first_ord
        FROM (SELECT * REPLACE (trim(url) AS url) FROM results WHERE {has('url')})) WHERE rn = 1""",
)
def _(v: Views) -> DataFrame:
    return rk.dedup_results(v.results).select("query", "url", "title", "snippet", "engine", "ord")


def _ranked(v: Views) -> DataFrame:
    score = grading.rank_score("entity", SOURCE_YEAR, "title", "snippet", "url", "engine")
    return v.results.withColumn("search_score", score)


BEST = (
    RANKED
    + """, best AS (SELECT * REPLACE (first_ord AS ord) FROM (SELECT *, row_number() OVER (PARTITION BY entity, url ORDER BY search_score DESC, ord) AS rn,
    min(ord) OVER (PARTITION BY entity, url) AS first_ord FROM ranked) WHERE rn = 1)"""
)


@query("w3_best_per_url", "SELECT entity, url, search_score, engine, title, ord FROM best", BEST)
def _(v: Views) -> DataFrame:
    return rk.best_per_url(_ranked(v)).select("entity", "url", "search_score", "engine", "title", "ord")


@query(
    "w4_cap_per_domain",
    """SELECT entity, url, ord, pos AS rank FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY over, search_score DESC, ord) AS pos FROM (
         SELECT *, h <> '' AND row_number() OVER (PARTITION BY entity, h ORDER BY search_score DESC, ord) > 3 AS over FROM best)) WHERE pos <= 25""",
    BEST,
)
def _(v: Views) -> DataFrame:
    out = rk.cap_per_domain(rk.best_per_url(_ranked(v)), 25, 3)
    return out.select("entity", "url", "ord", F.col("_rank").cast("bigint").alias("rank"))


# Each candidate three times: with its score as text, with a lower or missing one, with a higher one or none.
MANY = """many AS (SELECT entity, (ord * 1000 + sentence_no) * 3 + copy AS ord, url, value_10k, sentence,
      CASE copy WHEN 0 THEN cast(score AS string) WHEN 1 THEN CASE WHEN ord % 3 = 0 THEN NULL ELSE cast(score - 20 AS string) END
        ELSE CASE WHEN ord % 5 = 0 THEN cast(score + 1 AS string) || '.0' ELSE 'n/a' END END AS score
      FROM cands CROSS JOIN (VALUES (0), (1), (2)) AS c(copy))"""
POINTS = "coalesce(try_cast(score AS double), 0)"


@query(
    "w5_dedup_candidates",
    f"""SELECT ord, url, value_10k, sentence, score FROM (SELECT *, row_number() OVER (PARTITION BY url, value_10k, sentence ORDER BY {POINTS} DESC, ord) AS rn FROM many) WHERE rn = 1""",
    FOUND + ", " + MANY,
)
def _(v: Views) -> DataFrame:
    return rk.dedup_candidates(_many(v)).select("ord", "url", "value_10k", "sentence", "score")


def _many(v: Views) -> DataFrame:
    rows = cand.extract_candidates(v.bulletins, SOURCE_YEAR)
    rows = rows.withColumn("copy", F.explode(F.array(*map(F.lit, range(3)))))
    score = F.col("score")
    lower = F.when(F.col("ord") % 3 != 0, (score - 20).cast("string"))
    higher = F.when(F.col("ord") % 5 == 0, F.concat((score + 1).cast("string"), F.lit(".0"))).otherwise(F.lit("n/a"))
    return rows.select(
        "entity",
        ((F.col("ord") * 1000 + F.col("sentence_no")) * 3 + F.col("copy")).alias("ord"),
        "url",
        "value_10k",
        "sentence",
        F.when(F.col("copy") == 0, score.cast("string")).when(F.col("copy") == 1, lower).otherwise(higher).alias("score"),
    )


@query(
    "w6_top_candidates",
    f"""SELECT entity, ord, score, pos AS rank FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY {POINTS} DESC, ord) AS pos FROM
         (SELECT *, row_number() OVER (PARTITION BY entity, url, value_10k, sentence ORDER BY {POINTS} DESC, ord) AS rn FROM many) WHERE rn = 1) WHERE pos <= 4""",
    FOUND + ", " + MANY,
)
def _(v: Views) -> DataFrame:
    out = rk.top_candidates(_many(v), 4)
    return out.select("entity", "ord", "score", F.col("_rank").cast("bigint").alias("rank"))


@query("w8_distinct_in_order", "SELECT url, min(ord) AS ord FROM results GROUP BY 1")
def _(v: Views) -> DataFrame:
    return rk.distinct_in_order(v.results)


@query("w8_first_distinct", "SELECT url, min(ord) AS ord FROM results GROUP BY 1 ORDER BY 2 LIMIT 80")
def _(v: Views) -> DataFrame:
    return rk.distinct_in_order(v.results, limit=80)


@query(
    "w11_first_engine_only",
    """SELECT query, ord, engine FROM (SELECT *, CASE engine WHEN 'bing' THEN 1 WHEN 'google' THEN 2 WHEN '360' THEN 3 END AS e FROM odd) r
       WHERE e = (SELECT min(CASE engine WHEN 'bing' THEN 1 WHEN 'google' THEN 2 WHEN '360' THEN 3 END) FROM odd o WHERE o.query = r.query)""",
    "odd AS (SELECT ord, engine, query || cast(ord % 97 AS string) AS query FROM results)",
)
def _(v: Views) -> DataFrame:
    rows = v.results.withColumn("query", F.concat("query", (F.col("ord") % 97).cast("string")))
    return rk.first_engine_only(rows, ["bing", "google", "360"]).select("query", "ord", "engine")


@query(
    "u1_concat_urls",
    "SELECT url, arg_min(l, l * 1000000000000 + ord) AS first_list, arg_min(ord, l * 1000000000000 + ord) AS ord FROM "
    "(SELECT 0 AS l, ord, url FROM results UNION ALL SELECT 1, page_id, url FROM pages) GROUP BY 1",
)
def _(v: Views) -> DataFrame:
    listed = v.table("pages").select(F.col("page_id").alias("ord"), "url")
    return rk.concat_urls(v.results, listed).select("url", F.col("_list").alias("first_list"), "ord")


# ---------------------------------------------------------------------- routes
ROUTE = (
    "CASE "
    + " ".join(
        f"WHEN {any_in('lower(name || chr(32) || name_cn || chr(32) || source_hint || chr(32) || note)', words)} THEN '{r}'"
        for r, words in routes.ROUTES.items()
    )
    + " ELSE 'web_search' END"
)


@query("p12_classify_route", f"SELECT p_partkey, {ROUTE} AS route FROM wanted")
def _(v: Views) -> DataFrame:
    return routes.classify_route(v.wanted).select("p_partkey", "route")


@query(
    "a12_route_summary",
    " UNION ALL ".join(
        f"SELECT '{e}' AS executor, '{','.join(rs)}' AS routes, count(*) AS n_variables, count(*) > 0 AS enabled FROM wanted WHERE {ROUTE} IN ({', '.join(repr(r) for r in rs)})"
        for e, rs in routes.EXECUTORS.items()
    ),
)
def _(v: Views) -> DataFrame:
    return routes.route_summary(routes.classify_route(v.wanted))


# --------------------------------------------------------------------- sources
@query(
    "s1_s2_csv_round_trip",
    "SELECT row_number() OVER (ORDER BY _row) AS _row, province, year, series, stock_10k, source_url, q FROM "
    "(SELECT *, 'a \"b\", ' || note || chr(10) || 'c' AS q FROM panel)",
)
def _(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "panel")
    quoted = F.concat(F.lit('a "b", '), "note", F.lit("\nc"))
    writers.write_panel(
        v.panel.withColumn("q", quoted), path, ["province", "year", "series", "stock_10k", "source_url", "q"]
    )
    return readers.read_panel(v.spark, path, multi_line=True)


def discovery_documents(v: Views) -> DataFrame:
    """One document per 128 results, rendered as JSON."""
    rows = v.results.withColumn("doc_no", F.floor(F.col("ord") / 128))
    listed = F.col("engine").isin("google", "tavily")
    candidate = F.struct("url", F.lit("s").alias("sentence"), F.col("ord").alias("score"))
    records = rows.groupBy("doc_no", "entity").agg(
        F.bool_or(F.col("engine") == "bing").alias("finished"),
        F.count(F.when(listed, 1)).alias("url_count"),
        F.count(F.when(~listed, 1)).alias("candidate_count"),
        F.array_sort(F.collect_list(F.when(listed, F.struct("ord", "url")))).alias("l"),
        F.array_sort(F.collect_list(F.when(~listed, F.struct("ord", candidate.alias("c"))))).alias("c"),
    )
    record = F.struct(
        "finished",
        "url_count",
        "candidate_count",
        F.col("l.url").alias("selected_urls"),
        F.col("c.c").alias("top_candidates"),
    )
    entries = F.array_sort(F.collect_list(F.struct("entity", record.alias("r"))), lambda a, b: F.when(a["entity"] < b["entity"], -1).when(a["entity"] > b["entity"], 1).otherwise(0))
    return records.groupBy("doc_no").agg(F.to_json(F.map_from_entries(entries)).alias("value"))


PLACED = """placed AS (SELECT *, cast(floor(ord / 128) AS bigint) AS doc, CASE WHEN engine IN ('google', 'tavily') THEN 'selected' ELSE 'candidate' END AS kind FROM results),
    numbered AS (SELECT *, cast(row_number() OVER (PARTITION BY doc, entity, kind ORDER BY ord) - 1 AS int) AS pos FROM placed)"""


@query(
    "s4_discovery_urls",
    "SELECT doc, entity, kind, pos, trim(url) AS url FROM numbered WHERE trim(url) LIKE 'http://%' OR trim(url) LIKE 'https://%'",
    PLACED,
)
def _(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "discovery")
    discovery_documents(v).write.partitionBy("doc_no").text(path)  # one file per document
    urls = readers.discovery_urls(readers.read_discovery(v.spark, path))
    doc = F.regexp_extract(F.col("ord.doc"), "doc_no=([0-9]+)", 1).cast("bigint")
    return urls.select(doc.alias("doc"), "entity", "kind", F.col("ord._p").alias("pos"), "url")


@query(
    "a11_candidate_totals",
    "SELECT count(*) FILTER (kind = 'selected') AS total_urls, count(*) FILTER (kind = 'candidate') AS total_candidates "
    "FROM placed WHERE entity IN ('北京市', '江苏省', '新疆维吾尔自治区')",
    PLACED,
)
def _(v: Views) -> DataFrame:
    summary = readers.discovery_summary(readers.parse_discovery(discovery_documents(v)))
    return rk.candidate_totals(summary, ["北京市", "江苏省", "新疆维吾尔自治区", "西藏自治区"])


@query("s4_discovery_candidates", "SELECT doc, entity, pos, url, ord AS score FROM numbered WHERE kind = 'candidate'", PLACED)
def _(v: Views) -> DataFrame:
    rows = readers.discovery_candidates(readers.parse_discovery(discovery_documents(v)))
    return rows.select(F.col("doc_no").alias("doc"), "entity", F.col("ord").alias("pos"), "url", "score")


@query(
    "s5_url_list",
    "SELECT trim(url) AS url, count(*) AS n FROM results WHERE ord % 4 <> 0 AND (trim(url) LIKE 'http://%' OR trim(url) LIKE 'https://%') GROUP BY 1",
)
def _(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "urls")
    line = F.when(F.col("ord") % 4 == 0, F.concat(F.lit("# "), "url")).otherwise(F.concat(F.lit(" "), "url"))
    v.results.select(line.alias("value")).write.text(path)
    return readers.read_url_list(v.spark, path).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def cubes(v: Views) -> DataFrame:
    """One statistics cube per customer, rendered as JSON."""
    rows = v.sql(
        "SELECT ck, yr, cents, n, 0 AS dup FROM cy UNION ALL SELECT ck, yr, cents + 100, n, 1 FROM cy WHERE ck % 5 = 0"
    )
    code = F.concat(F.lit("r"), F.col("ck").cast("string"))
    stamp = F.when(F.col("n") % 5 == 4, F.lit("x")).otherwise(F.col("yr").cast("string"))
    word = F.struct
    wds = F.array(
        word(F.lit("zb").alias("wdcode"), F.lit("A01").alias("valuecode")),
        word(F.lit("reg").alias("wdcode"), code.alias("valuecode")),
        word(F.lit("sj").alias("wdcode"), stamp.alias("valuecode")),
    )
    data = F.struct((F.col("cents") / 100).alias("data"), (F.col("n") % 4 != 0).alias("hasdata"))
    nodes = rows.groupBy("ck").agg(
        F.array_sort(F.collect_list(F.struct("dup", "yr", F.struct(data.alias("data"), wds.alias("wds")).alias("d")))).alias("d")
    )
    shown = F.when(F.col("ck") % 6 == 0, F.lit("other")).otherwise(code)
    reg = F.struct(
        F.lit("reg").alias("wdcode"),
        F.array(F.struct(shown.alias("code"), F.concat(F.lit("C"), F.col("ck").cast("string")).alias("cname"))).alias("nodes"),
    )
    cube = F.struct(F.struct(F.array(reg).alias("wdnodes"), F.col("d.d").alias("datanodes")).alias("returndata"))
    return nodes.select(F.col("ck").alias("doc_no"), F.to_json(cube).alias("value"))


@query(
    "s6_flatten_cube",
    f"""SELECT 'C' || cast(ck AS string) AS province, yr AS year, CASE WHEN n % 4 <> 0 THEN (cents + CASE WHEN ck % 5 = 0 THEN 100 ELSE 0 END) / 100 END AS gdp
        FROM cy WHERE ck % 6 <> 0 AND n % 5 <> 4 AND yr BETWEEN {FIRST_YEAR + 2} AND {LAST_YEAR}""",
)
def _(v: Views) -> DataFrame:
    return readers.flatten_cube(cubes(v), "gdp", None, FIRST_YEAR + 2, LAST_YEAR)


TIER = r"""CASE WHEN regexp_matches(trim(label), '(?i)^Transportation,\s*Storage,\s*Post\s*and\s*Telecommunication\s*Services$') THEN 0
    WHEN regexp_matches(trim(label), '(?i)Transportation,\s*Storage,\s*Post') THEN 1 WHEN regexp_matches(trim(label), '(?i)Transport') THEN 2 ELSE 3 END"""


@query(
    "s7_extract_sector_rows",
    rf"""SELECT e.full_name AS province, cast(regexp_extract(source_file, '(20[0-9][0-9])', 1) AS int) AS year,
          CASE WHEN tier < 3 THEN {number('total')} END AS transport_co2_mt, CASE WHEN tier < 3 THEN label ELSE '' END AS sector_label,
          CASE WHEN tier < 3 THEN {number('total')} END * 100 AS transport_co2_10k_ton_direct, source_file, sheet
        FROM (SELECT *, scope_1_total AS total, {TIER} AS tier, row_number() OVER (PARTITION BY source_file, sheet ORDER BY {TIER}, row_no) AS rn,
              regexp_extract(sheet, '^([A-Za-z]+)20[0-9][0-9]$', 1) AS alias FROM cells WHERE regexp_matches(source_file, '20[0-9][0-9]'))
          JOIN eng e ON e.eng_name = alias WHERE rn = 1""",
)
def _(v: Views) -> DataFrame:
    return readers.extract_sector_rows(v.cells)


# ------------------------------------------------------------------- streaming
OLD = "SELECT _row, 'E' || cast(ck AS string) AS province, cast(yr AS string) AS year, CASE WHEN n % 3 = 0 THEN '' ELSE cast(whole AS string) END AS stock_10k FROM base"
NEW = "SELECT ck * 16 + (yr - 1990) AS _row, CASE WHEN ck % 3 = 0 THEN 'E' ELSE 'N' END || cast(ck AS string) AS province, cast(yr AS string) AS year, cast(qty AS string) AS stock_10k FROM shipped"


#: A second patch changes half of the keys of the first, whose rows it takes as they were written.
AGAIN = "SELECT _row, province, year, stock_10k || '1' AS stock_10k FROM {rows} WHERE _row % 2 = 0"
LAST = f"SELECT _row, province, year, CASE WHEN _row % 2 = 0 THEN stock_10k || '1' ELSE stock_10k END AS stock_10k FROM ({NEW})"


def _stream(v: Views, rounds: int) -> str:
    """Runs the stream over two patches that share keys, each in the files of its own
    partitions, in about as many rounds; gives the state folder."""
    state, incoming = scratch_path(v.spark, "state"), scratch_path(v.spark, "incoming")
    patches.start_panel(v.sql(OLD), state, "stock_10k", buckets=16)
    new = v.sql(NEW)
    new.write.parquet(f"{incoming}/a")
    written = v.spark.read.schema(new.schema).parquet(f"{incoming}/a")
    v.spark.sql(AGAIN, rows=written).write.parquet(f"{incoming}/b")
    files = len(v.spark.read.parquet(f"{incoming}/*").inputFiles())
    query = patches.stream_rounds(v.spark, f"{incoming}/*", state, new.schema, "stock_10k", -(-files // rounds))
    query.awaitTermination()
    return state


@query(
    "x1_stream_rounds",
    f"""SELECT coalesce(n.province, o.province) AS province, coalesce(n.year, o.year) AS year, coalesce(n.stock_10k, o.stock_10k) AS stock_10k
        FROM ({OLD}) o FULL JOIN ({LAST}) n ON n.province = o.province AND n.year = o.year""",
)
def _(v: Views) -> DataFrame:
    return patches.latest_panel(v.spark, _stream(v, 2)).select("province", "year", "stock_10k")


@query(
    "x1_one_batch",
    f"""SELECT coalesce(n.province, o.province) AS province, coalesce(n.year, o.year) AS year, coalesce(n.stock_10k, o.stock_10k) AS stock_10k
        FROM ({OLD}) o FULL JOIN ({LAST}) n ON n.province = o.province AND n.year = o.year""",
)
def _(v: Views) -> DataFrame:
    return patches.latest_panel(v.spark, _stream(v, 1)).select("province", "year", "stock_10k")


@query(
    "x1_round_history",
    f"""SELECT count(*) AS rows, count(*) FILTER (coalesce(n.stock_10k, o.stock_10k) <> '') AS filled_rows,
          count(*) FILTER (coalesce(n.stock_10k, o.stock_10k) <> '' AND coalesce(o.stock_10k, '') = '') AS gained_keys
        FROM ({OLD}) o FULL JOIN ({NEW}) n ON n.province = o.province AND n.year = o.year""",
)
def _(v: Views) -> DataFrame:
    history = patches.round_history(v.spark, _stream(v, 2))
    return history.agg(
        F.max_by("rows", "batch").alias("rows"),
        F.max_by("filled_rows", "batch").alias("filled_rows"),
        F.sum("gained_keys").alias("gained_keys"),
    )
