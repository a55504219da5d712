"""Queries over panels: entities, keys, joins, coverage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.bindings.catalog import ENT, KEYED, has, number, query, s, year
from evidencepanel.bindings.views import FIRST_YEAR, LAST_YEAR, Views
from evidencepanel.functions import entity as ent
from evidencepanel.functions.entity import norm_key
from evidencepanel.functions.text import has_value, strip
from evidencepanel.operators import coverage as cov
from evidencepanel.operators import panel as pan
from evidencepanel.operators import stored
from evidencepanel.operators.groups import keep_last
from evidencepanel.plans import rounds
from evidencepanel.plans.session import scratch_path

KEYS = ["province", "year", "series"]
VALUES = ["stock_10k", "aux_value"]
YEARS = list(range(FIRST_YEAR, LAST_YEAR + 1))
GRID = f"SELECT ordinal, short_name, full_name, y AS year FROM dim, generate_series({FIRST_YEAR}, {LAST_YEAR}) AS g(y)"


# ------------------------------------------------------------------ entities
@query(
    "p1_normalize_entity",
    "SELECT _row, e.short_name AS short_form, e.full_name AS full_form, e.code AS code_form "
    "FROM panel p LEFT JOIN ent e ON e.name = p.province",
    ENT,
)
def _(v: Views) -> DataFrame:
    forms = [ent.normalize_entity("province", target=f).alias(f"{f}_form") for f in ent.FORMS]
    return v.panel.select("_row", *forms)


@query(
    "p1_normalize_entity_join",
    """SELECT c_custkey, (SELECT arg_min(n_nationkey, n_nationkey) FROM nation
          WHERE starts_with(c_name2, n_name)) AS first_nation
       FROM (SELECT c_custkey, 'NATION_' || cast(c_custkey % 30 AS string) || c_mktsegment AS c_name2 FROM customer)""",
)
def _(v: Views) -> DataFrame:
    dim = v.table("nation").select(
        F.col("n_nationkey").alias("ordinal"),
        F.col("n_name").alias("short"),
        F.concat("n_name", F.lit(" full")).alias("full"),
        F.concat(F.lit("code"), F.col("n_nationkey")).alias("code"),
    )
    rows = v.table("customer").select(
        "c_custkey",
        F.concat(F.lit("NATION_"), (F.col("c_custkey") % 30).cast("string"), "c_mktsegment").alias("name"),
    )
    out = ent.normalize_entity_join(rows, "name", dim, "entity")
    return out.select("c_custkey", F.substring("entity", F.lit(8), F.length("entity")).try_cast("int").alias("first_nation"))


@query(
    "p2_strict_names",
    """SELECT _row, (SELECT max(full_name) FROM dim WHERE short_name = province OR full_name = province) AS full_form,
         (SELECT max(short_name) FROM dim WHERE short_name = province OR full_name = province) AS short_form FROM panel""",
)
def _(v: Views) -> DataFrame:
    return v.panel.select(
        "_row", ent.short_to_full("province").alias("full_form"), ent.full_to_short("province").alias("short_form")
    )


@query(
    "p3_entity_universe",
    "SELECT ordinal, short_name AS entity, count(ck) AS n_rows FROM dim LEFT JOIN base USING (ordinal, short_name) GROUP BY 1, 2",
)
def _(v: Views) -> DataFrame:
    counts = v.base.groupBy("ordinal").agg(F.count("ck").alias("n"))
    universe = ent.entity_universe(v.spark)
    out = universe.join(counts, "ordinal", "left")
    return out.select("ordinal", "entity", F.coalesce("n", F.lit(0)).alias("n_rows"))


@query("p4_norm_key", "SELECT _row, k_province, k_year, series AS k_series FROM keyed", KEYED)
def _(v: Views) -> DataFrame:
    return v.panel.select("_row", *[norm_key(k).alias(f"k_{k}") for k in KEYS])


@query("p5_has_value", f"SELECT _row FROM panel WHERE {has('stock_10k')} OR {has('aux_value')}")
def _(v: Views) -> DataFrame:
    return v.panel.where(has_value(VALUES)).select("_row")


@query(
    "p6_alias_to_entity",
    r"""SELECT source_file, row_no, e.full_name AS province FROM cells
        JOIN eng e ON regexp_extract(sheet, '^([A-Za-z]+)20[0-9][0-9]$', 1) = e.eng_name""",
)
def _(v: Views) -> DataFrame:
    named = v.cells.select(
        "source_file", "row_no", F.regexp_extract("sheet", r"\A([A-Za-z]+)20\d{2}\z", 1).alias("alias")
    )
    return ent.alias_to_entity(named, "alias", ent.ENGLISH_NAMES).drop("alias")


@query(
    "p7_entity_aliases",
    """SELECT _row, short_name || CASE WHEN full_name IN ('内蒙古自治区', '新疆维吾尔自治区') THEN '|全区|我区'
         WHEN contains(full_name, '自治区') THEN '|全省|我省|全区|我区' WHEN full_name LIKE '%市' THEN '|全市|我市'
         ELSE '|全省|我省' END AS aliases FROM base""",
)
def _(v: Views) -> DataFrame:
    out = ent.entity_aliases(v.base, "full_name")
    return out.select("_row", F.array_join("aliases", "|").alias("aliases"))


# --------------------------------------------------------------- projections
@query(
    "p11_render_templates",
    """SELECT cast(g.year AS int) AS year, short_name AS entity, n AS template_no,
         replace(replace(replace(t, '{year}', cast(g.year AS string)), '{YEAR}', cast(g.year AS string)), '{entity}', short_name) AS query
       FROM grid g JOIN (VALUES (0, '{省名} 充电桩 {year} 保有量 台'), (1, '{entity} {YEAR} stock_10k')) AS t(n, t) ON true
       WHERE NOT EXISTS (SELECT 1 FROM cover c WHERE c.year = g.year AND c.entity = g.short_name)""",
    ENT
    + f", grid AS ({GRID}), cover AS (SELECT DISTINCT e.short_name AS entity, {year()} AS year FROM panel p "
    f"JOIN ent e ON e.name = {s('p.province')} WHERE {has('stock_10k')})",
)
def _(v: Views) -> DataFrame:
    gaps = cov.gap_matrix(v.panel, "stock_10k", FIRST_YEAR, LAST_YEAR).drop("ordinal")
    templates = ["{省名} {keyword_name} {year} 保有量 台", "{entity} {YEAR} {value_col}"]
    return cov.render_templates(gaps, templates, "充电桩", "stock_10k", {"{entity}": "entity"})


@query(
    "p13_derive_ratios",
    """SELECT province, year, ck,
         round(gdp_100m_cny * 10000 / nullif(resident_population_10k_person, 0), 4) AS gdp_per_capita_yuan,
         round(urban_population_10k_person / nullif(resident_population_10k_person, 0), 4) AS urbanization_rate,
         round(tertiary_value_added_100m_cny / nullif(gdp_100m_cny, 0), 4) AS tertiary_share FROM economy""",
)
def _(v: Views) -> DataFrame:
    out = pan.derive_ratios(v.economy)
    names = ["gdp_per_capita_yuan", "urbanization_rate", "tertiary_share"]
    return out.select("province", "year", "ck", *[F.round(c, 4).alias(c) for c in names])


@query(
    "p14_estimate_emission",
    """SELECT province, year, ck, round(coalesce(gasoline_consumption_10k_ton, gasoline_consumption_10k_ton_filled) * 2.925::DOUBLE
         + diesel_consumption_10k_ton * 3.096::DOUBLE, 3) AS transport_co2_est_10k_ton FROM economy""",
)
def _(v: Views) -> DataFrame:
    out = pan.estimate_emission(v.economy)
    name = "transport_co2_est_10k_ton"
    return out.select("province", "year", "ck", F.round(name, 3).alias(name))


# --------------------------------------------------------------------- joins
NEW_KEY = "coalesce(e.short_name, n.province)"


@query(
    "j1_merge_panel",
    f"""SELECT p._row, CASE WHEN {has('w.stock_10k')} THEN w.stock_10k ELSE p.stock_10k END AS stock_10k,
          CASE WHEN {has('w.aux_value')} THEN w.aux_value ELSE p.aux_value END AS aux_value,
          CASE WHEN {has('w.stock_10k')} THEN 1 ELSE 0 END + CASE WHEN {has('w.aux_value')} THEN 1 ELSE 0 END AS written
        FROM panel p LEFT JOIN w ON w.kp = p.province AND w.year = p.year AND w.series = p.series""",
    ENT
    + f""", w AS (SELECT {NEW_KEY} AS kp, n.year, n.series, arg_max(n.stock_10k, n._row) AS stock_10k,
          arg_max(n.aux_value, n._row) AS aux_value FROM patch n LEFT JOIN ent e ON e.name = n.province GROUP BY 1, 2, 3)""",
)
def _(v: Views) -> DataFrame:
    out = pan.merge_panel(v.panel, v.patch, KEYS, VALUES, entity_form="short")
    return out.select("_row", *VALUES, F.col("_written").alias("written"))


@query(
    "j1_cells_written",
    f"""SELECT cast(sum(CASE WHEN {has('w.stock_10k')} THEN 1 ELSE 0 END + CASE WHEN {has('w.aux_value')} THEN 1 ELSE 0 END) AS bigint)
          AS cells_written FROM panel p JOIN w ON w.kp = p.province AND w.year = p.year AND w.series = p.series""",
    ENT
    + f""", w AS (SELECT {NEW_KEY} AS kp, n.year, n.series, arg_max(n.stock_10k, n._row) AS stock_10k,
          arg_max(n.aux_value, n._row) AS aux_value FROM patch n LEFT JOIN ent e ON e.name = n.province GROUP BY 1, 2, 3)""",
)
def _(v: Views) -> DataFrame:
    return pan.cells_written(pan.merge_panel(v.panel, v.patch, KEYS, VALUES, entity_form="short"))


FILL = f"""r AS (SELECT {s('province')} AS p, {s('year')} AS y, {s('series')} AS se, arg_max({s('stock_10k')}, _row) AS ref
    FROM patch GROUP BY 1, 2, 3), f AS (SELECT p.*, {s('p.year')} IN ('1996', '1998', '2000') AS scanned,
    {s('p.year')} IN ('1996', '1998', '2000') AND NOT {has('p.stock_10k')} AND coalesce(r.ref, '') <> '' AS filled, r.ref
    FROM panel p LEFT JOIN r ON r.p = {s('p.province')} AND r.y = {s('p.year')} AND r.se = {s('p.series')})"""


@query("j2_reference_fill", "SELECT _row, CASE WHEN filled THEN ref ELSE stock_10k END AS stock_10k, scanned, filled FROM f", FILL)
def _(v: Views) -> DataFrame:
    out = pan.reference_fill(v.panel, v.patch, KEYS, "stock_10k", [1996, 1998, 2000])
    return out.select("_row", "stock_10k", F.col("_scanned").alias("scanned"), F.col("_filled").alias("filled"))


@query(
    "j2_fill_counts",
    "SELECT count(*) FILTER (scanned) AS scanned, count(*) FILTER (filled) AS filled FROM f",
    FILL,
)
def _(v: Views) -> DataFrame:
    return pan.fill_counts(pan.reference_fill(v.panel, v.patch, KEYS, "stock_10k", [1996, 1998, 2000]))


@query(
    "j3_panel_skeleton",
    f"""SELECT 'C' || cast(c_custkey AS string) AS province, cast(y AS int) AS year, '' AS stock_10k
        FROM customer, generate_series({FIRST_YEAR}, {LAST_YEAR}) AS g(y)""",
)
def _(v: Views) -> DataFrame:
    dim = v.table("customer").select(
        F.col("c_custkey").alias("ordinal"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("full")
    )
    return pan.panel_skeleton(dim, FIRST_YEAR, LAST_YEAR, "full", ["stock_10k"]).drop("ordinal")


PARTS = f""", grid AS ({GRID}), a AS (SELECT full_name, yr, sum(cents) AS cents FROM base GROUP BY 1, 2),
    b AS (SELECT d.full_name, yr, sum(qty) AS qty FROM shipped JOIN customer ON c_custkey = ck JOIN dim d ON ordinal = c_nationkey GROUP BY 1, 2)"""


@query(
    "j4_assemble_panel",
    """SELECT g.full_name AS province, cast(g.year AS int) AS year, cast(a.cents AS bigint) AS cents, cast(b.qty AS bigint) AS qty FROM grid g
       LEFT JOIN a ON a.full_name = g.full_name AND a.yr = g.year LEFT JOIN b ON b.full_name = g.full_name AND b.yr = g.year""",
    PARTS[2:],
)
def _(v: Views) -> DataFrame:
    a = v.base.groupBy(F.col("short_name").alias("province"), F.col("yr").cast("string").alias("year"))
    b = v.sql("SELECT d.code AS province, yr AS year, qty FROM shipped JOIN {customer} ON c_custkey = ck JOIN dim d ON ordinal = c_nationkey")
    parts = [a.agg(F.sum("cents").alias("cents")), b.groupBy("province", "year").agg(F.sum("qty").alias("qty"))]
    skeleton = pan.panel_skeleton(ent.PROVINCES, FIRST_YEAR, LAST_YEAR, spark=v.spark)
    return pan.assemble_panel(skeleton, parts, ["province", "year", "cents", "qty"])


@query(
    "j10_upsert",
    f"""SELECT _row, province, year, stock_10k, note FROM (SELECT *, row_number() OVER (PARTITION BY e, y ORDER BY side DESC, _row DESC) AS rn
        FROM (SELECT _row, {s('series || province')} AS e, {year()} AS y, series || province AS province, year, stock_10k, note, 0 AS side
              FROM panel WHERE {has('series || province')} AND coalesce({year()}, 0) <> 0
              UNION ALL SELECT _row, series || province, {year()}, series || province, year, stock_10k, NULL, 1 FROM patch)) WHERE rn = 1""",
)
def _(v: Views) -> DataFrame:
    key = F.concat("series", "province")
    old = v.panel.select("_row", key.alias("province"), "year", "stock_10k", "note")
    new = v.patch.select("_row", key.alias("province"), "year", "stock_10k")
    return pan.upsert(old, new).select("_row", "province", "year", "stock_10k", "note")


COLS = ["stock_10k", "source_id", "source_url", "access_date", "evidence"]


@query(
    "j11_overwrite_columns",
    f"""SELECT p._row, CASE WHEN u THEN w.stock_10k ELSE p.stock_10k END AS stock_10k,
          CASE WHEN u THEN w.source_id ELSE p.source_id END AS source_id, CASE WHEN u THEN w.source_url ELSE p.source_url END AS source_url,
          CASE WHEN u THEN w.access_date ELSE p.access_date END AS access_date, '' AS evidence, u AS updated
        FROM (SELECT p.*, w AS w, coalesce({s('p.year')} IN ('1997', '1999') AND {has('w.stock_10k')} AND w.n > 0, false) AS u
              FROM panel p LEFT JOIN w ON w.p = {s('p.province')} AND w.y = {s('p.year')} AND w.se = {s('p.series')}) p""",
    f"""w AS (SELECT {s('province')} AS p, {s('year')} AS y, {s('series')} AS se, count(*) AS n, arg_max(stock_10k, _row) AS stock_10k,
          arg_max(source_id, _row) AS source_id, arg_max(source_url, _row) AS source_url, arg_max(access_date, _row) AS access_date
          FROM patch GROUP BY 1, 2, 3)""",
)
def _(v: Views) -> DataFrame:
    out = pan.overwrite_columns(v.panel, v.patch, COLS, KEYS, [1997, 1999], require="stock_10k")
    return out.select("_row", *COLS, F.col("_updated").alias("updated"))


STORED_KEYS = ", ".join(s(k) for k in KEYS)
STORED = f"""last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {STORED_KEYS} ORDER BY _row DESC) AS rn FROM panel) WHERE rn = 1),
  news AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {STORED_KEYS} ORDER BY _row DESC) AS rn FROM patch) WHERE rn = 1)"""
ON_KEYS = " AND ".join(f"{s('p.' + k)} = {s('w.' + k)}" for k in KEYS)
STORED_COLS = COLS[:-1]


def _stored(v: Views) -> stored.StoredPanel:
    """The panel as a table of its own."""
    at = stored.StoredPanel(f"panel_{uuid.uuid4().hex}", {k: strip for k in KEYS}, parts=4, buckets=16)
    stored.store_panel(v.panel, at, scratch_path(v.spark, "stored-panel"))
    return at


@query(
    "j1_merge_stored",
    f"SELECT p._row, p.province, CASE WHEN {has('w.stock_10k')} THEN w.stock_10k ELSE p.stock_10k END AS stock_10k "
    f"FROM last p LEFT JOIN news w ON {ON_KEYS}",
    STORED,
)
def _(v: Views) -> DataFrame:
    at = _stored(v)
    stored.merge_stored(v.patch, at, ["stock_10k"])
    return stored.stored_rows(v.spark, at).select("_row", "province", "stock_10k")


@query(
    "j10_upsert_stored",
    f"SELECT _row, province, year, stock_10k, NULL AS note FROM news UNION ALL "
    f"SELECT p._row, p.province, p.year, p.stock_10k, p.note FROM last p LEFT JOIN news w ON {ON_KEYS} WHERE w._row IS NULL",
    STORED,
)
def _(v: Views) -> DataFrame:
    at = _stored(v)
    stored.upsert_stored(v.patch.select("_row", *KEYS, "stock_10k"), at)
    return stored.stored_rows(v.spark, at).select("_row", "province", "year", "stock_10k", "note")


@query(
    "j11_overwrite_stored",
    "SELECT p._row, "
    + ", ".join(f"CASE WHEN u THEN coalesce(w_{c}, '') ELSE {c} END AS {c}" for c in STORED_COLS)
    + f""" FROM (SELECT p.*, {", ".join(f"w.{c} AS w_{c}" for c in STORED_COLS)},
          w._row IS NOT NULL AND {s('p.year')} IN ('1997', '1999') AND {has('w.stock_10k')} AS u
        FROM last p LEFT JOIN news w ON {ON_KEYS}) p""",
    STORED,
)
def _(v: Views) -> DataFrame:
    at = _stored(v)
    stored.overwrite_stored(v.patch, at, STORED_COLS, [1997, 1999], require="stock_10k")
    return stored.stored_rows(v.spark, at).select("_row", *STORED_COLS)


def _other_panel(v: Views) -> DataFrame:
    """The panel after a fill, with some cells changed."""
    return v.sql(
        "SELECT _row, CASE WHEN _row % 5 = 0 THEN 'elsewhere' ELSE province END AS province, year, series, "
        "CASE WHEN _row % 7 = 0 THEN aux_value ELSE stock_10k END AS stock_10k, aux_value, 'x' AS extra FROM panel"
    )


def _diff(c: str) -> str:
    d = f"abs({number('a.' + c)} - {number('b.' + c)})"
    return (
        f"SELECT '{c}' AS \"column\", count({d}) AS both_non_na, count(*) FILTER ({d} > 1e-9) AS unequal_count, "
        f"round(coalesce(max({d}), 0), 4) AS max_abs_diff, round(coalesce(avg({d}), 0), 4) AS mean_abs_diff FROM panel a JOIN b "
        f"ON a.province = b.province AND a.year = b.year AND a.series = b.series"
    )


@query(
    "j14_compare_panels",
    " UNION ALL ".join(_diff(c) for c in VALUES),
    "b AS (SELECT _row, CASE WHEN _row % 5 = 0 THEN 'elsewhere' ELSE province END AS province, year, series, "
    "CASE WHEN _row % 7 = 0 THEN aux_value ELSE stock_10k END AS stock_10k, aux_value FROM panel)",
)
def _(v: Views) -> DataFrame:
    out = pan.compare_panels(v.panel, _other_panel(v), KEYS)
    return out.select(
        "column", "both_non_na", "unequal_count", *[F.round(c, 4).alias(c) for c in ("max_abs_diff", "mean_abs_diff")]
    )


PANEL_ONLY = ("source_id", "source_level", "source_name", "source_url", "cross_check_url", "access_date", "note")


def _column_rows(kind: str, columns, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{c}' AS \"column\", count(*) FILTER ({has(c)}) AS non_blank FROM {table}" for c in columns
    )


@query(
    "u3_shared_columns",
    f"""{_column_rows("shared", VALUES, "panel")} UNION ALL {_column_rows("right_only", ["extra"], "(SELECT 'x' AS extra FROM panel)")}
        UNION ALL {_column_rows("left_only", PANEL_ONLY, "panel")}""",
)
def _(v: Views) -> DataFrame:
    from evidencepanel.operators.quality import column_coverage

    other = _other_panel(v)
    found = pan.shared_columns(v.panel, other, [*KEYS, "_row"])
    out = None
    for kind, columns in found.items():
        table = other if kind == "right_only" else v.panel
        rows = column_coverage(table, columns).select(F.lit(kind).alias("kind"), "column", "non_blank")
        out = rows if out is None else out.unionByName(rows)
    return out


PATTERN = r"新能源汽车保有量(?:达到|约为|为)? ?([0-9]+(?:\.[0-9]+)?) ?万?辆"
SPECS = f"""
    SELECT _row * 2 + dup AS _row, CASE WHEN ck % 3 = 1 THEN 'X' ELSE 'E' END || cast(ck AS string) AS province, cast(t.yr AS string) AS year,
      'SRC_J' || cast(_row * 2 + dup AS string) AS source_id, 'A' AS source_level, 'bulletin' AS source_name,
      CASE WHEN ck % 11 = 2 THEN 'http://gone.example' ELSE b.url END AS source_url,
      '{PATTERN}' AS pattern, 'n' || cast(dup AS string) AS note
    FROM (SELECT *, 0 AS dup FROM base UNION ALL SELECT *, 1 AS dup FROM base WHERE ck % 4 = 1) t
      JOIN bulletins b ON b.ord = t._row"""
STRICT = """
    SELECT _row, CASE WHEN ck % 7 = 3 THEN 'Y' ELSE 'E' END || cast(ck AS string) AS province, cast(yr AS string) AS year,
      CASE WHEN ck % 6 = 0 THEN cast(whole AS string) ELSE ' ' END AS stock_10k, 'https://own.example' AS source_url
    FROM base"""
FILLED = f"""specs AS ({SPECS}), strict AS ({STRICT}),
    tried AS (SELECT sp.*, st._row AS st_row, {s('st.stock_10k')} AS old, b.text, regexp_extract(b.text, sp.pattern, 1) AS got
      FROM specs sp LEFT JOIN strict st ON st.province = sp.province AND st.year = sp.year LEFT JOIN bulletins b ON b.url = sp.source_url),
    firsts AS (SELECT province, year, min(_row) AS f, arg_min(got, _row) AS w FROM tried WHERE st_row IS NOT NULL AND old = '' AND got <> '' GROUP BY 1, 2),
    done AS (SELECT t.*, f, w, CASE WHEN st_row IS NULL THEN 'error' WHEN old <> '' OR (f IS NOT NULL AND _row > f) THEN 'skipped_already_filled'
      WHEN _row = f THEN 'ok' ELSE 'error' END AS status FROM tried t LEFT JOIN firsts USING (province, year))"""


def _fill(v: Views) -> dict[str, DataFrame]:
    pages = v.bulletins.select("url", "text")
    return pan.fill_with_status(v.sql(STRICT), v.sql(SPECS.replace("\\", "\\\\")), pages, "stock_10k", "2025-01-01")


@query(
    "j15_fill_with_status",
    """SELECT _row, province, year, status, CASE WHEN status = 'ok' THEN got WHEN status = 'error' THEN '' WHEN old <> '' THEN old ELSE w END AS value,
         CASE WHEN status = 'ok' THEN substr(text, greatest(1, instr(text, m) - 120), instr(text, m) + 220 - greatest(1, instr(text, m) - 120)) ELSE '' END AS evidence,
         CASE WHEN status <> 'error' THEN '' WHEN st_row IS NULL THEN 'panel_row_not_found' WHEN text IS NULL THEN 'no_text' ELSE 'regex_not_matched' END AS error
       FROM (SELECT *, regexp_extract(text, pattern, 0) AS m FROM done)""",
    FILLED,
)
def _(v: Views) -> DataFrame:
    return _fill(v)["evidence"].select("_row", "province", "year", "status", "value", "evidence", "error")


@query(
    "j15_patched_panel",
    """SELECT st._row, CASE WHEN d.status = 'ok' THEN d.got ELSE st.stock_10k END AS stock_10k, coalesce(d.source_id, '') AS source_id,
         CASE WHEN d.status = 'ok' THEN 'Round3严格补采; ' || d.note ELSE '' END AS note
       FROM strict st LEFT JOIN (SELECT * FROM done WHERE status = 'ok') d ON d.province = st.province AND d.year = st.year""",
    FILLED,
)
def _(v: Views) -> DataFrame:
    return _fill(v)["panel"].select("_row", "stock_10k", "source_id", "note")


@query(
    "j15_registry_additions",
    """SELECT _row, source_id, 'stock_10k' AS variable, source_level, source_name, source_url, '2025-01-01' AS access_date, note
       FROM done WHERE status = 'ok'""",
    FILLED,
)
def _(v: Views) -> DataFrame:
    names = ["_row", "source_id", "variable", "source_level", "source_name", "source_url", "access_date", "note"]
    return _fill(v)["registry"].select(*names)


@query("w1_keep_last", "SELECT _row, province, year, series, stock_10k FROM (SELECT *, row_number() OVER (PARTITION BY province, year, series ORDER BY _row DESC) AS rn FROM patch) WHERE rn = 1")
def _(v: Views) -> DataFrame:
    return keep_last(v.patch, KEYS).select("_row", *KEYS, "stock_10k")


# ------------------------------------------------------------------ coverage
COVER = (
    ENT
    + f", grid AS ({GRID}), cover AS (SELECT DISTINCT e.short_name AS entity, {year()} AS year FROM panel p "
    f"JOIN ent e ON e.name = {s('p.province')} WHERE {has('stock_10k')}), gaps AS (SELECT * FROM grid g WHERE NOT EXISTS "
    "(SELECT 1 FROM cover c WHERE c.year = g.year AND c.entity = g.short_name))"
)
FILLED_ROW = f"({has('stock_10k')} OR {has('aux_value')})"


@query(
    "a3_coverage_summary",
    f"""SELECT cast(sum(n) AS bigint) AS total_rows, cast({30 * len(YEARS)} AS bigint) AS all_keys_count, count(*) FILTER (f) AS filled_keys_count,
          round(count(*) FILTER (f) / {30 * len(YEARS)} * 100, 4) AS fill_rate
        FROM (SELECT k_province, k_year, count(*) AS n, bool_or({FILLED_ROW}) AS f FROM keyed GROUP BY 1, 2)""",
    KEYED,
)
def _(v: Views) -> DataFrame:
    out = cov.coverage_stats(v.panel, ["province", "year"], VALUES, YEARS).summary
    return out.withColumn("fill_rate", F.round("fill_rate", 4))


@query(
    "a3_coverage_any_keys",
    f"""SELECT cast(sum(n) AS bigint) AS total_rows, count(*) AS all_keys_count, count(*) FILTER (f) AS filled_keys_count,
          round(count(*) FILTER (f) / count(*) * 100, 4) AS fill_rate
        FROM (SELECT k_province, k_year, series, count(*) AS n, bool_or({FILLED_ROW}) AS f FROM keyed GROUP BY 1, 2, 3)""",
    KEYED,
)
def _(v: Views) -> DataFrame:
    out = cov.coverage_stats(v.panel, KEYS, VALUES).summary
    return out.withColumn("fill_rate", F.round("fill_rate", 4))


@query(
    "a3_coverage_by_year",
    f"SELECT cast(k_year AS int) AS year, count(*) AS filled_rows FROM keyed WHERE {FILLED_ROW} AND regexp_matches(k_year, '^[0-9]+$') GROUP BY 1",
    KEYED,
)
def _(v: Views) -> DataFrame:
    return cov.coverage_stats(v.panel, KEYS, VALUES).by_year


@query(
    "a3_coverage_by_column",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({has(c)}) AS non_blank FROM panel" for c in VALUES),
)
def _(v: Views) -> DataFrame:
    return cov.coverage_stats(v.panel, KEYS, VALUES).by_column


@query("a4_gap_matrix", "SELECT cast(year AS int) AS year, short_name AS entity, ordinal FROM gaps", COVER)
def _(v: Views) -> DataFrame:
    return cov.gap_matrix(v.panel, "stock_10k", FIRST_YEAR, LAST_YEAR)


def customer_dim(v: Views) -> DataFrame:
    """One entity per customer: as many as the table holds."""
    name = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    return v.table("customer").select(
        F.col("c_custkey").alias("ordinal"),
        F.rpad(name, 20, "_").alias("short"),
        name.alias("full"),
        F.concat(F.lit("code"), F.col("c_custkey").cast("string")).alias("code"),
    )


#: The panel with an entity per customer, written by full name, by code, or in no known way.
MANY_NAMES = """SELECT _row, CASE ck % 5 WHEN 0 THEN 'code' || cast(ck AS string) WHEN 1 THEN '?' || cast(ck AS string) ELSE ' C' || cast(ck AS string) END AS province,
    cast(yr AS string) AS year, CASE WHEN frac >= 20 THEN '1' ELSE ' ' END AS stock_10k FROM base"""
LARGE = f"large AS (SELECT _row, trim(province) AS raw, CASE WHEN ck % 5 = 1 THEN trim(province) ELSE rpad('C' || cast(ck AS string), 20, '_') END AS entity, yr, ck, frac >= 20 AS filled FROM ({MANY_NAMES}) JOIN base USING (_row))"
N_LARGE = f"((SELECT count(*) FROM customer) * {len(YEARS)})"


@query(
    "p2_strict_names_large",
    "SELECT _row, CASE WHEN ck % 5 > 1 THEN 'C' || cast(ck AS string) END AS full_form, CASE WHEN ck % 5 > 1 THEN entity END AS short_form FROM large",
    LARGE,
)
def _(v: Views) -> DataFrame:
    rows = v.sql(MANY_NAMES).withColumn("province", F.trim("province"))
    return ent.strict_names(rows, "province", customer_dim(v)).select("_row", "full_form", "short_form")


@query(
    "j1_merge_panel_large",
    """SELECT ck * 16 + (yr - 1990) AS _row, rpad('C' || cast(ck AS string), 20, '_') AS province, cast(yr AS string) AS year,
         CASE WHEN ck % 5 <> 1 AND frac >= 20 THEN '1' ELSE '0' END AS stock_10k FROM base""",
)
def _(v: Views) -> DataFrame:
    base = v.sql("SELECT _row, rpad('C' || cast(ck AS string), 20, '_') AS province, cast(yr AS string) AS year, '0' AS stock_10k FROM base")
    out = pan.merge_panel(base, v.sql(MANY_NAMES), ["province", "year"], ["stock_10k"], "short", customer_dim(v))
    return out.drop("_written")


@query(
    "a3_coverage_large",
    f"""SELECT cast(sum(n) AS bigint) AS total_rows, cast(any_value({N_LARGE}) AS bigint) AS all_keys_count, count(*) FILTER (f) AS filled_keys_count,
          round(count(*) FILTER (f) / any_value({N_LARGE}) * 100, 4) AS fill_rate
        FROM (SELECT entity, yr, count(*) AS n, bool_or(filled) AS f FROM large GROUP BY 1, 2)""",
    LARGE,
)
def _(v: Views) -> DataFrame:
    out = cov.coverage_stats(v.sql(MANY_NAMES), ["province", "year"], ["stock_10k"], YEARS, customer_dim(v)).summary
    return out.withColumn("fill_rate", F.round("fill_rate", 4))


@query(
    "r1_round_metrics_large",
    f"""SELECT cast(0 AS bigint) AS gained_keys, {N_LARGE} - c AS missing_before, {N_LARGE} - c AS missing_after,
          round(f / {N_LARGE} * 100, 4) AS fill_rate_before, round(f / {N_LARGE} * 100, 4) AS fill_rate_after
        FROM (SELECT count(DISTINCT (ck, yr)) FILTER (filled AND ck % 5 <> 1 AND yr BETWEEN {FIRST_YEAR} AND {LAST_YEAR}) AS c,
              count(DISTINCT (entity, yr)) FILTER (filled) AS f FROM large)""",
    LARGE,
)
def _(v: Views) -> DataFrame:
    rows = v.sql(MANY_NAMES)
    out = rounds.round_metrics(rows, rows, ["province", "year"], ["stock_10k"], FIRST_YEAR, LAST_YEAR, customer_dim(v))
    return out.select(
        "gained_keys",
        "missing_before",
        "missing_after",
        *[F.round(c, 4).alias(c) for c in ("fill_rate_before", "fill_rate_after")],
    )


@query("q8_entity_form_large", "SELECT _row FROM large WHERE ck % 5 < 2", LARGE)
def _(v: Views) -> DataFrame:
    from evidencepanel.operators.quality import check_entity_form

    out = check_entity_form(v.sql(MANY_NAMES), "full", customer_dim(v))
    return out.select((F.col("line") - 1).alias("_row"))


@query(
    "a4_gap_matrix_large",
    f"""SELECT cast(y AS int) AS year, 'C' || cast(c_custkey AS string) AS entity FROM customer, generate_series({FIRST_YEAR}, {LAST_YEAR}) AS g(y)
        WHERE NOT EXISTS (SELECT 1 FROM base WHERE ck = c_custkey AND yr = y AND frac >= 20)""",
)
def _(v: Views) -> DataFrame:
    rows = v.base.select(
        F.concat(F.lit("C"), F.col("ck").cast("string")).alias("province"),
        F.col("yr").cast("string").alias("year"),
        F.when(F.col("frac") >= 20, "1").otherwise(" ").alias("stock_10k"),
    )
    out = cov.gap_matrix(rows, "stock_10k", FIRST_YEAR, LAST_YEAR, customer_dim(v))
    return out.select("year", F.rtrim(F.replace("entity", F.lit("_"), F.lit(" "))).alias("entity"))


@query(
    "a5_year_gap_summary",
    f"""SELECT year, covered, missing, cast(CASE WHEN missing > 0 THEN row_number() OVER (ORDER BY missing = 0, missing, year) END AS int) AS focus_rank
        FROM (SELECT cast(y AS int) AS year, 30 - count(g.year) AS covered, count(g.year) AS missing
              FROM generate_series({FIRST_YEAR}, {LAST_YEAR}) AS t(y) LEFT JOIN gaps g ON g.year = y GROUP BY 1)""",
    COVER,
)
def _(v: Views) -> DataFrame:
    gaps = cov.gap_matrix(v.panel, "stock_10k", FIRST_YEAR, LAST_YEAR)
    return cov.year_gap_summary(gaps, FIRST_YEAR, LAST_YEAR, 30)


@query(
    "a10_year_status",
    f"SELECT province AS entity, bool_or({has('stock_10k')}) AS filled FROM panel WHERE {s('year')} = '1998' GROUP BY 1",
)
def _(v: Views) -> DataFrame:
    return cov.year_status(v.panel, 1998, "stock_10k")


GAIN = f"""after_keys AS (SELECT DISTINCT province, year, series FROM m WHERE {has('stock_10k')}),
    before_keys AS (SELECT DISTINCT province, year, series FROM panel WHERE {has('stock_10k')})"""


def _merged_sql(where: str = "") -> str:
    return f"""w AS (SELECT coalesce(e.short_name, n.province) AS kp, n.year, n.series, arg_max(n.stock_10k, n._row) AS stock_10k
        FROM patch n LEFT JOIN ent e ON e.name = n.province GROUP BY 1, 2, 3),
      m AS (SELECT p._row, p.province, p.year, p.series, CASE WHEN {has('w.stock_10k')} THEN w.stock_10k ELSE p.stock_10k END AS stock_10k
        FROM panel p LEFT JOIN w ON w.kp = p.province AND w.year = p.year AND w.series = p.series)"""


def _merged(v: Views) -> DataFrame:
    return pan.merge_panel(v.panel, v.patch, KEYS, ["stock_10k"], entity_form="short").drop("_written")


@query(
    "u2_gained_keys",
    "SELECT province AS k_province, year AS k_year, series AS k_series FROM (SELECT k_province AS province, k_year AS year, series FROM mk "
    f"WHERE {has('stock_10k')} EXCEPT SELECT k_province, k_year, series FROM keyed WHERE {has('stock_10k')})",
    KEYED
    + ", "
    + _merged_sql()
    + ", mk AS (SELECT k.k_province, k.k_year, m.series, m.stock_10k FROM m JOIN keyed k ON k._row = m._row)",
)
def _(v: Views) -> DataFrame:
    before = cov.coverage_stats(v.panel, KEYS, ["stock_10k"]).filled_keys
    after = cov.coverage_stats(_merged(v), KEYS, ["stock_10k"]).filled_keys
    return cov.gained_keys(after, before)


# -------------------------------------------------------------------- rounds
N_GRID = 30 * len(YEARS)
ROUND = (
    KEYED
    + ", "
    + _merged_sql()
    + ", mk AS (SELECT k.k_province, k.k_year, k.province, k.year, m.stock_10k FROM m JOIN keyed k ON k._row = m._row), "
    + f"fa AS (SELECT DISTINCT k_province, k_year FROM mk WHERE {has('stock_10k')}), fb AS (SELECT DISTINCT k_province, k_year FROM keyed WHERE {has('stock_10k')}), "
    + f"grid AS ({GRID})"
)
GAPS_OF = "(SELECT count(*) FROM grid g WHERE NOT EXISTS (SELECT 1 FROM {0} c WHERE c.k_province = g.short_name AND c.k_year = cast(g.year AS string)))"


@query(
    "r1_round_metrics",
    f"""SELECT (SELECT count(*) FROM (SELECT * FROM fa EXCEPT SELECT * FROM fb)) AS gained_keys,
          {GAPS_OF.format('fb')} AS missing_before, {GAPS_OF.format('fa')} AS missing_after,
          round((SELECT count(*) FROM fb) / {N_GRID} * 100, 4) AS fill_rate_before,
          round((SELECT count(*) FROM fa) / {N_GRID} * 100, 4) AS fill_rate_after""",
    ROUND,
)
def _(v: Views) -> DataFrame:
    out = rounds.round_metrics(v.panel, _merged(v), ["province", "year"], ["stock_10k"], FIRST_YEAR, LAST_YEAR)
    return out.select(
        "gained_keys",
        "missing_before",
        "missing_after",
        *[F.round(c, 4).alias(c) for c in ("fill_rate_before", "fill_rate_after")],
    )


@query(
    "r2_stop_decision",
    """SELECT series, round, low_gain_streak, low_gain_streak >= 2 OR missing_after = 0 AS stop FROM (
         SELECT *, cast(sum(CASE WHEN gained < 1 THEN 1 ELSE 0 END) OVER (PARTITION BY series, run ORDER BY round) AS bigint) AS low_gain_streak
         FROM (SELECT *, sum(CASE WHEN gained < 1 THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY round) AS run FROM series_rounds))""",
)
def _(v: Views) -> DataFrame:
    out = rounds.stop_decision(v.series_rounds, 1, 2, ["series"])
    return out.select("series", "round", "low_gain_streak", "stop")


@query(
    "r2_totals_stopped_growing",
    "SELECT series, round, coalesce(total <= lag(total) OVER (PARTITION BY series ORDER BY round), false) AS stop FROM series_rounds",
)
def _(v: Views) -> DataFrame:
    return rounds.totals_stopped_growing(v.series_rounds, series=["series"]).select("series", "round", "stop")


@query("r3_pending_entities", "SELECT entity FROM targets WHERE entity NOT IN (SELECT entity FROM progress WHERE finished)")
def _(v: Views) -> DataFrame:
    return rounds.pending_entities(v.targets, v.progress)


R4 = (
    KEYED
    + ", "
    + _merged_sql()
    + ", mk AS (SELECT k.k_province, k.k_year, m.series, m.stock_10k FROM m JOIN keyed k ON k._row = m._row), "
    + f"fa AS (SELECT DISTINCT k_province, k_year, series FROM mk WHERE {has('stock_10k')}), "
    + f"fb AS (SELECT DISTINCT k_province, k_year, series FROM keyed WHERE {has('stock_10k')})"
)


def _rounds(v: Views, **more) -> rounds.RoundRun:
    return rounds.run_rounds(v.panel, [v.patch] * 3, ["stock_10k"], FIRST_YEAR, LAST_YEAR, KEYS, **more)


@query(
    "r4_run_rounds",
    "SELECT gained, 'low gain' AS stopped FROM (SELECT count(*) AS gained FROM (SELECT * FROM fa EXCEPT SELECT * FROM fb))",
    R4,
)
def _(v: Views) -> DataFrame:
    """What the stored panel gained in all rounds, and why the loop ended."""
    run = _rounds(v, entity_form="short")
    before = cov.coverage_stats(v.panel, KEYS, ["stock_10k"]).filled_keys
    gained = cov.gained_keys(cov.coverage_stats(run.panel, KEYS, ["stock_10k"]).filled_keys, before)
    why = F.lit("low gain" if "low-gain" in run.stopped else run.stopped)
    return gained.agg(F.count(F.lit(1)).alias("gained")).withColumn("stopped", why)


@query("r4_final_panel", "SELECT _row, province, year, series, stock_10k FROM m", KEYED + ", " + _merged_sql())
def _(v: Views) -> DataFrame:
    return _rounds(v, entity_form="short").panel.select("_row", "province", "year", "series", "stock_10k")


@query("r4_fill_only", "SELECT _row, CASE WHEN empty AND ref <> '' THEN ref ELSE stock_10k END AS stock_10k FROM r4f", f"""
    r4r AS (SELECT {s('province')} AS p, {s('year')} AS y, {s('series')} AS se, arg_max({s('stock_10k')}, _row) AS ref FROM patch GROUP BY 1, 2, 3),
    r4f AS (SELECT p._row, p.stock_10k, NOT {has('p.stock_10k')} AS empty, coalesce(r.ref, '') AS ref FROM panel p
      LEFT JOIN r4r r ON r.p = {s('p.province')} AND r.y = {s('p.year')} AND r.se = {s('p.series')})""")
def _(v: Views) -> DataFrame:
    return _rounds(v, fill_only=True).panel.select("_row", "stock_10k")


@query("r4_stops_on_failure", "SELECT 'checks failed' AS stopped, count(*) AS n_rows FROM panel")
def _(v: Views) -> DataFrame:
    run = _rounds(v, entity_form="short", registry=v.registry, variable="stock_10k")
    return run.panel.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("stopped", F.lit(run.stopped))
