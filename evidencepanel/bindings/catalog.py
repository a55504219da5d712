"""Every registered query with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from evidencepanel.bindings.views import Views, check_sql

Build = Callable[[Views], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, extra: str = "") -> Callable[[Build], Build]:
    """Registers a query; ``sql`` names views, ``extra`` adds table expressions to it."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, check_sql(sql, extra) if sql else None)
        return build

    return add


# ------------------------------------------------------- pieces of check SQL
SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def s(x: str) -> str:
    """The stripped cell."""
    return f"trim(coalesce({x}, ''), ' 　')"


def has(x: str) -> str:
    return f"({s(x)} <> '')"


def year(x: str = "year") -> str:
    """Whole-number year or null."""
    return f"CASE WHEN regexp_matches({s(x)}, '^[-+]?[0-9]+$') THEN cast({s(x)} AS int) END"


def number(x: str) -> str:
    pattern = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({s(x)}, '{pattern}') THEN cast({s(x)} AS double) END"


def host(x: str) -> str:
    return rf"lower(regexp_extract({s(x)}, '(?i)^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#:@\[\]]+)', 1))"


def any_in(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def points(*pairs: tuple[str, int]) -> str:
    return "(" + " + ".join(f"CASE WHEN {t} THEN {p} ELSE 0 END" for t, p in pairs) + ")"


NAMES = "names AS (SELECT province AS name FROM panel UNION SELECT " + s("province") + " FROM panel UNION SELECT province FROM patch)"
ENT = (
    NAMES
    + """, ent AS (SELECT name, arg_min(short_name, prio) AS short_name, arg_min(full_name, prio) AS full_name,
    arg_min(code, prio) AS code FROM (SELECT name, d.*, CASE WHEN name = full_name THEN -3 WHEN name = d.code THEN -2
      WHEN name = short_name THEN -1 ELSE ordinal END AS prio FROM names JOIN dim d
      ON name = full_name OR name = d.code OR name = short_name OR starts_with(name, short_name)) GROUP BY name)"""
)
KEYED = (
    ENT
    + f""", keyed AS (SELECT p.*, CASE WHEN {s('province')} = '' THEN '' ELSE coalesce(e.short_name, {s('province')}) END AS k_province,
    CASE WHEN regexp_matches({s('year')}, '^[0-9]+$') THEN regexp_replace({s('year')}, '^0+(.)', '\\1') ELSE {s('year')} END AS k_year
    FROM panel p LEFT JOIN ent e ON e.name = {s('p.province')})"""
)


def matched(reg: str = "registry", rows: str = "panel") -> str:
    return f"""reg AS (SELECT * FROM {reg}),
  by_id AS (SELECT {s('source_id')} AS sid, arg_min(_row, _row) AS rid FROM reg WHERE {has('source_id')} GROUP BY 1),
  by_tuple AS (SELECT {s('source_level')} AS tl, {s('source_name')} AS tn, {s('source_url')} AS tu, min(_row) AS rid FROM reg
    WHERE {has('source_level')} OR {has('source_name')} OR {has('source_url')} GROUP BY 1, 2, 3),
  hits AS (SELECT p.*, CASE WHEN i.rid IS NOT NULL THEN 'source_id' WHEN t.rid IS NOT NULL THEN 'source_tuple'
      ELSE 'unmatched' END AS match_mode, coalesce(i.rid, t.rid) AS rid
    FROM {rows} p LEFT JOIN by_id i ON {s('p.source_id')} = i.sid
    LEFT JOIN by_tuple t ON {s('p.source_level')} = tl AND {s('p.source_name')} = tn AND {s('p.source_url')} = tu),
  resolved AS (SELECT h.*, r.note AS reg_note, r.cross_check_url AS reg_cross,
      coalesce(nullif({s('h.source_id')}, ''), {s('r.source_id')}) AS r_id,
      coalesce(nullif({s('h.source_level')}, ''), {s('r.source_level')}) AS r_level,
      coalesce(nullif({s('h.source_name')}, ''), {s('r.source_name')}) AS r_name,
      coalesce(nullif({s('h.source_url')}, ''), {s('r.source_url')}) AS r_url
    FROM hits h LEFT JOIN reg r ON r._row = h.rid)"""


def names_other(x: str, own: str) -> str:
    from evidencepanel.functions.entity import PROVINCES

    return "(" + " OR ".join(f"({own} <> '{n}' AND contains({x}, '{n}'))" for n in PROVINCES.names("short")) + ")"
