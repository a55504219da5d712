"""Panels, registries, result lists and texts derived from the given tables.

Each view is one SQL text in the dialect both engines share, so the operator
under test and its check start from the same rows.  Every view grows with the
tables: panels have a row per customer and year, registries one per supplier,
result lists one per event, sector cells one per line item.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from evidencepanel.functions.entity import ENGLISH_NAMES, PROVINCES

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "pages",
)
FIRST_YEAR, LAST_YEAR = 1994, 2001
SOURCE_YEAR = 1999


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(c) if isinstance(c, int) else f"'{c}'" for c in r) + ")" for r in rows)


_LEVEL = "CASE {0} % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END"
_NAME = "'统计公报来源' || cast({0} as string)"
_URL = (
    "CASE {0} % 3 WHEN 0 THEN 'https://tjj.s' || cast({0} as string) || '.gov.cn/tjgb/' || cast({0} as string) "
    "WHEN 1 THEN 'http://News.Sohu.com/a/' || cast({0} as string) "
    "ELSE 'https://user@www.s' || cast({0} as string) || '.gov.cn:8080/x?u=a@b' END"
)
_SID = "'SRC_' || lpad(cast({0} as string), 7, '0')"

# Base table names are written {orders}; other views are plain names.
VIEWS: dict[str, str] = {
    "dim": f"""
        SELECT * FROM (VALUES {_values([(i, *e) for i, e in enumerate(PROVINCES.entities)])})
        AS t(ordinal, short_name, full_name, code)""",
    "eng": f"""
        SELECT * FROM (VALUES {_values([(v, k) for k, v in ENGLISH_NAMES.items()])}) AS t(full_name, eng_name)""",
    "cy": """
        SELECT o_custkey AS ck, cast(extract(year FROM o_orderdate) AS int) AS yr,
               sum(cast(round(o_totalprice * 100) AS bigint)) AS cents, count(*) AS n
        FROM {orders} GROUP BY o_custkey, cast(extract(year FROM o_orderdate) AS int)""",
    # whole: the amount in whole units; frac: two digits; sk: the source; a third of all rows share source 1
    "base": """
        SELECT cy.ck * 16 + (cy.yr - 1990) AS _row, cy.ck, cy.yr, cy.n, cy.cents,
               cast(floor(cy.cents / 100000) AS bigint) AS whole, cy.cents % 100 AS frac,
               CASE WHEN cy.ck % 3 = 0 THEN 1 ELSE cast(floor(cy.ck / 15) AS bigint) END AS sk,
               d.ordinal, d.short_name, d.full_name, d.code
        FROM cy JOIN {customer} ON c_custkey = cy.ck JOIN dim d ON d.ordinal = c_nationkey""",
    "panel": f"""
        SELECT _row,
          CASE (ck + yr) % 13 WHEN 0 THEN full_name WHEN 1 THEN code WHEN 2 THEN full_name || '某区'
            WHEN 3 THEN '　' || short_name WHEN 4 THEN CASE WHEN ck % 3 = 0 THEN '火星省' ELSE short_name END
            WHEN 5 THEN CASE WHEN ck % 5 = 0 THEN '' ELSE short_name END ELSE short_name END AS province,
          CASE ck % 17 WHEN 0 THEN '0' || cast(yr AS string) WHEN 1 THEN ' ' || cast(yr AS string) || ' '
            WHEN 2 THEN CASE WHEN n = 1 THEN 'n/a' ELSE cast(yr AS string) END ELSE cast(yr AS string) END AS year,
          cast(ck - CASE WHEN ck % 10 = 9 THEN 1 ELSE 0 END AS string) AS series,
          CASE WHEN (ck + yr) % 6 = 0 THEN CASE WHEN ck % 2 = 0 THEN '' ELSE ' 　' END
            WHEN ck % 19 = 2 THEN cast(whole AS string) || '万台' WHEN ck % 19 = 3 THEN cast(whole AS string) || '辆'
            WHEN ck % 19 = 4 THEN cast(whole AS string) || ' 台' WHEN ck % 29 = 5 THEN 'abc'
            WHEN ck % 31 = 6 THEN '-' || cast(whole AS string)
            ELSE cast(whole AS string) || '.' || lpad(cast(frac AS string), 2, '0') END AS stock_10k,
          CASE WHEN ck % 4 = 1 THEN '' ELSE cast(n AS string) END AS aux_value,
          CASE ck % 7 WHEN 0 THEN '' WHEN 2 THEN 'SRC_X' || cast(ck % 50 AS string)
            WHEN 6 THEN ' ' || {_SID.format('sk')} || ' ' ELSE {_SID.format('sk')} END AS source_id,
          CASE ck % 7 WHEN 1 THEN '' WHEN 2 THEN 'D' ELSE {_LEVEL.format('sk')} END AS source_level,
          CASE ck % 7 WHEN 1 THEN '' WHEN 2 THEN 'Unknown' ELSE {_NAME.format('sk')} END AS source_name,
          CASE ck % 7 WHEN 1 THEN ' ' WHEN 2 THEN 'http://nowhere.example' ELSE {_URL.format('sk')} END AS source_url,
          CASE WHEN ck % 11 = 0 THEN 'https://x.example/' || cast(ck AS string) ELSE '' END AS cross_check_url,
          CASE WHEN ck % 9 = 0 THEN '' ELSE '2024-0' || cast(1 + ck % 9 AS string) || '-15' END AS access_date,
          'n' || cast(ck % 3 AS string) AS note
        FROM base""",
    "registry": f"""
        SELECT s_suppkey + 1 AS _row, CASE WHEN s_suppkey % 13 = 5 THEN '' WHEN s_suppkey % 11 = 7 THEN 'SRC_N' || cast(s_suppkey AS string) ELSE {_SID.format('s_suppkey')} END AS source_id,
          CASE WHEN s_suppkey % 5 = 4 THEN 'other' ELSE 'stock_10k' END AS variable,
          {_LEVEL.format('s_suppkey')} AS source_level,
          CASE WHEN s_suppkey % 11 = 7 THEN 'unused' ELSE '' END || {_NAME.format('s_suppkey')} AS source_name,
          {_URL.format('s_suppkey')} AS source_url,
          CASE WHEN s_suppkey % 8 = 2 THEN 'https://check.example/' || cast(s_suppkey AS string) ELSE '' END AS cross_check_url,
          '2024-01-01' AS publish_date, '2024-02-02' AS access_date, 'f.csv' AS evidence_file, '1' AS is_primary,
          'first' AS note
        FROM {{supplier}}
        UNION ALL
        SELECT s_suppkey + 1000000001 AS _row, {_SID.format('s_suppkey')} AS source_id, 'stock_10k' AS variable,
          'B' AS source_level, 'second' || cast(s_suppkey AS string) AS source_name, 'http://b.example/' AS source_url,
          'https://again.example' AS cross_check_url, '' AS publish_date, '' AS access_date, '' AS evidence_file,
          '0' AS is_primary, 'second' AS note
        FROM {{supplier}} WHERE s_suppkey % 6 = 0""",
    "shipped": """
        SELECT o_custkey AS ck, cast(extract(year FROM o_orderdate) AS int) AS yr,
               sum(cast(round(l_quantity) AS bigint)) AS qty, count(*) AS n
        FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
        GROUP BY o_custkey, cast(extract(year FROM o_orderdate) AS int)""",
    "patch": """
        SELECT p.ck * 64 + (p.yr - 1990) * 4 + dup AS _row,
          CASE p.ck % 3 WHEN 0 THEN d.full_name WHEN 1 THEN d.short_name ELSE d.code END AS province,
          cast(p.yr AS string) AS year,
          CASE WHEN p.ck % 5 = 3 THEN 'P' ELSE '' END || cast(p.ck - CASE WHEN p.ck % 10 = 9 THEN 1 ELSE 0 END AS string) AS series,
          CASE WHEN (p.ck + p.yr + dup) % 5 = 0 THEN ' ' ELSE cast(p.qty + dup AS string) END AS stock_10k,
          CASE WHEN (p.ck + dup) % 4 = 0 THEN '' ELSE cast(p.n AS string) END AS aux_value,
          'SRC_P' || cast(p.ck % 40 AS string) AS source_id, 'A' AS source_level, '补录' AS source_name,
          'https://patch.example/' || cast(p.ck % 40 AS string) AS source_url, '2024-06-01' AS access_date
        FROM (SELECT *, 0 AS dup FROM shipped UNION ALL SELECT *, 1 AS dup FROM shipped WHERE ck % 4 = 0) p
          JOIN {customer} ON c_custkey = p.ck JOIN dim d ON d.ordinal = c_nationkey""",
    "results": """
        SELECT event_id AS ord, d.full_name AS entity, 'q' || cast(user_id % 37 AS string) AS query,
          CASE event_type WHEN 'view' THEN 'google' WHEN 'click' THEN 'tavily' WHEN 'signup' THEN 'bing'
            WHEN 'purchase' THEN 'sogou' ELSE '360' END AS engine,
          CASE WHEN event_id % 23 = 0 THEN ' ' ELSE
            CASE WHEN event_id % 3 = 0 THEN 'https://tjj.hub.gov.cn/a/' ELSE CASE event_id % 7
              WHEN 0 THEN 'http://www.jl.gov.cn/' WHEN 1 THEN 'https://Mp.weixin.qq.com/s/' WHEN 2 THEN 'https://stats.example.org:81/'
              WHEN 3 THEN 'ftp://files.example.org/' WHEN 4 THEN 'http://u:p@ga.example.cn/' WHEN 5 THEN 'https://xinjiang.example/'
              ELSE 'no host ' END END || cast(event_id % 211 AS string) END AS url,
          CASE WHEN event_id % 5 = 0 THEN d.short_name || '新能源汽车保有量' WHEN event_id % 5 = 1 THEN '统计公报 常住人口'
            ELSE '新闻' || cast(event_id % 100 AS string) END AS title,
          CASE event_id % 6 WHEN 0 THEN '1999年 政府 公报' WHEN 1 THEN '全国 公安' WHEN 2 THEN '全市 国民经济和社会发展'
            WHEN 3 THEN '' ELSE cast(event_id AS string) || '统计局' END AS snippet
        FROM {events} JOIN dim d ON d.ordinal = user_id % 30""",
    "bulletins": """
        SELECT _row AS ord, full_name AS entity, yr,
          CASE ck % 5 WHEN 0 THEN 'https://tjj.x.gov.cn/' WHEN 1 THEN 'http://www.jilin.example/' WHEN 2 THEN 'https://www.neimenggu.gov.cn/'
            WHEN 3 THEN 'http://xj.gov.cn/' ELSE 'https://news.example/' END || cast(_row AS string) AS url,
          '工作报告' || cast(ck AS string) || '。 本文如下！' ||
          CASE (ck + yr) % 8
            WHEN 0 THEN '截至' || cast(yr AS string) || '年底，' || full_name || '新能源汽车保有量达到'
              || cast(whole AS string) || '.' || cast(frac AS string) || '万辆。'
            WHEN 1 THEN cast(yr AS string) || '年末，全省新能源汽车保有量为 ' || cast(cents AS string) || ' 辆；同比增长。'
            WHEN 2 THEN '全国新能源汽车保有量' || cast(whole AS string) || '万辆。'
            WHEN 3 THEN short_name || '电动汽车的社会保有量约为' || cast(whole AS string) || '万辆！'
            WHEN 4 THEN '截至11月底，全市新能源车保有量突破' || cast(whole AS string) || '万辆，其中北京较高。'
            WHEN 5 THEN short_name || '机动车保有量较高。'
            WHEN 6 THEN '我区新能源汽车保有量' || cast(whole AS string) || '万辆。'
            ELSE '全国及' || short_name || '新能源汽车保有量稳步提升，达' || cast(whole AS string) || '万辆。' END ||
          CASE (ck + 3 * yr) % 5
            WHEN 0 THEN cast(yr AS string) || '年末全省常住人口' || cast(whole AS string) || '.5万人。'
            WHEN 1 THEN '统计公报：' || full_name || '常住人口总量达 ' || cast(whole AS string) || '万人，增长。'
            WHEN 2 THEN '全国常住人口' || cast(whole AS string) || '万人。'
            WHEN 3 THEN '据' || short_name || '和河南的常住人口约计' || cast(whole AS string) || '万人。' ELSE '完。' END AS text
        FROM base""",
    "cells": """
        SELECT 'inventory_' || cast(20 + cast(extract(year FROM o_orderdate) AS int) AS string) || '_' || cast(o_custkey AS string)
            || '.xlsx' AS source_file,
          CASE WHEN o_custkey % 23 = 0 THEN 'NOTE' WHEN o_custkey % 23 = 1 THEN 'Nowhere2015' ELSE
            eng_name || cast(20 + cast(extract(year FROM o_orderdate) AS int) AS string) END AS sheet,
          (l_orderkey * 8 + l_linenumber) * 1000000
            + (l_partkey * 31 + cast(round(l_extendedprice * 100) AS bigint)) % 1000000 AS row_no,
          CASE WHEN l_partkey % 11 = 0 THEN ' Transportation, Storage,Post and Telecommunication Services '
            WHEN l_partkey % 11 = 1 THEN 'transportation, storage, post (all)' WHEN l_partkey % 11 = 2 THEN 'Road Transport'
            ELSE 'Sector ' || cast(l_partkey % 11 AS string) END AS label,
          CASE WHEN l_partkey % 4 = 3 THEN '-' ELSE cast(cast(round(l_quantity) AS bigint) AS string) || '.5' END AS scope_1_total
        FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey JOIN {customer} ON c_custkey = o_custkey
          JOIN dim d ON d.ordinal = c_nationkey JOIN eng e ON e.full_name = d.full_name""",
    "economy": """
        SELECT full_name AS province, yr AS year, ck,
          CASE WHEN ck % 9 = 1 THEN NULL ELSE cast(cents AS double) / 100 END AS gdp_100m_cny,
          cast(whole % 7 AS double) AS resident_population_10k_person,
          cast(n AS double) AS urban_population_10k_person,
          cast(whole AS double) AS tertiary_value_added_100m_cny,
          CASE WHEN ck % 3 = 0 THEN NULL ELSE cast(whole AS double) END AS gasoline_consumption_10k_ton,
          CASE WHEN ck % 6 = 0 THEN NULL ELSE cast(n AS double) END AS gasoline_consumption_10k_ton_filled,
          CASE WHEN ck % 5 = 0 THEN NULL ELSE cast(frac AS double) END AS diesel_consumption_10k_ton
        FROM base""",
    "wanted": """
        SELECT p_partkey, 'v' || cast(p_partkey AS string) AS name, p_name AS name_cn,
          CASE p_partkey % 13 WHEN 0 THEN 'NBS 数据库' WHEN 1 THEN '年鉴 PDF' WHEN 2 THEN '官网公告' WHEN 3 THEN '本地文档'
            WHEN 4 THEN 'stats.gov.cn' WHEN 5 THEN 'Excel 附件' WHEN 6 THEN 'JavaScript 分页' WHEN 7 THEN 'stats-gov' ELSE p_type END
            AS source_hint,
          p_brand AS note
        FROM {part}""",
    "series_rounds": """
        SELECT ck AS series, yr AS round, n % 3 AS gained,
          CASE WHEN frac < 5 THEN 0 ELSE frac END AS missing_after, whole AS total
        FROM base""",
    "targets": """
        SELECT DISTINCT 'U' || cast(user_id AS string) AS entity FROM {events}""",
    "progress": """
        SELECT CASE WHEN user_id % 3 = 0 THEN 'X' ELSE 'U' END || cast(user_id AS string) AS entity, event_type = 'purchase' AS finished
        FROM {events}""",
}


def depends_on(text: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN) {v}\b", text)]


def needed_views(text: str) -> list[str]:
    """Views a text needs, in the order of their definition."""
    seen: set[str] = set()
    todo = depends_on(text)
    while todo:
        name = todo.pop()
        if name not in seen:
            seen.add(name)
            todo += depends_on(VIEWS[name])
    return [v for v in VIEWS if v in seen]


def with_views(query: str, extra: str = "") -> str:
    """The query with the views it needs as common table expressions."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in needed_views(query + extra)]
    parts += [extra] if extra else []
    return (f"WITH {', '.join(parts)} " if parts else "") + query


def check_sql(query: str, extra: str = "") -> str:
    """The same for the checking engine, where base tables are plain views."""
    text = with_views(query, extra)
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


class Views:
    """Tables and views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, query: str) -> DataFrame:
        text = with_views(query)
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        return self.sql(f"SELECT * FROM {name}")
