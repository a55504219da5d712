"""Routing of wanted variables to the kind of source that can serve them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.functions.text import contains_any, strip

# Route keyword groups, in the order they are tried.
ROUTES: dict[str, tuple[str, ...]] = {
    "api": ("api", "akshare", "nbs", "stats.gov", "数据库", "接口", "json"),
    "doc_or_table": ("excel", "xlsx", "csv", "pdf", "年鉴", "公报", "ceads", "报告", "附件"),
    "dynamic_web": ("动态", "js", "javascript", "分页", "搜索", "官网", "公告", "详情页", "爬取"),
    "local_docs": ("local", "本地", "file", "文档", "docx", "ppt", "txt"),
}
OTHER_ROUTE = "web_search"
EXECUTORS: dict[str, tuple[str, ...]] = {
    "api_executor": ("api",),
    "browser_executor": ("dynamic_web", "web_search"),
    "doc_executor": ("doc_or_table", "local_docs"),
}


def classify_route(
    df: DataFrame,
    columns: Sequence[str] = ("name", "name_cn", "source_hint", "note"),
    routes: Mapping[str, Sequence[str]] = ROUTES,
) -> DataFrame:
    """Adds ``route``: the first keyword group found in the lower-cased text."""
    text = F.lower(F.concat_ws(" ", *[strip(c) for c in columns]))
    route = F.lit(OTHER_ROUTE)
    for name, words in reversed(list(routes.items())):
        route = F.when(contains_any(text, words), F.lit(name)).otherwise(route)
    return df.withColumn("route", route)


def route_summary(routed: DataFrame) -> DataFrame:
    """Variables per executor: its routes, how many variables, whether it runs.

    Routes are folded to at most one row each before the executors are formed.
    """
    counts = routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("route").isin(*routes), F.col("n"))), F.lit(0)).alias(name)
        for name, routes in EXECUTORS.items()
    ]
    rows = [
        F.struct(
            F.lit(name).alias("executor"),
            F.lit(",".join(routes)).alias("routes"),
            F.col(name).alias("n_variables"),
            (F.col(name) > 0).alias("enabled"),
        )
        for name, routes in EXECUTORS.items()
    ]
    return counts.agg(*sums).select(F.inline(F.array(*rows)))
