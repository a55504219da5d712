"""Readers: panels, discovery documents, address lists, cubes, sector tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidencepanel.functions.entity import ENGLISH_NAMES, alias_to_entity
from evidencepanel.functions.text import is_http, strip, to_int, to_number
from evidencepanel.operators.groups import ROW, keep_last, key_hash, need, same_key
from evidencepanel.plans.session import written_once


def read_panel(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """CSV with a header: all text, byte-order mark dropped, empty cells ``""``.

    Adds ``_row``, the 1-based data row, in file-name order over several files.
    Big files are split and numbered per split, so no task reads a whole file.
    ``multi_line=True`` is for cells that hold line breaks; each file is then one task.
    The files are scanned once: rows and their places are written below the shared
    folder, and counted and numbered from there.
    """
    table = spark.read.csv(
        path if isinstance(path, str) else list(path),
        header=True,
        multiLine=multi_line,
        quote='"',
        escape='"',
        inferSchema=False,
        enforceSchema=False,
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    cols = table.columns
    placed = table.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in cols],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    placed = written_once(placed, "csv-rows")
    # One row per file split: first id, size, and the rows of all splits before.
    splits = placed.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        F.col("_file").alias("_f"),
        F.col("_block").alias("_b"),
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    numbered = placed.join(splits, same_key([(placed["_file"], splits["_f"]), (placed["_block"], splits["_b"])]))
    row = (F.col("_id") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    return numbered.select(*cols, row.alias(ROW))


DISCOVERY_RECORD = (
    "struct<finished:boolean,url_count:bigint,candidate_count:bigint,selected_urls:array<string>,"
    "selected_url_meta:array<struct<url:string,search_score:bigint,engine:string,query:string,title:string>>,"
    "top_candidates:array<struct<url:string,sentence:string,value_raw:double,unit:string,value_10k:double,"
    "value_10k_person:double,score:bigint,search_score:bigint,explicit_province_in_sentence:boolean,"
    "search_engine:string,search_query:string>>>"
)


def parse_discovery(documents: DataFrame, json_col: str = "value", order: str = "doc_no") -> DataFrame:
    """Entity records of discovery documents: one row per (document, entity)."""
    need(documents, json_col, order)
    parsed = documents.select(order, F.from_json(F.col(json_col), f"map<string,{DISCOVERY_RECORD}>").alias("_m"))
    rows = parsed.select(order, F.posexplode(F.map_entries("_m")).alias("entity_no", "_e"))
    return rows.select(order, "entity_no", F.col("_e.key").alias("entity"), F.col("_e.value").alias("record")).where(
        F.col("record").isNotNull()
    )


def discovery_summary(records: DataFrame) -> DataFrame:
    """Finished flag and counts per entity record."""
    return records.select(
        "entity",
        F.coalesce("record.finished", F.lit(False)).alias("finished"),
        F.coalesce("record.url_count", F.lit(0)).alias("url_count"),
        F.coalesce("record.candidate_count", F.lit(0)).alias("candidate_count"),
    )


def discovery_urls(records: DataFrame, order: str = "doc_no") -> DataFrame:
    """http(s) addresses: per entity the selected ones, then those of candidates.

    ``ord`` is (document, entity, kind, place), which sorts as the text reads.
    """
    empty = F.array().cast("array<string>")
    listed = F.array(
        F.struct(F.lit("selected").alias("kind"), F.coalesce("record.selected_urls", empty).alias("urls")),
        F.struct(F.lit("candidate").alias("kind"), F.coalesce("record.top_candidates.url", empty).alias("urls")),
    )
    kinds = records.select(order, "entity_no", "entity", F.posexplode(listed).alias("_k", "_l"))
    rows = kinds.select(
        order, "entity_no", "entity", "_k", F.col("_l.kind").alias("kind"), F.posexplode("_l.urls").alias("_p", "_u")
    )
    place = F.struct(F.col(order).alias("doc"), F.col("entity_no").alias("entity_no"), "_k", "_p")
    return rows.where(is_http("_u")).select("entity", "kind", strip("_u").alias("url"), place.alias("ord"))


def discovery_candidates(records: DataFrame, order: str = "doc_no") -> DataFrame:
    """Candidates of the records, one per row, with their place as ``ord``."""
    rows = records.select(order, "entity_no", "entity", F.posexplode("record.top_candidates").alias("_p", "_c"))
    return rows.select(order, "entity_no", "entity", F.col("_p").alias("ord"), "_c.*")


def read_discovery(spark: SparkSession, path: str) -> DataFrame:
    """Discovery documents from files, one document per file, as entity records."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("doc_no"))
    return parse_discovery(files)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Addresses from text lines; blanks, ``#`` comments and other schemes go."""
    lines = spark.read.text(path).select(strip("value").alias("url"), F.monotonically_increasing_id().alias("ord"))
    return lines.where(~F.col("url").startswith("#") & is_http("url")).select("ord", "url")


CUBE_SCHEMA = (
    "struct<returndata:struct<"
    "wdnodes:array<struct<wdcode:string,nodes:array<struct<code:string,cname:string,name:string,unit:string>>>>,"
    "datanodes:array<struct<data:struct<data:double,hasdata:boolean>,"
    "wds:array<struct<wdcode:string,valuecode:string>>>>>>"
)


def _node_names(nodes: Column) -> Column:
    entries = F.transform(nodes, lambda n: F.struct(n["code"], F.coalesce(n["cname"], n["name"], F.lit(""))))
    return F.map_from_entries(entries)


def flatten_cube(
    cubes: DataFrame,
    value_col: str,
    entities: Sequence[str] | None,
    first_year: int,
    last_year: int,
    json_col: str = "value",
    order: str = "doc_no",
) -> DataFrame:
    """Statistics cubes to (entity, year, value), the last cell of a key kept.

    Region codes become names by the cube's own node list; cells of unknown
    regions, unwanted entities, bad or unwanted years go; a cell without data
    gives null.
    """
    need(cubes, json_col, order)
    parsed = cubes.select(order, F.from_json(F.col(json_col), CUBE_SCHEMA)["returndata"].alias("_d"))
    dims = F.filter(F.col("_d.wdnodes"), lambda w: w["wdcode"] == F.lit("reg"))
    parsed = parsed.select(order, _node_names(F.get(dims, 0)["nodes"]).alias("_names"), "_d.datanodes")
    cells = parsed.select(order, "_names", F.posexplode("datanodes").alias("_p", "_n"))
    keys = F.map_from_entries(F.transform("_n.wds", lambda w: F.struct(w["wdcode"], w["valuecode"])))
    cells = cells.select(order, "_p", "_names", "_n.data", keys.alias("_k"))
    entity = F.element_at(F.col("_names"), F.element_at(F.col("_k"), "reg"))
    year = to_int(F.element_at(F.col("_k"), "sj"))
    rows = cells.select(
        entity.alias("province"),
        year.alias("year"),
        F.when(F.coalesce("data.hasdata", F.lit(False)), F.col("data.data")).alias(value_col),
        F.struct(order, "_p").alias(ROW),
    )
    rows = rows.where(F.col("province").isNotNull() & F.col("year").between(first_year, last_year))
    if entities is not None:
        rows = rows.where(F.col("province").isin(list(entities)))
    return keep_last(rows, ["province", "year"]).drop(ROW)


# The sought sector, from the exact phrase to the loosest word.
SECTOR_TIERS = (
    r"(?i)\ATransportation,\s*Storage,\s*Post\s*and\s*Telecommunication\s*Services\z",
    r"(?i)Transportation,\s*Storage,\s*Post",
    r"(?i)Transport",
)
UNIT_CHANGE = 100


def extract_sector_rows(cells: DataFrame, names: Mapping[str, str] | DataFrame = ENGLISH_NAMES) -> DataFrame:
    """One row per (file, sheet) of long sector tables: the first best-tier label.

    ``cells`` holds source_file, sheet, row_no, label, scope_1_total.  Sheets
    are ``Name20YY``; the year comes from the file name.  A sheet without the
    sector gives a null value.
    """
    need(cells, "source_file", "sheet", "row_no", "label", "scope_1_total")
    label = strip("label")
    exact, phrase, word = SECTOR_TIERS
    # Most labels miss the loosest word, which the other two contain.
    tier = F.when(~label.rlike(word), len(SECTOR_TIERS)).when(label.rlike(exact), 0).when(label.rlike(phrase), 1)
    rows = cells.select(
        "source_file",
        "sheet",
        F.struct(tier.otherwise(2).alias("tier"), "row_no").alias("_place"),
        F.struct("label", F.col("scope_1_total").cast("string").alias("total")).alias("_cell"),
    )
    picked = rows.groupBy(key_hash(["source_file", "sheet"]), "source_file", "sheet").agg(
        F.min_by("_cell", "_place").alias("b"), F.min("_place").alias("_place")
    )
    year = F.regexp_extract("source_file", r"(20\d{2})", 1).try_cast("int")
    named = F.regexp_extract("sheet", r"\A([A-Za-z]+)20\d{2}\z", 1)
    picked = picked.withColumns({"year": year, "_alias": named})
    picked = picked.where(F.col("year").isNotNull() & (F.col("_alias") != ""))
    found = F.col("_place.tier") < len(SECTOR_TIERS)
    picked = alias_to_entity(picked, "_alias", names)
    value = F.when(found, to_number("b.total"))
    return picked.select(
        "province",
        "year",
        value.alias("transport_co2_mt"),
        "source_file",
        "sheet",
        F.when(found, F.col("b.label")).otherwise(F.lit("")).alias("sector_label"),
        (value * UNIT_CHANGE).alias("transport_co2_10k_ton_direct"),
    )
