"""Inputs of the registered queries: SQL over the driver's tables that Spark and DuckDB both run.

The tables are generic, so every operator's input is derived from them by the
same text in both engines. Table names stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from entrygraph.plans.staging import dealt

INPUTS = {
    "surfaces": """
        SELECT p_partkey AS k,
          CASE p_partkey % 8
            WHEN 0 THEN upper(p_name) || ', ' || CAST(p_size * 40 + 800 AS STRING) || ' m'
            WHEN 1 THEN replace(p_name, 'blue', 'Höllen') || ' (' || CAST(p_size * 40 + 800 AS STRING) || ' m)'
            WHEN 2 THEN 'Bergstation der ' || replace(p_name, ' ', '') || 'bahn'
            WHEN 3 THEN replace(p_name, ' ', '') || 'bahn Talstation'
            WHEN 4 THEN 'Große ' || p_name
            WHEN 5 THEN replace(p_name, ' ', '-')
            WHEN 6 THEN substr(p_name, 1, length(p_name) - 1)
            ELSE p_name END AS surface,
          CASE p_partkey % 6 WHEN 0 THEN 'peak' WHEN 1 THEN 'pass' WHEN 2 THEN 'hut' WHEN 3 THEN 'settlement' WHEN 4 THEN 'locality' END AS type,
          p_size
        FROM {part}""",
    "gazetteer": """
        SELECT replace(p_name, 'blue', 'Höllen') || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' || p_type ELSE ' ' || p_brand END AS name,
          CASE p_partkey % 5 WHEN 0 THEN 'peak' WHEN 1 THEN 'ridge' WHEN 2 THEN 'hut' WHEN 3 THEN 'settlement' ELSE 'path' END AS type,
          47.0 + CAST(p_partkey % 1000 AS DOUBLE) / 1000.0 AS lat, 11.0 + CAST(p_partkey % 777 AS DOUBLE) / 1000.0 AS lon,
          CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size * 40 + 780 AS DOUBLE) END AS ele,
          CASE p_partkey % 3 WHEN 0 THEN 'node/' WHEN 1 THEN 'way/' ELSE 'relation/' END || CAST(p_partkey AS STRING) AS osm
        FROM {part}""",
    "items": """
        SELECT k AS item_id, k AS seq, 'R' || CAST(k - k % 3 AS STRING) AS entry_id, CASE WHEN k % 3 = 0 THEN 'place' ELSE 'mention' END AS kind,
          surface, surface AS name, type, CASE WHEN k % 5 = 0 THEN CAST(p_size * 40 + 800 AS DOUBLE) END AS elevation_m
        FROM ({surfaces}) s""",
    "raw_ids": """
        SELECT CAST((o_orderkey - o_orderkey % 400) / 400 AS BIGINT) AS guide_id, o_orderkey AS seq, CAST((o_orderkey - o_orderkey % 20) / 20 AS INT) AS page, CAST(o_orderkey % 20 + 1 AS INT) AS position,
          CASE WHEN o_orderkey % 7 IN (3, 4) OR o_orderkey % 29 = 0 THEN NULL
            WHEN o_orderkey % 11 = 0 THEN 'R ' || CAST(o_orderkey % 400 - 11 + 1 AS STRING)
            WHEN o_orderkey % 13 = 0 THEN '• ' || CAST(o_orderkey % 400 + 1 AS STRING) || ' a'
            WHEN o_orderkey % 17 = 0 THEN '00' || CAST(o_orderkey % 400 + 1 AS STRING) || ' am Grat'
            ELSE CAST(o_orderkey % 400 + 1 AS STRING) END AS raw_id
        FROM {orders}""",
    "numbers": """
        SELECT CAST((o_orderkey - o_orderkey % 300) / 300 AS BIGINT) AS guide_id, o_orderkey AS seq,
          CASE WHEN o_custkey % 4 = 0 OR o_orderkey % 7 IN (3, 4) THEN NULL WHEN o_custkey % 31 = 0 THEN o_orderkey % 300 - 2 ELSE o_orderkey % 300 + 1 END AS value
        FROM {orders}""",
    "entries": """
        SELECT guide_id, seq, 'L' || CAST(guide_id AS STRING) || '-' || CAST(seq AS STRING) AS id, kind, name, l_partkey,
          CASE kind WHEN 'place' THEN 'hut' END AS place_type, seq % 4 AS grade_no
        FROM (
          SELECT l_orderkey AS guide_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq,
            CASE l_returnflag WHEN 'R' THEN 'place' WHEN 'A' THEN 'route' ELSE CASE WHEN l_linestatus = 'O' THEN 'route' ELSE 'traverse' END END AS kind, p_name AS name, l_partkey
          FROM {lineitem} JOIN {part} ON l_partkey = p_partkey) x""",
    "pages": """
        SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS guide_id, CAST((doc_id - doc_id % 2) / 2 AS INT) AS page, text FROM {documents}""",
    "anchored": """
        SELECT a.doc_id, CASE WHEN a.doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS guide_id, CAST((a.doc_id - a.doc_id % 2) / 2 AS INT) AS page,
          CASE WHEN a.doc_id % 9 = 0 THEN '  ' WHEN a.doc_id % 9 = 1 THEN 'nowhere at all' WHEN a.doc_id % 9 = 2 THEN substr(a.text, 20, 3) ELSE substr(a.text, 5, 40) END AS start_quote,
          CASE WHEN a.doc_id % 9 = 3 THEN substr(a.text, 5, 40) WHEN a.doc_id % 9 = 4 THEN 'no such end' WHEN a.doc_id % 9 = 5 THEN substr(b.text, 30, 20) ELSE substr(a.text, 80, 25) END AS end_quote
        FROM {documents} a LEFT JOIN {documents} b ON b.doc_id = a.doc_id + 2""",
    "graph_places": "SELECT 'N' || CAST(n_nationkey AS STRING) AS id, n_name AS name, 'place' AS kind FROM {nation}",
    "graph_routes": """
        SELECT 'C' || CAST(c_custkey AS STRING) AS id, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'N99' ELSE 'N' || CAST(c_nationkey AS STRING) END AS destination_id,
          c_custkey, c_nationkey, c_mktsegment AS peak FROM {customer}""",
    "graph_pois": """
        SELECT 'osm-node-' || CAST(s_suppkey AS STRING) AS poi_id, s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'peak' WHEN 1 THEN 'hut' ELSE 'settlement' END AS type,
          47.0 + CAST(s_suppkey % 100 AS DOUBLE) / 64.0 AS lat, 11.0 + CAST(s_suppkey % 90 AS DOUBLE) / 64.0 AS lon, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) + 1000.25 END AS ele, s_suppkey
        FROM {supplier}""",
    "graph_place_links": """
        SELECT s_suppkey AS seq, CASE WHEN s_nationkey % 3 = 0 THEN 'X' ELSE 'N' END || CAST(s_nationkey AS STRING) AS place_id, 'osm-node-' || CAST(s_suppkey * 2 AS STRING) AS poi_id FROM {supplier}""",
    "graph_mentions": """
        SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey, 'C' || CAST(l_partkey % 500 AS STRING) AS entry_id, 'osm-node-' || CAST(l_suppkey AS STRING) AS poi_id FROM {lineitem}""",
}


def _uses(sql: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", sql)


def sql_of(name: str, tables: dict[str, str] | None = None) -> str:
    """The SQL of an input, inputs it uses put in; base tables by name, or as ``tables`` has them."""
    sql = INPUTS[name]
    for used in dict.fromkeys(_uses(sql)):
        sql = sql.replace("{" + used + "}", sql_of(used, tables) if used in INPUTS else (tables or {}).get(used, used))
    return sql


def read(spark: SparkSession, sf_dir: str, name: str, deal: bool = False) -> DataFrame:
    """A base table, or an input derived from base tables, whose rows may be dealt to all tasks by their key, the first column."""
    if name not in INPUTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base = set()
    todo = [name]
    while todo:
        for used in _uses(INPUTS[todo.pop()]):
            (todo.append if used in INPUTS else base.add)(used)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in base}
    if deal:
        frames = {t: dealt(f, f.columns[0]) for t, f in frames.items()}
    return spark.sql(sql_of(name, {t: "{" + t + "}" for t in base}), **frames)


def with_inputs(query: str, *names: str) -> str:
    """DuckDB SQL: ``query`` after a WITH that defines the inputs it names."""
    parts = [f"{n}_in AS ({sql_of(n)})" for n in names]
    return f"WITH {', '.join(parts)}{',' if query.lstrip().startswith('+') else ''} {query.lstrip().lstrip('+')}"
