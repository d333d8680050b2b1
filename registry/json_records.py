"""JSON records: parsing, flattening, blocks and path mapping.

The nested records are built from the columns of one order each, so nothing has to be gathered.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.variants import as_text
from docflow.operators import blocks as B
from docflow.operators import flatten as N
from docflow.operators import json_paths as P
from docflow.session import workspace
from docflow.sources import json_lines as J
from registry import Registry
from registry.common import table, events

area = Registry()


@area.add("SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events")
def json_lines(spark, sf_dir):
    good = J.accepted(J.parse_json_lines(events(spark, sf_dir), "props"))
    return good.select("event_id", F.try_variant_get("record", "$.k", "bigint").alias("k"))


_BROKEN = """CASE event_id % 10 WHEN 0 THEN left(props, 4) WHEN 1 THEN '[' || props || ']' WHEN 2 THEN 'null' WHEN 3 THEN ''
    WHEN 4 THEN '"text"' ELSE props END"""


def _broken(spark, sf_dir):
    kind = F.col("event_id") % 10
    text = (
        F.when(kind == 0, F.substring("props", 1, 4)).when(kind == 1, F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == 2, "null").when(kind == 3, "").when(kind == 4, '"text"').otherwise(F.col("props"))
    )
    return events(spark, sf_dir).select("event_id", text.alias("value"))


_OUTCOME = """
    SELECT CASE event_id % 10 WHEN 0 THEN 'malformed JSON' WHEN 1 THEN 'not a JSON object' WHEN 4 THEN 'not a JSON object'
      ELSE 'document' END AS outcome, count(*) AS n
    FROM events WHERE event_id % 10 NOT IN (2, 3) GROUP BY 1
"""


@area.add(_OUTCOME)
def json_line_errors(spark, sf_dir):
    parsed = J.parse_json_lines(_broken(spark, sf_dir))
    return parsed.groupBy(F.coalesce("error", F.lit("document")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@area.add(_OUTCOME)
def json_flatten_errors(spark, sf_dir):
    parsed = N.flatten_json(_broken(spark, sf_dir), "value")
    return parsed.groupBy(F.coalesce("error", F.lit("document")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@area.add("""
    SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'malformed JSON' WHEN 1 THEN 'not a JSON object' WHEN 4 THEN 'not a JSON object' END AS error,
      CASE event_id % 10 WHEN 0 THEN props[:4] WHEN 1 THEN '[' || props || ']' WHEN 4 THEN '"text"' END AS text,
      CASE WHEN event_id % 10 > 4 THEN props::JSON->>'k' END AS k
    FROM events WHERE event_id % 10 NOT IN (2, 3)
""")
def json_lines_parsed_once(spark, sf_dir):
    # Records and rejects are read back from one write; no line is parsed twice.
    good, bad = J.parsed_once(J.parse_json_lines(_broken(spark, sf_dir)), workspace(spark, "parsed-once"))
    nothing = F.lit(None).cast("string")
    records = good.select("event_id", nothing.alias("error"), nothing.alias("text"), F.expr("variant_get(record, '$.k', 'string')").alias("k"))
    return records.unionByName(bad.select("event_id", "error", F.col("value").alias("text"), nothing.alias("k")))


@area.add("SELECT event_id::VARCHAR AS event_id, 'k' AS path, props::JSON->>'k' AS value FROM events")
def json_flatten_events(spark, sf_dir):
    documents = N.flat_documents(N.flatten_json(events(spark, sf_dir), "props"), "event_id")
    leaves = N.to_leaves(documents, "event_id")
    return leaves.select("event_id", "path", as_text(F.col("value")).alias("value"))


def order_records(spark, sf_dir, as_json: bool = True):
    """One nested record per order; with ``as_json`` its shape varies from row to row."""
    none = F.lit(None).cast("string")
    customer = F.struct(F.col("o_custkey").alias("key"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    items = F.array(
        F.struct(F.lit(1).alias("no"), (F.col("o_custkey") % 2).alias("half"), F.lit(None).cast("struct<x:bigint>").alias("sub")),
        F.struct(F.lit(2).alias("no"), F.lit(None).cast("bigint").alias("half"), F.struct((F.col("o_orderkey") % 3).alias("x")).alias("sub")),
    )
    grid = F.array(F.array(F.lit(1).cast("bigint"), F.col("o_orderkey") % 4), F.array(F.col("o_custkey") % 7))
    record = F.struct(
        F.col("o_orderpriority").alias("priority"), customer.alias("customer"), items.alias("items"), grid.alias("grid"),
        F.array().cast("array<string>").alias("empty"), none.alias("nothing"),
    )
    df = table(spark, sf_dir, "orders")
    return df.select("o_orderkey", (F.to_json(record) if as_json else record).alias("record"))


_K, _C = "o_orderkey", "o_custkey"
_LEAVES = {
    "priority": "o_orderpriority",
    "customer.key": f"{_C}::VARCHAR",
    "customer.tags": "'[\"' || o_orderstatus || '\",\"' || o_orderpriority || '\"]'",
    "items.0.no": "'1'",
    "items.0.half": f"({_C} % 2)::VARCHAR",
    "items.1.no": "'2'",
    "items.1.sub.x": f"({_K} % 3)::VARCHAR",
    "grid.0": f"'[1,' || {_K} % 4 || ']'",
    "grid.1": f"'[' || {_C} % 7 || ']'",
}
_LEAVES_SQL = " UNION ALL ".join(
    f"SELECT o_orderkey::VARCHAR AS o_orderkey, '{path}' AS path, {value} AS value FROM orders" for path, value in _LEAVES.items()
)


@area.add(_LEAVES_SQL)
def json_flatten_orders(spark, sf_dir):
    documents = N.flat_documents(N.flatten_json(order_records(spark, sf_dir), "record"), "o_orderkey")
    leaves = N.to_leaves(documents, "o_orderkey")
    return leaves.select("o_orderkey", "path", as_text(F.col("value")).alias("value"))


@area.add(_LEAVES_SQL)
def flatten_typed_orders(spark, sf_dir):
    typed = order_records(spark, sf_dir, as_json=False).select("o_orderkey", "record.*")
    fields = N.flatten_typed(typed, "o_orderkey")
    leaves = fields.select("o_orderkey", F.explode("fields").alias("path", "value"))
    return leaves.select("o_orderkey", "path", as_text(F.col("value")).alias("value"))


@area.add("""
    SELECT CASE WHEN event_id % 2 = 0 THEN 'own' || event_id ELSE event_id::VARCHAR END AS event_id, 'a/b/0/c' AS path,
      user_id::VARCHAR AS value
    FROM events WHERE event_id % 3 > 0
""")
def json_flatten_own_ids(spark, sf_dir):
    # An id inside the record wins, another delimiter joins the names, and mixed lists are refused.
    own = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"id":"own'), "event_id", F.lit('",'))).otherwise("")
    tail = F.when(F.col("event_id") % 3 == 0, ",5").otherwise("")
    text = F.concat(F.lit("{"), own, F.lit('"a":{"b":[{"c":'), "user_id", F.lit("}"), tail, F.lit("]}}"))
    df = events(spark, sf_dir).select("event_id", text.alias("value"))
    documents = N.flat_documents(N.flatten_json(df, "value", "/"), "event_id")
    leaves = N.to_leaves(documents, "event_id")
    return leaves.select("event_id", "path", as_text(F.col("value")).alias("value"))


@area.add(f"SELECT event_id, '{N.MIXED_LIST}' AS error FROM events WHERE event_id % 3 = 0")
def json_flatten_rejects(spark, sf_dir):
    tail = F.when(F.col("event_id") % 3 == 0, ",5").otherwise("")
    text = F.concat(F.lit('{"a":[{"c":'), "user_id", F.lit("}"), tail, F.lit("]}"))
    df = events(spark, sf_dir).select("event_id", text.alias("value"))
    return N.flat_rejects(N.flatten_json(df, "value")).select("event_id", "error")


def _node(node: str, parent: str, depth: int, ordinal: int, fields: str) -> str:
    return f"""SELECT {_K}::VARCHAR AS root_id, {node} AS doc_id, {parent} AS parent_id, {depth} AS depth,
        {ordinal} AS ordinal, {fields} AS fields FROM orders"""


_ROOT = f"{_K}::VARCHAR"


def _below(path: str) -> str:
    return f"{_K} || '.{path}'"


_BLOCKS_SQL = " UNION ALL ".join([
    _node(_ROOT, "NULL", 0, 0, "'{\"priority\":\"' || o_orderpriority || '\"}'"),
    _node(_below("customer"), _ROOT, 1, 0,
          f"'{{\"key\":' || {_C} || ',\"tags\":[\"' || o_orderstatus || '\",\"' || o_orderpriority || '\"]}}'"),
    _node(_below("items.0"), _ROOT, 1, 0, f"'{{\"half\":' || {_C} % 2 || ',\"no\":1}}'"),
    _node(_below("items.1"), _ROOT, 1, 1, "'{\"no\":2}'"),
    _node(_below("items.1.sub"), _below("items.1"), 2, 0, f"'{{\"x\":' || {_K} % 3 || '}}'"),
    _node(_below("grid.0"), _ROOT, 1, 0, f"'{{\"' || {_below('grid.0')} || '\":[1,' || {_K} % 4 || ']}}'"),
    _node(_below("grid.1"), _ROOT, 1, 1, f"'{{\"' || {_below('grid.1')} || '\":[' || {_C} % 7 || ']}}'"),
])


@area.add(_BLOCKS_SQL)
def nested_blocks_orders(spark, sf_dir):
    parsed = B.parse_blocks(order_records(spark, sf_dir), "o_orderkey", "record")
    return B.block_documents(parsed).withColumn("fields", F.to_json("fields"))


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@area.add(f"""
    WITH ranked AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}, l_extendedprice) AS rn FROM lineitem),
    kept AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY rn) AS lines, count(*) AS n
      FROM ranked WHERE rn <= 3 GROUP BY 1)
    SELECT o_orderkey, coalesce(lines, '') AS lines, coalesce(n, 0) AS n,
      coalesce((SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o_orderkey), 0) AS n_children
    FROM orders LEFT JOIN kept ON l_orderkey = o_orderkey
""")
def block_fetch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE_ORDER)
    blocks = B.fetch_blocks(orders, lines, "o_orderkey", "l_orderkey", _LINE_ORDER, limit=3)
    texts = F.transform("children", lambda c: F.concat_ws(":", c["l_linenumber"], c["l_partkey"]))
    return blocks.select("o_orderkey", F.array_join(texts, ",").alias("lines"), F.size("children").alias("n"), "n_children")


def _records(spark, sf_dir):
    return order_records(spark, sf_dir).select("o_orderkey", F.parse_json("record").alias("record"))


@area.add(f"""
    SELECT {_K}, 0 AS part_no, o_orderpriority AS priority, 1 AS no, ({_C} % 2)::VARCHAR AS half, NULL AS x,
      '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags FROM orders
    UNION ALL
    SELECT {_K}, 1, o_orderpriority, 2, NULL, ({_K} % 3)::VARCHAR, '["' || o_orderstatus || '","' || o_orderpriority || '"]' FROM orders
""")
def json_split_mapping(spark, sf_dir):
    mappings = ("priority:/priority", "/items/no", "half_l:/items/half", "x:/items/sub/x", "tags:/customer/tags")
    mapped = P.map_paths(_records(spark, sf_dir), "record", mappings, split="/items")

    def field(name: str):
        return as_text(F.col("fields")[name])

    return mapped.select(
        "o_orderkey", "part_no", field("priority").alias("priority"), field("no").cast("int").alias("no"),
        field("half_l").alias("half"), field("x").alias("x"), field("tags").alias("tags"),
    )


_FULL_NAMES = {
    "priority": "o_orderpriority",
    "customer.key": f"{_C}::VARCHAR",
    "customer.tags": _LEAVES["customer.tags"],
    "items.no": "'[1,2]'",
    "items.half": f"({_C} % 2)::VARCHAR",
    "items.sub.x": f"({_K} % 3)::VARCHAR",
    "grid": f"'[1,' || {_K} % 4 || ',' || {_C} % 7 || ']'",
    "color_s": "o_orderpriority",
}


@area.add(" UNION ALL ".join(
    f"SELECT {_K}, '{name}' AS name, {value} AS value FROM orders" for name, value in _FULL_NAMES.items()
))
def json_full_names(spark, sf_dir):
    mapped = P.map_paths(_records(spark, sf_dir), "record", ("color_s:/priority", "$FQN:/**"))
    fields = mapped.select("o_orderkey", F.explode("fields").alias("name", "value"))
    return fields.select("o_orderkey", "name", as_text(F.col("value")).alias("value"))
