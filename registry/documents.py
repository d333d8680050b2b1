"""Mapping typed rows and maps to documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import mappers as M
from docflow.operators import typing as Y
from docflow.operators.filters import by_id, sample, track_keywords
from registry import Registry
from registry.common import events, table

area = Registry()


def _st(column: str, name: str) -> str:
    has_blank = f"contains({column}, ' ')"
    return f"CASE WHEN NOT {has_blank} THEN {column} END AS {name}_s, CASE WHEN {has_blank} THEN {column} END AS {name}_t"


@area.add(f"""
    SELECT p_partkey::VARCHAR AS id, {_st('p_name', 'p_name')}, {_st('p_brand', 'p_brand')}, {_st('p_type', 'p_type')},
      p_size AS p_size_i, p_retailprice AS p_retailprice_d
    FROM part
""")
def dynamic_fields_part(spark, sf_dir):
    return M.dynamic_fields(table(spark, sf_dir, "part"), "p_partkey")


@area.add(f"""
    SELECT o_orderkey::VARCHAR AS id, o_custkey AS o_custkey_l, {_st('o_orderstatus', 'o_orderstatus')},
      o_totalprice AS o_totalprice_d, epoch_ms(o_orderdate) AS o_orderdate_tdt, {_st('o_orderpriority', 'o_orderpriority')}
    FROM orders
""")
def dynamic_fields_orders(spark, sf_dir):
    documents = M.dynamic_fields(table(spark, sf_dir, "orders"), "o_orderkey")
    return documents.withColumn("o_orderdate_tdt", F.unix_millis("o_orderdate_tdt"))


@area.add("""
    SELECT o_orderkey::VARCHAR AS id, o_custkey AS o_custkey_ref, o_orderpriority AS o_orderpriority_s, o_orderkey::VARCHAR AS money_str
    FROM orders
""")
def dynamic_fields_override(spark, sf_dir):
    # An overridden string is never split by blanks, and a decimal maps only by an override.
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderkey").cast("decimal(20,0)").alias("money"),
        F.col("o_orderkey").cast("decimal(20,0)").alias("dropped"),
    )
    overrides = {"o_custkey": "_ref", "o_orderpriority": "_s", "money": "_str"}
    return M.dynamic_fields(df, "o_orderkey", overrides).withColumn("money_str", F.col("money_str").cast("string"))


@area.add("SELECT vec_id::VARCHAR AS id, label AS label_i FROM embeddings")
def dynamic_fields_arrays_dropped(spark, sf_dir):
    # The vector is left out even though an override names it.
    return M.dynamic_fields(table(spark, sf_dir, "embeddings"), "vec_id", {"embedding": "_fs"})


@area.add("SELECT vec_id::VARCHAR AS id, label FROM embeddings")
def dynamic_fields_guess(spark, sf_dir):
    return M.guessed_fields(table(spark, sf_dir, "embeddings"), "vec_id")


@area.add("""
    SELECT id, field, count(*) AS n FROM (
      SELECT p_partkey::VARCHAR AS id, CASE WHEN contains(p_name, ' ') THEN 'p_name_t' ELSE 'p_name_s' END AS field FROM part
      UNION ALL SELECT p_partkey::VARCHAR, 'p_size_i' FROM part WHERE p_size % 2 = 0)
    GROUP BY 1, 2
""")
def present_fields(spark, sf_dir):
    # A NULL is no field: odd sizes are set to NULL first.
    df = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("p_size")
    )
    fields = M.to_fields(M.dynamic_fields(df, "p_partkey"))
    return fields.groupBy("id", "field").agg(F.count(F.lit(1)).alias("n"))


@area.add("""
    SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'own' || s_suppkey ELSE s_suppkey::VARCHAR END AS id, s_name AS name,
      s_nationkey::VARCHAR AS nation
    FROM supplier
""")
def map_fields(spark, sf_dir):
    own = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("own"), F.col("s_suppkey")))
    entries = F.create_map(
        F.lit("id"), own, F.lit("name"), F.col("s_name"), F.lit("nation"), F.col("s_nationkey").cast("string")
    )
    df = table(spark, sf_dir, "supplier").select("s_suppkey", entries.alias("line"))
    documents = M.map_fields(df, "s_suppkey", "line")
    return documents.select("id", F.col("fields")["name"].alias("name"), F.col("fields")["nation"].alias("nation"))


@area.add("""
    SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"'
      || CASE WHEN n_regionkey > 1 THEN ',"region":' || n_regionkey ELSE '' END || '}' AS json
    FROM nation
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders
""")
def json_text(spark, sf_dir):
    # Rows are serialised without NULLs; a payload that is text already stays as it is.
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", F.when(F.col("n_regionkey") > 1, F.col("n_regionkey")).alias("region")
    )
    payload = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n_nationkey"), "o_orderstatus")
    return M.to_json_text(nation).select("n_nationkey", "json").union(
        M.to_json_text(payload, "o_orderstatus").select("n_nationkey", "json")
    )


@area.add("""
    SELECT s_suppkey::VARCHAR AS id,
      '{"id":"' || s_suppkey || '","fields":[{"name":"s_name","value":"' || s_name || '"},{"name":"s_nationkey","value":'
      || CASE WHEN s_nationkey % 4 = 0 THEN '""' ELSE s_nationkey::VARCHAR END || '}]}' AS json
    FROM supplier
""")
def index_envelope(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.when(F.col("s_nationkey") % 4 != 0, F.col("s_nationkey")).alias("s_nationkey")
    )
    return M.envelope_json(M.envelopes(df, "s_suppkey"))


_CELLS = """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'FALSE' END AS flag, event_id::VARCHAR AS whole,
      CASE WHEN event_id % 2 = 0 THEN event_id || '.5' ELSE event_id::VARCHAR END AS number,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment, event_type AS word,
      CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE event_id::VARCHAR END AS mixture
    FROM events
"""


def _cells(spark, sf_dir):
    event = F.col("event_id").cast("string")
    return events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, "true").otherwise("FALSE").alias("flag"),
        event.alias("whole"),
        F.when(F.col("event_id") % 2 == 0, F.concat(event, F.lit(".5"))).otherwise(event).alias("number"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.col("event_type").alias("word"),
        F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(event).alias("mixture"),
    )


@area.add(f"""
    SELECT event_id, lower(flag) = 'true' AS flag, whole::BIGINT AS whole, number::DOUBLE AS number,
      epoch_ms(strptime(moment, '%Y-%m-%d %H:%M:%S')) AS moment, word, mixture FROM ({_CELLS})
""")
def type_guess(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    typed = Y.cast_guessed(cells, Y.guess_types(cells))
    return typed.withColumn("moment", F.unix_millis("moment"))


_KIND = """CASE WHEN v IN ('true', 'false') THEN 'boolean' WHEN regexp_full_match(v, '-?[0-9]+') THEN 'long'
    WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 'double' WHEN try_cast(v AS TIMESTAMP) IS NOT NULL THEN 'date' ELSE 'string' END"""


@area.add(f"""
    SELECT kind, count(*) AS n FROM (
      SELECT {_KIND} AS kind FROM (SELECT lower(unnest([flag, whole, number, moment, word, mixture])) AS v FROM ({_CELLS})))
    GROUP BY 1
""")
def type_guess_values(spark, sf_dir):
    values = _cells(spark, sf_dir).select(F.explode(F.array("flag", "whole", "number", "moment", "word", "mixture")).alias("v"))
    return values.select(Y.guess_value(F.col("v")).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@area.add("""
    SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS "event_type_", user_id AS "user-id.x"
    FROM events
""")
def blank_and_names(spark, sf_dir):
    blank = F.when(F.col("event_id") % 3 == 0, F.repeat(F.lit(" "), (F.col("event_id") % 2).cast("int"))).otherwise(F.col("event_type"))
    df = events(spark, sf_dir).select("event_id", blank.alias("event_type!"), F.col("user_id").alias("user-id.x"))
    return M.clean_names(M.drop_blank(df))


@area.add("""
    WITH hashed AS (SELECT event_id, sha256('+' || event_id || chr(31) || '+' || event_type) AS h FROM events)
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id::VARCHAR ELSE
      h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] END AS id
    FROM hashed
""")
def missing_ids(spark, sf_dir):
    given = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string"))
    df = events(spark, sf_dir).select("event_id", "event_type", given.alias("id"))
    return M.with_missing_ids(df, "id", ["event_id", "event_type"]).select("event_id", "id")


@area.add("SELECT count(*) AS docs, count(*) AS ids, true AS well_formed FROM events")
def random_ids(spark, sf_dir):
    df = M.with_missing_ids(events(spark, sf_dir).select("event_id"))
    shape = r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return df.agg(
        F.count(F.lit(1)).alias("docs"), F.countDistinct("id").alias("ids"), F.bool_and(F.col("id").rlike(shape)).alias("well_formed")
    )


@area.add("SELECT event_id FROM events WHERE event_id % 4 <> 0 AND event_type <> 'error'")
def complete_tuples(spark, sf_dir):
    df = events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 4 != 0, F.col("event_id")).alias("id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("payload"),
    )
    return M.with_ids_and_payload(df, "id", "payload").select("event_id")


@area.add("SELECT event_id FROM events WHERE event_type = 'purchase'")
def mapper_veto(spark, sf_dir):
    # The mapper knows purchases only.
    document = F.when(F.col("event_type") == "purchase", F.struct("event_id", "value"))
    return M.keep_mapped(M.as_documents(events(spark, sf_dir)).withColumn("doc", document), "doc").select("event_id")


KEYWORDS = ["license", "the", "über", "copyright", "mit"]


@area.add(r"""
    SELECT doc_id FROM documents
    WHERE regexp_matches(text, '(?i)(?:^|[^\pL\pN\pM_])(?:license|the|über|copyright|mit)(?:$|[^\pL\pN\pM_])')
""")
def keyword_filter(spark, sf_dir):
    return track_keywords(table(spark, sf_dir, "documents"), "text", KEYWORDS).select("doc_id")


@area.add("SELECT doc_id FROM documents WHERE doc_id % 10 < 3")
def sample_mod(spark, sf_dir):
    return sample(table(spark, sf_dir, "documents"), "doc_id", 3, 10).select("doc_id")


@area.add("SELECT p_partkey, p_name FROM part WHERE p_partkey = 17")
def lookup_by_id(spark, sf_dir):
    return by_id(table(spark, sf_dir, "part"), "17", "p_partkey").select("p_partkey", "p_name")
