"""Nested records to blocks of one parent document and its descendants."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.flatten import TOO_DEEP, BadRecord, json_codec, nests, read_object, scalar_text, storable
from docflow.operators.ranking import first_per_group

SEPARATOR = "."


def nodes(doc_id: str, record: dict, encode: Callable[[object], str]) -> Iterator[dict]:
    """The documents of one block, parent first.

    Objects and elements of lists of objects become children under their own ``id`` or under
    ``parent.field[.index]``. An element of a list of lists becomes a child whose only field is
    named like the child and holds the inner list.
    """
    pending = [(scalar_text(record.get("id")) or doc_id, None, 0, 0, record)]
    while pending:
        node_id, parent_id, depth, ordinal, content = pending.pop()
        fields, children = {}, []
        for name, value in content.items():
            below = f"{node_id}{SEPARATOR}{name}"
            if value is None or value == [] or (name == "id" and not isinstance(value, (dict, list))):
                continue
            if isinstance(value, dict):
                children.append((scalar_text(value.get("id")) or below, 0, value))
            elif isinstance(value, list) and nests(value):
                for i, item in enumerate(value):
                    at = f"{below}{SEPARATOR}{i}"
                    inner = item if isinstance(item, dict) else {at: item}
                    children.append((scalar_text(inner.get("id")) or at, i, inner))
            else:
                fields[name] = value
        yield {
            "node_id": storable(node_id),
            "parent_id": parent_id and storable(parent_id),
            "depth": depth,
            "ordinal": ordinal,
            "fields": encode(fields) if fields else "{}",
        }
        pending.extend((child, node_id, depth + 1, i, inner) for child, i, inner in reversed(children))


_NODE = (
    T.StructType()
    .add("node_id", "string")
    .add("parent_id", "string")
    .add("depth", "integer")
    .add("ordinal", "integer")
    .add("fields", "string")
)
_BLOCK = T.StructType().add("nodes", T.ArrayType(_NODE)).add("error", "string")
_ARROW_NODE = pa.struct(
    [
        ("node_id", pa.string()),
        ("parent_id", pa.string()),
        ("depth", pa.int32()),
        ("ordinal", pa.int32()),
        ("fields", pa.string()),
    ]
)


def _block(doc_id: str | None, text: str | None, decode, encode) -> dict:
    try:
        record = read_object(text, decode)
        return {"nodes": None if record is None else list(nodes(doc_id, record, encode)), "error": None}
    except BadRecord as bad:
        return {"nodes": None, "error": str(bad)}
    except RecursionError:
        return {"nodes": None, "error": TOO_DEEP}
    except ValueError:
        return {"nodes": None, "error": "number out of range"}


@F.arrow_udf(_BLOCK)
def _block_batch(doc_ids: pa.Array, texts: pa.Array) -> pa.Array:
    codec = json_codec()
    rows = [_block(doc_id, text, *codec) for doc_id, text in zip(doc_ids.to_pylist(), texts.to_pylist())]
    return pa.array(rows, pa.struct([("nodes", pa.list_(_ARROW_NODE)), ("error", pa.string())]))


# Declared non-deterministic only so that a filter on its result cannot run it a second time.
_block_once = _block_batch.asNondeterministic()


def parse_blocks(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Add ``nodes`` (the documents of the block) and ``error`` to rows of JSON text.

    Rows are dealt by their id first: parsing costs far more than reading, and a small file would
    otherwise be parsed in as few tasks as it has splits.
    """
    dealt = df.repartition(F.col(doc_id))
    parsed = dealt.withColumn("_block", _block_once(F.col(doc_id).cast("string"), F.col(text)))
    found = parsed.filter(F.col("_block.nodes").isNotNull() | F.col("_block.error").isNotNull())
    return found.select(*df.columns, "_block.nodes", "_block.error")


def block_documents(parsed: DataFrame) -> DataFrame:
    """One row per document: ``root_id, parent_id, doc_id, depth, ordinal, fields`` (VARIANT)."""
    good = parsed.filter(F.col("error").isNull())
    return good.select(F.col("nodes")[0]["node_id"].alias("root_id"), F.inline("nodes")).select(
        "root_id",
        "parent_id",
        F.col("node_id").alias("doc_id"),
        "depth",
        "ordinal",
        F.parse_json("fields").alias("fields"),
    )


def block_rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).drop("nodes")


def fetch_blocks(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, order: list[str], limit: int
) -> DataFrame:
    """Parents with up to ``limit`` of their children, in ``order``, as the array ``children``.

    The limit is the feature: it is applied before anything is gathered, so the list of a parent
    with any number of children stays small; ``n_children`` tells how many there are. Parents
    without children get an empty list.
    """
    kept = first_per_group(children, [child_key], order, limit)
    rest = [c for c in children.columns if c != child_key and c not in order]
    listed = kept.groupBy(F.col(child_key).alias("_parent")).agg(
        F.sort_array(F.collect_list(F.struct(*order, *rest))).alias("children")
    )
    counts = children.groupBy(F.col(child_key).alias("_parent")).agg(F.count(F.lit(1)).alias("n_children"))
    empty = F.array().cast(listed.schema["children"].dataType)
    joined = parents.join(counts.join(listed, "_parent", "left"), F.col(parent_key) == F.col("_parent"), "left")
    return joined.drop("_parent").withColumns(
        {"children": F.coalesce("children", empty), "n_children": F.coalesce("n_children", F.lit(0))}
    )
