"""Splitting JSON records and mapping slash paths to fields.

A mapping is ``target:/a/b`` (one path), ``/a/b`` (named after its last step), or ends in ``/*``
(direct scalar members) or ``/**`` (all leaves below). ``$FQN:`` names leaves by their dotted full
path, a plain target gathers them all in one field. Lists below the split point make a field
multi-valued; paths carry no list positions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.let import let
from docflow.functions.variants import as_list, as_object, is_null
from docflow.operators.flatten import json_codec

ALL_FIELDS = ("$FQN:/**",)
FULL_NAME = "$FQN"


@dataclass(frozen=True)
class Mapping:
    target: str | None
    steps: tuple[str, ...]
    wildcard: str | None

    @classmethod
    def parse(cls, text: str) -> Mapping:
        target, colon, path = text.rpartition(":")
        if not path.startswith("/"):
            raise ValueError(f"mapping {text!r} needs a path that starts with /")
        steps = tuple(s for s in path.split("/") if s)
        wildcard = steps[-1] if steps and steps[-1] in ("*", "**") else None
        if wildcard:
            steps = steps[:-1]
        if "*" in steps or "**" in steps or not (steps or wildcard):
            raise ValueError(f"mapping {text!r}: a wildcard may only be the last step")
        return cls(target if colon else None, steps, wildcard)

    @property
    def name(self) -> str:
        if self.target == FULL_NAME:
            return ".".join(self.steps)
        return self.target or self.steps[-1]


def _steps(path: str) -> tuple[str, ...]:
    return tuple(s for s in path.split("/") if s)


def _member(value: Column, *steps: str) -> Column:
    path = "$" + "".join("['" + s.replace("\\", "\\\\").replace("'", "\\'") + "']" for s in steps)
    return F.try_variant_get(value, path, "variant")


def _values(record: Column, steps: tuple[str, ...]) -> Column:
    """All values a path reaches, entering every list on the way: ARRAY<VARIANT>."""
    none = F.array().cast("array<variant>")

    def members(value: Column) -> Column:
        return let(value, lambda v: F.coalesce(as_list(v), F.when(is_null(v), none).otherwise(F.array(v))))

    if not steps:
        return F.array(record)
    reached = members(_member(record, steps[0]))
    for step in steps[1:]:
        reached = F.flatten(F.transform(reached, _through(step, members)))
    if len(steps) > 1:
        # Without a list on the way one look-up reaches the value; otherwise it finds nothing.
        direct = _member(record, *steps)
        reached = F.when(direct.isNotNull(), members(direct)).otherwise(reached)
    return F.filter(reached, lambda v: ~is_null(v))


def _through(step: str, members: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda value: members(_member(value, step))


def split_records(df: DataFrame, record: str, split: str = "/") -> DataFrame:
    """One row per object found at the split path: ``part`` (VARIANT) and its number ``part_no``."""
    parts = F.array(F.col(record)) if not _steps(split) else _values(F.col(record), _steps(split))
    return df.select("*", F.posexplode(parts).alias("part_no", "part"))


def map_paths(df: DataFrame, record: str, mappings: tuple[str, ...] = ALL_FIELDS, split: str = "/") -> DataFrame:
    """Split VARIANT records and add ``part_no`` and ``fields`` (MAP of name to VARIANT).

    A path below the split point is read from the part, any other from the whole record. Single
    paths are read by the JVM; only wildcards, whose names are in the data, need the helper.
    """
    parsed = [Mapping.parse(m) for m in mappings or ALL_FIELDS]
    split_steps = _steps(split)
    rows = split_records(df, record, split)

    gathered: dict[str, list[Column]] = {}
    for mapping in parsed:
        if mapping.wildcard:
            continue
        inside = mapping.steps[: len(split_steps)] == split_steps
        source, steps = ("part", mapping.steps[len(split_steps) :]) if inside else (record, mapping.steps)
        gathered.setdefault(mapping.name, []).append(_values(F.col(source), steps))
    entries = [
        F.struct(F.lit(name).alias("key"), F.concat(*found).alias("value")) for name, found in gathered.items()
    ]
    single = F.lit(None).cast("map<string,variant>")
    if entries:
        filled = F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0)
        single = F.map_from_entries(
            F.transform(
                filled,
                lambda e: F.struct(
                    e["key"],
                    F.when(F.size(e["value"]) == 1, e["value"][0]).otherwise(e["value"].cast("variant")).alias("value"),
                ),
            )
        )
    wild = [[m.target, list(m.steps), m.wildcard] for m in parsed if m.wildcard]
    if not wild:
        return rows.select(*df.columns, "part_no", single.alias("fields"))
    whole = F.to_json(record) if split_steps else F.lit(None).cast("string")
    spec = F.lit(json.dumps({"split": list(split_steps), "wild": wild}))
    rows = rows.withColumn("_wild", _wildcards_once(whole, F.to_json("part"), spec))
    found = as_object(F.parse_json("_wild"))
    return rows.select(*df.columns, "part_no", (F.map_concat(found, single) if entries else found).alias("fields"))


def _scalars(record, steps: list[str]) -> Iterator[tuple[list[str], object]]:
    """Every non-null scalar with the object keys that lead to it; lists add no step."""
    pending = [(steps, record)]
    while pending:
        at, value = pending.pop()
        if isinstance(value, dict):
            pending.extend(([*at, name], item) for name, item in reversed(value.items()))
        elif isinstance(value, list):
            pending.extend((at, item) for item in reversed(value))
        elif value is not None:
            yield at, value


def _gather(whole: str | None, part: str, spec: dict) -> dict:
    """Fields of the wildcard mappings: scalars of the part, and of the record outside the split."""
    split = spec["split"]
    found = list(_scalars(json.loads(part), split))
    if whole is not None:
        found += [(steps, value) for steps, value in _scalars(json.loads(whole), []) if steps[: len(split)] != split]
    fields: dict[str, list] = {}
    for steps, value in found:
        for target, below, wildcard in spec["wild"]:
            rest = len(steps) - len(below)
            if steps[: len(below)] != below or rest < 1 or (wildcard == "*" and rest != 1):
                continue
            name = ".".join(steps) if target == FULL_NAME else target or steps[-1]
            fields.setdefault(name, []).append(value)
    return {name: values[0] if len(values) == 1 else values for name, values in fields.items()}


@F.arrow_udf(T.StringType())
def _wildcard_batch(wholes: pa.Array, parts: pa.Array, specs: pa.Array) -> pa.Array:
    spec = json.loads(specs[0].as_py()) if len(specs) else {}
    encode = json_codec()[1]
    return pa.array(
        [
            encode(_gather(whole, part, spec))
            for whole, part in zip(wholes.to_pylist(), parts.to_pylist())
        ],
        pa.string(),
    )


# Declared non-deterministic only so that a filter on its result cannot run it a second time.
_wildcards_once = _wildcard_batch.asNondeterministic()
