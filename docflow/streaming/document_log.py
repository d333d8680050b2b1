"""Documents in partitioned files, committed one micro-batch at a time."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docflow.functions.let import named
from docflow.operators.collections import through_alias
from docflow.operators.upsert import current_view
from docflow.sources.storage import open_storage, read_json, write_json

COLLECTION = "collection"
BUCKET = "_bucket"
POINTER = "current.json"
DOCS_PER_BUCKET = 2_000_000
# The collection of a log under which lines without a document are stored.
REJECTED = "__rejected__"


def write_documents(
    df: DataFrame, path: str, mode: str = "errorifexists", file_format: str = "parquet", by_slot: bool = False
) -> None:
    """Write documents under ``collection=.../``; a new collection needs no preparation.

    The rebalance brings the documents of a collection together without trusting collections to
    be of similar size: Spark splits a large one over several tasks and files, and merges small
    ones. ``by_slot`` also keeps the slots of a collection in files of their own.
    """
    keys = [COLLECTION, "slot"] if by_slot else [COLLECTION]
    placed = df.hint("rebalance", *(F.col(c) for c in keys))
    placed.write.mode(mode).format(file_format).partitionBy(COLLECTION).save(path)


def _wider(one: T.DataType, two: T.DataType) -> T.DataType:
    """The type that holds values of both: numbers widen, a date becomes a time, anything else text."""
    if one == two:
        return one
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(one, whole) and isinstance(two, whole):
        return whole[max(whole.index(type(one)), whole.index(type(two)))]()
    if isinstance(one, (*whole, T.FloatType, T.DoubleType)) and isinstance(two, (*whole, T.FloatType, T.DoubleType)):
        # A long does not fit a double; as text it stays what it was.
        return T.StringType() if T.LongType() in (one, two) else T.DoubleType()
    if {type(one), type(two)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """All fields of the schemas in the order of their first appearance, each with a type that fits all."""
    kinds: dict[str, T.DataType] = {}
    for field in (f for s in schemas for f in s.fields):
        kinds[field.name] = _wider(kinds.get(field.name, field.dataType), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _as_type(name: str, have: T.DataType | None, wanted: T.DataType) -> Column:
    if have is None:
        return F.lit(None).cast(wanted).alias(name)
    column = named(name)
    if have != wanted and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        column = F.to_json(column)
    return column.cast(wanted).alias(name)


class DocumentLog:
    """An append-only log of documents in a shared folder, compacted into generations from time to time.

    A batch is written to its own folder and becomes visible with its manifest: one row per
    collection, written last. A batch that is already committed is not written again, so repeated
    delivery changes nothing, no committed file is ever touched, and a failed attempt is never read.

    Each batch keeps its own schema. A document has NULL in columns that its batch lacks, and a column that
    changes its type is read as the type that holds all its values (``merged_schema``).

    ``compact`` writes the current documents as a new generation and then swaps one pointer file. Batches
    in the generation are not read again. A generation is cut by collection and by a hash of the id, so a
    lookup opens the files of one bucket.

    Rows of the collection ``REJECTED`` are lines without a document. They are written and committed with the
    documents of their batch, so that both come from one parse, and only ``rejects`` reads them.
    ``reject_fields`` are the columns that only they use.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: tuple[str, ...] = (COLLECTION, "id"), reject_fields: tuple[str, ...] = ()
    ):
        self.spark, self.path, self.keys, self.reject_fields = spark, path.rstrip("/"), list(keys), reject_fields

    # --- writing ---------------------------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write one batch, all of it, and then commit it.

        Documents get a ``seq`` that grows in the order of the batch, unless they have one.
        """
        if self.committed(batch_id):
            return
        if "seq" not in batch.columns:
            batch = batch.withColumn("seq", F.monotonically_increasing_id())
        folder = f"{self.path}/documents/batch_id={batch_id}"
        write_documents(batch, folder, mode="overwrite")
        write_json(f"{self.path}/schemas", f"{batch_id}.json", json.loads(batch.drop(*self.reject_fields).schema.json()))
        # Counted from the files just written, so the input is evaluated once.
        written = self.spark.read.schema(f"{COLLECTION} string").parquet(folder)
        manifest = written.groupBy(COLLECTION).agg(F.count(F.lit(1)).alias("docs"))
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={batch_id}")

    def committed(self, batch_id: int) -> bool:
        """Whether a batch is in the current generation or its manifest is complete."""
        pointer = self.generation()
        if pointer and batch_id <= pointer["upto"] and batch_id not in pointer["gaps"]:
            return True
        system, top = open_storage(f"{self.path}/manifest/batch_id={batch_id}/_SUCCESS")
        return system.get_file_info(top).type == pafs.FileType.File

    def compact(self, order: tuple[str, ...] = ("batch_id", "seq"), buckets: int | None = None) -> int:
        """Write the current documents (by ``order``) as a new generation, and return its number.

        Readers see the old generation and its batches until the pointer is swapped, a failure before that changes
        nothing, and a generation may be written again. Run one compaction at a time. Later versions
        must be ordered by the same columns. ``buckets`` per collection default to one for two million
        documents of the average collection. Folders of older generations and batches stay where they are.
        """
        before = self.generation()
        done = self._batches()
        number = (before["generation"] if before else 0) + 1
        view = self.current(order)
        if buckets is None:
            sizes = self.registry().agg(F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("collections")).first()
            buckets = max(1, -(-(sizes["docs"] or 0) // (DOCS_PER_BUCKET * max(1, sizes["collections"]))))
        # Every attempt has a folder of its own, so one that failed is never mixed with the next.
        name = f"generation={number}-{uuid.uuid4().hex}"
        placed = view.withColumn(BUCKET, self._bucket(F.col(self.keys[-1]), buckets))
        keyed = placed.repartition(COLLECTION, BUCKET).sortWithinPartitions(COLLECTION, BUCKET, self.keys[-1])
        writer = keyed.withColumnRenamed("batch_id", "_batch_id").write.partitionBy(COLLECTION, BUCKET)
        writer.option(f"parquet.bloom.filter.enabled#{self.keys[-1]}", "true").parquet(f"{self.path}/base/{name}")
        included = set(done) | (set(range(before["upto"] + 1)) - set(before["gaps"]) if before else set())
        upto = max(included, default=-1)
        base = self.spark.read.schema(f"{COLLECTION} string").parquet(f"{self.path}/base/{name}")
        base.groupBy(COLLECTION).agg(F.count(F.lit(1)).alias("docs")).write.parquet(f"{self.path}/base_counts/{name}")
        pointer = {
            "generation": number,
            "folder": name,
            "buckets": buckets,
            "upto": upto,
            "gaps": sorted(set(range(upto + 1)) - included),
            "order": list(order),
            "schema": json.loads(view.schema.json()),
        }
        write_json(self.path, POINTER, pointer)
        return number

    # --- reading ---------------------------------------------------------------------------------

    def generation(self) -> dict | None:
        """The pointer to the current generation, None before the first."""
        return read_json(self.path, POINTER)

    def _batches(self, pointer: dict | None = None) -> list[int]:
        """Committed batches that are not in the generation."""
        pointer = pointer or self.generation()
        system, top = open_storage(f"{self.path}/manifest")
        found = system.get_file_info(pafs.FileSelector(top, allow_not_found=True, recursive=True))
        ids = sorted(int(f.path.rsplit("/", 2)[1].removeprefix("batch_id=")) for f in found if f.base_name == "_SUCCESS")
        return [i for i in ids if not pointer or i > pointer["upto"] or i in pointer["gaps"]]

    def rejects(self) -> DataFrame:
        """The rejected lines of all committed batches, compacted or not: ``batch_id``, the id and ``reject_fields`` as text."""
        batches = self._batches({"upto": -1, "gaps": []})
        columns = ["batch_id", self.keys[-1], *self.reject_fields]
        texts = [T.StructField(name, T.StringType()) for name in (*columns[1:], COLLECTION)]
        schema = T.StructType([*texts, T.StructField("batch_id", T.LongType())])
        if not batches:
            return self.spark.createDataFrame([], schema).select(*columns)
        folders = [f"{self.path}/documents/batch_id={i}" for i in batches]
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/documents").parquet(*folders)
        return stored.filter(F.col(COLLECTION) == REJECTED).select(*columns)

    def manifest(self) -> DataFrame:
        """Committed batches: ``batch_id, collection, docs``, also rejects and those that a generation has taken up."""
        schema = f"{COLLECTION} string, docs bigint, batch_id bigint"
        return self.spark.read.schema(schema).parquet(f"{self.path}/manifest").select("batch_id", COLLECTION, "docs")

    def registry(self) -> DataFrame:
        """Every collection, with its number of documents: those of the generation and the versions since."""
        pointer = self.generation()
        counts = self.manifest().filter(F.col(COLLECTION) != REJECTED).select(COLLECTION, "docs")
        if pointer:
            base = self.spark.read.schema(f"{COLLECTION} string, docs bigint").parquet(f"{self.path}/base_counts/{pointer['folder']}")
            counts = base.unionByName(self.manifest().filter(self._later(pointer) & (F.col(COLLECTION) != REJECTED)).select(COLLECTION, "docs"))
        return counts.groupBy(COLLECTION).agg(F.sum("docs").alias("docs"))

    @staticmethod
    def _later(pointer: dict) -> Column:
        return (F.col("batch_id") > pointer["upto"]) | F.col("batch_id").isin(pointer["gaps"])

    def _schemas(self, batches: list[int]) -> dict[int, T.StructType]:
        return {i: T.StructType.fromJson(read_json(f"{self.path}/schemas", f"{i}.json")) for i in batches}

    def _read(self, pointer: dict | None, batches: list[int]) -> tuple[DataFrame | None, DataFrame | None]:
        """Documents of the generation and of the batches, both with the schema that fits all."""
        schemas = self._schemas(batches)
        base_schema = T.StructType.fromJson(pointer["schema"]) if pointer else None
        fields = merged_schema([*([base_schema] if base_schema else []), *schemas.values()])
        wanted = [f for f in fields.fields if f.name not in (COLLECTION, "batch_id")]
        base = None
        if pointer:
            # Folder names are text: a collection called 20240101 or 2024-01-01 must not change type.
            plain = [T.StructField("_batch_id" if f.name == "batch_id" else f.name, f.dataType) for f in base_schema.fields]
            stored = self.spark.read.schema(T.StructType([*plain, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{self.path}/base/{pointer['folder']}")
            have = {f.name: f.dataType for f in base_schema.fields}
            base = stored.select(BUCKET, F.col("_batch_id").alias("batch_id"), COLLECTION, *(_as_type(f.name, have.get(f.name), f.dataType) for f in wanted))
        delta = None
        groups: dict[str, list[int]] = {}
        for i, own in schemas.items():
            groups.setdefault(own.json(), []).append(i)
        for text, ids in groups.items():
            own = T.StructType.fromJson(json.loads(text))
            have = {f.name: f.dataType for f in own.fields}
            read = T.StructType([*(T.StructField(f.name, f.dataType) for f in own.fields if f.name != COLLECTION), T.StructField(COLLECTION, T.StringType()), T.StructField("batch_id", T.LongType())])
            folders = [f"{self.path}/documents/batch_id={i}" for i in ids]
            stored = self.spark.read.schema(read).option("basePath", f"{self.path}/documents").parquet(*folders)
            stored = stored.filter(F.col(COLLECTION) != REJECTED)
            part = stored.select("batch_id", COLLECTION, *(_as_type(f.name, have.get(f.name), f.dataType) for f in wanted))
            delta = part if delta is None else delta.unionByName(part)
        return base, delta

    def documents(self) -> DataFrame:
        """All document versions since the last compaction, and the documents it kept, with their ``batch_id``."""
        pointer = self.generation()
        base, delta = self._read(pointer, self._batches(pointer))
        found = [d for d in (base.drop(BUCKET) if base is not None else None, delta) if d is not None]
        if not found:
            raise ValueError(f"{self.path}: nothing is committed yet")
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def current(self, order: tuple[str, ...] = ("batch_id", "seq")) -> DataFrame:
        """The newest version of every document.

        The generation is neither shuffled nor sorted: it passes by the documents that later batches have, a set
        that Spark broadcasts where it is small, and only what it has of those is compared with them.
        """
        return self._current(order, lambda df: df, F.lit(True))

    def _current(self, order: tuple[str, ...], chosen: Callable[[DataFrame], DataFrame], in_base: Column) -> DataFrame:
        pointer = self.generation()
        base, delta = self._read(pointer, self._batches(pointer))
        if base is None:
            return current_view(chosen(self.documents()), self.keys, list(order))
        if list(order) != pointer["order"]:
            raise ValueError(f"the log is compacted by {pointer['order']}")
        base = chosen(base.filter(in_base).drop(BUCKET))
        if delta is None:
            return base
        newest = current_view(chosen(delta), self.keys, list(order))
        changed = newest.select(*self.keys)
        touched = current_view(base.join(changed, self.keys, "left_semi").unionByName(newest), self.keys, list(order))
        return base.join(changed, self.keys, "left_anti").unionByName(touched)

    def newest(self, n: int, order: tuple[str, ...] = ("batch_id", "seq")) -> DataFrame:
        """The current documents of the ``n`` newest collections.

        The names come from the manifest; files of all other collections are never opened.
        """
        registry = self.registry()
        return self._current(order, lambda df: through_alias(df, n, registry), F.lit(True))

    @staticmethod
    def _bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")

    def lookup(self, ids: list[str], collection: str | None = None, order: tuple[str, ...] = ("batch_id", "seq")) -> DataFrame:
        """The current documents with one of a few ids, in one collection or in all.

        Of the generation only the buckets of the ids are opened, and of those only row groups whose Bloom filter
        does not exclude them; of later batches the files whose statistics or filters allow the ids.
        """
        pointer = self.generation()
        kind = F.col(self.keys[-1])
        wanted = kind.isin([str(i) for i in ids]) if collection is None else kind.isin([str(i) for i in ids]) & (F.col(COLLECTION) == collection)
        buckets = F.lit(True)
        if pointer:
            row = self.spark.range(1).select(*(self._bucket(F.lit(str(i)), pointer["buckets"]).alias(f"b{k}") for k, i in enumerate(ids))).first()
            buckets = F.col(BUCKET).isin(sorted(set(row)))
        return self._current(order, lambda df: df.filter(wanted), buckets)


def start_ingest(
    documents: DataFrame,
    log: DocumentLog,
    checkpoint: str,
    interval: str | None = None,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append a stream of documents to a log.

    Source offsets are committed only after the batch is, and a failed batch is repeated as a
    whole. ``interval`` (such as ``"500 milliseconds"``) sets how long documents may wait; without
    it everything available is processed and the query ends. ``per_batch`` holds steps that need
    a bounded input, such as load shedding.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log.append(batch if per_batch is None else per_batch(batch), batch_id)

    writer = documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def finish(query: StreamingQuery) -> None:
    """Process what has arrived, then stop: nothing stays buffered."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()
