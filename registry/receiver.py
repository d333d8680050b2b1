"""A receiver of requests for the delivery queries: what it accepts can be read back as a table."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.sources.storage import open_storage


class Receiver:
    """Keeps every accepted request as a line of JSON, a file per task and endpoint, in the shared folder.

    ``down`` endpoints refuse everything; with ``flaky`` the connection is lost at the first attempt of each request.
    A request that arrives again, as after a lost task, counts once.
    """

    def __init__(self, folder: str, down: tuple[str, ...] = (), flaky: bool = False):
        self.folder, self.down, self.flaky = folder, down, flaky
        self.tried: str | None = None
        self.names: dict[str, str] = {}

    def __call__(self, endpoint: str, collection: str, documents: list[str]) -> None:
        if endpoint in self.down:
            raise ConnectionError(f"endpoint {endpoint} is down")
        request = hashlib.sha256("\n".join([collection, *documents]).encode()).hexdigest()
        if self.flaky and request != self.tried:
            self.tried = request
            raise ConnectionError("connection lost")
        system, top = open_storage(self.folder)
        if endpoint not in self.names:
            context = TaskContext.get()
            system.create_dir(f"{top}/endpoint={endpoint}", recursive=True)
            self.names[endpoint] = f"endpoint={endpoint}/{context.taskAttemptId() if context else 0}-{uuid.uuid4().hex}.json"
        line = json.dumps({"request": request, "collection": collection, "docs": documents})
        with system.open_append_stream(f"{top}/{self.names[endpoint]}", compression=None) as out:
            out.write(line.encode() + b"\n")

    def arrived(self, spark: SparkSession, fields: str) -> DataFrame:
        """The documents that arrived, with ``endpoint, collection, request`` and the ``size`` of their request."""
        stored = spark.read.schema("request string, collection string, docs array<string>, endpoint string").json(self.folder)
        once = stored.dropDuplicates(["endpoint", "request"])
        single = once.select("endpoint", "collection", "request", F.size("docs").alias("size"), F.explode("docs").alias("doc"))
        return single.select("endpoint", "collection", "request", "size", F.from_json("doc", fields).alias("d")).select(
            "endpoint", "collection", "request", "size", "d.*"
        )
