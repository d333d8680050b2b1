"""Latency sketches: stated error, merging, values that are none."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.streaming import latency


def test_quantiles_within_the_stated_error(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(3, 2, 4000), [0.0, -1.0, 1e-9, 1e9]])
    rows = [("a", i // 100, float(v)) for i, v in enumerate(values)] + [("b", 0, 7.0), (None, 0, 5.0), ("c", 0, None), ("c", 0, math.nan), ("c", 0, math.inf), ("b", None, 1.0)]
    frame = spark.createDataFrame(rows, "endpoint string, minute int, millis double").withColumn("at", F.timestamp_seconds(F.col("minute") * 60))
    path = str(tmp_path / "sketches")
    for error in (0.01, 0.05):
        for batch, kept in enumerate((F.col("minute") < 20, F.col("minute") >= 20, F.col("minute") < 20)):
            latency.append_sketches(latency.latency_sketches(frame.filter(kept), ["endpoint"], "at", error=error), path, batch % 2)
        stored = latency.stored_sketches(spark, path)
        found = {(r.endpoint, r["quantile"]): r for r in latency.merged_quantiles(stored, ["endpoint"], [0, 0.5, 0.9, 1], error).collect()}
        ordered = np.sort(values)
        for q in (0.5, 0.9, 1):
            exact = ordered[max(0, math.ceil(q * len(ordered)) - 1)]
            assert found["a", q].n == len(values) and abs(found["a", q].value - exact) <= exact * (error + 1e-9)
        assert found["a", 0].value == 0.0 and found["b", 0.5].n == 1
        assert abs(found[None, 0.5].value - 5) <= 5 * error and not any(endpoint == "c" for endpoint, _ in found)
        per_minute = latency.merged_quantiles(stored, ["endpoint", "since"], [0.5], error)
        assert per_minute.filter("endpoint = 'a'").count() == 41
        assert latency.merged_quantiles(stored, [], [1], error).first().n == len(values) + 2
    assert latency.merged_quantiles(stored.limit(0), ["endpoint"], [0.5]).collect() == []
    with pytest.raises(ValueError):
        latency.merged_quantiles(stored, ["endpoint"], [1.5])
    with pytest.raises(ValueError):
        latency.latency_sketches(frame, ["endpoint"], "at", error=0.0)
