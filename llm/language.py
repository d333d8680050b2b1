"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are runs of 2 to 4 bytes of the lower-cased text, where everything but letters counts as one
word boundary. Each is hashed to a bucket with an embedding; the mean embedding of a text goes through
a linear softmax. Both are trained by stochastic gradient descent in numpy. Confidence is
calibrated by a temperature, and a text whose calibrated confidence lies below what nearly all
correctly recognised texts reach is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow.operators.ranking import first_per_group
from llm.common import byte_chunks, tidy, written

BUCKETS = 1 << 13
LENGTHS = (2, 3, 4)
UNKNOWN = "und"

_PROFILE = "lang string, rank int, bucket array<int>, part array<float>"
_PROFILE_SCHEMA = pa.schema(
    [("lang", pa.string()), ("rank", pa.int32()), ("bucket", pa.list_(pa.int32())), ("part", pa.list_(pa.float32()))]
)

_LETTER = np.zeros(256, np.uint8) + 32
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _normal(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters with single blanks between words, and where each text starts."""
    # Three blanks between texts: no subword reaches from one into the next after collapsing.
    raw = np.frombuffer(b" " + b"\n".join(texts) + b" ", np.uint8)
    data = _LETTER[raw]
    # Capitals of the Latin-1 block: two bytes, the second one is 32 below its small letter.
    capital = np.zeros(len(raw), bool)
    capital[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    data = np.where(capital, data + 32, data).astype(np.uint8)
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], kept[firsts]


def subword_buckets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the buckets of all its subwords, repeats included."""
    for first, last in byte_chunks(texts):
        data, starts = _normal(texts[first:last])
        codes = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
        found = []
        for n in LENGTHS:
            gram = np.full(len(data), n, np.uint32)
            for j in range(n):
                gram = gram * np.uint32(0x01000193) ^ codes[j : j + len(data)]
            gram = gram * np.uint32(0x9E3779B1)
            found.append((gram >> np.uint32(32 - 13)).astype(np.int32))
        stacked = np.stack(found)
        for i in range(last - first):
            # A text owns the blank before its first word; subwords end with the blank after its last.
            lo, hi = int(starts[i]), min(int(starts[i + 1]) + 1, len(data))
            yield np.concatenate([stacked[j, lo : max(lo, hi - n + 1)] for j, n in enumerate(LENGTHS)])


@dataclass
class Model:
    """Learned languages, their logits per bucket (embedding times softmax), and the calibration."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def raw(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        for i, buckets in enumerate(subword_buckets(texts)):
            if len(buckets):
                counts = np.bincount(buckets, minlength=BUCKETS)
                out[i] = counts @ self.logits / len(buckets)
        return out + self.bias

    def probabilities(self, raw: np.ndarray) -> np.ndarray:
        z = raw / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _descend(x: np.ndarray, y: np.ndarray, use: np.ndarray, classes: int, dim: int, epochs: int, rate: float, seed: int):
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (x.shape[1], dim)).astype(np.float32)
    weights = rng.normal(0, 0.1, (dim, classes)).astype(np.float32)
    bias = np.zeros(classes, np.float32)
    # Bucket frequencies are tiny: one common scale makes the steps independent of the text length.
    scale = np.float32(x.shape[1] ** 0.5)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(use), max(1, len(use) // 32)):
            batch = x[rows] * scale
            hidden = batch @ embedding
            z = hidden @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = p @ weights.T
            weights -= step * (hidden.T @ p)
            bias -= step * p.sum(axis=0)
            embedding -= step * (batch.T @ back)
    return (embedding @ weights * scale).astype(np.float64), bias.astype(np.float64)


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 500,
    dim: int = 16,
    epochs: int = 30,
    rate: float = 0.5,
    lost: float = 0.001,
) -> Model:
    """Train on at most ``per_language`` labelled texts of each language, chosen by a hash of the id.

    Rows without text or language teach nothing. A fifth of the sample is kept back: it sets the
    temperature (least log loss) and the rejection threshold, which at most a share of ``lost`` of
    its correctly recognised texts stays below. Without any labelled text the model knows no
    language and answers ``und``.
    """
    usable = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    # Keys are ranked without their texts, in parts of a language first; then the chosen texts are fetched.
    keyed = usable.withColumn("key", F.struct("id", "lang", F.xxhash64("text").alias("mark")))
    order = [F.xxhash64("key.id"), "key.id", "key.mark"]
    keys = first_per_group(keyed.select("key", "lang"), ["lang"], order, per_language, salts=64)
    ranked = keys.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    places = written(ranked.groupBy("key").agg(F.min("rank").alias("rank")), "language-sample")
    chosen = keyed.join(places, "key").dropDuplicates(["key"])

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            kept = [np.unique(b, return_counts=True) for b in subword_buckets(texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("rank"),
                    pa.array([k.astype(np.int32) for k, _ in kept], pa.list_(pa.int32())),
                    pa.array([(n / max(1, n.sum())).astype(np.float32) for _, n in kept], pa.list_(pa.float32())),
                ],
                names=["lang", "rank", "bucket", "part"],
            )

    # A bounded sample: one task trains on all of it, and only the model comes to the driver.
    profiles = chosen.select("lang", "rank", "text").mapInArrow(profile, _PROFILE)
    schema = "languages array<string>, logits binary, bias binary, temperature double, threshold double"
    found = profiles.repartition(1).mapInArrow(_trainer(dim, epochs, rate, lost), schema).first()
    if found is None:
        return _unlearned()
    languages = list(found["languages"])
    logits = np.frombuffer(found["logits"], "<f8").reshape(BUCKETS, len(languages))
    return Model(languages, logits, np.frombuffer(found["bias"], "<f8"), found["temperature"], found["threshold"])


def _unlearned() -> Model:
    return Model([UNKNOWN], np.zeros((BUCKETS, 1)), np.zeros(1))


def _trainer(dim: int, epochs: int, rate: float, lost: float):
    """Of the profiles in a partition, one row with the model's parts."""

    @tidy
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _trained(pa.Table.from_batches(batches, _PROFILE_SCHEMA), dim, epochs, rate, lost)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([m.languages], pa.list_(pa.string())),
                pa.array([m.logits.astype("<f8").tobytes()], pa.binary()),
                pa.array([m.bias.astype("<f8").tobytes()], pa.binary()),
                pa.array([m.temperature]),
                pa.array([m.threshold]),
            ],
            names=["languages", "logits", "bias", "temperature", "threshold"],
        )

    return train


def _trained(rows: pa.Table, dim: int, epochs: int, rate: float, lost: float) -> Model:
    """The model of ``lang, rank, bucket, part``, one row per text."""
    if rows.num_rows == 0:
        return _unlearned()
    rows = rows.sort_by([("lang", "ascending"), ("rank", "ascending")])
    names = rows.column("lang").to_pylist()
    languages = sorted(set(names))
    y = np.array([languages.index(n) for n in names])
    x = np.zeros((len(names), BUCKETS), np.float32)
    # Straight from the Arrow lists: as Python objects they would take gigabytes.
    lists = rows.column("bucket").combine_chunks()
    counts = np.diff(np.asarray(lists.offsets))
    x[np.repeat(np.arange(len(names)), counts), lists.flatten().to_numpy()] = rows.column("part").combine_chunks().flatten().to_numpy()
    held = np.arange(len(y)) % 5 == 4
    if held.sum() < 5:
        held[:] = False
    logits, bias = _descend(x, y, np.flatnonzero(~held), len(languages), dim, epochs, rate, seed=11)
    model = Model(languages, logits, bias)
    if held.any():
        raw, truth = x[held] @ logits + bias, y[held]
        losses = []
        for t in np.geomspace(0.05, 20, 60):
            model.temperature = t
            losses.append((-np.log(model.probabilities(raw)[np.arange(len(truth)), truth] + 1e-12).mean(), t))
        model.temperature = float(min(losses)[1])
        p = model.probabilities(raw)
        sure = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
        if len(sure):
            # Never above one half: a text with a majority language is not thrown away.
            model.threshold = float(min(0.5, sure[int(lost * len(sure))]))
    return model


def identify(documents: DataFrame, model: Model, text_col: str = "text", name: str = "language") -> DataFrame:
    """All columns of ``documents`` and a struct ``name``: ``lang_pred, score, rejected``.

    The whole text counts. A NULL text, or one without a letter, is ``und`` with score 0 and
    rejected. Otherwise ``lang_pred`` is the most probable learned language (ties to the first by
    name), ``score`` its calibrated probability, and ``rejected`` tells whether that is below the
    threshold. An existing column ``name`` is replaced.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            lettered = [t is not None and any(map(str.isalpha, t)) for t in part]
            texts = [t.encode("utf-8", "surrogatepass") for t, ok in zip(part, lettered, strict=True) if ok]
            p = model.probabilities(model.raw(texts)) if texts else np.zeros((0, 1))
            best = p.argmax(axis=1)
            at = iter(range(len(texts)))
            rows = []
            for ok in lettered:
                if ok:
                    i = next(at)
                    score = float(p[i, best[i]])
                    unknown = model.languages == [UNKNOWN]
                    rows.append((model.languages[best[i]], 0.0 if unknown else score, unknown or score < model.threshold))
                else:
                    rows.append((UNKNOWN, 0.0, True))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    # Not to be repeated for a filter on its result: a text is read once.
    return documents.withColumn(name, predict.asNondeterministic()(F.col(text_col)))


def learning_rows(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows a model may learn from: all but those whose id falls into the held-out quarter."""
    return documents.filter(F.crc32(F.col(id_col).cast("string")) % 4 != 2)
