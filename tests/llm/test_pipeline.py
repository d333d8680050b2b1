"""The pipeline's stages, each judged on its own input."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from llm import minhash, mixing, suffix

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs)
    for name in list(seen)[:-1]:
        assert sorted(seen[name][1].columns) == sorted(columns)
    before, after = seen["language"]
    assert after.count() >= 0.95 * before.count()
    before, after = seen["near_duplicates"]
    kept = {r.doc_id for r in minhash.near_duplicates(before).collect() if r.kept}
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted(kept)
    before, after = seen["repeats"]
    cut = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(before).collect()}
    for r in after.collect():
        assert r.text == cut[r.doc_id].decode("utf-8", "ignore") and r.n_chars == len(r.text)
    before, after = seen["tokens"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert after.count() == before.count()
    assert all(len(r.ids) == 4 * r.n_tokens and (r.n_tokens > 0) == bool(texts[r.doc_id]) for r in after.collect())
    assert np.isfinite([r.n_tokens for r in after.collect()]).all()


def test_mixing_keeps_rows_without_id_and_the_order(spark, tmp_path):
    # Texts of different lengths; ids are missing, repeated or unique.
    rows = [(None if i % 3 == 0 else i // 6, " ".join([f"w{i}"] * (i + 1)), "en", "abc"[i % 7 % 3], i) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    want = [r.text for r in mixing.schedule(mixing.mix(docs, keep=("text",)), keep=("text",)).collect()]
    corpus_pipeline.mix_sources(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/out")
    parts = sorted((tmp_path / "out").glob("part-*"))
    got = [r for part in parts for r in spark.read.parquet(str(part)).collect()]
    assert [r.text for r in got] == want
    assert {tuple(r) for r in got} <= set(rows) and any(r.doc_id is None for r in got)


def test_cut_texts_keep_their_replacement_characters(spark, tmp_path):
    shared = "äöü" * 30
    # The repeat ends inside a character: ã is C3 A3, and C3 also follows the repeat in the first text.
    rows = [(1, "é" + shared + "ö"), (2, "one \ufffd two " + shared + "ã \ufffd\x1a\x1ab\x1aa"), (3, "\ufffd whole"), (None, "\ufffd" + shared)]
    table = [(i, t, "en", "a", len(t)) for i, t in rows]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    cut = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(docs).collect()}
    got = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, docs, SF_DIR).collect()}
    assert cut[2].startswith(b"one \xef\xbf\xbd two \xa3 ") and got[2].text == cut[2].decode("utf-8", "ignore") and got[2].text.count("\ufffd") == 2
    assert got[3].text == "\ufffd whole" and got[None].text == "\ufffd" + shared
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_cut_repeats_with_repeated_ids(spark):
    import hashlib

    passage = " ".join(f"word{i}" for i in range(30))
    texts = [passage + " one tail of its own that is long enough to count here", passage + " and another tail, which nobody else has in the table"]
    first, second = sorted(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    rows = [(1, passage, "en", "a", 0), (5, first, "en", "b", 0), (5, second, "en", "c", 0), (5, first, "de", "d", 0), (5, None, None, None, 0), (5, "short", "en", "e", 0)]
    rows += [(None, passage, "en", "f", 0), (7, second, "en", "g", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.source): (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    rest = first.removeprefix(passage)
    # Of the two texts of id 5 the one with the smaller digest takes part, in all its rows; the other one stays whole.
    assert got[5, "b"] == got[5, "d"] == (rest, len(rest))
    assert got[5, "c"] == (second, len(second))
    assert got[5, None] == (None, None) and got[5, "e"] == ("short", 5)
    assert got[1, "a"] == got[None, "f"] == (passage, len(passage))
    # Passage and blank stand together in a smaller id.
    assert got[7, "g"][0] == second.removeprefix(passage + " ")
    assert len(got) == len(rows)
