"""Each operator against brute force, on small tables with every awkward kind of row."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from llm import ann, bpe, chat, invertible, language, minhash, mixing, pseudo_likelihood, suffix, warc
from llm.common import gram_hashes, range_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, digest int, size int, b int"
WORDS = [f"w{i}" for i in range(400)]


def _texts() -> list[str | None]:
    rng = random.Random(5)
    make = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    base, passage = make(200), make(60)
    words = base.split(" ")
    near = [" ".join(w if rng.random() > 0.01 else "x" for w in words) for _ in range(12)]
    chain = [" ".join(words[i : i + 150]) for i in range(0, 50, 5)]
    texts = [None, "", "   \n\t ", "one", "One two THREE", "one  two\nthree", base, base, base.upper(), *near, *chain]
    texts += [make(30) + passage + make(30), passage, make(5) + passage + "é😀", "a" * 400, "ab" * 300, "a" * 90]
    texts += ["!!! 123 ???", "Äpfel und Öl, straße", make(4000), "\n".join(make(6) for _ in range(300)), "x\x00y" * 30, "z" * 49, "z" * 50, "z" * 51]
    return texts


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """Rows with nulls, repeats and other columns whose names the operators use inside; as files."""
    rows = [(i, t, ["en", "de", None][i % 3], [None, "b", "a", "a"][i % 4], None, "q", 1, 2, 3) for i, t in enumerate(_texts())]
    folder = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _shingles(text: str | None) -> set:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _groups(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {d: _shingles(t) for d, t in texts.items()}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def test_near_duplicates(spark, docs, empty):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    groups = _groups(texts)
    assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == {
        d: (len(_shingles(t)), groups[d], groups[d] == d) for d, t in texts.items()
    }
    assert minhash.near_duplicates(empty).count() == 0
    loose = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, None)], "doc_id long, text string")
    rows = sorted(map(tuple, minhash.near_duplicates(loose).collect()), key=str)
    assert rows == sorted([(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (2, 0, 2, True)], key=str)


def test_many_near_copies_stay_connected(spark):
    # Copies that each resemble the original, but often not one another.
    rng = random.Random(2)
    words = [f"t{i}" for i in range(120)]
    texts = {0: " ".join(words)}
    for i in range(1, 700):
        copy = list(words)
        for at in rng.sample(range(120), 3):
            copy[at] = f"n{i}x{at}"
        texts[i] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = _groups(texts)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == want


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.5, 0.75, 0.9):
        found = []
        for _ in range(60):
            common = rng.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64) * np.uint64(2)
            sides = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 1000 - len(common), dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for _ in range(2)]
            a, b = (minhash.sketch(s) for s in sides)
            n = np.array([1000])
            found.append(minhash.estimate(np.array([(a == b).sum()]), n, n)[0])
        true = share / (2 - share)
        assert abs(np.mean(found) - true) < 0.03


def _without_repeats(texts: list[tuple[int, bytes]]) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    for d, x in sorted(texts):
        for i in range(len(x) - 49):
            first.setdefault(x[i : i + 50], d)
    out = {}
    for d, x in texts:
        gone = bytearray(len(x))
        for i in range(len(x) - 49):
            if first[x[i : i + 50]] < d:
                gone[i : i + 50] = b"1" * 50
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(x), len(x) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def _cuts(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in suffix.remove_repeats(df).collect()}


def test_repeats_are_removed(spark, docs, empty, monkeypatch):
    want = _without_repeats([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])
    assert _cuts(docs) == want
    # Hot anchors, several shards and several parts per shard give the same.
    for name, value in (("HOT", 2), ("SHARD_BYTES", 1 << 12), ("PART_BYTES", 1 << 11)):
        monkeypatch.setattr(suffix, name, value)
    assert _cuts(docs) == want
    assert suffix.remove_repeats(empty).count() == 0
    loose = spark.createDataFrame([(None, "q" * 80), (3, "q" * 80), (3, "q" * 80), (3, "r" * 60), (9, "r" * 70)], "doc_id long, text string")
    removed = sorted((r.doc_id or 0, r.n_removed) for r in suffix.remove_repeats(loose).collect())
    assert removed == [(0, 0), (3, 0), (3, 0), (3, 0), (9, 70)]


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for letters, n in ((1, 200), (2, 500), (4, 3000)):
        text = rng.integers(97, 97 + letters, n).astype(np.uint8)
        raw = text.tobytes()
        order, rank = suffix.suffix_array(text)
        cut = [raw[i : i + 50] for i in order]
        assert cut == sorted(cut) and sorted(order.tolist()) == list(range(n))
        shared = suffix.common_prefixes(text, order, rank)
        for i in range(1, n):
            a, b = raw[order[i - 1] :], raw[order[i] :]
            k = 0
            while k < min(len(a), len(b), 50) and a[k] == b[k]:
                k += 1
            assert shared[i] == k


def test_equal_windows_before_zero_bytes():
    """Zeros behind the text, which fill the last words, are none of its bytes."""
    rng = np.random.default_rng(3)
    for letters, n in ((1, 73), (1, 119), (2, 458), (1, 2303)):
        text = np.concatenate([rng.integers(0, letters, n), np.zeros(60, np.int64)]).astype(np.uint8)
        starts, opens = suffix.equal_windows(text, np.arange(len(text)) <= len(text) - 50)
        groups = np.split(starts, np.flatnonzero(opens)[1:])
        windows = [{text[i : i + 50].tobytes() for i in g} for g in groups]
        assert all(len(w) == 1 for w in windows) and len(set.union(*windows)) == len(groups)
        assert sorted(starts.tolist()) == list(range(len(text) - 49))


def test_suffixes_cost_a_few_sorts():
    """Prefixes are compared by eight bytes and groups sorted as plain numbers; byte by byte took twice the time."""
    rng = np.random.default_rng(4)
    source = rng.integers(97, 123, 120_000).astype(np.uint8)
    text = np.concatenate([source[i : i + 400] for i in rng.integers(0, len(source) - 400, 2500)])
    key = rng.integers(0, 1 << 62, len(text)).astype(np.uint64)
    ratios = []
    for _ in range(3):
        at = time.process_time()
        np.argsort(key)
        one = time.process_time()
        suffix.equal_windows(text, np.ones(len(text), bool))
        ratios.append((time.process_time() - one) / (one - at))
    assert min(ratios) < 12


def test_hashes_in_a_row_equal_those_of_ranges():
    data = np.random.default_rng(5).integers(0, 256, 70_000).astype(np.uint8)
    for width in (1, 25, 50):
        at = np.arange(len(data) - width + 1)
        assert (gram_hashes(data, width) == range_hashes(data, at, at + width)).all()
    assert not len(gram_hashes(data[:24], 25))


def test_fingerprints(spark, docs, empty):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in invertible.fingerprints(docs).collect()}
    prints = {}
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        own, new, other = (set(t.split("\n")) for t in (text, edited, after))
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(len(own & new) / len(own | new))
        assert r.near_next == pytest.approx(len(own & other) / len(own | other))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert invertible.fingerprints(empty).count() == 0
    one = spark.createDataFrame([(None, "abc\nd"), (None, "abc\nd")], "doc_id long, text string")
    assert [(r.doc_id, r.near_next) for r in invertible.fingerprints(one).collect()] == [(None, 1.0)] * 2


def test_peeling_recovers_the_differing_digests(spark):
    rng = random.Random(1)
    rows = []
    for i, n in enumerate((0, 1, 3, 5, 40, 900)):
        common = [rng.getrandbits(62) for _ in range(20)]
        rows.append((i, common + [rng.getrandbits(62) for _ in range(n)], common + [rng.getrandbits(62) for _ in range(n // 2)]))
    pairs = spark.createDataFrame(rows, "row long, left array<long>, right array<long>")
    assert dict(map(tuple, invertible.differences(pairs).collect())) == {i: len(set(a) ^ set(b)) for i, a, b in rows}
    level = F.lit(0)
    cells = invertible.subtract(invertible.sketch(F.col("left"), level), invertible.sketch(F.col("right"), level))
    found = pairs.filter("row = 2").select(invertible.peel(cells, level, F.lit(18)).alias("f")).first().f
    assert {(f.d, f.sign) for f in found} == {(d, 1) for d in set(rows[2][1]) - set(rows[2][2])} | {(d, -1) for d in set(rows[2][2]) - set(rows[2][1])}


def test_byte_bpe(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = bpe.Vocabulary.read(path, public_tokenizers.PATTERN)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: r for r in bpe.encode(docs, vocabulary).collect()}
    for d, text in texts.items():
        assert np.frombuffer(got[d].ids, "<u4").tolist() == known.encode_ordinary(text)
        assert bytes(got[d].decoded) == text.encode()
    assert bpe.encode(empty, vocabulary).count() == 0
    for word in ("abcabc" * 200, "ééé" * 150, "𝟘" * 100):
        assert bpe.encode_long(word.encode(), ranks) == known._encode_single_piece(word)


def test_language(spark, docs, empty):
    rng = random.Random(3)
    kinds = {"en": "the of and ing tion er".split(), "de": "der und ung schen ein ür".split(), "fr": "les eau que ion é ez".split()}
    rows = [(i, " ".join("".join(rng.choices(parts, k=2)) for _ in range(40)), lang) for i, (lang, parts) in enumerate(list(kinds.items()) * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(language.learning_rows(df), per_language=60)
    told = language.identify(df, model).select("doc_id", "lang", "language.*").collect()
    assert np.mean([r.lang_pred == r.lang for r in told]) > 0.98 and all(0 <= r.score <= 1 for r in told)
    odd = {r.doc_id: r.language for r in language.identify(docs, model).collect()}
    for d, text in {r.doc_id: r.text for r in docs.collect()}.items():
        none = not any(map(str.isalpha, text or ""))
        assert (odd[d].lang_pred == "und") == none and (not none or (odd[d].score == 0 and odd[d].rejected))
    assert language.identify(empty, language.fit(empty)).count() == 0
    assert language.identify(docs, language.fit(empty)).filter("language.lang_pred <> 'und'").count() == 0


def test_pseudo_likelihood(spark, docs, empty):
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    network = pseudo_likelihood.train(texts)
    got = {r.id: r for r in pseudo_likelihood.score(texts, network).collect()}
    share = network.log_share()
    for r in texts.collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower())
        assert got[r.id].n_tokens == len(words)
        if len(words) > 300 or not words:
            continue
        from llm.common import word_hashes

        classes = network.classes(word_hashes([(r.text or "").encode()])[0])
        embedding, w1, b1, outer, within = (w.astype(np.float64) for w in network.weights)
        width = within.shape[1]
        total = 0.0
        for i, own in enumerate(classes):
            near = [classes[j] if 0 <= j < len(classes) else pseudo_likelihood.PAD for j in (i - 2, i - 1, i + 1, i + 2)]
            hidden = np.append(np.tanh(np.concatenate([embedding[c] for c in near]) @ w1 + b1), 1)
            # A class is as likely as its group, times its chance within the group.
            for z, place in ((outer @ hidden, own // width), (within[own // width] @ hidden, own % width)):
                total += z[place] - np.log(np.exp(z).sum())
            total += share[own]
        assert got[r.id].log_prob == pytest.approx(total, rel=1e-4)
    blank = pseudo_likelihood.Network(network.frequent, network.spread, pseudo_likelihood.initial())
    untrained = sum(r.log_prob for r in pseudo_likelihood.score(texts, blank).collect())
    assert sum(r.log_prob for r in got.values()) > untrained
    assert got[0].log_prob == 0 and got[0].per_token is None
    assert pseudo_likelihood.pseudo_likelihood(empty).count() == 0


def test_pseudo_likelihood_task_takes_one_core(spark):
    """Steps of a task run in its own thread: OpenBLAS's threads spun on all cores over the small products."""

    def timed(batches):
        import math
        import time

        from llm.common import one_blas_thread

        one_blas_thread()
        rng = np.random.default_rng(0)
        weights = pseudo_likelihood.initial(1064)
        line, at = pseudo_likelihood._lined_up(rng.integers(0, 1064, 100_000).astype(np.int32), np.full(500, 200), 1064)
        for _ in batches:
            pass
        cpu, wall = time.process_time(), time.perf_counter()
        for lo in range(0, len(at), 4096):
            near, own = pseudo_likelihood._piece(line, at, lo, 4096)
            pseudo_likelihood.descend(weights, near, own, 0.5 * math.sqrt(len(own) / 256))
        yield pa.RecordBatch.from_arrays([pa.array([(time.process_time() - cpu) / (time.perf_counter() - wall)])], names=["ratio"])

    import pyarrow as pa

    (ratio,) = spark.range(1, numPartitions=1).mapInArrow(timed, "ratio double").first()
    assert ratio < 1.5


def test_classes_of_all_groups_sum_to_one():
    weights = pseudo_likelihood.initial(300)
    weights = [w + np.random.default_rng(1).normal(0, 0.3, w.shape).astype(np.float32) * (w > -1) for w in weights]
    pad, total = 300, 0.0
    for own in range(300):
        line, at = pseudo_likelihood._lined_up(np.array([5, 7, own, 9, 299]), np.array([5]), pad)
        total += np.exp(pseudo_likelihood.log_softmax_at(weights, line, at)[2])
    assert total == pytest.approx(1, abs=1e-4)


def test_pseudo_likelihood_step_goes_down_the_gradient():
    rng = np.random.default_rng(2)
    weights = [w + rng.normal(0, 0.2, w.shape).astype(np.float32) for w in pseudo_likelihood.initial(40)]
    # Documents without words, of one word and of several lie side by side.
    line, at = pseudo_likelihood._lined_up(rng.integers(0, 40, 60), np.array([0, 1, 29, 0, 2, 28]), 40)
    loss = lambda w: -pseudo_likelihood.log_softmax_at(w, line, at).astype(np.float64).mean()
    after = [w.copy() for w in weights]
    pseudo_likelihood.descend(after, line, at, 1e-2)
    for k in range(5):
        moved = [*weights[:k], after[k], *weights[k + 1 :]]
        # Along a gradient step of length r the loss falls by the squared step over r.
        assert loss(weights) - loss(moved) == pytest.approx(((after[k] - weights[k]) ** 2).sum() / 1e-2, rel=0.1, abs=2e-5)


def test_pseudo_likelihood_learns_from_every_place(spark):
    # Every eighth word is another one than those between, which a stride of 8 or 16 never meets.
    text = " ".join("rare" if i % 8 == 0 else "often" for i in range(32_000))
    row = pseudo_likelihood.pseudo_likelihood(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_tokens == 32_000 and row.per_token > -1


def test_rare_words_are_told_apart_by_their_counts(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "FREQUENT", 4)
    # w1 is seen once, w90 ninety times; each stands alone in documents of its own.
    rows = [(i, f"w{i}") for i in range(1, 91) for _ in range(i)] + [(None, "w7"), (5, "w8"), (100, None)]
    texts = spark.createDataFrame(rows, "id long, text string").repartition(3)
    network = pseudo_likelihood.train(texts)
    assert len(network.frequent) == 9 and sum(network.spread) == len(rows) - 1 - sum(range(82, 91))
    scored = pseudo_likelihood.score(texts, network).collect()
    assert len(scored) == len(rows)
    assert sorted((r.id or 0, r.n_tokens) for r in scored) == sorted((i or 0, int(t is not None)) for i, t in rows)
    from llm.common import word_hashes

    # All documents have the same context, so words of a bucket differ by their counts alone.
    classes = dict(zip(range(1, 91), network.classes(word_hashes([f"w{i}".encode() for i in range(1, 91)])[0]), strict=True))
    own = {r.id: r.log_prob for r in scored if r.id and r.id != 5 and r.n_tokens}
    for a in own:
        for b in own:
            if classes[a] == classes[b]:
                assert own[a] - own[b] == pytest.approx(np.log(a + (a in (7, 8))) - np.log(b + (b in (7, 8))), abs=1e-6)


def _brute(rows, ids, k=10):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8}
    out = {}
    for q in ids & usable.keys():
        ranked = sorted((float(np.sqrt(((v - usable[q]) ** 2).sum())), i) for i, v in usable.items() if i != q)[:k]
        out[q] = [i for _, i in ranked]
    return out


def test_tree_search(spark, monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 1, (12, 8))
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.3, 8)).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(2000 + i, [1.0] * 8) for i in range(300)]
    rows += [(5000, None), (5001, [0.0] * 8), (5002, [float("nan")] * 8), (5003, [None, 1.0] * 4), (5004, [1.0, 2.0]), (None, [1.0] * 8), rows[7], rows[100]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, leaf string")
    monkeypatch.setattr(ann, "PIECE_ROWS", 64)
    got: dict[int, list] = {}
    for r in ann.search(df, lambda vec_id: vec_id % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = _brute(rows, set(range(0, 6000, 100)))
    assert got.keys() == want.keys() and all(len(set(v)) == 10 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    assert got[2000] == want[2000]
    few = df.filter("vec_id IN (0, 1, 2)")
    assert sorted(r.vec_id for r in ann.search(few, lambda v: v % 100 == 0).collect()) == [1, 2]
    assert ann.search(df.limit(0), lambda v: v % 100 == 0).count() == 0


def test_warc(spark, empty):
    noise = random.Random(4)
    pages = [(i, f"http://h/é {i}\r\n", "".join(chr(noise.randrange(32, 0x2FF)) for _ in range(noise.randrange(3000)))) for i in range(60)]
    pages += [(100, "u", "same"), (101, None, "same"), (102, "v", "same"), (102, "v", "same"), (103, "w", None), (104, "w", ""), (None, "x", "same"), (None, None, "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha1", F.lit(1)).withColumn("n", F.lit(2))
    files = warc.archive(spark, df)
    first: dict[str, int] = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = max(first.get(html or "", -1), i)
    want = []
    for i, _, html in pages:
        raw = (html or "").encode()
        refers = first.get(html or "") if first.get(html or "") != i else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), digest, "revisit" if refers is not None else "response", refers, None if refers is not None else raw))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    for split in (97, 1000, 1 << 22):
        rows = [tuple(r[:5]) + (None if r[5] is None else bytes(r[5]),) for r in warc.read_archives(files, split).select(*columns).collect()]
        assert sorted(rows, key=str) == sorted(want, key=str)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.archive(spark, none)).count() == 0


def test_chat(spark, monkeypatch):
    rows = [(1, 2, "b", "two"), (1, 1, "a", "one"), (1, 1, "system", "be kind"), (1, None, None, None), (1, 3, "b", "two"), (None, 0, "a", "x"), (2, 0, "system", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("c")).withColumn("part", F.lit(9))
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.rotate(df).collect()}
    assert got.keys() == {(1, s, p) for s in ("a", "b", "unknown") for p in (0, 1)} | {(None, "a", 0)}
    r = got[1, "b", 0]
    assert r.text + got[1, "b", 1].text == "<|user|>a: one<|end|>\n<|system|>be kind<|end|>\n<|assistant|>two<|end|>\n<|assistant|>two<|end|>\n<|user|>unknown: <|end|>\n"
    assert [r.text[s.start : s.end] for s in r.spans] == ["two<|end|>\n"] * 2
    assert chat.rotate(df.limit(0)).count() == 0
    long = spark.range(1000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'a', 'b') AS role", "concat('t', id) AS text")
    parts = chat.rotate(long.union(long.withColumn("turn", F.lit(5)))).filter("speaker = 'a'").orderBy("part").collect()
    assert len(parts) > 4 and max(p.n_turns for p in parts) == 256 and sum(p.n_turns for p in parts) == 2000


def test_warc_candidates_need_a_whole_header():
    import io
    import zlib

    class Archive(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    real = warc.record(7, "u" * 9000, b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    fakes = [b"WARC/1.1\r\nno field\r\n\r\n", b"WARC/1.0", b"WARC/1.1\r\nWARC-Type: response\r\n\r\nx", b"WARC/1.1\r\n\xff: 1\r\n\r\n", b"text"]
    packed = lambda body: (z := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(body) + z.flush()
    archive = Archive(b"".join(packed(f) + real for f in fakes) + packed(fakes[0]))
    bodies = list(warc.records_in_range(archive, 0, archive.size()))
    assert [warc.parse(b)["page_id"] for b in bodies] == [7] * len(fakes)


def test_archives_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 500)
    noise = random.Random(6)
    pages = [(i, "u", "".join(chr(noise.randrange(32, 0x2FF)) for _ in range(400))) for i in range(50)]
    files = warc.archive(spark, spark.createDataFrame(pages, "page_id long, url string, html string"))
    read = warc.read_archives(files, 500)
    total = sum(-(-r.bytes // 500) for r in files.collect())
    assert read.rdd.getNumPartitions() == total > 20 and read.count() == 50


def test_positions_are_the_summed_demand(spark):
    rows = [(i, " ".join("w" * (1 + i % 7)), "abc"[i % 3]) for i in range(900)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    total = sum(r.taken for r in mixed)
    assert {r.mix_size for r in mixed} == {total}
    # A copy's position is the number of words that all copies due before it have.
    copies = []
    for r in mixed:
        assert len(r.positions) == -(-r.taken // r.size)
        # Whole passes come first, a cut copy last.
        sizes = [min(r.size, r.taken - k * r.size) for k in range(len(r.positions))]
        copies += zip(r.positions, sizes, strict=True)
    before = 0
    for position, size in sorted(copies):
        assert abs(position * total - before - size / 2) < 0.02 * total
        before += size
    assert before == total


def test_mixing(docs, empty):
    sizes: dict = {}
    rows = mixing.mix(docs).collect()
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    assert {r.source: r.source_size for r in rows} == sizes
    weights = dict(zip(["a", "b", None], [5, 2, 1], strict=True))
    left, targets, free = 1.5 * sum(sizes.values()), {}, set(sizes)
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 2 * sizes[s]}
        for s in over or free:
            targets[s] = 2 * sizes[s] if over else level * weights[s]
        left -= sum(2 * sizes[s] for s in over)
        free -= over or free
    for source in sizes:
        own = [r for r in rows if r.source == source]
        assert own[0].target == pytest.approx(targets[source])
        assert abs(sum(r.taken for r in own) - targets[source]) <= 0.5
        assert all(0 <= r.taken <= 2 * r.size and len(r.positions) <= 2 for r in own)
    copies = mixing.schedule(mixing.mix(docs)).collect()
    assert [c.position for c in copies] == sorted(c.position for c in copies) and all(0 <= c.position <= 1 for c in copies)
    assert mixing.mix(empty).count() == 0


def test_training_time_inverts_the_schedule(spark):
    grid = spark.range(101).select((F.col("id") / 100).alias("share"))
    for slope in mixing.SLOPES:
        for r in grid.select("share", mixing.training_time(F.col("share"), F.lit(slope)).alias("t")).collect():
            assert slope * r.t**2 + (1 - slope) * r.t == pytest.approx(r.share)
