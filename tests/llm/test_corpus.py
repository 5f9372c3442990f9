"""Corpus operators against plain Python on small tables with nulls, empty and long texts, ties and repeats."""

import gzip
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallybook.llm import bpe, decontam, graph, jaccard, langid, lines, packing, quality, substring, vectors, warc

SF = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").encode().split()


BASE = " ".join(f"w{i}" for i in range(80))
NEAR = BASE.replace("w40 ", "other ")
EDGE = [
    (1, BASE),
    (2, NEAR),
    (3, "intro here " + BASE + " the end"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "a " * 60),
    (8, "one word\x1cstill"),
    (9, " ".join(str(i * i % 9973) for i in range(60_000))),
    (10, BASE),
    (10, BASE),
    (None, "No id but a text of its own"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in EDGE], "doc_id long, text string, id string, key int")


@pytest.fixture(scope="module")
def nothing(edge):
    return edge.where("false")


def test_substring_removes_what_repeats(edge, nothing):
    counts = Counter(tuple(w[i : i + 35]) for w in (words_of(t) for _, t in EDGE) for i in range(len(w) - 34))
    want = []
    for i, text in EDGE:
        w = words_of(text)
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if counts[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    got = substring.dedup(edge).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert substring.dedup(nothing).count() == 0


def brute_links(rows):
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i, len(s), least.get(top(k), i)) for k, (i, s) in enumerate(sets)), key=str)


def test_jaccard_links_as_brute_force(spark, edge, nothing):
    got = jaccard.link(edge).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute_links(EDGE)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = jaccard.link(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute_links([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert jaccard.link(nothing).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (500, 500)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()))
    assert len({got[k] for k in range(1, 41)}) == len({got[k] for k in range(100, 130)}) == 1
    assert got[1] != got[100] and 500 not in got
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_leaks_are_found_with_substitutions_and_clean_texts_stay(spark, edge, nothing):
    item = [f"q{i}" for i in range(30)]
    changed = [("zz" if k in (4, 11, 17, 25) else w) for k, w in enumerate(item)]
    rows = [(1, "before " + " ".join(item).upper() + " after"), (2, " ".join(changed)), (3, " ".join(item[:12])), (4, None), (5, ""), (6, BASE), (2, " ".join(changed))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item)), (8, "Only Six words are in here"), (7, None), (9, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.leaked, r.item_ids) for r in decontam.find_leaks(docs, bench, block_bytes=40).collect()}
    assert got == {1: (True, [9]), 2: (True, [9]), 3: (False, []), 4: (False, []), 5: (False, []), 6: (False, [])}
    assert decontam.find_leaks(nothing, bench).count() == 0
    assert decontam.find_leaks(edge, bench.where("false")).where("leaked").count() == 0


def test_languages_on_held_out_rows(spark, edge, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where("doc_id % 4 <> 2"))
    held = langid.identify(docs.where("doc_id % 4 = 2"), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count() > 0
    assert held.where("score < 0 or score > 1").count() == 0
    odd = {r.doc_id: r.lang_pred for r in langid.identify(edge, model).collect()}
    assert odd[4] == odd[5] == odd[6] == odd[9] == "und" and odd[1] != "und"
    assert langid.identify(nothing, model).count() == 0
    none = langid.fit(edge.select(F.lit(None).cast("string").alias("lang"), "text"))
    assert {r.lang_pred for r in langid.identify(edge, none).collect()} == {"und"}


def test_quality_ranks_held_out_rows(spark, edge, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 5 <> 0"))
    got = quality.score(docs, model).join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert quality.score(edge, model).where("score between 0 and 1").count() == len(EDGE)
    assert quality.score(nothing, model).count() == 0
    flat = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.score(edge, flat).collect()} == {0.5}


def test_one_of_each_group_of_lines_stays(spark, nothing):
    line = "The quick brown fox jumps over the lazy dog while the sun sets slowly behind the hills of the north country"
    near = line.replace("lazy", "hazy")
    rows = [(1, f"{line}\nunique one, only here\nshort"), (2, f"{near}\n\nshort"), (3, f"some other line of text\n{line}"), (4, None), (5, ""), (6, line), (6, line)]
    assert lines.similarity(line, near) >= 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(1))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in lines.dedup(docs).collect()}
    assert got[1] == (3, 0, rows[0][1]) and got[2] == (2, 1, "\nshort")
    assert got[3] == (2, 1, "some other line of text") and got[4] == (0, 0, None) and got[5] == (0, 0, "") and got[6] == (1, 1, "")
    assert lines.dedup(nothing).count() == 0


def test_similar_lines_of_a_crowded_template_are_all_found(spark):
    rng = np.random.default_rng(5)
    head = "Terms and conditions apply to every order placed through this page, see the notes below for more about: "
    word = lambda: "".join(chr(97 + k) for k in rng.integers(0, 26, 14))
    first = [head + word() for _ in range(300)]
    text = first + [x[:-2] + "##" for x in first]
    assert lines.similarity(first[0], first[1]) < 0.8 <= lines.similarity(text[0], text[300])
    root = list(range(len(text)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [lines._shingles(x) for x in text]
    for a in range(len(text)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    first_of = {}
    for k in range(len(text)):
        first_of.setdefault(top(k), k)
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in lines.dedup(docs).collect()}
    assert got == {k: int(first_of[top(k)] != k) for k in range(len(text))} and sum(got.values()) >= 300


def test_line_pairs_are_bounded_and_compared_as_strings_are():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    left = ["".join(chr(97 + k) for k in rng.integers(0, 4, int(rng.integers(1, 900)))) for _ in range(300)]
    right = [x[: len(x) // 2] + "é" * (k % 3) + x[len(x) // 2 + k % 70 :] or "e" for k, x in enumerate(left)]
    want = np.array([lines.similarity(x, y) for x, y in zip(left, right, strict=True)])
    assert lines._jaccard(pa.array(left), pa.array(right)).tolist() == want.tolist()
    bits = []
    for side in (left, right):
        _, line, values = next(lines._sets(pa.array(side)))
        bits.append(lines._parities(line, values, np.bincount(line)))
    sets = [[lines._shingles(x) for x in side] for side in (left, right)]
    only_one = np.array([len(x ^ y) for x, y in zip(*sets, strict=True)])
    differing = lines._differing(*bits)
    assert (differing <= only_one).all() and (differing % 2 == only_one % 2).all() and differing[want < 0.5].min() > 0
    a, b = (np.array([len(x) for x in side]) for side in sets)
    pairs = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(range(300)), *map(pa.array, (a, b)), *(pa.array(x, pa.binary()) for x in bits)], names=["a", "b", "na", "nb", "pa", "pb"])
    close = {x for batch in lines._close(0.8)(iter([pairs])) for x in batch.column("a").to_pylist()}
    assert close >= set(np.flatnonzero(want >= 0.8).tolist()) and len(close) < 300


def test_short_and_repeated_character_lines_go(spark, tmp_path):
    from tallybook.llm.queries import op5_line_dedup

    rows = [(1, "Menu\nabc\n" + "-" * 10), (2, "Menu\nabd\n" + "-" * 60), (3, "abc\n" + "-" * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_removed for r in op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 2, 3: 2}


def test_bpe_equals_the_tokenizers_library(edge, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    own = bpe.Bpe(open(path, encoding="utf-8").read())
    odd = ["", "  ", "It's we'll 123 ---", "ΑΣ ΣΑΣ", "İé", "a<|endoftext|>B <|start", "x" * 3000, "\x1c\x85", *[t or "" for _, t in EDGE]]
    for text in odd:
        ids = reference.encode(text, add_special_tokens=False).ids
        coded = own.encode(text)
        assert np.frombuffer(coded, "<u4").tolist() == ids
        assert own.decode(coded) == reference.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(edge, path).count() == len(EDGE)
    assert bpe.encode_decode(nothing, path).count() == 0


def test_shards_are_even_gapless_and_keep_groups(spark, edge, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.assign(docs, shards=4).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 4 and sums.max() - sums.min() <= got["size"].max()
    full = packing.assign(edge, capacity=20_000).toPandas()
    assert full.groupby("text_crc32")["shard"].nunique().max() == 1 and len(full) == len(EDGE)
    for frame in (got, full):
        assert all(sorted(s) == list(range(len(s))) for _, s in frame.groupby("shard")["slot"])
    assert packing.assign(nothing, shards=4).count() == 0
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 100, 3000).tolist()
    bins, used = packing.best_fit(sizes, 100)
    load = np.bincount(bins, sizes)
    assert load.max() <= 100 and used == len(load) <= 1.02 * sum(sizes) / 100 + 1


def test_vectors_link_as_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8))
    x = np.concatenate([x, x[:20] + rng.normal(size=(20, 8)) * 0.1, x[:5]])
    rows = [(i, [float(v) for v in x[i]], int(i % 2) if i < 60 else int((i - 60) % 20 % 2)) for i in range(len(x))]
    rows += [(200, None, 0), (201, [0.0] * 8, 0), (202, [float("nan")] * 8, 0), (203, [None] * 8, 0), (204, [1.0] * 8, None), (205, [], 0), (206, rows[0][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vectors.near_duplicates(table)
    y = np.array([np.array(r[1], np.float32) for r in rows[:85]] + [np.array(rows[0][1], np.float32)]).astype(float)
    ids, label = [*range(85), 206], [r[2] for r in rows[:85]] + [0]
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = (y @ y.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    want = dict(zip(ids, near.sum(axis=1).tolist(), strict=True)) | {i: 0 for i in range(200, 206)}
    assert {r.vec_id: r.n_links for r in got.collect()} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert vectors.audit(got, table, every=1) == 1.0
    assert vectors.near_duplicates(table.where("false")).count() == 0


def test_vector_links_across_shards_count_at_both_ends(spark, monkeypatch):
    monkeypatch.setattr(vectors, "AIM", 40)
    monkeypatch.setattr(vectors, "MOST", 80)
    monkeypatch.setattr(vectors, "VISITORS", 60)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 5))
    x = np.concatenate([x, x[0] + rng.normal(size=(200, 5)) * 0.05, x[:30] + rng.normal(size=(30, 5)) * 0.05, x[:10]])
    table = spark.createDataFrame([(i, v.tolist(), int(i % 50 == 7)) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in vectors.near_duplicates(table).collect()}
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(len(x)) % 50 == 7
    near = (y @ y.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    least = np.arange(len(x))
    while (low := np.minimum(least, np.where(near, least, len(x)).min(axis=1))).tolist() != least.tolist():
        least = low
    assert {i: got[i].n_links for i in got} == dict(enumerate(near.sum(axis=1).tolist()))
    assert {i: got[i].component_id for i in got} == dict(enumerate(least.tolist()))


def test_vectors_of_neighbouring_clumps_all_link(spark):
    rng = np.random.default_rng(8)
    middle = np.eye(64)[0] + 0.1 * np.eye(64)[1:13]
    x = np.repeat(middle, 70, axis=0) + rng.normal(size=(840, 64)) * 0.002
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = y @ y.T
    assert near[:70, :70].min() > near[:70, 70:].max() and near.min() >= 0.98
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = vectors.near_duplicates(table).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(839, 0)} and len(got) == 840


def test_warc_round_trip_and_salvage(spark, tmp_path):
    long = "é<p>" * 200
    rows = [(3, "u3", long), (1, "u\r\n1", long), (2, None, "tiny"), (4, "u4", "tiny"), (5, "u5", None), (5, "u5", None), (6, "u6", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    warc.write(pages, str(tmp_path / "a"))
    got = warc.read(spark, str(tmp_path / "a")).collect()
    assert {r.kind for r in got} == {"record"} and len(got) == len(rows)
    by = {r.record_id: r for r in got}
    assert by["urn:page:3"].type == "revisit" and by["urn:page:3"].refers_to == "urn:page:1"
    for i, _, html in rows:
        data = (html or "").encode()
        assert (by[f"urn:page:{i}"].payload_bytes, by[f"urn:page:{i}"].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    warc.write(pages.where("false"), str(tmp_path / "b"))
    assert warc.read(spark, str(tmp_path / "b")).count() == 0

    def record(name, body):
        return f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{name}>\r\nWARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    a, b, c = (record(n, n.encode() * 50) for n in "abc")
    broken = b.replace(b"bbb", b"bxb", 1)
    plain = [(x.get("record_id"), x["at"], x["length"]) for x in warc.salvage(a + broken + c + b"tail")]
    assert plain == [("a", 0, len(a)), (None, len(a), len(b)), ("c", len(a + b), len(c)), (None, len(a + b + c), 4)]
    x, y, z = map(gzip.compress, (a, b, c))
    bad = y[:-6] + bytes([y[-6] ^ 255]) + y[-5:]
    zipped = [(r.get("record_id"), r["at"], r["length"]) for r in warc.salvage(x + bad + z)]
    assert zipped == [("a", 0, len(x)), (None, len(x), len(y)), ("c", len(x + y), len(z))]
    assert list(warc.salvage(b"")) == []


def test_pipeline_stages_keep_the_columns_and_the_clean(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.scratch.stored(stage(spark, docs, SF))
        assert k == 4 or docs.columns == list(corpus_pipeline.COLUMNS)
    assert 0.8 * before <= docs.count() <= before


def test_pipeline_drops_documents_left_with_blank_lines(spark):
    import corpus_pipeline

    rows = [(1, "the same line of text", "en", "a"), (2, "the same line of text\n\n\n", "en", "a"), (3, "\n\nanother one", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert got == {1: rows[0][1], 3: rows[2][1]}
