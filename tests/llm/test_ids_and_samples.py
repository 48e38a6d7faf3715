"""Ids at the ends of 64 bits and missing ones, and samples that are bounded in total."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripline.llm import common, decontaminate, labels, lines, minhash, tokens, vectors, warc

IDS = [2**62 - 1, 2**62, 2**62 + 7, 2**63 - 2, 0, -5, -(2**63), None]


def text(seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join(f"{chr(97 + a)}{b}" for a, b in zip(r.integers(0, 26, n), r.integers(0, 500, n), strict=True))


def test_vector_ids(spark):
    """Every id comes back as it is; the least id of a component stands for it, and none where no row has one."""
    r = np.random.default_rng(3)
    a, b, c = r.standard_normal((3, 8))
    near = lambda v: (v + r.standard_normal(8) * 0.002).tolist()
    rows = [(i, near(a), 1) for i in IDS] + [(10 + k, near(b), 1) for k in range(3)] + [(None, near(c), 2), (None, near(c), 2)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    first = [g for g in got if g.n_links == 7]
    assert sorted(g.vec_id for g in first if g.vec_id is not None) == sorted(i for i in IDS if i is not None)
    assert {g.component_id for g in first} == {-(2**63)} and [g.vec_id for g in first if g.kept] == [-(2**63)]
    assert {(g.vec_id, g.component_id, g.kept) for g in got if g.n_links == 2} == {(10, 10, True), (11, 10, False), (12, 10, False)}
    last = [g for g in got if g.n_links == 1]
    assert len(last) == 2 and all(g.vec_id is None and g.component_id is None for g in last) and sum(g.kept for g in last) == 1


def test_document_ids(spark):
    """The same for near copies, alone and in groups, and for the rows that stay."""
    rows = [(i, text(1) + f" tail{k}") for k, i in enumerate(IDS)] + [(2**62 + 100, text(2)), (2**63 - 1, text(3)), (None, text(4)), (None, text(5) + " x"), (None, text(5) + " y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(frame).collect()
    assert sorted(map(str, (g.doc_id for g in got))) == sorted(map(str, (i for i, _ in rows)))
    big = {(g.doc_id, g.class_id, g.kept) for g in got if g.class_id == -(2**63)}
    assert big == {(i, -(2**63), i == -(2**63)) for i in IDS}
    assert {(g.doc_id, g.class_id) for g in got if g.class_id not in (None, -(2**63))} == {(2**62 + 100, 2**62 + 100), (2**63 - 1, 2**63 - 1)}
    lone = [g for g in got if g.class_id is None]
    assert len(lone) == 3 and sum(g.kept for g in lone) == 2
    assert minhash.one_of_each(frame).count() == 5


def test_benchmark_ids(spark):
    item = text(9, 30)
    docs = spark.createDataFrame([(i, text(20 + k) + " " + item) for k, i in enumerate(IDS)] + [(2**63 - 1, text(50))], "doc_id long, text string")
    bench = spark.createDataFrame([(2**62 + 3, item), (None, item)], "item_id long, text string")
    got = {(g.doc_id, g.item_id) for g in decontaminate.matches(docs, bench).collect()}
    assert got == {(i, j) for i in IDS for j in (2**62 + 3, None)}
    assert [r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()] == [2**63 - 1]


@pytest.mark.parametrize("parts", [1, 40])
def test_samples_do_not_grow_with_tasks(spark, parts):
    rows = spark.range(20_000).repartition(parts)
    took = common.least_hashed(rows, F.col("id"), 100, F.col("id"))
    got = sorted(r.id for r in took.collect())
    every = {r.id: r.h for r in rows.select("id", F.xxhash64(F.lit("sample"), "id").alias("h")).collect()}
    assert got == sorted(sorted(every, key=every.get)[:100])
    below = took._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in below  # only rows below a share of the hashes are sorted
    few = common.least_hashed(spark.range(5), F.col("id"), 100, F.col("id"))
    assert few.count() == 5 and common.least_hashed(spark.range(0), F.col("id"), 5, F.col("id")).count() == 0
    same = spark.range(20_000).select((F.col("id") % 3).alias("id"))
    assert common.least_hashed(same, F.col("id"), 50, F.col("id")).count() == 50


def test_sample_under_repeated_ids(spark):
    """One text per id, the same in every run, and no more bytes than allowed."""
    rows = [(i % 30, text(i)) for i in range(300)] + [(40, "long " * 5000), (41, None)]
    known = spark.createDataFrame([(i, i % 2) for i in range(42)], "id long, y int")
    runs = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        runs.append(labels.sample(docs, known, 100))
    assert runs[0] == runs[1] and len(runs[0][0]) == 32
    texts, _ = labels.sample(docs, known, 100, most_bytes=5000)
    assert 0 < len(texts) < 32 and sum(len(t.encode()) for t in texts) <= 5000 and not any(t.startswith("long") for t in texts)
    assert len(labels.sample(docs.where("doc_id = 40"), known, 100, most_bytes=10)[0]) == 1
    import public_tokenizers

    path = public_tokenizers.path(tokens.VOCABULARY)
    assert tokens.train(docs, path) == tokens.train(docs.repartition(3), path)


ENDS = [2**63 - 1, None, 2**63 - 2, 2**62, 0, -1, -(2**63)]


def test_token_file_ids(spark, tmp_path):
    """The largest id comes back as itself, before rows without one."""
    import public_tokenizers

    rows = [(i, text(k, 5 + k)) for k, i in enumerate(ENDS)] + [(None, "x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokens.round_trip(frame).orderBy("start").collect()
    assert [r.doc_id for r in got] == [*sorted(i for i in ENDS if i is not None), None, None]
    manifest, dictionary = tokens.write(frame, str(tmp_path), public_tokenizers.path("word_bpe_49k.json"), shards=1)
    with tokens.Reader(str(tmp_path), manifest.first().file, dictionary) as file:
        assert len(file.fetch(2**63 - 1)) == next(r.n_tokens for r in got if r.doc_id == 2**63 - 1)
    bare, dictionary = tokens.write(frame.where("doc_id is null"), str(tmp_path / "bare"), public_tokenizers.path("word_bpe_49k.json"), shards=1)
    with tokens.Reader(str(tmp_path / "bare"), bare.first().file, dictionary) as file, pytest.raises(KeyError):
        file.fetch(2**63 - 1)


def test_line_ids(spark):
    """A row with the largest id and one without are two documents; the one with an id owns a line of both."""
    shared = "a line that several documents hold"
    for order in (ENDS, ENDS[::-1]):
        frame = spark.createDataFrame([(i, shared + "\nown line of " + str(i)) for i in order], "doc_id long, text string")
        got = {r.doc.doc_id: r.n_dropped for r in lines.dedup_lines(frame).collect()}
        assert got == {i: int(i != -(2**63)) for i in ENDS}
    two = spark.createDataFrame([(2**63 - 1, shared), (None, shared), (None, shared)], "doc_id long, text string")
    assert sorted((r.doc.doc_id is None, r.n_dropped) for r in lines.dedup_lines(two).collect()) == [(False, 0), (True, 1), (True, 1)]


def test_page_ids(spark):
    big = "y" * 2000
    got = warc.round_trip(spark.createDataFrame([(i, "u", big) for i in ENDS], "page_id long, url string, html string")).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {(i, "response" if i == 2**63 - 1 else "revisit", None if i == 2**63 - 1 else 2**63 - 1) for i in ENDS}


@pytest.mark.parametrize("parts", [1, 40])
def test_hot_line(spark, parts):
    """A line that most rows hold, beside rare ones."""
    rows = [(i, f"a very frequent line\nseldom line {i // 2}\nown line of document {i}\nA VERY frequent line ") for i in range(400)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert {r.doc.doc_id: r.n_dropped for r in got} == {i: 2 * (i > 0) + i % 2 for i in range(400)}


def test_dictionary_is_learned_in_a_task(spark, monkeypatch):
    """The driver loads no tokenizer, with rows and without."""
    import public_tokenizers

    def refuse(*_):
        raise AssertionError("the driver loads the tokenizer")

    monkeypatch.setattr(tokens, "Encoder", refuse)
    path = public_tokenizers.path(tokens.VOCABULARY)
    docs = spark.createDataFrame([(i, text(i, 200)) for i in range(300)], "doc_id long, text string")
    assert len(tokens.train(docs, path)) > 256 and tokens.train(docs.limit(0), path) == b""
