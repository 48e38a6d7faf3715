"""The pipeline of corpus_pipeline.py, stage by stage, against small loops."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from gripline.llm import mixing, quality

from .test_operators import jaccard, text

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, copies int, row_id string"
END = 2


def table(rows):
    return Counter(map(str, rows))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Near copies, leaks, bad documents, nulls, empty and long texts, repeated rows, and columns named as the stages name theirs."""
    item = text(7000, 24)
    base = text(50, 120)
    rows = [(i, text(i), "en", f"s{i % 3}", 1, 0.1, 3, "r") for i in range(30)]
    rows += [(40, base, "en", "s0", 1, 0.1, 3, "r"), (41, base + " tail", "en", "s1", 1, 0.1, 3, "r"), (42, base.upper(), None, None, None, None, None, None)]
    rows += [(50, text(1, 30) + " " + item + " " + text(2, 30), "en", "s2", 1, 0.1, 3, "r"), (2**63 - 1, text(60), "en", "s2", 1, 0.1, 3, "r"), (7, text(7), "en", "s1", 1, 0.1, 3, "r")]
    rows += [(60 + i, "$$ ## 0 0 0 !! " * (20 + i), "en", "s0", 1, 0.1, 3, "r") for i in range(12)]
    rows += [(80, None, None, None, None, None, None, None), (81, "", "", "", 0, 0.0, 0, ""), (None, text(90), "en", "s0", 1, 0.1, 3, "r"), (None, None, None, None, None, None, None, None)]
    rows += [(82, " ".join(f"word{i}" for i in range(20_000)), "en", "s1", 1, 0.1, 3, "r")]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], int(not (r[1] or "$").startswith("$")), 0) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), item


def test_stages(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    folder, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {"": docs.collect()}
    for (name, stage), before in zip(corpus_pipeline.STAGES[:-1], ["", "quality", "near_dedup", "decontamination"], strict=True):
        given = spark.createDataFrame(kept[before], docs.schema)
        out = stage(spark, given, folder)
        assert out.columns == docs.columns
        kept[name] = out.collect()

    scored = {(r.doc_id, r.predicted) for r in quality.query(docs, labels).collect()}
    assert table(kept["quality"]) == table(r for r in kept[""] if (80 if r.text is None else r.doc_id, 1) in scored)  # equal texts score alike
    assert {i for i in range(30)} | {40, 41, 50} <= {r.doc_id for r in kept["quality"]} and not {60, 65, 71} & {r.doc_id for r in kept["quality"]}

    # one row of each class: equal rows are one, rows without words stand alone
    given = list({str(r): r for r in kept["quality"]}.values())
    words = [(r.text or "").lower().split() for r in given]
    sets = [Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter() for w in words]
    cls = list(range(len(given)))
    for a in range(len(given)):
        for b in range(a):
            alike = words[a] == words[b] if max(map(len, (words[a], words[b]))) > 5000 else bool(sets[a] and sets[b]) and jaccard(sets[a], sets[b]) >= 0.8
            if alike:
                cls = [cls[b] if c == cls[a] else c for c in cls]
    order = lambda k: (given[k].doc_id is None, given[k].doc_id or 0)
    firsts = [min((k for k in range(len(given)) if cls[k] == c), key=order) for c in set(cls)]
    assert table(kept["near_dedup"]) == table(given[k] for k in firsts)

    assert table(kept["decontamination"]) == table(r for r in kept["near_dedup"] if item not in (r.text or "").lower())

    mixed = mixing.mix(spark.createDataFrame(kept["decontamination"], docs.schema)).collect()
    assert table(kept["mixing"]) == table(r.doc for r in mixed for _ in range(r.copies))
    assert sum(r.copies for r in mixed) > 0 and all(0 <= r.copies <= 3 for r in mixed)

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in kept["mixing"]:
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, END]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(want)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
