"""The dealt operators on small tables: brute force, edge cases, round trips."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripline.llm import common, decontaminate, hilbert, lines, minhash, mixing, quality, queries, tokens, toxicity, vectors, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int, row_id string, doc string"
LONG = " ".join(f"word{i}" for i in range(30_000))


def text(seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join(f"{chr(97 + a)}{b}" for a, b in zip(r.integers(0, 26, n), r.integers(0, 500, n), strict=True))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, and columns named as the operators name theirs."""
    rows = [(i, text(i), "en", f"s{i % 4}", 1, 7, "x", "y") for i in range(40)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "", "", 0, 0, "", ""), (102, " \t\n", "de", "s0", 3, 0, "", ""), (103, LONG, "de", "s0", 3, 0, "", "")]
    rows += [(104, text(3), "en", "s0", 1, 1, "", ""), (5, text(5), "en", "s1", 1, 7, "x", "y"), (5, text(5), "en", "s1", 1, 7, "x", "y"), (None, text(900), "en", None, 1, 1, "", ""), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- 1 mixing
def shares(sizes, limit=3):
    """Targets by sharing again until none is above its limit."""
    keys = sorted(sizes, key=lambda k: (k is None, k))
    weight = {k: i % 3 + 1 for i, k in enumerate(keys)}
    fixed, total = {}, sum(sizes.values())
    while True:
        open_ = [k for k in keys if k not in fixed]
        left = total - sum(fixed.values())
        got = {k: left * weight[k] / sum(weight[j] for j in open_) for k in open_}
        above = [k for k in open_ if got[k] > limit * sizes[k]]
        if not above:
            return fixed | got
        fixed |= {k: limit * sizes[k] for k in above}


def test_mixing(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and mixing.mix(none).count() == 0
    sizes = defaultdict(int)
    for r in rows:
        assert r.size == len((r.doc.text or "").split()) and r.copies <= 3 and r.doc.copies in (7, 0, 1, None)
        sizes[r.doc.source] += r.size
    want = shares(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.doc.source] and math.isclose(r.target, want[r.doc.source], rel_tol=1e-12)
        taken[r.doc.source] += r.size * r.copies
    for k, v in want.items():
        assert abs(taken[k] - v) <= 3 * max(r.size for r in rows if r.doc.source == k)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd.repartition(3)).collect()))
    assert mixing.taken(odd).count() == sum(r.copies for r in rows) and mixing.taken(odd).columns == odd.columns


def test_mixing_targets_even(spark):
    rows = spark.createDataFrame([(i, " ".join("w" * (1 + i * 7 % 90)), f"s{i % 5 if i % 3 else 0}") for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix(rows).groupBy("doc.source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.02 for r in got)


# --- 2 vectors
def test_vectors(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal((60, 8))
    rows = [(i, (base[i % 40] + r.standard_normal(8) * (0.12 if i % 3 else 0)).tolist(), i % 3) for i in range(300)]
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [float("nan")] + [1.0] * 7, 1), (403, [None] + [1.0] * 7, 1), (404, rows[0][1], None), (405, [float("inf")] + [1.0] * 7, 1), (406, [], 1), (407, [1.0, 2.0], 1), (408, [2.0, 4.0], 1), (None, rows[1][1], 1), (2, rows[2][1], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vectors.near_duplicates(frame, per_cell=20, block=16).collect()
    exact = [(i, np.array(v, np.float32).astype(float) if v and None not in v else None, k) for i, v, k in rows]
    ok = [j for j, (i, v, k) in enumerate(exact) if v is not None and k is not None and np.isfinite(v).all() and v.any()]
    near = defaultdict(set)
    for a in ok:
        for b in ok:
            (x, y) = exact[a][1], exact[b][1]
            if a != b and exact[a][2] == exact[b][2] and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                near[a].add(b)
    big = 10**18
    ids = [big if i is None else i for i, _, _ in rows]
    component = list(ids)
    while True:
        new = [min([component[j], *(component[k] for k in near[j]), *(component[k] for k in range(len(ids)) if ids[k] == ids[j])]) for j in range(len(ids))]
        if new == component:
            break
        component = new
    want = sorted((ids[j], len(near[j]), component[j]) for j in range(len(ids)))
    assert sorted((big if r.vec_id is None else r.vec_id, r.n_links, big if r.component_id is None else r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


# --- 3 decontamination
def test_decontamination(spark, odd, none):
    item = text(7000, 24)
    words = item.split()
    edited = " ".join("changed" if i % 8 == 3 else w for i, w in enumerate(words))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, text(8000, 30)), (None, text(9000, 20)), (6, "one two")], "item_id long, text string")
    leaks = [(200, text(1, 30) + " " + item.upper() + "\n" + text(2, 30)), (201, text(3, 400) + " " + edited), (202, " ".join(words[:6]) + " " + text(5)), (203, LONG + " " + item + " " + LONG), (204, text(9000, 20)), (205, "ONE two")]
    rows = odd.unionByName(spark.createDataFrame(leaks, "doc_id long, text string"), allowMissingColumns=True)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(rows, bench).collect()}
    assert set(got) == {(200, 1), (201, 1), (203, 1), (204, None), (205, 6)}
    assert got[200, 1].score == 1.0 and (got[200, 1].first_word, got[200, 1].end_word) == (30, 54)
    assert got[203, 1].first_word == 30_000 and got[201, 1].score == pytest.approx((21 * 2 - 3) / 48)
    clean = decontaminate.without_leaks(rows, bench)
    assert clean.columns == rows.columns and clean.count() == rows.count() - 5
    assert decontaminate.matches(none, bench).count() == 0 and decontaminate.matches(odd, bench.limit(0)).count() == 0


@pytest.mark.parametrize("exact", [False, True])
def test_edited_copies(spark, exact):
    """Copies with every 4th, 5th and 6th word changed, and one with a word put in after every 2, beside exact copies or not."""
    items = [text(7100 + i, 24 + i) for i in range(6)]
    docs = [(1000 + i, text(7200 + i, 50) + " " + t + " " + text(7300 + i, 50)) for i, t in enumerate(items) if exact]
    for i, t in enumerate(items):
        words = t.split()
        for every in (4, 5, 6):
            docs.append((10 * i + every, text(7400 + i, 30) + " " + " ".join(f"new{k}" if k % every == every - 1 else w for k, w in enumerate(words)) + " " + text(7500 + i, 30)))
        docs.append((10 * i, " ".join(w + f" more{k}" * (k % 2) for k, w in enumerate(words))))
    docs += [(2000 + i, text(7600 + i, 200)) for i in range(30)]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    number = lambda t: np.array([int(hashlib.md5(w.encode()).hexdigest()[:12], 16) for w in t.split()])
    want = {(d, i): decontaminate.align(number(x), number(t))[0] / (2 * len(x.split())) for d, t in docs for i, x in enumerate(items)}
    want = {k: v for k, v in want.items() if v >= decontaminate.LEAST}
    assert len(want) >= (30 if exact else 24) and {(r.doc_id, r.item_id): r.score for r in got.collect()} == want


def test_short_items(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, text(1) + " Alpha BETA " + text(2)), (3, text(3) + " beta alpha " + text(4)), (4, "x gamma"), (5, text(5))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta"), (2, "gamma")], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.first_word, r.end_word) for r in decontaminate.matches(docs, bench).collect()} == {(1, 1, 0, 2), (2, 1, 60, 62), (4, 2, 1, 2)}


def test_alignment_brute():
    r = np.random.default_rng(3)
    for _ in range(30):
        a, b = r.integers(0, 4, r.integers(1, 12)), r.integers(0, 4, r.integers(1, 20))
        s = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                s[i, j] = max(0, s[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), s[i - 1, j] - 1, s[i, j - 1] - 1)
        assert decontaminate.align(a, b)[0] == s.max()


# --- 4 and 7 classifiers
def test_quality_gradient():
    p = {k: v.astype(np.float64) + (0.05 if k in "bc" else 0) for k, v in quality.start(1).items()}  # away from the kinks at 0
    docs = [b"some words here " * 40, b"### $$$ " * 9, b""]
    flat, index, starts = quality.lay_out([x for d in docs for x in quality.pieces(d)])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        h = quality.chunk_outputs(p, flat, index)["h"]
        n = np.diff(np.append(starts, len(h)))
        z = np.concatenate([np.maximum.reduceat(h, starts), np.add.reduceat(h, starts) / n[:, None]], axis=1) @ p["u"] + p["d"]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    g = quality.gradients(p, flat, index, starts, y)
    for name, at in (("u", (3,)), ("v", (5, 2)), ("w", (1, 4, 6)), ("bytes", (ord("e"), 2)), ("b", (3,)), ("c", (1,)), ("d", (0,))):
        old = p[name][at]
        p[name][at] = old + 1e-5
        up = loss()
        p[name][at] = old - 1e-5
        down = loss()
        p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_quality_covers_long_texts():
    model = quality.start(2)
    long = (text(1, 200) + " ").encode() * 200
    h = [quality.chunk_outputs(model, *quality.lay_out([p])[:2])["h"] for p in quality.pieces(long, 10**9)][0]
    z = np.concatenate([h.max(axis=0), h.mean(axis=0)])
    assert quality.scores(model, [long, b"x"])[0] == pytest.approx(1 / (1 + np.exp(-(z @ model["u"] + model["d"][0]))), abs=1e-5)


@pytest.mark.parametrize("model", [quality, toxicity])
def test_classifier_edges(spark, odd, none, model):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(100, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = model.query(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert model.query(none, labels).count() == 0 and model.query(odd, labels.limit(0)).count() == odd.count()
    assert model.query(odd, labels.where("quality = 1")).count() == odd.count()


@pytest.mark.parametrize("name,column,least", [("op4_quality", "quality", 0.93), ("op7_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, column, least):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    assert rows.select(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0] > least


def test_good_keeps_columns(spark, odd):
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    assert quality.good(odd, labels).columns == odd.columns and quality.good(odd, labels).count() == odd.count()


# --- 5 MinHash
def jaccard(a, b):
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return total


def test_similarity_and_signature():
    r = np.random.default_rng(2)
    for _ in range(20):
        a = {int(k): int(v) for k, v in zip(r.integers(0, 40, 25), r.integers(1, 4, 25), strict=True)}
        b = {int(k): int(v) for k, v in zip(r.integers(0, 40, 25), r.integers(1, 4, 25), strict=True)}
        side = lambda s: (np.array(sorted(s)), np.array([s[k] for k in sorted(s)]))
        assert minhash.similarity(*side(a), *side(b)) == pytest.approx(jaccard(a, b))
    hashes = minhash.mixed(np.arange(1, 41, dtype=np.uint64) * minhash.STEP)
    one, two = r.integers(1, 5, 40), r.integers(1, 5, 40)
    held = minhash.signatures(np.repeat([0, 1], 40), np.tile(hashes, 2), np.concatenate([one, two]).astype(float), 2, 4096)
    want = jaccard(dict(enumerate(one.tolist())), dict(enumerate(two.tolist())))
    assert (held[0] == held[1]).mean() == pytest.approx(want, abs=0.04)


def test_near_duplicates(spark, odd, none):
    base = text(50, 120).split()
    chain = [" ".join([*base[: 120 - 3 * i], *text(60, 200).split()[: 3 * i]]) for i in range(12)]
    rows = odd.unionByName(spark.createDataFrame([(300 + i, t) for i, t in enumerate(chain)], "doc_id long, text string"), allowMissingColumns=True)
    got = minhash.near_duplicates(rows).collect()
    assert len(got) == rows.count() and minhash.near_duplicates(none).count() == 0
    sets = {}
    for r in rows.collect():
        w = (r.text or "").lower().split()
        key = r.doc_id if r.doc_id is not None else 10**6 + len(w)
        if w and len(w) < 1000:
            sets[key] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    cls = {k: k for k in sets}
    links = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    for _ in cls:
        for a, b in links:
            cls[a] = cls[b] = min(cls[a], cls[b])
    assert {r.doc_id: r.class_id for r in got if r.doc_id in cls} == {k: v for k, v in cls.items() if k < 10**6}
    assert all(r.kept for r in got if r.doc_id is None or r.doc_id in (100, 101, 102, 103))
    one = minhash.one_of_each(rows)
    assert one.columns == rows.columns and one.count() == len({r.row_id for r in got if r.kept})


def test_repeated_ids(spark):
    """Rows that share a doc_id and hold different texts: only those near another, or with a leak, go."""
    rows = [(1, text(1)), (1, text(2)), (1, text(2)), (2, text(3)), (3, text(2)), (4, text(4) + " " + text(5, 20)), (4, text(6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.text for r in minhash.one_of_each(docs).collect()) == sorted({t for _, t in rows})
    clean = decontaminate.without_leaks(docs, spark.createDataFrame([(1, text(5, 20))], "item_id long, text string"))
    assert sorted(map(tuple, clean.collect())) == sorted(r for r in rows if r != rows[5])


def test_large_group_of_near_copies(spark):
    base = text(77, 100).split()
    rows = [(i, " ".join([*base[: i % 90], f"new{i}", *base[i % 90 + 1 :]])) for i in range(300)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_tiles(spark, monkeypatch):
    """Copies that mostly lie below the threshold to the hub, in tiles of few documents, against all pairs."""
    monkeypatch.setattr(minhash, "TILE_DOCS", 8)
    r = np.random.default_rng(5)
    base = text(78, 90).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        w = list(base)
        for k in r.choice([5, 20, 35, 50, 65, 80], int(r.integers(1, 5)), replace=False):
            w[k] = f"new{r.integers(0, 2)}"
        if i % 9 == 0:
            w += w[:12]  # repeats shingles
        rows.append((i, " ".join(w)))
    sets = {i: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for i, w in ((i, t.split()) for i, t in rows)}
    cls = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    for _ in range(30):
        for a, b in links:
            cls[a] = cls[b] = min(cls[a], cls[b])
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: x.class_id for x in got} == cls


@pytest.mark.parametrize("columns", [7, 4096])
def test_tile_links(monkeypatch, columns):
    monkeypatch.setattr(minhash, "COLUMNS", columns)
    r = np.random.default_rng(6)
    sets = []
    for _ in range(60):
        h = np.unique(np.concatenate([np.arange(20), r.integers(20, 24, 3)]).astype(np.int64))
        h = np.sort(r.choice(h, int(r.integers(15, len(h))), replace=False))
        sets.append((h, r.choice([1, 1, 1, 2], len(h)) if r.random() < 0.3 else np.ones(len(h), np.int64)))
    side, ids = np.repeat([0, 1], 30), np.arange(60)
    want, got = {i: i for i in range(60)}, {i: i for i in range(60)}
    pairs = [(i, j) for i in range(30) for j in range(30, 60) if minhash.similarity(*sets[i], *sets[j]) >= 0.8 - 1e-12]
    for found, links in ((want, pairs), (got, minhash.tile_links(side, ids, ids, sets, 0.8))):
        assert set(links) <= set(pairs)
        for _ in range(60):
            for a, b in links:
                found[a] = found[b] = min(found[a], found[b])
    assert pairs and got == want


# --- 6 sharding
def test_curve(spark):
    rows = sorted((r.h, (r.x0, r.x1, r.x2)) for r in hilbert.curve(spark, 3).collect())
    assert [h for h, _ in rows] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for (_, p), (_, q) in zip(rows, rows[1:], strict=False))


def test_shards(spark, odd, none, tmp_path):
    rows = hilbert.shard(odd).collect()
    assert len(rows) == odd.count() and hilbert.shard(none).count() == 0
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        data = (r.doc.text or "").encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and set(by) == set(range(8))
    last = -1
    for k in range(8):
        part = sorted(by[k], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        assert all(a.curve <= b.curve for a, b in zip(part, part[1:], strict=False)) and part[0].curve >= last
        last = part[-1].curve
    assert hilbert.shard(odd.limit(3)).count() == 3
    hilbert.write(hilbert.shard(odd), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == odd.count()


def test_shard_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op6_sharding"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(texts) == sorted(r.doc_id for r in rows)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)


# --- 8 token files
def test_tokens_equal_the_tokenizer(spark, odd, none, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.VOCABULARY)
    whole = Tokenizer.from_file(path)
    strange = ["Don't  STOP... now!?", "É́cole fin x\u0085y", "a<|endoftext|>b <|EndOfText|>", "\x1c\x1d tab\tnew\n\r\x0b", "x.y,z;;'s 't", "12,345.67% ﬁ ß İI", "", "   ", "...", "日本語 テスト。 ok.", "re'll 've'd", "Å. B"]
    assert [x.tolist() for x in tokens.Encoder(path).texts(strange)] == [whole.encode(t, add_special_tokens=False).ids for t in strange]
    rows = odd.unionByName(spark.createDataFrame([(500 + i, t) for i, t in enumerate(strange)], "doc_id long, text string"), allowMissingColumns=True)
    folder = str(tmp_path / "tokens")
    manifest, dictionary = tokens.write(rows, folder, path)
    got = tokens.read(manifest, folder, dictionary).orderBy("start").collect()
    want = sorted(((r.doc_id if r.doc_id is not None else 2**63, r.text or "") for r in rows.collect()), key=lambda x: x[0])
    assert [2**63 if r.doc_id is None else r.doc_id for r in got] == [i for i, _ in want]
    start, want_crc = 0, Counter()
    for r, (i, _) in zip(got, want, strict=True):
        assert r.start == start
        start += r.n_tokens
    for i, t in want:
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want_crc[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((2**63 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want_crc
    for r in manifest.collect():
        with tokens.Reader(folder, r.file, dictionary) as file:
            if 503 in file.index["doc_id"]:
                assert file.fetch(503).tolist() == [*whole.encode(strange[3], add_special_tokens=False).ids, 2]
            with pytest.raises(KeyError):
                file.fetch(999_999)
            with pytest.raises(ValueError):
                tokens.Reader(folder, r.file, b"another")
    assert tokens.round_trip(none).count() == 0


def test_few_small_files(spark, tmp_path, monkeypatch):
    """The manifest is one file and the sample few, whatever the number of shuffle partitions; every document is in a token file."""
    import public_tokenizers

    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path / "sample"))
    docs = spark.createDataFrame([(i, f"text {i} of a few words") for i in range(600)], "doc_id long, text string").repartition(3)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        manifest, _ = tokens.write(docs, str(tmp_path / "tokens"), public_tokenizers.path(tokens.VOCABULARY))
        rows = manifest.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 40 and sum(r.documents for r in rows) == 600
    assert len(list((tmp_path / "tokens" / "manifest").glob("part-*"))) == 1
    assert 1 <= len(list((tmp_path / "sample").glob("part-*"))) <= tokens.SAMPLE_TASKS


def test_slices_are_runs_of_bytes():
    """Every text once and in order; a run ends with the text that fills it, and no later run is made before it is asked for."""
    import pyarrow as pa

    texts = ["", "abc", "é" * 3, "x" * 50, "", "y", "日本"]
    for most in (1, 4, 9, 1000):
        runs = list(tokens.slices(pa.array(["before", *texts]).slice(1), most))
        assert [t for _, run in runs for t in run] == texts
        assert [a for a, _ in runs] == np.cumsum([0, *(len(run) for _, run in runs[:-1])]).tolist()
        assert all(sum(len(t.encode()) for t in run[:-1]) < most for _, run in runs)
        assert all(sum(len(t.encode()) for t in run) >= most for _, run in runs[:-1])
    assert list(tokens.slices(pa.array([], pa.string()))) == []


def test_tokens_of_mixed_signs():
    """Words whose punctuation follows another sign, which the pre-tokenizer takes together."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.VOCABULARY)
    whole = Tokenizer.from_file(path)
    heads = ["hello)", 'said "yes"', "it's'", "5%", "x*", "-", "a]", "é", "É\u0301", "x\u0301", "日本", "日。", "²", "İ", "x\u00a0", "\u037e", "(", "", "😀", "a_", "Don't", "a.b)"]
    mixed = [f"The {h}{t} End{t}" for h in heads for t in (".", ",", "!?", "...", ";:", "")]
    mixed += ['The rule (see above). He said "yes", then left.', 'one "!!, two ").. three', '"', ")."]
    assert [x.tolist() for x in tokens.Encoder(path).texts(mixed)] == [whole.encode(t, add_special_tokens=False).ids for t in mixed]


def test_plain_words_skip_the_normal_form():
    """Words of small letters go to the model as they are, once for all tails of signs; everything else goes the whole way."""
    import public_tokenizers
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, inner):
            self.inner, self.seen = inner, []

        def encode_batch_fast(self, words, **options):
            self.seen += words
            return self.inner.encode_batch_fast(words, **options)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    path = public_tokenizers.path(tokens.VOCABULARY)
    whole = Tokenizer.from_file(path)
    encoder = tokens.Encoder(path)
    encoder.tokenizer = Counting(encoder.tokenizer)
    heads = ["cup", "Cup", "größe", "Größe", "naïve", "e\u0301t", "σας", "x÷y", "ªb", "don't", "b52", "日本"]
    for tails in ([""], ["", ".", "***", "%%%", "#&$)", '",'], ["."]):
        texts = [f"{h}{t}" for h in heads for t in tails] + [" ".join(f"{h}{t}" for h in heads for t in tails)]
        assert [x.tolist() for x in encoder.texts(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    words = [w for w in encoder.tokenizer.seen if w[:1].isalnum()]
    assert len(words) == len(set(words)) and not {"cup", "größe", "naïve"} & set(words)
    assert {w for w in words if w[-1] in tokens.PUNCTUATION} <= {f"e\u0301t{t}" for t in ("", ".", "***", "%%%", "#&$)", '",')}


# --- 9 lines
def brute_lines(rows):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                held[key(x)].add(i)
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(held[key(x)]) < 2 or i == min(held[key(x)])]
        out.append((i, len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (9, 3)])
def test_lines(spark, odd, batches, fanout):
    r = np.random.default_rng(5)
    pool = ["A common line here", "a COMMON line here \t", "\x0bshort", "ÉCOLE fermée lundi", "école fermée lundi", "tiny line", "ten chars!", "", "another shared line"]
    rows = [(int(i), "\n".join(pool[k] if k < len(pool) else f"own line {i} {k}" for k in r.integers(0, 20, r.integers(1, 12)))) for i in r.permutation(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "\n".join(f"line number {k % 700}" for k in range(3000))), (204, "line number 5\nx\nline number 699"), (7, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(frame, batches=batches, fanout=fanout)
    got = [(x.doc.doc_id, x.n_lines, x.n_dropped, hashlib.sha256(x.kept.encode()).hexdigest()) for x in got.collect()]
    assert sorted(got) == brute_lines(rows)
    assert lines.dedup_lines(odd).count() == odd.count() and lines.dedup_lines(odd.limit(0)).count() == 0


# --- 10 WARC
def test_warc(spark, tmp_path):
    big, other = "é" * 600, "x" * 5000
    rows = [(i, f"http://a/{i}\r\nX: y é", big if i % 3 else other + str(i % 2)) for i in range(40)] + [(50, None, None), (51, "u", ""), (52, "u", "small"), (53, "u", "small"), (None, "u", big), (39, "again", other + "1"), (60, "u", "a\r\n\r\nb")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    runs = []
    for run in "ab":
        folder = str(tmp_path / run)
        manifest = warc.write(frame.repartition(5), folder, shards=3, roll=3000)
        runs.append([r.sha1 for r in manifest.orderBy("file").collect()])
        got = warc.read(manifest, folder).collect()
    assert runs[0] == runs[1] and len(runs[0]) > 3
    owner = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= 1000:
            owner[t] = max(owner.get(t, -1), i)
    want = []
    for i, _, t in rows:
        data = (t or "").encode()
        to = owner.get(t) if len(data) >= 1000 and owner.get(t) != i else None
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if to is not None else "response", to, b"" if to is not None else data))
    key = lambda x: tuple(map(str, x))
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
    assert warc.round_trip(frame.limit(0)).count() == 0
