"""Hard negatives, fill-in-middle and packing against plain loops, with odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripline.llm import infill, negatives, packing, queries

VECTORS = "vec_id long, embedding array<double>, label int, score long, rank int, id long, h long, task int"
DOCS = "doc_id long, text string, lang string, uid long, piece long, form string, output string, length int"
MARKED = "before <S> after"
WIDE = "ä€😀x yz-" * 9000


# --- 11 hard negatives
def brute(rows, positives=5, negatives_=10):
    """Rows by plain loops over distinct usable rows."""
    usable = []
    for i, v, k in dict.fromkeys((i, None if v is None else tuple(v), k) for i, v, k in rows):
        if v is not None and k is not None and None not in v and np.isfinite(v).all():
            usable.append((i, k, [int(x) * 256 if abs(x) >= 2**53 else int(np.floor(256 * x)) for x in v]))
    hold = lambda s: max(-negatives.MOST, min(negatives.MOST, s))
    late = lambda i: (i is None, i or 0)
    out = []
    for j, (a, k, x) in enumerate(usable):
        if a is None or a % 100:
            continue
        met = [(hold(sum(p * q for p, q in zip(x, y, strict=True))), i, other) for n, (i, other, y) in enumerate(usable) if n != j and len(y) == len(x)]
        met.sort(key=lambda r: (-r[0], late(r[1])))
        for score, positive, _ in [r for r in met if r[2] == k][:positives]:
            hard = [r for r in met if r[2] != k and 30 * score <= 100 * r[0] <= 90 * score][:negatives_]
            out += [(a, positive, rank, i, score, s) for rank, (s, i, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


def as_rows(frame):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in frame.collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    """Ties, a frequent label, negative scores, odd rows; with small anchor blocks, lanes and steps as well."""
    if small:
        monkeypatch.setattr(negatives, "ANCHORS", 3)
        monkeypatch.setattr(negatives, "PER_LANE", 90)
        monkeypatch.setattr(negatives, "STEP", 1)
    r = np.random.default_rng(5)
    centres = r.standard_normal((4, 12)) * 0.2
    rows = [(i * 10, (centres[i % 4] + r.standard_normal(12) * 0.3).round(2).tolist(), 0 if i % 3 else i % 5) for i in range(250)]
    rows += [(10_000 + i, rows[7][1], i % 4) for i in range(60)]  # one very common vector
    rows += [(20_000, None, 1), (20_100, [float("nan")] + [0.1] * 11, 1), (20_200, [None] + [0.1] * 11, 1), (20_300, [0.1] * 12, None), (20_400, [float("inf")] + [0.1] * 11, 1)]
    rows += [(20_500, [0.0] * 12, 1), (20_600, [], 1), (20_700, [], 1), (20_701, [], 2), (20_800, [1.0, 2.0], 1), (20_801, [2.0, 1.0], 1), (20_802, [0.5, 0.9], 2), (None, rows[0][1], 0), (None, rows[0][1], 3)]
    rows += [rows[3], rows[3], (100, rows[4][1], 0), (-100, rows[5][1], 0), (2**63 - 1, rows[6][1], 3), (2**62, rows[6][1], 3)]
    frame = spark.createDataFrame([(*row, 1, 2, 3, 4, 5) for row in rows], VECTORS)
    got = as_rows(negatives.hard_negatives(frame))
    want = brute(rows)
    assert len(want) > 500 and got == want
    assert negatives.hard_negatives(frame.limit(0)).count() == 0


def test_hard_negatives_of_huge_vectors(spark):
    """Components whose products doubles cannot add exactly, and scores beyond 64 bits."""
    r = np.random.default_rng(8)
    rows = [(i * 50, (r.standard_normal(6) * 10.0 ** (3 + 8 * (i % 2))).tolist(), i % 2 + 3 * (i % 5 == 0)) for i in range(24)]
    rows += [(5000, [1e300, 1.0], 9), (5001, [1e300, 2.0], 9), (5002, [1e-3, 2.0], 8), (5003, [7.0, 2.0], 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert as_rows(negatives.hard_negatives(frame)) == brute(rows)


def test_windows():
    for p in range(-400, 400):
        low, high = negatives.window_of(p)
        assert [s for s in range(-500, 500) if 30 * p <= 100 * s <= 90 * p] == list(range(low, high + 1))


def test_scan_drops_rows_early():
    """Rows far from all windows go before all columns are read, and none that belongs goes."""
    import pyarrow as pa

    r = np.random.default_rng(3)
    x = r.standard_normal((500, 64))
    x[:20] = x[0] + r.standard_normal((20, 64)) * 0.01
    columns = [pa.array(range(500)), pa.array(range(500)), pa.array([0] * 500), pa.array(x.tolist(), pa.list_(pa.float64()))]
    block = negatives.Block(pa.RecordBatch.from_arrays(columns, ["id", "h", "label", "embedding"]))
    anchor = negatives.Anchor(900, 0, 0, x[0], [(-negatives.MOST, negatives.MOST)], 5)
    alive, score = anchor._scan(block, np.arange(500))
    exact = negatives.quantised(x) @ negatives.quantised(x[0])
    assert len(alive) < 25 and set(np.argsort(-exact)[:5]) <= set(alive) and (score == exact[alive]).all()


# --- 12 fill-in-middle
def plain_form(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    words = " ".join(f"word{i}" for i in range(300))
    texts = [words, "", None, "a", "\n", "é", "<", MARKED, WIDE, "a" * 20_000, "<P" + words + "S>", "é \U0001f469‍\U0001f680 <S", "x" * 4096 + "y", "ab" * 2048 + " " + "c" * 4096, " " * 9000]
    return [(i * 7 + k, t) for i, t in enumerate(texts) for k in range(7)] + [(None, words), (None, None), (3, words), (3, words), (2**63 - 1, words), (-5, words)]


def test_fill_in_middle(spark, monkeypatch):
    monkeypatch.setattr(infill, "BATCH", 50_000)
    rows = [(i, t, "en", 1, 2, "x", "y", 3) for i, t in odd_texts()]
    frame = spark.createDataFrame(rows, DOCS)
    got = infill.fill_in_middle(frame).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = [(i, t or "", *plain_form(i, t or "")) for i, t in odd_texts()]
    assert sorted([(r.doc_id, r.back, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=str) == sorted(want, key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(frame.limit(0)).count() == 0


def test_cuts_at_every_unit():
    text = "ab cd€😀ef" * 40
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    for block in (1, 2, 3, 8, 64, 4096):
        tree = infill.Units(text.encode(), block)
        assert tree.units == len(units) and tree.points == len(text)
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert tree.cut(k) == (len(before.encode()), len(before))


def test_fenwick():
    r = np.random.default_rng(0)
    for size in (0, 1, 2, 7, 8, 100):
        counts = r.integers(0, 4, (size, 2))
        tree = infill.Fenwick(counts)
        for k in range(int(counts[:, 0].sum()) + 2):
            at, before = tree.descend(k)
            assert at == int((np.cumsum(counts[:, 0]) <= k).sum()) and (before == counts[:at].sum(axis=0)).all()


# --- 13 packing
def plain_first_fit(sizes, capacity):
    bins, out = [], []
    for s in sizes:
        b = next((i for i, used in enumerate(bins) if used + s <= capacity), len(bins))
        if b == len(bins):
            bins.append(0)
        out.append((b, bins[b]))
        bins[b] += s
    return out


def test_tournament():
    r = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 400):
        sizes = r.integers(1, 65, n).tolist()
        assert packing.first_fit(sizes, 64) == plain_first_fit(sizes, 64)
        assert packing.first_fit(sorted(sizes)[::-1], 64) == plain_first_fit(sorted(sizes)[::-1], 64)


def packing_rows():
    words = " ".join(f"word{i} and more" for i in range(40))
    rows = [(i, " ".join(words.split()[: i * 13 % 120])) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, " \n"), (None, words), (None, None), (5, words), (5, words), (103, words * 30), (2**63 - 1, "Ab ä€")]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_packing(spark, tokenizer):
    frame = spark.createDataFrame([(i, t, "en", 1, 2, "x", "y", 3) for i, t in packing_rows()], DOCS)
    got = packing.packed_pieces(frame, length=64, group=40).collect()
    # all ids, each once, in whole documents
    documents = {}
    for r in got:
        documents.setdefault((r.doc_id, r.doc_tokens, r.sequence_id if r.doc_id in (5, None) and r.doc_tokens <= 64 else 0), []).append(r)
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in packing_rows()]
    assert sum(r.length for r in got) == sum(len(x) for _, x in ids)
    for i, x in ids:
        if i in (None, 5):
            continue
        parts = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist() == x
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts[:-1])]).tolist() and {r.doc_tokens for r in parts} == {len(x)}
    want = sorted(str(x[k : k + 64]) for _, x in ids for k in range(0, len(x), 64))
    assert sorted(str(np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    # sequences without gaps, and nearly full
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    sizes = []
    for rows in by.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0, *(r.length for r in rows[:-1])]).tolist()
        sizes.append(sum(r.length for r in rows))
    assert max(sizes) <= 64 and sum(64 - s for s in sizes) < 0.1 * sum(sizes)
    assert packing.packed_pieces(frame.limit(0)).count() == 0


def test_groups_are_packed_as_by_loops(spark):
    """Every group's places equal first-fit decreasing by plain loops."""
    cut = packing.pieces(spark.createDataFrame([(i, "word " * (i * 37 % 300)) for i in range(200)], "doc_id long, text string"), length=128)
    placed = packing.pack(cut, length=128, group=50)
    sizes = {(r.uid, r.piece): r.length for r in cut.select("uid", "piece", "length").collect()}
    groups = -(-len(sizes) // 50)
    got = {}
    for r in placed.collect():
        got.setdefault(r.sequence_id % groups, {})[r.uid, r.piece] = (r.sequence_id // groups, r.offset)
    assert len(got) == groups and sum(map(len, got.values())) == len(sizes)
    for rows in got.values():
        order = sorted(rows, key=lambda k: (-sizes[k], k))
        assert [rows[k] for k in order] == plain_first_fit([sizes[k] for k in order], 128)


def test_sequences(spark):
    cut = packing.pieces(spark.createDataFrame([(i, "word " * (i * 37 % 300)) for i in range(50)], "doc_id long, text string"), length=128)
    placed = packing.pack(cut, length=128, group=20)
    rows = packing.sequences(cut, placed, length=128, pad=7).collect()
    joined = cut.join(placed, ["uid", "piece"]).collect()
    for r in rows:
        parts = sorted((p for p in joined if p.sequence_id == r.sequence_id), key=lambda p: p.offset)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in parts]).tolist()
        assert r.n_tokens == len(ids)
        assert np.frombuffer(r.ids, "<u4").tolist() == (ids if len(ids) & (len(ids) - 1) == 0 else ids + [7] * (128 - len(ids)))
    assert sum(r.n_tokens for r in rows) == sum(p.length for p in joined)


def test_packing_query(spark, tokenizer):
    """The registered query over whole tables: its checksums are those of the tokenizer's ids."""
    folder = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.start): r for r in queries.op13_packing(spark, folder).collect()}
    n = 0
    for r in queries.table(spark, folder, "documents").select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), packing.LENGTH):
            piece = got[r.doc_id, start]
            part = ids[start : start + packing.LENGTH]
            assert (piece.length, piece.doc_tokens, piece.ids_crc32) == (len(part), len(ids), zlib.crc32(part.tobytes()))
            n += 1
    assert n == len(got)
    used = {}
    for r in got.values():
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sum(packing.LENGTH - u for u in used.values()) < 0.02 * sum(used.values())
