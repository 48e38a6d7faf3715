"""Toxicity: boosted trees over dense features of whole texts, with isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import text_of
from gripline.llm.labels import held_out, labelled, sample

#: Learned from at most so many labelled rows of each class.
SAMPLE = 2500
#: Lexicon: pieces of words, of so many letters, that mark toxic texts; the strongest ones are kept.
PIECE = range(4, 9)
LEXICON = 400
TIERS = 4
TREES = 120
DEPTH = 3
BINS = 32
RATE = 0.1
LEAST_ROWS = 20
#: Words for the second person in the languages at hand.
YOU = ("you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti", "usted", "ustedes", "vosotros", "su")
#: Words between a lexicon hit and a word for the second person that count as near.
NEAR = 6
LETTER_LIKE = "0134578@$!*"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def word_pieces(word: str) -> set[str]:
    """The bare word, marked at both ends, and its pieces."""
    bare = word.strip(".,;:!?\"'()[]#$%&*|-")
    return {f" {bare} "} | {bare[i : i + n] for n in PIECE for i in range(len(bare) - n + 1)} if bare else set()


def learn_lexicon(texts: list[str], y: list[int], most: int = LEXICON) -> dict[str, int]:
    """Pieces with a tier, 0 for the strongest: those whose share among toxic texts most exceeds that among others, in standard
    errors. Pieces that another of equal counts contains say nothing new and are left out."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for text, mark in zip(texts, y, strict=True):
        found: set[str] = set()
        for word in set(words_of(text)):
            found |= word_pieces(word)
        seen[mark].update(found)
    n = (max(1, y.count(0)), max(1, y.count(1)))
    ranked = []
    for piece, k in seen[1].items():
        if k >= 5:
            p, q = k / n[1], seen[0][piece] / n[0]
            if p > 2 * q:
                pool = (k + seen[0][piece] + 1) / (n[0] + n[1] + 2)
                ranked.append(((p - q) / math.sqrt(pool * (1 - pool) * (1 / n[0] + 1 / n[1])), k, piece))
    ranked.sort(key=lambda x: (-x[0], -len(x[2]), x[2]))
    chosen: list[tuple[float, int, str]] = []
    by_count: dict[tuple[float, int], list[str]] = {}
    for z, k, piece in ranked:
        alike = by_count.setdefault((round(z, 9), k), [])
        if z > 4 and not any(piece.strip() in other for other in alike):
            alike.append(piece)
            chosen.append((z, k, piece))
            if len(chosen) >= most:
                break
    size = max(1, -(-len(chosen) // TIERS))
    return {piece: i // size for i, (_, _, piece) in enumerate(chosen)}


class Features:
    """Dense features of a text; every word of it counts."""

    def __init__(self, lexicon: dict[str, int]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for piece, tier in lexicon.items():
            self.machine.add_word(piece, (tier, len(piece)))
        self.some = bool(lexicon)
        if self.some:
            self.machine.make_automaton()
        table = np.zeros((128, 6))
        for i in range(128):
            c = chr(i)
            table[i] = (c.isupper(), c.islower(), c.isdigit(), c.isspace(), c in ".,;:!?", not c.isalnum() and not c.isspace() and c not in ".,;:!?")
        self.kinds = table

    def names(self) -> int:
        return 2 * TIERS + 12

    def __call__(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        size = max(1, len(raw))
        plain = np.bincount(raw[raw < 128], minlength=128)
        upper, lower, digit, space, mark, odd = plain @ self.kinds
        # Words bare of marks, with one blank at each side, so that whole words and pieces are found in one pass.
        words = [w.strip(".,;:!?\"'()[]#$%&*|-") for w in words_of(text)]
        line = "  ".join(["", *words, ""])
        hits, places = [0] * TIERS, []
        if self.some:
            for end, (tier, length) in self.machine.iter(line):
                hits[tier] += 1
                if tier < 2:
                    places.append(end - length // 2)
        n = max(1, len(words))
        near = 0
        if places:
            starts = np.cumsum([2, *(len(w) + 2 for w in words)])[:-1]
            you = np.array([i for i, w in enumerate(words) if w in YOU])
            if len(you):
                at = np.searchsorted(starts, np.array(places), side="right") - 1
                k = np.searchsorted(you, at)
                gap = np.minimum(np.abs(you[np.minimum(k, len(you) - 1)] - at), np.abs(you[np.maximum(k - 1, 0)] - at))
                near = int((gap <= NEAR).sum())
        hidden = sum(1 for w in words if not w.isalpha() and any(c in LETTER_LIKE for c in w) and any(c.isalpha() for c in w))
        spaced = sum(1 for a, b in zip(words, words[1:], strict=False) if len(a) == 1 and len(b) == 1)
        letters = max(1.0, upper + lower)
        rest = [near / n, near > 0, upper / letters, digit / size, mark / size, odd / size, space / size, hidden / n, spaced / n, math.log(n), sum(map(len, words)) / n, (size - plain.sum()) / size]
        return np.array([*(h / n for h in hits), *hits, *rest], np.float64)


class Trees:
    """Gradient boosting for log loss over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES):
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
        self.cuts = [np.unique(np.append(c, 0.0)) for c in self.cuts]
        share = np.clip((weight * y).sum() / max(1e-9, weight.sum()), 1e-3, 1 - 1e-3)
        self.base = math.log(share / (1 - share))
        self.trees: list[dict] = []
        bins = self.binned(x)
        margin = np.full(len(x), self.base)
        for _ in range(trees if len(set(y.tolist())) == 2 else 0):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(bins, weight * (p - y), weight * p * (1 - p), np.arange(len(x)), DEPTH)
            margin += self._values(tree, bins)
            self.trees.append(tree)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1) if len(x) else np.zeros(x.shape, np.int64)

    def _grow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> dict:
        gs, hs = g[rows].sum(), h[rows].sum()
        leaf = {"value": -RATE * gs / (hs + 1.0)}
        if not depth or len(rows) < 2 * LEAST_ROWS:
            return leaf
        best = (1e-6, 0, 0)
        for j, cuts in enumerate(self.cuts):
            b, m = bins[rows, j], len(cuts) + 1
            gl, hl, nl = (np.cumsum(np.bincount(b, w, m))[:-1] for w in (g[rows], h[rows], None))
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            gain[(nl < LEAST_ROWS) | (len(rows) - nl < LEAST_ROWS)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), j, int(gain.argmax()))
        if best[0] <= 1e-6:
            return leaf
        _, j, k = best
        left = bins[rows, j] <= k
        return {"feature": j, "bin": k, "left": self._grow(bins, g, h, rows[left], depth - 1), "right": self._grow(bins, g, h, rows[~left], depth - 1)}

    def _values(self, tree: dict, bins: np.ndarray) -> np.ndarray:
        if "value" in tree:
            return np.full(len(bins), tree["value"])
        return np.where(bins[:, tree["feature"]] <= tree["bin"], self._values(tree["left"], bins), self._values(tree["right"], bins))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        return self.base + sum((self._values(t, bins) for t in self.trees), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising curve of label shares that fits best, by pooling neighbours that fall."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, v, w in zip(margin[order], y[order], weight[order], strict=True):
        blocks.append([v * w, w, m * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top, strict=True)]
    if not blocks:
        return np.array([0.0]), np.array([0.5])
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(texts: list[str], y: list[int], weights: tuple[float, float] = (1.0, 1.0)) -> dict:
    """Lexicon from two folds of three, trees from the second and calibration from the third, so that no part is judged by its own rows;
    weights restore the classes' shares."""
    marks = np.array(y, np.int64)
    fold = np.arange(len(y)) % 3
    pick = lambda *k: [i for i in range(len(y)) if fold[i] in k]
    for_words, for_trees, for_curve = pick(0), pick(1), pick(2)
    lexicon = learn_lexicon([texts[i] for i in for_words], [y[i] for i in for_words])
    features = Features(lexicon)
    x = np.array([features(t) for t in texts]) if texts else np.zeros((0, features.names()))
    w = np.where(marks == 1, weights[1], weights[0]).astype(np.float64)
    trees = Trees(x[for_trees], marks[for_trees].astype(np.float64), w[for_trees])
    curve = isotonic(trees(x[for_curve]), marks[for_curve].astype(np.float64), w[for_curve])
    return {"lexicon": lexicon, "trees": trees, "curve": curve}


def scores(model: dict, texts: list[str], features: Features | None = None) -> np.ndarray:
    features = features or Features(model["lexicon"])
    if not texts:
        return np.zeros(0)
    margin = model["trees"](np.array([features(t) for t in texts]))
    return np.interp(margin, *model["curve"])


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model["lexicon"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(model, batch.column("text").to_pylist(), features))], ["doc_id", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> dict:
    """The model, learned from at most `rows` labelled documents of each class outside the held-out third; class shares are counted
    over all of them."""
    known = labelled(docs, labels, "toxic")
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    parts = [sample(docs, known.where(F.col("y") == k), rows) for k in (0, 1)]
    weights = tuple(n.get(k, 0) / max(1, len(parts[k][1])) for k in (0, 1))
    every = [(t, m) for texts, marks in parts for t, m in zip(texts, marks, strict=True)]
    order = np.random.default_rng(5).permutation(len(every))
    return fit([every[i][0] for i in order], [every[i][1] for i in order], weights)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """Rows (doc_id, score): the calibrated probability that each row's whole text is toxic.

    Features are densities of a learned lexicon in tiers, hits near words for the second person, and rates of capitals, marks, other
    signs, digits and hidden spellings. A null text is scored as the empty one, whose features are zeros. Each row has one score, also a repeated
    one or one without doc_id. An empty table gives an empty one. Other columns are not used.
    """
    return docs.select(docs["doc_id"], text_of(docs).alias("text")).mapInArrow(_score(model), "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score(docs, train(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
