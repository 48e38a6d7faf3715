"""Token ids in binary files: one zstandard frame per document under a shared dictionary."""

from __future__ import annotations

import hashlib
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gripline.llm.common import LAST, cuts, id_of, least_hashed, range_of, shared_folder, text_of, width, within_bytes, written
from gripline.llm.files import committed, reader

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: The dictionary is trained on so many documents (those with the smallest id hashes) and has so many bytes.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Words whose ids a worker keeps.
KEPT_WORDS = 600_000
#: Tasks that write the sample: it is small, and a file for each shuffle partition is a file for a few rows.
SAMPLE_TASKS = 8
#: Bytes of text encoded at a time.
SLICE_BYTES = 1 << 20
#: File: magic, 32 bytes hash of the dictionary, id width; frames; index of (doc_id, n_tokens, offset, length); place of the index.
MAGIC = b"GLTOK001"
HEAD = "<8s32sI"
ENTRY = np.dtype([("doc_id", "<i8"), ("n_tokens", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("missing", "u1")])
TAIL = "<QQ8s"
MANIFEST = "shard int, file string, documents long, tokens long, bytes long, dictionary string"
#: Signs taken off the ends of words; no apostrophe, which may begin a unit of its own.
PUNCTUATION = '.,;:!?*&#$%)"'
#: Words that normal form and pre-tokenizer leave as they are, each one unit: small letters, composed.
PLAIN = re.compile("[a-zß-öø-ÿ]+")


class Encoder:
    """Ids of whole texts from the ids of their words.

    The vocabulary's pre-tokenizer never joins characters across a blank, and its normal form changes none, so a text's
    ids are its words' ids in order. A word is encoded once and kept; a tail of plain punctuation after a letter or number is a
    unit of its own for the pre-tokenizer, and ASCII words are lower-cased as its normal form does, so both are taken off before
    the look-up. After another sign the tail is part of that sign's unit, and the word is encoded whole. Words of small letters
    go to the model as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = Tokenizer(self.tokenizer.model)  # the same model, with letters as bytes and nothing before it
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parted: dict[str, bool] = {"": True}
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = sorted({s[:1] if s[1:2].isalnum() else s[:2] for s in specials if s})

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of each word as bytes. Words not met while as many others as the half of what is kept came in are forgotten."""
        recent, older = self.recent, self.older
        found = list(map(recent.get, words))
        plain, other = [], []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            if (ids := older.get(words[i])) is not None:
                recent[words[i]] = found[i] = ids
            else:
                (plain if PLAIN.fullmatch(words[i]) else other).append(i)
        for tokenizer, fresh in ((self.model, plain), (self.tokenizer, other)):
            encoded = tokenizer.encode_batch_fast([words[i] for i in fresh], add_special_tokens=False) if fresh else []
            for i, e in zip(fresh, encoded, strict=True):
                recent[words[i]] = found[i] = np.array(e.ids, np.uint32).tobytes()
        if len(recent) > KEPT_WORDS // 2:
            self.recent, self.older = {}, recent
        return found

    def _parts(self, c: str) -> bool:
        """Whether the pre-tokenizer cuts between a character and the punctuation after it."""
        if c not in self.parted:
            normal = self.tokenizer.normalizer
            both = c + PUNCTUATION
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal.normalize_str(both) if normal else both)
            self.parted[c] = pieces[-1][0] == PUNCTUATION
        return self.parted[c]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Texts that may hold a special token, which can span words, go to the tokenizer whole."""
        out: list[np.ndarray | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if any(m in t for m in self.marks)]
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        rest = [i for i in range(len(texts)) if out[i] is None]
        if rest:
            split = pc.ascii_split_whitespace(pa.array([texts[i] for i in rest], pa.large_string()))
            words = split.values.dictionary_encode()
            bare = pc.utf8_rtrim(words.dictionary, PUNCTUATION)
            before = pc.utf8_slice_codeunits(bare, -1).dictionary_encode()
            parted = pa.array([self._parts(c) for c in before.dictionary.to_pylist()], pa.bool_()).take(before.indices)
            bare = pc.if_else(parted, bare, words.dictionary)
            heads = pc.if_else(pc.string_is_ascii(bare), pc.ascii_lower(bare), bare).dictionary_encode()
            cut = pc.not_equal(bare, words.dictionary)
            tails = pc.replace_substring_regex(words.dictionary.filter(cut), f"^(?:.*[^{PUNCTUATION}])?([{PUNCTUATION}]*)$", r"\1")
            tails = pc.replace_with_mask(pa.repeat(pa.scalar("", tails.type), len(cut)), cut, tails).dictionary_encode()
            ids = self._look_up([w for part in (heads, tails) for w in part.dictionary.to_numpy(zero_copy_only=False).tolist()])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            starts = np.cumsum(sizes) - sizes
            flat = np.frombuffer(b"".join(ids), np.uint32)
            # Each word is two units, head and tail.
            units = np.stack([np.asarray(heads.indices), np.asarray(tails.indices) + len(heads.dictionary)], axis=1)
            which = units[np.asarray(words.indices)].ravel().astype(np.int64)
            n = sizes[which]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            every = flat[np.arange(total) + np.repeat(starts[which] - (ends - n), n)] if total else np.zeros(0, np.uint32)
            ends = ends[1::2]
            at = np.concatenate([[0], ends])[np.asarray(split.offsets)]
            for k, i in enumerate(rest):
                out[i] = every[at[k] : at[k + 1]]
        return out


def encoder_for(path: str) -> Encoder:
    """The worker's encoder for this file: the tasks that a worker runs one after the other share its words."""
    kept = vars(sys.modules["tokenizers"]).setdefault("_gripline_encoders", {}) if "tokenizers" in sys.modules else {}
    if path not in kept:
        encoder = Encoder(path)
        kept = vars(sys.modules["tokenizers"]).setdefault("_gripline_encoders", {})
        kept[path] = encoder
    return kept[path]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about so many bytes together, and the place of the first: one run at a time becomes Python strings."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = min(int(np.searchsorted(ends, before + most)) + 1, len(texts))
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop


def serialized(ids: np.ndarray, wide: bool, end: int | None = None) -> bytes:
    return np.append(ids, np.uint32(end)).astype("<u4" if wide else "<u2").tobytes()


def train(docs: DataFrame, path: str, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for id arrays, from at most `rows` documents and SAMPLE_BYTES of text; of rows that share an id, the text
    with the smallest hash counts. A corpus too small or uniform to train on gets an empty one."""
    key = id_of(docs, "doc_id")
    picked = F.broadcast(least_hashed(docs, key, rows, key.alias("id")).distinct())  # `rows` rows at most
    found = docs.select(key.alias("id"), text_of(docs).alias("text")).join(picked, "id")
    one = written(found.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text")).coalesce(SAMPLE_TASKS))
    sampled = within_bytes(one, SAMPLE_BYTES).select("id", "text").repartition(1).sortWithinPartitions("id")
    return next((r[0] for r in sampled.mapInArrow(_train(path, size), "dictionary binary").collect()), b"")


def _train(path: str, size: int):
    """The sample is encoded and learned from in a task: tasks keep the tokenizer anyway, and the driver never loads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        samples = [serialized(x, encoder.wide, END_ID) for batch in batches for _, texts in slices(batch.column("text")) for x in encoder.texts(texts)]
        try:
            dictionary = zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 10)), samples).as_bytes()
        except zstandard.ZstdError:
            dictionary = b""
        yield pa.RecordBatch.from_arrays([pa.array([dictionary], pa.binary())], ["dictionary"])

    return run


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _write(folder: str, path: str, dictionary: bytes, end: int):
    mark = hashlib.sha256(dictionary).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=False)

        def documents() -> Iterator[tuple[int, tuple[int, bool], np.ndarray]]:
            for batch in batches:
                shards, ids, missing = (batch.column(c).to_pylist() for c in ("shard", "id", "missing"))
                for a, texts in slices(batch.column("text")):
                    b = a + len(texts)
                    yield from zip(shards[a:b], zip(ids[a:b], missing[a:b], strict=True), encoder.texts(texts), strict=True)

        pending = next(it := documents(), None)
        while pending is not None:
            shard, entries, at = pending[0], [], struct.calcsize(HEAD)
            name = f"tokens-{shard:06d}.bin"
            with committed(folder, name) as out:
                out.write(struct.pack(HEAD, MAGIC, mark, 4 if encoder.wide else 2))
                while pending is not None and pending[0] == shard:
                    frame = packer.compress(serialized(pending[2], encoder.wide, end))
                    out.write(frame)
                    name_of, missing = pending[1]
                    entries.append((name_of, len(pending[2]) + 1, at, len(frame), missing))
                    at += len(frame)
                    pending = next(it, None)
                index = np.array(entries, ENTRY)
                out.write(index.tobytes())
                out.write(struct.pack(TAIL, at, len(entries), MAGIC))
            row = (shard, name, len(entries), int(index["n_tokens"].sum()), at + index.nbytes + struct.calcsize(TAIL), mark.hex())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["shard", "file", "documents", "tokens", "bytes", "dictionary"])

    return run


def write(docs: DataFrame, folder: str, path: str, end: int = END_ID, shards: int | None = None, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, bytes]:
    """Encode every whole text with the vocabulary file at `path`, append the id `end`, and write files to `folder` in ascending order
    of doc_id; returns the manifest and the dictionary, which is stored beside the files under its hash.

    Each file holds a range of doc_ids: one zstandard frame per document under the shared dictionary, the hash of that
    dictionary, and an index of offsets, so that one short document is read without its neighbours. Files are named once whole;
    the manifest, a row for each of them, comes last and is one file.

    A null text is the empty one: it has the end id alone. Rows without doc_id come last. Rows that repeat a doc_id are documents of their own, in order of
    their texts' hashes. An empty table gives an empty manifest. Other columns are not written.
    """
    spark = docs.sparkSession
    dictionary = train(docs, path, rows)
    with committed(folder, f"dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)
    key = id_of(docs, "doc_id")
    bounds = cuts(docs, key, shards or width(spark))
    dealt = docs.select(range_of(key, bounds).alias("shard"), key.alias("id"), docs["doc_id"].cast("long").isNull().alias("missing"), text_of(docs).alias("text"))
    dealt = dealt.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "id", "missing", F.xxhash64("text"))
    dealt.mapInArrow(_write(folder, path, dictionary, end), MANIFEST).repartition(1).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"), dictionary


class Reader:
    """Documents of one file."""

    def __init__(self, folder: str, name: str, dictionary: bytes):
        self.stream = reader(folder, name)
        magic, mark, self.width = struct.unpack(HEAD, self.stream.read(struct.calcsize(HEAD)))
        if magic != MAGIC or mark != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was not written with this dictionary")
        self.stream.seek(self.stream.size() - struct.calcsize(TAIL))
        at, n, _ = struct.unpack(TAIL, self.stream.read(struct.calcsize(TAIL)))
        self.stream.seek(at)
        self.index = np.frombuffer(self.stream.read(n * ENTRY.itemsize), ENTRY)
        self.packer = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document, end id included."""
        entry = self.index[k]
        self.stream.seek(int(entry["offset"]))
        data = self.packer.decompress(self.stream.read(int(entry["length"])))
        return np.frombuffer(data, "<u4" if self.width == 4 else "<u2").astype("<u4")

    def fetch(self, doc_id: int) -> np.ndarray:
        """Ids of a document by its doc_id."""
        k = int(np.searchsorted(self.index["doc_id"], doc_id))
        if k == len(self.index) or self.index["doc_id"][k] != doc_id or self.index["missing"][k]:
            raise KeyError(doc_id)
        return self.ids(k)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.stream.close()


def _read(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with Reader(folder, name, dictionary) as file:
                    n = file.index["n_tokens"].astype(np.int64)
                    starts = start + np.cumsum(n) - n
                    crcs = np.fromiter((zlib.crc32(file.ids(k).tobytes()) for k in range(len(n))), np.int64, len(n))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (file.index["doc_id"].astype(np.int64), starts, n, crcs, file.index["missing"].astype(bool))], ["doc_id", "start", "n_tokens", "ids_crc32", "missing"])

    return run


def read(manifest: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) from the files: start counts the ids of all documents before."""
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    placed = manifest.select("file", F.coalesce(before, F.lit(0)).alias("start"))
    rows = placed.repartition(width(manifest.sparkSession), "file").mapInArrow(_read(folder, dictionary), "doc_id long, start long, n_tokens long, ids_crc32 long, missing boolean")
    return rows.select(F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "start", "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the documents to a new shared folder and read them back."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    folder = shared_folder(docs.sparkSession)
    manifest, dictionary = write(docs, folder, path, **options)
    return read(manifest, folder, dictionary)


__all__ = ["LAST", "Encoder", "Reader", "read", "round_trip", "train", "write"]
