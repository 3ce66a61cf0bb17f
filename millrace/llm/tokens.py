"""Token ids in files: one zstandard frame per document, a shared dictionary, and an offset index (operator 9).

``write_tokens`` leaves two tables under its path. ``dictionary`` has one row: sha256, bytes, and the tokenizer's file name. ``blocks``
has a row for about a megabyte of frames: part, block (their order is that of doc_id), dictionary (the sha256), and for
each document doc_id, n_tokens and where its frame ends, besides the frames themselves. A frame is the document's ids as
little-endian unsigned 32-bit integers, compressed alone, so a short document is read by slicing one frame out of its block.

Defined results: a null text is an empty one and holds the end id only; equal ids are ordered by text; null ids come first;
repeated rows are documents of their own. An empty table leaves no blocks and reads as no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace.llm.store import column, frugal, slices

END_ID = 0
#: The dictionary: its bytes, about how many documents it is trained on, and how many bytes of each.
DICTIONARY = 1 << 16
SAMPLE_DOCS = 1024
SAMPLE_BYTES = 1 << 14
BLOCK_BYTES = 1 << 20
#: Words whose ids a worker keeps, with some 200 bytes for each. Fewer take more time.
KNOWN_WORDS = 1_500_000
#: New words that are encoded in a call: what the library keeps of their text stays in the processor's cache.
LEARNED_WORDS = 1 << 10
MERGED_WORDS = 1 << 7
LEVEL = 3

BLOCK_SCHEMA = ("part int, block int, dictionary string, doc_ids array<long>, n_tokens array<long>, ends array<long>, "
                "frames binary")


def _byte_signs() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable, else the next from 256."""
    signs = np.zeros(256, np.uint32)
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs[printable] = printable
    others = np.flatnonzero(signs == 0)
    signs[others] = 256 + np.arange(len(others))
    return signs


_BYTE_SIGNS = _byte_signs()
_SIGNS = ".,!?;:"
_id = attrgetter("id")


class Encoder:
    """``Tokenizer.encode`` without special tokens, with the ids of words kept between texts.

    The vocabulary splits a text into pieces before it merges bytes. A space between two other characters always begins a piece, and a
    single line end between two is a piece of its own, so such a text may be encoded word by word and each distinct word once.
    Distinct words are found by Arrow. New ones of letters are one piece each and go straight to the merges, others are encoded many in a
    call, joined by spaces; both are cut at the ids that begin with a space. Words at the start of a line are joined by line ends. Texts
    with other white space, with white space beside white space or at an end, or with the mark below are encoded whole.
    """

    _mark = "\x00"
    _letters = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")
    _white = re.compile(r"\s")

    def __init__(self, file: str, most: int = KNOWN_WORDS):
        from tokenizers import Tokenizer

        self.most = most
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.line = self.tokenizer.token_to_id("\u010a")
        self.merge = self.tokenizer.model.tokenize
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(1 + max(vocabulary.values()), np.bool_)
        self.spaced[[n for t, n in vocabulary.items() if t[0] == "\u0120"]] = True
        #: No id of letters' bytes has a space after another sign, so merges never join two words of letters.
        letters = {"\u0120", *map(chr, _BYTE_SIGNS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3]])}
        self.apart = not any("\u0120" in t.lstrip("\u0120") and letters.issuperset(t) for t in vocabulary)
        self.forget()

    def forget(self) -> None:
        """A known word's number, where its ids begin in ``ids``, and how many they are."""
        self.known: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def keep(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, total = len(self.known), len(ids)
        while len(self.ids) < self.used + total:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.start) < first + len(keys):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.ids[self.used:self.used + total] = ids
        self.start[first:first + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.size[first:first + len(keys)] = sizes
        self.used += total
        self.known.update(zip(keys, range(first, first + len(keys))))

    def many(self, words: list[str], after: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that each stand after ``after``, a space or a line end, and how many each has."""
        ids = np.array(self.plain([(after if after == " " else "") + after.join(words)])[0], np.uint32)
        if after == " ":
            first = np.flatnonzero(self.spaced[ids])
            sizes = np.diff(np.append(first, len(ids)))
        else:
            ends = np.flatnonzero(np.append(ids == self.line, True))
            sizes = np.diff(np.append(-1, ends)) - 1
            ids = ids[ids != self.line]
        if len(sizes) != len(words):
            alone = self.plain([after + w if after == " " else w for w in words])
            ids, sizes = np.array(list(chain.from_iterable(alone)), np.uint32), np.array(list(map(len, alone)), np.int64)
        return ids, sizes

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``many`` after spaces, for words of letters: one piece each, so many go to the merges in one call, which never join them."""
        found = []
        for at in range(0, len(words), MERGED_WORDS):
            data = np.frombuffer((" " + " ".join(words[at:at + MERGED_WORDS])).encode(), np.uint8)
            found += map(_id, self.merge(_BYTE_SIGNS[data].tobytes().decode("utf-32-le")))
        ids = np.array(found, np.uint32)
        return ids, np.diff(np.append(np.flatnonzero(self.spaced[ids]), len(ids)))

    def learn(self, keys: list[str]) -> None:
        """A key is a word after a space; marked, a word at the start of a line; a line end stands for itself.

        A sign after a letter is a piece of its own, so such a word is its stem's ids and the sign's.
        """
        known = [k for k in keys if k not in ("", "\n", self._mark) and not self._white.search(k)]
        letters, ended, others, lines = [], [], [], []
        for k in known:
            if k[0] == self._mark:
                lines.append(k)
            elif not self.apart:
                others.append(k)
            elif self._letters.match(k):
                letters.append(k)
            elif k[-1] in _SIGNS and self._letters.match(k, 0, len(k) - 1):
                ended.append(k)
            else:
                others.append(k)
        if letters:
            self.keep(letters, *self.merged(letters))
        if ended:
            ids, sizes = self.merged([k[:-1] for k in ended])
            signs = {s: self.plain([s])[0][0] for s in _SIGNS}
            self.keep(ended, np.insert(ids, np.cumsum(sizes), [signs[k[-1]] for k in ended]), sizes + 1)
        for after, own in ((" ", others), ("\n", lines)):
            for at in range(0, len(own), LEARNED_WORDS):
                part = own[at:at + LEARNED_WORDS]
                self.keep(part, *self.many(part if after == " " else [k[1:] for k in part], after))
        if "\n" in keys:
            self.keep(["\n"], np.array([self.line], np.uint32), np.ones(1, np.int64))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.most:
            self.forget()
        if not texts:
            return []
        marked = [self._mark + t.replace("\n", " \n " + self._mark) for t in texts]
        split = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        words = split.flatten().dictionary_encode()
        keys = words.dictionary.to_pylist()
        at = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            self.learn([keys[k] for k in unknown])
            at[unknown] = [self.known.get(keys[k], -1) for k in unknown]
        at = at[words.indices.to_numpy()]
        odd = np.diff(np.concatenate([[0], np.cumsum(at < 0)])[bounds]) > 0
        odd |= np.fromiter((self._mark in t for t in texts), np.bool_, len(texts))
        whole = iter(self.plain([t for t, o in zip(texts, odd) if o]))
        size = np.where(at < 0, 0, self.size[at])
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.start[at] - ends + size, size) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[bounds]
        return [np.array(next(whole), np.uint32) if o else ids[bounds[k]:bounds[k + 1]] for k, o in enumerate(odd)]


_encoders: dict[str, Encoder] = {}


def encoder(file: str, most: int = KNOWN_WORDS) -> Encoder:
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    _encoders[file].most = most
    return _encoders[file]


def _sampler(file: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = encoder(file).encode([t or "" for t in column(batch, "text").to_pylist()])
            yield pa.RecordBatch.from_pydict({"ids": pa.array([i.astype("<u4").tobytes()[:SAMPLE_BYTES] for i in ids],
                                                              pa.binary())})
    return sample


def train_dictionary(docs: DataFrame, file: str) -> bytes:
    """Trained on the first 16 KiB of ids of about 1,024 documents, picked by a hash of doc_id; at most 4,096 come to the driver.

    Too few documents to train on give a dictionary of their plain bytes.
    """
    apart = max(1, docs.count() // SAMPLE_DOCS)
    picked = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id"), F.lit(apart)) == 0).limit(4 * SAMPLE_DOCS)
    samples = sorted(bytes(r.ids) for r in picked.mapInArrow(frugal(_sampler(file)), "ids binary").toLocalIterator())
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


def _shared(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _packer(file: str, dictionary: bytes, digest: str, end_id: int, known_words: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared(dictionary), write_content_size=True)
        part, block = TaskContext.get().partitionId(), 0
        doc_ids, counts, frames, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(f) for f in frames]).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([digest]),
                 pa.array([doc_ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([b"".join(frames)], pa.binary())],
                names=["part", "block", "dictionary", "doc_ids", "n_tokens", "ends", "frames"])

        for batch in slices(batches, "text", most=1 << 20):
            texts = [t or "" for t in column(batch, "text").to_pylist()]
            for doc_id, ids in zip(column(batch, "doc_id").to_pylist(), encoder(file, known_words).encode(texts)):
                frame = press.compress(np.append(ids, np.uint32(end_id)).astype("<u4").tobytes())
                doc_ids.append(doc_id)
                counts.append(len(ids) + 1)
                frames.append(frame)
                size += len(frame) + 24
                if size >= BLOCK_BYTES:
                    yield row()
                    block += 1
                    doc_ids, counts, frames, size = [], [], [], 0
        if frames:
            yield row()
    return pack


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, known_words: int = KNOWN_WORDS) -> None:
    """Write the ids of ``docs`` (doc_id, text) under ``path``, in ascending doc_id order.

    ``known_words`` bounds the words whose ids a worker keeps between texts: memory against time, with the same ids.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer_file)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), tokenizer_file.rpartition("/")[2])],
                          "sha256 string, bytes binary, tokenizer string").write.parquet(f"{path}/dictionary")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(frugal(_packer(tokenizer_file, dictionary, digest, end_id, known_words)), BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def frame_ids(frame: bytes, dictionary: bytes) -> np.ndarray:
    """The ids of one document."""
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=_shared(dictionary)).decompress(frame), "<u4")


def _reader(dictionary: bytes, digest: str, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != digest:
                    raise ValueError("the frames were written with another dictionary")
                start, at, out = row["start"], 0, []
                for doc_id, count, end in zip(row["doc_ids"], row["n_tokens"], row["ends"]):
                    ids = press.decompress(row["frames"][at:end])
                    out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), np.frombuffer(ids, "<u4") if with_ids else None))
                    start, at = start + count, end
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:5 if with_ids else 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)][:len(names)], names=names)
    return read


def read_tokens(spark: SparkSession, path: str, where: Column | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, from the files.

    ``where`` selects blocks by their columns, such as ``array_contains(doc_ids, 7)``; ``start`` still counts all documents before.
    """
    stored = spark.read.parquet(f"{path}/dictionary").first()
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    index = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # One row per written partition, then a window within each: neither holds a row per document.
    parts = index.groupBy("part").agg(F.sum("n").alias("n"))
    before = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = index.withColumn("block_start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "block", (F.col("part_start") + F.col("block_start")).alias("start"))
    wanted = blocks if where is None else blocks.where(where)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = wanted.join(starts, ["part", "block"]).select("dictionary", "doc_ids", "n_tokens", "ends", "frames", "start")
    return found.mapInArrow(frugal(_reader(bytes(stored["bytes"]), stored["sha256"], with_ids)), schema)
