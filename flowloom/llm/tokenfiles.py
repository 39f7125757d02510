"""Token ids as flat binary files: a Spark data source that writes and reads them.

A set of token files is a folder. Each shard has ``<name>.ids``, the ids of its documents one after
the other as little-endian unsigned integers of 2 or 4 bytes, and ``<name>.index``, for each document
two little-endian 64-bit integers: its id and the offset, in ids of this shard, where it ends. The
smallest 64-bit integer stands for a null document id. ``manifest.json`` is written last, by the
commit: the shards in order, with the number of documents and ids of each. The base of a shard is the
sum of the ids of the shards before it, so that nothing has to be renumbered when shards are written
side by side. Shards of lost or repeated attempts have names of their own and are not in the manifest.
"""

from __future__ import annotations

import gc
import itertools
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from flowloom.plans.checkpoints import scratch_path

from .store import small_batches

NO_ID = np.iinfo(np.int64).min
CACHED_WORDS = 600_000
JOINED_WORDS = 50
READ_DOCS = 4096
#: Documents that are encoded together: their absent words go to the tokenizer at once.
ENCODED_DOCS = 1024

DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a plain path or ``file:`` is local, other schemes are Arrow's."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class Encoder:
    """Ids of whole texts, with what stands between white space encoded once while it is remembered.

    A tokenizer that drops ASCII white space and never joins what it separates gives for a text the ids
    of its words in order. ``splits`` says so; without it whole texts are encoded. New words are sent to
    the tokenizer many at a time with the separator between them, and its single id cuts the answer;
    words that hold the separator themselves are encoded alone.
    """

    SEPARATOR = "0"

    def __init__(self, path: str, dtype: str, splits: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        mark = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.mark, self.splits = mark[0], splits and len(mark) == 1
        self.known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        alone = [i for i, t in enumerate(texts) if self.SEPARATOR in t]
        for i, ids in zip(alone, self._ids([texts[i] for i in alone]), strict=True):
            self.known[words[i]] = np.array(ids, self.dtype).tobytes()
        rest = [i for i, t in enumerate(texts) if self.SEPARATOR not in t]
        joined = [rest[at : at + JOINED_WORDS] for at in range(0, len(rest), JOINED_WORDS)]
        between = f" {self.SEPARATOR} "
        for part, ids in zip(joined, self._ids([between.join(texts[i] for i in part) for part in joined]), strict=True):
            ids = np.array(ids, self.dtype)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer does not keep words apart; use splits=False")
            raw, size = ids.tobytes(), self.dtype.itemsize
            starts, ends = [0, *((cuts + 1) * size).tolist()], [*(cuts * size).tolist(), len(raw)]
            self.known.update((words[i], raw[s:e]) for i, s, e in zip(part, starts, ends, strict=True))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if not self.splits:
            return [np.array(ids, self.dtype).tobytes() for ids in self._ids([(t or b"").decode() for t in texts])]
        known, out, absent = self.known.get, [], []
        fresh: set[bytes] = set()
        for i, t in enumerate(texts):
            words = t.split() if t else []
            coded = list(map(known, words))
            if None in coded:
                absent.append((i, words))
                fresh.update(w for w, c in zip(words, coded, strict=True) if c is None)
                out.append(b"")
            else:
                out.append(b"".join(coded))
        if fresh:
            self._learn(list(fresh))
            for i, words in absent:
                out[i] = b"".join(map(self.known.__getitem__, words))
            if len(self.known) > CACHED_WORDS:  # what came first comes often
                self.known = dict(itertools.islice(self.known.items(), CACHED_WORDS // 2))
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def shared_encoder(path: str, dtype: str, splits: bool) -> Encoder:
    """One encoder for each worker process, so that its tasks share what they have encoded."""
    key = (path, dtype, splits)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, dtype, splits)
    return _ENCODERS[key]


@contextmanager
def uncollected() -> Iterator[None]:
    """No searches for cycles inside: encoding makes millions of lists and bytes and no cycle."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


@dataclass
class Shard(WriterCommitMessage):
    name: str
    part: int
    docs: int
    ids: int


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.tokenizer, self.end = options["path"], options["tokenizer"], int(options["end"])
        self.dtype, self.splits = options["dtype"], options["splits"] == "true"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Shard:
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        files, root = storage(self.path)
        files.create_dir(root, recursive=True)
        encoder, end = shared_encoder(self.tokenizer, self.dtype, self.splits), np.array([self.end], self.dtype).tobytes()
        docs = total = 0
        with uncollected(), files.open_output_stream(f"{root}/{name}.ids") as ids, files.open_output_stream(f"{root}/{name}.index") as index:
            for batch in batches:
                for at in range(0, len(batch), ENCODED_DOCS):
                    some = batch.slice(at, ENCODED_DOCS)
                    names = some.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                    coded = encoder.encode(some.column(1).to_pylist())
                    ends = total + np.cumsum([len(c) // encoder.dtype.itemsize + 1 for c in coded])
                    ids.write(b"".join(c + end for c in coded))
                    index.write(np.column_stack([names, ends]).astype("<i8").tobytes())
                    docs, total = docs + len(coded), int(ends[-1])
        return Shard(name, part, docs, total)

    def commit(self, messages: list[Shard | None]) -> None:
        shards = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        bases = [0, *itertools.accumulate(s.ids for s in shards)]
        manifest = {"dtype": self.dtype, "end": self.end, "shards": [{"name": s.name, "docs": s.docs, "ids": s.ids, "base": b} for s, b in zip(shards, bases, strict=False)]}
        files, root = storage(self.path)
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/manifest.json") as out:
            out.write(json.dumps(manifest).encode())

    def abort(self, messages: list[Shard | None]) -> None:
        """Shards without a manifest are not part of any set."""


class TokenFiles:
    """The documents of a folder of token files, memory-mapped where the folder is local."""

    def __init__(self, path: str):
        self.files, self.root = storage(path)
        with self.files.open_input_stream(f"{self.root}/manifest.json") as source:
            manifest = json.loads(source.read())
        self.dtype, self.end, self.shards = np.dtype(manifest["dtype"]).newbyteorder("<"), manifest["end"], manifest["shards"]

    def shard(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document ids, their ends, and the ids of one shard."""
        shard = self.shards[at]
        if not shard["docs"]:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, self.dtype)
        if isinstance(self.files, fs.LocalFileSystem):
            index = np.memmap(f"{self.root}/{shard['name']}.index", "<i8", "r").reshape(-1, 2)
            ids = np.memmap(f"{self.root}/{shard['name']}.ids", self.dtype, "r")
        else:
            read = lambda kind: self.files.open_input_stream(f"{self.root}/{shard['name']}.{kind}").read()
            index, ids = np.frombuffer(read("index"), "<i8").reshape(-1, 2), np.frombuffer(read("ids"), self.dtype)
        if len(index) != shard["docs"] or len(ids) != shard["ids"]:
            raise ValueError(f"{shard['name']} does not hold what the manifest says")
        return index[:, 0], index[:, 1], ids


@dataclass
class ShardNumber(InputPartition):
    at: int


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def partitions(self) -> list[ShardNumber]:
        return [ShardNumber(i) for i in range(len(TokenFiles(self.path).shards))]

    def read(self, partition: ShardNumber) -> Iterator[pa.RecordBatch]:
        source = TokenFiles(self.path)
        base, (names, ends, ids) = source.shards[partition.at]["base"], source.shard(partition.at)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        for at in range(0, len(ends), READ_DOCS):
            s, e, n = starts[at : at + READ_DOCS], ends[at : at + READ_DOCS], names[at : at + READ_DOCS]
            wide, first = ids[s[0] : e[-1]].astype("<u4", copy=False), int(s[0])
            sums = [zlib.crc32(wide[i - first : j - first]) for i, j in zip(s.tolist(), e.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(n.astype(np.int64), mask=n == NO_ID), pa.array(base + s), pa.array(e - s), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )


class TokenFileSource(DataSource):
    """``spark.read`` gives a digest of each document, ``df.write`` takes ``doc_id`` and ``text``."""

    @classmethod
    def name(cls) -> str:
        return "tokenfiles"

    def schema(self) -> str:
        return DIGEST

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int, vocabulary: int, splits: bool = False, partitions: int | None = None) -> None:
    """Write the ids of ``docs`` (``doc_id``, ``text``; others are ignored) to ``path`` in ascending id order.

    Null ids come first, rows that repeat an id in the order of a hash of their texts. A null or empty text is
    its end id alone. Ids take 2 bytes while ``vocabulary`` fits, else 4. An empty table gives a
    manifest without documents. A range partition of bounded size is one shard: ranges are cut by id,
    by the hash of the text where an id repeats, and by where rows were read where both do.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenFileSource)
    text = F.col("text").cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_print"), F.monotonically_increasing_id().alias("_read"))
    by = ("doc_id", "_print", "_read")
    spread = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    writer = spread.sortWithinPartitions(*by).select("doc_id", "text").write.format("tokenfiles").mode("append")
    with small_batches(spark, ENCODED_DOCS):
        writer.option("tokenizer", tokenizer).option("end", str(end)).option("dtype", dtype).option("splits", str(splits).lower()).save(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    spark.dataSource.register(TokenFileSource)
    return spark.read.format("tokenfiles").load(path)


def token_digest(docs: DataFrame, tokenizer: str, end: int, vocabulary: int, splits: bool = False) -> DataFrame:
    """Write ``docs`` as token files below the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer, end, vocabulary, splits)
    return read_token_files(docs.sparkSession, path)
