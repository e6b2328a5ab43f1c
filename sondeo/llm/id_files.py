"""Files of token ids in ascending order of documents: a data source that Spark writes and reads.

A file is: words (Simple-8b, eight bytes each), then its tables, then TRAILER. The tables are, one after the other: the
first word of each block and the number of all words, the documents' ids, whether each is null (a byte), and how many
token ids each has. All numbers are little-endian. A folder's manifest.json names its files in order, with the number of
token ids before each; files that it doesn't name are not part of it.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import simple8b
from .common import small_batches
from .tokens import encoder

NAME, MANIFEST, MAGIC, VERSION = "token_ids", "manifest.json", b"TOKENIDS", 1
#: magic, version, block, documents, token ids, words, blocks, CRC-32 of the tables, zero.
TRAILER = "<8sIIQQQQII"
TRAILER_BYTES = struct.calcsize(TRAILER)
#: Token ids after which a task begins another file; that are coded, or read, at once.
FILE_IDS, AT_ONCE = 1 << 27, 1 << 18
READ_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """A store that tasks and driver can write to, and the path in it."""
    return pafs.FileSystem.from_uri(uri)


class FileWriter:
    """One file; documents come in ascending order."""

    def __init__(self, store: pafs.FileSystem, path: str) -> None:
        self.out = store.open_output_stream(path)
        self.docs: list[int | None] = []
        self.lengths: list[np.ndarray] = []
        self.words_by_block: list[np.ndarray] = []
        self.n_ids = self.n_words = 0

    def add(self, docs: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        counts = simple8b.block_counts(lengths)
        per = max(1, AT_ONCE // simple8b.BLOCK)
        at = 0
        for i in range(0, len(counts), per):
            some = counts[i : i + per]
            words, by_block = simple8b.encode(ids[at : at + int(some.sum())], some)
            self.out.write(words.astype("<u8").tobytes())
            self.words_by_block.append(by_block)
            self.n_words += len(words)
            at += int(some.sum())
        self.docs += docs
        self.lengths.append(lengths)
        self.n_ids += at

    def close(self) -> None:
        first_word = np.cumsum(np.concatenate([[0], *self.words_by_block])).astype("<u8")
        known = [0 if d is None else d for d in self.docs]
        tables = b"".join(x.tobytes() for x in (first_word, np.array(known, "<i8"), np.array([d is None for d in self.docs], "u1"), np.concatenate([np.zeros(0, "<u8"), *self.lengths]).astype("<u8")))
        self.out.write(tables)
        self.out.write(struct.pack(TRAILER, MAGIC, VERSION, simple8b.BLOCK, len(self.docs), self.n_ids, self.n_words, len(first_word) - 1, zlib.crc32(tables), 0))
        self.out.close()


def read_file(store: pafs.FileSystem, path: str, at_once: int = AT_ONCE) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Documents, how many token ids each has, and these one after the other: parts of a file of about at_once ids, or one document."""
    with store.open_input_file(path) as file:
        end = file.size() - TRAILER_BYTES
        file.seek(max(0, end))
        head = file.read()
        if end < 0 or (found := struct.unpack(TRAILER, head))[:3] != (MAGIC, VERSION, simple8b.BLOCK):
            raise ValueError(f"not a file of token ids: {path}")
        _, _, _, n_docs, n_ids, n_words, n_blocks, crc, _ = found
        if end != 8 * n_words + 8 * (n_blocks + 1) + 17 * n_docs:
            raise ValueError(f"{path} is not as long as it says")
        file.seek(8 * n_words)
        tables = file.read(end - 8 * n_words)
        if zlib.crc32(tables) != crc:
            raise ValueError(f"the tables of {path} are damaged")
        first_word = np.frombuffer(tables, "<u8", n_blocks + 1).astype(np.int64)
        known = np.frombuffer(tables, "<i8", n_docs, 8 * (n_blocks + 1))
        absent = np.frombuffer(tables, "u1", n_docs, 8 * (n_blocks + 1 + n_docs))
        lengths = np.frombuffer(tables, "<u8", n_docs, 8 * (n_blocks + 1 + n_docs) + n_docs).astype(np.int64)
        counts = simple8b.block_counts(lengths)
        first_block = np.concatenate([[0], np.cumsum(-(-lengths // simple8b.BLOCK))])
        total = np.concatenate([[0], np.cumsum(lengths)])
        at = 0
        while at < n_docs:
            to = max(at + 1, int(np.searchsorted(total, total[at] + at_once, side="right")) - 1)
            a, b = int(first_block[at]), int(first_block[to])
            file.seek(8 * int(first_word[a]))
            words = np.frombuffer(file.read(8 * int(first_word[b] - first_word[a])), "<u8")
            ids = simple8b.decode(words, np.diff(first_word[a : b + 1]), counts[a:b])
            yield [None if n else int(d) for d, n in zip(known[at:to], absent[at:to], strict=True)], lengths[at:to], ids
            at = to


@dataclass
class Written(WriterCommitMessage):
    partition: int
    #: name, documents, ids, first document and last document of each file, in order
    files: list[tuple[str, int, int, int | None, int | None]]


def _order(doc: int | None) -> tuple[bool, int]:
    return (doc is not None, doc or 0)


class IdsWriter(DataSourceArrowWriter):
    """Each task writes files under names of its own; what commit() is told of goes into the manifest, all other files go."""

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path.rstrip("/"), overwrite
        store, folder = _store(self.path)
        if not overwrite and store.get_file_info(f"{folder}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise ValueError(f"{path} holds ids already")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = _store(self.path)
        store.create_dir(folder)
        files: list[tuple] = []
        file, name = None, ""

        def close() -> None:
            if file:
                file.close()
                files.append((name, len(file.docs), file.n_ids, file.docs[0], file.docs[-1]))

        for batch in iterator:
            if not batch.num_rows:
                continue
            docs, blob = batch.column(0).to_pylist(), batch.column(1)
            if blob.null_count:
                raise ValueError("a row has no ids")
            offsets = np.frombuffer(blob.buffers()[1], np.int64 if pa.types.is_large_binary(blob.type) else np.int32)[blob.offset : blob.offset + len(blob) + 1]
            ids = np.frombuffer(blob.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]].view("<u4")
            if file is None or file.n_ids >= FILE_IDS:
                close()
                name = f"ids-{uuid.uuid4().hex}.s8b"
                file = FileWriter(store, f"{folder}/{name}")
            so_far = [*file.docs[-1:], *docs]
            if any(_order(a) > _order(b) for a, b in zip(so_far, so_far[1:], strict=False)):
                raise ValueError("documents do not come in ascending order")
            file.add(docs, np.diff(offsets).astype(np.int64) // 4, ids)
        close()
        return Written(TaskContext.get().partitionId(), files)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = _store(self.path)
        store.create_dir(folder)
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        for (_, _, _, _, last), (name, _, _, first, _) in zip(files, files[1:], strict=False):
            if _order(last) > _order(first):
                raise ValueError(f"{name} begins before the file in front of it ends")
        listed, start = [], 0
        for name, docs, ids, _, _ in files:
            listed.append({"file": name, "docs": docs, "ids": ids, "start": start})
            start += ids
        with store.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps({"files": listed}).encode())
        self._keep(store, folder, {f["file"] for f in listed})

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _store(self.path)
        for m in messages:
            for name, *_ in m.files if m else ():
                if store.get_file_info(f"{folder}/{name}").type != pafs.FileType.NotFound:
                    store.delete_file(f"{folder}/{name}")

    def _keep(self, store: pafs.FileSystem, folder: str, names: set[str]) -> None:
        for info in store.get_file_info(pafs.FileSelector(folder)):
            if info.base_name.endswith(".s8b") and info.base_name not in names:
                store.delete_file(info.path)


class IdsReader(DataSourceReader):
    """One partition a file. `ids` is an array of numbers, or where the schema says binary, four little-endian bytes each."""

    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.names = path.rstrip("/"), schema.names
        self.binary = any(f.name == "ids" and isinstance(f.dataType, T.BinaryType) for f in schema.fields)

    def partitions(self) -> list[InputPartition]:
        store, folder = _store(self.path)
        with store.open_input_stream(f"{folder}/{MANIFEST}") as file:
            files = json.loads(file.read())["files"]
        return [InputPartition((f["file"], f["start"])) for f in files] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        store, folder = _store(self.path)
        name, start = partition.value
        for docs, lengths, ids in read_file(store, f"{folder}/{name}"):
            ends = np.cumsum(lengths)
            columns = {"doc_id": pa.array(docs, pa.int64()), "start": pa.array(start + ends - lengths), "n_tokens": pa.array(lengths)}
            if "ids" in self.names:
                if self.binary:
                    if ids.max(initial=0) >> 32:
                        raise ValueError("an id takes more than four bytes: read ids as an array")
                    data = ids.astype("<u4").tobytes()
                    columns["ids"] = pa.array([data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)], pa.binary())
                else:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.view(np.int64)))
            start += int(lengths.sum())
            yield pa.RecordBatch.from_arrays([columns[n] for n in self.names], self.names)


class TokenIds(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return IdsReader(self.options["path"], schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> IdsWriter:
        return IdsWriter(self.options["path"], overwrite)


def token_ids(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ids (four little-endian bytes each) of each row's whole text, end_id last; rows stay where they are. A null text is an empty one."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_texts = encoder(vocabulary)
        for batch in batches:
            ids = of_texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.concatenate([x, end]).tobytes() for x in ids], pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).mapInArrow(encode, "doc_id long, ids binary")


def write_ids(docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Token ids of whole texts as files under path (a folder of a store that pyarrow knows and all tasks reach), in ascending order of ids.

    Texts are dealt by ranges of ids, ties by a hash of the text, so an id that very many rows repeat is in several
    ranges; each range is sorted and becomes files of at most about FILE_IDS token ids. Null texts are empty, rows that
    repeat an id all stay, null ids come first. An empty table gives a manifest without files. Other columns are not read.
    """
    docs.sparkSession.dataSource.register(TokenIds)
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    token_ids(rows, vocabulary, end_id).write.format(NAME).mode("append").save(path)


def read_ids(spark: SparkSession, path: str, columns: Iterable[str] = ("doc_id", "start", "n_tokens", "ids"), binary: bool = False) -> DataFrame:
    """The named columns of READ_SCHEMA of every document, from the files: start is the number of token ids of all documents before it."""
    spark.dataSource.register(TokenIds)
    kinds = {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids": "binary" if binary else "array<bigint>"}
    return spark.read.format(NAME).schema(", ".join(f"{c} {kinds[c]}" for c in columns)).load(path)
