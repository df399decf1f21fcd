"""Token-id output as sorted-string-table shards.

A shard holds documents in the order of their identifiers: data blocks of prefix-compressed entries, an index of one entry a block, a
Bloom filter over the identifiers, and a footer of fixed size. A lookup reads the footer, index and filter, then one block.

    block   entries, then crc32 of the entries (4 bytes)
    entry   varint shared, varint rest, varint value size, rest of the key, value
    key     0 for a null identifier, or 1 and the identifier as 8 big-endian bytes with the sign bit flipped
    value   ids as little-endian unsigned 16-bit integers (32-bit where the vocabulary needs them)
    index   per block: varint size of the first key, first key, varint offset, varint size
    bloom   bits, a power of two of them
    footer  <QQQQQQBBxxxxxx8s: index at, index size, bloom at, bloom size, documents, tokens, hashes, bytes an id, magic

Shards are files in the shared folder of the cluster. A task writes a file of its own name, and only the manifest, a table
written by Spark's commit protocol, says which files count: a task that runs twice leaves an orphan, never a wrong result.

Defined results: a null text counts as empty; rows that repeat an identifier follow each other in the order of a hash of their texts; null
identifiers come first; an empty table gives no shard. Texts are read whole.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import qualified, scratch_path, settle, table
from dialoom.llm.tokens import shared_encoder, vocabulary_path

MAGIC = b"DLSSTv01"
FOOTER = struct.Struct("<QQQQQQBBxxxxxx8s")
#: Bytes of a block, bits a key and hashes of the filter.
BLOCK_BYTES, BLOOM_BITS, BLOOM_HASHES = 65_536, 10, 7
#: Id that ends a document.
END = 2


def _store(path: str):
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        c = b[at]
        n |= (c & 127) << shift
        at, shift = at + 1, shift + 7
        if c < 128:
            return n, at


def key_bytes(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + (int(doc_id) + (1 << 63)).to_bytes(8, "big")


def doc_id_of(key: bytes) -> int | None:
    return None if key == b"\0" else int.from_bytes(key[1:], "big") - (1 << 63)


def _probes(key: bytes, bits: int, hashes: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x5BD1E995) | 1
    return [(a + i * b) & (bits - 1) for i in range(hashes)]


class Writer:
    def __init__(self, sink, id_bytes: int):
        self.sink, self.id_bytes = sink, id_bytes
        self.block, self.last, self.first = bytearray(), b"", b""
        self.index, self.at, self.docs, self.tokens = bytearray(), 0, 0, 0
        self.hashes: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        key = key_bytes(doc_id)
        if not self.block:
            self.first, self.last = key, b""
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(ids)) + key[shared:] + ids
        self.last = key
        self.hashes.append(key)
        self.docs += 1
        self.tokens += len(ids) // self.id_bytes
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            body = bytes(self.block) + struct.pack("<I", zlib.crc32(self.block))
            self.index += _varint(len(self.first)) + self.first + _varint(self.at) + _varint(len(body))
            self.sink.write(body)
            self.at += len(body)
            self.block = bytearray()

    def close(self) -> None:
        self._flush()
        bits = 1 << max(3, (BLOOM_BITS * len(self.hashes) - 1).bit_length())
        bloom = np.zeros(bits, bool)
        for key in self.hashes:
            bloom[_probes(key, bits, BLOOM_HASHES)] = True
        packed = np.packbits(bloom, bitorder="little").tobytes()
        self.sink.write(bytes(self.index))
        self.sink.write(packed)
        self.sink.write(FOOTER.pack(self.at, len(self.index), self.at + len(self.index), len(packed), self.docs, self.tokens, BLOOM_HASHES, self.id_bytes, MAGIC))
        self.sink.close()


class Reader:
    """Random access to one shard; a scan holds one block at a time."""

    def __init__(self, path: str):
        store, name = _store(path)
        self.file = store.open_input_file(name)
        size = self.file.size()
        self.index_at, index_size, bloom_at, bloom_size, self.docs, self.tokens, self.n_hashes, self.id_bytes, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a shard")
        self.kind = np.dtype(f"<u{self.id_bytes}")
        raw, at = self.file.read_at(index_size, self.index_at), 0
        self.keys: list[bytes] = []
        self.blocks: list[tuple[int, int]] = []
        while at < len(raw):
            n, at = _read_varint(raw, at)
            self.keys.append(raw[at : at + n])
            offset, at = _read_varint(raw, at + n)
            n, at = _read_varint(raw, at)
            self.blocks.append((offset, n))
        self.bloom = self.file.read_at(bloom_size, bloom_at)

    def _entries(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        offset, n = self.blocks[i]
        raw = self.file.read_at(n, offset)
        if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError(f"block {i} is damaged")
        at, key = 0, b""
        while at < n - 4:
            shared, at = _read_varint(raw, at)
            rest, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + rest]
            at += rest
            yield key, np.frombuffer(raw, self.kind, size // self.id_bytes, at)
            at += size

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(len(self.blocks)):
            for key, ids in self._entries(i):
                yield doc_id_of(key), ids

    def may_hold(self, doc_id: int | None) -> bool:
        bits = len(self.bloom) * 8
        return all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key_bytes(doc_id), bits, self.n_hashes))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every entry with this identifier."""
        key = key_bytes(doc_id)
        out: list[np.ndarray] = []
        if not self.may_hold(doc_id):
            return out
        i = bisect_right(self.keys, key) - 1
        while i > 0 and self.keys[i] == key:  # entries of one identifier may start in an earlier block
            i -= 1
        for i in range(max(i, 0), len(self.keys)):
            if self.keys[i] > key:
                break
            out += [ids for k, ids in self._entries(i) if k == key]
        return out


def write_shards(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write; the manifest: (shard, path, n_docs, n_tokens, first_key, last_key, start), start being the ids of all shards before.

    One range exchange by (key, hash of the text), so that not even the rows of one key are bound to one task.
    """
    path = vocabulary or vocabulary_path()
    folder = qualified(docs.sparkSession, folder)  # tasks open the store that Spark would write to, not their own disks
    store, name = _store(folder)
    store.create_dir(name, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    rows = rows.repartitionByRange("k", "h").sortWithinPartitions("k", "h").drop("h")

    def written(batches):
        from pyspark import TaskContext

        encoder = shared_encoder(path)
        mark = np.array([end], encoder.kind).tobytes()
        writer = file = None
        for b in batches:
            for k, t in zip(b.column("k").to_pylist(), b.column("t")):
                if writer is None:
                    file = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.sst"
                    store, name = _store(file)
                    writer = Writer(store.open_output_stream(name), encoder.kind.itemsize)
                writer.add(k, encoder.encode_bytes(t.as_py()) + mark)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"shard": TaskContext.get().partitionId(), "path": file, "n_docs": writer.docs, "n_tokens": writer.tokens, "first_key": writer.hashes[0], "last_key": writer.hashes[-1]}], schema)

    import pyarrow as pa

    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_key", pa.binary()), ("last_key", pa.binary())])
    manifest = settle(rows.mapInArrow(written, "shard int, path string, n_docs long, n_tokens long, first_key binary, last_key binary"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, texts: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), and ids with texts=True, from the files."""
    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if texts else "")

    def read(batches):
        for b in batches:
            for path, start in zip(b["path"], b["start"]):
                rows, size = [], 0
                for doc_id, ids in Reader(path).scan():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), *([ids.astype(np.int32)] if texts else [])))
                    start, size = start + len(ids), size + len(ids)
                    if len(rows) >= 10_000 or texts and size > 1_000_000:
                        yield _frame(rows, texts)
                        rows, size = [], 0
                if rows:
                    yield _frame(rows, texts)

    return manifest.select("path", "start").repartition(spread).mapInPandas(read, kind)


def _frame(rows: list[tuple], texts: bool) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if texts else [])])
    return out.astype({"doc_id": "Int64"})


def lookup(manifest: DataFrame, doc_id: int | None) -> list[np.ndarray]:
    """The ids of one document. Only shards whose range of keys holds the identifier are opened (keys sort as identifiers do; one shard, or
    several if they share the identifier), then filter and binary search in their index decide."""
    key = F.lit(key_bytes(doc_id))
    holding = manifest.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("shard").select("path")
    return [ids for r in holding.toLocalIterator() for ids in Reader(r["path"]).get(doc_id)]


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(write_shards(table(spark, sf_dir, "documents"), scratch_path(spark, "shards")))


QUERIES = {"op4_token_shards": op4_token_shards}
SQL: dict[str, str] = {}
