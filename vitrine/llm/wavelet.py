"""Token ids in wavelet-matrix files: succinct bit planes with rank and select.

A shard holds consecutive documents: their ids, their lengths and one wavelet matrix over all
their token ids.  Level `l` of the matrix stores bit `l` (highest first) of every id, after a stable
sort by the bits above it.  A directory of counts every `BLOCK` bits gives rank in constant time and
select by binary search, so single tokens, the number of occurrences of an id in a range and the
places of an id are found in the compressed file's planes without decoding the shard.

Writing: documents are range-partitioned and sorted by id, each task encodes its texts with the
tokenizers library and writes a file whenever a shard is full.  A file gets its final name by a move
after it is complete, and a repeated task writes the same bytes under the same name.

Encoding cuts a text where the tokenizer's own pattern always cuts (a blank before a word, ends of
white space), encodes each distinct piece of a batch once with the library's model and puts the ids
together; texts with special-token strings or separators of other rules go through the library whole.

Defined cases: null and empty texts are the end id alone; rows with one id keep the order of their
texts; a null id comes first; an empty table writes no file and gives no rows.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.common import NO_ID, pieces, row_id, stored, text_bytes, whole_text
from vitrine.session import work_dir

MAGIC = b"WVM1"
BLOCK = 2048  # bits per entry of the rank directory


# --- the structure -------------------------------------------------------------------------

@dataclass
class WaveletMatrix:
    size: int
    planes: list[np.ndarray]  # packed bits, highest bit of the ids first
    ranks: list[np.ndarray]  # ones before each block
    zeros: list[int]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, ranks, zeros = [], [], []
        for level in range(width - 1, -1, -1):
            bits = (now >> level) & 1 == 1
            low = now[~bits]
            zeros.append(len(low))
            packed = np.packbits(bits)
            planes.append(packed)
            ranks.append(directory(packed))
            now = np.concatenate([low, now[bits]])
        return cls(len(ids), planes, ranks, zeros)

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first `i` bits of a level."""
        block, plane = i // BLOCK, self.planes[level]
        start, end = block * BLOCK // 8, i // 8
        n = int(self.ranks[level][block]) + int(np.bitwise_count(plane[start:end]).sum())
        return n + (int(plane[end] >> (8 - i % 8)).bit_count() if i % 8 else 0)

    def bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i // 8] >> (7 - i % 8)) & 1

    def access(self, i: int) -> int:
        token = 0
        for level, zeros in enumerate(self.zeros):
            b = self.bit(level, i)
            ones = self.rank1(level, i)
            i = zeros + ones if b else i - ones
            token = token << 1 | b
        return token

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of a token among positions lo..hi lie below the last level."""
        width = len(self.planes)
        if token >> width:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (width - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        a, b = self._range(token, lo, self.size if hi is None else hi)
        return b - a

    def select1(self, level: int, k: int) -> int:
        """Position of the k-th one (from 0) of a level."""
        block = int(np.searchsorted(self.ranks[level], k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits)[k - int(self.ranks[level][block])])

    def select0(self, level: int, k: int) -> int:
        before = np.arange(len(self.ranks[level])) * BLOCK - self.ranks[level]
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == 0)[k - int(before[block])])

    def place(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of a token."""
        lo, hi = self._range(token, 0, self.size)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - level) & 1
            i = self.select1(level, i - self.zeros[level]) if one else self.select0(level, i)
        return i

    def places(self, token: int) -> list[int]:
        return [self.place(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids: from the lowest level upwards, undo each stable sort."""
        now = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.size).view(bool)
            up = np.empty_like(now)
            up[~bits] = now[:self.zeros[level]]
            up[bits] = now[self.zeros[level]:] | now.dtype.type(1 << (len(self.planes) - 1 - level))
            now = up
        return now


def directory(packed: np.ndarray) -> np.ndarray:
    step = BLOCK // 8
    ones = np.bitwise_count(packed)
    sums = np.add.reduceat(ones, np.arange(0, len(ones), step), dtype=np.int64) if len(ones) else np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(sums)]).astype(np.uint32)


# --- the file ------------------------------------------------------------------------------

def to_file(doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
    """Header, then compressed sections: document ids, lengths, and plane and directory of each level."""
    m = WaveletMatrix.build(ids)
    pack = zstandard.ZstdCompressor(level=1)
    sections = [np.array(doc_ids, "<i8").tobytes(), np.array(lengths, "<u4").tobytes()]
    for plane, rank in zip(m.planes, m.ranks):
        sections += [plane.tobytes(), rank.astype("<u4").tobytes()]
    packed = [pack.compress(s) for s in sections]
    head = struct.pack("<4sQQI", MAGIC, len(doc_ids), m.size, len(m.planes))
    head += struct.pack(f"<{len(m.zeros)}Q", *m.zeros) + struct.pack(f"<{len(packed)}Q", *map(len, packed))
    return head + b"".join(packed)


def from_file(data: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, lengths and the matrix of a file."""
    magic, docs, size, width = struct.unpack_from("<4sQQI", data)
    if magic != MAGIC:
        raise ValueError("not a wavelet-matrix file")
    at = struct.calcsize("<4sQQI")
    zeros = list(struct.unpack_from(f"<{width}Q", data, at))
    at += 8 * width
    sizes = struct.unpack_from(f"<{2 + 2 * width}Q", data, at)
    at += 8 * len(sizes)
    sections = []
    for n in sizes:
        sections.append(zstandard.ZstdDecompressor().decompress(data[at:at + n]) if n else b"")
        at += n
    planes = [np.frombuffer(s, np.uint8) for s in sections[2::2]]
    ranks = [np.frombuffer(s, "<u4") for s in sections[3::2]]
    return (np.frombuffer(sections[0], "<i8"), np.frombuffer(sections[1], "<u4"),
            WaveletMatrix(size, planes, ranks, zeros))


# --- encoding ------------------------------------------------------------------------------

# White space that the tokenizer's pattern and Python's see alike; the four separators differ.
CUT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
ODD = re.compile("[\x1c-\x1f]")


def visible_bytes() -> list[str]:
    """The characters byte-level vocabularies write for bytes: printable ones stand for themselves,
    the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Token ids of whole texts; equal to the library's encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, cache: int = 500_000) -> None:
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # The library's own pattern for byte-level words, a fixed value.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.visible = visible_bytes()
        self.known = Known(self.piece)
        self.cache = cache

    def piece(self, text: str) -> bytes:
        """Ids of a piece as little-endian 32-bit numbers."""
        ids: list[int] = []
        table = self.visible
        for word in self.pattern.findall(text):
            ids += [t.id for t in self.model.tokenize("".join([table[b] for b in word.encode()]))]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if ODD.search(text) or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        if len(self.known) > self.cache:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, CUT.findall(text))), "<u4")


class Known(dict):
    """Ids of pieces, made at their first use."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = self.make(piece)
        return ids


@functools.lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """One encoder per worker process: its pieces serve the tasks that follow."""
    return Encoder(path)


# --- the operator --------------------------------------------------------------------------

def write_shards(documents: DataFrame, tokenizer: str, root: str, end_id: int = 2,
                 shard_tokens: int = 1 << 21) -> DataFrame:
    """Encode every text and write wavelet-matrix files below `root` in ascending id order.
    Returns the stored table of files: partition, seq, name, n_tokens."""
    n = pieces(text_bytes(documents), 24 << 20)
    ordered = (documents.select(row_id().alias("id"), whole_text().alias("text"))
               .repartitionByRange(n, "id").sortWithinPartitions("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        docs: list[int] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        rows: list[tuple[int, str, int]] = []

        def flush() -> None:
            name = f"shard-{part:06d}-{len(rows):06d}.wvm"
            data = to_file(docs, lengths, np.concatenate(held))
            draft = f"{folder}/.{name}-{TaskContext.get().taskAttemptId()}"
            with store.open_output_stream(draft) as out:
                out.write(data)
            store.move(draft, f"{folder}/{name}")
            rows.append((len(rows), name, sum(lengths)))
            docs.clear(), lengths.clear(), held.clear()

        full = 0
        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encoder.encode(text), np.uint32(end_id))
                docs.append(doc), lengths.append(len(ids)), held.append(ids)
                full += len(ids)
                if full >= shard_tokens:
                    flush()
                    full = 0
        if docs:
            flush()
        yield pa.RecordBatch.from_pydict({
            "partition": pa.array([part] * len(rows), pa.int32()), "seq": pa.array([r[0] for r in rows], pa.int32()),
            "name": pa.array([r[1] for r in rows], pa.string()), "n_tokens": pa.array([r[2] for r in rows], pa.int64())})

    return stored(ordered.mapInArrow(run, "partition int, seq int, name string, n_tokens long"), "shards")


def read_shards(files: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    spark = files.sparkSession
    # One row per writing task, then one per file: sums within tasks, tasks behind one another.
    parts = files.groupBy("partition").agg(F.sum("n_tokens").alias("n"))
    whole = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("partition").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("partition", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    starts = (files.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
              .join(parts, "partition").select("name", (F.col("before") + F.col("inner")).alias("offset")))
    contents = (spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(root)
                .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("name").to_pylist(), batch.column("content")):
                docs, lengths, matrix = from_file(data.as_py())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths.astype(np.int64))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "name": [name] * len(docs), "doc_id": pa.array(docs), "inner": pa.array(ends - lengths),
                    "n_tokens": pa.array(lengths.astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64())})

    rows = contents.mapInArrow(run, "name string, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "name").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), (F.col("offset") + F.col("inner")).alias("start"),
        "n_tokens", "ids_crc32")


def token_files(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents and read them back: doc_id, start, n_tokens, ids_crc32."""
    root = work_dir(documents.sparkSession, "wavelet")
    files = write_shards(documents, tokenizer, root)
    if files.isEmpty():
        return documents.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_shards(files, root)
