"""Token-id files: independent zstandard frames, a seek table behind them, checksums.

A file is a valid zstandard stream: data frames of little-endian unsigned 32-bit ids of
whole documents (a long document spans frames of its own), one skippable frame with the
document index, and the seek table as a last skippable frame, laid out as the public
zstandard seekable format has it: per frame compressed size, content size and the low
half of the content's xxhash64, then the number of frames, a flag byte and a magic.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata.llm import pieces
from rxstrata.llm.bpe import slices, text_sizes
from rxstrata.llm.pieces import laid_out, learnt
from rxstrata.llm.storage import open_input, written_whole
from rxstrata.session import stage, staging_path

# fixed values of the file format
SKIPPABLE, INDEX_FRAME = 0x184D2A5E, 0x184D2A50
SEEK_MAGIC, CHECKSUMS = 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")
HEADER = struct.Struct("<II")

END_ID = 0
FRAME_BYTES = 1 << 20
CACHE_PIECES = 1_000_000  # that a process remembers; some 200 bytes each


@functools.cache
def load_tokenizer(path: str):
    """The tokenizer of a file, once per process; special strings are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class PieceEncoder:
    """Whole texts through the tokenizers library, each piece between spaces once.

    Byte-level pre-tokens never hold a space after something else than white space, so a
    text may be cut before such a space and the parts encoded alone. Equal pieces of a
    batch are looked up once; new ones are encoded together as one text of that kind.
    ``encoder`` keeps one per worker process, so pieces that one task has learnt are known
    to the next.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        table = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(table.values()) + 1, dtype=bool)
        self.opens[[i for token, i in table.items() if token.startswith("Ġ")]] = True
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype="<u4")

    def _learn(self, new: list[str]) -> None:
        spaced = [p for p in new if p[:1] == " "]
        for i in range(0, len(spaced), 2000):
            part = spaced[i : i + 2000]
            ids = self._ids("".join(part))
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(part):
                raw, at = ids.tobytes(), (cuts * 4).tolist()
                split = [raw[x:y] for x, y in zip(at, [*at[1:], len(raw)])]
            else:
                split = [self._ids(p).tobytes() for p in part]
            self.known.update(zip(part, split, strict=True))
        self.known.update((p, self._ids(p).tobytes()) for p in new if p[:1] != " ")

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cuts = [bool(t) and not pieces.irregular(t) for t in texts]
        spaced, firsts, codes, edges = pieces.cut([t for t, c in zip(texts, cuts, strict=True) if c])
        found = learnt(self.known, spaced + firsts, CACHE_PIECES, self._learn)
        data, at = laid_out(found, codes)
        rows = zip(at[edges[:-1]], at[edges[1:]])
        return [
            bytes(data[slice(*next(rows))]) if c else self._ids(t).tobytes() if t else b""
            for t, c in zip(texts, cuts, strict=True)
        ]


@functools.cache
def encoder(path: str) -> PieceEncoder:
    """The encoder of this process."""
    return PieceEncoder(path)


class FrameWriter:
    """Appends documents in order and closes with index and seek table."""

    def __init__(self, out, level: int = 3, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.codec = zstandard.ZstdCompressor(level=level)
        self.parts: list[bytes] = []
        self.size = 0
        self.table: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, data: bytes) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(data) // 4)
        if self.size and self.size + len(data) > self.frame_bytes:
            self._flush()
        for i in range(0, len(data), self.frame_bytes):
            self.parts.append(data[i : i + self.frame_bytes])
            self.size += len(self.parts[-1])
            if self.size >= self.frame_bytes:
                self._flush()

    def _flush(self) -> None:
        import xxhash

        content = b"".join(self.parts)
        if content:
            frame = self.codec.compress(content)
            self.out.write(frame)
            self.table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.parts, self.size = [], 0

    def close(self) -> None:
        self._flush()
        null = np.array([i is None for i in self.ids], dtype=np.uint8)
        ids = np.array([i or 0 for i in self.ids], dtype="<i8")
        body = self.codec.compress(
            null.tobytes() + ids.tobytes() + np.array(self.lengths, dtype="<i8").tobytes()
        )
        body = struct.pack("<Q", len(self.ids)) + body
        self.out.write(HEADER.pack(INDEX_FRAME, len(body)) + body)
        self.table.append((HEADER.size + len(body), 0, zlib.crc32(body)))
        seek = b"".join(ENTRY.pack(*row) for row in self.table)
        seek += FOOTER.pack(len(self.table), CHECKSUMS, SEEK_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE, len(seek)) + seek)


class FrameReader:
    """Opens a file by its seek table; frames are read only as they are asked for."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.codec = zstandard.ZstdDecompressor()
        size = source.size()
        count, _, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the file")
        raw = self._at(size - FOOTER.size - count * ENTRY.size, count * ENTRY.size)
        entries = np.frombuffer(raw, "<u4").reshape(count, 3).astype(np.int64)
        self.checks = entries[:-1, 2]
        self.offsets = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.contents = np.concatenate([[0], np.cumsum(entries[:-1, 1])])
        body = self._at(int(self.offsets[-2]) + HEADER.size, int(entries[-1, 0]) - HEADER.size)
        if zlib.crc32(body) != entries[-1, 2]:
            raise ValueError("the document index does not match its checksum")
        (n,) = struct.unpack_from("<Q", body)
        index = self.codec.decompress(body[8:], max_output_size=17 * n + 1) if n else b""
        self.null = np.frombuffer(index, np.uint8, n) == 1
        self.doc_ids = np.frombuffer(index, "<i8", n, offset=n) if n else np.zeros(0, "<i8")
        self.lengths = np.frombuffer(index, "<i8", n, offset=9 * n) if n else np.zeros(0, "<i8")
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, number: int) -> bytes:
        import xxhash

        raw = self._at(int(self.offsets[number]), int(self.offsets[number + 1] - self.offsets[number]))
        content = self.codec.decompress(raw)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[number]:
            raise ValueError(f"frame {number} does not match its checksum")
        return content

    def documents(self, rows: Sequence[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """(row, ids as bytes) of the asked rows in ascending order, or of all."""
        held, content = -1, b""
        for row in range(len(self.lengths)) if rows is None else rows:
            first, last = int(self.starts[row]) * 4, int(self.starts[row] + self.lengths[row]) * 4
            number = int(np.searchsorted(self.contents, first, side="right")) - 1
            parts = []
            while first < last:
                if number != held:
                    held, content = number, self.frame(number)
                begin, end = int(self.contents[number]), int(self.contents[number + 1])
                parts.append(content[first - begin : min(last, end) - begin])
                first, number = min(last, end), number + 1
            yield row, b"".join(parts)


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Writes one file per range of ids below ``folder``; returns the list of files.

    Rows: file (number in id order), uri, n_docs, n_tokens. Documents stand in ascending
    id order, null ids first, rows of the same id by the hash of their text; each ends
    with ``end_id``. Null and empty texts have only that. Texts are dealt by range of
    (id, hash, number of the row), so rows equal in id and text are split too. An empty
    table gives files without documents; other columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        number = TaskContext.get().partitionId()
        of, rows = encoder(path), 0
        uri = f"{folder}/ids-{number:06d}.zst"
        end = struct.pack("<I", end_id)
        with written_whole(uri) as out:
            writer = FrameWriter(out)
            for batch in batches:
                for part in slices(batch, text_sizes(batch.column(1))):
                    texts = part.column(1).to_pylist()
                    for doc_id, data in zip(part.column(0).to_pylist(), of.encode(texts), strict=True):
                        writer.add(doc_id, data + end)
                        rows += 1
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {"file": [number], "uri": [uri], "n_docs": [rows], "n_tokens": [sum(writer.lengths)]}
        )

    tie = F.xxhash64(F.col(text_col))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), tie.alias("tie"))
        .withColumn("nth", F.monotonically_increasing_id())
        .repartitionByRange(parts, F.col("id").asc_nulls_first(), "tie", "nth")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie", "nth")
        .select("id", "text")
    )
    return ordered.mapInArrow(run, "file long, uri string, n_docs long, n_tokens long")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the listed files.

    ``start`` counts the ids of all documents before it; the running total is over the
    list of files, one row per file.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.filter("n_docs > 0").withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(row["uri"]) as source:
                    reader = FrameReader(source)
                    checks = np.fromiter((zlib.crc32(d) for _, d in reader.documents()), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids, pa.int64(), mask=reader.null),
                            pa.array(row["base"] + reader.starts, pa.int64()),
                            pa.array(reader.lengths, pa.int64()),
                            pa.array(checks, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")]
    )
    return placed.select("uri", "base", "file").repartition(parts, "file").mapInArrow(run, schema)


def written_and_read(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``docs`` to a new shared folder and reads the files back."""
    folder = staging_path(docs.sparkSession, "token-files")
    return read(stage(write(docs, path, folder, id_col, text_col), "token-file-list"))
