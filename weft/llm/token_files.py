"""Token ids as seekable zstandard files.

A file is a row of independent zstandard frames. The frames' raw contents, one after
the other, are the ids of the file's documents as little-endian unsigned 32-bit
integers; a frame is cut every ``FRAME_BYTES``, so a long document spans several and
writers and readers hold one frame at a time. Then follow

* a skippable frame (magic 0x184D2A5D) with the documents: a row count, and zstandard
  compressed columns id, id-is-null, number of ids;
* a skippable frame (magic 0x184D2A5E) with the seek table in the published seekable
  layout: for each frame before it compressed size, raw size and the low 32 bits of the
  raw bytes' XXH64, each as u32; then frame count, descriptor 0x80 and 0x8F92EAB1.

A reader takes the table from the end of the file, finds a document's bytes from the id
counts before it, and decompresses and verifies only the frames that overlap them.

Documents are written in ascending id order (null ids first, equal ids by a hash of the
text): a range exchange deals them to tasks, one file a task, named after the attempt, so
that a repeated task never touches a file that another attempt wrote. The manifest that
Spark commits lists the files that count. Null texts are empty: they have the end id only.
Repeated ids keep one entry for each row. An empty table has no files and no rows.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import lower_ascii, materialise, open_store, read_range, table
from weft.session import scratch_path

FRAME_BYTES = 1 << 18
LEVEL = 3
END_ID = 2
# A capital and what may be a combining mark after it: composed before or after it is lower-cased makes a difference.
COMPOSES = re.compile(rb"[A-Z][\xc2-\xf4]")
CACHED_CHUNKS = 500_000
ENCODE_BYTES = 4 << 20  # texts that are encoded together

# Fixed values of the zstandard seekable format.
DOCS_MAGIC = 0x184D2A5D
TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
DESCRIPTOR = 0x80


class TokenFileWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, out):
        self.out, self.compress = out, zstandard.ZstdCompressor(level=LEVEL)
        self.raw = bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []

    def _frame(self, raw: bytes) -> None:
        packed = self.compress.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.raw += ids
        while len(self.raw) >= FRAME_BYTES:
            self._frame(bytes(self.raw[:FRAME_BYTES]))
            del self.raw[:FRAME_BYTES]

    def close(self) -> None:
        if self.raw:
            self._frame(bytes(self.raw))
        columns = (np.array([d or 0 for d in self.docs], "<i8").tobytes()
                   + np.array([d is None for d in self.docs], np.uint8).tobytes()
                   + np.array(self.sizes, "<u8").tobytes())
        body = struct.pack("<Q", len(self.docs)) + self.compress.compress(columns)
        self.out.write(struct.pack("<II", DOCS_MAGIC, len(body)) + body)
        self.frames.append((len(body) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), DESCRIPTOR, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class TokenFileReader:
    """Random access to one file."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        end = file.size()
        n, descriptor, magic = struct.unpack("<IBI", read_range(file, end - 9, 9))
        if magic != SEEKABLE_MAGIC or descriptor != DESCRIPTOR:
            raise ValueError("no seek table at the end of the file")
        entries = np.frombuffer(read_range(file, end - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        places = np.concatenate([[0], np.cumsum(entries[:, 0])])
        body = read_range(file, int(places[n - 1]), int(entries[n - 1, 0]))
        (count,) = struct.unpack("<Q", body[8:16])
        columns = self.unpack.decompress(body[16:]) if count else b""
        self.ids = np.frombuffer(columns[:8 * count], "<i8")
        self.null = np.frombuffer(columns[8 * count:9 * count], np.uint8).astype(bool)
        self.sizes = np.frombuffer(columns[9 * count:], "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.packed, self.places = entries[:-1, 0], places
        self.checks = entries[:-1, 2]
        self.raw_at = np.concatenate([[0], np.cumsum(entries[:-1, 1])])
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            raw = self.unpack.decompress(read_range(self.file, int(self.places[k]), int(self.packed[k])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.held = (k, raw)
        return self.held[1]

    def parts(self, row: int) -> Iterator[bytes]:
        """The id bytes of the file's ``row``-th document, a frame's share at a time."""
        start, stop = int(self.starts[row]) * 4, int(self.starts[row + 1]) * 4
        k = int(np.searchsorted(self.raw_at, start, "right")) - 1
        while start < stop:
            base = int(self.raw_at[k])
            raw = self.frame(k)
            yield raw[start - base: stop - base]
            start, k = base + len(raw), k + 1

    def document(self, row: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts(row)), "<u4")

    def find(self, doc_id: int) -> list[int]:
        """Rows of a document id."""
        return np.flatnonzero((self.ids == doc_id) & ~self.null).tolist()


class ChunkEncoder:
    """Encodes texts with the tokenizers library; ids as little-endian u32.

    For tokenizers that lower-case, end each word in a token with ``</w>``, and never join
    text across ASCII white space or between a letter and ASCII punctuation. A text is
    encoded by its white-space-free chunks. Chunks met before come from a bounded memory; of new ones the
    words are encoded many in a call, and their ids are told apart by the word ends.
    The exact strings of special tokens are cut out first and become these tokens, as in the library's plain call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # what is left, in other letter case, is ordinary text
        special = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.apart = re.compile(b"(%s)" % b"|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special = {b" " + s: struct.pack("<I", i) for s, i in special.items()}  # no chunk has a space
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = dict(self.special)
        self.old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words that have letters only."""
        out: list[bytes] = []
        groups = [words[i:i + 64] for i in range(0, len(words), 64)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups]), strict=True):
            stops = (np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1) * 4
            if len(stops) == len(group):
                stops = stops.tolist()
                out.extend(ids[a:b] for a, b in zip([0, *stops], stops, strict=False))
            else:  # a letter whose lower case is no letter alone
                out.extend(self._ids(group))
        return out

    def _learn(self, chunks: list[bytes]) -> None:
        """Bring chunks into memory."""
        known, parts, words, others = self.known, [], {}, {}
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            word = text.rstrip(string.punctuation)
            if not word.lower().isalpha():  # nor where a letter's lower case is no letter alone
                word = ""
            rest = text[len(word):]
            parts.append((word, rest))
            if word:
                words[word] = known.get(word.encode()) if rest else None
            if rest:
                others[rest] = b""
        new = [w for w, ids in words.items() if ids is None]
        words.update(zip(new, self._word_ids(new), strict=True))
        others.update(zip(others, self._ids(list(others)), strict=True))
        words[""] = others[""] = b""
        known.update((c, words[w] + others[r]) for c, (w, r) in zip(chunks, parts, strict=True))

    def _chunks(self, text: bytes) -> list[bytes]:
        """Chunks, lower-cased where that is safe; special tokens with a space before."""
        parts = self.apart.split(text) if self.apart else [text]
        if len(parts) == 1:
            return self._lowered(text)
        return [c for k, part in enumerate(parts) for c in ([b" " + part] if k % 2 else self._lowered(part))]

    @staticmethod
    def _lowered(text: bytes) -> list[bytes]:
        """Chunks in lower case, so that the memory holds each once. The library composes marks
        first and lower-cases then; a chunk with a mark after A-Z is left to it as it is."""
        if not COMPOSES.search(text):
            return lower_ascii(text).split()
        return [c if COMPOSES.search(c) else lower_ascii(c) for c in text.split()]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        split = [self._chunks(t) for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHED_CHUNKS:
            self.old, self.known = self.known, dict(self.special)
            new = set().union(*split).difference(self.known)
        known, old = self.known, self.old
        known.update((w, old[w]) for w in new if w in old)
        self._learn([w for w in new if w not in old])
        return [b"".join(map(known.__getitem__, words)) for words in split]


@lru_cache(maxsize=4)
def tokenizer_encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and tokenizer, kept from task to task."""
    return ChunkEncoder(path)


MANIFEST_SCHEMA = "part long, path string, docs long, ids long, first_id long, last_id long"


def write_token_files(docs: DataFrame, folder: str, make_encoder: Callable[[], Callable], end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write the files; returns the committed manifest."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    rows = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
            .sortWithinPartitions("doc_id", "tie"))
    end = struct.pack("<I", end_id)

    def write(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encode, writer, path = make_encoder(), None, ""
        for batch in found:
            ids = batch.column("doc_id").to_pylist()
            column, at = batch.column("text"), 0
            while at < len(ids):
                texts, held = [], 0
                while at + len(texts) < len(ids) and held < ENCODE_BYTES:
                    texts.append(column[at + len(texts)].as_py())
                    held += len(texts[-1])
                if writer is None:
                    path = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.ids.zst"
                    store, place = open_store(path)
                    store.create_dir(os.path.dirname(place))
                    writer = TokenFileWriter(store.open_output_stream(place, compression=None))
                for doc_id, own in zip(ids[at:at + len(texts)], encode(texts), strict=True):
                    writer.add(doc_id, own + end)
                at += len(texts)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({
                "part": [context.partitionId()], "path": [path], "docs": [len(writer.docs)], "ids": [sum(writer.sizes)],
                "first_id": pa.array([next((d for d in writer.docs if d is not None), None)], pa.int64()),
                "last_id": pa.array([writer.docs[-1]], pa.int64())})

    return materialise(rows.mapInArrow(write, MANIFEST_SCHEMA), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files.

    The manifest has one row for each file; only these rows pass through the driver, for
    the running start of each file."""
    spark = manifest.sparkSession
    files, start = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r["part"]):
        files.append((row["path"], start))
        start += row["ids"]
    listed = spark.createDataFrame(files, "path string, start long").repartition(max(1, len(files)), "path")

    def read(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                store, place = open_store(path)
                with store.open_input_file(place) as file:
                    reader = TokenFileReader(file)
                    n = len(reader.ids)
                    for at in range(0, n, 8192):
                        crcs = []
                        for row in range(at, min(at + 8192, n)):
                            crc = 0
                            for part in reader.parts(row):
                                crc = zlib.crc32(part, crc)
                            crcs.append(crc)
                        some = slice(at, at + 8192)
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(reader.ids[some], mask=reader.null[some]),
                            "start": first + reader.starts[:-1][some],
                            "n_tokens": reader.sizes[some], "ids_crc32": pa.array(crcs, pa.int64())})

    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (array<long>) of the documents with some ids, one row for each that is there.

    Only files whose range of ids has one of them are opened, and of these only the tables at
    the end and the frames of the documents asked for are read."""
    spark, wanted = manifest.sparkSession, sorted(set(doc_ids))
    asked = []
    for row in manifest.where("last_id IS NOT NULL").collect():
        own = wanted[bisect_left(wanted, row["first_id"]):bisect_right(wanted, row["last_id"])]
        if own:
            asked.append((row["path"], own))
    listed = spark.createDataFrame(asked, "path string, wanted array<long>").repartition(max(1, len(asked)), "path")

    def read(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for path, own in zip(batch.column("path").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                store, place = open_store(path)
                with store.open_input_file(place) as file:
                    reader = TokenFileReader(file)
                    for doc_id in own:
                        for row in reader.find(doc_id):
                            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc_id], pa.int64()),
                                                              "ids": pa.array([reader.document(row).astype(np.int64)], pa.list_(pa.int64()))})

    return listed.mapInArrow(read, "doc_id long, ids array<long>")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into seekable token files, and digest them as read back."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"),
                                 lambda: tokenizer_encoder(path))
    return read_token_files(manifest)
