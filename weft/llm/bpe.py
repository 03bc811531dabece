"""Byte-level BPE: encoding with a rank queue on hierarchical bitmaps, and decoding.

A pre-token's bytes form a doubly linked list. Each adjacent pair that is a token waits,
by its left position, in the bucket of its rank. Bitmaps of 64-bit words in three levels
tell which buckets hold anything: the lowest waiting rank is found by a find-first-set in
each level, and a merge costs a few word operations however long the pre-token is.
Entries are never taken out early: one whose pair has changed meanwhile is stale and is
skipped when it comes up. Within a rank the leftmost position goes first (a heap), so the
result is that of repeatedly merging the leftmost lowest-ranked pair.

Pre-tokens met for the first time are merged many at a time (``merge_all``): they are
laid end to end in one list, no pair crosses their borders, and all waiting positions of
the lowest rank are merged in one step. That equals merging each by itself unless a merge
makes a pair of a rank below its own; pre-tokens where that happens, which a trained
vocabulary hardly has, are merged again one by one (``merge``).

A text is cut at white space first, in a way that never crosses a match of the
pre-token pattern, and a bounded memory keeps the ids of chunks met before.

Null texts are empty: no ids. Bytes that are not UTF-8 become U+FFFD before encoding.
Repeated rows are encoded each on their own; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import by_size, open_store, table

CACHED_CHUNKS = 200_000
BATCH_BYTES = 2 << 20
# White space of the pre-token pattern's \s, as the inside of a character class.
SPACE = r"\t-\r \x85\xa0  -     　"
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0     　") | {chr(c) for c in range(0x2000, 0x200B)}
# White space next to white space, or other than space and line feed; and the null.
UNUSUAL = ["  ", " \n", "\n ", "\n\n", "\0", *sorted(SPACES - {" ", "\n"})]


class RankQueue:
    """Buckets of positions by rank, the lowest rank first."""

    def __init__(self, ranks: int):
        self.words = [0] * (ranks // 64 + 1)
        self.blocks = [0] * (ranks // 4096 + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        self.words[rank >> 6] |= 1 << (rank & 63)
        self.blocks[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, int] | None:
        """The lowest rank and its leftmost position."""
        if not self.top:
            return None
        block = (self.top & -self.top).bit_length() - 1
        bits = self.blocks[block]
        word = block << 6 | (bits & -bits).bit_length() - 1
        bits = self.words[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.words[word] &= self.words[word] - 1
            if not self.words[word]:
                self.blocks[block] &= self.blocks[block] - 1
                if not self.blocks[block]:
                    self.top &= self.top - 1
        return rank, position


class BytePairCodec:
    """ranks: token bytes to id; the id is the merge rank. pattern: cuts a text to pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import re

        import regex

        self.ranks, self.queue = ranks, RankQueue(max(ranks.values(), default=0) + 1)
        self.tokens = {i: b for b, i in ranks.items()}
        self.pieces = regex.compile(pattern.replace(r"\s+(?!\S)", f"[{SPACE}]+(?![^{SPACE}])").replace(
            r"[^\s", f"[^{SPACE}").replace(r"\s+", f"[{SPACE}]+")).findall
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]").findall
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        top = max(ranks.values()) + 1
        self.size_of = np.array([len(self.tokens.get(i, b"")) for i in range(top)])
        self.place_of = np.cumsum(self.size_of) - self.size_of
        self.flat = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(top)), np.uint8)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])
        made = sorted((ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self.pairs = np.array([p for p, _ in made] + [np.iinfo(np.int64).max])
        self.made = np.array([i for _, i in made] + [-1])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n, queue = len(piece), self.queue
        # A part is known by the position of its first byte; ends[p] is where it ends.
        ends = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for p in range(n - 1):
            rank = ranks.get(piece[p:p + 2])
            if rank is not None:
                queue.push(rank, p)
        alive = bytearray(b"\x01") * n
        while (entry := queue.pop()) is not None:
            rank, left = entry
            if not alive[left]:
                continue
            right = ends[left]
            if right >= n or ranks.get(piece[left:ends[right]]) != rank:
                continue  # stale
            stop = ends[right]
            ends[left] = stop
            alive[right] = 0
            if stop < n:
                before[stop] = left
                rank = ranks.get(piece[left:ends[stop]])
                if rank is not None:
                    queue.push(rank, left)
            first = before[left]
            if first >= 0:
                rank = ranks.get(piece[first:stop])
                if rank is not None:
                    queue.push(rank, first)
        out, p = [], 0
        while p < n:
            out.append(ranks[piece[p:ends[p]]])
            p = ends[p]
        return out

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (int32) of many pre-tokens, all positions of a rank at a time."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        text = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(text)
        if not n:
            return [b"" for _ in pieces]
        token = self.bytes[text]
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(n + 1, bool)
        first[starts[sizes > 0]] = True
        first[n] = True
        waits = np.full(n, -1)  # rank of the pair of each part and the next
        inner = np.flatnonzero(~first[1:n])
        waits[inner] = self.pair_ranks(token[inner], token[inner + 1])
        buckets: dict[int, list[np.ndarray]] = {}
        queue = RankQueue(len(self.queue.words) * 64)

        def push(positions: np.ndarray) -> None:
            positions = positions[waits[positions] >= 0]
            if not len(positions):
                return
            ranks = waits[positions]
            by = np.argsort(ranks, kind="stable")
            positions, ranks = positions[by], ranks[by]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            edges = [0, *cuts.tolist(), len(ranks)]
            for rank, a, b in zip(ranks[edges[:-1]].tolist(), edges, edges[1:], strict=False):
                if rank in buckets:
                    buckets[rank].append(positions[a:b])
                else:
                    buckets[rank] = [positions[a:b]]
                    queue.push(rank, 0)

        push(inner)
        again: list[np.ndarray] = []
        while (entry := queue.pop()) is not None:
            rank = entry[0]
            found = buckets.pop(rank)
            left = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            left = left[waits[left] == rank]
            if not len(left):
                continue  # stale
            touch = after[left[:-1]] == left[1:]
            if touch.any():  # of overlapping pairs the first, third, ... of each run
                runs = np.flatnonzero(np.concatenate([[True], ~touch]))
                place = np.arange(len(left)) - np.repeat(runs, np.diff(np.append(runs, len(left))))
                left = left[place % 2 == 0]
            right = after[left]
            stop = after[right]
            token[left] = rank
            token[right] = -1
            waits[right] = -1
            waits[left] = -1
            after[left] = stop
            inside = stop < n
            before[stop[inside]] = left[inside]
            ahead = left[~first[stop]]
            waits[ahead] = self.pair_ranks(token[ahead], token[after[ahead]])
            behind = before[left[~first[left]]]
            waits[behind] = self.pair_ranks(token[behind], token[after[behind]])
            fresh = np.concatenate([ahead, behind])
            lower = fresh[(waits[fresh] >= 0) & (waits[fresh] < rank)]
            if len(lower):
                again.append(lower)
            push(fresh)
        kept = np.flatnonzero(token >= 0)
        ids = token[kept].astype(np.int32).tobytes()
        edges = (np.searchsorted(kept, np.append(starts, n)) * 4).tolist()
        out = [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        for k in np.unique(np.searchsorted(starts, np.concatenate(again), "right") - 1).tolist() if again else ():
            out[k] = np.array(self.merge(pieces[k]), np.int32).tobytes()
        for k, piece in enumerate(pieces):
            if piece in self.ranks:
                out[k] = self.ranks[piece].to_bytes(4, sys.byteorder)
        return out

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the tokens that pairs of tokens make; -1 where there is none."""
        wanted = left << 32 | right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.made[at], -1)

    def cut(self, text: str) -> list[str]:
        """Chunks of a text, which no pre-token crosses, as keys of the memory.

        A key that begins with white space stands for itself, one that begins with a null
        for what follows it, any other for itself after one space. So a text whose white
        space is single spaces and line feeds is simply split."""
        if not text:
            return []
        if text[-1] not in SPACES and not any(x in text for x in UNUSUAL):
            spaced = text.replace("\n", " \n")
            return spaced.split(" ")[1:] if spaced[0] == " " else ("\0" + spaced).split(" ")
        return ["\0" + c if c[0] not in SPACES else c[1:] if c[0] == " " and len(c) > 1 and c[1] != "\0" and c[1] not in SPACES else c
                for c in self.chunks(text)]

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; chunks not met before are merged together first."""
        cuts = [self.cut(t) for t in texts]
        new = set().union(*cuts).difference(self.known)
        if len(self.known) + len(new) > CACHED_CHUNKS:
            self.old, self.known = self.known, {}
            new = set().union(*cuts)
        known, old = self.known, self.old
        pieces_of: dict[str, list[str]] = {}
        for key in new:
            if key in old:
                known[key] = old[key]
            elif key.isalpha():
                pieces_of[key] = [" " + key]
            else:
                pieces_of[key] = self.pieces(key[1:] if key[0] == "\0" else key if key[0] in SPACES else " " + key)
        pieces = list({p for own in pieces_of.values() for p in own})
        # a piece of one space and what a key may begin with is that key's whole chunk
        ids = {p: known[p[1:]] for p in pieces if p[0] == " " and len(p) > 1 and p[1] != "\0" and p[1] not in SPACES and p[1:] in known}
        pieces = [p for p in pieces if p not in ids]
        ids.update(zip(pieces, self.merge_all([p.encode() for p in pieces]), strict=True))
        for key, own in pieces_of.items():
            known[key] = ids[own[0]] if len(own) == 1 else b"".join(map(ids.__getitem__, own))
        for own in cuts:
            yield np.frombuffer(b"".join(map(known.__getitem__, own)), np.int32)

    def forget(self) -> None:
        """Give the memory of chunks back."""
        self.known, self.old = {}, {}

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, one after the other."""
        out = []
        for at in range(0, len(ids), 1 << 18):
            part = ids[at:at + (1 << 18)]
            sizes = self.size_of[part]
            ends = np.cumsum(sizes)
            shift = self.place_of[part] - (ends - sizes)
            out.append(self.flat[np.arange(ends[-1]) + np.repeat(shift, sizes)].tobytes())
        return b"".join(out)


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64-token rank``."""
    store, place = open_store(path)
    with store.open_input_stream(place, compression=None) as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.read().splitlines())}


def encode_texts(docs: DataFrame, make_codec: Callable[[], BytePairCodec], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and the bytes they decode to, of every text. ``make_codec`` is
    called once a task; one that keeps what it makes (``ranked_codec``) makes it once a worker."""
    return _mapped(docs, make_codec, id_col, text_col, "ids array<int>, decoded binary",
                   lambda ids, decoded: {"ids": pa.array([x.tolist() for x in ids], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.binary())})


def digest_texts(docs: DataFrame, make_codec: Callable[[], BytePairCodec], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes, made where they are encoded."""
    decimal: list[str] = []

    def columns(ids: list[np.ndarray], decoded: list[bytes]) -> dict:
        if not decimal:
            decimal.extend(map(str, range(1 << 18)))
        return {"n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": [hashlib.sha256(",".join(map(decimal.__getitem__, x.tolist())).encode()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded]}

    return _mapped(docs, make_codec, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def _mapped(docs: DataFrame, make_codec, id_col: str, text_col: str, kinds: str, columns) -> DataFrame:
    def run(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in found:
            codec = codec or make_codec()
            for part in by_size(batch, "text", BATCH_BYTES):
                texts = [(x.as_py() or b"").decode("utf-8", "replace") for x in part.column("text")]
                encoded = codec.encode_all(texts)
                for at in range(0, len(texts), 64):
                    ids = list(islice(encoded, 64))
                    yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").slice(at, 64),
                                                      **columns(ids, [codec.decode(x) for x in ids])})
        if codec is not None:
            codec.forget()  # the worker may serve other stages next

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {kinds}")


@lru_cache(maxsize=4)
def ranked_codec(path: str, pattern: str) -> BytePairCodec:
    """One codec for each Python worker, ranks file and pattern; its tables are kept from task to task."""
    return BytePairCodec(load_ranks(path), pattern)


def public_codec(name: str = "byte_bpe_multi_50k.tiktoken") -> BytePairCodec:
    import public_tokenizers

    return ranked_codec(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents; digests of the ids and of the decoded bytes."""
    return digest_texts(table(spark, sf_dir, "documents"), public_codec)
