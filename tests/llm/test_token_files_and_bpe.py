"""Token files and byte-level BPE against the tokenizers and tiktoken libraries."""

from __future__ import annotations

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weft.llm import bpe, token_files
from weft.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = "byte_bpe_multi_50k.tiktoken"
ODD = "aB 'sİßeé\t\n\x0b\x0c\x1c\x1f\x85\xa0 é漢字1½²_!?.🙂\x00|"


@pytest.fixture(scope="module")
def codec():
    return bpe.public_codec()


@pytest.fixture(scope="module")
def theirs(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@given(st.lists(st.one_of(st.text(alphabet=ODD, max_size=30), st.text(max_size=20)), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_bpe_equals_tiktoken_and_decodes(codec, theirs, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert ids.tolist() == theirs.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


RUNS_OF_SPACE = st.lists(st.sampled_from([" ", "  ", "\t", "\n", "\x0b", "\xa0", "\u2003", "\0", "a", "b", "'s", ",", "9"]), max_size=14).map("".join)


@given(st.lists(RUNS_OF_SPACE, min_size=1, max_size=12), st.permutations(range(12)), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_ids_do_not_depend_on_what_was_met_before(codec, theirs, texts, order, size):
    """One codec for all examples: every order and batching gives the library's ids."""
    want = {t: theirs.encode_ordinary(t) for t in texts}
    for some in (texts, [texts[k] for k in order if k < len(texts)], ["a ", "b  ", *texts, "x \n y", "   x"]):
        for at in range(0, len(some), size):
            batch = some[at:at + size]
            for text, ids in zip(batch, codec.encode_all(batch), strict=True):
                assert ids.tolist() == want.setdefault(text, theirs.encode_ordinary(text)) and codec.decode(ids) == text.encode()


def test_codecs_of_two_rank_files_are_told_apart(spark, theirs):
    def own(which):
        def make():
            ranks = {bytes([b]): 255 - b if which else b for b in range(256)}
            return bpe.BytePairCodec(ranks, public_tokenizers.PATTERN)
        return make
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    assert [bpe.encode_texts(df, own(k)).first().ids for k in (0, 1)] == [[97, 98], [158, 157]]


def test_bpe_of_very_long_pre_tokens(codec, theirs):
    for text in ("a" * 40_000, "xyz" * 9_000 + "Straße" * 3_000, "\n" * 5_000 + " " * 5_000 + "."):
        assert codec.encode(text).tolist() == theirs.encode_ordinary(text)
    for piece in (b"thethethe" * 50, b"a" * 999, "ß漢".encode() * 40):  # the one-by-one merge
        assert codec.merge(piece) == codec.encode(piece.decode()).tolist()


def test_merge_order_with_ranks_that_fall():
    """A vocabulary in which a merge makes a pair of a lower rank: both merges agree with a plain search."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"cd": 258, b"bcd": 259, b"aa": 260, b"aaa": 261}
    codec = bpe.BytePairCodec(ranks, public_tokenizers.PATTERN)

    def plain(piece: bytes) -> list[int]:
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rnd = random.Random(3)
    pieces = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 14))).encode() for _ in range(400)]
    many = codec.merge_all(pieces)
    for piece, ids in zip(pieces, many, strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == plain(piece) == codec.merge(piece)


def test_rank_queue_pops_lowest_rank_then_leftmost():
    queue, rnd = bpe.RankQueue(50_000), random.Random(1)
    entries = [(rnd.randrange(50_000), rnd.randrange(1000)) for _ in range(3000)]
    for rank, position in entries:
        queue.push(rank, position)
    assert [queue.pop() for _ in entries] == sorted(entries) and queue.pop() is None


def _docs(spark):
    rows = [(5, "The cat's 12 hats, the END."), (1, None), (2, ""), (3, "x " * 200_000), (3, "x " * 200_000), (None, "Ünï çödé İ|"),
            (4, "\n\n tabs\t\there "), (7, "word" * 30_000)]
    return spark.createDataFrame([(i, t, 9, "s", 1) for i, t in rows], "doc_id long, text string, n_tokens int, ids string, start int").repartition(3)


def test_digest_query_on_odd_rows(spark, codec, theirs):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest_texts(_docs(spark), bpe.public_codec).collect()}
    want = set()
    for r in _docs(spark).collect():
        ids = theirs.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == want
    out = bpe.encode_texts(_docs(spark).where("doc_id = 5"), bpe.public_codec).first()
    assert out.ids == theirs.encode_ordinary("The cat's 12 hats, the END.") and bytes(out.decoded) == b"The cat's 12 hats, the END."
    assert bpe.digest_texts(_docs(spark).where("false"), bpe.public_codec).count() == 0


MARKS = "\u0300\u0301\u0308\u030a\u030c\u0331\u0338\u0327"


@given(st.lists(st.lists(st.one_of(st.text(alphabet=ODD + "TheworHJWY=<" + MARKS, max_size=12),
                                   st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "T\u0308", "H\u0331", "J\u030c", "W\u030a", "Y\u030a"])), max_size=5).map("".join),
                min_size=1, max_size=10))
@settings(max_examples=300, deadline=None)
def test_chunk_encoder_equals_the_library(texts):
    whole = Tokenizer.from_file(WORDS)
    got = token_files.tokenizer_encoder(WORDS)([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_special_strings_are_tokens_as_in_the_plain_call(monkeypatch):
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|ENDOFTEXT|> x", "<|startoftext|><|endoftext|>", "<|endoftext|", "The END<|startoftext|>'s <|endoftext|>,\n(c", ""]
    plain = Tokenizer.from_file(WORDS)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [320, 49407, 321]
    monkeypatch.setattr(token_files, "CACHED_CHUNKS", 3)  # memory is turned over on the way
    encode = token_files.ChunkEncoder(WORDS)
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for t in texts for x in encode([t.encode()])] == want
    assert [np.frombuffer(x, "<u4").tolist() for x in encode([t.encode() for t in texts])] == want


def test_token_files_round_trip(spark):
    manifest = token_files.write_token_files(_docs(spark), scratch_path(spark, "t"), lambda: token_files.tokenizer_encoder(WORDS))
    got = sorted(tuple(r) for r in token_files.read_token_files(manifest).select("start", "n_tokens", "ids_crc32").collect())
    whole = Tokenizer.from_file(WORDS)
    rows = sorted(_docs(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))  # null ids first
    want, start = [], 0
    for r in rows:
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)
    asked = token_files.read_documents(manifest, [7, 3, 1, 999, 7]).collect()
    by_id = {r.doc_id: whole.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows}
    assert sorted(r.doc_id for r in asked) == [1, 3, 3, 7] and all(r.ids == by_id[r.doc_id] for r in asked)
    assert token_files.read_documents(manifest, [999]).count() == 0
    empty = token_files.write_token_files(_docs(spark).where("false"), scratch_path(spark, "t"), lambda: token_files.tokenizer_encoder(WORDS))
    assert token_files.read_token_files(empty).count() == 0


class _Kept(io.BytesIO):
    def close(self):
        pass


def test_reader_decompresses_only_the_frames_of_a_document():
    out = _Kept()
    writer = token_files.TokenFileWriter(out)
    docs = [(k, np.arange(k * 1000, k * 1000 + n, dtype="<u4")) for k, n in enumerate([5, 0, 200_000, 7, 90_000])]
    for k, ids in docs:
        writer.add(k, ids.tobytes())
    writer.close()
    data = out.getvalue()
    reader = token_files.TokenFileReader(pa.BufferReader(data))
    for row, (k, ids) in enumerate(docs):
        assert reader.find(k) == [row] and (reader.document(row) == ids).all()
    seen = []
    reader = token_files.TokenFileReader(pa.BufferReader(data))
    frame = reader.frame
    reader.frame = lambda k: seen.append(k) or frame(k)
    reader.document(3)
    assert len(set(seen)) == 1 and len(reader.packed) > 3
    # standard readers take the frames as one stream; a changed byte is found
    import zstandard
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    assert stream.read(4 * 200_005) == b"".join(ids.tobytes() for _, ids in docs)[:4 * 200_005]
    broken = bytearray(data)
    broken[int(reader.places[1]) + 40] ^= 1
    with pytest.raises(Exception):
        token_files.TokenFileReader(pa.BufferReader(bytes(broken))).document(2)
    with pytest.raises(ValueError):
        token_files.TokenFileReader(pa.BufferReader(data[:-1] + b"x"))
