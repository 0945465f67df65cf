"""BPE, edit-aware counts, token files."""

import hashlib
import io
import random
import struct
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from rxstrata.llm import bpe, token_counts, token_files
from rxstrata.session import stage, staging_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN

TEXTS = [
    None, "", " ", "  \n ", "a", "Hello there, it's 2024!  \n\n  fine\t", "é日本語 ñ x", "a" * 3000,
    "<|endoftext|> plain", "\x00\x01 \x1c b", "trailing ", "trailing\n", "two  spaces", " lead", "’s 's 'll",
    "word " * 20_000, "tail   wide",
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    ).encode_ordinary


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(RANKS, PATTERN)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_round_trip(documents, reference):
    docs = documents(*TEXTS, "repeated", "repeated")
    got = {r.doc_id: r for r in bpe.round_trip(docs, RANKS, PATTERN).collect()}
    for i, t in enumerate([*TEXTS, "repeated", "repeated"]):
        ids = reference(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_then_decode(documents, reference):
    encoded = bpe.encode(documents(*TEXTS), RANKS, PATTERN)
    assert {r.doc_id: r.ids for r in encoded.collect()} == {
        i: reference(t or "") for i, t in enumerate(TEXTS)
    }
    decoded = {r.doc_id: bytes(r.bytes) for r in bpe.decode(encoded, RANKS, PATTERN).collect()}
    assert decoded == {i: (t or "").encode() for i, t in enumerate(TEXTS)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_text(texts):
    coder = bpe.Coder(RANKS, PATTERN)
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    ids = coder.encode(texts)
    assert [i.tolist() for i in ids] == [enc.encode_ordinary(t) for t in texts]
    assert coder.decode(ids) == [t.encode() for t in texts]


def test_long_words(coder, reference):
    rng = random.Random(3)
    words = ["aab" * 200, "the" * 200, "日本語の文章" * 30, "".join(rng.choices("theranio", k=1500)), "é" * 300]
    words += ["".join(rng.choices("abcdefghij", k=rng.randint(60, 300))) for _ in range(20)]
    ids = coder.encode(words)
    assert [i.tolist() for i in ids] == [reference(w) for w in words]
    assert coder.decode(ids) == [w.encode() for w in words]


def test_edits_against_counting_anew(reference):
    rng = random.Random(9)
    counter = token_counts.WordCounter(RANKS, PATTERN)
    pieces = ["a", "b", " ", "  ", "\n", "'", "ll", "'s", "1", "é", "!", "\t", "the ", "日本"]
    for _ in range(400):
        text = "".join(rng.choices(pieces, k=rng.choice([0, 1, 5, 30, 600])))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(0, 4)) // 2 * 2))
        edits = [(a, b, "".join(rng.choices(pieces, k=rng.randint(0, 5)))) for a, b in zip(cuts[::2], cuts[1::2])]
        tree = token_counts.SegmentTree(text, counter)
        for a, b, new in reversed(edits):
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.n_chars == len(text)
        assert tree.n_tokens == len(reference(text))


def test_edits_cost_what_they_touch(reference):
    counter = token_counts.WordCounter(RANKS, PATTERN)
    text = "some words of a long text, " * 5000
    tree = token_counts.SegmentTree(text, counter)
    tree.replace(60_000, 60_010, "other")
    tree.replace(0, 0, "first ")
    assert tree.n_tokens == len(reference("first " + text[:60_000] + "other" + text[60_010:]))
    assert tree.recounted < 200


def test_counts_of_documents(documents, reference):
    texts = [*TEXTS, "a\nb\na\nc\na", "x\n\nx\n"]

    def edited(text):
        for a, b, new in reversed(token_counts.cleaning_edits(text)):
            text = text[:a] + new + text[b:]
        return text

    assert edited("a\nb\na\nc\na") == "a\nb\nc\n"
    rows = token_counts.count_edited(documents(*texts), RANKS, PATTERN, edits=token_counts.cleaning_edits)
    for r in rows.collect():
        t = texts[r.doc_id] or ""
        assert (r.n_tokens, r.n_tokens_after) == (len(reference(t)), len(reference(edited(t))))
    column = F.when(F.length("text") > 3, F.array(F.struct(F.lit(1).alias("start"), F.lit(2).alias("end"), F.lit("Q ").alias("replacement"))))
    rows = token_counts.count_edited(documents(*texts).withColumn("edits", column), RANKS, PATTERN)
    for r in rows.collect():
        t = texts[r.doc_id] or ""
        assert r.n_tokens_after == len(reference(t[:1] + "Q " + t[2:] if len(t) > 3 else t))
    assert token_counts.count_edited(documents(), RANKS, PATTERN, edits=token_counts.cleaning_edits).count() == 0


def test_pieces_encode_as_whole_texts(tokenizer):
    encoder = token_files.PieceEncoder(JSON)
    rng = random.Random(2)
    parts = ["the", " ", " ", "\n", "é", "'s", ",", "12", "\t", "日", "Ġ", " ", "\x1c", "word"]
    texts = [*TEXTS, *("".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(500))]
    got = encoder.encode(texts)
    for t, data in zip(texts, got, strict=True):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer(t or ""), repr(t)


class Counted(dict):
    """Counts how often an entry is asked for."""

    asked = 0

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)

    def get(self, key, *default):
        self.asked += 1
        return super().get(key, *default)


def test_equal_pieces_of_a_batch_are_looked_up_once(tokenizer):
    encoder = token_files.PieceEncoder(JSON)
    encoder.known = Counted()
    texts = [f"{i % 3} " + "one two, three\nfour " * 200 + "end" for i in range(30)]
    got = encoder.encode(texts)
    assert [np.frombuffer(d, "<u4").tolist() for d in got] == [tokenizer(t) for t in texts]
    assert encoder.known.asked <= 2 * 9


def test_equal_pieces_of_a_batch_are_split_once(reference):
    coder, seen = bpe.Coder(RANKS, PATTERN), []
    split, coder.words, coder.segments = coder.split, Counted(), Counted()
    coder.split = lambda text: seen.append(len(text)) or split(text)
    texts = [f"{i % 3} " + "one two, three\nfour " * 200 + "end" for i in range(30)] + [None, "", "uncut  one ", " x", "x"]
    ids = coder.encode(texts)
    assert [i.tolist() for i in ids] == [reference(t or "") for t in texts]
    assert sum(seen) < 100 and coder.words.asked < 50
    assert coder.decode(ids) == [(t or "").encode() for t in texts] and coder.segments.asked < 50
    assert coder.listed(ids) == [" ".join(map(str, reference(t or ""))).encode() for t in texts]


def test_other_patterns_do_not_cut_at_spaces():
    pattern = r"\S+ \S+|\s+|\S+"
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = ["one two three", "a b", "", "x"]
    ids = bpe.Coder(RANKS, pattern).encode(texts)
    assert [i.tolist() for i in ids] == [enc.encode_ordinary(t) for t in texts]


def test_what_is_remembered_changes_no_result(reference):
    coder = bpe.Coder(RANKS, PATTERN, remembered=5)
    for texts in (["one two three four five"], ["one six seven"], ["eight one two\nnine", "ten one"], []):
        ids = coder.encode(texts)
        assert [i.tolist() for i in ids] == [reference(t) for t in texts]
        assert coder.decode(ids) == [t.encode() for t in texts]
        assert len(coder.words) <= 10


def test_token_files(spark, documents, tokenizer):
    rows = [(i * 2, t, "s") for i, t in enumerate(TEXTS)] + [(3, "third", "s"), (None, "no id", "s"), (4, "", "s")]
    docs = documents(*rows).repartition(3)
    got = token_files.written_and_read(docs, JSON).collect()
    assert len(got) == len(rows)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(
        (d for d, _, _ in rows), key=lambda d: (d is not None, d)
    )
    crcs = sorted(
        (str(d), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, t, _ in rows
        for ids in [[*tokenizer(t or ""), 0]]
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == crcs
    assert token_files.written_and_read(documents(), JSON).count() == 0


class Counting(io.BytesIO):
    """A file that counts what is read."""

    got = 0

    def size(self):
        return len(self.getvalue())

    def read(self, n=-1):
        data = super().read(n)
        self.got += len(data)
        return data


def one_file(frame_bytes=4096):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype("<u4").tobytes() for n in (1, 0, 3, 5000, 2, *[700] * 60)]
    out = io.BytesIO()
    writer = token_files.FrameWriter(out, frame_bytes=frame_bytes)
    for i, data in enumerate(docs):
        writer.add(None if i == 1 else i, data)
    writer.close()
    return docs, out.getvalue()


def test_readers_take_only_the_frames_they_need():
    docs, data = one_file()
    source = Counting(data)
    reader = token_files.FrameReader(source)
    opened = source.got
    assert [d for _, d in reader.documents()] == docs
    assert reader.null.tolist() == [i == 1 for i in range(len(docs))]
    source.got = 0
    assert list(token_files.FrameReader(source).documents([2, 40])) == [(2, docs[2]), (40, docs[40])]
    assert source.got - opened < 4 * 4096


def test_the_file_is_a_plain_zstandard_stream():
    import zstandard

    docs, data = one_file()
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as stream:
        assert stream.read() == b"".join(docs)


def test_damage_is_noticed():
    docs, data = one_file()
    broken = bytearray(data)
    broken[200] ^= 1
    with pytest.raises(Exception):  # the codec's or the checksum's error
        list(token_files.FrameReader(Counting(bytes(broken))).documents())
    at = len(data) - 9 - 12
    entry = list(struct.unpack_from("<III", data, at - 12))
    entry[2] ^= 1
    broken = bytearray(data)
    struct.pack_into("<III", broken, at - 12, *entry)
    with pytest.raises(ValueError, match="checksum"):
        list(token_files.FrameReader(Counting(bytes(broken))).documents())


def test_a_repeated_task_leaves_one_file(spark, documents):
    folder = staging_path(spark, "twice")
    docs = documents(*TEXTS)
    first = stage(token_files.write(docs, JSON, folder), "list")
    again = stage(token_files.write(docs, JSON, folder), "list")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    assert token_files.read(again).count() == len(TEXTS)
