"""WARC archives, the classifier, and the pipeline over a supplied table."""

import gzip
import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from rxstrata.llm import bpe, classifier, warc
from rxstrata.llm.queries import op8_quality_classifier, table
from rxstrata.llm.storage import open_input

from . import brute
from .test_native import targets_by_rounds

SMALL = "/root/testdata/sf0.001"
BIG = "<p>Ünïcode</p>\r\n\r\nWARC/1.1\r\n" * 60


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("file", F.lit(1))


def test_archives(spark, documents):
    documents()
    rows = [(i, f"http://h/{i}", BIG if i % 3 else f"{i}" + "y" * 1200) for i in range(60)]
    rows += [(100, None, None), (101, "http://e/\r\nX: y", ""), (102, "u", "short"), (103, "u", "short")]
    rows += [(104, "u", "z" * 1000), (105, "u", "z" * 1000), (106, "u", "é" * 499 + "!"), (107, "u", "é" * 499 + "!")]
    rows += [(None, "u", BIG), (59, "again", BIG)]
    archives = warc.archive(pages(spark, rows).repartition(4))
    got = warc.read(archives).collect()
    assert len(got) == len(rows)
    payloads = [(h or "").encode() for _, _, h in rows]
    last = {}
    for (page_id, _, _), p in zip(rows, payloads, strict=True):
        if page_id is not None:
            last[p] = max(page_id, last.get(p, page_id))
    want = Counter()
    responses = set()
    for (page_id, _, _), p in zip(rows, payloads, strict=True):
        original = len(p) >= 1000 and (page_id != last[p] or p in responses)
        if page_id == last[p]:
            responses.add(p)
        want[(page_id, len(p), hashlib.sha1(p).hexdigest(), "revisit" if original else "response", last[p] if original else None)] += 1
    assert Counter(tuple(r) for r in got) == want
    # plain gzip reads the archives, and equal payloads are stored once
    text = b""
    for r in archives.collect():
        with open_input(r.uri) as source:
            text += gzip.decompress(source.read())
    assert text.count(BIG.encode()) == 1 and text.count(b"WARC-Type: revisit") == sum(r.record_type == "revisit" for r in got)
    assert b"\r\nX: y" not in text


def test_no_pages(spark, documents):
    documents()
    assert warc.read(warc.archive(pages(spark, []))).count() == 0


def test_a_cut_archive_is_noticed():
    import io

    record = warc._member(warc._record("response", 1, "u", hashlib.sha1(b"x").hexdigest(), 1, b"x"), 6)
    assert len(list(warc.records(io.BytesIO(record * 3)))) == 3
    with pytest.raises(EOFError):
        list(warc.records(io.BytesIO(record + record[:-9])))


def test_scores_on_held_out_labels(spark, documents):
    documents()
    folder = "/root/testdata/sf0.01"
    rows = op8_quality_classifier(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    assert len(rows) == table(spark, folder, "documents").count()
    hits = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in labels:
            hits.append(r.predicted == labels[r.doc_id])
    assert np.mean(hits) >= 0.95 and len(hits) > 50


def test_scores_do_not_depend_on_batches_or_order():
    texts = pa.array(["good words here and there", None, "", "bad### worse*** 12", "x y z x y z x y z " * 50])
    model = classifier.fit_ftrl(classifier.sparse_rows(texts), np.array([1, 1, 1, 0, 0.0]))
    together = model.scores(texts)
    alone = [model.scores(texts.slice(i, 1))[0] for i in range(len(texts))]
    assert np.allclose(together, alone)
    # the dot product over sparse rows is the score
    for (index, share), s in zip(classifier.sparse_rows(texts), together, strict=True):
        assert 1 / (1 + np.exp(-(model.weights[index] @ share + model.weights[-1]))) == pytest.approx(s)


def test_model_without_labels_and_clashing_columns(spark, documents):
    docs = documents("some text", None, "").withColumn("_score", F.lit("mine"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = classifier.fit(docs, none)
    assert {r.score for r in classifier.with_scores(docs, model).collect()} == {0.5}
    kept = classifier.keep_good(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.count() == 3
    odd = spark.createDataFrame([(0, None, 1), (None, 1, 1), (1, 0, 0), (1, 1, 0)], none.schema)
    assert classifier.fit(docs, odd).weights.shape == (2**classifier.BITS + 1,)
    assert classifier.with_scores(documents(), model).count() == 0


def test_repeated_ids_bring_one_row_each_to_the_driver(spark, documents, monkeypatch):
    got = []
    monkeypatch.setattr(classifier, "fit_ftrl", lambda rows, labels, bits: got.append((rows, list(labels))))
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:10]
    docs = documents(*[(i, f"text {i} number {n}", "s") for i in ids for n in range(7 if i == ids[0] else 1)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    for parts in (1, 5):
        classifier.fit(docs.repartition(parts), labels)
    assert len(got[0][0]) == 10 and got[0][1] == got[1][1]
    for (i, x), (j, y) in zip(got[0][0], got[1][0], strict=True):
        assert (i == j).all() and (x == y).all()


def test_pipeline_stages_against_brute_force(spark, documents):
    documents()
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = step(spark, before, SMALL)
        docs = docs.cache()
        rows, old = docs.collect(), before.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "quality_classifier":
            model = classifier.fit(before, table(spark, SMALL, "labels"))
            scores = model.scores(pa.array([r.text for r in old]))
            assert {r.doc_id for r in rows} == {r.doc_id for r, s in zip(old, scores) if s >= 0.3}
        elif name == "exact_dedup":
            last = {}
            for r in old:
                key = (r.text or "").translate(brute.LOWER)
                last[key] = max(r.doc_id, last.get(key, r.doc_id))
            assert {r.doc_id for r in rows} == set(last.values())
        elif name == "ngram_jaccard_join":
            found = brute.join_components([(r.doc_id, r.text) for r in old])
            assert {r.doc_id for r in rows} == {r.doc_id for r, (n, c) in zip(old, found) if c == r.doc_id or not n}
        elif name == "mixing":
            sizes = Counter()
            for r in old:
                sizes[r.source] += len(brute.words(r.text))
            targets, copies = targets_by_rounds(sizes), {}
            for r in old:
                rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0.0
                text = hashlib.md5((r.text or "").encode()).hexdigest()
                drawn = int(hashlib.md5(f"mix-1:{r.doc_id}:{text}".encode()).hexdigest()[:13], 16) / 2**52
                copies[r.doc_id] = int(rate) + (drawn < rate - int(rate))
            assert Counter(r.doc_id for r in rows) == Counter({d: n for d, n in copies.items() if n})
        else:
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in old)
            texts = {r.doc_id: r.text for r in old}
            plain = tiktoken.Encoding(
                "plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
            )
            for r in rows:
                ids = plain.encode_ordinary(texts[r.doc_id] or "")
                listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
                assert (r.n_tokens, r.ids_sha256) == (len(ids), listed)
                assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert rows
