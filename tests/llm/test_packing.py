import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from osm_tables.llm import packing
from tests.llm.helpers import DOCS, odd_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(pieces, lengths, capacity):
    """Every token once; sequences without gaps, of whole capacity or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, n, sequence, offset in pieces:
        assert n > 0
        by_doc[doc].append((start, n))
        by_sequence[sequence].append((offset, n))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(by_doc[doc]):
            assert start == at
            at += n
        assert at == length
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at == capacity or at < capacity and at & (at - 1) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([1, 8, 64]))
def test_any_lengths_pack_without_padding(lengths, capacity):
    check(packing.pack(np.array(lengths, np.int64), capacity, 1.0, 0.1).tolist(), lengths, capacity)


def test_costs_are_balanced():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 400) for _ in range(2000)]
    cost = lambda pieces: np.bincount(pieces[:, 3], pieces[:, 2] + pieces[:, 2] ** 2 / 1024)
    found = packing.pack(np.array(lengths), 1024, 1.0, 1 / 1024)
    full = cost(found)[: sum(lengths) // 1024]
    order, at, plain = list(range(2000)), 0, []
    for doc in order:  # one after another, as they come
        start, n = 0, lengths[doc]
        while n:
            part = min(n, 1024 - at % 1024)
            plain.append((doc, start, part, at // 1024, at % 1024))
            start, n, at = start + part, n - part, at + part
    as_they_come = cost(np.array(plain))[: sum(lengths) // 1024]
    assert full.std() < 0.6 * as_they_come.std()


def test_ids_are_the_tokenizers(tokenizer):
    texts = [t or "" for _, t in odd_docs()] + ["<|endoftext|> it's 100% <|x|>\n\n  tail  ", "a <|endoftext|>", "x  <|endoftext|><|endoftext|>  y", "<|endoftext"]
    encode = packing.encoder(PATH)
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_all_documents_are_the_tokenizers(spark, sf_dir, tokenizer):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    encode = packing.encoder(PATH)
    wanted = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert all(encode(t) == w.ids for t, w in zip(texts, wanted, strict=True))


def test_files_with_odd_added_tokens_go_to_their_library(tmp_path, tokenizer):
    import json

    content = json.load(open(PATH, encoding="utf-8"))
    content["added_tokens"][0]["rstrip"] = True
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(content), encoding="utf-8")
    text = "a <|endoftext|>  b"
    assert packing.encoder(str(path))(text) == Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("batch", [2_000_000, 300])
def test_documents_against_the_tokenizer(spark, tokenizer, batch):
    rows = odd_docs() + [(7000, "many words " * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", length int")
    found = packing.pack_documents(docs, PATH, batch_tokens=batch, with_ids=True).collect()
    expected = defaultdict(int)
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        expected[doc, tuple(ids)] += 1
    sequences, tokens = defaultdict(list), defaultdict(int)
    for p in found:
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and len(p["ids"]) == p["length"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        for i, x in enumerate(p["ids"]):
            tokens[p["doc_id"], p["doc_tokens"], p["start"] + i, x] += 1
    for (doc, ids), times in expected.items():
        for i, x in enumerate(ids):
            assert tokens[doc, len(ids), i, x] >= times
    assert sum(tokens.values()) == sum(len(ids) * times for (_, ids), times in expected.items())
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)


def test_no_documents_and_a_wrong_capacity(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS), PATH).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack_documents(spark.createDataFrame([], DOCS), PATH, capacity=1000)


def test_added_tokens_in_a_text_are_their_own_ids(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>x<|endoftext"), (3, "plain"), (4, " \n <|endoftext|>"), (5, None)]
    found = packing.pack_documents(spark.createDataFrame(rows, DOCS).coalesce(1), PATH, with_ids=True).collect()
    ids = defaultdict(list)
    for p in sorted(found, key=lambda p: (p["doc_id"], p["start"])):
        ids[p["doc_id"]] += p["ids"]
    assert ids[1] == [64, 220, 50256, 275, 0]
    defaults = Tokenizer.from_file(PATH)
    assert dict(ids) == {d: defaults.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
