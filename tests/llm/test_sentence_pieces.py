import hashlib
import random
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from osm_tables.llm import sentence_pieces as S
from tests.llm.helpers import DOCS, odd_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "e", "er", "th", "the", "in", "ing", " ", "  ", "\n", "\t", "é", "日", "\U0001f600", S.SPACE, "0", "00", "-", "<0x0A>", "aaa", "\x00", "==", "<s>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(1500)]
    made += ["".join(rng.choice(string.ascii_letters + "  .,'") for _ in range(rng.randrange(60))) for _ in range(1500)]
    return made + [t or "" for _, t in odd_docs()] + ["a" * 5000, "no spaces" * 500, " " * 999]


def test_ids_and_texts_are_the_librarys(library):
    transducer = S.compiled(PATH)
    for text in texts():
        ids = transducer.encode(text)
        assert ids == library.encode(text), text
        assert transducer.decode(ids) == library.decode(ids)


def test_whole_texts_and_words_give_the_same_path():
    transducer = S.Transducer(PATH)
    for text in texts()[::40]:
        whole = transducer.normalised(text)
        if whole:
            assert list(transducer.path(whole)) == transducer.encode(text)


def test_weights_alone_decide_without_merging():
    """A model of weighted pieces: the lightest of all ways, found by trying every one."""
    transducer = S.Transducer(PATH)
    rng = random.Random(2)
    transducer.merging = False
    transducer.names = ["<unk>", *"abc", "ab", "bc", "abc", "ca", "aab"]
    transducer.ids = {x: i for i, x in enumerate(transducer.names) if i}
    transducer.compile_arcs()
    transducer.weights = [0.0] + [rng.uniform(1, 5) for _ in transducer.ids]

    def ways(text):
        if not text:
            yield []
        for x, i in transducer.ids.items():
            if text.startswith(x):
                yield from ([i, *rest] for rest in ways(text[len(x) :]))

    for _ in range(200):
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        weight = lambda way: sum(transducer.weights[i] for i in way)
        assert weight(transducer.path(text)) == pytest.approx(min(map(weight, ways(text))))


def test_documents_round_trip(spark, library):
    rows = odd_docs()
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", ids int")
    encoded = S.encode_documents(docs, PATH)
    back = S.decode_documents(encoded, PATH).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(d), t or "") for d, t in rows)
    for r in back:
        assert r["ids"] == library.encode(r["text"])
    digests = {(r["doc_id"], r["n_ids"], r["ids_crc32"], r["decoded_sha256"]) for r in S.digests(encoded, PATH).collect()}
    for r in back:
        ids = np.array(r["ids"], "<u4")
        assert (r["doc_id"], len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(r["text"].encode()).hexdigest()) in digests
    assert S.encode_documents(docs.where("false"), PATH).count() == 0


def test_pieces_tried_longest_first_are_those_of_all_states():
    class Counted(dict):
        n = 0

        def get(self, key, default=None):
            self.n += 1
            return dict.get(self, key, default)

    transducer = S.Transducer(PATH)
    transducer.arcs = Counted(transducer.arcs)
    rng = random.Random(4)
    all_states = longest_first = 0
    for letters in ["etaoinsh", "ab", string.ascii_letters] * 500:
        word = S.SPACE + "".join(rng.choices(letters, k=rng.randrange(1, 25)))
        before = transducer.arcs.n
        found = transducer.path(word)
        between = transducer.arcs.n
        back, last = transducer._merging_states(word)
        longest_first, all_states = longest_first + between - before, all_states + transducer.arcs.n - between
        at, ids = len(word), []
        while at:
            ids.append(last[at])
            at = back[at]
        assert found == tuple(ids[::-1]), word
    assert longest_first < 0.8 * all_states
