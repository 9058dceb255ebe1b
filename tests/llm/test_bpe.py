from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tripflow.llm import bpe

from .conftest import MESSY, make

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), bpe.class_array())


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


def test_random_texts_encode_as_the_library_does(encoder, library):
    draw = random.Random(3)
    letters = list("'''strvemldLLa e1 \n\t  ¼²é中!?.\x1c\x85  🙂x")
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 700 + "bc" * 400, "", "'", " ", "'re've'll 're 'lx 's'", "<|endoftext|>"]
    for text, (ids, marks, parts) in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()
        assert [text.encode()[a:b] for a, b in zip(marks, marks[1:])] == [encoder.decode(p) for p in parts]


def test_scan_equals_step_by_step_composition():
    of_class, compose, image = bpe.monoid()
    to, _ = bpe.automaton()
    classes = np.random.default_rng(5).integers(0, bpe.CLASSES, 3 * bpe.LANE * bpe.LANE // 2 + 7)
    state, states = bpe.FRESH, []
    for kind in classes[:5000]:
        state = to[state, kind]
        states.append(state)
    assert image[bpe.scan(of_class[classes], compose)[:5000], bpe.FRESH].tolist() == states


def test_digests_of_messy_rows(spark, messy, library):
    def wanted(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = Counter(map(tuple, bpe.digests(messy, PATH).collect()))
    assert got == Counter(wanted(r[0], r[1]) for r in MESSY)


def test_offsets_let_ranges_of_slices_decode(spark, library):
    text = "It's 12 o'clock — naïve  texts\n\nend "
    row = bpe.encode(make(spark, [(1, text)]), PATH, "source").first()
    assert row.source == "s" and row.ids == library.encode_ordinary(text)
    own = bpe.Encoder(bpe.read_ranks(PATH), bpe.class_array())
    for i in range(len(row.slice_bytes) - 1):
        part = np.array(row.ids[row.slice_ids[i] : row.slice_ids[i + 1]], "<u4").tobytes()
        assert own.decode(part) == text.encode()[row.slice_bytes[i] : row.slice_bytes[i + 1]]
    assert bpe.decode(bpe.encode(make(spark, [(1, text), (2, None)]), PATH), PATH).orderBy("doc_id").collect()[0].text == text.encode()


def test_no_rows(nothing):
    assert bpe.digests(nothing, PATH).count() == 0
