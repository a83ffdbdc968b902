"""Packing: every id once, the tokenizer's ids, the programme against trying all cuts, odd rows."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from llm_fixtures import SF, documents, nothing, odd, odd_rows  # noqa: F401
from rollplane.llm import packing
from rollplane.llm.queries import QUERIES
from tokenizers import Tokenizer

JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(JSON)


def waste(n, size=2048):
    return 0 if n & (n - 1) == 0 else size - n


def check(rows, texts, reference, size=2048):
    """``rows`` of pack(); ``texts`` by doc_id."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        want = reference.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        pieces.sort(key=lambda r: r.start)
        got = b"".join(bytes(r.ids) for r in pieces)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert [r.start for r in pieces] == list(itertools.accumulate([0] + [r.length for r in pieces[:-1]]))
        assert {r.doc_tokens for r in pieces} == {len(want)} and all(len(r.ids) == 4 * r.length > 0 for r in pieces)
    total = pad = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(itertools.accumulate([0] + [r.length for r in pieces[:-1]]))
        n = sum(r.length for r in pieces)
        assert n <= size
        total, pad = total + n, pad + waste(n, size)
    return pad / max(total, 1)


def test_query_holds_every_id_once_with_little_padding(spark, documents, reference):
    rows = packing.pack(documents, JSON, P.PATTERN).collect()
    assert check(rows, {r.doc_id: r.text for r in documents.collect()}, reference) < 0.01
    want = sorted((r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens, r.sequence_id, r.offset) for r in rows)
    assert sorted(map(tuple, QUERIES["op11_packing"](spark, SF).collect())) == want


def test_cuts_are_the_cheapest():
    rnd = random.Random(4)
    for _ in range(300):
        size, each = rnd.choice([4, 8, 16]), rnd.choice([0, 1, 3])
        places = [0]
        while len(places) < rnd.randint(2, 12):
            places.append(places[-1] + rnd.randint(1, size))
        penalty = [rnd.choice([0, 0, 2, 9]) for _ in places]
        cuts, cost = packing.best_cuts(places, penalty, size, each)

        def price(ends):
            begin = [0, *ends[:-1]]
            if any(places[b] - places[a] > size for a, b in zip(begin, ends)):
                return None
            return sum(waste(places[b] - places[a], size) + penalty[b] + each for a, b in zip(begin, ends))

        last = len(places) - 1
        prices = [price([*mid, last]) for k in range(last) for mid in itertools.combinations(range(1, last), k)]
        assert price(cuts) == cost == min(p for p in prices if p is not None)


def test_cuts_prefer_document_then_sentence_ends():
    marks = packing.sentence_marks({b"a": 0, b".": 1, b" b": 2, b"\n": 3, b"c": 4}, {"<s>": 5})
    ids = np.array([0, 1, 2, 4, 3, 0, 1, 4, 4, 4, 4, 4])
    places, cost = packing.cut_places(ids, np.array([4, 12]), marks, 2, 3, 4, 64)
    # after ". " and a line end; every third id of the long stretch; the last two ids
    assert dict(zip(places.tolist(), cost.tolist())) == {0: 0, 2: 4, 4: 0, 5: 4, 8: 64, 10: 64, 11: 64, 12: 0}


def test_encoder_equals_the_library(reference):
    encode = packing.encoder(*packing.load_tokenizer(JSON), P.PATTERN)
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list("　﻿😀\U000e0041")
    texts = [f"a{c}b {c}{c}1{c} {c}  {c}?'s" for c in chars]
    texts += ["", " ", "x  y", " \n" * 3000 + "x y", "a" + "\t " * 900, "q" * 50_000, "<|endoftext|>a <|endoftext|", "'S 'll I'LL",
              " " * 2000 + "z", "x" + " " * 5000 + "\n" * 5000 + "y" + " " * 1000]
    for t, e in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
        assert encode(t).tolist() == e.ids


def test_blank_run_beyond_the_pattern():
    encode = packing.encoder(*packing.load_tokenizer(JSON), P.PATTERN)
    assert len(encode(" " * 1_000_000 + "x")) > 0


def test_odd_rows(odd, odd_rows, nothing, reference):
    rows = packing.pack(odd, JSON, P.PATTERN, size=256, block_tokens=500).collect()
    wanted = sorted(len(reference.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in odd_rows)
    assert sorted(r.doc_tokens for r in rows if r.start == 0) == wanted
    assert sum(r.length for r in rows) == sum(wanted)
    seqs = packing.sequences(packing.pack(odd, JSON, P.PATTERN, size=256, block_tokens=500), 256).collect()
    assert all(r.n_tokens <= 256 and len(r.ids) == 4 * r.n_tokens == 4 * sum(d.length for d in r.documents) for r in seqs)
    assert all(r.padded_to == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 256) for r in seqs)
    assert {r.sequence_id for r in seqs} == {r.sequence_id for r in rows}
    assert packing.pack(nothing, JSON, P.PATTERN).count() == 0


def test_reruns_agree(odd):
    key = lambda: sorted(map(repr, packing.pack(odd, JSON, P.PATTERN, size=64).collect()))
    assert key() == key()
