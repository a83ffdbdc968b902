"""Helpers that need no Spark: hashing, filters, signatures, merges, templates."""

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from llm_fixtures import SF, WORD  # noqa: F401
from hypothesis import given, settings, strategies as st
from rollplane.llm import bpe, chat, exact_dedup, hashing, katz, license_scan, near_dedup
import re


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \n\té ", max_size=12)), max_size=8))
def test_word_hashes_follow_words(texts):
    h, first = hashing.word_hashes(pa.array(texts, pa.string()), lower=True)
    words = [WORD.findall(t or "") for t in texts]
    assert first.tolist() == np.cumsum([0] + [len(w) for w in words]).tolist()
    flat = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for ws in words for w in ws]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_hash_does_not_depend_on_place_or_chunk():
    long = "x" * (hashing.CHUNK + 10)
    h, _ = hashing.word_hashes(pa.array([f"word {long} word", "word"]))
    assert h[0] == h[2] == h[3] != h[1]
    assert hashing.string_hashes(pa.array(["word", long])).tolist() == [h[0], h[1]]


def test_pack_round_trip():
    v = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], np.int64)
    assert (hashing.unpack(hashing.pack(v), len(v)) == v).all()
    assert len(hashing.unpack(hashing.pack(v[:0]), 0)) == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 4096, 60_000])
def test_fuse_filter_has_all_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    filt = exact_dedup.build_fuse(keys)
    assert exact_dedup.in_fuse(keys, *filt).all()
    if n > 3:
        assert exact_dedup.in_fuse(rng.integers(0, 2**63, 50_000).astype(np.uint64), *filt).mean() < 0.02
    if n >= 4096:
        assert len(filt[2]) < 1.5 * n


def test_bag_minhash_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    errors, spread = [], []
    for _ in range(150):
        a = {int(k): int(rng.integers(1, 40)) for k in rng.integers(0, 10**9, 50)}
        b = {k: (int(rng.integers(1, 40)) if rng.random() < 0.4 else v) for k, v in a.items() if rng.random() < 0.9}
        doc = np.repeat([0, 1], [len(a), len(b)])
        sig = near_dedup.bag_minhash(doc, hashing.mix64(np.array([*a, *b], np.uint64)),
                                     np.array([*a.values(), *b.values()]), 2, 128)
        keys = {*a, *b}
        j = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
        errors.append((sig[0] == sig[1]).mean() - j)
        spread.append(j * (1 - j) / 128)
    assert abs(np.mean(errors)) < 4 * np.sqrt(np.mean(spread) / len(errors))
    assert 0.8 < np.std(errors) / np.sqrt(np.mean(spread)) < 1.2


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


def test_merges_as_tiktoken(ranks):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    import pyarrow.parquet as pq
    words = {w for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() for w in regex.findall(P.PATTERN, t)}
    words |= {"a" * 3000, "ab" * 700, "éèê" * 90, "thththe" * 40, " " * 500, "!?" * 99}
    assert [w for w in words if bpe.merge_word(w.encode(), ranks) != enc.encode_ordinary(w)] == []


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>[]/\\|sINTtur end\n", max_size=40))
def test_escapes_are_reversible_and_hide_control_strings(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text and chat.unescape_field(chat.escape_field(text)) == text
    assert not re.search(r"<s>|</s>|\[/?INST\]|<\|", e)
    assert "\n" not in chat.escape_field(text)


def test_template_language():
    r = chat.compile_template(
        "{% set who = 'A' ~ 'B' %}{{ who | lower }}{# note #}{% for m in messages %}"
        "{% if loop.first and not (m.role == 'x') %}<{{ loop.index0 + 1 }}>{% elif m['text'] != '' %}{{ m.text | trim | upper }}"
        "{% else %}none{% endif %}{% generation %}{{ m.text | length }}{% endgeneration %}{% endfor %}")
    text, spans = r([{"role": "u", "text": " a "}, {"role": "v", "text": " b "}, {"role": "v", "text": ""}])
    assert text == "ab<1>3B3none0" and [text[a:b] for a, b in spans] == ["3", "3", "0"]


def test_constants_fold():
    assert chat.fold(chat.parse("a{{ 'b' ~ (1 + 2) }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{% if 'a' in 'b' %}d{% endif %}")) == [
        ("text", "ab3c")]
    assert chat.fold(chat.parse("{% if true or x %}yes{% endif %}")) == [("text", "yes")]


@pytest.mark.parametrize("bad", ["{{ a | system }}", "{{ a(1) }}", "{% import x %}", "{% for m in messages %}", "{{ a ==",
                                 "{{ __import__('os') }}", "{% if a %}", "{{ a[b] }}", "{{ }}"])
def test_templates_outside_the_language_are_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_python_objects_are_out_of_reach():
    r = chat.compile_template("{% for m in messages %}{{ m.__class__ }}{{ m.text.__len__ }}{% endfor %}")
    assert r([{"role": "a", "text": "b"}])[0] == ""


def test_good_turing_ratios():
    d = katz.good_turing([0, 1000, 400, 220, 140, 95, 70])
    assert ((d[1:] > 0) & (d[1:] < 1)).all()
    assert (katz.good_turing([0] * 7)[1:] < 1).all()


def test_known_licence_sentences_are_normalised_and_hinted():
    for s in license_scan.SENTENCES.values():
        assert re.fullmatch(r"[a-z0-9]+( [a-z0-9]+)*", s) and re.search(license_scan.HINT, s)
    for _, ids in license_scan.RULES:
        assert set(ids) <= set(license_scan.SENTENCES)


def test_word_lists_are_shuffled_compressed():
    """Lists of words survive packing, take under half of their plain size, and none crosses BPE's exchange unpacked."""
    words = ["", "a", "\u00e9t\u00e9", "\u6f22\u5b57", *[f" number{i * 7}" for i in range(5000)]]
    lens, body = hashing.pack_strings(pa.array(words))
    assert hashing.unpack_strings(lens, body, len(words)).to_pylist() == words
    assert hashing.unpack_strings(*hashing.pack_strings(pa.array([], pa.string())), 0).to_pylist() == []
    assert hashing.unpack_strings(*hashing.pack_strings(pa.array(["", ""])), 2).to_pylist() == ["", ""]
    assert len(lens) + len(body) < sum(len(w.encode()) for w in words) / 2
    assert "words" in bpe.SPLIT_COLUMNS and bpe.MERGED.field("ids").type == bpe.MERGED.field("n").type == pa.binary()
