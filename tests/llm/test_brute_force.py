"""Every query without an SQL twin against a plain Python version."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from llm_fixtures import SF, WORD, documents, labels, shingle_counts  # noqa: F401
from rollplane.llm import bpe, chat, katz, license_scan, near_dedup, quality_rules
from rollplane.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_op1_shards_are_near_equal(spark, texts):
    rows = by_id(QUERIES["op1_kd_shards"](spark, SF))
    assert set(rows) == set(texts)
    load, slots = Counter(), defaultdict(list)
    for i, r in rows.items():
        b = (texts[i] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "bytes", None)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(load) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - sum(load.values()) / 24 <= 2 * max(r.size for r in rows.values())


def test_op3_finds_the_labelled_junk(spark, labels):
    rows = by_id(QUERIES["op3_quality"](spark, SF))
    lab = labels.collect()
    right = [rows[r.doc_id].kept == (r.quality == 1) for r in lab]
    assert sum(right) / len(right) > 0.95


def test_op3_held_out_accuracy(documents, labels):
    from pyspark.sql import functions as F
    from rollplane.llm import quality_classifier as qc
    fold = F.col("doc_id") % 3 == 0
    rows = by_id(qc.quality_table(documents, labels.filter(~fold)))
    lab = labels.filter(fold).collect()
    assert sum(rows[r.doc_id].kept == (r.quality == 1) for r in lab) / len(lab) > 0.9


def test_op5_licences(spark, texts):
    rows = by_id(QUERIES["op5_licenses"](spark, SF))
    planted = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    for i, t in texts.items():
        want = {v for k, v in planted.items() if any(line.strip() == k for line in (t or "").split("\n"))}
        assert set(filter(None, rows[i].licenses.split(","))) == want


def test_licence_texts_match_ordered_rules(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
           "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation "
           "the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright "
           "notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE "
           "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE "
           "WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. The end.")
    bsd = ["bsd_redistribution", "bsd_source", "bsd_binary"]
    text = {k: license_scan.SENTENCES[k].capitalize() + "." for k in license_scan.SENTENCES}
    rows = [(1, mit), (2, "\n".join(text[k] for k in bsd)), (3, "\n".join(text[k] for k in [*bsd, "bsd_endorse"])),
            (4, "Some prose. " + text["bsd_source"] + " More prose."), (5, text["short_mit"] + "\n" + text["short_gpl3"])]
    got = by_id(license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i].licenses for i in range(1, 6)] == [["MIT"], ["BSD-2-Clause"], ["BSD-3-Clause"], [], ["MIT", "GPL-3.0"]]


def katz_brute(texts, is_train):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    toks = {i: WORD.findall(low(t or "")) + ["\n"] for i, t in texts.items()}
    uni = Counter(w for i, t in toks.items() if is_train(i) for w in t)
    bi = Counter(p for i, t in toks.items() if is_train(i) for p in zip(["\n"] + t, t))
    n = sum(uni.values())
    d1, d2 = (katz.good_turing([0] + [Counter(c.values())[r] for r in range(1, katz.K + 2)]) for c in (uni, bi))
    kept = lambda d, c: (d[c] if c <= katz.K else 1.0) * c
    unknown = 1 - sum(kept(d1, c) for c in uni.values()) / n
    p1 = lambda w: kept(d1, uni[w]) / n if uni[w] else unknown
    after = defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c
    weights = {}
    for h, ws in after.items():
        lost = 1 - sum(kept(d2, c) for c in ws.values()) / uni[h]
        left = max(lost, 0.5 / (uni[h] + 1))
        weights[h] = left / (1 - sum(map(p1, ws))), (1 - left) / (1 - lost)

    def p(h, w):
        a, s = weights.get(h, (1.0, 1.0))
        c = after.get(h, {}).get(w, 0)
        return s * kept(d2, c) / uni[h] if c else a * p1(w)
    base = lambda w: math.log10((uni[w] + 0.5) / (n + 0.5 * (len(uni) + 1)))
    return toks, uni, n, p, base, after, unknown


def test_op6_katz(spark, texts):
    rows = by_id(QUERIES["op6_katz"](spark, SF))
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    toks, uni, n, p, base, after, unknown = katz_brute(texts, lambda i: not held(i))
    for i, t in toks.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(t), sum(uni[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(map(base, t)), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(h, w)) for h, w in zip(["\n"] + t, t)), rel_tol=1e-6)
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    for h in list(after)[:40]:  # every context sums to 1
        assert math.isclose(sum(p(h, w) for w in uni) + p(h, "\n\n"), 1, abs_tol=1e-9)


def test_katz_spread_contexts_and_small_blocks(spark, documents, texts):
    from pyspark.sql import functions as F
    train = F.col("doc_id") % 5 != 1
    a = by_id(katz.katz_scores(documents, train))
    b = by_id(katz.katz_scores(documents.repartition(5, "doc_id"), train, block_tokens=3000, bucket_tokens=2000))
    assert all(math.isclose(a[i].score, b[i].score, rel_tol=1e-6) for i in a)


def classes_brute(texts):
    ids, sets = list(texts), [shingle_counts(t) for t in texts.values()]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for x, a in zip(ids, sets):
        for y, b in zip(ids, sets):
            if x < y:
                low = sum((a & b).values())
                if texts[x] == texts[y] or low and low / (sum(a.values()) + sum(b.values()) - low) >= 0.8:
                    parent[max(root(x), root(y))] = min(root(x), root(y))
    return {i: root(i) for i in ids}


def test_op8_classes(spark, texts):
    rows = by_id(QUERIES["op8_near_dedup"](spark, SF))
    want = classes_brute(texts)
    assert {i: r.class_id for i, r in rows.items()} == want
    size = Counter(want.values())
    assert all(r.class_size == size[want[i]] and r.kept == (i == want[i]) for i, r in rows.items())


def test_near_dedup_chain_and_hot_family(spark):
    """A chain in which only neighbours are alike is one class, a large family is one
    class, and a passage shared by otherwise different texts makes none."""
    words = [f"w{i}" for i in range(400)]
    chain = {i: " ".join(words[i * 8:i * 8 + 100]) for i in range(12)}
    family = {100 + i: " ".join([f"f{j}" for j in range(120)][:110 + i % 10] + [f"x{i}"]) for i in range(60)}
    shared = {300 + i: " ".join([f"s{j}" for j in range(60)] + [f"own{i}_{j}" for j in range(60)]) for i in range(40)}
    texts = chain | family | shared
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in near_dedup.near_dedup(df).collect()}
    assert got == classes_brute(texts)


def test_near_dedup_large_family_of_uneven_copies(spark):
    """Copies with few to many edits: those beyond the threshold stay apart, unless
    another copy of theirs links them; no pair is lost to the last round's bound."""
    import random
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    texts, k = {}, 0
    for edits in [1, 2, 3, 4, 5, 6, 8, 10, 14] * 14:
        t = list(base)
        for at in rnd.sample(range(150), edits):
            t[at] = f"n{k}_{at}"
        texts[k] = " ".join(t)
        k += 1
        if k % 9 == 0:  # a near copy of a distant copy
            t[rnd.randrange(150)] = f"m{k}"
            texts[k] = " ".join(t)
            k += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = classes_brute(texts)
    assert len(set(want.values())) > 10
    assert {r.doc_id: r.class_id for r in near_dedup.near_dedup(df).collect()} == want


def test_near_dedup_family_of_recurring_edits(spark):
    """Copies that draw their edits from one pool have no shingles of their own, so a count of those rules no
    pair out: all 44,850 were tried. Few are now, and none that is similar is left out."""
    import random
    from itertools import combinations
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(600)]
    texts = {}
    for i in range(300):
        t = list(base)
        for at in rnd.sample(range(0, 600, 3), rnd.randrange(18, 26)):
            t[at] = f"n{at}"
        texts[i] = t
        if i % 10 == 9:  # like the copy before, far from the first text
            texts[i] = list(texts[i - 1])
            texts[i][1] = f"m{i}"
    name = {i: hashlib.md5(" ".join(t).encode()).digest() for i, t in {**texts, -1: base}.items()}
    body = spark.createDataFrame([(name[i], " ".join(t), 1) for i, t in {**texts, -1: base}.items()],
                                 "node binary, text string, n_chars int")
    family = spark.createDataFrame([(name[-1], name[i], name[i]) for i in texts], "first binary, node binary, label binary")
    got = {(bytes(r.a), bytes(r.b)) for r in near_dedup.possible_pairs(family, body, 0.8).collect()}
    sets = {i: Counter(tuple(t[k:k + 5]) for k in range(596)) for i, t in texts.items()}
    similar = {tuple(sorted((name[x], name[y]))) for x, y in combinations(texts, 2)
               if sum((sets[x] & sets[y]).values()) / sum((sets[x] | sets[y]).values()) >= 0.8}
    assert len(similar) >= 30 and similar <= got
    assert len(got) < 9000


def test_op9_base_and_verdict(spark, texts, labels):
    rows = by_id(QUERIES["op9_weak_quality"](spark, SF))
    for i, t in texts.items():
        w = WORD.findall(t or "")
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        n = Counter(tri)
        covered = {k + j for k, x in enumerate(tri) if n[x] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    judged = [(rows[r.doc_id], r.quality) for r in labels.collect() if not rows[r.doc_id].base_failed]
    assert sum(r.kept == (q == 1) for r, q in judged) / len(judged) > 0.95


def test_op9_em_matches_plain_em(documents):
    voted = quality_rules.votes(quality_rules.text_stats(documents))
    names = list(quality_rules.RULES)
    model = quality_rules.fit(voted, names, max_steps=5, tolerance=0)
    rows = [[r[f"v_{n}"] for n in names] for r in voted.collect()]
    floor = 1 - quality_rules.MAX_FALSE_ALARM
    pi, a, b = 0.8, [floor] * len(names), [0.5] * len(names)
    for _ in range(5):
        post = []
        for v in rows:
            z = math.log(pi / (1 - pi)) + sum(0 if x is None else math.log(a[j] / (1 - b[j]) if x else (1 - a[j]) / b[j])
                                              for j, x in enumerate(v))
            post.append(1 / (1 + math.exp(-z)))
        pi = min(0.99, max(0.01, sum(post) / len(rows)))
        for j in range(len(names)):
            seen = [(p, v[j]) for p, v in zip(post, rows) if v[j] is not None]
            a[j] = max(floor, (sum(p for p, x in seen if x == 1) + 1) / (sum(p for p, _ in seen) + 2))
            b[j] = (sum(1 - p for p, x in seen if x == 0) + 1) / (sum(1 - p for p, _ in seen) + 2)
    assert math.isclose(model["prior"], pi, rel_tol=1e-9)
    assert all(math.isclose(model["good"][n], a[j]) and math.isclose(model["bad"][n], b[j]) for j, n in enumerate(names))


def tiktoken_rows(texts):
    import public_tokenizers as P
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for i, t in texts:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    return out


def test_op10_as_tiktoken(spark, texts):
    rows = QUERIES["op10_byte_bpe"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(tiktoken_rows(texts.items()))


def test_pipeline_by_stages(spark, documents, labels, texts):
    """Each stage against a plain version over its own input."""
    import corpus_pipeline as cp
    from rollplane.llm.common import written
    docs, outs = documents, []
    for name, stage in cp.STAGES:
        got = written(stage(spark, docs, SF), name)
        outs.append((docs.collect(), got.collect()))
        if name != cp.STAGES[-1][0]:
            assert got.columns == documents.columns
        docs = got
    before, after = outs[0]
    quality = {r.doc_id: r.quality for r in labels.collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    judged = [i for i in quality]
    assert sum((i in gone) == (quality[i] == 0) for i in judged) / len(judged) > 0.95
    before, after = outs[1]
    last = {}
    for r in before:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(last.values())
    before, after = outs[2]
    assert sorted(r.doc_id for r in after) == sorted(set(classes_brute({r.doc_id: r.text for r in before}).values()))
    before, after = outs[3]
    copies = Counter(r.doc_id for r in after)
    words = lambda r: len(WORD.findall(r.text))
    taken, size = Counter(), Counter()
    for r in before:
        size[r.source] += words(r)
        taken[r.source] += words(r) * copies[r.doc_id]
    assert max(copies.values()) <= 2
    weight = dict(zip(sorted(size), [3, 1, 2] * len(size)))
    target, open_, total = {}, set(size), 1.5 * sum(size.values())
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if 2 * size[s] <= level * weight[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    longest = Counter()
    for r in before:
        longest[r.source] = max(longest[r.source], words(r))
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in size)
    before, after = outs[4]
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after)
    assert got == sorted(tiktoken_rows([(r.doc_id, r.text) for r in before]))


def test_op4_output_parses_back(spark):
    turns = [(1, 0, "user", "a<|turn|>b</s>"), (1, 1, "assistant", "x <\\s> y"), (1, 2, "assistant", ""), (2, None, None, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert chat.read_back(out[1].formatted) == [(r, t) for _, _, r, t in turns[:3]]
    assert chat.read_back(out[2].formatted) == [("", "")]
    assert [chat.unescape(out[1].formatted[s.start:s.end]) for s in out[1].spans] == ["x <\\s> y", ""]
