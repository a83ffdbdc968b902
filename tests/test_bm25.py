"""Block-pruned BM25 against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from rollplane.operators import bm25 as B


def brute(queries, docs, k, k1=0.9, b=0.4):
    toks = {i: re.findall(r"[^\W_]+", t.lower()) if t is not None else None for i, t in docs}
    lens = [len(t) for t in toks.values() if t is not None]
    mean = sum(lens) / len(lens)
    df = Counter(w for t in toks.values() for w in set(t or ()))
    want = {}
    for q, text in queries:
        want.setdefault(q, set()).update(re.findall(r"[^\W_]+", (text or "").lower()))
    out = []
    for q, terms in want.items():
        scores = []
        for i, t in toks.items():
            tf = Counter(t or ())
            s = sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / mean))
                    for w in terms if tf[w])
            if s > 0:
                scores.append((-math.floor(s * 1e6 + 0.5), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def data(seed):
    rnd = random.Random(seed)
    vocab = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", "!"]) for _ in range(rnd.randint(0, n)))
    docs = [(i, text(40)) for i in range(400)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(30)] + [(2000, None), (2001, ""), (2002, "Ünï w1 W1")]
    queries = [(i, text(6)) for i in range(40)] + [(50, ""), (51, None), (52, "nowhere"), (53, "w1 w1"), (53, "w2"), (54, "W1 ünï")]
    return docs, queries


@pytest.mark.parametrize("k, block, chunk", [(3, 16, 10**6), (1, 7, 10**6), (50, 64, 40), (1000, 1, 10**6)])
def test_equals_scoring_everything(spark, k, block, chunk):
    docs, queries = data(k)
    d = spark.createDataFrame(docs, "id long, body string").repartition(5)
    q = spark.createDataFrame(queries, "qid long, text string")
    index = B.write_index(B.bm25_index(d, d_id="id", text="body", block_docs=block))
    rows = B.bm25_search(q, index, k, q_id="qid", q_text="text", d_id="id", chunk_terms=chunk).collect()
    got = sorted((r.qid, r["rank"], r.id, math.floor(r.score * 1e6 + 0.5)) for r in rows)
    assert got == brute(queries, docs, k)


def test_text_ids_and_no_rows(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "id string, body string")
    q = spark.createDataFrame([("q", "x")], "qid string, text string")
    index = B.bm25_index(d, d_id="id", text="body")
    rows = B.bm25_search(q, index, 2, q_id="qid", q_text="text", d_id="id").collect()
    assert [(r.qid, r["rank"], r.id) for r in rows] == [("q", 1, "a"), ("q", 2, "b")]
    for qs, ds in ((q.limit(0), d), (q, d.limit(0)), (q, d.selectExpr("id", "cast(null as string) body"))):
        assert B.bm25_search(qs, B.bm25_index(ds, d_id="id", text="body"), 2, q_id="qid", q_text="text", d_id="id").count() == 0


def test_blocks_without_a_chance_are_not_scored(spark, monkeypatch):
    docs = [(i, "common filler text here") for i in range(640)] + [(9000 + i, "common rare word") for i in range(3)]
    index = B.bm25_index(spark.createDataFrame(docs, "id long, body string").coalesce(1), d_id="id", text="body", block_docs=32).collect()
    import pyarrow as pa
    import numpy as np
    kind = pa.schema([("docs", pa.list_(pa.int64())), ("len", pa.list_(pa.int32())), ("n_null", pa.int32()), ("terms", pa.list_(pa.string())),
                      ("start", pa.list_(pa.int32())), ("doc", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in index], schema=kind)
    words = pa.array(["common", "rare"])
    chunk = (words, np.array([0, 1]), np.array([0, 2]), np.array([0.001, 5.0]), 0.9, 0.4, 4.0)
    s, scored = B._Scorer(chunk, 3, np.array([1_000_000])), []
    monkeypatch.setattr(B._Scorer, "score", lambda self, block, q, place: scored.append(block))
    for block in B._blocks([batch], words):
        s.visit(block, lambda bound: B._micro(bound + 1e-9) >= s.floor)
    assert len(index) == 21 and len(scored) == 1


def test_a_task_reads_the_index_in_small_pieces(spark):
    import pyarrow.parquet as pq
    docs = spark.range(0, 6000, 1, 1).selectExpr("id", "concat_ws(' ', transform(sequence(1, 40), x -> concat('w', (id * x) % 997))) body")
    index = B.write_index(B.bm25_index(docs, d_id="id", text="body"))
    files = [pq.ParquetFile(f.replace("file:", "")) for f in index.inputFiles()]
    assert max(f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) <= B.ROW_GROUP_BLOCKS
    assert sum(len(r.docs) for r in index.select("docs").collect()) == 6000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20


def test_long_documents_make_small_blocks(spark):
    words = B.BLOCK_WORDS // 2 + 1
    docs = spark.range(0, 5, 1, 1).selectExpr("id", f"concat_ws(' ', transform(sequence(1, {words}), x -> concat('w', x % 50))) body")
    sizes = [len(r.docs) for r in B.bm25_index(docs, d_id="id", text="body").collect()]
    assert sizes == [1] * 5
