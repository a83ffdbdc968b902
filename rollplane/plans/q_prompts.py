"""Queries: prompt sources, prompt/chat projections (A1, A2, B*), loss
masks and spans (T21-T24), packing (G15-G18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..operators import packing as PK, prompts as P
from ..sources import fixtures as FX, io
from ..sources.fixtures import with_fixtures as W
from ..sources.tables import read_table
from .registry import r6, register

MSG = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
WORDS = r"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def words_sql(x: str) -> str:
    return WORDS.format(x=x)


# A1 -------------------------------------------------------------------------
@register("read_prompts", f"""
SELECT doc_id, lang, CAST(len({words_sql('text')}) AS INTEGER) AS n_words FROM documents""")
def q_read_prompts(spark, sf):
    df = io.read_prompts(spark, f"{sf}/documents.parquet")
    return df.select("doc_id", "lang", P.token_count("text").alias("n_words"))


# A2 -------------------------------------------------------------------------
@register("row_slice", """
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
WHERE i >= 100 AND i < n - 100""")
def q_row_slice(spark, sf):
    df = io.read_prompts(spark, f"{sf}/documents.parquet@[100:-100]", order_cols=["doc_id"])
    return df.select("doc_id")


# B1 -------------------------------------------------------------------------
@register("build_prompt_rows", W("""
SELECT question_id, label, lang AS md_lang, source AS md_source, CAST(2 AS INTEGER) AS md_size FROM prompts""", "prompts"))
def q_build_prompt_rows(spark, sf):
    p = P.build_prompt_rows(FX.prompts(spark, sf), prompt_key="prompt", label_key="label", metadata_key=None,
                            id_col="question_id", metadata_cols=("lang", "source"))
    return p.select("question_id", "label", F.col("metadata")["lang"].alias("md_lang"),
                    F.col("metadata")["source"].alias("md_source"), F.size("metadata").alias("md_size"))


# B2 -------------------------------------------------------------------------
@register("multimodal_parts", W("""
SELECT question_id, CAST(CASE WHEN source = 'src0' THEN 2 ELSE 1 END AS INTEGER) AS n_parts FROM prompts""", "prompts"))
def q_multimodal_parts(spark, sf):
    p = FX.prompts(spark, sf)
    img = F.when(F.col("source") == "src0", F.concat(F.lit("img/"), F.col("question_id").cast("string"), F.lit(".png")))
    return p.select("question_id", F.size(P.multimodal_parts("prompt", {"image": img})).alias("n_parts"))


# B3 -------------------------------------------------------------------------
@register("render_chat", W(f"""
SELECT conv_id, md5(string_agg({MSG}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10)) AS rendered_md5,
       CAST(length(string_agg({MSG}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10)) AS INTEGER) AS n_chars
FROM chat GROUP BY conv_id""", "chat"))
def q_render_chat(spark, sf):
    r = P.render_chat(FX.chat(spark, sf))
    return r.select("conv_id", F.md5("rendered").alias("rendered_md5"), F.length("rendered").alias("n_chars"))


# B5 -------------------------------------------------------------------------
@register("prompt_len_filter", W(f"""
SELECT question_id FROM prompts WHERE len({words_sql('prompt')}) <= 300""", "prompts"))
def q_prompt_len_filter(spark, sf):
    return P.prompt_len_filter(FX.prompts(spark, sf), max_length=300).select("question_id")


# B6 -------------------------------------------------------------------------
@register("map_roles", """
SELECT conv_id, turn, role FROM conversations""")
def q_map_roles(spark, sf):
    c = FX.chat(spark, sf)
    raw = c.select("conv_id", "turn", F.when(F.col("role") == "user", "human")
                   .when(F.col("role") == "assistant", "gpt").otherwise(F.col("role")).alias("from"))
    return raw.select("conv_id", "turn", P.map_role("from").alias("role"))


# B7 -------------------------------------------------------------------------
@register("extract_nested", W("""
SELECT question_id, CAST(length(prompt) AS INTEGER) AS content_len, label AS ground_truth FROM prompts""", "prompts"))
def q_extract_nested(spark, sf):
    p = FX.prompts(spark, sf)
    nested = p.select("question_id",
                      F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("prompt"),
                      F.struct(F.col("label").alias("ground_truth")).alias("reward_model"))
    return nested.select("question_id", F.length(F.get("prompt", 0)["content"]).alias("content_len"),
                         F.col("reward_model.ground_truth").alias("ground_truth"))


# B8 -------------------------------------------------------------------------
@register("add_question_id", """
SELECT doc_id, 'docs__' || CAST(doc_id AS VARCHAR) AS qid,
       'docs__idx' || CAST(row_number() OVER (ORDER BY lang, doc_id) - 1 AS VARCHAR) AS qid_idx
FROM documents""")
def q_add_question_id(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "lang")
    a = P.add_question_id(d, "docs", id_col="doc_id", out_col="qid")
    b = P.add_question_id(a, "docs", order_cols=["lang", "doc_id"], out_col="qid_idx")
    return b.select("doc_id", "qid", "qid_idx")


# B11 ------------------------------------------------------------------------
@register("reward_select", W("""
SELECT group_index, idx_in_group, 2 * reward - 1 AS reward_value FROM samples""", "samples"))
def q_reward_select(spark, sf):
    s = FX.samples(spark, sf)
    rm = F.create_map(F.lit("score"), F.col("reward") * 2 - 1, F.lit("acc"), F.col("reward"))
    return s.select("group_index", "idx_in_group", P.reward_select("reward", rm, "score").alias("reward_value"))


# B12 ------------------------------------------------------------------------
@register("effective_len", W("""
SELECT group_index, idx_in_group, CAST(sum(m) AS BIGINT) AS effective_len FROM tok GROUP BY group_index, idx_in_group""",
    "tok"))
def q_effective_len(spark, sf):
    from ..operators.metrics import effective_length
    t = FX.token_rows(spark, sf)
    return t.select("group_index", "idx_in_group", effective_length("loss_mask").alias("effective_len"))


# B13 ------------------------------------------------------------------------
@register("default_loss_mask", W("""
SELECT group_index, idx_in_group, CAST(response_length AS INTEGER) AS mask_len, CAST(response_length AS INTEGER) AS mask_sum
FROM samples""", "samples"))
def q_default_loss_mask(spark, sf):
    s = FX.samples(spark, sf).withColumn("loss_mask", F.lit(None).cast("array<int>"))
    m = P.default_loss_mask("loss_mask", "response_length")
    return s.select("group_index", "idx_in_group", F.size(m).alias("mask_len"),
                    F.aggregate(m, F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# B14 ------------------------------------------------------------------------
@register("to_train_columns", W("""
SELECT group_index, idx_in_group, round(reward - avg(reward) OVER (PARTITION BY group_index), 6) AS rewards,
       CASE WHEN status = 'truncated' THEN 1.5 ELSE reward END AS raw_reward,
       CASE WHEN status = 'truncated' THEN 1 ELSE 0 END AS truncated,
       CAST(list_sum(loss_mask) AS INTEGER) AS mask_sum
FROM token_rows""", "token_rows"))
def q_to_train_columns(spark, sf):
    from ..operators import groups as G
    t = FX.token_rows(spark, sf)
    t = G.group_norm_rewards(t, group_cols=("group_index",), estimator="reinforce_plus_plus_baseline", out_col="norm")
    md = F.when(F.col("status") == "truncated", F.create_map(F.lit("raw_reward"), F.lit("1.5"))) \
          .otherwise(F.create_map().cast("map<string,string>"))
    tr = P.to_train_columns(t.withColumn("metadata", md), reward=F.col("norm"), metadata_col="metadata")
    return tr.select("group_index", "idx_in_group", r6("rewards").alias("rewards"), "raw_reward", "truncated",
                     F.aggregate("loss_masks", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# B15 ------------------------------------------------------------------------
@register("replicate_samples", W("""
SELECT question_id, gi AS group_index, CAST(gi * 4 + j AS BIGINT) AS "index", CAST(j AS BIGINT) AS sample_in_group
FROM (SELECT question_id, row_number() OVER (ORDER BY question_id) - 1 AS gi FROM prompts) p,
     (SELECT unnest(range(4)) AS j) r""", "prompts"))
def q_replicate_samples(spark, sf):
    from .ranking import global_index
    p = global_index(FX.prompts(spark, sf).select("question_id"), ["question_id"], "group_index")
    r = P.replicate_samples(p, 4)
    return r.select("question_id", "group_index", "index", "sample_in_group")


# B17 ------------------------------------------------------------------------
@register("inject_metadata", W("""
SELECT question_id, CASE WHEN source = 'src0' THEN 'xx' ELSE lang END AS md_lang, 'f1' AS md_rm_type,
       CAST(3 AS INTEGER) AS md_size
FROM prompts""", "prompts"))
def q_inject_metadata(spark, sf):
    p = FX.prompts(spark, sf)
    md = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    ov = F.when(F.col("source") == "src0", F.create_map(F.lit("lang"), F.lit("xx"))) \
          .otherwise(F.create_map().cast("map<string,string>"))
    m = P.inject_metadata(md, F.lit("f1"), ov)
    return p.select("question_id", m["lang"].alias("md_lang"), m["rm_type"].alias("md_rm_type"),
                    F.size(m).alias("md_size"))


# B18 ------------------------------------------------------------------------
@register("finish_to_status", W("""
SELECT uid, CASE WHEN finish_reason = 'length' THEN 'truncated' WHEN finish_reason = 'abort' THEN 'aborted'
                 ELSE 'completed' END AS status,
       CASE WHEN finish_reason = 'length' THEN 'truncated' ELSE 'completed' END AS buffer_status
FROM buffer_items""", "buffer_items"))
def q_finish_to_status(spark, sf):
    b = FX.buffer_items(spark, sf)
    return b.select("uid", P.finish_to_status("finish_reason").alias("status"),
                    P.finish_to_status("finish_reason", buffer_variant=True).alias("buffer_status"))


# B19 ------------------------------------------------------------------------
@register("candidate_prompt", W("""
SELECT conv_id, md5(string_agg('Solution ' || CAST(i AS VARCHAR) || ':' || chr(10) || text, chr(10) || chr(10) ORDER BY turn))
       AS prompt_md5, CAST(count(*) AS INTEGER) AS n_candidates
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM chat WHERE role = 'assistant') a
GROUP BY conv_id""", "chat"))
def q_candidate_prompt(spark, sf):
    c = FX.chat(spark, sf).filter(F.col("role") == "assistant")
    m = P.collect_messages(c, fields=("text",))
    cands = F.transform("messages", lambda e: e["text"])
    return m.select("conv_id", F.md5(P.numbered_join(cands, "Solution {i}:\n{x}")).alias("prompt_md5"),
                    F.size("messages").alias("n_candidates"))


# B21 ------------------------------------------------------------------------
@register("round_number", W("""
SELECT conv_id, CAST(count(*) FILTER (WHERE role = 'assistant') AS INTEGER) AS round_number FROM chat GROUP BY conv_id""",
    "chat"))
def q_round_number(spark, sf):
    m = P.collect_messages(FX.chat(spark, sf))
    return m.select("conv_id", P.round_number("messages").alias("round_number"))


# B22 ------------------------------------------------------------------------
@register("append_turns", W(f"""
SELECT conv_id, CAST(sum(len({words_sql('text')})) AS INTEGER) AS n_tokens,
       CAST(sum(CASE WHEN role = 'assistant' THEN len({words_sql('text')}) ELSE 0 END) AS INTEGER) AS mask_sum,
       round(sum(CASE WHEN role = 'assistant' THEN list_sum(list_transform({words_sql('text')}, lambda w: -length(w) / 8)) ELSE 0 END), 6) AS log_prob_sum
FROM chat GROUP BY conv_id""", "chat"))
def q_append_turns(spark, sf):
    """Model tokens carry a log-prob of minus an eighth of their length."""
    c = FX.chat(spark, sf).withColumnRenamed("text", "content")
    c = c.withColumn("log_probs", F.transform(P.word_tokens("content"), lambda w: -F.length(w) / 8))
    m = P.collect_messages(c, fields=("role", "content", "log_probs"))
    r = m.select("conv_id", P.append_turns("messages", log_probs=True).alias("r"))
    return r.select("conv_id", F.size("r.tokens").alias("n_tokens"),
                    F.aggregate("r.loss_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                    r6(F.aggregate("r.log_probs", F.lit(0.0), lambda a, x: a + x)).alias("log_prob_sum"))


# B23 ------------------------------------------------------------------------
@register("remaining_budget", W("""
SELECT group_index, idx_in_group, 50 - response_length AS budget, response_length = 50 AS truncated FROM samples""",
    "samples"))
def q_remaining_budget(spark, sf):
    s = FX.samples(spark, sf)
    b = P.remaining_budget(F.lit(50).cast("bigint"), F.col("response_length") + 10, F.lit(10).cast("bigint"))
    return s.select("group_index", "idx_in_group", b.alias("budget"), (b == 0).alias("truncated"))


# T21 ------------------------------------------------------------------------
_MASK_SQL = """
, mm AS (SELECT conv_id, turn, role, step_loss_mask, words, len(words) AS n,
                coalesce(sum(len(words)) OVER (PARTITION BY conv_id ORDER BY turn
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o,
                role = 'assistant' AND step_loss_mask = 1 AND len(words) >= 2 AS on_
         FROM chat_msgs)
"""


def _chat_mask(spark, sf):
    c = FX.chat(spark, sf).withColumnRenamed("text", "content")
    m = P.collect_messages(c, fields=("role", "content", "step_loss_mask"))
    return m.select("conv_id", P.chat_loss_mask("messages").alias("cm"))


@register("chat_loss_mask", W(_MASK_SQL + """
SELECT conv_id, CAST(sum(n) AS INTEGER) AS n_tokens,
       CAST(sum(CASE WHEN on_ THEN n - 1 ELSE 0 END) AS INTEGER) AS mask_sum,
       CAST(sum(CASE WHEN on_ THEN (n - 1) * (2 * o + n + 2) / 2 ELSE 0 END) AS BIGINT) AS mask_wsum
FROM mm GROUP BY conv_id""", "chat_msgs"))
def q_chat_loss_mask(spark, sf):
    m = _chat_mask(spark, sf)
    mask = F.col("cm.loss_mask")
    return m.select("conv_id", F.size("cm.tokens").alias("n_tokens"),
                    F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                    F.aggregate(F.transform(mask, lambda x, i: (x * (i + 1)).cast("bigint")), F.lit(0).cast("bigint"),
                                lambda a, x: a + x).alias("mask_wsum"))


# T22 ------------------------------------------------------------------------
@register("response_span", W(_MASK_SQL + """
SELECT conv_id, CAST(coalesce(sum(n) - min(CASE WHEN on_ THEN o + 1 END), 0) AS BIGINT) AS response_length,
       CAST(sum(CASE WHEN on_ THEN n - 1 ELSE 0 END) AS INTEGER) AS mask_sum
FROM mm GROUP BY conv_id""", "chat_msgs"))
def q_response_span(spark, sf):
    m = _chat_mask(spark, sf)
    rs = P.response_span("cm.loss_mask")
    return m.select("conv_id", rs["response_length"].alias("response_length"),
                    F.aggregate(rs["loss_mask"], F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# T23 ------------------------------------------------------------------------
@register("mask_text_spans", W(_MASK_SQL + """
SELECT conv_id, CAST(count(*) FILTER (WHERE on_) AS INTEGER) AS n_spans,
       coalesce(md5(string_agg(CASE WHEN on_ THEN array_to_string(list_slice(words, 2, n), ' ') END, '|' ORDER BY turn)),
                md5('')) AS spans_md5
FROM mm GROUP BY conv_id""", "chat_msgs"))
def q_mask_text_spans(spark, sf):
    m = _chat_mask(spark, sf)
    sp = P.mask_text_spans("cm.tokens", "cm.loss_mask")
    return m.select("conv_id", F.size(sp).alias("n_spans"), F.md5(F.array_join(sp, "|")).alias("spans_md5"))


# T24 ------------------------------------------------------------------------
@register("find_sublist", W(_MASK_SQL + """
SELECT conv_id, CAST(count(*) FILTER (WHERE role = 'assistant') AS INTEGER) AS n_found,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN o END), 0) AS BIGINT) AS pos_sum
FROM mm GROUP BY conv_id""", "chat_msgs"))
def q_find_sublist(spark, sf):
    m = _chat_mask(spark, sf)
    pos = P.find_sublist("cm.tokens", F.array(F.lit("<|im_start|>assistant")))
    return m.select("conv_id", F.size(pos).alias("n_found"),
                    F.aggregate(pos, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pos_sum"))


# G15 ------------------------------------------------------------------------
def _packs(spark, sf):
    t = FX.token_rows(spark, sf)
    return PK.pack_sequences(t, part_cols=["group_index"], order_col="idx_in_group", tokens="tokens",
                             loss_mask="loss_mask", per_token=["log_probs"], per_sample=["reward", "response_length"])


@register("pack_sequences", W("""
SELECT group_index, CAST(count(*) AS INTEGER) AS n_seqs, CAST(sum(response_length) AS INTEGER) AS total_len,
       '0,' || string_agg(CAST(cu AS VARCHAR), ',' ORDER BY idx_in_group) AS cu_seqlens,
       CAST(sum(list_sum(loss_mask)) AS INTEGER) AS mask_sum,
       CAST(sum(response_length * (response_length - 1) / 2) AS INTEGER) AS pos_sum
FROM (SELECT *, sum(response_length) OVER (PARTITION BY group_index ORDER BY idx_in_group) AS cu FROM token_rows) x
GROUP BY group_index""", "token_rows"))
def q_pack_sequences(spark, sf):
    pk = _packs(spark, sf)
    return pk.select("group_index", F.size("members").alias("n_seqs"), F.size("tokens").alias("total_len"),
                     F.array_join("cu_seqlens", ",").alias("cu_seqlens"),
                     F.aggregate("loss_masks", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                     F.aggregate("position_ids", F.lit(0), lambda a, x: a + x).alias("pos_sum"))


# G16 ------------------------------------------------------------------------
@register("unpack_sequences", W("""
SELECT group_index, idx_in_group AS member, CAST(sum(tk) AS BIGINT) AS tok_sum, CAST(sum(tk * (t + 1)) AS BIGINT) AS tok_wsum,
       CAST(sum(m) AS INTEGER) AS mask_sum, response_length, round(sum(lp), 6) AS lp_sum
FROM tok GROUP BY group_index, idx_in_group, response_length""", "tok"))
def q_unpack_sequences(spark, sf):
    u = PK.unpack_sequences(_packs(spark, sf), part_cols=["group_index"], per_token=["log_probs"])
    tk = F.col("tokens")
    return u.select("group_index", "member",
                    F.aggregate(tk, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tok_sum"),
                    F.aggregate(F.transform(tk, lambda x, i: (x * (i + 1)).cast("bigint")), F.lit(0).cast("bigint"),
                                lambda a, x: a + x).alias("tok_wsum"),
                    F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                    "response_length", r6(A.asum("log_probs")).alias("lp_sum"))


# G17 ------------------------------------------------------------------------
@register("pad_to_multiple", W("""
SELECT group_index, CAST(((sum(response_length) + 63) // 64) * 64 AS INTEGER) AS padded_len,
       CAST(((sum(response_length) + 63) // 64) * 64 - sum(response_length) AS INTEGER) AS pad_length,
       CAST(((sum(response_length) + 63) // 64) * 64 AS INTEGER) AS last_cu
FROM token_rows GROUP BY group_index""", "token_rows"))
def q_pad_to_multiple(spark, sf):
    p = PK.pad_to_multiple(_packs(spark, sf), 64)
    return p.select("group_index", F.size("tokens").alias("padded_len"), F.col("pad_length").cast("int"),
                    F.element_at("cu_seqlens", -1).alias("last_cu"))


# G18 ------------------------------------------------------------------------
@register("zigzag_shard", W("""
, c AS (SELECT group_index, idx_in_group, response_length, CAST(ceil(response_length / 4.0) AS BIGINT) AS ch FROM token_rows),
r AS (SELECT c.*, unnest([0, 1]) AS cp_rank FROM c),
s AS (SELECT tok.group_index, tok.idx_in_group, CASE WHEN t // c.ch < 2 THEN t // c.ch ELSE 3 - t // c.ch END AS cp_rank,
             sum(tk) AS tsum
      FROM tok JOIN c USING (group_index, idx_in_group) GROUP BY ALL)
SELECT r.group_index, r.idx_in_group, CAST(r.cp_rank AS INTEGER) AS cp_rank, CAST(2 * r.ch AS INTEGER) AS shard_len,
       CAST(coalesce(s.tsum, 0) AS BIGINT) AS shard_sum
FROM r LEFT JOIN s USING (group_index, idx_in_group, cp_rank)""", "tok"))
def q_zigzag_shard(spark, sf):
    t = FX.token_rows(spark, sf)
    z = PK.zigzag_shard(t, tokens="tokens", cp_size=2, keep=["group_index", "idx_in_group"])
    return z.select("group_index", "idx_in_group", "cp_rank", F.size("shard").alias("shard_len"),
                    F.aggregate("shard", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("shard_sum"))


def _offsets_sql(i: int, number: str) -> str:
    lo, hi = f"greatest({number} * ch, total - response_length - 1)", f"least(({number} + 1) * ch, total - 1)"
    at = lambda x: f"CAST(CASE WHEN {lo} < {hi} THEN {x} ELSE 0 END AS INTEGER)"
    return (f"CAST({number} * ch AS INTEGER) AS chunk{i}_start, CAST(({number} + 1) * ch AS INTEGER) AS chunk{i}_end, "
            f"{at(lo)} AS logits{i}_start, {at(hi)} AS logits{i}_end, {at(lo + ' + 1')} AS tokens{i}_start, {at(hi + ' + 1')} AS tokens{i}_end")


# prompts of 3 + idx_in_group tokens before each response
@register("zigzag_offsets", W(f"""
, c AS (SELECT group_index, idx_in_group, response_length, response_length + 3 + idx_in_group AS total FROM token_rows),
r AS (SELECT *, (total + 5) // 6 AS ch, unnest([0, 1, 2]) AS k FROM c)
SELECT group_index, idx_in_group, CAST(k AS INTEGER) AS cp_rank, CAST(ch AS INTEGER) AS chunk_len,
       {_offsets_sql(0, 'k')}, {_offsets_sql(1, '(5 - k)')} FROM r""", "tok"))
def q_zigzag_offsets(spark, sf):
    t = FX.token_rows(spark, sf).withColumn("total", F.col("response_length") + 3 + F.col("idx_in_group"))
    return PK.zigzag_offsets(t, total_length="total", response_length="response_length", cp_size=3, keep=["group_index", "idx_in_group"])


@register("zigzag_gather", W("""
SELECT group_index, idx_in_group, md5(string_agg(CAST(tk AS VARCHAR), ',' ORDER BY t)) AS tokens_md5, CAST(count(*) AS INTEGER) AS n_tokens
FROM tok GROUP BY group_index, idx_in_group""", "tok"))
def q_zigzag_gather(spark, sf):
    """Shards put together again are the sequence."""
    t = FX.token_rows(spark, sf).withColumn("n", F.size("tokens"))
    z = PK.zigzag_shard(t, tokens="tokens", cp_size=2, keep=["group_index", "idx_in_group", "n"])
    g = PK.zigzag_gather(z, keys=["group_index", "idx_in_group"], cp_size=2, total_len="n")
    return g.select("group_index", "idx_in_group", F.md5(F.array_join("tokens", ",")).alias("tokens_md5"), F.size("tokens").alias("n_tokens"))
