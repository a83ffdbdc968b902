"""Queries: grading and extraction jobs over the synthesised response table
F6 and over whole document texts (T1-T5, T9, T10, T13, T14, T16, T19, T26,
T27).  The SQL twins are built by small helpers that spell the same rules
in DuckDB's dialect (RE2 regexes, list lambdas)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..sources import fixtures as FX
from ..sources.fixtures import with_fixtures as W
from ..sources.tables import read_table
from .registry import r6, register

KEY = ("group_index", "idx_in_group")
PUNCT_SQL = TX.PUNCTUATION.replace("'", "''")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(translate(lower({x}), '{PUNCT_SQL}', ''), "
            f"'\\b(a|an|the)\\b', ' ', 'g'), '\\s+', ' ', 'g'))")


def words_sql(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def f1_cols_sql(pred: str, truth: str) -> str:
    """Columns pn, gn, p, g, common (to be used in a sub-select)."""
    return (f"{norm_sql(pred)} AS pn, {norm_sql(truth)} AS gn")


F1_FROM_PARTS = """
  CASE WHEN pred IS NULL OR ((pn IN ('yes','no','noanswer') OR gn IN ('yes','no','noanswer')) AND pn <> gn)
            OR common = 0 THEN 0.0 ELSE 2.0 * (common / len(p)) * (common / len(g)) / ((common / len(p)) + (common / len(g))) END"""


def f1_sql_subquery(src: str, pred: str, truth: str, keep: str) -> str:
    """SELECT keep, pred, pn, gn, p, g, common FROM src."""
    return f"""
SELECT {keep}, pred, pn, gn, p, g,
       coalesce(list_sum(list_transform(list_distinct(p), lambda w: least(len(list_filter(p, lambda x: x = w)),
                                                                      len(list_filter(g, lambda x: x = w))))), 0) AS common
FROM (SELECT {keep}, pred, pn, gn, {words_sql('pn')} AS p, {words_sql('gn')} AS g
      FROM (SELECT {keep}, {pred} AS pred, {norm_sql(pred)} AS pn, {norm_sql(truth)} AS gn FROM {src}) a) b"""


def dapo_norm_sql(x: str) -> str:
    e = f"string_split({x}, '=')[-1]"
    for before, after in TX.DAPO_SUBSTITUTIONS:
        e = f"replace({e}, {q(before)}, {q(after)})"
    for expr in TX.DAPO_REMOVED:
        e = f"replace({e}, {q(expr)}, '')"
    e = f"regexp_replace({e}, '(.*?)(\\$)(.*?)(\\$)(.*)', '$\\3$', 'g')"
    e = f"regexp_replace({e}, '(\\\\text\\{{)(.*?)(\\}})', '\\2', 'g')"
    e = f"regexp_replace({e}, '(\\\\textbf\\{{)(.*?)(\\}})', '\\2', 'g')"
    e = f"regexp_replace({e}, '(\\\\overline\\{{)(.*?)(\\}})', '\\2', 'g')"
    e = f"regexp_replace({e}, '(\\\\boxed\\{{)(.*)(\\}})', '\\2', 'g')"
    e = f"regexp_replace({e}, '(frac)([^{{])(.)', 'frac{{\\2}}{{\\3}}', 'g')"
    e = f"regexp_replace({e}, '(sqrt)([^{{])', 'sqrt{{\\2}}', 'g')"
    e = f"replace({e}, '$', '')"
    return e


def dapo_norm_final_sql(x: str) -> str:
    """digit-group commas + strip, applied to an already normalised alias."""
    return (f"{strip_sql(f'CASE WHEN regexp_matches(replace({x}, {q(',')}, {q('')}), {q('^[0-9]+$')}) '
                         f'THEN replace({x}, {q(',')}, {q('')}) ELSE {x} END')}")


ANSWER_SQL = "'(?i)Answer\\s*:\\s*([^\\n]+)'"
BOXED_RE = "'\\\\boxed\\{(?:[^{}]|\\{(?:[^{}]|\\{[^{}]*\\})*\\})*\\}'"


def last_boxed_sql(x: str) -> str:
    return f"regexp_extract_all({x}, {BOXED_RE})[-1]"


def boxed_content_sql(x: str) -> str:
    b = last_boxed_sql(x)
    return f"CASE WHEN {b} IS NOT NULL THEN substring({b}, 8, length({b}) - 8) END"


# T1 -------------------------------------------------------------------------
@register("f1_grade", W(f"""
SELECT group_index, idx_in_group,
       round({F1_FROM_PARTS}, 6) AS f1,
       round(CASE WHEN pred IS NULL OR ((pn IN ('yes','no','noanswer') OR gn IN ('yes','no','noanswer')) AND pn <> gn)
                       OR common = 0 THEN 0.0 ELSE common / len(p) END, 6) AS "precision",
       round(CASE WHEN pred IS NULL OR ((pn IN ('yes','no','noanswer') OR gn IN ('yes','no','noanswer')) AND pn <> gn)
                       OR common = 0 THEN 0.0 ELSE common / len(g) END, 6) AS recall
FROM ({f1_sql_subquery('graded', 'response', 'label', 'group_index, idx_in_group')}) c""", "graded"))
def q_f1_grade(spark, sf):
    g = FX.graded(spark, sf)
    f = TX.f1_grade("response", "label")
    return g.select(*KEY, r6(f["f1"]).alias("f1"), r6(f["precision"]).alias("precision"),
                    r6(f["recall"]).alias("recall"))


# T2 -------------------------------------------------------------------------
@register("exact_match", W(f"""
SELECT group_index, idx_in_group,
       CAST({norm_sql('response')} = {norm_sql('label')} OR {norm_sql('response')} = {norm_sql("'the ' || p_name")}
            AS INTEGER) AS em
FROM graded""", "graded"))
def q_exact_match(spark, sf):
    g = FX.graded(spark, sf)
    golden = F.array(F.col("label"), F.concat(F.lit("the "), F.col("p_name")))
    return g.select(*KEY, TX.exact_match("response", golden).alias("em"))


# T3 -------------------------------------------------------------------------
@register("last_boxed", W(f"""
SELECT group_index, idx_in_group, {last_boxed_sql('response')} AS boxed, {boxed_content_sql('response')} AS content
FROM graded""", "graded"))
def q_last_boxed(spark, sf):
    g = FX.graded(spark, sf)
    return g.select(*KEY, TX.last_boxed("response").alias("boxed"), TX.boxed_content("response").alias("content"))


# T4 -------------------------------------------------------------------------
@register("dapo_normalize", W(f"""
SELECT group_index, idx_in_group, {dapo_norm_final_sql('n')} AS normalized
FROM (SELECT group_index, idx_in_group, {dapo_norm_sql('response')} AS n FROM graded) x""", "graded"))
def q_dapo_normalize(spark, sf):
    g = FX.graded(spark, sf)
    return g.select(*KEY, TX.dapo_normalize("response").alias("normalized"))


# T5 -------------------------------------------------------------------------
@register("dapo_grade", W(f"""
SELECT group_index, idx_in_group, CAST(CASE WHEN pred = gt THEN 1.0 ELSE -1.0 END AS DOUBLE) AS score, pred = gt AS acc, pred
FROM (SELECT group_index, idx_in_group, {dapo_norm_final_sql('pn')} AS pred,
             CAST(CAST(trunc(TRY_CAST({dapo_norm_final_sql('gn')} AS DOUBLE)) AS BIGINT) AS VARCHAR) AS gt
      FROM (SELECT group_index, idx_in_group,
                   {dapo_norm_sql(f"coalesce(regexp_extract_all(right(response, 300), {ANSWER_SQL}, 1)[-1], '[INVALID]')")} AS pn,
                   {dapo_norm_sql('label')} AS gn
            FROM graded WHERE rm_type = 'dapo') a) b""", "graded"))
def q_dapo_grade(spark, sf):
    g = FX.graded(spark, sf).filter(F.col("rm_type") == "dapo")
    d = TX.dapo_grade("response", "label")
    return g.select(*KEY, d["score"].alias("score"), d["acc"].alias("acc"), d["pred"].alias("pred"))


# T9 -------------------------------------------------------------------------
LETTERS_SQL = "['A','B','C','D','E','F','G','H']"


def letter_sql(text: str) -> str:
    pats = [p.replace("'", "''") for p in TX.LETTER_PATTERNS]
    parts = []
    for p in pats:
        c = f"upper(regexp_extract({text}, '{p}', 1))"
        parts.append(f"CASE WHEN {c} <> '' AND list_contains({LETTERS_SQL}, {c}) THEN {c} END")
    fb = f"list_filter(regexp_extract_all({text}, '\\b([A-Z])\\b', 1), lambda c: list_contains({LETTERS_SQL}, c))"
    parts.append(f"CASE WHEN len({fb}) > 0 THEN {fb}[-1] END")
    return "coalesce(" + ", ".join(parts) + ")"


def choice_norm_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


CHOICE_SQL = f"""
SELECT group_index, idx_in_group,
       CAST(CASE WHEN response IS NULL THEN 0.0
            WHEN ext IS NOT NULL AND cl IS NOT NULL THEN CASE WHEN ext = cl THEN 1.0 ELSE 0.0 END
            WHEN {choice_norm_sql('lab')} <> '' AND instr(rn, {choice_norm_sql('lab')}) > 0 THEN 1.0
            WHEN ext IS NOT NULL AND cl IS NULL AND lab <> '' THEN CASE WHEN ext = upper(lab) THEN 1.0 ELSE 0.0 END
            ELSE 0.0 END AS DOUBLE) AS reward
FROM (SELECT *, CASE WHEN response IS NULL OR response = '' THEN NULL ELSE {letter_sql('st')} END AS ext,
             {choice_norm_sql('st')} AS rn
      FROM (SELECT *, string_split(coalesce(response, ''), '</think>')[-1] AS st, trim(label) AS lab,
                   CASE WHEN length(trim(label)) = 1 AND list_contains({LETTERS_SQL}, upper(trim(label)))
                        THEN upper(trim(label)) END AS cl
            FROM graded) a) b"""


@register("choice_grade", W(CHOICE_SQL, "graded"))
def q_choice_grade(spark, sf):
    g = FX.graded(spark, sf)
    return g.select(*KEY, TX.choice_grade("response", "label").alias("reward"))


# T10 ------------------------------------------------------------------------
_DISPATCH_CTES = f"""
, f1 AS ({f1_sql_subquery("(SELECT *, CASE WHEN rm_type = 'boxed_f1' THEN coalesce(" + boxed_content_sql('response') + ", '') ELSE response END AS r2 FROM graded WHERE rm_type IN ('f1', 'boxed_f1')) s", 'r2', 'label', 'group_index, idx_in_group')}),
ch AS ({CHOICE_SQL.replace('FROM graded)', "FROM graded WHERE rm_type = 'gpqa')")}),
dp AS (SELECT group_index, idx_in_group, CASE WHEN pred = gt THEN 1.0 ELSE -1.0 END AS reward
       FROM (SELECT group_index, idx_in_group, {dapo_norm_final_sql('pn')} AS pred,
                    CAST(CAST(trunc(TRY_CAST({dapo_norm_final_sql('gn')} AS DOUBLE)) AS BIGINT) AS VARCHAR) AS gt
             FROM (SELECT group_index, idx_in_group,
                          {dapo_norm_sql(f"coalesce(regexp_extract_all(right(response, 300), {ANSWER_SQL}, 1)[-1], '[INVALID]')")} AS pn,
                          {dapo_norm_sql('label')} AS gn
                   FROM graded WHERE rm_type = 'dapo') a) b)
"""
_DISPATCH_UNION = f"""SELECT group_index, idx_in_group, round({F1_FROM_PARTS}, 6) AS reward FROM f1
UNION ALL SELECT group_index, idx_in_group, round(reward, 6) FROM ch
UNION ALL SELECT group_index, idx_in_group, round(reward, 6) FROM dp"""


@register("grade_dispatch", W(_DISPATCH_CTES + _DISPATCH_UNION, "graded"))
def q_grade_dispatch(spark, sf):
    g = FX.graded(spark, sf)
    return TX.grade_table(g).select(*KEY, r6("reward").alias("reward"))


# T13 ------------------------------------------------------------------------
def _first_tag_pos(tag: str) -> str:
    return (f"CASE WHEN instr(response, '<{tag}>') > 0 AND "
            f"instr(substring(response, instr(response, '<{tag}>')), '</{tag}>') > 0 THEN instr(response, '<{tag}>') ELSE 0 END")


@register("extract_action", W(f"""
SELECT group_index, idx_in_group,
       CASE WHEN sp > 0 AND (ap = 0 OR sp < ap) THEN 'search' WHEN ap > 0 THEN 'answer' END AS action,
       {strip_sql("CASE WHEN sp > 0 AND (ap = 0 OR sp < ap) THEN regexp_extract(response, '(?s)<search>(.*?)</search>', 1) WHEN ap > 0 THEN regexp_extract(response, '(?s)<answer>(.*?)</answer>', 1) ELSE '' END")} AS content
FROM (SELECT *, {_first_tag_pos('search')} AS sp, {_first_tag_pos('answer')} AS ap FROM graded) x""", "graded"))
def q_extract_action(spark, sf):
    g = FX.graded(spark, sf)
    a = TX.extract_action("response")
    return g.select(*KEY, a["action"].alias("action"), a["content"].alias("content"))


# T14 ------------------------------------------------------------------------
@register("truncate_after_tag", W("""
SELECT group_index, idx_in_group,
       CASE WHEN instr(response, '</search>') > 0 THEN split_part(response, '</search>', 1) || '</search>'
            WHEN instr(response, '</answer>') > 0 THEN split_part(response, '</answer>', 1) || '</answer>'
            ELSE response END AS truncated
FROM graded""", "graded"))
def q_truncate_after_tag(spark, sf):
    g = FX.graded(spark, sf)
    return g.select(*KEY, TX.truncate_after_tag("response").alias("truncated"))


# T16 ------------------------------------------------------------------------
@register("tool_reward_shaping", W(f"""
SELECT group_index, idx_in_group,
       round(CASE WHEN s < 0 THEN least(-0.6, s + (kind - 2) / 2 * 0.1) ELSE s END, 6) AS score
FROM (SELECT *, CASE WHEN coalesce({boxed_content_sql('right(right(response, 300), 100)')} = label, false)
                     THEN 1.0 ELSE -1.0 END AS s FROM graded) x""", "graded"))
def q_tool_reward_shaping(spark, sf):
    g = FX.graded(spark, sf)
    s = TX.dapo_grade("response", "label", strict_box=True)["score"]
    return g.select(*KEY, r6(TX.tool_reward_shaping(s, F.col("kind"))).alias("score"))


# T19 ------------------------------------------------------------------------
@register("split_reasoning", W(f"""
SELECT group_index, idx_in_group,
       CASE WHEN ok THEN {strip_sql('parts[1]')} END AS reason, CASE WHEN ok THEN {strip_sql('parts[2]')} END AS answer
FROM (SELECT *, len(parts) = 2 AND parts[2] <> '' AS ok
      FROM (SELECT *, string_split(replace(response, '<|user|>', ''), '</think>') AS parts FROM graded) a) b""", "graded"))
def q_split_reasoning(spark, sf):
    g = FX.graded(spark, sf)
    s = TX.split_reasoning("response")
    return g.select(*KEY, s["reason"].alias("reason"), s["answer"].alias("answer"))


# T26 ------------------------------------------------------------------------
@register("sanitize_query", """
SELECT doc_id, md5(s) AS sanitized_md5, CAST(length(s) AS INTEGER) AS n_chars
FROM (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[^\\pL\\pN_\\s]', ' ', 'g'),
                                                                  '[\\t\\r\\f\\x0B\\n]', ' ', 'g'),
                                                   '\\s+', ' ', 'g'), '^ | $', '', 'g') AS s
      FROM documents) x""")
def q_sanitize_query(spark, sf):
    d = read_table(spark, sf, "documents")
    s = TX.sanitize_query("text")
    return d.select("doc_id", F.md5(s).alias("sanitized_md5"), F.length(s).alias("n_chars"))


# T27 ------------------------------------------------------------------------
@register("snippet_segments", f"""
SELECT doc_id, CAST(len(segs) AS INTEGER) AS n_segments, md5(array_to_string(segs, '|')) AS segments_md5
FROM (SELECT doc_id, list_filter(list_transform(string_split(text, '...'), lambda s: {strip_sql('s')}),
                                 lambda s: len(list_filter(regexp_split_to_array(s, '\\s+'), lambda w: w <> '')) > 5) AS segs
      FROM documents) x""")
def q_snippet_segments(spark, sf):
    d = read_table(spark, sf, "documents")
    s = TX.snippet_segments("text")
    return d.select("doc_id", F.size(s).alias("n_segments"), F.md5(F.array_join(s, "|")).alias("segments_md5"))


# C6 -------------------------------------------------------------------------
def _code_safety_sql(x: str) -> str:
    parts = [f"CASE WHEN regexp_matches({x}, {q('(?i)' + p)}) THEN {q('Code contains dangerous pattern: ' + p)} END"
             for p in TX.DANGEROUS_CODE_PATTERNS]
    allowed = "[" + ", ".join(q(m) for m in TX.ALLOWED_MODULES) + "]"
    mods = (f"list_concat(regexp_extract_all({x}, {q(r'import\s+(\w+)')}, 1), "
            f"regexp_extract_all({x}, {q(r'from\s+(\w+)')}, 1))")
    bad = f"list_filter({mods}, lambda m: NOT list_contains({allowed}, m))[1]"
    parts.append(f"CASE WHEN {bad} IS NOT NULL THEN 'Import of ''' || {bad} || ''' is not allowed' END")
    return "coalesce(" + ", ".join(parts) + ")"


@register("code_safety_filter", f"""
SELECT page_id, r IS NULL AS safe, coalesce(r, 'Code is safe') AS reason
FROM (SELECT page_id, {_code_safety_sql('html')} AS r FROM pages) x""")
def q_code_safety_filter(spark, sf):
    p = read_table(spark, sf, "pages").select("page_id", "html")
    return TX.code_safety_filter(p, "html").select("page_id", "safe", "reason")


# T11 ------------------------------------------------------------------------
_TAGSEQ_RE = "^<think></think>(<search></search><information></information><think></think>)*<answer></answer>$"


@register("search_format_valid", W(f"""
SELECT conv_id,
       coalesce(regexp_matches(transcript, '<\\|im_start\\|>assistant')
                AND regexp_matches(array_to_string(tags, ''), '{_TAGSEQ_RE}')
                AND len(list_filter(list_zip(tags, segs[1:len(tags)]),
                                    lambda p: p[1][2] <> '/' AND NOT regexp_matches(p[2], '^\\s*$'))) = 0
                AND regexp_matches(segs[-1], '^\\s*$'), false) AS valid
FROM (SELECT conv_id, transcript, regexp_extract_all(c, '{TX.SEARCH_TAG_RE}') AS tags,
             regexp_split_to_array(c, '{TX.SEARCH_TAG_RE}') AS segs
      FROM (SELECT conv_id, transcript,
                   regexp_extract(transcript, '(?s)<\\|im_start\\|>assistant\\s*(.*)', 1) AS c FROM transcripts) a) b""",
    "transcripts"))
def q_search_format_valid(spark, sf):
    t = FX.transcripts(spark, sf)
    return t.select("conv_id", TX.search_format_valid("transcript")["valid"].alias("valid"))


# T12 ------------------------------------------------------------------------
_SEARCH_PROMPT = ("<|im_start|>user\nAnswer inside <answer> and </answer>, for example <answer> Beijing </answer>."
                  "<|im_end|>\n")


def _gold_sql() -> str:
    return "CASE WHEN conv_id % 3 = 0 THEN ['nothing'] ELSE [t1] END"


@register("search_em_score", W(f"""
, v AS (SELECT conv_id, transcript,
               coalesce(regexp_matches(transcript, '<\\|im_start\\|>assistant')
                 AND regexp_matches(array_to_string(tags, ''), '{_TAGSEQ_RE}')
                 AND len(list_filter(list_zip(tags, segs[1:len(tags)]),
                                     lambda p: p[1][2] <> '/' AND NOT regexp_matches(p[2], '^\\s*$'))) = 0
                 AND regexp_matches(segs[-1], '^\\s*$'), false) AS valid
        FROM (SELECT conv_id, transcript, regexp_extract_all(c, '{TX.SEARCH_TAG_RE}') AS tags,
                     regexp_split_to_array(c, '{TX.SEARCH_TAG_RE}') AS segs
              FROM (SELECT conv_id, transcript,
                           regexp_extract(transcript, '(?s)<\\|im_start\\|>assistant\\s*(.*)', 1) AS c FROM transcripts) a) b),
g AS (SELECT conv_id, coalesce(max(CASE WHEN turn = 1 THEN text END), '') AS t1 FROM conversations GROUP BY conv_id),
x AS (SELECT v.conv_id, v.valid, {q(_SEARCH_PROMPT)} || v.transcript AS sol,
             list_transform({_gold_sql()}, lambda a: {norm_sql('a')}) AS gold
      FROM v JOIN g USING (conv_id)),
y AS (SELECT *, list_transform(regexp_extract_all(sol, '(?s)<answer>(.*?)</answer>', 1), lambda s: {strip_sql('s')}) AS answers,
             list_transform(list_transform(regexp_extract_all(sol, '(?s)<information>(.*?)</information>', 1),
                                           lambda s: {strip_sql('s')}), lambda s: {norm_sql('s')}) AS info
      FROM x),
z AS (SELECT *, CASE WHEN len(answers) >= 2 THEN answers[-1] END AS answer,
             valid AND len(list_filter(info, lambda b: len(list_filter(gold, lambda gg: instr(b, gg) > 0)) > 0)) > 0 AS retrieved
      FROM y)
SELECT conv_id,
       round(CAST(CASE WHEN answer IS NULL THEN CASE WHEN valid THEN CASE WHEN retrieved THEN 0.3 ELSE 0.2 END ELSE 0.0 END
                       WHEN list_contains(gold, {norm_sql('answer')}) THEN CASE WHEN valid THEN 1.0 ELSE 0.8 END
                       WHEN valid THEN CASE WHEN retrieved THEN 0.3 ELSE 0.2 END
                       ELSE 0.1 END AS DOUBLE), 6) AS score
FROM z""", "transcripts"))
def q_search_em_score(spark, sf):
    t = FX.transcripts(spark, sf)
    c = read_table(spark, sf, "conversations")
    g = c.groupBy("conv_id").agg(F.coalesce(F.max(F.when(F.col("turn") == 1, F.col("text"))), F.lit("")).alias("t1"))
    j = t.join(g, "conv_id")
    gold = F.when(F.col("conv_id") % 3 == 0, F.array(F.lit("nothing"))).otherwise(F.array(F.col("t1")))
    sol = F.concat(F.lit(_SEARCH_PROMPT), F.col("transcript"))
    return j.select("conv_id", r6(TX.search_em_score(sol, gold)).alias("score"))


# D11 ------------------------------------------------------------------------
@register("recompute_rewards", W(_DISPATCH_CTES + f"""
, disp AS ({_DISPATCH_UNION}),
fa AS ({f1_sql_subquery('graded', 'response', 'label', 'group_index, idx_in_group')})
SELECT d.group_index, d.idx_in_group, d.reward AS old_reward, round({F1_FROM_PARTS}, 6) AS new_reward,
       d.reward <> round({F1_FROM_PARTS}, 6) AS changed
FROM disp d JOIN fa ON d.group_index = fa.group_index AND d.idx_in_group = fa.idx_in_group""", "graded"))
def q_recompute_rewards(spark, sf):
    g = FX.graded(spark, sf)
    old = TX.grade_table(g, out_col="old_reward")
    new = old.withColumn("new_reward", r6(TX.f1_grade("response", "label")["f1"]))
    return new.select(*KEY, r6("old_reward").alias("old_reward"), "new_reward",
                      (r6("old_reward") != F.col("new_reward")).alias("changed"))


# T6 -------------------------------------------------------------------------
@register("mathd_grade")
def q_mathd_grade(spark, sf):
    """Boxed (or raw) answer vs label under mathd normalisation; no SQL twin
    (the normalisation is a sequence of split/rebuild steps), pinned by
    goldens in tests/test_goldens.py."""
    g = FX.graded(spark, sf)
    given = F.coalesce(TX.boxed_content("response"), F.col("response"))
    return g.select(*KEY, TX.mathd_normalize(given).alias("normalized"),
                    TX.mathd_grade(given, "label").alias("reward"))


# T8 -------------------------------------------------------------------------
@register("deepscaler_grade")
def q_deepscaler_grade(spark, sf):
    g = FX.graded(spark, sf)
    return g.select(*KEY, TX.deepscaler_grade("response", "label").alias("reward"))
