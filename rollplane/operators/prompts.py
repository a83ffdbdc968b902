"""Prompt and chat operators (B*), loss masks and spans.

Text tokenisation is pluggable: the default ``word_tokens`` splits on
whitespace with a native expression (so counts match SQL engines);
a real vocabulary can be supplied as a ``Column -> Column`` function.
Chat rendering uses one fixed ChatML family instead of a model's own
template (no tokenizer files exist offline).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.ranking import global_index

Tokenizer = Callable[[Column], Column]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def word_tokens(text: Column | str) -> Column:
    """Default tokenizer: whitespace-separated words (array<string>)."""
    return F.filter(F.split(_c(text), r"\s+"), lambda w: w != "")


def token_count(text: Column | str, tokenizer: Tokenizer = word_tokens) -> Column:
    return F.size(tokenizer(_c(text)))


# B1 -------------------------------------------------------------------------
def build_prompt_rows(df: DataFrame, *, prompt_key: str = "text", label_key: str | None = "label",
                      metadata_key: str | None = "metadata", id_col: str | None = None,
                      metadata_cols: Sequence[str] = ()) -> DataFrame:
    """Map dataset keys to sample columns: prompt, label, metadata
    (missing metadata -> empty map).  ``metadata_cols`` builds the map
    from plain columns when the source has no map column."""
    if metadata_key and metadata_key in df.columns:
        md = F.coalesce(F.col(metadata_key), F.create_map().cast("map<string,string>"))
    elif metadata_cols:
        md = F.create_map(*[x for c in metadata_cols for x in (F.lit(c), F.col(c).cast("string"))])
    else:
        md = F.create_map().cast("map<string,string>")
    cols = [F.col(id_col)] if id_col else []
    cols += [F.col(prompt_key).alias("prompt"),
             (F.col(label_key).cast("string") if label_key else F.lit(None).cast("string")).alias("label"),
             md.alias("metadata")]
    return df.select(*cols)


# B2 -------------------------------------------------------------------------
def multimodal_parts(text: Column | str, media: dict[str, Column | str]) -> Column:
    """Part list ``[{type:'text',text}, {type:<media>, path}...]`` of the
    columns present; null media are dropped."""
    parts = [F.struct(F.lit("text").alias("type"), _c(text).cast("string").alias("text"),
                      F.lit(None).cast("string").alias("path"))]
    for kind, col in media.items():
        parts.append(F.struct(F.lit(kind).alias("type"), F.lit(None).cast("string").alias("text"),
                              _c(col).cast("string").alias("path")))
    return F.filter(F.array(*parts), lambda p: p["text"].isNotNull() | p["path"].isNotNull())


# B3 -------------------------------------------------------------------------
IM_START, IM_END = "<|im_start|>", "<|im_end|>"


def chatml_message(role: Column, content: Column) -> Column:
    return F.concat(F.lit(IM_START), role, F.lit("\n"), content, F.lit(IM_END + "\n"))


def render_messages(messages: Column | str, add_generation_prompt: bool = True,
                    tools_json: Column | None = None) -> Column:
    """Render an ``array<struct<role, content>>`` (already ordered) to one
    ChatML string; tools (a JSON list) go into the system block."""
    body = F.array_join(F.transform(_c(messages), lambda m: chatml_message(m["role"], m["content"])), "")
    if tools_json is not None:
        tools = F.concat(F.lit(IM_START + "system\n# Tools\n<tools>\n"), tools_json, F.lit("\n</tools>" + IM_END + "\n"))
        body = F.concat(tools, body)
    if add_generation_prompt:
        body = F.concat(body, F.lit(IM_START + "assistant\n"))
    return body


def collect_messages(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                     fields: Sequence[str] = ("role", "text")) -> DataFrame:
    """Turn rows -> one ordered ``messages`` array per conversation.  The
    list is one conversation (the unit every chat operator consumes)."""
    st = F.struct(F.col(turn_col).alias("turn"), *[F.col(f) for f in fields])
    return (df.groupBy(conv_col).agg(F.array_sort(F.collect_list(st)).alias("messages")))


def render_chat(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", add_generation_prompt: bool = True) -> DataFrame:
    msgs = collect_messages(df.select(conv_col, turn_col, F.col(role_col).alias("role"),
                                      F.col(text_col).alias("content")),
                            conv_col=conv_col, turn_col=turn_col, fields=("role", "content"))
    return msgs.select(conv_col, render_messages("messages", add_generation_prompt).alias("rendered"))


# B4 -------------------------------------------------------------------------
TOOL_SCHEMA = "array<struct<type:string,function:struct<name:string,description:string,parameters:string>>>"


def normalize_tools(tools: Column | str) -> Column:
    """tools given as a JSON string -> parsed list; unparsable -> error."""
    parsed = F.from_json(_c(tools), TOOL_SCHEMA)
    return F.when(_c(tools).isNull(), F.lit(None).cast(TOOL_SCHEMA)).when(
        parsed.isNull(), F.raise_error(F.lit("tools must be a JSON list")).cast(TOOL_SCHEMA)).otherwise(parsed)


# B5 -------------------------------------------------------------------------
def prompt_len_filter(df: DataFrame, *, max_length: int | None, text_col: str = "prompt",
                      tokenizer: Tokenizer = word_tokens, multimodal_col: str | None = None) -> DataFrame:
    """Drop prompts with more than ``max_length`` tokens; rows with media
    parts are never dropped."""
    if max_length is None:
        return df
    keep = token_count(text_col, tokenizer) <= max_length
    if multimodal_col:
        keep = keep | (F.size(F.filter(multimodal_col, lambda p: p["type"] != "text")) > 0)
    return df.filter(keep)


# B6 -------------------------------------------------------------------------
# Source role names -> chat roles.
ROLE_MAP = {"human": "user", "gpt": "assistant", "system": "system"}


def map_role(role: Column | str) -> Column:
    m = F.create_map(*[F.lit(x) for kv in ROLE_MAP.items() for x in kv])
    mapped = F.element_at(m, _c(role))
    return F.when(mapped.isNull(), F.raise_error(F.concat(F.lit("no chat role for "), _c(role))).cast("string")) \
            .otherwise(mapped)


# B8 -------------------------------------------------------------------------
def add_question_id(df: DataFrame, dataset: str, *, id_col: str | None = None,
                    order_cols: Sequence[str] = (), out_col: str = "question_id") -> DataFrame:
    """``<dataset>__<id>`` from an id column, else ``<dataset>__idx<i>`` with
    i the row position in ``order_cols`` (distributed global index)."""
    if id_col:
        return df.withColumn(out_col, F.concat(F.lit(f"{dataset}__"), F.col(id_col).cast("string")))
    g = global_index(df, order_cols, "_qi")
    return g.withColumn(out_col, F.concat(F.lit(f"{dataset}__idx"), F.col("_qi").cast("string"))).drop("_qi")


# B11 ------------------------------------------------------------------------
def reward_select(reward: Column | str, reward_map: Column | str | None = None,
                  reward_key: str | None = None) -> Column:
    """``reward`` or ``reward_map[reward_key]``; a missing key fails."""
    if reward_key is None or reward_map is None:
        return _c(reward)
    v = F.element_at(_c(reward_map), F.lit(reward_key))
    return F.when(v.isNull() & _c(reward_map).isNotNull(),
                  F.raise_error(F.lit(f"reward key {reward_key} missing")).cast("double")) \
            .otherwise(F.coalesce(v, _c(reward)))


# B13 ------------------------------------------------------------------------
def default_loss_mask(mask: Column | str, response_length: Column | str) -> Column:
    """All-ones mask when null; a mask whose length differs fails."""
    m = _c(mask)
    n = _c(response_length)
    ones = F.array_repeat(F.lit(1), n.cast("int"))
    return F.when(m.isNull(), ones).when(F.size(m) != n, F.raise_error(
        F.lit("loss mask length != response length")).cast("array<int>")).otherwise(m)


# B14 ------------------------------------------------------------------------
def to_train_columns(df: DataFrame, *, reward: Column, raw_reward_col: str = "reward",
                     status_col: str = "status", metadata_col: str | None = None) -> DataFrame:
    """Samples -> trainer columns: rewards, raw_reward (overridden by
    metadata['raw_reward'] when present), truncated 0/1, loss masks
    defaulted, and total lengths where there is a ``tokens`` column. Optional columns are
    decided per row (presence), not by the first row; all others are carried."""
    raw = F.col(raw_reward_col).cast("double")
    if metadata_col:
        raw = F.coalesce(F.element_at(F.col(metadata_col), F.lit("raw_reward")).cast("double"), raw)
    out = df.withColumn("rewards", reward).withColumn("raw_reward", raw) \
            .withColumn("truncated", (F.col(status_col) == "truncated").cast("int"))
    if "loss_mask" in df.columns:
        out = out.withColumn("loss_masks", default_loss_mask("loss_mask", "response_length"))
    else:
        out = out.withColumn("loss_masks", F.array_repeat(F.lit(1), F.col("response_length").cast("int")))
    if "tokens" in df.columns:
        out = out.withColumn("total_lengths", F.size("tokens"))
    return out


# B15 ------------------------------------------------------------------------
def replicate_samples(df: DataFrame, n: int, *, group_col: str = "group_index", base: int = 0,
                      epochs: int = 1) -> DataFrame:
    """n copies of each prompt (per epoch): ``index = group_index*n + j + base``."""
    out = df.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(n * epochs - 1))))
    return (out.withColumn("epoch", (F.col("_j") / n).cast("int"))
               .withColumn("sample_in_group", (F.col("_j") % n).cast("bigint"))
               .withColumn("index", F.col(group_col) * n + F.col("sample_in_group") + base)
               .drop("_j"))


# B16 ------------------------------------------------------------------------
def spec_info_rollup(df: DataFrame, *, keys: Sequence[str], accept: str, draft: str, verify: str,
                     response_length: str) -> DataFrame:
    """Accumulate speculative-decoding counters per sample; rate =
    accept/draft, length = response_length/verify (0 when undefined)."""
    agg = df.groupBy(*keys).agg(F.sum(accept).alias("accept_tokens"), F.sum(draft).alias("draft_tokens"),
                                F.sum(verify).alias("verify_ct"), F.max(response_length).alias("response_length"))
    return (agg.withColumn("spec_accept_rate", F.coalesce(F.col("accept_tokens") / F.nullif("draft_tokens", F.lit(0)), F.lit(0.0)))
               .withColumn("spec_accept_length", F.coalesce(F.col("response_length") / F.nullif("verify_ct", F.lit(0)), F.lit(0.0))))


# B17 ------------------------------------------------------------------------
def inject_metadata(metadata: Column | str, rm_type: Column | None, overrides: Column | None) -> Column:
    """Merge rm_type and overrides into the sample metadata; later wins."""
    m = F.coalesce(_c(metadata), F.create_map().cast("map<string,string>"))
    entries = F.map_entries(m)
    if rm_type is not None:
        entries = F.concat(entries, F.array(F.struct(F.lit("rm_type").alias("key"), rm_type.alias("value"))))
    if overrides is not None:
        entries = F.concat(entries, F.map_entries(overrides))
    # keep the last entry of each key
    rev = F.reverse(entries)
    keys = F.array_distinct(F.transform(rev, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.filter(rev, lambda e: e["key"] == k)[0]["value"]))


# B18 ------------------------------------------------------------------------
def finish_to_status(finish_reason: Column | str, buffer_variant: bool = False) -> Column:
    fr = _c(finish_reason)
    if buffer_variant:
        return F.when(fr == "length", "truncated").otherwise("completed")
    return F.when(fr == "length", "truncated").when(fr == "abort", "aborted").otherwise("completed")


# B21 ------------------------------------------------------------------------
def round_number(messages: Column | str) -> Column:
    return F.size(F.filter(_c(messages), lambda m: m["role"] == "assistant"))


# B23 ------------------------------------------------------------------------
def remaining_budget(max_new_tokens: Column, n_tokens: Column, prompt_len: Column,
                     context_cap: Column | None = None) -> Column:
    """max_new_tokens - (len(tokens) - prompt_len) (optionally capped by the
    context left); negative fails; 0 means truncated."""
    b = max_new_tokens - (n_tokens - prompt_len)
    if context_cap is not None:
        b = F.least(b, context_cap)
    return F.when(b < 0, F.raise_error(F.lit("negative token budget")).cast("bigint")).otherwise(b)


# B19 / B20 ------------------------------------------------------------------
def numbered_join(items: Column, fmt: str, sep: str = "\n\n") -> Column:
    """Join an ordered array of strings as ``fmt.format(i=<1-based>, x=item)``."""
    head, mid = fmt.split("{i}")
    mid, tail = mid.split("{x}")
    return F.array_join(F.transform(items, lambda x, i: F.concat(F.lit(head), (i + 1).cast("string"), F.lit(mid), x,
                                                                F.lit(tail))), sep)


# T21 ------------------------------------------------------------------------
GEN_PREFIX = IM_START + "assistant\n"


def message_tokens(role: Column, content: Column, tokenizer: Tokenizer = word_tokens) -> Column:
    return tokenizer(chatml_message(role, content))


def chat_loss_mask(messages: Column | str, tokenizer: Tokenizer = word_tokens, variant: str = "chatml") -> Column:
    """struct(tokens, loss_mask) over an ordered message array.  Each
    message is tokenised on its own; assistant messages get 0 for the
    generation prefix and 1 after it, other roles 0; a message whose
    ``step_loss_mask`` is not 1 is all 0.  ``distill`` variant: first
    message rendered with the generation prompt (mask 0) + raw last
    message content (mask 1)."""
    gen_len = F.size(tokenizer(F.lit(GEN_PREFIX)))
    if variant == "distill":
        first = tokenizer(F.concat(chatml_message(_c(messages)[0]["role"], _c(messages)[0]["content"]), F.lit(GEN_PREFIX)))
        last = F.element_at(_c(messages), -1)
        resp = tokenizer(last["content"])
        on = F.coalesce(last["step_loss_mask"], F.lit(1)) == 1
        mask = F.concat(F.array_repeat(F.lit(0), F.size(first)),
                        F.array_repeat(F.when(on, 1).otherwise(0), F.size(resp)))
        return F.struct(F.concat(first, resp).alias("tokens"), mask.alias("loss_mask"))
    per = F.transform(_c(messages), lambda m: F.struct(
        message_tokens(m["role"], m["content"], tokenizer).alias("tok"),
        m["role"].alias("role"), F.coalesce(m["step_loss_mask"], F.lit(1)).alias("slm")))

    def mask_of(p):
        n = F.size(p["tok"])
        asst = F.concat(F.array_repeat(F.lit(0), F.least(gen_len, n)),
                        F.array_repeat(F.lit(1), F.greatest(n - gen_len, F.lit(0))))
        return F.when((p["role"] == "assistant") & (p["slm"] == 1), asst).otherwise(F.array_repeat(F.lit(0), n))

    return F.struct(F.flatten(F.transform(per, lambda p: p["tok"])).alias("tokens"),
                    F.flatten(F.transform(per, mask_of)).alias("loss_mask"))


# T22 ------------------------------------------------------------------------
def response_span(mask: Column | str) -> Column:
    """struct(response_length, loss_mask): from the first 1 to the end, 0 and
    an empty mask when there is no 1."""
    p = F.array_position(_c(mask), 1)
    n = F.when(p > 0, F.size(_c(mask)) - p + 1).otherwise(F.lit(0))
    return F.struct(n.cast("bigint").alias("response_length"),
                    F.when(p > 0, F.slice(_c(mask), F.greatest(p, F.lit(1)).cast("int"), n.cast("int")))
                     .otherwise(F.array().cast("array<int>")).alias("loss_mask"))


# T23 ------------------------------------------------------------------------
def mask_text_spans(tokens: Column | str, mask: Column | str, sep: str = " ") -> Column:
    """Text of each maximal run of mask == 1 (tokens joined with ``sep``)."""
    z = F.arrays_zip(_c(tokens).alias("t"), _c(mask).alias("m"))
    init = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("cur"))

    def step(acc, e):
        on = e["m"] == 1
        flush = (~on) & (F.size(acc["cur"]) > 0)
        done = F.when(flush, F.concat(acc["done"], F.array(F.array_join(acc["cur"], sep)))).otherwise(acc["done"])
        cur = F.when(on, F.concat(acc["cur"], F.array(e["t"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(done.alias("done"), cur.alias("cur"))

    return F.aggregate(z, init, step, lambda acc: F.when(F.size(acc["cur"]) > 0, F.concat(
        acc["done"], F.array(F.array_join(acc["cur"], sep)))).otherwise(acc["done"]))


# T24 ------------------------------------------------------------------------
def find_sublist(main: Column | str, sub: Column | str) -> Column:
    """All 0-based start positions where ``sub`` occurs in ``main``."""
    n, k = F.size(_c(main)), F.size(_c(sub))
    starts = F.sequence(F.lit(0), F.greatest(n - k, F.lit(-1)))
    return F.when(n - k < 0, F.array().cast("array<int>")).otherwise(
        F.filter(starts, lambda i: F.slice(_c(main), i + 1, k) == _c(sub)))


# B22 ------------------------------------------------------------------------
def append_turns(turns: Column | str, tokenizer: Tokenizer = word_tokens, log_probs: bool = False) -> Column:
    """Ordered turns (struct role, content and, with ``log_probs``, that field) ->
    one response: model (assistant) tokens mask 1 with their log-probs,
    observation tokens mask 0 and log-prob 0.0. A model turn whose log-probs
    do not match its tokens fails."""
    def aligned(m, tok, model):
        given = m["log_probs"].cast("array<double>") if log_probs else F.transform(tok, lambda t: F.lit(0.0))
        fits = F.when(F.size(given) == F.size(tok), given).otherwise(
            F.raise_error(F.lit("a turn's log-probs do not match its tokens")).cast("array<double>"))
        return F.when(model, fits).otherwise(F.transform(tok, lambda t: F.lit(0.0)))

    per = F.transform(_c(turns), lambda m: F.struct(
        tokenizer(m["content"]).alias("tok"), (m["role"] == "assistant").alias("model"),
        aligned(m, tokenizer(m["content"]), m["role"] == "assistant").alias("lp")))
    toks = F.flatten(F.transform(per, lambda p: p["tok"]))
    mask = F.flatten(F.transform(per, lambda p: F.array_repeat(F.when(p["model"], 1).otherwise(0), F.size(p["tok"]))))
    return F.struct(toks.alias("tokens"), mask.alias("loss_mask"),
                    F.flatten(F.transform(per, lambda p: p["lp"])).alias("log_probs"))


# B24 ------------------------------------------------------------------------
def sampling_seed(seed: int, position: Column | str) -> Column:
    """Per-sample seed = base seed + position inside its group."""
    return F.lit(seed) + _c(position)


# B25 ------------------------------------------------------------------------
TOOL_CALL_RE = r"(?s)<tool_call>(.*?)</tool_call>"


def tool_calls(text: Column | str) -> Column:
    """Parsed tool calls of a response: array<struct<name, code, valid>>."""
    blocks = F.regexp_extract_all(_c(text), F.lit(TOOL_CALL_RE), 1)
    return F.transform(blocks, lambda b: F.struct(
        F.get_json_object(b, "$.name").alias("name"),
        F.get_json_object(b, "$.arguments.code").alias("code"),
        F.get_json_object(b, "$.name").isNotNull().alias("valid")))


def tool_call_action(text: Column | str, default: str = "respond") -> Column:
    """First parsed call's name; no call or unparsable JSON -> default."""
    first = F.get(tool_calls(text), 0)
    return F.when(first.isNotNull() & first["valid"], first["name"]).otherwise(F.lit(default))


def tool_call_message(text: Column | str, default: str = "respond") -> Column:
    """struct(message, action) of a response. message: role, content (the text outside of the calls; null where there are calls
    and it is blank) and tool_calls (id ``call_<i>_<name>``, type, function name and arguments as JSON text; null without
    calls). action: the first call's name and arguments, or ``default`` with the whole response as ``content`` where there is no
    call or its arguments are no JSON object. A null response gives null."""
    from ..functions.text import let
    t = _c(text)

    def message(v: Column) -> Column:
        calls = F.transform(v["blocks"], lambda b, i: F.struct(
            F.concat(F.lit("call_"), i.cast("string"), F.lit("_"), F.coalesce(F.get_json_object(b, "$.name"), F.lit("unknown"))).alias("id"),
            F.lit("function").alias("type"),
            F.struct(F.coalesce(F.get_json_object(b, "$.name"), F.lit("")).alias("name"),
                     F.coalesce(F.get_json_object(b, "$.arguments"), F.lit("{}")).alias("arguments")).alias("function")))
        some = F.size(v["blocks"]) > 0
        content = F.when(some & (F.trim(v["rest"]) == ""), F.lit(None).cast("string")).otherwise(v["rest"])
        first = F.get(v["blocks"], 0)
        name, kwargs = F.get_json_object(first, "$.name"), F.get_json_object(first, "$.arguments")
        known = some & name.isNotNull() & F.coalesce(kwargs.startswith("{"), F.lit(False))
        spoken = F.to_json(F.struct(v["t"].alias("content")))
        return F.struct(
            F.struct(F.lit("assistant").alias("role"), content.alias("content"), F.when(some, calls).alias("tool_calls")).alias("message"),
            F.struct(F.when(known, name).otherwise(F.lit(default)).alias("name"),
                     F.when(known, kwargs).otherwise(spoken).alias("kwargs")).alias("action"))

    made = let(message, t=t, blocks=F.regexp_extract_all(t, F.lit(TOOL_CALL_RE), 1), rest=F.regexp_replace(t, TOOL_CALL_RE, ""))
    return F.when(t.isNotNull(), made)


# T25 ------------------------------------------------------------------------
def token_delta(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", tokenizer: Tokenizer = word_tokens) -> DataFrame:
    """Per message: the text added to the rendered conversation by that
    message = render(messages[:i+1]) minus render(messages[:i]), found by
    the running rendered length; tokens of the delta, mask 1 only for
    assistant messages."""
    from pyspark.sql import Window as W
    rendered = chatml_message(F.col(role_col), F.col(text_col))
    w = W.partitionBy(conv_col).orderBy(turn_col).rowsBetween(W.unboundedPreceding, -1)
    msgs = df.select(conv_col, turn_col, role_col, rendered.alias("_r"))
    full = msgs.groupBy(conv_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(turn_col, "_r"))), lambda e: e["_r"]), "")
        .alias("_full"))
    pos = msgs.withColumn("_start", F.coalesce(F.sum(F.length("_r")).over(w), F.lit(0)))
    j = pos.join(full, conv_col)
    delta = F.substring(F.col("_full"), F.col("_start") + 1, F.length("_r"))
    toks = tokenizer(delta)
    return j.select(conv_col, turn_col, role_col, delta.alias("delta"), toks.alias("tokens"),
                    F.array_repeat(F.when(F.col(role_col) == "assistant", 1).otherwise(0), F.size(toks)).alias("loss_mask"))
