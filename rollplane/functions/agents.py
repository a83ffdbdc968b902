"""Expressions for tool-using agents and formal-math data (T13-T15 tool
variants, T17, T28, C5, B9, B10). All native Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import ColumnOrName, _c, let, snippet_segments

# Patterns of a tool-using answer.
BOXED_ANSWER = r"(?s)Answer:\s*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}"
TOOL_CALL = r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"
CODE_TAG = r"(?s)<code>(.*?)</code>"
PYTHON_BLOCK = r"(?s)```python\s*(.*?)\s*```"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# T13 (tool variant) ------------------------------------------------------------
def extract_tool_action(prediction: ColumnOrName) -> Column:
    """struct(action, content) by priority: boxed answer, code_interpreter tool
    call with code, <code> tag, python block; else (null, '')."""
    def pick(v):
        x = v["x"]
        call = F.regexp_extract(x, TOOL_CALL, 1)
        code = F.when(F.get_json_object(call, "$.name") == "code_interpreter", F.get_json_object(call, "$.arguments.code"))
        empty = F.lit(None).cast("string")

        def found(action, content):
            return F.struct(action.alias("action"), content.alias("content"))
        return (F.when(x.rlike(BOXED_ANSWER), found(F.lit("answer"), _strip(F.regexp_extract(x, BOXED_ANSWER, 1))))
                 .when(_strip(code) != "", found(F.lit("code"), code))
                 .when(x.rlike(CODE_TAG), found(F.lit("code"), _strip(F.regexp_extract(x, CODE_TAG, 1))))
                 .when(x.rlike(PYTHON_BLOCK), found(F.lit("code"), _strip(F.regexp_extract(x, PYTHON_BLOCK, 1))))
                 .otherwise(found(empty, F.lit(""))))

    return let(pick, x=_c(prediction))


# T14 (tool variant) ------------------------------------------------------------
def truncate_after_tool(resp: ColumnOrName) -> Column:
    """Cut after the last tool call, else the first </code>, else the last python
    block, else the last boxed answer; otherwise unchanged."""
    def cut(v):
        x = v["x"]

        def last(pattern):
            # text up to the end of the last match, null without one
            found = F.regexp_extract_all(x, F.lit(pattern), 0)
            return F.when(F.size(found) > 0, let(
                lambda p: F.substring(p["x"], F.lit(1), F.length(p["x"]) - F.position(F.reverse(p["m"]), F.reverse(p["x"])) + 1),
                x=x, m=F.element_at(found, -1)))
        return F.coalesce(
            last(r"(?s)<tool_call>\s*\{.*?\}\s*</tool_call>"),
            F.when(F.instr(x, "</code>") > 0, F.concat(F.substring_index(x, "</code>", 1), F.lit("</code>"))),
            last(r"(?s)```python\s*.*?```"), last(BOXED_ANSWER), x)

    return let(cut, x=_c(resp))


# T15 ------------------------------------------------------------------------
# What the environment answers.
INVALID_TOOL = ("\nMy previous action is invalid. If I want to execute code, I should put the code between <code> and "
                "</code>. If I want to give the final answer, I should use the format 'Answer: \\boxed{answer}'. "
                "Let me try again.\n")
INVALID_SEARCH = ("\nMy previous action is invalid. If I want to search, I should put the query between <search> and "
                  "</search>. If I want to give the final answer, I should put the answer between <answer> and </answer>. "
                  "Let me try again.\n")


def search_observation(action: ColumnOrName, results: ColumnOrName) -> Column:
    """struct(text, done): what follows a search or answer action."""
    a = _c(action)
    text = (F.when(a == "search", F.concat(F.lit("\n\n<information>"), _strip(_c(results)), F.lit("</information>\n\n")))
             .when(a == "answer", F.lit("")).otherwise(F.lit(INVALID_SEARCH)))
    return F.struct(text.alias("text"), F.coalesce(a == "answer", F.lit(False)).alias("done"))


def tool_observation(action: ColumnOrName, content: ColumnOrName, result: ColumnOrName) -> Column:
    """struct(text, done): what follows a code or answer action; ``result`` is the interpreter's output."""
    a = _c(action)
    body = F.when(_strip(_c(content)) == "", F.lit("Error: No Python code found")).otherwise(_c(result))
    text = (F.when(a == "code", F.concat(F.lit("\n\n<interpreter>\n"), body, F.lit("\n</interpreter>\n\n")))
             .when(a == "answer", F.lit("")).otherwise(F.lit(INVALID_TOOL)))
    return F.struct(text.alias("text"), F.coalesce(a == "answer", F.lit(False)).alias("done"))


# T17 ------------------------------------------------------------------------
def last_fenced_block(text: ColumnOrName) -> Column:
    found = F.regexp_extract_all(_c(text), F.lit(r"(?s)```(?:\w+)?\n(.*?)```"), 1)
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def code_block_assemble(prompt: ColumnOrName, response: ColumnOrName) -> Column:
    """struct(code, error): the question part (up to ':=') of the prompt's last
    block with the proof part (from ':=') of the response's; 'no_code' without a
    block in the response; a prompt without block or ':=' fails."""
    def build(v):
        q, a = v["q"], v["a"]
        at = F.instr(q, ":=")
        question = F.when(at > 0, F.substring(q, F.lit(1), at - 1)).otherwise(
            F.raise_error(F.lit("the prompt has no code block with ':='")).cast("string"))
        proof = F.when(F.instr(a, ":=") > 0, F.substring(a, F.instr(a, ":="), F.length(a))) \
            .otherwise(F.concat(F.lit(":= by\n"), a))
        return F.struct(F.when(a.isNotNull(), F.concat(question, proof)).alias("code"),
                        F.when(a.isNull(), "no_code").alias("error"))

    return let(build, q=last_fenced_block(prompt), a=last_fenced_block(response))


# T28 ------------------------------------------------------------------------
def snippet_context(snippet: ColumnOrName, doc: ColumnOrName) -> Column:
    """Paragraphs of ``doc`` that hold a segment of the snippet: for each segment the
    lines from its first occurrence's start to its end (line breaks count as blanks
    when looking), without repeats, joined by line breaks."""
    def paragraph(doc_, flat, s):
        at = F.position(s, flat)
        before = F.substring(doc_, F.lit(1), at)            # up to the occurrence's first character
        start = F.length(before) - F.length(F.substring_index(before, "\n", -1))
        end = at - 1 + F.length(s)
        rest = F.substring(doc_, end + 1, F.length(doc_))
        stop = end + F.length(F.substring_index(rest, "\n", 1))
        return F.when(at > 0, _strip(F.substring(doc_, start + 1, stop - start)))

    def collect(v):
        paras = F.transform(v["segments"], lambda s: paragraph(v["doc"], v["flat"], s))
        return F.array_join(F.array_distinct(F.filter(paras, lambda p: p.isNotNull())), "\n")

    return let(collect, segments=snippet_segments(snippet), doc=_c(doc), flat=F.translate(_c(doc), "\n", " "))


# C5 / B9 / B10 -----------------------------------------------------------------
NEEDLE = "theorem "


def occurrences(text: ColumnOrName, needle: str) -> Column:
    x = _c(text)
    return ((F.length(x) - F.length(F.replace(x, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def theorem_filter(df, *, code: str, difficulty: str | None = None, wanted: object = None):
    """Rows whose code states exactly one theorem, of the wanted difficulty if one is given."""
    keep = occurrences(code, NEEDLE) == 1
    if difficulty is not None and wanted is not None:
        keep = keep & (F.col(difficulty) == F.lit(wanted))
    return df.filter(keep)


BY_SORRY = r"(?m) *:=\s*(?:by\s*)?(?:sorry\s*)?$"


def to_by_sorry(code: ColumnOrName) -> Column:
    """The statement with its proof replaced by ``sorry``; fails without ':=' at a line's end."""
    x = _c(code)
    return F.when(x.rlike(BY_SORRY), F.concat(F.regexp_replace(x, BY_SORRY, ""), F.lit(" := by\n  sorry"))).otherwise(
        F.raise_error(F.lit("the statement does not end in ':='")).cast("string"))


def theorem_prompt(statement: ColumnOrName, code: ColumnOrName, template: str) -> Column:
    """The statement as a comment before its theorem, the proof left open, in
    ``template`` (with one ``{}``); fails unless there is exactly one theorem."""
    x = _c(code)
    head, tail = template.split("{}")
    commented = F.replace(x, F.lit(NEEDLE), F.concat(F.lit("/- "), _c(statement), F.lit(" -/\n" + NEEDLE)))
    return F.when(occurrences(x, NEEDLE) == 1, F.concat(F.lit(head), to_by_sorry(commented), F.lit(tail))).otherwise(
        F.raise_error(F.lit("the code must state exactly one theorem")).cast("string"))


def sft_pair(prompt: ColumnOrName, output: ColumnOrName, prefix: str, template: str) -> Column:
    """array of (role, content): the prompt without its required prefix, proof left
    open, in ``template``; the output opened as a Lean block."""
    x = _c(prompt)
    head, tail = template.split("{}")
    body = F.when(x.startswith(prefix), F.substring(x, F.lit(len(prefix) + 1), F.length(x))).otherwise(
        F.raise_error(F.lit("the prompt lacks its prefix")).cast("string"))

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("user", F.concat(F.lit(head), to_by_sorry(body), F.lit(tail))),
                   message("assistant", F.concat(F.lit("```lean\n"), _c(output))))
