"""Prompts, message lists and their rendered text.

Prompt wording is data: every function takes it as a column or a parameter, and
the catalogue below is only a default.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.constants import TURN_END, TURN_START
from abacist.functions.columns import ColumnLike, as_column
from abacist.functions.text import strip

DEFAULT_PROMPT_TYPE = "zero_shot"

# Fixed names of prompt kinds, which tables of rows refer to; the wording is free.
DEFAULT_PROMPTS: dict[str, str] = {
    "standard": "给出这道应用题的数值结果，只写一个数。",
    "zero_shot_simple": "先想清楚再作答，结尾写成“答案：数字”。",
    "zero_shot": "写出计算过程，另起一行写“答案：数字”，数字后不加单位。",
    "few_shot": "示例：每盒6支笔，3盒共几支？\n步骤：6×3=18\n答案：18\n照此解答下题。",
    "sft": "请按步骤计算，结尾写“答案：数字”。",
    "dpo": "请按步骤计算一次，不要回头修改，结尾写“答案：数字”。",
    "grpo": "写出计算过程一次，另起一行写“答案：数字”，不要回头修改。",
}

DEFAULT_INSTRUCTION = "解答下面的小学应用题。"
DEFAULT_STEP_REQUEST = "请写出步骤，结尾写“答案：数字”。"

DEFAULT_CORRECT_REQUEST = "题目：{question}\n已知答案：{answer}\n写出得到它的步骤。"
DEFAULT_WRONG_REQUEST = "题目：{question}\n写一份算错的解答，结果不要等于{answer}。"

# A catalogue is written into the plan as literals, so its size is checked.
MAX_CATALOGUE_ENTRIES = 1_000


def check_catalogue(entries) -> None:
    if len(entries) > MAX_CATALOGUE_ENTRIES:
        raise ValueError(
            f"{len(entries)} entries are too many for literals; pass them as a table"
        )


def lookup(
    key: ColumnLike, catalogue: Mapping[str, str], default: str | None = None
) -> Column:
    """The catalogue text of a key, the text of ``default`` for unknown keys."""
    check_catalogue(catalogue)
    pairs = [F.lit(part) for entry in catalogue.items() for part in entry]
    found = F.try_element_at(F.create_map(*pairs), as_column(key))
    return found if default is None else F.coalesce(found, F.lit(catalogue[default]))


def prompt_text(
    prompt_type: ColumnLike,
    catalogue: Mapping[str, str] = DEFAULT_PROMPTS,
    default: str = DEFAULT_PROMPT_TYPE,
) -> Column:
    """System prompt of a prompt type."""
    return lookup(prompt_type, catalogue, default)


def message(role: str, content: ColumnLike) -> Column:
    return F.struct(
        F.lit(role).alias("role"), as_column(content).cast("string").alias("content")
    )


def messages(
    system: ColumnLike, user: ColumnLike, assistant: ColumnLike | None = None
) -> Column:
    """``array<struct<role, content>>`` of a conversation with one question."""
    turns = [message("system", system), message("user", user)]
    if assistant is not None:
        turns.append(message("assistant", assistant))
    return F.array(*turns)


def chat_text(
    turns: ColumnLike,
    generation_prompt: bool = False,
    start: str = TURN_START,
    end: str = TURN_END,
) -> Column:
    """Messages with role headers, optionally opening the assistant's turn."""
    rendered = F.array_join(
        F.transform(
            as_column(turns),
            lambda m: F.concat(
                F.lit(start), m["role"], F.lit("\n"), m["content"], F.lit(end)
            ),
        ),
        "",
    )
    if generation_prompt:
        rendered = F.concat(rendered, F.lit(f"{start}assistant\n"))
    return rendered


def training_segments(
    instruction: ColumnLike,
    question: ColumnLike,
    start: str = TURN_START,
    end: str = TURN_END,
    step_request: str = DEFAULT_STEP_REQUEST,
) -> Column:
    """Prefix of a training text: system and user segment without role names,
    and the opened third segment."""
    return F.concat(
        F.lit(start),
        as_column(instruction),
        F.lit(f" {step_request}{end}{start}"),
        as_column(question),
        F.lit(f"{end}{start}"),
    )


def request_text(template: str, question: ColumnLike, answer: ColumnLike) -> Column:
    """A template with ``{question}`` and ``{answer}`` filled in once."""
    columns = {"question": as_column(question), "answer": as_column(answer)}
    pieces: list[Column] = []
    rest = template
    while rest:
        at, name = min(
            (rest.find("{%s}" % n), n) if "{%s}" % n in rest else (len(rest), "")
            for n in columns
        )
        if at:
            pieces.append(F.lit(rest[:at]))
        if not name:
            break
        pieces.append(columns[name].cast("string"))
        rest = rest[at + len(name) + 2 :]
    return F.concat(*pieces) if pieces else F.lit("")


def reply_content(body: ColumnLike) -> Column:
    """The reply text of a chat completion body, stripped."""
    return strip(F.get_json_object(as_column(body), "$.choices[0].message.content"))
