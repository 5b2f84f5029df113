"""Chat formatting by a compiled template.

A conversation's rows, by turn, are rendered by a template (``template.py``) into one
text, with the ranges of it that a model is to generate: the loss mask. Texts and roles
go through the filter ``escape``: a backslash before each backslash and each character
that a control string may begin with. So no control string can begin inside a text,
and reading back is exact.

Spark groups the rows of each conversation; a conversation is one formatted value, so
its rows meet in one place by what it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.template import compile_template

# Strings that a tokenizer takes as control.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>")
TURN, TEXT, END = CONTROL[4:]

#: Each turn between marks; what the assistant says is to be generated.
TEMPLATE = """
{#- One line for each role would do; marks are the same for all. -#}
<s>{% for message in messages -%}
  <|turn|>{{ message.role | escape }}<|text|>
  {%- if message.role == 'assistant' -%}
    {% generation %}{{ message.text | escape }}{% endgeneration %}
  {%- else -%}
    {{ message.text | escape }}
  {%- endif -%}
  <|end|>
{%- endfor %}</s>
{#- -#}
"""

_STARTS = re.compile("[" + re.escape("\\" + "".join(sorted({c[0] for c in CONTROL}))) + "]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_MARKS = re.compile(r"\\.|" + "|".join(map(re.escape, (TURN, TEXT, END))), re.S)


def escape(text: str | None) -> str:
    return _STARTS.sub(lambda m: "\\" + m[0], text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, from the formatted text alone."""
    places = [(m.start(), m.end(), m[0]) for m in _MARKS.finditer(formatted) if m[0][0] != "\\"]
    turns = []
    for (_, a, mark), (b, c, _), (d, _, _) in zip(places, places[1:], places[2:], strict=False):
        if mark == TURN:
            turns.append((unescape(formatted[a:b]), unescape(formatted[c:d])))
    return turns


def formatted(
    conversations: DataFrame,
    template: str = TEMPLATE,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: ``conversation``, ``formatted`` and ``spans``.

    ``spans`` are the ranges of code points under the loss mask, in order. A null role
    or text is empty; null turns come first, equal turns are ordered by role and text,
    and repeated rows are repeated turns. Rows with a null id are one conversation. An
    empty table gives an empty result; a template that cannot be compiled is an error.
    """
    compile_template(template, {"escape": escape})
    rows = conversations.select(
        conversations[conversation].alias("conversation"),
        F.struct(
            conversations[turn].cast("bigint").alias("turn"),
            F.coalesce(conversations[role], F.lit("")).alias("role"),
            F.coalesce(conversations[text], F.lit("")).alias("text"),
        ).alias("message"),
    )
    grouped = rows.groupBy("conversation").agg(
        F.sort_array(F.collect_list("message")).alias("messages")
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template, {"escape": escape})
        for batch in batches:
            found = [run({"messages": m}) for m in batch.column(1).to_pylist()]
            spans = [[{"start": a, "stop": b} for a, b in s] for _, s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([t for t, _ in found], pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ],
                names=["conversation", "formatted", "spans"],
            )

    kind = grouped.schema["conversation"].dataType.simpleString()
    return grouped.mapInArrow(
        render,
        f"conversation {kind}, formatted string, spans array<struct<start:bigint,stop:bigint>>",
    )


def digests(frame: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations and their spans."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for text, spans in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                turns = read_turns(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
                for column, value in zip(
                    columns,
                    (
                        len(turns),
                        hashlib.sha256(said.encode()).hexdigest(),
                        len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(),
                        len(text),
                    ),
                    strict=True,
                ):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
             "formatted_chars"]
    kind = frame.schema["conversation"].dataType.simpleString()
    return frame.select("conversation", "formatted", "spans").mapInArrow(
        read,
        f"conversation {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint,"
        " loss_sha256 string, formatted_chars bigint",
    )
