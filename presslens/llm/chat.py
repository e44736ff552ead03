"""Conversations rendered by a compiled template, with the spans that a model is to learn.

Turns are sorted inside their conversation by turn, role and text and stream through the
template, so a conversation needs memory for one turn only. The output has one row per
conversation, or several parts in order where it is longer than `PART` characters; spans count
code points inside their part. Control strings inside texts are escaped by a backslash after
the `<` of `<|` (and one more where backslashes stand there), which is reversible; a role's
line feeds are written \\n before that.

Null texts and roles are empty, turns without conv_id are one conversation of null id,
null turns come first, repeated rows are turns of their own, an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslens.llm.template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
PART = 1 << 20
CHAT_TEMPLATE = (
    "{% for m in messages %}{{ '<|im_' ~ 'start|>' }}{{ m.role | role }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '<|im_' ~ 'end|>' }}\n{% endfor %}"
)
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


FILTERS = {"escape": escape, "role": escape_role}
FORMATTED = "conv_id long, part int, formatted string, learnt array<struct<start:int,end:int>>"


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _formatter(template: str, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, FILTERS)
        rows = _rows(batches, "conv_id", "role", "text")
        following = next(rows, None)
        pending: list[tuple] = []

        def batch() -> pa.RecordBatch:
            learnt = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            types = (pa.int64(), pa.int32(), pa.string(), learnt)
            columns = [pa.array(c, t) for c, t in zip(zip(*pending), types)]
            pending.clear()
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "formatted", "learnt"])

        while following is not None:
            conv = following[0]

            def messages():
                nonlocal following
                while following is not None and following[0] == conv:
                    yield {"role": following[1] or "", "text": following[2] or ""}
                    following = next(rows, None)

            texts, spans, size, part, opened = [], [], 0, 0, None
            for text, learnt in render({"messages": messages()}):
                if learnt and opened is None:
                    opened = size
                elif not learnt and opened is not None:
                    spans.append({"start": opened, "end": size})
                    opened = None
                if size > part_chars and opened is None:
                    pending.append((conv, part, "".join(texts), spans))
                    yield batch()
                    texts, spans, size, part = [], [], 0, part + 1
                texts.append(text)
                size += len(text)
            pending.append((conv, part, "".join(texts), spans))
            if len(pending) >= 200 or size > part_chars // 4:
                yield batch()
            while following is not None and following[0] == conv:  # a template may not read all
                following = next(rows, None)
        if pending:
            yield batch()

    return run


def format_chats(conversations: DataFrame, template: str = CHAT_TEMPLATE, part_chars: int = PART) -> DataFrame:
    """conv_id, part, formatted text and learnt spans, parts of a conversation in order."""
    compile_template(template, FILTERS)  # errors show here, not in a task
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_formatter(template, part_chars), FORMATTED)


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns and learnt text of each conversation from its formatted parts."""
    names = [c.split()[0] for c in READ.split(", ")]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    done: list[tuple] = []
    state = None

    def close() -> None:
        if state["rest"]:
            raise ValueError(f"conversation {state['conv']}: {state['rest'][:80]!r} is no turn")
        done.append(
            (state["conv"], state["turns"], state["text"].hexdigest(), state["loss"], state["learnt"].hexdigest(), state["chars"])
        )

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for conv, part, formatted, spans in _rows(batches, "conv_id", "part", "formatted", "learnt"):
        if part == 0:
            if state is not None:
                close()
            state = {"conv": conv, "turns": 0, "text": hashlib.sha256(), "loss": 0, "learnt": hashlib.sha256(), "chars": 0, "rest": ""}
        state["chars"] += len(formatted)
        for span in spans:
            text = unescape(formatted[span["start"] : span["end"]])
            state["loss"] += len(text)
            state["learnt"].update(text.encode("utf-8", "surrogatepass"))
        whole, at = state["rest"] + formatted, 0
        while whole.startswith(START, at) and (end := whole.find(END + "\n", at)) >= 0:
            role, _, text = whole[at + len(START) : end].partition("\n")
            turn = f"{unescape_role(role)}\n{unescape(text)}\n"
            state["text"].update(turn.encode("utf-8", "surrogatepass"))
            state["turns"] += 1
            at = end + len(END) + 1
        state["rest"] = whole[at:]
        if len(done) >= 2000:
            yield batch()
    if state is not None:
        close()
    if done:
        yield batch()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a formatted table holds; keeps to its partitions and order."""
    return formatted.mapInArrow(_read_back, READ)
