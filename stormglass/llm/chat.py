"""Chat formatting: a black-box template is rendered turn by turn, and the outputs are compared.

The template is any function from a list of (role, text) turns to a string. Nothing is assumed of it
but what the outputs show: turn k covers what output k adds to output k - 1, and a template whose
output k does not begin with output k - 1 has rewritten its history and is reported.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>"

_SPECIAL = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)

OUTPUT = (
    "conv_id bigint, n_turns bigint, formatted string, turn_spans array<struct<start:bigint,stop:bigint>>, "
    "loss_spans array<struct<start:bigint,stop:bigint>>, rewrites_at bigint"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("turn_spans", _SPANS),
    ("loss_spans", _SPANS), ("rewrites_at", pa.int64()),
])


def escape(text: str) -> str:
    """No control string is left in the result: a backslash is doubled, and one parts "<" from "|"."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _SPECIAL.sub(r"\1", text)


def marked_turns(turns: list[Turn]) -> str:
    """The template of the query: marks around each turn, texts escaped, line ends of roles as \\n."""
    return "".join(
        f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}{END}\n" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of marked_turns."""
    return [(_SPECIAL.sub(lambda m: "\n" if m[1] == "n" else m[1], role), unescape(text))
            for role, text in _TURN.findall(formatted)]


def _text_edges(render: Template, before: list[Turn], role: str) -> tuple[int, int]:
    """Characters that stand before and after the text of a next turn, found with two probe texts."""
    one, two = render([*before, (role, "a")]), render([*before, (role, "b")])
    return len(commonprefix([one, two])), len(commonprefix([one[::-1], two[::-1]]))


def render_spans(
    turns: list[Turn], render: Template, loss_role: str = "assistant",
) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]], int | None]:
    """Output, span of each turn, spans of the texts under the loss, first turn that rewrote history.

    Spans are code points of the whole output. After a rewrite, spans of earlier turns would be wrong,
    so the lists are empty then.
    """
    done, spans, loss = render([]), [], []
    for k in range(len(turns)):
        now = render(turns[:k + 1])
        if not now.startswith(done):
            return render(turns), [], [], k
        spans.append((len(done), len(now)))
        if turns[k][0] == loss_role:
            head, tail = _text_edges(render, turns[:k], loss_role)
            if head + tail > len(now) or head < len(done):
                return render(turns), [], [], k
            loss.append((head, len(now) - tail))
        done = now
    return done, spans, loss, None


def format_chats(turns: DataFrame, render: Template = marked_turns, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: text, turn spans, loss spans, first turn that rewrites history (or null).

    turns: conv_id, turn, role, text; other columns are ignored. Turns go by number (null first), ties by
    role and text; a repeated row is a turn of its own; null roles and texts are empty. Rows without a
    conv_id belong to no conversation and are formatted one by one. An empty table gives an empty table.
    Rendering every prefix costs the square of a conversation's turns, as the template is a black box.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                listed = [(t["role"] or "", t["text"] or "") for t in row["turns"]]
                text, spans, loss, rewrites = render_spans(listed, render, loss_role)
                pairs = [[{"start": a, "stop": b} for a, b in x] for x in (spans, loss)]
                rows.append({"conv_id": row["conv_id"], "n_turns": len(listed), "formatted": text,
                             "turn_spans": pairs[0], "loss_spans": pairs[1], "rewrites_at": rewrites})
            yield from pa.Table.from_pylist(rows, schema=_ARROW).to_batches()

    lone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    grouped = (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), lone.alias("lone"),
                     F.struct("turn", "role", "text").alias("t"))
        .groupBy("conv_id", "lone").agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", "turns")
    )
    return grouped.mapInArrow(run, OUTPUT)


def digest(formatted: DataFrame) -> DataFrame:
    """Figures of the outputs, read back from the text and its spans alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            out = {name: [] for name in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                         "formatted_chars")}
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read_back(text)
                said = "".join(unescape(text[s["start"]:s["stop"]]) for s in row["loss_spans"])
                all_turns = "".join(f"{role}\n{body}\n" for role, body in turns)
                for name, value in zip(out, (
                    row["conv_id"], len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(said),
                    hashlib.sha256(said.encode()).hexdigest(), len(text),
                ), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out)

    return formatted.mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint")
