"""Chat formatting in budgeted windows.

Each turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside a role or text are
escaped by a backslash after their first character; a control string that has backslashes there
already gets one more, so unescaping is exact. A long conversation becomes several windows of at
most ``budget`` tokens. The prefix sums of its turns' tokens say where windows can end, always between
turns. Each later window repeats the leading system turn, if it and the window's first own turn fit the
budget together, and up to ``history`` tokens of the turns just before it; the loss mask covers the
assistants' texts, but never repeated ones, so each is learned once. A turn that is longer than the
budget is a window of its own, with nothing repeated; no other window passes the budget. A system turn that
fills the budget is never repeated.

Scale: prefix sums over a conversation of any length come from two levels, sums of blocks of turns and
sums within a block. The prefix also deals a conversation into *segments* of ``segment`` budgets;
each segment is cut into windows by itself, together with copies of the system turn and of the turns
just before it. So no task holds more than one block or segment, also if one conversation holds a
third of all turns. Only the digest of a whole conversation, which is sequential by nature, is read
in one task; it streams over sorted windows and holds one of them.

Defined results: null text and role count as empty; turns are ordered by turn (null first), role and
text, so repeated rows keep together; a null ``conv_id`` is a conversation like others; a system turn
leads only if it is the first; other system turns are ordinary; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lineforge.llm.tables import written
from lineforge.llm.tokens import fast_tokenizer

# The template's marks, and strings that other templates give a meaning.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_REST})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_REST})")


@dataclass(frozen=True)
class ChatSettings:
    budget: int = 2048
    history: int = 512
    # Budgets per segment, turns per block of the prefix sums.
    segment: int = 64
    block: int = 256


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(role: str, text: str) -> str:
    """A turn; a line break in the role is written as ``\\n``."""
    name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    return f"{START}{name}\n{escape(text)}{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted string."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        role = unescape(formatted[at + len(START) : line])
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
        turns.append((role, unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def with_tokens(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """conv_id, turn, role, text and the number of ``tokens`` of the rendered turn."""
    plain = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = fast_tokenizer(tokenizer_path)
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            sizes = [len(encode(render(r, t))) for r, t in zip(roles, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "tokens"])

    return plain.mapInArrow(count, T.StructType([*plain.schema.fields, T.StructField("tokens", T.LongType())]))


def with_prefix(turns: DataFrame, settings: ChatSettings) -> DataFrame:
    """``prefix``: tokens of the conversation before the turn; ``total``: all of its tokens. Runs a job."""
    blocked = turns.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / settings.block))
    sums = written(blocked.groupBy("conv_id", "block").agg(F.sum("tokens").alias("own")), "blocks")
    conv = Window.partitionBy("conv_id")
    before = conv.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("own").over(before), F.lit(0)).alias("offset"),
        F.sum("own").over(conv).alias("total"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    order = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    inside = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocked.join(offsets, same).withColumn("prefix", F.col("offset") + inside).drop("c", "b", "block", "offset")


def in_segments(turns: DataFrame, settings: ChatSettings) -> DataFrame:
    """Each turn in its segment, as history in the next one, and a system turn below the budget in all later ones."""
    size = settings.budget * settings.segment
    own = F.floor(F.col("prefix") / size).cast("int")
    last = F.floor((F.col("total") - 1) / size).cast("int")
    after = F.col("prefix") + F.col("tokens")
    system = (F.col("prefix") == 0) & (F.col("role") == "system")
    place = lambda segment, kind: F.struct(segment.alias("segment"), F.lit(kind).alias("kind"))
    places = F.concat(
        F.array(place(own, "own")),
        F.when(~system & (own < last) & (after > (own + 1) * size - settings.history), F.array(place(own + 1, "history"))).otherwise(
            F.array().cast("array<struct<segment:int,kind:string>>")
        ),
        F.when(system & (F.col("tokens") < settings.budget) & (last > own), F.transform(F.sequence(own + 1, last), lambda s: place(s, "system"))).otherwise(
            F.array().cast("array<struct<segment:int,kind:string>>")
        ),
    )
    return turns.select("conv_id", "role", "text", "tokens", "prefix", F.inline(places))


WINDOW = "segment int, window int, formatted string, loss array<struct<start:int,stop:int>>, repeated int, tokens long"


class Turn(NamedTuple):
    """A turn as one segment has it."""

    role: str
    text: str
    tokens: int
    prefix: int
    kind: str


def cut_windows(rows: list[Turn], settings: ChatSettings) -> list[tuple]:
    """(window, formatted, loss spans, number of repeated turns, tokens) of one segment, its turns by ``prefix``."""
    own = [r for r in rows if r.kind == "own"]
    earlier = [r for r in rows if r.kind == "history"]
    lead = [r for r in rows if r.kind == "system"]
    if own and own[0].prefix == 0 and own[0].role == "system":
        lead = own[:1]
    sums = np.concatenate([[0], np.cumsum([r.tokens for r in own])])
    out, first = [], 0
    while first < len(own):
        repeated = [r for r in lead if r is not own[first] and r.tokens + own[first].tokens <= settings.budget]
        room = settings.budget - sum(r.tokens for r in repeated)
        history: list = []
        left = min(settings.history, room - own[first].tokens)
        for r in reversed(earlier + own[:first]):
            if r.tokens > left or r in lead:
                break
            history.insert(0, r)
            left -= r.tokens
        room -= sum(r.tokens for r in history)
        # The last turn whose sum from here is within the room; at least one.
        last = max(first + 1, int(np.searchsorted(sums, sums[first] + room, "right")) - 1)
        repeated += history
        text, loss = "".join(render(r.role, r.text) for r in repeated), []
        for r in own[first:last]:
            turn = render(r.role, r.text)
            if r.role == "assistant":
                begin = len(text) + turn.index("\n") + 1
                loss.append((begin, len(text) + len(turn) - len(END) - 1))
            text += turn
        used = sum(r.tokens for r in repeated) + int(sums[last] - sums[first])
        out.append((len(out), text, loss, len(repeated), used))
        first = last
    return out


def format_chats(turns: DataFrame, tokenizer_path: str, settings: ChatSettings = ChatSettings()) -> DataFrame:
    """One row per window: the formatted text, spans under the loss mask (code points), repeated turns."""
    counted = written(with_tokens(turns, tokenizer_path), "turns")
    placed = in_segments(with_prefix(counted, settings), settings)
    key = turns.select("conv_id").schema.fields
    schema = T.StructType([*key, *T.StructType.fromDDL(WINDOW).fields])
    columns = ["conv_id", "segment", "role", "text", "tokens", "prefix", "kind"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            out = []
            for conv, segment, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (conv, segment) != at:
                    out += [(*at, *window) for window in cut_windows(held, settings)]
                    held = []
                at = (conv, segment)
                held.append(Turn(*turn))
            if out:
                yield as_batch(out, batch.schema.field(0).type)
        # A segment without turns of its own, only copies, has no windows.
        out = [(*at, *window) for window in cut_windows(held, settings)] if held else []
        if out:
            yield as_batch(out, batch.schema.field(0).type)

    spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def as_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        conv, segment, number, text, loss, repeated, tokens = zip(*rows, strict=True)
        marks = [[{"start": a, "stop": b} for a, b in x] for x in loss]
        arrays = [
            pa.array(conv, kind),
            pa.array(segment, pa.int32()),
            pa.array(number, pa.int32()),
            pa.array(text, pa.string()),
            pa.array(marks, spans),
            pa.array(repeated, pa.int32()),
            pa.array(tokens, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    dealt = placed.select(*columns).repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "prefix")
    return dealt.mapInArrow(cut, schema)


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_chats(windows: DataFrame) -> DataFrame:
    """Per conversation, from formatted windows alone: its turns and the text under the loss mask."""
    key = windows.select("conv_id").schema.fields
    schema = T.StructType([*key, *T.StructType.fromDDL(DIGEST).fields])
    columns = ["conv_id", "formatted", "loss", "repeated"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, state = none, None

        def row() -> tuple:
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                own, formatted, loss, repeated = (batch.column(c)[i].as_py() for c in range(4))
                if own != conv or conv is none:
                    if conv is not none:
                        rows.append(row())
                    conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["stop"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=arrow)
        if conv is not none:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row(), strict=True))], schema=arrow)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window").select(*columns)
    return ordered.mapInArrow(read, schema)
