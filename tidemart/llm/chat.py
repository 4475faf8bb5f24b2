"""Conversations rendered by a compiled chat template, with the spans a model shall learn.

A ``ChatFormat`` holds the template's source, its control strings and the pattern that reads turns
back. Rows of a conversation are brought together in order of ``turn`` and rendered by the closures
of ``templates``; texts are escaped, so that no text can end its turn or begin another one.

A conversation of more than ``SEGMENT`` turns is rendered in segments (blocks of turn numbers) by
several tasks, and any segment is cut into parts of about ``PART_CHARS`` characters, so that neither a
row nor a task grows with a conversation. How many turns lie before a segment comes from counts of
(conversation, segment), not from the texts. Templates that look at ``messages`` anywhere else than in
one loop cannot be split; their conversations are rendered whole.

Defined results: null texts and null roles are empty; an empty table gives no rows. Rows without a
conv_id are one conversation. Turns come in order of (turn, role, text), those without a number first;
repeated rows are turns of their own. Numbers may have gaps and be negative. Texts are rendered whole
whatever their length. Columns other than conv_id, turn, role and text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import stored
from tidemart.llm.templates import Escape, Output, Template

#: Turn numbers that share all but their last 12 bits are a segment; 4,096 of them at most.
SEGMENT_BITS = 12
SEGMENT = 1 << SEGMENT_BITS

#: A part is closed after the turn that reaches this many characters.
PART_CHARS = 1 << 20

#: Parts and turns handed to Spark at a time.
BATCH_CHARS, BATCH_ROWS = 1 << 23, 2_000


@dataclass(frozen=True)
class ChatFormat:
    source: str
    controls: tuple[str, ...]
    turn: str  # pattern of one turn with groups named by role, or role and text
    opening: str = ""  # what stands once before the first turn
    constants: dict = field(default_factory=dict)

    def compiled(self) -> Template:
        return Template(self.source, self.controls, self.constants)

    def turns(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of every turn of a formatted run of turns, unescaped."""
        at, pattern = len(self.opening) if text.startswith(self.opening) else 0, re.compile(self.turn, re.S)
        while at < len(text):
            m = pattern.match(text, at)
            if m is None:
                raise ValueError(f"no turn begins at {at}")
            groups = {k: Escape.undo(v) for k, v in m.groupdict().items() if v is not None}
            yield (groups["role"], groups["text"]) if "role" in groups else next(iter(groups.items()))
            at = m.end()


#: The control strings of two public chat formats. Roles without a mark of their
#: own are named between [ROLE] and [TEXT].
INST = ChatFormat(
    source="""{{ bos }}
{%- for m in messages -%}
  {%- if m.role == 'user' -%} [INST] {{ m.text | escape }} [/INST]
  {%- elif m.role == 'assistant' -%} {% generation %}{{ m.text | escape }}{% endgeneration %}{{ eos }}
  {%- else -%} [ROLE] {{ m.role | escape }} [TEXT] {{ m.text | escape }} [/TEXT]
  {%- endif -%}
{%- endfor -%}""",
    controls=("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/TEXT]"),
    turn=r"\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\] (?P<role>.*?) \[TEXT\] (?P<text>.*?) \[/TEXT\]|(?P<assistant>.*?)</s>",
    opening="<s>",
    constants={"bos": "<s>", "eos": "</s>"},
)

CHATML = ChatFormat(
    source="""{% for m in messages %}{{ start ~ m.role | escape }}<|im_sep|>
{%- if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}{{ end }}
{% endfor %}""",
    controls=("<|im_start|>", "<|im_sep|>", "<|im_end|>"),
    turn=r"<\|im_start\|>(?P<role>.*?)<\|im_sep\|>(?P<text>.*?)<\|im_end\|>\n",
    constants={"start": "<|im_start|>", "end": "<|im_end|>"},
)

FORMATTED = (
    "conv_id long, segment long, part int, is_first boolean, is_last boolean, n_turns long, text string, "
    "spans array<struct<start: long, end: long>>"
)


def formatted(conversations: DataFrame, chat: ChatFormat = INST) -> DataFrame:
    """Conversations as formatted texts, in parts: (conv_id, segment, part, is_first, is_last,
    n_turns, text, spans). ``spans`` are [start, end) in characters of the part's text."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    first = F.lit(-(1 << (63 - SEGMENT_BITS)) - 1)
    segment = F.coalesce(F.shiftright("turn", SEGMENT_BITS), first).alias("segment")
    if chat.compiled().splittable:
        counts = rows.groupBy("conv_id", segment).agg(F.count(F.lit(1)).alias("n"))
        conv = Window.partitionBy("conv_id")
        before = F.sum("n").over(conv.orderBy("segment").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
        long = counts.select("conv_id", "segment", before.alias("before"), F.sum("n").over(conv).alias("total")).where(F.col("total") > SEGMENT)
        r, s = rows.select("*", segment).alias("r"), stored(long, "long_conversations").alias("s")
        same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.segment") == F.col("s.segment"))
        rows = r.join(s, same, "left").select(
            "r.conv_id", F.coalesce("s.segment", F.lit(0)).alias("segment"), "turn", "role", "text",
            F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("total", F.lit(-1)).alias("total"))
    else:
        rows = rows.select("conv_id", F.lit(0).cast("long").alias("segment"), "turn", "role", "text",
                           F.lit(0).cast("long").alias("before"), F.lit(-1).cast("long").alias("total"))
    ordered = rows.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
    return ordered.mapInArrow(_render(chat), FORMATTED)


def _render(chat: ChatFormat):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, ready = chat.compiled(), _Rows(_FORMATTED_ARROW)
        for key, messages in _runs(batches):
            ready_rows = _split(template, key, messages) if template.splittable else _whole(template, key, messages)
            for row in ready_rows:
                yield from ready.add(row, len(row[6]))
        yield from ready.rest()

    return parts


_FORMATTED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("part", pa.int32()), ("is_first", pa.bool_()), ("is_last", pa.bool_()),
    ("n_turns", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def _runs(batches: Iterator[pa.RecordBatch]):
    """Rows that follow each other with one (conv_id, segment): the key with before and total, and
    an iterator over the messages, which must be used up before the next run."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    source = rows()
    row = next(source, None)
    while row is not None:
        key = row[0], row[1], row[5], row[6]

        def messages(key=key):
            nonlocal row
            while row is not None and (row[0], row[1]) == key[:2]:
                yield {"role": row[3], "text": row[4]}
                row = next(source, None)

        yield key, messages()


def _split(template: Template, key: tuple, messages: Iterator[dict]) -> Iterator[tuple]:
    """Parts of a segment, rendered turn by turn; only the message after the present one is held."""
    conv, segment, at, total = key
    part, first, message = 0, at == 0, next(messages)
    env, out = template.start(first)
    n = 0
    while message is not None:
        following = next(messages, None)
        last = following is None and total in (-1, at + 1)
        template.turn(env, out, message, at, last)
        at, n, message = at + 1, n + 1, following
        if last:
            template.end(env, out)
        if following is None or out.length >= PART_CHARS:
            yield conv, segment, part, first, last, n, out.text(), _spans(out)
            part, first, n = part + 1, False, 0
            env, out = template.start(False)


def _whole(template: Template, key: tuple, messages: Iterator[dict]) -> Iterator[tuple]:
    turns = list(messages)
    out = template.render(turns)
    yield key[0], key[1], 0, True, True, len(turns), out.text(), _spans(out)


def _spans(out: Output) -> list[dict]:
    return [{"start": a, "end": b} for a, b in out.spans]


class _Rows:
    """Rows waiting to become an Arrow batch."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, row: tuple, chars: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if self.chars >= BATCH_CHARS or len(self.rows) >= BATCH_ROWS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self.rows, self.chars = [], 0


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_PIECES = DIGESTS + ", segment long, part int, turns binary, loss binary"


def digests(parts: DataFrame, chat: ChatFormat = INST) -> DataFrame:
    """What can be read back from formatted texts, a row per conversation: turns and roles with
    their hash, and all text below the loss mask with its length and hash.

    A conversation in one part is hashed where it was rendered. The parts of a longer one pass on
    what they hold; a hash over them has to run through them in order, so one task reads them
    one after the other and keeps none.
    """
    pieces = parts.select("conv_id", "segment", "part", "is_first", "is_last", "n_turns", "text", "spans").mapInArrow(_read(chat), _PIECES)
    together = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "part")
    return together.mapInArrow(_hash_runs, DIGESTS)


_PIECES_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("segment", pa.int64()), ("part", pa.int32()),
    ("turns", pa.binary()), ("loss", pa.binary()),
])
_DIGESTS_ARROW = pa.schema(list(_PIECES_ARROW)[:6])


def _read(chat: ChatFormat):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = _Rows(_PIECES_ARROW)
        for batch in batches:
            for conv, segment, part, first, last, _, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = list(chat.turns(text))
                turns = "".join(f"{role}\n{said}\n" for role, said in found).encode()
                # The end of a turn is no part of a span, so spans are unescaped one by one.
                loss = "".join(Escape.undo(text[s["start"]:s["end"]]) for s in spans)
                whole, said = first and last, loss.encode()
                row = (conv, len(found), hashlib.sha256(turns).hexdigest() if whole else None, len(loss),
                       hashlib.sha256(said).hexdigest() if whole else None, len(text), segment, part,
                       None if whole else turns, None if whole else said)
                yield from ready.add(row, 0 if whole else len(turns) + len(said))
        yield from ready.rest()

    return read


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of a conversation, in order, become one row; whole conversations stay as they are."""
    ready, open_conv, sums, hashes = _Rows(_DIGESTS_ARROW), None, None, None

    def close():
        conv, (n, loss, chars), (turns, said) = open_conv[0], sums, hashes
        return conv, n, turns.hexdigest(), loss, said.hexdigest(), chars

    for batch in batches:
        for conv, n, turns_hash, loss_chars, loss_hash, chars, _, _, turns, loss in zip(
                *(c.to_pylist() for c in batch.columns), strict=True):
            if open_conv is not None and open_conv != (conv,):
                yield from ready.add(close(), 0)
                open_conv = None
            if turns_hash is not None:
                yield from ready.add((conv, n, turns_hash, loss_chars, loss_hash, chars), 0)
                continue
            if open_conv is None:
                open_conv, sums, hashes = (conv,), [0, 0, 0], (hashlib.sha256(), hashlib.sha256())
            sums = [a + b for a, b in zip(sums, (n, loss_chars, chars), strict=True)]
            hashes[0].update(turns)
            hashes[1].update(loss)
    if open_conv is not None:
        yield from ready.add(close(), 0)
    yield from ready.rest()
