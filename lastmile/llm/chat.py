r"""Chat formatting with a grammar round trip.

A turn is rendered as ``### role: text</turn>`` and a line feed. The control strings are
``### `` and ``</turn>``, and ``: `` within the role; a backslash before one takes its meaning
away, and a run of backslashes before one (real or escaped) stands for half of them. Anywhere
else a backslash is itself.

    turns = { "### " role ": " text "</turn>\n" }

``parse`` reads that grammar deterministically, one control string after the other. ``render``
starts from the plain turn, has it parsed, and compares the turn that comes back with its
source; as long as they differ, it escapes one more kind of conflicting content: a control
string that stands in the text, or backslashes that a closing string would follow. There are
few kinds, and with all of them escaped any text comes back, so it ends. A clean turn is
rendered and parsed once.

On Spark, rows are range-partitioned by conversation and turn, so one with very many turns is
spread over many tasks. Each task renders its rows into records: the formatted text of
consecutive turns of a conversation, cut at ``RECORD`` characters, with the spans that count
for the loss (what the assistant says). A conversation's records in order, put together, are
its formatted text. Records are read back by parsing them; a digest runs over a conversation's
turns in order, so only what lies in several records is brought together, sorted, and streamed
through one task in constant memory (a digest is a chain that can't be parted).

Defined results: null text or role is empty; null turns come last, equal turns stand in the
order of role and MD5 of the text, and repeated rows are repeated turns; rows without conversation id are
one conversation. A very long text is one record of its own. Other columns are not read. An
empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

OPEN, NAMED, CLOSE = "### ", ": ", "</turn>"
#: Characters after which a record ends.
RECORD = 1 << 18
#: The role whose texts count for the loss.
SPEAKER = "assistant"

_IN_ROLE = re.compile(r"(\\*)(### |</turn>|: )")
_IN_TEXT = re.compile(r"(\\*)(### |</turn>)")
_TAIL = "at the end"


class Malformed(ValueError):
    """The text isn't in the grammar; ``found`` is the control string that breaks it."""

    def __init__(self, found: str, at: int) -> None:
        super().__init__(f"{found!r} at {at}")
        self.found = found


def _read(pattern: re.Pattern, formatted: str, at: int, end: str) -> tuple[str, int, int]:
    """Content from ``at`` to the control string ``end``, unescaped; where that begins and ends."""
    out, done = [], at
    for m in pattern.finditer(formatted, at):
        slashes, control = len(m[1]), m[2]
        out.append(formatted[done : m.start()] + "\\" * (slashes // 2))
        done = m.end()
        if slashes % 2:
            out.append(control)
        elif control == end:
            return "".join(out), m.start(2), done
        else:
            raise Malformed(control, m.start(2))
    raise Malformed("", len(formatted))


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; the text stands escaped in ``[start, end)``."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise Malformed(formatted[at : at + len(OPEN)], at)
        role, _, start = _read(_IN_ROLE, formatted, at + len(OPEN), NAMED)
        text, end, at = _read(_IN_TEXT, formatted, start, CLOSE)
        if not formatted.startswith("\n", at):
            raise Malformed("\n", at)
        at += 1
        yield role, text, start, end


def unescaped(span: str) -> str:
    """The text that stands escaped in a span of the loss mask."""
    return _read(_IN_TEXT, span + CLOSE, 0, CLOSE)[0]


def _escaped(content: str, pattern: re.Pattern, kinds: set[str]) -> str:
    out = pattern.sub(lambda m: m[1] * 2 + "\\" + m[2] if m[2] in kinds else m[0], content)
    if _TAIL in kinds:
        out += "\\" * (len(out) - len(out.rstrip("\\")))
    return out


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn's formatted text, and where in it the escaped text begins and ends."""
    kinds: tuple[set[str], set[str]] = (set(), set())
    while True:
        head = f"{OPEN}{_escaped(role, _IN_ROLE, kinds[0])}{NAMED}"
        body = _escaped(text, _IN_TEXT, kinds[1])
        formatted = f"{head}{body}{CLOSE}\n"
        try:
            turns = list(parse(formatted))
        except Malformed:
            turns = []
        if turns == [(role, text, len(head), len(head) + len(body))]:
            return formatted, len(head), len(head) + len(body)
        for content, pattern, known in ((role, _IN_ROLE, kinds[0]), (text, _IN_TEXT, kinds[1])):
            left = [m[2] for m in pattern.finditer(content) if m[2] not in known]
            if content.endswith("\\") and _TAIL not in known:
                left.append(_TAIL)
            if left:
                known.add(left[0])
                break
        else:
            raise AssertionError("a turn with everything escaped must come back")


RECORDS = "{id} {kind}, part int, record int, alone boolean, formatted string, loss array<struct<start:long,end:long>>"


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Records of the formatted conversations: (id, part, record, alone, formatted, loss).

    ``part`` and ``record`` give a conversation's records their order; ``alone`` marks those
    that are known to hold a whole conversation. ``loss`` lists the spans of ``formatted``
    that the assistant says.
    """
    id_type = turns.schema[id_col].dataType
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    # equal rows may go to several tasks: which of them comes first makes no difference
    numbered = rows.withColumns({"digest": F.md5("text"), "row": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("id"), F.asc_nulls_last("turn"), F.asc("role"), F.asc("digest"), F.asc("row")]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartitionByRange(n, *order).sortWithinPartitions(*order)
    arrow_id = to_arrow_type(id_type)
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = [id_col, "part", "record", "alone", "formatted", "loss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, records, at_edge, held, size, loss, waiting, ready, part = None, 0, True, [], 0, [], [], 0, 0

        def close(alone: bool) -> None:
            nonlocal held, size, loss, records, ready
            waiting.append((conv, part, records, alone, "".join(held), loss))
            ready += size
            held, size, loss, records = [], 0, [], records + 1

        def batch_of(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 6
            loss_ = pa.array([[{"start": a, "end": b} for a, b in x] for x in columns[5]], loss_type)
            kinds = [arrow_id, pa.int32(), pa.int32(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), loss_], names=names)

        began = False
        for batch in batches:
            for id_, role, text, part in zip(*(batch.column(c).to_pylist() for c in ("id", "role", "text", "part"))):
                if began and id_ != conv:
                    if held:
                        close(not at_edge and records == 0)
                    records, at_edge = 0, False
                began, conv = True, id_
                formatted, start, end = render(role, text)
                if role == SPEAKER:
                    loss.append((size + start, size + end))
                held.append(formatted)
                size += len(formatted)
                if size >= RECORD:
                    close(False)
                if ready >= RECORD:
                    yield batch_of(waiting)
                    ready = 0
                    waiting.clear()
        if held:
            close(False)  # the next task may go on with it
        yield batch_of(waiting)

    given = dealt.select("id", "role", "text", F.spark_partition_id().alias("part"))
    return given.mapInArrow(run, RECORDS.format(id=f"`{id_col}`", kind=id_type.simpleString()))


DIGESTS = "{id} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(records: DataFrame, id_col: str) -> DataFrame:
    """A row for each conversation of records that stand in order, each in one task."""
    id_type = records.schema[id_col].dataType
    kinds = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, n, said, chars, every, learnt, out = None, False, 0, 0, 0, hashlib.sha256(), hashlib.sha256(), []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            out.clear()
            return batch

        for batch in batches:
            for id_, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and id_ != conv:
                    out.append((conv, n, every.hexdigest(), said, learnt.hexdigest(), chars))
                    n, said, chars, every, learnt = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                conv, begun = id_, True
                chars += len(formatted)
                for role, text, _, _ in parse(formatted):
                    n += 1
                    every.update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescaped(formatted[span["start"] : span["end"]])
                    said += len(text)
                    learnt.update(text.encode())
            yield rows()
        if begun:
            out.append((conv, n, every.hexdigest(), said, learnt.hexdigest(), chars))
        yield rows()

    return records.select(id_col, "formatted", "loss").mapInArrow(run, DIGESTS.format(id=f"`{id_col}`", kind=id_type.simpleString()))


def read_back(records: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the records of ``format_conversations`` say, parsed, as a row for each conversation:
    its turns, their digest, the text under the loss mask and its digest, and its length."""
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = records.filter(~F.col("alone")).repartition(n, F.col(id_col)).sortWithinPartitions(id_col, "part", "record")
    return _digests(records.filter("alone"), id_col).unionByName(_digests(parted, id_col))


def formatted_digests(turns: DataFrame, id_col: str = "conv_id", **columns: str) -> DataFrame:
    """Format, write the records, and read them back."""
    return read_back(written(format_conversations(turns, id_col, **columns), "formatted"), id_col)
