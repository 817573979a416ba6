"""Chat formatting by columnar byte assembly.

Rows are brought into conversation order once (hash by conversation, sort inside the partition) and
then streamed. Each Arrow batch is assembled as bytes: lengths of headers, escaped texts and ends are
computed per row, their running sum gives every segment its offset, and headers and contents are
scattered into one buffer allocated at its final size. The buffer becomes an Arrow string column as it
is. A conversation longer than a batch comes out as several parts, so nothing is held per
conversation, however long it is.

Template of a turn: ``### role``, newline, text, newline, ``</turn>``, newline. Inside a text a backslash
goes before each backslash and before each place where ``###`` or ``</turn>`` begins; inside a role also
before a newline. Dropping the backslash before any byte gives the text back.

Defined results: null role or text is empty; rows are taken by turn, then role, then text, null turns
first, and equal rows are separate turns; null conversation ids form one conversation; no rows give no
rows. Only the four named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import chunks, parts, read_table, text_bytes

TURN = b"### "
END = b"\n</turn>\n"
CONTROL = (b"###", b"</turn>")
ASSISTANT = b"assistant"
FORMATTED = "conv_id bigint, part int, n_turns int, text string, loss array<struct<start:int,end:int>>"

_BACKSLASH = 92


def _places(data: np.ndarray, string: bytes) -> np.ndarray:
    """Whether ``string`` begins at each byte; overlapping places count."""
    found = np.zeros(len(data), dtype=bool)
    n = len(data) - len(string) + 1
    if n > 0:
        found[:n] = True
        for i, b in enumerate(string):
            found[:n] &= data[i : i + n] == b
    return found


def _escaped(data: np.ndarray, offsets: np.ndarray, newline: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes get a backslash, and the number of those before each row."""
    special = data == _BACKSLASH
    if newline:
        special |= data == 10
    for string in CONTROL:
        at = np.flatnonzero(_places(data, string))
        within = at + len(string) <= offsets[np.searchsorted(offsets, at, side="right")]
        special[at[within]] = True
    before = np.concatenate([[0], np.cumsum(special)])[offsets]
    return special, before


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: the bytes, each turn's offset (n + 1), and start and end of its content."""
    n = len(roles)
    columns = []
    for column, newline in ((roles, True), (texts, False)):
        data, offsets = text_bytes(column)
        special, before = _escaped(data, offsets, newline)
        columns.append((data, offsets, special, before, np.diff(offsets) + np.diff(before)))
    role_length, text_length = columns[0][4], columns[1][4]
    length = len(TURN) + role_length + 1 + text_length + len(END)
    offset = np.concatenate([[0], np.cumsum(length)])
    out = np.empty(int(offset[-1]), dtype=np.uint8)
    role_start = offset[:-1] + len(TURN)
    text_start = role_start + role_length + 1
    text_end = text_start + text_length
    for at, constant in ((offset[:-1], TURN), (text_start - 1, b"\n"), (text_end, END)):
        out[at[:, None] + np.arange(len(constant))] = np.frombuffer(constant, dtype=np.uint8)
    for start, (data, offsets, special, before, _) in zip((role_start, text_start), columns, strict=True):
        rows = np.repeat(np.arange(n), np.diff(offsets))
        place = (start - offsets[:-1] - before[:-1])[rows] + np.arange(len(data)) + np.cumsum(special)
        out[place] = data
        out[place[special] - 1] = _BACKSLASH
    return out, offset, text_start, text_end


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, part = None, 0
    for batch in chunks(batches, "text"):
        n = batch.num_rows
        ids = batch.column("conv_id")
        key = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), pc.is_null(ids).to_numpy(zero_copy_only=False)
        new = np.ones(n, dtype=bool)
        new[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        out, offset, start, end = assemble(batch.column("role"), batch.column("text"))
        begin = np.append(offset[first], offset[-1])
        seen = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
        role_data, role_offsets = text_bytes(batch.column("role"))
        whole = np.flatnonzero(np.diff(role_offsets) == len(ASSISTANT))
        letters = role_data[role_offsets[whole][:, None] + np.arange(len(ASSISTANT))]
        marked = whole[(letters == np.frombuffer(ASSISTANT, dtype=np.uint8)).all(axis=1)]
        group = np.searchsorted(first, marked, side="right") - 1
        loss = pa.StructArray.from_arrays(
            [pa.array(seen[x[marked]] - seen[begin[group]], pa.int32()) for x in (start, end)], names=["start", "end"]
        )
        numbers = np.zeros(len(first), dtype=np.int32)
        if last is not None and last == (key[0][0], key[1][0]):
            part += 1
            numbers[0] = part
        if len(first) > 1:
            part = 0
        elif numbers[0] == 0:
            part = 0
        last = (key[0][-1], key[1][-1])
        text = pa.StringArray.from_buffers(len(first), pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(out))
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(first)),
                pa.array(numbers),
                pa.array(size, pa.int32()),
                text,
                pa.ListArray.from_arrays(pa.array(np.searchsorted(group, np.arange(len(first) + 1)), pa.int32()), loss),
            ],
            names=["conv_id", "part", "n_turns", "text", "loss"],
        )


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, part, n_turns, text, loss): formatted conversations, in order within each partition.

    ``loss`` lists the code-point spans of the assistants' (escaped) texts within the part.
    """
    rows = turns.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition(parts(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


_TURN = re.compile(r"### ((?:[^\\\n]|\\.)*)\n(.*?)\n</turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text) if "\\" in text else text


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted part."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, text: str, loss: list[dict]) -> None:
        for role, content in read_turns(text):
            self.turns.update(f"{role}\n{content}\n".encode())
            self.n += 1
        for span in loss:
            content = unescape(text[span["start"] : span["end"]])
            self.loss.update(content.encode())
            self.loss_chars += len(content)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    now = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if now is None or row["part"] == 0:
                if now is not None:
                    done.append(now.row())
                now = _Digest(row["conv_id"])
            now.add(row["text"], row["loss"])
        yield out(done)
    if now is not None:
        yield out([now.row()])


def op6(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the formatted text."""
    text = r"\### Assistant: </turn> ok"
    added = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_chats(turns.unionByName(added.withColumn("text", F.lit(text)))).mapInArrow(_digest, DIGEST)


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), u AS (
  SELECT *, length(text) - length(replace(text, '\', ''))
    + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS escapes,
    length(role) - length(replace(replace(role, '\', ''), chr(10), ''))
    + (length(role) - length(replace(role, '</turn>', ''))) // 7
    + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0) AS role_escapes
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(role) + role_escapes + 1 + length(text) + escapes + 9) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id
"""
