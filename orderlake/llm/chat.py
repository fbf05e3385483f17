"""Chat formatting at the level of tokens (operator 12).

A turn becomes ``TURN role BODY text STOP``.  ``TURN``, ``BODY`` and ``STOP`` are reserved ids behind the
vocabulary: no text encodes to them, so a text cannot end its turn or open another one.
Role and text are encoded separately and the ids spliced; the ids of the segments of a turn,
the tokens before it in its conversation, and the loss mask all come from prefix sums over
segment lengths.

In print the reserved ids stand for ``### ``, ``: `` and ``</turn>`` with a line feed.  So that the
printed form can be read back too, control strings inside a text (``###``, ``</turn>`` and the special
tokens of the vocabulary; in a role also ``: ``) are broken by a backslash after their first
letter, and a backslash is written twice.

Rows are dealt out by range of (conversation, turn), so a conversation of any length spans
tasks; only its digests, which hash its turns in order, are one stream in one task, read
row by row.

Cases: a null role or text counts as empty; turns stand in the order of ``turn`` (null first),
equal ones by role, then by a digest of the text; rows without a conversation id form one
conversation whose id is null; an empty table gives no rows; other columns, whatever their
names, take no part.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm import bpe
from orderlake.llm.common import pieces
from orderlake.llm.scan import running

#: What the reserved ids stand for in print.
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: Control strings a text must not hold (beside the special tokens), and those of a role.
IN_TEXT = ("###", "</turn>")
IN_ROLE = (*IN_TEXT, COLON)
ESCAPED = re.compile(r"\\(.)", re.S)

FORMATTED = T.StructType([
    T.StructField("conversation", T.StringType()), T.StructField("conv_id", T.LongType()),
    T.StructField("one", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("loss_mask", T.ArrayType(T.ByteType()))])


class Template:
    """Writes and reads turns as ids of one vocabulary."""

    def __init__(self, codec: bpe.ByteBPE, learn: tuple[str, ...] = ("assistant",)):
        self.codec, self.learn = codec, frozenset(learn)
        self.turn = len(codec.text)
        self.body, self.stop = self.turn + 1, self.turn + 2
        self.text_marks = self._pattern((*IN_TEXT, *codec.special))
        self.role_marks = self._pattern((*IN_ROLE, *codec.special))

    @staticmethod
    def _pattern(controls) -> re.Pattern:
        """The first letter of every control string, overlapping ones too."""
        return re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls))

    @staticmethod
    def escape(text: str, marks: re.Pattern) -> str:
        return marks.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return ESCAPED.sub(r"\1", text)

    def write(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, loss mask) of one turn."""
        segments = [np.array([self.turn]), self._ids(self.escape(role, self.role_marks)),
                    np.array([self.body]), self._ids(self.escape(text, self.text_marks)), np.array([self.stop])]
        ends = np.cumsum([len(s) for s in segments])
        marks = np.zeros(ends[-1] + 1, np.int8)
        if role in self.learn:
            marks[ends[2]] += 1
            marks[ends[3]] -= 1
        return np.concatenate(segments).astype(np.int32), np.cumsum(marks[:-1], dtype=np.int8)

    def _ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.codec.encode(text), "<u4").astype(np.int64)

    def _text(self, ids: np.ndarray) -> str:
        return self.codec.decode(ids.astype("<u4").tobytes())

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, str]:
        """(role, text, text under the loss mask, printed form) of one turn."""
        body, stop = np.flatnonzero(ids == self.body), np.flatnonzero(ids == self.stop)
        if ids[0] != self.turn or len(body) != 1 or len(stop) != 1 or stop[0] != len(ids) - 1:
            raise ValueError("not one turn")
        role, text = self._text(ids[1:body[0]]), self._text(ids[body[0] + 1:stop[0]])
        printed = f"{OPEN}{role}{COLON}{text}{CLOSE}"
        return self.unescape(role), self.unescape(text), self.unescape(self._text(ids[mask == 1])), printed

    def parse(self, printed: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of a printed conversation."""
        out, at = [], 0
        while at < len(printed):
            colon, end = printed.index(COLON, at), printed.index(CLOSE, at)
            out.append((self.unescape(printed[at + len(OPEN):colon]),
                        self.unescape(printed[colon + len(COLON):end])))
            at = end + len(CLOSE)
        return out


def format_conversations(turns: DataFrame, vocabulary: str, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn of (conv_id, turn, role, text): ``conv_id``, ``turn_no`` from 0, ``token_start`` (tokens
    of the conversation before this turn), ``ids``, ``loss_mask`` (1 on the text of the roles in
    ``learn``)."""
    spec = turns.sparkSession.sparkContext.broadcast(bpe.read_spec(vocabulary))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("-")).alias("conversation"),
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.md5(text.cast("binary")).alias("digest"), F.monotonically_increasing_id().alias("number"))

    def write(batch):
        template = Template(bpe.load(spec.value), learn)
        for piece in pieces([batch], most=1 << 20, owner="bpe"):
            made = [template.write(r, t) for r, t in zip(piece.column("role").to_pylist(),
                                                         piece.column("text").to_pylist())]
            n = np.array([len(i) for i, _ in made], np.int64)
            off = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [piece.column("conversation"), piece.column("conv_id"), pa.array(np.ones(len(n), np.int64)),
                 pa.array(n), pa.ListArray.from_arrays(off, pa.array(np.concatenate([i for i, _ in made]))),
                 pa.ListArray.from_arrays(off, pa.array(np.concatenate([m for _, m in made])))],
                [f.name for f in FORMATTED.fields])

    return running(rows, "conversation", ["turn", "role", "digest", "number"], ["one", "n_tokens"],
                   label="chat", prepare=write, prepared=FORMATTED).select(
        "conv_id", F.col("one_before").alias("turn_no"), F.col("n_tokens_before").alias("token_start"),
        "ids", "loss_mask")


def read_turns(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """``conv_id``, ``turn_no``, ``role``, ``text``, ``loss_text`` and ``printed`` of every formatted turn, decoded from
    its ids."""
    spec = formatted.sparkSession.sparkContext.broadcast(bpe.read_spec(vocabulary))

    def read(batches):
        template = Template(bpe.load(spec.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, mask = part.column("ids"), part.column("loss_mask")
                rows = [template.read(ids[i].values.to_numpy(), mask[i].values.to_numpy())
                        for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), part.column("turn_no"),
                     *(pa.array([r[j] for r in rows], pa.string()) for j in range(4))],
                    ["conv_id", "turn_no", "role", "text", "loss_text", "printed"])

    return formatted.select("conv_id", "turn_no", "ids", "loss_mask").mapInArrow(
        read, "conv_id long, turn_no long, role string, text string, loss_text string, printed string")


def conversation_digests(read: DataFrame) -> DataFrame:
    """Per conversation: ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed of every turn),
    ``loss_chars``, ``loss_sha256``, ``formatted_chars``.  The turns stream by in order, hashed one at a time."""
    rows = read.select("conv_id", "turn_no", "role", "text", "loss_text", F.length("printed").alias("chars")) \
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")

    def digest(batches):
        now, state = None, None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "chars")]
            for conv, role, text, loss, chars in zip(*columns):
                if state is None or conv != now:
                    if state is not None:
                        done.append(_closed(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            if done:
                yield pa.RecordBatch.from_pylist(done, _DIGESTS)
        if state is not None:
            yield pa.RecordBatch.from_pylist([_closed(now, state)], _DIGESTS)

    return rows.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _closed(conv, state) -> dict:
    n, turns, loss_chars, loss, chars = state
    return dict(zip(_DIGESTS.names, (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)))
