"""Chat formatting by token-level assembly.

Every segment of a turn is encoded by itself and reserved ids are spliced in between, so no
text can produce a reserved id. Control strings inside a text get one backslash after their
first character (and one more where backslashes stand there already), which undoes without
loss. A turn's loss mask is the prefix sum of +1 at the start and -1 at the end of each segment
that is learned.

Template: ``<s>`` opens a conversation; ``[INST]text[/INST]`` is a user's turn, ``text</s>`` an
assistant's, ``[SYS]text[/SYS]`` the system's, ``[ROLE]role[SEP]text[/ROLE]`` any other's. Only
the text of an assistant's turn is learned.

Null texts and roles are empty. Very long texts are encoded whole. Turns of equal number are ordered by role, then by a hash of the
text; a null turn comes first, rows without a conversation id form one conversation. An empty table gives an empty
output. Columns other than the four are not used.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[SEP]", "[/ROLE]"]
ANY_CONTROL = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(ANY_CONTROL)
_UNESCAPE = re.compile(ANY_CONTROL.replace(r"\\*", r"\\+"))

FORMATTED = "conv_id long, part int, turn long, role string, tie long, ids array<int>, mask array<tinyint>"


def escaped(text: str) -> str:
    if "<" not in text and "[" not in text:
        return text
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescaped(text: str) -> str:
    if "\\" not in text:
        return text
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


class Template:
    """Encodes turns and reads them back with a byte-level vocabulary of ranks; reserved ids
    follow the vocabulary's last.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1
        self.reserved = {c: self.first + i for i, c in enumerate(CONTROLS)}
        self.control = {i: c for c, i in self.reserved.items()}

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self._encoding.decode_bytes(ids).decode()

    def turn(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of one turn."""
        body = escaped(text)
        if role == "user":
            parts = ["[INST]", (body, False), "[/INST]"]
        elif role == "assistant":
            parts = [(body, True), "</s>"]
        elif role == "system":
            parts = ["[SYS]", (body, False), "[/SYS]"]
        else:
            parts = ["[ROLE]", (escaped(role), False), "[SEP]", (body, False), "[/ROLE]"]
        ids: list[int] = []
        steps = []
        for part in parts:
            if isinstance(part, str):
                ids.append(self.reserved[part])
                continue
            start = len(ids)
            ids += self.encode(part[0])
            if part[1]:
                steps.append((start, len(ids)))
        change = np.zeros(len(ids) + 1, np.int8)
        for start, end in steps:
            change[start] += 1
            change[end] -= 1
        return np.array(ids, np.int32), np.cumsum(change[:-1], dtype=np.int8)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str | None, str, int, list[str]]:
        """Role, text, formatted length, and the learned texts of one part; the opening of a
        conversation has no role.
        """
        role, texts, chars, start = "assistant", [], 0, 0
        runs: dict[tuple[int, int], str] = {}  # between reserved ids, decoded once
        for stop in [*np.flatnonzero(ids >= self.first).tolist(), len(ids)]:
            text = runs[start, stop] = self.decode(ids[start:stop].tolist()) if stop > start else ""
            control = self.control[int(ids[stop])] if stop < len(ids) else ""
            chars += len(text) + len(control)
            if control in ("[/INST]", "</s>", "[/SYS]", "[SEP]", "[/ROLE]"):
                texts.append(unescaped(text))
                role = {"[/INST]": "user", "[/SYS]": "system", "[/ROLE]": texts[0]}.get(control, role)
            start = stop + 1
        m = np.diff(np.concatenate([[0], mask, [0]]))
        learned = []
        for a, b in zip(np.flatnonzero(m == 1).tolist(), np.flatnonzero(m == -1).tolist()):
            text = runs.get((a, b))
            learned.append(unescaped(self.decode(ids[a:b].tolist()) if text is None else text))
        return (role, texts[-1], chars, learned) if texts else (None, "", chars, learned)


@lru_cache(maxsize=2)
def _template(path: str, pattern: str) -> Template:
    return Template(path, pattern)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [flat[x:y] for x, y in zip(at[:-1], at[1:])]


def formatted(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per part of a conversation, its ids and its mask: part 0 opens it, part 1 are the
    turns, in the order of turn, role, tie.

    Every row is made by itself and nothing is shuffled but conversation ids, so a conversation
    that holds a third of all turns is split like any other.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = _template(path, pattern)
        for b in batches:
            made = [
                template.turn(r or "", t or "") if p else (np.array([template.reserved["<s>"]], np.int32), np.zeros(1, np.int8))
                for p, r, t in zip(b["part"].to_pylist(), b["role"].to_pylist(), b["text"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in ("conv_id", "part", "turn", "role", "tie")],
                 _lists([x for x, _ in made], pa.int32()), _lists([m for _, m in made], pa.int8())],
                ["conv_id", "part", "turn", "role", "tie", "ids", "mask"])

    conv, turn = F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")
    none = F.lit(None).cast("string")
    rows = turns.select(conv, F.lit(1).alias("part"), turn, "role", F.xxhash64("text").alias("tie"), "text")
    heads = turns.select(conv).distinct().select(
        "conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("turn"), none.alias("role"),
        F.lit(0).cast("long").alias("tie"), none.alias("text"))
    return rows.unionByName(heads).mapInArrow(encode, FORMATTED)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_tokens long")


def digests(output: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per conversation, read back from its ids and masks alone.

    A digest is made in order, so a conversation is read by one task; its rows pass by one
    after the other and only the state of two digests is held.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, rows, key, state = _template(path, pattern), [], object(), None

        def done() -> tuple:
            return (key, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(),
                    state["chars"], state["tokens"])

        for b in batches:
            for conv, ids, mask in zip(b["conv_id"].to_pylist(), _arrays(b["ids"]), _arrays(b["mask"])):
                if state is None or conv != key:
                    if state is not None:
                        rows.append(done())
                    key = conv
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0,
                             "chars": 0, "tokens": 0}
                role, text, chars, learned = template.read(ids, mask)
                if role is not None:
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                for piece in learned:
                    state["loss"].update(piece.encode())
                    state["loss_chars"] += len(piece)
                state["chars"] += chars
                state["tokens"] += len(ids)
            if rows:
                yield _rows(rows)
                rows = []
        if state is not None:
            yield _rows([done()])

    placed = output.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "part", "turn", "role", "tie")
    return placed.select("conv_id", "ids", "mask").mapInArrow(read, DIGEST)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in DIGEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
