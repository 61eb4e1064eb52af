"""Chat formatting as prefix trees: shared first turns are emitted once, depth first."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import Encoder, default_vocabulary

START, END = "<|im_start|>", "<|im_end|>"
_MARK, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema([
    ("tree_id", pa.int64()), ("start", pa.int64()), ("position", pa.int64()), ("ids", pa.list_(pa.int32())),
    ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("attends", pa.list_(_SPAN)), ("conv_id", pa.int64()),
])
ROWS = (
    "tree_id long, start long, position long, ids array<int>, loss_start int, loss_end int, "
    "attends array<struct<start: long, end: long>>, conv_id long"
)
READ = "conv_id long, turns array<struct<role: string, text: string>>, loss_text string, formatted_chars long"
#: Depths at which the order of conversations follows their shared turns across partitions.
_LEVELS = (1, 2, 4, 8)


def escape(text: str) -> str:
    """One more backslash inside every ``<|``, ``<\\|``, ...: no text can hold a control string."""
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _encoded_turn(encoder: Encoder, role: str, text: str) -> tuple[list[int], int, int]:
    """Ids of one marked turn and the range of them that the loss covers."""
    head, body, foot = (
        x.tolist() for x in encoder.encode([f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"])
    )
    loss = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
    return head + body + foot, *loss


def _joined(spans: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    if spans and spans[-1][1] == start:
        return [*spans[:-1], (spans[-1][0], end)]
    return [*spans, (start, end)]


def prefix_trees(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", vocabulary: str | None = None,
) -> DataFrame:
    """Conversations as token streams of prefix trees, in depth-first order.

    Conversations that share their first turns are neighbours once sorted by their turns, so one
    pass with a stack of the open path emits every shared turn once. A row with ``ids`` is a
    turn: its tokens stand at ``start`` of the stream of ``tree_id``, their position ids count
    from ``position``, ``loss_start..loss_end`` (of ids) is trained on, and the turn attends to
    the stream intervals ``attends`` (its ancestors and itself). A row without ids ends the
    conversation ``conv_id``, which is what ``attends`` covers.

    The order is dealt out by range on hashes of the first turns and the id, so a first turn or
    whole conversation shared by very many is split; it then appears once per partition. Rows
    are ordered by turn, then role and text, so ties and repeated rows have a fixed order; null
    role or text is empty; a null conv_id is an id like others; other columns are ignored.
    """
    path = vocabulary or default_vocabulary()
    row = F.struct(
        F.col(turn).alias("n"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    whole = turns.select(F.col(conv_id).cast("long").alias("conv_id"), row.alias("row"))
    whole = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = whole.select(
        "conv_id", F.transform("rows", lambda r: F.struct(r["role"], r["text"])).alias("turns")
    )
    levels = [f"level{k}" for k in _LEVELS]
    whole = whole.withColumns({x: F.xxhash64(F.slice("turns", 1, k)) for x, k in zip(levels, _LEVELS)})
    # the number of partitions is the session's
    ordered = whole.repartitionByRange(*levels, "conv_id").sortWithinPartitions("level1", "turns", "conv_id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        tree = (TaskContext.get().partitionId() << 33) - 1
        open_path: list[tuple] = []  # (role, text), position after it, spans up to it
        end = 0
        for batch in batches:
            rows, size = [], 0
            for conv, conv_turns in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turns"))):
                keys = [(t["role"], t["text"]) for t in conv_turns]
                shared = 0
                while shared < min(len(keys), len(open_path)) and keys[shared] == open_path[shared][0]:
                    shared += 1
                if shared == 0:
                    tree, end = tree + 1, 0
                del open_path[shared:]
                for key in keys[shared:]:
                    ids, first, last = _encoded_turn(encoder, *key)
                    position, spans = open_path[-1][1:] if open_path else (0, [])
                    spans = _joined(spans, end, end + len(ids))
                    rows.append((tree, end, position, ids, first, last, spans, None))
                    size += len(ids)
                    end += len(ids)
                    open_path.append((key, position + len(ids), spans))
                rows.append((tree, end, open_path[-1][1], None, None, None, open_path[-1][2], conv))
                if size > 1_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    return ordered.select("conv_id", "turns").mapInArrow(walk, ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
    columns[6] = [[{"start": a, "end": b} for a, b in spans] for spans in columns[6]]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def read_back(trees: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Conversations from the rows of ``prefix_trees``, in the order in which it gave them.

    Only the ids, intervals and loss ranges are read: tokens are decoded, the template is
    parsed, and escapes are undone. The loss text is the decoded text under the loss ranges.
    """
    path = vocabulary or default_vocabulary()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        tree, nodes = None, []  # of the open path: start, end, turn, loss text, characters
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["tree_id"] != tree:
                    tree, nodes = row["tree_id"], []
                covered = [(s["start"], s["end"]) for s in row["attends"]]
                while nodes and not any(a <= nodes[-1][0] and nodes[-1][1] <= b for a, b in covered):
                    nodes.pop()
                if row["ids"] is not None:
                    ids, at = row["ids"], row["start"]
                    marked = encoder.decode(ids)
                    role, body = _TURN.fullmatch(marked).groups()
                    loss = unescape(encoder.decode(ids[row["loss_start"] : row["loss_end"]]))
                    turn = {"role": unescape_role(role), "text": unescape(body)}
                    nodes.append((at, at + len(ids), turn, loss, len(marked)))
                else:
                    if sum(b - a for a, b in covered) != sum(n[1] - n[0] for n in nodes):
                        raise ValueError("rows of a tree are missing or out of order")
                    found.append((
                        row["conv_id"], [n[2] for n in nodes], "".join(n[3] for n in nodes),
                        sum(n[4] for n in nodes),
                    ))
            columns = list(zip(*found)) if found else [()] * 4
            kinds = [pa.int64(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), pa.string(), pa.int64()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["conv_id", "turns", "loss_text", "formatted_chars"],
            )

    return trees.mapInArrow(read, READ)
