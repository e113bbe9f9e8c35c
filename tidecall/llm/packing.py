"""Cost-balanced packing of tokenized documents into sequences of one capacity."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidecall.llm.tokens import encoder

#: Relative cost of a token by itself and of a pair of tokens that attend to each other.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
ROWS_AT_ONCE = 64


class OpenSequences:
    """Sequences with room, by their room: a tree over all rooms with the cheapest sequence of each part.

    The cheapest one with room for a piece is found among all in as many steps as the capacity
    has bits. Equal costs go to the sequence that was opened first.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.by_room: dict[int, list[tuple[float, int]]] = {}
        self.cheapest: list[tuple[float, int] | None] = [None] * (2 * self.leaves)
        self.room = 0  # of all together

    def _update(self, room: int) -> None:
        at = self.leaves + room
        held = self.by_room.get(room)
        self.cheapest[at] = held[0] if held else None
        while at > 1:
            at >>= 1
            left, right = self.cheapest[2 * at], self.cheapest[2 * at + 1]
            self.cheapest[at] = left if right is None or (left is not None and left < right) else right

    def add(self, cost: float, sequence: int, room: int) -> None:
        heapq.heappush(self.by_room.setdefault(room, []), (cost, sequence))
        self.room += room
        self._update(room)

    def take(self, least: int) -> tuple[float, int, int] | None:
        """Remove the cheapest sequence with ``least`` room or more: its cost, number and room."""
        best, node = None, 0
        low, high = self.leaves + least, 2 * self.leaves
        while low < high:  # the parts of the tree that make up the rooms asked for
            if low & 1:
                if (x := self.cheapest[low]) is not None and (best is None or x < best):
                    best, node = x, low
                low += 1
            if high & 1:
                high -= 1
                if (x := self.cheapest[high]) is not None and (best is None or x < best):
                    best, node = x, high
            low, high = low >> 1, high >> 1
        if best is None:
            return None
        while node < self.leaves:
            node = 2 * node if self.cheapest[2 * node] == best else 2 * node + 1
        room = node - self.leaves
        heapq.heappop(self.by_room[room])
        self.room -= room
        self._update(room)
        return (*best, room)


class Packer:
    """Open sequences of one task.

    One with room stays open for the next block, so that only the last few of a task are padded.
    """

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open = OpenSequences(capacity)

    def cost(self, tokens: int) -> float:
        return LINEAR * tokens + QUADRATIC * tokens * tokens

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
        """Pieces ``(document, start, length, sequence, offset)`` of documents of these lengths."""
        capacity, out = self.capacity, []
        rest: list[tuple[int, int, int]] = []  # -length, document, start
        for i, n in enumerate(lengths):
            full = n - n % capacity
            for start in range(0, full, capacity):
                out.append((i, start, capacity, self._new(), 0))
            if n > full:
                rest.append((full - n, i, full))
        needed = sum(-x[0] for x in rest) - self.open.room
        for _ in range(-(-max(needed, 0) // capacity)):
            self.open.add(0.0, self._new(), capacity)
        heapq.heapify(rest)
        while rest:
            n, i, start = heapq.heappop(rest)
            n = -n
            # Where none has room for the whole, the cheapest one takes what it can.
            cost, sequence, room = self.open.take(n) or self.open.take(1)
            piece = min(n, room)
            out.append((i, start, piece, sequence, capacity - room))
            if piece < room:
                self.open.add(cost + self.cost(piece), sequence, room - piece)
            if piece < n:
                heapq.heappush(rest, (piece - n, i, start + piece))
        return out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    block_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``capacity`` tokens.

    A document is its token ids followed by ``end_id``. Within a task the documents are taken
    in blocks of about ``block_tokens``. A block's whole-capacity chunks become sequences by
    themselves; what is left of each document goes, in descending length, to the sequence with
    the lowest cost (linear plus quadratic in each piece, since attention stays inside a
    piece) that has room for it, whichever that is. A remainder that fits none is cut at the room of the
    cheapest. There are just as many sequences as the tokens need, and those with room stay
    open for the next block: all padding of a task is less than one sequence.

    Nothing is shuffled: a sequence holds documents of one input partition. Memory is bounded
    by a block and the longest document.

    Null and empty texts are one ``end_id``. Repeated rows are packed once each. An empty
    table gives no rows. Other columns are not read.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``; sequence
    ids are unique in the table, offsets gapless.
    """
    fields = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(name, T.LongType(), False) for name in fields]
    )
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        encode = encoder(tokenizer_path).encode

        def flush(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            rows = packer.place([len(x) // 4 for x in texts])
            columns = [
                [s for _, s, _, _, _ in rows],
                [n for _, _, n, _, _ in rows],
                [zlib.crc32(texts[i][4 * s : 4 * (s + n)]) for i, s, n, _, _ in rows],
                [len(texts[i]) // 4 for i, _, _, _, _ in rows],
                [q for _, _, _, q, _ in rows],
                [o for _, _, _, _, o in rows],
            ]
            key = pa.concat_arrays(ids).take(pa.array([r[0] for r in rows], pa.int64()))
            return pa.RecordBatch.from_arrays(
                [key, *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *fields]
            )

        ids, texts, tokens = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                ids.append(some.column(0))
                encoded = [encode(t or "") + end for t in some.column(1).to_pylist()]
                texts += encoded
                tokens += sum(map(len, encoded)) // 4
                if tokens >= block_tokens:
                    yield flush(ids, texts)
                    ids, texts, tokens = [], [], 0
        if texts:
            yield flush(ids, texts)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
