"""Hierarchical multi-length packing of token sequences.

A document's ids (with one closing id) are cut into full windows of the
longest context; what remains is routed to the smallest context tier that
holds it. Tiers are packed from long to short: a window opens with its tier's
longest piece, its gap is filled with the largest pieces of this and shorter
tiers that fit, and a last gap by cutting one piece, so every window is
exactly full. The few tokens left at the end of a task are written as windows
of power-of-two lengths. Each tier's windows are then dealt to step groups in
snake order of their attention cost, so the groups of a flush cost alike.

Tier capacities are powers of two, hence no window needs padding. Every task
packs its own documents: there is no shuffle, memory is bounded by the buffer
(``BUFFER_TOKENS``), and a lost task repeats alone. ``sequence_id`` holds the
task's partition in its upper bits.

Defined results: a null or empty text has only the closing id; repeated rows
are packed each on its own; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import map_batches, pieces
from sentinela.llm.byte_bpe import PieceEncoder

TIERS = (128, 256, 512, 1024)
#: Tokens of waiting pieces that a task holds before it packs them.
BUFFER_TOKENS = 1 << 20
#: Windows of one tier that a step group takes from a flush.
GROUP_WINDOWS = 32
ID_BYTES = 4
CLOSING = (0).to_bytes(ID_BYTES, "little")


class Pool:
    """Waiting pieces ordered by length: (length, order of arrival, row, start, ids)."""

    def __init__(self):
        self.items: list[tuple] = []
        self.tokens = 0

    def add(self, item: tuple) -> None:
        bisect.insort(self.items, item)
        self.tokens += item[0]

    def extend(self, items: list[tuple]) -> None:
        self.items = sorted(self.items + items)
        self.tokens += sum(i[0] for i in items)

    def take(self, at: int) -> tuple:
        item = self.items.pop(at)
        self.tokens -= item[0]
        return item

    def largest_within(self, room: int) -> int:
        """Index of the longest piece of at most ``room`` tokens, or -1."""
        return bisect.bisect_right(self.items, (room, float("inf"))) - 1


class Packer:
    """Packs one task's documents; rows are (doc index, start, length, crc, sequence, offset, tier, group)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, group_windows: int = GROUP_WINDOWS):
        if list(tiers) != sorted(set(tiers)) or any(t & (t - 1) for t in tiers):
            raise ValueError("tiers must be ascending powers of two")
        self.tiers, self.top, self.group_windows = tiers, tiers[-1], group_windows
        self.pool = Pool()
        self.arrivals: list[tuple] = []
        self.waiting = 0
        self.windows: list[tuple[int, list[tuple]]] = []   # (capacity, pieces)
        self.serial = self.next_sequence = self.next_group = 0

    def add(self, row: tuple, ids: bytes) -> None:
        """A document: ``row`` is carried to its pieces; ``ids`` are 32-bit integers."""
        n = len(ids) // ID_BYTES
        full = n - n % self.top
        for start in range(0, full, self.top):
            self.windows.append((self.top, [(self.top, 0, row, start, ids[start * ID_BYTES:(start + self.top) * ID_BYTES])]))
        if n > full:
            self.arrivals.append((n - full, self._serial(), row, full, ids[full * ID_BYTES:]))
            self.waiting += n - full

    def _serial(self) -> int:
        self.serial += 1
        return self.serial

    def pack(self, last: bool = False) -> Iterator[tuple]:
        """Packs what waits into full windows; with ``last`` also the rest. Yields finished rows."""
        self.pool.extend(self.arrivals)
        self.arrivals, pool = [], self.pool
        while pool.items:
            capacity = next(t for t in self.tiers if t >= pool.items[-1][0])
            if pool.tokens < capacity:
                if not last:
                    break
                # Less than a window is left: cut it into powers of two.
                capacity = 1 << (pool.tokens.bit_length() - 1)
            self.windows.append((capacity, self._fill(capacity)))
        self.waiting = pool.tokens
        yield from self._deal()

    def _fill(self, capacity: int) -> list[tuple]:
        """Pieces that exactly fill a window; the pool holds at least that many tokens."""
        pool, out, room = self.pool, [], capacity
        while room:
            at = pool.largest_within(room)
            if at >= 0:
                out.append(pool.take(at))
            else:   # every piece is longer than the gap: cut the shortest
                length, _, row, start, ids = pool.take(0)
                out.append((room, 0, row, start, ids[:room * ID_BYTES]))
                pool.add((length - room, self._serial(), row, start + room, ids[room * ID_BYTES:]))
            room -= out[-1][0]
        return out

    def _deal(self) -> Iterator[tuple]:
        """Windows to step groups: per tier, by falling attention cost, in snake order."""
        by_tier: dict[int, list[list[tuple]]] = {}
        for capacity, parts in self.windows:
            by_tier.setdefault(capacity, []).append(parts)
        self.windows = []
        for capacity in sorted(by_tier, reverse=True):
            windows = sorted(by_tier[capacity], key=lambda w: -sum(p[0] * p[0] for p in w))
            groups = -(-len(windows) // self.group_windows)
            for i, parts in enumerate(windows):
                turn, place = divmod(i, groups)
                group = self.next_group + (groups - 1 - place if turn % 2 else place)
                offset = 0
                for length, _, row, start, ids in parts:
                    yield row, start, length, zlib.crc32(ids), self.next_sequence, offset, capacity, group, ids
                    offset += length
                self.next_sequence += 1
            self.next_group += groups


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         tiers: tuple[int, ...] = TIERS, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group (and ids).

    ``path`` names a tokenizers file. ``sequence_id`` and ``step_group`` are
    unique over the whole table.
    """
    kind = dict(df.dtypes)[id_col]
    schema = (f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              f"offset bigint, tier int, step_group bigint" + (", ids binary" if with_ids else ""))
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, types = PieceEncoder(path), Packer(tiers), None
        base = TaskContext.get().partitionId() << 40

        def written(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            block = list(rows)
            for at in range(0, len(block), 20_000):
                cols = [[], [], [], [], [], [], [], [], []]
                raw = []
                for (doc, tokens), start, length, crc, sequence, offset, tier, group, ids in block[at:at + 20_000]:
                    for col, value in zip(cols, (doc, start, length, crc, tokens, base + sequence, offset, tier, base + group)):
                        col.append(value)
                    raw.append(ids)
                arrays = [pa.array(c, t) for c, t in zip(cols, [types, *[pa.int64()] * 6, pa.int32(), pa.int64()])]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array(raw, pa.binary())] if with_ids else []), names=names)

        for whole in batches:
            types = whole.column(0).type
            for batch in pieces(whole, "text", 6 << 20):
                docs = batch.column(0).to_pylist()
                for doc, ids in zip(docs, enc.encode(batch.column(1))):
                    ids += CLOSING
                    packer.add((doc, len(ids) // ID_BYTES), ids)
                if packer.waiting >= BUFFER_TOKENS or len(packer.windows) >= 4096:
                    yield from written(packer.pack())
        if types is not None:
            yield from written(packer.pack(last=True))

    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(narrow, run, schema, ("vocabulary", path)).withColumnRenamed("id", id_col)
