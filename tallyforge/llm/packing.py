"""Vector bin packing of examples into training sequences (operator 1).

Each sequence has three limits at once: tokens, segments and loss-bearing
tokens. The open sequence takes the waiting piece whose demand has the largest
dot product with what is left of the limits; where none fits, the best piece is
cut. Packing runs within a partition over a bounded pool, so nothing is
shuffled and memory does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import bound_batches
from tallyforge.llm.tokens import encoder, tokenizer_path

#: sequence_id = partition * 2**36 + number within the partition
PARTITION_SHIFT = 36

SCHEMA = "doc_id long, start long, length long, ids binary, loss_tokens long, doc_tokens long, sequence_id long, offset long, segment long"


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    loss: np.ndarray | None  # None: every token bears loss
    doc_tokens: int

    @property
    def loss_tokens(self) -> int:
        return len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> tuple[Piece, Piece]:
        a, b = (None, None) if self.loss is None else (self.loss[:n], self.loss[n:])
        return Piece(self.doc_id, self.start, self.ids[:n], a, self.doc_tokens), Piece(self.doc_id, self.start + n, self.ids[n:], b, self.doc_tokens)

    def most(self, tokens: int, loss_tokens: int) -> int:
        """The longest prefix within both limits."""
        n = min(tokens, len(self.ids))
        if self.loss is None:
            return min(n, loss_tokens)
        return min(n, int(np.searchsorted(np.cumsum(self.loss), loss_tokens, side="right")))


class Packer:
    """Fills one sequence after another from a pool of pieces."""

    def __init__(self, limits: Limits, cuttable: bool = True):
        self.limits, self.cuttable = limits, cuttable
        self.scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.open: list[Piece] = []
        self.left = self.scale.copy()

    def pack(self, pool: list[Piece]) -> Iterator[list[Piece]]:
        """Place all of ``pool``; yields the sequences that are closed."""
        waiting = list(pool)
        demand = np.array([[len(p.ids), 1, p.loss_tokens] for p in waiting], float).reshape(-1, 3)
        alive = np.ones(len(waiting), bool)
        while alive.any():
            fits = alive & (demand <= self.left).all(axis=1)
            score = (demand / self.scale) @ (self.left / self.scale)
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1.0)))
                alive[k] = False
                self._take(waiting[k])
            else:
                k = int(np.argmax(np.where(alive, score, -1.0)))
                n = waiting[k].most(int(self.left[0]), int(self.left[2])) if self.cuttable and self.left[1] >= 1 else 0
                if n:
                    head, waiting[k] = waiting[k].cut(n)
                    demand[k] = len(waiting[k].ids), 1, waiting[k].loss_tokens
                    self._take(head)
                elif self.open:
                    yield self._close()
                    continue
                else:
                    raise ValueError(f"document {waiting[k].doc_id} does not fit a sequence and must not be cut")
            if self.left[0] < 1 or self.left[1] < 1:
                yield self._close()

    def rest(self) -> Iterator[list[Piece]]:
        if self.open:
            yield self._close()

    def _take(self, piece: Piece) -> None:
        self.open.append(piece)
        self.left -= (len(piece.ids), 1, piece.loss_tokens)

    def _close(self) -> list[Piece]:
        done, self.open, self.left = self.open, [], self.scale.copy()
        return done


def without_padding(sequence: list[Piece], most: int) -> Iterator[list[Piece]]:
    """Cut a short sequence into sequences whose lengths are powers of two."""
    pieces, total = list(sequence), sum(len(p.ids) for p in sequence)
    if total == most:
        yield pieces
        return
    while total:
        want, part = 1 << (total.bit_length() - 1), []
        total -= want
        while want:
            piece = pieces.pop(0)
            if len(piece.ids) > want:
                piece, after = piece.cut(want)
                pieces.insert(0, after)
            part.append(piece)
            want -= len(piece.ids)
        yield part


def _pack_partition(path: str, limits: Limits, end_id: int, cuttable: bool, pool_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << PARTITION_SHIFT
        encode, packer, count = encoder(path).encode, Packer(limits, cuttable), 0
        rows: list[tuple] = []

        def number(sequences: Iterator[list[Piece]]) -> None:
            nonlocal count
            for closed in sequences:
                for part in without_padding(closed, limits.tokens) if cuttable else (closed,):
                    offset = 0
                    for k, p in enumerate(part):
                        rows.append((p.doc_id, p.start, len(p.ids), p.ids.tobytes(), p.loss_tokens, p.doc_tokens, base + count, offset, k))
                        offset += len(p.ids)
                    count += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 9
            rows.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 5
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        pool: list[Piece] = []
        waiting = 0
        for batch in batches:
            has_loss = batch.num_columns > 2
            for i in range(batch.num_rows):
                ids = np.append(encode(batch[1][i].as_py()), np.uint32(end_id)).astype("<u4")
                loss = None
                if has_loss:
                    first = batch[2][i].as_py() or 0  # tokens before it (the prompt) bear no loss
                    loss = np.arange(len(ids)) >= first
                piece = Piece(batch[0][i].as_py(), 0, ids, loss, len(ids))
                if cuttable and loss is None and limits.loss_tokens >= limits.tokens:
                    while len(piece.ids) >= limits.tokens:  # a whole sequence by itself
                        head, piece = piece.cut(limits.tokens)
                        number(iter([[head]]))
                if len(piece.ids):
                    pool.append(piece)
                    waiting += len(piece.ids)
                if waiting >= pool_tokens:
                    number(packer.pack(pool))
                    pool, waiting = [], 0
                if len(rows) >= 4096:
                    yield flush()
        number(packer.pack(pool))
        number(packer.rest())
        if rows:
            yield flush()

    return run


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", loss_start_col: str | None = None, path: str | None = None, limits: Limits = Limits(), end_id: int = 0, cuttable: bool = True, pool_tokens: int = 1 << 18) -> DataFrame:
    """Pack whole texts into sequences; one row per piece of a document.

    A document is its ids and then ``end_id``; null text counts as empty, so
    every row gets a piece, repeated rows and null ids included. With
    ``cuttable`` documents may be cut anywhere and each id lies in one piece;
    without it each example stays whole, and one that exceeds a limit raises
    ValueError. ``loss_start_col`` holds the first loss-bearing token (null: 0);
    without it all tokens bear loss. ``ids`` are little-endian unsigned 32-bit.
    Other input columns are not read. An empty table gives no rows. A sequence
    that cannot be filled is cut into lengths that are powers of two.
    """
    bound_batches(docs.sparkSession)
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    if loss_start_col:
        columns.append(F.col(loss_start_col).cast("long").alias("loss_start"))
    run = _pack_partition(path or tokenizer_path(), limits, end_id, cuttable, pool_tokens)
    return docs.select(*columns).mapInArrow(run, SCHEMA)
