"""Ids that micro-batches have stored, kept in few files however many batches there were.

A batch adds its ids as a piece of its own. When a batch number is a multiple
of a power of ``fan``, the ``fan`` pieces of the next smaller power before it
become one. So the ids before any batch lie in at most ``fan - 1`` pieces of
each power, and an id is written again once for each power only. A piece is
partitioned by a prefix of the hash of the ids; a lookup opens the prefixes
that its own ids have.

Which pieces exist follows from the batch number alone, so a batch that runs
again reads the same pieces and replaces what it wrote. The parts of a piece
go when the batch after the one that made it starts, since only then that
batch cannot run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift.sources.tables import delete

Piece = tuple[int, int]


def pieces_before(batch_id: int, fan: int) -> list[Piece]:
    """Pieces ``(first batch, batches)`` that hold all batches before this one, the largest first."""
    size = 1
    while size * fan <= batch_id:
        size *= fan
    out, at = [], 0
    while size:
        while at + size <= batch_id:
            out.append((at, size))
            at += size
        size //= fan
    return out


def pieces_made(batch_id: int, fan: int) -> list[Piece]:
    """Pieces that become complete when this batch starts, the smallest first."""
    out, size = [], fan
    while batch_id and batch_id % size == 0:
        out.append((batch_id - size, size))
        size *= fan
    return out


def parts_of(piece: Piece, fan: int) -> list[Piece]:
    first, size = piece
    return [(first + k * size // fan, size // fan) for k in range(fan)]


@dataclass(frozen=True)
class FoldedIds:
    """The id column ``key`` below a folder."""

    spark: SparkSession
    path: str
    key: str
    fan: int = 8
    prefixes: int = 64

    def prefix(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.prefixes)).cast("int")

    def _folder(self, piece: Piece) -> str:
        return f"{self.path}/first={piece[0]}/batches={piece[1]}"

    def _read(self, pieces: list[Piece]) -> DataFrame:
        schema = f"{self.key} string, first bigint, batches bigint, prefix int"
        if not pieces:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[self._folder(piece) for piece in pieces])

    def _write(self, ids: DataFrame, piece: Piece) -> None:
        spread = ids.select(self.key, self.prefix().alias("prefix")).hint("rebalance", "prefix")
        spread.write.mode("overwrite").partitionBy("prefix").parquet(self._folder(piece))

    def begin(self, batch_id: int) -> None:
        """Fold what this batch completes, and drop the parts of what the batch before it folded."""
        for piece in pieces_made(batch_id - 1, self.fan) if batch_id else []:
            for part in parts_of(piece, self.fan):
                delete(self.spark, self._folder(part))
        for piece in pieces_made(batch_id, self.fan):
            self._write(self._read(parts_of(piece, self.fan)), piece)

    def known(self, batch_id: int, ids: DataFrame) -> DataFrame:
        """Stored ids that may be among ``ids``: those under the same prefixes.

        The prefixes come to the driver; there are at most ``prefixes`` of them.
        """
        hit = [row["prefix"] for row in ids.select(self.prefix().alias("prefix")).distinct().collect()]
        return self._read(pieces_before(batch_id, self.fan)).where(F.col("prefix").isin(*hit)).select(self.key)

    def add(self, batch_id: int, ids: DataFrame) -> None:
        self._write(ids, (batch_id, 1))
