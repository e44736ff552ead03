"""Exact duplicates by two passes over a Bloom filter.

The first pass puts every text hash into a filter whose cells count to two: tasks count their
own cells, the counts of a filter segment are added up in one small group, and only the bit
"reached twice" is kept. A hash that occurs twice has all its cells at two. The second pass
tests each row: rows that fail pass straight through as their own group, only possibly
repeated ones shuffle to be grouped by the full SHA-256 hash. The filter has 16 cells per row
up to `max_filter_bytes`; on more rows than that its false alarms rise, so more rows
shuffle, and the result is the same.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts
the largest doc_id stays; a row without doc_id stays only where no equal text has one. Rows
that share text and largest doc_id are all marked kept; `keep_one` returns one of them. An
empty table gives an empty result, other columns are carried only by `keep_one`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType

from presslens.llm import textkit
from presslens.llm.rows import row_hash, unused
from presslens.sources.storage import write_table

PROBES = 4
CELLS_PER_ROW = 16
SEGMENT_BITS = 19  # cells of a segment: 64 KB once packed
MAX_FILTER_BYTES = 256 << 20
RUN_BYTES = 4 << 20  # hashes counted at a time
TEST_BYTES = 1 << 20  # hashes tested at a time


def _sha256(text: pa.Array) -> list[bytes]:
    return [hashlib.sha256(t.lower()).digest() for t in textkit.as_bytes(text)]


@F.arrow_udf(BinaryType())
def normalised_sha256(text: pa.Array) -> pa.Array:
    """SHA-256 of the UTF-8 text with A-Z lower-cased."""
    return pa.array(_sha256(text), pa.binary())


def _cells(packed: list[bytes], width: int, bits: int) -> np.ndarray:
    """PROBES distinct cells of each hash; hashes are records of `width` bytes, packed."""
    words = np.frombuffer(b"".join(packed), "<u8").reshape(-1, width // 8)
    step = words[:, 1:2] if width > 8 else textkit.mix(words)
    probes = words[:, :1] + np.arange(PROBES, dtype=np.uint64) * (step | np.uint64(1))
    return (probes & np.uint64((1 << bits) - 1)).astype(np.int64)


def _count_cells(width: int, bits: int):
    """Per run of rows and segment: cells reached once and cells reached more often."""

    def counted(packed: list[bytes]) -> Iterator[pa.RecordBatch]:
        reached, times = np.unique(_cells(packed, width, bits), return_counts=True)
        segments = reached >> SEGMENT_BITS
        edges = np.flatnonzero(np.diff(segments)) + 1
        for part, n in zip(np.split(reached, edges), np.split(times, edges)):
            local = (part & ((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
            row = [int(part[0] >> SEGMENT_BITS)], [local[n == 1].tobytes()], [local[n > 1].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["segment", "once", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                held.append(packed)
                size += len(packed)
                if size > RUN_BYTES:
                    yield from counted(held)
                    held, size = [], 0
        if size:
            yield from counted(held)

    return run


def _merge(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmap of the cells of one segment that were reached twice."""
    counts = np.zeros(1 << SEGMENT_BITS, np.uint8)
    segment = None
    for batch in tables:
        for number, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
            segment = number
            at = np.frombuffer(once, np.uint32)
            counts[at] = np.minimum(counts[at] + 1, 2)
            counts[np.frombuffer(more, np.uint32)] = 2
    if segment is not None:
        bitmap = np.packbits(counts == 2, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([bitmap])], names=["segment", "bitmap"])


def _sums(hit: np.ndarray, packed: list[bytes], width: int) -> np.ndarray:
    """Hits in each of the packed values."""
    before = np.concatenate(([0], np.cumsum(hit)))
    ends = np.cumsum([0, *(len(v) // width for v in packed)])
    return before[ends[1:]] - before[ends[:-1]]


class RepeatFilter:
    """Tells which hashes possibly occur more than once.

    `column` holds hashes of `width` bytes, one or several packed into a value; `n` is how many.
    """

    def __init__(self, rows: DataFrame, column: str, n: int, width: int = 32, max_bytes: int = MAX_FILTER_BYTES):
        self.width = width
        most = (max_bytes * 8).bit_length() - 1
        self.bits = max(SEGMENT_BITS, min(most, (n * CELLS_PER_ROW).bit_length()))
        parts = rows.select(column).mapInArrow(
            _count_cells(width, self.bits), "segment long, once binary, more binary"
        )
        merged = parts.groupBy("segment").applyInArrow(_merge, "segment long, bitmap binary")
        packed = np.zeros(1 << (self.bits - 3), np.uint8)
        size = 1 << (SEGMENT_BITS - 3)
        for row in merged.toLocalIterator():
            packed[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.bitmap, np.uint8)
        self.shared = rows.sparkSession.sparkContext.broadcast(packed)

    def _counter(self):
        """Function that tells how many of each value's hashes possibly occur more than once."""
        shared, bits, width = self.shared, self.bits, self.width

        def hits(values: list[bytes]) -> np.ndarray:
            at = _cells(values, width, bits)
            return (shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)

        def count(values: list[bytes]) -> np.ndarray:
            out, run, size = [], [], 0
            for value in values:
                run.append(value)
                size += len(value)
                if size > TEST_BYTES:
                    out.append(_sums(hits(run), run, width))
                    run, size = [], 0
            if run:
                out.append(_sums(hits(run), run, width))
            return np.concatenate(out) if out else np.zeros(0, np.int64)

        return count

    def repeats(self, column: str) -> Column:
        """How many of the packed hashes possibly occur more than once."""
        counter = self._counter()

        @F.arrow_udf(LongType())
        def count(packed: pa.Array) -> pa.Array:
            return pa.array(counter(packed.to_pylist()), pa.int64())

        return count(F.col(column))

    def repeated_sha256(self, text: str) -> Column:
        """normalised_sha256 of a text that possibly occurs more than once, else null.

        Hashed and tested by one function: of two in a row each would hold a Python worker of its own.
        """
        counter = self._counter()

        @F.arrow_udf(BinaryType())
        def repeated(column: pa.Array) -> pa.Array:
            hashes = _sha256(column)
            return pa.array(hashes, pa.binary(), mask=counter(hashes) == 0)

        # Else a filter on the hash would be pushed below it and evaluate it a second time.
        return repeated.asNondeterministic()(text)

    def possibly_repeated(self, column: str) -> Column:
        return self.repeats(column) > 0


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row."""
    hashed = docs.select(F.col(id_col).alias("doc_id"), normalised_sha256(text_col).alias("sha"))
    hashed = write_table(hashed, "hashes")
    tested = hashed.withColumn("again", RepeatFilter(hashed, "sha", hashed.count()).possibly_repeated("sha"))
    tested = write_table(tested, "tested")
    single = tested.filter("not again").select(
        "doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    rows = tested.filter("again").select("doc_id", "sha")
    groups = rows.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Written, so that both sides of the join are plain exchanges that a skewed key can split.
    repeated = rows.join(write_table(groups, "groups"), "sha")
    return single.unionByName(repeated).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts: largest doc_id, then by a hash of the whole row.

    Columns of any type and name are kept.
    """
    sha, row = unused(docs, "_sha", "_row")
    hashed = row_hash(docs)
    columns = normalised_sha256(text_col).alias(sha), F.col(id_col).alias("id"), hashed.alias("row")
    thin = write_table(docs.select(*columns), "hashes")
    repeats = RepeatFilter(thin, sha, thin.count())
    best = thin.filter(repeats.possibly_repeated(sha)).groupBy(sha).agg(F.max(F.struct("id", "row")).alias("best"))
    winners = write_table(best.select(F.col(sha), F.col("best.row").alias(row)), "winners")
    marked = docs.withColumn(sha, repeats.repeated_sha256(text_col))
    alone = marked.filter(F.col(sha).isNull())
    rest = marked.filter(F.col(sha).isNotNull()).withColumn(row, hashed).join(winners, [sha, row], "left_semi")
    rest = rest.dropDuplicates([sha])
    return alone.drop(sha).unionByName(rest.drop(sha, row))
