"""Benchmark passages in documents by greedy string tiling.

Words are runs of letters, digits and underscores in lower case. Seeds are the runs of
`min_tile` words of an item (all words of a shorter one), so every tile consists of seeds that
the document holds, and the words of such seeds bound what tiles can cover. A document and a
benchmark item whose bound reaches `coverage` are tiled: the longest common run of words not yet
marked is found by running Karp-Rabin hashes over both, every non-overlapping match of that
length is marked, and this goes on down to `min_tile` words. Tiles may lie in any order, so a passage with its parts exchanged is covered as well.
The pair counts if the marked share of the item reaches `coverage`.

Documents never shuffle: the benchmark goes to them, in blocks of at most `block_bytes` of
text, each broadcast and met by all documents. Null and blank texts and items match nothing;
an item shorter than `min_tile` needs all its words in a row.
Repeated rows give repeated results, null ids are carried as null, other columns are ignored
by `tilings` and kept by `without_leaks`. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType

from presslens.llm import textkit
from presslens.sources.storage import write_table

MIN_TILE, COVERAGE = 3, 0.7
BLOCK_BYTES = 16 << 20
_TABLE_BITS = 22
_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15


def normalise(text: str | None) -> bytes:
    return " ".join(_WORD.findall((text or "").lower())).encode()


def _rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window of `length` tokens, from prefix sums of powers."""
    powers = np.full(len(tokens) + 1, np.uint64(_BASE))
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(tokens * powers[:-1])))
    shift = powers[::-1][: len(tokens) - length + 1]  # brings all windows to one power
    return (sums[length:] - sums[:-length]) * shift


def _windows(tokens: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows without a marked token."""
    marked = np.concatenate(([0], np.cumsum(~free)))
    starts = np.flatnonzero(marked[length:] == marked[:-length])
    # The shift of `_rolling` depends on the array's length, so hashes are made relative here.
    return starts, _rolling(tokens, length)[starts]


def greedy_tiles(item: np.ndarray, doc: np.ndarray, min_tile: int) -> list[int]:
    """Lengths of the tiles, longest first; item and doc are arrays of word hashes."""
    held = np.isin(doc, item)
    runs = np.flatnonzero(np.diff(np.concatenate(([0], held.view(np.int8), [0]))))
    spans = [(s, e) for s, e in zip(runs[::2], runs[1::2]) if e - s >= min_tile]
    if not spans:
        return []
    # One array: the item, then the parts of doc made of its words, with marked gaps between.
    gap = np.zeros(1, np.uint64)
    pieces = [item]
    for s, e in spans:
        pieces += [gap, doc[s:e]]
    tokens = np.concatenate(pieces)
    free = tokens != 0
    m = len(item)
    tiles = []
    longest = min(m, max(e - s for s, e in spans))

    def common(length: int) -> tuple[dict[int, deque[int]], list[tuple[int, int]]]:
        starts, hashes = _windows(tokens, free, length)
        mine = starts + length <= m
        wanted = np.isin(hashes, hashes[mine]) & (starts > m)
        if not wanted.any():
            return {}, []
        places = defaultdict(deque)
        for at, h in zip(starts[mine].tolist(), hashes[mine].tolist()):
            places[h].append(at)
        return places, list(zip(starts[wanted].tolist(), hashes[wanted].tolist()))

    while longest >= min_tile:
        low, high, best = min_tile, longest, None
        while low <= high:  # a common run of n words has common runs of fewer
            middle = (low + high + 1) // 2
            found = common(middle)
            if found[1]:
                best, low = (middle, *found), middle + 1
            else:
                high = middle - 1
        if best is None:
            break
        longest, places, hits = best
        marked = False
        for at, h in hits:
            if not free[at : at + longest].all():
                continue
            queue, others = places[h], []
            while queue:
                start = queue.popleft()
                if not free[start : start + longest].all():
                    continue  # marked words stay marked, so this place is done with
                if np.array_equal(tokens[start : start + longest], tokens[at : at + longest]):
                    free[at : at + longest] = free[start : start + longest] = False
                    tiles.append(longest)
                    marked = True
                    break
                others.append(start)  # another run of words with the same hash
            queue.extendleft(reversed(others))
        if not marked:  # only hash collisions at this length
            longest -= 1
    return tiles


def benchmark_index(items: list[tuple[int | None, str | None]], min_tile: int) -> dict:
    """Ids, word hashes and seeds of a block of items; plain data, as it is broadcast."""
    ids, item_words = [], []
    by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    begins = [0]
    for item_id, text in items:
        words, _ = textkit.word_hashes([normalise(text)])
        if len(words) == 0:
            continue
        words = words | np.uint64(1)  # never 0, the gap
        n = min(min_tile, len(words))
        grams = textkit.ngram_hashes(words, n)
        by_length[n].append((grams, begins[-1] + np.arange(len(grams))))
        begins.append(begins[-1] + len(words))
        ids.append(item_id)
        item_words.append(words)
    seeds = {}
    for n, parts in by_length.items():
        grams = np.concatenate([g for g, _ in parts])
        places = np.concatenate([p for _, p in parts])
        order = np.argsort(grams, kind="stable")
        distinct, first = np.unique(grams[order], return_index=True)
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[distinct >> np.uint64(64 - _TABLE_BITS)] = True
        seeds[n] = (distinct, np.append(first, len(grams)), places[order], table)
    return {"ids": ids, "words": item_words, "begins": np.array(begins), "seeds": seeds}


def _candidates(index: dict, words: np.ndarray, at: np.ndarray, coverage: float) -> Iterator[tuple[int, int]]:
    """Pairs of a text and an item whose seeds in the text can cover enough of the item."""
    begins = index["begins"]
    for n, (grams, bounds, places, table) in index["seeds"].items():
        hashes = textkit.ngram_hashes(words, n)
        maybe = np.flatnonzero(table[hashes >> np.uint64(64 - _TABLE_BITS)])
        gram = np.minimum(np.searchsorted(grams, hashes[maybe]), len(grams) - 1)
        doc = np.searchsorted(at, maybe, "right") - 1
        hit = (grams[gram] == hashes[maybe]) & (maybe + n <= at[doc + 1])
        doc, gram = doc[hit], gram[hit]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]))
        for lo, hi in zip(edges[:-1], edges[1:]):
            if lo == hi:
                continue
            held = np.unique(gram[lo:hi])
            size = bounds[held + 1] - bounds[held]
            # Every place of the held seeds in the block, in order.
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found = np.sort(places[np.repeat(bounds[held], size) + within])
            owner = np.searchsorted(begins, found, "right") - 1
            new = np.minimum(n, np.diff(found, append=found[-1] + n))  # words up to the next seed
            new[:-1][owner[1:] != owner[:-1]] = n
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            items = owner[first]
            enough = np.add.reduceat(new, first) >= coverage * (begins[items + 1] - begins[items])
            for i in items[enough]:
                yield int(doc[lo]), int(i)


def matches(
    index: dict, texts: list[bytes], min_tile: int, coverage: float
) -> Iterator[tuple[int, int, int, list[int]]]:
    """(text number, item number, item words, tiles) of each pair over the threshold."""
    words, at = textkit.word_hashes([normalise(t.decode()) for t in texts])
    words = words | np.uint64(1)
    for doc, i in sorted(_candidates(index, words, at, coverage)):
        item = index["words"][i]
        tiles = greedy_tiles(item, words[at[doc] : at[doc + 1]], min(min_tile, len(item)))
        if tiles and sum(tiles) >= coverage * len(item):
            yield doc, i, len(item), tiles


def _blocks(benchmark: DataFrame, min_tile: int, block_bytes: int) -> Iterator[tuple[Broadcast, bool]]:
    """Broadcast indexes of the benchmark, one bounded block after the other, and whether it is the last."""
    items = benchmark.select(F.col("item_id"), F.col("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    copy = F.lit(1)
    if blocks > 1:  # equal rows are dealt over the blocks as well
        copy = F.row_number().over(Window.partitionBy("item_id", "text").orderBy("item_id"))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text", copy), F.lit(blocks)))
    if blocks > 1:
        items = write_table(items, "items")
    for block in range(blocks):
        rows = [tuple(r) for r in items.filter(F.col("block") == block).select("item_id", "text").collect()]
        index = benchmark_index(rows, min_tile)
        yield benchmark.sparkSession.sparkContext.broadcast(index), block == blocks - 1


TILED = (
    "doc_id long, item_id long, item_words int, covered_words int, coverage double, "
    "n_tiles int, longest_tile int"
)


def _tiler(shared, min_tile: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                ids = part.column(0).to_pylist()
                found = [
                    (ids[d], shared.value["ids"][i], n, sum(t), sum(t) / n, len(t), max(t))
                    for d, i, n, t in matches(shared.value, texts, min_tile, coverage)
                ]
                if found:
                    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
                    names = [c.split()[0] for c in TILED.split(", ")]
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def tilings(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tile: int = MIN_TILE,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for shared, _ in _blocks(benchmark, min_tile, block_bytes):
        found = thin.mapInArrow(_tiler(shared, min_tile, coverage), TILED)
        out = found if out is None else out.unionByName(found)
    return out


def _leak_test(shared, min_tile: int, coverage: float):
    @F.arrow_udf(BooleanType())
    def leaks(text: pa.Array) -> pa.Array:
        flags = np.zeros(len(text), bool)
        done = 0
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        for part, texts in textkit.slices(batch, "text"):
            for doc, *_ in matches(shared.value, texts, min_tile, coverage):
                flags[done + doc] = True
            done += part.num_rows
        return pa.array(flags)

    return leaks


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tile: int = MIN_TILE,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents that contain no benchmark item, with all their columns.

    With several blocks what each leaves is written, so a worker holds one block at a time.
    """
    for shared, last in _blocks(benchmark, min_tile, block_bytes):
        docs = docs.filter(~_leak_test(shared, min_tile, coverage)("text"))
        if not last:
            docs = write_table(docs, "without-block")
    return docs
