"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has bit i set if more than half of the text's shingle hashes have it. Equal
fingerprints are one entry of the index, so copies of a text cost one entry. Entries are
sorted by Gray rank, in which neighbours differ in few bits, and cut into pages of `PAGE`;
`FANOUT` neighbouring pages or nodes make a node of the next level. A node keeps the bits that all
entries below share, as a mask and a pattern.

All links within `radius` bits come from walking the tree against itself from the top: a pair of
nodes is followed by the pairs of their children, the differences between bits that both
children share and that have not been counted higher up are added to those of the parents, and
a pair with more than `radius` of them is dropped with all the entries below. That walk is a join of
a level's pairs with the children twice; the bound on children bounds what a pair can make. The
pairs of pages left are compared in tasks, where groups of `LEAF` neighbours are pruned by
their masks in the same way. Nothing is capped, and every link within the radius is met.

Only components are wanted. Each page is linked within itself first, its entries get the name of
their part of the page, and a pair of pages then gives a spanning forest over those names: at
most one edge per part, however many entries link.

Cases: a null or blank text has fingerprint zero and links like any other; fewer words than a
shingle make one shingle. Every row is a document of its own text: rows that share a doc_id, and
rows without one, link by their texts, and a component's id is its smallest doc_id (null if no
member has one). Repeated rows stay repeated; an empty table gives an empty result; other
columns are ignored. A text is hashed in pieces, so memory does not follow its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from presslens.llm import textkit
from presslens.operators.components import connected_components
from presslens.operators.heavy import split_join
from presslens.operators.ranking import with_row_index
from presslens.sources.storage import write_table

SEED = 42
PAGE = 1024  # entries of a page
FANOUT = 16  # children of a node
LEAF = 16  # neighbours whose shared bits are tested together inside a page
HASHES = 1 << 14  # shingle hashes whose bits are counted at a time
MATRIX = 1 << 10  # pairs of leaves compared at a time


def _shingle_hashes(words: list[bytes], k: int) -> Iterator[np.ndarray]:
    """XXH64 of each k consecutive words, joined by a blank."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(words) - k + 1)
    for at in range(0, len(hashes), HASHES):
        yield hashes[at : at + HASHES]


def fingerprint(text: bytes, k: int) -> int:
    """Unsigned fingerprint of a UTF-8 text; zero without words."""
    bits, n = np.zeros(64, np.int64), 0
    carry: list[bytes] = []
    for piece in textkit._pieces(text):
        words = carry + piece.lower().split()
        if len(words) >= k:
            for hashes in _shingle_hashes(words, k):
                rows = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
                bits += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                n += len(hashes)
        carry = words[-(k - 1) :] if k > 1 else []
    if n == 0 and carry:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED)
    return sum(1 << int(i) for i in np.flatnonzero(2 * bits > n))


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                prints = np.array([fingerprint(t, k) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
                )

    return run


def gray_rank(fp: Column) -> Column:
    """Position of a fingerprint in the Gray sequence, as a long in the order of signed numbers."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _shared_bits(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pattern and mask of each leaf."""
    at = np.arange(0, len(entries), LEAF)
    low, high = np.bitwise_and.reduceat(entries, at), np.bitwise_or.reduceat(entries, at)
    return low, ~(low ^ high)


def _leaves(entries: np.ndarray) -> np.ndarray:
    """Entries as rows of LEAF, the last one filled up with its last entry."""
    missing = -len(entries) % LEAF
    return np.concatenate([entries, np.repeat(entries[-1:], missing)]).reshape(-1, LEAF)


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of all entries left[i], right[j] within `radius` bits of each other."""
    (low_a, mask_a), (low_b, mask_b) = _shared_bits(left), _shared_bits(right)
    apart = (low_a[:, None] ^ low_b) & mask_a[:, None] & mask_b
    rows, cols = np.nonzero(np.bitwise_count(apart) <= radius)
    a, b = _leaves(left), _leaves(right)
    found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(rows), MATRIX):
        r, c = rows[at : at + MATRIX], cols[at : at + MATRIX]
        near = np.bitwise_count(a[r][:, :, None] ^ b[c][:, None, :]) <= radius
        pair, i, j = np.nonzero(near)
        found_i.append(r[pair] * LEAF + i)
        found_j.append(c[pair] * LEAF + j)
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    inside = (i < len(left)) & (j < len(right))
    return i[inside], j[inside]


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        after = after[after]
        while not np.array_equal(after, deeper := after[after]):
            after = deeper
        if np.array_equal(after, root):
            return root
        root = after


def _lists(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values, np.int64).view(np.uint64) for x in column]


def _settled(radius: int):
    """Pages of Gray ranks to pages of fingerprints, each with the name of its part of the page."""
    top = np.uint64(1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = []
            for ranks in _lists(batch.column("ranks")):
                ranks = ranks ^ top
                entries = ranks ^ (ranks >> np.uint64(1))
                root = local_roots(len(entries), *close_pairs(entries, entries, radius))
                pages.append((entries, entries[root]))
            kind = pa.list_(pa.int64())
            columns = [pa.array([p[i].view(np.int64) for p in pages], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "fps", "parts"])

    return run


def _forests(radius: int):
    """Edges between parts of two pages: a spanning forest of their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, part_a, b, part_b in zip(*(_lists(batch.column(c)) for c in ("fa", "pa", "fb", "pb"))):
                i, j = close_pairs(a, b, radius)
                if not len(i):
                    continue
                names, ends = np.unique(np.concatenate([part_a[i], part_b[j]]), return_inverse=True)
                root = local_roots(len(names), ends[: len(i)], ends[len(i) :])
                tied = root != np.arange(len(names))
                pair = names[tied], names[root[tied]]
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pair], names=["src", "dst"])

    return run


def _levels(pages: DataFrame) -> list[DataFrame]:
    """Nodes (id, parent, low, high) of every level, the pages first and one root last."""
    low = F.aggregate("fps", F.lit(-1).cast("long"), lambda a, x: a.bitwiseAND(x))
    high = F.aggregate("fps", F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    up = (F.floor(F.col("id") / FANOUT)).alias("parent")
    levels = [write_table(pages.select("id", up, low.alias("low"), high.alias("high")), "nodes")]
    while levels[-1].count() > 1:
        above = levels[-1].groupBy(F.col("parent").alias("id")).agg(
            F.bit_and("low").alias("low"), F.bit_or("high").alias("high")
        )
        levels.append(write_table(above.select("id", up, "low", "high"), "nodes"))
    return levels


def _page_pairs(levels: list[DataFrame], radius: int) -> DataFrame:
    """Pairs a < b of pages that the accumulated differences of their paths do not rule out."""
    pairs = levels[-1].select(
        F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).alias("apart"), F.lit(0).cast("long").alias("seen")
    )
    for nodes in reversed(levels[:-1]):
        x = nodes.select(F.col("parent").alias("a"), F.struct("id", "low", "high").alias("x"))
        y = nodes.select(F.col("parent").alias("b"), F.struct("id", "low", "high").alias("y"))
        mask = F.expr("~(x.low ^ x.high) & ~(y.low ^ y.high) & ~seen")
        more = F.expr("bit_count((x.low ^ y.low) & fresh)")
        grown = pairs.join(x, "a").join(y, "b").filter("x.id <= y.id").withColumn("fresh", mask)
        pairs = grown.withColumn("apart", F.col("apart") + more).filter(F.col("apart") <= radius)
        pairs = pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "apart", F.expr("seen | fresh").alias("seen"))
        pairs = write_table(pairs, "node-pairs")
    return pairs.filter("a < b").select("a", "b")


def _parts(entries: DataFrame, radius: int) -> DataFrame:
    """(fp, part): the smallest fingerprint, as a signed number, that each entry reaches."""
    ranked = with_row_index(entries.select(gray_rank(F.col("fp")).alias("rank")), ["rank"], "pos")
    paged = ranked.groupBy(F.floor(F.col("pos") / PAGE).alias("id")).agg(
        F.sort_array(F.collect_list("rank")).alias("ranks")  # at most PAGE of them
    )
    settled = paged.mapInArrow(_settled(radius), "id long, fps array<long>, parts array<long>")
    pages = write_table(settled, "pages")
    pairs = _page_pairs(_levels(pages), radius)
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = lambda name: pages.select(
        F.col("id").alias(name), F.col("fps").alias(f"f{name}"), F.col("parts").alias(f"p{name}")
    )
    met = pairs.repartition(tasks, "a", "b").join(side("a"), "a").join(side("b"), "b")
    edges = write_table(met.mapInArrow(_forests(radius), "src long, dst long"), "edges")
    ends = edges.select(F.col("src").alias("part")).unionByName(edges.select(F.col("dst").alias("part")))
    named = connected_components(ends, edges, "part")
    flat = pages.select(F.explode(F.arrays_zip("fps", "parts")).alias("e")).select("e.fps", "e.parts")
    flat = flat.toDF("fp", "part").join(named, "part", "left")
    return flat.select("fp", F.coalesce("component", "part").alias("part"))


def near_duplicates(
    docs: DataFrame, k: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row."""
    if k < 1 or not 0 <= radius < 64:
        raise ValueError("k must be positive and radius between 0 and 63")
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = write_table(thin.mapInArrow(_fingerprints(k), "doc_id long, fp long"), "fingerprints")
    entries = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    entries = write_table(entries, "entries")
    parts = write_table(_parts(entries, radius), "parts")
    first = parts.join(entries, "fp").groupBy("part").agg(F.min("first").alias("component_id"))
    first = write_table(first.withColumnRenamed("part", "_part"), "smallest")
    # A part may hold most entries, and an entry most rows.
    named = split_join(parts, first, F.col("part"), F.col("_part"), "left").select(
        F.col("fp").alias("_fp"), "component_id"
    )
    named = write_table(named, "named")
    return split_join(prints, named, F.col("fp"), F.col("_fp"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
