"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Texts are sets of word shingles. Equal sets are one class, so copies cost one row each. Every
class gets a sketch: in round i each shingle is hashed into one of `size` bins (in the second
half of the rounds all go to one fixed bin), a bin keeps the least hash of the first round
that reaches it, so all coordinates fill, and two sketches agree in a coordinate with the
probability of the sets' similarity, concentrated as for independent coordinates. Bands of
coordinates are candidate buckets; at similarity 0.8 and 32 bands of 4 a pair shares no
bucket once in 2e7, at 0.85 once in 2e10. Candidates are confirmed on the full sets of words.

Only components are wanted, so a bucket does not emit its pairs. First every member meets
the pivot of its bucket, which is linear, and the confirmed links are contracted. Buckets of
more than `LARGE` members have a second pivot, the member with the smallest share of shingles
that no other member of a large bucket has: such shingles are in no intersection, so they
bound a member's similarity to all others, and a member with too many of them is linked
with nobody there. (They are found by a two-count Bloom filter, whose false alarms
only weaken the bound.) What is left are pairs of one bucket in different components: each
bucket keeps its largest component whole and pairs the other members with all of it, in
blocks of bounded size, in members and in shingles, that spread over tasks; a pair goes on only from the first bucket it
shares, within the bound, with near sketches and, in a large bucket, near sets of hashes. Every pair that shares a bucket is either
inside a component by then, excluded by an exact bound, or tested: nothing is lost to a cap.

Cases: a null or blank text has an empty set, is linked with nothing and kept. Rows sharing
a doc_id are one document and linked; a row without doc_id gets a null component, takes part
in nothing and is kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType

from presslens.llm import textkit
from presslens.llm.exact_dedup import RepeatFilter
from presslens.llm.rows import unused
from presslens.operators.components import connected_components
from presslens.sources.storage import write_table

BANDS, ROWS = 32, 4
BLOCK = 2048  # members on either side of a block of pairs
BLOCK_SHINGLES = 1 << 18  # shingles of their sets on either side, where a block has the sets
LARGE = 64  # members of a bucket from which a second pivot and the bound pay


def fast_sketch(elements: np.ndarray, size: int) -> np.ndarray:
    """`size` coordinates (a power of two) of a non-empty set of 64-bit hashes."""
    shift = np.uint64(64 - (size.bit_length() - 1))
    out = np.zeros(size, np.uint64)
    empty = np.ones(size, bool)
    for i in range(2 * size):
        seed = np.uint64((i + 1) * 0xD1342543DE82EF95 % (1 << 64))
        values = textkit.mix(elements ^ seed)
        if i < size:
            values = np.sort(values)  # the upper bits are the bin
            bins = (values >> shift).astype(np.int64)
            first = np.concatenate(([True], bins[1:] != bins[:-1]))
            bins, values = bins[first], values[first]
            fresh = empty[bins]
            bins, values = bins[fresh], values[fresh]
        elif empty[i - size]:
            bins, values = np.array([i - size]), values.min(keepdims=True)
        else:
            continue
        out[bins] = values
        empty[bins] = False
        if not empty.any():
            break
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket key per band; the band number is part of it."""
    parts = sketch[: bands * rows].reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        keys = textkit.mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return keys.view(np.int64)


def least_matches(size: int, threshold: float) -> int:
    """Coordinates that agree at least, 6.5 standard deviations below the mean at threshold."""
    spread = math.sqrt(size * threshold * (1 - threshold))
    return max(1, math.floor(size * threshold - 6.5 * spread))


SKETCHED = "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, sketch binary"


def _sketcher(k: int, bands: int, rows: int):
    size = 1 << (bands * rows - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                words, at = textkit.word_hashes(texts)
                n, d1, d2, keys, sketches = [], [], [], [], []
                for i in range(len(texts)):
                    shingles = textkit.shingle_set(words[at[i] : at[i + 1]], k)
                    n.append(len(shingles))
                    if len(shingles) == 0:
                        for column in (d1, d2, keys, sketches):
                            column.append(None)
                        continue
                    sketch = fast_sketch(shingles, size)
                    d1.append(int(shingles.sum().view(np.int64)))
                    d2.append(int(textkit.mix(~shingles).sum().view(np.int64)))
                    keys.append(band_keys(sketch, bands, rows))
                    sketches.append((sketch & np.uint64(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(d1, pa.int64()),
                        pa.array(d2, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "keys", "sketch"],
                )

    return run


def _matches(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).sum(axis=-1, dtype=np.int32)


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _similar_sketches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = _matches(_matrix(batch.column("sa")), _matrix(batch.column("sb"))) >= least
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


BLOCK_COLUMNS = ("key", "i", "j", "rep", "comp", "minor", "n", "live", "keys", "sketch", "small")


def _block_pairs(least: int, percent: int):
    """Pairs of different components in each block, of rows sorted by block."""

    def pairs(key: int, block: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, comps, minor, n, live = (np.array(c) for c in list(zip(*block))[:5])
        keys = np.frombuffer(b"".join(r[5] for r in block), np.int64).reshape(len(block), -1)
        sketches = np.frombuffer(b"".join(r[6] for r in block), np.uint8).reshape(len(block), -1)
        right = np.flatnonzero(~minor)
        sets = _local_numbers([r[7] for r in block])
        for row in np.flatnonzero(minor):
            bound = np.minimum(live[row], live[right]) * (100 + percent) >= percent * (n[row] + n[right])
            other = right[bound & (comps[right] != comps[row])]
            near = other[_matches(sketches[row], sketches[other]) >= least]
            if len(near):
                first = (keys[near] == keys[row]).argmax(axis=1)
                near = near[keys[row][first] == key]
            if sets and len(near):
                held = np.zeros(sets[0], bool)
                held[sets[1][row]] = True
                both = np.array([held[sets[1][o]].sum() for o in near])
                near = near[100 * both >= percent * (n[row] + n[near] - both)]
            if len(near):
                pair = [np.minimum(ids[row], ids[near]), np.maximum(ids[row], ids[near])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in pair], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, current = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in BLOCK_COLUMNS)):
                if row[:3] != current:
                    if block:
                        yield from pairs(current[0], block)
                    block, current = [], row[:3]
                block.append(row[3:])
        if block:
            yield from pairs(current[0], block)

    return run


def _local_numbers(packed: list[bytes | None]) -> tuple[int, list[np.ndarray]] | None:
    """Shingles of each member as numbers of the block's own; None where the block has no sets."""
    if packed[0] is None:
        return None
    sets = [np.frombuffer(p, np.uint32) for p in packed]
    distinct, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    return len(distinct), np.split(numbers, np.cumsum([len(s) for s in sets])[:-1])


def _packed_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                words, at = textkit.word_hashes(texts)
                sets = [textkit.shingle_set(words[s:e], k) for s, e in zip(at[:-1], at[1:])]
                # Half a hash is enough to bound an intersection: collisions only add to it.
                packed = [[s.tobytes() for s in sets], [s.astype(np.uint32).tobytes() for s in sets]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(p, pa.binary()) for p in packed)],
                    names=["rep", "shingles", "small"],
                )

    return run


def word_shingles(text: str, k: int) -> set[tuple[bytes, ...]]:
    """The set of a text as words, not hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def _verifier(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("ta"), batch.column("tb")):
                left, right = word_shingles(a.as_py(), k), b.as_py()
                if right != last:
                    last, last_set = right, word_shingles(right, k)
                both = len(left & last_set)
                keep.append(100 * both >= percent * (len(left) + len(last_set) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Graph:
    """Steps on class representatives; `reps` holds doc_id, sketch and text per class."""

    def __init__(self, reps: DataFrame, texts: DataFrame, k: int, percent: int, least: int):
        self.sketches = reps.select("doc_id", "sketch")
        self.texts, self.k, self.percent, self.least = texts, k, percent, least

    def _with(self, pairs: DataFrame, side: DataFrame, value: str, names: tuple[str, str]) -> DataFrame:
        for end, name in zip("ab", names):
            pairs = pairs.join(side.select(F.col("doc_id").alias(end), F.col(value).alias(name)), end)
        return pairs

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches agree in enough coordinates."""
        both = self._with(pairs, self.sketches, "sketch", ("sa", "sb"))
        return both.mapInArrow(_similar_sketches(self.least), "a long, b long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links: pairs whose full sets are similar enough."""
        both = self._with(pairs, self.texts, "text", ("ta", "tb"))
        links = both.mapInArrow(_verifier(self.k, self.percent), "a long, b long")
        return write_table(links.toDF("src", "dst"), "links")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, one row per row.

    Two documents are linked if 100 * intersection >= percent * union of their k-word
    shingle sets. See the module text for the method and the defined cases.
    """
    if bands * rows & (bands * rows - 1):
        raise ValueError("bands * rows must be a power of two")
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = write_table(thin.mapInArrow(_sketcher(k, bands, rows), SKETCHED), "sketches")
    linkable = sketched.filter("d1 is not null and doc_id is not null")
    digest = ["d1", "d2"]
    classes = write_table(linkable.groupBy(*digest).agg(F.min("doc_id").alias("rep")), "classes")
    reps = write_table(
        linkable.join(classes, digest)
        .filter("doc_id = rep")
        .select("doc_id", "n_shingles", "keys", "sketch", *digest)
        .dropDuplicates(["doc_id", *digest]),
        "representatives",
    )
    members = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep")).distinct()
    pivot = F.min(F.struct(F.xxhash64("rep").alias("h"), "rep"))["rep"]
    buckets = write_table(
        members.groupBy("key").agg(F.count("*").alias("n"), pivot.alias("pivot")).filter("n > 1"),
        "buckets",
    )
    shared = write_table(members.join(buckets, "key"), "shared")
    nodes = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = thin.join(nodes, "doc_id", "left_semi")

    percent_near = percent / 100
    graph = _Graph(reps, texts, k, percent, least_matches(bands * rows, percent_near))
    sets, live = _live_shares(shared, texts, k)
    central = live.filter(F.col("live") * 100 >= F.col("n_set") * percent)
    crowded = shared.filter(F.col("n") > LARGE).select("key", "rep").join(central, "rep")
    centre = F.max(F.struct(F.col("live") / F.col("n_set"), "rep"))["rep"]
    centres = write_table(crowded.groupBy("key").agg(centre.alias("pivot")), "centres")
    stars = shared.select("rep", "pivot").unionByName(
        crowded.select("key", "rep").join(centres, "key").select("rep", "pivot")
    )
    stars = stars.filter("rep != pivot").select(
        F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")
    )
    links = graph.confirmed(graph.similar(stars.distinct()))
    first = write_table(connected_components(nodes, links, "doc_id"), "components")

    rest = graph.confirmed(_unsettled(shared, first, reps, sets, live, graph.least, percent))
    ends = rest
    for end in ("src", "dst"):
        names = first.select(F.col("doc_id").alias(end), F.col("component").alias("_to"))
        ends = ends.join(names, end).drop(end).withColumnRenamed("_to", end)
    roots = first.select(F.col("component").alias("doc_id")).distinct()
    second = write_table(connected_components(roots, ends, "doc_id"), "components")

    named = classes.join(first.withColumnRenamed("doc_id", "rep"), "rep", "left").join(
        second.select(F.col("doc_id").alias("component"), F.col("component").alias("root")),
        "component",
        "left",
    )
    named = write_table(
        named.select(*digest, F.coalesce("root", "rep").alias("component_id")), "named"
    )
    return (
        sketched.select("doc_id", "n_shingles", *digest)
        .join(named, digest, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
                "component_id"
            ),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _live_shares(shared: DataFrame, texts: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Members of large buckets: their packed sets (rep, shingles, small), and (rep, n_set, live),
    the number of their shingles and of those that possibly occur in a second one of them."""
    members = shared.filter(F.col("n") > LARGE).select(F.col("rep").alias("doc_id")).distinct()
    chosen = texts.join(members, "doc_id", "left_semi").select("doc_id", "text")
    sets = write_table(chosen.mapInArrow(_packed_sets(k), "rep long, shingles binary, small binary"), "sets")
    n = F.octet_length("shingles") / 8
    total = int(sets.agg(F.sum(n)).first()[0] or 0)
    live = RepeatFilter(sets, "shingles", total, width=8).repeats("shingles")
    counted = sets.select("rep", n.cast("long").alias("n_set"), live.alias("live"))
    # A doc_id may stand for several rows with different texts; the one with most decides.
    best = F.max(F.struct(F.col("live") / F.col("n_set"), "n_set", "live")).alias("m")
    return sets, write_table(counted.groupBy("rep").agg(best).select("rep", "m.n_set", "m.live"), "live")


def _unsettled(
    shared: DataFrame,
    comps: DataFrame,
    reps: DataFrame,
    sets: DataFrame,
    live: DataFrame,
    least: int,
    percent: int,
) -> DataFrame:
    """Distinct pairs (a, b) that share a bucket, differ in component and may be linked."""
    named = comps.select(F.col("doc_id").alias("rep"), F.col("component").alias("comp"))
    placed = shared.select("key", "rep", "n").join(named, "rep").join(live, "rep", "left")
    bounded = F.col("n") > LARGE
    placed = placed.filter(~bounded | (F.col("live") * 100 >= F.col("n_set") * percent))
    carried = F.when(bounded, F.col("n_set")).otherwise(0).alias("carried")
    live = F.when(bounded, F.col("live")).alias("live")
    placed = write_table(placed.select("key", "rep", "comp", live, carried), "placed")
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("carried").alias("held"))
    mixed = sizes.groupBy("key").agg(
        F.sum("n").alias("total"),
        F.sum("held").alias("held"),
        F.max(F.struct("n", "comp", "held")).alias("largest"),
        F.count("*").alias("comps"),
    ).filter("comps > 1")
    parts = lambda n, held: F.ceil(F.greatest(n / BLOCK, held / BLOCK_SHINGLES)).cast("int")
    mixed = write_table(
        mixed.select(
            "key",
            F.col("largest.comp").alias("major"),
            parts(F.col("total"), F.col("held")).alias("cols"),
            parts(F.col("total") - F.col("largest.n"), F.col("held") - F.col("largest.held")).alias("rows"),
        ),
        "mixed",
    )
    details = reps.select(
        F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), _packed("keys").alias("keys"), "sketch"
    )
    rows = placed.drop("carried").join(mixed, "key").join(details, "rep")
    small = sets.select(F.col("rep").alias("_rep"), "small")
    rows = rows.join(small, F.col("live").isNotNull() & (F.col("rep") == F.col("_rep")), "left")
    rows = rows.withColumn("live", F.coalesce("live", "n"))
    chunk = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    right = rows.withColumns({"j": chunk("cols"), "minor": F.lit(False)}).withColumn("i", every("rows"))
    left = rows.filter("comp != major").withColumns({"i": chunk("rows"), "minor": F.lit(True)})
    left = left.withColumn("j", every("cols"))
    blocks = left.select(*BLOCK_COLUMNS).unionByName(right.select(*BLOCK_COLUMNS))
    blocks = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return blocks.mapInArrow(_block_pairs(least, percent), "a long, b long").distinct()


@F.arrow_udf(BinaryType())
def _packed(keys: pa.Array) -> pa.Array:
    """Band keys of each row as bytes."""
    return pa.array([np.array(k, np.int64).tobytes() for k in keys.to_pylist()], pa.binary())


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Documents without those whose component has a smaller doc_id; columns of any name are kept."""
    (name,) = unused(docs, "_gone")
    gone = near_duplicates(docs, k, percent).filter("not kept").select(F.col("doc_id").alias(name))
    return docs.join(gone.distinct(), F.col("doc_id") == F.col(name), "left_anti")
