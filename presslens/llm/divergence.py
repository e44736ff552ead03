"""Audit of how far the sources of a language diverge in their terms, in exact integers.

Terms are maximal runs of letters A-Z, a-z and characters from U+0080 on, A-Z lower-cased. Tasks
count them in buckets by length: up to 8 bytes are one 64-bit word and up to 16 bytes two,
packed from the left, so that word order is byte order; they are radix-sorted by 16-bit digits
and counted by runs. Longer terms are sorted as bytes, in buckets of their own by length.
A task hands on its sums when it holds `BUFFER` terms, so the shuffle carries about one row per term,
group and task. The shuffle's key is the packed words and the bytes beyond them; text is made
again only for reported terms.

A language keeps the terms of at least `min_docs` of its documents. A group is a source of a
language. With N occurrences of V kept terms, p = 1 + floor(S * (count + 1) / (N + V)), S = 10**9, and
the divergence of p from q is floor((p - q)**2 / q). Part `term` lists the terms that a group has
more often than its language does, part `pair` the sums over all kept terms against each
other source. Most terms of most pairs have count 0 on a side: the value of such a term depends
on the other side's count only, so these are added up by distinct p, and term by term only those
that both sources have are looked at, summed in the tasks per pair of sources.

Cases: null text, language and source are empty strings. Every row is a document. A group
without terms is paired like any other, a language without kept terms gives pairs of value 0, a
language with one source no pairs. Repeated rows count again; an empty table gives an empty
result; other columns are ignored. Long texts are counted in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from presslens.llm import textkit
from presslens.sources.storage import write_table

SCALE = 10**9
PIECE = 1 << 20  # bytes of text looked at together
BUFFER = 1 << 20  # counted terms that a task holds
PAIRS = 1 << 17  # pairs of sources at one term that are summed together
_IS_TERM = np.zeros(256, bool)
_IS_TERM[np.r_[65:91, 97:123, 128:256]] = True
PACKED = "lang string, source string, w0 long, w1 long, rest binary, n long, docs long"
TERM = ["w0", "w1", "rest"]


def radix_order(*words: np.ndarray) -> np.ndarray:
    """Stable order by unsigned words, the most significant first: a counting pass per 16-bit digit.

    NumPy's stable sort of 16-bit numbers is a radix sort. Digits that are all alike need no pass.
    """
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class _Counter:
    """Counts of (group, term) in a task: occurrences and documents."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self):
        self.short: list[tuple[np.ndarray, ...]] = []  # (group, document, w0, w1, n)
        self.long: dict[int, list[tuple[int, bytes, int, int]]] = {}  # (group, term, document, n) by length
        self.held = 0

    def add(self, texts: list[bytes], groups: np.ndarray, first: int):
        """Count the terms of some texts, which are documents first, first + 1 ..."""
        data = b"\0".join(texts).lower()
        codes = np.frombuffer(data + bytes(16), np.uint8)
        inside = _IS_TERM[codes]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        doc = np.searchsorted(begins, starts, "right") - 1
        size = ends - starts
        words = np.ndarray((len(codes) - 7,), ">u8", codes, strides=(1,))
        for least, most in ((1, 8), (9, 16)):
            pick = (size >= least) & (size <= most)
            at, length = starts[pick], size[pick]
            w0 = words[at].astype(np.uint64)
            w1 = np.zeros(len(at), np.uint64)
            unused = ((most - length) * 8).astype(np.uint64)
            if most == 8:
                w0 = w0 >> unused << unused
            else:
                w1 = words[at + 8].astype(np.uint64) >> unused << unused
            self._add_short(groups[doc[pick]], doc[pick] + first, w0, w1, np.ones(len(at), np.int64))
        for i in np.flatnonzero(size > 16):
            d = int(doc[i])
            bucket = self.long.setdefault(int(size[i]).bit_length(), [])
            bucket.append((int(groups[d]), data[starts[i] : ends[i]], d + first, 1))
            self.held += 1

    def _add_short(self, group, doc, w0, w1, n):
        """Sum equal (document, term) entries."""
        if not len(w0):
            return
        order = radix_order(w0, w1)  # stable, so documents stay in order
        group, doc, w0, w1, n = group[order], doc[order], w0[order], w1[order], n[order]
        at = run_starts(w0, w1, doc)
        self.short.append((group[at], doc[at], w0[at], w1[at], np.add.reduceat(n, at)))
        self.held += len(at)

    def shrink(self):
        """Sum what the pieces of one long document have in common."""
        parts, self.short = self.short, []
        long, self.long = self.long, {}
        self.held = 0
        if parts:
            self._add_short(*(np.concatenate(c) for c in zip(*parts)))
        for length, entries in long.items():
            entries.sort()
            merged = [(*k, sum(e[3] for e in g)) for k, g in groupby(entries, key=lambda e: e[:3])]
            self.long[length] = merged
            self.held += len(merged)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Sums by group and term."""
        names = list(self.groups)
        langs, sources = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))

        def batch(group, w0, w1, rest, n, docs):
            picked = pa.array(group)
            columns = [langs.take(picked), sources.take(picked), pa.array(w0.view(np.int64)), pa.array(w1.view(np.int64)), rest]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(n), pa.array(docs)], names=["lang", "source", *TERM, "n", "docs"]
            )

        if self.short:
            group, doc, w0, w1, n = (np.concatenate(c) for c in zip(*self.short))
            order = radix_order(group.astype(np.uint64), w0, w1)
            group, w0, w1, n = group[order], w0[order], w1[order], n[order]
            at = run_starts(group, w0, w1)
            docs = np.diff(np.append(at, len(group)))  # an entry is a document
            rest = pa.array([b""], pa.binary()).take(pa.array(np.zeros(len(at), np.int64)))
            yield batch(group[at], w0[at], w1[at], rest, np.add.reduceat(n, at), docs)
        for entries in self.long.values():
            entries.sort()
            rows = []
            for (group, term), own in groupby(entries, key=lambda e: e[:2]):
                own = list(own)
                rows.append((group, term, sum(e[3] for e in own), len({e[2] for e in own})))
            heads = np.frombuffer(b"".join(r[1][:16] for r in rows), ">u8").astype(np.uint64).reshape(-1, 2)
            rest = pa.array([r[1][16:] for r in rows], pa.binary())
            group, n, docs = (np.array([r[i] for r in rows], np.int64) for i in (0, 2, 3))
            yield batch(group, heads[:, 0].copy(), heads[:, 1].copy(), rest, n, docs)
        self.clear()


def _cut(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end behind a byte of no term."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end > at and _IS_TERM[text[end - 1]]:
            end -= 1
        if end == at:
            end = at + PIECE
            while end < len(text) and _IS_TERM[text[end]]:
                end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter, n = _Counter(), 0
    for batch in batches:
        for part, texts in textkit.slices(batch, "text"):
            names = zip(*(part.column(c).fill_null("").to_pylist() for c in ("lang", "source")))
            groups = np.array([counter.groups.setdefault(g, len(counter.groups)) for g in names], np.int64)
            if len(texts) == 1:
                for piece in _cut(texts[0]):
                    counter.add([piece], groups, n)
                    if counter.held > BUFFER:
                        counter.shrink()
            else:
                counter.add(texts, groups, n)
            n += len(texts)
            if counter.held > BUFFER:
                yield from counter.batches()
    yield from counter.batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, w0, w1, rest, n, docs): occurrences and documents of every term in every group."""
    parts = docs.select("lang", "source", "text").mapInArrow(_counted, PACKED)
    return parts.groupBy("lang", "source", *TERM).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(S * (n + 1) / (total + kept)), in decimals as the product can exceed 64 bits."""
    product = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", product, total + kept) + 1


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def _term_text() -> Column:
    """The term as text; no term holds a zero byte."""
    words = F.expr("concat(unhex(lpad(hex(w0), 16, '0')), unhex(lpad(hex(w1), 16, '0')), rest)")
    return F.rtrim(words.cast("string"), F.lit("\0"))


def _summed(lang, a, b, value):
    """Sum the values of equal (lang, a, b)."""
    order = radix_order(lang.view(np.uint64), a.view(np.uint64), b.view(np.uint64))
    lang, a, b, value = lang[order], a[order], b[order], value[order]
    at = run_starts(lang, a, b)
    return lang[at], a[at], b[at], np.add.reduceat(value, at)


def _run_pairs(code, source, p, zero, ends) -> Iterator[tuple[np.ndarray, ...]]:
    """Summed values of all ordered pairs inside each run [ends[i], ends[i + 1]) of a term.

    Every entry meets its whole run, about PAIRS pairs at a time, so a term of very many sources
    takes no more memory than others.
    """
    begin = np.repeat(ends[:-1], np.diff(ends))
    width = np.repeat(np.diff(ends), np.diff(ends))
    done = np.cumsum(width)
    first = 0
    while first < len(width):
        spent = done[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(done, spent + PAIRS, "right")))
        own = width[first:stop]
        left = np.repeat(np.arange(first, stop), own)
        right = np.arange(len(left)) + np.repeat(begin[first:stop] - (done[first:stop] - own - spent), own)
        keep = left != right
        left, right = left[keep], right[keep]
        x, y, x0, y0 = p[left], p[right], zero[left], zero[right]
        value = (x - y) * (x - y) // y
        value -= (x - y0) * (x - y0) // y0
        value -= (x0 - y) * (x0 - y) // y
        value += (x0 - y0) * (x0 - y0) // y0
        if len(left):
            yield _summed(code[left], source[left], source[right], value)
        first = stop


def _joint_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources the part of the sum that only terms of both have; rows sorted by term.

    Sums wrap modulo 2**64, and the whole sums fit, so no order of adding them matters.
    """
    names: dict[str, int] = {}
    sums: list[tuple[np.ndarray, ...]] = []
    held = 0

    def out():
        lang, a, b, value = _summed(*(np.concatenate(c) for c in zip(*sums)))
        text = pa.array(list(names), pa.string()).take(pa.array(lang))
        columns = [text, pa.array(a), pa.array(b), pa.array(value)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "joint"])

    def rows(batch):
        """Language code, term, source, p and p of count 0 of a batch, in blocks of bounded size."""
        tail = np.empty(batch.num_rows, object)
        tail[:] = batch.column("rest").to_pylist()
        code = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int64)
        w0, w1, *rest = (np.asarray(batch.column(c), np.int64) for c in ("w0", "w1", "source", "p", "zero"))
        return [code, w0, w1, tail, *rest]

    waiting = None  # the last run, which may go on in the next batch
    for batch in _then_none(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            fresh = rows(batch)
            waiting = fresh if waiting is None else [np.concatenate(x) for x in zip(waiting, fresh)]
        if waiting is None:
            continue
        ends = np.append(run_starts(*waiting[:4]), len(waiting[0]))
        whole = len(ends) - (1 if batch is None else 2)
        code, source, p, zero = waiting[0], *waiting[4:]
        for part in _run_pairs(code, source, p, zero, ends[: whole + 1]):
            sums.append(part)
            held += len(part[0])
            if held > 4 * PAIRS:
                sums = [_summed(*(np.concatenate(c) for c in zip(*sums)))]
                held = len(sums[0][0])
                if held > 2 * PAIRS:
                    yield out()
                    sums, held = [], 0
        waiting = [c[ends[whole] :] for c in waiting]
    if sums:
        yield out()


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value and rank; see the module text."""
    text = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")}
    thin = docs.select(*text.values(), F.col("text"))
    counts = write_table(term_counts(thin), "term-counts")
    kept = counts.groupBy("lang", *TERM).agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    kept = write_table(kept.filter(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    used = write_table(counts.drop("docs").join(kept, ["lang", *TERM]), "kept-counts")

    groups = thin.select("lang", "source").distinct()
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total"))
    own = used.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    stats = groups.join(own, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    zero = F.when(F.col("v") > 0, _p(F.lit(0).cast("long"), F.col("own"), F.col("v")))
    stats = write_table(stats.withColumns({"number": number, "zero": zero}), "group-sizes")

    rated = used.join(stats, ["lang", "source"]).withColumns(
        {
            "p": _p(F.col("n"), F.col("own"), F.col("v")),
            "q": _p(F.col("n_lang"), F.col("total"), F.col("v")),
        }
    )
    rated = write_table(rated.select("lang", "source", "number", *TERM, "p", "q", "zero"), "rated-terms")
    return _term_part(rated, top).unionByName(_pair_part(rated, stats))


def _term_part(rated: DataFrame, top: int) -> DataFrame:
    sign = F.lit(-(1 << 63))
    order = [F.desc("value"), F.col("w0").bitwiseXOR(sign), F.col("w1").bitwiseXOR(sign), F.col("rest")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    found = rated.filter("p > q").withColumn("value", F.expr(_f("p", "q"))).withColumn("rank", rank)
    found = found.filter(F.col("rank") <= top)
    return found.select("lang", "source", F.lit("term").alias("part"), _term_text().alias("item"), "value", "rank")


def _pair_part(rated: DataFrame, stats: DataFrame) -> DataFrame:
    side = lambda x: stats.select("lang", *(F.col(c).alias(f"{x}_{c}") for c in ("source", "number", "zero")), "v")
    pairs = side("a").join(side("b").drop("v"), "lang").filter("a_source != b_source")
    pairs = pairs.withColumn("base", F.expr(_f("a_zero", "b_zero")))

    # Terms that one source has, by their distinct p, against the other's p of count 0.
    spread = rated.groupBy("lang", F.col("number").alias("a"), "p", "zero").agg(F.count("*").alias("m"))
    spread = write_table(spread, "spread")
    others = stats.select("lang", F.col("number").alias("b"), F.col("zero").alias("z"))
    met = spread.join(others, "lang").filter("a != b")
    singles = met.groupBy("lang", "a", "b").agg(
        F.sum(F.expr(f"m * ({_f('p', 'z')} - {_f('zero', 'z')})")).alias("ours"),
        F.sum(F.expr(f"m * ({_f('z', 'p')} - {_f('z', 'zero')})")).alias("theirs"),
    )
    singles = write_table(singles, "singles")

    rows = rated.select("lang", *TERM, F.col("number").alias("source"), "p", "zero")
    rows = rows.repartition("lang", *TERM).sortWithinPartitions("lang", *TERM)
    joint = rows.mapInArrow(_joint_sums, "lang string, a long, b long, joint long")
    joint = joint.groupBy("lang", "a", "b").agg(F.sum("joint").alias("joint"))

    keys = {"a_number": "a", "b_number": "b"}
    pairs = pairs.withColumnsRenamed(keys)
    pairs = pairs.join(singles.select("lang", "a", "b", "ours"), ["lang", "a", "b"], "left")
    turned = singles.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "theirs")
    pairs = pairs.join(turned, ["lang", "a", "b"], "left").join(joint, ["lang", "a", "b"], "left")
    parts = [F.col("v") * F.col("base"), F.col("ours"), F.col("theirs"), F.col("joint")]
    value = sum((F.coalesce(x, F.lit(0)) for x in parts), F.lit(0).cast("long"))
    rank = F.row_number().over(Window.partitionBy("lang", "a_source").orderBy(F.desc("value"), "b_source"))
    return (
        pairs.withColumn("value", value)
        .withColumn("rank", rank)
        .select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), "value", "rank")
    )
