"""Language of a text by interpolated Kneser-Ney models of characters.

Letters are lower-cased, everything between letters is one blank, and four characters pack
into one 64-bit key. Tasks count the keys per language over all training texts; the counts,
the continuation counts of the three lower orders (numbers of distinct longer keys) and the
discounts are Spark aggregates over all keys, none is dropped. The rows of a model are cut by
their context, read backwards, into segments of about `segment_rows` four-character rows. All
rows that a key's probability rests on share its context or a part of it, so a segment with
the at most 65,536 rows a language and order that reach over its edges answers its keys
alone. A segment is made into sorted arrays with interpolated probabilities and back-off
weights and broadcast; several segments are passes over the texts that add up, one at a time
in a worker. Rows of keys met before are remembered per worker within `CACHE_CELLS`. The
least cross-entropy per character wins.

The score is the winner's share of exp(-cross-entropy * characters), characters counted up
to `SURE`. `rejected` is calibrated on all training texts, whose scores are those returned:
true where the cross-entropy lies over `z` standard errors above its language's mean. A null
text or one without a letter is 'und' with score 0 and rejected. Without any training text all are
'und'. Ties go to the first language by name. Rows repeat as they come; columns of the input
named held_out, lang_pred, score or rejected are replaced, others kept; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from presslens.llm import textkit
from presslens.sources import storage

SEGMENT_ROWS = 1 << 21  # four-character rows of all languages in one broadcast, some 32 bytes each
CACHE_CELLS = 1 << 23  # remembered log-probabilities in a worker, 4 bytes each
OWN_ROWS = 30
SURE = 40
_PAD, _BLANK = 1, 32
_S16, _S32, _S48 = np.uint64(16), np.uint64(32), np.uint64(48)
_CHAR = np.uint64(0xFFFF)
_LAST = (1 << 48) - 1  # greatest context
_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case letter of each code point up to 65,535, blank for anything else."""
    if not _tables:
        table = np.full(1 << 16, _BLANK, np.uint16)
        for c in range(1 << 16):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                low = ord(chr(c).lower()[0])
                table[c] = low if low < 1 << 16 else c
        _tables.append(table)
    return _tables[0]


def keys_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all texts, first key of each text, and its number of letters.

    Key i of a text ends at its character i; before the first stand pads.
    """
    joined = "   ".join(["", *texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.concatenate(([3], lengths[:-1] + 3)))
    chars = _letters()[np.minimum(codes, 0xFFFF)]
    for at in np.flatnonzero(codes > 0xFFFF):  # rare: letters beyond 65,535 fold into it
        letter = chr(codes[at]).lower()
        chars[at] = 0xE000 + ord(letter[0]) % 0x1800 if letter.isalpha() else _BLANK
    for i in (1, 2, 3):
        chars[starts - i] = _PAD
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != _BLANK) | (chars[:-1] > _BLANK)
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    first = kept_before[starts]
    ends = kept_before[starts + lengths]
    letters = np.concatenate(([0], np.cumsum(chars > _BLANK)))
    n_letters = letters[starts + lengths] - letters[starts]
    c = chars[keep].astype(np.uint64)
    keys = np.zeros(len(c), np.uint64)
    keys[3:] = (c[:-3] << _S48) | (c[1:-2] << _S32) | (c[2:-1] << _S16) | c[3:]
    inside = np.zeros(len(c) + 1, np.int64)
    np.add.at(inside, first, 1)
    np.add.at(inside, ends, -1)
    chosen = np.cumsum(inside[:-1]) > 0
    return keys[chosen], np.concatenate(([0], np.cumsum(ends - first))), n_letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, n) per task, a key again where a task meets very many distinct ones."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    size = 0

    def compact(parts):
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        unique, inverse = np.unique(keys, return_inverse=True)
        return unique, np.bincount(inverse, counts, len(unique)).astype(np.int64)

    def written(held):
        for lang, parts in held.items():
            keys, counts = compact(parts)
            for i in range(0, len(keys), 1 << 16):
                k = keys[i : i + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k)), pa.array(k), pa.array(counts[i : i + (1 << 16)])],
                    names=["lang", "key", "n"],
                )

    for batch in batches:
        for part, texts in textkit.slices(batch, "text"):
            keys, at, _ = keys_of([t.decode("utf-8", "replace") for t in texts])
            by_lang = defaultdict(list)
            for i, lang in enumerate(part.column(0).to_pylist()):
                by_lang[lang].append(keys[at[i] : at[i + 1]])
            for lang, parts in by_lang.items():
                held[lang].append(np.unique(np.concatenate(parts), return_counts=True))
                size += len(held[lang][-1][0])
        if size > 1 << 21:
            held = defaultdict(list, {lang: [compact(p)] for lang, p in held.items()})
            size = sum(len(p[0][0]) for p in held.values())
            if size > 1 << 20:
                yield from written(held)
                held, size = defaultdict(list), 0
    yield from written(held)


def discount_of(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.75


def _order(keys: np.ndarray, counts: np.ndarray, discount: float, lower) -> dict:
    """One order of a model from sorted keys; `lower(keys)` is the next lower order's value."""
    if not len(keys):
        empty = np.zeros(0)
        return {"keys": keys, "p": empty, "contexts": keys, "weight": empty}
    contexts, first, types = np.unique(keys >> _S16, return_index=True, return_counts=True)
    totals = np.add.reduceat(counts, first)
    weight = discount * types / totals
    spread = np.repeat(np.arange(len(contexts)), types)
    p = np.maximum(counts - discount, 0) / totals[spread] + weight[spread] * lower(keys)
    return {"keys": keys, "p": p, "contexts": contexts, "weight": weight}


def _look_up(order: dict, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
    if not len(order["keys"]):
        return lower
    at = np.minimum(np.searchsorted(order["keys"], keys), len(order["keys"]) - 1)
    known = order["keys"][at] == keys
    context = keys >> _S16
    c = np.minimum(np.searchsorted(order["contexts"], context), len(order["contexts"]) - 1)
    weight = np.where(order["contexts"][c] == context, order["weight"][c], 1.0)
    return np.where(known, order["p"][at], weight * lower)


def probability(orders: list[dict], keys: np.ndarray) -> np.ndarray:
    """Probability of the last character of each key after the ones before it."""
    p = np.full(len(keys), 1 / (1 << 16))
    for i, order in enumerate(orders):
        part = keys & np.uint64((1 << 16 * (i + 1)) - 1)
        p = _look_up(order, part, p)
    return p


def kneser_ney(levels: list[tuple[np.ndarray, np.ndarray]], discounts: list[float]) -> list[dict]:
    """Orders 1 to 4 from the (sorted distinct keys, counts) and the discount of each."""
    orders: list[dict] = []
    for (keys, counts), discount in zip(levels, discounts):
        below = list(orders)
        orders.append(_order(keys, counts, discount, lambda k, below=below: probability(below, k)))
    return orders


def _context(key: Column) -> Column:
    """The three characters before the last one, read backwards."""
    char = lambda at: F.shiftrightunsigned(key, at).bitwiseAND(0xFFFF)
    return F.shiftleft(char(16), 32) + F.shiftleft(char(32), 16) + char(48)


def _levels(counts: DataFrame) -> DataFrame:
    """(lang, level, key, n, first, last): counts of all orders and the contexts that they serve."""
    level, out = counts.withColumn("level", F.lit(4)), None
    for order in (4, 3, 2, 1):
        if order < 4:  # how many distinct longer keys end in a key
            short = F.col("key").bitwiseAND((1 << 16 * order) - 1).alias("key")
            level = level.select("lang", short).groupBy("lang", "key").agg(F.count("*").alias("n"))
            level = level.withColumn("level", F.lit(order))
        first = _context(F.col("key"))
        last = first + F.lit((1 << 16 * (4 - order)) - 1)
        rows = level.select("lang", "level", "key", "n", first.alias("first"), last.alias("last"))
        out = rows if out is None else out.unionByName(rows)
    return out


def train(docs: DataFrame, segment_rows: int = SEGMENT_ROWS) -> dict:
    """Counts of all orders as a table, languages, discounts and the segments' edges, from (text, lang)."""
    rows = docs.filter("text is not null and lang is not null").select("lang", "text")
    counts = rows.mapInArrow(_count, "lang string, key long, n long")
    counts = storage.write_table(counts.groupBy("lang", "key").agg(F.sum("n").alias("n")), "language-counts")
    levels = storage.write_table(_levels(counts), "language-levels")
    totals = levels.groupBy("lang", "level").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
    )
    found = {(r.lang, r.level): r for r in totals.collect()}  # four rows per language
    langs = sorted({lang for lang, _ in found})
    discounts = [[discount_of(found[g, i].once, found[g, i].twice) for i in (1, 2, 3, 4)] for g in langs]
    parts = -(-sum(r.rows for (_, level), r in found.items() if level == 4) // segment_rows)
    inner = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = F.percentile_approx("first", shares, max(10_000, 20 * parts))
        inner = sorted(set(levels.filter("level = 4").agg(cuts).first()[0]))
    edges = [0, *(c for c in inner if c > 0), _LAST + 1]
    return {"langs": langs, "discounts": discounts, "levels": levels, "edges": edges}


def segment(model: dict, number: int) -> dict:
    """Sorted arrays of all languages for the keys whose context lies in one segment."""
    low, high = model["edges"][number], model["edges"][number + 1]
    rows = model["levels"].filter((F.col("first") < high) & (F.col("last") >= low))
    at = F.array_position(F.lit(model["langs"]), F.col("lang")).cast("int").alias("lang")
    held = rows.select(at, "level", "key", "n").toArrow()  # bounded by the segment
    lang, level, keys, counts = (np.asarray(c.combine_chunks()) for c in held.columns)
    keys = keys.view(np.uint64)
    sorting = np.lexsort((keys, level, lang))
    lang, level, keys, counts = lang[sorting], level[sorting], keys[sorting], counts[sorting]
    orders, group = [], lang.astype(np.int64) * 8 + level
    for i, discounts in enumerate(model["discounts"], 1):
        cuts = [np.searchsorted(group, [i * 8 + o, i * 8 + o + 1]) for o in (1, 2, 3, 4)]
        orders.append(kneser_ney([(keys[a:b], counts[a:b]) for a, b in cuts], discounts))
    return {"langs": model["langs"], "orders": orders, "low": low, "high": high}


def _log_rows(part: dict, keys: np.ndarray) -> np.ndarray:
    """(distinct sorted keys x languages) log-probabilities; those met before are remembered."""
    seen, rows = part.get("seen", (np.zeros(0, np.uint64), np.zeros((0, len(part["langs"])), np.float32)))
    place = np.searchsorted(seen, keys)
    known = np.zeros(len(keys), bool)
    inside = place < len(seen)
    known[inside] = seen[place[inside]] == keys[inside]
    out = np.empty((len(keys), len(part["langs"])), np.float32)
    out[known] = rows[place[known]]
    fresh = keys[~known]
    if len(fresh):
        for i, orders in enumerate(part["orders"]):
            out[~known, i] = np.log(probability(orders, fresh))
        if out.size <= CACHE_CELLS:
            if rows.size + len(fresh) * out.shape[1] > CACHE_CELLS:
                part["seen"] = (keys, out)
            else:
                part["seen"] = (np.insert(seen, place[~known], fresh), np.insert(rows, place[~known], out[~known], axis=0))
    return out


def log_sums(part: dict, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts x languages) sums of log-probabilities over the segment's keys."""
    sums = np.zeros((len(at) - 1, len(part["langs"])))
    if not part["langs"] or not len(keys):
        return sums
    if part["low"] > 0 or part["high"] <= _LAST:
        context = (((keys >> _S16) & _CHAR) << _S32) | (((keys >> _S32) & _CHAR) << _S16) | (keys >> _S48)
        chosen = (context >= np.uint64(part["low"])) & (context < np.uint64(part["high"]))
        at = np.concatenate(([0], np.cumsum(chosen)))[at]
        keys = keys[chosen]
    filled = np.flatnonzero(np.diff(at) > 0)
    if len(filled):
        distinct, inverse = np.unique(keys, return_inverse=True)
        values = _log_rows(part, distinct)
        for i in range(sums.shape[1]):  # one language at a time, so memory follows the text
            sums[filled, i] = np.add.reduceat(values[inverse, i], at[:-1][filled], dtype=np.float64)
    return sums


PREDICTED = "lang_pred string, score double, entropy double, n_scored long"


def _adding(shared):
    """Log-probability sums of a segment on top of those of earlier ones."""

    def run(column: pa.Array, before: pa.Array) -> pa.Array:
        part, rows = shared.value, []
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        for _, texts in textkit.slices(batch, "text"):
            keys, at, _ = keys_of([t.decode("utf-8", "replace") for t in texts])
            rows.append(log_sums(part, keys, at))
        sums = np.concatenate(rows) if rows else np.zeros((0, len(part["langs"])))
        for i, old in enumerate(before.to_pylist()):
            if old is not None:
                sums[i] += old
        return pa.array(sums.tolist(), pa.list_(pa.float64()))

    return run


def _choosing(langs: list[str]):
    def run(column: pa.Array, sums: pa.Array) -> pa.Array:
        rows, done = [], 0
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        for _, texts in textkit.slices(batch, "text"):
            _, at, letters = keys_of([t.decode("utf-8", "replace") for t in texts])
            for total, chars, some in zip(
                sums.slice(done, len(texts)).to_pylist(), np.diff(at).tolist(), letters.tolist()
            ):
                if not some or not langs:
                    rows.append(("und", 0.0, None, 0))
                    continue
                h = -np.array(total) / chars
                best = int(np.argmin(h))
                share = 1 / np.exp((h[best] - h) * min(chars, SURE)).sum()
                rows.append((langs[best], float(share), float(h[best]), chars))
            done += len(texts)
        names = ("lang_pred", "score", "entropy", "n_scored")
        types = (pa.string(), pa.float64(), pa.float64(), pa.int64())
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.StructArray.from_arrays(columns, names=names)

    return run


def scored(rows: DataFrame, model: dict, text: str, sums: str, answer: str) -> DataFrame:
    """rows with a column struct(lang_pred, score, entropy, n_scored) for the text.

    With several segments each pass writes the rows with their sums so far, so that one segment
    at a time is in a worker.
    """
    spark = rows.sparkSession
    rows = rows.withColumn(sums, F.lit(None).cast("array<double>"))
    passes = len(model["edges"]) - 1 if model["langs"] else 0
    for number in range(passes):
        shared = spark.sparkContext.broadcast(segment(model, number))
        rows = rows.withColumn(sums, F.arrow_udf(_adding(shared), "array<double>")(text, sums))
        if number + 1 < passes:
            rows = storage.write_table(rows, "language-pass")
    choice = F.arrow_udf(_choosing(model["langs"]), PREDICTED)(text, sums)
    return rows.withColumn(answer, choice).drop(sums)


def held_out(folds: int = 3, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold


def identified(
    docs: DataFrame, z: float = 8.0, segment_rows: int = SEGMENT_ROWS, keep: list[str] | None = None
) -> DataFrame:
    """The columns of docs (or those in `keep`) with held_out, lang_pred, score and rejected."""
    model = train(docs.filter(~held_out()), segment_rows)
    answers = ("held_out", "lang_pred", "score", "rejected")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in answers]
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    text, sums, a, held, learnt = (prefix + n for n in ("text", "sums", "answer", "held", "learnt"))
    rows = docs.select(
        *kept,
        F.col("text").alias(text),
        held_out().alias(held),
        (~held_out() & F.expr("text is not null and lang is not null")).alias(learnt),
    )
    rows = storage.write_table(scored(rows, model, text, sums, a).drop(text), "language-scores")
    known = rows.filter(F.col(learnt)).select(f"{a}.*").filter("n_scored > 0")
    moments = known.groupBy("lang_pred").agg(
        (F.sum(F.col("entropy") * F.col("n_scored")) / F.sum("n_scored")).alias("mean"),
        F.sum("n_scored").alias("chars"),
        F.sum(F.col("n_scored") * F.col("entropy") ** 2).alias("square"),
        F.count("*").alias("rows"),
    )
    fitted = moments.collect()  # one row per language
    apart = [max(0.0, r.square - r.chars * r["mean"] ** 2) for r in fitted]
    n_rows = max(1, sum(r.rows for r in fitted))
    pooled = (sum(apart) / n_rows) ** 0.5
    limits = []
    for row, squares in zip(fitted, apart):
        sd = (squares / row.rows) ** 0.5 if row.rows >= OWN_ROWS else pooled
        limits += [F.lit(row.lang_pred), F.struct(F.lit(row["mean"]).alias("mean"), F.lit(sd).alias("sd"))]
    answer = F.col(a)
    if limits:
        mean = sum(r.chars * r["mean"] for r in fitted) / sum(r.chars for r in fitted)
        others = F.struct(F.lit(mean).alias("mean"), F.lit(pooled).alias("sd"))
        limit = F.coalesce(F.create_map(*limits)[answer["lang_pred"]], others)
        bound = limit["mean"] + z * limit["sd"] / F.sqrt(F.greatest(answer["n_scored"], F.lit(1)))
        rejected = F.coalesce(answer["entropy"] > bound, F.lit(True))
    else:
        rejected = F.lit(True)
    return rows.select(
        *kept,
        F.col(held).alias("held_out"),
        answer["lang_pred"].alias("lang_pred"),
        answer["score"].alias("score"),
        rejected.alias("rejected"),
    )
