"""Secrets in texts: fixed patterns, and values in credential context by guess cost.

The guess cost of a value is the least sum over its segmentations of the segments' costs,
each the decimal logarithm of the guesses for it: common words (capitalised or with digits for
letters), dates and years, repeats of a unit, copies of an earlier part, sequences, keyboard walks,
and single characters by brute force. A dynamic program over the positions finds it.

Words cost by rank. Fixed common words of passwords have their place in the list; all others
are ranked by the number of documents that hold them outside credential context, over all
documents, and the most frequent ones of at least `MIN_DOCS` documents, at most `max_words`, are broadcast
(a word is at most `LONGEST_PATTERN` letters, so the ranking has a fixed size bound). A secret
that repeats in many documents is thus no word. Values that follow a name with a
credential word in it and `:` or `=`, a bearer marker, or stand as the password of a URL become
`guess` spans if their cost reaches `least_cost`, unless inside another; the spans of the fixed
patterns stay as they are. The search takes time in proportion to the text.

Positions are code points, ends exclusive. A null text is empty and has no span. Rows repeat
as they come, null ids are carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from presslens.llm import textkit
from presslens.sources import storage

LEAST_COST = 10.0
SEGMENT_COST = 0.3  # for telling where segments meet
LONGEST_PATTERN = 32  # longest word, date, walk or short repeat; longer ones are several, long repeats are copies
SEED = LONGEST_PATTERN // 2 + 1  # characters that a copy of an earlier part begins with
MAX_WORDS = 100_000  # ranked words
MIN_DOCS = 3
HELD_WORDS = 1 << 18  # distinct words that a task holds before it writes their counts
KINDS = ("assign", "access", "hex", "guess")

# The patterns of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as with + and a length test

CREDENTIAL = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "://")
# A name is tried from its start only, and whole; a credential word may stand anywhere in it.
NAME = re.compile(r"""(?<![A-Za-z0-9_.-])([A-Za-z0-9_.-]++)["']?[\x20\t]*+[:=][\x20\t]*+["']?""", re.ASCII)
WORD = re.compile(
    r"""pass(?:word|wd|phrase|code)|pwd|secret|token|credential|(?:api|access|private)[_.-]?key"""
    r"""|(?:pass|auth)(?:(?![a-z])|(?-i:(?=[A-Z])))""",  # not passenger, author
    re.ASCII | re.IGNORECASE,
)
LETTERS = re.compile(r"[^\W\d_]+")
VALUE = re.compile(r"""[^\s"'<>,;]{6,}""", re.ASCII)
MARKED = (
    re.compile(r"\bbearer\x20++([A-Za-z0-9+/_.=-]{6,})", re.ASCII | re.IGNORECASE),
    re.compile(r"(?<=[A-Za-z0-9+.-])://[^\s/:@]*+:([^\s/@]{6,}+)@", re.ASCII),
)

# Common words of passwords, most common first.
WORDS = (
    "password qwerty admin welcome login letmein dragon monkey master sunshine princess football "
    "baseball shadow superman iloveyou trustno secret summer winter spring autumn flower freedom "
    "whatever hello charlie michael jordan hunter ranger soccer hockey killer george computer "
    "internet service test demo guest root user default changeme example sample token access "
    "private public system server database manager support office company mobile phone"
).split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
SUBSTITUTES = str.maketrans("013457@$!", "oleastasi")
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
PLACE = {c: (x + y / 2, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])[-/._]?(?:19|20)\d\d",
    re.ASCII,
)
YEAR = re.compile(r"(?:19|20)\d\d", re.ASCII)


def _one(c: str) -> float:
    """Brute force: logarithm of the size of the character's class."""
    if c.isascii():
        return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() else math.log10(33)
    return 2.0


def _near(a: str, b: str) -> bool:
    if a not in PLACE or b not in PLACE or a == b:
        return False
    (xa, ya), (xb, yb) = PLACE[a], PLACE[b]
    return abs(ya - yb) <= 1 and abs(xa - xb) <= 1


def _segments(
    value: str, at: int, again: list[list[int]], copied: list[int], ranks: dict[str, int]
) -> Iterator[tuple[int, float]]:
    """(end, cost) of the patterns that begin at a position."""
    rest = value[at : at + LONGEST_PATTERN]
    low = rest.lower()
    plain = low.translate(SUBSTITUTES)
    for n in range(3, len(rest) + 1):
        for word, changed in ((low[:n], 0), (plain[:n], 1)):
            rank = RANK.get(word) or ranks.get(word)
            if rank:
                yield at + n, math.log10(rank + 1) + 0.5 * (changed + (rest[:n] != low[:n]))
                break
    for pattern, cost in ((DATE, math.log10(365 * 200)), (YEAR, math.log10(200))):
        found = pattern.match(value, at)
        if found:
            yield found.end(), cost
    step = ord(low[1]) - ord(low[0]) if len(low) > 1 else 9
    if abs(step) == 1 and low[0].isalnum():
        n = 2
        while n < len(low) and ord(low[n]) - ord(low[n - 1]) == step and low[n].isalnum():
            n += 1
        if n >= 3:
            yield at + n, math.log10(36 * 2 * n)
    n = 1
    while n < len(low) and _near(low[n - 1], low[n]):
        n += 1
    if n >= 3:
        turns = sum(
            (PLACE[low[i + 1]][0] - PLACE[low[i]][0], PLACE[low[i + 1]][1])
            != (PLACE[low[i]][0] - PLACE[low[i - 1]][0], PLACE[low[i]][1])
            for i in range(1, n - 1)
        )
        yield at + n, math.log10(len(PLACE) * n) + 0.6 * turns
    for unit in range(1, len(rest) // 2 + 1):
        times = 1 + again[unit - 1][at] // unit
        if times >= 2 and times * unit >= 3:
            yield at + times * unit, sum(map(_one, value[at : at + unit])) + math.log10(times)
    if copied[at]:
        yield at + copied[at], math.log10(at + 1) + math.log10(copied[at])


def _copied(value: str) -> list[int]:
    """For each position how far the value goes on as behind the last place with the same `SEED` characters."""
    out, seen, source = [0] * len(value), {}, -1
    for at in range(len(value) - SEED + 1):
        before, seed = source, value[at : at + SEED]
        source = seen.get(seed, -1)
        seen[seed] = at
        if source < 0:
            continue
        n = SEED
        if at and before >= 0 and source == before + 1:  # one on from the match of the last position
            n = max(n, out[at - 1] - 1)
        while at + n < len(value) and value[source + n] == value[at + n]:
            n += 1
        out[at] = n
    return out


def _again(value: str) -> list[list[int]]:
    """For each unit up to half the longest pattern: how far each position equals the one a unit on."""
    out = []
    for unit in range(1, min(len(value), LONGEST_PATTERN) // 2 + 1):
        run = [0] * (len(value) + 1)
        for at in range(len(value) - unit - 1, -1, -1):
            run[at] = run[at + 1] + 1 if value[at] == value[at + unit] else 0
        out.append(run)
    return out


def guess_cost(value: str, ranks: dict[str, int] | None = None) -> float:
    """Decimal logarithm of the guesses for a value, by its cheapest segmentation; ranks of further words."""
    best = [0.0] + [math.inf] * len(value)  # a pattern ends here
    force = [math.inf] * (len(value) + 1)  # a brute-force span ends here
    again, copied = _again(value), _copied(value)
    for at in range(len(value)):
        here = min(best[at], force[at])
        start = here + (SEGMENT_COST if at else 0.0)
        one = _one(value[at])
        force[at + 1] = min(force[at] + one, (best[at] + (SEGMENT_COST if at else 0.0)) + one)
        for end, cost in _segments(value, at, again, copied, ranks or {}):
            best[end] = min(best[end], start + cost)
    return min(best[-1], force[-1])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping within a kind."""
    low = text.lower()
    found = []
    if any(w in low for w in ("passw", "secret", "token", "key")):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _in_context(text: str) -> Iterator[tuple[int, int]]:
    """Values of names with a credential word, behind bearer markers, and passwords of URLs."""
    name = NAME.search(text)
    while name:
        value = VALUE.match(text, name.end()) if WORD.search(name[1]) else None
        if value:
            yield value.span()
        name = NAME.search(text, value.end() if value else name.end(1))
    for marked in MARKED:
        for m in marked.finditer(text):
            yield m.span(1)


def guessed_spans(text: str, least_cost: float, ranks: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """Values in credential context that cost at least so many guesses, without those inside another."""
    low = text.lower()
    if not any(w in low for w in CREDENTIAL):
        return []
    found, done = [], -1
    for start, end in sorted(_in_context(text), key=lambda s: (s[0], -s[1])):
        if end > done and guess_cost(text[start:end], ranks) >= least_cost:
            found.append(("guess", start, end))
            done = end
    return found


def written(spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then by the order of kinds."""
    order = sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"


def plain_words(text: str) -> set[str]:
    """Distinct lower-case words of a text, without the values in credential context."""
    low = text.lower()
    if any(w in low for w in CREDENTIAL):
        parts, done = [], 0
        for start, end in sorted(_in_context(text)):
            parts.append(text[done : max(done, start)])
            done = max(done, end)
        low = " ".join([*parts, text[done:]]).lower()
    return {w for w in LETTERS.findall(low) if 3 <= len(w) <= LONGEST_PATTERN}


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, documents) per task, a word again where a task meets very many distinct ones."""

    def written() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    held: Counter[str] = Counter()
    for batch in batches:
        for _, texts in textkit.slices(batch, "text"):
            for raw in texts:
                held.update(plain_words(raw.decode("utf-8", "replace")))
            if len(held) > HELD_WORDS:
                yield written()
                held.clear()
    yield written()


def word_ranks(docs: DataFrame, max_words: int = MAX_WORDS) -> dict[str, int]:
    """Rank of the words in most documents, equal ones in the order of their letters.

    A histogram of the counts, in at most 4,032 steps of about one percent, tells how far down the
    ranking goes: through the last step that ends within `max_words`. Only these words leave the tasks.
    """
    counts = docs.select("text").mapInArrow(_count_words, "word string, n long")
    step = F.floor(F.log2("n") * 64).cast("int").alias("step")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_DOCS)
    counts = storage.write_table(counts.select("word", "n", step), "word-counts")
    least, taken = None, 0
    for row in sorted(counts.groupBy("step").count().collect(), reverse=True):
        taken += row["count"]
        if taken > max_words:
            break
        least = row.step
    if least is None:
        return {}
    first = counts.filter(F.col("step") >= least).collect()
    return {r.word: i + 1 for i, r in enumerate(sorted(first, key=lambda r: (-r.n, r.word)))}


def _scanner(least_cost: float, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ranks = [c.split()[0] for c in FOUND.split(", ")], shared.value
        for batch in batches:
            for part, texts in textkit.slices(batch, "text"):
                rows = []
                for raw in texts:
                    text = raw.decode("utf-8", "replace")
                    base = base_spans(text)
                    more = guessed_spans(text, least_cost, ranks)
                    counts = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                    digest = hashlib.sha256(written(base, KINDS).encode()).hexdigest()
                    rows.append((*counts, len(more), digest, written(base + more, KINDS)))
                types = [pa.int64()] * 4 + [pa.string()] * 2
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    return run


def secrets(docs: DataFrame, least_cost: float = LEAST_COST, max_words: int = MAX_WORDS) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(word_ranks(thin, max_words))
    return thin.mapInArrow(_scanner(least_cost, shared), FOUND)
