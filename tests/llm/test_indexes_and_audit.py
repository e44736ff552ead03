"""Centroid clustering, SimHash index and divergence audit against brute force, and their odd cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from presslens.llm import centroids, divergence, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("n", "fp", "v", "p", "cluster", "component_id", "rank", "value", "kept")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH}).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))


def brute_clusters(rows, k, rounds):
    """Plain rounds in Python's integers."""
    points = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(points, key=lambda p: (name(p[0]), p[1]))[:k]]

    def best(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in points:
            members[best(v)[1]].append(v)
        for i, own in members.items():
            centres[i] = [sum(c) // len(own) for c in zip(*own)]
    final = [(i, *best(v)) for i, v in points]
    inertia = collections.Counter()
    for _, d, c in final:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    whole = sum(inertia.values())
    return collections.Counter((i, c, d, inertia[c], whole, sha[c]) for i, d, c in final)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("rounds", [0, 3])
def test_clusters_equal_plain_rounds(spark, rounds):
    draw = random.Random(5)
    rows = [(i % 70, [draw.gauss(i % 5, 0.4) for _ in range(4)]) for i in range(80)] + [(None, [0.5] * 4)] * 3
    df = clashing(vectors(spark, rows)).repartition(5)
    got = collections.Counter(tuple(r) for r in centroids.clustered(df, 6, rounds, 4).collect())
    assert got == brute_clusters(rows, 6, rounds)


def test_clusters_leave_out_unsound_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0], [1.0, None], [1.0, nan], [inf, 1.0], [-inf, 1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v) for i, v in enumerate(bad)] + [(100, [1.0, 2.0]), (101, [1.0, 2.0])]
    got = centroids.clustered(vectors(spark, rows), 8, 2, 2).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in got) == [(100, 0, 0), (101, 0, 0)]
    assert {r.cluster for r in got} == {0}  # equal centroids: the smaller number
    assert centroids.clustered(vectors(spark, rows[:8]), 8, 2, 2).count() == 0
    assert centroids.clustered(vectors(spark, []), 8, 2, 2).count() == 0


def test_clusters_of_huge_components(spark):
    rows = [(i, [s * 3e38] * 64) for i, s in enumerate((1, -1) * 40)]
    got = centroids.clustered(vectors(spark, rows), 1, 1).collect()
    assert all(r.distance == 64 << 54 for r in got) and all(r.inertia is None for r in got)


def test_clusters_run_in_the_jvm(spark):
    df = centroids.clustered(vectors(spark, [(1, [0.0] * 64)]), 2, 1)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def plain_print(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_parts(prints, radius):
    """Root of each fingerprint under links of all pairs."""
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in distinct}


def brute_simhash(rows, k, radius):
    prints = [plain_print(t, k) for _, t in rows]
    part = brute_parts(prints, radius)
    least = {}
    for (d, _), f in zip(rows, prints):
        if d is not None:
            least[part[f]] = min(d, least.get(part[f], d))
    return collections.Counter((d, f"{f:016x}", least.get(part[f])) for (d, _), f in zip(rows, prints))


def test_simhash_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAGE", 8)
    monkeypatch.setattr(simhash, "FANOUT", 3)
    monkeypatch.setattr(simhash, "LEAF", 3)
    monkeypatch.setattr(simhash, "HASHES", 5)
    draw = random.Random(3)
    rows = []
    for base in range(25):
        text = [f"w{draw.randrange(40)}" for _ in range(120)]
        for copy in range(base % 6 + 1):
            changed = list(text)
            for at in draw.sample(range(120), copy % 4):
                changed[at] = f"x{copy}"
            rows.append((1000 - len(rows), " ".join(changed)))
    rows += [(1, None), (2, ""), (3, " \t\x0b"), (4, "One"), (4, "one"), (5, "a b"), (None, "A B"), (None, "alone here now"), (6, "é ſ K\x00 x")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = collections.Counter(tuple(r) for r in simhash.near_duplicates(df, 3, 3).collect())
    assert got == brute_simhash(rows, 3, 3)


def test_index_meets_every_link(spark, monkeypatch):
    """Dense groups, where every page links with others, through all levels of the tree."""
    monkeypatch.setattr(simhash, "PAGE", 16)
    monkeypatch.setattr(simhash, "FANOUT", 2)
    draw = random.Random(9)
    prints = {0, (1 << 64) - 1}
    for _ in range(30):
        x = draw.getrandbits(64)
        for _ in range(draw.choice((1, 5, 40))):
            prints.add(x)
            for bit in draw.sample(range(64), draw.choice((1, 3, 4))):
                x ^= 1 << bit
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    got = {r.fp: r.part for r in simhash._parts(spark.createDataFrame(signed, "fp long"), 3).collect()}
    part = brute_parts(prints, 3)
    groups = collections.defaultdict(set)
    for f, label in got.items():
        groups[label].add(f % (1 << 64))
    wanted = collections.defaultdict(set)
    for f, label in part.items():
        wanted[label].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_close_pairs_equal_all_pairs():
    draw = np.random.default_rng(2)
    for n, m in ((1, 1), (17, 40), (33, 5)):
        a = np.sort(draw.integers(0, 1 << 12, n).astype(np.uint64))
        b = np.sort(draw.integers(0, 1 << 12, m).astype(np.uint64))
        i, j = simhash.close_pairs(a, b, 2)
        assert set(zip(i, j)) == {(x, y) for x in range(n) for y in range(m) if int(a[x] ^ b[y]).bit_count() <= 2}


def test_simhash_long_text_and_empty_table(spark, monkeypatch):
    text = " ".join(f"w{i * i % 9973}" for i in range(3000)) + " " + "y" * 5000
    whole = simhash.fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash.textkit, "SLICE_BYTES", 1000)
    assert simhash.fingerprint(text.encode(), 3) == whole == plain_print(text, 3)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_audit(rows, min_docs, top):
    """All terms of all pairs, in Python's integers."""
    count, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = collections.Counter()
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= min_docs]
        sources = [s for x, s in groups if x == lang]
        by = {s: [count[lang, s, t] for t in kept] for s in sources}
        whole = [sum(by[s][i] for s in sources) for i in range(len(kept))]
        rate = lambda ns: [1 + 10**9 * (n + 1) // (sum(ns) + len(ns)) for n in ns]
        p, q = {s: rate(by[s]) for s in sources}, rate(whole)
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pairs = [(o, sum(map(f, p[s], p[o]))) for o in sources if o != s]
            terms = [(t, f(x, y)) for t, x, y, n in zip(kept, p[s], q, by[s]) if n and x > y]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                for r, (item, value) in enumerate(items[:most], 1):
                    out[lang, s, part, item, value, r] += 1
    return out


def audit_rows():
    draw = random.Random(4)
    stems = ["a", "Ab", "bcdefgh", "bcdefghi", "bcdefghij", "été", "x" * 16, "x" * 17, "x" * 300, "ünïcode" * 5, "zz z"]
    stems += [f"{a}{b}" for a in ("mor", "tal", "quendis", "straordinario") for b in ("ab", "ec", "id", "ovalenti")]
    rows = []
    for i in range(150):
        text = " ".join(draw.choices(stems, k=draw.randrange(12))) + draw.choice(("", "1", "-A_b", "\x00Q", "\U0001f600"))
        rows.append((text, draw.choice(("de", "en", "en")), draw.choice(("s0", "s0", "s1", "S2", "é", None))))
    rows += [(None, None, None), ("", "en", "empty"), ("ONE two", "xx", "only"), ("a a", "yy", "one"), ("b", "yy", "two"), *[("term", "zz", "a")] * 3]
    return rows


def run_audit(spark, rows, **kw):
    df = clashing(spark.createDataFrame(rows, "text string, lang string, source string")).repartition(4)
    return collections.Counter(tuple(r) for r in divergence.audit(df, **kw).collect())


def test_audit_equals_plain_sums(spark):
    assert run_audit(spark, audit_rows(), top=5) == plain_audit(audit_rows(), 3, 5)


def test_audit_in_small_steps(spark, monkeypatch):
    """Flushed buffers, cut texts and split runs give the same."""
    for name, value in (("PIECE", 64), ("BUFFER", 40), ("PAIRS", 20)):
        monkeypatch.setattr(divergence, name, value)
    rows = audit_rows() + [(" ".join(t or "" for t, _, _ in audit_rows()), "en", "s1")]
    monkeypatch.setattr(divergence.textkit, "SLICE_BYTES", 200)
    assert run_audit(spark, rows) == plain_audit(rows, 3, 200)


def test_long_texts_are_counted_once_per_document(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 50)
    monkeypatch.setattr(divergence, "BUFFER", 3)
    counter = divergence._Counter()
    text = ("alpha beta " + "g" * 40 + " ") * 20
    group = np.array([counter.groups.setdefault(("en", "s"), 0)])
    for piece in divergence._cut(text.encode()):
        counter.add([piece], group, 0)
        counter.shrink()
    batches = [b.to_pydict() for b in counter.batches()]
    assert sorted(n for b in batches for n in b["n"]) == [20, 20, 20]
    assert [d for b in batches for d in b["docs"]] == [1, 1, 1]


def test_radix_order_is_stable():
    draw = np.random.default_rng(1)
    high, low = draw.integers(0, 3, 500).astype(np.uint64), draw.integers(0, 1 << 60, 500).astype(np.uint64)
    low[::3] = low[0]
    assert np.array_equal(divergence.radix_order(high, low), np.lexsort((low, high)))


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
