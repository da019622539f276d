"""Components, SimHash and line dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varlake.llm import line_dedup, simhash
from varlake.llm.components import connected_components
from varlake.llm.line_dedup import dedup_lines
from varlake.llm.queries import QUERIES
from varlake.llm.simhash import _split_hot, fingerprint_texts, near_dedup, near_dup_classes, near_links


def classes_of(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


# ---- components
@pytest.mark.parametrize("case", ["random", "path", "hub", "none"])
def test_components(spark, case):
    random = np.random.default_rng(3)
    pairs = {
        "random": random.integers(0, 400, (300, 2)).tolist(),
        "path": [(i, i + 1) for i in random.permutation(60).tolist()],
        "hub": [(500, i) for i in range(300)] + [(500, 500)],
        "none": [],
    }[case]
    df = spark.createDataFrame([*pairs, (None, 1)], "a long, b long")
    want = classes_of(501, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = connected_components(df).collect()
    assert len(got) == len(linked)
    assert {r["node"]: r["component"] for r in got} == {x: want[x] for x in linked}


# ---- SimHash
def fingerprint(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list("abÀZ \n\t\x0b\x1c\xa0é")), max_size=80), min_size=1, max_size=6))
def test_fingerprints(texts):
    assert fingerprint_texts(texts, 4).tolist() == [fingerprint(t, 4) for t in texts]


def test_long_texts_in_stretches(monkeypatch):
    monkeypatch.setattr(simhash, "STRETCH", 40)
    texts = ["one two three four five six seven eight " * 60, "x" * 500, "a b c", " " * 200, "word " * 700]
    assert fingerprint_texts(texts, 4).tolist() == [fingerprint(t, 4) for t in texts]


def links_brute(values, bits):
    v = np.array(values, np.uint64)
    return [(i, int(j)) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= bits) + i + 1]


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_links_connect_what_is_near(spark, bits):
    random = np.random.default_rng(bits)
    values = list({int(x) for x in random.integers(0, 2**64, 200, dtype=np.uint64)})
    for v in values[:100]:  # chains and dense groups, also beyond a small key
        for n in range(60 if v == values[0] else 3):
            for b in random.integers(0, 64, random.integers(1, bits + 3)):
                v ^= 1 << int(b)
            values.append(v if n % 2 else v ^ 1)
    values = sorted(set(values))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    index = {v: i for i, v in enumerate(values)}
    found = [(index[r["a"] % (1 << 64)], index[r["b"] % (1 << 64)]) for r in near_links(df, bits).collect()]
    brute = links_brute(values, bits)
    assert set(found) <= {*brute, *((b, a) for a, b in brute)}
    assert classes_of(len(values), found) == classes_of(len(values), brute)


def test_hot_keys_are_cut_into_blocks(spark):
    """One segment in common, so all share a key: no group of a key is larger than
    two blocks, and what is connected is what brute force connects."""
    random = np.random.default_rng(3)
    values = np.unique((random.integers(0, 1 << 10, 400, dtype=np.uint64) << np.uint64(30)) | np.uint64(7))
    df = spark.createDataFrame([(int(v),) for v in values], "fingerprint long")
    index = {int(v): i for i, v in enumerate(values)}
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 4
    want = classes_of(len(values), [(int(i), int(j)) for i, j in zip(*np.nonzero(near), strict=True) if i < j])
    for block in (20, 100, 1_000):
        pairs = [(index[r["a"]], index[r["b"]]) for r in near_links(df, 4, block).collect()]
        assert all(near[i, j] for i, j in pairs)
        assert classes_of(len(values), pairs) == want
    keyed = df.select(F.lit(1).cast("long").alias("k"), "fingerprint").unionByName(df.limit(5).select(F.lit(2).cast("long").alias("k"), "fingerprint"))
    sizes = [r["count"] for r in _split_hot(keyed, 20).groupBy("k").count().collect()]
    assert max(sizes) < 2 * 20 * 2 and 5 in sizes  # two blocks as hashing fills them
    met = {}
    for r in _split_hot(keyed, 20).where("k != 2").collect():
        met.setdefault(r["fingerprint"], set()).add(r["k"])
    own = list(met.values())
    assert len(own) == len(values) and all(x & y for x in own for y in own)


def test_dense_keys_give_a_forest():
    base = np.uint64(0x1234567890ABCDEF)
    ball = np.unique(np.array([base ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(64) for j in range(i)]))
    a, b = simhash._links(np.zeros(len(ball), np.int64), ball, 4)
    assert len(a) == len(ball) - 1 and (np.bitwise_count(a ^ b) <= 4).all()


ROWS = [(1, "a b c d e"), (2, "A  b\nC d e"), (3, None), (4, ""), (5, "\x0b \t"), (7, "zebra " * 30), (6, "zebra " * 31), (8, "other words stand here now"), (8, "other words stand here now"), (None, "a b c d e"), (None, "nothing like it")]


def test_classes_of_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 99) for i, t in ROWS], "doc_id long, text string, component_id int")
    got = sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in near_dup_classes(df, 4, 4).collect()), key=str)
    prints = [fingerprint(t, 4) for _, t in ROWS]
    root = classes_of(len(ROWS), links_brute(prints, 4))
    least = {c: min((i for (i, _), r in zip(ROWS, root) if r == c and i is not None), default=None) for c in set(root)}
    assert got == sorted([(i, p, least[r]) for (i, _), p, r in zip(ROWS, prints, root)], key=str)
    kept = near_dedup(df, 4, 4)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 3, 6, 8, None], key=str)
    assert near_dup_classes(df.limit(0)).isEmpty() and near_dedup(df.limit(0)).isEmpty()


def test_registered_simhash(spark, sf):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [fingerprint(t, 4) for _, t in docs]
    root = classes_of(len(docs), links_brute(prints, 4))
    want = {i: (f"{p:016x}", docs[r][0]) for (i, _), p, r in zip(docs, prints, root)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash_near_dedup"](spark, sf).collect()} == want


# ---- lines
def dedup_brute(rows, threshold=0.8):
    """The texts without their later like lines, in the order of the ids."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    places = [(i, j, line.strip()) for i in order for j, line in enumerate((rows[i][1] or "").split("\n")) if line.strip()]
    distinct = list(dict.fromkeys(p[2] for p in places))
    sets = [line_dedup.shingles(x) for x in distinct]
    pairs = [
        (a, b)
        for a in range(len(distinct))
        for b in range(a + 1, len(distinct))
        if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) >= threshold * max(len(sets[a]), len(sets[b])) and line_dedup.jaccard(sets[a], sets[b]) >= threshold
    ]
    root = classes_of(len(distinct), pairs)
    number = {x: root[i] for i, x in enumerate(distinct)}
    first, gone = {}, {i: set() for i in range(len(rows))}
    for i, j, line in places:
        if first.setdefault(number[line], (i, j)) != (i, j):
            gone[i].add(j)
    return [None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[i]) for i, (_, t) in enumerate(rows)]


def prose(random, n):
    return " ".join("".join(random.choice(list("abcdefghij"), 5)) for _ in range(n))


def test_lines_against_brute_force(spark):
    random = np.random.default_rng(9)
    lines = [prose(random, n) for n in random.integers(3, 40, 40)]

    def changed(line, n):
        c = list(line)
        for p in random.integers(0, len(c), n):
            c[p] = "Z"
        return "".join(c)

    docs = []
    for i in range(60):
        own = [prose(random, 8)]
        for k in random.integers(0, len(lines), 4):
            own.append(changed(lines[k], random.integers(0, 2)) if len(lines[k]) > 150 else lines[k])
        docs.append((i, "\n".join(own)))
    big = prose(random, 80)
    docs += [(100 + i, changed(big, 3)) for i in range(40)]
    docs += [(None, lines[0]), (3, "  " + lines[1] + "\r\n\n\nshort\nshort"), (200, None), (201, ""), (202, "short\n \n" + lines[2])]
    df = spark.createDataFrame([(i, t, "v") for i, t in docs], "doc_id long, text string, n_lines string").coalesce(3)
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    want = dedup_brute(docs)
    rows = got.collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=key) == sorted(((i, t) for (i, _), t in zip(docs, want)), key=key)
    assert sum(r["n_removed"] for r in rows) > 150
    assert all(r["n_lines"] == (0 if r["text"] is None else len(r["text"].split("\n")) * (r["n_removed"] == 0) or r["n_lines"]) for r in rows)


@settings(max_examples=300, deadline=None)
@given(a=st.text(st.sampled_from(list("abé ÿ日")), min_size=8, max_size=70), b=st.text(st.sampled_from(list("abé ÿ")), min_size=8, max_size=70), cut=st.integers(0, 60))
def test_line_similarity_is_exact(a, b, cut):
    for x, y in ((a, b), (a, a[:cut] + b), (b, b[:cut] + b), (b, b[cut:] + b[:8])):
        want = line_dedup.jaccard(line_dedup.shingles(x), line_dedup.shingles(y))
        p, q = line_dedup.Line(x), line_dedup.Line(y)
        assert p.similarity(q) == q.similarity(p) == want
        assert all(p.may_be_alike(q, t) for t in (0.2, 0.5, 0.8) if want >= t)


@pytest.mark.parametrize("batch", [1, 2, 7, 10_000])
def test_shared_keys_across_batches(spark, batch):
    random = np.random.default_rng(batch)
    rows = [(int(k), int(h)) for k, h in zip(random.integers(0, 60, 300), random.integers(0, 9, 300))] + [(99, 4), (99, 4)]
    lines = {}
    for k, h in rows:
        lines.setdefault(k, set()).add(h)
    want = {(k, h) for k, hs in lines.items() if len(hs) > 1 for h in hs}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = line_dedup._shared_keys(spark.createDataFrame(rows, "k long, h long")).collect()
        assert {(r["k"], r["h"]) for r in got} == want
        rep = dict((r["k"], r["rep"]) for r in got)
        assert all(r["rep"] == rep[r["k"]] and (r["k"], r["rep"]) in want for r in got)
        values = spark.createDataFrame([(v,) for v in range(40)], "fingerprint long")
        pairs = [(r["a"], r["b"]) for r in near_links(values, 4).collect()]
        assert classes_of(40, pairs) == [0] * 40
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("block", [1, 3])
def test_cross_links_in_blocks(spark, monkeypatch, block):
    """Lines that are not like a key's smallest line still find each other."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    base, other = "abcdefghijklmnopqrstuvwxyz" * 4, "0123456789" * 3 + "the quick brown fox jumps over the lazy dog"
    lines = [base, base + "1", base + "2", other, other + "!", other + "?", "alone and unlike all the others in here"]
    texts = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "h long, line string")
    found = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "h long, component long")
    shared = texts.selectExpr("1L AS k", "h", "0L AS rep")
    monkeypatch.setattr(line_dedup, "_indexed", lambda rows: rows)
    monkeypatch.setattr(line_dedup, "_shared_keys", lambda rows: shared)
    monkeypatch.setattr(line_dedup, "_texts", lambda *a: texts)
    del found
    got = {r["h"]: r["component"] for r in line_dedup._components(texts, texts, 0.8).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}


@pytest.mark.parametrize("outside", [300, 40])
def test_no_group_of_a_hot_key_has_more_than_two_blocks(spark, monkeypatch, outside):
    """Lines under one key that are unlike its smallest line and each other, but for two pairs."""
    monkeypatch.setattr(line_dedup, "BLOCK", 20)
    random = np.random.default_rng(4)
    base = prose(random, 40)
    lines = [base] + [base + str(i) for i in range(90)] + [prose(random, 12) for _ in range(outside)]
    lines += [lines[95] + "!", lines[120] + "!"]
    texts = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    shared = texts.selectExpr("1L AS k", "h", "0L AS rep")
    groups = []
    links = line_dedup._cross_links

    def watched(members, threshold):
        groups.extend((r["block"], r["h"]) for r in members.select("block", "h").collect())
        return links(members, threshold)

    monkeypatch.setattr(line_dedup, "_indexed", lambda rows: rows)
    monkeypatch.setattr(line_dedup, "_shared_keys", lambda rows: shared)
    monkeypatch.setattr(line_dedup, "_texts", lambda *a: texts)
    monkeypatch.setattr(line_dedup, "_cross_links", watched)
    got = {r["h"]: r["component"] for r in line_dedup._components(texts, texts, 0.8).collect()}
    n = len(lines)
    assert got == {**{h: 0 for h in range(91)}, 95: 95, 120: 120, n - 2: 95, n - 1: 120}
    held = {}
    for block, h in groups:
        held.setdefault(block, []).append(h)
    assert max(map(len, held.values())) <= 2 * 40  # blocks by hash are of 20 lines or so
    met = {(a, b) for hs in held.values() for a in hs for b in hs if a < b}
    assert met >= {(a, b) for b in range(91, n) for a in range(1, b)}


def test_lines_with_one_change_are_alike(spark):
    """An inner character of a line of 60, and a word of six letters in one of 110."""
    short = "every reader of this page may write to us at the old address"
    long = "the committee met on the second of march in order to discuss the plans for a bridge over the river at its mouth"
    docs = [(1, f"{short}\n{long}\nabcdefg\nabcd"), (2, short.replace("page", "pace")), (3, long.replace("bridge", "tunnel")), (4, "abcdefh\nabce\nabcd")]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "", 3: "", 4: "abcdefh\nabce"}


def test_lines_of_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_registered_line_dedup(spark, sf):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r["doc_id"]: r["text"] for r in QUERIES["op10_line_dedup"](spark, sf).collect()}
    assert got == {i: t for (i, _), t in zip(docs, dedup_brute(docs))}


def test_sketches_and_shingle_numbers():
    """Sketches of equal lines are equal, of alike lines seldom far apart, of others mostly."""
    random = np.random.default_rng(8)
    lines = ["".join(random.choice(list("abcdefgh é€"), random.integers(5, 200))) for _ in range(400)]
    assert line_dedup.distinct_shingles(lines).tolist() == [len(line_dedup.shingles(x)) for x in lines]
    sketch = line_dedup.sketches(lines).view(np.uint64)
    assert (line_dedup.sketches(lines[::-1]).view(np.uint64)[::-1] == sketch).all()
    far = line_dedup.apart(sketch[1:], sketch[:-1])
    assert 20 < far.mean() < 28
    near = []
    for x in lines:
        if len(x) > 60:
            near.append((x, x[:20] + "#" + x[21:]))
    near = [(x, y) for x, y in near if line_dedup.jaccard(line_dedup.shingles(x), line_dedup.shingles(y)) >= 0.8]
    a, b = (line_dedup.sketches([p[i] for p in near]).view(np.uint64) for i in (0, 1))
    assert len(near) > 100 and (line_dedup.apart(a, b) <= line_dedup.SKETCH_APART).all()


@pytest.mark.parametrize("stretch", [30, 100_000])
def test_pairs_of_lines_are_compared_together(monkeypatch, stretch):
    """Many pairs at once give what each gives alone, also beyond Latin-1."""
    monkeypatch.setattr(line_dedup, "BLOCK_CHARS", stretch)
    random = np.random.default_rng(8)
    x = ["".join(random.choice(list("abé ÿ日"[: 5 + i % 2]), 5 + i % 40)) for i in range(300)]
    y = [a[: int(random.integers(0, 4))] + a + b[:2] if i % 3 else b + b for i, (a, b) in enumerate(zip(x, x[::-1]))]
    for t in (0.2, 0.5, 0.8):
        want = [line_dedup.jaccard(line_dedup.shingles(a), line_dedup.shingles(b)) >= t for a, b in zip(x, y)]
        assert line_dedup.alike(x, y, t).tolist() == want and 0 < sum(want) < len(x)
    assert line_dedup.alike([], [], 0.8).tolist() == []


def test_no_task_of_line_dedup_needs_two_python_workers(spark, monkeypatch):
    """A map over another's rows, with no shuffle between, holds a worker of its own in each task."""
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    stored = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", watched)
    text = "every reader of this page may write to us at the old address"
    docs = [(i, f"{text}{i}\nabcdefg{i}") for i in range(20)]
    plans.append(dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString())
    assert sum("MapInArrow" in p for p in plans) >= 5
    for plan in plans:
        maps = 0
        for line in plan.split("\n"):
            maps = 0 if "Exchange" in line else maps + ("MapInArrow" in line)
            assert maps < 2, plan


@pytest.mark.parametrize("held, batch", [(250_000, 10_000), (40, 1), (3, 7)])
def test_lines_meet_by_bucket(spark, monkeypatch, held, batch):
    """Keys of few lines give pairs that may be alike, keys of more their lines; none is lost,
    however little of a bucket is held."""
    monkeypatch.setattr(line_dedup, "HELD", held)
    random = np.random.default_rng(held)
    keys = [*range(40), *(int(x) << 53 for x in range(-30, 30))]
    rows = [(int(k), int(h)) for k in keys for h in random.integers(0, 90, random.integers(1, 7))] + [(k, h) for k in (5, 7 << 53) for h in range(90)] * 2
    sketch = random.integers(-(1 << 63), (1 << 63) - 1, 3)
    parts = {}
    for i in random.permutation(len(rows)).tolist():
        k, h = rows[i]
        parts.setdefault((k % (1 << 64) >> 52, int(random.integers(0, 9))), []).append((k, h, int(sketch[h % 3])))
    blobs = [(b, bytearray(np.array(x, np.int64).tobytes())) for (b, _), x in parts.items()]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = line_dedup._met(spark.createDataFrame(blobs, "bucket int, signed binary")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    lines = {}
    for k, h in rows:
        lines.setdefault(k, set()).add(h)
    many = {k for k, hs in lines.items() if len(hs) > line_dedup.FEW}
    assert {(r["k"], r["h"]) for r in got if r["other"] is None} == {(k, h) for k in many for h in lines[k]} and len(many) == 2
    want = {(a, b) for k, hs in lines.items() if k not in many for a in hs for b in hs if a < b and a % 3 == b % 3}
    assert {(r["h"], r["other"]) for r in got if r["k"] is None} == want


def test_line_keys_travel_many_in_a_row(spark):
    """A row for each key and line would be 12 for each of 3,000 lines."""
    random = np.random.default_rng(6)
    docs = [("\n".join(prose(random, 9) + str(i * 50 + j) for j in range(50)),) for i in range(60)]
    signed = line_dedup._signed(spark.createDataFrame(docs, "text string").coalesce(1)).collect()
    assert len(signed) <= 1 << line_dedup.BUCKET_BITS
    rows = np.concatenate([np.frombuffer(r["signed"], np.int64).reshape(-1, 3) for r in signed])
    lines = [x for (d,) in docs for x in d.split("\n")]
    keys, sketch = line_dedup.signatures(lines)
    want = {(k, line_dedup.line_hash(x), s) for x, own, s in zip(lines, keys.tolist(), sketch.tolist()) for k in own}
    assert len(rows) == 12 * 3_000 and {tuple(r) for r in rows.tolist()} == want
    assert all(k % (1 << 64) >> 52 == r["bucket"] for r in signed for k in np.frombuffer(r["signed"], np.int64)[::3].tolist())


def test_sketches_of_keys_keep_pairs_that_are_alike():
    random = np.random.default_rng(8)
    lines = ["".join(random.choice(list("abcdefgh é€"), random.integers(60, 200))) for _ in range(2_000)]
    pairs = [(x, x[:20] + "#" + x[21:]) for x in lines]
    pairs = [(x, y) for x, y in pairs if line_dedup.jaccard(line_dedup.shingles(x), line_dedup.shingles(y)) >= 0.8]
    (k, a), (m, b) = (line_dedup.signatures([p[i] for p in pairs]) for i in (0, 1))
    assert len(pairs) > 1_000 and (line_dedup.apart(a.view(np.uint64), b.view(np.uint64)) <= line_dedup.SKETCH_APART).all()
    assert (k == m).any(axis=1).mean() > 0.99
    far = line_dedup.apart(a[1:].view(np.uint64), a[:-1].view(np.uint64))
    assert 20 < far.mean() < 28


@pytest.mark.parametrize("held, signed", [(250_000, 500_000), (5, 40)])
def test_places_of_lines_travel_with_their_keys(spark, monkeypatch, held, signed):
    """Each place is told once, a line's first one is one row, and of a line that is everywhere
    two places a task at most go to the bucket of its hash."""
    monkeypatch.setattr(line_dedup, "HELD", held)
    monkeypatch.setattr(line_dedup, "SIGNED", signed)
    docs = [(i * 1_000, f"line {i}, alone\n\n  everywhere  \nabc\nin three {i % 30}\neverywhere") for i in range(90)]
    want = [(line_dedup.line_hash(x), u, no) for u, d in docs for no, x in enumerate(line_dedup.lines_of(d)) if x]
    rows = line_dedup._signed(spark.createDataFrame(docs, "uid long, text string").coalesce(2), places=True)
    at_home = [np.frombuffer(r["signed"], np.int64)[::3] for r in rows.collect() if 1 << line_dedup.BUCKET_BITS <= r["bucket"] < line_dedup.AGAIN]
    common = {line_dedup.line_hash(x) for x in ("everywhere", "abc")}
    assert max(int((x == h).sum()) for x in at_home for h in common) == 2
    got = line_dedup._met(rows).where("u is not null").collect()
    assert sorted((r["h"], r["u"], r["l"]) for r in got) == sorted(want)
    times = {}
    for h, _, _ in want:
        times[h] = times.get(h, 0) + 1
    assert sorted(r["h"] for r in got if r["place"] != line_dedup.FURTHER) == sorted(times)
    assert {r["h"] for r in got if r["place"] == line_dedup.ONLY} == {h for h, n in times.items() if n == 1}


def test_texts_are_taken_apart_once_before_lines_are_looked_up(spark, monkeypatch):
    taken = []
    arrow_map = line_dedup.arrow_map
    monkeypatch.setattr(line_dedup, "arrow_map", lambda df, *a: taken.append(df.columns) or arrow_map(df, *a))
    docs = [(None, "the first of all lines\nxyz"), ("b", "the first of all lines 2\nxyz\nxyz"), ("a", "xyz\nthe first of all lines\n\nthe first of all lines")]
    got = dedup_lines(spark.createDataFrame(docs, "id string, body string").coalesce(1), id_col="id", text_col="body").collect()
    assert {r["id"]: (r["body"], r["n_lines"], r["n_removed"]) for r in got} == {None: ("", 2, 2), "b": ("", 3, 3), "a": ("xyz\nthe first of all lines\n", 4, 1)}
    assert sum("text" in columns for columns in taken) == 2


def test_partners_of_large_groups_are_found_in_stretches(spark, monkeypatch):
    """However few pairs are held against each other at a time."""
    random = np.random.default_rng(11)
    lines = [prose(random, 12) for _ in range(60)]
    lines += [x + "!" for x in lines[:30]]
    sketch, size = line_dedup.sketches(lines).tolist(), line_dedup.distinct_shingles(lines).tolist()
    rows = [(1, 0, True, h, h % 50, s, n, x) for h, (s, n, x) in enumerate(zip(sketch, size, lines))]
    members = spark.createDataFrame(rows, "k long, block long, here boolean, h long, component long, sketch long, size int, line string")
    seen = []
    for at_once in (7, 30_000):
        monkeypatch.setattr(line_dedup, "AT_ONCE", at_once, raising=False)
        near = {r["h"]: r["near"] for r in line_dedup._with_partners(members, 0.8).collect()}
        links = {tuple(sorted((r["a"], r["b"]))) for r in line_dedup._cross_links(members, 0.8).collect()}
        seen.append((near, links))
    assert seen[0] == seen[1] and seen[0][1] == {(i, i + 60) for i in range(30)}
    assert all(seen[0][0][h] for i in range(30) for h in (i, i + 60))
