"""The Merkle manifest against a plain tree."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from varlake.llm import merkle
from varlake.llm.merkle import folded, leaf_digest, merkle_manifest, recompute_roots
from varlake.llm.queries import QUERIES


def digest(text):
    return sha256(text.encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, fanout=2):
    """The root and the proof of each leaf, as hex text."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in zip(at, proofs, strict=True):
            first = i // fanout * fanout
            p += [level[j] for j in range(first, min(first + fanout, len(level))) if j != i]
        level = [digest("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return (level[0] if level else None), proofs


def order(v):
    return (v is not None, v if v is not None else 0)


def manifest(rows, fanout=2):
    """By group: {(key, leaf): (subroot, root, proof)} in lists, for (key, group, leaf)."""
    groups = {}
    for key, group, leaf in rows:
        groups.setdefault(group, []).append((key, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (order(r[0]), r[1]))
        trees[g] = tree([leaf for _, leaf in groups[g]], fanout)
    root, tops = tree([trees[g][0] for g in names], fanout)
    out = []
    for g, top in zip(names, tops, strict=True):
        for (key, leaf), proof in zip(groups[g], trees[g][1], strict=True):
            out.append((key, leaf, trees[g][0], root, "".join(proof + top)))
    return out


@pytest.mark.parametrize(("fanout", "sizes"), [(2, [1]), (2, [2, 1]), (2, [700, 3, 1, 256]), (3, [1000, 27, 28]), (5, [130, 1, 1, 1, 1, 1, 1]), (300, [700, 20])])
def test_manifest_equals_plain_tree(spark, fanout, sizes):
    rows = [(i, None if g == 0 else f"g{g}", digest(f"{g}/{i}")) for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame([(k, g, bytes.fromhex(d), "x") for k, g, d in rows[::-1]], "key long, g string, leaf binary, Leaf2 string")
    made = recompute_roots(merkle_manifest(df, "key", "g", fanout=fanout), fanout=fanout).collect()
    got = [(r["key"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), (r["proof"] + r["top_proof"]).hex()) for r in made]
    assert sorted(got) == sorted(manifest(rows, fanout))
    assert all(r["folded_root"] == r["root"] for r in made)


def test_far_levels(spark, monkeypatch):
    """Small blocks, so that trees take several passes and ancestors many blocks."""
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rows = [(i, "a" if i % 3 else None, digest(str(i))) for i in range(1500)]
    df = spark.createDataFrame([(k, g, bytes.fromhex(d)) for k, g, d in rows], "key long, g string, leaf binary")
    made = merkle_manifest(df, "key", "g").collect()
    got = [(r["key"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), (r["proof"] + r["top_proof"]).hex()) for r in made]
    assert sorted(got) == sorted(manifest(rows))


def test_changed_leaves_and_proofs_are_found(spark):
    df = spark.range(50).select("id", (F.col("id") % 3).cast("string").alias("g"), leaf_digest("id").alias("leaf"), leaf_digest("id", "id").alias("other"))
    made = merkle_manifest(df, "id", "g", keep=("other",))
    assert all(r["folded_root"] != r["root"] for r in recompute_roots(made, "other").collect())
    row = made.first()
    proof = bytearray(row["proof"])
    proof[3] ^= 1
    assert folded(row["leaf"], row["pos"], row["n"], bytes(row["proof"])) == row["subroot"]
    assert folded(row["leaf"], row["pos"], row["n"], bytes(proof)) != row["subroot"]


def test_odd_rows(spark):
    """Null keys come first, repeated rows are leaves of their own, a null leaf
    folds to null, an empty table gives none, and other columns don't matter."""
    schema = "doc_id long, lang string, leaf binary, LANG2 string, idx int, pos int"
    one = bytes.fromhex(digest("1"))
    df = spark.createDataFrame([(None, None, one, "x", 1, 1), (2, None, one, "x", 1, 1), (2, None, one, "x", 1, 1), (2, "de", one, None, 1, 1)], schema)
    made = merkle_manifest(df).orderBy("g", "pos").collect()
    assert [(r["doc_id"], r["g"], r["pos"]) for r in made] == [(None, 0, 0), (2, 0, 1), (2, 0, 2), (2, 1, 0)]
    want = sorted(manifest([(r["doc_id"], r["lang"], r["leaf"].hex()) for r in df.collect()]), key=str)
    assert sorted([(r["doc_id"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), (r["proof"] + r["top_proof"]).hex()) for r in made], key=str) == want
    assert merkle_manifest(df.limit(0)).collect() == []
    assert [r["folded_root"] for r in recompute_roots(merkle_manifest(df).selectExpr("*", "cast(null as binary) as none"), "none").collect()] == [None] * 4
    with pytest.raises(ValueError, match="fanout"):
        merkle_manifest(df, fanout=1)
    with pytest.raises(ValueError, match="no column"):
        merkle_manifest(df, "nothing")


def test_registered_manifest(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    leaf = lambda r, more=0: digest("".join(map(value, (r["doc_id"], r["source"], r["lang"], r["n_chars"] if r["n_chars"] is None else r["n_chars"] + more, r["text"]))))
    want = {k: (d, s, r, digest(p)) for k, d, s, r, p in manifest([(r["doc_id"], r["lang"], leaf(r)) for r in docs])}
    got = QUERIES["op11_merkle_manifest"](spark, sf).collect()
    assert len(got) == len(docs)
    assert {r["doc_id"]: (r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got} == want
    intact = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0 or r["n_chars"] is None for r in docs}
    assert {r["doc_id"]: r["verified"] for r in got} == intact
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in got)
