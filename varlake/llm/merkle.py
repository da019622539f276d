"""Merkle manifest of a dataset: digests, a tree per group, a proof per row.

Each row is a leaf.  The leaves of a group, in order, form a tree of
``fanout`` children a node; a node alone on its level is the group's subroot,
and the subroots, in order of the group, form the tree of the dataset.  A run of
fewer nodes at a level's end, even of one, is hashed like any other.  The proof of
a row holds the siblings on its way to the root, level by level, left to right.

1. Rows are numbered in order by a range sort; a group's first number turns that
   into places.  Groups meet rows by stretch of numbers, never by the group's name,
   so a group of any size is dealt out.
2. Trees are built a block of ``2**8`` or so nodes at a time, 8 levels a pass.
   Every node is written with the siblings in its run: its segment, one level long.
3. Pointer jumping: in each round the nodes on levels that are a multiple of 2d
   join their ancestors d levels higher and append those segments, which doubles
   the distance that a segment spans, until the leaves' reach the subroot.  An
   ancestor is dealt to the blocks of nodes below it, so no key has more than a
   block's rows, however many rows the ancestor has below it.
4. The same is done with the subroots, and their segments end the leaves'.

Digests are held as 32 bytes and hashed as hex text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, ddl, pick, stored
from varlake.operators.joins import with_row_index

BLOCK = 256  #: nodes of a block, at most
SIZE = 32  #: bytes of a digest


def leaf_digest(*values: Column | str) -> Column:
    """The digest (32 bytes) of a row: of each value ``-`` if null, else its
    number of UTF-8 bytes, a colon and the value as text."""
    texts = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def combined(digests: list[bytes]) -> bytes:
    return sha256("".join([d.hex() for d in digests]).encode()).digest()


def _levels(fanout: int) -> int:
    """Levels that a block of at most BLOCK nodes spans; at least one."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _depth(n: int, fanout: int) -> int:
    depth = 0
    while n > 1:
        n, depth = -(-n // fanout), depth + 1
    return depth


def _grown(nodes: DataFrame, level: int, fanout: int) -> DataFrame:
    """The trees over ``nodes`` (g, pos, size, digest: all nodes of a level in
    groups of ``size`` leaves), some levels of them: (g, level, pos, size, top,
    digest, segment).  The segment of the highest nodes is null, but for
    subroots, which are marked ``top``."""
    levels = _levels(fanout)
    span = fanout**levels

    def block(g: int, first: int, size: int, digests: list[bytes]) -> Iterator[tuple]:
        n = size
        for _ in range(level):
            n = -(-n // fanout)
        for here in range(level, level + levels + 1):
            if n == 1 or here == level + levels:
                yield g, here, first, size, n == 1, digests[0], b"" if n == 1 else None
                return
            above = []
            for a in range(0, len(digests), fanout):
                run = digests[a : a + fanout]
                for i, d in enumerate(run):
                    yield g, here, first + a + i, size, False, d, b"".join(run[:i] + run[i + 1 :])
                above.append(combined(run))
            digests, first, n = above, first // fanout, -(-n // fanout)

    names = ["g", "level", "pos", "size", "top", "digest", "segment"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digests = None, []
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for g, pos, size, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (here := (g, pos // span * span, size)):
                    if key:
                        out += block(*key, digests)
                        if len(out) > 20_000:
                            yield batch_of()
                    key, digests = here, []
                digests.append(digest)
        if key:
            out += block(*key, digests)
        if out:
            yield batch_of()

    dealt = nodes.select("g", "pos", "size", "digest").withColumn("b", F.floor(F.col("pos") / span))
    dealt = dealt.repartition("g", "b").sortWithinPartitions("g", "pos").select("g", "pos", "size", "digest")
    return arrow_map(dealt, run, "g long, level int, pos long, size long, top boolean, digest binary, segment binary")


def _trees(leaves: DataFrame, most: int, fanout: int) -> DataFrame:
    """(g, level, pos, size, top, digest, segment) of all nodes over ``leaves``
    (g, pos, size, digest), of which no group has more than ``most``."""
    parts, level = [], 0
    while not parts or level < _depth(most, fanout):
        grown = stored(_grown(leaves, level, fanout))
        parts.append(grown.where("segment is not null"))
        leaves = grown.where("segment is null")
        level += _levels(fanout)
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    return nodes


def _to_subroot(nodes: DataFrame, most: int, fanout: int) -> DataFrame:
    """(g, pos, segment): of each leaf all siblings up to the subroot."""
    held = nodes.select("g", "level", "pos", "size", "segment")
    distance = 1
    while distance < _depth(most, fanout):
        # the nodes that an ancestor covers, in blocks of at most BLOCK
        span = fanout**distance
        block = min(span, fanout ** _levels(fanout))
        up = held.where(F.col("level") % (2 * distance) == distance)
        first = F.col("pos") * F.lit(float(span))
        last = F.floor((F.col("size") - 1) / F.pow(F.lit(float(fanout)), F.col("level") - distance))  # of that level
        up = up.select(
            "g",
            (F.col("level") - distance).alias("level"),
            F.explode(F.sequence(F.floor(first / block), F.floor(F.least(first + (span - 1), last) / block))).alias("b"),
            F.col("segment").alias("rest"),
        )
        below = held.where(F.col("level") % (2 * distance) == 0).withColumn("b", F.floor(F.col("pos") / block))
        joined = below.join(up, ["g", "level", "b"], "left")
        held = stored(joined.select("g", "level", "pos", "size", F.concat("segment", F.coalesce("rest", F.lit(b""))).alias("segment")))
        distance *= 2
    return held.where("level = 0").select("g", "pos", "segment")


def _forest(leaves: DataFrame, most: int, fanout: int) -> tuple[DataFrame, DataFrame]:
    """(g, pos, segment) of the leaves, and (g, digest) of the subroots."""
    nodes = _trees(leaves, most, fanout)
    return _to_subroot(nodes, most, fanout), nodes.where("top").select("g", "digest")


def merkle_manifest(df: DataFrame, order_col: str = "doc_id", group_col: str = "lang", leaf_col: str = "leaf", keep: tuple[str, ...] = (), fanout: int = 2) -> DataFrame:
    """(order, *keep, leaf, pos, n, g, groups, proof, top_proof, subroot, root)
    of each row of ``df``, digests and proofs in bytes.

    Leaves of a group come in order of ``order_col``, ties in order of the
    digest, nulls first; groups in order of their name, null first.  ``pos`` is
    the place in the group of ``n`` rows, ``g`` that of the group among
    ``groups``; ``proof`` has the siblings up to the subroot and ``top_proof``
    those from there.  Repeated rows are leaves of their own, and an empty table
    gives no rows."""
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    names = [f"k{i}" for i in range(len(keep))]
    rows = stored(pick(df, key=order_col, grp=group_col, leaf=leaf_col, **dict(zip(names, keep, strict=True))))
    numbered = with_row_index(rows, ["grp", "key", "leaf"], "idx")
    groups = numbered.groupBy("grp").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stored(with_row_index(groups, ["grp"], "g").select((F.col("g") - 1).alias("g"), "first", "n"))
    count, most = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()

    def beside(of_groups: DataFrame) -> DataFrame:
        """The rows with what there is of their group, which is dealt to the
        stretches of numbers that it covers."""
        covered = F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("first") + F.col("n") - 1) / BLOCK))
        spread = of_groups.withColumn("stretch", F.explode(covered))
        met = numbered.withColumn("stretch", F.floor(F.col("idx") / BLOCK)).join(spread, "stretch")
        return met.where((F.col("idx") >= F.col("first")) & (F.col("idx") < F.col("first") + F.col("n")))

    # trees are named by the number of their first leaf
    leaves = beside(groups).select(F.col("first").alias("g"), (F.col("idx") - F.col("first")).alias("pos"), F.col("n").alias("size"), F.col("leaf").alias("digest"))
    segments, subroots = _forest(leaves, most, fanout)
    of_groups = stored(groups.join(subroots.select(F.col("g").alias("first"), F.col("digest").alias("subroot")), "first"))
    one = of_groups.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(count).cast("long").alias("size"), F.col("subroot").alias("digest"))
    tops, root = _forest(one, count, fanout)
    root_digest = root.select("digest").first()
    of_groups = of_groups.join(tops.select(F.col("pos").alias("g"), F.col("segment").alias("top_proof")), "g")
    proofs = segments.select((F.col("g") + F.col("pos")).alias("idx"), F.col("segment").alias("proof"))
    whole = beside(of_groups).join(proofs, "idx")
    out = whole.select(
        "key",
        *names,
        "leaf",
        (F.col("idx") - F.col("first")).alias("pos"),
        "n",
        "g",
        F.lit(count).cast("long").alias("groups"),
        "proof",
        "top_proof",
        "subroot",
        F.lit(bytes(root_digest[0]) if root_digest else None).cast("binary").alias("root"),
    )
    return out.toDF(order_col, *keep, "leaf", "pos", "n", "g", "groups", "proof", "top_proof", "subroot", "root")


def folded(leaf: bytes, pos: int, n: int, proof: bytes, fanout: int = 2) -> bytes:
    """The root of a tree of ``n`` leaves that the leaf at ``pos`` and its proof give."""
    at = 0
    while n > 1:
        others = min(fanout, n - pos // fanout * fanout) - 1
        run = [proof[at + SIZE * i : at + SIZE * (i + 1)] for i in range(others)]
        run.insert(pos % fanout, leaf)
        leaf = combined(run)
        at += SIZE * others
        pos, n = pos // fanout, -(-n // fanout)
    return leaf


def recompute_roots(manifest: DataFrame, leaf_col: str = "leaf", fanout: int = 2) -> DataFrame:
    """``manifest`` with folded_root: the root that each row's ``leaf_col`` gives
    with the proof.  A null leaf gives null."""
    names = manifest.columns
    own = [names.index(c) for c in (leaf_col, "pos", "n", "proof", "g", "groups", "top_proof")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = zip(*(batch.column(i).to_pylist() for i in own), strict=True)
            roots = [None if leaf is None else folded(folded(leaf, pos, n, proof, fanout), g, groups, top, fanout) for leaf, pos, n, proof, g, groups, top in values]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())], [*batch.schema.names, "folded_root"])

    plain = manifest.toDF(*(f"c{i}" for i in range(len(names))))
    kinds = ", ".join(f"c{i} {ddl(plain, f'c{i}')}" for i in range(len(names)))
    return arrow_map(plain, run, f"{kinds}, folded_root binary").toDF(*names, "folded_root")
