"""Token counts of whole texts, huge ones by overlap resynchronisation.

Texts up to ``huge_chars`` characters are counted where they are read.  A longer
one is cut into chunks that overlap; the chunks are dealt out to all tasks, so
one huge document doesn't hold up one task.  Each chunk is encoded with offsets
and reports, for the two stretches that it shares with its neighbours, where
pre-tokens start and how many tokens lie before each.  Neighbours are spliced at
the first start that both report.

Why that is exact: pre-tokenisation scans from left to right and looks a few
characters ahead but never back, so once two scans agree on a start they agree
on all that follows.  A start counts as stable only if it stands MARGIN
characters before the chunk's right end, more than the scan or a special string
looks ahead.  The first chunk is right from the start; each splice carries that
on.  Where neighbours share no stable start, the document is done again with
chunks and overlaps twice as long, at last as one chunk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.codec import codec, grouped
from varlake.llm.common import arrow_map, ddl, pick, stored, strings, text_or_empty

MARGIN = 32  #: characters; the longest special string of the vocabularies has 15
HUGE_CHARS = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024


def _count_whole(rows: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            counts = [len(b) // 4 for group in grouped(strings(batch.column(2))) for b in c.encode(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"])

    return arrow_map(rows, run, f"key {ddl(rows, 'key')}, n_bytes long, n_tokens long")


def _cut(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(uid, k, last, part): the overlapping chunks of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(strings(batch.column(1), 1)):
                uid = batch.column(0)[i].as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))
                for a in range(0, n, 64):
                    ks = range(a, min(a + 64, n))
                    parts = [text[k * chunk :] if k == n - 1 else text[k * chunk : (k + 1) * chunk + overlap] for k in ks]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * len(ks), pa.int64()), pa.array(ks, pa.int64()), pa.array([k == n - 1 for k in ks]), pa.array(parts, pa.string())],
                        ["uid", "k", "last", "part"],
                    )

    return arrow_map(rows.select("uid", "text"), run, "uid long, k long, last boolean, part string")


def _summaries(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Per chunk: its tokens, and the stable starts in its first and last
    overlap with the tokens before each (places relative to the overlap)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for last, part in zip(batch.column(2).to_pylist(), strings(batch.column(3)), strict=True):
                starts, counts = c.piece_counts(part)
                before = np.cumsum(counts) - counts
                stable = len(part) if last else len(part) - MARGIN
                head = (starts > 0) & (starts < min(overlap, stable))
                tail = (starts >= chunk) & (starts < stable)
                cols[0].append(int(counts.sum()))
                cols[1].append(starts[head])
                cols[2].append(before[head])
                cols[3].append((starts[tail] - chunk) if not last else [])
                cols[4].append(before[tail] if not last else [])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in cols[1:]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cols[0], pa.int64()), *lists], ["uid", "k", "last", "total", "hp", "hc", "tp", "tc"])

    return arrow_map(chunks, run, "uid long, k long, last boolean, total long, hp array<long>, hc array<long>, tp array<long>, tc array<long>")


def _spliced(found: DataFrame) -> DataFrame:
    """(uid, n_tokens): the spliced count, null where some neighbours share no
    stable start."""
    left = found.where(~F.col("last")).select("uid", (F.col("k") + 1).alias("k"), "total", "tp", "tc")
    right = found.where(F.col("k") > 0).select("uid", "k", "hp", "hc")
    seams = left.join(right, ["uid", "k"]).select("uid", "total", "tp", "tc", "hp", "hc", F.array_min(F.array_intersect("tp", "hp")).alias("p"))
    at = lambda pos, cnt: F.element_at(cnt, F.array_position(pos, F.col("p")).cast("int"))
    extra = seams.select("uid", F.when(F.col("p").isNotNull(), F.col("total") - at("tp", "tc") + at("hp", "hc")).alias("extra"))
    extra = extra.groupBy("uid").agg(F.sum("extra").alias("extra"), F.count_if(F.col("extra").isNull()).alias("open"))
    total = found.groupBy("uid").agg(F.sum("total").alias("total"))
    joined = total.join(extra, "uid", "left")
    done = F.coalesce(F.col("open"), F.lit(0)) == 0
    return joined.select("uid", F.when(done, F.col("total") - F.coalesce(F.col("extra"), F.lit(0))).alias("n_tokens"))


def token_counts(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    huge_chars: int = HUGE_CHARS,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every text, for a byte-level vocabulary file.

    Null text counts as empty: 0 bytes, 0 tokens.  Repeated rows give repeated
    results; further columns are ignored; an empty table gives no rows."""
    if not MARGIN < overlap_chars <= chunk_chars:
        raise ValueError(f"the overlap must be over {MARGIN} characters, and no longer than a chunk")
    rows = pick(df, key=id_col, text=text_col)
    rows = rows.select("key", F.octet_length(text_or_empty(rows.text)).cast("long").alias("n_bytes"), text_or_empty(rows.text).alias("text"))
    # the same scan gives the same uid each time: partitions follow the files
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    is_huge = F.length("text") > huge_chars
    whole = _count_whole(rows.where(~is_huge).select("key", "n_bytes", "text"), path)
    huge = rows.where(is_huge)
    parts, todo, chunk, overlap = [], huge, chunk_chars, overlap_chars
    while True:
        dealt = _cut(todo, chunk, overlap).repartition("uid", "k")
        found = stored(_spliced(stored(_summaries(dealt, path, chunk, overlap))))
        parts.append(found.where(F.col("n_tokens").isNotNull()))
        failed = found.where(F.col("n_tokens").isNull()).select("uid")
        if failed.isEmpty():
            break
        todo, chunk, overlap = huge.join(failed, "uid", "left_semi"), 2 * chunk, 2 * overlap
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    long_ones = huge.select("uid", "key", "n_bytes").join(counts, "uid").select("key", "n_bytes", "n_tokens")
    return whole.unionByName(long_ones).toDF(id_col, "n_bytes", "n_tokens")
