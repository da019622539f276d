"""BPE encoding and decoding of whole texts (speculate and verify).

The merge work is in ``bpe_tables`` and the cache of units in ``codec``; here
are the DataFrame operators.  Each text is encoded where it is read: no shuffle,
and memory is bounded by one Arrow batch, a cache of 300,000 units and, for a
text longer than two million characters, that text.

Null text counts as empty and gives no ids; null ids decode to an empty text;
null ids inside a list and ids that the vocabulary lacks are left out.  Repeated
rows give repeated results.  Further columns of the input are ignored unless
named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from varlake.llm.codec import codec, grouped
from varlake.llm.common import arrow_map, ddl, pick, strings, text_or_empty


def bpe_encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the ids of each text by the vocabulary file
    ``path``, which every executor must have there.  Special strings inside a
    text become their ids, as by default in the library."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            at = 0
            for group in grouped(strings(batch.column(1))):
                ids = [np.frombuffer(b, "<i4") for b in c.encode(group)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), lists], ["key", "ids"])
                at += len(group)

    rows = pick(df, key=id_col, text=text_col)
    rows = rows.select("key", text_or_empty(rows.text).alias("text"))
    return arrow_map(rows, run, f"key {ddl(rows, 'key')}, ids array<int>").toDF(id_col, "ids")


def bpe_decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, text): the text of each list of ids, special tokens included."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            at, sizes = 0, ids.value_lengths().fill_null(0).to_numpy()
            while at < len(ids):
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 500_000)))
                texts = [c.decode([i for i in x if i is not None] if x else []) for x in ids.slice(at, end - at).to_pylist()]
                rest = [col.slice(at, end - at) for col in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*batch.schema.names[:-1], "text"])
                at = end

    names = [f"k{i}" for i in range(len(keep))]
    rows = pick(df, key=id_col, **dict(zip(names, keep, strict=True)), ids=ids_col)
    kinds = ", ".join(f"{n} {ddl(rows, n)}" for n in ("key", *names))
    return arrow_map(rows, run, f"{kinds}, text string").toDF(id_col, *keep, "text")
