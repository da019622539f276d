"""Phrase mining against a plain count."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from varlake.llm import phrases, word_blocks
from varlake.llm.phrases import mine_phrases
from varlake.llm.queries import OP12_SQL, QUERIES


def mined(rows, min_count, max_words=4, percent=80, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    absorbed = set()
    for (lang, g), a in candidates.items():
        for i in range(len(g)):
            for j in range(i + 2, len(g) + 1):
                if j - i < len(g) and (k := (lang, g[i:j])) in candidates and 100 * a >= percent * candidates[k]:
                    absorbed.add(k)
    out = {}
    for (lang, g), a in candidates.items():
        if (lang, g) not in absorbed:
            score, _, l, r = min((2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
            out.setdefault(lang, []).append((" ".join(g), a, l, r, n[lang], score))
    found = []
    for lang, rows in out.items():
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        found += [(lang, i + 1, *x) for i, x in enumerate(rows[:top])]
    return sorted(found)


def found(df, **options):
    return sorted(tuple(r) for r in mine_phrases(df, **options).collect())


@pytest.mark.parametrize("step", [3, 20_000])
@pytest.mark.parametrize("size", [500, 8 << 20])
def test_phrases_equal_plain_counts(spark, monkeypatch, step, size):
    monkeypatch.setattr(phrases, "STEP", step)
    monkeypatch.setattr(word_blocks, "PART", 2 * size)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", size)
    random = np.random.default_rng(step + size)
    words = ["a", "A", "the", "b\x01", "é", "É", "of", "x\x1f", "ß", "\x00"]
    ends = [" ", " ", " ", " ", "\t", " \t ", ". ", "\n", ",", "\x0b", "\r\n", "\xa0", "\x1c"]
    rows = []
    for i in range(120):
        parts = [words[min(random.geometric(0.3) - 1, 9)] + ends[random.integers(0, len(ends)) if random.random() < 0.3 else 0] for _ in range(random.integers(0, 60))]
        rows.append(([None, "en", "und", "de"][i % 4], "".join(parts)))
    rows += [("en", None), ("en", ""), (None, " . ,"), ("en", "the the the the the the the the"), ("en", "of the a b of the a b")] * 8
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(df, min_count=5) == mined(rows, 5)
    assert found(df, min_count=3, max_words=3, absorbed_percent=50, top=7) == mined(rows, 3, 3, 50, 7)


def test_odd_tables(spark):
    """A text of one very long piece and word, clashing columns, no words, no rows."""
    long = "Ab " * 300_000 + "w" * 5_000_000 + " ab" * 100
    schema = "LANG2 string, lang string, text string, n long, block long, w string"
    df = spark.createDataFrame([("x", "en", long, 1, 1, "w"), ("x", None, None, None, None, None)], schema)
    assert found(df, min_count=30) == mined([("en", long)], 30)
    assert found(df.where("text is null")) == []
    assert found(df.limit(0)) == []


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(word_blocks, "STRETCH", 10)
    text = "Aa bb.cc  dd\tee " + "f" * 40 + " g! "
    assert [w for ws in phrases.pieces(text) for w in ws] == [b"aa", b"bb", phrases.BREAK, b"cc", b"dd", b"ee", b"f" * 40, b"g", phrases.BREAK]


def test_squeezed_numbers_come_back():
    for dtype in (np.int32, np.int64):
        x = np.random.default_rng(1).integers(0, 2**31 - 1, 1000).astype(dtype)
        assert (word_blocks.unsqueezed(word_blocks.squeezed(x), dtype) == x).all()
        assert len(word_blocks.unsqueezed(word_blocks.squeezed(x[:0]), dtype)) == 0


def test_registered_phrases_equal_sql_and_plain_counts(spark, sf):
    got = sorted(tuple(r) for r in QUERIES["op12_phrase_collocations"](spark, sf).collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()
    assert got == mined([tuple(r) for r in docs], 30)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.sql(OP12_SQL).fetchall())
