"""Document quality by ordinal cumulative-link regression on hashed text.

Documents have ordered grades 0 .. G - 1.  One weight vector is shared by all
cut points: P(grade > j | x) = sigmoid(w . x - t_j) with thresholds t_0 < t_1 <
...  From it come the expected grade and tail probabilities, and documents are
kept by the probability that they reach a grade.

Features are hashed into ``2 ** BITS`` weights: each word (lower case, without
marks around it), its beginnings of four and six characters, and its form (the
marks around it, capitals, a repeat of the word before).  Their values are shares
of a text's words, so length alone says nothing, and a score is an average over
words of what each word adds, which is looked up once per distinct word.

The fit uses at most ``max_rows`` labelled rows (those with the smallest hashes,
each grade in proportion) with at most ``max_features`` features together; all
documents are scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, ddl, pick, stored, strings, text_or_empty

BITS = 18
MAX_ROWS = 8_000
MAX_FEATURES = 8_000_000  #: of all rows of a fit together, 8 bytes each
LEAST_ROWS = 5
FIT_AT_ONCE = 100_000  #: features of a fit of which more than 16 bytes each are held
CACHE_WORDS = 300_000
STRETCH = 2_000_000  #: characters of a text whose words are counted at a time
EDGES = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)
WHITE = re.compile(r"\s")
SCALE = 20.0  #: a feature that half of the words have is worth this half


def _hash(kind: str, value: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}".encode()) & ((1 << BITS) - 1)


REPEAT = _hash("form", "repeat")


def word_features(word: str) -> list[int]:
    """Hashed features of a word."""
    core = word
    out = []
    if not word.isalnum():
        before, core, after = EDGES.match(word).groups()
        out.append(_hash("marks", f"{before[:3]} {after[:3]}") if core else _hash("form", "marks only"))
    if len(core) > 1 and core.isupper():
        out.append(_hash("form", "capitals"))
    low = core.lower()
    if low:
        out.append(_hash("word", low))
    return out + [_hash("start", low[:n]) for n in (4, 6) if len(low) > n]


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, in stretches."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > STRETCH and (m := WHITE.search(text, at + STRETCH)):
            end = m.start()
        if words := text[at:end].split():
            yield words
        at = max(end, at + 1)


def repeats(words: list[str]) -> int:
    """How many words follow themselves."""
    return sum(map(str.__eq__, words, words[1:]))


def features(text: str) -> dict[int, float]:
    """The feature vector of a text."""
    out: Counter = Counter()
    total = 0
    for words in words_of(text):
        total += len(words)
        out[REPEAT] += repeats(words)
        for word, n in Counter(words).items():
            for f in word_features(word):
                out[f] += n
    return {f: SCALE * n / total for f, n in out.items() if n}


def _stretches(places: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges a .. b of groups of at most FIT_AT_ONCE items, or of one group;
    group i has the items ``places[i]`` .. ``places[i + 1]``."""
    a, n = 0, len(places) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(places, places[a] + FIT_AT_ONCE, "right")) - 1)
        yield a, b
        a = b


class OrdinalModel:
    """Shared weights and ordered thresholds.  The first threshold is free and
    the others follow at distances exp(g), which keeps them in order."""

    def __init__(self, grades: int, bits: int = BITS):
        self.weights = np.zeros(1 << bits, np.float32)
        self.start, self.gaps = 0.0, np.zeros(max(0, grades - 2))

    @property
    def thresholds(self) -> np.ndarray:
        return self.start + np.append(0.0, np.cumsum(np.exp(self.gaps)))

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for each j: (rows, grades - 1), falling with j."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - np.asarray(score)[:, None], -60, 60)))

    def fit(
        self, lens: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, rounds: int = 300, rate: float = 0.1, ridge: float = 1.5e-3, least_rows: int = LEAST_ROWS, alpha: float = 0.25
    ) -> OrdinalModel:
        """Maximum likelihood with a ridge, by Adagrad on all rows at once; row i
        has the next ``lens[i]`` features (``cols``) and values.

        Features that fewer than ``least_rows`` rows have get no weight; the
        others are divided by a power (``alpha``) of their root mean square, so
        that rare telling words count more.  Grades weigh alike, however many
        rows they have."""
        n, places = len(lens), np.append(0, np.cumsum(lens, dtype=np.int64))
        seen = np.zeros(len(self.weights), np.int64)
        for a, b in _stretches(places):
            seen += np.bincount(cols[places[a] : places[b]], minlength=len(seen))
        often = seen >= max(1, least_rows)
        kept = np.flatnonzero(often)
        if not len(kept):
            return self
        # what is kept, by row and by feature; all else is made a stretch of rows at a time
        number = (np.cumsum(often) - 1).astype(np.int32)
        total = int(seen[kept].sum())
        back, values_by_row = np.empty(total, np.int32), np.empty(total, np.float32)
        count, squares, at = np.zeros(n, np.int64), np.zeros(len(kept)), 0
        for a, b in _stretches(places):
            own = slice(places[a], places[b])
            some = often[cols[own]]
            count[a:b] = np.bincount(np.repeat(np.arange(b - a, dtype=np.int32), lens[a:b])[some], minlength=b - a)
            to = slice(at, at := at + int(some.sum()))
            back[to], values_by_row[to] = number[cols[own][some]], values[own][some]
            np.add.at(squares, back[to], (values_by_row[to] * values_by_row[to]).astype(np.float64))
        scale = (np.sqrt(squares / n) ** -alpha).astype(np.float32)
        rows, row_places = np.flatnonzero(count), np.append(0, np.cumsum(count))
        col_places = np.append(0, np.cumsum(seen[kept]))
        col_row, col_value, free = np.empty(total, np.int32), np.empty(total, np.float32), col_places[:-1].copy()
        for a, b in _stretches(row_places):
            own = slice(row_places[a], row_places[b])
            values_by_row[own] *= scale[back[own]]
            order = np.argsort(back[own], kind="stable")
            here, start, times = np.unique(back[own][order], return_index=True, return_counts=True)
            to = np.arange(len(order)) + np.repeat(free[here] - start, times)
            col_row[to] = np.repeat(np.arange(a, b, dtype=np.int32), count[a:b])[order]
            col_value[to] = values_by_row[own][order]
            free[here] += times
        by_row, by_col = list(_stretches(np.append(row_places[rows], total))), list(_stretches(col_places))
        row_places = np.append(row_places[rows], total)
        weigh = 1 / (len(np.unique(grade)) * np.bincount(grade)[grade])
        every, score, w = np.arange(n), np.zeros(n), np.zeros(len(kept), np.float32)
        square_w, square_t = np.full(len(kept), 1e-8, np.float32), np.full(1 + len(self.gaps), 1e-8)
        for _ in range(rounds):
            for a, b in by_row:
                own = slice(row_places[a], row_places[b])
                score[rows[a:b]] = np.add.reduceat(w[back[own]] * values_by_row[own], row_places[a:b] - row_places[a])
            # P(grade = g) = tail(g - 1) - tail(g); the derivatives of its logarithm in closed form
            tail = np.concatenate([np.ones((n, 1)), self.tails(score), np.zeros((n, 1))], axis=1)
            up, down = tail[every, grade], tail[every, grade + 1]
            p = np.maximum(up - down, 1e-12)
            d_up, d_down = weigh * up * (1 - up) / p, weigh * down * (1 - down) / p
            d, g = (d_down - d_up).astype(np.float32), np.empty(len(kept), np.float32)
            for a, b in by_col:
                own = slice(col_places[a], col_places[b])
                g[a:b] = np.add.reduceat(d[col_row[own]] * col_value[own], col_places[a:b] - col_places[a])
            g += ridge * w
            square_w += g * g
            w -= rate * g / np.sqrt(square_w)
            # a threshold is the lower bound of one grade and the upper bound of the one below
            d_t = np.array([d_up[grade == j + 1].sum() - d_down[grade == j].sum() for j in range(1 + len(self.gaps))])
            by = np.append(d_t.sum(), [d_t[j:].sum() * np.exp(self.gaps[j - 1]) for j in range(1, len(d_t))])
            square_t += by * by
            step = rate * by / np.sqrt(square_t)
            self.start -= step[0]
            self.gaps -= step[1:]
        self.weights[kept] = w * scale
        return self

    def score(self, text: str) -> float:
        """w . x of a text."""
        return sum(self.weights[f] * v for f, v in features(text).items())


class Scorer:
    """Scores of many texts; what a word adds is kept per distinct word."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.tolist()
        self.adds: dict[str, float] = {}

    def score(self, text: str) -> float:
        score, total, weights = 0.0, 0, self.weights
        for words in words_of(text):
            adds = self.adds
            if lack := set(words).difference(adds):
                if len(adds) + len(lack) > CACHE_WORDS:
                    adds = self.adds = {}
                    lack = set(words)
                for word in lack:
                    adds[word] = sum([weights[f] for f in word_features(word)])
            score += sum(map(adds.__getitem__, words)) + weights[REPEAT] * repeats(words)
            total += len(words)
        return SCALE * score / total if total else 0.0


def fit_quality(df: DataFrame, labels: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """A model from the labelled documents: ``labels`` has (id, grade); grades
    are 0 .. grades - 1, others and null are passed over.  At most ``max_rows``
    rows come to the driver, as hashed features, and no more of them (in the order
    of a hash of their ids) than have ``max_features`` together, so that very long
    texts don't fill it.  Without ratings of two grades
    there is nothing to tell documents apart by: all get score 0 and the highest
    grade, so none is rejected."""
    marks = pick(labels, key=id_col, grade=grade_col).where(F.col("grade").between(0, grades - 1)).groupBy("key").agg(F.min("grade").cast("int").alias("grade"))
    count = {r["grade"]: r["n"] for r in marks.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    model = OrdinalModel(grades)
    untold = OrdinalModel(grades)
    untold.start = -60.0
    total = sum(count.values())
    if len(count) < 2:
        return untold
    chosen = None
    for g, n in sorted(count.items()):
        own = marks.where(F.col("grade") == g).orderBy(F.xxhash64("key"), "key").limit(max(1, min(n, max_rows * n // total)))
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = pick(df, key=id_col, text=text_col)
    rows = texts.select("key", text_or_empty(texts.text).alias("text")).join(chosen, "key").select("grade", F.xxhash64("key").alias("h"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8):  # a long text has many features
                group = batch.slice(at, 8)
                found = [features(t) for t in strings(group.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [*group.columns[:2], pa.array([list(x) for x in found], pa.list_(pa.int32())), pa.array([list(x.values()) for x in found], pa.list_(pa.float32()))], ["grade", "h", "f", "v"]
                )

    # a document that occurs in many rows has as many here; the bound holds for all of them
    found = stored(arrow_map(rows, run, "grade int, h long, f array<int>, v array<float>").limit(max_rows))
    sizes = found.groupBy("h").agg(F.sum(F.size("f")).alias("n")).orderBy("h").toArrow()
    fit = int(np.searchsorted(np.cumsum(sizes["n"].to_numpy()), max_features, "right"))
    if fit < sizes.num_rows:
        found = found.where(F.col("h") < sizes["h"][fit].as_py())
    got = found.select("grade", "f", "v").toArrow()
    if len(set(got["grade"].to_pylist())) < 2:
        return untold
    grade, lens = got["grade"].to_numpy().astype(np.int64), pc.list_value_length(got["f"]).to_numpy()
    cols, values = np.empty(int(lens.sum()), np.int32), np.empty(int(lens.sum()), np.float32)
    for out, name in ((cols, "f"), (values, "v")):
        end = 0
        for chunk in got[name].chunks:
            flat = chunk.flatten().to_numpy()
            out[end : (end := end + len(flat))] = flat
    del got, chunk, flat
    pa.default_memory_pool().release_unused()
    return model.fit(lens, cols, values, grade)


def score_quality(df: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, score, expected_grade, p_above_0, p_above_1, ...) of every
    document, scored where it is read.  Null text counts as empty; empty texts
    have score 0; repeated rows repeat; an empty table gives no rows."""
    cuts = len(model.thresholds)
    weights = df.sparkSession.sparkContext.broadcast(model.weights)  # 2 ** BITS floats, whatever the input

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights.value)
        for batch in batches:
            score = np.array([scorer.score(t or "") for t in strings(batch.column(at))])
            tails = model_tails(score)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(score), pa.array(tails.sum(axis=1)), *(pa.array(tails[:, j]) for j in range(cuts))], [*batch.schema.names[:kept], *out])

    light = OrdinalModel(cuts + 1, 0)
    light.start, light.gaps = model.start, model.gaps
    model_tails = light.tails
    out = ["score", "expected_grade", *(f"p_above_{j}" for j in range(cuts))]
    names = [f"k{i}" for i in range(len(keep))]
    kept = 1 + len(keep)
    if text_col in keep and df.schema[text_col].dataType.simpleString() == "string":  # the text goes to Python once
        at = 1 + keep.index(text_col)
        rows = pick(df, key=id_col, **dict(zip(names, keep, strict=True)))
    else:
        at = kept
        rows = pick(df, key=id_col, **dict(zip(names, keep, strict=True)), text=text_col)
        rows = rows.select("key", *names, text_or_empty(rows.text).alias("text"))
    kinds = ", ".join([*(f"{n} {ddl(rows, n)}" for n in ("key", *names)), *(f"{n} double" for n in out)])
    return arrow_map(rows, run, kinds).toDF(id_col, *keep, *out)
