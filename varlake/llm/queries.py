"""The registered queries over the operators of this folder: each applies its
operator to its whole table and derives the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.llm.ann import nearest
from varlake.llm.bpe import bpe_decode, bpe_encode
from varlake.llm.html_text import extract_text
from varlake.llm.line_dedup import dedup_lines
from varlake.llm.lm import score_texts
from varlake.llm.merkle import leaf_digest, merkle_manifest, recompute_roots
from varlake.llm.packing import pack_documents
from varlake.llm.phrases import mine_phrases
from varlake.llm.quality import OrdinalModel, fit_quality, score_quality
from varlake.llm.simhash import near_dedup, near_dup_classes
from varlake.llm.token_counts import token_counts
from varlake.llm.topk import exact_topk
from varlake.llm.warc import read_warc, write_warc

GRADES = 3  #: 0 poor, 1 toxic, 2 clean
KEEP_FROM = 0.5  #: the probability of being clean from which a document is kept
SIMHASH_WORDS, SIMHASH_BITS = 4, 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe_encode(_table(spark, sf_dir, "documents"), path)
    decimal = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    counted = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"))
    text = bpe_decode(counted, path, keep=("n_tokens", "ids_sha256"))
    return text.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


OP2_SQL = """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0
), r AS (
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dup_classes(_table(spark, sf_dir, "documents"), SIMHASH_WORDS, SIMHASH_BITS)
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_warc(write_warc(_table(spark, sf_dir, "pages")), with_payload=False)
    return pages.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


OP8_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), l AS (
    SELECT page_id, strlen(payload) AS n, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS last FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM l
"""


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> OrdinalModel:
    """The model of the graded ratings that ``labels`` imply."""
    labels = _table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return fit_quality(docs, labels.select("doc_id", grade.alias("grade")), GRADES)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_quality(docs, quality_model(spark, sf_dir, docs))
    return scored.withColumn("keep", F.col(f"p_above_{GRADES - 2}") >= KEEP_FROM)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    leaf, changed = (leaf_digest("doc_id", "source", "lang", n, "text") for n in (n_chars, n_chars + 1))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = _table(spark, sf_dir, "documents").select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, changed).alias("changed"))
    manifest = merkle_manifest(rows, keep=("changed",))
    checked = recompute_roots(manifest.withColumn("seen", F.coalesce("changed", "leaf")), "seen")
    digest = lambda c: F.lower(F.hex(c)).alias(c)
    proof = F.sha2(F.lower(F.hex(F.concat("proof", "top_proof"))).cast("binary"), 256).alias("proof_sha256")
    return checked.select("doc_id", digest("leaf"), digest("subroot"), digest("root"), proof, digest("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), p AS (
    SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d
), w AS (
    SELECT lang, [x FOR x IN string_split_regex(piece, '[\\x20\\x09]+') IF x <> ''] AS ws FROM p
), spot AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), gram AS (
    SELECT lang, unnest([ws[i:i + m - 1] FOR m IN range(1, least(4, len(ws) - i + 1) + 1)]) AS g FROM spot
), f AS (
    SELECT lang, g, count(*) AS f FROM gram GROUP BY lang, g HAVING count(*) >= 30 OR len(g) = 1
), n AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang
), c AS (
    SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 30
), from_place AS (
    SELECT lang, a, g, unnest(range(1, len(g))) AS s FROM c
), inner_part AS (
    SELECT lang, a AS longer, unnest([g[s:s + m - 1] FOR m IN range(2, least(len(g) - 1, len(g) - s + 1) + 1)]) AS g FROM from_place
), absorbed AS (
    SELECT DISTINCT c.lang, c.g FROM c JOIN inner_part i ON i.lang = c.lang AND i.g = c.g WHERE 100::HUGEINT * i.longer >= 80::HUGEINT * c.a
), cut AS (
    SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM c
), scored AS (
    SELECT t.lang, t.g, t.a, t.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * t.a) // (x.f + y.f))::BIGINT AS score
    FROM cut t JOIN f x ON x.lang = t.lang AND x.g = t.g[1:t.k] JOIN f y ON y.lang = t.lang AND y.g = t.g[t.k + 1:len(t.g)]
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM scored
), ranked AS (
    SELECT l.lang, array_to_string(l.g, ' ') AS phrase, l.a, l.l, l.r, l.score,
           row_number() OVER (PARTITION BY l.lang ORDER BY l.score DESC, l.a DESC, array_to_string(l.g, ' ')) AS rank
    FROM lowest l LEFT JOIN absorbed b ON b.lang = l.lang AND b.g = l.g
    WHERE l.o = 1 AND b.g IS NULL
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held")), "held")


# ---- the stages of the pipeline: each takes and returns rows with the columns of documents
def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.  The model is that
    of op9, which ``documents`` and ``labels`` give."""
    model = quality_model(spark, sf_dir, _table(spark, sf_dir, "documents"))
    names = docs.columns
    scored = score_quality(docs, model, keep=tuple(c for c in names if c != "doc_id"))
    return scored.where(F.col(f"p_above_{GRADES - 2}") >= KEEP_FROM).select(*names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; a document of which
    no text is left goes, one that came without text stays."""
    out = dedup_lines(docs)
    left = (F.col("n_removed") == 0) | (F.length(F.trim(F.translate("text", "\n\r\t", "   "))) > 0)
    return out.where(left).select(*docs.columns).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup(docs, SIMHASH_WORDS, SIMHASH_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_encode_decode,
        op2_exact_topk,
        op3_token_counts,
        op4_best_fit_packing,
        op5_nearest_neighbours,
        op6_html_text,
        op7_simhash_near_dedup,
        op8_warc,
        op9_quality,
        op10_line_dedup,
        op11_merkle_manifest,
        op12_phrase_collocations,
        op13_lm_scoring,
    )
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op2_exact_topk": OP2_SQL, "op8_warc": OP8_SQL, "op12_phrase_collocations": OP12_SQL}
