"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import numbered, table
from tidemark.llm.decontamination import hit_words, is_contaminated, with_contamination
from tidemark.llm.language import fit_language, with_language
from tidemark.llm.mixing import mix, word_count
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.neighbours import nearest
from tidemark.llm.passages import without_passages
from tidemark.llm.phrases import collocations
from tidemark.llm.quality import fit_quality, with_quality
from tidemark.llm.repeats import without_repeated_bytes
from tidemark.llm.secrets import secret_spans
from tidemark.llm.sentences import SENTENCES, WORDS, without_repeats
from tidemark.llm.setsketch import with_near_group
from tidemark.llm.sharding import shard_rows
from tidemark.llm.simhash import near_groups, with_fingerprint
from tidemark.llm.common import kept


def id_remainder(count: int) -> Column:
    """crc32 of doc_id as text, modulo ``count``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % count


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(id_remainder(5) != 0)
    scored = with_quality(docs, fit_quality(docs, labels, "quality"), out="_quality")
    score = F.col("_quality.score")
    return scored.select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = with_contamination(docs, table(spark, sf_dir, "benchmark"), out="_found")
    return marked.select(
        "doc_id",
        F.col("_found.n_words").alias("n_words"),
        hit_words("_found").alias("n_hit"),
        F.size("_found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_found.items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated("_found").alias("contaminated"),
    )


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language(docs.where(id_remainder(4) != 2))
    marked = with_language(docs.drop("lang"), model, out="_language")
    return marked.select(
        "doc_id",
        (id_remainder(4) == 2).alias("held_out"),
        F.col("_language.lang").alias("lang_pred"),
        F.col("_language.score").alias("score"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        word_count(F.col("text")).alias("_size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_check"),
    )
    rows, _ = numbered(rows)
    mixed = mix(rows)
    taken = mixed.pieces.groupBy("_row").agg(F.sum("_words").alias("_taken"))
    sources = mixed.sources.select(F.col("_source").alias("_name"), "_size", "_target")
    sources = sources.withColumnRenamed("_size", "_source_size")
    return (
        rows.join(taken, "_row", "left")
        .join(sources, F.col("_source").eqNullSafe(F.col("_name")))
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_size").alias("size"),
            F.col("_source_size").alias("source_size"),
            F.col("_target").alias("target"),
            F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return shard_rows(docs, key, 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = docs.select("doc_id", secret_spans(F.col("text")).alias("_all"))
    base = F.filter("_all", lambda span: span["base"])

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def counted(kind: str) -> Column:
        return F.size(F.filter(base, lambda span: span["kind"] == kind)).cast("long")

    return marked.select(
        "doc_id",
        *[counted(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("_all")).alias("spans"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = kept(with_fingerprint(docs, "text", "_fp", 4).drop("text"), "fingerprints")
    return near_groups(rows, "doc_id", "_fp", 4).select(
        "doc_id",
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_group").alias("component_id"),
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = without_repeated_bytes(docs, out="_cut")
    removed = F.aggregate(
        "_cut.removed", F.lit(0).cast("long"), lambda n, run: n + (run[1] - run[0]).cast("long")
    )
    return cut.select(
        "doc_id",
        (F.octet_length("_cut.kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("_cut.removed").cast("long").alias("n_spans"),
        F.sha2("_cut.kept", 256).alias("kept_sha256"),
    )


def _units_left(cut: DataFrame, units: str) -> DataFrame:
    gone = F.aggregate(
        "_cut.removed",
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("last")),
        lambda s, run: F.struct(
            (s["n"] + F.greatest(F.lit(0), run[1] - F.greatest(run[0] - 1, s["last"]))).alias("n"),
            F.greatest(s["last"], run[1]).alias("last"),
        ),
    )
    return cut.select(
        "doc_id",
        F.col("_cut.n_sentences").alias(units),
        gone["n"].cast("long").alias("n_removed"),
        F.sha2(F.coalesce("_cut.kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated runs of sentences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _units_left(without_repeats(docs, out="_cut"), "n_sentences")


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages, in whole sentences or not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _units_left(without_passages(docs, out="_cut"), "n_units")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document by the similarity of its pairs of words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    near = with_near_group(docs, out="_near")
    return near.select(
        "doc_id",
        F.col("_near.n").alias("n_shingles"),
        F.col("_near.group").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("_near.group")).alias("kept"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after the other."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality,
        op2_decontamination,
        op3_neighbours,
        op4_language,
        op5_mixing,
        op6_sharding,
        op7_secrets,
        op8_simhash,
        op9_repeats,
        op10_sentences,
        op10_passages,
        op11_phrases,
        op12_negatives,
        op13_setsketch,
        pipeline,
    )
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_decontamination": rf"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")},
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT DISTINCT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, i, i + least(13, len(w)) - 1) AS x
  FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i)
  WHERE len(w) > 0
), places AS (
  SELECT row, i, n, list_slice(w, i, i + n - 1) AS x
  FROM words, (SELECT DISTINCT n FROM windows) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
  WHERE len(w) >= n
), found AS (
  SELECT row, i, p.n AS n, item_id FROM places AS p JOIN windows AS q ON p.x = q.x AND p.n = q.n
), hits AS (
  SELECT row, count(DISTINCT k) AS n_hit
  FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
""",
    "op10_sentences": rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row, coalesce(text, '') AS text
  FROM documents
), cut AS (
  SELECT row, doc_id, i, s[i] AS raw, list_filter(
      string_split_regex({_LOWER.format("s[i]")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT *, regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+') AS s FROM docs),
    unnest(range(1, len(s) + 1)) AS t(i)
), summed AS (
  SELECT *, len(w) AS n, sum(len(w)) OVER (PARTITION BY row ORDER BY i) AS upto FROM cut
), ends AS (
  SELECT a.row, a.doc_id, a.i AS first, min(b.i) AS last
  FROM summed AS a JOIN summed AS b
    ON a.row = b.row AND b.i >= a.i + {SENTENCES - 1} AND b.upto - a.upto + a.n >= {WORDS}
  GROUP BY ALL
), wholes AS (
  SELECT row, doc_id, 1 AS first, max(i) AS last FROM summed
  WHERE row NOT IN (SELECT row FROM ends) GROUP BY ALL HAVING sum(n) > 0
), spans AS (
  SELECT e.row, e.doc_id, e.first, e.last, list(array_to_string(c.w, ' ') ORDER BY c.i) AS x
  FROM (FROM ends UNION ALL FROM wholes) AS e
    JOIN summed AS c ON c.row = e.row AND c.i BETWEEN e.first AND e.last
  GROUP BY ALL
), later AS (
  SELECT row, first, last FROM (
    SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, first) AS place FROM spans)
  WHERE place > 1
), gone AS (
  SELECT DISTINCT row, i FROM later, unnest(range(first, last + 1)) AS t(i)
)
SELECT d.doc_id, count(c.i) AS n_sentences, count(g.i) AS n_removed,
  sha256(coalesce(string_agg(c.raw, '' ORDER BY c.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM docs AS d LEFT JOIN cut AS c ON c.row = d.row LEFT JOIN gone AS g ON g.row = c.row AND g.i = c.i
GROUP BY d.row, d.doc_id
""",
    "op11_phrases": rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), f AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS n
  FROM cut, (SELECT unnest(range(1, 6)) AS k), unnest(range(1, len(w) - k + 2)) AS t(i)
  WHERE len(w) >= k GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE k > 1 AND n >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.a, t.total, c.k, i, x.n AS l, y.n AS r,
    (1000::HUGEINT * c.a * t.total) // (x.n::HUGEINT * y.n) AS score
  FROM candidates AS c, unnest(range(1, c.k)) AS u(i)
    JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, i), ' ')
    JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, i + 1, c.k), ' ')
    JOIN totals AS t ON t.lang = c.lang
), scored AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), inner_ones AS (
  SELECT DISTINCT c.lang, array_to_string(list_slice(c.w, i, i + s - 1), ' ') AS phrase, c.a
  FROM candidates AS c, (SELECT unnest(range(2, 5)) AS s), unnest(range(1, c.k - s + 2)) AS t(i)
  WHERE s < c.k
), free AS (
  SELECT * FROM scored AS s WHERE NOT EXISTS (
    SELECT 1 FROM inner_ones AS i
    WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.a >= 100 * s.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, total AS n, CAST(score AS BIGINT) AS score
FROM free QUALIFY rank <= 2000
""",
    "op12_negatives": """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows AS a JOIN rows AS b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER)
    AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scored AS n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
""",
}
