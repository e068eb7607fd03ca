"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (decontaminate, embedding_dedup, html_text, lm, minhash, mixing, packing, phrases,
                           quality, sharding, spelling, token_files, topk)
from tallybook.llm.workers import ship
from tallybook.sources.staging import staging_path


def tokenizer_file() -> str:
    """The public vocabulary the queries use; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(spark, folder, "embeddings"))


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    return topk.top_k(rows.where("vec_id % 100 = 0"), rows)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shard_rows(rows, ["doc_id"], 16, rows=docs.count()).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long"), "grown_shard")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return quality.score_documents(docs, labels).select(
        "doc_id", "p_text", "host_posterior", "path_posterior", "score", "keep")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    path = staging_path(spark, "token-files")
    token_files.write_tokens(docs, path, tokenizer_file())
    rows = token_files.read_tokens(spark, path)
    return rows.select("doc_id", "start", "n_tokens", token_files.ids_crc32(F.col("tokens")).alias("ids_crc32"))


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"), shingle=3, percent=85)


def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_file()).drop("ids")


def op10_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm.score_texts(read(spark, folder, "documents"), held_out)


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(read(spark, folder, "documents"), alter=spelling.drop_letters(199))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_items(
        read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("items")


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_topk, op3_sharding, op4_quality, op5_mixing,
                                 op6_token_files, op7_minhash, op8_html, op9_packing, op10_lm,
                                 op11_spelling, op12_phrases, op13_decontaminate)}

# The same order, budgets and cut in one statement.
OP5_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('mix|' || CAST(doc_id AS VARCHAR)) AS k
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighted AS (
    SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n,
           CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS w
    FROM sources),
levels AS (
    SELECT *, (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE)
               - CAST(coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, n
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
              / sum(w) OVER (ORDER BY 2 * source_size / w, n
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted),
targets AS (
    SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), w * max(level) OVER ()) AS target
    FROM levels),
ranked AS (
    SELECT doc_id, d.source, size, source_size, target, CAST(round(target) AS BIGINT) AS wanted,
           CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
cut AS (
    SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS epochs FROM ranked)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, wanted - epochs * source_size - before)) AS BIGINT) AS taken
FROM cut
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Classes of linked ids from ``links`` (a, b), both directions, for the ids of ``nodes``.
_CLASSES = """
reached AS (
    SELECT id AS a, id AS b FROM nodes
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
classes AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a)"""

OP1_SQL = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
vectors AS (
    SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS size
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
    WHERE len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id
    WHERE x.size > 0 AND y.size > 0 AND list_inner_product(x.v, y.v) / (x.size * y.size) >= 0.93),
{_CLASSES},
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM classes LEFT JOIN counted USING (id)
"""

OP2_SQL = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP7_SQL = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 1, 2))) AS p(i) WHERE len(w) > 0),
nodes AS (SELECT doc_id AS id, count(s) AS size FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b
    WHERE 100 * n >= 85 * (p.size + q.size - n)),
{_CLASSES}
SELECT id AS doc_id, size AS n_shingles, component_id, id = component_id AS kept
FROM nodes JOIN classes USING (id)
"""

# Counts of all word sequences, then cuts, extensions and ranks.
OP12_SQL = rf"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS t FROM documents)),
grams AS (
    SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM pieces, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) + 2 - k)) AS p(i)
    WHERE len(w) >= k GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE words = 1 GROUP BY lang),
candidates AS (
    SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE words > 1 AND f >= 10),
longer AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
    FROM candidates WHERE words = 3),
free AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.a >= 50 * c.a)),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS left_part,
           array_to_string(w[k + 1:words], ' ') AS right_part
    FROM free, unnest([1, 2]) AS s(k) WHERE k < words),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
           CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.left_part
    JOIN grams y ON y.lang = c.lang AND y.phrase = c.right_part),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# All windows of all texts, without fingerprints.
OP13_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS length
    FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
    WHERE len(w) > 0),
wanted AS (
    SELECT DISTINCT item, length, array_to_string(w[i:i + length - 1], ' ') AS t
    FROM items, unnest(range(1, len(w) + 2 - length)) AS p(i)),
windows AS (
    SELECT doc, i, length, array_to_string(w[i:i + length - 1], ' ') AS t
    FROM docs, (SELECT DISTINCT length FROM wanted) AS s, unnest(range(1, len(w) + 2 - length)) AS p(i)
    WHERE len(w) >= length),
hits AS (SELECT doc, i, length, item FROM windows JOIN wanted USING (length, t)),
marked AS (
    SELECT doc, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, length)) AS p(k) GROUP BY doc),
named AS (
    SELECT doc, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (doc) LEFT JOIN named USING (doc)
"""

ORACLE_SQL = {"op1_embedding_dedup": OP1_SQL, "op2_topk": OP2_SQL, "op5_mixing": OP5_SQL, "op7_minhash": OP7_SQL,
              "op12_phrases": OP12_SQL, "op13_decontaminate": OP13_SQL}
