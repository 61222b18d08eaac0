"""The queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formtide.llm.common import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.packing import pack_documents

    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


@query
def op2_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.toxicity import learn_toxicity, score_toxicity

    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return score_toxicity(docs, learn_toxicity(docs, labels))


@query
def op5_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from formtide.llm.quality import learn_quality, remainder, score_quality

    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    scores = score_quality(docs, learn_quality(docs, labels, held))
    return scores.select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op4_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.neighbours import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op8_pivot_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.neighbours import top_k

    return top_k(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


ORACLES["op8_pivot_distances"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op9_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.cover_dedup import remove_repeats

    return remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op3_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.suffix_dedup import remove_repeats

    return remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.jaccard import similarity_classes

    return similarity_classes(read_table(spark, sf_dir, "documents"))


@query
def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.suffix_tree_lm import score_texts

    return score_texts(read_table(spark, sf_dir, "documents"))


@query
def op1_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from formtide.llm.pieces import encode_texts

    rows = encode_texts(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "restored", "ids")


@query
def op11_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from formtide.llm.language import learn_languages, predict_languages
    from formtide.llm.sampling import remainder

    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    found = predict_languages(docs, learn_languages(docs, held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_bytes", "n_agree")


@query
def op12_secondary_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from formtide.llm.hard_negatives import mine_hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine_hard_negatives(vectors, lambda vec_id: vec_id % 100 == 0)


ORACLES["op12_secondary_sort"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
           CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


@query
def op13_truncation_peeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formtide.llm.prefix_trie import prefix_trie

    return prefix_trie(read_table(spark, sf_dir, "conversations"))


# crc32 goes bit by bit: DuckDB has no such function
ORACLES["op13_truncation_peeling"] = """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT conv_id, CAST(xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
            lambda ch: list_transform(range(8), lambda i: (ascii(ch) >> CAST(i AS INTEGER)) & 1)))),
        lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1))), 4294967295) % 6 AS BIGINT) AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
    SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h
), paths AS (
    SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.part, r.place) FILTER (r.part IS NOT NULL), []) AS path
    FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), members AS (
    SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths
), nodes AS (
    SELECT depth, path[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
    FROM members GROUP BY ALL
), below AS (
    SELECT a.depth, a.prefix, sum(CASE WHEN b.depth = a.depth + 1 THEN 1 ELSE 0 END) AS n_children,
           sum(CASE WHEN b.depth > 0 THEN (b.n_convs - 1) * length(b.prefix[b.depth].text) ELSE 0 END) AS saved_tokens
    FROM nodes a JOIN nodes b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY a.depth, a.prefix
), leaves AS (
    SELECT a.depth, a.prefix, count(*) AS n_leaves
    FROM nodes a JOIN below b ON b.n_children = 0 AND b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix
    GROUP BY a.depth, a.prefix
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       CAST(b.n_children AS BIGINT) AS n_children, l.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n
JOIN below b ON b.depth = n.depth AND b.prefix = n.prefix
JOIN leaves l ON l.depth = n.depth AND l.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1 : n.depth - 1]
"""
