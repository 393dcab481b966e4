"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, byte_bpe, language, mixing, packing, phrases, pii, secrets, simhash, token_counts, topk, urls, vectors
from .common import settle, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates among all vectors of a label."""
    return vectors.near_vectors(table(spark, folder, "embeddings"), least=0.93)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents replicated so that sources weigh as the square roots of their sizes."""
    return mixing.replicate(table(spark, folder, "documents"), seed=11, temperature=0.5)


#: The rules of the contract.
URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages; a page is labelled by the document of its number."""
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad)
    return urls.judge(table(spark, folder, "pages"), labels, URL_RULES)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All long strings of all documents with their probability of being a secret."""
    return secrets.scan(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents, and which are longer than a window of 512."""
    counts = token_counts.count_tokens(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted languages of all documents, learned from three quarters of them."""
    return language.fit_and_predict(table(spark, folder, "documents"))


def surrogate_key(spark: SparkSession) -> bytes:
    """The secret that surrogates depend on; the default is for proofs only."""
    return spark.conf.get("dugout.pii.key", "proof").encode()


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with personal data replaced, and how much each type was found."""
    replaced = pii.replace_pii(table(spark, folder, "documents"), surrogate_key(spark))
    counts = [F.coalesce(F.col("pii_counts")[k], F.lit(0)).alias(f"n_{k}") for k in pii.TYPES]
    return replaced.select("*", *counts).drop("pii_counts")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op9_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return topk.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    return simhash.simhash_classes(table(spark, folder, "documents"), words=3, max_bits=2)


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded; digests of their ids and bytes."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    decoded = byte_bpe.round_trip(table(spark, folder, "documents"), path)
    shown = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(shown, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest phrases of every language in all documents."""
    return phrases.collocations(table(spark, folder, "documents"), most=2000, least=10)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """The tokens of two vocabularies aligned in all documents, with corpus-wide pair counts."""
    docs = table(spark, folder, "documents")
    aligned = alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    stored = settle(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.score(stored)


QUERIES = {f.__name__: f for f in (op1_near_vectors, op2_url_filter, op3_mixing, op4_secret_scan, op5_token_counts, op6_language_id, op7_pii, op8_packing, op9_exact_topk, op10_simhash, op11_byte_bpe, op12_phrases, op13_alignment)}

SQL: dict[str, str] = {
    "op1_near_vectors": """
        WITH RECURSIVE fine AS (
            SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.row AS a, b.row AS b FROM fine a JOIN fine b
            ON a.label = b.label AND a.row <> b.row AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93
        ),
        reach AS (
            SELECT a AS start, b AS there FROM links
            UNION SELECT reach.start, links.b FROM reach JOIN links ON links.a = reach.there
        ),
        degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        least AS (SELECT start, min(vec_id) AS least FROM reach JOIN fine ON fine.row = there GROUP BY start),
        judged AS (
            SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id
            FROM fine LEFT JOIN degrees ON a = row LEFT JOIN least ON start = row
            UNION ALL
            SELECT vec_id, 0::BIGINT, vec_id FROM embeddings
            WHERE label IS NULL OR embedding IS NULL OR len(embedding) = 0
               OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0
               OR len(list_filter(embedding, lambda x: x <> 0)) = 0
        )
        SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM judged
    """,
    "op9_exact_topk": """
        WITH whole AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ),
        words AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
        ),
        phrases AS (
            SELECT lang, k, unnest(list_transform(
                range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM words, (VALUES (1), (2), (3)) AS sizes(k)
        ),
        counts AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM phrases GROUP BY ALL),
        totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
        frequent AS (SELECT * FROM counts WHERE k > 1 AND a >= 10),
        cuts AS (
            SELECT f.lang, f.phrase, f.a, c, l.a AS l, r.a AS r,
                1000000::HUGEINT * f.a * f.a // (l.a::HUGEINT * r.a) AS score
            FROM frequent f JOIN (VALUES (1), (2)) AS places(c) ON c < f.k
            JOIN counts l ON l.lang = f.lang AND l.phrase = array_to_string(f.w[1:c], ' ')
            JOIN counts r ON r.lang = f.lang AND r.phrase = array_to_string(f.w[c + 1:f.k], ' ')
        ),
        lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
        ),
        kept AS (
            SELECT * FROM lowest s WHERE NOT EXISTS (
                SELECT 1 FROM frequent f, (VALUES (1), (2)) AS places(c)
                WHERE f.k = 3 AND f.lang = s.lang AND array_to_string(f.w[c:c + 1], ' ') = s.phrase AND 100 * f.a >= 50 * s.a
            )
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, n, score::BIGINT AS score
        FROM kept JOIN totals USING (lang)
        QUALIFY rank <= 2000
    """,
    "op3_mixing": """
        WITH sources AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (
            SELECT source, sqrt(n) * (sum(n) OVER () / sum(sqrt(n)) OVER ()) / n AS rate FROM sources
        ),
        parts AS (SELECT source, rate, greatest(1, ceil(rate / 64))::BIGINT AS parts FROM rates),
        chances AS (
            SELECT source, parts, k, exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)) AS chance
            FROM parts, range(0, 200) AS t(k)
        ),
        cdf AS (
            SELECT source, parts, list(c) AS cdf FROM (
                SELECT source, parts, sum(chance) OVER (PARTITION BY source ORDER BY k) AS c FROM chances
            ) GROUP BY source, parts
        ),
        numbered AS (
            SELECT d.*, list_sum(list_transform(range(0, parts), lambda part: len(list_filter(cdf, lambda c:
                c <= (('0x' || substr(md5('11:' || d.doc_id || ':' || part), 1, 13))::BIGINT + 0.5)
                    / 4503599627370496.0)))) AS number
            FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
        )
        SELECT doc_id, text, lang, source, n_chars, unnest(range(1, number::BIGINT + 1))::INTEGER AS copy
        FROM numbered
    """,
}
