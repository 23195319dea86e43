"""One query per operator, with production parameters, over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.llm import ball_tree, bloom, byte_bpe, cover_tree, factor_machine, feistel, line_dedup, order_minhash, packing, piece_count, sanitise, set_join, whitening
from ledgermart.llm.common import documents


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom.dedup(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = factor_machine.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = factor_machine.score(docs.select("doc_id", "text"), machine)
    return scored.select("doc_id", (factor_machine.fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.join(documents(spark, sf_dir), percent=90, width=3)


def op6_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.spans(documents(spark, sf_dir).select("doc_id", "text"), sanitise.WHOLE)
    counts = [sanitise.count_of(kind).alias(f"n_{kind}") for kind in sanitise.KINDS[:4]]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(sanitise.listed(F.col("base")), 256).alias("base_sha256"), sanitise.listed(sanitise.all_spans()).alias("spans"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_count.count_tokens(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel.shard(documents(spark, sf_dir)).drop("position")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=4, scale=256)


QUERIES = {q.__name__: q for q in (op1_order_minhash, op2_line_dedup, op3_exact_dedup, op4_quality, op5_ngram_join, op6_sanitise, op7_byte_bpe, op8_packing, op9_token_counts, op10_sharding, op11_lexical_search, op12_embedding_near_dedup, op13_whitening)}

SQL = {
    "op2_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM documents WHERE text <> ''
        ),
        d AS (
            SELECT line, length(line) AS n, min((doc_id, pos)) AS first FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
        ),
        v AS (
            SELECT line, n, first, i, hash(left(line, i::INT) || substr(line, i::INT + 2)) AS h
            FROM (SELECT *, unnest(range(n)) AS i FROM d WHERE n >= 20)
        ),
        earliest AS (SELECT h, i, n, min(first) AS first FROM v GROUP BY h, i, n),
        near AS (
            SELECT v.line FROM v JOIN earliest e USING (h, i, n) WHERE e.first < v.first
            UNION SELECT v.line FROM v JOIN d ON hash(d.line) = v.h AND d.n >= 20 AND d.n = v.n - 1 WHERE d.first < v.first
            UNION SELECT d.line FROM v JOIN d ON hash(d.line) = v.h AND d.n >= 20 AND d.n = v.n - 1 WHERE v.first < d.first
        ),
        judged AS (
            SELECT l.*, (d.first IS NOT NULL AND ((l.doc_id, l.pos) <> d.first OR near.line IS NOT NULL)) AS gone, near.line IS NOT NULL AS near
            FROM l LEFT JOIN d USING (line) LEFT JOIN near USING (line)
        ),
        kept AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, count(*) FILTER (near) AS n_near,
                   coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
            FROM judged GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(n_near, 0) AS n_near,
               sha256(coalesce(kept.text, '')) AS text_sha256
        FROM documents LEFT JOIN kept USING (doc_id)
    """,
    "op5_ngram_join": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], chr(31)) FOR i IN range(1, len(w) - 1)]
                                                WHEN len(w) > 0 THEN [array_to_string(w, chr(31))] ELSE [] END) AS g FROM t
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM both_of JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)
        ),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) m USING (doc_id)
    """,
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g USING (text_sha256)
    """,
    "op11_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ),
        lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM lengths),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        df AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN lengths USING (doc_id), total GROUP BY item_id, doc_id
        ),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
              AND len(list_filter(embedding, lambda c: c <> 0)) > 0
        ),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
        least AS (SELECT a AS vec_id, min(b) AS least FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(least, e.vec_id)) AS component_id, e.vec_id <= coalesce(least, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
    """,
}
