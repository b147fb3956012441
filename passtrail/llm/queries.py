"""The operators over their whole tables with production parameters, and the digests of their results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.llm import audit, bpe, chosen, common, exact, lines, packing, search, simhash, substring, suffix, toxicity, warc, winnow
from passtrail.operators.stores import new_folder, stored


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    common.small_batches(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def op1_warc(spark: SparkSession, base: str) -> DataFrame:
    """``pages`` written as compressed archives, and what is read back from them."""
    folder = new_folder(spark, "archives")
    stored(warc.write_archives(warc.page_records(_table(spark, base, "pages")), folder), "manifest")
    back = warc.read_archives(warc.load_archives(spark, folder), with_payload=False, strict=True)
    return back.select(
        warc.page_of(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
        "record_type", warc.page_of(F.col("refers_to_id")).alias("refers_to"),
    )


def op2_bpe(spark: SparkSession, base: str) -> DataFrame:
    """Ids of whole ``documents`` and the texts that the ids stand for."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(_table(spark, base, "documents"), path, then=bpe.digests(path))


def op3_toxicity(spark: SparkSession, base: str) -> DataFrame:
    """Toxicity scores of ``documents``, learned from ``labels``."""
    return toxicity.judged(_table(spark, base, "documents"), _table(spark, base, "labels"))


def op4_exact_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Groups of ``documents`` that are equal but for white space, and the row of each that stays."""
    return exact.copy_groups(_table(spark, base, "documents")).drop("mark")


def op5_simhash(spark: SparkSession, base: str) -> DataFrame:
    """SimHash fingerprints of ``documents`` and the components of those that differ in at most four bits."""
    return simhash.components(_table(spark, base, "documents"))


def op6_suffix_array(spark: SparkSession, base: str) -> DataFrame:
    """Bytes of ``documents`` that are in a string of 400 that occurs twice."""
    found = suffix.repeated_bytes(_table(spark, base, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_winnowing(spark: SparkSession, base: str) -> DataFrame:
    """Fingerprints of ``documents``, of their edited texts, and how alike they are."""
    return winnow.edits(_table(spark, base, "documents"))


def op8_packing(spark: SparkSession, base: str) -> DataFrame:
    """All ``documents`` as pieces of sequences of at most 2048 ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, base, "documents"), path, with_ids=False)


def op9_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Words of ``documents`` that repeat an earlier run of twenty."""
    found = substring.repeated_words(_table(spark, base, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Lines of ``documents`` that are similar to an earlier line."""
    found = lines.without_similar_lines(_table(spark, base, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, base: str) -> DataFrame:
    """The ten best ``documents`` for each ``benchmark`` item."""
    return search.search(_table(spark, base, "documents"), _table(spark, base, "benchmark"))


def op12_filter_audit(spark: SparkSession, base: str) -> DataFrame:
    """What five filters remove from ``documents`` in each of their orders, by language."""
    return audit.audit(_table(spark, base, "documents"), _table(spark, base, "labels"))


def op13_chosen_path(spark: SparkSession, base: str) -> DataFrame:
    """Components of ``documents`` whose sets of two-word shingles are similar at 0.8."""
    return chosen.components(_table(spark, base, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_simhash": op5_simhash,
    "op6_suffix_array": op6_suffix_array,
    "op7_winnowing": op7_winnowing,
    "op8_packing": op8_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_chosen_path": op13_chosen_path,
}

#: The same results as SQL, where SQL can express them over whole tables.
ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
            CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM q
    """,
    "op4_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
            row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
        FROM plain WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
    """,
    "op11_ranked_search": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), q AS (
            SELECT item_id, row, term, count(*) AS repeats FROM (
                SELECT item_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT DISTINCT item_id, text FROM benchmark)
            ) GROUP BY ALL
        ), n AS (SELECT row, doc_id, count(*) AS n FROM d GROUP BY row, doc_id), s AS (SELECT count(*) AS total, sum(n)::BIGINT AS length FROM n),
        tf AS (SELECT row, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY row, term),
        w AS (
            SELECT term, floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term
        ), scored AS (
            SELECT q.item_id, q.row AS item, n.doc_id, n.row,
                sum(q.repeats * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 75 + ((75 * n.n * s.total) // s.length)))))::BIGINT AS score
            FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n ON n.row = tf.row, s GROUP BY ALL
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scored WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), f AS (
            SELECT doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
            FROM w
        ), l AS (
            SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
        ), doc AS (
            SELECT part, [a, b, c, d, e] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
            FROM f LEFT JOIN l ON f.doc_id = l.doc_id
        ), cell AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
            FROM doc GROUP BY part, fails
        ), letter AS (SELECT unnest([1, 2, 3, 4, 5]) AS k), orders AS (
            SELECT [v.k, w.k, x.k, y.k, z.k] AS ks, substr('ABCDE', v.k, 1) || substr('ABCDE', w.k, 1) || substr('ABCDE', x.k, 1)
                || substr('ABCDE', y.k, 1) || substr('ABCDE', z.k, 1) AS filter_order
            FROM letter v, letter w, letter x, letter y, letter z WHERE len(list_distinct([v.k, w.k, x.k, y.k, z.k])) = 5
        ), met AS (
            SELECT part, filter_order, step.k AS step, ks[step.k] AS bit, n, good, toxic, fails[ks[step.k]] AS here,
                len(list_filter(ks[1:step.k - 1], lambda i: fails[i])) > 0 AS before, len(list_filter(fails, lambda x: x)) AS failed
            FROM cell, orders, letter step
        ), steps AS (
            SELECT part, filter_order, step, any_value(bit) AS bit,
                sum(CASE WHEN NOT here AND NOT before THEN n ELSE 0 END) AS kept, sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN here AND before THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN here AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN here AND NOT before THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN here AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
            FROM met GROUP BY part, filter_order, step
        )
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
            unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM steps
    """,
    "op13_chosen_path": r"""
        WITH RECURSIVE w AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), docs AS (
            SELECT row, doc_id, CASE WHEN len(words) < 2 THEN words
                ELSE list_distinct(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) END AS shingles
            FROM w
        ), sets AS (SELECT list_sort(shingles) AS s, row, doc_id, len(shingles) AS n FROM docs),
        classes AS (SELECT min(row) AS node, min(doc_id) AS least, s, any_value(n) AS n FROM sets WHERE n > 0 GROUP BY s),
        tokens AS (SELECT node, n, unnest(s) AS token FROM classes), hashed AS (SELECT node, n, hash(token) AS token FROM tokens),
        links AS (
            SELECT a.node AS a, b.node AS b FROM hashed a JOIN hashed b ON a.token = b.token AND a.node < b.node
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.node, b.node HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT node AS a, node AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
        found AS (SELECT r.a AS node, min(c.least) AS component_id FROM reach r JOIN classes c ON c.node = r.b GROUP BY r.a)
        SELECT sets.doc_id, sets.n AS n_shingles, CASE WHEN sets.n = 0 THEN sets.doc_id ELSE component_id END AS component_id,
            sets.doc_id IS NOT DISTINCT FROM (CASE WHEN sets.n = 0 THEN sets.doc_id ELSE component_id END) AS kept
        FROM sets LEFT JOIN classes USING (s) LEFT JOIN found USING (node)
    """,
}
