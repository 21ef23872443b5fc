"""Queries opN_<name> over the driver tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lapmart.llm import (
    decontam, divergence, ego, license_scan, packing, periodic, personal, ppm, quality, secret_scan, setjoin, simple8b, warc)
from lapmart.llm.common import table


def op1_epsilon_grid(spark, sf_dir):
    """Embeddings of equal labels with cosine 0.98 or more."""
    return ego.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op2_simple8b(spark, sf_dir):
    """Token files: word_bpe_49k ids with end id 2, read back."""
    return simple8b.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


def op3_empirical_bayes(spark, sf_dir):
    """Every document judged; sites are sources, and languages within a source."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            F.col("source"), F.col("lang")).drop("row_key")


def op4_randomness_battery(spark, sf_dir):
    """Secrets of every document."""
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op5_retrieval_packing(spark, sf_dir):
    """Windows of 2048 ids of byte_bpe_50k with end id 1."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1)


def op6_ppm(spark, sf_dir):
    """All documents scored by a byte trie and by word counts."""
    return ppm.score(table(spark, sf_dir, "documents"))


def op7_warc(spark, sf_dir):
    """Every page archived and read back."""
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_decontamination(spark, sf_dir):
    """Documents against the windows of 13 words of the benchmark."""
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_patience(spark, sf_dir):
    """License notices in every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark, sf_dir):
    """Documents whose sets of 3-word shingles have Jaccard similarity 0.9 or more."""
    return setjoin.jaccard_components(table(spark, sf_dir, "documents"), 3, 90, 100)


def op11_minimizer_runs(spark, sf_dir):
    """Periodic runs of words of every document, a tenth of them made periodic first."""
    docs = table(spark, sf_dir, "documents")
    return periodic.digest(periodic.collapse(docs.withColumn("text", periodic.planted(F.col("doc_id"), F.col("text")))))


def op12_semi_markov(spark, sf_dir):
    """Personal data of every document."""
    return personal.digest(personal.personal_data(table(spark, sf_dir, "documents")))


def op13_late_strings(spark, sf_dir):
    """Term divergence of the sources of each language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_epsilon_grid, op2_simple8b, op3_empirical_bayes, op4_randomness_battery, op5_retrieval_packing, op6_ppm, op7_warc,
    op8_decontamination, op9_patience, op10_jaccard_join,
    op11_minimizer_runs, op12_semi_markov, op13_late_strings)}

# Links of the pairs (a, b), spread to whole components.
_REACH = """
    , pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a AS node, b AS other FROM pairs UNION SELECT r.node, l.b FROM reach r JOIN pairs l ON r.other = l.a),
    comp AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)"""

ORACLE_SQL = {
    "op1_epsilon_grid": f"""
        WITH RECURSIVE v AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
          WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x FOR x IN embedding IF x <> 0]) > 0),
        links AS (
          SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
          WHERE list_cosine_similarity(x.e, y.e) >= 0.98) {_REACH},
        degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
               vec_id = coalesce(component, vec_id) AS kept
        FROM embeddings LEFT JOIN degree ON vec_id = a LEFT JOIN comp ON vec_id = node""",
    "op8_decontamination": r"""
        WITH iw AS (SELECT item_id, regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win,
                       least(13, len(w)) AS n
                FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
        dw AS (SELECT doc_id, regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        dg AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                     FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
        occ AS (SELECT doc_id, item_id, i, dg.n FROM dg JOIN win USING (win, n)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
        it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
               FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY 1)
        SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op10_jaccard_join": f"""
        WITH RECURSIVE d AS (
          SELECT doc_id, list_filter_words AS w FROM (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x20\x09-\x0D]+') IF x <> ''] AS list_filter_words FROM documents)),
        s AS (SELECT DISTINCT doc_id, sh FROM (
          SELECT doc_id, unnest([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, greatest(len(w) - 1, 2))]) AS sh
          FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y USING (sh)
              WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
                  WHERE 100 * o >= 90 * (p.n + q.n - o)) {_REACH}
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON doc_id = node""",
    "op13_late_strings": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        tok AS (SELECT r, lang, source, unnest(w) AS t FROM d),
        kept AS (SELECT lang, t, count(*) AS total FROM tok GROUP BY lang, t HAVING count(DISTINCT r) >= 3),
        l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, t, count(*) AS n FROM tok JOIN kept USING (lang, t) GROUP BY lang, source, t),
        gn AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
        p AS (SELECT lang, source, t, coalesce(c.n, 0) AS n,
                     1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(gn.n, 0) + v)::HUGEINT AS p,
                     1 + (1000000000::HUGEINT * (total + 1)) // (l.n + v)::HUGEINT AS q
              FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN gn USING (lang, source)
                     LEFT JOIN c USING (lang, source, t)),
        pair AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                 FROM p x JOIN p y USING (lang, t) WHERE x.source <> y.source GROUP BY ALL),
        parts AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
          UNION ALL
          SELECT lang, source, 'term', t, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
          FROM parts) WHERE part = 'pair' OR rank <= 200""",
    "op7_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
             r AS (SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN response IS NULL OR page_id IS NOT DISTINCT FROM response
                    THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> response THEN response END AS refers_to
        FROM p LEFT JOIN r USING (payload_digest)""",
}
