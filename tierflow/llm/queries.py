"""The subpackage's queries and their SQL, for registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tierflow.llm.best_fit import op5_best_fit_packing
from tierflow.llm.decontaminate import op8_benchmark_decontamination
from tierflow.llm.embedding_links import op6_embedding_links
from tierflow.llm.hard_negatives import op11_hard_negatives
from tierflow.llm.html_extraction import op7_html_extraction
from tierflow.llm.language_model import op2_language_model_scores
from tierflow.llm.mixing import op13_source_mix
from tierflow.llm.near_duplicates import op4_near_duplicates
from tierflow.llm.packed_ids import op3_packed_token_ids
from tierflow.llm.spelling import op12_spelling_groups
from tierflow.llm.suffix_dedup import op1_suffix_dedup
from tierflow.llm.toxicity import op10_toxicity
from tierflow.llm.urls import op9_url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_language_model_scores": op2_language_model_scores,
        "op3_packed_token_ids": op3_packed_token_ids,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_embedding_links": op6_embedding_links,
        "op7_html_extraction": op7_html_extraction,
        "op8_benchmark_decontamination": op8_benchmark_decontamination,
        "op9_url_filter": op9_url_filter,
        "op10_toxicity": op10_toxicity,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_spelling_groups": op12_spelling_groups,
        "op13_source_mix": op13_source_mix,
        "pipeline": corpus_pipeline.run,
    }


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

# Every window of every text against every window of every item.
OP8 = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id, w, least(len(w), 10) AS n
          FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    theirs AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
               FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
    ours AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
             FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                   FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
    h AS (SELECT DISTINCT r, item_id, i, n FROM ours JOIN theirs USING (n, k)),
    words AS (SELECT r, count(DISTINCT p) AS n_hit
              FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM h) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

# Every pair of vectors, and all that each reaches.
OP6 = """
    WITH RECURSIVE e AS (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9),
    reach AS (SELECT vec_id, vec_id AS r FROM embeddings
              UNION SELECT reach.vec_id, e.b FROM reach JOIN e ON reach.r = e.a),
    least_id AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
    n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM least_id LEFT JOIN n ON n.a = vec_id"""


# Every anchor against every row.
OP11 = """
    WITH q AS (
        SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, b.r, a.label = b.label AS same,
               list_inner_product(a.v, b.v)::BIGINT AS score
        FROM q a JOIN q b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
    p AS (
        SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) AS k FROM s WHERE same),
    n AS (
        SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.id, s.r) AS rank
        FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
        WHERE p.k <= 5 AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

# CRC-32 byte by byte with a table made by its rule (the reversed polynomial is a fixed value),
# near words by what is left without one character.
OP12 = r"""
    WITH RECURSIVE crc AS (
        SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i)),
    runs AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
        FROM documents),
    counted AS (SELECT id, run, count(*) AS m FROM runs WHERE length(run) >= 6 GROUP BY id, run),
    coded AS (
        SELECT run, m, xor(list_reduce(
            [4294967295] || flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
                CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)),
            lambda h, b: xor(h // 256, t[xor(h % 256, b) + 1])), 4294967295) AS h
        FROM counted, crc),
    words AS (
        SELECT word, sum(m)::BIGINT AS n
        FROM (SELECT m, CASE WHEN h % 199 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word
              FROM coded)
        WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
    cut AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    pairs AS (
        SELECT a.word, b.word AS near FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
        UNION SELECT cut.word, w.word FROM cut JOIN words w ON w.word = cut.rest
        UNION SELECT w.word, cut.word FROM cut JOIN words w ON w.word = cut.rest),
    best AS (
        SELECT p.word, count(*) AS n_near, arg_min(p.near, (-w.n, p.near)) AS near, max(w.n) AS near_n
        FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
    forms AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
               CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
        FROM words LEFT JOIN best USING (word)),
    steps AS (
        SELECT word, form AS at FROM forms WHERE form IS NOT NULL
        UNION SELECT steps.word, forms.form FROM steps JOIN forms ON forms.word = steps.at WHERE forms.form IS NOT NULL),
    roots AS (SELECT steps.word, min(steps.at) AS root FROM steps JOIN forms ON forms.word = steps.at WHERE forms.form IS NULL GROUP BY steps.word)
    SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)"""


def oracle_sql() -> dict[str, str]:
    """Only what SQL can say; the other queries have plain versions in tests/llm."""
    return {
        "op6_embedding_links": OP6,
        "op8_benchmark_decontamination": OP8,
        "op11_hard_negatives": OP11,
        "op12_spelling_groups": OP12,
    }
