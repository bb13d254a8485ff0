"""One query per operator, over its whole table, and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortrail.llm import (
    bpe,
    chat,
    decontaminate,
    divergence,
    html_text,
    language,
    parity,
    pii,
    repeats,
    simhash,
    token_counts,
    topk,
    va_file,
)
from cohortrail.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


# A conversation whose texts are control strings.
CONFLICTING = "SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.formatted(rows.union(spark.sql(CONFLICTING))))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.over_limit(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.audited(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.linked(table(spark, sf_dir, "documents"))


QUERIES = (
    op1_decontamination,
    op2_byte_bpe,
    op3_chat,
    op4_repeats,
    op5_pii,
    op6_top_k,
    op7_token_counts,
    op8_main_text,
    op9_language,
    op10_simhash,
    op11_centroids,
    op12_divergence,
    op13_jaccard,
)

TOP_K_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.r <> c.r
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
), sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text,
        '<\\*\|im_start\|>|<\\*\|im_end\|>|<\\*\|endoftext\|>|<\\*/?s>|\[\\*/?INST\]|<\\*</?SYS>>'
    )) + length('<|im_start|>' || role || chr(10) || '<|im_end|>' || chr(10)) AS chars
    FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized
GROUP BY conv_id
"""


REPEATS_SQL = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
    FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM d)
), first AS (
    SELECT s, min(doc_id) AS doc FROM w GROUP BY s
), r AS (
    SELECT w.doc_id, w.i, lag(w.i) OVER o AS p, lead(w.i) OVER o AS n
    FROM w JOIN first USING (s)
    WHERE first.doc < w.doc_id
    WINDOW o AS (PARTITION BY w.doc_id ORDER BY w.i)
), gone AS (
    SELECT doc_id,
           CAST(sum(least(50, coalesce(n - i, 50))) AS BIGINT) AS n_removed,
           count(*) FILTER (p IS NULL OR i - p > 50) AS n_spans,
           string_agg(CASE WHEN p IS NULL THEN substr(h, 1, 2 * i)
                           WHEN i - p > 50 THEN substr(h, 2 * (p + 50) + 1, 2 * (i - p - 50))
                           ELSE '' END, '' ORDER BY i) || substr(any_value(h), 2 * (max(i) + 50) + 1) AS kept
    FROM r JOIN d USING (doc_id)
    GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(len(h) // 2 AS BIGINT) AS n_bytes,
       coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


def _centroids_sql(rounds: int = 10) -> str:
    """Ten rounds of assignment and update, one after the other, over one row per vector and component."""
    parts = [
        """WITH usable AS (
    SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), x AS MATERIALIZED (
    SELECT r, unnest(range(64)) AS d, unnest(v) AS x FROM usable
), first AS (
    SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c
    FROM usable WHERE vec_id IS NOT NULL
), c0 AS MATERIALIZED (
    SELECT c, d, x FROM first JOIN x USING (r) WHERE c < 8
)"""
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT r, c, distance FROM (
        SELECT r, c, distance, row_number() OVER (PARTITION BY r ORDER BY distance, c) AS nr FROM (
            SELECT x.r, k.c, sum((x.x - k.x) * (x.x - k.x)) AS distance
            FROM x JOIN c{i} k USING (d) GROUP BY x.r, k.c)
    ) WHERE nr = 1
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
    SELECT c, d, sum(x) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY c, d
), c{i + 1} AS MATERIALIZED (
    SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, k.x) AS x FROM c{i} k LEFT JOIN s{i} USING (c, d)
)""")
    return (
        ", ".join(parts)
        + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN usable USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c) USING (c)
"""
    )


DIVERGENCE_SQL = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), t AS MATERIALIZED (
    SELECT r, lang, source, unnest(terms) AS term FROM d
), kept AS MATERIALIZED (
    SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), counts AS MATERIALIZED (
    SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM t SEMI JOIN kept USING (lang, term)
    GROUP BY lang, source, term
), langs AS (
    SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), groups AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(x.n, 0) AS n, coalesce(langs.v, 0) AS v, coalesce(langs.n, 0) AS all_n
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source) x USING (lang, source)
), p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c,
           1 + (1000000000 * (coalesce(x.c, 0) + 2)) // (g.n + 2 * g.v) AS p,
           1 + (1000000000 * (k.c + 2)) // (g.all_n + 2 * g.v) AS q
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts x USING (lang, source, term)
), pairs AS (
    SELECT lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY lang, a.source, b.source
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


JACCARD_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, w[i:i + 3] AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id
GROUP BY d.doc_id
"""


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def statements() -> dict[str, str]:
    return {
        "op3_chat": CHAT_SQL,
        "op4_repeats": REPEATS_SQL,
        "op6_top_k": TOP_K_SQL,
        "op11_centroids": _centroids_sql(),
        "op12_divergence": DIVERGENCE_SQL,
        "op13_jaccard": JACCARD_SQL,
    }
