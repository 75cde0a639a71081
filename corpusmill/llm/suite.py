"""One registered query per operator over its whole table, and the same results in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    byte_bpe,
    conversation_repair,
    html_extraction,
    kd_search,
    language_id,
    line_dedup,
    mixing,
    one_bit_search,
    quality,
    secrets,
    simhash,
    spelling_variants,
    token_counts,
)
from corpusmill.llm.common import sha256_hex
from corpusmill.session import shared_dir

TOKEN_LIMIT = 2048
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    # one cache for all runs of a cluster: counts are keyed by content, whatever table it stands in
    cache = f"{shared_dir(spark)}/token-counts"
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), path, cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc.doc_id", "kept.n_lines", "kept.n_dropped", sha256_hex(F.col("kept.text")).alias("kept_sha256")
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return kd_search.exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return one_bit_search.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        sha256_hex(secrets.span_text(base)).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(language_id.remainder(F.col("doc_id")) == 2, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc.doc_id",
        F.coalesce(language_id.remainder(F.col("doc.doc_id")) == 2, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        "found.score",
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_RANKS)
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).drop("shards")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, gone = conversation_repair.damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.audits(turns, gone=gone).drop("n_turns")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_table(spark, sf_dir, "documents"), typo_every=199)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = html_extraction.extract(pages, html_extraction.train())
    return found.select("page.page_id", "page.url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_line_dedup, op3_exact_top_k, op4_nearest, op5_secrets,
        op6_language_id, op7_byte_bpe, op8_mixture, op9_quality, op10_simhash, op11_conversation_repair,
        op12_spelling_variants, op13_html_extraction,
    )
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, n, line,
                   translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
        ),
        owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
        judged AS (
            SELECT l.doc_id, l.n, l.line, o.owner IS NOT NULL AND o.owner <> l.doc_id AS dropped
            FROM lines l LEFT JOIN owners o ON l.key = o.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )
        SELECT query_id, rank::INT AS rank, vec_id, score FROM (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score,
                   row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
        ) WHERE rank <= 10""",
    "op8_mixture": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
        ),
        sources AS (
            SELECT *, 3 * source_size AS cap, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
        ),
        marked AS (
            SELECT *, cap::DOUBLE * sum(weight) OVER later < weight::DOUBLE * (sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0)) AS cut
            FROM sources
            WINDOW later AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                   earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ),
        plan AS (
            SELECT *, least(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END), 3)::INT AS passes,
                   greatest(ceil(sqrt(n)), 1)::BIGINT AS blocks
            FROM (SELECT source, n, source_size,
                         CASE WHEN cut THEN cap::DOUBLE ELSE (sum(source_size) OVER ())::DOUBLE
                              - coalesce((sum(cap) FILTER (cut) OVER ())::DOUBLE, 0) END
                         * CASE WHEN cut THEN 1 ELSE weight::DOUBLE END
                         / CASE WHEN cut THEN 1 ELSE (sum(weight) FILTER (NOT cut) OVER ())::DOUBLE END AS target
                  FROM marked)
        ),
        placed AS (
            SELECT s.*, p.target, p.source_size, p.passes, floor(p.target - p.passes * p.source_size + 0.5)::BIGINT AS rest,
                   floor(place * blocks)::BIGINT AS block
            FROM (SELECT *, (('0x' || md5('5|' || doc_id)[:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS place FROM sized) s
            JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
        ),
        blocked AS (
            SELECT *, sum(words) OVER (PARTITION BY source ORDER BY block) AS upto
            FROM (SELECT source, block, any_value(rest) AS rest, sum(size) AS words FROM placed GROUP BY source, block)
        ),
        rows_ AS (
            SELECT d.*, d.rest > 0 AND b.upto <= d.rest AS whole, b.upto - b.words < d.rest AND d.rest < b.upto AS edge,
                   d.rest - (b.upto - b.words) AS room,
                   sum(d.size) OVER (PARTITION BY d.source, d.block ORDER BY d.place) AS filled
            FROM placed d JOIN blocked b ON d.source IS NOT DISTINCT FROM b.source AND d.block = b.block
        ),
        gaps AS (
            SELECT source, min(room - CASE WHEN filled <= room THEN filled ELSE 0 END) AS gap FROM rows_ WHERE edge GROUP BY source
        ),
        fitted AS (
            SELECT r.*, g.gap, row_number() OVER (PARTITION BY r.source, NOT whole AND NOT (edge AND filled <= room) AND size <= gap AND size > 0
                                           ORDER BY size DESC, place DESC) = 1
                        AND NOT whole AND NOT (edge AND filled <= room) AND coalesce(size <= gap AND size > 0, false) AS best
            FROM rows_ r LEFT JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source
        ),
        pool AS (
            SELECT doc_id, source, block, place, size, left_ AS gap
            FROM (SELECT *, gap - max(size) FILTER (best) OVER (PARTITION BY source) AS left_ FROM fitted)
            WHERE NOT whole AND NOT (edge AND filled <= room) AND NOT best AND size > 0 AND size <= left_
        ),
        filling AS (
            WITH RECURSIVE f AS (
                SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY block, place))::BIGINT AS upto FROM pool
                UNION ALL
                SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY block, place))::BIGINT
                FROM (SELECT doc_id, source, block, place, size, gap - spent AS gap
                      FROM (SELECT *, max(upto) FILTER (upto <= gap) OVER (PARTITION BY source) AS spent FROM f)
                      WHERE upto > gap AND size <= gap - spent)
            )
            SELECT doc_id FROM f WHERE upto <= gap
        )
        SELECT doc_id, size, source_size, target,
               (size * (passes + (whole OR (edge AND filled <= room) OR best OR doc_id IN (SELECT doc_id FROM filling))::INT))::BIGINT AS taken
        FROM fitted""",
    "op11_conversation_repair": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, _:
                CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n::BIGINT)) AS t
        ),
        damaged AS (
            SELECT conv_id, turn, damage,
                   CASE damage WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                   CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
                        ELSE coalesce(text, ' ') END AS text
            FROM (SELECT *, xor(list_reduce(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                            lambda c, x: xor(crc.t[(xor(c, ord(x)) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS damage
                  FROM conversations, crc)
        ),
        turns AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS place
            FROM (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth
                  FROM (FROM damaged WHERE damage > 0 UNION ALL FROM damaged WHERE damage = 3))
        ),
        judged AS (
            SELECT *, CASE WHEN ending = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(ending, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                   coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS odd
            FROM (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS ending FROM turns)
        ),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                   count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (odd) AS illegal,
                   list({'role': role, 'text': text, 'fault': fault} ORDER BY place) AS rows_
            FROM judged GROUP BY conv_id
        ),
        -- per state of the grammar the least (cost, audit, text): nothing yet, after s, after u, after a
        steps AS (
            SELECT conv_id, 0 AS i, {'c': 0, 'a': '', 't': ''} AS n0, {'c': 1000000, 'a': '', 't': ''} AS s0,
                   {'c': 2, 'a': 'I', 't': chr(10) || 'user:'} AS u0, {'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS a0
            FROM counted
        ),
        walked AS (
            WITH RECURSIVE w AS (
                FROM steps
                UNION ALL
                SELECT conv_id, i, n1, s1, least(u1, {'c': n1.c + 2, 'a': n1.a || 'I', 't': n1.t || chr(10) || 'user:'},
                                                     {'c': s1.c + 2, 'a': s1.a || 'I', 't': s1.t || chr(10) || 'user:'},
                                                     {'c': a1.c + 2, 'a': a1.a || 'I', 't': a1.t || chr(10) || 'user:'}),
                       least(a1, {'c': u1.c + 2, 'a': u1.a || 'I', 't': u1.t || chr(10) || 'assistant:'},
                                 {'c': n1.c + 4, 'a': n1.a || 'II', 't': n1.t || chr(10) || 'user:' || chr(10) || 'assistant:'},
                                 {'c': s1.c + 4, 'a': s1.a || 'II', 't': s1.t || chr(10) || 'user:' || chr(10) || 'assistant:'})
                FROM (
                    SELECT conv_id, i + 1 AS i, {'c': n0.c + 3, 'a': n0.a || 'D', 't': n0.t} AS n1,
                           least({'c': s0.c + 3, 'a': s0.a || 'D', 't': s0.t},
                                 {'c': n0.c + CASE WHEN left(role, 1) = 's' THEN stay ELSE 1000000 END, 'a': n0.a || 'K', 't': n0.t || as_is}) AS s1,
                           least({'c': u0.c + 3, 'a': u0.a || 'D', 't': u0.t},
                                 {'c': n0.c + as_u.c, 'a': n0.a || as_u.a, 't': n0.t || as_u.t},
                                 {'c': s0.c + as_u.c, 'a': s0.a || as_u.a, 't': s0.t || as_u.t},
                                 {'c': a0.c + as_u.c, 'a': a0.a || as_u.a, 't': a0.t || as_u.t}) AS u1,
                           least({'c': a0.c + 3, 'a': a0.a || 'D', 't': a0.t},
                                 {'c': u0.c + as_a.c, 'a': u0.a || as_a.a, 't': u0.t || as_a.t}) AS a1
                    FROM (
                        SELECT *, CASE WHEN left(role, 1) = 'u' THEN {'c': stay, 'a': 'K', 't': as_is}
                                       ELSE {'c': stay + 2, 'a': 'R', 't': chr(10) || 'user:' || text} END AS as_u,
                               CASE WHEN left(role, 1) = 'a' THEN {'c': stay, 'a': 'K', 't': as_is}
                                    ELSE {'c': stay + 2, 'a': 'R', 't': chr(10) || 'assistant:' || text} END AS as_a
                        FROM (
                            SELECT w.*, c.rows_[i + 1].role AS role, c.rows_[i + 1].text AS text, chr(10) || c.rows_[i + 1].role || ':' || c.rows_[i + 1].text AS as_is,
                                   CASE c.rows_[i + 1].fault WHEN 0 THEN 0 WHEN 3 THEN 1 ELSE 1000000 END AS stay
                            FROM w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE i < len(c.rows_)
                        )
                    )
                )
            )
            FROM w
        ),
        best AS (
            SELECT w.conv_id, least(n0, a0) AS b FROM walked w
            JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE i = len(c.rows_)
        )
        SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
               sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) d
        LEFT JOIN counted c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN best ON d.conv_id IS NOT DISTINCT FROM best.conv_id""",
    "op12_spelling_variants": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, _:
                CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n::BIGINT)) AS t
        ),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
            GROUP BY ALL
        ),
        hashed AS (
            SELECT run, n, xor(list_reduce(
                flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                        lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 | (ord(x) >> 6), 128 | (ord(x) & 63)] END)),
                lambda c, x: xor(crc.t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h
            FROM runs, crc
        ),
        words AS (
            SELECT word, sum(n)::BIGINT AS n
            FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                              ELSE run END AS word, n FROM hashed)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ),
        cut AS (
            SELECT word, n, left(word, (i - 1)::INT) AS head, substr(word, (i + 1)::INT) AS tail
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n
            FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.head || a.tail = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.head || a.tail = b.word
        ),
        judged AS (
            SELECT w.word, w.n, coalesce(m.n_near, 0) AS n_near,
                   CASE WHEN -m.best.n >= 5 * w.n THEN m.best.word END AS form, CASE WHEN -m.best.n >= 5 * w.n THEN -m.best.n END AS form_n
            FROM words w LEFT JOIN (
                SELECT word, count(*) AS n_near, min({'n': -other_n, 'word': other}) AS best FROM near GROUP BY word
            ) m ON w.word = m.word
        ),
        followed AS (
            WITH RECURSIVE f AS (
                SELECT word, word AS root, form AS next FROM judged
                UNION ALL
                SELECT f.word, f.next, j.form FROM f JOIN judged j ON f.next = j.word
            )
            SELECT word, root FROM f WHERE next IS NULL
        )
        SELECT j.word, form, root, n, n_near, form_n FROM judged j JOIN followed f ON j.word = f.word""",
}
