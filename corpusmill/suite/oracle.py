"""The same results as plain SQL over the given tables, for checking."""

_FILES = """
        WITH p AS (
          SELECT '/data/' || lower(o_orderstatus) || '/RC_' || o_orderkey ||
                 CASE o_orderkey % 5 WHEN 0 THEN '.parquet' WHEN 1 THEN '.PARQ' WHEN 2 THEN '' ELSE '.zst' END AS path,
                 CASE o_orderkey % 5 WHEN 0 THEN '.parquet' WHEN 1 THEN '.parq' WHEN 2 THEN '' ELSE '.zst' END AS ext,
                 o_custkey * 1000 + o_orderkey % 1000 AS length, o_orderdate AS modified FROM orders),
        f AS (SELECT *, split_part(path, '/', 4) AS name FROM p)"""

_HUMAN = """
               CASE WHEN {0} < 1024 THEN printf('%.2f B', {0}::DOUBLE)
                    WHEN {0} / 1024.0 < 1024 THEN printf('%.2f KB', {0}::DOUBLE / 1024)
                    WHEN {0} / 1048576.0 < 1024 THEN printf('%.2f MB', {0}::DOUBLE / 1048576)
                    WHEN {0} / 1073741824.0 < 1024 THEN printf('%.2f GB', {0}::DOUBLE / 1073741824)
                    ELSE printf('%.2f TB', {0}::DOUBLE / 1099511627776) END"""

# Orders stored as text, a file per month.
_MONTHS = """
        WITH f AS (SELECT strftime(o_orderdate, '%Y-%m') AS month,
                          CAST(sum(length(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) + 1) AS BIGINT) AS length
                   FROM orders GROUP BY 1)"""

ORACLE = {
    "jsonl_topic_filter": """
        SELECT doc_id, lower(source) AS subreddit, lang, text, n_chars, 'comments' AS _kind, '2025-01' AS _month
        FROM documents WHERE lower(source) = 'src3'""",
    "topic_by_language": """
        SELECT lang, count(*) AS records, CAST(sum(n_chars) AS BIGINT) AS chars
        FROM documents WHERE lower(source) = 'src3' GROUP BY lang""",
    "jsonl_ingest_stats": """
        WITH s AS (
          SELECT 'dump-' || lang AS path,
                 CASE WHEN doc_id % 10 = 0 THEN 'bad' WHEN doc_id % 7 = 0 THEN 'blank'
                      WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN 'bad'
                      WHEN lower(source) = 'src3' THEN 'match' ELSE 'other' END AS status
          FROM documents)
        SELECT path, count(*) AS lines_total, count(*) FILTER (status = 'bad') AS bad_json,
               CAST(0 AS BIGINT) AS too_large,
               count(*) FILTER (status = 'match') AS matched
        FROM s WHERE status <> 'blank' GROUP BY ROLLUP (path)""",
    "json_field_types": """
        SELECT event_id, '7' AS subreddit FROM events WHERE event_id % 3 <> 1""",
    "created_cast": """
        SELECT event_id,
               CASE event_id % 5 WHEN 0 THEN user_id WHEN 1 THEN CAST(trunc(value) AS BIGINT)
                                 WHEN 2 THEN user_id WHEN 4 THEN 1 END AS created_utc,
               CASE WHEN event_id % 5 = 3 THEN 'n/a' END AS _created_utc_raw
        FROM events""",
    "mixed_type_fields": """
        SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN event_type
                                           ELSE replace(props, ' ', '') END AS mixed
        FROM events""",
    "normalize_records": """
        SELECT doc_id, lower(source) AS subreddit, n_chars AS created_utc, '<' || lang || '>' AS title, true AS dropped
        FROM documents""",
    "id_keyed_objects": """
        SELECT event_id, CAST(event_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS "user", replace(props, ' ', '') AS props,
               CAST(7 AS BIGINT) AS columns FROM events""",
    "open_object_keys": """
        WITH k AS (
            SELECT '$' AS path, unnest(['status', 'by_order', 'meta']) AS key FROM orders
            UNION ALL SELECT '$.by_order', CAST(o_orderkey AS VARCHAR) FROM orders
            UNION ALL SELECT '$.meta', unnest(['by_day', 'list']) FROM orders
            UNION ALL SELECT '$.meta.by_day', strftime(o_orderdate, '%a') FROM orders
            UNION ALL SELECT '$.meta.list[]', left(o_orderpriority, 1) FROM orders)
        SELECT path, min(key) AS first_key, max(key) AS last_key, count(DISTINCT key) > 100 AS is_open FROM k GROUP BY path""",
    "column_types": """
        SELECT CAST(ordinal_position - 1 AS INTEGER) AS ordinal, column_name AS "column",
               CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS type
        FROM information_schema.columns WHERE table_name = 'lineitem'""",
    "unknown_column": """
        SELECT count(event_id) AS rows, 'the view has no column ' || chr(39) || 'no_such' || chr(39) AS error FROM events""",
    "iso_now": "SELECT event_id, true AS iso FROM events",
    "sample_rows": """
        SELECT * FROM orders ORDER BY md5(o_orderkey || '|7') LIMIT 50""",
    "sample_column": """
        SELECT value FROM events WHERE event_id % 50 <> 0 AND event_id % 7 <> 0 ORDER BY md5(event_id || '|7') LIMIT 50""",
    "sample_all_columns": """
        WITH v AS (
          SELECT event_id, unnest(['event_id', 'event_type', 'value', 'users', 'nothing']) AS "column",
                 unnest([CAST(event_id AS VARCHAR), nullif(event_type, 'error'),
                         CASE WHEN event_id % 50 <> 0 AND event_id % 7 <> 0 THEN CAST(value AS VARCHAR) END,
                         CASE WHEN event_id % 3 = 0 THEN '[' || user_id || ']' END, NULL]) AS value
          FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value IS NULL, md5(event_id || '|' || "column" || '|7')) AS place FROM v)
        SELECT "column", value FROM r WHERE place <= 3 AND (value IS NOT NULL OR ("column" = 'nothing' AND place = 1))""",
    "sample_one_per_column": """
        WITH v AS (
          SELECT o_orderkey, unnest(['o_orderkey', 'o_custkey', 'o_orderpriority']) AS "column",
                 unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority]) AS value FROM orders)
        SELECT "column", value FROM v
        QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY md5(o_orderkey || '|' || "column" || '|7')) = 1""",
    "html_unescape": """
        SELECT page_id,
               replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS html
        FROM pages""",
    "kind_month_from_name": """
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'comments' WHEN 1 THEN 'submissions' END AS kind,
               CASE WHEN o_orderkey % 4 < 2 THEN strftime(o_orderdate, '%Y-%m') END AS month
        FROM orders""",
    "provenance_columns": """
        SELECT o_orderkey,
               '/dumps/' || CASE o_orderkey % 4 WHEN 0 THEN 'RC_' || strftime(o_orderdate, '%Y-%m') || '.zst'
                                  WHEN 1 THEN 'rs_' || strftime(o_orderdate, '%Y-%m') || '_part.jsonl'
                                  WHEN 2 THEN 'x_RC_' || strftime(o_orderdate, '%Y-%m') || '.zst'
                                  ELSE 'RC-' || strftime(o_orderdate, '%Y-%m') || '.gz' END AS _source_path,
               CASE o_orderkey % 4 WHEN 0 THEN 'comments' WHEN 1 THEN 'submissions' END AS _kind,
               CASE WHEN o_orderkey % 4 < 2 THEN strftime(o_orderdate, '%Y-%m') END AS _month
        FROM orders""",
    "sanitize_nested": """
        SELECT event_id,
               event_id % 2 <> 0 AND event_id % 3 <> 0 AS s_null,
               CASE WHEN event_id % 2 = 0 THEN user_id END AS s_a,
               event_id % 3 <> 0 AS inner_null,
               CASE WHEN event_id % 3 = 0 THEN value END AS inner_x,
               CAST(CASE event_id % 5 WHEN 0 THEN -1 WHEN 1 THEN -1 WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS list_size,
               CASE WHEN event_id % 5 > 1 THEN user_id END AS list_last,
               event_id % 2 <> 0 AND event_id % 3 <> 0 AS structs_null,
               event_id % 2 <> 0 AS first_null,
               CAST(4 AS BIGINT) AS columns
        FROM events""",
    "drop_all_null_fields": """
        SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS click_value FROM events""",
    "nested_to_json": """
        SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS kind,
               event_id AS first_id, event_type AS raw, true AS keeps_null_fields
        FROM events""",
    "align_schema": """
        SELECT o_orderstatus, CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(NULL AS DOUBLE) AS extra,
               CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
               CASE WHEN o_custkey BETWEEN -128 AND 127 THEN CAST(o_custkey AS TINYINT) END AS o_custkey,
               CAST(NULL AS INTEGER) AS o_orderpriority
        FROM orders""",
    "union_by_name_widen": """
        SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment FROM customer
        UNION ALL BY NAME
        SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, s_nationkey FROM supplier""",
    "union_files_by_name": """
        SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier UNION ALL BY NAME SELECT * FROM nation""",
    "union_type_conflict": """
        SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS v, CAST(NULL AS VARCHAR) AS w FROM orders
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN round(o_totalprice, 2) END, o_orderstatus FROM orders
        UNION ALL
        SELECT o_orderkey, NULL, o_orderstatus FROM orders""",
    "union_schema_types": """
        SELECT DISTINCT column_name AS "column",
               CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                              WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>'
                              WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS type
        FROM information_schema.columns
        WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events',
                             'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')""",
    "merge_parquet_folder": """
        SELECT event_id, event_type, CAST(user_id AS DOUBLE) AS user_id FROM events
        UNION ALL BY NAME SELECT event_id, value, CAST(user_id AS DOUBLE) AS user_id FROM events
        UNION ALL BY NAME SELECT event_type AS extra, event_id + 0.5 AS user_id FROM events""",
    "filter_expression": """
        SELECT event_id, ts, user_id, event_type, value FROM events WHERE value > 100 AND event_type = 'click'""",
    "not_equal_keep_missing": """
        SELECT event_id, nullif(event_type, 'error') AS event_type FROM events
        WHERE nullif(event_type, 'error') IS DISTINCT FROM 'click'""",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "shape": "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS cols FROM lineitem",
    "column_profile": """
        WITH e AS (
          SELECT count(*) AS n, count(*) FILTER (event_type <> 'error') AS kinds,
                 count(*) FILTER (event_id % 50 <> 0 AND event_id % 7 <> 0) AS vals,
                 count(*) FILTER (event_id % 3 = 0) AS users FROM events)
        SELECT 0 AS ordinal, 'event_id' AS "column", 'bigint' AS type, n AS non_null, CAST(0 AS BIGINT) AS nulls FROM e
        UNION ALL SELECT 1, 'event_type', 'string', kinds, n - kinds FROM e
        UNION ALL SELECT 2, 'value', 'double', vals, n - vals FROM e
        UNION ALL SELECT 3, 'users', 'array<bigint>', users, n - users FROM e
        UNION ALL SELECT 4, 'nothing', 'string', 0, n FROM e""",
    "info_summary": """
        WITH c AS (SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice',
                                  'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate']) AS "column",
                          unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS ordinal),
             n AS (SELECT count(*) AS rows FROM lineitem)
        SELECT ordinal, "column", rows AS non_null, CAST(0 AS BIGINT) AS nulls, rows, CAST(11 AS BIGINT) AS cols FROM c, n""",
    "min_max": """
        SELECT 'value' AS "column", min(value) AS min, max(value) AS max FROM events
        WHERE event_id % 50 <> 0 AND event_id % 7 <> 0""",
    "min_max_all_missing": """
        SELECT 'nothing' AS "column", min(nullif(event_type, lower(event_type))) AS min, max(nullif(event_type, lower(event_type))) AS max
        FROM events""",
    "value_counts": """
        SELECT nullif(event_type, 'error') AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 20""",
    "value_counts_topk": """
        SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 25""",
    "frequent_values": """
        SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 25""",
    "value_counts_nan": """
        SELECT CASE WHEN event_id % 50 <> 0 AND event_id % 7 <> 0 THEN value END AS value, count(*) AS n
        FROM events GROUP BY 1 ORDER BY n DESC, value NULLS LAST LIMIT 30""",
    "null_fractions": """
        WITH f AS (SELECT avg(CASE WHEN l.doc_id IS NULL THEN 1.0 ELSE 0.0 END) AS p
                   FROM documents d LEFT JOIN labels l USING (doc_id))
        SELECT 'nan' AS "column", 1.0::DOUBLE AS null_fraction, '100.00%' AS null_percent
        UNION ALL SELECT 'quality', round(p, 9), printf('%.2f', p * 100) || '%' FROM f
        UNION ALL SELECT 'toxic', round(p, 9), printf('%.2f', p * 100) || '%' FROM f""",
    "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 25",
    "tail_rows": "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 25",
    "head_by_key": "SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 40",
    "tail_filtered": "SELECT * FROM events WHERE event_type = 'click' ORDER BY event_id DESC LIMIT 40",
    "sample_checks": """
        SELECT least(count(*), 100) AS n, least(count(DISTINCT o_orderkey), 100) AS distinct_keys FROM orders""",
    "sample_column_checks": """
        SELECT least(count(*), 50) AS n, CAST(0 AS BIGINT) AS differing FROM events
        WHERE event_id % 50 <> 0 AND event_id % 7 <> 0""",
    "sample_all_columns_checks": """
        SELECT 'event_id' AS "column", least(count(*), 3) AS n FROM events
        UNION ALL SELECT 'event_type', least(count(*), 3) FROM events WHERE event_type <> 'error'
        UNION ALL SELECT 'value', least(count(*), 3) FROM events WHERE event_id % 50 <> 0 AND event_id % 7 <> 0
        UNION ALL SELECT 'users', least(count(*), 3) FROM events WHERE event_id % 3 = 0
        UNION ALL SELECT 'nothing', 0""",
    "human_sizes": """
        WITH o AS (SELECT o_orderkey, CAST(trunc(o_totalprice * pow(10.0, o_orderkey % 9)) AS BIGINT) AS bytes FROM orders)
        SELECT o_orderkey, bytes,
               CASE WHEN bytes < 1024 THEN printf('%.2f B', bytes::DOUBLE)
                    WHEN bytes / 1024.0 < 1024 THEN printf('%.2f KB', bytes::DOUBLE / 1024)
                    WHEN bytes / 1048576.0 < 1024 THEN printf('%.2f MB', bytes::DOUBLE / 1048576)
                    WHEN bytes / 1073741824.0 < 1024 THEN printf('%.2f GB', bytes::DOUBLE / 1073741824)
                    ELSE printf('%.2f TB', bytes::DOUBLE / 1099511627776) END AS size
        FROM o""",
    "iso_times": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts FROM events",
    "path_parts": """
        SELECT p_partkey, p_brand || '.' || upper(p_type) AS name, '.' || lower(p_type) AS ext,
               'set.' || p_size || '/' || p_brand || '.' || upper(p_type) AS below,
               '/data/set.' || p_size || '/' || p_brand || '.' || upper(p_type) AS path
        FROM part""",
    "blank_text": """
        SELECT turn, count(*) FILTER (turn < 2 OR text = '') AS blank, count(*) AS n FROM conversations GROUP BY turn""",
    "file_inventory": """
        SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY ALL""",
    "largest_of_listing": _FILES + """
        SELECT substr(path, 7) AS file, length, """ + _HUMAN.format("length") + """ AS size FROM f ORDER BY length DESC, path LIMIT 10""",
    "extensions_of_listing": _FILES + """
        SELECT CASE WHEN ext = '' THEN '[no ext]' ELSE ext END AS ext, count(*) AS files FROM f GROUP BY ALL""",
    "sizes_of_listing": _FILES + """,
        s AS (SELECT count(*) AS file_count, CAST(sum(length) AS BIGINT) AS total_bytes, min(length) AS size_min_bytes,
                     percentile_disc(0.5) WITHIN GROUP (ORDER BY length DESC) AS size_median_bytes,
                     CAST(sum(length) // count(*) AS BIGINT) AS size_avg_bytes, max(length) AS size_max_bytes,
                     strftime(min(modified), '%Y-%m-%dT%H:%M:%S') AS mtime_earliest,
                     strftime(max(modified), '%Y-%m-%dT%H:%M:%S') AS mtime_latest FROM f)
        SELECT *, """ + ", ".join(
        _HUMAN.format(f"{n}_bytes") + f" AS {n}_human" for n in ("total", "size_min", "size_median", "size_avg", "size_max")
    ) + " FROM s",
    "ordered_files": _FILES + """
        SELECT path, CAST(row_number() OVER (ORDER BY name, path) AS INTEGER) AS place
        FROM f WHERE name NOT IN ('RC_4', 'RC_5.parquet')""",
    "largest_files": _MONTHS + """
        SELECT month, length, """ + _HUMAN.format("length") + """ AS size FROM f ORDER BY length DESC, month LIMIT 10""",
    "extension_counts": _FILES + """,
        m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders)
        SELECT CASE WHEN ext = '' THEN '[no ext]' ELSE ext END AS ext, count(*) AS files
        FROM (SELECT ext FROM f UNION ALL SELECT '.txt' FROM m) GROUP BY ALL""",
    "file_size_stats": _MONTHS + """,
        s AS (SELECT count(*) AS file_count, CAST(sum(length) AS BIGINT) AS total_bytes, min(length) AS size_min_bytes,
                     percentile_disc(0.5) WITHIN GROUP (ORDER BY length DESC) AS size_median_bytes,
                     CAST(sum(length) // count(*) AS BIGINT) AS size_avg_bytes, max(length) AS size_max_bytes, true AS in_order FROM f)
        SELECT *, """ + ", ".join(
        _HUMAN.format(f"{n}_bytes") + f" AS {n}_human" for n in ("total", "size_min", "size_median", "size_avg", "size_max")
    ) + " FROM s",
    "row_groups": """
        SELECT CAST(sum(ceil(n / 50000.0)) AS BIGINT) AS total_row_groups, CAST(sum(ceil(n / 50000.0)) AS BIGINT) AS files_counted,
               CAST(0 AS BIGINT) AS files_unreadable, CAST(sum(n) AS BIGINT) AS total_rows
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
    "most_row_groups": """
        SELECT o_orderpriority, o_orderstatus, CAST(ceil(count(*) / 100.0) AS INTEGER) AS num_row_groups, count(*) AS num_rows
        FROM orders GROUP BY ALL""",
    "row_groups_of_listing": """
        SELECT CAST(sum(p_size) FILTER (p_size % 9 <> 0) AS BIGINT) AS total_row_groups,
               count(*) FILTER (p_size % 9 <> 0) AS files_counted, count(*) FILTER (p_size % 9 = 0) AS files_unreadable,
               CAST(sum(p_partkey * 10) FILTER (p_size % 9 <> 0) AS BIGINT) AS total_rows,
               CAST(sum(p_partkey * p_size) FILTER (p_size % 9 <> 0) AS BIGINT) AS total_byte_size
        FROM part""",
    "most_row_groups_of_listing": """
        SELECT p_partkey || '.parquet' AS file, p_size AS num_row_groups, p_partkey * 10 AS num_rows, p_partkey * p_size AS total_byte_size
        FROM part WHERE p_size % 9 <> 0 ORDER BY p_size DESC, 'file:/data/' || p_partkey || '.parquet' LIMIT 10""",
    "stored_row_groups": """
        SELECT CAST(sum(ceil(n / 1000.0)) AS BIGINT) AS total_row_groups, CAST(0 AS BIGINT) AS files_unreadable,
               CAST(sum(n) AS BIGINT) AS total_rows FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus)""",
    "corpus_meta": """
        SELECT true AS is_directory, CAST(sum(n) AS BIGINT) AS rows, CAST(11 AS BIGINT) AS cols,
               CAST(sum(ceil(n / 50000.0)) AS BIGINT) AS files, CAST(sum(ceil(n / 50000.0)) AS BIGINT) AS file_count
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
    "csv_first_rows": """
        SELECT o_orderkey, o_custkey, o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS INTEGER) AS place
        FROM orders QUALIFY place <= 70""",
    "decode_cut_files": """
        SELECT codec, part, count(*) > 0 AS reported, true AS from_start, CAST(0 AS BIGINT) AS torn
        FROM orders, (SELECT unnest(['gz', 'bz2', 'xz', 'zst']) AS codec), (SELECT unnest(['all', 'few']) AS part) GROUP BY codec, part""",
    "union_lattice": """
        SELECT t.*, CASE WHEN t."column" = 'all_null' THEN 0 ELSE 2 * n END AS n FROM (SELECT count(*) AS n FROM orders), (VALUES
          ('mixed_sign', 'double', 'double'), ('widest', 'bigint', 'bigint'), ('one_zone', 'timestamp', 'timestamp'),
          ('two_zones', 'string', 'double'), ('text_and_date', 'string', 'string'), ('all_binary', 'binary', 'binary'),
          ('all_null', 'string', 'string'), ('no_rule', 'string', 'double')) t("column", type, fallback)""",
    "csv_roundtrip": "SELECT * FROM documents",
    "parquet_roundtrip": """
        SELECT codec, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, max(o_orderdate) AS latest
        FROM orders, (SELECT unnest(['zstd', 'snappy', 'gzip', 'lz4', 'none']) AS codec) GROUP BY codec""",
    "decode_codecs": """
        SELECT codec, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, round(sum(c_acctbal), 2) AS balance,
               count(*) FILTER (c_custkey % 10 = 0) AS replaced
        FROM customer, (SELECT unnest(['plain', 'gz', 'bz2', 'xz', 'zst', 'zst_long', 'zst_joined', 'mislabelled']) AS codec)
        GROUP BY codec""",
    "build_topic_table": """
        SELECT doc_id, lower(source) AS subreddit, lang, text, n_chars FROM documents WHERE lower(source) = 'src3'""",
    "build_topic_aligned": """
        SELECT text, CAST(n_chars AS INTEGER) AS n_chars, doc_id, CAST(NULL AS VARCHAR) AS absent
        FROM documents WHERE lower(source) = 'src5'""",
    "build_topic_report": """
        WITH m AS (SELECT count(*) AS n, count(*) FILTER (lower(source) = 'src3') AS hits FROM documents)
        SELECT 'config' AS event, 'src3' AS topic, NULL::BIGINT AS file_rows, NULL::BIGINT AS lines_total, NULL::BIGINT AS bad_json,
               NULL::BIGINT AS matched, NULL::BIGINT AS rows_written
        UNION ALL SELECT 'file', NULL, hits, n, 0, hits, NULL FROM m
        UNION ALL SELECT 'finish', NULL, NULL, NULL, NULL, NULL, hits FROM m""",
}
