"""The same results in plain SQL over the same tables, to check the queries by."""

from __future__ import annotations

import re

# Stand-in tables, in order of use.
VIEWS: dict[str, str] = {
    "v_findings": """
        SELECT o_orderkey AS order_key, coalesce(l.labels, 'No Finding') AS finding_labels,
               o_totalprice AS total, o_orderpriority AS priority
        FROM orders LEFT JOIN (
            SELECT l_orderkey, string_agg(p_type, '|' ORDER BY p_type) AS labels
            FROM (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey)
            GROUP BY l_orderkey) l ON l_orderkey = o_orderkey""",
    "v_labels": """
        SELECT order_key, string_split(finding_labels, '|') AS labels, finding_labels, total FROM v_findings""",
    "v_split_list": """
        SELECT o_orderkey AS id,
               CASE WHEN ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 100 < 80
                    THEN 'train' ELSE 'test' END AS part
        FROM orders""",
    "v_split_column": """
        SELECT *, 'files/' || order_key || '.png' AS image_files,
               CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'validate' ELSE 'test' END AS split
        FROM (SELECT *, ('0x' || substr(md5('42|' || order_key), 1, 8))::BIGINT % 100 AS b FROM v_findings)""",
    "v_samples": """
        SELECT o_orderkey AS key, 'scans/' || o_orderkey || '.png' AS image_files,
               CASE WHEN o_totalprice < 50000 THEN 1 WHEN o_totalprice < 120000 THEN 2 ELSE 0 END AS labels
        FROM orders""",
    "v_split_samples": """
        SELECT key, image_files, labels,
               CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, ('0x' || substr(md5('42|' || key), 1, 8))::BIGINT % 100 AS b FROM v_samples)""",
    "v_scans": """
        SELECT page_id, path, split_part(path, '/', 3) AS class, split_part(path, '/', -1) AS name
        FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(
                url, '[?#].*$', ''), '/+$', ''), '^https?://', '/') AS path FROM pages)""",
    "v_tree": """
        SELECT class, place, (CASE WHEN place < 20 THEN '_' WHEN place < 40 THEN '.' ELSE '' END)
                   || replace(substr(path, 2), '/', '-') AS name
        FROM (SELECT DISTINCT class, path, ('0x' || substr(md5('42|' || path), 1, 8))::BIGINT % 100 AS place FROM v_scans)""",
    "v_class_dirs": """
        SELECT page_id, path AS image_files, split_part(path, '/', -2) AS class_name,
               (dense_rank() OVER (ORDER BY split_part(path, '/', -2)) - 1)::INT AS labels
        FROM v_scans""",
    "v_page_samples": """
        SELECT image_files, labels,
               CASE WHEN ('0x' || substr(md5('42|' || image_files), 1, 8))::BIGINT % 100 < 80
                    THEN 'train' ELSE 'test' END AS split
        FROM v_class_dirs""",
    "v_patients": """
        SELECT (c_custkey * 2)::INT AS id,
               CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'unknown'
                    ELSE c_nationkey || '.7' END AS target
        FROM customer""",
    "v_lookup": """
        SELECT s.patient, s.filename, trunc(try_cast(p.target AS DOUBLE))::INT AS target, s.scans,
               CASE WHEN s.patient IS NULL THEN 'bad_id' WHEN p.id IS NULL THEN 'missing'
                    WHEN try_cast(p.target AS DOUBLE) IS NULL THEN 'bad_target' ELSE 'ok' END AS status
        FROM (SELECT patient, split_part(max(path), '/', -1) AS filename, count(*) AS scans
              FROM (SELECT path, try_cast(right(split_part(split_part(name, '.', 1), '-', 1), 3) AS INTEGER) AS patient
                    FROM v_scans) GROUP BY patient) s
        LEFT JOIN v_patients p ON p.id = s.patient""",
    "v_pred2": """
        SELECT doc_id, quality AS y_true, (n_chars > 1000)::INT AS y_pred, n_chars::DOUBLE AS score
        FROM labels JOIN documents USING (doc_id)""",
    "v_pred10": """
        SELECT vec_id, label AS y_true, list_transform(embedding, lambda x: x::DOUBLE) AS logits,
               list_position(embedding, list_max(embedding)) - 1 AS y_pred
        FROM embeddings""",
    "v_pred_gaps": """
        SELECT vec_id, embedding AS logits, CASE vec_id % 10 WHEN 3 THEN NULL WHEN 4 THEN label + 100 WHEN 5 THEN -2 ELSE label END AS y_true,
               CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 2 = 0 THEN label ELSE 1 END AS y_pred
        FROM embeddings""",
    "v_pred_lines": """
        SELECT l_orderkey, l_linenumber, (l_returnflag = 'R')::INT AS y_true, (l_quantity > 25)::INT AS y_pred,
               l_extendedprice AS score, [0::DOUBLE, (l_quantity - 25) / 10] AS logits,
               l_linestatus AS split, l_linenumber AS epoch
        FROM lineitem""",
    "v_metric_log": """
        SELECT user_id AS run_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::INT AS epoch,
               CASE WHEN event_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, event_type AS metric, value
        FROM events""",
    "v_params": """
        SELECT c_custkey AS run_id, unnest([
            {'s': 1, 'k': '_target_',
             'v': 'models.' || upper(c_mktsegment[1]) || lower(substr(c_mktsegment, 2)) || 'Net'},
            {'s': 1, 'k': 'optimizer', 'v': 'torch.optim.Adam'},
            {'s': 1, 'k': 'criterion', 'v': 'torch.nn.CrossEntropyLoss'},
            {'s': 1, 'k': 'lr', 'v': '0.00' || (c_nationkey + 1)},
            {'s': 1, 'k': 'mode', 'v': ['train', 'evaluate', 'diffusion'][c_custkey % 3 + 1]},
            {'s': 1, 'k': 'type', 'v': ['train', 'eval', 'diff'][c_custkey % 3 + 1]},
            {'s': 1, 'k': 'use_sampling', 'v': CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END},
            {'s': 1, 'k': 'sampling_method', 'v': 'resample'},
            {'s': 1, 'k': 'sample_to_value', 'v': '3500'},
            {'s': 1, 'k': 'random_state', 'v': (c_custkey % 1000)::VARCHAR},
            {'s': 1, 'k': 'date', 'v': '2024-01-01'},
            {'s': 1, 'k': 'timestamp', 'v': '00-00-00'},
            {'s': 1, 'k': 'postfix', 'v': lower(c_mktsegment)},
            {'s': 2, 'k': 'lr', 'v': CASE WHEN c_custkey % 5 = 0 THEN '0.1' ELSE '0.00' || (c_nationkey + 1) END},
            {'s': 2, 'k': 'pretrained_model', 'v': 'run-' || c_custkey}], recursive := true)
        FROM customer""",
    "v_merged": """
        SELECT run_id, k, arg_max(v, s) AS v FROM v_params GROUP BY run_id, k""",
    "v_lists": """
        SELECT id AS order_key, list_sort(list(DISTINCT part)) AS parts FROM v_split_list GROUP BY id""",
}

SEEDED = "row_number() OVER (PARTITION BY {by} ORDER BY md5('{seed}|' || {key}), {key})"


def seeded(key: str, by: str = "1", seed: int = 42) -> str:
    return SEEDED.format(key=key, by=by, seed=seed)


def quotas(source: str, label: str, seed_name: str = "q", size: str = "0.1") -> str:
    """Test quota per class: the rest left by the rounded train shares."""
    return f"""
        {seed_name}_n AS (SELECT {label} AS c, count(*) AS n FROM {source} GROUP BY 1),
        {seed_name}_t AS (SELECT c, n, sum(n) OVER () AS total,
            (sum(n) OVER () - ceil({size}::DOUBLE * sum(n) OVER ()))::BIGINT AS train FROM {seed_name}_n),
        {seed_name}_w AS (SELECT c, n, train, (n::HUGEINT * train) // total::HUGEINT AS whole,
            (n::HUGEINT * train) % total::HUGEINT AS frac FROM {seed_name}_t),
        {seed_name} AS (SELECT c, n, n - whole - CASE WHEN row_number() OVER (ORDER BY frac DESC, c)
            <= train - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM {seed_name}_w)"""


def report(source: str, rows: str, shown: str) -> str:
    """Classification report over ``rows`` (label set) of a prediction source."""
    return f"""
        m_c AS (SELECT y_true, y_pred, count(*) AS n FROM {source} GROUP BY 1, 2),
        m_l AS ({rows}),
        m_k AS (SELECT l.label, l.shown,
            coalesce((SELECT sum(n) FROM m_c WHERE y_true = l.label AND y_pred = l.label), 0)::DOUBLE AS hits,
            coalesce((SELECT sum(n) FROM m_c WHERE y_true = l.label), 0)::DOUBLE AS support,
            coalesce((SELECT sum(n) FROM m_c WHERE y_pred = l.label), 0)::DOUBLE AS predicted FROM m_l l),
        m_s AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
            CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
            CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f1 FROM m_k),
        m_r AS (
            SELECT shown AS label, precision, recall, f1, support FROM m_s
            UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support),
                sum(hits) / sum(support), sum(support) FROM m_s
            UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m_s
            UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM m_s)"""


def auc(source: str, score: str) -> str:
    return f"""
        a_s AS (SELECT {score} AS s, count(*) FILTER (y_true = 1) AS p, count(*) FILTER (y_true <> 1) AS n
                FROM {source} GROUP BY 1),
        a_b AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
                FROM a_s),
        a AS (SELECT sum(p * (b::DOUBLE + n / 2.0)) / (sum(p)::DOUBLE * sum(n)::DOUBLE) AS roc_auc FROM a_b)"""


LOSS = "ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits))))) + list_max(logits) - logits[y_true + 1]"
PRESENT = "SELECT DISTINCT label, label::VARCHAR AS shown FROM (SELECT y_true AS label FROM m_c UNION ALL SELECT y_pred FROM m_c)"
IS_POSITIVE = "list_contains(labels, 'PROMO')"

# Each entry: further WITH parts (may be empty) and the closing SELECT.
ORACLES: dict[str, tuple[str, str]] = {}


def oracle(name: str, select: str, *parts: str) -> None:
    ORACLES[name] = (",".join(parts), select)


# --- sources and sinks ---
oracle("scan_metadata_csv", "SELECT * FROM v_findings")
oracle("versioned_cache", "SELECT * FROM v_samples")
oracle("scan_id_list", "SELECT id::VARCHAR AS id FROM v_split_list")
oracle("scan_class_dirs", """SELECT class || '/' || name AS image_files, class AS class_name,
        (dense_rank() OVER (ORDER BY class) - 1)::INT AS labels FROM v_tree""")
oracle("scan_shards", """SELECT name, printf('images_%03d/images/', (place % 13 + 1)::INT) || name AS image_files
    FROM v_tree WHERE place % 13 < 12""")
oracle("scan_flat_dir", "SELECT name, name AS path FROM v_tree")
oracle("scan_generated", "SELECT '/generated/' || name AS image_files, 1 AS labels FROM v_tree")
COLUMN_COHORT = """SELECT order_key, '/scans/' || image_files AS image_files, finding_labels AS labels,
    CASE split WHEN 'validate' THEN 'val' ELSE split END AS split FROM v_split_column"""
oracle("write_cohort", COLUMN_COHORT)
oracle("write_eval", """SELECT 'test' AS split, 3 AS epoch, y_true, y_pred, count(*) AS n, count(*) AS rows
    FROM v_pred_lines GROUP BY y_true, y_pred""")
oracle(
    "write_eval_epochs",
    """SELECT split, epoch, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        support::BIGINT AS support FROM (
        SELECT split, epoch, label::VARCHAR AS label, precision, recall, f1, support FROM h_s
        UNION ALL SELECT split, epoch, 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support),
            sum(hits) / sum(support), sum(support) FROM h_s GROUP BY 1, 2
        UNION ALL SELECT split, epoch, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM h_s GROUP BY 1, 2
        UNION ALL SELECT split, epoch, 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM h_s GROUP BY 1, 2)""",
    """h_k AS (SELECT split, epoch, label, count(*) FILTER (y_true = label AND y_pred = label)::DOUBLE AS hits,
        count(*) FILTER (y_true = label) AS support, count(*) FILTER (y_pred = label) AS predicted
        FROM v_pred_lines CROSS JOIN (VALUES (0), (1)) l(label) GROUP BY 1, 2, 3)""",
    """h_s AS (SELECT *, hits / predicted AS precision, hits / support AS recall,
        2 * hits / (predicted + support) AS f1 FROM h_k)""",
)
oracle(
    "run_report",
    """SELECT section, line_no::INT AS line_no, line FROM (
        SELECT 1 AS section, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM (SELECT [
            '# Run summary', '', '## Test results', '### Evaluation metrics',
            '| model_name | roc_auc | accuracy | loss | precision | recall | f1-score |',
            '| --- | --- | --- | --- | --- | --- | --- |',
            printf('| densenet | %.6f | %.6f | %.6f | %.6f | %.6f | %.6f |', a.roc_auc, acc.precision, loss.loss,
                   mac.precision, mac.recall, mac.f1), ''] AS l
            FROM a, (SELECT * FROM m_r WHERE label = 'accuracy') acc, (SELECT * FROM m_r WHERE label = 'macro avg') mac, loss)
        UNION ALL
        SELECT 2, generate_subscripts(l, 1) - 1, unnest(l) FROM (SELECT [
            '### Confusion matrix',
            '|  | ' || (SELECT string_agg(label, ' | ' ORDER BY label) FROM m_l) || ' |',
            '| --- |' || (SELECT repeat(' --- |', count(*)) FROM m_l)]
            || (SELECT list('| ' || y || ' | ' || cells || ' |' ORDER BY y) FROM (
                SELECT t.label AS y, string_agg(coalesce(n, 0), ' | ' ORDER BY p.label) AS cells
                FROM m_l t CROSS JOIN m_l p LEFT JOIN m_c ON y_true = t.label AND y_pred = p.label GROUP BY t.label)) || [''] AS l)
        UNION ALL
        SELECT 3, generate_subscripts(l, 1) - 1, unnest(l) FROM (SELECT
            ['## `config.yaml`', '```yaml', '# --config-name=config', ''] || list(e ORDER BY e) || ['```'] AS l
            FROM (SELECT n_name || ': ' || n_regionkey AS e FROM nation)))""",
    report("v_pred_lines", PRESENT, "shown"),
    auc("v_pred_lines", "y_pred"),
    f"loss AS (SELECT avg({LOSS}) AS loss FROM v_pred_lines)",
)
oracle("materialize", "SELECT * FROM v_findings")
oracle("metric_log", """SELECT run_id, epoch, split, split || '_' || metric AS metric, value FROM v_metric_log
    WHERE metric <> 'signup'""")
POSITIONS = """CASE WHEN split = 'test' THEN row_number() OVER (PARTITION BY split ORDER BY {0})
    ELSE row_number() OVER (PARTITION BY split ORDER BY md5('42|' || {0}), {0}) END"""
oracle("batch_export", f"""SELECT key, labels, split, position, (position - 1) // 64 AS batch_id
    FROM (SELECT *, {POSITIONS.format('key')} AS position FROM v_split_samples)""")

# --- projections and filters ---
oracle("path_join", """SELECT page_id, '/data/scans/' || name AS plain, '/data/scans/' || name AS closed,
    name AS no_base, path AS absolute FROM v_scans""")
oracle("sample_pair", "SELECT image_files, finding_labels AS labels FROM v_split_column")
oracle("drop_columns", "SELECT order_key, finding_labels FROM v_findings")
oracle("subset_to_class", "SELECT * FROM v_samples WHERE labels IN (1, 2)")
oracle("create_subset", "SELECT * FROM v_findings WHERE contains(finding_labels, 'PROMO') OR contains(finding_labels, 'ECO')")
oracle("filter_paths", """SELECT page_id, path, class FROM v_scans
    WHERE length(name) >= 3 AND NOT contains(path, '.html') AND NOT contains(path, 'spam-')""")
oracle("positives_only", "SELECT * FROM v_findings WHERE list_contains(string_split(finding_labels, '|'), 'PROMO')")
oracle("preprocess_dataset", "SELECT image_files, labels FROM v_samples WHERE labels IN (0, 2)")
oracle("split_by_column", "SELECT order_key, CASE split WHEN 'validate' THEN 'val' ELSE split END AS split FROM v_split_column")
oracle("threshold_counts", """SELECT count(*) AS n, count(*) FILTER (total < 18000) AS below_18000,
    count(*) FILTER (total < 210000) AS below_210000 FROM v_findings WHERE contains(finding_labels, 'PROMO')""")
oracle("restrict_to_subset", """SELECT order_key, array_to_string(labels, ',') AS labels FROM v_labels
    WHERE len(list_filter(labels, lambda x: x NOT IN ('PROMO', 'SMALL', 'LARGE'))) = 0""")
oracle("drop_nulls", "SELECT * FROM v_patients WHERE target IS NOT NULL")
oracle("safe_int_target", """SELECT id, trunc(try_cast(target AS DOUBLE))::INT AS code FROM v_patients
    WHERE try_cast(target AS DOUBLE) IS NOT NULL""")
oracle("metaclass", """SELECT order_key, CASE WHEN contains(finding_labels, 'PROMO') THEN 'PROMO' ELSE 'Non-PROMO' END
    AS finding_labels, finding_labels AS old_finding_labels FROM v_findings""")
oracle("label_any", f"SELECT order_key, {IS_POSITIVE}::INT AS label FROM v_labels")
oracle("label_exclusive", f"""SELECT order_key, {IS_POSITIVE}::INT AS label FROM v_labels
    WHERE NOT ({IS_POSITIVE} AND len(labels) > 1)""")
oracle("params_clean", """SELECT run_id, string_agg(k || '=' || v, ',' ORDER BY k || '=' || v) AS params FROM v_params p
    WHERE s = 1 AND k <> '_target_' AND NOT (k = 'sampling_method' AND run_id % 2 = 1) GROUP BY run_id""")
oracle("every_k", "SELECT * FROM v_metric_log WHERE epoch % 5 = 0")

# --- joins ---
oracle("join_scans", """SELECT order_key, finding_labels, l_linenumber, l_partkey
    FROM v_findings JOIN lineitem ON l_orderkey = order_key""")
oracle("split_by_list", """SELECT order_key, finding_labels, part AS split FROM v_findings
    JOIN v_split_list ON id = order_key""")
PROMO_KEYS = "SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO'"
oracle("anti_rows", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN ({PROMO_KEYS})")
oracle("select_keys", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN ({PROMO_KEYS})")
oracle("missing_keys", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
oracle("bind_columns", """SELECT doc_id, lang, n_chars, quality, toxic FROM documents FULL JOIN labels USING (doc_id)""")
oracle("patient_lookup", "SELECT patient, filename, target, scans, status FROM v_lookup")
oracle("decode_labels", """SELECT key, labels, CASE labels WHEN 1 THEN 'small' WHEN 2 THEN 'medium' END AS name
    FROM v_samples""")

# --- aggregations ---
oracle("value_counts", "SELECT finding_labels, count(*) AS n FROM v_findings GROUP BY 1")
oracle("target_counts", "SELECT label, count(*) AS n FROM (SELECT unnest(labels) AS label FROM v_labels) GROUP BY 1")
oracle("n_unique", "SELECT count(DISTINCT finding_labels) AS n_unique FROM v_findings")
CLASSES = "SELECT DISTINCT p_type AS label FROM part UNION SELECT 'No Finding'"
oracle("class_zero_one", f"""SELECT label, count(*) FILTER (NOT list_contains(labels, label)) AS zeros,
    count(*) FILTER (list_contains(labels, label)) AS ones FROM ({CLASSES}) c CROSS JOIN v_labels GROUP BY label""")
oracle("prevalence", f"""SELECT n_positive, n, round(n_positive * 100.0::DOUBLE / n, 6) AS percent,
    printf('%.4f%%', n_positive * 100.0::DOUBLE / n) AS percent_text
    FROM (SELECT count(*) FILTER ({IS_POSITIVE}) AS n_positive, count(*) AS n FROM v_labels)""")
oracle("target_breakdown", """SELECT CASE WHEN grouping(labels) = 1 THEN 'Total'
        ELSE ['large', 'small', 'medium'][labels + 1] END AS label,
    nullif(count(*) FILTER (split = 'train'), 0) AS train_split,
    nullif(count(*) FILTER (split = 'val'), 0) AS validation_split,
    nullif(count(*) FILTER (split = 'test'), 0) AS test_split, count(*) AS Total
    FROM v_split_samples GROUP BY ROLLUP (labels)""")
oracle("target_breakdown_two", """SELECT CASE WHEN grouping(labels) = 1 THEN 'Total'
        ELSE ['large', 'small', NULL][labels + 1] END AS label,
    nullif(count(*) FILTER (split = 'train'), 0) AS train_split,
    nullif(count(*) FILTER (split = 'test'), 0) AS test_split, count(*) AS Total
    FROM v_split_samples WHERE split <> 'val' GROUP BY ROLLUP (labels)""")
oracle("samples_per_class", """SELECT string_agg(n, ',' ORDER BY labels) AS samples_per_class
    FROM (SELECT labels, count(*) AS n FROM v_samples GROUP BY 1)""")
oracle("lookup_status", "SELECT status, sum(scans)::BIGINT AS n FROM v_lookup GROUP BY 1")
oracle("partition_check", """SELECT count(*) AS total, count(*) FILTER (list_contains(parts, 'train')) AS n_train,
    count(*) FILTER (list_contains(parts, 'test')) AS n_test, count(*) FILTER (len(parts) > 1) AS overlap,
    count(*) FILTER (parts IS NULL) AS unmatched,
    (count(*) FILTER (len(parts) > 1) = 0 AND count(*) FILTER (parts IS NULL) = 0)::INT AS complete
    FROM v_findings LEFT JOIN v_lists USING (order_key)""")
oracle("argmax_predict", "SELECT vec_id, y_true, y_pred FROM v_pred10")
oracle("prediction_table", "SELECT vec_id || '.png' AS key, y_true, y_pred FROM v_pred10")
oracle(
    "confusion_matrix",
    """SELECT t.label AS y_true, p.label AS y_pred, coalesce(n, 0) AS n
    FROM m_l t CROSS JOIN m_l p LEFT JOIN m_c ON y_true = t.label AND y_pred = p.label""",
    "m_c AS (SELECT y_true, y_pred, count(*) AS n FROM v_pred10 GROUP BY 1, 2)",
    f"m_l AS ({PRESENT})",
)
oracle("confusion_matrix_lines", """SELECT y_true, count(*) FILTER (y_pred = 0) AS pred_0,
    count(*) FILTER (y_pred = 1) AS pred_1 FROM v_pred_lines GROUP BY 1""")
ROUNDED_REPORT = """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
    support::BIGINT AS support FROM m_r"""
oracle("classification_report", ROUNDED_REPORT, report("v_pred10", PRESENT, "shown"))
oracle("classification_report_lines", ROUNDED_REPORT, report(
    "v_pred_lines", "SELECT * FROM (VALUES (0, 'other'), (1, 'returned'), (2, 'absent')) t(label, shown)", "shown"))
oracle(
    "run_summary",
    """SELECT 'densenet' AS model_name, round(a.roc_auc, 6) AS roc_auc, round(acc.precision, 6) AS accuracy,
    round(loss.loss, 6) AS loss, round(mac.precision, 6) AS precision, round(mac.recall, 6) AS recall, round(mac.f1, 6) AS f1
    FROM a, loss, (SELECT * FROM m_r WHERE label = 'accuracy') acc, (SELECT * FROM m_r WHERE label = 'macro avg') mac""",
    report("v_pred_lines", PRESENT, "shown"),
    auc("v_pred_lines", "y_pred"),
    f"loss AS (SELECT avg({LOSS}) AS loss FROM v_pred_lines)",
)
oracle("roc_auc", "SELECT round(roc_auc, 6) AS roc_auc FROM a", auc("v_pred2", "score"))
oracle("roc_auc_lines", "SELECT round(roc_auc, 6) AS roc_auc FROM a", auc("v_pred_lines", "score"))
oracle("roc_auc_hard", "SELECT round(roc_auc, 6) AS roc_auc FROM a", auc("v_pred_lines", "y_pred"))
WITHOUT_LOSS = f"count({LOSS}) AS n, count(*) - count({LOSS}) AS without_loss"
oracle("mean_loss", f"SELECT round(avg({LOSS}), 6) AS loss, {WITHOUT_LOSS} FROM v_pred10")
oracle("mean_loss_lines", f"SELECT round(avg({LOSS}), 6) AS loss, {WITHOUT_LOSS} FROM v_pred_lines")
SAME = "avg((y_true IS NOT DISTINCT FROM y_pred)::INT)"
oracle("accuracy_gaps", f"""SELECT round({SAME}, 6) AS accuracy, unnest(['plain', 'named', 'classes']) AS path
    FROM v_pred_gaps""")
oracle("topk_gaps", """SELECT round(avg((y_true BETWEEN 0 AND len(logits) - 1
        AND len(list_filter(logits, lambda x: x > logits[y_true + 1])) < 3 AND y_true IS NOT NULL)::INT), 6) AS topk
    FROM (SELECT logits, coalesce(y_true, -1) AS y_true FROM v_pred_gaps)""")
oracle("confusion_matrix_gaps", """SELECT t.label AS y_true, p.label AS y_pred, count(g.vec_id) AS n
    FROM (SELECT y_true AS label FROM v_pred_gaps UNION SELECT y_pred FROM v_pred_gaps) t
    CROSS JOIN (SELECT y_true AS label FROM v_pred_gaps UNION SELECT y_pred FROM v_pred_gaps) p
    LEFT JOIN v_pred_gaps g ON g.y_true IS NOT DISTINCT FROM t.label AND g.y_pred IS NOT DISTINCT FROM p.label GROUP BY 1, 2""")
oracle("run_report_gaps", """SELECT (generate_subscripts(l, 1) - 1)::INT AS line_no, unnest(l) AS line FROM (SELECT [
        '### Confusion matrix',
        '|  | ' || (SELECT string_agg(coalesce(label::VARCHAR, 'null'), ' | ' ORDER BY label NULLS FIRST) FROM r_l) || ' |',
        '| --- |' || (SELECT repeat(' --- |', count(*)) FROM r_l)]
        || (SELECT list('| ' || coalesce(y::VARCHAR, 'null') || ' | ' || cells || ' |' ORDER BY y NULLS FIRST) FROM r_c) || [''] AS l)""",
    "r_l AS (SELECT y_true AS label FROM v_pred_gaps UNION SELECT y_pred FROM v_pred_gaps)",
    """r_n AS (SELECT t.label AS y, p.label AS p, count(g.vec_id) AS n FROM r_l t CROSS JOIN r_l p LEFT JOIN v_pred_gaps g
        ON g.y_true IS NOT DISTINCT FROM t.label AND g.y_pred IS NOT DISTINCT FROM p.label GROUP BY 1, 2)""",
    "r_c AS (SELECT y, string_agg(n, ' | ' ORDER BY p NULLS FIRST) AS cells FROM r_n GROUP BY y)")
oracle("write_eval_names", """SELECT g.split, g.epoch, t.label AS y_true, p.label AS y_pred, t.called AS true_name,
        p.called AS pred_name, count(l.l_orderkey) AS n
    FROM (SELECT DISTINCT split, epoch FROM v_pred_lines) g
    CROSS JOIN (VALUES (0, 'kept'), (1, 'returned'), (2, 'lost')) t(label, called)
    CROSS JOIN (VALUES (0, 'kept'), (1, 'returned'), (2, 'lost')) p(label, called)
    LEFT JOIN v_pred_lines l ON l.split = g.split AND l.epoch = g.epoch AND l.y_true = t.label AND l.y_pred = p.label
    GROUP BY ALL""")
BY_EPOCH = """SELECT split, epoch, sum(p * (below + n / 2.0::DOUBLE)) / (sum(p) * sum(n)) AS roc_auc FROM (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY split, epoch ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below
    FROM (SELECT split, epoch, score, count(*) FILTER (y_true = 1)::DOUBLE AS p, count(*) FILTER (y_true <> 1)::DOUBLE AS n
          FROM v_pred_lines GROUP BY 1, 2, 3)) GROUP BY 1, 2"""
oracle("roc_auc_epochs", f"SELECT split, epoch, round(roc_auc, 6) AS roc_auc FROM ({BY_EPOCH})")
oracle("epoch_metrics_scores", f"""SELECT split, epoch, 'roc_auc' AS metric, round(roc_auc, 6) AS value FROM ({BY_EPOCH})
    UNION ALL SELECT split, epoch, 'accuracy', round(avg((y_true = y_pred)::INT), 6) FROM v_pred_lines GROUP BY 1, 2
    UNION ALL SELECT split, epoch, 'loss', round(avg({LOSS}), 6) FROM v_pred_lines GROUP BY 1, 2""")
oracle("roc_auc_classes", """SELECT c AS positive, round(sum(p * (below + n / 2.0::DOUBLE)) / (sum(p) * sum(n)), 6) AS roc_auc FROM (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY c ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below
    FROM (SELECT c, logits[c + 1] AS score, count(*) FILTER (y_true = c)::DOUBLE AS p, count(*) FILTER (y_true <> c)::DOUBLE AS n
          FROM v_pred10 CROSS JOIN (VALUES (0), (1), (2)) t(c) GROUP BY 1, 2)) GROUP BY 1""")
oracle("vector_moments", """SELECT side AS "set", i, j, round(mean_i, 6) AS mean_i, round(mean_j, 6) AS mean_j,
        round((products - n * mean_i * mean_j) / (n - 1), 6) AS covariance, n, skipped
    FROM (SELECT x.side, x.i::INT AS i, y.i::INT AS j, sum(x.v * y.v) AS products, avg(x.v) AS mean_i, avg(y.v) AS mean_j,
                 count(*) AS n FROM m_v x JOIN m_v y ON x.vec_id = y.vec_id AND x.i <= y.i GROUP BY 1, 2, 3)
    JOIN (SELECT side, count(*) FILTER (vec_id % 50 = 0) AS skipped FROM m_s GROUP BY 1) USING (side)""",
    "m_s AS (SELECT *, CASE WHEN label < 5 THEN 'real' ELSE 'fake' END AS side FROM embeddings)",
    """m_v AS (SELECT vec_id, side, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v
        FROM m_s WHERE vec_id % 50 <> 0)""")
oracle("custom_metric_merged", """SELECT split, epoch, round(avg(r), 6) AS balanced_accuracy FROM (
    SELECT split, epoch, y_true, avg((y_true = y_pred)::INT) AS r FROM v_pred_lines GROUP BY 1, 2, 3) GROUP BY 1, 2""")
oracle("accuracy", "SELECT round(avg((y_true = y_pred)::INT), 6) AS accuracy FROM v_pred_lines")
oracle("custom_metric", """SELECT split, epoch, round(avg(r), 6) AS balanced_accuracy FROM (
    SELECT split, epoch, y_true, avg((y_true = y_pred)::INT) AS r FROM v_pred_lines GROUP BY 1, 2, 3) GROUP BY 1, 2""")
oracle("metrics_by_name", f"""SELECT split, round(avg((y_true = y_pred)::INT), 6) AS accuracy,
    round(count(*) FILTER (y_true = 1 AND y_pred = 1) / count(*) FILTER (y_pred = 1), 6) AS precision,
    round(count(*) FILTER (y_true = 1 AND y_pred = 1) / count(*) FILTER (y_true = 1), 6) AS recall,
    round(2 * count(*) FILTER (y_true = 1 AND y_pred = 1)
        / (count(*) FILTER (y_pred = 1) + count(*) FILTER (y_true = 1)), 6) AS f1,
    round(avg({LOSS}), 6) AS loss, round(avg((y_true - y_pred) * (y_true - y_pred)), 6) AS meansquarederror
    FROM v_pred_lines GROUP BY split""")

oracle(
    "metrics_by_name_classes",
    """SELECT 'macro' AS average, round((SELECT precision FROM m_r WHERE label = 'accuracy'), 6) AS accuracy,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(k.topk, 6) AS topk
    FROM m_r, k WHERE label = 'macro avg'
    UNION ALL SELECT 'weighted', NULL, round(precision, 6), round(recall, 6), round(f1, 6), NULL
    FROM m_r WHERE label = 'weighted avg'""",
    report("v_pred10", PRESENT, "shown"),
    """k AS (SELECT avg((len(list_filter(logits, lambda x: x > logits[y_true + 1])) < 5)::INT) AS topk FROM v_pred10)""",
)

oracle("epoch_metrics", f"""SELECT split, epoch, split || '_' || metric AS metric, round(value, 6) AS value FROM (
        UNPIVOT (SELECT * FROM g_a JOIN g_r USING (split, epoch)) ON roc_auc, accuracy, loss, precision, recall, f1
        INTO NAME metric VALUE value)""",
    f"""g_a AS (SELECT split, epoch, avg((y_true = y_pred)::INT) AS accuracy, avg({LOSS}) AS loss,
        (sum(y_true * y_pred) * sum((1 - y_true) * (1 - y_pred))
         + 0.5::DOUBLE * sum(y_true * y_pred) * sum((1 - y_true) * y_pred)
         + 0.5::DOUBLE * sum(y_true * (1 - y_pred)) * sum((1 - y_true) * (1 - y_pred)))
        / (sum(y_true) * sum(1 - y_true)) AS roc_auc
        FROM v_pred_lines WHERE epoch % 2 = 0 GROUP BY 1, 2)""",
    """g_k AS (SELECT split, epoch, label,
        count(*) FILTER (y_true = label AND y_pred = label)::DOUBLE AS hits,
        count(*) FILTER (y_true = label) AS support, count(*) FILTER (y_pred = label) AS predicted
        FROM v_pred_lines CROSS JOIN (VALUES (0), (1)) l(label) WHERE epoch % 2 = 0 GROUP BY 1, 2, 3)""",
    """g_r AS (SELECT split, epoch, avg(hits / predicted) AS precision, avg(hits / support) AS recall,
        avg(2 * hits / (predicted + support)) AS f1 FROM g_k GROUP BY 1, 2)""",
)

# --- run logs ---
oracle("best_epochs", """SELECT run_id, metric, epoch, value, place FROM (
    SELECT *, (row_number() OVER (PARTITION BY run_id, metric ORDER BY value, epoch))::INT AS place
    FROM v_metric_log) WHERE place <= 2""")
oracle(
    "early_stop",
    """SELECT run_id, metric, count(*) AS epochs, min(CASE WHEN place - last >= 10 THEN epoch END) AS stop_epoch
    FROM e_l GROUP BY 1, 2""",
    """e_b AS (SELECT run_id, metric, epoch, value, row_number() OVER (PARTITION BY run_id, metric ORDER BY epoch) AS place,
        max(value) OVER (PARTITION BY run_id, metric ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
        FROM v_metric_log)""",
    """e_l AS (SELECT run_id, metric, epoch, place, max(CASE WHEN best IS NULL OR value > best THEN place END) OVER (
        PARTITION BY run_id, metric ORDER BY epoch) AS last FROM e_b)""",
)
oracle("last_metrics", """SELECT run_id, split, metric, max(epoch) AS epoch, arg_max(value, epoch) AS value
    FROM v_metric_log GROUP BY 1, 2, 3""")

# --- sorts and top-k ---
oracle("sorted_classes", "SELECT DISTINCT finding_labels FROM v_findings ORDER BY 1")
oracle("preview", "SELECT * FROM v_findings ORDER BY order_key LIMIT 5")
oracle("sample_k", f"SELECT * EXCLUDE r FROM (SELECT *, {seeded('key')} AS r FROM v_samples) WHERE r <= 500")

# --- unions and replication ---
oracle("union_parts", f"SELECT order_key, {IS_POSITIVE}::INT AS label FROM v_labels")
COMBINED = """SELECT image_files, labels, split, '{0}' AS source FROM v_split_samples
    UNION ALL SELECT image_files, labels, split, 'pages' FROM v_page_samples"""
oracle("combine_datasets", COMBINED.format("main"))
oracle("label_difference", "SELECT unnest(labels) AS label FROM v_labels EXCEPT SELECT p_type FROM part")
oracle("replicate_class", """SELECT key, labels, unnest(CASE WHEN labels = 1 THEN [1, 2, 3] ELSE [1] END) AS copy
    FROM v_samples""")

# --- scalar functions ---
oracle("basename", "SELECT page_id, name FROM v_scans")
oracle("patient_id", "SELECT page_id, split_part(name, '.', 1) AS patient_id FROM v_scans")
oracle("scan_number", """SELECT page_id, try_cast(right(split_part(split_part(name, '.', 1), '-', 1), 3) AS INTEGER)
    AS number FROM v_scans""")
oracle("split_labels", """SELECT order_key, len(labels)::INT AS n_labels, labels[1] AS first_label, labels[-1] AS last_label
    FROM v_labels""")
oracle("label_encode", """SELECT order_key, finding_labels, (dense_rank() OVER (ORDER BY finding_labels) - 1)::INT AS code
    FROM v_findings""")
oracle("multilabel_binarize", "SELECT order_key, " + ", ".join(
    f"list_contains(labels, '{c}')::INT AS \"{c}\""
    for c in ("ECONOMY", "LARGE", "MEDIUM", "No Finding", "PROMO", "SMALL", "STANDARD")) + " FROM v_labels")
oracle("one_hot_long", "SELECT order_key, unnest(labels) AS label FROM v_labels")
oracle("labels_from_encoding", """SELECT string_agg(finding_labels, ',' ORDER BY finding_labels) AS labels
    FROM (SELECT DISTINCT finding_labels FROM v_findings)""")
oracle("text_prompt", """SELECT order_key, lower('A photo of a lung xray' || CASE
    WHEN list_contains(labels, 'No Finding') THEN ''
    WHEN len(labels) = 1 THEN ' depicting visible ' || labels[1]
    WHEN len(labels) = 2 THEN ' depicting visible ' || labels[1] || ' and ' || labels[2]
    ELSE ' depicting visible ' || array_to_string(labels[:-2], ', ') || ', and ' || labels[-1] END) AS prompt
    FROM v_labels""")
oracle("text_prompt_one_hot", """SELECT order_key, lower('An X-ray' || CASE
    WHEN list_contains(labels, 'No Finding') THEN ''
    WHEN len(labels) = 1 THEN ' depicting visible ' || labels[1]
    WHEN len(labels) = 2 THEN ' depicting visible ' || labels[1] || ' and ' || labels[2]
    ELSE ' depicting visible ' || array_to_string(labels[:-2], ', ') || ', and ' || labels[-1] END) AS prompt
    FROM v_labels""")
oracle("zero_pad", """SELECT o_orderkey, printf('%03d', o_orderkey) AS three, printf('%04d', o_orderkey + 1) || '.png' AS four
    FROM orders""")
oracle("short_name", """SELECT p_partkey, 'Dense_' || p_type AS short, lower('Dense_' || p_type) AS lowered,
    CASE WHEN p_size % 2 = 0 THEN p_brand ELSE lower('Dense_' || p_type) END AS model FROM part""")
oracle("run_name", """SELECT run_id, lower(split_part(p['_target_'], '.', -1)) || CASE run_id % 3
    WHEN 0 THEN ';optimizer=adam;lr=' || p['lr'] || ';weight_decay=0.0;criterion=crossentropyloss'
        || CASE WHEN run_id % 2 = 0 THEN ';sample_to_value=3500' ELSE '' END || ';pretrained=true'
    WHEN 1 THEN ';pretrained_model=' || p['pretrained_model'] ELSE '' END
    || ';seed=' || p['random_state'] || ';2024-01-01-00-00-00;' || p['postfix'] AS run_name
    FROM (SELECT run_id, map_from_entries(list((k, v))) AS p FROM v_merged GROUP BY run_id)""")
oracle("collect_params", """SELECT run_id, string_agg(e, ',' ORDER BY e) AS params FROM (
    SELECT c_custkey AS run_id, unnest([
        'criterion_name=CrossEntropyLoss', 'dataset_name=chest', 'date=2024-01-01', 'lr=0.0' || c_nationkey,
        'model_name=' || CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'densenet121' END,
        'optimizer_name=AdamW', 'positive_class=PROMO', 'postfix=' || lower(c_mktsegment),
        'pretrained_model_name_or_path=models/' || c_mktsegment, 'random_state=' || c_custkey, 'reduction=mean',
        CASE WHEN c_nationkey >= 10 THEN 'sampling_method=resample' END, 'timestamp=00-00-00',
        'use_sampling=' || CASE WHEN c_nationkey < 10 THEN 'false' ELSE 'true' END, 'use_transforms=true']) AS e
    FROM customer) WHERE e IS NOT NULL GROUP BY run_id""")
oracle("merge_params", "SELECT run_id, string_agg(k || '=' || v, ',' ORDER BY k || '=' || v) AS params FROM v_merged GROUP BY run_id")
oracle("rename_metrics", """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'fid' WHEN 'view' THEN 'inception'
    WHEN 'click' THEN 'ssim' ELSE event_type END AS metric FROM events""")

# --- splitting, sampling, rebalancing ---
oracle("seeded_order", f"SELECT key, {seeded('key')} AS position FROM v_samples")
oracle("seeded_order_by_class", f"SELECT key, labels, {seeded('key', 'labels')} AS position FROM v_samples")
SPLIT = f"SELECT key, labels, {seeded('key', 'labels')} AS r FROM v_samples"
oracle(
    "stratified_split",
    f"""SELECT key, labels, CASE WHEN r <= quota THEN 'test' ELSE 'train' END AS split
    FROM ({SPLIT}) s JOIN q ON c = labels""",
    quotas("v_samples", "labels"),
)
oracle(
    "stratified_split3",
    """SELECT key, class_name, code, 'test' AS split FROM s_1 WHERE test
    UNION ALL SELECT key, class_name, code, CASE WHEN r <= quota THEN 'val' ELSE 'train' END FROM s_3 JOIN q2 ON c = code""",
    """s_0 AS (SELECT key, class_name, (dense_rank() OVER (ORDER BY class_name) - 1)::INT AS code FROM (
        SELECT key, ['large', 'small', 'medium'][labels + 1] AS class_name FROM v_samples))""",
    quotas("s_0", "code"),
    f"""s_1 AS (SELECT key, class_name, code, r <= quota AS test
        FROM (SELECT *, {seeded('key', 'code')} AS r FROM s_0) JOIN q ON c = code)""",
    "s_2 AS (SELECT key, class_name, code FROM s_1 WHERE NOT test)",
    quotas("s_2", "code", "q2"),
    f"s_3 AS (SELECT *, {seeded('key', 'code')} AS r FROM s_2)",
)


def draw_parts(source: str, need: str, prefix: str = "d") -> str:
    """Draws with replacement per class, each naming a row by its seeded rank."""
    return f"""
        {prefix}_r AS (SELECT *, {seeded('key', 'labels')} AS rank FROM {source}),
        {prefix}_n AS (SELECT labels AS c, count(*) AS n FROM {source} GROUP BY 1),
        {prefix}_d AS (SELECT c, n, unnest(range(greatest({need}, 0))) AS draw FROM {prefix}_n),
        {prefix} AS (SELECT key, labels, draw FROM {prefix}_r JOIN {prefix}_d ON c = labels
            AND rank = ('0x' || substr(md5('42|' || c || '|' || draw), 1, 15))::BIGINT % n + 1)"""


oracle("share_split", """SELECT key, labels, CASE WHEN ('0x' || substr(md5('42|' || key), 1, 8))::BIGINT / 4294967296::DOUBLE < 0.1
    THEN 'test' ELSE 'train' END AS split FROM v_samples""")
oracle("share_sample", """SELECT key, labels FROM v_samples WHERE ('0x' || substr(md5('42|' || key), 1, 8))::BIGINT / 4294967296::DOUBLE
    < CASE labels WHEN 0 THEN 0.25 WHEN 2 THEN 0.5 ELSE 1 END""")
oracle("stratified_split_sizes", f"""SELECT s.key, s.labels, CASE WHEN r <= test THEN 'test' WHEN r <= test + train THEN 'train' END AS split
    FROM ({SPLIT}) s JOIN z_q USING (labels)""",
    "z_n AS (SELECT labels, count(*) AS n, sum(count(*)) OVER () AS total FROM v_samples GROUP BY 1)",
    "z_t AS (SELECT *, floor(0.5 * total)::BIGINT AS kept, ceil(0.2::DOUBLE * total)::BIGINT AS tested FROM z_n)",
    """z_w AS (SELECT *, (n::HUGEINT * kept) // total::HUGEINT AS whole, (n::HUGEINT * kept) % total::HUGEINT AS frac FROM z_t)""",
    """z_k AS (SELECT *, (whole + CASE WHEN row_number() OVER (ORDER BY frac DESC, labels) <= kept - sum(whole) OVER ()
        THEN 1 ELSE 0 END)::BIGINT AS train FROM z_w)""",
    "z_l AS (SELECT labels, train, n - train AS rest, tested, sum(n - train) OVER () AS total FROM z_k)",
    """z_v AS (SELECT *, (rest::HUGEINT * tested) // total::HUGEINT AS whole, (rest::HUGEINT * tested) % total::HUGEINT AS frac FROM z_l)""",
    """z_q AS (SELECT labels, train, (whole + CASE WHEN row_number() OVER (ORDER BY frac DESC, labels) <= tested - sum(whole) OVER ()
        THEN 1 ELSE 0 END)::BIGINT AS test FROM z_v)""")
oracle("bootstrap_per_class", "SELECT key, labels, draw FROM d", draw_parts("v_samples", "3500"))
oracle("resample_to_value", "SELECT key, labels, NULL::BIGINT AS draw FROM v_samples UNION ALL SELECT key, labels, draw FROM d",
       draw_parts("v_samples", "3500 - n"))
oracle("undersample", f"""SELECT key, labels FROM ({SPLIT}) WHERE r <= (
    SELECT min(n) FROM (SELECT count(*) AS n FROM v_samples GROUP BY labels))""")
oracle("mix_generated", f"""SELECT image_files, labels FROM v_samples UNION ALL
    SELECT f, 2 FROM (SELECT f, {seeded('f')} AS r FROM (SELECT '/generated/' || c_name || '.png' AS f FROM customer))
    WHERE r <= abs((SELECT count(*) FROM v_samples WHERE labels = 2) - (SELECT count(*) FROM customer))""")
TRAIN_PART = f"""p_0 AS (SELECT key, labels, CASE WHEN r <= quota THEN 'val' ELSE 'train' END AS split
    FROM ({SPLIT}) s JOIN q ON c = labels), p_t AS (SELECT key, labels FROM p_0 WHERE split = 'train')"""
oracle(
    "prepare_splits",
    f"""SELECT key, labels, 'train' AS split FROM (SELECT *, {seeded('key', 'labels')} AS r FROM p_t)
    WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM p_t GROUP BY labels))
    UNION ALL SELECT key, labels, split FROM p_0 WHERE split = 'val'""",
    quotas("v_samples", "labels"),
    TRAIN_PART,
)
oracle(
    "prepare_splits_bootstrap",
    """SELECT key, labels, 'train' AS split, draw FROM d
    UNION ALL SELECT key, labels, split, NULL FROM p_0 WHERE split = 'val'""",
    quotas("v_samples", "labels"),
    TRAIN_PART,
    draw_parts("p_t", "1000"),
)

FILE_SPLIT = f"SELECT image_files, labels, {seeded('image_files', 'labels')} AS r FROM v_samples"
oracle(
    "prepare_splits_generated",
    f"""SELECT image_files, labels, 'train' AS split FROM (SELECT *, {seeded('image_files', 'labels')} AS r FROM w_m)
    WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM w_m GROUP BY labels))
    UNION ALL SELECT image_files, labels, 'val' FROM w_0 WHERE val""",
    quotas("v_samples", "labels"),
    f"w_0 AS (SELECT image_files, labels, r <= quota AS val FROM ({FILE_SPLIT}) s JOIN q ON c = labels)",
    f"w_g AS (SELECT f, {seeded('f')} AS r FROM (SELECT '/generated/' || c_name || '.png' AS f FROM customer))",
    """w_m AS (SELECT image_files, labels FROM w_0 WHERE NOT val UNION ALL SELECT f, 2 FROM w_g WHERE r <= abs(
        (SELECT count(*) FROM w_0 WHERE NOT val AND labels = 2) - (SELECT count(*) FROM customer)))""",
)

# --- cohorts ---
oracle("cohort_by_list", f"""SELECT order_key, '/scans/' || order_key AS image_files, finding_labels AS labels, part AS split
    FROM v_labels JOIN v_split_list ON id = order_key WHERE {IS_POSITIVE}""")
oracle("cohort_by_column", COLUMN_COHORT)
oracle("cohort_by_dirs", """
    SELECT split || '/' || class || '/' || name AS image_files, class AS class_name, labels,
        unnest(CASE WHEN labels = 0 AND split = 'train' THEN [1, 2, 3] ELSE [1] END) AS copy, split
    FROM (SELECT *, CASE WHEN place < 80 THEN 'train' ELSE 'test' END AS split FROM v_tree)
    JOIN (SELECT class, (dense_rank() OVER (ORDER BY class) - 1)::INT AS labels
          FROM (SELECT class FROM v_tree UNION SELECT 'el')) USING (class)""")
oracle("cohort_by_lookup", """SELECT s.patient, '/scans/' || s.filename AS image_files,
        trunc(try_cast(p.target AS DOUBLE))::INT AS labels
    FROM (SELECT patient, split_part(max(path), '/', -1) AS filename
          FROM (SELECT path, try_cast(right(split_part(split_part(name, '.', 1), '-', 1), 3) AS INTEGER) AS patient
                FROM v_scans WHERE NOT contains(path, '.html')) GROUP BY patient) s
    JOIN v_patients p ON p.id = s.patient WHERE try_cast(p.target AS DOUBLE) IS NOT NULL""")
oracle("load_cohort", COMBINED.format("samples"))
oracle(
    "explore_flow",
    """SELECT version, part, count(*) AS n, sum(positive)::BIGINT AS n_positive, count(*) - sum(positive)::BIGINT AS n_negative,
        round(sum(positive) * 100.0::DOUBLE / count(*), 6) AS percent,
        printf('%.4f%%', sum(positive) * 100.0::DOUBLE / count(*)) AS percent_text,
        count(*) FILTER (part = 'all' AND parts IS NULL) AS unlisted,
        count(*) FILTER (part = 'all' AND len(parts) > 1) AS overlap
    FROM x_p GROUP BY version, part""",
    f"""x_0 AS (SELECT parts, labels, {IS_POSITIVE}::INT AS positive, {IS_POSITIVE} AND len(labels) > 1 AS mixed,
        len(list_filter(labels, lambda x: x NOT IN ('PROMO', 'SMALL', 'LARGE'))) = 0 AS allowed
        FROM v_labels LEFT JOIN v_lists USING (order_key))""",
    "x_v AS (SELECT 1 AS version, * FROM x_0 UNION ALL SELECT 2, * FROM x_0 WHERE NOT mixed)",
    """x_p AS (SELECT *, 'all' AS part FROM x_v
        UNION ALL SELECT *, unnest(parts) AS part FROM x_v
        UNION ALL SELECT *, 'restricted_test' FROM x_v WHERE list_contains(parts, 'test') AND allowed)""",
)
JOB = [
    f"j_0 AS (SELECT order_key AS key, {IS_POSITIVE}::INT AS labels, part FROM v_labels JOIN v_split_list ON id = order_key)",
    "j_t AS (SELECT key, labels FROM j_0 WHERE part = 'train')",
    quotas("j_t", "labels"),
    f"""j_s AS (SELECT key, labels, CASE WHEN r <= quota THEN 'val' ELSE 'train' END AS split
        FROM (SELECT *, {seeded('key', 'labels')} AS r FROM j_t) JOIN q ON c = labels)""",
]
UNDERSAMPLED = [
    *JOB,
    f"j_r AS (SELECT *, {seeded('key', 'labels')} AS r FROM j_s WHERE split = 'train')",
    """j_all AS (SELECT key, labels, split FROM j_r WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM j_r GROUP BY labels))
        UNION ALL SELECT key, labels, split FROM j_s WHERE split = 'val'
        UNION ALL SELECT key, labels, part FROM j_0 WHERE part = 'test')""",
]
JOB_ROWS = f"FROM (SELECT *, {POSITIONS.format('key')} AS position FROM j_all)"
BATCH = "position, (position - 1) // 64 AS batch_id"
oracle("prepare_job", f"SELECT key AS order_key, '/scans/' || key AS image_files, labels, split, {BATCH} {JOB_ROWS}", *UNDERSAMPLED)
oracle("prepare_job_export", f"SELECT key AS order_key, labels, split, {BATCH} {JOB_ROWS}", *UNDERSAMPLED)
oracle(
    "prepare_job_bootstrap",
    f"""SELECT key AS order_key, labels, split, draw, {BATCH}
    FROM (SELECT *, CASE WHEN split = 'test' THEN row_number() OVER (PARTITION BY split ORDER BY key)
        ELSE row_number() OVER (PARTITION BY split ORDER BY md5(concat_ws('|', '42', key, draw)), key, draw) END AS position FROM j_all)""",
    *JOB,
    "j_b AS (SELECT key, labels FROM j_s WHERE split = 'train')",
    draw_parts("j_b", "1000"),
    """j_all AS (SELECT key, labels, 'train' AS split, draw FROM d
        UNION ALL SELECT key, labels, split, NULL FROM j_s WHERE split = 'val'
        UNION ALL SELECT key, labels, part, NULL FROM j_0 WHERE part = 'test')""",
)

# --- vectors ---
VALUES = "SELECT vec_id, (generate_subscripts(v, 1) - 1)::INT AS position, unnest(v) AS value FROM ({0})"
oracle("vec_normalize", VALUES.format("""SELECT vec_id,
        list_transform(embedding, lambda x: (x::DOUBLE * 2.0::DOUBLE / m - 1.0::DOUBLE) * 1024.0::DOUBLE) AS v
        FROM embeddings, (SELECT max(list_max(embedding))::DOUBLE AS m FROM embeddings)"""))
oracle("vec_out_of_range", """SELECT vec_id, (list_max(embedding)::DOUBLE > 0.35::DOUBLE)::INT AS out_of_range,
    CASE WHEN list_max(embedding)::DOUBLE <= 0.35::DOUBLE THEN len(embedding) END::INT AS scaled FROM embeddings""")
oracle("vec_channel_mean", VALUES.format("""SELECT vec_id,
    list_transform(range(0, len(embedding), 3), lambda i:
        list_sum(list_transform(embedding[i + 1:i + 3], lambda x: x::DOUBLE)) / len(embedding[i + 1:i + 3])) AS v
    FROM embeddings"""))
oracle("vec_channel_repeat", VALUES.format(
    "SELECT vec_id, flatten(list_transform(embedding, lambda x: [x::DOUBLE, x::DOUBLE, x::DOUBLE])) AS v FROM embeddings"))
oracle("vec_steps", """SELECT vec_id, position, value, 4 AS steps FROM (""" + VALUES.format("""SELECT vec_id,
    list_transform(list_transform(embedding, lambda x: (x::DOUBLE * 2.0::DOUBLE - 1.0::DOUBLE) * 1024.0::DOUBLE),
        lambda a: ((a + a + a) / 3)::FLOAT::DOUBLE) AS v FROM embeddings""") + ")")
oracle(
    "inception_score",
    "SELECT round(avg(score), 6) AS inception_mean, round(stddev_samp(score), 6) AS inception_std FROM i_s",
    """i_p AS (SELECT vec_id, ('0x' || substr(md5('42|' || vec_id), 1, 8))::BIGINT % 10 AS fold,
        list_transform(e, lambda x: x / list_sum(e)) AS p
        FROM (SELECT vec_id, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM v_pred10))""",
    "i_l AS (SELECT vec_id, fold, generate_subscripts(p, 1) AS j, unnest(p) AS x FROM i_p)",
    "i_m AS (SELECT fold, j, avg(x) AS m FROM i_l GROUP BY 1, 2)",
    """i_s AS (SELECT fold, exp(avg(kl)) AS score FROM (SELECT l.vec_id, l.fold, sum(x * (ln(x) - ln(m))) AS kl
        FROM i_l l JOIN i_m m ON l.fold = m.fold AND l.j = m.j GROUP BY 1, 2) GROUP BY 1)""",
)
oracle(
    "pair_ssim",
    """SELECT round(avg((2 * mx * my + c1) * (2 * cov + c2) / ((mx * mx + my * my + c1) * (vx + vy + c2))), 6) AS ssim,
        count(*) AS pairs, (SELECT abs(count(*) FILTER (side = 'fake') - count(*) FILTER (side = 'real')) FROM k_s) AS unpaired,
        0::BIGINT AS skipped FROM k_m, k_c""",
    f"""k_s AS (SELECT *, {seeded('vec_id', 'side')} AS r FROM (SELECT vec_id, embedding AS v,
        CASE WHEN label < 5 THEN 'real' ELSE 'fake' END AS side FROM embeddings))""",
    """k_c AS (SELECT (0.01 * max(w)) ** 2 AS c1, (0.03 * max(w)) ** 2 AS c2 FROM (
        SELECT max(list_max(v))::DOUBLE - min(list_min(v))::DOUBLE AS w FROM k_s GROUP BY side))""",
    """k_p AS (SELECT f.r, unnest(f.v)::DOUBLE AS x, unnest(g.v)::DOUBLE AS y
        FROM k_s f JOIN k_s g ON f.r = g.r WHERE f.side = 'fake' AND g.side = 'real')""",
    """k_m AS (SELECT r, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS cov
        FROM k_p GROUP BY r)""",
)

# --- streaming ---
EPOCHS = """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS epoch, (event_type = 'error')::INT AS y_true,
    (value > 10)::INT AS y_pred FROM events"""
oracle("stream_confusion", f"SELECT epoch, y_true, y_pred, count(*) AS n FROM ({EPOCHS}) GROUP BY 1, 2, 3")
oracle("stream_late_rows", """SELECT epoch, count(*) FILTER (NOT behind) AS counted,
        round(avg((y_true = y_pred)::INT) FILTER (NOT behind), 6) AS accuracy, count(*) FILTER (behind) AS late, count(*) AS arrived
    FROM (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS epoch, (event_type = 'error')::INT AS y_true,
                 (value > 10)::INT AS y_pred, event_id % 10 = 0 AND day(ts) <= 10 AS behind FROM events) GROUP BY 1""")
oracle("batch_confusion", f"""SELECT epoch, count(*) AS n, round(avg((y_true = y_pred)::INT), 6) AS accuracy
    FROM ({EPOCHS}) GROUP BY 1""")


def _used(text: str) -> list[str]:
    """Views a text needs, those of its views included, in defining order."""
    found = {v for v in VIEWS if re.search(rf"\b{v}\b", text)}
    while True:
        more = {w for v in found for w in VIEWS if re.search(rf"\b{w}\b", VIEWS[v])} | found
        if more == found:
            return [v for v in VIEWS if v in found]
        found = more


def oracle_queries() -> dict[str, str]:
    """Complete SQL text per query name."""
    texts = {}
    for name, (parts, select) in ORACLES.items():
        views = [f"{v} AS ({VIEWS[v]})" for v in _used(parts + select)]
        steps = [*views, *([parts] if parts else [])]
        texts[name] = (f"WITH {', '.join(steps)} " if steps else "") + select
    return texts
