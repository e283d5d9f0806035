"""The queries of plans/queries.py in DuckDB's SQL."""

from __future__ import annotations

_WORD = lambda w: f"(^|[^A-Za-z0-9_]){w}([^A-Za-z0-9_]|$)"
_NO, _THE = _WORD("no"), _WORD("the")
_SECRET, _LICENCE = "token|password|AKIA", "license|licensed"

#: The fixture cascade over documents.
_QC = f"""
    qc AS (SELECT doc_id, lang, source, n_chars, text,
      CASE WHEN regexp_matches(text, '{_SECRET}', 'i') THEN 'EXCLUDE_SECRET'
           WHEN regexp_matches(text, '{_LICENCE}', 'i') THEN 'REVIEW_LICENCE'
           WHEN regexp_matches(text, '{_NO}') AND regexp_matches(regexp_replace(text, '{_NO}', ' ', 'gi'), '{_THE}', 'i') THEN 'REVIEW_MECHANISM'
           WHEN regexp_matches(text, '{_NO}') THEN 'EXCLUDE_NO_GOF_EVIDENCE'
           WHEN lang = 'de' AND n_chars < 200 THEN 'EXCLUDE_NON_GOF_LOF' ELSE 'KEEP' END AS action,
      CASE WHEN regexp_matches(text, '{_SECRET}', 'i') THEN 'secret in text'
           WHEN regexp_matches(text, '{_LICENCE}', 'i') THEN 'licence in ' || source
           WHEN regexp_matches(text, '{_NO}') AND regexp_matches(regexp_replace(text, '{_NO}', ' ', 'gi'), '{_THE}', 'i') THEN 'negated and claimed'
           WHEN regexp_matches(text, '{_NO}') THEN 'negated'
           WHEN lang = 'de' AND n_chars < 200 THEN 'short' ELSE '' END AS reason
      FROM documents)"""

_FLAGS = f"""{_QC},
    m AS (SELECT *, ['HYPERMORPH_TRUE_GOF','TOXIC_GOF','DOMINANT_NEGATIVE_ANTIMORPH','LOSS_OF_FUNCTION_NON_GOF','UNCERTAIN_OR_CONFLICTING'][CAST(doc_id % 5 + 1 AS INT)] AS mech,
      CASE WHEN doc_id % 7 = 0 THEN 'TRUE_GOF' WHEN doc_id % 7 = 1 THEN 'ANTIMORPH_DN' ELSE '' END AS strict FROM qc),
    f AS (SELECT *,
      CASE WHEN action IN ('EXCLUDE_NON_GOF_LOF','EXCLUDE_NO_GOF_EVIDENCE') THEN 'LOSS_OF_FUNCTION_NON_GOF' ELSE mech END AS curated_mechanism_class_round1,
      CASE WHEN starts_with(action, 'EXCLUDE') THEN 'EXCLUDED' ELSE strict END AS strict_gof_status_round1,
      CASE WHEN action = 'KEEP' THEN 'YES' WHEN starts_with(action, 'EXCLUDE') THEN 'NO' ELSE 'REVIEW' END AS include_in_final_dataset_round1,
      CASE WHEN action <> 'KEEP' THEN 'NO' WHEN strict = 'TRUE_GOF' OR mech = 'HYPERMORPH_TRUE_GOF' THEN 'YES'
           WHEN mech IN ('DOMINANT_NEGATIVE_ANTIMORPH','TOXIC_GOF') OR strict = 'ANTIMORPH_DN' THEN 'YES_NEOMORPH_DN' ELSE 'REVIEW' END AS include_in_strict_HN_analysis_round1
      FROM m)"""

SQL: dict[str, str] = {
    "q_scan_clean": r"SELECT doc_id, left(regexp_replace(text, '^\s+|\s+$', '', 'g'), 80) AS head, CAST(length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS BIGINT) AS n, '' AS note FROM documents WHERE regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''",
    "q_scan_topn": "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 30",
    "q_null_cast": "SELECT d.doc_id, CAST(TRY_CAST(regexp_replace(text, '[^0-9]', '', 'g') AS DECIMAL(18,0)) AS BIGINT) AS number, coalesce(quality, -1) AS quality, TRY_CAST(regexp_replace(source, '[^0-9]', '', 'g') AS INT) AS source_no FROM documents d LEFT JOIN labels l USING (doc_id)",
    "q_enum_guard": "SELECT event_id, CASE WHEN upper(event_type) IN ('CLICK','VIEW','PURCHASE') THEN upper(event_type) ELSE 'OTHER' END AS kind, CAST(CASE WHEN starts_with(props, '{') THEN length(props) ELSE 0 END AS BIGINT) AS props_n FROM events",
    "q_add_missing_cols": "SELECT origin, lang, source, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM (SELECT doc_id AS id, lang, source, 'documents' AS origin FROM documents UNION ALL SELECT item_id, '', '', 'benchmark' FROM benchmark) GROUP BY ALL",
    "q_flatten_json": "WITH k AS (SELECT props, unnest(json_keys(props)) AS name FROM events) SELECT name, count(*) AS n, count(DISTINCT json_extract_string(props, '$.' || name)) AS \"values\" FROM k GROUP BY name",
    "q_map_explode": "WITH r AS (SELECT DISTINCT conv_id, role FROM conversations) SELECT role AS section, count(*) AS n, round(count(*) / (SELECT count(DISTINCT conv_id) FROM conversations), 9) AS share FROM r GROUP BY role",
    "q_vocab_flags": f"SELECT doc_id, regexp_matches(text || ' ' || source, '{_SECRET}', 'i') AS secret, regexp_matches(text || ' ' || source, '{_LICENCE}', 'i') AS licence, regexp_matches(text || ' ' || source, '{_THE}', 'i') AS the, regexp_matches(text || ' ' || source, '{_NO}') AS no FROM documents",
    "q_negation_retest": "SELECT doc_id, regexp_matches(text, 'the (and|of)', 'i') AS negated, regexp_matches(regexp_replace(text, 'the (and|of)', ' ', 'gi'), '(and|of) th', 'i') AS still FROM documents",
    "q_tiered_match": f"""
        WITH h AS (SELECT doc_id, left(text, length(text) // 2) AS a, substr(text, length(text) // 2 + 1) AS b FROM documents),
        x AS (SELECT doc_id, a, b, CASE WHEN a <> '' AND b <> '' THEN a || ' ' || b ELSE a || b END AS s FROM h),
        m AS (SELECT *, regexp_extract(s, '{_SECRET}', 0, 'i') AS m1, regexp_extract(s, 'licen[a-z]+', 0, 'i') AS m2, regexp_extract(s, 'that [a-z]+', 0, 'i') AS m3 FROM x)
        SELECT doc_id, CASE WHEN m1 <> '' THEN 'tier1' WHEN m2 <> '' THEN 'tier2' WHEN m3 <> '' THEN 'tier3' ELSE '' END AS best,
          left(concat_ws(' | ', CASE WHEN m1 <> '' THEN 'tier1:' || m1 END, CASE WHEN m2 <> '' THEN 'tier2:' || m2 END, CASE WHEN m3 <> '' THEN 'tier3:' || m3 END), 200) AS matched,
          concat_ws(',', CASE WHEN regexp_matches(a, 'that [a-z]+', 'i') THEN 'first' END, CASE WHEN regexp_matches(b, 'that [a-z]+', 'i') THEN 'second' END) AS hits FROM m""",
    "q_sentence_extract": r"WITH s AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[A-Z][a-z ,]{0,60}[.]', 0, 'i'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS l FROM documents), u AS (SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM s) SELECT doc_id, CAST(len(l) AS BIGINT) AS n, coalesce(array_to_string(l, '|'), '') AS sentences FROM u",
    "q_prompt_budget": """
        WITH p AS (SELECT doc_id, source, text, length(text) // 3 AS k FROM documents),
        a AS (SELECT *, CASE WHEN length(left(text, 120)) > 100 THEN left(left(text, 120), 90) END AS snip, left(text, k) AS s1, substr(text, k + 1, k) AS s2, substr(text, 2 * k + 1) AS s3 FROM p),
        b AS (SELECT *, 700 - coalesce(length(snip), 0) AS b1 FROM a), c AS (SELECT *, b1 - length(left(s1, b1)) AS b2 FROM b), d AS (SELECT *, b2 - CASE WHEN b2 > 0 THEN length(left(s2, b2)) ELSE 0 END AS b3 FROM c)
        SELECT doc_id, 'Title: ' || source || chr(10) || chr(10) || concat_ws(chr(10) || chr(10), '[VARIANTS]' || chr(10) || snip, CASE WHEN b1 > 0 THEN '[ABSTRACT]' || chr(10) || left(s1, b1) END,
          CASE WHEN b2 > 0 THEN '[RESULTS]' || chr(10) || left(s2, b2) END, CASE WHEN b3 > 0 THEN '[METHODS]' || chr(10) || left(s3, b3) END) AS prompt FROM d""",
    "q_prompt_capped": "SELECT conv_id, left('Title: ' || conv_id || chr(10) || chr(10) || coalesce(string_agg('[' || role || ']' || chr(10) || left(text, 200), chr(10) || chr(10) ORDER BY turn, role, text) FILTER (WHERE length(text) > 20), ''), 900) AS prompt FROM conversations GROUP BY conv_id",
    "q_norm_code": "SELECT p_partkey, 'c.' || regexp_replace(p_brand, '[^0-9]', '', 'g') || 'del' AS code, 'p.x' || p_size || 'dup' AS compare FROM part",
    "q_norm_protein": "SELECT p_partkey, 'p.gln' || p_size || 'fster' || (p_partkey % 9) AS frameshift, 'p.arg' || p_size || 'ter' AS stop FROM part",
    "q_parse_id": r"SELECT page_id, regexp_extract(replace(url, '/', '#c.'), '#(c\.[^#\s]+)', 1) AS coding, regexp_extract(replace(url, '/', '#c.'), '#(p\.[^#\s]+)', 1) AS protein FROM pages",
    "q_positions": "WITH l AS (SELECT page_id, regexp_extract_all(url || ' 7 ' || page_id, '[0-9]+') AS l FROM pages), u AS (SELECT page_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM l) SELECT page_id, array_to_string(l, ',') AS numbers, CAST(len(l) AS BIGINT) AS n FROM u",
    "q_relevance_flag": r"SELECT page_id, regexp_matches(lower(url || ' ' || page_id), '(?:^|[^a-z0-9_])(?:fs|ter|stop|del|dup|ins)(?:$|[^a-z0-9_])|frameshift|nonsense|(?:^|[^a-z0-9_])trunc|[*x][0-9]|x(?:$|[^a-z0-9_])|delins|ext[*]|(?:^|[^a-z0-9_])ext[a-z]|splice|splicing') AS relevant FROM pages",
    "q_score_band": "WITH v AS (SELECT vec_id AS doc_id, (round(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda a, b: a + b) * 1000) % 100) / 100 AS score FROM embeddings) SELECT CASE WHEN coalesce(score, 0) >= 0.7 THEN 'HIGH' WHEN coalesce(score, 0) >= 0.4 THEN 'MID' ELSE 'LOW' END AS band, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good FROM labels LEFT JOIN v USING (doc_id) GROUP BY 1",
    "q_html_tags": r"WITH x AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, list_transform(regexp_extract_all(html, '(?s)<li(?: [^>]*)?>(.*?)</li>', 1), lambda s: regexp_replace(regexp_replace(regexp_replace(s, '<[^>]+>', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS l FROM pages) SELECT page_id, regexp_replace(title, '<[^>]+>', '', 'g') AS title, CAST(len(l) AS BIGINT) AS n_items, coalesce(array_to_string(l, '|'), '') AS items FROM x",
    "q_record_flatten": "WITH g AS (SELECT conv_id, list(role ORDER BY turn, role, text) AS roles, list(text ORDER BY turn, role, text) FILTER (WHERE role = 'user') AS users FROM conversations GROUP BY conv_id) SELECT conv_id, left(coalesce(users[1], ''), 40) AS opening, left(array_to_string(roles, ' '), 60) AS roles, concat_ws('; ', CASE WHEN len(roles) > 4 THEN 'long' END, CASE WHEN list_contains(roles, 'system') THEN 'system' END, 'turns=' || len(roles)) AS why FROM g",
    "q_split_pairs": r"""
        WITH s AS (SELECT page_id, string_split(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[.]', ';', 'g'), ';') AS a, string_split(regexp_replace(url, '[:/.]+', ';', 'g'), ';') AS b FROM pages),
        i AS (SELECT page_id, a, b, unnest(range(greatest(len(a), len(b)))) AS i FROM s)
        SELECT page_id, i, coalesce(trim(a[i + 1]), '') AS "left", coalesce(trim(b[i + 1]), '') AS "right", regexp_matches(coalesce(trim(b[i + 1]), ''), '^[0-9]{5,6}$') AS is_id FROM i""",
    "q_any_missing": "SELECT conv_id, bool_or(length(text) < 40) AS any_short, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) AS n FROM conversations GROUP BY conv_id",
    "q_qc_cascade": f"WITH {_QC} SELECT doc_id, action, reason FROM qc",
    "q_derived_flags": f"WITH {_FLAGS} SELECT doc_id, curated_mechanism_class_round1, strict_gof_status_round1, include_in_final_dataset_round1, include_in_strict_HN_analysis_round1, CASE WHEN include_in_strict_HN_analysis_round1 IN ('YES','YES_NEOMORPH_DN') THEN 'INCLUDE' WHEN include_in_final_dataset_round1 = 'NO' THEN 'EXCLUDE' ELSE 'REVIEW' END AS hn_view_round1 FROM f",
    "q_reclass_nine": f"""WITH {_FLAGS},
        a AS (SELECT *, ['frameshift','stop_gain','stop_loss','NMD_escape','missense'][CAST(n_chars % 5 + 1 AS INT)] AS kind, doc_id % 2 = 0 AS stop, doc_id % 3 = 0 AS neo, starts_with(action, 'EXCLUDE') AS ex FROM f),
        v AS (SELECT *, CASE kind WHEN 'frameshift' THEN 'FRAMESHIFT' WHEN 'stop_gain' THEN 'STOP_GAIN' WHEN 'stop_loss' THEN 'STOP_LOSS' WHEN 'NMD_escape' THEN CASE WHEN stop THEN 'STOP_GAIN' ELSE 'FRAMESHIFT' END ELSE 'OTHER' END AS variant FROM a),
        w AS (SELECT *, CASE WHEN variant = 'STOP_LOSS' THEN 'NONSTOP_EXTENSION' ELSE 'NOT_APPLICABLE' END AS sub,
          CASE WHEN ex OR mech = 'LOSS_OF_FUNCTION_NON_GOF' THEN 'NON_GOF_EXCLUDE' WHEN variant = 'OTHER' THEN 'OUT_OF_SCOPE_BROAD_GOF' ELSE variant || '_GOF' END AS task,
          CASE WHEN action IN ('EXCLUDE_NO_GOF_EVIDENCE','EXCLUDE_NON_GOF_LOF') OR mech = 'LOSS_OF_FUNCTION_NON_GOF' THEN 'NO' WHEN mech = 'UNCERTAIN_OR_CONFLICTING' OR action = 'REVIEW_MECHANISM' THEN 'CONFLICTING' WHEN mech IN ('HYPERMORPH_TRUE_GOF','DOMINANT_NEGATIVE_ANTIMORPH','TOXIC_GOF') THEN 'YES' ELSE 'REVIEW' END AS due,
          CASE WHEN mech = 'LOSS_OF_FUNCTION_NON_GOF' THEN 'CONTRADICTS_GOF' WHEN action = 'EXCLUDE_NO_GOF_EVIDENCE' THEN 'NO_GOF_SHOWN' WHEN doc_id % 4 = 0 THEN 'DIRECT_FUNCTIONAL' ELSE 'UNCERTAIN' END AS strength,
          CASE WHEN variant = 'STOP_LOSS' THEN 'NOT_APPLICABLE' WHEN kind = 'NMD_escape' THEN 'NMD_ESCAPE_REPORTED' WHEN mech = 'LOSS_OF_FUNCTION_NON_GOF' THEN 'NMD_SENSITIVE_OR_DEGRADED' ELSE 'UNKNOWN' END AS nmd,
          CASE WHEN ex THEN 'NON_GOF' WHEN mech = 'HYPERMORPH_TRUE_GOF' THEN CASE WHEN neo THEN 'NEOMORPH' ELSE 'HYPERMORPH' END WHEN mech = 'DOMINANT_NEGATIVE_ANTIMORPH' THEN 'DOMINANT_NEGATIVE_SEPARATE' WHEN mech = 'TOXIC_GOF' THEN 'TOXIC_GOF_SEPARATE' WHEN mech = 'LOSS_OF_FUNCTION_NON_GOF' THEN 'NON_GOF' ELSE 'REVIEW' END AS call FROM v)
        SELECT doc_id, variant AS primary_variant_class, sub AS stop_loss_subtype, task AS primary_gof_task, due AS gof_due_to_variant, strength AS gof_evidence_strength, nmd AS nmd_escape_status, call AS hn_call,
          CASE WHEN task IN ('NON_GOF_EXCLUDE','OUT_OF_SCOPE_BROAD_GOF') OR include_in_final_dataset_round1 = 'NO' THEN 'NO' WHEN include_in_final_dataset_round1 = 'REVIEW' THEN 'REVIEW' ELSE 'YES' END AS include_in_core_task_dataset,
          concat_ws('; ', CASE WHEN kind = 'NMD_escape' THEN 'NMD_escape hgvs remapped→' || variant END,
            CASE WHEN task = 'NON_GOF_EXCLUDE' AND ex THEN 'QC_excluded:' || action WHEN task = 'NON_GOF_EXCLUDE' THEN 'mech=LOF_non_GOF' WHEN task = 'OUT_OF_SCOPE_BROAD_GOF' THEN 'variant_type_' || variant || '_not_primary_task' END,
            'mech=' || mech, CASE WHEN call IN ('DOMINANT_NEGATIVE_SEPARATE','TOXIC_GOF_SEPARATE','NEOMORPH') THEN 'hn_call=' || call END, CASE WHEN sub <> 'NOT_APPLICABLE' THEN 'stop_loss_subtype=' || sub END,
            CASE WHEN nmd IN ('NMD_ESCAPE_REPORTED','NMD_SENSITIVE_OR_DEGRADED') THEN 'nmd=' || nmd END, CASE due WHEN 'NO' THEN 'no_GOF_evidence' WHEN 'CONFLICTING' THEN 'conflicting_GOF_signals' END, CASE WHEN starts_with(action, 'REVIEW') THEN 'qc_flag:' || action END) AS task_reclassification_reason
        FROM w""",
    "q_notation_class": "WITH v AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'STOP_LOSS' WHEN 1 THEN 'FRAMESHIFT' WHEN 2 THEN CASE WHEN p_partkey % 3 = 0 THEN 'FRAMESHIFT' ELSE 'STOP_GAIN' END ELSE CASE p_partkey % 3 WHEN 0 THEN 'FRAMESHIFT' WHEN 1 THEN 'OTHER' ELSE 'STOP_GAIN' END END AS variant FROM part) SELECT p_partkey, variant, CASE WHEN variant = 'STOP_LOSS' THEN 'GENETIC_STOP_CODON_LOSS' ELSE 'NOT_APPLICABLE' END AS subtype FROM v",
    "q_default_cols": "WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'FRAMESHIFT' WHEN 'O' THEN 'STOP_LOSS' ELSE 'OTHER' END AS v, starts_with(o_orderpriority, '1') AS h FROM orders) SELECT v AS primary_variant_class, CASE WHEN v = 'OTHER' THEN 'REVIEW' ELSE v || '_GOF' END AS primary_gof_task, CASE WHEN h THEN 'YES' ELSE 'REVIEW' END AS gof_due_to_variant, 'STRONG_ASSERTION' AS gof_evidence_strength, CASE WHEN v = 'STOP_LOSS' THEN 'NOT_APPLICABLE' ELSE 'UNKNOWN' END AS nmd_escape_status, CASE WHEN h THEN 'HYPERMORPH' ELSE 'REVIEW' END AS hn_call, CASE WHEN v = 'OTHER' THEN 'REVIEW' ELSE 'YES' END AS include_in_core_task_dataset, 'NOT_APPLICABLE' AS stop_loss_subtype, count(*) AS n FROM r GROUP BY ALL",
    "q_lookup_last_wins": "WITH l AS (SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_returnflag DESC) AS r FROM lineitem) SELECT o_orderkey, coalesce(l_returnflag, '') AS l_returnflag FROM orders LEFT JOIN l ON o_orderkey = l_orderkey AND r = 1",
    "q_dedup_antijoin": "WITH m AS (SELECT doc_id, text, lang, lang = 'en' AND text IN (SELECT text FROM benchmark) AS known, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS r FROM documents) SELECT doc_id, CASE WHEN known OR r > 1 THEN 'duplicate' ELSE 'new' END AS state FROM m",
    "q_resume_anti": "SELECT doc_id FROM documents WHERE doc_id % 10 = 0 OR doc_id NOT IN (SELECT doc_id FROM labels)",
    "q_semi_ids": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "q_map_then_anti": "SELECT c_nationkey, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1",
    "q_bridge_coalesce": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE coalesce(n_name, '') END AS n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "q_first_key": "WITH a AS (SELECT s_suppkey AS k, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS v FROM supplier WHERE s_suppkey % 2 = 0 GROUP BY 1), b AS (SELECT s_nationkey AS k, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS v FROM supplier WHERE s_suppkey % 2 = 1 GROUP BY 1) SELECT c_custkey, coalesce(a.v, b.v) AS names FROM customer LEFT JOIN a ON c_custkey = a.k LEFT JOIN b ON c_nationkey = b.k",
    "q_fuzzy_exists": """
        WITH n AS (SELECT doc_id, doc_id % 40 AS k, 'c.' || (n_chars % 900) AS coding, regexp_extract(text, '^[A-Za-z]+') AS protein, regexp_extract_all(text, '[0-9]+') AS nums FROM documents),
        m AS (SELECT item_id % 40 AS k, 'c.' || (item_id * 7 % 900) AS coding, regexp_extract(text, '^[A-Za-z]+') AS protein FROM benchmark)
        SELECT doc_id, count(*) OVER (PARTITION BY k) AS of_pmid, CAST(EXISTS (SELECT 1 FROM m WHERE m.k = n.k AND (m.coding = n.coding OR (m.protein <> '' AND m.protein = n.protein) OR list_has_any(n.nums, regexp_extract_all(m.coding || ' ' || m.protein, '[0-9]+')))) AS INT) AS covered
        FROM n WHERE k IN (SELECT k FROM m)""",
    "q_coverage": "SELECT count(*) AS n, count(l.doc_id) AS covered, round(count(l.doc_id) / count(*), 9) AS share FROM documents LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)",
    "q_map_literal": "SELECT CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'TOP' WHEN o_orderpriority = '3-MEDIUM' THEN 'MID' ELSE 'REST' END AS level, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
    "q_top1_scored": r"""
        WITH w AS (SELECT p_brand, p_partkey, p_name, list_distinct(string_split(lower(p_brand), ' ')) AS b, list_distinct(string_split(lower(p_name), ' ')) AS a FROM part),
        s AS (SELECT p_brand, p_partkey, len(list_intersect(b, a)) / len(b) + len(list_intersect(a, ['blue','green','brand','part','metal','widget'])) / len(a) AS score FROM w)
        SELECT p_brand, p_partkey, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS r FROM s) WHERE r = 1""",
    "q_disease_ids": """
        WITH e AS (SELECT n_name AS gene, s_suppkey AS k, s_suppkey % 3 = 0 AS marked, s_suppkey % 5 = 0 AS same, s_suppkey % 2 = 0 AS valid FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey > 5),
        w AS (SELECT n_name AS gene, len(list_distinct(string_split('syndrome ' || lower(n_name), ' '))) AS words FROM nation),
        s AS (SELECT e.*, CASE WHEN marked THEN -1 WHEN same THEN 1 ELSE 1 / words END AS score FROM e JOIN w USING (gene) WHERE valid),
        b AS (SELECT gene, arg_min(k, [-score, k]) AS best, max(score) AS top, arg_min(k, [CAST(marked AS DOUBLE), k]) AS first FROM s GROUP BY gene)
        SELECT n_name AS gene, CASE WHEN top >= 0.5 THEN CAST(100000 + best AS VARCHAR) ELSE CAST(100000 + first AS VARCHAR) END AS id,
          CASE WHEN n_name NOT IN (SELECT gene FROM e) THEN 'not_found' WHEN first IS NULL THEN 'no_valid_id' WHEN top >= 0.99 THEN 'exact' WHEN top >= 0.5 THEN 'partial:' || printf('%.2f', top) ELSE 'first_valid' END AS tag
        FROM nation LEFT JOIN b ON n_name = b.gene""",
    "q_precise_list": "SELECT DISTINCT doc_id AS pmid FROM documents WHERE source <> 'src0' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND doc_id NOT IN (SELECT item_id FROM benchmark)",
    "q_set_ops": "WITH a AS (SELECT doc_id FROM documents), b AS (SELECT doc_id FROM labels), c AS (SELECT item_id AS doc_id FROM benchmark), u AS (SELECT 'union' AS s, doc_id FROM (SELECT * FROM b UNION SELECT * FROM c) UNION ALL SELECT 'both', doc_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only', doc_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) SELECT s AS \"set\", count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM u GROUP BY 1",
    "q_value_counts": "SELECT coalesce(event_type, 'unclear') AS value, count(*) AS n FROM events GROUP BY 1",
    "q_cond_counts": "SELECT count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE quality = 0) AS bad, count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS toxic_good FROM labels",
    "q_global_stats": "SELECT count(*) AS n, round(avg(n_chars), 6) AS mean_chars, count(DISTINCT source) AS sources FROM documents",
    "q_group_index": "SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY 1",
    "q_summary_stack": "WITH r AS (SELECT lang, source, coalesce(CAST(quality AS VARCHAR), 'none') AS quality FROM documents LEFT JOIN labels USING (doc_id)) SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(source) = 0 THEN 'source' WHEN grouping(quality) = 0 THEN 'quality' ELSE 'total' END AS label, coalesce(lang, source, quality, '') AS value, count(*) AS n FROM r GROUP BY GROUPING SETS ((lang), (source), (quality), ())",
    "q_prf1": "WITH g AS (SELECT DISTINCT item_id % 4 AS k, unnest(string_split(lower(text), ' ')) AS w FROM benchmark), p AS (SELECT DISTINCT doc_id % 4 AS k, unnest(string_split(lower(text), ' ')) AS w FROM documents), j AS (SELECT count(*) FILTER (WHERE g.k IS NOT NULL AND p.k IS NOT NULL) AS tp, count(*) FILTER (WHERE g.k IS NULL) AS fp, count(*) FILTER (WHERE p.k IS NULL) AS fn FROM (SELECT * FROM g WHERE w <> '') g FULL JOIN (SELECT * FROM p WHERE w <> '') p ON g.k = p.k AND g.w = p.w) SELECT tp, fp, fn, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 9) AS f1 FROM j",
    "q_keys_without": "SELECT user_id FROM events GROUP BY 1 HAVING NOT coalesce(bool_or(event_type = 'purchase' AND value > 90), false)",
    "q_keep_first": "SELECT lang, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM (SELECT lang, text, min(doc_id) AS doc_id FROM documents GROUP BY ALL) GROUP BY 1",
    "q_first_label": "SELECT user_id, event_type AS label FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1",
    "q_fallback_chain": "SELECT CASE WHEN n_chars > 2000 THEN 'full' ELSE 'short' END AS source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE n_chars > 500 GROUP BY 1",
    "q_batching": "WITH b AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7 AS batch FROM documents) SELECT source, batch, count(*) AS n, min(doc_id) AS \"first\" FROM b GROUP BY ALL",
    "q_running_total": "SELECT event_id, CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events",
    "q_views_split": f"WITH {_QC}, v AS (SELECT 'all' AS view, doc_id FROM qc UNION ALL SELECT 'kept', doc_id FROM qc WHERE action = 'KEEP' UNION ALL SELECT 'excluded', doc_id FROM qc WHERE starts_with(action, 'EXCLUDE') UNION ALL SELECT 'review', doc_id FROM qc WHERE starts_with(action, 'REVIEW') UNION ALL SELECT 'german', doc_id FROM qc WHERE lang = 'de') SELECT view, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM v GROUP BY 1",
    "q_stub_upsert": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS known, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "q_stream_append": "SELECT event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total FROM events WHERE value IS NOT NULL GROUP BY 1",
    "q_flagship": f"WITH {_QC}, f AS (SELECT lang, text, min(doc_id) AS doc_id FROM documents GROUP BY ALL) SELECT qc.lang, action, coalesce(quality, -1) AS quality, count(*) AS n FROM f JOIN qc USING (doc_id) LEFT JOIN labels USING (doc_id) GROUP BY ALL",
}
