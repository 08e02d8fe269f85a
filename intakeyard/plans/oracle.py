"""DuckDB oracle SQL per registered query (same result columns, same names).

Stand-ins come from the shared SQL text; every fact about the JSON lines is
computed with DuckDB's own JSON functions or from the defect table by ``k % 97``,
never with the Spark code under test.
"""

from __future__ import annotations

from itertools import combinations

from intakeyard.sources.standins import CSV_HEADER, with_clause

ORACLE: dict[str, str] = {}

# Expected first-failing-rule text for each injected defect (k % 97).
FIELD_SET_EXTRA = ("unexpected field set: country,founded,id,industry,linkedin_url,locality,"
                   "name,new_vendor_field,region,size,website")
FIELD_SET_MISSING = ("unexpected field set: country,founded,id,industry,linkedin_url,locality,"
                     "name,region,website")

FIRST_RULE_CASE = f"""CASE
  WHEN k % 97 = 1 THEN 'malformed JSON'
  WHEN k % 97 = 2 THEN 'record must be an object'
  WHEN k % 97 = 3 THEN 'blank line skipped'
  WHEN k % 97 = 4 THEN '{FIELD_SET_EXTRA}'
  WHEN k % 97 = 5 THEN '{FIELD_SET_MISSING}'
  WHEN k % 97 = 6 THEN 'id must be a non-empty string'
  WHEN k % 97 = 7 THEN 'name must be a non-empty string'
  WHEN k % 97 IN (8, 9, 10, 13) THEN 'founded must be an integer or null'
  WHEN k % 97 = 14 THEN 'industry must be a string or null'
  WHEN k % 97 = 15 THEN 'website must be a string or null'
  ELSE 'valid' END"""

RULE_KEY_CASE = """CASE
  WHEN k % 97 = 1 THEN 'malformed' WHEN k % 97 = 2 THEN 'object'
  WHEN k % 97 IN (4, 5) THEN 'field_set' WHEN k % 97 = 6 THEN 'id' WHEN k % 97 = 7 THEN 'name'
  WHEN k % 97 IN (8, 9, 10, 13) THEN 'founded' WHEN k % 97 = 14 THEN 'industry'
  WHEN k % 97 = 15 THEN 'website' END"""

STRICT_ROWS = """SELECT line_no, CASE WHEN k % 97 = 17 THEN '0' ELSE id END AS id, website, name,
  CAST(CASE k % 97 WHEN 11 THEN 2020 WHEN 12 THEN 1000 ELSE founded END AS INTEGER) AS founded,
  size, locality, region, country, industry, linkedin_url
FROM vendor_rec WHERE k % 97 NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 13, 14, 15)"""

STRING_FIELDS = ("id", "website", "name", "size", "locality", "region", "country", "industry",
                 "linkedin_url")
ALL_FIELDS = ("id", "website", "name", "founded", "size", "locality", "region", "country",
              "industry", "linkedin_url")

JSON_TYPE_LABEL = """CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN 'number' WHEN 'ARRAY' THEN 'array'
  WHEN 'OBJECT' THEN 'object' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
  WHEN 'HUGEINT' THEN 'integer' ELSE lower(t) END"""


def _vendor(*names: str) -> str:
    return with_clause(("vendor_rec", "vendor_json") + names)


def _typed_kv(source: str) -> str:
    """CTEs ``obj`` (object lines) and ``typed`` (line_no, field, jt) over ``source``."""
    return f""", obj AS (SELECT line_no, value FROM {source}
             WHERE json_valid(value) AND json_type(value) = 'OBJECT'),
kv AS (SELECT line_no, k AS field, json_type(value, '$."' || k || '"') AS t
       FROM (SELECT line_no, value, unnest(json_keys(value)) AS k FROM obj)),
typed AS (SELECT line_no, field, {JSON_TYPE_LABEL} AS jt FROM kv)"""


def _field_types(prefix: str, source: str) -> str:
    return (prefix + _typed_kv(source)
            + "\nSELECT field, jt AS json_type, count(*) AS n FROM typed GROUP BY field, jt")


def _field_profile(prefix: str, source: str) -> str:
    return (prefix + _typed_kv(source) + """
SELECT field, string_agg(DISTINCT jt, ',' ORDER BY jt) AS observed_types,
  count(*) FILTER (WHERE jt = 'null') AS null_count, count(*) AS observed_count,
  count(*) FILTER (WHERE jt IN ('array', 'object')) AS structured_count,
  min(line_no) = (SELECT min(line_no) FROM obj) AS in_first_record
FROM typed GROUP BY field""")


EVENTS_SRC = ", ev AS (SELECT event_id AS line_no, props AS value FROM events)"

ORACLE.update({
    "jsonl_positions": _vendor() + "\nSELECT line_no, value FROM vendor_json",
    "json_decode_status": _vendor() + """
SELECT line_no, CASE WHEN NOT json_valid(value) THEN 'malformed'
  WHEN json_type(value) <> 'OBJECT' THEN 'not_object' ELSE 'object' END AS decode_status
FROM vendor_json""",
    "first_rule_by_line": _vendor() + f"\nSELECT line_no, {FIRST_RULE_CASE} AS rule FROM vendor_rec",
    "rule_violations": _vendor() + f"""
SELECT rule, count(*) AS n_lines FROM (SELECT {RULE_KEY_CASE} AS rule FROM vendor_rec)
WHERE rule IS NOT NULL GROUP BY rule""",
    "strict_import_rows": _vendor() + "\n" + STRICT_ROWS,
    "schema_drift": _vendor() + """
SELECT line_no, CASE WHEN k % 97 = 5 THEN 'size' ELSE '' END AS missing_fields,
  CASE WHEN k % 97 = 4 THEN 'new_vendor_field' ELSE '' END AS extra_fields
FROM vendor_rec WHERE k % 97 IN (4, 5)""",
    "null_vs_empty": _vendor() + f", strict AS ({STRICT_ROWS})\n" + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, count(*) FILTER (WHERE {f} IS NULL) AS n_null, "
        f"count(*) FILTER (WHERE {f} = '') AS n_empty FROM strict" for f in STRING_FIELDS),
    "json_field_types": _field_types(_vendor(), "vendor_json"),
    "json_field_profile": _field_profile(_vendor(), "vendor_json"),
    "props_field_types": _field_types("WITH x AS (SELECT 1)" + EVENTS_SRC, "ev"),
    "props_field_profile": _field_profile("WITH x AS (SELECT 1)" + EVENTS_SRC, "ev"),
    "duplicate_ids": _vendor() + _typed_kv("vendor_json") + """
SELECT count(*) AS n_keys, count(*) - count(DISTINCT id) AS duplicate_ids
FROM (SELECT json_extract_string(value, '$.id') AS id FROM obj
      WHERE json_type(value, '$.id') = 'VARCHAR')""",
    "key_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "required_field_counts": _vendor() + f", strict AS ({STRICT_ROWS})" + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE id IS NULL OR id = '') AS missing_ids,
  count(*) FILTER (WHERE name IS NULL OR name = '') AS missing_names FROM strict""",
    "vendor_profile": _vendor() + f", strict AS ({STRICT_ROWS})\nSELECT min(founded) AS founded_min,"
    " max(founded) AS founded_max, count(*) FILTER (WHERE contains(website, '/'))"
    " AS websites_with_slash, " + ", ".join(f"count({f}) AS non_null_{f}" for f in ALL_FIELDS)
    + " FROM strict",
    "sample_records": _vendor() + "\nSELECT line_no, value FROM vendor_json WHERE line_no <= 3",
})


# ---- C. compare -------------------------------------------------------------

def _eq_sql(f: str) -> str:
    t = f"json_type(jv, '$.{f}')"
    if f == "founded":
        cv = "TRY_CAST(nullif(c.founded, '') AS INTEGER)"
        jd = (f"CASE WHEN {t} = 'BOOLEAN' THEN CASE WHEN json_extract_string(jv, '$.{f}') = 'true'"
              f" THEN 1.0 ELSE 0.0 END ELSE TRY_CAST(json_extract_string(jv, '$.{f}') AS DOUBLE) END")
        typed = f"{t} IN ('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE', 'BOOLEAN') AND CAST({cv} AS DOUBLE) = {jd}"
    else:
        cv = f"nullif(c.{f}, '')"
        typed = f"{t} = 'VARCHAR' AND {cv} = json_extract_string(jv, '$.{f}')"
    return (f"coalesce(CASE WHEN {cv} IS NULL THEN ({t} IS NULL OR {t} = 'NULL') "
            f"ELSE ({typed}) END, false)")


def _compare_ctes(window: int | None = None) -> str:
    wf = f" WHERE c.pos <= {window}" if window else ""
    id_match = ("coalesce(CASE WHEN c.id IS NULL THEN (json_type(jv, '$.id') IS NULL OR "
                "json_type(jv, '$.id') = 'NULL') ELSE (json_type(jv, '$.id') = 'VARCHAR' AND "
                "c.id = json_extract_string(jv, '$.id')) END, false)")
    eqs = ", ".join(f"{_eq_sql(f)} AS eq_{f}" for f in CSV_HEADER)
    structured = " + ".join(
        f"CASE WHEN json_type(jv, '$.{f}') IN ('ARRAY', 'OBJECT') THEN 1 ELSE 0 END" for f in CSV_HEADER)
    mms = ", ".join(f"(id_match AND NOT eq_{f}) AS mm_{f}" for f in CSV_HEADER)
    return (with_clause(("vendor_rec", "vendor_json", "vendor_csv")) + f""",
j AS (SELECT line_no AS pos, CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT'
        THEN value ELSE '{{}}' END AS jv FROM vendor_json),
b AS (SELECT c.pos, c.n_cells, {id_match} AS id_match, {eqs},
        (nullif(c.founded, '') IS NOT NULL AND TRY_CAST(nullif(c.founded, '') AS INTEGER) IS NULL)
          AS bad_founded,
        {structured} AS structured,
        CASE WHEN json_type(jv, '$.id') = 'VARCHAR' THEN json_extract_string(jv, '$.id') END AS json_id
      FROM vendor_csv c JOIN j ON j.pos = c.pos{wf}),
r AS (SELECT *, {mms}, (id_match AND bad_founded) AS founded_not_integer FROM b)""")


def _field_mismatch_sql(window: int | None = None) -> str:
    return _compare_ctes(window) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, count(*) AS n FROM r WHERE mm_{f}" for f in CSV_HEADER
    ).replace("count(*) AS n FROM r WHERE", "count(*) AS n FROM r WHERE") + ""


def _nonzero(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE n > 0"


ORACLE.update({
    "positional_compare": _compare_ctes() + "\nSELECT pos, id_match, concat_ws(',', "
    + ", ".join(f"CASE WHEN mm_{f} THEN '{f}' END" for f in sorted(CSV_HEADER))
    + ") AS mismatched_fields FROM r",
    "compare_summary": _compare_ctes() + """
SELECT count(*) AS records_compared, count(*) FILTER (WHERE NOT id_match) AS id_mismatches,
  count(*) FILTER (WHERE n_cells > 10) AS malformed_csv_rows,
  count(*) FILTER (WHERE founded_not_integer) AS founded_not_integer,
  CAST(coalesce(sum(structured), 0) AS BIGINT) AS structured_values,
  count(json_id) - count(DISTINCT json_id) AS duplicate_json_ids,
  (SELECT count(*) FROM vendor_csv) AS csv_records,
  (SELECT count(*) FROM vendor_json) AS json_records
FROM r""",
    "first_divergence": _compare_ctes() + """
SELECT min(pos) FILTER (WHERE n_cells > 10) AS first_malformed_row,
  min(pos) FILTER (WHERE NOT id_match) AS first_id_mismatch FROM r""",
    "csv_normalized": with_clause(("vendor_rec", "vendor_csv")) + "\nSELECT pos, " + ", ".join(
        (f"TRY_CAST(nullif({f}, '') AS INTEGER) AS {f}" if f == "founded" else f"nullif({f}, '') AS {f}")
        for f in CSV_HEADER) + ", (nullif(founded, '') IS NOT NULL AND TRY_CAST(nullif(founded, '') AS"
    " INTEGER) IS NULL) AS founded_not_integer FROM vendor_csv",
})
ORACLE["field_mismatches"] = _nonzero(_field_mismatch_sql())
ORACLE["compare_window"] = _nonzero(_field_mismatch_sql(1000))


# ---- D. ledger ---------------------------------------------------------------

REG = with_clause(("reg_files", "reg_stored", "reg_requested", "reg_snapshots", "reg_snapshots_requested", "runs",
                   "source_before", "source_after"))
DIFFERS = " OR ".join(f"s.{f} IS DISTINCT FROM r.{f}" for f in (
    "snapshot_id", "role", "filename", "object_key", "format", "sha256", "byte_size"))
SHARES = "(s.sha256 = r.sha256 OR s.object_key = r.object_key)"



def _differences(requested: str, stored: str, keys: tuple[str, ...], fields: tuple[str, ...]) -> str:
    same_key = " AND ".join(f"s.{k} = r.{k}" for k in keys)
    listed = ", ".join(f"CASE WHEN s.{f} IS DISTINCT FROM r.{f} THEN '{f}' END" for f in fields)
    return f"""
SELECT {", ".join(f"coalesce(r.{k}, s.{k}) AS {k}" for k in keys)}, CASE WHEN s.snapshot_id IS NULL THEN 'new' WHEN r.snapshot_id IS NULL THEN 'unexpected'
  WHEN concat_ws(',', {listed}) = '' THEN 'verified' ELSE 'conflict' END AS status,
  CASE WHEN s.snapshot_id IS NULL OR r.snapshot_id IS NULL THEN '' ELSE concat_ws(',', {listed}) END AS fields
FROM {requested} r FULL JOIN {stored} s ON {same_key}"""


ORACLE.update({
    "file_differences": REG + _differences(
        "reg_requested", "(SELECT * FROM reg_stored WHERE snapshot_id IN (SELECT snapshot_id FROM reg_requested))", ("snapshot_id", "role"),
        ("filename", "object_key", "format", "sha256", "byte_size")),
    "snapshot_differences": REG + _differences("reg_snapshots_requested", "reg_snapshots", ("snapshot_id",), (
        "source", "dataset", "acquired_at", "manifest_key", "source_url", "description")),
    "artifact_reconcile": REG + """
SELECT r.object_key, r.byte_size AS length, r.sha256, CASE WHEN s.file_id IS NULL THEN 'write'
  WHEN s.byte_size = r.byte_size AND s.sha256 = r.sha256 THEN 'reuse' ELSE 'collision' END AS action
FROM reg_requested r LEFT JOIN reg_stored s ON s.object_key = r.object_key""",
    "artifact_drift": REG + """
SELECT coalesce(b.path, a.path) AS path, b.path IS NULL OR a.path IS NULL OR b.length <> a.length OR b.modified <> a.modified AS changed
FROM source_before b FULL JOIN source_after a ON a.path = b.path""",
    "resolve_artifact": REG + """
SELECT request_file_id, snapshot_id, file_id FROM (
  SELECT r.file_id AS request_file_id, s.snapshot_id, s.file_id,
    row_number() OVER (PARTITION BY r.file_id ORDER BY s.snapshot_id, s.file_id) AS rn
  FROM reg_requested r JOIN reg_stored s ON s.sha256 = r.sha256 AND s.byte_size = r.byte_size
  WHERE s.format = 'txt' AND s.snapshot_id IN (SELECT snapshot_id FROM reg_snapshots)) WHERE rn = 1""",
    "artifact_collisions": REG + f"""
SELECT * FROM (SELECT r.file_id,
  (SELECT count(*) FROM reg_stored s WHERE s.sha256 = r.sha256) AS hash_matches,
  (SELECT count(*) FROM reg_stored s WHERE s.object_key = r.object_key) AS key_matches,
  EXISTS (SELECT 1 FROM reg_stored s WHERE {SHARES} AND s.snapshot_id <> r.snapshot_id) AS other_snapshot
  FROM reg_requested r) WHERE hash_matches > 0 OR key_matches > 0""",
    "ledger_reconcile": REG + f"""
SELECT r.file_id, CASE
  WHEN NOT EXISTS (SELECT 1 FROM reg_stored s WHERE {SHARES}) THEN 'new'
  WHEN r.snapshot_id NOT IN (SELECT snapshot_id FROM reg_snapshots) THEN 'collision'
  WHEN NOT EXISTS (SELECT 1 FROM reg_stored s WHERE {SHARES} AND ({DIFFERS})) THEN 'verified'
  ELSE 'conflict' END AS status
FROM reg_requested r""",
    "unexpected_roles": REG + """
SELECT s.snapshot_id, s.role FROM reg_stored s
WHERE s.snapshot_id IN (SELECT snapshot_id FROM reg_requested)
  AND NOT EXISTS (SELECT 1 FROM reg_requested r WHERE r.snapshot_id = s.snapshot_id AND r.role = s.role)""",
    "register_files": REG + f"""
SELECT r.file_id, r.snapshot_id, r.role,
  CASE WHEN EXISTS (SELECT 1 FROM reg_stored s WHERE s.snapshot_id = r.snapshot_id AND s.role = r.role)
       THEN 'verify' ELSE 'insert' END AS action,
  CASE WHEN NOT EXISTS (SELECT 1 FROM reg_stored s WHERE s.snapshot_id = r.snapshot_id AND s.role = r.role)
       THEN NULL
       ELSE NOT EXISTS (SELECT 1 FROM reg_stored s WHERE s.snapshot_id = r.snapshot_id AND s.role = r.role
                        AND ({DIFFERS})) END AS matches_stored
FROM reg_requested r""",
    "supersede_runs": REG + """
SELECT run_id, target,
  CASE WHEN status = 'running' AND target = 't7' THEN 'failed' ELSE status END AS status,
  CASE WHEN status = 'running' AND target = 't7'
       THEN 'Superseded after a prior importer process ended' END AS error
FROM runs""",
    "finish_run": REG + """, n AS (SELECT l_orderkey AS run_id, count(*) FILTER (WHERE l_returnflag = 'R') AS n
  FROM lineitem GROUP BY l_orderkey),
q AS (SELECT runs.run_id, runs.status AS prior_status, coalesce(n.n, 0) AS cnt FROM runs LEFT JOIN n USING (run_id))
SELECT run_id, prior_status,
  CASE WHEN prior_status = 'running' THEN CASE WHEN cnt > 0 THEN 'succeeded' ELSE 'failed' END
       ELSE prior_status END AS status,
  CASE WHEN prior_status = 'running' AND cnt > 0 THEN cnt END AS row_count,
  CASE WHEN prior_status = 'running' AND cnt = 0 THEN 'no returned lines for run ' || CAST(run_id AS VARCHAR) END AS error,
  prior_status = 'running' AS applied
FROM q""",
    "current_version": REG + """
SELECT target, run_id, CAST(started_at AS VARCHAR) AS started_at, row_count FROM runs
WHERE status = 'succeeded'
QUALIFY row_number() OVER (PARTITION BY target ORDER BY started_at DESC, run_id DESC) = 1""",
    "lineage": REG + """, cur AS (SELECT target, run_id FROM runs WHERE status = 'succeeded'
  QUALIFY row_number() OVER (PARTITION BY target ORDER BY started_at DESC, run_id DESC) = 1),
f AS (SELECT snapshot_id, count(*) AS n_files, CAST(sum(byte_size) AS BIGINT) AS total_bytes
  FROM reg_files GROUP BY snapshot_id)
SELECT cur.target, cur.run_id, 'src' || substr(cur.target, 2) AS snapshot_id, s.dataset, s.acquired_at,
  coalesce(CASE WHEN s.snapshot_id IS NOT NULL THEN f.n_files END, 0) AS n_files,
  coalesce(CASE WHEN s.snapshot_id IS NOT NULL THEN f.total_bytes END, 0) AS total_bytes
FROM cur LEFT JOIN reg_snapshots s ON s.snapshot_id = 'src' || substr(cur.target, 2) LEFT JOIN f ON f.snapshot_id = s.snapshot_id""",
    "fk_orphans": REG + """
SELECT 'lineitem.l_orderkey -> orders[o_orderstatus <> P]' AS edge, count(*) AS child_rows,
  count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN
    (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IS NOT NULL)) AS orphan_rows
FROM lineitem
UNION ALL
SELECT 'orders.o_custkey -> customer', count(*), count(*) FILTER (WHERE o_custkey IS NOT NULL AND
  o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)) FROM orders
UNION ALL
SELECT 'labels.doc_id -> documents', count(*), count(*) FILTER (WHERE doc_id IS NOT NULL AND
  doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)) FROM labels
UNION ALL
SELECT 'reg_requested.snapshot_id -> reg_snapshots', count(*), count(*) FILTER (WHERE snapshot_id IS NOT NULL
  AND snapshot_id NOT IN (SELECT snapshot_id FROM reg_snapshots WHERE snapshot_id IS NOT NULL))
FROM reg_requested""",
    "checksum_ledger": REG + """
SELECT e.file_id AS version, CASE WHEN s.file_id IS NULL THEN 'pending'
  WHEN e.filename IS NOT DISTINCT FROM s.filename AND e.sha256 IS NOT DISTINCT FROM s.sha256 THEN 'applied'
  ELSE 'changed' END AS status
FROM reg_requested e LEFT JOIN reg_stored s ON s.file_id = e.file_id""",
    "ledger_expectations": REG + """
SELECT 'files.sha256_not_hex64' AS "check",
  count(*) FILTER (WHERE NOT coalesce(regexp_full_match(sha256, '[0-9a-f]{64}'), false)) AS n_violations
FROM reg_files
UNION ALL SELECT 'files.negative_byte_size', count(*) FILTER (WHERE coalesce(byte_size < 0, true)) FROM reg_files
UNION ALL SELECT 'files.empty_text', count(*) FILTER (WHERE coalesce(snapshot_id, '') = '' OR
  coalesce(role, '') = '' OR coalesce(filename, '') = '' OR coalesce(object_key, '') = '' OR
  coalesce(format, '') = '') FROM reg_files
UNION ALL SELECT 'runs.unknown_status', count(*) FILTER (WHERE NOT coalesce(status IN ('running', 'succeeded', 'failed'), false)) FROM runs
UNION ALL SELECT 'runs.negative_row_count', count(*) FILTER (WHERE coalesce(row_count < 0, false)) FROM runs
UNION ALL SELECT 'runs.empty_text', count(*) FILTER (WHERE coalesce(target, '') = '') FROM runs
UNION ALL SELECT 'snapshots.empty_text', count(*) FILTER (WHERE '' IN (coalesce(snapshot_id, ''), coalesce(source, ''), coalesce(dataset, ''),
  coalesce(acquired_at, ''), coalesce(manifest_key, ''), coalesce(source_url, ''))) FROM reg_snapshots
UNION ALL SELECT 'snapshots.surplus_snapshot_id', count(*) - count(DISTINCT snapshot_id) FROM reg_snapshots
UNION ALL SELECT 'snapshots.surplus_manifest_key', count(*) - count(DISTINCT manifest_key) FROM reg_snapshots
UNION ALL SELECT 'snapshots.surplus_source_dataset_acquired', count(*) - count(DISTINCT (source, dataset, acquired_at)) FROM reg_snapshots
UNION ALL SELECT 'files.surplus_sha256', count(*) - (SELECT count(*) FROM (SELECT DISTINCT sha256 FROM reg_files)) FROM reg_files
UNION ALL SELECT 'files.surplus_object_key', count(*) - (SELECT count(*) FROM (SELECT DISTINCT object_key FROM reg_files)) FROM reg_files
UNION ALL SELECT 'files.surplus_snapshot_role', count(*) - (SELECT count(*) FROM (SELECT DISTINCT snapshot_id, role FROM reg_files)) FROM reg_files
UNION ALL SELECT 'files.surplus_file_id', count(*) - (SELECT count(*) FROM (SELECT DISTINCT file_id FROM reg_files)) FROM reg_files
UNION ALL SELECT 'runs.surplus_run_id', count(*) - (SELECT count(*) FROM (SELECT DISTINCT run_id FROM runs)) FROM runs""",
})


# ---- K. verdict and publish ----------------------------------------------------

_VALID_KEY = f"CASE WHEN ({FIRST_RULE_CASE}) = 'valid' THEN CASE WHEN k % 97 = 17 THEN '0' ELSE id END END"
COMPANY_COLS = ", ".join(ALL_FIELDS)

ORACLE.update({
    "load_verdict": _vendor() + f""", v AS (SELECT line_no, {FIRST_RULE_CASE} AS rule, {_VALID_KEY} AS key, name
  FROM vendor_rec),
m AS (SELECT count(*) AS lines, count(*) FILTER (WHERE rule = 'blank line skipped') AS blank_lines,
  count(*) FILTER (WHERE rule = 'valid') AS valid_rows,
  count(*) FILTER (WHERE rule NOT IN ('valid', 'blank line skipped')) AS violations,
  min(line_no) FILTER (WHERE rule NOT IN ('valid', 'blank line skipped')) AS first_violation_line,
  arg_min(rule, line_no) FILTER (WHERE rule NOT IN ('valid', 'blank line skipped')) AS first_violation,
  count(*) FILTER (WHERE rule = 'valid' AND (key IS NULL OR key = '')) AS missing_ids,
  count(*) FILTER (WHERE rule = 'valid' AND coalesce(name, '') = '') AS missing_names FROM v),
d AS (SELECT count(key) - count(DISTINCT key) AS duplicate_ids FROM v)
SELECT m.*, d.duplicate_ids,
  CASE WHEN violations > 0 OR valid_rows = 0 OR duplicate_ids > 0 OR missing_ids > 0 OR missing_names > 0 THEN 'reject' ELSE 'accept' END AS verdict,
  CASE WHEN violations > 0 THEN 'line ' || CAST(first_violation_line AS VARCHAR) || ': ' || first_violation
       WHEN valid_rows = 0 THEN 'import produced no rows'
       WHEN missing_ids > 0 THEN CAST(missing_ids AS VARCHAR) || ' rows without an id'
       WHEN missing_names > 0 THEN CAST(missing_names AS VARCHAR) || ' rows without a name'
       WHEN duplicate_ids > 0 THEN CAST(duplicate_ids AS VARCHAR) || ' duplicate ids' END AS reason
FROM m, d""",
    "publish_roundtrip": with_clause(("vendor_rec",)) + f"\nSELECT {COMPANY_COLS} FROM vendor_rec",
    "point_lookup": with_clause(("vendor_rec",)) + f"""
SELECT {COMPANY_COLS}, 'id' AS lookup FROM vendor_rec WHERE id = '7'
UNION ALL SELECT {COMPANY_COLS}, 'website' FROM vendor_rec WHERE website = 'c8.example.com'
UNION ALL SELECT {COMPANY_COLS}, 'linkedin_url' FROM vendor_rec WHERE linkedin_url = 'linkedin.com/company/10'""",
    "orphan_stages": REG + "\nSELECT run_id, target, status FROM runs WHERE status <> 'succeeded'",
    "orphan_folders": REG + "\nSELECT CAST(run_id AS VARCHAR) AS run_id FROM runs WHERE target = 't7' AND status <> 'succeeded'",
})


# ---- X. scalars ------------------------------------------------------------------

def _fb(x: str) -> str:
    units = [("KiB", 1024), ("MiB", 1024 ** 2), ("GiB", 1024 ** 3)]
    sql = f"CASE WHEN {x} < 0 THEN NULL WHEN {x} < 1024 THEN CAST({x} AS VARCHAR) || ' B' "
    for (u, d), nxt in zip(units, [1024 ** 2, 1024 ** 3, 1024 ** 4]):
        sql += f"WHEN {x} < {nxt} THEN printf('%.2f', {x} / {d}) || ' {u}' "
    return sql + f"ELSE printf('%.2f', {x} / {1024 ** 4}) || ' TiB' END"


ISO = r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?"
SCHEME = "[A-Za-z][A-Za-z0-9+.-]*"

ORACLE.update({
    "format_bytes": "SELECT doc_id, " + ", ".join(
        f"{_fb(f'(n_chars * {m})')} AS size_x{m}" for m in (1, 1000, 1000000, 1000000000)) + " FROM documents",
    "row_fingerprint": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "redact_literals": """SELECT doc_id, length(r) AS n_chars_after, sha256(r) AS sha256_after FROM (
  SELECT doc_id, replace(replace(replace(text, 'der', '[redacted]'), 'que', '[redacted]'), 'und', '[redacted]') AS r
  FROM documents)""",
    "url_target": f"""SELECT page_id, scheme, host, path, has_credentials,
  regexp_replace(scheme || '://' || host || path, '/+$', '') AS target FROM (
  SELECT page_id, regexp_extract(url, '^({SCHEME})://', 1) AS scheme,
    regexp_extract(url, '^{SCHEME}://(?:[^@/?#]*@)?([^:/?#]*)', 1) AS host,
    regexp_extract(url, '^{SCHEME}://[^/?#]*([^?#]*)', 1) AS path,
    regexp_matches(url, '^{SCHEME}://[^/?#]*@') AS has_credentials FROM pages)""",
    "acquired_at_utc": f"""SELECT o_orderkey, t AS acquired_at,
  CASE WHEN regexp_full_match(t, '{ISO}') THEN strftime(
    CAST(replace(substr(t, 1, 19), 'T', ' ') AS TIMESTAMP) - to_minutes(
      CASE WHEN length(t) > 19 AND substr(t, 20, 1) IN ('+', '-')
           THEN (CASE WHEN substr(t, 20, 1) = '-' THEN -1 ELSE 1 END)
                * (CAST(substr(t, 21, 2) AS INTEGER) * 60 + CAST(substr(t, 24, 2) AS INTEGER))
           ELSE 0 END), '%Y-%m-%d %H:%M:%S') END AS acquired_at_utc
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE
    WHEN o_orderkey % 97 = 0 THEN '-xx' WHEN o_orderkey % 5 = 0 THEN ''
    WHEN o_orderkey % 5 = 1 THEN 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00Z'
    WHEN o_orderkey % 5 = 2 THEN 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00+02:00'
    WHEN o_orderkey % 5 = 3 THEN 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00-05:00'
    ELSE 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00' END AS t FROM orders)""",
    "versioned_names": """SELECT o_orderpriority,
  CASE WHEN regexp_matches(o_orderpriority, '^([0-9]+)-(.*)$')
       THEN CAST(regexp_extract(o_orderpriority, '^([0-9]+)-(.*)$', 1) AS BIGINT) END AS version,
  CASE WHEN regexp_matches(o_orderpriority, '^([0-9]+)-(.*)$')
       THEN regexp_extract(o_orderpriority, '^([0-9]+)-(.*)$', 2) END AS name,
  regexp_matches(o_orderpriority, '^([0-9]+)-(.*)$') AS valid, count(*) AS n
FROM orders GROUP BY ALL""",
    "render_values": """SELECT doc_id, CASE WHEN length(j) <= 80 THEN j ELSE substr(j, 1, 79) || '…' END AS rendered
FROM (SELECT doc_id, CAST(to_json(text) AS VARCHAR) AS j FROM documents)""",
    "object_keys": """SELECT event_id, 'events/' || event_type || '/' || strftime(ts, '%Y-%m-%d') || '/'
  || CAST(event_id AS VARCHAR) || '.json' AS object_key FROM events""",
    "error_tail": """SELECT conv_id, turn, length(right(text, 4000)) AS tail_chars,
  sha256(right(text, 4000)) AS tail_sha256 FROM conversations""",
})


# ---- E. inventory ------------------------------------------------------------------

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
IN_TABLES = "(" + ", ".join(f"'{t}'" for t in TABLE_NAMES) + ")"
SPARK_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'FLOAT' THEN 'float' WHEN 'BOOLEAN' THEN 'boolean'
  ELSE lower(data_type) END"""
COLUMNS_SQL = f"""SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name,
  {SPARK_TYPE} AS data_type, is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name IN {IN_TABLES}"""


# The columns of the given tables that hold single values, in table order.
ATOMIC_COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "embeddings": ("vec_id", "label"),
    "pages": ("page_id", "url", "html"),
    "benchmark": ("item_id", "text"),
    "labels": ("doc_id", "quality", "toxic"),
    "conversations": ("conv_id", "turn", "role", "text"),
}


def _candidate_keys_sql() -> str:
    parts = [f"SELECT '{t}' AS table_name, '{c}' AS column_name FROM {t} "
             f"HAVING count(*) > 0 AND count({c}) = count(*) AND count(DISTINCT {c}) = count(*)"
             for t, cols in ATOMIC_COLUMNS.items() for c in cols]
    return "\nUNION ALL\n".join(parts)


def _composite_keys_sql(width: int = 3) -> str:
    """Every combination counted on its own; of the unique ones those that contain no other."""
    parts = []
    for t, cols in ATOMIC_COLUMNS.items():
        for k in range(1, width + 1):
            for c in combinations(range(len(cols)), k):
                names = [cols[i] for i in c]
                whole = " AND ".join(f"count({n}) = count(*)" for n in names)
                parts.append(f"SELECT '{t}' AS t, {k} AS k, {sum(1 << i for i in c)} AS m, '{','.join(names)}' AS names, "
                             f"count(*) > 0 AND {whole} AND count(DISTINCT ({', '.join(names)})) = count(*) AS u FROM {t}")
    union = "\nUNION ALL\n".join(parts)
    return f"""WITH c AS MATERIALIZED ({union})
SELECT a.t AS table_name, a.k AS n_columns, a.names AS key_columns FROM c a
WHERE a.u AND NOT EXISTS (SELECT 1 FROM c b WHERE b.t = a.t AND b.u AND b.m <> a.m AND (a.m & b.m) = b.m)"""


ORACLE.update({
    "inv_relations": f"""SELECT table_name, CAST(count(*) AS INTEGER) AS n_columns
FROM information_schema.columns WHERE table_name IN {IN_TABLES} GROUP BY table_name""",
    "inv_columns": COLUMNS_SQL,
    "inv_exact_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS exact_rows FROM {t}" for t in TABLE_NAMES),
    "inv_bounded_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS exact_rows, CAST(NULL AS VARCHAR) AS count_error FROM {t}"
        for t in TABLE_NAMES),
})
ORACLE["inv_candidate_keys"] = _candidate_keys_sql()
ORACLE["inv_composite_keys"] = _composite_keys_sql()
ORACLE["inv_nested"] = f"""WITH c AS ({COLUMNS_SQL}), k AS ({_candidate_keys_sql()})
SELECT c.table_name, CAST(count(*) AS INTEGER) AS n_columns,
  string_agg(column_name || ':' || data_type, ',' ORDER BY position) AS columns,
  coalesce((SELECT string_agg(k.column_name, ',' ORDER BY k.column_name) FROM k
            WHERE k.table_name = c.table_name), '') AS candidate_keys
FROM c GROUP BY c.table_name"""


# ---- S, K6, A17, P8 ------------------------------------------------------------------

EXPECTED_ORDER = "[" + ", ".join(f"'{f}'" for f in ALL_FIELDS) + "]"
MANIFEST_LINE = ("'{\"bytes\":' || CAST(byte_size AS VARCHAR) || ',\"filename\":\"' || filename || "
                 "'\",\"format\":\"' || format || '\",\"object_key\":\"' || object_key || "
                 "'\",\"role\":\"' || role || '\",\"sha256\":\"' || sha256 || '\"}'")
DECLARED_ROWS = [("orders", i + 1, n, t) for i, (n, t) in enumerate(
    [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
     ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")])] + [
    ("lineitem", i + 1, n, t) for i, (n, t) in enumerate(
        [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
         ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
         ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
         ("l_shipdate", "timestamp_ntz")])]

DEFAULT_CELLS = "n_cells + CASE WHEN vendor_csv.k % 50 = 9 THEN 1 ELSE 0 END"

ORACLE.update({
    "csv_vendor_scan": with_clause(("vendor_csv",)) + "\nSELECT pos, " + ", ".join(CSV_HEADER) + ", n_cells FROM vendor_csv",
    # By the default dialect a quote after a backslash ends its cell's quoting: a comma behind it cuts the cell.
    "csv_default_scan": with_clause(("vendor_csv",)) + "\nSELECT pos, id, " + DEFAULT_CELLS + " AS n_cells FROM vendor_csv",
    "default_dialect_divergence": with_clause(("vendor_csv",)) + f"""
SELECT min(vendor_csv.pos) FILTER (WHERE {DEFAULT_CELLS} > 10) AS first_malformed_row, min(vendor_csv.pos) FILTER (WHERE vendor_csv.id <> r.id) AS first_id_mismatch
FROM vendor_csv JOIN vendor_rec r ON r.line_no = vendor_csv.pos""",
    "header_check": "SELECT '" + ",".join(CSV_HEADER) + "' AS header, 'yes' AS expected_header",
    "schema_probes": _vendor() + f""", n AS (SELECT count(*) AS n FROM vendor_json),
p AS (SELECT f AS fraction, CAST(floor(n * CAST(f AS DECIMAL(3, 2))) AS BIGINT) + 1 AS line_no
      FROM n, (VALUES ('0.00'), ('0.25'), ('0.50'), ('0.75'), ('0.99')) t(f))
SELECT p.fraction, p.line_no,
  coalesce(json_valid(v.value) AND json_type(v.value) = 'OBJECT', false) AS decoded,
  coalesce(json_valid(v.value) AND json_type(v.value) = 'OBJECT' AND json_keys(v.value) = {EXPECTED_ORDER}, false) AS order_ok
FROM p JOIN vendor_json v ON v.line_no = p.line_no""",
    "schema_order_check": _vendor() + f"""
SELECT count(*) AS objects, count(*) FILTER (WHERE json_keys(value) <> {EXPECTED_ORDER}) AS order_mismatches
FROM vendor_json WHERE json_valid(value) AND json_type(value) = 'OBJECT'""",
    "manifest_lines": REG + f"\nSELECT snapshot_id, role, {MANIFEST_LINE} AS line FROM reg_files",
    "manifest_per_snapshot": REG + f"""
SELECT snapshot_id, count(*) AS n_files, CAST(sum(byte_size) AS BIGINT) AS total_bytes,
  sha256(concat_ws(':', {", ".join(f"CAST(sum(CAST(('0x' || substr(sha256({MANIFEST_LINE}), {8 * i + 1}, 8)) AS BIGINT)) AS VARCHAR)" for i in range(8))},
    CAST(count(*) AS VARCHAR), CAST(CAST(sum(byte_size) AS BIGINT) AS VARCHAR))) AS manifest_digest
FROM reg_files GROUP BY snapshot_id""",
    "plan_key_check": REG + """
SELECT snapshot_id, count(*) AS n_files, count(DISTINCT object_key) AS n_distinct_keys,
  count(*) = count(DISTINCT object_key) AS keys_distinct FROM reg_files GROUP BY snapshot_id""",
    "schema_assert": f"""WITH e(table_name, position, expected_column, expected_type) AS (VALUES {", ".join(
        f"('{t}', {p}, '{n}', '{ty}')" for t, p, n, ty in DECLARED_ROWS)}),
o AS (SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name AS observed_column,
        {SPARK_TYPE} AS observed_type FROM information_schema.columns WHERE table_name IN ('orders', 'lineitem'))
SELECT coalesce(e.table_name, o.table_name) AS table_name, coalesce(e.position, o.position) AS position,
  e.expected_column, e.expected_type, o.observed_column, o.observed_type,
  e.expected_column IS NOT DISTINCT FROM o.observed_column AND e.expected_type IS NOT DISTINCT FROM o.observed_type AS matches
FROM e FULL OUTER JOIN o ON e.table_name = o.table_name AND e.position = o.position""",
})


# ---- K4, D1, D2, S14: the stored ledger -------------------------------------------------------

# Unique contents, so every file of the first request is stored; the second is judged against them.
_JUDGED = with_clause(("reg_first", "reg_second", "reg_first_snapshots", "reg_second_snapshots")) + """,
marked AS (SELECT r.*, s.role IS NOT NULL AS held, s.byte_size = r.byte_size AND s.sha256 = r.sha256 AS same,
             EXISTS (SELECT 1 FROM reg_first f WHERE f.sha256 = r.sha256) OR EXISTS (SELECT 1 FROM reg_first f WHERE f.object_key = r.object_key) AS owned
           FROM reg_second r LEFT JOIN reg_first s ON s.snapshot_id = r.snapshot_id AND s.role = r.role),
judged AS (SELECT *, CASE WHEN held AND same THEN 'verified' WHEN held THEN 'conflict'
             WHEN owned OR (snapshot_id || ' ' || role) <> (SELECT min(o.snapshot_id || ' ' || o.role) FROM marked o
                                                             WHERE o.sha256 = m.sha256 AND NOT o.held AND NOT o.owned) THEN 'collision'
             ELSE 'new' END AS status FROM marked m),
out AS (SELECT snapshot_id, role, sha256, byte_size, status,
          snapshot_id IN (SELECT snapshot_id FROM judged WHERE status IN ('conflict', 'collision'))
          OR snapshot_id IN (SELECT f.snapshot_id FROM reg_first_snapshots f JOIN reg_second_snapshots s USING (snapshot_id)
                             WHERE f.description IS DISTINCT FROM s.description) AS refused FROM judged)"""

ORACLE.update({
    "registration_outcomes": _JUDGED + "\nSELECT snapshot_id, role, status, refused FROM out",
    "ledger_registration": _JUDGED + """
SELECT snapshot_id, role, sha256, byte_size, CAST(1 AS BIGINT) AS commit FROM reg_first
UNION ALL SELECT snapshot_id, role, sha256, byte_size, CAST(2 AS BIGINT) FROM out WHERE status = 'new' AND NOT refused""",
})


# ---- K6, S8: the manifest's digests, probes by byte offset -----------------------------------------

# Up to 64 ** 4 lines: levels are counted until one holds a single node.
_TREE_LEVEL = """l{k} AS (SELECT CAST({k} AS INTEGER) AS level, node // 64 AS node, sha256(string_agg(digest, '' ORDER BY node)) AS digest,
  CAST(sum(size) AS BIGINT) AS size FROM {below} GROUP BY node // 64)"""
_DOCUMENT = REG + f""", d AS (SELECT row_number() OVER (ORDER BY snapshot_id, role) - 1 AS node, {MANIFEST_LINE} AS line FROM reg_files),
h AS (SELECT node, sha256(line) AS digest, 1 AS size FROM d)"""

ORACLE.update({
    "manifest_document": _DOCUMENT + "\nSELECT node + 1 AS line_no, line FROM d",
    "manifest_tree": _DOCUMENT + ",\n" + ",\n".join(_TREE_LEVEL.format(k=k, below=f"l{k - 1}" if k else "h") for k in range(4)) + """
SELECT * FROM l0 UNION ALL SELECT * FROM l1 WHERE (SELECT count(*) FROM l0) > 1
UNION ALL SELECT * FROM l2 WHERE (SELECT count(*) FROM l1) > 1 UNION ALL SELECT * FROM l3 WHERE (SELECT count(*) FROM l2) > 1""",
    "offset_probes": _vendor() + f""", b AS (SELECT line_no, value, CAST(sum(strlen(value) + 1) OVER (ORDER BY line_no) - strlen(value) - 1 AS BIGINT) AS begins,
  CAST(sum(strlen(value) + 1) OVER () AS BIGINT) AS total FROM vendor_json),
p AS (SELECT f AS fraction, (SELECT min(begins) FROM b WHERE begins > CAST(floor(b.total * CAST(f AS DOUBLE)) AS BIGINT) OR CAST(f AS DOUBLE) = 0) AS begins
      FROM (VALUES ('0.00'), ('0.25'), ('0.50'), ('0.75'), ('0.99')) t(f))
SELECT p.fraction, p.begins AS line_offset, coalesce(json_valid(b.value) AND json_type(b.value) = 'OBJECT', false) AS decoded,
  coalesce(json_valid(b.value) AND json_type(b.value) = 'OBJECT' AND json_keys(b.value) = {EXPECTED_ORDER}, false) AS order_ok
FROM p JOIN b ON b.begins = p.begins""",
})


# ---- R1: the inspection report, line by line from the oracles above ------------------------------------

def _number(x: str) -> str:
    return f"coalesce(format('{{:,}}', CAST({x} AS BIGINT)), 'none')"


def _report_lines(source: str, rank: int, section: str, *items: tuple[int, str, str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT {rank} AS section_rank, CAST({r} AS BIGINT) AS row_rank, '{section}' AS section, '{i}' AS item, {v} AS value FROM {source}"
                                for r, i, v in items)


_REPORT = f"""WITH head AS ({ORACLE["header_check"]}), probes AS ({ORACLE["schema_probes"]}), prof AS ({ORACLE["json_field_profile"]}),
samples AS ({ORACLE["sample_records"]}), summary AS ({ORACLE["compare_summary"]}), mism AS ({ORACLE["field_mismatches"]}),
div AS ({ORACLE["default_dialect_divergence"]}),
first AS ({_vendor()} SELECT json_keys(value) AS fields FROM vendor_json WHERE json_valid(value) AND json_type(value) = 'OBJECT' ORDER BY line_no LIMIT 1)"""

ORACLE["inspect_report"] = _REPORT + "\n" + "\nUNION ALL\n".join([
    _report_lines("head", 1, "csv", (1, "column order", "replace(header, ',', ', ')"), (2, "column order as declared", "expected_header")),
    _report_lines("first", 2, "json", (1, "fields of line 1", "array_to_string(fields, ', ')"),
                  (2, "fields as declared", f"CASE WHEN fields = {EXPECTED_ORDER} THEN 'yes' ELSE 'NO' END")),
    _report_lines("probes", 2, "json", (3, "lines probed for field order",
                                        "CAST(count(*) FILTER (WHERE NOT order_ok) AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR) || ' differ'")),
    f"""SELECT 3, CAST(CASE WHEN list_position(first.fields, prof.field) > 0 THEN list_position(first.fields, prof.field) ELSE 1000000 END AS BIGINT), 'field',
  prof.field, replace(observed_types, ',', ', ') || ' (null in ' || {_number("null_count")} || ' of ' || {_number("observed_count")} || ')' FROM prof, first""",
    """SELECT 4, line_no, 'example line', CAST(line_no AS VARCHAR), CASE WHEN length(value) <= 80 THEN value ELSE substr(value, 1, 79) || '…' END FROM samples""",
    _report_lines("summary", 5, "csv against json", (1, "pairs of records", _number("records_compared")), (2, "pairs with other ids", _number("id_mismatches")),
                  (3, "json ids seen again", _number("duplicate_json_ids")), (4, "csv rows with too many cells", _number("malformed_csv_rows")),
                  (8, "nested values", _number("structured_values"))),
    _report_lines("mism", 5, "csv against json", (5, "differing cells by field", f"coalesce(string_agg(field || '=' || {_number('n')}, ', ' ORDER BY field), 'none')")),
    _report_lines("div", 5, "csv against json", (6, "plain dialect: first row too wide", _number("first_malformed_row")),
                  (7, "plain dialect: first other id", _number("first_id_mismatch"))),
]) + "\nORDER BY 1, 2, 4"
