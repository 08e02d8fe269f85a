"""Stand-in inputs derived from the given tables.

Each stand-in is one SQL text that runs unchanged in Spark and in DuckDB; table
references are placeholders (``{customer}``) filled per engine, ``{sha_text}``
becomes ``sha2(text, 256)`` in Spark and ``sha256(text)`` in DuckDB. The operators
under test never use this SQL: they see the stand-ins as files or DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from intakeyard.sources.tables import TABLES, sql_ref

# The vendor record's field order (JSON file order) and the
# alphabetical order used as the CSV header.
JSON_FIELDS = ("id", "website", "name", "founded", "size", "locality", "region",
               "country", "industry", "linkedin_url")
CSV_HEADER = ("country", "founded", "id", "industry", "linkedin_url", "locality", "name",
              "region", "size", "website")

VENDOR_REC = """
SELECT CAST(c.c_custkey + 1 AS BIGINT) AS line_no, c.c_custkey AS k,
  CAST(c.c_custkey AS STRING) AS id,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL
       WHEN c.c_custkey % 20 = 1 THEN concat('https://www.c', c.c_custkey, '.example.com/a,b')
       ELSE concat('c', c.c_custkey, '.example.com') END AS website,
  CASE WHEN c.c_custkey % 50 = 7  THEN concat('Quoted ', chr(34), c.c_name, chr(34))
       WHEN c.c_custkey % 50 = 9  THEN concat('Said ', chr(34), 'hi', chr(34), ', ', c.c_name)
       WHEN c.c_custkey % 50 = 11 THEN concat('Back', chr(92), 'slash ', c.c_name)
       WHEN c.c_custkey % 50 = 13 THEN concat('Two', chr(10), 'lines ', c.c_name)
       ELSE c.c_name END AS name,
  CASE WHEN c.c_custkey % 5 < 3 THEN NULL ELSE CAST(1098 + c.c_custkey % 929 AS INT) END AS founded,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '1-10' WHEN 'BUILDING' THEN '11-50'
       WHEN 'FURNITURE' THEN '51-200' WHEN 'HOUSEHOLD' THEN '201-500' ELSE '501-1000' END AS size,
  CASE WHEN c.c_custkey % 6 = 0 THEN NULL WHEN c.c_custkey % 6 = 1 THEN ''
       ELSE concat('City ', c.c_nationkey) END AS locality,
  CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE r.r_name END AS region,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE n.n_name END AS country,
  CASE WHEN c.c_custkey % 6 = 5 THEN NULL ELSE c.c_mktsegment END AS industry,
  concat('linkedin.com/company/', c.c_custkey) AS linkedin_url
FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey
                  JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""


def _js(expr: str) -> str:
    """JSON text of a nullable string expression (escapes backslash, quote, newline)."""
    return (f"CASE WHEN {expr} IS NULL THEN 'null' ELSE '\"' || replace(replace(replace({expr}, "
            f"chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)), chr(10), chr(92) || 'n')"
            f" || '\"' END")


def _vendor_json_sql() -> str:
    vals = {
        "id": "CASE k % 97 WHEN 6 THEN '\"\"' WHEN 17 THEN '\"0\"' ELSE " + _js("id") + " END",
        "website": "CASE WHEN k % 97 = 15 THEN '{\"u\":1}' ELSE " + _js("website") + " END",
        "name": "CASE WHEN k % 97 = 7 THEN 'null' ELSE " + _js("name") + " END",
        "founded": ("CASE k % 97 WHEN 8 THEN '\"2020\"' WHEN 9 THEN '2147483648' WHEN 10 THEN '2020.5'"
                    " WHEN 11 THEN '2020.0' WHEN 12 THEN '1e3' WHEN 13 THEN 'true'"
                    " ELSE coalesce(CAST(founded AS STRING), 'null') END"),
        "industry": "CASE WHEN k % 97 = 14 THEN '[\"a\"]' ELSE " + _js("industry") + " END",
    }
    pairs = {f: f"'\"{f}\":' || ({vals.get(f) or _js(f)})" for f in JSON_FIELDS}
    forward = []
    for i, f in enumerate(JSON_FIELDS):
        sep = "" if i == 0 else "',' || "
        if f == "size":
            forward.append(f"(CASE WHEN k % 97 = 5 THEN '' ELSE ',' || {pairs[f]} END)")
        else:
            forward.append(f"{sep}{pairs[f]}")
    forward_txt = " || ".join(forward)
    reverse_txt = " || ',' || ".join(pairs[f] for f in reversed(JSON_FIELDS))
    return f"""
SELECT line_no, k,
  CASE k % 97 WHEN 1 THEN 'not json' WHEN 2 THEN '[1]' WHEN 3 THEN ''
    WHEN 16 THEN '{{' || {reverse_txt} || '}}'
    ELSE '{{' || {forward_txt}
         || (CASE WHEN k % 97 = 4 THEN ',"new_vendor_field":"surprise"' ELSE '' END) || '}}' END AS value
FROM vendor_rec
"""


VENDOR_JSON = _vendor_json_sql()

# What the vendor CSV holds once decoded (``raw_name`` keeps the backslashes its dialect drops); some rows have
# surplus cells, empty ones among them, and ten records more than the JSON repeat the first ten at the end.
VENDOR_CSV = """
SELECT pos, k, raw_name,
  CASE WHEN pos % 101 = 14 THEN concat('x', id) ELSE id END AS id,
  coalesce(website,'') AS website, replace(raw_name, chr(92), '') AS name,
  coalesce(CAST(founded AS STRING),'') AS founded, size, coalesce(locality,'') AS locality,
  coalesce(region,'') AS region, coalesce(country,'') AS country,
  coalesce(industry,'') AS industry, linkedin_url,
  CASE WHEN pos % 103 IN (18, 19) THEN 11 WHEN pos % 103 = 20 THEN 12 ELSE 10 END AS n_cells
FROM (SELECT line_no AS pos, name AS raw_name, * FROM vendor_rec
      UNION ALL
      SELECT line_no + (SELECT count(*) FROM vendor_rec) AS pos, name AS raw_name, * FROM vendor_rec WHERE line_no <= 10) v
"""

#: Every document as a ledger file; the stored and requested sides below are parts of it, so that they can differ.
REG_FILES = """
SELECT doc_id AS file_id, source AS snapshot_id, concat('doc_', doc_id) AS role,
  concat('doc_', doc_id, '.txt') AS filename,
  concat('docs/', source, '/', lang, '/', doc_id, '.txt') AS object_key,
  'txt' AS format, {sha_text} AS sha256, n_chars AS byte_size
FROM {documents}
"""

REG_STORED = "SELECT * FROM reg_files WHERE file_id % 3 <> 0"

REG_REQUESTED = """
SELECT doc_id AS file_id,
  CASE WHEN doc_id % 14 = 8 THEN concat(source, '-new') ELSE source END AS snapshot_id,
  concat('doc_', doc_id) AS role,
  concat('doc_', doc_id, '.txt') AS filename,
  concat('docs/', source, '/', lang, '/', doc_id, '.txt') AS object_key,
  'txt' AS format, {sha_text} AS sha256,
  n_chars + CASE WHEN doc_id % 10 = 4 THEN 1 ELSE 0 END AS byte_size
FROM {documents} WHERE doc_id % 2 = 0
"""

_SNAPSHOT = """
SELECT snapshot_id, snapshot_id AS source, 'documents' AS dataset, {acquired} AS acquired_at,
  concat('docs/', snapshot_id, '/manifest.json') AS manifest_key, concat('https://example.com/', snapshot_id) AS source_url,
  {described} AS description
FROM {files} GROUP BY snapshot_id
"""
REG_SNAPSHOTS = _SNAPSHOT.format(acquired="'2026-01-15'", described="concat('files of ', snapshot_id)", files="reg_stored")
# Some requested snapshots disagree with the stored ones in one field or in two.
REG_SNAPSHOTS_REQUESTED = _SNAPSHOT.format(
    acquired="CASE WHEN min(file_id) % 4 = 0 THEN '2026-01-16' ELSE '2026-01-15' END",
    described="CASE WHEN min(file_id) % 3 = 1 THEN NULL ELSE concat('files of ', snapshot_id) END", files="reg_requested")

# A file's identity at two times: some grew, some were only touched, some are gone, some are new.
SOURCE_BEFORE = "SELECT object_key AS path, byte_size AS length, file_id AS modified FROM reg_files WHERE file_id % 19 <> 5"
SOURCE_AFTER = """
SELECT object_key AS path, byte_size + CASE WHEN file_id % 10 = 4 THEN 1 ELSE 0 END AS length,
  file_id + CASE WHEN file_id % 22 = 6 THEN 60 ELSE 0 END AS modified
FROM reg_files WHERE file_id % 23 <> 7
"""

RUNS = """
SELECT o_orderkey AS run_id, concat('t', o_custkey % 20) AS target, o_orderdate AS started_at,
  CASE o_orderstatus WHEN 'P' THEN 'running' WHEN 'F' THEN 'failed' ELSE 'succeeded' END AS status,
  CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END AS row_count
FROM {orders}
"""

# Two registration requests on files that differ in content: the second names all files again, those of one snapshot with
# another size, and adds a snapshot of copies and one of other files.
REG_UNIQUE = """
SELECT r.* FROM reg_files r JOIN (SELECT sha256, min(file_id) AS first_id FROM reg_files GROUP BY sha256) u ON r.file_id = u.first_id
"""
REG_FIRST = "SELECT * FROM reg_unique WHERE file_id % 3 <> 0"
REG_SECOND = """
SELECT file_id, snapshot_id, role, filename, object_key, format, sha256,
  byte_size + CASE WHEN file_id % 3 = 1 AND snapshot_id = (SELECT min(snapshot_id) FROM reg_files) THEN 1 ELSE 0 END AS byte_size
FROM reg_unique
UNION ALL
SELECT file_id, 'copied' AS snapshot_id, role, filename, concat('copied/', object_key) AS object_key, format, sha256, byte_size
FROM reg_unique WHERE file_id % 50 = 2
UNION ALL
SELECT file_id, 'fresh' AS snapshot_id, role, filename, concat('fresh/', object_key) AS object_key, format, reverse(sha256) AS sha256, byte_size
FROM reg_unique WHERE file_id % 40 = 3
"""
REG_FIRST_SNAPSHOTS = _SNAPSHOT.format(acquired="'2026-01-15'", described="concat('files of ', snapshot_id)", files="reg_first")
REG_SECOND_SNAPSHOTS = _SNAPSHOT.format(
    acquired="'2026-01-15'", files="reg_second",
    described="CASE WHEN snapshot_id = (SELECT max(snapshot_id) FROM reg_files) THEN 'renamed' ELSE concat('files of ', snapshot_id) END")

STANDINS = {
    "vendor_rec": (VENDOR_REC, ()),
    "vendor_json": (VENDOR_JSON, ("vendor_rec",)),
    "vendor_csv": (VENDOR_CSV, ("vendor_rec",)),
    "reg_files": (REG_FILES, ()),
    "reg_stored": (REG_STORED, ("reg_files",)),
    "reg_requested": (REG_REQUESTED, ()),
    "reg_snapshots": (REG_SNAPSHOTS, ("reg_stored",)),
    "reg_snapshots_requested": (REG_SNAPSHOTS_REQUESTED, ("reg_requested",)),
    "reg_unique": (REG_UNIQUE, ("reg_files",)),
    "reg_first": (REG_FIRST, ("reg_unique",)),
    "reg_second": (REG_SECOND, ("reg_unique",)),
    "reg_first_snapshots": (REG_FIRST_SNAPSHOTS, ("reg_first",)),
    "reg_second_snapshots": (REG_SECOND_SNAPSHOTS, ("reg_second", "reg_files")),
    "source_before": (SOURCE_BEFORE, ("reg_files",)),
    "source_after": (SOURCE_AFTER, ("reg_files",)),
    "runs": (RUNS, ()),
}


def _fill(sql: str, refs: dict[str, str]) -> str:
    for key, value in refs.items():
        sql = sql.replace("{" + key + "}", value)
    return sql


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for dep in STANDINS[n][1]:
            visit(dep)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_clause(names: tuple[str, ...], engine: str = "duckdb", sf_dir: str | None = None, written: dict[str, str] | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` for the stand-ins (and their inputs); those ``written`` are read from their Parquet folder."""
    written = written or {}
    if engine == "duckdb":
        refs = {t: t for t in TABLES}
        refs["sha_text"] = "sha256(text)"
    else:
        assert sf_dir is not None
        refs = {t: sql_ref(sf_dir, t) for t in TABLES}
        refs["sha_text"] = "sha2(text, 256)"
    parts = []
    for n in _order(names):
        sql = f"SELECT * FROM parquet.`{written[n]}`" if n in written else _fill(STANDINS[n][0], refs)
        parts.append(f"{n} AS ({sql})")
    return "WITH " + ",\n".join(parts)


def standin(spark: SparkSession, sf_dir: str, name: str, written: dict[str, str] | None = None) -> DataFrame:
    """The stand-in as a Spark DataFrame, planned from the parquet tables and from stand-ins already ``written``."""
    return spark.sql(f"{with_clause((name,), 'spark', sf_dir, written)}\nSELECT * FROM {name}")
