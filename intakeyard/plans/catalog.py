"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the given tables (or files Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.functions import json_values as J
from intakeyard.functions import scalars
from intakeyard.operators import archive, artifacts, compare, inventory, keys, ledger, profile, publish, registry, reports, rules
from intakeyard.plans.vendor import vendor_csv, vendor_csv_path, vendor_json_path, vendor_lines, vendor_prepared
from intakeyard.session import configure
from intakeyard.sources import csv_records, files, positions, seek, standins, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- A. strict validation -------------------------------------------------

@query
def jsonl_positions(spark, sf_dir):
    return vendor_lines(spark, sf_dir).select("line_no", "value")


@query
def json_decode_status(spark, sf_dir):
    return rules.decode_status(vendor_prepared(spark, sf_dir))


@query
def first_rule_by_line(spark, sf_dir):
    return rules.first_rule_by_line(vendor_prepared(spark, sf_dir))


@query
def rule_violations(spark, sf_dir):
    return rules.rule_violation_counts(vendor_prepared(spark, sf_dir))


@query
def strict_import_rows(spark, sf_dir):
    return rules.accepted_rows(vendor_prepared(spark, sf_dir))


@query
def schema_drift(spark, sf_dir):
    return rules.schema_drift(vendor_prepared(spark, sf_dir))


@query
def null_vs_empty(spark, sf_dir):
    rows = rules.accepted_rows(vendor_prepared(spark, sf_dir))
    string_fields = [f for f, t in rules.VENDOR_TYPES.items() if t == "string"]
    stacked = rows.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in string_fields
    ])).alias("s")).select("s.field", "s.v")
    return stacked.groupBy("field").agg(
        F.count_if(F.col("v").isNull()).alias("n_null"),
        F.count_if(F.col("v") == "").alias("n_empty"))


# ---- B. profiling ----------------------------------------------------------

@query
def json_field_types(spark, sf_dir):
    return profile.field_types(profile.field_values(vendor_prepared(spark, sf_dir)))


@query
def json_field_profile(spark, sf_dir):
    return profile.field_profile(profile.field_values(vendor_prepared(spark, sf_dir)))


# Parsing only (no declared fields): profiling a JSON column needs no rule list.
PROFILE_ONLY = rules.RuleSet((), (), {})


def _events_prepared(spark, sf_dir):
    configure(spark)
    ev = tables.load(spark, sf_dir, "events").select(
        F.col("event_id").alias("line_no"), F.col("props").alias("value"))
    return PROFILE_ONLY.prepare(ev)


@query
def props_field_types(spark, sf_dir):
    return profile.field_types(profile.field_values(_events_prepared(spark, sf_dir)))


@query
def props_field_profile(spark, sf_dir):
    return profile.field_profile(profile.field_values(_events_prepared(spark, sf_dir)))


@query
def duplicate_ids(spark, sf_dir):
    p = vendor_prepared(spark, sf_dir).filter(F.col("_t_id") == "STRING")
    return profile.duplicate_count(p, J.as_string(J.field(F.col("_m"), "id")))


@query
def key_violations(spark, sf_dir):
    li = tables.load(spark, sf_dir, "lineitem")
    return profile.key_violations(li, ["l_orderkey", "l_linenumber"])


@query
def required_field_counts(spark, sf_dir):
    rows = rules.accepted_rows(vendor_prepared(spark, sf_dir))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("id").isNull() | (F.col("id") == "")).alias("missing_ids"),
        F.count_if(F.col("name").isNull() | (F.col("name") == "")).alias("missing_names"))


@query
def vendor_profile(spark, sf_dir):
    rows = rules.accepted_rows(vendor_prepared(spark, sf_dir))
    return rows.agg(
        F.min("founded").alias("founded_min"), F.max("founded").alias("founded_max"),
        F.count_if(F.col("website").contains("/")).alias("websites_with_slash"),
        *[F.count(c).alias(f"non_null_{c}") for c in rules.VENDOR_TYPES])


@query
def sample_records(spark, sf_dir, k: int = 3):
    return vendor_lines(spark, sf_dir).filter(F.col("line_no") <= k)


# ---- C. cross-representation compare --------------------------------------

def _compare_rows(spark, sf_dir, window=None, keep_all=False):
    csv = vendor_csv(spark, sf_dir, window=window)  # S7: the first N records of both sides, by reading no more
    return compare.joined(csv, vendor_prepared(spark, sf_dir, window=window), standins.CSV_HEADER, keep_all=keep_all)


@query
def positional_compare(spark, sf_dir):
    return compare.positional_compare(_compare_rows(spark, sf_dir), standins.CSV_HEADER)


@query
def field_mismatches(spark, sf_dir):
    return compare.field_mismatches(_compare_rows(spark, sf_dir), standins.CSV_HEADER)


@query
def compare_summary(spark, sf_dir):
    return compare.summary(_compare_rows(spark, sf_dir, keep_all=True))


@query
def first_divergence(spark, sf_dir):
    return compare.first_divergence(_compare_rows(spark, sf_dir))


@query
def compare_window(spark, sf_dir, window: int = 1000):
    return compare.field_mismatches(_compare_rows(spark, sf_dir, window=window),
                                    standins.CSV_HEADER)


@query
def csv_normalized(spark, sf_dir):
    return compare.csv_normalized(vendor_csv(spark, sf_dir), standins.CSV_HEADER)


# ---- D. provenance ledger ---------------------------------------------------

SUPERSEDE_TARGET = "t7"


def _reg(spark, sf_dir, name):
    return standins.standin(spark, sf_dir, name)


@query
def resolve_artifact(spark, sf_dir, snapshot_id: str | None = None, source: str | None = None, role: str | None = None,
                     fmt: str = "txt", dataset: str = "documents"):
    """Each requested file's archived original (same hash and size, in a snapshot of the dataset);
    the optional filters are added only when given."""
    def only(df, **terms):
        return reduce(lambda d, t: d.filter(F.col(t[0]) == t[1]), [t for t in terms.items() if t[1] is not None], df)

    snapshots = only(_reg(spark, sf_dir, "reg_snapshots"), dataset=dataset, source=source)
    cand = only(_reg(spark, sf_dir, "reg_stored"), format=fmt, snapshot_id=snapshot_id, role=role).join(
        snapshots, "snapshot_id", "left_semi")
    one = cand.groupBy("sha256", "byte_size").agg(
        F.min(F.struct("snapshot_id", "file_id")).alias("_s"))
    req = _reg(spark, sf_dir, "reg_requested").select(
        F.col("file_id").alias("request_file_id"), "sha256", "byte_size")
    return req.join(one, ["sha256", "byte_size"]).select(
        "request_file_id", "_s.snapshot_id", "_s.file_id")


def _matched(spark, sf_dir):
    return ledger.match_summaries(_reg(spark, sf_dir, "reg_requested"),
                                  _reg(spark, sf_dir, "reg_stored"))


@query
def artifact_collisions(spark, sf_dir):
    return ledger.collisions(_matched(spark, sf_dir))


@query
def ledger_reconcile(spark, sf_dir):
    return ledger.reconcile(_matched(spark, sf_dir), _reg(spark, sf_dir, "reg_snapshots"))


@query
def file_differences(spark, sf_dir):
    """Files of the requested snapshots, requested against stored: status and differing fields."""
    requested = _reg(spark, sf_dir, "reg_requested")
    stored = _reg(spark, sf_dir, "reg_stored").join(requested.select("snapshot_id").distinct(), "snapshot_id", "left_semi")
    fields = tuple(f for f in ledger.FILE_FIELDS if f not in ("snapshot_id", "role"))
    return ledger.differences(requested, stored, ("snapshot_id", "role"), fields)


@query
def snapshot_differences(spark, sf_dir):
    """D1/J8 on the metadata of the snapshots themselves."""
    return ledger.differences(_reg(spark, sf_dir, "reg_snapshots_requested"), _reg(spark, sf_dir, "reg_snapshots"),
                              ("snapshot_id",), ledger.SNAPSHOT_FIELDS)


@query
def unexpected_roles(spark, sf_dir):
    return ledger.unexpected_roles(_reg(spark, sf_dir, "reg_requested"),
                                   _reg(spark, sf_dir, "reg_stored"))


@query
def register_files(spark, sf_dir):
    return ledger.register(_reg(spark, sf_dir, "reg_requested"), _reg(spark, sf_dir, "reg_stored"))


def _registered_twice(spark, sf_dir):
    """A ledger of its own with the first request, the second, and the second once more, which must add nothing."""
    root = f"{files.fixture_dir(spark, sf_dir, 'registry')}-{files.fresh_name()}"
    log = registry.registry(spark, root)
    written: dict[str, str] = {}

    def asked(name: str) -> DataFrame:
        """A request as it came in, written down: the texts are read and hashed once, not by every comparison."""
        path = f"{root}-requests/{name}"
        standins.standin(spark, sf_dir, name, written).write.parquet(path)
        written[name] = path
        return spark.read.parquet(path)

    for name in ("reg_files", "reg_unique", "reg_first", "reg_second"):
        asked(name)
    first, second = ((asked(f"{n}_snapshots"), spark.read.parquet(written[n])) for n in ("reg_first", "reg_second"))
    registry.register(log, *first)
    out, _ = registry.register(log, *second)
    again, number = registry.register(log, *second)
    if number is not None:
        raise AssertionError("a repeated registration wrote a commit")
    return log, out


@query
def ledger_registration(spark, sf_dir):
    """The stored files after two requests, with the commit that added each."""
    log, _ = _registered_twice(spark, sf_dir)
    return log.read("files").select("snapshot_id", "role", "sha256", "byte_size", "commit")


@query
def registration_outcomes(spark, sf_dir):
    """What became of each file of the second request."""
    _, out = _registered_twice(spark, sf_dir)
    return out.select("snapshot_id", "role", "status", "refused")


@query
def supersede_runs(spark, sf_dir):
    return ledger.supersede(_reg(spark, sf_dir, "runs"), SUPERSEDE_TARGET)


@query
def finish_run(spark, sf_dir):
    """Every run asks to finish: succeeded with its returned-line count, or failed."""
    li = tables.load(spark, sf_dir, "lineitem")
    loaded = li.groupBy(F.col("l_orderkey").alias("run_id")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n"))
    runs = _reg(spark, sf_dir, "runs")
    req = runs.select("run_id").join(loaded, "run_id", "left").select(
        "run_id",
        F.when(F.coalesce(F.col("n"), F.lit(0)) > 0, "succeeded").otherwise("failed").alias("new_status"),
        F.coalesce(F.col("n"), F.lit(0)).alias("row_count"),
        F.concat(F.lit("no returned lines for run "), F.col("run_id").cast("string")).alias("error"))
    return ledger.finish(runs, req)


@query
def current_version(spark, sf_dir):
    return ledger.current_version(_reg(spark, sf_dir, "runs"))


@query
def lineage(spark, sf_dir):
    """Target -> its current run -> the run's stored snapshot -> its files; a target whose snapshot is not stored shows no dataset."""
    cur = ledger.current_version(_reg(spark, sf_dir, "runs")).withColumn(
        "snapshot_id", F.concat(F.lit("src"), F.expr("substr(target, 2)")))
    snapshots = _reg(spark, sf_dir, "reg_snapshots").select("snapshot_id", "dataset", "acquired_at")
    held = _reg(spark, sf_dir, "reg_files").groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("byte_size").alias("total_bytes"))
    found = cur.join(snapshots.join(held, "snapshot_id", "left"), "snapshot_id", "left")
    return found.select("target", "run_id", "snapshot_id", "dataset", "acquired_at", F.coalesce("n_files", F.lit(0)).alias("n_files"),
                        F.coalesce("total_bytes", F.lit(0)).cast("bigint").alias("total_bytes"))


@query
def fk_orphans(spark, sf_dir):
    t = lambda n: tables.load(spark, sf_dir, n)
    return ledger.union_all([
        ledger.orphans(t("lineitem"), "l_orderkey",
                       t("orders").filter(F.col("o_orderstatus") != "P"), "o_orderkey",
                       "lineitem.l_orderkey -> orders[o_orderstatus <> P]"),
        ledger.orphans(t("orders"), "o_custkey", t("customer"), "c_custkey",
                       "orders.o_custkey -> customer"),
        ledger.orphans(t("labels"), "doc_id", t("documents"), "doc_id", "labels.doc_id -> documents"),
        ledger.orphans(_reg(spark, sf_dir, "reg_requested"), "snapshot_id",
                       _reg(spark, sf_dir, "reg_snapshots"), "snapshot_id",
                       "reg_requested.snapshot_id -> reg_snapshots"),
    ])


@query
def checksum_ledger(spark, sf_dir):
    """Bundled (requested) entries against recorded (stored) ones by version."""
    exp = _reg(spark, sf_dir, "reg_requested").select(
        F.col("file_id").alias("version"), F.col("filename").alias("e_name"),
        F.col("sha256").alias("e_sha"))
    rec = _reg(spark, sf_dir, "reg_stored").select(
        F.col("file_id").alias("version"), F.col("filename").alias("r_name"),
        F.col("sha256").alias("r_sha"))
    j = exp.join(rec, "version", "left")  # recorded-but-not-bundled is ignored
    status = (F.when(F.col("r_name").isNull() & F.col("r_sha").isNull(), "pending")
              .when(F.col("e_name").eqNullSafe(F.col("r_name")) & F.col("e_sha").eqNullSafe(F.col("r_sha")),
                    "applied").otherwise("changed"))
    return j.select("version", status.alias("status"))


def _surplus(df, cols, check):
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return per.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("n_violations")) \
        .select(F.lit(check).alias("check"), "n_violations")


@query
def ledger_expectations(spark, sf_dir):
    """F13 + uniqueness as data: one conditional pass per table plus one keyed aggregate
    per uniqueness rule."""
    files = _reg(spark, sf_dir, "reg_files")
    runs = _reg(spark, sf_dir, "runs")
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    f_checks = {
        "files.sha256_not_hex64": ~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)),
        "files.negative_byte_size": F.coalesce(F.col("byte_size") < 0, F.lit(True)),
        "files.empty_text": empty("snapshot_id") | empty("role") | empty("filename")
        | empty("object_key") | empty("format"),
    }
    r_checks = {
        "runs.unknown_status": ~F.coalesce(F.col("status").isin(*ledger.RUN_STATES), F.lit(False)),
        "runs.negative_row_count": F.coalesce(F.col("row_count") < 0, F.lit(False)),
        "runs.empty_text": empty("target"),
    }
    snapshots = _reg(spark, sf_dir, "reg_snapshots")
    s_checks = {"snapshots.empty_text": reduce(lambda a, b: a | b, [empty(c) for c in (
        "snapshot_id", "source", "dataset", "acquired_at", "manifest_key", "source_url")])}

    def cond_counts(df, checks):
        agg = df.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])
        return agg.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("n_violations"))
            for k in checks])).alias("s")).select("s.check", "s.n_violations")

    return ledger.union_all([
        cond_counts(files, f_checks), cond_counts(runs, r_checks), cond_counts(snapshots, s_checks),
        _surplus(snapshots, ["snapshot_id"], "snapshots.surplus_snapshot_id"),
        _surplus(snapshots, ["manifest_key"], "snapshots.surplus_manifest_key"),
        _surplus(snapshots, ["source", "dataset", "acquired_at"], "snapshots.surplus_source_dataset_acquired"),
        _surplus(files, ["sha256"], "files.surplus_sha256"),
        _surplus(files, ["object_key"], "files.surplus_object_key"),
        _surplus(files, ["snapshot_id", "role"], "files.surplus_snapshot_role"),
        _surplus(files, ["file_id"], "files.surplus_file_id"),
        _surplus(runs, ["run_id"], "runs.surplus_run_id"),
    ])


# ---- K. stage, verdict, publish ----------------------------------------------

COMPANIES_TARGET = "companies"


def clean_jsonl(spark, sf_dir):
    """The vendor feed without defects (Spark's own JSON writer), written once."""
    rec = standins.standin(spark, sf_dir, "vendor_rec")
    lines = rec.select("line_no", F.to_json(F.struct(*standins.JSON_FIELDS),
                                            {"ignoreNullFields": "false"}).alias("value"))
    return files.write_lines(spark, lines, files.fixture_dir(spark, sf_dir, "vendor_clean_jsonl"))


def _warehouse(spark, sf_dir):
    root = files.fixture_dir(spark, sf_dir, "warehouse")
    return f"{root}/companies", f"{root}/ledger/runs"


@query
def load_verdict(spark, sf_dir):
    return publish.load_verdict(vendor_prepared(spark, sf_dir))


@query
def publish_roundtrip(spark, sf_dir):
    """The defect feed is rejected (ledger row ``failed``, nothing staged); the clean feed
    is staged, counted twice and committed; the current version is read back whole."""
    configure(spark)
    table_root, ledger_path = _warehouse(spark, sf_dir)
    bad = vendor_prepared(spark, sf_dir)
    publish.publish(spark, bad, table_root, ledger_path,
                    target=COMPANIES_TARGET, snapshot_id="vendor-defects")
    source = clean_jsonl(spark, sf_dir)
    good = rules.VENDOR.prepare(positions.read_lines(spark, source))
    publish.publish(spark, good, table_root, ledger_path,
                    target=COMPANIES_TARGET, snapshot_id="vendor-clean", source=source)
    path = publish.current_path(spark, table_root, ledger_path, COMPANIES_TARGET)
    return spark.read.schema(publish.COMPANIES_SCHEMA).parquet(path)


def _current_companies(spark, sf_dir):
    table_root, ledger_path = _warehouse(spark, sf_dir)
    path = (publish.current_path(spark, table_root, ledger_path, COMPANIES_TARGET)
            if files.exists(spark, ledger_path) else None)
    if path is None:
        return publish_roundtrip(spark, sf_dir)
    return spark.read.schema(publish.COMPANIES_SCHEMA).parquet(path)


@query
def point_lookup(spark, sf_dir):
    """equality lookups on id, website, linkedin_url (pushed into the Parquet scan;
    the table is clustered by id and carries bloom filters on the other two)."""
    t = _current_companies(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        t.filter(F.col("id") == "7").withColumn("lookup", F.lit("id")),
        t.filter(F.col("website") == "c8.example.com").withColumn("lookup", F.lit("website")),
        t.filter(F.col("linkedin_url") == "linkedin.com/company/10").withColumn("lookup", F.lit("linkedin_url")),
    ])


@query
def orphan_stages(spark, sf_dir):
    """K3 over the run ledger: every run staged a folder; only succeeded runs are referenced."""
    runs = _reg(spark, sf_dir, "runs")
    return publish.orphan_stages(runs.select("run_id", "target", "status"), runs)


@query
def orphan_folders(spark, sf_dir):
    """K3 on storage: folders of a table root that hold files and that no succeeded run of the ledger references."""
    root = f"{files.fixture_dir(spark, sf_dir, 'staged')}-{files.fresh_name()}"
    runs = _reg(spark, sf_dir, "runs").where("target = 't7'").select("run_id", "target", "status", "row_count", "started_at")
    files.write_folders(spark, runs.withColumn("id", F.col("run_id")), f"{root}/table", "run_id")  # what each run has staged: a folder a run
    log = publish.runs_log(spark, f"{root}/runs")
    log.try_commit({"": runs.select(F.col("run_id").cast("string").alias("run_id"), F.lit(None).cast("string").alias("snapshot_id"), "target", "status",
                                    F.col("started_at").cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"),
                                    "row_count", F.lit(None).cast("string").alias("error"))}, 0)
    return publish.orphan_folders(spark, f"{root}/table", f"{root}/runs")


# ---- X. scalar functions over the given tables ---------------------------------

@query
def format_bytes(spark, sf_dir):
    d = tables.load(spark, sf_dir, "documents")
    return d.select("doc_id", *[scalars.format_bytes(F.col("n_chars") * m).alias(f"size_x{m}")
                                for m in (1, 1000, 1000000, 1000000000)])


@query
def row_fingerprint(spark, sf_dir):
    d = tables.load(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(F.col("text"), 256).alias("sha256"))


REDACT_SECRETS = ("der", "que", "und")


@query
def redact_literals(spark, sf_dir):
    d = tables.load(spark, sf_dir, "documents")
    red = scalars.redact(F.col("text"), REDACT_SECRETS)
    return d.select("doc_id", F.length(red).alias("n_chars_after"),
                    F.sha2(red, 256).alias("sha256_after"))


@query
def url_target(spark, sf_dir):
    p = tables.load(spark, sf_dir, "pages")
    parts = scalars.url_parts(F.col("url"))
    return p.select("page_id", parts["scheme"].alias("scheme"), parts["host"].alias("host"),
                    parts["path"].alias("path"), parts["userinfo"].isNotNull().alias("has_credentials"),
                    scalars.url_target(F.col("url")).alias("target"))


@query
def acquired_at_utc(spark, sf_dir):
    configure(spark)
    o = tables.load(spark, sf_dir, "orders")
    hh = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    day = F.col("o_orderdate").cast("date").cast("string")
    suffix = (F.when(F.col("o_orderkey") % 97 == 0, F.lit("-xx"))
              .when(F.col("o_orderkey") % 5 == 0, F.lit(""))
              .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("T"), hh, F.lit(":30:00Z")))
              .when(F.col("o_orderkey") % 5 == 2, F.concat(F.lit("T"), hh, F.lit(":30:00+02:00")))
              .when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("T"), hh, F.lit(":30:00-05:00")))
              .otherwise(F.concat(F.lit("T"), hh, F.lit(":30:00"))))
    text = F.concat(day, suffix)
    ts = scalars.acquired_at_utc(text)
    return o.select("o_orderkey", text.alias("acquired_at"),
                    F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("acquired_at_utc"))


@query
def versioned_names(spark, sf_dir):
    o = tables.load(spark, sf_dir, "orders")
    v = scalars.versioned_name(F.col("o_orderpriority"), sep="-")
    return (o.select("o_orderpriority", v["version"].alias("version"), v["name"].alias("name"),
                     v["valid"].alias("valid"))
            .groupBy("o_orderpriority", "version", "name", "valid").agg(F.count(F.lit(1)).alias("n")))


@query
def render_values(spark, sf_dir):
    d = tables.load(spark, sf_dir, "documents")
    return d.select("doc_id", scalars.render_value(scalars.json_string(F.col("text"))).alias("rendered"))


@query
def object_keys(spark, sf_dir):
    e = tables.load(spark, sf_dir, "events")
    return e.select("event_id", F.concat_ws("/", F.lit("events"), F.col("event_type"),
                                            F.date_format("ts", "yyyy-MM-dd"),
                                            F.concat(F.col("event_id").cast("string"), F.lit(".json")))
                    .alias("object_key"))


@query
def error_tail(spark, sf_dir):
    c = tables.load(spark, sf_dir, "conversations")
    tail = scalars.error_tail(F.col("text"), 4000)
    return c.select("conv_id", "turn", F.length(tail).alias("tail_chars"),
                    F.sha2(tail, 256).alias("tail_sha256"))


# ---- E. inventory ---------------------------------------------------------------

def _frames(spark, sf_dir):
    return {t: tables.load(spark, sf_dir, t) for t in tables.TABLES}


@query
def inv_relations(spark, sf_dir):
    return inventory.relations(spark, _frames(spark, sf_dir))


@query
def inv_columns(spark, sf_dir):
    return inventory.columns(spark, _frames(spark, sf_dir))


@query
def inv_exact_counts(spark, sf_dir):
    return inventory.exact_counts(_frames(spark, sf_dir))


@query
def inv_candidate_keys(spark, sf_dir):
    return inventory.candidate_keys(spark, _frames(spark, sf_dir))


@query
def inv_composite_keys(spark, sf_dir):
    """Minimal keys of up to three columns of every table."""
    return keys.composite_keys(spark, _frames(spark, sf_dir))


@query
def inv_bounded_counts(spark, sf_dir, timeout_s: float = 120.0):
    return inventory.bounded_counts(spark, _frames(spark, sf_dir), timeout_s)


def _sizes(spark, sf_dir):
    return inventory.sizes(spark, {t: tables.table_path(sf_dir, t) for t in tables.TABLES})


@query
def inv_sizes(spark, sf_dir):
    return _sizes(spark, sf_dir)


@query
def inv_estimates(spark, sf_dir):
    return inventory.estimates(spark, _frames(spark, sf_dir))


@query
def inv_empty_but_large(spark, sf_dir):
    return inventory.empty_but_large(inventory.exact_counts(_frames(spark, sf_dir)),
                                     _sizes(spark, sf_dir))


@query
def inv_summary(spark, sf_dir):
    return _sizes(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_relations"),
                                     F.sum("total_bytes").cast("bigint").alias("total_bytes"))


@query
def inv_nested(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    return inventory.nested(inventory.columns(spark, fr), inventory.candidate_keys(spark, fr))


@query
def inv_schema_counts(spark, sf_dir):
    """Relations per database; databases without relations keep 0 (left join)."""
    dbs = spark.createDataFrame([(d.name,) for d in spark.catalog.listDatabases()], "database string")
    rels = spark.createDataFrame(
        [(t.namespace[0] if t.namespace else None, t.name, t.tableType)
         for d in spark.catalog.listDatabases() for t in spark.catalog.listTables(d.name)],
        "database string, name string, kind string")
    return dbs.join(rels, "database", "left").groupBy("database").agg(
        F.count_if(F.col("kind").isin("MANAGED", "EXTERNAL", "VIEW")).alias("relation_count"))


# ---- S. CSV scans, header, offset probes -----------------------------------------

@query
def csv_vendor_scan(spark, sf_dir):
    """Vendor dialect (backslash escape, multi-line) with record positions and cell counts."""
    return vendor_csv(spark, sf_dir).select("pos", *standins.CSV_HEADER, "n_cells")


@query
def csv_default_scan(spark, sf_dir):
    """The default dialect on the same files (misreads backslash-escaped quotes)."""
    return vendor_csv(spark, sf_dir, csv_records.DEFAULT).select("pos", "id", "n_cells")


@query
def default_dialect_divergence(spark, sf_dir):
    """A13 on a default-dialect scan against the feed without defects: first over-long row, first id divergence."""
    d = vendor_csv(spark, sf_dir, csv_records.DEFAULT).select("pos", F.col("id").alias("csv_id"), "n_cells")
    clean = rules.VENDOR.prepare(positions.read_lines(spark, clean_jsonl(spark, sf_dir)))
    j = clean.select(F.col("line_no").alias("pos"), J.as_string(J.field(F.col("_m"), "id")).alias("json_id"))
    rows = d.join(j, "pos").select("pos", (F.col("n_cells") > len(standins.CSV_HEADER)).alias("too_long"),
                                   F.col("csv_id").eqNullSafe(F.col("json_id")).alias("id_match"))
    return compare.first_divergence(rows)


@query
def header_check(spark, sf_dir):
    """The header record as scanned, compared with the expected ordered header; no row if there is none."""
    cells = csv_records.header(spark, vendor_csv_path(spark, sf_dir), csv_records.VENDOR)
    expected = F.array(*[F.lit(c) for c in standins.CSV_HEADER])
    return cells.select(F.array_join("cells", ",").alias("header"),
                        F.when(F.col("cells") == expected, "yes").otherwise("NO").alias("expected_header"))


PROBE_FRACTIONS = ("0.00", "0.25", "0.50", "0.75", "0.99")


def _order_ok(value_col="value"):
    keys = F.json_object_keys(F.col(value_col))
    return F.coalesce(keys == F.array(*[F.lit(f) for f in standins.JSON_FIELDS]), F.lit(False))


@query
def schema_probes(spark, sf_dir):
    """S8 re-aimed: records at floor(n * f) + 1 for f in 0/25/50/75/99 %; decoded and
    whether keys come in the expected order."""
    lines = vendor_lines(spark, sf_dir)
    n = lines.agg(F.count(F.lit(1)).alias("n"))
    probes = n.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("fraction"),
                 (F.floor(F.col("n") * F.lit(f).cast("decimal(3,2)")) + 1).cast("bigint").alias("line_no"))
        for f in PROBE_FRACTIONS])).alias("p")).select("p.fraction", "p.line_no")
    # Five probe rows: a proven-small broadcast side. Only the lines they name are parsed.
    return rules.VENDOR.prepare(lines.join(F.broadcast(probes), "line_no")).select(
        "fraction", "line_no", F.col("_m").isNotNull().alias("decoded"), _order_ok().alias("order_ok"))


@query
def offset_probes(spark, sf_dir):
    """The first whole line behind 0/25/50/75/99 % of the feed's bytes, by seeking: decoded, and whether its keys are in order."""
    configure(spark)
    found = seek.probe_lines(spark, vendor_json_path(spark, sf_dir), PROBE_FRACTIONS)
    return rules.VENDOR.prepare(found.select("fraction", F.col("line_offset").alias("line_no"), "value")).select(
        "fraction", F.col("line_no").alias("line_offset"), F.col("_m").isNotNull().alias("decoded"), _order_ok().alias("order_ok"))


@query
def schema_order_check(spark, sf_dir):
    """F3 over every record: objects whose keys are not in the expected order."""
    p = vendor_prepared(spark, sf_dir).filter(F.col("_m").isNotNull())
    return p.agg(F.count(F.lit(1)).alias("objects"), F.count_if(~_order_ok()).alias("order_mismatches"))


# ---- K6, A17, S12, S13, K5, D8: manifests and artifacts ------------------------------

@query
def manifest_lines(spark, sf_dir):
    return artifacts.manifest_lines(_reg(spark, sf_dir, "reg_files"))


@query
def manifest_per_snapshot(spark, sf_dir):
    stored = _reg(spark, sf_dir, "reg_files")
    return artifacts.manifest_digest(artifacts.manifest_lines(stored), stored)


def _manifest_document(spark, sf_dir):
    lines = artifacts.manifest_lines(_reg(spark, sf_dir, "reg_files")).select(F.struct("snapshot_id", "role").alias("at"), "line")
    return archive.write_document(spark, lines, files.fixture_dir(spark, sf_dir, "manifest_document"))


@query
def manifest_document(spark, sf_dir):
    """K6: the manifest as written, line by line in order of snapshot and role."""
    return positions.read_lines(spark, _manifest_document(spark, sf_dir)).select("line_no", F.col("value").alias("line"))


@query
def manifest_tree(spark, sf_dir):
    """K6: the digests over the manifest document, ranges of lines up to its one root."""
    return archive.tree(spark, _manifest_document(spark, sf_dir))


@query
def plan_key_check(spark, sf_dir):
    return artifacts.plan_key_check(_reg(spark, sf_dir, "reg_files"))


@query
def artifact_listing(spark, sf_dir):
    return artifacts.listing(spark, sf_dir, "*.parquet")


@query
def artifact_fingerprint(spark, sf_dir):
    return artifacts.fingerprints(spark, sf_dir, "*.parquet")


@query
def artifact_reconcile(spark, sf_dir):
    """K5: requested files against the stored objects by key: write, reuse or collision."""
    def objects(name):
        return _reg(spark, sf_dir, name).select("object_key", F.col("byte_size").alias("length"), "sha256")

    return artifacts.reconcile(objects("reg_requested"), objects("reg_stored"))


@query
def artifact_drift(spark, sf_dir):
    """Files whose size or modification time differs between two listings."""
    def listed(name):
        return _reg(spark, sf_dir, name).select("path", "length", F.timestamp_seconds("modified").alias("modification_time"))

    return artifacts.drift(listed("source_before"), listed("source_after"))


# ---- P8/U4/D6: schema assertions ---------------------------------------------------

# Declared (name, type) per position for the tables a load depends on.
DECLARED = {
    "orders": (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")),
    "lineitem": (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")),
}


@query
def schema_assert(spark, sf_dir):
    exp = spark.createDataFrame([(t, i + 1, n, ty) for t, cols in DECLARED.items() for i, (n, ty) in enumerate(cols)],
                                "table_name string, position int, expected_column string, expected_type string")
    obs = inventory.columns(spark, {t: tables.load(spark, sf_dir, t) for t in DECLARED}).select(
        "table_name", "position", F.col("column_name").alias("observed_column"),
        F.col("data_type").alias("observed_type"))
    j = exp.join(obs, ["table_name", "position"], "full")
    return j.select("*", (F.col("expected_column").eqNullSafe(F.col("observed_column"))
                          & F.col("expected_type").eqNullSafe(F.col("observed_type"))).alias("matches"))


# ---- R. reports --------------------------------------------------------------------

@query
def inspect_report(spark, sf_dir):
    """R1 as one ordered table; every line is selected from the aggregate it states."""
    prepared = vendor_prepared(spark, sf_dir)
    first = prepared.filter(F.col("_m").isNotNull()).agg(F.min_by(F.json_object_keys("value"), F.col("line_no")).alias("fields"))
    rows = _compare_rows(spark, sf_dir, keep_all=True)
    return reports.inspection(
        header=csv_records.header(spark, vendor_csv_path(spark, sf_dir), csv_records.VENDOR), expected_header=standins.CSV_HEADER,
        first_fields=first, expected_fields=standins.JSON_FIELDS, probes=schema_probes(spark, sf_dir),
        profile=profile.field_profile(profile.field_values(prepared)),
        samples=sample_records(spark, sf_dir).select("line_no", scalars.render_value(F.col("value")).alias("rendered")),
        summary=compare.summary(rows), mismatches=compare.field_mismatches(rows.where("in_csv AND in_json"), standins.CSV_HEADER),
        divergence=default_dialect_divergence(spark, sf_dir))


@query
def inv_report(spark, sf_dir, timeout_s: float = 120.0):
    """R2 as one ordered table."""
    fr = _frames(spark, sf_dir)
    return reports.inventory(counts=inventory.bounded_counts(spark, fr, timeout_s), sizes=_sizes(spark, sf_dir), columns=inventory.columns(spark, fr),
                             keys=inventory.candidate_keys(spark, fr), threshold=inventory.EMPTY_BUT_LARGE_BYTES)
