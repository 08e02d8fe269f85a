import hashlib

from pyspark.sql import functions as F

from intakeyard.functions import scalars as S


def one(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_format_bytes(spark):
    got = one(spark, S.format_bytes(F.col("x")), [(0,), (1024,), (1024 ** 2,), (1024 ** 3,), (1152,), (-1,),
                                                   (5 * 1024 ** 4,)], "x bigint")
    assert got == ["0 B", "1.00 KiB", "1.00 MiB", "1.00 GiB", "1.12 KiB", None, "5.00 TiB"]


def test_sha256_matches_hashlib(spark):
    text = "line of some file\n" * 57 + "last"
    assert one(spark, F.sha2(F.col("x"), 256), [(text,)]) == [hashlib.sha256(text.encode()).hexdigest()]


def test_redaction(spark):
    got = one(spark, S.redact(F.col("x"), ("k3y-one", "", "k3y-two")),
              [("login with k3y-one, then k3y-two, then k3y-one",)])
    assert got == ["login with [redacted], then [redacted], then [redacted]"]


def test_acquired_at_to_utc(spark):
    got = one(spark, F.date_format(S.acquired_at_utc(F.col("x")), "yyyy-MM-dd HH:mm:ss"),
              [("2026-08-17",), ("2026-08-16T19:00:00-05:00",), ("2026-08-17T10:00:00Z",), ("2026-08",),
               ("20260817",), ("2026-W34-1",), ("2026W341",), ("2026-08-17T10",), ("2026-08-17T10:00:00+0200",),
               ("20260817T101530,25-01",), ("2026-13-01",), ("2026-0817",), ("",), (None,)])
    assert got == ["2026-08-17 00:00:00", "2026-08-17 00:00:00", "2026-08-17 10:00:00", None,
                   "2026-08-17 00:00:00", "2026-08-17 00:00:00", "2026-08-17 00:00:00", "2026-08-17 10:00:00", "2026-08-17 08:00:00",
                   "2026-08-17 11:15:30", None, None, None, None]


def test_render_value_truncates_to_80(spark):
    got = one(spark, S.render_value(S.json_string(F.col("x"))), [("a" * 100,), ("short",)])
    assert got[0] == '"' + "a" * 78 + "…" and len(got[0]) == 80
    assert got[1] == '"short"'


def test_url_target_and_versions(spark):
    rows = [("https://user:pw@h.example.com/a/b/?q=1",)]
    assert one(spark, S.url_target(F.col("x")), rows) == ["https://h.example.com/a/b"]
    assert one(spark, S.url_target(F.col("x")), [("https://u:p@h.example.com:9000/a/",)]) == ["https://h.example.com:9000/a"]
    v = S.versioned_name(F.col("x"))
    got = spark.createDataFrame([("001_meta.sql",), ("bad.sql",)], "x string").select(
        v["version"], v["name"], v["valid"]).collect()
    assert [tuple(r) for r in got] == [(1, "meta.sql", True), (None, None, False)]
