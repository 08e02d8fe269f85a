"""Lines of the template tree: their tokens, and that a pass parses them once."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from intakeyard.llm import line_templates as L

LINES = ["plain words only here", "two  spaces", " lead", "trail ", "", " ", "\t", "tab\tcut", "a\rb", "v\x0bw f\x0cg", "x1 y 22z w", "mixed\t9 \x0b a",
         "no-break space stays", "été 東京 naïve", "<*> literal", "7", "a  b 3\tc", " em space", "1 2 3 4 5", "\x0c 5 \x0c"]


def _tokens(line):
    return ["<*>" if re.search("[0-9]", t) else t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]


def test_tokens_of_odd_lines(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(LINES)], "doc_id bigint, text string")
    got = {r.line: (r.tokens, r.n) for r in L._parsed(docs, "doc_id", "text", 3, 50).select("line", "tokens", "n").collect()}
    assert got == {t: (" ".join(_tokens(t)), len(_tokens(t))) for t in LINES}


def test_a_filter_does_not_parse_again(spark, monkeypatch):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a b c 1\nd e f 2").alias("text")).repartition(2)
    plans = []
    real = L.saved
    monkeypatch.setattr(L, "saved", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    L.recurring_lines(docs, "doc_id", "text", 3, 2, 3, 0.75, 50, 2)
    assert plans[0].count("regexp_replace(") == 2, plans[0]  # once for the leaves, once for the lines of those that stay
