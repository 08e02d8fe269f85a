"""Strict record validation: a declared rule list compiled to column expressions.

Rules are data. ``RuleSet.compile`` turns them into one projection that parses
each line once (VARIANT), reads each field's type once, and evaluates every rule;
the first failing rule in declared order is the line's verdict. Everything is a
built-in expression, so the whole check runs inside whole-stage codegen and
scales with the number of input splits; a thousand-field feed is just a longer
list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intakeyard.functions import json_values as J
from intakeyard.sources.standins import JSON_FIELDS

INT32_MIN, INT32_MAX = -2147483648, 2147483647

# Verdict texts for lines that never reach the rules.
BLANK_LINE = "blank line skipped"
MALFORMED = "malformed JSON"
VALID = "valid"


@dataclass(frozen=True)
class Rule:
    kind: str          # object | field_set | required_string | string_or_null | int32_or_null
    field: str | None  # the field a per-field rule reads
    message: str

    @property
    def key(self) -> str:
        return self.field or self.kind


# The vendor company record's rules, in the order they are checked,
# and their messages (the field-set message is followed by the keys found).
VENDOR_RULES = (
    Rule("object", None, "record must be an object"),
    Rule("field_set", None, "unexpected field set"),
    Rule("required_string", "id", "id must be a non-empty string"),
    Rule("required_string", "name", "name must be a non-empty string"),
    Rule("string_or_null", "website", "website must be a string or null"),
    Rule("int32_or_null", "founded", "founded must be an integer or null"),
    Rule("string_or_null", "size", "size must be a string or null"),
    Rule("string_or_null", "locality", "locality must be a string or null"),
    Rule("string_or_null", "region", "region must be a string or null"),
    Rule("string_or_null", "country", "country must be a string or null"),
    Rule("string_or_null", "industry", "industry must be a string or null"),
    Rule("string_or_null", "linkedin_url", "linkedin_url must be a string or null"),
)

# Output column types of an accepted record.
VENDOR_TYPES = {f: ("int" if f == "founded" else "string") for f in JSON_FIELDS}


def _pinned(c: Column) -> Column:
    """``c`` made nondeterministic at no cost (the partition id is never negative), which
    keeps it computed once in its own projection."""
    return F.when(F.spark_partition_id() >= 0, c)


@dataclass(frozen=True)
class RuleSet:
    fields: tuple[str, ...]
    rules: tuple[Rule, ...]
    types: dict[str, str]

    def _t(self, f: str) -> str:
        return f"_t_{f}"

    def prepare(self, lines: DataFrame, value_col: str = "value") -> DataFrame:
        """Parse once; keep the object map and each declared field's VARIANT type.

        The parsed columns are pinned (``_pinned``): Catalyst neither pushes a filter on
        a verdict below this projection nor inlines the parse into it (a Filter has no
        common-subexpression elimination, so every rule would parse the line again).
        """
        v = J.parse(F.col(value_col))
        d = lines.select("*", _pinned(v).alias("_v"),
                         F.col(value_col).rlike(r"^[ \t\r]*$").alias("_blank"))
        d = d.select("*", _pinned(J.as_object(F.col("_v"))).alias("_m"))
        return d.select("*", *[_pinned(J.type_name(J.field(F.col("_m"), f))).alias(self._t(f))
                               for f in self.fields])

    def failure(self, rule: Rule) -> Column:
        """TRUE when a parsed object breaks ``rule`` (only meaningful when ``_m`` is set)."""
        m = F.col("_m")
        if rule.kind == "object":
            return m.isNull()
        if rule.kind == "field_set":
            expected = F.array(*[F.lit(f) for f in sorted(self.fields)])
            return F.array_sort(F.map_keys(m)) != expected
        t = F.col(self._t(rule.field))
        x = J.field(m, rule.field)
        if rule.kind == "required_string":
            return ~F.coalesce((t == "STRING") & (F.length(J.as_string(x)) > 0), F.lit(False))
        if rule.kind == "string_or_null":
            return ~(x.isNull() | t.isin("STRING", "VOID"))
        if rule.kind == "int32_or_null":
            d = J.as_double(x)
            ok = (x.isNull() | (t == "VOID")
                  | (J.is_numeric_type(t) & (F.floor(d) == d) & d.between(INT32_MIN, INT32_MAX)))
            return ~F.coalesce(ok, F.lit(False))
        raise ValueError(f"unknown rule kind {rule.kind}")

    def message(self, rule: Rule) -> Column:
        if rule.kind == "field_set":
            return F.concat(F.lit(rule.message + ": "),
                            F.array_join(F.array_sort(F.map_keys(F.col("_m"))), ","))
        return F.lit(rule.message)

    def first_rule(self) -> Column:
        """Verdict of a prepared line: the first failing rule's message, or ``valid``."""
        chain = F.when(F.col("_blank"), BLANK_LINE).when(F.col("_v").isNull(), MALFORMED)
        for rule in self.rules:
            chain = chain.when(self.failure(rule), self.message(rule))
        return chain.otherwise(VALID)

    def violations(self) -> Column:
        """Array of every rule the line breaks (``object`` short-circuits the rest)."""
        per_rule = [F.when(self.failure(r), F.lit(r.key)) for r in self.rules if r.kind != "object"]
        return (F.when(F.col("_blank"), F.array())
                .when(F.col("_v").isNull(), F.array(F.lit("malformed")))
                .when(F.col("_m").isNull(), F.array(F.lit("object")))
                .otherwise(F.filter(F.array(*per_rule), lambda c: c.isNotNull())))

    def typed_row(self) -> list[Column]:
        """Accepted object → the declared columns in declared order."""
        m = F.col("_m")
        return [F.try_variant_get(J.field(m, f), "$", self.types[f]).alias(f) for f in self.fields]


VENDOR = RuleSet(JSON_FIELDS, VENDOR_RULES, VENDOR_TYPES)


def decode_status(prepared: DataFrame, pos_col: str = "line_no") -> DataFrame:
    """Inspect-mode decoding: ``object``, ``not_object`` or ``malformed`` (blank lines too)."""
    status = (F.when(F.col("_v").isNull(), "malformed")
              .when(F.col("_m").isNull(), "not_object").otherwise("object"))
    return prepared.select(pos_col, status.alias("decode_status"))


def first_rule_by_line(prepared: DataFrame, rules: RuleSet = VENDOR, pos_col: str = "line_no"
                       ) -> DataFrame:
    return prepared.select(pos_col, rules.first_rule().alias("rule"))


def rule_violation_counts(prepared: DataFrame, rules: RuleSet = VENDOR) -> DataFrame:
    """Lines breaking each rule (every rule, not only the first)."""
    return (prepared.select(F.explode(rules.violations()).alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("n_lines")))


def accepted_rows(prepared: DataFrame, rules: RuleSet = VENDOR, pos_col: str = "line_no"
                  ) -> DataFrame:
    """Rows a strict load would store: valid lines only, typed, blank lines skipped."""
    return (prepared.filter(rules.first_rule() == VALID)
            .select(pos_col, *rules.typed_row()))


def schema_drift(prepared: DataFrame, fields: tuple[str, ...] = JSON_FIELDS,
                 pos_col: str = "line_no") -> DataFrame:
    """Objects whose key set differs from the declared one: missing and extra keys."""
    keys = F.map_keys(F.col("_m"))
    expected = F.array(*[F.lit(f) for f in fields])
    missing = F.array_sort(F.array_except(expected, keys))
    extra = F.array_sort(F.array_except(keys, expected))
    return (prepared.filter(F.col("_m").isNotNull())
            .select(pos_col, F.array_join(missing, ",").alias("missing_fields"),
                    F.array_join(extra, ",").alias("extra_fields"))
            .filter((F.col("missing_fields") != "") | (F.col("extra_fields") != "")))
