"""Strict validation: accepted records, first failing rules, number edges, malformed lines."""

import json

from intakeyard.operators import rules as R
from intakeyard.sources import positions

COMPANY_1 = {"id": "full-7", "website": "http://mill.test/x;y,z", "name": 'Mill "No. 4",\nold part',
             "founded": 1911, "size": "201-500", "locality": "", "region": None, "country": "Österreich",
             "industry": "paper", "linkedin_url": "li.test/mill"}
COMPANY_2 = {"id": "bare-8", "website": None, "name": "Bare", "founded": None, "size": None,
             "locality": None, "region": None, "country": None, "industry": None, "linkedin_url": None}


def _prepared(spark, lines_file, records):
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records]
    return R.VENDOR.prepare(positions.read_lines(spark, lines_file(lines)))


def test_valid_records_load_and_keep_null_apart_from_empty(spark, lines_file):
    p = _prepared(spark, lines_file, [COMPANY_1, COMPANY_2])
    rows = {r.id: r for r in R.accepted_rows(p).collect()}
    assert set(rows) == {"full-7", "bare-8"}
    assert rows["full-7"].locality == "" and rows["full-7"].region is None
    assert rows["full-7"].name == COMPANY_1["name"] and rows["full-7"].founded == 1911
    assert rows["bare-8"].founded is None


def _first_rule(spark, lines_file, record):
    p = _prepared(spark, lines_file, [record])
    return R.first_rule_by_line(p).collect()[0]


def test_unexpected_field_is_rejected_with_keys_and_line(spark, lines_file):
    r = _first_rule(spark, lines_file, {**COMPANY_1, "extra_column": 1})
    assert r.line_no == 1
    assert r.rule.startswith("unexpected field set: ") and "extra_column" in r.rule


def test_string_year_and_empty_id_are_rejected(spark, lines_file):
    assert _first_rule(spark, lines_file, {**COMPANY_1, "founded": "1911"}).rule == \
        "founded must be an integer or null"
    assert _first_rule(spark, lines_file, {**COMPANY_1, "id": ""}).rule == "id must be a non-empty string"


def test_number_edges(spark, lines_file):
    base = json.dumps({**COMPANY_2, "founded": 0})
    cases = {"2020.0": "valid", "1e3": "valid", "2020.5": "founded must be an integer or null",
             "2147483648": "founded must be an integer or null", "-2147483648": "valid",
             "true": "founded must be an integer or null"}
    recs = [base.replace('"founded": 0', f'"founded": {v}') for v in cases]
    p = _prepared(spark, lines_file, recs)
    got = {r.line_no: r.rule for r in R.first_rule_by_line(p).collect()}
    assert [got[i + 1] for i in range(len(cases))] == list(cases.values())
    typed = {r.line_no: r.founded for r in R.accepted_rows(p).collect()}
    assert typed[1] == 2020 and typed[2] == 1000


def test_malformed_blank_and_non_object(spark, lines_file):
    p = _prepared(spark, lines_file, ["not json", "", "[1]", "null", json.dumps(COMPANY_2)])
    got = [r.rule for r in sorted(R.first_rule_by_line(p).collect())]
    assert got == [R.MALFORMED, R.BLANK_LINE, "record must be an object", "record must be an object", R.VALID]
    status = [r.decode_status for r in sorted(R.decode_status(p).collect())]
    assert status == ["malformed", "malformed", "not_object", "not_object", "object"]


def test_duplicate_keys_keep_last_value(spark, lines_file):
    rec = json.dumps(COMPANY_2)[:-1] + ', "name": "Later"}'
    p = _prepared(spark, lines_file, [rec])
    assert R.accepted_rows(p).collect()[0].name == "Later"
