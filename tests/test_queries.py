"""Every registered query against its SQL."""

import pytest
from compare import connect, rows_of, rows_of_sql
from conftest import SF

import __spark_entry__ as registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) >= {name for name in registry.queries() if name.startswith("q_")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    names, rows = rows_of(registry.queries()[name](spark, SF))
    want_names, want, _ = rows_of_sql(duck, SQL[name])
    assert names == want_names
    assert sum(rows.values()) > 0
    assert rows == want


def test_entry(spark):
    assert registry.entry(spark).count() == 1500


def test_fixture_reaches_every_reason(spark):
    rows = registry.queries()["q_quality_report"](spark, SF).collect()
    reached = {(r.field, r.reason) for r in rows}
    expected = {
        "ip": "ok missing ipv6_or_non_ipv4 wrong_octet_count empty_octet non_numeric_or_negative "
        "non_decimal_format octet_out_of_range",
        "hostname": "ok missing empty_string too_long contains_periods invalid_characters",
        "fqdn": "valid missing empty_string too_long too_few_labels empty_label invalid_hostname_label "
        "invalid_domain_label1 label_1_hyphen_edge label_1_too_long",
        "mac": "valid missing empty_string invalid_format",
        "owner": "missing owner_valid_and_normalized",
        "device_type": "exact_match fuzzy_match missing empty_string no_match",
        "site": "missing empty_string normalized_site",
    }
    assert reached == {(f, r) for f, reasons in expected.items() for r in reasons.split()}
