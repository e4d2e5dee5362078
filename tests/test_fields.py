"""Every field function on edge values, and against Python's own parsers."""

import ipaddress
import itertools
import random

import pytest

from netgroom import functions as N


def _run(spark, function, values, *columns, source="v", **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {source} string")
    rows = function(df, source, "x", **kw).orderBy("i").select(*columns).collect()
    return [tuple(r) if len(columns) > 1 else r[0] for r in rows]


def test_ipv4_edges(spark):
    cases = {
        None: (None, "missing"),
        "": (None, "wrong_octet_count"),
        "   ": (None, "wrong_octet_count"),
        "::1": (None, "ipv6_or_non_ipv4"),
        "1.2.3:4": (None, "ipv6_or_non_ipv4"),
        "1.2.3": (None, "wrong_octet_count"),
        "1.2.3.4.5": (None, "wrong_octet_count"),
        "+1.2.3.4": ("1.2.3.4", "ok"),
        "++1.2.3.4": (None, "non_decimal_format"),
        "+.1.1.1": (None, "non_numeric_or_negative"),
        "1..2.300": (None, "empty_octet"),
        "300..1.1": (None, "octet_out_of_range"),
        "1.2.3.": (None, "empty_octet"),
        ".1.2.3": (None, "empty_octet"),
        "1.2.3.-4": (None, "non_numeric_or_negative"),
        "1.2.3. 4": (None, "non_numeric_or_negative"),
        "1.2.300.x": (None, "octet_out_of_range"),
        "1.2.x.300": (None, "non_numeric_or_negative"),
        "\t010.000.0010.255\n": ("10.0.10.255", "ok"),
        "1.2.3.256": (None, "octet_out_of_range"),
        "1.2.3.99999999999999999999": (None, "octet_out_of_range"),
        "١.2.3.٤": ("1.2.3.4", "ok"),
        "1.2.3.²": (None, "non_decimal_format"),
        "1.2.3.4²": (None, "non_decimal_format"),
        "1.2_0.3.4": (None, "non_numeric_or_negative"),
    }
    got = _run(spark, N.clean_ipv4, list(cases), "x_clean", "x_reason")
    assert dict(zip(cases, got)) == cases


def test_ipv4_against_octets(spark):
    kinds = {
        "7": "ok", "007": "ok", "+8": "ok", "0": "ok", "255": "ok", "000": "ok",
        "": "empty_octet", "a": "non_numeric_or_negative", "-1": "non_numeric_or_negative",
        "+": "non_numeric_or_negative", "1+": "non_numeric_or_negative", "++1": "non_decimal_format",
        "256": "octet_out_of_range", "+999": "octet_out_of_range",
    }
    octets = list(itertools.product(kinds, repeat=4))
    random.Random(1).shuffle(octets)
    octets = octets[:6000]
    got = _run(spark, N.clean_ipv4, [".".join(o) for o in octets], "x_valid", "x_clean", "x_reason")
    for parts, (valid, clean, reason) in zip(octets, got):
        expected = next((kinds[p] for p in parts if kinds[p] != "ok"), "ok")
        assert (reason, valid) == (expected, expected == "ok"), parts
        assert clean == (".".join(str(int(p)) for p in parts) if valid else None)


def test_type_subnet_pointer(spark):
    cases = {
        "10.1.2.3": ("private_rfc1918", "10.0.0.0/8", "10.1.2.0/24"),
        "172.16.5.9": ("private_rfc1918", "172.16.0.0/16", "172.16.5.0/24"),
        "172.31.0.1": ("private_rfc1918", "172.31.0.0/16", "172.31.0.0/24"),
        "172.32.5.9": ("public_or_other", "172.32.5.0/24", ""),
        "172.15.5.9": ("public_or_other", "172.15.5.0/24", ""),
        "172.1.60.9": ("public_or_other", "172.1.60.0/24", ""),
        "192.168.7.8": ("private_rfc1918", "192.168.7.0/24", "192.168.7.0/24"),
        "192.169.7.8": ("public_or_other", "192.169.7.0/24", ""),
        "169.254.9.9": ("link_local_apipa", "169.254.0.0/16", ""),
        "127.9.9.9": ("loopback", "127.0.0.0/8", ""),
        "100.1.1.1": ("public_or_other", "100.1.1.0/24", ""),
        None: ("invalid", "", ""),
    }
    df = spark.createDataFrame([(k,) for k in cases], "ip string")
    rows = df.select(
        "ip", N.ipv4_type(df.ip), N.default_subnet(df.ip), N.private_subnet_24(df.ip), N.reverse_ptr4(df.ip)
    ).collect()
    assert {r[0]: tuple(r[1:4]) for r in rows} == cases
    for r in rows:
        assert r[4] == (None if r[0] is None else ipaddress.ip_address(r[0]).reverse_pointer)
    odd = spark.createDataFrame([("text",)], "ip string")
    assert odd.select(N.ipv4_type(odd.ip), N.default_subnet(odd.ip)).first() == ("invalid_format", "")


def _literals():
    rng = random.Random(7)
    group = lambda: rng.choice(["0", "1", "ab", "DEAD", "00f", "12345", "g", "", "0000"])
    for _ in range(3000):
        groups = [group() for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.6:
            groups.insert(rng.randint(0, len(groups)), "")
        if rng.random() < 0.2:
            groups.append(rng.choice(["1.2.3.4", "1.2.3.256", "01.2.3.4", "1.2.3"]))
        yield ":".join(groups) + rng.choice(["", "", "", "%eth0", "%", "%a%b", "/64"])
    for n in range(10):
        yield "::" + ":".join(["1"] * n)
        yield ":".join(["1"] * n) + "::"
        yield ":".join(["fe"] * n)
    yield from ["::", ":::", ":", "", "1::", "::1.2.3.4", "1.2.3.4", "1.2.3.04", "1.2.3", "::1.2.3.4:5", "1.2.3.4::", None]


def test_ipv6_against_standard_library(spark):
    values = list(_literals())
    pointer = _run(spark, N.reverse_ptr, values, "x")
    version = _run(spark, N.ip_version, values, "x")
    seen = set()
    for value, ptr, ver in zip(values, pointer, version):
        try:
            address = ipaddress.ip_address(value)
        except ValueError:
            address = None
        scoped = getattr(address, "scope_id", None) is not None
        assert ptr == (None if address is None or scoped else address.reverse_pointer), value
        assert ver == ("invalid" if address is None else str(address.version)), value
        seen.add((ver, ptr is None))
    assert seen == {("6", False), ("6", True), ("4", False), ("invalid", True)}


def test_hostname(spark):
    cases = {
        None: (None, False, "missing"),
        "  ": (None, False, "empty_string"),
        "Web.1": ("Web.1", False, "contains_periods"),
        "-a": ("-a", False, "invalid_characters"),
        "a-": ("a-", False, "invalid_characters"),
        "A_b": ("A_b", False, "invalid_characters"),
        "h" * 64: ("h" * 64, False, "too_long"),
        "H" * 63: ("h" * 63, True, "ok"),
        " Srv-01 ": ("srv-01", True, "ok"),
        "é": ("é", False, "invalid_characters"),
        "a\nb": ("a\nb", False, "invalid_characters"),
    }
    got = _run(spark, N.clean_hostname, list(cases), "x_clean", "x_valid", "x_reason")
    assert dict(zip(cases, got)) == cases


def test_site(spark):
    cases = {
        None: ("unknown", "missing"),
        " ": ("unknown", "empty_string"),
        "---": ("", "normalized_site"),
        "Unknown": ("unknown", "missing"),
        " N/A ": ("unknown", "missing"),
        "DC__1,, East": ("dc-1-east", "normalized_site"),
        "HQ-BUILDING-1": ("hq-bldg-1", "normalized_site"),
        "_a　b_": ("a-b", "normalized_site"),
        "n / a": ("n-/-a", "normalized_site"),
    }
    got = _run(spark, N.clean_site, list(cases), "x_clean", "x_reason")
    assert dict(zip(cases, got)) == cases


def test_fqdn(spark):
    cases = {
        None: (None, "missing"),
        " ": (None, "empty_string"),
        "A.B.": ("a.b", "valid"),
        "a..": ("a..", "empty_label"),
        ".": (".", "too_few_labels"),
        "host": ("host", "too_few_labels"),
        "a.lo_cal": ("a.lo_cal", "invalid_domain_label1"),
        "a.-x": ("a.-x", "label_1_hyphen_edge"),
        "a.b.c.x-": ("a.b.c.x-", "label_3_hyphen_edge"),
        "a.b.c!.-d": ("a.b.c!.-d", "invalid_domain_label2"),
        "x" * 64 + ".b": ("x" * 64 + ".b", "label_0_too_long"),
        "a.b." + "x" * 64: ("a.b." + "x" * 64, "label_2_too_long"),
        "a_b.c": ("a_b.c", "invalid_hostname_label"),
        "-a.c": ("-a.c", "invalid_hostname_label"),
        ".a.c": (".a.c", "empty_label"),
        ".".join(["abcdefg"] * 32): (".".join(["abcdefg"] * 32), "valid"),
        ".".join(["abcdefg"] * 33): (".".join(["abcdefg"] * 33), "too_long"),
        "2nd.9": ("2nd.9", "valid"),
        "a\n.b-\n.c": ("a\n.b-\n.c", "valid"),
        "a.b-\nc": ("a.b-\nc", "invalid_domain_label1"),
        "a.é": ("a.é", "invalid_domain_label1"),
    }
    got = _run(spark, N.clean_fqdn, list(cases), "x_clean", "x_reason")
    assert dict(zip(cases, got)) == cases


def test_fqdn_consistency(spark):
    rows = [
        ("h.site", "h", "site", "consistent"),
        ("H.SITE.", "H", "Site", "consistent"),
        ("h.other", "h", "site", "inconsistent"),
        ("h.site", None, "site", "unknown"),
        ("h.site", "h", None, "unknown"),
        ("h", None, None, "inconsistent"),
        (None, "h", "site", "inconsistent"),
    ]
    df = spark.createDataFrame(rows, "f string, h string, s string, want string")
    for row in N.clean_fqdn(df, "f", "x", "h", "s").collect():
        assert row.x_consistent == row.want


def test_mac(spark):
    cases = {
        None: (None, "missing"),
        " ": (None, "empty_string"),
        "AA-BB-CC-DD-EE-FF": ("aa:bb:cc:dd:ee:ff", "valid"),
        " 00:11-22:33-44:5F": ("00:11:22:33:44:5f", "valid"),
        "AAbb.ccdd.eeFF": ("aa:bb:cc:dd:ee:ff", "valid"),
        "001122334455": (None, "invalid_format"),
        "00:11:22:33:44": (None, "invalid_format"),
        "0011.2233-4455": (None, "invalid_format"),
        "00:11:22:33:44:55:66": (None, "invalid_format"),
    }
    got = _run(spark, N.clean_mac, list(cases), "x_clean", "x_reason")
    assert dict(zip(cases, got)) == cases


def test_owner(spark):
    cases = {
        None: (None, None, None, "missing"),
        " \t": (None, None, None, "missing"),
        "()": (None, None, "", "owner_valid_and_normalized"),
        "Li ( Net Ops ) Wei": ("li  wei", None, "Net Ops", "owner_valid_and_normalized"),
        "a@x.io Bob b@y.io (A) (B)": ("bob", "a@x.io", "A", "owner_valid_and_normalized"),
        "Jo (x y@z.org)": ("jo", "y@z.org", "x", "owner_valid_and_normalized"),
        "jané@corp.example.com": (None, "jané@corp.example.com", None, "owner_valid_and_normalized"),
        "a@b": ("a@b", None, None, "owner_valid_and_normalized"),
        "open (": ("open (", None, None, "owner_valid_and_normalized"),
        "x (a\nb)": ("x (a\nb)", None, None, "owner_valid_and_normalized"),
    }
    got = _run(spark, N.parse_owner, list(cases), "x_clean", "x_email", "x_team", "x_reason")
    assert dict(zip(cases, got)) == cases


@pytest.mark.parametrize("upper", [False, True])
def test_device_type(spark, upper):
    cases = {
        None: ("unknown", 0, "missing"),
        " ": ("unknown", 0, "empty_string"),
        ",": ("unknown", 0, "no_match"),
        "access_point": ("unknown", 0, "no_match"),
        "load_balancer": ("unknown", 0, "no_match"),
        "wireless_ap": ("wireless_ap", 90, "fuzzy_match"),
        "ip_phone": ("ip_phone", 90, "fuzzy_match"),
        "controller": ("wireless_controller", 100, "exact_match"),
        "unknown": ("unknown", 100, "exact_match"),
        " phone ": ("ip_phone", 100, "exact_match"),
        "backups": ("ups", 90, "fuzzy_match"),
        "core sw": ("switch", 90, "fuzzy_match"),
        "swap": ("unknown", 0, "no_match"),
        "pa220": ("firewall", 90, "fuzzy_match"),
        "pa": ("unknown", 0, "no_match"),
        "access-point": ("wireless_ap", 90, "fuzzy_match"),
        "load-balancer": ("load_balancer", 90, "fuzzy_match"),
        "vm switch": ("switch", 90, "fuzzy_match"),
        "iot": ("unknown", 0, "no_match"),
    }
    values = [v.upper() if v and upper else v for v in cases]
    got = _run(spark, N.clean_device_type, values, "x_clean", "x_confidence", "x_reason")
    assert dict(zip(cases, got)) == cases
