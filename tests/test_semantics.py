"""Hand-written micro-fixtures: each pins one semantic decision of the
customer jobs (expected rows written from the job specifications)."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from recsmith.functions import dates as D
from recsmith.functions import numbers as N
from recsmith.functions import rules as R
from recsmith.functions import strings as S
from recsmith.functions.blanks import is_blank
from recsmith.operators import dedup as DD
from recsmith.operators import filters as FL
from recsmith.operators import joins as J
from recsmith.sources.layout import Layout, unpack_hex
from recsmith.sinks.writers import quoted_line


def test_blank_and_missing_are_both_blank(spark):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "   "), ("d", "\u0000\u0000"), ("e", "2001")],
                               "k string, v string")
    assert rows(df.filter(~is_blank("v")), "k") == [("e",)]


def test_delete_equal_keeps_missing(spark):
    df = spark.createDataFrame([("1", "O"), ("2", None), ("3", ""), ("4", "M")], "k string, g string")
    assert rows(FL.drop_equal(df, "g", "O"), "k") == [("2",), ("3",), ("4",)]


def test_positional_match_merge(spark):
    # key A: 3 left x 2 right; key B: 1 left x 0 right; key C: 0 left x 1 right
    left = spark.createDataFrame([("A", 1, "l1"), ("A", 2, "l2"), ("A", 3, "l3"), ("B", 1, "b1")],
                                 "k string, o int, lv string")
    right = spark.createDataFrame([("A", "r1"), ("A", "r2"), ("C", "c1")], "k string, rv string")
    for skew_safe in (False, True):
        out = J.match_merge(left, right, "k", ["o"], ["rv"], keep="all", skew_safe=skew_safe)
        got = rows(out, "k", "lv", "rv", "slot")
        assert got == [("A", "l1", "r1", 1), ("A", "l2", "r2", 2), ("A", "l3", "r2", 3),
                       ("B", "b1", None, 1), ("C", None, "c1", 1)]
        kept = J.match_merge(left, right, "k", ["o"], ["rv"], keep="left", skew_safe=skew_safe)
        assert sorted(r.k for r in kept.collect()) == ["A", "A", "A", "B"]


def test_overlay_right_wins_when_matched(spark):
    main = spark.createDataFrame([("1", "M1", "n1"), ("2", "M2", "n2")], "k string, BRANCH string, name string")
    org = spark.createDataFrame([("1", "O1")], "k string, BRANCH string")
    out = J.overlay_merge(main, org, "k")
    assert rows(out, "k", "BRANCH", "name") == [("1", "O1", "n1"), ("2", "M2", "n2")]


def test_same_bytes_read_twice_last_wins(spark):
    df = spark.createDataFrame([("ABCDEFGHIJ",)], "value string")
    lay = Layout.of([("X", 1, 3), ("Y", 1, 2), ("X", 5, 3)])
    assert rows(lay.decode(df)) == [("EFG", "AB")]


def test_zip_first_line_wins_with_exclusions(spark):
    df = spark.createDataFrame([
        ("12,45 X", "23456 TOWN", "34567 CITY"),
        ("00001 X", "99998 X", "1ABCD X"),
        ("12345", "54321 B", ""),
    ], "l2 string, l3 string, l4 string")
    pick = N.first_matching_source([(S.zip_line_ok(c), S.zip_of(c)) for c in ("l2", "l3", "l4")])
    assert [r[0] for r in df.select(pick).collect()] == ["23456", "1ABCD", "12345"]


def test_zip_state_boundaries(spark):
    df = spark.createDataFrame([("69000",), ("68199",), ("68200",), ("05000",), ("04999",), ("1ABCD",),
                                ("87000",)], "z string")
    got = [r[0] for r in df.select(R.zip_state("z")).collect()]
    assert got == ["PAH", "SEL", "", "KED", "", "", "LAB"]


def test_loan_status_precedence(spark):
    df = spark.createDataFrame([
        ("3", 50, "P", 10),   # paid wins over arrears and NPL
        ("3", 50, "", 10),    # arrears wins over NPL
        ("0", 95, "", 10),    # NPL by days
        ("0", 1, "", 10),     # 1 is in no bucket -> ACTIVE from balance
        ("0", 92, "", 0),     # 92 is in no bucket, no balance -> ''
        ("0", None, "", 5),   # missing days compare false
    ], "npl string, ad int, paid string, bal int")
    got = [r[0] for r in df.select(R.loan_status("npl", "ad", "paid", "bal")).collect()]
    assert got == ["PAID-OFF", "ACCOUNT IN ARREARS", "NPL", "ACTIVE", "", "ACTIVE"]


def test_packed_dates_and_dummy(spark):
    df = spark.createDataFrame([(10031998123,), (0,), (1011999000,)], "n long")
    assert [r[0] for r in df.select(D.packed_mmddyyyy_to_yyyymmdd("n")).collect()] == \
        ["19981003", "00000000", "19990101"]
    t = spark.createDataFrame([("00002000000",), ("",), (" 1011999000",)], "t string")
    assert [r[0] for r in t.select(D.open_date_text("t")).collect()] == ["20000101", "00000000", "19990101"]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("1", "2020-01-01", "a"), ("1", "2021-05-01", "b"), ("2", "2019-01-01", "c")],
                               "k string, d string, v string")
    assert rows(DD.latest_per_key(df, "k", ["d"]), "k", "v") == [("1", "b"), ("2", "c")]


def test_flag_join_does_not_fan_out(spark):
    fact = spark.createDataFrame([("A",), ("B",)], "k string")
    ids = spark.createDataFrame([("A",), ("A",), ("Z",)], "id string")
    out = J.flag_join(fact, ids, ["k"], ["id"], flag="hit")
    assert rows(out) == [("A", True), ("B", False)]


def test_quoted_line_with_trailer(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    line = df.select(quoted_line(["a", "b"], ",", ", \\N")).first()[0]
    assert line == '"1","x", \\N'


def test_zero_pad_sign_and_overflow(spark):
    df = spark.createDataFrame([(5,), (-5,), (123456,), (None,)], "n long")
    assert [r[0] for r in df.select(S.zero_pad("n", 3)).collect()] == ["005", "-05", "123456", None]


def test_packed_decimal_nibbles(spark):
    df = spark.createDataFrame([("12345C",), ("00450D",), ("404040",), ("0012F",)], "h string")
    got = [r[0] for r in df.select(unpack_hex(F.col("h"))).collect()]
    assert got == [12345, -450, None, 12]
    scaled = [r[0] for r in df.select(unpack_hex(F.col("h"), 2)).collect()]
    assert scaled[0] == Decimal("123.45")


def test_implied_decimals(spark):
    df = spark.createDataFrame([("000012345",), ("   123.40",), ("   ",)], "value string")
    out = Layout.of([("amt", 1, 9, "n", 2)]).decode(df)
    assert [r[0] for r in out.collect()] == [Decimal("123.45"), Decimal("123.40"), None]


def test_delimited_short_rows(spark, tmp_path):
    from recsmith.sources.readers import read_delimited
    p = tmp_path / "alias.txt"
    p.write_text('"IC";"ABCDEFGH"\n"PP"\n"XYZW";"LONGER THAN THREE"\n')
    out = read_delimited(spark, str(p), ["ALIASKEY", "ALIAS"], sep=";", max_width={"ALIASKEY": 3, "ALIAS": 5})
    assert rows(out) == [("IC", "ABCDE"), ("PP", ""), ("XYZ", "LONGE")]


def test_account_rules(spark):
    df = spark.createDataFrame([("03000000001", "000"), ("06719999999", "000"), ("01500000000", "371"),
                                ("04500000000", "476"), ("09000000000", "000"), ("03000000000", "000")],
                               "a string, p string")
    got = [r[0] for r in df.select(R.deposit_appl_code("a", "p")).collect()]
    assert got == ["CA", "", "FCYFD", "FCYCA", "", ""]
    pre = spark.createDataFrame([("05",), ("02",), ("09",)], "a string")
    assert [r[0] for r in pre.select(R.account_prefix_code("a")).collect()] == ["DP", "LN", ""]


def test_text_compare_ignores_padding(spark):
    df = spark.createDataFrame([("DP   ",), ("DP",), ("FD",)], "c string")
    assert rows(FL.keep_in(df, "c", ["DP   "])) == [("DP",), ("DP   ",)]


def test_expiry_cut_off_keeps_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", "2000-01-01"), ("c", "2030-01-01")], "k string, d string")
    df = df.withColumn("d", F.to_date("d"))
    assert rows(df.filter(FL.not_expired("d", "2020-01-01")), "k") == [("a",), ("c",)]


def test_owners_dedup_matches_brute_force(spark):
    """Owner records: the inputs are deduplicated before the join; the result
    must equal distinct-after-join computed directly (duplicate account and
    relationship records, a missing key, a hot customer, flipped edges)."""
    from recsmith.plans.owners import account_owners

    acct = [("01000000001", "C1", "AAA", "901"), ("01000000001", "C1", "AAA", "901"),
            ("02000000002", "C1", "BBB", "901"), ("03000000003", "C2", "CCC", "000"),
            ("04000000004", None, "DDD", "901"), ("08000000005", "C3", "EEE", "901")]
    acct += [(f"05{i:09d}", "HOT", "HHH", "901") for i in range(40)]
    rel = [("C1", "A", "C2", "B"), ("C1", "A", "C2", "B"), ("C2", "B", "C1", "A"),
           ("C3", "X", "C1", "Y"), (None, "Z", "C3", "Z"), ("C9", "Q", "C8", "R")]
    rel += [("HOT", "H", f"P{i}", "K") for i in range(30)]
    acct_df = spark.createDataFrame(acct, "ACCTNOC string, CUSTNO string, RLENCODE string, PRISEC string")
    rel_df = spark.createDataFrame(rel, "CUST1 string, CODE1 string, CUST2 string, CODE2 string")

    def code(acct_no):
        p = acct_no[:2]
        return "LN" if p in ("02", "08") else "DP" if p in ("01", "03", "04", "05", "06", "07") else ""

    both = [(a, ca, b, cb) for a, ca, b, cb in rel] + [(b, cb, a, ca) for a, ca, b, cb in rel]
    # a missing value is laid out as blanks in the record: '' after trimming
    expected = sorted({(code(no), no, rc, cust, c1 or "", c2 or "", cd2 or "")
                       for no, cust, rc, pri in acct if pri == "901" and cust is not None
                       for k, c1, c2, cd2 in both if k == cust})
    got = account_owners(acct_df, rel_df)
    assert got.columns == ["ACCTCODE", "ACCTNOC", "RLENCODE", "CUSTNO", "CODE1", "CUSTNO2", "CODE2"]
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert got.count() == len(expected)


def test_relationship_enrichment_matches_brute_force(spark):
    """Both-sides enrichment against a direct reading of the specification:
    lookups first, then each positional alias merge in the full side order
    (ties, several aliases per customer, more aliases than rows, no alias,
    no name, expired and blank-expiry rows)."""
    from recsmith.plans.relationships import enrich_both_sides

    rel = [("A", "X", 1, 2, 20200101, ""), ("A", "X", 1, 2, 20200101, ""),
           ("A", "Y", 2, 1, 20190101, ""), ("B", "X", 1, 2, 20200101, ""),
           ("B", "X", 3, 2, 20180101, ""), ("C", "Y", 1, 1, 20200101, "2001-01-01"),
           ("D", "Z", 1, 1, 20200101, ""), ("A", "Z", 1, 1, 20210101, "  ")]
    codes = [(1, "ONE"), (2, "TWO"), (3, "THREE")]
    names = [("A", "I", "ANN"), ("B", "O", "BOB"), ("C", "I", "CAT"), ("D", "I", "DAN"),
             ("X", "O", "XEN"), ("Y", "I", "YUL")]
    aliases = [("A", "AL3"), ("A", "AL1"), ("A", "AL2"), ("B", "BL1"), ("X", "XL2"), ("X", "XL1"),
               ("X", "XL5"), ("X", "XL4"), ("X", "XL3"), ("Y", "YL1")]
    custs = [("A", "000000001", "RET"), ("X", "000000002", "COR"), ("Y", "000000003", "RET"),
             ("Z", "000000004", "GOV")]
    got = enrich_both_sides(
        spark.createDataFrame(rel, "CUSTNO string, CUST2 string, CODE1 int, CODE2 int, EFFDATE long, EXPDATE1 string"),
        spark.createDataFrame(codes, "CODE int, DESC string"),
        spark.createDataFrame(names, "CUSTNO string, INDORG string, CUSTNAME string"),
        spark.createDataFrame(aliases, "CUSTNO string, ALIAS string"),
        spark.createDataFrame(custs, "CUSTNO string, OLDIC string, BASICGRPCODE string"))

    code_d, name_d, cust_d = dict(codes), {n[0]: n[1:] for n in names}, {c[0]: c[1:] for c in custs}

    def nulls_first(row, cols):
        return tuple((row[c] is not None, row[c]) for c in cols)

    def side(rows, party, code, s, order):
        for r in rows:
            r["DESC" + s] = code_d.get(r[code])
            r["INDORG" + s], r["CUSTNAME" + s] = name_d.get(r[party], (None, None))
        out = []
        for k in sorted({r[party] for r in rows}):
            left = sorted([r for r in rows if r[party] == k], key=lambda r: nulls_first(r, order))
            right = sorted(a for c, a in aliases if c == k)
            for i in range(max(len(left), len(right))):
                r = dict(left[min(i, len(left) - 1)])
                r["ALIAS" + s] = right[min(i, len(right) - 1)] if right else None
                r["OLDIC" + s], r["BASICGRPCODE" + s] = cust_d.get(k, (None, None))
                out.append(r)
        return out

    rows = [dict(CUSTNO1=a, CUSTNO2=b, CODE1=c1, CODE2=c2, EFFDATE=e) for a, b, c1, c2, e, x in rel
            if x.strip() == ""]
    rows = side(rows, "CUSTNO1", "CODE1", "1", ["CODE1", "CUSTNO2", "CODE2", "EFFDATE"])
    rows = side(rows, "CUSTNO2", "CODE2", "2", ["CODE2", "CUSTNO1", "CODE1", "EFFDATE", "DESC1", "INDORG1",
                                               "CUSTNAME1", "ALIAS1", "OLDIC1", "BASICGRPCODE1"])
    cols = ["CUSTNO1", "CUSTNO2", "DESC1", "DESC2", "CUSTNAME1", "CUSTNAME2", "ALIAS1", "ALIAS2",
            "OLDIC1", "OLDIC2"]
    expected = sorted(tuple(r[c] or "" for c in cols) + (f"{r['EFFDATE']:08d}",) for r in rows)
    assert rows_of(got, cols + ["EFFDATE"]) == expected


def rows_of(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_match_merge_keeps_missing_keys(spark):
    left = spark.createDataFrame([(None, 1, "l0"), (None, 2, "l1"), ("A", 1, "a")], "k string, o int, lv string")
    right = spark.createDataFrame([(None, "r0"), ("B", "b")], "k string, rv string")
    want = [(None, "l0", "r0", 1), (None, "l1", "r0", 2), ("A", "a", None, 1), ("B", None, "b", 1)]
    for skew_safe in (False, True):
        out = J.match_merge(left, right, "k", ["o"], ["rv"], keep="all", skew_safe=skew_safe)
        got = [tuple(r) for r in out.select("k", "lv", "rv", "slot").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_match_merge_hot_key_both_ways(spark):
    # One key holds most rows on both sides; a shared column takes the right value.
    left = spark.range(400).select(F.when(F.col("id") < 300, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id").alias("o"), F.lit("l").alias("s"))
    right = spark.range(330).select(F.when(F.col("id") < 280, "hot").otherwise((F.col("id") + 70).cast("string")).alias("k"),
                                    F.col("id").alias("p"), F.concat(F.lit("r"), F.col("id")).alias("s"))
    for overlay in ("matched", "positional"):
        got = [rows(J.match_merge(left, right, "k", ["o"], ["p"], keep="all", overlay=overlay, skew_safe=safe))
               for safe in (False, True)]
        assert got[0] == got[1] and len(got[0]) == 300 + max(100, 0)
        last = [r for r in got[0] if r[0] == "hot" and r[4] == 300][0]
        assert last == (("hot", 299, "r279" if overlay == "matched" else "l", 279, 300, True, True))


def test_every_new_tax_id_is_tested(spark):
    from recsmith.plans.taxid import tax_matches

    old = spark.createDataFrame([("1", "I", "OLD1", "00001"), ("2", "O", "OLD2", "00002")],
                                "CUSTNO string, INDORG string, OLDIC string, CUSTBRCH string")
    new = spark.createDataFrame([("1", "NICAAA"), ("1", "NICBBB"), ("2", "NICCCC")], "CUSTNO string, NEWIC string")
    watch = spark.createDataFrame([("BBB", "OLD2")], "ID1 string, ID2 string")
    assert rows(tax_matches(old, new, watch), "CUSTNO", "NEWIC", "BUSREG", "RHOLD_IND", "MATCHID") == [
        ("1", "NICAAA", "", "N", "X"), ("1", "NICBBB", "", "Y", "N"), ("2", "NICCCC", "NICCCC", "Y", "O")]


def test_records_stay_whole_on_missing_and_wide_numbers(spark):
    lay = Layout.of([("a", 1, 3, "x"), ("b", 7, 6, "n", 2), ("c", 13, 4, "z"), ("d", 17, 2), ("e", 19, 4, "n")], lrecl=24)
    df = spark.createDataFrame([(12, 1.5, 7, "t", 5), (None, None, None, None, None), (1234567, 1234567.89, 123456, "long", -99999)],
                               "a long, b double, c long, d string, e long")
    out = df.select(lay.render_expr().alias("v"), lay.overflow_count().alias("n"))
    assert [tuple(r) for r in out.collect()] == [
        ("00012C" + "  1.50" + "0007" + "t " + "   5  ", 0), ("00000C" + " " * 18, 0),
        ("*" * 16 + "lo" + "****  ", 4)]


def test_risk_codes_are_always_sixty_characters(spark):
    from recsmith.plans.combined import CUST_KEEP, customer_part

    c = spark.createDataFrame([("1", 5, None, "7")], "CUSTNO string, HRC01 long, HRC03 long, HRC20 string")
    c = c.withColumns({n: F.lit("") for n in CUST_KEEP})
    c = c.withColumns({n: F.lit(1) for n in ("PRIPHONE", "SECPHONE", "MOBILEPH", "FAX", "ADDREF")}).withColumn(
        "CUSTOPENDATE", F.lit("00002000000"))
    got = customer_part(c).first()["HRCALL"]
    assert got == "005" + "000" * 18 + "007"


def test_packed_binary_reader(spark, tmp_path):
    from recsmith.sources.readers import read_fixed_binary

    path = tmp_path / "packed.dat"
    path.write_bytes(b"".join(b"AB" + bytes.fromhex(h) for h in ("00123C", "99999D", "00000F", "0012AC")))
    lay = Layout.of([("t", 1, 2), ("n", 3, 3, "p", 2)])
    got = [tuple(r) for r in read_fixed_binary(spark, str(path), 5, lay).collect()]
    assert got == [("AB", Decimal("1.23")), ("AB", Decimal("-999.99")), ("AB", Decimal("0.00")), ("AB", None)]


def test_report_numbers_are_whole(spark):
    """Six-digit numbers keep all their digits; the line only grows."""
    from recsmith.plans import report as RP

    names = [f[2] for f in RP.REPORT_FIELDS[1:]]
    rows_ = spark.range(100_001).select(F.lit(1).alias("SRC"), F.lpad(F.col("id").cast("string"), 11, "0").alias("ACCTNOC"),
                                        *[F.lit("0").alias(n) for n in names if n != "ACCTNOC"])
    lines = {r.line_no: r.value for r in RP.report_lines(rows_).where("line_no in (-1, 0, 1, 99999, 100000, 100001)").collect()}
    assert lines[1].startswith("    1;") and lines[99999].startswith("99999;") and len(lines[1]) == 800
    assert lines[100000].startswith("100000;") and lines[100001].startswith("100001;") and len(lines[100001]) == 801
    assert len(lines[0]) == 800 and lines[0][695:701] == "SEQ ;A"
