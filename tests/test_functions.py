import datetime

import pytest
from pyspark.sql import functions as F

from lotmill.functions import text as T
from lotmill.params import STATES


@pytest.fixture(scope="module")
def apply(spark):
    def run(f, values, kind="string"):
        df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
        return [r[0] for r in df.withColumn("o", f(F.col("v"))).orderBy("k").select("o").collect()]

    return run


def test_dates(apply):
    got = apply(T.parse_date, ["05-03-2026", "5-3-2026", "\t05-03-2026 \n", "31-02-2026", "2026-03-05", "", None, "05-03-26"])
    assert got == [datetime.date(2026, 3, 5)] * 3 + [None] * 5
    assert apply(lambda c: T.date_flag(c, "d"), ["x", " ", None, "1-1-2026"]) == ["d.unparseable", None, None, None]


def test_amounts(apply):
    assert apply(T.parse_amount, ["1,11,41,39,999", "0", "Rs. 5", "", None, "-5", "9" * 30]) == [1114139999, 0, None, None, None, None, None]
    assert apply(T.digits_amount, ["Rs. 1,000/-", "none", None]) == [1000, None, None]


def test_norm_and_key(apply, spark):
    assert apply(T.norm, [" A b\t", None, ""]) == ["a b", "", ""]
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (" A|B ", "c"), (None, None)], "x string, y string")
    keys = [r[0] for r in rows.select(T.listing_key([F.col("x"), F.col("y")])).collect()]
    assert keys[0] == keys[1] == keys[2] != keys[3] and all(len(k) == 24 for k in keys)


def test_placeholders(apply):
    assert apply(T.without_placeholder, [" n.a. ", "-", "NA", "N/A", "", None, "Active"]) == [None] * 6 + ["Active"]


def test_teaser(apply):
    got = apply(T.collapse_teaser, [["Land and Build...", "Land and Building, Pune"], ["One"], [], ["Cars", "Land"], ["A...", "B"]], "array<string>")
    assert [(g.text, g.uncertain) for g in got] == [("Land and Building, Pune", False), ("One", False), ("", False), ("Cars | Land", True), ("A... | B", True)]


def test_form(apply):
    form = (
        "Form\n1. Name of Corporate Debtor Acme\n Ltd 2. CIN/LLPIN of Corporate Debtor U18101KA2002PLC000001\n11. EMD Amount Rs. 10,000\n"
        "12. Auction Platform Others 12(a). Auction Platform (Others) site x\n16. Location of Assets to be Auctioned Goa Unique Number - 5"
    )
    got = apply(T.form_fields, [form, "no labels", None])
    assert got[0] == {
        "corporate_debtor_pdf": "Acme Ltd", "cin": "U18101KA2002PLC000001", "emd_amount_raw": "Rs. 10,000", "auction_platform": "Others",
        "auction_platform_other": "site x", "location_raw": "Goa",
    }
    assert got[1] == {} and not got[2]


def test_areas(apply):
    mentions = apply(T.area_mentions, ["7,450 sq. ft and 2 acres", "1,68,003.00 Sq mtrs", "none", None])
    assert mentions == [["7,450 sq. ft", "2 acres"], ["1,68,003.00 Sq mtrs"], [], []]
    assert apply(T.area_sqft, ["7,450 sq. ft", "2 acres", "3 yards", ", cents", "10 cents"]) == [7450.0, 87120.0, None, None, 4356.0]
    sizes = apply(T.plot_size, [["7,450 sq. ft"], ["100 sq ft", "900 sq ft"], ["500 sq. mtrs", "500 sq. mtrs"], [], ["48,859 sq. meters"], ["x acres"]], "array<string>")
    assert [s.sqft for s in sizes] == [7450.0, None, 5382.0, None, 525913.4, None]
    assert sizes[1].flags == ["area.ambiguous"] and sizes[3].flags == ["area.none"] and sizes[5].flags == ["area.unparsed", "area.unconverted"]


def test_states(apply):
    got = apply(lambda c: T.state_of(c, STATES), ["Pune, MAHARASHTRA", "Goalpara", "Delhi and Punjab", " ", None, "Jammu  & Kashmir", "Dadra & Nagar Haveli", "New Delhi"])
    assert [(g.state, g.flag) for g in got] == [
        ("Maharashtra", None), (None, "state.none"), ("Punjab", "state.ambiguous"), (None, "state.blank"), (None, "state.blank"), ("Jammu and Kashmir", None),
        ("Dadra and Nagar Haveli and Daman and Diu", None), ("Delhi", None),
    ]


def test_registrar(apply):
    got = apply(T.registrar_state, ["U18101KA2002PLC000001", " u18101up2002plc000001", "U18101TG2002PLC000001", "U18101TZ2002PLC000001", "U18101QQ2002PLC000001", "short", None])
    assert got == ["karnataka", "uttar pradesh", "telangana", "tamil nadu", None, None, None]
    assert apply(T.state_slug, ["Jammu & Kashmir"]) == ["jammu_and_kashmir.csv"]


def test_classes(apply):
    got = apply(T.possession, ["Physical Possession", "symbolic possession", "physical possession, symbolic possession", "other", None])
    assert [g.status for g in got] == ["physical", "symbolic", None, None, None]
    assert [g.flag for g in got][2:4] == ["possession.ambiguous", "possession.none"]
    assert apply(T.land_class, ["non agricultural", "Agricultural land", "nothing", None]) == ["non-agricultural", "agricultural", None, None]


def test_shown(apply):
    assert apply(T.currency, [12000000, 0, None, 999, 1000, -1234567], "long") == [
        "Rs. 1,20,00,000", "no reserve fixed (per notice)", "not disclosed", "Rs. 999", "Rs. 1,000", "-Rs. 12,34,567",
    ]
    assert apply(T.show_date_text, ["2026-08-11", "soon", None]) == ["11 Aug 2026", "soon", "unknown"]


def test_links(apply):
    assert apply(lambda c: T.absolute_link(c, "https://x"), ["/a.pdf", "http://y/b", "javascript:void", "", None]) == ["https://x/a.pdf", "http://y/b", None, None, None]


def test_tiers_and_means(apply, spark):
    rows = spark.createDataFrame([("Acme", "Pune"), ("Acme", None)], "n string, l string").select(T.search_tiers(F.col("n"), F.col("l")))
    a, b = (r[0] for r in rows.collect())
    assert len(a) == 4 and len(b) == 3 and a[-1] == b[-1] == "Acme" and a[0] == '"Acme" Pune auction OR insolvency OR NCLT'
    rows = spark.createDataFrame([(92.0, 80.0, 70.0), (None, 50.0, 50.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in rows.select(T.mean_known(F.col("a"), F.col("b"), F.col("c"))).collect()] == [80.7, 50.0, None]


def test_form_labels_count_where_they_stand_first(spark):
    text = "1. Name of Corporate Debtor\nA  B\n10. Reserve Price 5\n16. Location of Assets to be Auctioned Pune 10. Reserve Price 6 Unique Number - 7"
    late = "2. CIN/LLPIN of Corporate Debtor U1 Unique Number - 3 11. EMD Amount 4"
    df = spark.createDataFrame([(text,), (late,), ("nothing",), (None,)], "t string")
    got = [r[0] for r in df.select(T.form_fields(F.col("t"))).collect()]
    assert got[0] == {"corporate_debtor_pdf": "A B", "reserve_price_pdf_raw": "5", "location_raw": "Pune 10. Reserve Price 6"}
    assert got[1] == {"cin": "U1 Unique Number - 3", "emd_amount_raw": ""} and got[2] == {} and not got[3]


def test_areas_of_absurd_size(spark):
    df = spark.createDataFrame([("99,99,99,99,999 hectares",), ("9" * 400 + " acres",), ("9" * 40 + " sq ft",)], "t string")
    got = [r[0].sqft for r in df.select(T.plot_size(T.area_mentions(F.col("t")))).collect()]
    assert got[0] == pytest.approx(99999999999 * 107639.1, rel=1e-3) and got[2] == 1e40 and got[1] in (None, float("inf"))


def test_rounding_beyond_decimals(spark):
    row = spark.range(1).select(T.round1(F.lit(2.25)).alias("a"), T.round1(F.lit(1e300)).alias("b"), T.round1(F.lit(float("nan"))).alias("c"), T.mean_known(F.lit(1e15), F.lit(None).cast("double")).alias("d")).first()
    assert (row.a, row.b, row.d) == (2.3, 1e300, 1e15) and row.c != row.c
