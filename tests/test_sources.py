import csv
import os

import pytest

from lotmill.sources import csv_records, pages, registry, registry_source

PAGE = """<table><tr><td>menu</td></tr></table><table><tr><th>Date</th><th>Name of Corporate Debtor</th><th>Reserve Price</th><th>Details</th></tr>
<tr><td>1-1-2024</td><td>Acme <b>Ltd</b> &amp; Co</td><td>5</td><td><a href="/d/1.pdf">PDF</a> <a href="/no">x</a></td></tr><tr></tr>
<tr><td>2-1-2024</td><td>B</td><td>6</td></tr><tr><td>cut</td></tr></table>"""


def test_table_rows(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "page int, html string")
    good, rejects = pages.split_rows(pages.extract_rows(df))
    got = good.orderBy("row_idx").collect()
    assert [c.text for c in got[0].cells] == ["1-1-2024", "Acme Ltd & Co", "5", "PDF x"] and got[0].cells[3].href == "/d/1.pdf"
    assert len(got) == 2 and [(r.row_idx, r.raw_text) for r in rejects.collect()] == [(4, "cut")]


def test_records_by_header(spark):
    page = """<table><tr><th>Details</th><th>Reserve Price</th><th>Name of Corporate Debtor</th><th>Reserve price (revised)</th></tr>
    <tr><td><a href='/d'>x</a></td><td>5</td><td>A</td><td>6</td></tr><tr><td>y</td><td>7</td><td>B</td></tr></table>"""
    good, rejects = pages.split_rows(pages.extract_rows(spark.createDataFrame([(1, page)], "page int, html string")))
    got = pages.records(good, ["reserve_price_raw", "corporate_debtor", "auction_date"]).orderBy("row_idx").collect()
    assert rejects.count() == 0 and [r.corporate_debtor.text for r in got] == ["A", "B"] and got[0].reserve_price_raw.text == "6"  # the later column counts
    assert got[1].reserve_price_raw is None and [r.cell_flags for r in got] == [[], ["cell.missing.reserve_price_raw"]] and got[0].auction_date is None


def test_links_in_any_quotes(spark):
    html = """<a href="/1">a</a><A class=x HREF='/2'>b</A><a href=/3>c</a><a data-href="/no">d</a><a href="">e</a><a title='x' href='javascript:f()'>f</a>"""
    got = pages.page_links(spark.createDataFrame([(1, html)], "page_id int, html string"), "b").orderBy("nth").collect()
    assert [(r.url, r.flag) for r in got] == [("b/1", None), ("b/2", None), ("b/3", None), (None, "link.unusable"), (None, "link.unusable")]


def test_links_as_a_parser_sees_them(spark):
    html = """<a href="/x?a=1&amp;b=2">1</a><!-- <a href="/c">no</a> --><script>var s = '<a href="/s">no</a>';</script><a title="a>b" href=/t>2</a><a
    href=" /pad ">3</a><a name=x>none</a>"""
    got = pages.page_links(spark.createDataFrame([(1, html), (2, None)], "page_id int, html string"), "b").orderBy("nth").collect()
    assert [(r.nth, r.url) for r in got] == [(0, "b/x?a=1&b=2"), (1, "b/t"), (2, "b/pad")]


def test_nested_result_blocks(spark):
    html = '<div class="result"><div><div><a href="u">T &amp; <b>x</b></a></div></div><span class="result__snippet">s <span>t</span> u</span></div><div class="other"><a href=v>no</a></div>'
    got = pages.result_blocks(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()
    assert [tuple(r) for r in got] == [(1, 0, "T & x", "u", "s t u")]


def test_longest_header_wins(spark):
    df = spark.createDataFrame([(1, 0, "Date of Auction"), (1, 1, "Date of Notice"), (1, 2, "Other")], "page int, col_idx int, header string")
    mapped = pages.header_mapping(df)
    assert [r.field for r in mapped.orderBy("col_idx").collect()] == ["auction_date", "notice_date", None]
    assert pages.missing_fields(mapped, ["auction_date", "reserve_price_raw"]).first().missing == ["reserve_price_raw"]


def test_result_blocks_cut_before_they_are_checked(spark):
    block = '<div class="result x"><a href="u">%s</a><p class="snippet">s</p></div>'
    df = spark.createDataFrame([(1, (block % "A") + (block % " ") + (block % "C") + (block % "D"))], "page_id int, html string")
    assert [r.title for r in pages.result_blocks(df).collect()] == ["A", "C"]


def test_registry_headers(spark):
    assert registry.match_header(["﻿CIN ", "x"], ["corporate_identification_number", "cin"]) == "﻿CIN "
    raw = spark.createDataFrame([(" u1 ", "NA", 1), ("U1", "Active", 2), (None, "x", 3), ("", "y", 4)], "CIN string, CompanyStatus string, file_pos int")
    got = registry.last_rows(registry.normalise(raw, "goa")).collect()
    assert [(r.cin, r.company_status, r.duplicates, r.company_name) for r in got] == [("U1", "Active", 1, None)]
    with pytest.raises(ValueError):
        registry.normalise(spark.createDataFrame([(1,)], "a int"))


def test_registry_files(spark, tmp_path):
    (tmp_path / "goa.csv").write_text("﻿CIN,CompanyName\nU1,One\n", encoding="utf-8")
    (tmp_path / "delhi.csv").write_text("CORPORATE_IDENTIFICATION_NUMBER,Company Name,PAIDUP_CAPITAL\nU2,Two,5\n", encoding="utf-8")
    got = registry.read_files(spark, {"goa": str(tmp_path / "goa.csv"), "delhi": str(tmp_path / "delhi.csv")})
    assert sorted((r.state, r.cin, r.company_name, r.paidup_capital) for r in got.collect()) == [("delhi", "U2", "Two", "5"), ("goa", "U1", "One", None)]


def test_registry_files_as_they_come(spark, tmp_path):
    (tmp_path / "goa.csv").write_text('CIN,CompanyName,Address\nU1,"One ""A"" Ltd","line 1\nline 2"\nU1,Two,x\n', encoding="utf-8")
    (tmp_path / "delhi.csv").write_text("Name\nx\n", encoding="utf-8")
    (tmp_path / "bihar.csv").write_text("CIN,CompanyName\n,x\n", encoding="utf-8")
    paths = {s: str(tmp_path / f"{s}.csv") for s in ("goa", "delhi", "bihar", "assam")}
    found, reasons = registry.open_files(spark, paths)
    assert reasons == {"delhi": "no_key", "assam": "file_absent", "bihar": "no_rows"}
    rows = found.orderBy("file_pos").collect()
    assert [(r.company_name, r.registered_office_address) for r in rows] == [('One "A" Ltd', "line 1\nline 2"), ("Two", "x")]
    assert registry.last_rows(found).first().company_name == "Two"
    status = {r.state: (r.status, r.n_rows, r.duplicates) for r in registry.availability(found, list(paths), reasons).collect()}
    assert status == {"goa": ("ok", 2, 1), "delhi": ("no_key", 0, 0), "bihar": ("no_rows", 0, 0), "assam": ("file_absent", 0, 0)}
    asked = spark.createDataFrame([("U18101AS2002PLC000001",), ("U18101GA2002PLC000001",)], "cin string")
    assert [r.miss_reason for r in registry.lookup(asked, found, reasons).collect()] == ["file_absent", "no_match"]
    with pytest.raises(ValueError):
        registry.read_files(spark, paths)


NASTY = [
    ["CIN", "Company Name", "Note"], ["U1", 'a "b" c', "x"], ["U2", "two\nlines", ""], ["U3", '"', ","], ["U4", "", 'ends in quote"'], ["U5", "a,b\r\nc", "\n\n"],
    ["U6", 'x"",y', "z"], ["U7", "plain", "é" * 50],
]


@pytest.mark.parametrize("split", [2**27, 4096, 333])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_any_number_of_splits(spark, tmp_path, split, end):
    """The same rows and places however the file is split, breaks in quotes across the splits included."""
    rows = [[f"U{k}", *(NASTY[1 + k % 7][1:])] for k in range(500)] + [["U500", "long\n" * 900, 'q""q']]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows([NASTY[0], *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = csv_records.read_csv(spark, str(tmp_path / "a.csv"))
        assert got.columns == ["CIN", "Company Name", "Note", "file_pos"]
        have = [list(r) for r in got.orderBy("file_pos").collect()]
        assert csv_records._lines(spark, str(tmp_path / "a.csv")).select("split").distinct().count() >= min(20, os.path.getsize(tmp_path / "a.csv") // split)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert have == [[*[v or None for v in r], k] for k, r in enumerate(rows, 1)]


def test_stray_quotes_and_odd_files(spark, tmp_path):
    texts = {"stray": 'CIN,Name\nU1,5" pipe\nU2,"say "hi" now"\nU3,x\n\nU4\nU5,a,b\n', "bom": '\ufeff"CIN","Name"\n"U1","a\nb"', "empty": "", "twice": "A,a,CIN,\n1,2,U1,\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    read = lambda n: csv_records.read_csv(spark, str(tmp_path / f"{n}.csv"))
    assert [(r.CIN, r.Name, r.file_pos) for r in read("stray").orderBy("file_pos").collect()][0::2] == [("U1", '5" pipe', 1), ("U3", "x", 3), ("U5", "a", 6)]
    assert [tuple(r) for r in read("bom").collect()] == [("U1", "a\nb", 1)]
    assert read("empty").count() == 0 and [tuple(r) for r in read("twice").collect()] == [("1", "2", "U1", 1)]


def test_registry_data_source(spark, tmp_path):
    opened = tmp_path / "opened"
    opened.mkdir()
    folder = tmp_path / "reg"
    (folder / "slug=west_bengal").mkdir(parents=True)
    (folder / "goa.csv").write_text('CIN,CompanyName,CompanyStatus\n u1 ,"One\nLtd",-\nU1,Two,Active\n,x,y\n', encoding="utf-8")
    (folder / "slug=west_bengal" / "part-0.csv").write_text("Company Name,CORPORATE_IDENTIFICATION_NUMBER\nThree,U3\n", encoding="utf-8")
    (folder / "delhi.csv").write_text("Name\nx\n", encoding="utf-8")
    (folder / "bihar.csv").write_text("CIN,CompanyName\n,x\n", encoding="utf-8")
    (folder / "kerala.csv").write_text("", encoding="utf-8")
    states = ["goa", "west bengal", "delhi", "bihar", "assam", "kerala"]
    rows = registry_source.registry_rows(spark, folder.as_uri(), states, opened=opened.as_uri())
    assert sorted((r.state, r.cin, r.company_name, r.company_status) for r in rows.where("state IN ('goa', 'west bengal')").collect()) == [
        ("goa", "U1", "One\nLtd", None), ("goa", "U1", "Two", "Active"), ("west bengal", "U3", "Three", None),
    ]
    assert sorted(p.name for p in opened.iterdir()) == ["goa.csv-goa", "part-0.csv-west bengal"]
    assert rows.where("state = 'nowhere'").count() == 0 and registry.last_rows(rows.where("state = 'goa'")).first().company_name == "Two"
    there = {r.state: (r.status, r.n_rows) for r in registry_source.registry_availability(spark, folder.as_uri(), states).collect()}
    assert there == {"goa": ("ok", 2), "west bengal": ("ok", 1), "delhi": ("no_key", 0), "bihar": ("no_rows", 0), "assam": ("file_absent", 0), "kerala": ("no_key", 0)}


def test_lookup_cuts_the_registry_down_first(spark):
    rows = spark.createDataFrame([("U18101GA2002PLC000001",)], "cin string")
    found = spark.createDataFrame([("goa", "U18101GA2002PLC000001", "a", "b", "1", 1), ("goa", "U18101GA2002PLC000001", "c", "b", "1", 2)], "state string, cin string, company_name string, company_status string, paidup_capital string, file_pos long")
    got = registry.lookup(rows, found)
    assert got.first().company_name == "c"
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftSemi")


def test_long_pages_leave_in_small_batches(spark):
    head = "<table><tr><th>Reserve Price</th><th>Corporate Debtor</th></tr>"
    html = head + "".join(f'<tr><td>{k}</td><td><a href="/{k}">D &amp; {k}</a></td></tr>' for k in range(2500)) + "</table>"
    batches = list(pages.row_batches(7, pages.listing_table(html, ["reserve price"])))
    assert [b.num_rows for b in batches] == [1000, 1000, 501] and batches[2].column("row_idx")[-1].as_py() == 2500
    df = spark.createDataFrame([(7, html), (8, ""), (9, None), (10, html)], "page int, html string").coalesce(1)
    got = pages.extract_rows(df).orderBy("page", "row_idx").collect()
    assert [(r.page, r.row_idx) for r in got] == [(p, k) for p in (7, 10) for k in range(2501)]
    assert got[0].is_header and not got[1].is_header and got[2500].headers == ["Reserve Price", "Corporate Debtor"]
    assert got[2500].cells[1].asDict(True) == {"text": "D & 2499", "href": "/2499", "pieces": ["D & 2499"]}


def test_plain_markup_is_read_as_the_parser_reads_it():
    import random

    def parsed(html):
        parser = pages._Tables()
        parser.feed(html)
        parser.close()
        return parser.tables

    bits = [
        "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<TH class=\"x\">", "</th>", '<a href="/x">', '<A title="t" HREF="y" href="z">', '<a href="?a=1&amp;copy=2">', "<a>", "</a>",
        "<b>", "</b>", "<br/>", "<td/>", "text", " ", "a &lt; b", "&amp", "&#65;", "a < b", "<!-- <td> -->", "<script>", "</script>", "<td x='>'>", "<", "&", " ", "\x1c", "<p x=\"1\">",
    ]
    dice, plain = random.Random(1), 0
    for n in range(20000):
        html = "".join(dice.choices(bits[:20] if n % 2 else bits, k=dice.randint(1, 14)))
        plain += pages._plain_tables(html) is not None
        assert pages.tables_of(html) == parsed(html), html
    assert plain > 2000


def test_plain_cells_are_known_without_a_pattern(monkeypatch):
    """Of a table's tags only those with attributes are matched; a pattern on every tag took most of the time of a page."""
    tried, pattern = [], pages._TAG

    class Counted:
        def fullmatch(self, name):
            tried.append(name)
            return pattern.fullmatch(name)

    monkeypatch.setattr(pages, "_TAG", Counted())
    html = "<table>" + '<tr><td>a &amp; b</td><td><a href="/n">PDF</a> end</td></tr>' * 500 + "</table>"
    (rows,) = pages._plain_tables(html)
    assert len(rows) == 500 and rows[-1] == [{"tag": "td", "href": None, "pieces": ["a & b"]}, {"tag": "td", "href": "/n", "pieces": ["PDF", "end"]}]
    assert len(tried) == 502
