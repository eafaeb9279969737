from urllib.parse import unquote, urljoin

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollbook.functions import text as X, typed
from rollbook.functions.keys import composite_key, differs


def one_column(spark, values, type_="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")


def apply(spark, values, function):
    df = one_column(spark, values).select("i", function(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_strip_matches_every_unicode_white_space(spark):
    spaces = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    values = [f"{s}a{s}b{s}" for s in spaces] + ["", "  ", "​x", "plain", None]
    expected = [None if v is None else v.strip() for v in values]
    assert apply(spark, values, X.strip_whitespace) == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aN/A0-1 \t ,.", max_size=12), min_size=50, max_size=200))
def test_clean_cell_against_plain_python(spark, values):
    def plain(v):
        v = v.strip()
        return None if v in ("", "00000000", "0001-01-01", "N/A", "NA", "000") else v

    values = values + ["00000000", " NA ", "na", "N/A", "000", "0000", "0001-01-01", "NA,000", ",", "000,"]
    assert apply(spark, values, X.clean_cell) == [plain(v) for v in values]


def test_exempt_cell_keeps_markers(spark):
    assert apply(spark, [" 000 ", "", " "], lambda c: X.clean_cell(c, ())) == ["000", None, None]


def test_null_if_blank(spark):
    assert apply(spark, [" a ", "  ", "", None], X.null_if_blank) == ["a", None, None, None]


def test_percent_decode(spark):
    values = ["a%20b", "a+b", "100%", "%zz%41", "S%C3%A3o", "%2B", "plain", "%E3"]
    assert apply(spark, values, X.percent_decode) == [unquote(v) for v in values]


def test_last_segment_and_directory(spark):
    assert apply(spark, ["a/b%20c/", "x.zip", "a/%2F"], X.last_segment) == ["b c", "x.zip", "/"]
    assert apply(spark, ["a/", "a"], X.is_directory) == [True, False]


def test_resolve_url(spark):
    base = "https://h.example.com/a/b/c.html?q=1#f"
    hrefs = [
        "/x", "y.zip", "./y", "../y", "../../../y", "#top", "?p=2", "", "//o.example.com/z", "http://k.example.com/",
        "mailto:a@b.c", "d/../e/./f?x=../y", "..", ".", "/m/../n/", "z/?u=/a/../b",
    ]
    got = apply(spark, hrefs, lambda c: X.resolve_url(F.lit(base), c))
    assert got == [urljoin(base, h) for h in hrefs]
    assert apply(spark, ["x"], lambda c: X.resolve_url(F.lit("http://h.example.com"), c)) == ["http://h.example.com/x"]


def test_months(spark):
    values = ["2026-03", "K_202603.zip", "x2026_03y", "none", "12345", "a1999-12 2026-01"]
    assert apply(spark, values, X.month_in_name) == ["2026-03", "2026-03", "2026-03", None, None, "1999-12"]
    assert apply(spark, ["2026-03", "2026-03x"], X.is_month_folder) == [True, False]


def test_small_functions(spark):
    assert apply(spark, ["11.111.111/0001-41", "x"], X.digits_only) == ["11111111000141", ""]
    assert apply(spark, ["7", "123456789"], lambda c: X.zero_pad(c, 8)) == ["00000007", "123456789"]
    assert apply(spark, ['"abc"', "abc", None], X.bare_etag) == ["abc", "abc", ""]
    assert apply(spark, ["12", "", None, "x"], X.long_or_zero) == [12, 0, 0, 0]
    assert apply(spark, ["https://h.example.com/s/TOKEN/?a=1"], X.share_token) == ["TOKEN"]
    assert apply(spark, ["https://h.example.com/s/T"], X.dav_base) == ["https://h.example.com/public.php/webdav/"]
    assert apply(spark, ["x"], lambda c: X.clamp(F.lit(500), 1, 100)) == [100]


def test_contains_keeps_like_meaning(spark):
    values = ["100% pure", "100 pure", "a_b", "axb", "back\\slash", None]
    assert apply(spark, values, lambda c: X.contains_ci(c, "A_B")) == [False, False, True, True, False, None]
    assert apply(spark, values, lambda c: X.contains_ci(c, "100\\%")) == [True, False, False, False, False, None]
    assert apply(spark, values, lambda c: X.contains_ci(c, "k\\\\s")) == [False, False, False, False, True, None]
    assert apply(spark, values, lambda c: X.contains_ci(c, "\\p\\ure")) == [True, True, False, False, False, None]


def test_typed(spark):
    days = apply(spark, ["20230101", "20231301", "2023-01-01", "", None], lambda c: typed.compact_date(c).cast("string"))
    assert days == ["2023-01-01", None, None, None, None]
    assert apply(spark, ["S", "N", "s", None], typed.yes_no) == [True, False, None, None]
    money = apply(spark, ["100000,00", "1,5", "x", None], lambda c: typed.comma_money(c).cast("string"))
    assert money == ["100000.00", "1.50", None, None]


def test_key_functions(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    got = df.select(composite_key("x", "y").alias("k"), differs([F.col("x")], [F.col("y")]).alias("d")).collect()
    assert [(r["k"], r["d"]) for r in got] == [("ab", True), (None, True), (None, False)]
