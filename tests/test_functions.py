"""Golden values of dates, URLs, texts and vectors."""

import datetime

import pytest
from pyspark.sql import functions as F

from marisight.functions import dates, text, urls, vectors


def one(spark, column, value="x"):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("o")).first().o


@pytest.mark.parametrize(
    "label, want",
    [
        ("15 Januari 2024", "2024-01-15"),
        ("1 Mac 2023", "2023-03-01"),
        ("31 Ogos 2019", "2019-08-31"),
        ("2nd Mac 2023", "2023-03-02"),
        ("15 | Januari | 2024", "2024-01-15"),
        ("Tarikh: 15 Jun 2024, Kuala Lumpur", "2024-06-15"),
        ("18 FEB 2025 SELASA", "2025-02-18"),
        ("99999 2019 99999", "2019-01-01"),
        ("2024-03-15 pagi", "2024-03-15"),
        ("03/02/2025", "2025-02-03"),
        ("March 5, 2021", "2021-03-05"),
        ("abcxyz", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_parse_date(spark, label, want):
    assert one(spark, dates.parse_date(F.col("v")), label) == want


def test_other_dates(spark):
    assert one(spark, dates.sitting_date(F.col("v")), "3 MAC 2025 (ISNIN)") == "2025-03-03"
    assert one(spark, dates.range_start(F.col("v")), "17 Ogos - 20 Ogos 2015") == "2015-08-17"
    assert one(spark, dates.name_date(F.col("v")), "JDR05032025.pdf") == "2025-03-05"
    assert one(spark, dates.iso_date(F.col("v")), "2024-03-15T14:30:00+08:00") == "2024-03-15"
    assert one(spark, dates.iso_date(F.col("v")), "not-a-date") == ""
    assert one(spark, dates.path_date(F.col("v")), "https://x/2024/05/06/y") == "2024-05-06"
    assert one(spark, dates.title_date(F.col("v")), "Laporan bulan Mei 2020 sehingga 3 Jun 2021") == "2021-06-03"
    assert one(spark, dates.since(F.col("v"), F.lit(datetime.date(2024, 1, 1))), "nonsense") is True


@pytest.mark.parametrize(
    "url, want",
    [(" http://WWW.Host.My/a/B?x=1#top ", "https://www.host.my/a/B?x=1"), ("https://h/a;p?q", "https://h/a?q"), ("https://h", "https://h")],
)
def test_canonical(spark, url, want):
    assert one(spark, urls.canonical(F.col("v")), url) == want
    assert one(spark, urls.canonical(urls.canonical(F.col("v"))), url) == want


def test_urls(spark):
    v = F.col("v")
    assert one(spark, urls.canonical_compact(v), "http://www.h.my//a//b/?utm_x=1&b=2&a=1") == "https://h.my/a/b?a=1&b=2"
    assert one(spark, urls.canonical_allowed(v, F.array(F.lit("h.my"))), "http://www.H.my/A/?utm_source=x&b=1") == "https://h.my/a/?b=1"
    for given, want in (("http://h.my/", "https://h.my/"), ("https://h.my/A/b/", "https://h.my/a/b"), ("https://h.my/a%20b/%C3%A9?SessionId=1&z=2&flag&a=B&a=C&_ga=9#f", "https://h.my/a%20b/%c3%a9?a=c&z=2"), ("https://h.my/a b~c*d+e/", "https://h.my/a%20b~c%2ad%2be"), ("https://h.my/p;v=1?MSCLKID=2", "https://h.my/p")):
        assert one(spark, urls.canonical_allowed(v, F.array(F.lit("www.h.my"))), given) == want
    assert one(spark, urls.canonical_allowed(v, F.array(F.lit("h.my"))), "http://other.my/A") is None
    assert one(spark, urls.canonical_valid(v), "ftp://h/x") is None
    assert one(spark, urls.content_type(v), "https://h/x/a.DOCX?y").endswith("wordprocessingml.document")
    assert one(spark, urls.content_type(v), "https://h/x") == "application/octet-stream"
    assert one(spark, urls.absolute(v, F.lit("https://h/a/b/c.html")), "../../d.pdf") == "https://h/d.pdf"
    assert one(spark, urls.absolute(v, F.lit("https://h/a/b")), "c/./d?x#y") == "https://h/a/c/d?x#y"
    assert one(spark, urls.slug(v), "  Jabatan Ä 1! ") == "jabatan-1"
    assert one(spark, urls.slug(v), None) == "unknown-agency"
    assert one(spark, urls.title_of(v), "0123456789abcdef_laporan-2024.pdf") == "laporan 2024"
    assert one(spark, urls.versioned_name(v, F.lit(datetime.date(2024, 1, 2))), "a.b.pdf") == "a.b_2024-01-02.pdf"
    link = "/a/b.pdf"
    import base64

    assert one(spark, urls.hex_link(v), base64.b64encode(link.encode()).hex()) == link
    assert one(spark, urls.hex_link(v), "zz") == "zz"


def test_texts(spark):
    v = F.col("v")
    assert one(spark, text.question_language(v), "Apakah bantuan untuk pelajar?") == "ms"
    assert one(spark, text.question_language(v), "What is the policy?") == "en"
    assert one(spark, text.needs_clarification(v), "tax") is True
    assert one(spark, text.needs_clarification(v), "Tell me  about tax relief") is True
    assert one(spark, text.needs_clarification(v), "how do I file tax") is False
    assert one(spark, text.word_chunks(v), "a b c d e f g h i") == ["a b c d e f g h ", "i"]
    assert one(spark, text.citation_marks(v), "x [2] y [10]") == [2, 10]
    assert one(spark, text.initials(v), "ana.b-c@x.my") == "AB"
    assert one(spark, text.percent_decoded(v), "a 20b") == "a b"
    assert one(spark, text.short_title(v), "z" * 51) == "z" * 47 + "..."
    assert one(spark, text.listing_title(v), "Akta 1 | Portal") == "Akta 1"
    assert one(spark, text.language_code(v), "my") == "ms"
    assert tuple(one(spark, text.date_and_title(v), "3 Mac 2024\nTajuk")) == ("3 Mac 2024", "Tajuk")


def test_vectors(spark):
    arr = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    assert one(spark, vectors.cosine(arr(1, 0), arr(1, 0))) == 1.0
    assert one(spark, vectors.cosine(arr(0, 0), arr(1, 0))) == 0.0
    assert one(spark, vectors.cosine(arr(1, 1, 5), arr(1, 1))) == pytest.approx(2 / (27**0.5 * 2**0.5))
    assert one(spark, vectors.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b")))) == 0.5


@pytest.mark.parametrize(
    "label, want",
    [
        ("2024 Mac 15", "2024-03-15"),
        ("2024/03/15", "2024-03-15"),
        ("2024/03/05", "2024-05-03"),
        ("03/15/2024", "2024-03-15"),
        ("15 Jan 24", "2024-01-15"),
        ("1/2/24", "2024-02-01"),
        ("1.2.99", "1999-02-01"),
        ("Dikemaskini 20240315", "2024-03-15"),
        ("2024 Disember", "2024-12-01"),
        ("03/2024", "2024-03-01"),
        ("15Januari 2024", "2024-01-15"),
        ("Bil. 12 / 31 Februari 2024", "2024-02-01"),
        ("45 Mac 2024", "2024-03-01"),
        ("Jun 3rd, 2021 | x", "2021-06-03"),
        ("abc2019 report", ""),
        ("call 60312345678", ""),
        ("Mac 15,2024", "2024-03-15"),
        ("2024-13-45T00", "2024-13-45"),
    ],
)
def test_other_forms_of_dates(spark, label, want):
    assert dates.read_date(label) == want


def test_dates_of_many_labels(spark):
    rows = spark.createDataFrame([(1, "3 Mac 2024", ["x", None, "5 Jun 2020"]), (2, None, None), (3, "", []), (4, "3 Mac 2024", ["none"])], "n int, v string, lines array<string>")
    got = {r.n: (r.d, r.s) for r in rows.select("n", dates.parse_date(F.col("v")).alias("d"), dates.speech_date(F.col("v"), F.col("lines"), F.lit("2019")).alias("s")).collect()}
    assert got == {1: ("2024-03-03", "2020-06-05"), 2: ("", "2019-01-01"), 3: ("", "2019-01-01"), 4: ("2024-03-03", "2019-01-01")}


def test_catalogue_text_of_names(spark, sf_dir):
    from marisight.plans.listing_queries import name_functions

    row = name_functions(spark, sf_dir).where("c_custkey = 1").first()
    assert row.catalogue == "T1\nD\nColumns: x, y\nFrequency: daily\nCategory: prices"
