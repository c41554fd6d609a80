from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave.functions import names, similarity, text

ACCENTED = ["Müller-Lüdenscheidt, J.", " A & B ", "snake_case", "Œuvre ß Łódź", "ÅÉÎÕÜ ñ ç", "Ærøskøbing", "tab\there", "", "Ωmega Москва", "大学", "a大", "İstanbul", "x y", "é"]


def test_normalize_golden():
    assert text.normalize_query("Müller-Lüdenscheidt, J.") == "mullerludenscheidt j"
    assert text.normalize_query(" A & B ") == "a  b"
    assert text.normalize_query("snake_case") == "snake_case"
    assert text.normalize_query("Ærøskøbing ß") == "aeroskobing ss"


def test_query_and_ingest_differ_on_text_without_latin():
    assert text.normalize_query("大学") == "大学"
    assert text.normalize_ingest("大学") == "u5927 u5b66"


@pytest.mark.parametrize("at", ["query", "ingest"])
def test_normalized_column_equals_function(spark, at):
    rows = spark.createDataFrame([(x,) for x in [*ACCENTED, None]], "x string").select("x", text.normalized(F.col("x"), at).alias("n")).collect()
    function = text.normalize_query if at == "query" else text.normalize_ingest
    assert {r.x: r.n for r in rows} == {x: None if x is None else function(x) for x in [*ACCENTED, None]}


@given(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126)))
def test_normalize_is_idempotent_on_ascii(x):
    once = text.normalize_query(x)
    assert text.normalize_query(once) == once


DOIS = {
    "https://doi.org/10.1234/AbC": "10.1234/AbC", "doi: 10.1234/abc": "10.1234/abc", "<10.1234/abc>": "10.1234/abc", "10.1234/abc?x=1": "10.1234/abc",
    "10.1234/abc def": "10.1234/abc", "10.1234/abc.": "10.1234/abc.", "10.1234/ab<c.": "10.1234/ab<c", "10.12/abc": "10.12/abc", "abc": None, "": None, None: None,
    "HTTP://DX.DOI.ORG/10.1234/x#y": "10.1234/x", '"10.1234/q"': "10.1234/q", "www.doi.org/10.5555/(a)b;c:d": "10.5555/(a)b;c:d",
}


def test_clean_doi(spark):
    rows = spark.createDataFrame([(x,) for x in DOIS], "x string").select("x", text.clean_doi(F.col("x")).alias("d")).collect()
    assert {r.x: r.d for r in rows} == DOIS


def test_doi_prefix_and_url(spark):
    rows = spark.createDataFrame([("https://doi.org/10.1/a",), ("HTTPS://doi.org/10.1/a",), ("10.1",), (None,)], "x string")
    out = [tuple(r) for r in rows.select(text.doi_of_url(F.col("x")), text.doi_prefix(text.doi_of_url(F.col("x")))).collect()]
    assert out == [("10.1/a", "10.1"), ("HTTPS://doi.org/10.1/a", "HTTPS:"), ("10.1", ""), (None, "")]


def test_acronyms(spark):
    given_ = {"EMBL": True, "E.M.B.L.": True, "Embl": False, "123": False, "TOOLONG": False, "A-B-C-D": True, None: False, "": False}
    rows = spark.createDataFrame([(x,) for x in given_], "x string").select("x", text.is_likely_acronym(F.col("x")).alias("a")).collect()
    assert {r.x: r.a for r in rows} == given_


def test_authors_of(spark):
    row = spark.createDataFrame([(" A. B ;C;; D|E$ ",)], "x string")
    for separator, wanted in ((";", ["A. B", "C", "D|E$"]), ("|", ["A. B ;C;; D", "E$"]), ("", ["A. B ;C;; D|E$"]), ("$", ["A. B ;C;; D|E"])):
        assert row.select(text.authors_of(F.col("x"), separator)).first()[0] == wanted


def test_lossy_int(spark):
    rows = spark.createDataFrame([("3",), ("3.7",), ("x",), (None,), ("-2",), ("99999999999",)], "x string")
    assert [r[0] for r in rows.select(text.lossy_int(F.col("x"))).collect()] == [3, 4, None, None, -2, None]


def test_path_index(spark):
    rows = spark.createDataFrame([("authorships[12].affiliations[3].x",), ("title",), ("authorships[99999999999].x",)], "x string")
    assert [r[0] for r in rows.select(text.path_index(F.col("x"), "authorships")).collect()] == [12, None, None]


def test_jaro_winkler_golden():
    for a, b, wanted in (("martha", "marhta", 0.9611), ("smith", "smyth", 0.8933), ("jon", "john", 0.9333), ("", "a", 0.0), ("same", "same", 1.0), ("ab", "xy", 0.0)):
        assert round(similarity.jaro_winkler(a, b), 4) == wanted


@settings(max_examples=200)
@given(st.text(alphabet="abcde", max_size=9), st.text(alphabet="abcde", max_size=9))
def test_jaro_winkler_equals_duckdb(a, b):
    import duckdb

    ours = similarity.jaro_winkler(a, b)
    assert 0 <= ours <= 1
    if a and b:
        assert abs(ours - duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]) < 1e-9


def _partial_by_definition(a: str, b: str) -> float:
    def common(x: str, y: str) -> int:
        table = [0] * (len(y) + 1)
        for c in x:
            before = table[:]
            for j, d in enumerate(y):
                table[j + 1] = before[j] + 1 if c == d else max(before[j + 1], table[j])
        return table[-1]

    def one(s: str, t: str) -> float:
        n = len(s)
        windows = {t[max(0, e - n) : e] for e in range(1, len(t) + n)} - {""}
        return max(2 * common(s, w) / (n + len(w)) for w in windows)

    if not a or not b:
        return 0.0
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    return max(one(s, t), one(t, s)) if len(a) == len(b) else one(s, t)


@settings(max_examples=200)
@given(st.text(alphabet="abc ", max_size=7), st.text(alphabet="abc ", max_size=12))
def test_partial_ratio_equals_definition(a, b):
    assert abs(similarity.partial_ratio(a, b) - _partial_by_definition(a, b)) < 1e-12


def test_partial_ratio_golden():
    assert similarity.partial_ratio("abc", "xxabcxx") == 1.0
    assert similarity.partial_ratio("ABC", "abc") == 0.0


PAIRS = [
    ("Smith J", "John Smith", "last_initial", True), ("Smith K", "John Smith", "last_initial", True), ("Mary Smith", "John Smith", "first_last", True),
    ("Jon Smith", "John Smyth", "auto", True), ("Anna Smith", "Zoe Smyth", "auto", False), ("Smith, John", "John Smith", "last_comma_first", True),
    ("Madonna", "Madonna Smith", "auto", False), ("Madonna", "madonna", "auto", True), (None, "John Smith", "auto", False), ("  ", "John Smith", "auto", False),
    ("J. Smith", "John Smyth", "first_initial_last", True), ("K. Smith", "John Smyth", "first_initial_last", False), ("Smith John", "John Smith", "last_first", True),
]


def test_names_similar(spark):
    for a, b, style, wanted in PAIRS:
        assert names.names_similar(a, b, style, "first_last") is wanted, (a, b, style)
    for style in {p[2] for p in PAIRS}:
        own = [p for p in PAIRS if p[2] == style]
        rows = spark.createDataFrame([(p[0], p[1]) for p in own], "a string, b string")
        out = rows.select(names.names_similar_column(F.col("a"), F.col("b"), style, "first_last", 0.85)).collect()
        assert [r[0] for r in out] == [p[3] for p in own]


def test_human_names():
    parse = names.human_name
    assert parse("Dr. Ludwig van Beethoven Jr.")[:3] == ("ludwig", "", "van beethoven")
    assert parse("van der Berg, Jan P., PhD")[:3] == ("jan", "p.", "van der berg")
    assert parse("John Smith, Jr.")[:3] == ("john", "", "smith")
    assert parse('John "Jack" Quincy Adams')[:3] == ("john", "quincy", "adams")
    assert parse("Madonna")[:3] == ("madonna", "", "")
    assert parse("José García").normalized == "jose  garcia"
    assert parse("")[:3] == ("", "", "")


def test_no_script_collapses_into_the_blank_key():
    names = ["大学", "東京大学", "جامعة القاهرة", "서울대학교", "प्रयाग विश्वविद्यालय", "とうきょう", "אוניברסיטה", "Московский университет", "มหาวิทยาลัย", "საქართველო"]
    plain = [text.normalize_ingest(n) for n in names]
    assert all(plain) and len(set(plain)) == len(plain) and all(p.isascii() for p in plain)
    assert text.normalize_ingest("प्रयाग") == "parayaga" and text.transliterate("大") == "u5927 "


def test_white_space_is_the_same_on_the_jvm(spark):
    texts = ["a\x1cb", "\x1d a \x1f", "\x0b a\x0cb ", "a\x85b", "a\xa0b", "\tß\x1e", "x\u2003y"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalized(F.col("t"), "ingest").alias("n")).collect()
    assert {r.t: r.n for r in rows} == {t: text.normalize_ingest(t) for t in texts}
