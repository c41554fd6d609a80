from __future__ import annotations

import gzip
import json

import pytest

from citeweave.operators import extract, normalize, stats
from citeweave.plans import pipeline
from citeweave.sources import works
from citeweave.sources.registry import DOI_ARRAYS, WORK_ARRAYS

WORK = {
    "id": "https://openalex.org/W1", "doi": "https://doi.org/10.1234/abc", "primary_location": {"source": {"id": "https://openalex.org/S1"}},
    "authorships": [{
        "author": {"display_name": "José García"}, "affiliations": [{"raw_affiliation_string": "Univ. of X", "institution_ids": ["https://openalex.org/I1"]}],
        "institutions": [{"id": "https://openalex.org/I1", "ror": "https://ror.org/01x"}],
    }],
}


def lines(spark, *works_):
    rows = [(w if isinstance(w, str) else json.dumps(w), "f") for w in works_]
    return spark.createDataFrame(rows, "line string, source_file_path string")


def pairs(value, fields, flavour=extract.WORK):
    tree = extract.compile_patterns(extract.parse_fields(fields), flavour.arrays, flavour.wildcard_heads)
    return list(extract.walk(value, tree))


def test_pipeline_fields(spark):
    rows = extract.extract(lines(spark, WORK), extract.PIPELINE_FIELDS).collect()
    assert {(r.work_id, r.doi, r.source_id, r.doi_prefix) for r in rows} == {("https://openalex.org/W1", "10.1234/abc", "https://openalex.org/S1", "10.1234")}
    assert {(r.subfield_path, r.value) for r in rows} == {
        ("authorships[0].affiliations[0].institution_ids[0]", "https://openalex.org/I1"), ("authorships[0].affiliations[0].raw_affiliation_string", "Univ. of X"),
        ("authorships[0].author.display_name", "José García"), ("authorships[0].institutions[0].id", "https://openalex.org/I1"),
        ("authorships[0].institutions[0].ror", "https://ror.org/01x"),
    }


def test_shapes():
    assert pairs({"title": None}, "title") == [("title", "title", "")]
    assert pairs({}, "title") == []
    assert pairs({"title": None}, "title", extract.DOI) == []
    assert pairs({"title": ["a", "b"]}, "title", extract.DOI) == [("title", "title[0]", "a"), ("title", "title[1]", "b")]
    assert pairs({"title": "x"}, "title,title") == [("title", "title", "x")] * 2
    assert pairs({"issued": {"date-parts": [[2020, 1]]}}, "issued.date-parts", extract.DOI) == [("issued.date-parts", "issued.date-parts[0]", "[2020,1]")]
    assert pairs({"authorships": [{"b": 1, "a": {"y": 1.0, "x": None}}]}, "authorships") == [("authorships", "authorships[0]", '{"a":{"x":null,"y":1.0},"b":1}')]
    assert pairs({"primary_location": {"source": {"issn": ["1", "2"]}}}, "primary_location.source.issn") == [("primary_location.source.issn", "primary_location.source.issn", '["1","2"]')]
    assert [p[1] for p in pairs({"abstract_inverted_index": {"w": [3, 5]}}, "abstract_inverted_index.*")] == ["abstract_inverted_index.w[0]", "abstract_inverted_index.w[1]"]
    assert ("relation.*", "relation.is-part-of[0]", '{"id":"x"}') in pairs({"relation": {"is-part-of": [{"id": "x"}]}}, "relation.is-part-of", extract.DOI)
    assert pairs({"apc_list": [1]}, "apc_list") == [("apc_list", "apc_list", "[1]")]
    assert [p[1] for p in pairs({"grants": [1], "versions": [2]}, "grants,versions")] == ["grants[0]", "versions[0]"]
    assert pairs({"author": [{"affiliation": [{"id": [{"id": "r"}]}]}]}, "author.affiliation.id.id", extract.DOI)[0][1] == "author[0].affiliation[0].id[0].id"
    assert pairs({"assertion": [{"group": [1]}]}, "assertion.group", extract.DOI) == [("assertion.group", "assertion[0].group", "[1]")]


def test_registry_sizes():
    assert (len(WORK_ARRAYS), len(DOI_ARRAYS)) == (30, 102)


@pytest.mark.parametrize(
    "source,shown", [("1.0", "1.0"), ("1e20", "1e20"), ("1e16", "1e16"), ("1e15", "1000000000000000.0"), ("1e-5", "0.00001"), ("1.5e-7", "1.5e-7"), ("-2.5", "-2.5"), ("0.0", "0.0"), ("12", "12"), ("18446744073709551616", "1.8446744073709552e19"), ("true", "true")]
)
def test_rendering(source, shown):
    assert extract.rendered(extract.parse_line(source)) == shown


def test_bad_lines_and_required_keys(spark):
    given = lines(spark, WORK, "", "  ", "{broken", '{"title": "no id"}', '{"id": 5}', "NaN", {"id": "W2"})
    assert {r.work_id for r in extract.extract(given, "id").collect()} == {"https://openalex.org/W1", "W2"}
    report = extract.line_report(given).first()
    assert (report["lines"], report.blank, report.broken, report.missing_key, report.usable) == (8, 2, 2, 2, 2)


def test_member_and_filters(spark):
    given = lines(spark, {"DOI": "10.1/a", "member": 78}, {"DOI": "10.2/b", "member": "9", "prefix": "10.9"}, {"DOI": "10.3/c"}, {"member": "9"})
    rows = extract.extract(given, "DOI", extract.DOI).collect()
    assert {(r.doi, r.member_id, r.doi_prefix) for r in rows} == {("10.1/a", "78", "10.1"), ("10.2/b", "9", "10.9")}
    assert [r.doi for r in extract.extract(given, "DOI", extract.DOI, group="78").collect()] == ["10.1/a"]
    assert [r.doi for r in extract.extract(given, "DOI", extract.DOI, prefix="10.9").collect()] == ["10.2/b"]
    with pytest.raises(ValueError):
        extract.parse_fields(" , . ")


def test_extraction_on_the_jvm_equals_the_walk(spark):
    odd = {
        "id": "W3", "doi": "10.5/x/y", "primary_location": {"source": {"id": 7}},
        "authorships": [None, {"author": None}, {"author": {"display_name": None}}, {"author": {"display_name": "a\"b\nc"}, "affiliations": None, "institutions": "x"},
                        {"affiliations": [{"raw_affiliation_string": "", "institution_ids": ["I1", None, "I2"]}, {}], "institutions": [{"id": "I1"}, {"ror": True, "id": 12}]}],
    }
    given = lines(spark, WORK, odd, "", "{broken", '{"title": "no id"}', {"id": 5}, {"id": "W4", "authorships": {"author": {"display_name": "no list"}}}, {"id": "W5", "doi": None}, "[1]", "null")
    walked, jvm = (sorted(map(tuple, f(given, extract.PIPELINE_FIELDS + ",id,doi").collect())) for f in (extract.extract, extract.extract_jvm))
    assert jvm == walked and len(jvm) > 15
    for group, prefix in (("https://openalex.org/S1", None), (None, "10.5"), ("", None), (None, "")):
        keep = {"group": group, "prefix": prefix}
        assert sorted(map(tuple, extract.extract_jvm(given, "id", **keep).collect())) == sorted(map(tuple, extract.extract(given, "id", **keep).collect()))
    plan = extract.extract_jvm(given, extract.PIPELINE_FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
    with pytest.raises(ValueError):
        extract.extract_jvm(given, "a.*")


def test_unreadable_files_are_named(spark, tmp_path):
    whole = gzip.compress(b"line\n" * 50_000)
    for name, data in (("a.gz", whole), ("cut.gz", whole[: len(whole) // 2]), ("no.gz", b"plain"), ("b.txt", b"x")):
        (tmp_path / name).write_bytes(data)
    report = {r.path.rsplit("/", 1)[1]: r for r in works.file_report(spark, str(tmp_path)).collect()}
    assert set(report) == {"a.gz", "cut.gz", "no.gz"}
    assert (report["a.gz"].error, report["a.gz"].unpacked, report["a.gz"].length) == (None, 250_000, len(whole))
    assert report["cut.gz"].error and report["no.gz"].error
    assert works.file_counts(works.file_report(spark, str(tmp_path))).first().asDict() == {"files_ok": 1, "files_failed": 2}
    assert works.file_report(spark, str(tmp_path / "none")).count() == 0
    files = works.files_below(spark, str(tmp_path))
    assert works.partitions_for(files) is None
    assert works.partitions_for(files, 10) == -(-sum(r.length for r in report.values()) // 10)


def test_native_extraction_agrees(spark):
    rows = spark.createDataFrame([(1, '{"a": "x", "b": {"c": 5}, "n": null}'), (2, "broken"), (3, '{"b": {}}')], "id int, j string")
    out = extract.extract_native(rows, "j", {"a": "$.a", "c": "$.b.c", "n": "$.n"})
    assert {(r.id, r.field_name, r.subfield_path, r.value) for r in out.collect()} == {(1, "a", "a", "x"), (1, "c", "b.c", "5"), (1, "n", "n", "")}


def test_files_end_to_end(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    with gzip.open(tmp_path / "in" / "deep" / "a.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps(WORK) + "\n\n{bad\n")
    with gzip.open(tmp_path / "in" / "b.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps(WORK | {"id": "W2", "doi": None, "primary_location": None}) + "\n")
    (tmp_path / "in" / "c.gz").write_bytes(b"\x1f\x8b\x08not gzip")
    rows = pipeline.extract_fields(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert rows.count() == 10
    back = works.read_csv(spark, str(tmp_path / "out"))
    assert back.count() == 10 and back.columns == rows.columns
    pipeline.extract_fields(spark, str(tmp_path / "in"), str(tmp_path / "org"), organize=True)
    assert {p.name for p in (tmp_path / "org").iterdir() if p.is_dir()} == {"organized_by=https_openalex.org_S1", "organized_by=unknown"}
    (tmp_path / "none").mkdir()
    assert pipeline.extract_fields(spark, str(tmp_path / "none"), str(tmp_path / "o2")) is None
    summary = pipeline.extraction_summary(rows)
    assert summary["totals"].first().asDict() == {"total_rows": 10, "unique_works": 2, "unique_dois": 1}
    assert [(r.source_id, r.n) for r in summary["groups"].collect()] == [("https://openalex.org/S1", 5)]
    assert stats.group_table(rows, "work_id", most=2).count() == 0


def test_stream_takes_up_new_files(spark, tmp_path):
    from citeweave.streaming.extract import stream_author_affiliations, stream_fields

    (tmp_path / "in").mkdir()
    for i in range(3):
        with gzip.open(tmp_path / "in" / f"{i}.gz", "wt", encoding="utf-8") as f:
            f.write(json.dumps(WORK | {"id": f"W{i}"}) + "\n")
        stream_fields(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 5 * (i + 1)
    stream_author_affiliations(spark, str(tmp_path / "in"), str(tmp_path / "aa"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "aa")).count() == 3


def fields(spark, *rows):
    full = [(w, d, f, "authorships" + p, v, "", "", "f") for w, d, f, p, v in rows]
    return spark.createDataFrame(full, "work_id string, doi string, field_name string, subfield_path string, value string, source_id string, doi_prefix string, source_file_path string")


N, R, A, I, O = normalize.NAME, normalize.RAW_AFFILIATION, normalize.AFFILIATION_INSTITUTION, normalize.INSTITUTION_ID, normalize.INSTITUTION_ROR


def test_pivot_golden(spark):
    rows = normalize.normalize_works(extract.extract(lines(spark, WORK), extract.PIPELINE_FIELDS)).collect()
    assert [tuple(r) for r in rows] == [("https://openalex.org/W1", "10.1234/abc", 0, "José García", "jose garcia", 0, "Univ. of X", "univ of x", "https://ror.org/01x")]


def test_pivot_edges(spark):
    given = fields(
        spark,
        ("w", "d", N, "[0].author.display_name", "A"), ("w", "d", N, "[1].author.display_name", "B"), ("w", "d", "authorships.author.orcid", "[2].author.orcid", "o"),
        ("w", "d", R, "[0].affiliations[10].raw_affiliation_string", "X"), ("w", "d", A, "[0].affiliations[10].institution_ids[0]", "i0"),
        ("w", "d", A, "[0].affiliations[10].institution_ids[1]", "i1"), ("w", "d", A, "[0].affiliations[10].institution_ids[2]", "i2"),
        ("w", "d", I, "[1].institutions[0].id", "i1"), ("w", "d", O, "[1].institutions[0].ror", "r1"), ("w", "d", I, "[1].institutions[1].id", "i2"),
        ("w", "d", O, "[1].institutions[1].ror", "r2"), ("w", "d", A, "[0].affiliations[3].institution_ids[0]", "i9"),
        ("v", "", I, "[0].institutions[0].id", "i9"), ("v", "", O, "[0].institutions[0].ror", "r9"), ("v", "", "title", "x", "t"),
    )
    rows = {(r.work_id, r.author_sequence, r.affiliation_sequence): r for r in normalize.normalize_works(given).collect()}
    assert set(rows) == {("w", 0, 10), ("w", 0, 0), ("w", 1, 0), ("w", 2, 0), ("v", 0, 0)}
    assert rows["w", 0, 10].affiliation_ror == "r1"  # the first with a ROR, defined under another author
    assert (rows["w", 0, 0].affiliation_name, rows["w", 0, 0].affiliation_ror) == ("", "")  # ids only, ROR in another work
    assert (rows["w", 1, 0].affiliation_name, rows["w", 2, 0].author_name) == ("", "")
