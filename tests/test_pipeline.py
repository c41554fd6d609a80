from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citeweave.operators import build, discovery, entities, linkage, search
from citeweave.plans import cli, config, pipeline
from citeweave.schemas import AUTHOR_AFFILIATIONS, AUTHOR_REFERENCES
from citeweave.sources import sinks, works


def refs(spark, *rows):
    """(work_id, doi, author, affiliation)"""
    full = [(w, d, 0, a, (a or "").lower(), 0, x, (x or "").lower() or None, "r", (x or "").lower().strip()) for w, d, a, x in rows]
    return spark.createDataFrame(full, AUTHOR_REFERENCES)


def linked(spark, *rows):
    return spark.createDataFrame([(*r,) for r in rows], "input_doi string, input_work_id string, input_author_name string, ref_author_name string, ref_affiliation string, linkage_status string")


def test_build_and_rejects(spark):
    good = ("W1", "null", "0", "A", "a", "x", "Aff", " AFF ", "r")
    rows = [good, ("", *good[1:]), ("null", *good[1:]), ("w" * 1000, *good[1:]), (None, *good[1:]), ("W2", "10.1/x", "1", "b" * 499, "b", "1", None, None, None), ("W3", "", "1", "b" * 500, "b", "1", "", "", ""), ("W4", "", "1", "", "b", "1", "", "", "")]
    staged = spark.createDataFrame(rows, "work_id string, doi string, author_sequence string, author_name string, normalized_author_name string, affiliation_sequence string, affiliation_name string, normalized_affiliation_name string, affiliation_ror string")
    table = {r.work_id: r for r in build.build_references(staged).collect()}
    assert set(table) == {"W1", "W2"}
    assert (table["W1"].doi, table["W1"].author_sequence, table["W1"].affiliation_sequence, table["W1"].normalized_affiliation_key) == (None, 0, None, "aff")
    assert table["W2"].normalized_affiliation_key == ""
    assert build.counts(staged).first().asDict() == {"staged": 8, "imported": 2, "rejected": 6}
    contents = [r.row_content for r in build.rejects(staged).collect()]
    assert len(contents) == 6 and contents.count(None) == 1
    assert build.import_errors(staged, 4).count() == 4
    nulls = {r.column_name: (r.nulls, r.percent) for r in build.null_checks(build.build_references(staged)).collect()}
    assert nulls["doi"] == (1, 50.0)
    assert build.null_checks(build.build_references(staged.where("false")), ["doi"]).first().percent is None


def test_linkage(spark):
    references = refs(spark, ("W1", "10.1234/ab", "John Smith", "Inst X"), ("W1", "10.1234/ab", "Zoe Long", "Inst X"), ("W2", None, "John Smith", None), ("W3", "10.1234/AB", "John Smith", "Y"))
    user = spark.createDataFrame([("https://doi.org/10.1234/ab", "W1", "Smith, John; Nobody, Else"), (None, "W2", "Smith, J."), ("", "", "Smith, John"), ("10.1234/ab", None, " ")], "doi string, wid string, names string")
    inputs = linkage.input_authors(user, "names", ";", "doi", "wid")
    rows = linkage.link_authors(inputs, references, ["inst x"], "last_comma_first", "first_last").collect()
    assert {tuple(r) for r in rows} == {("10.1234/ab", "W1", "Smith, John", "John Smith", "inst x", "org_match_found"), ("", "W2", "Smith, J.", "John Smith", "", "name_match_no_org_affiliation")}
    assert len(rows) == 2  # found by both ids, one row
    statuses = {r.linkage_status for r in linkage.link_authors(inputs, references, [], "last_comma_first", "first_last").collect()}
    assert statuses == {"first_available"}
    with pytest.raises(ValueError):
        linkage.input_authors(user, "names", ";")


def test_exclusion_and_discovery(spark):
    references = refs(spark, ("W1", "10.1/a", "A", "X"), ("W2", "10.1/b", "B", "X"), ("W3", None, "C", "X"), (None, None, "D", "X"), ("W5", "10.1/e", "E", None))
    known = spark.createDataFrame([("10.1/a", None), (None, "W3"), (None, None), ("https://doi.org/10.1/b", None)], "doi string, work_id string")
    left = discovery.exclude_known(references, known)
    assert {r.author_name for r in left.collect()} == {"B", "D", "E"}
    links = linked(spark, ("", "", "n", "m", " X ", "org_match_found"), ("", "", "n2", "m", "x", "first_available"), ("", "", "n3", "m", "x", "name_match_no_org_affiliation"), ("", "", "n4", "m", "", "first_available"))
    rows = discovery.discover_by_affiliation(links, references, known)
    assert sorted((r.input_author_name, r.discovered_author) for r in rows.collect()) == [("n", "B"), ("n", "D"), ("n2", "B"), ("n2", "D"), ("n4", "E")]
    assert discovery.discover_by_affiliation(links, references, known, skip_blank=True).count() == 4


def test_entity_discovery(spark):
    references = refs(spark, ("W1", "10.1/a", "A", "dept of biology heidelberg embl"), ("W2", "10.1/b", "B", "dept_of biology heidelberg"), ("W3", "10.1/c", "C", "o'hara & co dept of biology"))
    keys = spark.createDataFrame([("dept_of biology", "s"), ("a\\b", "t")], "entity_key string, source_affiliations string")
    none = works.empty_ids(spark)
    found = lambda orgs, **k: {r.discovered_work_id for r in discovery.discover_by_entities(keys, references, orgs, none, **k).collect()}
    assert found(["Heidelberg"]) == {"W1", "W2"}  # _ is a wildcard
    assert found(["EMBL"]) == {"W1"}
    assert found(["O'Hara & Co"]) == set()
    assert found([]) == set()
    seen = spark.createDataFrame([("10.1/a", None)], "doi string, work_id string")
    assert {r.discovered_work_id for r in discovery.discover_by_entities(keys, references, ["Heidelberg"], none, seen).collect()} == {"W2"}


def test_combine(spark):
    columns = "input_doi string, input_work_id string, input_author_name string, linking_affiliation string, discovered_work_id string, discovered_doi string, discovered_author string, discovered_author_affiliation string, discovered_ror_id string"
    one = spark.createDataFrame([("", "", "n", "x", "W1", None, "A", "b", "r"), ("", "", "n", "w", "W1", None, "A", None, "r")], columns)
    _, no_entities = pipeline.empty_discoveries(spark)
    two = spark.createDataFrame([("s", "e", "W1", None, "A", "a", "n", "r"), ("s", "e", "W2", "d", "B", "a", "n", "r")], no_entities.schema)
    both = discovery.combine(one, two)
    assert {(r.work_id, r.match_type, r.matching_affiliation, r.author_affiliation) for r in both.collect()} == {("W1", "affiliation_exact", "w", None), ("W2", "entity_extracted", "e", "a")}
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, discovery.combine_by_row_number(one, two).collect()), key=repr)
    assert discovery.combine(one, no_entities).count() == 2  # one kind is not deduplicated
    assert {(r.match_type, r.work_count) for r in discovery.match_counts(both).collect()} == {("affiliation_exact", 1), ("entity_extracted", 1)}
    assert discovery.discovered_ids(one, two).count() == 2
    null_last = discovery.export_works(both.unionByName(both.withColumn("doi", F.lit("a")).where("work_id = 'W1'"))).collect()
    assert [r.doi for r in null_last] == ["a", None, "d"]


def test_entities(spark):
    texts = ["Department of Physics, European Molecular Biology Laboratory, Heidelberg", "no org here", "University of Oxford and School of Medicine"]
    found = entities.by_rules(texts)
    assert "European Molecular Biology Laboratory" in found[0] and found[1] == []
    rows = entities.extract_entities(spark.createDataFrame([(t,) for t in texts], "source_affiliation string"))
    mapping = {r.source_affiliation: r.extracted_entities for r in entities.entity_mappings(rows).collect()}
    assert mapping[texts[0]] == "; ".join(found[0]) and texts[1] not in mapping
    given = spark.createDataFrame([("a", 0, "European Molecular Biology Laboratory"), ("b", 0, "European Molecular Biology Laboratory"), ("c", 0, "exactly fifteen"), ("d", 0, "EMBL"), ("e", 0, "Completely Different Things")], "source_affiliation string, pos int, entity_text string")
    keys = entities.entity_keys(given, ["Molecular Biology Laboratory"], 85)
    assert [tuple(r) for r in keys.collect()] == [("european molecular biology laboratory", "a")]
    assert entities.entity_keys(given, ["European Molecular Biology Laboratory"], 100).count() == 0  # over, not at, the threshold


def test_search(spark):
    references = refs(spark, ("W1", "10.1/a", "A", "inst x"), ("W2", None, "B", "inst x"))
    terms = spark.createDataFrame([("Inst. X!",), ("Inst. X!",), ("nothing",), (None,)], "`my term` string")
    rows = search.search_order(search.search_affiliations(terms, "my term", references)).collect()
    assert [r.ref_work_id for r in rows] == ["W1", "W1", "W2", "W2"]
    ids = spark.createDataFrame([("10.1/a", None), ("10.9/z", None)], "doi string, work_id string")
    out = search.search_ids(ids, references, ["Inst X"])
    assert {k: [r.work_id for r in v.collect()] for k, v in out.items()} == {"matched": ["W1"], "discovered": ["W2"], "unmatched": [None]}


def test_csv_quirks(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text('a,b,c\n1,,""\n"x ""q"" y","line\nbreak",z\nshort\n', encoding="utf-8")
    rows = [tuple(r) for r in works.read_csv(spark, str(path)).collect()]
    assert rows == [("1", None, None), ('x "q" y', "line\nbreak", "z"), ("short", None, None)]
    single = sinks.write_csv(works.read_csv(spark, str(path)), str(tmp_path / "o.csv"), single=True)
    assert [tuple(r) for r in works.read_csv(spark, single).collect()] == rows
    assert sinks.processed_name("/x/y.csv") == "/x/y_processed.csv"
    assert sinks.output_paths("/x/out.csv")["linkage"] == "/x/out_linkage.csv"


def test_config():
    good = {"input_columns": {"doi": "d", "authors": "a", "author_separator": ";"}, "organization_names": ["X"], "name_matching_threshold": None, "other": 1}
    assert config.from_dict(good).organization_names == ("X",)
    assert config.from_dict(good).name_matching_threshold == 0.85
    for bad in ({}, {"input_columns": {"authors": "a", "author_separator": ""}}, {"input_columns": {"doi": "d", "authors": "a"}}):
        with pytest.raises(config.ConfigError):
            config.from_dict(bad)
    assert config.memory("8GB") == "8g"
    for bad in ("8", "8gb", "GB"):
        with pytest.raises(config.ConfigError):
            config.memory(bad)
    for bad in ("", "a/../b", "a;b", "/no/such/file"):
        with pytest.raises(config.ConfigError):
            config.checked_path(bad)


def test_command_line(spark, tmp_path):
    staged = spark.createDataFrame(
        [("W1", "10.1234/a", 0, "John Smith", "john smith", 0, "Inst X", "inst x", "r"), ("W2", "10.1234/b", 0, "Ann Other", "ann other", 0, "Inst X", "inst x", "r"), ("", "", 0, "bad", "bad", 0, "", "", "")], AUTHOR_AFFILIATIONS
    )
    sinks.write_csv(staged, str(tmp_path / "aa.csv"))
    db = str(tmp_path / "db")
    assert cli.main(["build", "-r", str(tmp_path / "aa.csv"), "-d", db]) == 0
    assert cli.main(["verify", "-d", db]) == 0
    assert cli.main(["cluster", "-d", db, "--indexes", "doi"]) == 0
    assert spark.read.parquet(f"{db}/author_references_by_doi").count() == 2
    (tmp_path / "in.csv").write_text('doi,who\n10.1234/a,"Smith, John"\n', encoding="utf-8")
    (tmp_path / "c.yaml").write_text(
        "input_columns: {doi: doi, authors: who, author_separator: ''}\ninput_name_style: last_comma_first\norganization_names: [Inst X]\naffiliation_search_columns: {affiliation_name: term}\n", encoding="utf-8"
    )
    assert cli.main(["query", "-i", str(tmp_path / "in.csv"), "-o", str(tmp_path / "out.csv"), "-d", db, "-c", str(tmp_path / "c.yaml"), "-p"]) == 0
    assert [r.linkage_status for r in works.read_csv(spark, str(tmp_path / "out_linkage.csv")).collect()] == ["org_match_found"]
    assert [r.work_id for r in works.read_csv(spark, str(tmp_path / "out_discovered_works.csv")).collect()] == ["W2"]
    (tmp_path / "t.csv").write_text("term\nInst. X\n", encoding="utf-8")
    assert cli.main(["query", "-i", str(tmp_path / "t.csv"), "-o", str(tmp_path / "s.csv"), "-d", db, "-c", str(tmp_path / "c.yaml"), "-s"]) == 0
    assert works.read_csv(spark, str(tmp_path / "s.csv")).count() == 2


def test_clean_exclusion_is_opt_in(spark):
    references = refs(spark, ("W1", "10.1234/a", "John Smith", "inst x"), ("W2", "10.1234/b", "Ann Other", "inst x"))
    user = spark.createDataFrame([("https://doi.org/10.1234/a", "John Smith")], "doi string, who string")
    base = {"input_columns": {"doi": "doi", "authors": "who", "author_separator": ""}, "entity_extraction_enabled": False}
    found = lambda c: {r.discovered_work_id for r in pipeline.process(spark, user, references, config.from_dict(c)).by_affiliation.collect()}
    assert found(base) == {"W1", "W2"}
    assert found(base | {"clean_exclusion_ids": True}) == {"W2"}
