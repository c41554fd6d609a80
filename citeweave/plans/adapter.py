"""The driver's star-schema tables in the shapes of this library, as DataFrames and as the same SQL.

An order is a work, its lines are the authors, a part's name is a person's name, a supplier and a brand make an
affiliation, and a nation is an institution.  The user's list are the urgent orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

URGENT = "1-URGENT"
ORGANIZATIONS = ["Supplier#000000007 Institute", "Supplier#00000001", "Brand#13"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doi_of(order: Column) -> Column:
    """Every tenth work has no DOI."""
    return F.when(order % 10 != 0, F.concat(F.lit("10."), (1000 + order % 9).cast("string"), F.lit("/Ord."), order.cast("string")))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order, line number (made unique) and what the tables have for the part and the supplier of every line."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    window = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = items.withColumn("n", F.row_number().over(window) - 1)
    rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(F.col("l_orderkey").alias("k"), "n", F.col("p_name").alias("name"), "s_name", "p_brand", "s_nationkey")


def _affiliation(supplier: Column, brand: Column) -> Column:
    return F.concat(supplier, F.lit(" Institute, Unit "), brand)


def _ror(nation: Column) -> Column:
    return F.concat(F.lit("https://ror.org/"), nation.cast("string"))


def _institution(nation: Column) -> Column:
    return F.concat(F.lit("I"), nation.cast("string"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order, line number (made unique), part name, affiliation name, institution of every line."""
    nation = F.col("s_nationkey")
    return _joined(spark, sf_dir).select("k", "n", "name", _affiliation(F.col("s_name"), F.col("p_brand")).alias("affiliation"), _ror(nation).alias("ror"), _institution(nation).alias("institution"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The author x affiliation table before validation, all strings, with the faults that validation looks for."""
    from ..functions import text

    plain = text.normalized_latin(F.col("affiliation"))
    return lines(spark, sf_dir).select(
        F.when(F.col("n") == 6, "null").otherwise(F.concat(F.lit("W"), F.col("k").cast("string"))).alias("work_id"),
        F.coalesce(doi_of(F.col("k")), F.lit("null")).alias("doi"), F.when(F.col("n") == 2, "x").otherwise(F.col("n").cast("string")).alias("author_sequence"),
        F.when(F.col("n") == 5, "").otherwise(F.col("name")).alias("author_name"), F.lower("name").alias("normalized_author_name"), F.lit("0").alias("affiliation_sequence"),
        F.col("affiliation").alias("affiliation_name"), plain.alias("normalized_affiliation_name"), F.col("ror").alias("affiliation_ror"),
    )


STAGED_SQL = """lines AS (
  SELECT l.k, l.n, p.p_name AS name, s.s_name || ' Institute, Unit ' || p.p_brand AS affiliation, 'https://ror.org/' || s.s_nationkey AS ror, 'I' || s.s_nationkey AS institution
  FROM (SELECT l_orderkey AS k, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS n FROM lineitem) l
  JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
staged AS (
  SELECT CASE WHEN n = 6 THEN 'null' ELSE 'W' || k END AS work_id, CASE WHEN k % 10 <> 0 THEN '10.' || (1000 + k % 9) || '/Ord.' || k ELSE 'null' END AS doi,
    CASE WHEN n = 2 THEN 'x' ELSE n::VARCHAR END AS author_sequence, CASE WHEN n = 5 THEN '' ELSE name END AS author_name, lower(name) AS normalized_author_name,
    '0' AS affiliation_sequence, affiliation AS affiliation_name, trim(regexp_replace(lower(affiliation), '[^\\w\\s]', '', 'g')) AS normalized_affiliation_name,
    ror AS affiliation_ror FROM lines)"""

REFS_SQL = (
    "WITH "
    + STAGED_SQL
    + """,
refs AS (
  SELECT work_id, CASE WHEN doi IN ('', 'null') THEN NULL ELSE doi END AS doi, TRY_CAST(author_sequence AS INTEGER) AS author_sequence, author_name, normalized_author_name,
    TRY_CAST(affiliation_sequence AS INTEGER) AS affiliation_sequence, affiliation_name, normalized_affiliation_name, affiliation_ror,
    lower(trim(coalesce(normalized_affiliation_name, ''))) AS normalized_affiliation_key
  FROM staged WHERE work_id NOT IN ('', 'null') AND author_name <> '' AND length(work_id) < 1000 AND length(author_name) < 500)"""
)


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.build import build_references

    return build_references(staged(spark, sf_dir))


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The urgent orders as a user's list: a DOI as a URL or with a label, a work id, and names as "last, first"."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == URGENT).select("o_orderkey", "o_orderstatus")
    name = F.concat(F.split_part("name", F.lit(" "), F.lit(2)), F.lit(", "), F.split_part("name", F.lit(" "), F.lit(1)))
    names = lines(spark, sf_dir).groupBy("k").agg(F.array_join(F.array_sort(F.collect_set(name)), "; ").alias("authors"))
    doi = doi_of(F.col("o_orderkey"))
    return orders.join(names, F.col("o_orderkey") == F.col("k")).select(
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("https://doi.org/"), doi)).when(F.col("o_orderstatus") == "O", F.concat(F.lit(" doi:"), doi, F.lit(" "))).otherwise(doi).alias("doi"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("W"), F.col("o_orderkey").cast("string"))).alias("work_id"), "authors",
    )


#: Continues ``REFS_SQL``: the same list, with raw and clean DOI.
USER_SQL = """,
users AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'https://doi.org/' || d WHEN 'O' THEN ' doi:' || d || ' ' ELSE d END AS doi, d AS clean_doi,
    CASE WHEN o_orderstatus = 'P' THEN 'W' || o_orderkey END AS work_id, o_orderkey AS k
  FROM (SELECT *, CASE WHEN o_orderkey % 10 <> 0 THEN '10.' || (1000 + o_orderkey % 9) || '/Ord.' || o_orderkey END AS d FROM orders WHERE o_orderpriority = '1-URGENT')
  WHERE o_orderkey IN (SELECT k FROM lines)),
inputs AS (
  SELECT DISTINCT u.clean_doi AS input_doi, u.work_id AS input_work_id, split_part(l.name, ' ', 2) || ', ' || split_part(l.name, ' ', 1) AS input_author FROM users u JOIN lines l ON u.k = l.k),
orgs AS (SELECT unnest(['supplier000000007 institute', 'supplier00000001', 'brand13']) AS name),
pairs AS (
  SELECT DISTINCT i.input_doi, i.input_work_id, i.input_author, r.author_name AS ref_author_name, r.normalized_affiliation_name AS ref_affiliation FROM inputs i JOIN refs r ON i.input_doi = r.doi
  UNION
  SELECT DISTINCT i.input_doi, i.input_work_id, i.input_author, r.author_name, r.normalized_affiliation_name FROM inputs i JOIN refs r ON i.input_work_id = r.work_id),
scored AS (
  SELECT *, jaro_winkler_similarity(il, rl) AS jl, jaro_winkler_similarity(i1, r1) AS jf FROM (
    SELECT *, split_part(input_author, ', ', 1) AS il, split_part(input_author, ', ', 2) AS i1, split_part(ref_author_name, ' ', 2) AS rl, split_part(ref_author_name, ' ', 1) AS r1 FROM pairs)),
linkage AS (
  SELECT coalesce(input_doi, '') AS input_doi, coalesce(input_work_id, '') AS input_work_id, input_author AS input_author_name, ref_author_name, ref_affiliation,
    CASE WHEN EXISTS (SELECT 1 FROM orgs o WHERE contains(ref_affiliation, o.name)) THEN 'org_match_found' ELSE 'name_match_no_org_affiliation' END AS linkage_status
  FROM scored WHERE jl >= 0.85 AND (jl >= 0.95 OR (CASE WHEN length(i1) = 1 OR length(r1) = 1 THEN i1[1] = r1[1] ELSE jf >= 0.85 END))),
known AS (SELECT DISTINCT doi, work_id FROM users),
unknown AS (SELECT * FROM refs r WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.doi = r.doi) AND NOT EXISTS (SELECT 1 FROM known k WHERE k.work_id = r.work_id)),
discovered AS (
  SELECT l.input_doi, l.input_work_id, l.input_author_name, l.ref_affiliation AS linking_affiliation, r.work_id AS discovered_work_id, r.doi AS discovered_doi,
    r.author_name AS discovered_author, r.affiliation_name AS discovered_author_affiliation, r.affiliation_ror AS discovered_ror_id
  FROM linkage l JOIN unknown r ON lower(trim(l.ref_affiliation)) = r.normalized_affiliation_key WHERE l.linkage_status = 'org_match_found'),
entities AS (SELECT * FROM (VALUES ('supplier000000007 institute', 'a'), ('institute unit brand13', 'b')) t(entity_key, source_affiliations)),
by_entity AS (
  SELECT DISTINCT e.source_affiliations AS source_embl_affiliation, e.entity_key AS extracted_entity, r.work_id AS discovered_work_id, r.doi AS discovered_doi,
    r.author_name AS discovered_author, r.affiliation_name AS discovered_author_affiliation, r.normalized_affiliation_name AS discovered_normalized_affiliation,
    r.affiliation_ror AS discovered_ror_id
  FROM entities e JOIN unknown r ON contains(r.normalized_affiliation_key, e.entity_key)
  WHERE EXISTS (SELECT 1 FROM (VALUES ('institute')) o(name) WHERE contains(r.normalized_affiliation_key, o.name))),
works AS (
  SELECT discovered_work_id AS work_id, discovered_doi AS doi, discovered_author AS author, discovered_author_affiliation AS author_affiliation, discovered_ror_id AS ror_id,
    linking_affiliation AS matching_affiliation, 'affiliation_exact' AS match_type FROM discovered
  UNION ALL
  SELECT discovered_work_id, discovered_doi, discovered_author, discovered_author_affiliation, discovered_ror_id, extracted_entity, 'entity_extracted' FROM by_entity),
combined AS (
  SELECT work_id, doi, author, author_affiliation, ror_id, matching_affiliation, match_type FROM (
    SELECT *, row_number() OVER (PARTITION BY work_id, doi, author ORDER BY CASE match_type WHEN 'affiliation_exact' THEN 1 ELSE 2 END, matching_affiliation, author_affiliation, ror_id) AS p
    FROM works) WHERE p = 1)"""
ENTITY_ORGANIZATIONS = ["Institute"]
ENTITIES = [("supplier000000007 institute", "a"), ("institute unit brand13", "b")]


def work_lines(spark: SparkSession, sf_dir: str, bare: int | None = None) -> DataFrame:
    """Every order as one line of JSON, as works with a work id come; the last of every ``bare`` authors has no affiliation."""
    def author(line: Column) -> Column:
        nation = line["s_nationkey"]
        ids = {"affiliations": F.array(F.struct(_affiliation(line["s_name"], line["p_brand"]).alias("raw_affiliation_string"), F.array(_institution(nation)).alias("institution_ids"))),
               "institutions": F.array(F.struct(_institution(nation).alias("id"), _ror(nation).alias("ror")))}
        held = F.lit(True) if bare is None else line["n"] % bare != bare - 1
        return F.struct(F.struct(line["name"].alias("display_name")).alias("author"), *(F.when(held, v).alias(c) for c, v in ids.items()))

    # an order's lines come together as the tables have them; what is made of them is longer
    listed = F.transform(F.array_sort(F.collect_list(F.struct("n", "name", "s_name", "p_brand", "s_nationkey"))), author)
    works = _joined(spark, sf_dir).groupBy("k").agg(listed.alias("authorships"))
    record = F.struct(
        F.concat(F.lit("W"), F.col("k").cast("string")).alias("id"), F.concat(F.lit("https://doi.org/"), doi_of(F.col("k"))).alias("doi"), "authorships",
        F.struct(F.struct(F.concat(F.lit("S"), (F.col("k") % 5).cast("string")).alias("id")).alias("source")).alias("primary_location"),
    )
    # the shuffle of the grouping deals the lines out already, so nothing is spread again before they are parsed
    return works.select(F.to_json(record).alias("line"), F.lit("orders").alias("source_file_path"))


def doi_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one line of JSON, as works known by their DOI come; the member is a number, every seventh has no field."""
    k = F.col("k")
    author = F.struct(F.col("name").alias("family"), F.array(F.struct(F.col("affiliation").alias("name"))).alias("affiliation"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("n", author.alias("a")))), lambda x: x["a"])
    works = lines(spark, sf_dir).groupBy("k").agg(listed.alias("authors"))
    full = k % 7 != 0
    cited = F.struct(F.array(F.struct(F.concat(F.lit("W"), k.cast("string")).alias("id"), k.alias("n"))).alias("cites"))
    record = F.struct(
        doi_of(k).alias("DOI"), (k % 5).alias("member"), F.when(k % 3 == 0, F.concat(F.lit("P"), (k % 9).cast("string"))).alias("prefix"), F.when(full, F.col("authors")).alias("author"),
        F.when(full, F.array(F.concat(F.lit("Order "), k.cast("string")))).alias("title"), F.when(full, cited).alias("relation"),
    )
    return works.select(F.to_json(record).alias("line"), F.lit("orders").alias("source_file_path"))
