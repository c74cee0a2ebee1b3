"""Queries of public projections, merges of partial results, and registry tables, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.geometry import box
from veilspark.operators import incremental, merges, projections, registry
from veilspark.operators.projections import field
from veilspark.plans.frames import read_table
from veilspark.plans.queries import query
from veilspark.plans.release_queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]


def _named(name: str, key) -> Column:  # noqa: ANN001
    return F.format_string(f"{name}#%09d", key)


def _aliases(rows: DataFrame, kind: str, value, id_, entity, verified) -> DataFrame:  # noqa: ANN001
    """The value is a key already: lower case, words with one space between."""
    return rows.select(F.lit(kind).alias("alias_type"), value.alias("normalized_value"), id_.cast("long").alias("alias_id"), entity.alias("entity_id"), verified.alias("verified"))


_PERIOD = "({0} - {0} % 5)::VARCHAR || '-' || ({0} - {0} % 5 + 4)::VARCHAR"


# Public projections


@query(f"""
SELECT l_orderkey * 10 + l_linenumber AS education_id, l_orderkey AS document_id, CASE WHEN s_acctbal > 0 THEN 'organization_' || l_suppkey END AS organization_id,
  CASE l_returnflag WHEN 'R' THEN 'PhD' WHEN 'A' THEN 'M.A.' END AS degree_type, CASE WHEN l_returnflag IN ('R', 'A') THEN 'found' ELSE 'uncertain' END AS degree_status,
  CASE WHEN l_returnflag IN ('R', 'A') THEN '' ELSE 'invalid_controlled_value_suppressed' END AS degree_flags,
  l_linestatus AS academic_field, {_PERIOD.format("year(l_shipdate)")} AS start_period
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def public_education(spark: SparkSession, sf_dir: str) -> DataFrame:
    degree = F.when(F.col("l_returnflag") == "R", "PhD").when(F.col("l_returnflag") == "A", "M.A.").otherwise("Diploma")
    items = read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"), F.lit("a").alias("application_id"), F.col("l_orderkey").alias("document_id"),
        F.lit("p").alias("person_id"), field(_named("Supplier", "l_suppkey")).alias("institution"), field(degree).alias("degree_type"),
        field(F.col("l_linestatus")).alias("field"), *[field(F.year("l_shipdate")).alias(f"{c}_year") for c in ("start", "end", "graduation")],
        F.col("l_tax").alias("item_model_confidence"),
    )
    supplier = read_table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    key = F.format_string("supplier %09d", "s_suppkey")
    known = _aliases(supplier, "organization_name", key, F.col("s_suppkey"), F.concat(F.lit("organization_"), "s_suppkey"), F.lit(True))
    return projections.public_education(items, known).select(
        "education_id", "document_id", "organization_id", "degree_type.value", F.col("degree_type.status").alias("degree_status"),
        F.array_join("degree_type.validation_flags", ",").alias("degree_flags"), F.col("academic_field.value").alias("academic_field"), F.col("start_period.value").alias("start_period"),
    ).withColumnRenamed("value", "degree_type")


@query(f"""
SELECT o_orderkey AS employment_id, CASE WHEN c_acctbal > 0 THEN 'organization_' ELSE 'second_' END || o_custkey AS organization_id,
  CASE o_orderstatus WHEN 'F' THEN 'Faculty' WHEN 'P' THEN 'industry' END AS position_type, {_PERIOD.format("year(o_orderdate)")} AS start_period, 'present' AS end_period
FROM orders JOIN customer ON c_custkey = o_custkey""")
def public_employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each organisation has two aliases; the older one is taken only where it is verified."""
    position = F.when(F.col("o_orderstatus") == "F", "Faculty").when(F.col("o_orderstatus") == "P", "industry").otherwise("Intern")
    orders = read_table(spark, sf_dir, "orders")
    items = orders.select(
        F.col("o_orderkey").alias("item_id"), F.lit("a").alias("application_id"), F.col("o_custkey").alias("document_id"), F.lit("p").alias("person_id"),
        field(_named("Customer", "o_custkey")).alias("organization"), field(position).alias("position_type"), field(position).alias("job_category"),
        field(F.date_format("o_orderdate", "MMM yyyy")).alias("start_date"), field(F.lit("Present")).alias("end_date"), F.lit(0.5).alias("item_model_confidence"),
    )
    customer = read_table(spark, sf_dir, "customer")
    key = F.format_string("customer %09d", "c_custkey")
    first = _aliases(customer, "organization_name", key, F.col("c_custkey"), F.concat(F.lit("organization_"), "c_custkey"), F.col("c_acctbal") > 0)
    second = _aliases(customer, "organization_name", key, F.col("c_custkey") + 10**12, F.concat(F.lit("second_"), "c_custkey"), F.lit(True))
    return projections.public_employment(items, first.unionByName(second)).select(
        "employment_id", "organization_id", F.col("position_type.value").alias("position_type"), F.col("start_period.value").alias("start_period"), F.col("end_period.value").alias("end_period")
    )


@query("""
SELECT o_orderkey AS publication_id, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'work_' || o_orderkey END
    WHEN year(o_orderdate) < 1998 THEN 'work_' || o_orderpriority || '_' || year(o_orderdate) END AS work_id,
  CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'venue_' || left(o_orderpriority, 1) END AS venue_organization_id,
  CASE WHEN o_orderstatus <> 'O' THEN 'Journal article' END AS publication_type, year(o_orderdate)::VARCHAR AS publication_year
FROM orders""")
def public_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    doi = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("10.1000/"), "o_orderkey"))
    kind = F.when(F.col("o_orderstatus") == "O", "Poster").otherwise("Journal article")
    items = orders.select(
        F.col("o_orderkey").alias("item_id"), F.lit("a").alias("application_id"), F.col("o_custkey").alias("document_id"), F.lit("p").alias("person_id"),
        field(doi).alias("doi"), field(F.col("o_orderpriority")).alias("title"), field(F.col("year")).alias("year"), field(F.col("o_orderpriority")).alias("venue"),
        field(kind).alias("publication_type"), F.lit(0.5).alias("item_model_confidence"),
    )
    by_doi = orders.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0")
    works = _aliases(by_doi, "work_key", F.concat(F.lit("10 1000 "), "o_orderkey"), F.col("o_orderkey"), F.concat(F.lit("work_"), "o_orderkey"), F.lit(True))
    titled = orders.where("year < 1998").select("o_orderpriority", "year").distinct()
    words = F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit(" ")))
    by_title = _aliases(titled, "work_key", F.concat_ws(" ", words, "year"), F.col("year"), F.concat_ws("_", F.lit("work"), "o_orderpriority", "year"), F.lit(True))
    grades = orders.select("o_orderpriority").distinct().where(F.substring("o_orderpriority", 1, 1).isin("1", "2"))
    venues = _aliases(grades, "venue_name", words, F.lit(0), F.concat(F.lit("venue_"), F.substring("o_orderpriority", 1, 1)), F.lit(False))
    shown = projections.public_publications(items, works.unionByName(by_title).unionByName(venues))
    return shown.select("publication_id", "work_id", "venue_organization_id", F.col("publication_type.value").alias("publication_type"), F.col("publication_year.value").alias("publication_year"))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of names, each name several times in a document."""
    return read_table(spark, sf_dir, "events").select(
        (F.col("user_id") % 50).alias("document_id"), F.lit("person_name").alias("kind"), F.format_string("CUSTOMER %09d", F.col("event_id") % 20).alias("text"),
        F.when(F.col("value") > 10, F.concat(F.lit("person_"), "event_id")).alias("entity_id"), F.col("event_id").alias("ord"),
    )


@query("""
WITH n AS (SELECT user_id % 50 AS d, event_id % 20 AS k, max(event_id) AS p FROM events WHERE value > 10 GROUP BY ALL)
SELECT l_orderkey AS publication_id, 'work_' || l_orderkey AS work_id, 'person_' || CASE WHEN l_linenumber = 1 THEN o_custkey ELSE p END AS person_id,
  l_linenumber AS author_position, l_linenumber = 1 AS is_applicant
FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN n ON d = l_orderkey % 50 AND k = l_partkey % 20""")
def public_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("publication_id"), (F.col("l_orderkey") % 50).alias("document_id"), field(_named("Customer", F.col("l_partkey") % 20)).alias("name"),
        F.col("l_linenumber").alias("author_position"), (F.col("l_linenumber") == 1).alias("is_applicant"),
    )
    works = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("publication_id"), F.concat(F.lit("work_"), "o_orderkey").alias("work_id"), F.concat(F.lit("person_"), "o_custkey").alias("person_id")
    )
    return projections.public_authors(authors, works, _people(spark, sf_dir)).drop("model_confidence")


@query("""
SELECT user_id % 50 AS document_id, 'customer 0000000' || lpad((event_id % 20)::VARCHAR, 2, '0') AS name_key, 'person_' || min(event_id) AS person_id
FROM events WHERE value > 10 GROUP BY ALL""")
def author_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The person whom a name stands for where relationships are derived: its first mention's."""
    return projections.named_people(_people(spark, sf_dir))


@query("""
WITH i AS (SELECT o_custkey, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
SELECT c_custkey AS document_id, CASE WHEN c_acctbal > 0 THEN 'found' ELSE 'model_failed' END AS status, coalesce(n, 0)::INT AS items, coalesce(ids, '') AS ids
FROM customer LEFT JOIN i ON o_custkey = c_custkey""")
def public_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    documents = customer.select(F.lit("a").alias("application_id"), F.col("c_custkey").alias("document_id"), F.lit("p").alias("person_id"))
    sections = customer.select(
        F.col("c_custkey").alias("document_id"), F.lit("education").alias("section"), F.when(F.col("c_acctbal") > 0, "found").alias("status"),
        F.lit(0.5).alias("model_confidence"), F.lit("").alias("not_found_reason"), F.array(F.lit("checked")).alias("validation_flags"),
    )
    orders = read_table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    items = orders.select(F.col("o_orderkey").alias("education_id"), F.lit("a").alias("application_id"), F.col("o_custkey").alias("document_id"), F.lit("p").alias("person_id"), "o_orderpriority")
    rows = projections.profiles(documents, sections, {"education": (items, "education_id")}).withColumn("of", F.coalesce("education.items", F.array()))
    ids = F.array_join(F.transform("of", lambda x: x["education_id"]), ",")
    return rows.select("document_id", F.col("education.status").alias("status"), F.size("of").alias("items"), ids.alias("ids"))


@query("""
SELECT 'rel_' || substr(sha256('educated_at|' || o_orderkey), 1, 20) AS relationship_id, 'educated_at' AS relationship_type, 'customer_' || o_custkey AS source_id, 'status_' || o_orderstatus AS target_id
FROM orders WHERE o_orderstatus <> 'P'""")
def cv_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("status_"), "o_orderstatus"))
    items = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("education_id"), F.col("o_custkey").alias("document_id"), F.concat(F.lit("customer_"), "o_custkey").alias("person_id"),
        target.alias("organization_id"), F.lit(0.5).alias("item_model_confidence"),
    )
    return projections.cv_relationships(items, "education_id", "educated_at", "organization_id").select("relationship_id", "relationship_type", "source_id", "target_id")


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id) AS k FROM events WHERE value >= 20)
SELECT user_id AS document_id, 'm' || event_id % 3 || CASE WHEN k > 1 THEN '#' || k ELSE '' END AS redaction_id,
  CASE WHEN s_suppkey IS NOT NULL THEN 'linked' WHEN p_partkey IS NOT NULL THEN 'entity_without_person' ELSE 'unlinked' END AS link_status
FROM o LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = event_id % 150 LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = p_partkey % 7""")
def redaction_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    occurrences = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("document_id"), F.concat(F.lit("m"), F.col("event_id") % 3).alias("mention_id"), F.col("event_id").alias("ord"),
        (F.col("value") >= 20).alias("accepted"), (F.col("event_id") % 150).alias("entity_id"),
    )
    entities = read_table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("entity_id"), (F.col("p_partkey") % 7).alias("person_id"), F.lit(True).alias("known_entity"))
    people = read_table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("person_id"), F.lit(True).alias("known_person"))
    return projections.redaction_export(occurrences, entities, people).select("document_id", "redaction_id", "link_status")


# Merges


_PARTS = """SELECT conv_id, role, turn, text, CASE turn % 3 WHEN 1 THEN 'found' WHEN 2 THEN 'model_failed' ELSE 'not_found' END AS status, turn / 100 AS confidence FROM conversations"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    status = F.when(turn % 3 == 1, "found").when(turn % 3 == 2, "model_failed").otherwise("not_found")
    items = F.when(turn % 6 == 1, F.array("text")).otherwise(F.array().cast("array<string>"))
    return read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("document_id"), F.col("role").alias("section"), turn.alias("chunk"), status.alias("status"), (turn / 100).alias("model_confidence"), items.alias("items")
    )


@query(f"""
SELECT conv_id AS document_id, role AS section, CASE WHEN bool_or(turn % 6 = 1) THEN 'found' WHEN bool_or(status = 'model_failed') THEN 'model_failed' ELSE 'not_found' END AS status,
  arg_min(confidence, CASE status WHEN 'found' THEN 0 WHEN 'model_failed' THEN 1000000 ELSE 2000000 END + turn) AS model_confidence, count(*) FILTER (turn % 6 = 1)::INT AS items,
  sha256(coalesce(string_agg(text, '|' ORDER BY turn) FILTER (turn % 6 = 1), '')) AS items_sha256
FROM ({_PARTS}) GROUP BY ALL""")
def merged_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merges.merged_sections(_parts(spark, sf_dir)).select(
        "document_id", "section", "status", "model_confidence", F.size("items").alias("items"), F.sha2(F.array_join("items", "|"), 256).alias("items_sha256")
    )


@query("""
SELECT conv_id AS document_id, CASE WHEN bool_or(turn % 5 = 4) THEN 'found' WHEN bool_or(turn % 5 = 3) THEN 'uncertain' WHEN bool_or(turn % 5 = 2) THEN 'not_found' ELSE 'model_failed' END AS status,
  CASE WHEN bool_or(turn % 5 >= 2) THEN min(turn) FILTER (turn % 2 = 1) / 100 END AS model_confidence
FROM conversations GROUP BY conv_id""")
def merged_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    status = F.when(turn % 5 == 4, "found").when(turn % 5 == 3, "uncertain").when(turn % 5 == 2, "not_found").otherwise("model_failed")
    chunks = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), turn.alias("chunk"), status.alias("status"), F.when(turn % 2 == 1, turn / 100).alias("model_confidence"))
    return merges.merged_letters(chunks)


@query("""
SELECT conv_id AS document_id, role AS section, CASE WHEN bool_or(turn % 6 = 1) THEN 'found' WHEN bool_or(turn % 3 = 2) THEN 'uncertain' ELSE 'not_found' END AS status, count(*) FILTER (turn % 6 = 1)::INT AS items
FROM conversations GROUP BY ALL""")
def merged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parts(spark, sf_dir).withColumn("status", F.when(F.col("status") == "model_failed", "uncertain").otherwise("not_found"))
    return merges.merged_pages(rows, part="chunk").select("document_id", "section", "status", F.size("items").alias("items"))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings' first two numbers as corners of boxes in points, labels as pages."""
    x, y = F.col("embedding")[0].cast("double") * 500, F.col("embedding")[1].cast("double") * 500
    return read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("page"), box(x, y, x + 12, y + 12).alias("box"))


@query("""
WITH b AS (SELECT vec_id, label AS page, embedding[1]::DOUBLE * 500 AS x, embedding[2]::DOUBLE * 500 AS y FROM embeddings),
p AS (SELECT l.vec_id AS box_id, w.* FROM b l JOIN b w ON w.page = l.page AND w.vec_id % 2 = 1 AND l.x - 4 < w.x + 12 AND w.x < l.x + 16 AND l.y - 3 < w.y + 12 AND w.y < l.y + 15 WHERE l.vec_id % 2 = 0)
SELECT b.vec_id AS box_id, coalesce(string_agg('w' || p.vec_id, ' ' ORDER BY p.vec_id), '') AS text, min(p.x) AS left_edge, max(p.y + 12) AS lower_edge
FROM b LEFT JOIN p ON box_id = b.vec_id WHERE b.vec_id % 2 = 0 GROUP BY b.vec_id""")
def text_in_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir)
    words = rows.where("vec_id % 2 = 1").select("page", F.col("vec_id").alias("ord"), F.concat(F.lit("w"), "vec_id").alias("word"), "box")
    found = merges.text_in_boxes(words, rows.where("vec_id % 2 = 0").withColumnRenamed("vec_id", "box_id"), ["page"])
    return found.select("box_id", "text", F.col("snapped.x0").alias("left_edge"), F.col("snapped.y1").alias("lower_edge"))


@query()
def merged_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of rows decides what merges, so there is no SQL; a test compares with a plain loop."""
    id_ = F.col("vec_id")
    kinds = F.element_at(F.array(*map(F.lit, ("email", "website", "address"))), (id_ % 3 + 1).cast("int"))
    sources = F.element_at(F.array(*map(F.lit, ("model", "pdf_regex"))), (id_ % 2 + 1).cast("int"))
    rows = _boxes(spark, sf_dir).select(
        (F.col("page") % 5).alias("document_id"), "page", kinds.alias("category"), id_.alias("ord"), "box.*", sources.alias("source"),
        F.when(id_ % 5 == 0, "applicant").otherwise("unknown").alias("role"), F.concat(F.lit("t"), id_).alias("text"),
    )
    return merges.merged_occurrences(rows)


# Registry


@query("""
WITH v AS (SELECT p_partkey, p_size, 'organization_' || substr(sha256(trim(regexp_replace(lower(CASE WHEN p_size > 25 THEN p_type ELSE p_brand END), '[^a-z0-9_]+', ' ', 'g'))), 1, 20) AS entity_id FROM part)
SELECT entity_id, 'size' || arg_min(p_size, p_partkey) AS entity_type, count(DISTINCT p_partkey % 100) AS occurrence_count, 'resolved' AS resolution_status
FROM v GROUP BY entity_id HAVING bool_or(p_partkey % 3 = 0)""")
def opaque_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("value"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("strong"),
        F.concat(F.lit("size"), "p_size").alias("entity_type"), (F.col("p_partkey") % 100).alias("evidence"),
    )
    resolved = registry.resolved_values(part, "organization", strong_key="strong")
    entities = registry.opaque_entities(resolved, "entity_type", "p_partkey", "evidence")
    return registry.public_rows(entities, resolved.where("p_partkey % 3 = 0"))


@query("""
SELECT DISTINCT 'organization_' || substr(sha256(trim(regexp_replace(lower(CASE WHEN p_size > 25 THEN p_type ELSE p_brand END), '[^a-z0-9_]+', ' ', 'g'))), 1, 20) AS entity_id, p_brand AS alias FROM part""")
def opaque_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select(F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("value"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("strong"))
    return registry.opaque_aliases(registry.resolved_values(part, "organization", strong_key="strong"))


@query("""
SELECT DISTINCT 'person_' || c_custkey AS entity_id, 'email' AS alias_type, lower(c_mktsegment) || '@x.org' AS normalized_value, o_orderstatus = 'F' AS verified
FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 2 = 0 AND c_nationkey % 3 <> 1""")
def registry_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("c_custkey") % 2 == 0, "person_").otherwise("group_")
    status = F.when(F.col("c_nationkey") % 3 == 0, "active").when(F.col("c_nationkey") % 3 == 1, "merged")
    customer = read_table(spark, sf_dir, "customer")
    persons = customer.select(F.concat(prefix, "c_custkey").alias("person_id"), status.alias("status"))
    orders = read_table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    identifiers = orders.select(
        F.concat(prefix, "c_custkey").alias("person_id"), F.lit("email").alias("identifier_type"), F.concat("c_mktsegment", F.lit("@X.org")).alias("value"),
        F.when(F.col("o_orderstatus") == "F", True).alias("verified"),
    )
    imports = read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("checksum"))
    return registry.imported(persons, identifiers, imports, "not imported before")[1]


@query("""
SELECT o_custkey AS party, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS roles, count(DISTINCT o_orderkey)::INT AS documents,
  CASE WHEN bool_or(year(o_orderdate) < 1998) THEN 'cv' ELSE 'letter' END AS source, 'person_' || o_custkey % 10 AS person_id
FROM orders GROUP BY o_custkey""")
def party_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")).select(
        F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("role"), F.col("o_orderpriority").alias("application_id"), F.col("o_orderkey").alias("document_id"), F.lit("e").alias("entity_id"), "year"
    )
    both = registry.parties({"cv": orders.where("year < 1998"), "letter": orders.where("year >= 1998")})
    persons = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"), F.concat(F.lit("person_"), F.col("c_custkey") % 10).alias("person_id"))
    return registry.serialized(both, persons).select("party", F.array_join("roles", ",").alias("roles"), F.size("document_ids").alias("documents"), "source", "person_id")


@query("""
SELECT user_id AS party, event_id % 10 AS document_id, lower(event_type) || '@x.org' AS normalized_value, bool_or(value > 50) AS verified, count(*) AS seen FROM events GROUP BY ALL""")
def party_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("party"), F.lit("email").alias("identifier_type"), F.concat("event_type", F.lit("@X.org")).alias("value"),
        (F.col("event_id") % 10).alias("document_id"), F.lit(None).cast("string").alias("entity_id"), (F.col("value") > 50).alias("verified"),
    )
    return registry.party_identifiers(rows).select("party", "document_id", "normalized_value", "verified", "seen")


@query("""
SELECT CASE WHEN s_suppkey IS NOT NULL THEN s_suppkey % 5 ELSE l_suppkey END AS person_id, min(l_orderkey) AS party, count(*) AS parties
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 5000) ON s_suppkey = l_suppkey GROUP BY 1""")
def person_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("party"), F.col("l_suppkey").alias("person_id")).distinct()
    retired = read_table(spark, sf_dir, "supplier").where("s_acctbal < 5000").select(F.col("s_suppkey").alias("person_id"), (F.col("s_suppkey") % 5).alias("survivor"))
    return registry.representatives(registry.active_persons(members, retired))


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Unclassified' ELSE upper(left(event_type, 1)) || substr(lower(event_type), 2) || ' Owner' END || CASE WHEN event_id % 2 = 0 THEN ' email address' ELSE ' other' END AS label FROM events""")
def reason_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("event_id") % 4 == 0, "unknown").otherwise(F.concat("event_type", F.lit("_owner")))
    kind = F.when(F.col("event_id") % 2 == 0, "email").otherwise("other")
    return read_table(spark, sf_dir, "events").select("event_id", registry.reason_label(role, kind).alias("label"))


# Stages


@query("""
SELECT o_orderkey, CASE WHEN ok THEN 'completed' ELSE 'failed' END AS processing_status, CASE WHEN ok AND o_orderkey % 3 > 0 THEN 'status' || o_orderkey % 3 ELSE 'withheld' END AS release_status,
  CASE WHEN NOT ok THEN 'processing_failed' WHEN o_orderkey % 3 = 0 THEN 'privacy_not_completed' END AS reason_code
FROM (SELECT o_orderkey, o_orderstatus <> 'P' AND o_totalprice > 50000 AS ok FROM orders)""")
def loaded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "document_id")
    privacy = orders.where("document_id % 3 > 0").select("document_id", F.concat(F.lit("status"), F.col("document_id") % 3).alias("release_status"))
    rows = incremental.loaded(orders.select("document_id"), orders.where("o_orderstatus <> 'P'"), orders.where("o_totalprice > 50000"), privacy)
    return rows.withColumnRenamed("document_id", "o_orderkey")


@query("""
SELECT o_orderkey AS document_id, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 0 AND o_orderkey % 5 > 0 THEN 'new' ELSE 'old' END AS stage_fingerprint FROM orders""")
def restamped_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "found").otherwise("model_failed")
    state = orders.select(F.col("o_orderkey").alias("document_id"), F.lit("old").alias("stage_fingerprint"), status.alias("extraction_status"), (F.col("o_orderkey") % 4).alias("failed_pages"))
    expected = orders.where("o_orderkey % 5 > 0").select(F.col("o_orderkey").alias("document_id"), F.lit("new").alias("expected"))
    return incremental.restamped(state, expected).select("document_id", "stage_fingerprint")
