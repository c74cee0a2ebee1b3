"""Queries of mentions, registry, review and release tables, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.functions import scalars as C
from veilspark.functions import spans as S
from veilspark.operators import gate, incremental, joins, mentions, resolution, rollups, sets
from veilspark.plans.frames import read_table
from veilspark.plans.queries import _EMAIL, ORACLE_SQL, QUERIES, _spans_sql, documents, query

__all__ = ["ORACLE_SQL", "QUERIES"]


# Mentions


@query("""
SELECT user_id, event_id % 7 AS start, event_type AS kind, event_id AS ord, role FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 7, event_type ORDER BY (role = 'unknown')::INT, event_id) AS k
  FROM (SELECT *, CASE WHEN value >= 50 THEN 'author' ELSE 'unknown' END AS role FROM events)) WHERE k = 1""")
def mention_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("value") >= 50, "author").otherwise("unknown")
    rows = read_table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 7).alias("start"), F.col("event_type").alias("kind"), F.col("event_id").alias("ord"), role.alias("role"))
    return mentions.deduplicated(rows, ["user_id", "start", "kind"])


@query("""
WITH m AS (SELECT l_orderkey AS document_id, l_linenumber AS start, 'model' AS detector FROM lineitem),
f AS (SELECT o_orderkey AS document_id, CASE WHEN o_orderpriority LIKE '1%' THEN 9 ELSE 1 END AS start FROM orders WHERE o_orderstatus = 'F')
SELECT coalesce(m.document_id, f.document_id) AS document_id, coalesce(m.start, f.start) AS start,
  CASE WHEN f.document_id IS NOT NULL THEN 'structured' ELSE detector END AS detector
FROM m FULL JOIN f ON m.document_id = f.document_id AND m.start = f.start""")
def field_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("start"), F.lit("model").alias("detector"))
    fields = read_table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    fields = fields.select(F.col("o_orderkey").alias("document_id"), F.when(F.col("o_orderpriority").startswith("1"), 9).otherwise(1).alias("start"))
    return mentions.promoted(found, fields, ["document_id", "start"])


@query("SELECT l_orderkey, count(DISTINCT (l_partkey, l_suppkey)) AS structured_mentions FROM lineitem GROUP BY l_orderkey")
def mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.counted(read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey"), "l_orderkey", "l_partkey", "l_suppkey")


@query("""
SELECT conv_id, turn, 100 * turn AS start, 100 * turn + length(text) AS "end"
FROM conversations WHERE text IS NOT NULL""")
def shifted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    one = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length("text").cast("long").alias("end")))
    return turns.select("conv_id", "turn", F.inline(mentions.shifted(one, 100 * F.col("turn"))))


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) >= 40 AS reliable,
  array_to_string(list_filter([
    CASE WHEN length(text) - length(replace(text, chr(65533), '')) > 0.05 * length(text) THEN 'encoding_replacement_characters' END,
    CASE WHEN doc_id % 10 > 6 AND length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) < 160 THEN 'image_dominant_page' END,
    CASE WHEN length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) < 40 THEN 'insufficient_native_text' END,
    CASE WHEN length(text) - length(regexp_replace(text, '[^\\p{C}\\p{Z}]|[ \\n\\t]', '', 'g')) < 0.85 * length(text) THEN 'low_printable_ratio' END,
    CASE WHEN doc_id % 4 % 2 = 1 THEN 'rotated_page' END], lambda x: x IS NOT NULL), ',') AS flags,
  NOT regexp_matches(text, '\\S') AND doc_id % 3 = 0 AS blank FROM d""".replace("\\\\", "\\"))
def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotation, images and drawings, which the table lacks, are told from the id."""
    text, id_ = F.coalesce("text", F.lit("")), F.col("doc_id")
    flags = C.native_quality(text, id_ % 4 * 90, id_ % 10 / 10)
    return read_table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", C.native_text_reliable(text).alias("reliable"), F.array_join(flags, ",").alias("flags"), C.visually_blank(text, id_ % 3, F.lit(0)).alias("blank")
    )


@query("""
SELECT d.doc_id, regexp_replace(coalesce(text, ''), '[^\\r\\n]', ' ', 'g') AS masked FROM documents d WHERE length(text) BETWEEN 1 AND 400""".replace("\\\\", "\\"))
def masked_short_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known spans as blanks: here one that covers the whole of a short text."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").where(F.length("text").between(1, 400))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length("text").alias("end"), F.lit("email").alias("kind"), F.col("text").alias("text")))
    return docs.select("doc_id", S.mask_spans(F.col("text"), whole).alias("masked"))


@query("""
WITH p AS (SELECT conv_id, turn, coalesce(length(text), 0) AS n FROM conversations),
o AS (SELECT conv_id, turn, n, (sum(n + 1) OVER (PARTITION BY conv_id ORDER BY turn) - n - 1)::BIGINT AS a FROM p),
q AS (SELECT conv_id, unnest([0, 10, 100, 500, 2000]) AS start FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT q.conv_id, q.start, min(turn) AS page FROM q LEFT JOIN o ON o.conv_id = q.conv_id AND a <= q.start AND q.start + 5 <= a + n GROUP BY ALL""")
def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first turn, taken as a page, that holds a place and the five characters after it."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0))
    pages = turns.select("conv_id", F.struct(F.col("turn").alias("page"), start.alias("document_start"), (start + F.col("n")).alias("document_end")).alias("page"))
    listed = pages.groupBy("conv_id").agg(F.sort_array(F.collect_list("page")).alias("pages"))
    asked = listed.select("conv_id", "pages", F.explode(F.array(*map(F.lit, (0, 10, 100, 500, 2000)))).alias("start"))
    return asked.select("conv_id", "start", S.page_of(F.col("pages"), F.col("start"), F.col("start") + 5)["page"].alias("page"))


# Registry and review


@query("""
SELECT o_orderkey, 'customer_' || substr(sha256(a.c_custkey::VARCHAR), 1, 20) AS source_id, 'customer_' || substr(sha256(b.c_custkey::VARCHAR), 1, 20) AS target_id
FROM orders JOIN customer a ON a.c_custkey = o_custkey JOIN customer b ON b.c_custkey = o_orderkey % 1000 WHERE a.c_acctbal > 0 AND b.c_acctbal > 0""")
def relationship_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read_table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", C.stable_id("customer", F.col("c_custkey")).alias("id"))
    edges = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 1000).alias("dst"))
    return joins.endpoints(edges, known, "c_custkey", "id").select("o_orderkey", "source_id", "target_id")


_LINKED = """
SELECT l_orderkey, l_linenumber, CASE WHEN s.s_suppkey IS NOT NULL THEN 'linked' WHEN p.p_partkey IS NOT NULL THEN 'entity_without_person' ELSE 'unlinked' END AS link_status
FROM lineitem LEFT JOIN (SELECT p_partkey, p_partkey % 100 AS person FROM part WHERE p_size > 10) p ON p.p_partkey = l_partkey
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = p.person"""


@query(_LINKED)
def link_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    redactions = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("entity_id"))
    entities = read_table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("entity_id"), (F.col("p_partkey") % 100).alias("person_id"), F.lit(True).alias("known_entity"))
    people = read_table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("person_id"), F.lit(True).alias("known_person"))
    return joins.link_status(redactions, entities, people).select("l_orderkey", "l_linenumber", "link_status")


@query(f"SELECT link_status, count(*) AS redactions FROM ({_LINKED}) GROUP BY link_status")
def redaction_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.redaction_quality(link_status(spark, sf_dir))


@query("""
SELECT c_custkey AS entity_id, c_mktsegment AS entity_type, count(DISTINCT o_orderstatus) AS document_count, count(DISTINCT o_orderpriority) AS application_count
FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY ALL""")
def public_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("c_acctbal") > 0, "active").otherwise("merged")
    entities = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("entity_type"), status.alias("status"))
    seen = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_id"), "o_orderstatus", "o_orderpriority")
    return rollups.public_entities(entities, seen, "o_orderstatus", "o_orderpriority")


_PAIRS = """
WITH pairs AS (
  SELECT DISTINCT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, reason FROM (
    SELECT l_partkey, l_suppkey, 'name' AS reason FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT l_suppkey, l_partkey, 'phone' FROM lineitem WHERE l_returnflag = 'A') WHERE l_partkey <> l_suppkey),
one AS (SELECT a, b, list_sort(list(reason)) AS reasons, 'candidate_' || substr(sha256(a::VARCHAR || ':' || b::VARCHAR), 1, 20) AS candidate_id FROM pairs GROUP BY a, b)"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    names = lines.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.lit("name").alias("reason"))
    phones = lines.where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.lit("phone").alias("reason"))
    rejected = lines.where("l_returnflag = 'N'").select(resolution.candidate_id(F.col("l_partkey"), F.col("l_suppkey")).alias("candidate_id"))
    merged = read_table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("party"), (F.col("p_partkey") % 5).alias("person_id"))
    return resolution.review_candidates([names, phones], rejected, merged)


_REVIEW = _PAIRS + """
SELECT a, b, {} AS reasons, candidate_id FROM one
LEFT JOIN (SELECT p_partkey, p_partkey % 5 AS person FROM part WHERE p_size > 25) pa ON pa.p_partkey = a
LEFT JOIN (SELECT p_partkey, p_partkey % 5 AS person FROM part WHERE p_size > 25) pb ON pb.p_partkey = b
WHERE (pa.person IS NULL OR pb.person IS NULL OR pa.person <> pb.person) AND candidate_id NOT IN (
  SELECT 'candidate_' || substr(sha256(least(l_partkey, l_suppkey)::VARCHAR || ':' || greatest(l_partkey, l_suppkey)::VARCHAR), 1, 20) FROM lineitem WHERE l_returnflag = 'N')"""


@query(_REVIEW.format("array_to_string(reasons, ' | ')"))
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review candidates, with their reasons in one field."""
    return resolution.review_rows(_candidates(spark, sf_dir), ["reasons"])


@query(_PAIRS + """
SELECT candidate_id, CASE WHEN candidate_id = 'candidate_0' THEN 'invalid' WHEN decision = 'reject' THEN 'rejected' WHEN len(reasons) > 1 THEN 'conflict' ELSE 'merge' END AS outcome
FROM (SELECT candidate_id, reasons, CASE WHEN a % 3 = 0 THEN 'reject' ELSE 'accept' END AS decision FROM one UNION ALL SELECT 'candidate_0', [], 'accept')""")
def manual_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on every pair proposed, and one on a candidate that doesn't exist."""
    none = read_table(spark, sf_dir, "part").limit(0)
    lines = read_table(spark, sf_dir, "lineitem")
    names = lines.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.lit("name").alias("reason"))
    phones = lines.where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), F.lit("phone").alias("reason"))
    pairs = resolution.review_candidates(
        [names, phones], none.select(F.lit("").alias("candidate_id")), none.select(F.col("p_partkey").alias("party"), F.col("p_partkey").alias("person_id"))
    ).withColumn("conflict", F.size("reasons") > 1)
    made = pairs.select("candidate_id", F.when(F.col("a") % 3 == 0, "reject").otherwise("accept").alias("decision"))
    forged = spark.range(1).select(F.lit("candidate_0").alias("candidate_id"), F.lit("accept").alias("decision"))
    return resolution.decided(pairs, made.unionByName(forged)).select("candidate_id", "outcome")


@query("SELECT event_id, user_id FROM events WHERE value < 50 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 997 = 0)")
def without_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "value")
    return sets.without_rejected(events.where("value < 50"), events.where("event_id % 997 = 0"), "user_id").select("event_id", "user_id")


@query("""
SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n FROM events WHERE value >= 50 GROUP BY ALL)
UNION ALL SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n FROM events WHERE value < 50 GROUP BY ALL) o
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.value >= 50 AND e.user_id = o.user_id AND e.event_type = o.event_type)""")
def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    old, new = (events.where(c).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")) for c in ("value < 50", "value >= 50"))
    return incremental.upserted(old, new, ["user_id", "event_type"])


@query("""
SELECT l_orderkey, l_linenumber, count(*) OVER w > 1 AND min(l_linenumber) OVER w <> max(l_linenumber) OVER w AND max(l_tax * 12) OVER w - min(l_tax * 12) OVER w < 0.03
  AND (max(l_tax * 12) OVER w <= 0.08 OR min(l_tax * 12) OVER w >= 0.92) AS is_furniture
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey, l_discount, l_quantity)""")
def page_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat_ws("/", F.col("l_discount").cast("string"), F.col("l_quantity").cast("string"))
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", value.alias("value"), (F.col("l_tax") * 12).alias("y"))
    return sets.furniture(rows, "l_suppkey", "value", "l_linenumber", "y").select("l_orderkey", "l_linenumber", "is_furniture")


# Release


@query("""
SELECT doc_id, CASE WHEN quality = 1 AND doc_id % 100 / 100 >= 0.9 AND (toxic IS NULL OR toxic = 0) AND (doc_id % 7 = 0 OR doc_id % 11 / 10 >= 0.85) THEN 'released' ELSE 'withheld' END AS status FROM labels""")
def release_rule_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    flags = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(none)
    scanned = F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 11 / 10)
    return read_table(spark, sf_dir, "labels").select("doc_id", gate.release_rule_v1(F.col("quality") == 1, F.col("doc_id") % 100 / 100, flags, none, scanned).alias("status"))


@query("""
SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'canonical' WHEN o_orderpriority LIKE '2%' THEN 'semantic' ELSE 'privacy' END AS stage,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'withheld' ELSE 'completed' END AS status FROM orders)
WHERE (stage <> 'privacy' AND status = 'failed') OR (stage = 'privacy' AND status = 'withheld')""")
def retryable_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    stage = F.when(first == "1", "canonical").when(first == "2", "semantic").otherwise("privacy")
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P", "withheld").otherwise("completed")
    return incremental.retryable(read_table(spark, sf_dir, "orders"), stage, status).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def success_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "json_completed").otherwise("failed")
    return rollups.successful(read_table(spark, sf_dir, "orders").withColumn("status", status)).select("o_orderkey")


@query("""
SELECT count(*) FILTER (o_orderstatus = 'F') AS released, count(*) FILTER (o_orderstatus = 'P') AS review, count(*) FILTER (o_orderstatus = 'O') AS withheld, count(*) AS documents FROM orders""")
def package_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "validated_candidate").when(F.col("o_orderstatus") == "P", "review_required").when(F.col("o_orderstatus") == "O", "withheld")
    return rollups.package_counts(read_table(spark, sf_dir, "orders").select(status.alias("status")), "status")


@query("""
SELECT event_type, applications, workers, round(applications * mean / 3600 / workers, 6) AS projected_hours FROM (
  SELECT event_type, mean, applications, unnest([1, 2, 3, 4]) AS workers FROM (
    SELECT event_type, mean, unnest(list_distinct([100, 500, 1000, n])) AS applications FROM (SELECT event_type, avg(value) AS mean, count(value) AS n FROM events GROUP BY event_type)))""")
def application_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.wall_hours(read_table(spark, sf_dir, "events", "event_type", "value"), "event_type", "value")


@query("""
SELECT coalesce(a.metric, b.metric) AS metric, "first", "second" FROM (SELECT event_type AS metric, count(*) AS "first" FROM events WHERE value < 50 GROUP BY ALL) a
FULL JOIN (SELECT event_type AS metric, count(*) AS "second" FROM events WHERE value >= 50 GROUP BY ALL) b USING (metric)""")
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_type", "value")
    runs = [events.where(c).groupBy(F.col("event_type").alias("metric")).agg(F.count(F.lit(1)).alias("n")) for c in ("value < 50", "value >= 50")]
    return rollups.compared(*runs, "metric", "n")


# Ground truth, audit and fuzzy evidence


@query("""
WITH done AS (SELECT DISTINCT o_custkey, lower(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'F')
SELECT count(*) AS expected_identifier_count, count(v) AS hits, count(v) / count(*) AS seeded_identifier_recall
FROM orders o LEFT JOIN done ON done.o_custkey = o.o_custkey AND v = lower(o.o_orderpriority)""")
def seeded_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' priorities as identifiers that must be redacted; those of finished orders of the customer are."""
    orders = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority", "o_orderstatus").withColumnRenamed("o_custkey", "application_id")
    expected = orders.select("application_id", F.upper("o_orderpriority").alias("value"))
    return rollups.seeded_recall(expected, orders.where("o_orderstatus = 'F'").withColumnRenamed("o_orderpriority", "value"))


@query(f"""
WITH d AS (SELECT doc_id, text, unnest({_spans_sql("text", _EMAIL, "email")}) AS s FROM documents WHERE contains(text, '@'))
SELECT doc_id, 'email' AS finding_type, s.start AS "start", (s.start + length(s.text))::INT AS "end",
  replace(substr(text, greatest(s.start - 80, 0)::BIGINT + 1, (s.start + length(s.text) + 80 - greatest(s.start - 80, 0))::BIGINT), chr(10), ' ') AS context,
  lower(s.text) = lower(regexp_extract(text, '{_EMAIL}')) AS matches_structured_extraction FROM d""")
def audit_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail addresses left in documents; each document's first one stands for what was extracted from it."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), F.col("text").alias("redacted"))
    scanned = docs.withColumn("findings", S.detect(F.col("redacted"), ["email"]))
    first = scanned.where(F.size("findings") > 0).select("document_id", F.upper(F.get(F.col("findings"), F.lit(0))["text"]).alias("value"))
    return gate.audit(scanned, structured=first).withColumnRenamed("document_id", "doc_id")


@query()
def fuzzy_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with similar names (a capitalised word and the word after it) that come from the same source, which stands for a shared site."""
    docs = documents(spark, sf_dir)
    found = F.explode(F.regexp_extract_all("text", F.lit(r"(?U)\b\p{Lu}\w+[ \t]+\w+"), F.lit(0)))
    names = docs.select("doc_id", found.alias("name")).select("doc_id", F.lit("person_name").alias("identifier_type"), C.word_key(F.col("name")).alias("normalized_value"))
    sources = read_table(spark, sf_dir, "documents", "doc_id", "source").where("source IS NOT NULL")
    sites = sources.select("doc_id", F.lit("website").alias("identifier_type"), F.col("source").alias("normalized_value"))
    return resolution.fuzzy_evidence(names.unionByName(sites), "doc_id")
