"""Three packages from one graph: who sees which columns, and all of them or none."""

import pytest
from pyspark.sql import functions as F

from veilspark.operators import packages
from veilspark.sources import writers

SECRET = "Ann Lee"


@pytest.fixture(scope="module")
def graph(spark):
    def table(columns, **special):
        row = spark.range(2).select("id", *[F.concat(F.lit(f"{c}_"), F.col("id").cast("string")).alias(c) for c in columns if c not in special])
        return row.select("*", *[v.alias(k) for k, v in special.items()], F.lit(SECRET).alias("display_name")).drop("id")

    edges = ["relationship_id", "relationship_type", "subject_person_id", "object_person_id", "application_id", "document_id", "confidence", "review_status", "evidence"]
    made = {n: table(c) for n, c in packages.PUBLIC.items() if n != "people"}
    made["people"] = table(packages.PUBLIC["people"], roles=F.array(F.lit("applicant"), F.lit("coauthor")))
    made["redactions"] = table(packages.REDACTIONS, text=F.lit("=1+1"))
    made |= {"parties": table(["local_person_id"]), "relationships": table(edges), "review_queue": table(["candidate_id"]), "automatic_matches": table(["method"]).limit(0)}
    return made


@pytest.fixture
def leaks(spark):
    return spark.createDataFrame([], "file string")


def read(spark, path):
    return spark.read.csv(path, header=True, escape='"')


def test_each_audience_has_its_columns(spark, graph, leaks, tmp_path):
    out = str(tmp_path / "out")
    writers.emit(packages.audiences(graph), leaks, out)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["researcher", "researcher_p4", "restricted"]
    for package in ("researcher", "researcher_p4"):
        for name, columns in packages.PUBLIC.items():
            found = read(spark, f"{out}/{package}/{name}")
            assert found.columns == columns and found.count() == 2
        assert "evidence" not in read(spark, f"{out}/{package}/relationships").columns
        assert not any(SECRET in p.read_text() for p in (tmp_path / "out" / package).rglob("part-*.csv"))
        assert {r.roles for r in read(spark, f"{out}/{package}/people").collect()} == {"applicant|coauthor"}
    assert {r.display_name for r in read(spark, f"{out}/restricted/people").collect()} == {SECRET}
    assert {r.text for r in read(spark, f"{out}/researcher_p4/redactions").collect()} == {"'=1+1"}
    assert not (tmp_path / "out" / "researcher" / "redactions").exists()
    counts = {r.table: int(r.rows) for r in read(spark, f"{out}/restricted/counts").collect()}
    assert counts == {"parties": 2, "people": 2, "relationships": 2, "review_queue": 2, "automatic_matches": 0}
    for package in ("restricted", "researcher", "researcher_p4"):
        listed, now = spark.read.json(f"{out}/{package}/manifest"), writers.manifest(spark, f"{out}/{package}")
        assert writers.changed_files(listed, now.where("file NOT LIKE 'manifest/%'")).count() == 0


def test_a_failure_in_the_third_package_leaves_none(spark, graph, leaks, tmp_path):
    out = str(tmp_path / "out")
    broken = packages.audiences(graph)
    good = {**broken["researcher_p4"]}
    broken["researcher_p4"] = {**good, "redactions": good["redactions"].withColumn("text", F.raise_error(F.lit("lost")).cast("string"))}
    with pytest.raises(Exception, match="lost"):
        writers.emit(broken, leaks, out)
    assert list(tmp_path.iterdir()) == []
    writers.emit(packages.audiences(graph), leaks, out)
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    with pytest.raises(Exception, match="lost"):
        writers.emit(broken, leaks, out)
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before
    with pytest.raises(ValueError, match="leaks"):
        writers.emit(broken, spark.createDataFrame([("f",)], "file string"), out)
    writers.emit({"researcher": broken["researcher"]}, leaks, out)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["researcher"]


def test_a_graph_without_a_table_is_an_error(graph):
    with pytest.raises(ValueError, match="lacks people"):
        packages.audiences({n: t for n, t in graph.items() if n != "people"})
