"""Lines, detections on lines, phrases near boxes and the grounding of model detections, against plain loops."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from veilspark.operators import lines
from veilspark.plans.linkage_queries import QUERIES

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def words_of(spark, rows):
    return spark.createDataFrame(rows, f"document_id string, page int, block int, line int, number int, text string, box {BOX}")


def union(boxes):
    return tuple(f(b[i] for b in boxes) for i, f in enumerate((min, min, max, max)))


def compact(text):
    return re.sub(r"[^a-z0-9]", "", text.lower())


def plain_phrase(value, page_words, box, most):
    groups = {}
    for w in page_words:
        groups.setdefault((w[2], w[3]), []).append(w)
    groups = [sorted(g, key=lambda w: w[4]) for _, g in sorted(groups.items())]
    x0, y0, x1, y1 = box[0] - 8, box[1] - 5, box[2] + 8, box[3] + 5

    def meets(r):
        return r[0] < x1 and x0 < r[2] and r[1] < y1 and y0 < r[3]

    best, n = (None, None, 0.0), max(1, len(value.split()))
    for g in [g for g in groups if meets(union([w[6] for w in g]))] or groups:
        for size in range(max(1, n - 3), min(len(g), most, n + 4) + 1):
            for start in range(len(g) - size + 1):
                some = g[start : start + size]
                text = " ".join(w[5] for w in some)
                score = difflib.SequenceMatcher(None, compact(value), compact(text)).ratio()
                if score > best[2]:
                    best = (text, union([w[6] for w in some]), score)
    return best


@pytest.fixture(scope="module")
def page():
    rng = random.Random(11)
    rows = []
    for doc in ("a", "b"):
        for p in range(2):
            for line in range(12):
                x = 0.0
                for k in range(rng.randint(1, 9)):
                    text = rng.choice(["Ann", "Lee", "ann@x.org", "Main", "12", "St.", "of", "Bo", "Leeds", "Anna"])
                    rows.append((doc, p, line // 8, line, k, text, (x, line * 12.0, x + 6.0 * len(text), line * 12.0 + 10)))
                    x += 6.0 * len(text) + 6
    random.Random(1).shuffle(rows)
    return rows


def test_phrases_are_the_best_of_all_windows(spark, page):
    rng = random.Random(3)
    wanted = []
    for i in range(60):
        y = rng.choice([0.0, 30.0, 70.0, 5000.0])
        value = rng.choice(["Ann Lee", "Anna Leeds of", "12 Main St", "bo", "zzz", "Ann  Lee of Leeds 12"])
        wanted.append((i, rng.choice("ab"), rng.randint(0, 1), value, (0.0, y, rng.choice([30.0, 90.0]), y + rng.choice([3.0, 20.0])), rng.choice([2, 8, 14])))
    wanted += [(90, "a", 0, " ", (0.0, 0.0, 9.0, 9.0), 8), (91, "c", 0, "Ann", (0.0, 0.0, 9.0, 9.0), 8)]
    df = spark.createDataFrame(wanted, f"wanted_id int, document_id string, page int, value string, box {BOX}, max_words int")
    table = lines.lines(words_of(spark, page))
    for least in (0.0, 0.8):
        got = {r.wanted_id: (r.phrase, tuple(r.box), r.score) for r in lines.phrases(df, table, least).collect()}
        want = {i: plain_phrase(v, [w for w in page if w[:2] == (d, p)], b, m) for i, d, p, v, b, m in wanted if v.strip() and d != "c"}
        assert got == {i: w for i, w in want.items() if w[2] > 0 and w[2] >= least}


def test_detections_have_the_box_of_their_words(spark):
    rows, x = [], 0.0
    for k, text in enumerate(["call", "(555)", "123-4567,", "or", "ann@www.x.org", "see", "www.y.org/a", "0000-0001-2345-6789"]):
        rows.append(("d", 0, 0, 3, k, text, (x, 36.0, x + len(text), 46.0)))
        x += len(text) + 1
    got = {(r.identifier_type, r.text): tuple(r.box) for r in lines.detections(lines.lines(words_of(spark, rows)), 2.0, 40.0, 100.0).collect()}
    phone = next(b for (k, t), b in got.items() if k == "phone_number" and "123-4567" in t)
    assert phone == (3.0, 34.0, 22.0, 48.0)
    assert got["email", "ann@www.x.org"] == (22.0, 34.0, 39.0, 48.0)
    assert ("website", "www.y.org/a") in got and not any(k == "website" and "x.org" in t for k, t in got)
    assert all(b[2] <= 40.0 for b in got.values())


def test_every_detection_ends_one_way(spark):
    words = [("d", 0, 0, i, k, t, (10.0 * k, 12.0 * i, 10.0 * k + 9, 12.0 * i + 10)) for i, line in enumerate(["Dr. Ann Lee", "ann@x.org", "the committee office", "12 Main Street Town"]) for k, t in enumerate(line.split())]
    near = lambda i: (0.0, 12.0 * i, 40.0, 12.0 * i + 10)
    rows = [
        (1, 0, "person_name", "Ann Lee", near(0)), (2, 0, "email", "ann@x.org", near(1)), (3, 0, "person_name", "the committee", near(2)),
        (4, 0, "postal_address", "12 Main Street", near(3)), (5, 0, "postal_address", "the committee office", near(2)), (6, 0, "phone_number", "ann@x.org", near(1)),
        (7, 0, "person_name", "Quentin Zzyzx", near(0)), (8, 0, "person_name", "Ann Lee", None), (9, 0, "person_name", "Ann Lee", (0.0, 0.0, 100.0, 90.0)),
        (10, 0, "signature", None, near(2)), (11, 0, "person_name", " ", near(0)), (12, 1, "person_name", "Bo Smith", near(0)), (13, 1, "email", None, near(0)),
    ]
    found = spark.createDataFrame([(i, "d", p, k, v, b) for i, p, k, v, b in rows], f"wanted_id int, document_id string, page int, identifier_type string, value string, box {BOX}")
    pages = spark.createDataFrame([("d", 0, 100.0, 100.0), ("d", 1, 100.0, 100.0)], "document_id string, page int, width double, height double")
    got = {r.wanted_id: (r.reason, r.text) for r in lines.grounded(found, lines.lines(words_of(spark, words)), pages, 1.0).collect()}
    assert got == {
        1: (None, "Ann Lee"), 2: (None, "ann@x.org"), 3: ("failed_person_name_shape", None), 4: (None, "12 Main Street"), 5: ("failed_address_shape", None),
        6: ("identifier_shape_not_verified", None), 7: ("model_value_not_grounded", None), 8: ("invalid_bounding_box", None), 9: ("bounding_box_too_large", None),
        10: (None, "[signature]"), 11: ("missing_model_text", None), 12: (None, "Bo Smith"), 13: ("missing_model_text", None),
    }


def test_no_words_no_lines(spark):
    none = words_of(spark, [])
    assert lines.lines(none).count() == 0 and lines.detections(lines.lines(none), 1.0, 9.0, 9.0).count() == 0
    docs = spark.createDataFrame([("d", ""), ("e", None), ("f", "one\n\n two  three")], "document_id string, text string")
    got = lines.lines(lines.word_table(docs)).select("document_id", "line", "text", F.col("box.x1").alias("x1")).collect()
    assert sorted(map(tuple, got)) == [("f", 0, "one", 18.0), ("f", 2, "two three", 66.0)]


def test_lines_of_texts_need_no_shuffle_of_words(spark):
    texts = [("a", "Ann  Lee\n\n \t\nann@x.org, été \U0001f600 x"), ("b", ""), ("c", None), ("d", "\n".join(f" w{i}  v" for i in range(130))), ("e", "one\r\ntwo ")]
    docs = spark.createDataFrame(texts, "document_id string, text string")
    got, want = lines.printed(docs), lines.lines(lines.word_table(docs))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = QUERIES["line_detections"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "line#" not in "".join(re.findall(r"Exchange hashpartitioning.*", plan))


def test_few_runs_are_compared_and_none_better_is_missed(monkeypatch):
    rng, calls, ratio = random.Random(5), [], difflib.SequenceMatcher

    def counted(*args):
        calls.append(1)
        return ratio(*args)

    for trial in range(60):
        parts = ["".join(rng.choice("abe1") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(2, 30))]
        a = "" if trial == 0 else "".join(parts[3:7]).replace("e", "c")
        least, low, high = rng.choice([0.0, 0.76]), rng.randint(1, 2), min(8, len(parts))
        scored = [(ratio(None, a, "".join(parts[i : i + n])).ratio(), -n, -i) for n in range(low, high + 1) for i in range(len(parts) - n + 1)]
        best = max((s for s in scored if s[0] >= least and s[0] > 0), default=None)
        monkeypatch.setattr(lines, "AT_ONCE", rng.choice([3, 4096]))
        assert lines._most_similar(a, parts, low, high, least) == (best and (best[0], -best[1], -best[2]))
    monkeypatch.setattr(lines.difflib, "SequenceMatcher", counted)
    words = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    assert lines._most_similar("".join(words[50:54]).replace("e", "c"), words, 1, 8, 0.76)[1:] == (4, 50)
    assert len(calls) < 20
