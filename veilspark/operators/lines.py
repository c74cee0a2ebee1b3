"""Pages as tables of words: lines, detectors on lines, and the phrase near a box that a value stands for."""

from __future__ import annotations

import difflib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions import geometry
from veilspark.functions import spans as S
from veilspark.functions.scalars import compact_text
from veilspark.plans.frames import cut, small_side

LINE = ["document_id", "page", "block", "line"]
#: How far from a line a box may be, and how many words a phrase may differ by from the value.
NEAR_X, NEAR_Y, FEWER, MORE = 8.0, 5.0, 3, 4
#: Height of the bands by which lines and boxes meet.
BAND = 64.0


def word_table(docs: DataFrame, page_lines: int = 60) -> DataFrame:
    """Words of plain texts (document_id, text) as if printed: a line each 12 points, a character each 6."""
    each = docs.select("document_id", F.posexplode(F.split("text", "\n")).alias("at", "whole"))
    words = each.select("document_id", "at", F.posexplode(S.matches(F.col("whole"), r"\S+")).alias("number", "w"))
    y0 = (F.col("at") % page_lines) * 12.0
    return words.select(
        "document_id", F.floor(F.col("at") / page_lines).cast("int").alias("page"), F.lit(0).alias("block"), F.col("at").alias("line"), "number",
        F.col("w.text").alias("text"), geometry.box(F.col("w.start") * 6.0, y0, F.col("w.end") * 6.0, y0 + 10.0).alias("box"),
    )


def lines(words: DataFrame) -> DataFrame:
    """A row per line (document_id, page, block, line): its words in order, each with its place in `text`, and its box."""
    grouped = words.groupBy(*LINE).agg(F.array_sort(F.collect_list(F.struct("number", "text", "box"))).alias("w"))  # one line of a page

    def placed(ends: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            end = F.get(ends, i) - 1
            return F.struct((end - F.length(w["text"])).alias("start"), end.alias("end"), w["text"].alias("text"), w["box"].alias("box"))

        return F.transform("w", word)

    ends = S.running(F.transform("w", lambda w: F.length(w["text"]) + 1), lambda a, b: a + b)
    text = F.array_join(F.transform("w", lambda w: w["text"]), " ").alias("text")
    return grouped.select(*LINE, text, S.let(ends, placed).alias("words"), around(F.transform("w", lambda w: w["box"])).alias("box"))


def _filled(docs: DataFrame) -> DataFrame:
    """Lines with a word (document_id, at, whole) of plain texts (document_id, text), a row a text: only texts are dealt out, by document."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = docs.select("document_id", "text").repartition(tasks, "document_id").select("document_id", F.posexplode(F.split("text", "\n")).alias("at", "whole"))
    return each.where(F.col("whole").rlike(r"\S"))


def printed_texts(docs: DataFrame, page_lines: int = 60) -> DataFrame:
    """printed(docs) with `texts`, what its words are, for the words with their places and boxes, which cost many times as much."""
    y0 = (F.col("at") % page_lines) * 12.0
    space = F.lit(" \t\x0b\f\r")  # what \s matches, but for the end of a line
    x0, x1 = F.length("whole") - F.length(F.ltrim("whole", space)), F.length(F.rtrim("whole", space))
    return _filled(docs).select(
        "document_id", F.floor(F.col("at") / page_lines).cast("int").alias("page"), F.lit(0).alias("block"), F.col("at").alias("line"),
        F.regexp_extract_all("whole", F.lit(r"\S+"), F.lit(0)).alias("texts"), geometry.box(x0 * 6.0, y0, x1 * 6.0, y0 + 10.0).alias("box"),
    )


def printed(docs: DataFrame, page_lines: int = 60) -> DataFrame:
    """lines(word_table(docs)) of plain texts (document_id, text), a row a text: only texts are dealt out, never words or their boxes."""
    each = _filled(docs)
    found = each.select("document_id", "at", S.matches(F.col("whole"), r"\S+").alias("w"))
    y0 = (F.col("at") % page_lines) * 12.0

    def placed(ends: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            end = F.get(ends, i) - 1
            seen = geometry.box(w["start"] * 6.0, y0, w["end"] * 6.0, y0 + 10.0)
            return F.struct((end - F.length(w["text"])).alias("start"), end.alias("end"), w["text"].alias("text"), seen.alias("box"))

        return F.transform("w", word)

    ends = S.running(F.transform("w", lambda w: F.length(w["text"]) + 1), lambda a, b: a + b)
    text = F.array_join(F.transform("w", lambda w: w["text"]), " ").alias("text")
    whole = geometry.box(F.element_at("w", 1)["start"] * 6.0, y0, F.element_at("w", -1)["end"] * 6.0, y0 + 10.0)
    page = F.floor(F.col("at") / page_lines).cast("int").alias("page")
    return found.select("document_id", page, F.lit(0).alias("block"), F.col("at").alias("line"), text, S.let(ends, placed).alias("words"), whole.alias("box"))


def around(boxes: Column) -> Column:
    """The box around all boxes of a list that isn't empty."""
    return F.aggregate(boxes, F.get(boxes, F.lit(0)), lambda a, b: geometry.union(a, b))


def clipped(box: Column, margin: float, width: Column, height: Column) -> Column:
    """A box with a margin, within its page."""
    wide = geometry.expand(box, margin)
    zero = F.lit(0.0)
    return geometry.box(F.greatest(zero, wide.x0), F.greatest(zero, wide.y0), F.least(width, wide.x1), F.least(height, wide.y1))


def detections(lines_: DataFrame, margin: float, width: float, height: float, kinds: list[str] | None = None) -> DataFrame:
    """A row for each detector's match in a line, with the box around the words that it touches.

    Sites inside a mail address or a unique identifier are part of it and no detections.
    """
    found = lines_.withColumn("spans", S.detect(F.col("text"), kinds))
    owners = F.filter("spans", lambda s: s["kind"].isin("email", "unique_identifier"))
    inside = lambda s: F.exists(owners, lambda o: (s["start"] >= o["start"]) & (s["end"] <= o["end"]))
    each = found.select(*LINE, "words", F.explode(F.filter("spans", lambda s: ~((s["kind"] == "website") & inside(s)))).alias("s"))
    touched = F.filter("words", lambda w: (w["start"] < F.col("s.end")) & (w["end"] > F.col("s.start")))
    box = around(F.transform(touched, lambda w: w["box"]))
    return each.select(
        *LINE, F.col("s.kind").alias("identifier_type"), F.col("s.text").alias("text"), F.col("s.start").alias("start"),
        clipped(box, margin, F.lit(width), F.lit(height)).alias("box"),
    )


def _bands(box: Column) -> Column:
    return F.sequence(F.floor(box.y0 / BAND), F.floor(box.y1 / BAND))


#: Characters of compact texts; at how many words runs begin that are counted at once; words held at once, but for a longer line.
LETTERS, AT_ONCE, MOST_AT_ONCE = b"0123456789abcdefghijklmnopqrstuvwxyz", 8192, 1 << 18
_CODE = np.full(256, 255, dtype=np.uint8)
_CODE[list(LETTERS)] = np.arange(len(LETTERS))
_CODE[list(LETTERS.upper())] = np.arange(len(LETTERS))
#: The two other characters whose lower case holds a letter: their last byte, those before it, the letter.
_ODD = [(0xB0, b"\xc4", b"i"), (0xAA, b"\xe2\x84", b"k")]


def _compact(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """compact_text of many texts (UTF-8 bytes, and where each begins and ends) as numbers of LETTERS, and where each begins and ends in them."""
    code = _CODE[data]
    for last, before, letter in _ODD:
        at = np.flatnonzero(data == last)
        at = at[at >= len(before)]
        for k, byte in enumerate(before):
            at = at[data[at - len(before) + k] == byte]
        code[at] = LETTERS.index(letter)
    kept = np.flatnonzero(code < 255)
    return code[kept], np.searchsorted(kept, ends)


def _letters(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row for each place between compact words: how often each letter stands before it."""
    word = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    counts = np.bincount(word * len(LETTERS) + codes, minlength=(len(ends) - 1) * len(LETTERS)).reshape(-1, len(LETTERS))
    before = np.zeros((len(ends), len(LETTERS)), dtype=np.int32)
    np.cumsum(counts, axis=0, out=before[1:])
    return before


def _ratio(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    """SequenceMatcher's ratio of texts with `common` matching characters of `total`."""
    return np.where(total == 0, 1.0, 2.0 * common / np.maximum(total, 1))


def _best_runs(values: list[str], codes: np.ndarray, ends: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, least: float) -> list[tuple[float, int, int] | None]:
    """For each compact value (score, size, start) of the run of low to high compact words of its line most similar to it, then the shortest, then the first.

    codes, ends: the words of all lines and their ends, from 0; first: where each value's line begins among them, and the end.
    The length of a run, then letters in common, wherever they stand, bound its ratio from above. Runs are taken from the
    likeliest size on, of a size from the highest bound down, and compared only where the bound allows for a better one.
    """
    text = np.frombuffer(LETTERS, dtype=np.uint8)[codes].tobytes().decode()
    length = np.array([len(v) for v in values], dtype=np.int64)
    data = np.frombuffer("".join(values).encode(), dtype=np.uint8)
    wanted = np.diff(_letters(_CODE[data], np.concatenate([[0], length.cumsum()])), axis=0)
    row = np.repeat(np.arange(len(values)), np.diff(first))
    likely = np.minimum(low + FEWER, high)
    best: list[tuple[float, int, int] | None] = [None] * len(values)
    floor = np.full(len(values), float(least))
    for at in range(0, len(row), AT_ONCE):
        owner = row[at : at + AT_ONCE]
        mine = slice(owner[0], owner[-1] + 1)
        here = ends[at : at + AT_ONCE + max(int(high[mine].max()), 0)]
        before = _letters(codes[here[0] : here[-1]], here - here[0])
        last, value_length = first[owner + 1] - at, length[owner]
        usual, fewest, most = likely[owner], low[owner], high[owner]
        for more in sorted(range(int((low - likely)[mine].min()), int((high - likely)[mine].max()) + 1), key=abs):
            size = usual + more
            start = np.flatnonzero((size >= fewest) & (size <= most) & (np.arange(len(owner)) + size <= last))
            end, lengths = start + size[start], value_length[start]
            run = here[end] - here[start]
            able = _ratio(np.minimum(run, lengths), run + lengths) >= np.maximum(floor[owner[start]], 1e-9)
            start, end, total = start[able], end[able], (run + lengths)[able]
            common = np.minimum(before[end] - before[start], wanted[owner[start]]).sum(axis=1)
            bound = _ratio(common, total)
            able = np.flatnonzero(bound >= np.maximum(floor[owner[start]], 1e-9))
            order = able[np.lexsort((start[able], -bound[able], owner[start[able]]))]
            start, end = start[order], end[order]
            for k, s, e, b in zip(owner[start].tolist(), (start + at).tolist(), (end + at).tolist(), bound[order].tolist(), strict=True):
                known, place = best[k], (s - e, int(first[k]) - s)
                if known and (b, *place) < known:
                    continue
                score = difflib.SequenceMatcher(None, values[k], text[ends[s] : ends[e]]).ratio()
                if score >= least and score > 0 and (known is None or (score, *place) > known):
                    best[k], floor[k] = (score, *place), score
    return [b and (b[0], -b[1], -b[2]) for b in best]


def _most_similar(a: str, parts: list[str], low: int, high: int, least: float) -> tuple[float, int, int] | None:
    """_best_runs of one compact value and one line of compact words."""
    codes, ends = _compact(np.frombuffer("".join(parts).encode(), dtype=np.uint8), np.cumsum([0, *map(len, parts)]))
    return _best_runs([a], codes, ends, np.array([0, len(parts)]), np.array([low]), np.array([high]), least)[0]


@F.arrow_udf(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("size", T.IntegerType()), T.StructField("start", T.IntegerType())]))
def most_similar(value: pa.Array, texts: pa.Array, low: pa.Array, high: pa.Array, least: pa.Array) -> pa.Array:
    """_best_runs of compact values and the words of a line each; null where there is no line or no size is allowed."""
    asked = np.flatnonzero((low.fill_null(1).to_numpy() <= high.fill_null(0).to_numpy()) & texts.is_valid().to_numpy(zero_copy_only=False))
    found: list[tuple[float, int, int] | None] = [None] * len(value)
    held = texts.value_lengths().fill_null(0).to_numpy().cumsum() // MOST_AT_ONCE
    for some in np.split(asked, np.flatnonzero(np.diff(held[asked])) + 1) if len(asked) else []:
        at = pa.array(some)
        rows = texts.take(at)
        words = rows.flatten().cast(pa.large_string()).fill_null("")
        _, places, data = words.buffers()
        ends = np.frombuffer(places, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        codes, ends = _compact(np.frombuffer(data or b"", dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0])
        first = np.concatenate([[0], rows.value_lengths().to_numpy().cumsum()]).astype(np.int64)
        numbers = [x.take(at).to_numpy().astype(np.int64) for x in (low, high)]
        for k, best in zip(some.tolist(), _best_runs(value.take(at).to_pylist(), codes, ends, first, *numbers, least[0].as_py()), strict=True):
            found[k] = best
    columns = [pa.array([b and b[i] for b in found], t) for i, t in enumerate((pa.float64(), pa.int32(), pa.int32()))]
    return pa.StructArray.from_arrays(columns, ["score", "size", "start"])


def phrases(wanted: DataFrame, lines_: DataFrame, least: float = 0.0) -> DataFrame:
    """The run of words of a line most similar to each wanted value, if its similarity is at least `least` and above 0.

    wanted: (wanted_id, document_id, page, value, box, max_words); lines_: of lines(), or of printed_texts(), whose words have
    no boxes, nor then have phrases. Lines near the box are looked at; where none is near, all of the page. A run has FEWER
    words less to MORE words more than the value. Ties go to the first line, then to fewer words, then to the first place.
    Lines and boxes meet by page and band, never all with all, without a shuffle where both are dealt out by document alike.
    Of a line's runs only those are compared whose letters allow for a better one than was found. What is best near the
    boxes is written as a table, and lines are read again only if some box has none near.
    """
    near = geometry.box(F.col("box.x0") - NEAR_X, F.col("box.y0") - NEAR_Y, F.col("box.x1") + NEAR_X, F.col("box.y1") + NEAR_Y)
    # Without a document there is no line. Lines get the same filter from the join, so what both are made from is read once.
    wanted = wanted.where("trim(value) <> '' AND document_id IS NOT NULL").withColumn("near", near)
    texts = F.col("texts") if "texts" in lines_.columns else F.transform("words", lambda w: w["text"])
    boxes = F.transform("words", lambda w: w["box"]) if "words" in lines_.columns else F.lit(None).cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")
    slim = lines_.select(*LINE, F.col("box").alias("line_box"), texts.alias("texts"), boxes.alias("boxes"))
    banded = slim.withColumn("band", F.explode(_bands(F.col("line_box"))))
    w, b = wanted.withColumn("band", F.explode_outer(_bands(F.col("near")))).alias("w"), banded.alias("b")
    # What shares several bands counts in the first of them.
    first = F.greatest(F.floor(F.col("line_box.y0") / BAND), F.floor(F.col("near.y0") / BAND))
    same = [F.col(f"w.{c}") == F.col(f"b.{c}") for c in ("document_id", "page", "band")]
    by_band = geometry.intersects(F.col("line_box"), F.col("near")) & (F.col("w.band") == first)
    columns = ["wanted_id", "value", "max_words", "block", "line", "texts", "boxes"]
    # What is dealt out by document is so by page and band too; Spark would else shuffle all words once more.
    conf, key = lines_.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    found = conf.get(key)
    conf.set(key, "false")
    try:
        best = cut(_best(w.join(b, [*same, by_band], "left").select(*columns), least))
    finally:
        conf.set(key, found)
    alone = best.where("NOT met").select(F.col("wanted_id").alias("id"))
    if not alone.isEmpty():
        rest = small_side(cut(wanted.join(alone, F.col("wanted_id").eqNullSafe(F.col("id")), "left_semi")))
        best = best.where("met").unionByName(_best(rest.join(slim, ["document_id", "page"]).select(*columns), least))
    return best.where("best IS NOT NULL").select("wanted_id", "best.phrase", "best.box", F.col("best.rank.score").alias("score"), (-F.col("best.rank.line")).alias("line"))


def _best(both: DataFrame, least: float) -> DataFrame:
    """For each wanted_id whether it has a line (met), and the best of its runs of words or null."""
    count = F.size(F.filter(F.split(F.trim("value"), r"\s+"), lambda t: t != ""))
    low = F.greatest(F.lit(1), count - FEWER)
    high = F.least(F.size("texts"), F.col("max_words"), count + MORE)
    each = both.withColumn("run", most_similar(compact_text(F.col("value")), "texts", low, high, F.lit(float(least))))
    place = [F.col("run.start") + 1, F.col("run.size")]
    phrase = F.array_join(F.slice("texts", *place), " ")
    rank = F.struct("run.score", *[(-F.col(c)).alias(c.rpartition(".")[2]) for c in ("block", "line", "run.size", "run.start")])
    one = F.struct(rank.alias("rank"), phrase.alias("phrase"), around(F.slice("boxes", *place)).alias("box"))
    # Lines go no further than here: a row is one run of words.
    scored = each.select("wanted_id", F.col("line").isNotNull().alias("met"), F.when(F.col("run.score").isNotNull(), one).alias("one"))
    return scored.groupBy("wanted_id").agg(F.max("met").alias("met"), F.max("one").alias("best"))


# Least similarities by kind, the largest share of a page a box may cover, words that name no person.
LEAST = {"postal_address": 0.68}
LEAST_ELSE, MOST_WORDS, MOST_WORDS_ADDRESS, LARGEST_SHARE = 0.76, 8, 14, 0.25
NOT_PEOPLE = ["university", "college", "department", "school", "committee", "hospital", "institute", "laboratory", "corporation", "company", "foundation"]
TITLES = r"(?i)^(?:dear|dr|professor|prof|mr|mrs|ms)\.?\s+"
STREETS = r"(?:street|st\.?|road|rd\.?|avenue|ave\.?|boulevard|blvd\.?|drive|dr\.?|lane|ln\.?|way|court|ct\.?)"
PLACES = [rf"(?i)\b(?:\d{{1,6}}\s+\S+|P\.?O\.?\s+Box\s+\d+).*{STREETS}\b", r"(?i)\b[A-Z]{2}\s+\d{5}(?:-\d{4})?\b"]


def is_person_shaped(value: Column) -> Column:
    """Two to seven words, at least two of them capitalised, none of an institution; a title in front doesn't count."""
    bare = F.trim(F.regexp_replace(value, TITLES, ""), F.lit(" ,:"))
    words = F.filter(F.split(bare, r"\s+"), lambda w: w != "")
    capital = F.filter(words, lambda w: w.rlike(r"^[A-Z][A-Za-z'’-]*[.,]?$"))
    institution = F.exists(F.array(*map(F.lit, NOT_PEOPLE)), lambda w: F.contains(F.lower(bare), w))
    # A single capital is both a capitalised word and an initial, and counts twice.
    initials = F.filter(words, lambda w: w.rlike(r"^[A-Z]\.?$"))
    return F.size(words).between(2, 7) & ~institution & (F.size(capital) + F.size(initials) >= 2)


def grounded(found: DataFrame, lines_: DataFrame, pages: DataFrame, margin: float) -> DataFrame:
    """Every model detection with `reason` null and what was found for it, or the one reason it is discarded for.

    found: (wanted_id, document_id, page, identifier_type, value, box: points, null if invalid); pages: (document_id,
    page, width, height). Signatures stand as boxes; on pages without words the value itself stands. Else the value must be
    like a phrase near its box, which must have the form of its kind; a shaped kind gives the exact match.
    """
    kind = F.col("identifier_type")
    area = geometry.area(F.col("box")) / (F.col("width") * F.col("height"))
    read = lines_.select("document_id", "page").distinct().withColumn("has_words", F.lit(True))
    each = found.join(pages, ["document_id", "page"]).join(read, ["document_id", "page"], "left")
    words = F.when(kind == "postal_address", MOST_WORDS_ADDRESS).otherwise(MOST_WORDS)
    asked = each.where((kind != "signature") & F.col("box").isNotNull() & (area <= LARGEST_SHARE) & F.col("has_words"))
    near = phrases(asked.select("wanted_id", "document_id", "page", "value", "box", words.alias("max_words")), lines_, min(LEAST_ELSE, *LEAST.values()))
    each = each.join(near.select("wanted_id", "phrase", F.col("box").alias("phrase_box"), "score"), "wanted_id", "left")
    patterns = {k: p for k, p in S.PATTERNS if k in ("email", "phone_number", "website", "unique_identifier")}
    exact = F.col("phrase")
    for k, p in patterns.items():
        match = F.rtrim(F.regexp_extract("phrase", p, 0), F.lit(".,;:)"))
        exact = F.when(kind == k, F.when(match != "", match)).otherwise(exact)
    least = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in LEAST.items() for x in pair]), kind), F.lit(LEAST_ELSE))
    address = F.exists(F.array(*map(F.lit, PLACES)), lambda p: F.regexp_like(exact, p))
    reasons = [
        (F.col("box").isNull(), "invalid_bounding_box"), (area > LARGEST_SHARE, "bounding_box_too_large"), (kind == "signature", None),
        (F.coalesce(F.trim("value"), F.lit("")) == "", "missing_model_text"), (F.col("has_words").isNull(), None),
        (F.coalesce(F.col("score"), F.lit(0.0)) < least, "model_value_not_grounded"), (exact.isNull(), "identifier_shape_not_verified"),
        ((kind == "person_name") & ~is_person_shaped(exact), "failed_person_name_shape"), ((kind == "postal_address") & ~address, "failed_address_shape"),
    ]
    reason = F.lit(None).cast("string")
    for holds, name in reversed(reasons):
        reason = F.when(F.coalesce(holds, F.lit(False)), F.lit(name)).otherwise(reason)
    by_phrase = F.col("has_words").isNotNull() & (kind != "signature")
    kept = F.when(kind == "signature", "[signature]").when(by_phrase, exact).otherwise(F.col("value"))
    confidence = F.when(kind == "signature", 0.75).when(by_phrase, F.col("score")).otherwise(0.6)
    out = each.withColumn("reason", reason).withColumn("_box", F.when(by_phrase, F.col("phrase_box")).otherwise(F.col("box")))
    accepted = F.col("reason").isNull()
    return out.select(
        "wanted_id", "document_id", "page", "identifier_type", "reason", F.when(accepted, kept).alias("text"),
        F.when(accepted, clipped(F.col("_box"), margin, F.col("width"), F.col("height"))).alias("box"), F.when(accepted, confidence).alias("match_confidence"),
        (accepted & by_phrase).alias("value_verified"),
    )
