"""Operators on text intervals: half-open, in code points, from 0.

Everything here is a column expression over one row's text, so it runs inside the JVM in one pass,
and partitions need nothing from each other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspark.functions.scalars import stable_id

SPAN = "array<struct<start:int,end:int,kind:string,text:string>>"

# What is detected, and in which order overlapping spans win.
PATTERNS = [
    ("email", r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"),
    ("phone_number", r"(?<!\d)(?:\+?1[ .()-]*)?(?:\d[ .()-]*){10}(?!\d)"),
    ("website", r"(?i)\b(?:https?://|www\.)[^\s,;<>]+|\b[A-Z0-9.-]+\.(?:edu|com|org|net)(?:/[^\s,;<>]*)?"),
    ("unique_identifier", r"(?i)\b(?:orcid\s*[: ]\s*)?\d{4}-\d{4}-\d{4}-\d{3}[\dX]\b"),
    ("unique_identifier", r"(?i)\b(?:doi\s*:\s*)?10\.\d{4,9}/[-._;()/:A-Z0-9]+"),
]
PRIORITY = {
    "email": 100, "unique_identifier": 95, "phone_number": 90, "postal_address": 85, "website": 80, "signature": 75,
    "person_name": 70, "protected_alias": 65, "organization": 60, "work_title": 50, "date": 10,
}
# What a text must hold for a pattern of the same place above to match at all; far cheaper to look for.
HINTS = ["@", r"(?:\d[ .()-]*){10}", r"(?i)://|www\.|\.(?:edu|com|org|net)", r"\d{4}-\d{4}-\d{4}-\d{3}", r"10\.\d{4}"]
#: Running values are built in blocks of this many, since adding to an array copies it.
BLOCK = 64
PLACEHOLDER = r"\[\[[^\]]+\]\]"
HEADINGS = {
    "education": r"education|academic background|degrees?",
    "employment": r"employment|appointments?|professional experience|academic positions?",
    "publications": r"publications?|selected publications?|articles?|research papers?",
    "research": r"research|research interests?|methods?",
}


def let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, add, first: int = 0) -> Column:  # noqa: ANN001
    """For each place of an array of ints, add (sum, greatest: associative) over the values up to it."""
    none = F.struct(F.lit(first).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, v: Column) -> Column:
        return let(add(acc["at"], v), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

    def block(b: Column) -> Column:
        return F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), none, step)

    def joined(blocks: Column) -> Column:
        def base(acc: Column, part: Column) -> Column:
            return F.struct(add(acc["at"], part["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        bases = F.aggregate(blocks, none, base, lambda acc: acc["out"])
        return let(bases, lambda at: F.flatten(F.transform(blocks, lambda part, i: F.transform(part["out"], lambda v: add(F.get(at, i), v)))))

    places = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    return F.when(F.size(values) > 0, let(F.transform(places, block), joined)).otherwise(F.array().cast("array<int>"))


def in_order(spans: Column) -> Column:
    """Different spans by start, end and type; equal ones are neighbours after sorting, so none is compared with all."""

    def first_of_each(sorted_: Column) -> Column:
        return F.filter(sorted_, lambda s, i: (i == 0) | (s != F.get(sorted_, i - 1)))

    return let(spans, lambda all_: F.when(F.size(all_) < 2, all_).otherwise(let(F.array_sort(all_), first_of_each)))


def matches(text: Column, pattern: str | Column, kind: str | Column = "match", hint: str | None = None) -> Column:
    """All matches of a pattern that has no empty ones, left to right.

    The text between matches and the matches themselves give each one's offset as a running length.
    A hint is a cheaper pattern that every text with a match also matches.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    kind = F.lit(kind) if isinstance(kind, str) else kind
    empty = F.array().cast(SPAN)

    def offsets(found: Column) -> Column:
        def placed(between: Column) -> Column:
            sizes = F.transform(found, lambda t, i: F.length(t) + F.length(F.get(between, i)))
            return let(running(sizes, lambda a, b: a + b), spans_at)

        def spans_at(ends: Column) -> Column:
            def span(t: Column, i: Column) -> Column:
                end = F.get(ends, i)
                return F.struct((end - F.length(t)).alias("start"), end.alias("end"), kind.alias("kind"), t.alias("text"))

            return F.transform(found, span)

        return F.when(F.size(found) > 0, let(F.split(text, regex, -1), placed)).otherwise(empty)

    out = let(F.regexp_extract_all(text, regex, F.lit(0)), offsets)
    if hint is None:
        return out
    may = F.contains(text, F.lit(hint)) if hint.isalnum() or len(hint) == 1 else text.rlike(hint)
    return F.when(may, out).when(text.isNotNull(), empty)


def detect(text: Column, kinds: list[str] | None = None) -> Column:
    """Spans of all detectors, overlapping ones included, by start, end and type."""
    each = [matches(text, p, k, hint) for (k, p), hint in zip(PATTERNS, HINTS, strict=True) if kinds is None or k in kinds]
    return in_order(F.concat(*each))


def overlaps(a: Column, b: Column) -> Column:
    return ~((a["end"] <= b["start"]) | (a["start"] >= b["end"]))


def priority(kind: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])
    return F.coalesce(F.element_at(ranks, kind), F.lit(0))


def select_spans(spans: Column, without: tuple[str, ...] = ("date",)) -> Column:
    """Non-overlapping spans by priority, then length, then start; in text order."""
    open_ = F.filter(spans, lambda s: ~s["kind"].isin(*without)) if without else spans

    def order(a: Column, b: Column) -> Column:
        size_a, size_b = a["end"] - a["start"], b["end"] - b["start"]
        return (
            F.when(priority(a["kind"]) != priority(b["kind"]), F.signum(priority(b["kind"]) - priority(a["kind"])).cast("int"))
            .when(size_a != size_b, F.signum(size_b - size_a).cast("int"))
            .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
            .otherwise(F.when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1).otherwise(0))
        )

    def add(taken: Column, span: Column) -> Column:
        return F.when(F.exists(taken, lambda t: overlaps(t, span)), taken).otherwise(F.concat(taken, F.array(span)))

    def greedy(group: Column) -> Column:
        chosen = F.aggregate(F.array_sort(group, order), F.array().cast(SPAN), add)
        return F.when(F.size(group) < 2, group).otherwise(F.array_sort(chosen))

    def grouped(all_: Column) -> Column:
        """Spans by start fall into groups where one begins at or after all ends before it; only within a group do any overlap."""

        def cut_at(reach: Column) -> Column:
            begins = F.filter(F.sequence(F.lit(0), F.size(all_) - 1), lambda i: (i == 0) | (F.get(all_, i)["start"] >= F.get(reach, i - 1)))
            return let(begins, lambda at: F.flatten(F.transform(at, lambda a, k: greedy(F.slice(all_, a + 1, F.coalesce(F.get(at, k + 1), F.size(all_)) - a)))))

        return let(running(F.transform(all_, lambda s: s["end"]), F.greatest), cut_at)

    def chosen_of(all_: Column) -> Column:
        return F.when(F.size(all_) < 2, all_).otherwise(let(F.array_sort(all_), grouped))

    return let(open_, chosen_of)


def substitute(text: Column, spans: Column, replacement) -> Column:  # noqa: ANN001
    """text with each of the disjoint spans, in text order, replaced; replacement: a function of a span.

    The text is taken apart in two steps, for blocks of spans and in a block, since reaching a character walks there from the start.
    """

    def replaced(all_: Column) -> Column:
        def end_before(i: Column) -> Column:
            return F.when(i > 0, F.get(all_, i - 1)["end"]).otherwise(0)

        def block(b: Column) -> Column:
            first = b * BLOCK
            last = F.least(first + BLOCK, F.size(all_)) - 1

            def pieces(at: Column) -> Column:
                part = F.substring(text, at + 1, F.get(all_, last)["end"] - at)

                def piece(part_: Column) -> Column:
                    def one(s: Column, j: Column) -> Column:
                        before = end_before(first + j)
                        return F.concat(F.substring(part_, before - at + 1, s["start"] - before), replacement(s))

                    return F.array_join(F.transform(F.slice(all_, first + 1, F.lit(BLOCK)), one), "")

                return let(part, piece)

            return let(end_before(first), pieces)

        places = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        tail = F.substring(text, F.element_at(all_, -1)["end"] + 1, F.length(text))
        return F.when(F.size(all_) > 0, F.concat(F.array_join(F.transform(places, block), ""), tail)).otherwise(text)

    return let(spans, replaced)


def mask_placeholders(text: Column) -> Column:
    """Placeholders as spaces of the same length, so that offsets stay."""
    return substitute(text, matches(text, PLACEHOLDER), lambda s: F.repeat(F.lit(" "), s["end"] - s["start"]))


def mask_spans(text: Column, spans: Column) -> Column:
    """Characters of the spans as spaces, line ends kept."""
    return substitute(text, select_spans(spans, ()), lambda s: F.regexp_replace(s["text"], r"[^\r\n]", " "))


def escaped(value: Column) -> Column:
    return F.regexp_replace(value, r"([\\.\[\]{}()*+?^$|#&~-])", r"\\$1")


def alias_pattern(alias: Column) -> Column:
    """Complete tokens only, any white space between them, any case."""
    tokens = F.filter(F.split(F.trim(alias), r"(?U)\s+"), lambda t: t != "")
    body = F.array_join(F.transform(tokens, escaped), r"\s+")
    left = F.when(F.element_at(tokens, 1).rlike(r"(?U)^[^\W_]"), r"(?<!\w)").otherwise("")
    right = F.when(F.element_at(tokens, -1).rlike(r"(?U)[^\W_]$"), r"(?!\w)").otherwise("")
    return F.when(F.size(tokens) > 0, F.concat(F.lit("(?iuU)"), left, body, right))


def usable_alias(alias: Column) -> Column:
    return (F.length(F.trim(alias)) >= 3) & ~F.trim(alias).rlike(r"^\d+$")


def alias_occurrences(text: Column, alias: Column, kind: str | Column = "protected_alias") -> Column:
    return matches(text, alias_pattern(alias), kind)


def exact_positions(text: Column, value: Column, lower: Column | None = None, upper: Column | None = None) -> Column:
    """Non-overlapping occurrences in any case within [lower, upper)."""
    found = matches(text, F.concat(F.lit("(?iu)"), escaped(value)), "exact")
    if lower is not None:
        found = F.filter(found, lambda s: s["start"] >= lower)
    return F.filter(found, lambda s: s["end"] <= upper) if upper is not None else found


def ground(text: Column, value: Column, start: Column, end: Column) -> Column:
    """The evidence of a value: its direct offsets if they hold, else its only occurrence; null otherwise."""
    direct = (end > start) & (F.substring(text, start + 1, end - start) == value)
    found = exact_positions(text, value)
    span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit("direct").alias("kind"), value.alias("text"))
    return F.when(direct, span).when(F.size(found) == 1, found[0])


def page_of(pages: Column, start: Column, end: Column) -> Column:
    """The first page (page, document_start, document_end) that holds [start, end)."""
    return F.get(F.filter(pages, lambda p: (p["document_start"] <= start) & (end <= p["document_end"])), F.lit(0))


def repair_placeholder(kind: Column, document_id: Column, start: Column) -> Column:
    id_ = stable_id("doc", F.concat_ws(":", document_id, kind, start.cast("string")))

    def tagged(label: str) -> Column:
        return F.concat(F.lit(f"[[{label}:"), id_, F.lit("]]"))

    return (
        F.when(kind.isin("person_name", "protected_alias"), tagged("PERSON"))
        .when(kind == "organization", tagged("ORG")).when(kind == "work_title", tagged("WORK"))
        .when(kind == "email", "[[EMAIL]]").when(kind == "phone_number", "[[PHONE]]")
        .when(kind == "postal_address", "[[ADDRESS]]").when(kind == "website", "[[URL]]")
        .when(kind == "unique_identifier", "[[IDENTIFIER]]").when(kind == "signature", "[[SIGNATURE]]")
        .when(kind == "date", "[[DATE]]").otherwise("[[REDACTED]]")
    )


def headings(text: Column) -> Column:
    """Section headings, one on a line of its own, by start."""
    each = [matches(text, rf"(?im)^\s*(?:{p})\s*:?[ \t]*$", k) for k, p in HEADINGS.items()]
    return F.array_sort(F.concat(*each))


def sections(text: Column) -> Column:
    """For each heading kind: heading_found and candidate_entry_count of its last section.

    An entry is a line of the body with a year, or one that begins with a bullet or a number.
    """

    def entry(line: Column) -> Column:
        return line.rlike(r"\b(?:19|20)\d{2}\b") | line.rlike(r"^(?:[-*•]|\d+[.)])\s+")

    def counted(found: Column) -> Column:
        def with_count(span: Column, i: Column) -> Column:
            end = F.coalesce(F.get(found, i + 1)["start"], F.length(text))
            body = F.substring(text, span["start"] + 1, end - span["start"])
            lines = F.transform(F.slice(F.split(body, r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]"), 2, 1_000_000_000), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
            count = F.size(F.filter(lines, lambda x: (x != "") & entry(x)))
            return F.struct(span["kind"].alias("kind"), count.alias("n"))

        return F.transform(found, with_count)

    def last(all_: Column, kind: str) -> Column:
        mine = F.filter(all_, lambda s: s["kind"] == kind)
        return F.struct(
            F.lit(kind).alias("section"), (F.size(mine) > 0).alias("heading_found"),
            F.when(F.size(mine) > 0, F.element_at(mine, -1)["n"]).otherwise(0).cast("long").alias("candidate_entry_count"),
        )

    # The counts are taken once, whatever reads them.
    return let(let(headings(text), counted), lambda all_: F.array(*[last(all_, k) for k in HEADINGS]))


def chunks(text: Column, most: int) -> Column:
    """array<struct<offset, text>>: parts of at most `most` characters, cut after the last line end in
    their second half where there is one.

    A window of the text goes along, so that no part is reached from the text's start.
    """
    wide = BLOCK * most
    out = F.array().cast("array<struct<offset:int,text:string>>")
    first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("base"), F.substring(text, F.lit(1), F.lit(wide)).alias("window"), out.alias("out"))

    def walked(total: Column) -> Column:
        def cut_from(acc: Column) -> Column:
            def part_of(whole: Column) -> Column:
                line = F.length(whole) - F.instr(F.reverse(whole), "\n") + 1
                more = acc["at"] + most < total
                cut = F.when(more & (F.instr(whole, "\n") > 0) & (line > most // 2), line).otherwise(F.length(whole))
                return let(cut, lambda n: F.struct((acc["at"] + n).alias("at"), acc["base"].alias("base"), acc["window"].alias("window"), F.concat(
                    acc["out"], F.array(F.struct(acc["at"].alias("offset"), F.substring(whole, F.lit(1), n).alias("text")))).alias("out")))

            return let(F.substring(acc["window"], acc["at"] - acc["base"] + 1, F.lit(most)), part_of)

        def step(acc: Column, _: Column) -> Column:
            again = F.struct(acc["at"].alias("at"), acc["at"].alias("base"), F.substring(text, acc["at"] + 1, F.lit(wide)).alias("window"), acc["out"].alias("out"))
            moved = F.when(acc["at"] + most > acc["base"] + wide, again).otherwise(acc)
            return F.when(acc["at"] < total, let(moved, cut_from)).otherwise(acc)

        rounds = F.sequence(F.lit(1), F.ceil(total / F.lit(most / 2)).cast("int") + 1)
        return F.aggregate(rounds, first, step, lambda acc: acc["out"])

    return let(F.length(text), walked)
