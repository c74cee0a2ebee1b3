"""Stored answers of a model about CVs: read strictly, grounded in their documents, as tables of fields, items, sections and mentions.

An answer is read one level at a time, each as a map of strings, so what is wrong in one place hides nothing
elsewhere. Every breach of the contract is a fault with its path. An answer with a fault is not used, and none is
lost: its row has rows either in `sections` or in `faults`. What belongs to a document stays in its row while
its text is needed, without a shuffle; the tables made from it carry no text.

Defined cases: no answer is the fault `answer:missing`, one without a JSON object `answer:unreadable`; a null text
is an empty one, in which nothing is grounded; a key left out is a null; a nested value counts as its JSON text; of several answers
for a document each is parsed; of a key that an object repeats, the first counts; keys beyond the contract are faults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import scalars as C
from veilspark.functions import spans as S

# What an answer holds, which of it is taken from a vocabulary, and what is protected as (type, role).
FIELDS = {
    "education": ["institution", "degree_type", "field", "start_year", "end_year", "graduation_year"],
    "employment": ["organization", "original_title", "job_category", "position_type", "start_date", "end_date"],
    "publications": ["title", "doi", "publication_type", "year", "venue"],
}
RESEARCH = ["research_fields", "research_methods"]
DERIVED = ["job_category", "position_type", "publication_type"]
PROTECTED = {
    "institution": ("organization", "institution"), "organization": ("organization", "institution"), "original_title": ("work_title", "unknown"),
    "title": ("work_title", "unknown"), "doi": ("unique_identifier", "unknown"), "venue": ("organization", "institution"), "author": ("person_name", "coauthor"),
}
MENTION_KINDS = [
    "person_name", "organization", "work_title", "email", "phone_number", "postal_address",
    "website", "unique_identifier", "signature", "date",
]
MENTION_ROLES = [
    "applicant", "recommender", "reference", "coauthor", "recipient", "advisor", "committee_member", "third_party", "institution", "unknown",
]

MAP, MAPS = "map<string,string>", "array<map<string,string>>"
PAGES = "array<struct<page:int,document_start:int,document_end:int>>"


def _faults(path: Column, found: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, F.concat(path, F.lit(f":{reason}"))) for reason, bad in found.items()]))


def _all(rows: Column) -> Column:
    return F.flatten(F.transform(rows, lambda r: r["faults"]))


def _beyond(m: Column, keys: Column) -> Column:
    return F.size(F.array_except(F.map_keys(m), keys)) > 0


def _unread(m: Column, key: str, kind: str) -> Column:
    return m[key].isNotNull() & m[key].try_cast(kind).isNull()


def _confidence(m: Column) -> dict[str, Column]:
    number = m["model_confidence"].try_cast("double")
    return {"confidence": F.coalesce(~number.between(0.0, 1.0), F.lit(False)) | _unread(m, "model_confidence", "double")}


def _stated(m: Column, statuses: list[str]) -> dict[str, Column]:
    """A known status, and a confidence just where the model did not fail."""
    known, failed = m["status"].isin(statuses), m["status"] == "model_failed"
    stray = known & (failed == m["model_confidence"].isNotNull())
    return {"status": ~F.coalesce(known, F.lit(False)), "confidence_and_status": F.coalesce(stray, F.lit(False)), **_confidence(m)}


def _offsets(m: Column) -> dict[str, Column]:
    return {"offsets": _unread(m, "start", "int") | _unread(m, "end", "int")}


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _field(raw: Column, path: Column, name: Column, author: Column | None = None) -> Column:
    """A field as struct(name, author_position, is_applicant, value, status, model_confidence, start, end, faults)."""
    position = F.lit(None) if author is None else author["author_position"].try_cast("int")
    applicant = F.lit(None) if author is None else author["is_applicant"].try_cast("boolean")

    def read(m: Column) -> Column:
        found = {
            "missing": m.isNull(), **{k: m.isNotNull() & c for k, c in _stated(m, C.STATUSES).items()}, **_offsets(m),
            "value": (m["status"] == "found") & m["value"].isNull(), "keys": _beyond(m, _strings(["value", "status", "model_confidence", "start", "end"])),
        }
        if author is not None:
            found |= {
                "author_position": _unread(author, "author_position", "int") | (position < 1), "is_applicant": _unread(author, "is_applicant", "boolean"),
                "author_keys": _beyond(author, _strings(["name", "author_position", "is_applicant"])),
            }
        return F.struct(
            name.alias("name"), position.cast("int").alias("author_position"), applicant.cast("boolean").alias("is_applicant"),
            m["value"].alias("value"), m["status"].alias("status"), m["model_confidence"].try_cast("double").alias("model_confidence"),
            m["start"].try_cast("int").alias("start"), m["end"].try_cast("int").alias("end"), _faults(path, found).alias("faults"),
        )

    return S.let(F.from_json(raw, MAP), read)


def _list(raw: Column, path: Column, each) -> Column:  # noqa: ANN001
    """struct(rows, faults) of a JSON list of objects, absent ones empty; each(object, its path) makes a struct with faults."""

    def made(values: Column) -> Column:
        bad = (raw.isNotNull() & values.isNull()) | F.coalesce(F.exists(values, lambda v: v.isNull()), F.lit(False))
        objects = F.filter(F.coalesce(values, F.array().cast(MAPS)), lambda v: v.isNotNull())
        rows = F.transform(objects, lambda v, i: each(v, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return S.let(rows, lambda r: F.struct(r.alias("rows"), F.concat(_faults(path, {"unreadable": bad}), _all(r)).alias("faults")))

    return S.let(F.from_json(raw, MAPS), made)


def _item(names: Column, keys: Column):  # noqa: ANN202
    def read(m: Column, path: Column) -> Column:
        fields = F.transform(names, lambda n: _field(m[n], F.concat(path, F.lit("."), n), n))
        people = _list(m["authors"], F.concat(path, F.lit(".authors")), lambda a, p: _field(a["name"], p, F.lit("author"), a))
        faults = _faults(path, {**_confidence(m), "confidence_missing": m["model_confidence"].isNull(), **_offsets(m), "keys": _beyond(m, keys)})

        def whole(f: Column, authors: Column) -> Column:
            return F.struct(
                m["model_confidence"].try_cast("double").alias("model_confidence"), m["start"].try_cast("int").alias("start"), m["end"].try_cast("int").alias("end"),
                F.concat(f, authors["rows"]).alias("fields"), F.concat(faults, _all(f), authors["faults"]).alias("faults"),
            )

        return S.let(fields, lambda f: S.let(people, lambda authors: whole(f, authors)))

    return read


def _section(raw: Column, section: Column) -> Column:
    path = F.concat(F.lit("sections."), section)
    names = F.element_at(F.create_map(*[x for s, ns in FIELDS.items() for x in (F.lit(s), _strings(ns))]), section)
    authors = F.when(section == "publications", _strings(["authors"])).otherwise(F.array())
    keys = F.concat(names, _strings(["model_confidence", "start", "end"]), authors)

    def read(m: Column) -> Column:
        found = {"missing": m.isNull(), **{k: m.isNotNull() & c for k, c in _stated(m, C.STATUSES[:-1]).items()}}
        faults = _faults(path, {**found, "keys": _beyond(m, _strings(["status", "model_confidence", "not_found_reason", "items"]))})
        return S.let(
            _list(m["items"], F.concat(path, F.lit(".items")), _item(names, keys)),
            lambda items: F.struct(
                section.alias("section"), m["status"].alias("status"), m["model_confidence"].try_cast("double").alias("model_confidence"),
                m["not_found_reason"].alias("not_found_reason"), items["rows"].alias("items"), F.concat(faults, items["faults"]).alias("faults"),
            ),
        )

    return S.let(F.from_json(raw, MAP), read)


def _mention(m: Column, path: Column) -> Column:
    found = {
        **_confidence(m), "confidence_missing": m["model_confidence"].isNull(), "text": m["text"].isNull() | m["identifier_type"].isNull(),
        "offsets": m["start"].try_cast("int").isNull() | m["end"].try_cast("int").isNull(),
        "keys": _beyond(m, _strings(["identifier_type", "person_role", "text", "start", "end", "model_confidence"])),
    }
    return F.struct(
        m["identifier_type"].alias("kind"), F.coalesce(m["person_role"], F.lit("unknown")).alias("role"), m["text"].alias("text"),
        m["start"].try_cast("int").alias("start"), m["end"].try_cast("int").alias("end"), m["model_confidence"].try_cast("double").alias("model_confidence"),
        _faults(path, found).alias("faults"),
    )


def read(answers: DataFrame, response: str = "response") -> DataFrame:
    """answers with `sections`, `research_fields`, `research_methods` and `proposals` as the contract types them, and `faults`."""
    top = answers.withColumn("_top", C.model_json(F.col(response), MAP))
    top = top.withColumn("_parts", F.from_json(F.col("_top")["sections"], MAP))
    for name in RESEARCH:
        top = top.withColumn(f"_{name}", _list(F.col("_top")[name], F.lit(name), lambda m, p, n=name: _field(F.to_json(m), p, F.lit(n))))
    top = top.withColumn("_mentions", _list(F.col("_top")["mentions"], F.lit("mentions"), _mention))
    top = top.withColumn("sections", F.transform(_strings(list(FIELDS)), lambda s: _section(F.col("_parts")[s], s)))
    keys = _faults(F.lit("answer"), {"keys": _beyond(F.col("_top"), _strings(["sections", *RESEARCH, "mentions"])), "section_keys": _beyond(F.col("_parts"), _strings(list(FIELDS)))})
    inside = F.concat(keys, _all(F.col("sections")), *[F.col(f"{c}.faults") for c in ("_research_fields", "_research_methods", "_mentions")])
    faults = (
        F.when(F.col(response).isNull(), F.array(F.lit("answer:missing")))
        .when(F.col("_top").isNull(), F.array(F.lit("answer:unreadable")))
        .when(F.col("_parts").isNull(), F.array(F.lit("sections:missing")))
        .otherwise(inside)
    )
    return top.select(*answers.columns, "sections", *[F.col(f"_{n}.rows").alias(n) for n in RESEARCH], F.col("_mentions.rows").alias("proposals"), faults.alias("faults"))


def _each(rows: DataFrame, items: str | Column, name: str, place: str | None = None) -> DataFrame:
    """A row for each item; none for null. An outer explode brings no filter, which would be computed from the text a second time."""
    made = F.explode_outer(items).alias(name) if place is None else F.posexplode_outer(items).alias(place, name)
    return rows.select("*", made).where(F.col(name).isNotNull())


def faults(answered: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, path, reason) of every fault."""
    each = _each(answered.select(key, "faults"), "faults", "_fault")
    return each.select(key, F.regexp_extract("_fault", r"^(.*):", 1).alias("path"), F.regexp_extract("_fault", r":([^:]*)$", 1).alias("reason"))


def replayed(docs: DataFrame, answers: DataFrame, key: str = "document_id", response: str = "response") -> DataFrame:
    """Every document with what was read of its saved answer (key, response); where none was saved, that is its fault."""
    return read(docs.join(answers.select(key, response), key, "left"), response).drop(response)


def _at(text: Column, pages: Column, value: Column, start: Column, end: Column, lower: Column, upper: Column) -> Column:
    """struct(start, end, page, flags): where a value stands, else null places with the reason.

    Offsets that hold the value in any case count, else its only occurrence within the bounds (in the whole text
    where they don't fit it).
    """
    size = F.length(text)

    def fits(a: Column, b: Column) -> Column:
        return F.coalesce((a >= 0) & (a < b) & (b <= size), F.lit(False))

    direct = fits(start, end) & (F.lower(F.substring(text, start + 1, end - start)) == F.lower(value))
    base = F.when(fits(lower, upper), lower).otherwise(0)
    part = F.when(fits(lower, upper), F.substring(text, lower + 1, upper - lower)).otherwise(text)
    recovered = F.when(fits(lower, upper), "offset_recovered_by_bounded_exact_match").otherwise("offset_recovered_by_unique_exact_match")

    def outcome(a: Column | None, b: Column | None, flag: Column | None) -> Column:
        none = F.lit(None)
        flags = F.array(flag) if flag is not None else F.array().cast("array<string>")
        return F.struct((none if a is None else a).cast("int").alias("start"), (none if b is None else b).cast("int").alias("end"), flags.alias("flags"))

    pattern = F.concat(F.lit("(?iu)"), S.escaped(value))
    # What a split in three leaves before, between and after: two parts are one occurrence.
    lone = S.let(F.split(part, pattern, 3), lambda p: F.when(F.size(p) == 2, base + F.length(p[0])))
    found = S.let(lone, lambda a: F.when(a.isNull(), outcome(None, None, F.lit("ungrounded_value"))).otherwise(outcome(a, a + F.length(value), recovered)))
    search = F.when(value == "", outcome(None, None, F.lit("missing_evidence"))).otherwise(found)

    def paged(at: Column) -> Column:
        def ended(page: Column) -> Column:
            lost = at["start"].isNotNull() & page.isNull()
            return F.struct(
                F.when(~lost, at["start"]).alias("start"), F.when(~lost, at["end"]).alias("end"), page["page"].alias("page"),
                F.when(lost, F.array(F.lit("evidence_crosses_page_boundary"))).otherwise(at["flags"]).alias("flags"),
            )

        return S.let(S.page_of(pages, at["start"], at["end"]), ended)

    return S.let(F.when(direct, outcome(start, end, None)).otherwise(search), paged)


def _grounded(text: Column, pages: Column, f: Column, lower: Column, upper: Column) -> Column:
    derived = f["name"].isin(DERIVED)
    wanted = ~derived & (f["status"] == "found") & f["value"].isNotNull()
    flags = F.when(derived, F.array(F.lit("controlled_or_derived_value"))).otherwise(F.array().cast("array<string>"))
    none = F.struct(*[F.lit(None).cast("int").alias(c) for c in ("start", "end", "page")], flags.alias("flags"))

    def held(at: Column) -> Column:
        status = F.when(wanted & at["start"].isNull(), "uncertain").otherwise(f["status"])
        kept = [f[c].alias(c) for c in ("name", "author_position", "is_applicant", "value")]
        return F.struct(*kept, status.alias("status"), f["model_confidence"].alias("model_confidence"), *[at[c].alias(c) for c in ("start", "end", "page", "flags")])

    return S.let(F.when(wanted, _at(text, pages, f["value"], f["start"], f["end"], lower, upper)).otherwise(none), held)


def parse(answered: DataFrame, key: str = "document_id", text: str = "text", pages: str | None = None) -> DataFrame:
    """(key, sections, research_fields, research_methods, mentions, faults) of answers read, with their document's text; nulls where there are faults.

    Sections carry ids of their items, grounded fields and flags for what the headings of the text promise and the
    answer lacks. `pages` names a column of (page, document_start, document_end); without it a text is page 1.
    Whoever makes several tables of it cuts it first (`plans.frames.cut`), so that texts are read once.
    """
    good, kept = answered.withColumn("_text", F.coalesce(F.col(text), F.lit(""))), F.size("faults") == 0
    one = F.array(F.struct(F.lit(1).alias("page"), F.lit(0).alias("document_start"), F.length("_text").alias("document_end")))
    good = good.withColumn("_pages", (F.col(pages) if pages else one).cast(PAGES)).withColumn("_seen", S.sections(F.col("_text")))
    body, sheets = F.col("_text"), F.col("_pages")
    none = F.lit(None).cast("int")
    good = good.withColumn("_loose", F.transform(F.concat(*RESEARCH), lambda f: _grounded(body, sheets, f, none, none)))

    def loose(name: str) -> Column:
        return F.filter("_loose", lambda f: f["name"] == name)

    def item(section: Column, m: Column, i: Column) -> Column:
        id_ = F.concat(F.col(key).cast("string"), F.lit(":"), i.cast("string"), F.lit(":"), F.coalesce(m["start"].cast("string"), F.lit("None")))
        prefix = F.when(section == "publications", "publication").otherwise(section)
        valid = F.coalesce((m["start"] >= 0) & (m["start"] < m["end"]) & (m["end"] <= F.length(body)), F.lit(False))

        def placed(page: Column) -> Column:
            return F.struct(
                C.stable_id(prefix, id_).alias("item_id"), i.alias("item"), m["model_confidence"].alias("model_confidence"),
                F.when(page.isNotNull(), m["start"]).alias("start"), F.when(page.isNotNull(), m["end"]).alias("end"), page["page"].alias("page"),
                F.transform(m["fields"], lambda f: _grounded(body, sheets, f, m["start"], m["end"])).alias("fields"),
            )

        return S.let(F.when(valid, S.page_of(sheets, m["start"], m["end"])), placed)

    def section(s: Column) -> Column:
        seen = F.get(F.filter("_seen", lambda x: x["section"] == s["section"]), F.lit(0))
        count = F.size(s["items"])
        flags = F.array_compact(F.array(
            F.when(seen["heading_found"] & (count == 0), "detected_heading_without_extracted_items"),
            F.when(count < seen["candidate_entry_count"], "candidate_entry_coverage_gap"),
        ))
        return F.struct(
            *[s[c].alias(c) for c in ("section", "status", "model_confidence", "not_found_reason")],
            F.transform(s["items"], lambda m, i: item(s["section"], m, i)).alias("items"), flags.alias("validation_flags"),
        )

    def spans(m: Column) -> Column:
        """The places of a proposal: its own, else every exact occurrence; those that cross a page go."""
        here = _at(body, sheets, m["text"], m["start"], m["end"], none, none)
        every = F.when(m["text"] != "", S.exact_positions(body, m["text"])).otherwise(F.array().cast(S.SPAN))
        pairs = F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        sure = S.let(here, lambda at: F.when(at["start"].isNotNull(), F.array(F.struct(at["start"].alias("start"), at["end"].alias("end")))).otherwise(pairs))
        on_page = F.filter(sure, lambda s: S.page_of(sheets, s["start"], s["end"]).isNotNull())
        role = F.when(m["role"].isin(MENTION_ROLES), m["role"]).otherwise("unknown")
        return F.transform(on_page, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), m["kind"].alias("kind"), role.alias("role"), m["text"].alias("text"),
            m["model_confidence"].alias("model_confidence"), F.lit("model").alias("detector"),
        ))

    known = F.filter("proposals", lambda m: m["kind"].isin(MENTION_KINDS))
    found = F.filter(S.detect(body), lambda s: S.page_of(sheets, s["start"], s["end"]).isNotNull())
    patterns = F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit("unknown").alias("role"), s["text"].alias("text"),
        F.lit(None).cast("double").alias("model_confidence"), F.lit("regex").alias("detector"),
    ))
    return good.select(
        key, F.when(kept, F.transform("sections", section)).alias("sections"),
        *[F.when(kept, loose(n)).alias(n) for n in RESEARCH],
        F.when(kept, F.concat(F.flatten(F.transform(known, spans)), patterns)).alias("mentions"), "faults",
    )


def sections(parsed: DataFrame, key: str = "document_id") -> DataFrame:
    """One row a section: (key, section, status, model_confidence, not_found_reason, validation_flags, items), items counted."""
    each = _each(parsed.select(key, "sections"), "sections", "s")
    plain = [F.col(f"s.{c}").alias(c) for c in ("section", "status", "model_confidence", "not_found_reason", "validation_flags")]
    return each.select(key, *plain, F.size("s.items").alias("items"))


def fields(parsed: DataFrame, key: str = "document_id") -> DataFrame:
    """One row a field, those of research interests without an item: (key, section, item, item_id, place, name, value, status, ...)."""

    def group(section: Column, item: Column, id_: Column, held: Column) -> Column:
        return F.struct(section.alias("section"), item.cast("int").alias("item"), id_.cast("string").alias("item_id"), held.alias("fields"))

    of_items = F.flatten(F.transform("sections", lambda s: F.transform(s["items"], lambda i: group(s["section"], i["item"], i["item_id"], i["fields"]))))
    loose = F.array(*[group(F.lit(n), F.lit(None), F.lit(None), F.col(n)) for n in RESEARCH])
    groups = _each(parsed.select(key, F.concat(of_items, loose).alias("_groups")), "_groups", "g")
    each = _each(groups.select(key, "g.section", "g.item", "g.item_id", "g.fields"), "fields", "f", "place")
    return each.select(key, "section", "item", "item_id", "place", "f.*")


def mentions(parsed: DataFrame, key: str = "document_id") -> DataFrame:
    """One row for each place and type: what models and patterns found, the first known role first, and protected fields.

    A place that a field names too is `structured` and keeps its mention's role and text. Rows are combined before the shuffle.
    """
    kinds = F.create_map(*[F.lit(x) for n, (kind, _) in PROTECTED.items() for x in (n, kind)])
    roles = F.create_map(*[F.lit(x) for n, (_, role) in PROTECTED.items() for x in (n, role)])

    def named(f: Column) -> Column:
        applicant = (f["name"] == "author") & F.coalesce(f["is_applicant"], F.lit(False))
        return F.struct(
            f["start"].alias("start"), f["end"].alias("end"), F.element_at(kinds, f["name"]).alias("kind"),
            F.when(applicant, "applicant").otherwise(F.element_at(roles, f["name"])).alias("role"), f["value"].alias("text"),
            f["model_confidence"].alias("model_confidence"), F.lit("structured").alias("detector"),
        )

    held = F.flatten(F.transform("sections", lambda s: F.flatten(F.transform(s["items"], lambda i: i["fields"]))))
    protected = F.transform(F.filter(held, lambda f: f["name"].isin(list(PROTECTED)) & f["start"].isNotNull()), named)
    each = _each(parsed.select(key, F.concat("mentions", protected).alias("_all")), "_all", "m", "_ord").select(key, "_ord", "m.*")
    field = F.col("detector") == "structured"
    best = F.min_by(F.struct("role", "text", "model_confidence", "detector"), F.struct(field, ~field & (F.col("role") == "unknown"), "_ord"))
    one = each.groupBy(key, "start", "end", "kind").agg(best.alias("b"), F.bool_or(field).alias("_named"))
    detector = F.when(F.col("_named"), "structured").otherwise(F.col("b.detector"))
    doc = F.col(key).cast("string")
    id_ = C.stable_id("mention", F.concat_ws(":", doc, F.col("start").cast("string"), F.col("end").cast("string"), "kind"))
    local = C.stable_id("local", F.concat(doc, F.lit(":"), F.col("b.role"), F.lit(":"), C.casefold(F.col("b.text"))))
    return one.select(key, "start", "end", "kind", "b.role", "b.text", "b.model_confidence", detector.alias("detector"), id_.alias("mention_id"), local.alias("local_entity_id"))
