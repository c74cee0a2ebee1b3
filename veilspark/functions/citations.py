"""Blocks of several citations taken apart, as column expressions with offsets into the block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspark.functions.first_generation import AUTHOR
from veilspark.functions.scalars import single_spaced
from veilspark.functions.spans import let, running

# Fixed values.
FOLLOWS = r"(?=[,;]|\s+(?:19|20)\d{2}|\s*[“\"])"
MARK = r"[“\"]|\b(?:19|20)\d{2}\b"
HEADING = r"(?i)\b(?:TEACHING EXPERIENCE|AWARDS|REFERENCES|PRESENTATIONS)\b"
SHAPE = r"(?i)[“\"]|\b(?:publication|presented|journal|thesis|dissertation|abstract|doi|isbn)\b"
OPENING = r"(?i)^\s*(?:thesis|dissertation)"
LEAST_WORDS = 4

LEADING_AUTHOR = rf"(?={AUTHOR}{FOLLOWS})"


def broken(block: Column) -> Column:
    """A block cut before each author that has a quote or a year since the author before.

    An author without one belongs to the same citation, so whether to cut is told by the part just
    before alone. Blocks hold no underscore, which marks the cuts.
    """

    def marked(parts: Column) -> Column:
        return F.transform(parts, lambda p, k: F.when((k > 0) & F.get(parts, k - 1).rlike(MARK), F.concat(F.lit("_"), p)).otherwise(p))

    return F.split(F.array_join(let(F.split(block, LEADING_AUTHOR, -1), marked), ""), "_", -1)


def scholarly_pieces(value: Column) -> Column:
    """array<struct<start, end, text>>: the citations of a block; start and end are of the block, in code points.

    What comes before the first author goes, unless the block is one thesis; what comes after a heading
    goes; a piece needs a sign of scholarly work and four words. Null gives null, no piece an empty array.
    """
    flat = F.translate(value, "_", " ")

    def of_block(text: Column) -> Column:
        authors = F.regexp_count(text, F.lit(AUTHOR + FOLLOWS))
        before = F.length(F.get(F.split(text, LEADING_AUTHOR, 2), F.lit(0)))
        leads = text.rlike("^" + AUTHOR + FOLLOWS)
        kept_whole = (authors == 0) | leads | ((authors == 1) & text.rlike(OPENING))
        return let(F.when(kept_whole, 0).otherwise(before), lambda at: pieces_from(text, at, authors))

    def pieces_from(text: Column, at: Column, authors: Column) -> Column:
        body = F.substring(text, at + 1, F.length(text))
        return let(F.when(authors > 1, broken(body)).otherwise(F.array(body)), lambda all_: placed(all_, at))

    def placed(all_: Column, at: Column) -> Column:
        ends = running(F.transform(all_, lambda p: F.length(p)), lambda a, b: a + b)
        return let(ends, lambda e: F.transform(all_, lambda p, k: piece(p, at + F.get(e, k) - F.length(p))))

    def piece(raw: Column, start: Column) -> Column:
        def stripped(cut: Column) -> Column:
            open_ = F.regexp_replace(cut, r"(?U)^[\s,.;]+", "")
            bare = F.regexp_replace(open_, r"(?U)[\s,.;]+$", "")
            first = start + F.length(cut) - F.length(open_)
            return F.struct(first.alias("start"), (first + F.length(bare)).alias("end"), single_spaced(bare).alias("text"))

        return let(F.get(F.split(raw, HEADING, 2), F.lit(0)), stripped)

    def scholarly(p: Column) -> Column:
        return p["text"].rlike(SHAPE) & (F.size(F.split(p["text"], " ")) >= LEAST_WORDS)

    return F.when(value.isNotNull(), F.filter(let(flat, of_block), scholarly))
