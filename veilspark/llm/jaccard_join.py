"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the hashes (64 bits) of its distinct word n-grams; two link when the Jaccard
similarity of their sets is at least `percent` / 100. Elements are ordered by the number of
documents that have them, rarest first. Documents that link share an element of their prefixes of
n - ceil(t n) + 1 elements, and l elements of prefixes longer by l - 1. A document's l is taken from
the number of candidates its prefix would meet: the more, the longer the prefix and the more shared
elements are needed before sets are compared; of a pair, the smaller l counts.

Rows with the same words are one vertex. Few of an element's documents: they are compared pairwise.
Many: they are compared with one of them, and found links are contracted, so a group of near copies
costs in proportion to its size. Where documents of different components are left, they are compared
in blocks by matrix products, so no row is made for a pair. No candidate is dropped.

Defined cases: texts that are null or without words have an empty set, n_shingles 0, and link with
nothing, not even each other; fewer words than n are one element; a row without an id has no links, a null
component and the size of the same words of a row with one, else 0; rows that repeat an id have each its own
size, and their texts' groups are one; ids are of type long; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.llm import packets
from veilspark.llm.arrow import forget, small_batches
from veilspark.operators.graph import connected_components
from veilspark.plans.frames import cut, read_table

WORDS, PERCENT = 3, 90
SALTS = 16
#: Documents of an element that are compared pairwise; documents of a block, and elements multiplied at once.
FEW, BLOCK, WIDTH = 64, 256, 16_384
#: A longer prefix for each factor of 4 of candidates beyond this number.
CHEAP, LONGEST = 16, 4
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def digest_of(text: str | None) -> str | None:
    """Equal for the same folded words, null without words."""
    words = (text or "").encode().translate(_FOLD).split()
    return hashlib.sha256(b" ".join(words)).hexdigest() if words else None


def same_words(docs: DataFrame) -> DataFrame:
    """(id, digest) of documents (id, text): digests are equal for the same folded words, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            digests += [digest_of(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], ["id", "digest"])

    return small_batches(docs).mapInArrow(run, "id bigint, digest string")


def shingles(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    each = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in (t.encode().translate(_FOLD).split() for t in texts)]
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    out = []
    for numbers_ in each:
        w = words[numbers_]
        k = min(n, len(w))
        h = np.full(max(0, len(w) - k + 1) if k else 0, k, np.uint64)
        for j in range(k):
            h = packets.mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[j : j + len(h)])
        out.append(np.unique(h))
    return out


def set_sizes(docs: DataFrame, n: int) -> DataFrame:
    """(id, n_shingles) of documents (id, text), row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(shingles([text.as_py() or ""], n)[0]) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["id", "n_shingles"])

    return small_batches(docs).mapInArrow(run, "id bigint, n_shingles bigint")


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest size of a set that links with one of n, which is also what they must share."""
    return -(-n * percent // 100)


def _prefixes(ids: list, digests: list, sets: list[np.ndarray], known: packets.Shared, percent: int) -> pa.Table:
    rows = []
    for id_, digest, h in zip(ids, digests, sets, strict=True):
        n = len(h)
        if not n:
            rows.append((id_, digest, 0, 0, None, None))
            continue
        count = known.count(h)
        short = int(n - needed(n, percent) + 1)
        order = np.lexsort((h, count))
        cost = int((count[order[:short]] - 1).sum())
        if not cost:
            rows.append((id_, digest, n, 0, None, None))
            continue
        more = min(LONGEST, 1 + max(0, int(np.log2(cost / CHEAP) // 2) if cost > CHEAP else 0), n - short + 1)
        prefix = order[: short + more - 1]
        prefix = prefix[count[prefix] > 1]
        rows.append((id_, digest, n, more, h[prefix].astype(np.int64), h.astype(np.int64)))
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["id", "digest", "n", "more", "prefix", "elements"])


def sets_of(docs: DataFrame, first: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, digest, n, more, prefix, elements) of documents (id, text) with an id in `first`; prefix and elements
    are null where the prefix meets no other document."""
    size = packets.layout(docs, "text", 6.0)
    base = docs.withColumn("b", packets.batch_of(F.col("id"), size.batches))
    mine = first.select(packets.batch_of(F.col("id"), size.batches).alias("b"), F.col("id").alias("bucket"), F.lit(None).cast("binary").alias("payload"))

    def read(table: pa.Table, right: pa.Table) -> tuple[list, list[str], pa.Table]:
        forget()
        is_id = pa.compute.is_null(right.column("payload"))
        wanted = set(right.filter(is_id).column("bucket").to_pylist())
        chosen = list(dict.fromkeys((i, t) for i, t in packets.texts(table) if i in wanted))
        return [i for i, _ in chosen], [t for _, t in chosen], right.filter(pa.compute.invert(is_id))

    def send(table: pa.Table, right: pa.Table) -> pa.Table:
        sets = shingles(read(table, right)[1], n)
        batch = table.column("b")[0].as_py() if table.num_rows else 0
        return packets.packets(batch, np.concatenate([np.zeros(0, np.uint64), *sets]), size.buckets)

    def receive(table: pa.Table, right: pa.Table) -> pa.Table:
        ids, chosen, answers = read(table, right)
        return _prefixes(ids, list(map(digest_of, chosen)), shingles(chosen, n), packets.Shared(answers, size.buckets), percent)

    grouped = base.groupBy("b")
    sent = grouped.cogroup(mine.groupBy("b")).applyInArrow(send, packets.PACKET)
    answers = packets.shared(sent).unionByName(mine)
    schema = "id bigint, digest string, n bigint, more int, prefix array<bigint>, elements array<bigint>"
    return grouped.cogroup(answers.groupBy("b")).applyInArrow(receive, schema)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (x, y), those whose sets link."""
    left = sets.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("more").alias("mx"), F.col("prefix").alias("px"), F.col("elements").alias("ex"))
    right = sets.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("more").alias("my"), F.col("prefix").alias("py"), F.col("elements").alias("ey"))
    both = pairs.join(left, "x").join(right, "y")
    enough = F.size(F.array_intersect("px", "py")) >= F.least("mx", "my")
    shared = F.size(F.array_intersect("ex", "ey"))
    alike = 100 * shared >= percent * (F.col("nx") + F.col("ny") - shared)
    return both.where(F.when(enough, alike).otherwise(F.lit(False))).select("x", "y")


def _fits(percent: int) -> Column:
    return (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")) & (F.col("x") != F.col("y"))


def links(sets: DataFrame, percent: int = PERCENT, ties: DataFrame | None = None) -> DataFrame:
    """(vertex, component) of all documents with a link; ties: further links (x, y)."""
    known = sets.where("prefix IS NOT NULL")
    postings = known.select("id", "n", F.explode("prefix").alias("element"))
    several = postings.groupBy("element").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    postings = cut(postings.join(several, "element"))
    x = postings.select("element", F.col("id").alias("x"), F.col("n").alias("nx"))
    y = postings.select("element", F.col("id").alias("y"), F.col("n").alias("ny"))
    few = F.col("docs") <= FEW
    pairs = postings.where(few).select("element", F.col("id").alias("x"), F.col("n").alias("nx")).join(y, "element")
    pairs = pairs.where(_fits(percent) & (F.col("x") < F.col("y"))).select("x", "y").distinct()
    found = cut(_verified(pairs, known, percent) if ties is None else _verified(pairs, known, percent).unionByName(ties))
    components = connected_components(found, "x", "y")
    many, _ = _open(postings.where(~few).drop("docs"), components)
    leaders = many.groupBy("element").agg(F.min("id").alias("leader"))
    pairs = many.join(leaders, "element").where("id <> leader").select(F.col("leader").alias("x"), F.col("id").alias("y")).distinct()
    found = found.unionByName(cut(_verified(pairs, known, percent)))
    components = connected_components(found, "x", "y")
    many, left = _open(many.drop("component"), components)
    if not left:
        return components
    found = found.unionByName(cut(_compared_in_blocks(many, known, percent)))
    return connected_components(found, "x", "y")


def _open(postings: DataFrame, components: DataFrame) -> tuple[DataFrame, int]:
    """Postings, with components, of elements whose documents are of several components; and how many there are."""
    labels = components.select(F.col("vertex").alias("id"), "component")
    labelled = cut(postings.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")))
    several = labelled.groupBy("element").agg(F.min("component").alias("a"), F.max("component").alias("z")).where("a <> z")
    left = cut(labelled.join(several, "element", "left_semi"))
    return left, left.count()


def _compared_in_blocks(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among documents that share an open element, without a row for each pair.

    Documents tied by elements are a group. Its largest component need not be compared within itself:
    blocks of the other documents meet blocks of all. A task compares two blocks by one matrix
    product over the elements that both have, and returns links that join components only.
    """
    least = postings.groupBy("element").agg(F.min("id").alias("x"))
    groups = connected_components(postings.join(least, "element").select("x", F.col("id").alias("y")).distinct(), "x", "y")
    docs = postings.select("id", "component").distinct().join(groups.withColumnsRenamed({"vertex": "id", "component": "group"}), "id")
    sizes = docs.groupBy("group", "component").agg(F.count(F.lit(1)).alias("docs"))
    sizes = sizes.groupBy("group").agg(F.max_by("component", F.struct("docs", "component")).alias("largest"), F.sum("docs").alias("docs"), (F.sum("docs") - F.max("docs")).alias("others"))
    docs = docs.join(sizes, "group").join(sets.select("id", "n", "elements"), "id")

    def blocks(column: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(column) / BLOCK)).cast("int")

    own = F.pmod(F.xxhash64("id"), blocks("docs")).cast("int")
    other = F.pmod(F.xxhash64("id", F.lit(1)), blocks("others")).cast("int")
    row = ["group", "id", "component", "n", "elements"]
    all_ = docs.select(*row, own.alias("i"), F.explode(F.sequence(F.lit(0), blocks("others") - 1)).alias("j"), F.lit(False).alias("other"))
    rest = docs.where("component <> largest").select(*row, F.explode(F.sequence(F.lit(0), blocks("docs") - 1)).alias("i"), other.alias("j"), F.lit(True).alias("other"))

    def compare(table: pa.Table) -> pa.Table:
        return _links_of_blocks(table, percent)

    return all_.unionByName(rest).groupBy("group", "i", "j").applyInArrow(compare, "x bigint, y bigint")


def _links_of_blocks(table: pa.Table, percent: int) -> pa.Table:
    ids, n, component = (table.column(c).to_numpy() for c in ("id", "n", "component"))
    lists = table.column("elements").combine_chunks()
    values, counts = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(ids)), counts)
    _, which, often = np.unique(values, return_inverse=True, return_counts=True)
    order = np.argsort(which, kind="stable")
    order = order[often[which[order]] > 1]
    which = np.unique(which[order], return_inverse=True)[1]
    row = row[order]
    other = np.asarray(table.column("other").to_pylist(), bool)
    right, left = np.flatnonzero(other), np.flatnonzero(~other)
    place = np.empty(len(ids), np.int64)
    place[right], place[left] = np.arange(len(right)), np.arange(len(left))
    shared = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(which[-1]) + 1 if len(which) else 0, WIDTH):
        a, z = np.searchsorted(which, [at, at + WIDTH])
        r, w, o = row[a:z], which[a:z] - at, other[row[a:z]]
        dense = [np.zeros((len(side), WIDTH), np.float32) for side in (left, right)]
        dense[0][place[r[~o]], w[~o]] = 1
        dense[1][place[r[o]], w[o]] = 1
        shared += dense[0] @ dense[1].T
    alike = 100 * shared >= percent * (n[left][:, None] + n[right][None, :] - shared)
    x, y = np.nonzero(alike & (component[left][:, None] != component[right][None, :]))
    top: dict[int, int] = {}

    def find(v: int) -> int:
        while top.setdefault(v, v) != v:
            top[v] = v = top[top[v]]
        return v

    kept = []
    for a, b in zip(left[x].tolist(), right[y].tolist(), strict=True):
        p, q = find(int(component[a])), find(int(component[b]))
        if p != q:
            top[p] = q
            kept.append((int(ids[a]), int(ids[b])))
    return pa.table({"x": pa.array([a for a, _ in kept], pa.int64()), "y": pa.array([b for _, b in kept], pa.int64())})


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Each row's id, n_shingles and component_id. Ids are of type long."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Rows without an id link with nothing, so their sets are counted where they are.
    nameless = set_sizes(texts.where("id IS NULL"), n).select("id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    texts = texts.where("id IS NOT NULL")
    keyed = cut(same_words(texts)).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    known = keyed.where("digest IS NOT NULL")
    salted = known.groupBy("digest", "salt").agg(F.min("id").alias("first"))
    least = salted.groupBy("digest").agg(F.min("first").alias("first"))
    spread = cut(salted.select("digest", "salt").join(least, "digest"))
    sets = cut(sets_of(texts, spread.select(F.col("first").alias("id")).distinct(), n, percent))
    # Only ids of several texts tie their texts' representatives.
    several = known.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("z")).where("a <> z").select("id")
    ties = known.join(several, "id", "left_semi").join(spread, ["digest", "salt"])
    ties = ties.where("id <> first").select(F.col("first").alias("x"), F.col("id").alias("y")).distinct()
    named = links(sets, percent, ties).select(F.col("vertex").alias("first"), "component")
    # A row for each digest and salt, so rows of one text meet it in several tasks.
    sizes = sets.groupBy("digest").agg(F.max("n").alias("n_shingles"))
    spread = spread.join(sizes, "digest").join(named, "first", "left")
    spread = spread.select("digest", "salt", "n_shingles", F.coalesce("component", "first").alias("component"))
    found = keyed.join(spread, ["digest", "salt"], "left").select(
        "id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
    return found.unionByName(nameless)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")
