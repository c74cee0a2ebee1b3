"""Token ids as Arrow files of fixed-size lists.

Each file is an Arrow IPC stream with a footer. Its batches hold the same number of rows (but for
the last), and a row is one sequence: `ids`, a fixed-size list of `length` unsigned integers;
`mask`, a fixed-size list of booleans, false where the last sequence is filled up; and the documents
that begin in it, as `docs` and their positions `at`. So sequence i is row i mod rows of batch
i div rows, and reading it through a memory map copies nothing: ids come as a view of the mapped
bytes, masks as an Arrow array over the mapped bits.

Texts are cut before each space that other than white space follows, where the library's pieces end
whatever surrounds them, and each distinct part of a slice is encoded once, many in one call.

Documents are written in ascending order of id, each followed by the end id: one file for each range
partition, so file k + 1 goes on where file k ends. Files are written under a temporary name and
renamed, so a task that is run again leaves the same file.

Defined cases: a null or empty text is the end id alone; null ids come first (stored as null); rows
with equal ids keep an order by text; partitions without rows write no file and an empty table writes
none at all; a text that holds the string of a special token is encoded whole, as the library has it
(the special token's id, unless the caller's file says otherwise); other columns are left out, so their
names can't clash.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.llm.arrow import held, small_batches
from veilspark.llm.pieces import RUN, SPACE, ragged, slices
from veilspark.plans.frames import cut, read_table, shared_dir

LENGTH = 2048
ROWS = 64
#: Parts joined in one text for the library; texts handed to it in one call; bytes of text handled at once.
JOINED, CALLED, SLICE_BYTES = 512, 128, 6 << 20
#: Stands for a place to cut at, in texts that don't hold it.
_MARK = "\ue000"

def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Encoder:
    """Ids of whole texts by the tokenizers library, which takes much less time for many parts in one text.

    A part that begins with a space and other than white space is a run of pieces wherever it stands, so
    distinct parts are joined; token lengths in bytes tell whose ids are whose, since byte-level ids lose nothing.
    """

    def __init__(self, content: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, id_ in vocabulary.items():
            self.bytes_of[id_] = len(token)  # a character for each byte

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and how many each has."""
        ids, counts = [np.zeros(0, np.uint32)], []
        for k in range(0, len(texts), CALLED):
            for found in self.library.encode_batch_fast(texts[k : k + CALLED], add_special_tokens=False):
                ids.append(np.array(found.ids, np.uint32))
                counts.append(len(ids[-1]))
        return np.concatenate(ids), np.array(counts, np.int64)

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts, each behind a space, and where each one's begin and how many they are."""
        edges = np.append(np.arange(0, len(parts), JOINED), len(parts))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), parts), pa.scalar(" ", parts.type))
        ids, _ = self._ids([" " + x for x in joined.to_pylist()])
        upto = np.cumsum(pc.binary_length(parts).to_numpy() + 1)
        ends = np.cumsum(self.bytes_of[ids])
        stop = np.searchsorted(ends, upto) + 1 if len(parts) else np.zeros(0, np.int64)
        if len(parts) and not np.array_equal(ends[stop - 1], upto):
            raise ValueError("the tokenizer joins bytes across parts")
        return ids, np.append(0, stop)[:-1], np.diff(stop, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none), and each text's end among them after a leading 0."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring(texts, _MARK)
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        odd = pc.match_substring_regex(texts, RUN)
        if pc.any(odd).as_py():
            marked = pc.replace_substring_regex(pc.if_else(odd, texts, ""), f" ([^{SPACE}])", _MARK + r"\1")
            plain = pc.replace_substring(pc.if_else(odd, "", texts), " ", _MARK)
            texts_ = pc.if_else(odd, marked, plain)
            split = pc.split_pattern(pc.if_else(whole, "", texts_), _MARK)
        else:
            split = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        counts = np.diff(offsets) - 1  # parts behind a space
        flat = split.flatten()
        first = np.zeros(len(flat), bool)
        first[offsets[:-1]] = True
        lead = pc.if_else(whole, texts, flat.filter(pa.array(first)))
        seen = flat.filter(pa.array(~first)).dictionary_encode()
        ids, starts, lengths = self._parts(seen.dictionary)
        lead_ids, lead_lengths = self._ids(lead.to_pylist())
        place = seen.indices.to_numpy()
        total = np.concatenate([[0], np.cumsum(counts + 1)])
        all_starts, all_lengths = np.empty(int(total[-1]), np.int64), np.empty(int(total[-1]), np.int64)
        behind = ~first
        all_starts[behind], all_lengths[behind] = starts[place], lengths[place]
        all_starts[total[:-1]] = len(ids) + np.cumsum(lead_lengths) - lead_lengths
        all_lengths[total[:-1]] = lead_lengths
        found = np.concatenate([ids, lead_ids])[ragged(all_starts, all_lengths)]
        return found, np.concatenate([[0], np.cumsum(all_lengths)])[total]


def encoder(content: str) -> Encoder:
    """This worker's encoder, made once for each tokenizer."""
    return held(("tokens", hashlib.sha256(content.encode()).digest()), lambda: Encoder(content))


def file_schema(length: int, id_type: pa.DataType, vocabulary: int) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema(
        {"ids": pa.list_(kind, length), "mask": pa.list_(pa.bool_(), length), "docs": pa.list_(id_type), "at": pa.list_(pa.int32())}
    )


class SequenceWriter:
    """Cuts a stream of documents into sequences and writes them; holds less than a batch and one slice of documents."""

    def __init__(self, sink: pa.NativeFile, schema: pa.Schema, rows: int) -> None:
        self.writer = pa.ipc.new_file(sink, schema)
        self.schema, self.rows = schema, rows
        self.length = schema.field("ids").type.list_size
        self.held = np.zeros(0, np.uint32)
        self.docs: list[object] = []
        self.starts: list[int] = []  # from the first held id

    def add(self, ids: np.ndarray, docs: list[object], starts: np.ndarray) -> None:
        self.starts += (starts + len(self.held)).tolist()
        self.docs += docs
        self.held = np.concatenate([self.held, ids])
        size = self.rows * self.length
        whole = len(self.held) // size
        for k in range(whole):
            self._write(self.held[k * size : (k + 1) * size], size)
        self.held = self.held[whole * size :]

    def _write(self, ids: np.ndarray, filled: int) -> None:
        schema, sequences = self.schema, len(ids) // self.length
        here = int(np.searchsorted(np.asarray(self.starts, np.int64), filled))
        starts = np.asarray(self.starts[:here], np.int64)
        ends = np.concatenate([[0], np.searchsorted(starts, self.length * np.arange(1, sequences + 1))]).astype(np.int32)
        kind = schema.field("ids").type.value_type
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids.astype(kind.to_pandas_dtype())), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < filled), self.length),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(self.docs[:here], schema.field("docs").type.value_type)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array((starts % self.length).astype(np.int32))),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
        del self.docs[:here]
        self.starts = [x - filled for x in self.starts[here:]]

    def close(self) -> None:
        if filled := len(self.held):
            self._write(np.concatenate([self.held, np.zeros(-filled % self.length, np.uint32)]), filled)
        self.writer.close()


class SequenceFile:
    """Random access to the sequences of one file; over a memory map no ids are copied."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.reader = pa.ipc.open_file(source)
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * self.rows + self.reader.get_batch(n - 1).num_rows if n else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        batch = self.reader.get_batch(i // self.rows)
        ids = batch.column(0).slice(i % self.rows, 1).flatten().to_numpy(zero_copy_only=True)
        return ids, batch.column(1).slice(i % self.rows, 1).flatten()

    def documents(self) -> Iterator[tuple[object, np.ndarray]]:
        """Each document's id and its ids, end id included."""
        doc, kept, any_doc = None, [], False
        for k in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(k)
            length = batch.column(0).type.list_size
            ids = batch.column(0).flatten().to_numpy()
            filled = int(np.count_nonzero(batch.column(1).flatten().to_numpy(zero_copy_only=False)))
            counts = np.diff(batch.column(2).offsets.to_numpy())
            starts = batch.column(3).flatten().to_numpy() + np.repeat(np.arange(batch.num_rows) * length, counts)
            docs = batch.column(2).flatten().to_pylist()
            edges = [*starts.tolist(), filled]
            if edges[0]:
                kept.append(ids[: edges[0]])
            for x, a, b in zip(docs, edges, edges[1:], strict=False):
                if any_doc:
                    yield doc, kept[0] if len(kept) == 1 else np.concatenate(kept)
                doc, kept, any_doc = x, [ids[a:b]], True
        if any_doc:
            yield doc, np.concatenate(kept)


def write(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, length: int = LENGTH, rows: int = ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write all documents; returns the manifest: part, path, n_docs, n_ids, and `start`, the ids before the file."""
    content = read_tokenizer(tokenizer_path)
    from tokenizers import Tokenizer

    vocabulary = max(end_id + 1, Tokenizer.from_str(content).get_vocab_size())
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if dict(slim.dtypes)["id"] not in ("bigint", "int", "string"):
        raise ValueError("ids must be integers or strings")
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[dict(slim.dtypes)["id"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = pa.fs.FileSystem.from_uri(folder)
        use, writer, sink, n_docs, n_ids = encoder(content), None, None, 0, 0
        path = f"{base}/part-{part:06d}.arrow"
        draft = f"{base}/.part-{part:06d}.{uuid.uuid4().hex}"
        for batch in batches:
            for some in slices(batch, 1, SLICE_BYTES):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    sink = fs.open_output_stream(draft)
                    writer = SequenceWriter(sink, file_schema(length, id_type, vocabulary), rows)
                ids, ends = use.encode(some.column(1))
                ids = np.insert(ids, ends[1:], end_id)
                starts = ends[:-1] + np.arange(len(ends) - 1)
                writer.add(ids, some.column(0).to_pylist(), starts)
                n_docs, n_ids = n_docs + some.num_rows, n_ids + len(ids)
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(draft, path)
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "n_docs": [n_docs], "n_ids": [n_ids]})

    ordered = slim.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    manifest = cut(small_batches(ordered).mapInArrow(run, "part bigint, path string, n_docs bigint, n_ids bigint"))
    # A row for each file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """From the files: each document's id, start, n_tokens and ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                docs, starts, counts, sums, at = [], [], [], [], row["start"]
                with fs.open_input_file(row["path"]) as source:
                    for doc, ids in SequenceFile(source).documents():
                        docs.append(doc)
                        starts.append(at)
                        counts.append(len(ids))
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        at += len(ids)
                arrays = [pa.array(docs, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type])]
                arrays += [pa.array(x, pa.int64()) for x in (starts, counts, sums)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "start", "n_tokens", "ids_crc32"])

    # A partition for each file, which adaptive execution doesn't merge.
    files = manifest.select("path", "start", "part").repartitionByRange(max(1, manifest.count()), "part").select("path", "start")
    return files.mapInArrow(run, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    manifest = write(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_documents(manifest, folder).withColumnRenamed("id", "doc_id")
