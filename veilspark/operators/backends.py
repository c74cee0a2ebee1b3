"""Pluggable models: a backend is a factory of a function from texts to spans, made once for each task."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = "array<struct<start:int,end:int,kind:string,text:string,score:double>>"
Span = tuple[int, int, str, str, float]
Backend = Callable[[], Callable[[str], list[Span]]]


def null_backend() -> Callable[[str], list[Span]]:
    return lambda text: []


def pattern_backend(patterns: dict[str, str], score: float = 0.9) -> Backend:
    """A deterministic stand-in for a model: named patterns."""

    def make() -> Callable[[str], list[Span]]:
        compiled = [(k, re.compile(p)) for k, p in patterns.items()]
        return lambda text: [(m.start(), m.end(), k, m.group(), score) for k, p in compiled for m in p.finditer(text)]

    return make


BACKENDS: dict[str, Backend] = {"null": null_backend}


def detect(docs: DataFrame, backend: Backend, text: str = "text") -> DataFrame:
    """docs with `model_spans` of the backend; spans that don't fit their text or repeat are left out."""

    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = backend()
        for texts in batches:
            yield texts.map(lambda t: valid(t or "", find(t or "")))

    return docs.withColumn("model_spans", run(F.col(text)))


def detect_twice(docs: DataFrame, backend: Backend, text: str, masked: str) -> DataFrame:
    """docs with `model_spans` of a text and of a masked form of equal length, each span once, by start, end and type.

    A plan node of its own: the model is not run again for each use of its spans.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("score", pa.float64())]))

    def scan(find: Callable[[str], list[Span]], whole: str, part: str) -> list[dict]:
        found = {s[:3]: s for t in (part, whole) for s in valid(t, find(t))}
        return [dict(zip(("start", "end", "kind", "text", "score"), found[k], strict=True)) for k in sorted(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = backend()
        for batch in batches:
            pairs = zip(batch.column(text).to_pylist(), batch.column(masked).to_pylist(), strict=True)
            spans = pa.array([scan(find, a or "", b or "") for a, b in pairs], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, spans], [*batch.schema.names, "model_spans"])

    spans = T.StructType.fromDDL(f"model_spans {SPANS}").fields
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *spans]))


def valid(text: str, spans: list[Span]) -> list[Span]:
    placeholders = [m.span() for m in re.finditer(r"\[\[[^\]]+\]\]", text)]
    good = {
        (s, e, k): (s, e, k, t, score)
        for s, e, k, t, score in spans
        if 0 <= s < e <= len(text) and text[s:e] == t and not any(s < b and e > a for a, b in placeholders)
    }
    return [good[k] for k in sorted(good)]
