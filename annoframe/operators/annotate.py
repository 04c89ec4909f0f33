"""Annotators written in Python run in Arrow batches; votes, batches of bounded size, alignment of ambiguous annotations."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Span = tuple[int, int, str]
Annotator = Callable[[str], list[Span]]
_MODELS: dict[str, object] = {}
HELD = 50_000  # spans of a batch that a worker gives on
SPANS = "array<struct<start:bigint,end:bigint,label:string>>"


def worker_model(model: str | None, make: Callable[[], object]) -> object:
    """What `make` gives, made once in the life of a worker for each name of a model; without a name, anew."""
    if model is None:
        return make()
    if model not in _MODELS:
        _MODELS[model] = make()
    return _MODELS[model]


def shipped(spark: SparkSession, path: str) -> str:
    """Have Spark send a model's file or folder, which the driver can read, to all executors; the name by which
    `shipped_path` finds it there."""
    spark.sparkContext.addFile(path, recursive=True)
    return path.rstrip("/").rpartition("/")[2]


def shipped_path(name: str) -> str:
    return SparkFiles.get(name)


def annotate(texts: DataFrame, make: Callable[[], Annotator], model: str | None = None) -> DataFrame:
    """text_id, spans, error of every text.  `make` gives the function for one text; where that fails, the text gets no spans
    and the error's text, and the run goes on.  With the name of a model, `make` runs once per Python worker, which keeps
    what it gives for all tasks and queries that name that model; else once per task.  Null text is empty."""

    def told(ids: list, counts: list, spans: list[Span], errors: list) -> pa.RecordBatch:
        ends = pa.array([None if n is None else b - n for n, b in zip(counts, accumulate(n or 0 for n in counts))] + [len(spans)], pa.int32())
        columns = list(zip(*spans)) or [[], [], []]
        items = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["start", "end", "label"])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(ends, items), pa.array(errors, pa.string())], names=["text_id", "spans", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of few texts are held at a time: given on once there are `HELD`."""
        annotator = worker_model(model, make)
        for batch in batches:
            ids, counts, spans, errors = [], [], [], []
            for text_id, text in zip(batch.column("text_id"), batch.column("text")):
                try:
                    found, error = [(a, b, c) for a, b, c in annotator(text.as_py() or "")], None
                except Exception as e:
                    found, error = None, f"{type(e).__name__}: {e}"
                ids.append(text_id.as_py())
                counts.append(None if found is None else len(found))
                spans += found or []
                errors.append(error)
                if len(spans) >= HELD:
                    yield told(ids, counts, spans, errors)
                    ids, counts, spans, errors = [], [], [], []
            if ids:
                yield told(ids, counts, spans, errors)

    return texts.select(F.col("text_id").cast("long").alias("text_id"), "text").mapInArrow(run, f"text_id long, spans {SPANS}, error string")


def annotate_with_status(texts: DataFrame, make: Callable[[], Callable[[str], tuple[list[Span], dict[str, str]]]], model: str | None = None) -> DataFrame:
    """text_id, spans, status of every text, where a text's function gives spans and a status that is kept as metadata.
    After an error there are no spans and the status holds `error`.  model: as in `annotate`.  Null text is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mapper = worker_model(model, make)
        for batch in batches:
            out = []
            for text_id, text in batch[["text_id", "text"]].itertuples(index=False, name=None):
                try:
                    found, status = mapper(text or "")
                    out.append((text_id, [{"start": a, "end": b, "label": c} for a, b, c in found], dict(status)))
                except Exception as e:
                    out.append((text_id, None, {"error": f"{type(e).__name__}: {e}"}))
            yield pd.DataFrame(out, columns=["text_id", "spans", "status"])

    return texts.select("text_id", "text").mapInPandas(run, f"text_id long, spans {SPANS}, status map<string,string>")


def chained(*makers: Callable) -> Callable[[], Annotator]:
    """One annotator of several: the first sees the text, each later one the text and the spans so far, which it may change,
    drop or add to.  What the last gives is the result."""

    def make() -> Annotator:
        first, *rest = [m() for m in makers]

        def one(text: str) -> list[Span]:
            spans = first(text)
            for step in rest:
                spans = step(text, spans)
            return spans

        return one

    return make


def good_and_bad(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per span of the texts that went well; the errors of the others."""
    layer = annotated.where("error is null").select("text_id", F.explode("spans").alias("s")).select("text_id", "s.*")
    return layer, annotated.where("error is not null").select("text_id", "error")


def pattern_annotator(pattern: str, label: str) -> Callable[[], Annotator]:
    def make() -> Annotator:
        found = re.compile(pattern)
        return lambda text: [(*m.span(), label) for m in found.finditer(text)]

    return make


def budget_spans(text: str, most: int, ends: str = ".!?") -> list[Span]:
    """Batches of at most `most` characters that end after the last closing mark in reach; white space between is left out."""
    if len(text) < most:
        return [(0, len(text), "batch")]
    out, at = [], 0
    while at < len(text):
        stop = min(at + most, len(text))
        mark = max(text.rfind(c, at + 2, stop) for c in ends)
        stop = mark + 1 if mark >= 0 else stop
        out.append((at, stop, "batch"))
        more = re.compile(r"\S").search(text, stop)
        at = more.start() if more else stop
    return out


def budget_batches(texts: DataFrame, most: int) -> DataFrame:
    """text_id, start, end of every text's batches."""
    layer, _ = good_and_bad(annotate(texts, lambda: lambda text: budget_spans(text, most)))
    return layer.drop("label")


def voted(versions: DataFrame) -> DataFrame:
    """versions: text_id, start, end, label, one row per model.  The label most models chose; the least of equals."""
    c = versions.groupBy("text_id", "start", "end", "label").agg(F.count("*").alias("votes"))
    return c.groupBy("text_id", "start", "end").agg(F.min_by("label", F.struct(-F.col("votes"), "label")).alias("label"), F.max("votes").alias("votes"))


def pair_annotations(a: list[dict], b: list[dict], attributes: list[str], focus: list[str]) -> list[tuple[str, int, int, list[str]]]:
    """(status, place in a, place in b, equal attributes).  Each of a takes its equal in b, else the free one of b that is
    nobody's equal and has the most attributes in common, where a later one must not have fewer of the focus."""
    own, used, out = set(focus), set(), []
    for i, x in enumerate(a):
        best, equal, status = next((j for j, y in enumerate(b) if x == y), -1), list(attributes), "COMMON"
        if best < 0:
            equal, status = [], "MODIFIED"
            for j, y in enumerate(b):
                shared = [k for k in attributes if x.get(k) == y.get(k)]
                if j not in used and y not in a and len(shared) > len(equal) and len(own.intersection(shared)) >= len(own.intersection(equal)):
                    best, equal = j, shared
        out.append((status if best >= 0 else "MISSING", i, best, equal))
        used.add(best)
    return out + [("EXTRA", -1, j, []) for j in range(len(b)) if j not in used]


def aligned(rows: DataFrame, attributes: list[str], focus: list[str]) -> DataFrame:
    """rows: text_id, start, end, a, b (arrays of maps, null for none).  One row per pair: status, a_nth, b_nth, equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal pairs of lists are aligned once a batch."""
        for batch in batches:
            own = batch.column("ab").dictionary_encode()
            out, ends = [], [0]
            for x in own.dictionary.to_pylist():
                sides = json.loads(x)
                out += pair_annotations(sides.get("a") or [], sides.get("b") or [], attributes, focus)
                ends.append(len(out))
            ends, at = np.array(ends), own.indices.to_numpy()
            n = ends[at + 1] - ends[at]  # rows of each
            row = np.repeat(np.arange(len(at)), n)
            pick = pa.array(np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + ends[at][row])
            columns = list(zip(*out)) or [[], [], [], []]
            pairs = [pa.array(c, t).take(pick) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string())))]
            spans = [batch.column(c).take(pa.array(row)) for c in ("text_id", "start", "end")]
            yield pa.RecordBatch.from_arrays([*spans, *pairs], names=["text_id", "start", "end", "status", "a_nth", "b_nth", "equal"])

    place = [F.col(c).cast("long").alias(c) for c in ("text_id", "start", "end")]
    both = F.to_json(F.struct("a", "b"), {"ignoreNullFields": "false"})
    return rows.select(*place, both.alias("ab")).mapInArrow(run, "text_id long, start long, end long, status string, a_nth int, b_nth int, equal array<string>")
