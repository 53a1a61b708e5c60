"""Taxonomy files of any size, cut at their top-level nodes by many tasks.

Spark's text reader splits a file at closing braces into records and deals its
byte ranges to tasks. What a range means depends on what lies before it: it may
begin within a string, and at any depth. A first pass therefore sums up every
range for both cases, the sums of a file are put together in order, and a
second pass, which knows how each range begins, cuts out the nodes. Only nodes
that lie in more than one range are joined by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import materialize

_QUOTE, _BACKSLASH, _COMMA = 34, 92, 44
_STEP = np.zeros(256, dtype=np.int64)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_STRUCTURAL = _STEP != 0
_STRUCTURAL[_COMMA] = True
_SCHEMA = re.compile(rb'"Schema"\s*:\s*([\[{])')
_BOM_BYTES = 3


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that no backslash escapes."""
    found = np.flatnonzero(data == _QUOTE)
    behind = found[(found > 0) & (data[np.maximum(found - 1, 0)] == _BACKSLASH)]
    escaped = []
    for place in behind.tolist():
        first = place
        while first > 0 and data[first - 1] == _BACKSLASH:
            first -= 1
        if (place - first) % 2:
            escaped.append(place)
    return np.setdiff1d(found, escaped, assume_unique=True) if escaped else found


class Structure:
    """Brackets and commas outside of strings in a piece of JSON that begins ``inside`` a string or not."""

    def __init__(self, data: bytes, quotes: np.ndarray, inside: bool):
        raw = np.frombuffer(data, dtype=np.uint8)
        self.quotes, self.inside = quotes, inside
        places = np.flatnonzero(_STRUCTURAL[raw])
        self.places = places[~self.within_string(places)]
        self.marks = raw[self.places]
        #: Depth behind each place, relative to the beginning.
        self.depth = np.cumsum(_STEP[self.marks])

    def within_string(self, places: np.ndarray) -> np.ndarray:
        return (np.searchsorted(self.quotes, places) + self.inside) % 2 == 1

    def depth_before(self, place: int) -> int:
        at = int(np.searchsorted(self.places, place))
        return int(self.depth[at - 1]) if at else 0


@dataclass
class RangeState:
    """How a byte range begins: within a string, at which depth, and within which form of ``Schema``."""

    inside: bool = False
    depth: int = 0
    form: str = ""


@dataclass
class _Case:
    """What a range does if it begins inside a string, or outside: depth gained, least depth, ``Schema`` keys."""

    depth: int = 0
    least: int = 0
    keys: list[tuple[int, str, int]] = field(default_factory=list)  # depth, form, least depth behind it


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """document, block, file size and text (with its closing braces) of consecutive records of one range."""
    for batch in batches:
        documents, blocks = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        changes = [i for i in range(1, len(blocks)) if blocks[i] != blocks[i - 1] or documents[i] != documents[i - 1]]
        for first, end in zip([0, *changes], [*changes, len(blocks)]):
            if first < end:
                texts = batch.column(3).slice(first, end - first).cast(pa.binary()).to_pylist()
                yield documents[first], int(blocks[first]), batch.column(2)[first].as_py(), b"}".join(texts) + b"}"


_SUMMARY = ("document string, block bigint, file_size bigint, bytes bigint, quotes bigint, tail string, "
            "cases array<struct<depth:bigint,least:bigint,keys:array<struct<depth:bigint,form:string,least:bigint>>>>")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each byte range of the task."""
    current, size, held, flips, tail, cases = None, 0, 0, 0, b"", [_Case(), _Case()]

    def row() -> pa.RecordBatch:
        listed = [{"depth": c.depth, "least": c.least, "keys": [dict(zip(("depth", "form", "least"), k)) for k in c.keys]}
                  for c in cases]
        names = [part.split()[0] for part in _SUMMARY[:_SUMMARY.index("cases")].split(", ") if part]
        values = [*current, size, held, flips, tail.decode("utf-8", "replace")]
        table = pa.table({n: [v] for n, v in zip(names, values)})
        return table.append_column("cases", pa.array([listed], pa.list_(pa.struct([
            ("depth", pa.int64()), ("least", pa.int64()), ("keys", pa.list_(pa.struct([
                ("depth", pa.int64()), ("form", pa.string()), ("least", pa.int64())])))])))).to_batches()[0]

    for document, block, file_size, data in _grouped(batches):
        if (document, block) != current:
            if current:
                yield row()
            current, size, held, flips, cases = (document, block), file_size, 0, 0, [_Case(), _Case()]
        quotes = _quotes(np.frombuffer(data, dtype=np.uint8))
        for start, case in enumerate(cases):
            here = Structure(data, quotes, bool((start + flips) % 2))
            least = int(here.depth.min(initial=0))
            case.keys = [(d, form, min(low, case.depth + least)) for d, form, low in case.keys]
            for m in _SCHEMA.finditer(data):
                if m.start() in quotes and not here.within_string(np.array([m.start()]))[0]:
                    at = int(np.searchsorted(here.places, m.end()))
                    behind = int(here.depth[at:].min(initial=here.depth[at - 1]))
                    case.keys.append((case.depth + here.depth_before(m.start()), m[1].decode(), case.depth + behind))
            case.least = min(case.least, case.depth + least)
            case.depth += int(here.depth[-1]) if len(here.depth) else 0
        held, flips, tail = held + len(data), flips + len(quotes), data[data.rfind(b"}", 0, -1) + 1:-1][-64:]
    if current:
        yield row()


def range_states(summaries: list) -> dict[tuple[str, int], RangeState]:
    """How each range begins, from what all ranges of its file do.

    A file that is no whole JSON object, or has no ``Schema`` list or node, is an error.
    """
    states: dict[tuple[str, int], RangeState] = {}
    files: dict[str, list] = {}
    for s in summaries:
        files.setdefault(s.document, []).append(s)
    for document, parts in files.items():
        parts.sort(key=lambda s: s.block)
        state, found = RangeState(), False
        for s in parts:
            states[document, s.block] = state
            case = s.cases[state.inside]
            form = "" if state.depth + case.least <= 1 else state.form
            for key in case.keys:
                if state.depth + key.depth == 1:
                    found, form = True, key.form if state.depth + key.least > 1 else ""
            state = RangeState(bool((state.inside + s.quotes) % 2), state.depth + case.depth, form)
        # Every record was given a closing brace, the last one of a file may have none of its own.
        total, size = sum(s.bytes for s in parts), parts[0].file_size
        closed = total in (size, size - _BOM_BYTES)
        whole = state.depth == 0 if closed else state.depth == -1 and not parts[-1].tail.strip()
        if not found or state.inside or not whole:
            raise ValueError(f"taxonomy without readable top-level 'Schema': {document}")
    return states


_PIECE = "document string, block bigint, ordinal bigint, begun boolean, ended boolean, text string"


def _pieces(states: dict[tuple[str, int], RangeState]):
    """Task function: the nodes and parts of nodes in each byte range; ``ordinal`` counts node ends before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, rows = None, RangeState(), []
        ordinal, begun, parts = 0, False, []

        def piece(ended: bool) -> tuple:
            return (*current, ordinal, begun, ended, b"".join(parts).decode("utf-8"))

        def flush() -> pa.RecordBatch:
            names = [p.split()[0] for p in _PIECE.split(", ")]
            types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for document, block, _, data in _grouped(batches):
            if (document, block) != current:
                if current and state.form:
                    rows.append(piece(False))
                current, begin = (document, block), states[document, block]
                state = RangeState(begin.inside, begin.depth, begin.form)
                ordinal, begun, parts = 0, False, []
            quotes = _quotes(np.frombuffer(data, dtype=np.uint8))
            here = Structure(data, quotes, state.inside)
            depth, at, index = state.depth + here.depth, 0, 0
            opened = [m for m in _SCHEMA.finditer(data) if m.start() in quotes
                      and not here.within_string(np.array([m.start()]))[0]
                      and state.depth + here.depth_before(m.start()) == 1]
            while True:
                if not state.form:
                    opened = [m for m in opened if m.start() >= at]
                    if not opened:
                        break
                    m = opened.pop(0)
                    state.form, at = m[1].decode(), m.end() - (m[1] == b"{")
                    begun, parts = True, []
                    index = int(np.searchsorted(here.places, m.end()))
                ends = depth[index:] == 1
                if state.form == "[":
                    ends = ends | ((here.marks[index:] == _COMMA) & (depth[index:] == 2))
                ends = np.flatnonzero(ends)
                if not len(ends):
                    break
                index += int(ends[0])
                place, last = int(here.places[index]), depth[index] == 1
                parts.append(data[at:place + (state.form == "{")])
                rows.append(piece(True))
                ordinal, begun, parts, at, index = ordinal + 1, True, [], place + 1, index + 1
                if last:
                    state.form = ""
            if state.form:
                parts.append(data[at:])
            state.inside = bool((state.inside + len(quotes)) % 2)
            state.depth = int(depth[-1]) if len(depth) else state.depth
            if rows:
                yield flush()
                rows = []
        if current and state.form:
            rows.append(piece(False))
        if rows:
            yield flush()

    return run


def scan_nodes(spark: SparkSession, path: str | list[str], folder: str | None = None) -> DataFrame:
    """Top-level nodes of UTF-8 taxonomy files: ``document``, ``place``, ``node`` (variant).

    The same rows as ``top_nodes(read_taxonomy(...))``, from files of any size:
    each byte range of a file is a task. ``Schema`` may be a list or one node;
    a file without it, or one that is cut off, stops the job, and so does a
    node that is no JSON. What other top-level keys hold is skipped unread. A
    node may have up to 128 MiB, the bound of a variant.
    """
    records = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), "value")
    # One row for each byte range, a few numbers each.
    states = range_states(records.mapInArrow(_summaries, _SUMMARY).collect())
    pieces = materialize(records.mapInArrow(_pieces(states), _PIECE), "node-pieces", folder)
    counts = pieces.groupBy("document", "block").agg(F.count_if("ended").alias("ends")).collect()  # one row a range
    before: dict[tuple[str, int], int] = {}
    sums: dict[str, int] = {}
    for row in sorted(counts, key=lambda r: (r.document, r.block)):
        before[row.document, row.block] = sums.get(row.document, 0)
        sums[row.document] = before[row.document, row.block] + row.ends
    bases = spark.createDataFrame([(d, b, n) for (d, b), n in before.items()], "document string, block bigint, base bigint")
    placed = pieces.join(F.broadcast(bases), ["document", "block"]).withColumn("place", F.col("base") + F.col("ordinal"))
    whole = F.col("begun") & F.col("ended")
    joined = placed.where(~whole).groupBy("document", "place").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    texts = placed.where(whole).select("document", "place", "text").unionByName(
        joined.select("document", "place", F.array_join("parts.text", "").alias("text")))
    return texts.where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "").select(
        "document", F.col("place").cast("int").alias("place"), F.parse_json("text").alias("node"))
