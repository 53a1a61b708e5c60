"""Fill-in-the-middle: a document is cut at two unit ends and its parts are put in another order.

The ends of a document's units are held as a compressed set of offsets in the
manner of Roaring bitmaps: a container for every 65,536 offsets, as a sorted
array, a bitmap or a list of runs, whichever is smallest, and the cumulative
cardinalities of the containers. Where the n-th unit ends is a search in these
cardinalities and a select within one container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_BITS = 16
_SPAN = 1 << _BITS


# --- the boundary set -------------------------------------------------------

class ArrayContainer:
    """Up to a few thousand offsets, sorted: two bytes each."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @staticmethod
    def bytes_for(cardinality: int, runs: int) -> int:
        return 2 * cardinality

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitmapContainer:
    """A bit for each of the 65,536 offsets, with the number of set bits before every 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_SPAN, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def bytes_for(cardinality: int, runs: int) -> int:
        return _SPAN // 8

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, side="right")) - 1
        left = int(self.words[word])
        for _ in range(rank - int(self.before[word])):
            left &= left - 1  # without its lowest set bit
        return 64 * word + (left & -left).bit_length() - 1


class RunContainer:
    """Runs of consecutive offsets (blank lines, one-character units): four bytes each."""

    def __init__(self, low: np.ndarray):
        low = low.astype(np.int64)
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.starts = low[first].astype(np.uint16)
        self.before = np.append(first, len(low))  # offsets in earlier runs

    @staticmethod
    def bytes_for(cardinality: int, runs: int) -> int:
        return 4 * runs

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


CONTAINERS = (ArrayContainer, RunContainer, BitmapContainer)


class BoundarySet:
    """A set of offsets given in rising order, of any size."""

    def __init__(self, offsets: np.ndarray):
        offsets = np.asarray(offsets, dtype=np.int64)
        high = offsets >> _BITS
        starts = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[starts]
        self.cumulative = np.append(starts, len(offsets))
        self.containers = [self._container(offsets[a:b] & (_SPAN - 1)) for a, b in zip(starts, self.cumulative[1:])]

    @staticmethod
    def _container(low: np.ndarray):
        runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
        return min(CONTAINERS, key=lambda kind: kind.bytes_for(len(low), runs))(low)

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, rank: int) -> int:
        """The offset with ``rank`` smaller ones in the set."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.cumulative, rank, side="right")) - 1
        return (int(self.keys[at]) << _BITS) | self.containers[at].select(rank - int(self.cumulative[at]))


def line_ends(text: str) -> np.ndarray:
    """Code-point offsets behind each line of ``text``; a last line may lack its line feed."""
    if text.isascii():
        points = np.frombuffer(text.encode("ascii"), dtype=np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.flatnonzero(points == 10) + 1
    return ends if not len(text) or text[-1] == "\n" else np.append(ends, len(text))


# --- the transformation -----------------------------------------------------

def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits for a document, the same in every run; a null id counts as an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def cut_offsets(boundaries: BoundarySet, h1: int, h2: int) -> tuple[int, int]:
    """Where prefix and middle end: behind as many units as the draws say, none and all included."""
    units = sorted(h % (len(boundaries) + 1) for h in (h1, h2))
    return tuple(boundaries.select(n - 1) if n else 0 for n in units)


def transform(text: str, form: str, begin: int, stop: int) -> str:
    prefix, middle, suffix = text[:begin], text[begin:stop], text[stop:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    if form == "spm":
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return text


def restore(output: str, form: str) -> str:
    """The exact text of an output; its parts hold no mark, so the first of each kind is the one put there."""
    if form == "plain":
        return output
    marks = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    first, rest = output[len(marks[0]):].split(marks[1], 1)
    second, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, seed: int = 7, changed_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output and restored of every document.

    Units are lines, counted over the whole text. A text stays plain if it is
    empty or null, holds one of the three marks, or is drawn to stay
    (``changed_percent``); then the two lengths are null. ``restored`` is made
    from ``output`` and ``form`` alone. Repeated rows give the same output, a
    null id is drawn like an empty one; extra columns are ignored; an empty
    table gives no rows.
    """
    schema = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, "
              "restored string")
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [part.split()[0] for part in schema.split(", ")]

    def one(doc_id: int | None, text: str) -> tuple:
        boundaries = BoundarySet(line_ends(text))
        h1, h2, h3, h4 = draws(seed, doc_id)
        if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= changed_percent:
            return doc_id, len(boundaries), "plain", None, None, text, restore(text, "plain")
        form = "spm" if h4 % 100 < spm_percent else "psm"
        begin, stop = cut_offsets(boundaries, h1, h2)
        output = transform(text, form, begin, stop)
        return doc_id, len(boundaries), form, begin, stop - begin, output, restore(output, form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                rows.append(one(doc_id, text.as_py() or ""))
                held += len(rows[-1][5])
                # Long texts go on in small batches, so that a task holds few of them three times over.
                if held >= 1 << 23 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, held = [], 0

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def digests(outputs: DataFrame) -> DataFrame:
    """The outputs with SHA-256 of ``output`` and ``restored`` in their place."""
    def sha(name: str):
        return F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256")

    return outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored"))
