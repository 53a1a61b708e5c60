import hashlib
import re

import numpy as np
import pytest

from shelfmark.llm import fill_middle as fm
from shelfmark.llm.queries import QUERIES


@pytest.mark.parametrize("density", [0.0005, 0.04, 0.3, 0.97, 1.0])
@pytest.mark.parametrize("size", [0, 1, 65_536, 65_537, 200_000])
def test_select(density, size):
    offsets = np.flatnonzero(np.random.default_rng(size).random(size) < density)
    held = fm.BoundarySet(offsets)
    assert len(held) == len(offsets)
    picked = {0, len(offsets) - 1, *np.random.default_rng(1).integers(0, max(len(offsets), 1), 200).tolist()}
    assert all(held.select(r) == offsets[r] for r in picked if 0 <= r < len(offsets))
    with pytest.raises(IndexError):
        held.select(len(offsets))


def test_kinds_of_containers():
    span = 65_536
    mixed = np.r_[np.arange(0, span, 100), span + np.flatnonzero(np.random.default_rng(0).random(span) < 0.5),
                  2 * span + np.arange(5_000), 5 * span + 7]
    held = fm.BoundarySet(mixed)
    assert [type(c) for c in held.containers] == [
        fm.ArrayContainer, fm.BitmapContainer, fm.RunContainer, fm.ArrayContainer]
    assert held.keys.tolist() == [0, 1, 2, 5] and held.cumulative[-1] == len(mixed)
    assert [held.select(r) for r in range(len(mixed))] == mixed.tolist()


TEXTS = ["", "a", "a\n", "\n", "\n\n\nend", "é\n\U0001F600b\nq", "one\r\ntwo\rthree", "x" * 70_000 + "\n" + "y\n" * 70_000, "\x00\n"]


@pytest.mark.parametrize("text", TEXTS)
def test_lines(text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert fm.line_ends(text).tolist() == np.cumsum([len(x) for x in lines], dtype=int).tolist()


def plain(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text):
        return doc_id, len(lines), "plain", None, None, text, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(lines), form, len(prefix), len(middle), output, text


def test_equals_plain_version(spark):
    texts = [*TEXTS, None, "has <M> in\nit", "<P\n><S\n>", "<<S\n<S", "tie\ntie\ntie", "tie\ntie\ntie"]
    rows = [(i, t) for i, t in enumerate(texts * 4)] + [(None, "no\nid"), (3, "again\n"), (3, "again\n"), (-5, "a\nb")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, form string, n int")
    found = sorted(map(repr, map(tuple, fm.fill_in_middle(docs).collect())))
    assert found == sorted(repr(plain(*r)) for r in rows)
    assert fm.fill_in_middle(docs.limit(0)).collect() == []


def test_query_on_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = [plain(*d) for d in docs]
    expected = [(*e[:5], *(hashlib.sha256(t.encode()).hexdigest() for t in e[5:])) for e in expected]
    assert sorted(map(tuple, QUERIES["op12_fill_middle"](spark, folder).collect())) == sorted(expected)


def test_rates(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "'a\nb\nc\nd' AS text")
    forms = [r.form for r in fm.fill_in_middle(docs, changed_percent=60, spm_percent=20).collect()]
    assert 0.5 < 1 - forms.count("plain") / 400 < 0.7 and 0.1 < forms.count("spm") / (400 - forms.count("plain")) < 0.3
    assert {r.form for r in fm.fill_in_middle(docs, changed_percent=0).collect()} == {"plain"}
