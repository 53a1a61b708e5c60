import hashlib

from pyspark.sql import functions as F

from shelfmark.llm import warc_fixity as wf


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, archive string")


def _root(leaves, fanout):
    """Digest of an archive's tree by the definition; leaves are (sha256, begin, stop)."""
    level = [(hashlib.sha256(f"{s}:{b}:{e}".encode()).hexdigest(), b, e) for s, b, e in leaves]
    while len(level) > 1:
        groups = [level[i:i + fanout] for i in range(0, len(level), fanout)]
        level = [(hashlib.sha256(f"{''.join(d for d, _, _ in g)}:{g[0][1]}:{g[-1][2]}".encode()).hexdigest(), g[0][1], g[-1][2])
                 for g in groups]
    return level[0][0]


ROWS = [(i, f"http://a/{i}", f"<p>{'é' * i}</p>") for i in range(100)]


def test_damage_is_located(spark):
    rows = ROWS + [(None, None, None), (7, "http://a/7", "again"), (7, "http://a/7", "again"), (8, "u", "y" * 100_000)]
    copy = [(i, u, h if i != 40 else h + "!") for i, u, h in rows if i != 12] + [(500, "new", "page")]
    found = wf.fixity_audit(wf.archive_records(_pages(spark, rows), 64), wf.archive_records(_pages(spark, copy), 64), 4).collect()
    states = {}
    for r in found:
        states.setdefault(r.status, []).append(r.page_id)
    assert (states.pop("altered"), states.pop("missing"), states.pop("extra")) == ([40], [12], [500])
    assert len(states["intact"]) == len(rows) - 2
    for archive in {r.archive for r in found if r.status != "extra"}:
        own = sorted((r for r in found if r.archive == archive and r.status != "extra"), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own))) and own[0].begin == 0
        assert all(a.stop == b.begin for a, b in zip(own, own[1:]))
        leaves = [(r.sha256, r.begin, r.stop) for r in own]
        root = _root(leaves, 4)
        height = len(wf.merkle_levels(wf.fixity_leaves(wf.archive_records(_pages(spark, rows), 64)), 4))
        for _ in range(height - 1 - _height(len(own), 4)):  # a lone node is carried up
            root = hashlib.sha256(f"{root}:{own[0].begin}:{own[-1].stop}".encode()).hexdigest()
        assert {r.root for r in own} == {root}


def _height(leaves, fanout):
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // fanout), height + 1
    return height


def test_equal_archives_read_nothing_below_the_roots(spark):
    leaves = wf.fixity_leaves(wf.archive_records(_pages(spark, ROWS), 16))
    tree = wf.merkle_levels(leaves, 4)
    assert len(tree) == 3
    assert wf.audit(tree, [tree[0].limit(0), tree[1].limit(0), tree[2]], 4).collect() == []


def test_only_records_of_differing_leaves_are_matched(spark, monkeypatch):
    kept = {}
    original = wf.stored
    monkeypatch.setattr(wf, "stored", lambda df, label: kept.setdefault(label, []).append(original(df, label)) or kept[label][-1])
    records = wf.archive_records(_pages(spark, ROWS), 16)
    changed = wf.archive_records(_pages(spark, [(i, u, h + "!" if i == 33 else h) for i, u, h in ROWS if i != 70]), 16)
    found = wf.fixity_audit(records, changed, 4)
    assert sorted((r.page_id, r.status) for r in found.collect() if r.status != "intact") == [(33, "altered"), (70, "missing")]
    # 33 is longer and 70 is lost, so what follows them in their archives is looked at and no other archive.
    assert {r.archive for level in kept["suspects"] for r in level.collect()} == {33 // 16, 70 // 16}
    kept.clear()
    assert {r.status for r in wf.fixity_audit(records, records, 4).collect()} == {"intact"}
    assert sum(level.count() for level in kept["suspects"]) == 0 and kept["damage"][0].count() == 0


def test_pages_without_id_are_spread(spark):
    rows = [(None, f"http://a/{i}", "x") for i in range(200)] + [(None, None, None)] * 3 + ROWS[:5]
    records = wf.archive_records(_pages(spark, rows))
    assert records.where("page_id IS NULL").select("archive").distinct().count() > 150
    copy = [r for r in rows if r[1] != "http://a/7" or r[0] is not None] + [(None, "new", "x")]
    found = [r.status for r in wf.fixity_audit(records, wf.archive_records(_pages(spark, copy))).collect()]
    assert len(found) == len(rows) + 1 and (found.count("missing"), found.count("extra")) == (1, 1)


def test_record_text(spark):
    record = wf.archive_records(_pages(spark, ROWS[2:3])).first()
    head, body = record.record.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\n") and "Content-Length: 11" in head and body == "<p>éé</p>\r\n\r\n"


def test_everything_or_nothing_lost(spark):
    records = wf.archive_records(_pages(spark, ROWS[:5]))
    none = records.limit(0)
    assert {r.status for r in wf.fixity_audit(records, none).collect()} == {"missing"}
    assert {r.status for r in wf.fixity_audit(none, records).collect()} == {"extra"}
    assert {r.status for r in wf.fixity_audit(records, records.withColumn("note", F.lit(1))).collect()} == {"intact"}
    assert wf.fixity_audit(none, none).collect() == []
