"""WARC round trips and delta-maintained rollups."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from weft.llm import rollups, warc
from weft.llm.common import open_store
from weft.session import scratch_path

BIG = "<p>" + "same body " * 200


def _pages(spark):
    rows = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/9 x\n", BIG), (3, None, "short"), (4, "http://b", "short"),
            (5, "http://c", None), (6, "http://d", ""), (7, "http://é", "ü" * 700), (8, "http://f", "ü" * 700), (None, "http://n", BIG),
            (10, "u", "z" * 3_000_000), (11, "u", "y" * 999), (12, "u", "y" * 999)]
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], "page_id long, url string, html string, digest int, path string").repartition(3)


def _wanted(pages):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    out = []
    for i, body in rows:
        same = [j for j, b in rows if b == body and j is not None]
        first = max(same, default=None)
        revisit = len(body) >= 1000 and i != first
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    pages = _pages(spark)
    index = warc.write_warc(pages, scratch_path(spark, "w"))
    back = warc.read_warc(index).collect()
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in back), key=str) == _wanted(pages)
    bodies = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert all(bytes(r.payload) == bodies[r.page_id] for r in back if r.record_type == "response")
    assert {r.page_id: r.url for r in back}[9] == "http://a/9%20x%0A" and {r.page_id: r.url for r in back}[3] is None
    # only the selected records are read
    some = warc.read_warc(index.where("page_id in (2, 10)")).collect()
    assert sorted(r.page_id for r in some) == [2, 10]
    # a file is a row of gzip members that ordinary readers take
    row = index.where("page_id = 10").first()
    store, place = open_store(row.path)
    with store.open_input_stream(place, compression=None) as file:
        assert gzip.decompress(file.read()).count(b"WARC/1.1\r\n") == index.where(index.path == row.path).count()


def test_warc_empty_table_and_damage(spark):
    index = warc.write_warc(_pages(spark).where("false"), scratch_path(spark, "w"))
    assert warc.read_warc(index).count() == 0
    good = warc.record_bytes(1, "u", b"body", "0" * 40, None, False)
    with pytest.raises(ValueError):
        warc.parse_record(gzip.compress(good))


def test_ranges_are_coalesced():
    places = [(0, 100), (100, 50), (200, 10), (200 + warc.GAP_BYTES + 11, 5), (500_000, warc.READ_BYTES + 1), (500_000 + warc.READ_BYTES + 1, 4)]
    got = list(warc.ranges(places))
    assert [(a, n, len(k)) for a, n, k in got] == [(0, 210, 3), (200 + warc.GAP_BYTES + 11, 5, 1), (500_000, warc.READ_BYTES + 1, 1), (500_000 + warc.READ_BYTES + 1, 4, 1)]
    assert list(warc.ranges([])) == []


CHANGES = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def _totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_rollup_batches_are_signed_and_idempotent(spark):
    roll = rollups.Rollup(spark, scratch_path(spark, "r"))
    assert _totals(roll) == {}
    first = spark.createDataFrame([("insert", "a", "en", "t1", 10, None), ("insert", "a", "en", "t1", 5, None), ("insert", None, None, "t1", 7, None),
                                   ("insert", "a", "en", "t2", None, None)], CHANGES)
    assert roll.commit("b1", first)
    want = {("a", "en", "t1"): (2, 15), (None, None, "t1"): (1, 7), ("a", "en", "t2"): (1, 0)}
    assert _totals(roll) == want
    assert not roll.commit("b1", first) and _totals(roll) == want
    second = spark.createDataFrame([("delete", "a", "en", "t1", 5, None), ("revise", "a", "en", "t1", 12, 10), ("delete", None, None, "t1", 7, None)], CHANGES)
    assert roll.commit("b2", second)
    want = {("a", "en", "t1"): (1, 12), ("a", "en", "t2"): (1, 0)}
    assert _totals(roll) == want
    roll.compact()
    assert _totals(roll) == want
    assert not roll.commit("b2", second) and not roll.commit("b1", first)
    assert roll.commit("b3", spark.createDataFrame([], CHANGES)) and _totals(roll) == want
    roll.compact()
    assert roll.commit("b4", first) and _totals(roll) == {("a", "en", "t1"): (3, 27), ("a", "en", "t2"): (2, 0), (None, None, "t1"): (1, 7)}


def test_rollup_ignores_a_batch_that_broke_off(spark):
    folder = scratch_path(spark, "r")
    roll = rollups.Rollup(spark, folder)
    rows = spark.createDataFrame([("insert", "a", "en", "t", 10, None)], CHANGES)
    roll.commit("b1", rows)
    store, place = open_store(f"{folder}/batch=b1/_SUCCESS")
    store.delete_file(place)  # as after a writer's loss
    assert _totals(roll) == {}
    assert roll.commit("b1", rows) and _totals(roll) == {("a", "en", "t"): (1, 10)}


def test_of_two_senders_of_a_batch_one_counts(spark, monkeypatch):
    folder = scratch_path(spark, "r")
    roll, other = rollups.Rollup(spark, folder), rollups.Rollup(spark, folder)
    rows = spark.createDataFrame([("insert", "a", "en", "t", 10, None)], CHANGES)
    real = rollups.deltas

    def late(changes):  # the other sender commits while this one is at work
        monkeypatch.setattr(rollups, "deltas", real)
        assert other.commit("b1", rows)
        return real(changes)

    monkeypatch.setattr(rollups, "deltas", late)
    assert not roll.commit("b1", rows)
    assert _totals(roll) == {("a", "en", "t"): (1, 10)} and set(roll._listed()) == {"batch=b1"}


def test_rollup_expires_what_is_folded(spark):
    roll = rollups.Rollup(spark, scratch_path(spark, "r"))
    rows = spark.createDataFrame([("insert", "a", "en", "t", 10, None)], CHANGES)
    for k in range(3):
        roll.commit(f"b{k}", rows)
        roll.compact()
    roll.commit("b3", rows)
    assert roll.expire() == 3 + 4 and set(roll._listed()) == {"batch=b3", "ids=3", "folded=3"}
    assert _totals(roll) == {("a", "en", "t"): (4, 40)} and not roll.commit("b1", rows) and roll.expire() == 0


def test_rollup_rejects_unknown_changes_and_ids(spark):
    roll = rollups.Rollup(spark, scratch_path(spark, "r"))
    with pytest.raises(Exception):
        roll.commit("b", spark.createDataFrame([("upsert", "a", "en", "t", 1, 1)], CHANGES))
    with pytest.raises(Exception):
        roll.commit("b", spark.createDataFrame([(None, "a", "en", "t", 1, 1)], CHANGES))
    with pytest.raises(ValueError):
        roll.commit("../b", spark.createDataFrame([], CHANGES))


def test_rollup_query_on_null_ids_equals_its_sql(spark, tmp_path):
    import duckdb

    docs = [(1, "en", "a", "some words, here"), (None, "en", "a", "some words, here"), (None, "de", "b", "no id at all"), (None, "de", "b", "no id at all"),
            (None, "de", "b", None), (2, "en", "a", None), (3, "en", "b", "Toxic one!"), (5, "en", "b", "some words, here")]
    spark.createDataFrame(docs, "doc_id long, lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1), (1, 0), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = sorted(con.execute(rollups.OP10_SQL).fetchall())
    assert sorted(tuple(r) for r in rollups.op10_token_rollups(spark, str(tmp_path)).select("source", "lang", "tokenizer", "n_docs", "n_tokens").collect()) == want
