"""Readers: columns by name, records that can't be read."""

import pytest

from mentionflow.sources import tables


def test_columns_by_header_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text('specialty,kol_name,extra,kol_id\nUrology,"Jane ""J"" Roe",x,K1\n,"Two\nlines",y,K2\n')
    got = {tuple(r) for r in tables.read_roster(spark, f"file://{tmp_path}/r.csv").collect()}
    assert got == {("K1", 'Jane "J" Roe', None, None, "Urology"), ("K2", "Two\nlines", None, None, None)}
    assert tables.quarantined(spark, f"file://{tmp_path}/r.csv", tables.ROSTER).count() == 0


def test_files_with_other_headers_raise(spark, tmp_path):
    (tmp_path / "r.csv").mkdir()
    (tmp_path / "r.csv" / "a.csv").write_text("kol_id,kol_name\nK1,Ann\n")
    (tmp_path / "r.csv" / "b.csv").write_text("kol_name,kol_id\nBo,K2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_roster(spark, f"file://{tmp_path}/r.csv").collect()


def test_broken_records_are_kept_apart(spark, tmp_path):
    good = '{"kol_id": "K1", "roster_seq": 1, "item_pos": 3, "results": [{"url": "u"}]}'
    bad = ['{"kol_id": "K2", "results": [{', "no json at all", '{"kol_id": "K3", "roster_seq": "one"}']
    (tmp_path / "i.json").write_text("\n".join([good, *bad, "", good]) + "\n")
    path = f"file://{tmp_path}/i.json"
    rows = tables.read_serp_items(spark, path).collect()
    assert [(r.kol_id, r.roster_seq, r.results[0].url) for r in rows] == [("K1", 1, "u")] * 2
    assert {r.record for r in tables.quarantined(spark, path, tables.SERP_ITEMS).collect()} == set(bad)
    (tmp_path / "l.csv").write_text("kol_id,roster_seq,cluster_no,query,status,error\nK1,1,,q,failed,\nK1,x,2,q,ok,\nK1,1,3,q,ok\nK2,1,3,q,ok,\n")
    log = f"file://{tmp_path}/l.csv"
    assert sorted((r.kol_id, r.cluster_no or 0) for r in tables.read_fetch_log(spark, log).collect()) == [("K1", 0), ("K2", 3)]
    n = tables.keep_quarantined(spark, {"items": (path, tables.SERP_ITEMS), "log": (log, tables.FETCH_LOG)}, f"file://{tmp_path}/q")
    assert {(r.source, r.n) for r in n.collect()} == {("items", 3), ("log", 2)}
