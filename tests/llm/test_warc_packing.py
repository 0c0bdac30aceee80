"""Archives and packing."""

import gzip
import zlib

import numpy as np
import pytest

from mentionflow.llm import packing, warc
from mentionflow.llm.common import Scratch


def test_arc_versions_and_lengths(spark, tmp_path):
    v1 = warc.arc_head(1, "a.arc", "19990101000000") + b"\n" + warc.arc_record(1, "http://a/?x%20y", "19990102030405", warc.http_body(5, b"new\n\nhttp://fake 0 0 0 9\n"), 0, "a.arc") + b"\n" + b"dns:a 1.2.3.4 19990102 text/dns 3\nabc\n"
    v2 = warc.arc_head(2, "b.arc", "19990101000000") + b"\n" + warc.arc_record(2, "http://b/", "199901020304", b"HTTP/1.0 200 OK\r\n\r\n\xff\x00", 0, "b.arc") + b"\n"
    (tmp_path / "a.arc").write_bytes(v1)
    (tmp_path / "b.arc.gz").write_bytes(b"".join(zlib.compress(x, wbits=31) for x in (v2[:60], v2[60:])))
    got = {r.url: r for r in warc.read_arc(spark, f"file://{tmp_path}").collect()}
    assert set(got) == {"http://a/?x%20y", "dns:a", "http://b/"}
    a, d, b = got["http://a/?x%20y"], got["dns:a"], got["http://b/"]
    assert (a.page_id, bytes(a.payload), a.date, a.kind) == (5, b"new\n\nhttp://fake 0 0 0 9\n", "1999-01-02T03:04:05Z", "response")
    assert (d.page_id, bytes(d.payload), d.kind, d.date) == (None, b"abc", "resource", "1999-01-02T00:00:00Z")
    assert bytes(b.payload) == b"\xff\x00" and b.date == "1999-01-02T03:04:00Z" and len({x.record_id for x in got.values()}) == 3
    warc.convert(spark, f"file://{tmp_path}", f"file://{tmp_path}/warc", Scratch(spark, "test"))
    back = {r.url: (r.record_type, r.payload_bytes, r.payload_digest) for r in warc.read_warc(spark, f"file://{tmp_path}/warc").collect()}
    assert back == {u: (r.kind, r.payload_bytes, r.payload_digest) for u, r in got.items()}


def test_pages_with_copies(spark):
    import hashlib

    big = "é<\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(1, "u1", big), (2, "u 2", big), (3, None, big), (4, "u4", "small"), (5, "u5", "small"), (6, "u6", None), (7, "u7", ""), (1, "again", big), (None, "n", big), (8, "u8", "x" * 100), (9, "u9", "x" * 100), (10, "u10", "x" * 99), (11, "u11", "x" * 99), (12, "u/" + "é" * 40_000, "after a long url")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(df.repartition(3)).collect()), key=str)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [j for j, _, k in rows if j is not None and (k or "").encode() == data]
        first = min(ids) if len(data) >= 100 else i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if i == first else "revisit", None if i == first else first))
    assert got == sorted(want, key=str)
    assert warc.archived(df.limit(0)).count() == 0


def test_archives_that_cannot_be_read(spark):
    head = warc.arc_head(1, "a.arc", "19990101000000") + b"\n"
    record = warc.arc_record(1, "http://a/", "19990102030405", warc.http_body(5, b"abc"), 0, "a.arc")
    read = lambda data: list(warc.arc_records(warc.Stream(data)))
    assert len(read(head + record + b"\n" + record)) == 2 and read(b"") == [] and read(head) == []
    packed = zlib.compress(head + record, wbits=31)
    assert len(read(packed)) == 1 and len(read(packed + packed + b"\0" * 9)) == 2
    for bad in (head + record[:-1], head + record + b"\nnot a header\n", head + b"http://a/ 0.0.0.0 1999 3\nabc", head + b"http://a/ 0", packed[:-9], packed + b"x"):
        with pytest.raises(ValueError):
            read(bad)
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    back = lambda data: [block for _, block in warc.warc_records(warc.Stream(data))]
    assert back(whole * 2) == [b"abc", b"abc"] and back(b"") == []
    for bad in (whole[:-1], whole[:-6], whole + b"junk", whole.replace(b"3", b"2"), whole.replace(b"Content-Length: 3\r\n", b"")):
        with pytest.raises(ValueError):
            back(bad)


def test_archives_roll_and_pages_may_have_any_url(spark, tmp_path):
    rows = [(i, "filedesc://x.arc" if i % 5 == 0 else f"http://a/{i}", f"page {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_arc(df, f"file://{tmp_path}/arc", limit=2000)
    files = list((tmp_path / "arc").rglob("*.gz"))
    assert len(files) > 5 and all(len(gzip.decompress(f.read_bytes())) <= 2000 for f in files)
    got = {(r.page_id, r.url, bytes(r.payload).decode()) for r in warc.read_arc(spark, f"file://{tmp_path}/arc").collect()}
    assert got == set(rows)


def test_files_keep_to_their_bytes(spark, tmp_path):
    """Large pages among small ones, many of them the same: a file holds what fits, a larger page is alone in its file."""
    large = "x" * 20_000_000
    rows = [(i, f"http://a/{i}", large if i % 4 == 0 else "y" * (i * 1000) if i % 4 == 1 else "z" * 200) for i in range(24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_arc(df, f"file://{tmp_path}/arc", limit=30_000)
    warc.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc", Scratch(spark, "test"), limit=30_000)
    for folder, marks in (("arc", b"Archive-length"), ("warc", b"WARC/1.1")):
        for f in (tmp_path / folder).rglob("*.gz"):
            data = gzip.decompress(f.read_bytes())
            assert len(data) <= 30_000 or data.count(marks) == 1 and data.count(b"X-Page-Id") == 1
    back = {r.page_id: (r.record_type, r.payload_bytes) for r in warc.read_warc(spark, f"file://{tmp_path}/warc").collect()}
    firsts = {html: min(i for i, _, h in rows if h == html) for _, _, html in rows}
    assert back == {i: ("response" if firsts[h] == i or len(h) < 100 else "revisit", len(h)) for i, _, h in rows}


@pytest.mark.parametrize("run", [" ", "\n", "\t", "\u3000"])
def test_long_runs_of_blanks(run):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    encode = packing.Tokens(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    text = "a" + run * 1_000_000 + "b"
    assert encode(text) == Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


def test_bins_of_different_groups_meet(spark, docs):
    """More underfull bins than a group may have: they are dealt out anew until that no longer helps."""
    texts = [(i, "word " * 39) for i in range(300)]  # 40 tokens: three in a sequence of 128
    rows = packing.packed(docs(texts), capacity=128, group_rows=10, fan_in=2).collect()
    assert check(rows, texts, 128)[0] <= 104


def test_ranks_and_vocabulary_agree(spark):
    """Ids come from the ranks file of the vocabulary: the same as the tokenizers library gives, on all documents."""
    import public_tokenizers as P
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.Tokens(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").toLocalIterator():
        assert encode(r.text or "") == whole.encode(r.text or "", add_special_tokens=False).ids


def test_cut():
    assert packing.cut(1, 8) == [(0, 1)] and packing.cut(8, 8) == [(0, 8)] and packing.cut(17, 8) == [(0, 1), (1, 8), (9, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_least_room(seed):
    sizes = np.random.default_rng(seed).integers(1, 64, 300).tolist()
    got = packing.best_fit(sizes, 64)
    rooms: list[int] = []
    for s, at in zip(sizes, got, strict=True):
        fits = [r for r in rooms if r >= s]
        if at == len(rooms):
            assert not fits
            rooms.append(64)
        else:
            assert rooms[at] == min(fits)
        rooms[at] -= s


def check(rows, texts, capacity):
    from collections import Counter, defaultdict

    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in texts:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), capacity)):
            want[i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(by_seq), -(-sum(r.length for r in rows) // capacity)


def test_packing_in_levels(spark, docs):
    texts = [(i, "word " * (1 + i * 37 % 90)) for i in range(500)] + [(7, "same"), (7, "same"), (None, None), (900, ""), (901, "<|endoftext|> a <|endoftext|>"), (902, "  \n\t  x é日本🎉 'll" * 30)]
    rows = packing.packed(docs(texts), capacity=128, group_rows=60, fan_in=3).collect()
    n, least = check(rows, texts, 128)
    assert n <= 1.03 * least + 2
    assert packing.packed(docs([])).count() == 0


def test_packing_query(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    n, least = check(packing.op4_best_fit_packing(spark, sf_dir).collect(), texts, 2048)
    assert n <= 1.02 * least + 1
