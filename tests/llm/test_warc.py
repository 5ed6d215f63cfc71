from collections import Counter

import pytest

from tidemark.llm import warc

PAGES = "page_id bigint, url string, html string, record_type string, payload double"


def run(spark, rows, folder):
    pages = spark.createDataFrame([(*r, "x", 1.0) for r in rows], PAGES).repartition(3)
    manifest = warc.write_archives(pages, f"file://{folder}")
    return manifest, warc.read_archives(manifest).collect()


def test_round_trip(spark, tmp_path):
    rows = [(i, f"https://a.example/{i} é", "<p>" + "x" * (i * 37 % 500)) for i in range(40)]
    rows += [(50 + i, None, "same") for i in range(30)] + [(None, "u\n\r", "same"), (None, None, None), (99, "", ""), (100, "u", None)]
    rows += [(200, "u", "é😀\r\n\r\n" * 600_000), (7, "u", "again"), (7, "u", "again")]
    manifest, got = run(spark, rows, tmp_path / "w")
    holders = {}
    for p, _, h in rows:
        holders.setdefault(h or "", []).append(p)
    want = Counter()
    for p, _, h in rows:
        ids = [i for i in holders[h or ""] if i is not None]
        last = max(ids) if ids else None
        revisit = p != last
        data = (h or "").encode()
        want[(p, len(data), warc.digest_of(data), "revisit" if revisit else "response", last if revisit else None, None if revisit else data)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    # Single records by their ids; the whole bundle as any Zstandard reader has it.
    import zstandard

    for m in manifest.collect():
        reader = warc.Reader(m["path"])
        index = reader.index()
        assert m["n_frames"] == len(reader.frames)
        for rid in list(index)[:5]:
            fields, payload = reader.get(rid)
            assert fields["WARC-Record-ID"] == rid
            assert fields["WARC-Type"] == "revisit" or warc.digest_of(payload) == fields["WARC-Payload-Digest"][5:]
        plain = b"".join(bytes(reader.frame(k)) for k in range(len(reader.frames)))
        with open(m["path"].removeprefix("file://"), "rb") as f:
            assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == plain


def test_no_pages(spark, tmp_path):
    assert run(spark, [], tmp_path / "w")[1] == []


def test_damage_is_found(tmp_path):
    bundle = warc.Bundle(f"file://{tmp_path}")
    record = warc.make_record(1, "u", b"payload", warc.digest_of(b"other"), None, False)
    bundle.add("<urn:uuid:1>", record)
    path, *_ = bundle.close()
    with open(path.removeprefix("file://"), "r+b") as f:
        f.truncate(f.seek(0, 2) - 1)
    with pytest.raises(ValueError):
        warc.Reader(path)
