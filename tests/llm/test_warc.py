"""Web archives: round trips, ZIP64, damage."""

import io
import zipfile
from collections import Counter

import pytest

from tidespan.llm import warc

ROWS = [(i, f"http://a.example/{i}", f"<p>{i % 7}</p>" * (1 + i % 3), i) for i in range(60)] + [
    (900, None, None, 0),
    (901, "broken\r\nurl%0A", "", 0),
    (902, "u", "é日本\r\n\r\n🙂", 0),
    (5, "again", "<p>5</p>" * 3, 0),
    (5, "again", "<p>5</p>" * 3, 0),
    (None, "no id", "same", 0),
    (None, "no id", "same", 0),
    (903, "long", "x" * 3_000_000, 0),
]
SCHEMA = "page_id long, url string, html string, payload int"


def wanted(rows, least=0):
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = Counter()
    for i, u, h, *_ in rows:
        body = (h or "").encode()
        of = first.get(h or "")
        revisit = of is not None and i != of and len(body) >= least
        kind, payload = ("revisit", None) if revisit else ("response", body)
        out[i, u, kind, payload, len(body), warc.digest_of(body), of if revisit else None] += 1
    return out


def rows_of(out):
    return Counter(
        (r.page_id, r.url, r.record_type, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest, r.refers_to)
        for r in out.collect()
    )


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    assert rows_of(warc.archive(pages, least=least)) == wanted(ROWS, least)


def test_keys_and_addresses_of_any_text(spark):
    """Texts as keys: empty, brackets, blanks, escapes, line ends; no key is not the empty key."""
    keys = ["", "a>", "<a>", " a ", "%41", "a\r\nb", "{x", "\x85\u2028", "é日🙂", None, "%", "urn:x-page:"]
    rows = [(k, k, f"<p>{i // 2}</p>") for i, k in enumerate(keys)]
    out = warc.archive(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert sorted(map(repr, ((r.page_id, r.url) for r in out))) == sorted(map(repr, ((k, k) for k in keys)))
    by = {r.page_id: r for r in out}
    for a, b in zip(keys[::2], keys[1::2], strict=True):
        if None not in (a, b):
            assert by[max(a, b)].refers_to == min(a, b) and by[min(a, b)].refers_to is None
    for page in keys:
        back = warc.parse(warc.record(page, page, b"x", None, False))
        assert (back.page, back.url, back.refers) == (page, page, None)


def test_many_packages_and_stretches(spark, monkeypatch):
    monkeypatch.setattr(warc, "STRETCH_BYTES", 700)
    folder = warc.scratch_dir(spark, "warc")
    packages = warc.write_packages(warc.with_revisits(spark.createDataFrame(ROWS, SCHEMA)), folder, package_bytes=2000)
    assert packages.count() > 4
    out = warc.read_records(warc.locate_records(packages, folder), folder)
    assert out.count() == len(ROWS)


def test_no_pages(spark):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).count() == 0


class Bytes(io.BytesIO):
    def read_at(self, length, offset):
        self.seek(offset)
        return self.read(length)


def package(comment=b"", limit=None, monkeypatch=None, method=zipfile.ZIP_STORED):
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", method) as z:
        with z.open("filler", "w", force_zip64=True) as f:
            f.write(b"z" * 5000)
        with z.open(warc.DATA_MEMBER, "w", force_zip64=True) as f:
            f.write(b"0123456789" * 100)
        z.writestr(warc.INDEX_MEMBER, "".join(
            f'- x {{"filename": "{warc.DATA_MEMBER}", "offset": "{o}", "length": "{n}"}}\n' for o, n in ((0, 10), (13, 4))
        ))
        z.comment = comment
    return raw.getvalue()


@pytest.mark.parametrize("comment", [b"", b"a comment", b"PK\x05\x06 in a comment " + b"y" * 60_000])
@pytest.mark.parametrize("limit", [None, 3000])
def test_directories(comment, limit, monkeypatch):
    raw = package(comment, limit, monkeypatch)
    if limit:
        assert warc.END64 in raw
    found = {m.name: m for m in warc.members(Bytes(raw), len(raw))}
    assert list(found) == ["filler", warc.DATA_MEMBER, warc.INDEX_MEMBER]
    assert found["filler"].size == found["filler"].packed == 5000
    at = warc.data_start(Bytes(raw), found[warc.DATA_MEMBER])
    assert raw[at : at + 1000] == b"0123456789" * 100
    places = list(warc.index_entries(Bytes(raw), len(raw)))
    assert [raw[o : o + n] for o, n in places] == [b"0123456789", b"3456"]


def test_what_cannot_be_read():
    with pytest.raises(ValueError, match="no end record"):
        warc.members(Bytes(b"nothing"), 7)
    raw = package(method=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="not stored"):
        list(warc.index_entries(Bytes(raw), len(raw)))
    good = warc.record("1", "u", b"payload", None, False)
    assert warc.parse(good).payload == b"payload"
    import gzip

    bad = gzip.compress(gzip.decompress(good).replace(b"payload\r\n", b"pAyload\r\n"))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(bad)
