import base64
import glob
import hashlib
import io
import random

import pytest
import zstandard

from tillcast.llm import warc as W


def brute(rows, min_bytes=0):
    first, count = {}, {}
    for i, _, html in rows:
        body = (html or "").encode()
        count[body] = count.get(body, 0) + 1
        if i is not None:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        owner = first.get(body)
        again = len(body) >= min_bytes and count[body] > 1 and owner is not None and owner != i
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", owner if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("records", "limit", "least"), [(1000, 16 << 20, 0), (7, 16 << 20, 0), (7, 3000, 500)])
def test_round_trip(spark, tmp_path, monkeypatch, records, limit, least):
    rnd = random.Random(1)
    body = lambda k: "<html><p>Ünïcode " + "".join(rnd.choices("abc <>&\r\n\0P*M\x18", k=k)) + "</p></html>"
    pool = [body(rnd.randrange(900)) for _ in range(40)] + ["", None, "x", body(400_000)]
    rows = [(i, rnd.choice([f"http://e.com/{i}?q=é", None, "bad\r\nurl: x"]), rnd.choice(pool)) for i in range(150)]
    rows += [(3, "http://again", rows[3][2]), (None, "no id", pool[0]), (None, None, "own page without an id"), (None, None, "own page without an id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int").repartition(2)
    monkeypatch.setattr(W, "ARCHIVE_RECORDS", records)
    # constants reach Spark's tasks through the functions' module, so set them there too
    run = W._archives

    def held(batches):
        W.ARCHIVE_RECORDS, W.ARCHIVE_BYTES = records, limit
        yield from run(batches)

    monkeypatch.setattr(W, "_archives", held)
    folder = str(tmp_path / "w")
    W.write_warc(df, folder, min_bytes=least)
    got = W.read_warc(spark, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows, least)
    texts = {hashlib.sha1((h or "").encode()).digest(): (h or "").encode() for _, _, h in rows}
    assert all(r.payload == texts[base64.b32decode(r.payload_digest)] for r in got if r.record_type == "response")
    for name in glob.glob(folder + "/*.warc.zst"):
        data = open(name, "rb").read()
        size = int.from_bytes(data[4:8], "little")
        assert int.from_bytes(data[:4], "little") == 0x184D2A5D
        kind = zstandard.DICT_TYPE_AUTO
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size], dict_type=kind)).stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert plain == b"".join(W.frames(data)) and plain.startswith(b"WARC/1.1\r\n")
        assert 1 <= plain.count(b"WARC/1.1\r\nWARC-Type") <= records


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive_pages(df, str(tmp_path / "w")).count() == 0


def test_damage(spark):
    data = b"".join(W.archive([W.record(1, "u", b"payload", None)]))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(W.frames(data[:-6]))
    assert [W.parse(x)["payload"] for x in W.frames(data)] == [b"payload"]
    with pytest.raises(ValueError):
        W.parse(W.record(1, "u", b"payload", None).replace(b"payload\r\n", b"paylord\r\n"))
