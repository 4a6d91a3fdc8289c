"""Round trips, and recovery from damaged archives."""

import gzip
import hashlib
import io
import random

from erascore.llm import warc as W

SCHEMA = "page_id long, url string, html string, kind string, digest string, first long"


def member(i, size=400):
    body = random.Random(i).randbytes(size).hex().encode()
    return W.record_bytes(i, f"http://h/{i}", body, hashlib.sha256(body).hexdigest(), None)


def read(data):
    out = list(W.salvage(io.BytesIO(data), len(data)))
    assert sum(x[2] for x in out) == len(data) and [x[1] for x in out] == sorted(x[1] for x in out)  # every byte is accounted for
    return [x[3]["warc-record-id"].strip("<>").rpartition(":")[2] for x in out if x[0] == "record"], [x[1:] for x in out if x[0] == "gap"]


def test_sound_archive():
    assert read(b"".join(member(i) for i in range(5))) == (["0", "1", "2", "3", "4"], [])
    assert read(b"") == ([], [])


def test_damage_costs_only_its_own_records():
    parts = [member(i) for i in range(6)]
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    flipped = bytearray(b"".join(parts))
    flipped[starts[2] + 200] ^= 0xFF
    got, gaps = read(bytes(flipped))
    assert got == ["0", "1", "3", "4", "5"] and [(a, n) for a, n, _ in gaps] == [(starts[2], len(parts[2]))]
    cut = b"".join([*parts[:2], parts[2][:100], *parts[3:]])
    got, gaps = read(cut)
    assert got == ["0", "1", "3", "4", "5"] and [(a, n) for a, n, _ in gaps] == [(starts[2], 100)]
    junk = b"junk \x1f\x8b\x08 WARC/1.0\r\nnot a record"
    got, gaps = read(parts[0] + junk + parts[1] + parts[2][:50])
    assert got == ["0", "1"] and [(a, n) for a, n, _ in gaps] == [(len(parts[0]), len(junk)), (len(parts[0] + junk + parts[1]), 50)]
    wrong = gzip.compress(gzip.decompress(parts[1]).replace(b"HTTP/1.1 200", b"HTTP/1.1 404"))
    got, gaps = read(parts[0] + wrong + parts[2])
    assert got == ["0", "2"] and gaps[0][2] == "block digest differs"


def test_plain_archives():
    plain = [gzip.decompress(member(i)) for i in range(4)]
    assert read(b"".join(plain)) == (["0", "1", "2", "3"], [])
    broken = plain[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert read(plain[0] + broken + plain[2] + plain[3])[0] == ["0", "2", "3"]
    assert read(plain[0] + plain[1][:90] + plain[2])[0] == ["0", "2"]


def test_members_of_several_records():
    plain = [gzip.decompress(member(i, 90_000 if i == 3 else 400)) for i in range(7)]
    one = gzip.compress(b"".join(plain))
    assert read(one) == ([str(i) for i in range(7)], [])
    assert read(member(8) + one + member(9))[0] == ["8", *map(str, range(7)), "9"]
    cut = one[:-60]  # the last record and the checksum are incomplete
    got, gaps = read(cut)
    assert got == [str(i) for i in range(6)] and len(gaps) == 1
    got, gaps = read(cut + member(9))
    assert got == [*map(str, range(6)), "9"] and len(gaps) == 1
    wrong = bytearray(one)
    wrong[-5] ^= 1  # the checksum differs: which record is wrong cannot be told
    assert read(bytes(wrong) + member(9))[0] == ["9"]
    bare = gzip.compress(b"".join(p.replace(b"WARC-Block-Digest", b"X-Digest") for p in plain))
    assert read(bare)[0] == [str(i) for i in range(7)] and read(bare[:-60])[0] == []


def test_headers_of_any_length():
    long = gzip.decompress(member(1)).replace(b"http://h/1", b"http://h/" + b"x" * (3 << 20))
    plain = [gzip.decompress(member(i)) for i in (0, 2)]
    assert read(plain[0] + long + plain[1]) == (["0", "1", "2"], [])
    assert read(member(0) + gzip.compress(long) + member(2)) == (["0", "1", "2"], [])


def test_random_damage_loses_no_other_record():
    parts = [member(i) for i in range(8)]
    whole = b"".join(parts)
    for seed in range(60):
        rnd, data = random.Random(seed), bytearray(whole)
        at = rnd.randrange(len(data))
        hit = next(i for i in range(8) if at < sum(map(len, parts[:i + 1])))
        data[at] ^= 1 << rnd.randrange(8)
        got, _ = read(bytes(data))
        assert set(got) >= {str(i) for i in range(8)} - {str(hit)}


def expected(rows):
    out = []
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "").encode() == body and p is not None]
        again = len(body) >= 100 and page is not None and page != min(same)
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    return sorted(out, key=repr)


def test_pages_come_back(spark):
    long, text = "ü" * 200_000, "<p>same é</p>" * 20
    rows = [(5, "http://a/\r\nX: y", text), (3, None, text), (9, "u", text), (3, "twice", text), (7, "u", "short"), (8, "u", "short"), (1, "u", None),
            (2, "u", ""), (None, "u", text), (10, "u", long), (11, "u", long), (12, "u", "\r\n\r\nWARC/1.0\r\n\x1f"), (-4, "u", long + "x")]
    rows = [(*r, "k", "d", 1) for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, W.page_report(frame).collect()), key=repr) == expected(rows)
    assert W.page_report(frame.limit(0)).collect() == []


def test_rolled_files_and_gaps_in_place(spark, tmp_path):
    frame = spark.createDataFrame([(i, "u", f"{i} " * 300) for i in range(50)], "page_id long, url string, html string").repartition(2)
    manifest = W.write_archives(frame, str(tmp_path / "w"), roll_bytes=2000)
    files = [r["archive"] for r in manifest.collect()]
    assert len(files) > 4
    with open(files[0], "r+b") as f:
        f.seek(30)
        f.write(b"\0\0\0\0")
    back = W.read_archives(manifest).collect()
    assert sum(r["kind"] == "gap" for r in back) == 1 and sum(r["kind"] == "record" for r in back) == 49
