import hashlib
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.sources import byteranges, files


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(7)
    out = tmp_path_factory.mktemp("ranges")
    lines = [b"x" * rng.choice([0, 1, 5, 300, 4000]) + b"\xc3\xa9" * rng.randint(0, 3) for _ in range(300)]
    (out / "a.txt").write_bytes(b"\n".join(lines) + b"\n")
    (out / "b.txt").write_bytes(b"first\n\n\nlast without end")
    (out / "c.txt").write_bytes(b"")
    (out / "d.bin").write_bytes(rng.randbytes(3_000_001))
    (out / "e.txt").write_bytes(b"\n" * 10)
    (out / "_hidden").write_bytes(b"no\n")
    return out


@pytest.mark.parametrize("size", [7, 100, 4096, 1 << 20])
@pytest.mark.parametrize("name", ["a.txt", "b.txt", "c.txt", "e.txt"])
def test_lines_of_ranges_come_once(spark, folder, name, size):
    if size == 7 and name == "a.txt":
        size = 911
    out = byteranges.read_ranges(spark, f"{folder}/{name}", size)
    raw = (folder / name).read_bytes()
    want, at = [], 0
    for line in raw.split(b"\n")[:-1] + ([raw.split(b"\n")[-1]] if raw.split(b"\n")[-1] else []):
        want.append((at, line.decode()))
        at += len(line) + 1
    assert sorted((r.start, r.value) for r in out.collect()) == want
    if raw:
        assert out.rdd.getNumPartitions() == -(-len(raw) // size)


def test_folder(spark, folder):
    out = byteranges.read_ranges(spark, f"file://{folder}", 1 << 20).groupBy(F.element_at(F.split("path", "/"), -1).alias("f")).count()
    assert {r.f: r["count"] for r in out.filter("f <> 'd.bin'").collect()} == {"a.txt": 300, "b.txt": 4, "e.txt": 10}


def joined(df):
    return b"".join(bytes(r.data) for r in df.orderBy("start").collect())


def test_read_at_any_place(spark, folder, monkeypatch):
    raw, path = (folder / "d.bin").read_bytes(), f"{folder}/d.bin"
    for offset, n in ((0, 10), (5, 0), (1000, 5000), (2_999_999, 50), (3_000_001, 4), (0, -1), (1_048_570, 20)):
        assert joined(byteranges.read_at(spark, path, offset, n)) == raw[offset : None if n < 0 else offset + n]
    assert joined(byteranges.read_at(spark, path, -7, 3, 2)) == raw[-7:-4] and joined(byteranges.read_at(spark, path, 0, 5, 2)) == b""
    assert joined(byteranges.head_bytes(spark, path, 33)) == raw[:33]
    assert joined(byteranges.tail_bytes(spark, path, 33)) == raw[-33:] and joined(byteranges.tail_bytes(spark, f"{folder}/b.txt", 999)) == (folder / "b.txt").read_bytes()
    for bad in ((-1, 0), (1, 2), (0, 1)):
        with pytest.raises(files.SourceError):
            byteranges.read_at(spark, path, bad[0], 1, bad[1])
    with pytest.raises(Exception, match="no byte"):
        byteranges.read_at(spark, path, 3_000_002, 1).collect()
    with pytest.raises(Exception, match="no file"):
        byteranges.read_at(spark, f"{folder}/none", 0, 1).collect()


def test_tail_lines(spark, folder):
    lines = (folder / "a.txt").read_bytes().decode().split("\n")[:-1]
    for n in (1, 3, 299, 400):
        assert [r.value for r in byteranges.tail_lines(spark, f"{folder}/a.txt", n, first=64).collect()] == lines[-n:]


def model_crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def model_checksum(raw, block, crc):
    md5s = b""
    for at in range(0, len(raw), block):
        part = raw[at : at + block]
        md5s += hashlib.md5(b"".join(struct.pack(">I", crc(part[i : i + 512])) for i in range(0, len(part), 512))).digest()
    size = 32
    while size < len(md5s):
        size *= 2
    return hashlib.md5(md5s + bytes(size - len(md5s))).hexdigest()


def test_block_checksums(spark, folder):
    assert model_crc32c(b"123456789") == 0xE3069283  # the check value of CRC-32C
    assert byteranges.chunk_crcs(b"123456789").tolist() == [0xE3069283] and byteranges.chunk_crcs(b"").tolist() == []
    for block in (512, 65536, 1 << 20, 1 << 27):
        got = {r.path.rsplit("/", 1)[1]: (r.blocks, r.checksum) for r in byteranges.block_checksums(spark, str(folder), block, "CRC32").collect()}
        if block == 512:
            got.pop("d.bin")
        for name, (blocks, checksum) in got.items():
            raw = (folder / name).read_bytes()
            assert (blocks, checksum) == (-(-len(raw) // block), model_checksum(raw, block, zlib.crc32))
    small = (folder / "a.txt").read_bytes()[:20_000]
    (folder / "f.txt").write_bytes(small)
    assert byteranges.block_checksums(spark, f"{folder}/f.txt", 1024).first().checksum == model_checksum(small, 1024, model_crc32c)
