"""Indexed BAM files: cut anywhere they give the records of the whole file; regions give what a filter over all records gives."""

import random
import struct
import zlib

import pytest

from lociforge.sources import bam

CONTIGS = [("chr1", 2_000_000), ("chr:2", 500_000), ("empty", 9)]


def block(plain):
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(plain) + packer.flush()
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\0BC\x02\0" + struct.pack("<H", len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(plain), len(plain))


def record(name, ref, pos, ops):
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(ops), 4 if ref < 0 else 0, 4, -1, -1, 0) + name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for o, n in ops) + b"\x12\x48" + b"\xff" * 4
    return struct.pack("<i", len(body)) + body


def bin_of(start, end):
    return next(n for n in reversed(bam.bins_of(start, end)) if len([b for b in bam.bins_of(start, end) if level(b) == level(n)]) == 1)


def level(number):
    return sum(number >= first for first, _ in bam._LEVELS)


@pytest.fixture
def written(tmp_path):
    """A sorted file with mapped and unmapped records in blocks that cut records, and its index."""
    rng = random.Random(4)
    places = sorted((ref, rng.randrange(CONTIGS[ref][1] - 40_000)) for ref in (0, 1) for _ in range(700))
    rows = [(f"r{rng.randrange(500)}", ref, pos, [("S", 3), ("M", rng.randrange(1, 30_000)), ("D", 5)]) for ref, pos in places] + [(f"u{i}", -1, -1, []) for i in range(9)]
    head = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", len(CONTIGS)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in CONTIGS)
    parts = [record(*r) for r in rows]
    plain, size = head + b"".join(parts), 777
    blocks, starts = [block(plain[i : i + size]) for i in range(0, len(plain), size)], [0]
    for b in blocks:
        starts.append(starts[-1] + len(b))
    (tmp_path / "s.bam").write_bytes(b"".join(blocks) + block(b""))
    virtual, at = [], len(head)
    for part in [*parts, b""]:
        virtual.append(starts[at // size] << 16 | at % size)
        at += len(part)
    bins, windows = [{} for _ in CONTIGS], [[] for _ in CONTIGS]
    for i, (_, ref, pos, ops) in enumerate(rows):
        if ref >= 0:
            end = pos + bam._span(ops)
            bins[ref].setdefault(bin_of(pos, end), []).append((virtual[i], virtual[i + 1]))
            windows[ref] += [0] * ((end - 1 >> 14) + 1 - len(windows[ref]))
            for w in range(pos >> 14, (end - 1 >> 14) + 1):
                windows[ref][w] = windows[ref][w] or virtual[i]
    data = b"BAI\x01" + struct.pack("<i", len(CONTIGS))
    for found, least in zip(bins, windows):
        data += struct.pack("<i", len(found) + 1) + struct.pack("<IiQQQQ", bam._SUMMARY_BIN, 2, 1, 2, 3, 4)
        data += b"".join(struct.pack("<Ii", n, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks) for n, chunks in found.items())
        data += struct.pack("<i", len(least)) + struct.pack(f"<{len(least)}Q", *least)
    (tmp_path / "s.bam.bai").write_bytes(data)
    return str(tmp_path / "s.bam"), rows


def _read(spark, path, **options):
    spark.dataSource.register(bam.BamDataSource)
    return spark.read.format("bam").options(**options).load(path)


def _plain(rows):
    return [(r.read_name, r.ref_id, r.pos0, [tuple(x) for x in r.cigar], r.seq) for r in rows]


@pytest.mark.parametrize("split", [1, 5000, 1 << 25])
def test_every_cut_gives_all_records(spark, written, split):
    path, rows = written
    table = _read(spark, path, splitBytes=split)
    got = table.orderBy("aln_no").collect()
    assert _plain(got) == [(*r, "ACGT") for r in rows] and len({r.aln_no for r in got}) == len(rows)
    assert (table.rdd.getNumPartitions() > 3) == (split < 1 << 25)


def test_without_an_index_a_file_is_one_part(spark, written, tmp_path):
    path, rows = written
    (tmp_path / "s.bam.bai").unlink()
    got = _read(spark, path).orderBy("aln_no").collect()
    assert _plain(got) == [(*r, "ACGT") for r in rows] and [r.aln_no for r in got] == list(range(1, len(rows) + 1))
    with pytest.raises(Exception, match="regions need an index"):
        _read(spark, path, regions="chr1").collect()


@pytest.mark.parametrize("text", ["chr1", "chr:2", "chr:2:100-20000", "chr1:500000-500000", "chr1:16385-32768,chr1:20000-60000,chr:2:1-5", "chr1:1900000", "empty", "chr1:1-90000000"])
def test_regions_give_what_a_filter_gives(spark, written, text):
    path, rows = written
    regions = bam.parse_regions(text, CONTIGS)
    want = [(*r, "ACGT") for r in rows if any(r[1] == ref and r[2] < en and r[2] + bam._span(r[3]) > st for ref, st, en in regions)]
    assert _plain(_read(spark, path, regions=text).orderBy("aln_no").collect()) == want
    assert want or text in ("empty", "chr1:500000-500000")


def test_regions_are_named_by_the_header():
    assert bam.parse_regions("chr1:5-9, chr:2", CONTIGS) == [(0, 4, 9), (1, 0, 500_000)]
    with pytest.raises(ValueError, match="unknown contig"):
        bam.parse_regions("chr9:1-2", CONTIGS)


def test_reads_of_a_small_region_skip_most_blocks(written):
    path, _ = written
    index = bam._index(path)
    ranges = bam.region_ranges(index, [(0, 1_000_000, 1_000_100)])
    assert sum((hi >> 16) - (lo >> 16) for lo, hi in ranges) < 0.2 * max(hi >> 16 for found, _ in index for chunks in found.values() for _, hi in chunks)
