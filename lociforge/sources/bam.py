"""BAM files as a Spark data source: ``spark.dataSource.register(BamDataSource)``, then ``spark.read.format("bam").load(path)``.

With an index (``.bai``) beside it a file is cut at records into partitions of about ``splitBytes`` (32 MB) of compressed data, and the option ``regions``
(``chr1:5-90,chr2``) reads only blocks that can hold records meeting them; without one a file is one partition.  Nothing is kept between records.
``aln_no`` rises in the file's order and is unique in a file: the record's virtual offset, or its number where there is no index.
"""

from __future__ import annotations

import glob
import gzip
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "sample_id string, read_name string, aln_no long, ref_id int, pos0 int, flag int, mapq int, cigar array<struct<op:string,len:int>>, seq string"
_OPS = "MIDNSHP=X"
_BASES = "=ACMGRSVTWYHKDBN"

#: Fixed values of the index's format: first bin number and width (as a shift) of each level, and the bin that holds a contig's summary.
_LEVELS = ((0, 29), (1, 26), (9, 23), (73, 20), (585, 17), (4681, 14))
_SUMMARY_BIN = 37450


def detect_format(head: bytes, path: str = "") -> str:
    """``bam``, ``cram`` or ``sam`` by the first bytes, else by the name's end."""
    if head[:2] == b"\x1f\x8b":
        return "bam"
    if head[:4] == b"CRAM":
        return "cram"
    return next((k for k in ("bam", "cram", "sam") if path.lower().endswith("." + k)), "unknown")


def read_header(stream) -> tuple[str, list[tuple[str, int]]]:
    """Header text and (name, length) of the contigs."""
    if stream.read(4) != b"BAM\x01":
        raise ValueError("not a BAM stream")
    text = stream.read(struct.unpack("<i", stream.read(4))[0]).rstrip(b"\0").decode()
    contigs = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
        contigs.append((name, struct.unpack("<i", stream.read(4))[0]))
    return text, contigs


def read_records(stream) -> Iterator[tuple]:
    """(read_name, ref_id, pos0, flag, mapq, cigar, seq) of each record."""
    while head := stream.read(4):
        body = stream.read(struct.unpack("<i", head)[0])
        ref_id, pos, l_name, mapq, _, n_cigar, flag, l_seq = struct.unpack_from("<iiBBHHHi", body)
        at = 32 + l_name
        packed = struct.unpack_from(f"<{n_cigar}I", body, at)
        if any(x & 15 >= len(_OPS) for x in packed):
            raise ValueError("unknown CIGAR operation")
        bases = body[at + 4 * n_cigar : at + 4 * n_cigar + (l_seq + 1) // 2]
        seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in bases)[:l_seq]
        yield body[32 : at - 1].decode(), ref_id, pos, flag, mapq, [(_OPS[x & 15], x >> 4) for x in packed], seq


def read_index(data: bytes) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """A ``.bai`` index: per contig the chunks (two virtual offsets) of each bin, and the first offset of each 16 kb window."""
    if data[:4] != b"BAI\x01":
        raise ValueError("not a BAM index")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        (n_bins,), at, found = struct.unpack_from("<i", data, at), at + 4, {}
        for _ in range(n_bins):
            number, n = struct.unpack_from("<Ii", data, at)
            places = struct.unpack_from(f"<{2 * n}Q", data, at + 8)
            at += 8 + 16 * n
            if number != _SUMMARY_BIN:
                found[number] = list(zip(places[::2], places[1::2]))
        (n_windows,) = struct.unpack_from("<i", data, at)
        out.append((found, list(struct.unpack_from(f"<{n_windows}Q", data, at + 4))))
        at += 4 + 8 * n_windows
    return out


def bins_of(start: int, end: int) -> list[int]:
    """Numbers of the index's bins, at each of its six widths, that meet the half-open interval."""
    return [b for first, shift in _LEVELS for b in range(first + (start >> shift), first + (max(end - 1, start) >> shift) + 1)]


def split_ranges(index, split_bytes: int) -> list[tuple[int, int | None]]:
    """Virtual offsets that cut a file at records, ``split_bytes`` of compressed data or more apart; the last range runs to the file's end (null)."""
    starts = sorted({lo for found, _ in index for chunks in found.values() for lo, _ in chunks} | {w for _, windows in index for w in windows if w})
    cuts = starts[:1]
    for v in starts[1:]:
        if (v >> 16) - (cuts[-1] >> 16) >= split_bytes:
            cuts.append(v)
    return list(zip(cuts, [*cuts[1:], None]))


def region_ranges(index, regions: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges of virtual offsets that hold every record meeting any of the regions (ref_id, start, end)."""
    found = []
    for ref_id, start, end in regions:
        bins, windows = index[ref_id]
        least = windows[min(start >> 14, len(windows) - 1)] if windows else 0
        numbers = bins_of(start, end) if end - start < 1 << 26 else list(bins)
        found += [(max(lo, least), hi) for b in numbers for lo, hi in bins.get(b, ()) if hi > least]
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(found):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def parse_regions(text: str, contigs: list[tuple[str, int]]) -> list[tuple[int, int, int]]:
    """Regions ``name``, ``name:start`` or ``name:start-end`` (1-based, closed), by commas, as (ref_id, start, end), 0-based and half-open."""
    numbers, out = {name: i for i, (name, _) in enumerate(contigs)}, []
    for one in filter(None, (t.strip() for t in text.split(","))):
        name, _, span = (one, "", "") if one in numbers else one.rpartition(":")
        if name not in numbers:
            raise ValueError(f"unknown contig in region {one}")
        lo, _, hi = span.partition("-")
        out.append((numbers[name], max(int(lo or 1) - 1, 0), int(hi) if hi else contigs[numbers[name]][1]))
    return out


class BlockRange:
    """The uncompressed bytes between two virtual offsets; each block is read and unpacked when its turn comes."""

    def __init__(self, file, start: int, end: int | None):
        self.file, self.next, self.end = file, start >> 16, end
        self.data, self.at, self.block, self.base = b"", 0, start >> 16, 0
        if self._load():
            self.at = start & 0xFFFF

    def _load(self) -> bool:
        last = None if self.end is None else self.end >> 16
        if last is not None and (self.next > last or self.next == last and not self.end & 0xFFFF):
            return False
        head = self.file.read_at(12, self.next)
        if len(head) < 12:
            return False
        extra = struct.unpack_from("<H", head, 10)[0]
        fields, at, size = self.file.read_at(extra, self.next + 12), 0, None
        while at + 4 <= len(fields):
            tag, length = fields[at : at + 2], struct.unpack_from("<H", fields, at + 2)[0]
            if tag == b"BC":
                size = struct.unpack_from("<H", fields, at + 4)[0] + 1
            at += 4 + length
        if size is None:
            raise ValueError("an indexed BAM must consist of BGZF blocks")
        plain = zlib.decompress(self.file.read_at(size - 20 - extra, self.next + 12 + extra), wbits=-15)
        if self.next == last:
            plain = plain[: self.end & 0xFFFF]
        self.data, self.at, self.block, self.next = plain, 0, self.next, self.next + size
        return True

    def place(self) -> int | None:
        """The virtual offset of the next byte; null at the end."""
        while self.at >= len(self.data):
            if not self._load():
                return None
        return self.block << 16 | self.at

    def read(self, n: int) -> bytes:
        parts = []
        while n and self.place() is not None:
            parts.append(self.data[self.at : self.at + n])
            self.at += len(parts[-1])
            n -= len(parts[-1])
        return b"".join(parts)


def _open(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def _index(path: str) -> list | None:
    """The index beside a file (``x.bam.bai`` or ``x.bai``); none: null."""
    for name in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai"):
        try:
            with _open(name) as f:
                return read_index(f.read())
        except FileNotFoundError:
            continue
    return None


class _Range(InputPartition):
    """A part of a file: between virtual offsets, or whole if ``start`` is null."""

    def __init__(self, path: str, start: int | None = None, end: int | None = None, regions: list | None = None):
        self.path, self.start, self.end, self.regions = path, start, end, regions


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pattern, self.regions = options["path"], options.get("regions")
        self.split_bytes = int(options.get("splitbytes", options.get("splitBytes", 32 << 20)))

    def partitions(self) -> list[InputPartition]:
        paths = [self.pattern] if "://" in self.pattern else sorted(glob.glob(self.pattern)) or [self.pattern]
        return [part for path in paths for part in self._parts(path)]

    def _parts(self, path: str) -> list[InputPartition]:
        index = _index(path)
        if self.regions is None:
            return [_Range(path, lo, hi) for lo, hi in split_ranges(index or [], self.split_bytes)] or [_Range(path)]
        if index is None:
            raise ValueError(f"regions need an index: {path}.bai is missing")
        with _open(path) as f:
            regions = parse_regions(self.regions, read_header(gzip.GzipFile(fileobj=f))[1])
        return [_Range(path, lo, hi, regions) for lo, hi in region_ranges(index, regions)] or [_Range(path, 0, 0, regions)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        with _open(partition.path) as f:
            kind = detect_format(f.read_at(4, 0), partition.path)
            if kind == "cram":
                raise ValueError("CRAM needs its reference and codecs; convert it to BAM or Parquet first")
            sample = partition.path.rsplit("/", 1)[-1].split(".")[0]
            for number, (name, ref_id, pos, flag, mapq, cigar, seq) in self._numbered(f, partition):
                if partition.regions is None or any(ref_id == r and pos < en and pos + _span(cigar) > st for r, st, en in partition.regions):
                    yield sample, name, number, ref_id, pos, flag, mapq, cigar, seq

    def _numbered(self, f, partition: _Range) -> Iterator[tuple[int, tuple]]:
        if partition.start is None:
            f.seek(0)  # after a read at a place
            with gzip.GzipFile(fileobj=f) as stream:
                read_header(stream)
                yield from enumerate(read_records(stream), 1)
            return
        stream = BlockRange(f, partition.start, partition.end)
        while (place := stream.place()) is not None:
            yield place, next(read_records(stream))


def _span(cigar: list[tuple[str, int]]) -> int:
    """Bases of the genome that a record covers, one at least."""
    return max(sum(n for op, n in cigar if op in "MDN=X"), 1)


class BamDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)
