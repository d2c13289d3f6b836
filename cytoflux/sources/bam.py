"""A data source of BAM files: compressed blocks are read in splits, by any number of tasks.

A BAM file is a chain of BGZF blocks that are compressed one by one, and alignments lie across their borders.  A split begins at the first block that starts in it: blocks are known
by their header, and by the header that must follow where they end.  In a split that is not the first, the first alignment is found by trying places until a chain of plausible
alignments follows.  A split's alignments are those that begin in its blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "qname string, flag int, chrom string, start bigint, mapq int, cigar string, mate_chrom string, mate_start bigint, insert_size bigint, seq string, qual string, tags map<string,string>"
#: Letters of the format (fixed values): operations, bases, and the sizes of number types of tags.
OPERATIONS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
NUMBERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
_EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Alignments that must follow one another where a split's first is sought.
CHAIN = 4


def file_system(path: str):
    """A file system and the path in it: local without a scheme, else what the scheme names."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def block_size(head: bytes) -> int | None:
    """The size of the BGZF block that begins with ``head`` (18 bytes or more of it), or None if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return None
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(12 + extra, len(head)):
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and n == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


class _Blocks:
    """Decompressed blocks of a file from a place on, each with the place where it begins."""

    def __init__(self, file, size: int, start: int) -> None:
        self.file, self.size, self.at = file, size, start

    def first(self) -> bool:
        """Move to the first block that begins at ``at`` or later; False if there is none."""
        while self.at < self.size:
            self.file.seek(self.at)
            window = self.file.read(1 << 17)
            i = window.find(b"\x1f\x8b\x08\x04")
            while i >= 0:
                n = block_size(window[i : i + 256])
                if n is not None:
                    follows = self.at + i + n
                    if follows == self.size:
                        self.at += i
                        return True
                    self.file.seek(follows)
                    if block_size(self.file.read(256)) is not None:
                        self.at += i
                        return True
                i = window.find(b"\x1f\x8b\x08\x04", i + 1)
            self.at += max(len(window) - 3, 1) if len(window) == 1 << 17 else len(window)
        return False

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while self.at < self.size:
            self.file.seek(self.at)
            head = self.file.read(256)
            n = block_size(head)
            if n is None:
                raise ValueError(f"no BGZF block at {self.at}")
            raw = head[:n] + self.file.read(max(n - len(head), 0))
            start, self.at = self.at, self.at + n
            skip = 12 + struct.unpack_from("<H", raw, 10)[0]
            data = zlib.decompress(raw[skip:-8], -15)
            if zlib.crc32(data) != struct.unpack_from("<I", raw, n - 8)[0]:
                raise ValueError(f"a damaged BGZF block at {start}")
            yield start, data


def header(path: str) -> tuple[list[tuple[str, int]], int]:
    """The chromosomes and their sizes, and how many decompressed bytes the header takes."""
    fs, name = file_system(path)
    with fs.open_input_file(name) as f:
        buffer, blocks = b"", iter(_Blocks(f, f.size(), 0))

        def need(n: int) -> None:
            nonlocal buffer
            while len(buffer) < n:
                found = next(blocks, None)
                if found is None:
                    raise ValueError(f"{path}: a truncated header")
                buffer += found[1]

        need(12)
        if buffer[:4] != b"BAM\x01":
            raise ValueError(f"{path} is no BAM file")
        at = 8 + struct.unpack_from("<i", buffer, 4)[0]
        need(at + 4)
        count = struct.unpack_from("<i", buffer, at)[0]
        at += 4
        chroms = []
        for _ in range(count):
            need(at + 4)
            n = struct.unpack_from("<i", buffer, at)[0]
            need(at + 8 + n)
            chroms.append((buffer[at + 4 : at + 3 + n].decode(), struct.unpack_from("<i", buffer, at + 4 + n)[0]))
            at += 8 + n
    return chroms, at


def plausible(data: bytes, at: int, chroms: int) -> int | None:
    """The end of the alignment that may begin at ``at``, -1 if ``data`` is too short to tell, None if none does."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, name, _, _, ops, _, length, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < chroms and -1 <= mate < chroms and pos >= -1 and mate_pos >= -1 and name >= 2 and length >= 0):
        return None
    if size < 32 + name + 4 * ops + (length + 1) // 2 + length or size > 1 << 28:
        return None
    if at + 36 + name > len(data):
        return -1
    text = data[at + 36 : at + 36 + name]
    if text[-1] != 0 or not all(33 <= c <= 126 for c in text[:-1]):
        return None
    return at + 4 + size


def first_alignment(data: bytes, chroms: int, whole: bool) -> int | None:
    """The first place in ``data`` from which ``CHAIN`` plausible alignments follow one another, or fewer up to its end if ``data`` is the ``whole`` rest; None if it is not to be seen yet."""
    for at in range(len(data)):
        place, seen = at, 0
        while seen < CHAIN:
            if place == len(data) and whole and seen:
                return at
            end = plausible(data, place, chroms) if place < len(data) else -1
            if end is None:
                break
            if end == -1 or end > len(data):
                if whole:
                    break
                return None
            place, seen = end, seen + 1
        else:
            return at
    return None


def _tags(data: bytes, at: int, end: int) -> dict[str, str]:
    out = {}
    while at < end:
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in NUMBERS:
            value = struct.unpack_from(NUMBERS[kind], data, at)[0]
            at += struct.calcsize(NUMBERS[kind])
            out[name] = f"{value:g}" if kind == "f" else str(value)
        elif kind == "A":
            out[name] = chr(data[at])
            at += 1
        elif kind in "ZH":
            stop = data.index(b"\0", at)
            out[name] = data[at:stop].decode()
            at = stop + 1
        elif kind == "B":
            part, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[part][1]}", data, at + 5)
            out[name] = ",".join([part, *(f"{v:g}" if part == "f" else str(v) for v in values)])
            at += 5 + n * struct.calcsize(NUMBERS[part])
        else:
            raise ValueError(f"an unknown type of tag: {kind}")
    return out


_PAIRS = np.array([a + b for a in BASES for b in BASES])


def alignment(data: bytes, at: int, chroms: list[tuple[str, int]], wanted: set[str]) -> tuple:
    """The alignment at ``at`` as a row; columns that are not ``wanted`` are null and not decoded."""
    size, ref, pos, name, mapq, _, ops, flag, length, mate, mate_pos, insert = struct.unpack_from("<iiiBBHHHiiii", data, at)
    end, p = at + 4 + size, at + 36
    qname = data[p : p + name - 1].decode() if "qname" in wanted else None
    p += name
    cigar = "".join(f"{v >> 4}{OPERATIONS[v & 15]}" for v in struct.unpack_from(f"<{ops}I", data, p)) or "*" if "cigar" in wanted else None
    p += 4 * ops
    half = (length + 1) // 2
    seq = "".join(_PAIRS[np.frombuffer(data, np.uint8, half, p)].tolist())[:length] or "*" if "seq" in wanted else None
    p += half
    qual = None
    if "qual" in wanted:
        raw = data[p : p + length]
        qual = "*" if not raw or raw[0] == 255 else bytes(q + 33 for q in raw).decode()
    p += length
    of = lambda k: "*" if k < 0 else chroms[k][0]
    return (qname, flag, of(ref), pos, mapq, cigar, of(mate), mate_pos, insert, seq, qual, _tags(data, p, end) if "tags" in wanted else None)


class _Stream:
    """The decompressed bytes of blocks from a place on, as far as they are read; ``limit`` is where the first block at or behind ``stop`` begins in them."""

    def __init__(self, blocks: _Blocks, stop: int) -> None:
        self.blocks, self.stop, self.data, self.limit, self.ended = iter(blocks), stop, b"", None, False

    def more(self) -> bool:
        found = next(self.blocks, None)
        if found is None:
            self.ended = True
            return False
        if self.limit is None and found[0] >= self.stop:
            self.limit = len(self.data)
        self.data += found[1]
        return True

    def drop(self, n: int) -> None:
        self.data = self.data[n:]
        if self.limit is not None:
            self.limit -= n

    def size(self, at: int) -> int | None:
        """Bytes of the alignment at ``at``, read in full; None at the end of the file."""
        while len(self.data) - at < 4 or len(self.data) - at < 4 + struct.unpack_from("<i", self.data, at)[0]:
            if not self.more():
                if len(self.data) > at:
                    raise ValueError("a truncated alignment")
                return None
        return 4 + struct.unpack_from("<i", self.data, at)[0]


def rows(path: str, start: int, stop: int, wanted: set[str] | None = None) -> Iterator[tuple]:
    """The alignments of ``path`` that begin in blocks from ``start`` up to ``stop`` (places in the compressed file)."""
    wanted = wanted or {c.split()[0] for c in SCHEMA.split(", ")}
    chroms, skip = header(path)
    fs, name = file_system(path)
    with fs.open_input_file(name) as f:
        blocks = _Blocks(f, f.size(), start)
        if not blocks.first() or blocks.at >= stop:
            return
        stream = _Stream(blocks, stop)
        if start == 0:
            while len(stream.data) < skip and stream.more():
                pass
            at: int | None = skip
        else:
            at = None
            while at is None:
                grew = stream.more()
                at = first_alignment(stream.data, len(chroms), not grew)
                if at is None and not grew:
                    return
        while stream.limit is None or at < stream.limit:
            if at > 1 << 20:
                stream.drop(at)
                at = 0
            if at == len(stream.data) and stream.limit is None and not stream.more():
                return
            if stream.limit is not None and at >= stream.limit:
                return
            size = stream.size(at)
            if size is None:
                return
            yield alignment(stream.data, at, chroms, wanted)
            at += size


class _Split(InputPartition):
    def __init__(self, path: str, start: int, stop: int) -> None:
        self.path, self.start, self.stop = path, start, stop


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths, self.size = options["path"].split(","), int(options.get("splitBytes", 64 << 20))
        self.columns = {c.strip() for c in options["columns"].split(",")} if options.get("columns") else None

    def partitions(self) -> list[_Split]:
        from pyarrow import fs as F

        out = []
        for path in self.paths:
            fs, name = file_system(path)
            info = fs.get_file_info(name)
            found = sorted(x.path for x in fs.get_file_info(F.FileSelector(name)) if x.path.endswith(".bam")) if info.type == F.FileType.Directory else [name]
            prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
            for f in found:
                size = fs.get_file_info(f).size
                out += [_Split(prefix + f, a, min(a + self.size, size)) for a in range(0, size, self.size)]
        return out

    def read(self, partition: _Split) -> Iterator[tuple]:
        return rows(partition.path, partition.start, partition.stop, self.columns)


def compressed(data: bytes, most: int = 0xFF00) -> bytes:
    """BGZF blocks of ``data``, without the empty one that ends a file."""
    out = []
    for i in range(0, len(data), most):
        part = data[i : i + most]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        out.append(b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


def header_bytes(chroms: list[tuple[str, int]]) -> bytes:
    text = "".join(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in chroms).encode()
    return b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(chroms)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in chroms)


def alignment_bytes(row, number: dict[str, int]) -> bytes:
    """A row of ``SCHEMA`` as an alignment; tags are written as texts (``Z``), whole numbers as ``i``."""
    qname, flag, chrom, start, mapq, cigar, mate_chrom, mate_start, insert, seq, qual, tags = row
    name = (qname or "*").encode() + b"\0"
    ops = []
    digits = ""
    for c in "" if cigar in (None, "*") else cigar:
        if c.isdigit():
            digits += c
        else:
            ops.append(int(digits) << 4 | OPERATIONS.index(c))
            digits = ""
    seq = "" if seq in (None, "*") else seq
    codes = [BASES.index(c) if c in BASES else 15 for c in seq.upper()] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    quality = b"\xff" * len(seq) if qual in (None, "*") else bytes(ord(c) - 33 for c in qual)
    if len(quality) != len(seq):
        raise ValueError(f"sequence and quality of {qname} differ in length")
    more = b""
    for k, v in (tags or {}).items():
        whole = v.lstrip("-").isdigit() and -(1 << 31) <= int(v) < 1 << 31 and str(int(v)) == v
        more += k.encode() + (b"i" + struct.pack("<i", int(v)) if whole else b"Z" + v.encode() + b"\0")
    ref = lambda c: number[c] if c not in (None, "*") else -1
    at = lambda p: -1 if p is None else p
    body = struct.pack("<iiBBHHHiiii", ref(chrom), at(start), len(name), mapq or 0, 4680, len(ops), flag or 0, len(seq), ref(mate_chrom), at(mate_start), insert or 0)
    body += name + struct.pack(f"<{len(ops)}I", *ops) + packed + quality + more
    return struct.pack("<i", len(body)) + body


class _Written(WriterCommitMessage):
    def __init__(self, path: str) -> None:
        self.path = path


class _Writer(DataSourceWriter):
    """Each task writes a whole BAM file aside; all of them get their names when all are there."""

    def __init__(self, options) -> None:
        self.path = options["path"]
        self.chroms = [(c, int(n)) for c, _, n in (x.rpartition(":") for x in options["chromosomes"].split(","))]

    def write(self, iterator: Iterator) -> _Written:
        import uuid

        fs, name = file_system(self.path)
        fs.create_dir(name, recursive=True)
        target = f"{name}/.part-{uuid.uuid4().hex}"
        number = {c: i for i, (c, _) in enumerate(self.chroms)}
        with fs.open_output_stream(target) as out:
            out.write(compressed(header_bytes(self.chroms)))
            held, size = [], 0
            for row in iterator:
                held.append(alignment_bytes(tuple(row), number))
                size += len(held[-1])
                if size >= 1 << 20:
                    out.write(compressed(b"".join(held)))
                    held, size = [], 0
            out.write(compressed(b"".join(held)) + _EOF)
        return _Written(target)

    def commit(self, messages: list) -> None:
        fs, name = file_system(self.path)
        for k, m in enumerate(sorted((m for m in messages if m is not None), key=lambda m: m.path)):
            fs.move(m.path, f"{name}/part-{k:05}.bam")

    def abort(self, messages: list) -> None:
        fs, _ = file_system(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(m.path)


class BamSource(DataSource):
    """``spark.read.format("bam").load(path)``: files or folders (of ``*.bam``), comma-separated, that executors can open.

    Options: ``splitBytes`` (64 MB of the compressed file a task), ``columns`` (comma-separated: only these are decoded, the others are null).  Writing appends a file per partition and needs
    ``chromosomes`` (``name:size``, comma-separated) for the header.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BamSource)
