"""BAM files in ranges of bytes, as a Spark data source, and folders of BAM files written by one.

A BAM file is a row of compressed blocks, and records run across them without a mark. A range of bytes owns the blocks that begin in it
and the records that begin in those. Its first block is found by trying headers and checksums, its first record as the first place from
which a chain of records holds. At its end a range looks for the first record of the ranges after it in the same way, and must come to
the same place as its own chain did: since the first range begins where the header ends, every range then began at a true record.

rec_ord is a record's virtual offset: the place of its block in the file times 65,536 and its place in the block.
"""

from __future__ import annotations

import bisect
import gzip
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from graphloom.sources.files import open_at

#: Fixed values of the format: CIGAR operations, sequence letters, sizes of tag types, and the empty block at a file's end.
CIGAR_OPS, LETTERS = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
TAG_FORMATS = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BLOCK_MAGIC = b"\x1f\x8b\x08\x04"

LETTER_PAIRS = [a + b for a in LETTERS for b in LETTERS]
#: Bytes, unpacked, from which a range's first record is looked for at first.
WINDOW = 1 << 20
RECORD = "rec_ord long, query_id string, flag int, target string, pos0 long, cigar string, seq_len int, seq string, as_score int, ms_score int, nm int, raw binary"


def _block_at(data: bytes, at: int) -> int:
    """The size of the block that ``data`` may have at ``at``; 0 if there is no block's header, -1 if more bytes are needed to tell."""
    if data[at : at + 4] != BLOCK_MAGIC[: len(data) - at]:
        return 0
    if at + 12 > len(data):
        return -1
    end = at + 12 + struct.unpack_from("<H", data, at + 10)[0]
    if end > len(data):
        return -1
    at += 12
    while at + 4 <= end:
        kind, size = data[at : at + 2], struct.unpack_from("<H", data, at + 2)[0]
        if kind == b"BC" and size == 2 and at + 6 <= end:
            return struct.unpack_from("<H", data, at + 4)[0] + 1
        at += 4 + size
    return 0


def _unpacked(block: bytes) -> bytes | None:
    """A block's content; None if it is not a whole block."""
    start = 12 + struct.unpack_from("<H", block, 10)[0]
    try:
        out = zlib.decompress(block[start:-8], -15)
    except zlib.error:
        return None
    return out if (zlib.crc32(out), len(out)) == struct.unpack("<II", block[-8:]) else None


class Blocks:
    """The blocks of one file: (offset, content), in order, from one that begins at or after a place."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def first(self, at: int) -> int:
        """The offset of the first block at or after ``at``; the file's size if there is none."""
        while at < self.size:
            data = self._bytes(at, 1 << 18)
            found = data.find(BLOCK_MAGIC)
            if found < 0:
                at += max(1, len(data) - 3)
                continue
            block = self._bytes(at + found, 1 << 16)
            size = _block_at(block, 0)
            if size > 0 and size <= len(block) and _unpacked(block[:size]) is not None:
                return at + found
            at += found + 1
        return self.size

    def read(self, at: int) -> Iterator[tuple[int, bytes]]:
        held, begin = b"", at
        while at < self.size:
            place = at - begin
            size = _block_at(held, place)
            if size < 0 or place + max(size, 18) > len(held):
                held, begin, place = self._bytes(at, 1 << 20), at, 0
                size = _block_at(held, 0)
            if size <= 0 or place + size > len(held) or (out := _unpacked(held[place : place + size])) is None:
                raise ValueError(f"no whole block at byte {at}")
            yield at, out
            at += size


class Stream:
    """Unpacked bytes from one block on, with the virtual offset of each place."""

    def __init__(self, blocks: Blocks, at: int):
        self.blocks, self.data, self.done = blocks.read(at), bytearray(), 0
        self.begins: list[int] = []  # of the blocks held: places in the stream, and offsets in the file
        self.offsets: list[int] = []
        self.ended = False

    def more(self) -> bool:
        for offset, out in self.blocks:
            if out:
                self.begins.append(self.done + len(self.data))
                self.offsets.append(offset)
                self.data += out
                return True
        self.ended = True
        return False

    def have(self, place: int, n: int) -> bool:
        """Reads on until ``n`` bytes from ``place`` are there; False if the file ends before."""
        while self.done + len(self.data) < place + n:
            if not self.more():
                return False
        return True

    def at(self, place: int, n: int) -> bytes:
        return bytes(self.data[place - self.done : place - self.done + n])

    def drop(self, place: int) -> None:
        """Forgets what is before ``place``."""
        if place - self.done > WINDOW:
            del self.data[: place - self.done]
            self.done = place
            k = bisect.bisect_right(self.begins, place) - 1
            del self.begins[:k], self.offsets[:k]

    def virtual(self, place: int) -> int | None:
        """The virtual offset of a place; at a block's end that of the next block, None at the file's end."""
        while not self.begins or place >= self.done + len(self.data):
            if not self.more():
                return None
        k = bisect.bisect_right(self.begins, place) - 1
        return self.offsets[k] << 16 | place - self.begins[k]


def header(stream: io.BufferedIOBase) -> tuple[str, list[tuple[str, int]]]:
    """Header text and targets, from an unpacked BAM stream; leaves it at the first record."""
    if stream.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = stream.read(struct.unpack("<i", stream.read(4))[0]).rstrip(b"\0").decode()
    targets = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
        targets.append((name, struct.unpack("<i", stream.read(4))[0]))
    return text, targets


class _Reading(io.RawIOBase):
    """A stream read from its beginning, as header() wants it."""

    def __init__(self, stream: Stream):
        self.stream, self.place = stream, 0

    def read(self, n: int = -1) -> bytes:
        self.stream.have(self.place, n)
        out = self.stream.at(self.place, n)
        self.place += len(out)
        return out


def _plausible(data: bytes, at: int, lengths: list[int]) -> int:
    """The size of the record that ``data`` may have at ``at``, its size field included; 0 if there is none; less than 0 if what is there is no proof against one."""
    if at + 36 > len(data):
        return -1
    size, target, pos, l_name, _, _, n_ops, _, l_seq, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    if size < 32 or l_name < 1 or l_seq < 0 or not -1 <= target < len(lengths) or not -1 <= mate < len(lengths) or pos < -1 or mate_pos < -1:
        return 0
    if 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq > size or (target >= 0 and pos >= lengths[target]):
        return 0
    name = data[at + 36 : at + 36 + l_name]
    if any(not 33 <= c <= 126 for c in name[: l_name - 1]) or (len(name) == l_name and name[-1]):
        return 0
    ops = data[at + 36 + l_name : at + 36 + l_name + 4 * n_ops]
    if any(c & 15 > 8 for c in ops[::4]):
        return 0
    return 4 + size


def first_record(file, size: int, start: int, end: int, lengths: list[int]) -> int | None:
    """Virtual offset of the first record that begins in a block of the range from ``start`` to ``end``; None if there is none."""
    blocks = Blocks(file, size)
    at = blocks.first(start)
    if at >= end:
        return None
    stream, window, place = Stream(blocks, at), WINDOW, 0
    while True:
        stream.have(0, window)
        data = bytes(stream.data)
        limit = next((b for b, o in zip(stream.begins, stream.offsets, strict=True) if o >= end), len(data))
        while place < limit:
            chain, n, step = place, 0, 1
            while chain < len(data) and (step := _plausible(data, chain, lengths)) > 0:
                chain, n = chain + step, n + 1
            if chain >= len(data) or step < 0:  # all that is there holds
                if stream.ended and chain == len(data):
                    return stream.virtual(place)
                if not stream.ended:
                    if n > 1 or window > 64 * WINDOW:
                        return stream.virtual(place)
                    break  # too little to go by: look at more
            place += 1
        if place >= limit and (stream.ended or limit < len(data)):
            return None
        window *= 2


def _tags(data: bytes, at: int) -> dict[str, int]:
    """Integer tags; the others are stepped over."""
    out: dict[str, int] = {}
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            at = data.index(b"\0", at) + 1
        elif kind == "B":
            n = struct.unpack("<i", data[at + 1 : at + 5])[0]
            at += 5 + n * struct.calcsize("<" + TAG_FORMATS[chr(data[at])])
        else:
            form = "<" + TAG_FORMATS[kind]
            value = struct.unpack(form, data[at : at + struct.calcsize(form)])[0]
            if kind not in "Af":
                out[name] = value
            at += struct.calcsize(form)
    return out


def _values(ordinal: int, data: bytes, targets: list[tuple[str, int]], want: set[str]) -> dict:
    """The wanted columns of one record (without its size field)."""
    target, pos, l_name, _, _, n_ops, flag, l_seq = struct.unpack_from("<iiBBHHHi", data)
    ops = 32 + l_name
    seq = ops + 4 * n_ops
    out = {"rec_ord": ordinal, "flag": flag, "target": targets[target][0] if target >= 0 else "*", "pos0": pos, "seq_len": l_seq or None}
    if "query_id" in want:
        out["query_id"] = data[32 : ops - 1].decode()
    if "cigar" in want:
        out["cigar"] = "".join(f"{o >> 4}{CIGAR_OPS[o & 15]}" for o in struct.unpack_from(f"<{n_ops}I", data, ops)) or "*"
    if "seq" in want:
        out["seq"] = "".join(map(LETTER_PAIRS.__getitem__, data[seq : seq + (l_seq + 1) // 2]))[:l_seq] or "*"
    if want & {"as_score", "ms_score", "nm"}:
        tags = _tags(data, seq + (l_seq + 1) // 2 + l_seq)
        out |= {"as_score": tags.get("AS"), "ms_score": tags.get("ms"), "nm": tags.get("NM")}
    if "raw" in want:
        out["raw"] = data
    return out


_headers: dict[tuple[str, int], tuple[list[tuple[str, int]], int | None]] = {}  # the last one of this process


def _header_of(file, path: str, size: int) -> tuple[list[tuple[str, int]], int | None]:
    """Targets, and the virtual offset of the first record."""
    if (path, size) not in _headers:
        stream = Stream(Blocks(file, size), 0)
        reading = _Reading(stream)
        _, targets = header(reading)
        _headers.clear()
        _headers[path, size] = (targets, stream.virtual(reading.place))
    return _headers[path, size]


def is_blocked(file) -> bool:
    """Whether a file begins with a block."""
    return _block_at(file.read(1 << 16), 0) > 0


def header_of(file, size: int) -> tuple[str, list[tuple[str, int]]]:
    """Header text and targets of a file, with blocks or as a plain gzip stream, of which no more is read."""
    file.seek(0)
    if is_blocked(file):
        return header(_Reading(Stream(Blocks(file, size), 0)))
    file.seek(0)
    with gzip.open(file) as stream:
        return header(stream)


def records_of_range(file, path: str, size: int, start: int, end: int, step: int, want: set[str]) -> Iterator[dict]:
    """Records that begin in the range, and the proof that the next range with a record begins where they end."""
    targets, begin = _header_of(file, path, size)
    if begin is None or begin >> 16 >= end:
        return
    lengths = [n for _, n in targets]
    if begin >> 16 < start:
        begin = first_record(file, size, start, end, lengths)
        if begin is None:
            return
    stream = Stream(Blocks(file, size), begin >> 16)
    place = begin & 0xFFFF
    while (virtual := stream.virtual(place)) is not None and virtual >> 16 < end:
        if not stream.have(place, 4) or not stream.have(place, 4 + (n := struct.unpack("<i", stream.at(place, 4))[0])):
            raise ValueError(f"{path} ends inside a record")
        yield _values(virtual, stream.at(place + 4, n), targets, want)
        place += 4 + n
        stream.drop(place)
    at = end
    while at < size:
        found = first_record(file, size, at, min(size, at + step), lengths)
        if found is not None:
            if found != virtual:
                raise ValueError(f"{path}: records from byte {start} on do not meet those from {at} on; read the file in one range")
            return
        at += step
    if virtual is not None:
        raise ValueError(f"{path}: no range after byte {end} begins with the record at {virtual}; read the file in one range")


def records_of_file(content: bytes, want: set[str]) -> Iterator[dict]:
    """All records of a file in memory. One that is a plain gzip stream without blocks is read too; rec_ord then counts from 0."""
    if _block_at(content[: 1 << 16], 0) > 0:
        yield from records_of_range(io.BytesIO(content), str(uuid.uuid4()), len(content), 0, len(content), 1 << 62, want)
        return
    with gzip.open(io.BytesIO(content)) as stream:
        _, targets = header(stream)
        ordinal = 0
        while size := stream.read(4):
            yield _values(ordinal, stream.read(struct.unpack("<i", size)[0]), targets, want)
            ordinal += 1


def batches(rows: Iterator[dict], schema) -> Iterator:
    """Arrow batches of records, small enough for long sequences."""
    import pyarrow as pa

    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row.get("seq") or row.get("raw") or "") + 100
        if size > 4 << 20 or len(held) == 10_000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


class _Range(InputPartition):
    def __init__(self, path: str, size: int, start: int, end: int):
        self.path, self.size, self.start, self.end = path, size, start, end


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.step = schema, int(options["step"])
        self.files = json.loads(options["files"])

    def partitions(self) -> list[_Range]:
        return [_Range(path, size, at, min(size, at + self.step)) for path, size in self.files for at in range(0, size, self.step)]

    def read(self, part: _Range | None) -> Iterator:
        from pyspark.sql.pandas.types import to_arrow_schema

        if part is None:  # what Spark gives where there are no partitions
            return
        schema = to_arrow_schema(self.schema)
        with open_at(part.path) as file:
            yield from batches(records_of_range(file, part.path, part.size, part.start, part.end, self.step, set(schema.names)), schema)


class BamSource(DataSource):
    """Options: files (JSON list of path and size), step (bytes of a range) and columns (of ``RECORD``, with ", ")."""

    @classmethod
    def name(cls) -> str:
        return "graphloom_bam"

    def schema(self) -> str:
        want = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        return ", ".join(c for c in RECORD.split(", ") if not want or c.split()[0] in want)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), overwrite)


def packed_header(text: str, targets: list[tuple[str, int]]) -> bytes:
    raw = text.encode()
    names = [(name.encode() + b"\0", n) for name, n in targets]
    return b"BAM\1" + struct.pack("<i", len(raw)) + raw + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(name)) + name + struct.pack("<i", n) for name, n in names)


def block(data: bytes) -> bytes:
    """One block of at most 65,280 bytes."""
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return BLOCK_MAGIC + bytes(4) + b"\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class _Part(WriterCommitMessage):
    def __init__(self, temporary: str, final: str):
        self.temporary, self.final = temporary, final


class _Writer(DataSourceWriter):
    """Each task writes one BAM file, whole with header and end, under a name that the commit makes final; what did not commit goes."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.text, self.targets = options["path"], options["text"], [tuple(t) for t in json.loads(options["targets"])]
        self.overwrite = overwrite

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def write(self, rows: Iterator) -> _Part:
        from pyspark import TaskContext

        system, folder = self._system()
        system.create_dir(folder, recursive=True)
        number = TaskContext.get().partitionId()
        part = _Part(f"{folder}/_part-{number:06d}-{uuid.uuid4().hex}", f"{folder}/part-{number:06d}.bam")
        with system.open_output_stream(part.temporary, compression=None) as out:
            held = bytearray(packed_header(self.text, self.targets))
            for (raw,) in rows:
                held += struct.pack("<i", len(raw)) + raw
                while len(held) >= 65_280:
                    out.write(block(bytes(held[:65_280])))
                    del held[:65_280]
            out.write((block(bytes(held)) if held else b"") + END_BLOCK)
        return part

    def commit(self, messages: list[_Part | None]) -> None:
        from pyarrow import fs

        system, folder = self._system()
        kept = {m.temporary for m in messages if m}
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.path not in kept and (info.base_name.startswith("_part-") or (self.overwrite and info.base_name.endswith(".bam"))):
                system.delete_file(info.path)
        for m in messages:
            if m:
                system.move(m.temporary, m.final)

    def abort(self, messages: list[_Part | None]) -> None:
        system, _ = self._system()
        for m in messages:
            if m:
                system.delete_file(m.temporary)
