"""The file format of operator 4: the public Zstandard seekable layout.

A shard is a run of independent Zstandard frames, each the little-endian unsigned 32-bit ids of some whole
documents, and at its end a skippable frame with the seek table: per frame its compressed size, its
content size and the low 32 bits of the content's XXH64. Any Zstandard tool reads a shard from the
start; a reader that knows a frame's number reads the table at the end and that frame alone.
"""

from __future__ import annotations

import re
import struct

import pyarrow.fs as pafs
import xxhash
import zstandard

# fixed values of the seekable layout
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
ENTRY = struct.Struct("<III")    # compressed size, content size, checksum
FOOTER = struct.Struct("<IBI")   # number of frames, descriptor, magic
HEADER = struct.Struct("<II")    # magic, size of what follows


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (``file:/x`` as Hadoop writes it, too) or a plain path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def checksum(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class ShardWriter:
    """Writes frames in order; the seek table goes out on :meth:`close`."""

    def __init__(self, path: str, level: int = 3):
        fs, at = file_system(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(at, compression=None)  # else guessed from the name
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.table: list[bytes] = []

    def write(self, content: bytes) -> int:
        """Appends a frame; its number."""
        frame = self.compressor.compress(content)
        self.out.write(frame)
        self.table.append(ENTRY.pack(len(frame), len(content), checksum(content)))
        return len(self.table) - 1

    def close(self) -> None:
        body = b"".join(self.table)
        self.out.write(HEADER.pack(SKIPPABLE_MAGIC, len(body) + FOOTER.size))
        self.out.write(body + FOOTER.pack(len(self.table), HAS_CHECKSUMS, SEEKABLE_MAGIC))
        self.out.close()


class ShardReader:
    """Reads single frames of a shard by number, each checked against its checksum."""

    def __init__(self, path: str):
        fs, at = file_system(path)
        self.path, self.file = path, fs.open_input_file(at)
        size = self.file.size()
        if size < HEADER.size + FOOTER.size:
            raise ValueError(f"{path}: too short for a seek table")
        n, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        length = n * ENTRY.size + FOOTER.size
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS or length + HEADER.size > size:
            raise ValueError(f"{path}: no seek table with checksums")
        if HEADER.unpack(self.file.read_at(HEADER.size, size - length - HEADER.size)) != (SKIPPABLE_MAGIC, length):
            raise ValueError(f"{path}: the seek table's header is wrong")
        self.entries = list(ENTRY.iter_unpack(self.file.read_at(n * ENTRY.size, size - length)))
        self.offsets = [0]
        for compressed, *_ in self.entries:
            self.offsets.append(self.offsets[-1] + compressed)
        self.decompressor = zstandard.ZstdDecompressor()

    def read(self, frame: int) -> bytes:
        compressed, size, check = self.entries[frame]
        data = self.file.read_at(compressed, self.offsets[frame])
        content = self.decompressor.decompress(data) if size else b""
        if len(content) != size or checksum(content) != check:
            raise ValueError(f"{self.path}: frame {frame} is damaged")
        return content

    def close(self) -> None:
        self.file.close()
