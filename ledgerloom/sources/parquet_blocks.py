"""Parquet files joined by copying their encoded column blocks; no page is decoded.

A footer is a Thrift structure in the compact protocol. It is read into plain lists of
(field id, type, value), the offsets in it are moved, and it is written again. Field
numbers below are those of the public parquet-format definition.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterable
from typing import Protocol

MAGIC = b"PAR1"
TRUE, FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT = range(1, 13)

Fields = list[tuple[int, int, object]]


#: Bytes of a block that are held at a time while it is copied.
PIECE = 8 << 20


class Part(Protocol):
    """A file that is read by ranges, such as pyarrow's random access files."""

    def size(self) -> int: ...

    def read_at(self, nbytes: int, offset: int) -> bytes: ...


class InMemory:
    def __init__(self, data: bytes):
        self.data = data

    def size(self) -> int:
        return len(self.data)

    def read_at(self, nbytes: int, offset: int) -> bytes:
        return self.data[offset : offset + nbytes]


class BlockError(ValueError):
    """A file cannot be joined, or a joined file does not hold what its parts held."""


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def byte(self) -> int:
        self.at += 1
        return self.data[self.at - 1]

    def varint(self) -> int:
        value = shift = 0
        while True:
            b = self.byte()
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    def zigzag(self) -> int:
        n = self.varint()
        return (n >> 1) ^ -(n & 1)

    def value(self, kind: int) -> object:
        if kind in (TRUE, FALSE):
            return kind == TRUE
        if kind == BYTE:
            return self.byte()
        if kind in (I16, I32, I64):
            return self.zigzag()
        if kind == DOUBLE:
            self.at += 8
            return self.data[self.at - 8 : self.at]
        if kind == BINARY:
            n = self.varint()
            self.at += n
            return self.data[self.at - n : self.at]
        if kind in (LIST, SET):
            head = self.byte()
            n, inner = head >> 4, head & 15
            n = self.varint() if n == 15 else n
            return inner, [self.byte() if inner in (TRUE, FALSE) else self.value(inner) for _ in range(n)]
        if kind == STRUCT:
            return self.struct()
        raise BlockError(f"a footer holds a Thrift type that Parquet does not use: {kind}")

    def struct(self) -> Fields:
        fields, last = [], 0
        while head := self.byte():
            kind = head & 15
            last = last + (head >> 4) if head >> 4 else self.zigzag()
            fields.append((last, kind, self.value(kind)))
        return fields


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _encode(kind: int, value: object) -> bytes:
    if kind in (TRUE, FALSE):
        return b""
    if kind == BYTE:
        return bytes([value])
    if kind in (I16, I32, I64):
        return _varint(value << 1 if value >= 0 else (-value << 1) - 1)
    if kind == DOUBLE:
        return value
    if kind == BINARY:
        return _varint(len(value)) + value
    if kind in (LIST, SET):
        inner, items = value
        head = bytes([len(items) << 4 | inner]) if len(items) < 15 else bytes([0xF0 | inner]) + _varint(len(items))
        return head + b"".join(bytes([x]) if inner in (TRUE, FALSE) else _encode(inner, x) for x in items)
    out, last = [], 0
    for fid, k, v in value:
        k = (TRUE if v else FALSE) if k in (TRUE, FALSE) else k
        out.append(bytes([(fid - last) << 4 | k]) if 0 < fid - last < 16 else bytes([k]) + _encode(I16, fid))
        out.append(_encode(k, v))
        last = fid
    return b"".join(out) + b"\0"


def _get(fields: Fields, fid: int, default=None):
    return next((v for f, _, v in fields if f == fid), default)


def _with(fields: Fields, changed: dict[int, tuple[int, object]], dropped: Iterable[int] = ()) -> Fields:
    kept = {f: (k, v) for f, k, v in fields if f not in set(dropped)} | changed
    return [(f, *kept[f]) for f in sorted(kept)]


def read_footer(part: Part) -> Fields:
    """The footer of a file, by two range reads."""
    size = part.size()
    tail = bytes(part.read_at(8, size - 8)) if size >= 12 else b""
    if tail[4:] != MAGIC or bytes(part.read_at(4, 0)) != MAGIC:
        raise BlockError("not a plain Parquet file")
    (n,) = struct.unpack("<I", tail[:4])
    if n + 12 > size:
        raise BlockError("the footer is longer than the file")
    return _Reader(bytes(part.read_at(n, size - 8 - n))).struct()


def split_footer(data: bytes) -> Fields:
    """The footer of a whole file's bytes."""
    return read_footer(InMemory(data))


def schema_key(footer: Fields) -> str:
    """Equal for files whose schemas are the same, column for column."""
    return hashlib.sha256(_encode(LIST, _get(footer, 2))).hexdigest()


def counts(footer: Fields) -> tuple[int, int]:
    """(row groups, rows); the rows of the groups must add up to the file's."""
    groups = _get(footer, 4, (STRUCT, []))[1]
    rows = sum(_get(g, 3) for g in groups)
    if rows != _get(footer, 3):
        raise BlockError(f"the row groups hold {rows} rows, the footer says {_get(footer, 3)}")
    return len(groups), rows


def join_parts(parts: Iterable[Part], write: Callable[[bytes], object]) -> dict:
    """Writes one file with all row groups of the parts, in their order, and says what was counted.

    Blocks pass in pieces, so no part is ever held whole. Parts without rows add nothing. Parts of another schema than the
    first raise BlockError; group them by schema_key() before. Page indexes and bloom filters lie outside the
    blocks and are left out (readers fall back to the statistics in the footer).
    """
    groups, first, files, rows, blocks, at = [], None, 0, 0, 0, 0

    def put(data: bytes) -> None:
        nonlocal at
        write(data)
        at += len(data)

    for part in parts:
        footer = read_footer(part)
        if first is None:
            first = footer
            put(MAGIC)
        elif schema_key(first) != schema_key(footer):
            raise BlockError("the schemas differ")
        n_groups, n_rows = counts(footer)
        blocks, rows, files = blocks + n_groups, rows + n_rows, files + 1
        for group in _get(footer, 4, (STRUCT, []))[1]:
            columns, start_of_group = [], at
            for chunk in _get(group, 1)[1]:
                if _get(chunk, 1) is not None:
                    raise BlockError("a column lies in another file")
                meta = _get(chunk, 3)
                offsets = {f: _get(meta, f) for f in (9, 10, 11) if _get(meta, f)}
                start, size = min(offsets.values()), _get(meta, 7)
                shift, copied = at - start, 0
                while copied < size:
                    piece = bytes(part.read_at(min(PIECE, size - copied), start + copied))
                    if not piece:
                        raise BlockError("a column block is cut off")
                    put(piece)
                    copied += len(piece)
                meta = _with(meta, {f: (I64, v + shift) for f, v in offsets.items()}, dropped=(14, 15))
                columns.append(_with(chunk, {2: (I64, 0), 3: (STRUCT, meta)}, dropped=(4, 5, 6, 7)))
            groups.append(_with(group, {1: (LIST, (STRUCT, columns)), 5: (I64, start_of_group)}, dropped=(7,)))
    if first is None:
        raise BlockError("there are no parts")
    footer = _encode(STRUCT, _with(first, {3: (I64, rows), 4: (LIST, (STRUCT, groups))}))
    put(footer + struct.pack("<I", len(footer)) + MAGIC)
    return {"files": files, "blocks": blocks, "rows": rows, "bytes": at}


def join_files(parts: Iterable[bytes]) -> tuple[bytes, dict]:
    """The same for parts and a file held in memory; the joined footer is read back and must hold every block."""
    out = bytearray()
    n = join_parts(map(InMemory, parts), out.extend)
    if counts(split_footer(bytes(out))) != (n["blocks"], n["rows"]):
        raise BlockError("the joined footer does not hold every block")
    return bytes(out), {k: n[k] for k in ("files", "blocks", "rows")}
