"""Reads stored members of a ZIP archive by ranges, without unpacking it.

The end record, its ZIP64 form and the central directory are parsed here; a
member's bytes are then read in place from any random-access file (``seek``,
``read``).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
#: The end record and the longest comment after it.
_TAIL = 22 + 0xFFFF


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


class ZipReader:
    """The members of an archive; ``read`` gives a range of one that is stored."""

    def __init__(self, source, size: int):
        self.source = source
        self.members = {m.name: m for m in self._directory(size)}
        self._data: dict[str, int] = {}

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        out = bytes(self.source.read(n))
        if len(out) != n:
            raise ValueError("the archive ends early")
        return out

    def _directory(self, size: int):
        tail = self._at(max(0, size - _TAIL), min(size, _TAIL))
        at = tail.rfind(_END)
        # the mark may stand in a comment: the true one's comment ends with the file
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        entries, length, start = struct.unpack_from("<HII", tail, at + 10)
        place = max(0, size - _TAIL) + at
        if place >= 20 and (locator := self._at(place - 20, 20))[:4] == _LOCATOR:
            end64 = self._at(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != _END64:
                raise ValueError("no ZIP64 end record where the locator points")
            entries, length, start = struct.unpack_from("<QQQ", end64, 32)
        directory, at = self._at(start, length), 0
        for _ in range(entries):
            if directory[at : at + 4] != _ENTRY:
                raise ValueError("not an entry of a central directory")
            method = struct.unpack_from("<H", directory, at + 10)[0]
            packed, size, n_name, n_extra, n_comment, disk = struct.unpack_from("<IIHHHH", directory, at + 20)
            header = struct.unpack_from("<I", directory, at + 42)[0]
            name = directory[at + 46 : at + 46 + n_name]
            extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
            size, packed, header = _wide(extra, size, packed, header)
            yield Member(name.decode(), method, packed, header)
            at += 46 + n_name + n_extra + n_comment

    def read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        """``length`` bytes of a stored member from ``start``."""
        member = self.members[name]
        if member.method:
            raise ValueError(f"{name} is compressed by the archive; only stored members can be read by ranges")
        if name not in self._data:
            head = self._at(member.header, 30)
            if head[:4] != _LOCAL:
                raise ValueError("no local header where the directory points")
            self._data[name] = member.header + 30 + sum(struct.unpack_from("<HH", head, 26))
        length = member.size - start if length is None else length
        if start < 0 or start + length > member.size:
            raise ValueError("beyond the end of the member")
        return self._at(self._data[name] + start, length)


def _wide(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """The 64-bit values that stand in the extra field for those that do not fit 32 bits."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            size = next(wide) if size == 0xFFFFFFFF else size
            packed = next(wide) if packed == 0xFFFFFFFF else packed
            header = next(wide) if header == 0xFFFFFFFF else header
        at += 4 + n
    return size, packed, header
