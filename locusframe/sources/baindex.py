"""The index of an alignment file (BAI): which parts of it hold the reads of a range of places.

Places are binned by a tree of six levels, eight bins below one, the finest of 16 kb. For
each contig a file has, by bin, ranges of virtual places (block << 16 | offset in it), and
for each 16 kb the least virtual place of a read that reaches into them.
"""

from __future__ import annotations

import struct

MAGIC = b"BAI\1"
#: Fixed values of the format: bits of the finest bin, the first bin of each level, the bin that holds totals.
FINEST = 14
FIRST = (4681, 585, 73, 9, 1, 0)
TOTALS = 37450


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds [begin, end)."""
    bits = FINEST
    for first in FIRST[:-1]:
        if begin >> bits == (end - 1) >> bits:
            return first + (begin >> bits)
        bits += 3
    return 0


def bins_over(begin: int, end: int) -> set[int]:
    """All bins that [begin, end) touches."""
    out, bits = set(), FINEST
    for first in FIRST:
        out.update(range(first + (begin >> bits), first + ((end - 1) >> bits) + 1))
        bits += 3
    return out


class Index:
    """One dictionary of bins and one list of least places for each contig."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a BAI file")
        at = 8
        self.bins: list[dict[int, list[tuple[int, int]]]] = []
        self.least: list[tuple[int, ...]] = []
        for _ in range(struct.unpack_from("<i", data, 4)[0]):
            own, at, count = {}, at + 4, struct.unpack_from("<i", data, at)[0]
            for _ in range(count):
                number, n = struct.unpack_from("<Ii", data, at)
                values = struct.unpack_from(f"<{2 * n}Q", data, at + 8)
                at += 8 + 16 * n
                if number != TOTALS:
                    own[number] = list(zip(values[::2], values[1::2], strict=True))
            n = struct.unpack_from("<i", data, at)[0]
            self.least.append(struct.unpack_from(f"<{n}Q", data, at + 4))
            at += 4 + 8 * n
            self.bins.append(own)


def ranges_of(index: Index, wanted: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Ranges of virtual places that hold all reads that overlap one of (contig's number, begin, end); apart, in order."""
    found = []
    for ref, begin, end in wanted:
        if end <= begin or ref >= len(index.bins):
            continue
        least = index.least[ref]
        if not least or begin >> FINEST >= len(least):
            continue
        own = index.bins[ref]
        touched = own.keys() & bins_over(begin, end) if end - begin < 1 << 26 else own.keys()
        from_here = least[begin >> FINEST]
        found += [(max(a, from_here), b) for k in touched for a, b in own[k] if b > from_here]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        # Ranges that end and begin in one block are read together.
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class IndexWriter:
    """Gathers an index while a file is written: as many numbers as it has bins and finest windows."""

    def __init__(self, contigs: int) -> None:
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(contigs)]
        self.least: list[list[int]] = [[] for _ in range(contigs)]

    def add(self, ref: int, begin: int, end: int, start: int, stop: int) -> None:
        """A read over [begin, end) that lies at [start, stop) in the file."""
        if ref < 0:
            return
        ranges = self.bins[ref].setdefault(bin_of(begin, end), [])
        if ranges and ranges[-1][1] == start:
            ranges[-1][1] = stop
        else:
            ranges.append([start, stop])
        least = self.least[ref]
        for window in range(begin >> FINEST, ((end - 1) >> FINEST) + 1):
            least += [0] * (window + 1 - len(least))
            least[window] = min(least[window] or start, start)

    def extend(self, part: Index, shift: int) -> None:
        """What follows: an index of a later stretch of the file, its places moved by ``shift``."""
        for bins, least, own, places in zip(self.bins, self.least, part.bins, part.least, strict=True):
            for number, ranges in own.items():
                bins.setdefault(number, []).extend([a + shift, b + shift] for a, b in ranges)
            least += [0] * (len(places) - len(least))
            for window, place in enumerate(places):
                if place:
                    least[window] = least[window] or place + shift

    def content(self) -> bytes:
        out = bytearray(MAGIC + struct.pack("<i", len(self.bins)))
        for bins, least in zip(self.bins, self.least, strict=True):
            out += struct.pack("<i", len(bins))
            for number, ranges in sorted(bins.items()):
                out += struct.pack("<Ii", number, len(ranges)) + b"".join(struct.pack("<QQ", *r) for r in ranges)
            # A window that no read reaches has the place of the one before it.
            for k in range(1, len(least)):
                least[k] = least[k] or least[k - 1]
            out += struct.pack("<i", len(least)) + struct.pack(f"<{len(least)}Q", *least)
        return bytes(out)
