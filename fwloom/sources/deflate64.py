"""Deflate64, method 9 of zip archives, decoded as a stream: Deflate with a window of 64 KB, two more distance codes, and a longest code with 16
extra bits. Used where the optional package inflate64 is missing; plain Python, so some megabytes a second."""

from __future__ import annotations

from collections.abc import Callable, Iterator

WINDOW = 1 << 16
FLUSH = 1 << 17
#: The order in which the lengths of the code of codes are stored; fixed by the format.
ORDER = (16, 17, 18, 0, 8, 7, 9, 6, 10, 5, 11, 4, 12, 3, 13, 2, 14, 1, 15)


def ladder(first: int, plain: int, group: int, count: int) -> list[tuple[int, int]]:
    """Base and extra bits of codes: ``plain`` of one value each, then groups with one more extra bit each."""
    out, at = [], first
    for n in range(count):
        bits = max(0, (n - plain) // group + 1)
        out.append((at, bits))
        at += 1 << bits
    return out


#: Lengths of codes 257 to 284, and 285; distances of codes 0 to 31.
LENGTHS = [*ladder(3, 8, 4, 28), (3, 16)]
DISTANCES = ladder(1, 4, 2, 32)


class Damaged(ValueError):
    """A stream that is no Deflate64."""


def table_of(lengths: list[int]) -> tuple[list[tuple[int, int]], int]:
    """Symbol and bits of every string of as many bits as the longest code has, first bit lowest."""
    longest = max(lengths, default=0)
    if not longest:
        return [], 0
    table: list[tuple[int, int]] = [(-1, 0)] * (1 << longest)
    code = 0
    for bits in range(1, longest + 1):
        for symbol, n in enumerate(lengths):
            if n == bits:
                if code >= 1 << bits:
                    raise Damaged("too many codes of a length")
                start = int(f"{code:0{bits}b}"[::-1], 2)
                for at in range(start, 1 << longest, 1 << bits):
                    table[at] = (symbol, bits)
                code += 1
        code <<= 1
    return table, longest


class Bits:
    """Bits of a stream, lowest first."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.held, self.count, self.data, self.at = read, 0, 0, b"", 0

    def fill(self, n: int) -> None:
        """At least ``n`` bits, or all that are left."""
        while self.count < n:
            if self.at >= len(self.data):
                self.data, self.at = self.read(1 << 16), 0
                if not self.data:
                    return
            part = self.data[self.at : self.at + 6]
            self.held |= int.from_bytes(part, "little") << self.count
            self.count += 8 * len(part)
            self.at += len(part)

    def take(self, n: int) -> int:
        self.fill(n)
        if self.count < n:
            raise EOFError("stream ends inside a block")
        out = self.held & (1 << n) - 1
        self.held >>= n
        self.count -= n
        return out

    def symbol(self, table: list[tuple[int, int]], longest: int) -> int:
        if self.count < longest:
            self.fill(longest)
        symbol, n = table[self.held & len(table) - 1] if table else (-1, 0)
        if symbol < 0:
            raise Damaged("no such code")
        if n > self.count:
            raise EOFError("stream ends inside a block")
        self.held >>= n
        self.count -= n
        return symbol


def tables(bits: Bits) -> tuple[tuple[list[tuple[int, int]], int], tuple[list[tuple[int, int]], int]]:
    """Tables of literals and distances that a block brings along."""
    literals, distances, codes = bits.take(5) + 257, bits.take(5) + 1, bits.take(4) + 4
    own = [0] * 19
    for n in ORDER[:codes]:
        own[n] = bits.take(3)
    table, longest = table_of(own)
    lengths: list[int] = []
    while len(lengths) < literals + distances:
        symbol = bits.symbol(table, longest)
        if symbol < 16:
            lengths.append(symbol)
        elif symbol == 16:
            if not lengths:
                raise Damaged("nothing to repeat")
            lengths += [lengths[-1]] * (3 + bits.take(2))
        else:
            lengths += [0] * (3 + bits.take(3) if symbol == 17 else 11 + bits.take(7))
    if len(lengths) > literals + distances:
        raise Damaged("too many lengths")
    return table_of(lengths[:literals]), table_of(lengths[literals:])


FIXED = (table_of([8] * 144 + [9] * 112 + [7] * 24 + [8] * 8), table_of([5] * 32))


def inflate64(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The bytes of a stream, of which ``read`` gives the next; memory is a window and a piece."""
    bits, out = Bits(read), bytearray()
    last = 0
    while not last:
        last, kind = bits.take(1), bits.take(2)
        if kind == 0:
            bits.take(bits.count & 7)
            size, check = bits.take(16), bits.take(16)
            if size ^ check != 0xFFFF:
                raise Damaged("length of a stored block")
            for _ in range(size):
                out.append(bits.take(8))
        elif kind == 3:
            raise Damaged("kind of a block")
        else:
            (literals, most), (distances, far) = FIXED if kind == 1 else tables(bits)
            while (symbol := bits.symbol(literals, most)) != 256:
                if symbol < 256:
                    out.append(symbol)
                    continue
                if symbol > 285:
                    raise Damaged("no such length")
                base, extra = LENGTHS[symbol - 257]
                length = base + bits.take(extra)
                base, extra = DISTANCES[bits.symbol(distances, far)]
                distance = base + bits.take(extra)
                if distance > len(out):
                    raise Damaged("distance before the start")
                if distance >= length:
                    start = len(out) - distance
                    out += out[start : start + length]
                else:
                    piece = bytes(out[-distance:])
                    out += (piece * (length // distance + 1))[:length]
                if len(out) >= FLUSH:
                    yield bytes(out[:-WINDOW])
                    del out[:-WINDOW]
        if len(out) >= FLUSH:
            yield bytes(out[:-WINDOW])
            del out[:-WINDOW]
    yield bytes(out)
