"""Reader of compound files (the container of doc, xls, ppt and msg), by the published format: sectors, allocation chains, directory."""

from __future__ import annotations

import struct

MAGIC = bytes.fromhex("d0cf11e0a1b11ae1")
_END = 0xFFFFFFFA  # sector numbers from here on are marks


class Compound:
    """``streams``: path within the file -> function that reads it. Damaged chains end where they break."""

    def __init__(self, content: bytes) -> None:
        if content[:8] != MAGIC:
            raise ValueError("not a compound file")
        self.data = content
        self.size, self.small = 1 << struct.unpack_from("<H", content, 30)[0], 1 << struct.unpack_from("<H", content, 32)[0]
        first_dir, self.cutoff, first_mini, _, first_difat, n_difat = struct.unpack_from("<I4xIIIII", content, 48)
        fat_sectors = [s for s in struct.unpack_from("<109I", content, 76) if s < _END]
        for _ in range(min(n_difat, 1 << 16)):
            if first_difat >= _END:
                break
            part = struct.unpack(f"<{self.size // 4}I", self._sector(first_difat).ljust(self.size, b"\xff"))
            fat_sectors += [s for s in part[:-1] if s < _END]
            first_difat = part[-1]
        self.fat = self._numbers(b"".join(self._sector(s) for s in fat_sectors))
        self.mini_fat = self._numbers(self._chain(first_mini, self.fat, self._sector))
        self._read_directory(self._chain(first_dir, self.fat, self._sector))

    @staticmethod
    def _numbers(raw: bytes) -> tuple[int, ...]:
        return struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4])

    def _sector(self, n: int) -> bytes:
        return self.data[(n + 1) * self.size : (n + 2) * self.size]

    @staticmethod
    def _chain(start: int, table: tuple[int, ...], get) -> bytes:
        out, seen = [], set()
        while start < _END and start < len(table) and start not in seen:
            seen.add(start)
            out.append(get(start))
            start = table[start]
        return b"".join(out)

    def _read_directory(self, raw: bytes) -> None:
        self.streams: dict = {}
        entries = []
        for at in range(0, len(raw) - 127, 128):
            length, kind = struct.unpack_from("<HB", raw, at + 64)
            left, right, child = struct.unpack_from("<III", raw, at + 68)
            start, size = struct.unpack_from("<IQ", raw, at + 116)
            entries.append((raw[at : at + max(0, min(length, 64) - 2)].decode("utf-16-le", "replace"), kind, left, right, child, start, size & 0xFFFFFFFF))
        root = next((e for e in entries if e[1] == 5), None)
        self.mini = self._chain(root[5], self.fat, self._sector) if root else b""
        todo, seen = ([(root[4], "")] if root else []), set()
        while todo:
            n, base = todo.pop()
            if n >= len(entries) or n in seen:
                continue
            seen.add(n)
            name, kind, left, right, child, start, size = entries[n]
            todo += [(left, base), (right, base)]
            if kind == 1:
                todo.append((child, f"{base}{name}/"))
            elif kind == 2:
                self.streams[base + name] = (start, size)

    def read(self, path: str) -> bytes:
        start, size = self.streams[path]
        if size < self.cutoff:
            return self._chain(start, self.mini_fat, lambda n: self.mini[n * self.small : (n + 1) * self.small])[:size]
        return self._chain(start, self.fat, self._sector)[:size]
