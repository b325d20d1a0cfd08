"""Encode texts chunk by chunk, remembering the chunks seen, within a bound of entries."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

MEMO_ENTRIES = 400_000
ENTRY_BYTES = 256  # of an entry on average; longer ones fill a memo sooner
OBJECTS = 130  # bytes that an entry takes besides its characters and ids
SHORT = 64  # characters of a text's first piece up to which it is remembered


def kept(name: str, make: Callable):
    """One object per Python worker process and name: workers serve many tasks, memos should too."""
    store = sys.modules.setdefault("_regmill_kept", types.ModuleType("_regmill_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


class _Odd(Exception):
    """A chunk that touches another space: the text cannot be cut there."""


class Memo(dict):
    """Results of a function by argument, in two generations of at most `entries` each, and of `entries` times ENTRY_BYTES.

    A full generation becomes the older one; what is used of that comes back, the rest goes with the next change. A result
    that alone would fill a quarter of a generation is not kept.
    """

    def __init__(self, function: Callable, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.function, self.entries, self.older = function, entries, {}
        self.most, self.size = max(entries * ENTRY_BYTES, 1 << 12), 0

    def __missing__(self, key):
        value = self.older.get(key)
        return self.put(key, self.function(key) if value is None else value)

    def put(self, key, value):
        size = OBJECTS + 5 * len(key)  # ids are four bytes and rarely more than characters
        if size > self.most // 4:
            return value
        if len(self) >= self.entries or self.size + size > self.most:
            self.older = dict(self)
            self.forget()
        self.size += size
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.size = 0

    def drop(self) -> None:
        """Both generations."""
        self.forget()
        self.older = {}

    def unknown(self, keys: set) -> list:
        """Those of the keys that neither generation has; those in the older one come back."""
        missing = [k for k in keys if k not in self]
        older = self.older
        for k in missing:
            if k in older:
                self.put(k, older[k])
        return [k for k in missing if k not in older]


class ChunkEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    In the split pattern of byte-level BPE a match starts at every single space between two non-spaces and at no
    other place does a match hold a space after a non-space. So texts are cut there, and `encode` sees each
    distinct chunk (with its leading space) once. Texts with other white space next to a space are
    given to `encode` whole.
    """

    def __init__(
        self,
        encode: Callable[[str], bytes],
        entries: int = MEMO_ENTRIES,
        encode_many: Callable[[list[str]], list[bytes]] | None = None,
    ):
        self.encode = encode
        self.encode_many = encode_many or (lambda pieces: [encode(p) for p in pieces])
        self.memo, self.new = Memo(self._reserved, entries), {}
        self.starts = Memo(encode, entries // 8)

    def _reserved(self, chunk: str) -> bytearray:
        """A buffer that stands for the chunk's ids until they are known."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Odd
        return self.new.setdefault(chunk, bytearray())

    def _found(self, text: str | None) -> list:
        """Ids of the text's pieces, some of them still reserved buffers."""
        if not text:
            return []
        first, *parts = text.split(" ")
        if parts and (not first or first[-1].isspace()):
            return [self.encode(text)]
        try:
            start = self.starts[first] if len(first) <= SHORT else self.encode(first)
            return [start, *map(self.memo.__getitem__, parts)]
        except _Odd:
            return [self.encode(text)]

    def _fill(self) -> None:
        for (chunk, buffer), ids in zip(
            self.new.items(), self.encode_many([" " + c for c in self.new]), strict=True
        ):
            buffer += ids
            holder = self.memo if chunk in self.memo else self.memo.older
            if chunk in holder:
                holder[chunk] = ids

    def drop(self) -> None:
        self.memo.drop()
        self.starts.drop()

    def ids(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; chunks that are not known yet are encoded all at once."""
        try:
            found = [self._found(text) for text in texts]
            self._fill()
        except BaseException:
            # nothing may stay reserved: the worker can be given another task
            self.memo.drop()
            raise
        finally:
            self.new = {}
        return [b"".join(pieces) for pieces in found]
