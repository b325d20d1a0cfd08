"""Deep-shallow sorting of byte windows: which windows of a buffer are equal.

Shallow: multikey quicksort, eight bytes a symbol, over all segments of a level at once; segments of one
window are done. Deep: windows that still agree after the shallow depth have a long common prefix, and a blind
trie orders them: it branches on the first byte where its windows differ and compares a new window with one
leaf only. Of windows that equal their segment's first one only the first enters the trie.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8


class BlindTrie:
    """Compact trie of equally long byte strings: inner nodes are [depth, {byte: child}], leaves lists of numbers."""

    def __init__(self, of):
        self.of = of  # the string of a number
        self.root = None

    def add(self, number: int) -> None:
        text = self.of(number)
        if self.root is None:
            self.root = [number]
            return
        # blind descent: bytes between branches are not looked at
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            child = children.get(text[depth])
            node = child if child is not None else next(iter(children.values()))
        other = self.of(node[0])
        if other == text:
            node.append(number)
            return
        split = next(i for i, (a, b) in enumerate(zip(text, other, strict=True)) if a != b)
        # second descent, to the branch point
        parent, key, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < split:
            parent, key, node = node, text[node[0]], node[1][text[node[0]]]
        if isinstance(node, tuple) and node[0] == split:
            node[1][text[split]] = [number]
            return
        inner = (split, {other[split]: node, text[split]: [number]})
        if parent is None:
            self.root = inner
        else:
            parent[1][key] = inner

    def leaves(self) -> list[list[int]]:
        """Numbers of equal strings together, strings in order."""
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def _symbols(buffer: bytes) -> np.ndarray:
    """The big-endian number of the eight bytes from every place; the buffer ends in eight spare bytes."""
    return np.ndarray((len(buffer) - SYMBOL + 1,), ">u8", buffer, strides=(1,))


def equal_windows(
    buffer: bytes, starts: np.ndarray, classes: np.ndarray, length: int, shallow: int = 16
) -> tuple[np.ndarray, np.ndarray]:
    """(window, segment): the windows buffer[start : start + length] that equal another one of their class.

    Equal windows have equal segment numbers; windows without an equal are left out. The buffer must
    go on for SYMBOL bytes after the last window.
    """
    symbols = _symbols(buffer)
    window = np.arange(len(starts))
    segment = classes
    depth = 0
    while len(window) and depth < min(shallow, length):
        # one level of the quicksort: order by symbol within segments, cut where symbols change
        step = min(SYMBOL, length - depth)
        key = symbols[starts[window] + depth].astype(np.uint64) >> np.uint64(8 * (SYMBOL - step))
        order = np.lexsort((key, segment))
        window, segment, key = window[order], segment[order], key[order]
        fresh = np.ones(len(window), bool)
        fresh[1:] = (segment[1:] != segment[:-1]) | (key[1:] != key[:-1])
        numbers = np.cumsum(fresh) - 1
        alone = np.bincount(numbers) == 1
        keep = ~alone[numbers]
        window, segment = window[keep], numbers[keep]
        depth += step
    if depth < length and len(window):
        window, segment = _deep(buffer, symbols, starts, window, segment, depth, length)
    return window, segment


def _deep(buffer, symbols, starts, window, segment, depth, length):
    """Segments with a common prefix of `depth` bytes, in order of segment, to segments of equal windows."""
    fresh = np.ones(len(window), bool)
    fresh[1:] = segment[1:] != segment[:-1]
    leader = window[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    same = np.ones(len(window), bool)
    for at in [*range(depth, length - SYMBOL + 1, SYMBOL), max(length - SYMBOL, 0)]:
        same &= symbols[starts[window] + at] == symbols[starts[leader] + at]
    # windows unlike their leader: a blind trie per segment, with the leader for the windows like it
    numbers = np.cumsum(fresh) - 1
    mixed = np.zeros(numbers[-1] + 1, bool)
    mixed[numbers[~same]] = True
    settled = ~mixed[numbers]
    out_window, out_segment = [window[settled]], [numbers[settled]]
    following = int(numbers[-1]) + 1
    rest = np.flatnonzero(~settled & ~same)
    base = starts.tolist() if len(rest) < len(starts) // 8 else starts

    def of(number: int) -> bytes:
        a = int(base[number]) + depth
        return buffer[a : a + length - depth]

    if len(rest):
        cuts = np.flatnonzero(np.diff(numbers[rest])) + 1
        for part in np.split(rest, cuts):
            trie = BlindTrie(of)
            trie.add(int(leader[part[0]]))
            for k in window[part].tolist():
                trie.add(k)
            for leaf in trie.leaves():
                if leaf[0] == leader[part[0]]:
                    continue
                if len(leaf) > 1:
                    out_window.append(np.array(leaf))
                    out_segment.append(np.full(len(leaf), following))
                following += 1
        like = ~settled & same
        out_window.append(window[like])
        out_segment.append(numbers[like])
    found, segments = np.concatenate(out_window), np.concatenate(out_segment)
    order = np.argsort(segments, kind="stable")
    found, segments = found[order], segments[order]
    several = np.bincount(segments)[segments] > 1
    return found[several], segments[several]
