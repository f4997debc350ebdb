"""Longest matches of a vocabulary at every place of a text: an Aho-Corasick automaton as numpy arrays.

The automaton is that of the reversed words and reads the text from its end,
so the longest word that ends where it stands is the longest that starts there
in the text. A match depends on no more characters than the longest word has,
so stretches of the text are read side by side, each from that many characters
behind its end.
"""

from __future__ import annotations

import numpy as np

LANE = 112               # places that a stretch answers for
MULTIPLIER = 0x9E3779B97F4A7C15


class LongestMatch:
    """Of ``words`` (text to number): the number of the longest at a place, -1 where there is none."""

    def __init__(self, words: dict[str, int]):
        self.reach = max(map(len, words))
        chars = sorted({c for w in words for c in w})
        self.number = np.zeros(0x110000, np.int32)          # 0: a character of no word
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        code = {c: k + 1 for k, c in enumerate(chars)}
        self.width = len(chars) + 1
        child: dict[int, int] = {}
        parent, out = [0], [-1]
        for w, i in words.items():
            node = 0
            for c in reversed(w):
                key = node * self.width + code[c]
                if key not in child:
                    child[key] = len(out)
                    parent.append(node)
                    out.append(-1)
                node = child[key]
            out[node] = i
        fail, depth = [0] * len(out), [0] * len(out)
        for node in range(1, len(out)):                     # a parent is made before its children
            depth[node] = depth[parent[node]] + 1
        for _, key, node in sorted((depth[n], k, n) for k, n in child.items()):
            if depth[node] > 1:
                f, c = fail[parent[node]], key % self.width
                while f and f * self.width + c not in child:
                    f = fail[f]
                fail[node] = child.get(f * self.width + c, 0)
            if out[node] < 0:
                out[node] = out[fail[node]]
        self.fail, self.out = np.array(fail), np.array(out)
        self.root = np.array([child.get(c, 0) for c in range(self.width)])
        self._table(child)

    def _table(self, child: dict[int, int]) -> None:
        """The transitions by the hash of (node, character), the next free slot where it is taken."""
        self.bits = max(len(child) * 6, 64).bit_length()
        self.keys = np.full((1 << self.bits) + 64, -1)
        self.nodes = np.zeros(len(self.keys), np.int64)
        keys = np.fromiter(child, np.int64, len(child))
        for key, slot in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.nodes[slot] = key, child[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _child(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The transition of each (node, character), -1 where there is none."""
        key = node * self.width + char
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.nodes[slot], -1)
        rest = np.flatnonzero((found != key) & (found >= 0))
        while len(rest):
            slot[rest] += 1
            found = self.keys[slot[rest]]
            hit = found == key[rest]
            out[rest[hit]] = self.nodes[slot[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out

    def __call__(self, text: str) -> np.ndarray:
        n = len(text)
        lanes = max(-(-n // LANE), 1)
        chars = np.zeros(lanes * LANE + self.reach, np.int64)
        chars[:n] = self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        out = np.full(lanes * LANE, -1)
        start, node = np.arange(lanes) * LANE, np.zeros(lanes, np.int64)
        for at in range(LANE + self.reach - 2, -1, -1):
            char = chars[start + at]
            new = self.root[char]
            inner = np.flatnonzero((node > 0) & (char > 0))
            back = node[inner]
            while len(inner):
                to = self._child(back, char[inner])
                hit = to >= 0
                new[inner[hit]] = to[hit]
                inner, back = inner[~hit], self.fail[back[~hit]]
                inner, back = inner[back > 0], back[back > 0]
            node = new
            if at < LANE:
                out[start + at] = self.out[node]
        return out[:n]
