"""Byte-pair merge tables and the speculate-and-verify word encoder.

A word is a sequence of symbols (its UTF-8 bytes; with an end-of-word suffix
the last byte is a symbol of its own kind).  Encoding a batch of distinct words:

1. *Speculate*: greedy longest match over a trie of all tokens proposes a
   segmentation, for all words of the batch at once in numpy.
2. *Verify*: every adjacent pair of proposed tokens is tested for
   compatibility, each distinct pair once, vectorised.  A segmentation of which
   all adjacent pairs are compatible is the one that merging yields.
3. *Repair*: only words with an incompatible pair are merged exactly.

Compatibility of (a, b): replay the merges at the seam backwards.  At any
moment the piece left of the seam is a right descendant of ``a`` and the piece
right of it a left descendant of ``b``.  The pair fails if some two pieces that
meet at the seam have a merge that comes before both are absorbed by their
parents (equal ranks: the left one goes first).
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np

SYMS = 512
SHORT = 64  #: words up to this many symbols are repaired in numpy, longer ones with a heap


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if it is a visible Latin-1 character, else the next unused code from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(visible) else chr(next(rest)) for b in range(256)]


class IntMap:
    """Read-only map from non-negative int64 keys to int32 values, looked up
    for whole arrays at a time (open addressing, a quarter full at most)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            spot, first = np.unique(slot[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[spot], self.values[spot] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            taken = self.keys[slot[todo]] >= 0
            slot[todo[taken]] = (slot[todo[taken]] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where absent."""
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.values[slot], np.int32(-1))
        left = np.flatnonzero((seen != keys) & (seen >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            seen = self.keys[slot]
            hit = seen == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            go = ~hit & (seen >= 0)
            left, slot = left[go], slot[go]
        return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class BpeTables:
    """The merges of a ``tokenizers`` JSON file as arrays.

    Token ids must grow with merge order (checked), so that the id of a merged
    token serves as the merge's rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        model = self.spec["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.suffix = bool(suffix)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [""] * size
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.symbol_id = np.full(SYMS, -1, np.int32)
        forms: dict[int, tuple[int, ...]] = {}
        for b, c in enumerate(byte_chars()):
            for sym, s in ((b, c), (256 + b, c + suffix))[: 1 + self.suffix]:
                self.symbol_id[sym] = vocab[s]
                forms[vocab[s]] = (sym,)
        self.left = np.full(size, -1, np.int32)
        self.right = np.full(size, -1, np.int32)
        last = max(forms)
        pairs, made = [], []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if z <= last:
                raise ValueError("token ids must grow with merge order")
            last = z
            self.left[z], self.right[z] = x, y
            forms[z] = forms[x] + forms[y]
            pairs.append(x * 65536 + y)
            made.append(z)
        self.pairs = IntMap(np.array(pairs, np.int64), np.array(made, np.int32))
        self.pair_dict = dict(zip(pairs, made, strict=True))
        nodes: dict[int, int] = {}
        ends = [-1]
        for token, form in forms.items():
            at = 0
            for sym in form:
                key = at * SYMS + sym
                if (nxt := nodes.get(key)) is None:
                    nxt = nodes[key] = len(ends)
                    ends.append(-1)
                at = nxt
            ends[at] = token
        self.trie = IntMap(np.fromiter(nodes.keys(), np.int64), np.fromiter(nodes.values(), np.int32))
        self.first_node = self.trie.find(np.arange(SYMS, dtype=np.int64))
        self.token_at = np.array(ends, np.int32)

    # ---- speculate
    def _longest(self, syms: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that starts at each position: its id, its length."""
        best, length = self.symbol_id[syms].copy(), np.ones(len(syms), np.int64)
        at = np.flatnonzero(np.arange(len(syms)) + 1 < end)
        node = self.first_node[syms[at]].astype(np.int64)
        depth = 1
        while len(at):
            nxt = self.trie.find(node * SYMS + syms[at + depth])
            go = nxt >= 0
            at, node = at[go], nxt[go].astype(np.int64)
            depth += 1
            token = self.token_at[node]
            full = token >= 0
            best[at[full]], length[at[full]] = token[full], depth
            more = at + depth < end[at]
            at, node = at[more], node[more]
        return best, length

    def propose(self, syms: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest-match tokens of all words, and how many of each."""
        ends = starts + lens
        best, length = self._longest(syms, np.repeat(ends, lens))
        taken = np.zeros(len(syms), bool)
        row = np.flatnonzero(lens > 0)
        cur = starts[row]
        while len(row):
            taken[cur] = True
            cur = cur + length[cur]
            go = cur < ends[row]
            row, cur = row[go], cur[go]
        counts = np.add.reduceat(np.append(taken, False), np.append(starts, len(syms))[:-1], dtype=np.int64) if len(starts) else lens
        counts[lens == 0] = 0
        return best[taken], counts

    # ---- verify
    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays two tokens when merged together."""
        top = np.int32(2**31 - 1)
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        until_x, until_y = np.full(len(a), top), np.full(len(a), top)
        while len(at):
            made = self.pairs.find(x * 65536 + y)
            bad = (made >= 0) & (made < until_x) & (made <= until_y)
            ok[at[bad]] = False
            back_x = x > y  # the younger of the two is undone; of twins the right one
            nx, ny = self.right[x], self.left[y]
            go = ~bad & np.where(back_x, nx >= 0, ny >= 0)
            until_x, until_y = np.where(back_x, x, until_x)[go], np.where(back_x, until_y, y)[go]
            x, y = np.where(back_x, nx, x)[go].astype(np.int64), np.where(back_x, y, ny)[go].astype(np.int64)
            at = at[go]
        return ok

    # ---- repair
    def _merge_short(self, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many short words, one merge a word and round."""
        out_ids: list[np.ndarray] = []
        out_row: list[np.ndarray] = []
        ids, row = ids.astype(np.int64), np.repeat(np.arange(len(lens)), lens)
        none = np.int64(2**31)
        while len(ids):
            made = np.full(len(ids), none)
            inner = np.flatnonzero(row[:-1] == row[1:])
            found = self.pairs.find(ids[inner] * 65536 + ids[inner + 1]).astype(np.int64)
            made[inner] = np.where(found >= 0, found, none)
            start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            least = np.minimum.reduceat(made, start)
            size = np.diff(np.append(start, len(ids)))
            over = np.repeat(least == none, size)
            out_ids.append(ids[over])
            out_row.append(row[over])
            hits = np.flatnonzero((made == np.repeat(least, size)) & ~over)
            hits = hits[np.append(True, row[hits[1:]] != row[hits[:-1]])] if len(hits) else hits
            ids[hits] = made[hits]
            keep = ~over
            keep[hits + 1] = False
            ids, row = ids[keep], row[keep]
        all_ids, all_rows = np.concatenate(out_ids or [ids]), np.concatenate(out_row or [row])
        order = np.argsort(all_rows, kind="stable")
        return all_ids[order], np.bincount(all_rows, minlength=len(lens))

    def merge_long(self, ids: list[int]) -> list[int]:
        """Exact merging of one word with a heap, O(n log n)."""
        ids, n, get = list(ids), len(ids), self.pair_dict.get
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(z, i, ids[i], ids[i + 1]) for i in range(n - 1) if (z := get(ids[i] * 65536 + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            z, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = z, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (w := get(z * 65536 + ids[nxt[i]])) is not None:
                    heapq.heappush(heap, (w, i, z, ids[nxt[i]]))
            if prv[i] >= 0 and (w := get(ids[prv[i]] * 65536 + z)) is not None:
                heapq.heappush(heap, (w, prv[i], ids[prv[i]], z))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids of all words one after the other, ids per word, and how many
        words had to be merged exactly."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        if not lens.sum():
            return np.zeros(0, np.int32), lens, 0
        syms = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(lens) - lens
        if self.suffix:
            syms[(starts + lens - 1)[lens > 0]] += 256
        ids, counts = self.propose(syms, starts, lens)
        row = np.repeat(np.arange(len(words)), counts)
        seam = np.flatnonzero(row[:-1] == row[1:])
        pairs, back = np.unique(ids[seam].astype(np.int64) * 65536 + ids[seam + 1], return_inverse=True)
        ok = self.compatible(pairs >> 16, pairs & 65535)[back]
        failed = np.unique(row[seam[~ok]])
        if not len(failed):
            return ids, counts, 0
        short = failed[lens[failed] <= SHORT]
        fixed: list[np.ndarray] = []
        fixed_rows: list[np.ndarray] = []
        if len(short):
            base = self.symbol_id[syms[ragged(starts[short], lens[short])]]
            got, n = self._merge_short(base, lens[short])
            fixed.append(got)
            fixed_rows.append(np.repeat(short, n))
        for w in failed[lens[failed] > SHORT].tolist():
            got = self.merge_long(self.symbol_id[syms[starts[w] : starts[w] + lens[w]]].tolist())
            fixed.append(np.array(got, np.int64))
            fixed_rows.append(np.full(len(got), w))
        good = np.ones(len(words), bool)
        good[failed] = False
        keep = good[row]
        all_rows = np.concatenate([row[keep], *fixed_rows])
        order = np.argsort(all_rows, kind="stable")
        return (np.concatenate([ids[keep], *fixed])[order]).astype(np.int32), np.bincount(all_rows, minlength=len(words)), len(failed)


@functools.lru_cache(maxsize=4)
def tables(path: str) -> BpeTables:
    """The tables of a file, loaded once per Python process."""
    return BpeTables(path)
