"""Whole texts to token ids with the merge tables, through a cache of units.

A *unit* is a stretch of text whose tokens depend on nothing outside it:

- word vocabularies (white space dropped): what stands between white space;
- byte-level vocabularies (a space goes with the next word): a single space and
  the text up to the next single space, where both neighbours of the space are
  not white space.

Units repeat, so each distinct one is encoded once and kept in a bounded cache;
the units that a batch lacks are encoded together by ``BpeTables.encode_words``.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import regex

from varlake.llm.bpe_tables import ragged, tables

CACHE_UNITS = 300_000  #: distinct units kept per Python process, and as many of the generation before
GROUP_CHARS = 2_000_000  #: text handled at a time; longer texts are cut between units
#: Fixed value: the pattern of byte-level pre-tokenisation.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Controls that Python's split() takes for white space and Unicode does not.
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")
#: A space between two characters that are not white space.
LONE_SPACE = regex.compile(r"(?<=\S) (?=\S)")


def opens_with_only_space(unit: str) -> bool:
    return unit.rfind(" ") == 0 and len(unit) > 1 and not unit[1].isspace() and not unit[-1].isspace()


class Codec:
    def __init__(self, path: str):
        self.tables = tables(path)
        spec = self.tables.spec
        pre = spec["pre_tokenizer"]
        self.words = pre["type"] == "Sequence"
        if self.words:
            pattern = pre["pretokenizers"][0]["pattern"]["Regex"]
            self.pattern = regex.compile(pattern + r"|\n")
        else:
            self.pattern = regex.compile(BYTE_LEVEL)
        self.special = self.tables.special
        self.special_at = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.repaired = 0

    # ---- units
    def units(self, text: str) -> list[str]:
        if self.words:
            if SEPARATORS.search(text):
                return [u for u in SPACE.split(text) if u]
            return text.split()
        parts = text.split(" ")
        if "" not in parts and sum(map(len, map(str.strip, parts))) + len(parts) - 1 == len(text):
            return [parts[0], *[" " + u for u in parts[1:]]]
        cuts = [0, *(m.start() for m in LONE_SPACE.finditer(text)), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

    def stretches(self, text: str) -> Iterator[str]:
        """The text, cut between units if it is long."""
        cut = SPACE if self.words else LONE_SPACE
        at = 0
        while len(text) - at > GROUP_CHARS and (m := cut.search(text, at + GROUP_CHARS)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    # ---- learning the units that the cache lacks
    def _pieces(self, units: list[str]) -> tuple[list[str], list[int] | None]:
        """Pre-tokens of all units, one unit after the other; for words with a
        newline after each unit's, else with the number of each unit's."""
        if self.words:
            joined = "\n".join(units) + "\n"
            if not joined.isascii():
                joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")
            return self.pattern.findall(joined.lower()), None
        if opens_with_only_space(units[0]) and len(units) > 1:
            # learn() brings units of one kind: those that open with their only
            # space can be scanned in one go, as each such space opens a pre-token
            pieces = self.pattern.findall("".join(units))
            opens = [i for i, p in enumerate(pieces) if p[0] == " "]
            return pieces, np.diff([*opens, len(pieces)]).tolist()
        found = [self.pattern.findall(u) for u in units]
        return [p for f in found for p in f], [len(f) for f in found]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        pieces, per_unit = self._pieces(units)
        distinct = list(dict.fromkeys(pieces))
        index = dict(zip(distinct, range(len(distinct)), strict=True))
        which = np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))
        if per_unit is None:
            distinct[index["\n"]] = ""  # ends a unit, has no ids
            last = np.flatnonzero(which == index["\n"]) + 1
        else:
            last = np.cumsum(per_unit)
        flat, counts, failed = self.tables.encode_words([p.encode() for p in distinct])
        self.repaired += failed
        starts = np.cumsum(counts) - counts
        ids = flat[ragged(starts[which], counts[which])].astype("<u4").tobytes()
        ends = (4 * np.append(0, np.cumsum(counts[which]))[last]).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def learn(self, units: list[str]) -> None:
        """Encode units and keep their ids."""
        kinds: list[list[str]] = [[], [], []]
        for u in units:
            kinds[2 if "<|" in u and self.special_at.search(u) else 0 if self.words or opens_with_only_space(u) else 1].append(u)
        for plain in kinds[:2]:
            if plain:
                self.cache.update(zip(plain, self._encode_units(plain), strict=True))
        for u in kinds[2]:
            out, at = [], 0
            for m in self.special_at.finditer(u):
                if at < m.start():
                    out += self._encode_units([u[at : m.start()]])
                out.append(np.array([self.special[m[0]]], "<u4").tobytes())
                at = m.end()
            self.cache[u] = b"".join(out + (self._encode_units([u[at:]]) if at < len(u) else []))

    def _looked_up(self, texts: list[str]) -> Iterator[list[str]]:
        group = [self.units(t) for t in texts]
        wanted = set().union(*group)
        if len(self.cache) > CACHE_UNITS:  # the units of the last generation come back when they are asked for
            self.old, self.cache = self.cache, {}
        if lack := wanted.difference(self.cache):
            old = self.old
            again = [u for u in lack if u in old]
            self.cache.update(zip(again, map(old.__getitem__, again), strict=True))
            self.learn(list(lack.difference(again)))
        yield from group

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        for group in grouped(texts):
            if len(group) == 1 and len(group[0]) > GROUP_CHARS:
                yield b"".join(b for part in self.stretches(group[0]) for b in self._encode_group([part]))
            else:
                yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        for units in self._looked_up(texts):
            cache = self.cache
            yield b"".join([cache[u] for u in units])

    def piece_counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Byte-level vocabularies: where each pre-token (or special token)
        starts, and the number of its tokens."""
        starts: list[int] = []
        pieces: list[str] = []
        fixed: list[int] = []  # places of special tokens
        at = 0
        for m in [*self.special_at.finditer(text), None]:
            for p in self.pattern.finditer(text, at, m.start() if m else len(text)):
                starts.append(p.start())
                pieces.append(p[0])
            if m:
                fixed.append(len(pieces))
                starts.append(m.start())
                pieces.append("")
                at = m.end()
        index: dict[str, int] = {}
        which = np.fromiter((index.setdefault(p, len(index)) for p in pieces), np.int64, len(pieces))
        _, counts, failed = self.tables.encode_words([p.encode() for p in index])
        self.repaired += failed
        out = counts[which] if len(which) else which
        out[fixed] = 1
        return np.array(starts, np.int64), out

    # ---- back to text
    def decode(self, ids: list[int]) -> str:
        """As the library does: without a decoder the tokens joined by a space,
        with the byte-level one the bytes that the tokens stand for.  Ids that
        the vocabulary lacks are left out."""
        size, strings = len(self.tables.strings), self.tables.strings
        if ids and not (0 <= min(ids) and max(ids) < size):
            ids = [i for i in ids if 0 <= i < size]
        if self.tables.spec["decoder"] is None:
            return " ".join(map(strings.__getitem__, ids))
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")

    @functools.cached_property
    def _bytes(self) -> list[bytes]:
        from varlake.llm.bpe_tables import byte_chars

        back = {ord(c): b for b, c in enumerate(byte_chars())}
        named = set(self.special.values())
        return [s.encode() if i in named else bytes(back[ord(c)] for c in s) for i, s in enumerate(self.tables.strings)]


def grouped(texts: Iterable[str]) -> Iterator[list[str]]:
    """Consecutive texts, in groups of about GROUP_CHARS characters."""
    group: list[str] = []
    size = 0
    for t in texts:
        if group and size + len(t) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, one per Python process."""
    return Codec(path)
