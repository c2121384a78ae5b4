"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A proposal is the BPE result
exactly if every two neighbours, merged alone, stay as they are: take the first
merge of the whole word that crosses a border; up to then all merges lie inside
tokens, so the two neighbours alone would have met the same merge. The pairs of
a batch are checked together against a sorted table of known pairs; a pair that
is new is merged once. Only words with a failing pair are merged exactly.
"""

from __future__ import annotations

import functools
import gc
import heapq
import json
import re
import unicodedata
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from paddock.llm.common import arrow_map, pick, sha256

#: White space of the Unicode property of that name, which the tokenizer's ``\\s`` means; ``str.split`` and the
#: ``\\s`` of ``re`` also know others.
_SPACE = "\t-\r \x85\xa0  -     　"
_SPACES = re.compile(f"[{_SPACE}]+")
_SPACE_SET = {chr(c) for c in range(0x10000) if _SPACES.match(chr(c))}
#: Characters of a text that are worked on together; longer texts are cut at white space.
PIECE = 1 << 19
#: Words kept with their ids, their bytes and their ids; full, the store begins anew. These bound memory, not results.
STORE_WORDS, STORE_BYTES, STORE_IDS = 1 << 19, 1 << 23, 1 << 21
#: Entries of the young half of the cache of words of texts that are not told apart in arrays.
CACHE = 100_000
#: Code points below this are told apart by classes of letters and numbers written out, others by their properties.
_LATIN = 0x250
#: Longest word, in bytes, that is merged beside others; longer ones use a heap.
SIDE_BY_SIDE = 64
#: The split the file must name, and the endings it keeps apart.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BLANK, _LETTER, _NUMBER, _OTHER = range(4)  # kinds of characters
_ALONE = 0xFFFF
_NEVER = np.int32(2**31 - 1)
_NOTHING = np.zeros(0, np.uint16)


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte (rule of byte-level BPE)."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(other)) for b in range(256)]


class Cache:
    """Results by word in two halves: a full young half becomes the old one, words in use move on."""

    def __init__(self, entries: int) -> None:
        self.entries = entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def holding(self, words: set[str], make: Callable[[list[str]], dict[str, bytes]]) -> dict[str, bytes]:
        """A table that has all these words; ``make`` gives those not kept."""
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young
        missing = words.difference(self.young)
        if missing and self.old:
            moved = {w: self.old[w] for w in missing.intersection(self.old)}
            self.young.update(moved)
            missing.difference_update(moved)
        if missing:
            self.young.update(make(list(missing)))
        return self.young


def _kinds() -> np.ndarray:
    """Kind of each code point below _LATIN."""
    space = set(map(ord, _SPACE_SET))
    category = [unicodedata.category(chr(c))[0] for c in range(_LATIN)]
    kinds = [_BLANK if c in space else {"L": _LETTER, "N": _NUMBER}.get(k, _OTHER) for c, k in enumerate(category)]
    return np.array(kinds, np.uint8)


def _lower(text: str) -> str:
    """Composed and in lower case, character by character: no final sigma."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


def _word_starts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the words of a text, and the blanks between them, begin.

    A word is a run of letters, one number, or a run of other characters; an
    apostrophe that begins such a run takes an ending behind it into a word.
    """
    kind = kinds[codes]
    start = np.ones(len(codes), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    quotes = np.flatnonzero((codes == ord("'")) & start)
    if len(quotes):
        after = np.concatenate([codes, np.zeros(2, codes.dtype)])
        first, second = after[quotes + 1], after[quotes + 2]
        one = np.isin(first, [ord(e) for e in _ENDINGS if len(e) == 1])
        two = np.zeros(len(quotes), bool)
        for a, b in (e for e in _ENDINGS if len(e) == 2):
            two |= (first == ord(a)) & (second == ord(b))
        for some, size in ((one, 2), (two & ~one, 3)):
            at = quotes[some]
            for k in range(1, size):
                start[at + k] = False
            at = at + size
            start[at[at < len(codes)]] = True
    return np.flatnonzero(start)


class Lookup:
    """Values (int32, not negative) by key (uint32) for arrays of keys: open addressing in arrays."""

    _FREE = np.uint32(2**32 - 1)  # no key is as large

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(int(4 * len(keys)).bit_length(), 4)
        self.keys = np.full(1 << self.bits, self._FREE, np.uint32)
        self.values = np.full(1 << self.bits, -1, np.int32)
        keys, values, slots = keys.astype(np.uint32), values.astype(np.int32), self._slots(keys.astype(np.uint32))
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == self._FREE)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, -1 where it is not known."""
        slots = self._slots(keys)
        there = self.keys[slots]
        values = np.where(there == keys, self.values[slots], -1)
        asked = np.flatnonzero((there != keys) & (there != self._FREE))
        slots = slots[asked]
        while len(asked):
            slots = (slots + 1) & (len(self.keys) - 1)
            there = self.keys[slots]
            same = there == keys[asked]
            values[asked[same]] = self.values[slots[same]]
            on = ~same & (there != self._FREE)
            asked, slots = asked[on], slots[on]
        return values


class Store:
    """Words (bytes) with their ids, in arrays; many are looked up at once. Equal hashes are confirmed byte by byte."""

    _ODD = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.bits = 1 + (STORE_WORDS - 1).bit_length()
        self.power, self.back = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.hash, self.at, self.size = (np.zeros(STORE_WORDS, t) for t in (np.uint64, np.int32, np.int32))
        self.ids_at, self.ids_size = np.zeros(STORE_WORDS, np.int32), np.zeros(STORE_WORDS, np.int32)
        self.text, self.ids = np.zeros(STORE_BYTES, np.uint8), np.zeros(STORE_IDS, np.uint16)
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.n = self.n_text = self.n_ids = 0

    def hashes(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A hash of each word, from running sums over all bytes."""
        if len(self.power) < len(flat) + 1:
            n = 2 * len(flat) + 1
            for name, factor in (("power", self._ODD), ("back", pow(self._ODD, -1, 1 << 64))):
                own = np.full(n, factor, np.uint64)
                own[0] = 1
                setattr(self, name, np.cumprod(own))
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat + np.uint64(1)) * self.power[: len(flat)], out=sums[1:])
        found = (sums[starts + sizes] - sums[starts]) * self.back[starts]
        found ^= found >> np.uint64(31)
        return found * np.uint64(self._ODD)

    def find(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it is not kept."""
        found = np.full(len(starts), -1, np.int64)
        asked, slot = np.arange(len(starts)), self._slot(hashes)
        while len(asked):
            entry = self.slots[slot]
            equal = (entry >= 0) & (self.hash[entry] == hashes[asked])
            found[asked[equal]] = entry[equal]
            on = (entry >= 0) & ~equal
            asked, slot = asked[on], (slot[on] + 1) & (len(self.slots) - 1)
        place = np.flatnonzero(found >= 0)
        place, wrong = place[self.size[found[place]] == sizes[place]], found >= 0
        wrong[place] = False
        own, step = sizes[place], _steps(sizes[place])
        differ = flat[np.repeat(starts[place], own) + step] != self.text[np.repeat(self.at[found[place]], own) + step]
        if differ.any():
            wrong[np.repeat(place, own)[differ]] = True
        found[wrong] = -1
        return found

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(
        self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, ids: np.ndarray, count: np.ndarray
    ) -> None:
        """Keep distinct words that ``find`` did not have, with their ids one after the other."""
        n, n_text, n_ids = len(starts), int(sizes.sum()), len(ids)
        if self.n + n > STORE_WORDS or self.n_text + n_text > STORE_BYTES or self.n_ids + n_ids > STORE_IDS:
            self.clear()
            if n > STORE_WORDS or n_text > STORE_BYTES or n_ids > STORE_IDS:
                return
        new = slice(self.n, self.n + n)
        self.hash[new], self.size[new], self.ids_size[new] = hashes, sizes, count
        self.at[new] = self.n_text + np.cumsum(sizes) - sizes
        self.ids_at[new] = self.n_ids + np.cumsum(count) - count
        self.text[self.n_text : self.n_text + n_text] = flat[np.repeat(starts, sizes) + _steps(sizes)]
        self.ids[self.n_ids : self.n_ids + n_ids] = ids
        entry, slot = np.arange(self.n, self.n + n, dtype=np.int32), self._slot(hashes)
        while len(entry):
            free = np.flatnonzero(self.slots[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            self.slots[slot[free[first]]] = entry[free[first]]
            left = np.ones(len(entry), bool)
            left[free[first]] = False
            entry, slot = entry[left], (slot[left] + 1) & (len(self.slots) - 1)
        self.n, self.n_text, self.n_ids = self.n + n, self.n_text + n_text, self.n_ids + n_ids


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Trie:
    """Longest tokens of many words at once: all words walk the tokens' bytes side by side."""

    def __init__(self, inside: dict[bytes, int], ending: dict[bytes, int]) -> None:
        children: dict[int, int] = {}
        ids: list[list[int]] = [[-1], [-1]]
        for which, tokens in enumerate((inside, ending)):
            for token, place in tokens.items():
                node = 0
                for byte in token:
                    key = node << 8 | byte
                    if key not in children:
                        children[key] = len(ids[0])
                        ids[0].append(-1)
                        ids[1].append(-1)
                    node = children[key]
                ids[which][node] = place
        self.children = Lookup(np.array(list(children), np.uint32), np.array(list(children.values())))
        self.inside, self.ending = (np.array(i, np.int32) for i in ids)

    def longest(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the longest tokens from left to right of each word (bytes of ``flat``), and how many these are.

        Every byte must be a token, inside a word and at its end.
        """
        found = np.zeros((len(starts), int(sizes.max(initial=1))), np.int32)
        count = np.zeros(len(starts), np.int64)
        word = np.arange(len(starts))
        at, end = starts.copy(), starts + sizes
        node, best, best_at = np.zeros(len(word), np.int64), np.full(len(word), -1, np.int32), at.copy()
        while len(word):
            more = at < end
            key = node.astype(np.uint32) << np.uint32(8) | flat[np.minimum(at, len(flat) - 1)]
            child = np.where(more, self.children.get(key), -1)
            on = child >= 0
            at = at + on
            node = np.where(on, child, 0)
            token = np.where(at < end, self.inside[node], self.ending[node])
            better = on & (token >= 0)
            best, best_at = np.where(better, token, best), np.where(better, at, best_at)
            # a word that cannot go on gives its longest token and begins again behind it
            stop = np.flatnonzero(~on)
            found[word[stop], count[word[stop]]] = best[stop]
            count[word[stop]] += 1
            at[stop] = best_at[stop]
            node[stop], best[stop] = 0, -1
            left = on | (at < end)
            if not left.all():
                word, at, end = word[left], at[left], end[left]
                node, best, best_at = node[left], best[left], best_at[left]
        return found, count


class WordBpe:
    """Encoder and decoder for a ``tokenizers`` file of a BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        _require(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(map(re.escape, self.special)))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if split != _SPLIT:
            raise ValueError("not a BPE file whose words are split in the way this encoder knows")
        self.split = regex.compile(split).findall
        self.beyond = re.compile(f"[^\\x00-{chr(_LATIN - 1)}]").search
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, place in [*vocab.items(), *self.special.items()]:
            self.tokens[place] = token
        self.inside = {t: i for t, i in vocab.items() if not t.endswith(suffix)}
        self.ending = {t[: -len(suffix)]: i for t, i in vocab.items() if t.endswith(suffix)}
        self.suffix = len(suffix)
        sizes: dict[str, set[int]] = {}
        for token in [*self.inside, *self.ending]:
            sizes.setdefault(token[:3], {1, 2}).add(len(token))
        #: lengths, falling, of the tokens that begin with three characters
        self.reach = {start: tuple(sorted(known, reverse=True)) for start, known in sizes.items()}
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges.setdefault(vocab[left] << 16 | vocab[right], (rank, vocab[left + right]))
        self.rank = Lookup(np.array(list(self.merges), np.uint32), np.array([r for r, _ in self.merges.values()]))
        self.made = np.zeros(len(model["merges"]), np.uint32)
        for rank, made in self.merges.values():
            self.made[rank] = made
        letters = _byte_characters()
        self.characters = str.maketrans({chr(b): c for b, c in enumerate(letters)})
        byte_of = {c: b for b, c in enumerate(letters)}
        in_bytes = lambda tokens: {bytes(map(byte_of.__getitem__, t)): i for t, i in tokens.items()}
        self.trie = Trie(in_bytes(self.inside), in_bytes(self.ending))
        self.inside_byte = np.array([self.inside[c] for c in letters], np.uint32)
        self.ending_byte = np.array([self.ending[c] for c in letters], np.uint32)
        self.kinds = _kinds()
        self.symbols: dict[int, list[int]] = {}
        self.pairs = np.zeros(0, np.uint32)
        self.fits = np.zeros(0, bool)
        self.store = Store()
        self.words = Cache(CACHE)

    # encoding

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text (null: none)."""
        return next(self.encode_many([text]))

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; the words of about PIECE characters are looked up together."""
        parts: list[str] = []
        owner: list[int] = []  # place of the text of each part
        n = weight = 0
        for text in texts:
            for part in pieces(text or ""):
                parts.append(part)
                owner.append(n)
            n, weight = n + 1, weight + len(text or "")
            if weight > PIECE:
                yield from self._encode_group(parts, owner, n)
                parts, owner, n, weight = [], [], 0, 0
        yield from self._encode_group(parts, owner, n)

    def _encode_group(self, parts: list[str], owner: list[int], n: int) -> Iterator[np.ndarray]:
        """Ids of n texts, from their parts."""
        collecting = gc.isenabled()
        gc.disable()  # many objects are made here and none refers to itself
        try:
            ids: list[np.ndarray] = [_NOTHING] * len(parts)
            plain: list[tuple[int, str]] = []
            for i, part in enumerate(parts):
                low = part.lower() if part.isascii() else _lower(part)
                if "<|" in part or not low.isascii() and self.beyond(low):
                    words = self._words(part)
                    known = self.words.holding(set(words), self._encode_words)
                    ids[i] = np.frombuffer(b"".join([known[w] for w in words]), np.uint16)
                elif low:
                    plain.append((i, low))
            for (i, _), own in zip(plain, self._encode_plain([low for _, low in plain])):
                ids[i] = own
        finally:
            if collecting:
                gc.enable()
        found: list[list[np.ndarray]] = [[] for _ in range(n)]
        for i, own in zip(owner, ids):
            found[i].append(own)
        for own in found:
            yield own[0] if len(own) == 1 else np.concatenate(own)

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts in lower case whose characters all have a kind: words are cut and told apart in arrays."""
        if not texts:
            return []
        joined = "\n".join(texts)
        codes, data = np.frombuffer(joined.encode("utf-32-le"), np.uint32), joined.encode()
        begins = _word_starts(codes, self.kinds)
        ends = np.append(begins, len(codes))
        if len(data) > len(codes):  # two bytes for a character above ASCII
            places = np.zeros(len(codes) + 1, np.int32)
            np.cumsum(1 + (codes > 0x7F), out=places[1:])
            ends = places[ends]
        buffers = pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)
        words = pa.StringArray.from_buffers(len(begins), *buffers).dictionary_encode()
        own, sizes = self._known(words.dictionary)
        # the ids of all words, gathered by their place in the dictionary
        firsts = np.cumsum(sizes) - sizes
        index = words.indices.to_numpy()
        each = sizes[index]
        upto = np.cumsum(each)
        gather = np.repeat(firsts[index] - upto + each, each)
        gather += np.arange(len(gather))
        ids = own[gather]
        # words of earlier texts begin before a text does
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        before = np.searchsorted(begins, np.cumsum(lengths) - lengths)
        cuts = [*np.append(0, upto)[before].tolist(), len(ids)]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _known(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has; blanks have none."""
        _, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        flat = np.frombuffer(data, np.uint8)
        starts, sizes = ends[:-1], np.diff(ends)
        first, second = flat[starts], flat[np.minimum(starts + 1, len(flat) - 1)]
        # of the blanks below _LATIN two take two bytes
        blank = (first == 32) | (first >= 9) & (first <= 13) | (first == 0xC2) & ((second == 0x85) | (second == 0xA0))
        place = np.flatnonzero(~blank)
        starts, sizes = starts[place], sizes[place]
        hashes = self.store.hashes(flat, starts, sizes)
        entry = self.store.find(flat, starts, sizes, hashes)
        kept, new = np.flatnonzero(entry >= 0), np.flatnonzero(entry < 0)
        made, made_count = self._encode_flat(flat, starts[new], sizes[new])
        count = np.zeros(len(words), np.int64)
        count[place[kept]], count[place[new]] = self.store.ids_size[entry[kept]], made_count
        firsts = (np.cumsum(count) - count)[place]
        ids = np.empty(int(count.sum()), np.uint16)
        for some, source, at in (
            (kept, self.store.ids, self.store.ids_at[entry[kept]]),
            (new, made, np.cumsum(made_count) - made_count),
        ):
            own = count[place[some]]
            step = _steps(own)
            ids[np.repeat(firsts[some], own) + step] = source[np.repeat(at, own) + step]
        self.store.add(flat, starts[new], sizes[new], hashes[new], made, made_count)
        return ids, count

    def _words(self, text: str) -> list[str]:
        """Words of any text as they are merged; a special token is a word with its own spelling."""
        out: list[str] = []
        at = 0
        for match in self.special_at.finditer(text):
            out += self.split(_lower(text[at : match.start()]))
            out.append(match[0])
            at = match.end()
        return out + self.split(_lower(text[at:]))

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words and special tokens, as bytes."""
        out = {w: np.uint16(self.special[w]).tobytes() for w in words if w[:2] == "<|" and w in self.special}
        plain = [w for w in words if w not in out]
        encoded = [w.encode() for w in plain]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids, count = self._encode_flat(np.frombuffer(b"".join(encoded), np.uint8), np.cumsum(sizes) - sizes, sizes)
        ends = np.cumsum(count).tolist()
        out.update({w: ids[a:b].tobytes() for w, a, b in zip(plain, [0, *ends], ends)})
        return out

    def _encode_flat(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (bytes of ``flat``), one after the other, and how many each has.

        Proposed, all neighbours checked at once, and merged exactly where a check fails.
        """
        long = np.flatnonzero(sizes > SIDE_BY_SIDE)
        if len(long):
            short = np.flatnonzero(sizes <= SIDE_BY_SIDE)
            parts: list[np.ndarray] = [_NOTHING] * len(sizes)
            ids, count = self._encode_flat(flat, starts[short], sizes[short])
            for i, own in zip(short.tolist(), np.split(ids, np.cumsum(count)[:-1])):
                parts[i] = own
            for i in long.tolist():
                parts[i] = self._encode_long(flat[starts[i] : starts[i] + sizes[i]].tobytes())
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        if not len(sizes):
            return _NOTHING, np.zeros(0, np.int64)
        tokens, count = self.trie.longest(flat, starts, sizes)
        column = np.arange(tokens.shape[1])
        right = np.full_like(tokens, _ALONE)
        right[:, :-1] = np.where(column[1:] < count[:, None], tokens[:, 1:], _ALONE)
        # every token but the last with its neighbour; a word of one token with nothing
        asked = column < np.maximum(count - 1, 1)[:, None]
        good = self._fit(tokens[asked].astype(np.uint32) << np.uint32(16) | right[asked].astype(np.uint32))
        failing = np.unique(np.nonzero(asked)[0][~good])
        widths = (sizes[failing] + 3) // 4 * 4
        for width in np.unique(widths).tolist():
            some = failing[widths == width]
            at, size = np.arange(width), sizes[some, None]
            own = flat[np.minimum(starts[some, None] + at, len(flat) - 1)]
            rows = np.where(at < size - 1, self.inside_byte[own], np.where(at < size, self.ending_byte[own], _ALONE))
            merged = self._merge_rows(rows.astype(np.uint32))
            count[some] = (merged != _ALONE).sum(axis=1)
            fits = min(width, tokens.shape[1])  # no word has more tokens than bytes
            tokens[some, :fits] = merged[:, :fits]
        return tokens[column < count[:, None]].astype(np.uint16), count

    def _encode_long(self, word: bytes) -> np.ndarray:
        """The same for one word of any length."""
        mapped = word.decode("latin-1").translate(self.characters)
        own = self._greedy(mapped)
        if not self._fit(_pairs(own)).all():
            own = self._merge_long(self._start(mapped))
        return np.array(own, np.uint16)

    def _mapped_word(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.characters)

    def _greedy(self, word: str) -> list[int]:
        """Longest tokens from left to right of one word in mapped characters."""
        inside, ending, reach, out, at, left = self.inside, self.ending, self.reach, [], 0, len(word)
        while left:
            for size in reach.get(word[at : at + 3], (2, 1)):
                found = inside.get(word[at : at + size]) if size < left else None
                if size == left:
                    found = ending.get(word[at:])
                if found is not None:
                    out.append(found)
                    at, left = at + size, left - size
                    break
        return out

    def _fit(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair stays as it is, by one search in the table of known pairs."""
        asked, back = np.unique(keys, return_inverse=True)
        place = np.searchsorted(self.pairs, asked)
        known = np.zeros(len(asked), bool)
        inside = place < len(self.pairs)
        known[inside] = self.pairs[place[inside]] == asked[inside]
        new = asked[~known].tolist()
        if new:
            wanted = [[k >> 16] if k & 0xFFFF == _ALONE else [k >> 16, k & 0xFFFF] for k in new]
            merged = self._merge_many([[s for t in w for s in self._of(t)] for w in wanted])
            checked = np.fromiter((w == m for w, m in zip(wanted, merged)), bool, len(new))
            pairs = np.concatenate([self.pairs, np.array(new, np.uint32)])
            order = np.argsort(pairs, kind="stable")
            self.pairs, self.fits = pairs[order], np.concatenate([self.fits, checked])[order]
            place = np.searchsorted(self.pairs, asked)
        return self.fits[place][back]

    def _of(self, token: int) -> list[int]:
        """The single-character symbols of a token."""
        if token not in self.symbols:
            text = self.tokens[token]
            mid = self.inside.get(text) == token
            self.symbols[token] = [self.inside[c] for c in text] if mid else self._start(text[: -self.suffix])
        return self.symbols[token]

    def _start(self, word: str) -> list[int]:
        return [self.inside[c] for c in word[:-1]] + [self.ending[word[-1]]]

    def _merge_many(self, words: list[list[int]]) -> list[list[int]]:
        """Exact merging of many words side by side: in each the pair of lowest rank, leftmost first."""
        out: list[list[int]] = [[]] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > SIDE_BY_SIDE:
                out[i] = self._merge_long(word)
            else:
                by_length.setdefault((len(word) + 3) // 4 * 4, []).append(i)
        for width, places in by_length.items():
            rows = np.full((len(places), width), _ALONE, np.uint32)
            for row, i in enumerate(places):
                rows[row, : len(words[i])] = words[i]
            merged = self._merge_rows(rows)
            for i, row, n in zip(places, merged.tolist(), (merged != _ALONE).sum(axis=1).tolist()):
                out[i] = row[:n]
        return out

    def _merge_rows(self, rows: np.ndarray) -> np.ndarray:
        """Merge in rows padded with _ALONE, to rows of the same width; a done row leaves the work."""
        done = rows.copy()
        index = np.arange(len(rows))
        ranks = self._ranks(rows[:, :-1], rows[:, 1:])
        while len(index):
            at = ranks.argmin(axis=1)
            each = np.arange(len(index))
            best = ranks[each, at]
            on = best < _NEVER
            if not on.all():
                done[index[~on]] = rows[~on]
                index, rows, ranks, at, best = index[on], rows[on], ranks[on], at[on], best[on]
                each = np.arange(len(index))
                if not len(index):
                    break
            n = rows.shape[1]
            rows[each, at] = self.made[best]
            source = np.minimum(np.arange(n) + (np.arange(n) > at[:, None]), n - 1)
            rows = np.take_along_axis(rows, source, 1)
            rows[:, -1] = _ALONE
            ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], n - 2), 1)
            ranks[:, -1] = _NEVER
            ranks[each, at] = np.where(at < n - 1, self._ranks(rows[each, at], rows[each, np.minimum(at + 1, n - 1)]), _NEVER)
            has = at > 0
            ranks[each[has], at[has] - 1] = self._ranks(rows[each[has], at[has] - 1], rows[each[has], at[has]])
        return done

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, _NEVER without one."""
        keys = (left << np.uint32(16)) | right
        ranks = self.rank.get(keys.ravel()).reshape(keys.shape)
        return np.where(ranks < 0, _NEVER, ranks)

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for very long words."""
        symbols, n, get = list(symbols), len(symbols), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := get(symbols[i] << 16 | symbols[j])) is not None:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s >= 0]

    # decoding

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by a space: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _pairs(tokens: list[int]) -> np.ndarray:
    """Each token but the last with its neighbour, one token with nothing."""
    if len(tokens) == 1:
        return np.array([tokens[0] << 16 | _ALONE], np.uint32)
    own = np.array(tokens, np.uint32)
    return own[:-1] << np.uint32(16) | own[1:]


def _require(spec: dict) -> None:
    """Refuse files of another kind rather than encode them wrongly."""
    model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
    plain = not (model["dropout"] or model["byte_fallback"] or model["ignore_merges"])
    known = normal == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"]
    if not (plain and known and spec["decoder"] is None and len(model["vocab"]) < _ALONE):
        raise ValueError("not a BPE file with word ends of the kind this encoder reads")


def pieces(text: str) -> Iterator[str]:
    """Parts of a text of bounded length, cut at white space only."""
    at = 0
    while len(text) - at > PIECE:
        space = _SPACES.search(text, at + PIECE)
        if space is None:
            break
        yield text[at : space.start()]
        at = space.end()
    yield text[at:] if at else text


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder for each worker process and file."""
    return WordBpe(path)


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of each row; null and empty texts have no ids.

    Rows are worked on where they are: no shuffle, repeated rows stay, an empty
    table gives an empty one, other columns are not looked at.
    """
    file = path or default_path()

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, ids in _encoded(tuples, file):
            yield doc_id, ids.tolist()

    return arrow_map(pick(docs, "doc_id", "text"), "doc_id long, ids array<int>", rows)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows of doc_id and ids (null ids: the empty text)."""
    file = path or default_path()

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        decode = encoder(file).decode
        for doc_id, ids in tuples:
            yield doc_id, decode(np.array(ids or [], np.int64))

    return arrow_map(pick(encoded, "doc_id", "ids"), "doc_id long, text string", rows)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode each whole text and decode the ids again: count and digests of both.

    Cases are treated as in ``encode_documents``; a text without ids has n_tokens
    0 and the digests of the empty string.
    """
    file = path or default_path()

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        decode = encoder(file).decode
        for doc_id, ids in _encoded(tuples, file):
            decimal = " ".join(map(DECIMAL.__getitem__, ids.tolist()))
            yield doc_id, len(ids), sha256(decimal), sha256(decode(ids))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(pick(docs, "doc_id", "text"), schema, rows)


#: Decimal text of each possible id.
DECIMAL = [str(i) for i in range(1 << 16)]


def _encoded(tuples: Iterator[tuple], path: str) -> Iterator[tuple]:
    """doc_id and ids of tuples of doc_id and text, which are read ahead by a bounded group."""
    waiting: deque = deque()

    def texts() -> Iterator[str | None]:
        for doc_id, text in tuples:
            waiting.append(doc_id)
            yield text

    for ids in encoder(path).encode_many(texts()):
        yield waiting.popleft(), ids
