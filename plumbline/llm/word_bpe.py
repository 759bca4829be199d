"""Word-end BPE of many words at once, in numpy.

The lower-casing vocabulary marks word ends and drops white space, so a text's ids are those of
its chunks, and chunks can be encoded in any order, each once. All unseen chunks of a slice of
texts go through the merges together: in each round every chunk merges its pair of lowest rank.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import regex

from plumbline.llm.token_counts import byte_letters

#: Words, and chunks, whose ids a worker keeps, in each of two generations.
KEPT_WORDS = 270_000
#: How the tokenizer splits normalized text into chunks; anything else is dropped.
CHUNKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that Python's split() takes for white space and the tokenizer doesn't.
ODD_SPACE = "\x1c\x1d\x1e\x1f"


class Kept:
    """A dictionary of two generations: what is not asked for in a long time is forgotten."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """Keys that are in neither generation; the others are in the young one afterwards."""
        if len(self.young) > KEPT_WORDS:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for key in keys.difference(young):
            value = old.get(key)
            if value is None:
                out.append(key)
            else:
                young[key] = value
        return out


class WordEncoder:
    """Ids of texts under a vocabulary file with word ends."""

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.end = int(end_id).to_bytes(4, "little")
        self.chunks = regex.compile(CHUNKS)
        self.words, self.parts = Kept(), Kept()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.inner, self.final = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
        for letter, byte in byte_letters().items():
            self.inner[byte], self.final[byte] = vocab[letter], vocab[letter + suffix]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs] + [0], dtype=np.int64)
        # Rank of each pair in a table of open addressing; `never` for pairs that don't merge.
        self.never = len(pairs)
        self.bits = 18
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, self.never, dtype=np.int64)
        for rank, (key, place) in enumerate(zip((left << 20 | right).tolist(), self.place(left, right).tolist(), strict=True)):
            while self.keys[place] not in (-1, key):
                place = (place + 1) & ((1 << self.bits) - 1)
            if self.keys[place] == -1:
                self.keys[place], self.ranks[place] = key, rank

    def place(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20 | right).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (key >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key, place = left << 20 | right, self.place(left, right)
        found = self.keys[place]
        out = np.where(found == key, self.ranks[place], self.never)
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[place[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[place[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def merge(self, chunks: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk."""
        sizes = np.array([len(c) for c in chunks], dtype=np.int64)
        data = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        ids = self.inner[data]
        ends = np.cumsum(sizes)
        ids[ends - 1] = self.final[data[ends - 1]]
        of = np.repeat(np.arange(len(chunks)), sizes)
        done_ids, done_of = [], []
        while len(ids):
            pair = np.full(len(ids), self.never, dtype=np.int64)
            same = np.flatnonzero(of[1:] == of[:-1])
            pair[same] = self.rank(ids[same], ids[same + 1])
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            size = np.diff(np.concatenate([first, [len(ids)]]))
            best = np.repeat(np.minimum.reduceat(pair, first), size)
            over = best == self.never
            if over.any():
                done_ids.append(ids[over])
                done_of.append(of[over])
                ids, of, pair, best = ids[~over], of[~over], pair[~over], best[~over]
            here = np.flatnonzero(pair == best)
            if not len(here):
                break
            # Where a pair overlaps the one before (as in aaa), every second one merges.
            touch = np.concatenate([[False], (here[1:] == here[:-1] + 1)])
            if touch.any():
                run = np.arange(len(here)) - np.maximum.accumulate(np.where(touch, 0, np.arange(len(here))))
                here = here[run % 2 == 0]
            ids[here] = self.made[pair[here]]
            keep = np.ones(len(ids), dtype=bool)
            keep[here + 1] = False
            ids, of = ids[keep], of[keep]
        ids, of = np.concatenate(done_ids), np.concatenate(done_of)
        order = np.argsort(of, kind="stable")
        whole = ids[order].astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(of[order], np.arange(len(chunks) + 1))).tolist()
        return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def learn(self, words: set[str]) -> None:
        missing = self.words.missing(words)
        if not missing:
            return
        split = self.chunks.findall
        parts = [[w] if w.isalpha() else split(w) for w in missing]
        new = self.parts.missing(set(chain.from_iterable(parts)))
        if new:
            self.parts.young.update(zip(new, self.merge([c.encode("utf-8", "surrogatepass") for c in new]), strict=True))
        get, young = self.parts.young.__getitem__, self.words.young
        for word, own in zip(missing, parts, strict=True):
            young[word] = get(word) if len(own) == 1 else b"".join(map(get, own))

    def alone(self, text: str) -> bool:
        return any(s in text for s in self.specials) or any(c in text for c in ODD_SPACE)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end id."""
        words = []
        for t in texts:
            if self.alone(t):
                words.append(None)
                continue
            if not t.isascii():
                # Letter by letter: a sigma that ends a word is none of lower()'s business.
                t = unicodedata.normalize("NFC", t).replace("Σ", "σ")
            words.append(t.lower().split())
        self.learn(set().union(*(w for w in words if w)))
        get = self.words.young.__getitem__
        out = []
        for text, own in zip(texts, words, strict=True):
            if own is None:
                out.append(np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() + self.end)
            else:
                out.append(b"".join(map(get, own)) + self.end)
        return out
