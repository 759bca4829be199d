"""Token counts by prefix dynamic programming.

A byte-level BPE encoding of a prefix ends in exactly one token t, and what stands before t is the
encoding of the shorter prefix without it. So going through a chunk (what the tokenizer's own
pattern splits off) byte by byte, the last token and the number of tokens of every prefix follow
from those of shorter prefixes: t is the longest vocabulary entry that ends there and may follow
the last token of the rest. The counts of all prefixes answer truncation and budget questions
without encoding again; a document's count is the sum over its chunks.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import body, small_batches

#: How the byte-level tokenizer splits text before the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Coarser pieces, each a whole number of chunks, as no chunk holds white space after other characters.
PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Characters that Python's \s takes for white space and the tokenizer doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Pieces whose counts a worker keeps.
KEPT_PIECES = 400_000


def byte_letters() -> dict[str, int]:
    """The letters by which the vocabulary file writes bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts of every prefix, for one byte-level BPE vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        parts = [tuple(bytes(letters[c] for c in side) for side in pair) for pair in pairs]
        # Tokens go by number, in the order in which the merges make them; single bytes come first.
        words = sorted((w for w in vocab if len(w) == 1)) + list(dict.fromkeys(a + b for a, b in parts))
        number = {w: i for i, w in enumerate(words)}
        first = len(words) - len(set(words) - {w for w in words if len(w) == 1})
        self.halves = [(i, i) if i < first else None for i in range(len(words))]
        self.merge: dict[int, int] = {}
        for a, b in parts:
            whole = number[a + b]
            self.merge.setdefault(number[a] << 20 | number[b], whole)
            self.halves[whole] = self.halves[whole] or (number[a], number[b])
        self.first = first
        #: Number of each token, -1 for what only begins a token.
        self.begins = {w[:k]: -1 for w in words for k in range(1, len(w))} | number
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.split = regex.compile(SPLIT)
        self.may_follow: dict[int, bool] = {}
        self.kept: dict[str, int] = {}
        self.kept_chunks: dict[str, int] = {}

    def follows(self, left: int, right: int) -> bool:
        """Whether the encoding of two tokens' joined bytes is these two tokens.

        Seen backwards in time, the pieces that touch at the border are the right spine of left and
        the left spine of right. If two of them could merge before one of them was used up by its
        own word's next merge, the border would be gone.
        """
        a, b, until, ok = left, right, len(self.halves), True
        while True:
            made = self.merge.get(a << 20 | b)
            if made is not None and made < until:
                ok = False
                break
            if a < self.first and b < self.first:
                break
            if a > b:
                until, a = a, self.halves[a][1]
            else:
                # A merge of the same kind at the border stands further left and comes first.
                until, b = b + 1, self.halves[b][0]
        if len(self.may_follow) > 1_000_000:
            self.may_follow.clear()
        self.may_follow[left << 20 | right] = ok
        return ok

    def prefixes(self, chunk: bytes) -> list[int]:
        """Token counts of chunk[:0], chunk[:1], ... chunk."""
        size, begins, known = len(chunk), self.begins.get, self.may_follow.get
        last, counts = [-1] * (size + 1), [0] * (size + 1)
        # Starts go up, so the first token found for an end is the longest that fits there.
        for start in range(size):
            left, n = last[start] << 20, counts[start] + 1
            for end in range(start + 1, size + 1):
                token = begins(chunk[start:end])
                if token is None:
                    break
                if token < 0 or last[end] >= 0:
                    continue
                if start:
                    ok = known(left | token)
                    if ok is None:
                        ok = self.follows(last[start], token)
                    if not ok:
                        continue
                last[end] = token
                counts[end] = n
        return counts

    def count_chunk(self, chunk: str) -> int:
        n = self.prefixes(chunk.encode("utf-8", "surrogatepass"))[-1]
        if len(chunk) < 200:
            if len(self.kept_chunks) >= KEPT_PIECES:
                self.kept_chunks.clear()
            self.kept_chunks[chunk] = n
        return n

    def count_piece(self, piece: str) -> int:
        total, get = 0, self.kept_chunks.get
        for chunk in self.split.findall(piece):
            n = get(chunk)
            total += self.count_chunk(chunk) if n is None else n
        if len(piece) < 200:
            if len(self.kept) >= KEPT_PIECES:
                self.kept.clear()
            self.kept[piece] = total
        return total

    def segments(self, text: str) -> list[str]:
        """The text, split at special strings, which the library's default takes for one token each."""
        return self.special_split.split(text) if self.special_split and any(s in text for s in self.specials) else [text]

    def pieces(self, text: str) -> list[str]:
        return self.split.findall(text) if ODD_SPACE.search(text) else PIECES.findall(text)

    def count(self, text: str) -> int:
        total, get = 0, self.kept.get
        for segment in self.segments(text):
            if segment in self.specials:
                total += 1
                continue
            for piece in self.pieces(segment):
                n = get(piece)
                total += self.count_piece(piece) if n is None else n
        return total

    def table(self, text: str) -> list[tuple[int, int]]:
        """(characters, tokens) at every border between chunks, from (0, 0) to the whole text."""
        out, at, n = [(0, 0)], 0, 0
        for segment in self.segments(text):
            for chunk in [segment] if segment in self.specials else self.split.findall(segment):
                at += len(chunk)
                n += 1 if chunk in self.specials else self.prefixes(chunk.encode("utf-8", "surrogatepass"))[-1]
                out.append((at, n))
        return out

    def truncate(self, text: str, budget: int, table: list[tuple[int, int]] | None = None) -> str:
        """The longest prefix that ends between chunks, or within the next one, of at most budget tokens.

        Within a chunk the stored counts of its prefixes decide; only cuts at whole characters count.
        """
        table = table or self.table(text)
        k = bisect_right(table, budget, key=lambda x: x[1]) - 1
        at, n = table[k]
        if k + 1 == len(table):
            return text
        chunk = text[at : table[k + 1][0]]
        if chunk in self.specials or chunk.isspace():
            return text[:at]
        counts = self.prefixes(chunk.encode("utf-8", "surrogatepass"))
        size = best = 0
        for j, c in enumerate(chunk, 1):
            size += len(c.encode("utf-8", "surrogatepass"))
            if n + counts[size] <= budget:
                best = j
        return text[: at + best]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have no bytes and no tokens. Each row is counted for itself, repeated ones
    too; an empty table gives an empty result. Very long texts are read chunk by chunk, a worker
    keeps the counts of KEPT_PIECES pieces at most. vocabulary: path of the tokenizer's file, at the
    same place on all executors.
    """

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(vocabulary).count
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": batch["t"].map(count).astype("int64"), "over_limit": False})

    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.octet_length(body(text_col)).cast("long").alias("n_bytes"), body(text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInPandas(counts, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from plumbline.llm.common import table

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
