"""Operator 11: byte-level BPE encoding and decoding by a monoid tree reduction.

Encodings of byte strings are a monoid: two neighbours are joined by encoding anew a window of tokens round their
boundary.  A match of the pattern is cut in halves down to single bytes and joined up the tree; halves repeat a lot
between words, so short ones, and the boundaries of two tokens, are remembered.

Why the window suffices.  A sequence of tokens is the encoding of its bytes if and only if every two neighbours are the
encoding of theirs.  For suppose that each pair is and that some merge crosses a boundary between tokens; take the first
such merge.  Until then every token was merged within itself, in the order in which the pair on either side of that
boundary is merged alone, since what is least and leftmost of all is so of the pair; so the pair alone would be merged
across the boundary too.  The other way round, an encoding has no crossing merge, so no part of it has one.  Hence once
the window's new encoding begins with the left neighbour's token and ends with the right neighbour's, all pairs beyond
it are as they were and the whole is final.  Where either end has changed, the window doubles on that side, up to the
end of the neighbour, where nothing is left to check.

Texts are cut at places where the pattern always has a boundary: before a single space or newline between two other
characters.  Long texts are halved there first, so no task holds all pieces of one at a time.  Decoding is
concatenation: leaves of ids are turned into bytes and joined pairwise.

Defined results: a null text is an empty one, which has no ids and decodes to no bytes; equal documents are encoded
each for itself and null ids stay; an empty table gives an empty result; encode keeps other columns, whatever their
names.  A token that the vocabulary holds but its merges never give is used where it is a match by itself, as tiktoken
does.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, release, table, unused

#: Characters of a text that are cut into units at a time; ids that are turned into bytes at a time.
LEAF = 1 << 16
#: Entries of each memory's younger half; units over LONGEST characters and halves over SHORT bytes are not kept, so
#: this bounds the bytes as well.
KEPT, LONGEST, SHORT = 250_000, 32, 8
_NONE = 1 << 62  # no such pair
_EVEN = re.compile(r"(?<=\S)(?=[ \n]\S)")


def even(text: str) -> bool:
    """Whether all white space of a text is single spaces and newlines between other characters."""
    return text.split() == text.replace("\n", " ").split(" ")


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Kept(dict):
    """make(key) by key, for at most twice as many keys as most: when that many are held, they become the old ones, of which
    those asked for again are taken over."""

    def __init__(self, make, longest: int, most: int = KEPT):
        self.make, self.longest, self.most, self.old = make, longest, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    """Encodes and decodes by a file of ranks and the pattern that cuts texts into matches."""

    def __init__(self, path: str, pattern: str | None = None):
        import regex

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, file))}
        self.tokens = {i: b for b, i in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        # the token that two tokens make up, by both their numbers
        self.pairs = {
            a << 32 | b: i
            for piece, i in self.ranks.items()
            for k in range(1, len(piece))
            if (a := self.ranks.get(piece[:k])) is not None and (b := self.ranks.get(piece[k:])) is not None
        }
        self.matches = regex.compile(pattern).findall
        self.halves, self.windows = Kept(self.tree, SHORT), Kept(self.merge, SHORT)
        self.units, self.spaced = Kept(self.unit, LONGEST), Kept(self.after_space, LONGEST)

    # -- one match ----------------------------------------------------------------------------------------------------

    def match(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tree(piece)

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) == 1:
            return [self.single[piece[0]]]
        half = len(piece) // 2
        return self.join(self.halves[piece[:half]], self.halves[piece[half:]])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of left, an encoding, followed by those of right, another."""
        tokens, i, j = self.tokens, 1, 1
        window = self.windows[tokens[left[-1]] + tokens[right[0]]]
        while True:
            grow_left = i < len(left) and window[0] != left[-i]
            grow_right = j < len(right) and window[-1] != right[j - 1]
            if not grow_left and not grow_right:
                return left[:-i] + window + right[j:]
            if grow_left:
                i = min(2 * i, len(left))
            if grow_right:
                j = min(2 * j, len(right))
            window = self.windows[b"".join([tokens[t] for t in left[-i:] + right[:j]])]

    def merge(self, piece: bytes) -> list[int]:
        """Byte pair merging of a window: the pair of least rank, the leftmost of equals, until none is left."""
        if len(piece) > 96:
            return self._merge_many(piece)
        get, single = self.pairs.get, self.single
        ids = [single[b] for b in piece]
        made = [get(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while made and (least := min(made)) != _NONE:
            at = made.index(least)
            ids[at] = least  # tokens are numbered by rank
            del ids[at + 1], made[at]
            if at < len(made):
                made[at] = get(least << 32 | ids[at + 1], _NONE)
            if at:
                made[at - 1] = get(ids[at - 1] << 32 | least, _NONE)
        return ids

    def _merge_many(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs and links between neighbours."""
        n, ranks = len(piece), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at a place
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01") * n
        while heap:
            r, i = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or ranks.get(piece[i : end[j]]) != r:
                continue  # one of its parts has been merged since
            end[i], alive[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                if (r := ranks.get(piece[i : end[end[i]]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := ranks.get(piece[before[i] : end[i]])) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    # -- whole texts --------------------------------------------------------------------------------------------------

    def leaves(self, text: str) -> Iterator[str]:
        """Stretches of the text in order, of LEAF characters or about; each ends where the pattern has a boundary."""
        left = [text]
        while left:
            part = left.pop()
            cut = None
            if len(part) > LEAF:
                half = len(part) // 2
                cut = _EVEN.search(part, half)
                if cut is None:  # the last place before the middle
                    for cut in _EVEN.finditer(part, 0, half + 2):
                        pass
            if cut is None:
                yield part
            else:
                left += [part[cut.start() :], part[: cut.start()]]

    def unit(self, unit: str) -> bytes:
        """The ids of a unit, a stretch between boundaries, as little-endian unsigned 32-bit numbers."""
        ids: list[int] = []
        letters = unit[unit[:1] == " " :]
        for m in (unit,) if letters.isascii() and letters.isalpha() else self.matches(unit):
            ids += self.match(m.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def after_space(self, word: str) -> bytes:
        """The ids of a unit, a space and word or, where word starts with a newline, word alone."""
        if word[-1] in ",.!?" and (before := word[-2:-1]).isalpha() and before.isascii():  # a boundary stands between
            return self.spaced[word[:-1]] + self.units[word[-1]]
        return self.unit(word if word[0] == "\n" else " " + word)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        for leaf in self.leaves(text):
            if not even(leaf):
                out += map(self.units.__getitem__, self.matches(leaf))
                continue
            first, *words = leaf.replace("\n", " \n").split(" ")
            if first:  # else the leaf starts with its space or newline
                out.append(self.unit(first))
            out += map(self.spaced.__getitem__, words)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids, little-endian unsigned 32-bit numbers, stand for."""
        each = np.frombuffer(ids, "<u4")
        parts = [b"".join(map(self.tokens.__getitem__, each[a : a + LEAF].tolist())) for a in range(0, len(each), LEAF)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str | None = None) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encoded(text: Column | str, path: str, pattern: str | None = None) -> Column:
    """The ids of a column of texts, as a binary column of little-endian unsigned 32-bit numbers."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mine = codec(path, pattern)
        for texts in batches:
            yield pd.Series([mine.encode(t or "") for t in texts], dtype=object)
        release()  # what is remembered stays for the next partition

    return run(text)


def decoded(ids: Column | str, path: str, pattern: str | None = None) -> Column:
    """The bytes that a column of encoded ids stands for, null for null."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mine = codec(path, pattern)
        for column in batches:
            yield pd.Series([None if x is None else mine.decode(x) for x in column], dtype=object)
        release()

    return run(ids)


def encode(docs: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """docs with the ids of their texts in a column token_ids (with underscores before it where docs has that name)."""
    bound_batches(docs.sparkSession)
    (name,) = unused(docs.columns, "token_ids")
    return docs.withColumn(name, encoded(F.col("text"), path, pattern))


def decode(docs: DataFrame, ids: str, path: str, pattern: str | None = None) -> DataFrame:
    """docs with the bytes of the ids in a column token_bytes (named as in encode)."""
    bound_batches(docs.sparkSession)
    (name,) = unused(docs.columns, "token_bytes")
    return docs.withColumn(name, decoded(F.col(ids), path, pattern))


def op11_bpe(spark, sf_dir: str) -> DataFrame:
    path = ranks_path()
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return decode(ids, "token_ids", path).select(
        "doc_id",
        F.expr("length(token_ids) div 4").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("token_bytes", 256).alias("decoded_sha256"),
    )
