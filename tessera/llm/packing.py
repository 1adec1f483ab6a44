"""Operators 2 and 3: best-fit packing and token-id output.

Documents are tokenized once, where they are read; each worker keeps a bounded cache of encoded words.  What a packing
needs to know of the corpus is how many pieces have each length, at most max_len numbers, so the driver can pack all
of it exactly, best fit decreasing, over runs of equal pieces and equal bins.  A segment tree over the capacities
0..max_len finds the tightest open capacity in logarithmic time.  The result is a short table of intervals; a piece
finds its sequence by its length and its rank among the pieces of that length, which comes from counts per input
partition.  No text and no ids are shuffled until rows of a sequence are put together.

Defined results: a null text is an empty one and gives the end id alone; equal documents are packed each for itself;
an empty table gives no sequences; a document longer than max_len is cut without loss into pieces of max_len, the
first of which may be shorter; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import KEPT, Kept, even
from .common import batches, materialize, release, table

#: Longer words aren't kept by a worker, so the bound on their number bounds the bytes as well.
LONGEST_WORD = 48
EOS = 2
MAX_LEN = 1024


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_ranks(path: str) -> tuple[dict[bytes, int], str]:
    """The byte-level vocabulary of a tokenizers file as bytes -> id, which is also the order of merges, and the
    pattern of its pre-tokenizer."""
    import public_tokenizers

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(b): b for b in shown}
    code |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    ranks = {bytes(code[c] for c in w): i for w, i in vocab.items() if all(c in code for c in w) and "<|" not in w}
    return ranks, public_tokenizers.PATTERN


class Encoder:
    """Token ids of whole texts, as little-endian bytes: those the tokenizers library gives for the vocabulary file.

    The byte-level pre-tokenizer never joins two words and always puts a boundary before a single space or newline
    that stands between two other characters; so an evenly spaced text is encoded word by word, words are cached, and
    new words are merged by tiktoken, whose byte pair merging over the same ranks costs a tenth.  On loading, both
    libraries must agree on a sample, else every text goes through the tokenizers library whole.  At most twice kept words
    are held; that decides memory and time, not the ids."""

    def __init__(self, path: str, kept: int = KEPT):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        try:
            ranks, pattern = byte_ranks(path)
            merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            sample = "It's 12,345 words\nof \u00fcber-\u00e9t\u00e9  text; \u65e5\u672c\t<|endoftext|> don't"
            agree = merges.encode_ordinary(sample) == self.tokenizer.encode(sample, add_special_tokens=False).ids
            self.merge = merges.encode_ordinary if agree else None
        except (KeyError, ValueError):
            self.merge = None  # not a byte-level vocabulary
        self.words, self.marks = Kept(self.word, LONGEST_WORD, kept), Kept(self.whole, 1, kept)

    def pack(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def whole(self, text: str) -> bytes:
        if self.merge is None:
            return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return self.pack(self.merge(text))

    def encode(self, text: str) -> bytes:
        if self.merge is None or not even(text):
            return self.whole(text)
        first, *words = text.replace("\n", " \n").split(" ")
        return self.whole(first) + b"".join(map(self.words.__getitem__, words))

    def word(self, word: str) -> bytes:
        """The ids of a word and the space before it, or of a newline and a word."""
        if word[-1] in ",.!?" and (before := word[-2:-1]).isalpha() and before.isascii():  # always two words
            return self.words[word[:-1]] + self.marks[word[-1]]
        return self.pack(self.merge(word if word[0] == "\n" else " " + word))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, kept: int = KEPT) -> Encoder:
    """The worker's encoder; a worker holds one."""
    if (path, kept) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, kept] = Encoder(path, kept)
    return _ENCODERS[path, kept]


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())]
)


def token_pieces(docs: DataFrame, path: str, eos: int = EOS, max_len: int = MAX_LEN, kept: int = KEPT) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian, 2 bytes each where the vocabulary allows,
    else 4), and what ranks it among the pieces of its length: part (input partition) and nth (its turn there)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path, kept), TaskContext.get().partitionId()
        end, width, turn = enc.pack([eos]), enc.width, [0] * (max_len + 1)

        def rows():
            for frame in frames:
                for at in range(0, frame.num_rows, 64):
                    chunk = frame.slice(at, 64)
                    for doc, text in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist(), strict=True):
                        ids = enc.encode(text or "") + end
                        n = len(ids) // width
                        first = n % max_len or min(n, max_len)
                        start, piece = 0, 0
                        while start < n:
                            length = max_len if piece else first
                            turn[length] += 1
                            yield doc, piece, start, length, ids[start * width : (start + length) * width], part, turn[length] - 1
                            start, piece = start + length, piece + 1

        yield from batches(PIECES, rows(), limit=4 << 20, weigh=lambda r: len(r[4]) + 64)
        release()  # the words stay for the next partition

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length int, ids binary, part int, nth long"
    )


class SegmentTree:
    """Which of the capacities 0..top are open; tightest(c) is the least open one that is c or more."""

    def __init__(self, top: int):
        self.leaves = 1
        while self.leaves <= top:
            self.leaves *= 2
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.leaves
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, capacity: int) -> int | None:
        at = capacity + self.leaves
        if at >= 2 * self.leaves:
            return None
        while not self.open[at]:
            while at & 1:  # a right child: nothing further right under this parent
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(counts: dict[int, int], max_len: int = MAX_LEN) -> np.ndarray:
    """Best fit decreasing of counts[length] pieces of each length into bins of max_len.  Rows (length, first rank,
    first bin, pieces per bin, offset in the bin), by length and rank: the piece of that length and rank r goes to bin
    first bin + (r - first rank) // per bin, at offset + (r - first rank) % per bin * length.

    Bins with the same room are handled together, in runs of consecutive numbers; the outcome is that of placing the
    pieces one by one.  Runs are split at most twice a length, so time and space depend on max_len, not on the corpus."""
    tree, runs, rows, bins = SegmentTree(max_len), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            runs.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                each = max_len // length
                room, first, n = max_len, bins, -(-left // each)
                bins += n
            else:
                first, n = runs[room].pop()
                if not runs[room]:
                    tree.set(room, False)
                each = room // length
            full = min(n, left // each)
            rows.append((length, rank, first, each, max_len - room))
            put(room - each * length, first, full)
            rank, left = rank + full * each, left - full * each
            if full < n and left:  # one more bin takes what remains
                put(room - left * length, first + full, 1)
                rank, full, left = rank + left, full + 1, 0
            if room < max_len:
                put(room, first + full, n - full)
    rows.sort(key=lambda r: (-r[0], r[1]))
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def place(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """pieces (materialized token_pieces) with sequence_id and offset."""
    per = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= max_len rows
    table_ = pieces.sparkSession.sparkContext.broadcast(plan(counts, max_len))  # its size depends on max_len alone
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))

    @F.pandas_udf("sequence_id long, offset long")
    def seat(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = table_.value
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        lengths, starts = np.unique(-p[:, 0], return_index=True)
        base = np.append(starts, len(p))
        at = np.empty(len(n), dtype=np.int64)
        for x in np.unique(n):
            i = np.searchsorted(lengths, -x)
            mine = n == x
            at[mine] = base[i] + np.searchsorted(p[base[i] : base[i + 1], 1], r[mine], side="right") - 1
        _, first, bin_, each, offset = p[at].T
        turn = r - first
        return pd.DataFrame({"sequence_id": bin_ + turn // each, "offset": offset + turn % each * n})

    out = pieces.join(ranks, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
    out = out.withColumn("_seat", seat("length", F.col("_before") + F.col("nth")))
    return out.select("doc_id", "piece", "start", "length", *[c for c in pieces.columns if c not in PIECES.names], "_seat.sequence_id", "_seat.offset")


def _wide(data: bytes, n: int) -> bytes:
    return np.frombuffer(data, dtype=f"<u{len(data) // n}").astype("<u4").tobytes()


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series, n: pd.Series) -> pd.Series:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit numbers."""
    return pd.Series([zlib.crc32(_wide(x, k)) for x, k in zip(ids, n, strict=True)], dtype="int64")


def pack(docs: DataFrame, path: str, eos: int = EOS, max_len: int = MAX_LEN, kept: int = KEPT) -> DataFrame:
    """doc_id, piece, start, length, sequence_id and offset of every piece, with its ids' crc32.  kept bounds the words a
    worker holds, for jobs whose executors have other stages' memory to bear."""
    pieces = materialize(token_pieces(docs, path, eos, max_len, kept), "pieces")
    return place(pieces.withColumn("ids_crc32", ids_crc32("ids", "length")), max_len)


SEQUENCES = pa.schema(
    [("sequence_id", pa.int64()), ("input_ids", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()), ("doc_ids", pa.list_(pa.int64()))]
)


def packed_sequences(docs: DataFrame, path: str, eos: int = EOS, max_len: int = MAX_LEN, pad: int = 0) -> DataFrame:
    """One row per sequence: input_ids (max_len ids, padded, as the pieces' ids are stored), n_tokens, cu_seqlens
    (cumulative segment lengths from 0 to n_tokens), position_ids (unsigned 16-bit, from 0 again in each segment and
    0 in the padding; 32-bit where max_len needs it) and doc_ids."""
    pieces = materialize(token_pieces(docs, path, eos, max_len), "pieces")
    placed = place(pieces.withColumn("tokens", F.col("ids")), max_len)

    def run(frames):
        def rows():
            held: list[tuple] = []

            def row():
                parts = [h[2] for h in held]
                lengths = [h[3] for h in held]
                n = sum(lengths)
                width = len(parts[0]) // lengths[0]
                ids = b"".join(parts) + int(pad).to_bytes(width, "little") * (max_len - n)
                kind = "<u2" if max_len <= 1 << 16 else "<u4"
                at = np.concatenate([*(np.arange(k) for k in lengths), np.zeros(max_len - n, dtype=np.int64)]).astype(kind)
                return held[0][0], ids, n, [0, *np.cumsum(lengths).tolist()], at.tobytes(), [h[4] for h in held]

            for frame in frames:
                cols = [frame.column(i).to_pylist() for i in range(5)]
                for r in zip(*cols, strict=True):
                    if held and held[0][0] != r[0]:
                        yield row()
                        held.clear()
                    held.append(r)
            if held:
                yield row()

        yield from batches(SEQUENCES, rows(), weigh=lambda r: len(r[1]) + len(r[4]) + 64)

    return (
        placed.select("sequence_id", "offset", "tokens", "length", "doc_id")
        .repartition("sequence_id")
        .sortWithinPartitions("sequence_id", "offset")
        .mapInArrow(run, "sequence_id long, input_ids binary, n_tokens int, cu_seqlens array<int>, position_ids binary, doc_ids array<long>")
    )


def write_packed(docs: DataFrame, target: str, path: str, **options) -> None:
    """Writes packed_sequences as Parquet under target: fixed-size binary rows that make up an id matrix."""
    packed_sequences(docs, path, **options).write.option("compression", "zstd").parquet(target)


def read_matrix(rows: list, max_len: int = MAX_LEN) -> np.ndarray:
    """The id matrix of collected rows of packed_sequences."""
    return np.stack([np.frombuffer(r["input_ids"], dtype=f"<u{len(r['input_ids']) // max_len}") for r in rows])


def op2_packing(spark, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"), vocabulary())
    return out.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op3_token_output(spark, sf_dir: str) -> DataFrame:
    """The digest of the written sequences: segments, tokens, crc32 of the row of ids and of the position resets."""
    packed = materialize(packed_sequences(table(spark, sf_dir, "documents"), vocabulary()), "packed")
    return packed.select(
        "sequence_id",
        F.size("doc_ids").cast("long").alias("segments"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "cu_seqlens",
        "doc_ids",
        F.crc32("input_ids").alias("ids_crc32"),
        F.crc32("position_ids").alias("positions_crc32"),
    )
