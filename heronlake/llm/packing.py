"""Best-fit packing of token sequences through a configuration linear program.

Tokenising gives every document pieces of at most ``capacity`` ids; longer documents are cut. How pieces share sequences
is decided on the histogram of piece lengths alone, which has at most ``capacity`` entries however large the corpus:

1. The configuration LP (use as few configurations as cover every length's count) is solved by multiplicative weights:
   a length's weight falls as it gets covered; knapsack dynamic programming prices the configuration of most weight.
2. The fractional solution is rounded: configurations in falling order of use are taken as often as they fit whole.
   What is left goes through the LP again, a few times.
3. The rest, a number of pieces that does not grow with the corpus, is placed by best fit: each sequence starts with the
   longest piece left and takes the subset of the others that fills it best (subset sums over bit sets).

The plan lists, for each length, runs of ranks with their sequences and offsets. Every piece finds its own place by its
rank among the pieces of its length; ranks are counted in salted buckets, so a length that a third of all pieces share is
no hot key.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.llm import common

CAPACITY = 2048
END_ID = 0
#: Pre-tokens whose ids a worker remembers in each of two generations.
CACHE_WORDS = 200_000
#: Pieces that one rank bucket holds on average.
BUCKET_PIECES = 20_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """Ids of a text as little-endian 32-bit bytes, through a cache over a tokenizers file.

    The file lower-cases and cuts a text into pre-tokens (contractions, letter runs, single numerals, runs of others).
    Texts of printable Latin characters, which lower-casing and composing treat alike everywhere, are cut by the same
    pattern here and only pre-tokens not seen before reach the BPE model. Other texts go through the whole tokenizer in
    parts between blanks and line ends, which its pattern never joins.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # added tokens are cut out in ids()
        self.added = {t.content: i.to_bytes(4, "little") for i, t in self.tok.get_added_tokens_decoder().items()}
        self.cut_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda text: [text]
        self.model = self.tok.model
        latin = [chr(i) for i in range(0x250)]
        letters, numbers = (re.escape("".join(c for c in latin if unicodedata.category(c)[0] == k)) for k in "LN")
        self.cut = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+").findall
        plain = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f]+").fullmatch
        # capitals such as U+0186 lower-case to letters beyond this alphabet: texts with them are not plain
        self.other = re.compile("[^" + re.escape("".join(c for c in latin if plain(c) and plain(c.lower()))) + "]").search
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # the byte-level alphabet: bytes that show stand for themselves
        self.byte = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.part = common.Recent(self._part, cache_words)
        self.whole = common.Recent(self._whole, cache_words // 8)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = "".join(map(self.byte.__getitem__, part.encode("utf-8")))
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part)])

    def _whole(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            runs = self.cut_added(text or "")
            yield b"".join([self.added[r] if i % 2 else self._run(r) for i, r in enumerate(runs)]) if len(runs) > 1 else self._run(runs[0])

    def _run(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if self.other(text):
            memory, parts = self.whole, re.split("[ \t\r\n]", text)
        else:
            memory, parts = self.part, self.cut(text.lower())
        found = list(map(memory.young.get, parts))
        if None in found:
            found = [memory(p) if f is None else f for f, p in zip(found, parts)]
        return b"".join(found)


@functools.cache
def _tokenizer(path: str) -> WordTokenizer:
    """One for each worker: tasks find this function by name, whereas a dict beside them would travel with each task."""
    return WordTokenizer(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: its ids and end_id, cut every ``capacity`` ids. Null and empty texts: end_id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for b in common.parts(batches):
            rows: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), tok.ids(b.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_TYPES)], ["doc_id", "piece", "start", "length", "ids_crc32"]) if rows else pa.RecordBatch.from_arrays([pa.array([], t) for t in _PIECE_TYPES], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(run, PIECE_SCHEMA)


_PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())


def price(weights: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of most weight: lengths (of total at most capacity) with multiplicities. weights[l]: of length l."""
    lengths = np.flatnonzero(weights[: capacity + 1] > 0)
    w = weights[lengths]
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    ends = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        if ends[c]:
            values = w[: ends[c]] + best[c - lengths[: ends[c]]]
            i = int(values.argmax())
            best[c], pick[c] = values[i], i
    out: dict[int, int] = {}
    c = capacity
    while c > 0 and pick[c] >= 0:
        l = int(lengths[pick[c]])
        out[l] = out.get(l, 0) + 1
        c -= l
    return out


def configuration_lp(counts: np.ndarray, capacity: int, duals: np.ndarray, rounds: int, eta: float = 30.0) -> tuple[list[tuple[dict[int, int], float]], np.ndarray]:
    """A fractional packing of counts[l] pieces of each length l: ([(configuration, uses)], better duals); nothing is packed twice.

    Multiplicative weights: a length's weight is its dual estimate times exp(-eta * the share of it that is covered), so all
    shares rise together. Each round uses the configuration of most weight for one step of its scarcest length. The weights
    reached estimate the duals of what is left.
    """
    have = np.flatnonzero(counts)
    n = np.maximum(counts.astype(float), 1e-9)
    step = float(np.clip(len(have) / 800, 0.01, 0.25))
    covered = np.where(counts > 0, 0.0, 1.0)
    found: list[tuple[dict[int, int], float]] = []
    for _ in range(rounds):
        live = covered < 1 - 1e-9
        if not live.any():
            break
        config = price(np.where(live, duals * np.exp(-eta * covered), 0.0), capacity)
        uses = min(min((1 - covered[l]) * n[l], max(step * n[l], a)) / a for l, a in config.items())
        for l, a in config.items():
            covered[l] += uses * a / n[l]
        found.append((config, uses))
    better = duals.copy()
    better[have] *= np.exp(-eta * np.clip(covered[have] - np.median(covered[have]), -0.2, 0.2))
    return found, better


def fill(counts: dict[int, int], capacity: int) -> list[int]:
    """One sequence: the longest piece and the subset of the others whose lengths fill the rest best."""
    first = max(counts)
    room = capacity - first
    sums, history = 1, []
    limit = (1 << (room + 1)) - 1
    for l in sorted((l for l in counts if l <= room), reverse=True):
        for _ in range(min(counts[l] - (l == first), room // l)):
            new = (sums | sums << l) & limit
            if new == sums:
                break
            history.append((l, sums))
            sums = new
            if sums >> room & 1:
                break
        if sums >> room & 1:
            break
    at = sums.bit_length() - 1
    out = [first]
    for l, before in reversed(history):
        if not before >> at & 1:
            out.append(l)
            at -= l
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, phases: int = 8, rounds: int = 400) -> list[tuple[int, list[int]]]:
    """(number of sequences, their lengths in order) for all pieces of the histogram."""
    out: list[tuple[int, list[int]]] = []
    counts = np.zeros(capacity + 1, np.int64)
    for l, n in histogram.items():
        counts[l] = n
    if counts[capacity]:
        out.append((int(counts[capacity]), [capacity]))
        counts[capacity] = 0
    duals = np.arange(capacity + 1) / capacity
    for _ in range(phases):
        before = int(counts.sum())
        if before <= 2 * capacity:
            break
        found, duals = configuration_lp(counts, capacity, duals, rounds)
        for config, uses in sorted(found, key=lambda x: -x[1]):
            full = sum(l * n for l, n in config.items()) >= capacity - capacity // 256
            # of a configuration used less than once a whole one is taken only where it wastes nothing
            whole = min(max(int(full), int(uses)), *(int(counts[l]) // n for l, n in config.items()))
            if whole:
                out.append((whole, [l for l, n in sorted(config.items(), reverse=True) for _ in range(n)]))
                for l, n in config.items():
                    counts[l] -= whole * n
        if counts.sum() > 0.7 * before:
            break
    rest = {int(l): int(counts[l]) for l in np.flatnonzero(counts)}
    while rest:
        bin_ = fill(rest, capacity)
        many = max(1, min(rest[l] // bin_.count(l) for l in set(bin_)))
        for l in set(bin_):
            rest[l] -= many * bin_.count(l)
            if not rest[l]:
                del rest[l]
        out.append((many, bin_))
    return out


def places(planned: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length its runs by first rank: (first rank, first sequence, multiplicity in one, first offset)."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for many, lengths in planned:
        offset = 0
        for l in dict.fromkeys(lengths):
            n = lengths.count(l)
            runs.setdefault(l, []).append((ranks.get(l, 0), sequence, n, offset))
            ranks[l] = ranks.get(l, 0) + many * n
            offset += l * n
        sequence += many
    return {l: tuple(np.array(c) for c in zip(*r)) for l, r in runs.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents: (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece.

    Null and empty texts are one piece of end_id. Repeated rows and rows with a null doc_id are packed like any other, each
    as its own document; ties between them are broken by the place in the table of pieces; an empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    # the numbers are written with the pieces, so equal rows keep theirs, and spread over the buckets of ranks
    cut = common.materialise(pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pack")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    buckets = max(1, sum(histogram.values()) // BUCKET_PIECES)
    found = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    salted = cut.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    sizes = salted.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    ranked = salted.withColumn("within", rank).join(before, ["length", "bucket"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("within")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = found.value
        for b in common.parts(batches):
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for l in np.unique(length):
                at = np.flatnonzero(length == l)
                first, seq, many, off = runs[int(l)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                inside = rank[at] - first[k]
                sequence[at] = seq[k] + inside // many[k]
                offset[at] = off[k] + inside % many[k] * l
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECE_SCHEMA + ", sequence_id long, offset long")
