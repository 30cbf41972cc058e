"""SentencePiece encoding and decoding by weighted finite-state transduction.

A model file is compiled to three machines of states and arcs:

* ``Normaliser``: a trie over the model's character map; its arcs read characters, its final states write what they become
  (longest match first, any other character stands for itself), and two more states drop blanks that are left out.
* ``PieceMachine``: a trie of all pieces. A path from the root to a final state is an arc of the lattice that writes the piece.
* Byte fallback: a loop that reads a character without a piece and writes the pieces of its UTF-8 bytes, or the unknown piece.

An input is composed with them lazily: only the states that it reaches are ever made, and its ids are the output of the
shortest path in the tropical semiring.

* Unigram models: an arc weighs minus its piece's score, an unknown character more than any piece. Sums are rounded to single
  precision, as the library rounds them, so that near ties fall alike.
* BPE models: merging is not a sum of weights, but a sequence of pieces is what merging gives exactly if every piece merges to
  itself and any two neighbours stay apart. So the lattice is composed with the acceptor of neighbours, whose states are
  pieces and whose arcs weigh 0 or infinity. Its arcs come from the compiled merge trees: of two neighbours the right
  spine of one and the left spine of the other face each other, and an arc weighs infinity if some facing pair merges
  before either of them merges away from the border. Every prefix has one finite path, so a place needs one state.

BPE texts are worked off in units that no piece crosses: at blanks, and between characters that no piece holds in a row.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.llm import common

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE_UNITS = 250_000
CACHE_PAIRS = 400_000
INFINITY = math.inf
#: What an unknown character's score lies below the least score of a piece.
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            x = data[i]
            i += 1
            value |= (x & 127) << shift
            shift += 7
            if x < 128:
                return value

    while i < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[i : i + n]
            i += n


class Trie:
    """States as numbers; arcs[state] maps a character to the next state, output[state] is set where a path may end."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = [{}]
        self.output: list = [None]

    def add(self, path: str, output) -> None:
        state = 0
        for c in path:
            nxt = self.arcs[state].get(c)
            if nxt is None:
                nxt = self.arcs[state][c] = len(self.arcs)
                self.arcs.append({})
                self.output.append(None)
            state = nxt
        self.output[state] = output


def _character_map(blob: bytes) -> Iterator[tuple[str, str]]:
    """(read, written) of a compiled character map: a double array of byte transitions, then the written texts."""
    size = struct.unpack_from("<I", blob)[0]
    units = np.frombuffer(blob, "<u4", size // 4, 4)
    texts = blob[4 + size :]
    if not len(units):
        return
    label = np.where(units >> 31, 256, units & 0xFF)
    step = (units >> 10) << ((units & (1 << 9)) >> 6)
    children: dict[int, list[tuple[int, int]]] = {}
    for at in np.flatnonzero(label < 256).tolist():
        children.setdefault(at ^ int(label[at]), []).append((int(label[at]), at))
    todo = [(0, b"")]
    while todo:
        at, path = todo.pop()
        base = at ^ int(step[at])
        if units[at] >> 8 & 1:
            start = int(units[base]) & 0x7FFFFFFF
            yield path.decode("utf-8"), texts[start : texts.index(b"\0", start)].decode("utf-8")
        todo += [(child, path + bytes([c])) for c, child in children.get(base, ()) if c]


class Normaliser:
    """The transducer from a text to the form that pieces are matched with. Blanks and visible blanks are the same there; here
    both are plain blanks, in pieces too, which keeps most texts in one byte a character."""

    def __init__(self, spec: dict[int, int | bytes], kept: list[str] = ()):
        if not spec.get(5, 1):
            raise ValueError("models that keep blanks and visible blanks apart are not supported")
        self.prefix, self.strip = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.map = Trie()
        first, later = set(), set()
        for read, written in _character_map(spec[2]) if spec.get(2) else ():
            self.map.add(read, written)
            if len(read) == 1:
                first.add(read)
            else:
                later.add(read[1])
        # a text without a character that is mapped alone, or second in a longer match, passes as it is
        mapped = "".join(sorted(first | later))
        self.touched = re.compile(f"[{re.escape(mapped)}]").search if mapped else lambda text: None
        self.kept = re.compile("(" + "|".join(map(re.escape, sorted(kept, key=len, reverse=True))) + ")").split if kept else None

    def rewrite(self, text: str) -> str:
        """The path of longest matches through the character map."""
        if not self.touched(text):
            return text
        arcs, output, out, at = self.map.arcs, self.map.output, [], 0
        while at < len(text):
            state, i, found, end = 0, at, text[at], at + 1
            while i < len(text) and (state := arcs[state].get(text[i])) is not None:
                i += 1
                if output[state] is not None:
                    found, end = output[state], i
            out.append(found)
            at = end
        return "".join(out)

    def __call__(self, text: str) -> str:
        if self.kept:
            text = "".join(part if i % 2 else self.rewrite(part) for i, part in enumerate(self.kept(text)))
        else:
            text = self.rewrite(text)
        if self.strip:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = text.replace(BLANK, " ")
        if self.prefix:
            text = " " + text
        return text.rstrip(" ") if self.strip else text  # visible blanks at the end go, too


class Transducer:
    """The compiled machines of one model."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        normaliser: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        for number, value in _fields(model):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode("utf-8").replace(BLANK, " "))
                self.scores.append(struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.bpe = trainer.get(3, 1) == 2
        if not self.bpe and trainer.get(3, 1) != 1:
            raise ValueError("only BPE and unigram models can be compiled")
        if trainer.get(24):
            raise ValueError("models with blanks as suffixes are not supported")
        self.user = [p for p, k in zip(self.pieces, self.kinds) if k == USER]
        self.normalise = Normaliser(normaliser, self.user)
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in ((NORMAL, UNUSED) if self.bpe else (NORMAL, USER))}
        known = [self.scores[i] for i, k in enumerate(self.kinds) if k == NORMAL]
        self.least, self.most = min(known, default=0.0), max(known, default=0.0)
        self.output = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.encode("utf-8") for p, k in zip(self.pieces, self.kinds)]
        self.plain_output = UNUSED not in self.kinds
        self.trie = Trie()
        if self.bpe:
            self._compile_merges()
            self._compile_units()
        for p, i in self.ids.items():
            if not self.bpe or i in self.left:
                self.trie.add(p, i)

    # byte fallback

    def _fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]

    # unigram

    def _lattice_path(self, text: str) -> list[str]:
        """The shortest path of a normalised text; of equal ones that of the longer last piece."""
        n, arcs, output, read = len(text), self.trie.arcs, self.trie.output, text.replace(BLANK, " ")
        width = [len(c.encode("utf-8", "surrogatepass")) for c in text] if self.user else ()
        score = [-INFINITY] * (n + 1)  # minus the weight of the best path to a place
        back = [-1] * (n + 1)
        score[0], single = 0.0, array("f", [0.0])
        for start in range(n):
            here, state, i, lone = score[start], 0, start, False
            while i < n and (state := arcs[state].get(read[i])) is not None:
                i += 1
                piece = output[state]
                if piece is not None:
                    lone |= i == start + 1
                    total = here + (self.scores[piece] if self.kinds[piece] == NORMAL else sum(width[start:i]) * self.most - 0.1)
                    single[0] = total
                    if back[i] < 0 or single[0] > score[i]:
                        score[i], back[i] = single[0], start
            if not lone:
                single[0] = here + (self.least - UNKNOWN_PENALTY)
                if back[start + 1] < 0 or single[0] > score[start + 1]:
                    score[start + 1], back[start + 1] = single[0], start
        out, at = [], n
        while at:
            out.append(text[back[at] : at])
            at = back[at]
        return out[::-1]

    def _unigram(self, text: str) -> bytes:
        out: list[int] = []
        for piece in self._lattice_path(text):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.bytes or not out or out[-1] != self.unknown:  # a run of unknown characters is one piece
                out += self._fallback(piece)
        return np.array(out, "<u4").tobytes()

    # BPE

    def _compile_merges(self) -> None:
        """Spines of all pieces that merging can give.

        Symbols are pieces and the characters in pieces. A symbol's left spine is itself, its left part, that one's left
        part and so on, each with the score at which it merges away from the left border; right spines likewise.
        """
        rank = {p: self.scores[i] for p, i in self.ids.items()}
        for p in self.user:
            rank.setdefault(p, self.scores[self.pieces.index(p)])
        self.merged = rank
        #: of each symbol: ((part, score of the merge that takes it away), ...)
        lefts: dict[str, tuple] = {c: ((c, -INFINITY),) for c in sorted({c for p in rank for c in p})}
        rights = dict(lefts)
        self.parts: dict[str, tuple[str, str]] = {}
        self._lefts, self._rights = lefts, rights
        for p in sorted((p for p in rank if len(p) > 1), key=lambda p: (-rank[p], len(p))):
            own = rank[p]
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in lefts and b in lefts and self._apart(a, b, True):
                    lefts[p] = ((p, -INFINITY), (a, own), *lefts[a][1:])
                    rights[p] = ((p, -INFINITY), (b, own), *rights[b][1:])
                    self.parts[p] = (a, b)
                    break
        self.left = {i for p, i in self.ids.items() if p in lefts}
        #: States of the neighbour acceptor: pieces by id, then characters in pieces that are no pieces, then all others as one.
        lone = [c for c in lefts if len(c) == 1 and c not in self.ids]
        self.symbols = [*self.pieces, *lone]
        self.lone = {c: len(self.pieces) + k for k, c in enumerate(lone)}

    def _apart(self, left: str, right: str, whole: bool = False) -> bool:
        """Whether two neighbours stay apart while they are built, and (unless whole) after that."""
        merged, lefts = self.merged, self._lefts[right]
        for i, (r, gone_r) in enumerate(self._rights[left]):
            for j, (l, gone_l) in enumerate(lefts):
                score = None if whole and i == j == 0 else merged.get(r + l)
                # of equal scores the leftmost pair merges first: r goes away to the left of the border, l to the right
                if score is not None and score > gone_r and score >= gone_l:
                    return False
        return True

    def _compile_units(self) -> None:
        multi = [p for p in self.ids if len(p) > 1]
        #: Neighbouring characters inside pieces; no piece crosses any others, so units are cut between those.
        self.inner = {p[i : i + 2] for p in self.merged for i in range(len(p) - 1)}
        joined = {c for p in multi for c in p}
        if any(" " in p.lstrip(" ") for p in self.merged):
            self.cut = re.compile(r"(?s).+").findall  # a piece crosses blanks, so a text is one unit
        else:
            lone = "".join(c for c in map(chr, range(32)) if c not in joined)
            lone = re.escape(lone) or r"\0"
            self.cut = re.compile(f" *[^ {lone}]+|[{lone}]| +").findall
        self.frozen = re.compile("(" + "|".join(map(re.escape, sorted(self.user, key=len, reverse=True))) + ")").split if self.user else None
        self.pairs: dict[int, bool] = {}
        self.unit = common.Recent(self._unit, CACHE_UNITS)

    def accepts(self, left: int, right: int) -> bool:
        """The neighbour acceptor's arc from left to right: True weighs 0."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        n = len(self.symbols)
        found = self.pairs[left * (n + 1) + right] = left == n or right == n or self._apart(self.symbols[left], self.symbols[right])
        return found

    def _pair_path(self, unit: str) -> list[int]:
        """The shortest path as symbols. Finite arcs all weigh 0, so the first finite path found is it: states are expanded
        depth first, arcs of longer pieces first. A place has one state, so a place that led nowhere is never entered again.
        """
        arcs, output, pairs, accepts = self.trie.arcs, self.trie.output, self.pairs, self.accepts
        root, n, other = arcs[0], len(unit), len(self.symbols)
        path: list[int] = []
        open_arcs: list[tuple[int, list[tuple[int, int]]]] = []  # of the states on the path: place and arcs (end, symbol) not tried yet, longest last
        dead = set()
        here, at = other, 0
        while at < n:
            own = []
            state, i = root.get(unit[at]), at + 1
            if state is None or output[state] is None:  # a character without a piece
                own.append((i, self.lone.get(unit[at], other)))
            while state is not None:
                piece = output[state]
                if piece is not None:
                    own.append((i, piece))
                if i == n:
                    break
                state = arcs[state].get(unit[i])
                i += 1
            while True:
                base = here * (other + 1)
                while own:
                    end, symbol = own.pop()
                    ok = pairs.get(base + symbol)
                    if (ok or ok is None and accepts(here, symbol)) and end not in dead:
                        break
                else:  # back to the state before
                    dead.add(at)
                    if not path:
                        raise ValueError("the model's pieces do not merge in the order of their scores")
                    path.pop()
                    at, own = open_arcs.pop()
                    here = path[-1] if path else other
                    continue
                break
            open_arcs.append((at, own))
            path.append(symbol)
            here, at = symbol, end
        pieces = len(self.pieces)
        if max(path) < pieces:
            return path
        return [symbol if symbol < pieces else -end for symbol, end in zip(path, [*(place for place, _ in open_arcs[1:]), n])]

    def _write(self, symbol: int, unit: str) -> list[int]:
        """The ids that a symbol of a path stands for: a piece, or (-place) the character that ends there."""
        if symbol < 0:
            return self._fallback(unit[-symbol - 1])
        if self.kinds[symbol] == UNUSED and (parts := self.parts.get(self.pieces[symbol])):
            return [x for p in parts for x in (self._write(self.ids[p], p) if p in self.ids else self._fallback(p))]
        return [symbol]

    def _unit(self, unit: str) -> bytes:
        """Ids of a unit as little-endian 32-bit bytes, byte fallback included."""
        inner, at, parts = self.inner, 0, []
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in inner:
                parts.append(unit[at:i])
                at = i
        if parts:
            return b"".join(map(self.unit, [*parts, unit[at:]]))
        path = self._pair_path(unit)
        if self.plain_output and min(path) >= 0:
            return struct.pack(f"<{len(path)}I", *path)
        ids = [i for symbol in path for i in self._write(symbol, unit)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _bpe(self, text: str) -> bytes:
        runs = self.frozen(text) if self.frozen else [text]
        out = []
        for k, run in enumerate(runs):
            if k % 2:
                out.append(self.pieces.index(run).to_bytes(4, "little"))
                continue
            units = self.cut(run)
            found = list(map(self.unit.young.get, units))
            out += [self.unit(u) if f is None else f for f, u in zip(found, units)] if None in found else found
        coded = b"".join(out)
        if self.bytes or not coded:
            return coded
        ids = np.frombuffer(coded, "<u4")  # a run of unknown characters is one piece
        return ids[~((ids == self.unknown) & np.r_[False, ids[:-1] == self.unknown])].tobytes()

    def path(self, text: str) -> bytes:
        """Ids of a normalised text as little-endian 32-bit bytes."""
        return (self._bpe(text) if self.bpe else self._unigram(text)) if text else b""

    def encode(self, text: str | None) -> bytes:
        """Ids of a text; null and empty: none."""
        return self.path(self.normalise(text or ""))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces' bytes, visible blanks to blanks, without the dummy prefix; broken UTF-8 is replaced."""
        data = b"".join(map(self.output.__getitem__, ids.tolist()))
        text = data.decode("utf-8", "replace")
        return text[1:] if self.normalise.prefix and text.startswith(" ") else text


_COMPILED: dict[int, Transducer] = {}


def _compiled(model: bytes) -> Transducer:
    key = zlib.crc32(model)
    if key not in _COMPILED:
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def _model(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_ids, ids_crc32, round_trip), one row for each row of docs.

    ids: array<int>. ids_crc32: of the ids as little-endian unsigned 32-bit numbers. round_trip: whether decoding the ids
    gives the normalised text back. Null and empty texts: no ids, crc 0, true. Repeated rows each get their row, null ids
    pass through, an empty table gives no rows, other columns are ignored. Texts are read whole.
    """
    spark = docs.sparkSession
    held = _model(spark, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _compiled(held.value)
        for b in common.parts(batches):
            texts = [fst.normalise(t or "") for t in b.column(1).to_pylist()]
            coded = list(map(fst.path, texts))
            flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            n = np.array([len(c) // 4 for c in coded], np.int32)
            ends = np.cumsum(n, dtype=np.int64)
            same = []
            for t, e, k in zip(texts, ends.tolist(), n.tolist()):
                same.append(fst.decode(flat[e - k : e]) == (t[1:] if fst.normalise.prefix else t))
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), ids, pa.array(n), pa.array(list(map(zlib.crc32, coded)), pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"])

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(run, "doc_id long, ids array<int>, n_ids int, ids_crc32 long, round_trip boolean")


def decode(coded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of ids; null ids give a null text, null elements are left out."""
    spark = coded.sparkSession
    held = _model(spark, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _compiled(held.value)
        for b in common.parts(batches):
            texts = [None if x is None else fst.decode(np.array([i for i in x if i is not None], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{ids_col}`").cast("array<int>")).mapInArrow(run, "doc_id long, text string")
