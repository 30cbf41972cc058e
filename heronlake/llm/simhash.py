"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has a bit set where over half of a text's shingle hashes have it. Two fingerprints link at ``max_distance``
(3) or fewer differing bits.

Candidate search: the 64 bits are a ring of four 16-bit segments. By the pigeonring principle, whenever two fingerprints
differ in at most 3 bits there is a start segment i from which every chain of l consecutive segments differs in at most
floor(3 l / 4) bits: 0 in the first, 1 in the first two, 2 in the first three, 3 in all. The first two conditions make the
join key: segment i is equal, and of the next segment's two bytes at least one is equal (one differing bit cannot touch
both). The remaining chain budgets prune pairs inside a bucket before the full Hamming check.

Only distinct fingerprints are compared, each bucket returns a spanning forest (never all of its pairs), and components
are found by ``common.connected_components``. A bucket of very many close fingerprints is handled exactly and linearly
through Hamming balls (``_ball_forest``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm import common

SEED = 42
SHINGLE = 3
SEGMENTS = 4
#: From so many fingerprints a bucket is solved by Hamming balls instead of by all of its pairs.
BALL_FROM = 20_000
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included. Null, empty or blank: 0; short: one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # long texts: eight bytes a bit, so in parts
        part = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): the signed form of each row's fingerprint, one row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.parts(batches):
            fps = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _segments(x: np.ndarray, start: int) -> np.ndarray:
    """x turned so that segment ``start`` holds the lowest 16 bits."""
    r = np.uint64(16 * start)
    return (x >> r) | (x << (np.uint64(64) - r)) if start else x


def _pairs_forest(fps: np.ndarray, start: int, max_distance: int) -> list[tuple[int, int]]:
    """Spanning forest of a bucket by breadth-first search; every row is compared once, under the chain budgets."""
    ring = _segments(fps, start)
    left = np.arange(len(fps))
    edges: list[tuple[int, int]] = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            diff = ring[left] ^ ring[at]
            near = np.ones(len(left), bool)
            for l in range(1, SEGMENTS + 1):  # chain of l segments: at most floor(max_distance * l / SEGMENTS) bits
                mask = _FULL if l == SEGMENTS else np.uint64((1 << (16 * l)) - 1)
                near &= _popcount(diff & mask) <= max_distance * l // SEGMENTS
            if near.any():
                hit = left[near]
                edges += [(int(at), int(h)) for h in hit]
                queue += hit.tolist()
                left = left[~near]
    return edges


def _ball_forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """As _pairs_forest for distance 3, in time linear in the rows: x and y link exactly if some z is within 2 bits of x and 1 of y."""
    masks = {0: [0], 1: [1 << i for i in range(64)], 2: [(1 << i) | (1 << j) for i in range(64) for j in range(i)]}
    inner = np.array(masks[0] + masks[1], np.uint64)
    outer = np.array(masks[2], np.uint64)
    hub = np.concatenate([fps ^ m for m in inner])
    owner = np.tile(np.arange(len(fps)), len(inner))
    order = np.argsort(hub, kind="stable")
    hub, owner = hub[order], owner[order]
    first = np.flatnonzero(np.r_[True, hub[1:] != hub[:-1]])
    keys, head = hub[first], owner[first]
    group = np.repeat(np.arange(len(keys)), np.diff(np.r_[first, len(hub)]))
    found = [np.stack([head[group], owner], 1)]
    for m in outer:  # the second ball, one mask at a time
        at = np.searchsorted(keys, z := fps ^ m).clip(max=len(keys) - 1)
        ok = keys[at] == z
        found.append(np.stack([head[at[ok]], np.flatnonzero(ok)], 1))
        if len(found) > 64:
            found = [_spanning(np.concatenate(found), len(fps))]
    return [tuple(map(int, e)) for e in _spanning(np.concatenate(found), len(fps))]


def _spanning(pairs: np.ndarray, n: int) -> np.ndarray:
    """A star forest with the components of pairs (minimum labels by pointer jumping)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    leaf = np.flatnonzero(label != np.arange(n))
    return np.stack([label[leaf], leaf], 1)


def bucket_forest(fps: np.ndarray, start: int, max_distance: int = 3) -> list[tuple[int, int]]:
    """Pairs of positions that link a bucket's distinct fingerprints as all of its links do."""
    if len(fps) >= BALL_FROM and max_distance == 3:
        return _ball_forest(fps)
    return _pairs_forest(fps, start, max_distance)


def links(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp, long), enough to give the components of all links.

    max_distance: 3 at most, since the join key allows one bit in two neighbouring segments.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3")
    keys = []
    for i in range(SEGMENTS):
        seg = F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
        nxt = F.shiftrightunsigned("fp", 16 * ((i + 1) % SEGMENTS)).bitwiseAND(F.lit(0xFFFF))
        for half in range(2):
            byte = F.shiftrightunsigned(nxt, 8 * half).bitwiseAND(F.lit(0xFF))
            keys.append(F.lit((2 * i + half) << 24).cast("long") + seg * 256 + byte)
    spread = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    parts = spread.repartition("key").sortWithinPartitions("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            a, b = [], []
            for s, e in zip(cut[:-1], cut[1:]):
                if e - s > 1:
                    own = fp[s:e].view(np.uint64)
                    for x, y in bucket_forest(own, int(key[s]) >> 25, max_distance):
                        a.append(int(fp[s + x]))
                        b.append(int(fp[s + y]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            fp, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            held.append((key, fp))
            if key[0] == key[-1] == held[0][0][0]:  # the bucket goes on
                continue
            k, f = (np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(k, k[-1]))
            held = [(k[last:], f[last:])]
            yield flush(k[:last], f[:last])
        if held:
            yield flush(*(np.concatenate(x) for x in zip(*held)))

    return parts.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each input row.

    component_id: the smallest doc_id among all rows reachable through links, the row itself included.
    Null, empty and blank texts have fingerprint zero and link like any other. Rows with a null doc_id get a fingerprint
    and their component's smallest non-null doc_id (null if it has none). Repeated rows come back as often as they
    came. An empty table gives an empty result; other columns are ignored.
    """
    rows = common.materialise(with_fingerprints(docs, id_col, text_col), "simhash")
    classes = common.materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    roots = common.connected_components(links(classes.select("fp"), max_distance))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp")
    lows = linked.groupBy("root").agg(F.min("low").alias("least"))
    named = linked.join(lows, "root").select("fp", "least")
    # a written table, so that the last join is a plain one, whose hot fingerprints Spark can split
    of = common.materialise(classes.join(named, "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id")), "simhash-components")
    return rows.join(of, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_distance: int = 3) -> DataFrame:
    """The rows of docs with one document of each near-duplicate group: the one with the smallest doc_id.

    Of several rows with that doc_id one stays; a group whose doc_ids are all null keeps no row, for none can be named.
    Null, empty and blank texts are one group. An empty table stays empty; other columns are kept, whatever their names.
    """
    [key] = common.fresh(docs.columns, "_keep")
    found = near_duplicates(docs, id_col, text_col, max_distance)
    keep = common.materialise(found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("n")), "simhash-keep")
    # the list grows with the corpus: never broadcast, so the plan is the same at every size
    out = docs.join(keep.select(F.col("doc_id").alias(key)).hint("merge"), F.col(f"`{id_col}`") == F.col(key), "left_semi")
    if keep.where("n > 1").limit(1).count():
        out = out.dropDuplicates([id_col])
    return out
