"""Near-duplicate embeddings through an inverted multi-index.

Two independent codebooks, one for each half of the dimensions, span a grid of cells. Every vector is filed in the cell of
its two nearest centroids. As a query it visits cells in rising order of the sum of its two half distances (multi-sequence
traversal) until the target recall, and is verified against all vectors filed there. How many cells that takes is
calibrated at fit time on pairs exactly at the similarity threshold, the hardest ones that must be found.

Codebooks and calibration use a bounded sample; all vectors are indexed, and all of them are queries. Only vectors that
differ are compared: equal ones form a class that links within itself.

Cells meet in regions, groups of neighbouring left centroids: a vector travels once to each region that it visits, in the
precision it came in, with the list of its cells, instead of once to each cell. Regions of very many vectors are split into
blocks that are compared pairwise, so no task holds more than two blocks, and a task returns link counts and a spanning
forest, never its pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm import common

THRESHOLD = 0.9
#: Bound of the fit: about so many vectors in the training sample.
SAMPLE = 50_000
TARGET_RECALL = 0.97
#: Vectors a cell should hold; fixes the size of the codebooks between the bounds.
CELL_VECTORS = 24
CODEBOOK = (4, 4096)
#: Vectors that a region is laid out for, and from how many on it is split.
REGION_VECTORS = 8_000
BLOCK = 32_000
#: Entries of one matrix of similarities, and rows in one matrix of distances.
MATRIX = 1 << 21
ROWS = 2048


def usable(v: np.ndarray | list | None) -> np.ndarray | None:
    """The unit vector in double precision, or None for null, empty, zero and non-finite vectors and null components."""
    if v is None or len(v) == 0 or any(x is None for x in v):
        return None
    a = np.asarray(v, np.float64)
    if not np.isfinite(a).all():
        return None
    top = np.abs(a).max()
    if top == 0:
        return None
    a = a / top
    return a / np.sqrt(a @ a)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([distances(x[i : i + ROWS], c).argmin(1) for i in range(0, len(x), ROWS)])
        sums, n = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[r.integers(0, len(x), len(c))])
    return c


@dataclass
class Index:
    """Codebooks of both halves, the number of cells that a query visits, and the region of each left centroid."""

    left: np.ndarray
    right: np.ndarray
    visits: int = 1
    regions: np.ndarray | None = None

    def region(self, cells: np.ndarray) -> np.ndarray:
        return self.regions[cells // len(self.right)]

    @staticmethod
    def rank(a: np.ndarray, b: np.ndarray, cell: int) -> int:
        """Place of a cell in the traversal for distances a and b: cells that are nearer, and one."""
        cost = a[cell // len(b)] + b[cell % len(b)]
        return int(np.searchsorted(np.sort(b), cost - a, side="left").sum()) + 1

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def tables(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, : self.half], self.left), distances(x[:, self.half :], self.right)

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = self.tables(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def traverse(self, a: np.ndarray, b: np.ndarray, visits: int) -> list[int]:
        """The first cells in rising order of a[i] + b[j], by the multi-sequence algorithm over the sorted halves."""
        i_of, j_of = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        x, y = a[i_of].tolist(), b[j_of].tolist()
        heap, out, done, width = [(x[0] + y[0], 0, 0)], [], {}, len(self.right)
        while heap and len(out) < visits:
            _, i, j = heapq.heappop(heap)
            out.append(int(i_of[i]) * width + int(j_of[j]))
            done[i] = j + 1  # row i is worked off up to here
            if i + 1 < len(x) and done.get(i + 1, 0) == j:
                heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
            if j + 1 < len(y) and (i == 0 or done.get(i - 1, 0) > j + 1):
                heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        return out

    @staticmethod
    def fit(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> Index:
        """sample: unit vectors; rows: how many will be indexed."""
        k = int(np.clip(np.sqrt(max(1, rows / CELL_VECTORS)), *CODEBOOK))
        k = max(1, min(k, len(sample)))
        half = max(1, sample.shape[1] // 2)
        index = Index(kmeans(sample[:, :half], k), kmeans(sample[:, half:], k) if sample.shape[1] > half else np.zeros((1, sample.shape[1] - half)))
        # pairs exactly at the threshold: x and a neighbour of it in a random direction
        r = np.random.default_rng(11)
        x = sample[r.choice(len(sample), min(1000, len(sample)), replace=False)]
        u = r.normal(size=x.shape)
        u -= (u * x).sum(1)[:, None] * x
        size = np.sqrt((u * u).sum(1))[:, None]
        y = threshold * x + np.sqrt(1 - threshold**2) * np.divide(u, size, out=np.zeros_like(u), where=size > 0)
        ranks = []
        for q, d in ((x, y), (y, x)):
            ranks.append(np.array([Index.rank(p, r_, c) for p, r_, c in zip(*index.tables(q), index.cell(d).tolist())]))
        index.visits = int(max(1, np.quantile(np.minimum(*ranks), target, method="higher")))  # a pair is found from either side
        groups = kmeans(index.left, int(min(k, max(1, -(-rows // REGION_VECTORS)))))
        index.regions = distances(index.left, groups).argmin(1).astype(np.int32)
        return index


def _forest(near: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, node) with the components of a bipartite block of links; rows and cols: ids."""
    r, c = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(r):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sub = near[np.ix_(r, c)]
    big = np.iinfo(np.int64).max
    row, col = rows[r].copy(), cols[c].copy()
    while True:
        new_col = np.minimum(col, np.where(sub, row[:, None], big).min(0))
        new_row = np.minimum(row, np.where(sub, new_col[None, :], big).min(1))
        if (new_col == col).all() and (new_row == row).all():
            break
        row, col = new_row, new_col
    a, b = np.r_[rows[r], cols[c]], np.r_[row, col]
    edges = np.unique(np.stack([a, b], 1)[a != b], axis=0)
    return edges[:, 0], edges[:, 1]


def _meet(index: Index, region: int, threshold: float, q: pd.DataFrame, d: pd.DataFrame) -> tuple[dict[str, np.ndarray], list[np.ndarray]]:
    """Links between visitors q and residents d of a region: counts by id, and edges with the links' components."""
    units = lambda df: np.stack([usable(np.frombuffer(v, k)) for v, k in zip(df["payload"], df["kind"])])
    x, y = units(q), units(d)
    qi, di, qw, dw = (df[c].to_numpy() for df, c in ((q, "id"), (d, "id"), (q, "weight"), (d, "weight")))
    q_home, d_home = q["home"].to_numpy(), d["home"].to_numpy()
    q_roads, d_roads = (np.stack([np.frombuffer(v, np.int32) for v in df["roads"]]) for df in (q, d))
    d_roads = np.sort(d_roads, axis=1)
    who, place = np.nonzero(index.region(q_roads) == region)
    cells = q_roads[who, place]
    order = np.argsort(cells, kind="stable")
    cells, who = cells[order], who[order]
    lives = np.argsort(d_home, kind="stable")
    homes, first = np.unique(d_home[lives], return_index=True)
    last = np.r_[first[1:], len(lives)]
    start, stop = np.searchsorted(cells, homes, "left"), np.searchsorted(cells, homes, "right")
    n_q, n_d = np.zeros(len(q), np.int64), np.zeros(len(d), np.int64)
    edges: list[np.ndarray] = []
    for c in np.flatnonzero(stop > start).tolist():
        own = lives[first[c] : last[c]]
        step = max(1, MATRIX // len(own))
        for at in range(start[c], stop[c], step):
            v = who[at : min(at + step, stop[c])]
            near = (x[v] @ y[own].T >= threshold) & (qi[v][:, None] != di[own][None, :])
            rows, cols = near.any(1), near.any(0)
            if not rows.any():
                continue
            v, near, mine = v[rows], near[np.ix_(rows, cols)], own[cols]
            np.add.at(n_q, v, near @ dw[mine])
            # a pair seen from both sides is met twice: the resident's side counts only where it does not visit the other's home
            unique, back = np.unique(q_home[v], return_inverse=True)
            both = np.stack([(d_roads[mine] == u).any(1) for u in unique])[back]
            np.add.at(n_d, mine, (near & ~both).T @ qw[v])
            edges.append(np.stack(_forest(near, qi[v], di[mine]), 1))
    return {"q": n_q, "d": n_d}, edges


def _region(pdf: pd.DataFrame, index: Index, threshold: float) -> pd.DataFrame:
    """Compare a region, or a block of visitors with one of residents: rows (a, b, n), n links for a where b is null, else an edge a, b."""
    region = int(pdf["region"].iloc[0])
    visiting, living = pdf[pdf["role"] != 2], pdf[(pdf["role"] == 2) | (pdf["role"] == 0) & (index.region(pdf["home"].to_numpy()) == region)]
    columns = {"a": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "edges": np.zeros((0, 2), np.int64)}
    if len(visiting) and len(living):
        n, edges = _meet(index, region, threshold, visiting, living)
        ids, counts = np.r_[visiting["id"].to_numpy(), living["id"].to_numpy()], np.r_[n["q"], n["d"]]
        found = np.concatenate(edges) if edges else columns["edges"]
        columns = {"a": ids[counts > 0], "n": counts[counts > 0], "edges": _spanning_forest(found)}
    a, e = columns["a"], columns["edges"]
    return pd.DataFrame({"a": np.r_[a, e[:, 0]], "b": pd.array([*[None] * len(a), *e[:, 1].tolist()], dtype="Int64"), "n": np.r_[columns["n"], np.zeros(len(e), np.int64)]})


def _spanning_forest(edges: np.ndarray) -> np.ndarray:
    """A star forest with the components of edges."""
    if not len(edges):
        return edges.reshape(0, 2)
    nodes, back = np.unique(edges, return_inverse=True)
    pairs, label = back.reshape(-1, 2), np.arange(len(nodes))
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
    leaf = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[leaf], nodes[label[leaf]]], 1)


def _links(classes: DataFrame, total: int, threshold: float, target_recall: float) -> DataFrame:
    """(a, b, n) as in ``_region`` for ``total`` classes of one vector length, through an index of their own."""
    spark = classes.sparkSession
    drawn = classes.select("payload", "kind").where(F.pmod(F.xxhash64("payload"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / total)) + 1).limit(2 * SAMPLE)
    sample = np.stack([usable(np.frombuffer(r["payload"], r["kind"])) for r in drawn.toLocalIterator()])
    index = Index.fit(sample, total, threshold, target_recall)
    held = spark.sparkContext.broadcast(index)

    def roads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = held.value
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                pdf = whole.iloc[at : at + ROWS]
                a, b = ix.tables(np.stack([usable(np.frombuffer(v, k)) for v, k in zip(pdf["payload"], pdf["kind"])]))
                home = a.argmin(1) * len(ix.right) + b.argmin(1)
                way = [np.array(ix.traverse(p, q, ix.visits), np.int32) for p, q in zip(a, b)]
                yield pdf[["id", "weight", "payload", "kind"]].assign(home=home.astype("int32"), roads=[w.tobytes() for w in way], regions=[np.unique(ix.region(w)).tolist() for w in way], lives=ix.region(home))

    schema = "id long, weight long, payload binary, kind string, home int, roads binary, regions array<int>, lives int"
    filed = common.materialise(classes.mapInPandas(roads, schema), "vector-cells")
    residents = filed.groupBy(F.col("lives").alias("region")).agg(F.count("*").alias("n"))
    visitors = filed.select(F.explode("regions").alias("region")).groupBy("region").agg(F.count("*").alias("m"))
    full = visitors.join(residents, "region").where((F.col("n") > BLOCK) | (F.col("m") > 2 * BLOCK))
    hot = common.materialise(full.select("region", F.ceil(F.col("n") / BLOCK).cast("int").alias("nd"), F.ceil(F.col("m") / BLOCK).cast("int").alias("nq")), "vector-hot-regions")
    record = ["id", "weight", "payload", "kind", "home", "roads"]
    travelling = filed.select(*record, "lives", F.explode("regions").alias("region"))
    zero = F.lit(0)
    if not hot.limit(1).count():
        sent = travelling.select(*record, "region", zero.alias("dk"), zero.alias("qk"), zero.alias("role"))
    else:
        cool = travelling.join(hot.select("region"), "region", "left_anti").select(*record, "region", zero.alias("dk"), zero.alias("qk"), zero.alias("role"))
        warm = travelling.join(hot, "region")
        own_block = lambda n: F.pmod(F.xxhash64("id"), n.cast("long")).cast("int")
        blocks = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        visiting = warm.select(*record, "region", own_block(F.col("nq")).alias("qk"), blocks(F.col("nd")).alias("dk"), F.lit(1).alias("role"))
        living = warm.where(F.col("lives") == F.col("region")).select(*record, "region", own_block(F.col("nd")).alias("dk"), blocks(F.col("nq")).alias("qk"), F.lit(2).alias("role"))
        sent = cool.unionByName(visiting).unionByName(living)
    met = sent.repartition("region", "dk", "qk").groupBy("region", "dk", "qk").applyInPandas(lambda pdf: _region(pdf, held.value, threshold), "a long, b long, n long")
    return common.materialise(met, "vector-links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of vectors; see ``fit`` for what is sampled.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing and are kept. Vectors of
    different lengths have no cosine: each length has its own index, built one after the other. Rows with a null id come back with
    their links, their component's smallest id (null if none) and kept null or false. Repeated rows link with each other. An
    empty table gives no rows; other columns are ignored. Equal vectors are told by a 128-bit hash of their bytes.
    """
    spark = vectors.sparkSession
    single = vectors.select(F.col(f"`{vector_col}`").alias("v")).schema["v"].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<float>" if single else "array<double>").alias("v"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            payload = [None if usable(v) is None else np.asarray(v, kind).tobytes() for v in pdf["v"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "key": [None if p is None else xxhash.xxh3_128_digest(p) for p in payload], "payload": payload})

    own = common.materialise(rows.mapInPandas(packed, "vec_id long, key binary, payload binary"), "vectors")
    # equal vectors are one class, whose node is a number of its own
    classes = own.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"), F.first("payload").alias("payload"))
    classes = common.materialise(classes.select("key", "low", "weight", "payload", F.lit(kind).alias("kind"), F.monotonically_increasing_id().alias("id")), "vector-classes")
    sizes = {r["bytes"]: r["n"] for r in classes.groupBy(F.length("payload").alias("bytes")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return own.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.when(F.col("vec_id").isNotNull(), True).alias("kept"))
    met = spark.createDataFrame([], "a long, b long, n long")
    for width, total in sorted(sizes.items()):
        if total > 1:
            met = met.unionByName(_links(classes.where(F.length("payload") == width), total, threshold, target_recall))
    counts = met.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = common.connected_components(met.where("b is not null").select("a", "b"))
    small = classes.select("key", "low", "weight", "id")
    named = small.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = named.join(lows, "root").join(counts, "id", "left").select("key", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    joined = own.select("vec_id", "key").join(of, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
