"""Nearest neighbours by an adaptive dimension scan over inverted lists.

Index (fitted on a bounded sample of ``sample_rows`` rows): k-means centres and a
random rotation.  Equal vectors are as far from any query as each other, and ties
go to the smaller id, so of a group of copies only the k + 1 smallest ids can be
among the k nearest of anyone (the query may be one of them): the group enters
the index as these, and a vector that a third of all rows share costs no more
than another.  Every vector is put in the list of its nearest centre; lists are
cut into tiles of about ``tile_rows`` rows, each one row of the index holding the
ids, the rotated vectors as column blocks (dimensions x rows) and the originals.

Search: a query probes the lists of its nearest centres.  In each tile distances
grow block by block; after t of d dimensions a candidate is abandoned if
``partial * d / t > (1 + eps / sqrt(t))^2 * bound^2``, the test that its whole
distance exceeds the bound with the error that a random rotation allows.  The
bound starts as the query's k-th distance among the sample's rows and shrinks
with the tile's own best.  Survivors get their exact distance on the original
vectors in double precision.

The number of probed lists is not guessed: for ``calibration`` sample queries the
exact neighbours among all rows (blocks of rows against these few queries) tell
how many lists reach ``target_recall``.

On the driver: the sample, the centres, counts per list and the calibration's
neighbours, all bounded by parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import literal, unit_hash
from tillpoint.session import cut_lineage

SAMPLE_ROWS = 8192
MAX_LISTS = 1024
TILE_ROWS = 256
QUERY_BLOCK = 64
BLOCK_DIMS = 16
EPS = 2.1
CALIBRATION = 100
TARGET_RECALL = 0.985
LEAST_LIST = 64
K = 10


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int | None = None) -> tuple[DataFrame, int]:
    """(id, x array<double>) of the vectors that take part, and their dimension.

    Out stay rows with a null id, null or empty vectors, zero vectors, vectors with a null, NaN or infinite
    component, and vectors whose length isn't ``dim`` (by default the commonest length, ties to the shorter).
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    good = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & finite & F.exists("x", lambda v: v != 0.0))
    if dim is None:
        first = good.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
        dim = first["d"] if first else 0
    return good.filter(F.size("x") == dim), dim


def first_copies(rows: DataFrame, most: int) -> DataFrame:
    """The rows (id, x) of the ``most`` smallest ids of each vector; Spark limits the groups before the shuffle too."""
    order = Window.partitionBy("x").orderBy("id")
    return rows.withColumn("copy", F.dense_rank().over(order)).filter(F.col("copy") <= most).drop("copy")


def _centres(sample: np.ndarray, n: int, seed: int, rounds: int = 8) -> np.ndarray:
    pick = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centres = distinct[pick.permutation(len(distinct))[:n]].copy()
    for _ in range(rounds):
        own = _nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        count = np.bincount(own, minlength=len(centres))
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


def _to_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant per row."""
    return (centres ** 2).sum(1)[None, :] - 2.0 * x @ centres.T


def _nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_to_centres(x[i:i + 2048], centres).argmin(1) for i in range(0, len(x), 2048)]) if len(x) else np.zeros(0, np.int64)


def _best(ids: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest by (distance, id)."""
    if len(ids) > 4 * k:
        edge = np.partition(dist, k - 1)[k - 1]
        at = np.flatnonzero(dist <= edge)
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], dist[at]))][:k]


def exact_distances(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - x[None, :]) ** 2).sum(1))


@dataclass
class Index:
    dim: int
    centres: np.ndarray
    rotation: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    counts: np.ndarray          # rows per list
    tiles: DataFrame            # list, tile, ids, blocks, originals
    tiles_of: list[int]
    probes: int
    n_rows: int


def build_index(rows: DataFrame, dim: int, k: int = K, sample_rows: int = SAMPLE_ROWS, max_lists: int = MAX_LISTS, tile_rows: int = TILE_ROWS,
                calibration: int = CALIBRATION, target_recall: float = TARGET_RECALL, seed: int = 3) -> Index:
    """``rows``: (id, x) from ``usable``; not empty."""
    n = rows.count()
    bound = max(64, min(sample_rows, (64 << 20) // (8 * dim)))
    drawn = rows.filter(unit_hash(F.col("id"), seed=seed) < F.lit(min(1.0, bound / n))).toPandas()
    if not len(drawn):
        drawn = rows.limit(1).toPandas()
    drawn = drawn.sort_values("id", kind="stable")
    sample = np.stack(drawn["x"].to_numpy())
    sample_ids = drawn["id"].to_numpy(np.int64)
    n_lists = int(min(max_lists, max(1, len(sample) // 8), max(1, 1.2 * np.sqrt(n)), max(1, n // LEAST_LIST)))
    centres = _centres(sample, n_lists, seed)
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((centres, rotation.astype(np.float32)))   # at most max_lists x dim and dim x dim numbers

    @F.pandas_udf("int")
    def list_of(x: pd.Series) -> pd.Series:
        return pd.Series(_nearest_centre(np.stack(x.to_numpy()), shared.value[0]) if len(x) else [], dtype="int32")

    listed = cut_lineage(rows.select("id", "x", list_of("x").alias("list")))
    counts = np.zeros(len(centres), np.int64)
    for r in listed.groupBy("list").agg(F.count("*").alias("n")).collect():   # a row per list
        counts[r["list"]] = r["n"]
    tiles_of = [max(1, -(-int(c) // tile_rows)) for c in counts]
    in_list = F.element_at(literal(tiles_of, "array<bigint>"), F.col("list") + 1)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        x = np.stack(rows["x"].to_numpy())
        turned = x.astype(np.float32) @ shared.value[1]
        blocks = [np.ascontiguousarray(turned[:, d:d + BLOCK_DIMS].T).tobytes() for d in range(0, x.shape[1], BLOCK_DIMS)]
        return pd.DataFrame({"list": rows["list"].iloc[:1], "tile": rows["tile"].iloc[:1], "ids": [rows["id"].to_numpy(np.int64).tobytes()],
                             "blocks": [blocks], "originals": [x.tobytes()]})

    tiled = listed.withColumn("tile", F.pmod(F.xxhash64("id", F.lit(seed)), in_list))
    tiles = cut_lineage(tiled.groupBy("list", "tile").applyInPandas(pack, "list int, tile long, ids binary, blocks array<binary>, originals binary"))
    probes = _calibrate(listed, sample_ids, sample, centres, calibration, k, target_recall)
    return Index(dim, centres, rotation, sample_ids, sample, counts, tiles, tiles_of, probes, n)


def exact_neighbours(rows: DataFrame, queries: list[tuple[int, np.ndarray]], k: int, keep: list[str] | None = None) -> DataFrame:
    """(query, id, score, keep...): the exact k nearest rows of a bounded set of queries, by blocks of rows."""
    keep = keep or []
    shared = rows.sparkSession.sparkContext.broadcast(queries)
    kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def scan(batches):
        found: dict[int, pd.DataFrame] = {}
        for batch in batches:
            if not len(batch):
                continue
            x, ids = np.stack(batch["x"].to_numpy()), batch["id"].to_numpy(np.int64)
            for q, vec in shared.value:
                dist = exact_distances(vec, x)
                dist[ids == q] = np.inf
                at = _best(ids, dist, k)
                at = at[np.isfinite(dist[at])]
                part = pd.DataFrame({"query": q, "id": ids[at], "score": dist[at]} | {c: batch[c].to_numpy()[at] for c in keep})
                part = pd.concat([found[q], part]) if q in found else part
                found[q] = part.sort_values(["score", "id"], kind="stable").head(k)
        if found:
            yield pd.concat(found.values())

    near = rows.mapInPandas(scan, f"query long, id long, score double{kinds}")
    order = Window.partitionBy("query").orderBy("score", "id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _calibrate(listed: DataFrame, ids: np.ndarray, sample: np.ndarray, centres: np.ndarray, calibration: int, k: int, target: float) -> int:
    pick = np.random.default_rng(1).permutation(len(ids))[:calibration]
    near = exact_neighbours(listed, [(int(ids[i]), sample[i]) for i in pick], k, ["list"]).toPandas()   # calibration x k rows
    if not len(near):
        return 1
    order = {int(ids[i]): np.argsort(_to_centres(sample[i:i + 1], centres)[0], kind="stable").argsort(kind="stable") for i in pick}
    ranks = np.sort([order[q][l] for q, l in zip(near["query"], near["list"])])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]) + 1


def search(index: Index, queries: DataFrame, k: int = K, eps: float = EPS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every query row (id, x), itself (its id) left out.

    A query probes ``index.probes`` lists, and more if these hold fewer than k + 1 rows.  Ties go to the smaller
    id; with fewer than k candidates all are returned.
    """
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.centres, index.sample_ids, index.sample, index.counts, index.rotation.astype(np.float32)))
    probes, dim = index.probes, index.dim

    def route(batches):
        centres, s_ids, sample, counts, _ = shared.value
        for batch in batches:
            out = []
            for q, x in zip(batch["id"].to_numpy(np.int64), batch["x"]):
                order = np.argsort(_to_centres(x[None, :], centres)[0], kind="stable")
                n = max(probes, int(np.searchsorted(np.cumsum(counts[order]), k + 1)) + 1)
                dist = exact_distances(x, sample)[s_ids != q]
                bound = float(np.partition(dist, k - 1)[k - 1]) if len(dist) >= k else np.inf
                out += [(int(l), int(q), x.tobytes(), bound) for l in order[:n] if counts[l]]
            yield pd.DataFrame(out, columns=["list", "query_id", "q", "bound"])

    routed = queries.select("id", "x").mapInPandas(route, "list int, query_id long, q binary, bound double")
    routed = cut_lineage(routed)
    loads = {r["list"]: r["n"] for r in routed.groupBy("list").agg(F.count("*").alias("n")).collect()}   # a row per list
    lists = range(len(index.counts))
    tiles_of = F.element_at(literal(index.tiles_of, "array<bigint>"), F.col("list") + 1)
    deals = F.element_at(literal([max(1, -(-loads.get(i, 0) // query_block)) for i in lists], "array<bigint>"), F.col("list") + 1)
    each = routed.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), tiles_of - 1)))
    part = F.pmod(F.xxhash64("query_id"), deals)   # about query_block queries of a list in each part
    blocks = (each.groupBy(F.col("list").alias("q_list"), F.col("tile").alias("q_tile"), part.alias("part"))
              .agg(F.collect_list(F.struct("query_id", "q", "bound")).alias("qs")))
    pairs = blocks.join(index.tiles, (F.col("q_list") == F.col("list")) & (F.col("q_tile") == F.col("tile")))

    def scan(batches):
        for batch in batches:
            out = []
            for ids_b, blocks_b, orig_b, qs in zip(batch["ids"], batch["blocks"], batch["originals"], batch["qs"]):
                ids = np.frombuffer(ids_b, np.int64)
                tile = [np.frombuffer(b, np.float32).reshape(-1, len(ids)) for b in blocks_b]
                originals = np.frombuffer(orig_b, np.float64).reshape(len(ids), dim)
                for q in qs:
                    out.append(_scan(int(q["query_id"]), np.frombuffer(q["q"], np.float64), q["bound"], ids, tile, originals, shared.value[4], k, eps))
            if out:
                yield pd.DataFrame({"query_id": np.concatenate([o[0] for o in out]), "vec_id": np.concatenate([o[1] for o in out]),
                                    "score": np.concatenate([o[2] for o in out])})

    found = pairs.select("ids", "blocks", "originals", "qs").mapInPandas(scan, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _scan(q: int, x: np.ndarray, bound: float, ids: np.ndarray, tile: list[np.ndarray], originals: np.ndarray, rotation: np.ndarray, k: int, eps: float):
    """The tile's up to k candidates for one query: (query ids, ids, exact distances)."""
    turned = x.astype(np.float32) @ rotation
    d, t = len(x), 0
    slack = 1e-5 * max(1.0, float(x @ x))   # single precision of the rotated values
    alive = np.flatnonzero(ids != q)
    partial = np.zeros(len(alive), np.float32)
    for rows in tile:
        step = rows[:, alive] - turned[t:t + len(rows), None]
        partial += np.einsum("ij,ij->j", step, step)
        t += len(rows)
        if np.isfinite(bound):
            keep = partial * (d / t) <= (1.0 + eps / np.sqrt(t)) ** 2 * bound * bound + slack
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    dist = exact_distances(x, originals[alive])
    at = _best(ids[alive], dist, k)
    return np.full(len(at), q, np.int64), ids[alive][at], dist[at]


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, **options) -> DataFrame:
    """Index all usable rows, search for those where ``is_query`` (over the column ``id``) holds.

    All usable rows are queried against, however many copies a vector has: see ``first_copies`` for the rows that the
    index holds.  An empty table, or one without usable vectors, gives an empty result; rows that repeat an id are
    candidates of their own, but never of a query with that id.
    """
    rows, dim = usable(vectors, id_col, vec_col)
    rows = cut_lineage(rows)
    if not dim:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build_index(cut_lineage(first_copies(rows, k + 1)), dim, k, **options)
    return search(index, rows.filter(is_query), k)
