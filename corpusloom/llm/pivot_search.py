"""Exact inner-product search: vectors keyed by nearest pivot and distance, annuli left out by the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import with_columns
from corpusloom.session import materialize

K = 10
SCALE = 1024
#: Pivots, and annuli of each: the catalogue of annuli has at most their product in rows.
PIVOTS, ANNULI = 32, 16
#: Vectors that meet queries in one group, and queries that meet them at a time.
BLOCK, QUERIES = 8192, 256


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``ints``: components times ``scale``, rounded down. One row per id: of several, the smallest vector.

    Vectors that are null, or hold a null or non-finite component, and null ids take no part.
    """
    given = F.col(f"`{vector_col}`").cast("array<double>")
    fine = given.isNotNull() & F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(given, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return vectors.filter(F.col(f"`{id_col}`").isNotNull() & fine).groupBy(F.col(f"`{id_col}`").cast("long").alias("vec_id")).agg(F.min(ints).alias("ints"))


def _matrix(rows, dim: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones with zeros at their end."""
    out = np.zeros((len(rows), dim), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _lifted(rows: np.ndarray, top: float) -> np.ndarray:
    """One more component that gives all vectors the same length, so that near means a large inner product."""
    rows = rows.astype(float)
    return np.hstack([rows, np.sqrt(np.maximum(top - (rows**2).sum(axis=1), 0))[:, None]])


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exactly: as floating numbers where those are exact, else as integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(queries.shape[1], 1)
    if most < 2**53:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return queries @ rows.T


def best(products: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of the ``k`` highest scores of each query, ties to smaller ids, its own id left out."""
    for i, scores in enumerate(products):
        at = np.flatnonzero(ids != own[i])
        if len(at) > k:
            least = np.partition(scores[at], len(at) - k)[len(at) - k]
            at = at[scores[at] >= least]
        for j in at[np.lexsort((ids[at], -scores[at]))[:k]]:
            yield int(own[i]), int(ids[j]), int(scores[j])


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each query with the other vectors.

    Every vector is keyed by its nearest of ``PIVOTS`` pivots (a bounded sample: the smallest hashes of ids) and its
    distance to it, in a space with one more component where nearness is inner product; each pivot's vectors are cut
    into ``ANNULI`` by distance. A query first meets the annuli nearest to it that hold more than ``k`` vectors,
    which bounds its k-th score from below; then every annulus whose best possible score, by the triangle inequality,
    is not under that bound. Results are exact. Annuli are dealt out in blocks of at most about ``BLOCK`` vectors, so a
    pivot that holds a third of all vectors is many groups.

    ``is_query`` says which vectors are queries (default: ``vec_id`` divisible by 100). Equal vectors of different ids
    are different candidates. A shorter vector counts as having zeros at its end. An empty table gives an empty one;
    extra columns are not read.
    """
    spark = vectors.sparkSession
    ints = materialize(whole_vectors(vectors, id_col, vector_col), "vectors")
    norm = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    top, dim = ints.agg(F.max(norm), F.max(F.size("ints"))).first()
    schema = "query_id long, vec_id long, score long"
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = ints.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    pivots = _lifted(_matrix([r["ints"] for r in sample], dim), top)
    shared = spark.sparkContext.broadcast(pivots)
    slack = 1e-6 * (1 + top)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _distances(_lifted(_matrix(batch.column("ints").to_pylist(), dim), top), shared.value)
            near = far.argmin(axis=1) if len(far) else np.empty(0, np.int64)
            columns = [*batch.columns, pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near])]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "ints", "pivot", "distance"])

    keyed = materialize(ints.mapInArrow(key, "vec_id long, ints array<long>, pivot int, distance double"), "keyed")
    cuts = keyed.groupBy("pivot").agg(F.percentile_approx("distance", [i / ANNULI for i in range(1, ANNULI)]).alias("cuts"))
    placed = keyed.join(F.broadcast(cuts), "pivot").withColumn("annulus", F.size(F.filter("cuts", lambda c: c < F.col("distance")))).drop("cuts")
    catalogue = placed.groupBy("pivot", "annulus").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")).toPandas()
    catalogue = catalogue.sort_values(["pivot", "annulus"]).reset_index(drop=True)  # at most PIVOTS * ANNULI rows
    catalogue["blocks"] = -(-catalogue["n"] // BLOCK)
    table = spark.sparkContext.broadcast(catalogue)
    blocks = F.broadcast(spark.createDataFrame(catalogue[["pivot", "annulus", "blocks"]].astype("int64"), "pivot long, annulus long, blocks long"))
    # Both sides of a cogroup need keys of one type: a number has another hash as int than as long.
    placed = placed.withColumns({c: F.col(c).cast("long") for c in ("pivot", "annulus")})
    placed = placed.join(blocks, ["pivot", "annulus"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    queries = ints.filter(is_query if is_query is not None else F.col("vec_id") % 100 == 0)

    def bounds(rows: np.ndarray) -> np.ndarray:
        """The best score a query can have in each annulus."""
        c = table.value
        far = _distances(_lifted_query(rows), shared.value)[:, c["pivot"]]
        gap = np.maximum(0, np.maximum(c["low"].to_numpy() - far, far - c["high"].to_numpy()))
        return ((rows.astype(float) ** 2).sum(axis=1)[:, None] + top - gap**2) / 2 + slack

    def _lifted_query(rows: np.ndarray) -> np.ndarray:
        return np.hstack([rows.astype(float), np.zeros((len(rows), 1))])

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the annuli that each meets first, written because rounding can differ when bounds are computed again."""
        n = table.value["n"].to_numpy()
        for batch in batches:
            early = []
            for own in bounds(_matrix(batch.column("ints").to_pylist(), dim)) if batch.num_rows else ():
                order = np.argsort(-own, kind="stable")
                early.append(order[: np.searchsorted(np.cumsum(n[order]), k + 1) + 1].tolist())
            yield with_columns(batch, early=pa.array(early, pa.list_(pa.int64())))

    def visits(first: bool):
        """For each query, the blocks it meets: the most promising annuli first, or all others that can still matter."""

        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = table.value
            for batch in batches:
                met = batch.column("early").to_pylist()
                if not first and batch.num_rows:
                    least = batch.column("least").to_pylist()
                    reach = bounds(_matrix(batch.column("ints").to_pylist(), dim))
                    met = [np.setdiff1d(np.flatnonzero(own >= (-np.inf if to is None else to)), had) for own, to, had in zip(reach, least, met)]
                out: list[list] = [[], [], [], []]
                for i, annuli in enumerate(met):
                    for a in annuli:
                        for b in range(c["blocks"][a]):
                            for column, value in zip(out, (i, c["pivot"][a], c["annulus"][a], b)):
                                column.append(value)
                at = pa.array(out[0], pa.int64())
                columns = [batch.column("vec_id").take(at), batch.column("ints").take(at), *(pa.array(v, pa.int64()) for v in out[1:])]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "ints", "pivot", "annulus", "block"])

        return plan

    def meet(vectors_in: pd.DataFrame, queries_in: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(vectors_in) and len(queries_in):
            rows, ids = _matrix(vectors_in["ints"].tolist(), dim), vectors_in["vec_id"].to_numpy()
            for i in range(0, len(queries_in), QUERIES):
                part = queries_in.iloc[i : i + QUERIES]
                found.extend(best(_products(_matrix(part["ints"].tolist(), dim), rows), ids, part["query_id"].to_numpy(), k))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    where = ["pivot", "annulus", "block"]

    def met(asked: DataFrame, first: bool) -> DataFrame:
        sent = asked.mapInArrow(visits(first), "query_id long, ints array<long>, pivot long, annulus long, block long")
        return placed.select(*where, "vec_id", "ints").groupBy(*where).cogroup(sent.groupBy(*where)).applyInPandas(meet, schema)

    queries = materialize(queries.mapInArrow(promising, "vec_id long, ints array<long>, early array<long>"), "queries")
    early = materialize(_top(met(queries, True), k), "early")
    least = early.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    asked = queries.join(least.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    return _top(early.drop("rank").unionByName(met(asked, False)), k).select("query_id", "rank", "vec_id", "score")
