"""Nearest vectors by cosine similarity over an inverted-file index.

Index. Vectors are scaled to length one; k-means centroids (fitted on at most
``train_rows`` of them, a documented sample: it only shapes the lists) cut all
of them into lists, every row into the list of its nearest centroid. A list is
written in chunks of about ``CHUNK`` vectors, so a list that holds a third of
all rows is as many tasks as its size asks for. The index keeps each list's
size and radius (the farthest member from its centroid).

Search. A query goes to the ``probes`` lists with the nearest centroids, there
to every chunk, in blocks of queries: a task multiplies one block with one
chunk, both of bounded size, and hands on ``k`` rows per query. Similarities
are those of the full vectors. ``exact=True`` then goes on to the lists that
may still hold a nearer vector: by the triangle inequality a member of a list
is no nearer than the distance to its centroid less the radius. What is found
is the true k nearest, and only lists that the bound cannot rule out are read.

Neighbours rank by similarity rounded to ``PLACES`` decimals, equal ones by
ascending id; a row is no neighbour of its own id. Rows without a vector are
not indexed and find nothing; a zero vector has similarity 0 with all. Rows
that share an id are indexed each; of queries that do the smallest vector asks.
All vectors have the same dimension.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package
from .vectors import kmeans_fit, l2_normalize

CHUNK = 20_000      # vectors of a list that one task holds
QUERIES = 2_000     # queries that one task holds
TRAIN_ROWS = 100_000
PLACES = 9


def cosine(a, b) -> Column:
    """Cosine similarity of two array columns; 0 with a zero vector, null without a vector."""
    x, y = l2_normalize(a), l2_normalize(b)
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)


class VectorIndex:
    """Lists of unit vectors: ``rows`` (id, list, chunk, vec), ``lists`` (list,
    centroid, radius, n, chunks), all written."""

    def __init__(self, df: DataFrame, id_col: str, vec_col: str, n_lists: int | None = None,
                 train_rows: int = TRAIN_ROWS, seed: int = 42, chunk: int = CHUNK):
        ship_package(df.sparkSession)
        units = materialize(df.where(F.col(vec_col).isNotNull()).select(
            F.col(id_col).alias("id"), l2_normalize(vec_col).alias("vec")))
        total = units.count()
        self.n_lists = max(1, min(n_lists or round(total ** 0.5), total))
        if total > train_rows:  # by a hash of the id: the same rows whatever the partitions
            part = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) < int((1 << 20) * train_rows / total)
            sample = units.where(part)
        else:
            sample = units
        if total:
            model, _ = kmeans_fit(sample, "vec", k=self.n_lists, seed=seed)
            centers = np.array([c.tolist() if hasattr(c, "tolist") else list(c) for c in model.clusterCenters()])
        else:
            centers = np.zeros((1, 0))  # one list, of nothing
        self.centers, self.n_lists = centers, len(centers)
        placed = materialize(_nearest(units, centers, 1).select("id", "vec", F.col("near")[0]["list"].alias("list"),
                                                               F.col("near")[0]["d"].alias("d")))
        facts = placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius"))
        self.lists = materialize(facts.withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")))
        # at most n_lists rows, a parameter
        cut = placed.join(F.broadcast(self.lists.select("list", "chunks")), "list")
        self.rows = materialize(cut.select("id", "list", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"), "vec"))

    def search(self, queries: DataFrame, id_col: str, vec_col: str, k: int = 10, probes: int = 8,
               exact: bool = False, block: int = QUERIES) -> DataFrame:
        """``query_id``, ``rank``, ``id``, ``similarity`` of the k nearest."""
        asked = (queries.where(F.col(vec_col).isNotNull()).groupBy(F.col(id_col).alias("query_id"))
                        .agg(F.min(vec_col).alias("v")).select("query_id", l2_normalize("v").alias("q")))
        asked = materialize(_nearest(asked, self.centers, self.n_lists if exact else min(probes, self.n_lists), "q"))
        first = asked.withColumn("near", F.slice("near", 1, max(1, min(probes, self.n_lists))))
        found = self._probe(first, k, block)
        if exact:
            found = materialize(found)
            # the k-th similarity as a distance, with room for its rounding; none yet: everything is near enough
            worst = 2 - 2 * (F.col("similarity") - 10.0 ** -PLACES)
            kth = found.where(F.col("rank") == k).select("query_id", (F.sqrt(worst) + 1e-9).alias("reach"))
            rest = asked.join(kth, "query_id", "left").withColumn("near", F.slice("near", max(1, min(probes, self.n_lists)) + 1,
                                                                              F.greatest(F.size("near"), F.lit(1))))
            near = (rest.select("query_id", "q", "reach", F.inline("near")).join(F.broadcast(self.lists), "list")
                        .where(F.col("reach").isNull() | (F.col("d") - F.col("radius") <= F.col("reach"))))
            more = self._probe(near.groupBy("query_id", "q").agg(F.collect_list(F.struct("list", "d")).alias("near")), k, block)
            found = _best(found.drop("rank").union(more.drop("rank")), k)
        return found

    def probes_for(self, share: float = 0.95, k: int = 10, sample: int = 200, seed: int = 7) -> int:
        """How many lists to probe so that ``share`` of the true neighbours are
        in them: counted on about ``sample`` of the indexed rows, whose exact
        neighbours are searched for."""
        total = self.rows.count()
        part = F.lit(True) if total <= sample else (
            F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) < int((1 << 20) * sample / total))
        some = materialize(self.rows.where(part).select(F.col("id").alias("query_id"), "vec"))
        truth = self.search(some, "query_id", "vec", k, probes=1, exact=True)
        order = _nearest(some.groupBy("query_id").agg(F.min("vec").alias("vec")), self.centers, self.n_lists).select(
            "query_id", F.col("near.list").alias("order"))
        at = (truth.join(self.rows.select("id", "list"), "id").join(order, "query_id")
                   .groupBy(F.array_position("order", F.col("list")).cast("int").alias("at")).count().collect())
        need, seen = share * sum(r["count"] for r in at), 0
        for r in sorted(at):  # a row per list at most
            seen += r["count"]
            if seen >= need:
                return r["at"]
        return self.n_lists

    def _probe(self, asked: DataFrame, k: int, block: int) -> DataFrame:
        """The k best of the lists that each query names in ``near``."""
        each = asked.select("query_id", "q", F.explode("near.list").alias("list"))
        # queries per list are counted, so that no task gets more than about ``block``
        crowd = each.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        sized = F.broadcast(crowd.join(self.lists.select("list", "chunks"), "list"))  # n_lists rows at most
        dealt = each.join(sized, "list").select(
            "query_id", "q", "list", F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        held = self.rows.join(sized.select(F.col("list").alias("l"), "blocks"), F.col("list") == F.col("l")).select(
            "id", "vec", F.col("list").alias("of_list"), F.col("chunk").alias("of_chunk"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("of_block"))
        schema = T.StructType([T.StructField("query_id", asked.schema["query_id"].dataType),
                               T.StructField("id", self.rows.schema["id"].dataType), T.StructField("similarity", T.DoubleType())])
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return arrow.empty_table()
            sims = np.round(_matrix(left.column("q")) @ _matrix(right.column("vec")).T, PLACES)
            ids, asked_ids = right.column("id").combine_chunks(), left.column("query_id").combine_chunks()
            order = np.asarray(pc.sort_indices(ids))
            sims, ids = sims[:, order], ids.take(pa.array(order))  # equal similarities: ascending id
            own: dict = {}
            for i, v in enumerate(ids.to_pylist()):
                own.setdefault(v, []).append(i)
            for i, v in enumerate(asked_ids.to_pylist()):
                sims[i, own.get(v, [])] = -np.inf
            top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
            rows = np.repeat(np.arange(len(sims)), top.shape[1])
            cols = top.ravel()
            value = sims[rows, cols]
            ok = np.isfinite(value)
            return pa.table([asked_ids.take(pa.array(rows[ok])), ids.take(pa.array(cols[ok])), pa.array(value[ok])], schema=arrow)

        pairs = (dealt.groupBy("list", "chunk", "block").cogroup(held.groupBy("of_list", "of_chunk", "of_block"))
                      .applyInArrow(score, schema))
        return _best(pairs, k)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "id", "similarity", "rank")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


def _nearest(units: DataFrame, centers: np.ndarray, n: int, vec: str = "vec") -> DataFrame:
    """Rows with ``near``: the n nearest centroids (list, d), nearest first."""
    schema = T.StructType([*units.schema.fields, T.StructField("near", T.ArrayType(T.StructType([
        T.StructField("list", T.IntegerType()), T.StructField("d", T.DoubleType())])))])

    def run(batches):
        squares = (centers ** 2).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(pa.chunked_array([batch.column(batch.schema.names.index(vec))]))
            if centers.shape[1]:
                d = np.sqrt(np.maximum((m ** 2).sum(axis=1)[:, None] + squares - 2 * m @ centers.T, 0))
            else:
                d = np.zeros((len(m), 1))
            order = np.argsort(d, axis=1, kind="stable")[:, :n]
            near = [[{"list": int(c), "d": float(d[i, c])} for c in row] for i, row in enumerate(order)]
            kind = pa.list_(pa.struct([("list", pa.int32()), ("d", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, kind)], names=[*batch.schema.names, "near"])

    return units.mapInArrow(run, schema)


def recall(found: DataFrame, truth: DataFrame) -> Column:
    """Share of the true neighbours (query_id, id) that were found."""
    hit = truth.select("query_id", "id").join(found.select("query_id", "id"), ["query_id", "id"], "left_semi")
    return hit.agg(F.count(F.lit(1))).scalar() / truth.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
