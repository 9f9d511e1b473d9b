"""Near-duplicate embeddings by sorted projection passes.

Each pass orders the vectors of a label lexicographically by their concatenated random hashes (signs of random
projections of what is left of a unit vector once its label's mean is taken off, so that planes split a label evenly also
where its vectors share a direction) and compares each with its next neighbours in that order; the verified pairs of all
passes are united to components. Window and passes bound the search for what belongs together, not what is counted: inside
a component all pairs are then compared in blocks, so that links are counted whole, however many a vector has.

In a label whose mean has the squared length 1 - v, what is left of two vectors at cosine c has a cosine of about
r = 1 - (1 - c) / v, and they agree in a hash with probability a = 1 - acos(r) / pi. Of n vectors about n / 2 ** L share the
first L hashes, so a pass brings a pair into a window of w with probability a ** log2(n / w). Each label has as many passes
as it needs, so that a pair at the least cosine meets in no pass with probability MISS at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BITS, WINDOW, BLOCK = 32, 128, 256
#: Chance that a pair at the least cosine meets in no pass; least number of passes of a label beyond a window.
MISS, LEAST_PASSES = 1e-3, 8
#: Least cosine r that passes are counted for. Where a pair has less, any two vectors of the label are nearly or fully linked.
LEAST_LEFT = 0.3
#: Windows of a range of sorted rows, at least: ends of ranges see only one neighbouring range.
RANGE_WINDOWS = 16


def passes_for(n: Column, spread: Column, least: float, window: int = WINDOW, miss: float = MISS) -> Column:
    """Passes over a label of n vectors whose mean has the squared length 1 - spread."""
    left = F.greatest(F.lit(LEAST_LEFT), 1 - (1 - least) / spread)
    meet = F.pow(1 - F.acos(F.least(F.lit(1.0), left)) / math.pi, F.greatest(F.lit(0.0), F.log2(n / window)))
    return F.when(n <= window, 1).otherwise(F.greatest(F.lit(LEAST_PASSES), F.ceil(math.log(miss) / F.log1p(-F.least(meet, F.lit(1 - 1e-9)))))).cast("int")


def labels_of(one: DataFrame, least: float, window: int) -> DataFrame:
    """(label, dim, centre, passes): the mean of each label's unit vectors, and how many passes it needs."""
    top = F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))
    x = F.transform("vec", lambda x: x / F.col("top"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, y: s + y * y))
    unit = one.select("label", "dim", "vec", top.alias("top")).select("label", "dim", x.alias("x")).select("label", "dim", F.posexplode(F.transform("x", lambda y: y / length)).alias("pos", "y"))
    mean = unit.groupBy("label", "dim", "pos").agg(F.avg("y").alias("y"), F.count("*").alias("n"))
    out = mean.groupBy("label", "dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "y"))), lambda p: p["y"]).alias("centre"), F.max("n").alias("n"), F.sum(F.col("y") * F.col("y")).alias("shared"))
    return out.select("label", "dim", "centre", "n", passes_for(F.col("n"), F.greatest(1 - F.col("shared"), F.lit(1e-9)), least, window).alias("passes"))


def matrix(col: pa.Array) -> np.ndarray:
    """Unit vectors of a list column whose lists are equally long."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    x = col.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(col), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither vanish nor overflow
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def usable(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor empty and has only finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad)


def near_pairs(one: DataFrame, labels: DataFrame, least: float, bits: int, window: int, tables: common.Tables) -> DataFrame:
    """Verified pairs (a, b) of neighbours in some pass. one: rep, label, dim, vec; vec not null. labels: label, dim, centre, n, passes.

    Rows are dealt by range of (pass, label, dim, hashes). The rows at both ends of a range are compared across the border
    in a second, small step.
    """

    def hashed(batches):
        for b in batches:
            dims = common.column(b, "dim").to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                left = matrix(common.column(part, "vec")) - common.column(part, "centre").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                passes = common.column(part, "passes").to_numpy()
                sent = part.select(["rep", "label", "dim", "vec"])
                for p in range(int(passes.max())):
                    on = passes > p
                    planes = np.random.default_rng([p, int(dim)]).standard_normal((int(dim), bits))
                    sign = (left[on] @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)[::-1])
                    cols = [pa.array(np.full(len(sign), p, np.int32)), pa.array(sign, pa.int64()), *sent.filter(pa.array(on)).columns]
                    yield pa.record_batch(cols, ["pass", "hashes", *sent.schema.names])

    def compare(ids, x, group, border=None):
        forest = common.Forest()
        for off in range(1, min(window, len(ids) - 1) + 1):
            near = (np.einsum("ij,ij->i", x[:-off], x[off:]) >= least) & (group[:-off] == group[off:])
            if border is not None:
                near &= border[:-off] != border[off:]
            for i in np.flatnonzero(near).tolist():
                forest.link(int(ids[i]), int(ids[i + off]))
        return forest.kept

    def neighbours(batches):
        from pyspark import TaskContext

        at, tail, first = TaskContext.get().partitionId(), None, True
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]).select(names)
            t = t if tail is None else pa.concat_tables([tail, t])
            if first:
                first = False
                yield from ends(t.slice(0, window), at - 1, 1)
            yield from found(t)
            tail = t.slice(max(0, t.num_rows - window))
        if tail is not None:
            yield from ends(tail, at, 0)

    def found(t, border=None):
        dims = t.column("dim").to_numpy()
        group = np.unique(np.stack([t.column(n).to_numpy().astype(np.int64) for n in ("pass", "label", "dim")]), axis=1, return_inverse=True)[1].reshape(-1)
        for dim in np.unique(dims):
            mask = dims == dim
            part = t.filter(pa.array(mask))
            kept = compare(part.column("rep").to_numpy(), matrix(part.column("vec")), group[mask], None if border is None else border[mask])
            if kept:
                yield out(pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64()))

    def ends(t, border, side):
        n = t.num_rows
        t = t.combine_chunks()
        yield out(pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([border] * n, pa.int32()), pa.array([side] * n, pa.int32()), *[t.column(c).combine_chunks() for c in names])

    def out(a, b, *more):
        cols = [a, b, *(more or [pa.nulls(len(a), k) for k in (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float32()))])]
        return pa.record_batch(cols, ["a", "b", "border", "side", *names])

    names = ["pass", "hashes", "rep", "label", "dim", "vec"]
    order = ["pass", "label", "dim", "hashes", "rep"]
    schema = "pass int, hashes bigint, rep bigint, label int, dim int, vec array<float>"
    # a row a label, which Spark broadcasts if it is small, or else splits where one label has most vectors
    rows = one.select("rep", "label", "dim", "vec").join(labels.drop("n"), ["label", "dim"]).select("rep", "label", "dim", "vec", "centre", "passes").mapInArrow(hashed, schema)
    sorted_rows = labels.agg(F.sum(F.col("n") * F.col("passes"))).first()[0] or 0
    ranges = max(1, min(int(one.sparkSession.conf.get("spark.sql.shuffle.partitions")), sorted_rows // (window * RANGE_WINDOWS)))
    got = tables.write(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(neighbours, f"a bigint, b bigint, border int, side int, {schema}"))

    def across(batches):
        for g in common.sorted_groups(batches, ["border"]):
            t = pa.table({n: pa.array(list(g[n]), pa.list_(pa.float32())) if n == "vec" else pa.array(g[n]) for n in names})
            for r in found(t, g["side"]):
                yield r.select(["a", "b"])

    edge = got.where("a is null").select("border", "side", *names).repartition("border").sortWithinPartitions("border", *order)
    return got.where("a is not null").select("a", "b").union(edge.mapInArrow(across, "a bigint, b bigint"))


def link_counts(members: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Rows (rep, links): how many other vectors of its component a vector is linked with. members: component, n, rep, dim, mult, vec."""
    dealt = common.block_pairs(members, "n", block, F.xxhash64("rep")).select("component", "bi", "bj", "mine", "rep", "mult", "vec")

    def run(batches):
        for g in common.sorted_groups(batches, ["component", "bi", "bj"]):
            x = matrix(pa.array(list(g["vec"]), pa.list_(pa.float32())))
            same = g["bi"][0] == g["bj"][0]
            i = np.arange(len(x)) if same else np.flatnonzero(g["mine"] == g["bi"])
            j = i if same else np.flatnonzero(g["mine"] == g["bj"])
            near = x[i] @ x[j].T >= least
            if same:
                np.fill_diagonal(near, False)
                ids, n = g["rep"], near @ g["mult"]
            else:
                ids, n = np.concatenate([g["rep"][i], g["rep"][j]]), np.concatenate([near @ g["mult"][j], g["mult"][i] @ near])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["rep", "links"])

    counted = dealt.repartition("component", "bi", "bj").sortWithinPartitions("component", "bi", "bj").mapInArrow(run, "rep bigint, links bigint")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def classes(df: DataFrame, least: float = 0.93, passes: int | None = None, bits: int = BITS, window: int = WINDOW) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per input row (vec_id, embedding, label).

    Vectors are compared only under equal, non-null labels and equal lengths. A row whose vector is null, empty, zero or
    has a null or non-finite component, or whose label or vec_id is null, links with nothing and is its own component
    (kept is null where vec_id is). Equal vectors of a label are one vector with a multiplicity. Repeated rows count as
    vectors of their own; an empty table gives an empty result; other columns are not read. passes: by default as many for
    each label as its size and spread need.
    """
    spark = df.sparkSession
    tables = common.Tables(spark)
    rows = df.select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("vec"))
    good = usable(rows, "vec").where("vec_id is not null and label is not null and exists(vec, x -> x <> 0)")
    one = tables.write(good.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")).withColumn("dim", F.size("vec")))
    labels = labels_of(one, least, window)
    labels = tables.write(labels if passes is None else labels.withColumn("passes", F.lit(passes)))
    part = tables.write(common.components(spark, near_pairs(one, labels, least, bits, window, tables), tables))
    sizes = part.groupBy("component").agg(F.count("*").alias("n"))
    members = part.join(sizes, "component").withColumnRenamed("node", "rep").join(one, "rep")
    counts = link_counts(members, least)
    one = one.join(counts, "rep", "left").join(part.withColumnRenamed("node", "rep"), "rep", "left")
    one = tables.write(one.select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    mine = good.select("vec_id", "label", "vec").join(one, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    ok = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0), F.lit(False))
    rest = rows.where(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return mine.union(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
