"""Embedding near-dedup by NN-descent.

Only vectors with equal, non-null labels are compared, by cosine in double
precision.  Equal vectors are one node with a count.

1. First graph.  Every node is sorted by the sign codes of several sets of
   random hyperplanes (label first); in each order, blocks of consecutive nodes
   are compared and the best ``k`` of each node are kept.  Blocks are cut from
   range partitions, so no bucket can be large.  A label has as many orders as
   its nodes need: a pair at the threshold meets in one block of some order with
   probability ``1 - MISS`` or more, and no label has fewer than ``ORDERS``.
2. Descent.  Each node's list (neighbours and best reverse neighbours) is
   gathered with their vectors; all members are compared with each other,
   and pairs better than a member's worst neighbour are offered to it.  A
   list whose every neighbour reaches the threshold is saturated and doubles.
3. Audit.  Every node whose id is divisible by 100 is compared with all rows, in
   passes of bounded size; where these have fewer than ``AUDIT_LINKS`` links outside
   dense groups, so are further nodes outside them, until so many are seen or all are
   asked.  If ``MOST_AUDIT`` nodes have fewer, recall is unmeasured, and that is an
   error.  While the links found fall short of ``recall``, fresh orders and another
   round run; after ``most_rounds`` that is an error, never a result.
4. Threshold edges.  Pairs at or above the threshold are links.  A list with
   ``k`` or more links was saturated and may have dropped others; a pair that both
   ends dropped has two saturated ends.  Components with saturated nodes are
   therefore neighbours if the angle between their pivots (the saturated node with
   the least id) is within both radii and the threshold's angle, and neighbours are
   compared whole: their nodes are cut into blocks, every pair of blocks is
   compared in its own group, and only counts per node and the pairs of components
   that turn out to be linked leave the tasks.  Nothing is capped, and no pair list
   of a dense group exists.
5. Components by alternating stars, then once more over the pairs of step 4.

Defined results: rows whose vector is null, empty, zero, or holds null or
non-finite components, or whose label or id is null, link with nothing and
are their own component; vectors of different lengths are never linked; vectors
may be of any length; equal rows each get a row and count as links of each other, and so do rows with one id
and different vectors or labels (a component is named by the least id of its
rows); other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movrec.llm.common import arrow_map, running_before, settle
from movrec.llm.graph import components

THRESHOLD = 0.93
K, REVERSE, LARGEST = 8, 8, 64
ORDERS, BLOCK, CODE_BITS, MISS = 6, 128, 48, 0.005
ROUNDS, MOST_ROUNDS = 2, 8
AUDIT_LINKS, MOST_AUDIT, AUDIT_BATCH, RECALL = 300, 1 << 20, 8192, 0.99
#: a pair this near the threshold may be a link in one product and none in another
ROUNDING = 1e-9
CELL = 192


def vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, label, v`` (raw components as bytes, null if the row links with nothing)."""
    single = isinstance(rows.schema[vector].dataType.elementType, T.FloatType)
    kind = np.dtype("<f4" if single else "<f8")
    ids, labels = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column(2):
                flat = x.values
                if flat is None or not len(flat) or flat.null_count:
                    out.append(None)
                    continue
                v = flat.to_numpy().astype(kind)
                out.append(v.tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "v"])

    found = arrow_map(rows.select("vec_id", "label", vector), run, f"vec_id {ids}, label {labels}, v binary")
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    return found.withColumn("v", F.when(usable, F.col("v")))


def _unit(cells: list[bytes], single: bool) -> np.ndarray:
    m = np.frombuffer(b"".join(cells), "<f4" if single else "<f8").astype(np.float64).reshape(len(cells), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], ["u", "v", "sim"])


_EDGE = "u bigint, v bigint, sim double"


def _groups(batches, keys: tuple[int, ...], most: int | None = None):
    """Complete groups of equal key columns of sorted batches, as lists of columns (of at most ``most`` rows)."""
    now, held = None, None
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for row in zip(*cols):
            key = tuple(row[k] for k in keys)
            if key != now or (most and len(held) >= most):
                if held:
                    yield list(zip(*held))
                now, held = key, []
            held.append(row)
    if held:
        yield list(zip(*held))


def orders_needed(rows, threshold: float, least: int = ORDERS, block: int = BLOCK):
    """Orders in which a pair at the threshold, among ``rows`` nodes (a column), shares a block at least once but for ``MISS``."""
    agree = 1 - np.arccos(threshold) / np.pi  # one sign bit; about log2(rows / block) of them name a block
    p = F.pow(F.lit(float(agree)), F.greatest(F.lit(0.0), F.log2(rows / F.lit(block))))
    needed = F.ceil(F.lit(float(np.log(MISS))) / F.log1p(-p)).cast("int")
    return F.when(p > 1 - 1e-6, F.lit(least)).otherwise(F.greatest(F.lit(least), needed))


def first_graph(nodes: DataFrame, single: bool, k: int = K, threshold: float = THRESHOLD, orders: int = ORDERS, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """Edges ``u, v, sim`` to the best ``k`` neighbours inside blocks of each order; another ``seed`` gives other orders."""

    def codes(batches):
        planes: dict[tuple, np.ndarray] = {}
        for batch in batches:
            size, most = np.asarray(pa.compute.binary_length(batch.column(3))), batch.column(4).to_numpy()
            for n in np.unique(size):
                here = np.flatnonzero(size == n)
                x = _unit(batch.column(3).take(pa.array(here)).to_pylist(), single)
                for t in range(int(most[here].max())):
                    if (n, t) not in planes:
                        planes[n, t] = np.random.Generator(np.random.PCG64([17, seed, t])).normal(size=(x.shape[1], CODE_BITS))
                    taken = most[here] > t
                    part = batch.take(pa.array(here[taken]))
                    code = (x[taken] @ planes[n, t] > 0) @ (1 << np.arange(CODE_BITS, dtype=np.int64)[::-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), t, np.int32)), part.column(1), part.column(2), pa.array(code), part.column(0), part.column(3)],
                        ["t", "label", "size", "code", "id", "v"],
                    )

    label = nodes.schema["label"].dataType.simpleString()
    # only labels of some thousand nodes need more orders than the least
    large = nodes.groupBy("label", "size").count().withColumn("orders", orders_needed(F.col("count"), threshold, orders, block)).filter(F.col("orders") > orders)
    dealt = nodes.join(F.broadcast(large.drop("count")), ["label", "size"], "left").select("id", "label", "size", "v", F.coalesce("orders", F.lit(orders)).alias("orders"))
    coded = arrow_map(dealt, codes, f"t int, label {label}, size int, code bigint, id bigint, v binary")
    keys = ["t", "label", "size", "code", "id"]
    dealt = coded.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def best(batches):
        tail = None
        for t, lab, size, _, ids, cells in _groups(batches, (0, 1, 2), block):
            here = (t[0], lab[0], size[0])
            if tail is not None and tail[0] == here:  # half a block of overlap
                ids, cells = tail[1] + ids, tail[2] + cells
            tail = (here, ids[-block // 2 :], cells[-block // 2 :])
            if len(ids) < 2:
                continue
            x = _unit(list(cells), single)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            n = min(k, len(ids) - 1)
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            own, ids = np.repeat(np.arange(len(ids)), n), np.array(ids)
            yield _edges(ids[own], ids[top.ravel()], s[own, top.ravel()])

    return arrow_map(dealt, best, _EDGE)


def _lists(edges: DataFrame, size: DataFrame | None, k: int) -> DataFrame:
    """The best edges of every node: ``k``, or what ``size`` (u, room) says; ranked from 1."""
    distinct = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    if size is not None:
        distinct = distinct.join(size, "u", "left").withColumn("room", F.coalesce("room", F.lit(k)))
    else:
        distinct = distinct.withColumn("room", F.lit(k))
    ranked = distinct.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v")))
    return ranked.filter("rank <= room")


def descend(nodes: DataFrame, lists: DataFrame, single: bool, reverse: int = REVERSE) -> DataFrame:
    """Candidate edges from one join of neighbours with neighbours."""
    back = lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim")
    back = back.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))).filter(F.col("rank") <= reverse)
    around = lists.select("u", "v").union(back.select("u", "v")).union(lists.select("u", F.col("u").alias("v"))).distinct()
    worst = lists.groupBy("u").agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("n"), F.first("room").alias("room"))
    worst = worst.select(F.col("u").alias("id"), F.when(F.col("n") >= F.col("room"), F.col("worst")).otherwise(-2.0).alias("worst"))
    members = nodes.select("id", "v").join(worst, "id").select(F.col("id").alias("m"), F.col("v").alias("cell"), "worst")
    joined = around.withColumnRenamed("v", "m").join(members, "m").select("u", "m", "worst", "cell")
    dealt = joined.repartition("u").sortWithinPartitions("u", "m")

    def compare(batches):
        for _, m, worst, cells in _groups(batches, (0,)):
            if len(m) < 2:
                continue
            x = _unit(list(cells), single)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            a, b = np.nonzero(s > np.array(worst)[:, None])
            ids = np.array(m)
            if len(a):
                yield _edges(ids[a], ids[b], s[a, b])

    return arrow_map(dealt, compare, _EDGE)


def audit(
    placed: DataFrame, lists: DataFrame, single: bool, threshold: float,
    links: int = AUDIT_LINKS, most: int = MOST_AUDIT, batch: int = AUDIT_BATCH,
) -> float:
    """Share of the true links of the asked nodes that stand in the graph; the lesser of all links and those outside dense groups.

    ``placed`` are the nodes with ``dense``, the group of components that is compared
    whole (null outside).  A link inside a group will be counted; any other must be held
    in a list.  Every node whose id is divisible by 100 is asked against all rows, in
    passes of about ``batch`` nodes.  If they have fewer than ``links`` links outside
    dense groups, further loose nodes are asked, until those links are seen, all loose
    nodes are asked, or ``most`` are.  Fewer links than that are then no measurement:
    ``RuntimeError``, unless neither the asked nodes nor the lists have any.
    """
    every = placed.filter("id % 100 = 0")
    seen = [_judge(placed, part, lists, single, threshold) for part in _passes(every, batch)]
    true, hit, loose_true, loose_hit = (sum(s[i] for s in seen) for i in range(4))
    share = hit / true if true else 1.0
    rest = placed.filter("dense is null and id % 100 <> 0")
    done, size = every.filter("dense is null").count(), rest.count()
    whole = done + size
    parts = _passes(rest, batch, size)
    while loose_true < links and parts and done < most:
        part = parts.pop()
        done += part.count()
        _, _, t, h = _judge(placed, part, lists, single, threshold)
        loose_true, loose_hit = loose_true + t, loose_hit + h
    if loose_true < links and done < whole:
        held = lists.filter(F.col("sim") >= threshold).join(placed.filter("dense is null").select(F.col("id").alias("u")), "u", "left_semi")
        if loose_true or not held.isEmpty():
            raise RuntimeError(f"recall is unmeasured: {done} of {whole} nodes have {loose_true} links, {links} are asked for")
    return min(share, loose_hit / loose_true if loose_true else 1.0)


def _passes(rows: DataFrame, batch: int, size: int | None = None) -> list[DataFrame]:
    """``rows`` cut by a hash of ``id`` into parts of about ``batch`` rows."""
    n = -(-(rows.count() if size is None else size) // batch)
    return [rows.filter(F.pmod(F.xxhash64(F.lit("audit"), "id"), F.lit(n)) == i) for i in range(n)]


def _judge(placed: DataFrame, rows: DataFrame, lists: DataFrame, single: bool, threshold: float) -> tuple[int, int, int, int]:
    """True links of the few ``rows`` to any of ``placed`` and how many of them stand in the graph; the same of rows outside dense groups."""
    asked = rows.select("id", "label", "size", "v", "dense").collect()
    if not asked:
        return 0, 0, 0, 0
    loose = placed.sparkSession.createDataFrame([(r["id"],) for r in asked if r["dense"] is None], "u bigint").withColumn("loose", F.lit(True))
    threshold += ROUNDING
    shared = placed.sparkSession.sparkContext.broadcast([tuple(r) for r in asked])

    def run(batches):
        known: dict[tuple, list] = {}
        for q, lab, size, v, dense in shared.value:
            known.setdefault((lab, size), []).append((q, bytes(v), dense))
        units = {k: (np.array([r[0] for r in q]), _unit([r[1] for r in q], single), *_group([r[2] for r in q])) for k, q in known.items()}
        for batch in batches:
            ids, labels, sizes, cells, groups = (c.to_pylist() for c in batch.columns)
            parts: dict[tuple, list] = {}
            for i, key in enumerate(zip(labels, sizes)):
                if key in units:
                    parts.setdefault(key, []).append(i)
            for key, rows in parts.items():
                q, x, own, inside = units[key]
                for at in range(0, len(rows), CELL):
                    here = rows[at : at + CELL]
                    a, b = np.nonzero(x @ _unit([cells[i] for i in here], single).T >= threshold)
                    v, (group, _) = np.array([ids[i] for i in here]), _group([groups[i] for i in here])
                    a, b = a[q[a] != v[b]], b[q[a] != v[b]]
                    counted = inside[a] & (own[a] == group[b])
                    a, b, n = a[~counted], b[~counted], int(counted.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([*q[a].tolist(), None], pa.int64()), pa.array([*v[b].tolist(), None], pa.int64()), pa.array([*[1] * len(a), n], pa.int64())],
                        ["u", "v", "n"],
                    )

    true = arrow_map(placed.select("id", "label", "size", "v", "dense"), run, "u bigint, v bigint, n bigint")
    held = lists.select("u", "v").union(lists.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct().withColumn("held", F.lit(1))
    stands = F.col("u").isNull() | F.col("held").isNotNull()
    marked = true.filter("n > 0").join(held, ["u", "v"], "left").join(F.broadcast(loose), "u", "left")
    sums = [F.sum("n"), F.sum(F.when(stands, F.col("n"))), F.sum(F.when(F.col("loose"), F.col("n"))), F.sum(F.when(stands & F.col("loose"), F.col("n")))]
    return tuple(x or 0 for x in marked.agg(*[x.alias(f"n{i}") for i, x in enumerate(sums)]).first())


def _group(groups: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
    """The groups with 0 for none, and where there is one."""
    return np.array([g or 0 for g in groups], np.int64), np.array([g is not None for g in groups], bool)


def _paired(rows: DataFrame, by: list[str], cell: int) -> DataFrame:
    """``rows`` cut into blocks by hash of ``id`` within ``by``, and dealt so that each pair of blocks (i, j) is one group."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("blocks"))
    cut = rows.join(settle(sizes), by).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "other")
    return cut.repartition(*by, "i", "j").sortWithinPartitions(*by, "i", "j", "own", "id")


def dense_neighbours(full: DataFrame, single: bool, threshold: float, cell: int = CELL) -> DataFrame:
    """``id, dense``: groups of components whose saturated nodes ``full`` (component, id, label, size, v) may be linked.

    Components that no other can reach are missing.  By the triangle inequality of
    angles no link joins saturated nodes of different groups.
    """
    pivots = settle(full.groupBy("component").agg(F.min_by(F.struct("label", "size", "v"), "id").alias("p")).select("component", "p.*"))

    def reach(batches):
        for batch in batches:
            component, sizes, cells, centres = batch.column(0), *(c.to_pylist() for c in batch.columns[1:])
            angle = np.zeros(len(sizes))
            for n in set(sizes):
                here = [i for i, size in enumerate(sizes) if size == n]
                x, y = (_unit([w[i] for i in here], single) for w in (cells, centres))
                angle[here] = np.arccos(np.clip((x * y).sum(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([component, pa.array(angle)], ["component", "angle"])

    both = full.select("component", "size", "v").join(pivots.select("component", F.col("v").alias("pivot")), "component")
    radius = arrow_map(both, reach, "component bigint, angle double").groupBy("component").agg(F.max("angle").alias("radius"))
    balls = settle(pivots.join(radius, "component").select("label", "size", F.col("component").alias("id"), "radius", "v"))
    dealt = _paired(balls, ["label", "size"], cell).select("label", "size", "i", "j", "id", "radius", "v")
    spread = float(np.arccos(threshold)) + 1e-6

    def near(batches):
        for _, _, _, _, ids, radius, cells in _groups(batches, (0, 1, 2, 3)):
            x, r = _unit(list(cells), single), np.array(radius)
            met = np.arccos(np.clip(x @ x.T, -1, 1)) <= r[:, None] + r[None, :] + spread
            least, before = np.arange(len(r)), None
            while before is None or (least != before).any():  # the least member of each connected part
                before, least = least, np.where(met, least[None, :], len(r)).min(axis=1)
            far = least != np.arange(len(r))
            if far.any():
                ids = np.array(ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[least[far]])], ["u", "v"])

    met = settle(arrow_map(dealt, near, "u bigint, v bigint").distinct())
    return components(met).select("id", F.col("component").alias("dense"))


def dense_counts(members: DataFrame, single: bool, threshold: float, cell: int = CELL) -> DataFrame:
    """``id, links`` and ``id, joins`` of the dense groups in ``members`` (dense, component, id, size, copies, v).

    ``links`` are linked rows of a node and ``joins`` a component to which component ``id`` is linked.
    A group is cut into blocks by hash; each pair of blocks is compared by itself.
    """
    dealt = _paired(members, ["dense"], cell).select("dense", "i", "j", "own", "id", "size", "copies", "v", "component")

    def run(batches):
        for _, i, j, own, ids, size, copies, cells, parts in _groups(batches, (0, 1, 2)):
            own, size, copies, ids, parts = np.array(own), np.array(size), np.array(copies), np.array(ids), np.array(parts)
            for n in np.unique(size):
                here = np.flatnonzero(size == n)
                a = here if i[0] == j[0] else here[own[here] == i[0]]
                b = here if i[0] == j[0] else here[own[here] == j[0]]
                if not len(a) or not len(b):
                    continue
                x, y = (_unit([cells[t] for t in w], single) for w in (a, b))
                near = x @ y.T >= threshold
                if i[0] == j[0]:
                    np.fill_diagonal(near, False)
                    yield _counts(ids[a], near @ copies[b])
                else:
                    yield _counts(ids[a], near @ copies[b])
                    yield _counts(ids[b], near.T @ copies[a])
                across = near & (parts[a][:, None] != parts[b][None, :])
                if across.any():
                    s, t = np.nonzero(across)
                    joined = np.unique(np.stack([parts[a][s], parts[b][t]]), axis=1)
                    yield _counts(joined[0], np.zeros(joined.shape[1]), joined[1])

    found = arrow_map(dealt, run, "id bigint, links bigint, joins bigint")
    return found.groupBy("id", "joins").agg(F.sum("links").alias("links"))


def _counts(ids, links, joins=None) -> pa.RecordBatch:
    joins = pa.nulls(len(ids), pa.int64()) if joins is None else pa.array(joins, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(links.astype(np.int64)), joins], ["id", "links", "joins"])


def dense_groups(nodes: DataFrame, lists: DataFrame, single: bool, threshold: float, k: int) -> tuple[DataFrame, DataFrame]:
    """The links of the lists, both ways, and the nodes with ``component`` and ``dense`` (null: all its links are held)."""
    links = lists.filter(F.col("sim") >= threshold)
    full = links.groupBy("u").count().filter(F.col("count") >= k).select(F.col("u").alias("id"))
    edges = settle(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    comp = settle(components(edges))
    saturated = settle(comp.join(full, "id").join(nodes.select("id", "label", "size", "v"), "id").select("component", "id", "label", "size", "v"))
    groups = dense_neighbours(saturated, single, threshold).withColumnRenamed("id", "component")
    dense = saturated.select("component").distinct().join(groups, "component", "left")
    dense = settle(dense.select("component", F.coalesce("dense", "component").alias("dense")))
    return edges, settle(nodes.join(comp, "id", "left").join(dense, "component", "left"))


def numbered_nodes(usable: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``label, size, v, id, copies``: one row for each different vector with a number of its own, and the numbers' names.

    A node's name is the least id of its rows.  It is the number too (then there
    are no names), unless one id stands for several nodes; then numbers follow the
    order of (name, vector), as running sums over range partitions, so that the
    least number of a component still has its least name.
    """
    nodes = settle(usable.groupBy("label", "size", "v").agg(F.min("vec_id").cast("bigint").alias("id"), F.count(F.lit(1)).alias("copies")))
    if nodes.groupBy("id").count().filter("count > 1").isEmpty():
        return nodes, None
    placed = nodes.withColumnRenamed("id", "name").withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1))
    numbered = running_before(placed, "_all", ["name", "label", "size", "v"], "_one", "id").withColumn("id", F.col("id").cast("bigint"))
    numbered = settle(numbered)
    return numbered.select("label", "size", "v", "id", "copies"), numbered.select("id", "name")


def near_duplicates(
    rows: DataFrame, vector: str = "embedding", threshold: float = THRESHOLD, k: int = K, rounds: int = ROUNDS,
    most_rounds: int = MOST_ROUNDS, largest: int = LARGEST, recall: float = RECALL,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows`` (vec_id, label, vector).

    Raises ``RuntimeError`` if the audit still falls short of ``recall`` after ``most_rounds``.
    """
    single = isinstance(rows.schema[vector].dataType.elementType, T.FloatType)
    all_rows = settle(vectors(rows, vector))
    usable = all_rows.filter(F.col("v").isNotNull()).withColumn("size", F.octet_length("v"))
    nodes, names = numbered_nodes(usable)
    found = first_graph(nodes, single, k, threshold)
    lists = settle(_lists(found, None, k))
    done = 0
    while True:
        fresh = None
        if done >= rounds:
            edges, placed = dense_groups(nodes, lists, single, threshold, k)
            share = audit(placed, lists, single, threshold)
            if share >= recall:
                break
            if done >= most_rounds:
                raise RuntimeError(f"{share:.4f} of the audited links found after {done} rounds; {recall} are asked for")
            fresh = first_graph(nodes, single, k, threshold, seed=done)
        room = lists.groupBy("u").agg(F.first("room").alias("room"), F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst"))
        grown = F.when((F.col("n") >= F.col("room")) & (F.col("worst") >= threshold), F.least(F.col("room") * 2, F.lit(largest))).otherwise(F.col("room"))
        size = settle(room.select("u", grown.alias("room")))
        offers = descend(nodes, lists.drop("room").join(size, "u"), single)
        offers = offers.unionByName(fresh) if fresh is not None else offers
        lists = settle(_lists(lists.select("u", "v", "sim").unionByName(offers), size, k))
        done += 1
    counted = settle(dense_counts(placed.filter("dense is not null"), single, threshold))
    joins = components(counted.filter("joins is not null"), "id", "joins").select(F.col("id").alias("was"), F.col("component").alias("now"))
    counted = counted.filter("joins is null").select("id", "links")
    sparse = edges.join(placed.filter("dense is null").select(F.col("id").alias("u")), "u")
    counted = counted.union(sparse.join(nodes.select(F.col("id").alias("v"), "copies"), "v").groupBy("u").agg(F.sum("copies").alias("links")))
    counted = counted.withColumnRenamed("id", "cid")
    result = (
        placed.join(counted, placed.id == counted.cid, "left").join(joins, F.col("component") == F.col("was"), "left")
        .select("label", "size", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("now", "component", "id").alias("component_id"))
    )
    result = settle(result)
    if names is not None:
        named = result.join(names, F.col("component_id") == F.col("id"))
        result = named.select("label", "size", "v", "n_links", F.col("name").alias("component_id"))
    linked = usable.join(result, ["label", "size", "v"]).select("vec_id", "n_links", "component_id")
    alone = all_rows.filter(F.col("v").isNull()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).withColumn("kept", kept)
