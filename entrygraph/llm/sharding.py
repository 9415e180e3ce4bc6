"""Resharding by minimum-cost flow.

Documents lie in old shards; the new shards have capacities. The cheapest flow
from old sizes to new capacities, where bytes that stay cost nothing and bytes
that move cost one each, says how many bytes go from which shard to which.
Rows of equal texts are a group and go to one shard together, wherever they lay
before. Groups of more than a SHARE-th of a shard, of which there are few, are
placed first, the largest first, each whole: where most of its bytes lie if that
shard has room, else where most room is. The flow fills what room is left. Only
a group that is larger than a shard is split, its rows being placed one by one.

Groups are laid in blocks by a hash, the rows of large ones by a number drawn
for the row, so that running sums are taken within a block and none is large.
There are a fixed number of blocks to an old shard (more only where a block
would hold more than BLOCK_BYTES, and at most BLOCKS in all), and the driver
sees one row a block; the flow is then cut out of each old shard's blocks in
their order.

Defined cases: a null text has size 16 and the checksum of nothing, and is equal
to other null and empty texts; a null doc_id is like any other; repeated rows are
of one group, with slots of their own; an empty table gives an empty result;
other columns are carried, whatever their names, but for those named like the
result's (size, old_shard, shard, slot); groups of equal size are placed in the
order of their hashes.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.llm.common import staged, text_or_empty

OVERHEAD = 16
#: Columns of the result.
RESULT = ("size", "old_shard", "shard", "slot")
#: Bytes that a block is to hold at most, on average, as long as there are no more than BLOCKS.
BLOCK_BYTES, BLOCKS = 128 << 20, 100_000
#: Groups of more than this part of a shard's bytes are placed one by one, on the driver: fewer than SHARE to a shard.
SHARE = 32


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Amounts by (from, to) that ship all of ``supply`` within ``capacity`` at least total ``cost(i, j)`` a unit.

    Successive shortest augmenting paths with potentials on the bipartite
    network; the graphs here have a node for each old and new shard only.
    """
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    edges: list[list] = []  # to, rest, cost
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def add(a: int, b: int, most: int, price: int) -> None:
        out[a].append(len(edges))
        edges.append([b, most, price])
        out[b].append(len(edges))
        edges.append([a, 0, -price])

    for i, s in enumerate(supply):
        add(source, i, s, 0)
    for j, c in enumerate(capacity):
        add(n + j, sink, c, 0)
    begin = len(edges)
    for i in range(n):
        for j in range(m):
            add(i, n + j, sum(supply), cost(i, j))
    lift = [0] * (n + m + 2)
    left = sum(supply)
    if sum(capacity) < left:
        raise ValueError("capacities hold less than there is")
    while left:
        far = [float("inf")] * (n + m + 2)
        by = [-1] * (n + m + 2)
        far[source] = 0
        heap = [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in out[a]:
                b, rest, price = edges[e]
                if rest and (x := d + price + lift[a] - lift[b]) < far[b]:
                    far[b], by[b] = x, e
                    heapq.heappush(heap, (x, b))
        for a, d in enumerate(far):
            if d < float("inf"):
                lift[a] += d
        push, a = left, sink
        while a != source:
            push = min(push, edges[by[a]][1])
            a = edges[by[a] ^ 1][0]
        a = sink
        while a != source:
            edges[by[a]][1] -= push
            edges[by[a] ^ 1][1] += push
            a = edges[by[a] ^ 1][0]
        left -= push
    flow = {}
    for k in range(begin, len(edges), 2):
        if got := edges[k + 1][1]:
            i, j = divmod((k - begin) // 2, m)
            flow[i, j] = got
    return flow


def size_of(text: Column) -> Column:
    return (F.octet_length(text_or_empty(text)) + OVERHEAD).cast("long")


def reshard(docs: DataFrame, old: int, new: int) -> DataFrame:
    """``docs`` with size, old_shard, shard and slot: sizes of the ``new`` shards are near equal.

    The old shard of a document is the hash of its text modulo ``old``; with
    a real layout, pass the rows with their own assignment to ``transfer``.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    placed = docs.select(row, size_of(F.col("text")).alias("size"), F.xxhash64(text_or_empty(F.col("text"))).alias("group"))
    done = transfer(placed.withColumn("old_shard", F.pmod("group", F.lit(old)).cast("int")), old, new)
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in RESULT], *RESULT)


def _placed_whole(groups: list[tuple[int, int, int]], capacity: list[int]) -> tuple[list[tuple[int, int]], list[int]]:
    """(group, shard) for groups (hash, bytes, home) in the order given, and the room that is left in each shard."""
    room, out = list(capacity), []
    for group, size, home in groups:
        to = home if home < len(room) and room[home] >= size else max(range(len(room)), key=room.__getitem__)
        room[to] -= size
        out.append((group, to))
    return out, [max(0, r) for r in room]


def transfer(placed: DataFrame, old: int, new: int) -> DataFrame:
    """Plan and apply the moves for rows that have old_shard, group and size.

    A group lies where most of its bytes lay, and is placed by its middle byte;
    each new shard takes the stretch of bytes the flow gives it. Sizes differ
    from equal by less than two small groups for each stretch, where the large
    ones leave room for that.
    """
    spark = placed.sparkSession
    names = placed.columns
    others = F.struct(*[placed[f"`{c}`"].alias(c) for c in names if c not in ("group", *RESULT)]).alias("_row") if set(names) - {"group", *RESULT} else F.struct(F.lit(0)).alias("_row")
    placed = staged(placed.select("old_shard", "group", "size", others, F.xxhash64(F.monotonically_increasing_id()).alias("_draw")))
    whole, rows = placed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    blocks = int(max(8, min(-(-whole // (BLOCK_BYTES * old)), BLOCKS // old)))
    most = max(1, whole // (new * SHARE))
    each = placed.groupBy("group", "old_shard").agg(F.sum("size").alias("_b"))
    groups = staged(each.groupBy("group").agg(F.sum("_b").alias("_bytes"), F.max_by("old_shard", F.struct("_b", -F.col("old_shard"))).alias("_home")))
    capacity = [whole * (j + 1) // new - whole * j // new for j in range(new)]
    # fewer than SHARE * new groups are large, and fewer than new are larger than a shard
    fit = groups.filter((F.col("_bytes") > most) & (F.col("_bytes") <= whole // new)).orderBy(F.desc("_bytes"), "group").collect()
    assigned, capacity = _placed_whole([(r.group, r._bytes, r._home) for r in fit], capacity)
    large = F.broadcast(groups.filter(F.col("_bytes") > F.greatest(F.lit(most), F.lit(whole // new))).select("group", F.lit(True).alias("_large")))
    laid = placed.join(large, "group", "left").withColumn("_key", F.when(F.col("_large"), F.col("_draw")).otherwise(F.col("group")))
    units = laid.filter("_large").select("_key", "old_shard", "size").unionByName(groups.filter(F.col("_bytes") <= most).select(F.col("group").alias("_key"), F.col("_home").alias("old_shard"), F.col("_bytes").alias("size")))
    units = units.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "_key"), F.lit(blocks)).cast("int"))
    units = staged(units.groupBy("old_shard", "block", "_key").agg(F.sum("size").alias("bytes")))
    totals = units.groupBy("old_shard", "block").agg(F.sum("bytes").alias("bytes")).orderBy("old_shard", "block").collect()  # at most BLOCKS
    supply = [0] * old
    begin = []
    for r in totals:
        begin.append((r.old_shard, r.block, supply[r.old_shard]))
        supply[r.old_shard] += r.bytes
    flow = min_cost_flow(supply, capacity, lambda i, j: int(i != j))
    # stretches of each old shard: what stays comes first
    cuts: dict[int, list[tuple[int, int]]] = {i: [] for i in range(old)}
    at = [0] * old
    for (i, j), n in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        at[i] += n
        cuts[i].append((at[i], j))
    starts = spark.createDataFrame(begin, "old_shard int, block int, begin long")
    table = spark.createDataFrame([(i, [c for c, _ in cuts[i]], [j for _, j in cuts[i]]) for i in range(old)], "old_shard int, upto array<long>, takers array<int>")
    running = Window.partitionBy("old_shard", "block").orderBy("_key")
    middle = F.col("begin") + F.sum("bytes").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.floor((F.col("bytes") + 1) / 2)
    # both sides have a row a block or an old shard
    known = units.join(F.broadcast(starts), ["old_shard", "block"]).withColumn("_middle", middle).join(F.broadcast(table), "old_shard")
    taken = F.expr("size(filter(upto, c -> c <= _middle))")
    chosen = known.select("_key", F.get(F.col("takers"), F.least(taken, F.size("takers") - 1)).alias("shard"))
    takers = staged(chosen.unionByName(spark.createDataFrame(assigned, "_key long, shard int")))
    # a key has a group's rows, which fit a shard, or one
    known = laid.join(takers, "_key")
    spread = F.pmod(F.xxhash64("_draw"), F.lit(max(1, min(rows // 20_000, BLOCKS // new)))).cast("int")
    within = Window.partitionBy("shard", "_part").orderBy("_draw")
    known = staged(known.withColumn("_part", spread).withColumn("_rank", F.row_number().over(within).cast("long") - 1).drop("_key", "_large"))
    counts = known.groupBy("shard", "_part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_first", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")  # at most BLOCKS rows
    done = known.join(F.broadcast(offsets), ["shard", "_part"]).withColumn("slot", F.col("_first") + F.col("_rank"))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in names if c not in ("group", *RESULT)], "group", *RESULT)


def write_shards(resharded: DataFrame, path: str, new: int, only_changed: bool = True) -> None:
    """Rewrite the shards' files under ``path``, as folders shard=0 to ``new`` - 1; folders beyond and empty shards go.

    With only_changed, shards that lose or gain no row stay as they are. What is
    written is read from ``resharded``'s own staged table, never from ``path``.
    """
    spark = resharded.sparkSession
    rows = staged(resharded)
    fresh = rows
    if only_changed:
        changed = rows.filter("shard <> old_shard").selectExpr("explode(array(shard, old_shard)) as shard").distinct()
        fresh = rows.join(F.broadcast(changed), "shard", "left_semi")
    fresh.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    there = {r.shard for r in rows.select("shard").distinct().collect()}  # at most ``new``
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder) if files.exists(folder) else []:
        name = status.getPath().getName()
        if name.startswith("shard=") and (int(name[6:]) >= new or int(name[6:]) not in there):
            files.delete(status.getPath(), True)
