"""Clustering by a pair predicate: edges, then connected components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from presslens.functions.text import normalise_name, sorted_tokens
from presslens.operators.fuzzy import match_names
from presslens.sources.storage import cut_estimates, cut_lineage


def edges_same_key(df: DataFrame, node: str, key: Column) -> DataFrame:
    """Equality predicate: each member is tied to the smallest member of its key, so a key
    with n members costs n edges, not n squared."""
    keyed = df.select(F.col(node).alias("src"), key.alias("_key")).filter("_key is not null")
    smallest = keyed.groupBy("_key").agg(F.min("src").alias("dst"))
    return keyed.join(smallest, "_key").filter("src != dst").select("src", "dst")


def edges_within(df: DataFrame, node: str, value: str, distance: float, block: list[str]) -> DataFrame:
    """|x - y| <= distance inside a block, as edges with the same components as all pairs.

    The value line is cut into cells of half the distance. Members of a cell belong
    together and are tied to its smallest node; two cells belong together exactly if the
    largest value of the lower and the smallest of the upper one are close enough, which
    only the next three cells can be. Every step is a grouped aggregate or an equi-join.
    """
    if distance <= 0:
        raise ValueError("distance must be positive; use edges_same_key for equality")
    points = df.select(*block, F.col(node).alias("src"), F.col(value).alias("_x")).na.drop()
    points = points.withColumn("_cell", F.floor(F.col("_x") / (distance / 2)))
    cells = points.groupBy(*block, "_cell").agg(
        F.min("src").alias("dst"), F.min("_x").alias("_low"), F.max("_x").alias("_high")
    )
    members = points.join(cells, [*block, "_cell"]).filter("src != dst").select("src", "dst")
    upper = cells.select(
        *block,
        F.explode(F.array(*(F.col("_cell") - i for i in (1, 2, 3)))).alias("_cell"),
        F.col("dst").alias("src"),
        F.col("_low").alias("_next_low"),
    )
    steps = cells.select(*block, "_cell", "dst", "_high").join(upper, [*block, "_cell"])
    near = steps.filter(F.col("_next_low") - F.col("_high") <= distance)
    return members.unionByName(near.select("src", "dst"))


def edges_fuzzy(df: DataFrame, node: str, name: str, threshold: float = 90) -> DataFrame:
    """Token-sort ratio >= threshold between names, through their distinct texts."""
    keyed = df.select(
        F.col(node).alias("src"), sorted_tokens(normalise_name(F.col(name))).alias("_name")
    ).filter("_name != ''")
    holders = keyed.groupBy("_name").agg(F.min("src").alias("dst"))
    ties = keyed.join(holders, "_name").filter("src != dst").select("src", "dst")
    names = holders.select(F.col("_name").alias("name"))
    matches = match_names(names, None, threshold).filter("a != b")
    near = (
        matches.join(holders.select(F.col("_name").alias("a"), F.col("dst").alias("src")), "a")
        .join(holders.select(F.col("_name").alias("b"), "dst"), "b")
        .select("src", "dst")
    )
    return ties.unionByName(near)


def edges_by_predicate(
    df: DataFrame,
    node: str,
    predicate,
    block: list[str],
    chunk: int = 2048,
    order: str | None = None,
) -> DataFrame:
    """Any predicate `f(a, b) -> Column` over pairs that share a block (a candidate key).

    Every pair of a block is tested, which grows with its square. A block is cut into chunks
    of about `chunk` rows, and each pair of chunks is a join key of its own, so one large
    block spreads over many tasks.

    `order` names a numeric column for predicates that read no other column, are symmetric and whose
    links leave nothing out between them: if finite values x <= y <= z and x and z pass, so do x and y,
    and y and z. Then neighbours in that order decide, and the edges, with the same components as
    all pairs, grow with the rows.
    """
    if not block:
        raise ValueError("a candidate key is needed")
    if order is not None:
        return _edges_in_order(df, node, predicate, block, order)
    sizes = df.groupBy(*block).agg(F.ceil(F.count("*") / chunk).cast("int").alias("_chunks"))
    sizes = sizes.toDF(*(f"_b{i}" for i in range(len(block))), "_chunks")
    known = [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(block)]
    placed = df.join(sizes, known).drop(*(f"_b{i}" for i in range(len(block))))
    own = F.pmod(F.xxhash64(node), F.col("_chunks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    a = placed.withColumn("_i", own).withColumn("_j", every).alias("a")
    b = placed.withColumn("_j", own).withColumn("_i", every).alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in block]
    same += [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_i", "_j")]
    condition = predicate(lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}"))
    for test in same:
        condition = test & condition
    pairs = a.join(b, condition & (F.col(f"a.{node}") < F.col(f"b.{node}")))
    return pairs.select(F.col(f"a.{node}").alias("src"), F.col(f"b.{node}").alias("dst"))


def _edges_in_order(df: DataFrame, node: str, predicate, block: list[str], order: str) -> DataFrame:
    """edges_by_predicate through the distinct values of a block.

    Values are dealt over tasks by ranges, and a task cuts its values into runs of neighbours that pass. The last
    run of a block in one task and the first one of the next task that has any belong to one chain if they pass.
    Rows are tied to the smallest node of their run and this to the smallest one of its chain, so edges are two
    steps deep, however long a chain of values is. Null, NaN and the infinities keep to no order and are tested
    against all values. Rows of a value that passes with itself or with another one belong together.
    """
    if not isinstance(df.schema[order].dataType, NumericType):
        raise ValueError(f"{order} must be a number")
    names = [f"_b{i}" for i in range(len(block))]
    rows = df.select(*(F.col(c).alias(b) for c, b in zip(block, names)), F.col(node).alias("_node"), F.col(order).alias("_x"))
    rows = rows.filter("_node is not null")

    def passes(x: str, y: str) -> Column:
        of = lambda value: lambda c: F.col({order: value}[c])
        return F.coalesce(predicate(of(x), of(y)) | predicate(of(y), of(x)), F.lit(False))

    values = rows.groupBy(*names, "_x").agg(F.min("_node").alias("_low"))
    values = values.repartitionByRange(*names, "_x").withColumn("_part", F.spark_partition_id())
    values = cut_lineage(values)
    x = F.col("_x").cast("double")
    finite = F.coalesce(F.abs(x) < float("inf"), F.lit(False))
    ordered, loose = values.filter(finite), values.filter(~finite)

    line = Window.partitionBy(*names, "_part").orderBy("_x")
    points = ordered.withColumn("_y", F.lag("_x").over(line))
    points = points.withColumn("_cut", (F.col("_y").isNull() | ~passes("_y", "_x")).cast("int"))
    points = points.withColumn("_run", F.sum("_cut").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*names, "_part", "_run")
    points = points.withColumns({"_least": F.min("_low").over(run), "_size": F.count("*").over(run)})

    ends = points.groupBy(*names, "_part").agg(
        F.min("_x").alias("_first"), F.min_by("_least", "_run").alias("_first_least"),
        F.max("_x").alias("_last"), F.max_by("_least", "_run").alias("_last_least"), F.max("_run").alias("_runs"),
    )
    parts = Window.partitionBy(*names).orderBy("_part")
    ends = ends.withColumns({"_y": F.lag("_last").over(parts), "_several": (F.col("_runs") > 1).cast("int")})
    ends = ends.withColumn("_cut", (F.col("_y").isNull() | ~passes("_y", "_first")).cast("int"))
    # Cuts between tasks and inside them, up to a run, number its chain.
    cuts = F.sum(F.col("_cut") + F.col("_several")).over(parts.rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("_cuts", cuts)

    def side(number: Column, value: str, least: str) -> Column:
        return F.struct(number.alias("_chain"), F.col(value).alias("_x"), F.col(least).alias("_via"))

    first = side(F.col("_cuts") - F.col("_several"), "_first", "_first_least")
    last = side(F.col("_cuts"), "_last", "_last_least")
    sides = ends.select(*names, F.inline(F.when(F.col("_several") == 1, F.array(first, last)).otherwise(F.array(first))))
    chain = Window.partitionBy(*names, "_chain")
    chains = sides.withColumns({"_least": F.min("_via").over(chain), "_size": F.count("*").over(chain)}).filter("_size > 1")

    tied = points.filter((F.col("_size") > 1) | passes("_x", "_x")).select(*names, "_x", "_least", "_least")
    tied = tied.union(chains.select(*names, "_x", "_via", "_least"))
    if not loose.isEmpty():
        tied = tied.union(_loose_ties(values, loose, names, passes))
    tied = tied.toDF(*(f"_o{b}" for b in names), "_y", "_via", "_least")
    joined = rows.join(tied, _same_value(names))
    ties = [F.struct(F.col(c).alias("src"), F.col("_least").alias("dst")) for c in ("_node", "_via")]
    return joined.select(F.inline(F.array(*ties))).filter("src != dst")


def _same_value(names: list[str]) -> Column:
    same = [F.col(b).eqNullSafe(F.col(f"_o{b}")) for b in names]
    return reduce(Column.__and__, same, F.col("_x").eqNullSafe(F.col("_y")))


def _loose_ties(values: DataFrame, loose: DataFrame, names: list[str], passes) -> DataFrame:
    """(block, value, its smallest node, node it is tied to) of values without an order and of those they pass with."""
    odd = loose.select(*(F.col(b).alias(f"_o{b}") for b in names), F.col("_x").alias("_y"), F.col("_low").alias("_least"))
    same = [F.col(b).eqNullSafe(F.col(f"_o{b}")) for b in names]
    links = values.join(odd, reduce(Column.__and__, same)).filter(passes("_x", "_y"))
    return links.select(*names, "_x", "_low", "_least").union(links.select(*names, "_y", "_least", "_least")).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """(node, component), component being the smallest member; singletons kept.

    Every round ties each node to its smallest neighbour, follows these ties to their roots
    by pointer jumping and contracts the edges, which shrink from round to round. Tables
    are checkpointed, and hot nodes only meet one row per node on the other side.
    """
    live = cut_lineage(edges.select("src", "dst").filter("src != dst").distinct())
    labels = cut_lineage(nodes.select(F.col(node).alias("node")).distinct().withColumn("component", F.col("node")))
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        parents = cut_lineage(
            both.groupBy("src").agg(F.min("dst").alias("parent")).filter("parent < src")
        )
        parents = _jump_to_roots(parents)
        labels = cut_estimates(_relabel(labels, "component", parents))
        live = cut_estimates(
            _relabel(_relabel(live, "src", parents), "dst", parents).filter("src != dst").distinct()
        )
    return labels.select(F.col("node").alias(node), "component")


def _relabel(df: DataFrame, col: str, parents: DataFrame) -> DataFrame:
    step = parents.select(F.col("src").alias("_old"), F.col("parent").alias("_new"))
    joined = df.join(step, F.col(col) == F.col("_old"), "left")
    return joined.withColumn(col, F.coalesce("_new", F.col(col))).drop("_old", "_new")


def _jump_to_roots(parents: DataFrame) -> DataFrame:
    """Replace parent by grandparent until nobody's parent has a parent."""
    while True:
        step = parents.select(F.col("src").alias("_mid"), F.col("parent").alias("_next"))
        jumped = cut_estimates(
            parents.join(step, F.col("parent") == F.col("_mid"), "left").select(
                "src",
                F.coalesce("_next", "parent").alias("parent"),
                F.col("_next").isNotNull().alias("_moved"),
            )
        )
        parents = jumped.select("src", "parent")
        if jumped.filter("_moved").isEmpty():
            return parents


def cluster(df: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """Component of every row of df; edges come from one of the builders above."""
    return connected_components(df, edges, node)
