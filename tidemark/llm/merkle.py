"""Merkle manifest of a table by a butterfly exchange.

Every row is a leaf. The leaves of a group (a source) stand in one order, and a tree of ``FANOUT``
children a node is built over them; the roots of the groups, in the order of the group, are the leaves
of a last tree. A row's proof is the digests beside its path to the root.

Partitions. A group is cut into aligned partitions of ``FANOUT ** LEVELS`` consecutive leaves, so a
partition is a whole subtree (the last may hold fewer). Positions come from a range-partitioned
order: equal rows first collapse to one row with a count, each range numbers its own rows,
and the sums of the ranges before it are added.

Butterfly. The partitions' numbers are read in base ``FANOUT``. In round r those partitions whose
numbers differ in digit r alone swap the roots they hold; each hashes the run of roots it receives, so
after the round all partitions below a node of that level hold its digest, computed ``FANOUT ** r``
times over, and have collected the digests beside it. After the last round every partition holds the root
of its group and the upper half of its proofs; nothing is sent down the tree. A group whose number of
partitions is no multiple of the stride is filled up with empty partitions (less than as many again) that
hold no rows but take part, so that every partition finds its partners. One group of the exchange is
at most ``FANOUT`` rows, also where one source holds most rows.

Proofs. Each partition then hashes its own leaves (one Arrow group of at most ``FANOUT ** LEVELS`` rows) and
writes one row per leaf. Full proofs, about as long as a text, exist only inside that task.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import quoted
from tidemark.session import materialize

FANOUT = 16
LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its number of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def subtree(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """All levels from the leaves up: ``levels`` of them, or up to a single node."""
    out = [leaves]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        row = out[-1]
        out.append([digest("".join(row[i : i + fanout])) for i in range(0, len(row), fanout)])
    return out


def positions(runs: DataFrame, group: str, order: list[str], count: str) -> DataFrame:
    """``runs`` with ``start`` (leaves of the group before the run) and ``total`` (leaves of the group).

    A row stands for ``count`` equal leaves. Nothing gathers a group in one task: rows are range-partitioned by
    (group, order), and only one sum for each group and range is ordered across ranges.
    """
    ranged = runs.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "merkle-ranged")
    inside = Window.partitionBy("part", group).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(group, "part").agg(F.sum(count).alias("held"))
    across = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col(group).alias("g"), F.col("part").alias("p"),
        F.coalesce(F.sum("held").over(across), F.lit(0)).alias("before"), F.sum("held").over(Window.partitionBy(group)).alias("total"),
    )
    numbered = ranged.withColumn("within", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    joined = numbered.join(sums, F.col(group).eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
    return joined.withColumn("start", F.col("before") + F.col("within")).drop("g", "p", "part", "before", "within")


def partitions(numbered: DataFrame, group: str, count: str, size: int) -> DataFrame:
    """One row for each run and partition it reaches into: ``part``, ``at`` (first place in it), ``times``, ``parts``."""
    end = F.col("start") + F.col(count)
    cut = numbered.withColumn("part", F.explode(F.sequence(F.expr(f"start div {size}"), F.expr(f"(start + {count} - 1) div {size}"))))
    first, last = F.greatest(F.col("start"), F.col("part") * size), F.least(end, (F.col("part") + 1) * size)
    return cut.withColumn("at", first - F.col("part") * size).withColumn("times", last - first).withColumn("parts", F.expr(f"(total + {size} - 1) div {size}")).drop("start", count, "total")


def roots(placed: DataFrame, group: str, fanout: int, levels: int) -> DataFrame:
    """(group, part, parts, hash) of every partition; ``levels`` runs of hashes up, or up to one node where the group is one partition."""
    run = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("at", "node"))), lambda x: x["node"]))
    # A run of equal leaves reaches into a node's children by repeating its digest there; it is at most one partition long.
    level = placed.select(group, "part", "parts", F.explode(F.expr("sequence(at, at + times - 1)")).alias("at"), F.col("leaf").alias("node"))
    level = level.repartition(F.col(group), F.col("part"))
    for _ in range(levels):
        up = level.withColumn("up", F.expr(f"at div {fanout}"))
        n = F.count("*")
        # The last run of a partition that is a whole group stays as it is once a single node is left.
        alone = (F.col("parts") == 1) & (F.col("up") == 0) & (n == 1)
        level = up.groupBy(group, "part", "parts", "up").agg(F.when(alone, F.first("node")).otherwise(F.sha2(run, 256)).alias("node")).withColumnRenamed("up", "at")
    return level.select(group, "part", "parts", F.col("node").alias("hash"))


def butterfly(own: DataFrame, group: str, fanout: int) -> DataFrame:
    """(group, part, root, path): the group's root and the digests beside the partition's path to it.

    ``own`` holds one root per partition. Each round is written to the shared folder.
    """
    most = own.agg(F.max("parts")).first()[0] or 0
    # The largest stride below the number of partitions; partitions are filled up to a multiple of it.
    stride, strides = 1, []
    while stride < most:
        strides.append(stride)
        stride *= fanout
    state = own.withColumn("path", F.array().cast(PATH)).withColumn("real", F.lit(True))
    if strides:
        top = F.greatest(*[F.when(F.col("parts") > s, F.lit(s)).otherwise(0) for s in [0, *strides]])
        filled = F.when(top > 0, F.ceil(F.col("parts") / top) * top).otherwise(0)
        twin = state.withColumn("upto", filled).withColumn("part", F.col("part") + F.col("parts")).where("part < upto").drop("upto")
        twin = twin.withColumn("hash", F.lit(None).cast("string")).withColumn("real", F.lit(False))
        state = state.unionByName(twin)
    for s in strides:
        done, going = state.where(F.col("parts") <= s), state.where(F.col("parts") > s)
        key = going.withColumn("up", F.expr(f"part div {s * fanout}")).withColumn("low", F.expr(f"part % {s}")).withColumn("digit", F.expr(f"(part div {s}) % {fanout}"))
        groups = key.groupBy(group, "parts", "up", "low").agg(F.sort_array(F.collect_list(F.struct("digit", "part", "hash", "real", "path"))).alias("swap"))
        held = F.filter("swap", lambda x: x["hash"].isNotNull())
        beside = lambda side: F.concat_ws("", F.transform(F.filter(F.col("held"), side), lambda x: x["hash"]))
        members = groups.withColumn("held", held).withColumn("parent", F.when(F.size("held") > 0, F.sha2(F.concat_ws("", F.transform("held", lambda x: x["hash"])), 256)))
        members = members.withColumn("m", F.explode("swap"))
        step = F.struct(beside(lambda x: x["digit"] < F.col("m.digit")).alias("left"), beside(lambda x: x["digit"] > F.col("m.digit")).alias("right"))
        after = members.select(
            group, F.col("m.part").alias("part"), "parts", F.col("parent").alias("hash"), F.concat("m.path", F.array(step)).alias("path"), F.col("m.real").alias("real")
        )
        state = materialize(done.unionByName(after.select(*done.columns)), "merkle-round")
    return state.where("real").select(group, "part", F.col("hash").alias("root"), "path")


def _beside(tree: list[list[str]], i: int, fanout: int) -> list[tuple[str, str]]:
    """(digests to the left, to the right) of a leaf on each level of its partition's subtree."""
    out = []
    for row in tree[:-1]:
        a = i - i % fanout
        out.append(("".join(row[a:i]), "".join(row[i + 1 : a + fanout])))
        i //= fanout
    return out


def tree_paths(table: DataFrame, group: str, order: list[str], fanout: int = FANOUT, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(placed, paths) of the column ``leaf``: rows with their partition and place, and (group, part, root, path)."""
    keys = [c for c in table.columns if c != "copies"]
    numbered = positions(table.groupBy(*keys).agg(F.count("*").alias("copies")), group, order, "copies")
    placed = materialize(partitions(numbered, group, "copies", fanout**levels), "merkle-placed")
    own = materialize(roots(placed, group, fanout, levels), "merkle-roots")
    return placed, butterfly(own, group, fanout)


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", claimed: dict[str, Column] | None = None,
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    The leaves of a group (null first, then in order of UTF-8 bytes) stand by id, then by digest, null ids first.
    ``claimed`` gives other values of some fields for the check: ``folded_root`` is recomputed from
    the leaf of the claimed values and the stored digests beside the path, and ``verified`` says whether it
    is the root. Repeated rows are leaves of their own. Null fields hash as ``-``; an empty table returns no rows.
    ``docs`` may have any other columns.
    """
    values = {f: quoted(f) for f in fields}
    rows = docs.select(
        quoted(group_col).cast("string").alias("grp"), quoted(id_col).alias("id"), leaf(list(values.values())).alias("leaf"),
        leaf(list({**values, **(claimed or {})}.values())).alias("shown"),
    )
    # A claimed leaf is stored only where it differs.
    rows = rows.withColumn("shown", F.when(F.col("shown") != F.col("leaf"), F.col("shown")))
    placed, paths = tree_paths(rows, "grp", ["id", "leaf", "shown"], fanout, levels)
    paths = materialize(paths, "merkle-paths")
    tops = paths.where("part = 0").select(F.lit(0).alias("all"), F.col("grp"), F.col("root").alias("leaf"))
    top_placed, top_paths = tree_paths(tops, "all", ["grp"], fanout, levels)
    top = placed_paths(top_placed, top_paths, fanout, levels)
    both = paths.join(top, paths.grp.eqNullSafe(top.top_grp)).select(
        paths.grp, paths.part, paths.root.alias("subroot"), "top_root", F.concat(paths.path, "top_path").alias("path")
    )

    def prove(leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("at")
        rep = leaves.loc[leaves.index.repeat(leaves["times"])]
        path = above.iloc[0]
        upper = [(p["left"], p["right"]) for p in path["path"]]
        nodes = rep["leaf"].tolist()
        tree = subtree(nodes, fanout, None if rep["parts"].iloc[0] == 1 else levels)
        proofs, folded = [], []
        for i, (own, shown) in enumerate(zip(nodes, rep["shown"].tolist())):
            steps = _beside(tree, i, fanout) + upper
            node = shown or own
            for left, right in steps:
                node = digest(left + node + right)
            proofs.append(digest("".join(left + right for left, right in steps)))
            folded.append(node)
        return pd.DataFrame({
            "id": rep["id"].array, "leaf": nodes, "subroot": path["subroot"], "root": path["top_root"],
            "proof_sha256": proofs, "folded_root": folded,
        })

    kind = docs.select(quoted(id_col).alias("id")).schema["id"].dataType.simpleString()
    # Ids travel as text: pandas would turn whole numbers beside a null into floats.
    held = placed.withColumn("id", F.col("id").cast("string"))
    done = held.groupBy("grp", "part").cogroup(both.groupBy("grp", "part")).applyInPandas(
        prove, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return done.select(F.col("id").cast(kind).alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def placed_paths(placed: DataFrame, paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(top_grp, top_root, top_path): every leaf of the last tree with its whole path."""

    def prove(leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("at")
        path = above.iloc[0]
        upper = [{"left": p["left"], "right": p["right"]} for p in path["path"]]
        tree = subtree(leaves["leaf"].tolist(), fanout, None if leaves["parts"].iloc[0] == 1 else levels)
        steps = [[{"left": a, "right": b} for a, b in _beside(tree, i, fanout)] + upper for i in range(len(leaves))]
        return pd.DataFrame({"top_grp": leaves["grp"].array, "top_root": path["root"], "top_path": steps})

    return placed.groupBy("all", "part").cogroup(paths.groupBy("all", "part")).applyInPandas(prove, f"top_grp string, top_root string, top_path {PATH}")
