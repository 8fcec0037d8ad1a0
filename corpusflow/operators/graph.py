"""Class hierarchies: root resolution, bounded breadth-first search, label pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.operators.select import first_of_each
from corpusflow.storage import checkpointed

MAX_DEPTH, MAX_CLASSES, MAX_CHILDREN, PER_CLASS, ROOTS_FOUND, ROOTS_KEPT = 4, 3000, 2000, 3000, 6, 4


def resolve_roots(labels: DataFrame, edges: DataFrame, roots: DataFrame, keep: int = ROOTS_KEPT, prefix: str = "", found_most: int = ROOTS_FOUND) -> DataFrame:
    """``label, item, rank``: items with an exact label that have a parent, curated first.

    ``labels(item, label)``, ``edges(child, parent)``, ``roots(label, curated)``. Of a
    label's items whose name begins with ``prefix`` the first ``found_most`` count,
    and its curated item always.
    """
    own = labels.join(roots, "label")
    own = own.filter(F.col("item").startswith(prefix)) if prefix else own
    own = own.join(edges.select(F.col("child").alias("item")), "item", "left_semi").distinct()
    found = first_of_each(own, ["label"], "item", found_most)
    curated = own.filter(F.col("item") == F.col("curated"))
    found = found.unionByName(curated).distinct()
    order = Window.partitionBy("label").orderBy(~F.col("item").eqNullSafe(F.col("curated")), "item")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep).select("label", "item", "rank")


def descend(edges: DataFrame, roots: DataFrame, depth: int = MAX_DEPTH, max_classes: int | None = MAX_CLASSES, max_children: int | None = MAX_CHILDREN, known: DataFrame | None = None) -> DataFrame:
    """``node, depth`` of the classes below the roots, levels 0 to ``depth``.

    A level expands at most what is left of ``max_classes``, in order of node; a
    node gives at most ``max_children`` children; None is no bound. Each level is
    checkpointed. ``known`` is the result of a run that ended early: its last level is
    expanded next.
    """
    edges = edges.select("child", "parent").distinct()
    if max_children is not None:
        edges = first_of_each(edges, ["parent"], "child", max_children)
    edges = checkpointed(edges)  # read at each level
    visited = roots.select(F.col("node"), F.lit(0).alias("depth")).distinct()
    at = 0
    if known is not None:
        visited = checkpointed(known.select("node", "depth").unionByName(visited).groupBy("node").agg(F.min("depth").alias("depth")))
        at = visited.agg(F.max("depth").alias("d")).first()["d"] or 0
    frontier = visited.filter(F.col("depth") == at).select("node")
    for level in range(at + 1, depth + 1):
        found = frontier.join(edges, frontier["node"] == edges["parent"]).select(F.col("child").alias("node")).distinct()
        found = found.join(visited, "node", "left_anti")
        if max_classes is not None:
            left = max_classes - visited.count()
            if left <= 0:
                break
            found = found.orderBy("node").limit(left)
        frontier = checkpointed(found)
        visited = checkpointed(visited.unionByName(frontier.withColumn("depth", F.lit(level))))
        if frontier.isEmpty():
            break
    return visited


def class_terms(instances: DataFrame, source: DataFrame, target: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``class, item, en, zh``: items with both labels, the first ``per_class`` of each class."""
    both = instances.join(source.withColumnRenamed("label", "en"), "item").join(target.withColumnRenamed("label", "zh"), "item")
    return first_of_each(both, ["class"], "item", per_class)


def harvest(classes: DataFrame, fetch, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``terms(class, item, en, zh)`` and ``state(class, done, error)`` of classes that ``known``
    (the state of a run before) does not have as done.

    ``fetch(class)`` yields ``(item, en, zh)``; it runs where the classes lie, and a
    class that fails is a row of the state, to be fetched by the next run. Write both
    once: a second use would fetch again.
    """
    from corpusflow.shipping import ship

    ship(classes.sparkSession)
    todo = classes.select("class").distinct()
    if known is not None:
        todo = todo.join(known.filter("done").select("class"), "class", "left_anti")

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for name in frame["class"]:
                try:
                    rows += [(name, *r, None) for r in fetch(name)]
                    rows.append((name, None, None, None, None))
                except Exception as e:  # a failed class is a row, not a failed job
                    rows.append((name, None, None, None, str(e)[:200] or "failed"))
            yield pd.DataFrame(rows, columns=["class", "item", "en", "zh", "error"])

    found = checkpointed(todo.mapInPandas(run, "class string, item string, en string, zh string, error string"))
    bad = F.max("error")
    state = found.groupBy("class").agg(bad.isNull().alias("done"), bad.alias("error"))
    return found.filter("item IS NOT NULL").drop("error"), state


def distinct_terms(terms: DataFrame, key: str = "item", by: str = "class") -> DataFrame:
    """One row for each ``key``: that of the first ``by``."""
    rest = [c for c in terms.columns if c != key]
    return terms.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(by, *rest)).alias("row")).select(key, "row.*")
