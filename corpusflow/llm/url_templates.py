"""URL filters by a path-template tree (operator 4).

Urls are judged by host and path rules; the longest that fits wins. The others
are judged by templates: for each host a tree of path segments, in which
numbers, dates and hashes stand for themselves as classes, a place with many
rarely used values becomes a wildcard, and branches whose share of blocked urls
among labelled ones (those that a rule judged) does not differ significantly from
their siblings' merge into one. Branches without enough labels are not merged: want of
evidence is no likeness. A template is rejected if its smoothed purity, the share of
blocked urls among its labelled ones, is high enough. A template with too few labels of its
own inherits: from the host down, each node's purity is its labels', smoothed towards what it
inherits, and it hands that on in so far as its urls are labelled: a node that a rule
judges as a whole tells much of a branch without labels, one that rules hardly touch
tells little.

The tree grows level by level over distinct typed paths with their counts, by
grouped sums; no host's urls are gathered in a task, and where rows meet their node's row a
hot node's stay where they are.

Cases: a null url, or one without ``://``, has empty host and path and is judged
as such; an empty path fits no rule with a path; equally long rules: the first
listed; without labels nothing is rejected; repeated rows give a row each; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C

#: (verdict, host, path); a rule list is a configuration, held in the plan.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Levels of the tree; what lies deeper is one segment, as it stands.
DEPTH = 6
#: A place with this many values, each in fewer urls on average, is a wildcard.
MANY_VALUES, PER_VALUE = 12, 4.0
#: Two-sided 5 % bound of a standard normal.
Z = 1.96
PRIOR_WEIGHT, REJECT, LEAST_LABELS = 4.0, 0.8, 5


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), F.lit(""))
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def rule_of(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """The rule that judges a url, as ``host + path``, and its verdict; else null."""
    rules = sorted(RULES if rules is None else rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in rules]
    name = [F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, rules, strict=True)]
    verdict = [F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, rules, strict=True)]
    none = F.lit(None).cast("string")
    return F.coalesce(*name, none), F.coalesce(*verdict, none)


def typed(path: Column) -> Column:
    """Segments of a path, with classes for values that vary by nature."""
    one = lambda s: (
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), "{date}")
        .when(s.rlike(r"^\d+$"), "{num}")
        .when(s.rlike(r"^\d+\.\w{1,5}$"), F.concat(F.lit("{num}."), F.substring_index(s, ".", -1)))
        .when(s.rlike(r"^[0-9a-fA-F-]{16,}$"), "{hex}")
        .otherwise(s)
    )
    parts = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), one)
    deep = F.size(parts) > DEPTH
    return F.when(deep, F.concat(F.slice(parts, 1, DEPTH), F.array(F.array_join(F.slice(parts, F.lit(DEPTH + 1), F.size(parts)), "/")))).otherwise(parts)


def templates(urls: DataFrame) -> DataFrame:
    """``host, typed, names, n, blocked, allowed`` for distinct ``(host, typed)``; ``names`` is the template.

    ``urls`` has ``host``, ``typed`` and ``label`` (block, allow or null).
    """
    counts = urls.groupBy("host", "typed").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "block").alias("blocked"), F.count_if(F.col("label") == "allow").alias("allowed"))
    tree = C.materialise(counts.withColumn("names", F.array().cast("array<string>")), "paths")
    total = tree.count()
    for depth in range(DEPTH + 1):
        tree = tree.withColumn("s", F.get("typed", F.lit(depth)))
        deeper = tree.filter(F.col("s").isNotNull()).withColumn("branch", F.struct("host", "names", "s"))
        child = deeper.groupBy("branch").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum(F.col("blocked") + F.col("allowed")).alias("l"))
        child = C.materialise(child.withColumn("node", F.struct("branch.host", "branch.names")), "branches")
        many = child.count()
        if not many:
            break
        parent = child.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("pn"), F.sum("b").alias("pb"), F.sum("l").alias("pl"))
        both = C.join_groups(child, parent, "node", "members", many)
        # two shares, of the branch and of its siblings, with half a count for each verdict
        sb, sl = F.col("pb") - F.col("b"), F.col("pl") - F.col("l")
        own, other = (F.col("b") + 0.5) / (F.col("l") + 1), (sb + 0.5) / (sl + 1)
        pooled = (F.col("pb") + 1) / (F.col("pl") + 2)
        z = F.abs(own - other) / F.sqrt(pooled * (1 - pooled) * (1 / (F.col("l") + 1) + 1 / (sl + 1)))
        alike = (F.col("l") >= LEAST_LABELS) & (sl >= LEAST_LABELS) & (z < Z)
        variable = (F.col("k") >= MANY_VALUES) & (F.col("pn") / F.col("k") < PER_VALUE)
        named = both.select("branch", "rows", F.when((F.col("k") > 1) & (variable | alike), "*").otherwise(F.col("branch.s")).alias("name"))
        grown = C.join_groups(deeper, named, "branch", "rows", total).withColumn("names", F.concat("names", F.array("name")))
        keep = ["host", "typed", "n", "blocked", "allowed", "names"]
        tree = C.materialise(grown.select(keep).unionByName(tree.filter(F.col("s").isNull()).select(keep)), "paths")
    return tree.select("host", "typed", "names", "n", "blocked", "allowed")


def rejected(tree: DataFrame) -> DataFrame:
    """``host, names, n_labels, purity, n_inherited, inherited, rejected`` of every template.

    ``purity`` is by its own labels; ``inherited`` by those on the way to it, of which the
    nearest node that has any has ``n_inherited``.
    """
    total = tree.agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a")).first()
    b, a = total["b"] or 0, total["a"] or 0
    prior = b / (a + b) if a + b else 0.0
    sums = C.materialise(tree.groupBy("host", "names").agg(F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum(F.col("blocked") + F.col("allowed")).alias("l")), "templates")
    way = sums.withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("names")))).withColumn("node", F.struct("host", F.slice("names", F.lit(1), F.col("depth")).alias("names")))
    nodes = way.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n_"), F.sum("b").alias("b_"), F.sum("l").alias("l_"))
    met = C.join_groups(way.select("host", "names", "depth", "node"), nodes, "node", "members", way.count())
    steps = met.groupBy("host", "names").agg(F.array_sort(F.collect_list(F.struct("depth", "n_", "b_", "l_"))).alias("steps"))  # a row a level
    start = F.struct(F.lit(prior).alias("purity"), F.lit(prior).alias("given"), F.lit(0).cast("long").alias("labels"))

    def step(acc: Column, x: Column) -> Column:
        own = (x["b_"] + PRIOR_WEIGHT * acc["given"]) / (x["l_"] + PRIOR_WEIGHT)
        share = x["l_"] / x["n_"]
        return F.struct(own.alias("purity"), (share * own + (1 - share) * acc["given"]).alias("given"), F.when(x["l_"] > 0, x["l_"]).otherwise(acc["labels"]).alias("labels"))

    told = steps.select("host", "names", F.aggregate("steps", start, step).alias("x")).select("host", "names", F.col("x.purity").alias("inherited"), F.col("x.labels").alias("n_inherited"))
    purity = (F.col("b") + PRIOR_WEIGHT * prior) / (F.col("l") + PRIOR_WEIGHT)
    own = sums.join(told, ["host", "names"]).withColumn("purity", purity)
    sure = F.col("l") >= LEAST_LABELS
    bad = F.when(sure, F.col("purity") >= REJECT).otherwise((F.col("inherited") >= REJECT) & (F.col("n_inherited") >= LEAST_LABELS))
    return own.select("host", "names", F.col("l").alias("n_labels"), "purity", "n_inherited", "inherited", bad.alias("rejected"))


def judge(pages: DataFrame, rules=None) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict``, and what a template's verdict
    rests on: ``template, n_labels, purity, n_inherited, inherited``."""
    host, path = parsed(F.col("url"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = C.materialise(own.withColumn("rule", name).withColumn("label", verdict).withColumn("typed", typed(F.col("path"))), "urls")
    tree = templates(own)
    template = F.concat(F.when(F.size("names") > 0, "/").otherwise(""), F.array_join("names", "/"))
    of = tree.select(F.struct("host", "typed").alias("form"), "host", "names", "n").join(rejected(tree), ["host", "names"])
    of = C.materialise(of.select("form", "n", "rejected", template.alias("template"), "n_labels", "purity", "n_inherited", "inherited"), "forms")
    # a form of many pages: its pages stay where they are
    met = C.join_groups(own.withColumn("form", F.struct("host", "typed")), of, "form", "n", own.count())
    return met.select("page_id", "host", "path", "rule", F.coalesce("label", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "n_labels", "purity", "n_inherited", "inherited")
