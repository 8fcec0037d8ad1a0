"""SimHash near-duplicates through BK-trees (operator 6).

Each whole text, A-Z lower-cased, gives the XXH64 hashes of its word shingles,
repeats included; a fingerprint bit is 1 if set in over half of them. Equal
fingerprints are one item from then on. Fingerprints that differ in at most
``radius`` bits share, cut into ``radius + extra`` parts, at least ``extra`` of
them unchanged: each choice of ``extra`` parts is a shard key. The trees of a
partition's shards are built together, and every member descends its shard's
tree along the edges within the radius. A shard with more than ``cell`` members
is cut into a triangle of cells, one tree each, through which all its members
still pass, so no link is lost and no task holds a shard of unbounded size.
Links within a cell leave it as one link a member; their components are found
by distributed rounds.

Cases: a text without words (or null) has fingerprint zero and links like any
other; fewer words than the shingle give one shingle; ties (a bit set in just
half) are 0; repeated rows share fingerprint and component; rows with a null id
get their component's least id; an empty table gives an empty result; further
columns are ignored by ``near_duplicates`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.llm.bktree import Forest, Union
from corpusflow.llm.components import components
from corpusflow.shipping import ship
from corpusflow.storage import spread

SHINGLE = 3
RADIUS = 3
#: Members of a cell of a large shard.
CELL = 1024
#: Expected members of a shard from which one more part joins the key.
FULL_SHARD = 256
#: Groups of similar texts: words of a shingle, 64-bit words of a fingerprint,
#: differing bits (a Jaccard similarity of 0.8 gives 39 of 256 and a deviation of 6).
WIDE_SHINGLE, WIDE_WORDS, WIDE_RADIUS, WIDE_CELL = 5, 4, 54, 8192
#: Least Jaccard similarity of linked texts, and members of a cell that holds whole sets.
SIMILARITY, SET_CELL = 0.8, 512
#: How often the members of large candidate groups are dealt to cells anew.
ROUNDS = 2
#: How many of the pairs at the radius the bands find (nearer ones: more).
BAND_RECALL = 0.95
#: Shingles hashed between two rounds of counting.
_STEP = 1 << 18


def _set_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, by row."""
    out = np.zeros((len(offsets) - 1, 64), np.int64)
    for a, b in C.spans(offsets, _STEP):
        own = hashes[offsets[a] : offsets[b]]
        bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = offsets[a : b + 1] - offsets[a]
        full = np.flatnonzero(np.diff(cut))
        if len(full):
            out[a + full] = np.add.reduceat(bits, cut[:-1][full], axis=0, dtype=np.int32)
    return out


def _hashed(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """``id, h``: the XXH64 hashes of each row's shingles, repeats included."""
    ship(docs.sparkSession)
    own = spread(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    words = own.select("id", C.words_col(_lower_ascii(F.col("text"))).alias("w"))
    last = F.size("w") - shingle
    gram = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(F.col("w"), i + k) for k in range(shingle)]))
    short = F.when(F.size("w") == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join("w", " "))))
    return words.select("id", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(short).alias("h"))


def _sets(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """``id, mark, h``: the set of each row's shingles, ascending, and a hash that names it."""
    return _hashed(docs, id_col, text, shingle).withColumn("h", F.array_sort(F.array_distinct("h"))).select("id", F.xxhash64("h").alias("mark"), "h")


def _majority(column: pa.Array, seeds: int) -> np.ndarray:
    """Rows of ``seeds`` 64-bit fingerprints; the first is that of the hashes themselves."""
    lists = column.cast(pa.large_list(pa.int64()))
    off = lists.offsets.to_numpy().astype(np.int64)
    flat = np.ascontiguousarray(lists.values.to_numpy()).view(np.uint64)[off[0] : off[-1]]
    off = off - off[0]
    out = np.zeros((len(off) - 1, seeds), np.uint64)
    for k in range(seeds):
        own = flat
        if k:
            own = (flat + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
            own = (own ^ (own >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            own ^= own >> np.uint64(29)
        ones = _set_bits(own, off) * 2 > np.diff(off)[:, None]
        out[:, k] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id_col, fingerprint long)`` for each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = _majority(batch.column("h"), 1).view(np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints)], names=["id", "fingerprint"])

    return _hashed(docs, id_col, text, shingle).mapInArrow(C.in_worker(run), f"id {kind}, fingerprint long").withColumnRenamed("id", id_col)


def _lower_ascii(text):
    """A-Z lower-cased, nothing else: ``lower`` unless the text has other letters that change."""
    plain = ~text.rlike("[^\\x00-\\x7f]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def shard_keys(n_prints: int, radius: int) -> list[tuple[int, ...]]:
    """Bit masks, one for each shard key: enough bits for small shards."""
    extra = 1
    while extra < 6 and n_prints / 2 ** (64 * extra / (radius + extra)) > FULL_SHARD:
        extra += 1
    parts = radius + extra
    cut = [64 * k // parts for k in range(parts + 1)]
    masks = [((1 << cut[k + 1]) - 1) ^ ((1 << cut[k]) - 1) for k in range(parts)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return [(k, signed(sum(masks[j] for j in chosen))) for k, chosen in enumerate(combinations(range(parts), extra))]


def _groups(batches):
    """Whole runs of equal ``cell`` from batches that are sorted by it."""
    held = None
    for batch in batches:
        table = pa.table([*batch.columns], names=batch.schema.names)
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        cell = table.column("cell").to_numpy()
        if not len(cell):
            continue
        last = len(cell) - int((cell[::-1] != cell[-1]).argmax()) if cell[0] != cell[-1] else 0
        held = table.slice(last)
        if last:
            yield table.slice(0, last)
    if held is not None and held.num_rows:
        yield held


def _words_of(column: pa.ChunkedArray) -> np.ndarray:
    """Fingerprints as unsigned words; binary ones as rows of words."""
    if pa.types.is_int64(column.type):
        return column.to_numpy().view(np.uint64)
    values = column.combine_chunks().cast(pa.large_binary())
    raw = np.frombuffer(b"".join(values.to_pylist()), np.uint64)
    return raw.reshape(len(values), -1)


def _links_of(table: pa.Table, radius: int) -> tuple[pa.Array, pa.Array]:
    """One link for each member that is not its set's least, over whole cells.

    The least, so that the links of one set from different cells are mostly the same.
    Members of one ``label``, if there are labels, are one set from the start: such a
    set counts as one member, and cells of one such set alone are not searched.
    """
    column = table.column("fingerprint")
    cell, side, prints = table.column("cell").to_numpy(), table.column("side").to_numpy(), _words_of(column)
    labels = table.column("label").to_numpy() if "label" in table.schema.names else np.arange(len(cell))
    _, number = np.unique(cell, return_inverse=True)
    least, most = np.full(number.max() + 1, np.iinfo(np.int64).max), np.full(number.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(least, number, labels)
    np.maximum.at(most, number, labels)
    keep = np.flatnonzero((least < most)[number])
    # by cell, in order of the fingerprints
    words = np.atleast_2d(prints[keep].T)
    keep = keep[np.lexsort((*words, number[keep]))]
    number, side, prints, labels = number[keep], side[keep], prints[keep], labels[keep]
    # side 0: the cell's tree; side 1: passes through it; side 2: both
    in_tree, asks = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    groups = np.unique(number[in_tree])
    if len(groups):
        forest = Forest(prints[in_tree], number[in_tree])
        at = np.searchsorted(groups, number[asks])
        known = (at < len(groups)) & (groups[np.minimum(at, len(groups) - 1)] == number[asks])
        asks, at = asks[known], at[known]
    sets = Union(len(prints))
    order = np.lexsort((np.arange(len(labels)), labels, number))
    new = np.ones(len(order), bool)
    new[1:] = (number[order][1:] != number[order][:-1]) | (labels[order][1:] != labels[order][:-1])
    sets.label[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    start = sets.label.copy()
    if len(groups):
        for who, node in forest.search(prints[asks], forest.roots[at], radius):
            a, b = asks[who], in_tree[node]
            other = sets.label[a] != sets.label[b]
            sets.link(a[other], b[other])
    moved = np.flatnonzero((start == np.arange(len(start))) & (sets.label != start))
    return column.take(pa.array(keep[moved])), column.take(pa.array(keep[sets.label[moved]]))


def _cells(shards: DataFrame, cell: int, member: str = "fingerprint") -> DataFrame:
    """``cell, side, member`` of shards ``k, v, member``, and what else these have; large
    ones in a triangle of cells."""
    own = [member, *[c for c in shards.columns if c not in ("k", "v", member)]]
    sizes = shards.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    large = C.materialise(sizes.filter(F.col("n") > cell).select("k", "v", F.ceil(F.col("n") / cell).cast("int").alias("m")), "large")
    if large.limit(1).count() == 0:
        return shards.select(F.xxhash64("k", "v").alias("cell"), F.lit(2).alias("side"), *own)
    large = C.broadcast_if_small(large)
    alone = C.materialise(shards.join(large, ["k", "v"], "left"), "shards")
    small = alone.filter(F.col("m").isNull()).select(F.xxhash64("k", "v").alias("cell"), F.lit(2).alias("side"), *own)
    # A large shard: part i is the tree of cells (i, j), and part j passes through.
    part = F.pmod(F.xxhash64(member), F.col("m")).cast("int")
    cut = alone.filter(F.col("m").isNotNull()).select("k", "v", "m", part.alias("p"), *own)
    as_tree = cut.select("k", "v", F.explode(F.sequence("p", F.col("m") - 1)).alias("j"), F.col("p").alias("i"), *own).withColumn("side", F.when(F.col("i") == F.col("j"), 2).otherwise(0))
    asking = cut.filter(F.col("p") > 0).select("k", "v", F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias("i"), F.col("p").alias("j"), *own).withColumn("side", F.lit(1))
    cells = as_tree.unionByName(asking).select(F.xxhash64("k", "v", "i", "j").alias("cell"), "side", *own)
    return small.unionByName(cells)


def _linked(cells: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` out of cells, each cell whole in one task."""
    ship(cells.sparkSession)
    kind = cells.schema["fingerprint"].dataType.simpleString()
    n_parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for table in _groups(batches):
            a, b = _links_of(table, radius)
            if len(a):
                yield from pa.table({"a": a, "b": b}).to_batches()

    return cells.repartition(n_parts, "cell").sortWithinPartitions("cell").mapInArrow(C.in_worker(run), f"a {kind}, b {kind}")


def links(prints: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints within ``radius`` of each other.

    ``prints`` has distinct fingerprints. Not every pair is given: of each cell,
    one link for each member, which is all that components need.
    """
    n = prints.count()
    keys = shard_keys(n, radius)
    own = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("v")) for k, m in keys]))
    shards = prints.select("fingerprint", own.alias("s")).select("fingerprint", "s.k", "s.v")
    return _linked(_cells(shards, cell), radius)


def _similar_in(marks: np.ndarray, labels: np.ndarray, asks: np.ndarray, tree: np.ndarray, flat: np.ndarray, off: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
    """Links of one cell: a member of ``tree`` and one that asks, of at least that similarity.

    Members of one label are linked already. Each member of the tree is compared
    with whoever is not yet in its set, so that a group of near copies costs as
    many comparisons as it has members.
    """
    _, flat = np.unique(flat, return_inverse=True)
    size, sets = np.diff(off), Union(len(marks))
    _, first, number = np.unique(labels, return_index=True, return_inverse=True)
    sets.label = first[number]
    seen = np.zeros(int(flat.max()) + 1 if len(flat) else 1, bool)
    both_sides = np.array_equal(asks, tree)
    for t in tree:
        rest = asks[(asks > t) | (not both_sides)]
        rest = rest[sets.label[rest] != sets.label[t]]
        small, large = np.minimum(size[rest], size[t]), np.maximum(size[rest], size[t])
        rest = rest[small >= least * large - 1e-9]  # as sizes allow
        if not len(rest):
            continue
        own = flat[off[t] : off[t + 1]]
        seen[own] = True
        both = C.sums(seen[flat[C.ragged(off[rest], size[rest])]], C.ends(size[rest])).astype(np.int64)
        seen[own] = False
        rest = rest[both >= least * (size[rest] + size[t] - both) - 1e-9]
        # one link for each set that joins
        rest = rest[np.unique(sets.label[rest], return_index=True)[1]]
        if len(rest):
            sets.link(np.full(len(rest), t), rest)
            yield from ((marks[t], marks[r]) for r in rest)


def _verified(cells: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` of marks whose sets have at least that Jaccard similarity,
    out of cells ``cell, side, mark, label, h``."""
    ship(cells.sparkSession)
    n_parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for table in _groups(batches):
            cell, side, marks, labels = (table.column(c).to_numpy() for c in ("cell", "side", "mark", "label"))
            lists = table.column("h").combine_chunks().cast(pa.large_list(pa.int64()))
            off = lists.offsets.to_numpy().astype(np.int64)
            flat, off = lists.values.to_numpy()[off[0] : off[-1]], off - off[0]
            cut = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1), len(cell)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                own = off[a : b + 1]
                found = list(_similar_in(marks[a:b], labels[a:b], np.flatnonzero(side[a:b] != 0), np.flatnonzero(side[a:b] != 1), flat[own[0] : own[-1]], own - own[0], least))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    cells = cells.select("cell", "side", "mark", "label", "h")
    return cells.repartition(n_parts, "cell").sortWithinPartitions("cell").mapInArrow(C.in_worker(run), "a long, b long")


def _similar(near: DataFrame, least: float, cell: int) -> DataFrame:
    """``node, root`` of marks: groups of sets of that Jaccard similarity, each within its ``v``.

    ``near`` has ``v, mark, h``. A ``v`` of at most ``cell`` members is a cell. The
    members of a larger one are dealt to cells, and dealt anew, in ``ROUNDS``;
    after that what is one group by then is not compared within itself any more:
    its largest group meets all others, and these meet each other, in cells of two
    parts. So each pair is compared, and near copies, however many, are copied to
    ``ROUNDS`` cells each.
    """
    sizes = near.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    large = C.materialise(sizes.filter(F.col("n") > cell).select("v", F.ceil(F.col("n") / cell).cast("int").alias("m")), "large")
    whole = lambda df: df.select(F.xxhash64("v").alias("cell"), F.lit(2).alias("side"), "mark", F.col("mark").alias("label"), "h")
    if large.limit(1).count() == 0:
        return components(_verified(whole(near), least))
    large = C.broadcast_if_small(large)
    links = C.materialise(_verified(whole(near.join(large, "v", "left_anti")), least), "links")
    own = C.materialise(near.join(large, "v"), "sets")
    labels = own.select("mark", F.col("mark").alias("label"))
    found = links.limit(0)

    def labelled() -> DataFrame:
        roots = components(found)
        return own.select("mark").join(roots, F.col("mark") == F.col("node"), "left").select("mark", F.coalesce("root", "mark").alias("label"))

    for k in range(ROUNDS):
        dealt = F.xxhash64("v", F.lit(k), F.pmod(F.xxhash64("mark", F.lit(k)), F.col("m")))
        cells = own.join(labels, "mark").select(dealt.alias("cell"), F.lit(2).alias("side"), "mark", "label", "h")
        found = found.unionByName(C.materialise(_verified(cells, least), "links"))
        labels = C.materialise(labelled(), "labels")
    # what is left: v of more than one group
    groups = own.select("v", "mark").join(labels, "mark").groupBy("v", "label").agg(F.count(F.lit(1)).alias("n"))
    top = groups.groupBy("v").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))
    parts = lambda n: F.ceil(n / cell).cast("int")
    left = top.filter("groups > 1").select("v", "major", parts(F.col("n") - F.col("most")).alias("others"), parts(F.col("most")).alias("majors"))
    own = own.select("v", "mark", "h").join(C.broadcast_if_small(C.materialise(left, "left")), "v").join(labels, "mark")
    dealt = lambda n: F.pmod(F.xxhash64("mark", F.lit(ROUNDS)), n).cast("int")
    own = own.withColumn("part", F.when(F.col("label") == F.col("major"), F.col("others") + dealt(F.col("majors"))).otherwise(dealt(F.col("others"))))
    # cells (i, j) of parts i <= j, of which i is one of the others: i is the tree
    tree = own.filter("part < others").withColumn("i", F.col("part")).withColumn("j", F.explode(F.sequence("part", F.col("others") + F.col("majors") - 1)))
    tree = tree.withColumn("side", F.when(F.col("i") == F.col("j"), 2).otherwise(0))
    asks = own.filter("part > 0").withColumn("j", F.col("part")).withColumn("i", F.explode(F.sequence(F.lit(0), F.least("part", "others") - 1))).withColumn("side", F.lit(1))
    cells = tree.unionByName(asks).select(F.xxhash64("v", "i", "j").alias("cell"), "side", "mark", "label", "h")
    return components(links.unionByName(found).unionByName(_verified(cells, least)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: ``id_col, fingerprint long, component_id`` (least id reachable)."""
    prints = C.materialise(fingerprints(docs, id_col, text, shingle).withColumnRenamed(id_col, "id"), "prints")
    least = C.materialise(prints.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "least")
    roots = C.settled(docs.sparkSession, "roots", lambda: components(links(least.select("fingerprint"), radius)))
    return _named(prints, least, roots, id_col)


def _named(prints: DataFrame, least: DataFrame, roots: DataFrame, id_col: str, by: str = "fingerprint") -> DataFrame:
    """Rows with the least id of the component of their ``by``.

    ``least`` has a row for each ``by``, with its least id and its number of ``rows``.
    """
    joined = least.join(roots, least[by] == roots["node"]).select("root", "node", "least")
    by_root = joined.groupBy("root").agg(F.min("least").alias("component"))
    linked = roots.join(by_root, "root").select(F.col("node").alias(by), "component")
    named = least.join(linked, by, "left").select(by, "rows", F.coalesce("component", "least").alias("component_id"))
    named = C.materialise(named, "named")
    total = named.agg(F.sum("rows").alias("n")).first()["n"] or 0
    keys = prints.select("id", by, *({"fingerprint"} - {by}))
    return C.join_groups(keys, named, by, "rows", total).select(F.col("id").alias(id_col), "fingerprint", "component_id")


def band_bits(n: int, agree: float, recall: float) -> tuple[int, int]:
    """Bits of a band and number of bands: buckets of a hundred strangers or so, and
    ``recall`` of the pairs whose fingerprints agree in a share ``agree`` of bits."""
    bits = max(8, int(np.ceil(np.log2(max(n, 2)))) - 7)
    return bits, int(np.ceil(np.log(1 - recall) / np.log(1 - agree**bits)))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = WIDE_SHINGLE, radius: int = WIDE_RADIUS) -> DataFrame:
    """Per row: ``id_col, fingerprint binary, component_id``, for a similarity of 0.8.

    64 bits tell such texts apart from others too coarsely. Here a fingerprint
    has ``WIDE_WORDS`` words and is that of the set of shingles; shards are bands
    of its bits, drawn from a fixed seed, as many as give ``BAND_RECALL`` at the
    radius; in the shards the trees are searched as ever. What they
    link is a candidate only: within each component of candidates the sets
    themselves are compared, and those of a Jaccard similarity of ``SIMILARITY``
    or more are linked (sets are compared by their shingles' 64-bit hashes).
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def wide(batches):
        for batch in batches:
            rows = _majority(batch.column("h"), WIDE_WORDS)
            raw = pa.py_buffer(rows.tobytes())
            values = pa.Array.from_buffers(pa.binary(8 * WIDE_WORDS), len(rows), [None, raw]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), values], names=["id", "mark", "fingerprint"])

    prints = C.materialise(_sets(docs, id_col, text, shingle).mapInArrow(C.in_worker(wide), f"id {kind}, mark long, fingerprint binary"), "prints")
    least = C.materialise(prints.groupBy("mark", "fingerprint").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "least")
    distinct = C.materialise(least.select("fingerprint").distinct(), "distinct")
    bits, bands = band_bits(distinct.count(), 1 - radius / (64 * WIDE_WORDS), BAND_RECALL)
    rng = np.random.default_rng(17)
    places = [rng.choice(64 * WIDE_WORDS, bits, replace=False) for _ in range(bands)]

    def banded(own: DataFrame, bands: list[tuple[int, np.ndarray]]) -> DataFrame:
        """Links by some bands of ``own(fingerprint, label)``."""

        def cut(batches):
            for batch in batches:
                rows = _words_of(pa.chunked_array([batch.column("fingerprint")]))
                ones = np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")
                for k, place in bands:
                    v = ones[:, place].astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), k, np.int32)), pa.array(v), *batch.columns], names=["k", "v", *batch.schema.names])

        shards = own.mapInArrow(C.in_worker(cut), "k int, v long, fingerprint binary, label long")
        return _linked(_cells(shards, WIDE_CELL), radius)

    def found() -> DataFrame:
        # some bands first: what they link needs no links of its own in the others
        numbered = list(enumerate(places))
        some = -(-bands // 4)
        roots = components(banded(distinct.withColumn("label", F.xxhash64("fingerprint")), numbered[:some]))
        named = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", F.xxhash64(F.coalesce("root", "fingerprint")).alias("label"))
        rest = banded(C.materialise(named, "distinct"), numbered[some:])
        return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest))

    roots = C.settled(docs.sparkSession, "roots", found)
    # candidates: the sets of components of more than one
    near = least.join(roots, least["fingerprint"] == roots["node"], "left").select("mark", "least", F.coalesce("root", "fingerprint").alias("v"))
    many = near.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v")
    near = C.materialise(near.join(C.broadcast_if_small(C.materialise(many, "many")), "v"), "near")
    ids = C.broadcast_if_small(near.select(F.col("least").alias("least_")).distinct())
    again = _sets(docs.join(ids, docs[id_col].eqNullSafe(ids["least_"]), "left_semi"), id_col, text, shingle)
    sets = near.select("v", "mark").join(again.select("mark", "h").dropDuplicates(["mark"]), "mark")
    return _named(prints, least, _similar(C.materialise(sets, "sets"), SIMILARITY, SET_CELL), id_col, "mark")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each group of similar ones, with all their columns.

    The one with the least ``doc_id`` stays (null comes first), of equal ids the
    one whose text has the least hash, of repeated rows one. Rows are told apart
    by ``doc_id`` and text, so two documents under one id are two documents.
    """
    key, gone_, twice_, row_ = (C.fresh(docs, c) for c in ("key_", "gone_", "twice_", "row_"))
    keyed = docs.withColumn(key, F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("sum")))
    groups = C.settled(docs.sparkSession, "groups", lambda: similar_groups(keyed.select(F.col(key).alias("key"), "text"), "key"))
    gone = C.materialise(groups.filter(F.col("key") != F.col("component_id")).select(F.col("key").alias(gone_)).distinct(), "gone")
    kept = keyed.join(C.broadcast_if_small(gone), F.col(key) == F.col(gone_), "left_anti")
    twice = groups.filter(F.col("key") == F.col("component_id")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("key").alias(twice_))
    twice = C.materialise(twice, "twice")
    if twice.limit(1).count() == 0:
        return kept.drop(key)
    ids = C.broadcast_if_small(twice)
    again = kept.join(ids, F.col(key) == F.col(twice_), "left_semi")
    # rows that repeat are aggregated, not sorted
    first = again.groupBy(key).agg(F.any_value(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(row_)).select(f"{row_}.*")
    return kept.join(ids, F.col(key) == F.col(twice_), "left_anti").drop(key).unionByName(first)
