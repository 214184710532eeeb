"""N-gram Jaccard join with signature trees; all links, as connected components.

Sets are the distinct shingles of a text, as 64-bit hashes. Equal sets are one node. Two sets with
100 * |intersection| >= percent * |union| share ``needed`` elements of their prefixes: the first
n - ceil(percent * n / 100) + needed elements in an order that is the same for all sets. So

1. each node is listed under its prefix elements, elements of common passages last in the order;
   elements that occur once are dropped, then nodes with too few elements left, which leaves next
   to nothing of texts without a relative;
2. each node is compared with the smallest node of each of its lists, exactly; these links already
   join a group of copies, whatever its size, with as many comparisons as members;
3. lists whose other members still are of several components go through signature trees, one list of
   those with the same members: bitmaps and sizes prune pairs of nodes by the largest possible
   overlap. A group first offers a spanning forest of the pairs that are left, which are compared
   exactly and join almost all there is to join; then all pairs between components that still are
   different. Long lists are cut into chunks, and each pair of chunks is a task's group.

Pairs are compared by sizes, then by bitmaps, and only what these leave by the elements, since the
elements are what makes a shuffle wide.

Nothing is capped and no step depends on luck; common elements only change the order.

Defined results: a text without words (or null) has an empty set and is a component of its own;
with fewer words than a shingle the whole sequence is the one shingle; repeated rows and equal
texts are one node and each row is returned; a null id joins in but never names a component unless
alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import signature_tree as S
from eventlens.llm import words as W
from eventlens.llm.common import arrow_map, fresh, materialize

SHINGLE = 4
PERCENT = 85
HOT_SHARE = 1 / 1000
HOT_LEAST = 8
BATCH = 12 << 20
MAX_HOT = 1 << 20
CHUNK = 4096
ELEMENTS = 1 << 22
MORE_PERCENT = 3


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    found = W.words_of(column)
    runs = W.windows(found.hashes, size)
    out = []
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if high - low >= size:
            out.append(np.unique(runs[low:high - size + 1]))
        elif high > low:
            out.append(W.windows(found.hashes[low:high], high - low))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(elements: np.ndarray) -> int:
    """A 64-bit name of a set, signed."""
    if not len(elements):
        return 0
    with np.errstate(over="ignore"):
        total = np.add.reduce(W.finish(elements)) + np.uint64(len(elements))
        return int(W.finish(np.array([total]))[0].astype(np.int64))


def needed(n: int) -> int:
    """How many prefix elements two similar sets have in common, the smaller one of n elements."""
    return 1 + n * MORE_PERCENT // 100


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + needed(n)) if n else 0


def _signed(elements: np.ndarray) -> np.ndarray:
    return elements.view(np.int64)


def common_elements(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles that are common within some batch of rows: only a hint for the order.

    Every batch names its own, so nothing but these few is shuffled. At most ``MAX_HOT`` are used,
    the most frequent; that changes work, not results, since any one order gives all links.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, 0, BATCH)):
            sets = shingle_sets(batch.column(0), size)
            if not sum(map(len, sets)):
                continue
            element, count = np.unique(np.concatenate(sets), return_counts=True)
            hot = count >= max(HOT_LEAST, HOT_SHARE * len(sets))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(element[hot])), pa.array(count[hot])], ["element", "n"])

    named = (docs.select("text").mapInArrow(run, "element bigint, n bigint")
             .groupBy("element").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "element").limit(MAX_HOT).select("element"))
    found = [b for b in [named.toArrow().column(0).to_numpy()] if len(b)]
    return np.sort(np.concatenate(found).view(np.uint64)) if found else np.zeros(0, np.uint64)


def members(docs: DataFrame, size: int) -> DataFrame:
    """Per document (doc_id, text, row_key): set size and node, the set's name."""
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), size)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_key(s) for s in sets], pa.int64())], ["doc_id", "row_key", "n", "node"])

    return arrow_map(docs, of, "doc_id bigint, row_key bigint, n bigint, node bigint", text=1)


def prefixes(docs: DataFrame, size: int, percent: int, hot: np.ndarray) -> DataFrame:
    """(element, node) for the prefix of each document's set."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        hot = shared.value
        nodes, parts = [], []
        for elements in shingle_sets(batch.column(0), size):
            nodes.append(set_key(elements))
            length = prefix_length(len(elements), percent)
            if length and len(hot):
                at = np.minimum(np.searchsorted(hot, elements), len(hot) - 1)
                common = hot[at] == elements
                elements = np.concatenate([elements[~common], elements[common]])
            parts.append(elements[:length])
        return pa.RecordBatch.from_arrays(
            [pa.array(_signed(np.concatenate(parts))),
             pa.array(np.repeat(nodes, [len(p) for p in parts]))], ["element", "node"])

    return arrow_map(docs.select("text"), of, "element bigint, node bigint", text=0)


def node_sets(docs: DataFrame, size: int) -> DataFrame:
    """Per node: the set itself, its size and its bitmap. ``docs`` has node and text."""
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), size)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        maps = [S.bitmap(s, S.width_for(len(s))).tobytes() for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(np.concatenate(sets)))),
             pa.array(maps, pa.binary())], ["node", "n", "elements", "bitmap"])

    return arrow_map(docs, of, "node bigint, n bigint, elements array<bigint>, bitmap binary", text=1)


def _possible(percent: int):
    """Keeps the pairs whose bitmaps leave enough overlap possible."""
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)
        keep = [S.overlap(np.frombuffer(x, np.uint64), na, np.frombuffer(y, np.uint64), nb) * (100 + percent)
                >= (na + nb) * percent for na, x, nb, y in rows]
        return batch.select([0, 1, 2, 4]).filter(pa.array(keep, pa.bool_()))

    return of


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: sizes first, then bitmaps, then the exact intersection."""
    known = sets.select("node", "n", "bitmap")
    near = (pairs.select("a", "b").join(known.toDF("a", "na", "ma"), "a").join(known.toDF("b", "nb", "mb"), "b")
            .filter((F.col("na") * 100 >= F.col("nb") * percent)
                    & (F.col("nb") * 100 >= F.col("na") * percent))
            .select("a", "b", "na", "ma", "nb", "mb"))
    left = arrow_map(near, _possible(percent), "a bigint, b bigint, na bigint, nb bigint")
    elements = sets.select("node", "elements")
    both = F.size(F.array_intersect("ea", "eb")).cast("bigint")
    return (left.join(elements.toDF("b", "eb"), "b").join(elements.toDF("a", "ea"), "a")
            .withColumn("both", both)
            .filter(F.col("both") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
            .select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; a component is its smallest node.

    Smallest labels spread along edges, and each step also follows the label's own label, so the
    number of steps grows with the logarithm of a component's length.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("l"))
                         .select(F.col("a").alias("node"), F.least("a", "l").alias("component")))
    while True:
        heard = (both.join(labels.toDF("b", "l"), "b").groupBy("a").agg(F.min("l").alias("l"))
                 .withColumnRenamed("a", "node"))
        nearer = labels.join(heard, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "l").alias("c"))
        jumped = (nearer.join(labels.toDF("c", "further"), "c", "left")
                  .select("node", "old", F.least("c", F.coalesce("further", "c")).alias("component")))
        moved = materialize(jumped)
        labels = moved.select("node", "component")
        if moved.filter("old <> component").isEmpty():
            return labels


class _Spanning:
    """Which members are joined already; keeps of many pairs those that join something new."""

    def __init__(self, component: np.ndarray):
        self.label = np.unique(component, return_inverse=True)[1]

    def new(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Places of the pairs to keep."""
        a, b = self.label[i], self.label[j]
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while x in top:
                x = top[x]
            return x

        apart = np.flatnonzero(a != b)
        if not len(apart):
            return apart
        # One of the pairs that join the same two will do.
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        apart = apart[np.unique(low * (int(self.label.max()) + 1) + high, return_index=True)[1]]
        keep = []
        for k in apart.tolist():
            x, y = root(int(a[k])), root(int(b[k]))
            if x != y:
                top[x] = y
                keep.append(k)
        table = np.arange(int(self.label.max()) + 1)
        for x in top:
            table[x] = root(x)
        self.label = table[self.label]
        return np.array(keep, np.int64)


def _group_pairs(columns: dict[str, np.ndarray], maps: list[bytes], percent: int, forest: bool) -> Iterator[tuple]:
    """Pairs of one group: a chunk of a list with itself, or two chunks of it."""
    node, component, n = (columns[k] for k in ("node", "component", "n"))
    guest, chunk = columns["guest"], columns["chunk"]
    spanning = _Spanning(component)
    # Similar sets are of one size class or of neighbouring ones; bitmaps of a class differ little in width.
    size_class = np.floor(np.log(np.maximum(n, 1)) / _base(percent)).astype(np.int64)
    for k in np.unique(size_class).tolist():
        at = np.flatnonzero((size_class == k) | (size_class == k + 1))
        if len(at) < 2:
            continue
        words = [np.frombuffer(maps[m], np.uint64) for m in at]
        width = min(map(S.width_of, words))
        bits = np.stack([S.fold(m, width) for m in words])
        at_order = np.lexsort((bits[:, 0], n[at]))  # of equal sizes, relatives side by side
        at = at[at_order]
        for i, j in S.pairs(S.Tree(bits[at_order], n[at]), percent):
            i, j = at[i], at[j]
            ok = (component[i] != component[j]) & ~(guest[i] & guest[j]) & (
                (size_class[i] == k) | (size_class[j] == k))
            if columns["c1"][0] != columns["c2"][0]:
                ok &= chunk[i] != chunk[j]
            i, j = i[ok], j[ok]
            if forest:
                keep = spanning.new(i, j)
                i, j = i[keep], j[keep]
            yield np.minimum(node[i], node[j]), np.maximum(node[i], node[j])


GROUP = ("element", "class", "c1", "c2")


def _tree_pairs(percent: int, forest: bool):
    """Over rows sorted by group; at most one group and one batch are held."""
    def pairs_of(table: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        columns = {k: table[k].to_numpy() for k in table.column_names if k != "bitmap"}
        new = np.zeros(table.num_rows, bool)
        for k in GROUP:
            new[1:] |= columns[k][1:] != columns[k][:-1]
        cuts = np.concatenate([[0], np.flatnonzero(new), [table.num_rows] if last else []]).astype(int)
        maps = table["bitmap"].to_pylist()
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if (columns["component"][low:high] != columns["component"][low]).any():
                out += _group_pairs({k: v[low:high] for k, v in columns.items()}, maps[low:high], percent, forest)
        batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["a", "b"])
        return batch, table.slice(cuts[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            out, held = pairs_of(held, False)
            yield out
        if held is not None and held.num_rows:
            yield pairs_of(held, True)[0]

    return run


def _base(percent: int) -> float:
    """The logarithm of the largest ratio of similar sets' sizes."""
    return math.log(100 / percent) * (1 + 1e-9)


def candidate_pairs(lists: DataFrame, sets: DataFrame, percent: int, chunk: int = CHUNK,
                    forest: bool = False) -> DataFrame:
    """Pairs of different components that signature trees leave, from (element, node, component).

    With ``forest`` a group returns no more of them than join its components.
    """
    # Lists with the same members (by 128 bits) need one of them.
    shape = (lists.groupBy("element")
             .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                  F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("node")).alias("x"),
                  F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
             .filter("low <> high").groupBy("members", "x", "y").agg(F.min("element").alias("element"))
             .select("element", "members"))
    # A long list is dealt by size class, and a set visits the class below.
    long = F.col("members") > chunk
    rows = (lists.join(shape, "element").join(sets.select("node", "n"), "node")
            .withColumn("v", F.explode(F.when(long, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .withColumn("guest", F.col("v") == 1)
            .withColumn("class", F.when(long, F.floor(F.log("n") / _base(percent)).cast("int") - F.col("v")).otherwise(0))
            .select("element", "class", "node", "component", "n", "guest"))
    size = F.greatest(F.count(F.lit(1)) / chunk, F.sum("n") / ELEMENTS)
    counts = (rows.groupBy("element", "class")
              .agg(F.ceil(size).cast("int").alias("chunks"), F.min("guest").alias("visited"),
                   F.min("component").alias("low"), F.max("component").alias("high"))
              .filter("low <> high AND NOT visited").select("element", "class", "chunks"))
    cut = (rows.join(counts, ["element", "class"])
           .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .withColumn("c1", F.least("chunk", "other")).withColumn("c2", F.greatest("chunk", "other"))
           .select(*GROUP, "chunk", "node", "component", "n", "guest"))
    # Bitmaps are the wide part: they join last and travel once.
    cut = cut.join(sets.select("node", "bitmap"), "node")
    return (cut.repartition(*GROUP).sortWithinPartitions(*GROUP)
            .mapInArrow(_tree_pairs(percent, forest), "a bigint, b bigint").distinct())


class _Found(NamedTuple):
    """What joining and counting share: rows, their nodes, lists of relatives, sets of those."""

    listed: DataFrame
    lists: DataFrame
    sets: DataFrame


def _one_text_each(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, text), one row for each node of ``chosen`` (node, row_key, k).

    Only the nodes whose row is repeated (``k`` > 1) have their texts folded.
    """
    once = rows.join(chosen.filter("k = 1"), "row_key").select("node", "text")
    again = (rows.join(chosen.filter("k > 1"), "row_key").groupBy("node")
             .agg(F.first("text").alias("text")))
    return once.union(again)


def _relatives(docs: DataFrame, size: int, percent: int) -> _Found:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64("doc_id", "text").alias("row_key"))
    listed = materialize(members(rows, size))
    sizes = listed.filter("n > 0").select("node", "n").distinct()
    # Two passes over the texts send elements, 8 and 16 bytes each; nothing is kept of them but
    # those that occur again.
    index = prefixes(rows, size, percent, common_elements(rows, size))
    again = index.groupBy("element").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    hits = materialize(index.join(again, "element", "left_semi").distinct())
    # A similar set is smaller by the threshold at most, and that much less may be in common.
    least = 1 + F.floor(F.ceil(F.col("n") * percent / 100) * MORE_PERCENT / 100)
    related = (hits.groupBy("node").agg(F.count(F.lit(1)).alias("k")).join(sizes, "node")
               .filter(F.col("k") >= least).select("node"))
    near = materialize(hits.join(related, "node", "left_semi"))
    shared = (near.groupBy("element")
              .agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .filter("low <> high").select("element", "low"))
    lists = materialize(near.join(shared, "element").select("element", "node", "low"))
    del index, again, hits, related, near, shared

    chosen = materialize(
        listed.join(lists.select("node").distinct(), "node", "left_semi")
        .groupBy("node", "row_key").agg(F.count(F.lit(1)).alias("k"))
        .groupBy("node").agg(F.min(F.struct("row_key", "k")).alias("row")).select("node", "row.*"))
    return _Found(listed, lists, materialize(node_sets(_one_text_each(rows, chosen), size)))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) once the components that ``links`` join are one."""
    ends = labels.select("node", "component")
    edges = (links.join(ends.toDF("a", "ca"), "a").join(ends.toDF("b", "cb"), "b")
             .select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a <> b").distinct())
    joined = components(edges).toDF("component", "joined")
    return materialize(labels.join(joined, "component", "left")
                       .select("node", F.coalesce("joined", "component").alias("component")))


def _joined(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document: doc_id, row_key, n and c, the node that names its component."""
    listed, lists, sets = _relatives(docs, size, percent)
    firsts = lists.filter("node <> low")
    labels = _merged(sets.select("node", F.col("node").alias("component")), materialize(similar(
        firsts.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), sets, percent)))
    # Pairs with the first of a list are compared now, so it need not come again. First each group
    # offers as many pairs as could join its components, then all that are left between different ones.
    for forest in (True, False):
        labelled = firsts.join(labels, "node").select("element", "node", "component")
        offered = materialize(candidate_pairs(labelled, sets, percent, forest=forest))
        labels = _merged(labels, materialize(similar(offered, sets, percent)))
    return (listed.join(labels, "node", "left")
            .withColumn("c", F.coalesce("component", "node")).drop("component"))


def cluster(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    joined = _joined(docs, size, percent)
    # Texts without a word are alone, each under its own id.
    named = joined.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return (joined.filter("n > 0").join(named, "c").select(
                "doc_id", F.col("n").alias("n_shingles"), "component_id")
            .union(joined.filter("n = 0").select("doc_id", "n", "doc_id")))


def links(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """All pairs (a, b) of similar distinct sets, a < b, by node; inside components too."""
    return _links(_relatives(docs, size, percent), percent)


def _links(found: _Found, percent: int) -> DataFrame:
    # Each node its own component: no pair of a list is skipped.
    alone = found.lists.select("element", "node", F.col("node").alias("component"))
    return similar(materialize(candidate_pairs(alone, found.sets, percent)), found.sets, percent)


def link_counts(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id and n_links, the other rows that are similar to it.

    Rows with an equal set count; a text without words has none.
    """
    found = _relatives(docs, size, percent)
    nodes = found.listed.filter("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
    pairs = materialize(_links(found, percent))
    both = pairs.union(pairs.select("b", "a"))
    others = (both.join(nodes.toDF("b", "rows"), "b").groupBy("a").agg(F.sum("rows").alias("others"))
              .withColumnRenamed("a", "node"))
    counts = nodes.join(others, "node", "left").select(
        "node", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return (found.listed.filter("n > 0").join(counts, "node").select("doc_id", "n_links")
            .union(found.listed.filter("n = 0").select("doc_id", F.lit(0).cast("bigint"))))


def keep_one(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, and all without words.

    The one with the smallest id stays, of equal ids that with the smaller hash of id and text;
    a document without an id stays where no other one of its component has an id. All rows that
    repeat a kept id and its text stay; of rows without an id, which nothing tells apart, one.
    """
    names = fresh(docs.columns, "kept_id", "kept_key", "kept_empty")
    joined = _joined(docs, size, percent).select("doc_id", "row_key", "n", "c")
    first = (joined.filter("n > 0").groupBy("c")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("row"))
             .select("row.doc_id", "row.row_key", F.lit(False)))
    # Only ids and hashes are left of the join when the texts travel.
    kept = materialize(first.union(joined.filter("n = 0").select(
        "doc_id", "row_key", F.lit(True)).distinct())).toDF(*names)
    doc_id = docs["doc_id"].cast("bigint")
    key = F.xxhash64(doc_id, docs["text"])

    def stay(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        same = doc_id.eqNullSafe(chosen[names[0]]) & (key == chosen[names[1]])
        return rows.join(chosen, same, "left_semi")

    named = stay(docs, kept.filter(F.col(names[0]).isNotNull() | F.col(names[2])))
    nameless = stay(docs.filter(doc_id.isNull()),
                    kept.filter(F.col(names[0]).isNull() & ~F.col(names[2])))
    return named.union(nameless.dropDuplicates(["text"]))
