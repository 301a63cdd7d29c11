"""Near-duplicate classes by DartMinHash signatures and banded joining.

Texts are linked if the sets of their five-word shingles are alike by 0.8 or more (Jaccard).
Texts of the same shingles are one node, so copies never become pairs. Classes are the connected
components of the links.

1. Nodes that share a band meet in a bucket. All of a bucket are compared, as whole texts, with
   its leader; four orders of the nodes give a node several leaders. The pairs grow with the rows.
2. Components of the links found.
3. What could be missed are links between nodes of different components with a common leader.
   Leaders whose nodes lie in one component are done. The others' nodes are compared exactly, all
   but those of the largest component with all, and give only links that join components. A
   leader's nodes are cut into blocks, so no task holds more than two blocks of them.

Intermediate tables are written below the shared folder; what Spark joins, it can split.

A text of fewer than five words is one shingle; a text without words is alike its exact copies
only; null is empty. Repeated rows are members like any other. The class id is the smallest
doc_id in it, null if none has one. Texts are told apart by 64 bits of their shingles: among a
thousand million different texts the chance of one wrong pair is three in a hundred.

Very long texts are sketched like others, from all their shingles. An empty table gives no rows and
no classes. Other columns are ignored by the report and kept by keep_first, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailspark.llm.common import map_batches, own_columns, shuffle_width, strings, with_id
from mailspark.llm.dart_minhash import elements, shingle_hashes, similarity, sketch
from mailspark.llm.decontamination import words_of
from mailspark.session import scratch_dir

SIMILARITY = 0.8
ROUNDING = 1e-9
BLOCK_ROWS = 1500
BLOCK_BYTES = 4 * 1024 * 1024
LINKS_A_TASK = 100_000
SALTS = 16
# Four orders of the nodes, by flipping bits.
ORDERS = (0, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x14057B7EF767814F)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _few(df: DataFrame, rows: int, rows_a_task: int) -> DataFrame:
    """The rows in as few tasks as their number asks for, if that is less than a shuffle's."""
    tasks = max(1, -(-rows // rows_a_task))
    return df if tasks >= shuffle_width(df.sparkSession) else df.coalesce(tasks)


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits of a row's id and text."""
    return F.xxhash64(id_col, text_col), F.xxhash64(F.lit(1), text_col, id_col)


def sets_of(texts: list[str], counted: bool = False) -> list[np.ndarray]:
    return [elements(h, counted) for h in shingle_hashes([words_of(t) for t in texts])]


def sketch_rows(docs: DataFrame, text_col: str, id_col: str, counted: bool) -> DataFrame:
    """(doc_id, key1, key2, node, bands) of each row; narrow."""

    def run(batch: pa.RecordBatch) -> dict:
        found = sketch(strings(batch.column(3)), counted)
        return {
            "doc_id": batch.column(0), "key1": batch.column(1), "key2": batch.column(2),
            "node": [node for node, _ in found], "bands": [bands for _, bands in found],
        }

    key1, key2 = row_key("doc_id", "text")
    return map_batches(
        with_id(docs, text_col, id_col).select(
            "doc_id", key1.alias("key1"), key2.alias("key2"), "text"
        ),
        run,
        "doc_id bigint, key1 bigint, key2 bigint, node bigint, bands array<bigint>",
    )


def compare(pairs: DataFrame, texts: DataFrame, counted: bool) -> DataFrame:
    """(leader, node, alike) of each pair, from whole texts."""
    left = texts.select(F.col("node").alias("leader"), F.col("text").alias("text_a"))
    right = texts.select("node", F.col("text").alias("text_b"))

    def run(batch: pa.RecordBatch) -> dict:
        a, b = strings(batch.column(2)), strings(batch.column(3))
        unlike = list(dict.fromkeys([*a, *b]))
        sets = dict(zip(unlike, sets_of(unlike, counted)))
        return {
            "leader": batch.column(0), "node": batch.column(1),
            "alike": [similarity(sets[x], sets[y]) for x, y in zip(a, b)],
        }

    both = pairs.join(right, "node").join(left, "leader").select(
        "leader", "node", "text_a", "text_b"
    )
    return map_batches(both, run, "leader bigint, node bigint, alike double")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in links (a, b): the least node that can be reached. Labels
    spread along links and jump to their label's label until none changes.

    Each turn's labels are written, so Spark knows their size: small ones are sent to the links
    instead of both being shuffled.
    """
    size = 2 * links.count()

    def written(df: DataFrame, label: str) -> DataFrame:
        return _written(_few(df, size, LINKS_A_TASK), label)

    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = written(links.select("a", "b").unionByName(back).distinct(), "edges")
    label = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")),
        "component",
    )
    while True:
        heard = (
            edges.join(label.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        nearer = heard.join(label, "node").select(
            "node", "component", F.least("component", "heard").alias("near")
        )
        onward = label.select(F.col("node").alias("near"), F.col("component").alias("far"))
        least = F.least("near", "far")
        moved = written(
            nearer.join(onward, "near").select(
                "node", least.alias("component"), (least < F.col("component")).alias("changed")
            ),
            "component",
        )
        label = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return label


def joining_links(
    nodes: list[int], component: list[int], second: list[bool], sets: list[np.ndarray], alike: float
) -> list[tuple[int, int]]:
    """Links between nodes of different components, as few as join what can be joined.

    If `second` marks some nodes, they are the other block and only links across are sought. The
    sets that hold a shingle are found in one sorted list of all shingles, so comparing one node
    with all others is one pass over the places its shingles share.
    """
    parent: dict[int, int] = {c: c for c in component}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    largest = Counter(component).most_common(1)[0][0]
    sizes = np.array([len(s) for s in sets])
    shingles = np.concatenate(sets)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], np.repeat(np.arange(len(sets)), sizes)[order]
    across, other = any(second), np.array(second)
    links = []
    for y, own in enumerate(sets):
        if component[y] == largest or not len(own):
            continue
        first = np.searchsorted(shingles, own, "left")
        n = np.searchsorted(shingles, own, "right") - first
        places = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(owner[places], minlength=len(sets))
        near = shared >= (alike - ROUNDING) * (sizes[y] + sizes - shared)
        near[y] = False
        if across:
            near &= other != other[y]
        for x in np.flatnonzero(near).tolist():
            a, b = root(component[x]), root(component[y])
            if a != b:
                parent[a] = b
                links.append((nodes[y], nodes[x]))
    return links


def links_left(
    compared: DataFrame, label: DataFrame, texts: DataFrame, alike: float, counted: bool
) -> DataFrame:
    """Links (a, b) between different components among the nodes of one leader."""
    leaders = compared.select("leader").distinct()
    members = (
        compared.select("leader", "node")
        .unionByName(leaders.select("leader", F.col("leader").alias("node")))
        .join(label, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    sized = members.join(
        texts.select("node", F.octet_length("text").alias("size")), "node"
    )
    # a leader and one node were compared already, and so were nodes of one component
    mixed = (
        sized.groupBy("leader")
        .agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.count("*").alias("n"), F.sum("size").alias("bytes"),
        )
        .where("low != high and n > 2")
        .select(
            "leader",
            F.ceil(
                F.greatest(F.col("n") / F.lit(BLOCK_ROWS), F.col("bytes") / F.lit(BLOCK_BYTES))
            ).cast("int").alias("blocks"),
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
        )
    )
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    dealt = (
        members.withColumn("salt", salt)
        .join(mixed, ["leader", "salt"])  # a leader may have a third of all nodes
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "leader", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "own", "node", "component",
        )
    )
    dealt = _written(dealt, "dealt")
    by_block = (
        dealt.join(texts, "node")
        .select("leader", "low", "high", "own", "node", "component", "text")
        # no number: many small partitions are read as few
        .repartition("leader", "low", "high")
    )
    grouped = _few(by_block, dealt.count(), BLOCK_ROWS).sortWithinPartitions(
        "leader", "low", "high", "node"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for *key, own_block, node, component, text in zip(*columns, strings(batch.column(6))):
                if key != now:
                    yield from found(held, now)
                    held, now = [], key
                held.append((node, component, own_block, text))
        yield from found(held, now)

    def found(held: list[tuple], key) -> Iterator[pa.RecordBatch]:
        if len({component for _, component, _, _ in held}) < 2:
            return
        nodes, component, block, text = (list(x) for x in zip(*held))
        second = [key[1] != key[2] and b == key[2] for b in block]
        links = joining_links(nodes, component, second, sets_of(text, counted), alike)
        if links:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.int64()) for x in zip(*links)], names=["a", "b"]
            )

    return grouped.mapInArrow(run, "a bigint, b bigint")


def find_classes(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    alike: float = SIMILARITY,
    counted: bool = False,
) -> DataFrame:
    """(doc_id, key1, key2, class_id, first) of each row; first marks the rows equal to the
    class's first row, by doc_id, in which null comes last. `counted` weighs shingles by their
    counts."""
    rows = _written(sketch_rows(docs, text_col, id_col, counted), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key1", "key2"))
    nodes = _written(
        rows.groupBy("node").agg(first.alias("first"), F.first("bands").alias("bands")), "nodes"
    )
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    order = F.get(F.array(*[F.lit(x) for x in ORDERS]), F.pmod("bucket", F.lit(4)).cast("int"))
    leaders = (
        banded.groupBy("bucket")
        .agg(F.min(F.col("node").bitwiseXOR(order)).alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("bucket", F.col("least").bitwiseXOR(order).alias("leader"))
    )
    pairs = _written(
        banded.join(leaders, "bucket").where("node != leader").select("leader", "node").distinct(),
        "pairs",
    )
    # one row for each node that meets another, with the whole text of its first row
    wanted = pairs.select(F.explode(F.array("leader", "node")).alias("node")).distinct().join(
        nodes.select("node", F.col("first.key1").alias("key1"), F.col("first.key2").alias("key2")),
        "node",
    )
    key1, key2 = row_key("doc_id", "text")
    texts = _written(
        with_id(docs, text_col, id_col)
        .select("text", key1.alias("key1"), key2.alias("key2"))
        .join(wanted, ["key1", "key2"])
        .select("node", "text")
        .dropDuplicates(["node"]),
        "texts",
    )
    compared = _written(compare(pairs, texts, counted), "compared")
    linked = compared.where(F.col("alike") >= alike - ROUNDING).select(
        F.col("leader").alias("a"), F.col("node").alias("b")
    )
    label = components(linked)
    left = _written(links_left(compared, label, texts, alike, counted), "links")
    # the links left join components, so labels of labels are enough
    at_a, at_b = (
        label.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab"
    )
    joined = components(
        left.join(at_a, "a", "left").join(at_b, "b", "left").select(
            F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")
        )
    ).withColumnRenamed("node", "near").withColumnRenamed("component", "far")
    known = (
        nodes.select("node", "first")
        .join(label, "node", "left")
        .withColumn("near", F.coalesce("component", "node"))
        .join(joined, "near", "left")
        .select("node", "first", F.coalesce("far", "near").alias("component"))
    )
    heads = known.groupBy("component").agg(F.min("first").alias("head"))
    node_class = known.join(heads, "component").select("node", "head")
    return rows.join(node_class, "node").select(
        "doc_id",
        "key1",
        "key2",
        F.col("head.doc_id").alias("class_id"),
        ((F.col("key1") == F.col("head.key1")) & (F.col("key2") == F.col("head.key2"))).alias(
            "first"
        ),
    )


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, class_id) of each row."""
    return find_classes(docs, text_col, id_col).select("doc_id", "class_id")


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents, with their own columns, without near-duplicates: the first row of each
    class stays, once."""
    kept = (
        find_classes(docs, text_col, id_col)
        .where("first")
        .select(F.col("key1").alias("__kept1"), F.col("key2").alias("__kept2"))
        .distinct()
    )
    keyed = docs.withColumns(
        {"__id": F.col(id_col).cast("bigint"), "__text": F.col(text_col).cast("string")}
    )
    key1, key2 = row_key("__id", "__text")
    keyed = keyed.withColumns({"__key1": key1, "__key2": key2})
    same = (F.col("__key1") == F.col("__kept1")) & (F.col("__key2") == F.col("__kept2"))
    return (
        keyed.join(kept, same, "left_semi")
        .dropDuplicates(["__key1", "__key2"])
        .select(*own_columns(docs))
    )
