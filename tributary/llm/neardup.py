"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal shingle sets form a class; classes are joined. Independent trees recurse from a
root that holds all classes: a node sends each member to one child per chosen minwise coordinate,
named by the member's minimum there. The root chooses one coordinate for each tree.

* Nodes up to ``LEAF`` members are compared exhaustively, on sketches of a byte a coordinate.
* Larger ones branch on, by ``WAYS`` coordinates that no tree begins with. Such a node first compares its members
  with one of them, its hub: what is alike already is in one cluster, and a node within one cluster is done.
* What is still large after the last level is compared block by block, so no pair of such a node is left out.

These comparisons name members that have likely partners, not pairs: a node gives fewer rows than it has
members. Clusters of such members are then compared on their full sets, block by block within a task. In
clusters of several blocks all members meet a few hubs first. Those so found to be one component need not
meet each other: only the others meet them, and each other.

A pair at the threshold shares a node of one tree's first level with probability 3/4, so ``TREES`` trees miss
it with (1/4) ** TREES = 4e-9 where nodes are small. Where all are large, the branching process (each of
two children is shared with probability 3/4) dies out in a tree with 0.11 at most, so that all
trees miss it with 1e-8 (0.33 ** 14, with the first level) if their coordinates were independent. ``SHARED``
misses 3e-6 in either case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.graph import components
from tributary.llm.tables import Stage
from tributary.llm.tokens import chunks, mix, words_of

SHINGLE, SIMILARITY = 5, 75
#: Independent trees, minwise coordinates, members compared exhaustively, levels, coordinates by which large nodes branch.
TREES, COORDINATES, LEAF, LEVELS, WAYS = 14, 40, 4096, 6, 2
#: Members of a block that are compared on sketches; a task holds two blocks at a time.
SKETCH_BLOCK = 2048
#: Members, and shingles where they are many, of a block that is compared on full sets; hubs of a cluster of several blocks.
BLOCK, BLOCK_SHINGLES, HUBS = 512, 1 << 19, 8
#: Bytes of text that a task works on at once.
CHUNK = 1 << 20
#: Coordinates that must agree before two sets are compared in full. Of 40, a pair at the threshold
#: has fewer than 14 with probability 2e-7.
AGREE = 14
#: Trees in which a class must share its first node with another; a pair at the threshold shares
#: fewer than 3 of 14 with probability 3e-6.
SHARED = 3

_SEEDS = np.random.default_rng(611953).integers(1, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = np.uint64(0xC4CEB9FE1A85EC53)


def _sets(data: np.ndarray, at: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each text's begin."""
    words = words_of(data, at, lower=True)
    hashes, doc, _ = words.windows(shingle)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    hashes, doc = np.concatenate([hashes, words.whole(short)]), np.concatenate([doc, short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(at)))


def _digests(hashes: np.ndarray, starts: np.ndarray) -> pa.Array:
    """128 bits that name a set; null for the empty one."""
    sizes = np.diff(starts)
    some = np.flatnonzero(sizes)
    digest = np.zeros((len(sizes), 2), np.uint64)
    if len(some):
        digest[some, 0] = np.add.reduceat(mix(hashes + np.uint64(1)), starts[:-1][some])
        digest[some, 1] = np.add.reduceat(mix(hashes * np.uint64(3)), starts[:-1][some])
    return pa.array([d.tobytes() if n else None for d, n in zip(digest, sizes)], pa.binary())


def _least(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise coordinates of each set, a row each; zeros for the empty one."""
    sizes = np.diff(starts)
    some = np.flatnonzero(sizes)
    cut = starts[:-1][some]
    least = np.zeros((len(sizes), COORDINATES), np.int32)
    if len(some):
        for c, seed in enumerate(_SEEDS):
            x = hashes * seed
            x ^= x >> np.uint64(32)
            x *= _LAST
            top = np.minimum.reduceat(x, cut) >> np.uint64(32)
            least[some, c] = top.astype(np.uint32).view(np.int32)
    return least


def _lists(least: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, least.size + 1, COORDINATES, dtype=np.int32), least.ravel())


def _bytes(least: np.ndarray) -> pa.Array:
    """One byte of each coordinate: equal coordinates have equal ones, others with 1/256."""
    return pa.array([row.tobytes() for row in (least & 0xFF).astype(np.uint8)], pa.binary())


def _sketch(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [("id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("least", pa.list_(pa.int32())), ("sketch", pa.binary()), ("tag", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in chunks(batch.column(2), CHUNK):
                hashes, starts = _sets(data, at, shingle)
                least = _least(hashes, starts)
                id_, key, tag = (batch.column(k).slice(first, end - first).cast(pa.int64()) for k in (0, 1, 3))
                columns = [id_, key, pa.array(np.diff(starts), pa.int64()), _digests(hashes, starts), _lists(least), _bytes(least), tag]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _full_sets(shingle: int, others: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the shingle hashes of ``text``; rows whose set is not that of class ``cls`` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, at in chunks(batch.column("text"), CHUNK):
                hashes, starts = _sets(data, at, shingle)
                part = batch.slice(first, end - first)
                sets = pa.ListArray.from_arrays(starts.astype(np.int32), hashes.view(np.int64))
                own = pc.fill_null(pc.equal(_digests(hashes, starts), part.column("cls").cast(pa.binary())), False)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), sets], [*others, "hashes"]).filter(own)

    return run


def _rows(table: pa.RecordBatch) -> tuple[pa.StructArray, list[tuple[int, int]], list[np.ndarray]]:
    """The rows of list column ``m``, where each list begins and ends, and sketch, n, label, side."""
    lists = table.column("m")
    ends, rows = lists.offsets.to_numpy(), lists.values
    columns = [rows.field(f).to_numpy(zero_copy_only=False) for f in ("n", "label", "side")]
    sketches = rows.field("sketch")
    data = np.frombuffer(sketches.buffers()[2], np.uint8) if len(sketches) else np.zeros(0, np.uint8)
    first = sketches.offset and int(np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset])
    data = data[first : first + COORDINATES * len(sketches)].reshape(-1, COORDINATES)
    return rows, list(zip(ends[:-1].tolist(), ends[1:].tolist())), [data, *columns]


def _partners(k: int, sketch: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Members after k that may be similar to k and are of another component."""
    far = slice(k + 1, None)
    other = (label[far] != label[k]) & ((side[far] != side[k]) | (side[k] == 0))
    other &= 100 * np.minimum(n[far], n[k]) >= SIMILARITY * np.maximum(n[far], n[k])
    at = np.flatnonzero(other) + k + 1
    return at[(sketch[at] == sketch[k]).sum(axis=1) >= AGREE] if len(at) else at


def _near(table: pa.RecordBatch) -> list[pa.Array]:
    """Members of each list that have a likely partner, with a label that likely partners share."""
    rows, spans, columns = _rows(table)
    found, roots = [], []
    for lo, hi in spans:
        sketch, n, label, side = (c[lo:hi] for c in columns)
        root, some = label.copy(), np.zeros(hi - lo, bool)
        for k in range(hi - lo - 1):
            partners = _partners(k, sketch, n, root, side)
            if len(partners):
                some[k] = some[partners] = True
                _merge(root, k, partners)
        at = np.flatnonzero(some)
        # The smallest label names what is connected, so that nodes of several trees give the same name.
        names, which = np.unique(root[at], return_inverse=True)
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, which, label[at])
        found.append(at + lo)
        roots.append(least[which])
    taken = np.concatenate(found) if found else np.zeros(0, np.int64)
    root = np.concatenate(roots) if roots else np.zeros(0, np.int64)
    return [rows.field("cls").take(pa.array(taken)), pa.array(columns[2][taken]), pa.array(root)]


def _merge(root: np.ndarray, k: int, others: np.ndarray) -> list[int]:
    """Gives the roots of the others to k's; the roots that are replaced."""
    gone = np.unique(root[others])
    gone = gone[gone != root[k]]
    if len(gone):
        root[np.isin(root, gone)] = root[k]
    return gone.tolist()


def _linked(table: pa.RecordBatch) -> list[pa.Array]:
    """Labels that similar members of each list connect, by their full sets in ``hashes``.

    What is connected already is not compared, so a list gives fewer links than it has members.
    """
    rows, spans, columns = _rows(table)
    sets = rows.field("hashes")
    ends, hashes = sets.offsets.to_numpy(), sets.values.to_numpy()
    left, right = [], []
    for lo, hi in spans:
        sketch, n, label, side = (c[lo:hi] for c in columns)
        cut = ends[lo : hi + 1] - ends[lo]
        codes = np.unique(hashes[ends[lo] : ends[hi]], return_inverse=True)[1]
        marked, root = np.zeros(len(codes), bool), label.copy()
        for k in range(hi - lo - 1):
            partners = _partners(k, sketch, n, root, side)
            if not len(partners):
                continue
            mine = codes[cut[k] : cut[k + 1]]
            marked[mine] = True
            if len(partners) < 16:
                common = np.array([np.count_nonzero(marked[codes[cut[p] : cut[p + 1]]]) for p in partners.tolist()])
            else:
                first = cut[k + 1]
                common = np.add.reduceat(marked[codes[first:]], cut[k + 1 : -1] - first, dtype=np.int64)[partners - k - 1]
            marked[mine] = False
            own = root[k]
            for gone in _merge(root, k, partners[100 * common >= SIMILARITY * (n[partners] + n[k] - common)]):
                left.append(own)
                right.append(gone)
    return [pa.array(left, pa.int64()), pa.array(right, pa.int64())]


def _by_lists(
    work: Callable[[pa.RecordBatch], list[pa.Array]], names: list[str], lists: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, lists):
                yield pa.RecordBatch.from_arrays(work(_compact(batch.slice(k, lists))), names)

    return run


def _compact(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The same rows without those of the batch that it was cut from."""
    return batch.take(pa.array(np.arange(batch.num_rows)))


_NEAR = "cls binary, label bigint, root bigint"
_MEMBER = ("cls", "n", "sketch", "label", "side")


def _lists_of(rows: DataFrame, group: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*group).agg(F.collect_list(F.struct(*columns)).alias("m")).select("m")


def _met(members: DataFrame, group: str, columns: tuple[str, ...]) -> DataFrame:
    """Lists ``m`` in which each two members of a group meet: it is cut into ``blocks``, and each two blocks meet."""
    cut = members.withColumn("block", F.pmod(F.xxhash64("cls", group), "blocks").cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    met = met.select("*", side.alias("side"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return _lists_of(met, (group, "i", "j"), columns)


def _compared(nodes: DataFrame) -> DataFrame:
    """(cls, label, root) of the members (node, size, cls, n, sketch, label) that have a likely partner in their node."""
    lists = _met(nodes.withColumn("blocks", F.ceil(F.col("size") / SKETCH_BLOCK).cast("int")), "node", _MEMBER)
    return lists.mapInArrow(_by_lists(_near, ["cls", "label", "root"], 64), _NEAR)


def _with_size(members: DataFrame) -> DataFrame:
    """Members of nodes that have two or more."""
    return members.join(members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), "node")


def _like_hub(large: DataFrame) -> DataFrame:
    """(cls, label, root) of members of large nodes that are likely partners of the hub of their node, and of the hub."""
    hub = F.min(F.struct(F.xxhash64("cls", "node").alias("o"), *(F.col(c) for c in ("cls", "n", "sketch", "label"))))
    hubs = large.groupBy("node").agg(hub.alias("hub"), F.count("*").alias("size"))
    # A block of members and the hub of the node are a list.
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = large.withColumn("block", F.pmod(F.xxhash64("cls", "node"), F.ceil(F.col("size") / BLOCK)).cast("int")).withColumn("side", F.lit(2))
    copies = hubs.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    copies = copies.select("node", "block", "hub.*").withColumn("side", F.lit(1))
    both = own.select("node", "block", *_MEMBER).unionByName(copies.select("node", "block", *_MEMBER))
    return _lists_of(both, ("node", "block"), _MEMBER).mapInArrow(_by_lists(_near, ["cls", "label", "root"], 64), _NEAR)


def _children(members: DataFrame, level: int) -> DataFrame:
    """(node, cls) one level down: members (node, cls, least) go by ``WAYS`` coordinates that the node draws."""
    sent = members.withColumn("way", F.explode(F.sequence(F.lit(1), F.lit(WAYS))))
    # Two ways of a node are two coordinates.
    drawn = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(COORDINATES - TREES)) + F.col("way") * 7
    at = TREES + 1 + F.pmod(drawn, F.lit(COORDINATES - TREES))
    return sent.select(F.xxhash64("node", "way", F.element_at("least", at.cast("int"))).alias("node"), "cls")


def _likely(classes: DataFrame, stage: Stage) -> DataFrame:
    """(cls, label, root) of all classes that have a likely partner; likely partners are connected by roots."""
    roots = classes.select("cls", F.posexplode(F.slice("least", 1, TREES)).alias("tree", "value"))
    members = stage.table(roots.select(F.xxhash64("tree", "value").alias("node"), "cls"), "members0")
    facts = classes.select("cls", "n", "sketch", F.xxhash64("cls").alias("label"))
    sized = _with_size(members)
    # The nodes of a class, at most one for each tree.
    often = sized.groupBy("cls").agg(F.collect_list(F.struct("node", "size")).alias("nodes")).where(F.size("nodes") >= SHARED)
    inside = stage.table(often.join(facts, "cls").select("cls", "n", "sketch", "label", F.inline("nodes")), "inside0")
    near = stage.table(_compared(inside.where(F.col("size") <= LEAF)).distinct(), "near0")
    for level in range(1, LEVELS + 1):
        large = inside.where(F.col("size") > LEAF)
        if large.isEmpty():
            return near
        alike = stage.table(near.union(_like_hub(large)).distinct(), f"alike{level}")
        clusters = _clusters(alike, stage, f"clusters{level}")
        placed = large.join(clusters, "label", "left").withColumn("cluster", F.coalesce("cluster", "label"))
        open_ = placed.groupBy("node").agg((F.min("cluster") != F.max("cluster")).alias("open")).where("open").select("node")
        rest = large.join(open_, "node")
        if level < LEVELS:
            least = classes.select("cls", "least")
            sent = stage.table(_children(rest.select("node", "cls").join(least, "cls"), level), f"members{level}")
            inside = stage.table(_with_size(sent).join(facts, "cls"), f"inside{level}")
            found = _compared(inside.where(F.col("size") <= LEAF))
        else:
            found = _compared(rest)
        near = stage.table(alike.union(found).distinct(), f"near{level}")
    return near


def _clusters(near: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(label, cluster): labels that roots connect."""
    ends = stage.table(near.select(F.col("label").alias("a"), F.col("root").alias("b")).where("a <> b").distinct(), f"{name}-ends")
    return components(ends, stage, f"{name}-cc").select(F.col("v").alias("label"), F.col("label").alias("cluster"))


_LINKS = "a bigint, b bigint"


def _links(lists: DataFrame) -> DataFrame:
    return lists.mapInArrow(_by_lists(_linked, ["a", "b"], 16), _LINKS)


def _labels(classes: DataFrame, source: DataFrame, rows: DataFrame, stage: Stage, shingle: int) -> DataFrame:
    """(cls, label) of the classes that are linked with another; classes of one component share a label.

    Each full set is sent once for each block that its cluster's other members fill, not once for each pair.
    """
    near = _likely(classes, stage)
    stage.drop("members", "inside", "alike", "clusters")
    clusters = _clusters(near, stage, "near")
    members = near.select("cls", "label").distinct().join(clusters, "label").join(classes.select("cls", "n", "sketch", "key"), "cls")
    members = stage.table(members, "near-members")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("cluster").agg(blocks.alias("blocks"))
    whole = stage.table(_with_sets(members.join(sizes, "cluster"), source, rows, shingle), "whole")
    set_ = (*_MEMBER, "hashes")
    one = whole.where("blocks = 1").withColumn("side", F.lit(0))
    small = stage.table(_links(_lists_of(one, ("cluster",), set_)).distinct(), "small-links")
    labels = members.select("cls", "label")
    large = whole.where("blocks > 1")
    if not large.isEmpty():
        labels = _merged(labels, stage.table(_links(_lists_of(_with_hubs(large), ("cluster", "block"), set_)).distinct(), "hub-links"), stage, "hubs")
        now = large.drop("label").join(labels, "cls")
        # No cluster holds labels of another, so those of small clusters are still the ones that they came with.
        small = small.union(stage.table(_links(_lists_of(_apart(now, stage), ("cluster", "i", "j"), set_)).distinct(), "large-links"))
    return _merged(labels, small, stage, "all")


def _with_hubs(large: DataFrame) -> DataFrame:
    """Members by (cluster, block) on side 2, and the hubs of their cluster in each block on side 1."""
    first = Window.partitionBy("cluster").orderBy(F.xxhash64("cls", "cluster"), "cls")
    hubs = large.withColumn("place", F.row_number().over(first)).where(F.col("place") <= HUBS).drop("place")
    copies = hubs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    own = large.withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int")).withColumn("side", F.lit(2))
    return own.unionByName(copies)


def _apart(large: DataFrame, stage: Stage) -> DataFrame:
    """Members by (cluster, i, j) so that each two of unlike labels meet, but for those of the largest label of a cluster.

    Of a cluster the ``mains`` blocks of its largest label come first, then the ``rests`` blocks of all others. A block of
    the former meets those of the latter only, and these all blocks.
    """
    weight = F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    counted = large.groupBy("cluster", "label").agg(weight.alias("weight"))
    sizes = counted.groupBy("cluster").agg(F.max(F.struct("weight", "label")).alias("main"), F.sum("weight").alias("all"))
    rests = F.ceil(F.round(F.col("all") - F.col("main.weight"), 6)).cast("int")
    sizes = sizes.select("cluster", F.col("main.label").alias("main"), F.ceil("main.weight").cast("int").alias("mains"), rests.alias("rests"))
    sizes = stage.table(sizes.where("rests > 0"), "sides")
    cut = large.join(sizes, "cluster").withColumn("is_main", F.col("label") == F.col("main"))
    own = F.when(F.col("is_main"), F.pmod(F.xxhash64("cls"), "mains")).otherwise(F.col("mains") + F.pmod(F.xxhash64("cls"), "rests")).cast("int")
    cut = cut.withColumn("block", own)
    first = F.when(F.col("is_main"), F.col("mains")).otherwise(F.lit(0))
    met = cut.withColumn("other", F.explode(F.sequence(first, F.col("mains") + F.col("rests") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    return met.select("*", side.alias("side"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _with_sets(members: DataFrame, source: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """Members with the hashes of their full sets, from the text of one row of each class."""
    texts = source.select("key", "text").join(members, "key")
    if not rows.groupBy("key").count().where("count > 1").isEmpty():
        # Rows that share an id or a text: one text for each class and text is enough, of each task first.
        others = [F.first(c).alias(c) for c in members.columns if c not in ("key", "cls")]
        texts = texts.groupBy("cls", F.xxhash64("text").alias("tag")).agg(F.first("text").alias("text"), *others)
    names = ["cluster", "blocks", "cls", "n", "sketch", "label"]
    sets = texts.select("text", *names).mapInArrow(
        _full_sets(shingle, names), "cluster long, blocks int, cls binary, n long, sketch binary, label long, hashes array<bigint>"
    )
    return sets


def _sketched(docs: DataFrame, id_col: str, text_col: str, shingle: int, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """The source as (id, key, text) and a row (id, key, n, cls, least, sketch) for each of its rows. The key is
    the id; rows without one have a hash of their text."""
    text = F.col(text_col).cast("string").alias("text")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("key"), text)
    sql = "id long, key long, n long, cls binary, least array<int>, sketch binary, tag long"
    tagged = source.withColumn("tag", F.xxhash64("text"))
    return source, stage.table(tagged.mapInArrow(_sketch(shingle), sql), "rows")


def _components(rows: DataFrame, source: DataFrame, stage: Stage, shingle: int) -> DataFrame:
    """(cls, least_id, component): the smallest id of the component of each class, and a number that names it."""
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.min("key").alias("key"), F.min("id").alias("id"), F.max("n").alias("n"), F.first("least").alias("least"), F.first("sketch").alias("sketch")
    )
    classes = stage.table(classes, "classes")
    labels = _labels(classes, source, rows, stage, shingle)
    own = F.coalesce("label", F.xxhash64("cls"))
    named = stage.table(classes.select("cls", "id").join(labels, "cls", "left").select("cls", "id", own.alias("component")), "named")
    least = named.groupBy("component").agg(F.min("id").alias("least_id"))
    return stage.table(named.select("cls", "component").join(least, "component"), "components")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Groups of documents linked by word shingles: ``100 * common >= 75 * union``.

    Letters A-Z count as lower case. A document with fewer words than a shingle has its whole word
    sequence as the only one. Returns a row per input row: id, ``n_shingles``, ``component_id`` (the
    smallest id of the group, its own if alone) and ``kept``. Null and wordless texts have no
    shingles and are linked with nothing. Rows without an id join groups but name one only if all
    its ids are null. Rows with the same id are compared by their own texts. Other columns are not
    carried along. An empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession)
    source, rows = _sketched(docs, id_col, text_col, shingle, stage)
    found = _components(rows, source, stage, shingle).select("cls", "least_id")
    stage.keep("rows", "components")
    component = F.coalesce("least_id", "id")
    return rows.select("id", "n", "cls").join(found, "cls", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of ``near_duplicates``, with all columns whatever their names.

    It is the row with the smallest id, null last; of several texts of that id in the group that with the
    smallest hash, of rows equal in id and text any one. Texts of one id that are not alike are groups
    of their own. Rows without words stay, all of them. An empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession)
    source, rows = _sketched(docs, id_col, text_col, shingle, stage)
    found = _components(rows, source, stage, shingle).select("cls", "component")
    placed = rows.select("id", "tag", "cls").join(found, "cls").groupBy("component", "id", "tag").agg(F.count("*").alias("rows"))
    placed = stage.table(placed, "placed")
    # The best first: a struct compares field by field.
    best = placed.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("best"))
    judged = placed.join(best, "component").withColumn("stays", F.col("id").eqNullSafe(F.col("best.id")) & (F.col("tag") == F.col("best.tag")))
    judged = stage.table(judged.select("id", "tag", "rows", "stays"), "judged")
    stage.keep("judged")
    own = docs.select(
        F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("tag"),
    )

    def like(other: DataFrame, how: str, rows: DataFrame = own) -> DataFrame:
        key = other.select(F.col("id").alias("other_id"), F.col("tag").alias("other_tag"))
        return rows.join(key, F.col("id").eqNullSafe(F.col("other_id")) & (F.col("tag") == F.col("other_tag")), how)

    kept = like(judged.where("not stays"), "left_anti")
    again = judged.where("stays and rows > 1")
    if not again.isEmpty():
        once = like(again, "left_semi", kept).groupBy("id", "tag").agg(F.first("row").alias("row"))
        kept = like(again, "left_anti", kept).select("row").union(once.select("row"))
    return kept.select("row.*")


def _merged(labels: DataFrame, ends: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Labels after joining those that the links (a, b) between labels connect."""
    if ends.isEmpty():
        return labels
    found = components(ends, stage, f"{name}-cc").select(F.col("v").alias("label"), F.col("label").alias("lower"))
    return stage.table(labels.join(found, "label", "left").select("cls", F.coalesce("lower", "label").alias("label")), f"{name}-labels")
