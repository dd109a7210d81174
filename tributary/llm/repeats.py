"""Substring dedup: repeated windows of words, found by Rabin-Karp hashes counted in Spark.

Three steps, two shuffles, every part bounded whatever the data:

1. Each task hashes every window of its documents and combines them: of equal windows only those
   of its smallest document go on; the others are settled, since a smaller document has the same
   words. A passage that a third of the corpus shares so costs one entry a task, not one a document.
2. Hash ranges meet the entries of all tasks; all but those of the smallest document are settled.
3. Settled windows go to their documents, overlapping ones merge into removal intervals, and the
   remaining words are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.blobs import pack, unpack
from tributary.llm.tables import parts_for
from tributary.llm.tokens import chunks, words_of

WINDOW = 13
#: Windows combined in a task before they are sent on (about 100 MB), bytes of text in a hash range
#: or a group of documents. They set how the work is cut, never the result.
COMBINE, RANGE_BYTES, GROUP_BYTES = 2_000_000, 12 << 20, 8 << 20
#: Copies of a row without an id that are written from one array.
COPIES = 10_000

_FOUND = pa.schema(
    [("kind", pa.int8()), ("part", pa.int32()), ("n", pa.int32()), ("docs", pa.int32()), ("blob", pa.binary())]
)
_FOUND_SQL = "kind tinyint, part int, n int, docs int, blob binary"
_NO_ID = np.iinfo(np.int64).max


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _FOUND]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _ids(column: pa.Array) -> np.ndarray:
    """Ids; rows without one count as larger than all others."""
    return column.cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _group(ids: np.ndarray, tags: np.ndarray, groups: int) -> np.ndarray:
    """As ``_GROUP_SQL``: by id, rows without one by the checksum of their text."""
    ids = np.where(ids == _NO_ID, tags.astype(np.int64), ids)
    return ((ids ^ (ids.view(np.uint64) >> np.uint64(7)).view(np.int64)) % groups).astype(np.int32)


_KEY_SQL = f"if(coalesce(id, {_NO_ID}L) = {_NO_ID}L, coalesce(crc32(cast(text as binary)), 0L), id) key"
#: An odd number of groups, so that ids with a common power of two still spread.
_GROUP_SQL = "cast(pmod(key ^ shiftrightunsigned(key, 7), {}) as int) g"


def _settled(ids: np.ndarray, tags: np.ndarray, doc: np.ndarray, place: np.ndarray, groups: int) -> list[tuple]:
    """Windows to remove, packed by group of documents. ``doc`` are places in ``ids``."""
    rows = []
    if not len(doc):
        return rows
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    used, doc = np.unique(doc, return_inverse=True)
    part = _group(ids[used], tags[used], groups)
    by = np.argsort(part, kind="stable")
    counts = np.bincount(doc, minlength=len(used))
    ends = np.cumsum(counts)
    for g, mine in zip(*_runs(part[by], by)):
        n = counts[mine]
        at = np.concatenate([np.arange(e - c, e) for e, c in zip(ends[mine], n)])
        steps = np.diff(place[at], prepend=0).astype(np.int64)
        head = pack(ids[used[mine]].astype(np.int64), tags[used[mine]], n.astype(np.uint32))
        body = pack((steps & 0xFFFFFFFF).astype(np.uint32))
        rows.append((1, int(g), len(at), len(mine), len(head).to_bytes(4, "little") + head + body))
    return rows


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate([[0], cuts])], np.split(values, cuts)


def _split_smallest(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Of sorted hashes: which entries do not belong to the smallest owner of their hash."""
    heads = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    starts = np.flatnonzero(heads)
    least = np.minimum.reduceat(owner, starts) if len(starts) else owner
    return owner != np.repeat(least, np.diff(np.append(starts, len(hashes))))


def _map(window: int, ranges: int, groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flush(ids: list, tags: list, hashes: list, doc: list, place: list) -> pa.RecordBatch:
        ids, tags, hashes, doc, place = (np.concatenate(x) for x in (ids, tags, hashes, doc, place))
        order = np.argsort(hashes)
        hashes, doc, place = hashes[order], doc[order], place[order]
        late = _split_smallest(hashes, ids[doc])
        rows = _settled(ids, tags, doc[late], place[late], groups)
        hashes, doc, place = hashes[~late], doc[~late], place[~late]
        head = pack(ids.astype(np.int64), tags)
        head = len(head).to_bytes(4, "little") + head
        part = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
        if len(part):
            for p, at in zip(*_runs(part, np.arange(len(part)))):
                body = pack(np.diff(hashes[at], prepend=np.uint64(0)), doc[at].astype(np.uint32), place[at].astype(np.uint32))
                rows.append((0, int(p), len(at), len(ids), head + body))
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, n = [[], [], [], [], []], 0, 0
        for batch in batches:
            ids = _ids(batch.column(0))
            for first, end, data, at in chunks(batch.column(1)):
                words = words_of(data, at)
                hashes, doc, place = words.windows(window)
                tags = [zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:])]
                new = (ids[first:end], np.array(tags, np.uint32), hashes, doc + docs, place.astype(np.int64))
                for store, x in zip(held, new):
                    store.append(x)
                docs, n = docs + end - first, n + len(hashes)
                if n >= COMBINE:
                    yield flush(*held)
                    held, docs, n = [[], [], [], [], []], 0, 0
        if n:
            yield flush(*held)

    return run


def _reduce(groups: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        ids, tags, hashes, doc, place, docs, passed = [], [], [], [], [], 0, []
        for row in table.to_pylist():
            blob = row["blob"]
            if row["kind"]:  # settled by a task already
                passed.append((1, row["group"], row["n"], row["docs"], blob))
                continue
            cut = 4 + int.from_bytes(blob[:4], "little")
            i, t = unpack(blob[4:cut], row["docs"], np.int64, np.uint32)
            h, d, p = unpack(blob[cut:], row["n"], np.uint64, np.uint32, np.uint32)
            for store, x in zip((ids, tags, hashes, doc, place), (i, t, np.cumsum(h, dtype=np.uint64), d.astype(np.int64) + docs, p.astype(np.int64))):
                store.append(x)
            docs += row["docs"]
        rows = passed
        if ids:
            ids, tags, hashes, doc, place = (np.concatenate(x) for x in (ids, tags, hashes, doc, place))
            order = np.argsort(hashes)
            late = order[_split_smallest(hashes[order], ids[doc[order]])]
            rows = rows + _settled(ids, tags, doc[late], place[late], groups)
        return pa.Table.from_batches([_rows(rows)])

    return run


def _write(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string()), ("copies", pa.int64())])

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        removed: dict[tuple[int, int], list[np.ndarray]] = {}
        for row in found.to_pylist():
            blob = row["blob"]
            cut = 4 + int.from_bytes(blob[:4], "little")
            ids, tags, counts = unpack(blob[4:cut], row["docs"], np.int64, np.uint32, np.uint32)
            (steps,) = unpack(blob[cut:], row["n"], np.uint32)
            place = np.cumsum(steps.view(np.int32), dtype=np.int64)
            for i, t, at in zip(ids.tolist(), tags.tolist(), np.split(place, np.cumsum(counts)[:-1])):
                removed.setdefault((i, t), []).append(at)
        out: list[tuple] = []
        column = texts.column("id").combine_chunks()
        shown, ids, copies = column.to_pylist(), _ids(column).tolist(), texts.column("copies").to_pylist()
        data, at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        for first, end, data, at in chunks(texts.column("text")):
            for k in range(first, end):
                text = data[at[k - first] : at[k - first + 1]].tobytes()
                words = text.split()
                n = len(words)
                gone = removed.get((ids[k], zlib.crc32(text)))
                if gone:
                    starts = np.concatenate(gone)
                    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + window, minlength=n + 1)
                    words = list(compress(words, (np.cumsum(edge[:n]) == 0).tolist()))
                kept = b" ".join(words)
                out.append((shown[k], n, n - len(words), kept, hashlib.sha256(kept).hexdigest(), copies[k]))
        columns = list(zip(*out)) if out else [[] for _ in schema]
        arrays = [pa.array(c, pa.binary() if f.name == "kept" else f.type) for c, f in zip(columns, schema)]
        arrays[3] = arrays[3].cast(pa.string())
        return pa.Table.from_arrays(arrays, schema=schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove words covered by a window that also starts in a document with a smaller id.

    Returns a row per input row: the id, ``n_words``, ``n_removed``, ``kept`` (the remaining words,
    joined by one space) and ``kept_sha256``. Other columns are not carried along, so their names
    cannot clash. Null or empty text, and text shorter than a window, loses nothing. A null id
    counts as larger than all others; rows with the same id never remove each other's words, whether
    they are copies or not. Rows without an id are spread by their texts, and equal ones of them are
    worked on once. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size, unnamed = source.selectExpr("coalesce(sum(octet_length(text)), 0)", "count_if(id is null)").first()
    ranges, groups = parts_for(size, RANGE_BYTES, 64), parts_for(size, GROUP_BYTES, 64) | 1
    if unnamed:
        once = source.where("id is null").groupBy("id", "text").agg(F.count("*").alias("copies"))
        source = source.where("id is not null").withColumn("copies", F.lit(1).cast("long")).unionByName(once)
    else:
        source = source.withColumn("copies", F.lit(1).cast("long"))
    entries = source.select("id", "text").mapInArrow(_map(window, ranges, groups), _FOUND_SQL)
    # Settled windows only pass through this shuffle; any range will do for them.
    keyed = entries.select(
        "kind", F.when(F.col("kind") == 0, F.col("part")).otherwise(F.col("part") % ranges).alias("range"),
        F.col("part").alias("group"), "n", "docs", "blob",
    )
    found = keyed.groupBy("range").applyInArrow(_reduce(groups), _FOUND_SQL).select(
        F.col("part").alias("g"), "n", "docs", "blob"
    )
    texts = source.selectExpr("*", _KEY_SQL).selectExpr("id", "text", "copies", _GROUP_SQL.format(groups))
    written = texts.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(
        _write(window), "id long, n_words long, n_removed long, kept string, kept_sha256 string, copies long"
    )
    if unnamed:  # in two steps, so that no array is long
        written = written.withColumn("step", F.expr(f"explode(sequence(1L, copies, {COPIES}L))")).withColumn(
            "copy", F.expr(f"explode(sequence(step, least(copies, step + {COPIES - 1})))")
        )
    return written.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept", "kept_sha256")
