"""Suffix-array dedup: bytes covered by a string of 200 bytes that starts anywhere else, too.

Every suffix that begins with ``LENGTH`` bytes has an anchor: the first least hash of the ``GRAM``-byte strings
in these bytes. Equal strings have their anchors at equal places, so suffixes meet by anchor, and runs of
neighbouring suffixes with one anchor travel as one piece of text (a third of a copy for each byte).

1. Each task cuts its texts into pieces. Of equal pieces one goes on; all of them are settled, for they
   repeat. So a text that a third of the corpus shares costs each task one entry a piece.
2. The pieces of a range of anchors are sorted deep-shallow from their anchors on: a multikey quicksort of
   8-byte characters orders them to depth ``GRAM``; what then still is together is ordered by blind tries, one
   of what follows the anchor and one of what precedes it. The suffixes at one distance before the anchor
   are ordered as both tries say, so a node of the first trie, together with neighbours in the order of the second,
   tells how far each piece repeats to both sides.
3. The intervals go to their documents and merge; the remaining bytes are put together.

An anchor with very many different pieces (round a common line) is counted beforehand. Its pieces are cut
finer and dealt by what all suffixes of such a part share, at last by all their 200 bytes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.blobs import pack, unpack
from tributary.llm.tables import Stage, parts_for, text_bytes
from tributary.llm.tokens import _BYTES, _VALUE, chunks, mix

#: Bytes of a repeated string, and of the strings that anchors are chosen from.
LENGTH, GRAM = 200, 32
#: Bytes of text in a range of anchors, in a group of documents, and whose pieces are combined in a task.
#: They set how the work is cut, never the result.
RANGE_BYTES, GROUP_BYTES, COMBINE = 8 << 20, 8 << 20, 12 << 20
#: Different pieces from which an anchor is cut finer: so many, and such a share of a range; anchors cut at most.
HOT, HOT_SHARE, HOT_ANCHORS = 256, 0.25, 4_000_000
#: Suffixes of a part of a hot piece, step by step.
FINER = (8, 1)
#: Ranges and groups at least.
LEAST_PARTS = 64

_NO_ID = np.iinfo(np.int64).max
_PIECES_SQL = "kind tinyint, part int, blob binary"
_PIECES = pa.schema([("kind", pa.int8()), ("part", pa.int32()), ("blob", pa.binary())])
_PIECE, _INTERVAL = 0, 1


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class _Pieces:
    """The pieces of some texts: document, first and last suffix, anchor and the key that deals them out."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int, gram: int) -> None:
        up, down = _BYTES.upto(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * up[:-1], out=self.total[1:])
        self.length = length
        grams = mix((self.total[gram:] - self.total[:-gram]) * down[: len(data) - gram + 1]) if len(data) >= length else np.zeros(0, np.uint64)
        # The place in the lower half: of equal hashes the first counts.
        keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width = length - gram + 1
        anchor = (_least_in(keyed, width) & np.uint64(0xFFFFFFFF)).astype(np.int64) if len(keyed) >= width else np.zeros(0, np.int64)
        inside = np.zeros(len(anchor) + 1, np.int64)
        ends = np.maximum(at[1:] - length + 1, at[:-1])
        some = ends > at[:-1]
        np.add.at(inside, at[:-1][some], 1)
        np.add.at(inside, ends[some], -1)
        suffix = np.flatnonzero(np.cumsum(inside[:-1]))
        of = anchor[suffix]
        begins = np.ones(len(suffix), bool)
        begins[1:] = (np.diff(of) != 0) | (np.diff(suffix) != 1)
        cut = np.flatnonzero(begins)
        self.first = suffix[cut]
        self.last = suffix[np.append(cut[1:], len(suffix)) - 1] if len(suffix) else self.first
        self.anchor = of[cut]
        self.key = mix(grams[self.anchor])
        self.doc = np.searchsorted(at, self.first, side="right") - 1

    def _hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _BYTES.upto(len(self.total))[1]
        return mix((self.total[end] - self.total[start]) * down[start] + np.uint64(1))

    def finer(self, hot: np.ndarray, suffixes: int) -> None:
        """Cuts pieces whose key is hot into parts of the suffixes that begin at like distances from the
        anchor. All suffixes of a part share the bytes that its key is made of."""
        at = np.searchsorted(hot, self.key)
        is_hot = hot[np.minimum(at, len(hot) - 1)] == self.key if len(hot) else np.zeros(len(self.key), bool)
        mine = np.flatnonzero(is_hot)
        if not len(mine):
            return
        first, last, anchor, doc = (x[mine] for x in (self.first, self.last, self.anchor, self.doc))
        near, far = (anchor - last) // suffixes, (anchor - first) // suffixes
        n = far - near + 1
        of = np.repeat(np.arange(len(mine)), n)
        step = near[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        shared = anchor[of] - suffixes * step
        own_first = np.maximum(first[of], shared - suffixes + 1)
        key = self._hash(shared, shared + self.length + 1 - suffixes)
        rest = np.flatnonzero(~is_hot)
        new = {"first": own_first, "last": np.minimum(last[of], shared), "anchor": anchor[of], "doc": doc[of], "key": key}
        for name, part in new.items():
            setattr(self, name, np.concatenate([getattr(self, name)[rest], part]))

    def content(self) -> np.ndarray:
        return self._hash(self.first, self.last + self.length)


def _pieces_of(data: np.ndarray, at: np.ndarray, length: int, gram: int, hot: list[np.ndarray]) -> _Pieces:
    pieces = _Pieces(data, at, length, gram)
    for step, keys in enumerate(hot):
        pieces.finer(keys, FINER[step])
    return pieces


def _count_pieces(length: int, gram: int, hot: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, n): different pieces of a key, where a task holds more than one; null: all pieces."""

    def counted(keys: list[np.ndarray], contents: list[np.ndarray]) -> pa.RecordBatch:
        key, content = np.concatenate(keys), np.concatenate(contents)
        order = np.lexsort((content, key))
        key, content = key[order], content[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        key = key[new]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(heads, len(key)))
        some = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(key[heads][some].view(np.int64)), pa.nulls(1, pa.int64())]), pa.array(np.append(n[some], len(key)), pa.int64())],
            ["key", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, contents, held = [], [], 0
        for batch in batches:
            for _, _, data, at in chunks(batch.column(0)):
                pieces = _pieces_of(data, at, length, gram, hot)
                keys.append(pieces.key)
                contents.append(pieces.content())
                held += len(data)
                if held >= COMBINE:
                    yield counted(keys, contents)
                    keys, contents, held = [], [], 0
        if keys:
            yield counted(keys, contents)

    return run


def _hot_keys(source: DataFrame, length: int, gram: int, ranges: int, stage: Stage) -> list[np.ndarray]:
    """For each step of ``FINER`` the keys that are cut: at most ``HOT_ANCHORS``, as their counts add up to no more than all."""
    hot: list[np.ndarray] = []
    for step in range(len(FINER)):
        rows = source.select("text").mapInArrow(_count_pieces(length, gram, hot), "key long, n long")
        counts = stage.table(rows.groupBy("key").agg(F.sum("n").alias("n")), f"keys{step}")
        pieces = counts.where("key is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        limit = max(HOT, HOT_SHARE * pieces / ranges, pieces / HOT_ANCHORS)
        found = counts.where(f"key is not null and n >= {limit}").select("key").toArrow().column("key")
        keys = np.sort(found.to_numpy().astype(np.int64).view(np.uint64))
        if not len(keys):
            break
        hot.append(keys)
    return hot


def _group(ids: np.ndarray, tags: np.ndarray, groups: int) -> np.ndarray:
    return (mix(ids.view(np.uint64) ^ tags) % np.uint64(groups)).astype(np.int32)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _intervals(ids: np.ndarray, tags: np.ndarray, start: np.ndarray, stop: np.ndarray, groups: int) -> list[tuple]:
    """Intervals to remove, packed by group of documents."""
    part = _group(ids, tags, groups)
    order = np.lexsort((start, tags, ids, part))
    part, ids, tags, start, stop = (x[order] for x in (part, ids, tags, start, stop))
    rows, cuts = [], [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            own = slice(a, b)
            body = pack(ids[own], tags[own], start[own].astype(np.uint32), (stop[own] - start[own]).astype(np.uint32))
            rows.append((_INTERVAL, int(part[a]), (b - a).to_bytes(4, "little") + body))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _PIECES]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)


def _cut_texts(length: int, gram: int, ranges: int, groups: int, hot: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flush(held: dict[bytes, list[int]], where: list[np.ndarray]) -> pa.RecordBatch:
        ids, tags, start, anchor, key = (np.concatenate(x) for x in zip(*where))
        texts, seen = list(held), list(held.values())
        again = np.array([k for places in seen if len(places) > 1 for k in places], np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        stop = start[again] + np.repeat([len(t) for t, places in held.items() if len(places) > 1], [len(p) for p in seen if len(p) > 1]).astype(np.int64)
        rows = _intervals(ids[again], tags[again], start[again], stop, groups)
        first = np.array([places[0] for places in seen], np.int64)
        settled = np.array([len(places) > 1 for places in seen], np.uint8)
        part = ((mix(key[first]) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                at = order[a:b]
                own = first[at]
                head = pack(ids[own], tags[own], start[own].astype(np.uint32), sizes[at].astype(np.uint16), anchor[own].astype(np.uint16), settled[at])
                body = pack(np.frombuffer(b"".join([texts[k] for k in at.tolist()]), np.uint8))
                lengths = (b - a, len(head), int(sizes[at].sum()))
                rows.append((_PIECE, int(part[at[0]]), b"".join(n.to_bytes(4, "little") for n in lengths) + head + body))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}
        where, n, size = [], 0, 0
        for batch in batches:
            ids = _ids(batch.column(0))
            for first, end, data, at in chunks(batch.column(1)):
                pieces, raw = _pieces_of(data, at, length, gram, hot), data.tobytes()
                tags = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.uint64)
                doc = pieces.doc
                where.append((ids[first:end][doc], tags[doc], pieces.first - at[doc], pieces.anchor - pieces.first, pieces.key))
                for k, (a, b) in enumerate(zip(pieces.first.tolist(), (pieces.last + length).tolist()), n):
                    text = raw[a:b]
                    if (places := held.get(text)) is None:
                        held[text] = [k]
                    else:
                        places.append(k)
                n, size = n + len(doc), size + len(data)
                if size >= COMBINE:
                    yield flush(held, where)
                    held, where, n, size = {}, [], 0, 0
        if n:
            yield flush(held, where)

    return run


def shallow(text: np.ndarray, at: np.ndarray, depth: int) -> list[np.ndarray]:
    """Multikey quicksort, 8 bytes at a time: groups of two or more places whose next ``depth`` bytes are equal, in order."""
    members, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    for level in range(0, depth, 8):
        bytes_ = text[at[members][:, None] + np.arange(level, level + 8)]
        character = np.ascontiguousarray(bytes_).view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((character, group))
        members, group, character = members[order], group[order], character[order]
        new = np.ones(len(members), bool)
        new[1:] = (group[1:] != group[:-1]) | (character[1:] != character[:-1])
        group = np.cumsum(new) - 1
        together = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
        members, group = members[together], group[together]
    return [g for g in np.split(members, np.flatnonzero(np.diff(group)) + 1) if len(g)]


def _common(a: bytes, b: bytes) -> int:
    """How many bytes two strings begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    other = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (other.bit_length() + 7) // 8


class BlindTrie:
    """A trie that holds where strings part and by which byte, not the bytes between. ``-1`` is the end of a string.

    A string goes down by its bytes at the places where others part, whatever stands between. The string
    that it so finds is the only one it is compared with; the place of their first other byte is where it parts.
    """

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: list = [len(strings[0]), {}, [0]]
        for k in range(1, len(strings)):
            self._insert(k)

    def _insert(self, k: int) -> None:
        own = self.strings[k]
        node = self.root
        while node[1]:
            depth = node[0]
            child = node[1].get(own[depth] if depth < len(own) else -1)
            node = child if child is not None else next(iter(node[1].values()))
        other = self.strings[node[2][0]]
        part = _common(own, other)
        if part == len(own) == len(other):
            node[2].append(k)
            return
        above, node = None, self.root
        while node[1] and node[0] < part:
            above = node
            node = node[1][own[node[0]]]
        leaf = [len(own), {}, [k]]
        mine = own[part] if part < len(own) else -1
        if node[1] and node[0] == part:
            node[1][mine] = leaf
            return
        theirs = other[part] if part < len(other) else -1
        branch = [part, {mine: leaf, theirs: node}, None]
        if above is None:
            self.root = branch
        else:
            above[1][own[above[0]]] = branch

    def walk(self) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
        """Strings in order, how much each shares with the next, and nodes (depth, first, end) of that order, children first."""
        order, shared, nodes = [], [], []
        stack: list[tuple] = [(self.root, 0, 0, None)]
        while stack:
            node, state, first, children = stack.pop()
            if not node[1]:
                first = len(order)
                order += node[2]
                shared += [node[0]] * (len(node[2]) - 1)
                if len(node[2]) > 1:
                    nodes.append((node[0], first, len(order)))
                continue
            if state == 0:
                first, children = len(order), [node[1][c] for c in sorted(node[1])]
            if state < len(children):
                if state:
                    shared.append(node[0])
                stack.append((node, state + 1, first, children))
                stack.append((children[state], 0, 0, None))
            else:
                nodes.append((node[0], first, len(order)))
        return order, shared, nodes


def repeats(before: list[bytes], after: list[bytes], length: int) -> list[tuple[int, int]]:
    """How far strings round one anchor repeat to the left and to the right; (0, 0) where no ``length`` bytes do.

    ``before``: the bytes before the anchor, the nearest first; ``after``: those from it on. Of all strings
    that share r bytes after the anchor with one, the neighbours in the order of ``before`` share most
    before it; the intervals so found all hold the anchor, so the widest to both sides are their union.
    """
    if len(after) == 2:
        left, right = _common(*before), _common(*after)
        return [(left, right)] * 2 if left + right >= length else [(0, 0)] * 2
    order, _, nodes = BlindTrie(after).walk()
    by_left, shared, _ = BlindTrie(before).walk()
    rank = np.empty(len(after), np.int64)
    rank[by_left] = np.arange(len(after))
    order, shared = np.array(order), np.array([*shared, 0])
    lefts, rights = np.zeros(len(after), np.int64), np.zeros(len(after), np.int64)
    most = int(shared.max())
    for depth, first, end in nodes:
        if depth + most < length:
            continue
        places = np.sort(rank[order[first:end]])
        near = np.minimum.reduceat(shared, places)[:-1]
        left = np.maximum(np.append(near, 0), np.append(0, near))
        enough = left + depth >= length
        of = np.array(by_left)[places[enough]]
        lefts[of] = np.maximum(lefts[of], left[enough])
        rights[of] = np.maximum(rights[of], depth)
    return list(zip(lefts.tolist(), rights.tolist()))


def _sort_range(length: int, gram: int, groups: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        rows, heads, bodies = [], [], []
        for kind, part, blob in zip(*(table.column(c).to_pylist() for c in ("kind", "group", "blob"))):
            if kind == _INTERVAL:  # settled by a task already
                rows.append((kind, part, blob))
                continue
            n, head, size = (int.from_bytes(blob[k : k + 4], "little") for k in (0, 4, 8))
            heads.append(unpack(blob[12 : 12 + head], n, np.int64, np.uint64, np.uint32, np.uint16, np.uint16, np.uint8))
            bodies.append(unpack(blob[12 + head :], size, np.uint8)[0])
        if not heads:
            return pa.Table.from_batches([_batch(rows)])
        ids, tags, start, sizes, anchor, settled = (np.concatenate(x) for x in zip(*heads))
        text = np.concatenate(bodies)
        sizes, anchor = sizes.astype(np.int64), anchor.astype(np.int64)
        at = np.cumsum(sizes) - sizes
        left, right = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        raw = text.tobytes()
        first, middle, end = at.tolist(), (at + anchor).tolist(), (at + sizes).tolist()
        for members in shallow(text, at + anchor, gram):
            own = members.tolist()
            found = repeats([raw[first[k] : middle[k]][::-1] for k in own], [raw[middle[k] : end[k]] for k in own], length)
            left[members], right[members] = zip(*found)
        some = np.flatnonzero((right > 0) & (settled == 0))
        middle = start[some].astype(np.int64) + anchor[some]
        rows += _intervals(ids[some], tags[some], middle - left[some], middle + right[some], groups)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _packed_texts(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts by group of documents; equal rows of a task once, with their number."""

    def flush(held: Counter, texts: dict) -> pa.RecordBatch:
        keys = list(held)
        ids, tags = np.array([_NO_ID if i is None else i for i, _ in keys], np.int64), np.array([t for _, t in keys], np.uint64)
        null = np.array([i is None for i, _ in keys], np.uint8)
        copies, sizes = np.array([held[k] for k in keys], np.uint32), np.array([len(texts[k]) for k in keys], np.uint32)
        part = _group(ids, tags, groups)
        order = np.argsort(part, kind="stable")
        cuts, rows = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = order[a:b]
            head = pack(ids[at], tags[at], null[at], copies[at], sizes[at])
            body = pack(np.frombuffer(b"".join([texts[keys[k]] for k in at.tolist()]), np.uint8))
            lengths = (b - a, len(head), int(sizes[at].sum()))
            rows.append((0, int(part[at[0]]), b"".join(n.to_bytes(4, "little") for n in lengths) + head + body))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, size = Counter(), {}, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, end, data, at in chunks(batch.column(1)):
                raw = data.tobytes()
                for k, a, b in zip(range(first, end), at[:-1].tolist(), at[1:].tolist()):
                    key = (ids[k], xxhash.xxh3_64_intdigest(raw[a:b]))
                    held[key] += 1
                    texts[key] = raw[a:b]
                size += len(data)
                if size >= COMBINE:
                    yield flush(held, texts)
                    held, texts, size = Counter(), {}, 0
        if held:
            yield flush(held, texts)

    return run


_KEPT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string()), ("copies", pa.int64())])
_KEPT_SQL = "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, copies long"


def _write(texts: pa.Table, found: pa.Table) -> pa.Table:
    removed: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for blob in found.column("blob").to_pylist():
        columns = unpack(blob[4:], int.from_bytes(blob[:4], "little"), np.int64, np.uint64, np.uint32, np.uint32)
        for i, t, start, n in zip(*(c.tolist() for c in columns)):
            removed.setdefault((i, t), []).append((start, start + n))
    out = []
    for blob in texts.column("blob").to_pylist():
        n, head, size = (int.from_bytes(blob[k : k + 4], "little") for k in (0, 4, 8))
        columns = unpack(blob[12 : 12 + head], n, np.int64, np.uint64, np.uint8, np.uint32, np.uint32)
        raw, at = unpack(blob[12 + head :], size, np.uint8)[0].tobytes(), 0
        for i, t, null, copies, length in zip(*(c.tolist() for c in columns)):
            parts, gone, spans, before = [], 0, 0, -1
            for start, stop in sorted(removed.get((i, t), ())):
                if start > before:
                    parts.append(raw[at + max(before, 0) : at + start])
                    spans += 1
                    before = start
                if stop > before:
                    gone, before = gone + stop - before, stop
            parts.append(raw[at + max(before, 0) : at + length])
            kept = b"".join(parts)
            out.append((None if null else i, length, gone, spans, kept, hashlib.sha256(kept).hexdigest(), copies))
            at += length
    columns = list(zip(*out)) if out else [[] for _ in _KEPT]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KEPT)], schema=_KEPT)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Remove each byte covered by ``length`` bytes of UTF-8 that also start anywhere else, in the same document too.

    A row per input row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs removed), ``kept`` (the
    remaining bytes, which may cut a character) and ``kept_sha256``. Strings are judged on the input and never
    cross rows. Null and short texts lose nothing; a null text is empty. Rows that repeat, with the same id or
    none, remove each other's bytes. Other columns are not carried along. An empty table gives an empty result.
    ``gram`` is a multiple of 8, less than ``length``.
    """
    stage = Stage(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = text_bytes(source, "text")
    ranges, groups = parts_for(size, RANGE_BYTES, LEAST_PARTS), parts_for(size, GROUP_BYTES, LEAST_PARTS)
    hot = _hot_keys(source, length, gram, ranges, stage)
    pieces = source.mapInArrow(_cut_texts(length, gram, ranges, groups, hot), _PIECES_SQL)
    # Settled intervals only pass through this shuffle; any range will do for them.
    keyed = pieces.select("kind", F.when(F.col("kind") == _PIECE, F.col("part")).otherwise(F.col("part") % ranges).alias("range"), F.col("part").alias("group"), "blob")
    found = keyed.groupBy("range").applyInArrow(_sort_range(length, gram, groups), _PIECES_SQL).select(F.col("part").alias("g"), "blob")
    texts = source.mapInArrow(_packed_texts(groups), _PIECES_SQL).select(F.col("part").alias("g"), "blob")
    kept = texts.groupBy("g").cogroup(found.groupBy("g")).applyInArrow(_write, _KEPT_SQL)
    every = kept.withColumn("part", F.explode(F.expr("sequence(0L, (copies - 1) div 4096)")))
    every = every.withColumn("k", F.explode(F.expr("sequence(part * 4096, least(copies, (part + 1) * 4096) - 1)")))
    return every.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
