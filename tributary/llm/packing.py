"""Best-fit packing of token sequences, with a certificate of how good it is.

1. Tokenise; cut documents longer than a sequence into full pieces and a shorter first one. Full
   pieces are sequences of their own, so only the short pieces are packed.
2. Pieces are dealt out to parts of bounded size. Each part is packed by best-fit decreasing, and
   dual feasible functions give a lower bound for its number of sequences. Where both agree the part
   is certified and its sequences stay, but for a rest less than half full.
3. That rest, and elsewhere all sequences that leave a gap, are given up: their pieces are dealt out anew, together
   with those of other such parts, and packed again, until nothing is left or a round saves
   nothing. The best packing of each piece is kept.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import Stage, parts_for
from tributary.llm.tokens import chunks

CAPACITY = 1024
END = 2
#: Pieces packed in one task, rounds of exchange at most, lines handed to the tokenizer at once.
PART, ROUNDS, LINES = 3000, 8, 500
#: Bytes of words and ids that a worker remembers, what each costs besides, and the longest word remembered.
REMEMBERED, EACH, LONGEST = 240 << 20, 170, 400

_CACHE: dict[str, dict[str, bytes]] = {}
_HELD: dict[str, int] = {}
_TOKENIZERS: dict[str, object] = {}


def tokenizer_of(path: str):
    """The tokenizer of a file, loaded once for each worker."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Ids of whole texts as little-endian 32-bit words.

    Byte-level BPE never joins across a single space before a word, nor across a line break between
    two words, so texts are cut there and the ids of each part are remembered. Texts with other
    white space, where that does not hold, go to the tokenizer as they are.
    """
    tokenizer, known = tokenizer_of(path), _CACHE.setdefault(path, {})
    # A part that begins with the mark has no space before it.
    split = [None if _joining(t) else (_MARK + t.replace("\n", f" {_BREAK} {_MARK}")).split(" ") for t in texts]
    parts = set().union(*(s for s in split if s))
    new = [w for w in parts if w not in known]
    size = EACH * len(new) + 2 * sum(map(len, new))
    if _HELD.get(path, 0) + size > REMEMBERED:
        known.clear()
        _HELD[path], new = 0, list(parts)
        size = EACH * len(new) + 2 * sum(map(len, new))
    known.update(_encode_parts(tokenizer, new))
    whole = iter(_encode(tokenizer, [t for t, s in zip(texts, split) if s is None]))
    ids = [next(whole) if s is None else b"".join(map(known.__getitem__, s)) for s in split]
    # Long words, as of text without spaces, are of use for these texts only.
    for word in [w for w in new if len(w) > LONGEST]:
        size -= EACH + 2 * len(word)
        del known[word]
    _HELD[path] = _HELD.get(path, 0) + size
    return ids


_MARK = "\x01"
_BREAK = _MARK + "\n"
_ASCII_SPACES = ("\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", _MARK, "  ", "\n ", " \n", "\n\n", "<|")
_OTHER_SPACE = re.compile(r"[^\S\n ]")


def _joining(text: str) -> bool:
    """Whether spaces may join with their neighbours, or a special token may be spelt out."""
    return (
        any(s in text for s in _ASCII_SPACES) or text[:1] in ("", " ", "\n") or text[-1:] in (" ", "\n")
        or (not text.isascii() and _OTHER_SPACE.search(text) is not None)
    )


def _encode(tokenizer, texts: list[str]) -> list[bytes]:
    return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encode_parts(tokenizer, parts: list[str]) -> Iterator[tuple[str, bytes]]:
    """Ids of parts. They are handed over as lines, many at a time, since a call has its price; the
    token of the line break, which no other part can hold, tells them apart again."""
    lines = [w for w in parts if w != _BREAK]
    texts = [w[1:] if w[0] == _MARK else " " + w for w in lines]
    (mark,) = tokenizer.encode("\n", add_special_tokens=False).ids
    if len(lines) < len(parts):
        yield _BREAK, array("I", [mark]).tobytes()
    joined = ["\n".join(texts[k : k + LINES]) + "\n" for k in range(0, len(texts), LINES)]
    for k, found in enumerate(tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        data, at = ids.tobytes(), 0
        ends = np.flatnonzero(ids == mark).tolist()
        for word, end in zip(lines[LINES * k : LINES * (k + 1)], ends, strict=True):
            yield word, data[4 * at : 4 * end]
            at = end + 1


def _pieces(path: str, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.array([END], "<u4").tobytes()
    schema = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, _, _ in chunks(batch.column(1)):
                rows = []
                ids = batch.column(0).slice(first, stop - first).to_pylist()
                texts = batch.column(1).slice(first, stop - first).fill_null("").to_pylist()
                for shown, data in zip(ids, token_bytes(texts, path)):
                    data += end
                    n = len(data) // 4
                    head = n % capacity or capacity
                    for piece, at in enumerate([0, *range(head, n, capacity)]):
                        size = capacity if piece else min(head, n)
                        rows.append((shown, piece, at, size, zlib.crc32(data[4 * at : 4 * (at + size)])))
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each size, and the number of bins. The fullest bin with room is taken."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room
    rooms, used = 0, 0  # bit r: some bin has room r
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_[room].pop()
            if not open_[room]:
                rooms ^= 1 << room
        else:
            room, b, used = capacity, used, used + 1
        bins[k], offsets[k] = b, capacity - room
        if room > size:
            open_[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, used


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions, evaluated on the size histogram.

    u_k rounds a size down to k-ths unless (k + 1) * size is a multiple of the capacity; f_t counts
    sizes over capacity - t as a whole sequence and drops those below t.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    for k in range(1, 33):
        exact = (k + 1) * x % capacity == 0
        value = np.where(exact, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    for t in range(1, capacity // 2 + 1):
        total = int(count[capacity - t + 1 :].sum()) * capacity + int((count * x)[t : capacity - t + 1].sum())
        best = max(best, -(-total // capacity))
    return best


def _pack(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "id", "piece", "start"], ascending=False, kind="stable")
        sizes = part["length"].to_numpy()
        bins, offsets, used = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, sizes, minlength=used)
        certified = used == lower_bound(sizes, capacity)
        return part.assign(bin=bins, offset=offsets, fill=fill[bins].astype("int64"), certified=certified, bound=lower_bound(sizes, capacity))

    return run


_PIECE = "id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECE + ", part long, bin long, offset long, fill long, certified boolean, bound long"


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens.

    Returns a row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``
    and ``offset``. Null and empty texts are one end token. Rows with the same id, or none, are
    packed as documents of their own. Other columns are not carried along. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    stage = Stage(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = stage.table(source.mapInArrow(_pieces(tokenizer_path, capacity), _PIECE), "pieces")
    columns = ["id", "piece", "start", "length", "ids_crc32"]
    places = [*columns, "round", "part", "bin", "offset"]
    full = pieces.where(F.col("length") == capacity).select(
        *columns, F.lit(-1).alias("round"), F.lit(0).cast("long").alias("part"),
        F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("long").alias("offset"),
    )
    kept, left, given_up = [full], pieces.where(F.col("length") < capacity), None
    n = left.count()
    for turn in range(ROUNDS):
        if not n:
            break
        parts = parts_for(n, PART)
        dealt = left.select(*columns).withColumn("part", F.pmod(F.xxhash64("id", "piece", F.lit(turn)), F.lit(parts)))
        packed = stage.table(dealt.groupBy("part").applyInPandas(_pack(capacity), _PACKED), f"round{turn}")
        packed = packed.withColumn("round", F.lit(turn))
        stays = (F.col("certified") & (2 * F.col("fill") > capacity)) | (F.col("fill") == capacity)
        head = F.col("offset") == 0
        n, open_, sequences = packed.agg(F.count_if(~stays), F.count_if(~stays & head), F.count_if(head)).first()
        if given_up is not None and sequences >= given_up:
            kept.append(left.select(*places))  # the exchange saved nothing: as it was
            break
        if not n or parts == 1 or turn == ROUNDS - 1:
            kept.append(packed.select(*places))
            break
        kept.append(packed.where(stays).select(*places))
        left, given_up = packed.where(~stays), open_
    whole = kept[0]
    for more in kept[1:]:
        whole = whole.unionByName(more)
    # 6 bits of round, 34 of part and 23 of bin (a part has at most PART bins); full pieces use all.
    number = F.when(F.col("round") < 0, -1 - F.col("bin")).otherwise(
        F.shiftleft(F.col("round").cast("long"), 57).bitwiseOR(F.shiftleft("part", 23)).bitwiseOR(F.col("bin"))
    )
    return whole.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), "offset")
