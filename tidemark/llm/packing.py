"""Packing of tokenised documents into sequences of bounded length by swap-based local search.

Method
------
Documents are tokenised, closed with an end id and, only if longer than a sequence, cut into full pieces and
a rest. Pieces are dealt at random to groups of bounded size, each packed in one task: a best-fit start,
then a local search over the underfull sequences, which moves a piece, exchanges one for one or
two for one, whenever this raises the sum of squared fills, so that some sequences fill up and others empty. Pieces of
sequences that stay clearly underfull are dealt to new groups once more.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TEXT_ROWS, map_arrow
from tidemark.session import stage

_CACHE_WORDS = 500_000
_tokenizers: dict[str, WordTokenizer] = {}


#: Stretches that need no Unicode normalisation: printable ASCII but the apostrophe (contractions), Latin letters.
_PLAIN = re.compile(r"[!-&(-~\u00c0-\u012f\u0131-\u024f]+")
_PARTS = re.compile(r"[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]|[^a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _SHOWN)}


class WordTokenizer(dict):
    """Ids of whole texts by a lower-casing vocabulary that never joins across ASCII white space.

    Ids of a stretch without white space depend on that stretch alone, so this dictionary keeps them (as
    little-endian unsigned 32-bit ids) for the next time it comes, ``_CACHE_WORDS`` of them at most; when it has
    missed many more since, it starts anew. Plain stretches go straight to the vocabulary's merges, part by
    part; all others through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.missed = 0

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():
            ids = array("I", [t.id for t in self.merge(word.lower().decode())]).tobytes()
        elif word[-1] < 128 and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]
        else:
            text = word.decode()
            if b"<|" not in word and _PLAIN.fullmatch(text):
                shown = [p if p.isascii() else "".join([_BYTES[b] for b in p.encode()]) for p in _PARTS.findall(text.lower())]
                ids = array("I", [t.id for p in shown for t in self.merge(p)]).tobytes()
            else:
                ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self) < _CACHE_WORDS:
            self[word] = ids
        else:
            self.missed += 1
            if self.missed > 4 * _CACHE_WORDS:
                self.missed = 0
                self.clear()
        return ids

    def ids(self, text: str) -> bytes:
        raw = text.encode("utf-8", "replace")
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


def tokenizer(path: str) -> WordTokenizer:
    """One per process and path."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32 and, if asked for, the ids."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = tokenizer(path)
        end = int(end_id).to_bytes(4, "little")
        rows, piece, start, length, crc, ids = [], [], [], [], [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            all_ids = own.ids(text or "") + end
            for k, at in enumerate(range(0, len(all_ids), 4 * capacity)):
                part = all_ids[at : at + 4 * capacity]
                rows.append(row)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
        columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.record_batch(columns, names=names)

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), of, schema, TEXT_ROWS)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items (their positions) by bin: each, longest first, goes where it leaves the least room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room left, bin), sorted
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        k = bisect.bisect_left(room, (lengths[i], -1))
        if k < len(room):
            left, b = room.pop(k)
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        if left > lengths[i]:
            bisect.insort(room, (left - lengths[i], b))
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, passes: int = 6) -> list[list[int]]:
    """Raise the sum of squared fills of underfull bins by moves and exchanges; drop bins that empty.

    Bins take from less full ones only, the fullest first, so every step raises the sum. ``passes`` bounds
    the sweeps; the search ends earlier when a sweep changes nothing.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    of = {i: k for k, b in enumerate(bins) for i in b}
    for _ in range(passes):
        pool = sorted((lengths[i], i) for k, b in enumerate(bins) if 0 < fill[k] < capacity for i in b)
        changed = False

        def largest(most: int, least: int, into: int, pool=pool) -> int | None:
            """The longest item of at most ``most`` and over ``least`` in a bin less full than ``into``."""
            at = bisect.bisect_right(pool, (most, len(lengths))) - 1
            for k in range(at, max(-1, at - 12), -1):
                size, i = pool[k]
                if size <= least:
                    return None
                if of[i] != into and fill[of[i]] <= fill[into]:
                    return i
            return None

        def put(i: int, into: int) -> None:
            out = of[i]
            bins[out].remove(i)
            fill[out] -= lengths[i]
            bins[into].append(i)
            fill[into] += lengths[i]
            of[i] = into

        for k in sorted((k for k in range(len(bins)) if 0 < fill[k] < capacity), key=lambda k: (-fill[k], k)):
            while 0 < fill[k] < capacity:
                room = capacity - fill[k]
                i = largest(room, 0, k)
                if i is not None:  # move
                    put(i, k)
                    changed = True
                    continue
                best: tuple[int, tuple[int, ...], tuple[int, ...]] | None = None
                own = bins[k]
                for a in own:  # one for one, two for one
                    i = largest(lengths[a] + room, lengths[a], k)
                    if i is not None and (best is None or lengths[i] - lengths[a] > best[0]):
                        best = (lengths[i] - lengths[a], (a,), (i,))
                    first = largest((lengths[a] + room) // 2, 0, k)
                    if first is not None:
                        second = largest(lengths[a] + room - lengths[first], lengths[a] - lengths[first], k)
                        gain = lengths[first] + lengths[second] - lengths[a] if second is not None and second != first else 0
                        if second is not None and of[first] == of[second] and gain > (best[0] if best else 0) and fill[of[first]] - gain < fill[k]:
                            best = (gain, (a,), (first, second))
                for x in range(len(own)):  # two of this bin for one
                    for y in range(x + 1, min(len(own), x + 6)):
                        both = lengths[own[x]] + lengths[own[y]]
                        i = largest(both + room, both, k)
                        if i is not None and (best is None or lengths[i] - both > best[0]):
                            best = (lengths[i] - both, (own[x], own[y]), (i,))
                if best is None:
                    break
                _, mine, theirs = best
                other = of[theirs[0]]
                for i in mine:
                    put(i, other)
                for i in theirs:
                    put(i, k)
                changed = True
        if not changed:
            break
    return [b for b in bins if b]


def _pack_groups(pieces: DataFrame, groups: int, capacity: int, turn: int) -> DataFrame:
    """(uid, length) to (uid, length, sequence_id, offset, fill) by groups of bounded size."""

    def of(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("uid", "ascending")])
        lengths = part["length"].to_pylist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        order = np.array([i for b in bins for i in b], np.int64)
        at = np.array([k for k, b in enumerate(bins) for _ in b], np.int64)
        size = np.array(lengths, np.int64)[order]
        full = np.bincount(at, size, len(bins)).astype(np.int64)
        before = np.cumsum(size) - size
        first = np.r_[True, at[1:] != at[:-1]]
        offset = before - np.maximum.accumulate(np.where(first, before, 0))
        base = (turn << 61) | (int(key[0].as_py()) << 24)
        return pa.table({"uid": part["uid"].take(pa.array(order)), "length": size, "sequence_id": at + base, "offset": offset, "fill": full[at]})

    dealt = pieces.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)).cast("int").alias("g"))
    return dealt.groupBy("g").applyInArrow(of, "uid long, length long, sequence_id long, offset long, fill long")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", group: int = 6000, with_ids: bool = False) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids``).

    A null or empty text is the end id alone. Offsets are gapless from 0 in each sequence. Repeated rows, and
    rows with a null id, are packed each. ``group``: about how many pieces one task packs. Further columns
    are ignored; an empty table gives no rows.
    """
    pieces = stage(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select("uid", F.col("uid").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    first = stage(_pack_groups(rest, max(1, -(-rest.count() // group)), capacity, 0), "packed")
    loose = first.where(F.col("fill") < F.lit(0.97 * capacity)).select("uid", "length")
    again = _pack_groups(loose, max(1, -(-loose.count() // group)), capacity, 1)
    placed = full.unionByName(first.where(F.col("fill") >= F.lit(0.97 * capacity)).select("uid", "sequence_id", "offset")).unionByName(again.select("uid", "sequence_id", "offset"))
    out = pieces.join(placed, "uid")
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
