"""Repeated substrings by longest-previous-factor arrays (operator 12).

The factor of a position is the longest string that starts there and also starts at an earlier position. It is
read off the suffix order: the match is the previous or the next suffix, in that order, which starts earlier
(previous and next smaller value). Only factors of ``min_length`` bytes matter, so suffixes that can have none are
never sorted:

1. Every window of ``min_length`` bytes is named after its anchor, the least hashed ``anchor_length``-gram inside
   it. Equal windows have equal anchors at equal places, so a window can only repeat among the windows of one
   anchor gram. Consecutive windows of one anchor form a run (one row per about 70 bytes).
2. Runs are counted by anchor hash. A run whose hash is alone has no factor. Where all runs of a hash are the same
   string, every one of them is a copy.
3. The other runs reduce to one representative per distinct string, the earliest. The representatives of one anchor
   hash meet in one task, which sorts their suffixes, takes neighbours' common prefixes and finds previous and next
   smaller positions. A hash with more than ``max_group`` representatives is not gathered: its windows are compared
   one by one through a grouped count, which is exact too.
4. The intervals found come back to their texts, and the covered bytes are cut out.

Positions are ordered by (id, text hash, offset), null ids last. Rows equal in id and text stand at one position;
they count as so many documents where copies are counted. A null text is empty; texts shorter than ``min_length``
have no window. Texts are UTF-8 bytes: a cut can fall inside a character, so the kept text is binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmflow.llm.common import heavy_join, stage

ANCHOR_LENGTH = 64
MAX_GROUP = 4096
# Bytes hashed at a time; a longer text is read in overlapping pieces. Positions in a piece must fit in _BITS.
_PIECE, _BITS = 1 << 21, 22
_LOW = np.uint64((1 << _BITS) - 1)
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) hash base and of its inverse modulo 2^64."""
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for out, base in ((up, _BASE), (down, pow(_BASE, -1, 1 << 64))):
        out[0] = 1
        size = 1
        while size < n:
            step = np.uint64(pow(base, size, 1 << 64))
            out[size:2 * size] = out[:min(size, n - size)] * step
            size *= 2
    return up, down


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A well-mixed 64-bit hash of every ``length``-gram of the bytes, from running sums."""
    up, down = _powers(_PIECE + 4096)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    found = (sums[length:] - sums[:-length]) * down[:len(data) - length + 1]
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    return found


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def runs(data: np.ndarray, ends: list[int], min_length: int, anchor_length: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, anchor minus first window, anchor hash) of the runs of several texts side by side."""
    width = min_length - anchor_length + 1
    hashes = gram_hashes(data, anchor_length)
    least = least_in_windows((hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), width)
    anchor = (least & _LOW).astype(np.int64)
    inside = np.ones(len(anchor), bool)
    for end in ends:
        inside[max(0, end - min_length + 1):end] = False
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    anchor = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, len(at)))
    return at[first], count, anchor[first] - at[first], hashes[anchor[first]]


def _pieces(column: pa.Array, min_length: int) -> Iterator[tuple[np.ndarray, list[int], np.ndarray, np.ndarray]]:
    """(bytes, ends of texts, rows, offset of each text's slice) with at most _PIECE bytes, long texts overlapping."""
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, "right")) - 1)
        start, end = int(offsets[row]), int(offsets[last])
        if end - start <= _PIECE:
            yield data[start:end], list(offsets[row + 1:last + 1] - start), np.arange(row, last), offsets[row:last] - start
        else:  # one long text
            step = _PIECE - min_length + 1
            for at in range(start, end - min_length + 1, step):
                part = data[at:min(end, at + _PIECE)]
                yield part, [len(part)], np.array([row]), np.array([start - at])
        row = last


def _binary(column: pa.Array) -> pa.Array:
    return pa.array([b""] * len(column), pa.binary()) if pa.types.is_null(column.type) else column.fill_null(b"")


def _place(first: np.ndarray, count: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """A run's offset, window count and anchor lead in one long, ordered by offset."""
    return (first << 24) | (count << 12) | lead


def find_runs(min_length: int, anchor_length: int, carry: list[str], schema: pa.Schema) -> Callable:
    """mapInArrow function: (carried columns, bytes) -> one row per run (carried columns, hash, digest, place)."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = _binary(batch.column("bytes"))
            for data, ends, rows, starts in _pieces(column, min_length):
                if len(data) < min_length:
                    continue
                first, count, lead, anchor = runs(data, ends, min_length, anchor_length)
                if not len(first):
                    continue
                view, digest = memoryview(np.ascontiguousarray(data)), xxhash.xxh64_intdigest
                digests = np.fromiter(
                    (digest(view[a:a + n + min_length - 1], n << 12 | d) for a, n, d in zip(first.tolist(), count.tolist(), lead.tolist())),
                    np.uint64, len(first))
                text = np.searchsorted(starts, first, "right") - 1
                made = {name: batch.column(name).take(pa.array(rows[text])) for name in carry}
                made |= {"hash": pa.array(anchor.view(np.int64)), "digest": pa.array(digests.view(np.int64)),
                         "place": pa.array(_place(first - starts[text], count, lead))}
                yield pa.record_batch([made[f.name] for f in schema], schema=schema)
    return apply


def previous_smaller(position: np.ndarray, common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each rank the nearest rank before it with a smaller position, and the common prefix of the two.

    ``common[r]`` is the common prefix of ranks r-1 and r. Chains whose common prefix falls under ``least`` end
    with (-1, 0): their factor is too short to matter. All ranks walk at once, over what the ranks passed have found.
    """
    n = len(position)
    found, prefix = np.arange(-1, n - 1), common.copy()
    found[prefix < least] = -1
    open_ = np.flatnonzero(found >= 0)
    open_ = open_[position[found[open_]] > position[open_]]
    while len(open_):
        via = found[open_]
        after, length = found[via], np.minimum(prefix[open_], prefix[via])
        after = np.where(length < least, -1, after)
        found[open_], prefix[open_] = after, length
        open_ = open_[after >= 0]
        open_ = open_[position[found[open_]] > position[open_]]
    prefix[found < 0] = 0
    return found, prefix


def factors(keys: np.ndarray, available: np.ndarray, position: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, index of the earlier match) of the longest previous factor of every suffix; (0, -1) under ``least``.

    ``keys`` holds one zero-padded suffix a row, ``available`` its true length."""
    # zero padding equals zero bytes: the shorter suffix goes first, as its length closes the key
    closed = np.concatenate([keys, available.astype(">u4")[:, None].view(np.uint8)], axis=1)
    order = np.argsort(closed.view(f"S{closed.shape[1]}").ravel(), kind="stable")
    del closed
    common = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 15):
        here = order[a:a + (1 << 15)]
        before = order[a - 1:a - 1 + len(here)]
        differ = keys[here] != keys[before]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])
        common[a:a + len(here)] = np.minimum(same, np.minimum(available[here], available[before]))
    ranked = position[order]
    back, back_length = previous_smaller(ranked, common, least)
    mirrored = np.concatenate([[0], common[:0:-1]])
    ahead, ahead_length = previous_smaller(ranked[::-1], mirrored, least)
    ahead, ahead_length = np.where(ahead >= 0, len(order) - 1 - ahead, -1)[::-1], ahead_length[::-1]
    use_back = back_length >= ahead_length
    source, length = np.where(use_back, back, ahead), np.where(use_back, back_length, ahead_length)
    out_length, out_source = np.empty_like(length), np.empty_like(source)
    out_length[order] = length
    out_source[order] = np.where(source >= 0, order[source], -1)
    return out_length, out_source


def _resolve(min_length: int, keep_first: bool) -> Callable:
    """mapInArrow function over representatives, sorted by hash: intervals of windows that repeat."""
    schema = pa.schema([("id_at", pa.int64()), ("text_hash", pa.int64()), ("place", pa.int64()), ("windows", pa.int64())])

    def solve(rows: dict) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((rows["place"], rows["text_hash"], rows["id_at"]))  # earliest first
        place = rows["place"][order]
        count = (place >> 12) & 0xFFF
        parts = [rows["part"][k] for k in order]
        width = max(map(len, parts))
        flat = np.zeros((len(parts), 2 * width), np.uint8)
        for k, part in enumerate(parts):
            flat[k, :len(part)] = np.frombuffer(part, np.uint8)
        owner = np.repeat(np.arange(len(parts)), count)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, width, axis=1)[owner, shift])
        size = np.array([len(p) for p in parts])
        # one anchor hash after another: suffixes of different hashes may share a long prefix, which does no harm
        length, source = factors(keys, size[owner] - shift, np.arange(len(owner)), min_length)
        hit = length >= min_length
        if not keep_first:
            hit[source[hit]] = True
        at = np.flatnonzero(hit)
        if len(at):
            begin = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])])
            first = at[begin]
            yield pa.record_batch([pa.array(rows["id_at"][order][owner[first]]), pa.array(rows["text_hash"][order][owner[first]]),
                                   pa.array((place[owner[first]] >> 24) + shift[first]),
                                   pa.array(np.diff(np.append(np.flatnonzero(begin), len(at))))], schema=schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 2 * MAX_GROUP:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.column("hash")[-1].as_py()
            whole = int(np.searchsorted(table.column("hash").to_numpy(), last, "left"))
            if whole:
                yield from portions(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield from portions(pa.Table.from_batches(held))

    def portions(table: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes = table.column("hash").to_numpy()
        start = 0
        while start < len(hashes):
            end = int(np.searchsorted(hashes, hashes[min(len(hashes) - 1, start + MAX_GROUP // 4)], "right"))
            part = table.slice(start, end - start)
            yield from solve({n: part.column(n).to_numpy() for n in ("id_at", "text_hash", "place")} | {"part": part.column("part").to_pylist()})
            start = end
    return apply


def _fetch(min_length: int) -> Callable:
    """mapInArrow function: (text bytes, list of its runs) -> one row per run with the bytes that its windows cover."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                data = one.column("bytes")[0].as_buffer()
                for group in range(0, len(one.column("runs")[0]), 4096):
                    wanted = one.column("runs")[0].values.slice(group, 4096)
                    place = wanted.field("place").to_numpy()
                    first, count = place >> 24, (place >> 12) & 0xFFF
                    parts = [data.slice(int(a), int(n) + min_length - 1).to_pybytes() for a, n in zip(first, count)]
                    n = len(parts)
                    yield pa.record_batch(
                        [wanted.field("hash"), wanted.field("big"), one.column("id_at").take(pa.array([0] * n)),
                         one.column("text_hash").take(pa.array([0] * n)), wanted.field("place"), pa.array(parts, pa.binary())],
                        names=["hash", "big", "id_at", "text_hash", "place", "part"])
    return apply


def _single_windows(min_length: int) -> Callable:
    """mapInArrow function: a run of a very frequent hash -> one row per window with its digest."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                view = memoryview(row["part"])
                n = (row["place"] >> 12) & 0xFFF
                digest = [xxhash.xxh3_128_digest(view[i:i + min_length]) for i in range(n)]
                yield pa.record_batch(
                    [pa.array(digest, pa.binary()), pa.array([row["id_at"]] * n, pa.int64()), pa.array([row["text_hash"]] * n, pa.int64()),
                     pa.array([(row["place"] >> 24) + i for i in range(n)], pa.int64())],
                    names=["digest", "id_at", "text_hash", "place"])
    return apply


def repeated_intervals(docs: DataFrame, min_length: int, keep_first: bool, anchor_length: int) -> DataFrame:
    """(id_at, text_hash, place, windows): window starts whose bytes go. ``docs`` has id_at, text_hash, bytes."""
    fields = [("id_at", pa.int64()), ("text_hash", pa.int64()), ("hash", pa.int64()), ("digest", pa.int64()), ("place", pa.int64())]
    brief = docs.select("bytes").mapInArrow(
        find_runs(min_length, anchor_length, [], pa.schema(fields[2:])), "hash long, digest long, place long")
    repeated = stage(brief.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
                     .filter("n > 1").select("hash", "n", (F.lit(keep_first) | F.expr("low <> high")).alias("mixed")), "lpf-hashes")
    full = docs.mapInArrow(find_runs(min_length, anchor_length, ["id_at", "text_hash"], pa.schema(fields)),
                           "id_at long, text_hash long, hash long, digest long, place long")
    found = stage(heavy_join(full, repeated, ["hash"], "n").drop("n"), "lpf-runs")
    windows = F.shiftright("place", 12).bitwiseAND(F.lit(0xFFF))
    plain = (F.shiftright("place", 24).alias("place"), windows.alias("windows"))
    copies = found.filter("NOT mixed").select("id_at", "text_hash", *plain)

    mixed = found.filter("mixed")
    strings = stage(mixed.groupBy("hash", "digest").agg(
        F.count(F.lit(1)).alias("m"), F.min(F.struct(F.col("id_at"), F.col("text_hash"), F.col("place"))).alias("first")), "lpf-strings")
    later = heavy_join(mixed, strings.filter("m > 1"), ["hash", "digest"], "m")
    if keep_first:
        later = later.filter(F.struct("id_at", "text_hash", "place") != F.col("first"))
    later = later.select("id_at", "text_hash", *plain)

    # representatives of the hashes that more than one string shares; in the both-sides mode those already known to
    # repeat serve as witnesses only
    spread = strings.groupBy("hash").agg(F.count(F.lit(1)).alias("strings")).filter("strings > 1")
    wanted = heavy_join(strings, spread, ["hash"], "strings").select(
        "hash", (F.col("strings") > MAX_GROUP).alias("big"), "first.*")
    lists = wanted.groupBy("id_at", "text_hash").agg(F.collect_list(F.struct("hash", "big", "place")).alias("runs"))
    texts = docs.groupBy("id_at", "text_hash").agg(F.first("bytes").alias("bytes"))
    parts = stage(texts.join(lists, ["id_at", "text_hash"]).select("id_at", "text_hash", "bytes", "runs").mapInArrow(
        _fetch(min_length), "hash long, big boolean, id_at long, text_hash long, place long, part binary"), "lpf-parts")
    few = (parts.filter("NOT big").repartition("hash").sortWithinPartitions("hash")
           .mapInArrow(_resolve(min_length, keep_first), "id_at long, text_hash long, place long, windows long"))
    single = stage(parts.filter("big").mapInArrow(_single_windows(min_length), "digest binary, id_at long, text_hash long, place long"),
                   "lpf-windows")
    same = single.groupBy("digest").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("id_at", "text_hash", "place")).alias("first")).filter("m > 1")
    many = heavy_join(single, same, ["digest"], "m")
    if keep_first:
        many = many.filter(F.struct("id_at", "text_hash", "place") != F.col("first"))
    many = many.select("id_at", "text_hash", "place", F.lit(1).cast("long").alias("windows"))
    return copies.unionByName(later).unionByName(few).unionByName(many)


def _cut(min_length: int, id_fields: list[str]) -> Callable:
    """mapInArrow function: text bytes and window intervals -> removed spans and kept bytes."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("bytes"), batch.column("intervals")
            starts, ends, kept = [], [], []
            for k in range(batch.num_rows):
                data = texts[k].as_buffer() if texts[k].is_valid else pa.py_buffer(b"")
                if not lists[k].is_valid:
                    starts.append([])
                    ends.append([])
                    kept.append(data.to_pybytes())
                    continue
                place = lists[k].values.field("place").to_numpy()
                last = place + lists[k].values.field("windows").to_numpy() + min_length - 1
                order = np.argsort(place, kind="stable")
                place, reach = place[order], np.maximum.accumulate(last[order])
                begin = np.flatnonzero(np.concatenate([[True], place[1:] > reach[:-1]]))
                a, b = place[begin], reach[np.append(begin[1:], len(place)) - 1]
                keep = np.ones(data.size, bool)
                for x, y in zip(a, b):
                    keep[x:y] = False
                starts.append(a.tolist())
                ends.append(b.tolist())
                kept.append(np.frombuffer(data, np.uint8)[keep].tobytes())
            yield pa.record_batch(
                [batch.column(n) for n in id_fields] + [pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
                names=[*id_fields, "starts", "ends", "kept"])
    return apply


def remove_repeats(docs: DataFrame, min_length: int = 200, keep_first: bool = True, id_col: str = "doc_id",
                   text_col: str = "text", anchor_length: int = ANCHOR_LENGTH) -> DataFrame:
    """The bytes of every text without strings of ``min_length`` bytes that repeat.

    Returns one row per input row: ``id_col``, ``n_bytes``, ``starts`` and ``ends`` (arrays: the maximal removed
    runs, end exclusive) and ``kept`` (binary: the remaining bytes). With ``keep_first`` the first copy in the order
    of (id, text hash, offset) stays, and rows equal in both get one verdict; otherwise every byte goes that is
    covered by a string which starts anywhere else. The id must be a whole number; other columns are not read.
    """
    if not anchor_length <= min_length <= anchor_length + 4000:
        raise ValueError("min_length must be between anchor_length and anchor_length + 4000 bytes")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    id_at = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))  # null ids last
    base = docs.select(id_at.alias("id_at"), F.xxhash64(raw).alias("text_hash"), raw.alias("bytes"))
    found = repeated_intervals(base, min_length, keep_first, anchor_length)
    lists = found.groupBy("id_at", "text_hash").agg(F.collect_list(F.struct("place", "windows")).alias("intervals"))
    marked = docs.select(F.col(id_col).cast("long").alias("id"), id_at.alias("id_at"), F.xxhash64(raw).alias("text_hash"), raw.alias("bytes"))
    cut = (marked.join(lists, ["id_at", "text_hash"], "left").select("id", "bytes", "intervals")
           .mapInArrow(_cut(min_length, ["id"]), "id long, starts array<long>, ends array<long>, kept binary"))
    return cut.select(F.col("id").alias(id_col), "starts", "ends", "kept",
                      (F.octet_length("kept") + F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"),
                                                            lambda s, x: s + x["ends"] - x["starts"])).cast("long").alias("n_bytes"))
