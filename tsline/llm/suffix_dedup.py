"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere are removed.

Every string of ``length`` bytes chooses an anchor: the substring of ``gram``
bytes in it with the smallest hash (the leftmost of equal ones). Equal strings
choose equal anchors at the same place, so strings need comparing only where
their anchors are equal. Strings of one document that share an anchor stand side
by side; they are handled as one segment. Segments with equal content repeat as
a whole. The others of an anchor are sorted as suffixes in the deep-shallow way:
a multikey sort to a shallow depth, one eight-byte key at a time, then blind
tries for the groups that still share a prefix; neighbours in that order that
agree on ``length`` bytes are repeats. An anchor of more segments than a task sorts
is split first: its strings choose longer anchors, up to the whole string.

Defined cases: null counts as empty; texts shorter than ``length`` lose nothing;
overlapping occurrences in one document count; rows that repeat an id and text
repeat each other; matches never cross documents; an empty table gives an empty
result; extra columns are not carried. Anchors only propose; equal segments are
taken as equal by a 64-bit hash of their bytes beside the 64-bit hash of their
anchor, all other decisions compare bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsline.llm.shared import bounded, mix64, require, text_buffer, write_scratch

LENGTH = 400
GRAM = 128
#: Bytes of text that are hashed at a time.
PIECE = 1 << 20
#: Depth of the multikey sort, in keys of eight bytes.
SHALLOW = 4
#: A task sorts at most this many distinct segments of an anchor; longer anchors split those of more.
GROUP_SEGMENTS = 20_000
#: Bytes of segments that are sorted at a time.
SORT_BYTES = 1 << 20
_PLACE_BITS = 21


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` adjacent values."""
    n = len(values)
    pad = -n % width
    full = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    head = np.minimum.accumulate(full, axis=1).ravel()
    tail = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - width + 1], head[width - 1:n])


class Anchors:
    """Finds the anchors of texts; keeps the powers of the rolling hash between calls."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, piece: int = PIECE):
        self.length, self.gram, self.piece = length, gram, piece
        self.width = length - gram + 1  # anchors to choose from in a string
        base = 0x9E3779B97F4A7C15
        size = 2 * piece + length
        self.power, self.inverse = (
            np.cumprod(np.append(np.uint64(1), np.full(size, step, np.uint64)), dtype=np.uint64)
            for step in (np.uint64(base), np.uint64(pow(base, -1, 1 << 64))))
        self.codes = mix64(np.arange(1, 257, dtype=np.uint64))

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """``(row, place, first, last, anchor hash)`` arrays: strings starting at first..last of a row
        choose the anchor at place (all counted from the row's start)."""
        found = []
        row, n_rows = 0, len(offsets) - 1
        while row < n_rows:
            size = offsets[row + 1] - offsets[row]
            if size > self.piece:  # a long text, by overlapping pieces
                for at in range(0, int(size) - self.length + 1, self.piece):
                    end = min(int(size), at + self.piece + self.length - 1)
                    ends = np.array([0, end - at], np.int64)
                    part = self._piece(data[offsets[row] + at:offsets[row] + end], ends)
                    found.append((part[0] + row, *(x + at for x in part[1:4]), part[4]))
                row += 1
                continue
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + self.piece, side="right")) - 1)
            part = self._piece(data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row])
            found.append((part[0] + row, *part[1:]))
            row = stop
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.int64),)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _piece(self, data: np.ndarray, ends: np.ndarray):
        n = len(data)
        if n < self.length:
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.codes[data] * self.power[:n])])
        grams = mix64((sums[self.gram:] - sums[:-self.gram]) * self.inverse[:n - self.gram + 1])
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        chosen = sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), self.width) & mask
        chosen = chosen.astype(np.int64)
        starts = np.arange(len(chosen))
        rows = np.searchsorted(ends, starts, side="right") - 1
        inside = starts + self.length <= ends[rows + 1]
        starts, chosen, rows = starts[inside], chosen[inside], rows[inside]
        if not len(starts):
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        new = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (rows[1:] != rows[:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        owner = rows[first]
        return (owner, chosen[first] - ends[owner], starts[first] - ends[owner], starts[last] - ends[owner],
                grams[chosen[first]].view(np.int64))


def deep_shallow(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int = LENGTH,
                 shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by group and their first ``length`` bytes, and which of them equal the one before.

    ``length`` is a multiple of 8. All groups are sorted at once: each pass
    splits every group that is still open.
    """
    depth = length // 8
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data) + length, np.uint64)
    for i in range(8):
        words |= padded[i:i + len(words)] << np.uint64(56 - 8 * i)
    order = np.argsort(groups, kind="stable")
    same = np.concatenate([[False], groups[order][1:] == groups[order][:-1]]) if len(order) else np.zeros(0, bool)

    def runs(same):
        """Positions in runs of several, and each one's run number."""
        joined = same.copy()
        joined[:-1] |= same[1:]
        at = np.flatnonzero(joined)
        return at, np.cumsum(~same[at])

    # multikey sort: open runs are split by one key of eight bytes at a time
    for d in range(min(shallow, depth)):
        at, run = runs(same)
        if not len(at):
            break
        key = words[starts[order[at]] + 8 * d]
        place = np.lexsort((key, run))
        order[at] = order[at][place]
        key, run = key[place], run[place]
        same[at] = np.concatenate([[False], (run[1:] == run[:-1]) & (key[1:] == key[:-1])])
    # blind tries: a run's first suffix is the path; the others branch off it at their first differing key
    at, run = runs(same)
    from_depth = np.full(len(at), min(shallow, depth), np.int64)
    while len(at):
        own = starts[order[at]]
        head = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        which = np.cumsum(np.concatenate([[True], run[1:] != run[:-1]])) - 1
        path = own[head][which]
        branch = from_depth.copy()
        left = np.flatnonzero(branch < depth)
        while len(left):
            left = left[words[own[left] + 8 * branch[left]] == words[path[left] + 8 * branch[left]]]
            branch[left] += 1
            left = left[branch[left] < depth]
        cut = np.minimum(branch, depth - 1)
        key, on_path = words[own + 8 * cut], words[path + 8 * cut]
        side = np.where(branch == depth, 0, np.where(key < on_path, -1, 1))
        deep = np.where(side < 0, branch, -branch)
        place = np.lexsort((np.where(side == 0, np.uint64(0), key), deep, side, which))
        order[at] = order[at][place]
        which, side, deep, key, branch = (x[place] for x in (which, side, deep, key, branch))
        mates = (which[1:] == which[:-1]) & (side[1:] == side[:-1]) & (deep[1:] == deep[:-1])
        mates &= (side[1:] == 0) | (key[1:] == key[:-1])
        joined = np.concatenate([[False], mates])
        same[at] = joined
        # branches of several suffixes are tries of their own, below the key they share
        several = joined.copy()
        several[:-1] |= joined[1:]
        several &= side != 0
        run = np.cumsum(~joined)[several]
        at, from_depth = at[several], branch[several] + 1
        # a branch that shares all keys is decided
        done = from_depth >= depth
        at, run, from_depth = at[~done], run[~done], from_depth[~done]
    return order, same


def _spans(data: np.ndarray, ends: np.ndarray, anchors: np.ndarray, length: int):
    """Which strings of segments repeat: ``(segment, offset)`` of each repeated one."""
    many = np.maximum(np.diff(ends) - length + 1, 0)
    owner = np.repeat(np.arange(len(many)), many)
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    order, same = deep_shallow(data, ends[owner] + offset, anchors[owner], length)
    repeated = same.copy()
    repeated[:-1] |= same[1:]
    hit = np.sort(order[repeated])
    return owner[hit], offset[hit]


def _merge(owner: np.ndarray, offset: np.ndarray):
    """Adjacent offsets of an owner as ``(owner, first, last)``."""
    if not len(owner):
        return owner, offset, offset
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], offset[first], offset[last]


_SPAN = "id long, th long, start long, stop long"


def _span_batch(ids, ths, starts, stops) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, ths, starts, stops)],
                                      names=["id", "th", "start", "stop"])


def _sort_segments(batches, length: int):
    """Repeated spans of the single segments among ``(anchor, id, th, at, single, segment)`` rows sorted by anchor."""
    held, size, current = [], 0, None

    def solve(rows):
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        ends = np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])])
        anchors = np.array([r[0] for r in rows])
        owner, offset = _spans(data, ends, anchors, length)
        single = np.array([r[4] for r in rows], bool)
        owner, offset = owner[single[owner]], offset[single[owner]]
        owner, first, last = _merge(owner, offset)
        at = np.array([r[3] for r in rows], np.int64)[owner]
        return _span_batch(np.array([r[1] for r in rows], np.int64)[owner],
                           np.array([r[2] for r in rows], np.int64)[owner], at + first, at + last + length)

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[0] != current:
                if size >= SORT_BYTES:
                    yield solve(held)
                    held, size = [], 0
                current = row[0]
            held.append(row)
            size += len(row[5])
    if held:
        yield solve(held)


def _combined(row, anchor, content, first, last):
    """Segments of a row that are equal in anchor, content and length as one, with the starts of the others."""
    order = np.lexsort((first, content, anchor, row))
    row, anchor, content, first, last = (x[order] for x in (row, anchor, content, first, last))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    head = np.flatnonzero(new)
    many = np.diff(np.append(head, len(row)))
    later = np.concatenate([[0], np.cumsum(many - 1)])
    others = pa.ListArray.from_arrays(pa.array(later, pa.int32()), pa.array(first[~new], pa.int64()),
                                      mask=pa.array(many == 1))
    return row[head], anchor[head], content[head], first[head], others, (last - first)[head]


def _found_anchors(bodies: DataFrame, length: int, gram: int, piece: int) -> DataFrame:
    """The segments of ``bodies(id, th, base, body)`` whose anchor occurs again; equal ones of a body are one row."""
    def anchors(batches):
        finder = Anchors(length, gram, piece)
        for batch in bounded(batches, 3):
            data, offsets = text_buffer(batch.column(3))
            row, place, first, last, anchor = finder.of(data, offsets)
            raw = memoryview(np.ascontiguousarray(data))
            at, stop = offsets[row] + first, offsets[row] + last + length
            content = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], seed=s) for a, b, s in zip(
                at.tolist(), stop.tolist(), (place - first).tolist())), np.uint64, len(row)).view(np.int64)
            row, anchor, content, first, others, more = _combined(row, anchor, content, first, last)
            of = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(of) for i in range(3)), pa.array(anchor), pa.array(content), pa.array(first),
                 others, pa.array(more.astype(np.int32))],
                names=["id", "th", "base", "anchor", "content", "at", "others", "more"])

    every = write_scratch(bodies.mapInArrow(
        anchors, "id long, th long, base long, anchor long, content long, at long, others array<long>, more int"), "anchors")
    # most anchors occur once, in text that nothing repeats; only the others' segments go on
    shared = write_scratch(every.groupBy("anchor").agg(F.sum(_times()).alias("n")).where("n > 1").select("anchor"),
                           "shared-anchors")
    return write_scratch(every.join(shared.hint("merge"), "anchor", "left_semi"), "shared-segments")


def _times():
    """How often a row's segment occurs in its body."""
    return F.coalesce(F.size("others"), F.lit(0)) + 1


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   most: int = GROUP_SEGMENTS, piece: int = PIECE) -> DataFrame:
    """``(id, th, start, stop)`` byte spans, overlapping ones too, of ``texts(id, th, text)``."""
    return _spans_of(texts.select("id", "th", F.lit(0).cast("long").alias("base"), F.encode("text", "utf-8").alias("body")),
                     length, gram, most, piece)


def _spans_of(bodies: DataFrame, length: int, gram: int, most: int, piece: int) -> DataFrame:
    """Spans of ``bodies(id, th, base, body)``; a body starts at ``base`` of its text."""
    found = _found_anchors(bodies, length, gram, piece)
    classes = found.groupBy("anchor", "content").agg(
        F.sum(_times()).alias("n"), F.first(F.struct("id", "th", "base", "at", "more")).alias("one"))
    groups = write_scratch(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments"))
                           .where("segments > 1"), "anchor-groups")
    twice = classes.where("n > 1").select(F.col("anchor").alias("a"), F.col("content").alias("c"))
    whole = found.join(twice, (F.col("anchor") == F.col("a")) & (F.col("content") == F.col("c")), "left_semi").select(
        "id", "th", "base", "more", F.explode(F.concat(F.array("at"), F.coalesce("others", F.array().cast("array<long>"))))
        .alias("at")).select("id", "th", (F.col("base") + F.col("at")).alias("start"),
                             (F.col("base") + F.col("at") + F.col("more") + length).alias("stop"))
    open_ = classes.select("anchor", "n", "one.*").join(groups, "anchor")
    wanted = open_.groupBy("id", "th", "base").agg(F.collect_list(F.struct(
        "anchor", "at", "more", (F.col("n") == 1).alias("single"), (F.col("segments") > most).alias("large"))).alias("wanted"))
    met = bodies.join(wanted, ["id", "th", "base"])

    def cut(large: bool):
        def run(batches):
            for batch in bounded(batches, 3):
                rows, seen = [], set()
                ids, ths, bases = (batch.column(i).to_pylist() for i in range(3))
                for i, (raw, wanted) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                    if (ids[i], ths[i], bases[i]) in seen:
                        continue
                    seen.add((ids[i], ths[i], bases[i]))
                    rows += [(w["anchor"], ids[i], ths[i], bases[i] + w["at"], w["single"],
                              raw[w["at"]:w["at"] + w["more"] + length]) for w in wanted if w["large"] == large]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], t) for j, t in enumerate(
                        (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                    names=["anchor", "id", "th", "at", "single", "segment"])

        return met.select("id", "th", "base", "body", "wanted").mapInArrow(
            run, "anchor long, id long, th long, at long, single boolean, segment binary")

    sorted_ = (cut(False).repartition("anchor").sortWithinPartitions("anchor")
               .mapInArrow(lambda batches: _sort_segments(batches, length), _SPAN))
    spans = whole.unionByName(sorted_)
    if gram == length or groups.where(F.col("segments") > most).isEmpty():
        return spans
    longer = write_scratch(cut(True).select("id", "th", F.col("at").alias("base"), F.col("segment").alias("body")),
                           "large-anchors")
    return spans.unionByName(_spans_of(longer, length, min(2 * gram, length), most, piece))


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = GROUP_SEGMENTS,
                 piece: int = PIECE) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``: the removed byte spans, merged, and the bytes that stay.

    Texts are shuffled once by document; fetching segments and removing spans
    read the same exchange.
    """
    require(docs, "doc_id", "text")
    if length % 8 or not 0 < gram <= length or 2 * piece + length >= 1 << _PLACE_BITS + 1:
        raise ValueError("length must be a multiple of 8, gram at most length, and piece at most 2 ** 20")
    full = F.coalesce("text", F.lit(""))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                        F.xxhash64(full).alias("th"), full.alias("text"))
    spans = repeated_spans(texts, length, gram, most, piece).groupBy("id", "th").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans"))

    def remove(batches):
        for batch in bounded(batches, 1):
            data, offsets = text_buffer(batch.column(1))
            out, kept = [], []
            for r, spans in enumerate(batch.column(2).to_pylist()):
                raw = data[offsets[r]:offsets[r + 1]]
                merged = []
                for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                stay = np.ones(len(raw), bool)
                for a, b in merged:
                    stay[a:b] = False
                out.append([{"start": a, "stop": b} for a, b in merged])
                kept.append(raw[stay].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)),
                 pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    joined = texts.join(spans, ["id", "th"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(remove, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") > -(1 << 63), F.col("doc_id")))
