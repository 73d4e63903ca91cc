"""N-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric. Pivots drawn from a region split it into Voronoi
cells; a document also goes to every cell whose pivot is at most twice the
radius further than its own (the triangle inequality: a partner of it may live
there); cells are split again until they are small, and small cells are joined
exactly, by set intersection.

Documents without shared shingles are all at distance 1 of each other, and there
pivots cannot tell them apart, so the starting regions are made first, exactly:
two sets whose similarity reaches the threshold differ in at most ``k`` shingles,
so if the shingles are dealt by hash into more than ``k`` parts, one is equal in
both. Where such parts hold few shingles, at a low threshold, unrelated sets that
share a passage would have equal ones too; there the shingles are dealt into
``(k + 1) / 2`` groups of three parts, one group differs in one part at most, and
two of its parts are equal in both. Sets with equal parts are tied together, unless
their sizes or parity bitmaps show that they cannot link, and the connected
components are the starting regions. No link can cross them. Parts that too many
sets share, or that are empty, tie nothing; the sets that so may have lost a partner
(it must be one of them too) are compared by their rarest shingles: of two linked sets
the first shingle in common, in one order of all, is among the first of each.

Links are kept as a spanning forest: documents that a pivot links are settled
with each other and not compared again, so a group of near copies costs its size
times the number of pivots, not its square.

Defined cases: null counts as empty; a text without words has no shingles and
is linked with nothing; a text of fewer words than a shingle has its whole
sequence as one shingle; equal sets are always linked; a similarity exactly at
the threshold links; rows are told apart by their sets, so rows without an id or
of a repeated one are linked like all others, and a group of rows without any id
has a null ``component_id``; repeated rows are linked with each other; an empty
table gives an empty result; extra columns are not carried. Shingles are compared
by 64-bit hashes and whole sets by 128-bit ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsline.llm.shared import bounded, components, free_shuffles, mix64, require, text_buffer, word_view, write_scratch

#: Pivots of a region, at most 62.
PIVOTS = 16
#: A region is joined in one task when it has at most this many sets and shingles.
REGION_ROWS = 2048
REGION_SHINGLES = 1_000_000
#: Mean shingles of a part from which single parts tie; below it, two of the three parts of a group do.
PART_SHINGLES = 8
#: A key of more sets is common: its sets are not taken as pairs.
KEY_SETS = 16
#: Pairs that a task holds to drop those it has seen.
PAIRS_HELD = 1 << 20
#: Shingles of open sets that a task holds to make keys of.
SHINGLES_HELD = 1 << 18
#: Bits of a set's parities, as powers of two.
MIN_BITS, MAX_BITS = 6, 12


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the k-word shingles of each row."""
    words, index, rows = word_view(column, fold=True)
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    each = known[index]
    odd = np.uint64(0x9E3779B97F4A7C15)
    rolled = each
    for j in range(1, k):
        rolled = mix64(rolled[:-1] * odd + each[j:]) if len(rolled) > 1 else rolled[:0]
    out = []
    for a, b in zip(rows[:-1], rows[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for w in each[a:b]:
                short = mix64(short * odd + w)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digest(found: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(found.tobytes())


def set_number(found: np.ndarray) -> int:
    """A 64-bit name of a set; equal names only ever put sets into one region."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def size_classes(top: int, num: int, den: int) -> np.ndarray:
    """Upper bounds of the size classes; a set's partners lie in its class and the ones beside it."""
    bounds = [1]
    while bounds[-1] < top:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * den // num))
    return np.array(bounds, np.int64)


def parts_of(num: int, den: int) -> int:
    """Parts of a group, by the mean number of shingles that a single part would have."""
    return 1 if den + num >= 2 * PART_SHINGLES * (den - num) else 3


def part_keys(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every set, and the row of each key; linked sets have one in common."""
    return _keys_and_slack(sets, num, den)[:2]


def _keys_and_slack(sets: list[np.ndarray], num: int, den: int, empties: bool = True,
                    half: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the row of each key, and how many keys a row may lose and still share one with all it is linked with.

    Within a class of sizes up to u, sets at the threshold differ in at most
    ``k = (den - num) 2u / (den + num)`` shingles. Shingles are dealt into groups.
    A group of a single part is a key; of ``k + 1 + spare`` such groups at least
    ``1 + spare`` are equal. In groups of several parts, each choice of all but one
    is a key; of ``(k + 1) / 2 + spare`` such groups at least ``1 + spare`` differ
    in one shingle at most, and share the key that leaves out its part. That key may
    be of empty parts; only sets with such a choice in more than ``spare`` groups
    need keys of empty parts, and they alone have them. Where k is 0 the whole set
    is the key. A set joins its own class and the next one, where a larger partner
    may be. A set may lose its keys of as many groups as ``spare`` has beyond those with
    empty choices; one that needs keys of empty parts may lose none (-1).
    Without ``empties`` there are no keys of empty parts: a set of -1 may share no
    key with a partner that is also of -1. ``half`` asks for the keys and slack of the even (0)
    or odd (1) classes only, one of each set's two.
    """
    width = parts_of(num, den)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.full(len(sets), -1)
    bounds = size_classes(int(sizes.max()) + 1, num, den)
    bounds = np.append(bounds, max(bounds[-1] + 1, bounds[-1] * den // num))
    differ = (den - num) * 2 * bounds // (den + num)
    spare = np.where(differ > 0, 1 + differ // 16, 0)
    groups = np.where(differ > 0, (differ + 1 if width == 1 else (differ + 2) // 2) + spare, 1)
    own = np.searchsorted(bounds, sizes)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    place = flat >> np.uint64(32)  # rows are sorted by hash, so their parts come in order
    value = mix64(flat + np.uint64(0x51ED270B))
    keys, rows, slack = [], [], []
    for level in (own, own + 1) if half is None else (own + ((own + half) & 1),):
        many = np.where(sizes > 0, groups[level], 0)
        base = np.concatenate([[0], np.cumsum(many)])
        owner = np.repeat(np.arange(len(sets)), many)
        number = np.arange(base[-1]) - base[owner]
        part = width * base[row] + ((place * (width * many[row]).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums, held = np.zeros((2, width * base[-1]), np.uint64)
        sums[part[first]] = mix64(np.add.reduceat(value, first) + part[first].astype(np.uint64) % np.uint64(width))
        held[part[first]] = np.diff(np.append(first, len(part))).astype(np.uint64)
        sums, held = sums.reshape(-1, width), held.reshape(-1, width).astype(np.int64)
        salt = mix64((level[owner] * (1 << 32) + number).astype(np.uint64))
        if width == 1:
            left, empty = sums.copy(), held == 0
        else:
            left = sums.sum(axis=1)[:, None] - sums + np.arange(1, width + 1, dtype=np.uint64)[None, :]
            empty = held.sum(axis=1)[:, None] == held
        exact = differ[level[owner]] == 0  # one key of the whole set
        left[exact, 0] = sums[exact].sum(axis=1)
        empty[exact, 0], empty[exact, 1:] = False, True
        odd = np.bincount(owner[empty.any(axis=1) & ~exact], minlength=len(sets))
        wanted = ~empty
        if empties:
            wanted |= ((odd > spare[level])[owner] & ~exact)[:, None]
        keys.append(mix64(left + salt[:, None])[wanted])
        rows.append(np.broadcast_to(owner[:, None], wanted.shape)[wanted])
        slack.append(np.where(odd > spare[level], -1, spare[level] - odd))
    return np.concatenate(keys).view(np.int64), np.concatenate(rows), np.min(slack, axis=0)


def parity_bits(found: np.ndarray) -> bytes:
    """Whether an even or odd number of a set's hashes ends in each bit pattern, for about as many patterns as hashes.

    Two such strings differ in no more bits than the sets differ in shingles, also
    when the longer one is folded to the length of the other.
    """
    width = 1 << min(max(int(len(found) - 1).bit_length(), MIN_BITS), MAX_BITS)
    ends = (found & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(ends, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(left: pa.Array, right: pa.Array, n_left: np.ndarray, n_right: np.ndarray, num: int, den: int) -> np.ndarray:
    """False where sizes and parity bits show that two sets are below the threshold."""
    few, many = np.minimum(n_left, n_right), np.maximum(n_left, n_right)
    out = den * few >= num * many
    (x, at), (y, to) = text_buffer(left), text_buffer(right)
    lengths, other = np.diff(at), np.diff(to)
    for a, b in np.unique(np.stack([lengths, other]), axis=1).T:
        rows = np.flatnonzero((lengths == a) & (other == b) & out)
        short = min(a, b)
        one = x[at[rows][:, None] + np.arange(a)].reshape(len(rows), a // short, short)
        two = y[to[rows][:, None] + np.arange(b)].reshape(len(rows), b // short, short)
        differ = np.bitwise_xor.reduce(one, axis=1) ^ np.bitwise_xor.reduce(two, axis=1)
        apart = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        out[rows] = apart * (den + num) <= (few + many)[rows] * (den - num)
    return out


def _hub(low: np.ndarray) -> np.ndarray:
    """A name, at least 0, of the runs whose smallest set this is; no set of its own."""
    return (mix64(low.view(np.uint64) ^ np.uint64(0x6A09E667F3BCC909)) >> np.uint64(1)).view(np.int64)


def _runs(keys: np.ndarray, *ids: np.ndarray):
    """Start and length of every run of a sorted array, and the run of each row."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(keys)))
    return first, many, np.repeat(np.arange(len(first)), many)


def _pairs(ids: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All pairs inside each run, the smaller id first: two rows of distinct columns."""
    out = [np.zeros((2, 0), np.int64)]
    for size in np.unique(many[many > 1]):
        inside = ids[first[many == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        out.append(np.stack([inside[:, i].ravel(), inside[:, j].ravel()]))
    return _distinct(np.concatenate(out, axis=1))


def _distinct(pairs: np.ndarray) -> np.ndarray:
    order = np.lexsort(pairs[::-1])
    pairs = pairs[:, order]
    fresh = np.ones(pairs.shape[1], bool)
    fresh[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
    return pairs[:, fresh]


def _with_hash(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.withColumn("text_hash", text_hash())


def _describe(hashed: DataFrame, k: int) -> DataFrame:
    """Size, names and parity bits of the shingle set of every row."""
    def describe(batches):
        for batch in bounded(batches, 1):
            sets = shingle_sets(batch.column(1), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_digest(s) if len(s) else None for s in sets], pa.string()),
                 pa.array([set_number(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([parity_bits(s) if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "digest", "number", "bits"])

    return write_scratch(hashed.mapInArrow(
        describe, "doc_id long, text_hash long, n_shingles long, digest string, number long, bits binary"), "shingle-sets")


def _ties(a: np.ndarray, b: np.ndarray, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.broadcast_to(n, a.shape).astype(np.int32))],
                                      names=["a", "b", "n"])


def _counted(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Ties with how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else order
    return _ties(a[first], b[first], np.diff(np.append(first, len(a))))


def _dealt(names: np.ndarray, keys: np.ndarray, rows: np.ndarray, most: int,
           slack: np.ndarray | None = None) -> pa.RecordBatch:
    """A batch's keys as rows to be dealt by key: ``(key, a, b)``; a key of more than ``most`` sets is common.

    ``b`` is null for a key's set, -1 for a key that is common in this batch already, below
    -1 a set's slack, else the hub of a set. Such a key leaves the batch as ties to the
    batch's hub and one row, so no task sees all sets of a key that a third of all share.
    """
    ids = names[rows]
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first, many, run = _runs(keys)
    common = many > most
    inside = common[run]
    low = ids[first]
    code = np.full(len(ids), -1, np.int64)
    code[inside] = _hub(low)[run[inside]]
    placed = [np.where(inside, mix64(ids.view(np.uint64)).view(np.int64), keys), keys[first[common]]]
    every, codes = [ids, low[common]], [code, np.full(int(common.sum()), -1, np.int64)]
    known = [inside, np.ones(int(common.sum()), bool)]
    if slack is not None:
        placed.append(mix64(names.view(np.uint64)).view(np.int64))
        every.append(names)
        codes.append(-3 - slack)
        known.append(np.ones(len(names), bool))
    placed, every, codes, known = (np.concatenate(x) for x in (placed, every, codes, known))
    order = np.argsort(every, kind="stable")  # rows of one set side by side take less room
    return pa.RecordBatch.from_arrays(
        [pa.array(placed[order]), pa.array(every[order]), pa.array(codes[order], mask=~known[order])],
        names=["key", "a", "b"])


def _tied(batches, most: int):
    """Ties ``(a, b, n)`` of keys that arrive sorted.

    The sets of a key that at most ``most`` have are taken as pairs (n: 0). A key of
    more is common: its sets are tied to its hub, a node that is no set, n times (-1: the
    tie of a batch's hub). A set's slack comes with -2.
    """
    key, a, plain = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    pairs: list = []
    for batch in batches:
        place, name = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        code = np.asarray(batch.column(2).fill_null(-1))
        if (code < -1).any():
            yield _ties(name[code < -1], -3 - code[code < -1], -2)
        if (code >= 0).any():
            yield _counted(name[code >= 0], code[code >= 0])
        here = code == -1
        # the run that the batch before ended in goes on
        key, a = np.append(key, place[here]), np.append(a, name[here])
        plain = np.append(plain, ~np.asarray(batch.column(2).is_valid())[here])
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (plain[1:] != plain[:-1])
        key, a, plain = key[fresh], a[fresh], plain[fresh]
        first, many, run = _runs(key)
        if not len(first):
            continue
        sets = np.bincount(run[plain], minlength=len(first))
        common = (sets > most) | (sets < many)
        hub = _hub(a[first])[run]
        yield _counted(a[common[run] & plain], hub[common[run] & plain])
        yield _ties(_hub(a[~plain]), hub[~plain], -1)
        whole = (run < len(first) - 1) & ~common[run]
        start, size, _ = _runs(key[whole])
        pairs.append(_pairs(a[whole], start, size))
        if sum(p.shape[1] for p in pairs) > PAIRS_HELD:
            pairs = [_distinct(np.concatenate(pairs, axis=1))]
            if pairs[0].shape[1] > PAIRS_HELD // 2:
                yield _ties(*pairs.pop(), 0)
        rest = first[-1:] if common[-1] else slice(first[-1], None)
        key, a, plain = key[rest], a[rest], plain[rest] & (not common[-1])
    pairs.append(_pairs(a, np.array([0]), np.array([int(plain.sum())])))
    yield _ties(*_distinct(np.concatenate(pairs, axis=1)), 0)


def _all_tied(keys: DataFrame, name: str) -> DataFrame:
    most = KEY_SETS
    return write_scratch(keys.repartition("key").sortWithinPartitions("key", "a").mapInArrow(
        lambda batches: _tied(batches, most), "a long, b long, n int"), name)


def first_keys(sizes: np.ndarray, run: np.ndarray, place: np.ndarray, shingles: np.ndarray, num: int, den: int):
    """Keys of the first shingles of every set, and the set of each key; linked sets have one in common.

    ``shingles`` are those of set ``run``, ``place`` says where each stands in the set by
    one order of all shingles. Two sets of sizes a and b at the threshold share at least
    ``num (a + b) / (num + den)`` shingles, so the first of these has no more than the others
    of its set before it. A set meets its own size class and the ones beside it, each
    with the shingles that the smallest partner there leaves open.
    """
    bounds = size_classes(int(sizes.max()) + 1, num, den)
    bounds = np.append(bounds, max(bounds[-1] + 1, bounds[-1] * den // num))
    lows = np.concatenate([[1], bounds[:-1] + 1])
    own = np.searchsorted(bounds, sizes)
    keys, sets = [], []
    for step in (-1, 0, 1):
        other = np.maximum(own + step, 0)
        least = np.maximum(lows[other], -(-sizes * num // den))
        can = (own + step >= 0) & (least <= bounds[other]) & (least * num <= sizes * den)
        shared = -(-(num * (sizes + least)) // (num + den))
        taken = place < np.where(can, sizes - shared + 1, 0)[run]
        salt = mix64((own + other).astype(np.uint64))
        keys.append(mix64(shingles[taken] + salt[run[taken]]))
        sets.append(run[taken])
    return np.concatenate(keys).view(np.int64), np.concatenate(sets)


def _by_rarest(batches, num: int, den: int, most: int):
    """Keys of sets by their rarest shingles; their shingles that other sets have too come by ``number``, the rarest first."""
    held: list = []

    def solve(number, size, shingle):
        fresh = np.ones(len(number), bool)  # rows that repeat an id with its text
        fresh[1:] = (number[1:] != number[:-1]) | (shingle[1:] != shingle[:-1])
        number, size, shingle = number[fresh], size[fresh], shingle[fresh]
        first, many, run = _runs(number)
        # shingles of no other set come before
        place = np.arange(len(number)) - first[run] + (size[first] - many)[run]
        return _dealt(number[first], *first_keys(size[first], run, place, shingle.view(np.uint64), num, den), most)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([np.asarray(batch.column(c)) for c in ("number", "size", "shingle")])
        if sum(len(x[0]) for x in held) > SHINGLES_HELD:
            number, size, shingle = (np.concatenate(x) for x in zip(*held))
            done = int(np.argmax(number == number[-1]))  # the last set may go on
            if done:
                yield solve(number[:done], size[:done], shingle[:done])
            held = [[number[done:], size[done:], shingle[done:]]]
    if held:
        yield solve(*(np.concatenate(x) for x in zip(*held)))


def _open_ties(hashed: DataFrame, known: DataFrame, names: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Ties, as of :func:`_tied`, that join every two linked ones of the sets of ``names(number)``."""
    rows = known.where("n_shingles > 0").groupBy("number").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("row"))
    wanted = write_scratch(rows.join(names, "number").select(
        "number", F.col("row.doc_id").alias("id"), F.col("row.text_hash").alias("hash")), "open-sets")
    # one plan at every size: the open sets grow with the corpus and are never broadcast
    fetched = hashed.join(wanted.hint("merge"), (F.col("text_hash") == F.col("hash"))
                          & F.col("doc_id").eqNullSafe(F.col("id"))).select("number", "text")

    def spread(batches):
        last = None
        for batch in bounded(batches, 1):
            numbers = batch.column(0).to_pylist()
            # rows that repeat an id with its text come one after the other
            keep = [i for i, x in enumerate(numbers) if x != (numbers[i - 1] if i else last)]
            last = numbers[-1] if numbers else last
            sets = shingle_sets(batch.column(1).take(pa.array(keep, pa.int64())), k)
            many = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([numbers[i] for i in keep], np.int64), many)),
                 pa.array(np.repeat(many, many)),
                 pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))],
                names=["number", "size", "shingle"])

    shingles = write_scratch(fetched.mapInArrow(spread, "number long, size long, shingle long"), "open-shingles")
    free_shuffles(shingles)
    often = shingles.groupBy(F.col("shingle").alias("of")).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    ranked = shingles.join(often, F.col("shingle") == F.col("of")).select("number", "size", "shingle", "times")
    most = KEY_SETS
    keys = (ranked.repartition("number").sortWithinPartitions("number", "times", "shingle")
            .mapInArrow(lambda batches: _by_rarest(batches, num, den, most), "key long, a long, b long"))
    return _all_tied(keys, "tied-open-sets")


def starting_regions(docs: DataFrame, k: int, num: int, den: int, known: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` of the sets, by :func:`set_number`, that may be linked with another one.

    Pairs of sets that share a key of at most ``KEY_SETS`` sets, and that :func:`may_link`
    leaves, are ties. Sets that have too many common keys, or choices of empty parts, to be
    sure of another shared key are open: only two open sets can be linked without such a
    pair, and these get the ties of :func:`_open_ties`, where keys are of their rarest
    shingles, so that passages which many sets share tie nothing but sets made of them.
    """
    most = KEY_SETS

    def parts(half):
        def each(batches):
            for batch in bounded(batches, 0):
                sets = {set_number(s): s for s in shingle_sets(batch.column(0), k) if len(s)}
                if sets:
                    keys, rows, slack = _keys_and_slack(list(sets.values()), num, den, empties=False, half=half)
                    yield _dealt(np.array(list(sets), np.int64), keys, rows, most, slack)
        return each

    hashed = _with_hash(docs)
    if known is None:
        known = _describe(hashed, k)
    # one half of the keys after the other: their rows take more disk than all else, and are freed between
    halves = []
    for half in (0, 1):
        halves.append(_all_tied(hashed.select("text").mapInArrow(parts(half), "key long, a long, b long"), "tied-sets"))
        free_shuffles(halves[-1])
    found = halves[0].union(halves[1])
    sure = F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0)) > F.min(F.when(F.col("n") == -2, F.col("b")))
    lost = found.where("n > 0 OR n = -2").groupBy(F.col("a").alias("number")).agg(sure.alias("open"))
    more = _open_ties(hashed, known, lost.where("open").select("number"), k, num, den)
    free_shuffles(more)
    sketches = known.where("n_shingles > 0").groupBy("number").agg(
        F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    pairs = found.where("n = 0").select("a", "b").union(more.where("n = 0").select("a", "b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("number").alias(side), F.col("n").alias(f"n_{side}"),
                                           F.col("bits").alias(f"bits_{side}")).hint("merge"), side)

    def check(batches):
        for batch in batches:
            a, b, n_a, n_b = (np.asarray(batch.column(c)) for c in ("a", "b", "n_a", "n_b"))
            good = may_link(batch.column("bits_a"), batch.column("bits_b"), n_a, n_b, num, den)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])

    edges = pairs.mapInArrow(check, "a long, b long").union(more.where("n > 0 OR n = -1").select("a", "b"))
    return components(edges, "regions")


def _links(sets: list[np.ndarray], labels: np.ndarray, num: int, den: int) -> np.ndarray:
    """Smallest row linked with each row through exact links, except between rows of one label."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), sizes)
    _, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[where]
    keep = shared[where]
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((n, n), np.float32)
    width = 4096
    cuts = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        block = np.zeros((n, width), np.float32)
        block[row[a:b], column[a:b] - c * width] = 1.0
        total += block @ block.T
    both = total.astype(np.int64)
    linked = den * both >= num * (sizes[:, None] + sizes[None, :] - both)
    root = np.arange(n)
    # rows of one label are linked already, each with all others of it
    for own in np.unique(labels[labels >= 0]):
        mates = np.flatnonzero(labels == own)
        linked[mates[0], mates] = linked[mates, mates[0]] = True
    while True:
        low = np.where(linked, root[None, :], n).min(axis=1)
        low = np.minimum(low, root)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _join_regions(batches, num: int, den: int):
    """Links of the regions that arrive whole and in order: (digest, smallest linked digest)."""
    held: list = []

    def solve(rows):
        seen: dict = {}
        for digest, found, label in rows:
            seen.setdefault(digest, (found, label))
        names = sorted(seen)
        if len(names) < 2:
            return []
        marks = {m: i for i, m in enumerate(sorted({seen[d][1] for d in names if seen[d][1] is not None}))}
        labels = np.array([marks.get(seen[d][1], -1) for d in names])
        root = _links([seen[d][0] for d in names], labels, num, den)
        return [(names[i], names[r]) for i, r in enumerate(root) if i != r]

    def pack(pairs):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()),
                                           pa.array([p[1] for p in pairs], pa.string())], names=["a", "b"])

    current = None
    for batch in batches:
        out = []
        regions, digests, labels = (batch.column(i).to_pylist() for i in (0, 1, 3))
        for i, region in enumerate(regions):
            if region != current:
                out += solve(held)
                held, current = [], region
            held.append((digests[i], batch.column(2)[i].values.to_numpy().view(np.uint64), labels[i]))
        yield pack(out)
    yield pack(solve(held))


def _joined(rows: DataFrame, num: int, den: int) -> DataFrame:
    return (rows.select("region", "digest", "found", "label").repartition("region")
            .sortWithinPartitions("region")
            .mapInArrow(lambda batches: _join_regions(batches, num, den), "a string, b string"))


def _measure(rows: DataFrame, sizes: DataFrame, pivots: int, num: int, den: int) -> DataFrame:
    """Distances of all rows of large regions to their region's pivots.

    ``mask`` has a bit for each pivot a row is linked with, ``home`` is the
    nearest pivot's cell, ``near`` are the cells where a partner may be. Rows
    not settled yet come first as pivots. A region is dealt into as many shares
    as its size needs, each with the pivots beside it, so no task sees more of a
    hot region than any other.
    """
    rank = Window.partitionBy("region").orderBy(F.col("label").isNotNull(), F.xxhash64("digest"), "digest")
    picked = (rows.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= pivots)
              .select(F.col("region").alias("in_region"), F.col("_rank").alias("rank"),
                      F.col("digest").alias("name"), F.col("found").alias("chosen")))
    shares = sizes.select("region", F.ceil(F.col("n") / REGION_ROWS).cast("int").alias("shares"))
    spread = picked.join(shares, picked["in_region"] == shares["region"]).select(
        "in_region", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("in_share"), "rank", "name", "chosen")
    dealt = rows.join(shares, "region").withColumn(
        "share", F.pmod(F.xxhash64("digest"), "shares").cast("int")).drop("shares")

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("rank")
        chosen = [np.array(x, np.int64).view(np.uint64) for x in right["chosen"].to_pylist()]
        names = right["name"].to_pylist()
        home, near, masks, links, pivot = [], [], [], [], []
        for digest, found in zip(left["digest"].to_pylist(), left["found"].to_pylist()):
            own = np.array(found, np.int64).view(np.uint64)
            both = np.array([len(np.intersect1d(own, c, assume_unique=True)) for c in chosen])
            union = np.array([len(own) + len(c) for c in chosen]) - both
            linked = den * both >= num * union
            away = 1.0 - both / union
            home.append(int(away.argmin()))
            # the radius is 1 - num / den; a little is added for rounding
            near.append(np.flatnonzero(away <= away.min() + 2.0 * (1.0 - num / den) + 1e-9).tolist())
            masks.append(sum(1 << int(i) for i in np.flatnonzero(linked)))
            links.append([names[i] for i in np.flatnonzero(linked) if names[i] != digest])
            pivot.append(digest in names)
        keep = left.select(["region", "digest", "found", "label"])
        for name, values, kind in (("home", home, pa.int32()), ("near", near, pa.list_(pa.int32())),
                                   ("mask", masks, pa.int64()), ("links", links, pa.list_(pa.string())),
                                   ("pivot", pivot, pa.bool_())):
            keep = keep.append_column(name, pa.array(values, kind))
        return keep

    return dealt.groupBy("region", "share").cogroup(spread.groupBy("in_region", "in_share")).applyInArrow(
        measure, "region string, digest string, found array<long>, label string, home int, near array<int>, "
                 "mask long, links array<string>, pivot boolean")


def _merge_masks(table: pa.Table) -> pa.Table:
    """For every distinct mask of a region, the lowest pivot that its pivots reach through common masks."""
    masks = table["mask"].to_pylist()
    root = list(range(64))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for mask in masks:
        members = [find(i) for i in range(mask.bit_length()) if mask >> i & 1]
        for other in members:
            root[other] = min(members)
    return table.append_column("top", pa.array([find(m.bit_length() - 1) for m in masks], pa.int32()))


def _split(rows: DataFrame, sizes: DataFrame, pivots: int, num: int, den: int):
    """One Voronoi step over large regions: the rows of the cells, those of regions left whole, and the links to pivots.

    Rows that pivots link, directly or through each other, get one label: they
    need no comparing among themselves. Rows of a region's most common label go
    to their own cell only; all others also go to the cells in reach, where by
    the triangle inequality every partner of theirs has its own cell. Pivots
    have met all rows and go nowhere. A region of which two cells would each keep
    most rows is left whole: its cells would only be copies of it.
    """
    met = write_scratch(_measure(rows, sizes, pivots, num, den), "measured")
    links = met.select(F.col("digest").alias("a"), F.explode("links").alias("b"))
    # a labelled row links whatever any row of its label links; distinct masks are 2 ** pivots at most
    whole = write_scratch(met.where("label IS NOT NULL").groupBy("region", "label").agg(
        F.bit_or("mask").alias("mask")), "label-masks").select(
        F.col("region").alias("in_region"), F.col("label").alias("in_label"), F.col("mask").alias("all_mask"))
    met = met.join(whole, (F.col("region") == F.col("in_region")) & (F.col("label") == F.col("in_label")), "left") \
        .withColumn("mask", F.coalesce("all_mask", "mask")).drop("in_region", "in_label", "all_mask")
    tops = write_scratch(met.where("mask <> 0").select("region", "mask").distinct().groupBy("region").applyInArrow(
        _merge_masks, "region string, mask long, top int"), "merged-masks").select(
        F.col("region").alias("in_region"), F.col("mask").alias("in_mask"), "top")
    named = met.join(tops, (F.col("region") == F.col("in_region")) & (F.col("mask") == F.col("in_mask")), "left").select(
        "region", "digest", "found", "home", "near", "pivot",
        F.when(F.col("top").isNotNull(), F.concat_ws("#", "region", "top")).otherwise(F.col("label")).alias("label"))
    common = (named.where("label IS NOT NULL").groupBy("region", "label").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("region").agg(F.max(F.struct("n", "label"))["label"].alias("main")))
    cells = F.when(F.col("label") == F.col("main"), F.array("home")).otherwise(F.col("near"))
    placed = write_scratch(named.where("NOT pivot").join(common, "region", "left").select(
        "region", "digest", "found", "label", cells.alias("cells")), "placed-rows")
    counts = placed.select("region", F.explode("cells").alias("cell")).groupBy("region", "cell").agg(
        F.count(F.lit(1)).alias("n"))
    total = placed.groupBy(F.col("region").alias("in_region")).agg(F.count(F.lit(1)).alias("total"))
    copies = write_scratch(counts.join(total, F.col("region") == F.col("in_region")).where(
        F.col("n") >= F.col("total") * 0.5).groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("region"), "unsplit-regions")
    out = (placed.join(copies, "region", "left_anti").withColumn("_cell", F.explode("cells"))
           .select(F.concat_ws("/", "region", "_cell").alias("region"), "digest", "found", "label"))
    return out, placed.join(copies, "region", "left_semi").select("region", "digest", "found", "label"), links


def _in_blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Regions that pivots cannot split, as pairs of blocks that together hold every open pair.

    Rows of the region's most common label are settled with each other: their
    blocks meet only the blocks of the other rows.
    """
    common = (rows.where("label IS NOT NULL").groupBy("region", "label").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("region").agg(F.max(F.struct("n", "label"))["label"].alias("main")))
    rows = rows.join(common, "region", "left").withColumn(
        "settled", F.coalesce(F.col("label") == F.col("main"), F.lit(False)))
    # a block has at most half of a task's rows and shingles, on average
    share = F.greatest(F.lit(1.0 / REGION_ROWS), F.size("found") / REGION_SHINGLES) * 2
    many = rows.groupBy("region").agg(
        F.ceil(F.sum(F.when(F.col("settled"), share).otherwise(0.0))).cast("int").alias("mains"),
        F.ceil(F.sum(F.when(F.col("settled"), 0.0).otherwise(share))).cast("int").alias("others"))
    rows = rows.join(many.where("others > 0"), "region")  # else all rows are settled
    pick = F.xxhash64("digest", F.lit("block"))
    main = F.pmod(pick, F.greatest("mains", F.lit(1))).cast("int")
    other = F.pmod(pick, F.greatest("others", F.lit(1))).cast("int")
    steps = F.sequence(F.lit(0), F.col("others") - 1)
    with_mains = F.when(F.col("mains") > 0, F.transform(
        F.sequence(F.lit(0), F.greatest("mains", F.lit(1)) - 1),
        lambda i: F.concat_ws("-", F.lit("m"), i, other))).otherwise(F.array().cast("array<string>"))
    task = F.when(F.col("settled"), F.transform(steps, lambda j: F.concat_ws("-", F.lit("m"), main, j))).otherwise(
        F.concat(with_mains, F.transform(steps, lambda j: F.concat_ws(
            "-", F.lit("o"), F.least(j, other), F.greatest(j, other)))))
    return (rows.withColumn("_task", F.explode(task))
            .withColumn("region", F.concat_ws("#", "region", "_task")))


def region_links(rows: DataFrame, num: int, den: int, pivots: int = PIVOTS,
                 most_rows: int = REGION_ROWS, most_shingles: int = REGION_SHINGLES) -> DataFrame:
    """Links ``(a, b)`` that span every linked group of ``rows(region, digest, found, label)``."""
    links, before = [], None
    while True:
        sizes = write_scratch(rows.groupBy("region").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.size("found")).alias("shingles"),
            F.count_distinct(F.coalesce("label", "digest")).alias("open")), "region-sizes")
        big = sizes.where((F.col("n") > most_rows) | (F.col("shingles") > most_shingles)).where("open > 1 AND n > 2")
        small = sizes.where("open > 1").join(big.select("region"), "region", "left_anti")
        links.append(write_scratch(_joined(rows.join(small.select("region"), "region", "left_semi"), num, den), "links"))
        if big.isEmpty():
            break
        if before is not None:  # a cell that kept most rows of its region cannot be split
            parent = before.select(F.col("region").alias("_p"), F.col("n").alias("_n"))
            judged = big.join(parent, F.regexp_replace("region", "/[^/]*$", "") == F.col("_p"), "left")
            stuck = write_scratch(judged.where(F.col("n") >= F.col("_n") * 0.5).select("region"), "stuck")
            blocks = _in_blocks(rows.join(stuck, "region", "left_semi"), sizes)
            links.append(write_scratch(_joined(blocks, num, den), "links"))
            big = big.join(stuck, "region", "left_anti")
        big = write_scratch(big, "big-regions")
        if big.isEmpty():
            break
        cells, whole, found = _split(rows.join(big.select("region"), "region", "left_semi"), big, pivots, num, den)
        links.append(found)
        links.append(write_scratch(_joined(_in_blocks(whole, big), num, den), "links"))
        rows, before = write_scratch(cells, "cells"), big
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each linked group: its smallest id, then the smallest text hash.

    Null ids come after all others; rows that share an id but are not linked
    are in groups of their own. Of rows equal in id and text, one by the hash of
    all its columns stays. Documents without shingles all stay.
    """
    groups = write_scratch(ngram_groups(docs, **options), "ngram-groups")
    inside = F.col("n_shingles") > 0
    first = groups.where(inside).groupBy("group_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("k"))
    stay = first.select("k.doc_id", "k.text_hash").unionByName(
        groups.where(~inside).select("doc_id", "text_hash").distinct())
    stay = write_scratch(stay.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")), "ngram-stay")
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").cast("long").alias("own_id"), text_hash().alias("own_hash"))
    kept = given.join(stay, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")), "left_semi")
    repeated = groups.where(inside).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = write_scratch(repeated.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")),
                             "ngram-repeated")
    if not repeated.isEmpty():
        same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash"))
        plain = [F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
        one = kept.join(repeated, same, "left_semi").groupBy("own_id", "own_hash").agg(
            F.min_by("row", F.xxhash64(*plain)).alias("row"))
        kept = kept.join(repeated, same, "left_anti").select("row").unionByName(one.select("row"))
    return kept.select("row.*")


def ngram_groups(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, pivots: int = PIVOTS,
                 most_rows: int = REGION_ROWS, most_shingles: int = REGION_SHINGLES) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id, group_key)`` for every row of ``docs``.

    Two documents link when ``den * intersection >= num * union`` of their sets
    of k-word shingles; ``component_id`` is the smallest id reachable by links.
    ``text_hash`` tells rows apart that share an id; ``group_key`` is equal for
    linked rows only, whatever their ids, and null for rows without shingles.
    """
    require(docs, "doc_id", "text")
    hashed = _with_hash(docs)
    known = _describe(hashed, k)
    regions = write_scratch(starting_regions(docs, k, num, den, known), "starting-regions")
    free_shuffles(regions)
    sets = known.where("n_shingles > 0").groupBy("digest", "number").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("row"))
    placed = sets.join(regions.withColumnRenamed("id", "number"), "number")
    placed = write_scratch(placed.select("digest", "component", "row.doc_id", "row.text_hash"), "placed-sets")
    several = write_scratch(placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                            .select("component"), "several-sets")
    wanted = write_scratch(placed.join(several, "component").select(
        "digest", F.col("component").cast("string").alias("region"), F.col("doc_id").alias("id"),
        F.col("text_hash").alias("hash")), "region-members")
    # one plan at every size: the members grow with the corpus and are never broadcast
    fetched = hashed.join(wanted.hint("merge"), (F.col("text_hash") == F.col("hash"))
                          & F.col("doc_id").eqNullSafe(F.col("id"))).select("digest", "region", "text")

    def members(batches):
        last = None
        for batch in bounded(batches, 2):
            digests, regions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # rows that repeat an id with its text come one after the other
            keep = [i for i, d in enumerate(digests) if d != (digests[i - 1] if i else last)]
            last = digests[-1] if digests else last
            sets = shingle_sets(batch.column(2).take(pa.array(keep, pa.int64())), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([regions[i] for i in keep], pa.string()), pa.array([digests[i] for i in keep], pa.string()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.nulls(len(keep), pa.string())], names=["region", "digest", "found", "label"])

    rows = write_scratch(fetched.mapInArrow(
        members, "region string, digest string, found array<long>, label string"), "region-rows")
    free_shuffles(rows)
    tied = write_scratch(components(region_links(rows, num, den, pivots, most_rows, most_shingles), "ngram-components"),
                         "ngram-tied")
    # both sides of the joins are written, so that a hot group's rows can be split over tasks
    grouped = write_scratch(known.join(tied.withColumnRenamed("id", "digest"), "digest", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component", "digest").alias("group_key")), "ngram-grouped")
    lowest = write_scratch(grouped.groupBy("group_key").agg(F.min("doc_id").alias("low")), "ngram-lowest")
    return grouped.join(lowest, "group_key", "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"), "group_key")
