"""Byte-level BPE encoding and decoding: the tokenizers library over Arrow batches.

The vocabulary is a rank file (base64 token, rank). Bytes map to printable
characters by the usual byte-level table, merges are derived from the ranks,
and every match of the split pattern is merged separately. Within a batch, texts
are cut before single spaces that stand between two non-space characters, where
no match can cross, and each distinct piece is encoded once.

Defined cases: null counts as empty; an empty text has no ids and decodes to no
bytes; strings that look like special tokens are ordinary text; decoding joins
the bytes of all ids before any character is formed, so characters split over
several ids come back whole; bytes that are no valid UTF-8 (an id list cut
inside a character) decode to U+FFFD in the text form and unchanged in the byte
form; an id outside the vocabulary is an error; repeated rows give repeated
rows; an empty table gives an empty result; input columns named like an output
column are replaced.
"""

from __future__ import annotations

import base64
import codecs
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tsline.llm.shared import bounded, give_back, require, slices, text_buffer

#: Bytes of text that a worker encodes at a time, and pieces that go to the library at a time.
TEXT_AT_ONCE = 2 << 20
PIECES_AT_ONCE = 10_000
#: Distinct pieces whose ids a worker keeps between batches.
PIECES_KEPT = 150_000
#: Ids that a worker decodes at a time.
IDS_AT_ONCE = 1 << 18


def byte_chars() -> list[str]:
    """Character of each byte: printable Latin-1 ones stand for themselves, the rest follow 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in blob.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def rank_tokenizer(blob: bytes, pattern: str):
    """A tokenizer that merges by rank.

    A pair may merge whenever its concatenation has a rank, so every split of a
    token into two tokens is a merge with that token's rank.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = parse_ranks(blob), byte_chars()

    def shown(token: bytes) -> str:
        return "".join(chars[b] for b in token)

    merges = []
    for token in sorted(ranks, key=ranks.get):
        splits = [(token[:i], token[i:]) for i in range(1, len(token))
                  if token[:i] in ranks and token[i:] in ranks]
        splits.sort(key=lambda pair: (ranks[pair[0]], ranks[pair[1]]))
        merges += [(shown(a), shown(b)) for a, b in splits]
    tokenizer = Tokenizer(models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=merges,
                                     ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of pieces: row starts, and single spaces between two characters that are no white space.

    Of the characters beyond ASCII, those led by C2, E1, E2 and E3 may be white
    space; next to these no cut is made.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    opens = np.zeros(256, bool)
    opens[0x21:0x7F] = opens[0xC3:0xE1] = opens[0xE4:0xF5] = True
    lead2, lead3, lead4 = (np.zeros(256, bool) for _ in range(3))
    lead2[0xC3:0xE0] = lead3[0xE0] = lead3[0xE4:0xF0] = lead4[0xF0:0xF5] = True
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < n - 1)]
    before = data[at - 1]
    last = lambda back: data[np.maximum(at - back, 0)]
    inner = lambda back: (last(back) & 0xC0) == 0x80
    closed = (before > 0x20) & (before < 0x7F) | (before >= 0x80) & (
        lead2[last(2)] | inner(2) & (lead3[last(3)] | inner(3) & lead4[last(4)]))
    cuts = at[closed & opens[data[at + 1]]]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    return np.union1d(cuts, starts)


def token_sizes(tokenizer) -> np.ndarray:
    """Bytes that each id of a byte-level tokenizer stands for."""
    sizes = np.zeros(max(tokenizer.get_vocab().values(), default=-1) + 1, np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        sizes[i] = len(token)  # one character stands for one byte
    for i, token in tokenizer.get_added_tokens_decoder().items():
        sizes[i] = len(token.content.encode())
    return sizes


class PieceEncoder:
    """Ids of pieces; those of recent distinct pieces are kept, up to a bound.

    Pieces that begin with a single space and neither begin nor end in other
    white space are encoded joined, many at a time: the cuts between them are
    safe ones, so their ids follow each other and the ids' bytes tell them apart.
    """

    def __init__(self, tokenizer, limit: int = PIECES_KEPT, joined: bool = True):
        self.tokenizer, self.limit = tokenizer, limit
        self.sizes = token_sizes(tokenizer) if joined else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

    def _add(self, pieces: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.flat.append(flat)
        self.lengths.append(lengths)

    def _one_by_one(self, pieces: list[str]) -> None:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        self._add(pieces, np.fromiter((i for x in ids for i in x), np.int32),
                  np.array([len(x) for x in ids], np.int64))

    def _joined(self, pieces: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)
        ids = np.array(found[0].ids, np.int32)
        ends = np.cumsum(self.sizes[ids])
        want = np.cumsum([len(p.encode()) for p in pieces])
        last = np.minimum(np.searchsorted(ends, want), max(len(ends) - 1, 0))
        if not len(ends) or not np.array_equal(ends[last], want):
            self._one_by_one(pieces)
        else:
            self._add(pieces, ids, np.diff(last + 1, prepend=0))

    def __call__(self, pieces: pa.Array) -> pa.Array:
        """Ids of each string of ``pieces`` as a list array."""
        if len(self.known) > self.limit:
            self._forget()
        names = pieces.to_pylist()
        plain, other = [], []
        for n in names:
            if n not in self.known:
                safe = self.sizes is not None and len(n) > 1 and n[0] == " " and all(
                    "!" <= c <= "~" or c.isalnum() for c in (n[1], n[-1]))
                (plain if safe else other).append(n)
        for todo, run in ((plain, self._joined), (other, self._one_by_one)):
            for at in range(0, len(todo), PIECES_AT_ONCE):
                run(todo[at:at + PIECES_AT_ONCE])
        self.flat, self.lengths = [np.concatenate(self.flat)], [np.concatenate(self.lengths)]
        offsets = np.concatenate([[0], np.cumsum(self.lengths[0])])
        table = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(self.flat[0]))
        return table.take(pa.array([self.known[n] for n in names], pa.int64()))


def encode_column(encoder: PieceEncoder, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a string column, and each row's start among them, plus the end."""
    data, offsets = text_buffer(column)
    cuts = safe_cuts(data, offsets)
    bounds = np.append(cuts, len(data))
    pieces = slices(data, bounds, pa.large_string()).dictionary_encode()
    ids = encoder(pieces.dictionary).take(pieces.indices)
    starts = np.asarray(ids.offsets)[np.searchsorted(bounds, offsets)] if len(cuts) else np.zeros(len(offsets), np.int64)
    return np.asarray(ids.flatten()), starts


def _out(df: DataFrame, keep, extra) -> tuple[list[str], T.StructType]:
    names = [f.name for f in extra]
    kept = [c for c in (keep if keep is not None else df.columns) if c not in names]
    return kept, T.StructType([df.schema[c] for c in kept] + extra)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text",
           keep: list[str] | None = None, offsets: bool = False) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``ids array<int>``.

    With ``offsets``, also ``char_starts array<int>``: the code point in which
    each id's bytes begin. The rank file is read where the driver runs and sent
    with the function as a built tokenizer; its size is the vocabulary's.
    """
    require(docs, text)
    with open(rank_file, "rb") as f:
        built = docs.sparkSession.sparkContext.broadcast(rank_tokenizer(f.read(), pattern).to_str())
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if offsets:
        extra.append(T.StructField("char_starts", T.ArrayType(T.IntegerType())))
    kept, schema = _out(docs, keep, extra)
    names = list(dict.fromkeys([*kept, text]))

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(built.value)
        encoder = PieceEncoder(tokenizer)
        for batch in bounded(batches, names.index(text), TEXT_AT_ONCE):
            column = batch.column(names.index(text))
            flat, starts = encode_column(encoder, column)
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int32()))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept] + [lists]
            if offsets:
                data, rows = text_buffer(column)
                begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                at = np.concatenate([[0], np.cumsum(encoder.sizes[flat])])[:-1]
                row = np.searchsorted(rows, at, side="right") - 1
                inside = begun[at + 1] - 1 - begun[rows[row]] if len(at) else at
                columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()),
                                                        pa.array(inside, pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *[f.name for f in extra]])

    return docs.select(*names).mapInArrow(run, schema)


def token_chars(blob: bytes) -> list[str]:
    """The characters of each id, one for each byte, as the vocabulary writes it."""
    ranks, chars = parse_ranks(blob), byte_chars()
    table = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = "".join(chars[b] for b in token)
    return table


def char_bytes() -> np.ndarray:
    """The byte table reversed: the byte of each character's code point."""
    out = np.zeros(1 + max(map(ord, byte_chars())), np.uint8)
    for byte, char in enumerate(byte_chars()):
        out[ord(char)] = byte
    return out


def token_bytes(blob: bytes) -> list[bytes]:
    """The byte string of each id, from its characters."""
    back = char_bytes()
    return [bytes(back[[ord(c) for c in shown]]) if shown else b"" for shown in token_chars(blob)]


def decode_steps(ids, table: list[bytes]) -> list[str]:
    """Text that each id completes; a character split over ids comes with its last byte."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    out = [decoder.decode(table[i]) for i in ids]
    tail = decoder.decode(b"", final=True)
    if tail and out:
        out[-1] += tail
    return out


def _few_ids(batch: pa.RecordBatch, column: int):
    """The batch cut so that a part has at most ``IDS_AT_ONCE`` ids, or one row."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0), np.int64))
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + IDS_AT_ONCE, side="right")))
        yield batch.slice(row, stop - row)
        row = stop


def decode(encoded: DataFrame, rank_file: str, ids: str = "ids", keep: list[str] | None = None,
           as_text: bool = False) -> DataFrame:
    """``encoded`` (or its columns ``keep``) with ``decoded``: bytes, or text with ``as_text``."""
    require(encoded, ids)
    with open(rank_file, "rb") as f:
        blob = encoded.sparkSession.sparkContext.broadcast(f.read())
    kept, schema = _out(encoded, keep, [
        T.StructField("decoded", T.StringType() if as_text else T.BinaryType())])
    batch_names = list(dict.fromkeys([*kept, ids]))

    def run(batches):
        shown = token_chars(blob.value)
        points = np.frombuffer("".join(shown).encode("utf-32-le"), np.uint32).astype(np.uint16)
        table = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum([len(s) for s in shown])]), pa.int64()), pa.array(points))
        back = char_bytes()
        at = batch_names.index(ids)
        for batch in (part for whole in batches for part in _few_ids(whole, at)):
            lists = batch.column(at)
            flat = lists.flatten()
            if len(flat) and not 0 <= pc.min(flat).as_py() <= pc.max(flat).as_py() < len(table):
                raise ValueError("an id outside the vocabulary")
            lengths = pc.fill_null(pc.list_value_length(lists), 0)
            rows = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))])
            joined = table.take(flat)  # ids to characters, these to bytes
            ends = np.asarray(joined.offsets, np.int64)
            whole = slices(back[np.asarray(joined.flatten())], (ends - ends[0])[rows], pa.large_binary())
            if as_text:
                whole = pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())
            else:
                whole = whole.cast(pa.binary())
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, whole], names=[*kept, "decoded"])
        give_back()

    return encoded.select(*batch_names).mapInArrow(run, schema)
