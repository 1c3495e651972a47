"""SentencePiece encoding with seeded merge-dropout, and its decoding.

The vocabulary and merge order come from a SentencePiece BPE model file; the
model is read once, on the driver, and its few tables travel to the tasks.
Texts split before each run of spaces, as no piece of such a model reaches over
one (checked on reading). Within a unit the agenda holds each adjacent pair
that forms a piece, best score first and leftmost of equals. A candidate's
merge is skipped for good if a hash keyed by the seed, of doc_id, text, the
unit's place in the document and the candidate (left, middle, right), falls
below the dropout rate. Hence every occurrence of a word is cut on its own, and
every run gives the same pieces. An occurrence whose coins skip none of the
merges that its plain cut makes has just that cut, which is made once a task
batch; all others are cut one occurrence at a time.

Spaces become U+2581 after one is put in front; characters that are no piece
become byte pieces, and so does U+2581 itself where a text holds it. Decoding
gives back every text exactly, for every seed and rate. Without dropout the
pieces are those of the library for texts without U+2581.

A null text counts as empty; an empty text has no pieces.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.base import Rolling, blocks, each_bytes, mix, scan, utf8, written

#: Where the public tokenizers lie; a parameter of every entry point.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 20
ENCODED = "doc_id long, ids array<int>, n_pieces long, n_bytes long, text_sha256 string"
SPACE = "▁"
#: Units of up to so many characters are cut many at a time, longer ones one by one.
SHORT = 32

_TEXTS = Rolling(13)
_LEFT, _MIDDLE, _RIGHT = 0x9E3779B97F4A7C15, 0xA0761D6478BD642F, 0xC2B2AE3D27D4EB4F


class Vocabulary:
    """Pieces, merges and their order, and byte pieces of a SentencePiece BPE model."""

    def __init__(self, pieces: list[str], scores: list[float], special: list[bool], byte_ids: list[int]) -> None:
        self.byte_ids = np.array(byte_ids, np.int64)
        self.bytes_of = [b"" if s else p.replace(SPACE, " ").encode() for p, s in zip(pieces, special, strict=True)]
        for value, piece in enumerate(byte_ids):
            self.bytes_of[piece] = bytes([value])
        self.is_byte = np.zeros(len(pieces), bool)
        self.is_byte[self.byte_ids] = True
        ordinary = {p: i for i, p in enumerate(pieces) if not special[i] and not self.is_byte[i]}
        if any(SPACE in p.lstrip(SPACE) for p in ordinary):
            raise ValueError("a piece reaches over a space; texts can't be cut at spaces")
        #: Piece of each character; a character without one has a number beyond all pieces.
        self.size = len(pieces)
        self.characters = {p: i for p, i in ordinary.items() if len(p) == 1}
        rank = np.empty(self.size, np.int64)
        rank[np.lexsort((np.arange(self.size), -np.array(scores)))] = np.arange(self.size)
        rows = [
            (ordinary[p[:k]] * self.size + ordinary[p[k:]], i)
            for p, i in ordinary.items()
            for k in range(1, len(p))
            if p[:k] in ordinary and p[k:] in ordinary
        ]
        rows.sort()
        self.rank = rank.astype(np.int32)
        self.by_rank = np.argsort(rank).astype(np.int32)
        self._table(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64))
        self.merges = dict(rows)

    def _table(self, pairs: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing: a slot, and the next ones while taken by others."""
        self.mask = (1 << max(4, int(4 * len(pairs) + 1).bit_length())) - 1
        self.slots, self.merged = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int64)
        self.reach = 1
        for pair, result, slot in zip(pairs.tolist(), merged.tolist(), self._slot(pairs).tolist(), strict=True):
            step = 0
            while self.slots[(slot + step) & self.mask] >= 0:
                step += 1
            self.slots[(slot + step) & self.mask], self.merged[(slot + step) & self.mask] = pair, result
            self.reach = max(self.reach, step + 1)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (mix(pairs.astype(np.uint64)) >> np.uint64(20)).astype(np.int64) & self.mask

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that left and right form; a number beyond all ranks if none."""
        out = np.full(left.shape, self.size, np.int32)
        fit = (left < self.size) & (right < self.size) & (left >= 0) & (right >= 0)
        pairs = left[fit].astype(np.int64) * self.size + right[fit]
        slot, found = self._slot(pairs), np.full(len(pairs), self.size, np.int32)
        open_ = np.arange(len(pairs))
        for _ in range(self.reach):
            at = self.slots[slot[open_]]
            same = at == pairs[open_]
            found[open_[same]] = self.rank[self.merged[slot[open_[same]]]]
            open_ = open_[~same & (at >= 0)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
        out[fit] = found
        return out


def read_model(spark: SparkSession, path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file, read through Spark or, where it is a local file of the driver, directly."""
    import sentencepiece

    try:
        with open(path, "rb") as f:
            data = f.read()
    except OSError:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = range(model.get_piece_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    return Vocabulary(
        [model.id_to_piece(i) for i in ids],
        [model.get_score(i) for i in ids],
        special,
        [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
    )


# --- one unit at a time ---------------------------------------------------------------------------


def _threshold(dropout: float) -> int:
    return min(int(dropout * 2.0**64), 2**64 - 1)


def _coin(key: int, left: int, middle: int, right: int) -> int:
    """The keyed hash that decides on the candidate of the characters from left to middle and from there to right."""
    x = (key + left * _LEFT + middle * _MIDDLE + right * _RIGHT) & (2**64 - 1)
    for _ in range(2):  # as mix, of one value
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & (2**64 - 1)
    return x ^ (x >> 32)


def _candidate(left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What a candidate adds to the key of its coin."""
    out = left.astype(np.uint64) * np.uint64(_LEFT)
    out += middle.astype(np.uint64) * np.uint64(_MIDDLE)
    out += right.astype(np.uint64) * np.uint64(_RIGHT)
    return out


def cut_one(vocabulary: Vocabulary, symbols: list[int], key: int, dropout: float) -> list[int]:
    """Pieces of one unit by a heap of candidate merges; symbols beyond the vocabulary stay."""
    n, limit = len(symbols), _threshold(dropout)
    end, before, piece = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(left: int) -> None:
        right = end[left]
        if right < n and piece[left] < vocabulary.size and piece[right] < vocabulary.size:
            merged = vocabulary.merges.get(piece[left] * vocabulary.size + piece[right])
            if merged is not None:
                heapq.heappush(heap, (int(vocabulary.rank[merged]), left, right, end[right], merged))

    for at in range(n - 1):
        offer(at)
    alive = [True] * n
    while heap:
        _, left, right, to, merged = heapq.heappop(heap)
        if not alive[left] or right >= n or not alive[right] or end[left] != right or end[right] != to:
            continue
        if limit and _coin(key, left, right, to) < limit:
            continue
        piece[left], end[left], alive[right] = merged, to, False
        if to < n:
            before[to] = left
            offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [piece[at] for at in range(n) if alive[at]]


# --- many units at a time -------------------------------------------------------------------------


def cut_many(
    vocabulary: Vocabulary,
    symbols: np.ndarray,
    keys: np.ndarray,
    dropout: float,
    made: list[tuple[np.ndarray, np.ndarray]] | None = None,
) -> np.ndarray:
    """The same for all rows of symbols at once, -1 filling up; one merge of each row a round, the best of its agenda.

    A candidate's coin depends on its place in the row alone, so a skipped one
    is simply never on the agenda. The merges of each round (rows, candidates)
    are appended to made.
    """
    symbols = symbols.astype(np.int32)
    n, width = symbols.shape
    start = np.tile(np.arange(width, dtype=np.int16), (n, 1))
    length = (symbols >= 0).sum(axis=1)
    stop = np.minimum(start + 1, length[:, None]).astype(np.int16)
    limit = np.uint64(_threshold(dropout))

    def agenda(piece: np.ndarray, begin: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        ranks = vocabulary.merge(piece[:, :-1], piece[:, 1:])
        if limit:
            rows, at = np.nonzero(ranks < vocabulary.size)
            skip = mix(key[rows] + _candidate(begin[rows, at], end[rows, at], end[rows, at + 1])) < limit
            ranks[rows[skip], at[skip]] = vocabulary.size
        return ranks

    active = np.arange(n)
    piece, begin, end, key = symbols, start, stop, keys
    ranks = agenda(piece, begin, end, key) if width > 1 else np.zeros((n, 0), np.int32)
    while len(active) and ranks.shape[1]:
        best = ranks.argmin(axis=1)
        lowest = ranks[np.arange(len(active)), best]
        going = lowest < vocabulary.size
        if not going.all():
            symbols[active[~going], : piece.shape[1]] = piece[~going]
            symbols[active[~going], piece.shape[1] :] = -1
            active, piece, begin, end, key = active[going], piece[going], begin[going], end[going], key[going]
            ranks, best, lowest = ranks[going], best[going], lowest[going]
            if not len(active):
                break
        rows, columns = np.arange(len(active)), np.arange(piece.shape[1])
        if made is not None:
            made.append((active, _candidate(begin[rows, best], end[rows, best], end[rows, best + 1])))
        piece[rows, best] = vocabulary.by_rank[lowest]
        end[rows, best] = end[rows, best + 1]
        # close the gap left by the right part
        source = np.minimum(columns + (columns > best[:, None]), piece.shape[1] - 1)
        piece, begin, end = (np.take_along_axis(x, source, axis=1) for x in (piece, begin, end))
        piece[:, -1] = -1
        ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], ranks.shape[1] - 1), axis=1)
        ranks[:, -1] = vocabulary.size
        for side in (-1, 0):  # the two new neighbours
            at = best + side
            fit = np.flatnonzero((at >= 0) & (at < piece.shape[1] - 1))
            at = at[fit]
            pair = np.stack([piece[fit, at], piece[fit, at + 1]], axis=1)
            b, e = np.stack([begin[fit, at], begin[fit, at + 1]], axis=1), np.stack([end[fit, at], end[fit, at + 1]], axis=1)
            ranks[fit, at] = agenda(pair, b, e, key[fit])[:, 0]
        if (piece[:, -2:] < 0).all() and piece.shape[1] > 2:
            piece, begin, end, ranks = piece[:, :-1], begin[:, :-1], end[:, :-1], ranks[:, :-1]
    if len(active):
        symbols[active, : piece.shape[1]] = piece
        symbols[active, piece.shape[1] :] = -1
    return symbols


# --- texts ----------------------------------------------------------------------------------------


def as_bytes(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids of each symbol, and byte values (-1: a piece) of all these ids; characters go by UTF-8."""
    character = np.maximum(symbols - size, 0)
    n = np.where(symbols < size, 1, 1 + (character >= 0x80) + (character >= 0x800) + (character >= 0x10000))
    total = np.cumsum(n)
    which = np.repeat(np.arange(len(symbols)), n)
    place = np.arange(len(which)) - np.repeat(total - n, n)
    value = character[which] >> (6 * (n[which] - 1 - place))
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n[which]]
    value = np.where(place == 0, value | lead, (value & 0x3F) | 0x80)
    return n, np.where(symbols[which] < size, -1, value)


class Encoder:
    """Pieces of texts; remembers nothing from one batch to the next."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED) -> None:
        if not 0 <= dropout <= 1:
            raise ValueError("a dropout rate lies between 0 and 1")
        self.vocabulary, self.dropout = vocabulary, dropout
        self.seed = np.uint64(int.from_bytes(hashlib.blake2b(str(seed).encode(), digest_size=8).digest(), "little"))
        self.symbol = vocabulary.size + np.arange(0x110000, dtype=np.int32)
        for character, piece in vocabulary.characters.items():
            if character != SPACE:
                self.symbol[ord(character)] = piece
        if SPACE in vocabulary.characters:
            self.symbol[ord(" ")] = vocabulary.characters[SPACE]

    def cut(
        self,
        units: pa.Array,
        which: np.ndarray,
        keys: np.ndarray,
        dropout: float,
        made: list[tuple[np.ndarray, np.ndarray]] | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of units[which], each with its key, end to end, and how many each has; made as in cut_many."""
        data, offsets = utf8(units)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
        symbols = self.symbol[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        begin, size = lead[offsets[:-1]][which], np.diff(lead[offsets])[which]
        owners, values = [], []
        for low, high in ((0, 4), (4, 6), (6, 8), (8, 11), (11, 16), (16, SHORT)):
            group = np.flatnonzero((size > low) & (size <= high))
            for start in range(0, len(group), 8_000):
                part = group[start : start + 8_000]
                columns = np.arange(high)
                at = np.minimum(begin[part, None] + columns, len(symbols) - 1)
                rows = np.where(columns < size[part, None], symbols[at], -1)
                merges: list[tuple[np.ndarray, np.ndarray]] | None = None if made is None else []
                rows = cut_many(self.vocabulary, rows, keys[part], dropout, merges)
                if made is not None:
                    made += [(part[of], candidates) for of, candidates in merges]
                owners.append(np.repeat(part, (rows >= 0).sum(axis=1)))
                values.append(rows[rows >= 0])
        for i in np.flatnonzero(size > SHORT).tolist():
            row = cut_one(self.vocabulary, symbols[begin[i] : begin[i] + size[i]].tolist(), int(keys[i]), dropout)
            owners.append(np.full(len(row), i))
            values.append(np.array(row))
        owner = np.concatenate([np.zeros(0, np.int64), *owners])
        order = np.argsort(owner, kind="stable")
        value = np.concatenate([np.zeros(0, np.int64), *values])[order]
        n, raw = as_bytes(value, self.vocabulary.size)
        ids = np.where(raw < 0, np.repeat(value, n), self.vocabulary.byte_ids[np.maximum(raw, 0)])
        return ids.astype(np.int32), np.bincount(np.repeat(owner[order], n), minlength=len(which))

    def skipping(self, unit: np.ndarray, keys: np.ndarray, n_units: int, made: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whether an occurrence's own coins skip any merge that its unit's plain cut makes."""
        owner = np.concatenate([np.zeros(0, np.int64), *(of for of, _ in made)])
        order = np.argsort(owner, kind="stable")
        candidates = np.concatenate([np.zeros(0, np.uint64), *(c for _, c in made)])[order]
        n_merges = np.bincount(owner, minlength=n_units)
        begin = np.cumsum(n_merges) - n_merges
        out = np.zeros(len(unit), bool)
        for start in range(0, len(unit), 1 << 17):
            part = unit[start : start + (1 << 17)]
            n = n_merges[part]
            of = np.repeat(np.arange(len(part)), n)
            at = np.arange(len(of)) + np.repeat(begin[part] - (np.cumsum(n) - n), n)
            skip = mix(keys[start : start + (1 << 17)][of] + candidates[at]) < np.uint64(_threshold(self.dropout))
            out[start + of[skip]] = True
        return out

    def encode(self, texts: pa.Array, ids: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts end to end, and where each text's begin. ids and texts key the coins."""
        raw, offsets = utf8(texts)
        filled = np.diff(offsets) > 0
        data = np.insert(raw, offsets[:-1][filled], np.uint8(32))  # the space in front
        edges = offsets + np.concatenate([[0], np.cumsum(filled)])
        space = data == 32
        new = space.copy()
        new[1:] &= ~space[:-1]
        new[edges[:-1][filled]] = True
        starts = np.flatnonzero(new)
        first = np.searchsorted(starts, edges)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        coded = pc.dictionary_encode(pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(data)]))
        units, unit = coded.dictionary, np.asarray(coded.indices, np.int64)
        n_units = len(units)
        if not self.dropout:
            pool, sizes = self.cut(units, np.arange(n_units), np.zeros(n_units, np.uint64), 0.0)
            where = unit
        else:
            counts = np.diff(first)
            place = np.arange(len(starts)) - np.repeat(first[:-1], counts)
            # rows without an id, or with the same one, differ by their texts
            doc = mix(np.array([i or 0 for i in ids], np.int64).astype(np.uint64) + self.seed)
            doc ^= _TEXTS.of_words(data, edges[:-1], edges[1:])
            keys = mix(np.repeat(mix(doc), counts) + place.astype(np.uint64) * np.uint64(_LEFT))
            # the plain cut pays where a unit stands in several places; a long one hardly ever keeps all its merges
            characters = np.asarray(pc.utf8_length(units.cast(pa.string())), np.int64)
            shared = np.flatnonzero((np.bincount(unit, minlength=n_units) > 1) & (characters <= SHORT))
            number = np.full(n_units, -1, np.int64)
            number[shared] = np.arange(len(shared))
            made: list[tuple[np.ndarray, np.ndarray]] = []
            pool, sizes = self.cut(units, shared, np.zeros(len(shared), np.uint64), 0.0, made)
            where = number[unit]
            plain = np.flatnonzero(where >= 0)
            where[plain[self.skipping(where[plain], keys[plain], len(shared), made)]] = -1
            own = np.flatnonzero(where < 0)
            where[own] = len(shared) + np.arange(len(own))
            more, more_sizes = self.cut(units, unit[own], keys[own], self.dropout)
            pool, sizes = np.concatenate([pool, more]), np.concatenate([sizes, more_sizes])
        begin = np.cumsum(sizes) - sizes
        n = sizes[where]
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(total[-1]) + np.repeat(begin[where] - total[:-1], n)
        return pool[at], total[first]


def decode(vocabulary: Vocabulary, ids: list[int]) -> bytes:
    """The text behind piece ids, without the space put in front."""
    return b"".join([vocabulary.bytes_of[i] for i in ids])[1:]


# --- operators ------------------------------------------------------------------------------------


def encode_documents(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, ids, n_pieces, n_bytes, text_sha256.

    ids are the piece ids, n_bytes counts the byte pieces among them, and the digest of the text's UTF-8 lets a
    reader of the pieces prove that nothing was lost.
    """
    encoder = Encoder(read_model(docs.sparkSession, model), dropout, seed)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=2 << 20):
            ids, edges = encoder.encode(batch.column("text"), batch.column("doc_id").to_pylist())
            fallback = np.concatenate([[0], np.cumsum(encoder.vocabulary.is_byte[ids])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                    pa.array(np.diff(edges)),
                    pa.array(np.diff(fallback[edges])),
                    pa.array([hashlib.sha256(t).hexdigest() for t in each_bytes(batch.column("text"))], pa.string()),
                ],
                ["doc_id", "ids", "n_pieces", "n_bytes", "text_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scan(rows, work, ENCODED)


def checked_documents(docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """The rows of encode_documents with lossless: whether decoding the pieces gives the text back.

    The pieces are written before they are decoded, so that a task runs one Python worker at a time.
    """
    decoded = decode_documents(written(encode_documents(docs, model, dropout, seed), "pieces"), model)
    return decoded.withColumn("lossless", F.sha2("text", 256) == F.col("text_sha256")).drop("text")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The rows of encoded, as encode_documents gives them, with the decoded text; null ids give an empty one."""
    vocabulary = read_model(encoded.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(vocabulary.bytes_of, pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                column = part.column("ids")
                lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
                data, offsets = utf8(table.take(pc.list_flatten(column)))
                edges = offsets[np.concatenate([[0], np.cumsum(lengths)])]
                raw = data.tobytes()
                texts = [raw[a + 1 : b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                columns = [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "text"])

    rows = encoded.select("doc_id", "ids", "n_pieces", "n_bytes", "text_sha256")
    return scan(rows, work, f"{ENCODED}, text string")
