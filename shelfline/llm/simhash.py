"""Near duplicates by SimHash fingerprints, found through Golay-code keys.

A fingerprint is the bitwise majority of the hashes of a text's word shingles.
To find all pairs that differ in at most four bits, it is cut into four
segments of 16 bits. By pigeonhole, two such fingerprints agree as follows:

* two segments are equal; or
* one segment is equal and at least one of any two others differs by at most
  one bit; or
* all four differ by exactly one bit.

"At most one bit" is looked up through the perfect (23, 12) Golay code: a
segment decodes to the index of its nearest codeword, and its keys are that
index and the smaller indices that its one-bit neighbours decode to. Two
segments one bit apart then share the smaller of their two indices. The three
cases give 6, 8 and 1 combinations of exact segments and indices, about 60
keys in all, of 28 to 36 bits each.

Only distinct fingerprints are keyed, hence copies, however many, cost one.
Under one key, fingerprints are compared in the task that reads them and only
links along a spanning forest leave it, never all pairs. A key with over RUN
fingerprints is dealt out again as pairs of blocks, so no task holds more than
two blocks. Links give components.

Null and wordless texts have fingerprint 0 and link like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import LOWER, ROW, blocks, each_bytes, keep_rows, scan, text_mark, with_row, written
from shelfline.llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Most fingerprints of one key that a task compares at once, and those compared pair by pair.
RUN, SHORT = 1 << 16, 24

# --- Golay code -----------------------------------------------------------------------------------

#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the perfect code of length 23.
GENERATOR = 0b110001110101


def _remainder(value: int) -> int:
    for bit in range(22, 10, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - 11)
    return value


def _nearest() -> np.ndarray:
    """Codeword index for each 16-bit segment, the other seven bits being 0."""
    error = np.zeros(2048, np.int64)  # by remainder; each has just one error of up to three bits
    bits = [1 << b for b in range(23)]
    for a in [0, *bits]:
        for b in [0, *bits]:
            for c in [0, *bits]:
                error[_remainder(a ^ b ^ c)] = a ^ b ^ c
    remainder = np.zeros(1, np.int64)
    for bit in range(16):
        remainder = np.concatenate([remainder, remainder ^ _remainder(1 << bit)])
    return (np.arange(1 << 16) ^ error[remainder]) >> 11


def _keys() -> tuple[np.ndarray, np.ndarray]:
    """The keys of each segment, -1 beyond the last, and their number."""
    own = _nearest()
    values = np.arange(1 << 16)
    near = np.stack([own, *(own[values ^ (1 << b)] for b in range(16))], axis=1)
    near = np.sort(np.where(near <= own[:, None], near, 1 << 12), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = 1 << 12
    near = np.sort(near, axis=1)
    count = (near < 1 << 12).sum(axis=1)
    return np.where(near < 1 << 12, near, -1)[:, : count.max()], count


_TABLE: list[np.ndarray] = []


def keys_of_segments() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLE:
        _TABLE.extend(_keys())
    return _TABLE[0], _TABLE[1]


def combined_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index into prints and key, for all keys of all fingerprints; distance 4."""
    near, _ = keys_of_segments()
    segments = [((prints >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    codes = [near[s] for s in segments]
    every = np.arange(len(prints))
    at, keys, kind = [], [], 0
    for i in range(4):
        for j in range(i + 1, 4):
            at.append(every)
            keys.append(kind << 48 | segments[i] << 16 | segments[j])
            kind += 1
    for i in range(4):
        for j in [k for k in range(4) if k != i][:2]:
            rows, column = np.nonzero(codes[j] >= 0)
            at.append(rows)
            keys.append(kind << 48 | segments[i][rows] << 12 | codes[j][rows, column])
            kind += 1
    width = near.shape[1]
    for a in range(width):
        for b in range(width):
            pair = np.flatnonzero((codes[0][:, a] >= 0) & (codes[1][:, b] >= 0))
            for c in range(width):
                rows = pair[codes[2][pair, c] >= 0]
                at.append(rows)
                keys.append(kind << 48 | codes[0][rows, a] << 24 | codes[1][rows, b] << 12 | codes[2][rows, c])
    return np.concatenate(at), np.concatenate(keys)


# --- fingerprints ---------------------------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the shingles' XXH64, bit by bit; 0 without a word."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
    counts = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number, and, where docs has ROW, that and the text's mark."""
    marks = ["mark", ROW] if ROW in docs.columns else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            prints = np.array([fingerprint(t, shingle) for t in each_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64)), *(batch.column(m) for m in marks)], ["doc_id", "fp", *marks]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([text_mark().alias("mark"), ROW] if marks else []))
    return scan(rows, work, "doc_id long, fp long" + (f", mark binary, {ROW} struct<file:bigint,place:bigint>" if marks else ""))


# --- links ----------------------------------------------------------------------------------------


def forest(prints: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links along a spanning forest of the pairs within ``most`` bits: each reached print is compared with the unreached."""
    left, links = np.unique(prints), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            here, front = front[:64], front[64:]
            reached = np.zeros(len(left), bool)
            for p in here:
                reached |= np.bitwise_count(left ^ p) <= most
            found, left = left[reached], left[~reached]
            links.append((np.full(len(found), root), found))
            front = np.concatenate([front, found])
    return links


def linked(keys: np.ndarray, prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between prints of equal keys; rows come sorted by key."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    size = np.diff(edges)
    run = np.repeat(np.arange(len(size)), size)
    a, b = [], []
    short = size[run] <= SHORT
    k, p, r = keys[short], prints[short], run[short]
    for step in range(1, SHORT):
        same = np.flatnonzero(r[step:] == r[:-step])
        if not len(same):
            break
        near = same[np.bitwise_count(p[same] ^ p[same + step]) <= most]
        a.append(p[near])
        b.append(p[near + step])
    for start, end in zip(edges[:-1][size > SHORT].tolist(), edges[1:][size > SHORT].tolist(), strict=True):
        for x, y in forest(prints[start:end], most):
            a.append(x)
            b.append(y)
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    both = np.stack([np.concatenate(a), np.concatenate(b)], axis=1)
    both = np.unique(np.sort(both[both[:, 0] != both[:, 1]], axis=1), axis=0)
    return both[:, 0], both[:, 1]


_LINKS = "u long, v long, key long, block long, fp long"


def _batch(u=(), v=(), key=(), block=(), fp=()) -> pa.RecordBatch:
    n = max(len(u), len(key))
    columns = [np.asarray(c).astype(np.uint64).view(np.int64) if len(c) else None for c in (u, v, key, block, fp)]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()) if c is None else pa.array(c) for c in columns], ["u", "v", "key", "block", "fp"]
    )


def _compare(most: int, limit: int):
    """Work on rows (key, fp) sorted by key: links, or for keys with over ``limit`` rows the rows with block numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        long_key, passed = None, 0
        for batch in batches:
            new = np.asarray(batch.column("key").to_numpy(zero_copy_only=False), np.int64)
            keys = np.concatenate([keys, new])
            prints = np.concatenate([prints, np.asarray(batch.column("fp").to_numpy(zero_copy_only=False), np.int64).view(np.uint64)])
            while len(keys):
                if long_key is not None:
                    n = int(np.searchsorted(keys, long_key, "right"))
                    if n:
                        yield _batch(key=keys[:n], block=(passed + np.arange(n)) // limit, fp=prints[:n])
                    passed, keys, prints = passed + n, keys[n:], prints[n:]
                    if not len(keys):
                        break
                    long_key = None
                last = int(np.searchsorted(keys, keys[-1]))  # this key's rows may go on
                if last:
                    u, v = linked(keys[:last], prints[:last], most)
                    yield _batch(u=u, v=v)
                    keys, prints = keys[last:], prints[last:]
                if len(keys) <= limit:
                    break
                long_key, passed = keys[-1], 0
        if len(keys):
            u, v = linked(keys, prints, most)
            yield _batch(u=u, v=v)

    return work


def links(prints: DataFrame, most: int = DISTANCE, limit: int = RUN) -> DataFrame:
    """Links u, v between distinct fingerprints (fp) at most ``most`` <= 4 bits apart: enough to connect all such pairs."""
    if not 0 <= most <= 4:
        raise ValueError("the keys find up to 4 differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column("fp").to_numpy(zero_copy_only=False), np.int64)
            for start in range(0, len(values), 4096):
                part = values[start : start + 4096]
                at, keys = combined_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at])], ["key", "fp"])

    rows = scan(prints.select("fp"), keyed, "key long, fp long").repartition("key").sortWithinPartitions("key")
    found = written(scan(rows, _compare(most, limit), _LINKS), "links")
    near = found.where("u is not null").select("u", "v")
    long = found.where("key is not null").select("key", "block", "fp")
    if long.isEmpty():
        return near
    size = long.groupBy("key").agg(F.max("block").alias("last"))
    pairs = (
        long.join(size, "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .select(F.struct("key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")).alias("group"), "fp")
        .withColumn("key", F.xxhash64("group"))  # groups that share a key by chance are only compared as well
        .select("key", "fp")
    )
    pairs = pairs.repartition("key").sortWithinPartitions("key")
    more = scan(pairs, _compare(most, 1 << 62), _LINKS)
    return near.unionByName(more.select("u", "v").where("u is not null"))


def _rooted(distinct: DataFrame, most: int, limit: int) -> DataFrame:
    """The rows of distinct (fp, first) with the root of their component."""
    found = components(links(distinct, most, limit))
    return distinct.join(found.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_groups(docs: DataFrame, shingle: int = SHINGLE, most: int = DISTANCE, limit: int = RUN) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable, for each row of docs (doc_id, text)."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    roots = written(_rooted(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), most, limit), "roots")
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_firsts(docs: DataFrame, shingle: int = SHINGLE, most: int = DISTANCE) -> DataFrame:
    """Of each group the row of docs with the least doc_id, null after all others, and of these the least mark.

    Of rows that repeat both doc_id and text, one stays.
    """
    docs = with_row(docs)
    prints = written(fingerprints(docs, shingle), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", ROW)
    roots = _rooted(written(prints.groupBy("fp").agg(F.min(first).alias("first")), "firsts"), most, RUN)
    stays = roots.groupBy("root").agg(F.min("first").alias("first")).select(f"first.{ROW}")
    return keep_rows(docs, stays)
