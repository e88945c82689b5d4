"""SimHash fingerprints and exact Hamming linking by pigeonring filtering."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import free_name, map_rows, settle, sized_join, small
from lodeflow.llm.components import connected_components

#: Fingerprints of one block of a hot key; a task compares two blocks at most.
BLOCK = 4096
#: Groups up to this size are compared all at once, by shifted arrays.
NARROW = 24

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOW_BITS = np.uint64(0x0101010101010101)


def words(text: str | None) -> list[bytes]:
    """White-space separated words with A-Z in lower case, as UTF-8."""
    # bytes.split() splits at exactly space and 0x09-0x0D
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def shingle_hashes(toks: list[bytes], size: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by spaces; of a shorter text its whole sequence."""
    if not toks:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(toks)
    if len(toks) <= size:
        return np.array([xxhash.xxh64_intdigest(line, seed)], dtype=np.uint64)
    length = np.fromiter(map(len, toks), dtype=np.int64, count=len(toks))
    end = np.cumsum(length + 1) - 1
    start = end - length
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(start[: -size + 1].tolist() if size > 1 else start.tolist(), end[size - 1 :].tolist(), strict=True)), dtype=np.uint64, count=len(toks) - size + 1)


def majorities(hashes: np.ndarray) -> list[int]:
    """For each row of hashes, the 64 bits set in more than half of them, unsigned; zero for an empty row.

    Eight bits at a time are spread over the bytes of a word and added, 255 words before a byte could run over.
    """
    m, n = hashes.shape
    if not n:
        return [0] * m
    h = np.zeros((m, -(-n // 255) * 255), dtype=np.uint64)
    h[:, :n] = hashes
    h = h.reshape(m, -1, 255)
    sums = np.empty((m, 8, 8), dtype=np.int64)  # row, byte, bit
    for k in range(8):
        sums[:, :, k] = ((h >> np.uint64(k)) & _LOW_BITS).sum(axis=2).view(np.uint8).reshape(m, -1, 8).sum(axis=1, dtype=np.int64)
    return np.packbits((2 * sums > n).reshape(m, 64), axis=1, bitorder="little").view("<u8").ravel().tolist()


def majority(hashes: np.ndarray) -> int:
    return majorities(hashes[None, :])[0]


def fingerprint(text: str | None, size: int = 3) -> int:
    return majority(shingle_hashes(words(text), size))


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class Ring:
    """How 64 bits are cut into ``tau + 1`` segments on a ring, and what a chain of segments may differ by.

    If two fingerprints differ in at most tau bits, some start segment begins a chain whose first l segments
    differ in at most floor(l * tau / m) = l - 1 bits, for each l from 1 to m. So the start segment is equal,
    and, as the next one differs in one bit at most, so is one half of that; both make the key.
    """

    def __init__(self, tau: int, bits: int = 64):
        self.tau, self.m = tau, tau + 1
        cuts = [round(i * bits / self.m) for i in range(self.m + 1)]
        self.segments = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(self.m)]

    def halves(self, i: int) -> list[tuple[int, int]]:
        at, n = self.segments[(i + 1) % self.m]
        return [(at, n // 2), (at + n // 2, n - n // 2)]

    def key_parts(self) -> list[tuple[int, tuple[int, int], tuple[int, int]]]:
        """(start segment, its bits, half of the next one): one key each."""
        if self.m == 1:
            return [(0, (0, 32), (32, 32))]
        return [(i, self.segments[i], h) for i in range(self.m) for h in self.halves(i)]

    def keys(self, fp: Column) -> Column:
        """All keys of a fingerprint, as an array of longs; the top bits number the key."""
        def cut(part):
            at, n = part
            return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1))

        return F.array(*[F.lit(k).cast("long") * F.lit(1 << 48) + F.shiftleft(cut(a), b[1]) + cut(b) if self.m > 1 else fp for k, (_, a, b) in enumerate(self.key_parts())])

    def chain(self, key_no: int) -> list[tuple[np.uint64, int]]:
        """(bits of the first l segments, most differing bits) for l = 2 .. m - 1."""
        start = self.key_parts()[key_no][0]
        out, mask = [], 0
        for l in range(1, self.m):
            at, n = self.segments[(start + l - 1) % self.m]
            mask |= ((1 << n) - 1) << at
            if l >= 2:
                out.append((np.uint64(mask), l - 1))
        return out


class Near:
    """Which pairs within one key are links: chain conditions, then the full check, then the second check."""

    def __init__(self, ring: Ring, wide_diff: int | None):
        self.ring, self.wide_diff = ring, wide_diff
        self.chains = [ring.chain(k) for k in range(len(ring.key_parts()))]

    def pairs(self, key_no: np.ndarray | int, x: np.ndarray, wide_a=None, wide_b=None) -> np.ndarray:
        """Positions in ``x`` (exclusive or of the two fingerprints) that are links."""
        alive = np.arange(len(x))
        single = np.isscalar(key_no)
        for l in range(max(0, self.ring.m - 2)):
            if not len(alive):
                return alive
            if single:
                mask, most = self.chains[key_no][l]
            else:
                mask = np.array([c[l][0] for c in self.chains], dtype=np.uint64)[key_no[alive]]
                most = self.chains[0][l][1]
            alive = alive[np.bitwise_count(x[alive] & mask) <= most]
        alive = alive[np.bitwise_count(x[alive]) <= self.ring.tau]
        if self.wide_diff is not None and len(alive):
            a = wide_a[alive] if wide_a.ndim == 2 and len(wide_a) == len(x) else wide_a
            alive = alive[np.bitwise_count(a ^ wide_b[alive]).sum(axis=1) <= self.wide_diff]
        return alive


def group_links(near: Near, key_no: int, fp: np.ndarray, wide: np.ndarray | None) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links within one group, as positions.

    A search from node to node compares each with those not yet reached only, so a dense group of copies
    costs little more than one pass, and never yields more edges than members.
    """
    left, out = np.arange(len(fp)), []
    while len(left):
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            q = queue.pop()
            hit = near.pairs(key_no, fp[left] ^ fp[q], None if wide is None else wide[q : q + 1], None if wide is None else wide[left])
            if len(hit):
                got = left[hit]
                out += [(root, int(g)) for g in got]
                queue += got.tolist()
                left = np.delete(left, hit)
    return out


def _bucket_edges(tau: int, wide_diff: int | None, wide_words: int):
    """Reads rows sorted by key, gives edges between the ids of each key's group."""

    def run(batches):
        import pyarrow as pa

        near = Near(Ring(tau), wide_diff)

        def edges(key, ids, fp, wide):
            a_out, b_out = [], []
            cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            size = np.diff(cut)
            no = (key >> 48).astype(np.int64) if near.ring.m > 1 else np.zeros(len(key), dtype=np.int64)
            width = np.repeat(size, size)
            for off in range(1, min(NARROW, int(size.max(initial=0)))):
                i = np.flatnonzero((key[off:] == key[:-off]) & (width[off:] <= NARROW))
                if len(i):
                    j = i + off
                    hit = near.pairs(no[i], fp[i] ^ fp[j], None if wide is None else wide[i], None if wide is None else wide[j])
                    a_out.append(ids[i[hit]])
                    b_out.append(ids[j[hit]])
            for g in np.flatnonzero(size > NARROW):
                s = slice(cut[g], cut[g + 1])
                for a, b in group_links(near, int(no[cut[g]]), fp[s], None if wide is None else wide[s]):
                    a_out.append(ids[s][a : a + 1])
                    b_out.append(ids[s][b : b + 1])
            if not a_out:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], names=["a", "b"])

        kept = None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 2)]
            wide = None
            if wide_words:
                wide = np.stack([batch.column(3 + k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(wide_words)], axis=1)
            part = (*cols, wide)
            if kept is not None:
                part = tuple(None if y is None else np.concatenate([x, y]) for x, y in zip(kept, part, strict=True))
            if not len(part[0]):
                continue
            last = int(np.flatnonzero(np.concatenate(([True], part[0][1:] != part[0][:-1])))[-1])
            head = [None if x is None else x[:last] for x in part]
            kept = tuple(None if x is None else x[last:] for x in part)
            if last and (out := edges(head[0], head[1], head[2].view(np.uint64), None if head[3] is None else np.ascontiguousarray(head[3]).view(np.uint64))):
                yield out
        if kept is not None and (out := edges(kept[0], kept[1], np.ascontiguousarray(kept[2]).view(np.uint64), None if kept[3] is None else np.ascontiguousarray(kept[3]).view(np.uint64))):
            yield out

    return run


def hamming_links(points: DataFrame, tau: int, wide: list[str] | None = None, wide_diff: int | None = None, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect just those points which links of at most ``tau`` differing bits connect.

    ``points``: id (long), fp (long), each fingerprint once; with ``wide`` (further words of 64 bits) a link
    must also differ in at most ``wide_diff`` of those. Every point gives 2 * (tau + 1) keys, one shuffle deals
    them out, and a task compares the members of a key. Keys with more than ``block`` points are cut into
    blocks, and each pair of blocks is a group of its own: nothing is capped, no group is unbounded.
    """
    wide = wide or []
    ring = Ring(tau)
    rows = points.select("id", "fp", *wide, F.explode(ring.keys(F.col("fp"))).alias("key"))
    dealt = rows.selectExpr("key", "id", "fp", *wide, "count(*) over (partition by key) as n", "row_number() over (partition by key order by id) as r").where("n > 1")
    run = _bucket_edges(tau, wide_diff, len(wide))
    cols = ["key", "id", "fp", *wide]
    out = dealt.where(F.col("n") <= block).select(*cols).mapInArrow(run, "a bigint, b bigint")
    half = block // 2
    hot = dealt.where(F.col("n") > block).withColumn("k", F.floor((F.col("r") - 1) / half)).withColumn("m", F.floor((F.col("n") - 1) / half))
    pairs = hot.withColumn("o", F.explode(F.expr("sequence(0L, m)"))).where("not (o = k and m > 0)").selectExpr(*cols, "least(k, o) as p", "greatest(k, o) as q")
    # rows of one pair of blocks stand together: the key's own order, then the pair; the pair is hashed into the dealing
    spread = pairs.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "id")
    tagged = spread.select(*cols, F.xxhash64("p", "q").alias("pq"))
    out_hot = tagged.mapInArrow(_pair_edges(tau, wide_diff, len(wide)), "a bigint, b bigint")
    return out.unionByName(out_hot)


def _pair_edges(tau: int, wide_diff: int | None, wide_words: int):
    """As ``_bucket_edges`` where a change of the last column ends a group too."""
    inner = _bucket_edges(tau, wide_diff, wide_words)

    def run(batches):
        import pyarrow as pa

        kept, name = [], None

        def flush():
            if kept:
                yield from inner(iter([pa.Table.from_batches(kept).combine_chunks().to_batches()[0]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            tag = np.stack([batch.column(0).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()], axis=1)
            cut = [0, *(np.flatnonzero((tag[1:] != tag[:-1]).any(axis=1)) + 1).tolist(), len(tag)]
            for a, b in zip(cut, cut[1:], strict=False):
                if name is not None and tuple(tag[a]) != name:
                    yield from flush()
                    kept.clear()
                name = tuple(tag[a])
                kept.append(batch.slice(a, b - a))
        yield from flush()

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", size: int = 3) -> DataFrame:
    """(id_col, fp): the fingerprint of every whole text as a signed long."""

    def make():
        return lambda ids, texts: [ids, [signed(fingerprint(t, size)) for t in texts]]

    return map_rows(docs, [id_col, "text"], f"`{id_col}` {dict(docs.dtypes)[id_col]}, fp bigint", make)


def components(docs: DataFrame, size: int = 3, tau: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Equal fingerprints are one point, so any number of exact copies costs one row in the search.
    Defined results: null or wordless texts have fingerprint zero and are linked like any other; rows with
    null doc_id take part, and component_id is the smallest doc_id that isn't null (null if there is none);
    repeated rows give a row each; an empty table gives no rows; other columns are not read.
    """
    fps = settle(fingerprints(docs, size=size))
    points = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    edges = hamming_links(points.select(F.col("fp").alias("id"), "fp"), tau)
    roots = settle(connected_components(edges))
    linked = points.join(roots, points.fp == roots.node).select("fp", "root", "low")
    least = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = linked.join(least, "root").select("fp", "component_id")
    owner = points.join(named, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id"))
    return fps.join(owner, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---------------------------------------------------------------------------------------------------------------
# Near-duplicate stage: the links of fingerprints above, and resemblance (Jaccard) of 0.8 or more of sets of five-word shingles, exactly.

#: Shingles of one block of a large candidate group; a task compares two blocks at most (and two texts at least).
BLOCK_SHINGLES = 1 << 19
#: Shingles in a part of a set, about.
PART = 3
#: Shingles of the sets whose keys a task packs at once, and of those that make a bucket (about half as many keys).
PACK_SHINGLES = 1 << 20
BUCKET_SHINGLES = 1 << 20
#: Members up to which those of a key are compared by sketches, and the places of a sketch.
HOT = 1 << 16
PLACES = 2048
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray, seeds: tuple[int, ...]) -> np.ndarray:
    """A 64-bit finaliser, so that each seed gives independent bits; a row for each seed."""
    x = x[None, :] + np.array([(s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF for s in seeds], dtype=np.uint64)[:, None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the set of runs of ``size`` words; of a shorter text its whole sequence."""
    toks = words(text)
    if not toks:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, toks), dtype=np.uint64, count=len(toks))
    run = np.zeros(max(1, len(h) - size + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, len(h))):
            run = run * _MIX + _scramble(h[k : k + len(run)], (k + 1,))[0]
    return np.unique(run)


def _bounds() -> list[int]:
    """First sizes of the size classes, each a quarter above the last; sets of fewer than 4 resemble equal ones only."""
    out = [4]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return out


_SIZES = _bounds()


def near_keys(h: np.ndarray) -> np.ndarray:
    """Keys of a set; two unequal sets with a Jaccard index of 0.8 or more have one in common, always.

    Let the smaller set have a elements. The sets differ in a // 4 elements at most, so of m parts, into which
    elements are dealt by hash, m - d are equal for any d of at least a // 4. Order parts by their number of elements:
    the last of the equal parts is among the last d + 1 in both sets, so those are the keys. m and d are set by the
    size class of the smaller set; a set has keys for each class that a smaller partner may be in. Should a key be an
    empty part, it is so in both sets; then the first n - ceil(0.8 n) + 1 elements are keys of the class too (prefix filtering).
    """
    n = len(h)
    if n < 4:
        return np.empty(0, dtype=np.uint64)
    out = []
    least = max(4, -(-4 * n // 5))
    body = _scramble(h, (7,))[0]
    with np.errstate(over="ignore"):
        for c in range(bisect_right(_SIZES, least) - 1, bisect_right(_SIZES, n)):
            top = _SIZES[c + 1] - 1
            d = top // 4
            m = max(d + 1, top // PART)
            part = ((_scramble(h, (1000 + c,))[0] >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            part = part.astype(np.int64)
            count = np.bincount(part, minlength=m)
            total = np.zeros(m, dtype=np.uint64)
            np.add.at(total, part, body)
            last = np.argsort(count, kind="stable")[m - d - 1 :]
            full = last[count[last] > 0]
            out.append(_scramble(total[full] + full.astype(np.uint64) * _MIX, (2000 + c,))[0])
            if len(full) < len(last):
                out.append(_scramble(h[: n - (-(-4 * n // 5)) + 1], (3000 + c,))[0])
    return np.unique(np.concatenate(out))


def sketch(h: np.ndarray) -> np.ndarray:
    """Parity of a set's elements in each place. Sketches differ in no more places than the sets in elements, so they lose no link."""
    return np.packbits((np.bincount((_scramble(h, (11,))[0] % np.uint64(PLACES)).astype(np.int64), minlength=PLACES) & 1).astype(np.uint8)).view("<u8")


def _pack(size: int, buckets: int):
    """Reads (id, text), gives (bucket, base, ids, keys): many keys in a row, of 40 bits and mostly two bytes of an id each.

    Of equal sets that a task meets at once, one gives keys.
    """

    def rows(met):
        ids, found = list(met.values()), [near_keys(np.frombuffer(h, dtype=np.uint64)) for h in met]
        key, own = np.concatenate(found), np.repeat(np.arange(len(found)), list(map(len, found)))
        bucket = (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        key, own, bucket = key[order], own[order], bucket[order]
        base = min(ids)
        span = max(ids) - base
        off = np.array([i - base for i in ids], dtype=np.uint64).astype("<u2" if span < 1 << 16 else "<u4" if span < 1 << 32 else "<u8")[own]
        low, high = key.astype("<u4"), (key >> np.uint64(32)).astype("<u1")
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))).tolist()
        return [(int(bucket[a]), base, off[a:b].tobytes(), low[a:b].tobytes() + high[a:b].tobytes()) for a, b in zip(cut, cut[1:], strict=False)]

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("bucket", pa.int64()), ("base", pa.int64()), ("ids", pa.binary()), ("keys", pa.binary())])
        met: dict[bytes, int] = {}
        held = 0
        for batch in batches:
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = shingle_set(text, size)
                if len(h) >= 4 and met.setdefault(h.tobytes(), i) == i:
                    held += len(h)
                if held > PACK_SHINGLES:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows(met)], schema=schema)
                    met, held = {}, 0
        if met:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows(met)], schema=schema)

    return run


def _meet(batches):
    """Reads packed keys sorted by bucket, gives (g, id) for the ids of each key that several have; g is made of all its ids."""
    import pyarrow as pa

    def groups(parts):
        key, ids = [], []
        for base, off, keys in parts:
            n = len(keys) // 5
            key.append(np.frombuffer(keys, "<u4", n).astype(np.uint64) | np.frombuffer(keys, "<u1", n, 4 * n).astype(np.uint64) << np.uint64(32))
            ids.append((np.frombuffer(off, f"<u{len(off) // n}").astype(np.uint64) + np.uint64(base & (1 << 64) - 1)).view(np.int64))
        key, ids = np.concatenate(key), np.concatenate(ids)
        order = np.argsort(key)
        key, ids = key[order], ids[order]
        cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        size = np.diff(cut)
        g = np.add.reduceat(_scramble(ids.view(np.uint64), (13,))[0], cut[:-1])
        some = np.flatnonzero(size > 1)
        some = some[np.unique(g[some], return_index=True)[1]]
        if len(some):
            named = np.zeros(len(size), dtype=bool)
            named[some] = True
            here = np.repeat(named, size)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(g[named], size[named]).view(np.int64)), pa.array(ids[here])], names=["g", "id"])

    name, parts = None, []
    for batch in batches:
        for bucket, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != name:
                if parts:
                    yield from groups(parts)
                name, parts = bucket, []
            parts.append(part)
    if parts:
        yield from groups(parts)


def sketch_ties(size: np.ndarray, bits: np.ndarray) -> list[tuple[int, int]]:
    """Edges, as positions, that connect what pairs connect whose sketches allow a Jaccard index of 0.8 or more.

    Such sets differ in a ninth of the sum of their sizes at most.
    """
    left, out = np.arange(len(size)), []
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            q = queue.pop()
            differ = np.maximum(np.bitwise_count(bits[left] ^ bits[q]).sum(axis=1, dtype=np.int64), np.abs(size[left] - size[q]))
            hit = 9 * differ <= size[left] + size[q]
            got, left = left[hit], left[~hit]
            out += [(int(q), int(x)) for x in got]
            queue += got.tolist()
    return out


def _tie(batches):
    """Reads (g, id, n, bits) with the rows of each g together, gives ties between ids."""
    import pyarrow as pa

    def ties(ids, size, bits):
        return [(ids[a], ids[b]) for a, b in sketch_ties(np.array(size, dtype=np.int64), np.frombuffer(b"".join(bits), dtype="<u8").reshape(len(ids), -1))]

    def table(got):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], pa.int64()) for k in (0, 1)], names=["a", "b"])

    name, held = None, ([], [], [])
    for batch in batches:
        out = []
        for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if g != name:
                out += ties(*held) if len(held[0]) > 1 else []
                name, held = g, ([], [], [])
            for x, v in zip(held, row, strict=True):
                x.append(v)
        yield table(out)
    yield table(ties(*held) if len(held[0]) > 1 else [])


def set_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges, as positions, that connect just those sets which pairs with a Jaccard index of 0.8 or more connect.

    A search from set to set counts the elements that it shares with each set not yet reached.
    """
    size = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    held, start = owner[order], np.concatenate(([0], np.cumsum(np.bincount(code))))
    first = np.concatenate(([0], np.cumsum(size)))
    left, out = np.ones(len(sets), dtype=bool), []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            q = queue.pop()
            own = code[first[q] : first[q + 1]]
            n = start[own + 1] - start[own]
            at = np.repeat(start[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.bincount(held[at], minlength=len(sets))
            hit = np.flatnonzero(left & (both > 0) & (5 * both >= 4 * (size + size[q] - both)))
            left[hit] = False
            out += [(q, int(x)) for x in hit]
            queue += hit.tolist()
    return out


def _near_edges(size: int):
    """Reads (group, p, q, id, text) with the rows of each (group, p, q) together, gives edges between their ids."""

    def run(batches):
        import pyarrow as pa

        def edges(ids, sets):
            got = set_links(sets) if len(ids) > 1 else []
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in got], pa.int64()), pa.array([ids[b] for _, b in got], pa.int64())], names=["a", "b"])

        name, ids, sets = None, [], []
        for batch in batches:
            for g, p, q, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (g, p, q) != name:
                    yield from edges(ids, sets)
                    name, ids, sets = (g, p, q), [], []
                ids.append(i)
                sets.append(shingle_set(text, size))
        yield from edges(ids, sets)

    return run


def _star_edges(size: int):
    """Reads (g, k, id, text) with the rows of each (g, k) together, that of id g first; gives (id, g) where the two are near."""

    def run(batches):
        import pyarrow as pa

        name, first, out = None, None, []
        for batch in batches:
            for g, k, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = shingle_set(text, size)
                if (g, k) != name:
                    assert i == g
                    name, first = (g, k), h
                elif set_links([first, h]):
                    out.append((i, g))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    return run


def block_pairs(placed: DataFrame) -> DataFrame:
    """(id, g, p, q) for each pair of blocks in which two texts may meet that aren't known to be connected.

    ``placed``: id, g (candidate group), k (block), r (root of what is known). Two blocks within one root are spared, so
    a group that is known but for a few members sends its texts once for each block of the few, not for each of its own.
    """
    blocks = placed.groupBy("g", "k").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.max("m").alias("m"))
    left, right = blocks.selectExpr("g", "k as p", "lo as lo1", "hi as hi1", "m"), blocks.selectExpr("g", "k as q", "lo as lo2", "hi as hi2")
    met = left.join(right, "g").where("(p < q or m = 0) and not (lo1 = hi1 and lo2 = hi2 and lo1 = lo2)")
    each = met.select("g", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("k"))
    return placed.join(each, ["g", "k"]).select("id", "g", "p", "q")


def near_duplicates(docs: DataFrame, id_col: str, size: int = 5, block: int = BLOCK_SHINGLES, tau: int | None = None) -> DataFrame:
    """(id_col, root): rows with the same root are near duplicates, directly or by a chain.

    Two texts are linked if the Jaccard index of their sets of five-word shingles is 0.8 or more; none is missed and
    none below is linked. With ``tau`` texts are linked too whose fingerprints (of three-word shingles) differ in at most
    that many bits, as in ``components``, by pigeonring. Texts with the same set are one point.

    Sets meet by keys, packed into rows for buckets and sorted there. Those with a key in common are tied where their sketches
    allow a link, so a key gives no more ties than members and a common phrase none between unlike texts; a key of more than
    ``HOT`` members ties them all to the least.
    One tie of each point is checked by whole sets first. What ties connect is a candidate group; in those that the first check
    doesn't connect, all members are compared by their whole sets. Groups of more than ``block`` shingles are cut into blocks,
    and each pair of blocks is compared unless it is connected already: nothing is capped. ``id_col`` must be a unique long,
    ``docs`` a repeatable plan.
    """

    def make():
        def run(ids, texts):
            sets = [shingle_set(t, size) for t in texts]
            named = [xxhash.xxh3_128_intdigest(h.tobytes()) for h in sets]
            fps = [signed(fingerprint(t)) if tau is not None else None for t in texts]
            return [ids, [signed(x >> 64) for x in named], [signed(x & ((1 << 64) - 1)) for x in named], list(map(len, sets)), fps]

        return run

    rows = settle(map_rows(docs, [id_col, "text"], "id bigint, s1 bigint, s2 bigint, n bigint, fp bigint", make))
    firsts = rows.groupBy("s1", "s2").agg(F.min("id").alias("point"))
    named = settle(rows.select("id", "s1", "s2", "n").join(firsts, ["s1", "s2"]).select("id", "point", "n"))
    texts = docs.select(F.col(id_col).alias("id"), "text")
    buckets = 1 + (named.agg(F.sum("n")).first()[0] or 0) // BUCKET_SHINGLES
    packed = texts.mapInArrow(_pack(size, buckets), "bucket bigint, base bigint, ids binary, keys binary")
    met = settle(packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet, "g bigint, id bigint").distinct())
    met = met.join(named.select("id", "point"), "id").select("g", F.col("point").alias("id")).distinct()
    met = settle(met.selectExpr("g", "id", "count(*) over (partition by g) as c", "min(id) over (partition by g) as low").where("c > 1"))
    few = settle(met.where(F.col("c") <= HOT).select("id").distinct())

    def sketches():
        def run(ids, texts):
            sets = [shingle_set(t, size) for t in texts]
            return [ids, list(map(len, sets)), [sketch(h).tobytes() for h in sets]]

        return run

    bits = settle(map_rows(texts.join(F.broadcast(few) if small(few, 1_000_000) else few, "id"), ["id", "text"], "id bigint, n bigint, bits binary", sketches))
    cold = met.where(F.col("c") <= HOT).select("g", "id").join(bits, "id").select("g", "id", "n", "bits").repartition("g").sortWithinPartitions("g", "id")
    ties = met.where((F.col("c") > HOT) & (F.col("id") > F.col("low"))).selectExpr("id as a", "low as b").unionByName(cold.mapInArrow(_tie, "a bigint, b bigint"))
    ties = settle(ties.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    points = named.where("id = point").select("id", "n")

    def meet(rows: DataFrame, cols: list[str]) -> DataFrame:
        rows = settle(rows)
        held = texts.join(F.broadcast(rows) if small(rows, 1_000_000) else rows, "id")
        return held.select(*cols, "id", "text").repartition(*cols).sortWithinPartitions(*cols, "id")

    star = ties.groupBy("a").agg(F.min("b").alias("g")).withColumnRenamed("a", "id").join(points, "id")
    star = star.selectExpr("id", "g", f"floor((sum(n) over (partition by g order by id) - n) / {block}) as k")
    star = star.unionByName(star.selectExpr("g as id", "g", "k").distinct())
    known = settle(meet(star, ["g", "k"]).mapInArrow(_star_edges(size), "a bigint, b bigint"))
    tied = connected_components(ties).select(F.col("node").alias("id"), F.col("root").alias("g")).join(points, "id")
    tied = tied.join(connected_components(known).withColumnRenamed("node", "id"), "id", "left").select("id", "g", "n", F.coalesce("root", "id").alias("r"))
    open_ = settle(tied.selectExpr("*", "min(r) over (partition by g) as lo", "max(r) over (partition by g) as hi").where("lo < hi"))
    placed = open_.selectExpr("id", "g", "r", f"floor((sum(n) over (partition by g order by r, id) - n) / {block}) as k")
    placed = settle(placed.selectExpr("*", "max(k) over (partition by g) as m"))
    edges = known.unionByName(meet(block_pairs(placed), ["g", "p", "q"]).mapInArrow(_near_edges(size), "a bigint, b bigint"))
    if tau is not None:
        lows = settle(rows.join(named.select("id", "point"), "id").groupBy("fp").agg(F.min("point").alias("low")))
        near = hamming_links(lows.select(F.col("low").alias("id"), "fp"), tau)
        same = rows.select("id", "fp").join(points.select("id"), "id").join(lows, "fp").selectExpr("id as a", "low as b").where("a <> b")
        edges = edges.unionByName(near).unionByName(same)
    roots = connected_components(edges)
    owner = named.join(roots, named.point == roots.node, "left")
    return owner.select(F.col("id").alias(id_col), F.coalesce("root", "point").alias("root"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates (the first by ``doc_id``, nulls first, then by scan order); columns unchanged.

    Linked are fingerprints at 3 or fewer differing bits, as in ``components``, and sets of shingles at 0.8 or more.
    Texts without words are one group. Rows are told apart by a row number of the scan, so null or repeated
    ids do no harm; ``docs`` must be a repeatable plan such as a Parquet read. An empty table gives no rows; without a ``doc_id`` the scan's order counts. Other columns may have any names.
    """
    row = free_name(docs, "__row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    ids = numbered.select(F.col(row).alias("row"), (F.col("doc_id") if "doc_id" in docs.columns else F.lit(None).cast("bigint")).alias("doc_id"))
    groups = near_duplicates(numbered.select(F.col(row).alias("row"), "text"), "row", tau=3)
    first = groups.join(ids, "row").groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("members"))
    kept = settle(first.where("members > 1").select("root", F.col("first.row").alias("kept")))
    gone = settle(sized_join(groups, kept, ["root"], "inner", 1_000_000).where("row <> kept").select(F.col("row").alias(row)))
    return numbered.join(F.broadcast(gone) if small(gone, 1_000_000) else gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
