"""N-gram Jaccard join (operator 1): grouped prefix join over word shingles.

A document's set holds the 64-bit hashes of its distinct shingles; equal sets are one set from
the start (a set is named by a hash of its members). Two sets link when
100 * |intersection| >= 80 * |union|.

1. Inverted index. Shingles go to buckets by hash, packed: per map task and bucket one row with
   the sets' names, sizes and shingles. A bucket counts in how many sets each shingle occurs.
   Shingles of one set only can be in no intersection and stop here; they count as the rarest ones.
2. Prefixes. The others return to their sets. Shingles are ordered by document frequency, then
   hash; a set of n shingles can link only through its first n - ceil(0.8 n) + 1. Where the shingles that
   occur nowhere else fill that prefix, the set links with nothing and leaves.
3. Groups. Sets with the same prefix, size and number of lone shingles form one group; only
   groups are joined on prefix shingles. A pair of groups must pass the size and the position filter.
4. First links. In each shingle's bucket every group is paired with the bucket's pivot only,
   and each member of a group with its representative; members are verified on their whole sets. Verified
   pairs give components. That settles large groups of copies with a number of pairs in
   proportion to their size.
5. Rest. Shingles whose groups' members still lie in several components hold all pairs that may
   be missing. Members there are laid into blocks of similar sets; two blocks that share
   such a shingle, compatible sizes and more than one component are compared whole, as matrices, in the
   cell of their two classes, to which each block travels once. Nothing is
   left out: a link between sets of different components must share a prefix shingle, which
   then lies in several components.
6. Components of all links; every document takes the smallest id of its component.

Names are 64-bit hashes, shingles travel as 40 bits plus their bucket (one of P). Two sets of a and b shingles
are thus found to share one too many with a probability of about a b / (2^40 P); sizes and equal
sets are told by the full 64 bits.

Defined cases: texts without words (NULL, empty) have an empty set and link with nothing; fewer words than
a shingle form one shingle; equal rows are each a document and link through their
common set; NULL ids take part, and a component's id is its smallest id that is not NULL; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from medallion.llm.common import bucket_count, cut, give_back, lean, session, slots, text_key
from medallion.llm.components import components
from medallion.llm.words import U, Words, grams, mix, words

SHINGLE, PERCENT = 5, 80
FLUSH_KEYS = 1_000_000  # shingles a map task holds before it packs them
BLOCK_SETS, BLOCK_KEYS = 128, 200_000  # members and shingles of a block
LEAST_CLASSES, CLASS_BYTES = 5, 16 << 20  # classes of blocks, and a class's compressed bytes from which there are more
OUT_BYTES = 4 << 20  # packed bytes of one Arrow batch
_LOW = U((1 << 40) - 1)  # bits of a shingle that travel; its bucket adds more


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, names, shingles row after row, ascending) of the sets of a chunk's rows."""
    g, at = grams(w.hash, w.doc, k)
    row = w.doc[at]
    n_words = w.counts()
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):  # the whole sequence is one shingle
        extra = []
        first = np.searchsorted(w.doc, short)
        with np.errstate(over="ignore"):
            for r, a in zip(short, first, strict=True):
                m = int(n_words[r])
                x, _ = grams(w.hash[a:a + m], np.zeros(m, np.int64), m)
                extra.append(x[0] ^ U(m * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        row = np.concatenate((row, short))
        order = np.argsort(row, kind="stable")
        row, g = row[order], np.concatenate((g, np.array(extra, U)))[order]
    cuts = np.searchsorted(row, np.arange(w.n + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        g[a:b].sort()
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[fresh], row[fresh]
    size = np.bincount(row, minlength=w.n)
    c = np.zeros(len(g) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(mix(g ^ U(0x5851F42D4C957F2D)), out=c[1:])
        off = np.concatenate(([0], np.cumsum(size)))
        name = mix((c[off[1:]] - c[off[:-1]]) + size.astype(U) * U(0xD6E8FEB86659FD93))
    return size, name, g


# --- documents' sets ---

def _doc_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            name = np.zeros(batch.num_rows, U)
            for w in words(batch.column("text"), lower=True):
                size[w.row0:w.row0 + w.n], name[w.row0:w.row0 + w.n], _ = shingle_sets(w, k)
            sid = pa.array(_signed(name), pa.int64(), mask=size == 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tk"), sid, pa.array(size)],
                                             names=["doc_id", "tk", "sid", "n"])
    return run


# --- 1. inverted index ---

def _pack(parts: list[np.ndarray]) -> bytes:
    head = np.array([len(p) for p in parts], np.int64)
    return head.tobytes() + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _unpack(blob, kinds) -> list[np.ndarray]:
    head = np.frombuffer(blob, np.int64, len(kinds))
    out, at = [], 8 * len(kinds)
    for n, kind in zip(head, kinds, strict=True):
        out.append(np.frombuffer(blob, kind, int(n), at))
        at += int(n) * np.dtype(kind).itemsize
    return out


_POSTING = (np.uint64, np.uint32, np.uint32, np.uint32, np.uint8)  # names, sizes, counts, shingle low, high


def _by_bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> U(48)) * U(n)) >> U(16)).astype(np.uint16 if n <= 1 << 16 else np.int64)


def _rows(slot: np.ndarray, made: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(slot[b]) for b, _ in made], pa.int64()),
                                       pa.array([b for b, _ in made], pa.int32()),
                                       pa.array([x for _, x in made], pa.binary())], names=["slot", "bucket", "blob"])


def _flush(size, name, keys, n_buckets, slot) -> Iterator[pa.RecordBatch]:
    size, name, keys = np.concatenate(size), np.concatenate(name), np.concatenate(keys)
    owner = np.repeat(np.arange(len(size)), size)
    # equal sets are sent once
    _, one = np.unique(name, return_index=True)
    lead = np.zeros(len(name), bool)
    lead[one] = True
    ok = lead[owner]
    owner, keys = owner[ok], keys[ok]
    bucket = _by_bucket(keys, n_buckets)
    order = np.argsort(bucket, kind="stable")
    owner, keys, bucket = owner[order], keys[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
    made, held = [], 0
    for b in range(n_buckets):
        x, y = edges[b], edges[b + 1]
        if x == y:
            continue
        o, k = owner[x:y], keys[x:y] & _LOW
        first = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        who = o[first]
        blob = _pack([name[who], size[who].astype(np.uint32), np.diff(np.append(first, len(o))).astype(np.uint32),
                      (k & U(0xFFFFFFFF)).astype(np.uint32), (k >> U(32)).astype(np.uint8)])
        made.append((b, blob))
        held += len(blob)
        if held > OUT_BYTES:
            yield _rows(slot, made)
            made, held = [], 0
    if made:
        yield _rows(slot, made)


def _postings(k: int, n_buckets: int, slot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, name, keys, held = [], [], [], 0
        for batch in batches:
            for w in words(batch.column("text"), lower=True):
                s, n, g = shingle_sets(w, k)
                some = s > 0
                size.append(s[some])
                name.append(n[some])
                keys.append(g)
                held += len(g)
                if held >= FLUSH_KEYS:
                    yield from _flush(size, name, keys, n_buckets, slot)
                    size, name, keys, held = [], [], [], 0
        if held:
            yield from _flush(size, name, keys, n_buckets, slot)
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> dict[int, list]:
    found: dict[int, list] = {}
    for batch in batches:
        for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
            found.setdefault(b, []).append(blob.as_buffer().to_pybytes())
    return found


_SHARED = (np.uint64, np.uint32, np.uint32, np.uint64, np.uint32)  # names, sizes, counts, shingles, frequencies


def _shared(n_buckets: int, slot: np.ndarray):
    """Per bucket: shingles found in two sets or more, sent to their sets' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, blobs in _gather(batches).items():
            cols = list(zip(*(_unpack(x, _POSTING) for x in blobs), strict=True))
            blobs.clear()
            count = np.concatenate(cols[2])
            name, size = np.concatenate(cols[0]), np.concatenate(cols[1])
            key = np.concatenate(cols[3]).astype(U) | (np.concatenate(cols[4]).astype(U) << U(32))
            del cols
            who = np.repeat(np.arange(len(name), dtype=np.int64), count)
            order = np.argsort(key)
            key, who = key[order], who[order]
            del order
            same = key[1:] == key[:-1]
            many = np.append(False, same) | np.append(same, False)
            key, who = key[many], who[many]
            order = np.lexsort((name[who], key))
            key, who = key[order], who[order]
            fresh = np.append(True, (key[1:] != key[:-1]) | (name[who[1:]] != name[who[:-1]])) if len(key) else np.zeros(0, bool)
            key, who = key[fresh], who[fresh]
            if not len(key):
                continue
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            freq = np.diff(np.append(start, len(key)))
            freq = np.repeat(freq, freq)
            ok = freq > 1
            key, who, freq = key[ok] | (U(b) << U(48)), who[ok], freq[ok]
            if not len(key):
                continue
            back = _by_bucket(name[who], n_buckets)
            order = np.lexsort((name[who], back))
            key, who, freq, back = key[order], who[order], freq[order], back[order]
            edges = np.searchsorted(back, np.arange(n_buckets + 1))
            made, held = [], 0
            for t in range(n_buckets):
                x, y = edges[t], edges[t + 1]
                if x == y:
                    continue
                nm = name[who[x:y]]
                first = np.flatnonzero(np.append(True, nm[1:] != nm[:-1]))
                blob = _pack([nm[first], size[who[x:y]][first], np.diff(np.append(first, y - x)).astype(np.uint32),
                              key[x:y], freq[x:y].astype(np.uint32)])
                made.append((t, blob))
                held += len(blob)
                if held > OUT_BYTES:
                    yield _rows(slot, made)
                    made, held = [], 0
            if made:
                yield _rows(slot, made)
    return run


_CAND = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("lone", pa.int64()), ("gid", pa.int64()),
                   ("prefix", pa.binary()), ("keys", pa.binary())])
_CAND_DDL = "sid long, n long, lone long, gid long, prefix binary, keys binary"


def least_overlap(n, percent: int):
    """Shingles that a set of n must share with any set it links with."""
    return -(-percent * n // 100)


def _candidates(percent: int):
    """Per set: its shared shingles by (frequency, hash), if its prefix reaches them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _gather(batches).values():
            cols = list(zip(*(_unpack(x, _SHARED) for x in blobs), strict=True))
            blobs.clear()
            count = np.concatenate(cols[2])
            name, size = np.concatenate(cols[0]), np.concatenate(cols[1])
            key, freq = np.concatenate(cols[3]), np.concatenate(cols[4])
            del cols
            uniq, inv = np.unique(name, return_inverse=True)
            total = np.zeros(len(uniq), np.int64)
            total[inv] = size
            have = np.bincount(inv, weights=count).astype(np.int64)
            live = have >= least_overlap(total, percent)  # else lone shingles fill the prefix
            who = np.repeat(inv, count)
            ok = live[who]
            who, key, freq = who[ok], key[ok], freq[ok]
            order = np.lexsort((key, freq, who))
            who, key = who[order], key[order]
            out = {f.name: [] for f in _CAND}
            edges = np.searchsorted(who, np.arange(len(uniq) + 1))
            held = 0
            for s in np.flatnonzero(live):
                a, b = edges[s], edges[s + 1]
                n, lone = int(total[s]), int(total[s] - have[s])
                reach = n - int(least_overlap(n, percent)) + 1 - lone
                pre = key[a:a + reach]
                with np.errstate(over="ignore"):
                    gid = mix((mix(pre + np.arange(1, len(pre) + 1, dtype=U) * U(0x9E3779B97F4A7C15)).sum(keepdims=True)
                               + U(n)) * U(0xD6E8FEB86659FD93) + U(lone))
                out["sid"].append(int(_signed(uniq[s:s + 1])[0]))
                out["n"].append(n)
                out["lone"].append(lone)
                out["gid"].append(int(_signed(gid)[0]))
                out["prefix"].append(pre.tobytes())
                out["keys"].append(key[a:b].tobytes())
                held += 8 * (b - a)
                if held > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _CAND], schema=_CAND)
                    out, held = {f.name: [] for f in _CAND}, 0
            if out["sid"]:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _CAND], schema=_CAND)
    return run


# --- 3. group postings ---

def _explode_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pre = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("prefix")]
        count = np.array([len(p) for p in pre], np.int64)
        if not count.sum():
            continue
        at = np.repeat(np.arange(len(pre)), count)
        pos = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        col = {c: batch.column(c).to_numpy()[at] for c in ("gid", "rep", "n", "lone")}
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pre)), pa.array(col["gid"]), pa.array(col["rep"]),
                                          pa.array(col["n"]), pa.array(col["lone"]), pa.array(pos + col["lone"])],
                                         names=["token", "gid", "rep", "n", "lone", "pos"])


def _sizes_fit(a: str, b: str, percent: int):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _position_fits(na: str, pa_: str, nb: str, pb: str, percent: int):
    """The overlap that is still possible from a first common shingle at these positions."""
    best = F.lit(1) + F.least(F.col(na) - F.col(pa_) - 1, F.col(nb) - F.col(pb) - 1)
    return (100 + percent) * best >= percent * (F.col(na) + F.col(nb))


@arrow_udf(LongType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    out = np.zeros(len(a), np.int64)
    for r in range(len(a)):
        x, y = np.frombuffer(a[r].as_buffer(), np.int64), np.frombuffer(b[r].as_buffer(), np.int64)
        both = np.sort(np.concatenate((x, y)))
        out[r] = (both[1:] == both[:-1]).sum()
    return pa.array(out)


def _verify(pairs: DataFrame, cand: DataFrame, percent: int) -> DataFrame:
    """(src, dst) of the pairs that link."""
    one = cand.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("keys").alias("ka"))
    two = cand.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("kb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("o", _overlap("ka", "kb"))
    return (both.filter(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o")))
            .select(F.col("a").alias("src"), F.col("b").alias("dst")))


# --- 5. blocks ---

_BLOCK = (np.int64, np.int64, np.int64, np.int64, np.uint64)  # sets, sizes, components, counts, shingles


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs sorted sets into blocks, compressed (neighbours share most shingles); a block is
    named by its first set."""
    held: list[tuple] = []
    keys = 0

    def pack():
        k = [np.frombuffer(h[3], U) for h in held]
        blob = _pack([np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64),
                      np.array([h[2] for h in held], np.int64), np.array([len(x) for x in k], np.int64),
                      np.concatenate(k)])
        return pa.RecordBatch.from_arrays(
            [pa.array([held[0][0]], pa.int64()), pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
             pa.array([zstandard.ZstdCompressor(level=1).compress(blob)], pa.binary())], names=["block", "sids", "blob"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("sid", "n", "comp", "keys")), strict=True):
            held.append(row)
            keys += len(row[3]) // 8
            if len(held) >= BLOCK_SETS or keys >= BLOCK_KEYS:
                yield pack()
                held, keys = [], 0
    if held:
        yield pack()


def _compare(a: tuple, b: tuple, percent: int) -> tuple[list, list]:
    """Links between the components of two blocks: one for each pair of components that it joins."""
    (sa, na, ca, la, ka), (sb, nb, cb, lb, kb) = a, b
    uniq, inv = np.unique(np.concatenate((ka, kb)), return_inverse=True)
    ra, rb = np.repeat(np.arange(len(sa)), la), np.repeat(np.arange(len(sb)), lb)
    ia, ib = inv[:len(ka)], inv[len(ka):]
    over = np.zeros((len(sa), len(sb)), np.float32)
    for lo in range(0, len(uniq), 16384):  # matrix product, a stretch of shingles at a time
        x, y = np.zeros((len(sa), 16384), np.float32), np.zeros((len(sb), 16384), np.float32)
        p, q = (ia >= lo) & (ia < lo + 16384), (ib >= lo) & (ib < lo + 16384)
        x[ra[p], ia[p] - lo] = 1
        y[rb[q], ib[q] - lo] = 1
        over += x @ y.T
    o = np.rint(over).astype(np.int64)
    link = (100 * o >= percent * (na[:, None] + nb[None, :] - o)) & (ca[:, None] != cb[None, :])
    i, j = np.nonzero(link)
    if not len(i):
        return [], []
    _, one = np.unique(np.stack((ca[i], cb[j]), 1), axis=0, return_index=True)
    return sa[i[one]].tolist(), sb[j[one]].tolist()


def _cross(percent: int):
    """The links of one cell: its pairs of blocks, each block being sent to the cell once."""
    def run(pairs: pa.Table, blocks: pa.Table) -> pa.Table:
        inflate = zstandard.ZstdDecompressor().decompress
        blob = {k: v for k, v in zip(blocks.column("block").to_pylist(), blocks.column("blob"), strict=True)}
        src, dst = [], []
        held: tuple | None = None
        for a, b in sorted(zip(pairs.column("block_a").to_pylist(), pairs.column("block_b").to_pylist(), strict=True)):
            if held is None or held[0] != a:
                held = a, _unpack(inflate(blob[a].as_py()), _BLOCK)
            one, two = _compare(held[1], _unpack(inflate(blob[b].as_py()), _BLOCK), percent)
            src += one
            dst += two
        give_back()
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})
    return run


def _cells(pairs: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """The links of all pairs of blocks. Blocks are dealt into g classes by hash and pairs into the g (g + 1) / 2 cells
    of two classes; a block travels to at most g cells, once each, however many partners it has there. g grows with
    the blocks' bytes, so that a cell stays bounded."""
    size = blocks.agg(F.sum(F.length("blob"))).first()[0] or 0
    g = max(LEAST_CLASSES, -(-size // CLASS_BYTES))
    one, two = (F.pmod(F.xxhash64(c), F.lit(g)) for c in ("block_a", "block_b"))
    pairs = cut(pairs.withColumn("cell", F.least(one, two) * g + F.greatest(one, two)), "block-pairs")
    sent = (pairs.select("cell", F.explode(F.array("block_a", "block_b")).alias("block")).distinct()
            .join(blocks.select("block", "blob"), "block").select(F.col("cell").alias("to"), "block", "blob"))
    return (pairs.groupBy("cell").cogroup(sent.groupBy("to")).applyInArrow(_cross(percent), "src long, dst long"))


def set_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, text_col: str = "text") -> DataFrame:
    """(sid, root): the component of every set that links with another one."""
    spark = session(docs)
    n_buckets = bucket_count(docs)
    slot = slots(spark, n_buckets)
    text = docs.select(F.col(text_col).alias("text"))
    packed = "slot long, bucket int, blob binary"
    index = text.mapInArrow(lean(_postings(k, n_buckets, slot)), packed).repartition(n_buckets, "slot")
    shared = index.mapInArrow(lean(_shared(n_buckets, slot)), packed).repartition(n_buckets, "slot")
    cand = cut(shared.mapInArrow(lean(_candidates(percent)), _CAND_DDL), "sets")

    groups = (cand.groupBy("gid").agg(F.min(F.struct("sid", "n", "lone", "prefix")).alias("g"))
              .select("gid", F.col("g.sid").alias("rep"), "g.n", "g.lone", "g.prefix"))
    post = cut(groups.mapInArrow(lean(_explode_prefix), "token long, gid long, rep long, n long, lone long, pos long"), "prefixes")
    # the pivot: the member with the fewest shingles of its own, relative to its size
    order = F.struct((F.col("lone") * 1000 / F.col("n")).cast("long").alias("o"), F.xxhash64("rep").alias("h"),
                     F.col("rep").alias("p_rep"), F.col("n").alias("p_n"), F.col("pos").alias("p_pos"))
    pivot = (post.groupBy("token").agg(F.min(order).alias("p"), F.count(F.lit(1)).alias("c")).filter("c > 1")
             .select("token", "p.p_rep", "p.p_n", "p.p_pos"))
    near = (post.join(pivot, "token").filter(F.col("rep") != F.col("p_rep"))
            .filter(_sizes_fit("n", "p_n", percent) & _position_fits("n", "pos", "p_n", "p_pos", percent))
            .select(F.col("p_rep").alias("a"), F.col("rep").alias("b")))
    member = (cand.select("gid", "sid").join(groups.select("gid", "rep"), "gid").filter("sid != rep")
              .select(F.col("rep").alias("a"), F.col("sid").alias("b")))
    pairs = cut(near.unionByName(member).distinct(), "pairs")
    links = cut(_verify(pairs, cand, percent), "links")
    first = components(links)

    # shingles whose groups' members lie in several components
    sets = cand.select("sid", "gid", "n").join(first.select(F.col("node").alias("sid"), "root"), "sid", "left") \
        .select("sid", "gid", "n", F.coalesce("root", "sid").alias("comp"))
    sets = cut(sets, "sets")
    per = sets.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    post = post.join(per, "gid")
    open_tokens = (post.groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h"))
                   .filter("l != h").select("token"))
    rest = post.join(open_tokens, "token").select("token", "gid").join(sets, "gid")
    rest = cut(rest.select("token", "sid", "n", "comp"), "rest")
    if rest.isEmpty():
        return first.withColumnRenamed("node", "sid")
    lead = rest.groupBy("sid", "n", "comp").agg(F.min("token").alias("lead"))
    laid = (lead.join(cand.select("sid", "keys"), "sid").repartitionByRange("lead", "n", "sid")
            .sortWithinPartitions("lead", "n", "sid"))
    blocks = cut(laid.mapInArrow(lean(_blocks), "block long, sids array<long>, blob binary"), "blocks")
    where = blocks.select("block", F.explode("sids").alias("sid"))
    touch = (rest.join(where, "sid").groupBy("token", "block")
             .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("comp").alias("c"), F.max("comp").alias("d")))
    touch = cut(touch, "touch")
    two = touch.withColumnsRenamed({"block": "block_b", "lo": "lo_b", "hi": "hi_b", "c": "c_b", "d": "d_b"})
    pairs = (touch.join(two, "token").filter(F.col("block") <= F.col("block_b"))
             .filter((F.col("hi_b") * 100 >= F.col("lo") * percent) & (F.col("hi") * 100 >= F.col("lo_b") * percent))
             .filter(F.least("c", "c_b") != F.greatest("d", "d_b"))
             .select(F.col("block").alias("block_a"), "block_b").distinct())
    more = cut(_cells(pairs, blocks, percent), "links")
    comp = first.select(F.col("node").alias("src"), F.col("root").alias("dst")).filter("src != dst")
    return components(comp.unionByName(more)).withColumnRenamed("node", "sid")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, set_id, text_key, kept) for every row of ``docs``. ``kept`` marks
    the rows of the document that stays: the smallest id of its component and, among texts of
    that id, the smallest text key; documents with an empty set all stay."""
    session(docs)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("tk"), F.col(text_col).alias("text"))
    rows = cut(text.mapInArrow(lean(_doc_sets(k)), "doc_id long, tk long, sid long, n long"), "documents")
    comps = set_components(docs, k, percent, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "tk"))  # ids before NULL
    least = rows.filter("sid IS NOT NULL").groupBy("sid").agg(first.alias("low"))
    low = least.join(comps, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    root = low.groupBy("root").agg(F.min("low").alias("first"))
    ids = low.join(root, "root").select(F.col("sid").alias("set_id"), "first")
    alone = F.col("sid").isNull()
    return (rows.join(ids, F.col("sid") == F.col("set_id"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
                    F.col("sid").alias("set_id"), F.col("tk").alias("text_key"),
                    (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tk") == F.col("first.tk")))).alias("kept")))


def representatives(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of each component one row of the document that stays.

    Of rows equal in id and text the least by all other columns stays, whatever the partitioning, so a
    rerun agrees; columns must be orderable. Documents with an empty set all stay. The
    decisions are a narrow table of (id, text key), joined to the texts once."""
    rows = cut(near_duplicates(docs, k, percent, id_col, text_col), "near-duplicates")
    key = [F.col("doc_id").alias("__nd_id"), F.col("text_key").alias("__nd_tk")]
    on = docs[id_col].cast("long").eqNullSafe(F.col("__nd_id")) & (text_key(text_col) == F.col("__nd_tk"))
    kept = docs.join(cut(rows.filter("NOT kept").select(*key).distinct(), "gone"), on, "left_anti")
    twice = cut(rows.filter("kept AND set_id IS NOT NULL").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                .drop("n"), "equal-rows")
    if twice.isEmpty():
        return kept
    names = docs.columns
    least = F.min(F.struct(*[c for c in names if c != text_col], text_col)).alias("__nd_row")
    one = (kept.join(twice, on, "left_semi").groupBy(F.col(id_col).cast("long").alias("__nd_id"), text_key(text_col).alias("__nd_tk"))
           .agg(least).select(*[F.col("__nd_row")[c].alias(c) for c in names]))
    return kept.join(twice, on, "left_anti").unionByName(one)
