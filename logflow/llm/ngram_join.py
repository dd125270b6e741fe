"""N-gram Jaccard join (2) by vertical partitioning.

A document's set is its distinct 3-word shingles (lower-cased A-Z; words are
runs without ASCII blanks).  Two documents link when
``100 * intersection >= percent * union``; the result is each document's set
size and the smallest doc_id reachable by links.

The global order of shingles is that of their 64-bit hashes, and fragments are
ranges of that order.

1. Every document is cut into its fragments, and each fragment counts by
   itself how many of a document's shingles occur in no other document.
   Summed per document this bounds its overlap with any other: a set with
   more than ``100 - percent`` percent shingles of its own has no link.
   The fragments travel as packed arrays of 32 bits a shingle; what is to be
   known of whole sets goes with one fragment of each block of documents, and
   the counts come back as one array for a block.  A fragment has a bounded
   number of shingles; more than ``FANOUT`` fragments are cut in
   two steps, so that blocks never make rows of a few shingles each.
2. Equal sets are one class, represented by its smallest doc_id; step 1 is
   repeated among the representatives that are left, as long as it excludes
   a tenth of them.
3. Candidates: with at most d differing shingles, two sets cut into d + 1
   ranges agree on one whole range.  Sizes are dealt into classes, each with
   its own d, and every set signs its ranges for its class and the one below.
4. In each group of equal signatures one member after another (first 1, then
   3, 12, ... more) is compared with those after it that are not yet known to
   be in its component.  A group of copies is settled by its first member;
   pairs within a component are never made.  Bit sketches that bound the
   difference of two sets from below leave out pairs that cannot link.
5. Pairs are verified by fragments: partial overlaps are counted for each
   fragment separately and summed per pair.  Components are found by
   alternating star contractions over the verified links.

Null or empty text and texts without words have an empty set and link with
nothing; with fewer than 3 words the whole sequence is the one shingle.  Rows
without doc_id are left out; rows that repeat a doc_id are one document (with
different texts, the one with the largest set, then the largest hashes, stands
for it; shingles are counted for each text by itself).  An empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logflow.llm._common import ASCII_LOWER, WORD_HASHES, id_text, map_slices, mix, shingle_hashes, stored

_32 = np.uint64(32)
_ODD = np.uint64(0x9E3779B97F4A7C15)

#: Documents packed at a time, and bytes of a fragment: what a task holds of
#: it is some ten times as much.
BLOCK_ROWS = 1000
FRAGMENT_BYTES = 5 << 20


def shingle_set(text: str, k: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    h = WORD_HASHES.of(text.encode("utf-8").translate(ASCII_LOWER).split())
    if not len(h):
        return np.zeros(0, np.uint64)
    if len(h) < k:
        return mix(shingle_hashes(h, len(h)) + np.uint64(len(h)))
    return np.unique(shingle_hashes(h, k))


def fragment_of(g: np.ndarray, fragments: int) -> np.ndarray:
    return (((g >> _32) * np.uint64(fragments)) >> _32).astype(np.int64)


#: A block's part of a fragment: how many shingles of which documents stand in
#: ``own``, and the facts of the block in one of its rows.
PACKED = "frag long, block long, sizes binary, own binary, shared binary, info binary"
COUNTED = "block long, counts binary, info binary"
FACTS = "doc_id long, n long, h1 long, h2 long, own long"
#: Fragments that a block is cut into at once.
FANOUT = 1024


def set_hashes(g: np.ndarray) -> tuple[np.int64, np.int64]:
    """Two order-free hashes of a set."""
    return np.add.reduce(mix(g)).view(np.int64), np.bitwise_xor.reduce(mix(g + _ODD)).view(np.int64)


def pack_counts(docs: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising places of documents and their counts, in as few bytes each as
    the largest step and the largest count need: with more fragments a
    document has fewer shingles in each, down to one."""
    if not len(docs):
        return b""
    both = np.diff(docs, prepend=-1), counts
    widths = [next(w for w in (1, 2, 4) if int(x.max()) < 256 ** w) for x in both]
    return bytes(widths) + b"".join(x.astype(f"<u{w}").tobytes() for x, w in zip(both, widths))


def unpack_counts(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = packed[:2]
    n = (len(packed) - 2) // (a + b)
    steps = np.frombuffer(packed, f"<u{a}", n, 2)
    return np.cumsum(steps, dtype=np.int64) - 1, np.frombuffer(packed, f"<u{b}", n, 2 + n * a).astype(np.int64)


def _cut(f: np.ndarray, parts: int, *columns: np.ndarray) -> list[list[np.ndarray]]:
    """Each column cut into the rows of part 0, 1, ...; ``f`` has their parts."""
    order = np.argsort(f, kind="stable")
    at = np.searchsorted(f[order], np.arange(1, parts))
    return [np.split(c[order], at) for c in columns]


def _rows(first: int, block: int, own: list, owner: list, shared: list, info: bytes) -> list[tuple]:
    """One row for each fragment with something in it; ``info`` goes with one."""
    out, home = [], block % len(own)
    for f, (o, k, b) in enumerate(zip(own, owner, shared)):
        if len(o) or len(b) or f == home:
            # shingles of a document stand together
            change = np.flatnonzero(np.diff(k, prepend=-1))
            out.append((first + f, block, pack_counts(k[change], np.diff(np.append(change, len(k)))),
                        o.astype("<u4").tobytes(), b.astype("<u4").tobytes(), info if f == home else b""))
    return out


def pack_fragments(ids: np.ndarray, sets: list[np.ndarray], fragments: int) -> pd.DataFrame:
    """A block of up to 65,536 documents cut into fragments.  ``own``: the
    32-bit values of shingles that only one row of the block has, row by row
    (``sizes`` of them); ``shared``: those of the others, once.  ``info``:
    doc_id, size and two hashes of every row.  Blocks are named by it."""
    lengths = np.asarray([len(s) for s in sets], dtype=np.int64)
    info = np.zeros((len(sets), 4), dtype="<i8")
    info[:, 0], info[:, 1] = ids, lengths
    for k, x in enumerate(sets):
        if len(x):
            info[k, 2:] = set_hashes(x)
    g = np.concatenate([*sets, np.zeros(0, np.uint64)])
    order = np.argsort(g, kind="stable").astype(np.uint32)
    s = g[order]
    same = np.concatenate([[False], s[1:] == s[:-1], [False]])
    multi = np.zeros(len(g), dtype=bool)
    multi[order] = same[:-1] | same[1:]
    both = s[~same[:-1] & same[1:]] if len(s) else s  # one of each shared shingle
    del order, s, same
    single, owner = g[~multi], np.repeat(np.arange(len(sets)), lengths)[~multi]
    own, owner = _cut(fragment_of(single, fragments), fragments, single, owner)
    shared, = _cut(fragment_of(both, fragments), fragments, both)
    facts = info.tobytes()
    block = xxhash.xxh3_64_intdigest(facts) >> 1
    return pd.DataFrame(_rows(0, block, own, owner, shared, facts), columns=PACKED_NAMES)


def recut(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """The rows of fragments, each cut into ``parts`` by the 32-bit values."""
    def part(v):
        return (v.astype(np.uint64) * np.uint64(parts) >> _32).astype(np.int64)

    out = []
    for r in pdf.itertuples(index=False):
        own, shared = np.frombuffer(r.own, "<u4"), np.frombuffer(r.shared, "<u4")
        owner = np.repeat(*unpack_counts(r.sizes))
        own, owner = _cut(part(own), parts, own, owner)
        shared, = _cut(part(shared), parts, shared)
        out += [x for x in _rows(r.frag * parts, r.block, own, owner, shared, r.info) if x[3] or x[4] or x[5]]
    return pd.DataFrame(out, columns=PACKED_NAMES)


def count_own(pdf: pd.DataFrame) -> pd.DataFrame:
    """One fragment of all blocks: for each block the documents that have
    shingles which occur nowhere else, and how many."""
    own, shared = (np.frombuffer(b"".join(pdf[c]), "<u4") for c in ("own", "shared"))
    order = np.argsort(own, kind="stable").astype(np.uint32)
    s = own[order]
    same = np.concatenate([[False], s[1:] == s[:-1], [False]])
    alone = np.zeros(len(own), dtype=bool)
    alone[order] = ~(same[:-1] | same[1:])
    del order, s, same
    if len(shared) and len(own):
        shared = np.unique(shared)
        at = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
        alone &= shared[at] != own
    upto = np.concatenate([[0], np.cumsum(alone, dtype=np.uint32)])
    out, start = [], 0
    for r in pdf.itertuples(index=False):
        docs, sizes = unpack_counts(r.sizes)
        ends = start + np.cumsum(sizes)
        counts = np.diff(upto[ends], prepend=upto[start])  # none is above its size
        start = ends[-1] if len(ends) else start
        if counts.any() or r.info:
            out.append((r.block, pack_counts(docs[counts > 0], counts[counts > 0]), r.info))
    return pd.DataFrame(out, columns=COUNTED_NAMES)


def sum_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """The partial counts of a block, summed over its fragments."""
    info = np.frombuffer(next(x for x in pdf["info"] if x), "<i8").reshape(-1, 4)
    own = np.zeros(len(info), dtype=np.int64)
    for docs, counts in map(unpack_counts, pdf["counts"]):
        own[docs] += counts
    return pd.DataFrame(info, columns=["doc_id", "n", "h1", "h2"]).assign(own=own)


PACKED_NAMES, COUNTED_NAMES = ([c.split()[0] for c in x.split(", ")] for x in (PACKED, COUNTED))


def set_facts(blocks: DataFrame, make, fragments: int, block_rows: int = BLOCK_ROWS, fanout: int = FANOUT) -> DataFrame:
    """doc_id, n, h1, h2, own and the number of the rows that ``make`` yields
    from batches of ``blocks`` (doc_ids and sets)."""
    first = min(fragments, fanout)
    parts = -(-fragments // first)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), block_rows):
                yield pack_fragments(*make(pdf.iloc[at:at + block_rows]), first)

    def cut_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 100):
                yield recut(pdf.iloc[at:at + 100], parts)

    packed = map_slices(blocks, pack, PACKED)
    if parts > 1:
        packed = packed.repartition("frag").mapInPandas(cut_on, PACKED)
    counted = packed.groupBy("frag").applyInPandas(count_own, COUNTED)
    texts = counted.groupBy("block").applyInPandas(sum_block, FACTS)
    standing = F.struct("n", "h1", "h2")
    return texts.groupBy("doc_id").agg(F.max_by("own", standing).alias("own"), F.max(standing).alias("s"),
                                       F.count(F.lit(1)).alias("times")).select("doc_id", "own", "s.*", "times")


#: Ids that a segment of the filter is made for, and its longs.  Beyond
#: ``FILTER_IDS`` in all (32 MB) there is no filter.
SEGMENT_IDS, SEGMENT = 1 << 14, 1 << 12
FILTER_IDS = 1 << 24


def among(rows: DataFrame, ids: DataFrame, many: int) -> DataFrame:
    """Those of ``rows`` whose doc_id is one of the ``many`` ids, and some 2
    percent of the others: what is left is joined, and so shuffled, with less
    text.  A Bloom filter of two bits an id, dealt into segments."""
    if many > FILTER_IDS:
        return rows
    segments = many // SEGMENT_IDS + 1

    def places(df: DataFrame) -> DataFrame:
        h = F.xxhash64("doc_id", F.lit("among"))
        return df.withColumns({"_segment": F.pmod(h, F.lit(segments)), **{
            f"_p{k}": F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(64 * SEGMENT)) for k in (1, 2)}})

    def bits(pdf: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(64 * SEGMENT, dtype=np.uint8)
        on[pdf["_p1"]] = on[pdf["_p2"]] = 1
        return pd.DataFrame({"_segment": pdf["_segment"].iloc[:1],
                             "_bits": [np.packbits(on, bitorder="little").view("<i8")]})

    held = places(ids).groupBy("_segment").applyInPandas(bits, "_segment long, _bits array<long>")
    there = [F.expr(f"(shiftrightunsigned(_bits[cast(_p{k} div 64 as int)], cast(_p{k} % 64 as int)) & 1) = 1") for k in (1, 2)]
    found = places(rows).alias("r").join(
        F.broadcast(held.alias("f")), (F.col("r._segment") == F.col("f._segment")) & there[0] & there[1], "left_semi")
    return found.drop("_segment", "_p1", "_p2")


def may_link(percent: int):
    """The shingles shared with others suffice for a link."""
    return (F.col("n") > 0) & (100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))


def signatures(g: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of a set's ranges, for the size class of the set and the one
    below.  Class c holds the sizes from r**c to r**(c+1), r = 100 / percent;
    a pair whose smaller set is in class c differs in at most d shingles."""
    n, r = len(g), 100 / percent
    c = int(np.floor(np.log(n) / np.log(r) + 1e-9))
    spread = (100 - percent) / (100 + percent)
    mixed = np.append(mix(g), np.uint64(0))
    out = []
    for k in (c, c - 1):
        if k < 0:
            continue
        top = r ** (k + 1)
        d = int(spread * top * (1 + r) + 1e-6)
        if d < 1:
            continue  # sets of these sizes link only if they are equal
        b = fragment_of(g, d + 1)
        at = np.searchsorted(b, np.arange(d + 2))
        sums = np.add.reduceat(mixed, at[:-1])
        counts = np.diff(at).astype(np.uint64)
        sums[counts == 0] = 0
        salt = mix(np.arange(d + 1, dtype=np.uint64) + np.asarray([k + 1], np.uint64) * _ODD)
        out.append(mix(sums + salt + counts * _ODD))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


#: Longs of a parity sketch: that of a group's members, and that of a pair.
SKETCH, WIDE = 4, 32


def parity(g: np.ndarray, longs: int = SKETCH) -> np.ndarray:
    """The parity of the number of shingles in each of 64 * longs buckets.
    Two sets differ in at least as many shingles as their sketches in bits."""
    odd = np.bincount((g % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _sketches(sets: DataFrame, longs: int, columns: list[str], keep: list[str]) -> DataFrame:
    """``keep`` of ``sets`` and the longs of their sketches."""
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bits = np.asarray([parity(np.frombuffer(t, "<u8"), longs) for t in pdf["tokens"]], dtype=np.int64)
            yield pdf[keep].assign(**dict(zip(columns, bits.reshape(-1, longs).T)))

    return map_slices(sets, draw, ", ".join(f"{c} long" for c in [*keep, *columns]))


def _within(apart, percent: int):
    """Sets of na and nb shingles that differ in at least ``apart`` may link."""
    both = F.col("na") + F.col("nb")
    return 100 * (both - apart) >= percent * (both + apart)


def likely(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose wide sketches do not exclude a link:
    what is compared by shingles are 256 bytes a set before that."""
    names = [c for c in wide.columns if c != "doc_id"]
    a, b = (wide.select(F.col("doc_id").alias(x), F.struct(*names).alias("s" + x)) for x in "ab")
    apart = sum((F.bit_count(F.col(f"sa.{c}").bitwiseXOR(F.col(f"sb.{c}"))) for c in names), F.lit(0))
    return pairs.join(a, "a").join(b, "b").where(_within(apart, percent)).select("a", "b", "na", "nb")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Every node above has one edge, to a node that is never above."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """doc_id, root for every node of ``edges`` (a > b) that is not its
    component's smallest.  Each step halves paths; edges are written once a
    step."""
    edges = stored(edges.select("a", "b").distinct(), "edges")
    while not _stars(edges):
        edges = stored(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("root"))


def jaccard_components(docs: DataFrame, *, k: int = 3, percent: int = 90, fragment_bytes: int = FRAGMENT_BYTES,
                       block_rows: int = BLOCK_ROWS, fanout: int = FANOUT, part_shingles: int = 512) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    rows = id_text(docs)
    size, many = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    # about one shingle for six characters, four bytes each, and 32 bytes of info for each row
    fragments = int(max(16, (size * 4 // 6 + 32 * many) // fragment_bytes + 1))

    def from_texts(pdf: pd.DataFrame):
        return pdf["doc_id"].to_numpy(np.int64), [shingle_set(t, k) for t in pdf["text"].tolist()]

    facts = stored(set_facts(rows, from_texts, fragments, block_rows, fanout), "facts")
    classes = facts.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("own").alias("own"))
    # written, so that the join with the texts is planned by its real size:
    # the texts are not shuffled for a few representatives
    reps = stored(classes.where(may_link(percent)).select(F.col("rep").alias("doc_id"), "n", "h1", "h2"), "reps")
    chosen, held = reps.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    fragments = int(max(16, (4 * held + 32 * chosen) // fragment_bytes + 1))

    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, k) for t in pdf["text"].tolist()]
            info = np.asarray([[len(s), *set_hashes(s)] for s in sets], dtype=np.int64).reshape(-1, 3)
            out = pd.DataFrame({"doc_id": pdf["doc_id"], "n": info[:, 0],
                                "tokens": [s.astype("<u8").tobytes() for s in sets]})
            # of rows that repeat a doc_id only the one that stands for it
            yield out[(info == pdf[["n", "h1", "h2"]].to_numpy()).all(axis=1)]

    sets = map_slices(among(rows, reps, chosen).join(reps, "doc_id"), to_sets, "doc_id long, n long, tokens binary")
    if not facts.where("times > 1").isEmpty():
        sets = sets.dropDuplicates(["doc_id"])
    sets = stored(sets, "sets")

    def from_sets(pdf: pd.DataFrame):
        return pdf["doc_id"].to_numpy(np.int64), [np.frombuffer(t, "<u8") for t in pdf["tokens"]]

    had = facts.where(may_link(percent)).count()
    while True:
        left = stored(set_facts(sets, from_sets, fragments, block_rows, fanout).where(may_link(percent)).select("doc_id", "own"), "left")
        sets = sets.drop("own").join(left, "doc_id")
        have = left.count()
        if 10 * have >= 9 * had:  # the next round would hardly exclude more
            break
        had = have
    links = candidate_links(stored(sets, "sets"), percent, part_shingles)

    named = facts.join(classes.select("n", "h1", "h2", "rep"), ["n", "h1", "h2"], "left")
    return (named.join(links.select(F.col("doc_id").alias("rep"), "root"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "doc_id").alias("component_id")))


def level(n: int, part_shingles: int) -> int:
    """A set of ``n`` shingles is cut into 2 ** level ranges."""
    return ((n - 1) // part_shingles).bit_length()


def verified(pairs: DataFrame, sets: DataFrame, percent: int, part_shingles: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link.  Both sets of a pair are cut into
    as many fragments as its larger set needs for ``part_shingles`` each;
    partial overlaps are counted by fragment and summed."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, t in zip(pdf["doc_id"].tolist(), pdf["tokens"]):
                g = np.frombuffer(t, "<u8")
                # for every size of the larger set that can link with this one
                for k in range(level(len(g), part_shingles), level(len(g) * 100 // percent, part_shingles) + 1):
                    f = fragment_of(g, 2 ** k)
                    at = np.flatnonzero(np.diff(f, prepend=-1))
                    out += [(doc_id, k, int(f[x]), p.view(np.int64)) for x, p in zip(at, np.split(g, at[1:]))]
            yield pd.DataFrame(out, columns=["doc_id", "level", "frag", "part"])

    used = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "used")
    parts = map_slices(among(sets.select("doc_id", "tokens"), used, used.count()), cut,
                       "doc_id long, level int, frag int, part array<long>")
    a = parts.select(F.col("doc_id").alias("a"), "level", "frag", F.col("part").alias("pa"))
    b = parts.select(F.col("doc_id").alias("b"), "level", "frag", F.col("part").alias("pb"))
    above = F.floor((F.greatest("na", "nb") - 1) / part_shingles).cast("long")
    pairs = pairs.withColumn("level", F.when(above > 0, F.length(F.bin(above))).otherwise(0))
    both = pairs.join(a, ["a", "level"]).join(b, ["b", "level", "frag"])
    overlap = both.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("pa", "pb"))).alias("o"),
                                         F.first("na").alias("na"), F.first("nb").alias("nb"))
    return overlap.where(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def candidate_links(sets: DataFrame, percent: int, part_shingles: int) -> DataFrame:
    """doc_id, root of the components among distinct sets."""
    sketch = [f"s{k}" for k in range(SKETCH)]

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = [signatures(np.frombuffer(t, "<u8"), percent) for t in pdf["tokens"]]
            yield pd.DataFrame({"sig": np.concatenate([*s, np.zeros(0, np.uint64)]).view(np.int64),
                                "doc_id": pdf["doc_id"].repeat([len(x) for x in s]).to_numpy()})

    # a set has many signatures, most of which no other has: only the two ids
    # are dealt by signature, and what is known of a set meets those left
    group = W.partitionBy("sig")
    shared = (map_slices(sets, sign, "sig long, doc_id long")
              .withColumn("many", F.max("doc_id").over(group) > F.min("doc_id").over(group)).where("many")
              .withColumn("nth", F.row_number().over(group.orderBy("doc_id"))).drop("many"))
    about = _sketches(sets, SKETCH, sketch, ["doc_id", "n", "own"])
    wide = stored(_sketches(sets, WIDE, [f"w{k}" for k in range(WIDE)], ["doc_id"]), "wide")
    groups = stored(shared.join(about, "doc_id"), "groups")
    links = groups.sparkSession.createDataFrame([], "a long, b long")
    roots = links.select(F.col("a").alias("doc_id"), F.col("b").alias("root"))
    seen, lo, width = None, 1, 1
    rest = groups.withColumn("root", F.col("doc_id"))
    while not rest.isEmpty():
        first = rest.where(F.col("nth") < lo + width).select(
            "sig", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("own").alias("ob"), F.col("root").alias("rb"),
            F.col("nth").alias("kb"), F.struct(*sketch).alias("sb"))
        other = rest.where(F.col("nth") > lo).select(
            "sig", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("own").alias("oa"),
            F.col("root").alias("ra"), F.col("nth").alias("ka"), F.struct(*sketch).alias("sa"))
        # neither set's own shingles are in the other
        most = F.least(F.col("na") - F.col("oa"), F.col("nb") - F.col("ob"))
        least = F.greatest(F.col("na") + F.col("ob"), F.col("nb") + F.col("oa"))
        apart = sum((F.bit_count(F.col(f"sa.{c}").bitwiseXOR(F.col(f"sb.{c}"))) for c in sketch), F.lit(0))
        fits = ((F.col("ra") != F.col("rb")) & (100 * most >= percent * least)
                & _within(apart, percent))
        pairs = other.join(first, (other["sig"] == first["sig"]) & (F.col("ka") > F.col("kb")) & fits).select(
            "a", "b", "na", "nb").distinct()
        pairs = stored(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), "pairs")
        near = pairs if pairs.isEmpty() else stored(likely(pairs, wide, percent), "likely")
        if not near.isEmpty():
            found = stored(verified(near, sets, percent, part_shingles), "links")
            if not found.isEmpty():
                links = links.unionByName(found)
                roots = components(links)
        pairs = pairs.select("a", "b")
        seen = pairs if seen is None else seen.unionByName(pairs)
        lo, width = lo + width, 4 * width
        # groups that still hold members of different components from here on;
        # components only grow, so the others are done
        at = (rest.where(F.col("nth") >= lo).drop("root").join(roots, "doc_id", "left")
              .withColumn("root", F.coalesce("root", "doc_id")))
        rest = stored(at.withColumn("mixed", F.min("root").over(group) < F.max("root").over(group))
                      .where("mixed").drop("mixed"), "rest")
    return roots


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component, the one with the
    smallest doc_id; all columns kept.  Rows without doc_id stay."""
    found = jaccard_components(docs, **options)
    gone = stored(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")), "gone")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
