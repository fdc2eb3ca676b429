"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles; documents with the same set are
one class from the start.  Every class has ``POSITIONS`` minwise tokens.  A
tree branches the classes by the token at one or two selected positions, so
classes that share it stay together, and branches a node of more than ``LEAF``
classes again at positions of its own.  Small nodes are compared exhaustively
on their minwise tokens.  ``TREES`` independent trees bring the chance that a
pair at the threshold never meets in a small node under one in a million.

What agrees there is only a candidate.  Candidates are grouped into connected
groups, which is a superset of every real group, and each group is resolved on
full shingle sets: one member at a time is compared with the whole group, and
members already known to be connected are not compared with each other, so a
group of copies takes one comparison a member.  A pair is left out only if
both ends are in one component or one of them was compared with the whole
group; the components are exact for the pairs that the trees brought together.

Nothing is capped.  A large node that keeps ``UNSPLIT`` of its parent's classes,
of whose classes so many agree with one, or that is left after ``DEPTH`` levels is a candidate group as a whole, tied to its
smallest member; a candidate group of more than
``GROUP_SHINGLES`` shingles is resolved by a distributed join of its classes on
their rarest shingles instead of in one task.

Defined cases: documents without words are linked with nothing; fewer words
than a shingle count as one shingle; a null doc_id is linked with nothing and
kept; repeated rows are copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, LOWER, by_value, chunks, connected, filter_bits, filter_of, filter_places, gram_hashes, mix, seeded, stored, table, text_or_empty, with_body, word_hashes, word_spans

by_value(__name__)

SHINGLE = 4
PERCENT = 80
POSITIONS = 64
TREES = 12
#: trees that branch at two positions, so that a node has 1.25 branches a class
#: on average, 1 / 0.8
DOUBLE = 3
LEAF = 64
DEPTH = 5
#: share of its parent's classes, or of near copies of one of its classes, from
#: which a large node is a group as a whole
UNSPLIT = 0.7
#: agreeing tokens of 64 that make a candidate; a pair at the threshold has 51
#: on average, with a standard deviation of 3.2
AGREE = 35
GROUP_SHINGLES = 4_000_000
#: bits of a bucket of shingles whose rarity is known in a large group
RARITY_BITS = 21
#: classes of a token compared with as many in one task
TILE = 2048
#: times that the classes of a token in a large group are compared with one of
#: them, at most, before all that are still apart are compared
PIVOTS = 16


def shingle_sets(data: np.ndarray, offs: np.ndarray, rows: int, k: int, lower: bool = True):
    """Sorted distinct shingle hashes of each row, as one list of arrays."""
    if lower:
        data = LOWER[data]
    s, e, row = word_spans(data, offs)
    h = word_hashes(data, s, e)
    grams = gram_hashes(h, k, 7)
    edges = np.searchsorted(row, np.arange(rows + 1))
    none = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(gram_hashes(h[a:b], b - a, 100 + b - a))
        else:
            out.append(none)
    return out


def set_key(values: np.ndarray) -> bytes:
    """128 bits that don't depend on the order of a set."""
    parts = [int(mix(values ^ np.uint64(c)).sum(dtype=np.uint64)) for c in (0x51ED270B7C4A1F1D, 0x2545F4914F6CDD1D)]
    return b"".join(p.to_bytes(8, "big") for p in parts)


_FACTORS = seeded(POSITIONS, 21) | np.uint64(1)
_SHIFTS = seeded(POSITIONS, 22)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise tokens, a row for each non-empty set."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), POSITIONS), np.uint64)
    for i in range(POSITIONS):
        out[:, i] = np.minimum.reduceat((flat ^ _SHIFTS[i]) * _FACTORS[i], at)
    return mix(out)


SIGNED = "doc_id long, body long, n_shingles long, class binary, roots array<long>, sketch binary"


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, body (a hash of the text, which tells rows with one id apart),
    n_shingles, class (key of the shingle set), roots (its node in the first
    level of every tree), sketch (a byte of every minwise token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = np.array([*range(TREES), *range(DOUBLE)], np.uint64)
        for batch, data, offs in chunks(batches, "text"):
            sets = shingle_sets(data, offs, len(batch), shingle)
            full = [i for i, x in enumerate(sets) if len(x)]
            keys, roots, sketches = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                tokens = minwise([sets[i] for i in full])
                nodes = mix(tokens[:, : len(tree)] + tree * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                low = (tokens & np.uint64(255)).astype(np.uint8)
                for j, i in enumerate(full):
                    keys[i], roots[i], sketches[i] = set_key(sets[i]), nodes[j], low[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(roots, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "body", "n_shingles", "class", "roots", "sketch"],
            )

    return with_body(docs).mapInArrow(run, SIGNED)


def agreeing(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the agreeing classes of each node (members:
    class, sketch): one less than the classes of a connected part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_, b_ = [], []
            members = batch.column(0)
            edges = members.offsets.to_pylist()
            flat = members.values
            keys = flat.field("class").to_pylist()
            sketches = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint8).reshape(len(keys), POSITIONS)
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                m = sketches[lo:hi]
                near = (m[:, None] == m[None]).sum(axis=2) >= AGREE
                left = np.ones(hi - lo, bool)
                for root in range(hi - lo):
                    if not left[root]:
                        continue
                    seen = front = near[root] & left
                    while True:
                        more = near[front].any(axis=0) & left & ~seen
                        if not more.any():
                            break
                        seen, front = seen | more, more
                    left &= ~seen
                    left[root] = False
                    for i in np.flatnonzero(seen):
                        if i != root:
                            a_.append(keys[lo + root])
                            b_.append(keys[lo + i])
            yield pa.RecordBatch.from_arrays([pa.array(a_, pa.binary()), pa.array(b_, pa.binary())], names=["a", "b"])

    return nodes.select("members").mapInArrow(run, "a binary, b binary")


def dense_nodes(large: DataFrame, classes: DataFrame) -> DataFrame:
    """node, dense: whether ``UNSPLIT`` of the classes of a node agree with one of
    them, which a hash picks.  Branching would carry every one of such a group of
    near copies through all levels of all trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, one = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, POSITIONS) for k in (1, 2))
            agrees = (own == one).sum(axis=1) >= AGREE
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(agrees.astype(np.float64))], names=["node", "agrees"])

    rows = large.select("node", "class").join(classes.select("class", "sketch"), "class")
    picked = rows.groupBy("node").agg(F.min_by("sketch", F.xxhash64("class", "node")).alias("one"))
    compared_ = rows.join(picked, "node").select("node", "sketch", "one").mapInArrow(run, "node long, agrees double")
    return compared_.groupBy("node").agg((F.avg("agrees") >= UNSPLIT).alias("dense"))


def candidates(classes: DataFrame) -> DataFrame:
    """Candidate edges (a, b) between classes (class, roots, sketch).

    A large node that keeps most of its parent's classes, or most of whose
    classes are near copies of one, isn't split by branching: its classes are a
    candidate group as a whole, each tied to the smallest.  Nothing leaves a
    node, so each class stays findable from all its nodes.
    """
    rows = classes.select(F.explode("roots").alias("node"), "class", F.lit(None).cast("long").alias("before"))
    found = None
    for level in range(1, DEPTH + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("class").alias("least")).where("n > 1")
        shared = stored(rows.join(sizes, "node"), "nodes")
        if level < DEPTH:
            dense = stored(dense_nodes(shared.where(F.col("n") > LEAF), classes), "dense")
            shared = shared.join(dense, "node", "left")
        whole = F.col("dense") | (F.col("n") >= F.lit(UNSPLIT) * F.col("before")) if level < DEPTH else F.lit(True)
        whole = (F.col("n") > LEAF) & F.coalesce(whole, F.lit(False))
        small = shared.where(F.col("n") <= LEAF).join(classes.select("class", "sketch"), "class")
        edges = agreeing(small.groupBy("node").agg(F.collect_list(F.struct("class", "sketch")).alias("members")))
        edges = edges.unionAll(shared.where(whole & (F.col("class") != F.col("least"))).select(F.col("least").alias("a"), F.col("class").alias("b")))
        found = edges if found is None else found.unionAll(edges)
        large = shared.where((F.col("n") > LEAF) & ~whole)
        if level == DEPTH or large.isEmpty():
            return found
        # a position of the node's own, and a second one for every fourth node
        first = F.pmod(F.xxhash64("node", F.lit("first")), F.lit(POSITIONS))
        second = F.when(
            F.pmod(F.xxhash64("node", F.lit("two")), F.lit(4)) == 0,
            F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit("second")), F.lit(POSITIONS - 1)), F.lit(POSITIONS)),
        )
        at = F.explode(F.array_compact(F.array(first, second)))
        rows = (
            large.join(classes.select("class", "sketch"), "class")
            .select("class", "sketch", "node", "n", at.alias("at"))
            .select(F.xxhash64("node", "at", F.expr("substring(sketch, cast(at as int) + 1, 1)")).alias("node"), "class", F.col("n").alias("before"))
        )


def compared(pivot: np.ndarray, values: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets (values by owner) are at least ``percent`` similar."""
    at = np.searchsorted(pivot, values)
    hit = pivot[np.minimum(at, len(pivot) - 1)] == values
    both = np.bincount(owner[hit], minlength=len(sizes))
    return 100 * both >= percent * (len(pivot) + sizes - both)


def resolve(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Component number of each set under the similarity, within one group.

    The rarest value that two similar sets have in common is among the rarest
    of both (all but the share that both must have, and one).  An index of
    these values, by size of the set, gives those that a member can be similar
    to: no more values of either may be rarer than may differ, given both
    sizes.  Only those of other components are compared.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    owner, start = np.repeat(np.arange(n, dtype=np.int32), sizes), np.cumsum(sizes) - sizes
    ids, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    ids, many = ids.astype(np.int32), many.astype(np.int32)
    ids = ids[np.lexsort((ids, many[ids], owner))]
    # members like many others first
    turns = np.argsort(-np.add.reduceat(many[ids], start, dtype=float) / sizes, kind="stable")
    rare = sizes + -sizes * percent // 100 + 1
    inside = np.repeat(start - np.cumsum(rare) + rare, rare) + np.arange(rare.sum())
    width = int(sizes.max()) + 1
    index = ids[inside].astype(np.int64) * width + sizes[owner[inside]]
    order = np.argsort(index, kind="stable")
    inside, index = inside[order], index[order]

    def near(p: int) -> np.ndarray:
        """Members of other components that may be similar to p."""
        size, values = int(sizes[p]), ids[start[p] : start[p] + rare[p]].astype(np.int64)
        left = size - np.arange(len(values))
        most = np.minimum((left * (100 + percent) - percent * size) // percent, width - 1)
        at = np.searchsorted(index, values * width - (-percent * size // 100))
        count = np.maximum(np.searchsorted(index, values * width + most, side="right") - at, 0)
        found = inside[np.repeat(at - np.cumsum(count) + count, count) + np.arange(count.sum())]
        members = owner[found]
        both = np.minimum(np.repeat(left, count), sizes[members] - (found - start[members]))
        return np.unique(members[(label[members] != label[p]) & (both * (100 + percent) >= percent * (size + sizes[members]))])

    label, done = np.arange(n), np.zeros(n, bool)
    while True:
        largest = np.bincount(label).argmax()
        open_ = turns[~done[turns] & (label[turns] != largest)] if done.any() else turns[:1]
        if not len(open_):
            return label
        for p in open_:
            done[p] = True
            others = near(p)
            for at in range(0, len(others), 256):
                some = others[at : at + 256]
                values, of = np.concatenate([sets[x] for x in some]), np.repeat(np.arange(len(some)), sizes[some])
                linked = some[compared(sets[p], values, of, sizes[some], percent)]
                if len(linked):
                    label[np.isin(label, label[linked])] = label[p]


def resolve_groups(groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect each group's components (members: class,
    shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                members = batch.column(0).slice(row, 1).flatten()
                keys = members.field("class").to_pylist()
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in members.field("shingles")]
                label = resolve(sets, percent)
                first = {}
                a_, b_ = [], []
                for key, x in zip(keys, label.tolist(), strict=True):
                    if first.setdefault(x, key) != key:
                        a_.append(first[x])
                        b_.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(a_, pa.binary()), pa.array(b_, pa.binary())], names=["a", "b"])

    return groups.select("members").mapInArrow(run, "a binary, b binary")


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A record batch cut between rows to about ``limit`` bytes of a binary column."""
    ends = np.cumsum([len(x.as_buffer()) for x in batch.column(column)])
    at = 0
    while at < len(batch):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def group_tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each shingle of a group, and the number of shingles of
    each row (class, group, shingles)."""
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
    sizes = np.array([len(x) for x in sets])
    of_group = np.array([int.from_bytes(x.as_py()[:8], "big") for x in batch.column(1)], np.uint64)
    return mix(np.concatenate(sets) ^ np.repeat(of_group, sizes)), sizes


def rarity(members: DataFrame):
    """A broadcast table of ``2**RARITY_BITS`` bytes: how often the shingles of a
    bucket occur in their groups, in steps of an eighth of an octave.

    It only serves to put rare shingles first; any order of shingles gives the
    same links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for part in slices(batch, 2):
                bucket, n = np.unique(group_tokens(part)[0] >> np.uint64(64 - RARITY_BITS), return_counts=True)
                total[bucket.astype(np.int64)] += n
        bucket = np.flatnonzero(total)
        for at in range(0, len(bucket), 1 << 16):
            some = bucket[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counted = members.select("class", "group", "shingles").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = counted.where("n > 1").select("bucket", F.least(F.floor(8 * F.log2("n")), F.lit(255)).cast("short").alias("step")).toArrow()
    out = np.zeros(1 << RARITY_BITS, np.uint8)
    out[got.column("bucket").to_numpy()] = got.column("step").to_numpy()
    return members.sparkSession.sparkContext.broadcast(out)


def prefixes(members: DataFrame, percent: int) -> DataFrame:
    """token, class, size, place: of the shingles of each class, rarest first, all
    that can be the first that it has in common with a similar class.

    What comes before ``place`` isn't common, so with ``both`` common shingles
    ``place <= size - both``, and ``both`` is at least ``percent`` of the size."""
    steps = rarity(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                token, sizes = group_tokens(part)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((token, steps.value[(token >> np.uint64(64 - RARITY_BITS)).astype(np.int64)], owner))
                place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = place <= (sizes + -sizes * percent // 100)[owner]
                owner = owner[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token[order][first].view(np.int64)),
                        part.column(0).take(pa.array(owner)),
                        pa.array(sizes[owner].astype(np.int32)),
                        pa.array(place[first].astype(np.int32)),
                    ],
                    names=["token", "class", "size", "place"],
                )

    return members.select("class", "group", "shingles").mapInArrow(run, "token long, class binary, size int, place int")


def central_pairs(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b), with other labels, of each class and one class of the same
    token and about its size: the one that has the fewest rarer shingles, any
    one in later turns."""
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(max(100 / percent, 1.01)))
    rows = rows.withColumn("band", band)
    first = F.struct(F.xxhash64("class", F.lit(turn)).alias("nth") if turn else F.col("place").alias("nth"), "place", "size", "class", "label")
    one = rows.groupBy("token", "band").agg(F.min(first).alias("one"), F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    both = F.least(F.col("size") - F.col("place"), F.col("one.size") - F.col("one.place"))
    pairs = rows.join(one.select("token", "band", "one"), ["token", "band"]).where(F.col("label") != F.col("one.label"))
    pairs = pairs.where(both * (100 + percent) >= percent * (F.col("size") + F.col("one.size")))
    return pairs.select(F.col("one.class").alias("a"), F.col("class").alias("b")).distinct()


def open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes with other labels that a token of both doesn't
    rule out.  A token of many classes is dealt out in pairs of tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles = batch.column(1).to_pylist()
            for row, (x, y) in enumerate(tiles):
                members = batch.column(0).slice(row, 1).flatten()
                keys = members.field("class")
                size, place, tile = (members.field(c).to_numpy() for c in ("size", "place", "tile"))
                label = members.field("label").dictionary_encode().indices.to_numpy()
                left, right = np.flatnonzero(tile == x), np.flatnonzero(tile == y)
                rest = size - place
                for lo in range(0, len(left), 256):
                    i = left[lo : lo + 256, None]
                    near = (label[i] != label[right]) & (np.minimum(rest[i], rest[right]).astype(np.int64) * (100 + percent) >= percent * (size[i].astype(np.int64) + size[right]))
                    if x == y:
                        near &= i < right
                    p, q = np.nonzero(near)
                    if len(p):
                        a, b = keys.take(pa.array(left[lo + p])), keys.take(pa.array(right[q]))
                        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    sizes = rows.groupBy("token").agg(F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    tiles = F.ceil(F.col("n") / TILE)
    rows = rows.join(sizes.select("token", "n"), "token").withColumn("tiles", tiles)
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    rows = rows.select("token", "class", "size", "place", "label", "tile", other)
    pair = F.struct(F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"))
    blocks = rows.groupBy("token", pair.alias("pair")).agg(F.collect_list(F.struct("class", "size", "place", "label", "tile")).alias("members"))
    blocks = blocks.select("members", F.array("pair.x", "pair.y").alias("pair")).where(F.size("members") > 1)
    found = blocks.mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sets = [members.select(F.col("class").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab"]
    return pairs.join(sets[0], "a").join(sets[1], "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a binary, b binary")


def resolve_large(members: DataFrame, percent: int) -> DataFrame:
    """As ``resolve``, for groups (class, group, shingles) that no single task
    should hold.

    Similar classes have a token of their ``prefixes`` in common.  First each
    class is compared with one class of each of its tokens, which connects most
    of a group of near copies, again for as long as many classes get a link;
    then what remains in different components of a token is compared."""
    rows = stored(prefixes(members, percent), "prefixes")
    least = members.count() // 4
    links = None
    for turn in range(PIVOTS):
        found = stored(similar(stored(central_pairs(labelled(rows, links), percent, turn), "central"), members, percent), "links")
        links = found if links is None else links.unionAll(found)
        if found.select("b").distinct().count() <= least:
            break
    rest = stored(open_pairs(labelled(rows, links), percent), "open")
    return links.unionAll(stored(similar(rest, members, percent), "links"))


def labelled(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """``rows`` with the label of each class: that of its component of the links,
    or the class."""
    if links is None:
        return rows.withColumn("label", F.col("class"))
    joined = connected(links).select(F.col("id").alias("class"), F.col("label").alias("_label"))
    return rows.join(joined, "class", "left").withColumn("label", F.coalesce("_label", "class")).drop("_label")


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """class, group, shingles (sorted 64-bit hashes) of the wanted classes
    (doc_id, class, group), from the text of one document of each.

    Texts stay where they are: a Bloom filter of the wanted ids goes to the
    documents, and the sets made there join the wanted classes."""
    key = F.xxhash64("doc_id")
    ids = filter_of(wanted.select(key.alias("value")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits(ids.value)

        def passing():
            for batch in batches:
                high, low = filter_places(batch.column(0).to_numpy())
                yield batch.filter(pa.array(bits[high] & bits[low]))

        for batch, data, offs in chunks(passing(), "text"):
            sets = [x for x in shingle_sets(data, offs, len(batch), shingle) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["class", "shingles"]
            )

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where("doc_id is not null")
    sets = text.select(key.alias("key"), "text").mapInArrow(run, "class binary, shingles binary")
    return sets.join(wanted.select("class", "group"), "class").select("class", "group", "shingles")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, body, n_shingles, class, component_id, kept, one row a document."""
    signs = stored(signed(docs, shingle), "signed")
    classes = stored(
        signs.where("class is not null and doc_id is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("roots").alias("roots"), F.first("sketch").alias("sketch")),
        "classes",
    )
    groups = stored(connected(candidates(classes)).select(F.col("id").alias("class"), F.col("label").alias("group")), "groups")
    sizes = groups.join(classes.select("class", "doc_id", "n_shingles"), "class")
    wide = sizes.groupBy("group").agg(F.sum("n_shingles").alias("all"))
    wanted = stored(sizes.join(wide, "group").select("doc_id", "class", "group", (F.col("all") > GROUP_SHINGLES).alias("large")), "wanted")
    # one row a class, also where a doc_id occurs with the same text twice
    sets = full_sets(docs, wanted.where(~F.col("large")).select("doc_id", "class", "group"), shingle)
    small = sets.groupBy("group").agg(F.collect_set(F.struct("class", "shingles")).alias("members"))
    # links run from one member of a component to each other one
    named = stored(resolve_groups(small, percent).select(F.col("b").alias("id"), F.col("a").alias("label")), "links")
    named = named.unionAll(named.select(F.col("label").alias("id"), "label").distinct())
    if not wanted.where("large").isEmpty():
        members = stored(full_sets(docs, wanted.where("large").select("doc_id", "class", "group"), shingle).dropDuplicates(["class"]), "members")
        named = named.unionAll(connected(resolve_large(members, percent)))
    ids = named.join(classes.select(F.col("class").alias("id"), "doc_id"), "id")
    component = ids.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = ids.join(component, "label").select(F.col("id").alias("class"), "component_id")
    of_class = classes.select("class", "doc_id").join(named, "class", "left").select("class", F.coalesce("component_id", "doc_id").alias("_component"))
    out = signs.select("doc_id", "body", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "body", "n_shingles", "class", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def op10_chosen_path_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
