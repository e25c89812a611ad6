"""Near-duplicate documents by chosen-path set similarity join.

Texts become sets of distinct word shingles.  Equal sets form a class, so copies
count once.  Each tree branches the classes by a chosen coordinate of their
minwise signature: classes with equal selected tokens share a child node.  A
node of at most ``LEAF`` classes is compared exhaustively on full sets.  In the
first tree a larger one branches again, up to ``DEPTH`` levels.  Independent trees
repeat the root split: a pair of similarity 0.8 shares that of one tree with
probability 0.8, and of none of ``TREES`` with 0.2 ** TREES.

What stays large after ``DEPTH`` levels is a group whose members resemble one
another.  It is dealt into blocks of bounded size, and every block is compared
exhaustively together with the same ``PIVOTS`` members: the most central ones of
the node, by the agreement of their sketches with the consensus of a block.
Members that differ from the group in ways of their own are nearest to its
centre, so the pivots tie the blocks together.  No group meets in one task.  The
first tree runs alone, and the components it finds drop every node that is
already whole.  After the other trees, classes in many large root nodes are dealt
into the blocks of one of those nodes, once.

A pair that shares large root nodes only is not lost, because the remainder is
exact: the members of all root nodes above ``LEAF`` that are not
yet one component enter a prefix-filtered join.  A pair of the wanted similarity shares one at least
of the rarest shingles of either set (rarest in this remainder, so a passage of
the whole group comes last).  The documents of a rare shingle are one group; those
of a frequent one are compared in tiles of bounded size, every member outside the
largest component with all others.

Inside a group, two-bit sketches of 256 minwise values first leave out members
that no member of another component comes near (a pair of similarity 0.8 falls
under the cut with a probability of about one in a billion).  A comparison walks the links of a bounded group breadth first and emits only
links that reach a new member: components are complete, pairs are not listed.

Defined results: null and empty texts have no shingles, link with nothing and
stay; rows without an id are grouped like others and show a null id; rows that
share an id are one document (linked); an empty table gives no rows; other
columns are not read.  Shingles are counted by 64-bit hashes and compared by 40
bits of them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm import words as W
from eventrollup.llm.common import discard, read_input, ship, slices, store, vacate
from eventrollup.llm.components import components

SHINGLE = 4
PERCENT = 80
TREES = 10
DEPTH = 4
LEAF = 64
FILTER_BITS = 26              # 8 MB of bits
PIVOTS = 16
# Equal values, of LONG coordinates cut to two bits, below which two members of a
# group are not compared on full sets: six standard deviations under the mean
# of a pair of similarity 0.8.
SKETCH_SIGMAS = 6
COORDINATES = 32
TILE = 256                    # members on either side of a tile of a frequent shingle
LEVEL_BITS = 22               # 4 MB of shingle frequencies
LONG = 256                    # coordinates of a sketch, which also ranks the members of a large node

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(33))
_ODD = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * _U(2) + _U(1)
_LONG = _RNG.integers(0, 2**63, LONG, dtype=np.uint64) * _U(2) + _U(1)
_SALT = _RNG.integers(0, 2**63, 8, dtype=np.uint64) * _U(2) + _U(1)

SIGNED = "doc_id bigint, n_shingles bigint, content binary, sig binary"


def _document_sets(batches: Iterator[pa.RecordBatch], k: int):
    vacate()
    for batch in slices(batches):
        data, offsets = W.text_bytes(batch.column(1))
        starts, ends, first = W.word_spans(data, offsets, W.NOT_SPACE)
        hashes, offsets = W.shingles(W.word_hashes(data, starts, ends), first, k)
        yield batch.column(0), hashes, offsets


def _signer(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, offsets in _document_sets(batches, k):
            n = np.diff(offsets)
            some = np.flatnonzero(n > 0)
            content = np.zeros((len(n), 2), dtype="<u8")
            sig = np.zeros((len(n), COORDINATES), dtype="<u4")
            if len(some):
                at = offsets[:-1][some]
                content[some, 0] = np.add.reduceat(W.mix(hashes), at)
                content[some, 1] = np.add.reduceat(W.mix(hashes ^ _SALT[0]), at)
                for i, odd in enumerate(_ODD):
                    # The low half of the least value: its high half is small by choice.
                    sig[some, i] = np.minimum.reduceat(hashes * odd, at) & _U(0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(n, pa.int64()),
                pa.array([x.tobytes() if m else None for x, m in zip(content, n, strict=True)], pa.binary()),
                pa.array([x.tobytes() if m else None for x, m in zip(sig, n, strict=True)], pa.binary())],
                names=["doc_id", "n_shingles", "content", "sig"])
    return run


def _pack(hashes: np.ndarray) -> bytes:
    """The upper 40 bits of each hash."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:]).tobytes()


def _unpack(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(body, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _sketch(long: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, four to a byte."""
    two = (long & np.uint32(3)).astype(np.uint8).reshape(len(long), LONG // 4, 4)
    return two[:, :, 0] | (two[:, :, 1] << 2) | (two[:, :, 2] << 4) | (two[:, :, 3] << 6)


def _two_bits(sketches: list[bytes]) -> np.ndarray:
    """One row per sketch, one column per coordinate."""
    packed = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(sketches), LONG // 4)
    return np.concatenate([(packed >> s) & 3 for s in (0, 2, 4, 6)], axis=1)


def _near(percent: int):
    """Rows (grp, cls, component, sketch) sorted by grp -> those with a member of
    another component that may be similar enough."""
    p = percent / 100 + (1 - percent / 100) / 4
    least = int(LONG * p - SKETCH_SIGMAS * (LONG * p * (1 - p)) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("grp", pa.int64()), ("cls", pa.int64())])
        group, rows = None, []

        def done() -> pa.RecordBatch:
            two = _two_bits([x for _, _, x in rows])
            label = np.array([c for _, c, _ in rows])
            keep = [i for i in range(len(rows))
                    if (((two == two[i]).sum(axis=1) >= least) & (label != label[i])).any()]
            return pa.RecordBatch.from_arrays(
                [pa.array([group] * len(keep), pa.int64()), pa.array([rows[i][0] for i in keep], pa.int64())], schema=schema)

        for batch in batches:
            for g, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if g != group:
                    if len(rows) > 1:
                        yield done()
                    group, rows = g, []
                rows.append(row)
        if len(rows) > 1:
            yield done()
    return run


def _places(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids.view(np.uint64)) >> _U(64 - FILTER_BITS)).astype(np.int64)


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted ids -> non-zero words of the bit filter."""
    for batch in batches:
        at = np.unique(_places(batch.column(0).to_numpy()))
        if len(at):
            word, first = np.unique(at >> 6, return_index=True)
            mask = np.bitwise_or.reduceat(_U(1) << (at & 63).astype(np.uint64), first)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], names=["word", "mask"])


def _bit_filter(wanted: DataFrame) -> np.ndarray:
    """Bit filter of the wanted ids: of fixed size, whatever their number."""
    words = wanted.select("cls").mapInArrow(_filter_words, "word bigint, mask bigint") \
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return bits


def _passing(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = _places(batch.column(0).to_numpy())
        keep = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & _U(1)
        yield batch.filter(pa.array(keep == 1))


def _of_passing(run, bits: np.ndarray):
    """``run`` over the batches that pass, in the same worker process: two steps of
    one stage would be two processes per core."""
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(_passing(batches, bits))
    return both


def _sets(k: int, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, offsets in _document_sets(_passing(batches, bits), k):
            some = np.flatnonzero(np.diff(offsets))
            long = np.zeros((len(some), LONG), dtype="<u4")
            if len(some):
                for i, odd in enumerate(_LONG):
                    long[:, i] = np.minimum.reduceat(hashes * odd, offsets[:-1][some]) >> _U(32)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(some)),
                pa.array([_pack(hashes[offsets[i]:offsets[i + 1]]) for i in some], pa.binary()),
                pa.array([x.tobytes() for x in _sketch(long)], pa.binary())],
                names=["cls", "set", "sketch"])
    return run


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (W.mix(tokens) >> _U(64 - LEVEL_BITS)).astype(np.int64)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cls, set) -> shingles and the number of sets that hold them, summed per slice."""
    for batch in slices(batches, "set"):
        names, n = np.unique(np.concatenate([_unpack(x) for x in batch.column(1).to_pylist()]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n, pa.int64())], names=["token", "n"])


def _leveled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted shingles -> buckets and quarter powers of two of the counts."""
    for batch in batches:
        level = np.minimum(4 * np.log2(batch.column(1).to_numpy()), 127).astype(np.int8)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_bucket(batch.column(0).to_numpy().view(np.uint64)).astype(np.int32)), pa.array(level)],
            names=["bucket", "level"])


def _levels(sets: DataFrame, bits: np.ndarray) -> np.ndarray:
    """How frequent the commonest shingle of every bucket is among the sets that pass
    the filter, 0 where none is in two.  Of fixed size; buckets that shingles share only make the order of
    the shingles worse, and any order gives the same links."""
    often = sets.mapInArrow(_of_passing(_tokens, bits), "token bigint, n bigint") \
        .groupBy("token").agg(F.sum("n").alias("n")).where("n > 1")
    rows = often.mapInArrow(_leveled, "bucket int, level tinyint").groupBy("bucket").agg(F.max("level").alias("level")).toArrow()
    out = np.zeros(1 << LEVEL_BITS, dtype=np.int8)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def _prefixes(percent: int, levels: np.ndarray):
    """Rows (cls, set) -> the rarest shingles of each set, one of which any set of
    the wanted similarity shares; those of a single set are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "set"):
            tokens, n = [], []
            for body in batch.column(1).to_pylist():
                own = _unpack(body)
                level = levels[_bucket(own)]
                first = np.lexsort((own, level))[:len(own) + 1 - -(-percent * len(own) // 100)]
                tokens.append(own[first[level[first] > 0]])
                n.append(len(tokens[-1]))
            at = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), batch.column(0).take(at)], names=["token", "cls"])
    return run


def _child(node: np.ndarray, coordinate: np.ndarray, sig: np.ndarray) -> np.ndarray:
    value = sig[np.arange(len(sig)), coordinate].astype(np.uint64)
    return W.mix(W.mix(node + (coordinate.astype(np.uint64) + _U(1)) * _SALT[1]) ^ value)


def _roots(trees: range):
    """One root split per tree, on a coordinate of its own, and a second one in
    every fourth tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u4").reshape(-1, COORDINATES)
            for tree in trees:
                for c in [tree, tree + TREES] if tree % 4 == 3 else [tree]:
                    node = _child(np.full(len(sig), tree, dtype=np.uint64) * _SALT[2], np.full(len(sig), c % COORDINATES), sig)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node.view(np.int64)), batch.column(0)], names=["node", "cls"])
    return run


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, cls, sig) -> the child nodes, on a coordinate drawn per node."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column(0).to_numpy().view(np.uint64)
        sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<u4").reshape(-1, COORDINATES)
        drawn = (W.mix(node ^ _SALT[3]) % _U(COORDINATES)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_child(node, drawn, sig).view(np.int64)), batch.column(1)], names=["node", "cls"])


def _consensus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The commonest value of every coordinate among the sketches of a node."""
    for batch in batches:
        out = []
        for sketches in batch.column(1).to_pylist():
            two = _two_bits(sketches)
            often = np.stack([(two == value).sum(axis=0) for value in range(4)])
            out.append(often.argmax(axis=0).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "centre"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many coordinates of a member equal the consensus of its node."""
    for batch in batches:
        if not batch.num_rows:
            continue
        centre = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, LONG)
        score = (_two_bits(batch.column(2).to_pylist()) == centre).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(score.astype(np.int32))], names=["node", "cls", "score"])


def _linked(names: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of a bounded group, breadth first: each joins a new member."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat, offsets = np.concatenate(sets), np.cumsum(size) - size
    values, flat = np.unique(flat, return_inverse=True)
    waiting = np.ones(len(sets), dtype=bool)
    links = []
    for root in range(len(sets)):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            x = queue.pop()
            mark = np.zeros(len(values), dtype=np.int64)
            mark[flat[offsets[x]:offsets[x] + size[x]]] = 1
            both = np.add.reduceat(mark[flat], offsets)
            new = np.flatnonzero(waiting & (100 * both >= percent * (size + size[x] - both)))
            waiting[new] = False
            queue += new.tolist()
            links += [(names[x], names[i]) for i in new]
    return links


def _comparer(percent: int):
    """Rows (grp, cls, set) sorted by grp -> links (a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, sets = None, [], []

        def done():
            links = _linked(names, sets, percent) if len(names) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()),
                                               pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            for g, c, s in zip(*(batch.column(i) for i in range(3)), strict=True):
                if g.as_py() != group:
                    if len(names) > 1:
                        yield done()
                    group, names, sets = g.as_py(), [], []
                names.append(c.as_py())
                sets.append(_unpack(s.as_py()))
        yield done()
    return run


class _Join:
    """The chosen-path join over the stored classes(cls, sig) and documents."""

    def __init__(self, docs: DataFrame, classes: DataFrame, k: int, percent: int, repeats: bool):
        self.docs, self.classes, self.k, self.percent, self.repeats = docs, classes, k, percent, repeats
        self.sets: DataFrame | None = None

    def branch(self, trees: range, depth: int, known: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(leaves, large, wide) as rows (node, cls): nodes with two classes at least
        that are not yet one component; large ones exceed ``LEAF`` after ``depth``
        levels, wide ones are the root nodes that do."""
        rows = store(self.classes.select("cls", "sig").mapInArrow(_roots(trees), "node bigint, cls bigint"), "path-rows")
        leaves = None
        for level in range(1, depth + 1):
            if known is None:
                labelled = rows.withColumn("component", F.col("cls"))
            else:
                labelled = rows.join(known.withColumnRenamed("node", "cls"), "cls", "left") \
                    .withColumn("component", F.coalesce("component", "cls"))
            sizes = store(labelled.groupBy("node").agg(
                F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
                .where("n > 1 and x <> y").select("node", "n"), "path-sizes")
            live = store(rows.join(sizes, "node").select("node", "cls", "n"), "path-live")
            discard(rows)
            small = live.where(F.col("n") <= LEAF).select("node", "cls")
            leaves = small if leaves is None else leaves.unionByName(small)
            large = live.where(F.col("n") > LEAF).select("node", "cls")
            wide = large if level == 1 else wide
            if level == depth or sizes.where(F.col("n") > LEAF).isEmpty():
                break
            # Only the signatures of large nodes are shuffled to the join.
            bits = _bit_filter(large)
            sigs = self.classes.select("cls", "sig").mapInArrow(functools.partial(_passing, bits=bits), "cls bigint, sig binary")
            rows = store(large.join(sigs, "cls").select("node", "cls", "sig")
                         .mapInArrow(_branch, "node bigint, cls bigint"), "path-rows")
        # The same members under several nodes are compared once.
        members = leaves.groupBy("node").agg(F.array_sort(F.collect_list("cls")).alias("members"))
        once = members.select(F.xxhash64("members").alias("grp"), "members").dropDuplicates(["grp", "members"])
        groups = once.select(F.col("grp").alias("node"), F.explode("members").alias("cls"))
        return store(groups, "path-leaves"), large, wide

    def blocks(self, large: DataFrame) -> DataFrame:
        """Large nodes dealt into blocks of about ``LEAF`` members with shared pivots."""
        per = store(large.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("parts")), "path-parts")
        dealt = store(large.join(per, "node").select("node", "cls", F.pmod(F.xxhash64("cls"), F.col("parts")).alias("part"))
                      .join(self.among(large, "cls bigint, sketch binary"), "cls"), "path-dealt")
        # One block is a random sample of its node, of bounded size.
        centre = dealt.where("part = 0").groupBy("node").agg(F.collect_list("sketch").alias("sketches")) \
            .mapInArrow(_consensus, "node bigint, centre binary")
        scored = dealt.join(store(centre, "path-centre"), "node") \
            .select("node", "cls", "sketch", "centre").mapInArrow(_agreement, "node bigint, cls bigint, score int")
        best = scored.groupBy("node", F.pmod(F.xxhash64("cls", F.lit(3)), F.lit(PIVOTS)).alias("lot")) \
            .agg(F.max(F.struct("score", "cls"))["cls"].alias("cls"))
        spread = store(best.select("node", "cls"), "path-pivots").join(per, "node") \
            .select("node", "cls", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
        return store(dealt.select("node", "cls", "part").unionByName(spread).distinct(), "path-blocks")

    def among(self, wanted: DataFrame, columns: str) -> DataFrame:
        """Columns of the sets whose class passes a bit filter of the wanted ones, so
        that few others are shuffled to the join that follows (which is exact)."""
        bits = _bit_filter(wanted.select("cls").distinct())
        names = [c.split()[0] for c in columns.split(", ")]
        return self.sets.select(*names).mapInArrow(lambda batches: _passing(batches, bits), columns)

    def compare(self, groups: DataFrame, known: DataFrame | None) -> DataFrame:
        """groups(grp, cls) -> stored links.  Sketches first leave out the members
        that no member of another component comes near; the rest bring their sets."""
        component = F.col("cls").alias("component")
        if known is not None:
            groups = groups.join(known.withColumnRenamed("node", "cls"), "cls", "left")
            component = F.coalesce("component", "cls").alias("component")
        near = groups.select("grp", "cls", component).join(self.among(groups, "cls bigint, sketch binary"), "cls") \
            .select("grp", "cls", "component", "sketch").repartition("grp").sortWithinPartitions("grp") \
            .mapInArrow(_near(self.percent), "grp bigint, cls bigint")
        groups = store(near, "path-near")
        return store(groups.join(self.among(groups, "cls bigint, set binary"), "cls").select("grp", "cls", "set")
                     .repartition("grp").sortWithinPartitions("grp")
                     .mapInArrow(_comparer(self.percent), "a bigint, b bigint"), "links")

    def gather(self, wide: DataFrame, known: DataFrame) -> DataFrame:
        """Stored links of the classes with many wide root nodes, each dealt into the
        blocks of one of them: most members of a large group join its component here,
        in rows that grow with the group.  It only saves work in the remainder."""
        picked = wide.groupBy("cls").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("roots")) \
            .where(F.col("roots") >= TREES // 2).select("node", "cls")
        blocks = self.blocks(store(picked, "gather-picked"))
        return self.compare(blocks.select(F.xxhash64("node", "part").alias("grp"), "cls"), known)

    def remainder(self, wide: DataFrame, known: DataFrame) -> DataFrame:
        """Stored links of the members of large root nodes that are not yet one component."""
        labelled = store(wide.join(known.withColumnRenamed("node", "cls"), "cls", "left")
                         .select("node", "cls", F.coalesce("component", "cls").alias("component")), "rest-labelled")
        apart = labelled.groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        members = store(labelled.join(apart.select("node"), "node", "left_semi").select("cls").distinct(), "rest-members")
        # The sets stay where they are stored; the few others that the filter lets
        # through are compared like members.
        bits, sets = _bit_filter(members), self.sets.select("cls", "set")
        rows = store(sets.mapInArrow(_of_passing(_prefixes(self.percent, _levels(sets, bits)), bits), "token bigint, cls bigint")
                     .join(known.withColumnRenamed("node", "cls"), "cls", "left")
                     .select("token", "cls", F.coalesce("component", "cls").alias("component")), "rest-prefixes")
        sizes = rows.groupBy("token").agg(
            F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"),
            F.expr("bit_xor(xxhash64(cls))").alias("who")).where("n > 1 and x <> y")
        # Shingles of the same members are one.
        sizes = store(sizes.groupBy("n", "who").agg(F.min("token").alias("token")).select("token", "n"), "rest-sizes")
        rows = store(rows.join(sizes, "token"), "rest-rows")
        often = rows.where(F.col("n") > LEAF)
        groups = rows.where(F.col("n") <= LEAF).select(F.col("token").alias("grp"), "cls")
        main = often.groupBy("token", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("token").agg(
            F.max_by("component", F.struct("m", "component")).alias("main"),
            F.ceil(F.sum("m") / TILE).alias("parts"), F.ceil((F.sum("m") - F.max("m")) / TILE).alias("lots"))
        dealt = store(often.join(main, "token").select(
            "token", "cls", "parts", "lots", (F.col("component") != F.col("main")).alias("stray"),
            F.pmod(F.xxhash64("cls"), F.col("parts")).alias("part"),
            F.pmod(F.xxhash64("cls", F.lit(5)), F.col("lots")).alias("lot")), "rest-dealt")

        def every(n):
            return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

        tiles = dealt.select("token", "cls", "part", every("lots").alias("lot")).unionByName(
            dealt.where("stray").select("token", "cls", every("parts").alias("part"), "lot")).distinct()
        return self.compare(groups.unionByName(tiles.select(F.xxhash64("token", "part", "lot").alias("grp"), "cls")), known)

    def fetch(self, wanted: DataFrame) -> DataFrame:
        """Full sets of the wanted classes, from the texts of their first documents."""
        wanted = store(wanted.select("cls").distinct(), "wanted")
        # The texts stay where they are read: a bit filter of fixed size leaves out
        # most others.  Those that it lets through are sets like any other; every
        # join on the sets is exact.
        sets = self.docs.select("doc_id", "text").mapInArrow(
            _sets(self.k, _bit_filter(wanted)), "cls bigint, set binary, sketch binary")
        if self.repeats:
            # Repeated rows of one document are one set.
            sets = sets.withColumn("tie", F.xxhash64("set")).dropDuplicates(["cls", "tie"]).drop("tie")
        return store(sets, "sets")

    def run(self, links: DataFrame) -> DataFrame:
        """Components (node, component) of the classes, with some links given."""
        leaves, large, first = self.branch(range(0, 1), DEPTH, None)
        early = self.sets = self.fetch(leaves.select("cls").unionByName(first.select("cls")))
        links = links.unionByName(self.compare(self._groups(leaves, self.blocks(large)), None))
        labels = components(links)
        # The wide nodes of the other trees are left to the remainder.
        leaves, _, wide = self.branch(range(1, TREES), 1, labels)
        discard(self.classes)
        more = leaves.select("cls").unionByName(wide.select("cls")).distinct()
        late = self.fetch(more.join(self.sets.select("cls"), "cls", "left_anti"))
        self.sets = early.unionByName(late)
        links = links.unionByName(self.compare(leaves.withColumnRenamed("node", "grp"), labels))
        labels = components(links)
        wide = first.unionByName(wide)
        links = links.unionByName(self.gather(wide, labels))
        labels = components(links)
        more = self.remainder(wide, labels)
        discard(early, late)
        return labels if more.isEmpty() else components(links.unionByName(more))

    @staticmethod
    def _groups(leaves: DataFrame, blocks: DataFrame) -> DataFrame:
        return leaves.select(F.col("node").alias("grp"), "cls").unionByName(
            blocks.select(F.xxhash64("node", "part").alias("grp"), "cls"))


def _surrogates(docs: DataFrame) -> DataFrame | None:
    """(hash, id) for the texts of rows without an id, None if there are none.
    The ids are drawn until no document has one of them: any long is a real id."""
    nameless = docs.where(F.col("doc_id").isNull()).select(F.xxhash64("text").alias("hash")).distinct()
    if nameless.isEmpty():
        return None
    taken = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    salt = 0
    while True:
        made = store(nameless.select("hash", F.xxhash64("hash", F.lit(salt)).alias("id")), "surrogates")
        again = made.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
        if made.select("id").join(taken, made["id"] == taken["doc_id"], "left_semi").unionByName(again).isEmpty():
            return made
        salt += 1


def _identified(docs: DataFrame, made: DataFrame | None) -> DataFrame:
    """docs(doc_id, text, ..) -> id, real, text, ..: rows without a doc_id get the
    id of their text."""
    named = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), F.lit(True).alias("real"), "*")
    if made is None:
        return docs.select(F.col("doc_id").alias("id"), F.lit(True).alias("real"), "*")
    other = docs.where(F.col("doc_id").isNull()).withColumn("hash", F.xxhash64("text")) \
        .join(made, "hash").select("id", F.lit(False).alias("real"), *docs.columns)
    return named.unionByName(other)


def _decide(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """docs(doc_id, text) without null ids -> doc_id, n_shingles, component per row."""
    ship(docs.sparkSession)
    signed = store(docs.mapInArrow(_signer(k), SIGNED), "signatures")
    classes = store(signed.where(F.col("n_shingles") > 0).groupBy("content").agg(
        F.min("doc_id").alias("cls"), F.first("sig").alias("sig")), "classes")
    rows = store(signed.select("doc_id", "n_shingles", "content")
                 .join(classes.select("content", "cls"), "content", "left")
                 .select("doc_id", "n_shingles", "cls"), "document-classes")
    discard(signed)
    # Rows that share an id are one document: link the classes they fall into.
    ids = rows.groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi")
    same = rows.join(ids, "doc_id").where("cls <> lo").select(F.col("cls").alias("a"), F.col("lo").alias("b"))
    repeats = not rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    labels = _Join(docs, classes, k, percent, repeats).run(store(same.distinct(), "links"))
    return rows.join(labels.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "cls", "doc_id").alias("component"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, kept, one row per document row."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = _surrogates(slim)
    out = _decide(_identified(slim, made).select(F.col("id").alias("doc_id"), "text"), k, percent)
    if made is None:
        return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                          (F.col("doc_id") == F.col("component")).alias("kept"))
    # Only real ids are shown, and the smallest real one names a component.
    marked = store(out.join(made.select(F.col("id").alias("doc_id"), F.lit(True).alias("drawn")), "doc_id", "left")
                   .withColumn("real", F.when(F.col("drawn").isNull(), F.col("doc_id"))), "named")
    lowest = marked.groupBy("component").agg(F.min("real").alias("component_id"))
    return marked.join(lowest, "component").select(
        F.col("real").alias("doc_id"), "n_shingles", "component_id",
        F.coalesce(F.col("real") == F.col("component_id"),
                   F.col("component_id").isNull() & (F.col("doc_id") == F.col("component"))).alias("kept"))


def keep_first(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each group, with all its columns; of a
    group without ids the one of the smallest drawn id.  Rows that share an id are
    one document, so one of them stays."""
    # The document is one struct, so its columns can have any names.
    packed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.struct("*").alias("document"))
    made = _surrogates(packed.select("doc_id", "text"))
    keyed = _identified(packed, made)
    rows = store(_decide(keyed.select(F.col("id").alias("doc_id"), "text"), k, percent), "decisions")
    first = rows.select(F.col("doc_id").alias("id"), "component").distinct()
    if made is not None:
        # A group with real ids keeps the smallest of them.
        drawn = made.select("id", F.lit(1).alias("drawn"))
        first = first.join(drawn, "id", "left").withColumn("order", F.struct(F.coalesce("drawn", F.lit(0)).alias("drawn"), "id"))
        least = first.groupBy("component").agg(F.min("order")["id"].alias("least"))
        first = first.join(least, "component").select("id", F.col("least").alias("component"))
    gone = store(first.where("id <> component").select("id"), "gone")
    out = keyed.join(gone, "id", "left_anti")
    if not rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["id"])
    return out.select("document.*")


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_input(spark, sf_dir, "documents", "doc_id", "text"))
