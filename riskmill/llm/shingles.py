"""Exact Jaccard join of word n-gram sets with prefix trees.

A document's set holds the hashes of its distinct word n-grams. Documents with equal sets are one class.

Which sets meet is decided exactly. Two sets that reach the similarity differ in at most d elements,
where d follows from their size; sizes fall into classes whose neighbours differ by the similarity, and
each set takes part in the scheme of its own class and of the next larger one. A scheme cuts the range of
hashes into d + 1 + k segments; by the pigeonhole principle two similar sets agree on k + 1 whole ones. A
set leaves out its m smallest segments (m < k): those on which two sets agree are in the same order in both,
so k + 1 - m of them are left in both. The key of a segment is a digest of its elements. Groups with the
same members become one that counts for all their segments.

A set that shares fewer than k + 1 - m segments of a scheme with all others together has no similar set
there, and leaves the scheme's groups: so go most sets that share only a passage. What goes takes
from the counts of others, so this is repeated `rounds` times; any number of rounds keeps every link.
Groups that have their leading member in common are then joined, so that a set stands in few groups.

Within a group the sets, in the global order of their hashes, stand in a prefix tree. A set is looked up
by walking the tree level by level, all open nodes of a level at once: the overlap up to a node is shared by
all sets below it, and a subtree is left when what remains of its longest set, or of the set looked up, can no
longer reach the needed overlap.
Only links between sets that are not connected yet matter: subtrees that hold one component with the
set are left too, and sets of the largest component need not be looked up. What leaves a group is one
row per linked set. First every set meets its two largest groups; of all other groups only those that
still hold several components are walked.

Groups with more than `group_shingles` elements are cut into blocks; each pair of blocks is a task's tree
of its own. Nothing is capped, and no pairs are listed.

Rules: NULL, empty and white texts have an empty set and link with nothing; texts with fewer words than n
are one n-gram. A row with a NULL key links with nothing and gets no component. Repeated rows are equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from riskmill.llm.components import components
from riskmill.llm.store import stored
from riskmill.llm.text import PART, Words, joined, mixed, slices


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    words = Words(texts)
    hashes, at, counts = words.hashes(), words.word_at, words.counts
    grams = hashes
    for k in range(1, n):
        grams = joined(grams[: len(hashes) - k], hashes[k:]) if len(hashes) > k else hashes[:0]
    sets = []
    for first, count in zip(at[:-1], counts):
        if count >= n:
            sets.append(np.unique(grams[first : first + count - n + 1]))
        elif count:
            whole = hashes[first] ^ np.uint64(count)
            for h in hashes[first + 1 : first + count]:
                whole = joined(np.array([whole]), h)[0]
            sets.append(np.array([mixed(np.array([whole]))[0]]))
        else:
            sets.append(hashes[:0])
    return sets


#: The bits of a segment key that hold its scheme.
SCHEME = np.uint64(511)


class Schemes:
    """Size classes and, for each, into how many segments its sets are cut."""

    def __init__(self, percent: int):
        self.percent, sizes = percent, [1]
        while sizes[-1] < 1 << 40:
            sizes.append(max(sizes[-1] + 1, sizes[-1] * 100 // percent))
        self.sizes = np.array(sizes)
        self.differ = 2 * self.sizes * (100 - percent) // (100 + percent)
        self.spare = 2 + self.differ // 3
        self.left_out = 1 + self.differ // 8
        #: Segments that two similar sets share at least in their keys.
        self.needed = self.spare + 1 - self.left_out

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """The segment keys of a sorted set in its two schemes; the last bits tell the scheme."""
        found, own = [], int(np.searchsorted(self.sizes, len(elements)))
        values = mixed(elements)
        for c in (own, own + 1):
            if not self.differ[c]:
                continue  # only equal sets are that similar
            parts = int(self.differ[c]) + 1 + int(self.spare[c])
            part = ((elements >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
            sums = np.zeros(parts, np.uint64)
            sums[part[first].astype(np.int64)] = np.add.reduceat(values, first)
            held = np.bincount(part.astype(np.int64), minlength=parts)
            kept = np.argsort(held, kind="stable")[self.left_out[c] :].astype(np.uint64)
            name = mixed(kept + np.uint64(c << 40))
            key = mixed(sums[kept.astype(np.int64)] ^ name) + name
            found.append((key & ~SCHEME) | np.uint64(c))
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


def class_of(elements: np.ndarray) -> int:
    """A digest of a set."""
    total = np.add.reduce(mixed(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(elements))]))[0].view(np.int64))


def _sizes(n: int):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PART):
                sets = shingle_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                ], ["id", "n", "class"])

    return sizes


def _segments(n: int, percent: int, ranges: int):
    """For each hash range: the segment keys of a run of texts and the classes that they belong to."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes, spread = Schemes(percent), np.uint64((1 << 64) // ranges + 1)

        def told(keys, classes):
            place = np.repeat(np.arange(len(keys), dtype=np.uint16), [len(k) for k in keys])
            keys, table = np.concatenate(keys), np.array(classes, np.int64).tobytes()
            order = np.argsort(keys)
            keys, place = keys[order], place[order]
            cuts = np.searchsorted((keys // spread).astype(np.int64), np.arange(ranges + 1))
            for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r])] + [pa.array([d], pa.binary()) for d in (keys[a:b].tobytes(), place[a:b].tobytes(), table)],
                        ["range", "keys", "places", "classes"],
                    )

        keys, classes, held, seen = [], [], 0, set()
        for batch in batches:
            for part in slices(batch, "text", PART):
                for s in shingle_sets(part.column("text"), n):
                    if not len(s) or (c := class_of(s)) in seen or not len(k := schemes.keys(s)):
                        continue
                    seen.add(c)
                    keys.append(k)
                    classes.append(c)
                    held += len(k)
                    if held > 1 << 20 or len(classes) > 60_000:
                        yield from told(keys, classes)
                        keys, classes, held, seen = [], [], 0, set()
        if held:
            yield from told(keys, classes)

    return segments


def _groups(key: tuple, rows: pa.Table) -> pa.Table:
    """Of one hash range: the members of each segment that several classes share. Groups of a scheme with
    equal members become one; `times` is how many they were."""
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in rows["keys"].to_pylist()])
    classes = np.concatenate([
        np.frombuffer(c, np.int64)[np.frombuffer(p, np.uint16)]
        for c, p in zip(rows["classes"].to_pylist(), rows["places"].to_pylist())
    ])
    order = np.argsort(keys, kind="stable")
    keys, classes = keys[order], classes[order]
    shared = np.zeros(len(keys), bool)
    shared[1:] = keys[1:] == keys[:-1]
    shared[:-1] |= shared[1:]
    keys, classes = keys[shared], classes[shared]
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
    keys, classes = keys[fresh], classes[fresh]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
    many = np.diff(first, append=len(keys))
    sums = np.add.reduceat(mixed(classes.view(np.uint64)), first) if len(first) else np.zeros(0, np.uint64)
    scheme = keys[first] & SCHEME
    group = mixed(mixed(sums + many.astype(np.uint64)) + scheme).view(np.int64)
    _, once, times = np.unique(group, return_index=True, return_counts=True)
    count = np.zeros(len(first), np.int64)
    count[once] = np.where(many[once] > 1, times, 0)
    count = np.repeat(count, many)
    keep = count > 0
    return pa.table({
        "group": np.repeat(group, many)[keep], "class": classes[keep],
        "scheme": np.repeat(scheme.astype(np.int32), many)[keep], "times": count[keep],
    })


def _peeled(groups: DataFrame, needed: np.ndarray, rounds: int) -> DataFrame:
    """The groups without sets that share too few segments of a scheme to have a similar set in it."""
    least = F.element_at(F.array(*(F.lit(int(k)) for k in needed)), F.col("scheme") + 1)
    for _ in range(rounds):
        enough = groups.groupBy("class", "scheme").agg(F.sum("times").alias("shared")).filter(F.col("shared") >= least)
        groups = groups.join(enough.select("class", "scheme"), ["class", "scheme"], "left_semi")
        several = groups.groupBy("group").agg(F.count(F.lit(1)).alias("left")).filter("left > 1").select("group")
        groups = stored(groups.join(several, "group", "left_semi"))
    return groups


def _merged(groups: DataFrame) -> DataFrame:
    """Groups with the same leading member, by one order of the sets and then another, become one.

    The many segments of a few much alike sets make many groups with nearly the same members.
    """
    for order in (1, 2):
        lead = groups.groupBy("group").agg(F.min(F.xxhash64("class", F.lit(order))).alias("lead"))
        groups = groups.join(lead, "group").select(F.col("lead").alias("group"), "class").distinct()
    return stored(groups)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in slices(batch, "text", PART):
            data = [pack.compress(t.as_py() or b"") for t in part.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(data, pa.binary())], ["id", "data"])


class PrefixTree:
    """Sets in their global order as paths of a tree whose nodes hold `STRIDE` elements each.

    Sets are sorted by their elements, so the sets below a node are neighbours: of each level, `first` and
    `last` are these for every node, `parent` is its place on the level before, and `part` are its elements.
    Sets with equal beginnings share nodes and with them the overlap up to there.
    """

    STRIDE = 32

    def __init__(self, sets: list[np.ndarray], elements: int):
        """elements: sets hold numbers below it; it stands for no element itself."""
        self.sets, self.levels = sets, []
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat, starts = np.concatenate(sets), np.cumsum(self.sizes) - self.sizes
        shared = np.zeros(len(sets), np.int64)
        for k, (a, b) in enumerate(zip(sets, sets[1:]), 1):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            shared[k] = differ[0] if len(differ) else m
        above = np.zeros(len(sets), np.int64)
        for depth in range(0, int(self.sizes.max()), self.STRIDE):
            there = np.flatnonzero(self.sizes > depth)
            at = np.flatnonzero(shared[there] < depth + self.STRIDE)  # a shorter neighbour shares less as well
            first, last = there[at], there[np.append(at[1:], len(there)) - 1]
            places = starts[first, None] + depth + np.arange(self.STRIDE)
            inside = places < (starts + self.sizes)[first, None]
            part = np.where(inside, flat[np.minimum(places, len(flat) - 1)], elements).astype(np.int32)
            end = np.minimum(self.sizes[first], depth + self.STRIDE)
            self.levels.append((
                first, last, above[first], part, end, flat[starts[first] + end - 1],
                np.minimum.reduceat(self.sizes[there], at), np.maximum.reduceat(self.sizes[there], at),
            ))
            above[there] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(there))))

    def similar(self, x: np.ndarray, mark: np.ndarray, among: np.ndarray, percent: int) -> np.ndarray:
        """Which of the sets that `among` marks reach the similarity with x, level by level.

        mark: by element, whether x holds it. Subtrees without a set of `among` are not entered, and those
        that can no longer reach the overlap they need are left.
        """
        before, found = np.append(0, np.cumsum(among)), []
        nodes, overlap = np.arange(len(self.levels[0][0])), np.zeros(len(self.levels[0][0]), np.int64)
        for level, (first, last, parent, part, end, final, shortest, longest) in enumerate(self.levels):
            if level:
                nodes = np.flatnonzero(overlap[parent] >= 0)
                overlap = overlap[parent[nodes]]
            wanted = before[last[nodes] + 1] > before[first[nodes]]
            nodes, overlap = nodes[wanted], overlap[wanted]
            if not len(nodes):
                break
            overlap = overlap + np.count_nonzero(mark[part[nodes]], axis=1)
            rest = len(x) - np.searchsorted(x, final[nodes], "right")
            reach = overlap + np.minimum(rest, longest[nodes] - end[nodes])
            kept = (100 + percent) * reach >= percent * (len(x) + shortest[nodes])
            nodes, overlap = nodes[kept], overlap[kept]
            # The first set below a node can end with it.
            one = first[nodes]
            done = among[one] & (self.sizes[one] == end[nodes])
            done &= (100 + percent) * overlap >= percent * (len(x) + self.sizes[one])
            found.append(one[done])
            state = np.full(len(first), -1)
            state[nodes] = overlap
            overlap = state
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def linked_components(sets: list[np.ndarray], component: np.ndarray, percent: int) -> np.ndarray:
    """The components of the sets after all links among them; `component` is what is known before."""
    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum([0, *map(len, sets)])
    local = [place[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]
    order = sorted(range(len(local)), key=lambda i: local[i].astype(">i4").tobytes())
    tree = PrefixTree([local[i] for i in order], len(every))
    _, component = np.unique(component[order], return_inverse=True)
    mark = np.zeros(len(every) + 1, bool)
    open_sets = np.ones(len(order), bool)  # not looked up yet
    while True:
        sizes = np.bincount(component[open_sets], minlength=len(order))
        if np.count_nonzero(sizes) < 2:
            break
        waiting = np.flatnonzero(open_sets)
        one = waiting[np.argmin(sizes[component[waiting]])]
        open_sets[one] = False
        x = tree.sets[one]
        mark[x] = True
        among = open_sets & (component != component[one])
        linked = np.unique(component[tree.similar(x, mark, among, percent)])
        if len(linked):
            component[np.isin(component, linked)] = component[one]
        mark[x] = False
    out = np.empty(len(order), np.int64)
    out[order] = component
    return out


def _walked(n: int, percent: int):
    """From rows sorted by group and pair of blocks: each newly linked document and its root there."""
    names = ("group", "one", "other")

    def group(rows: pa.Table):
        texts = [zstandard.decompress(d) for d in rows["data"].to_pylist()]
        sets, keep, seen = [], [], set()
        for i, (s, c) in enumerate(zip(shingle_sets(pa.array(texts, pa.binary()), n), rows["class"].to_pylist())):
            if c not in seen and len(s) and class_of(s) == c:  # else another row with this id
                seen.add(c)
                sets.append(s)
                keep.append(i)
        if len(sets) < 2:
            return None
        ids, before = (np.asarray(rows[c].combine_chunks())[keep] for c in ("rep", "component"))
        after = linked_components(sets, before, percent)
        root = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(root, after, ids)
        root = root[after]
        told = root != ids
        return (ids[told], root[told]) if told.any() else None

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found):
            return pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["id", "root"])

        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            keys = np.stack([np.asarray(rows[c].combine_chunks()) for c in names])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1)]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1 and (found := group(rows.slice(a, b - a))):
                    yield emit(found)
            rest = rows.slice(cuts[-1])
        if rest is not None and rest.num_rows > 1 and (found := group(rest)):
            yield emit(found)

    return walk


def _links(members: DataFrame, pool: DataFrame, n: int, percent: int, group_shingles: int) -> DataFrame:
    """Links that the groups of `members` (group, class, rep, n, component, weight) show."""
    blocks = F.ceil(F.col("weight") / group_shingles).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    ).withColumn("with", F.explode(F.expr("IF(blocks = 1, array(0), filter(sequence(0, blocks - 1), x -> x <> block))")))
    dealt = dealt.withColumns({"one": F.least("block", "with"), "other": F.greatest("block", "with")})
    by = ["group", "one", "other"]
    return dealt.select(*by, "class", "rep", "component").join(pool, "rep").repartition(*by).sortWithinPartitions(
        *by
    ).mapInArrow(_walked(n, percent), "id long, root long")


def similar_documents(
    docs: DataFrame, key: str, text: str, *, n: int = 3, percent: int = 90, group_shingles: int = 500_000,
    ranges: int | None = None, rounds: int = 3,
) -> DataFrame:
    """Per row: key, n_shingles, component_id (the smallest key that it reaches).

    ranges: hash ranges of the segments, each of which fits a task; by default as many as shuffle partitions.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sized = stored(rows.mapInArrow(_sizes(n), "id long, n long, class long"))
    classes = sized.filter("class IS NOT NULL AND id IS NOT NULL").groupBy("class").agg(
        F.min("id").alias("rep"), F.first("n").alias("n")
    )
    groups = rows.filter("id IS NOT NULL").select("text").mapInArrow(
        _segments(n, percent, ranges), "range long, keys binary, places binary, classes binary"
    ).groupBy("range").applyInArrow(_groups, "group long, class long, scheme int, times long")
    groups = stored(groups.groupBy("group", "class").agg(F.sum("times").alias("times"), F.first("scheme").alias("scheme")))
    groups = _peeled(groups, Schemes(percent).needed, rounds)
    groups = _merged(groups.select("group", "class"))
    held = groups.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    members = stored(groups.join(held, "group").join(classes, "class"))
    pool = stored(rows.mapInArrow(_compressed, "id long, data binary").join(
        members.select(F.col("rep").alias("id")).distinct(), "id"
    ).withColumnRenamed("id", "rep"))
    weights = members.groupBy("group").agg(F.sum("n").alias("weight"))

    largest = Window.partitionBy("rep").orderBy(F.col("members").desc(), "group")
    chosen = members.withColumn("at", F.row_number().over(largest)).filter("at <= 2").withColumn("component", F.col("rep"))
    first = stored(_links(chosen.join(weights, "group"), pool, n, percent, group_shingles))

    whole = chosen.groupBy("group").agg(F.count(F.lit(1)).alias("c"), F.first("members").alias("m")).filter("c = m")
    known = components(first, "id", "root")
    left = members.join(whole.select("group"), "group", "left_anti").join(
        known, members["rep"] == known["node"], "left"
    ).withColumn("component", F.coalesce("component_id", "rep")).drop("node", "component_id")
    divided = left.groupBy("group").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.sum("n").alias("weight")
    ).filter("a < b").select("group", "weight")
    second = _links(left.join(divided, "group"), pool, n, percent, group_shingles)

    found = components(first.unionByName(second), "id", "root").withColumnRenamed("node", "rep")
    named = classes.join(found, "rep", "left").select("class", F.coalesce("component_id", "rep").alias("root"))
    return sized.join(named, "class", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"),
    )
