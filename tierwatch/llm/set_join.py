"""Similarity join of shingle sets by set relations.

A set is the 64-bit hashes of a text's distinct word shingles, in the order of the hashes. Equal
sets are one class. Classes link when ``100 * intersection >= percent * union``.

Index lists. The order of hashes is cut into as many blocks by position as two linked sets of a
band of sizes can differ in, and one more, so linked sets agree in a whole block. A list holds
the classes with one content at one block position of one band; a class skips the lists of all
bands and blocks whose sizes or positions cannot match by not being in them. Blocks without
content say nothing, so there are some more; a class with too few filled blocks still adds a
finer cut, until linked sets must agree in a filled one. So no link is lost, and texts that merely
share a passage rarely meet.

Answers from relations. Every list names a leader, its most listed class, and each class is
compared with the leaders of its lists only. A class's answers are derived from its leader's: the
overlaps with all members that the leader has, corrected by the few shingles in which the two
sets differ. Links are counted for each class, not stored as pairs; a pair that meets in several
groups counts in that of its smallest common leader. Components alone need less: classes linked
to their leader are in one, and only the others' answers are derived. Large groups are split by
salt; what needs answers beyond its own part then meets all other parts, block by block. Groups
thus stay bounded, but counting the links of a group takes time by the square of its classes.

Edge cases: null texts and texts without words have the size 0 and stand alone; fewer words than
a shingle are one shingle; null ids join by their text, and a component without any id has a
null ``component_id``; repeated rows are each reported; an empty table gives an empty result;
only the id and the text are read. Classes and shingles are told apart by 64 bits.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierwatch.llm.components import components
from tierwatch.llm.registered import query, table
from tierwatch.llm.words import NOT_SPACE, chunks, give_back, mix, windows, words
from tierwatch.session import materialize

_U = np.uint64
_BASE, _BLOCK, _CLASS = _U(0x9E3779B97F4A7C15), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)
_KEY_BITS = _U(0xFFFFFFFFFFFF0000)
#: Shingles of one comparison group, about; a larger group is split by salt.
GROUP_SHINGLES = 1 << 20
_SETS = "doc_id long, text_hash long, class long, n_shingles long"
_LINKS = "a long, b long, leader long, stray boolean, n long"


@dataclass(frozen=True)
class Measure:
    """Words per shingle, and the least similarity in per cent."""

    size: int = 3
    percent: int = 90

    def __post_init__(self) -> None:
        if not 70 <= self.percent <= 100 or self.size < 1:
            raise ValueError("a similarity from 70 to 100 per cent, and one word or more")

    def linked(self, common: np.ndarray, n: int, others: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (n + others - common)

    def differ(self, largest: np.ndarray) -> np.ndarray:
        """The most shingles in which two linked sets of at most this size can differ."""
        return 2 * largest * (100 - self.percent) // (100 + self.percent)


NEAR_COPIES = Measure(5, 80)


def _band_edges() -> np.ndarray:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] + max(1, edges[-1] // 2))
    return np.array(edges)


_EDGES = _band_edges()


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text of a small batch, and where each set begins."""
    found = words(texts, NOT_SPACE, lower=True)
    hashes, first = windows(found, size)
    rows = found.rows()[first]
    n_words = np.diff(found.bounds)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        total, at = np.zeros(len(short), _U), found.bounds[short]
        for j in range(int(n_words[short].max())):
            has = j < n_words[short]
            total[has] = total[has] * _BASE + found.hashes[at[has] + j]
        whole = mix(total + n_words[short].astype(_U))
        place = np.searchsorted(rows, short)
        hashes, rows = np.insert(hashes, place, whole), np.insert(rows, place, short)
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        hashes[a:b].sort()
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])])
        hashes, rows = hashes[new], rows[new]
    return np.searchsorted(rows, np.arange(len(texts) + 1)), hashes


def class_of(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, 0 for an empty one."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(hashes ^ _CLASS), dtype=_U)])
    n = np.diff(bounds)
    return np.where(n > 0, mix(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(_U)), _U(0)).view(np.int64)


def signatures(bounds: np.ndarray, hashes: np.ndarray, measure: Measure) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the index lists of each set, and where those of each set begin."""
    n = np.diff(bounds)
    own = np.searchsorted(_EDGES, n, "right") - 1
    content = mix(hashes ^ _BLOCK)
    found, of = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for above in range(3):
        band = own + above
        # Sets of a lower band meet those of this one only if they are large enough.
        active = np.flatnonzero((n > 0) & ((above == 0) | (100 * n >= measure.percent * _EDGES[band])))
        most = measure.differ(_EDGES[band + 1] - 1)
        # Random blocks leave some empty: spare cuts for those that the smallest sets of the band leave.
        smallest = measure.percent * _EDGES[band] / 100
        spare = np.where(most > 0, np.ceil(2 * (most + 1) * np.exp(-smallest / (most + 1))), 0).astype(np.int64)
        level = 0
        while len(active):
            sizes = n[active]
            at = np.repeat(bounds[active] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            row = np.repeat(active, sizes)
            cuts = (most[row] + 1 + spare[row] * (level + 1) + level).astype(_U)
            part = ((hashes[at] >> _U(32)) * cuts) >> _U(32)
            starts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])]))
            where = mix((band[row[starts]].astype(_U) << _U(48)) + (_U(level) << _U(40)) + part[starts] + _BASE)
            found.append(mix(np.add.reduceat(content[at], starts) + where))
            of.append(row[starts])
            filled = np.bincount(row[starts], minlength=len(n))
            active = active[filled[active] <= most[active]]
            level += 1
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    # 48 bits tell the keys of 10**12 entries apart but for one in a few hundred, which costs a comparison.
    return np.searchsorted(of[order], np.arange(len(n) + 1)), (found[order] & _KEY_BITS).view(np.int64)


def _describe(measure: Measure):
    """Class and size of (doc_id, text_hash, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in chunks(batch.column(2)):
                bounds, hashes = shingle_sets(part, measure.size)
                classes = class_of(bounds, hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(part)), batch.column(1).slice(row, len(part)),
                     pa.array(classes, mask=classes == 0), pa.array(np.diff(bounds))],
                    names=["doc_id", "text_hash", "class", "n_shingles"])
        give_back()
    return run


def _listed(measure: Measure):
    """The (key, class) entries of the index lists for (text) rows; a task gives those of a class once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, part in chunks(batch.column(0)):
                bounds, hashes = shingle_sets(part, measure.size)
                classes = class_of(bounds, hashes)
                first = np.zeros(len(part), bool)
                for i, name in enumerate(classes.tolist()):
                    if name and name not in seen:
                        seen.add(name)
                        first[i] = True
                key_bounds, keys = signatures(bounds, hashes, measure)
                sizes = np.diff(key_bounds)
                kept = np.repeat(first, sizes)
                yield pa.RecordBatch.from_arrays([pa.array(keys[kept]), pa.array(np.repeat(classes, sizes)[kept])],
                                                 names=["key", "class"])
        del seen
        give_back()
    return run


class Group:
    """One leader and some members: which of them are in one component and, on request, how many links each has.

    ``leaders`` are those of all groups of each set. With strays, only these are compared, and
    a stray's links to members count for the stray: the other side counts where it is the stray.
    """

    def __init__(self, measure: Measure, names: list[int], sets: list[np.ndarray], strays: list[bool],
                 leaders: list[list[int]], count: bool, has_strays: bool) -> None:
        self.measure, self.names, self.sets, self.count = measure, names, sets, count
        self.strays, self.has_strays = np.array(strays), has_strays
        self.n_links = np.zeros(len(names), np.int64)
        self.smaller = [[x for x in of if x < names[0]] for of in leaders]
        self.of_leader: dict[int, list[int]] = {}
        for i, of in enumerate(self.smaller):
            for x in of:
                self.of_leader.setdefault(x, []).append(i)
        self.root = list(range(len(names)))
        self.links: list[tuple[int, int]] = []

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def _join(self, i: int, j: int) -> None:
        a, b = self._find(i), self._find(j)
        if a != b:
            self.root[a] = b
            self.links.append((self.names[i], self.names[j]))

    def _owned(self, i: int) -> np.ndarray:
        """The sets that have no smaller leader in common with this one."""
        owned = np.ones(len(self.names), bool)
        for x in self.smaller[i]:
            owned[self.of_leader[x]] = False
        return owned

    def _add(self, i: int, linked: np.ndarray) -> None:
        """Count the links of a set with those after it, or with the members if it is a stray."""
        linked = linked & self._owned(i)
        if self.has_strays:
            self.n_links[i] += np.count_nonzero(linked[1:] & ~self.strays[1:])
        else:
            linked[:i + 1] = False
            self.n_links[i] += np.count_nonzero(linked)
            self.n_links += linked

    def apart(self, i: int) -> bool:
        """Whether a set is in another component than the leader."""
        return self._find(i) != self._find(0)

    def compare(self) -> None:
        """The leader (first) with all; then the others, or those not linked to it, by the leader's overlaps."""
        sizes = np.array([len(s) for s in self.sets])
        elements, owner = np.concatenate(self.sets), np.repeat(np.arange(len(sizes)), sizes)
        leader = self.sets[0]
        in_leader = np.isin(elements, leader, assume_unique=False)
        common = np.bincount(owner[in_leader], minlength=len(sizes))
        linked = self.measure.linked(common, len(leader), sizes)
        for i in np.flatnonzero(linked):
            self._join(int(i), 0)
        if self.count and not self.has_strays:
            self._add(0, linked)
        rest = [i for i in range(1, len(sizes)) if (self.count or not linked[i]) and (self.strays[i] or not self.has_strays)]
        if not rest:
            return
        order = np.argsort(elements, kind="stable")
        elements, owner = elements[order], owner[order]
        for i in rest:
            mine = self.sets[i]
            less = np.setdiff1d(leader, mine, assume_unique=True)
            more = np.setdiff1d(mine, leader, assume_unique=True)
            mine_common = common - self._owners(elements, owner, less, len(sizes)) + self._owners(elements, owner, more, len(sizes))
            mine_linked = self.measure.linked(mine_common, len(mine), sizes)
            if self.count:
                self._add(i, mine_linked)
            if not linked[i]:
                for j in np.flatnonzero(mine_linked):
                    self._join(i, int(j))

    @staticmethod
    def _owners(elements: np.ndarray, owner: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
        """How many of the wanted shingles each set has."""
        low, high = np.searchsorted(elements, wanted, "left"), np.searchsorted(elements, wanted, "right")
        sizes = high - low
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.bincount(owner[at], minlength=n)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int, str, list[int]]]]]:
    """Consecutive rows of one group as (leader, [(role, class, text, leaders)])."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for leader, part, block, role, name, text, leaders in zip(*columns):
            if (leader, part, block) != key:
                if rows:
                    yield key[0], rows
                key, rows = (leader, part, block), []
            # The text of a class may be stored any number of times; one is enough.
            if not rows or rows[-1][:2] != (role, name):
                rows.append((role, name, text, leaders))
    if rows:
        yield key[0], rows


def _compare(measure: Measure, count: bool, has_strays: bool):
    """Links within groups whose rows are sorted by role: the leader (0), members (1), strays (2).

    Without strays every member is compared; those that stay apart from their leader, or all if
    links are counted, are reported as strays. With strays, only these are compared with all.
    A class's number of links is a row with the class on both sides.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              names=["a", "b", "leader", "stray", "n"])

        for leader, rows in _groups(batches):
            names, sets, strays, of = [], [], [], []
            for row, texts in chunks(pa.array([r[2] for r in rows], pa.string())):
                bounds, hashes = shingle_sets(texts, measure.size)
                for i, name in enumerate(class_of(bounds, hashes).tolist()):
                    role, wanted, _, leaders = rows[row + i]
                    if name == wanted and (not names or name != names[-1]):
                        names.append(name)
                        sets.append(hashes[bounds[i]:bounds[i + 1]])
                        strays.append(role == 2)
                        of.append(leaders)
            if not names or names[0] != leader:
                raise ValueError("a group without its leader")
            group = Group(measure, names, sets, strays, of, count, has_strays)
            group.compare()
            out += [(a, b, leader, False, 0) for a, b in group.links]
            out += [(name, name, leader, False, n) for name, n in zip(names, group.n_links.tolist()) if n]
            if not has_strays:
                out += [(name, name, leader, True, 0) for i, name in enumerate(names) if group.apart(i) or count and i]
            if len(out) > 10_000:
                yield batch()
                out = []
        if out:
            yield batch()
        out = []
        give_back()
    return run


def _fetch(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Members with the text of their class, grouped and sorted for comparison."""
    rows = members.join(docs, ["row_key", "text_hash"]).select("leader", "part", "block", "role", "class", "text", "leaders")
    return rows.repartition("leader", "part", "block").sortWithinPartitions("leader", "part", "block", "role", "class")


def _parts(members: DataFrame, by: str, into: str, group_shingles: int) -> tuple[DataFrame, DataFrame]:
    """Members with a part of their leader's group, and the number of parts of each leader."""
    parts = members.groupBy("leader").agg(F.ceil(F.sum("n_shingles") / group_shingles).cast("int").alias("parts"))
    dealt = members.join(parts, "leader").withColumn(into, F.pmod(F.xxhash64(F.lit(by), "class"), F.col("parts")).cast("int"))
    return dealt.drop("parts"), parts


def _index_lists(docs: DataFrame, measure: Measure) -> DataFrame:
    """``key, class`` of the lists with two classes or more, stored.

    Entries are made twice, to find the shared keys and to join them, which is cheaper than
    storing all of them.
    """
    listed = docs.select("text").mapInArrow(_listed(measure), "key long, class long")
    shared = listed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    shared = shared.filter("low <> high").select("key").hint("shuffle_hash")  # entries need no sort
    return materialize(listed.join(shared, "key"), "index-lists")


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are gone; it does so when the driver's JVM collects them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def link_classes(docs: DataFrame, classes: DataFrame, measure: Measure, group_shingles: int = GROUP_SHINGLES,
                 count: bool = False) -> DataFrame:
    """Links ``a, b`` between classes that connect exactly the classes that the similarity connects.

    With ``count`` there are also rows with a class on both sides, whose sum ``n`` is its number of links.
    """
    lists = _index_lists(docs, measure)
    _release(docs.sparkSession)

    weight = lists.groupBy("class").agg(F.count("*").alias("weight"))
    leaders = lists.join(weight, "class").groupBy("key").agg(F.max(F.struct("weight", "class"))["class"].alias("leader"))
    pairs = lists.join(leaders, "key").select("leader", "class").filter("leader <> class").distinct()
    if count:
        pairs = materialize(pairs, "pairs")
        every = pairs.union(pairs.select("leader", F.col("leader").alias("class")))
        leaders_of = every.groupBy("class").agg(F.collect_set("leader").alias("leaders"))
        classes = materialize(classes.join(leaders_of, "class"), "leaders")
    else:
        classes = classes.withColumn("leaders", F.array().cast("array<long>"))
    members = materialize(pairs.join(classes, "class"), "members")

    dealt, parts = _parts(members, "part", "part", group_shingles)
    dealt = materialize(dealt.select("leader", "part", F.lit(0).alias("block"), F.lit(1).alias("role"), "class", "row_key",
                                     "text_hash", "n_shingles", "leaders"), "groups")
    heads = parts.join(classes.withColumnRenamed("class", "leader"), "leader").select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("block"),
        F.lit(0).alias("role"), F.col("leader").alias("class"), "row_key", "text_hash", "n_shingles", "leaders")
    found = materialize(_fetch(dealt.unionByName(heads), docs).mapInArrow(_compare(measure, count, False), _LINKS), "links")
    links = found.filter("not stray").select("a", "b", "n")

    # What stays apart from its leader in a split group, or is counted there, meets the other parts as well.
    several = parts.filter("parts > 1")
    strays = found.filter("stray").select("leader", F.col("a").alias("class")).join(several, "leader").join(classes, "class")
    strays = materialize(strays, "strays")
    if strays.isEmpty():
        return links
    by_block, blocks = _parts(strays.drop("parts"), "block", "block", group_shingles)
    grid = blocks.withColumnRenamed("parts", "blocks")
    columns = ["leader", "part", "block", "role", "class", "row_key", "text_hash", "n_shingles", "leaders"]
    each_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    others = dealt.drop("block").join(grid, "leader").withColumn("block", each_block).select(*columns)
    firsts = heads.drop("block").join(grid, "leader").withColumn("block", each_block).select(*columns)
    spread = by_block.join(several, "leader").select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", F.lit(2).alias("role"),
        "class", "row_key", "text_hash", "n_shingles", "leaders", "parts").filter(
            F.col("part") != F.pmod(F.xxhash64(F.lit("part"), "class"), F.col("parts"))).drop("parts")
    more = _fetch(others.unionByName(firsts).unionByName(spread), docs).mapInArrow(_compare(measure, count, True), _LINKS)
    return links.union(materialize(more, "links").select("a", "b", "n"))


def join_sets(docs: DataFrame, measure: Measure = Measure(), id_col: str = "doc_id", text_col: str = "text",
              group_shingles: int = GROUP_SHINGLES, count_links: bool = True) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept, n_links`` of every row.

    ``kept`` marks the text of each component that has its smallest id (and, of several texts with
    that id, the smallest hash). ``n_links`` is the number of other sets that the row's set is linked
    to; without ``count_links`` it is left out, and links inside a component are not all looked for.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).alias("text"))
    sets = materialize(rows.mapInArrow(_describe(measure), _SETS), "shingle-sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    classes = sets.filter(F.col("class").isNotNull()).groupBy("class").agg(
        first.alias("first"), F.max("n_shingles").alias("n_shingles"))
    classes = materialize(classes.select("class", "first", "n_shingles"), "classes")
    keyed = classes.select("class", F.coalesce("first.doc_id", "first.text_hash").alias("row_key"), "first.text_hash", "n_shingles")
    texts = rows.select(F.coalesce("doc_id", "text_hash").alias("row_key"), "text_hash", "text")
    links = link_classes(texts, keyed, measure, group_shingles, count_links)
    n_links = links.filter("n > 0").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n_links"))

    of_class = components(links.filter("a <> b")).withColumnRenamed("node", "class")
    linked = classes.join(of_class, "class", "left").select(
        "class", "first", F.coalesce("component", "class").alias("component"))
    best = linked.groupBy("component").agg(F.min("first").alias("best"))
    named = linked.join(best, "component").join(n_links, "class", "left").select(
        "class", "best", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    narrow = sets.select("doc_id", "text_hash", "class", "n_shingles")
    placed = narrow.filter(F.col("class").isNotNull()).join(named, "class").select(
        "doc_id", "text_hash", "n_shingles", F.col("best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))).alias("kept"), "n_links")
    alone = narrow.filter(F.col("class").isNull()).select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(0).cast("long").alias("n_links"))
    return placed.unionByName(alone) if count_links else placed.drop("n_links").unionByName(alone.drop("n_links"))


def keep_one(docs: DataFrame, measure: Measure, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, in its own columns.

    Repeated rows count as copies. Rows without words are all kept.
    """
    joined = join_sets(docs, measure, id_col, text_col, count_links=False)
    kept = joined.filter(F.col("kept")).select("doc_id", "text_hash", (F.col("n_shingles") == 0).alias("empty"))
    kept = kept.groupBy(F.coalesce("doc_id", "text_hash").alias("__key"), F.col("text_hash").alias("__hash")).agg(
        F.max("empty").alias("__empty"))
    keyed = docs.withColumns({"__hash": F.xxhash64(F.col(text_col)),
                              "__key": F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))})
    found = keyed.join(kept, ["__key", "__hash"])
    again = F.row_number().over(Window.partitionBy("__key", "__hash").orderBy(F.lit(1)))
    return found.withColumn("__again", again).filter((F.col("__again") == 1) | F.col("__empty")).select(*docs.columns)


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\x20\x09-\x0D]+')")
SQL = f"""WITH RECURSIVE split AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(g, ' ') AS g FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 2, 1) + 1), lambda i: ws[i:i + 2])) AS g
    FROM split WHERE len(ws) > 0) t),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (max(m.n) + max(n.n) - count(*))),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
named AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS name FROM shingles GROUP BY 1),
counted AS (
  SELECT l.x AS doc_id, count(DISTINCT theirs.name) AS n_links
  FROM links l JOIN named ours ON ours.doc_id = l.x JOIN named theirs ON theirs.doc_id = l.y WHERE ours.name <> theirs.name GROUP BY 1)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.y) AS component_id, coalesce(max(c.n_links), 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN counted c USING (doc_id) LEFT JOIN reached r ON r.x = d.doc_id
GROUP BY d.doc_id"""


@query(SQL)
def op3_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document, and the number of other sets that its set is linked to."""
    return join_sets(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")
