"""Size-aware similarity join of shingle sets, and the classes its links make.

Small sets are *light*: two of them link when they share a subset of a size that
their sizes fix, so each set lists its subsets of that size and sets that list
the same one are linked, with nothing left to verify. Large sets are *heavy*:
they are found by scanning inverted lists. The boundary between the two is the
size at which listing subsets, summed over the corpus, begins to cost more.

Lists of single shingles would bring together all documents that share one
passage. The lists here are of *blocks*: a set is cut by hash into so many
blocks that two sets within the threshold must agree in at least two of them,
and a list holds the sets that have one block, whole, in common. A passage that
a third of all documents share then fills no list.

Classes need a link between any two of their parts, not all pairs. Each list is
joined to two of its members first. The sets that these links leave apart are
put on a second kind of inverted lists, those of their rarest shingles, which are
scanned across the parts pair by pair, so that no link between different texts is
lost. Equal sets are one set from the start.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.llm.common import add_columns, checkpointed, own_names, release
from quillgrid.llm.components import components

MOST_LIGHT = 40
"""Sizes considered for light sets."""

SET = "n_shingles long, _print binary, _keys array<long>, _subsets array<struct<key:long,role:int>>"

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """The distinct word shingles of a text, as sorted 64-bit hashes. Fewer
    words than ``width`` are one shingle, no words none."""
    words = text.encode().lower().split()  # bytes: A-Z alone in lower case, cut at ASCII blanks
    if not words:
        return np.empty(0, np.uint64)
    width = min(width, len(words))
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n, found = len(words) - width + 1, np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            found = _mix(found * _A + one[j : j + n])
    return np.unique(found)


LEAST_BUCKETS = 512


def parity(shingles: np.ndarray) -> np.ndarray:
    """For each of some buckets of hashes whether the set has an odd number of shingles in
    it, as bits of longs. Where two sets differ in a bit they differ in a shingle of that
    bucket, so the bits that differ are no more than the shingles that do. There are at
    least two buckets a shingle, a power of two, told by the low bits of the hash: of half
    as many buckets the sketch is the exclusive or of both halves."""
    buckets = max(LEAST_BUCKETS, 1 << (2 * shingles.size - 1).bit_length()) if shingles.size else LEAST_BUCKETS
    odd = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Threshold:
    """Sizes and overlaps of a Jaccard threshold of ``percent`` / 100."""

    def __init__(self, percent: int, largest: int = 1 << 31) -> None:
        self.percent = percent
        # Classes of sizes: a set's partners lie in its own class or beside it.
        self.starts = [1]
        while self.starts[-1] <= largest:
            self.starts.append(self.largest_partner(self.starts[-1]) + 1)

    def overlap(self, a: int, b: int) -> int:
        """Shared elements that sets of these sizes need."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def largest_partner(self, a: int) -> int:
        return 100 * a // self.percent

    def smallest_partner(self, b: int) -> int:
        return -(-self.percent * b // 100)

    def class_of(self, n: int) -> int:
        return bisect_right(self.starts, n) - 1

    def differing(self, size_class: int) -> int:
        """Elements in which pairs may differ whose smaller set is of this class."""
        a = self.starts[size_class + 1] - 1
        together = a + self.largest_partner(a)
        return (100 - self.percent) * together // (100 + self.percent)

    def blocks(self, size_class: int) -> int:
        """Blocks for pairs whose smaller set is of this class. They agree in all but
        ``differing`` blocks, of which some may be empty: hence a tenth more."""
        differing = self.differing(size_class)
        return differing + 2 + differing // 10

    def subset_sizes(self, n: int, boundary: int) -> list[tuple[int, int, int]]:
        """``(smaller, larger, shared)`` of the light pairs that a set of size n may be in."""
        found = []
        for b in range(n, min(boundary, self.largest_partner(n)) + 1):
            found.append((n, b, self.overlap(n, b)))
        for a in range(self.smallest_partner(n), n):
            found.append((a, n, self.overlap(a, n)))
        return [(a, b, c) for a, b, c in found if c <= a]

    def light_cost(self, n: int) -> int:
        """Subsets that a set of size n lists when all its partners are light."""
        return sum(math.comb(n, c) for _, _, c in self.subset_sizes(n, self.largest_partner(n)))

    def heavy_cost(self, n: int) -> int:
        """Lists that a set is put on, and its elements to verify a candidate with."""
        at = self.class_of(n)
        return self.blocks(at) + self.blocks(max(0, at - 1)) + n

    def boundary(self, counts: dict[int, int]) -> int:
        """The largest light size: where the two costs over the corpus are least."""
        costs = {0: sum(k * self.heavy_cost(n) for n, k in counts.items())}
        for n in range(1, MOST_LIGHT + 1):
            k = counts.get(n, 0)
            costs[n] = costs[n - 1] + k * (self.light_cost(n) - self.heavy_cost(n))
        return min(costs, key=lambda n: (costs[n], n))


def block_keys(shingles: np.ndarray, limits: Threshold, boundary: int) -> np.ndarray:
    """The lists that a set is put on, for partners of which one is heavy."""
    n = shingles.size
    if limits.largest_partner(n) <= boundary:
        return np.empty(0, np.int64)
    own, keys = limits.class_of(n), []
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(shingles ^ _B), dtype=np.uint64)])
        for at in {own, max(0, own - 1)}:
            m = limits.blocks(at)
            block = (shingles >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)  # rises with the shingle
            edge = np.searchsorted(block, np.arange(m + 1, dtype=np.uint64))
            # All blocks agree but those in which the sets differ. Where fewer are empty, one
            # of the others agrees, so empty blocks are left out and fill no list.
            told = np.diff(edge) > 0
            if (~told).sum() >= m - limits.differing(at):
                told[:] = True
            number = np.arange(m, dtype=np.uint64)
            key = _mix(_mix(sums[edge[1:]] - sums[edge[:-1]]) + number * _A + np.uint64(at) * _B)
            keys.append(key[told])
    return np.concatenate(keys).view(np.int64)


def subset_keys(shingles: np.ndarray, limits: Threshold, boundary: int) -> list[dict]:
    """The subsets that a light set lists. ``role`` 0 marks the sets any other
    on the list links with: those of the smaller size of the pair."""
    n, found = shingles.size, []
    if not 0 < n <= boundary:
        return found
    for a, b, c in limits.subset_sizes(n, boundary):
        tag = a.to_bytes(2, "little") + b.to_bytes(2, "little")
        for chosen in combinations(range(n), c):
            key = xxhash.xxh3_64_intdigest(shingles[list(chosen)].tobytes() + tag)
            found.append({"key": key - (1 << 63), "role": int(n != a)})
    return found


def near_classes(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of every document.

    Documents link when the Jaccard similarity of their sets of ``width``-word
    shingles is at least ``percent`` / 100; ``component_id`` is the smallest id
    that links lead to. Words are split at ASCII blanks, A-Z in lower case.
    Documents without words have no shingles and link with nothing, not even
    with each other. Rows that repeat an id keep their rows; those with words share
    their component, whether their texts link or not, as they are reached by that id.
    Rows without an id have no shingles and no component. An empty table gives an empty result; other
    columns are not read.

    Shingles are compared by 64-bit hashes, equal sets by 128 bits.
    """
    limits = Threshold(percent)
    text = F.when(F.col(id_col).isNotNull(), F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    boundary = _boundary(rows, limits, width)

    def work(texts: list[str | None]) -> list[list]:
        sizes, prints, keys, subsets, seen = [], [], [], [], set()
        for text in texts:
            shingles = shingle_set(text or "", width)
            known = xxhash.xxh3_128_digest(shingles.tobytes()) if shingles.size else None
            sizes.append(shingles.size)
            prints.append(known)
            new = known is not None and known not in seen  # copies nearby list nothing again
            seen.add(known)
            keys.append(block_keys(shingles, limits, boundary) if new else None)
            subsets.append(subset_keys(shingles, limits, boundary) if new else None)
        return [sizes, prints, keys, subsets]

    # Rows have numbers of their own, fixed by the checkpoint, since ids may repeat with other texts.
    made = add_columns(rows, SET, "text", work, ["id", "hash"]).withColumnRenamed("id", "doc")
    sets = checkpointed(made.withColumn("id", F.monotonically_increasing_id()))
    every = checkpointed(sets.select("id", "doc", "n_shingles"))
    # Equal sets are one node, named by the smallest number.
    firsts = sets.where("_print IS NOT NULL").groupBy("_print").agg(F.min("id").alias("node"), F.first("n_shingles").alias("n"))
    nodes = checkpointed(sets.join(firsts, "_print").select("id", "doc", "hash", "node", "n"))
    same = nodes.where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    # Rows of one id are reached together.
    ids = nodes.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("doc", "a")
    told = nodes.join(ids, "doc").where("node <> a").select("a", F.col("node").alias("b"))

    names = nodes.drop("doc", "hash")
    light = _light_links(sets, names)
    on_lists = _shared_lists(sets, names)
    del made, sets, firsts, names  # keys and subsets have been read
    release(docs.sparkSession)
    named = nodes.where("id = node").select("node", "doc", "hash")
    heavy = _heavy_links(rows, named, on_lists, light, limits, width)
    found = components(same.union(told).union(light).union(heavy))
    release(docs.sparkSession)
    out = every.join(found, "id", "left")
    least = out.where("component IS NOT NULL").groupBy("component").agg(F.min("doc").alias("least"))
    return out.join(least, "component", "left").select(
        F.col("doc").alias(id_col), "n_shingles", F.coalesce("least", "doc").alias("component_id")
    )


def _boundary(rows: DataFrame, limits: Threshold, width: int) -> int:
    """The boundary for this corpus; sizes are estimated by the number of words.
    Any boundary gives the same links."""
    words = F.regexp_count("text", F.lit(r"[^ \t-\r]+"))
    size = F.least(F.greatest(words - width + 1, F.lit(1)), F.lit(MOST_LIGHT + 1))
    counted = rows.where("text IS NOT NULL").groupBy(size.alias("n")).count().collect()  # at most MOST_LIGHT + 1 rows
    return limits.boundary({r["n"]: r["count"] for r in counted})


def _light_links(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links of sets that list the same subset: each with the first that all link with."""
    listed = sets.where(F.size("_subsets") > 0).select("id", F.explode("_subsets").alias("s"))
    listed = listed.select("id", F.col("s.key").alias("key"), F.col("s.role").alias("role")).join(nodes.drop("n"), "id")
    hubs = listed.groupBy("key").agg(
        F.min(F.when(F.col("role") == 0, F.col("node"))).alias("hub"), F.min("node").alias("least"), F.max("node").alias("most")
    ).where("hub IS NOT NULL AND least <> most")
    links = listed.join(hubs, "key").where("node <> hub")
    return checkpointed(links.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())


PASSES = 2
"""Passes over the lists, each over those of some keys, so that fewer lie on disks at once."""


def _shared_lists(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(key, node, n)`` of the lists with at least two different sets."""
    found = []
    for number in range(PASSES):
        listed = sets.where(F.size("_keys") > 0).select("id", F.explode("_keys").alias("key"))
        listed = listed.where(F.pmod("key", F.lit(PASSES)) == number)
        # Most lists hold one set: for these nothing but the key is shuffled, and once.
        shared = checkpointed(listed.groupBy("key").count().where("count > 1").select("key"))
        release(nodes.sparkSession)
        named = checkpointed(listed.join(shared, "key").join(nodes, "id").select("key", "node", "n").distinct())
        del shared, listed
        release(nodes.sparkSession)
        # Copies that different tasks have listed are one set by now.
        several = named.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("key")
        found.append(checkpointed(named.join(several, "key")))
        del named, several
    return reduce(DataFrame.union, found)


def _heavy_links(rows: DataFrame, named: DataFrame, on_lists: DataFrame, light: DataFrame, limits: Threshold, width: int) -> DataFrame:
    """Verified links among the sets on common lists."""
    # Texts are fetched by id and hash, since one id may have several. Copies of a row fall
    # together where the join has dealt them.
    wanted = on_lists.select("node").distinct().join(named, "node").withColumnRenamed("doc", "id")
    texts = rows.join(wanted, ["id", "hash"]).groupBy("id", "hash").agg(F.first("node").alias("node"), F.first("text").alias("text"))

    def work(texts: list[str | None]) -> list[list]:
        sets = [shingle_set(t or "", width) for t in texts]
        return [[x.view(np.int64) for x in sets], [parity(x) for x in sets]]

    shingles = checkpointed(add_columns(texts, "shingles array<long>, parity array<long>", "text", work, ["node"]))
    del texts, wanted
    release(rows.sparkSession)

    # First two members of each list against all others on it.
    one, two = F.min("node").alias("one"), F.min_by("node", F.xxhash64("node")).alias("two")
    hubs = on_lists.groupBy("key").agg(one, two)
    pairs = on_lists.join(hubs, "key").select("node", "n", F.explode(F.array("one", "two")).alias("hub"))
    pairs = pairs.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    first = checkpointed(_verified(pairs, shingles, limits))
    linked = first.where("linked").select("a", "b")
    del pairs
    release(rows.sparkSession)

    # What these and the light links leave apart on some list.
    parts = components(linked.union(light))
    apart = on_lists.join(parts, on_lists["node"] == parts["id"], "left")
    apart = apart.select("key", "node", "n", F.coalesce("component", "node").alias("part"))
    mixed = apart.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("key")
    loose = checkpointed(apart.join(mixed, "key").select("node", "n", "part").distinct())
    del apart, mixed, parts
    release(rows.sparkSession)
    loose = checkpointed(_left_over(shingles, loose, limits))
    release(rows.sparkSession)

    lists = _rare_lists(shingles, loose, limits).join(_met(first, hubs), "node", "left").join(shingles.select("node", "parity"), "node")
    lists = checkpointed(lists)
    del loose
    release(rows.sparkSession)
    x, y = lists.alias("x"), lists.alias("y")
    across = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.part") != F.col("y.part")) & _near(limits) & _alike(limits) & ~_too_far(limits) & ~F.arrays_overlap("x.before", "y.before"))
    across = across.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    second = _verified(across, shingles, limits).where("linked").select("a", "b")
    return checkpointed(linked.union(second))


BEFORE = 64
"""Earlier lists remembered with each entry. Pairs that first meet later than that
are made more than once and told apart afterwards."""

MET = 8
"""Hubs remembered of each set. More of them would spare more comparisons; the links are the same."""


def _met(first: DataFrame, hubs: DataFrame) -> DataFrame:
    """``(node, met)``: the hubs that each set was compared with and how many
    shingles it shares with them, the closest ones."""
    hub = hubs.select(F.explode(F.array("one", "two")).alias("hub")).distinct()
    both = first.select(F.col("a").alias("node"), F.col("b").alias("hub"), "shared").union(first.select("b", "a", "shared"))
    known = both.join(hub, "hub").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("shared", "hub")), False).alias("met"))
    return known.select("node", F.slice("met", 1, MET).alias("met"))


def _alike(limits: Threshold) -> Column:
    """Whether the sketches of ``x`` and ``y`` differ in no more bits than linked sets may
    in shingles: (1 - t) / (1 + t) of their sizes together. Sizes that may link have
    sketches of one length, or one of twice the other's."""
    least = F.least(F.size("x.parity"), F.size("y.parity"))

    def folded(sketch: str) -> Column:
        halves = F.zip_with(F.slice(sketch, F.lit(1), least), F.slice(sketch, least + 1, least), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(sketch) == least, F.col(sketch)).otherwise(halves)

    differ = F.zip_with(folded("x.parity"), folded("y.parity"), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    bits = F.aggregate(differ, F.lit(0), lambda n, b: n + b)
    return bits * (100 + limits.percent) <= (100 - limits.percent) * (F.col("x.n") + F.col("y.n"))


def _too_far(limits: Threshold) -> Column:
    """Whether a hub that both sets ``x`` and ``y`` have met shows that they
    cannot link: what they share lies inside or outside of the hub, and is no
    more than the smaller part of either there."""
    def shows(h: Column, g: Column) -> Column:
        most = F.least(h["shared"], g["shared"]) + F.least(F.col("x.n") - h["shared"], F.col("y.n") - g["shared"])
        return (h["hub"] == g["hub"]) & (100 * most < limits.percent * (F.col("x.n") + F.col("y.n") - most))

    return F.coalesce(F.exists("x.met", lambda h: F.exists("y.met", lambda g: shows(h, g))), F.lit(False))


SHARE = 4
"""One in so many shingles is looked at first."""


def _left_over(shingles: DataFrame, loose: DataFrame, limits: Threshold) -> DataFrame:
    """``loose`` without the sets that one shingle in ``SHARE``, taken by hash, tells to have
    no partner: those of them that no other part holds are more than a link leaves out."""
    some = F.filter("shingles", lambda x: F.pmod(x, F.lit(SHARE)) == 0)
    taken = shingles.select("node", some.alias("some"))  # before the join, which moves no others then
    held = taken.join(loose, "node").select("node", "part", F.explode("some").alias("shingle"))
    both = held.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("shingle")
    common = held.select("node", "shingle").join(both, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("common"))
    own = taken.select("node", F.size("some").alias("looked")).join(common, "node", "left")
    own = own.select("node", (F.col("looked") - F.coalesce("common", F.lit(0))).alias("alone"))
    return loose.join(own, "node").where(F.col("alone") <= F.col("n") - _least_shared(limits)).drop("alone")


def _least_shared(limits: Threshold) -> Column:
    """Shingles that a set of size ``n`` shares with each of its partners."""
    return F.ceil(F.lit(limits.percent) * F.col("n") / 100)


def _rare_lists(shingles: DataFrame, loose: DataFrame, limits: Threshold) -> DataFrame:
    """``(shingle, node, n, part, before)``: inverted lists of the rarest shingles of
    each set, so many that two linked sets have one of them in common. Those that one part
    alone holds come first, and need no list. Only lists that hold different parts are left."""
    held = shingles.join(loose, "node").select("node", "part", F.explode("shingles").alias("shingle"))
    counts = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("part").alias("p"), F.max("part").alias("q"))
    counts = counts.where("p <> q").select("shingle", "sets")
    common = held.select("node", "shingle").join(counts, "shingle").join(loose, "node")
    own = Window.partitionBy("node")  # a set is one document's
    rarest = common.withColumn("place", F.row_number().over(own.orderBy("sets", "shingle")))
    rarest = rarest.withColumn("alone", F.col("n") - F.count(F.lit(1)).over(own))
    rarest = rarest.where(F.col("alone") + F.col("place") <= F.col("n") - _least_shared(limits) + 1)
    rarest = rarest.select("shingle", "node", "n", "part", "sets")
    several = rarest.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("shingle")
    listed = rarest.join(several, "shingle")
    # The lists a set is on before this one: two sets are paired on the first that both are on.
    order = own.orderBy("sets", "shingle")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    listed = listed.withColumn("number", F.row_number().over(order))
    before = F.collect_list(F.when(F.col("number") <= BEFORE, F.col("shingle"))).over(earlier)
    return listed.withColumn("before", before).drop("sets", "number")


def _near(limits: Threshold) -> Column:
    """Whether the sizes of ``x`` and ``y`` allow a link."""
    x, y = F.col("x.n"), F.col("y.n")
    return (100 * x >= limits.percent * y) & (100 * y >= limits.percent * x)


def _verified(pairs: DataFrame, shingles: DataFrame, limits: Threshold) -> DataFrame:
    """The pairs ``(a, b)`` with their exact verdict ``linked``. Those that sizes or
    sketches rule out are left out before any shingles are moved."""
    told = F.struct(F.size("shingles").alias("n"), "parity")
    close = pairs.join(shingles.select(F.col("node").alias("a"), told.alias("x")), "a")
    close = close.join(shingles.select(F.col("node").alias("b"), told.alias("y")), "b")
    close = close.where(_near(limits) & _alike(limits)).select("a", "b")
    a = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    b = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    both = close.join(b, "b").join(a, "a")
    shared = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - shared
    return both.select("a", "b", shared.alias("shared"), (100 * shared >= limits.percent * union).alias("linked"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each class, with all columns of
    ``docs``. Documents without words and rows without an id stay."""
    own, new, old = own_names(docs)
    classes = near_classes(docs, percent, width, id_col, text_col)
    gone = classes.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return own.join(gone, F.col(new[id_col]) == F.col("_gone"), "left_anti").select(*old)
