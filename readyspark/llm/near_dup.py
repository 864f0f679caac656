"""Near-duplicate documents by a chosen-path set similarity join (operator 10).

A document is its set of distinct five-word shingles; two are linked where the
Jaccard similarity of the sets is at least the threshold. The stages:

1. Sketch. One pass over the texts gives each document's set size, a 128-bit
   sum that identifies the set, ``SIGNATURE`` minwise tokens (the smallest
   scrambled shingle under as many hash functions) and the ``LOW`` least hashes
   of the set itself. Documents of one set form a class, which goes on as its
   smallest id.
2. Chosen paths. In each of ``trees`` independent trees a class is sent along
   selected minwise tokens (``BRANCH`` of them on average at each level); classes
   with the same token meet in a node. First every node's classes are compared with its first one only, which
   links nearly all copies at linear cost however large a group is. Nodes whose
   classes are then still of several components are compared exhaustively when
   they hold at most ``NODE`` classes and else branch again along further
   tokens. After ``LEVELS`` levels a node is a crowd of much the same sets; it
   goes on branching along the places its path hasn't used (``DEEP`` of them on
   average) until it holds at most ``TILE`` classes or no place is left, and is
   then compared exhaustively, in tiles of two of its parts.
3. Confirmation. Pairs whose signatures agree in at least ``AGREE`` places and
   whose least hashes put them near the threshold are confirmed on the full
   sets, computed anew for such documents alone: pairs with a first class by a
   join, small nodes whole. A node's sets are sent along with its rows, so many
   likely but unlike pairs in it cost comparisons and no rows.
4. Components. Links are contracted in a Spark loop.

Recall of a pair at similarity 0.75, the hardest: it shares no root token of 4
trees with 2 tokens each with probability 0.25 ** 8 = 1.5e-5; where all its nodes
branch once or twice, it is missed with probability 1e-3; its signatures agree in
fewer than 13 of 32 places with probability 1e-5, and its least hashes fall below
``NEAR`` with probability 2e-5. A pair already joined through others isn't needed.
Crowds lose more, as every level may part a pair: with ``NODE`` 16 and ``TILE`` 128 a
run linked 885 of a star's 901 classes (similarity 0.79) and 248 of 250 pairs of 0.8
in a crowd of 0.65 (test_duplicates.py).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import few, list_array, mix64, shingles, prepare_python, text_bytes, tidy, written
from readyspark.llm.components import components

SIGNATURE = 32   # minwise tokens of a document
AGREE = 13       # places in which a candidate pair's signatures agree at least
LOW = 96         # least hashes of a document's set: the whole set of a short text
NEAR = 0.565     # similarity that they must show, four deviations below 0.75
TREES = 4
# tokens along which a tree sends a document at each level: two at the root, then
# one and for a third of the rows another (1 / 0.75 on average, which keeps large
# nodes from multiplying), then two again for the few that are left
BRANCH = (2, 4 / 3, 2)
NODE = 256       # classes that are compared exhaustively
LEVELS = len(BRANCH)
DEEP = 5 / 3     # tokens along which a crowd goes on branching at each further level
TILE = 4096      # classes of a crowd that are compared exhaustively, in tiles

SLICE = 500_000  # shingles of a node that are counted at once
COLUMNS = 1024   # of them, such as two sets have, that are multiplied at once

_MULTIPLY = mix64(np.arange(1, SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def signature(found: np.ndarray) -> np.ndarray:
    """``SIGNATURE`` minwise tokens (32 bits each) of a non-empty set."""
    low = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 4096):
            x = found[at:at + 4096][None, :] * _MULTIPLY[:, None]
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x94D049BB133111EB)
            low = np.minimum(low, x.min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets may be similar, by the least hashes of each: among the
    least of their union, the share that both have estimates the similarity."""
    both = np.union1d(a, b)
    whole = len(a) < LOW and len(b) < LOW
    if not whole:
        both = both[:LOW]
    shared = len(np.intersect1d(np.intersect1d(a, b, True), both, True))
    return shared >= (0.74 if whole else NEAR) * len(both)


def set_sums(found: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = found.sum(dtype=np.uint64)
        b = mix64(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id``, ``n`` (set size), ``k1``, ``k2`` (set identity), ``sig``, ``low``;
    null and wordless texts have n = 0 and nulls."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, k1, k2, sigs, low = [], [], [], [], []
            for data in text_bytes(b.column(1)):
                found = shingles(data, size)
                sums = set_sums(found) if len(found) else (None, None)
                n.append(len(found))
                k1.append(sums[0])
                k2.append(sums[1])
                sigs.append(signature(found) if len(found) else np.empty(0, np.int32))
                low.append((found[:LOW] >> np.uint64(32)).astype(np.uint32).tobytes())
            values = np.concatenate(sigs) if sigs else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 list_array(values, [len(s) for s in sigs], pa.int32()), pa.array(low, pa.binary())],
                names=["id", "n", "k1", "k2", "sig", "low"])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(tidy(run), f"id {kind}, n long, k1 long, k2 long, sig array<int>, low binary")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id``, ``k1``, ``found`` (the sorted set as bytes) of the wanted ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(data, size) for data in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([set_sums(s)[0] if len(s) else None for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "k1", "found"])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    return read.join(wanted, "id", "left_semi").mapInArrow(tidy(run), f"id {kind}, k1 long, found binary")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted sets."""
    union = len(np.union1d(x, y))
    return 100 * (len(x) + len(y) - union) >= percent * union


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two of the sorted sets, which are
    counted in slices of the hash range."""
    out = np.zeros((len(sets), len(sets)), np.int64)
    slices = 1 + sum(len(s) for s in sets) // SLICE
    bounds = [np.uint64((k << 64) // slices) for k in range(1, slices)]
    cuts = [np.concatenate([[0], np.searchsorted(s, np.array(bounds, np.uint64)), [len(s)]]) for s in sets]
    for k in range(slices):
        parts = [s[c[k]:c[k + 1]] for s, c in zip(sets, cuts)]
        _, code, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        code, keep = code.ravel(), times > 1
        place = (np.cumsum(keep) - 1)[code]
        row, keep = np.repeat(np.arange(len(sets)), [len(x) for x in parts]), keep[code]
        row, place = row[keep], place[keep]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        ends = np.searchsorted(place, np.arange(0, (place[-1] + 1 if len(place) else 0) + COLUMNS, COLUMNS))
        for i, (x, y) in enumerate(zip(ends, ends[1:])):
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[row[x:y], place[x:y] - i * COLUMNS] = 1
            out += (has @ has.T).astype(np.int64)
    return out


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``ka``, ``b``, ``kb``) whose full sets are similar:
    100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("k1").alias("ka"), F.col("found").alias("fa"))
    right = sets.select(F.col("id").alias("b"), F.col("k1").alias("kb"), F.col("found").alias("fb"))
    joined = pairs.join(left, ["a", "ka"]).join(right, ["b", "kb"]).select("a", "b", "fa", "fb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                             for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    kind = joined.schema["a"].dataType.simpleString()
    return joined.mapInArrow(tidy(run), f"a {kind}, b {kind}").distinct()


def branch(rows: DataFrame, level: int) -> DataFrame:
    """Send each row (``node``, ``tree``, ``sig``, ...) along its tree's next tokens."""
    most = math.ceil(BRANCH[level])
    begin = sum(math.ceil(b) for b in BRANCH[:level])

    def token(j: int):
        # the tree's own order of the signature's places; none comes twice on a path
        place = F.pmod(F.xxhash64(F.lit("place"), "tree") + F.lit((begin + j) * 11), F.lit(SIGNATURE)).cast("int")
        return F.struct(place.alias("p"), F.element_at("sig", place + 1).alias("t"))

    # all classes of a node decide alike whether it takes its last token
    last = F.pmod(F.xxhash64("node", F.lit("last")), F.lit(1000)) < round(1000 * (BRANCH[level] - most + 1))
    some = F.array(*[token(j) for j in range(most - 1)])
    taken = F.when(last, F.concat(some, F.array(token(most - 1)))).otherwise(some)
    out = rows.withColumn("_c", F.explode(taken))
    return out.withColumn("node", F.xxhash64("node", "_c.p", "_c.t")).drop("_c")


def branch_on(rows: DataFrame) -> DataFrame:
    """Send each row of a crowd (``node``, ``used``, ``sig``, ...) along tokens at
    places that its path hasn't used, in an order of the node's own."""
    free = F.expr(f"""slice(sort_array(transform(filter(sequence(0, {SIGNATURE - 1}), p -> (shiftright(used, p) & 1L) = 0),
                      p -> struct(xxhash64(node, p) AS h, p AS p))), 1, {math.ceil(DEEP)})""")
    both = F.pmod(F.xxhash64("node", F.lit("last")), F.lit(1000)) < round(1000 * (DEEP - math.ceil(DEEP) + 1))
    out = rows.withColumn("_free", free).withColumn(
        "_p", F.explode(F.when(both, F.col("_free.p")).otherwise(F.slice("_free.p", 1, math.ceil(DEEP) - 1))))
    return (out.withColumn("node", F.xxhash64("node", "_p", F.expr("sig[_p]")))
               .withColumn("used", F.expr("used | shiftleft(1L, _p)")).drop("_free", "_p"))


def tiles(rows: DataFrame) -> DataFrame:
    """The rows of large nodes in a node for every two parts of theirs, so that any
    two rows meet."""
    out = rows.withColumn("_g", F.ceil(F.col("size") / F.lit(NODE))).withColumn(
        "_i", F.pmod(F.xxhash64("k1", "id", "node"), F.col("_g")))
    out = out.withColumn("_j", F.explode(F.expr("filter(sequence(0L, _g - 1), j -> j != _i)")))
    return out.withColumn("node", F.xxhash64("node", F.least("_i", "_j"), F.greatest("_i", "_j"))).drop("_g", "_i", "_j")


def by_node(rows: DataFrame, columns: list[str], schema: str, work) -> DataFrame:
    """Apply ``work`` (a node's rows to result rows) to every node. A node holds a
    bounded number of rows; a task streams its nodes one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kinds, names = [], []

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for b in batches:
            names, kinds = zip(*work(None, b.schema))
            out = []
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][0] != r[0]:
                    out += work(held, None)
                    held = []
                held.append(r)
            if out:
                yield batch(out)
        if held and (out := work(held, None)):
            yield batch(out)

    ordered = rows.select(*columns).repartition("node").sortWithinPartitions("node", "id", "k1")
    return ordered.mapInArrow(tidy(run), schema)


NODE_ROW = ["node", "id", "k1", "n", "comp", "sig"]


def _alike(node: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a node the later rows of other components whose size allows
    the similarity and whose signature agrees often enough."""
    sig = np.array([r[5] for r in node], np.int32)
    n = np.array([r[3] for r in node], np.int64)
    codes = np.unique(np.array([r[4] for r in node]), return_inverse=True)[1].ravel()
    for i in range(len(node) - 1):
        same = (sig[i + 1:] == sig[i]).sum(axis=1) >= AGREE
        same &= codes[i + 1:] != codes[i]
        same &= 100 * np.minimum(n[i + 1:], n[i]) >= 75 * np.maximum(n[i + 1:], n[i])
        if same.any():
            yield i, i + 1 + np.flatnonzero(same)


def plausible(rows: DataFrame) -> DataFrame:
    """The rows of every node that have a likely partner of another component."""

    def work(node, schema):
        if node is None:
            return [(c, schema.field(c).type) for c in NODE_ROW]
        low = [np.frombuffer(r[6], np.uint32) for r in node]
        take: set[int] = set()
        for i, others in _alike(node):
            for j in others.tolist():
                if not (i in take and j in take) and near(low[i], low[j]):
                    take |= {i, j}
        return [node[i][:6] for i in sorted(take)]

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return by_node(rows, [*NODE_ROW, "low"], ", ".join(f"{c} {kinds[c]}" for c in NODE_ROW), work)


def linked_in_nodes(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every node's rows compared exhaustively on their full sets: links (``a``,
    ``b``) between its components. A pair that earlier links of the node have
    joined needs no comparison, so a node gives fewer links than it has rows."""

    def work(node, schema):
        if node is None:
            return [("a", schema.field("id").type), ("b", schema.field("id").type)]
        found = [np.frombuffer(r[6], np.uint64) for r in node]
        shared = None
        first: dict = {}
        parent = [first.setdefault(r[4], i) for i, r in enumerate(node)]

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for i, others in _alike(node):
            mine = root(i)
            for j in [j for j in others.tolist() if root(j) != mine]:
                if shared is None:
                    shared = shared_counts(found)
                union = len(found[i]) + len(found[j]) - shared[i, j]
                if 100 * shared[i, j] >= percent * union and (x := root(i)) != (y := root(j)):
                    parent[max(x, y)] = min(x, y)
                    out.append((node[i][1], node[j][1]))
        return out

    kind = rows.schema["id"].dataType.simpleString()
    joined = rows.join(sets.select("id", "k1", "found"), ["id", "k1"])
    return by_node(joined, [*NODE_ROW, "found"], f"a {kind}, b {kind}", work).distinct()


def likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree often enough and whose least hashes put
    them near the threshold."""
    sides = [classes.select(F.col("id").alias(x), F.col("k1").alias(f"k{x}"), F.col("sig").alias(f"s{x}"),
                            F.col("low").alias(f"l{x}")) for x in "ab"]
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    joined = pairs.join(sides[0], ["a", "ka"]).join(sides[1], ["b", "kb"]).where(agree >= AGREE)
    joined = joined.select("a", "ka", "b", "kb", "la", "lb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [near(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))
                  for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in b.columns[:4]], names=["a", "ka", "b", "kb"])

    kind = joined.schema["a"].dataType.simpleString()
    return joined.mapInArrow(tidy(run), f"a {kind}, ka long, b {kind}, kb long")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                   size: int = 5, trees: int = TREES) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (the smallest
    id reachable over links), ``kept`` (it is that id).

    Null and wordless texts have no shingles and are linked with nothing; texts
    shorter than a shingle are one. Rows of a null id carry a null component, are
    kept and link nothing. Rows that repeat an id are one document: their links
    are joined. Other columns are ignored, whatever their names.
    """
    if percent < 75:
        raise ValueError("the recall of the trees is set for 75 percent and more")
    drawn = written(sketch(docs, id_col, text_col, size), "sketch")
    classes = written(drawn.where("n > 0 AND id IS NOT NULL").groupBy("n", "k1", "k2")
                           .agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("low").alias("low")), "classes")

    roots = classes.select("id", "k1", "n", "sig", F.explode(F.array(*[F.lit(t) for t in range(trees)])).alias("tree"))
    roots = branch(roots.withColumn("node", F.xxhash64("tree")), 0)
    met = roots.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("id", "k1", "n")).alias("head"))
    met = written(met.where("size > 1"), "nodes")
    entries = written(roots.select("node", "tree", "id", "k1", "n")
                           .join(met.select("node", "head", "size"), "node"), "entries")

    def sets_of(wanted: DataFrame, kind: str) -> DataFrame:
        wanted = few(written(wanted.distinct(), f"wanted-{kind}"))  # so that the texts aren't shuffled to be chosen
        return written(full_sets(docs, wanted, id_col, text_col, size), f"sets-{kind}")

    # classes against the first of their nodes, where it is that of two nodes at least
    # (a pair of unlike classes seldom meets twice; what this leaves out, the nodes find)
    heads = entries.where((F.col("id") != F.col("head.id"))
                          & (100 * F.least("n", "head.n") >= percent * F.greatest("n", "head.n")))
    heads = heads.groupBy(F.col("id").alias("a"), F.col("k1").alias("ka"), F.col("head.id").alias("b"),
                          F.col("head.k1").alias("kb")).agg(F.count(F.lit(1)).alias("met")).where("met > 1").drop("met")
    pairs = written(likely_pairs(heads, classes), "pairs")
    sets = sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))), "first")
    links = written(confirm(pairs, sets, percent), "links-first")

    # nodes that still hold several components: small ones whole, large ones branch
    found = written(components(links), "components")
    comp = F.coalesce("component_id", "id")

    def mixed(rows: DataFrame) -> DataFrame:
        sizes = (rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"),
                                          F.max("comp").alias("hi")).where("lo != hi").select("node", "size"))
        return rows.join(sizes, "node")

    rows = mixed(entries.drop("head", "size").join(found, "id", "left").withColumn("comp", comp).drop("component_id"))
    sigs = classes.select("id", "k1", "sig", "low")
    rows = written(rows.join(sigs, ["id", "k1"]), "level-0")
    small, level = [rows.where(F.col("size") <= NODE)], 1
    large = rows.where(F.col("size") > NODE).drop("size")
    while not large.isEmpty() and level < LEVELS:
        rows = written(mixed(branch(large, level)), f"level-{level}")
        small.append(rows.where(F.col("size") <= NODE))
        large, level = rows.where(F.col("size") > NODE).drop("size"), level + 1
    if level == LEVELS:
        # a crowd's sizes are those of its last level; ``used`` has the tree's places so far
        spent = [F.pmod(F.xxhash64(F.lit("place"), "tree") + F.lit(j * 11), F.lit(SIGNATURE)).cast("int").alias("p")
                 for j in range(sum(math.ceil(b) for b in BRANCH))]
        used = reduce(lambda x, y: x.bitwiseOR(y), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in spent])
        rows = rows.where(F.col("size") > NODE).withColumn("used", used)
        last = LEVELS + SIGNATURE - len(spent) - math.ceil(DEEP) + 1
        while True:
            rest = (F.col("size") > TILE) & F.lit(level < last)
            small.append(tiles(rows.where((F.col("size") > NODE) & ~rest)).drop("used"))
            large = rows.where(rest).drop("size")
            if level == last or large.isEmpty():
                break
            rows, level = written(mixed(branch_on(large)), f"level-{level}"), level + 1
            small.append(rows.where(F.col("size") <= NODE).drop("used"))
    rows = written(plausible(reduce(DataFrame.unionByName, small)), "plausible")
    sets = sets_of(rows.select("id"), "nodes")
    links = links.union(written(linked_in_nodes(rows, sets, percent), "links-nodes"))

    # back to the documents: class by set, component by class
    found = written(components(links), "components")
    label = classes.select("n", "k1", "k2", "id").join(found, "id", "left").select(
        "n", "k1", "k2", F.coalesce("component_id", "id").alias("component_id"))
    full = drawn.drop("sig", "low")
    linked = full.where("n > 0 AND id IS NOT NULL").join(label, ["n", "k1", "k2"])
    alone = full.where("n = 0 OR id IS NULL").withColumn("component_id", F.col("id"))
    out = linked.select("id", "n", "component_id").union(alone.select("id", "n", "component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay: of each group its smallest id, one row of
    it (the smallest text, where rows repeat an id); every row without an id."""
    kept = similar_groups(docs, id_col, text_col, **how).where("kept")
    kept = written(kept.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")), "kept")
    none = docs.where(F.col(id_col).isNull())
    out = docs.join(few(kept.where("_rows = 1")), id_col, "left_semi").unionByName(none)
    again = kept.where("_rows > 1")
    if again.isEmpty():
        return out
    # the whole row travels as a value; ties of equal texts by the other columns as JSON, maps too
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    order = F.struct(F.col(text_col).isNull().alias("none"), F.col(text_col).alias("text"), rest.alias("rest"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = docs.join(again, id_col, "left_semi").groupBy(id_col).agg(F.min_by(row, order).alias("_row"))
    return out.unionByName(least.select("_row.*"))
