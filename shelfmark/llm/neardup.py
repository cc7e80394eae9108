"""Near-duplicate groups of documents: SuperMinHash, banding, verification on full sets, union-find."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_words, by_bytes
from shelfmark.session import stored

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Plan:
    """How documents are compared.

    Two documents are linked if the intersection of their sets of ``shingle``-word shingles has at
    least ``percent`` hundredths of their union. Signatures have ``bands * rows`` registers. At a
    similarity of 0.85 a pair shares no band in about 3 of 10 million cases with the default, at
    0.8 in 5 of 100,000. ``likely`` is the estimate below which a pair with a common band is not
    verified; it lies more than five standard deviations under the threshold.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 6
    slack: float = 0.16

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def likely(self) -> float:
        return self.percent / 100 - self.slack


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Each text's sorted distinct 64-bit shingle hashes.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. A text of fewer
    words than ``shingle`` is one shingle as a whole; one without words, or null, has none.
    """
    words, bounds = ascii_words(pc.ascii_lower(texts))
    codes = pc.dictionary_encode(words.cast(pa.large_binary()))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in codes.dictionary.to_pylist()), np.uint64, len(codes.dictionary))
    w = hashes[codes.indices.to_numpy(zero_copy_only=False)] if len(codes) else hashes
    rolled = w
    for i in range(1, shingle):
        rolled = _mix(rolled[: len(w) - i] * _GOLD + w[i:]) if len(w) > i else rolled[:0]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= shingle:
            found = np.sort(rolled[a : b - shingle + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif b > a:
            whole = xxhash.xxh3_64_intdigest(w[a:b].tobytes(), seed=b - a)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(w[:0])
    return out


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """SuperMinHash registers, one row a set: ``step << 32 | fraction``; all ones for an empty set.

    Every element draws a random permutation of the registers and a fraction for each step; at
    step j it offers j plus its fraction to the j-th register of its permutation, and registers
    keep the least. As later steps only offer more, a set whose registers are all taken stops.
    The elements of all sets go through a step together. A permutation is known by its swaps so
    far: ``value`` holds what each of them put at ``place``.
    """
    registers = np.full((len(sets), size), _EMPTY, np.uint64)
    lens = np.fromiter(map(len, sets), np.int64, len(sets))
    element = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), lens)
    place: list[np.ndarray] = []
    value: list[np.ndarray] = []
    for step in range(size):
        if not len(element):
            break
        draw = _mix(element + np.uint64(int(_GOLD) * (step + 1) & (2**64 - 1)))
        at = (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(size - step)) >> np.uint64(32)).astype(np.int16) + np.int16(step)
        mine, here = at.copy(), np.full(len(at), step, np.int16)
        for p, v in zip(place, value, strict=True):
            np.copyto(mine, v, where=p == at)
            np.copyto(here, v, where=p == step)
        np.minimum.at(registers.reshape(-1), owner * size + mine, np.uint64(step << 32) | (draw >> np.uint64(32)))
        open_ = (registers == _EMPTY).any(axis=1)[owner]
        place.append(at)
        value.append(here)
        if not open_.all():
            element, owner = element[open_], owner[open_]
            place, value = [p[open_] for p in place], [v[open_] for v in value]
    return registers


def signatures(docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """(key, id, mark, n, print, bands, sig, marks): one row a document.

    ``key`` numbers rows, ``mark`` hashes texts, ``print`` the sets; ``marks`` has the bands as bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, "t", 4 << 20):
            sets = shingle_sets(batch.column("t"), plan.shingle)
            prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            # copies within a batch share their registers
            where = {p: i for i, p in enumerate(prints) if p is not None}
            order = {p: n for n, p in enumerate(where)}
            registers = super_minhash([sets[i] for i in where.values()], plan.size)
            mixed = _mix(registers).reshape(len(where), plan.bands, plan.rows)
            band = np.broadcast_to(np.arange(1, plan.bands + 1, dtype=np.uint64) * _GOLD, (len(where), plan.bands))
            for r in range(plan.rows):
                band = _mix(band + mixed[:, :, r])
            band, sig = band.astype(np.int64), (mixed.reshape(len(where), plan.size) & np.uint64(0xFF)).astype(np.uint8)
            rows = [order.get(p) for p in prints]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key + np.arange(len(sets))), batch.column("i"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array([None if r is None else band[r] for r in rows], pa.list_(pa.int64())),
                    pa.array([None if r is None else sig[r].tobytes() for r in rows], pa.binary()),
                    pa.array([None if r is None else band[r].tobytes() for r in rows], pa.binary()),
                ],
                names=["key", "id", "mark", "n", "print", "bands", "sig", "marks"],
            )
            key += len(sets)

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"), F.xxhash64(docs[text_col]).alias("mark"))
    return wanted.mapInArrow(run, f"key long, id {kind}, mark long, n long, print binary, bands array<long>, sig binary, marks binary")


def _elements(wanted: DataFrame, classes: DataFrame, docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """(cls, elements): the full sets of the classes ``wanted`` (cls), cut from their texts again."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            found = shingle_sets(batch.column("t"), plan.shingle)
            prints = batch.column("print").to_pylist()
            same = [i for i, s in enumerate(found) if xxhash.xxh3_128_digest(s.tobytes()) == prints[i]]
            blobs = pa.array([found[i].tobytes() for i in same], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("cls").take(pa.array(same, pa.int64())), blobs], names=["cls", "elements"])

    needed = wanted.distinct().join(classes.select("cls", "print", "low"), "cls")
    texts = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    cut = needed.join(texts, texts["i"].eqNullSafe(needed["low"])).select("cls", "print", "t")
    return stored(cut.mapInArrow(sets, "cls long, elements binary").dropDuplicates(["cls"]), "neardup-sets")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, elements: DataFrame, plan: Plan) -> DataFrame:
    """Of the pairs (a, b) of classes, those whose full sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("x", "y")]
            keep = [i for i, (x, y) in enumerate(zip(*sides, strict=True)) if _similar(x, y, plan.percent)]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return (
        pairs.join(elements.toDF("a", "x"), "a").join(elements.toDF("b", "y"), "b")
        .select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")
    )


_GROUP = ["bucket", "t", "p"]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by group."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if len(table):
            same = [pc.equal(table[c], table[c][-1]) for c in _GROUP]
            cut = len(table) - pc.sum(pc.and_(pc.and_(same[0], same[1]), same[2])).as_py()
            rest = table.slice(cut)
            if cut:
                yield table.slice(0, cut)
    if rest is not None and len(rest):
        yield rest


class _Cell:
    """The rows of a group: targets, probes, and which of them are likely pairs."""

    def __init__(self, table: pa.Table, plan: Plan) -> None:
        self.cls, self.comp, self.probe = (table[c].to_numpy() for c in ("cls", "comp", "probe"))
        self.sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(table), -1)
        self.bands = np.frombuffer(b"".join(table["marks"].to_pylist()), np.int64).reshape(len(table), -1)
        self.band = int(np.flatnonzero(self.bands[0] == table["bucket"][0].as_py())[0])
        self.targets, self.least = np.flatnonzero(~self.probe), plan.size * plan.likely

    def likely(self, i: int) -> np.ndarray:
        """Targets of other components whose signatures are like the probe's, in no earlier bucket with it."""
        to = self.targets[self.comp[self.targets] != self.comp[i]]
        to = to[(self.sig[to] == self.sig[i]).sum(axis=1) >= self.least]
        return to[(self.bands[to] == self.bands[i]).argmax(axis=1) == self.band]


def _cells(table: pa.Table) -> Iterator[pa.Table]:
    keys = [table[c].to_numpy() for c in _GROUP]
    cuts = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(table)], strict=True):
        yield table.slice(a, b - a).combine_chunks()


def _crossing(members: DataFrame, plan: Plan, block: int = 1024) -> DataFrame:
    """Rows of groups in which likely pairs that share a bucket, but not a component, meet.

    ``members`` is (bucket, cls, comp, sig, marks). Buckets of one component are done. In another, the
    members outside the component of its least member probe all members. Targets are cut into
    blocks and probes too, so that no group (bucket, t, p) has much more than two blocks. Rows
    without a likely partner in their group are left out.
    """
    # one row a bucket: sizes of targets and probes
    first = members.groupBy("bucket").agg(F.min(F.struct("cls", "comp"))["comp"].alias("home"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
    first = first.where("lo <> hi").select("bucket", "home", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    open_ = members.join(first, "bucket").withColumn("h", F.xxhash64("cls"))
    spread = F.sequence(F.lit(0), F.col("blocks") - 1)
    mine = F.pmod("h", F.col("blocks")).cast("int")
    rest = ["cls", "comp", "sig", "marks"]
    targets = open_.select("bucket", mine.alias("t"), F.explode(spread).alias("p"), F.lit(False).alias("probe"), *rest)
    probes = open_.where("comp <> home").select("bucket", F.explode(spread).alias("t"), mine.alias("p"), F.lit(True).alias("probe"), *rest)
    used = probes.select("bucket", "p").distinct()  # blocks without a probe need no targets
    targets = targets.join(used, ["bucket", "p"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _grouped(batches):
            for table in _cells(whole):
                cell, used = _Cell(table, plan), np.zeros(len(table), bool)
                for i in np.flatnonzero(cell.probe).tolist():
                    found = cell.likely(i)
                    used[found] = True
                    used[i] = len(found) > 0
                if used.any():
                    yield from table.filter(pa.array(used)).to_batches()

    groups = targets.unionByName(probes)
    return _sorted(groups).mapInArrow(run, groups.schema)


def _sorted(groups: DataFrame) -> DataFrame:
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return groups.repartition(n, *_GROUP).sortWithinPartitions(*_GROUP)


def _bridges(rows: DataFrame, elements: DataFrame, plan: Plan) -> DataFrame:
    """Links (a, b) between components, verified on full sets inside the groups of `_crossing`.

    Each likely pair is compared in one group, unless links found there already join its components.
    So a group passes on fewer links than it has rows, however many pairs it compares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _grouped(batches):
            links = []
            for table in _cells(whole):
                cell = _Cell(table, plan)
                sets = [np.frombuffer(v, np.uint64) for v in table["elements"].to_pylist()]
                up = {c: c for c in cell.comp.tolist()}

                def root(x: int, up: dict[int, int] = up) -> int:
                    while up[x] != x:
                        up[x] = x = up[up[x]]
                    return x

                for i in np.flatnonzero(cell.probe).tolist():
                    for j in cell.likely(i).tolist():
                        a, b = root(int(cell.comp[i])), root(int(cell.comp[j]))
                        if a != b and _similar(sets[i], sets[j], plan.percent):
                            up[a] = b
                            links.append((int(cell.cls[i]), int(cell.cls[j])))
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return _sorted(rows.join(elements, "cls")).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(cls, comp): the least id reachable from every end of the links (a, b).

    Each task first joins its own links by union-find and passes on one link a node. Then nodes
    take the least label among their neighbours and follow labels to labels until nothing
    changes. State is written to the shared folder each round.
    """

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        def out() -> pa.RecordBatch:
            nodes = list(up)
            columns = [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())]
            up.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    up[max(x, y)] = min(x, y)
            if len(up) > 500_000:
                yield out()
        yield out()

    links = edges.mapInArrow(forest, "a long, b long").where("a <> b")
    links = stored(links.union(links.select("b", "a")).distinct(), "neardup-links")
    labels = stored(links.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.col("a")).alias("comp")), "neardup-labels")
    while True:
        near = links.join(labels.toDF("b", "near"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("near").alias("near"))
        step = labels.join(near, "cls").select("cls", F.least("comp", "near").alias("next"), "comp")
        beyond = labels.toDF("next", "beyond")
        new = stored(step.join(beyond, "next", "left").select("cls", F.least("next", "beyond").alias("comp"), (F.least("next", "beyond") < F.col("comp")).alias("moved")), "neardup-labels")
        if new.where("moved").isEmpty():
            return new.select("cls", "comp")
        labels = new.select("cls", "comp")


def groups(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, mark, doc_id, n_shingles, component_id, first): the near-duplicate group of every row.

    ``component_id`` is the smallest id in the group (null if all ids are null), ``first`` is true
    for one row of each group, that with the smallest id (nulls last). A row without words is a
    group of its own. Rows may repeat and ids may be null or repeat: groups are of rows. Other
    columns are not read.

    Equal sets become one class first. Classes that share a band are candidates. First each class
    is verified against the least member of those of its buckets that name it most often; then all
    likely pairs within a bucket that are still in different components are compared inside tasks.
    So a large group of copies costs a few rows a member, and no likely pair is left out.
    """
    sigs = stored(signatures(docs, plan, id_col, text_col), "neardup-sigs")
    classes = stored(
        sigs.where("n > 0").groupBy("print").agg(F.min("key").alias("cls"), F.min("id").alias("low")), "neardup-classes"
    )
    reps = classes.join(sigs.select(F.col("key").alias("cls"), "bands", "sig", "marks"), "cls")
    buckets = reps.select(F.explode("bands").alias("bucket"), "cls")
    centers = buckets.groupBy("bucket").agg(F.min("cls").alias("center"), F.count("*").alias("size")).where("size > 1")
    shared = stored(buckets.join(centers, "bucket").select("bucket", "cls", "center"), "neardup-buckets")
    votes = shared.where("cls <> center").groupBy("cls", "center").agg(F.count("*").alias("n"))
    pairs = stored(
        votes.groupBy("cls").agg(F.max_by("center", F.struct("n", -F.col("center"))).alias("center")).select(F.col("center").alias("a"), F.col("cls").alias("b")),
        "neardup-pairs",
    )
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b"))
    edges = stored(_verified(pairs, _elements(wanted, classes, docs, plan, id_col, text_col), plan), "neardup-edges")
    comp = components(edges)
    members = (
        shared.select("bucket", "cls").join(comp, "cls", "left").join(reps.select("cls", "sig", "marks"), "cls")
        .select("bucket", "cls", F.coalesce("comp", "cls").alias("comp"), "sig", "marks")
    )
    rest = stored(_crossing(members, plan), "neardup-rest")
    if not rest.isEmpty():
        more = _bridges(rest, _elements(rest.select("cls"), classes, docs, plan, id_col, text_col), plan)
        edges = edges.union(stored(more, "neardup-edges"))
        comp = components(edges)
    linked = classes.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    least = linked.groupBy("comp").agg(F.min("low").alias("component_id"))
    of_print = stored(linked.join(least, "comp").select("print", "comp", "component_id"), "neardup-groups")
    rows = sigs.select("key", "id", "mark", "n", "print").join(of_print, "print", "left")
    # the first row of each group: one row a group, combined before the shuffle
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    heads = rows.where("comp is not null").groupBy("comp").agg(F.min(order)["key"].alias("head"))
    return rows.join(heads, "comp", "left").select(
        "key", "mark", F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("comp").isNull() | (F.col("key") == F.col("head"))).alias("first"),
    )


def one_of_each(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each near-duplicate group is kept.

    Rows that repeat in id and text are one document and leave one row.
    """
    found = stored(groups(docs, plan, id_col, text_col).select("doc_id", "mark", "first"), "neardup-found")
    first = found.where("first").select("doc_id", "mark").distinct()
    mark = F.xxhash64(docs[text_col])
    kept = docs.join(first, docs[id_col].eqNullSafe(first["doc_id"]) & (mark == first["mark"]), "left_semi")
    if found.groupBy("doc_id", "mark").count().where("count > 1").isEmpty():
        return kept
    own = "mark" + "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    return kept.withColumn(own, F.xxhash64(text_col)).dropDuplicates([id_col, own]).drop(own)
