"""Similarity join of documents on sets of word shingles, by a forest of count-vector R-trees.

Shingles are hashed into 256 groups; a document's point holds its count in each. The overlap of two
documents is at most the sum of the smaller counts, and for a tree node the sum over the largest
counts in it, so points and whole nodes that cannot reach the needed overlap are left out. Pairs
that survive are verified on the shingle sets.

One tree over all documents would not scale: points of unrelated long texts lie close together. So
the documents are dealt to many trees, losslessly: of n shingles, the n - ceil(0.75 n) + 1 first in
one fixed order are a document's keys, and two documents that link share a key. The order puts
shingles of few documents first (counted over all documents, each by a quarter of its shingles), so
common lines and passages are keys of hardly any document. The keys are counted again, and the trees
of those that a large group shares are dealt out in pieces with pivots of their own.

Every tree is worked in two steps. First its pivot meets all other members: the one with the fewest
rarer shingles, which of a text and its changed copies is the text itself. What then hangs together
needs no more pairs: only in trees that hold several components are members of different components
compared, leaf by leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridweave.llm.common import batches_of, free_name, written
from gridweave.llm.components import components
from gridweave.llm.textvec import mix, shingle_sets

GROUPS = 256
CELLS = 1 << 22  # of the table of shingle frequencies
RARE = 8  # documents that share a trial key, up to which it is not common
NEEDED = 1 << 23  # bits of the table of documents whose sets are to be verified
LEAF = 128
SLOT = 256  # members of a tree that are sorted into leaves together
TEXTS = 1000  # rows a task takes at a time
BLOCK = 4  # slots of a tree that meet the others together
PAIRED = 16  # cells of two blocks a task takes at a time
_LOCAL = 1 << 17  # sets a task remembers, so that it sends a copied set once
COMMON = 128  # members from which a key's tree is dealt out in pieces
_EMITTED = 1 << 20  # pairs a task remembers, so that trees with the same members give them once
EARLIER = 8  # compared trees a member names that it was in before, so that pairs met there are left out

Batches = Iterator[pa.RecordBatch]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _name(s: np.ndarray) -> int:
    """A 64-bit digest that names a set."""
    return int(mix(s.sum(keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def _group(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(GROUPS - 1)).astype(np.int64)


SCANNED = "doc_id long, digest long, n_shingles long, name long, point binary"


def _scan(k: int) -> Callable[[Batches], Batches]:
    """Per text its set's size, name and point."""
    names = [part.split()[0] for part in SCANNED.split(", ")]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            n = batch.num_rows
            got = np.zeros((n, 2), np.int64)
            points = [b""] * n
            for i, s in shingle_sets(batch["text"], k):
                if len(s):
                    got[i] = len(s), _name(s)
                    counts = np.bincount(_group(s), minlength=GROUPS)
                    points[i] = np.minimum(counts, 255).astype(np.uint8).tobytes()
            columns = [pa.array(got[:, 0]), pa.array(got[:, 1]), pa.array(points, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], *columns], names)

    return run


def _new_sets(batch: pa.RecordBatch, k: int, seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Names and sets of a batch that this task has not had lately: a copied set goes out once."""
    for _, s in shingle_sets(batch["text"], k):
        if not len(s) or (name := _name(s)) in seen:
            continue
        if len(seen) >= _LOCAL:
            seen.clear()
        seen.add(name)
        yield name, s


def _first(n: int, share: int) -> int:
    """How many keys a set of n shingles needs to share one with every set it can link with."""
    return n - -(-share * n // 100) + 1


def _trial(k: int, share: int) -> Callable[[Batches], Batches]:
    """Half the hash of what would be the sets' keys in the order of the hashes alone."""

    def run(batches: Batches) -> Batches:
        seen: set[int] = set()
        for batch in batches:
            out, size = [], 0
            for _, s in _new_sets(batch, k, seen):
                out.append(s[: _first(len(s), share)].astype(np.uint32))
                size += len(out[-1])
                if size > 1_000_000:
                    yield _halves(out)
                    out, size = [], 0
            if out:
                yield _halves(out)

    return run


def _halves(out: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int32))], ["half"])


def frequency_classes(texts: DataFrame, k: int, share: int) -> np.ndarray:
    """Per cell of a table of fixed size the log of the most documents that share a trial key there.

    All documents are counted. The classes only order the keys: a shingle that falls into the cell
    of a common one by chance is ordered behind others, no link is lost.
    """
    halves = texts.select("text").mapInArrow(_trial(k, share), "half int").groupBy("half").count()
    cells = (
        halves.filter(F.col("count") > RARE)
        .select(F.col("half").bitwiseAND(CELLS - 1).alias("cell"), F.log2("count").cast("int").alias("c"))
        .groupBy("cell")
        .agg(F.max("c").alias("c"))
        .toArrow()
    )
    table = np.zeros(CELLS, np.uint8)
    table[cells["cell"].to_numpy()] = cells["c"].to_numpy()
    return table


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def _chosen(
    batch: pa.RecordBatch, k: int, share: int, klass: np.ndarray, seen: set[int]
) -> Iterator[tuple[int, np.ndarray, int]]:
    """Name, keys and size of each new set: its first shingles by class of frequency, then by hash."""
    for name, s in _new_sets(batch, k, seen):
        order = np.argsort(klass[_cells(s)], kind="stable")[: _first(len(s), share)]
        yield name, s[order], len(s)


def _chosen_halves(k: int, share: int, classes: bytes) -> Callable[[Batches], Batches]:
    """Half the hash of every key."""

    def run(batches: Batches) -> Batches:
        klass = np.frombuffer(classes, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            out, size = [], 0
            for _, keys, _ in _chosen(batch, k, share, klass, seen):
                out.append(keys.astype(np.uint32))
                size += len(keys)
                if size > 1_000_000:
                    yield _halves(out)
                    out, size = [], 0
            if out:
                yield _halves(out)

    return run


def common_keys(texts: DataFrame, k: int, share: int, classes: bytes) -> bytes:
    """A bit per cell that holds a key of at least COMMON members: the keys themselves are counted,
    as any shingle, counted before or not, can be the key of a large group."""
    cells = (
        texts.select("text")
        .mapInArrow(_chosen_halves(k, share, classes), "half int")
        .groupBy("half")
        .count()
        .filter(F.col("count") >= COMMON)
        .select(F.col("half").bitwiseAND(CELLS - 1).alias("cell"))
        .distinct()
        .toArrow()
    )
    common = np.zeros(CELLS, bool)
    common[cells["cell"].to_numpy()] = True
    return np.packbits(common).tobytes()


def _keys(k: int, share: int, classes: bytes, common: bytes) -> Callable[[Batches], Batches]:
    """A row per set and key."""

    def run(batches: Batches) -> Batches:
        klass = np.frombuffer(classes, np.uint8)
        hot = np.unpackbits(np.frombuffer(common, np.uint8)).view(bool)
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple[int, np.ndarray, int]] = []
            size = 0
            for row in _chosen(batch, k, share, klass, seen):
                out.append(row)
                size += len(row[1])
                if size > 500_000:
                    yield _key_rows(out, hot)
                    out, size = [], 0
            if out:
                yield _key_rows(out, hot)

    return run


def _key_rows(out: list[tuple[int, np.ndarray, int]], hot: np.ndarray) -> pa.RecordBatch:
    lengths = [len(x[1]) for x in out]
    keys = np.concatenate([x[1] for x in out])
    return pa.RecordBatch.from_arrays(
        [
            _signed(keys),
            pa.array(np.repeat(np.array([x[0] for x in out], np.int64), lengths)),
            pa.array(np.repeat(np.array([x[2] for x in out], np.int32), lengths)),
            pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])),
            pa.array(hot[_cells(keys)]),
        ],
        ["key", "name", "n", "place", "common"],
    )


def _wanted(k: int, bits: bytes) -> Callable[[Batches], Batches]:
    """Name and set of the marked texts; a task sends equal ones once."""

    def run(batches: Batches) -> Batches:
        marked = np.frombuffer(bits, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            cell = batch["cell"].to_numpy()
            batch = batch.filter(pa.array((marked[cell >> 3] >> (cell & 7) & 1).astype(bool)))
            out: list[tuple[int, np.ndarray]] = []
            size = 0
            for name, s in _new_sets(batch, k, seen):
                out.append((name, s))
                size += len(s)
                if size > 500_000:
                    yield _set_rows(out)
                    out, size = [], 0
            if out:
                yield _set_rows(out)

    return run


def _set_rows(out: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    offsets = np.cumsum([0] + [len(x[1]) for x in out]).astype(np.int32)
    items = _signed(np.concatenate([x[1] for x in out]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.array([x[0] for x in out], np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets), items),
        ],
        ["name", "items"],
    )


def _marks(ids: DataFrame) -> bytes:
    """A table of fixed size with a bit for the cell of every id."""
    parts = (
        ids.selectExpr("cast(cell >> 3 as int) byte", "1 << cast(cell & 7 as int) bit")
        .groupBy("byte")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(NEEDED // 8, np.uint8)
    bits[parts["byte"].to_numpy()] = parts["bits"].to_numpy().astype(np.uint8)
    return bits.tobytes()


def _id_cell(doc_id: str) -> Column:
    return F.expr(f"xxhash64({doc_id}) & {NEEDED - 1}")


def can_link(a: str, b: str, share: int) -> Column:
    """Whether sizes and the place of a shared key allow a link, for columns n_a, place_a and so on.

    If the key is the first that two sets share in the order of keys, all they share lies at or
    behind its place in both; the first key of every link passes.
    """
    total = F.col(f"n_{a}") + F.col(f"n_{b}")
    behind = lambda x: F.col(f"n_{x}") - F.col(f"place_{x}")
    return (100 + share) * F.least(behind(a), behind(b)) >= share * total


def _verified(pairs: DataFrame, names: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """Pairs (a, b) whose points allow the overlap and whose sets have it."""
    of = lambda x: names.select(*[F.col(c).alias(f"{c}_{x}") for c in names.columns])
    close = written(
        pairs.join(of("a"), F.col("a") == F.col("name_a"))
        .join(of("b"), F.col("b") == F.col("name_b"))
        .select("a", "b", "least_a", "least_b", "n_a", "n_b", "point_a", "point_b")
        .mapInArrow(_bounded(share), "a long, b long, least_a long, least_b long"),
        "close",
        narrow=True,
    )
    # the sets are made anew from the texts of the smallest ids only
    ids = close.select(_id_cell("least_a").alias("cell")).union(close.select(_id_cell("least_b")))
    sets = (
        texts.select("text", _id_cell("doc_id").alias("cell"))
        .mapInArrow(_wanted(k, _marks(ids)), "name long, items array<long>")
        .dropDuplicates(["name"])
    )
    common = F.size(F.array_intersect("s_a", "s_b"))
    return (
        close.select("a", "b")
        .join(sets.select(F.col("name").alias("b"), F.col("items").alias("s_b")), "b")
        .join(sets.select(F.col("name").alias("a"), F.col("items").alias("s_a")), "a")
        .filter(100 * common >= share * (F.size("s_a") + F.size("s_b") - common))
        .select("a", "b")
    )


def _counts(points: pa.Array) -> np.ndarray:
    """Group counts of points, a row each; a full byte stands for any larger count."""
    rows = np.frombuffer(b"".join(points.to_pylist()), np.uint8).reshape(-1, GROUPS).astype(np.int32)
    rows[rows == 255] = 1 << 20
    return rows


def _bounded(share: int) -> Callable[[Batches], Batches]:
    """Pairs whose summed coordinate minima reach the needed overlap."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                least = np.minimum(_counts(part["point_a"]), _counts(part["point_b"])).sum(axis=1)
                total = part["n_a"].to_numpy() + part["n_b"].to_numpy()
                keep[lo : lo + len(least)] = (100 + share) * least >= share * total
            yield batch.filter(pa.array(keep)).select(["a", "b", "least_a", "least_b"])

    return run


def _cell_pairs(share: int) -> Callable[[Batches], Batches]:
    """Members of a cell, by two leaves, that lie in different components and that points and places
    allow to link. Leaves whose boxes cannot reach the overlap are passed over. Most pairs meet in many
    trees: one that met in an earlier tree is left out, and a task sends a pair once."""

    def run(batches: Batches) -> Batches:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for rows, apart in zip(batch["rows"], batch["apart"].to_pylist(), strict=True):
                for a, b in _leaves_met(rows, apart):
                    need = share * (a["n"][:, None] + b["n"][None, :])
                    room = np.minimum(a["behind"][:, None], b["behind"][None, :])
                    ok = (100 + share) * room >= need
                    ok &= a["label"][:, None] != b["label"][None, :]
                    if a is b:
                        ok &= a["name"][:, None] < b["name"][None, :]
                    box = np.minimum(a["box"], b["box"]).sum()
                    if (100 + share) * box < need.min() or not ok.any():
                        continue
                    i, j = np.nonzero(ok)
                    good = []
                    for lo in range(0, len(i), 4096):
                        p, q = i[lo : lo + 4096], j[lo : lo + 4096]
                        new = ~_met_before(a["earlier"][p], b["earlier"][q])
                        least = np.minimum(a["point"][p[new]], b["point"][q[new]]).sum(axis=1)
                        new[new] = (100 + share) * least >= need[p[new], q[new]]
                        good.append(new)
                    good = np.concatenate(good)
                    left, right = a["name"][i[good]], b["name"][j[good]]
                    low, high = np.minimum(left, right), np.maximum(left, right)
                    new = set(zip(low.tolist(), high.tolist(), strict=True)) - sent
                    if len(sent) > _EMITTED:
                        sent.clear()
                    sent |= new
                    if new:
                        pairs = np.array(sorted(new), np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"]
                        )

    return run


def _leaves_met(rows: pa.Scalar, apart: bool) -> Iterator[tuple[dict[str, np.ndarray], dict[str, np.ndarray]]]:
    """Each two leaves of a cell, and each with itself; in a cell of two blocks, one leaf of each."""
    every = _arrays(rows)
    order = np.argsort(every["leaf"], kind="stable")
    cuts = np.flatnonzero(np.diff(every["leaf"][order])) + 1
    leaves = [{c: v[at] for c, v in every.items()} for at in np.split(order, cuts)]
    for leaf in leaves:
        leaf["box"] = leaf["point"].max(axis=0)
    for i, a in enumerate(leaves):
        for b in leaves[i:]:
            if not apart or a["block"][0] != b["block"][0]:
                yield a, b


def _met_before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two members, a row each, name a common earlier tree; 0 stands for none."""
    return ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] != 0)).any(axis=(1, 2))


def _arrays(cell: pa.Scalar) -> dict[str, np.ndarray]:
    rows = cell.values
    flat = {
        c: rows.field(c).to_numpy(zero_copy_only=False) for c in ("name", "label", "n", "place", "leaf", "block")
    }
    size = flat["n"].astype(np.int64)
    earlier = rows.field("earlier").flatten().to_numpy().reshape(-1, EARLIER)
    return flat | {
        "n": size, "behind": size - flat["place"], "point": _counts(rows.field("point")), "earlier": earlier,
    }


def _rest(members: DataFrame, names: DataFrame, labels: DataFrame, share: int) -> DataFrame:
    """Candidate pairs across components, in the trees of more than two that hold several."""
    named = members.join(labels.withColumnRenamed("node", "name"), "name", "left").select(
        "key", "name", "n", "place", F.coalesce("label", "name").alias("label")
    )
    # many trees have the same members: the one of the first of their keys is enough. A member has
    # one row per tree, or equal names would cancel in the xor
    trees = (
        named.groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.count("*").alias("m"),
            F.min("place").alias("place"),
            F.bit_xor(F.xxhash64("name")).alias("x1"),
            F.bit_xor(F.xxhash64("name", F.lit(7))).alias("x2"),
        )
        .filter("low <> high and m > 2")
        .groupBy("m", "x1", "x2")
        .agg(F.min(F.struct("place", "key"))["key"].alias("key"))
        .select("key", "m")
    )
    # slots by the true size of the tree: no task sorts a large one, and leaves stay full
    slots = F.ceil(F.col("m") / SLOT)
    # two members of one tree that were both in an earlier one have met there: places only grow in the
    # order of keys, so that all that lets them meet now let them meet then
    mine = Window.partitionBy("name").orderBy("place")
    rows = (
        named.join(trees, "key")
        .withColumn("slot", F.pmod(F.hash("name").cast("long"), slots))
        .withColumn("earlier", F.array(*[F.lag("key", i, 0).over(mine) for i in range(1, EARLIER + 1)]))
        .join(names.select("name", "point"), "name")
    )
    # leaves: neighbours by size, then by point, so that their boxes are narrow
    order = Window.partitionBy("key", "slot").orderBy("n", "point", "name")
    number = F.floor((F.row_number().over(order) - 1) / LEAF)
    # a tree is a grid of blocks of leaves. Each two blocks meet in a cell of their own, so no task has
    # more than two blocks of a tree, and a leaf is sent once to a cell, not once for each leaf it meets
    blocks = F.ceil(slots / BLOCK)
    block = F.floor(F.col("slot") / BLOCK)
    cells = (
        rows.withColumn("leaf", F.col("slot") * F.lit(1 << 32) + number)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .groupBy("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .agg(
            F.collect_list(F.struct("name", "label", "n", "place", "leaf", "block", "point", "earlier")).alias("rows"),
            F.min("label").alias("label_low"),
            F.max("label").alias("label_high"),
        )
        .filter("label_low <> label_high")
        .select("rows", (F.col("low") < F.col("high")).alias("apart"))
    )
    return cells.mapInArrow(_cell_pairs(share), "a long, b long").distinct()


def jaccard_components(docs: DataFrame, k: int = 5, share: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id per row of `docs` (columns doc_id, text).

    Words are runs of all but space and 09-0D, A-Z lower-cased. Two texts link when 100 times their
    shared k-word shingles reach `share` times their united ones. Texts of fewer words have one
    shingle, the whole; null, empty and wordless texts have none and link with nothing: their
    component is their own id. Rows that share a doc_id are each judged by their own text. Rows
    without doc_id link with nothing and have a null component. Equal sets are one node, named by a
    64-bit digest; shingles are compared by 64-bit hashes. Texts of any length are read whole. An
    empty table gives no rows; other columns are ignored.
    """
    return _classes(docs, k, share).select("doc_id", "n_shingles", "component_id")


def _classes(docs: DataFrame, k: int, share: int) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, label, component_id of every row; the label names the
    component, and is null for rows that link with nothing by definition."""
    with batches_of(docs.sparkSession, TEXTS):
        return _classified(docs, k, share)


def _classified(docs: DataFrame, k: int, share: int) -> DataFrame:
    """The rows of `_classes`. All Python tasks run here: what is returned reads stored tables."""
    spark = docs.sparkSession
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest")
    )
    texts = every.filter("doc_id is not null")
    seen = written(every.mapInArrow(_scan(k), SCANNED), "scanned")
    rows = seen
    classes = frequency_classes(texts, k, share).tobytes()
    common = common_keys(texts, k, share, classes)
    names = written(
        rows.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("name")
        .agg(
            F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.max("point").alias("point")
        ),
        "names",
    )

    keys = texts.select("text").mapInArrow(
        _keys(k, share, classes, common), "key long, name long, n int, place int, common boolean"
    )
    # trees of common keys are dealt out in pieces with pivots of their own
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("common"), F.pmod(F.hash("name"), F.lit(pieces))).otherwise(0)
    piece = Window.partitionBy("key", "salt")
    met = (
        keys.withColumn("salt", salt)
        .select(
            "key", "salt", "name", "n", "place", "common",
            F.min(F.struct("place", "name", "n")).over(piece).alias("head"),
            F.min("name").over(piece).alias("low"),
            F.max("name").over(piece).alias("high"),
        )
        .filter("low <> high or common")
    )
    # a set copied in several tasks has equal rows, which lie in one piece: no further shuffle
    members = written(met.drop("low", "high").distinct(), "members")
    heads = members.filter("common and name = head.name").select("key", "name", "n", "place").distinct()
    first = heads.groupBy("key").agg(F.min(F.struct("place", "name", "n")).alias("head"))
    stars = (
        members.select("head", "name", "n", "place")
        .union(heads.join(first, "key").select("head", "name", "n", "place"))
        .filter("name <> head.name")
        .select(
            F.least("name", "head.name").alias("a"),
            F.greatest("name", "head.name").alias("b"),
            F.col("head.n").alias("n_a"),
            F.col("n").alias("n_b"),
            F.col("head.place").alias("place_a"),
            F.col("place").alias("place_b"),
        )
        .filter(100 * F.least("n_a", "n_b") >= share * F.greatest("n_a", "n_b"))
        .filter(can_link("a", "b", share))
        .select("a", "b")
        .distinct()
    )

    links = written(_verified(stars, names, texts, k, share), "links", narrow=True)
    labels = components(links)
    with batches_of(spark, PAIRED):
        rest = written(_rest(members.drop("head", "common"), names, labels, share), "rest", narrow=True)
    if rest.limit(1).count():
        more = _verified(rest, names, texts, k, share)
        labels = components(written(links.union(more), "links", narrow=True))

    class_of = (
        names.select("name", "least")
        .join(labels.withColumnRenamed("node", "name"), "name", "left")
        .withColumn("label", F.coalesce("label", "name"))
    )
    smallest = class_of.groupBy("label").agg(F.min("least").alias("component_id"))
    found = class_of.join(smallest, "label").select("name", "label", "component_id")
    rows = rows.drop("point")
    some = rows.filter("n_shingles > 0 and doc_id is not null").join(found, "name")
    none = rows.filter("n_shingles = 0 or doc_id is null").withColumns(
        {"label": F.lit(None).cast("long"), "component_id": F.col("doc_id")}
    )
    columns = ["doc_id", "digest", "n_shingles", "label", "component_id"]
    return some.select(*columns).union(none.select(*columns))


def keep_one(docs: DataFrame, k: int = 5, share: int = 75) -> DataFrame:
    """One row of `docs` of each group of linked texts: that of the smallest doc_id, of several with
    that id the one with the smallest digest of its text. Columns and other rows stay.

    Every row is judged by its own text, also where rows share a doc_id. Of rows repeated with one
    doc_id and text one stays, whatever their other columns. Rows without doc_id, and with a null,
    empty or wordless text, link with nothing. An empty table gives no rows; other columns, of
    whatever names, are passed on.
    """
    columns = docs.columns
    own, digest = free_name("own", columns), free_name("digest", columns)
    rows = written(_classes(docs, k, share).filter("doc_id is not null"), "classes", narrow=True)
    heads = rows.filter("label is not null").groupBy("label").agg(
        F.min(F.struct("doc_id", "digest")).alias("head")
    )
    others = rows.join(heads, "label").filter(F.struct("doc_id", "digest") != F.col("head"))
    repeated = rows.groupBy("doc_id", "digest").count().filter("count > 1")
    # ids and digests are small beside the texts: written first, their exact size plans the joins
    renamed = lambda df: df.select(F.col("doc_id").alias(own), F.col("digest").alias(digest))
    dropped = written(renamed(others).distinct(), "dropped", narrow=True)
    twice = written(renamed(repeated), "twice", narrow=True)
    keyed = docs.withColumns({own: F.col("doc_id").cast("long"), digest: F.xxhash64("text")})
    kept = keyed.join(dropped, [own, digest], "left_anti")
    if not twice.isEmpty():
        first = kept.join(twice, [own, digest], "left_semi").dropDuplicates([own, digest])
        kept = kept.join(twice, [own, digest], "left_anti").unionByName(first)
    return kept.select(*columns)
