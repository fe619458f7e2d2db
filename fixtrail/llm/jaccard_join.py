"""Similarity join of documents by the Jaccard similarity of their word n-grams.

Two sets of similarity ``t`` share their rarest tokens: ordered from rare to frequent, the first
``n - ceil(t n) + l`` tokens of both have ``l`` in common. Every document chooses its own ``l``: its prefix is lengthened
until the candidates it is expected to meet that often fall under a target, and a pair has to share the smaller of
both ``l`` before it is verified. Tokens of the shortest prefix (``l = 1``) are keys, as any linked pair shares one of them; the
longer prefix is for counting only, so that lengthening never adds frequent keys. Verification compares whole sets.

1. One pass reads the texts: equal sets are one class, and all tokens are counted in a fixed number of cells by
   hash, which gives the order from rare to frequent and is what is broadcast. Only classes are compared, copies are
   members. Any order all agree on is correct.
2. A second pass writes the prefix of every class. Its keys are grouped with map-side sums that hold all of a
   list of up to three classes; only keys of longer lists are shuffled once more.
3. Every class is first compared with the one class it meets in most lists (in a longer list, with a few pivots), then, where
   lists still hold several components, with a few more pivots. These links join most of a group of near copies.
4. Lists that still hold several components give all pairs across components, each pair once, at the first key both
   have: no earlier key may be common, and what is left of both sets behind that key has to be enough. So no link between
   components is missed, and pairs that are already connected are never made. The pairs of a list are looked through inside a
   task, by maps of bits of prefix and whole set; only what these can't rule out becomes a row. Long lists are cut into blocks,
   and each pair of blocks is a group of its own.
5. Components of all links; a component is named by its smallest doc_id.

Sets are 64-bit hashes of the n-grams; a class is known by 64 bits of a hash of its set. Words are
ASCII-lowered runs without white space. A text with fewer words than the n-gram is one token. Texts
that are null or without words are linked with nothing. Null ids take part; a component of null ids only
has a null name. Repeated rows are members of one class. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.llm.components import components
from fixtrail.llm.words import hashed_words, mixed, shingle_hashes
from fixtrail.operators.staging import stage, staging_scope

#: Tokens are counted in 2^CELL_BITS cells by hash: 8 MB in all, sent in rows of CELLS_PER_ROW.
CELL_BITS = 22
CELLS_PER_ROW = 1 << 16
#: Expected candidates of a document that its prefix is lengthened for.
TARGET = 16
#: The most shared tokens that a prefix is lengthened for.
MOST_SHARED = 64
PIVOTS = 3
#: Rounds of comparing classes with those they meet most often: pivot orders among the lists, and partners that
#: a class tries. The last step has no such bound, so this decides how a link is found, never whether.
ROUNDS = ((1, 1), (8, 4))
#: Words of 64 bits in the map of a prefix, and in that of a whole set, which go with its keys into the last step: few
#: tokens share a bit.
MAP_WORDS = 16
#: Rows of a list that a task compares with each other; longer lists are cut into blocks.
LIST_ROWS = 4096
#: Bits of a map by which rows that can't be wanted are left out before a shuffle: 8 MB, whatever the input.
MARK_BITS = 26
#: Tokens that a task counts at once.
TOKENS_HELD = 2_000_000


def _ceil_share(n: np.ndarray | int, percent: int):
    return -(-n * percent // 100)


class Order:
    """From rare to frequent by the counts of hash cells, then by hash.

    A cell counts all tokens that fall into it, so no token is more frequent than its cell.
    """

    def __init__(self, levels: np.ndarray, total: int) -> None:
        self._levels = levels
        self._usual = total / len(levels)  # other tokens in a cell

    @staticmethod
    def level(counts: np.ndarray) -> np.ndarray:
        return np.minimum(np.log2(1.0 + counts) * 2048, 65535).astype(np.uint16)

    def prefix(self, tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
        """The document's prefix and how many of its tokens a partner has to share.

        Documents met ``l`` times make up ``l`` of all meetings each, so there are at most meetings / l of them.
        """
        level = self._levels[tokens >> np.uint64(64 - CELL_BITS)]
        order = np.lexsort((mixed(tokens), level))
        least = int(_ceil_share(len(tokens), percent))
        base = len(tokens) - least + 1
        most = min(least, MOST_SHARED)
        meetings = np.cumsum(np.maximum(np.exp2(level[order[: base + most - 1]] / 2048.0) - 2.0 - self._usual, 0.0))
        candidates = meetings[base - 1 :] / np.arange(1, most + 1)
        few = np.flatnonzero(candidates <= TARGET)
        shared = int(few[0] if len(few) else candidates.argmin()) + 1
        return tokens[order[: base + shared - 1]], shared


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _signature(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _read_once(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, row_key, class (null without words) and n_shingles of every row; besides, rows with block and cells only.

    The latter count the tokens of a partition's sets in 2^CELL_BITS cells, a fixed number of bytes.
    """
    names = ["doc_id", "row_key", "class", "n_shingles", "block", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        cells = np.zeros(1 << CELL_BITS, np.uint16)
        held: list[np.ndarray] = []
        n = 0

        def add() -> None:
            at, times = np.unique(np.concatenate(held) >> np.uint64(64 - CELL_BITS), return_counts=True)
            cells[at] += np.minimum(times, 65535 - cells[at]).astype(np.uint16)

        for batch in batches:
            classes, sizes = [], []
            for words in hashed_words(batch["text"]):
                tokens = shingle_hashes(words, size)
                sizes.append(len(tokens))
                classes.append(_signature(tokens) if len(tokens) else None)
                if len(tokens) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    held.append(tokens)
                    n += len(tokens)
                    if n > TOKENS_HELD:
                        add()
                        held, n = [], 0
            nothing = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
            columns = [batch["doc_id"], batch["row_key"], pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), *nothing]
            yield pa.record_batch(columns, names)
        if held:
            add()
        blocks = [zlib.compress(x.tobytes(), 1) for x in cells.reshape(-1, CELLS_PER_ROW)] if seen else []
        for k in range(0, len(blocks), 32):
            some = blocks[k : k + 32]
            nothing = [pa.nulls(len(some), pa.int64())] * 4
            yield pa.record_batch([*nothing, pa.array(range(k, k + len(some)), pa.int32()), pa.array(some, pa.binary())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, row_key long, class long, n_shingles long, block int, cells binary")


def _token_order(parts: DataFrame, total: int) -> Order:
    """The order by the counts of all partitions; what reaches the driver has a fixed size."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch["block"].to_pylist(), batch["cells"].to_pylist(), strict=True):
                more = np.frombuffer(zlib.decompress(cells), np.uint16)
                if block in sums:
                    sums[block] += more
                else:
                    sums[block] = more.astype(np.int64)
        columns = [pa.array(list(sums), pa.int32()), pa.array([Order.level(x).tobytes() for x in sums.values()], pa.binary())]
        yield pa.record_batch(columns, ["block", "cells"])

    found = parts.repartition("block").mapInArrow(add_up, "block int, cells binary")
    levels = np.zeros((-(-(1 << CELL_BITS) // CELLS_PER_ROW), CELLS_PER_ROW), np.uint16)
    for row in stage(found, "token_cells").toLocalIterator():
        levels[row["block"]] = np.frombuffer(row["cells"], np.uint16)
    return Order(levels.ravel(), total)


def _bit_map(tokens: np.ndarray) -> bytes:
    bits = np.zeros(64 * MAP_WORDS, bool)
    bits[tokens & np.uint64(64 * MAP_WORDS - 1)] = True
    return np.packbits(bits).tobytes()


def _prefixes(docs: DataFrame, keys: DataFrame, order: Order, size: int, percent: int) -> DataFrame:
    """class, n, shared, prefix (tokens from rare to frequent) and maps (of prefix and set) of every set.

    Read from the rows among ``keys``, the first of every class. Few other rows are there too, so a list hardly
    counts a class twice.
    """
    shared_order, marks = (docs.sparkSession.sparkContext.broadcast(x) for x in (order, Marks(keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            names, sizes, needed, prefixes, maps = [], [], [], [], []
            for words in hashed_words(batch["text"].filter(pa.array(marks.value.hit(batch["hash"].to_numpy())))):
                tokens = shingle_hashes(words, size)
                name = _signature(tokens) if len(tokens) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                prefix, shared = shared_order.value.prefix(tokens, percent)
                names.append(name)
                sizes.append(len(tokens))
                needed.append(shared)
                prefixes.append(prefix.view(np.int64))
                maps.append(_bit_map(prefix) + _bit_map(tokens))
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            columns = [pa.array(c, pa.int64()) for c in (names, sizes, needed)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.record_batch([*columns, lists, pa.array(maps, pa.binary())], ["class", "n", "shared", "prefix", "maps"])

    texts = docs.select(F.xxhash64(_row_key()).alias("hash"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "class long, n long, shared long, prefix array<long>, maps binary")


class Marks:
    """A bit map of fixed size of some 64-bit hashes: tells which values certainly don't belong to them."""

    def __init__(self, values: DataFrame) -> None:
        """``values`` has one column of hashes; its 2^MARK_BITS cells reach the driver as at most that many bits."""
        (name,) = values.columns
        cells = values.select(F.shiftrightunsigned(F.xxhash64(name), 64 - MARK_BITS).alias("cell"))
        bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
        words = cells.select(F.shiftright("cell", 6).cast("int").alias("word"), bit.alias("bit"))
        found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.bits = np.zeros(1 << (MARK_BITS - 6), np.uint64)
        self.bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)

    def hit(self, hashed: np.ndarray) -> np.ndarray:
        """``hashed``: xxhash64 of the values, as computed by Spark."""
        cell = hashed.view(np.uint64) >> np.uint64(64 - MARK_BITS)
        return (self.bits[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _marked(rows: DataFrame, column: str, marks: Marks) -> DataFrame:
    """The rows whose value may belong to the marked ones."""
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = shared.value.hit(batch["_hash"].to_numpy())
            yield batch.drop_columns(["_hash"]).filter(pa.array(hit))

    return rows.withColumn("_hash", F.xxhash64(column)).mapInArrow(run, rows.schema)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("class")).unionAll(pairs.select(F.col("y").alias("class")))


def _whole_sets(docs: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """class and tokens (sorted, as bytes) of the classes whose first row is among ``keys``; others may be there too."""
    rows = docs.select(_row_key().alias("key"), F.col("text").cast("string").alias("text"))
    marks = docs.sparkSession.sparkContext.broadcast(Marks(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].filter(pa.array(marks.value.hit(batch["hash"].to_numpy())))
            sets = [shingle_hashes(words, size) for words in hashed_words(texts)]
            sets = [x for x in sets if len(x)]
            columns = [pa.array([_signature(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.record_batch(columns, ["class", "tokens"])

    hashed = rows.select(F.xxhash64("key").alias("hash"), "text")
    # by class, and so are the joins that follow
    return hashed.mapInArrow(run, "class long, tokens binary").groupBy("class").agg(F.any_value("tokens").alias("tokens"))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar enough; only sets of a pair are made and shuffled."""
    both = pairs = stage(pairs, "promising_pairs")
    keys = classes.join(_ends(pairs).distinct(), "class", "left_semi").select("key")
    sets = _whole_sets(docs, keys, size)
    for v in ("x", "y"):
        both = both.join(sets.select(F.col("class").alias(v), F.col("tokens").alias(f"tokens_{v}")), v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(batch[c][k].as_buffer(), np.uint64) for c in ("tokens_x", "tokens_y"))
                common = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["x", "y"]).filter(pa.array(kept, pa.bool_()))

    return both.select("x", "y", "tokens_x", "tokens_y").mapInArrow(run, "x long, y long")


def _links(docs: DataFrame, classes: DataFrame, parts: DataFrame, size: int, percent: int) -> DataFrame | None:
    """class, root of all classes that are linked with another."""
    total, sets = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if sets < 2:
        return None
    prefixes = stage(_prefixes(docs, classes.select("key"), _token_order(parts, total), size, percent), "prefixes")
    base = F.size("prefix") - F.col("shared").cast("int") + 1
    keys = prefixes.select("class", F.posexplode(F.slice("prefix", F.lit(1), base)).alias("place", "token"))
    lists = stage(
        keys.groupBy("token")
        .agg(F.count("*").alias("rows"), F.min("class").alias("a"), F.max("class").alias("b"), F.bit_xor("class").alias("all"))
        .where(F.col("a") != F.col("b")),
        "lists",
    )
    # with up to three rows, smallest, largest and the sum of bits tell them all
    three = F.array("a", "b", F.col("all").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b")))
    short = lists.where("rows <= 3").select(three.alias("c"))
    couple = lambda i, j: F.struct(F.least(F.col("c")[i], F.col("c")[j]).alias("x"), F.greatest(F.col("c")[i], F.col("c")[j]).alias("y"))
    short_pairs = stage(
        short.select(F.inline(F.array_distinct(F.array(couple(0, 1), couple(0, 2), couple(1, 2))))).where("x < y").groupBy("x", "y").count(),
        "short_pairs",
    )
    long_tokens = lists.where("rows > 3").select("token")
    postings = stage(
        _marked(keys, "token", Marks(long_tokens)).join(long_tokens, "token", "left_semi").dropDuplicates(["token", "class"]), "long_lists"
    )
    sizes = stage(
        prefixes.groupBy("class").agg(*[F.any_value(c).alias(c) for c in ("n", "shared")], F.any_value(F.size("prefix")).alias("length"))
        .join(postings.groupBy("class").agg(F.count("*").alias("long")), "class", "left").fillna(0, ["long"]),
        "sizes",
    )

    def alike(common: Column) -> Column:
        """Common tokens are in both prefixes or behind one of them, and have to make up the similarity."""
        after = F.greatest(F.col("n_x") - F.col("length_x"), F.col("n_y") - F.col("length_y"))
        return (
            (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y"))
            & (common >= F.least("shared_x", "shared_y"))
            & ((100 + percent) * (common + after) >= percent * (F.col("n_x") + F.col("n_y")))
        )

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs (x, y, short) that can share enough: their common keys are the ``short`` ones, which were counted, some of the
        long ones, and what their prefixes have been lengthened by."""
        for v in ("x", "y"):
            pairs = pairs.join(sizes.select(F.col("class").alias(v), *[F.col(c).alias(f"{c}_{v}") for c in ("n", "shared", "length", "long")]), v)
        return pairs.where(alike(F.col("short") + F.least("long_x", "long_y") + F.col("shared_x") + F.col("shared_y") - 2)).select("x", "y")

    def prefixes_of(classes_: DataFrame) -> DataFrame:
        found = _marked(prefixes, "class", Marks(classes_))
        return found.groupBy("class").agg(*[F.any_value(c).alias(c) for c in ("n", "shared", "prefix", "maps")])

    def promising(pairs: DataFrame) -> DataFrame:
        """Pairs (x, y) whose prefixes share enough."""
        pairs = stage(pairs, "possible_pairs")
        heads = prefixes_of(_ends(pairs))
        for v in ("x", "y"):
            side = [F.col(c).alias(f"{c}_{v}") for c in ("n", "shared", "prefix")]
            pairs = pairs.join(heads.select(F.col("class").alias(v), F.size("prefix").alias(f"length_{v}"), *side), v)
        return pairs.where(alike(F.size(F.array_intersect("prefix_x", "prefix_y")))).select("x", "y")

    links, groups = None, None
    open_lists, open_pairs = postings.select("token", "class", F.col("class").alias("root")), short_pairs
    for spread, tries in ROUNDS:
        # lists draw their pivots by one of ``spread`` orders, so a round tries a few pivots in all lists of a group
        order = [F.xxhash64("class", F.pmod("token", F.lit(spread)), F.lit(k)) for k in range(PIVOTS)]
        pivots = open_lists.groupBy("token").agg(
            *[F.min(F.struct(o, "class", "root")).getField(name).alias(f"{name}{k}") for k, o in enumerate(order) for name in ("class", "root")]
        )
        choices = F.array(*[F.struct(F.col(f"class{k}").alias("y"), F.col(f"root{k}").alias("s")) for k in range(PIVOTS)])
        met = (
            open_lists.join(pivots, "token")
            .select(F.col("class").alias("x"), F.filter(F.array_distinct(choices), lambda p: p["s"] != F.col("root")).alias("ps"))
            .where(F.size("ps") > 0)
            .groupBy("x", "ps")
            .count()
            .select("x", F.explode("ps.y").alias("y"), "count")
        )
        met = met.select("x", "y", "count", F.lit(0).cast("long").alias("short"))
        for x, y in (("x", "y"), ("y", "x")):
            met = met.unionAll(open_pairs.select(F.col(x).alias("x"), F.col(y).alias("y"), "count", F.col("count").alias("short")))
        met = met.groupBy("x", "y").agg(F.sum("count").alias("count"), F.sum("short").alias("short"))
        ranked = F.struct((-F.col("count")).alias("less"), F.xxhash64("y").alias("h"), "y", "short")
        best = met.groupBy("x").agg(_nth(ranked, tries).alias("best")).select("x", F.explode("best").alias("b"))
        near = best.select(F.least("x", "b.y").alias("x"), F.greatest("x", "b.y").alias("y"), "b.short")
        found = _verified(promising(possible(near.groupBy("x", "y").agg(F.max("short").alias("short")))), docs, classes, size, percent)
        links = stage(found if links is None else links.unionAll(found), "links")
        groups = stage(components(links), "groups").select(F.col("node").alias("class"), "root")
        # only what lies across components goes on
        renamed = postings.join(groups, "class", "left").withColumn("root", F.coalesce("root", "class"))
        several = renamed.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where(F.col("r") != F.col("s"))
        open_lists = stage(renamed.join(several.select("token"), "token", "left_semi"), "open_lists")
        open_pairs = short_pairs
        for v in ("x", "y"):
            open_pairs = open_pairs.join(groups.select(F.col("class").alias(v), F.col("root").alias(f"root_{v}")), v, "left")
        across = F.coalesce("root_x", "x") != F.coalesce("root_y", "y")
        open_pairs = stage(open_pairs.where(across).select("x", "y", "count"), "open_pairs")

    heads = prefixes_of(open_lists.select("class").distinct())
    rooted = open_lists.groupBy("class").agg(F.any_value("root").alias("root"), F.sort_array(F.collect_list(F.struct("place", "token"))).alias("keys"))
    placed = rooted.join(heads.select("class", "n", "shared", F.size("prefix").cast("long").alias("length"), "maps"), "class").select(
        "*", F.posexplode("keys").alias("at", "key")
    )
    placed = placed.select(
        "class", "root", "n", "shared", "length", "maps", F.col("key.place").cast("long").alias("place"), F.col("key.token").alias("token"),
        F.slice(F.col("keys.token"), F.lit(1), F.col("at")).alias("before"),
    )
    met = _pairs_across(placed, open_lists.groupBy("token").count(), percent)
    short_ones = possible(open_pairs.select("x", "y", F.col("count").alias("short")))
    last = promising(met.unionAll(short_ones).distinct())
    return components(links.unionAll(_verified(last, docs, classes, size, percent))).select(F.col("node").alias("class"), "root")


def _pairs_across(placed: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of different roots that meet in a list and may be similar, each at its first common key.

    ``placed`` has a row for each class of a list, ``counts`` the rows of each list (token). A task compares up to
    ``LIST_ROWS`` rows of a list with each other, or two blocks of a longer list.
    """
    sizes = counts.select("token", F.ceil(F.col("count") / LIST_ROWS).cast("long").alias("blocks"))
    own = placed.join(sizes, "token").withColumn("block", F.pmod(F.xxhash64("class"), "blocks"))
    blocks = own.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    groups = blocks.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("blocks", "other")
    by = ("token", "low", "high")
    names = [f.name for f in groups.schema if f.dataType.simpleString() == "bigint"]

    def compared(rows: pa.Table) -> pa.RecordBatch:
        c = {name: rows[name].to_numpy() for name in names}
        own, root, n, shared, length = (c[x] for x in ("class", "root", "n", "shared", "length"))
        behind = n - c["place"]  # this key and what may follow
        maps = np.frombuffer(b"".join(rows["maps"].to_pylist()), np.uint64).reshape(-1, 2, MAP_WORDS)
        before = rows["before"].combine_chunks()
        group = np.cumsum(_changes(rows, by))
        sets: dict[int, set[int]] = {}

        def keys_before(k: int) -> set[int]:
            if k not in sets:
                sets[k] = set(before[k].as_py())
            return sets[k]

        def enough(common: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return (100 + percent) * common >= percent * (n[i] + n[j])

        found: list[tuple[int, int]] = []
        i = np.arange(len(own))
        for step in range(1, len(own)):
            i = i[: np.searchsorted(i, len(own) - step)]
            i = i[group[i] == group[i + step]]
            if not len(i):
                break
            j = i + step
            ok = (root[i] != root[j]) & ((c["low"][i] == c["high"][i]) | (c["block"][i] != c["block"][j]))
            ok &= (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & enough(np.minimum(behind[i], behind[j]), i, j)
            a, b = i[ok], j[ok]
            # every mark that only one of both has is a token that only it has
            only_a, only_b = (np.bitwise_count(maps[v] & ~maps[w]).sum(axis=2, dtype=np.int64) for v, w in ((a, b), (b, a)))
            common = np.minimum(length[a] - only_a[:, 0], length[b] - only_b[:, 0])
            after = np.maximum(n[a] - length[a], n[b] - length[b])
            ok = (common >= np.minimum(shared[a], shared[b])) & enough(common + after, a, b)
            ok &= enough(np.minimum(n[a] - only_a[:, 1], n[b] - only_b[:, 1]), a, b)
            pairs = zip(a[ok].tolist(), b[ok].tolist(), strict=True)
            found += [(x, y) for x, y in pairs if keys_before(x).isdisjoint(keys_before(y))]
        ends = own[np.array(found, np.int64).reshape(-1, 2)]
        return pa.record_batch([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            rows = pa.Table.from_batches([*held, batch])
            held = [batch]
            if rows.num_rows:
                last = int(np.flatnonzero(_changes(rows, by))[-1])  # its list may go on in the next batch
                if last:
                    yield compared(rows.slice(0, last))
                held = rows.slice(last).to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    return groups.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "x long, y long")


def _changes(rows: pa.Table, by: tuple[str, ...]) -> np.ndarray:
    """Where a row differs from the one before it; the first one does."""
    out = np.zeros(rows.num_rows, bool)
    out[:1] = True
    for name in by:
        values = rows[name].to_numpy()
        out[1:] |= values[1:] != values[:-1]
    return out


def _nth(ranked: Column, n: int) -> Column:
    """An array of the ``n`` first structs of a group, with map-side selection."""
    return F.array(F.min(ranked)) if n == 1 else F.slice(F.sort_array(F.collect_list(ranked)), 1, n)


def similar_groups(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, component_key for every row of ``docs`` (a scan).

    ``row_key`` is xxhash64(doc_id, text); ``component_key`` is that of the component's first document.
    """
    spark = docs.sparkSession
    both = stage(_read_once(docs, size), "signatures")
    rows = both.where(F.col("block").isNull()).select("doc_id", "row_key", "class", "n_shingles")
    parts = both.where(F.col("block").isNotNull()).select("block", "cells")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    classes = stage(
        rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.first("n_shingles").alias("n"), F.min("row_key").alias("key"), first),
        "classes",
    )
    with staging_scope(spark):
        linked = _links(docs, classes, parts, size, percent)
        if linked is not None:
            linked = stage(linked, "components", outlives=True)
    if linked is None:
        named = classes.select("class", "first")
    else:
        rooted = classes.join(linked, "class", "left").withColumn("root", F.coalesce("root", "class"))
        named = rooted.select("class", "root").join(rooted.groupBy("root").agg(F.min("first").alias("first")), "root").select("class", "first")
    out = rows.join(named, "class", "left")
    alone = F.col("first").isNull()
    return out.select(
        "doc_id", "row_key", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.col("row_key")).otherwise(F.col("first.row_key")).alias("component_key"),
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand first in their component, once each, with all columns."""
    kept = similar_groups(docs, size, percent).where(F.col("row_key") == F.col("component_key")).select(F.col("row_key").alias("_key")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_key().alias("_key"))
    first = rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"])
    return first.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
