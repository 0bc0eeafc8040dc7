"""Size-aware heavy-light join of word shingle sets by Jaccard similarity.

Rows with equal sets form one class, which stands for all of them. Two
sets link when their Jaccard similarity reaches ``percent`` / 100, which
asks for an overlap c(n, m) that depends on their sizes alone.

* Small sets (up to a boundary): every set lists its subsets of the fixed
  sizes c that a partner of its size or another small size would share.
  Two sets link exactly when they share such a subset, so each shared
  subset is a star of links; no pair is compared.
* Large sets: inverted lists from shingle to sets, on each set's prefix
  only (its rarest shingles: a set cannot link without sharing one). A
  list up to ``LIST`` long gives its pairs that pass the size and position
  bounds. Longer lists come from groups of near copies; all sets of such a
  list are candidates of each other, and only its entries are kept. Lists
  that are long only because the sketch is too coarse for the text would
  chain sets without likeness into groups: their shingles then go last in
  the order, and the sets are listed again (``_listed``).

Candidates are verified on their full sets, in blocks of a bounded number
of sets: a block counts the overlaps of all its pairs and gives as few
links as connect the same sets. So a group of near copies is never paired
off in rows, and every link between different sets has its effect.

The boundary is where the subsets to list outnumber the list entries to
scan, from the counts of sets by size. Rarity comes from a count-min
sketch of all shingles, sized by the text; it only orders the prefix, with
the shingles that proved to be common after all others.

Shingles, sets and subsets are named by 64-bit hashes (sets by two).

Cases: a null or empty text has an empty set and links with nothing; a
text with fewer words than a shingle is one shingle; equal rows are
copies; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import sketch, textscan
from revlens.llm.components import components
from revlens.llm.stage import materialize, tuned, with_uid
from revlens.session import new_stage_path, remove_folder

WORDS = 5
PERCENT = 80
LIST = 16
MOST_SMALL = 24
CHUNK = 512
# Shingles of a chunk of sets, and subsets or links held before they are passed on.
CHUNK_SHINGLES = 1 << 18
HELD = 1 << 18
# Cells of the rarity sketch: one for so many bytes of text, within bounds.
BYTES_A_CELL = 32
LEVEL_BITS = (22, 25)
SEEN_BITS = 24


def overlap(total, percent: int):
    """Least overlap of two sets whose sizes sum to ``total``: ceil(p * total / (100 + p))."""
    return -(-percent * total // (100 + percent))


def prefix_length(n, percent: int):
    return n - (-(-percent * n // 100)) + 1


def shingles(text: textscan.Text, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles of all rows, number of each row)."""
    low = textscan.lower_ascii(text)
    w = textscan.words(low)
    n = w.counts
    hashes = textscan.span_hash(low.data, w.start, w.end)
    full = textscan.window_hash(hashes, words)
    at = textscan.inside(w.first, words)
    row = textscan.row_of(w.first)[at] if len(at) else at
    value = full[at]
    short = np.flatnonzero((n > 0) & (n < words))
    alone = [textscan.window_hash(hashes[w.first[i] : w.first[i + 1]], int(n[i]))[0] for i in short]
    row, value = np.concatenate([row, short]), np.concatenate([value, np.array(alone, dtype=np.uint64)])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(row[new], minlength=text.rows)


def _names(value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row's set, whatever its order."""
    ends = np.cumsum(n)
    out = []
    for salt in (np.uint64(1), np.uint64(0x632BE59BD9B4E019)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textscan.mix(value + salt))])
        out.append(textscan.mix(total[ends] - total[ends - n] + n.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _sets(docs: DataFrame, order: sketch.Levels, rarity, words: int, percent: int, common=None) -> DataFrame:
    """(_id, n, k1, k2, prefix, entries): each row's set by name and rarest shingles.

    ``entries`` estimates the list entries that its prefix meets. Sets up to
    ``MOST_SMALL`` keep all their shingles. Shingles of the bit set ``common``
    count as the most frequent ones; that it may hold others too does no harm,
    as the order is the same for every set.
    """
    seen = sketch.Seen(SEEN_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                value, n = shingles(text, words)
                k1, k2 = _names(value, n)
                row, level = np.repeat(np.arange(text.rows), n), order.level(rarity.value, value)
                last = seen.holds(common.value, value) if common is not None else np.zeros(len(value), dtype=bool)
                place = np.lexsort((value, level, last, row))
                at = np.arange(len(value)) - np.repeat(np.cumsum(n) - n, n)
                length = np.where(n > 0, prefix_length(n, percent), 0)
                listed = at < length[row]
                entries = np.bincount(row[listed], weights=np.exp2(level[place][listed].astype(float)), minlength=text.rows)
                kept = at < np.where(n <= MOST_SMALL, n, length)[row]
                counts = np.bincount(row[kept], minlength=text.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(text.first, text.rows), pa.array(n, pa.int32()), pa.array(k1), pa.array(k2),
                        textscan.as_arrow_lists(value[place][kept].view(np.int64), counts, pa.int64()), pa.array(entries),
                    ],
                    names=["_id", "n", "k1", "k2", "prefix", "entries"],
                )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, n int, k1 bigint, k2 bigint, prefix array<bigint>, entries double")


def subset_sizes(n: int, boundary: int, percent: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, overlap) of the pairs of small sizes that a set of n belongs to."""
    pairs = [(min(n, m), max(n, m)) for m in range(1, boundary + 1) if 100 * min(n, m) >= percent * max(n, m)]
    return [(a, b, overlap(a + b, percent)) for a, b in pairs]


def choose_boundary(by_size: dict[int, tuple[int, float]], percent: int) -> int:
    """The boundary of least cost, from (sets, list entries met) by size."""

    def cost(boundary: int) -> float:
        light = sum(many * sum(comb(n, c) for _, _, c in subset_sizes(n, boundary, percent)) for n, (many, _) in by_size.items() if n <= boundary)
        return light + sum(met for n, (_, met) in by_size.items() if 100 * n >= percent * (boundary + 1))

    return min(range(MOST_SMALL + 1), key=cost)


def _light_edges(reps: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links between small sets: a star for every subset that is shared."""

    def part(keys, sids, smaller) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, sids, smaller)], names=["key", "sid", "smaller"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sids, smaller, held = [], [], [], 0
        for batch in batches:
            flat, offsets = textscan.from_arrow_lists(batch.column("prefix"))
            for i, sid in enumerate(batch.column("sid").to_pylist()):
                value = np.sort(flat[offsets[i] : offsets[i + 1]].view(np.uint64))
                n = len(value)
                for a, b, c in subset_sizes(n, boundary, percent):
                    # one line a subset
                    chosen = textscan.mix(value[np.array(list(combinations(range(n), c)))])
                    weight = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) for k in range(c)], dtype=np.uint64)
                    key = textscan.mix((chosen * weight).sum(axis=1, dtype=np.uint64) + np.uint64(a * 1000 + b))
                    keys.append(key.view(np.int64))
                    sids.append(np.full(len(key), sid))
                    smaller.append(np.full(len(key), n == a))
                    held += len(key)
                # a set has thousands of subsets: a batch of sets is passed on in parts
                if held >= HELD:
                    yield part(keys, sids, smaller)
                    keys, sids, smaller, held = [], [], [], 0
        if held:
            yield part(keys, sids, smaller)

    rows = materialize(reps.filter(F.col("n").between(1, boundary)).select("sid", "prefix").mapInArrow(run, "key bigint, sid bigint, smaller boolean"), "subsets")
    # larger sets of a subset share enough with the smaller ones, not always with each other
    leaders = rows.groupBy("key").agg(F.min(F.when(F.col("smaller"), F.col("sid"))).alias("a"), F.count("*").alias("many")).filter("many > 1 and a is not null")
    return rows.join(leaders, "key").filter("sid <> a").select("a", F.col("sid").alias("b")).distinct()


def _lists(reps: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Scan the inverted lists: (e, a, na, pa, b). Short lists give candidate
    pairs (b is set), long ones their entries (b is null)."""

    def pairs(sid, n, pos, many: int):
        """Candidate pairs of runs of ``many`` entries each."""
        sid, n, pos = (x.reshape(-1, many).astype(np.int64) for x in (sid, n, pos))
        i, j = np.triu_indices(many, 1)
        a, b, na, nb, ia, ib = sid[:, i], sid[:, j], n[:, i], n[:, j], pos[:, i], pos[:, j]
        ok = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (np.maximum(na, nb) > boundary)
        ok &= np.minimum(na - ia, nb - ib) >= overlap(na + nb, percent)
        return np.minimum(a, b)[ok], np.maximum(a, b)[ok]

    def batch_of(e, a, n, pos, b) -> pa.RecordBatch:
        many = len(a)
        blank = pa.nulls(many, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(e, pa.int64()) if e is not None else blank, pa.array(a, pa.int64()), pa.array(n, pa.int32()) if n is not None else pa.nulls(many, pa.int32()),
             pa.array(pos, pa.int32()) if pos is not None else pa.nulls(many, pa.int32()), pa.array(b, pa.int64()) if b is not None else blank],
            names=["e", "a", "na", "pa", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.int64) for _ in range(4)]
        long_e = None  # the list being read, once it is known to be long

        def scan(rows: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, long_e
            e = rows[0]
            start = np.flatnonzero(np.diff(e, prepend=e[0] ^ 1) != 0)
            many = np.diff(start, append=len(e))
            long_run = many > LIST
            if long_e is not None and e[0] == long_e:
                long_run[0] = True
            open_run = not last
            whole = np.ones(len(start), dtype=bool)
            if open_run:
                whole[-1] = long_run[-1]  # the last list may go on; a long one is passed on as it comes
            at = textscan.gather_ranges(start[long_run], many[long_run])
            if len(at):
                yield batch_of(*(x[at] for x in rows), None)
            long_e = e[-1] if open_run and long_run[-1] else None
            for size in np.unique(many[whole & ~long_run]):
                if size > 1:
                    runs = np.flatnonzero(whole & ~long_run & (many == size))
                    for part in np.array_split(runs, max(1, len(runs) * int(size) ** 2 // (1 << 20))):
                        at = textscan.gather_ranges(start[part], many[part])
                        a, b = pairs(*(x[at] for x in rows[1:]), int(size))
                        if len(a):
                            seen = np.unique(np.stack([a, b], axis=1), axis=0)
                            yield batch_of(None, seen[:, 0], None, None, seen[:, 1])
            held = [x[start[-1] :] if not whole[-1] else x[:0] for x in rows]

        for batch in batches:
            rows = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, ("e", "sid", "n", "pos"))]
            if len(rows[0]):
                yield from scan(rows, False)
        if len(held[0]):
            yield from scan(held, True)

    listed = reps.filter(100 * F.col("n") >= percent * (boundary + 1)).select(
        "sid", "n", F.posexplode(F.slice("prefix", F.lit(1), (F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1).cast("int"))).alias("pos", "e")
    )
    ordered = listed.select("e", "sid", "n", "pos").repartition(F.col("e")).sortWithinPartitions("e")
    return materialize(ordered.mapInArrow(run, "e bigint, a bigint, na int, pa int, b bigint"), "lists")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(sid, shingles) of the wanted (sid, k1, k2), read from the texts again.
    A fixed-size bit set of their names spares the others the shuffle."""
    kind = sketch.Seen(SEEN_BITS)

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column("k1").to_numpy(zero_copy_only=False).view(np.uint64)

    shared = docs.sparkSession.sparkContext.broadcast(sketch.build(wanted.select("k1"), keys_of, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()  # copies within a task are given once
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                value, n = shingles(text, words)
                k1, k2 = _names(value, n)
                hit = np.flatnonzero((n > 0) & kind.holds(shared.value, k1.view(np.uint64)))
                hit = np.array([i for i in hit.tolist() if not (int(k1[i]) in given or given.add(int(k1[i])))], dtype=np.int64)
                if len(hit):
                    flat = value[textscan.gather_ranges((np.cumsum(n) - n)[hit], n[hit])].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(k1[hit]), pa.array(k2[hit]), textscan.as_arrow_lists(flat, n[hit], pa.int64())], names=["k1", "k2", "shingles"])

    found = docs.select("_text").mapInArrow(run, "k1 bigint, k2 bigint, shingles array<bigint>")
    once = found.groupBy("k1", "k2").agg(F.first("shingles").alias("shingles"))
    return materialize(once.join(wanted, ["k1", "k2"]).select("sid", "shingles"), "full-sets")


def linked_in_block(sids: np.ndarray, flat: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the sets of a block as all its links do, by exact
    overlaps of all its pairs (counted shingle by shingle, in slices)."""
    n = len(sids)
    owner = np.repeat(np.arange(n), sizes)
    value, column, many = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.cumsum(many > 1) - 1
    shared = many[column] > 1
    owner, column = owner[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    same = np.zeros((n, n), dtype=np.int64)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [at, at + width]))
        has = np.zeros((n, min(width, int(column[-1]) + 1 - at)), dtype=np.float32)
        has[owner[part], column[part] - at] = 1
        same += (has @ has.T).astype(np.int64)  # whole numbers up to the width: exact
    near = (100 + percent) * same >= percent * (sizes[:, None] + sizes[None, :]).astype(np.int64)
    np.fill_diagonal(near, False)
    left, a, b = np.ones(n, dtype=bool), [], []
    for first in range(n):
        edge = [first] if left[first] else []
        left[first] = False
        while edge:
            at = edge.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            a += [at] * len(new)
            b += new.tolist()
            edge += new.tolist()
    return sids[np.array(a, dtype=np.int64)], sids[np.array(b, dtype=np.int64)]


def _stars(long_lists: DataFrame) -> DataFrame:
    """(a, b): the sets of each long list, tied to its smallest one."""
    lead = long_lists.groupBy("e").agg(F.min("a").alias("b"))
    return materialize(long_lists.join(lead, "e").filter("a <> b").select("a", "b").distinct(), "stars")


def _blocks(pairs: DataFrame, stars: DataFrame, sizes: DataFrame) -> DataFrame:
    """(comp, x, y, sid): which sets meet in which block.

    Candidates are joined to groups: by pairs, and by the ``stars`` of the long
    lists that hold them. A group is dealt into chunks by hash, of about ``CHUNK``
    sets and at most about ``CHUNK_SHINGLES`` shingles by ``sizes`` (sid, n);
    block (x, y) has chunks x and y. Of a group that long lists made, every
    two chunks meet (all its pairs are candidates); of others, those with a
    candidate pair between them.
    """
    comps = components(pairs.unionByName(stars)).join(sizes.withColumnRenamed("sid", "node"), "node")
    crowded = stars.select(F.col("b").alias("node")).distinct().join(comps, "node").select("comp", F.lit(True).alias("crowded")).distinct()
    groups = comps.groupBy("comp").agg(F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int").alias("chunks"))
    chunks = F.col("chunks")
    placed = materialize(
        comps.join(groups.join(crowded, "comp", "left"), "comp").select(
            F.col("node").alias("sid"), "comp", chunks, F.coalesce("crowded", F.lit(False)).alias("crowded"),
            F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"),
        ),
        "groups",
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    dealt = placed.filter("chunks = 1 or crowded").select("sid", "comp", "chunk", other)
    by_pair = placed.filter("chunks > 1 and not crowded").select("sid", "comp", "chunk")
    met = pairs.join(by_pair.withColumnRenamed("sid", "a"), "a").join(by_pair.select(F.col("sid").alias("b"), F.col("chunk").alias("other")), "b")
    met = met.select(F.explode(F.array(F.struct(F.col("a").alias("sid"), "comp", "chunk", "other"), F.struct(F.col("b").alias("sid"), "comp", F.col("other").alias("chunk"), F.col("chunk").alias("other")))).alias("m"))
    every = dealt.unionByName(met.select("m.*").distinct())
    return every.select("comp", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "sid")


def _links(pairs: DataFrame, stars: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the candidates, as few as connect what all of them connect."""

    def meet(table: pa.Table) -> pa.Table:
        flat, offsets = textscan.from_arrow_lists(table.column("shingles"))
        a, b = linked_in_block(table.column("sid").to_numpy(), flat, np.diff(offsets), percent)
        return pa.table({"a": a, "b": b})

    members = _blocks(pairs, stars, sizes).join(sets, "sid")
    return members.select("comp", "x", "y", "sid", "shingles").groupBy("comp", "x", "y").applyInArrow(meet, "a bigint, b bigint")


def _representatives(rows: DataFrame, classes: DataFrame) -> DataFrame:
    return rows.join(classes.select(F.col("sid").alias("uid")), "uid", "left_semi").withColumnRenamed("uid", "sid")


def _copies(stars: DataFrame, many: int) -> int:
    """Copies of sets that the blocks of the groups of ``stars`` take: a set meets
    every chunk of its group. 0 where even a single group would take fewer
    than ``many``, the number of sets."""
    nodes = stars.select("a").unionByName(stars.select(F.col("b").alias("a"))).distinct().count()
    if nodes * ceil(nodes / CHUNK) <= many:
        return 0
    return components(stars).groupBy("comp").agg(F.count("*").alias("size")).agg(F.sum(F.col("size") * F.ceil(F.col("size") / CHUNK))).first()[0]


def _listed(source: DataFrame, order: sketch.Levels, rarity, words: int, percent: int) -> tuple[DataFrame, DataFrame, int, DataFrame, DataFrame]:
    """(rows, classes, boundary, lists, stars of the long lists).

    A sketch with many shingles a cell can't tell which of a set's shingles
    are common, so lists of sets that have little else in common grow long
    and chain up into groups, whose blocks grow with the square. What the
    lists show to be common goes last in the order, and the sets are listed
    by it again, as long as that halves the copies: a group of near copies
    stays, whatever the order.
    """
    kind = sketch.Seen(SEEN_BITS)

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column("e").to_numpy(zero_copy_only=False).view(np.uint64)

    known, common, before = None, None, None
    while True:
        path = new_stage_path(source.sparkSession, "sets")
        rows = materialize(with_uid(_sets(source, order, rarity, words, percent, common)), "sets", path)
        classes = materialize(rows.filter("n > 0").groupBy("k1", "k2").agg(F.min("uid").alias("sid"), F.min("_id").alias("low"), F.min("n").alias("n")), "classes")
        by_size = {r["n"]: (r["many"], r["met"]) for r in rows.filter(F.col("n").between(1, 2 * MOST_SMALL)).groupBy("n").agg(F.count("*").alias("many"), F.sum("entries").alias("met")).collect()}
        boundary = choose_boundary(by_size, percent)
        found = _lists(_representatives(rows, classes), boundary, percent)
        long_lists = found.filter("b is null").select("e", "a")
        stars = _stars(long_lists)
        many = classes.count()
        copies = _copies(stars, many)
        if copies <= many or (before is not None and 2 * copies > before):
            return rows, classes, boundary, found, stars
        before = copies
        # a shingle that was known stays known: it may no longer be in any prefix
        new = long_lists.select("e").distinct()
        known = materialize(new if known is None else known.unionByName(new), "common")
        common = source.sparkSession.sparkContext.broadcast(sketch.build(known, keys_of, kind))
        remove_folder(source.sparkSession, path)


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = WORDS, percent: int = PERCENT, level_bits: tuple[int, int] = LEVEL_BITS) -> DataFrame:
    """(id, n_shingles, component_id) for every row: the size of its set, and
    the smallest id that links reach. ``level_bits`` bounds the rarity sketch (four
    bytes a cell in a task): smaller ones cost shuffle, not results."""
    tuned(docs)
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    size = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    order = sketch.Levels(min(max(ceil(log2(size / BYTES_A_CELL + 1)), level_bits[0]), level_bits[1]))

    def all_shingles(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for text in textscan.slices(batch.column("_text")):
            yield shingles(text, words)[0]

    rarity = docs.sparkSession.sparkContext.broadcast(sketch.build(source.select("_text"), all_shingles, order))
    rows, classes, boundary, found, stars = _listed(source, order, rarity, words, percent)
    reps = _representatives(rows, classes)
    pairs = materialize(found.filter("b is not null").select("a", "b").distinct(), "pairs")
    long_lists = found.filter("b is null").select("e", "a")
    sids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).unionByName(long_lists.select(F.col("a").alias("sid"))).distinct()
    wanted = materialize(classes.join(sids, "sid").select("sid", "n", "k1", "k2"), "wanted")
    sets = _full_sets(source, wanted.drop("n"), words)
    edges = materialize(_links(pairs, stars, wanted.select("sid", "n"), sets, percent).unionByName(_light_edges(reps, boundary, percent)), "links")

    comps = components(edges)
    of_class = classes.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    lowest = of_class.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = of_class.join(lowest, "comp").select("k1", "k2", "component_id")
    return rows.select("_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left").select(
        F.col("_id").alias(id_col), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id")
    )
