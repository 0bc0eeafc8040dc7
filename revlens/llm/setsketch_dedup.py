"""Near-duplicate groups by SetSketch registers.

Every row's set of word shingles gets ``rows`` x ``bands`` registers. Each
holds the smallest exponentially distributed hash of the set on a scale of
powers of ``BASE``, truncated to one byte: K = 1 - floor(log_b(h)), from 0
to 255. Registers of a union are the larger ones of its parts, so sketches
merge; two sets share a register with a chance just above their Jaccard
similarity.

1. Rows with equal sets form one class, which one row stands for.
2. Bands of ``rows`` registers name buckets. At a similarity of 0.8 two sets
   share none of 64 bands of 6 with a chance of 3e-9 (``missed``).
3. Stars: each bucket's first set is a candidate pair with every other.
   Buckets are dealt by ranges of (bucket, set), so a bucket that holds a
   third of all sets is spread over many tasks, each with a star of its own.
4. Estimate: from the registers that are larger, smaller and equal, and both
   set sizes, the likelihood of each similarity follows (p_b of the SetSketch
   paper). A pair goes on unless 0.8 or more is e**``CUT`` times less likely
   than the best fit.
5. Verification on full sets, as a stream: a leader's set, then the sets that
   are to be compared with it; crowded leaders are dealt over several tasks.
6. Buckets whose sets are not yet in one component get another star, around
   a hub: the set that most often stands in what is left. Of every set
   there, the part outside its hub is kept. Two
   sets u, v of one hub share at most min(|u & hub|, |v & hub|) shingles
   inside it, so to link they share a known number of shingles outside it:
   v is looked up by the rarest shingles that u has outside the hub, by size
   of v. Where no such number follows (sets that the hub contains), pairs
   are compared directly. Only sets that do not link with their hub look up
   others, since the rest is one component already.
   So a group of near copies costs a few comparisons a set, pairs that can't
   link are never listed, and no candidate pair that could join two
   components is left out.

Cases: a null or empty text, or one without words, has an empty set, is
linked with nothing and kept; a text with fewer words than a shingle is one
shingle; equal rows are copies; very long texts are sketched whole, their
registers end at 255; a null id counts only where its group has no other
(then the component is null and the row kept); extra columns are ignored
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm import sketch, textscan
from revlens.llm.components import contracted, joined_by
from revlens.llm.jaccard_join import _names, shingles
from revlens.llm.stage import materialize, tuned, with_uid

WORDS = 2
PERCENT = 80
ROWS = 6
BANDS = 64
BASE = 1.1
RATE = 20.0
TOP = 255
CUT = 20.0
# Ratio of the sizes that are looked up together.
SIZES = 1.04
# Sets of a crowded bucket that are handed on at once and sets estimated beside one leader, and members of a leader in one task.
CHUNK = 512
MEMBERS = 4096
# Values hashed at once: their products stay in the processor's cache.
PIECE = 1 << 15


def missed(similarity: float = PERCENT / 100, rows: int = ROWS, bands: int = BANDS) -> float:
    """The chance that two sets share no band."""
    return (1 - similarity**rows) ** bands


def _multipliers(m: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = textscan.mix(np.arange(1, 2 * m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    odd = (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return odd[:m], odd[m:]


def registers(value: np.ndarray, n: np.ndarray, m: int) -> np.ndarray:
    """(rows, m) registers of the sets given one after another, n values each (0 for an empty set)."""
    out = np.zeros((len(n), m), dtype=np.uint8)
    filled = np.flatnonzero(n)
    if not len(filled):
        return out
    start = np.cumsum(n) - n
    least = np.full((len(filled), m), 0xFFFFFFFF, dtype=np.uint32)
    low, high = value.astype(np.uint32), (value >> np.uint64(32)).astype(np.uint32)
    a, c = _multipliers(m)
    begin = start[filled]
    for at in range(0, len(value), PIECE):
        to = min(at + PIECE, len(value))
        first = int(np.searchsorted(begin, at, side="right")) - 1
        last = int(np.searchsorted(begin, to))
        cut = np.maximum(begin[first:last], at) - at
        x, y = low[at:to], high[at:to]
        for i in range(m):
            part = np.minimum.reduceat(x * a[i] + y * c[i], cut)
            np.minimum(least[first:last, i], part, out=least[first:last, i])
    hashed = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    out[filled] = np.clip(1 - np.floor(np.log(hashed) / log(BASE)), 0, TOP).astype(np.uint8)
    return out


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / log(BASE)


def likelihood(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Log likelihood of ``similarity``, from the registers of a that are
    larger than, smaller than and equal to those of b."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    up, down = _p(np.maximum(u - v * similarity, 1e-12)), _p(np.maximum(v - u * similarity, 1e-12))
    return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))


def plausible(larger: np.ndarray, smaller: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes and registers may reach the similarity."""
    n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    equal = m - larger - smaller
    goal = np.minimum(percent / 100, most)
    at_goal = likelihood(larger, smaller, equal, n_a, n_b, goal)
    best = at_goal
    for share in np.linspace(0, 1, 41):  # below the goal; above it the pair passes anyway
        best = np.maximum(best, likelihood(larger, smaller, equal, n_a, n_b, goal * share))
    return fits & (best - at_goal <= CUT)


def _sketched(source: DataFrame, words: int, m: int) -> DataFrame:
    """(_id, n, k1, k2, registers) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in textscan.slices(batch.column("_text")):
                value, n = shingles(text, words)
                k1, k2 = _names(value, n)
                table = registers(value, n, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(text.first, text.rows), pa.array(n, pa.int64()), pa.array(k1), pa.array(k2),
                        pa.array([table[i].tobytes() if n[i] else b"" for i in range(text.rows)], pa.binary()),
                    ],
                    names=["_id", "n", "k1", "k2", "registers"],
                )

    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, n bigint, k1 bigint, k2 bigint, registers binary")


def _matrix(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, m)


def _bucket_names(table: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """(sets, bands) bucket names; the last bits tell the band."""
    out = np.zeros((len(table), bands), dtype=np.uint64)
    parts = table.reshape(len(table), bands, rows)
    for k in range(rows):
        out = textscan.mix(out * np.uint64(0x100000001B3) + parts[:, :, k] + np.uint64(k + 1))
    low = np.uint64((1 << ceil(log2(max(bands, 2)))) - 1)
    return (textscan.mix(out + np.arange(bands, dtype=np.uint64)) & ~low) | np.arange(bands, dtype=np.uint64)


def _buckets(reps: DataFrame, rows: int, bands: int) -> DataFrame:
    """(key, sid): the buckets of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = _bucket_names(_matrix(batch.column("registers"), rows * bands), rows, bands).view(np.int64)
                sid = np.repeat(batch.column("sid").to_numpy(zero_copy_only=False), bands)
                yield pa.RecordBatch.from_arrays([pa.array(names.reshape(-1)), pa.array(sid)], names=["key", "sid"])

    return reps.select("sid", "registers").mapInArrow(run, "key bigint, sid bigint")


def _stars(buckets: DataFrame) -> DataFrame:
    """(key, sid, lead, edge) of the buckets with two sets or more. ``lead`` is
    the first set of the bucket's part in a task. ``edge`` marks a bucket that
    may go on in another task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), dtype=np.int64)
        state = {"first": True, "lead": None, "key": None, "on": False}

        def scan(rows: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            key, sid = rows
            start = np.flatnonzero(np.diff(key, prepend=key[0] ^ 1) != 0)
            many = np.diff(start, append=len(key))
            lead = sid[start].copy()
            go_on = state["key"] is not None and key[0] == state["key"]
            if go_on:
                lead[0] = state["lead"]
            edge = np.zeros(len(start), dtype=bool)
            edge[0] = state["first"] or (go_on and state["on"])
            edge[-1] |= last
            keep = (many > 1) | edge
            if go_on:
                keep[0] = True
            whole = np.ones(len(start), dtype=bool)
            if not last:
                # the last bucket may go on: a small one waits, a crowded one is passed on as it comes
                whole[-1] = many[-1] > CHUNK or (go_on and len(start) == 1)
                if not whole[-1]:
                    keep[-1] = False
            state["key"], state["lead"], state["on"] = (key[-1], lead[-1], bool(edge[-1])) if not last and whole[-1] else (None, None, False)
            if whole[0]:
                state["first"] = False
            held = rows[:, start[-1] :] if not whole[-1] else rows[:, :0]
            at = textscan.gather_ranges(start[keep], many[keep])
            if len(at):
                n = many[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at]), pa.array(sid[at]), pa.array(np.repeat(lead[keep], n)), pa.array(np.repeat(edge[keep], n))], names=["key", "sid", "lead", "edge"]
                )

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "sid")])
            rows = np.concatenate([held, rows], axis=1)
            if rows.shape[1]:
                yield from scan(rows, False)
        if held.shape[1]:
            yield from scan(held, True)

    dealt = buckets.select("key", "sid").repartitionByRange("key", "sid").sortWithinPartitions("key", "sid")
    return dealt.mapInArrow(run, "key bigint, sid bigint, lead bigint, edge boolean")


def _star_pairs(stars: DataFrame) -> DataFrame:
    """(a, b): leaders with their sets, and the leaders of a bucket's parts."""
    heads = stars.filter("edge").groupBy("key").agg(F.min("lead").alias("a"), F.collect_set("lead").alias("leads")).select("a", F.explode("leads").alias("b"))
    return stars.select(F.col("lead").alias("a"), F.col("sid").alias("b")).unionByName(heads).filter("a <> b").distinct()


def _parts(pairs: DataFrame, most: int) -> DataFrame:
    """(a, b, part): the pairs of a leader a dealt over parts of about ``most``."""
    crowded = pairs.groupBy("a").agg(F.ceil(F.count("*") / most).cast("int").alias("parts")).filter("parts > 1")
    # at most one leader in ``most`` pairs
    return pairs.join(F.broadcast(crowded), "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))


def _roles(parts: DataFrame, reps: DataFrame, *columns: str) -> DataFrame:
    """(sid, a, part, role, columns): for every part its leader a (role 0) and
    the sets that it is paired with (role 1), with the sets' columns."""
    leaders = parts.select(F.col("a").alias("sid"), "a", "part", F.lit(0).alias("role")).distinct()
    members = parts.select(F.col("b").alias("sid"), "a", "part", F.lit(1).alias("role"))
    return leaders.unionByName(members).join(reps.select("sid", *columns), "sid").select("sid", "a", "part", "role", *columns)


def _estimated(pairs: DataFrame, reps: DataFrame, m: int, percent: int) -> DataFrame:
    """The roles, with the sets' names, of the pairs whose registers allow the
    similarity. Each leader's registers pass once a part, before those of its
    sets; a leader may come more than once."""
    names = ["sid", "a", "part", "role", "k1", "k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last leader: its sets may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in [*names, "n"]] + [_matrix(batch.column("registers"), m)]
            if held is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(held, rows)]
            a, part, role, n, table = rows[1], rows[2], rows[3], rows[6], rows[7]
            lead = np.maximum.accumulate(np.where(role == 0, np.arange(len(a)), -1))
            held = [x[lead[-1]][None] for x in rows]
            if (lead < 0).any() or (a[lead] != a).any() or (part[lead] != part).any():
                raise ValueError("a leader's registers are missing")
            b = np.flatnonzero((role == 1) & (100 * np.minimum(n[lead], n) >= percent * np.maximum(n[lead], n)))
            of = lead[b]
            b = b[plausible((table[of] > table[b]).sum(axis=1), (table[of] < table[b]).sum(axis=1), m, n[of], n[b], percent)]
            go_on = np.concatenate([np.unique(lead[b]), b])
            yield pa.RecordBatch.from_arrays([pa.array(x[go_on]) for x in rows[:6]], names=names)

    roles = _roles(materialize(_parts(pairs, CHUNK), "parts"), reps, "k1", "k2", "n", "registers")
    ordered = roles.repartition("a", "part").sortWithinPartitions("a", "part", "role")
    return materialize(ordered.mapInArrow(run, "sid bigint, a bigint, part int, role int, k1 bigint, k2 bigint"), "plausible")


def _full_sets(source: DataFrame, roles: DataFrame, words: int) -> DataFrame:
    """(k1, k2, shingles) of the sets of ``roles``, and maybe of some more: a
    bit set sized by about their number spares most others the shuffle."""
    kind = sketch.Seen(min(27, max(20, ceil(log2(16 * (roles.agg(F.approx_count_distinct("k1")).first()[0] + 1))))))

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column("k1").to_numpy(zero_copy_only=False).view(np.uint64)

    shared = source.sparkSession.sparkContext.broadcast(sketch.build(roles.select("k1"), keys_of, kind))

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

    return source.select("_text").mapInArrow(run, "k1 bigint, k2 bigint, shingles array<bigint>")


def held_by(leader: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values the sorted ``leader`` holds."""
    return leader[np.minimum(np.searchsorted(leader, values), len(leader) - 1)] == values


def _compared(roles: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, n, same, near, rest) of the pairs (a, b) of ``roles``, a the leader:
    the size of b, how many shingles both share, whether that reaches the
    similarity, and the shingles that b alone has. A pair may come more than once."""
    sets = _full_sets(source, roles, words).join(roles, ["k1", "k2"]).select("a", "part", "role", "sid", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, leader = None, None
        for batch in batches:
            flat, offsets = textscan.from_arrow_lists(batch.column("shingles"))
            flat = flat.view(np.uint64)
            a, part, role, sid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "part", "role", "sid"))
            start = np.flatnonzero((np.diff(a, prepend=a[0] ^ 1 if len(a) else 0) != 0) | (np.diff(part, prepend=-1) != 0) | (np.diff(role, prepend=-1) != 0))
            for i, to in zip(start.tolist(), [*start[1:].tolist(), len(a)]):
                if role[i] == 0:
                    of, leader = (a[i], part[i]), flat[offsets[i] : offsets[i + 1]].copy()
                    continue
                if of != (a[i], part[i]):
                    raise ValueError("a leader's set is missing")
                counts, own = np.diff(offsets[i : to + 1]), flat[offsets[i] : offsets[to]]
                shared = held_by(leader, own)
                same = np.add.reduceat(shared, offsets[i:to] - offsets[i], dtype=np.int64)
                near = 100 * same >= percent * (len(leader) + counts - same)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[i:to]), pa.array(sid[i:to]), pa.array(counts), pa.array(same), pa.array(near), textscan.as_arrow_lists(own[~shared].view(np.int64), counts - same, pa.int64())],
                    names=["a", "b", "n", "same", "near", "rest"],
                )

    ordered = sets.repartition("a", "part").sortWithinPartitions("a", "part", "role")
    return ordered.mapInArrow(run, "a bigint, b bigint, n bigint, same bigint, near boolean, rest array<bigint>")


def _verified(roles: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that reach the similarity on their full sets."""
    return _compared(roles, source, words, percent).filter("near").select("a", "b")


def _open(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(key, sid, comp) of the buckets that hold more than one component."""
    placed = materialize(buckets.join(comps.withColumnRenamed("node", "sid"), "sid", "left").select("key", "sid", F.coalesce("comp", "sid").alias("comp")), "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
    return materialize(placed.join(mixed, "key", "left_semi"), "open")


def _hub_pairs(rest: DataFrame) -> DataFrame:
    """(a, b): a hub for each open bucket, with the bucket's other sets."""
    sizes = rest.groupBy("key").agg(F.count("*").alias("size"))
    seen = materialize(rest.join(sizes, "key").groupBy("sid").agg(F.sum("size").alias("seen")), "seen")
    hubs = rest.join(seen, "sid").groupBy("key").agg(F.max(F.struct("seen", (-F.col("sid")).alias("less"))).alias("hub")).select("key", (-F.col("hub.less")).alias("a"))
    return rest.join(hubs, "key").select("a", F.col("sid").alias("b")).filter("a <> b").distinct()


def need(n_a, n_b, percent: int):
    """Least overlap of two sets of these sizes that link."""
    return F.ceil(F.lit(percent) * (n_a + n_b) / F.lit(100 + percent))


def _outside_pairs(around: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that may link although one of them is not
    of their common hub's component. ``around`` is (a, b, n, same, near, rest)
    for each hub a and set b."""
    of = lambda c, name: comps.select(F.col("node").alias(c), F.col("comp").alias(name))
    placed = around.join(of("b", "comp"), "b", "left").join(of("a", "comp_hub"), "a", "left")
    placed = placed.select(F.col("a").alias("hub"), "b", "n", "same", "rest", F.coalesce("comp", "b").alias("comp"), F.coalesce("comp_hub", "a").alias("comp_hub"))
    # a hub whose sets are all of its component has no more to ask
    mixed = placed.filter("comp <> comp_hub").select("hub").distinct()
    members = materialize(placed.join(mixed, "hub", "left_semi"), "members")
    # sets of nearly one size are looked up together, by the least of them
    band = F.floor(F.log(F.col("n").cast("double")) / log(SIZES)).cast("int").alias("size")
    entries = members.select("hub", "b", band, "comp", F.explode("rest").alias("e"))
    common = entries.groupBy("hub", "e").agg(F.count("*").alias("many")).filter("many > 1")
    # what only one set has outside the hub can't be shared, but counts for the number that must be
    listed = materialize(entries.join(common, ["hub", "e"]), "outside")
    sizes = members.groupBy("hub", band).agg(F.min("n").alias("low"), F.max("n").alias("high"))
    asked = members.filter("comp <> comp_hub").select("hub", F.col("b").alias("u"), F.col("n").alias("n_u"), F.col("comp").alias("comp_u"), "same", F.size("rest").alias("outside"))
    fits = (100 * F.col("high") >= percent * F.col("n_u")) & (100 * F.col("n_u") >= percent * F.col("low"))
    asked = asked.join(sizes, "hub").filter(fits).withColumn("least", need(F.col("n_u"), F.col("low"), percent)).withColumn("more", F.col("least") - F.col("same"))
    rarest = listed.groupBy("hub", "b").agg(F.sort_array(F.collect_list(F.struct("many", "e"))).alias("found")).withColumnRenamed("b", "u")
    asked = materialize(asked.filter("more <= outside").join(rarest, ["hub", "u"], "left"), "asked")
    # to share ``more`` of its shared-by-some shingles a set has to share one of all but the ``more`` - 1 commonest
    probes = asked.filter("more > 0").select("hub", "u", "comp_u", "size", F.explode(F.slice("found", F.lit(1), F.greatest(F.size("found") - F.col("more") + 1, F.lit(0)).cast("int"))).alias("f"))
    lists = listed.select("hub", "size", "e", F.col("b").alias("v"), F.col("comp").alias("comp_v"))
    by_list = probes.select("hub", "u", "comp_u", "size", "f.e").join(lists, ["hub", "size", "e"]).filter("u <> v and comp_u <> comp_v")
    inside = members.select("hub", band, F.col("b").alias("v"), F.col("comp").alias("comp_v"), F.col("same").alias("same_v"))
    directly = asked.filter("more <= 0").join(inside, ["hub", "size"]).filter("u <> v and comp_u <> comp_v and same_v >= least")
    return by_list.select("u", "v").unionByName(directly.select("u", "v")).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = WORDS, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row: the size of its set,
    the smallest id that links reach, and whether that is its own."""
    tuned(docs)
    m = rows * bands
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    every = materialize(with_uid(_sketched(source, words, m)), "sketches")
    classes = materialize(every.filter("n > 0").groupBy("k1", "k2").agg(F.min("uid").alias("sid"), F.min("_id").alias("low")), "classes")
    reps = materialize(every.join(classes.select(F.col("sid").alias("uid")), "uid", "left_semi").select(F.col("uid").alias("sid"), "n", "k1", "k2", "registers"), "sets")

    stars = materialize(_stars(_buckets(reps, rows, bands)), "stars")
    comps = contracted(_verified(_estimated(materialize(_star_pairs(stars), "pairs"), reps, m, percent), source, words, percent))
    open_buckets = _open(stars.select("key", "sid"), comps)
    if not open_buckets.isEmpty():
        hubs = materialize(_parts(materialize(_hub_pairs(open_buckets), "hubs"), MEMBERS), "parts")
        roles = materialize(_roles(hubs, reps, "k1", "k2"), "roles")
        around = materialize(_compared(roles, source, words, percent).dropDuplicates(["a", "b"]), "around")
        comps = joined_by(comps, around.filter("near").select("a", "b"))
        pairs = materialize(_outside_pairs(around, comps, percent), "outside-pairs")
        comps = joined_by(comps, _verified(_estimated(pairs, reps, m, percent), source, words, percent))
    of_class = classes.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    lowest = of_class.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = of_class.join(lowest, "comp").select("k1", "k2", "component_id")
    component = F.coalesce("component_id", "_id")
    return every.select("_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept")
    )
