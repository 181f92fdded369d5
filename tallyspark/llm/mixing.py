"""Mixing sources to target weights (operator 1) with DataFrame functions only.

A source's documents, in a pseudo-random order, lie on a line of words; the line is cut into
blocks of ``block`` words and a pass over the source takes its blocks in a permuted order.
A source's quota is the number of blocks that reach its target (the last one is trimmed, so
the mix takes the target exactly, to a word).

The quotas are dealt to output shards by a splitting tree: a node of shards [lo, hi) holds a
vector of block quotas, one per source; its left half gets a multivariate hypergeometric
draw of exactly as many blocks as it has room for and the right half gets the rest. So every
shard holds the same number of blocks within one, every quota is used up exactly, and a
shard's composition is that of a shuffled corpus. A shard's share of a source is a run of the
source's permuted blocks, disjoint from every other shard's; rows are shuffled inside shards.

Any number of sources passes. Sources are numbered and their targets found by prefix sums over
ranges of sources. The tree deals to groups of sources first and then inside each group
(``FANOUT`` members at a level), which draws from the same distribution; a row holds the
quotas of one group. Every source is cut into ``PARTS`` parts by the hash of its documents before any shuffle, so a
document's place does not depend on other sources. Blocks, parts and shards are parameters, the same at every size.

Defined results: null text or no word has size 0 and nothing is taken; null and empty source
are two sources; equal rows are placed one after the other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import packed, staged, word_count

#: Members of a group of the splitting tree; a source's or group's number div FANOUT is its group's.
FANOUT = 256
#: Parts of a source's line; a part is placed by one window.
PARTS = 4_096
#: Words of a block. A source has fewer than PRIME blocks: 10**12 words at this size, more with larger blocks.
BLOCK = 512
SHARDS = 64
#: A prime above every block count, so k * PRIME modulo n permutes 0..n-1.
PRIME = 2_147_483_647
WEIGHTS = (3, 1, 2)


def _key(source: Column) -> Column:
    """A source as a string that is never null; null and empty stay apart."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size and the hash that orders a source's documents."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size")).withColumn(
        "_h", F.xxhash64(F.lit(seed), "doc_id", "size")
    )


def before(rows: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """Adds the sums over the rows that come before in ``order``, a total order.

    Rows are written in ranges; one window runs inside each range and one over the ranges' totals.
    """
    ranged = staged(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = totals.select("_range", *[F.coalesce(F.sum(k).over(ranges), F.lit(0)).alias(f"_s_{k}") for k in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumns({f"_o_{k}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for k, c in sums.items()})
    found = [(F.col(f"_o_{k}") + F.col(f"_s_{k}")).alias(k) for k in sums]
    return own.join(F.broadcast(starts), "_range").select(*rows.columns, *found)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: sid, source, source_size, n_docs, target (double).

    Targets share ``share`` of all words by weight; one that would pass ``most`` times its
    source's size stops there and the others share the excess. With sources ordered by
    most * size / weight, the stopped ones are a prefix; the rest get level * weight.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = before(per, [F.col("source").asc_nulls_last()], {"sid": F.lit(1)}, "mix-numbers")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    s = ranked.withColumn("w", cycle).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    s = s.withColumn("at", F.col("cap") / F.col("w"))
    s = staged(before(s, [F.col("at").asc(), F.col("sid").asc()], {"caps": F.col("cap"), "ws": F.col("w")}, "mix-order"), "mix-sums")
    words, weight = s.agg(F.sum("source_size"), F.sum("w")).first()
    target = F.col("cap")
    if words:
        lam = (F.lit(float(words)) * F.lit(share) - F.col("caps")) / (F.lit(weight) - F.col("ws"))
        first = s.withColumn("lam", lam).where(F.col("lam") * F.col("w") < F.col("cap"))
        (level,) = first.agg(F.min(F.struct("at", "sid", "lam"))["lam"]).first()
        if level is not None:
            target = F.least(F.col("cap"), F.lit(level) * F.col("w"))
    return s.select("sid", "source", "source_size", "n_docs", target.alias("target"))


def quotas(per_source: DataFrame, block: int, seed: int, most: int = 2) -> DataFrame:
    """Adds each source's block count, whole passes, and what the last pass takes.

    ``rank`` of block k in the last pass is (k * PRIME + turn) modulo blocks; the pass takes
    ranks below ``part``, and of rank part - 1 all but the block's last ``trim`` words.
    """
    b = int(block)
    q = (
        per_source.withColumn("goal", F.expr(f"least(cast(floor(target + 0.5) as bigint), {int(most)} * source_size)"))
        .withColumn("blocks", F.expr(f"cast(ceil(source_size / {b}) as bigint)"))
        .withColumn("passes", F.expr("if(source_size = 0, 0L, goal div source_size)"))
        .withColumn("rest", F.expr("goal - passes * source_size"))
        .withColumn("short", F.expr(f"blocks * {b} - source_size"))
        .withColumn("turn", F.expr(f"if(blocks = 0, 0L, pmod(xxhash64({int(seed)}, sid), blocks))"))
        .withColumn("short_rank", F.expr(f"if(blocks = 0, 0L, pmod((blocks - 1) * {PRIME} + turn, blocks))"))
        .withColumn("plain", F.expr(f"cast(ceil(rest / {b}) as bigint)"))
        .withColumn(
            "part",
            F.expr(f"if(plain <= short_rank, plain, greatest(short_rank + 1, cast(ceil((rest + short) / {b}) as bigint)))"),
        )
        .withColumn("part", F.expr("if(rest = 0, 0L, part)"))
        .withColumn("trim", F.expr(f"if(rest = 0, 0L, part * {b} - if(part > short_rank, short, 0L) - rest)"))
    )
    return q.withColumn("quota", F.expr("passes * blocks + part")).drop("plain", "rest")


def _draw(rest: str, own: str, need: str, u: str) -> str:
    """SQL for one hypergeometric draw: of ``need`` taken from ``rest``, how many are of ``own``.

    Inversion of the distribution at ``u`` over mean +- 12 standard deviations (all there is,
    for small numbers); probabilities follow from the ratio of neighbours.
    """
    step = (
        f"(b.own - k) * (b.need - k) / ((k + 1D) * greatest(b.rest - b.own - b.need + k + 1D, 1D))"
    )
    spread = "12 * sqrt(b.mean * greatest(b.rest - b.own, 0D) / b.rest) + 12"
    return f"""transform(transform(transform(
        array(named_struct('rest', greatest(cast({rest} as double), 1D), 'own', cast({own} as double), 'need', cast({need} as double),
            'mean', cast({need} as double) * cast({own} as double) / greatest(cast({rest} as double), 1D))),
        b -> named_struct('rest', b.rest, 'own', b.own, 'need', b.need,
            'all', sequence(cast(greatest(0D, b.need - (b.rest - b.own), floor(b.mean - ({spread}))) as bigint),
                            cast(greatest(greatest(0D, b.need - (b.rest - b.own)), least(b.own, b.need, ceil(b.mean + {spread}))) as bigint)))),
        b -> named_struct('rest', b.rest, 'own', b.own, 'need', b.need, 'all', b.all, 'sum',
            aggregate(b.all, named_struct('f', 1D, 's', 0D), (a, k) -> named_struct('f', a.f * ({step}), 's', a.s + a.f), a -> a.s))),
        b -> least(cast(b.own as bigint), cast(b.need as bigint), aggregate(b.all, named_struct('f', 1D, 's', 0D, 'x', -1L),
            (a, k) -> named_struct('f', a.f * ({step}), 's', a.s + a.f,
                'x', if(a.x < 0 and a.s + a.f >= {u} * b.sum, k, a.x)), a -> if(a.x < 0, b.all[size(b.all) - 1], a.x))))[0]"""


def split_groups(groups: DataFrame, shards: int) -> DataFrame:
    """One row per group and shard: group, shard and ``q``, the shard's blocks of every member.

    ``groups`` has group, ``s`` (a seed), ``q`` (its members' blocks) and ``room`` (the blocks that
    each shard takes of the group, the same total). Each level splits every node in two.
    """
    nodes = groups.select("group", F.col("s").alias("seed"), F.lit(0).alias("lo"), F.lit(int(shards)).alias("hi"), "q", "room")
    u = "((pmod(xxhash64(seed, lo, hi, i), 9007199254740992L) + 0.5D) / 9007199254740992D)"
    fold = f"""aggregate(if(size(q) = 0, cast(array() as array<int>), sequence(0, size(q) - 1)), named_struct('rest', aggregate(q, 0L, (a, v) -> a + v),
        'need', need, 'out', cast(array() as array<bigint>)),
        (s, i) -> transform(array({_draw('s.rest', 'q[i]', 's.need', u)}),
            x -> named_struct('rest', s.rest - q[i], 'need', s.need - x, 'out', array_append(s.out, x)))[0], s -> s.out)"""
    for _ in range(max(0, (int(shards) - 1).bit_length())):
        mid = nodes.withColumn("mid", F.expr("cast((lo + hi) div 2 as int)")).withColumn(
            "need", F.expr("aggregate(slice(room, 1, mid - lo), 0L, (a, v) -> a + v)")
        )
        split = mid.withColumn("x", F.expr(f"if(hi - lo > 1, {fold}, q)"))
        nodes = split.select(
            "group",
            "seed",
            F.explode(
                F.expr(
                    "if(hi - lo > 1, array(named_struct('lo', lo, 'hi', mid, 'q', x, 'room', slice(room, 1, mid - lo)), "
                    "named_struct('lo', mid, 'hi', hi, 'q', zip_with(q, x, (a, b) -> a - b), 'room', slice(room, mid - lo + 1, hi - mid))), "
                    "array(named_struct('lo', lo, 'hi', hi, 'q', q, 'room', room)))"
                )
            ).alias("c"),
        ).select("group", "seed", "c.*")
    return nodes.select("group", F.col("lo").alias("shard"), "q")


def _even(total: str, shards: int) -> Column:
    """Blocks of every shard: as many as the others, within one."""
    n = int(shards)
    return F.expr(f"transform(sequence(0L, {n - 1}L), j -> ({total}) * (j + 1) div {n} - ({total}) * j div {n})")


def splitting_tree(q: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row per shard: shard and ``q``, its block quota of every source (by sid).

    ``q`` is the one-row frame of all quotas, one group.
    """
    room = _even("aggregate(q, 0L, (a, v) -> a + v)", shards)
    return split_groups(q.select(F.lit(0).alias("group"), F.lit(int(seed)).alias("s"), "q", room.alias("room")), shards).drop("group")


def dealt(quota: DataFrame, n: int, shards: int, seed: int, fanout: int = FANOUT) -> DataFrame:
    """Per source (sid) the array ``room``: the blocks that each shard takes of it.

    ``quota`` has sid (0 to ``n`` - 1) and quota. From the top, each group of up to ``fanout``
    deals what its shards take of it to its members, which are groups or, at last, sources.
    """
    depth = 1
    while fanout**depth < n:
        depth += 1
    total = quota.agg(F.sum("quota").cast("long").alias("t")).where("t is not null")
    # Written: a literal group would make the join below a cross join.
    rooms = staged(total.select(F.lit(0).cast("long").alias("group"), _even("t", shards).alias("room")), "mix-rooms")
    for level in range(depth - 1, -1, -1):
        members = quota.groupBy(F.expr(f"sid div {fanout**level}L").alias("m")).agg(F.sum("quota").alias("quota"))
        vectors = members.groupBy(F.expr(f"m div {fanout}L").alias("group")).agg(
            F.expr("transform(sort_array(collect_list(struct(m, quota))), x -> x.quota)").alias("q")
        )
        s = F.lit(int(seed)) if level == depth - 1 else F.xxhash64(F.lit(int(seed)), F.lit(level), "group")
        parts = split_groups(vectors.join(rooms, "group").withColumn("s", s), shards)
        table = parts.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("shard", "q"))).alias("t"))
        rooms = table.select("group", "t", F.explode(F.expr("sequence(0, size(t[0].q) - 1)")).alias("i")).select(
            F.expr(f"group * {fanout}L + i").alias("group"), F.expr("transform(t, x -> x.q[i])").alias("room")
        )
        rooms = staged(rooms, f"mix-tree-{level}")
    return rooms.withColumnRenamed("group", "sid")


class Mix:
    """A planned mix: the sources' targets and quotas, and the documents on their lines."""

    def __init__(
        self, docs: DataFrame, seed: int = 11, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2,
        shards: int = SHARDS, keep_documents: bool = False, sized: DataFrame | None = None, block: int = BLOCK, parts: int = PARTS,
    ) -> None:
        narrow = staged(measured(docs, seed), "mix-sizes") if sized is None else sized
        per = staged(targets(narrow, weights, share, most), "mix-targets")
        self.n_sources, largest = per.agg(F.count(F.lit(1)), F.coalesce(F.max("source_size"), F.lit(0))).first()
        if largest > block * (PRIME - 1):
            raise ValueError(f"a source has {largest} words: blocks must be larger than {block}")
        self.seed, self.most, self.block, self.shards = seed, most, block, shards
        self.sources = staged(quotas(per, block, seed, most), "mix-quotas")

        def in_parts(rows: DataFrame) -> DataFrame:
            return rows.withColumns({"_key": _key(F.col("source")), "_part": F.expr(f"pmod(_h, {int(parts)}L)")})

        if keep_documents:
            rows = docs.select(packed(docs), "doc_id", "source", word_count(F.col("text")).alias("size"))
            rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "size"))
        else:
            rows = narrow
        inside = Window.partitionBy("_key", "_part").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
        self._placed = in_parts(rows).drop("source").withColumn("_at", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
        totals = in_parts(narrow).groupBy("_key", "_part").agg(F.sum("size").alias("_t"))
        earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select("_key", "_part", F.coalesce(F.sum("_t").over(earlier), F.lit(0).cast("long")).alias("_start"))
        self._starts = starts.join(self.sources.withColumn("_key", _key(F.col("source"))), "_key")

    def _lines(self, starts: DataFrame) -> DataFrame:
        """The documents on their sources' lines (``at``), with the columns of ``starts``."""
        return self._placed.join(starts, ["_key", "_part"]).withColumn("at", F.col("_at") + F.col("_start")).drop("_key", "_part", "_at", "_start")

    @property
    def documents(self) -> DataFrame:
        return self._lines(self._starts)

    def _dealt_documents(self) -> DataFrame:
        """The documents with their source's ``ends``."""
        return self._lines(self._starts.join(self.runs().withColumnRenamed("_sid", "sid"), "sid"))

    def runs(self) -> DataFrame:
        """Per source (``_sid``) the array ``ends``: shard j takes the draws from ends[j - 1] up to
        ends[j], a run of the source's permuted blocks. One entry per shard and source."""
        rooms = dealt(self.sources.select("sid", "quota"), self.n_sources, self.shards, self.seed + 1)
        ends = (
            "aggregate(room, named_struct('t', 0L, 'out', cast(array() as array<bigint>)), "
            "(a, v) -> named_struct('t', a.t + v, 'out', array_append(a.out, a.t + v)), a -> a.out)"
        )
        return rooms.select(F.col("sid").alias("_sid"), F.expr(ends).alias("ends"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, the words that the mix takes of each document, and the
        shards that they go to."""
        b = self.block
        end = f"least((k + 1) * {b}, source_size)"
        rank = f"pmod(k * {PRIME} + turn, blocks)"
        have = f"greatest(0L, least(at + size, {end} - if(p = passes and {rank} = part - 1, trim, 0L)) - greatest(at, k * {b}))"
        blocks = f"if(size = 0, cast(array() as array<bigint>), sequence(at div {b}, (at + size - 1) div {b}))"
        draws = (
            f"flatten(transform({blocks}, k -> transform(filter(sequence(0L, {self.most - 1}L), p -> p * blocks + {rank} < quota), "
            f"p -> named_struct('draw', p * blocks + {rank}, 'words', {have}))))"
        )
        placed = self._dealt_documents().withColumn("drawn", F.expr(draws))
        shard = "size(filter(ends, e -> e <= d.draw))"
        return placed.select(
            "doc_id", "size", "source_size", "target",
            F.expr("aggregate(drawn, 0L, (a, d) -> a + d.words)").alias("taken"),
            F.expr(f"array_sort(array_distinct(transform(filter(drawn, d -> d.words > 0), d -> {shard})))").alias("shards"),
        )

    def rows(self) -> DataFrame:
        """The mix as documents (struct ``_doc``): each once per draw, with ``shard`` and ``slot``, which
        orders the shard's rows.

        A document belongs to the block that holds its middle word, so documents stay whole.
        Needs ``keep_documents``.
        """
        rank = f"pmod(k * {PRIME} + turn, blocks)"
        drawn = (
            self._dealt_documents()
            .where("size > 0")
            .withColumn("k", F.expr(f"(at + size div 2) div {self.block}"))
            .withColumn("draw", F.explode(F.expr(f"filter(transform(sequence(0L, {self.most - 1}L), p -> p * blocks + {rank}), d -> d < quota)")))
        )
        place = [F.expr("size(filter(ends, e -> e <= draw))").alias("shard"), F.xxhash64(F.lit(self.seed + 2), "sid", "draw", "at").alias("slot")]
        placed = drawn.select("_doc", *place, "at")
        return placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot", "at").select("_doc", "shard", "slot")
