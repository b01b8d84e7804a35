"""A trie of conversations by turns, kept as a z-fast trie.

A prefix of a conversation is known by 128 bits: two checksums of its turns and
their places, which add up by exclusive or, so a conversation of any length is
hashed in pieces of ``CHUNK`` turns by many tasks.

The trie is compacted: an edge (low, high] stands for a run of turns without a
branch or an end. It is found under the hash of its prefix at its handle, the
number in (low, high] that most often divides by two. Conversations are put in
by batches:

1. Every conversation left over looks for its exit edge by fat binary search:
   it halves the interval of its own depths at the number that most often
   divides by two, and asks for a handle there. A look at the names of edges
   (the prefix one turn below their top) and a comparison along the exit edge
   tell where it leaves the trie.
2. Of those that leave at one place with the same next turn, one (the
   smallest hash) is put in whole; the others wait for the next batch. It owns
   the path from the place to its end, and paths hang on each other like
   the heavy paths of a tree, so batches are few whatever the depth is.

Members, leaves and savings are then added up path by path, the last batch
first, and the edges are expanded to a row for every depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.spelling import sql_crc32
from varloom.operators.joins import balanced_join
from varloom.staging import staged

#: Prefixes in a row of the prefix table.
CHUNK = 64

#: Conversations of one block share the first turns of its first conversation, 0 to ``SHARED - 1`` of them.
BLOCK, SHARED = 20, 4

_WORD = r"[^\x20\x09-\x0D]+"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# The rebuilt conversations


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), a, b (checksums of role and text), words; by turn, nulls first, then by checksum.

    A range of conversations and turns goes to each task, so a conversation of any
    size is cut; places are counted in each range and start where the ranges
    before it end.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("copy"))
    ranged = staged(turns.repartitionByRange("conv_id", "turn", "a", "b", "copy").withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one conversation goes on from a range to the next one, so there are fewer of these rows than ranges.
    carried = counts.select("conv_id", "part", before.alias("before")).where("before > 0")
    own = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(F.asc_nulls_first("turn"), "a", "b"))
    return staged(ranged.withColumn("own", own).join(F.broadcast(carried), ["conv_id", "part"], "left")
                  .select("conv_id", (F.col("own") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "a", "b", "words"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversation ids, and the turns (conv_id, pos, a, b, words) of the rebuilt conversations.

    The first h turns come from the first conversation of the block (c - c % BLOCK,
    the remainder having the sign of c), the others are the conversation's own after its first h.
    """
    heads = (turns.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < SHARED)).groupBy(F.col("conv_id").alias("block"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("head")))
    convs = turns.select("conv_id").distinct().withColumns({
        "block": F.col("conv_id") - F.col("conv_id") % BLOCK, "h": (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")})
    convs = staged(convs.join(heads, "block", "left").select("conv_id", "h", F.slice(F.coalesce("head", F.expr(
        "cast(array() as array<struct<pos:bigint,a:bigint,b:bigint,words:bigint>>)")), F.lit(1), F.col("h")).alias("head")))
    own = balanced_join(turns, convs.select("conv_id", "h", F.size("head").alias("shared")), ["conv_id"], "inner", right_unique=True)
    own = own.where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "a", "b", "words")
    return convs.select("conv_id"), own.unionByName(convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*"))


def prefix_table(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, xs, ys, ws, w0): checksums and words of each prefix that ends in the chunk, and the words before it."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, out = batch.column("turns"), []
            offsets, flat = column.offsets.to_numpy(), column.values
            for name, ufunc in (("x", np.bitwise_xor), ("y", np.bitwise_xor), ("words", np.add)):
                values = flat.field(name).to_numpy().copy()
                for start, end in zip(offsets[:-1], offsets[1:]):
                    ufunc.accumulate(values[start:end], out=values[start:end])
                out.append(pa.ListArray.from_arrays(column.offsets, pa.array(values, pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"), *out], ["conv_id", "chunk", "xs", "ys", "ws"])

    marked = turns.select("conv_id", F.expr(f"(pos - 1) div {CHUNK}").alias("chunk"), F.struct(
        "pos", F.xxhash64("pos", "a", "b").alias("x"), F.xxhash64("b", "pos", "a", F.lit(2)).alias("y"), "words").alias("t"))
    chunks = marked.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("t")).alias("turns")).mapInArrow(
        add_up, "conv_id long, chunk long, xs array<long>, ys array<long>, ws array<long>")
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = {c: F.element_at(c, -1) for c in ("xs", "ys", "ws")}
    moved = chunks.withColumns({"x0": F.coalesce(F.bit_xor(last["xs"]).over(earlier), F.lit(0)), "y0": F.coalesce(F.bit_xor(last["ys"]).over(earlier), F.lit(0)),
                                "w0": F.coalesce(F.sum(last["ws"]).over(earlier), F.lit(0))})
    return staged(moved.select("conv_id", "chunk", F.expr("transform(xs, v -> v ^ x0)").alias("xs"), F.expr("transform(ys, v -> v ^ y0)").alias("ys"),
                               F.expr("transform(ws, v -> v + w0)").alias("ws"), F.col("w0").cast("long").alias("w0")))


def classes_of(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(cls, length, n, ends): conversations of equal turns under the smallest id, their number, the hash of their ids.

    The hash is one chain over the ids, which pass by as a sorted stream.
    """
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("chunk", F.size("xs").alias("size"), F.element_at("xs", -1).alias("x"),
                                                           F.element_at("ys", -1).alias("y"))).alias("e"))
    zero = F.lit(0).cast("long")
    ended = convs.join(whole, "conv_id", "left").select("conv_id", F.coalesce(F.col("e.chunk") * CHUNK + F.col("e.size"), zero).alias("length"),
                                                        F.coalesce("e.x", zero).alias("x"), F.coalesce("e.y", zero).alias("y"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        chain, first, n = None, 0, 0
        for batch in batches:
            for key in zip(*(batch.column(c).to_pylist() for c in ("length", "x", "y", "conv_id"))):
                if key[:3] != now:
                    if now is not None:
                        done.append((first, now[0], n, chain.hexdigest()))
                    now, chain, first, n = key[:3], hashlib.sha256(), key[3], 0
                chain.update((b"," if n else b"") + str(key[3]).encode())
                n += 1
            if len(done) > 10_000:
                yield _class_rows(done)
                done = []
        if now is not None:
            done.append((first, now[0], n, chain.hexdigest()))
        yield _class_rows(done)

    return staged(ended.repartition("length", "x", "y").sortWithinPartitions("length", "x", "y", "conv_id").mapInArrow(
        read, "cls long, length long, n long, ends string"))


def _class_rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (("cls", pa.int64()), ("length", pa.int64()), ("n", pa.int64()), ("ends", pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


# The trie


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that divides by the largest power of two: high without its bits below the first one that differs."""
    return F.expr(f"shiftleft(shiftright({high}, length(bin({low} ^ {high})) - 1), length(bin({low} ^ {high})) - 1)")


def with_prefix(rows: DataFrame, prefixes: DataFrame, who: str, depth: str, **wanted: str) -> DataFrame:
    """``rows`` with values of the prefix of conversation ``who`` of ``depth`` turns; ``wanted``: x, y or w to a new name.

    The empty prefix has zeros; a null depth or conversation gives null.
    """
    lists = {"x": "xs", "y": "ys", "w": "ws"}
    table = prefixes.select(F.col("conv_id").alias("_who"), F.col("chunk").alias("_chunk"), *[F.col(lists[k]).alias(f"_{k}") for k in wanted])
    joined = rows.join(table, F.expr(f"{who} = _who AND ({depth} - 1) div {CHUNK} = _chunk AND {depth} > 0"), "left")
    values = {name: F.expr(f"CASE WHEN {depth} = 0 THEN 0L ELSE get(_{k}, CAST(({depth} - 1) % {CHUNK} AS int)) END") for k, name in wanted.items()}
    return joined.withColumns(values).drop("_who", "_chunk", *[f"_{k}" for k in wanted])


def edge_table(breaks: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The compacted edges (owner, top, low, high) with the hashes of their extent (x, y), handle at f (hx, hy) and name (nx, ny).

    ``breaks`` (owner, top, depth): where the owner's path below ``top`` branches or ends.
    """
    above = F.lag("depth").over(Window.partitionBy("owner").orderBy("depth"))
    edges = breaks.select("owner", "top", F.coalesce(above, F.col("top")).alias("low"), F.col("depth").alias("high")).withColumn("f", fattest("low", "high"))
    edges = with_prefix(edges, prefixes, "owner", "high", x="x", y="y")
    edges = with_prefix(edges, prefixes, "owner", "f", x="hx", y="hy")
    return staged(with_prefix(edges, prefixes, "owner", "(low + 1)", x="nx", y="ny"))


def exits(waiting: DataFrame, edges: DataFrame | None, prefixes: DataFrame, longest: int) -> DataFrame:
    """(cls, length, owner, top, m): each class leaves the trie after m turns, on the owner's path (null: at the root)."""
    if edges is None:
        return waiting.select("cls", "length", *[F.lit(None).cast("long").alias(c) for c in ("owner", "top")], F.lit(0).cast("long").alias("m"))
    none = F.lit(None).cast("long")
    kept = ("owner", "top", "low", "high", "f", "x", "y")
    state = waiting.select("cls", "length", F.lit(0).cast("long").alias("a"), F.col("length").alias("b"), *[none.alias(f"on_{c}") for c in kept])
    handles = edges.select("hx", "hy", *[F.col(c).alias(f"at_{c}") for c in kept])
    for step in range(longest.bit_length()):
        state = state.withColumn("probe", F.when(F.col("a") < F.col("b"), fattest("a", "b")))
        state = with_prefix(state, prefixes, "cls", "probe", x="px", y="py").join(handles, F.expr("probe = at_f AND px = hx AND py = hy"), "left")
        hit = F.col("at_owner").isNotNull()
        state = state.select("cls", "length", F.when(hit, F.least("at_high", "b")).otherwise(F.col("a")).alias("a"),
                             F.when(hit | F.col("probe").isNull(), F.col("b")).otherwise(F.col("probe") - 1).alias("b"),
                             *[F.when(hit, F.col(f"at_{c}")).otherwise(F.col(f"on_{c}")).alias(f"on_{c}") for c in kept])
        if step % 4 == 3:
            state = staged(state)
    # The edge found last: is the class all along it, or does it leave it halfway?
    state = with_prefix(state, prefixes, "cls", "CASE WHEN on_high <= length THEN on_high END", x="ex", y="ey")
    state = state.withColumn("whole", F.coalesce((F.col("ex") == F.col("on_x")) & (F.col("ey") == F.col("on_y")), F.col("on_owner").isNull()))
    state = state.withColumn("start", F.when(F.col("on_owner").isNull(), F.lit(0).cast("long")).otherwise(F.col("on_high")))
    names = edges.select(F.col("low").alias("at_low"), F.col("high").alias("at_high"), F.col("owner").alias("at_owner"), F.col("top").alias("at_top"), "nx", "ny")
    state = with_prefix(state, prefixes, "cls", "CASE WHEN whole AND start < length THEN start + 1 END", x="px", y="py")
    state = state.join(names, F.expr("whole AND start = at_low AND px = nx AND py = ny"), "left")
    child = F.col("at_owner").isNotNull()
    inside = ~F.col("whole")

    def pick(halfway: Column, below: Column, there: Column) -> Column:
        return F.when(inside, halfway).when(child, below).otherwise(there)

    state = staged(state.select(
        "cls", "length", pick(F.col("on_owner"), F.col("at_owner"), F.col("on_owner")).alias("owner"), pick(F.col("on_top"), F.col("at_top"), F.col("on_top")).alias("top"),
        # The prefix of lo turns is common, the one of hi + 1 turns is not, or there is none.
        pick(F.col("on_f"), F.col("start") + 1, F.col("start")).alias("lo"),
        pick(F.least("on_high", "length"), F.least("at_high", "length"), F.col("start")).alias("hi")))
    for _ in range(((longest - 1) // CHUNK).bit_length()):
        # The last depth of the chunk in the middle, while the edge is over several chunks.
        middle = F.expr(f"(lo div {CHUNK} + (hi - 1) div {CHUNK} + 1) div 2 * {CHUNK}")
        state = state.withColumn("mid", F.when(F.expr(f"lo < hi AND lo div {CHUNK} < (hi - 1) div {CHUNK}"), middle))
        state = with_prefix(with_prefix(state, prefixes, "cls", "mid", x="px", y="py"), prefixes, "owner", "mid", x="qx", y="qy")
        same = (F.col("px") == F.col("qx")) & (F.col("py") == F.col("qy"))
        state = state.select("cls", "length", "owner", "top", F.when(same, F.col("mid")).otherwise(F.col("lo")).alias("lo"),
                             F.when(same | F.col("mid").isNull(), F.col("hi")).otherwise(F.col("mid") - 1).alias("hi"))
    # What is left lies in one chunk.
    for who, short in (("cls", "p"), ("owner", "q")):
        table = prefixes.select(F.col("conv_id").alias(f"{short}_who"), F.col("chunk").alias(f"{short}_chunk"), F.col("xs").alias(f"{short}x"), F.col("ys").alias(f"{short}y"))
        state = state.join(table, F.expr(f"lo < hi AND {who} = {short}_who AND (hi - 1) div {CHUNK} = {short}_chunk"), "left")
    further = F.expr(f"""CASE WHEN lo < hi THEN size(filter(sequence(CAST(lo % {CHUNK} AS int), CAST((hi - 1) % {CHUNK} AS int)),
        i -> get(px, i) = get(qx, i) AND get(py, i) = get(qy, i))) ELSE 0 END""")
    return state.select("cls", "length", "owner", "top", (F.col("lo") + further).alias("m"))


def build_paths(classes: DataFrame, prefixes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The paths (cls, length, parent, top) of each batch, and where the classes end: (owner, depth, cls)."""
    longest = classes.agg(F.max("length")).first()[0] or 0
    waiting, batches, ends = staged(classes.where("length > 0").select("cls", "length")), [], []
    breaks, edges = None, None
    while not waiting.isEmpty():
        left = with_prefix(exits(waiting, edges, prefixes, longest), prefixes, "cls", "CASE WHEN m < length THEN m + 1 END", x="px", y="py")
        left = staged(left)
        going = left.where("m < length")
        chosen = going.groupBy("m", "px", "py").agg(F.min_by(F.struct("cls", "length", "owner", "top"), F.struct(F.xxhash64("cls"), "cls")).alias("r"))
        paths = staged(chosen.select("r.cls", "r.length", F.col("r.owner").alias("parent"), F.col("r.top").alias("parent_top"), F.col("m").alias("top")))
        batches.append(paths.select("cls", "length", "parent", "top"))
        ends += [paths.select(F.col("cls").alias("owner"), F.col("length").alias("depth"), "cls"),
                 left.where("m = length").select("owner", F.col("m").alias("depth"), "cls")]
        new = (paths.select(F.col("cls").alias("owner"), "top", F.col("length").alias("depth"))
               .union(paths.where("parent IS NOT NULL").select("parent", "parent_top", "top"))
               .union(left.where("m = length").select("owner", "top", "m")))
        breaks = staged((new if breaks is None else breaks.union(new)).distinct())
        edges = edge_table(breaks, prefixes)
        waiting = staged(going.select("cls", "length").join(paths.select("cls"), "cls", "left_anti"))
    found = classes.where("length = 0").select(F.lit(None).cast("long").alias("owner"), F.col("length").alias("depth"), "cls")
    for part in ends:
        found = found.union(part)
    return batches, staged(found)


# Sums over subtrees, and the rows


EVENT = ["owner", "depth", "n", "least", "leaves", "saved", "kids", "ends"]


def path_sums(batches: list[DataFrame], ends: DataFrame, classes: DataFrame, prefixes: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Sums for each edge, and what hangs on the root.

    An event is what a place of a path gets: the class that ends there, or a
    path that hangs on it with its sums. Going up a path, events add up; batches
    are gone through from the last, so what hangs on a path is known before it.
    """
    zero = F.lit(0).cast("long")
    events = ends.join(classes.select("cls", "n", "ends"), "cls").select(
        "owner", "depth", "n", F.col("cls").alias("least"), zero.alias("leaves"), zero.alias("saved"), zero.alias("kids"), "ends")
    done = []
    for paths in reversed(batches):
        own = events.join(paths.select(F.col("cls").alias("owner"), "length", "top", "parent"), "owner")
        sums = own.groupBy("owner", "depth", "length", "top", "parent").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum("kids").alias("kids"),
            F.max("ends").alias("ends"))
        sums = with_prefix(sums, prefixes, "owner", "depth", w="w")
        # The words above the path belong to the same conversation.
        sums = with_prefix(sums, prefixes, "owner", "top", w="w_top")
        up = Window.partitionBy("owner").orderBy(F.desc("depth"))
        tip = (F.col("depth") == F.col("length")) & (F.col("kids") == 0)
        sums = sums.select("owner", "depth", "length", "top", "parent", "kids", "ends", "w", F.sum("n").over(up).alias("n"), F.min("least").over(up).alias("least"),
                           F.sum(F.col("leaves") + tip.cast("long")).over(up).alias("leaves"), F.sum("saved").over(up).alias("hung"),
                           F.coalesce(F.lead("depth").over(up), F.col("top")).alias("low"), F.coalesce(F.lead("w").over(up), F.col("w_top")).alias("w_low"))
        edge = (F.col("n") - 1) * (F.col("w") - F.col("w_low"))
        deeper = F.coalesce(F.sum(edge).over(up.rowsBetween(Window.unboundedPreceding, -1)), zero)
        sums = staged(sums.select("*", (F.col("hung") + deeper).alias("below"), F.lead("least").over(up).alias("least_low")))
        done.append(sums)
        hung = sums.where("low = top").select(
            F.col("parent").alias("owner"), F.col("top").alias("depth"), "n", "least", "leaves", (F.col("below") + edge).alias("saved"), F.lit(1).cast("long").alias("kids"),
            F.lit(None).cast("string").alias("ends"))
        events = staged(events.join(paths.select(F.col("cls").alias("owner")), "owner", "left_anti").select(*EVENT).union(hung.select(*EVENT)))
    every = None
    for sums in done:
        every = sums if every is None else every.union(sums)
    # All paths are done: what is left hangs on the root.
    return every, events


def expanded(edges: DataFrame, prefixes: DataFrame, root_least: int) -> DataFrame:
    """A row for every depth of every edge; a chunk of a path meets the edges that end in it, and the first one after it."""
    ending = edges.select("owner", F.col("depth").alias("at"), F.col("least").alias("at_least"))
    tops = edges.where("low = top AND parent IS NOT NULL").select(F.col("owner").alias("cls"), F.col("parent").alias("owner"), F.col("top").alias("at"))
    above = tops.join(ending, ["owner", "at"]).select(F.col("cls").alias("owner"), F.col("at_least").alias("over"))
    paths = edges.where("depth = length").select("owner", "length", "top", "parent").join(above, "owner", "left").select(
        F.col("owner").alias("conv_id"), "length", "top", F.when(F.col("parent").isNull(), F.lit(root_least).cast("long")).otherwise(F.col("over")).alias("over"))
    grouped = edges.groupBy(F.col("owner").alias("conv_id"), F.expr(f"(depth - 1) div {CHUNK}").alias("chunk")).agg(F.array_sort(F.collect_list(F.struct(
        "depth", "n", "least", "leaves", "below", "kids", "ends", "w", "low", "least_low"))).alias("here"))
    chunks = prefixes.join(paths, "conv_id").where((F.col("chunk") + 1) * CHUNK > F.col("top")).join(grouped, ["conv_id", "chunk"], "left")
    later = Window.partitionBy("conv_id").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("after", F.last(F.get("here", F.lit(0)), ignorenulls=True).over(later))
    depths = F.explode(F.expr(f"sequence(greatest(chunk * {CHUNK}, top) + 1, chunk * {CHUNK} + size(xs))")).alias("depth")
    rows = chunks.select("length", "top", "over", "ws", "w0", "here", "after", F.col("chunk"), depths)
    rows = rows.withColumn("e", F.coalesce(F.expr("get(filter(here, e -> e.depth >= depth), 0)"), F.col("after")))
    spot = f"CAST(depth - 1 - chunk * {CHUNK} AS int)"
    rows = rows.withColumn("before", F.expr(f"CASE WHEN {spot} = 0 THEN w0 ELSE get(ws, {spot} - 1) END"))
    last = F.col("e.depth") == F.col("depth")
    parent = F.when(F.col("depth") - 1 == F.col("top"), F.col("over")).when(F.col("depth") - 1 == F.col("e.low"), F.col("e.least_low")).otherwise(F.col("e.least"))
    return rows.select(
        F.col("e.least").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("e.n").alias("n_convs"),
        (F.when(last, F.col("e.kids")).otherwise(F.lit(0)) + (F.col("depth") < F.col("length")).cast("long")).alias("n_children"), F.col("e.leaves").alias("n_leaves"),
        (F.col("e.below") + (F.col("e.n") - 1) * (F.col("e.w") - F.col("before"))).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("e.ends")), F.lit(_NO_ENDS)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for every distinct prefix of the rebuilt conversations (conv_id, turn, role, text), the empty one included.

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Null roles and texts are empty; null
    turns come first; turns with equal numbers follow their checksums, repeated
    rows are turns of their own. Rows without conv_id are in no conversation and
    count nowhere. No conversations, no rows.
    """
    convs, turns = rebuilt_turns(placed_turns(conversations.select("conv_id", "turn", "role", "text")))
    prefixes = prefix_table(turns)
    classes = classes_of(convs, prefixes)
    batches, ends = build_paths(classes, prefixes)
    edges, events = path_sums(batches, ends, classes, prefixes)
    top = events.agg(F.min("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.sum("n").alias("n_convs"),
                     F.sum("kids").alias("n_children"), F.when(F.sum("kids") == 0, F.lit(1)).otherwise(F.sum("leaves")).cast("long").alias("n_leaves"),
                     F.sum("saved").alias("saved_tokens"), F.coalesce(F.max("ends"), F.lit(_NO_ENDS)).alias("ends_sha256"))
    root = staged(top.where("n_convs > 0"))
    if edges is None:
        return root
    return root.unionByName(expanded(edges, prefixes, root.first()["conv_id"]))


TRIE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {BLOCK} AS block, CAST(h % {SHARED} AS bigint) AS h
  FROM (SELECT conv_id, {sql_crc32("CAST(conv_id AS varchar)")} AS h FROM (SELECT DISTINCT conv_id FROM t) AS d) AS e),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d, turn, words FROM (
  SELECT *, sha256(role || chr(0) || text) AS turn, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM (
    SELECT c.conv_id, 0 AS part, t.pos, role, text FROM c JOIN t ON t.conv_id = c.block AND t.pos <= c.h
    UNION ALL SELECT c.conv_id, 1 AS part, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h) AS u) AS v),
k AS (SELECT conv_id, d, sha256(string_agg(turn, ',') OVER (PARTITION BY conv_id ORDER BY d)) AS key, words FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
p AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY d) AS up, d = max(d) OVER (PARTITION BY conv_id) AS is_end FROM k),
n AS (SELECT key, d, min(conv_id) AS least, min(up) AS up, count(*) AS n_convs, min(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256 FROM p GROUP BY key, d),
m AS (SELECT n.*, (SELECT count(*) FROM n AS x WHERE x.up = n.key) AS n_children FROM n),
s AS (SELECT a.key, sum((m.n_convs - 1) * m.words) AS saved, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves
  FROM m JOIN k AS a ON a.conv_id = m.least AND a.d <= m.d GROUP BY a.key)
SELECT m.least AS conv_id, CAST(m.d AS bigint) AS depth, u.least AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
  CAST(s.saved AS bigint) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON m.key = s.key LEFT JOIN n AS u ON m.up = u.key"""
