"""Shards of equal size that keep linked documents together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch


def _share(*parts: Column) -> Column:
    """A number in [0, 1) drawn from the hash of these values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def _numbers(values: list[float]) -> Column:
    """One number per shard."""
    return F.array(*map(F.lit, values)).cast("array<double>")


def propagate(nodes: DataFrame, shards: int, scratch: Scratch, guard: int = 500) -> DataFrame:
    """Balanced label propagation over ``nodes`` (``node, hub``; documents with one hub are linked).

    Every node starts in a shard drawn by its hash. In each round every hub orders the shards
    by the number of its nodes there, and pours nodes from the end of this order into the room
    of the shards at its head, as many shards as it takes. A shard admits the part of those
    who want in for which it has room or others leave. Who goes where is drawn by hash, so
    that no list of candidates is ranked anywhere. Room is the even share of all nodes less
    the linked ones that are there; less than two standard deviations of the draw that last
    filled a shard counts as none. Once no shard with room is wanted, nodes of different hubs
    change places. Each move raises the sum of squares of the nodes per hub and shard, so that
    the rounds end: when no node that wants to move is admitted anywhere. More than ``guard``
    rounds raise an error. Nodes without a hub are placed last, by their hash, in proportion to the room that
    is left. At the end shards are numbered so that those with one largest group are
    neighbours.

    Returns ``node, hub, shard``.
    """
    capacity = nodes.count() / shards
    start = F.floor(_share(F.col("node"), F.lit(0)) * shards).cast("int").alias("shard")
    state = scratch.write(nodes.where("hub is not null").select("node", "hub", start), "linked")
    full_below = [1.0] * shards
    for turn in range(1, guard + 2):
        # One row per hub and shard in which it has nodes.
        tally = scratch.write(state.groupBy("hub", "shard").agg(F.count("*").alias("n")), "tally")
        main = F.max(F.struct("n", "hub")).alias("main")
        load = {r["shard"]: r for r in tally.groupBy("shard").agg(F.sum("n").alias("n"), main).collect()}
        room = [capacity - (load[s]["n"] if s in load else 0) for s in range(shards)]
        usable = [r if r >= least else 0.0 for r, least in zip(room, full_below)]
        # Where no shard with room is wanted, nodes may still change places.
        for able in (F.get(_numbers(usable), F.col("shard")), F.greatest(F.lit(capacity) - F.col("n"), F.lit(0.0))):
            wish = scratch.write(_wishes(tally, able), "wish")
            flows = wish.select("shard", "out", F.explode("goals").alias("g")).groupBy("shard", "g.goal")
            # At most one row per pair of shards.
            flow = {(r[0], r[1]): r[2] for r in flows.agg(F.sum(F.expr("out * g.width"))).collect()}
            parts, wanted = _admitted(flow, room)
            moving = sum(n * parts[t] for (_, t), n in flow.items())
            if moving >= 1:
                break
            scratch.drop(wish)
        if moving < 1:
            break
        if turn > guard:
            raise RuntimeError(f"nodes still want to move after {guard} rounds")
        part = _numbers(parts)
        moves = wish.select(
            "hub",
            "shard",
            (F.col("out") / F.col("n")).alias("leave"),
            F.transform(
                "goals",
                lambda g: F.struct(
                    g["goal"].alias("goal"),
                    g["low"].alias("low"),
                    (g["low"] + g["width"] * F.get(part, g["goal"])).alias("high"),
                ),
            ).alias("goals"),
        )
        draw = _share(F.col("node"), F.lit(turn)) / F.col("leave")
        goal = F.get(F.filter("goals", lambda g: (draw >= g["low"]) & (draw < g["high"])), F.lit(0))["goal"]
        moved = state.join(moves, ["hub", "shard"], "left").select(
            "node", "hub", F.coalesce(goal, F.col("shard")).alias("shard")
        )
        before, state = state, scratch.write(moved, f"round-{turn}")
        scratch.drop(before, tally, wish)
        for s, n in enumerate(wanted):
            if n:
                full_below[s] = max(1.0, 2 * (n * parts[s]) ** 0.5)
    # Shards that one group fills become neighbours: where exact counts shift a border, it
    # stays in the group.
    order = sorted(load, key=lambda s: (load[s]["main"]["hub"], -load[s]["main"]["n"]))
    order += [s for s in range(shards) if s not in load]
    state = state.withColumn("shard", F.get(F.array(*(F.lit(order.index(s)) for s in range(shards))), F.col("shard")))
    return _fill(nodes.where("hub is null"), state, shards, capacity).unionByName(state)


def _admitted(flow: dict[tuple[int, int], float], room: list[float]) -> tuple[list[float], list[float]]:
    """The part that each shard admits of those who want in, and their number.

    Admitted are no more than there is room and than leave for places that admit them.
    """
    parts, wanted = [1.0] * len(room), [0.0] * len(room)
    for (_, goal), n in flow.items():
        wanted[goal] += n
    for _ in range(1000):
        free = list(room)
        for (shard, goal), n in flow.items():
            free[shard] += n * parts[goal]
        less = [min(p, max(0.0, f) / w) if w else 0.0 for p, f, w in zip(parts, free, wanted)]
        done = max(p - q for p, q in zip(parts, less)) < 1e-6
        parts = less
        if done:
            break
    return parts, wanted


def _wishes(tally: DataFrame, room: Column) -> DataFrame:
    """How many nodes of a hub want to leave a shard (``out`` of ``n``), and the goals of that hub.

    A goal has the part of the hub's leaving nodes (``total``) that it would take, as ``low``
    and ``width`` between 0 and 1. A hub has at most one row per shard.
    """
    hub = Window.partitionBy("hub")
    order = hub.orderBy(F.desc("n"), F.desc("draw"), F.desc("shard"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At a shard: room in those before it, nodes in those behind it.
    ranked = (
        tally.withColumn("draw", _share(F.col("hub"), F.col("shard")))
        .withColumn("room", room)
        .withColumn("ahead", F.sum("room").over(upto) - F.col("room"))
        .withColumn("behind", F.sum("n").over(hub) - F.sum("n").over(upto))
    )
    between = lambda x, most: F.greatest(F.lit(0.0), F.least(x, F.col(most).cast("double")))
    # The room before the last goal is less than the nodes from there on; behind it all leave.
    poured = ranked.select(
        "hub",
        "shard",
        "n",
        "ahead",
        between(F.col("ahead") - F.col("behind"), "n").alias("out"),
        between(F.col("behind") - F.col("ahead"), "room").alias("take"),
    ).withColumn("total", F.sum("out").over(hub))
    goal = F.struct(
        F.col("shard").alias("goal"),
        (F.col("ahead") / F.col("total")).alias("low"),
        (F.col("take") / F.col("total")).alias("width"),
    )
    goals = F.collect_list(F.when((F.col("take") > 0) & (F.col("total") > 0), goal)).over(hub)
    return poured.withColumn("goals", goals).where("out > 0").select("hub", "shard", "n", "out", "total", "goals")


def _fill(single: DataFrame, state: DataFrame, shards: int, capacity: float) -> DataFrame:
    """Nodes without links, in proportion to the room of the shards (one number each, on the driver)."""
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    room = [max(0.0, capacity - load.get(s, 0)) for s in range(shards)]
    borders = [sum(room[: s + 1]) / (sum(room) or 1.0) for s in range(shards - 1)]
    bounds = F.array(*map(F.lit, borders)) if borders else F.array().cast("array<double>")
    shard = F.size(F.filter(bounds, lambda b: b <= F.col("draw")))
    drawn = single.withColumn("draw", _share(F.col("node"), F.lit(0)))
    return drawn.select("node", "hub", shard.cast("int").alias("shard"))


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Shards whose row counts differ by one at most, with few links between equal texts cut.

    Documents with equal texts are linked through a hub, their text's digest, so that a group
    of copies is as many links as rows. Label propagation (``propagate``) gathers groups under
    quotas. A group larger than a shard fills as many as it needs. Then all rows stand in one
    order: by label, and inside a label the groups one after another with unlinked rows before
    and behind them. Position ``p`` of ``n`` goes
    to shard ``p * shards // n``: sizes are exact, a shard border moves across rows without
    links where it can, and at most ``shards - 1`` groups that would fit a shard are cut by
    it.

    Positions come from one range partitioning and the sizes of its parts. The text is read
    once, for its digest; after that a row is some ten bytes.

    Null texts have size 16 and the checksum of an empty text, and are not linked. Rows that
    repeat keep their number, null ids count as ids. An empty table gives no rows.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, linked``.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(docs[text_col], F.lit(""))
    digest = scratch.write(
        docs.select(
            docs[id_col].alias("doc_id"),
            (F.octet_length(text) + 16).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.when(docs[text_col].isNotNull(), F.md5(text.cast("binary"))).alias("digest"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "digest",
    )
    copies = digest.where("digest is not null").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    nodes = scratch.write(
        digest.join(copies, "digest", "left").select(
            "node", F.when(F.col("n").isNotNull(), F.xxhash64("digest")).alias("hub")
        ),
        "nodes",
    )
    labels = propagate(nodes, shards, scratch)
    # Unlinked rows stand on both sides of the groups of a label.
    side = F.when(F.col("hub").isNotNull(), 1).otherwise(F.when(_share(F.col("node"), F.lit(-1)) < 0.5, 0).otherwise(2))
    ordered = labels.select("node", F.col("shard").alias("label"), side.alias("side"), F.coalesce("hub", F.lit(0)).alias("hub"))
    order = ["label", "side", "hub", "node"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lined = scratch.write(
        ordered.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("node", (F.col("hub") != 0).alias("linked"), F.monotonically_increasing_id().alias("at")),
        "lined",
    )
    # The upper bits of ``at`` are the range, the lower ones the place in it.
    part = F.shiftrightunsigned("at", 33)
    sizes = lined.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per range.
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    total = lined.count()
    position = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = (
        lined.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .select("node", "linked", position.alias("position"))
        .withColumn("shard", F.expr(f"cast(position * {shards} div {max(total, 1)} as int)"))
    )
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return (
        digest.join(placed, "node")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("position") - first).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "linked",
        )
    )
