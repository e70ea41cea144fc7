"""Edit logs applied set-wise to base tables.

Every edit has a seq. Facts about one key (a synapse's existence, its regions, an attribute of a body) end as
their last edit by seq says. A synapse's owner follows its own last edit and then, in order of seq, the merges and
deletions of its body after that; merges may chain. Only the rows that a log can read or change are taken from the graph's
tables; all others pass by. Derived tables are computed anew for the touched bodies, so no counter is ever moved by hand and
the result equals a full computation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from axonweave.operators.aggregate import connections
from axonweave.operators.graph import checkpointed
from axonweave.plans.changes import KEYS, changes, delta, touched_nodes, with_delta
from axonweave.plans.load import Graph

PROPERTY_KINDS = ("update_properties", "set_properties", "delete_property")
#: Kinds of edits, and the arguments that each needs.
KINDS = {
    "add_neuron": ("body_id",), "delete_neuron": ("body_id",), "update_properties": ("body_id", "props"), "set_properties": ("body_id", "props"), "delete_property": ("body_id", "props"),
    "add_skeleton": ("body_id", "skeleton"), "delete_skeleton": ("body_id",), "add_roi": ("syn_id", "roi"), "remove_roi": ("syn_id", "roi"), "add_synapse": ("syn_id",), "add_link": ("syn_id", "post_id"),
    "add_synapse_to_segment": ("syn_id", "body_id"), "delete_synapse": ("syn_id",), "orphan_synapse": ("syn_id",), "merge": ("bodies",), "split": ("body_id", "bodies", "synapses"),
}
#: Kinds that name synapses which must be there, that change tables' rows of synapses, and that say whose a synapse is.
ON_SYNAPSE = {"add_roi", "remove_roi", "add_synapse_to_segment", "delete_synapse", "orphan_synapse", "add_neuron", "add_link"}
OF_SYNAPSE = {"add_synapse", "delete_synapse"}
OF_REGION = {"add_roi", "remove_roi"}
OF_OWNER = {"add_synapse_to_segment", "orphan_synapse", "delete_synapse", "add_neuron", "split"}
#: Kinds that pass on or end what a body owns.
OF_BODY = {"merge", "delete_neuron"}


def _last(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per key the values of the row with the largest seq, with that seq."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct("seq", *values), "seq").alias("m")).select(*keys, "m.*")


def new_edits(edits: DataFrame, applied: DataFrame | None) -> DataFrame:
    """Edits not applied before, one of each mutation key: the one with the least seq, then the least hash of its row.
    Edits without key always count."""
    keyed = edits.where("mutation_key IS NOT NULL")
    if applied is not None:
        keyed = keyed.join(applied.select("mutation_key"), "mutation_key", "left_anti")
    order = F.struct(F.col("seq").alias("a"), F.xxhash64(F.to_json(F.struct(*keyed.columns))).alias("b"))
    first = keyed.groupBy("mutation_key").agg(F.min_by(F.struct(*(c for c in keyed.columns if c != "mutation_key")), order).alias("_e")).select("mutation_key", "_e.*")
    return edits.where("mutation_key IS NULL").unionByName(first.select(*edits.columns))


def _is_struct(name: str, body: DataFrame) -> Column:
    """Whether the attribute's value is the JSON of its struct, with the first field at least."""
    kind = body.schema[name].dataType
    if not isinstance(kind, StructType):
        return F.lit(False)
    return F.from_json(F.try_element_at("props", F.lit(name)), kind)[kind.fieldNames()[0]].isNotNull()


def formed(edits: DataFrame, body: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edits that say what their kind needs, and those that do not, with a reason. An edit's seq is its own. The log is written
    once, with the reasons beside it."""
    plain = {c: t for c, t in body.dtypes if c != "body_id"}
    absent = reduce(lambda a, b: a | b, ((F.col("kind") == k) & F.col(c).isNull() for k, need in KINDS.items() for c in need))
    few = "(kind = 'split' AND (coalesce(size(bodies), 0) < 1 OR coalesce(size(synapses), 0) < 1)) OR (kind = 'merge' AND coalesce(size(array_distinct(bodies)), 0) < 2) OR (kind = 'add_synapse' AND coalesce(type, '') NOT IN ('pre', 'post'))"
    hollow = "exists(coalesce(bodies, array()), b -> b IS NULL) OR exists(coalesce(synapses, array()), s -> s IS NULL) OR (kind = 'merge' AND size(array_distinct(bodies)) < size(bodies))"
    names = F.map_keys("props")
    strange = F.col("kind").isin(*PROPERTY_KINDS, "add_neuron") & F.exists(names, lambda n: ~n.isin(*plain))
    parse = [F.try_element_at("props", F.lit(c)).isNotNull() & (F.try_element_at("props", F.lit(c)).try_cast(t).isNull() if not t.startswith(("struct", "array", "map")) else ~F.coalesce(_is_struct(c, body), F.lit(False))) for c, t in plain.items() if t != "string"]
    wrong = (F.col("kind") != "delete_property") & F.col("kind").isin(*PROPERTY_KINDS, "add_neuron") & reduce(lambda a, b: a | b, parse, F.lit(False))
    twice = F.count("*").over(Window.partitionBy("seq")) > 1
    rules = [(F.col("seq").isNull(), "seq is missing"), (F.col("seq") < 0, "seq is negative"), (twice, "seq is not its own"), (~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "unknown kind"), (absent | F.expr(few) | F.expr(hollow), "malformed"), (strange, "unknown attribute"), (wrong, "value does not parse")]
    marked = checkpointed(edits.withColumn("reason", F.coalesce(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(why)) for bad, why in rules))))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def _event(edits: DataFrame, kind: str, key, value) -> DataFrame:
    return edits.where(F.col("kind") == kind).select(key.alias("key"), "seq", value.alias("value"))


def _before(events: DataFrame, state: DataFrame, asks: DataFrame) -> DataFrame:
    """asks(key, seq, ...) with value: that of the key's last event(key, seq, value) before seq, else that of
    state(key, value). State is what happened before any seq, so all three are dealt and sorted by key once."""
    rest = [c for c in asks.columns if c not in ("key", "seq")]
    happened = state.select("key", F.lit(-1).cast("long").alias("seq"), "value").unionByName(events.select("key", "seq", "value"))
    rows = asks.select("key", "seq", F.struct(*rest, F.lit(True).alias("_ask")).alias("ask")).unionByName(happened.select("key", "seq", F.struct("value").alias("event")), allowMissingColumns=True)
    earlier = Window.partitionBy("key").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    met = rows.withColumn("last", F.last("event", ignorenulls=True).over(earlier)).where("ask IS NOT NULL")
    return met.select("key", "seq", *(F.col(f"ask.{c}") for c in rest), F.col("last.value").alias("value"))


def _asks(edits: DataFrame, *kinds: str, key: str | None = None, many: str | None = None) -> DataFrame:
    rows = edits.where(F.col("kind").isin(*kinds))
    return rows.select(F.explode(many).alias("key") if many else F.col(key).alias("key"), "seq").distinct()


def _faults(graph: Graph, edits: DataFrame, events: DataFrame, kinds: set[str]) -> DataFrame:
    """seq and reason of the edits that do not hold if those in events are the ones that count before them. kinds: those
    that occur; what only others need is not asked."""
    first, syn, body = F.get("bodies", F.lit(0)), F.col("syn_id"), F.col("body_id")
    no = F.lit(None).cast("string")
    synapses = _event(events, "add_synapse", syn, F.col("type")).union(_event(events, "delete_synapse", syn, no))
    merged = events.where("kind = 'merge'").select(F.explode(F.slice("bodies", F.lit(2), F.greatest(F.size("bodies") - 1, F.lit(0)))).alias("key"), "seq", no.alias("value"))
    yes = F.lit("there")
    bodies = _event(events, "add_neuron", body, yes).union(_event(events, "delete_neuron", body, no)).union(_event(events, "split", first, yes)).union(merged)
    known_synapses, known_bodies = graph["synapse"].select(F.col("syn_id").alias("key"), F.col("type").alias("value")), graph["body"].select(F.col("body_id").alias("key"), yes.alias("value"))
    reason = lambda rows, why: rows.select("seq", F.lit(why).alias("reason"))
    bad = []

    if kinds & ON_SYNAPSE:
        wanted = _asks(edits, "add_roi", "remove_roi", "add_synapse_to_segment", "delete_synapse", "orphan_synapse", key="syn_id").withColumn("type", no)
        wanted = wanted.unionByName(_asks(edits, "add_neuron", many="synapses").withColumn("type", no))
        wanted = wanted.unionByName(_asks(edits, "add_link", key="syn_id").withColumn("type", F.lit("pre"))).unionByName(_asks(edits, "add_link", key="post_id").withColumn("type", F.lit("post")))
        found = _before(synapses, known_synapses, wanted)
        bad.append(found.select("seq", F.when(F.col("value").isNull(), "unknown synapse").when(F.col("value") != F.col("type"), "wrong type of synapse").alias("reason")).where("reason IS NOT NULL"))

    if "add_synapse" in kinds:
        new = edits.where("kind = 'add_synapse'")
        bad.append(reason(new.where("x IS NULL OR y IS NULL OR z IS NULL"), "synapse has no place"))
        bad.append(reason(new.where("NOT coalesce(confidence, 0) BETWEEN 0 AND 1 OR isnan(confidence)"), "synapse has a confidence outside 0 to 1"))
        bad.append(reason(_before(synapses, known_synapses, _asks(edits, "add_synapse", key="syn_id")).where("value IS NOT NULL"), "synapse exists"))
        # a place is taken by a synapse that is there: of the table, or added before
        here = new.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL").select("x", "y", "z", F.col("seq").alias("at"), F.col("syn_id").alias("own"))
        added = events.where("kind = 'add_synapse'").select("x", "y", "z", F.col("syn_id").alias("key"), F.col("seq").alias("since"))
        at_place = here.join(graph["synapse"].select("x", "y", "z", F.col("syn_id").alias("key")), ["x", "y", "z"]).select("key", F.col("at").alias("seq"), "own")
        at_place = at_place.union(here.join(added, ["x", "y", "z"]).where("since < at").select("key", F.col("at").alias("seq"), "own")).where("key <> own").distinct()
        bad.append(reason(_before(synapses, known_synapses, at_place).where("value IS NOT NULL"), "place is taken"))

    on_body = {"update_properties", "set_properties", "delete_property", "add_synapse_to_segment", "add_skeleton", "delete_skeleton", "delete_neuron", "split"}
    if kinds & (on_body | {"merge", "add_neuron"}):
        asks = _asks(edits, *on_body, key="body_id").union(_asks(edits, "merge", many="bodies")).withColumn("new", F.lit(False))
        asks = asks.unionByName(_asks(edits, "add_neuron", key="body_id").union(edits.where("kind = 'split'").select(first.alias("key"), "seq")).withColumn("new", F.lit(True)))
        there = _before(bodies, known_bodies, asks)
        bad.append(there.select("seq", F.when(F.col("new") & F.col("value").isNotNull(), "body exists").when(~F.col("new") & F.col("value").isNull(), "unknown body").alias("reason")).where("reason IS NOT NULL"))

    if kinds & {"add_skeleton", "delete_skeleton"}:
        drawn = _event(events, "add_skeleton", body, yes).union(_event(events, "delete_skeleton", body, no)).union(_event(events, "delete_neuron", body, no)).union(merged)
        known = graph["skel_node"].select(F.col("body_id").alias("key"), yes.alias("value")).distinct()
        asks = _asks(edits, "add_skeleton", key="body_id").withColumn("new", F.lit(True)).unionByName(_asks(edits, "delete_skeleton", key="body_id").withColumn("new", F.lit(False)))
        there = _before(drawn, known, asks)
        bad.append(there.select("seq", F.when(F.col("new") & F.col("value").isNotNull(), "skeleton exists").when(~F.col("new") & F.col("value").isNull(), "skeleton is absent").alias("reason")).where("reason IS NOT NULL"))

    if kinds & {"add_neuron", "add_link", "split"}:
        free = _asks(edits, "add_neuron", many="synapses").union(_asks(edits, "add_link", key="syn_id")).union(_asks(edits, "add_link", key="post_id")).distinct()
        parts = edits.where("kind = 'split'").select(F.explode("synapses").alias("key"), "seq", F.col("body_id").alias("of"))
        asks = checkpointed(free.withColumn("of", F.lit(None).cast("long")).unionByName(parts).distinct())
        if not asks.isEmpty():
            owners = _owned_before(graph, events, asks, kinds)
            bad.append(reason(owners.where("of IS NULL AND owner IS NOT NULL"), "synapse has an owner"))
            bad.append(reason(owners.where("of IS NOT NULL AND NOT owner <=> of"), "synapse is not the body's"))
    every = reduce(DataFrame.union, bad) if bad else edits.select("seq", no.alias("reason")).where("false")
    return every.groupBy("seq").agg(F.min("reason").alias("reason"))


def checked(graph: Graph, edits: DataFrame, kinds: set[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Edits that hold at their seq, and the rejected ones with a reason.

    Only edits that hold count for later ones: the check is made again without those that it rejected until nothing
    changes. An edit is settled once all edits that it depends on are, so rounds are as many as the longest chain
    of edits that decide about one another.
    """
    kinds = set(KINDS) if kinds is None else kinds
    bad = checkpointed(_faults(graph, edits, edits, kinds))
    if bad.isEmpty():
        return edits, edits.withColumn("reason", F.lit(None).cast("string")).where(F.lit(False))
    while not bad.isEmpty():
        again = checkpointed(_faults(graph, edits, edits.join(bad.select("seq"), "seq", "left_anti"), kinds))
        both = again.withColumn("d", F.lit(1)).union(bad.withColumn("d", F.lit(-1))).groupBy("seq", "reason").agg(F.sum("d").alias("d")).where("d <> 0")
        settled = both.isEmpty()
        bad = again
        if settled:
            break
    marked = checkpointed(edits.join(bad, "seq", "left"))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def _owner_events(edits: DataFrame) -> DataFrame:
    """key (a synapse), seq and value (the body that it belongs to from then on, or null)."""
    syn, none = F.col("syn_id"), F.lit(None).cast("long")
    own = _event(edits, "add_synapse_to_segment", syn, F.col("body_id")).union(_event(edits, "orphan_synapse", syn, none)).union(_event(edits, "delete_synapse", syn, none))
    return own.union(_event(edits, "add_neuron", F.explode("synapses"), F.col("body_id"))).union(_event(edits, "split", F.explode("synapses"), F.get("bodies", F.lit(0))))


def _moves(edits: DataFrame) -> DataFrame:
    """old, at, next: what becomes of a body's synapses by merges and deletions."""
    merged = edits.where("kind = 'merge'").select(F.explode("bodies").alias("old"), F.col("seq").alias("at"), F.get("bodies", F.lit(0)).alias("next")).where("old <> next")
    gone = edits.where("kind = 'delete_neuron'").select(F.col("body_id").alias("old"), F.col("seq").alias("at"), F.lit(None).cast("long").alias("next"))
    return merged.unionByName(gone)


def _owned_before(graph: Graph, edits: DataFrame, asks: DataFrame, kinds: set[str]) -> DataFrame:
    """asks(key, seq, of) with the owner of the synapse just before seq."""
    base = _with_keys(graph["membership"], "syn_id", asks.select("key").distinct()).select(F.col("syn_id").alias("key"), F.struct(F.col("body_id").alias("owner"), F.lit(-1).cast("long").alias("since")).alias("value"))
    events = _owner_events(edits).select("key", "seq", F.struct(F.col("value").alias("owner"), F.col("seq").alias("since")).alias("value"))
    at = checkpointed(_before(events, base, asks).select("key", "seq", "of", "value.owner", "value.since"))
    if not kinds & {"merge", "delete_neuron"}:
        return at
    moves = checkpointed(_moves(edits))
    while True:
        step = at.where("owner IS NOT NULL").join(moves, (F.col("owner") == F.col("old")) & (F.col("at") > F.col("since")) & (F.col("at") < F.col("seq"))).groupBy("key", "seq").agg(F.min_by(F.struct("at", "next"), "at").alias("m"))
        step = checkpointed(step)
        if step.isEmpty():
            return at
        at = checkpointed(at.join(step, ["key", "seq"], "left").select("key", "seq", "of", F.when(F.col("m").isNotNull(), F.col("m.next")).otherwise(F.col("owner")).alias("owner"), F.coalesce("m.at", "since").alias("since")))


def _fates(edits: DataFrame, own: DataFrame | None) -> DataFrame:
    """body_id, seq, owner: whose the synapses are at the end that body_id has owned since seq (-1: since before the edits), or null.
    Held for bodies that were merged or deleted; owners that own(seq, owner) names start at their seq. Synapses of one body and
    seq share their fate, so bodies are followed and not synapses, in as many rounds as the longest chain of merges of one body."""
    moves = checkpointed(_moves(edits))
    starts = moves.select(F.col("old").alias("body_id"), F.lit(-1).cast("long").alias("seq"))
    if own is not None:
        starts = starts.unionByName(own.where("owner IS NOT NULL").select(F.col("owner").alias("body_id"), "seq"))
    at = checkpointed(starts.distinct().select("body_id", "seq", F.col("body_id").alias("owner"), F.col("seq").alias("since")))
    while True:
        step = at.where("owner IS NOT NULL").join(moves, (F.col("owner") == F.col("old")) & (F.col("at") > F.col("since"))).groupBy("body_id", "seq").agg(F.min_by(F.struct("at", "next"), "at").alias("m"))
        step = checkpointed(step)
        if step.isEmpty():
            return at.where("NOT owner <=> body_id OR since <> seq").select("body_id", "seq", "owner")
        at = checkpointed(at.join(step, ["body_id", "seq"], "left").select("body_id", "seq", F.when(F.col("m").isNotNull(), F.col("m.next")).otherwise(F.col("owner")).alias("owner"), F.coalesce("m.at", "since").alias("since")))


def _followed(rows: DataFrame, fates: DataFrame, on: list[str]) -> DataFrame:
    """rows(body_id, ...) with the owner at the end in place of body_id."""
    met = rows.join(fates.select(*on, F.col("owner").alias("_owner"), F.lit(True).alias("_moved")), on, "left")
    return met.withColumn("body_id", F.when(F.col("_moved"), F.col("_owner")).otherwise(F.col("body_id"))).drop("_owner", "_moved")


def _owners(edits: DataFrame, kinds: set[str]) -> Callable[[DataFrame], DataFrame]:
    """What the edits make of membership, or of some of its rows: synapses with an edit of their own are its last one's, others
    go with their body."""
    own = None
    if kinds & OF_OWNER:
        own = checkpointed(_last(_owner_events(edits).select(F.col("key").alias("syn_id"), "seq", F.col("value").alias("owner")), ["syn_id"], ["owner"]))
    fates = None
    if kinds & OF_BODY:
        fates = _fates(edits, own)
    given = None
    if own is not None:
        given = own.select("syn_id", "seq", F.col("owner").alias("body_id"))
        given = checkpointed(_followed(given, fates, ["body_id", "seq"]).drop("seq")) if fates is not None else given.drop("seq")

    def after(membership: DataFrame) -> DataFrame:
        rows = membership if fates is None else _followed(membership, fates.where("seq = -1"), ["body_id"]).where("body_id IS NOT NULL")
        if given is not None:
            rows = rows.join(given.select("syn_id"), "syn_id", "left_anti").unionByName(given.where("body_id IS NOT NULL"), allowMissingColumns=True)
        return rows.select(*membership.columns)

    return after


def _states(edits: DataFrame) -> DataFrame:
    """The synapses that edits add or delete, as their last edit leaves them."""
    added = edits.where("kind = 'add_synapse'").select("syn_id", "seq", F.lit(True).alias("on"), "x", "y", "z", "type", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.array_distinct(F.array_compact(F.coalesce("rois", F.array().cast("array<string>")))).alias("rois"))
    dropped = edits.where("kind = 'delete_synapse'").select("syn_id", "seq", F.lit(False).alias("on"), *(F.lit(None).cast(t).alias(c) for c, t in (("x", "long"), ("y", "long"), ("z", "long"), ("type", "string"), ("confidence", "double"), ("rois", "array<string>"))))
    return checkpointed(_last(added.unionByName(dropped), ["syn_id"], ["on", "x", "y", "z", "type", "confidence", "rois"]))


def _with_states(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    """rows of synapses, of any of their columns, without those that went and with those that came."""
    if state is None:
        return rows
    came = state.where("on").select(*(c for c in state.columns if c in rows.columns))
    return rows.join(state.select("syn_id"), "syn_id", "left_anti").unionByName(came, allowMissingColumns=True)


def _synapses(edits: DataFrame, kinds: set[str], state: DataFrame | None) -> Callable[[DataFrame], DataFrame]:
    """What the edits make of the synapses, or of some of them. Regions are put to the rows by one join with their synapse's edits."""
    sets = None
    if kinds & OF_REGION:
        change = edits.where("kind IN ('add_roi', 'remove_roi')").select("syn_id", "roi", "seq", (F.col("kind") == "add_roi").alias("on"))
        change = change.groupBy("syn_id", "roi").agg(F.max("seq").alias("seq"), F.max(F.when(F.col("on"), F.col("seq"))).alias("_put"))
        change = change.withColumn("on", F.coalesce(F.col("_put") == F.col("seq"), F.lit(False)))
        if state is not None:  # a region edit before a synapse was added anew says nothing about the new one
            change = change.join(state.where("on").select("syn_id", F.col("seq").alias("born")), "syn_id", "left").where("born IS NULL OR seq > born")
        sets = checkpointed(change.groupBy("syn_id").agg(F.sort_array(F.collect_set(F.when(F.col("on"), F.col("roi")))).alias("plus"), F.collect_set(F.when(~F.col("on"), F.col("roi"))).alias("minus")))

    def after(synapse: DataFrame) -> DataFrame:
        rows = _with_states(synapse, state)
        if sets is None:
            return rows.select(*synapse.columns)
        rois = F.array_union(F.array_except("rois", "minus"), "plus")
        return rows.join(sets, "syn_id", "left").withColumn("rois", F.when(F.col("plus").isNotNull(), rois).otherwise(F.col("rois"))).select(*synapse.columns)

    return after


def _settings(edits: DataFrame) -> DataFrame:
    """body_id, name, seq, value: each attribute that an edit sets; null in set_properties and delete_property
    removes."""
    rows = edits.where(F.col("kind").isin(*PROPERTY_KINDS, "add_neuron")).select("body_id", "seq", "kind", F.explode("props").alias("name", "value"))
    rows = rows.where("value IS NOT NULL OR kind IN ('set_properties', 'delete_property')")
    return rows.select("body_id", "name", "seq", F.when(F.col("kind") != "delete_property", F.col("value")).alias("value"))


def _properties(bodies: DataFrame, settings: DataFrame) -> DataFrame:
    """bodies with the last value set for each attribute."""
    last = _last(settings, ["body_id", "name"], ["value"]).groupBy("body_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("_m"))
    out = bodies.join(last, "body_id", "left")
    for c, t in bodies.dtypes:
        if c != "body_id" and not t.startswith(("struct", "array", "map")):
            out = out.withColumn(c, F.when(F.coalesce(F.map_contains_key("_m", F.lit(c)), F.lit(False)), F.try_element_at("_m", F.lit(c)).try_cast(t)).otherwise(F.col(c)))
        elif t.startswith("struct"):
            out = out.withColumn(c, F.when(F.coalesce(F.map_contains_key("_m", F.lit(c)), F.lit(False)), F.from_json(F.try_element_at("_m", F.lit(c)), t)).otherwise(F.col(c)))
    return out.drop("_m")


def _bodies(graph: Graph, edits: DataFrame, kinds: set[str]) -> DataFrame:
    """Bodies after the edits. Merges and splits take attributes as they are at their seq, so the log is cut at them:
    a body's state is set by its settings, then passed on by the next merge or split, and so forth. Rounds are as
    many as the longest chain of merges and splits of one body; only bodies that take part are in them."""
    bodies = graph["body"]
    plain = [c for c, t in bodies.dtypes if c != "body_id" and not t.startswith(("struct", "array", "map"))]
    new = edits.where("kind = 'add_neuron'").select("body_id").distinct().join(bodies.select("body_id"), "body_id", "left_anti")
    bodies = bodies.unionByName(new, allowMissingColumns=True)
    settings = checkpointed(_settings(edits))
    last = edits.where("kind IN ('delete_neuron', 'add_neuron')").groupBy("body_id").agg(F.max_by("kind", "seq").alias("kind")).where("kind = 'delete_neuron'")
    if not kinds & {"merge", "split"}:
        born = edits.where("kind = 'add_neuron'").groupBy("body_id").agg(F.max("seq").alias("_born"))
        due = settings.join(born, "body_id", "left").where("_born IS NULL OR seq >= _born").drop("_born") if "delete_neuron" in kinds else settings
        return _properties(bodies, due).join(last, "body_id", "left_anti")
    merges = edits.where("kind = 'merge'").select("seq", F.get("bodies", F.lit(0)).alias("target"), F.posexplode("bodies").alias("position", "body_id"))
    splits = edits.where("kind = 'split'").select("seq", F.get("bodies", F.lit(0)).alias("target"), F.explode(F.array(F.struct(F.lit(0).alias("position"), F.get("bodies", F.lit(0)).alias("body_id")), F.struct(F.lit(1).alias("position"), F.col("body_id").alias("body_id")))).alias("p")).select("seq", "target", "p.position", "p.body_id")
    steps = checkpointed(merges.withColumn("kind", F.lit("merge")).unionByName(splits.withColumn("kind", F.lit("split"))))
    chained = checkpointed(steps.select("target").union(steps.select("body_id")).distinct().withColumnRenamed("target", "body_id"))
    state = checkpointed(chained.join(bodies, "body_id", "left").withColumn("_at", F.lit(-1).cast("long")))
    while not steps.isEmpty():
        # the steps that no earlier step of one of their bodies is before
        first = steps.groupBy("body_id").agg(F.min("seq").alias("due"))
        ready = steps.join(first, "body_id").groupBy("seq").agg(F.bool_and(F.col("due") == F.col("seq")).alias("ok")).where("ok").select("seq")
        now = checkpointed(steps.join(ready, "seq", "left_semi"))
        parts = now.join(state, "body_id")
        due = settings.join(parts.select("body_id", F.col("seq").alias("_to"), "_at"), "body_id").where("seq > _at AND seq < _to").drop("_at", "_to")
        parts = _properties(parts, due)
        values = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("position"))).alias(c) if c != "size" else F.when(F.first("kind") == "merge", F.sum("size")).otherwise(F.max("size")).alias(c) for c in plain]
        values += [F.when(F.first("kind") == "merge", F.min_by(c, F.when(F.col(c).isNotNull(), F.col("position")))).alias(c) for c, t in bodies.dtypes if c != "body_id" and c not in plain]
        made = parts.groupBy(F.col("target").alias("body_id"), "seq").agg(*values).withColumnRenamed("seq", "_at")
        # what a merge takes in is gone; a split's old body goes on as it was
        old = now.where("body_id <> target").join(state, "body_id").select("kind", "seq", *state.columns)
        rest = state.join(now.select("body_id").union(now.select("target")).distinct(), "body_id", "left_anti")
        kept = old.where("kind = 'split'").select(*state.columns)
        state = checkpointed(rest.unionByName(made.select(*state.columns)).unionByName(kept))
        steps = checkpointed(steps.join(ready, "seq", "left_anti"))
    taken = checkpointed(edits.where("kind = 'merge'").select(F.explode("bodies").alias("body_id"), "seq", F.get("bodies", F.lit(0)).alias("target")).where("body_id <> target").groupBy("body_id").agg(F.max("seq").alias("_gone")))
    every = bodies.join(chained, "body_id", "left_anti").withColumn("_at", F.lit(-1).cast("long")).unionByName(state)
    later = settings.join(every.select("body_id", "_at"), "body_id").where("seq > _at").drop("_at")
    # a body that is added again after it went starts anew
    born = edits.where("kind IN ('add_neuron', 'split')").select(F.when(F.col("kind") == "split", F.get("bodies", F.lit(0))).otherwise(F.col("body_id")).alias("body_id"), "seq").groupBy("body_id").agg(F.max("seq").alias("_born"))
    out = _properties(every, later).drop("_at").join(taken, "body_id", "left").join(born, "body_id", "left").where("_gone IS NULL OR _born > _gone").drop("_gone", "_born")
    return out.join(last, "body_id", "left_anti")


def _skeletons(graph: Graph, edits: DataFrame, bodies: DataFrame) -> DataFrame:
    events = edits.where("kind IN ('add_skeleton', 'delete_skeleton')").select("body_id", "seq", "kind", "skeleton")
    had = graph["skel_node"].select("body_id").distinct()
    last = events.groupBy("body_id").agg(F.max_by("kind", "seq").alias("kind"), F.max(F.when(F.col("kind") == "delete_skeleton", F.col("seq"))).alias("cleared"))
    kept = graph["skel_node"].join(last.where("cleared IS NOT NULL").select("body_id"), "body_id", "left_anti")
    # an addition counts if no skeleton is there: the first after the last deletion, or the first of a body that had none
    adds = events.where("kind = 'add_skeleton'").join(last.select("body_id", "cleared"), "body_id").join(had.withColumn("had", F.lit(True)), "body_id", "left")
    adds = adds.where("seq > coalesce(cleared, -1) AND (had IS NULL OR cleared IS NOT NULL)").groupBy("body_id").agg(F.min_by("skeleton", "seq").alias("s"))
    rows = kept.unionByName(adds.select("body_id", F.inline("s")), allowMissingColumns=True).select(*graph["skel_node"].columns)
    return rows.join(bodies.select("body_id"), "body_id", "left_semi")


def _named(edits: DataFrame, one: tuple[str, ...], many: str, *kinds: str) -> DataFrame:
    """key: ids that edits (of some kinds) name in single columns or in a list."""
    rows = edits.where(F.col("kind").isin(*kinds)) if kinds else edits
    return rows.select(F.explode(F.array_union(F.coalesce(many, F.array().cast("array<bigint>")), F.array(*one))).alias("key")).where("key IS NOT NULL").distinct()


def _with_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    return df.join(keys.withColumnRenamed("key", column), column, "left_semi").select(*df.columns)


def part_of(graph: Graph, edits: DataFrame, kinds: set[str]) -> Graph:
    """The rows that edits can read or change. Keys come from the edits; tables are semi-joined with them, which is a broadcast
    while the edits are few. Written are the rows that checks ask for more than once; the others are read if somebody asks."""
    synapses, bodies = checkpointed(_named(edits, ("syn_id", "post_id"), "synapses")), checkpointed(_named(edits, ("body_id",), "bodies"))
    membership = _with_keys(graph["membership"], "syn_id", synapses)
    if kinds & OF_OWNER:
        membership = checkpointed(membership)
    if kinds & OF_BODY:
        moved = _named(edits, ("body_id",), "bodies", *OF_BODY)
        membership = membership.unionByName(_with_keys(graph["membership"], "body_id", moved).join(synapses.withColumnRenamed("key", "syn_id"), "syn_id", "left_anti").select(*membership.columns))
    synapse = _with_keys(graph["synapse"], "syn_id", synapses)
    if "add_synapse" in kinds:
        places = edits.where("kind = 'add_synapse'").select("x", "y", "z").distinct()
        synapse = synapse.unionByName(graph["synapse"].join(places, ["x", "y", "z"], "left_semi").join(synapses.withColumnRenamed("key", "syn_id"), "syn_id", "left_anti").select(*synapse.columns))
    out = {"membership": membership, "synapse": synapse, "body": checkpointed(_with_keys(graph["body"], "body_id", bodies))}
    # a body that comes anew has no row, so tables of none are none
    none = F.lit(False)
    out["syn_edge"] = graph["syn_edge"].where(none)
    if kinds & {"delete_synapse", "add_link"}:
        ends = checkpointed(_named(edits.withColumn("_no", F.array().cast("array<bigint>")), ("syn_id", "post_id"), "_no", "delete_synapse", "add_link"))
        before = _with_keys(graph["syn_edge"], "pre_id", ends)
        out["syn_edge"] = checkpointed(before.unionByName(_with_keys(graph["syn_edge"], "post_id", ends).join(ends.withColumnRenamed("key", "pre_id"), "pre_id", "left_anti").select(*before.columns)))
    if "skel_node" in graph:
        drawn = kinds & {"add_skeleton", "delete_skeleton"}
        nodes = _with_keys(graph["skel_node"], "body_id", bodies) if drawn or kinds & OF_BODY else graph["skel_node"].where(none)
        out["skel_node"] = checkpointed(nodes) if drawn else nodes
    return out


@dataclass
class Edited:
    """What edits come to: the rows of the base tables that they concern, before and after (the same frame, if no edit changes the
    table); the bodies touched; and the rejected edits with their reasons. steps: of tables whose rows change by joins, what makes
    the rows after of any rows before. gone: of tables that only lose rows, the keys of these."""

    old: Graph
    new: Graph
    touched: DataFrame
    rejected: DataFrame
    steps: dict[str, Callable[[DataFrame], DataFrame]]
    gone: Graph


def edited(graph: Graph, edits: DataFrame) -> Edited:
    """The effect of edits on a graph, without the rows that they leave alone. Base tables: synapse, syn_edge, membership, body,
    skel_node, and applied (mutation_key), if keys are to be remembered."""
    if "rois" not in edits.columns:
        edits = edits.withColumn("rois", F.lit(None).cast("array<string>"))
    fresh, odd = formed(new_edits(edits, graph.get("applied")), graph["body"])
    kinds = {r.kind for r in fresh.select("kind").distinct().collect()}  # of KINDS
    old = part_of(graph, fresh, kinds)
    known = old["synapse"].select("syn_id", "type", *("xyz" if "add_synapse" in kinds else ()))  # what checks ask of a synapse
    known = checkpointed(known) if kinds & (ON_SYNAPSE | OF_SYNAPSE) else known
    good, bad = checked(old | {"synapse": known}, fresh, kinds)
    steps, gone, links = {}, {}, old["syn_edge"]
    state = _states(good) if kinds & OF_SYNAPSE else None
    if kinds & (OF_SYNAPSE | OF_REGION):
        steps["synapse"] = _synapses(good, kinds, state)
        if not kinds & (OF_REGION | {"add_synapse"}):
            gone["synapse"] = _with_keys(known.select("syn_id"), "syn_id", state.select(F.col("syn_id").alias("key")))
    if kinds & (OF_OWNER | OF_BODY):
        steps["membership"] = _owners(good, kinds)
    if kinds & {"delete_synapse", "add_link"}:
        added = good.where("kind = 'add_link'").select(F.col("syn_id").alias("pre_id"), "post_id", "seq")
        sides = _with_states(known.select("syn_id", "type"), state)
        fit = added.join(sides.where("type = 'pre'").select(F.col("syn_id").alias("pre_id")), "pre_id", "left_semi").join(sides.where("type = 'post'").select(F.col("syn_id").alias("post_id")), "post_id", "left_semi")
        links = links.select("pre_id", "post_id", F.lit(-1).cast("long").alias("seq")).unionByName(fit).groupBy("pre_id", "post_id").agg(F.max("seq").alias("seq"))
        lost = good.where("kind = 'delete_synapse'").groupBy("syn_id").agg(F.max("seq").alias("at"))  # links go with a synapse, even if it is added anew
        for end in ("pre_id", "post_id"):
            links = links.join(lost.select(F.col("syn_id").alias(end), F.col("at").alias(f"_{end}")), end, "left").where(F.coalesce(F.col(f"_{end}") < F.col("seq"), F.lit(True)))
        links = checkpointed(links.select("pre_id", "post_id"))
    changed = kinds & (OF_BODY | {"add_neuron", "split", *PROPERTY_KINDS})
    bodies = checkpointed(_bodies(old, good, kinds)) if changed else old["body"]
    new = {"syn_edge": links, "body": bodies} | {t: steps[t](old[t]) if t in steps else old[t] for t in ("synapse", "membership")}
    if "skel_node" in old:
        new["skel_node"] = _skeletons(old, good, bodies) if kinds & {"add_skeleton", "delete_skeleton", *OF_BODY} else old["skel_node"]
    keys = good.where("mutation_key IS NOT NULL").select("mutation_key").distinct()
    new["applied"], old["applied"] = keys, keys.where(F.lit(False))
    return Edited(old, new, touched_bodies(old, new, good), bad.unionByName(odd), steps, gone)


def merged(graph: Graph, part: Edited) -> Graph:
    """graph with the rows of part as they are afterwards; all other rows are passed on as they are read, and so are tables
    that no edit changes."""
    out = {}
    for name, new in part.new.items():
        if name not in graph:
            out[name] = new
        elif new is part.old[name]:
            out[name] = graph[name]
        elif name in part.steps:
            out[name] = part.steps[name](graph[name])
        else:
            keys = KEYS[name]
            was = part.old[name].select(*keys).withColumn("_gone", F.lit(True))
            out[name] = with_delta(graph[name], [was, new.withColumn("_gone", F.lit(False))], keys)
    return out


def changed_rows(part: Edited) -> Graph:
    """Of each table that edits may change, the rows that come, change or go, as `delta` has them."""
    out = {}
    for name, new in part.new.items():
        if name in part.gone:
            rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema if f.name not in KEYS[name]]
            out[name] = part.gone[name].select(*KEYS[name], *rest, F.lit(True).alias("_gone")).select(*new.columns, "_gone")
        elif name in part.steps:
            was = checkpointed(part.old[name])
            out[name] = delta(was, checkpointed(part.steps[name](was)), KEYS[name])
        elif new is not part.old[name]:
            out[name] = delta(part.old[name], new, KEYS[name])
    return out


def touched_by(graph: Graph, part: Edited, **options) -> Graph:
    """What `touched_nodes` says of graph before and after the edits of part, connections included (options: those of
    `connections`). Compared are the rows that the edits concern; others are as they were."""
    found = {}
    for name, new in part.new.items():
        if name in part.gone:
            found[name] = checkpointed(part.gone[name].withColumn("change", F.lit("deleted")))
        elif name in graph and new is not part.old[name]:
            found[name] = checkpointed(changes(part.old[name], new, KEYS[name]))
    links = _changed_connections(graph, found, **options)
    return {node: checkpointed(keys) for node, keys in touched_nodes(graph, merged(graph, part), found | {"connection": links}).items()}


def _changed_connections(graph: Graph, found: Graph, **options) -> DataFrame:
    """Connections whose weights differ, with found, the changes of tables. A post counts for a connection once, whatever the
    others do, so the weights that come from posts with a changed link, end or owner say which connections differ."""
    after = lambda rows, t: with_delta(rows, [found[t].select(*KEYS[t], *(["now.*"] if "now" in found[t].columns else []), (F.col("change") == "deleted").alias("_gone"))], KEYS[t]) if t in found else rows
    ids = checkpointed(reduce(DataFrame.unionByName, (found[t].select(F.col("syn_id").alias("key")) for t in ("synapse", "membership") if t in found), graph["membership"].select(F.col("syn_id").alias("key")).where(F.lit(False))).distinct())
    posts = _with_keys(graph["syn_edge"], "pre_id", ids).select(F.col("post_id").alias("key")).unionByName(ids)
    if "syn_edge" in found:
        posts = posts.unionByName(found["syn_edge"].select(F.col("post_id").alias("key")))
    old = checkpointed(_with_keys(graph["syn_edge"].select("pre_id", "post_id"), "post_id", posts.distinct()))
    new = checkpointed(after(old, "syn_edge")) if "syn_edge" in found else old
    ends = checkpointed(reduce(DataFrame.union, (g.select(c) for g in (old, new) for c in ("pre_id", "post_id"))).distinct().withColumnRenamed("pre_id", "key"))
    synapse, membership = (checkpointed(_with_keys(graph[t].select("syn_id", c), "syn_id", ends)) for t, c in (("synapse", "confidence"), ("membership", "body_id")))

    def weights(links: DataFrame, synapse: DataFrame, membership: DataFrame) -> DataFrame:
        owned = synapse.join(membership, "syn_id")
        end = lambda s: owned.select(*(F.col(c).alias(f"{s}_{n}") for c, n in (("syn_id", "id"), ("body_id", "body"), ("confidence", "conf"))))
        return connections(links.join(end("pre"), "pre_id").join(end("post"), "post_id"), **options)

    return checkpointed(changes(weights(old, synapse, membership), weights(new, after(synapse, "synapse"), after(membership, "membership")), KEYS["connection"]).select(*KEYS["connection"]))


def apply_edits(graph: Graph, edits: DataFrame) -> tuple[Graph, DataFrame, DataFrame]:
    """The base tables after the edits, the bodies touched, and the rejected edits. Nothing is written, so a dry
    run is a call whose result is not stored. Of the base tables (see `edited`) only the rows that the edits concern are worked
    on."""
    part = edited(graph, edits)
    return merged(graph, part), part.touched, part.rejected


def touched_bodies(old: Graph, new: Graph, edits: DataFrame) -> DataFrame:
    """body_id of every body that an edit names or whose synapses it changes, before or after."""
    named = edits.select(F.explode(F.array_union(F.coalesce("bodies", F.array().cast("array<bigint>")), F.array("body_id"))).alias("body_id"))
    syns = edits.select(F.explode(F.array_union(F.coalesce("synapses", F.array().cast("array<bigint>")), F.array("syn_id", "post_id"))).alias("syn_id")).where("syn_id IS NOT NULL").distinct()
    held = [g["membership"].join(syns, "syn_id", "left_semi").select("body_id") for g in (old, new)]
    return named.union(held[0]).union(held[1]).where("body_id IS NOT NULL").distinct()


def without_repeats(connection_synapses: DataFrame) -> DataFrame:
    return connection_synapses.dropDuplicates(["pre_body", "post_body", "syn_id"])


def stamped(old: DataFrame, new: DataFrame, keys: list[str], ts) -> DataFrame:
    """new with column ts: the given time for rows that were added or changed, the old stamp for the rest."""
    rest = [c for c in new.columns if c not in (*keys, "ts")]
    before = old.select(*keys, F.struct(*rest).alias("_old"), F.col("ts").alias("_ts"))
    rows = new.drop("ts").join(before, keys, "left")
    # maps cannot be compared; their JSON can
    same = F.to_json("_old").eqNullSafe(F.to_json(F.struct(*rest))) & F.col("_old").isNotNull()
    return rows.withColumn("ts", F.when(same, F.col("_ts")).otherwise(F.date_trunc("second", F.lit(ts)))).drop("_old", "_ts")
