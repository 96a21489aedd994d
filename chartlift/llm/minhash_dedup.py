"""Near-duplicates by circulant MinHash, banding and exact Jaccard checks (operator 10).

One permutation scatters the shingles; a second one, applied to circular shifts of the first, gives all coordinates
of the signature: coordinate k is the least value of ``second(first(x) + k * shift)``. Bands of six coordinates are
the buckets; two sets of similarity 0.75 miss all 64 bands about once in 30,000 times.

Documents with equal sets are one class, found by a digest, and only its smallest id goes on. In a bucket all members
are compared with one hub, the member that shares most buckets with others, so a bucket of n members costs n
comparisons. Members f and p that are linked with each other but not both with their hub h are found without pairing
off the group. Of the shingles outside h that members of several components have, those of more than SMALL members are
the family's frequent ones: h and they make one set, F, and what a member shares with F is known by counting. Of the
shingles that f and p share, at most min(a, b) are in F, where a and b are the numbers that each shares with F. Either f and
p share rare shingles too, as many as the link needs besides those in F: a member that has fewer in common with members of
other components leaves, and the others meet in the group of such a shingle (a prefix of each set's rare common shingles, in
order, is enough; of groups with the same members the first is). No group has more than SMALL members, and the pairs of two
components are compared whose sizes, overlaps with F, shingles from the shared one on and parities of shingles allow a link (two
linked sets differ in at most a seventh of both sizes). Or the link may lie within F, which only members with three quarters
of their shingles in F allow. Where all but few of these are in one component, the few are paired with the others, by the same bounds;
else all are compared with the heaviest of them, a hub lighter than h, and searched again as its family. What counts as few
grows fourfold with each round, so there are few rounds, whatever the copies of one text differ in. Only families that the last
round added to are searched again, for pairs with an added member. Every link is confirmed on the full shingle sets.

Documents without words are linked with nothing. Rows with a null id take no part and are kept. Rows that share an id
share a component. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import map_texts, pieces, texts_of
from chartlift.llm.components import components
from chartlift.llm.shingles import GROUP_CHARS, mix, shingle_sets
from chartlift.operators.joins import attach
from chartlift.runtime import discard, scratch_path, settle, written

SHINGLE = 5
PERCENT = 75
COORDINATES = 128
BANDS = 64
SMALL = 64  # members of a group; members apart from a family's largest component in the first round, four times as many in each further one
MARKS = 1024
CHUNK = 4096
_OFFSETS = np.array([0, 5, 17, 38, 75, 104])  # the coordinates of a band; few bands share two of them
_SHIFT = np.uint32(0x9E3779B1)


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation, of the 32-bit numbers that shingle hashes are cut to."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    return x ^ (x >> np.uint32(15))


def _permute(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, in place."""
    x *= np.uint32(0x846CA68B)
    np.right_shift(x, np.uint32(15), out=spare)
    x ^= spare
    x *= np.uint32(0x85EBCA6B)
    np.right_shift(x, np.uint32(13), out=spare)
    x ^= spare
    return x


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of least values for each set; sets are not empty."""
    placed = _scatter((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32))
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((coordinates, len(sets)), dtype=np.uint32)
    turned, spare = np.empty_like(placed), np.empty_like(placed)
    for k in range(coordinates):
        np.add(placed, np.uint32((k * int(_SHIFT)) & 0xFFFFFFFF), out=turned)
        out[k] = np.minimum.reduceat(_permute(turned, spare), starts)
    return out.T


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit bucket number for each set and band."""
    places = (2 * np.arange(bands)[:, None] + _OFFSETS[None, :]) % signature.shape[1]
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(signature), axis=0)
    for i in range(len(_OFFSETS)):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + signature[:, places[:, i]].astype(np.uint64) + np.uint64(1))
    return keys.view(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a digest of the set and the buckets."""

    def make():
        def handle(ids, texts):
            sets = shingle_sets(texts, SHINGLE)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [[]] * len(sets)
            group, size = [], 0
            for i in [*full, None]:
                if group and (i is None or size + len(sets[i]) > GROUP_CHARS // 6):
                    for j, keys in zip(group, band_keys(signatures([sets[j] for j in group])), strict=True):
                        bands[j] = keys
                    group, size = [], 0
                if i is not None:
                    group.append(i)
                    size += len(sets[i])
            return {
                "doc_id": ids, "n_shingles": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], "bands": bands,
            }

        return handle

    return map_texts(docs, make, "doc_id long, n_shingles long, digest binary, bands array<long>")


def parities(own: np.ndarray) -> np.ndarray:
    """MARKS bits as 64-bit words: whether an odd number of the set's shingles falls on each bit.

    A bit that differs between two sets needs a shingle that only one of them has.
    """
    odd = np.bincount((own >> np.uint64(20)).astype(np.int64) % MARKS, minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_TESTED = "u long, v long, linked boolean, n_u long, n_v long, joint long, outside array<long>, marks array<long>, deep boolean"


def _compare(batches):
    """Each pair's sizes and overlap, u's shingles outside v and u's parities."""
    known: dict[int, np.ndarray] = {}  # the hubs of the last batch
    for batch in pieces(batches):
        hubs, others = batch.column("v").to_pylist(), batch.column("other").to_pylist()
        fresh = {h: t for h, t in zip(hubs, others, strict=True) if h not in known}
        sets = dict(zip(fresh, shingle_sets(list(fresh.values()), SHINGLE), strict=True))
        sets.update((h, known[h]) for h in set(hubs) if h in known)
        owns = shingle_sets(batch.column("text").to_pylist(), SHINGLE)
        joints, outside, marks = [], [], []
        for hub, own, deep in zip(hubs, owns, batch.column("deep").to_pylist(), strict=True):
            inside = np.isin(own, sets[hub], assume_unique=True)
            joints.append(int(inside.sum()))
            outside.append(own[~inside].view(np.int64) if deep else [])
            marks.append(parities(own) if deep else [])
        known = sets
        sizes = [(len(o), len(sets[h])) for o, h in zip(owns, hubs, strict=True)]
        linked = [100 * j >= PERCENT * (a + b - j) for j, (a, b) in zip(joints, sizes, strict=True)]
        columns = [batch.column("u"), batch.column("v"), pa.array(linked, pa.bool_()), pa.array([a for a, _ in sizes], pa.int64())]
        columns += [pa.array([b for _, b in sizes], pa.int64()), pa.array(joints, pa.int64())]
        columns += [pa.array(lists, pa.list_(pa.int64())) for lists in (outside, marks)] + [batch.column("deep")]
        yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "linked", "n_u", "n_v", "joint", "outside", "marks", "deep"])


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The comparison of pairs (u, v) on the full sets; pairs that are not deep will not be looked at further."""
    first = pairs.join(texts.withColumnRenamed("doc_id", "u"), "u")
    both = first.join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("other")), "v")
    return both.select("u", "v", "deep", "text", "other").mapInArrow(_compare, _TESTED)


def _families(tested: DataFrame, added: DataFrame, labels: DataFrame, weights: DataFrame) -> DataFrame:
    """Pairs of the hubs with added pairs whose members are not all in one component, with the components and weights of the
    members and whether the pair was added."""
    grown = added.select("v").distinct()
    names = labels.select(F.col("id").alias("u"), "component")
    rows = attach(tested.where("deep"), grown, ["v"]).join(names, "u", "left").withColumn("component", F.coalesce("component", "u"))
    mixed = rows.groupBy("v").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n_u").alias("least"))
    rows = attach(rows, mixed.where("lo < hi").select("v", "least"), ["v"])
    rows = rows.join(added.select("u", "v", F.lit(True).alias("added")).distinct(), ["u", "v"], "left").withColumn("added", F.coalesce("added", F.lit(False)))
    return rows.join(weights.withColumnRenamed("doc_id", "u"), "u")


def _raised(families: DataFrame) -> DataFrame:
    """The members with what they share with the hub and the frequent shingles (``joint``) and their rare common ones, rarest first.

    Common is what members of several components have outside the hub, frequent what more than SMALL rows of the family have of it;
    ``left`` counts a member's rare ones. A family's are listed in chunks of about CHUNK shingles, however many it has, in
    each chunk the rarest first: a prefix of them meets few members. All members of a family have the same order.
    """
    spread = families.select("v", "component", F.explode("outside").alias("shingle"))
    ends = spread.groupBy("v", "shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
    common = ends.where("lo < hi").select("v", "shingle", "n")
    chunks = common.groupBy("v").agg((F.floor(F.count(F.lit(1)) / CHUNK) + 1).alias("chunks"))
    rare = F.array_sort(F.collect_list(F.when(F.col("n") <= SMALL, F.struct("n", "shingle")))).getField("shingle").alias("rare")
    frequent = F.collect_list(F.when(F.col("n") > SMALL, F.col("shingle"))).alias("frequent")
    lists = attach(common, chunks, ["v"]).groupBy("v", F.expr("pmod(shingle, chunks)").alias("chunk")).agg(rare, frequent)
    # Rows of one id may have several texts.
    members = families.withColumn("own", F.xxhash64("n_u", "joint", "outside")).dropDuplicates(["u", "v", "own"])
    parts = attach(members.select("u", "v", "own", "outside"), chunks, ["v"])
    parts = parts.withColumn("chunk", F.explode(F.expr("array_distinct(transform(outside, x -> pmod(x, chunks)))")))
    parts = parts.withColumn("outside", F.expr("filter(outside, x -> pmod(x, chunks) = chunk)"))
    found = F.struct("chunk", F.array_intersect("rare", "outside").alias("rare"), F.size(F.array_intersect("frequent", "outside")).alias("frequent"))
    met = attach(parts, lists, ["v", "chunk"]).groupBy("u", "v", "own").agg(F.array_sort(F.collect_list(found)).alias("found"))
    met = met.select("u", "v", "own", F.flatten("found.rare").alias("rare"), F.expr("aggregate(found.frequent, 0L, (n, x) -> n + x)").alias("frequent"))
    whole = members.drop("outside").join(met, ["u", "v", "own"], "left").withColumn("joint", F.col("joint") + F.coalesce("frequent", F.lit(0)))
    whole = whole.withColumn("outside", F.coalesce("rare", F.array().cast("array<long>")))
    return whole.withColumn("left", F.size("outside").cast("long")).drop("own", "rare", "frequent")


def _prefixes(raised: DataFrame) -> DataFrame:
    """The members with the rare common shingles at which a link may begin.

    A link of u shares at least 0.75 of u's shingles, so a certain number of them is rare, and all of those are common. Members
    with fewer rare common shingles leave; of the others' the last, one less than that number, cannot be the first of a link.
    """
    needed = F.greatest(F.lit(1), F.ceil(F.col("n_u") * PERCENT / 100) - F.col("joint"))
    starting = raised.withColumn("starts", (F.col("left") - needed + 1).cast("int")).where("starts > 0")
    return starting.withColumn("outside", F.slice("outside", 1, F.col("starts"))).drop("starts")


def _common(families: DataFrame) -> DataFrame:
    """The members with the shingles outside their hub that members of other components have too, as far as a link may begin."""
    return _prefixes(_raised(families))


def _keyed(families: DataFrame, left: str) -> DataFrame:
    """A row for each member and shingle."""
    # What tells a member's row from another: rows of one id may have several texts.
    own = F.xxhash64("u", "n_u", "joint", "left", "outside").cast("decimal(20,0)").alias("own")
    rows = families.withColumn("left", F.expr(left)).select("*", own)
    keyed = rows.select("u", "weight", "component", "n_u", "joint", "added", "v", "left", "own", F.posexplode("outside").alias("place", "shingle"))
    rest = (F.col("left") - F.col("place")).alias("rest")  # the shingles outside the hub from this one on
    return keyed.select("u", "weight", "component", "n_u", "joint", "added", "v", "own", rest, F.xxhash64("v", "shingle").alias("group"))


def _groups(keyed: DataFrame) -> DataFrame:
    """Groups of several components with an added member: size, smallest set and hub; one of those with the same members."""
    best = F.max(F.struct(F.col("weight"), (-F.col("u")).alias("id"))).alias("hub")
    groups = keyed.groupBy("v", "group").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"), F.max("added").alias("grown"),
        F.min("n_u").alias("least"), best, F.sum("own").alias("owns"), F.sum("rest").alias("rests"))
    # Of groups with the same members, the first shingle's has the most of each set from there on.
    first = F.max_by(F.struct("group", "least", "hub"), "rests").alias("first")
    groups = groups.where("lo < hi AND grown").groupBy("v", "n", "owns").agg(first)
    return groups.select("first.group", "n", "first.least", (-F.col("first.hub.id")).alias("v"))


def _shared_outside(families: DataFrame, small_size: int, left: str = "n_u - joint") -> DataFrame:
    """From the groups that share a shingle their first hub lacks: members and hubs, or the possible pairs of small groups (not deep).

    A group without an added member has been searched before, with the same members. Members whose sizes allow no link at this
    shingle, not even with the smallest of the group, leave it: the group of the first shingle that a link shares keeps both its ends.
    ``left`` is the number of a member's shingles from the first of ``outside`` on that a link may share.
    """
    keyed = _keyed(families, left)
    groups = _groups(keyed)
    met = attach(keyed.drop("added", "v", "own"), groups, ["group"]).where("7 * (joint + rest) >= 3 * (n_u + least)")
    large = met.where((F.col("n") > small_size) & (F.col("u") != F.col("v"))).select("u", "v", F.lit(True).alias("deep"))
    marks = families.groupBy("u").agg(F.first("marks").alias("marks"))  # a set has the same marks in every family
    small = met.where(F.col("n") <= small_size).join(marks, "u")
    small = small.groupBy("group").agg(F.collect_list(F.struct("u", "component", "n_u", "joint", "rest", "marks")).alias("members"))

    def possible(a, b):
        # At the first shingle that a link shares outside the hub, none before it is shared; at a later one the pair need not be found again.
        most = F.least(a["joint"], b["joint"]) + F.least(a["rest"], b["rest"])
        apart = sum((F.bit_count(a["marks"][i].bitwiseXOR(b["marks"][i])) for i in range(MARKS // 64)), F.lit(0))
        sizes = a["n_u"] + b["n_u"]
        return (a["u"] > b["u"]) & (a["component"] != b["component"]) & (7 * most >= 3 * sizes) & (7 * apart <= sizes)

    def partners(a):
        return F.transform(F.filter("members", lambda b: possible(a, b)), lambda b: F.struct(a["u"].alias("u"), b["u"].alias("v")))

    pairs = small.select(F.inline(F.flatten(F.transform("members", partners)))).withColumn("deep", F.lit(False))
    return large.unionByName(pairs).distinct()


def _inside(raised: DataFrame, few: int) -> DataFrame:
    """Pairs whose link may lie within what both share with their hub and the frequent shingles, or members and a hub (deep).

    Both ends of such a link have three quarters of their shingles there. Of a family's members that do, those outside the component with
    most of them are paired with the others if they are ``few``; else all are compared with the heaviest.
    """
    near = raised.where("28 * joint >= 3 * greatest(7 * n_u, 4 * (n_u + least))")
    parts = near.groupBy("v", "component").agg(
        F.count(F.lit(1)).alias("n"), F.max("added").alias("added"), F.max(F.struct(F.col("weight"), (-F.col("u")).alias("id"))).alias("hub"))
    whole = parts.groupBy("v").agg(
        (F.sum("n") - F.max("n")).alias("apart"), F.max(F.struct("n", "component")).alias("main"), F.max("added").alias("grown"), F.max("hub").alias("hub"))
    whole = whole.where("grown AND apart > 0").select("v", "apart", F.col("main.component").alias("main"), (-F.col("hub.id")).alias("hub"))
    met = attach(near, whole, ["v"])
    large = met.where((F.col("apart") > few) & (F.col("u") != F.col("hub"))).select("u", F.col("hub").alias("v"), F.lit(True).alias("deep"))
    names = ["u", "n_u", "joint", "component", "added", "marks"]
    small = met.where(F.col("apart") <= few).select("v", "main", *names)
    ends = small.where("component != main").select("v", *[F.col(name).alias(f"{name}_f") for name in names])
    apart = sum((F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("marks_f")[i])) for i in range(MARKS // 64)), F.lit(0))
    pairs = attach(small.drop("main"), ends, ["v"]).where("component != component_f AND (added OR added_f) AND 7 * least(joint, joint_f) >= 3 * (n_u + n_u_f)")
    pairs = pairs.where(7 * apart <= F.col("n_u") + F.col("n_u_f"))
    pairs = pairs.select(F.greatest("u", "u_f").alias("u"), F.least("u", "u_f").alias("v"), F.lit(False).alias("deep"))
    return large.unionByName(pairs)


def _merged(labels: DataFrame, links: DataFrame, path: str) -> DataFrame:
    """The labels after further links, which are few or none between components."""
    ends = links.select("u", "v")
    for end in ("u", "v"):
        names = labels.select(F.col("id").alias(end), "component")
        ends = ends.join(names, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    joining = settle(ends.where("u != v").distinct())
    if joining.isEmpty():
        return labels
    moved = components(joining)
    renamed = labels.join(moved.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    return written(renamed.select("id", F.coalesce("to", "component").alias("component")).unionByName(moved), path)


def link(unique: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, component) of classes that are not the smallest id of their component."""
    rows = unique.select("doc_id", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size >= 2")
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "near")
    members = written(attach(rows, shared, ["bucket"]), f"{root}/members")
    weights = written(members.groupBy("doc_id").agg(F.sum("size").alias("weight")), f"{root}/weights")
    texts = written(docs.join(weights.select("doc_id"), "doc_id", "left_semi"), f"{root}/texts")

    weighed = members.join(weights, "doc_id")
    best = F.max(F.struct(F.col("weight"), (-F.col("doc_id")).alias("id"))).alias("hub")
    hubs = weighed.groupBy("bucket").agg(best).select("bucket", (-F.col("hub.id")).alias("v"))
    pairs = attach(members, hubs, ["bucket"]).where(F.col("doc_id") != F.col("v"))
    pairs = pairs.groupBy(F.col("doc_id").alias("u"), "v").agg((F.max("size") > 2).alias("deep"))
    fresh = written(pairs, f"{root}/seen/0")
    discard(spark, f"{root}/members")
    compared = written(_confirm(fresh, texts), f"{root}/tested/0")
    labels = written(components(compared.where("linked").select("u", "v")), f"{root}/labels/0")
    # Each round adds a folder to the pairs seen and tested, which stay one scan however many rounds there are.
    number = 0
    while True:
        seen, tested = (
            spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{root}/{name}")
            for name, rows in (("seen", fresh), ("tested", compared))
        )
        families = written(_families(tested, compared.where("deep"), labels, weights), f"{root}/families/{number}")
        # Pairs compared for their own sake are not deep: a family holds only members lighter than its hub.
        raised = written(_raised(families), f"{root}/common/{number}")
        wanted = _shared_outside(_prefixes(raised), SMALL, "left").unionByName(_inside(raised, SMALL * 4**number))
        turned = seen.select(F.col("v").alias("u"), F.col("u").alias("v"), F.lit(False).alias("deep"))
        known = seen.select("u", "v", "deep").unionByName(turned).groupBy("u", "v").agg(F.max("deep").alias("known"))
        wanted = wanted.groupBy("u", "v").agg(F.max("deep").alias("deep")).join(known, ["u", "v"], "left")
        number += 1
        fresh = written(wanted.where("known IS NULL OR (deep AND NOT known)").select("u", "v", "deep"), f"{root}/seen/{number}")
        discard(spark, f"{root}/families", f"{root}/common")
        if fresh.isEmpty():
            discard(spark, *(f"{root}/{name}" for name in ("seen", "tested", "texts", "weights")))
            return labels
        compared = written(_confirm(fresh, texts), f"{root}/tested/{number}")
        labels = _merged(labels, compared.where("linked"), f"{root}/labels/{number}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id that links reach) and kept (that id is the document's own)."""
    rows = texts_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    known = rows.where("doc_id IS NOT NULL")
    sketched = settle(sketch(rows))
    classes = sketched.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = sketched.where("digest IS NOT NULL AND doc_id IS NOT NULL").join(classes, "digest").where(F.col("doc_id") == F.col("first"))
    labels = link(firsts.dropDuplicates(["doc_id", "digest"]), known)
    named = attach(sketched.select("doc_id", "n_shingles", "digest"), classes, ["digest"], "left")
    named = named.join(labels.withColumnRenamed("id", "first"), "first", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first", "doc_id")).alias("component_id")
    found = named.select("doc_id", "n_shingles", component)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document (the smallest id) of each group, with all its columns; rows that share an id stay or go together."""
    gone = near_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("_gone"), "left_anti")
