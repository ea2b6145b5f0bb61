"""Merkle manifest of a dataset, with nested-interval labels.

Each row is a leaf with its rank among the rows of its group (one tree a group);
the groups' roots are the leaves of the tree of the whole dataset.  A node is
labelled with the interval of leaf ranks that it covers, so ancestry is
containment: a node's ancestors are those whose intervals hold its own, and its
siblings are what is left of its parent's interval without its own.

Trees grow by tiers of a few levels.  Nodes are dealt by (tree, rank div the
leaves of a tier's top node), the bucket in which all of a tier's containment is
decided, so a group of rows is bounded by ``BLOCK`` however large a tree is, and each
tier has that many times fewer rows than the one below.  Proofs come down the
same way: a tier's blocks meet the paths of the nodes that contain them, one to
one, and each member adds its siblings within the block.

Ranks come from a table written by ranges of (group, key, leaf), the counts of
its ranges and a row number within each range, so that no task holds a group.

Defined cases: a null field counts as ``-``; rows of one key follow by their leaf; rows with a null
key come first in their group; a null group is a tree of its own, before the
others; repeated rows are leaves each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyline.llm.common import let, shuffle_parts, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes that one group of a tier holds at most (a power of the fan-out).
BLOCK = 64


def said(value: Column) -> Column:
    """A field as it enters a leaf: its bytes in UTF-8, a colon and the value; ``-`` for null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[said(f) for f in fields]), 256)


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree, digest and more; a written table) with ``rank``, the place
    from 0 within the tree by ``order`` and digest."""
    tie = F.monotonically_increasing_id()  # equal rows need not share a range
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "digest", "_tie")]
    dealt = leaves.withColumn("_tie", tie).repartitionByRange(shuffle_parts(leaves.sparkSession), *by)
    dealt = written(dealt.withColumn("_part", F.spark_partition_id()), "manifest-leaves")
    counts = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("tree").alias("_t"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_part", "tree").orderBy(*by[1:]))
    out = dealt.withColumn("_nth", nth).join(offsets, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("_part") == F.col("_p")))
    return out.withColumn("rank", F.col("_before") + F.col("_nth") - 1).drop("_part", "_tie", "_nth", "_t", "_p", "_before")


def steps_of(fanout: int) -> int:
    """Levels of a tier."""
    steps = 1
    while fanout ** (steps + 1) <= BLOCK:
        steps += 1
    return steps


def with_height(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with the height of their tree: levels until one node is left."""
    top = 1
    while fanout ** top < 2**62:
        top += 1
    sizes = nodes.groupBy("tree").agg((F.max("lo") + 1).alias("_n")).select(
        F.col("tree").alias("_t"),
        sum((F.col("_n") > F.lit(fanout ** k)).cast("int") for k in range(top)).alias("height"))
    return nodes.join(sizes, F.col("tree").eqNullSafe(F.col("_t"))).drop("_t")


def parents(nodes: Column, fanout: int) -> Column:
    """The nodes over an array of neighbouring ones: runs of ``fanout``, the last
    run maybe shorter, each with the interval of its run."""
    def one(i: Column) -> Column:
        return let(F.slice(nodes, i * fanout + 1, fanout), lambda run: F.struct(
            F.get(run, F.lit(0))["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.transform(run, lambda x: x["digest"]), ""), 256).alias("digest")))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int")), one)


def grow(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The blocks of each tier, written: tree, height, bucket, lo, hi, members
    (with their payload) and levels, the nodes of the tier's levels from the
    members on.  ``nodes`` has tree, lo, hi, digest and payload."""
    steps, tiers = steps_of(fanout), []
    nodes = written(with_height(nodes, fanout), "manifest-nodes")
    tallest = nodes.agg(F.max("height")).first()[0] or 0
    while True:
        level = len(tiers) * steps
        bucket = F.expr(f"lo div {fanout ** (level + steps)}")
        block = nodes.groupBy("tree", "height", bucket.alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", "payload"))).alias("members"))
        block = block.withColumn("levels", F.array(F.transform("members", lambda m: m.dropFields("payload"))))
        for k in range(steps):
            # a level above the root is the root again
            higher = F.col("height") > level + k
            up = let(F.element_at("levels", -1), lambda top: F.when(higher, parents(top, fanout)).otherwise(top))  # noqa: B023
            block = block.withColumn("levels", F.concat("levels", F.array(up)))
        block = block.withColumn("top", F.get(F.element_at("levels", -1), F.lit(0)))
        tiers.append(written(block, "manifest-blocks"))
        if tallest <= level + steps:
            return tiers
        nodes = tiers[-1].filter(F.col("height") > level + steps).select(
            "tree", "top.lo", "top.hi", "top.digest", F.lit(None).cast(nodes.schema["payload"].dataType).alias("payload"), "height")


def tree_roots(tiers: list[DataFrame], fanout: int) -> DataFrame:
    """tree, digest: the root of each tree, from the tier in which it ends."""
    steps, out = steps_of(fanout), None
    for t, blocks in enumerate(tiers):
        done = blocks.filter(F.col("height") <= (t + 1) * steps).select("tree", "top.digest")
        out = done if out is None else out.unionByName(done)
    return out


def own_steps(member: Column, levels: Column, height: Column, level: int) -> Column:
    """What stands left and right of a member's node at each of the tier's
    levels: the parent's interval without the node's own."""
    def inside(nodes: Column, lo: Column, hi: Column) -> Column:
        return F.array_join(F.transform(F.filter(nodes, lambda x: (x["lo"] >= lo) & (x["hi"] <= hi)), lambda x: x["digest"]), "")

    def holder(k: Column) -> Column:
        return F.get(F.filter(F.get(levels, k), lambda x: (x["lo"] <= member["lo"]) & (x["hi"] >= member["hi"])), F.lit(0))

    def step(k: Column) -> Column:
        return let(F.struct(holder(k).alias("own"), holder(k + 1).alias("up")), lambda n: F.struct(
            inside(F.get(levels, k), n["up"]["lo"], n["own"]["lo"]).alias("left"),
            inside(F.get(levels, k), n["own"]["hi"], n["up"]["hi"]).alias("right")))

    counted = F.least(height - level, F.size(levels) - 1)
    return F.when(counted > 0, F.transform(F.sequence(F.lit(0), counted - 1), step)).otherwise(F.array().cast(PATH))


PATH = "array<struct<left: string, right: string>>"


def descend(tiers: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """tree, lo, hi, digest, payload, path and the other columns of ``tops``: every
    leaf with its siblings up to the top.  ``tops`` has each tree's path above its
    root (tree, path and more)."""
    steps, carried = steps_of(fanout), [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for t in reversed(range(len(tiers))):
        level = t * steps
        blocks = tiers[t].withColumns({"_lo": F.col("top.lo"), "_hi": F.col("top.hi")}).drop("top")
        same = F.col("tree").eqNullSafe(F.col("_t"))
        up = [F.col("path").alias("_path"), *carried]
        ends = blocks.filter(F.col("height") <= level + steps).join(tops.select(F.col("tree").alias("_t"), *up), same)
        if above is not None:
            # containment, decided within the bucket of the level above
            size = fanout ** (level + steps)
            over = above.select(F.col("tree").alias("_t"), F.expr(f"lo div {size}").alias("_b"), F.col("lo").alias("_from"), F.col("hi").alias("_to"), *up)
            on = same & (F.col("bucket") == F.col("_b")) & (F.col("_from") <= F.col("_lo")) & (F.col("_hi") <= F.col("_to"))
            goes_on = blocks.filter(F.col("height") > level + steps).join(over, on)
            ends = ends.unionByName(goes_on.drop("_b", "_from", "_to"))
        each = ends.select("tree", "height", "levels", "_path", *carried, F.explode("members").alias("m"))
        above = each.select("tree", "m.lo", "m.hi", "m.digest", "m.payload",
                            F.concat(own_steps(F.col("m"), F.col("levels"), F.col("height"), level), F.col("_path")).alias("path"), *carried)
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to with the siblings of ``path``."""
    return F.aggregate(path, start, lambda at, p: F.sha2(F.concat(p["left"], at, p["right"]), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", fanout: int = 2,
             keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the key, ``leaf``, ``subroot`` (of its group),
    ``root``, ``path`` (the digests left and right of it at each level, up to the
    root) and ``keep``, further columns computed from the row (structs of one
    name cannot clash with others: they travel in one payload)."""
    keep = keep or {}
    leaves = docs.select(F.col(group).alias("tree"), F.col(key).alias("_key"), leaf_of([F.col(f) for f in fields]).alias("digest"),
                         F.struct(F.col(key).alias("key"), *[c.alias(n) for n, c in keep.items()]).alias("payload"))
    place = ranked(written(leaves, "manifest-leaf"), ["_key"])
    tiers = grow(place.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "payload"), fanout)

    roots = tree_roots(tiers, fanout).select(F.lit("").alias("tree"), F.col("tree").alias("_group"), "digest", F.struct(F.col("tree").alias("group")).alias("payload"))
    place = ranked(written(roots, "manifest-roots"), ["_group"])
    top = grow(place.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "payload"), fanout)
    root = tree_roots(top, fanout).select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    tops = written(descend(top, root, fanout).select(F.col("payload.group").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "manifest-tops")
    return descend(tiers, tops, fanout).select(
        F.col("payload.key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path", *[F.col(f"payload.{n}").alias(n) for n in keep])


def tampered_proofs(docs: DataFrame, one_in: int = 7) -> DataFrame:
    """The manifest's proofs held against a copy in which one row in ``one_in``
    (by a checksum of doc_id) has one added to n_chars: a row is verified if what
    the copy's leaf and the siblings fold to is the root."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0
    more = [F.col(f).cast("decimal(20,0)") + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    rows = manifest(docs, keep={"other": F.when(hit, leaf_of(more))})
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    out = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                      folded(F.coalesce("other", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE f AS (
  SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS id, source, CAST(n_chars AS VARCHAR) AS n, CAST(n_chars + 1 AS VARCHAR) AS n1, text FROM documents),
c AS (  -- the checksum of the decimal doc_id, bit by bit
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id, ''), lambda s: ascii(s)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS crc FROM f),
p AS (
  SELECT doc_id, lang, crc,
    coalesce(strlen(id) || ':' || id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n) || ':' || n, '-') AS n, coalesce(strlen(n1) || ':' || n1, '-') AS n1, coalesce(strlen(text) || ':' || text, '-') AS tail FROM c),
l AS (
  SELECT doc_id, lang, sha256(head || n || tail) AS leaf, CASE WHEN crc % 7 = 0 THEN sha256(head || n1 || tail) ELSE sha256(head || n || tail) END AS start FROM p),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS size FROM l),
nodes AS (
  SELECT lang, 0 AS level, rank AS pos, leaf AS digest, size FROM r
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((size + 1) // 2) FROM nodes WHERE size > 1 GROUP BY lang, level, pos // 2),
subs AS (
  SELECT lang, digest AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, pos, subroot AS digest, size FROM subs
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((size + 1) // 2) FROM tops WHERE size > 1 GROUP BY level, pos // 2),
leaves AS (
  SELECT r.doc_id, r.lang, r.leaf, r.start, r.rank, s.subroot, s.height, s.pos AS top_pos, (SELECT digest FROM tops WHERE size = 1) AS root,
    (SELECT max(level) FROM tops) AS top_height, row_number() OVER () AS row
  FROM r JOIN subs s ON r.lang IS NOT DISTINCT FROM s.lang),
steps AS (
  SELECT x.row, k AS level, n.digest AS sibling, (x.rank >> k) & 1 AS is_right
  FROM (SELECT *, unnest(range(height)) AS k FROM leaves) x
  LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM x.lang AND n.level = x.k AND n.pos = xor(x.rank >> x.k, 1)
  UNION ALL
  SELECT x.row, x.height + k, n.digest, (x.top_pos >> k) & 1
  FROM (SELECT *, unnest(range(top_height)) AS k FROM leaves) x LEFT JOIN tops n ON n.level = x.k AND n.pos = xor(x.top_pos >> x.k, 1)),
climb AS (
  SELECT row, 0 AS level, start AS digest FROM leaves
  UNION ALL
  SELECT c.row, c.level + 1, sha256(CASE WHEN s.is_right = 1 THEN s.sibling || c.digest ELSE c.digest || coalesce(s.sibling, '') END)
  FROM climb c JOIN steps s ON s.row = c.row AND s.level = c.level),
done AS (SELECT row, arg_max(digest, level) AS folded_root FROM climb GROUP BY row),
proofs AS (SELECT row, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY row)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN done USING (row) LEFT JOIN proofs USING (row)
"""
