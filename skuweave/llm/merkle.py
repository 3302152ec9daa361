"""Merkle manifest of a dataset: levels built bottom up, stored as parent-linked node rows, and climbed by a recursive query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuweave.llm.common import Scratch, small_batches

#: Consecutive nodes that become one.
RUN = 16
#: Nodes that are broadcast for the last steps of the climb: at most so many, each under 2 KB. All levels below are joined by a shuffle.
BROADCAST_NODES = 20_000
#: Hex digits of a digest.
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(c: Column) -> Column:
    """'-' for null, else the value's UTF-8 byte count, ':' and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(cols: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def numbered(df: DataFrame, group: str, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """df with `at` (place from 0 in its group by `order`) and `n` (rows of the group); df is written once.

    A range partitioning deals out a hot group as well as any other, each partition numbers its own rows, and the few
    counts of (partition, group) give the offsets: no group is ever in one task.
    """
    place = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = scratch.table(dealt.withColumns({"_part": F.shiftright(place, 33), "_row": place.bitwiseAND(F.lit((1 << 33) - 1))}), name)
    counts = dealt.groupBy("_part", group).agg(F.count("*").alias("_c"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", group, "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"), F.sum("_c").over(Window.partitionBy(group)).alias("n"))
    return dealt.join(offsets, ["_part", group]).withColumn("at", F.col("_off") + F.col("_row") - F.col("_first")).drop("_part", "_row", "_first", "_off", "_c")


def children_of(at: str, digest: str) -> Column:
    """The digests of a run in their order, joined; a run has at most RUN."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(at), F.col(digest)))), lambda c: c[digest]), "")


def levels(first: DataFrame, base: int, scratch: Scratch) -> list[DataFrame]:
    """(tree, at, n, digest) of the lowest nodes -> for each level above (tree, level, at, n, digest, children).

    A level has the trees that had several nodes on the level below; n is the tree's number of nodes on the level. The loop runs log16(rows) times.
    """
    out, below, level = [], first, base
    while not (several := below.where("n > 1")).isEmpty():
        level += 1
        runs = several.groupBy("tree", F.floor(F.col("at") / RUN).alias("at")).agg(children_of("at", "digest").alias("children"), F.ceil(F.first("n") / RUN).alias("n"))
        below = scratch.table(runs.select("tree", F.lit(level).alias("level"), "at", "n", F.sha2("children", 256).alias("digest"), "children"), f"level-{level}")
        out.append(below)
    return out


#: One step for all rows: the node above gives the siblings (its children but the own one) and the place in the next node.
CLIMB = """
WITH RECURSIVE climb(packet, up, place, digest, subroot, siblings, folds) AS (
  SELECT packet, up, place, digest, subroot, siblings, folds FROM {start}
  UNION ALL
  SELECT c.packet, n.up, n.place, n.digest,
         coalesce(c.subroot, CASE WHEN n.top THEN c.digest END),
         concat(c.siblings, substr(n.children, 1, {hex} * c.place), substr(n.children, {hex} * c.place + {hex} + 1)),
         transform(c.folds, f -> sha2(concat(substr(n.children, 1, {hex} * c.place), f, substr(n.children, {hex} * c.place + {hex} + 1)), 256))
  FROM climb c JOIN {nodes} n ON c.up = n.node
)
SELECT * FROM climb WHERE up IS NULL OR up.level >= {stop}
"""


def climb(spark: SparkSession, start: DataFrame, nodes: DataFrame, stop: int) -> DataFrame:
    """Rows of start, carried up through nodes until the next node is of level `stop` or there is none."""
    return spark.sql(CLIMB, start=start, nodes=nodes, stop=stop, hex=HEX)


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    tree_col: str = "source",
    tampered: dict[str, Column] | None = None,
    touched: Column | None = None,
) -> DataFrame:
    """docs -> (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row for each row.

    Each row is a leaf: the digest of its fields. Per tree_col the leaves ascend by id; while several nodes remain, every
    RUN consecutive ones become their digest; what remains is the subroot. Subroots by tree_col (null first) likewise give the root.
    A row's proof has the siblings of each run up to the root, left to right. folded_root is recomputed from the row's
    present leaf and the stored siblings: `tampered` gives changed fields for the rows that are `touched`.

    1. Leaves are numbered by range partitions; runs of leaves become packets of at most RUN leaves.
    2. Each level above is written as node rows: children, digest, and the link to the parent (node, place in it).
    3. A recursive query climbs from the packets: a step joins the parent, appends its other children and folds every
       changed leaf's own digest. Siblings above a packet are the same for its leaves, so they are carried once, and
       unchanged leaves share one fold. Levels with many nodes are joined by a shuffle, the last ones (at most
       BROADCAST_NODES nodes) by a broadcast, since there all rows meet few parents.

    Nulls: '-' in the leaf; a null tree_col is a tree of its own; null ids come first and are not touched unless `touched` says
    so. Rows of one id are ordered by their leaves; repeated rows are leaves of their own. A tree of one leaf has it as
    subroot; a table with one tree has its subroot as root. Empty table: empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    scratch = Scratch(spark, "merkle")
    plain = [F.col(f"`{c}`") for c in fields]
    changed = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in fields]
    now = F.when(touched, leaf_digest(changed)) if touched is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{tree_col}`").cast("string")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf_digest(plain).alias("digest"), now.alias("now"))
    leaves = leaves.withColumn("now", F.when(F.col("now") != F.col("digest"), F.col("now")))
    leaves = numbered(leaves, "tree", ["id", "digest"], scratch, "leaves")

    # Packets: the runs of leaves with what each leaf is now. A lone leaf is its tree's subroot, its packet has no digest of its own.
    run = F.sort_array(F.collect_list(F.struct("at", "id", "digest", "now")))
    packets = leaves.groupBy("tree", F.floor(F.col("at") / RUN).alias("at")).agg(run.alias("leaves"), F.first("n").alias("leaves_n"))
    children = F.array_join(F.transform("leaves", lambda x: x["digest"]), "")
    packets = packets.select("tree", "at", "leaves", children.alias("children"), (F.col("leaves_n") == 1).alias("lone"), F.ceil(F.col("leaves_n") / RUN).alias("n"))
    digest = F.when(F.col("lone"), F.col("children")).otherwise(F.sha2("children", 256))
    packets = scratch.table(packets.withColumn("digest", digest), "packets")

    # Levels of the trees, then of the tree of subroots, whose levels go on from there.
    lowest = packets.select("tree", F.lit(1).alias("level"), "at", "n", "digest")
    own = levels(lowest, 1, scratch)
    bare = [lowest.withColumn("children", F.lit(None).cast("string")), *own]
    subroots = bare[0].where("n = 1")
    for one in bare[1:]:
        subroots = subroots.unionByName(one.where("n = 1"))
    ordered = subroots.select(F.lit(0).alias("all"), F.col("tree").alias("below"), F.col("level").alias("below_level"), "digest")
    ordered = scratch.table(numbered(ordered, "all", ["below"], scratch, "subroots").withColumn("tree", F.lit("^")), "tops")
    tops = levels(ordered.select("tree", "at", "n", "digest"), len(own) + 1, scratch)
    root = tops[-1] if tops else ordered
    links = ordered.where("n > 1").select("below", F.col("at").alias("top"))

    # Links upwards. A tree's last node goes on to the tree of subroots.
    def node(tree: Column, level: Column, at: Column) -> Column:
        return F.struct(tree.alias("tree"), level.cast("int").alias("level"), at.cast("long").alias("at"))

    def linked(rows: DataFrame) -> DataFrame:
        """rows of trees with `up` (null at the root) and `place` in it."""
        rows = rows.join(links.withColumnsRenamed({"below": "tree"}).withColumn("last", F.lit(1)), ["tree"], "left") if tops else rows.withColumn("top", F.lit(None).cast("long"))
        above = F.when(F.col("n") > 1, node(F.col("tree"), F.col("level") + 1, F.floor(F.col("at") / RUN)))
        onwards = F.when(F.col("top").isNotNull(), node(F.lit("^"), F.lit(len(own) + 2), F.floor(F.col("top") / RUN)))
        return rows.withColumn("up", F.coalesce(above, onwards)).withColumn("place", (F.when(F.col("n") > 1, F.col("at")).otherwise(F.col("top")) % RUN).cast("int"))

    def as_nodes(rows: DataFrame, top: bool) -> DataFrame:
        return rows.select(node(F.col("tree"), F.col("level"), F.col("at")).alias("node"), "up", "place", "digest", F.lit(top).alias("top"), "children")

    every = [as_nodes(linked(x), False) for x in own]
    for x in tops:
        above = F.when(F.col("n") > 1, node(F.col("tree"), F.col("level") + 1, F.floor(F.col("at") / RUN)))
        every.append(as_nodes(x.withColumn("up", above).withColumn("place", (F.col("at") % RUN).cast("int")), True))

    # The climb starts above the packets, with the leaves' first fold done.
    def fold(leaf: Column, place: Column) -> Column:
        before, after = F.col("children").substr(F.lit(1), HEX * place), F.col("children").substr(HEX * place + HEX + 1, F.lit(RUN * HEX))
        return F.when(F.col("lone"), leaf).otherwise(F.sha2(F.concat(before, leaf, after), 256))

    first = F.element_at("leaves", 1)["digest"]
    touched_leaves = F.filter("leaves", lambda x: x["now"].isNotNull())
    folds = F.concat(F.array(fold(first, F.lit(0))), F.transform(touched_leaves, lambda x: fold(x["now"], (x["at"] % RUN).cast("int"))))
    packet = F.struct("tree", "at")
    start = linked(packets.withColumn("level", F.lit(1))).select(
        packet.alias("packet"), "up", "place", "digest", F.when(F.col("up").isNull(), F.col("digest")).alias("subroot"), F.lit("").alias("siblings"), folds.alias("folds")
    )
    climbed = scratch.table(start, "start")
    if every:
        nodes = every[0]
        for x in every[1:]:
            nodes = nodes.union(x)
        nodes = scratch.table(nodes, "nodes")
        counts = {r["level"]: r["count"] for r in nodes.groupBy(F.col("node.level").alias("level")).count().collect()}
        last = max(counts)
        stop = last + 1
        while stop - 1 in counts and sum(c for lv, c in counts.items() if lv >= stop - 1) <= BROADCAST_NODES:
            stop -= 1
        limit = "spark.sql.cteRecursionRowLimit"
        was = spark.conf.get(limit)
        spark.conf.set(limit, "-1")  # rows grow with the table; the levels bound the recursion
        try:
            if min(counts) < stop:
                climbed = scratch.table(climb(spark, climbed, nodes.where(F.col("node.level") < stop), stop), "climbed")
            if stop <= last:
                climbed = scratch.table(climb(spark, climbed, F.broadcast(nodes.where(F.col("node.level") >= stop)), last + 1), "climbed")
        finally:
            spark.conf.set(limit, was)

    # Each leaf of a packet: its own siblings before those of the packet, and its fold.
    # The order of the folds is that of the changed leaves in the packet; the first is that of all others.
    number = lambda i: F.size(F.filter(F.slice("leaves", 1, i + 1), lambda x: x["now"].isNotNull()))
    places = F.transform("leaves", lambda x, i: F.struct(x["id"].alias("id"), x["digest"].alias("leaf"), i.alias("i"), F.when(x["now"].isNotNull(), number(i)).otherwise(0).alias("fold")))
    flat = packets.select(packet.alias("packet"), "lone", "children", places.alias("leaves")).join(climbed.select("packet", "digest", "subroot", "siblings", "folds"), "packet")
    flat = flat.withColumn("leaf", F.explode("leaves"))
    i = F.col("leaf.i")
    beside = F.when(F.col("lone"), F.lit("")).otherwise(F.concat(F.col("children").substr(F.lit(1), HEX * i), F.col("children").substr(HEX * i + HEX + 1, F.lit(RUN * HEX))))
    folded = F.element_at("folds", F.col("leaf.fold") + 1)
    root_digest = F.broadcast(root.where("n = 1").select(F.col("digest").alias("root")))  # one row
    out = flat.select(
        F.col("leaf.id").alias("doc_id"), F.col("leaf.leaf").alias("leaf"), F.coalesce("subroot", "digest").alias("subroot"), F.col("digest").alias("reached"),
        F.sha2(F.concat(beside, F.col("siblings")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    out = out.join(root_digest, F.lit(True), "left")
    out = out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
    return scratch.last(out, "merkle-manifest")


def document_manifest(docs: DataFrame) -> DataFrame:
    """merkle_manifest of documents, where one id in five by crc32 has its text's A-Z lower-cased before the check."""
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return merkle_manifest(docs, tampered={"text": F.translate("text", UPPER, LOWER)}, touched=touched)


#: DuckDB has no crc32: bit by bit over the digits.
ORACLE_SQL = """
WITH RECURSIVE d AS (
  SELECT *, coalesce('=' || source, '') AS tree,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
             lambda s, b: list_reduce([xor(s, b)] || range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), f AS (
  SELECT doc_id, tree, crc % 5 = 0 AS touched,
         concat(coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head, text
  FROM d
), l AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS digest,
         CASE WHEN touched THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS now
  FROM f
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l
), lower_nodes(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 16
), subroots AS (
  SELECT tree AS below, level AS below_level, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM lower_nodes WHERE n = 1
), upper_nodes(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 16
), climb_own(doc_id, tree, level, pos, n, siblings, fold) AS (
  SELECT doc_id, tree, 0, pos, n, '', coalesce(now, digest) FROM leaves
  UNION ALL
  SELECT c.doc_id, c.tree, c.level + 1, c.pos // 16, (c.n + 15) // 16, c.siblings || r.others, sha256(r.before || c.fold || r.after)
  FROM climb_own c, LATERAL (
    SELECT coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos <> c.pos), '') AS others, coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos < c.pos), '') AS before,
           coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos > c.pos), '') AS after
    FROM lower_nodes x WHERE x.tree = c.tree AND x.level = c.level AND x.pos // 16 = c.pos // 16) r
  WHERE c.n > 1
), climb_top(doc_id, subroot, level, pos, n, siblings, fold) AS (
  SELECT c.doc_id, s.digest, 0, s.pos, s.n, c.siblings, c.fold FROM climb_own c JOIN subroots s ON c.tree = s.below WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.subroot, c.level + 1, c.pos // 16, (c.n + 15) // 16, c.siblings || r.others, sha256(r.before || c.fold || r.after)
  FROM climb_top c, LATERAL (
    SELECT coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos <> c.pos), '') AS others, coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos < c.pos), '') AS before,
           coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos > c.pos), '') AS after
    FROM upper_nodes x WHERE x.level = c.level AND x.pos // 16 = c.pos // 16) r
  WHERE c.n > 1
), root AS (SELECT digest FROM upper_nodes WHERE n = 1)
SELECT l.doc_id, l.digest AS leaf, c.subroot, r.digest AS root, sha256(c.siblings) AS proof_sha256, c.fold AS folded_root, c.fold = r.digest AS verified
FROM leaves l JOIN climb_top c USING (doc_id) CROSS JOIN root r WHERE c.n = 1
"""
