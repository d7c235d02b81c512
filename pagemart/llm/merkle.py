"""Merkle manifest of a dataset: a hash tree per group over its rows, and one tree over the groups' roots.

A leaf is the hash of a row's fields. A group's leaves stand in the order of their id; every ``RUN`` consecutive
nodes become one parent until one is left, the group's subroot; the subroots in group order make the root the same way.

Trees are built from aligned blocks of ``BLOCK`` nodes (two levels). A block is one row that keeps each of its levels as one
string of hex digests: fixed-width substrings of a level are the runs that hash to the parents, and what flanks a
node's own digest inside its run are its siblings. The tops of all blocks are the nodes of the next, 256 times smaller
round, until every group has one node. Paths come back down the rounds, joined to blocks, not to rows.

Positions come from range partitions: every partition is numbered by itself and adds the counts of those before
it, so no task orders a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

RUN, WIDTH = 16, 64          # nodes a parent hashes; hex digits of a digest
BLOCK = RUN * RUN
PATH_TYPE = "array<struct<l:string,r:string>>"


def leaf_hash(*fields: Column) -> Column:
    """Hash of the fields one after another, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    shown = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
                             for s in shown]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path`` (the operator's column)."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def path_digest(path: Column) -> Column:
    """Hash of all sibling digests of a path, from the leaf's run up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def _numbered(rows: DataFrame, order: Sequence[str], what: str) -> DataFrame:
    """``rows`` (column ``g``, its group) with ``pos``, the 0-based place in the group's ``order``, and ``n``, the group's size.
    ``order`` has to tell all rows of a group apart."""
    dealt = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    at = F.monotonically_increasing_id()        # evaluated in the sorted partitions: the place in the partition
    placed = settle(dealt.withColumn("pid", F.spark_partition_id()).withColumn("at", at.bitwiseAND((1 << 33) - 1)), what)
    whole = Window.partitionBy("g")
    before = whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("g", "pid").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    offsets = counts.select("g", "pid", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                            F.sum("c").over(whole).alias("n"))
    return placed.join(offsets, ["g", "pid"]).withColumn("pos", F.col("at") + F.col("shift")).drop("pid", "at", "shift")


def _parents(level: str) -> str:
    """The next level: every run of ``level`` hashed, joined to one string."""
    runs = f"sequence(0, (length({level}) - 1) div {RUN * WIDTH})"
    return f"array_join(transform({runs}, i -> sha2(substring({level}, i * {RUN * WIDTH} + 1, {RUN * WIDTH}), 256)), '')"


def _blocks(nodes: DataFrame, what: str) -> DataFrame:
    """Nodes (g, pos, n, digest, x) as aligned blocks (g, block, n, items, l0, l1, top): ``l0`` and ``l1`` hold the
    digests of a level, ``top`` the digest that stands for the block."""
    packed = (nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).groupBy("g", "block")
              .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", "x"))).alias("m")))
    level0 = packed.select("g", "block", "n", F.expr("transform(m, e -> e.x)").alias("items"),
                           F.expr("array_join(transform(m, e -> e.digest), '')").alias("l0"))
    level1 = level0.withColumn("l1", F.expr(f"CASE WHEN n > 1 THEN {_parents('l0')} END"))
    top = f"CASE WHEN n = 1 THEN l0 WHEN n <= {RUN} THEN l1 ELSE sha2(l1, 256) END"
    return settle(level1.withColumn("top", F.expr(top)), what)


def _flanks(level: str, place: str) -> str:
    """The sibling digests left and right of the node at ``place`` of a level, within its run."""
    run = f"({place} div {RUN}) * {RUN * WIDTH}"
    return (f"named_struct('l', substring({level}, {run} + 1, ({place} % {RUN}) * {WIDTH}), "
            f"'r', substring(substring({level}, {run} + 1, {RUN * WIDTH}), ({place} % {RUN} + 1) * {WIDTH} + 1))")


def _opened(blocks: DataFrame) -> DataFrame:
    """The nodes of blocks that carry their own path (``up``): rows (g, pos, digest, x, path), and the blocks' further columns."""
    own = f"""CASE WHEN n = 1 THEN array() WHEN n <= {RUN} THEN array({_flanks('l0', 'i')})
                   ELSE array({_flanks('l0', 'i')}, {_flanks('l1', f'(i div {RUN})')}) END"""
    nodes = f"""transform(items, (x, i) -> named_struct('pos', block * {BLOCK} + i, 'digest', substring(l0, i * {WIDTH} + 1, {WIDTH}),
                'x', x, 'path', concat(CAST({own} AS {PATH_TYPE}), up)))"""
    rest = [c for c in blocks.columns if c not in ("block", "n", "items", "l0", "l1", "top", "up")]
    return blocks.select(*rest, F.explode(F.expr(nodes)).alias("e")).select(*rest, "e.*")


def _forest(nodes: DataFrame, most: int, what: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds' blocks from the nodes up, and the groups' roots (g, root). ``most`` is the size of the largest group."""
    rounds, roots = [], []
    while True:
        blocks = _blocks(nodes, what)
        rounds.append(blocks)
        roots.append(blocks.where(f"n <= {BLOCK}").select("g", F.col("top").alias("root")))
        if most <= BLOCK:
            break
        most = -(-most // BLOCK)
        nodes = (blocks.where(f"n > {BLOCK}")
                 .select("g", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
                         F.col("top").alias("digest"), F.lit(0).alias("x")))
    found = roots[0]
    for later in roots[1:]:
        found = found.unionByName(later)
    return rounds, found


def _paths(rounds: list[DataFrame], done: DataFrame) -> DataFrame:
    """The opened nodes of the first round. ``done`` (g, up, ...): path and further columns of every group's root."""
    extra = [c for c in done.columns if c != "g"]
    above: DataFrame | None = None
    for blocks in reversed(rounds):
        whole = blocks.where(f"n <= {BLOCK}").join(done, "g")
        if above is not None:
            linked = above.select("g", F.col("pos").alias("block"), F.col("path").alias("up"), *[c for c in extra if c != "up"])
            whole = whole.unionByName(blocks.where(f"n > {BLOCK}").join(linked, ["g", "block"]))
        above = _opened(whole)
    return above


def manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "source",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), also: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path, and the columns of ``also`` by their names.

    ``path`` lists the sibling digests (l, r) of each level from the leaf to the root; ``fold(leaf, path)`` is the root.
    A group's leaves ascend by id, null ids first, rows that share an id by their leaf (rows that share both are alike
    and take neighbouring places). Groups stand in order of their UTF-8 bytes, the null group first. A null field counts
    as ``-``, which no value gives; an empty text as ``0:``. Texts are hashed whole, whatever their length. A group of one
    row has its leaf as subroot, a table of one group its subroot as root; an empty table gives no rows. Further
    columns of ``docs`` play no part, whatever their names."""
    also = also or {}
    key = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = docs.select(key.alias("g"), F.col(doc_id).alias("id"), leaf_hash(*map(F.col, fields)).alias("digest"),
                         F.struct(F.lit(0).alias("o"), *[c.alias(f"c_{name}") for name, c in also.items()]).alias("c"))
    # written first: the texts are hashed once, and the number that tells alike rows apart is fixed in the file
    leaves = settle(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = _numbered(leaves, ["id", "digest", "row"], "merkle-order")
    sizes = leaves.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    n_groups, most = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    rows, subroots = _forest(placed.select("g", "pos", "n", "digest", F.struct("id", "c").alias("x")), most, "merkle-blocks")

    tops = _numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("root").alias("digest")), ["key"], "merkle-groups")
    groups, roots = _forest(tops.select("g", "pos", "n", "digest", F.col("key").alias("x")), n_groups, "merkle-top")
    done = _paths(groups, roots.select("g", "root", F.array().cast(PATH_TYPE).alias("up")))
    found = _paths(rows, settle(done.select(F.col("x").alias("g"), F.col("digest").alias("subroot"), "root", F.col("path").alias("up")),
                                "merkle-roots"))
    return found.select(F.col("x.id").alias(doc_id), F.col("digest").alias("leaf"), "subroot", "root", "path",
                        *[F.col(f"x.c.c_{name}").alias(name) for name in also])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` folded from rows some of which were changed after it was made: where 5 divides the CRC-32
    of the decimal id, the text has its capitals A-Z in lower case. ``verified`` says whether a row still leads to the root."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    changed = F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    seen = leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), changed)
    made = manifest(docs, also={"seen": seen})
    folded = made.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                         fold(F.col("seen"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


# The same tree with lists: a group's level is a list, and every further level comes from the one before by recursion.
_SQL_LEVELS = """
  SELECT {key} AS g, 0 AS lvl, list({node} ORDER BY {order}) AS nodes FROM {table} GROUP BY {key}
  UNION ALL
  SELECT g, lvl + 1, list_transform(range((len(nodes) + 15) // 16), lambda i: sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')))
  FROM {name} WHERE len(nodes) > 1
"""
_SQL_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0})) || ':' || {0} END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_SQL_FIELD.format(c) for c in (
        "CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"


_SQL_BITS = "list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
_SQL_CRC = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), "
            f"lambda crc, byte: {_SQL_BITS}), 4294967295)")

MANIFEST_SQL = f"""
WITH RECURSIVE hit AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND {_SQL_CRC} % 5 = 0
                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen_text FROM documents
), leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS k, {_sql_leaf("text")} AS leaf, {_sql_leaf("seen_text")} AS seen FROM hit
), places AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), own AS ({_SQL_LEVELS.format(key="k", node="leaf", order="pos", table="places", name="own")}
), subroots AS (
  SELECT g, lvl AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM own WHERE len(nodes) = 1
), upper_ AS ({_SQL_LEVELS.format(key="''", node="subroot", order="pos", table="subroots", name="upper_")}
), steps AS (
  SELECT p.k, p.pos, o.lvl, (p.pos // CAST(power(16, o.lvl) AS BIGINT)) % 16 AS j,
         o.nodes[(p.pos // CAST(power(16, o.lvl + 1) AS BIGINT)) * 16 + 1 : (p.pos // CAST(power(16, o.lvl + 1) AS BIGINT)) * 16 + 16] AS run
  FROM places p JOIN own o ON o.g = p.k WHERE len(o.nodes) > 1
  UNION ALL
  SELECT p.k, p.pos, s.height + u.lvl, (s.pos // CAST(power(16, u.lvl) AS BIGINT)) % 16,
         u.nodes[(s.pos // CAST(power(16, u.lvl + 1) AS BIGINT)) * 16 + 1 : (s.pos // CAST(power(16, u.lvl + 1) AS BIGINT)) * 16 + 16]
  FROM places p JOIN subroots s ON s.g = p.k, upper_ u WHERE len(u.nodes) > 1
), flanks AS (
  SELECT k, pos, lvl, array_to_string(run[1 : j], '') AS l, array_to_string(run[j + 2 :], '') AS r FROM steps
), paths AS (
  SELECT k, pos, list([l, r] ORDER BY lvl) AS path FROM flanks GROUP BY k, pos
), folded AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM upper_ WHERE len(nodes) = 1) AS root,
         sha256(coalesce(array_to_string(list_transform(path, lambda x: x[1] || x[2]), ''), '')) AS proof_sha256,
         coalesce(list_reduce(list_prepend([p.seen, ''], path), lambda a, x: [sha256(x[1] || a[1] || x[2]), ''])[1], p.seen) AS folded_root
  FROM places p JOIN subroots s ON s.g = p.k LEFT JOIN paths t ON t.k = p.k AND t.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM folded
"""
