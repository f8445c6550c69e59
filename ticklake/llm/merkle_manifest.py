"""Merkle manifest of a dataset through concatenated-level strings (operator 13).

1. Every row becomes a leaf digest (lowercase hex SHA-256 of its length-prefixed
   fields); only digests and ids travel from here on.
2. Leaves are numbered within their tree (one tree per group value) by one range
   exchange: the position is the row's place in its sorted partition plus the
   rows of the partitions before it.
3. ``SPAN`` levels at a time, aligned blocks of ``ARITY ** SPAN`` nodes keep each
   level as one hex string. A parent is the hash of a fixed-width substring; the
   substrings that flank a node are its sibling segment. Block tops are the nodes
   of the next round, so no string or group ever exceeds a block.
4. The roots of all trees are the nodes of one more tree, built the same way.
5. Paths come down again round by round: a block's path to the root is joined to
   it, then its rows take their own segments from the block's strings.

Everything is DataFrame functions. Work is one shuffle of narrow rows by range and
one by block; the later rounds are 512 times smaller each.

Defined results: a null field is written ``-``; null group values form the first
tree; null ids come first; equal ids are ordered by digest, and wholly equal rows
have equal results; an empty table has no rows; columns that are not named are
ignored, whatever they are called; texts of any length are hashed whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import stored, table

ARITY = 8
SPAN = 3
WIDTH = 64  # hex digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_RUN = ARITY * WIDTH
_BLOCK = ARITY**SPAN
_NO_PATH = "cast(array() as array<struct<left:string,right:string>>)"


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value (integers in decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*(encoded(f) for f in fields)), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that ``digest`` and its sibling segments lead to."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, within the tree) and ``n`` (rows of the tree).

    ``order`` must end in a column that tells repeated rows apart, so that a
    range of equal keys can be cut anywhere.
    """
    laid = stored(
        rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)),
        "numbered",
    )
    counts = laid.groupBy(tree, "_part").agg(F.count("*").alias("_many"), F.min("_at").alias("_first"))
    # one row per tree and partition: the windows are over partitions, not rows
    whole = Window.partitionBy(tree)
    offsets = counts.select(
        tree, "_part", "_first", F.sum("_many").over(whole).alias("n"),
        (F.sum("_many").over(whole.orderBy("_part")) - F.col("_many")).alias("_before"),
    )
    return (
        laid.join(offsets, [tree, "_part"])
        .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_part", "_first", "_before")
    )


def _above(level: str) -> Column:
    """The level above a level string: one hash per fixed-width substring."""
    return F.expr(
        f"array_join(transform(sequence(0, (length({level}) - 1) div {_RUN}),"
        f" i -> sha2(substring({level}, i * {_RUN} + 1, {_RUN}), 256)), '')"
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block: its members and its level strings.

    ``height`` is what is left to climb from this level to the tree's root.
    """
    powers = ", ".join(f"{ARITY**i}L" for i in range(63 // 3))
    out = (
        nodes.withColumn("block", F.expr(f"pos div {_BLOCK}"))
        .groupBy("tree", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "payload"))).alias("members"), F.min("n").alias("n"))
        .withColumn("height", F.expr(f"size(filter(array({powers}), p -> p < n))"))
        .withColumn("level0", F.array_join(F.col("members.digest"), ""))
    )
    for k in range(1, SPAN + 1):
        out = out.withColumn(f"level{k}", F.when(F.col("height") >= k, _above(f"level{k - 1}")))
    top = F.coalesce(*(F.col(f"level{k}") for k in range(SPAN, -1, -1)))
    return out.withColumn("top", top).drop(f"level{SPAN}")


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks over ``(tree, pos, n, digest, payload)``, and ``(tree, root)``."""
    rounds = []
    while True:
        blocks = stored(_blocks(nodes), "blocks")
        rounds.append(blocks)
        higher = blocks.where(F.col("height") > SPAN)
        if higher.isEmpty():
            break
        nodes = higher.select(
            "tree", F.col("block").alias("pos"), F.expr(f"(n + {_BLOCK - 1}) div {_BLOCK}").alias("n"),
            F.col("top").alias("digest"), F.lit(0).alias("payload"),
        )
    ended = [b.where(F.col("height") <= SPAN).select("tree", F.col("top").alias("root")) for b in rounds]
    return rounds, reduce(DataFrame.union, ended)


def _members(blocks: DataFrame) -> DataFrame:
    """Members of blocks that carry ``path`` and ``info``, each with its own path."""
    runs = blocks.select(
        "tree", "height", "path", "info", "members", *(f"level{k}" for k in range(SPAN)),
        F.explode(F.expr(f"sequence(0, (size(members) - 1) div {ARITY})")).alias("run"),
    )
    # the run that holds the member at each level, then the place in that run
    cut = [
        F.expr(f"substring(level{k}, (run div {ARITY**k}) * {_RUN} + 1, {_RUN})").alias(f"run{k}") for k in range(SPAN)
    ]
    rows = runs.select(
        "tree", "height", "path", "info", "run", *cut,
        F.posexplode(F.expr(f"slice(members, run * {ARITY} + 1, {ARITY})")).alias("place", "member"),
    )

    def segment(k: int) -> Column:
        place = "place" if k == 0 else f"((run div {ARITY ** (k - 1)}) % {ARITY})"
        return F.struct(
            F.expr(f"substring(run{k}, 1, {place} * {WIDTH})").alias("left"),
            F.expr(f"substring(run{k}, ({place} + 1) * {WIDTH} + 1)").alias("right"),
        )

    own = F.slice(F.array(*(segment(k) for k in range(SPAN))), F.lit(1), F.least(F.col("height"), F.lit(SPAN)))
    return rows.select("tree", "member.*", F.concat(own, F.col("path")).alias("path"), "info")


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``(tree, pos, digest, payload, path, info)`` of all first-round members.

    ``tops``: ``(tree, path, info)``, what follows each tree's root.
    """
    below = None
    for blocks in reversed(rounds):
        here = blocks.where(F.col("height") <= SPAN).join(tops, "tree")
        if below is not None:
            here = here.unionByName(blocks.where(F.col("height") > SPAN).join(below, ["tree", "block"]))
        found = _members(here)
        below = found.select("tree", F.col("pos").alias("block"), "path", "info")
    return found


def manifest(rows: DataFrame, group: Column, key: Column, leaf: Column, *carried: Column) -> DataFrame:
    """``(key, leaf, subroot, root, path, *carried)`` for every row of ``rows``.

    One tree per value of ``group`` (null first, then by UTF-8 bytes) over its
    rows by ``key``; one tree over their subroots. ``path`` holds the sibling
    segments from the leaf through the subroot to the root.
    """
    tree = F.when(group.isNull(), "").otherwise(F.concat(F.lit("+"), group.cast("string")))
    leaves = stored(
        rows.select(
            tree.alias("tree"), key.alias("key"), leaf.alias("digest"), F.monotonically_increasing_id().alias("row"),
            F.struct(key.alias("key"), *carried).alias("payload"),
        ),
        "leaves",
    )
    laid = numbered(leaves, "tree", ["key", "digest", "row"]).select("tree", "pos", "n", "digest", "payload")
    rounds, roots = grow(laid)
    branches = numbered(
        roots.select(
            F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"),
            F.struct(F.col("tree").alias("key")).alias("payload"),
        ),
        "tree", ["key"],
    ).select("tree", "pos", "n", "digest", "payload")
    upper, one = grow(branches)
    tops = descend(upper, one.select("tree", F.expr(_NO_PATH).alias("path"), F.struct("root").alias("info")))
    tops = stored(
        tops.select(
            F.col("payload.key").alias("tree"), "path", F.struct(F.col("digest").alias("subroot"), "info.root").alias("info")
        ),
        "subroots",
    )
    found = descend(rounds, tops)
    return found.select("payload.*", F.col("digest").alias("leaf"), "info.subroot", "info.root", "path")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark, sf_dir):
    """Every document's leaf, subroot, root and proof, and the root that its
    (partly tampered) row folds to."""
    docs = table(spark, sf_dir, "documents")
    now = {f: F.col(f) for f in FIELDS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    now["text"] = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    found = manifest(
        docs, F.col("lang"), F.col("doc_id"), row_digest(*(F.col(f) for f in FIELDS)),
        row_digest(*now.values()).alias("seen"),
    )
    folded = fold(F.col("seen"), F.col("path"))
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(name: str, value: str | None = None) -> str:
    text = f"cast({value or name} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


# Tables of the CRC follow from its polynomial; levels are one recursive query each.
ORACLE_SQL = f"""
with recursive crc_table as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from (select unnest(range(256))::bigint as i)
), docs as (
  select doc_id, source, lang, n_chars, text,
    coalesce(xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda ch: ord(ch)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0, false) as hit
  from documents, crc_table
), leaves as (
  select doc_id, case when lang is null then '' else '+' || lang end as tree,
    sha256({' || '.join(_field(f) for f in FIELDS)}) as leaf,
    sha256({' || '.join(_field(f, f"case when hit then translate(text, '{_UPPER}', '{_LOWER}') else text end" if f == 'text' else None) for f in FIELDS)}) as seen
  from docs
), placed as (
  select *, row_number() over (partition by tree order by encode(tree), doc_id nulls first, leaf) - 1 as pos from leaves
), low(tree, lvl, pos, digest, n) as (
  select tree, 0, pos, leaf, count(*) over (partition by tree) from placed
  union all
  select tree, lvl + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), (n + 7) // 8
  from low where n > 1 group by tree, lvl, pos // 8, n
), subroots as (
  select tree, digest as subroot, row_number() over (order by encode(tree)) - 1 as branch from low where n = 1
), upp(lvl, pos, digest, n) as (
  select 0, branch, subroot, count(*) over () from subroots
  union all
  select lvl + 1, pos // 8, sha256(string_agg(digest, '' order by pos)), (n + 7) // 8 from upp where n > 1 group by lvl, pos // 8, n
), sides as (
  select tree, lvl, pos,
    coalesce(string_agg(digest, '') over (partition by tree, lvl, pos // 8 order by pos rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(digest, '') over (partition by tree, lvl, pos // 8 order by pos rows between 1 following and unbounded following), '') as r
  from low where n > 1
  union all
  select null, lvl, pos,
    coalesce(string_agg(digest, '') over (partition by lvl, pos // 8 order by pos rows between unbounded preceding and 1 preceding), ''),
    coalesce(string_agg(digest, '') over (partition by lvl, pos // 8 order by pos rows between 1 following and unbounded following), '')
  from upp where n > 1
), steps as (
  select p.tree, p.pos, s.lvl as step, s.l, s.r
  from placed p join sides s on s.tree = p.tree and s.pos = p.pos // (8 ** s.lvl)::bigint
  union all
  select p.tree, p.pos, 100 + s.lvl, s.l, s.r
  from placed p join subroots b on b.tree = p.tree join sides s on s.tree is null and s.pos = b.branch // (8 ** s.lvl)::bigint
), paths as (
  select tree, pos, list({{'l': l, 'r': r}} order by step) as path from steps group by tree, pos
), whole as (
  select p.doc_id, p.leaf, p.seen, b.subroot, (select digest from upp where n = 1) as root,
    coalesce(path, []) as path
  from placed p join subroots b on b.tree = p.tree left join paths q on q.tree = p.tree and q.pos = p.pos
)
select doc_id, leaf, subroot, root,
  sha256(coalesce(array_to_string(list_transform(path, lambda s: s.l || s.r), ''), '')) as proof_sha256,
  list_reduce(list_prepend({{'l': '', 'r': seen}}, path), lambda a, s: {{'l': '', 'r': sha256(s.l || a.r || s.r)}}).r as folded_root,
  list_reduce(list_prepend({{'l': '', 'r': seen}}, path), lambda a, s: {{'l': '', 'r': sha256(s.l || a.r || s.r)}}).r = root as verified
from whole
"""
