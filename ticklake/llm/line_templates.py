"""Line dedup by a log-template tree (operator 2).

Lines are parsed as a log parser does it (after He et al., "Drain", ICWS 2017):

* variable fields, tokens that hold a digit, become ``<*>``; a line of mostly
  fields (tables, scores, dates) stays as it is and only equals itself;
* a tree of fixed depth files each line under its token count and its
  ``LEADING`` first tokens;
* in a leaf, a line joins the first template that agrees with it on at least
  ``SIMILARITY`` of the token positions that are not a field in both; positions
  that differ become ``<*>`` in the template. Otherwise it founds a template.

A template that occurs in at least ``MIN_DOCS`` documents recurs: its lines are
dropped from every document but the one with the smallest doc_id. The operator's
query and the pipeline do so for lines of every positive token count (those of up
to ``LEADING`` tokens share a leaf and a template only if they are equal, masked);
called without ``min_tokens``, lines of fewer than ``MIN_TOKENS`` are left alone.

On Spark: equal masked lines are merged first (map-side), so a line that a
third of all documents share is one row in its leaf. Only leaves with more
than one distinct line need comparing. A leaf is compared in chunks of about
``CHUNK`` lines. The templates of a leaf of several chunks are then linked with
each other: dealt by what they hold at blocks of positions, of which alike ones
share one at least (``alike``), so that no task holds an unbounded leaf and no
link is lost; linked templates become one. Within a chunk lines go in the order
of their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import NO_ID, partitions_for, stored
from ticklake.llm.graph import components

LEADING = 3
SIMILARITY = 0.8
MIN_DOCS = 2
MIN_TOKENS = 4
CHUNK = 2000
SHARD_LINES = 20_000
BROADCAST_LEAVES = 2_000_000  # of 16 bytes; beyond it the join shuffles
FIELD = "<*>"
MAX_FIELDS = 0.5  # share of a line's tokens


def masked(line: Column) -> Column:
    """The line's tokens joined by single blanks, digit-bearing ones as ``<*>``
    unless they are more than ``MAX_FIELDS`` of the line."""

    def choose(blanks: Column) -> Column:
        return _let(
            F.regexp_replace(blanks, r"[^ ]*[0-9][^ ]*", FIELD),
            lambda changed: F.when(_count(changed, FIELD) > MAX_FIELDS * (_count(blanks, " ") + 1), blanks).otherwise(changed),
        )

    changed = _let(F.btrim(F.regexp_replace(line, r"\s+", " ")), choose)
    # most lines hold neither digits nor odd blanks: a look tells
    odd = line.rlike(r"[0-9\t\x0B\f\r]") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return F.when(odd, changed).otherwise(line)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _count(text: Column, piece: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)


def distinct_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``(doc, text_key, leaf, line, masked)``: every distinct masked line of each row.

    ``doc`` is doc_id, or a stand-in above all ids where it is null (rows that
    share a doc_id are one document); with ``text_key`` it names rows of one text.
    """
    # masked inside the array, so that no filter repeats the work per line
    every = F.array_distinct(F.transform(F.split("text", "\n"), masked))
    cut = docs.where("text is not null").select(*_row_key(F.col("doc_id"), F.col("text")), F.explode(every).alias("masked"))
    n_tokens = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    # digits are left in lines of mostly fields only: a leaf for each
    leaf = F.xxhash64(n_tokens, F.when(F.col("masked").rlike("[0-9]"), F.col("masked")).otherwise(F.substring_index("masked", " ", LEADING)))
    return cut.where((n_tokens >= min_tokens) & (F.col("masked") != "")).select("doc", "text_key", leaf.alias("leaf"), F.xxhash64("masked").alias("line"), "masked")


def _row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    return F.coalesce(doc_id, F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_key")


class LeafTemplates:
    """Templates of one leaf: rows of token numbers, -1 where they vary."""

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.rows: np.ndarray | None = None
        self.n = 0
        self.founder: list[int] = []

    def file(self, tokens: np.ndarray, founder: int) -> int:
        """Number of the template that the line joins or founds."""
        if self.rows is None:
            self.rows = np.empty((4, len(tokens)), np.int32)
        equal = self.rows[: self.n] == tokens
        fields = (equal & (tokens < 0)).sum(1)
        fits = np.flatnonzero(equal.sum(1) - fields >= self.similarity * (len(tokens) - fields))
        if len(fits):
            at = int(fits[0])
            self.rows[at][self.rows[at] != tokens] = -1
            return at
        if self.n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[self.n] = tokens
        self.n += 1
        self.founder.append(founder)
        return self.n - 1


def _file_lines(similarity: float):
    """Lines (leaf, group, line, masked) of some leaves -> (leaf, line, template, pattern)."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("leaf", "ascending"), ("group", "ascending"), ("masked", "ascending")])
        at, out = None, ([], [], [], [])
        number: dict[str, int] = {}
        filed: list[tuple[int, int]] = []
        tree = LeafTemplates(similarity)

        def close():
            name = {k: w for w, k in number.items()} | {-1: FIELD}
            text = [" ".join(name[int(x)] for x in row) for row in (tree.rows[: tree.n] if tree.n else [])]
            for line, k in filed:
                for column, value in zip(out, (at[0], line, tree.founder[k], text[k])):
                    column.append(value)

        for leaf, group, line, text in zip(*(t.column(c).to_pylist() for c in ("leaf", "group", "line", "masked"))):
            if at != (leaf, group):
                if at:
                    close()
                at, number, filed, tree = (leaf, group), {}, [], LeafTemplates(similarity)
            tokens = np.array([-1 if w == FIELD else number.setdefault(w, len(number)) for w in text.split(" ")], np.int32)
            filed.append((line, tree.file(tokens, line)))
        if at:
            close()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, x) for c, x in zip(out, types)], names=["leaf", "line", "template", "pattern"])

    return run


def _file(lines: DataFrame, rows: int, similarity: float) -> DataFrame:
    shards = partitions_for(rows, SHARD_LINES, 12)
    return (
        lines.withColumn("shard", F.pmod(F.xxhash64("leaf", "group"), F.lit(shards)))
        .groupBy("shard").applyInArrow(_file_lines(similarity), "leaf long, line long, template long, pattern string")
    )


def templates(lines: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK) -> DataFrame:
    """``(leaf, line, template, pattern)`` for the lines of leaves that hold more
    than one distinct line. ``template`` is the line hash of its founder.

    ``lines``: a stored (doc, leaf, line, masked).
    """
    distinct = lines.groupBy("leaf", "line").agg(F.count("*").alias("n"))
    crowded = stored(
        distinct.groupBy("leaf").agg(F.count("*").alias("lines")).where("lines > 1"), "leaves"
    )
    # few lines lie in such leaves; while the leaves fit a broadcast, the texts
    # of the others are not shuffled
    few = crowded.count() <= BROADCAST_LEAVES
    wanted = lines.select("leaf", "line", "masked").join(F.broadcast(crowded) if few else crowded, "leaf")
    # one text per line: equal hashes are taken as equal lines
    once = wanted.groupBy("leaf", "line").agg(F.first("masked").alias("masked"), F.first("lines").alias("lines"))
    group = F.pmod(F.xxhash64("line"), F.ceil(F.col("lines") / chunk)).cast("int")
    first = stored(_file(once.withColumn("group", group), crowded.agg(F.sum("lines")).first()[0] or 0, similarity), "filed")
    # leaves of several chunks: their templates are linked
    split = crowded.where(F.col("lines") > chunk).select("leaf")
    if not split.take(1):
        return first
    heads = stored(first.join(split, "leaf").groupBy("leaf", "template").agg(F.first("pattern").alias("pattern")), "heads")
    joined = stored(components(alike(heads, similarity, chunk)).withColumnRenamed("node", "template"), "joined")
    # where the joined templates differ is a field
    places = heads.join(joined, "template").select("component", F.posexplode(F.split("pattern", " ")).alias("at", "token"))
    tokens = (
        places.groupBy("component", "at").agg(F.min("token").alias("low"), F.max("token").alias("high"))
        .groupBy("component").agg(F.array_sort(F.collect_list(F.struct(
            "at", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(FIELD).alias("token")))).alias("tokens"))
    )
    wider = tokens.select("component", F.array_join(F.col("tokens")["token"], " ").alias("wider"))
    renamed = joined.join(wider, "component").select("template", "component", "wider")
    return first.join(renamed, "template", "left").select(
        "leaf", "line", F.coalesce("component", "template").alias("template"), F.coalesce("wider", "pattern").alias("pattern")
    )


def alike(heads: DataFrame, similarity: float = SIMILARITY, most: int = CHUNK) -> DataFrame:
    """Links ``(u, v)`` that join all templates of a leaf, ``heads`` (leaf, template,
    pattern), that agree on at least ``similarity`` of the positions that are not
    a field in both. Linked templates are connected, not every pair is named.

    A group of at most ``most`` is compared in one task. Of a larger one, whose
    members agree on some positions already, two that are alike differ in at most
    e of the others: these are cut into e + 1 blocks, and the group is dealt anew
    once a block by what stands there. Both meet wherever they agree. A group that
    can differ in no more than is allowed is linked as a star. Every round fixes
    more positions, so the rounds end.
    """
    one = heads.groupBy("leaf", "pattern").agg(F.min("template").alias("first"))
    same = heads.join(one, ["leaf", "pattern"]).where("template <> first").select(F.col("first").alias("u"), F.col("template").alias("v"))
    known = F.sequence(F.lit(0), F.least(F.lit(LEADING), F.size("tokens")) - 1)
    work = one.select(F.col("leaf").alias("key"), F.col("first").alias("template"), F.split("pattern", " ").alias("tokens")).withColumn("known", known)
    found = [stored(same, "links")]
    while True:
        work = stored(work, "groups")
        sizes = work.groupBy("key").agg(F.count("*").alias("members"), F.min("template").alias("least")).where("members > 1")
        sized = stored(work.join(sizes, "key"), "sized")
        small = sized.where(F.col("members") <= most)
        shards = partitions_for(small.count(), SHARD_LINES, 12)
        found.append(stored(
            small.select("key", "template", "tokens", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
            .groupBy("shard").applyInArrow(_link_groups(similarity), "u long, v long"), "links"))
        large = sized.where(F.col("members") > most)
        if not large.take(1):
            break
        n, tokens = F.size("tokens"), F.col("tokens")
        fields = F.size(F.filter("known", lambda i: tokens[i] == FIELD))
        rest = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.array_contains("known", i))
        large = (
            large.withColumn("constant", n - fields).withColumn("rest", rest).withColumn("left", F.size("rest"))
            .withColumn("differ", F.floor((1 - similarity) * F.col("constant") + 1e-9).cast("int"))
        )
        star = F.col("constant") - F.col("left") >= similarity * F.col("constant")
        found.append(stored(large.where(star & (F.col("template") != F.col("least"))).select(F.col("least").alias("u"), F.col("template").alias("v")), "links"))
        # differ = 0: only equal ones are alike, and those are one already
        dealt = large.where(~star & (F.col("differ") > 0)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("differ"))))
        edge = lambda b: F.floor(b * F.col("left") / (F.col("differ") + 1)).cast("int")
        low, high = edge(F.col("block")), edge(F.col("block") + 1)
        dealt = dealt.withColumn("at", F.slice("rest", low + 1, high - low))
        work = dealt.select(
            F.xxhash64("key", "block", F.transform("at", lambda i: F.col("tokens")[i])).alias("key"),
            "template", "tokens", F.concat("known", "at").alias("known"),
        )
    out = found[0]
    for links in found[1:]:
        out = out.union(links)
    return out


def _link_groups(similarity: float):
    """Groups (key, template, tokens) of a bounded size -> links that span what is alike."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("key", "ascending"), ("template", "ascending")])
        keys, names = t.column("key").to_numpy(), t.column("template").to_numpy()
        u, v = [], []
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
        for a, b in zip(starts, [*starts[1:], len(keys)]):
            number = {FIELD: -1}
            # keys are hashes: rows of another length, of a clash, are never alike
            lists = t.column("tokens").slice(a, b - a).to_pylist()
            for size in {len(x) for x in lists}:
                at = [k for k, x in enumerate(lists) if len(x) == size]
                rows = np.array([[number.setdefault(w, len(number)) for w in lists[k]] for k in at], np.int32)
                root = np.arange(len(at))
                for i in range(len(at) - 1):
                    equal = rows[i + 1 :] == rows[i]
                    fields = (equal & (rows[i] < 0)).sum(1)
                    for j in i + 1 + np.flatnonzero(equal.sum(1) - fields >= similarity * (size - fields)):
                        if root[j] != root[i]:
                            root[root == root[j]] = root[i]
                            u.append(names[a + at[i]])
                            v.append(names[a + at[j]])
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def recurring_lines(lines: DataFrame, similarity: float = SIMILARITY, min_docs: int = MIN_DOCS, chunk: int = CHUNK) -> DataFrame:
    """``(line, template, pattern, n_docs, first_doc)`` of the lines whose template
    recurs. n_docs counts (document, distinct line) pairs of the template."""
    counts = stored(
        lines.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high")), "lines"
    )
    filed = stored(templates(lines, similarity, chunk), "templates")
    named = stored(
        counts.join(filed, ["leaf", "line"], "left")
        .withColumn("template", F.coalesce("template", "line")),
        "named",
    )
    recurs = stored(
        named.groupBy("template").agg(F.sum("n").alias("n_docs"), F.min("low").alias("first_doc"), F.max("high").alias("last_doc"))
        .where((F.col("n_docs") >= min_docs) & (F.col("first_doc") < F.col("last_doc"))).drop("last_doc"),
        "recurring",
    )
    return named.select("line", "template", "pattern").join(recurs, "template")


def drop_recurring(docs: DataFrame, similarity: float = SIMILARITY, min_docs: int = MIN_DOCS, chunk: int = CHUNK,
                   min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` with recurring lines cut from ``text``, plus the number of lines
    and characters cut (``lines_dropped``, ``chars_dropped``).

    Every row stays, also one whose text becomes empty. Null texts stay null,
    empty ones empty. Rows that share a doc_id (null included) count as one
    document. Extra columns pass through (but for the two added names).
    """
    lines = stored(distinct_lines(docs.select("doc_id", "text"), min_tokens), "doclines")
    recurring = stored(recurring_lines(lines, similarity, min_docs, chunk).select("line", "first_doc"), "drops")
    cut = (
        lines.select("doc", "text_key", "line").join(recurring, "line").where("doc <> first_doc")
        .groupBy("doc", "text_key").agg(F.collect_set("line").alias("_cut"))
    )
    # the row travels as one struct, so that no column of it can clash
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    own = docs.select(row, *_row_key(F.col("doc_id"), F.col("text")))
    text = F.col("row")["text"]
    # a text's own lines bound its set
    keep = F.filter(F.split(text, "\n"), lambda l: ~F.array_contains("_cut", F.xxhash64(masked(l))))
    joined = own.join(cut, ["doc", "text_key"], "left").withColumn("_kept", F.when(F.col("_cut").isNotNull() & text.isNotNull(), keep))
    out = F.when(F.col("_kept").isNull(), text).otherwise(F.array_join("_kept", "\n"))
    dropped = F.when(F.col("_kept").isNull(), 0).otherwise(F.size(F.split(text, "\n")) - F.size("_kept"))
    chars = F.coalesce(F.length(text) - F.length(out), F.lit(0))
    names = [c for c in docs.columns if c not in ("lines_dropped", "chars_dropped")]
    return joined.select(
        *((out if c == "text" else F.col("row")[c]).alias(c) for c in names),
        dropped.cast("long").alias("lines_dropped"), chars.cast("long").alias("chars_dropped"),
    )


def op2_line_templates(spark, sf_dir):
    """Every document after line dedup: counts and the cleaned text's digest."""
    from ticklake.llm.common import table

    kept = drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"), min_tokens=1)
    return kept.select("doc_id", "lines_dropped", "chars_dropped", F.length("text").cast("long").alias("chars_kept"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
