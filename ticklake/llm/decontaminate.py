"""Benchmark decontamination by a distributed positional inverted index (operator 9).

``build_index`` cuts the corpus into shards of documents and stores, per shard,
the positional postings of every token that some test item uses (tokens that
no test item uses cannot take part in a match). One row per shard, written as
Parquet: postings never cross a shard, so building and searching need no
shuffle and a hot token is only as large as its shard's list.

``search`` runs the test windows against every shard: windows with a term that
the shard lacks fall out at once; the rest intersect offset-adjusted lists,
from the rarest term on. Two kinds of match come back per document:

* phrase: the window's words at consecutive positions;
* proximity: all of the window's words within ``slop`` further words, in any
  order (reported as ``n_near_items``).

The test set is broadcast in parts of whole items of at most ``MAX_TEST_WORDS``
words, counted before anything reaches the driver. With one part the index holds
its words only; with more it holds every word, is searched once per part, and
the hit spans and items are put together per document row. An item of over
``MAX_TEST_WORDS`` words is cut into pieces that overlap by a window less a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, map_rows, stored
from ticklake.session import scratch_path

WINDOW = 10
SLOP = 5
SHARD_WORDS = 1_000_000
CANDIDATES = 1_000_000  # positions that are compared at once
SHARD_DOCS = 4096
MAX_TEST_WORDS = 2_000_000
GAP = 64  # positions left free after each document; above a window plus slop

# Words in UTF-8: runs of 0-9, a-z and bytes of non-ASCII letters, once A-Z are
# lower-cased; every other byte becomes a blank.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

INDEX = (
    "doc_ids array<bigint>, doc_null array<boolean>, doc_keys array<string>, n_words array<bigint>, "
    "terms array<binary>, n_postings array<int>, postings binary"
)
_ARROW = pa.schema([
    ("doc_ids", pa.list_(pa.int64())), ("doc_null", pa.list_(pa.bool_())), ("doc_keys", pa.list_(pa.string())),
    ("n_words", pa.list_(pa.int64())),
    ("terms", pa.list_(pa.binary())), ("n_postings", pa.list_(pa.int32())), ("postings", pa.binary()),
])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def pieces(words: list[bytes], most: int, width: int) -> Iterator[list[bytes]]:
    """``words`` in pieces of at most ``most`` words (a window at least) that overlap by
    ``width - 1``, so that every window lies whole in one of them."""
    step = max(1, most - width + 1)
    for at in range(0, max(1, len(words) - width + 1), step):
        yield words[at : at + step + width - 1]


def test_parts(bench: DataFrame, width: int = WINDOW) -> tuple[int, Iterator[list[tuple[int, list[bytes]]]]]:
    """Number of words of the test set and its word lists, in parts of whole rows
    of at most ``MAX_TEST_WORDS`` words (items without words have no window). A
    longer item is cut into overlapping pieces that share its id.

    Repeated item_ids count as one item with all their windows, also when their
    rows lie in several parts.
    """
    kind = bench.schema["item_id"].dataType.simpleString()
    given = bench.where("item_id is not null and text is not null").select("item_id", F.col("text").cast("binary").alias("text"))
    rows = stored(
        map_rows(given.distinct(), lambda: lambda i, t: (i, t, len(words_of(t))), f"item_id {kind}, text binary, words long")
        .where("words > 0"), "items",
    )
    total = rows.agg(F.sum("words")).first()[0] or 0
    # dealt by hash to groups that fill four fifths of a part on average
    groups = 1 if total <= MAX_TEST_WORDS else -(-5 * total // (4 * MAX_TEST_WORDS))

    def cut():
        for g in range(groups):
            part, size = [], 0
            for i, t, _ in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).toLocalIterator():
                for words in pieces(words_of(bytes(t)), MAX_TEST_WORDS, width):
                    if part and size + len(words) > MAX_TEST_WORDS:
                        yield part
                        part, size = [], 0
                    part.append((i, words))
                    size += len(words)
            if part:
                yield part

    return total, cut()


def build_index(docs: DataFrame, vocabulary: set[bytes] | None) -> DataFrame:
    """Shard rows of the positional index over ``docs`` (doc_id, text), of the
    words of ``vocabulary`` or (None) of all words. A row's key is ``text_key``.

    A shard closes at ``SHARD_WORDS`` words or ``SHARD_DOCS`` documents; a
    longer document makes a shard of its own, whole. A null text has no words.
    """
    terms = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [] if terms.value is None else sorted(terms.value)
        ids = {w: i for i, w in enumerate(names)}
        docs_, tokens, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text, key in zip(*(c.to_pylist() for c in part.columns)):
                    got = words_of(text)
                    docs_.append((doc_id, key, len(got)))
                    if terms.value is None:  # every shard numbers its own words
                        for w in got:
                            if w not in ids:
                                ids[w] = len(names)
                                names.append(w)
                    tokens.append(np.fromiter(map(ids.get, got, repeat(-1)), np.int32, len(got)))
                    size += len(got)
                    if size >= SHARD_WORDS or len(docs_) >= SHARD_DOCS:
                        yield _shard(docs_, tokens, names)
                        docs_, tokens, size = [], [], 0
                        if terms.value is None:
                            ids, names = {}, []
        if docs_:
            yield _shard(docs_, tokens, names)

    return docs.select("doc_id", F.col("text").cast("binary"), text_key(docs)).mapInArrow(run, INDEX)


def text_key(docs: DataFrame) -> Column:
    """What tells rows apart for a verdict, which hangs on the text alone."""
    return F.sha2(docs["text"].cast("binary"), 256)


def _shard(docs_, tokens, names) -> pa.RecordBatch:
    """One index row. Positions run through the shard with a gap of one window
    between documents, so that no match crosses a document's end."""
    token = np.concatenate(tokens)
    lens = np.array([n for *_, n in docs_], np.int64)
    position = np.arange(len(token), dtype=np.int64) + np.repeat(np.arange(len(lens)) * GAP, lens)
    known = token >= 0
    token, position = token[known], position[known]
    order = np.argsort(token, kind="stable")
    used, many = np.unique(token, return_counts=True)
    wide = np.int32 if not len(position) or position[-1] < 1 << 31 else np.int64
    packed = (b"\4" if wide is np.int32 else b"\x08") + position[order].astype(wide).tobytes()
    ids, keys, _ = zip(*docs_)
    row = ([d or 0 for d in ids], [d is None for d in ids], keys, lens, [names[u] for u in used], many, packed)
    return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, _ARROW)], schema=_ARROW)


class Windows:
    """The test set's windows as arrays of term numbers (-1 pads short items)."""

    def __init__(self, items: list[tuple[int, list[bytes]]], width: int = WINDOW):
        assert width + SLOP < GAP
        self.items = sorted({i for i, _ in items})
        number = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        place = {i: k for k, i in enumerate(self.items)}
        cut = {}
        for i, ws in items:
            ids = [number[w] for w in ws]
            for at in range(max(1, len(ids) - width + 1)):
                part = ids[at : at + width]
                cut[place[i], tuple(part + [-1] * (width - len(part)))] = None
        self.number = number
        self.item = np.array([k for k, _ in cut], np.int64)
        self.term = np.array([t for _, t in cut], np.int64).reshape(-1, width)


def search_shard(win: Windows, row: dict, slop: int) -> dict[str, np.ndarray]:
    """Of one shard: the hit spans (document, first word, end word) and the
    (document, item) pairs of phrase and proximity matches. All windows walk
    their lists side by side."""
    many = np.asarray(row["n_postings"], np.int64)
    wide = np.int32 if row["postings"][:1] == b"\4" else np.int64
    position = np.frombuffer(row["postings"], wide, offset=1).astype(np.int64) + GAP
    n_words = np.asarray(row["n_words"], np.int64)
    doc_start = np.cumsum(n_words + GAP) - n_words  # the first position of each document
    room = int((n_words + GAP).sum()) + 3 * GAP
    # every posting as one number, rising: list * room + position
    key = np.repeat(np.arange(len(many)), many) * room + position
    head = np.cumsum(many) - many
    of_term = np.full(len(win.number) + 1, -1, np.int64)  # the last one answers for padding
    for k, t in enumerate(row["terms"]):
        if t in win.number:
            of_term[win.number[t]] = k
    lists = of_term[win.term]
    size = np.where(win.term < 0, np.iinfo(np.int64).max, np.where(lists < 0, 0, many[lists] if len(many) else 0))
    live = np.flatnonzero(size.min(1) > 0)
    order = np.argsort(size[live], 1, kind="stable")  # rarest first
    length = (win.term[live] >= 0).sum(1)
    hit = np.zeros(room, np.int32)
    phrase, near = [], []
    if len(live):
        rare = lists[live, order[:, 0]]
        block = np.cumsum(many[rare]) // CANDIDATES
        for b in np.unique(block):
            some = np.flatnonzero(block == b)
            w = np.repeat(some, many[rare[some]])
            at = position[np.concatenate([np.arange(head[r], head[r] + many[r]) for r in rare[some]])]
            begin, wp = _offset_intersection(key, room, lists[live], order, length, w, at)
            np.add.at(hit, begin, 1)
            np.add.at(hit, begin + length[wp], -1)
            phrase.append((np.searchsorted(doc_start, begin, side="right") - 1, win.item[live[wp]]))
            # a phrase match is a proximity match; only the others are looked at
            near.append(phrase[-1])
            far = ~np.isin(w * room + at, wp * room + begin + order[wp, 0])
            for u, close in _near(key, room, lists[live], order, length, w[far], at[far], slop):
                near.append((np.searchsorted(doc_start, close, side="right") - 1, np.full(len(close), win.item[live[u]])))
    edge = np.flatnonzero(np.diff(np.r_[False, np.cumsum(hit) > 0, False]))
    of = np.searchsorted(doc_start, edge[::2], side="right") - 1
    spans = np.stack([of, edge[::2] - doc_start[of], edge[1::2] - doc_start[of]], 1)
    return {"spans": spans, "phrase": _pairs(phrase), "near": _pairs(near)}


def _offset_intersection(key, room, lists, order, length, w, at):
    """Starts of the windows ``w`` that hold all their words in a row, from the
    positions ``at`` of each one's rarest word."""
    begin = at - order[w, 0]
    for k in range(1, order.shape[1]):
        off = order[w, k]
        want = lists[w, off] * room + begin + off
        found = np.searchsorted(key, want)
        ok = (key[np.minimum(found, len(key) - 1)] == want) | (k >= length[w])
        w, begin = w[ok], begin[ok]
    return begin, w


def _near(key, room, lists, order, length, w, at, slop):
    """(window, positions of its rarest word) where all its words are close."""
    for k in range(1, order.shape[1]):
        far = length[w] + slop - 1
        base = lists[w, order[w, k]] * room + at
        found = np.searchsorted(key, base - far)
        ok = (key[np.minimum(found, len(key) - 1)] <= base + far) & (found < len(key)) | (k >= length[w])
        w, at = w[ok], at[ok]
    for u in np.unique(w):
        own = lists[u, order[u, : length[u]]]
        here = at[w == u]
        here = here[_one_span(key, room, own, here, length[u] + slop)]
        if len(here):
            yield u, here


def _one_span(key, room, own, anchors, span) -> np.ndarray:
    """Whether some ``span`` consecutive positions around the anchor hold every
    word of the window, a repeated word as often as it occurs there."""
    need = dict(zip(*np.unique(own, return_counts=True)))
    out = np.zeros(len(anchors), bool)
    for left in range(span):
        low = anchors - left
        ok = ~out
        for l, n in need.items():
            ok &= np.searchsorted(key, l * room + low + span) - np.searchsorted(key, l * room + low) >= n
        out |= ok
    return out


def _pairs(found) -> np.ndarray:
    """Distinct (document number, item number) rows."""
    if not found:
        return np.zeros((0, 2), np.int64)
    flat = np.concatenate([np.stack([d, i], 1) for d, i in found])
    return np.unique(flat, axis=0)


_FOUND = "shard bigint, at int, doc_id bigint, doc_key string, n_words bigint, spans array<array<bigint>>, item_ids array<string>, near_ids array<string>"
_HITS = ("doc_id", "n_words", "n_hit", "item_ids", "near_ids", "doc_key")
# hit words from spans of several parts, which may overlap
_COVERED = """aggregate(array_sort(spans), struct(0L as n, 0L as done),
    (a, s) -> struct(a.n + greatest(0L, s[1] - greatest(s[0], a.done)) as n, greatest(a.done, s[1]) as done), a -> a.n)"""


def _found(index: DataFrame, items: list[tuple[int, list[bytes]]], width: int, slop: int, every: bool) -> DataFrame:
    """``_FOUND`` rows of the documents of the index, or of those with a match only."""
    shared = index.sparkSession.sparkContext.broadcast(items)
    arrow = arrow_schema(_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win = Windows(shared.value, width)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(j)[k].as_py() for j, n in enumerate(batch.schema.names)}
                got = search_shard(win, row, slop)
                n = len(row["doc_ids"])
                names = {"phrase": [[] for _ in range(n)], "near": [[] for _ in range(n)]}
                for kind, per_doc in names.items():
                    for d, i in got[kind]:
                        per_doc[d].append(str(win.items[i]))
                spans = [[] for _ in range(n)]
                for d, a, b in got["spans"].tolist():
                    spans[d].append([a, b])
                out = [
                    (row["shard"], d, None if row["doc_null"][d] else row["doc_ids"][d], row["doc_keys"][d], row["n_words"][d],
                     spans[d], sorted(names["phrase"][d]), sorted(names["near"][d]))
                    for d in range(n) if every or names["near"][d]
                ]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return index.mapInArrow(run, _FOUND)


def search(index: DataFrame, items: list[tuple[int, list[bytes]]], width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``(doc_id, n_words, n_hit, item_ids, near_ids, doc_key)`` per document of the index.

    item_ids: the items with an occurring window, as strings, sorted; near_ids:
    those with a proximity match.
    """
    if sum(len(w) for _, w in items) > MAX_TEST_WORDS:
        raise ValueError(f"a test set of over {MAX_TEST_WORDS} words; search_parts takes it in parts")
    return _found(index, items, width, slop, True).withColumn("n_hit", F.expr(_COVERED)).select(*_HITS)


def search_parts(index: DataFrame, parts: Iterable[list[tuple[int, list[bytes]]]], width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """As ``search``, for a test set in parts; the stored ``index`` holds all words."""
    spark = index.sparkSession
    path = scratch_path(spark, "found")
    for items in parts:
        _found(index, items, width, slop, False).write.mode("append").parquet(path)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    found = (
        spark.read.schema(_FOUND).parquet(path).groupBy("shard", "at")
        .agg(*(union(c) for c in ("spans", "item_ids", "near_ids"))).withColumn("n_hit", F.expr(_COVERED)).drop("spans")
    )
    rows = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "doc_null", "doc_keys", "n_words")).alias("at", "d")).select(
        "shard", "at", F.when(~F.col("d.doc_null"), F.col("d.doc_ids")).alias("doc_id"), F.col("d.doc_keys").alias("doc_key"),
        F.col("d.n_words").alias("n_words"),
    )
    none = F.array().cast("array<string>")
    return rows.join(found, ["shard", "at"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("near_ids", none).alias("near_ids"), "doc_key",
    )


def find_contamination(docs: DataFrame, bench: DataFrame, width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``search`` over a stored index of ``docs``; one row per document row.

    Null and empty texts have no words and no hit; an empty test set hits
    nothing; repeated rows are answered each; extra columns are ignored.
    """
    total, parts = test_parts(bench, width)
    items = next(parts, []) if total <= MAX_TEST_WORDS else None
    built = build_index(docs, None if items is None else {w for _, ws in items for w in ws})
    index = stored(built.withColumn("shard", F.monotonically_increasing_id()), "postings")
    return search_parts(index, parts, width, slop) if items is None else search(index, items, width, slop)


def drop_contaminated(docs: DataFrame, bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit word, whatever their doc_id: a row goes
    by its own text alone (rows that share a hit row's id, null included, stay)."""
    bad = find_contamination(docs, bench, width).where("n_hit > 0").select("doc_key").distinct()
    return docs.join(bad, text_key(docs) == bad["doc_key"], "left_anti")


def op9_decontamination(spark, sf_dir):
    """Hit words and items per document."""
    from ticklake.llm.common import table

    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_ids").cast("bigint").alias("n_near_items"),
    )
