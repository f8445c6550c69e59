"""Phrase collocations through prefix-free parsing (operator 11).

1. Each text becomes a stream of words, with a break token between pieces. Where
   the hash of ``order - 1`` consecutive tokens is 0 modulo ``MODULUS`` (the
   content trigger) a chunk ends and the next begins; a chunk runs on over the
   trigger window, so neighbours overlap by ``order - 1`` tokens and every phrase
   of up to ``order`` words lies inside a chunk. The same passage is cut alike
   wherever it occurs.
2. The distinct chunks with their parse frequencies form the dictionary, the only
   thing that is counted from: a passage in a million documents is one row.
3. Phrases are counted inside the distinct chunks, weighted by frequency. A chunk
   owns the phrases that start before its trailing overlap, so those in an overlap
   count once.
4. Length by length: a phrase of m words reaches the threshold only if both its
   parts of m - 1 words do. Their hashes, in a bit filter of at most ``MOST_BITS``
   bits, keep the rest out of the shuffle; a false positive costs a row, never a
   count, and all counts are exact sums.
5. Cuts, drops and ranks are joins and groupings over the phrases that reach the
   threshold; the ranking takes the best of salted buckets before the best of a
   language.

Defined results: a null lang is ``und``; null, empty and wordless texts hold
nothing; repeated rows count again; texts of any length are parsed whole (a chunk
without a trigger is cut after ``LONGEST`` tokens, again with an overlap); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, partitions_for, stored, table

ORDER = 3
MIN_COUNT = 10
COVER_PERCENT = 50
TOP = 2000
MODULUS = 32
LONGEST = 256
MOST_BITS = 1 << 28
BUCKET_ROWS = 50_000
BUCKETS = 8
STEP = 4096  # chunks added at once
HELD = 16 << 20  # bytes of chunks that a task counts at once
OUT = 1 << 16  # rows of a batch that goes back to Spark

BREAK = b"\n"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9 + b" "
)
_BREAKS = re.compile(rb" *\n[\n ]*")


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, and one break token between pieces."""
    return [t for t in _BREAKS.sub(b" \n ", text.translate(_TABLE)).split(b" ") if t]


def parse(toks: list[bytes], order: int) -> Iterator[tuple[bytes, int]]:
    """``(chunk, owned)``: the chunks of a token stream; each owns the phrases
    that start at its first ``owned`` tokens."""
    n, over = len(toks), order - 1
    h = np.fromiter(map(zlib.crc32, toks), np.uint64, n)
    window = np.zeros(max(0, n - over + 1), np.uint64)
    for k in range(over):
        window = window * np.uint64(0x9E3779B1) + h[k : k + len(window)]
    window ^= window >> np.uint64(29)
    ends = [*np.flatnonzero(window % np.uint64(MODULUS) == 0).tolist(), n] if over else [n]
    at = 0
    for end in ends:
        while at < end:
            stop = min(end, at + LONGEST)
            yield b" ".join(toks[at : stop + over]), stop - at
            at = stop


def dictionary(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, chunk, owned, freq)``: distinct chunks of ``docs`` (lang, text)."""
    schema = arrow_schema("lang string, chunk string, owned int")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                langs, chunks, owned = [], [], []
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for chunk, own in parse(tokens(text), order):
                        langs.append(lang)
                        chunks.append(chunk)
                        owned.append(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(owned, pa.int32())],
                    schema=schema,
                )

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    chunks = texts.where("text is not null").mapInArrow(run, "lang string, chunk string, owned int")
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count("*").alias("freq"))


def _hashes(tokens: list[bytes]) -> np.ndarray:
    """Token hashes for the filters: 0 for a break, odd for words."""
    objects = np.fromiter(tokens, object, len(tokens))
    return np.where(objects == BREAK, np.uint64(0), pd.util.hash_array(objects, categorize=False) | np.uint64(1))


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of runs of tokens, from the hashes of their first, second, … tokens."""
    out = parts[0]
    for h in parts[1:]:
        out = out * np.uint64(0x9E3779B97F4A7C15) + h
        out ^= out >> np.uint64(29)
    return out


def _set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bit_filter(grams: DataFrame, words: int, how_many: int) -> bytes:
    """Bit array with the hash of every gram of ``words`` words set: 16 bits a gram,
    ``MOST_BITS`` at most. Built in Spark; what reaches the driver is the array."""
    bits = min(MOST_BITS, max(1 << 16, 1 << (16 * how_many).bit_length()))

    def places(batches):
        for batch in batches:
            toks = b" ".join(batch.column(0).to_pylist()).split(b" ") if batch.num_rows else []
            h = _hashes(toks)
            at = _mixed([h[k::words] for k in range(words)]) & np.uint64(bits - 1)
            one = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(one)], names=["word", "set"])

    found = (
        grams.select(F.col("gram").cast("binary")).mapInArrow(places, "word long, set long")
        .groupBy("word").agg(F.bit_or("set").alias("set")).toArrow()
    )
    array = np.zeros(bits // 64, "<i8")
    array[found.column("word").to_numpy()] = found.column("set").to_numpy()
    return array.tobytes()


def _distinct(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each value among the distinct ones, and these."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``HELD`` bytes: words that recur are numbered once in each."""
    some, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            some.append(batch.slice(at, STEP))
            size += some[-1].nbytes
            if size > HELD:
                yield pa.concat_batches(some)
                some, size = [], 0
    if some:
        yield pa.concat_batches(some)


def owned_grams(code: np.ndarray, lens: np.ndarray, owned: np.ndarray, words: int, hashes: np.ndarray, filters: list[np.ndarray]):
    """Places of the grams that start at a token their chunk owns and whose parts all
    pass the filters; none spans a break. Tokens come as places (``code``) in the
    distinct ones' ``hashes``, chunks as their ``lens``."""
    ends = np.cumsum(lens)
    place = np.arange(len(code)) - np.repeat(ends - lens, lens)
    alive = (hashes != 0) & _set(filters[0], hashes) if filters else hashes != 0
    alive = alive[code]
    start = alive & (place < np.repeat(owned, lens))
    left = np.repeat(ends, lens) - np.arange(len(code))  # tokens of the chunk from here on
    at = np.flatnonzero(start & (left >= words))
    for k in range(1, words):
        at = at[alive[at + k]]
    for m in range(2, words):
        for k in range(words - m + 1):
            at = at[_set(filters[m - 1], _mixed([hashes[code[at + k + i]] for i in range(m)]))]
    return at


def gram_counts(chunks: DataFrame, words: int, filters: list) -> DataFrame:
    """``(lang, gram, f)``: occurrences of the grams of ``words`` words that pass the
    filters (broadcast bit arrays of the grams of 1, 2, … words).

    A task counts grams as numbers of its distinct words; only distinct grams become
    strings."""
    schema = arrow_schema("lang string, gram string, f long")

    def run(batches):
        arrays = [np.frombuffer(f.value, np.uint8) for f in filters]
        for batch in _held(batches):
            tokens = pc.split_pattern(batch.column(1), pattern=b" ")
            lens = pc.list_value_length(tokens).to_numpy().astype(np.int64)
            code, distinct = _distinct(tokens.flatten())
            lang, langs = _distinct(batch.column(0))
            at = owned_grams(code, lens, batch.column(2).to_numpy(), words, _hashes(distinct.to_pylist()), arrays)
            of = np.repeat(np.arange(len(lens)), lens)[at]
            key, size = lang[of].astype(np.int64), len(langs)
            for k in range(words):
                if size * len(distinct) >= 1 << 62:  # too large for a number: only those that occur
                    key, found = pd.factorize(key)
                    size = len(found)
                key, size = key * len(distinct) + code[at + k], size * len(distinct)
            gram, found = pd.factorize(key)
            counts, first = np.zeros(len(found), np.int64), np.empty(len(found), np.int64)
            np.add.at(counts, gram, batch.column(3).to_numpy()[of])
            first[gram] = np.arange(len(gram))  # one occurrence of each
            for i in range(0, len(first), OUT):
                one = first[i : i + OUT]
                parts = [distinct.take(pa.array(code[at[one] + k])) for k in range(words)]
                grams = pc.binary_join_element_wise(*parts, b" ").cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang[of[one]])), grams, pa.array(counts[i : i + OUT])], schema=schema)

    rows = chunks.select("lang", F.col("chunk").cast("binary"), "owned", "freq")
    return (
        rows.mapInArrow(run, "lang string, gram string, f long")
        .groupBy("lang", "gram").agg(F.sum("f").alias("f"))
    )


def _cuts(grams: DataFrame) -> DataFrame:
    """Each candidate at each cut: its first ``k`` words and the rest."""
    w = F.split("gram", " ")
    at = grams.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(w) - 1)))
    return at.select(
        "lang", "gram", F.col("f").alias("a"), "k",
        F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(w, F.col("k") + 1, F.size(w)), " ").alias("rest"),
    )


def _inside(grams: DataFrame) -> DataFrame:
    """``(lang, gram, longest)``: shorter phrases inside the candidates, with the
    largest count of a candidate around them."""
    w = F.split("gram", " ")
    many = grams.withColumn("m", F.explode(F.expr("filter(sequence(2, size(split(gram, ' '))), m -> m < size(split(gram, ' ')))")))
    at = many.withColumn("i", F.explode(F.sequence(F.lit(1), F.size(w) - F.col("m") + 1)))
    part = F.array_join(F.slice(w, F.col("i"), F.col("m")), " ")
    return at.groupBy("lang", part.alias("gram")).agg(F.max("f").alias("around"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a² / (l r)) in exact decimals."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide[0] * wide[0], wide[1] * wide[2])


def collocations(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, cover: int = COVER_PERCENT, top: int = TOP
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of 2 to
    ``order`` words of each language.

    ``a``, ``l``, ``r``: occurrences of the phrase and of its two parts at the cut of
    the lowest score (ties: the shortest first part); ``n``: words of the language.
    Phrases inside a longer candidate of at least ``cover`` percent of their count
    are left out. By score, count, then phrase in byte order.
    """
    sc = docs.sparkSession.sparkContext
    chunks = stored(dictionary(docs, order), "chunks")
    words = stored(gram_counts(chunks, 1, []), "words")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    levels, filters = [words.where(F.col("f") >= min_count)], []
    for m in range(2, order + 1):
        filters.append(sc.broadcast(bit_filter(levels[-1], m - 1, levels[-1].count())))
        levels.append(stored(gram_counts(chunks, m, filters).where(F.col("f") >= min_count), f"grams{m}"))
    candidates = reduce(DataFrame.union, levels[1:])
    parts = reduce(DataFrame.union, levels[:-1])
    part = lambda of, as_: parts.select("lang", F.col("gram").alias(of), F.col("f").alias(as_))
    scored = (
        _cuts(candidates).join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"])
        .withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    covered = F.coalesce(F.col("around") * 100 >= F.col("a") * cover, F.lit(False))
    left = stored(
        scored.join(_inside(candidates), ["lang", "gram"], "left").where(~covered)
        .select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"),
        "scored",
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    buckets = partitions_for(left.count(), BUCKET_ROWS, BUCKETS)
    salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    heads = _first(salted, ["lang", "salt"], best, top).drop("salt")
    return _first(heads, ["lang"], best, top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _first(rows: DataFrame, by: list[str], order: list[Column], top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    return rows.withColumn("rank", rank).where(F.col("rank") <= top)


def op11_prefix_free_phrases(spark, sf_dir):
    """The collocations of every language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), worded as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
), grams as (
  select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) as gram
  from worded, (select unnest([1, 2, 3]) as m)
), counts as (
  select lang, m, gram, count(*) as f from grams group by all
), total as (
  select lang, sum(f) as n from counts where m = 1 group by lang
), candidates as (
  select lang, m, gram, f, string_split(gram, ' ') as w from counts where m > 1 and f >= {MIN_COUNT}
), cuts as (
  select lang, m, gram, f, k, array_to_string(w[1 : k], ' ') as head, array_to_string(w[k + 1 : m], ' ') as rest
  from candidates, (select unnest([1, 2]) as k) where k < m
), valued as (
  select c.lang, c.m, c.gram, c.f as a, c.k, l.f as l, r.f as r, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score
  from cuts c join counts l on l.lang = c.lang and l.gram = c.head join counts r on r.lang = c.lang and r.gram = c.rest
), lowest as (
  select * from valued qualify row_number() over (partition by lang, gram order by score, k) = 1
), inside as (
  select lang, array_to_string(w[i : i + 1], ' ') as gram, max(f) as around
  from candidates, (select unnest([1, 2]) as i) where m = 3 group by all
)
select s.lang, rank, phrase, a, l, r, n::bigint as n, score
from (
  select c.lang, row_number() over (partition by c.lang order by score desc, a desc, encode(c.gram)) as rank,
    c.gram as phrase, a, l, r, score::bigint as score
  from lowest c left join inside i on i.lang = c.lang and i.gram = c.gram and c.m = 2
  where i.around is null or 100 * i.around < {COVER_PERCENT} * a
) s join total t on t.lang = s.lang
where rank <= {TOP}
"""
