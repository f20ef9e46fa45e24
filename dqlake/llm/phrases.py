"""Phrase collocation mining with exact counts, by Toivonen's sampling method.

A sample of the documents proposes the phrases that are probably frequent. A pass over everything then counts the proposed phrases
and their negative border: the phrases that were not proposed although what is left of them without the last and without the first
word was. Together these are all phrases with both such parts proposed, so a task decides by itself what to count.

The proposed phrases are counted by their texts, which makes their numbers exact, and each task adds up its own first. The border is
counted by 64-bit keys, as nearly all of it is rare and its texts are never needed. Two phrases that share a key can only make a rare
one look frequent.

A border phrase that turns out frequent was missed by the sample. Every part of a frequent phrase is frequent, so all that is missed
holds such a border phrase. If there is one, a second pass counts the keys of all phrases around those, and a third one the texts of
what that and the border found. Then all frequent phrases have been counted by their texts.

Sets of phrases travel as bitmaps of a fixed size with two bits a phrase (Bloom filters), whatever their number. Bits that are set
by chance only make tasks count more phrases than they must.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dqlake.llm.common import release, stage, table

BITS = 26  # the bitmap has two to the power of this many bits: 8 MB
SAMPLE = 4  # one document in so many proposes
CHUNK = 700_000  # words that a task counts at a time
HELD = 500_000  # phrases whose texts and counts a task holds, over its chunks
SLICE = 250_000  # bytes of text that are split at a time, up to the end of a piece
COUNTED = "lang string, k int, phrase string, f long"
KEYS = "k int, key long, f long"
BOTH = "said struct<lang string, k int, phrase string>, key long, f long"
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")


class Ids(dict):
    """Consecutive numbers for words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def slices(data: bytes) -> Iterator[bytes]:
    """Stretches of whole pieces of about ``SLICE`` bytes."""
    at = 0
    while len(data) - at > SLICE:
        end = data.rfind(b"\n", at, at + SLICE)
        if end < 0:
            end = data.find(b"\n", at + SLICE)
        if end < 0:
            break
        yield data[at:end + 1]
        at = end + 1
    yield data[at:]


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number, modulo 2 to the 64, and of its inverse."""
    base = 0x9E3779B97F4A7C15
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, dtype=np.uint64)], dtype=np.uint64) for b in (base, pow(base, -1, 2**64)))


@lru_cache(1)
def byte_values() -> np.ndarray:
    return np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)


def words_in(data: bytes, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a folded text (blanks are spaces, ends of pieces are line feeds): their keys, the number of each one's piece,
    where it starts and where it stops.

    A key is a polynomial in the word's bytes, a difference of two running sums, mixed with the language.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = raw == 10
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ~ends & (raw != 32)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edges[::2], edges[1::2]
    up, down = powers(1 << max(SLICE.bit_length(), len(raw).bit_length()))
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(byte_values()[raw] * up[:len(raw)], out=total[1:])
    keys = (total[stop] - total[start]) * down[start] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 42))
    keys = (keys ^ (keys >> np.uint64(32))) * MIX2
    return keys ^ (keys >> np.uint64(29)), np.cumsum(ends, dtype=np.int64)[start], start, stop


class Chunk:
    """Words of one language: their keys, the number of the piece each stands in and, if wanted, their numbers among distinct ones
    (``ids``) or where they stand in the folded text (``spans``)."""

    def __init__(self, lang: str, more: str = "") -> None:
        self.lang, self.more, self.size, self.last, self.length = lang, more, 0, 0, 0
        self.ids, self.words, self.keys, self.pieces, self.data, self.spans = Ids(), [], [], [], [], []

    def add(self, data: bytes) -> None:
        keys, piece, start, stop = words_in(data, self.lang)
        if not len(keys):
            return
        piece += self.last + 1
        self.last = int(piece[-1])
        self.keys.append(keys)
        self.pieces.append(piece)
        self.size += len(keys)
        if self.more == "ids":
            self.words.append(np.fromiter(map(self.ids.__getitem__, data.split()), dtype=np.int64, count=len(keys)))
        elif self.more == "spans":
            self.spans.append(np.stack([start, stop]) + self.length)
            self.data.append(data)
            self.length += len(data)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """The keys, and whether each word and the next one stand in one piece. The chunk gives them up."""
        keys, pieces = np.concatenate(self.keys), np.concatenate(self.pieces)
        self.keys, self.pieces = [], []
        return keys, pieces[:-1] == pieces[1:]


def counts_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each stands there; ``keys`` is sorted in place."""
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], np.diff(first, append=len(keys))


def member(bits: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of each key are set."""
    if bits is None:
        return np.zeros(len(keys), dtype=bool)
    mask = np.uint64(8 * len(bits) - 1)
    out = np.ones(len(keys), dtype=bool)
    for i in range(0, len(keys), 65_536):  # what it takes halfway stays small
        some = keys[i:i + 65_536]
        for place in (some & mask, some >> np.uint64(32) & mask):
            out[i:i + 65_536] &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def longer(keys: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The keys of phrases with one more word."""
    out = (keys * MIX1 ^ last) * MIX2
    return out ^ (out >> np.uint64(29))


def keys_of(chunk: Chunk, known: np.ndarray | None, before: np.ndarray | None, shortest: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, keys, counts) of a chunk: all words, and longer phrases with both parts in ``known``, if they were not counted when
    the set was ``before``. With ``before``, parts that were not counted then do for longer ones too."""
    single, joined = chunk.taken()
    if shortest <= 1:
        yield 1, *counts_of(single.copy())
    keys = single
    new, old = member(known, single), member(before, single)
    for k in range(2, longest + 1):
        counted, earlier = new[:-1] & new[1:] & joined[:len(new) - 1], old[:-1] & old[1:]
        keys = longer(keys[:-1], single[k - 1:])
        if not counted.any():
            return
        if k >= shortest:
            yield k, *counts_of(keys[counted & ~earlier])
        if k < longest:
            new, old, at = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool), np.flatnonzero(counted)
            new[at], old[at] = member(known, keys[at]), earlier[at] & member(before, keys[at])
            if before is not None:
                new[at] |= ~earlier[at]


def texts_of(chunk: Chunk, wanted: np.ndarray, longest: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """(length, phrases, counts, keys) of a chunk, for the phrases in ``wanted`` whose parts are in it too, told apart by their words.

    The keys are those of their border, once an occurrence. Length 0 counts all words.
    """
    words, texts = np.concatenate(chunk.words), list(chunk.ids)
    chunk.words, chunk.ids = [], Ids()
    single, joined = chunk.taken()
    yield 0, [b""], np.array([len(words)]), single[:0]
    fits = member(wanted, single)
    name = np.where(fits, words, -1)  # number of the phrase that starts here, or -1
    counts = np.bincount(words[fits], minlength=1)
    some = np.flatnonzero(counts)
    yield 1, [texts[i] for i in some.tolist()], counts[some], single[~fits]
    keys, spelled = single, texts
    for k in range(2, longest + 1):
        fits = (name[:-1] >= 0) & (name[1:] >= 0)
        if k == 2:
            fits &= joined
        keys = longer(keys[:-1], single[k - 1:])
        at = np.flatnonzero(fits)
        inside = member(wanted, keys[at])
        at, border = at[inside], keys[at[~inside]]
        found, inverse, counts = np.unique(name[at] * len(texts) + words[at + k - 1], return_inverse=True, return_counts=True)
        spelled = [spelled[a] + b" " + texts[b] for a, b in zip((found // len(texts)).tolist(), (found % len(texts)).tolist())]
        yield k, spelled, counts, border
        if not len(at):
            return
        name = np.full(len(fits), -1, dtype=np.int64)
        name[at] = inverse


def missed_of(chunk: Chunk, wanted: np.ndarray, done: np.ndarray | None, longest: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(length, phrases, counts) of a chunk, for the phrases in ``wanted`` whose parts are in it too, unless they and their parts are
    in ``done``. Their texts are cut out one by one, as most are expected in ``done``."""
    single, joined = chunk.taken()
    data, (start, stop) = b"".join(chunk.data), np.concatenate(chunk.spans, axis=1)
    chunk.data, chunk.spans = [], []
    keys, new, old = single, member(wanted, single), member(done, single)
    for k in range(1, longest + 1):
        if k > 1:
            at, earlier = np.flatnonzero(new[:-1] & new[1:] & joined[:len(new) - 1]), old[:-1] & old[1:]
            if not len(at):
                return
            keys = longer(keys[:-1], single[k - 1:])
            new, old = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
            new[at], old[at] = member(wanted, keys[at]), earlier[at] & member(done, keys[at])
        fresh = np.flatnonzero(new & ~old)
        counts = Counter(b" ".join(data[a:b].split()) for a, b in zip(start[fresh].tolist(), stop[fresh + k - 1].tolist()))
        yield k, list(counts), np.fromiter(counts.values(), dtype=np.int64, count=len(counts))


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(language, folded texts) of a batch, about ``SLICE`` bytes at a time: a batch may hold very long texts, it is not copied whole."""
    alike: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
        data = text.as_buffer().to_pybytes()
        alike.setdefault(lang, []).append(data)
        sizes[lang] = sizes.get(lang, 0) + len(data)
        if sizes[lang] >= SLICE:
            del sizes[lang]
            yield lang, b"\n".join(alike.pop(lang)).translate(FOLD)
    for lang, some in alike.items():
        yield lang, b"\n".join(some).translate(FOLD)


def chunks(batches: Iterator[pa.RecordBatch], more: str = "") -> Iterator[Chunk]:
    """The words of (lang, text), by language, about ``CHUNK`` at a time."""
    held, size = {}, 0
    for batch in batches:
        for lang, data in stretches(batch):
            for part in slices(data):
                chunk = held.get(lang) or held.setdefault(lang, Chunk(lang, more))
                size -= chunk.size
                chunk.add(part)
                size += chunk.size
                if not chunk.size:
                    del held[lang]
                if size >= CHUNK:
                    yield from held.values()
                    held, size = {}, 0
    yield from held.values()


def key_rows(k: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(k, key, f)."""
    for i in range(0, len(keys), 100_000):
        part = keys[i:i + 100_000].view(np.int64)
        columns = [np.full(len(part), k, dtype=np.int32), part, counts[i:i + len(part)].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "key", "f"])


def count_keys(docs: DataFrame, known: bytes, before: bytes | None, shortest: int, longest: int) -> DataFrame:
    """(k, key, f) over all of ``docs`` (lang, text)."""
    sent = docs.sparkSession.sparkContext.broadcast((known, before))  # two bitmaps of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [None if b is None else np.frombuffer(b, dtype=np.uint8) for b in sent.value]
        for chunk in chunks(batches):
            for k, keys, counts in keys_of(chunk, *bits, shortest, longest):
                yield from key_rows(k, keys, counts)

    return docs.mapInArrow(run, KEYS).groupBy("k", "key").agg(F.sum("f").alias("f"))


class Held:
    """Texts and counts of phrases that a task has not passed on yet: a phrase leaves once a task, or once in ``HELD`` distinct ones."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, int], dict[bytes, int]] = {}
        self.size = 0

    def add(self, lang: str, k: int, phrases: list[bytes], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take them in; returned is what had to leave before."""
        if self.size + len(phrases) > HELD:
            yield from self.left()
        known = self.counts.setdefault((lang, k), {})
        self.size -= len(known)
        for phrase, n in zip(phrases, counts.tolist()):
            known[phrase] = known.get(phrase, 0) + n
        self.size += len(known)

    def left(self) -> Iterator[pa.RecordBatch]:
        """(lang, k, phrase, f) of all, which are given up."""
        self.size = 0
        while self.counts:
            (lang, k), known = self.counts.popitem()
            phrases, counts = list(known), np.fromiter(known.values(), dtype=np.int64, count=len(known))
            del known
            for i in range(0, len(phrases), 50_000):
                part = pa.array(phrases[i:i + 50_000], pa.binary()).cast(pa.string())
                n = len(part)
                columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, k, dtype=np.int32)), part, pa.array(counts[i:i + n])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "k", "phrase", "f"])


def count_texts(docs: DataFrame, wanted: bytes, longest: int, done: bytes | None = None) -> DataFrame:
    """(lang, k, phrase, f) over all of ``docs`` (lang, text) of what is in ``wanted`` and not in ``done``; without ``done``, k = 0
    counts all words."""
    spark = docs.sparkSession.sparkContext
    sent, left_out = spark.broadcast(wanted), None if done is None else spark.broadcast(done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [None if b is None else np.frombuffer(b.value, dtype=np.uint8) for b in (sent, left_out)]
        held = Held()
        for chunk in chunks(batches, "spans"):
            if left_out is None:
                yield from held.add(chunk.lang, 0, [b""], np.array([chunk.size]))
            for k, phrases, counts in missed_of(chunk, *bits, longest):
                yield from held.add(chunk.lang, k, phrases, counts)
        yield from held.left()

    return docs.mapInArrow(run, COUNTED).groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))


def said(rows: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, k, phrase, f) as rows of ``BOTH`` without a key."""
    phrases = pa.StructArray.from_arrays([rows["lang"], rows["k"], rows["phrase"]], names=["lang", "k", "phrase"])
    return pa.RecordBatch.from_arrays([phrases, pa.nulls(len(phrases), pa.int64()), rows["f"]], names=["said", "key", "f"])


def unsaid(rows: pa.RecordBatch) -> pa.RecordBatch:
    """(k, key, f) as rows of ``BOTH`` without a phrase."""
    none = pa.nulls(rows.num_rows, pa.struct([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string())]))
    return pa.RecordBatch.from_arrays([none, rows["key"], rows["f"]], names=["said", "key", "f"])


def count_proposed(docs: DataFrame, known: bytes, longest: int) -> DataFrame:
    """(said (lang, k, phrase), key, f) over all of ``docs`` (lang, text): the phrases in ``known`` by their texts, without a key, and
    their border by keys alone; k = 0 counts all words."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held = np.frombuffer(sent.value, dtype=np.uint8), Held()
        for chunk in chunks(batches, "ids"):
            for k, phrases, counts, border in texts_of(chunk, bits, longest):
                yield from map(said, held.add(chunk.lang, k, phrases, counts))
                yield from map(unsaid, key_rows(k, *counts_of(border)))
        yield from map(said, held.left())

    return docs.mapInArrow(run, BOTH).groupBy("said", "key").agg(F.sum("f").alias("f"))


def bitmap(keys: DataFrame, bits: int, earlier: bytes | None = None) -> bytes:
    """The bitmap of (key), with the bits of ``earlier``. It has a fixed size and is made of pieces of 4 KB on the executors."""
    places = F.array(F.col("key").bitwiseAND(2**bits - 1), F.shiftrightunsigned("key", 32).bitwiseAND(2**bits - 1))
    at = keys.select(F.explode(places).alias("at")).select((F.col("at") + 1).alias("at"))  # Spark numbers bits from 1
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(2**bits // 8, dtype=np.uint8)
    for row in parts.collect():  # at most 2 ** bits / 8 bytes
        piece = np.frombuffer(row["bits"], dtype=np.uint8)[:len(out)]
        out[(row["part"] - 1) * 4096:][:len(piece)] = piece
    if earlier is not None:
        out |= np.frombuffer(earlier, dtype=np.uint8)
    return out.tobytes()


def frequent_phrases(docs: DataFrame, min_count: int, longest: int, sample: int = SAMPLE, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, f) of all phrases with f >= min_count, (lang, n)) of ``docs`` (lang, text)."""
    fewer = max(2, 4 * min_count // (10 * sample))  # wanted in the sample: well below the share that is expected there
    # Row by row: copies of a text are drawn independently, or a phrase of one large group of copies would be missed.
    drawn = stage(docs.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(sample)) == 0), "phrases-sample")
    proposed = bytes(2**bits // 8)
    for k in range(1, longest + 1):
        likely = stage(count_keys(drawn, proposed, None, k, k).filter((F.col("k") == k) & (F.col("f") >= fewer)).select("key"), "phrases-proposed")
        proposed = bitmap(likely, bits, proposed)
        release(likely)
    release(drawn)
    enough = F.col("f") >= min_count
    counted = stage(count_proposed(docs, proposed, longest).filter(enough | (F.col("said.k") == 0)), "phrases-counted")
    texts, known = counted.filter("key is null").select("said.*", "f"), bitmap(counted.filter("key is not null"), bits, proposed)
    if known != proposed:
        found = stage(count_keys(docs, known, proposed, 2, longest).filter(enough).select("key"), "phrases-found")
        wanted = bitmap(found, bits, known)
        release(found)
        texts = texts.unionByName(stage(count_texts(docs, wanted, longest, proposed).filter(enough), "phrases-missed"))
    return texts.filter((F.col("k") > 0) & enough), texts.filter("k = 0").select("lang", F.col("f").alias("n"))


def words_of(phrase: Column) -> Column:
    return F.split(phrase, " ", -1)


def part(phrase: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words_of(phrase), start, length), " ")


def collocations(
    docs: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000, covered: int = 100, sample: int = SAMPLE, bits: int = BITS,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language whose words stand together most beyond chance.

    Words are what blanks and the signs ``.,;:!?`` leave, A-Z in lower case; phrases do not cross signs or line breaks. ``a`` counts
    the phrase, ``l`` and ``r`` its two parts at its worst cut, ``n`` all words of the language. A phrase inside a longer one that
    occurs at least ``covered`` percent as often is left out. Null texts are empty, a null language is ``und``. Repeated rows count
    as often as they stand. Texts without words add nothing; an empty table gives an empty table. Other columns are ignored.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found, totals = frequent_phrases(texts, min_count, longest, sample, bits)
    candidates = found.filter("k >= 2")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("*", part(F.col("phrase"), F.lit(1), F.col("cut")).alias("head"), part(F.col("phrase"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("_over", 1000 * whole("f") * whole("n")).withColumn("_under", whole("l") * whole("r"))
    cuts = cuts.withColumn("score", F.expr("_over div _under"))
    worst = cuts.groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    starts = F.sequence(F.lit(1), F.col("k") - F.col("length") + 1)
    inside = (
        found.filter("k >= 3").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("k") - 1))).withColumn("start", F.explode(starts))
        .groupBy("lang", part(F.col("phrase"), F.col("start"), F.col("length")).alias("phrase")).agg(F.max("f").alias("longer"))
    )
    kept = worst.join(inside, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    rows = kept.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranks = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranks.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def sql(min_count: int, top: int) -> str:
    """DuckDB: the same, by counting every phrase of up to five words."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS k FROM pieces WHERE len(w) > 0) WHERE k <= len(w))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {min_count}),
n AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
cuts AS (SELECT lang, phrase, f, cut, array_to_string(list_slice(w, 1, cut), ' ') AS head, array_to_string(list_slice(w, cut + 1, k), ' ') AS tail FROM (
  SELECT lang, phrase, f, k, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1)),
scores AS (SELECT c.lang, c.phrase, c.f AS a, a.f AS l, b.f AS r, n.n,
    (1000::HUGEINT * c.f * n.n) // (a.f::HUGEINT * b.f) AS score, row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000::HUGEINT * c.f * n.n) // (a.f::HUGEINT * b.f), cut) AS worst
  FROM cuts c JOIN f a ON a.lang = c.lang AND a.phrase = c.head JOIN f b ON b.lang = c.lang AND b.phrase = c.tail JOIN n ON n.lang = c.lang),
inside AS (SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(f) AS longer FROM (
  SELECT lang, w, f, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, f, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM f WHERE k > 2)) GROUP BY ALL),
kept AS (SELECT s.* FROM scores s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE worst = 1 AND coalesce(100 * longer < 100 * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}"""


SQL = sql(100, 2000)
