"""Phrase collocations, mined with a sample and its negative border (Toivonen).

1. A sample of pieces (a documented share, by hash) is counted whole; phrases
   that reach a lowered count in it are proposed.  They are kept as a filter
   of a fixed number of bits, which only ever errs by proposing more.
2. A full pass counts exactly every proposed phrase and the negative border:
   the phrases whose two shorter parts (without the last, without the first
   word) are proposed while they are not.  The border is not listed: a place
   of the text belongs to a counted phrase if both parts are in the filter.
3. Frequent border phrases are failures of the sample.  A further pass then
   counts what they may have hidden: the phrases not counted so far whose
   parts are all frequent or, not being counted either, may be.  It follows
   all lengths at once, so that no frequent phrase is left uncounted behind
   it: the frequent phrases are closed.

Counts are summed in the tasks, by dictionary codes, and then by phrase.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_in, small_or_shuffled, stage
from .words import Words, byte_kinds, joined, split_words

#: Bytes of text counted at a time, and counted phrases that leave a task at a time.
SLICE_BYTES, ROWS = 4 << 20, 1 << 16
#: Share of the pieces in the sample, and of the expected count that proposes a phrase there.
SAMPLE, LOWERED = 1 / 8, 0.35
#: The filter of proposed phrases has 2**FILTER_BITS bits (16 MB), whatever they are.
FILTER_BITS = 27
#: A broadcast of phrases and counts holds at most this many rows, of some 50 bytes each.
BROADCAST_ROWS = 400_000

#: Blanks part words; breaks part the pieces that phrases do not cross.
BLANKS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
KINDS = byte_kinds(BLANKS, BREAKS)

_COUNTED = "lang string, n_words int, phrase string, n long"


# ---- phrases of a slice ----------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _longer(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of phrases with one more word each."""
    return _mix(first * np.uint64(0x9E3779B97F4A7C15) + word)


class Slice:
    """The words of one language's texts in a slice."""

    def __init__(self, lang: str, texts: pa.Array):
        self.lang = lang
        self.words: Words = split_words(texts, KINDS, lower=True)
        w = self.words
        text = w.text_of()
        #: Do word i and the one behind it stand in one piece?
        self.joined = (np.diff(w.piece) == 0) & (np.diff(text) == 0)
        self.text = text

    def hashes(self) -> np.ndarray:
        """The hash of each word, its language's included."""
        seed = xxhash.xxh32_intdigest(self.lang.encode())
        own = np.array([xxhash.xxh64_intdigest(x, seed) for x in self.words.dictionary.to_pylist()], np.uint64)
        return own[self.words.code] if len(own) else np.zeros(0, np.uint64)

    def fits(self, n: int) -> np.ndarray:
        """Is there a phrase of n words from each place on?  (A place has as many as fit.)"""
        if n == 1:
            return np.ones(len(self.words.code), bool)
        shorter = self.fits(n - 1)
        return shorter[:-1] & self.joined[n - 2:] if len(shorter) else shorter

    def counts(self, n: int, places: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first places, counts, names) of the phrases of n words at ``places``.

        ``names`` tells the phrases of n - 1 words at all places apart; the
        new ones tell those of n words apart at ``places`` (elsewhere -1)."""
        keys = names[places] * max(len(self.words.dictionary), 1) + self.words.code[places + n - 1]
        _, first, own, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        out = np.full(len(self.words.code), -1)
        out[places] = own
        return places[first], count, out

    def rows(self, n: int, first: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counted phrases as rows."""
        for k in range(0, len(first), ROWS):
            at = first[k:k + ROWS]
            code = self.words.code[at[:, None] + np.arange(n)].reshape(-1)
            phrase = joined(self.words.dictionary.take(pa.array(code)), np.full(len(at), n))
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(self.lang, pa.string()), len(at)), pa.array(np.full(len(at), n, np.int32)),
                phrase.cast(pa.large_string()).cast(pa.string()), pa.array(count[k:k + ROWS].astype(np.int64))],
                ["lang", "n_words", "phrase", "n"])


def _slices(batches: Iterator[pa.RecordBatch], extra: str | None = None) -> Iterator[tuple[Slice, np.ndarray | None]]:
    """The texts of a partition, some megabytes and one language at a time."""
    for batch in batches:
        for part in rows_in(batch, SLICE_BYTES):
            lang = part.column("lang").dictionary_encode()
            codes = lang.indices.to_numpy(zero_copy_only=False)
            for k, name in enumerate(lang.dictionary.to_pylist()):
                own = pa.array(np.flatnonzero(codes == k))
                yield Slice(name, part.column("text").take(own)), \
                    None if extra is None else part.column(extra).take(own).to_numpy()


# ---- the filter -------------------------------------------------------------

def _positions(h: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return [(h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)]


def _member(flags: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter?"""
    out = np.ones(len(h), bool)
    for p in _positions(h, (8 * len(flags)).bit_length() - 1):
        out &= (flags[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return out


def build_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter (2**bits bits, at most 32) of a column ``h`` of hashes.

    Bits are set by an aggregate of bitmaps of 4 KB; the driver sees these
    2**(bits - 15) bitmaps at most, whatever the number of hashes."""
    mask = (1 << bits) - 1
    at = hashes.select(F.explode(F.array(F.col("h").bitwiseAND(F.lit(mask)),
                                         F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(mask)))).alias("p"))
    maps = at.groupBy(F.bitmap_bucket_number(F.col("p") + 1).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("m"))
    flags = np.zeros(1 << max(bits - 3, 12), np.uint8)
    for b, m in maps.collect():
        flags[(b - 1) * 4096:b * 4096] = np.frombuffer(m, np.uint8)
    return flags[:1 << (bits - 3)]


# ---- passes -----------------------------------------------------------------

def _sample(longest: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, key in _slices(batches, "h"):
            words = own.words
            if not len(words.code):
                continue
            begin = words.first[own.text]
            nth = (words.piece - words.piece[begin]).astype(np.uint64)  # a piece's number in its text
            taken = _mix(_mix(key.view(np.uint64)[own.text]) + nth) <= np.uint64(min(int(share * 2**64), 2**64 - 1))
            h = word = own.hashes()
            found = []
            for n in range(1, longest + 1):
                if n > 1:
                    h = _longer(h[:-1], word[n - 1:])
                found.append(h[own.fits(n) & taken[:len(h)]])
            h, count = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(count.astype(np.int64))], ["h", "n"])
    return run


def _count(longest: int, proposed, frequent=None):
    """Counts of a full pass; with ``frequent``, of the pass that follows failures.

    ``proposed`` and ``frequent`` are broadcast filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(proposed.value, np.uint8)
        often = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        for own, _ in _slices(batches):
            n_all = len(own.words.code)
            if not n_all:
                continue
            h = word = own.hashes()
            names = own.words.code.astype(np.int64)
            if often is None:
                total = np.bincount(names)
                yield pa.RecordBatch.from_arrays([pa.array([own.lang]), pa.array([0], pa.int32()), pa.array([""]),
                                                  pa.array([n_all])], ["lang", "n_words", "phrase", "n"])
                first = np.empty(len(total), np.int64)
                first[names[::-1]] = np.arange(n_all)[::-1]
                yield from own.rows(1, first, total)
            inside = _member(known, h)  # proposed
            may = inside if often is None else _member(often, h)  # may be frequent
            for n in range(2, longest + 1):
                if len(h) < 2:
                    break
                h = _longer(h[:-1], word[n - 1:])
                fits = own.fits(n)
                counted = fits & inside[:-1] & inside[1:]  # by the full pass
                now = counted if often is None else fits & may[:-1] & may[1:] & ~counted
                inside = counted.copy()
                inside[counted] = _member(known, h[counted])
                if often is None:
                    may = inside
                else:
                    may = now.copy()
                    may[counted] = _member(often, h[counted])
                open_ = now if often is None else now | may
                places = np.flatnonzero(open_)
                if not len(places):
                    break
                first, count, names = own.counts(n, places, names)
                if often is not None:  # phrases that only lead on are not counted again
                    new = now[first]
                    first, count = first[new], count[new]
                yield from own.rows(n, first, count)
    return run


def _hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each (lang, phrase), as in ``Slice.hashes``."""
    for batch in batches:
        seeds: dict[str, int] = {}
        out = np.zeros(batch.num_rows, np.uint64)
        with np.errstate(over="ignore"):
            for k, (lang, phrase) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())):
                seed = seeds.setdefault(lang, xxhash.xxh32_intdigest(lang.encode()))
                h = None
                for x in phrase.encode().split(b" "):
                    own = np.array([xxhash.xxh64_intdigest(x, seed)], np.uint64)
                    h = own if h is None else _longer(h, own)
                out[k] = h[0]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("phrase"), pa.array(out.view(np.int64))],
                                         ["lang", "phrase", "h"])


def frequent_phrases(docs: DataFrame, id_col: str, lang_col: str, text_col: str, least: int = 100, longest: int = 5,
                     share: float = SAMPLE, lowered: float = LOWERED, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, n_words, phrase, n): every phrase of 1 to ``longest`` words with
    at least ``least`` occurrences in its language, and one row a language
    with ``n_words`` 0 and the number of all its words.

    Texts are lower-cased (A-Z), cut into pieces at ``BREAKS``, pieces into
    words at ``BLANKS``; phrases lie within pieces, occurrences may overlap.  A
    null text is empty, a null language is ``und``; ids (null, repeated) only
    choose the sample; repeated rows count each; other columns are not read;
    an empty table gives an empty result.  Counts are exact whatever the
    sample proposes; ``share``, ``lowered`` and ``bits`` change the work only."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = docs.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h"),
                        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sampled = keyed.mapInArrow(_sample(longest, share), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    proposed = spark.sparkContext.broadcast(
        build_filter(sampled.filter(F.col("n") >= max(1, int(least * share * lowered))), bits).tobytes())

    def counted(run, what: str) -> DataFrame:
        sums = rows.mapInArrow(run, _COUNTED).groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("n"))
        return stage(sums.filter((F.col("n_words") == 0) | (F.col("n") >= least)), what)

    found = counted(_count(longest, proposed), "phrases")
    hashed = found.filter("n_words > 0").select("lang", "phrase").mapInArrow(_hash_phrases, "lang string, phrase string, h long")
    leading = found.filter((F.col("n_words") > 0) & (F.col("n_words") < longest))
    hashed_leading = leading.select("lang", "phrase").mapInArrow(_hash_phrases, "lang string, phrase string, h long")

    def missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(proposed.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(~_member(known, batch.column("h").to_numpy().view(np.uint64))))

    if not hashed_leading.mapInArrow(missed, hashed_leading.schema).isEmpty():  # the border has frequent phrases
        frequent = spark.sparkContext.broadcast(build_filter(hashed, bits).tobytes())
        found = found.unionByName(counted(_count(longest, proposed, frequent), "phrases-more"))
    return found


# ---- scores -----------------------------------------------------------------

def cut_score(a, n, left, right):
    """floor(1000 * a * n / (left * right)), exact beyond 64 bits."""
    wide = [F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c.cast("decimal(20,0)") for c in (a, n, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1], wide[2] * wide[3])


def collocations(docs: DataFrame, id_col: str, lang_col: str, text_col: str, least: int = 100, longest: int = 5,
                 absorbed: int = 100, top: int = 2000, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    Candidates are the phrases of 2 to ``longest`` words with a = n(phrase) at
    least ``least``.  Cut behind its first k words, a candidate has l = n(first
    part), r = n(rest) and the score floor(1000 * a * n / (l * r)), n being its
    language's words; the lowest-scoring cut counts, ties to the smallest k.  A
    candidate inside a longer one with ``absorbed`` percent of its occurrences
    is dropped.  Order: score and a descending, phrase ascending by UTF-8.
    Nulls, repeated rows, other columns and empty tables: ``frequent_phrases``,
    whose arguments ``how`` may hold."""
    found = frequent_phrases(docs, id_col, lang_col, text_col, least, longest, **how)
    counts = small_or_shuffled(found.filter("n_words > 0").select("lang", "phrase", "n"), "counts", BROADCAST_ROWS)
    totals = small_or_shuffled(found.filter("n_words = 0").groupBy("lang").agg(F.sum("n").alias("n")), "words", BROADCAST_ROWS)
    words = F.split("phrase", " ")
    candidates = found.filter("n_words > 1").select("lang", "phrase", F.col("n").alias("a"), "n_words", words.alias("w"))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    # what lies in a longer candidate lies in one that is one word longer and occurs as often or more
    inside = candidates.filter("n_words > 2").select("lang", "a", F.explode(F.array(
        part(F.lit(1), F.col("n_words") - 1), part(F.lit(2), F.col("n_words") - 1))).alias("phrase"))
    inside = small_or_shuffled(inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer")), "inside", BROADCAST_ROWS)
    own = (candidates.join(inside, ["lang", "phrase"], "left")
           .filter(F.coalesce(100 * F.col("longer") < absorbed * F.col("a"), F.lit(True))).drop("longer"))
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
            .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
            .join(totals, "lang").withColumn("score", cut_score("a", "n", "l", "r")))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each hashed part of a language first, so that none meets whole in one task
    parted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
