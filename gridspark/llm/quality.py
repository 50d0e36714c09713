"""Quality classifier: interpolated modified Kneser-Ney n-grams of characters.

``train`` counts the n-grams of trusted texts and builds, per language, the
model table: every n-gram of orders 1..n with its interpolated probability and
the weight with which it backs off.  ``score`` packs documents into chunks,
asks the sharded table once for each distinct n-gram of a chunk, and sums the
answers into each document's perplexity; ``thresholds`` takes language-specific
quantiles over trusted texts that were held out of the counts.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_worker, rows_in, small_or_shuffled, stage, tidied

ORDER = 5
#: Characters whose n-grams are taken at a time; bytes of text counted together, and packed into a chunk.
SLICE_CHARS, COUNT_BYTES, CHUNK_BYTES = 1 << 19, 16 << 20, 32 << 20
#: Bytes of a chunk's text that are Python strings at a time.
PART_BYTES = 8 << 20
#: So many tasks' remainders of a language make up one chunk.
SHARE = 4
#: One of so many trusted documents is held out of the counts, for the thresholds.
HOLD_OUT = 5
#: A language gets a threshold if so many held-out documents support it; others have the pooled one.
LEAST_DOCS = 5
#: Bits of a hash by whose ranges the pooled model's texts are numbered.
RANK_BITS = 12
#: The quantile of a language's held-out trusted texts that is its threshold.
QUANTILE = 0.98
#: Short texts: so many characters of the language's mean count beside a text's own.
PRIOR_CHARS = 64

# Stand before and after a text; characters below U+0020 are not part of one.
BEGIN, END = "\x02", "\x03"
_CONTROL = re.compile("[\x00-\x1f]")


def normal(text: str | None) -> str:
    """The text with white space as single spaces and without control characters."""
    text = " ".join((text or "").split())
    return _CONTROL.sub("\ufffd", text) if _CONTROL.search(text) else text


# ---- n-grams of a batch of texts ---------------------------------------------------

def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


class Alphabet:
    """The characters of some texts, numbered: n-grams pack into 63 bits where
    they are few enough."""

    def __init__(self, texts: list[str]):
        seen = np.zeros(0x110000, bool)
        seen[[ord(BEGIN), ord(END)]] = True
        for i in range(0, len(texts), 512):
            seen[_codes("".join(texts[i:i + 512]))] = True
        self.chars = np.flatnonzero(seen).astype(np.uint32)
        self.number = np.full(0x110000, -1, np.int32)
        self.number[self.chars] = np.arange(len(self.chars))
        self.bits = max(1, int(len(self.chars) - 1).bit_length())

    def strings(self, k: int, keys: np.ndarray) -> list[str]:
        """The k-grams of some keys."""
        mask = (1 << self.bits) - 1
        table = np.stack([self.chars[(keys >> (self.bits * j)) & mask] for j in range(k - 1, -1, -1)], axis=1)
        flat = np.ascontiguousarray(table, np.uint32).tobytes().decode("utf-32-le")
        return [flat[i:i + k] for i in range(0, len(flat), k)]

    def keys(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, keys) of the k-grams, given as rows of character codes, whose characters are all known."""
        ids = self.number[codes]
        rows = np.flatnonzero((ids >= 0).all(axis=1))
        out = np.zeros(len(rows), np.int64)
        for j in range(codes.shape[1]):
            out = (out << self.bits) | ids[rows, j]
        return rows, out


class Grams:
    """The n-grams of some strings, which end behind the first ``order - 1`` characters of each."""

    def __init__(self, strings: list[str], order: int, alphabet: Alphabet):
        self.order, self.alphabet = order, alphabet
        self.ids = alphabet.number[_codes("".join(strings))].astype(np.int64)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.count = sizes - (order - 1)
        #: where the n-grams end: everywhere but in what stands before them
        inside = np.ones(len(self.ids), bool)
        first = np.cumsum(sizes) - sizes
        for j in range(order - 1):
            inside[first + j] = False
        self.ends = np.flatnonzero(inside)

    def keys(self, k: int, ends: np.ndarray) -> np.ndarray:
        """The key of the k-gram that ends at each place."""
        out = np.zeros(len(ends), np.int64)
        for j in range(k - 1, -1, -1):
            out = (out << self.alphabet.bits) | self.ids[ends - j]
        return out


def _batches(texts: list[str], order: int) -> Iterator[tuple[int, Grams]]:
    """(first text, grams) of stretches of the texts, about ``SLICE_CHARS``
    long, under alphabets that many stretches share.  Each text has
    ``order - 1`` beginnings and an end.

    Texts whose common alphabet does not fit are halved; so is a single text of
    more different characters than fit, whose parts come one after the other
    under its place, the later ones behind the ``order - 1`` characters before them."""
    before = order - 1
    todo = [(0, [BEGIN * before + t + END for t in texts])]
    while todo:
        at, some = todo.pop()
        alphabet = Alphabet(some)
        if alphabet.bits * order > 63:
            half = len(some) // 2
            if half:
                todo += [(at + half, some[half:]), (at, some[:half])]
            else:
                cut = (before + len(some[0])) // 2
                todo += [(at, [some[0][cut - before:]]), (at, [some[0][:cut]])]
            continue
        i = 0
        while i < len(some):
            to, size = i, 0
            while to < len(some) and (to == i or size + len(some[to]) <= SLICE_CHARS):
                size += len(some[to])
                to += 1
            yield at + i, Grams(some[i:to], order, alphabet)
            i = to


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """(language, rows, normal texts) of the batch's rows with characters."""
    langs = np.array(batch.column("lang").to_pylist(), object)
    for lang in sorted(set(langs.tolist())):
        rows = np.flatnonzero(langs == lang)
        texts = [normal(t) for t in batch.column("text").take(pa.array(rows)).to_pylist()]
        some = np.flatnonzero([bool(t) for t in texts])
        if len(some):
            yield lang, rows[some], [texts[i] for i in some]


# ---- the model table ---------------------------------------------------------------

def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            for part in rows_in(batch, COUNT_BYTES):
                for lang, _, texts in _by_lang(part):
                    found: dict[Alphabet, list[tuple[np.ndarray, np.ndarray]]] = {}
                    for _, g in _batches(texts, order):
                        found.setdefault(g.alphabet, []).append(np.unique(g.keys(order, g.ends), return_counts=True))
                    for alphabet, some in found.items():
                        keys, at = np.unique(np.concatenate([k for k, _ in some]), return_inverse=True)
                        n = np.bincount(at, np.concatenate([c for _, c in some])).astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys), pa.string()), pa.array(alphabet.strings(order, keys), pa.string()),
                             pa.array(n)], ["lang", "gram", "c"])
    return run


def _discount(c: Column, d: Column) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _counted(texts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, c): the n-grams of the highest order in texts (lang, text)."""
    return (texts.filter(F.col("text").isNotNull()).mapInArrow(tidied(_count(order)), "lang string, gram string, c long")
            .groupBy("lang", "gram").agg(F.sum("c").alias("c")))


def train(trusted: DataFrame, lang_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """The model table (lang, gram, logp, bow) of trusted texts, stored in the
    shared folder; null languages count as the language ''.

    The highest order has raw counts, lower orders the number of different
    characters before an n-gram.  Each order and language has the three
    discounts of its counts of counts (for one that these leave without a
    value in (0, i]: i / 2).  ``gram`` '' holds the probability of a character
    never seen.  Counts are of all texts given, combined in the tasks before
    they are shuffled by n-gram; no key is hotter than its tasks."""
    texts = trusted.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    return _model(_counted(texts, order), order)


def _model(counted: DataFrame, order: int) -> DataFrame:
    """The model table of counted n-grams of the highest order."""
    counts = {order: stage(counted, "counts")}
    for k in range(order - 1, 0, -1):
        ends = counts[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
        counts[k] = stage(ends, f"counts{k}")  # read several times below, each time in a short plan
    discounts = small_or_shuffled(_discounts(counts), "discounts", 100_000)

    def contexts(k: int) -> DataFrame:
        c = counts[k].join(discounts.filter(F.col("k") == k), "lang")
        return (c.groupBy("lang", F.substring("gram", 1, k - 1).alias("h"))
                .agg(F.sum("c").alias("total"), F.sum(_discount(F.col("c"), F.col("d"))).alias("kept"))
                .select("lang", "h", "total", (F.col("kept") / F.col("total")).alias("back")))

    lower = counts[1].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p")).select("lang", F.lit("").alias("gram"), "p")
    unseen = lower.join(contexts(1), "lang").select("lang", "gram", F.log(F.col("p") * F.col("back")).alias("logp"), F.lit(0.0).alias("bow"))
    orders = [unseen]
    for k in range(1, order + 1):
        c = counts[k].join(discounts.filter(F.col("k") == k), "lang").withColumn("h", F.substring("gram", 1, k - 1))
        c = c.withColumn("suffix", F.substring("gram", 2, k - 1)).join(contexts(k), ["lang", "h"])
        c = c.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
        p = (F.col("c") - _discount(F.col("c"), F.col("d"))) / F.col("total") + F.col("back") * F.col("below")
        lower = stage(c.select("lang", "gram", p.alias("p")), f"order{k}")
        rows = lower.withColumn("bow", F.lit(0.0))
        if k < order:
            above = contexts(k + 1).select("lang", F.col("h").alias("gram"), F.log("back").alias("bow"))
            rows = lower.join(above, ["lang", "gram"], "full")  # contexts of text beginnings are no n-grams themselves
        orders.append(rows.select("lang", "gram", F.log("p").alias("logp"), F.coalesce("bow", F.lit(0.0)).alias("bow")))
    table = orders[0]
    for rows in orders[1:]:
        table = table.union(rows)
    return stage(table.select("lang", "gram", F.col("logp").cast("float"), F.col("bow").cast("float")), "model")


def _discounts(counts: dict[int, DataFrame]) -> DataFrame:
    """(lang, k, d array<double>): the discounts of counts 1, 2 and 3 or more."""
    all_counts = None
    for k, c in counts.items():
        some = c.filter("c <= 4").groupBy("lang", "c").agg(F.count("*").alias("n")).withColumn("k", F.lit(k))
        # languages whose counts are all larger need a row too
        some = some.union(c.select("lang").distinct().select("lang", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(k)))
        all_counts = some if all_counts is None else all_counts.union(some)
    n = [F.coalesce(F.sum(F.when(F.col("c") == i, F.col("n"))), F.lit(0)).cast("double").alias(f"n{i}") for i in range(1, 5)]
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def d(i: int) -> Column:
        value = i - (i + 1) * y * F.try_divide(f"n{i + 1}", F.col(f"n{i}"))
        return F.when((value > 0) & (value <= i), value).otherwise(i / 2)

    return all_counts.groupBy("lang", "k").agg(*n).select("lang", "k", F.array(d(1), d(2), d(3)).alias("d"))


# ---- scoring -----------------------------------------------------------------------

def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, blob): rows of one language as a compressed Arrow stream.

    A blob of full size is a chunk of its own; what is left of a language at
    the end of a task shares one with that of the ``SHARE`` tasks beside it,
    so that a chunk holds at most about twice a full blob."""
    from pyspark import TaskContext

    release_worker()
    task = TaskContext.get().partitionId()
    held: dict[str, list[pa.RecordBatch]] = {}
    size: dict[str, int] = {}
    done = 0

    def packed(chunk: str, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows[0].schema, options=pa.ipc.IpcWriteOptions(
                compression=pa.Codec("zstd", compression_level=6))) as w:
            w.write_table(pa.Table.from_batches(rows).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["chunk", "blob"])

    for batch in batches:
        for part in rows_in(batch, CHUNK_BYTES // 8):
            for lang in pc.unique(part.column("lang")).to_pylist():
                own = part.filter(pc.equal(part.column("lang"), lang))
                held.setdefault(lang, []).append(own)
                size[lang] = size.get(lang, 0) + own.nbytes
                if size[lang] >= CHUNK_BYTES:
                    yield packed(f"{task}/{done}", held.pop(lang))
                    size[lang], done = 0, done + 1
    for lang, rows in held.items():
        full = size[lang] >= CHUNK_BYTES // 2
        yield packed(f"{task}/{done}" if full else f"{lang}/{task // SHARE}/shared", rows)
        done += 1


def _unpack(blob: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(blob).read_all().combine_chunks()
    return table.to_batches()[0]


_REQUEST = "chunk string, lang string, gram string"


def _requests(order: int):
    def run(table: pa.Table) -> pa.Table:
        release_worker()
        out = [pa.table({x.split()[0]: pa.array([], pa.string()) for x in _REQUEST.split(", ")})]
        grams: dict[str, set[str]] = {}
        for blob in table.column("blob"):
            found: dict[tuple[str, Alphabet], list[np.ndarray]] = {}
            for part in rows_in(_unpack(blob.as_py()), PART_BYTES):
                for lang, _, texts in _by_lang(part):
                    for _, g in _batches(texts, order):
                        found.setdefault((lang, g.alphabet), []).append(np.unique(g.keys(order, g.ends)))
            for (lang, alphabet), some in found.items():
                # the shorter n-grams are the ends of longer ones, and their contexts the beginnings
                own = grams.setdefault(lang, {""})
                keys = np.unique(np.concatenate(some))
                own.update(alphabet.strings(order, keys))
                for k in range(order - 1, 0, -1):
                    contexts, keys = keys >> alphabet.bits, np.unique(keys & ((1 << (alphabet.bits * k)) - 1))
                    own.update(alphabet.strings(k, np.unique(np.concatenate([contexts, keys]))))
        chunk = table.column("chunk")[0].as_py() if len(table) else None
        for lang, own in grams.items():
            out.append(pa.table({"chunk": pa.array([chunk] * len(own), pa.string()), "lang": pa.array([lang] * len(own), pa.string()),
                                 "gram": pa.array(sorted(own), pa.string())}))
        return pa.concat_tables(out)
    return run


class Answers:
    """The model's rows for one language of a chunk."""

    def __init__(self, grams: list[str], logp: np.ndarray, bow: np.ndarray, order: int):
        sizes = np.fromiter(map(len, grams), np.int64, len(grams))
        self.rows = [np.flatnonzero(sizes == k) for k in range(order + 1)]
        self.codes = [_codes("".join([grams[i] for i in rows])).reshape(-1, k) if k else None for k, rows in enumerate(self.rows)]
        self.logp, self.bow = logp, bow
        self.unseen = float(logp[self.rows[0][0]]) if len(self.rows[0]) else None
        self.alphabet, self.known = None, []

    def _learn(self, alphabet: Alphabet) -> None:
        """Sort the rows by their keys in an alphabet, which mostly stays the same."""
        if self.alphabet is alphabet:
            return
        self.alphabet, self.known = alphabet, [None]
        for rows, codes in zip(self.rows[1:], self.codes[1:]):
            fits, keys = alphabet.keys(codes)
            order = np.argsort(keys)
            self.known.append((keys[order], rows[fits[order]]))

    def _look(self, k: int, keys: np.ndarray) -> np.ndarray:
        """The row of each k-gram, -1 where the model lacks it."""
        stored, rows = self.known[k]
        if not len(stored):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(stored, keys), len(stored) - 1)
        return np.where(stored[at] == keys, rows[at], -1)

    def _logp(self, keys: np.ndarray, bits: int, order: int) -> np.ndarray:
        """The log probability of each n-gram of the full order: that of the
        longest end of it the model has, and the weights of backing off to it."""
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        for k in range(order, 0, -1):
            own = keys[todo] & ((1 << (bits * k)) - 1)
            row = self._look(k, own)
            # a row may stand for a context only; then its probability is null
            seen = (row >= 0) & ~np.isnan(self.logp[row])
            out[todo[seen]] += self.logp[row[seen]]
            todo, own = todo[~seen], own[~seen]
            if k > 1 and len(todo):
                context = self._look(k - 1, own >> bits)
                out[todo] += np.where(context >= 0, self.bow[context], 0)
        out[todo] += self.unseen
        return out

    def text_sums(self, g: Grams) -> np.ndarray:
        """The log probability of each text of ``g``; each distinct n-gram is looked up once."""
        self._learn(g.alphabet)
        keys, at = np.unique(g.keys(g.order, g.ends), return_inverse=True)
        return np.add.reduceat(self._logp(keys, g.alphabet.bits, g.order)[at], np.cumsum(g.count) - g.count)


def _sum_up(order: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        release_worker()
        answers = {}
        for lang in pc.unique(right.column("lang")).to_pylist():
            own = right.filter(pc.equal(right.column("lang"), lang))
            answers[lang] = Answers(own.column("gram").to_pylist(), own.column("logp").to_numpy(), own.column("bow").to_numpy(), order)
        out = []
        for blob in left.column("blob"):
            for rows in rows_in(_unpack(blob.as_py()), PART_BYTES):
                n, total = np.zeros(rows.num_rows, np.int64), np.full(rows.num_rows, np.nan)
                for lang, own, texts in _by_lang(rows):
                    model = answers.get(lang)
                    for at, g in _batches(texts, order):
                        some = own[at:at + len(g.count)]
                        n[some] += g.count
                        if model is not None and model.unseen is not None:
                            total[some] = np.nan_to_num(total[some]) + model.text_sums(g)
                out.append(pa.table({"id": rows.column("id"), "h": rows.column("h"), "lang": rows.column("own"),
                                     "n": pa.array(n), "logp": pa.array(total, from_pandas=True)}))
        return pa.concat_tables(out)
    return run


def score(docs: DataFrame, model: DataFrame, id_col: str, lang_col: str, text_col: str, order: int = ORDER,
          model_col: str | None = None) -> DataFrame:
    """(id, h, lang, n, logp) of every row, stored in the shared folder: ``h``
    is a hash of the text, ``n`` its characters with the end, and ``logp`` its
    log probability, null without a model of its language or without
    characters.  ``model_col`` names the model where that is not the language.

    Texts are shuffled once, packed; a chunk asks for each of its distinct
    n-grams once, so what meets the sharded table follows the chunks'
    vocabularies, not the corpus' length."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                       F.coalesce(F.col(lang_col), F.lit("")).alias("own"),
                       F.coalesce(F.col(model_col or lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    packed = rows.mapInArrow(tidied(_pack), "chunk string, blob binary")
    asked = packed.groupBy("chunk").applyInArrow(_requests(order), _REQUEST)
    answered = asked.join(model, ["lang", "gram"]).select("chunk", "lang", "gram", "logp", "bow")
    summed = (packed.groupBy("chunk").cogroup(answered.groupBy("chunk"))
              .applyInArrow(_sum_up(order), "id long, h long, lang string, n long, logp double"))
    return stage(summed, "scores")


def thresholds(held_out: DataFrame, quantile: float = QUANTILE, fence: float = 0.0, prior: int = PRIOR_CHARS,
               least: int = LEAST_DOCS) -> DataFrame:
    """(lang, mean, most) from scores of held-out trusted texts: the mean
    entropy a character, and the largest (smoothed) entropy that is accepted:
    the quantile, moved out by ``fence`` times its distance from the median
    (by default not at all)."""
    own = held_out.filter(F.col("logp").isNotNull())
    mean = own.groupBy("lang").agg((-F.sum("logp") / F.sum("n")).alias("mean"), F.count("*").alias("docs")).filter(F.col("docs") >= least)
    mean = small_or_shuffled(mean, "means", 100_000)  # a row a language; scores are not dealt by language
    q = F.percentile_approx(smoothed(prior), [0.5, quantile], 10_000)
    return (own.join(mean, "lang").groupBy("lang", "mean").agg(q.alias("q"))
            .select("lang", "mean", (F.col("q")[1] + fence * (F.col("q")[1] - F.col("q")[0])).alias("most")))


def smoothed(prior: int = PRIOR_CHARS) -> Column:
    """A text's entropy a character, ``prior`` characters of the language's mean beside its own."""
    return (-F.col("logp") + prior * F.col("mean")) / (F.col("n") + prior)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(id) of documents labelled good and never bad or toxic; a null label is none."""
    return (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
            .agg(F.min("quality").alias("q"), F.coalesce(F.max("toxic"), F.lit(0)).alias("t")).filter("q = 1 and t = 0").select("id"))


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text) with ``pool``, dealt to ``HOLD_OUT`` folds in turn in
    the order of a hash: numbered within ranges of it, 2**``RANK_BITS`` at most,
    and by the rows of the ranges before."""
    rows = rows.withColumn("_h", F.xxhash64("id", "text")).withColumn("_range", F.shiftright("_h", 64 - RANK_BITS))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("_h", "id"))
    return (rows.withColumn("_nth", nth).join(F.broadcast(starts), "_range")
            .select("id", "text", ((F.col("_before") + F.col("_nth")) % HOLD_OUT).cast("string").alias("pool")))


def _pooled(docs: DataFrame, trusted: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Scores of ``docs`` (id, lang, text) under a model of all languages'
    trusted texts, and the one row (mean, most) of their threshold, or none.

    It learns from all of them, dealt in the order of a hash to ``HOLD_OUT``
    folds; each fold is held out in turn of a model of its own, for the
    threshold.  A fold's n-grams are counted once and added up for the models
    of the others."""
    held = stage(_dealt(trusted.filter(F.col("text").isNotNull())), "pool")
    own = _counted(held.select(F.col("pool").alias("lang"), "text"), order)
    pools = F.array(*[F.lit(str(i)) for i in range(HOLD_OUT)])
    others = own.select(F.explode(F.array_remove(pools, F.col("lang"))).alias("lang"), "gram", "c")
    model = _model(others.groupBy("lang", "gram").agg(F.sum("c").alias("c")), order)
    limit = thresholds(score(held, model, "id", "pool", "text", order).withColumn("lang", F.lit("")))
    return score(docs.withColumn("pool", F.lit("0")), model, "id", "lang", "text", order, "pool"), limit.drop("lang")


def judge(docs: DataFrame, labels: DataFrame, id_col: str, lang_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """(id, h, lang, n_chars, perplexity, threshold, accepted) of every row.

    Trained on the texts of trusted ids but one in ``HOLD_OUT``, which set the
    thresholds.  Accepted are texts whose smoothed entropy does not exceed
    their language's threshold (``threshold`` is that entropy as a perplexity).
    A language of fewer than ``LEAST_DOCS`` held-out texts backs off to a model
    and a threshold pooled over all languages; only where the whole table has
    too few trusted texts for that one is the threshold null and every text
    with characters accepted.  Null, empty and blank texts are rejected with a
    null perplexity; a null language is one of its own; rows that repeat an id
    are judged each by their text; empty tables give an empty result; other
    columns are not read."""
    trusted = small_or_shuffled(trusted_ids(labels), "trusted", 1_000_000)
    held = F.pmod(F.xxhash64(F.col("id")), F.lit(HOLD_OUT)) == 0
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    model = train(texts.filter(~held).join(trusted, "id", "left_semi"), "lang", "text", order)
    scores = score(docs, model, id_col, lang_col, text_col, order)
    limits = thresholds(scores.filter(held).join(trusted, "id", "left_semi"))
    limits = small_or_shuffled(limits, "limits", 100_000)
    rows = scores.join(limits, "lang", "left")
    weak = stage(scores.filter("n > 0").select("lang").distinct().join(limits, "lang", "left_anti"), "weak")
    if not weak.isEmpty():
        weak = small_or_shuffled(weak, "weak", 100_000)
        few = texts.withColumn("lang", F.coalesce("lang", F.lit(""))).join(weak, "lang", "left_semi")
        pooled, limit = _pooled(few, texts.join(trusted, "id", "left_semi").select("id", "text"), order)
        limit = limit.first()
        mean, most = (F.lit(x).cast("double") for x in (limit or (None, None)))
        rows = (scores.join(weak, "lang", "left_anti").join(limits, "lang", "left")
                .unionByName(pooled.withColumn("mean", mean).withColumn("most", most)))
    fine = F.coalesce(smoothed() <= F.col("most"), F.lit(True)) & (F.col("n") > 0)
    return rows.select("id", "h", F.nullif("lang", F.lit("")).alias("lang"), F.col("n").alias("n_chars"),
                       F.exp(-F.col("logp") / F.col("n")).alias("perplexity"), F.exp("most").alias("threshold"),
                       fine.alias("accepted"))


def keep_accepted(docs: DataFrame, judged: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, with their columns, that were accepted."""
    bad = judged.filter(~F.col("accepted")).select(F.col("id").alias("_id"), F.col("h").alias("_h")).distinct()
    bad = small_or_shuffled(bad, "rejected", 1_000_000)
    same = docs[id_col].cast("long").eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad["_h"])
    return docs.join(bad, same, "left_anti")
