"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of a bounded
sample of its training texts.  A text is lower-cased, everything in ASCII but
letters becomes single spaces, and it is cut into short pieces; every piece is
compressed with every dictionary, and the language whose pieces are
smallest in sum is predicted; a narrow margin to the runner-up marks the
prediction as rejected.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_or_shuffled

#: A language's dictionary is taken from this many distinct training texts, so many bytes of each from anywhere in it ...
DICT_DOCS, DOC_BYTES = 512, 256
#: ... and a line end between them, which is what it holds at most.
DICT_BYTES = DICT_DOCS * (DOC_BYTES + 1)
#: Parts in which a language's texts are ranked before the best of all parts are.
RANK_PARTS = 64
#: Texts are compressed in pieces of so many bytes, so that a long text cannot teach the compressor its own language.
PIECE = 2048
LEVEL = 6
#: A margin (1 - smallest / second smallest) below this is too narrow.
MIN_MARGIN = 0.01
UNKNOWN = "und"

_LETTERS = bytes(c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))


def folded(text: str) -> bytes:
    """What is compressed: lower case, ASCII letters and all other characters, single spaces."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def _excerpts(doc_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist()):
                raw = folded(text)
                start = h % max(1, len(raw) - doc_bytes + 1)
                out.append(raw[start:start + doc_bytes])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("n"), pa.array(out, pa.binary())], ["lang", "n", "excerpt"])
    return run


def train(docs: DataFrame, text_col: str, lang_col: str, key_cols: list[str],
          dict_docs: int = DICT_DOCS, doc_bytes: int = DOC_BYTES, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Language -> dictionary, from the documents with a text and a language.

    The sample is the ``dict_docs`` distinct texts of each language that come
    first by a hash of the text (so reruns agree; copies count once, texts
    without letters come last), an excerpt of ``doc_bytes`` bytes each, from a
    place of the whole folded text that the hash chooses.  ``key_cols`` do not
    matter.  Hashes are ranked first, in parts of a language and then among
    the parts' best; only the chosen texts are folded, and the driver receives
    ``dict_bytes`` a language at most."""
    texts = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
             .filter(F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0)))
    blank = ~F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]")
    keys = texts.select("lang", "h", blank.alias("blank")).groupBy("lang", "h").agg(F.min("blank").alias("blank"))
    keys = keys.withColumn("part", F.pmod("h", F.lit(RANK_PARTS)))
    first = Window.partitionBy("lang", "part").orderBy("blank", "h")
    rank = Window.partitionBy("lang").orderBy("blank", "h")
    chosen = (keys.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= dict_docs)
              .withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= dict_docs).select("lang", "h", "n"))
    chosen = small_or_shuffled(chosen, "sample", 1_000_000)
    rows = texts.join(chosen, ["lang", "h"]).select("lang", "text", "h", "n")
    sample = (rows.mapInArrow(_excerpts(doc_bytes), "lang string, n int, excerpt binary")
              .groupBy("lang", "n").agg(F.min("excerpt").alias("excerpt")))
    parts: dict[str, list[bytes]] = {}
    for r in sample.orderBy("lang", "n").select("lang", "excerpt").collect():
        parts.setdefault(r["lang"], []).append(bytes(r["excerpt"]))
    return {lang: b"\n".join(p)[:dict_bytes] for lang, p in sorted(parts.items())}


def _classify(dicts: dict[str, bytes], min_margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        langs = list(dicts)
        made = []
        for lang in langs:
            d = z.ZstdCompressionDict(dicts[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            made.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False).compress)
        for batch in batches:
            pred, score = [], []
            for text in batch.columns[-1].to_pylist():
                # the first letter mostly stands near the start, so this looks at a few characters
                if text is None or not langs or not any(c.isalpha() for c in text):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                raw = folded(text)
                sizes = [0] * len(langs)
                for i in range(0, len(raw), PIECE):
                    piece = raw[i:i + PIECE]
                    for k, compress in enumerate(made):
                        sizes[k] += len(compress(piece))
                order = sorted(range(len(langs)), key=lambda k: (sizes[k], langs[k]))
                pred.append(langs[order[0]])
                score.append(1 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array([s < min_margin for s in score], pa.bool_())],
                [*batch.schema.names[:-1], "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, dicts: dict[str, bytes], text_col: str, keep: list[str],
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """The ``keep`` columns, lang_pred, score and rejected of every row.

    score is the margin 1 - smallest / second smallest compressed size (1 with
    a single language).  lang_pred is ``und`` with score 0 where the text is
    null or holds no letter, or nothing was learned; equal sizes go to the
    smaller language name.  Only the text is an input; repeated rows and null
    ids are judged one by one, empty tables give an empty result.  The whole
    text is read, one narrow pass, no shuffle; the dictionaries ship with the
    task (``DICT_BYTES`` a language)."""
    t = docs.select(*keep, F.col(text_col).alias("_input"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.schema.fields[:-1])
    return t.mapInArrow(_classify(dicts, min_margin), f"{kinds}, lang_pred string, score double, rejected boolean")
