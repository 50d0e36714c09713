"""Language identification: held-out accuracy and defined results at the edges."""
from edges import SF01
from pyspark.sql import functions as F

from edges import edge_docs, no_docs  # noqa: F401
from gridspark.llm import langid
from gridspark.llm.queries import op10_lang_zstd


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = op10_lang_zstd(spark, SF01).join(truth, "doc_id").cache()
    assert rows.count() == truth.count()
    own = rows.filter("held_out").selectExpr("avg(int(lang = lang_pred)) AS a", "min(score) AS lo", "max(score) AS hi").first()
    assert own.a >= 0.97 and 0 <= own.lo and own.hi <= 1
    sure = rows.filter("held_out and not rejected and n > 100").selectExpr("avg(int(lang = lang_pred))").first()[0]
    assert sure >= 0.99


def test_learns_from_text_and_lang_of_its_rows_only(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    a = langid.train(docs.filter(~held), "text", "lang", ["doc_id"])
    b = langid.train(docs.withColumn("text", F.when(held, "xx").otherwise(F.col("text"))).filter(~held).repartition(5), "text", "lang", ["doc_id"])
    assert a == b and all(len(d) <= langid.DICT_BYTES for d in a.values())


def test_edges(spark, edge_docs, no_docs):
    dicts = langid.train(edge_docs, "text", "lang", ["doc_id"])
    assert set(dicts) == {"en", "de", "fr"}
    rows = langid.predict(edge_docs, dicts, "text", ["doc_id", "text"]).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert langid.predict(no_docs, dicts, "text", ["doc_id"]).count() == 0
    assert langid.train(no_docs, "text", "lang", ["doc_id"]) == {}
    assert {r.lang_pred for r in langid.predict(edge_docs, {}, "text", ["doc_id"]).collect()} == {"und"}
    same = langid.predict(edge_docs, {"b": b"word", "a": b"word"}, "text", ["doc_id"]).filter("doc_id = 1").first()
    assert same.lang_pred == "a" and same.score == 0 and same.rejected


def test_learns_from_the_whole_text_and_counts_copies_once(spark):
    header = "menu startseite impressum datenschutz anmelden " * 12
    bodies = [" ".join(f"body{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + i // 26)}" for j in range(400)) for i in range(40)]
    rows = [(i, header + b, "en") for i, b in enumerate(bodies)] + [(100 + i, "1234 " * 200 + "letters stand behind", "fr") for i in range(3)]
    rows += [(1000 + i, "copied words " * 30, "en") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = langid.train(docs, "text", "lang", ["doc_id"], dict_docs=41)
    parts = got["en"].split(b"\n")
    assert len(parts) == 41 and sum(p.startswith(b"copied") or b"copied words" in p for p in parts) == 1
    assert sum(b"body" in p for p in parts) >= 30 and b"letters stand behind" in got["fr"]


def test_predictions_equal_a_plain_classifier(spark):
    """Hashes, excerpts, dictionaries and sizes worked out anew, text by text, on a whole table."""
    import re
    import zlib

    import xxhash
    import zstandard as z
    from edges import SF001

    def fold(text):
        return b" ".join(re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()))

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = {}
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 4 != 2 and d.lang is not None and (d.text or "").strip(" "):
            h = xxhash.xxh64_intdigest(d.text.encode(), 42)
            h -= (h >= 2**63) * 2**64
            raw = fold(d.text)
            at = h % max(1, len(raw) - 255)
            learned.setdefault(d.lang, {})[raw == b"", h] = raw[at:at + 256]
    made = {}
    for lang, own in learned.items():
        taught = z.ZstdCompressionDict(b"\n".join(own[k] for k in sorted(own)[:512]), dict_type=z.DICT_TYPE_RAWCONTENT)
        made[lang] = z.ZstdCompressor(level=6, dict_data=taught, write_content_size=False, write_dict_id=False)
    want = {}
    for d in docs:
        held = zlib.crc32(str(d.doc_id).encode()) % 4 == 2
        if d.text is None or not any(c.isalpha() for c in d.text):
            want[d.doc_id] = (held, "und", 0.0)
            continue
        raw = fold(d.text)
        sizes = sorted((sum(len(c.compress(raw[i:i + 2048])) for i in range(0, len(raw), 2048)), lang) for lang, c in made.items())
        want[d.doc_id] = (held, sizes[0][1], 1 - sizes[0][0] / sizes[1][0])
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in op10_lang_zstd(spark, SF001).collect()}
    assert got == want and len({x[1] for x in want.values()}) >= 4
